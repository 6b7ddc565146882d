"""Column helpers for ad text, with the SQL build's exact string semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skillgrid.functions.constants import SNIPPET_CHARS


def search_text(headline: Column, description: Column) -> Column:
    """headline || ' ' || description, NULL parts as '' (not concat_ws: it drops the space)."""
    return F.concat(F.coalesce(headline, F.lit("")), F.lit(" "), F.coalesce(description, F.lit("")))


def collapse_whitespace(text: Column) -> Column:
    """Runs of RE2 whitespace (tab, LF, FF, CR, space; not VT) become one space."""
    return F.regexp_replace(text, r"[\t\n\f\r ]+", " ")


def snippet(description: Column, chars: int = SNIPPET_CHARS) -> Column:
    """First ``chars`` code points of the collapsed description ('' for NULL)."""
    return F.left(collapse_whitespace(F.coalesce(description, F.lit(""))), F.lit(chars))


# Collapsing a prefix of a text gives a prefix of the collapsed text, so the
# snippet can be cut from the collapsed first SNIPPET_WINDOW characters unless
# those collapse to fewer than the snippet length (long whitespace runs).
SNIPPET_WINDOW = 4_000


def snippet_head(description: Column, window: int = SNIPPET_WINDOW) -> Column:
    """Collapsed first ``window`` characters of the description ('' for NULL)."""
    return collapse_whitespace(F.left(F.coalesce(description, F.lit("")), F.lit(window)))


def snippet_from_head(
    head: Column, description: Column, chars: int = SNIPPET_CHARS, window: int = SNIPPET_WINDOW
) -> Column:
    """Same value as ``snippet(description)``; collapses the whole text only when
    the collapsed head is too short and the description is longer than the window."""
    whole = F.coalesce(description, F.lit(""))
    enough = (F.length(whole) <= window) | (F.length(head) >= chars)
    return F.when(enough, F.left(head, F.lit(chars))).otherwise(
        F.left(collapse_whitespace(whole), F.lit(chars))
    )


def trim_space_separators(text: Column) -> Column:
    """SQL ``trim``: strips Unicode space separators (Zs, e.g. NBSP), not tab/newline."""
    return F.regexp_replace(text, r"^\p{Zs}+|\p{Zs}+\z", "")


def month_start(ts: Column) -> Column:
    """First instant of the month as a wall-clock timestamp (session TZ is UTC)."""
    return F.date_trunc("month", ts).cast("timestamp_ntz")
