"""Skill extraction: taxonomy regexes (D1-D5, D7) and provided labels.

The regex "theta join" of ads x patterns is unrolled into one expression per
skill: an ordered ``CASE WHEN`` over that skill's aliases, so the first alias
that matches wins without a join or a window over wide rows. Each alias is
guarded by a ``contains`` test on its longest literal (and each skill by a
literal all its aliases share), which skips the regex engine for almost every
(ad, alias) pair. Where several extractions read the same ads, ``with_alias_bits``
makes those tests once and stores them with the ads as two longs, and each
extraction runs the regex engine only where a bit is set. All of it is a narrow
projection: the ad text is read once and never shuffled. Only the (id, skill) dedupe shuffles, and with a staging
function only for duplicated ids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgrid.functions import literals
from skillgrid.functions import text as tx
from skillgrid.functions.constants import LABEL_SOURCE, REGEX_SOURCE
from skillgrid.functions.regex import PREFILTER_FOLDS, literal_anchor, to_java
from skillgrid.functions.taxonomy import TECH_SKILLS, pattern_rows

MATCH_COLUMNS = [
    "id",
    "publication_month",
    "skill",
    "matched_text",
    "headline",
    "description_snippet",
]


def _grouped_patterns(
    taxonomy: dict[str, list[str]] | None, dialect: str
) -> dict[str, list[str]]:
    grouped: dict[str, list[str]] = {}
    for skill, _order, pattern in pattern_rows(taxonomy, dialect):
        grouped.setdefault(skill, []).append(pattern)
    return grouped


def prefilter_text(search_text: Column, dialect: str) -> Column:
    """Lower-cased text the literal anchors are searched in.

    The fold characters are rare, and ``translate`` is costly on long text,
    so it runs only for texts that contain one (byte scans decide).
    """
    src, dst = PREFILTER_FOLDS[dialect]
    present = None
    for c in src:
        hit = search_text.contains(c)
        present = hit if present is None else present | hit
    return F.lower(F.when(present, F.translate(search_text, src, dst)).otherwise(search_text))


def _sql_string(value: str) -> str:
    """A Spark SQL string literal (backslash-escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _skill_gate(anchors: list[str | None], min_len: int = 3) -> str | None:
    """Longest substring shared by every alias anchor of a skill (or None).

    Every match of every alias contains its anchor, hence the gate: when the
    gate is absent from a text no alias of the skill can match, and one
    ``contains`` skips them all.
    """
    if len(anchors) < 2 or any(a is None for a in anchors):
        return None
    base = min(anchors, key=len)
    best = ""
    for i in range(len(base)):
        for j in range(i + len(best) + 1, len(base) + 1):
            if all(base[i:j] in a for a in anchors):
                best = base[i:j]
            else:
                break
    return best if len(best) >= min_len else None


# Two longs of an ad that say which of the fixed taxonomy's aliases its text may hold.
ALIAS_BITS = ["alias_bits_0", "alias_bits_1"]


def _mask_sql(masks: dict[str, int]) -> str:
    """A test of whether one of the aliases with these bits is possible."""
    return "(" + " OR ".join(f"(`{c}` & {_long(m)}) <> 0L" for c, m in masks.items()) + ")"


def _long(mask: int) -> str:
    """A mask of 64 bits as a signed SQL long."""
    return f"bigint('{mask - (1 << 64) if mask >= 1 << 63 else mask}')"


def with_alias_bits(ads: DataFrame) -> DataFrame:
    """Adds ``ALIAS_BITS``: for each alias of the fixed taxonomy, whether the ad's text holds its anchor.

    Valid for both dialects: the text is folded in the way that folds more
    (which only adds candidates), and an alias's bit is set by its anchor in
    either dialect; without an anchor it is always set. All anchors are searched
    in one pass over the text (``functions.literals``).
    """
    anchors: dict[str, set[int]] = {}
    always: set[int] = set()
    for dialect in ("re2", "python"):
        rows = pattern_rows(None, dialect)
        if len(rows) > 64 * len(ALIAS_BITS):
            raise ValueError(f"{len(rows)} aliases do not fit {len(ALIAS_BITS)} longs; use operators.anchor_join")
        for number, (_skill, _order, pattern) in enumerate(rows):
            anchor = literal_anchor(pattern)
            if anchor is None:
                always.add(number)
            else:
                anchors.setdefault(anchor, set()).add(number)
    masks = lambda numbers: [sum(1 << (n % 64) for n in numbers if n // 64 == k) for k in range(len(ALIAS_BITS))]
    # A short anchor is mostly found early in a text; the long ones are searched together.
    long = {a: numbers for a, numbers in anchors.items() if len(a.encode()) >= literals.GRAM}
    searched = literals.LiteralSet({a.encode(): masks(numbers) for a, numbers in long.items()})

    @F.pandas_udf(", ".join(f"{c} long" for c in ALIAS_BITS))
    def found_bits(texts: pd.Series) -> pd.DataFrame:
        found = searched.search(texts.tolist(), len(ALIAS_BITS))
        return pd.DataFrame(found.view(np.int64), columns=ALIAS_BITS)

    prepared = with_search_columns(ads, "headline", "description_text", "python")
    prepared = prepared.withColumn("_found", found_bits(F.col("_folded").cast("binary")))
    columns = []
    for k, name in enumerate(ALIAS_BITS):
        parts = [_long(masks(always)[k]), f"`_found`.`{name}`"]
        parts += [
            f"CASE WHEN contains(`_folded`, {_sql_string(a)}) THEN {_long(masks(numbers)[k])} ELSE 0L END"
            for a, numbers in anchors.items() if a not in long and masks(numbers)[k]
        ]
        # Array elements are compiled in methods of their own, a long chain of ORs is not.
        columns.append(F.expr(f"aggregate(array({', '.join(parts)}), 0L, (a, x) -> a | x)").alias(name))
    return prepared.select(*[F.col(c) for c in ads.columns], *columns)


def has_alias_bits(ads: DataFrame) -> bool:
    return set(ALIAS_BITS) <= set(ads.columns)


def skill_match_sql(
    search: str,
    folded: str | None = None,
    taxonomy: dict[str, list[str]] | None = None,
    dialect: str = "re2",
    prefilter: bool = True,
    with_text: bool = True,
    bits: bool = False,
) -> str:
    """SQL text of ``array<struct<skill, pattern_order, matched_text>>``, one entry per matched skill.

    ``search``/``folded`` are SQL expressions (usually column references) for
    the text and its prefilter form. Per skill, an ordered ``CASE WHEN`` over
    its aliases: the first alias that matches wins, ``matched_text`` is the
    raw match (group 0), or NULL without ``with_text`` (one regex call per hit
    instead of two, for callers that need skill names only). Each alias is
    guarded by ``contains`` on its anchor, or with ``bits`` (fixed taxonomy
    only) by its bit of the row's ``ALIAS_BITS``.
    """
    if bits:
        return _bit_match_sql(search, dialect, with_text)
    if folded is None:
        src, dst = PREFILTER_FOLDS[dialect]
        present = " OR ".join(f"contains({search}, {_sql_string(c)})" for c in src)
        translated = f"translate({search}, {_sql_string(src)}, {_sql_string(dst)})"
        folded = f"lower(CASE WHEN {present} THEN {translated} ELSE {search} END)"
    per_skill = []
    for skill, patterns in _grouped_patterns(taxonomy, dialect).items():
        anchors = [literal_anchor(p) if prefilter else None for p in patterns]
        branches = []
        for order, (pattern, anchor) in enumerate(zip(patterns, anchors, strict=True)):
            java = _sql_string(to_java(pattern, dialect))
            hit = f"{search} RLIKE {java}"
            if anchor:
                hit = f"contains({folded}, {_sql_string(anchor)}) AND {hit}"
            text = f"regexp_extract({search}, {java}, 0)" if with_text else "CAST(NULL AS STRING)"
            branches.append(
                f"WHEN {hit} THEN named_struct('skill', {_sql_string(skill)}, "
                f"'pattern_order', {order}, 'matched_text', {text})"
            )
        expr = "CASE " + " ".join(branches) + " END"
        gate = _skill_gate(anchors)
        if gate:
            expr = f"CASE WHEN contains({folded}, {_sql_string(gate)}) THEN {expr} END"
        per_skill.append(expr)
    return "array_compact(array(" + ",\n".join(per_skill) + "))"


def _bit_match_sql(search: str, dialect: str, with_text: bool) -> str:
    """``skill_match_sql`` of the fixed taxonomy over rows that have ``ALIAS_BITS``."""
    per_skill: dict[str, list[str]] = {}
    masks: dict[str, dict[str, int]] = {}
    for number, (skill, order, pattern) in enumerate(pattern_rows(None, dialect)):
        column, k = ALIAS_BITS[number // 64], number % 64
        mine = masks.setdefault(skill, {})
        mine[column] = mine.get(column, 0) | 1 << k
        java = _sql_string(to_java(pattern, dialect))
        text = f"regexp_extract({search}, {java}, 0)" if with_text else "CAST(NULL AS STRING)"
        per_skill.setdefault(skill, []).append(
            f"WHEN {_mask_sql({column: 1 << k})} AND {search} RLIKE {java} THEN named_struct('skill', {_sql_string(skill)}, "
            f"'pattern_order', {order}, 'matched_text', {text})"
        )
    cases = [f"CASE WHEN {_mask_sql(masks[s])} THEN CASE {' '.join(w)} END END" for s, w in per_skill.items()]
    return "array_compact(array(" + ",\n".join(cases) + "))"


def skill_match_array(
    search_col: str = "_search",
    folded_col: str | None = "_folded",
    taxonomy: dict[str, list[str]] | None = None,
    dialect: str = "re2",
    prefilter: bool = True,
    with_text: bool = True,
    bits: bool = False,
) -> Column:
    """The match array over the named text columns, as one parsed expression.

    Built as SQL text and parsed once by Spark (one call instead of ~1,500
    Python-to-JVM calls). Pass ``search_col``/``folded_col`` computed in a
    projection below: the expression mentions them once per alias, and
    Catalyst keeps a multiply-referenced projection instead of inlining it.
    """
    folded = f"`{folded_col}`" if folded_col else None
    return F.expr(skill_match_sql(f"`{search_col}`", folded, taxonomy, dialect, prefilter, with_text, bits))


def found_skill_matches(
    ads: DataFrame,
    taxonomy: dict[str, list[str]] | None = None,
    dialect: str = "re2",
    prefilter: bool = True,
) -> DataFrame:
    """Per-ad matches before the id dedupe: ``MATCH_COLUMNS`` + ``pattern_order``.

    search_text = headline + ' ' + description (NULL parts become ''); the
    match is trimmed of Unicode space separators; the snippet is the first
    400 characters of the whitespace-collapsed description. A narrow stage:
    one projection and a generator over each ad row, no shuffle of the text.
    """
    bits = taxonomy is None and prefilter and has_alias_bits(ads)
    columns = ["id", "publication_month", "headline", "description_text"]
    prepared = _searched(ads, columns, "headline", "description_text", dialect, bits)
    prepared = prepared.withColumn("_head", tx.snippet_head(F.col("description_text")))
    prepared = prepared.withColumn(
        "description_snippet", tx.snippet_from_head(F.col("_head"), F.col("description_text"))
    )
    return prepared.select(
        "id",
        "publication_month",
        "headline",
        "description_snippet",
        F.inline(skill_match_array("_search", "_folded", taxonomy, dialect, prefilter, bits=bits)),
    ).withColumn("matched_text", tx.trim_space_separators(F.col("matched_text")))


def dedupe_matches(found: DataFrame) -> DataFrame:
    """One row per (id, skill): lowest pattern_order, then earliest month, headline,
    snippet, match. A ``min(struct)`` aggregate; its map-side partial step
    collapses a hot duplicated id before the shuffle.
    """
    best = found.groupBy("id", "skill").agg(
        F.min(
            F.struct(
                "pattern_order",
                "publication_month",
                "headline",
                "description_snippet",
                "matched_text",
            )
        ).alias("w")
    )
    return best.select(
        "id",
        F.col("w.publication_month").alias("publication_month"),
        "skill",
        F.col("w.matched_text").alias("matched_text"),
        F.col("w.headline").alias("headline"),
        F.col("w.description_snippet").alias("description_snippet"),
    )


def duplicate_ids(ads: DataFrame) -> DataFrame:
    """Ids on more than one ad row (NULL counts as one id, as in SQL grouping).

    A narrow aggregate over the id column only; partial aggregation collapses
    a hot id map-side.
    """
    return ads.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("id")


def regex_skill_matches(
    ads: DataFrame,
    taxonomy: dict[str, list[str]] | None = None,
    dialect: str = "re2",
    dedupe_ids: bool = True,
    prefilter: bool = True,
) -> DataFrame:
    """``historical_regex_skill_matches``: one row per (id, skill).

    Ids are not unique across archives, and one row per (id, skill) survives
    globally (``dedupe_matches``). The plan is the same whatever the number of
    repeated ids: the ad text is scanned where it lies, and only the match
    rows (headline and snippet, no text) go through the aggregate's shuffle.
    """
    found = found_skill_matches(ads, taxonomy, dialect, prefilter)
    return dedupe_matches(found) if dedupe_ids else found.select(*MATCH_COLUMNS)


def regex_skills(matches: DataFrame) -> DataFrame:
    """``historical_regex_skills``: the compact (id, month, skill) table."""
    return matches.select(
        "id", "publication_month", "skill", F.lit(REGEX_SOURCE).alias("skill_source")
    )


def ams_skills(ads: DataFrame) -> DataFrame:
    """``historical_job_skills`` from the provided label arrays.

    must-have and nice-to-have labels are a UNION ALL (a label in both counts
    twice); a NULL array contributes nothing to the other side; NULL labels
    are dropped. One ``explode`` over the concatenated arrays: a single pass.
    """
    empty = F.array().cast("array<struct<label:string>>")
    labels = F.concat(
        F.coalesce(F.col("must_have_skills").cast("array<struct<label:string>>"), empty),
        F.coalesce(F.col("nice_to_have_skills").cast("array<struct<label:string>>"), empty),
    )
    return (
        ads.select("id", "publication_month", F.explode(labels).alias("s"))
        .select("id", "publication_month", F.col("s.label").alias("skill"))
        .where(F.col("skill").isNotNull())
        .withColumn("skill_source", F.lit(LABEL_SOURCE))
    )


def with_search_columns(
    df: DataFrame, headline: str, description: str, dialect: str
) -> DataFrame:
    """Add ``_search`` (headline + ' ' + description) and ``_folded`` (its prefilter form).

    Computed once per row in their own projection; every alias then refers
    to the columns instead of re-deriving the text.
    """
    return df.withColumn(
        "_search", tx.search_text(F.col(headline), F.col(description))
    ).withColumn("_folded", prefilter_text(F.col("_search"), dialect))


def _searched(ads: DataFrame, columns: list[str], headline: str, description: str, dialect: str, bits: bool) -> DataFrame:
    """The columns with ``_search``, and ``_folded`` unless the rows' alias bits take its place.

    Text is put together only for rows with a bit set.
    """
    if not bits:
        return with_search_columns(ads.select(*columns), headline, description, dialect)
    possible = F.expr(_mask_sql({c: (1 << 64) - 1 for c in ALIAS_BITS}))
    text = tx.search_text(F.col(headline), F.col(description))
    return ads.select(*columns, *ALIAS_BITS).withColumn("_search", F.when(possible, text))


def _sorted_matches(match_array: Column) -> Column:
    found = F.transform(
        match_array,
        lambda m: F.struct(m["skill"].alias("skill"), m["matched_text"].alias("matched_text")),
    )
    return F.array_sort(found)


def skill_matches_column(
    text_sql: str,
    taxonomy: dict[str, list[str]] | None = None,
    dialect: str = "python",
) -> Column:
    """Per-text extraction (D3) of a SQL expression or column name.

    ``array<struct<skill, matched_text>>`` sorted by skill; NULL or empty text
    gives an empty array; the match is not trimmed. For whole tables prefer
    ``job_skill_lists``, which derives the text once per row.
    """
    safe = f"coalesce({text_sql}, '')"
    return _sorted_matches(F.expr(skill_match_sql(safe, None, taxonomy, dialect)))


def skill_list_column(
    text_sql: str, taxonomy: dict[str, list[str]] | None = None, dialect: str = "python"
) -> Column:
    """Skill names only (D4), sorted."""
    return F.transform(skill_matches_column(text_sql, taxonomy, dialect), lambda m: m["skill"])


def skill_matches(
    ads: DataFrame,
    taxonomy: dict[str, list[str]] | None = None,
    dialect: str = "python",
    description_col: str = "description_text",
) -> DataFrame:
    """Per-text extraction (D3) of whole ads: one (id, skill, matched_text) row per ad and skill."""
    bits = taxonomy is None and has_alias_bits(ads)
    prepared = _searched(ads, ["id", "headline", description_col], "headline", description_col, dialect, bits)
    matches = skill_match_array("_search", "_folded", taxonomy, dialect, bits=bits)
    found = prepared.select("id", F.explode_outer(matches).alias("m")).where(F.col("m").isNotNull())
    return found.select("id", "m.skill", "m.matched_text")


def job_skill_lists(
    job_ads: DataFrame,
    taxonomy: dict[str, list[str]] | None = None,
    dialect: str = "python",
    description_col: str = "description__text",
) -> DataFrame:
    """``job_skill_lists``: id, publication_date, skills[] (sorted) per ad."""
    bits = taxonomy is None and has_alias_bits(job_ads)
    columns = ["id", "publication_date", "headline", description_col]
    prepared = _searched(job_ads, columns, "headline", description_col, dialect, bits)
    matches = skill_match_array("_search", "_folded", taxonomy, dialect, with_text=False, bits=bits)
    # entries are already in taxonomy order with one per skill: sort the names
    return prepared.select(
        "id",
        "publication_date",
        F.array_sort(F.transform(matches, lambda m: m["skill"])).alias("skills"),
    )


def job_skills(skill_lists: DataFrame) -> DataFrame:
    """``job_skills``: one row per (ad, skill); empty lists give no rows.

    ``explode_outer`` + a NULL filter equals ``explode`` here, and keeps
    Catalyst from inferring a ``size(skills) > 0`` filter that predicate
    pushdown would inline, re-running the whole extraction below the scan.
    """
    return skill_lists.select(
        "id", "publication_date", F.explode_outer("skills").alias("skill")
    ).where(F.col("skill").isNotNull())


__all__ = [
    "MATCH_COLUMNS",
    "ams_skills",
    "job_skill_lists",
    "job_skills",
    "regex_skill_matches",
    "regex_skills",
    "skill_list_column",
    "skill_match_array",
    "skill_matches",
    "skill_matches_column",
]
