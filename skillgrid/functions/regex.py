"""Regex dialects for Spark (Java ``java.util.regex``).

Skill aliases come in two dialects whose meaning differs from Java's:

* ``re2``: what the SQL build runs (RE2 with the ``i`` option). ``\\b``/``\\w``
  and POSIX classes are ASCII, ``\\s`` has no vertical tab, ``$`` is end of text.
* ``python``: Python ``re`` on ``str`` with ``IGNORECASE``. ``\\b``/``\\w``/
  ``\\s``/``\\d`` are Unicode-aware.

``to_java`` rewrites a pattern so that Spark's ``rlike``/``regexp_extract``
find the same matches. ``literal_anchor`` gives the longest literal run
every match must contain, used as a cheap ``contains`` prefilter.
"""

from __future__ import annotations

DIALECTS = ("re2", "python")

# Java flags: case-insensitive with Unicode case folding (so 'Ä' matches 'ä').
_FLAGS = "(?iu)"

# Python's \w on str: letters, numbers (any N category) and underscore.
_PY_WORD = r"\p{L}\p{N}_"
# Python's \s on str: str.isspace() characters.
_PY_SPACE = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# RE2's \s: no vertical tab (Java's \s has it).
_RE2_SPACE = r"\t\n\f\r "

# Characters a case-insensitive match folds onto ASCII letters, but that
# Spark's lower() leaves alone (or expands). The prefilter maps them first so
# that a 'contains' test never rejects a text the regex would accept.
PREFILTER_FOLDS = {
    "re2": ("ſK", "sk"),  # long s, Kelvin sign
    "python": ("ſKİı", "skii"),  # + dotted / dotless i
}

# POSIX classes inside [...]. RE2 case-folds a class under the 'i' flag, so a
# class of letters also holds the two non-ASCII letters that fold onto ASCII
# (long s, Kelvin sign); Java does not fold \p{...} classes, so add them.
_FOLDS_TO_ASCII = r"\x{17F}\x{212A}"
_POSIX = {
    "alnum": r"\p{Alnum}" + _FOLDS_TO_ASCII,
    "alpha": r"\p{Alpha}" + _FOLDS_TO_ASCII,
    "digit": r"\p{Digit}",
    "lower": r"\p{Lower}" + _FOLDS_TO_ASCII,
    "upper": r"\p{Upper}" + _FOLDS_TO_ASCII,
    "space": _RE2_SPACE,
    "punct": r"\p{Punct}",
    "xdigit": r"\p{XDigit}",
    "word": r"\w",
}


def _word_class(dialect: str, negate: bool = False) -> str:
    if dialect == "re2":
        return r"\W" if negate else r"\w"
    return f"[{'^' if negate else ''}{_PY_WORD}]"


def _boundary(dialect: str, negate: bool = False) -> str:
    w = _word_class(dialect)
    if negate:
        return f"(?:(?<={w})(?={w})|(?<!{w})(?!{w}))"
    return f"(?:(?<={w})(?!{w})|(?<!{w})(?={w}))"


def _opening(pattern: str, i: int, dialect: str) -> str | None:
    """The boundary before a literal word character at ``pattern[i]``: what a search can reject by one character.

    Not where the character is optional, or also stands for one that is no word
    character (RE2's word characters are ASCII, and s and k match two others).
    """
    c = pattern[i : i + 1]
    if not (c.isascii() and c.isalnum()) or pattern[i + 1 : i + 2] in set("?*{") or (dialect == "re2" and c in "sSkK"):
        return None
    return f"(?={c})(?<!{_word_class(dialect)})"


def _class_body(letter: str, dialect: str) -> str | None:
    """Contents (no brackets) of a shorthand class usable inside ``[...]``."""
    if letter == "s":
        return _RE2_SPACE if dialect == "re2" else _PY_SPACE
    if letter == "w":
        return r"\w" if dialect == "re2" else _PY_WORD
    if letter == "d":
        return "0-9" if dialect == "re2" else r"\p{Nd}"
    return None


def to_java(pattern: str, dialect: str = "re2") -> str:
    """Rewrite ``pattern`` from ``dialect`` into an equivalent Java regex."""
    if dialect not in DIALECTS:
        raise ValueError(f"unknown regex dialect {dialect!r}; use one of {DIALECTS}")
    out: list[str] = []
    i, n = 0, len(pattern)
    in_class = False
    class_start = -1
    while i < n:
        c = pattern[i]
        if c == "\\" and i + 1 < n:
            e = pattern[i + 1]
            i += 2
            if in_class:
                body = _class_body(e, dialect)
                out.append(body if body is not None else "\\" + e)
                continue
            if e == "b":
                out.append(_opening(pattern, i, dialect) or _boundary(dialect))
            elif e == "B":
                out.append(_boundary(dialect, negate=True))
            elif e in "wsd":
                out.append(f"[{_class_body(e, dialect)}]")
            elif e in "WSD":
                out.append(f"[^{_class_body(e.lower(), dialect)}]")
            elif e == "Z":  # Python's end of text
                out.append(r"\z")
            else:
                out.append("\\" + e)
            continue
        if in_class:
            if c == "[" and pattern.startswith("[:", i):
                end = pattern.find(":]", i + 2)
                name = pattern[i + 2 : end] if end > 0 else ""
                if name in _POSIX:
                    out.append(_POSIX[name])
                    i = end + 2
                    continue
            if c == "[":  # a literal '[' inside a class
                out.append(r"\[")
                i += 1
                continue
            if c == "]" and i > class_start:
                in_class = False
            out.append(c)
            i += 1
            continue
        if c == "[":
            in_class = True
            out.append(c)
            i += 1
            if i < n and pattern[i] == "^":
                out.append("^")
                i += 1
            if i < n and pattern[i] == "]":  # leading ']' is a literal
                out.append(r"\]")
                i += 1
            class_start = i
            continue
        if c == "$":
            out.append(r"\z" if dialect == "re2" else r"(?=\n?\z)")
        elif c == ".":
            out.append(r"[^\n]")
        else:
            out.append(c)
        i += 1
    return _FLAGS + "".join(out)


_QUANTIFIERS = "?*+{"
_LITERAL_ESCAPES = set(".+-/#*?()[]{}|^$\\ &~'\"!,:;<=>@%`")


def _skip_group(pattern: str, i: int) -> int:
    """Index just past the ')' closing the group that opens at ``pattern[i]``."""
    depth, in_class, n = 0, False, len(pattern)
    while i < n:
        c = pattern[i]
        if c == "\\":
            i += 2
            continue
        if in_class:
            if c == "]":
                in_class = False
        elif c == "[":
            in_class = True
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if depth == 0:
                return i + 1
        i += 1
    return n


def _skip_class(pattern: str, i: int) -> int:
    i += 1
    if i < len(pattern) and pattern[i] == "^":
        i += 1
    if i < len(pattern) and pattern[i] == "]":
        i += 1
    while i < len(pattern):
        if pattern[i] == "\\":
            i += 2
            continue
        if pattern.startswith("[:", i):
            end = pattern.find(":]", i + 2)
            if end > 0:
                i = end + 2
                continue
        if pattern[i] == "]":
            return i + 1
        i += 1
    return i


def literal_anchor(pattern: str) -> str | None:
    """Longest lower-cased literal substring that every match must contain.

    Groups, classes, assertions and optional atoms break a run; a top-level
    alternation means no single literal is required (``None``).
    """
    runs: list[str] = []
    run: list[str] = []
    i, n = 0, len(pattern)
    last_was_char = False

    def cut() -> None:
        if run:
            runs.append("".join(run))
            run.clear()

    while i < n:
        c = pattern[i]
        if c in _QUANTIFIERS:
            optional = c in "?*" or pattern.startswith("{0", i)
            if c == "{":
                close = pattern.find("}", i)
                i = close + 1 if close > 0 else n
            else:
                i += 1
            if i < n and pattern[i] in "?+":  # lazy / possessive suffix
                i += 1
            if last_was_char and optional:
                run.pop()
            cut()
            last_was_char = False
            continue
        if c == "|":
            return None
        if c == "\\" and i + 1 < n:
            e = pattern[i + 1]
            i += 2
            if e in _LITERAL_ESCAPES:
                run.append(e)
                last_was_char = True
            else:
                cut()
                last_was_char = False
            continue
        if c == "(":
            i = _skip_group(pattern, i)
            cut()
            last_was_char = False
            continue
        if c == "[":
            i = _skip_class(pattern, i)
            cut()
            last_was_char = False
            continue
        if c in ".^$":
            cut()
            last_was_char = False
            i += 1
            continue
        run.append(c)
        last_was_char = True
        i += 1
    cut()
    best = max(runs, key=len, default="")
    return best.lower() or None


def match_reach(pattern: str) -> int | None:
    """An upper bound of a match's code points, or None.

    Only for patterns of single characters, classes, shorthands and word
    boundaries, some of them optional: whether such a pattern matches at a place
    depends on the match and one character before and after it.
    """
    plain, i = [], 0
    while i < len(pattern):
        if pattern[i] == "\\":
            if pattern[i + 1 : i + 2] not in _LITERAL_ESCAPES | set("bBwWsSdD"):
                return None
            i += 2
            continue
        plain.append(pattern[i])
        i += 1
    return None if set(plain) & set("*+{(|^$") else len(pattern)
