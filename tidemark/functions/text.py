"""Column expressions over definition and script text.

All of these are built-in Spark SQL expressions (regexp_replace, rlike,
regexp_extract, upper, ...), so they run inside whole-stage codegen on the
executors; nothing here is a UDF.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set of Python's ``str`` regexes (``\s`` with
# Unicode strings).  Java's ``\s`` is ASCII-only, so the class is spelled out:
# tab, newline, vertical tab, form feed, carriage return, space, the four
# information separators x1c-x1f, next-line x85, no-break space xa0, ogham
# space 1680, the spaces 2000-200a, line and paragraph separators 2028 2029,
# narrow no-break space 202f, medium math space 205f, ideographic space 3000.
WHITESPACE_CLASS = (
    r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# ``/* ... */`` across lines, non-greedy.
BLOCK_COMMENT = r"(?s)/\*.*?\*/"
# ``--`` to the end of its line.  ``(?d)`` makes ``\n`` the only line end, as
# in Python, so a ``\r`` or U+2028 inside the comment does not end it early.
LINE_COMMENT = r"(?dm)--.*$"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_sql_comments(text: Column | str, replacement: str = " ") -> Column:
    """Remove block comments, then line comments (comment markers inside
    string literals are not special: the reference does the same).

    The regexes only run on texts that contain a comment marker; the
    substring test is far cheaper than regex passes over a long text without
    comments."""
    src = col_(text)
    stripped = F.regexp_replace(F.regexp_replace(src, BLOCK_COMMENT, replacement), LINE_COMMENT, replacement)
    return F.when(src.contains("/*") | src.contains("--"), stripped).otherwise(src)


def collapse_whitespace(text: Column | str) -> Column:
    """Runs of whitespace to one space, then trimmed."""
    collapsed = F.regexp_replace(col_(text), WHITESPACE_CLASS + "+", " ")
    return F.trim(collapsed)


def normalize_definition(text: Column | str) -> Column:
    """Comment-, whitespace- and case-insensitive form of a definition.

    Two definitions with equal normal forms are "unchanged" in drift.
    """
    return F.upper(collapse_whitespace(strip_sql_comments(text, " ")))


def is_executable(text: Column | str) -> Column:
    """True when anything but comments and whitespace is left."""
    stripped = strip_sql_comments(text, "")
    return F.regexp_replace(stripped, WHITESPACE_CLASS + "+", "") != F.lit("")


def strip_surrounding_whitespace(text: Column | str) -> Column:
    """Trim every whitespace character (Spark's ``trim`` trims spaces only)."""
    return F.regexp_replace(col_(text), f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", "")


def count_char(text: Column | str, ch: str) -> Column:
    """Occurrences of one character."""
    t = col_(text)
    return F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))


def spark_identifier(name: str) -> str:
    """A backtick-quoted part of a name."""
    return "`" + name.replace("`", "``") + "`"


def spark_table(name: str) -> str:
    """A table name of one or more parts, each backtick-quoted; parts that are
    quoted already may hold dots."""
    parts = re.findall(r"`((?:[^`]|``)+)`|([^.`]+)", name)
    return ".".join(spark_identifier(quoted.replace("``", "`") or plain) for quoted, plain in parts)


def spark_string(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quote_identifier(name: Column | str) -> Column:
    """Bracket-quote an identifier, doubling any closing bracket."""
    return F.concat(F.lit("["), F.replace(col_(name), F.lit("]"), F.lit("]]")), F.lit("]"))


# Characters not allowed in Windows file names.
FORBIDDEN_FILENAME_CHARS = r'[<>:"/\\|?*]'


def sanitize_filename(name: Column | str) -> Column:
    """Forbidden characters to ``_``; trailing dots and spaces removed."""
    replaced = F.regexp_replace(col_(name), FORBIDDEN_FILENAME_CHARS, "_")
    return F.regexp_replace(replaced, r"[. ]+$", "")


def export_path(folder: Column | str, qualified_name: Column | str) -> Column:
    """``<folder>/<sanitized name>.sql``."""
    folder_col = F.lit(folder) if isinstance(folder, str) else folder
    return F.concat(folder_col, F.lit("/"), sanitize_filename(qualified_name), F.lit(".sql"))


# --------------------------------------------------------------------------
# Glob patterns (ignore lists)
# --------------------------------------------------------------------------

def comma_items(text: Column | str) -> Column:
    """The non-empty items of comma-separated text, trimmed, as an array."""
    return F.filter(F.transform(F.split(col_(text), ","), strip_surrounding_whitespace), lambda x: x != F.lit(""))


def split_patterns(values: Iterable[str] | str | None) -> list[str]:
    """A parameter of comma-separated patterns (one text or several) as a list."""
    texts = [values] if isinstance(values, str) else [str(v) for v in values or () if v is not None]
    return [item for item in map(str.strip, ",".join(texts).split(",")) if item]


# A run of stars, a question mark, or a bracket list with at least one character.
_GLOB_PART = re.compile(r"(?P<any>\*+)|(?P<one>\?)|\[(?P<no>!?)(?P<list>\][^\]]*|[^\]]+)\]")


def _java_quoted(literal: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", literal)


def glob_to_regex(pattern: str) -> str:
    """An anchored Java regex for a shell glob (``*``, ``?``, ``[seq]``,
    ``[!seq]``).  A bracket without its closing one stands for itself; a range
    that runs backwards matches nothing."""
    out, at = "", 0
    for part in _GLOB_PART.finditer(pattern):
        out += _java_quoted(pattern[at:part.start()])
        at = part.end()
        if part["list"] is None:
            out += ".*" if part["any"] else "."
            continue
        chars = re.sub(r"(.)-(.)", lambda m: m[0] if m[1] <= m[2] else "", part["list"], flags=re.S)
        chars = re.sub(r"([^\w\s-])", r"\\\1", chars)
        if chars:
            out += f"[{'^' if part['no'] else ''}{chars}]"
        else:
            out += "." if part["no"] else "(?!)"
    return "(?s)^" + out + _java_quoted(pattern[at:]) + r"\z"


def matches_any_glob(candidates: Sequence[Column], patterns: Sequence[str]) -> Column:
    """True when any candidate (already lower-cased) matches any pattern
    (lower-cased here)."""
    regexes = [glob_to_regex(p.lower()) for p in patterns]
    if not regexes or not candidates:
        return F.lit(False)
    combined = "|".join(f"(?:{r})" for r in regexes)
    cond = None
    for cand in candidates:
        m = F.coalesce(cand.rlike(combined), F.lit(False))
        cond = m if cond is None else (cond | m)
    return cond


# The parts of a glob: as _GLOB_PART, and the literal runs between them.
_GLOB_TOKEN = r"(?s)\*+|\?|\[!?(?:\][^\]]*|[^\]]+)\]|[^*?\[]+|\["
_GLOB_LIST = r"(?s)^\[(!?)(\][^\]]*|[^\]]+)\]$"


def glob_regexes(pattern: Column | str) -> Column:
    """:func:`glob_to_regex` of a column of globs."""
    def quoted(c: Column) -> Column:
        return F.regexp_replace(c, r"([^\w\s])", r"\\$1")

    def element(e: Column) -> Column:  # of a bracket list: one character, or a range that may run backwards
        low, high = F.substr(e, F.lit(1), F.lit(1)), F.substr(e, F.lit(3), F.lit(1))
        return F.when(F.length(e) == 1, quoted(e)).when(low <= high, F.concat(quoted(low), F.lit("-"), quoted(high))).otherwise("")

    def token(t: Column) -> Column:
        no, chars = F.regexp_extract(t, _GLOB_LIST, 1) == "!", F.regexp_extract(t, _GLOB_LIST, 2)
        body = F.array_join(F.transform(F.regexp_extract_all(chars, F.lit("(?s).-.|."), F.lit(0)), element), "")
        some = F.concat(F.lit("["), F.when(no, "^").otherwise(""), body, F.lit("]"))
        return (F.when(t.startswith("*"), ".*").when(t == "?", ".").when(chars == "", quoted(t))
                .when(body != "", some).when(no, ".").otherwise("(?!)"))

    tokens = F.regexp_extract_all(col_(pattern), F.lit(_GLOB_TOKEN), F.lit(0))
    return F.concat(F.lit("(?s)^"), F.array_join(F.transform(tokens, token), ""), F.lit(r"\z"))
