"""Text helpers as pure Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the white space that a JavaScript-style trim removes (trim() of Spark knows U+0020 only).
SPACE_CLASS = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

# The same characters one by one, for trimming without a regular expression.
SPACES = "\t\n\x0b\x0c\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wide_trim(c: Column | str) -> Column:
    """Strip every kind of Unicode blank from both ends."""
    return F.btrim(as_col(c), F.lit(SPACES))


def is_blank(c: Column | str) -> Column:
    """True for null, empty and white-space-only text; never null."""
    return F.coalesce(wide_trim(c) == "", F.lit(True))


def collapse_blanks(c: Column | str) -> Column:
    return wide_trim(F.regexp_replace(as_col(c), rf"{SPACE_CLASS}+", " "))


def drop_blanks(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), rf"{SPACE_CLASS}+", "")


def strip_tags(c: Column | str) -> Column:
    """Visible text of an HTML fragment: tags out, blanks collapsed."""
    return collapse_blanks(F.regexp_replace(as_col(c), "<[^>]+>", ""))


def blank_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(c != "", c)


def ascii_lower(c: Column | str) -> Column:
    """Lower case of ASCII letters only, as a SQLite LIKE folds them."""
    return F.translate(as_col(c), ASCII_UPPER, ASCII_LOWER)


def captured(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A regex group, null where the pattern doesn't match."""
    return blank_to_null(F.regexp_extract(as_col(c), pattern, group))
