"""Display and heading functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space as Python's ``str.split`` sees it, for Java patterns.
SPACE = r"[\s\x1c-\x1f\x85   -     　]"
#: The same as a plain character set for ``btrim``.
SPACES = "".join(map(chr, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def collapse(text: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", " "))


def _cut(text: Column, n: int) -> Column:
    return F.concat(F.rtrim(F.substring(text, 1, n - 1)), F.lit("…"))


def snippet(text: Column, n: int = 110) -> Column:
    """One line of at most ``n`` characters; a cut one ends in an ellipsis."""
    line = collapse(text)
    return F.when(line == "", "(no text)").when(F.char_length(line) <= n, line).otherwise(_cut(line, n))


def label(text: Column, n: int = 64) -> Column:
    line = collapse(text)
    return F.when(F.char_length(line) <= n, line).otherwise(F.concat(F.substring(line, 1, n - 1), F.lit("…")))


def score_bar(value: Column, width: int = 14) -> Column:
    """Filled and empty cells for a score clamped to 0..1, rounded half to even."""
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value.cast("double")))
    filled = F.bround(clamped * width).cast("int")
    return F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(width) - filled))


def shown(text: Column, cap: int, rank: int = 1, full: bool = False) -> Column:
    """Article text cut at ``cap`` characters with a notice; no cap at 0 or with ``full``."""
    if full or cap <= 0:
        return text
    notice = f"\n\n…[truncated — run `show {rank} full` for the whole article]"
    return F.when(F.char_length(text) > cap, F.concat(F.substring(text, 1, cap), F.lit(notice))).otherwise(text)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]")


def first_line(text: Column, n: int = 96) -> Column:
    """The first non-blank line, stripped and cut at ``n`` characters."""
    found = F.filter(F.transform(_lines(text), strip), lambda s: s != "")
    return F.substring(F.coalesce(F.get(found, F.lit(0)), F.lit("")), 1, n)


def first_heading(text: Column) -> Column:
    """Text of the first line that starts with ``#`` and has any; else empty."""
    headings = F.filter(F.transform(_lines(text), strip), lambda s: s.startswith("#"))
    names = F.filter(F.transform(headings, lambda s: strip(F.regexp_replace(s, "^#+", ""))), lambda s: s != "")
    return F.coalesce(F.get(names, F.lit(0)), F.lit(""))


def first_h1(text: Column) -> Column:
    """Text of the first level-one heading line, or null."""
    found = F.filter(F.transform(_lines(text), strip), lambda s: s.rlike(f"^#{SPACE}"))
    return F.get(F.transform(found, lambda s: strip(F.substring(s, F.lit(2), F.char_length(s)))), F.lit(0))


def display_title(title: Column, content: Column, id_: Column) -> Column:
    """Stripped title, else the first heading, else the id."""
    return F.coalesce(F.nullif(strip(title), F.lit("")), F.nullif(first_heading(content), F.lit("")), id_)


def plausible(keywords: list[str], id_: Column, title: Column) -> Column:
    """The first keyword found in the lower-cased id and title, or null."""
    hay = F.lower(F.concat_ws(" ", id_, title))
    return F.coalesce(*[F.when(F.contains(hay, F.lit(k)), F.lit(k)) for k in keywords]) if keywords else F.lit(None).cast("string")
