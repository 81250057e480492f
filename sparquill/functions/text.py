"""Text expressions. All are columns of built-in functions; none is a UDF."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters, digits and underscore of any script.
TOKEN = r"[\p{L}\p{N}_]+"


def strip(text: Column) -> Column:
    """Without white space at both ends, line ends and tabs included."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    """Runs of blanks become one, runs of line ends with blank lines one line end; stripped."""
    return strip(F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n\s*\n+", "\n"))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def hits(text: Column, terms: Iterable[str]) -> Column:
    """How many of the terms a text holds as substrings."""
    return reduce(lambda a, b: a + b, (F.contains(text, F.lit(t)).cast("int") for t in terms), F.lit(0))


def holds_any(text: Column, terms: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(t)) for t in terms), F.lit(False))


def first_held(text: Column, terms: Iterable[str]) -> Column:
    """The first of the terms, in their order, that a text holds; else null."""
    terms = list(terms)
    return F.coalesce(*[F.when(F.contains(text, F.lit(t)), F.lit(t)) for t in terms]) if terms else F.lit(None).cast("string")


def preview(text: Column, length: int = 200) -> Column:
    """The text, cut with three full stops after it if longer than length."""
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)


def without_first(text: Column, part: Column) -> Column:
    """The text without the first occurrence of part."""
    at = F.instr(text, part)
    cut = F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + F.length(part), F.length(text)))
    return F.when((at > 0) & (F.length(part) > 0), cut).otherwise(text)


def before(text: Column, part: Column, length: int = 100) -> Column:
    """Up to length characters before the first occurrence of part; empty where there is none."""
    at = F.instr(text, part)
    start = F.greatest(F.lit(1), at - length)
    return F.when(at > 0, F.substring(text, start, at - start)).otherwise("")


def number(text: Column) -> Column:
    """A number written with blanks between thousands and a decimal comma; null if it is none."""
    return F.translate(text, ", ", ".").try_cast("double")


def section_parts(raw: Column) -> tuple[Column, Column, Column]:
    """(id, number, suffix) of a section such as '12 a §': '12a', 12, 'a'. What does not parse keeps its text, number 0."""
    bare = F.regexp_replace(raw, r"[\s§]+", "")
    digits, suffix = F.regexp_extract(bare, r"^(\d+)([a-zA-Z]*)$", 1), F.lower(F.regexp_extract(bare, r"^(\d+)([a-zA-Z]*)$", 2))
    return F.when(digits == "", bare).otherwise(F.concat(digits, suffix)), F.when(digits == "", 0).otherwise(digits.try_cast("int")), F.nullif(suffix, F.lit(""))


def chapter_id(raw: Column) -> Column:
    """'7 a luku' gives '7a'; a letter right after the number's blanks counts as suffix, so '6 luku' gives '6l'."""
    found = r"(\d+)\s*([a-z]?)"
    return F.concat(F.regexp_extract(F.lower(raw), found, 1), F.regexp_extract(F.lower(raw), found, 2))


def node_id(*parts: Column) -> Column:
    """Parts joined by colons; empty and null parts are left out."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), ":")
