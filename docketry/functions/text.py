"""Cleaning of texts, as columns."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import markup


def collapse(c: Column) -> Column:
    """Runs of white space become one space; ends are not trimmed."""
    return F.regexp_replace(c, r"\s+", " ")


def strip_nul(c: Column) -> Column:
    return F.translate(c, "\x00", "")


def strip_record_noise(c: Column) -> Column:
    """Without what a printed record carries besides its text: marks in brackets that give a time or a page ("[Time: 10:30]", "[[Page S52]]"),
    and page numbers in the text ("Pg S5255", "Page H12-3"); see markup.record_text."""
    return _each(markup.record_text)(c)


def strip_tags(c: Column) -> Column:
    """Tags become spaces, entities go."""
    return F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", " "), r"&[#A-Za-z0-9]+;", " ")


def squeezed(c: Column) -> Column:
    """Trimmed and collapsed; null if nothing is left."""
    return F.nullif(F.trim(collapse(c)), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def shorten(c: Column, n: int = 200) -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("..."))).otherwise(c)


def html_fragments(c: Column, without: tuple[str, ...] = ("script", "style"), bare: bool = True) -> Column:
    """The text of the body of an HTML page, one space between fragments, references decoded, those without a semicolon only if `bare`. Elements `without` are left out with all in them; broken markup is read as far as it goes. See markup.html_text."""
    left_out = frozenset(without)
    return _each(lambda page: markup.html_text(page, left_out, bare))(c)


def xml_text(c: Column, element: str) -> Column:
    """The text in all elements of a name, white space collapsed: references decoded, CDATA sections as they are, comments left out. DTDs and other files are not read."""
    return _each(lambda doc: markup.xml_text(doc, element))(c)


def _each(read: Callable[[str | None], str | None]) -> Callable[[Column], Column]:
    """A reader of one text as a function of columns, in Arrow batches."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array((read(t.as_py()) for t in texts), pa.string())

    return run
