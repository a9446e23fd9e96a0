"""Arrays: vectors in text form and small predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_to_text(v: Column) -> Column:
    """[a,b,...]"""
    return F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: x.cast("string")), ","), F.lit("]"))


def vector_from_text(c: Column) -> Column:
    """The floats of [a,b,...]; none for []."""
    inner = F.trim(F.regexp_replace(c, r"^\s*\[|\]\s*$", ""))
    return F.when(inner == "", F.array().cast("array<float>")).otherwise(F.transform(F.split(inner, ","), lambda x: F.trim(x).cast("float")))


def has_dims(v: Column, dims: int) -> Column:
    return F.coalesce(F.size(v) == dims, F.lit(False))


def still_serving(ends: Column) -> Column:
    """Whether some end of service is blank."""
    return F.exists(ends, lambda e: F.coalesce(F.trim(e), F.lit("")) == "")


def parsed_numbers(items: Column) -> Column:
    """The integers among the items."""
    return F.filter(F.transform(items, lambda x: F.trim(x).try_cast("int")), lambda x: x.isNotNull())


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where a vector is null or zero."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.try_divide(dot, norm(a) * norm(b))


def first_sponsor(sponsors: Column) -> Column:
    """struct(kind, key, url) of the first sponsor: a member with an id, else a committee known by its address; null without sponsors."""
    s = F.try_element_at(sponsors, F.lit(1))
    kind = F.when(s["bioguideId"].isNotNull(), F.lit("Member")).when(s["url"].isNotNull(), F.lit("Committee"))
    return F.when(s.isNotNull(), F.struct(kind.alias("kind"), s["bioguideId"].alias("key"), s["url"].alias("url")))
