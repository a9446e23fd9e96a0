"""Readers of landed feeds: JSON pages and details, XML, texts, and tables.

Feeds are files that some fetcher has put down; all readers take explicit schemas, keep malformed records aside and never infer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import squeezed, strip_tags
from . import schemas


def pages(spark: SparkSession, path: str, schema: str, items: str) -> DataFrame:
    """Items of all pages of a list feed; a page without the list has none."""
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.select(F.inline(F.col(items)))


def details(spark: SparkSession, path: str, schema: str, envelope: str) -> DataFrame:
    """Detail records out of their envelope; files without one are dropped."""
    return spark.read.schema(schema).option("multiLine", True).json(path).where(F.col(envelope).isNotNull()).select(f"{envelope}.*")


def subjects(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(schemas.SUBJECTS).option("multiLine", True).json(path)
    return rows.select(F.inline("subjects.legislativeSubjects"))


def house_votes(spark: SparkSession, path: str) -> DataFrame:
    """House roll-call items: ids may be numbers or texts, the data address has two spellings, the chamber is House."""
    # names that differ in case alone can't stand in one schema, so one spelling is turned into the other first
    body = F.regexp_replace("value", r'"sourceDataUrl"\s*:', '"sourceDataURL":')
    rows = spark.read.text(path, wholetext=True).select(F.from_json(body, schemas.HOUSE_VOTE_ITEMS).alias("x"))
    return rows.select(F.inline("x.houseRollCallVotes")).withColumn("chamber", F.lit("House"))


def house_vote_members(spark: SparkSession, path: str) -> DataFrame:
    """Votes with their members; a page whose record is an empty list stands for a vote without members and gives no row."""
    rows = spark.read.text(path, wholetext=True)
    record = F.try_variant_get(F.try_parse_json("value"), "$.houseRollCallVoteMemberVotes", "variant")
    is_object = F.schema_of_variant(record).startswith("OBJECT")
    return rows.where(is_object).select(F.from_json(F.to_json(record), schemas.HOUSE_VOTE_MEMBERS).alias("v")).select("v.*")


def text_versions(spark: SparkSession, path: str, keys: DataFrame, key: str, key_of_file: Column) -> DataFrame:
    """(key, textVersions) for all keys; a key whose file is missing has an empty list. key_of_file finds the key in _metadata.file_path."""
    rows = spark.read.schema(schemas.TEXT_VERSIONS).option("multiLine", True).json(path)
    rows = rows.select(key_of_file.alias(key), "textVersions")
    return keys.select(key).join(rows, key, "left").withColumn("textVersions", F.coalesce("textVersions", F.array().cast(rows.schema["textVersions"].dataType)))


def xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").schema(schema).option("rowTag", row_tag).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").load(path)


def senate_votes(spark: SparkSession, path: str) -> DataFrame:
    """Senate roll-call votes with `valid`: congress, session, number and date are there and the file is well formed."""
    rows = xml(spark, path, "roll_call_vote", schemas.SENATE_VOTE)
    rows = rows.withColumn("vote_result", F.coalesce(squeezed(F.col("vote_result")), squeezed(F.col("result")))).drop("result")
    needed = F.lit(True)
    for c in ("congress", "session", "vote_number", "vote_date", "vote_result"):
        needed = needed & F.col(c).isNotNull()
    return rows.withColumn("valid", needed & F.col("_corrupt_record").isNull())


def senate_vote_list(spark: SparkSession, path: str) -> DataFrame:
    """Entries of the vote menu: those without a number are dropped, entries en bloc have "En Bloc" for a missing question or result."""
    rows = xml(spark, path, "vote", schemas.SENATE_MENU)
    bloc = F.when(F.col("en_bloc").isNotNull(), F.lit("En Bloc"))
    rows = rows.withColumns({"vote_number": F.col("vote_number").try_cast("int"), "question": F.coalesce(squeezed(F.col("question")), bloc), "result": F.coalesce(squeezed(F.col("result")), bloc)})
    return rows.dropna(subset=["vote_number", "vote_date", "question", "result"])


def senators(spark: SparkSession, path: str) -> DataFrame:
    """The senator register: lis_id, bioguide, names, party, state, service_class (the last given), congresses, is_current (some service without an end)."""
    rows = xml(spark, path, "senator", schemas.SENATOR_LOOKUP)
    services = F.coalesce("service_dates.service_date", F.array().cast(rows.schema["service_dates"].dataType["service_date"].dataType))
    return rows.select(
        squeezed(F.col("lisid")).alias("lis_id"), squeezed(F.col("bioguide")).alias("bioguide"), F.col("full_name.first_name").alias("first_name"), F.col("full_name.last_name").alias("last_name"), "party", "state",
        F.try_element_at(F.filter(F.transform(services, lambda s: s["_class"]), lambda c: c.isNotNull()), F.lit(-1)).alias("service_class"),
        F.filter(F.transform(F.coalesce("congresses.congress", F.array().cast("array<string>")), lambda c: F.trim(c).try_cast("int")), lambda c: c.isNotNull()).alias("congresses"),
        F.exists(services, lambda s: F.coalesce(F.trim(s["end_date"]["_year"]), F.lit("")) == "").alias("is_current"),
    ).dropna(subset=["lis_id", "bioguide", "last_name"])


def house_members(spark: SparkSession, path: str) -> DataFrame:
    """(bioguide, names, state, code, name, rank, side): a row for each committee or subcommittee seat."""
    rows = xml(spark, path, "member", schemas.HOUSE_MEMBER)
    seat = lambda code: lambda s: F.struct(F.coalesce(s[code], s["_code"]).alias("code"), s["_name"].alias("name"), s["_rank"].try_cast("int").alias("rank"), s["_side"].alias("side"))
    empty = F.array().cast("array<struct<code: string, name: string, rank: int, side: string>>")
    seats = F.concat(F.coalesce(F.transform("`committee-assignments`.committee", seat("_comcode")), empty), F.coalesce(F.transform("`committee-assignments`.subcommittee", seat("_subcomcode")), empty))
    info = "`member-info`"
    return rows.select(F.col(f"{info}.bioguideID").alias("bioguide"), F.col(f"{info}.firstname").alias("first_name"), F.col(f"{info}.lastname").alias("last_name"), F.col(f"{info}.state.`state-fullname`").alias("state"), F.inline(seats)).dropna(subset=["bioguide", "code"])


def senate_identities(spark: SparkSession, path: str) -> DataFrame:
    """(bioguide, lis_id, names, state, codes): ids as elements or attributes."""
    rows = xml(spark, path, "senator", schemas.SENATE_IDENTITY)
    codes = F.transform(F.coalesce("committees.committee", F.array().cast("array<struct<_code: string, _VALUE: string>>")), lambda c: F.coalesce(c["_code"], c["_VALUE"]))
    return rows.select(F.coalesce("bioguide_id", "_bioguide_id").alias("bioguide"), F.coalesce("lis_member_id", "_lis_member_id").alias("lis_id"), "first_name", "last_name", "party", "state", F.array_sort(F.array_distinct(codes)).alias("codes"))


def senate_rosters(spark: SparkSession, path: str) -> DataFrame:
    """(code, is_subcommittee, names, state, position): members of committees and their subcommittees. A body that is an HTML page means not found."""
    rows = spark.read.text(path, wholetext=True).where(~F.col("value").rlike(r"(?i)^\s*(?:<!doctype html|<html)"))
    parsed = rows.select(F.from_xml("value", schemas.SENATE_ROSTER).alias("x")).select("x.committees.*")
    member = lambda code, sub: (code, F.lit(sub).alias("is_subcommittee"), F.col("m.name.first").alias("first_name"), F.col("m.name.last").alias("last_name"), F.col("m.state").alias("state"), F.col("m.position").alias("position"))
    top = parsed.select(F.col("committee_code").alias("code"), F.explode("members.member").alias("m")).select(*member("code", False))
    below = parsed.select(F.explode("subcommittee").alias("s")).select(F.col("s.committee_code").alias("code"), F.explode("s.members.member").alias("m")).select(*member("code", True))
    return top.unionByName(below)


def listing_text(granules: DataFrame, *other: str) -> DataFrame:
    """(id, *other, text) of the granules (id, value) that are committee pages, tags and entities taken out."""
    return granules.where(F.col("id").contains("HOUSECOMMITTEES") | F.col("id").contains("SENATECOMMITTEES")).select("id", *other, strip_tags(F.col("value")).alias("text"))


def directory_listings(spark: SparkSession, path: str) -> DataFrame:
    """(id, text) of a directory's committee pages; a granule's id is the name of its file."""
    return listing_text(spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[A-Za-z]+)?$", 1).alias("id"), "value"))


def editions(packages: DataFrame, congress: int, date: str = "date_issued") -> DataFrame:
    """Directory editions of a congress's two years, latest first."""
    year = F.left(F.col(date), F.lit(4)).try_cast("int")
    first = 1789 + 2 * (congress - 1)
    return packages.where(year.between(first, first + 1)).orderBy(F.col(date).desc())


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of whole files as bytes."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def scan(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A table's columns; nothing else is read of its files."""
    return spark.read.parquet(path).select(*columns)


def congress_sessions(congresses: DataFrame, congress: str = "congress") -> DataFrame:
    """Each congress with its sessions 1 and 2."""
    return congresses.select(congress, F.explode(F.array(F.lit(1), F.lit(2))).alias("session"))


def events(rows: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(decoded payloads, undecodable rows) of JSON events."""
    parsed = rows.withColumn("_e", F.from_json(column, schema + ", _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}))
    good = F.coalesce(F.col("_e").isNotNull() & F.col("_e._bad").isNull(), F.lit(False))
    return parsed.where(good).select(*rows.columns, "_e.*").drop("_bad"), parsed.where(~good).select(*rows.columns)
