"""Jobs of reference data: committees and who sits in them, now and in past congresses; ids of senators; summaries of bills. Each run is published as one version, and is worked out
again if another writer changed its rows meanwhile. All return what they counted, as one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, text
from ..operators import filters as fl
from ..operators import merge as mg
from ..operators import resolve as rs
from ..operators.rank import last_wins
from ..operators.summary import tally
from ..sources.landing import written
from ..sources.snapshots import Catalog
from ..streaming.incremental import outbox
from .ingest import _or_empty, again


def _upsert(spec: mg.MergeSpec):
    return lambda stored, new: new if stored is None else mg.merge(stored, new, spec)


def refresh_mappings(catalog: Catalog, senators: DataFrame, members: DataFrame, current: int, window: int, run: str, now) -> DataFrame:
    """Senators of the register (lis_id, bioguide, names, party, state, congresses, is_current) who serve now or did in the last `window` congresses: their rows of lis_members, and the mapping of
    those whose member is stored (members: bioguide). A mapping that is new sends an event; a senator without a member has none until there is one. Counts parsed, inserted, updated, unknown."""

    def run_once() -> DataFrame:
        base = catalog.version()
        seen = last_wins(senators.where(F.coalesce("is_current", F.lit(False)) | fl.any_in_window(F.col("congresses"), current, window)), ["lis_id"], "bioguide")
        stamp = F.lit(now).cast("timestamp").alias("last_verified")
        lis = seen.select("lis_id", *[F.nullif(F.col(c), F.lit("")).alias(c) for c in ("first_name", "last_name", "party", "state")], stamp)
        stored = _or_empty(catalog, "member_lis_mapping", seen.select("bioguide", "lis_id", stamp), base)
        known = seen.join(members.select("bioguide", F.lit(True).alias("_known")).distinct(), "bioguide", "left").join(stored.select("bioguide", "lis_id", F.lit(True).alias("_was")), ["bioguide", "lis_id"], "left")
        judged = written(known.select("bioguide", "lis_id", F.when(F.col("_known").isNull(), "unknown").when(F.col("_was").isNull(), "inserted").otherwise("updated").alias("result")))
        mapped = judged.where("result <> 'unknown'").select("bioguide", "lis_id", stamp)
        news = outbox(judged.where("result = 'inserted'"), "member.updated", "member_lis_mapping", run, ["bioguide"])
        upserts = {"lis_members": (lis, ["lis_id"], _upsert(mg.MergeSpec(("lis_id",)))), "member_lis_mapping": (mapped, ["bioguide", "lis_id"], _upsert(mg.MergeSpec(("bioguide", "lis_id"))))}
        catalog.commit({}, {"events": news}, upserts, base, judged=("member_lis_mapping",))
        return tally(judged, parsed=F.lit(True), **{r: F.col("result") == r for r in ("inserted", "updated", "unknown")})

    return again(run_once)


_SEAT = ("committee", "member_id", "congress")


def _seats(rows: DataFrame, congress) -> DataFrame:
    """Rows of committee_members: of several for one seat the last listed."""
    known = keys.role(F.col("role"))
    return last_wins(rows, ["committee", "member_id"], "position").select("committee", "member_id", congress.cast("int").alias("congress"), known.alias("role"), F.col("side").cast("string").alias("side"), F.col("rank").cast("int").alias("rank"))


def load_history(catalog: Catalog, assignments: DataFrame, served: DataFrame, committees: DataFrame) -> DataFrame:
    """Assignments of printed rosters (congress, committee, first_name, last_name, state, role) into committee_members.

    committees (code, name) are found by their name, without case and punctuation; served (member_id, congress, first_name, last_name, state, position) are the members of a congress, found by surname and state and
    then by first name or initial. Counts seen, upserted, no_committee and no_member; what isn't found is left out, a missing committee first."""

    def run_once() -> DataFrame:
        index = committees.groupBy(keys.name_key(F.col("name")).alias("_key")).agg(F.min("code").alias("code"))
        rows = assignments.withColumns({"row": F.monotonically_increasing_id(), "_key": keys.name_key(F.col("committee"))})
        rows = written(rows.join(index, "_key", "left").drop("_key"))
        # a congress has its own people: it is a part of what must be equal
        in_congress = lambda df: df.withColumn("_where", F.concat(F.col("congress").cast("string"), F.lit("|"), F.trim("state")))
        found = written(rs.resolve_fuzzy(in_congress(rows), in_congress(served), "last_name", "first_name", "_where", "member_id", "position", "row"))
        good = found.where("code IS NOT NULL AND member_id IS NOT NULL").select("congress", F.col("code").alias("committee"), "member_id", "role", F.lit(None).alias("side"), F.lit(None).alias("rank"), F.col("row").alias("position"))
        seats = last_wins(good, list(_SEAT), "position").select(*_SEAT, keys.role(F.col("role")).alias("role"), F.col("side").cast("string").alias("side"), F.col("rank").cast("int").alias("rank"))
        catalog.commit({}, upserts={"committee_members": (seats, list(_SEAT), _upsert(mg.MergeSpec(_SEAT)))})
        gone = F.col("code").isNull()
        return tally(found, seen=F.lit(True), upserted=~gone & F.col("member_id").isNotNull(), no_committee=gone, no_member=~gone & F.col("member_id").isNull())

    return again(run_once)


def refresh_committees(catalog: Catalog, committees: DataFrame, house: DataFrame, identities: DataFrame, rosters: DataFrame, members: DataFrame, congress: int, now) -> DataFrame:
    """Committees and their present members in one version.

    committees (code, name, chamber, parent_code) keep the parent that they have if none comes. house seats (bioguide, code, rank, side) and Senate rosters (code, first_name, last_name, state, position) are those of members that
    are stored (members: bioguide, member_id); a senator is known by the identity (bioguide, first_name, last_name, state) of that name and state, the last listed of several. A seat in a committee that
    isn't stored makes a placeholder with its code as name. Counts committees, placeholders, seats and unknown."""

    def run_once() -> DataFrame:
        stamp = F.lit(now).cast("timestamp").alias("updated_at")
        listed = last_wins(committees, ["code"], "name").select("code", "name", "chamber", "parent_code", F.lit(True).alias("is_current"), stamp)
        none = F.lit(None).cast("string")
        houses = house.select("bioguide", "code", none.alias("role"), "side", "rank", F.lit("House").alias("chamber"))
        named = rs.resolve_by_name(rosters.withColumn("_given", none), identities.withColumns({"_given": none, "_at": F.monotonically_increasing_id()}), "_given", "first_name", "last_name", "state", "bioguide", "_at")
        senate = named.select("bioguide", "code", F.col("position").alias("role"), none.alias("side"), F.lit(None).cast("int").alias("rank"), F.lit("Senate").alias("chamber"))
        seats = houses.unionByName(senate).join(members.select("bioguide", "member_id"), "bioguide", "left").withColumn("position", F.monotonically_increasing_id())
        seats = written(seats.select(F.col("code").alias("committee"), "member_id", "role", "side", "rank", "chamber", "position"))
        good = seats.where("member_id IS NOT NULL")
        stored = _or_empty(catalog, "committees", listed)
        lacking = good.groupBy(F.col("committee").alias("code")).agg(F.min("chamber").alias("chamber")).join(listed.select("code").unionByName(stored.select("code")), "code", "left_anti")
        holders = written(lacking.select("code", F.col("code").alias("name"), "chamber", none.alias("parent_code"), F.lit(True).alias("is_current"), stamp))
        upserts = {
            "committees": (listed.unionByName(holders), ["code"], _upsert(mg.MergeSpec(("code",), keep_if_null=("parent_code",)))),
            "committee_members": (_seats(good, F.lit(congress)), list(_SEAT), _upsert(mg.MergeSpec(_SEAT))),
        }
        catalog.commit({}, upserts=upserts)
        counts = tally(seats, seats=F.col("member_id").isNotNull(), unknown=F.col("member_id").isNull())
        return counts.withColumns({"committees": F.lit(listed.count()), "placeholders": F.lit(holders.count())})

    return again(run_once)


def store_summaries(catalog: Catalog, summaries: DataFrame, stages: DataFrame) -> DataFrame:
    """Summaries (bill_key, version_code, action_date, action_desc, text) as a feed gives them. stages (code, order) ranks the stages.

    Of a bill the summary of its furthest stage counts (of equals that of the later action date); without a bill, or with a stage that isn't ranked, it is left out. A bill that isn't stored gets a placeholder, its expected stage is raised if that is strictly further than the
    one that is stored, and its text, without tags and with white space collapsed, is stored for its stage; a summary without text has none. Counts bills, advanced, at_stage and written."""

    def run_once() -> DataFrame:
        base = catalog.version()
        ranked = summaries.where("bill_key IS NOT NULL").join(F.broadcast(stages.select(F.col("code").alias("version_code"), "order")), "version_code")
        best = F.max_by(F.struct("version_code", "order", "action_date", "action_desc", "text"), F.struct("order", "action_date", "text"))
        best = written(ranked.groupBy("bill_key").agg(best.alias("b")).select("bill_key", "b.*"))
        proposed = best.select("bill_key", F.col("version_code").alias("code"), "order")
        stored = _or_empty(catalog, "bills_stages", proposed, base)
        judged = written(proposed.join(stored.select("bill_key", F.col("order").alias("_was")), "bill_key", "left").select("*", (F.col("_was").isNull() | (F.col("order") > F.col("_was"))).alias("further")))
        texts = best.select("bill_key", "version_code", "action_date", "action_desc", text.squeezed(text.strip_tags(F.col("text"))).alias("text")).where("text IS NOT NULL")
        upserts = {
            "bills": (best.select("bill_key"), ["bill_key"], lambda s, n: n if s is None else mg.insert_absent(s, n, ["bill_key"])),
            "bills_stages": (judged.where("further").select("bill_key", "code", "order"), ["bill_key"], lambda s, n: n if s is None else mg.advance(s, n, "bill_key", "code", "order")),
            "bill_summaries": (texts, ["bill_key", "version_code"], _upsert(mg.MergeSpec(("bill_key", "version_code")))),
        }
        catalog.commit({}, upserts=upserts, base=base, judged=("bills_stages",))
        counts = tally(judged, bills=F.lit(True), advanced=F.col("further"), at_stage=~F.col("further"))
        return counts.withColumn("written", F.lit(texts.count()))

    return again(run_once)
