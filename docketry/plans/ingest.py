"""Jobs: one run of a feed against a catalog, published as one version of all tables it touches."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import change as ch
from ..operators import merge as mg
from ..operators import resolve as rs
from ..operators import texts
from ..operators.summary import outcomes
from ..sources import chunks
from ..sources.landing import written
from ..sources.snapshots import Catalog, Conflict
from ..streaming.incremental import outbox


@dataclass(frozen=True)
class Record:
    """A kind of record: its table, keys, update date, how missing dates are read, and its children's tables with the columns that tell
    children of a parent apart. placeholder lists columns that a hydrated record has; owned the columns that this feed may change."""

    table: str
    keys: tuple[str, ...]
    date: str
    policy: str
    children: dict[str, tuple[str, ...]]
    values: tuple[str, ...] | None = None
    placeholder: tuple[str, ...] | None = None
    owned: tuple[str, ...] | None = None
    keep_if_null: tuple[str, ...] = ()
    #: Columns that the history of a child has; a child that isn't named keeps all.
    history: dict[str, tuple[str, ...]] = field(default_factory=dict)
    #: Child tables that are only appended to: the columns that tell entries apart, and those that an entry that is stored takes over.
    appended: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = field(default_factory=dict)
    #: The column whose chamber gives the earliest stage that a record has reached.
    floor: str | None = None


BILLS = Record("bills", ("bill_key",), "update_date", "bill", {"bill_cosponsors": ("member_key",), "bill_subjects": ("subject_name",)}, placeholder=("sponsor_key", "introduced_date", "latest_action_date", "update_date"), floor="origin_chamber")
MEMBERS = Record("members", ("bioguide",), "update_date", "member", {"member_terms": ("congress", "chamber")}, values=("first_name", "last_name", "current_party", "state", "district"), appended={"member_party_history": (("bioguide", "start_year", "party_name"), ("party_abbreviation",))})
AMENDMENTS = Record("amendments", ("amendment_key",), "update_date", "amendment", {})
VOTES = Record("votes", ("vote_key",), "update_date", "vote", {"vote_positions": ("chamber", "member_key")}, history={"vote_positions": ("member_key", "position", "party_at_vote", "state_at_vote")})


def _or_empty(catalog: Catalog, table: str, like: DataFrame, version: int | None = None) -> DataFrame:
    found = catalog.read(table, version)
    return like.limit(0) if found is None else found


def again(run, attempts: int = 5):
    """What run() returns; a run whose rows another writer changed meanwhile is worked out again from what is stored then."""
    for k in range(attempts):
        try:
            return run()
        except Conflict:
            if k + 1 == attempts:
                raise
    raise ValueError("attempts must be positive")


def ingest(catalog: Catalog, record: Record, incoming: DataFrame, children: dict[str, DataFrame], run: str, event: str | None = None, stages: DataFrame | None = None) -> DataFrame:
    """One run: classify, archive what will be overwritten, merge, replace the children of changed parents, append to those that are appended to, raise stages to their floor, queue
    events, and publish all as one version. Returns (change, n).

    incoming holds a row for each key. A vote whose positions didn't change is updated without touching them and sends no event. stages (code, order) ranks the stages of a record with a floor.
    Tables of records and children are dealt by key, and only the parts that a run touches are written; histories and events are appended. A run that is
    repeated finds everything unchanged and publishes nothing new; one that meets another writer of the same records is worked out again. Events that come twice are told by their ids
    (streaming.incremental.drain_once).
    """
    return again(lambda: _ingest(catalog, record, incoming, children, run, event, stages))


def _ingest(catalog: Catalog, record: Record, incoming: DataFrame, children: dict[str, DataFrame], run: str, event: str | None, stages: DataFrame | None) -> DataFrame:
    base = catalog.version()
    stored = _or_empty(catalog, record.table, incoming, base)
    k = list(record.keys)
    found = written(ch.classify(incoming, stored, k, record.date, record.policy, list(record.values) if record.values else None, list(record.placeholder) if record.placeholder else None))
    counted = [tuple(r) for r in outcomes(found, "change").collect()]  # four kinds of change at most
    kinds = {kind for kind, _ in counted} - {"Unchanged"}
    changed = found.where("change <> 'Unchanged'")
    over = changed.where("change <> 'New'")
    rows = changed.select(*incoming.columns)
    spec = mg.MergeSpec(record.keys, record.owned, record.keep_if_null)
    # where nothing changed no child is looked at, and where nothing is overwritten none that is stored
    replaced = {name: df if kinds else df.limit(0) for name, df in children.items() if name not in record.appended}
    upserts = {record.table: (rows, k, lambda s, new: new if s is None else mg.merge(s, new, spec))}
    before = lambda df: df if kinds - {"New"} else df.limit(0)
    old_children = {name: before(_or_empty(catalog, name, df, base)) for name, df in replaced.items()}
    touched = changed.select(*k, "change")
    if record.policy == "vote" and replaced and kinds - {"New"}:
        name = next(iter(replaced))
        replaced[name] = written(replaced[name].join(changed.select(*k), k, "left_semi"))
        diff = ch.keyed_diff(old_children[name].join(over.select(*k), k, "left_semi"), replaced[name].join(over.select(*k), k, "left_semi"), [*k, *record.children[name]])
        moved = over.join(diff.where("diff <> 'Same'").select(*k), k, "left_semi")
        touched = written(changed.where("change = 'New'").unionByName(moved).select(*k, "change"))
    for name, df in replaced.items():
        # the touched parents take their children along, so that a parent that has none now loses its old ones; a feed's children are worked out once for all that reads them
        new = written(touched.select(*k).join(df, k, "left"))
        own = [c for c in df.columns if c not in k]

        def renewed(s: DataFrame | None, n: DataFrame, own=own, df=df) -> DataFrame:
            real = n.where(F.coalesce(*[F.col(c).isNotNull() for c in own[:1]], F.lit(True)) if own else F.lit(True)).select(*df.columns)
            return real if s is None else mg.replace_children(s, real, k, touched)

        upserts[name] = (new, k, renewed)
    for name, (identity, touch) in record.appended.items():
        if name in children:
            mine = children[name].join(changed.select(*k), k, "left_semi")
            upserts[name] = (mine, k, lambda s, n, identity=identity, touch=touch: mg.append_or_touch(n.limit(0) if s is None else s, n, list(identity), list(touch)))
    if record.floor and stages is not None and record.floor in incoming.columns:
        reached = rows.select(*k, keys.stage_floor(F.col(record.floor)).alias("code")).join(F.broadcast(stages), "code").select(*k, "code", "order")
        upserts[f"{record.table}_stages"] = (reached, k, lambda s, n: n if s is None else mg.advance(s, n, k[0], "code", "order"))
    added = {}
    for name, df in mg.archive(before(stored), over, k, old_children, run, record.history, strict=True).items():
        added[f"{record.table}_history" if not name else f"{name}_history"] = df
    if event:
        added["events"] = outbox(touched, event, record.table, run, k)
    catalog.commit({}, added, upserts, base, judged=(record.table, *replaced))
    return catalog.spark.createDataFrame(counted, "change string, n long")


def check_texts(catalog: Catalog, table: str, key: str, candidates: DataFrame, offered: DataFrame, known: DataFrame, identity: list[str], run: str, now, event: str, checked: str = "last_check") -> DataFrame:
    """One run of a checker: candidates (key) are looked up in what is offered, an event is queued for each new version, and the records whose check didn't fail are stamped with
    `now` in the column `checked` of their table, all in one version. Returns (key, result, reason); a check that failed comes again with the next run."""
    results, fresh = ch.availability(candidates, offered, known, key, identity)
    news = outbox(fresh, event, table, run, [key, *identity])
    stamped = results.where("result <> 'Failed'").select(key, F.lit(now).cast("timestamp").alias(checked))
    upserts = {table: (stamped, [key], lambda s, n: n if s is None else mg.set_where(s, n, [key], {checked: lambda old, new: new}))}
    catalog.commit({}, {"events": news}, upserts)
    return results


def link_votes(votes: DataFrame, amendments: DataFrame) -> DataFrame:
    """votes (congress, chamber, roll_number, ...) with the amendment whose last action cites their roll, where only one does; such votes lose their
    bill. amendments: amendment_key, congress, amendment_type, number, latest_action_text."""
    chamber = keys.amendment_chamber(F.col("amendment_type"))
    acts = amendments.select("amendment_key", F.col("amendment_type").alias("_type"), F.col("number").alias("_number"), "congress", chamber.alias("chamber"), keys.roll_number(F.col("latest_action_text"), chamber).alias("roll_number")).dropna(subset=["chamber", "roll_number"])
    linked = rs.link_unique(acts, votes.select("vote_key", "congress", "chamber", "roll_number"), ["congress", "chamber", "roll_number"], "vote_key").select("vote_key", F.col("amendment_key").alias("_amendment"), "_type", "_number")
    hit = F.col("_amendment").isNotNull()
    new = {"amendment_key": F.col("_amendment"), "legislation_type": F.lit("AMENDMENT"), "amendment_type": F.col("_type"), "legislation_number": F.col("_number"), "bill_type": F.lit(None), "bill_key": F.lit(None)}
    out = votes.join(linked, "vote_key", "left")
    return out.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in votes.columns])


def store_texts(catalog: Catalog, documents: DataFrame, run: str, chunk_size: int = 20_000, model=None, dims: int = 1024, newest_wins: bool = False, event: str = "text.stored") -> DataFrame:
    """Texts of document versions into chunks with vectors. Returns (version_key, outcome, reason): Stored, Skipped or Failed.

    documents: version_key, document_key, version_date, format, content (decoded); they are read twice, first without format and content. In a first version of the catalog the versions to be fetched are pending, and their document's latest text is
    theirs; with newest_wins a version that is stored is fetched again only if what comes is of a later date, and the link moves only to a date that isn't before that of the version it shows.
    In a second one the chunks are appended, those that they replace are dead, and the version is complete. Only a version all of whose chunks have vectors is complete; what fails leaves nothing alive but
    its pending row (chunks of it that were made in a run that completed others are dead) and comes again with the next run. Contents are shuffled once and written once, as the files that the version adds to the chunks. Complete versions are skipped, and their event is sent again, as the run before may have been lost before it was delivered.
    """
    order = F.struct("version_date", "document_key")  # keys alone are judged first, so that contents are shuffled once, and only those that are wanted
    fresh = written(documents.groupBy("version_key").agg(F.max(order).alias("_last")).select("version_key", "_last.document_key", "_last.version_date"))
    wanted = again(lambda: _pending(catalog, fresh, newest_wins))
    open_ = wanted.where("wanted").select("version_key")
    some = documents.select("version_key", "document_key", "version_date", "format", "content").join(open_, "version_key", "left_semi").groupBy("version_key")
    last = some.agg(F.max_by(F.struct("document_key", "version_date", "format", "content"), order).alias("_r")).select("version_key", "_r.*")
    text = last.select("version_key", "document_key", texts.extract(F.col("content"), F.col("format")).alias("text"))
    # a row without a chunk comes first and says how long the text is, so that contents are written once, where readers will find them
    pieces = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(texts.chunks(F.col("text"), chunk_size), F.array().cast("array<string>")))
    rows = text.select("version_key", "document_key", F.length("text").cast("long").alias("text_length"), pieces.alias("pieces"))
    rows = rows.select("version_key", "document_key", "text_length", F.posexplode_outer("pieces").alias("_n", "content"))  # never empty; but posexplode would work everything out twice, to filter by size first
    head, batch, staged = F.col("_n") == 0, uuid.uuid4().hex, []
    rows = rows.select("version_key", "document_key", F.when(~head, F.col("_n") - 1).alias("chunk_index"), "content", F.lit(batch).alias("batch"), (F.monotonically_increasing_id() + 1).alias("row"), F.when(head, F.col("text_length")).alias("text_length"))

    def keep(df: DataFrame) -> DataFrame:
        """Rows in a new folder of the chunks, those with a vector in one of its own; the contents of a batch that failed are not wanted again."""
        staged.append(catalog.folder(chunks.CHUNKS))
        failed = F.col("failed").isNotNull()
        made = F.col("chunk_index").isNotNull() & ~failed
        out = df.withColumns({"content": F.when(~failed, F.col("content")), "made": (made & F.col("__task").isNull()) if "__task" in df.columns else made})
        out.write.partitionBy("made").parquet(staged[-1])
        return catalog.spark.read.schema(out.schema).parquet(staged[-1])

    if model is None:
        rows = keep(texts.embed(rows, "content", None, dims, error="failed"))
    else:
        rows = texts.embed_in_full_batches(rows, "content", model, dims, error="failed", keep=keep)
    lost = rows.where("failed IS NOT NULL").groupBy("version_key").agg(F.min("failed").alias("failed"))
    judged = rows.where("chunk_index IS NULL").select("version_key", "document_key", "text_length").join(lost, "version_key", "left")
    reason = F.when(F.col("text_length").isNull(), "no text").otherwise(F.col("failed"))
    judged = written(judged.select("version_key", "document_key", "text_length", reason.alias("reason")))
    # of versions that failed, which are few as a rule, the chunks with vectors are dead from the start
    waste = rows.where("chunk_index IS NOT NULL AND failed IS NULL").select("version_key", "batch", "row").join(judged.where("reason IS NOT NULL").select("version_key"), "version_key", "left_semi")
    folders = [f"{p}/made=true" for p in staged if "made=true" in catalog.log.files.names(p)]
    again(lambda: _complete(catalog, judged.where("reason IS NULL"), batch, rows, folders, waste, wanted.where("NOT wanted"), run, event))
    result = judged.select("version_key", F.when(F.col("reason").isNull(), "Stored").otherwise("Failed").alias("outcome"), "reason")
    return result.unionByName(wanted.where("NOT wanted").select("version_key", F.lit("Skipped").alias("outcome"), F.lit("already-processed").alias("reason")))


def _pending(catalog: Catalog, fresh: DataFrame, newest_wins: bool) -> DataFrame:
    """Make the rows of versions to be fetched, and the links to them. Returns (version_key, document_key, wanted)."""
    base = catalog.version()
    keys_ = fresh.select("version_key", "document_key", "version_date")
    none = {"fetched_in": "string", "text_length": "long", "batch": "string"}
    new = keys_.select("*", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    stored = _or_empty(catalog, "text_versions", new, base)
    known = keys_.join(stored.select("version_key", F.col("version_date").alias("_date"), "fetched_in", F.lit(True).alias("_was")), "version_key", "left")
    later = F.coalesce(F.col("version_date") > F.col("_date"), F.lit(False)) if newest_wins else F.lit(False)
    known = written(known.select("version_key", "document_key", "version_date", (F.col("fetched_in").isNull() | later).alias("wanted"), F.coalesce("_was", F.lit(False)).alias("was"), later.alias("later")))
    # a version that was pending stays as it is, but for one of a later date; the batch of the chunks that it has stays until they are replaced
    rows = known.where("NOT was OR later").join(new.drop("document_key", "version_date"), "version_key").select("version_key", "document_key", "version_date", "fetched_in", "text_length", "batch")
    spec = mg.MergeSpec(("version_key",), ("document_key", "version_date", "fetched_in", "text_length"))
    first = F.max_by(F.struct("version_key", "version_date"), F.struct("version_date", "version_key"))
    links = known.where("wanted").groupBy("document_key").agg(first.alias("l")).select("document_key", "l.version_key", "l.version_date")
    newer = (lambda s, i: s("version_date").isNull() | (i("version_date") >= s("version_date"))) if newest_wins else None
    linked = lambda s, n: n if s is None else mg.merge(s, n, mg.MergeSpec(("document_key",), guard=newer))
    upserts = {"text_versions": (rows, ["version_key"], lambda s, n: n if s is None else mg.merge(s, n, spec)), "text_latest": (links, ["document_key"], linked)}
    catalog.commit({}, upserts=upserts, base=base, judged=("text_versions",))
    return known.select("version_key", "document_key", "wanted")


def _complete(catalog: Catalog, done: DataFrame, batch: str, rows: DataFrame, folders: list[str], waste: DataFrame, skipped: DataFrame, run: str, event: str) -> None:
    """Append the chunks of a batch (rows; those with vectors are in `folders`), mark `waste` and those that they replace dead, complete what is done, and queue events, in one version."""
    base = catalog.version()
    news = outbox(done.select("version_key", "document_key").unionByName(skipped.select("version_key", "document_key")), event, "text_versions", run, ["version_key", "document_key"])
    folders = [] if done.isEmpty() else folders
    dead = waste.select("batch", "row") if folders else waste.select("batch", "row").limit(0)
    added = {"events": news, chunks.CHUNKS: folders or rows.select(*[c for c in rows.columns if c not in ("made", *chunks.TOLD)]).limit(0)}
    replaced = _or_empty(catalog, "text_versions", done, base).join(done.select("version_key"), "version_key", "left_semi").where("batch IS NOT NULL").select("version_key", "batch")
    old = chunks.live(catalog, base, replaced.select("batch").distinct())
    if old is not None:
        dead = dead.unionByName(old.join(replaced, ["version_key", "batch"], "left_semi").select("batch", "row"))
    added[chunks.DEAD] = chunks.dead_rows(dead)
    ends = done.select("version_key", F.lit(run).alias("fetched_in"), "text_length", F.lit(batch).alias("batch"))
    spec = mg.MergeSpec(("version_key",), ("fetched_in", "text_length", "batch"))
    catalog.commit({}, added, {"text_versions": (ends, ["version_key"], lambda s, n: n if s is None else mg.merge(s, n, spec))}, base, judged=("text_versions",))
