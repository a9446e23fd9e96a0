"""From documents to numbered, embedded chunks; and rosters of committees."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import rosters
from ..functions.text import collapse, html_fragments, strip_nul, strip_record_noise, xml_text
from ..sources.landing import written

FORMATS = {"Formatted Text": "html", "Formatted XML": "xml", "PDF": "pdf"}


def decoded(content: Column) -> Column:
    return F.decode(content, "UTF-8")


def plain_text(c: Column) -> Column:
    return collapse(c)


def bill_xml_text(c: Column) -> Column:
    """The text under all <legis-body> elements. DTDs and entities of other files are not read: the parts are cut out as text."""
    return xml_text(c, "legis-body")


def record_text(c: Column) -> Column:
    """A page of the record: its text without page and time marks."""
    return strip_record_noise(html_fragments(c))


def extract(content: Column, fmt: Column) -> Column:
    """Text of a decoded document by its format label; unknown labels are plain text, PDF is null (see extract_with)."""
    kind = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in FORMATS.items() for x in kv]), fmt), F.lit("text"))
    html, xml = [F.when(kind == k, content) for k in ("html", "xml")]  # a reader gets the documents of its format alone
    return strip_nul(F.when(kind == "html", html_fragments(html)).when(kind == "xml", bill_xml_text(xml)).when(kind == "text", plain_text(content)))


def extract_record(content: Column, fmt: Column) -> Column:
    """struct(text, error): HTML only; a PDF needs extract_with, other formats are errors of their row."""
    return F.struct(
        F.when(fmt == "HTML", strip_nul(record_text(F.when(fmt == "HTML", content)))).alias("text"),
        F.when(~fmt.isin("HTML", "PDF") | fmt.isNull(), F.concat(F.lit("unsupported format: "), F.coalesce(fmt, F.lit("none")))).alias("error"),
    )


def _with_fields(rows: DataFrame, fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([*rows.schema.fields, *(T.StructField(n, t) for n, t in fields.items())])


def extract_with(rows: DataFrame, content: str, parse: Callable[[bytes], str], out: str = "text") -> DataFrame:
    """rows with the text that parse (a PDF reader, say) finds in binary content, and {out}_error: why there is none (null where nothing failed).

    A document that can't be read fails alone; null content gives a null text and no error. Give the kind before the colon of an error to errors.error_class.
    A batch is read document by document and given back in pieces, so that beside it no more than a piece is held."""
    names = rows.columns
    piece = 1 << 20  # bytes of contents and letters of texts, or one document

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, errors, start, held = [], [], 0, 0
            for i, x in enumerate(b.column(names.index(content))):
                x, text, error = x.as_py(), None, None
                try:
                    text = None if x is None else parse(x)
                except Exception as e:  # noqa: BLE001  a document that can't be read must not end the job
                    error = failure("parse", e)
                texts.append(text)
                errors.append(error)
                held += len(x or b"") + len(text or "")
                if held >= piece or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays([*b.slice(start, len(texts)).columns, pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=[*names, out, f"{out}_error"])
                    texts, errors, start, held = [], [], i + 1, 0

    return rows.mapInArrow(work, _with_fields(rows, {out: T.StringType(), f"{out}_error": T.StringType()}))


def failure(kind: str, e: Exception) -> str:
    """"kind: reason" of an exception; what timed out or lost its connection is of that kind."""
    kind = "timeout" if isinstance(e, TimeoutError) else "connection" if isinstance(e, ConnectionError) else "io" if isinstance(e, OSError) else kind
    return f"{kind}: {type(e).__name__} {e}".strip()


def failed_rows(rows: DataFrame, key: str, error: str) -> DataFrame:
    """(key, class, reason) of the rows that failed: what to try again and what not."""
    from ..functions.errors import error_class

    kind = F.substring_index(error, ":", 1)
    return rows.where(F.col(error).isNotNull()).select(key, error_class(kind).alias("class"), F.col(error).alias("reason"))


def chunks(text: Column, size: int) -> Column:
    """Pieces of `size` characters, each trimmed, blank ones left out; null for a null text. One pass over the text, whatever its length."""
    if size <= 0:
        raise ValueError("chunks need a positive size")
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.filter(F.transform(pieces, lambda p: F.trim(p)), lambda c: c != "")


def chunks_of_fragments(fragments: Column, size: int) -> Column:
    """Pieces of the fragments put together with a space between them, so that words at their edges don't fuse."""
    return chunks(F.array_join(fragments, " "), size)


class ContextTooLong(Exception):
    """An embedder raises it for a text over its context; it is passed on instead of giving nulls."""


def embed(rows: DataFrame, content: str, model: Callable[[list[str]], list[list[float]]] | None, dims: int, batch: int = 50, out: str = "embedding", error: str | None = None) -> DataFrame:
    """rows with a vector for each text: model is called with `batch` texts, of whatever documents they are, and with fewer only at the end of a
    partition. Blank texts get null, a failing batch gets nulls for all its texts, and so do vectors of other than dims numbers; with `error` a column of that name says why.
    Without a model all are null."""
    if model is None:
        out_rows = rows.withColumn(out, F.lit(None).cast("array<float>"))
        return out_rows if error is None else out_rows.withColumn(error, F.lit(None).cast("string"))
    names = rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []  # [rows, vectors, reasons, texts without an answer]
        waiting: list[tuple[list, int, str]] = []

        def call(some: list[tuple[list, int, str]]) -> None:
            reason, made = None, [None] * len(some)
            try:
                made = model([t for _, _, t in some])
            except ContextTooLong:
                raise
            except Exception as e:  # noqa: BLE001
                reason = failure("embedding", e)
            for (h, k, _), v in zip(some, made, strict=True):
                h[1][k] = v if v is not None and len(v) == dims else None
                h[2][k] = reason or (None if h[1][k] is not None else f"dims: not {dims} numbers")
                h[3] -= 1

        def answered() -> Iterator[pa.RecordBatch]:
            while held and not held[0][3]:
                b, vectors, reasons, _ = held.pop(0)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(vectors, pa.list_(pa.float32())), *([pa.array(reasons, pa.string())] if error else [])], names=[*names, out, *([error] if error else [])])

        for b in batches:
            texts = b.column(names.index(content)).to_pylist()
            held.append([b, [None] * len(texts), [None] * len(texts), 0])
            full = [(held[-1], k, t) for k, t in enumerate(texts) if t and t.strip()]
            held[-1][3] = len(full)
            waiting += full
            while len(waiting) >= batch:
                call(waiting[:batch])
                del waiting[:batch]
            yield from answered()
        if waiting:
            call(waiting)
        yield from answered()

    fields = {out: T.ArrayType(T.FloatType())} | ({error: T.StringType()} if error else {})
    return rows.mapInArrow(work, _with_fields(rows, fields))


def embed_in_full_batches(rows: DataFrame, content: str, model: Callable[[list[str]], list[list[float]]], dims: int, batch: int = 50, out: str = "embedding", error: str = "embedding_error", keep: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """rows with a vector for each text, as embed gives them, but with ceil(texts / batch) calls of the model, however the rows are dealt over partitions.

    A task calls the model with full batches alone and leaves the texts at its end, fewer than a batch, marked with its number (__task) and theirs (__inside). Only these are shuffled: they are numbered over
    all tasks, by a count for each and the sums of those before it, and a batch is so many numbers in a row. Both steps are worked out once, by `keep`, which writes rows and gives them back."""
    own = rows.columns
    fields = {out: T.ArrayType(T.FloatType()), error: T.StringType(), "__task": T.IntegerType(), "__inside": T.IntegerType()}

    def given(t: pa.Table, vectors: list, reasons: list, task: int | None = None) -> pa.Table:
        marks = ([None] * t.num_rows, [None] * t.num_rows) if task is None else ([task] * t.num_rows, range(t.num_rows))
        more = [pa.array(vectors, pa.list_(pa.float32())), pa.array(reasons, pa.string()), *(pa.array(m, pa.int32()) for m in marks)]
        return pa.Table.from_arrays([*(t.column(c) for c in own), *more], names=[*own, *fields]).combine_chunks()

    def without(t: pa.Table, task: int | None = None) -> pa.Table:
        return given(t, [None] * t.num_rows, [None] * t.num_rows, task)

    def asked(t: pa.Table) -> pa.Table:
        reason, made = None, [None] * t.num_rows
        try:
            made = model(t.column(content).to_pylist())
        except ContextTooLong:
            raise
        except Exception as e:  # noqa: BLE001  a batch that fails gives nulls
            reason = failure("embedding", e)
        vectors = [v if v is not None and len(v) == dims else None for v in made]
        return given(t, vectors, [reason or (None if v is not None else f"dims: not {dims} numbers") for v in vectors])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, piece = None, 10 * batch  # rows that are copied at a time
        for b in (b.slice(k, piece) for b in batches for k in range(0, b.num_rows, piece)):
            t = pa.Table.from_batches([b])
            full = pc.fill_null(pc.match_substring_regex(t.column(content), "[^ \\t\\n\\r\\f\\v]"), False)
            yield from without(t.filter(pc.invert(full))).to_batches()
            t = t.filter(full) if waiting is None else pa.concat_tables([waiting, t.filter(full)])
            end = t.num_rows // batch * batch
            for k in range(0, end, batch):
                yield from asked(t.slice(k, batch)).to_batches()
            waiting = t.take(pa.array(range(end, t.num_rows), pa.int64()))  # a copy, so that the batch isn't held
        if waiting is not None:
            yield from without(waiting, TaskContext.get().partitionId()).to_batches()

    first = keep(rows.mapInArrow(work, _with_fields(rows, fields)))
    left = first.where("__task IS NOT NULL").select(*own, "__task", "__inside")
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task
    starts = left.groupBy("__task").agg(F.count("*").alias("__n")).select("__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    dealt = left.join(F.broadcast(starts), "__task").select(*own, F.floor((F.col("__start") + F.col("__inside")) / batch).alias("__batch"))
    second = keep(dealt.groupBy("__batch").applyInArrow(asked, _with_fields(rows, fields)))
    return first.where("__task IS NULL").unionByName(second).select(*own, out, error)


def parse_rosters(listings: DataFrame, committees: list[str], states: list[str], key: str = "id", text: str = "text") -> DataFrame:
    """Assignments of all listings (key, text): key, committee, is_subcommittee, first_name, last_name, state, role. A listing is a page of a directory as printed, its blanks kept; each is read by
    itself (functions.rosters), in the task that holds it. A null or empty text, and one without a known heading, has none."""
    known, places, roles = {rosters.heading_key(c) for c in committees} - {""}, rosters.Phrases({s: s for s in states}), rosters.Phrases(rosters.ROLES)
    kind = T.StructType([listings.schema[key], *T._parse_datatype_string("committee string, is_subcommittee boolean, first_name string, last_name string, state string, role string").fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, e) for i, page in enumerate(b.column(1).to_pylist()) for e in rosters.assignments(page, known, places, roles)]
            types = [pa.string(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.string()]
            made = [pa.array([e[k] for _, e in found], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i for i, _ in found], pa.int64())), *made], names=kind.names)

    return listings.select(key, text).mapInArrow(work, kind)
