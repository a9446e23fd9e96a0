"""Language identification by fusing evidence with Bayes' rule.

Four witnesses speak for each document: its text (trigrams of bytes), the language that its markup declares, the suffix of its address,
and the language habits of its host. The last three are counted over the whole table by grouped aggregation; a host's habits are
smoothed towards those of its domain, and those towards the whole corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table, with_columns
from .site_style_tree import host_of

BITS = 16


#: What is no letter: numbers, addresses and marks look alike in all languages.
_no_letters = re.compile(r"[\W\d_]+").sub


def _trigrams(text: str) -> np.ndarray:
    b = np.frombuffer(f" {_no_letters(' ', text.lower())} ".encode(), np.uint8).astype(np.uint32)
    return ((b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BITS)).astype(np.int64)


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities of hashed trigrams: one row a trigram, one column a language."""

    languages: tuple[str, ...]
    table: np.ndarray
    trust: int = 60

    def scores(self, text: str | None) -> tuple[list[float], int]:
        """Log-likelihood of the text in each language, as if it had `trust` independent trigrams at most, and its trigrams with letters."""
        text = text or ""
        if not any(map(str.isalpha, text[:200])) and not any(map(str.isalpha, text)):
            return [0.0] * len(self.languages), 0
        t = _trigrams(text)
        mean = np.zeros(len(self.languages))
        for at in range(0, len(t), 1 << 16):
            mean += self.table[t[at : at + (1 << 16)]].sum(0, dtype=np.float64)
        mean /= len(t)
        return (mean * min(len(t), self.trust)).tolist(), len(t)


#: The outcome for a text in none of the model's languages: its trigrams are taken to be anything, evenly.
UNKNOWN = "und"
#: The share of trigrams that a language is granted to have from anywhere (names, codes, other languages), evenly.
STRANGE = 0.2


def train(docs: DataFrame, sample: int = 1_000, least: int = 5, most_languages: int = 200, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", trust: int = 60) -> TextModel:
    """Trigram frequencies of at most `sample` documents of each declared language (the smallest hashes of their ids), and UNKNOWN.

    All tasks count what lies in their part; counts are summed by (language, trigram), and the table of the model alone comes to the driver: at most
    most_languages times 65,536 numbers. Languages that fewer than `least` documents declare are left out, and those beyond the
    most_languages most frequent; their texts are UNKNOWN unless they look like another language. Rows that share an id and a language are one for the sample."""
    told = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(label_col).cast("string").alias("l"))
    sizes = told.groupBy("l").agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.col("n").desc(), "l").limit(most_languages)
    # about sample * 1.2 + 20 rows of a language lie under its cut of the hash; of those the first `sample` are taken
    place = F.xxhash64("i") / F.lit(float(1 << 64)) + 0.5
    near = told.join(F.broadcast(sizes), "l").select("i", "l", place.alias("h"), ((sample * 1.2 + 20) / F.col("n")).alias("cut")).where("h < cut").distinct()
    first = near.withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h", "i"))).where(F.col("k") <= sample).select("i", "l")
    rows = docs.select(F.col(id_col).alias("i"), F.col(label_col).cast("string").alias("l"), F.col(text_col).alias("t")).join(F.broadcast(first), ["i", "l"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums.setdefault(lang, np.zeros(1 << BITS, np.int64))
                sums[lang] += np.bincount(_trigrams(text), minlength=1 << BITS)
        for lang, c in sums.items():
            g = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g, pa.int32()), pa.array(c[g], pa.int64())], names=["l", "g", "n"])

    counts = rows.select("l", "t").mapInArrow(count, "l string, g int, n bigint").groupBy("l", "g").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(set(counts["l"]))
    cols = []
    for name in names:
        some = counts[counts["l"] == name]
        c = np.zeros(1 << BITS)
        c[some["g"].to_numpy()] = some["n"].to_numpy()
        cols.append(np.log((1 - STRANGE) * c / c.sum() + STRANGE / (1 << BITS)))
    if names:
        cols.append(np.full(1 << BITS, -BITS * np.log(2)))
        names.append(UNKNOWN)
    return TextModel(tuple(names), np.stack(cols, 1).astype(np.float32) if cols else np.zeros((1 << BITS, 0), np.float32), trust)


def address_suffix(url: Column) -> Column:
    """What an address says of its language: a two-letter first part of the path, else the last label of the host; '' if none."""
    path = F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://[^/?#]*/([a-zA-Z]{2})(?:[/?#-]|$)", 1))
    top = F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://[^/?#:]*\.([a-zA-Z]+)(?:[:/?#]|$)", 1))
    return F.coalesce(F.when(path != "", path).when(top != "", top), F.lit(""))


def domain(host: Column) -> Column:
    """The last two labels of a host; for a name without dots (a source's) what stands before its first digit or mark, so that src1 and src2 are of one kind."""
    return F.when(host.contains("."), F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1)).otherwise(F.regexp_extract(host, r"^([^\d_/:-]*)", 1))


def identify(docs: DataFrame, model: TextModel, text: Column, declared: Column, host: Column, url: Column | None = None, smooth: float = 20.0, broadcast_hosts: int = 100_000, salts: int = 64) -> DataFrame:
    """docs with language (string), posterior (double) and trigrams_ (int).

    Any witness may be null and then says nothing; a text without letters has no likelihood. A document about which nobody says
    anything gets the language of the corpus. Equal posteriors go to the first language by name. With no languages in the model, language
    is null and posterior 0. Repeated rows are judged each. Columns of docs named as new ones are replaced.
    """
    size = len(model.languages)
    names = F.array(*[F.lit(n) for n in model.languages]) if size else F.array().cast("array<string>")
    given = docs.sparkSession.sparkContext.broadcast(model)

    def work(columns):
        rows = [given.value.scores(t) for t in columns[0].to_pylist()]
        return [pa.array([s for s, _ in rows], pa.list_(pa.float64())), pa.array([n for _, n in rows], pa.int32())]

    rows = docs.withColumns({"__lid_text": text.cast("string"), "__lid_declared": F.coalesce(declared.cast("string"), F.lit("")), "__lid_host": F.coalesce(host.cast("string"), F.lit("")), "__lid_suffix": F.coalesce(address_suffix(url), F.lit("")) if url is not None else F.lit("")})
    rows = with_columns(rows, ["__lid_text"], "__lid_scores array<double>, trigrams_ int", work).drop("__lid_text")
    if not size:
        return rows.drop("__lid_declared", "__lid_host", "__lid_suffix", "__lid_scores").withColumns({"language": F.lit(None).cast("string"), "posterior": F.lit(0.0)})
    best = F.when(F.col("trigrams_") > 0, F.expr("array_position(__lid_scores, array_max(__lid_scores))").cast("int"))
    counts = stored(rows.select("__lid_declared", "__lid_host", "__lid_suffix", best.alias("k")).where("k is not null").groupBy("__lid_declared", "__lid_host", "__lid_suffix", "k").agg(F.count("*").alias("n")), "evidence")

    def tallies(by: list[str]) -> DataFrame:
        each = counts.groupBy(*by, "k").agg(F.sum("n").alias("n")).groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("m"))
        return each.withColumn("c", F.transform(F.sequence(F.lit(1), F.lit(size)), lambda k: F.coalesce(F.try_element_at("m", k), F.lit(0)).cast("double"))).drop("m")

    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    everywhere = [0.0] * size
    for r in counts.groupBy("k").agg(F.sum("n").alias("n")).collect():
        everywhere[r["k"] - 1] = float(r["n"])
    corpus = [(n + 1) / (sum(everywhere) + size) for n in everywhere]
    corpus_ = F.array(*[F.lit(p) for p in corpus])
    # P(language | host), smoothed by `smooth` documents of its domain, and the domain's by as many of the corpus
    toward = lambda c, prior: F.zip_with(c, prior, lambda n, p: n + smooth * p)
    normal = lambda c: F.transform(c, lambda x: x / total(c))
    hosts = tallies(["__lid_host"]).withColumn("domain_", domain(F.col("__lid_host")))
    domains = counts.withColumn("domain_", domain(F.col("__lid_host"))).groupBy("domain_", "k").agg(F.sum("n").alias("n")).groupBy("domain_").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("m"))
    domains = domains.select("domain_", normal(toward(F.transform(F.sequence(F.lit(1), F.lit(size)), lambda k: F.coalesce(F.try_element_at("m", k), F.lit(0)).cast("double")), corpus_)).alias("d"))
    hosts = stored(hosts.join(domains, "domain_").select("__lid_host", normal(toward(F.col("c"), F.col("d"))).alias("__lid_prior")), "hosts")

    def witness(by: str, out: str) -> DataFrame:
        """P(sign | language) for each sign; one unseen elsewhere has a share of a hundredth."""
        return tallies([by]).select(by, F.zip_with("c", F.array(*[F.lit(n) for n in everywhere]), lambda n, t: (n + 0.01) / (t + 1)).alias(out))

    def attach(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
        # by broadcast while the signs are few, else dealt over salts so that a frequent sign is no large task
        if right.limit(broadcast_hosts + 1).count() <= broadcast_hosts:
            return left.join(F.broadcast(right), by, "left")
        left = left.withColumn("__lid_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int"))
        return left.join(right.withColumn("__lid_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), [by, "__lid_salt"], "left").drop("__lid_salt")

    rows = attach(rows, hosts, "__lid_host")
    rows = attach(rows, stored(witness("__lid_declared", "__lid_said"), "declared"), "__lid_declared")
    if url is not None:
        rows = attach(rows, stored(witness("__lid_suffix", "__lid_hint"), "suffixes"), "__lid_suffix")
    logs = lambda c: F.transform(c, lambda x: F.log(x))
    add = lambda a, b: F.zip_with(a, F.coalesce(b, F.array_repeat(F.lit(0.0), size)), lambda x, y: x + y)
    joint = add("__lid_scores", logs(F.coalesce(F.col("__lid_prior"), corpus_)))
    joint = add(joint, F.when(F.col("__lid_declared") != "", logs("__lid_said")))
    if url is not None:
        joint = add(joint, F.when(F.col("__lid_suffix") != "", logs("__lid_hint")))
    rows = rows.withColumn("__lid_scores", joint)
    top = F.array_max("__lid_scores")
    share = F.lit(1.0) / total(F.transform("__lid_scores", lambda x: F.exp(x - F.array_max("__lid_scores"))))
    rows = rows.withColumns({"language": F.element_at(names, F.array_position("__lid_scores", top).cast("int")), "posterior": share})
    return rows.drop("__lid_declared", "__lid_host", "__lid_suffix", "__lid_scores", "__lid_prior", "__lid_said", "__lid_hint")


#: A document is accepted whose language has this posterior.
ACCEPT = 0.5


def accepted() -> Column:
    """Whether the language is known: it is one of the model's, its posterior is at least ACCEPT, and the text has letters."""
    return (F.col("trigrams_") > 0) & (F.col("posterior") >= ACCEPT) & (F.col("language") != UNKNOWN)


def of_documents(docs: DataFrame) -> DataFrame:
    """identify() over documents (doc_id, text, lang, source): lang is the declared language, source the host. Documents have no address, so its suffix
    is no witness here (see of_pages)."""
    return identify(docs, train(docs), F.col("text"), F.col("lang"), F.col("source"))


def of_pages(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with declared, language, posterior and trigrams_: all four witnesses speak. Markup declares a language in <html lang>, the
    address has a suffix, and its host a domain. The text is that of the whole page without scripts; the model is trained on what pages declare.

    Null or empty html has no text; a null or odd url no host and suffix. Pages that share a page_id are judged each."""
    lang = F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})", 1))
    bare = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>|&[#A-Za-z0-9]+;", " ")
    rows = pages.select("page_id", "url", bare.alias("text"), F.nullif(lang, F.lit("")).alias("declared"))
    model = train(rows, id_col="page_id", label_col="declared")
    return identify(rows, model, F.col("text"), F.col("declared"), host_of(F.col("url")), F.col("url")).drop("text")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = of_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return out.select("doc_id", F.col("lang").alias("declared"), "language", F.round("posterior", 4).alias("posterior"), accepted().alias("accepted"))


def op7_page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = of_pages(table(spark, sf_dir, "pages"))
    return out.select("page_id", "declared", "language", F.round("posterior", 4).alias("posterior"), accepted().alias("accepted"))
