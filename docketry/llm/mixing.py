"""Mixing overlapping sources to target weights by min-cost flow.

Documents that belong to the same sources are alike to the mix, so they are summed by membership pattern, and the flow network is
small: each pattern offers its words once at no cost and again at a rising cost; arcs lead from a pattern to its sources, and from a
source to its quota. The cheapest flow repeats as little as possible. Documents are then selected by a seeded hash.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table, word_count


def share_out(sizes: dict[str | None, int], weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Targets of the sources: by code point, null last, they weigh `weights`, repeating, and share `share` times all words. None
    gets over `most` times its own words; the excess is shared again by weight."""
    order = [*sorted(s for s in sizes if s is not None), *([None] if None in sizes else [])]
    weight = {s: float(weights[k % len(weights)]) for k, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in out]
    return out


def max_flow(to: list[int], cap: list[int], out: list[list[int]], source: int, sink: int) -> int:
    """More flow from source to sink by Dinic's blocking flows, none of it taken back from the source's arcs. Arc e and its reverse e ^ 1 lie side by side; cap is changed in place."""
    pushed = 0
    while True:
        level = [-1] * len(out)
        level[source], line = 0, [source]
        for x in line:
            for e in out[x]:
                if cap[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    line.append(to[e])
        if level[sink] < 0:
            return pushed
        at = [0] * len(out)
        path: list[int] = []
        x = source
        while True:
            if x == sink:
                n = min(cap[e] for e in path)
                pushed += n
                for k, e in enumerate(path):
                    cap[e] -= n
                    cap[e ^ 1] += n
                cut = next(k for k, e in enumerate(path) if not cap[e])
                x = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[x] < len(out[x]):
                e = out[x][at[x]]
                if cap[e] > 0 and level[to[e]] == level[x] + 1:
                    break
                at[x] += 1
            if at[x] < len(out[x]):
                path.append(e)
                x = to[e]
            elif path:
                x = to[path.pop() ^ 1]
                at[x] += 1
            else:
                break


def route(patterns: dict[tuple, int], quotas: dict[str | None, int], most: int = 2) -> dict[tuple, dict]:
    """Words of each pattern (a tuple of sources) that go to each of its sources, by min-cost flow; each further copy of a pattern's words costs more.

    As costs lie on the source's arcs alone and rise with the copy, a cheapest maximum flow is a maximum flow of first copies, filled up to one
    of two copies, and so on: filling up takes nothing back from arcs that leave the source. Patterns of one source are summed in closed form by
    the same arcs, so the work grows with the memberships of the patterns."""
    names, kinds = {s: k for k, s in enumerate(quotas)}, list(patterns)
    first = 2 + len(kinds)
    to, cap, out = [], [], [[] for _ in range(first + len(names))]

    def arc(a: int, b: int, c: int) -> int:
        for x, y, n in ((a, b, c), (b, a, 0)):
            out[x].append(len(to))
            to.append(y)
            cap.append(n)
        return len(to) - 2

    copies = [arc(0, 2 + p, 0) for p in range(len(kinds))]
    given = [(kind, s, arc(2 + p, first + names[s], most * patterns[kind])) for p, kind in enumerate(kinds) for s in kind]
    for s, k in names.items():
        arc(first + k, 1, quotas[s])
    for _ in range(most):
        for p, kind in enumerate(kinds):
            cap[copies[p]] += patterns[kind]
        max_flow(to, cap, out, 0, 1)
    routed: dict[tuple, dict] = {}
    for kind, s, e in given:
        routed.setdefault(kind, {})[s] = cap[e ^ 1]
    return routed


def _cut(free: DataFrame, bins: int) -> DataFrame:
    """(pattern_, end_, run_) for free (pattern_, size_, draw_, gap_): the last draw up to which all of a pattern's documents fit its gap, and their words."""
    by = Window.partitionBy("pattern_").orderBy("bin_").rowsBetween(Window.unboundedPreceding, -1)
    inside = free.withColumns({"open_": F.col("gap_"), "low_": F.lit(0).cast("long"), "width_": F.lit(1 << 62).cast("long")})
    whole = where = None
    for _ in range(2):
        step = F.greatest(F.lit(1), F.expr(f"width_ div {bins}"))
        sums = inside.groupBy("pattern_", "open_", "low_", "width_", F.expr("(draw_ - low_) div " + f"greatest(1, width_ div {bins})").alias("bin_")).agg(F.sum("size_").alias("words_"))
        sums = stored(sums, "bins")
        if whole is None:
            whole = sums.groupBy("pattern_", "open_").agg(F.sum("words_").alias("run_")).where("run_ <= open_").select("pattern_", F.lit(1 << 62).cast("long").alias("end_"), "run_")
        sums = sums.withColumn("before_", F.coalesce(F.sum("words_").over(by), F.lit(0)))
        cut = sums.where((F.col("before_") <= F.col("open_")) & (F.col("before_") + F.col("words_") > F.col("open_")))
        # patterns are few, so this table is small
        where = stored(cut.select("pattern_", (F.col("open_") - F.col("before_")).alias("open_"), (F.col("low_") + F.col("bin_") * step).alias("low_"), step.alias("width_")), "cut")
        inside = free.join(F.broadcast(where), "pattern_").where((F.col("draw_") >= F.col("low_")) & (F.col("draw_") < F.col("low_") + F.col("width_")))
    run = Window.partitionBy("pattern_").orderBy("draw_").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = inside.withColumn("run_", F.sum("size_").over(run)).where("run_ <= open_").groupBy("pattern_").agg(F.max("draw_").alias("end_"), F.max("run_").alias("last_"))
    gaps = free.select("pattern_", "gap_").distinct()
    cut = where.join(last, "pattern_", "left").join(gaps, "pattern_").select("pattern_", F.coalesce("end_", F.col("low_") - 1).alias("end_"), (F.col("gap_") - F.col("open_") + F.coalesce("last_", F.lit(0))).alias("run_"))
    return stored(whole.unionByName(cut), "ends")


def select_words(docs: DataFrame, wanted: DataFrame, seed: int, bins: int = 4096) -> DataFrame:
    """docs (pattern_, size_, draw_) with taken_: whole copies of documents that come near wanted (pattern_, total_, words_).

    Every document gets the whole copies that all can have. One more copy goes to documents in the order of their draw (a seeded hash)
    until the rest is used up. Where the order is cut is found from sums by bins of the draw, and inside the one bin of the cut from sums
    by finer bins, so that only a 1/bins**2 part of a pattern is ever sorted. Then the largest document that still fits is taken. What is left open goes
    to those that are no larger than it, by the same cut, until none fits; two rounds halve what is open, so rounds are few.
    """
    plan = wanted.select("pattern_", "words_", F.when(F.col("total_") > 0, F.floor(F.col("words_") / F.col("total_"))).otherwise(F.lit(0)).alias("copies_"), (F.col("words_") - F.when(F.col("total_") > 0, F.floor(F.col("words_") / F.col("total_"))).otherwise(F.lit(0)) * F.col("total_")).alias("rest_"))
    # a text that stands in several rows has one draw; its rows are taken together or not at all
    several = docs.groupBy("pattern_", "draw_").agg(F.sum("size_").alias("unit_"), F.count("*").alias("n_")).where("n_ > 1").drop("n_")
    units = docs.join(stored(several, "several"), ["pattern_", "draw_"], "left").withColumn("unit_", F.coalesce("unit_", "size_"))
    light = stored(units.where("size_ > 0").select("pattern_", "draw_", "size_", "unit_"), "units")
    none = F.array().cast("array<struct<gap_:bigint,end_:bigint,pick_:bigint>>")
    gaps = stored(plan.select("pattern_", F.col("rest_").cast("long").alias("gap_"), none.alias("rounds_")), "gaps")
    taken = F.exists("rounds_", lambda r: ((F.col("unit_") <= r["gap_"]) & (F.col("draw_") <= r["end_"])) | F.coalesce(F.col("draw_") == r["pick_"], F.lit(False)))
    while True:
        free = light.join(F.broadcast(gaps), "pattern_").where((F.col("unit_") <= F.col("gap_")) & ~taken)
        ends = _cut(free.select("pattern_", "size_", "draw_", "gap_"), bins)
        if ends.isEmpty():
            break
        left = free.join(F.broadcast(ends), "pattern_").where((F.col("draw_") > F.col("end_")) & (F.col("unit_") <= F.col("gap_") - F.col("run_")))
        pick = left.groupBy("pattern_").agg(F.max(F.struct("unit_", "draw_")).alias("pick_"))
        gaps = gaps.join(F.broadcast(ends), "pattern_", "left").join(pick, "pattern_", "left")
        more = F.concat("rounds_", F.array(F.struct("gap_", "end_", F.col("pick_.draw_").alias("pick_"))))
        gaps = stored(gaps.select("pattern_", (F.col("gap_") - F.coalesce("run_", F.lit(0)) - F.coalesce("pick_.unit_", F.lit(0))).alias("gap_"), F.when(F.col("end_").isNotNull(), more).otherwise(F.col("rounds_")).alias("rounds_")), "gaps")
    out = units.join(F.broadcast(plan.select("pattern_", "copies_").join(gaps.select("pattern_", "rounds_"), "pattern_")), "pattern_", "left")
    return out.withColumn("taken_", (F.col("size_") * (F.coalesce("copies_", F.lit(0)) + F.coalesce(taken, F.lit(False)).cast("long"))).cast("long"))


def mix(docs: DataFrame, size: Column, sources: Column, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 11, most_patterns: int = 1_000_000) -> DataFrame:
    """Rows (row of docs as struct doc_, pattern_, size_, source_size_, target_, taken_).

    size is a long (null counts as 0), sources an array of names (null: the one source null). source_size_ and target_ are those of the
    first source of the document. A document takes part in all its sources; no document is taken more than `most` times.
    Ties cannot arise but among repeated rows, which share a draw and so a fate. An empty table gives no rows. The flow is solved on the driver, whose memory holds one
    number for each membership of a pattern (not of a document); more than most_patterns patterns raise ValueError before anything is collected.
    """
    names = F.array_sort(F.array_distinct(F.coalesce(sources, F.array(F.lit(None).cast("string")))))
    doc = F.struct(*[F.col(c) for c in docs.columns]) if docs.columns else F.struct(F.lit(1))
    key = F.xxhash64(F.lit(seed), doc)
    rows = docs.select(doc.alias("doc_"), F.to_json(names).alias("pattern_"), F.coalesce(size, F.lit(0)).cast("long").alias("size_"), F.shiftrightunsigned(key, 2).alias("draw_"))
    rows = stored(rows, "sized")
    sums = rows.groupBy("pattern_").agg(F.sum("size_").alias("total_")).limit(most_patterns + 1).collect()
    if len(sums) > most_patterns:
        raise ValueError(f"more than {most_patterns} membership patterns")
    spark = docs.sparkSession
    patterns = {tuple(json.loads(r["pattern_"])): r["total_"] for r in sums}
    sizes: dict[str | None, int] = {}
    for p, n in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    # documents in several sources count once in what there is to share out
    scale = sum(patterns.values()) / max(1, sum(sizes.values()))
    targets = share_out(sizes, weights, share * scale, most)
    flow = route(patterns, {s: round(t) for s, t in targets.items()}, most)
    schema = "pattern_ string, total_ long, words_ long, source_size_ long, target_ double"
    wanted = [(r["pattern_"], r["total_"], sum(flow.get(p, {}).values()), sizes[p[0]], float(targets[p[0]])) for r in sums for p in [tuple(json.loads(r["pattern_"]))]]
    wanted = spark.createDataFrame(wanted, schema)
    taken = select_words(rows, wanted.select("pattern_", "total_", "words_"), seed)
    return taken.join(F.broadcast(wanted.select("pattern_", "source_size_", "target_")), "pattern_", "left").select("doc_", "pattern_", "size_", "source_size_", "target_", "taken_")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    out = mix(docs, F.col("size"), F.array("source"))
    return out.select("doc_.doc_id", F.col("size_").alias("size"), F.col("source_size_").alias("source_size"), F.col("target_").alias("target"), F.col("taken_").alias("taken"))
