"""Shards as the leaves of a k-d tree over metadata: each node is cut at the weighted median along its widest dimension until leaves have the size wanted.

DataFrame functions only. All nodes of a level are cut together. The median is found from sums by bins of the dimension, then by finer bins inside the one bin that holds it,
until few rows are left to be put in order; so no node is ever sorted and no rows come to the driver, which holds one cut a node. Rows that are equal along a
dimension (a third may share a source) are ordered by a hash of their metadata and then by their number, so every node can be cut at any weight.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import stored, table

#: Bits of a dimension's grid and of the hash that orders rows of one cell.
GRID, TIE = 30, 32
#: Bits that one pass over the rows settles, and rows of a bin that are put in order instead.
STEP, FEW = 13, 20_000
_END = (1 << 63) - 1


@dataclass
class Node:
    """`leaves` leaves from leaf `first` on. A cut sends the rows after (key, number) along `dim` to the right."""

    first: int
    leaves: int
    dim: int = 0
    key: int = _END
    number: int = _END

    def children(self) -> list[Node]:
        left = self.leaves // 2
        return [self] if self.leaves < 2 else [Node(self.first, left), Node(self.first + left, self.leaves - left)]


def _listed(values: list[int], at: Column) -> Column:
    """values[at], with the list as a constant of the plan."""
    return F.get(F.lit(values).cast("array<long>"), at)


def _grid(rows: DataFrame, names: list[str]) -> list[Column]:
    """Each dimension on a grid of whole numbers over its whole range; null and what is no finite number come first.

    Strings count by the six bytes that follow what all of them begin with."""
    text = {n: isinstance(rows.schema[n].dataType, T.StringType) for n in names}

    def number(n: str) -> Column:
        x = F.col(n).cast("double")
        return F.when(F.abs(x) < float("inf"), x)

    ends = rows.agg(F.lit(0), *[f(F.col(n) if text[n] else number(n)) for n in names for f in (F.min, F.max)]).first()[1:]
    out = []
    for k, n in enumerate(names):
        low, high = ends[2 * k], ends[2 * k + 1]
        x = number(n)
        if text[n]:
            a, b = [(v or "").encode() for v in (low, high)]
            same = next((i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))
            bytes_ = F.conv(F.substring(F.concat(F.hex(F.encode(F.col(n), "UTF-8")), F.lit("0" * 12)), 2 * same + 1, 12), 16, 10)
            x = bytes_.cast("double")
            low, high = [float(int.from_bytes((v[same:] + bytes(6))[:6])) for v in (a, b)]
        if low is None or high is None or not high > low:
            out.append(F.when(x.isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long"))
        else:
            out.append(F.coalesce(1 + F.floor((x - low) / (high - low) * float((1 << GRID) - 2)), F.lit(0)).cast("long"))
    return out


def _cuts(rows: DataFrame, nodes: list[Node], n_dims: int) -> None:
    """Set the cut of each node with two leaves or more. rows have node, size, number and the keys k0, k1, ... along the dimensions."""
    stats = [f(f"k{d}").alias(f"{f.__name__}{d}") for d in range(n_dims) for f in (F.min, F.max)]
    seen = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("size"), *stats).collect()}
    goal, base, open_ = {}, {}, []
    for i, node in enumerate(nodes):
        if node.leaves > 1 and i in seen:
            r = seen[i]
            node.dim = max(range(n_dims), key=lambda d: ((r[f"max{d}"] >> TIE) - (r[f"min{d}"] >> TIE), -d))
            goal[i], base[i] = r["size"] * (node.leaves // 2) / node.leaves, 0
            open_.append(i)
    m = len(nodes)
    keys = F.array(*[F.col(f"k{d}") for d in range(n_dims)])
    at = rows.withColumn("key", F.get(keys, _listed([n.dim for n in nodes], F.col("node"))))
    # the open part of each node: keys from low on, of so many bits; then, among rows of one key, numbers
    for field, bits in (("key", GRID + TIE), ("number", 63)):
        low, left = dict.fromkeys(open_, 0), bits
        if field == "number":
            at = at.where(F.col("key") == _listed([nodes[i].key for i in range(m)], F.col("node")))
        while open_ and left > 0:
            left = max(0, left - STEP)
            part = at.where(_listed([int(i in low) for i in range(m)], F.col("node")) == 1)
            bin_ = F.shiftright(F.col(field) - _listed([low.get(i, 0) for i in range(m)], F.col("node")), left)
            width = STEP if left else bits - (bits // STEP) * STEP or STEP
            part = part.withColumn("bin", bin_).where((F.col("bin") >= 0) & (F.col("bin") < 1 << width))
            sums = part.groupBy("node", "bin").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
            upto = F.sum("size").over(Window.partitionBy("node").orderBy("bin")) + _listed([base.get(i, 0) for i in range(m)], F.col("node"))
            sums = sums.withColumn("upto", upto).where(F.col("upto") >= _listed_d([goal.get(i, 0.0) for i in range(m)], F.col("node")))
            held = {r["node"]: r["b"] for r in sums.groupBy("node").agg(F.min(F.struct("bin", "upto", "size", "n")).alias("b")).collect()}
            small = []
            for i in list(open_):
                if i not in held:  # nothing is left on the other side of the goal
                    open_.remove(i)
                    low.pop(i)
                    continue
                b = held[i]
                low[i] += b["bin"] << left
                base[i] = b["upto"] - b["size"]
                if b["n"] <= FEW:
                    small.append(i)
                    open_.remove(i)
                else:
                    setattr(nodes[i], field, low[i])
            if small:
                _order(at, field, nodes, small, low, left, base, goal)
                for i in small:
                    low.pop(i)
    # rows that are alike in key and number don't exist, so no node is left open


def _listed_d(values: list[float], at: Column) -> Column:
    return F.get(F.lit(values).cast("array<double>"), at)


def _order(at: DataFrame, field: str, nodes: list[Node], small: list[int], low: dict, left: int, base: dict, goal: dict) -> None:
    """Cut nodes of whose open part few rows are left: after the row, or before the first row, where the size so far is nearest to the goal."""
    m = len(nodes)
    start = _listed([low.get(i, 0) if i in small else _END for i in range(m)], F.col("node"))
    rest = at.where((F.col(field) >= start) & (F.shiftright(F.col(field) - start, left) == 0)).select("node", "key", "number", "size")
    upto = F.sum("size").over(Window.partitionBy("node").orderBy("key", "number").rowsBetween(Window.unboundedPreceding, 0))
    upto = upto + _listed([base.get(i, 0) for i in range(m)], F.col("node"))
    off = F.abs(upto - _listed_d([goal.get(i, 0.0) for i in range(m)], F.col("node")))
    best = rest.withColumn("off", off).groupBy("node").agg(F.min(F.struct("off", "key", "number")).alias("b"))
    for r in best.collect():
        i, b = r["node"], r["b"]
        if goal[i] - base[i] <= b["off"]:  # all of the open part to the right
            nodes[i].key, nodes[i].number = (low[i] - 1, _END) if field == "key" else (nodes[i].key, low[i] - 1)
        else:
            nodes[i].key, nodes[i].number = b["key"], b["number"]


def kd_tree(rows: DataFrame, dims: list[str], size: str, leaves: int | None = None, target: int | None = None, fixed: list[str] | None = None) -> DataFrame:
    """rows with shard (0 to leaves - 1, neighbours in the tree have neighbouring numbers) and slot (0, 1, ... in each shard, without gaps).

    dims are the columns to cut along, numbers or strings; of equally wide ones (as parts of their whole range) the first is cut. Shards have nearly equal sums of size: a cut misses its weight by half
    the size of one row at most. Without `leaves`, there are as many as the sum of sizes has targets. size is a column of whole numbers (null counts as 0).

    Null values, and such as are no finite number, come before all others. Ties along a dimension are ordered by a hash of the columns `fixed` (dims and size if none), so
    reruns agree; only rows that are alike in these may change places, by where they stand in the input. Repeated rows are rows of their own. An empty table gives no rows; with fewer rows than
    shards some shards are empty. Other columns pass, whatever their names, but for shard and slot, which are replaced.
    """
    row = F.struct(*[F.col(c) for c in rows.columns if c not in ("shard", "slot")])
    picked = [F.col(d).alias(f"d{k}") for k, d in enumerate(dims)]
    tie = F.shiftrightunsigned(F.xxhash64(*[F.col(c) for c in fixed or [*dims, size]]), 64 - TIE)
    full = rows.select(row.alias("row"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"), tie.alias("tie"), *picked)
    full = stored(full.withColumn("number", F.monotonically_increasing_id()), "numbered")
    grid = _grid(full, [f"d{k}" for k in range(len(dims))])
    keys = [(F.shiftleft(g, TIE) + F.col("tie")).alias(f"k{k}") for k, g in enumerate(grid)]
    narrow = full.select("size", "number", *keys)
    if leaves is None:
        leaves = max(1, -(-narrow.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // max(1, target or 1)))
    nodes, levels = [Node(0, leaves)], []
    while any(n.leaves > 1 for n in nodes):
        _cuts(narrow.withColumn("node", _child(levels, len(dims))), nodes, len(dims))
        levels.append(nodes)
        nodes = [c for n in nodes for c in n.children()]
    out = full.select("row", "tie", "number", *keys).withColumn("shard", _child(levels, len(dims)))
    return numbered(out).select("row.*", "shard", "slot")


def _child(levels: list[list[Node]], n_dims: int) -> Column:
    """The number, among the nodes below the last of these levels, of the node that holds a row. The tree is a constant; a row walks down it in one fold."""
    if not levels:
        return F.lit(0)
    keys = F.array(*[F.col(f"k{d}") for d in range(n_dims)])
    parts = []
    for nodes in levels:
        first = [sum(len(n.children()) for n in nodes[:i]) for i in range(len(nodes))]
        columns = {"first": first, "dim": [n.dim for n in nodes], "key": [n.key for n in nodes], "number": [n.number for n in nodes]}
        parts.append(F.struct(*[F.lit(v).cast("array<long>").alias(c) for c, v in columns.items()]))

    def down(node: Column, level: Column) -> Column:
        key, cut = F.get(keys, F.get(level["dim"], node)), F.get(level["key"], node)
        right = (key > cut) | ((key == cut) & (F.col("number") > F.get(level["number"], node)))
        return (F.get(level["first"], node) + right.cast("int")).cast("int")

    return F.aggregate(F.array(*parts), F.lit(0), down)


def numbered(rows: DataFrame, bucket_rows: int = 20_000) -> DataFrame:
    """rows (row, tie, number, shard) with slot: 0, 1, ... in each shard, by hash and then number.

    Rows are counted by shard and bucket of the hash; a bucket starts where the ones before it end, so no task orders a whole shard. Buckets that equal rows make large are dealt out by number."""
    counted = rows.groupBy("shard").count()
    total = counted.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    n_buckets = max(1, -(-total // bucket_rows))
    hot_rows = max(5 * bucket_rows, total // 10_000)  # so at most 10,000 buckets are hot
    bucket = F.floor(F.col("tie") * F.lit(n_buckets) / F.lit(float(1 << TIE))).cast("long")
    rows = rows.withColumn("bucket", bucket)
    hot = rows.groupBy("shard", "bucket").count().where(F.col("count") > hot_rows).select("shard", "bucket", F.lit(1).alias("hot"))
    rows = rows.join(F.broadcast(stored(hot, "hot")), ["shard", "bucket"], "left")
    rows = rows.withColumn("part", F.when(F.col("hot") == 1, F.pmod(F.xxhash64("number"), F.lit(10_000))).otherwise(F.lit(0)).cast("int"))
    before = Window.partitionBy("shard").orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "bucket", "part").count().withColumn("start", F.coalesce(F.sum("count").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket", "part").orderBy("tie", "number"))
    out = rows.withColumn("inside", inside).join(starts.drop("count"), ["shard", "bucket", "part"])
    return out.select("row", "shard", (F.col("start") + F.col("inside") - 1).alias("slot"))


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """A folder shard=k for each shard, in files of so many consecutive slots; a shard is written by as many tasks as it has files."""
    file = F.floor(F.col("slot") / rows_per_file)
    sharded.repartition("shard", file).sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("maxRecordsPerFile", rows_per_file).parquet(path)


def op12_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, by id, size, source and language. Null texts have size 1 and the checksum of nothing; equal texts go where their metadata does."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), "source", "lang")
    out = kd_tree(docs, ["doc_id", "size", "source", "lang"], "size", leaves=16, fixed=["doc_id", "text_crc32", "size", "source", "lang"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
