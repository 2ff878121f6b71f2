"""K-d tree sharding: split at weighted medians along the widest metadata dimension, until leaves are small.

Every row becomes a point of whole numbers, one per dimension: the value in the high bits and the row's own
tie-breaker in the low bits, so that a third of all rows with one source, size or text can still be cut.
Texts take no part beyond the first scan. A point carries its node, named by the node's first leaf and its
number of leaves; a level of the tree is a table with one row per node, joined to the points by adaptive
planning (few nodes: broadcast after a check of their size; many: a node is a small share of the rows).
Per level a small aggregation finds the extent of every node, then counts of bytes per bin of the node's widest
dimension are narrowed until the median is met within ``TOLERANCE`` of the node's bytes. Extents, bins and cuts
stay in Spark; the driver sees the extent of the root and whether a node is still open. Levels go with the
logarithm of the leaves, looks per level are at most seven.

A node of k leaves gives floor(k/2) : k - floor(k/2) of its bytes to its sides, so all leaves get the same
share whatever their number.

Defined results: a null text has no bytes and weighs 16; null dimensions are the lowest value; null or
repeated keys are placed like others; an empty table gives an empty result; with more leaves than rows some
leaves stay empty. Slots are gapless from 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import fresh, written

ROW_BYTES = 16
BINS = 1024
TOLERANCE = 0.0005
CHUNK_ROWS = 50_000
LOW_BITS = 32


def coordinate(df: DataFrame, name: str) -> Column:
    """A value as a whole number from 0 to 2^30: numbers by size, other values by their checksum."""
    kind = dict(df.dtypes)[name]
    col = F.col(f"`{name}`")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        value = F.greatest(F.least(col.cast("bigint"), F.lit((1 << 30) - 2)), F.lit(0)) + 1
    else:
        value = F.shiftright(F.crc32(col.cast("string").cast("binary")), 2) + 1
    return F.coalesce(value, F.lit(0)).cast("bigint")


def points(docs: DataFrame, dimensions: list[str], key: str, text: str) -> DataFrame:
    """Key, size, checksum, coordinates and node (the root) of every row, written once."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    tie = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
        tie.alias("tie"),
        F.least(F.octet_length(body), F.lit((1 << 30) - 1)).cast("bigint").alias("v0"),
        *[coordinate(docs, d).alias(f"v{i}") for i, d in enumerate(dimensions, 1)],
    )
    at = [(F.shiftleft(f"v{i}", LOW_BITS) + F.col("tie")).alias(f"d{i}") for i in range(len(dimensions) + 1)]
    root = F.lit(0).cast("bigint").alias("node")
    return written(rows.select("key", "size", "text_crc32", "tie", *at, root), "points")


def _extents(rows: DataFrame, dimensions: int, widths: list[float]) -> DataFrame:
    """One row per node that is to be cut: its widest dimension, the ends of that, the bytes wanted below the cut."""
    ends = [f(f"d{i}").alias(f"{n}{i}") for i in range(dimensions) for n, f in (("lo", F.min), ("hi", F.max))]
    found = rows.where("leaves > 1").groupBy("node", "leaves").agg(F.sum("size").alias("total"), *ends)
    spread = F.array(*[(F.col(f"hi{i}") - F.col(f"lo{i}")) / F.lit(w) for i, w in enumerate(widths)])
    found = found.withColumn("dimension", (F.array_position(spread, F.array_max(spread)) - 1).cast("int"))
    return found.select(
        "node",
        "dimension",
        F.floor(F.col("leaves") / 2).alias("half"),
        "total",
        (F.col("total") * (F.floor(F.col("leaves") / 2) / F.col("leaves"))).alias("wanted"),
        _chosen("lo", dimensions).alias("low"),
        _chosen("hi", dimensions).alias("high"),
        F.lit(0).cast("bigint").alias("below"),
    )


def _chosen(prefix: str, dimensions: int) -> Column:
    """The column of the node's dimension."""
    return F.coalesce(*[F.when(F.col("dimension") == i, F.col(f"{prefix}{i}")) for i in range(dimensions)])


def _look(rows: DataFrame, state: DataFrame, dimensions: int) -> DataFrame:
    """The bin of each node that holds its median, with the bytes below it, and the cut where the bin is narrow enough."""
    asked = state.select("node", "dimension", "low", "high", F.expr(f"(high - low + {BINS}) div {BINS}").alias("step"))
    at = rows.join(asked, "node").withColumn("at", _chosen("d", dimensions)).where("at between low and high")
    sums = at.groupBy("node", F.expr("cast((at - low) div step as int)").alias("bin")).agg(
        F.sum("size").alias("weight"), F.min("at").alias("bin_low"), F.max("at").alias("bin_high")
    )
    upto = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("weight").over(upto)).join(state, "node").withColumn("upto", F.col("below") + F.col("upto"))
    met = sums.where("upto >= wanted").groupBy("node").agg(
        F.min_by(F.struct("dimension", "half", "total", "wanted", "weight", "bin_low", "bin_high", "upto"), "bin").alias("m")
    )
    met = met.select("node", "m.*").withColumn("below", F.col("upto") - F.col("weight"))
    narrow = (F.col("bin_low") == F.col("bin_high")) | (F.col("weight") <= TOLERANCE * F.col("total"))
    nearer = F.when(F.col("wanted") - F.col("below") < F.col("upto") - F.col("wanted"), F.col("bin_low")).otherwise(F.col("bin_high") + 1)
    return met.select(
        "node", "dimension", "half", "total", "wanted", F.col("bin_low").alias("low"), F.col("bin_high").alias("high"), "below",
        F.when(narrow, nearer).alias("cut"),
    )


def medians(rows: DataFrame, dimensions: int, widths: list[float]) -> DataFrame:
    """node, dimension, half, cut of every node of more than one leaf; each narrowing is a written table."""
    state, found = written(_extents(rows, dimensions, widths), "extents"), None
    while not state.isEmpty():
        looked = written(_look(rows, state, dimensions), "look")
        cuts = looked.where("cut is not null").select("node", "dimension", "half", "cut")
        found = cuts if found is None else found.unionByName(cuts)
        state = looked.where("cut is null").drop("cut")
    return found


def tree(rows: DataFrame, dimensions: int, leaves: int) -> DataFrame:
    """``rows``, all at node 0, with the leaf they fall in as ``node``; one level of the tree after the other, each written once."""
    ends = [f(f"d{i}") for i in range(dimensions) for f in (F.min, F.max)]
    extent = rows.agg(*ends).first()
    placed = rows.withColumn("leaves", F.lit(leaves).cast("bigint"))
    if extent[0] is None:
        return placed
    widths = [max(1.0, float(extent[2 * i + 1] - extent[2 * i])) for i in range(dimensions)]
    largest = leaves
    while largest > 1:
        cut = placed.join(medians(placed, dimensions, widths), "node", "left")
        above = F.coalesce(_chosen("d", dimensions) >= F.col("cut"), F.lit(False))
        side = F.when(above, F.col("leaves") - F.col("half")).otherwise(F.coalesce("half", "leaves"))
        moved = {"node": F.col("node") + F.when(above, F.col("half")).otherwise(F.lit(0)), "leaves": side}
        placed = written(cut.withColumns(moved).select(placed.columns), "level")
        largest -= largest // 2
    return placed


def shards(
    docs: DataFrame,
    leaves: int | None = None,
    target_bytes: int | None = None,
    dimensions: tuple[str, ...] = ("lang", "source"),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """key, size, text_crc32, shard, slot. The length of the text is always a dimension besides ``dimensions``."""
    rows = points(docs, [d for d in dimensions if d in docs.columns], key, text)
    depth = sum(c.startswith("d") and c[1:].isdigit() for c in rows.columns)
    seen = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first()
    if leaves is None:
        leaves = max(1, -(-seen.s // (target_bytes or 1 << 30)))
    placed = tree(rows, depth, leaves).withColumn("shard", F.col("node").cast("int"))
    # A shard is numbered in chunks of bounded size, so that no task sorts a whole one.
    chunks = max(1, -(-seen.n // (leaves * CHUNK_ROWS)))
    placed = placed.withColumn("chunk", F.pmod("tie", F.lit(chunks)).cast("int"))
    sizes = placed.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("shard", "chunk").orderBy("key", "text_crc32", "tie")
    numbered = placed.withColumn("place", F.row_number().over(order)).join(offsets, ["shard", "chunk"])
    return numbered.select(
        F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("offset") + F.col("place") - 1).alias("slot")
    )


def write_shards(
    docs: DataFrame,
    path: str,
    leaves: int | None = None,
    target_bytes: int | None = None,
    dimensions: tuple[str, ...] = ("lang", "source"),
    text: str = "text",
) -> None:
    """All rows as one folder per shard, in slot order inside each file; a column named ``shard`` gives way to the folder's.

    Rows are numbered in a copy that is written first, so null and repeated keys are written as often as they come.
    """
    row, slot = fresh(docs, "_row"), fresh(docs, "_slot")
    docs = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    placed = shards(docs, leaves, target_bytes, dimensions, row, text).select(row, "shard", F.col("slot").alias(slot))
    docs.drop("shard").join(placed, row).repartition("shard", F.floor(F.col(slot) / CHUNK_ROWS)).sortWithinPartitions(
        "shard", slot
    ).drop(row, slot).write.partitionBy("shard").parquet(path)
