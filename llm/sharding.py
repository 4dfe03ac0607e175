"""Shards of near-equal bytes: a k-d tree over the rows' metadata.

A node of the tree that is to hold several shards is split along its widest dimension (its range as a
share of the whole table's) at the weighted median of bytes, or the weighted quantile if the number
of shards is odd. Medians are exact and distributed: a value is read `PASS` bits at a time, each pass
sums bytes per node and bin and finds the bin of the median in Spark; a row per node reaches the driver, where the nodes, about
two a shard, are kept. Rows with equal texts share all coordinates and a tie-breaking hash, so they go the same way. Only a
group of copies with more bytes than a shard is to have is cut, by a hash of its rows into pieces of a `PIECES`th of a shard.

Dimensions: the size of the text on a logarithmic scale, and metadata columns. Numbers, dates and times keep their order; other
values, which have none, are placed by a hash.

Cases: a null text has no bytes. Null metadata is a value of its own, below all numbers. Repeated rows are rows of their
own. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import stored

PIECES = 32
ROWS_PER_RUN = 100_000  # rows of a group of copies, or of a shard, that meet in one task
HALF, PASS = 31, 16  # bits of a coordinate, and of a pass; a code is a coordinate and a tie of as many bits
_TOP = (1 << HALF) - 1


def _coordinates(docs: DataFrame, names: tuple[str, ...]) -> list[Column]:
    """Each metadata column as a number of `HALF` bits."""
    ordered = {}
    for name in names:
        kind = docs.schema[name].dataType
        if isinstance(kind, T.NumericType):
            ordered[name] = F.col(name).cast("double")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            ordered[name] = F.col(name).cast("timestamp").cast("double")
    known = {n: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c) for n, c in ordered.items()}
    ends = docs.agg(*[f(c).alias(f"{e}{i}") for i, c in enumerate(known.values()) for e, f in (("a", F.min), ("b", F.max))]).first() if known else None
    out = []
    for name in names:
        if name in known:
            i = list(known).index(name)
            low, high = ends[f"a{i}"] or 0.0, ends[f"b{i}"] or 0.0
            part = (known[name] - low) / F.lit(max(high - low, 1e-300))
            out.append(F.coalesce((part * (_TOP - 1)).cast("long") + 1, F.lit(0).cast("long")))
        else:
            out.append(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")).bitwiseAND(F.lit(_TOP)))
    return out


def _size_code(size: Column) -> Column:
    return (F.least(F.log2(size.cast("double")) / 48, F.lit(1.0)) * _TOP).cast("long")


def _code() -> Column:
    """A node's chosen dimension leads, the group's hash breaks ties."""
    return F.shiftleft(F.element_at("d", F.col("dim") + 1), HALF).bitwiseOR(F.col("tie"))


def _cuts(units: DataFrame, nodes: list[tuple[int, int, float]]) -> dict[int, int]:
    """node -> code from which units go right; nodes are (node, dimension, bytes of the left side)."""
    spark = units.sparkSession
    open_ = {n: (dim, goal, 0, 0.0) for n, dim, goal in nodes}
    cuts: dict[int, int] = {}
    shift = 2 * HALF
    while open_:
        width = min(PASS, shift)
        shift -= width
        state = spark.createDataFrame(
            [(n, dim, goal, prefix, before) for n, (dim, goal, prefix, before) in open_.items()],
            "node long, dim int, goal double, prefix long, before double",
        )
        coded = units.join(F.broadcast(state), "node").withColumn("code", _code())  # a row for each node of a level
        bins = (
            coded.filter(F.shiftright("code", shift + width) == F.col("prefix"))
            .groupBy("node", F.shiftright("code", shift).alias("bin"))
            .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.first("goal").alias("goal"), F.first("before").alias("before"))
        )
        order = Window.partitionBy("node").orderBy("bin")  # 2 ** PASS bins at most
        upto = F.col("before") + F.sum("bytes").over(order)
        reached = bins.withColumn("upto", upto).filter(F.col("upto") >= F.col("goal"))
        found = reached.groupBy("node").agg(F.min_by(F.struct("bin", "bytes", "n", "upto"), "bin").alias("at")).collect()
        left = {}
        for row in found:
            (dim, goal, _, _), at = open_[row.node], row["at"]
            if at.n == 1 or not shift:  # one unit: the nearer side of it
                cuts[row.node] = (at.bin + (goal - (at.upto - at.bytes) > at.bytes / 2)) << shift
            else:
                left[row.node] = (dim, goal, at.bin, float(at.upto - at.bytes))
        for n in open_.keys() - left.keys() - cuts.keys():  # rounding: all of it is on the left
            cuts[n] = (open_[n][2] + 1) << (shift + width)
        open_ = left
    return cuts


def shard(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    dimensions: tuple[str, ...] = ("lang", "source"),
) -> DataFrame:
    """(id, size, crc, shard, slot) per row; give the number of shards or the bytes a leaf may have.

    Slots number the rows of a shard from 0 without gaps.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    coordinates = _coordinates(docs, dimensions)
    # texts are read once
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("n"),
            F.col(id_col).cast("long").alias("id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("crc"),
            F.xxhash64(text).alias("hash"),
            *[c.alias(f"m{i}") for i, c in enumerate(coordinates)],
        ),
        "rows",
    )
    key = ["hash", "size", "crc"]
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if shards is None:
        shards = max(1, -(-total // target_bytes))
    share = max(1.0, total / shards)
    # groups of copies that are cut, or dealt out where their rows meet: a row for each `ROWS_PER_RUN` rows and shard at most
    sizes = rows.groupBy(*key).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("copies"))
    cut = F.col("bytes") > share
    parts = F.when(cut, F.ceil(F.col("bytes") * PIECES / share)).otherwise(F.ceil(F.col("copies") / ROWS_PER_RUN)).cast("int")
    hot = stored(sizes.filter(cut | (F.col("copies") > ROWS_PER_RUN)).select(*key, cut.alias("cut"), parts.alias("parts")), "hot")
    dealt = rows.join(hot, key, "left").withColumn("cell", F.pmod(F.xxhash64("n"), F.coalesce("parts", F.lit(1))).cast("int"))
    dealt = dealt.withColumn("piece", F.when(F.col("cut"), F.col("cell")).otherwise(0))
    units = dealt.groupBy(*key, "piece").agg(
        F.sum("size").alias("bytes"), *[F.min(f"m{i}").alias(f"m{i}") for i in range(len(dimensions))]
    )  # copies in several sources go with the first of them
    coords = F.array(_size_code(F.col("size")), *[F.col(f"m{i}") for i in range(len(dimensions))])
    tie = F.xxhash64(*key, "piece").bitwiseAND(F.lit(_TOP))
    units = stored(units.select(*key, "piece", "bytes", coords.alias("d"), tie.alias("tie"), F.lit(1).cast("long").alias("node")), "units")
    dims = range(len(dimensions) + 1)
    leaves: dict[int, tuple[int, int]] = {1: (0, shards)}
    spread: list[float] | None = None
    while any(n > 1 for _, n in leaves.values()) and total:
        wide = {
            r.node: r
            for r in units.groupBy("node")
            .agg(
                F.sum("bytes").alias("bytes"),
                *[(F.max(F.element_at("d", d + 1)) - F.min(F.element_at("d", d + 1))).cast("double").alias(f"w{d}") for d in dims],
            )
            .collect()
        }
        if spread is None:
            spread = [max(1.0, wide[1][f"w{d}"]) for d in dims]
        nodes = {n: (a, k, k // 2) for n, (a, k) in leaves.items() if k > 1 and n in wide}
        if not nodes:
            break
        chosen = {n: max(dims, key=lambda d: (wide[n][f"w{d}"] / spread[d], -d)) for n in nodes}
        cuts = _cuts(units, [(n, chosen[n], float(wide[n].bytes) * left / k) for n, (_, k, left) in nodes.items()])
        table = spark.createDataFrame([(n, chosen[n], cuts[n]) for n in nodes], "node long, dim int, cut long")
        placed = units.join(F.broadcast(table), "node", "left")
        side = (_code() >= F.col("cut")).cast("long")
        moved = F.when(F.col("cut").isNull(), F.col("node")).otherwise(F.col("node") * 2 + side)
        units = stored(placed.withColumn("node", moved).drop("dim", "cut"), "split")
        leaves = {n: v for n, v in leaves.items() if n not in nodes and v[1] <= 1} | {
            2 * n + side: ((a, left) if not side else (a + left, k - left)) for n, (a, k, left) in nodes.items() for side in (0, 1)
        }
    numbers = spark.createDataFrame([(n, a) for n, (a, _) in leaves.items()], "node long, shard int")
    placed = units.select(*key, "piece", "node").join(F.broadcast(numbers), "node").join(hot, key, "left")
    cells = F.when(F.col("cut"), F.array("piece")).otherwise(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    placed = placed.select(*key, "shard", F.explode(cells).alias("cell"))
    runs = -(-(n_rows or 1) // (shards * ROWS_PER_RUN))
    out = dealt.select("n", "id", *key, "cell").join(placed, [*key, "cell"]).withColumn("run", F.pmod(F.xxhash64("n", "hash"), F.lit(runs)))
    in_run = Window.partitionBy("shard", "run").orderBy("id", "hash", "n")
    out = stored(out.withColumn("_row", F.row_number().over(in_run)), "slots")
    before = (
        out.groupBy("shard", "run")
        .agg(F.count(F.lit(1)).alias("n_run"))
        .withColumn("before", F.sum("n_run").over(Window.partitionBy("shard").orderBy("run")) - F.col("n_run"))
        .drop("n_run")
    )
    return out.join(before, ["shard", "run"]).select(
        "id", "size", "crc", "shard", (F.col("before") + F.col("_row") - 1).cast("long").alias("slot")
    )
