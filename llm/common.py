"""Small helpers the operators share: UTF-8 words, scratch tables, connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.sources.storage import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared scratch folder and read again, which cuts its lineage."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def short_batches(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows unless the session sets a size: rows can be long texts, and workers keep what they once used."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def lower_words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z lowered: bytes.lower and bytes.split touch ASCII only."""
    return utf8(text).lower().split()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _stars(edges: DataFrame, upward: bool) -> DataFrame:
    """One star step: the neighbours of each node are linked to its smallest neighbour instead."""
    if upward:  # every neighbour counts, the larger ones are linked anew
        near = edges.union(edges.select("b", "a"))
        keep = F.col("b") > F.col("a")
    else:  # edges point from the larger node to the smaller one
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        keep = F.lit(True)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    # sorted and merged: by the size of its files, in which repeated nodes take little, Spark would broadcast a table of millions of edges
    moved = near.join(least.hint("merge"), "a").filter(keep).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not upward:
        moved = moved.union(least.select("a", F.col("m").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over `edges` (a, b); nodes without edges are left out.

    Alternating large and small stars: only minima per node are aggregated, so a node with
    very many links is combined map-side. Each round is written to the shared scratch folder.
    """
    edges = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    for _ in range(rounds):
        edges = stored(_stars(_stars(edges, True), False), "stars")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b").cast("decimal(38,0)"))
        ).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def forest(links_of, n: int) -> list[tuple[int, int]]:
    """Spanning forest of n items. `links_of(i, rest)` gives the items of `rest` linked to i."""
    rest = np.arange(n)
    tree = []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = links_of(i, rest)
            tree += [(i, j) for j in rest[hit]]
            queue += list(rest[hit])
            rest = rest[~hit]
    return tree


def in_pieces(df: DataFrame, keys: list[str], order: str, size: int, sizes: DataFrame) -> DataFrame:
    """Blocks in which every pair of rows of a group meets at least once, none above 2 * size rows.

    `sizes` has a row (keys, members, least, most) for each group of two or more rows. A group up
    to `size` rows is one block. A larger one is dealt into p pieces by a hash of `order`, and each
    pair of pieces is a block, so each of its rows is sent p times. Adds `_block` (long), `_piece`
    (int, -1 in whole groups) and `_cross` (the block is of two pieces, even if one has no rows).
    The join is a sort-merge join: Spark takes a table for as large as the one its rows were exploded from, and would broadcast it.
    """
    df = df.join(sizes.hint("merge"), keys)
    pieces = F.ceil(F.col("members") / F.lit(size)).cast("int")
    own = F.pmod(F.xxhash64(F.lit(7), order), pieces).cast("int")
    rows = df.withColumn("_pieces", F.when(F.col("members") > size, pieces).otherwise(F.lit(1))).withColumn(
        "_piece", F.when(F.col("_pieces") > 1, own).otherwise(F.lit(-1))
    )
    other = F.explode(F.when(F.col("_pieces") > 1, F.sequence(F.lit(0), F.col("_pieces") - 1)).otherwise(F.array(F.lit(-1))))
    return (
        rows.withColumn("_other", other)
        .withColumn("_block", F.xxhash64(*keys, F.least("_piece", "_other"), F.greatest("_piece", "_other")))
        .withColumn("_cross", F.col("_piece") != F.col("_other"))
        .drop("_pieces", "_other", "members")
    )
