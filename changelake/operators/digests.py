"""Comparing two copies by trees of digests, so that equal documents are neither shuffled nor sent.

The hash of a document puts it in one of 2 ** bits ranges, the leaves. A leaf's digest is free of order: the number of its
documents, and an exclusive or and a sum of two independent 64-bit hashes of them. The digest of a wider range is made of
those of its parts. Two trees are compared from the top; only parts of ranges that differ are looked at further, and
only documents of leaves that differ are joined. Each side can keep its leaves and bring them up to date by itself.

Two leaves that differ pass for equal only if counts, both hashes' combinations and so 128 bits agree.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.columns import compact_json
from changelake.operators.reconcile import MATCH, reconcile_docs
from changelake.schema import DOC_KEY

# Leaves, and by how many bits a level of the tree is finer than the one above.
BITS, STEP = 16, 4
_SUM = "decimal(38,0)"


def leaf_of(bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64("index", "shard_id", "id"), 64 - bits)


def _combined(docs: Column, mixed: Column, total: Column) -> list[Column]:
    return [F.sum(docs).alias("docs"), F.bit_xor(mixed).alias("mixed"), F.sum(total.cast(_SUM)).cast(_SUM).alias("total")]


def digest_leaves(copy: DataFrame, bits: int = BITS) -> DataFrame:
    """(leaf, docs, mixed, total) of the live documents of a copy; bodies count without their white space."""
    body = F.sha2(compact_json(F.col("source")).cast("binary"), 256)
    mixed, total = F.xxhash64("index", "shard_id", "id", body), F.xxhash64(body, "id", "shard_id", "index")
    return copy.groupBy(leaf_of(bits).alias("leaf")).agg(*_combined(F.lit(1).cast("long"), mixed, total))


def rolled_up(leaves: DataFrame, by: int) -> DataFrame:
    """The digests of ranges that are 2 ** by times as wide."""
    wide = leaves.groupBy(F.shiftrightunsigned("leaf", by).alias("leaf"))
    return wide.agg(*_combined(F.col("docs"), F.col("mixed"), F.col("total")))


def differing_leaves(active: DataFrame, passive: DataFrame, bits: int = BITS, step: int = STEP) -> DataFrame:
    """The leaves whose digests differ, found level by level from the top."""
    found = None
    for level in [*range(step, bits, step), bits]:
        left, right = rolled_up(active, bits - level), rolled_up(passive, bits - level)
        if found is not None:
            finer = level - above
            for_parents = F.shiftrightunsigned("leaf", finer).alias("_parent")
            left, right = (
                side.withColumn("_parent", for_parents).join(found.withColumnRenamed("leaf", "_parent"), "_parent", "left_semi").drop("_parent")
                for side in (left, right)
            )
        right = right.select("leaf", F.struct("docs", "mixed", "total").alias("right"))
        both = left.select("leaf", F.struct("docs", "mixed", "total").alias("left")).join(right, "leaf", "full_outer")
        found, above = both.filter(~F.col("left").eqNullSafe(F.col("right"))).select("leaf"), level
    return found


def reconcile_by_digest(active: DataFrame, passive: DataFrame, bits: int = BITS, step: int = STEP) -> DataFrame:
    """The rows of `reconcile_docs`; documents are shuffled only where the copies differ."""
    sides = [digest_leaves(copy, bits).persist(StorageLevel.MEMORY_AND_DISK) for copy in (active, passive)]  # a row per leaf
    found = differing_leaves(*sides, bits, step)

    def parted(copy: DataFrame, how: str) -> DataFrame:
        return copy.withColumn("leaf", leaf_of(bits)).join(found, "leaf", how).drop("leaf")

    equal = parted(active, "left_anti").select(*DOC_KEY, F.lit(MATCH).alias("status"))
    return equal.unionByName(reconcile_docs(parted(active, "left_semi"), parted(passive, "left_semi")))
