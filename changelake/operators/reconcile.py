"""Comparing the active and the passive copy, and measuring how far apart they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.functions.columns import compact_json
from changelake.plans.ordered import ROWS_PER_SEGMENT, SEGMENT, carry, cut_by_ordinal, max_before
from changelake.schema import DOC_KEY, SHARD_KEY

MATCH, MISMATCH = "MATCH", "MISMATCH"


def _status() -> Column:
    return (
        F.when(F.col("in_active").isNull(), "MISSING_ACTIVE")
        .when(F.col("in_passive").isNull(), "MISSING_PASSIVE")
        .when(F.col("active_digest").eqNullSafe(F.col("passive_digest")), MATCH)
        .otherwise("CONTENT_MISMATCH")
    )


def _digest(name: str) -> Column:
    """A body is compared by 64 characters, so that bodies are not shuffled, and without its white space."""
    return F.sha2(compact_json(F.col("source")).cast("binary"), 256).alias(name)


def _paired(active: DataFrame, passive: DataFrame) -> DataFrame:
    left = active.select(*DOC_KEY, _digest("active_digest"), F.lit(True).alias("in_active"))
    right = passive.select(*DOC_KEY, _digest("passive_digest"), F.lit(True).alias("in_passive"))
    return left.join(right, DOC_KEY, "full_outer")


def reconcile_docs(active: DataFrame, passive: DataFrame) -> DataFrame:
    """Per live document of either copy: match, different content, or missing on one side."""
    return _paired(active, passive).select(*DOC_KEY, _status().alias("status"))


def spot_check(active: DataFrame, passive: DataFrame, n: int = 10) -> DataFrame:
    """Compare `n` documents picked by the hash of their key: repeatable, and a top-k, not a sort."""
    address = F.concat_ws("/", "index", F.col("shard_id").cast("string"), "id")

    def picked(copy: DataFrame) -> DataFrame:
        return copy.withColumn("_pick", F.md5(address)).orderBy("_pick").limit(n)

    # The first n of both copies together are among the first n of each.
    keys = (
        picked(active).select(*DOC_KEY, "_pick")
        .unionByName(picked(passive).select(*DOC_KEY, "_pick"))
        .distinct()
        .orderBy("_pick")
        .limit(n)
        .select(*DOC_KEY)
    )
    wanted = F.broadcast(keys)  # n rows
    return reconcile_docs(
        active.join(wanted, DOC_KEY, "left_semi"), passive.join(wanted, DOC_KEY, "left_semi")
    )


def reconcile_counts(active: DataFrame, passive: DataFrame) -> DataFrame:
    """Live documents per collection on both sides, with a TOTAL row.

    `in_sync` holds on the TOTAL row if every collection matches and there is any document.
    """
    counts = (
        active.groupBy("index").agg(F.count(F.lit(1)).alias("active"), F.lit(0).alias("passive"))
        .unionByName(
            passive.groupBy("index").agg(F.lit(0).alias("active"), F.count(F.lit(1)).alias("passive"))
        )
        .groupBy("index")
        .agg(F.sum("active").alias("active"), F.sum("passive").alias("passive"))
    )
    # A row of no collection, so that there is a total even where there are no documents.
    nothing = active.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("index"), F.lit(0).alias("active"), F.lit(0).alias("passive")
    )
    in_sync = ~F.col("_differs") & (F.col("active") > 0)
    return (
        counts.unionByName(nothing)
        .withColumn("_differs", F.col("active") != F.col("passive"))
        .rollup("index")
        .agg(
            F.sum("active").alias("active"),
            F.sum("passive").alias("passive"),
            F.max("_differs").alias("_differs"),
            F.grouping("index").alias("_total"),
        )
        .filter((F.col("_total") == 1) | F.col("index").isNotNull())
        .select(
            F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("index")).alias("index"),
            "active",
            "passive",
            F.when(F.col("active") == F.col("passive"), MATCH).otherwise(MISMATCH).alias("status"),
            F.when(F.col("_total") == 1, in_sync).alias("in_sync"),
        )
    )


def replication_lag(changes: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Per shard: newest sequence number of the active side against the checkpoint.

    A lag of 0 shows progress, not completeness: see `sequence_gaps`.
    """
    newest = changes.groupBy(*SHARD_KEY).agg(F.max("seq_no").alias("active_seq_no"))
    seen = F.coalesce("last_seq_no", F.lit(-1))
    return newest.join(
        checkpoints.select(*SHARD_KEY, "last_seq_no"), SHARD_KEY, "left"
    ).select(
        *SHARD_KEY,
        "active_seq_no",
        seen.alias("checkpoint_seq_no"),
        (F.col("active_seq_no") - seen).alias("lag"),
    )


def sequence_gaps(deliveries: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """Ranges of sequence numbers below the newest delivered one that never arrived."""
    # Copies of an event go first, in a map-side aggregate; then the numbers are unique.
    seqs = deliveries.select(*SHARD_KEY, "seq_no").distinct()
    rows = cut_by_ordinal(seqs, "seq_no", rows_per_segment)
    local = F.lag("seq_no").over(Window.partitionBy(*SHARD_KEY, SEGMENT).orderBy("seq_no"))
    before = carry(rows, SHARD_KEY, F.max("seq_no"), max_before)
    last = F.coalesce("_last", "_carry", F.lit(-1))
    return (
        rows.withColumn("_last", local)
        .join(before, [*SHARD_KEY, SEGMENT], "left")
        .filter(F.col("seq_no") - last > 1)
        .select(
            *SHARD_KEY,
            (last + 1).alias("gap_from"),
            (F.col("seq_no") - 1).alias("gap_to"),
            (F.col("seq_no") - last - 1).alias("missing"),
        )
    )
