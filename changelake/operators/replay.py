"""Consumer side: folding delivered changes into the replica and accounting for them.

Every rule here is order-free or uses the arrival order of the deliveries explicitly, so
late, repeated and shuffled deliveries are legal input and are never removed up front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.functions.columns import bulk_action, version
from changelake.plans.ordered import (
    ROWS_PER_SEGMENT,
    SEGMENT,
    carry,
    cut_hot_groups,
    max_before,
)
from changelake.schema import APPLIED, ARRIVAL, CONFLICT, DOC_KEY, FAILED, INDEX, REPLICA


def arrival_order(deliveries: DataFrame) -> DataFrame:
    """Deliveries in the order they arrived, first in, first out, inside each batch."""
    return deliveries.repartition("batch_key").sortWithinPartitions("batch_key", *ARRIVAL)


def redelivered(first: DataFrame, again: DataFrame) -> DataFrame:
    """Deliveries plus repeated ones. Nothing is removed: replay absorbs repeats."""
    return first.unionByName(again)


def _as_replica(changes: DataFrame) -> DataFrame:
    source = F.when(F.col("op_type") == INDEX, F.col("source"))
    return changes.withColumn("version", version()).withColumn("source", source)


def _first_arrival(changes: DataFrame) -> list[Column]:
    """Tie order of equal versions: the earlier arrival stays. Without one, any fixed order."""
    known = [c for c in (*ARRIVAL, "primary_term", "timestamp_ms") if c in changes.columns]
    return [F.col(c).asc() for c in known]


def latest_state(changes: DataFrame) -> DataFrame:
    """The replica after replaying the changes: highest version per document, deletes as tombstones."""
    # Spark limits each map task to its own best row per document before the shuffle, so
    # many copies of one document never meet in one task.
    best = Window.partitionBy(*DOC_KEY).orderBy(F.col("version").desc(), *_first_arrival(changes))
    return (
        _as_replica(changes)
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") == 1)
        .select(*REPLICA.fieldNames())
    )


def live_docs(state: DataFrame) -> DataFrame:
    """Documents of a replica that exist: its rows that are not tombstones."""
    return state.filter(F.col("op_type") == INDEX)


def apply_changes(state: DataFrame, changes: DataFrame) -> DataFrame:
    """Fold changes into a replica, which has one row per document.

    Only a strictly higher version replaces a row. The changes are reduced to one row per
    document first, which leaves them partitioned and sorted for the join; the replica is
    shuffled once and not ranked.
    """
    body = [c for c in REPLICA.fieldNames() if c not in DOC_KEY]
    stored = state.select(*DOC_KEY, F.struct(*body).alias("_stored"))
    fresh = latest_state(changes).select(*DOC_KEY, F.struct(*body).alias("_fresh"))
    replaced = F.col("_stored").isNull() | (F.col("_fresh.version") > F.col("_stored.version"))
    kept = F.when(replaced, F.col("_fresh")).otherwise(F.col("_stored"))
    return (
        stored.join(fresh, DOC_KEY, "full_outer")
        .select(*DOC_KEY, kept.alias("_row"))
        .select(*[F.col(c) if c in DOC_KEY else F.col(f"_row.{c}") for c in REPLICA.fieldNames()])
    )


def bootstrap(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Replica from an initial copy of existing documents, then changes on top.

    The copy leaves out dot-prefixed collections and has version 0, below every change.
    """
    copied = snapshot.filter(~F.col("index").startswith(".")).select(
        "index",
        "shard_id",
        "id",
        F.lit(0).cast("long").alias("version"),
        F.lit(-1).cast("long").alias("seq_no"),
        F.lit(0).cast("long").alias("primary_term"),
        F.lit(INDEX).alias("op_type"),
        "source",
        F.col("routing") if "routing" in snapshot.columns else F.lit(None).cast("string").alias("routing"),
        F.lit(0).cast("long").alias("timestamp_ms"),
    )
    return apply_changes(copied, changes)


def replay_verdicts(
    deliveries: DataFrame,
    state: DataFrame | None = None,
    rejected: Column | None = None,
    rows_per_segment: int | None = ROWS_PER_SEGMENT,
    touched: bool = False,
) -> DataFrame:
    """Add `verdict` to every delivered event, in arrival order per document.

    APPLIED if its version is above the stored one and above all earlier ones, else
    CONFLICT. Events for which `rejected` holds are FAILED and do not raise the version.
    `rows_per_segment=None` cuts no group, for deliveries known to be fewer than a segment has rows.
    `touched` tells that `state` holds no document but those of the deliveries, as `stored_versions` gives it.
    """
    refused = F.lit(False) if rejected is None else F.coalesce(rejected, F.lit(False))
    rows = deliveries.withColumn("_rejected", refused).withColumn("_raises", F.when(~F.col("_rejected"), version()))
    if state is not None:
        stored = state.select(*DOC_KEY, F.col("version").alias("_raises"), F.lit(True).alias("_stored"))
        if not touched:  # documents that no event touches stay out of the sort
            stored = stored.join(deliveries.select(*DOC_KEY).distinct(), DOC_KEY, "left_semi")
        rows = rows.withColumn("_stored", F.lit(False)).unionByName(stored, allowMissingColumns=True)
    else:
        rows = rows.withColumn("_stored", F.lit(False))
    key = list(DOC_KEY)
    if rows_per_segment is not None:
        key.append(SEGMENT)
        rows = cut_hot_groups(rows, DOC_KEY, "arrival", rows_per_segment)
    earlier = (
        Window.partitionBy(*key)
        .orderBy(F.col("_stored").desc(), *ARRIVAL, "seq_no")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("_reached", F.max("_raises").over(earlier)).filter(~F.col("_stored"))
    reached = F.col("_reached")
    if rows_per_segment is not None:
        placed = placed.join(carry(rows, DOC_KEY, F.max("_raises"), max_before), key, "left")
        reached = F.greatest(reached, F.col("_carry"))
    verdict = (
        F.when(F.col("_rejected"), FAILED)
        .when(reached.isNull() | (version() > reached), APPLIED)
        .otherwise(CONFLICT)
    )
    return placed.select(*deliveries.columns, verdict.alias("verdict"))


def replay_summary(verdicts: DataFrame, batch: str = "batch_key") -> DataFrame:
    """Per batch: outcome counts, the highest sequence number and the term of that event.

    The highest sequence number covers events of every outcome. Of several events that
    have it, the first to arrive gives the term.
    """
    first = F.struct(F.col("seq_no"), -F.col("arrival"), -F.col("line_no"))
    return verdicts.groupBy(batch).agg(
        F.count_if(F.col("verdict") == APPLIED).alias("succeeded"),
        F.count_if(F.col("verdict") == CONFLICT).alias("version_conflicts"),
        F.count_if(F.col("verdict") == FAILED).alias("failed"),
        F.max("seq_no").alias("max_seq_no"),
        F.max_by("primary_term", first).alias("max_primary_term"),
    )


def render_bulk_actions(changes: DataFrame) -> DataFrame:
    """Changes as bulk text with external versions, column `bulk`."""
    return changes.select("*", bulk_action().alias("bulk"))
