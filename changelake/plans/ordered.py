"""Ordered work inside groups of any size.

A window over one group runs in one task. That is fine until a single shard or
document holds a large part of all rows. Here a group above `rows_per_segment`
is cut into order-preserving segments: the window runs per (group, segment) in
parallel, one small row per segment carries the result of the earlier segments,
and the two are joined. Groups below the limit keep a null segment, so for them
the plan is the ordinary window plus a join against nothing.

Segments are computed from counts and from the ordering column's own values,
never from sampling, so a recomputed task puts every row where it was before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEGMENT = "_segment"
ROWS_PER_SEGMENT = 1_000_000

# Room for the second cut below one value of the first.
_FINER = 1 << 32

# Rows of a partition of a table whose size is known.
ROWS_PER_PARTITION = 50_000
_SHUFFLE = "spark.sql.shuffle.partitions"


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int) -> Iterator[None]:
    """Let shuffles of the session have partitions for so many rows: at least one a core, at most those the session has.

    A shuffle into many more partitions than there is work for takes longer than the work.
    """
    most = spark.conf.get(_SHUFFLE)
    needed = max(spark.sparkContext.defaultParallelism, rows // ROWS_PER_PARTITION)
    spark.conf.set(_SHUFFLE, str(min(int(most), needed)))
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE, most)


def _ranges(
    rows: DataFrame, keys: Sequence[str], lead: str, limit: int, finer: int = 1
) -> DataFrame:
    """Groups of `rows` above `limit`, with the start and width of even pieces of their range."""
    pieces = F.ceil(F.col("_rows") / F.lit(limit)) * F.lit(finer)
    span = F.col("_last") - F.col("_first") + F.lit(1)
    return (
        rows.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min(lead).alias("_first"),
            F.max(lead).alias("_last"),
        )
        .filter(F.col("_rows") > limit)
        .select(*keys, "_first", F.greatest(F.lit(1), F.ceil(span / pieces)).alias("_width"))
    )


def cut_hot_groups(
    df: DataFrame,
    keys: Sequence[str],
    lead: str,
    rows_per_segment: int = ROWS_PER_SEGMENT,
    unique_lead: bool = False,
) -> DataFrame:
    """Add `_segment`: null in ordinary groups, growing with `lead` in large ones.

    `lead` is the leading ordering column, an integer ordinal. Rows where it is null sort
    first. If it is unique within a group, fixed-width segments are small whatever the
    spread of the values. If not, the range of a group is cut evenly, and pieces in which
    the values crowd are cut once more, 32 times finer than their rows alone would ask for. Every
    group above the limit is cut. The list of such groups has one row per `rows_per_segment` rows
    at most; Spark chooses how to join it by its size, which it knows when the counts are done.
    """
    place = F.expr(f"(`{lead}` - _first) div _width")
    hot = _ranges(df, keys, lead, rows_per_segment)
    cut = df.join(hot, list(keys), "left")
    is_hot = F.col("_width").isNotNull()
    if unique_lead:
        place = F.expr(f"(`{lead}` - _first) div {int(rows_per_segment)}")
        return cut.withColumn(SEGMENT, F.when(is_hot, F.coalesce(place, F.lit(0)))).drop("_first", "_width")

    once = cut.withColumn(SEGMENT, F.when(is_hot, F.coalesce(place, F.lit(0)))).drop("_first", "_width")
    crowded = _ranges(
        once.filter(F.col(SEGMENT).isNotNull()), [*keys, SEGMENT], lead, 2 * rows_per_segment, 32
    )
    finer = F.col(SEGMENT) * _FINER + F.coalesce(place, F.lit(0))
    return (
        once.join(crowded, [*keys, SEGMENT], "left")
        .withColumn(SEGMENT, finer)
        .drop("_first", "_width")
    )


def cut_by_ordinal(df: DataFrame, lead: str, width: int = ROWS_PER_SEGMENT) -> DataFrame:
    """Add `_segment` for a `lead` that is unique within its group.

    `width` consecutive values hold at most `width` rows, so no counting pass is needed.
    """
    return df.withColumn(SEGMENT, F.expr(f"`{lead}` div {int(width)}"))


def carry(
    rows: DataFrame,
    keys: Sequence[str],
    part: Column,
    over_earlier: Callable,
    name: str = "_carry",
) -> DataFrame:
    """One row per (group, segment): `part` per segment, folded over the earlier segments."""
    earlier = Window.partitionBy(*keys).orderBy(SEGMENT)
    return (
        rows.filter(F.col(SEGMENT).isNotNull())
        .groupBy(*keys, SEGMENT)
        .agg(part.alias("_part"))
        .select(*keys, SEGMENT, over_earlier(F.col("_part"), earlier).alias(name))
    )


def _sum_before(part: Column, earlier) -> Column:
    return F.sum(part).over(earlier.rowsBetween(Window.unboundedPreceding, -1))


def max_before(part: Column, earlier) -> Column:
    return F.max(part).over(earlier.rowsBetween(Window.unboundedPreceding, -1))


def previous(part: Column, earlier) -> Column:
    return F.lag(part).over(earlier)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    lead: str,
    name: str = "row_no",
    unique_lead: bool = False,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Add a dense 0-based row number per group as `name`, in `order` (which starts with `lead`)."""
    if unique_lead:
        rows = cut_by_ordinal(df, lead, rows_per_segment)
    else:
        rows = cut_hot_groups(df, keys, lead, rows_per_segment)
    before = carry(rows, keys, F.count(F.lit(1)), _sum_before)
    local = Window.partitionBy(*keys, SEGMENT).orderBy(*order)
    return (
        rows.withColumn(name, F.row_number().over(local).cast("long") - 1)
        .join(before, [*keys, SEGMENT], "left")
        .withColumn(name, F.col(name) + F.coalesce("_carry", F.lit(0)))
        .drop(SEGMENT, "_carry")
    )
