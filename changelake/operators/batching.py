"""Packing the change log into batches, and describing the batches."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.columns import base_path, batch_key, change_line, event_size
from changelake.plans.ordered import ROWS_PER_SEGMENT, SEGMENT, cut_hot_groups, number_rows
from changelake.schema import SHARD_KEY

# The packing functions travel to the executors with the job, so the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Default limits of a batch.
MAX_EVENTS = 1000
MAX_AGE_MS = 5000
MAX_BYTES = 5 * 1024 * 1024


def batch_by_age(changes: DataFrame, ms: int = MAX_AGE_MS, name: str = "age_window") -> DataFrame:
    """Add the epoch-aligned tumbling window each event falls in."""
    return changes.withColumn(name, F.expr(f"timestamp_ms div {int(ms)}"))


def batch_by_count(
    changes: DataFrame, n: int = MAX_EVENTS, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """Add `batch_no`: every `n` events of a shard, in sequence order."""
    order = ["seq_no", "primary_term", "timestamp_ms", "id"]
    numbered = number_rows(
        changes, SHARD_KEY, order, "seq_no", "batch_no", True, rows_per_segment
    )
    return numbered.withColumn("batch_no", F.expr(f"batch_no div {int(n)}"))


def bulk_sub_batches(
    deliveries: DataFrame,
    n: int = 500,
    batch: str = "batch_key",
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Add `slice_no`: slices of `n` events of each delivered batch, in arrival order."""
    order = ["arrival", "batch_key", "line_no"]
    numbered = number_rows(
        deliveries, [batch], order, "arrival", "slice_no", rows_per_segment=rows_per_segment
    )
    return numbered.withColumn("slice_no", F.expr(f"slice_no div {int(n)}"))


# --- batches bounded by count, bytes and age ------------------------------------------

PACK_KEY = [*SHARD_KEY, "age_window"]
PACK_ORDER = ["seq_no", "primary_term", "timestamp_ms", "id"]


def pack_batches(
    changes: DataFrame,
    max_events: int = MAX_EVENTS,
    age_ms: int = MAX_AGE_MS,
    max_bytes: int = MAX_BYTES,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Add `age_window` and `batch_no`: a batch closes with the event that reaches a limit.

    Where a batch ends depends on where it began, so this is a sequential fold. Each
    (shard, window) group, or each segment of a large one, is folded on its own, on a skeleton of sizes in order: where
    the batch after each row would begin is one look-up per row, and pointer doubling follows those from the first batch on. A
    segment needs to know how full the batch is that reaches into it: segments of large groups are first summarised for every
    possible position of their first cut, and the summaries, one row per segment, are walked in order.

    What comes of the fold is a row per batch, its first place in the piece. The events, which never leave the JVM, are
    numbered in the same order and take the number of the last batch that begins at or before their place.
    """
    sized = batch_by_age(changes, age_ms).withColumn("_size", event_size())
    rows = cut_hot_groups(sized, PACK_KEY, "seq_no", rows_per_segment, unique_lead=True)
    piece = [*PACK_KEY, SEGMENT]
    # Events that agree in all of this are interchangeable, so both sides number them alike.
    order = [*PACK_ORDER, "_size"]
    skeleton = rows.select(*piece, *order)

    summaries = (
        skeleton.filter(F.col(SEGMENT).isNotNull())
        .repartition(*piece)
        .sortWithinPartitions(*piece, *order)
        .select(*piece, "_size")
        .mapInArrow(_summarise(max_events, max_bytes), _summary_schema(rows))
    )
    entries = (
        summaries.repartition(*PACK_KEY)
        .sortWithinPartitions(*piece)
        .mapInArrow(_walk(max_events, max_bytes), _entry_schema(rows))
    )
    # A segment's entry row sorts ahead of its events.
    begins = (
        skeleton.withColumn("_event", F.lit(True))
        .unionByName(entries.withColumn("_event", F.lit(False)), allowMissingColumns=True)
        .repartition(*piece)
        .sortWithinPartitions(*piece, "_event", *order)
        .select(*piece, "_event", "_size", "_count", "_bytes", "_cuts")
        .mapInArrow(_begin(max_events, max_bytes), _begin_schema(rows))
    )

    place = F.row_number().over(Window.partitionBy(*piece).orderBy(*order)) - 1
    placed = rows.withColumn("_place", place.cast("long")).withColumn("_event", F.lit(True))
    # Both sides are partitioned by piece, and so is their union: the events are shuffled once.
    marked = placed.unionByName(begins.repartition(*piece).withColumn("_event", F.lit(False)), allowMissingColumns=True)
    so_far = Window.partitionBy(*piece).orderBy("_place", "_event").rowsBetween(Window.unboundedPreceding, 0)
    return (
        marked.withColumn("batch_no", F.last("batch_no", ignorenulls=True).over(so_far))
        .filter("_event")
        .drop(SEGMENT, "_event", "_size", "_place")
    )


def _begin_schema(rows: DataFrame) -> T.StructType:
    return T.StructType(
        [rows.schema[c] for c in [*PACK_KEY, SEGMENT]]
        + [T.StructField("_place", T.LongType()), T.StructField("batch_no", T.LongType())]
    )


def _summary_schema(rows: DataFrame) -> T.StructType:
    longs = T.ArrayType(T.LongType())
    names = ["_prefix", "_open_count", "_open_bytes", "_cuts_after"]
    return T.StructType(
        [rows.schema[c] for c in [*PACK_KEY, SEGMENT]]
        + [T.StructField("_length", T.LongType()), T.StructField("_total", T.LongType())]
        + [T.StructField(n, longs) for n in names]
    )


def _entry_schema(rows: DataFrame) -> T.StructType:
    return T.StructType(
        [rows.schema[c] for c in [*PACK_KEY, SEGMENT]]
        + [T.StructField(n, T.LongType()) for n in ("_count", "_bytes", "_cuts")]
    )


def _starts(batch: pa.RecordBatch, keys: list[str], before: list | None) -> np.ndarray:
    """True where a row's key differs from the row above; `before` is the key above row 0."""
    flags = np.zeros(batch.num_rows, dtype=bool)
    flags[0] = before is None or before != _key_at(batch, keys, 0)
    for k in keys:
        col = batch.column(k)
        same = pc.equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
        # Two nulls compare as null, which is no change; the segment is null for a whole group.
        flags[1:] |= np.equal(same, False)
    return flags


def _key_at(batch: pa.RecordBatch, keys: list[str], row: int) -> list:
    return [batch.column(k)[row].as_py() for k in keys]


def _next_batches(sizes: np.ndarray, max_events: int, max_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sizes, and for each row, the end included, one past the last row of a batch that begins there."""
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    start = np.arange(len(sizes) + 1)
    end = np.minimum(start + max_events, np.searchsorted(prefix, prefix + max_bytes, "left"))
    return prefix, np.maximum(end, start + 1)


def _first_cut(prefix: np.ndarray, count: int, size: int, max_events: int, max_bytes: int) -> int:
    """Rows that the open batch of `count` events and `size` bytes still takes, if there are as many."""
    if count == 0:
        return 0
    return max(1, min(max_events - count, int(np.searchsorted(prefix, max_bytes - size, "left"))))


def batch_begins(sizes: np.ndarray, state: tuple, max_events: int, max_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, numbers) of the batches that rows of a segment are in, given the open batch that enters it."""
    count, size, number = state
    n = len(sizes)
    prefix, end = _next_batches(sizes, max_events, max_bytes)
    first = _first_cut(prefix, count, size, max_events, max_bytes)
    jump = np.minimum(end, n)
    places = np.array([min(first, n)])
    # each round appends as many places as there are, twice as far on
    while len(more := jump[places]) and more[0] < n:
        places = np.concatenate([places, more[more < n]])
        jump = jump[jump]
    places = places[places < n]
    if first and n:
        places = np.concatenate([[0], places])
    return places, number + np.arange(len(places))


def summarise_segment(sizes: np.ndarray, max_events: int, max_bytes: int) -> dict:
    """What a segment does to the open batch, for every place `f` its first cut may fall.

    A batch starting at row `f` is followed through the segment: how many cuts it meets
    and how full the batch is that is still open at the end.
    """
    n = len(sizes)
    start = np.arange(n + 1)
    prefix, end = _next_batches(sizes, max_events, max_bytes)
    closed = end <= n
    after = np.where(closed, end, start)
    cuts = closed.astype(np.int64)
    while True:
        further = after[after]
        if np.array_equal(further, after):
            break
        cuts = cuts + cuts[after]
        after = further
    keep = slice(0, min(max_events, n) + 1)
    return {
        "_length": n,
        "_total": int(prefix[-1]),
        "_prefix": prefix[keep].tolist(),
        "_open_count": (n - after)[keep].tolist(),
        "_open_bytes": (prefix[-1] - prefix[after])[keep].tolist(),
        "_cuts_after": cuts[keep].tolist(),
    }


def through_segment(state: tuple, s: dict, max_events: int, max_bytes: int) -> tuple:
    """(events, bytes, cuts so far) of the open batch after a segment, from those before it."""
    count, size, cuts = state
    first = _first_cut(s["_prefix"], count, size, max_events, max_bytes)
    if count:
        if first > s["_length"]:
            return count + s["_length"], size + s["_total"], cuts
        cuts += 1
    return s["_open_count"][first], s["_open_bytes"][first], cuts + s["_cuts_after"][first]


def _pieces(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[pa.Schema, list, list[pa.Array]]]:
    """Each piece of sorted batches: its key's schema, its key, and its columns, joined where a batch ends inside it."""
    piece = [*PACK_KEY, SEGMENT]
    key, held, schema = None, [], None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        schema = pa.schema([batch.schema.field(c) for c in piece])
        starts = _starts(batch, piece, key)
        at = (np.flatnonzero(starts[1:]) + 1).tolist()
        for begin, stop in zip([0, *at], [*at, batch.num_rows]):
            if starts[begin]:
                if held:
                    yield schema, key, [pa.concat_arrays(c) for c in zip(*held)]
                key, held = _key_at(batch, piece, begin), []
            held.append([batch.column(c).slice(begin, stop - begin) for c in columns])
    if held:
        yield schema, key, [pa.concat_arrays(c) for c in zip(*held)]


def _summarise(max_events: int, max_bytes: int):
    piece = [*PACK_KEY, SEGMENT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        names = ("_prefix", "_open_count", "_open_bytes", "_cuts_after")
        more = [("_length", pa.int64()), ("_total", pa.int64()), *[(n, longs) for n in names]]
        for schema, key, (sizes,) in _pieces(batches, ["_size"]):
            row = dict(zip(piece, key)) | summarise_segment(sizes.to_numpy(), max_events, max_bytes)
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([*schema, *[pa.field(*m) for m in more]]))

    return run


def _begin(max_events: int, max_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for schema, key, columns in _pieces(batches, ["_event", "_size", "_count", "_bytes", "_cuts"]):
            events = columns[0].to_numpy(zero_copy_only=False).astype(bool)
            entry = int(not events[0]) if len(events) else 0
            state = tuple(c[0].as_py() for c in columns[2:]) if entry else (0, 0, 0)
            sizes = columns[1].slice(entry).to_numpy()
            places, numbers = batch_begins(sizes, state, max_events, max_bytes)
            same = [pa.array([k] * len(places), f.type) for k, f in zip(key, schema)]
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(places, pa.int64()), pa.array(numbers, pa.int64())], names=[*schema.names, "_place", "batch_no"]
            )

    return run


def _walk(max_events: int, max_bytes: int):
    piece = [*PACK_KEY, SEGMENT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, (0, 0, 0)
        for batch in batches:
            out = []
            for s in batch.to_pylist():
                group = [s[c] for c in PACK_KEY]
                if group != key:
                    key, state = group, (0, 0, 0)
                out.append(
                    {c: s[c] for c in piece}
                    | {"_count": state[0], "_bytes": state[1], "_cuts": state[2]}
                )
                state = through_segment(state, s, max_events, max_bytes)
            if out:
                schema = pa.schema(
                    [batch.schema.field(c) for c in piece]
                    + [(n, pa.int64()) for n in ("_count", "_bytes", "_cuts")]
                )
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


# --- describing batches -----------------------------------------------------------------

BATCH = [*SHARD_KEY, "batch_no"]


def batch_ranges(batched: DataFrame, batch: list[str] | None = None) -> DataFrame:
    """Per batch: event count, sequence range and highest primary term."""
    return batched.groupBy(*(batch or BATCH)).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.min("seq_no").alias("from_seq_no"),
        F.max("seq_no").alias("to_seq_no"),
        F.max("primary_term").alias("primary_term"),
    )


def with_batch_key(batched: DataFrame, batch: list[str] | None = None) -> DataFrame:
    """Add `batch_key`, `{index}/{shard}/{term}_{first}_{last}`, to every event of a batch.

    Batches are bounded, so a window per batch is safe; it shares its partitioning with a
    following write by batch.
    """
    w = Window.partitionBy(*(batch or BATCH))
    key = batch_key(
        F.max("primary_term").over(w), F.min("seq_no").over(w), F.max("seq_no").over(w)
    )
    return batched.withColumn("batch_key", key)


def batch_manifest(
    batched: DataFrame,
    batch: list[str] | None = None,
    base: str = "",
    suffix: str = ".ndjson",
    stored: DataFrame | None = None,
) -> DataFrame:
    """One descriptor per batch. `payload_bytes` is the size of the lines, or the size on
    storage where `stored` (batch_key, stored_bytes) lists the written files."""
    line_bytes = F.sum(F.octet_length(change_line()) + F.lit(1))
    out = (
        batched.groupBy(*(batch or BATCH))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.min("seq_no").alias("from_seq_no"),
            F.max("seq_no").alias("to_seq_no"),
            F.max("primary_term").alias("primary_term"),
            *([] if stored is not None else [line_bytes.cast("long").alias("payload_bytes")]),
        )
        .withColumn("batch_key", batch_key("primary_term", "from_seq_no", "to_seq_no"))
    )
    if stored is not None:
        sizes = stored.groupBy("batch_key").agg(F.sum("stored_bytes").alias("payload_bytes"))
        out = out.join(sizes, "batch_key", "left")
    key = F.concat(F.lit(base_path(base)), F.col("batch_key"), F.lit(suffix))
    return out.select(
        key.alias("s3_key"),
        "event_count",
        "from_seq_no",
        "to_seq_no",
        "primary_term",
        "index",
        "shard_id",
        "payload_bytes",
    )


def ship_metrics(manifest: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Batches, events and bytes shipped. Batches of `wanted` without a descriptor failed."""
    rows = manifest.select("event_count", "payload_bytes", F.lit(0).alias("_failed"))
    if wanted is not None:
        failed = wanted.join(manifest.select("s3_key"), "s3_key", "left_anti")
        rows = rows.unionByName(failed.select(F.lit(1).alias("_failed")), allowMissingColumns=True)
    return rows.agg(
        F.count_if(F.col("_failed") == 0).alias("batches_shipped"),
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("events_shipped"),
        F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("bytes_shipped"),
        F.count_if(F.col("_failed") == 1).alias("ship_failures"),
    )


def backlog(changes: DataFrame, shipped: DataFrame) -> DataFrame:
    """Captured events not shipped yet: their number and estimated bytes."""
    left = changes.join(
        shipped.select(*SHARD_KEY, "seq_no").distinct(), [*SHARD_KEY, "seq_no"], "left_anti"
    )
    return left.agg(
        F.count(F.lit(1)).alias("queue_size"),
        F.coalesce(F.sum(event_size()), F.lit(0)).alias("queue_bytes"),
    )
