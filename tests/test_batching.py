import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changelake.functions.columns import change_line
from changelake.operators import batching
from changelake.plans.ordered import number_rows
from changelake.sources.storage import scratch_dir
from helpers import change, changes, delivery, deliveries, tuples


def pack_by_hand(sizes, max_events, max_bytes):
    out, number, count, size = [], 0, 0, 0
    for s in sizes:
        if count >= max_events or size >= max_bytes:
            number, count, size = number + 1, 0, 0
        count, size = count + 1, size + s
        out.append(number)
    return out


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(100, 900), min_size=1, max_size=60),
    st.integers(1, 8),
    st.integers(100, 3000),
    st.integers(1, 20),
)
def test_walking_segments_equals_one_fold(sizes, max_events, max_bytes, width):
    """Entry states from segment summaries reproduce the sequential fold."""
    state, got = (0, 0, 0), []
    for at in range(0, len(sizes), width):
        part = sizes[at : at + width]
        count, size, number = state
        for s in part:
            if count >= max_events or size >= max_bytes:
                count, size, number = 0, 0, number + 1
            count, size = count + 1, size + s
            got.append(number)
        summary = batching.summarise_segment(np.array(part), max_events, max_bytes)
        state = batching.through_segment(state, summary, max_events, max_bytes)
    assert got == pack_by_hand(sizes, max_events, max_bytes)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(100, 900), min_size=1, max_size=60),
    st.integers(1, 8),
    st.integers(100, 3000),
    st.integers(1, 20),
)
def test_batch_begins_equal_one_fold(sizes, max_events, max_bytes, width):
    """Places found by pointer doubling, segment by segment, give the sequential fold."""
    state, got = (0, 0, 0), []
    for at in range(0, len(sizes), width):
        part = np.array(sizes[at : at + width])
        places, numbers = batching.batch_begins(part, state, max_events, max_bytes)
        got += numbers[np.searchsorted(places, np.arange(len(part)), "right") - 1].tolist()
        state = batching.through_segment(state, batching.summarise_segment(part, max_events, max_bytes), max_events, max_bytes)
    assert got == pack_by_hand(sizes, max_events, max_bytes)


def _log(n, seed=3):
    rng = random.Random(seed)
    rows, seqs = [], {}
    for i in range(n):
        shard = 0 if rng.random() < 0.7 else rng.randrange(1, 4)
        seq = seqs[shard] = seqs.get(shard, -1) + 1
        rows.append(
            change(f"d{rng.randrange(20)}", seq, shard=shard, source='{"x":"' + "y" * rng.randrange(80) + '"}', ts=i * 10)
        )
    return rows


@pytest.mark.parametrize("rows_per_segment", [1_000_000, 13])
@pytest.mark.parametrize("age_ms", [400, 10_000])
def test_pack_batches(spark, rows_per_segment, age_ms):
    rows = _log(300)
    got = batching.pack_batches(
        changes(spark, rows).repartition(5), 6, age_ms, 700, rows_per_segment=rows_per_segment
    )
    got = {(r.shard_id, r.seq_no): (r.age_window, r.batch_no) for r in got.collect()}
    groups = {}
    for r in sorted(rows, key=lambda r: r["seq_no"]):
        groups.setdefault((r["shard_id"], r["timestamp_ms"] // age_ms), []).append(r)
    want = {}
    for (shard, window), members in groups.items():
        sizes = [100 + 4 + len(r["id"]) + len(r["source"]) for r in members]
        for r, b in zip(members, pack_by_hand(sizes, 6, 700)):
            want[(shard, r["seq_no"])] = (window, b)
    assert got == want


def test_pack_large_batches(spark):
    """Batches of 100,000 events over cut groups, with events that agree in all but the body."""
    rows = spark.range(260_000).select(
        F.lit("logs").alias("index"),
        F.concat(F.lit("d"), (F.col("id") % 7).cast("string")).alias("id"),
        F.concat(F.lit('{"v":'), (F.col("id") % 10).cast("string"), F.lit("}")).alias("source"),
        F.expr("id div 2").alias("seq_no"),
        F.lit(1).cast("long").alias("primary_term"),
        F.lit("INDEX").alias("op_type"),
        F.lit(None).cast("string").alias("routing"),
        F.lit(0).alias("shard_id"),
        F.lit(0).cast("long").alias("timestamp_ms"),
    )
    for width in (1_000_000, 30_000):
        got = batching.pack_batches(rows, 100_000, 1000, 1 << 40, rows_per_segment=width)
        sizes = got.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n"), F.min("seq_no").alias("a")).orderBy("batch_no")
        assert [tuple(r) for r in sizes.collect()] == [(0, 100_000, 0), (1, 100_000, 50_000), (2, 60_000, 100_000)]


def test_pack_keeps_bodies_out_of_python(spark):
    """Only the skeleton goes through Python, and the events are shuffled once."""
    stored = f"{scratch_dir(spark, 'pack')}/changes"
    changes(spark, _log(40)).write.parquet(stored)
    got = batching.pack_batches(spark.read.parquet(stored))
    plan = got._jdf.queryExecution().executedPlan().toString()
    nodes = [line for line in plan.split("\n") if "MapInArrow" in line]
    assert nodes and not any("source" in line for line in nodes)
    lines = plan.split("\n")
    bodies = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and "source#" in "".join(lines[i + 1 : i + 2])]
    assert len(bodies) == 1


def test_pack_keeps_every_column(spark):
    rows = changes(spark, _log(40))
    got = batching.pack_batches(rows)
    assert set(rows.columns) | {"age_window", "batch_no"} == set(got.columns)
    assert tuples(got, *rows.columns) == tuples(rows, *rows.columns)


@pytest.mark.parametrize("rows_per_segment", [1_000_000, 7])
def test_batch_by_count(spark, rows_per_segment):
    rows = _log(120)
    got = batching.batch_by_count(changes(spark, rows), 9, rows_per_segment)
    assert all(r.batch_no == r.seq_no // 9 for r in got.collect())


@pytest.mark.parametrize("unique_lead", [True, False])
def test_number_rows_across_segments(spark, unique_lead):
    n = 500
    df = spark.range(n).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("g"), (F.col("id") * 7).alias("o")
    )
    got = number_rows(df.repartition(7), ["g"], ["o"], "o", "no", unique_lead, rows_per_segment=20)
    seen = {}
    for r in got.orderBy("o").collect():
        assert r.no == seen.setdefault(r.g, 0)
        seen[r.g] += 1
    assert sum(seen.values()) == n


def test_bulk_slices_follow_arrival(spark):
    rows = [delivery(20 - i, "b1", 0, id=f"d{i}", seq=i) for i in range(7)]
    got = batching.bulk_sub_batches(deliveries(spark, rows), 3)
    assert [r.slice_no for r in got.orderBy("arrival").collect()] == [0, 0, 0, 1, 1, 1, 2]


def test_manifest(spark):
    rows = [change("a", 4, term=1), change("b", 7, term=3), change("c", 5, "DELETE", term=2)]
    batched = changes(spark, rows).withColumn("batch_no", F.lit(0))
    size = sum(len(r[0]) + 1 for r in batched.select(change_line()).collect())
    assert batching.batch_manifest(batched, base="/x", suffix=".ndjson.gz").first().asDict() == {
        "s3_key": "x/logs/0/3_4_7.ndjson.gz",
        "event_count": 3,
        "from_seq_no": 4,
        "to_seq_no": 7,
        "primary_term": 3,
        "index": "logs",
        "shard_id": 0,
        "payload_bytes": size,
    }


def test_backlog_and_ship_metrics(spark):
    rows = changes(spark, [change("a", i) for i in range(4)])
    left = batching.backlog(rows, rows.filter("seq_no < 3")).first()
    assert left.queue_size == 1 and left.queue_bytes == 100 + 4 + 1 + 7
    assert batching.backlog(rows, rows).first().asDict() == {"queue_size": 0, "queue_bytes": 0}
    manifest = batching.batch_manifest(rows.withColumn("batch_no", F.col("seq_no") % 2))
    got = batching.ship_metrics(manifest.filter("from_seq_no = 0"), manifest).first()
    assert (got.batches_shipped, got.events_shipped, got.ship_failures) == (1, 2, 1)
