import random

import pytest
from pyspark.sql import functions as F

from changelake.operators import checkpoint, replay
from changelake.schema import CHECKPOINTS, REPLICA
from helpers import change, changes, deliveries, delivery, tuples


def random_deliveries(n=300, seed=1, docs=12):
    """Deliveries of a log in random order, some twice, most of them for one document."""
    rng = random.Random(seed)
    log = []
    for seq in range(n):
        doc = "hot" if rng.random() < 0.5 else f"d{rng.randrange(docs)}"
        op = "DELETE" if rng.random() < 0.2 else "INDEX"
        log.append(change(doc, seq, op, source=f'{{"v":{seq}}}', term=1 + seq // 200))
    log += rng.sample(log, n // 5)
    rng.shuffle(log)
    return [r | {"arrival": i // 4, "batch_key": f"b{i // 20:02d}", "line_no": i % 4} for i, r in enumerate(log)]


def fold(rows, stored=(), rejected=lambda r: False):
    """Replay one by one: (verdicts, versions)."""
    state, verdicts = dict(stored), []
    for r in sorted(rows, key=lambda r: (r["arrival"], r["batch_key"], r["line_no"])):
        if rejected(r):
            verdicts.append((r["id"], r["seq_no"], r["arrival"], r["line_no"], "FAILED"))
            continue
        ok = r["seq_no"] + 1 > state.get(r["id"], (0,))[0]
        if ok:
            state[r["id"]] = (r["seq_no"] + 1, r["op_type"], r["source"])
        verdicts.append((r["id"], r["seq_no"], r["arrival"], r["line_no"], "APPLIED" if ok else "CONFLICT"))
    return sorted(verdicts, key=repr), state


def as_state(df):
    return {r.id: (r.version, r.op_type, r.source) for r in df.collect()}


@pytest.mark.parametrize("rows_per_segment", [1_000_000, 11])
def test_verdicts_equal_one_by_one_replay(spark, rows_per_segment):
    rows = random_deliveries()
    want, state = fold(rows, rejected=lambda r: r["seq_no"] % 13 == 5)
    got = replay.replay_verdicts(
        deliveries(spark, rows), rejected=F.col("seq_no") % 13 == 5, rows_per_segment=rows_per_segment
    )
    assert tuples(got, "id", "seq_no", "arrival", "line_no", "verdict") == want
    assert as_state(replay.latest_state(got.filter("verdict = 'APPLIED'"))) == state


@pytest.mark.parametrize("rows_per_segment", [1_000_000, 11])
def test_verdicts_on_a_stored_replica(spark, rows_per_segment):
    rows = random_deliveries()
    early, late = rows[:150], rows[150:]
    _, state = fold(early)
    want, final = fold(late, state)
    stored = replay.latest_state(deliveries(spark, early))
    got = replay.replay_verdicts(deliveries(spark, late), stored, rows_per_segment=rows_per_segment)
    assert tuples(got, "id", "seq_no", "arrival", "line_no", "verdict") == want
    assert as_state(replay.apply_changes(stored, deliveries(spark, late))) == final


def test_a_state_of_the_deliveries_only_is_not_joined_with_them(spark):
    rows = random_deliveries()
    _, state = fold(rows[:150])
    want, _ = fold(rows[150:], state)
    late = deliveries(spark, rows[150:])
    stored = replay.latest_state(deliveries(spark, rows[:150])).join(late.select("id").distinct(), "id", "left_semi").localCheckpoint()
    got = replay.replay_verdicts(late, stored, None, None, True)
    assert tuples(got, "id", "seq_no", "arrival", "line_no", "verdict") == want
    assert "LeftSemi" not in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("seed", range(3))
def test_latest_state_ignores_order_and_repeats(spark, seed):
    rows = random_deliveries()
    want = as_state(replay.latest_state(deliveries(spark, rows)))
    rng = random.Random(seed)
    again = [dict(r) for r in rows + rng.sample(rows, 50)]
    rng.shuffle(again)
    again = [r | {"arrival": i} for i, r in enumerate(again)]
    assert as_state(replay.latest_state(deliveries(spark, again).repartition(1 + seed))) == want


def test_tombstones_and_absent_documents(spark):
    rows = changes(spark, [change("a", 0), change("a", 1, "DELETE"), change("b", 5, "DELETE")])
    state = replay.latest_state(rows)
    assert tuples(state, "id", "version", "op_type", "source") == [
        ("a", 2, "DELETE", None),
        ("b", 6, "DELETE", None),
    ]
    assert replay.live_docs(state).count() == 0
    # A late older write does not bring a deleted document back.
    assert as_state(replay.apply_changes(state, changes(spark, [change("a", 0)])))["a"][1] == "DELETE"


def test_equal_version_keeps_what_is_stored(spark):
    stored = replay.latest_state(changes(spark, [change("a", 3, source='{"old":1}')]))
    got = replay.apply_changes(stored, changes(spark, [change("a", 3, source='{"new":1}')]))
    assert as_state(got)["a"][2] == '{"old":1}'


def test_same_id_in_two_shards_is_two_documents(spark):
    state = replay.latest_state(changes(spark, [change("a", 9, shard=0), change("a", 1, shard=1)]))
    assert tuples(state, "shard_id", "version") == [(0, 10), (1, 2)]


def test_bootstrap(spark):
    snapshot = spark.createDataFrame(
        [("logs", 0, "a", '{"s":1}'), ("logs", 0, "b", '{"s":2}'), (".sys", 0, "c", "{}")],
        "index string, shard_id int, id string, source string",
    )
    state = replay.bootstrap(snapshot, changes(spark, [change("a", 0, source='{"n":1}')]))
    assert tuples(state, "id", "version", "source") == [("a", 1, '{"n":1}'), ("b", 0, '{"s":2}')]
    assert state.columns == REPLICA.fieldNames()


def test_summary_takes_the_term_of_the_highest_sequence(spark):
    rows = [
        delivery(1, "b", 0, id="a", seq=9, term=1),
        delivery(1, "b", 1, id="b", seq=2, term=7),
        delivery(1, "b", 2, id="a", seq=9, term=4),
    ]
    got = replay.replay_summary(replay.replay_verdicts(deliveries(spark, rows))).first()
    assert got.asDict() == {
        "batch_key": "b",
        "succeeded": 2,
        "version_conflicts": 1,
        "failed": 0,
        "max_seq_no": 9,
        "max_primary_term": 1,
    }


def test_checkpoint_passes_failed_events(spark):
    rows = [delivery(i, "b", 0, id=f"d{i}", seq=i) for i in range(5)]
    verdicts = replay.replay_verdicts(deliveries(spark, rows), rejected=F.col("seq_no") == 4)
    got = checkpoint.checkpoint_update(verdicts).first()
    assert (got.last_seq_no, got.events_replayed) == (4, 4)


def test_merge_checkpoints(spark):
    def table(*rows):
        return spark.createDataFrame(list(rows), CHECKPOINTS)

    old = table(("logs", 0, 10, 2, 100, 5), ("logs", 1, 3, 1, 7, 5), ("shop", 0, 8, 1, 1, 1))
    new = table(("logs", 0, 10, 9, 4, 6), ("logs", 1, 5, 2, 2, 6), ("shop", 0, 2, 9, 1, 6), ("new", 0, 0, 1, 1, 6))
    got = tuples(checkpoint.merge_checkpoints(old, new), *CHECKPOINTS.fieldNames())
    assert got == [
        ("logs", 0, 10, 2, 104, 6),
        ("logs", 1, 5, 2, 9, 6),
        ("new", 0, 0, 1, 1, 6),
        ("shop", 0, 8, 1, 2, 6),
    ]
    positions = lambda df: tuples(df, "index", "shard_id", "last_seq_no", "events_replayed")
    assert positions(checkpoint.merge_checkpoints(new, old)) == positions(checkpoint.merge_checkpoints(old, new))


def test_pending_batches(spark):
    announced = spark.createDataFrame([("a",), ("b",), ("c",)], "s3_key string")
    processed = spark.createDataFrame([("a", 0), ("b", 2)], "s3_key string, failed int")
    assert tuples(checkpoint.pending_batches(announced, processed), "s3_key") == [("b",), ("c",)]


def test_bulk_actions(spark):
    rows = changes(spark, [change('q"\\\n', 4, routing="r"), change("d", 5, "DELETE")])
    got = sorted(r.bulk for r in replay.render_bulk_actions(rows).collect())
    assert got == [
        '{"delete":{"_index":"logs","_id":"d","version":6,"version_type":"external"}}',
        '{"index":{"_index":"logs","_id":"q\\"\\\\\\n","version":5,"version_type":"external","routing":"r"}}\n{"a":1}',
    ]
