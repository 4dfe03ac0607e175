from pyspark.sql import functions as F

from changelake.operators import digests, metrics, reconcile, replay
from changelake.schema import CHECKPOINTS
from helpers import change, changes, tuples


def docs(spark, rows):
    return spark.createDataFrame(rows, "index string, shard_id int, id string, source string")


def test_reconcile_docs(spark):
    active = docs(spark, [("l", 0, "a", "1"), ("l", 0, "b", "1"), ("l", 0, "c", None)])
    passive = docs(spark, [("l", 0, "a", "1"), ("l", 0, "b", "2"), ("l", 0, "c", None), ("l", 0, "d", "1")])
    want = [("a", "MATCH"), ("b", "CONTENT_MISMATCH"), ("c", "MATCH"), ("d", "MISSING_ACTIVE")]
    assert tuples(reconcile.reconcile_docs(active, passive), "id", "status") == want
    flipped = tuples(reconcile.reconcile_docs(passive, active), "id", "status")
    assert flipped[-1] == ("d", "MISSING_PASSIVE")


def test_nested_bodies_are_compared_whole(spark):
    active = docs(spark, [("l", 0, "a", '{"x":{"y":1},"z":1}')])
    passive = docs(spark, [("l", 0, "a", '{"x":{"y":1},"z":2}')])
    assert reconcile.reconcile_docs(active, passive).first().status == "CONTENT_MISMATCH"


def test_reconcile_counts(spark):
    active = docs(spark, [("l", 0, "a", "1"), ("m", 0, "b", "1")])
    passive = docs(spark, [("l", 0, "a", "1"), ("n", 0, "b", "1")])
    got = tuples(reconcile.reconcile_counts(active, passive), "index", "active", "passive", "status", "in_sync")
    # Totals agree although collections do not: not in sync.
    assert got == [
        ("TOTAL", 2, 2, "MATCH", False),
        ("l", 1, 1, "MATCH", None),
        ("m", 1, 0, "MISMATCH", None),
        ("n", 0, 1, "MISMATCH", None),
    ]
    same = reconcile.reconcile_counts(active, active).filter("index = 'TOTAL'").first()
    assert same.in_sync
    none = docs(spark, [])
    assert [tuple(r) for r in reconcile.reconcile_counts(none, none).collect()] == [
        ("TOTAL", 0, 0, "MATCH", False)
    ]


def test_spot_check_covers_both_sides(spark):
    active = docs(spark, [("l", 0, f"d{i}", "1") for i in range(30)])
    passive = active.filter(F.col("id") != "d3").unionByName(docs(spark, [("l", 0, "extra", "1")]))
    got = reconcile.spot_check(active, passive, n=100)
    assert tuples(got, "id", "status") == tuples(reconcile.reconcile_docs(active, passive), "id", "status")
    some = reconcile.spot_check(active, passive, n=7)
    assert some.count() == 7
    assert tuples(some, "id", "status") == tuples(reconcile.spot_check(active, passive, n=7), "id", "status")


def test_lag_and_gaps(spark):
    log = changes(spark, [change("a", i) for i in range(10)])
    seen = changes(spark, [change("a", i) for i in (2, 3, 3, 6, 9)])
    checkpoints = spark.createDataFrame([("logs", 0, 9, 1, 5, 0)], CHECKPOINTS)
    assert reconcile.replication_lag(log, checkpoints).first().lag == 0
    for width in (1_000_000, 4, 1):
        got = tuples(reconcile.sequence_gaps(seen, width), "gap_from", "gap_to", "missing")
        assert got == [(0, 1, 2), (4, 5, 2), (7, 8, 2)]
    none = spark.createDataFrame([], CHECKPOINTS)
    assert reconcile.replication_lag(log, none).first().lag == 10


def test_consumer_metrics(spark):
    rows = spark.createDataFrame(
        [(5, 0, 1), (5, 2, 2), (0, None, 3), (None, None, 4)], "events long, failed long, polled_ms long"
    )
    assert metrics.consumer_metrics(rows).first().asDict() == {
        "batches_processed": 1,
        "batches_failed": 2,
        "last_poll_ms": 4,
    }


def test_status_hides_metrics_while_stopped(spark):
    m = spark.range(1).select(F.lit(3).alias("captured_ops"))
    up = metrics.replication_status(spark, "producer", True, [m])
    assert tuples(up, "section", "metric", "value") == [
        ("producer", "captured_ops", "3"),
        ("replication", "role", "producer"),
        ("replication", "running", "true"),
    ]
    assert metrics.replication_status(spark, "producer", False, [m]).count() == 2


def test_live_copy_after_full_replay_is_in_sync(spark):
    log = changes(spark, [change(f"d{i % 5}", i, "DELETE" if i % 7 == 0 else "INDEX") for i in range(40)])
    live = replay.live_docs(replay.latest_state(log))
    twice = replay.live_docs(replay.apply_changes(replay.latest_state(log), log))
    assert reconcile.reconcile_docs(live, twice).filter("status <> 'MATCH'").count() == 0


def test_white_space_in_a_body_is_no_difference(spark):
    from changelake.functions.columns import bulk_action
    from helpers import change, changes

    spaced = changes(spark, [change("d1", 0, source='{\n "a": 1.50,\t"b": "x  \\" y"}')])
    tight = changes(spark, [change("d1", 0, source='{"a":1.50,"b":"x  \\" y"}')])
    other = changes(spark, [change("d1", 0, source='{"a":1.5,"b":"x  \\" y"}')])
    assert [r.status for r in reconcile.reconcile_docs(spaced, tight).collect()] == ["MATCH"]
    assert [r.status for r in reconcile.reconcile_docs(spaced, other).collect()] == ["CONTENT_MISMATCH"]
    text = spaced.select(bulk_action()).first()[0]
    assert text == tight.select(bulk_action()).first()[0] and text.count("\n") == 1


def test_digest_tree_equals_the_join(spark):
    """Equal, changed, missing and empty copies, at several widths of the tree."""
    rows = [("l", i % 3, f"d{i}", f'{{"v": {i}}}') for i in range(60)]
    other = [(a, b, c, d.replace(" ", "")) for a, b, c, d in rows]  # no difference
    other[7] = (*other[7][:3], '{"v":-1}')
    other = [r for r in other if r[2] not in ("d20", "d21")] + [("l", 0, "new", "{}")]
    active, passive = docs(spark, rows), docs(spark, other)
    columns = ["id", "index", "shard_id", "status"]
    for left, right in ((active, passive), (passive, active), (active, active), (active, passive.limit(0)), (passive.limit(0), active.limit(0))):
        want = tuples(reconcile.reconcile_docs(left, right), *columns)
        for bits, step in ((8, 3), (16, 4), (1, 4)):
            assert tuples(digests.reconcile_by_digest(left, right, bits, step), *columns) == want
    leaves = [digests.digest_leaves(c, 8) for c in (active, passive)]
    changed = active.filter(F.col("id").isin("d7", "d20", "d21")).unionByName(docs(spark, [("l", 0, "new", "{}")]))
    want = {r[0] for r in changed.select(digests.leaf_of(8)).collect()}
    assert {r.leaf for r in digests.differing_leaves(*leaves, 8, 3).collect()} == want
    # a tree is the same whatever the order, and can be made of the leaves of its parts
    assert tuples(digests.rolled_up(leaves[0], 3), "leaf", "docs", "mixed", "total") == tuples(
        digests.digest_leaves(active.repartition(7), 5), "leaf", "docs", "mixed", "total"
    )


def test_failed_tries_are_counted_once_each(spark):
    rows = spark.createDataFrame([(2, 0, 5, 3), (None, None, 6, 2), (0, 0, 7, 0)], "events long, failed long, polled_ms long, failed_tries long")
    assert tuple(metrics.consumer_metrics(rows).first()) == (1, 5, 7)
    assert tuple(metrics.consumer_metrics(rows.drop("failed_tries")).first()) == (1, 1, 7)
