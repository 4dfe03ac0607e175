import random

from pyspark.sql import functions as F

from changelake.functions.columns import base_path, compact_json, event_size, index_filter, name_list
from changelake.operators import capture
from helpers import change, changes, ops, tuples


def kept(spark, names, include=None, exclude=None):
    df = spark.createDataFrame([(n,) for n in names], "index string")
    return {r[0] for r in df.filter(index_filter(include, exclude)).collect()}


def test_index_filter_rules(spark):
    names = [".sys", "logs-a", "logs-b", "shop", "log*"]
    assert kept(spark, names) == {"logs-a", "logs-b", "shop", "log*"}
    assert kept(spark, names, include=".sys, logs-a") == {"logs-a"}
    assert kept(spark, names, include="logs-*") == {"logs-a", "logs-b"}
    assert kept(spark, names, include="*") == {"logs-a", "logs-b", "shop", "log*"}
    assert kept(spark, names, include="logs-*", exclude="logs-b") == {"logs-a"}
    # Exclusion has no wildcards.
    assert kept(spark, names, exclude="logs-*") == {"logs-a", "logs-b", "shop", "log*"}
    assert kept(spark, names, include=" , ,") == {"logs-a", "logs-b", "shop", "log*"}


def test_name_list_and_base_path():
    assert name_list(" a, b,,a ") == ["a", "b"]
    assert name_list(None) == [] and name_list("  ") == []
    assert base_path("/x/y") == "x/y/" and base_path("") == "" and base_path("x/") == "x/"


def test_event_size(spark):
    rows = changes(spark, [change(id="abc", index="ix", source='{"a":1}', routing="r"), change(id="abc", index="ix", op="DELETE")])
    assert [r[0] for r in rows.select(event_size()).collect()] == [100 + 2 + 3 + 7 + 1, 105]


def test_compact_json(spark):
    texts = [
        '{ "a" : 1,\n\t"b": [1, 2] }',
        '{"a b": "x  y\\" \\\\", "c" : "\\\\\\" z" }',
        "{}",
        '{"n": 1.50, "e": 1e5}',
        '{"long": "' + "x " * 20000 + '" }',
    ]
    want = [
        '{"a":1,"b":[1,2]}',
        '{"a b":"x  y\\" \\\\","c":"\\\\\\" z"}',
        "{}",
        '{"n":1.50,"e":1e5}',
        '{"long":"' + "x " * 20000 + '"}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(compact_json(F.col("t"))).collect()] == want


def routing_by_hand(requests, deletes):
    """The request map: put replaces, read removes."""
    waiting, out = {}, []
    steps = [(n, 0, k, r) for n, k, r in requests] + [(n, 1, k, None) for n, k in deletes]
    for n, kind, k, r in sorted(steps, key=lambda s: s[:2]):
        if kind == 0:
            if r is not None:
                waiting[k] = r
        else:
            out.append((n, k, waiting.pop(k, None)))
    return sorted(out), waiting


def routed(spark, requests, deletes, **kw):
    asked = spark.createDataFrame(
        [("logs", k, n, r) for n, k, r in requests], "index string, id string, op_no long, routing string"
    )
    done = spark.createDataFrame([("logs", k, n) for n, k in deletes], "index string, id string, op_no long")
    got = capture.delete_routing(asked, done, **kw)
    left = capture.unclaimed_requests(asked, done)
    return sorted((r.op_no, r.id, r.routing) for r in got.collect()), {
        r.id: r.routing for r in left.collect()
    }


def test_delete_routing_rules(spark):
    requests = [(1, "a", "r1"), (2, "a", "r2"), (5, "b", "rb"), (7, "b", None), (9, "c", "rc")]
    deletes = [(3, "a"), (4, "a"), (6, "b"), (8, "b")]
    assert routed(spark, requests, deletes) == (
        [(3, "a", "r2"), (4, "a", None), (6, "b", "rb"), (8, "b", None)],
        {"c": "rc"},
    )


def test_delete_routing_against_the_map_with_hot_documents(spark):
    rng = random.Random(7)
    steps = [(n, "hot" if rng.random() < 0.6 else f"d{rng.randrange(9)}") for n in range(400)]
    requests, deletes = [], []
    for n, k in steps:
        if rng.random() < 0.5:
            requests.append((n, k, f"r{n}"))
        if rng.random() < 0.6:
            deletes.append((n, k))
    want = routing_by_hand(requests, deletes)
    assert routed(spark, requests, deletes) == want
    assert routed(spark, requests, deletes, rows_per_segment=7) == want


def test_capture_changes(spark):
    rows = ops(
        spark,
        [
            (1, "SUCCESS", change("a", 0, routing="ra")),
            (2, "FAILURE", change("a", None, "DELETE", routing="leaked")),
            (3, "SUCCESS", change("a", 1, "DELETE")),
            (4, "SUCCESS", change("a", 2, "DELETE")),
            (5, "FAILURE", change("b", None)),
            (6, "SUCCESS", change("x", 0, index=".sys")),
            (7, "SUCCESS", change("n", 3, source=None)),
        ],
    )
    got = tuples(capture.capture_changes(rows), "id", "seq_no", "op_type", "source", "routing")
    assert got == [
        ("a", 0, "INDEX", '{"a":1}', "ra"),
        ("a", 1, "DELETE", None, "leaked"),
        ("a", 2, "DELETE", None, None),
    ]
    assert capture.capture_metrics(rows).first().asDict() == {
        "captured_ops": 3,
        "skipped_ops": 1,
        "failed_ops": 1,
    }


def test_waiting_request_of_an_earlier_run_is_used(spark):
    rows = ops(spark, [(10, "SUCCESS", change("a", 1, "DELETE"))])
    waiting = spark.createDataFrame([("logs", "a", 4, "early")], "index string, id string, op_no long, routing string")
    assert tuples(capture.capture_changes(rows, waiting=waiting), "id", "routing") == [("a", "early")]
