"""Periodic runs, license scans and hard negatives against brute-force versions, and their queries against SQL."""

import collections
import glob
import os
import random
import re

import duckdb
import numpy as np
import pytest
from llm_helpers import WORD, edge_docs
from pyspark.sql import functions as F

from llm import decontaminate, licenses, negatives, oracle, queries, runs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return edge_docs(spark).persist()


@pytest.mark.parametrize("name", sorted(oracle.ORACLES))
def test_query_like_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    want = con.execute(oracle.ORACLES[name])
    columns = [d[0] for d in want.description]
    found = queries.QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(found.columns)
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, found.select(columns).collect()), key=key) == sorted(want.fetchall(), key=key)


def test_rows_that_share_an_id(spark):
    """Contamination is judged row by row, also in several scans and where ids are equal or null."""
    leak = " ".join(f"q{i}" for i in range(12))
    rows = [(1, "clean words only"), (1, f"a b {leak} c"), (None, leak), (None, None), (2, ""), (2, leak)]
    table = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, _found string, key int")
    bench = spark.createDataFrame([("b1", leak), ("b2", "q3 q4"), ("b3", None)], "item_id string, text string")
    for part_bytes in (decontaminate.PART_BYTES, 40):
        got = decontaminate.decontaminate(table, bench, part_bytes=part_bytes).collect()
        key = lambda r: (r[0] or 0, *r[1:])
        found = sorted(((r.id, r.n_words, r.n_hit, tuple(r["items"])) for r in got), key=key)
        both = ("b1", "b2")
        want = [(None, 0, 0, ()), (None, 12, 12, both), (1, 3, 0, ()), (1, 15, 12, both), (2, 0, 0, ()), (2, 12, 12, both)]
        assert found == sorted(want, key=key)
        clean = decontaminate.without_leaks(table, bench, part_bytes=part_bytes)
        assert clean.columns == table.columns
        assert sorted((r.doc_id or 0, r.text or "") for r in clean.collect()) == [(0, ""), (1, "clean words only"), (2, "")]


# --- op11


def plain_runs(x):
    """Every run by comparing all words with those q further, for all q."""
    least = {}
    for q in range(1, len(x) // 3 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                least.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in least.items())


def test_runs():
    rng = random.Random(3)
    seen = 0
    for _ in range(400):
        kinds, x = rng.choice([1, 2, 3, 5, 50]), []
        while len(x) < rng.choice([10, 30, 100, 400]):
            if rng.random() < 0.6:
                word = [rng.randrange(kinds) for _ in range(rng.randint(1, rng.choice([3, 12, 60])))]
                x += (word * 9)[: rng.randint(len(word), 9 * len(word))]
            else:
                x += [rng.randrange(kinds) for _ in range(rng.randint(1, 20))]
        numbers = np.unique(x, return_inverse=True)[1]
        want = plain_runs(x)
        assert runs.find_runs(numbers) == want
        kept = [i for i in range(len(x)) if not any(a + q <= i < a + n for a, n, q in want)]
        assert np.flatnonzero(runs.collapsed(len(x), want)).tolist() == kept
        seen += len(want)
    assert seen > 200


@pytest.mark.parametrize("top", [3, 70_000, (1 << 31) - 1])
def test_matches_are_exact(top):
    """Large word numbers need several primes; no sum of squares may pass for zero."""
    rng = np.random.default_rng(top)
    words = rng.integers(0, top, 300).astype(np.uint64)
    words[100:200] = words[60:160]
    for length, first in ((8, 1), (32, 32), (64, 64)):
        starts = np.arange(0, len(words) - length, length)
        s, d = runs._matches(words, starts, length, first, runs._enough(length * top**2))
        want = [
            (a, k)
            for a in starts.tolist()
            for k in range(first, 2 * length)
            if a + k + length <= len(words) and (words[a : a + length] == words[a + k : a + k + length]).all()
        ]
        assert sorted(zip(s.tolist(), d.tolist())) == want
    assert len(runs._enough(length * ((1 << 31) - 1) ** 2)) > 1


def test_runs_long():
    rng = np.random.default_rng(1)
    word = rng.integers(0, 9000, 50_000)
    x = np.concatenate([rng.integers(0, 9000, 1234), word, word, word, word[:77]])
    found = runs.find_runs(np.unique(x, return_inverse=True)[1])
    assert [(n // q, q) for a, n, q in found] == [(3, 50_000)] and found[0][0] <= 1234
    assert runs.find_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]


def test_runs_edges(spark, docs):
    table = docs.withColumn("found", F.lit(1)).withColumn("words", F.lit("w"))
    rows = runs.periodic_runs(table, out_col="periods").collect()
    assert len(rows) == docs.count()
    assert runs.periodic_runs(table, out_col="periods").columns == [*table.columns, "periods"]
    for r in rows:
        words = WORD.findall(r.text or "")
        want = plain_runs(words) if len(words) < 3000 else [(0, len(words), 60)] if r.text.startswith(r.text[:40]) else None
        assert r.periods.n_words == len(words)
        if len(words) < 3000:
            assert [tuple(p) for p in r.periods.runs] == want
            gone = {i for a, n, q in want for i in range(a + q, a + n)}
            assert r.periods.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)
    giant = next(r for r in rows if r.doc_id == 43)
    assert len(giant.periods.runs) >= 1 and len(giant.periods.collapsed.split()) < 200
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_greatest(spark):
    cases = [([], None), ([(0, 30, 10), (5, 24, 8), (9, 31, 10)], (9, 31, 10)), ([(3, 30, 10), (3, 60, 20), (7, 90, 30)], (3, 30, 10))]
    table = spark.createDataFrame([(c,) for c, _ in cases], "runs array<struct<start: long, length: long, period: long>>")
    got = [r[0] and tuple(r[0]) for r in table.select(runs.greatest(F.col("runs"))).collect()]
    assert got == [want for _, want in cases]


# --- op12


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_notices(text, templates, percent):
    """(line, lines, label, share) by comparing every block with every template."""
    lines = [plain_words(x) for x in (text or "").split("\n")]
    blocks = [(i, 1) for i, ws in enumerate(lines) if ws]
    i = 0
    while i < len(lines):
        j = i
        while j < len(lines) and lines[j]:
            j += 1
        if j - i > 1:
            blocks.append((i, j - i))
        i = max(j, i + 1)
    sets = [(label, set(plain_words(t))) for label, t in templates if plain_words(t)]
    found = []
    for at, n in blocks:
        own = {w for ws in lines[at : at + n] for w in ws}
        held = [(label, ws) for label, ws in sets if 100 * len(ws & own) >= percent * len(ws)]
        found += [(at, n, label, len(ws & own) / len(ws)) for label, ws in held if not any(ws < other for _, other in held)]
    return sorted(found)


@pytest.mark.parametrize("percent", [40, 75, 90, 100])
def test_licenses(spark, percent):
    rng = random.Random(percent)
    words = [f"w{i}" for i in range(30)] + ["Über", "b-c", "the"]
    some = lambda k: " ".join(rng.choice(words) for _ in range(k))
    templates = [(f"t{i % 7}", some(rng.randint(1, 14))) for i in range(15)] + [("none", " ., "), ("t0", "the"), ("wide", some(60))]
    texts = [None, "", "\n\n", " . \n", "MIT License apache-license the general public LICENSE", "mit license mit license", "limit license"]
    texts += ["\n".join(some(rng.randint(0, 12)) for _ in range(rng.randint(1, 9))) for _ in range(80)]
    texts += [templates[3][1], templates[3][1], "x\n\n" + templates[16][1].replace(" ", " *\n * ", 3)]
    table = spark.createDataFrame([(i, t, 0.0, "k") for i, t in enumerate(texts)], "doc_id long, text string, license double, key string")
    rows = {r.doc_id: r for r in licenses.scan(table.repartition(3), templates=tuple(templates), percent=percent).collect()}
    assert len(rows) == len(texts) and list(rows[0].asDict()) == ["doc_id", "text", "key", "license"]
    seen = 0
    for i, text in enumerate(texts):
        own, got = plain_words(text or ""), rows[i].license
        places = [
            (k, label)
            for phrase, label in licenses.PHRASES.items()
            for k in range(len(own))
            if own[k : k + len(phrase.split())] == phrase.split()
        ]
        assert (got.n_words, got.n_base) == (len(own), len(places))
        assert (got.first_word, got.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        want = plain_notices(text, templates, percent)
        assert sorted(tuple(n) for n in got.notices) == want
        assert got.labels == sorted({label for _, label in places} | {n[2] for n in want})
        assert got.score == (1.0 if places else max((n[3] for n in want), default=0.0))
        seen += len(want)
    assert seen > 5


def test_licenses_notices(spark):
    text = """# Copyright someone
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.

Licensed under CC BY-NC 4.0."""
    table = spark.createDataFrame([(1, text), (2, "Licensed under a permit"), (None, text)], "doc_id long, text string")
    rows = {r.doc_id: r.license for r in licenses.scan(table).collect()}
    assert rows[1].labels == ["apache", "cc-by-nc"] and rows[1].base == ["apache"] and rows[1].score == 1.0
    assert [(n.line, n.lines, n.label) for n in rows[1].notices] == [(0, 3, "apache"), (4, 1, "cc-by-nc")]
    assert rows[2].labels == [] and rows[2].score == 0.0 and rows[None] == rows[1]


def test_licenses_edges(spark, docs):
    assert licenses.scan(docs).count() == docs.count() and licenses.scan(docs.limit(0)).count() == 0
    bare = licenses.scan(docs, phrases={}, templates=()).collect()
    assert all(r.license.labels == [] and r.license.score == 0 for r in bare)
    with pytest.raises(ValueError):
        licenses.Templates((("x", "y" * (licenses.TEMPLATE_BYTES + 1)),), 90)


# --- op13


def plain_negatives(rows, anchors):
    """Brute force over (id, label, integers)."""
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    found = []
    for i, label, v in rows:
        if not anchors(i):
            continue
        order = sorted((-score(v, w), j) for j, other, w in rows if other == label and j != i)[:5]
        for minus, j in order:
            bad = sorted((-score(v, w), k) for k, other, w in rows if other != label and 50 * -minus <= 100 * score(v, w) <= 95 * -minus)
            found += [(i, j, r + 1, k, -minus, -s) for r, (s, k) in enumerate(bad[:3])]
    return collections.Counter(found)


@pytest.mark.parametrize("shape", [{}, {"leaf": 12, "fanout": 3, "group": 9, "candidates": 5}, {"leaf": 1, "fanout": 2, "group": 40}])
def test_negatives(spark, shape):
    """Clusters, copies, a hot vector, opposite and zero vectors, large numbers, against all pairs."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((6, 5))
    rows = []
    for i in range(260):
        v = centres[i % 6] + 0.3 * rng.standard_normal(5)
        if i % 11 == 0:
            v = centres[0]
        if i % 37 == 0:
            v = -v
        rows.append((i, int(rng.integers(0, 4)), v.tolist()))
    rows += [(300 + i, i % 3, centres[1].tolist()) for i in range(60)] + [(400, 1, [0.0] * 5), (401, 2, []), (402, 2, [1.0]), (403, 1, [3e5] * 5)]
    odd = [(500, 1, None), (501, None, [1.0] * 5), (None, 1, [1.0] * 5), (503, 1, [float("nan")] * 5), (504, 2, [1.0, None]), (505, 2, [1e300] * 5)]
    table = spark.createDataFrame([(*r, 0.0, "x") for r in rows + odd], "vec_id long, label int, embedding array<double>, score double, node string")
    anchors = lambda i: i % 10 == 0 or i == 403
    mined = negatives.mine(table.repartition(3), (F.col("vec_id") % 10 == 0) | (F.col("vec_id") == 403), **shape)
    whole = [(i, label, [int(np.floor(256 * x)) for x in v] + [0] * (5 - len(v))) for i, label, v in rows]
    want = plain_negatives(whole, anchors)
    assert collections.Counter(map(tuple, mined.collect())) == want and len(want) > 100


def test_negatives_repeated_rows(spark):
    """A repeated row counts as often as it comes, but is no positive of itself."""
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.7, 0.2]), (2, 2, [0.7, 0.2])]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    found = sorted(map(tuple, negatives.mine(table, F.col("vec_id") == 0).collect()))
    assert [r[:4] for r in found] == [(0, 1, 1, 2)] * 2 + [(0, 1, 2, 2)] * 2
    assert negatives.mine(table, F.lit(False)).count() == 0
    assert negatives.mine(table.limit(0), F.col("vec_id") == 0).count() == 0


def test_tree_leaves_out(spark):
    """Far clusters: most leaves are not visited."""
    rng = np.random.default_rng(2)
    centres = 40 * rng.standard_normal((16, 8))
    rows = [(i, int(i % 2), (centres[i % 16] + rng.standard_normal(8)).tolist()) for i in range(1600)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    made = negatives.vectors(table, F.col("vec_id") % 50 == 0, "vec_id", "embedding", "label", 256)
    tree = negatives.Tree(made, 50, 4, 64, 100)
    assert tree.leaves.count() == 1600 and tree.leaves.select("row").distinct().count() == 1600
    home = tree.leaves.filter("anchor").drop("node", "n", "anchor")
    best = F.array((F.col("norm") * 0.999).cast("long"))
    visits = tree.visits(home.withColumn("low", best).withColumn("high", F.array(F.lit(1 << 61))))
    leaves = tree.leaves.select("node").distinct().count()
    assert leaves > 20 and 32 <= visits.count() < 32 * leaves / 3
