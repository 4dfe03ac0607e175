"""Operators on texts against brute-force versions."""

import collections
import hashlib
import math
import re
import tracemalloc
import zlib

import numpy as np
import pytest
import xxhash
from llm_helpers import WORD, edge_docs, lower, plain_fingerprint
from pyspark.sql import functions as F

from llm import decontaminate, lines, ngram, simhash, suffix
from llm.blocks import Blocks
from llm.common import _stars


@pytest.fixture(scope="module")
def docs(spark):
    return edge_docs(spark).persist()


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


# --- op1


def katz(train, every):
    """{text: (tokens, known, base, score)} by plain counting, and the number of training tokens."""
    tokens = lambda t: [w.encode() for w in WORD.findall(lower(t))] + [None]
    uni, bi = collections.Counter(), collections.Counter()
    for t in train:
        ws = tokens(t)
        uni.update(ws)
        bi.update(zip(["begin"] + ws[:-1], ws))

    def discounts(counter):
        often = np.array([sum(c == r for c in counter.values()) for r in range(1, ngram.K + 2)])
        return ngram.Counts(sum(counter.values()), len(counter), often).discounts()

    d1, d2 = discounts(uni), discounts(bi)
    cut = lambda d, c: d[c] if c <= ngram.K else 1.0
    n, v = sum(uni.values()), len(uni)
    p1 = {w: cut(d1, c) * c / n for w, c in uni.items()}
    free = 1 - sum(p1.values()) if n else 1.0
    follow = collections.defaultdict(dict)
    for (a, b), c in bi.items():
        follow[a][b] = c

    def p(a, b):
        low = p1.get(b, free)
        if a not in follow:
            return low
        total = sum(follow[a].values())
        left = 1 - sum(cut(d2, c) * c for c in follow[a].values()) / total
        scale = 1.0
        if left < 1e-12:
            left, scale = 1 / (total + 1), total / (total + 1)
        if b in follow[a]:
            return cut(d2, follow[a][b]) * follow[a][b] / total * scale
        return left / (1 - sum(p1[w] for w in follow[a])) * low

    out = {}
    for t in set(every):
        ws = tokens(t)
        out[t] = (
            len(ws),
            sum(uni[w] > 0 for w in ws),
            sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws),
            sum(math.log10(p(a, b)) for a, b in zip(["begin"] + ws[:-1], ws)),
        )
    for a in [*list(follow)[:5], "never"]:  # every distribution sums to one
        assert abs(sum(p(a, w) for w in uni) + p(a, "unseen") - 1) < 1e-9
    return out, n


def test_katz(docs):
    rows = pairs(docs)
    want, n = katz([t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1], [t for _, t in rows])
    model = ngram.Model(docs)
    assert model.unigram_counts.tokens == n
    got = model.score().collect()
    assert len(got) == len(rows)
    by_id = collections.defaultdict(list)
    for i, t in rows:
        by_id[i].append(want[t])
    for r in got:
        near = lambda w: abs(w[2] - r.base_score) < 1e-6 * (1 - w[2]) and abs(w[3] - r.score) < 1e-5 * (1 - w[3])
        assert any((r.n_tokens, r.n_known) == w[:2] and near(w) for w in by_id[r.id])
        assert r.held_out == (zlib.crc32(str(r.id).encode()) % 5 == 1)


def test_katz_spread_contexts(docs):
    """A context over the limit is dealt over all buckets and scores as before."""
    whole = {(r.id, round(r.score, 3)) for r in ngram.Model(docs).score().collect()}
    spread = ngram.Model(docs)
    spread.hot = 2.0
    spread.pairs = spread.blocks.ask(ngram._ask_bigrams(spread.n, 2.0), spread.word_answers)
    unigrams = spread.unigrams

    def survey(sent):
        got = [p for _, p in sent if p is not None]
        if got:
            here = ngram._Contexts(got, unigrams)
            yield ngram.Counts(0, 0, ngram._often(here.count)), dict(zip(here.contexts[here.spread].tolist(), here.sums()[here.spread]))

    _, spread.spread = spread.pairs.mapPartitions(survey).reduce(ngram._together)
    assert len(spread.spread) > 5
    assert {(r.id, round(r.score, 3)) for r in spread.score().collect()} == whole


# --- op3


def test_fingerprint():
    for text in (None, "", " ", "One two", "a b c d e f a b c d", "Ü x y z Z z Z"):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [2, 4])
def test_masks_cover(radius):
    masks = np.array(simhash.covering_masks(radius), dtype=np.uint64)
    rng = np.random.default_rng(0)
    for _ in range(500):
        bits = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
        assert ((masks & np.uint64(bits)) == 0).any()
    assert min(int(m).bit_count() for m in masks) >= 32


@pytest.mark.parametrize("block", [4096, 3])
def test_simhash_links(spark, block):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 12)]
    prints = list(base)
    for b in base:  # chains of near values
        for _ in range(8):
            b ^= sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 6), replace=False))
            prints.append(b)
    prints = sorted(set(prints))
    rows = [(int(np.array([p], dtype=np.uint64).view(np.int64)[0]),) for p in prints]
    edges = simhash.links(spark.createDataFrame(rows, "fp long"), block=block)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                root[find(b)] = find(a)
    want = {p: find(p) for p in prints}
    for p in prints:
        root[p] = p
    for e in edges.collect():
        a, b = (x & (2**64 - 1) for x in e)
        assert (a ^ b).bit_count() <= 4
        root[find(b)] = find(a)
    same = lambda f: {frozenset(p for p in prints if f(p) == g) for g in {f(p) for p in prints}}
    assert same(find) == same(want.get)


def test_simhash_broadcasts_no_table_that_spark_sizes_too_low(spark):
    """31 rows of each fingerprint are taken for one row, and files of edges for little more than their bytes."""
    prints = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    edges = spark.range(1000).select((F.col("id") + 1).alias("a"), (F.col("id") % 7).alias("b"))
    for made in (simhash.links(prints), _stars(edges, True), _stars(edges, False)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_simhash_edges(spark, docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r.id].add(r.component)
    assert by_id[1] == by_id[2] == by_id[3] == {1} and by_id[5] == by_id[6] == {4} and by_id[41] == by_id[40]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# --- op6


def test_decontaminate(spark, docs):
    texts = dict(pairs(docs))
    leak = texts[10].split()
    bench = [(1, " ".join(texts[9].split()[:14])), (2, leak[0]), (3, None), (4, "..."), (5, "over und"), (6, texts[44]), (6, texts[44])]
    table = spark.createDataFrame(bench, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for item, text in bench:
        ws = word.findall(lower(text))
        for k in range(max(1, len(ws) - 9) if ws else 0):
            windows[tuple(ws[k : k + 10])].add(str(item))
    for part_bytes in (decontaminate.PART_BYTES, 300):
        got = {r.id: r for r in decontaminate.decontaminate(docs.filter("doc_id is not null"), table, part_bytes=part_bytes).collect()}
        for i, text in texts.items():
            if i is None:
                continue
            ws = word.findall(lower(text))
            hit, items = set(), set()
            for k in range(len(ws)):
                for w, its in windows.items():
                    if tuple(ws[k : k + len(w)]) == w:
                        hit |= set(range(k, k + len(w)))
                        items |= its
            assert (got[i].n_words, got[i].n_hit, got[i].items) == (len(ws), len(hit), sorted(items))
            if part_bytes > 300:
                shown = [word.findall(lower(text[s.start : s.end])) for s in got[i].spans]
                assert sum(map(len, shown)) == len(hit)
    none = decontaminate.decontaminate(docs, table.limit(0)).agg({"n_hit": "max"}).first()[0]
    assert none == 0
    clean = decontaminate.without_leaks(docs, table)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} >= {1, 2, 3, None}


# --- op7


@pytest.mark.parametrize("hot", [suffix.HOT, 3])
def test_suffix(docs, hot):
    rows = [(i, t) for i, t in pairs(docs) if i is not None]
    got = {r.id: r for r in suffix.remove_repeats(docs.filter("doc_id is not null"), hot=hot).collect()}
    seen = {}
    removed = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if seen.setdefault(raw[p : p + 100], (i, p)) != (i, p):
                gone[p : p + 100] = b"\1" * 100
        removed[i] = raw, gone
    for i, (raw, gone) in removed.items():
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        assert (got[i].n_bytes, got[i].n_removed, len(got[i].spans)) == (len(raw), sum(gone), runs)
        assert hashlib.sha256(bytes(got[i].kept)).digest() == hashlib.sha256(kept).digest()
    assert suffix.remove_repeats(docs.limit(0)).count() == 0
    assert suffix.remove_repeats(docs).count() == docs.count()


# --- op9


def test_within_one_edit():
    a = "a b c d".split()
    for b, want in (("a b c d", 1), ("a c d", 1), ("a x b c d", 1), ("a b x d", 1), ("b c d x", 0), ("x b c y", 0), ("a b", 0)):
        assert lines.within_one_edit(a, b.split()) == bool(want)


def test_lines(spark, docs):
    base = "one two Three four five six seven eight nine"
    near = [base, base.upper(), base + " ten", base[4:], base.replace("five", "5"), base.replace("one", "1").replace("two", "2"), "five"]
    more = spark.createDataFrame([(100 + i, t, "x") for i, t in enumerate(near)] + [(99, "\n".join(near * 2), "x")], "doc_id long, text string, n_lines string")
    every = docs.select("doc_id", "text").filter("doc_id is not null").union(more.select("doc_id", "text"))
    got = collections.defaultdict(list)
    for r in lines.dedup_lines(every).collect():
        got[r.doc_id].append(r)
    earlier = []
    for i, t in sorted({(i, t) for i, t in pairs(every)}, key=lambda r: r[0]):
        kept = []
        for line in (t or "").split("\n"):
            ws = WORD.findall(lower(line))
            drop = bool(ws) and any(
                e == ws or min(len(e), len(ws)) >= lines.MIN_WORDS and lines.within_one_edit(e, ws) for e in earlier
            )
            earlier += [ws] if ws else []
            kept += [] if drop else [line]
        for r in got[i]:
            assert r.text == (None if t is None else "\n".join(kept)), i
    out = lines.dedup_lines(more)
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert lines.dedup_lines(docs.limit(0)).count() == 0
    assert lines.dedup_lines(docs).count() == docs.count()


def test_katz_table(spark, docs):
    from llm.common import scratch_dir

    model = ngram.Model(docs)
    path = scratch_dir(spark, "bigrams")
    model.store(path)
    stored = spark.read.parquet(path)
    assert stored.agg({"count": "sum"}).first()[0] == model.unigram_counts.tokens
    assert stored.select("context", "word").distinct().count() == stored.count() == model.bigram_counts.types
    assert ngram.Model(docs.limit(0)).score().count() == 0


def test_a_task_of_blocks_has_three_workers_whatever_it_knows(spark):
    """Each Python RDD after the last shuffle is a worker of the task, with a memory of its own."""
    rows = spark.range(40).selectExpr("id", "repeat('ab ', int(id)) AS text")
    blocks = Blocks(rows, 500)
    n = blocks.buckets

    def ask(ids, texts, *known):
        for t in texts:
            yield len(t) % n, len(t)

    def reply(sent):
        return [len(sent) for _ in sent]

    first = blocks.answers(blocks.ask(ask), reply)
    second = blocks.answers(blocks.ask(ask, first), lambda sent: [str(m) for m in reply(sent)])
    done = blocks.finish(lambda ids, texts, a, b: [(ids, a, b)], first, second)
    got = done.collect()
    assert sorted(i for ids, _, _ in got for i in ids) == list(range(40))
    assert all(set(a) == {3 * i % n for i in ids} and b == {k: str(m) for k, m in a.items()} for ids, a, b in got)
    lineage = done.toDebugString().decode().split("\n")
    margins = [len(x) - len(x.lstrip(" |+-()0123456789")) for x in lineage]
    assert sum("PythonRDD[" in x and m == margins[0] for x, m in zip(lineage, margins)) == 3


def test_line_variants_are_packed_and_those_of_the_words():
    """Every line without each of its words, by place and not; a row takes some bytes, not a Python tuple."""
    texts = [b"\n".join(b"a%d bb ccc d e f g hh%d" % (i, i // 2) for i in range(2000))]
    every = {0: (b"", np.arange(2000, dtype=np.int32).tobytes())}
    tracemalloc.start()
    chunk = lines.Candidates([{"_id": 7}], texts, every)
    before, _ = tracemalloc.get_traced_memory()
    tracemalloc.reset_peak()
    key, kind, c = chunk.variants()
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert peak < 40 * len(key)
    words = chunk.words[3]
    want = [(xxhash.xxh64_intdigest(b" ".join(words)), 2)]
    for i in range(len(words)):
        rest = b" ".join(words[:i] + words[i + 1 :])
        want += [(xxhash.xxh64_intdigest(rest, i + 1), 0), (xxhash.xxh64_intdigest(rest), 1)]
    assert list(zip(key[c == 3].tolist(), kind[c == 3].tolist())) == want
    # lines 2i and 2i + 1 differ in their first word only
    assert chunk.beaten_here() == {i: (7, i - 1) for i in range(1, 2000, 2)}
    assert len(lines.Candidates([{"_id": 7}], texts, {}).questions()[0]) == 0
