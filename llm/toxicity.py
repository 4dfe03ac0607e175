"""Toxicity by a linear-chain conditional random field over the tokens of a text.

Only documents are labelled, so the tokens of the fit are labelled first: a token of a toxic document
is toxic if it carries a feature (the word, or a prefix of it) that toxic documents hold far more
often than clean ones. The field has two states. Tokens without any such feature share one
potential, so a run of them is a power of one 2 x 2 matrix, and only the other tokens are visited:
the marginals are those of the full chain. A document's score is a logistic function of the expected
number of toxic tokens, their share, and the largest marginal, fitted to the document labels.

Fitting uses at most `max_rows` labelled rows (in the order of a hash of the id), chosen from the
whole table; everything is scored. The lexicon has at most `max_features` features.

Cases: a null or empty text has no tokens and the score of the bias alone. Rows without a label, or
with a null one, take no part in the fit. Repeated rows get a row each. If the fit sees only one
label, every score is that label's share. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import short_batches

MAX_ROWS = 20_000
MAX_FEATURES = 5_000
THRESHOLD = 0.3
PREFIXES = (3, 4, 5, 6, 7)

_TOKEN = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """The word itself and its prefixes, marked by a trailing `*`."""
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) >= k)]


def tokens(text: str | None) -> list[str]:
    return [w.lower() for w in _TOKEN.findall(text or "")]


@dataclass
class Chain:
    """Tokens that carry features: per document, gaps between them, features, and the tail after the last."""

    gaps: list[list[int]]
    found: list[list[tuple[int, ...]]]
    tails: list[int]
    places: list[list[int]]


class Lexicon:
    def __init__(self, names: list[str]):
        self.index = {n: i for i, n in enumerate(names)}
        self._known: dict[str, tuple[int, ...]] = {}

    def __getstate__(self) -> dict:
        return {"index": self.index, "_known": {}}

    def of(self, word: str) -> tuple[int, ...]:
        hit = self._known.get(word)
        if hit is None:
            if len(self._known) > 50_000:
                self._known.clear()
            hit = tuple(i for f in features(word) if (i := self.index.get(f)) is not None)
            self._known[word] = hit
        return hit

    def chains(self, texts: list[str | None]) -> Chain:
        out = Chain([], [], [], [])
        for text in texts:
            gaps, found, places, last = [], [], [], -1
            words = tokens(text)
            for i, hit in enumerate(map(self.of, words)):
                if hit:
                    gaps.append(i - last - 1)
                    found.append(hit)
                    places.append(i)
                    last = i
            out.gaps.append(gaps)
            out.found.append(found)
            out.places.append(places)
            out.tails.append(len(words) - last - 1)
        return out


class Packed:
    """The tokens of several chains in arrays, ordered by place in the chain, longer chains first."""

    def __init__(self, chain: Chain):
        self.sizes = np.array([len(g) for g in chain.gaps], dtype=np.int64)
        self.order = np.argsort(-self.sizes, kind="stable")
        rank = np.empty(len(self.order), np.int64)
        rank[self.order] = np.arange(len(self.order))
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.at = np.lexsort((rank[doc], place))  # packed -> place in the flattened chains
        found = [hit for hits in chain.found for hit in hits]
        self.width = np.array([len(h) for h in found], dtype=np.int64)
        self.flat = np.array([f for h in found for f in h], dtype=np.int64)
        self.starts = np.cumsum(self.width) - self.width
        self.gaps = np.array([g for gs in chain.gaps for g in gs], dtype=np.int64)
        self.tails = np.array(chain.tails, dtype=np.int64)
        longest = int(self.sizes.max()) if len(self.sizes) else 0
        active = np.searchsorted(np.sort(-self.sizes), -np.arange(1, longest + 1), side="right")
        self.cuts = np.concatenate([[0], np.cumsum(active)]).astype(np.int64)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.flat], self.starts) if len(self.flat) else np.zeros(0)


class Field:
    """A two-state chain. `edge` holds the log potentials of clean-toxic, toxic-clean, toxic-toxic and of a toxic plain token."""

    def __init__(self, weights: np.ndarray, edge: np.ndarray):
        self.weights, self.edge = weights, edge

    def _steps(self, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled matrices (plain step) ** gap and the logs of their scales."""
        move = np.exp(np.array([[0.0, self.edge[0]], [self.edge[1], self.edge[2]]]))
        plain = move * np.array([1.0, np.exp(self.edge[3])])
        values, vectors = np.linalg.eig(plain)
        top = values.max()
        distinct, of = np.unique(gaps, return_inverse=True)
        grown = (values / top)[None, :] ** distinct[:, None]
        power = np.maximum((vectors[None] * grown[:, None, :]) @ np.linalg.inv(vectors), 0)
        return power[of], gaps * np.log(top)

    def run(self, packed: Packed) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of the tokens with features, flattened, and the log partition function per document."""
        move = np.exp(np.array([[0.0, self.edge[0]], [self.edge[1], self.edge[2]]]))
        power, scale = self._steps(packed.gaps)
        jump = (power @ move)[packed.at]
        score = packed.scores(self.weights)
        high = np.maximum(score, 0)
        quiet, loud = np.exp(-high)[packed.at], np.exp(score - high)[packed.at]
        j00, j01, j10, j11 = (jump[:, a, b] for a in (0, 1) for b in (0, 1))
        lifted = (scale + high)[packed.at]
        n, cuts = len(packed.sizes), packed.cuts.tolist()
        a0, a1, log_z = np.ones(n), np.zeros(n), np.zeros(n)
        ahead0, ahead1 = np.empty(len(packed.at)), np.empty(len(packed.at))
        for lo, hi in zip(cuts, cuts[1:]):
            k = hi - lo
            b0 = (a0[:k] * j00[lo:hi] + a1[:k] * j10[lo:hi]) * quiet[lo:hi]
            b1 = (a0[:k] * j01[lo:hi] + a1[:k] * j11[lo:hi]) * loud[lo:hi]
            total = b0 + b1
            a0[:k], a1[:k] = b0 / total, b1 / total
            log_z[:k] += np.log(total) + lifted[lo:hi]
            ahead0[lo:hi], ahead1[lo:hi] = a0[:k], a1[:k]
        end, scale = self._steps(packed.tails[packed.order])
        c0, c1 = end[:, 0].sum(axis=1), end[:, 1].sum(axis=1)
        log_z += np.log(a0 * c0 + a1 * c1) + scale
        p = np.empty(len(packed.at))
        for lo, hi in zip(cuts[-2::-1], cuts[:0:-1]):
            k = hi - lo
            good, bad = ahead0[lo:hi] * c0[:k], ahead1[lo:hi] * c1[:k]
            p[lo:hi] = bad / (good + bad)
            u, v = quiet[lo:hi] * c0[:k], loud[lo:hi] * c1[:k]
            d0, d1 = j00[lo:hi] * u + j01[lo:hi] * v, j10[lo:hi] * u + j11[lo:hi] * v
            c0[:k], c1[:k] = d0 / (d0 + d1), d1 / (d0 + d1)
        marginals, out = np.empty(len(p)), np.empty(n)
        marginals[packed.at] = p
        out[packed.order] = log_z
        return marginals, out

    def path_score(self, packed: Packed, gold: np.ndarray) -> float:
        """Sum over documents of the score of the labelled path; plain tokens are clean."""
        log_move = np.array([[0.0, self.edge[0]], [self.edge[1], self.edge[2]]])
        heads = np.cumsum(packed.sizes) - packed.sizes
        before = np.concatenate([[0], gold[:-1]]) if len(gold) else gold
        before[heads[packed.sizes > 0]] = 0
        total = float((packed.scores(self.weights) * gold).sum())
        total += float(log_move[np.where(packed.gaps > 0, 0, before), gold].sum() + log_move[before, 0][packed.gaps > 0].sum())
        last = (heads + packed.sizes - 1)[packed.sizes > 0]
        return total + float(log_move[gold[last], 0][packed.tails[packed.sizes > 0] > 0].sum())

    @staticmethod
    def fit(chain: Chain, labels: list[np.ndarray], n_features: int, rounds: int = 40, decay: float = 1e-3, longest: int = 200) -> Field:
        """Gradient ascent on the conditional likelihood: marginals give the feature gradient, differences the rest.

        Chains are fitted in stretches of at most `longest` tokens with features.
        """
        field = Field(np.zeros(n_features), np.array([-3.0, 0.0, 0.0, -6.0]))
        parts, gold = Chain([], [], [], []), []
        for gaps, found, tail, ys in zip(chain.gaps, chain.found, chain.tails, labels):
            for at in range(0, max(1, len(gaps)), longest):
                parts.gaps.append(gaps[at : at + longest])
                parts.found.append(found[at : at + longest])
                parts.tails.append(tail if at + longest >= len(gaps) else 0)
                gold.append(ys[at : at + longest])
        packed, docs = Packed(parts), max(1, len(parts.gaps))
        gold = np.concatenate(gold).astype(np.int64) if gold else np.zeros(0, np.int64)
        mean, square = np.zeros(n_features + 4), np.zeros(n_features + 4)
        for step in range(1, rounds + 1):
            marginals, _ = field.run(packed)
            slope = np.bincount(packed.flat, np.repeat(gold - marginals, packed.width), n_features) / docs - decay * field.weights
            edge_slope = np.zeros(4)
            for k in range(4) if step % 4 == 1 else ():
                side = []
                for move in (1e-3, -1e-3):
                    edge = field.edge.copy()
                    edge[k] += move
                    other = Field(field.weights, edge)
                    side.append((other.path_score(packed, gold) - other.run(packed)[1].sum()) / docs)
                edge_slope[k] = (side[0] - side[1]) / 2e-3 - decay * field.edge[k]
            grad = np.concatenate([slope, edge_slope])
            mean = 0.9 * mean + 0.1 * grad
            square = 0.99 * square + 0.01 * grad**2
            move = 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
            field = Field(field.weights + move[:n_features], field.edge + move[n_features:])
        return field


def _by_document(marginals: np.ndarray, packed: Packed) -> list[np.ndarray]:
    return np.split(marginals, np.cumsum(packed.sizes)[:-1]) if len(packed.sizes) else []


@dataclass
class Tagger:
    lexicon: Lexicon
    field: Field
    logistic: np.ndarray  # bias and the weights of `summary`
    constant: float | None = None

    @staticmethod
    def summary(marginals: list[np.ndarray], sizes: list[int]) -> np.ndarray:
        """Per document: 1, log of the expected toxic tokens, their share, the largest marginal."""
        rows = []
        for m, n in zip(marginals, sizes):
            expected = float(m.sum())
            rows.append((1.0, np.log1p(expected), np.log1p(100 * expected / max(1, n)), float(m.max()) if len(m) else 0.0))
        return np.array(rows).reshape(-1, 4)

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray], Chain]:
        chain = self.lexicon.chains(texts)
        packed = Packed(chain)
        marginals = _by_document(self.field.run(packed)[0], packed)
        if self.constant is not None:
            return np.full(len(texts), self.constant), marginals, chain
        sizes = [sum(g) + len(g) + t for g, t in zip(chain.gaps, chain.tails)]
        return 1 / (1 + np.exp(-self.summary(marginals, sizes) @ self.logistic)), marginals, chain


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(curve, slope), -5, 5)
    return w


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> Tagger:
    """Fit on the texts of `docs` (doc_id, text) that `labels` (doc_id, toxic) marks, held-out ids apart.

    At most `max_rows` labels, the first by a hash of the id, and `max_features` features reach the
    driver. The chosen ids are broadcast, 16 bytes each, so that texts are filtered where they are read.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.filter(F.col("toxic").isNotNull() & (remainder("id") != 2))
    ids = marked.orderBy(F.xxhash64("id"), "id", "toxic").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    chosen = texts.join(F.broadcast(ids), "id")
    short_batches(docs.sparkSession)
    chosen = chosen.persist()
    clean, toxic = (chosen.filter(F.col("toxic") == k).count() for k in (0, 1))
    if not clean or not toxic:
        share = toxic / max(1, clean + toxic)
        return Tagger(Lexicon([]), Field(np.zeros(0), np.array([-3.0, 0.0, 0.0, -6.0])), np.zeros(4), share)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, y in zip(batch["text"], batch["toxic"]):
                seen[int(y == 1)].update({f for w in set(tokens(text)) for f in features(w)})
            names = list(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({"name": names, "bad": [seen[1][n] for n in names], "good": [seen[0][n] for n in names]})

    lift = F.log((F.col("bad") + 0.5) / (toxic + 1.0)) - F.log((F.col("good") + 0.5) / (clean + 1.0))
    words = (
        chosen.mapInPandas(count, "name string, bad long, good long")
        .groupBy("name")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .filter("bad >= 4")
        .withColumn("lift", lift)
        .filter("lift >= 2")
        .orderBy(F.desc(F.col("bad") * F.col("lift")), "name")
        .limit(max_features)
        .select("name", "lift")
        .collect()
    )
    lexicon = Lexicon([r.name for r in words])
    lifts = np.array([r.lift for r in words])
    sent = chosen.sparkSession.sparkContext.broadcast(lexicon)

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            c = sent.value.chains(list(batch["text"]))
            found = [[list(h) for h in doc] for doc in c.found]
            yield pd.DataFrame({"toxic": batch["toxic"], "gaps": c.gaps, "found": found, "tail": c.tails})

    shape = "toxic int, gaps array<int>, found array<array<int>>, tail int"
    chain, ys, labels = Chain([], [], [], []), [], []
    for row in chosen.mapInPandas(locate, shape).toLocalIterator():
        chain.gaps.append(list(row.gaps))
        chain.found.append([tuple(h) for h in row.found])
        chain.tails.append(row.tail)
        ys.append(row.toxic)
        labels.append(np.array([int(row.toxic == 1 and lifts[h].max() >= 3) for h in row.found], dtype=int))
    chosen.unpersist()
    field = Field.fit(chain, labels, len(lifts))
    packed = Packed(chain)
    marginals = _by_document(field.run(packed)[0], packed)
    sizes = [sum(g) + len(g) + t for g, t in zip(chain.gaps, chain.tails)]
    return Tagger(lexicon, field, _fit_logistic(Tagger.summary(marginals, sizes), np.array(ys, dtype=float)))


def scorer(spark: SparkSession, tagger: Tagger) -> Callable[[Column], Column]:
    """A column function: text -> struct (score, spans); spans are offending tokens (start, end, marginal) in characters."""
    short_batches(spark)
    sent = spark.sparkContext.broadcast(tagger)

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = []
            for at in range(0, len(batch), 500):
                part = [None if t is None else t for t in batch.iloc[at : at + 500]]
                scores, marginals, chain = sent.value.score(part)
                spans = []
                for text, m, places in zip(part, marginals, chain.places):
                    bad = {i: p for i, p in zip(places, m.tolist()) if p >= 0.5}
                    spans.append([(*x.span(), bad[i]) for i, x in enumerate(_TOKEN.finditer(text)) if i in bad] if bad else [])
                done.append(pd.DataFrame({"score": scores, "spans": spans}))
            yield pd.concat(done, ignore_index=True) if done else pd.DataFrame({"score": [], "spans": []})

    return F.pandas_udf(work, "score double, spans array<struct<start:int,end:int,p:double>>")


def score(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, spans) per row."""
    found = scorer(docs.sparkSession, tagger)(F.col(text_col))
    return docs.select(F.col(id_col).cast("long").alias("id"), found.alias("_s")).select("id", "_s.score", "_s.spans")


def remainder(id_col: str | Column = "doc_id", n: int = 4) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n
