"""Katz backoff language model: Good-Turing discounted bigrams over discounted unigrams.

P(w | v) is the discounted share of w among what follows v in the training texts, or, if v w was not
seen, the backoff weight of v times P(w); P(w) is the discounted share of w, or, for a word that
training lacks, the mass that discounting freed, which belongs to one further type. The weight of v
is the mass its discounts free divided by the unigram mass of what does not follow it, from exact
sums over all followers, so every distribution sums to one. A context whose followers are all too
frequent for a discount frees 1 / (count + 1).

N-gram counts are tables partitioned by hash of the context; a context with more than a bucket's
share of all tokens is spread over all buckets by its followers and its sums are combined. Words are
64-bit hashes (48 bits within one context). Chunks of documents ask for the words, then for the
bigrams they hold (`blocks`), so no token is shuffled one by one. Log probabilities of bigrams come back as
32-bit floats.

Cases: a null or empty text is the end token alone. Without training rows every probability is the
free mass, one. Repeated rows count and are scored once per row. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import Blocks

K = 5  # counts above it are not discounted
BEGIN, END = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC3A5C85C97CB3127)
_PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """64-bit polynomial hashes of byte ranges; powers are kept between calls."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if len(self.up) < n:
            self.up = _powers(_BASE, 2 * n)
            self.down = _powers(pow(_BASE, -1, 2**64), 2 * n)
        out = np.zeros(n, np.uint64)
        np.cumsum(_BYTE[data] * self.up[: n - 1], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes], rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the number of words of each."""
    hashes, counts, at = [], [], 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) < _PIECE):
            size += len(texts[stop]) + 1
            stop += 1
        data = np.frombuffer(b" ".join(t.lower() for t in texts[at:stop]) + b" ", np.uint8)
        inside = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
        turns = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
        starts, ends = turns[::2], turns[1::2]
        hashes.append(rolling.of(rolling.sums(data), starts, ends))
        borders = np.cumsum([0] + [len(t) + 1 for t in texts[at:stop]])
        counts.append(np.diff(np.searchsorted(starts, borders)))
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


@dataclass
class Counts:
    """What the driver knows of one order: tokens, types, and how many types occur 1 to K + 1 times."""

    tokens: int
    types: int
    often: np.ndarray

    def discounts(self) -> np.ndarray:
        """d[r] for r = 0..K: Good-Turing where its estimates are in (0, 1], absolute otherwise."""
        n = self.often.astype(float)
        r = np.arange(1, K + 1)
        if (n > 0).all():
            share = (K + 1) * n[K] / n[0]
            if share < 1:
                d = ((r + 1) * n[1:] / (r * n[:-1]) - share) / (1 - share)
                if (d > 0).all() and (d <= 1).all() and d[0] < 1:
                    return np.concatenate([[1.0], d])
        step = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
        return np.concatenate([[1.0], (r - step) / r])


def _often(counts: np.ndarray) -> np.ndarray:
    return np.bincount(counts[(counts > 0) & (counts <= K + 1)], minlength=K + 2)[1:]


def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * d[np.where(counts <= K, counts, 0)]


class Unigrams:
    def __init__(self, counts: Counts):
        self.n, self.v, self.d = counts.tokens, counts.types, counts.discounts()
        low = float((np.arange(1, K + 1) * counts.often[:K]).sum())
        kept = float((np.arange(1, K + 1) * counts.often[:K] * self.d[1:]).sum()) + (self.n - low)
        self.scale = 1.0
        self.free = 1 - kept / self.n if self.n else 1.0
        if self.free < 1e-12:
            self.free = 1 / (self.n + 1)
            self.scale = self.n / (self.n + 1)

    def p(self, counts: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.ones(len(counts))
        return np.where(counts > 0, _discounted(counts, self.d) * self.scale / self.n, self.free)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.n + 0.5 * (self.v + 1)))


class Chunk:
    """Tokens of a chunk: previous and current word per token, its document, distinct words and bigrams."""

    def __init__(self, texts: list[bytes], rolling: Rolling):
        words, sizes = word_hashes(texts, rolling)
        ends = np.cumsum(sizes)
        self.sizes = sizes + 1
        self.cur = np.insert(words, ends, END)
        self.prev = np.insert(words, ends - sizes, BEGIN)
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), self.sizes)
        self.words, of_cur = np.unique(self.cur, return_inverse=True)
        self.of_cur = of_cur.astype(np.int32)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of one token per distinct bigram, and the bigram of each token."""
        key = _mixed(self.prev) + self.cur
        _, first, of_token = np.unique(key, return_index=True, return_inverse=True)
        return first, of_token.astype(np.int32)


def _held(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(str(i).encode()) % 5 == 1 for i in ids], dtype=bool)


def _places(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its members, ascending)."""
    order = np.argsort(buckets, kind="stable")
    cuts = np.flatnonzero(np.diff(buckets[order])) + 1
    for part in np.split(order, cuts) if len(order) else ():
        yield int(buckets[part[0]]), part


def _ask_words(n: int):
    rolling = Rolling()

    def ask(ids: list, texts: list[bytes]) -> Iterator[tuple]:
        chunk = Chunk(texts, rolling)
        learn = ~_held(ids)[chunk.doc]
        counts = np.bincount(chunk.of_cur[learn], minlength=len(chunk.words)).astype(np.int32)
        for bucket, at in _places((chunk.words >> np.uint64(33)) % np.uint64(n)):
            yield bucket, (chunk.words[at].tobytes(), counts[at].tobytes())

    return ask


def _merge_words(sent: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    words = [np.frombuffer(w, np.uint64) for w, _ in sent]
    distinct, of = np.unique(np.concatenate(words), return_inverse=True)
    counts = np.bincount(of, np.concatenate([np.frombuffer(c, np.int32) for _, c in sent]), len(distinct))
    return distinct, counts.astype(np.int64), of, np.cumsum([len(w) for w in words])[:-1].tolist()


def _answer_words(sent: list) -> Iterable[bytes]:
    _, counts, of, cuts = _merge_words(sent)
    for part in np.split(counts[of], cuts):
        yield part.tobytes()


def _word_counts(chunk: Chunk, answers: dict, n: int) -> np.ndarray:
    """Training count of each distinct word of the chunk."""
    counts = np.zeros(len(chunk.words), np.int64)
    for bucket, at in _places((chunk.words >> np.uint64(33)) % np.uint64(n)):
        counts[at] = np.frombuffer(answers[bucket], np.int64)
    return counts


def _bigram_buckets(chunk: Chunk, first: np.ndarray, counts: np.ndarray, hot: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each distinct bigram, and whether its context is spread over all buckets."""
    prev, cur = chunk.prev[first], chunk.cur[first]
    at = np.searchsorted(chunk.words, prev)
    known = np.where(prev == BEGIN, 0, counts[np.minimum(at, len(counts) - 1)])
    spread = (known > hot) | (prev == BEGIN)
    return np.where(spread, _mixed(prev + cur), _mixed(prev)) % np.uint64(n), spread


def _ask_bigrams(n: int, hot: float):
    rolling = Rolling()

    def ask(ids: list, texts: list[bytes], answers: dict) -> Iterator[tuple]:
        chunk = Chunk(texts, rolling)
        counts = _word_counts(chunk, answers, n)
        first, of_token = chunk.bigrams()
        learn = ~_held(ids)[chunk.doc]
        seen = np.bincount(of_token[learn], minlength=len(first)).astype(np.int32)
        of_word = counts[chunk.of_cur[first]]
        buckets, spread = _bigram_buckets(chunk, first, counts, hot, n)
        for bucket, at in _places(buckets):
            at = at[np.argsort(chunk.prev[first[at]], kind="stable")]
            prev, start = np.unique(chunk.prev[first[at]], return_index=True)
            runs = np.diff(np.append(start, len(at))).astype(np.int32)
            cur = chunk.cur[first[at]].view(np.uint8).reshape(-1, 8)[:, :6]
            counted = (_narrow(seen[at]), _narrow(of_word[at]))
            yield bucket, (*(x.tobytes() for x in (prev, runs, spread[at[start]], cur)), *counted)

    return ask


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max()) if len(counts) else 0))


class _Contexts:
    """The bigrams of one bucket, merged over all chunks."""

    def __init__(self, sent: list, unigrams: Unigrams):
        prev, cur, seen, of_word, spread, sizes = [], [], [], [], [], []
        for p, r, s, c, n, w in sent:
            runs = np.frombuffer(r, np.int32)
            prev.append(np.repeat(np.frombuffer(p, np.uint64), runs))
            spread.append(np.repeat(np.frombuffer(s, bool), runs))
            wide = np.zeros((len(c) // 6, 8), np.uint8)
            wide[:, :6] = np.frombuffer(c, np.uint8).reshape(-1, 6)
            cur.append(wide.view(np.uint64)[:, 0])
            seen.append(n)
            of_word.append(w.astype(np.int64))
            sizes.append(len(seen[-1]))
        self.cuts = np.cumsum(sizes)[:-1].tolist()
        prevs, curs = np.concatenate(prev), np.concatenate(cur)
        _, first, self.of = np.unique(_mixed(prevs) + _mixed(curs), return_index=True, return_inverse=True)
        self.prev, self.cur = prevs[first], curs[first]
        self.count = np.bincount(self.of, np.concatenate(seen), len(first)).astype(np.int64)
        self.p_word = unigrams.p(np.concatenate(of_word)[first])
        self.contexts, start, self.context = np.unique(self.prev, return_index=True, return_inverse=True)
        self.spread = np.concatenate(spread)[first][start]

    def sums(self) -> np.ndarray:
        """Per context: types seen 1..K times, tokens of more frequent types, all tokens, unigram mass of what was seen."""
        out = np.zeros((len(self.contexts), K + 3))
        for r in range(1, K + 1):
            out[:, r - 1] = np.bincount(self.context[self.count == r], minlength=len(out))
        more = np.where(self.count > K, self.count, 0)
        out[:, K] = np.bincount(self.context, more, len(out))
        out[:, K + 1] = np.bincount(self.context, self.count, len(out))
        out[:, K + 2] = np.bincount(self.context, np.where(self.count > 0, self.p_word, 0), len(out))
        return out


def _backoff(sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scale of seen probabilities, weight of unseen ones) per context."""
    total = sums[:, K + 1]
    kept = (sums[:, :K] * np.arange(1, K + 1) * d[1:]).sum(axis=1) + sums[:, K]
    safe = np.maximum(total, 1)
    left = 1 - kept / safe
    short = left < 1e-12
    scale = np.where(short, total / (total + 1), 1.0)
    left = np.where(short, 1 / (total + 1), left)
    weight = np.where(total > 0, left / np.maximum(1 - sums[:, K + 2], 1e-300), 1.0)
    return scale, weight


class Model:
    """Counted and ready to score. `words` and `pairs` are the questions, merged per bucket by whoever reads them."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        self.spark = docs.sparkSession
        self.blocks = Blocks(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
        n = self.n = self.blocks.buckets
        self.words = self.blocks.ask(_ask_words(n))
        self.word_answers = self.blocks.answers(self.words, _answer_words)
        self.unigram_counts = _total(self.words, lambda sent: _merge_words(sent)[1])
        unigrams = self.unigrams = Unigrams(self.unigram_counts)
        self.hot = max(1.0, unigrams.n / n)
        self.pairs = self.blocks.ask(_ask_bigrams(n, self.hot), self.word_answers)

        def survey(sent: Iterator) -> Iterator[tuple]:
            got = [payload for _, payload in sent if payload is not None]
            if got:
                here = _Contexts(got, unigrams)
                sums = here.sums()
                hot = {int(c): s for c, s in zip(here.contexts[here.spread], sums[here.spread])}
                yield Counts(int(here.count.sum()), int((here.count > 0).sum()), _often(here.count)), hot

        # at most n contexts are spread: each has over 1/n of all tokens, besides the beginning of a text
        self.bigram_counts, self.spread = self.pairs.mapPartitions(survey).treeReduce(_together) if unigrams.n else (
            Counts(0, 0, np.zeros(K + 1, np.int64)), {})
        self.d = self.bigram_counts.discounts()

    def answer_pairs(self) -> RDD:
        unigrams, spread, d = self.unigrams, self.spread, self.d

        def answer(sent: list) -> Iterable[bytes]:
            here = _Contexts(sent, unigrams)
            sums = here.sums()
            for i in np.flatnonzero(here.spread):
                if int(here.contexts[i]) in spread:
                    sums[i] = spread[int(here.contexts[i])]
            scale, weight = _backoff(sums, d)
            total = np.maximum(sums[:, K + 1], 1)[here.context]
            seen = _discounted(here.count, d) / total * scale[here.context]
            p = np.where(here.count > 0, seen, weight[here.context] * here.p_word)
            logs = np.log10(np.maximum(p, 1e-300)).astype(np.float32)
            for part in np.split(logs[here.of], here.cuts):
                yield part.tobytes()

        return self.blocks.answers(self.pairs, answer)

    def score(self) -> DataFrame:
        """(id, held_out, n_tokens, n_known, base_score, score) per row."""
        n, hot, unigrams = self.n, self.hot, self.unigrams
        rolling = Rolling()

        def rows(ids: list, texts: list[bytes], words: dict, pairs: dict) -> Iterator[tuple]:
            chunk = Chunk(texts, rolling)
            counts = _word_counts(chunk, words, n)
            first, of_token = chunk.bigrams()
            logs = np.zeros(len(first))
            buckets, _ = _bigram_buckets(chunk, first, counts, hot, n)
            for bucket, at in _places(buckets):
                at = at[np.argsort(chunk.prev[first[at]], kind="stable")]
                logs[at] = np.frombuffer(pairs[bucket], np.float32)
            of_cur = counts[chunk.of_cur]
            docs = len(ids)
            known = np.bincount(chunk.doc, of_cur > 0, docs).astype(int)
            base = np.bincount(chunk.doc, unigrams.base(of_cur), docs)
            score = np.bincount(chunk.doc, logs[of_token], docs)
            return zip(ids, _held(ids).tolist(), chunk.sizes.tolist(), known.tolist(), base.tolist(), score.tolist())

        shape = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
        return self.spark.createDataFrame(
            self.blocks.finish(rows, self.word_answers, self.answer_pairs()), shape, verifySchema=False
        )

    def bigram_table(self) -> DataFrame:
        """(bucket, context, word, count): bigrams of the training texts, as 64- and 48-bit hashes."""
        unigrams = self.unigrams

        def rows(bucket: int, sent: Iterator) -> Iterator[tuple]:
            got = [payload for _, payload in sent if payload is not None]
            if got:
                here = _Contexts(got, unigrams)
                for c, w, n in zip(here.prev.view(np.int64).tolist(), here.cur.tolist(), here.count.tolist()):
                    if n:
                        yield bucket, c, w, n

        shape = "bucket int, context long, word long, count long"
        return self.spark.createDataFrame(self.pairs.mapPartitionsWithIndex(rows), shape, verifySchema=False)


    def store(self, path: str) -> None:
        """Write the bigram counts as a table partitioned by bucket."""
        self.bigram_table().write.partitionBy("bucket").parquet(path)


def _total(asked: RDD, counts_of) -> Counts:
    def count(sent: Iterator) -> Iterator[Counts]:
        got = [payload for _, payload in sent if payload is not None]
        if got:
            c = counts_of(got)
            yield Counts(int(c.sum()), int((c > 0).sum()), _often(c))

    none = Counts(0, 0, np.zeros(K + 1, np.int64))
    return asked.mapPartitions(count).fold(none, lambda a, b: Counts(a.tokens + b.tokens, a.types + b.types, a.often + b.often))


def _together(a: tuple, b: tuple) -> tuple:
    counts = Counts(a[0].tokens + b[0].tokens, a[0].types + b[0].types, a[0].often + b[0].often)
    hot = dict(a[1])
    for c, s in b[1].items():
        hot[c] = hot[c] + s if c in hot else s
    return counts, hot
