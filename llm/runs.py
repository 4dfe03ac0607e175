"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of consecutive words with smallest period q and at least max(`LEAST`, `TIMES` * q) words
that no neighbouring word extends keeping period q. At scale L (8, 16, 32, ...) a text is cut into aligned
blocks of L words. A run with a period from L to 2L - 1 (from 1 at scale 8) holds a whole block together
with its next occurrence, less than 2L words on. The sum of squared differences of word numbers between the block and the
words at every distance in reach is an integer convolution; it is done by a number-theoretic transform modulo primes whose
product exceeds the largest possible sum, so it is zero modulo all of them only where all words are equal. A zero is a seed,
a place and a distance, which is extended both ways word by word as far as the distance is a period.

Distances go up, and a seed within a known run at a multiple of its period is that run again, so the first distance that
finds a run is its smallest period. Two kinds of blocks are left out because they cannot give anything new: a block with a
word that does not come again within reach, and a block whose reach lies in a known run of a period up to L.

Cases: a null or empty text has no words and no runs; its collapsed text is empty. Texts are worked on whole, each in
memory of some 100 bytes a word; periods reach up to 2 ** 27 words. Every row is judged by itself, so repeated rows, ties, null ids and other
columns have no effect. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import short_batches, utf8

LEAST, TIMES = 24, 3
_BASE = 8  # the smallest scale; with LEAST = 24 and TIMES = 3 a run of any smaller period holds such a block and its next place
_ORDER = 27  # transforms of up to 2 ** _ORDER places
_CELLS = 1 << 19  # numbers worked on at once


@lru_cache(None)
def _primes() -> list[int]:
    """Primes k * 2 ** _ORDER + 1 below 2 ** 32, the largest first."""
    found = []
    for p in range(((1 << 32) >> _ORDER << _ORDER) + 1, 1 << _ORDER, -(1 << _ORDER)):
        if p < 1 << 32 and all(p % k for k in range(3, int(p**0.5) + 1, 2)):
            found.append(p)
    return found


def _enough(bound: int) -> list[int]:
    """As many primes as it takes for their product to exceed `bound`."""
    taken, product = [], 1
    for p in _primes():
        if product > bound:
            break
        taken.append(p)
        product *= p
    if product <= bound:
        raise ValueError("too many different words for an exact transform")
    return taken


@lru_cache(256)
def _twiddles(p: int, half: int, inverse: bool) -> np.ndarray:
    """The powers 0 .. half - 1 of a root of unity of order 2 * half modulo p."""
    other = next(g for g in range(2, 1000) if pow(g, (p - 1) // 2, p) != 1)
    root = pow(other, (p - 1) // (2 * half), p)
    if inverse:
        root = pow(root, p - 2, p)
    powers = np.ones(half, np.uint64)
    done, step = 1, root
    while done < half:
        powers[done : 2 * done] = powers[:done] * np.uint64(step) % np.uint64(p)
        done, step = 2 * done, step * step % p
    return powers


def _transform(x: np.ndarray, p: int) -> np.ndarray:
    """Number-theoretic transform of each row; its places come in bit-reversed order."""
    mod, rows, half = np.uint64(p), len(x), x.shape[1] // 2
    while half:
        pairs = x.reshape(rows, -1, 2, half)
        u, v = pairs[:, :, 0], pairs[:, :, 1]
        less = np.where(u >= v, u - v, u + mod - v)
        x = np.stack(((u + v) % mod, less * _twiddles(p, half, False) % mod), axis=2)
        half //= 2
    return x.reshape(rows, -1)


def _back(x: np.ndarray, p: int) -> np.ndarray:
    """The inverse of `_transform`."""
    mod, rows, size, half = np.uint64(p), len(x), x.shape[1], 1
    while half < size:
        pairs = x.reshape(rows, -1, 2, half)
        u, v = pairs[:, :, 0], pairs[:, :, 1] * _twiddles(p, half, True) % mod
        x = np.stack(((u + v) % mod, (u + mod - v) % mod), axis=2)
        half *= 2
    return x.reshape(rows, size) * np.uint64(pow(size, p - 2, p)) % mod


def _matches(words: np.ndarray, starts: np.ndarray, length: int, first: int, primes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) where the block of `length` words comes again, for distances from `first` to 2 * length - 1."""
    reach = 3 * length - 1 - first  # words from the first distance to the end of the last occurrence
    size = 1 << (reach - 1).bit_length()
    padded = np.concatenate([words, np.zeros(3 * length, np.uint64)])
    places, distances = [], []
    for at in range(0, len(starts), max(1, _CELLS // size)):
        s = starts[at : at + max(1, _CELLS // size)]
        block = padded[s[:, None] + np.arange(length)]
        window = padded[s[:, None] + first + np.arange(reach)]
        zero = np.ones((len(s), 2 * length - first), bool)
        for p in primes:
            mod = np.uint64(p)
            a, b = np.zeros((len(s), size), np.uint64), np.zeros((len(s), size), np.uint64)
            a[:, :reach] = window
            b[:, (-np.arange(length)) % size] = block
            cross = _back(_transform(a, p) * _transform(b, p) % mod, p)[:, : zero.shape[1]]
            squares = np.zeros((len(s), reach + 1), np.uint64)
            np.cumsum(window * window % mod, axis=1, out=squares[:, 1:])
            moving = squares[:, length:] - squares[:, : reach + 1 - length]
            own = (block * block % mod).sum(axis=1, dtype=np.uint64)[:, None]
            zero &= (own + moving) % mod == cross * np.uint64(2) % mod
        zero &= s[:, None] + first + np.arange(zero.shape[1]) + length <= len(words)
        row, d = np.nonzero(zero)
        places.append(s[row])
        distances.append(d + first)
    return np.concatenate(places), np.concatenate(distances)


def _stretch(words: np.ndarray, lo: int, hi: int, d: int) -> tuple[int, int]:
    """The widest [lo, hi) around the given one in which every word equals the one d on (hi: of the first of the two)."""
    step = 64
    while lo > 0:
        a = max(0, lo - step)
        other = np.flatnonzero(words[a:lo] != words[a + d : lo + d])
        if len(other):
            lo = a + int(other[-1]) + 1
            break
        lo, step = a, 2 * step
    step, last = 64, len(words) - d
    while hi < last:
        b = min(last, hi + step)
        other = np.flatnonzero(words[hi:b] != words[hi + d : b + d])
        if len(other):
            hi += int(other[0])
            break
        hi, step = b, 2 * step
    return lo, hi


def _again(words: np.ndarray) -> np.ndarray:
    """For each word how far on it comes again; beyond the text if it does not."""
    order = np.argsort(words, kind="stable")
    far = np.full(len(words), 2 * len(words), np.int64)
    same = words[order[1:]] == words[order[:-1]]
    far[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return far


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a sequence of word numbers from 0, sorted by start, then period."""
    n, runs = len(words), []
    if n < LEAST:
        return runs
    far = _again(words)[: n // _BASE * _BASE].reshape(-1, _BASE).max(axis=1)
    words = words.astype(np.uint64)
    top = int(words.max()) ** 2
    length, first = _BASE, 1
    while TIMES * length <= n:
        starts = np.flatnonzero(far < 2 * length) * length
        for b, size, q in runs:
            if q <= length:
                i, j = np.searchsorted(starts, [b, b + size])
                inside = np.minimum(starts[i:j] + 3 * length, n) <= b + size
                if inside.any():
                    starts = np.concatenate([starts[:i], starts[i:j][~inside], starts[j:]])
        if len(starts):
            s, d = _matches(words, starts, length, first, _enough(length * top))
            open_ = np.ones(len(s), bool)

            def close(b: int, e: int, multiple: int, exact: bool, s=s, d=d, open_=open_, length=length) -> None:
                i, j = np.searchsorted(s, [b, e])
                hit = s[i:j] + length + d[i:j] <= e
                open_[i:j] &= ~(hit & ((d[i:j] == multiple) if exact else (d[i:j] % multiple == 0)))

            for b, size, q in runs:
                close(b, b + size, q, False)
            for k in np.lexsort((s, d)):
                if open_[k]:
                    q = int(d[k])
                    lo, hi = _stretch(words, int(s[k]), int(s[k]) + length, q)
                    found = hi + q - lo >= max(LEAST, TIMES * q)
                    if found:
                        runs.append((lo, hi + q - lo, q))
                    close(lo, hi + q, q, not found)
        far = far[: len(far) // 2 * 2].reshape(-1, 2).max(axis=1)
        length, first = 2 * length, 2 * length
    return sorted((b, size, q) for b, size, q in runs)


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those in no run, or among the first period of each run they are in."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def run_finder(spark) -> Callable[[Column], Column]:
    """A column function: text -> struct (n_words, runs, collapsed): every run, and the words that stay, joined by one space."""
    short_batches(spark)

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                words = utf8(text).split()
                runs = find_runs(pd.factorize(np.array(words, object))[0]) if len(words) >= LEAST else []
                kept = words
                if runs:
                    kept = [words[i] for i in np.flatnonzero(collapsed(len(words), runs)).tolist()]
                rows = [{"start": a, "length": b, "period": q} for a, b, q in runs]
                out.append((len(words), rows, b" ".join(kept).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(out, columns=["n_words", "runs", "collapsed"])

    return F.pandas_udf(work, FOUND)


def periodic_runs(docs: DataFrame, text_col: str = "text", out_col: str = "found") -> DataFrame:
    """All columns of `docs` and `out_col`, a struct (n_words, runs, collapsed); a column of that name is replaced."""
    return docs.withColumn(out_col, run_finder(docs.sparkSession)(F.col(text_col)))


def greatest(runs: Column) -> Column:
    """Of an array of runs the one with the greatest length / period, compared exactly; ties: smallest start, then period."""

    def better(a: Column, b: Column) -> Column:
        return a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])

    # the array is sorted by start, then period, so that the first of equal ones stays
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, none, lambda a, b: F.when(better(a, b), b).otherwise(a))


WORD = r"[^\x20\x09-\x0D]+"


def planted(text: Column, doc_id: Column) -> Column:
    """The text; where crc32 of the id is divisible by 10, one stretch of its words repeated up to the end.

    With g the tenth of that crc32 and n the number of words, the words from a = g % n on become repeats of the
    first p = 1 + (n - a) // (3 + g % 8) of them. A null id leaves the text as it is.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)
