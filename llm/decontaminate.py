"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items.

Texts and items become words (A-Z lowered, runs of digits, letters and non-ASCII bytes). A window is
`window` consecutive words of an item; an item of fewer words, but not none, is one window. The
automaton holds the windows with a space at either end, so a match starts and ends at word borders,
and each document is scanned once. Word positions are mapped back to the original text.

The windows are broadcast in parts of at most `PART_BYTES`; a benchmark that needs more parts is
searched part by part, with what goes from one to the next written in between, and the hits are united, so no size is
out of reach and no part too large.

Cases: null and empty texts have no words, no hits and the digest of the empty string. Null and
empty items have no window. Equal items count as often as they have ids; repeated rows of one item
count once. Every document row gives a row of its own, also rows that share an id or have none. An empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import short_batches, stored, utf8

WINDOW = 10
PART_BYTES = 3 << 20

_KEEP = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_WORD = re.compile(rb"[^ ]+")


def plain(text: str | None) -> bytes:
    """The UTF-8 text with A-Z lowered and a space for every other ASCII byte that is no digit or letter."""
    return utf8(text).translate(_KEEP)


def item_windows(bench: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(item, window): distinct windows of each item, as bytes."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for item, text in zip(batch["item"], batch["text"]):
                words = plain(text).split()
                last = max(1, len(words) - window + 1) if words else 0
                found += [(item, w) for w in {b" ".join(words[i : i + window]) for i in range(last)}]
            yield pd.DataFrame(found, columns=["item", "window"])

    rows = bench.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return rows.mapInPandas(work, "item string, window binary").distinct()


class Windows:
    """Windows to search for; each Python worker builds the automaton once."""

    def __init__(self, windows: list[bytes]):
        self.windows = windows
        self._built = None

    def __getstate__(self) -> dict:
        return {"windows": self.windows, "_built": None}

    def automaton(self) -> ahocorasick.Automaton:
        if self._built is None:
            built = ahocorasick.Automaton()
            for i, w in enumerate(self.windows):
                built.add_word(f" {w.decode('latin-1')} ", (i, w.count(b" ") + 1))
            built.make_automaton()
            self._built = built
        return self._built


def runs(firsts: np.ndarray, lasts: np.ndarray) -> list[tuple[int, int]]:
    """The intervals [first, last] united and sorted."""
    merged: list[list[int]] = []
    for a, b in sorted(zip(firsts.tolist(), lasts.tolist())):
        if merged and a <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


def scanner(spark: SparkSession, windows: list[bytes]) -> Callable[[Column], Column]:
    """A column function: text -> struct (n_words, windows, spans): the windows that occur, and runs of hit words with their place."""
    short_batches(spark)
    sent = spark.sparkContext.broadcast(Windows(windows))

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        search = sent.value.automaton() if sent.value.windows else None
        names = sent.value.windows
        for batch in batches:
            out = []
            for text in batch:
                flat = plain(text)
                words = flat.split()
                hits = list(search.iter(" " + b" ".join(words).decode("latin-1") + " ")) if search and words else []
                spans = []
                if hits:
                    after = np.cumsum([len(w) + 1 for w in words])  # the space behind each word
                    last = np.searchsorted(after, [end for end, _ in hits])
                    first = last - np.array([n for _, (_, n) in hits]) + 1
                    places = [m.span() for m in _WORD.finditer(flat)]
                    raw = utf8(text)
                    for a, b in runs(first, last):
                        start, end = places[a][0], places[b][1]
                        begin = len(raw[:start].decode("utf-8", "surrogatepass"))
                        size = len(raw[start:end].decode("utf-8", "surrogatepass"))
                        spans.append((a, b, begin, begin + size))
                out.append((len(words), [names[i] for i in {i for _, (i, _) in hits}], spans))
            yield pd.DataFrame(out, columns=["n_words", "windows", "spans"])

    return F.pandas_udf(
        work, "n_words long, windows array<binary>, spans array<struct<first:int,last:int,start:int,end:int>>"
    )


def without_leaks(
    docs: DataFrame, bench: DataFrame, window: int = WINDOW, text_col: str = "text", part_bytes: int = PART_BYTES
) -> DataFrame:
    """`docs` without the rows that contain a window; texts are filtered where they are read."""
    pairs = item_windows(bench, window, "item_id", "text")
    n = _part_count(pairs, part_bytes)
    for i, windows in enumerate(_parts(pairs, n)):
        docs = docs.filter(F.size(scanner(docs.sparkSession, windows)(F.col(text_col))["windows"]) == 0)
        if i < n - 1:  # one automaton at a time
            docs = stored(docs, "clean")
    return docs


def _part_count(pairs: DataFrame, part_bytes: int) -> int:
    total = pairs.select("window").distinct().agg(F.sum(F.length("window") + 8)).first()[0] or 0
    return max(1, -(-2 * total // part_bytes)) if total > part_bytes else 1


def _parts(pairs: DataFrame, n: int) -> Iterator[list[bytes]]:
    """The distinct windows in n lists, dealt by hash."""
    distinct = pairs.select("window").distinct()
    for i in range(n):
        mine = distinct.filter(F.pmod(F.xxhash64("window"), F.lit(n)) == i)
        yield sorted(bytes(r.window) for r in mine.toLocalIterator())


def decontaminate(
    docs: DataFrame,
    bench: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(id, n_words, n_hit, items, spans) per row; spans are (start, end) in characters of the original."""
    pairs = item_windows(bench, window, item_col, item_text_col)
    n = _part_count(pairs, part_bytes)
    rows = docs.select(
        F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    )
    if n > 1:  # a row has to have the same key in every scan
        rows = stored(rows, "documents")
    scans = None
    for windows in _parts(pairs, n):
        found = scanner(docs.sparkSession, windows)(F.col("text"))
        part = rows.select("key", "id", found.alias("_s")).select("key", "id", "_s.*")
        scans = part if scans is None else scans.union(part)
    scans = stored(scans, "scan")  # texts are scanned once; the hits are read twice
    # the runs of several parts may overlap: in order, each adds what lies beyond the furthest end so far
    ordered = F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans"))))
    per_doc = scans.groupBy("key").agg(
        F.first("id").alias("id"), F.max("n_words").alias("n_words"), ordered.alias("spans"), F.flatten(F.collect_list("windows")).alias("windows")
    )
    beyond = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(acc["end"] + 1, s["first"]) + 1)).alias("n"),
            F.greatest(acc["end"], s["last"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    items = (
        per_doc.filter(F.size("windows") > 0)
        .select("key", F.explode("windows").alias("window"))
        .join(pairs, "window")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    hit = per_doc.withColumn("n_hit", beyond).drop("windows")
    return hit.join(items, "key", "left").select(
        "id",
        "n_words",
        "n_hit",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("spans"),
    )
