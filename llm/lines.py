"""Line deduplication by a deletion neighbourhood: of lines at most one word edit apart, the earliest stays.

A line goes if an earlier line (smaller id, or higher up in the same document) has the same words, or,
for lines of `MIN_WORDS` words or more, turns into it by inserting, deleting or replacing one word.
Words are compared without regard to A-Z case and to white space. Earlier lines count even if they go
themselves, so the result does not depend on any order of work.

Every line within the bound shares a variant with the other: both without the word at the same place
(a replacement), or the longer one without a word and the shorter one as it is. Variants are hashed
keys that meet in buckets (`blocks`); a bucket needs only the earliest line per key, so a key that very
many lines share costs one row per chunk. Two lines one edit apart also agree in their first or last half; lines whose
halves occur in no other line are left out before variants are made, which loses nothing. What
remains is verified word by word against the line that beat it.

Cases: null texts stay null; lines without words are kept. A document may lose all its lines; its row
stays, with an empty text. Of rows that share an id, lines at equal places do not drop each other. A
null id counts as smaller than all others. Columns other than the id and the text are passed on;
`n_lines` and `n_dropped` replace columns of those names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.blocks import Blocks
from llm.ngram import _places
from llm.suffix import _numbers

MIN_WORDS = 8
CHUNK_BYTES = 2 << 20
_hash = xxhash.xxh64_intdigest


def _split(texts: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(document, line, bytes in lower case) of every line."""
    for d, text in enumerate(texts):
        for n, line in enumerate(text.lower().split(b"\n")):
            yield d, n, line


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return (keys >> np.uint64(33)) % np.uint64(n)


def _empty(kinds: tuple) -> list[array]:
    """Columns to append to: a number takes its own bytes, where rows of tuples would take ten times as many."""
    return [array(np.dtype(k).char) for k in kinds]


def _columns(filled: list[array], kinds: tuple) -> list[np.ndarray]:
    return [np.frombuffer(c, k) for c, k in zip(filled, kinds)]


def _packed(columns: list[np.ndarray], at: np.ndarray) -> tuple[bytes, ...]:
    return tuple(c[at].tobytes() for c in columns)


def _unpacked(sent: list[tuple[bytes, ...]], kinds: tuple) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns over all messages, and the message of each row."""
    columns = [np.concatenate([np.frombuffer(m[i], k) for m in sent]) for i, k in enumerate(kinds)]
    sizes = [len(m[0]) // np.dtype(kinds[0]).itemsize for m in sent]
    return columns, np.repeat(np.arange(len(sent)), sizes)


def _first_of(key: np.ndarray, doc: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the row of the earliest line with its key, and whether that is strictly earlier."""
    order = np.lexsort((line, doc, key))
    head = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(order) else np.zeros(0, bool)
    run = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0)) if len(order) else np.zeros(0, np.int64)
    first = np.empty(len(order), np.int64)
    first[order] = order[run]
    return first, (doc > doc[first]) | (doc == doc[first]) & (line > line[first])


_LINE = (np.uint64, np.int64, np.int32, np.int32)  # hash, document id, line, number of the line in its chunk
_HALF = (np.uint64, np.uint64, np.int32)  # half, line hash, number


def _ask_lines(n: int):
    def ask(ids: list, texts: list[bytes]) -> Iterator[tuple]:
        numbers = _numbers([r["_id"] for r in ids]).tolist()
        lines, halves = _empty(_LINE), _empty(_HALF)
        add, hashes, wholes, owners = [c.append for c in lines], *[c.append for c in halves]
        for k, (d, at, line) in enumerate(_split(texts)):
            words = line.split()
            if words:
                whole = _hash(b" ".join(words))
                for put, value in zip(add, (whole, numbers[d], at, k)):
                    put(value)
                if len(words) >= MIN_WORDS:
                    for m in (len(words), len(words) - 1):
                        for half, seed in ((words[: m // 2], 2 * m), (words[m // 2 - m :], 2 * m + 1)):
                            hashes(_hash(b" ".join(half), seed))
                            wholes(whole)
                            owners(k)
        whole, half = _columns(lines, _LINE), _columns(halves, _HALF)
        first, later = _first_of(*whole[:3])
        kept = np.flatnonzero(~later)
        firsts = np.zeros(len(whole[0]) and int(whole[3].max()) + 1, bool)
        firsts[whole[3][kept]] = True
        half = [c[firsts[half[2]]] for c in half]
        mine = dict(_places(_bucket(whole[0][kept], n)))
        other = dict(_places(_bucket(half[0], n)))
        none = np.zeros(0, np.int64)
        gone = whole[3][later].tobytes()
        for bucket in sorted(mine.keys() | other.keys()):
            yield bucket, (_packed(whole, kept[mine.get(bucket, none)]), _packed(half, other.get(bucket, none)), gone)
            gone = b""

    return ask


def _answer_lines(sent: list) -> Iterable[tuple[bytes, bytes]]:
    """Numbers of lines that repeat an earlier one, and of lines that share a half with another line."""
    (key, doc, line, number), owner = _unpacked([m[0] for m in sent], _LINE)
    _, later = _first_of(key, doc, line)
    (half, whole, k), of = _unpacked([m[1] for m in sent], _HALF)
    order = np.lexsort((whole, half))
    h, w = half[order], whole[order]
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (w[1:] != w[:-1])]) if len(h) else np.zeros(0, bool)
    run = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])) - 1 if len(h) else np.zeros(0, np.int64)
    several = np.zeros(len(h), bool)
    several[order] = (np.bincount(run, same) > 0)[run] if len(h) else False
    for i, m in enumerate(sent):
        gone = np.concatenate([number[(owner == i) & later], np.frombuffer(m[2], np.int32)])
        yield gone.tobytes(), np.unique(k[(of == i) & several]).tobytes()


def _marked(answers: dict) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a chunk's lines that repeat an earlier one, and of the others that share a half with another line."""
    gone, near = (np.unique(np.concatenate([np.frombuffer(a[i], np.int32) for a in answers.values()] or [np.zeros(0, np.int32)])) for i in (0, 1))
    return gone, np.setdiff1d(near, gone)


class Candidates:
    """Lines of a chunk that are first of their kind and share a half with another: their words and places."""

    def __init__(self, ids: list, texts: list[bytes], answers: dict):
        wanted = set(_marked(answers)[1].tolist())
        numbers = _numbers([r["_id"] for r in ids]).tolist()
        self.words, self.doc, self.line = [], [], []
        if wanted:
            for k, (d, at, line) in enumerate(_split(texts)):
                if k in wanted:
                    self.words.append(line.split())
                    self.doc.append(numbers[d])
                    self.line.append(at)

    def _rests(self) -> Iterator[tuple[int, bytes]]:
        """(place, line without the word there) for each word, line by line; place 0 is the whole line."""
        for words in self.words:
            whole = b" ".join(words)
            yield 0, whole
            begin = 0
            for i, word in enumerate(words, 1):
                after = begin + len(word) + 1
                yield i, whole[:begin] + whole[after:] if i < len(words) else whole[: max(begin - 1, 0)]
                begin = after

    def variants(self) -> list[np.ndarray]:
        """(key, kind, candidate): kind 0 lacks a word at a known place, 1 lacks some word, 2 is whole."""
        key, kind = array("Q"), bytearray()
        for i, rest in self._rests():
            if i:
                key.append(_hash(rest, i))
                key.append(_hash(rest))
                kind += b"\0\1"
            else:
                key.append(_hash(rest))
                kind.append(2)
        sizes = [1 + 2 * len(words) for words in self.words]
        return [np.frombuffer(key, np.uint64), np.frombuffer(kind, np.uint8), np.repeat(np.arange(len(sizes), dtype=np.int32), np.array(sizes, np.int64))]

    def _places(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.doc, np.int64)[c], np.array(self.line, np.int32)[c]

    def beaten_here(self) -> dict[int, tuple[int, int]]:
        """Candidate -> (document, line) of the chunk's earliest line that lacks the same but a word at the same place."""
        key = np.frombuffer(array("Q", (_hash(rest, i) for i, rest in self._rests() if i)), np.uint64)
        c = np.repeat(np.arange(len(self.words), dtype=np.int32), np.array([len(w) for w in self.words], np.int64))
        doc, line = self._places(c)
        first, later = _first_of(key, doc, line)
        beaten: dict[int, tuple[int, int]] = {}
        for i, f in zip(np.flatnonzero(later).tolist(), first[later].tolist()):
            _lower(beaten, int(c[i]), (int(doc[f]), int(line[f])))
        return beaten

    def questions(self) -> list[np.ndarray]:
        """Rows _VARIANT to ask about: of kind 0, and of kind 1 at the same place, the chunk's earliest only.

        The others have a witness in the chunk (`beaten_here`).
        """
        key, kind, c = self.variants()
        doc, line = self._places(c)
        at = np.flatnonzero(kind == 0)
        _, later = _first_of(key[at], doc[at], line[at])
        # rows of kinds 0 and 1 alternate: the same word is left out
        asks = np.ones(len(key), bool)
        asks[at[later]] = False
        asks[at[later] + 1] = False
        return [x[asks] for x in (key, kind, doc, line, c)]


def _lower(into: dict, key: int, value: tuple[int, int]) -> None:
    if key not in into or value < into[key]:
        into[key] = value


_VARIANT = (np.uint64, np.uint8, np.int64, np.int32, np.int32)


def _ask_variants(n: int):
    def ask(ids: list, texts: list[bytes], answers: dict) -> Iterator[tuple]:
        columns = Candidates(ids, texts, answers).questions()
        for bucket, at in _places(_bucket(columns[0], n)):
            yield bucket, _packed(columns, at)

    return ask


def _answer_variants(sent: list) -> Iterable[tuple[bytes, ...]]:
    """(candidate, document, line of the earlier line) for each row that has one."""
    (key, kind, doc, line, c), owner = _unpacked(sent, _VARIANT)
    found = []
    at = np.flatnonzero(kind == 0)
    first, later = _first_of(key[at], doc[at], line[at])
    found.append((at[later], at[first[later]]))
    for mine, theirs in ((1, 2), (2, 1)):
        a, b = np.flatnonzero(kind == mine), np.flatnonzero(kind == theirs)
        if not len(a) or not len(b):
            continue
        b = b[np.lexsort((line[b], doc[b], key[b]))]
        place = np.searchsorted(key[b], key[a])
        hit = (place < len(b)) & (key[b[np.minimum(place, len(b) - 1)]] == key[a])
        a, w = a[hit], b[place[hit]]
        earlier = (doc[w] < doc[a]) | (doc[w] == doc[a]) & (line[w] < line[a])
        found.append((a[earlier], w[earlier]))
    mine, witness = (np.concatenate(x) for x in zip(*found))
    for i in range(len(sent)):
        at = owner[mine] == i
        yield c[mine[at]].tobytes(), doc[witness[at]].tobytes(), line[witness[at]].tobytes()


def _witnesses(chunk: Candidates, answers: dict) -> dict[int, tuple[int, int]]:
    """Candidate -> the earliest line that beat it."""
    beaten = chunk.beaten_here()
    for c, doc, line in answers.values():
        for k, d, n in zip(*(np.frombuffer(x, t).tolist() for x, t in ((c, np.int32), (doc, np.int64), (line, np.int32)))):
            _lower(beaten, k, (d, n))
    return beaten


def _place_bucket(doc: int, line: int, n: int) -> int:
    return _hash(f"{doc}:{line}".encode()) % n


def _ask_check(n: int):
    def ask(ids: list, texts: list[bytes], lines: dict, variants: dict) -> Iterator[tuple]:
        chunk = Candidates(ids, texts, lines)
        beaten = _witnesses(chunk, variants)
        out: dict[int, tuple[list, list]] = {}
        for c, words in enumerate(chunk.words):
            at = (chunk.doc[c], chunk.line[c])
            out.setdefault(_place_bucket(*at, n), ([], []))[0].append((at, b" ".join(words)))
            if c in beaten:
                out.setdefault(_place_bucket(*beaten[c], n), ([], []))[1].append((c, beaten[c], b" ".join(words)))
        yield from sorted(out.items())

    return ask


def within_one_edit(a: list, b: list) -> bool:
    """Whether inserting, deleting or replacing at most one element turns a into b."""
    if abs(len(a) - len(b)) > 1:
        return False
    front = 0
    while front < min(len(a), len(b)) and a[front] == b[front]:
        front += 1
    back = 0
    while back < min(len(a), len(b)) - front and a[-1 - back] == b[-1 - back]:
        back += 1
    return max(len(a), len(b)) - front - back <= 1


def _answer_check(sent: list) -> Iterable[list[int]]:
    known = {at: words for lines, _ in sent for at, words in lines}
    for _, beaten in sent:
        yield [c for c, at, words in beaten if at in known and within_one_edit(words.split(), known[at].split())]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the kept lines as its text, and `n_lines`, `n_dropped` (longs)."""
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    row = F.struct(
        F.col(id_col).cast("long").alias("_id"), F.col(text_col).isNull().alias("_null"), F.struct(*rest).alias("_rest")
    )
    blocks = Blocks(docs.select(row.alias("id"), F.col(text_col).alias("text")), CHUNK_BYTES)
    n = blocks.buckets
    lines = blocks.answers(blocks.ask(_ask_lines(n)), _answer_lines)
    variants = blocks.answers(blocks.ask(_ask_variants(n), lines), _answer_variants)
    checked = blocks.answers(blocks.ask(_ask_check(n), lines, variants), _answer_check)

    def rows(ids: list, texts: list[bytes], lines: dict, checked: dict) -> Iterator[tuple]:
        repeated, near = _marked(lines)
        gone = set(repeated.tolist()) | {int(near[c]) for cs in checked.values() for c in cs}
        k = 0
        for key, text in zip(ids, texts):
            parts = text.split(b"\n")
            kept = [line for i, line in enumerate(parts, k) if i not in gone]
            k += len(parts)
            new = None if key["_null"] else b"\n".join(kept).decode("utf-8", "replace")
            yield (*key["_rest"], new, len(parts), len(parts) - len(kept))

    shape = T.StructType([docs.schema[c] for c in rest] + [
        T.StructField(text_col, T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())
    ])
    made = spark.createDataFrame(blocks.finish(rows, lines, checked), shape, verifySchema=False)
    return made.select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
