"""Removal of repeated 100-byte strings by bucket-pointer refinement of suffixes.

A byte goes if some `LENGTH`-byte string over it also starts earlier: in a document with a smaller id,
or earlier in the same one. Each string of that length is named by its smallest 32-gram (the leftmost
one of least hash), which equal strings share at the same offset. Those 32-grams are the initial
buckets; strings whose bucket has one member are done. The others are refined by sorting on the
bucket identifiers of later offsets: the 50-gram at the start, then, within the buckets that still
have several members, the 50-gram 50 bytes on. What remains together is equal, and all but the
earliest are removed.

Chunks of documents ask for the buckets' sizes, then for the refinement (`blocks`). A chunk removes
what it repeats itself before it asks, so a passage that very many documents share is asked about
once per chunk, and sends only the bytes around bucket members, never whole texts. Buckets with over
`HOT` members are spread: their strings are asked about one by one, by hash.

Cases: a null text is empty; texts under 100 bytes lose nothing. Matches never cross documents. Of
rows that share an id, equal strings at equal places do not remove each other. A null id counts as
smaller than all others. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import Blocks
from llm.ngram import _PIECE, Rolling, _mixed, _places

LENGTH = 100
GRAM = 32
HALF = 50
HOT = 50_000
SLICE = 10_000  # bucket members refined at once
CHUNK_BYTES = 1 << 20
_AT = np.uint64((1 << 31) - 1)
_STEP = np.uint64(0x9FB21C651E98DF25)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(out) - (width - span)], out[width - span :]) if span < width else out


class Members:
    """Bucket members of some texts: the string starts lo..hi share the 32-gram at `at` (places in `data`)."""

    def __init__(self, texts: list[bytes], first_doc: int, rolling: Rolling):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.begin = np.cumsum([0] + [len(t) for t in texts])
        self.rolling = rolling
        self.first = first_doc
        n = len(self.data) - LENGTH + 1
        if n <= 0:
            self.lo = self.hi = self.at = self.doc = np.zeros(0, np.int64)
            self.gram = np.zeros(0, np.uint64)
            return
        sums = rolling.sums(self.data)
        places = np.arange(len(self.data) - GRAM + 1, dtype=np.uint64)
        grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * rolling.down[: len(places)])
        least = _least((grams & ~_AT) | places, LENGTH - GRAM + 1)[:n]
        at = (least & _AT).astype(np.int64)
        doc = np.repeat(np.arange(len(texts)), np.diff(self.begin))[:n]
        whole = np.flatnonzero(np.arange(n) + LENGTH <= self.begin[doc + 1])
        at, doc = at[whole], doc[whole]
        cut = np.flatnonzero((np.diff(at) != 0) | (np.diff(doc) != 0)) + 1 if len(at) else np.zeros(0, np.int64)
        head = np.concatenate([[0], cut]).astype(np.int64) if len(at) else np.zeros(0, np.int64)
        tail = np.concatenate([cut, [len(at)]]).astype(np.int64) - 1 if len(at) else np.zeros(0, np.int64)
        self.lo, self.hi, self.at = whole[head], whole[tail], at[head]
        self.doc = doc[head] + first_doc
        self.gram = grams[self.at]

    def keep(self, which: np.ndarray) -> None:
        self.lo, self.hi, self.at = self.lo[which], self.hi[which], self.at[which]
        self.doc, self.gram = self.doc[which], self.gram[which]

    def strings(self) -> tuple[np.ndarray, ...]:
        """(member, start, bucket, identifier at the start, identifier HALF bytes on) of each string."""
        sizes = self.hi - self.lo + 1
        member = np.repeat(np.arange(len(sizes)), sizes)
        start = np.arange(len(member)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.lo[member]
        bucket = _mixed(self.gram[member] + (self.at[member] - start).astype(np.uint64) * _STEP)
        sums = self.rolling.sums(self.data)  # not kept, eight bytes for each of the text
        near = self.rolling.of(sums, start, start + HALF)
        far = self.rolling.of(sums, start + HALF, start + LENGTH)
        return member, start, bucket, near, far


def _pieces(texts: list[bytes], rolling: Rolling) -> Iterator[Members]:
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) < _PIECE):
            size += len(texts[stop])
            stop += 1
        yield Members(texts[at:stop], at, rolling)
        at = stop


def _later(buckets: Iterable[np.ndarray], ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether an equal string starts earlier. `buckets` are identifiers to refine by, one after the other."""
    alive = np.arange(len(ids))
    name = np.zeros(len(ids), np.uint64)
    for identifier in buckets:
        _, of, size = np.unique(_mixed(name) + identifier[alive], return_inverse=True, return_counts=True)
        several = size[of] > 1
        alive, name = alive[several], of[several].astype(np.uint64)
    order = np.lexsort((starts[alive], ids[alive], name))
    alive, name = alive[order], name[order]
    head = np.maximum.accumulate(np.where(np.concatenate([[True], name[1:] != name[:-1]]), np.arange(len(name)), 0)) if len(name) else name
    earliest = alive[head.astype(np.int64)]
    out = np.zeros(len(ids), bool)
    out[alive] = (ids[alive] > ids[earliest]) | (ids[alive] == ids[earliest]) & (starts[alive] > starts[earliest])
    return out


def _numbers(ids: list) -> np.ndarray:
    return np.array([-(2**63) if i is None else i for i in ids], dtype=np.int64)


def _ask_sizes(n: int):
    rolling = Rolling()

    def ask(ids: list, texts: list[bytes]) -> Iterator[tuple]:
        grams = np.concatenate([m.gram for m in _pieces(texts, rolling)] or [np.zeros(0, np.uint64)])
        distinct, counts = np.unique(grams, return_counts=True)
        for bucket, at in _places((distinct >> np.uint64(33)) % np.uint64(n)):
            yield bucket, (distinct[at].tobytes(), counts[at].astype(np.int32).tobytes())

    return ask


def _answer_sizes(hot: int):
    def answer(sent: list) -> Iterable[bytes]:
        grams = [np.frombuffer(g, np.uint64) for g, _ in sent]
        _, of = np.unique(np.concatenate(grams), return_inverse=True)
        counts = np.bincount(of, np.concatenate([np.frombuffer(c, np.int32) for _, c in sent]))
        kind = np.where(counts > hot, 2, np.where(counts > 1, 1, 0)).astype(np.uint8)[of]
        for part in np.split(kind, np.cumsum([len(g) for g in grams])[:-1].tolist()):
            yield np.packbits(np.unpackbits(part[:, None], axis=1)[:, 6:]).tobytes()

    return answer


class Open:
    """A chunk after its own repeats are known: which strings are removed, and which it has to ask about."""

    def __init__(self, ids: list, texts: list[bytes], sizes: dict, n: int, rolling: Rolling):
        pieces = list(_pieces(texts, rolling))
        grams = np.concatenate([m.gram for m in pieces] or [np.zeros(0, np.uint64)])
        distinct, of = np.unique(grams, return_inverse=True)
        kind = np.zeros(len(distinct), np.uint8)
        for bucket, at in _places((distinct >> np.uint64(33)) % np.uint64(n)):
            two = np.unpackbits(np.frombuffer(sizes[bucket], np.uint8))[: 2 * len(at)].reshape(-1, 2)
            kind[at] = two[:, 0] * 2 + two[:, 1]
        kind, done = kind[of], 0
        self.kind, self.gram, self.bytes, self.offset = [], [], [], []
        columns: list[list[np.ndarray]] = [[] for _ in range(6)]
        members = 0
        for m in pieces:
            mine = kind[done : done + len(m.gram)]
            done += len(m.gram)
            m.keep(mine > 0)
            member, start, bucket, near, far = m.strings()
            local = start - m.begin[m.doc[member] - m.first]
            for column, values in zip(columns, (member + members, m.doc[member], local, bucket, near, far)):
                column.append(values if values.dtype == np.uint64 else values.astype(np.int32))
            self.kind.append(mine[mine > 0])
            self.gram.append(m.gram)
            self.bytes += [(m.data, a, b + LENGTH) for a, b in zip(m.lo.tolist(), m.hi.tolist())]
            self.offset.append(m.at - m.lo)
            members += len(m.gram)
        join = lambda parts, kind_: np.concatenate(parts) if parts else np.zeros(0, kind_)
        self.member, self.doc, self.start = (join(c, np.int32) for c in columns[:3])
        self.bucket, self.near, self.far = (join(c, np.uint64) for c in columns[3:6])
        self.kind, self.gram, self.offset = join(self.kind, np.uint8), join(self.gram, np.uint64), join(self.offset, np.int64)
        self.ids = _numbers(ids)
        self.removed = _later((self.bucket, self.near, self.far), self.ids[self.doc], self.start)

    def questions(self, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, members sent whole, strings sent by hash)."""
        first = ~self.removed
        asks = np.zeros(len(self.kind), bool)
        asks[self.member[first]] = True
        whole = np.flatnonzero(asks & (self.kind == 1))
        hashed = np.flatnonzero(first & (self.kind[self.member] == 2))
        by_gram = dict(_places((self.gram[whole] >> np.uint64(33)) % np.uint64(n)))
        by_hash = dict(_places(_mixed(self.near[hashed] + self.bucket[hashed]) % np.uint64(n)))
        none = np.zeros(0, np.int64)
        for bucket in sorted(by_gram.keys() | by_hash.keys()):
            yield bucket, whole[by_gram.get(bucket, none)], hashed[by_hash.get(bucket, none)]

    def heads(self) -> np.ndarray:
        """The first string of each member, in order; members own consecutive strings."""
        return np.searchsorted(self.member, np.arange(len(self.kind) + 1))


def _ask_strings(n: int):
    rolling = Rolling()

    def ask(ids: list, texts: list[bytes], sizes: dict) -> Iterator[tuple]:
        chunk = Open(ids, texts, sizes, n, rolling)
        heads = chunk.heads()
        for bucket, whole, hashed in chunk.questions(n):
            parts = [chunk.bytes[i] for i in whole.tolist()]
            at = heads[whole]
            yield bucket, (
                tuple(
                    x.tobytes()
                    for x in (
                        chunk.gram[whole],
                        chunk.offset[whole].astype(np.int32),
                        chunk.ids[chunk.doc[at]],
                        chunk.start[at].astype(np.int32),
                        np.array([b - a for _, a, b in parts], np.int32),
                    )
                ),
                b"".join(data[a:b].tobytes() for data, a, b in parts),
                tuple(
                    x.tobytes()
                    for x in (
                        chunk.bucket[hashed],
                        chunk.near[hashed],
                        chunk.far[hashed],
                        chunk.ids[chunk.doc[hashed]],
                        chunk.start[hashed].astype(np.int32),
                    )
                ),
            )

    return ask


_KINDS = (np.uint64, np.int32, np.int64, np.int32, np.int32)
_HASHED = (np.uint64, np.uint64, np.uint64, np.int64, np.int32)


def _answer_strings(sent: list) -> Iterable[tuple[bytes, bytes]]:
    rolling = Rolling()
    columns = [[np.frombuffer(x, k) for x, k in zip(head, _KINDS)] for head, _, _ in sent]
    gram, offset, ids, start, size = (np.concatenate(c) for c in zip(*columns))
    owner = np.repeat(np.arange(len(sent)), [len(c[0]) for c in columns])
    begins = np.concatenate([np.cumsum(c[4]) - c[4] for c in columns])
    count = size.astype(np.int64) - LENGTH + 1
    slot = np.cumsum(count) - count
    bits = np.zeros(int(count.sum()), bool)
    order = np.argsort(gram, kind="stable")
    edges = np.concatenate([[0], np.flatnonzero(np.diff(gram[order])) + 1, [len(order)]]) if len(order) else np.zeros(1, np.int64)
    a = 0
    while a < len(order):
        b = int(edges[np.searchsorted(edges, min(a + SLICE, len(order)))])
        mine = order[a:b]
        a = b
        data = np.frombuffer(b"".join(sent[owner[i]][1][begins[i] : begins[i] + size[i]] for i in mine.tolist()), np.uint8)
        sums = rolling.sums(data)
        place = np.cumsum(size[mine].astype(np.int64)) - size[mine]
        member = np.repeat(np.arange(len(mine)), count[mine])
        step = np.arange(len(member)) - np.repeat(np.cumsum(count[mine]) - count[mine], count[mine])
        at = place[member] + step
        bucket = _mixed(gram[mine][member] + (offset[mine][member] - step).astype(np.uint64) * _STEP)
        near, far = rolling.of(sums, at, at + HALF), rolling.of(sums, at + HALF, at + LENGTH)
        bits[slot[mine][member] + step] = _later((bucket, near, far), ids[mine][member], start[mine][member] + step)
    hashed = [[np.frombuffer(x, k) for x, k in zip(tail, _HASHED)] for _, _, tail in sent]
    bucket, near, far, ids2, start2 = (np.concatenate(c) for c in zip(*hashed))
    later = _later((bucket, near, far), ids2, start2)
    strings = np.bincount(owner, count, len(sent)).astype(np.int64) if len(owner) else np.zeros(len(sent), np.int64)
    cuts, cuts2 = np.cumsum(strings)[:-1].tolist(), np.cumsum([len(h[0]) for h in hashed])[:-1].tolist()
    for x, y in zip(np.split(bits, cuts), np.split(later, cuts2)):
        yield np.packbits(x).tobytes(), np.packbits(y).tobytes()


def _spans(starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings at the sorted `starts`."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > LENGTH) + 1
    heads, tails = np.concatenate([[0], cut]), np.concatenate([cut, [len(starts)]]) - 1
    return list(zip(starts[heads].tolist(), (starts[tails] + LENGTH).tolist()))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept): removed byte ranges and the bytes that stay, per row."""
    spark = docs.sparkSession
    blocks = Blocks(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), CHUNK_BYTES)
    n = blocks.buckets
    sizes = blocks.answers(blocks.ask(_ask_sizes(n)), _answer_sizes(hot))
    found = blocks.answers(blocks.ask(_ask_strings(n), sizes), _answer_strings)
    rolling = Rolling()

    def rows(ids: list, texts: list[bytes], sizes: dict, found: dict) -> Iterator[tuple]:
        chunk = Open(ids, texts, sizes, n, rolling)
        heads = chunk.heads()
        removed = chunk.removed.copy()
        for bucket, whole, hashed in chunk.questions(n):
            bits, later = (np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool) for x in found[bucket])
            counts = heads[whole + 1] - heads[whole]
            member = np.repeat(np.arange(len(whole)), counts)
            step = np.arange(len(member)) - np.repeat(np.cumsum(counts) - counts, counts)
            removed[heads[whole][member] + step] |= bits[: len(member)]
            removed[hashed] |= later[: len(hashed)]
        doc, start = chunk.doc[removed], chunk.start[removed]
        order = np.lexsort((start, doc))
        doc, start = doc[order], start[order]
        edges = np.searchsorted(doc, np.arange(len(ids) + 1))
        for i, (key, raw) in enumerate(zip(ids, texts)):
            spans = _spans(start[edges[i] : edges[i + 1]])
            kept, last = [], 0
            for a, b in spans:
                kept.append(raw[last:a])
                last = b
            kept.append(raw[last:])
            yield key, len(raw), sum(b - a for a, b in spans), spans, bytearray(b"".join(kept))

    shape = "id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"
    return spark.createDataFrame(blocks.finish(rows, sizes, found), shape, verifySchema=False)
