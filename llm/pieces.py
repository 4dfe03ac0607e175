"""SentencePiece encoding and decoding: the merges of a BPE model per word, the max-plus scan for a unigram one.

A text, with a leading space and spaces written as U+2581, is cut into pieces of the vocabulary as the
SentencePiece library does for the model's kind. A character without a piece becomes byte pieces.

BPE: starting from characters, the adjacent pair whose joint piece has the highest score is merged, the
leftmost of equal ones first, until no pair is a piece. The result is not the path with the largest sum of
scores (they are ranks), so a max-plus scan cannot give it. No piece has U+2581 behind another character, so
no merge crosses the border in front of it: words are merged by themselves and common ones are kept.
Giant texts are cut into chunks at fixed places; the words that lie in one chunk are encoded there, and what
stands between the last border of one chunk and the first of a later one is put together again and encoded
as a row of its own. A single word is always merged in one piece, in O(n log n).

Unigram (and any other kind): the sum of the scores is largest. Giant texts are cut into chunks at fixed places.
A piece may cross a border by up to L - 1 characters; how far it does is the state there. Each chunk yields the
L x L matrix of best sums from one border state to the next, the matrices are combined by max-plus products,
which are associative, and when the border states are known every chunk is traced back by itself. Best paths
meet in front of U+2581; a chunk is therefore cut there into words, whose encodings are kept, and only its first
and last word are tried for several states. Scores are integers with a tie-breaking part per
piece, so sums are exact and chunked and whole texts give the same ids.

Cases: null texts have null ids, empty texts none. A U+2581 of the text itself becomes bytes, so that
decode(encode(text)) is the text (the library takes it for a space). Repeated rows get equal ids. `ids` and
`score` replace columns of those names; other columns are passed on.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import sentencepiece
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import short_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GIANT = 1 << 16  # characters
CHUNK = 1 << 14
SPACE = "▁"
_LOW = -(1 << 62)
_WORD = re.compile(" *[^ ]+| +")
_BORDER = re.compile("[^ ](?= )")
_KEPT = 100_000
_SHORT = 24  # characters of words that are merged side by side
_TOGETHER = 1 << 20  # characters whose words are looked up at once
_SHAPE = "ids array<int>, score double"
BPE = 2  # TrainerSpec.model_type


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 0x7F) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = {1: (8, at), 5: (4, at)}.get(tag & 7) or varint(at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def model_type(model: bytes) -> int:
    """1 unigram (the default), 2 BPE, 3 word, 4 character."""
    trainer = b"".join(v for k, v in _fields(model) if k == 2)
    return next((v for k, v in _fields(trainer) if k == 3), 1)


class Vocabulary:
    """Pieces and integer scores, small enough to broadcast (bounded by the model file)."""

    def __init__(self, path: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bpe = model_type(model.serialized_model_proto()) == BPE
        self.merges: dict[str, tuple[int, float]] = {}  # of a BPE model: every piece that a merge may give
        self.decoded: list[bytes] = []
        found, self.bytes = {}, [-1] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.decoded.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.decoded.append(b"")
            else:
                self.decoded.append(piece.replace(SPACE, " ").encode())
                self.merges[piece.replace(SPACE, " ")] = (i, model.get_score(i))
                if model.get_score(i) > -1e8:  # below: pieces the model keeps out of the search
                    found[piece.replace(SPACE, " ")] = (i, model.get_score(i))
        worst = min((s for _, s in found.values()), default=0.0) - 10
        # a character in bytes counts once, with its first byte
        self.scores = np.array([model.get_score(i) for i in range(model.get_piece_size())])
        for b, i in enumerate(self.bytes):
            self.scores[i] = 0.0 if 0x80 <= b < 0xC0 else worst
        self.unit = 2.0**26 / max(1.0, -worst)
        self.table = {p: (i, self._whole(s, p)) for p, (i, s) in found.items()}
        self.unknown = self._whole(worst, "")
        self.width = max(map(len, self.table), default=1)
        # every beginning of a piece, with the piece's sum if it is one itself: a search stops where nothing goes on
        self.starts: dict[str, int | None] = {p[:k]: None for p in self.table for k in range(1, len(p))}
        self.starts |= {p: s for p, (_, s) in self.table.items()}
        self.parted = not any(" " in p.lstrip(" ") for p in (self.merges if self.bpe else self.table))
        self._known: dict[str, bytes] = {}
        self._earlier: dict[str, bytes] = {}
        if self.bpe:
            self._pair_up()

    def _whole(self, score: float, piece: str) -> int:
        """The score in `unit`s, times 64, plus a tie-breaking part below 64."""
        return (round(score * self.unit) << 6) + (xxhash.xxh64_intdigest(piece.encode()) & 63)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}, "_earlier": {}}

    def paths(self, x: str, start: int, stop: int) -> tuple[list[int], list[int]]:
        """Best sums to every end, over pieces that begin in [start, stop), and where the last piece begins."""
        best, back = [_LOW] * (len(x) + 1), [-1] * (len(x) + 1)
        best[start] = 0
        table, starts, size = self.table, self.starts, len(x)
        for p in range(start, stop):
            here = best[p]
            if here == _LOW:
                continue
            for q in range(p + 1, size + 1):
                part = x[p:q]
                if part not in starts:
                    break
                gain = starts[part]
                if gain is not None and here + gain > best[q]:
                    best[q], back[q] = here + gain, p
            if x[p] not in table and here + self.unknown > best[p + 1]:
                best[p + 1], back[p + 1] = here + self.unknown, p
        return best, back

    def merged(self, x: str) -> list[str]:
        """The pieces that BPE merges make of `x`; the best pair first, the leftmost of equal ones."""
        merges, size = self.merges, len(x)
        end = list(range(1, size + 1))  # end[i]: where the piece that begins at i ends, 0 if none begins there
        before = list(range(-1, size))  # where the piece in front of the one at i begins
        pairs = [(-merges[x[i : i + 2]][1], i, i + 2) for i in range(size - 1) if x[i : i + 2] in merges]
        heapq.heapify(pairs)
        while pairs:
            _, i, stop = heapq.heappop(pairs)
            j = end[i]
            if not j or j >= stop or end[j] != stop:  # one of the two was merged meanwhile
                continue
            end[i], end[j] = stop, 0
            if stop < size:
                before[stop] = i
                if (found := merges.get(x[i : end[stop]])) is not None:
                    heapq.heappush(pairs, (-found[1], i, end[stop]))
            if i and (found := merges.get(x[before[i] : stop])) is not None:
                heapq.heappush(pairs, (-found[1], before[i], stop))
        out, at = [], 0
        while at < size:
            out.append(x[at : end[at]])
            at = end[at]
        return out

    def _pair_up(self) -> None:
        """Symbols (pieces, and the characters they are made of) by number, and the pairs of them that make a piece."""
        symbols = self._texts = sorted({*self.merges, *(c for p in self.merges for c in p)})
        number = {x: i for i, x in enumerate(symbols)}
        self._symbol = {ord(x): i for x, i in number.items() if len(x) == 1}
        self._piece = np.array([self.merges.get(x, (-1,))[0] for x in symbols], np.int64)
        pairs = {}
        for p, (_, score) in self.merges.items():
            for k in range(1, len(p)):
                if p[:k] in number and p[k:] in number:
                    pairs[number[p[:k]] * len(symbols) + number[p[k:]]] = (-score, number[p])
        self._pairs = np.array(sorted(pairs), np.int64)
        self._rank = np.array([pairs[k][0] for k in self._pairs.tolist()], np.float64)
        self._made = np.array([pairs[k][1] for k in self._pairs.tolist()], np.int64)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of the piece that two neighbours make; an infinite rank if they make none."""
        key = np.where((a >= 0) & (b >= 0), a * len(self._piece) + b, -1)
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        hit = self._pairs[at] == key
        return np.where(hit, self._rank[at], np.inf), self._made[at]

    def merged_together(self, words: list[str]) -> list[bytes]:
        """The ids of `merged` of many words of up to `_SHORT` characters: all of them make their next merge at once."""
        if not words or not len(self._pairs):
            return [self._ids(w) for w in words]
        sizes = np.array([len(w) for w in words])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds, of = np.unique(codes, return_inverse=True)
        known = np.array([self._symbol.get(c, -2 - c) for c in kinds.tolist()], np.int64)[of]
        ends = np.cumsum(sizes)
        out: list[bytes] = [b""] * len(words)
        for low, high in ((0, 6), (6, 9), (9, 12), (12, 16), (16, _SHORT)):
            index = np.flatnonzero((sizes > low) & (sizes <= high))
            if not len(index):
                continue
            place = (ends[index] - sizes[index])[:, None] + np.arange(high)
            parts = np.where(np.arange(high) < sizes[index][:, None], known[np.minimum(place, len(known) - 1)], -1)
            ranks, made = self._pair(parts[:, :-1], parts[:, 1:])
            while len(index):
                best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(index), np.int64)
                going = ranks[np.arange(len(index)), best] < np.inf if ranks.shape[1] else np.zeros(len(index), bool)
                self._finished(index[~going], parts[~going], out)
                index, parts, ranks, made, best = index[going], parts[going], ranks[going], made[going], best[going]
                if not len(index):
                    break
                row = np.arange(len(index))
                parts[row, best] = made[row, best]
                parts = np.where(np.arange(parts.shape[1] - 1) > best[:, None], parts[:, 1:], parts[:, :-1])
                after = np.arange(ranks.shape[1] - 1) >= best[:, None]
                ranks, made = np.where(after, ranks[:, 1:], ranks[:, :-1]), np.where(after, made[:, 1:], made[:, :-1])
                for at in (best - 1, best):
                    r = row[(at >= 0) & (at < ranks.shape[1])]
                    c = at[r]
                    ranks[r, c], made[r, c] = self._pair(parts[r, c], parts[r, c + 1])
        return out

    def _finished(self, index: np.ndarray, parts: np.ndarray, out: list[bytes]) -> None:
        used = parts != -1
        ids = np.where(parts >= 0, self._piece[np.maximum(parts, 0)], -1)
        whole = ((ids >= 0) | ~used).all(axis=1)
        flat = ids[whole][used[whole]].astype("<i4").tobytes()
        ends = (np.cumsum(used[whole].sum(axis=1)) * 4).tolist()
        for i, a, b in zip(index[whole].tolist(), [0, *ends], ends):
            out[i] = flat[a:b]
        for i, row, of in zip(index[~whole].tolist(), parts[~whole].tolist(), ids[~whole].tolist()):
            spelt: list[int] = []  # with characters in bytes
            for part, piece in zip(row, of):
                if piece >= 0:
                    spelt.append(piece)
                elif part != -1:
                    char = self._texts[part] if part >= 0 else chr(-2 - part)
                    spelt += [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")]
            out[i] = np.array(spelt, "<i4").tobytes()

    def _ids(self, x: str) -> bytes:
        found, ids = (self.merges, []) if self.bpe else (self.table, [])
        for piece in self.merged(x) if self.bpe else self._searched(x):
            if piece in found:
                ids.append(found[piece][0])
            else:
                ids += [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
        return np.array(ids, "<i4").tobytes()

    def _searched(self, x: str) -> list[str]:
        """The pieces of the path with the largest sum."""
        _, back = self.paths(x, 0, len(x))
        out, at = [], len(x)
        while at:
            out.append(x[back[at] : at])
            at = back[at]
        return out[::-1]

    def word(self, x: str) -> bytes:
        """Ids of the pieces of `x`, as 32-bit integers."""
        hit = self._known.get(x) or self._earlier.get(x)
        if hit is None:
            hit = self._ids(x)
        self._keep(x, hit)
        return hit

    def _keep(self, x: str, hit: bytes) -> None:
        if len(x) <= 40:
            if len(self._known) >= _KEPT:  # words that are not met again go with the older half
                self._known, self._earlier = {}, self._known
            self._known[x] = hit

    def words(self, x: str) -> list[str]:
        return _WORD.findall(x) if self.parted else [x] if x else []

    def ends(self, x: str) -> tuple[str, str, str]:
        """`x` up to its first border between words, what lies between borders, and what follows the last one."""
        if not self.parted:
            return x, "", ""
        first = _BORDER.search(x)
        if first is None:
            return x, "", ""
        last = x.rstrip(" ").rfind(" ") + 1 if x[-1] != " " else len(x)
        last = len(x[:last].rstrip(" "))
        return x[: first.start() + 1], x[first.start() + 1 : last], x[last:]

    def encode(self, x: str) -> tuple[np.ndarray, float]:
        """Ids and score of a prepared text, from border to border."""
        known = self._known.get  # of a half that may have become the older one meanwhile
        ids = np.frombuffer(b"".join([known(w) or self.word(w) for w in self.words(x)]), "<i4")
        return ids, float(self.scores[ids].sum())

    def encode_all(self, texts: Sequence[str]) -> list[tuple[np.ndarray, float]]:
        """`encode` of each of several texts; words that are new are merged together."""
        if not self.bpe:
            return [self.encode(x) for x in texts]
        out, held, size = [], [], 0
        for n, x in enumerate(texts):
            held.append(x)
            size += len(x)
            if size >= _TOGETHER or n == len(texts) - 1:
                lists = [self.words(x) for x in held]
                found = {w: self._known.get(w) or self._earlier.get(w) for w in set().union(*lists)}
                fresh = [w for w, hit in found.items() if hit is None]
                short = [w for w in fresh if len(w) <= _SHORT]
                found |= zip(short, self.merged_together(short))
                found |= {w: self._ids(w) for w in fresh if len(w) > _SHORT}
                for w, hit in found.items():
                    self._keep(w, hit)
                for words in lists:
                    ids = np.frombuffer(b"".join([found[w] for w in words]), "<i4")
                    out.append((ids, float(self.scores[ids].sum())))
                held, size = [], 0
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.decoded.__getitem__, ids))[1:].decode("utf-8", "replace")

    def transfer(self, x: str, size: int) -> np.ndarray:
        """Matrix of a chunk: the first `size` characters of `x`; the rest shows what follows."""
        wide = self.width
        out = np.full((wide, wide), _LOW, np.int64)
        starts, at = [0], 0
        for w in self.words(x):
            at += len(w)
            starts.append(at)
        # borders between words of `x` that lie in the chunk: all paths pass there
        safe = [p for p in starts[1:-1] if p <= size] if self.parted else []
        # a space cut in two by the chunk's start is no border of this list; spaces merge into one word
        if not safe:
            for s in range(min(wide, size + 1)):
                best, _ = self.paths(x, s, size)
                for e in range(min(wide, len(x) - size + 1)):
                    out[s, e] = best[size + e]
            return out
        first, last = safe[0], safe[-1]
        middle = sum(self.paths(w, 0, len(w))[0][-1] for w in self.words(x[first:last]))
        head = [self.paths(x[:first], s, first)[0][first] if s <= first else _LOW for s in range(wide)]
        tail, _ = self.paths(x[last:], 0, size - last)
        for s, a in enumerate(head):
            for e in range(min(wide, len(x) - size + 1)):
                b = tail[size - last + e]
                if a != _LOW and b != _LOW:
                    out[s, e] = a + middle + b
        return out


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices."""
    both = np.where((a[:, :, None] > _LOW) & (b[None, :, :] > _LOW), a[:, :, None] + b[None, :, :], _LOW)
    return both.max(axis=1)


def border_states(matrices: list[np.ndarray]) -> list[int]:
    """State at each border, the outer ones included, of the best path through all chunks."""
    reached = [np.full(len(matrices[0]), _LOW, np.int64)]
    reached[0][0] = 0
    for m in matrices:
        reached.append(combine(reached[-1][None, :], m)[0])
    states = [0]
    for before, m in zip(reached[-2::-1], matrices[::-1]):
        column = m[:, states[-1]]
        states.append(int(np.argmax(np.where((before > _LOW) & (column > _LOW), before + column, _LOW))))
    return states[::-1]


def _prepared(text: str) -> str:
    """Leading space; the text's own U+2581 stays and matches no piece, since pieces are kept with spaces."""
    return " " + text if text else ""


def _merged_chunks(cut: DataFrame, sent: Broadcast, chunk: int) -> DataFrame:
    """(_key, k, ids, score) for the parts of giant texts, from words that are merged whole."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for key, k, x in zip(batch["_key"], batch["k"], batch["x"]):
                head, middle, tail = sent.value.ends(x[:chunk])
                whole = not middle and not tail
                ids, score = sent.value.encode(middle)
                made.append((key, k, head, None if whole else tail, ids, score))
            yield pd.DataFrame(made, columns=["_key", "k", "head", "tail", "ids", "score"])

    # a chunk without a border has no tail: its text belongs to the word that began before it
    made = cut.mapInPandas(parts, f"_key string, k int, head string, tail string, {_SHAPE}")

    def across(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        out, open_at, held = [], -1, []
        for k, head, tail in zip(group["k"], group["head"], group["tail"]):
            held.append(head)
            if tail is not None:
                out.append((open_at, "".join(held)))
                open_at, held = k, [tail]
        out.append((open_at, "".join(held)))
        return pd.DataFrame({"_key": group["_key"].iloc[0], "k": [k for k, _ in out], "x": [x for _, x in out]})

    # of a text, only what lies between the last border of a chunk and the next border comes together here
    joints = made.select("_key", "k", "head", "tail").groupBy("_key").applyInPandas(across, "_key string, k int, x string")

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sent.value.encode(x) for x in batch["x"]]
            yield pd.DataFrame({"_key": batch["_key"], "k": batch["k"], "ids": [a for a, _ in found], "score": [b for _, b in found]})

    shape = f"_key string, k int, {_SHAPE}"
    between = joints.repartition("_key", "k").mapInPandas(joined, shape).withColumn("k", F.col("k") * 2 + 1)
    return made.select("_key", (F.col("k") * 2).alias("k"), "ids", "score").union(between)


def _searched_chunks(cut: DataFrame, sent: Broadcast, chunk: int) -> DataFrame:
    """(_key, k, ids, score) for the chunks of giant texts, by the max-plus scan."""
    wide = sent.value.width

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [sent.value.transfer(x, min(chunk, len(x))).tobytes() for x in batch["x"]]
            yield pd.DataFrame({"_key": batch["_key"], "k": batch["k"], "m": made})

    def states(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        found = border_states([np.frombuffer(m, np.int64).reshape(wide, wide) for m in group["m"]])
        return pd.DataFrame({"_key": group["_key"], "k": group["k"], "a": found[:-1], "b": found[1:]})

    # a document's matrices are a few KB per chunk; its text stays in chunks
    borders = (
        cut.mapInPandas(matrices, "_key string, k int, m binary").groupBy("_key").applyInPandas(states, "_key string, k int, a int, b int")
    )

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["x"], batch["a"], batch["b"])
            made = [sent.value.encode(x[a : min(chunk, len(x)) + b]) for x, a, b in rows]
            yield pd.DataFrame({"_key": batch["_key"], "k": batch["k"], "ids": [a for a, _ in made], "score": [b for _, b in made]})

    return cut.join(borders, ["_key", "k"]).select("_key", "k", "x", "a", "b").mapInPandas(trace, f"_key string, k int, {_SHAPE}")


def encode(
    docs: DataFrame,
    text_col: str = "text",
    model: str = MODEL,
    giant: int = GIANT,
    chunk: int = CHUNK,
) -> DataFrame:
    """`docs` with `ids` (array<int>) and `score` (sum of piece scores)."""
    short_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary := Vocabulary(model))
    wide = vocabulary.width

    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            made = sent.value.encode_all([_prepared(t or "") for t in texts])
            gone = [t is None for t in texts]
            yield pd.DataFrame(
                {"ids": [None if g else a for g, (a, _) in zip(gone, made)], "score": [None if g else b for g, (_, b) in zip(gone, made)]}
            )

    docs = docs.select([c for c in docs.columns if c not in ("ids", "score")])
    large = F.char_length(text_col) > giant
    plain = docs.filter(F.coalesce(~large, F.lit(True))).withColumn("_e", F.pandas_udf(whole, _SHAPE)(F.col(text_col)))
    plain = plain.select(*docs.columns, F.col("_e.ids").alias("ids"), F.col("_e.score").alias("score"))

    # equal giant texts are encoded once; a chunk is a row of its own
    giants = docs.filter(large)
    x = F.concat(F.lit(" "), F.col(text_col))
    cut = (
        giants.select(F.sha2(F.col(text_col).cast("binary"), 256).alias("_key"), x.alias("x"))
        .dropDuplicates(["_key"])
        .select("_key", "x", F.ceil(F.char_length("x") / F.lit(chunk)).cast("int").alias("n"))
        .select("_key", "n", "x", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
        .select("_key", "n", "k", F.substring("x", F.col("k") * chunk + 1, F.lit(chunk + wide - 1)).alias("x"))
        .repartition("_key", "k")
    )

    traced = (_merged_chunks if vocabulary.bpe else _searched_chunks)(cut, sent, chunk)
    parts = F.array_sort(F.collect_list(F.struct("k", "ids", "score")))
    joined = traced.groupBy("_key").agg(parts.alias("p")).select(
        "_key",
        F.flatten(F.col("p.ids")).alias("ids"),
        F.aggregate("p.score", F.lit(0.0), lambda a, b: a + b).alias("score"),
    )
    keyed = giants.withColumn("_key", F.sha2(F.col(text_col).cast("binary"), 256))
    return plain.union(keyed.join(joined, "_key").select(*docs.columns, "ids", "score"))


def decode(docs: DataFrame, ids_col: str = "ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """`docs` with the text of its ids; null ids give null."""
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary(model))

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if ids is None else sent.value.decode(list(ids)) for ids in batch], dtype=object)

    return docs.withColumn(out, F.pandas_udf(work, "string")(F.col(ids_col)))
