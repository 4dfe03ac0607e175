"""Blocks of documents that ask tables kept elsewhere, without sending their texts.

A partition of the input is cut into chunks of some megabytes. A chunk sends packed questions to
buckets (one shuffle); a bucket merges what all chunks sent and answers each question; the answers
go back to the partition of the chunk (a second, smaller shuffle) and meet its texts there, because
both sides have the same number of partitions and the chunks' order is fixed by the input. Texts are
read again from the source in each round and never shuffled. A Python worker per task cuts the chunks, one puts
together the answers of all rounds (they are shuffled alike, so their union moves nothing), and one does the work.

RDDs, since no DataFrame operator lets two partitioned tables meet without moving both.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import count
from typing import Any

from pyspark import RDD
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import partitions, utf8

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20  # of text per bucket, so that a bucket's merge fits a worker at any size of the input


class Blocks:
    def __init__(self, docs: DataFrame, chunk_bytes: int = CHUNK_BYTES):
        """`docs` has two columns: an id and a text."""
        text = F.col(docs.columns[1]).cast("binary")
        size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        self.buckets = max(partitions(docs.sparkSession), -(-size // BUCKET_BYTES))

        def cut(index: int, rows: Iterator) -> Iterator[tuple]:
            ids, texts, size, k = [], [], 0, 0
            for doc, text in rows:
                raw = utf8(text)
                ids.append(doc)
                texts.append(raw)
                size += len(raw) + 64
                if size >= chunk_bytes:
                    yield (index, k), ids, texts
                    ids, texts, size, k = [], [], 0, k + 1
            if ids:
                yield (index, k), ids, texts

        self._chunks = _one_by_one(docs.rdd.mapPartitionsWithIndex(cut))
        self._rounds = count()

    def ask(self, questions: Callable[..., Iterable[tuple[int, Any]]], *answers: RDD) -> RDD:
        """Partition b holds (chunk, payload) for each (b, payload) of `questions(ids, texts, *answers)`."""
        depth, buckets = len(answers), self.buckets

        def send(item: tuple) -> Iterator[tuple]:
            (place, ids, texts), *known = _flat(item, depth)
            asked = False
            for bucket, payload in questions(ids, texts, *known):
                asked = True
                yield bucket, (place, payload)
            if not asked:  # every chunk gets an answer, so that the two sides stay in step
                yield place[1] % buckets, (place, None)

        return self._with(answers).flatMap(send).partitionBy(buckets, int).values()

    def answers(self, asked: RDD, reply: Callable[[list], Iterable[tuple]]) -> RDD:
        """Partition p holds (round, chunk, bucket, answer) for its chunks. `reply` maps a bucket's payloads to answers, in order."""
        parts, round_ = max(1, self._chunks.getNumPartitions()), next(self._rounds)

        def of_bucket(bucket: int, sent: Iterator) -> Iterator[tuple]:
            got = list(sent)
            real = [i for i, (_, payload) in enumerate(got) if payload is not None]
            for i, (place, payload) in enumerate(got):
                if payload is None:
                    yield place[0], (round_, place[1], None, None)
            if real:
                for i, answer in zip(real, reply([got[i][1] for i in real])):
                    place = got[i][0]
                    yield place[0], (round_, place[1], bucket, answer)

        return asked.mapPartitionsWithIndex(of_bucket).partitionBy(parts, int)

    def finish(self, work: Callable[..., Iterable], *answers: RDD) -> RDD:
        """The rows `work(ids, texts, *answers)` makes of each chunk."""
        depth = len(answers)

        def run(item: tuple) -> Iterable:
            (_, ids, texts), *known = _flat(item, depth)
            return work(ids, texts, *known)

        return self._with(answers).flatMap(run)

    def _with(self, answers: tuple[RDD, ...]) -> RDD:
        """Chunks, or (chunk, the dict {bucket: answer} of each round, earlier rounds first)."""
        if not answers:
            return self._chunks

        def in_order(rows: Iterator) -> Iterator[tuple]:
            by_chunk: dict[int, dict[int, dict]] = {}
            for _, (round_, k, bucket, answer) in rows:
                mine = by_chunk.setdefault(k, {}).setdefault(round_, {})
                if bucket is not None:
                    mine[bucket] = answer
            for k in sorted(by_chunk):
                known = by_chunk.pop(k)
                yield tuple(known[r] for r in sorted(known))

        known = reduce(RDD.union, answers).mapPartitions(in_order)
        chunks = self._chunks
        short = known.getNumPartitions() - chunks.getNumPartitions()
        if short > 0:
            chunks = chunks.union(_one_by_one(chunks.context.parallelize([], short)))
        return chunks.zip(_one_by_one(known))


def _one_by_one(rdd: RDD) -> RDD:
    """Zipped RDDs are sent in batches of a hundred otherwise, here all chunks of a partition at once."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def _flat(item: Any, depth: int) -> list:
    return [item[0], *item[1]] if depth else [item]
