"""SimHash near-duplicates through covering locality-sensitive hashing.

Each text gets a 64-bit fingerprint. For radius r the index has 2**(r+1) - 1 tables, each keeping
the bits that one non-zero vector of a Hadamard-like code selects. Two fingerprints that differ in
at most r bits agree in all kept bits of some table, so no pair within the radius is missed; every
pair that meets is verified, so none beyond it is linked.

Cases: a null or empty text, or one of white space, has no words and the fingerprint zero, which is
linked like any other. Equal texts, ids included, share a fingerprint and so a component. Columns
other than the id and the text are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import components, forest, in_pieces, lower_words, short_batches, stored

SEED = 42
RADIUS = 4
BLOCK = 4096  # fingerprints compared in one block


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Bit i is 1 if it is set in over half of the XXH64 of the text's word shingles, repeats included."""
    words = lower_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, last)), np.uint64, len(last))
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    of_octet = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ of_octet for k in range(8)])
    return int(np.packbits(ones * 2 > len(last), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp): the fingerprint as a signed long."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"id": batch["id"], "fp": found.view(np.int64)})

    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(work, "id long, fp long")


def covering_masks(radius: int) -> list[int]:
    """2**(radius+1) - 1 masks of 64 bits such that any `radius` bits are all unset in one of them.

    Bit i carries a vector m(i) of radius+1 bits; table v keeps it if the inner product of m(i) and
    v is odd. `radius` vectors span less than the whole space, so some v is orthogonal to all. The
    highest bit of every m(i) is set and the others count up, so a table keeps 32 bits at least.
    """
    width = radius + 1
    vectors = [1 << radius | i & ((1 << radius) - 1) for i in range(64)]
    return [sum(((v & m).bit_count() & 1) << i for i, m in enumerate(vectors)) for v in range(1, 1 << width)]


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints `fp` that connect all pairs within the radius.

    Not every pair is listed: within a bucket, a spanning forest of its links. Buckets above
    `block` fingerprints are compared piece by piece, each pair of pieces in a block of its own.
    """
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in covering_masks(radius)])
    keyed = prints.select("fp", F.posexplode(masks).alias("tab", "mask")).select(
        "fp", F.xxhash64("tab", F.col("fp").bitwiseAND(F.col("mask"))).alias("bucket")
    )
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    blocks = in_pieces(keyed, ["bucket"], "fp", block, sizes)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in whole_groups(batches, "_block"):
            values = np.unique(group["fp"].to_numpy().view(np.uint64))
            if len(values) == 2:
                near = [(0, 1)] if np.bitwise_count(values[0] ^ values[1]) <= radius else []
            else:
                near = forest(lambda i, rest: np.bitwise_count(values[rest] ^ values[i]) <= radius, len(values))
            if near:
                signed = values.view(np.int64)
                pairs = np.array(near)
                yield pd.DataFrame({"a": signed[pairs[:, 0]], "b": signed[pairs[:, 1]]})

    dealt = blocks.select("_block", "fp").repartition("_block").sortWithinPartitions("_block")
    return dealt.mapInPandas(work, "a long, b long").distinct()


def whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Groups of rows sorted by `key`, joined where a batch ends inside one."""
    held: pd.DataFrame | None = None
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        cuts = np.flatnonzero(np.diff(batch[key].to_numpy())) + 1
        edges = [0, *cuts.tolist()]
        for a, b in zip(edges, edges[1:]):
            yield batch.iloc[a:b]
        held = batch.iloc[edges[-1] :]
    if held is not None and len(held):
        yield held


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = RADIUS, block: int = BLOCK
) -> DataFrame:
    """(id, fp, component): component is the smallest id reachable over links of at most `radius` bits."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("id").alias("first"))
    reached = components(links(classes.select("fp"), radius, block))
    # both joins are sort-merge joins: tables of files and unions of them are larger in memory than Spark expects
    named = classes.join(reached.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    lowest = named.groupBy("root").agg(F.min("first").alias("component"))
    by_print = named.join(lowest, "root").select("fp", "component")
    return prints.join(by_print.hint("merge"), "fp").select("id", "fp", "component")
