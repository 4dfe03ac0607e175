"""Small tables with the cases every operator has to handle."""

import random
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars int, score double, component string"


def edge_docs(spark, seed=1):
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated rows, clashing column names."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["The", "the", "über", "日本", "a.b", "▁x"]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, "One"), (None, "no id"), (None, None)]
    for i in range(7, 40):
        text = "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 25))) for _ in range(rng.randint(1, 6)))
        rows.append((i, text + " " + passage if i % 3 == 0 else text))
    rows += [(40, rows[20][1]), (41, rows[20][1]), (42, "x" * 5000 + passage), (43, passage * 400), (44, passage), (44, passage)]
    return spark.createDataFrame(
        [(i, t, None if n % 5 == 0 else "en", None if n % 7 == 0 else "s", None, 0.5, "c") for n, (i, t) in enumerate(rows)], DOCS
    )


def lower(text):
    """A-Z only."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_fingerprint(text, n=4):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
