"""License scans: phrases that name a license, and an exact set-similarity join of text blocks with license notices.

Texts become words (A-Z lowered, runs of digits, letters and non-ASCII bytes). Every place of a phrase is counted. A block is
a line with words, or a paragraph: a stretch of two or more such lines in a row. A block holds a template if at least
`percent` of the template's different words are among its own.

The join: words of templates are ordered by the number of blocks that have them, rare ones first; words of no template can
be in no overlap and are left out. With need(T) the words asked of template T, a block that holds T has need(T) words at least (length filter), and the
first word the two have in common, in that order, is among the first |T| - need(T) + 1 of the template and the first
|B| - need(T) + 1 of the block (prefix filter). Where the two meet, the words before and behind must leave room for
need(T) common ones (positional filter). What passes is counted exactly, at its first common word only, so that no pair
comes twice. Of several templates a block holds, one whose words all belong to another of them is left out.

Phrases and templates are arguments, at most `TEMPLATE_BYTES` together, which bounds what is broadcast and the vocabulary
whose counts come to the driver. Documents are read once; texts are not shuffled.

Cases: null and empty texts have no words, no labels and a score of 0. Repeated rows give a row each. A template
without words matches nothing; no templates or no phrases match nothing. An empty table gives an empty table. A column
named like `out_col` is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import short_batches, stored, utf8
from llm.decontaminate import plain

PERCENT = 90
TEMPLATE_BYTES = 1 << 20

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of public licenses.
TEMPLATES = (
    ("cc-by", "Licensed under CC BY"),
    ("cc-by-sa", "Licensed under CC BY-SA"),
    ("cc-by-nc", "Licensed under CC BY-NC"),
    ("cc-by-nd", "Licensed under CC BY-ND"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND"),
    ("cc-by", "Licensed under a Creative Commons Attribution License"),
    ("cc-by-sa", "Licensed under a Creative Commons Attribution-ShareAlike License"),
    ("cc-by-nc", "Licensed under a Creative Commons Attribution-NonCommercial License"),
    (
        "cc0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License.",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("gfdl", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License"),
)


class Templates:
    """Templates as sets of word numbers, with what each asks of a block."""

    def __init__(self, templates: tuple[tuple[str, str], ...], percent: int):
        if sum(len(utf8(text)) for _, text in templates) > TEMPLATE_BYTES:
            raise ValueError(f"templates of more than {TEMPLATE_BYTES} bytes")
        sets = [(label, set(plain(text).split())) for label, text in templates]
        self.labels = [label for label, words in sets if words]
        vocabulary = sorted(set().union(*(words for _, words in sets)))
        self.numbers = {w: i for i, w in enumerate(vocabulary)}
        self.sets = [sorted(self.numbers[w] for w in words) for _, words in sets if words]
        self.needs = [max(1, -(-len(words) * percent // 100)) for words in self.sets]
        self.fewest = min(self.needs, default=1)
        self.wider = [
            [j for j, other in enumerate(self.sets) if set(words) < set(other)] for words in self.sets
        ]


def _blocks(flat: bytes, numbers: dict[bytes, int], fewest: int) -> list[tuple[int, int, list[int]]]:
    """(first line, lines, template words) of every line and paragraph with at least `fewest` template words."""
    found, begun, paragraph, lines = [], 0, set(), 0

    def end() -> None:
        if lines > 1 and len(paragraph) >= fewest:
            found.append((begun, lines, sorted(paragraph)))

    for n, line in enumerate(flat.split(b"\n")):
        words = line.split()
        if not words:
            end()
            paragraph, lines = set(), 0
            continue
        if not lines:
            begun = n
        has = {numbers[w] for w in words if w in numbers}
        if len(has) >= fewest:
            found.append((n, 1, sorted(has)))
        paragraph |= has
        lines += 1
    end()
    return found


_KEEP = bytes(10 if c == 10 else ord(plain(chr(c))) if c < 0x80 else c for c in range(256))  # as `plain`, but lines stay apart

SCAN = (
    "n_words long, n_base long, first_word long, last_word long, base array<string>, "
    "blocks array<struct<line: int, lines: int, words: array<int>>>"
)


def scanner(spark: SparkSession, phrases: dict[str, str], templates: Templates) -> Callable[[Column], Column]:
    """A column function: text -> struct of the places of phrases and the blocks that may hold a template."""
    short_batches(spark)
    wanted = [(b" " + b" ".join(plain(p).split()) + b" ", label) for p, label in phrases.items() if plain(p).split()]
    numbers, fewest = templates.numbers, templates.fewest

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                flat = utf8(text).translate(_KEEP)
                words = flat.split()
                line = b" " + b" ".join(words) + b" "
                places, base = [], set()
                for phrase, label in wanted:
                    at = line.find(phrase)
                    while at >= 0:
                        places.append(line.count(b" ", 0, at + 1) - 1)
                        base.add(label)
                        at = line.find(phrase, at + 1)
                blocks = [{"line": a, "lines": n, "words": has} for a, n, has in _blocks(flat, numbers, fewest)]
                first, last = (min(places), max(places)) if places else (None, None)
                out.append((len(words), len(places), first, last, sorted(base), blocks))
            made = pd.DataFrame(out, columns=["n_words", "n_base", "first_word", "last_word", "base", "blocks"])
            yield made.astype({"first_word": "Int64", "last_word": "Int64"})

    return F.pandas_udf(work, SCAN)


def held(blocks: DataFrame, templates: Templates) -> DataFrame:
    """The columns of `blocks` but `words`, with `template` (number) and `share`: every template each block holds.

    `blocks` has distinct template words of each block in `words`.
    """
    spark = blocks.sparkSession
    counts = dict(blocks.select(F.explode("words").alias("w")).groupBy("w").count().collect())  # a row for each template word
    order = sorted(range(len(templates.numbers)), key=lambda w: (counts.get(w, 0), w))
    rank = np.argsort(order).tolist()
    rows = []
    for t, (words, need) in enumerate(zip(templates.sets, templates.needs)):
        ranks = sorted(rank[w] for w in words)
        rows += [(r, t, i, ranks, need) for i, r in enumerate(ranks[: len(ranks) - need + 1])]
    prefixes = spark.createDataFrame(rows, "_r int, template int, _i int, _template array<int>, _need int")
    ranks = F.array_sort(F.transform("words", lambda w: F.element_at(F.lit(rank or [0]), w + 1)))
    keep = [c for c in blocks.columns if c != "words"]
    # the least demanding template sets the prefix; each one's own follows in the join
    sets = blocks.withColumn("_block", ranks).filter(F.size("_block") >= templates.fewest)
    heads = sets.select(*keep, "_block", F.posexplode(F.slice("_block", F.lit(1), F.size("_block") - templates.fewest + 1)).alias("_j", "_r"))
    own, size = F.size("_block"), F.size("_template")
    room = F.least("_i", "_j") + 1 + F.least(size - F.col("_i"), own - F.col("_j")) - 1
    met = heads.join(F.broadcast(prefixes), "_r").filter((own - F.col("_j") >= F.col("_need")) & (room >= F.col("_need")))
    common = met.withColumn("_common", F.array_intersect("_block", "_template"))
    exact = common.filter((F.size("_common") >= F.col("_need")) & (F.array_min("_common") == F.col("_r")))
    return exact.select(*keep, "template", (F.size("_common") / size).alias("share"))


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    percent: int = PERCENT,
    text_col: str = "text",
    keep: list[str] | None = None,
    out_col: str = "license",
) -> DataFrame:
    """Columns `keep` of each row (all, if not given) and `out_col`: what was found in its text.

    The struct has n_words, n_base (places of phrases), first_word, last_word, base (labels of phrases), notices (line,
    lines, label, share of each template held), labels (of either kind) and score: 1 with a phrase, else the greatest share.
    """
    known = Templates(templates, percent)
    row = F.struct(*(docs.columns if keep is None else keep))
    found = scanner(docs.sparkSession, phrases, known)(F.col(text_col))
    # the key has to be the same for both readers, so it is written
    scanned = stored(docs.select(F.monotonically_increasing_id().alias("key"), row.alias("doc"), found.alias("scan")), "licenses")
    blocks = scanned.select("key", F.inline("scan.blocks"))
    wider = F.array(*[F.array(*map(F.lit, w)).cast("array<int>") for w in known.wider])
    labels = F.array(*map(F.lit, known.labels)).cast("array<string>")
    notice = F.struct(
        "line",
        "lines",
        F.element_at(labels, F.col("template") + 1).alias("label"),
        "share",
    )
    if known.sets:
        held_ = held(blocks, known).groupBy("key", "line", "lines").agg(F.collect_list(F.struct("template", "share")).alias("all"))
        wide = F.filter("all", lambda x: ~F.arrays_overlap(F.element_at(wider, x["template"] + 1), F.col("all.template")))
        per_row = held_.select("key", "line", "lines", F.inline(wide)).groupBy("key").agg(F.array_sort(F.collect_list(notice)).alias("notices"))
    else:
        per_row = scanned.filter("false").select("key", F.array(F.struct(F.lit(0).alias("line"), F.lit(0).alias("lines"), F.lit("").alias("label"), F.lit(0.0).alias("share"))).alias("notices"))
    notices = F.coalesce("notices", F.array().cast("array<struct<line:int,lines:int,label:string,share:double>>"))
    together = scanned.join(per_row, "key", "left").withColumn("notices", notices)
    result = F.struct(
        "scan.n_words",
        "scan.n_base",
        "scan.first_word",
        "scan.last_word",
        "scan.base",
        "notices",
        F.array_sort(F.array_distinct(F.concat("scan.base", "notices.label"))).alias("labels"),
        F.when(F.col("scan.n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max("notices.share"), F.lit(0.0))).alias("score"),
    )
    return together.select("doc", result.alias("found")).select(
        *[F.col("doc")[c].alias(c) for c in (docs.columns if keep is None else keep) if c != out_col], F.col("found").alias(out_col)
    )
