"""Hard negatives through a multiway hyperplane tree in the style of GNAT, built and searched in Spark.

Vectors become integers, floor(`SCALE` * x), and a score is the inner product of two of them. An anchor's positives are its
best rows of the same label; for each positive the best rows of other labels are wanted whose score lies in a window of
`LOW` to `HIGH` percent of the positive's.

The tree: a node above `LEAF` rows takes up to `FANOUT` of its vectors as split points, far from each other, chosen from at
most `CANDIDATES` of its distinct vectors (those of the smallest hash in each of so many hash classes, a bounded sample that fixes
nothing but the shape). Each of its rows goes to the nearest split point. For every split point and every sibling subtree the node
keeps the least and the greatest distance of the subtree's rows to the point, and of their lengths. All rows are in the tree.

The search: a window of scores is an annulus of distances around the anchor, given the lengths in a subtree. A subtree is left out
if for some split point its range of distances does not meet what the annulus leaves possible. Leaves are searched exactly. An
anchor first searches the leaf it lies in; the last score that would be returned bounds its windows from below for the rest of the tree.
So the results are those of brute force; how much is left out depends on the data (little, if distances are all alike).

Anchors and rows meet by node in groups of at most about `GROUP` of each, so that a node, a leaf of equal vectors
or a popular subtree is never in one task; the tree and its ranges are tables and are not sent to the driver.

Cases: rows with a null id, label or vector, with null or non-finite components, or with a squared length above 2 ** 60 after scaling (scores
would leave the range of a long) take no part. A shorter vector counts as filled up with zeros; an empty one is zero.
Rows that share an id are rows of their own, but not positives of each other. Ties go to the smaller id. An anchor without a positive, or a
positive whose window holds no row, gives no row. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
LEAF, FANOUT, CANDIDATES, GROUP, LEVELS = 1024, 8, 64, 1024, 18
_FAR = 1 << 61


def vectors(rows: DataFrame, anchor: Column, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(row, id, label, anchor, vec, norm) of the rows that take part; vec holds 32-bit integers, all of one length."""
    given = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector_col).cast("array<double>").alias("x"),
    ).filter("id is not null and label is not null and x is not null")
    odd = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform("x", lambda v: F.floor(v * float(scale)).cast("double"))
    square = F.aggregate(F.transform("x", lambda v: F.pow(F.floor(v * float(scale)).cast("double"), 2.0)), F.lit(0.0), lambda a, b: a + b)
    clean = given.filter(~odd).filter(square <= float(1 << 60)).withColumn("x", whole)
    width = clean.agg(F.max(F.size("x"))).first()[0] or 0

    def work(batches):
        for batch in batches:
            x = np.zeros((len(batch), width), np.int32)
            for i, v in enumerate(batch["x"]):
                x[i, : len(v)] = v
            norm = (x.astype(np.int64) ** 2).sum(axis=1)
            yield batch[["row", "id", "label", "anchor"]].assign(vec=[v.tobytes() for v in x], norm=norm)

    numbered = clean.withColumn("row", F.monotonically_increasing_id())
    return stored(numbered.mapInPandas(work, "row long, id long, label string, anchor boolean, vec binary, norm long"), "vectors")


def _matrix(vecs) -> np.ndarray:
    """Vectors as a matrix in which products are exact: of doubles where they suffice, else of 64-bit integers."""
    vecs = list(vecs)
    x = np.frombuffer(b"".join(vecs), np.int32).reshape(len(vecs), -1)
    large = int(np.abs(x.astype(np.int64)).max(initial=0)) ** 2 * max(1, x.shape[1]) >= 1 << 50
    return x.astype(np.int64 if large else np.float64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    kind = np.int64 if np.int64 in (a.dtype, b.dtype) else np.float64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _squares(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.int64) ** 2).sum(axis=1)


def _far_apart(vecs: list[bytes], fanout: int) -> list[bytes]:
    """Up to `fanout` of the vectors, each the farthest from those before it."""
    x = _matrix(vecs)
    norm, cross = _squares(x), _products(x, x)
    chosen, near = [0], norm + norm[0] - 2 * cross[:, 0]
    while len(chosen) < fanout and near.max() > 0:
        far = int(near.argmax())
        chosen.append(far)
        near = np.minimum(near, norm + norm[far] - 2 * cross[:, far])
    return [vecs[i] for i in chosen]


def _parts(n: Column, size: int) -> Column:
    return F.ceil(n / F.lit(size)).cast("int")


def _dealt(n: Column, size: int, key: Column) -> Column:
    """The part of a group of n rows that a row goes to, so that parts have about `size` rows."""
    return F.pmod(F.xxhash64(F.lit(13), key), _parts(n, size)).cast("int")


def _each(n: Column, size: int) -> Column:
    return F.explode(F.sequence(F.lit(0), _parts(n, size) - 1))


def _renamed(df: DataFrame) -> DataFrame:
    """The same columns as new ones, for the second side of two that come from one table."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


class Tree:
    """The tree over `rows`: `levels`, tables of (node, points, children), and `leaves`, the rows with their leaf."""

    def __init__(self, rows: DataFrame, leaf: int, fanout: int, candidates: int, group: int):
        self.rows, self.fanout, self.group = rows, fanout, group
        self.levels, self.roots = [], rows.withColumn("node", F.lit(0).cast("long"))
        shape = self.roots.agg(F.count(F.lit(1)).alias("n"), F.min("vec") != F.max("vec")).first()
        self.size, self.open = shape[0], shape[0] > leaf and bool(shape[1])
        rest = self.roots.withColumn("n", F.lit(self.size).cast("long"))
        done = [] if self.open else [rest]
        depth = 0
        while self.open and depth < LEVELS:
            points = self._points(rest, candidates)
            routed = self._route(rest, points)
            children = self._children(routed, leaf, depth + 1 < LEVELS)
            self.levels.append(stored(points.join(children, "node"), "nodes"))
            known = self.levels[-1].select(F.inline("children")).select(F.col("child").alias("node"), "n", "inner")
            moved = stored(routed.drop("far", "node").withColumnRenamed("child", "node").join(known, "node"), "rows")
            done.append(moved.filter("not inner").drop("inner"))
            rest = moved.filter("inner").drop("inner")
            depth += 1
            if not self.levels[-1].filter(F.exists("children", lambda c: c["inner"])).head(1):
                break
        self.leaves = done[0]
        for part in done[1:]:
            self.leaves = self.leaves.unionByName(part)

    def _points(self, rest: DataFrame, candidates: int) -> DataFrame:
        """(node, n, points) of every node to be split."""
        fanout = self.fanout

        def choose(batches):
            for batch in batches:
                yield batch.assign(points=[_far_apart(list(p), fanout) for p in batch["points"]])

        h = F.xxhash64(F.lit(5), "node", "vec")
        few = rest.groupBy("node", F.pmod(h, F.lit(candidates)).alias("class")).agg(F.min_by("vec", h).alias("vec"), F.first("n").alias("n"))
        lists = few.groupBy("node").agg(F.first("n").alias("n"), F.array_sort(F.collect_list("vec")).alias("points"))
        return stored(lists.mapInPandas(choose, "node long, n long, points array<binary>"), "points")

    def _route(self, rest: DataFrame, points: DataFrame) -> DataFrame:
        """The rows with their child node and their squared distance to each split point, none beyond the last."""
        fanout = self.fanout

        def work(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame(columns=[*left.columns.drop(["n", "_part"]), "child", "far"])
            x, p = _matrix(left["vec"]), _matrix(right["points"].iloc[0])
            far = left["norm"].to_numpy()[:, None] + _squares(p)[None, :] - 2 * _products(x, p)
            return left.drop(columns=["n", "_part"]).assign(child=left["node"] * fanout + far.argmin(axis=1) + 1, far=list(far))

        size = self.group * 4
        left = rest.withColumn("_part", _dealt(F.col("n"), size, F.col("row")))
        right = points.withColumn("_part", _each(F.col("n"), size))
        schema = "row long, id long, label string, anchor boolean, vec binary, norm long, node long, child long, far array<long>"
        keys = ["node", "_part"]
        return stored(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(work, schema), "routed")

    def _children(self, routed: DataFrame, leaf: int, deeper: bool) -> DataFrame:
        """(node, children): for each child its rows, its ranges to all split points of the node, and whether it is split again."""
        at = [F.get("far", F.lit(i)) for i in range(self.fanout)]
        ranges = routed.groupBy("node", "child").agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.min(a) for a in at]).alias("least"),
            F.array(*[F.max(a) for a in at]).alias("most"),
            F.min("norm").alias("short"),
            F.max("norm").alias("long"),
            (F.min(F.xxhash64("vec")) != F.max(F.xxhash64("vec"))).alias("differ"),
        )
        inner = (F.col("n") > leaf) & F.col("differ") & F.lit(deeper)
        child = F.struct("child", "n", "least", "most", "short", "long", inner.alias("inner"))
        return ranges.groupBy("node").agg(F.array_sort(F.collect_list(child)).alias("children"))

    def visits(self, anchors: DataFrame) -> DataFrame:
        """`anchors` (with vec, norm, low, high: windows of scores) once for each leaf that may hold a score in a window; adds node, n."""
        if not self.levels:
            return anchors.withColumn("node", F.lit(0).cast("long")).withColumn("n", F.lit(self.size).cast("long"))
        columns = anchors.columns
        schema = anchors.schema.simpleString()[len("struct<") : -1] + ",node:bigint,n:bigint,inner:boolean"

        def work(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame(columns=[*columns, "node", "n", "inner"])
            found = _reached(left, right.iloc[0])
            picked, child = np.nonzero(found)
            children = right["children"].iloc[0]
            out = left[columns].iloc[picked].copy()
            for name, field in (("node", "child"), ("n", "n"), ("inner", "inner")):
                out[name] = np.array([c[field] for c in children])[child]
            return out

        at = anchors.withColumn("node", F.lit(0).cast("long"))
        found = None
        for level in self.levels:
            sizes = at.groupBy("node").agg(F.count(F.lit(1)).alias("_m"))
            left = at.join(sizes, "node").withColumn("_part", _dealt(F.col("_m"), self.group, F.col("row")))
            right = level.select("node", "points", "children").join(sizes, "node").withColumn("_part", _each(F.col("_m"), self.group))
            keys = ["node", "_part"]
            seen = stored(left.groupBy(*keys).cogroup(_renamed(right).groupBy(*keys)).applyInPandas(work, schema), "visits")
            leaves = seen.filter("not inner").drop("inner")
            found = leaves if found is None else found.unionByName(leaves)
            at = seen.filter("inner").drop("inner", "n")
        return found


def _reached(left: pd.DataFrame, node: pd.Series) -> np.ndarray:
    """For each anchor and child whether the child's ranges meet the annulus of some window."""
    x, p, children = _matrix(left["vec"]), _matrix(node["points"]), node["children"]
    norm = left["norm"].to_numpy()
    own = norm.astype(np.float64)[:, None]
    d = np.sqrt(np.maximum(norm[:, None] + _squares(p)[None, :] - 2 * _products(x, p), 0).astype(np.float64))
    k = len(p)
    least = np.sqrt(np.array([c["least"][:k] for c in children], np.float64))
    most = np.sqrt(np.array([c["most"][:k] for c in children], np.float64))
    short = np.array([c["short"] for c in children], np.float64)[None, :]
    long_ = np.array([c["long"] for c in children], np.float64)[None, :]
    slack = 1e-7 * (1 + np.sqrt(own) + np.sqrt(long_))  # more than the roots can be off
    # what the ranges allow for the distance of the anchor to a row of the child
    nearest = np.maximum((d[:, None, :] - most[None]).max(axis=2), (least[None] - d[:, None, :]).max(axis=2))
    farthest = (d[:, None, :] + most[None]).min(axis=2)
    found = np.zeros(nearest.shape, bool)
    low, high = (_filled(left[c], fill) for c, fill in (("low", 1), ("high", 0)))
    for w in range(low.shape[1]):
        a, b = low[:, w].astype(np.float64)[:, None], high[:, w].astype(np.float64)[:, None]
        outer = own + long_ - 2 * a
        inner = np.sqrt(np.maximum(own + short - 2 * b, 0))
        met = (outer >= -slack * slack) & (nearest <= np.sqrt(np.maximum(outer, 0)) + slack) & (farthest >= inner - slack)
        found |= met & (a <= b)
    return found


def _filled(lists: pd.Series, fill: int) -> np.ndarray:
    """Lists as the rows of a matrix; low 1 and high 0 make an empty window of what is missing."""
    out = np.full((len(lists), max(map(len, lists), default=0)), fill, np.int64)
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


def searched(visits: DataFrame, leaves: DataFrame, same: bool, take: int, group: int) -> DataFrame:
    """(row, window, id, score): for each visit and window the best `take` rows of the leaf, of the same label or of others."""

    def work(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"row": [], "window": [], "id": [], "score": []}).astype("int64")
        if not len(left) or not len(right):
            return empty
        right = right.sort_values(["id", "row"], kind="stable")
        scores = _products(_matrix(left["vec"]), _matrix(right["vec"]))
        codes, _ = pd.factorize(pd.concat([left["label"], right["label"]]))
        alike = codes[: len(left), None] == codes[None, len(left) :]
        ids = right["id"].to_numpy()
        fits = alike & (left["id"].to_numpy()[:, None] != ids[None, :]) if same else ~alike
        scores[~fits] = -_FAR
        order = np.argsort(-scores, axis=1, kind="stable")
        scores = np.take_along_axis(scores, order, axis=1)
        low, high, keys, out = _filled(left["low"], 1), _filled(left["high"], 0), left["row"].to_numpy(), []
        for w in range(low.shape[1]):
            first = (scores > high[:, w, None]).sum(axis=1)
            for t in range(min(take, scores.shape[1])):
                at = np.minimum(first + t, scores.shape[1] - 1)[:, None]
                score = np.take_along_axis(scores, at, axis=1)[:, 0]
                ok = (first + t < scores.shape[1]) & (score >= low[:, w]) & (score > -_FAR) & (low[:, w] <= high[:, w])
                place = np.take_along_axis(order, at, axis=1)[:, 0]
                out.append(pd.DataFrame({"row": keys[ok], "window": w, "id": ids[place[ok]], "score": score[ok]}))
        return pd.concat(out) if out else empty

    sizes = visits.groupBy("node").agg(F.count(F.lit(1)).alias("_m"), F.first("n").alias("_n"))
    m, n = F.col("_m"), F.col("_n")
    left = visits.select("row", "id", "label", "vec", "low", "high", "node").join(sizes, "node")
    left = left.withColumn("_left", _dealt(m, group, F.col("row"))).withColumn("_right", _each(n, group))
    right = leaves.select("row", "id", "label", "vec", "node").join(sizes, "node")
    right = right.withColumn("_right", _dealt(n, group, F.col("row"))).withColumn("_left", _each(m, group))
    keys = ["node", "_left", "_right"]
    met = left.groupBy(*keys).cogroup(_renamed(right).groupBy(*keys)).applyInPandas(work, "row long, window int, id long, score long")
    return stored(met, "found")


def _ranked(found: DataFrame, take: int) -> DataFrame:
    """The best `take` of each row and window, with `rank` from 1."""
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= take)


def _share(score: Column, percent: int, up: bool) -> Column:
    """`percent` hundredths of a long, rounded up or down, without leaving its range."""
    hundred, times = F.lit(100).cast("long"), F.lit(percent).cast("long")
    over = F.pmod(score, hundred)
    rest = over * times + F.lit(99 if up else 0)
    return F.call_function("div", score - over, hundred) * times + F.call_function("div", rest, hundred)


def mine(
    rows: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    leaf: int = LEAF,
    fanout: int = FANOUT,
    candidates: int = CANDIDATES,
    group: int = GROUP,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where `anchor` holds."""
    tree = Tree(vectors(rows, anchor, id_col, vector_col, label_col, scale), leaf, fanout, candidates, group)
    home = tree.leaves.filter("anchor").select("row", "id", "label", "vec", "norm", "node", "n")

    def best(windows: DataFrame, same: bool, take: int) -> DataFrame:
        """The best rows of all windows of the anchors: first in their own leaf, then wherever as much or more can be."""
        near = searched(windows, tree.leaves, same, take, group)
        worst = _ranked(near, take).filter(F.col("rank") == take).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("worst"))
        raised = F.transform("low", lambda v, i: F.greatest(v, F.coalesce(F.element_at("worst", i), v)))
        narrowed = stored(windows.join(worst, "row", "left").withColumn("low", raised).withColumnRenamed("node", "own").drop("worst", "n"), "windows")
        others = tree.visits(narrowed).filter("node <> own")
        return _ranked(near.unionByName(searched(others, tree.leaves, same, take, group)), take)

    long_list = lambda c: F.array(c).cast("array<bigint>")
    whole = home.withColumn("low", long_list(F.lit(1 - _FAR))).withColumn("high", long_list(F.lit(_FAR)))
    good = stored(best(whole, True, positives).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("good")), "positives")
    windows = home.join(good, "row")
    windows = windows.withColumn("low", F.transform("good.score", lambda s: _share(s, low, True)))
    windows = windows.withColumn("high", F.transform("good.score", lambda s: _share(s, high, False))).drop("good")
    bad = best(windows, False, negatives)
    named = bad.join(good, "row").join(home.select("row", F.col("id").alias("anchor_id")), "row")
    positive = F.element_at("good", F.col("window") + 1)
    return named.select(
        "anchor_id",
        positive["id"].alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
