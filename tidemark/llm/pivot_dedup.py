"""Near-duplicate vectors through a pivot-permutation index.

Reference points (pivots) are drawn from the vectors themselves. Each vector is described by its nearest pivots in
order; inverted lists hold, per pivot, the vectors that name it. Two vectors that share at least `shared` pivots are
candidates, verified by their cosine in double precision. A pair is counted only in the list of the first
pivot (by number) that both name. Long lists are cut into portions, and every pair of portions is a task of its own,
so no list is ever in one task. Equal vectors are one point with a multiplicity: they are never paired.

The pivots are at most `most_pivots` and grow with the vectors, so that lists stay short; they are a bounded sample,
but every vector is indexed. None has a cosine of APART or more with another: a dense group holds few of them, however
many vectors it has, so its members name the same ones and all of its pairs are verified.

Defined results: vectors that are null, zero, or hold null or non-finite components link with nothing; so do
those whose id is null; vectors of different lengths never link (there is an index for each length); rows with one id
are one vector (the least by its values) and give one row; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, components

#: Rows of a portion of a list.
PORTION = 1000
#: Pivots have a cosine below this with each other.
APART = 0.85


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def valid_points(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, point): vectors as doubles, point null if it links with nothing."""
    v = F.col(vec_col).cast("array<double>")
    fit = F.col(id_col).isNotNull() & (F.size(v) > 0)
    fit &= ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit &= F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).alias("vec_id"), F.when(F.coalesce(fit, F.lit(False)), v).alias("point")).groupBy("vec_id").agg(F.min("point").alias("point"))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _forest(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric link matrix the smallest node of its component."""
    n = len(linked)
    label = np.arange(n)
    reach = linked | np.eye(n, dtype=bool)
    while True:
        low = np.where(reach, label[None, :], n).min(axis=1)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def links(points: DataFrame, pivots: np.ndarray, threshold: float, named: int, shared: int) -> DataFrame:
    """(a, b, n, m): edges a-b that span the links found, and, where b is null, how many vectors the vectors a links to.

    points: (rep, times, point), all of one length and distinct. Links are counted with multiplicity.
    """
    dim, m = pivots.shape[1], len(pivots)
    spark = points.sparkSession
    held = spark.sparkContext.broadcast(pivots)

    def described(batches):
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                x = _unit(_matrix(part.column("point"), dim))
                near = x @ held.value.T
                k = min(named, m)
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                top = np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1)
                yield pa.RecordBatch.from_arrays([part.column("rep"), part.column("times"), pa.ListArray.from_arrays(np.arange(0, len(part) * k + 1, k, dtype=np.int32), top.astype(np.int32).ravel()), part.column("point")], ["rep", "times", "named", "point"])

    kind = points.schema["rep"].dataType.simpleString()
    described_ = Stored(points.select("rep", "times", "point").mapInArrow(described, f"rep {kind}, times long, named array<int>, point array<double>")).df
    sizes = described_.select(F.explode("named").alias("pivot")).groupBy("pivot").agg(F.ceil(F.count("*") / PORTION).cast("int").alias("cut"))
    lists = described_.select("*", F.explode("named").alias("pivot")).join(F.broadcast(sizes), "pivot")  # a row per pivot
    mine = F.pmod(F.xxhash64("rep"), F.col("cut")).cast("int")
    lists = lists.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    lists = lists.select("pivot", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "mine", "rep", "times", "named", "point")
    out_type = f"a {kind}, b {kind}, n long"

    def verified(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        pivot, p, q = (table.column(c)[0].as_py() for c in ("pivot", "p", "q"))
        mine = table.column("mine").to_numpy()
        x = _unit(_matrix(table.column("point").combine_chunks(), dim))
        lists_ = table.column("named").combine_chunks()
        k = len(lists_.flatten()) // len(table)
        names = np.sort(lists_.flatten().to_numpy().reshape(-1, k), axis=1)
        times = table.column("times").to_numpy()
        named_here, place = np.unique(names, return_inverse=True)
        marks = np.zeros((len(x), len(named_here)), dtype=np.float32)
        np.put_along_axis(marks, place.reshape(names.shape), 1, axis=1)
        before = marks[:, named_here < pivot]
        # candidates: enough shared pivots, of which this list's is the first
        candidate = (marks @ marks.T >= min(shared, k)) & (before @ before.T == 0)
        np.fill_diagonal(candidate, False)
        if p != q:
            candidate &= mine[:, None] != mine[None, :]
        linked = candidate & (x @ x.T >= threshold)
        n = linked @ times
        label = _forest(linked)
        reps = table.column("rep").combine_chunks()
        some = np.flatnonzero(n)
        joined = np.flatnonzero(label != np.arange(len(label)))
        a = pa.concat_arrays([reps.take(pa.array(some)), reps.take(pa.array(joined))])
        b = pa.concat_arrays([pa.nulls(len(some), reps.type), reps.take(pa.array(label[joined]))])
        return pa.table([a, b, pa.array(np.concatenate([n[some], np.zeros(len(joined), dtype=np.int64)]))], names=["a", "b", "n"])

    return lists.groupBy("pivot", "p", "q").applyInArrow(verified, out_type)


def choose_pivots(points: DataFrame, n: int, dim: int) -> np.ndarray:
    """The n points with the least hashes, without those that are near to one before."""
    found = points.select("point", F.xxhash64("point").alias("h")).orderBy("h").limit(n).select("point").toArrow()
    drawn = _unit(_matrix(found.column("point").combine_chunks(), dim))
    pivots, n = np.empty_like(drawn), 0
    for x in drawn:
        if not n or (pivots[:n] @ x).max() < APART:
            pivots[n] = x
            n += 1
    return pivots[:n]


def near_vectors(vectors: DataFrame, threshold: float = 0.95, named: int = 10, shared: int = 2, most_pivots: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per vector."""
    valid = Stored(valid_points(vectors, id_col, vec_col)).df
    points = Stored(valid.where(F.col("point").isNotNull()).groupBy("point").agg(F.min("vec_id").alias("rep"), F.count("*").alias("times"))).df
    edges, counts = None, None
    for dim in [r["d"] for r in points.groupBy(F.size("point").alias("d")).count().collect()]:
        own = points.where(F.size("point") == dim)
        total = own.count()
        # lists of named * total / n vectors: their length grows with the fourth root of the number of vectors only
        n = int(min(most_pivots, max(16, round(2.2 * total**0.65))))
        found = Stored(links(own, choose_pivots(own, n, dim), threshold, named, shared)).df
        some = found.where(F.col("b").isNotNull()).select("a", "b")
        more = found.where(F.col("b").isNull()).select("a", "n")
        edges = some if edges is None else edges.union(some)
        counts = more if counts is None else counts.union(more)
    if edges is None:
        kind = valid.schema["vec_id"].dataType.simpleString()
        return valid.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast(kind).alias("component_id"), F.lit(True).alias("kept"))
    part = components(edges).select(F.col("node").alias("rep"), "component")
    counted = counts.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    known = points.join(part, "rep", "left").join(counted, "rep", "left").select("point", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = valid.join(known, "point", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def brute_force(ids: list[int], matrix: np.ndarray, threshold: float = 0.95) -> list[tuple[int, int, int]]:
    """(vec_id, n_links, component_id) by comparing all pairs; for tests and recall."""
    x = _unit(np.asarray(matrix, dtype=np.float64))
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    order = np.argsort(ids)
    label = np.empty(len(ids), dtype=np.int64)
    label[order] = order[_forest(linked[np.ix_(order, order)])]
    return [(ids[i], int(linked[i].sum()), ids[label[i]]) for i in range(len(ids))]

