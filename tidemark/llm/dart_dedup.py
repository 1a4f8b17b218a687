"""Near-duplicate texts by DartMinHash.

A text is a weighted set of its shingles (five words). Darts are thrown, by hashing, into each element's region of
weight × rank; all sets see the same darts. Each dart falls on one of k coordinates, and the earliest that hits a set's
weights is its signature there, so two signatures agree at a coordinate with the probability of the weighted Jaccard
similarity. Only the darts up to a rank of about (k ln k + 2 k) / total weight need to be looked at: their number
does not depend on the size of the set. (Unit weights, the default, make that the Jaccard similarity of sets.)

Signatures are cut into bands; documents with an equal band are candidates, in one bucket. A document first meets the
least of the first documents of its buckets, by the exact similarity of their shingle sets. Where a bucket then still
holds several components, all its pairs that lie in two of them are decided exactly, inside tasks that give back only a
forest of the links: no task's output grows faster than its input, and long buckets are cut into portions. Copies of one
text are one document until the end.

Inside, a document is its row's number, so ids may repeat: rows that share an id but not a text are documents of
their own. A bucket, text or class that very many rows share is dealt to several tasks wherever rows meet by it.

Defined results: null and empty texts, and those of white space only, are alone; texts of fewer than five words have
one shingle, all their words; one row per input row; rows with a null id are alone, their class null; of repeated
rows of one id and text each is a row of the class; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, Stored, components, heavy_from, in_parts, mix, spread_join, text_bytes, word_hashes, words

WIDTH, K, ROWS = 5, 120, 5
#: Documents and shingles of a portion of a bucket.
PORTION, PORTION_SHINGLES = 1000, 500_000
#: Up to so many candidates their ids are broadcast (about 12 MB) to pick out their shingles; beyond that they are joined by shuffling.
MOST_BROADCAST = 500_000
_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def shingles(raw: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, times): the distinct shingles, by document."""
    starts, ends = words(raw)
    hashes = word_hashes(raw, starts, ends)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    count = np.bincount(doc, minlength=len(offsets) - 1)
    total = np.zeros(len(hashes), dtype=np.uint64)
    n = np.minimum(count, width)[doc]
    for k in range(width):
        ahead = np.zeros(len(hashes), dtype=np.uint64)
        ahead[: max(0, len(hashes) - k)] = hashes[k:]
        total = np.where(k < n, total * _C1 + ahead, total)
    first = np.cumsum(count) - count
    place = np.arange(len(hashes)) - first[doc]
    whole = place <= count[doc] - n  # the window ends within its document
    doc, found = doc[whole], mix(total[whole] + n[whole].astype(np.uint64))
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    at = np.flatnonzero(new)
    return doc[at], found[at], np.diff(np.append(at, len(doc)))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int = K) -> np.ndarray:
    """(n_docs × k) 32-bit values. doc is ascending; documents without weight keep zeros."""
    out = np.zeros((n_docs, k), dtype=np.uint32)
    weight = np.asarray(weight, dtype=np.float64)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    todo = total > 0
    limit = np.divide(k * np.log(k) + 2 * k, total, out=np.zeros(n_docs), where=todo)
    # the region of a weight is made of slabs of height one, the last one cut off
    slabs = np.ceil(weight).astype(np.int64)
    of = np.repeat(np.arange(len(doc)), slabs)
    level = np.arange(len(of)) - np.repeat(np.cumsum(slabs) - slabs, slabs)
    slab_doc, height = doc[of], np.minimum(1.0, weight[of] - level)
    slab = mix(element[of] + level.astype(np.uint64) * _C3)
    while todo.any():
        use = todo[slab_doc]
        d, e, top = slab_doc[use], slab[use], height[use]
        rank = np.zeros(len(d))
        keys, ranks, values = [], [], []
        step = 0
        while len(d):
            step += 1
            h = mix(e + np.uint64(step * int(_C1) & 0xFFFFFFFFFFFFFFFF))
            rank = rank - np.log(((h >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53)
            on = rank <= limit[d]
            d, e, top, rank, h = d[on], e[on], top[on], rank[on], h[on]
            g = mix(h + _C2)
            hit = (g >> np.uint64(40)).astype(np.float64) * 2.0**-24 <= top
            g = g[hit]
            keys.append(d[hit] * k + ((g & np.uint64(0xFFFF)) * np.uint64(k) >> np.uint64(16)).astype(np.int64))
            ranks.append(rank[hit])
            values.append((mix(g) >> np.uint64(32)).astype(np.uint32))
        key, rank, value = np.concatenate(keys), np.concatenate(ranks), np.concatenate(values)
        order = np.lexsort((rank, key))
        key, value = key[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        out.reshape(-1)[key[first]] = value[first]
        filled = np.bincount(key[first] // k, minlength=n_docs)
        todo &= filled < k  # some coordinate got no dart: look further
        limit *= 2
    return out


def band_hashes(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(documents × bands) 64-bit values."""
    bands = signature.shape[1] // rows
    cut = signature[:, : bands * rows].reshape(-1, bands, rows).astype(np.uint64)
    total = np.arange(bands, dtype=np.uint64)[None, :] * _C2
    for i in range(rows):
        total = total * _C1 + cut[:, :, i] + np.uint64(1)
    return mix(total)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def described(docs: DataFrame, id_col: str, text_col: str, k: int, rows: int, weighted: bool) -> DataFrame:
    """(id, copy_of, bands, shingles); copy_of is the text's digest, bands are empty for texts without words."""

    def of(batches):
        for batch in batches:
            for part in in_parts(batch, text_col):
                raw, offsets = text_bytes(part.column(text_col))
                doc, found, times = shingles(raw, offsets)
                n = len(part)
                bands = band_hashes(signatures(doc, found, times if weighted else np.ones(len(doc)), n, k), rows).view(np.int64)
                count = np.bincount(doc, minlength=n)
                some = count > 0
                short = (found & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(id_col), part.column("copy_of"), _lists(bands[some].ravel(), some * bands.shape[1]), _lists(short, count)], ["id", "copy_of", "bands", "shingles"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows_in = docs.where(F.col(id_col).isNotNull()).select(id_col, text_col, F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("copy_of"))
    return rows_in.mapInArrow(of, f"id {kind}, copy_of string, bands array<long>, shingles array<int>")


def similar(pairs: DataFrame, sets: DataFrame, threshold: float, heavy: int) -> DataFrame:
    """The (a, b) of pairs whose sets (row, shingles) are similar enough, by exact Jaccard similarity."""
    left = spread_join(pairs, sets.select(F.col("row").alias("a"), F.col("shingles").alias("_x")), "a", ["b"], heavy)
    both = left.join(sets.select(F.col("row").alias("b"), F.col("shingles").alias("_y")), "b")
    common = F.size(F.array_intersect("_x", "_y"))
    return both.where(common >= F.lit(threshold) * (F.size("_x") + F.size("_y") - common) - 1e-9).select("a", "b")


def alike(sets: list[np.ndarray], threshold: float, width: int = 4096) -> np.ndarray:
    """The matrix of which sets have a Jaccard similarity of threshold or more, by products of incidence matrices."""
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    row, column = row[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    ends = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + width + 1, width))
    for i, (low, high) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        if high > low:
            part = np.zeros((len(sets), width), dtype=np.float32)
            part[row[low:high], column[low:high] - i * width] = 1
            common += part @ part.T
    return common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-6


def spanning(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric link matrix the least node of its component."""
    label = np.arange(len(linked))
    reach = linked | np.eye(len(linked), dtype=bool)
    while True:
        low = np.where(reach, label[None, :], len(linked)).min(axis=1)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def met_in_buckets(rows: DataFrame, buckets: DataFrame, sets: DataFrame, threshold: float, heavy: int) -> DataFrame:
    """(a, b): links that span those between different components within the buckets.

    rows: (bucket, row, component); buckets: (bucket, cut), a bucket's number of portions; sets: (row, shingles). Every
    pair of a bucket that lies in two components is decided exactly, but only a forest of the links leaves a task.
    Each pair of portions is a group of its own.
    """
    cut = spread_join(rows, buckets, "bucket", ["row"], heavy).withColumn("mine", F.pmod(F.xxhash64("row"), F.col("cut")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    met = F.struct("bucket", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q")).alias("met")
    cut = cut.select(met, "row", "component").join(sets, "row")

    def of(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("row").combine_chunks()
        _, part = np.unique(table.column("component").to_numpy(zero_copy_only=False), return_inverse=True)
        lists = table.column("shingles").combine_chunks()
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy()
        linked = alike([values[i:j] for i, j in zip(offsets[:-1], offsets[1:], strict=True)], threshold)
        linked &= part[:, None] != part[None, :]
        label = spanning(linked)
        joined = np.flatnonzero(label != np.arange(len(label)))
        return pa.table([ids.take(pa.array(label[joined])), ids.take(pa.array(joined))], names=["a", "b"])

    return cut.groupBy("met").applyInArrow(of, "a long, b long")


def classes(docs: DataFrame, threshold: float, k: int, rows: int, weighted: bool, id_col: str, text_col: str) -> DataFrame:
    """(id, copy_of, row, class_row, class_id) of the rows with an id; class_id is the least id of the class, class_row a
    number of the class that no other has."""
    seen = Stored(described(docs, id_col, text_col, k, rows, weighted).withColumn("row", F.monotonically_increasing_id()))
    heavy = heavy_from(seen.df.count() * (k // rows))
    copies = Stored(seen.df.where(F.size("bands") > 0).select("copy_of", "id", "row").groupBy("copy_of").agg(F.min("id").alias("least_id"), F.min("row").alias("rep"))).df
    firsts = seen.df.select("row", "bands", F.size("shingles").alias("m")).join(copies.select(F.col("rep").alias("row")), "row", "left_semi")
    banded = firsts.select("row", "m", F.explode("bands").alias("bucket"))
    buckets = Stored(banded.groupBy("bucket").agg(F.min("row").alias("hub"), F.max("row").alias("last")).where("hub < last").select("bucket", "hub")).df
    members = Stored(spread_join(banded, buckets, "bucket", ["row"], heavy).distinct()).df
    ids = Stored(members.select("row").distinct()).df
    few = ids.count() <= MOST_BROADCAST
    active = Stored(seen.df.select("row", "shingles").join(F.broadcast(ids) if few else ids, "row", "left_semi")).df
    whole = Stored(seen.df.select("id", "copy_of", "row")).df
    seen.drop()
    # a document first meets the least of its hubs; most buckets are in one component after that
    tested = Stored(members.where("row <> hub").groupBy(F.col("row").alias("b")).agg(F.min("hub").alias("a"))).df
    linked = Stored(similar(tested, active, threshold, heavy)).df
    known = Stored(components(linked)).df
    placed = members.join(known.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))
    cut = F.ceil(F.greatest(F.count("*") / PORTION, F.sum("m") / PORTION_SHINGLES)).cast("int")
    mixed = placed.groupBy("bucket", "hub").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("row").alias("last"), F.count("*").alias("n"), cut.alias("cut")).where("low < high")
    # of a bucket of two nothing is left to test if its pair has been
    untested = mixed.where("n = 2").join(tested.toDF("last", "hub"), ["last", "hub"], "left_anti").select("bucket", "cut").union(mixed.where("n > 2").select("bucket", "cut"))
    more = Stored(met_in_buckets(placed.select("bucket", "row", "component"), untested, active, threshold, heavy)).df
    if more.limit(1).count():
        known = Stored(components(linked.union(more))).df
    of_copy = Stored(copies.join(known.withColumnRenamed("node", "rep"), "rep", "left").select("copy_of", "least_id", F.coalesce("component", "rep").alias("class_row"))).df
    least = of_copy.groupBy("class_row").agg(F.min("least_id").alias("class_id"))
    named = spread_join(of_copy.drop("least_id"), least, "class_row", ["copy_of"], heavy)
    # texts without words are in no class with others
    found = spread_join(whole, named, "copy_of", ["row"], heavy, "left")
    return found.select("id", "copy_of", "row", F.coalesce("class_row", "row").alias("class_row"), F.coalesce("class_id", "id").alias("class_id"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, k: int = K, rows: int = ROWS, weighted: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, kept) per row of docs; class_id is the least id of the class, kept marks that document."""
    named = classes(docs, threshold, k, rows, weighted, id_col, text_col).select("id", "class_id")
    alone = docs.where(F.col(id_col).isNull()).select(F.col(id_col).alias("id"), F.col(id_col).alias("class_id"))
    return named.union(alone).select(F.col("id").alias(id_col), "class_id", F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of docs of which one per class is left: the one with the least id.

    Rows with a null id, and those without words, all stay. Of repeated rows of one id and text one stays. Rows that
    share an id but have different texts are documents of their own.
    """
    worded = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    found = Stored(classes(docs.where(worded), threshold, K, ROWS, False, "doc_id", "text")).df
    # a class's rows of its least id can be of several texts: one of them is taken
    of_id = found.where(F.col("id") == F.col("class_id")).groupBy("class_row", "id", "copy_of").agg(F.count("*").alias("n"))
    taken = of_id.groupBy("class_row").agg(F.min(F.struct("id", "copy_of", "n")).alias("x")).select(F.col("x.id").alias("_id"), F.col("x.copy_of").alias("_text"), F.col("x.n").alias("_n"))
    on = (F.col("doc_id") == F.col("_id")) & (F.md5("text") == F.col("_text"))
    once = docs.where(worded).join(taken.where("_n = 1"), on, "left_semi")
    repeated = docs.where(worded).join(taken.where("_n > 1"), on, "left_semi")
    one = repeated.withColumn("_text", F.md5("text")).dropDuplicates(["doc_id", "_text"])
    return once.unionByName(one.select(docs.columns)).unionByName(docs.where(~worded))
