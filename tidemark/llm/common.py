"""Helpers shared by the training-data operators: shared-folder tables, text bytes as numpy, components."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of a text are its runs of characters other than these.
WORD = r"[^\x20\x09-\x0D]+"

_own_dirs: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset (tests, local mode) a temporary one of this session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("on a cluster, spark.checkpoint.dir must name a shared folder")
    key = id(spark.sparkContext)
    if key not in _own_dirs:
        _own_dirs[key] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _own_dirs[key], ignore_errors=True)
    return "file://" + _own_dirs[key]


def _path(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


class Stored:
    """A DataFrame written as Parquet under the shared folder and read back: its lineage ends there."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.where = f"{shared_dir(self.spark)}/tidemark/{uuid.uuid4().hex}"
        df.write.parquet(self.where)
        path, fs = _path(self.spark, self.where)
        fs.deleteOnExit(path)
        self.df = self.spark.read.schema(df.schema).parquet(self.where)

    def drop(self) -> None:
        path, fs = _path(self.spark, self.where)
        fs.delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    return Stored(df).df


# -- texts as bytes ---------------------------------------------------------------------------------------------------

#: Odd multiplier of the polynomial hashes and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, each followed by one space, and where each text begins (one more at the end)."""
    spaced = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    offsets = np.frombuffer(spaced.buffers()[1], dtype=np.int64)[spaced.offset : spaced.offset + len(spaced) + 1]
    data = spaced.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes that end with a space."""
    space = _IS_SPACE[raw]
    before = np.empty(len(space), dtype=bool)
    before[:1] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(~before & space)
    return starts, ends


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, BASE, dtype=np.uint64)
    down = np.full(n + 1, BASE_INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_powers_of = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i up to n."""
    global _powers_of
    if len(_powers_of[0]) <= n:
        _powers_of = _powers(max(1 << 16, 1 << int(n).bit_length()))
    return _powers_of


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    up, down = powers(len(raw))
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def in_parts(batch: pa.RecordBatch, column: str, most: int = 1 << 20):
    """Slices of the batch with about as many bytes of text at most, so that arrays of a long batch stay small."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += int(n)
    if begin < len(sizes):
        yield batch.slice(begin)


# -- keys that many rows share ----------------------------------------------------------------------------------------

#: Rows of one key beyond which they are dealt to several tasks, and the most keys that can have so many.
HEAVY, MOST_HEAVY = 1000, 100_000


def heavy_from(n: int) -> int:
    """From how many rows a key is heavy in n rows: at most MOST_HEAVY keys are, so their list may be broadcast."""
    return max(HEAVY, -(-n // MOST_HEAVY))


def spread_join(many: DataFrame, one: DataFrame, key: str, by: list[str], heavy: int, how: str = "inner") -> DataFrame:
    """many joined with one (a row per key). The rows of a key that more than `heavy` rows of many share are dealt by a
    hash of `by` to several tasks, each with a copy of the key's row of one. how is inner or left."""
    cuts = many.groupBy(key).agg(F.ceil(F.count("*") / heavy).cast("int").alias("_cut")).where("_cut > 1")
    cuts = F.broadcast(cuts)  # at most as many rows as many / heavy
    dealt = many.join(cuts, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*by), F.coalesce("_cut", F.lit(1))).cast("int")).drop("_cut")
    copied = one.join(cuts, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_cut", F.lit(1)) - 1))).drop("_cut")
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")


# -- connected components ---------------------------------------------------------------------------------------------


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of edges (a, b) that has a neighbour; component is the smallest node reachable.

    Large-star and small-star in turn: each edge moves to the least neighbour of its lower end, then the lower
    neighbours of a node are all tied to the least of them, until every node has one lower neighbour that has none.
    Minima are taken before anything moves, and the edges of a node with very many are dealt to several tasks.
    """
    now = Stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    heavy = heavy_from(now.df.count())
    for _ in range(rounds):
        e = now.df
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
        if not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").limit(1).count():
            nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.union(e.select("v", "v").distinct())
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        large = spread_join(e, low.select(F.col("u").alias("v"), "m"), "v", ["u"], heavy, "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(large, least, "u", ["v"], heavy).where("v <> m").select("v", "m").union(least.select("u", "m"))
        after = Stored(small.toDF("u", "v").distinct())
        now.drop()
        now = after
    raise RuntimeError("components() needs more rounds")
