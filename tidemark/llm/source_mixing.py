"""Mixing sources to target weights by repetition rates.

Sizes are summed per source; the targets follow from the weights, capped at a multiple of each source's size (what is
cut off is shared again by weight, which ends at one common level: target = least(cap, level * weight)). A document
is emitted floor(rate) times, and once more if a hash of its id falls below the fraction of the rate.

Defined results: a null text has size 0; a null source is a source of its own and the last; sources without words have
target 0 and nothing of them is taken; rows with the same id decide alike; without any words all targets are 0. Other
columns are kept by mix() and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, Stored

SEED = "mix-1"
#: Up to so many sources their rates are broadcast (under 10 MB); beyond that they are joined by sorting.
MOST_BROADCAST = 100_000


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from 32 bits of a hash of the key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, size); weights repeat over the sources in code point order.

    The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(ordered) - 1) % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    # with the sources before a row at their caps; this rises up to the first source whose cap isn't below it, then falls
    chosen = ranked.withColumn("level", level).withColumn("at", F.max("level").over(everything))
    return chosen.select("source", "source_size", F.least(F.col("most"), F.col("at") * F.col("weight")).alias("target"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) per row of docs."""
    sizes = Stored(sized(docs)).df
    return _decided(sizes, sizes, weights, cap, seed)


def _decided(sizes: DataFrame, rows: DataFrame, weights: tuple[float, ...], cap: float, seed: str) -> DataFrame:
    rates = Stored(source_targets(sizes, weights, cap)).df.withColumnRenamed("source", "_source")
    if rates.count() <= MOST_BROADCAST:
        rates = F.broadcast(rates)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + F.when(uniform(F.col("doc_id"), seed) < rate - F.floor(rate), 1).otherwise(0)
    joined = rows.join(rates, F.col("source").eqNullSafe(F.col("_source")))
    return joined.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("copies") * F.col("size")).drop("_source")


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0, seed: str = SEED) -> DataFrame:
    """The rows of docs as often as the mix takes them, with the columns of docs."""
    sizes = Stored(sized(docs)).df
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id"), F.col("source"), F.lit(0).cast("long").alias("size"))
    taken = _decided(sizes, rows, weights, cap, seed).where(F.col("copies") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")
