"""Comparison of two dated memberships, and ranges of disagreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CLUSTER_TOLERANCE_DAYS

MISSING, EXTRA = "missing_in_ours", "extra_in_ours"


def differences(ours: DataFrame, theirs: DataFrame, keys: list[str], comparison: str) -> DataFrame:
    """(keys, comparison, kind): what one side has and the other lacks, in one pass over both."""
    both = ours.select(*keys).distinct().withColumn("_o", F.lit(1)).withColumn("_t", F.lit(0)).union(theirs.select(*keys).distinct().withColumn("_o", F.lit(0)).withColumn("_t", F.lit(1)))
    sides = both.groupBy(*keys).agg(F.max("_o").alias("_o"), F.max("_t").alias("_t")).where(F.col("_o") != F.col("_t"))
    return sides.select(*keys, F.lit(comparison).alias("comparison"), F.when(F.col("_o") == 1, EXTRA).otherwise(MISSING).alias("kind"))


def tallies(ours: DataFrame, theirs: DataFrame, at: str, keys: list[str]) -> DataFrame:
    """Per date how many there are on either side, and how many only on one."""
    both = ours.select(at, *keys).distinct().withColumn("_o", F.lit(1)).withColumn("_t", F.lit(0)).union(theirs.select(at, *keys).distinct().withColumn("_o", F.lit(0)).withColumn("_t", F.lit(1)))
    sides = both.groupBy(at, *keys).agg(F.max("_o").alias("_o"), F.max("_t").alias("_t"))
    return sides.groupBy(at).agg(F.sum("_o").alias("ours"), F.sum("_t").alias("theirs"), F.count_if((F.col("_o") == 0)).alias("missing"), F.count_if(F.col("_t") == 0).alias("extra"))


def collapse(found: DataFrame, keys: list[str], at: str, days: int = CLUSTER_TOLERANCE_DAYS) -> DataFrame:
    """Per comparison, kind and key: first and last date, their number, and whether that is more than a difference of dates."""
    ranges = found.groupBy("comparison", "kind", *keys).agg(F.min(at).alias("first_date"), F.max(at).alias("last_date"), F.count("*").alias("n_dates"))
    span = F.datediff("last_date", "first_date")
    return ranges.withColumn("severity", F.when(span <= days, "minor_date_disagreement").otherwise("membership"))


def unique_owner(labels: DataFrame, label: str, owner: str, key: Column) -> DataFrame:
    """(tkey, owner) of the compare keys that exactly one owner has."""
    return labels.groupBy(key.alias("tkey")).agg(F.min(owner).alias(owner), F.max(owner).alias("_last")).where(F.col(owner) == F.col("_last")).drop("_last")


def render_report(ranges: DataFrame, per_date: DataFrame, issues: DataFrame, unknown: DataFrame, meta: dict, most_rows: int = 10_000) -> str:
    """The report in Markdown. Its tables hold at most most_rows rows each; the counts above them cover everything."""
    lines = ["# Reconciliation", "", f"Built: {meta.get('built_at', '')}", ""]

    def table(title: str, rows: DataFrame, order: list[str]) -> None:
        lines.extend(["", f"## {title} ({rows.count()})", "", "| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)])
        lines.extend("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows.orderBy(*order).limit(most_rows).collect())

    table("Dates", per_date.where("missing > 0 OR extra > 0"), [per_date.columns[0]])
    table("Counts of ranges", ranges.groupBy("comparison", "severity", "kind").count(), ["comparison", "severity", "kind"])
    table("Membership disagreements", ranges.where("severity = 'membership'"), ["comparison", "first_date"])
    table("Differences of dates", ranges.where("severity <> 'membership'"), ["comparison", "first_date"])
    table("Issues by kind", issues.groupBy("kind").count(), ["kind"])
    table("Identities to review", unknown, [unknown.columns[0]])
    return "\n".join(lines) + "\n"
