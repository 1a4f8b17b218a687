"""Membership lists, curated hints, build artefacts and stored tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_name, normalize_ticker, parse_date
from ..sinks.artefacts import current

#: Where each source's bodies stand, and what they are.
SOURCES = {
    "wikipedia_constituents": "the current list of members",
    "wikipedia_changes": "the table of changes",
    "wikipedia_revision": "dated revisions of the list",
    "reference_fja05680": "full lists of labels by date",
    "curated": "hand-checked hints",
}


def membership_list(spark: SparkSession, path: str) -> DataFrame:
    """(on_date, tickers) from CSV rows of a date and a comma-joined list; labels that don't look like any stay, in upper case."""
    rows = spark.read.csv(path, header=True, schema="date string, tickers string", quote='"', escape='"')
    labels = F.filter(F.transform(F.split("tickers", ","), lambda t: F.trim(t)), lambda t: t != "")
    clean = F.transform(labels, lambda t: F.coalesce(normalize_ticker(t), F.upper(t)))
    return rows.select(F.to_date(F.trim("date")).alias("on_date"), F.array_sort(F.array_distinct(clean)).alias("tickers")).orderBy("on_date")


def _csv(spark: SparkSession, folder: str, name: str, columns: str) -> DataFrame:
    """A small curated file with the position of each row; none is an empty table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], columns).withColumn("position", F.lit(0).cast("long"))
    return spark.read.csv(f"{folder}/{name}", header=True, schema=columns, quote='"', escape='"').withColumn("position", F.monotonically_increasing_id())


def curated(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """aliases, ticker_changes, distinct names and overrides."""
    aliases = _csv(spark, folder, "company_aliases.csv", "alias_name string, canonical_name string, entity_key string, source_url string")
    changes = _csv(spark, folder, "ticker_changes.csv", "old_ticker string, new_ticker string, effective_date string, company_name string, source_url string")
    distinct = _csv(spark, folder, "distinct_entities.csv", "name string, note string, source_url string")
    overrides = _csv(spark, folder, "event_overrides.csv", "mode string, effective_date string, action string, ticker string, company_name string, reason string, source_url string, confidence string, note string")
    return {
        "aliases": aliases.select("position", F.trim("alias_name").alias("alias_name"), F.trim("canonical_name").alias("canonical_name"), F.nullif(F.trim(F.coalesce("entity_key", F.lit(""))), F.lit("")).alias("entity_key")),
        "ticker_changes": changes.select("position", normalize_ticker(F.col("old_ticker")).alias("old_ticker"), normalize_ticker(F.col("new_ticker")).alias("new_ticker"), parse_date(F.col("effective_date")).alias("effective_date"), F.trim("company_name").alias("company_name"), "source_url"),
        "distinct": distinct.select(normalize_name(F.col("name")).alias("name_key")),
        "overrides": overrides.where(F.trim(F.coalesce("mode", F.lit(""))) != ""),
    }


def artefact(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An exported CSV with '' as null."""
    return spark.read.csv(path, header=True, schema=schema, nullValue="", quote='"', escape='"')


def stored_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the current version that sinks.artefacts.publish() wrote."""
    return spark.read.parquet(f"{current(spark, folder)}/{name}")


def addresses(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(source, url) in the order of sources.csv: what a scrape fetches. A url of the revision source holds {revid}, one of
    its lookup {date}. The file is kept by hand and small."""
    rows = _csv(spark, folder, "sources.csv", "source string, url string").orderBy("position")
    return [(r["source"], r["url"]) for r in rows.collect()]


def jdbc_table(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A table of a relational database; its driver must be on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def exists(folder: str) -> bool:
    return Path(folder).exists()
