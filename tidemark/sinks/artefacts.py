"""Build artefacts: versions of Parquet tables, CSV exports, logs, manifest, report and run history."""

from __future__ import annotations

import json
import logging
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def flat(df: DataFrame) -> DataFrame:
    """Lists joined by ';', nulls as ''."""
    return df.select(*[(F.array_join(c, ";") if t.startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c, t in df.dtypes])


def write_csv(df: DataFrame, path: str, fields: list[str] | None = None, one_file: bool = False) -> None:
    """A CSV export; one_file is for small tables that people read."""
    out = flat(df.select(*fields) if fields else df)
    (out.coalesce(1) if one_file else out).write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")


def write_log(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON line per decision."""
    df.write.mode(mode).json(path)


def publish(tables: dict[str, DataFrame], folder: str) -> str:
    """Writes all tables as one new version and then makes it the current one with a single small file.

    A reader that asked for current() sees all tables of one version; a failure before that file leaves the old version.
    The version before stays for readers that are still at it; older and unfinished ones go. One writer at a time.
    """
    spark = next(iter(tables.values())).sparkSession
    version = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f-") + uuid.uuid4().hex[:8]
    for name, df in tables.items():
        df.write.parquet(f"{folder}/versions/{version}/{name}")
    write_text(spark, f"{folder}/versions/{version}/_COMPLETE", "\n".join(tables) + "\n")
    complete = _complete(spark, folder)
    root, fs = _fs(spark, f"{folder}/versions")
    for status in fs.listStatus(root):
        if status.getPath().getName() not in complete[-2:]:
            fs.delete(status.getPath(), True)
    return f"{folder}/versions/{version}"


def _complete(spark: SparkSession, folder: str) -> list[str]:
    pattern, fs = _fs(spark, f"{folder}/versions/*/_COMPLETE")
    return sorted(s.getPath().getParent().getName() for s in fs.globStatus(pattern) or [])


def current(spark: SparkSession, folder: str) -> str:
    """The folder of the latest complete version."""
    if not (found := _complete(spark, folder)):
        raise FileNotFoundError(f"no complete version of tables in {folder}")
    return f"{folder}/versions/{found[-1]}"


def exists(spark: SparkSession, where: str) -> bool:
    path, fs = _fs(spark, where)
    return fs.exists(path)


def append_run(spark: SparkSession, folder: str, manifest: dict) -> None:
    """A row of the run history, which loads never truncate."""
    now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    spark.createDataFrame([(manifest.get("built_at", now), now, json.dumps(manifest, sort_keys=True))], "built_at string, loaded_at string, manifest_json string").write.mode("append").parquet(f"{folder}/build_runs")


def latest_run(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/build_runs").orderBy(F.col("loaded_at").desc()).limit(1)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text through the file system that the path names."""
    where, fs = _fs(spark, path)
    out = fs.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())


def to_json(df: DataFrame) -> DataFrame:
    """Each row as a JSON document, dates in ISO form."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))


class JsonLines(logging.Formatter):
    """Log records as JSON lines."""

    def format(self, record: logging.LogRecord) -> str:
        row = {"ts": datetime.fromtimestamp(record.created, timezone.utc).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            row["exception"] = self.formatException(record.exc_info)
        return json.dumps(row | getattr(record, "fields", {}))
