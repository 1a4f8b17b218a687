"""Streaming variants: memberships kept per key as claims arrive, windowed changes, deduplicated puts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPELLS = "company_id long, entry_date date, exit_date date, left_censored boolean"


def closed_spells(claims: DataFrame, delay: str = "1 day") -> DataFrame:
    """A stream of spells, each as its removal arrives, from a stream of claims (company_id, at timestamp, action).

    State per company is the open entry and the last exit; claims are taken in order of time within a batch. A claim
    later than the watermark's delay is dropped, as is an ADD while a spell is open.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        entry, last = state.get if state.exists else (None, None)
        rows = []
        claims_ = pd.concat(list(batches)).sort_values(["at", "action"], kind="stable")
        for at, action in zip(claims_["at"], claims_["action"], strict=True):
            day = at.date()
            if action == "ADD":
                entry = entry or day
            elif action == "REMOVE":
                rows.append((key[0], entry if entry is not None else last, day, entry is None))
                entry, last = None, day
        state.update((entry, last))
        yield pd.DataFrame(rows, columns=["company_id", "entry_date", "exit_date", "left_censored"])

    marked = claims.select("company_id", "at", "action").withWatermark("at", delay)
    return marked.groupBy("company_id").applyInPandasWithState(step, SPELLS, "entry date, last date", "append", "NoTimeout")


def windowed_changes(claims: DataFrame, window: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Changes per window of event time and action; windows close when the watermark passes."""
    return claims.withWatermark("at", delay).groupBy(F.window("at", window), "action").agg(F.count("*").alias("n"))


def deduplicated(puts: DataFrame, delay: str = "7 days") -> DataFrame:
    """A stream of fetched bodies (url, sha256, at) without repeats of one body of a URL."""
    return puts.withWatermark("at", delay).dropDuplicatesWithinWatermark(["url", "sha256"])
