"""Identifiers made from content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def company_id(key: Column) -> Column:
    return F.concat(F.lit("C"), F.substring(F.sha1(key.cast("binary")), 1, 10))


def event_id(company: Column, on: Column, action: Column, label: Column) -> Column:
    text = F.concat_ws("|", company.cast("string"), F.date_format(on, "yyyy-MM-dd"), action, label)
    return F.concat(F.lit("E"), F.substring(F.sha1(text.cast("binary")), 1, 14))


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)
