"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of a text is addressed by the SHA-256 of its bytes. A ledger keeps, for each (blob, rule version), the
spans that the rule found; a scan takes from the texts the distinct blobs, removes the pairs that the ledger has
already, runs only the rest, appends them, and joins the findings back to every path that holds the blob. The ledger is
partitioned by the first digits of the blob, and only rows of the scan's blobs are read from it. A pair that stands in it
more than once (a scan was repeated after a failure, or two ran at once) counts once: its rows hold the same spans. Matches are
found with the JVM's regular expressions; their places come from the lengths of the matches and of the text between
them, so no Python runs.

Defined results: a null text is an empty one; places are code points, the end is exclusive; letters match in ASCII
only; repeated rows and copies each get the findings of their blob; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored

SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string>>"
LEDGER = f"blob string, rule string, spans {SPAN}, prefix string"


@dataclass(frozen=True)
class Rule:
    """pattern's leftmost matches count if the group has least characters; maybe holds for every text with a match."""

    kind: str
    version: str
    pattern: str
    group: int
    least: int
    maybe: str


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either(x) for x in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = "(" + _NAMES + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of hex digits or of capitals is taken whole, so its least length may stand in the pattern.
BASE_RULES = (
    Rule("assign", "1", _ASSIGN, 2, 8, _ASSIGN),
    Rule("access", "1", "AKIA[A-Z0-9]{12,}", 0, 16, "AKIA[A-Z0-9]{12}"),
    Rule("hex", "1", "[0-9a-f]{32,}", 0, 32, "[0-9a-f]{32}"),
)
#: What the base rules don't see: private key blocks, and the short heads of signed web tokens.
MORE_RULES = (
    Rule("pem", "1", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "-----BEGIN "),
    Rule("jwt", "1", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ"),
)


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """The rule's spans in the text."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    rows = F.transform(F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("hit"), counted.alias("value")), lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.length(x["value"]).alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        span = F.struct(begin.alias("start"), F.lit(number).alias("kind_no"), (begin + x["hit"]).alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct((begin + x["hit"]).alias("at"), F.when(x["value"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(rule.maybe), F.aggregate(rows, start, add)["out"]).otherwise(F.array().cast(SPAN))


def with_prefix(blobs: DataFrame) -> DataFrame:
    """With the column by which the ledger is partitioned."""
    return blobs.withColumn("prefix", F.substring("blob", 1, 2))


def ledger_rows(ledger: DataFrame, blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rule, spans) of the ledger for the blobs and rules, one row per pair."""
    held = ledger.where(F.col("rule").isin([f"{r.kind}@{r.version}" for r in rules]))
    return held.join(with_prefix(blobs.select("blob")).distinct(), ["prefix", "blob"], "left_semi").select("blob", "rule", "spans").dropDuplicates(["blob", "rule"])


def scan_unseen(blobs: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None = None) -> DataFrame:
    """New ledger rows (blob, rule, spans) for the blobs (blob, text), one per pair that the ledger lacks."""
    names = [f"{r.kind}@{r.version}" for r in rules]
    if ledger is None:
        todo = blobs.withColumn("todo", F.array(*map(F.lit, names)))
    else:
        seen = ledger_rows(ledger, blobs, rules).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(F.array(*map(F.lit, names)), F.coalesce("seen", F.array().cast("array<string>"))))
        todo = todo.where(F.size("todo") > 0)
    nothing = F.lit(None).cast(SPAN)
    each = [F.struct(F.lit(n).alias("rule"), F.when(F.array_contains("todo", n), spans_of(F.col("text"), r, i)).otherwise(nothing).alias("spans")) for i, (n, r) in enumerate(zip(names, rules, strict=True))]
    return todo.select("blob", F.explode(F.filter(F.array(*each), lambda x: x["spans"].isNotNull())).alias("x")).select("blob", "x.rule", "x.spans")


def blobs_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The distinct blobs (blob, text). Copies meet before the shuffle as well as after it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.sha2(text, 256).alias("blob"), text.alias("text")).dropDuplicates(["blob"])


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, ledger_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, blob, spans) per row, spans by start and then in the rules' order.

    With ledger_path, a Parquet table that later scans pass again, only unseen pairs are scanned and then appended.
    """
    spark = docs.sparkSession
    ledger = None
    if ledger_path is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            ledger = spark.read.schema(LEDGER).parquet(ledger_path)
    new = Stored(scan_unseen(blobs_of(docs, text_col), rules, ledger))
    known = new.df
    if ledger_path is not None:
        with_prefix(new.df).repartition("prefix").write.mode("append").partitionBy("prefix").parquet(ledger_path)
        known = ledger_rows(spark.read.schema(LEDGER).parquet(ledger_path), blobs_of(docs, text_col), rules)
    found = known.where(F.size("spans") > 0).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    paths = docs.select(F.col(id_col), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("blob"))
    return paths.join(found, "blob", "left").select(id_col, "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def redact(docs: DataFrame, mark: str = "[secret]", rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """docs with every found span replaced by mark (spans that overlap or touch by one), n_chars counted anew.

    The columns of docs stay as they are otherwise; texts without findings pass untouched.
    """
    blob = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    new = Stored(scan_unseen(blobs_of(docs), rules))
    found = new.df.where(F.size("spans") > 0).groupBy(F.col("blob").alias("_blob")).agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("_spans"))
    joined = docs.join(found, blob == F.col("_blob"), "left")
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        plain = F.when(x["start"] > acc["at"], F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))).otherwise(F.when(acc["at"] == 0, F.lit(mark)).otherwise(acc["out"]))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), plain.alias("out"))

    done = F.aggregate("_spans", empty, add)
    masked = F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.length("text")))
    text = F.when(F.col("_spans").isNotNull(), masked).otherwise(F.col("text"))
    out = {"text": text, "n_chars": F.when(F.col("_spans").isNotNull(), F.length(masked).cast("long")).otherwise(F.col("n_chars"))}
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The counts and checksums of the spans of scan_secrets()."""

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.filter("spans", lambda x: x["kind_no"] < len(BASE_RULES))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in BASE_RULES]
    return scanned.select(id_col, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
