"""Secret scans with an incremental blob ledger.

Every version of a path is addressed by the SHA-256 of its text (its blob).  The ledger holds one row per blob and
rule version that was ever scanned, with its findings.  A scan meets only blobs that lack a row for the wanted rule
version, each once however many paths and versions carry it; findings are joined back to all of them.

All of it is native: matches come from regexp_extract_all, their places from the lengths of what split leaves between
them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weighlens.llm.common import staged
from weighlens.storage import shared_dir


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int  # the group whose length counts
    least: int  # shorter matches are dropped


# fixed values: the patterns every scan has; either case means that of the letters a to z only
BASE_RULES = (
    Rule("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # runs are maximal, so shorter ones need not be matched to be dropped
)
RULE_VERSION = "1"
_BLOCK = 128

FINDINGS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("kind_no", T.IntegerType()),
    T.StructField("kind", T.StringType()), T.StructField("end", T.IntegerType()),
]))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Findings of one rule in code points, end exclusive."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    step = F.transform(
        F.arrays_zip(F.transform(whole, F.length).alias("size"), F.transform(part, F.length).alias("counted"),
                     F.transform(F.slice(gaps, 1, F.size(whole)), F.length).alias("gap")),
        lambda x: F.struct(x["size"].alias("size"), x["counted"].alias("counted"), x["gap"].alias("gap")),
    )
    nothing = F.array().cast(FINDINGS)

    def walk(block: Column) -> Column:
        """Findings of some matches that follow each other, counted from where the first one's gap begins."""
        return F.aggregate(
            block, F.struct(F.lit(0).alias("at"), nothing.alias("found")),
            lambda s, x: F.struct(
                (s["at"] + x["gap"] + x["size"]).alias("at"),
                F.when(
                    x["counted"] >= rule.least,
                    F.concat(s["found"], F.array(F.struct(
                        (s["at"] + x["gap"]).alias("start"), F.lit(number).alias("kind_no"), F.lit(rule.kind).alias("kind"),
                        (s["at"] + x["gap"] + x["size"]).alias("end"),
                    )).cast(FINDINGS)),
                ).otherwise(s["found"]).alias("found"),
            ),
        )

    def moved(block: Column, by: Column) -> Column:
        return F.transform(block["found"], lambda x: F.struct(
            (x["start"] + by).alias("start"), x["kind_no"].alias("kind_no"), x["kind"].alias("kind"), (x["end"] + by).alias("end")))

    # arrays are copied when they grow: matches are walked in blocks, then the blocks are moved to their places at once
    in_blocks = _let(step, lambda s: F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(s) / _BLOCK).cast("int") - 1), lambda k: walk(F.slice(s, k * _BLOCK + 1, _BLOCK))))
    found = _let(in_blocks, lambda blocks: _let(
        F.aggregate(blocks, F.array(F.lit(0)), lambda ends, x: F.concat(ends, F.array(F.element_at(ends, -1) + x["at"]))),
        lambda starts: F.flatten(F.transform(blocks, lambda x, i: moved(x, F.get(starts, i)))).cast(FINDINGS),
    ))
    return F.when(text.rlike(rule.pattern), found).otherwise(nothing)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def find_secrets(text: Column, rules: tuple[Rule, ...] = BASE_RULES) -> Column:
    """All findings of a text (NULL: empty), by start, then rule order."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*(_spans(text, r, n) for n, r in enumerate(rules))))


def version_of(rules: tuple[Rule, ...], name: str = RULE_VERSION) -> str:
    """What findings are kept under: a name and a hash of the rules, so that other rules never meet old findings."""
    return f"{name}-{hashlib.sha256(repr(rules).encode()).hexdigest()[:16]}"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


class BlobLedger:
    """The ledger as a folder of Parquet files that only grows."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or shared_dir(spark, "blob-ledger")
        self.schema = T.StructType([
            T.StructField("blob", T.StringType()), T.StructField("rule_version", T.StringType()),
            T.StructField("findings", FINDINGS),
        ])

    def rows(self) -> DataFrame:
        """The ledger so far; a rerun after a lost job may have added a row twice, it counts once."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def scan(self, versions: DataFrame, text: str = "text", row_id: str = "doc_id",
             rules: tuple[Rule, ...] = BASE_RULES, rule_version: str = RULE_VERSION) -> DataFrame:
        """Scan the blobs that are new under this rule version; returns (row_id, blob, findings) of all rows.

        ``row_id`` names the row (path and version).  NULL texts are the empty blob.  Repeated rows come back as often
        as they were given, rows with a NULL id too.  An empty table scans nothing and gives no rows.  Findings belong to
        ``rule_version`` and the rules themselves.  Texts with very many findings take time in proportion to them.
        """
        rule_version = version_of(rules, rule_version)
        blobs = versions.select(F.col(row_id), F.col(text).alias("__text"), blob_id(F.col(text)).alias("blob"))
        paths = staged(blobs.select(row_id, "blob"), "blob-paths")
        seen = self.rows().filter(F.col("rule_version") == rule_version).select("blob")
        # a blob is read from one row: that with the lowest id; repeats of this row are cut by the ledger's reader
        chosen = (
            paths.groupBy("blob").agg(F.min(row_id).alias("__chosen")).join(seen, "blob", "left_anti")
            .select(F.col("blob").alias("__blob"), "__chosen")
        )
        new = blobs.join(
            staged(chosen, "blob-chosen"), (F.col("blob") == F.col("__blob")) & F.col(row_id).eqNullSafe(F.col("__chosen")), "left_semi"
        )
        (
            new.select("blob", F.lit(rule_version).alias("rule_version"), find_secrets(F.col("__text"), rules).alias("findings"))
            .write.mode("append").parquet(self.path)
        )
        known = self.rows().filter(F.col("rule_version") == rule_version).filter(F.size("findings") > 0)
        known = known.groupBy("blob").agg(F.first("findings").alias("findings"))
        return paths.join(known, "blob", "left").select(
            row_id, "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings")
        )


def span_text(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_of(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda x: x["kind"] == kind)).cast("bigint")
