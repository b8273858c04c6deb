"""Secret scans over an incremental ledger of content-addressed blobs.

A version of a path is named by the SHA-256 of its text, and equal texts are one
blob. The ledger holds a row for every (blob, rule, rule version) that was scanned,
with what was found; a scan looks only at pairs the ledger lacks, appends them, and
joins the findings back to every path and version. Only built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txlake.llm.common import unused
from txlake.sources.shared import exists, fresh_path, stage

LEDGER = "blob string, kind string, version int, spans array<struct<start:long,end:long>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping, whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


#: The base rules. A maximal run of n characters is one match of ``{n,}`` and shorter runs hold
#: none, so the two run rules state their least length in the pattern. For ``assign`` a failing
#: match still uses up its characters, so its length is tested afterwards.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)


def versions(docs: DataFrame, path: str, text: str) -> DataFrame:
    """``path, blob, text``; a null text is the empty blob."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(path).alias("path"), F.sha2(whole, 256).alias("blob"), whole.alias("text"))


def _found(rule: Rule) -> Column:
    """Matches of one pending rule, each with the length of the text before it since the last one."""
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all("text", pattern, F.lit(0))
    gaps = F.transform(F.split("text", rule.pattern, -1), lambda g: F.length(g).cast("long"))
    wanted = F.array_contains("kinds", rule.kind) & F.col("text").rlike(rule.pattern)
    return F.struct(
        F.lit(rule.kind).alias("kind"),
        F.when(wanted, F.arrays_zip(hits.alias("hit"), gaps.alias("gap"))).alias("hits"),
    )


def find(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, kind, spans`` for the pending ``kinds`` of ``blob, text, kinds``; code points, end exclusive."""
    per_rule = blobs.select("blob", F.inline(F.array(*map(_found, rules)))).where("hits IS NOT NULL")
    hits = per_rule.select("blob", "kind", F.posexplode("hits").alias("nth", "h")).select(
        "blob", "kind", "nth", F.col("h.hit").alias("hit"), F.col("h.gap").alias("gap"), F.length("h.hit").alias("n")
    ).where("hit IS NOT NULL")
    so_far = W.partitionBy("blob", "kind").orderBy("nth").rowsBetween(W.unboundedPreceding, 0)
    placed = hits.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far).cast("long"))
    long_enough = F.lit(False)
    for r in rules:
        inner = F.col("hit") if r.group == 0 else F.regexp_extract("hit", r.pattern, r.group)
        long_enough = long_enough | ((F.col("kind") == r.kind) & (F.length(inner) >= r.least))
    spans = F.sort_array(F.collect_list(F.struct((F.col("end") - F.col("n")).alias("start"), "end"))).alias("spans")
    return placed.where(long_enough).groupBy("blob", "kind").agg(spans)


def scan(
    docs: DataFrame,
    path: str = "doc_id",
    text: str = "text",
    ledger: str | None = None,
    rules: tuple[Rule, ...] = RULES,
) -> tuple[DataFrame, DataFrame]:
    """Bring the ledger up to date; gives ``path, blob`` of every row and the findings ``blob, kind, spans``.

    ``ledger`` is a Parquet folder that all executors reach; without one the scan
    starts from an empty ledger in the shared folder. Findings are of the given
    rules at their versions, blobs with none have no row. A null text is the empty
    blob; null paths, repeated rows and many versions of one path are kept as they
    are; other columns, whatever their names, are ignored; an empty table gives
    no rows. One writer at a time.
    """
    spark = docs.sparkSession
    ledger = ledger or fresh_path(spark, "ledger")
    named = versions(docs, path, text)
    unique = named.groupBy("blob").agg(F.first("text").alias("text"))
    rule_rows = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    blobs = unique.withColumn("kinds", F.array(*[F.lit(r.kind) for r in rules]))
    if exists(spark, ledger):
        wanted = spark.read.schema(LEDGER).parquet(ledger)
        current = F.array_contains(rule_rows, F.struct("kind", "version"))
        seen = wanted.where(current).groupBy("blob").agg(F.collect_set("kind").alias("seen"))
        open_kinds = F.array_except("kinds", F.coalesce("seen", F.array().cast("array<string>")))
        blobs = unique.withColumn("kinds", F.array(*[F.lit(r.kind) for r in rules])).join(seen, "blob", "left").select(
            "blob", "text", open_kinds.alias("kinds")
        )
    blobs = blobs.where(F.size("kinds") > 0)
    pairs = versions(docs, path, text).select("blob").distinct()
    found = stage(find(blobs, rules), "findings")
    # every pair that was open, found or not
    scanned = pairs.select("blob", F.inline(rule_rows))
    if exists(spark, ledger):
        scanned = scanned.join(wanted.select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
    fresh = scanned.join(found, ["blob", "kind"], "left").select(
        "blob", "kind", "version", F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans")
    )
    fresh = stage(fresh, "scanned")  # before appending to the table it is compared with
    fresh.write.mode("append").parquet(ledger)
    current = F.array_contains(rule_rows, F.struct("kind", "version"))
    findings = spark.read.schema(LEDGER).parquet(ledger).where(current & (F.size("spans") > 0))
    return named.select("path", "blob"), findings.select("blob", "kind", "spans")


def by_blob(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, spans``: all spans of a blob by start, then by the rules' order."""
    order = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    each = findings.select("blob", "kind", order.alias("nth"), F.inline("spans"))
    spans = F.sort_array(F.collect_list(F.struct("start", "nth", "end", "kind"))).alias("spans")
    return each.groupBy("blob").agg(spans)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the characters of every secret in ``text`` replaced by ``[kind]``; clean rows stay as they are.

    Of overlapping spans the earlier one names the kind. A null text stays null,
    other columns stay as they are.
    """
    _, findings = scan(docs, rules=rules)
    blob, spans_of = (unused(name, docs) for name in ("blob", "spans"))
    spans = by_blob(findings, rules).withColumnsRenamed({"spans": spans_of, "blob": blob})
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        before = F.substring("text", state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        mark = F.when(s["start"] >= state["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], before, mark).alias("out")
        )

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring("text", state["at"] + 1, F.length("text")))

    hidden = F.when(F.col(spans_of).isNull(), F.col("text")).otherwise(F.aggregate(spans_of, start, step, finish))
    keyed = docs.withColumn(blob, F.sha2(F.coalesce("text", F.lit("")), 256))
    return keyed.join(spans, blob, "left").withColumn("text", hidden).select(docs.columns)
