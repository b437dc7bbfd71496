"""Secret scan over an incremental ledger of blobs.

Every text version is addressed by its content (SHA-256). The ledger holds the
blobs already scanned, each with the rule versions it was scanned with, and
what was found. A scan looks only at pairs of blob and rule version that the
ledger lacks, on one version of each blob, appends to the ledger, and joins
findings back to every row with that content. DataFrame functions only.

The places of matches come from the matches and the gaps between them: a text
splits at a pattern into one gap more than there are matches, so the lengths
added up give code-point positions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_name, staged, text_column


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0        # the group that must have ``least`` characters
    least: int = 1

    @property
    def version(self) -> str:
        of = f"{self.pattern}\n{self.group}\n{self.least}"
        return f"{self.kind}:{hashlib.sha256(of.encode()).hexdigest()[:16]}"


# A key block: its BEGIN line, header fields, the body and the matching END line. Where another BEGIN or the end of the
# text comes first, the run of base64 words and lines that follows. Scans are over single characters, so none recurses.
_BASE64_NEXT = (r"(?:(?:[\x20\t]+|[\x20\t]*\r?\n[\x20\t]*)[A-Za-z0-9+/=]{16,}(?![^\x20\t\r\n])"
                r"|[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/=]+[\x20\t]*(?![^\r\n]))")
_PEM = (r"-----BEGIN ((?:[A-Z]+ )*)PRIVATE KEY-----(?:"
        r"(?=([\s\S]*?)-----(?:BEGIN |END \1PRIVATE KEY-----))\2-----END \1PRIVATE KEY-----"
        r"|(?:(?:[\x20\t]*\r?\n[A-Za-z-]{1,40}:[^\r\n]*){1,9}(?:[\x20\t]*\r?\n)?)?(?=" + _BASE64_NEXT + r")"
        r"[\s\S]*?(?<=[^\x20\t\r\n])(?![^\x20\t\r\n])(?!" + _BASE64_NEXT + r")"
        r"|[\x20\t]*[\\A-Za-z0-9+/=]{16,})?")

#: the base rules, in the order that ties at one start are listed
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # greedy runs of one class: a lower bound in the pattern drops the same short matches as one after it
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: further well-known credential formats
MORE_RULES = (
    Rule("pem", _PEM),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
)
RULES = BASE_RULES + MORE_RULES

SPAN = "struct<start:long,ord:int,end:long,kind:string>"


class Ledger:
    """Scanned (blob, rule versions) and spans found, as two tables under a
    shared path. ``create`` starts an empty one."""

    def __init__(self, spark: SparkSession, path: str, create: bool = False):
        self.spark, self.path = spark, path
        if create:
            self._add("scanned", spark.createDataFrame([], "blob string, versions array<string>"))
            self._add("findings", spark.createDataFrame([], "blob string, version string, start long, ord int, end long, kind string"))

    def _add(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{name}")

    def scanned(self) -> DataFrame:
        return self.spark.read.schema("blob string, versions array<string>").parquet(f"{self.path}/scanned")

    def findings(self) -> DataFrame:
        return self.spark.read.schema("blob string, version string, start long, ord int, end long, kind string").parquet(f"{self.path}/findings")

    def scan(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scans what is unseen of ``docs`` (doc_id, text) and returns
        (doc_id, blob) of all its rows. Findings are written before the blobs
        count as scanned, so a run that breaks off is done again, not lost."""
        versions = F.array(*[F.lit(r.version) for r in rules])
        rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text")).withColumn("blob", F.sha2("text", 256))
        keys = staged(rows.select("doc_id", "blob"), "secret-keys")
        seen = self.scanned().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("versions"))).alias("seen"))
        unseen = staged(
            keys.groupBy("blob").agg(F.min("doc_id").alias("at")).join(seen, "blob", "left")
            .select("blob", "at", F.array_except(versions, F.coalesce("seen", F.array().cast("array<string>"))).alias("versions"))
            .filter(F.size("versions") > 0), "secret-unseen")
        at = unseen.select(F.col("blob").alias("at_blob"), "at", "versions")
        texts = rows.join(at, (F.col("blob") == F.col("at_blob")) & F.col("doc_id").eqNullSafe(F.col("at")))
        self._add("findings", matches(texts.select("blob", "versions", "text"), rules).dropDuplicates(["blob", "version", "start"]))
        self._add("scanned", unseen.select("blob", "versions"))
        return keys

    def spans(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, spans): the findings of these rules, one row per blob that
        has any, by start and then by the rules' order."""
        kinds = self.findings().filter(F.col("version").isin([r.version for r in rules])).dropDuplicates(["blob", "version", "start"])
        order = F.array(*[F.lit(r.kind) for r in rules])
        kinds = kinds.withColumn("ord", F.array_position(order, F.col("kind")).cast("int"))
        return kinds.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "ord", "end", "kind"))).alias("spans"))


def matches(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, version, start, ord, end, kind) of the matches of each rule whose
    version is in ``versions``: leftmost and not overlapping per rule, those
    with too short a group dropped."""
    def found(r: Rule) -> F.Column:
        m, v = (F.regexp_extract_all("text", F.lit(r.pattern), F.lit(g)) for g in (0, r.group))
        sizes = F.arrays_zip(
            F.transform(m, F.length).alias("size"), F.transform(v, F.length).alias("value_size"),
            F.transform(F.slice(F.split("text", r.pattern, -1), 1, F.size(m)), F.length).alias("gap"))
        rows = F.transform(sizes, lambda x, i: F.struct(
            F.lit(r.version).alias("version"), F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"), i.alias("i"),
            x["size"].alias("size"), x["value_size"].alias("value_size"), x["gap"].alias("gap")))
        return F.when(F.array_contains("versions", F.lit(r.version)) & F.col("text").rlike(r.pattern), rows)

    # one pass over the texts: a null array explodes to nothing
    # rows that repeat id and text are counted along each on their own, and give the same matches
    hits = texts.withColumn("row", F.monotonically_increasing_id()).select(
        "blob", "row", F.explode(F.flatten(F.array_compact(F.array(*[found(r) for r in rules])))).alias("x")).select("blob", "row", "x.*")
    along = Window.partitionBy("blob", "row", "version").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(along)
    return hits.withColumn("end", end).filter("value_size >= least").select(
        "blob", "version", (F.col("end") - F.col("size")).alias("start"), F.lit(0).alias("ord"), "end", "kind")


def secret_spans(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, spans) of every row of ``docs``: a null text is empty,
    an empty text has no spans, repeated rows and ids are all kept, null ids
    stay null, other columns are ignored."""
    keys = ledger.scan(docs, rules)
    spans = staged(ledger.spans(rules), "secret-spans")
    return keys.join(spans, "blob", "left").select("doc_id", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def merged_spans(ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, parts): the stretches that spans cover, overlapping spans as one,
    in order; one row per blob that has any."""
    found = ledger.findings().filter(F.col("version").isin([r.version for r in rules])).select("blob", "start", "end").distinct()
    along = Window.partitionBy("blob").orderBy("start", "end")
    reached = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    fresh = found.withColumn("fresh", (reached.isNull() | (F.col("start") >= reached)).cast("int"))
    parts = fresh.withColumn("part", F.sum("fresh").over(along)).groupBy("blob", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return parts.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("parts"))


def redact_secrets(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each found span (overlapping ones as one) replaced by
    ``mark``; all rows and columns stay, whatever their names, and repeated
    rows all the same; a null text stays null, an empty one empty; no rows
    give no rows. A text with many spans is cut once: in UTF-32 a character
    has four bytes, so each part between two spans is found at once, in time
    that grows with the text and its spans."""
    ledger.scan(docs, rules)
    blob, parts = free_name(docs, "_blob"), free_name(docs, "_parts")
    spans = staged(merged_spans(ledger, rules), "secret-parts").select(F.col("blob").alias(blob), F.col("parts").alias(parts))
    mark_of_order = F.lit(b"\x00\x00\xfe\xff")                     # decoding eats one, and so not the text's own

    def between(i: F.Column, wide: F.Column) -> F.Column:
        """The text from the end of span i to the begin of the next one."""
        lo = F.when(i == 0, F.lit(0)).otherwise(F.element_at(F.col(parts), F.greatest(i, F.lit(1)))["end"])
        hi = F.when(i < F.size(parts), F.element_at(F.col(parts), F.least(i + 1, F.size(parts)))["start"]).otherwise(F.length(wide) / 4)
        part = F.substring(wide, (4 * lo + 1).cast("int"), (4 * (hi - lo)).cast("int"))
        return F.decode(F.concat(mark_of_order, part), "UTF-32")

    joined = docs.withColumn(blob, F.sha2(text_column(docs), 256)).join(spans, blob, "left")
    # an array of one: the wide text is made once a row
    cut = F.transform(F.array(F.encode(F.col("text"), "UTF-32")), lambda w: F.array_join(
        F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: between(i, w)), mark))[0]
    return joined.withColumn("text", F.when(F.col(parts).isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)
