"""Secret scans by an incremental blob ledger, in DataFrame functions only.

Every version of a path is addressed by the SHA-256 of its content. The ledger, append-only Parquet in a shared folder,
has a row for each blob and rule version that was ever scanned, with the spans found. A scan takes the blobs of the
given versions, drops the (blob, rule version) pairs that the ledger has, scans one copy of each blob that is left and
appends; findings are then joined back to every path that has the blob.

Defined results: null content is empty content; repeated versions are separate rows of the result; an empty table gives
an empty one; spans are code points of the content, end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, packed, text_of, unpacked


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost non-overlapping; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
#: Further kinds, each with an unmistakable beginning.
MORE = (
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("code_host", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    # one try for each run of its characters, and no way back: linear on any text
    Rule("web_token", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
)
RULES = BASE + MORE
FOUND = "array<struct<start:int,end:int>>"
#: Places of the pattern's own groups move by this many in the tiling pattern.
_SHIFT = 2


def _spans(text: Column, rule: Rule) -> Column:
    """Spans of a rule in a text. Each tile is the gap before a match and the match; tiles join without a gap."""
    flags = "(?i)" if rule.pattern.startswith("(?i)") else ""
    tile = rf"{flags}\G([\s\S]*?)({rule.pattern.removeprefix(flags)})"
    part = lambda n: F.regexp_extract_all(text, F.lit(tile), F.lit(n))
    sizes = F.transform(F.arrays_zip(part(0).alias("tile"), part(2).alias("match"),
                                     part(rule.group + _SHIFT).alias("checked")),
                        lambda x: F.struct(F.length(x["tile"]).alias("tile"), F.length(x["match"]).alias("match"),
                                           F.length(x["checked"]).alias("checked")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("spans"))
    step = lambda a, x: F.struct(
        (a["at"] + x["tile"]).alias("at"),
        F.when(x["checked"] < rule.least, a["spans"]).otherwise(F.concat(a["spans"], F.array(F.struct(
            (a["at"] + x["tile"] - x["match"]).alias("start"), (a["at"] + x["tile"]).alias("end"))))).alias("spans"))
    found = F.aggregate(sizes, start, step, lambda a: a["spans"])
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(FOUND))


class Ledger:
    """Scanned (blob, rule version) pairs with their spans, below a path in a shared folder."""

    SCHEMA = f"blob binary, rule string, spans {FOUND}"

    def __init__(self, path: str):
        self.path = path

    def read(self, spark) -> DataFrame:
        from pyspark.errors import AnalysisException

        try:
            return spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.SCHEMA)  # nothing was scanned yet

    def append(self, scanned: DataFrame) -> None:
        scanned.write.mode("append").option("compression", "zstd").parquet(self.path)


def scan(versions: DataFrame, ledger: Ledger | None = None, *, path: str = "doc_id", content: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, blob, findings) for each version; findings: map of rule kind to spans, kinds without spans left out."""
    spark = versions.sparkSession
    ledger = ledger or Ledger(fresh_path(versions, "ledger"))
    rows = versions.select(F.col(path).alias("path"), text_of(versions, content).alias("content"))
    named = rows.withColumn("blob", F.unhex(F.sha2("content", 256)))
    keys = [r.key for r in rules]
    seen = ledger.read(spark).where(F.col("rule").isin(keys)).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    # one path stands for each blob: only ids and addresses are compared before contents move
    blobs = named.groupBy("blob").agg(F.min(F.coalesce(F.col("path").cast("string"), F.lit(""))).alias("one"))
    fresh = blobs.join(seen, "blob", "left").select(
        "blob", "one", F.array_except(F.lit(keys).cast("array<string>"), F.coalesce(
            "done", F.array().cast("array<string>"))).alias("todo")).where(F.size("todo") > 0)
    chosen = named.withColumn("one", F.coalesce(F.col("path").cast("string"), F.lit(""))) \
        .join(fresh.hint("shuffle_hash"), ["blob", "one"])
    results = F.array(*[F.struct(F.lit(r.key).alias("rule"), F.when(
        F.array_contains("todo", r.key), _spans(F.col("content"), r)).alias("spans")) for r in rules])
    scanned = chosen.select("blob", F.explode(F.filter(results, lambda x: x["spans"].isNotNull())).alias("x")) \
        .select("blob", "x.rule", "x.spans").dropDuplicates(["blob", "rule"])
    ledger.append(scanned)
    kinds = F.create_map(*[F.lit(x) for r in rules for x in (r.key, r.kind)])
    findings = ledger.read(spark).where(F.col("rule").isin(keys) & (F.size("spans") > 0)).dropDuplicates(["blob", "rule"]) \
        .groupBy("blob").agg(F.map_from_entries(F.collect_list(F.struct(kinds[F.col("rule")], "spans"))).alias("findings"))
    return named.select("path", "blob").join(findings, "blob", "left").select(
        F.col("path").alias(path), "blob", F.coalesce("findings", F.create_map().cast(f"map<string,{FOUND}>")).alias("findings"))


def listed(findings: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of the kinds by start, then kind as listed, joined by commas."""
    def numbered(n: int, kind: str) -> Column:
        return F.transform(F.coalesce(findings[kind], F.array().cast(FOUND)), lambda s: F.struct(
            s["start"].alias("start"), F.lit(n).alias("n"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    every = F.flatten(F.array(*[numbered(n, k) for n, k in enumerate(kinds)]))
    return F.array_join(F.transform(F.array_sort(every), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, findings: Column, mark: str = "<SECRET>") -> Column:
    """The text with each run of overlapping spans replaced by a mark."""
    spans = F.array_sort(F.flatten(F.map_values(findings)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    step = lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(
            F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)))).alias("out"))
    last = lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, last)).otherwise(text)


def redact(docs: DataFrame, ledger: Ledger | None = None, *, path: str = "doc_id", text: str = "text", length: str = "n_chars",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with secrets replaced in the text, and with its length if there is such a column."""
    found = scan(docs.select(path, text), ledger, path=path, content=text, rules=rules)
    found = found.where(F.size("findings") > 0).select("blob", "findings").dropDuplicates(["blob"])
    body = F.col("row").getField(text)
    rows = packed(docs).withColumn("blob", F.unhex(F.sha2(F.coalesce(body.cast("string"), F.lit("")), 256))) \
        .join(found, "blob", "left")
    new = F.when(F.col("findings").isNull(), body).otherwise(redacted(body, F.col("findings")))
    changed = {text: new}
    if length in docs.columns:
        changed[length] = F.when(F.col("findings").isNull(), F.col("row").getField(length)).otherwise(
            F.length(new).cast(docs.schema[length].dataType))
    return unpacked(rows, docs.columns, changed)
