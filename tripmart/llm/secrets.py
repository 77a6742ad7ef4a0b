"""Secret scans over a ledger of contents.

Every version of every file is addressed by the SHA-256 of its text. A blob is scanned once for each
rule version, however many paths and versions hold it and however often the scan is run; findings
are joined back to all of them. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FINDINGS = "array<struct<rule:string,begin:int,end:int>>"
_LEDGER = f"blob string, rules array<string>, findings {_FINDINGS}"


@dataclass(frozen=True)
class Rule:
    """A pattern in the syntax of java.util.regex.

    Matches are leftmost and do not overlap; of these, those are kept in which capture ``group``
    has at least ``least`` characters. A changed pattern needs a new ``version``.
    """

    name: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# Runs of one character class are found by their least length at once: a shorter run cannot hold a
# longer one, so no other match is opened up.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=1, least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^/:@\x00-\x20]{1,100}:[^/:@\x00-\x20]{1,100}@"),
)
RULES = BASE_RULES + MORE_RULES


def _matches(rule: Rule) -> Column:
    """Widths of matches and of the gaps before them, in code points; null where none is found."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    widths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    checked = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    found = F.arrays_zip(
        widths.alias("width"), checked.alias("checked"), F.slice(gaps, F.lit(1), F.size(widths)).alias("gap")
    )
    wanted = F.array_contains("todo", rule.key) & text.rlike(rule.pattern)
    return F.when(wanted, F.struct(F.lit(rule.key).alias("rule"), F.lit(rule.least).alias("least"), found.alias("found")))


def scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, findings) of (blob, text, todo) with something found; offsets count code points."""
    each = F.array_compact(F.array(*[_matches(r) for r in rules]))
    rows = (
        blobs.select("blob", F.explode(each).alias("hit"))
        .select("blob", "hit.rule", "hit.least", F.posexplode("hit.found").alias("place", "m"))
        .select("blob", "rule", "least", "place", "m.*")
    )
    # where a match begins: all gaps so far and all earlier matches of the rule in this blob
    before = (
        "sum(gap) OVER (PARTITION BY blob, rule ORDER BY place)"
        " + coalesce(sum(width) OVER (PARTITION BY blob, rule ORDER BY place"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    return (
        rows.withColumn("begin", F.expr(before).cast("int"))
        .filter(F.col("checked") >= F.col("least"))
        .groupBy("blob")
        .agg(F.collect_list(F.struct("rule", "begin", (F.col("begin") + F.col("width")).alias("end"))).alias("findings"))
    )


class BlobLedger:
    """What has been scanned for what, as a table that only grows.

    Rows are (blob, rule versions scanned, findings). A run adds its rows in one committed write, so
    a run that dies leaves nothing behind that counts and can be repeated.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        spark.createDataFrame([], _LEDGER).write.mode("append").parquet(folder)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(_LEDGER).parquet(self.folder)

    def update(self, versions: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> None:
        """Scan the blobs among ``versions`` for the rule versions they were not yet scanned for.

        Null text is the empty blob. Copies meet before the shuffle and once more after it.
        """
        names = [r.key for r in rules]
        if len(set(names)) < len(names):
            raise ValueError("rule names and versions must differ")
        wanted = F.array(*map(F.lit, names))
        seen = self.rows().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        text = F.coalesce(F.col(text_col), F.lit(""))
        todo = (
            versions.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
            .groupBy("blob").agg(F.first("text").alias("text"))
            .join(seen, "blob", "left")
            .select("blob", "text", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
            .filter(F.size("todo") > 0)
        )
        found = scan(todo, rules)
        (
            todo.select("blob", "todo").join(found, "blob", "left")
            .select("blob", F.col("todo").alias("rules"),
                    F.coalesce("findings", F.array().cast(_FINDINGS)).cast(_FINDINGS).alias("findings"))
            .write.mode("append").parquet(self.folder)
        )

    def findings(self, rules: Sequence[Rule] = RULES) -> DataFrame:
        """(blob, findings) of these rule versions, by begin and then by the order of the rules."""
        rank = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.key), F.lit(k))])
        keys = [r.key for r in rules]
        kept = F.filter(F.flatten(F.collect_list("findings")), lambda f: f["rule"].isin(keys))
        return (
            self.rows().filter(F.size("findings") > 0).groupBy("blob").agg(kept.alias("kept"))
            .select("blob", F.array_sort(F.array_distinct(F.transform(
                "kept", lambda f: F.struct(
                    f["begin"].alias("begin"), rank[f["rule"]].alias("rank"),
                    F.substring_index(f["rule"], "@", 1).alias("kind"), f["end"].alias("end"))))).alias("found"))
        )


def secret_findings(
    versions: DataFrame, ledger: BlobLedger, rules: Sequence[Rule] = RULES, *,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, blob, found) of every row of ``versions`` after bringing the ledger up to date.

    ``found`` lists (begin, rank, kind, end) by begin and then by the order of the rules, begin and
    end in code points, end exclusive; empty where nothing is found. Null text is scanned as the
    empty text. Repeated rows and ids give one result row each, other columns are not read.
    """
    ledger.update(versions, rules, text_col)
    empty = F.array().cast("array<struct<begin:int,rank:int,kind:string,end:int>>")
    blob = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    return (
        versions.select(F.col(id_col).alias("id"), blob.alias("blob"))
        .join(ledger.findings(rules), "blob", "left")
        .select(F.col("id").alias(id_col), "blob", F.coalesce("found", empty).alias("found"))
    )


def span_list(found: Column) -> Column:
    return F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["begin"], f["end"]))


def with_digest(findings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    base = [r.name for r in BASE_RULES]
    of = lambda name: F.filter("found", lambda f: f["kind"] == name)
    in_base = F.filter("found", lambda f: f["kind"].isin(base))
    return findings.select(
        id_col,
        *[F.size(of(name)).cast("long").alias(f"n_{name}") for name in base],
        F.sha2(F.concat_ws(",", span_list(in_base)), 256).alias("base_sha256"),
        F.concat_ws(",", span_list(F.col("found"))).alias("spans"),
    )
