"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of a text is addressed by its SHA-256. A ledger table in shared storage holds what has been
found per blob and rule version, including that nothing was found; a scan runs the rules over blobs that the ledger lacks and appends
to it, and findings are joined back to every path that has the blob. A blob that a third of all paths
share is scanned once; the join back to its paths is one that AQE splits.

Positions come from splitting a text at a rule's matches: the pieces' and matches' lengths add up to
them. Rules run in the JVM's regular expressions without look-around.

Defined results: a null text is the empty blob; a null path is reported with its blob's findings; repeated
rows are repeated; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from epiframe.llm.common import new_path, staged


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; ``value`` cuts the part that ``min_chars`` counts from a match."""

    kind: str
    pattern: str
    min_chars: int
    value: str | None = None


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
RULES = (
    Rule("assign", _ASSIGN + "[A-Za-z0-9+/_.=-]+", 12, "^" + _ASSIGN),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]+", 16),
)
#: Change it with the rules: what a ledger holds is good for its version.
RULE_VERSION = "base-1"
#: Columns of the ledger, which is partitioned by version: a scan reads its own version's part.
LEDGER = "sha string, findings array<struct<start:int,kind_no:int,end:int,kind:string>>, version string"


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def find(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``sha, findings`` of ``sha, text``; findings: array of ``start, kind_no, end, kind`` in order."""
    out = blobs
    for k, rule in enumerate(rules):
        pattern = rule.pattern
        if rule.value is None:
            head = pattern[: pattern.rindex("[")]
            pattern = pattern[:-1] + "{" + str(rule.min_chars - len(head)) + ",}"
        q = _quote(pattern)
        counted = "length(m)" if rule.value is None else f"length(regexp_replace(m, {_quote(rule.value)}, ''))"
        out = out.withColumn(f"_m{k}", F.expr(f"transform(regexp_extract_all(text, {q}, 0), m -> struct(length(m) AS n, {counted} AS counted))"))
        # without a match the text is not split at all
        out = out.withColumn(f"_g{k}", F.expr(f"CASE WHEN size(_m{k}) > 0 THEN transform(split(text, {q}, -1), g -> length(g)) END"))
    one = "array<struct<start:int,kind_no:int,end:int,kind:string>>"
    for k, rule in enumerate(rules):
        # a fold over the lengths of gaps and matches gives positions
        out = out.withColumn(
            f"_s{k}",
            F.expr(f"""CASE WHEN _g{k} IS NULL THEN CAST(array() AS {one}) ELSE aggregate(
                zip_with(_m{k}, slice(_g{k}, 1, size(_m{k})), (m, g) -> struct(g AS gap, m.n AS n, m.counted >= {rule.min_chars} AS good)),
                struct(0 AS pos, CAST(array() AS {one}) AS found),
                (a, x) -> struct(a.pos + x.gap + x.n AS pos, CASE WHEN x.good THEN concat(a.found, array(struct(a.pos + x.gap AS start, {k} AS kind_no, a.pos + x.gap + x.n AS end, '{rule.kind}' AS kind))) ELSE a.found END AS found),
                a -> a.found) END"""),
        )
    return out.select("sha", F.array_sort(F.concat(*(f"_s{k}" for k in range(len(rules))))).alias("findings"))


def scan(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, version: str = RULE_VERSION) -> DataFrame:
    """``id_col, sha, findings`` of every row; ``ledger`` is the path of the ledger table, made if missing."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    paths = docs.select(F.col(id_col), F.sha2(text, 256).alias("sha"))
    blobs = docs.select(F.sha2(text, 256).alias("sha"), text.alias("text"))
    try:
        known = spark.read.schema(LEDGER).parquet(ledger).where(F.col("version") == version).select("sha")
        blobs = blobs.join(known, "sha", "left_anti")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    unseen = blobs.dropDuplicates(["sha"])
    find(unseen, rules).select("sha", F.lit(version).alias("version"), "findings").write.mode("append").partitionBy("version").parquet(ledger)
    found = spark.read.schema(LEDGER).parquet(ledger).where((F.col("version") == version) & (F.size("findings") > 0)).select("sha", "findings")
    # two scans at a time may both have entered a blob; written, so that AQE can split the join on a hot blob
    found = staged(found.dropDuplicates(["sha"]), "secret-findings")
    none = F.array().cast("array<struct<start:int,kind_no:int,end:int,kind:string>>")
    return paths.join(found, "sha", "left").select(id_col, "sha", F.coalesce("findings", none).alias("findings"))


def fresh_ledger(spark) -> str:
    return new_path(spark, "secret-ledger")
