"""Secret scans over an incremental ledger of content-addressed blobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetstar.llm.common import Scratch


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a regular expression; a match counts if its group ``group`` has ``least`` characters.

    ``hint`` is a cheap pattern every match contains; texts without it skip the rule.
    """

    kind: str
    pattern: str
    group: int
    least: int
    hint: str
    base: bool = False


#: Fixed patterns of the query's contract, in its order of kinds. Runs of at least so many characters are
#: the same spans as longer-than-nothing runs that are dropped when short, as a run is matched whole.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, "(?i)passw|secret|token|api_?key", True),
    Rule("access", "AKIA[A-Z0-9]{12,}", 0, 16, "AKIA[A-Z0-9]{12}", True),
    Rule("hex", "[0-9a-f]{32,}", 0, 32, "[0-9a-f]{32}", True),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "PRIVATE KEY-----"),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 40, "gh[pousr]_"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, "xox[abprs]-"),
)
RULE_VERSION = "2"
SPAN = "array<struct<start: bigint, kind: string, end: bigint, place: int>>"


def spans_of(text: Column, rule: Rule, place: int) -> Column:
    """The rule's spans in a text, in code points, end exclusive.

    The gaps between matches and the matches come from the same leftmost non-overlapping search;
    running sums of their lengths are the offsets. ``place`` is the rule's place in the list.
    """
    pattern = F.lit(rule.pattern)
    gaps, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    counted = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))

    def step(done, one):
        start = done["at"] + one["gap"]
        span = F.struct(start.alias("start"), F.lit(rule.kind).alias("kind"), (start + one["len"]).alias("end"), F.lit(place).alias("place"))
        spans = F.when(one["counted"] >= rule.least, F.array_append(done["spans"], span)).otherwise(done["spans"])
        return F.struct((start + one["len"]).alias("at"), spans.alias("spans"))

    lengths = F.zip_with(
        F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).cast("bigint").alias("gap"), F.length(m).cast("bigint").alias("len"))),
        counted,
        lambda gm, c: F.struct(gm["gap"].alias("gap"), gm["len"].alias("len"), F.length(c).alias("counted")),
    )
    # The gap after the last match has no match beside it.
    matches = F.filter(lengths, lambda one: one["len"].isNotNull())
    nothing = F.expr(f"cast(array() as {SPAN})")
    # Every step of a fold copies what it has gathered, so matches are folded in parts, after the parts' own offsets.
    named = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))

    def in_parts(found):
        size = F.ceil(F.cbrt(F.size(found))).cast("int")
        places = lambda at: F.sequence(at, F.least(at + size, F.size(found)) - 1)
        parts = F.transform(F.sequence(F.lit(0), F.size(found) - 1, size), lambda at: F.transform(places(at), lambda i: F.get(found, i)))
        return F.when(F.size(found) > 0, named(parts, lambda parts: named(offsets(parts), lambda at: folded(parts, at))))

    def offsets(parts):
        after = lambda at, part: F.aggregate(part, at, lambda at, one: at + one["gap"] + one["len"])
        return F.aggregate(parts, F.array(F.lit(0).cast("bigint")), lambda done, part: F.array_append(done, after(F.element_at(done, -1), part)))

    def folded(parts, at):
        start = lambda i: F.struct(F.get(at, i).alias("at"), nothing.alias("spans"))
        return F.flatten(F.transform(parts, lambda part, i: F.aggregate(part, start(i), step)["spans"]))

    return F.when(text.rlike(rule.hint), F.coalesce(named(matches, in_parts), nothing)).otherwise(nothing)


def scan(blobs: DataFrame, rules=RULES) -> DataFrame:
    """``sha256, spans`` for ``blobs (sha256, text)``; spans by start, then in the order of the rules."""
    found = F.concat(*[spans_of(F.col("text"), r, i) for i, r in enumerate(rules)])
    ordered = F.transform(F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return blobs.select("sha256", ordered.alias("spans"))


class Ledger:
    """Blob and rule-version pairs scanned so far, with their findings, in a folder of Parquet files.

    Appending is Spark's own committed write: a run that dies leaves no pairs behind and its blobs
    are scanned by the next run.
    """

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self, version: str) -> DataFrame:
        schema = "sha256 string, spans array<struct<start: bigint, end: bigint, kind: string>>"
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/rules={version}")
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(place.toString())

    def append(self, found: DataFrame, version: str) -> None:
        found.write.mode("append").parquet(f"{self.path}/rules={version}")


def scan_versions(paths: DataFrame, ledger: Ledger, path: str = "doc_id", text: str = "text", rules=RULES, version: str = RULE_VERSION) -> DataFrame:
    """``path, sha256, spans`` for every row of ``paths``: each historical version of each path is a row.

    A blob is a distinct text, addressed by its SHA-256. Blobs the ledger holds for this rule version
    aren't scanned again; of the others one path's text is scanned, and the findings are joined back
    to all paths with that content. Null text counts as empty; a repeated row, a null or repeated path
    keeps its row; other columns aren't read. Change ``version`` with the rules.
    """
    sha = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    scratch = Scratch(paths.sparkSession, "blobs")
    addressed = scratch.keep(paths.select(F.col(path).alias("_path"), sha.alias("sha256")), "addresses")
    # One row per blob, combined before the shuffle however many paths share it.
    unseen = addressed.groupBy("sha256").agg(F.min("_path").alias("_path")).join(ledger.read(version).select("sha256"), "sha256", "left_anti")
    texts = paths.select(F.col(path).alias("_own"), sha.alias("_sha"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    picked = texts.join(unseen, (texts["_sha"] == unseen["sha256"]) & texts["_own"].eqNullSafe(unseen["_path"]))
    ledger.append(scan(picked.select("sha256", "text"), rules).dropDuplicates(["sha256"]), version)
    found = ledger.read(version)
    return addressed.join(found, "sha256").select(F.col("_path").alias(path), "sha256", "spans")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, rules=RULES) -> DataFrame:
    """The counts, hash and text of the query, from ``doc_id, spans``."""
    base = [r.kind for r in rules if r.base]
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base_spans = joined(F.filter("spans", lambda s: s["kind"].isin(base)))
    return found.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in base], F.sha2(base_spans.cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
