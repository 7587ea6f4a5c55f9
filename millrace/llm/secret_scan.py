"""Secret scans over an incremental ledger of content-addressed texts.

Every version of a document is a (path, text) pair; the SHA-256 of the text is
its blob. The ledger, a folder of Parquet files, holds one row per blob and
scan: the rules that were run (kind and version) and the spans they found. A
scan computes the blobs of the versions given, drops those whose rules have all
been run, scans each remaining blob once with the rules it lacks, appends the
outcome in one commit, and joins the ledger's findings back to every path.
A rule whose pattern changes gets a new version and is run over all blobs again.

Only DataFrame functions are used. Copies are reduced to one blob with a partial
aggregate before texts are shuffled; the join back carries digests, not
texts. Work on one blob is linear in its length: a pattern's matches and the
gaps between them give lengths, and a running sum gives positions.

Defined results: a null text is the empty text, without findings; ties at one
start are ordered by kind; versions that repeat give repeated rows; other columns
stay, and one named like a result column is replaced. A run that dies before its
commit leaves the ledger as it was; the next one scans the blobs again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SPAN = "struct<start: bigint, place: int, kind: string, end: bigint>"
LEDGER = f"blob string, rules array<string>, spans array<{_SPAN}>"
RESULT = ("blob", "spans")


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern``, without overlap. A match counts if its
    ``group`` has ``least`` characters or more; one that fails is skipped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds, in the order in which they are listed.
BASE_RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]+", 0, 16),
)


def _may_match(rule: Rule) -> Column:
    """False only for texts in which no match can be long enough."""
    tail = f"{{{rule.least},}}"
    pattern = rule.pattern
    if rule.group == 0 and pattern.endswith("]+"):
        fixed = len(pattern[: pattern.rindex("[")])
        pattern = pattern[:-1] + f"{{{max(1, rule.least - fixed)},}}"
    elif pattern.endswith("]+)"):
        pattern = pattern[:-2] + tail + ")"
    return F.rlike("text", F.lit(pattern))


def _lengths(rule: Rule) -> Column:
    """One struct per match: characters since the match before, of the match, of its group."""
    pattern = F.lit(rule.pattern)
    hits = F.transform(F.regexp_extract_all("text", pattern, F.lit(0)), F.char_length)
    sized = hits if rule.group == 0 else F.transform(F.regexp_extract_all("text", pattern, F.lit(rule.group)), F.char_length)
    gaps = F.transform(F.split("text", rule.pattern, -1), F.char_length)
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"), sized.alias("sized"))
    return F.transform(zipped, lambda m: F.struct(m["gap"].alias("gap"), m["hit"].alias("hit"), m["sized"].alias("sized")))


def _scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows for ``blob``, ``text`` and ``done`` (rules already run)."""
    match = "array<struct<gap: int, hit: int, sized: int>>"
    found = []
    for place, rule in enumerate(rules):
        due = ~F.array_contains("done", rule.key) & _may_match(rule)
        matches = F.when(due, _lengths(rule).cast(match)).otherwise(F.array().cast(match))
        found.append(F.struct(F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), F.lit(rule.least).alias("least"), matches.alias("matches")))
    run = F.array_except(F.array(*[F.lit(r.key) for r in rules]), F.col("done"))
    each = blobs.select("blob", run.alias("rules"), F.explode(F.array(*found)).alias("by"))
    rows = each.select("blob", "rules", "by.place", "by.kind", "by.least", F.posexplode_outer("by.matches").alias("n", "m"))
    before = Window.partitionBy("blob", "place").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.gap").cast("bigint") + F.col("m.hit")).over(before)
    spans = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("m.hit"))
    kept = F.when(F.col("m.sized") >= F.col("least"), F.struct("start", "place", "kind", "end"))
    return spans.groupBy("blob").agg(F.first("rules").alias("rules"), F.sort_array(F.collect_list(kept)).cast(f"array<{_SPAN}>").alias("spans"))


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    if not _exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def scan(versions: DataFrame, ledger: str, rules: Sequence[Rule] = BASE_RULES, text: str = "text") -> None:
    """Scan what the ledger lacks and append it."""
    spark = versions.sparkSession
    keys = F.array(*[F.lit(r.key) for r in rules])
    body = F.coalesce(F.col(text), F.lit(""))
    blobs = versions.select(F.sha2(body, 256).alias("blob"), body.alias("text")).dropDuplicates(["blob"])
    done = read_ledger(spark, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
    none = F.array().cast("array<string>")
    lacking = blobs.join(done, "blob", "left").withColumn("done", F.coalesce("done", none)).filter(F.size(F.array_except(keys, F.col("done"))) > 0)
    _scan(lacking, rules).write.mode("append").parquet(ledger)


def findings(spark: SparkSession, ledger: str, rules: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """``blob`` and ``spans`` (by start, then kind) under the given rule versions."""
    current = F.array(*[F.lit(r.key) for r in rules])
    places = {r.kind: n for n, r in enumerate(rules)}
    rows = read_ledger(spark, ledger).filter(F.arrays_overlap("rules", current))
    kinds = F.transform(F.array_intersect("rules", current), lambda k: F.split_part(k, F.lit("@"), F.lit(1)))
    own = F.filter("spans", lambda s: F.array_contains(kinds, s["kind"]))
    order = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])
    placed = F.transform(own, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("place"), s["kind"].alias("kind"), s["end"].alias("end")))
    return rows.select("blob", placed.alias("spans")).groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))


def find_secrets(versions: DataFrame, ledger: str, rules: Sequence[Rule] = BASE_RULES, text: str = "text") -> DataFrame:
    """Bring the ledger up to date and add ``blob`` and ``spans`` to each version."""
    scan(versions, ledger, rules, text)
    kept = [c for c in versions.columns if c not in RESULT]
    addressed = versions.select(*kept, F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("blob"))
    return addressed.join(findings(versions.sparkSession, ledger, rules), "blob", "left").select(*kept, "blob", "spans")


def redact(found: DataFrame, text: str = "text", mask: str = "<secret>") -> DataFrame:
    """Replace every run of overlapping or touching spans in ``text`` by ``mask``."""
    span = "array<struct<start: bigint, end: bigint>>"

    def merge(runs, s):
        last = F.try_element_at(runs, F.lit(-1))
        longer = F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        new = F.concat(runs, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))
        return F.when((F.size(runs) > 0) & (last["end"] >= s["start"]), longer).otherwise(new)

    runs = F.aggregate("spans", F.array().cast(span), merge)
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("__runs", lambda r: r["end"]))
    ends = F.concat(F.transform("__runs", lambda r: r["start"]), F.array(F.char_length(text).cast("bigint")))
    pieces = F.transform(F.arrays_zip(begins.alias("b"), ends.alias("e")), lambda p: F.substring(F.col(text), (p["b"] + 1).cast("int"), (p["e"] - p["b"]).cast("int")))
    cleaned = F.when(F.size("spans") > 0, F.array_join(pieces, mask)).otherwise(F.col(text))
    return found.withColumn("__runs", F.when(F.size("spans") > 0, runs)).withColumn(text, cleaned).drop("__runs")
