"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as
Parquet to the shared folder and read again as the next stage's docs. All but the
last return the columns of ``docs``, other columns included.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalogue.registry import Entry, table
from millrace.llm import quality
from millrace.llm.byte_bpe import ByteBpe
from millrace.llm.decontaminate import contaminated
from millrace.llm.near_copies import near_copies, printed
from millrace.llm.secret_scan import find_secrets, redact
from millrace.storage import bound_batches, land, on_one_machine, scratch_path


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one that ``docs`` doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier rejects go; the rest stay as they are."""
    model = quality.fit(docs.select("doc_id", "text", "lang", "source"), table(spark, sf_dir, "labels"))
    p = _free(docs, "judged")
    return docs.withColumn(p, quality.score(spark, model)).filter(F.col(f"{p}.score") >= quality.THRESHOLD).drop(p)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near copies (five-word Jaccard of 0.8 or more) the row with
    the smallest doc_id stays (null counts as largest; of rows that share the id, one)."""
    bound_batches(spark)
    p, row = _free(docs, "printed"), _free(docs, "row")
    # written, so that the row numbers hold
    numbered = land(docs.withColumn(p, printed("text")).withColumn(row, F.monotonically_increasing_id()), "printed")
    small = numbered.select(F.col(row).alias("row"), F.col(f"{p}.fp").alias("fp"), F.col(f"{p}.node").alias("node"), "doc_id", "text")
    roots = near_copies(small.drop("doc_id"))
    rooted = small.select("row", "node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    kept = rooted.groupBy("root").agg(first).select(F.col("first.row").alias(row))
    return numbered.join(kept.hint("shuffle_hash"), row, "left_semi").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    bound_batches(spark)
    matches = _free(docs, "matches")
    marked = contaminated(docs, table(spark, sf_dir, "benchmark"), out=matches)
    return marked.filter(F.size(matches) == 0).drop(matches)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mask, and n_chars follows the text."""
    bound_batches(spark)
    clashing = {c: _free(docs, c) for c in ("blob", "spans") if c in docs.columns}
    found = find_secrets(docs.withColumnsRenamed(clashing), scratch_path(spark, "secret-ledger"))
    clean = redact(found, "text").drop("blob", "spans").withColumnsRenamed({new: old for old, new in clashing.items()})
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their digest, and whether decoding gives the text back."""
    bpe = ByteBpe(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    trip = docs.select("doc_id", "lang", "source", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("bytes"), bpe.round_trip("text").alias("t"))
    return trip.select(
        "doc_id",
        "lang",
        "source",
        F.size("t.ids").cast("long").alias("n_tokens"),
        F.col("t.ids").alias("token_ids"),
        F.sha2(F.array_join(F.col("t.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        (F.col("t.decoded") == F.col("bytes")).alias("decodes_back"),
    )


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("byte-level bpe", tokenised),
]

# a trained classifier, fingerprints and token ids are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_one_machine(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


ENTRY = Entry(run, ORACLE_SQL)
