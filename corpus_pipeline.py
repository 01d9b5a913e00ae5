"""A training-corpus pipeline: quality rules, near-duplicate removal,
benchmark decontamination, secret redaction and source mixing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``; the
last adds where each document stands in the mixed stream (``mix_slot``, the
order of blocks, and ``mix_offset``, the order inside a block).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import contamination, jaccard, mixing, rules, secret_scan
from tallyfold.session import durable_path, existing_files, materialize, ship_package
from tallyfold.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a learned rule rejects go."""
    learned = rules.fit_rules(docs, read_table(spark, sf_dir, "labels"))
    return rules.judge(docs, learned).where("_tf_kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the smallest id."""
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return contamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret, plain or encoded, is replaced by a mark."""
    clean = docs.withColumn("text", secret_scan.redacted_text(F.col("text")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its place in the mix of sources."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("source mixing", mix),
]

# Learned rules, decoded layers and the schedule are not expressible in SQL;
# the tests compare every stage with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, resume: str | None = None) -> DataFrame:
    """All stages over ``documents``.  With a name to ``resume`` by, each
    finished stage is kept under that name in the shared folder: a run that
    was broken off, run again with the same name, begins with the first stage
    that is not whole.  (A name belongs to one input.)"""
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        label = f"pipeline-{name.replace(' ', '-')}"
        if resume is None:
            docs = materialize(stage(spark, docs, sf_dir), label)
            continue
        path = durable_path(spark, f"pipelines/{resume}/{k}-{label}")
        # The writer puts the mark of success last.
        if not any(f.endswith("/_SUCCESS") for f in existing_files(spark, path)):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
