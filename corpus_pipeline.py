"""Documents to training tokens: five stages, each on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.llm import contamination, lines, pieces, quality, setjoin
from pulseboard.sources.scratch import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_QUALITY = 0.3
SHINGLE, PERCENT = 5, 80
MODEL = "piece_bpe_32k.model"
# Bytes of rows that go to a Python worker at once, about.
BATCH_BYTES = 8 << 20


def in_small_batches(spark: SparkSession) -> None:
    """A setting for the session, which stays: a stage's rows are made when they are written, after it has returned."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    in_small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    return quality.score(docs, model).where(F.col("score") >= LEAST_QUALITY).select(COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of lines that came before; documents of which nothing is left go."""
    kept = lines.dedup(docs).where("n_removed = 0 OR n_removed < n_lines AND trim(text) <> ''")
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document of the smallest id."""
    in_small_batches(spark)
    return setjoin.keep_first(docs, shingle=SHINGLE, percent=PERCENT).select(COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.check(docs, items).where(~F.col("contaminated")).select(COLUMNS)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of whole texts with begin and end (little-endian unsigned 32-bit integers), and whether
    they decode to the text."""
    in_small_batches(spark)
    coded = pieces.encode(docs, public_tokenizers.path(MODEL), decoded="decoded")
    return coded.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"),
    )


STAGES = [
    ("quality", good_quality),
    ("lines", without_repeated_lines),
    ("near_duplicates", without_near_duplicates),
    ("benchmark", without_benchmark),
    ("tokens", as_tokens),
]

# Neither the classifier nor the encoder can be said in SQL; tests hold the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
