"""The queries of the operators for training data, and their SQL counterparts where there are any."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.llm import (
    chat,
    codes,
    contamination,
    divergence,
    language,
    lines,
    neighbours,
    pieces,
    quality,
    scoring,
    setjoin,
    spans,
    tokencounts,
)
from pulseboard.sources.scratch import new_folder

PIECE_MODEL = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(modulus: int, remainder: int):
    """By the checksum of the id's digits; a row without an id is not held out."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(checksum % modulus == remainder, F.lit(False))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _held_out(5, 0)
    labels = _table(spark, sf_dir, "labels").where(~held_out)
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model, keep_text=False)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "bad_lines",
    )


def op2_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.dedup(docs).select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


OP2_SQL = f"""
    WITH {spans.dedup_oracle()}
    SELECT doc_id, n_words, n_removed, sha256(text) AS kept_sha256 FROM deduped"""


def op3_tokencounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as flat files of ids, and the token counts found in these."""
    path = new_folder(spark, "flat")
    width, end = tokencounts.write_flat(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(PIECE_MODEL))
    found = tokencounts.counts(spark, path, width=width, separator=end)
    part = F.regexp_extract("file", r"part-(\d+)-.*-c(\d+)", 1).cast("int")
    chunk = F.regexp_extract("file", r"part-(\d+)-.*-c(\d+)", 2).cast("int")
    return found.select(part.alias("part"), chunk.alias("chunk"), "doc", "n_tokens", "terminated")


def op4_setjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return setjoin.groups(docs, shingle=3, percent=90).select(
        F.col("_id").alias("doc_id"), "n_shingles", "component_id"
    )


OP4_SQL = f"""
    WITH RECURSIVE {setjoin.groups_oracle(3, 90)}
    SELECT doc_id, n_shingles, component_id FROM grouped"""


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _held_out(4, 2)
    model = language.fit(docs.where(~held_out).select("text", "lang"))
    return language.predict(docs.select("doc_id", "text"), model, keep_text=False).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )


# A conversation whose texts hold what looks like control strings.
TRICKY = r"\### Assistant: </turn> ok"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    pieces = chat.segments(given.unionByName(tricky))
    read = chat.formatted(pieces).withColumn("turns", chat.parsed(F.col("formatted")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        F.coalesce(F.col("first_bad"), F.lit(0)).cast("long").alias("first_bad"),
    )


def _escaped_sql(column: str) -> str:
    return f"replace(replace(replace({column}, chr(92), chr(92) || chr(92)), '<', chr(92) || 'l'), '>', chr(92) || 'g')"


_IN_ORDER = "turn NULLS FIRST, role, text"
OP6_SQL = f"""
    WITH given AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'),
    placed AS (
        SELECT *, row_number() OVER own AS place, lag(role) OVER own AS before, lead(role) OVER own IS NULL AS is_last
        FROM given WINDOW own AS (PARTITION BY conv_id ORDER BY {_IN_ORDER})),
    checked AS (
        SELECT *, CASE WHEN place = 1 THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
                       WHEN before = 'user' THEN role = 'assistant' ELSE false END AS allowed FROM placed)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length('<turn:></turn>') + length({_escaped_sql("role")}) + length({_escaped_sql("text")})) AS BIGINT) AS formatted_chars,
           bool_and(allowed) AND bool_or(is_last AND role = 'assistant') AS valid,
           coalesce(min(place) FILTER (NOT allowed), 0) AS first_bad
    FROM checked GROUP BY conv_id"""


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    checked = contamination.check(docs, _table(spark, sf_dir, "benchmark"), keep_text=False)
    return checked.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


OP9_SQL = f"""
    WITH {contamination.check_oracle()}
    SELECT d.doc_id, coalesce(len(w.w), 0) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
           sha256(coalesce(i.items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
    FROM documents d LEFT JOIN doc_words w ON w.doc_id = d.doc_id LEFT JOIN hit_words h ON h.doc_id = d.doc_id
         LEFT JOIN hit_items i ON i.doc_id = d.doc_id"""


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs).select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


OP10_SQL = f"""
    WITH {lines.dedup_oracle()}
    SELECT doc_id, n_lines, n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM deduped"""


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = public_tokenizers.path(PIECE_MODEL)
    coded = pieces.encode(docs, model, decoded="decoded").select("doc_id", "ids", "decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codes.compress(_table(spark, sf_dir, "embeddings"))
    return codes.label_errors(coded.rows).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(coded.digest).alias("codebooks_sha256"),
    )


OP12_SQL = f"""
    WITH {codes.compress_oracle()},
    told AS (
        SELECT place, id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(distance) AS BIGINT) AS error
        FROM coded GROUP BY ALL)
    SELECT id AS vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, d)) FROM b{codes.ROUNDS}) AS codebooks_sha256
    FROM told"""


def op13_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _held_out(7, 2)
    scored = scoring.score(docs.withColumn("held_out", held_out), ~F.col("held_out"))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_spans": op2_spans,
        "op3_tokencounts": op3_tokencounts,
        "op4_setjoin": op4_setjoin,
        "op5_language": op5_language,
        "op6_chat": op6_chat,
        "op7_pieces": op7_pieces,
        "op8_neighbours": op8_neighbours,
        "op9_contamination": op9_contamination,
        "op10_lines": op10_lines,
        "op11_divergence": op11_divergence,
        "op12_codes": op12_codes,
        "op13_scoring": op13_scoring,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_spans": OP2_SQL,
        "op4_setjoin": OP4_SQL,
        "op6_chat": OP6_SQL,
        "op9_contamination": OP9_SQL,
        "op10_lines": OP10_SQL,
        "op11_divergence": divergence.audit_oracle(),
        "op12_codes": OP12_SQL,
    }
