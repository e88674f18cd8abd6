"""Token counts of the documents in flat files of token ids.

A flat file is nothing but token ids, two or four little-endian bytes each, with an end-of-document
id after every document; no index says where documents begin. ``write_flat`` makes such files
from texts. ``counts`` finds the documents again: files are cut into blocks without regard to
documents, each task reads only its own blocks' bytes, each block is searched for the separator as one vector, and a prefix scan over the
blocks' summaries stitches the documents that cross borders, however many blocks they span.

Each block gives one row: its tokens, its separators, the tokens before the first and after the last
one, and the lengths of the documents that lie inside. The scan sums, per file and in order of the
blocks, the separators before a block (which number its documents) and the tokens that earlier
blocks left open.

Defined results: a separator directly after another (or at the start) ends an empty document of
length 0; tokens after the last separator are one more document, not terminated; an empty file has
no documents; a file whose size is not a whole number of tokens is an error; files can have any size. Null
texts are empty documents; repeated rows are repeated documents; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseboard.llm import pieces
from pulseboard.llm.texts import opened
from pulseboard.session import settings
from pulseboard.sources.scratch import written

BLOCK_TOKENS = 1 << 18
ROWS_A_FILE = 4096
# Bytes that a task reads, about.
TASK_BYTES = 32 << 20
# Bytes of text that go to a Python worker at once, about.
BATCH_BYTES = 8 << 20


def write_flat(docs: DataFrame, path: str, model_path: str, *, text: str = "text") -> tuple[int, int]:
    """Write the texts' ids as flat files; returns the bytes of a token and the separator.

    Spark's text writer puts out each row's bytes and then the separator in place of a line feed. A task has
    one Python step, as each such step of a task has a worker of its own, and workers keep their encoder.
    """
    vocabulary = pieces.read_vocabulary(model_path)
    width = 2 if len(vocabulary.pieces) <= 1 << 16 else 4
    end = vocabulary.end
    if end >= 128:
        raise ValueError("the separator's id must be below 128")
    coded = pieces.encode(
        docs.select(text), model_path, text=text, add_begin=False, add_end=False, keep_text=False, width=width
    )
    separator = chr(end) + "\0" * (width - 1)
    # The bytes seen as a string, without a look at them; the writer copies them as they are.
    rows = coded.select(F.col("ids").cast("string").alias("value"))
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        rows.write.option("lineSep", separator).option("maxRecordsPerFile", ROWS_A_FILE).text(path)
    return width, end


def blocks(spark: SparkSession, path: str, width: int, block: int) -> DataFrame:
    """(file, block): all files in a folder, cut into blocks of so many tokens; nothing is read yet."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    bad = F.raise_error(F.concat(F.lit("no flat token file of a size that can be read: "), "path"))
    checked = F.when(F.col("length") % width != 0, bad).otherwise(F.ceil(F.col("length") / (width * block)).cast("int"))
    numbered = files.where("length > 0").select(F.col("path").alias("file"), checked.alias("n"))
    total = numbered.agg(F.sum("n")).first()[0] or 0
    some = max(1, TASK_BYTES // (width * block))
    tasks = max(1, min(total, max(spark.sparkContext.defaultParallelism, -(-total // some))))
    at = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block")
    return numbered.select("file", at).repartition(tasks, "file", F.floor(F.col("block") / some), F.col("block") % 8)


def summaries(rows: DataFrame, width: int, separator: int, block: int) -> DataFrame:
    """(file, block, n, ends, head, tail, inside) of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opened(path) as file:
                    file.seek(at * width * block)
                    tokens = np.frombuffer(file.read(width * block), f"<u{width}")
                ends = np.flatnonzero(tokens == separator)
                any_ = len(ends) > 0
                out[0].append(len(tokens))
                out[1].append(len(ends))
                out[2].append(int(ends[0]) if any_ else 0)
                out[3].append(int(len(tokens) - 1 - ends[-1]) if any_ else len(tokens))
                out[4].append(np.diff(ends) - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *[pa.array(x, pa.int64()) for x in out[:4]], pa.array(out[4], pa.list_(pa.int64()))],
                names=["file", "block", "n", "ends", "head", "tail", "inside"],
            )

    return rows.mapInArrow(
        run, "file string, block int, n long, ends long, head long, tail long, inside array<bigint>"
    )


def counts(spark: SparkSession, path: str, *, width: int, separator: int, block: int = BLOCK_TOKENS) -> DataFrame:
    """(file, doc, n_tokens, terminated): documents in order, numbered from 0 in each file."""
    told = written(summaries(blocks(spark, path, width, block), width, separator, block), "blocks")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # Tokens that blocks leave open: what follows the last separator, or a whole block without one.
    # One task scans a file's blocks, without the lengths inside, which are joined again.
    scanned = told.drop("inside").withColumns(
        {
            "doc": F.coalesce(F.sum("ends").over(before), F.lit(0)),
            "left": F.coalesce(F.sum("tail").over(before), F.lit(0)),
            "last": F.lead("block").over(order).isNull(),
        }
    ).withColumn(
        "since", F.coalesce(F.last(F.when(F.col("ends") > 0, F.col("left")), True).over(before), F.lit(0))
    ).join(told.select("file", "block", "inside"), ["file", "block"])
    open_ = F.col("left") - F.col("since")
    first = F.when(F.col("ends") > 0, F.array(open_ + F.col("head"))).otherwise(F.array().cast("array<bigint>"))
    # What the file's last block leaves open is a document, too.
    rest = F.when(F.col("ends") > 0, F.col("tail")).otherwise(open_ + F.col("tail"))
    over = F.when(F.col("last") & (rest > 0), F.array(rest)).otherwise(F.array().cast("array<bigint>"))
    lengths = F.concat(first, "inside", over)
    return scanned.select(
        "file", "doc", "ends", F.posexplode(lengths).alias("k", "n_tokens")
    ).select("file", (F.col("doc") + F.col("k")).alias("doc"), "n_tokens", (F.col("k") < F.col("ends")).alias("terminated"))
