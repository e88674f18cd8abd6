"""Removal of long word sequences that another document has already, by de Bruijn compaction.

Every window of 50 consecutive words is an edge of a de Bruijn graph (its two ends are the
sequences of 49 words). Windows that follow each other and share their minimizer, the least hash
of twenty consecutive words inside, make a path; equal windows have equal minimizers, wherever they
stand, so all occurrences of an edge meet under one minimizer, and a path is one row instead of some
sixteen. Spark joins then compact the graph minimizer by minimizer:

* a minimizer that only one document has cannot lie on a repeated edge; its paths are left out;
* where all paths of a minimizer are the same, none branches, and the whole path has one first
  document;
* where paths differ (some documents go on differently, or begin or end there), the distinct paths
  are taken apart into their edges, and the first document of each edge is found.

Each path then knows for each of its edges the first document; coordinates of the source, the
document and the place of each occurrence, give the words to remove, and runs that touch are merged.
Paths and edges are told apart by two independent 64-bit hashes over hashes of the words.

Of several documents with a window, the one of the smallest id keeps it; its own repetitions stay,
too. Windows are judged on the texts as they came in.

Defined results: null and empty texts have no words; texts of fewer words than a window stay as they
are; rows without an id neither lose words nor make others lose any; rows of equal id count as one
document, so they do not affect each other; kept words are joined by one space, in texts that
lose nothing as well. Other columns stay; a column that has the name of a new one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.llm.tables import BROADCAST_ROWS, checked
from pulseboard.llm.texts import SECOND_BASE, SPACES, U64, Words, long_array, pieces, span_hashes, words
from pulseboard.sources.scratch import written

WINDOW = 50
# Lines that many documents share are mostly shorter; their words alone make no bucket.
MINIMIZER = 20
# A path of more edges (in a text that repeats itself) goes on as another one.
PATH = 64
NEW = ("n_words", "n_removed")


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _paths(w: Words, window: int, size: int) -> tuple[np.ndarray, ...]:
    """Row, first word in its row, edges, minimizer and two hashes of each path of a piece."""
    n = len(w.hashes)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),) * 3
    if n < window:
        return none
    row = np.repeat(np.arange(len(w.counts)), w.counts)
    at = np.arange(n - window + 1)
    inside = row[at] == row[at + window - 1]
    if not inside.any():
        return none
    few = span_hashes(w.hashes, np.arange(n - size + 1), np.arange(size, n + 1))
    least = _least(few, window - size + 1)
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1 : len(at)] != row[: len(at) - 1])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at)))
    # Long paths are cut, counted from their beginning.
    cuts = -(-length // PATH)
    part = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin = np.repeat(first, cuts) + part * PATH
    length = np.minimum(np.repeat(length, cuts) - part * PATH, PATH)
    # A path holds valid windows only up to the last that lies inside its row.
    ends = w.offsets[1:][row[begin]]
    length = np.minimum(length, ends - window + 1 - begin)
    keep = length > 0
    begin, length = begin[keep], length[keep]
    stop = begin + length + window - 1
    one = span_hashes(w.hashes, begin, stop)
    two = span_hashes(w.hashes, begin, stop, SECOND_BASE)
    return row[begin], begin - w.offsets[row[begin]], length, least[begin], one, two


def paths(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, minimizer: int = MINIMIZER) -> DataFrame:
    """The paths of all documents with an id: (doc, at, n, m, h1, h2)."""
    source = docs.where(F.col(doc_id).isNotNull() & (F.length(text) >= 2 * window - 1)).select(F.col(doc_id).cast("long"), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for piece in pieces(batch.column(1)):
                row, at, n, least, one, two = _paths(words(piece), window, minimizer)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[piece.first + row]), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), *map(long_array, (least, one, two))],
                    names=["doc", "at", "n", "m", "h1", "h2"],
                )

    return source.mapInArrow(run, "doc long, at int, n int, m long, h1 long, h2 long")


def minimizers(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, minimizer: int = MINIMIZER) -> DataFrame:
    """The minimizers of all documents with an id: (doc, m), once per document."""
    source = docs.where(F.col(doc_id).isNotNull() & (F.length(text) >= 2 * window - 1)).select(F.col(doc_id).cast("long"), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for piece in pieces(batch.column(1)):
                row, _, _, least, _, _ = _paths(words(piece), window, minimizer)
                order = np.lexsort((row, least))
                row, least = row[order], least[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (least[1:] != least[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[piece.first + row[new]]), long_array(least[new])], names=["doc", "m"]
                )

    return source.mapInArrow(run, "doc long, m long")


def _edges(branching: DataFrame, docs: DataFrame, doc_id: str, text: str, window: int) -> DataFrame:
    """The edges (h1, h2, k, e1, e2, first) of distinct paths, read from the documents that have them."""
    asked = branching.groupBy("doc").agg(F.collect_list(F.struct("at", "n", "h1", "h2")).alias("asked"))
    source = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc"), text)
    rows = source.join(asked, "doc").select(text, "asked", "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            for piece in pieces(batch.column(0)):
                w = words(piece)
                own = lists.slice(piece.first, len(piece))
                flat = own.flatten()
                if not len(flat):
                    continue
                row = np.repeat(np.arange(len(piece)), np.diff(own.offsets.to_numpy()))
                at, n, h1, h2 = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                first = batch.column(2).to_numpy(zero_copy_only=False)[piece.first + row]
                begin = w.offsets[row] + at
                stop = begin + n + window - 1
                fits = stop <= w.offsets[row + 1]
                # Of rows with one id, only the text that has the path counts.
                begin, n, stop = begin[fits], n[fits], stop[fits]
                same = span_hashes(w.hashes, begin, stop).view(np.int64) == h1[fits]
                keep = np.flatnonzero(fits)[same]
                begin, n = begin[same], n[same]
                which = np.repeat(np.arange(len(keep)), n)
                k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                edge = begin[which] + k
                take = keep[which]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h1[take]),
                        pa.array(h2[take]),
                        pa.array(k.astype(np.int32)),
                        long_array(span_hashes(w.hashes, edge, edge + window)),
                        long_array(span_hashes(w.hashes, edge, edge + window, SECOND_BASE)),
                        pa.array(first[take]),
                    ],
                    names=["h1", "h2", "k", "e1", "e2", "first"],
                )

    return rows.mapInArrow(run, "h1 long, h2 long, k int, e1 long, e2 long, first long")


def removals(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Runs of words to remove: (doc, begin, end), of each document with any."""
    repeated = (
        minimizers(docs, doc_id=doc_id, text=text, window=window)
        .groupBy("m")
        .agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        .where("first < last")
        .select("m")
    )
    met = written(paths(docs, doc_id=doc_id, text=text, window=window).join(repeated, "m"), "met")
    # The distinct paths, each with its first document and a place there.
    distinct = written(
        met.groupBy("m", "h1", "h2", "n")
        .agg(F.min(F.struct("doc", "at")).alias("place"))
        .select("m", "h1", "h2", "n", F.col("place.doc").alias("first"), F.col("place.at").alias("at")),
        "distinct",
    )
    alone = distinct.groupBy("m").agg((F.count("*") == 1).alias("alone"))
    # Without a branch, all edges have the same first document. Where paths branch, each distinct
    # one is taken apart once, in its first document.
    branching = distinct.join(alone.where("not alone"), "m").select(F.col("first").alias("doc"), "at", "n", "h1", "h2")
    branching = written(branching, "branching")
    edges = written(_edges(branching, docs, doc_id, text, window), "edges")
    # Most edges lie on one distinct path only; the others' first document is the least of these.
    owners = (
        edges.groupBy("e1", "e2")
        .agg(F.min("first").alias("owner"), F.max("first").alias("last"))
        .where("owner < last")
        .select("e1", "e2", "owner")
    )
    earlier = edges.join(checked(owners, "owners"), ["e1", "e2"]).where("owner < first").select("h1", "h2", "first", "k")
    # A document after a path's first one loses the whole path. The first one itself loses the
    # edges that another path has in an earlier document.
    wholly = (
        met.join(distinct.select("m", "h1", "h2", "first"), ["m", "h1", "h2"])
        .where("doc > first")
        .select("doc", "at", (F.col("at") + F.col("n") + window - 1).alias("end"))
    )
    partly = (
        met.withColumnRenamed("doc", "first")
        .join(checked(earlier, "earlier"), ["h1", "h2", "first"])
        .select(F.col("first").alias("doc"), (F.col("at") + F.col("k")).alias("at"))
        .select("doc", "at", (F.col("at") + window).alias("end"))
    )
    # Runs that touch or overlap are one.
    order = Window.partitionBy("doc").orderBy("at", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        wholly.union(partly)
        .groupBy("doc", "at")
        .agg(F.max("end").alias("end"))
        .withColumn("new", (F.col("at") > F.coalesce(reach, F.lit(-1))).cast("int"))
        .withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc", "run")
        .agg(F.min("at").alias("begin"), F.max("end").alias("end"))
        .select("doc", "begin", "end")
    )


def dedup(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """The table with the kept words as texts, and ``n_words`` (before) and ``n_removed``."""
    columns = [c for c in docs.columns if c.lower() not in NEW]
    cut = written(removals(docs, doc_id=doc_id, text=text, window=window), "removals")
    few = cut.count() <= BROADCAST_ROWS
    runs = cut.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("_runs"))
    if few:
        runs = F.broadcast(runs)
    source = docs.select(*columns).join(runs, F.col(doc_id).cast("long") == F.col("doc"), "left").drop("doc")
    none = F.array().cast("array<struct<begin:int,end:int>>")
    source = source.withColumn("_runs", F.coalesce("_runs", none))
    schema = T.StructType([*docs.select(*columns).schema.fields, *[T.StructField(c, T.LongType(), False) for c in NEW]])
    text_at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_runs = batch.column(batch.num_columns - 1)
            for piece in pieces(batch.column(text_at)):
                w = words(piece)
                own = all_runs.slice(piece.first, len(piece))
                flat = own.flatten()
                row = np.repeat(np.arange(len(piece)), np.diff(own.offsets.to_numpy()))
                begin = flat.field(0).to_numpy(zero_copy_only=False)
                end = flat.field(1).to_numpy(zero_copy_only=False)
                # Of rows with one id, a shorter text may not have the place; it loses what it has.
                begin = np.minimum(w.offsets[row] + begin, w.offsets[row + 1])
                end = np.minimum(w.offsets[row] + end, w.offsets[row + 1])
                depth = np.bincount(begin, minlength=len(w.hashes) + 1) - np.bincount(end, minlength=len(w.hashes) + 1)
                keep = np.cumsum(depth)[:-1] == 0
                kept_row = np.repeat(np.arange(len(piece)), w.counts)[keep]
                n_kept = np.bincount(kept_row, minlength=len(piece))
                texts = _joined(piece.data, piece.offsets, w.starts[keep], w.ends[keep], kept_row)
                columns_now = batch.slice(piece.first, len(piece)).columns[:-1]
                nulls = columns_now[text_at].is_null()
                columns_now[text_at] = pc.if_else(nulls, pa.scalar(None, texts.type), texts)
                yield pa.RecordBatch.from_arrays(
                    [*columns_now, pa.array(w.counts.astype(np.int64)), pa.array((w.counts - n_kept).astype(np.int64))],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)


def _joined(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray) -> pa.Array:
    """The given words of each row, joined by one space: each is copied with one separator after it."""
    stops = np.minimum(ends + 1, offsets[1:][row])
    change = np.zeros(len(data) + 1, np.int8)
    change[starts] += 1
    change[stops] -= 1
    copied = np.cumsum(change[:-1], dtype=np.int8) > 0
    even = np.where(SPACES[data], np.uint8(0x20), data)
    # The separator after the last word of a row goes.
    last = np.flatnonzero(np.diff(row, append=-1))
    over = np.zeros(len(offsets) - 1, bool)
    over[row[last]] = stops[last] > ends[last]
    texts = []
    for a, b, cut in zip(offsets.tolist(), offsets[1:].tolist(), over.tolist()):
        text = even[a:b][copied[a:b]]
        texts.append(text[: len(text) - cut].tobytes().decode())
    return pa.array(texts, pa.string())


def dedup_oracle(size: int = WINDOW) -> str:
    """DuckDB SQL for n_words, n_removed and the kept text by doc_id, for ids that are unique and not null."""
    return f"""
    doc_words AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    windows AS (
        SELECT doc_id, s, array_to_string(list_slice(w, s, s + {size} - 1), ' ') AS win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {size} + 2)) AS s FROM doc_words)),
    again AS (
        SELECT doc_id, s FROM windows JOIN (SELECT win, min(doc_id) AS least FROM windows GROUP BY win) USING (win)
        WHERE least < doc_id),
    removed AS (SELECT DISTINCT doc_id, unnest(range(s, s + {size})) AS place FROM again),
    places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM doc_words),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
        FROM places ANTI JOIN removed USING (doc_id, place) GROUP BY doc_id),
    deduped AS (
        SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(k.n, 0) AS n_removed, coalesce(k.text, '') AS text
        FROM doc_words d LEFT JOIN kept k USING (doc_id))"""
