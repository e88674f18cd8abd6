"""Vectors as short codes: a product quantizer learned by Lloyd's rounds over active entries.

Components become whole numbers, floor(scale * x), so that all arithmetic is exact. Each vector is cut into
equal parts, and each part position has a codebook that begins with that part of the
vectors of the smallest ids. A round gives every part the nearest entry of its codebook (ties to
the lower index) and then puts each entry at its parts' mean, rounded down; an entry without parts stays.

Each part keeps its entry and its exact distance from round to round. Where that entry stayed in its
place, the kept distance still holds and every other entry that stayed is no nearer than before, so the
part is compared with the moved entries only, by (distance, index); where it moved, all
entries are compared. Both give what comparing all would give.

Each round is one pass over a table in the shared folder that holds vectors and state, and one over its
result that adds up parts by entry, first in each task. Only codebooks and sums by entry go to the
driver, whose size follows from ``parts``, ``entries`` and the vectors' length. A round's table is
deleted when the next one has been written.

Defined results: rows whose vector is null or holds null or non-finite components are left out.
Repeated rows and ids stay rows of their own; of equal ids the vector that is smaller comes first in
the codebooks, null ids come last. Fewer rows than entries make smaller codebooks. A null
label is a label. An empty table gives no rows. Vectors must have one length, divisible by ``parts``,
and components of which squared distances fit 64 bits after scaling; else a ValueError says so. Other
columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.tables import checked, dropped
from pulseboard.sources.scratch import new_folder

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Rows that are handled at once.
ROWS = 1 << 14

STATE = "id long, label {label}, vector binary, code binary, distance binary, error long"


@dataclass(frozen=True)
class Codes:
    """``rows`` has (id, label, code, error): a byte per part, and the squared distances' sum;
    ``codebooks`` the entries (part, entry, component)."""

    rows: DataFrame
    codebooks: np.ndarray

    @property
    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def nearest(
    parts: np.ndarray,
    books: np.ndarray,
    moved: np.ndarray | None = None,
    code: np.ndarray | None = None,
    distance: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry, for each row and part.

    ``parts`` is (row, part, component), ``books`` (part, entry, component). With ``moved`` (part,
    entry), ``code`` and ``distance`` are what the parts had before these entries moved.
    """
    n, n_parts = parts.shape[:2]
    fresh = code is None
    out = np.zeros((n, n_parts), np.uint8) if fresh else code.copy()
    least = np.zeros((n, n_parts), np.int64) if fresh else distance.copy()
    for part in range(n_parts):
        own, book = np.ascontiguousarray(parts[:, part]), books[part]
        everywhere = np.ones(n, bool) if fresh else moved[part][out[:, part]]
        rows = np.flatnonzero(everywhere)
        if len(rows):
            best, index = _scanned(own[rows], book, range(len(book)))
            least[rows, part], out[rows, part] = best, index
        active = [] if fresh else np.flatnonzero(moved[part]).tolist()
        rows = np.flatnonzero(~everywhere)
        if active and len(rows):
            best, index = _scanned(own[rows], book, active)
            kept, at = least[rows, part], out[rows, part]
            wins = (best < kept) | ((best == kept) & (index < at))
            least[rows, part] = np.where(wins, best, kept)
            out[rows, part] = np.where(wins, index, at)
    return out, least


def _scanned(own: np.ndarray, book: np.ndarray, entries) -> tuple[np.ndarray, np.ndarray]:
    """The smallest distance to some entries, in the order of their indexes, and the entry's index."""
    best, index = None, None
    for entry in entries:
        apart = own - book[entry]
        squares = np.einsum("ij,ij->i", apart, apart)
        if best is None:
            best, index = squares, np.full(len(own), entry, np.uint8)
        else:
            nearer = squares < best
            best[nearer] = squares[nearer]
            index[nearer] = entry
    return best, index


def _numbers(column: pa.Array, dtype, width: int) -> np.ndarray:
    """A binary column of equally long values as rows of numbers."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype).reshape(len(column), width)


def _texts(rows: np.ndarray) -> pa.Array:
    """Rows of numbers as a binary column."""
    size = rows.shape[1] * rows.itemsize
    data = np.ascontiguousarray(rows).tobytes()
    return pa.array([data[i : i + size] for i in range(0, size * len(rows), size)] if size else [b""] * len(rows), pa.binary())


def _whole(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: float) -> DataFrame:
    """(id, label, vector): the rows that take part, their components as whole 64-bit numbers."""
    finite = F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    given = vectors.where(finite).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    kind = given.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            lengths = np.diff(column.offsets.to_numpy())
            if not len(lengths):
                continue
            if (lengths != lengths[0]).any():
                raise ValueError("the vectors are not of one length")
            numbers = np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale)
            if 4 * len(numbers) / len(column) * np.abs(numbers).max(initial=0) ** 2 >= 2.0**62:
                raise ValueError(f"components times {scale} are too large for exact distances")
            rows = numbers.astype(np.int64).reshape(len(column), int(lengths[0])).astype("<i4")
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], _texts(rows)], names=["id", "label", "vector"])

    return given.mapInArrow(run, f"id long, label {kind}, vector binary")


def _pass(table: DataFrame, width: int, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """The rows with the nearest entries as of ``books``; before, they have those from before the
    entries in ``moved`` moved, or without ``moved`` none."""
    parts = len(books)
    columns = ["id", "label", "vector", "code", "distance", "error"]
    kind = table.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                own = _numbers(batch.column(2), "<i4", width).astype(np.int64)
                own = own.reshape(len(own), parts, width // parts)
                before = ()
                if moved is not None:
                    before = moved, _numbers(batch.column(3), np.uint8, parts), _numbers(batch.column(4), "<i8", parts)
                code, distance = nearest(own, books, *before)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], _texts(code), _texts(distance.astype("<i8")), pa.array(distance.sum(1))],
                    names=columns,
                )

    return table.mapInArrow(run, STATE.format(label=kind))


def _sums(state: DataFrame, width: int, parts: int, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """How many parts each entry has, and their components' sums: (part, entry), (part, entry, component)."""
    each = width // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(parts * entries, np.int64)
        total = np.zeros((parts * entries, each), np.int64)
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                own = _numbers(batch.column(0), "<i4", width).astype(np.int64).reshape(-1, each)
                at = (_numbers(batch.column(1), np.uint8, parts) + np.arange(parts) * entries).ravel()
                order = np.argsort(at, kind="stable")
                different, begins = np.unique(at[order], return_index=True)
                count += np.bincount(at, minlength=len(count))
                if each:
                    total[different] += np.add.reduceat(own[order], begins, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(parts * entries)), pa.array(count), pa.array(list(total), pa.list_(pa.int64()))],
            names=["at", "n", "total"],
        )

    partial = state.select("vector", "code").mapInArrow(run, "at long, n long, total array<long>").where("n > 0")
    added = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(each)]
    count, total = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, each), np.int64)
    for row in partial.groupBy("at").agg(F.sum("n").alias("n"), *added).collect():
        count[row[0]], total[row[0]] = row[1], row[2:]
    return count.reshape(parts, entries), total.reshape(parts, entries, each)


def compress(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: float = SCALE,
) -> Codes:
    """Learn codebooks from all vectors, and code these by them."""
    spark = vectors.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("a code of one byte has 1 to 256 entries")
    path = new_folder(spark, "vectors")
    _whole(vectors, vec_id, vector, label, scale).write.parquet(path)
    state = spark.read.parquet(path)
    widths = sorted(r[0] for r in state.groupBy(F.octet_length("vector") / 4).count().limit(2).collect())
    if len(widths) > 1 or widths and int(widths[0]) % parts:
        raise ValueError(f"the vectors are not of one length that {parts} divides")
    width = int(widths[0]) if widths else 0
    first = state.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    first = np.array([np.frombuffer(r.vector, "<i4") for r in first], np.int64).reshape(len(first), parts, width // parts)
    books = np.ascontiguousarray(first.transpose(1, 0, 2))
    moved = None
    for _ in range(rounds if len(first) else 0):
        after = new_folder(spark, "codes")
        _pass(state, width, books, moved).write.parquet(after)
        dropped(spark, path)
        path, state = after, spark.read.parquet(after)
        count, total = _sums(state, width, parts, len(first))
        means = np.where(count[..., None] > 0, total // np.maximum(count, 1)[..., None], books)
        moved = (means != books).any(-1)
        books = means
    return Codes(_pass(state, width, books, moved).select("id", "label", "code", "error"), books)


def label_errors(rows: DataFrame) -> DataFrame:
    """The rows with ``label_error``: the errors' sum over all rows of an equal label."""
    sums = checked(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    sums = sums.withColumnRenamed("label", "_label")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def compress_oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """``coded`` (id, label, part, place, entry, distance) and ``b{rounds}`` (part, entry, d, x), as SQL for DuckDB."""
    steps = [
        f"""given AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id) AS place, vec_id AS id, label, embedding AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    cells AS MATERIALIZED (
        SELECT place, id, label, CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) AS x, (i - 1) // (n // {parts}) AS part, (i - 1) % (n // {parts}) AS d
        FROM (SELECT place, id, label, len(v) AS n, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM given)),
    b0 AS MATERIALIZED (SELECT part, place - 1 AS entry, d, x FROM cells WHERE place <= {entries})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""n{i} AS MATERIALIZED (
        SELECT place, part, min(distance * {entries} + entry) AS best FROM (
            SELECT c.place, c.part, b.entry, CAST(sum((c.x - b.x) * (c.x - b.x)) AS BIGINT) AS distance
            FROM cells c JOIN b{i} b ON b.part = c.part AND b.d = c.d GROUP BY ALL) GROUP BY ALL)"""
        )
        if i < rounds:
            steps.append(
                f"""m{i} AS MATERIALIZED (
        SELECT c.part, n.best % {entries} AS entry, c.d, CAST(sum(c.x) AS BIGINT) AS s, count(*) AS k
        FROM cells c JOIN n{i} n ON n.place = c.place AND n.part = c.part GROUP BY ALL),
    b{i + 1} AS MATERIALIZED (
        SELECT b.part, b.entry, b.d, CAST(CASE WHEN k IS NULL THEN b.x ELSE (s - ((s % k) + k) % k) // k END AS BIGINT) AS x
        FROM b{i} b LEFT JOIN m{i} m ON m.part = b.part AND m.entry = b.entry AND m.d = b.d)"""
            )
    steps.append(
        f"""coded AS (
        SELECT g.place, g.id, g.label, n.part, n.best % {entries} AS entry, n.best // {entries} AS distance
        FROM given g JOIN n{rounds} n ON n.place = g.place)"""
    )
    return ",\n    ".join(steps)
