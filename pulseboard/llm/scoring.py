"""Log probabilities of texts under a log-bilinear model, and under word frequencies.

Texts become tokens: words with only A-Z lower-cased, and one end. All training texts' tokens are counted, one
partial sum per task and token, and none is left out. The COMMON most frequent tokens (fewer, where
counts tie) go to all tasks as a table; what a text has besides is looked up by a join, so that the
vocabulary may outgrow any machine, while no frequent token is ever shuffled row by row.

The neural model (:mod:`bilinear`) predicts units: the WORDS most frequent tokens and, for all others,
CLASSES classes by a checksum of their last three bytes. Within its class a token has the share (c + 1) /
(all its class's c + 1, and 1 for a token not known), so that the probabilities of all tokens add up to one.
``fit`` trains on every training text: in each of ROUNDS rounds all tasks start from the same parameters, learn
from their share of the texts, and Spark averages what they have learned, weighted by tokens, in
two steps. Parameters, whose size does not depend on the texts, are all that goes to the driver.

Defined results: null texts count as empty and have one token, the end. Repeated rows and ids are rows
of their own, and each counts where it is trained on. Without training texts all units are equally likely
and every count is 0. Tokens of equal counts are ordered by their bytes. An empty table gives no rows. Columns
that have the name of a new one are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.llm import bilinear
from pulseboard.llm.texts import pieces
from pulseboard.sources.scratch import written

END = b""
WORDS = 1024
CLASSES = 256
COMMON = 1 << 18
ROUNDS = 4
# Different tokens that a task holds before it hands their counts on.
HELD = 250_000
# Bytes of units that a task scores at once.
SLICE = 1 << 19
# Parameters of one row, when they are averaged; and rows that are averaged at once in a first step.
BLOCK = 1 << 14
GROUPS = 64
NEW = ("n_tokens", "n_known", "train_tokens", "base_score", "score")

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, and the end."""
    found = text.translate(LOWER).split()
    found.append(END)
    return found


def _class_of(token: bytes) -> int:
    return crc32(token[-3:]) % CLASSES


def _texts(column: pa.Array) -> Iterator[bytes]:
    for piece in pieces(column):
        for begin, end in zip(piece.offsets[:-1], piece.offsets[1:], strict=True):
            yield piece.data[begin:end].tobytes()


def counts(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """(token, n): how often each token is in all texts."""

    def told(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["token", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for one in _texts(batch.column(0)):
                held.update(tokens(one))
                if len(held) > HELD:
                    yield told(held)
                    held = Counter()
        yield told(held)

    given = docs.select(F.col(text).alias("text"))
    return given.mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """``places`` has the common tokens' places in ``times`` (their counts) and ``units``; ``classes`` the sums
    over each class of its tokens' counts plus one; ``least`` the smallest common count."""

    places: dict[bytes, int]
    times: np.ndarray
    units: np.ndarray
    classes: np.ndarray
    least: int
    total: int
    different: int


@dataclass(frozen=True)
class Model:
    """``counted`` has the counts of all tokens, the rest what tasks need at hand."""

    vocabulary: Vocabulary
    counted: DataFrame
    parameters: bilinear.Parameters


def _least_common(counted: DataFrame, common: int) -> int:
    """The smallest count of which at most ``common`` tokens have as many or more, in steps of some
    9 percent; so few sums go to the driver."""
    steps = counted.groupBy(F.floor(F.log2(F.col("n").cast("double")) * 8).alias("step")).agg(
        F.count("*").alias("tokens"), F.min("n").alias("least")
    )
    some, least = 0, None
    for row in sorted(steps.collect(), key=lambda r: -r.step):
        some += row.tokens
        if some > common:
            break
        least = row.least
    return 1 + (counted.agg(F.max("n")).first()[0] or 0) if least is None else least


def _vocabulary(counted: DataFrame, words: int, common: int) -> Vocabulary:
    least = _least_common(counted, common)
    sums = counted.agg(F.sum("n"), F.count("*")).first()
    rows = counted.where(F.col("n") >= least).collect()
    rows = sorted(((bytes(r.token), r.n) for r in rows), key=lambda r: (r[0] != END, -r[1], r[0]))
    units = [i if i < words else words + _class_of(token) for i, (token, _) in enumerate(rows)]
    spoken = {token for token, _ in rows[:words]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for token, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if token not in spoken:
                    out[_class_of(token)] += n + 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(out)], names=["class", "n"])

    classes = np.ones(CLASSES, np.int64)
    for row in counted.mapInArrow(run, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        classes[row[0]] += row.n
    return Vocabulary(
        {token: i for i, (token, _) in enumerate(rows)},
        np.array([n for _, n in rows], np.int64),
        np.array(units, np.int64),
        classes,
        least,
        sums[0] or 0,
        sums[1],
    )


def _coded(docs: DataFrame, shared: Broadcast, words: int, text: str) -> DataFrame:
    """The columns but the text, and of each text: ``n`` tokens, how many are ``known`` and the sums of their
    log10(c + 1) and of their logarithms within their classes, as far as the common tokens go; ``units``; and the ``rest``,
    different tokens with the ``times`` that they occur."""
    kept = [c for c in docs.columns if c != text]
    new = T.StructType.fromDDL(
        "_n long, _known long, _logs double, _spread double, _units binary, _rest array<binary>, _times array<long>"
    )
    source = docs.select(*kept, F.col(text).alias("_text"))
    schema = T.StructType([*docs.select(*kept).schema.fields, *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        get = vocabulary.places.get
        logs = np.append(np.log10(vocabulary.times + 1.0), 0.0)
        classes = np.log10(vocabulary.classes.astype(float))
        units = np.append(vocabulary.units, 0)
        for batch in batches:
            for piece in pieces(batch.column(batch.num_columns - 1)):
                out: list[list] = [[] for _ in new.fields]
                for begin, end in zip(piece.offsets[:-1], piece.offsets[1:], strict=True):
                    found = tokens(piece.data[begin:end].tobytes())
                    at = np.fromiter((get(t, -1) for t in found), np.int64, len(found))
                    own, log = units[at], logs[at]
                    lacking = np.flatnonzero(at < 0)
                    rest = Counter()
                    if len(lacking):
                        others = [found[i] for i in lacking.tolist()]
                        own[lacking] = [words + _class_of(t) for t in others]
                        rest = Counter(others)
                    classed = own >= words
                    values = (
                        len(found),
                        len(found) - len(lacking),
                        log.sum(),
                        log[classed].sum() - classes[own[classed] - words].sum(),
                        own.astype("<u2").tobytes(),
                        list(rest),
                        list(rest.values()),
                    )
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                columns = [pa.array(column, kind) for column, kind in zip(out, KINDS, strict=True)]
                kept_columns = batch.slice(piece.first, len(piece)).columns[:-1]
                yield pa.RecordBatch.from_arrays([*kept_columns, *columns], names=schema.names)

    return source.mapInArrow(run, schema)


KINDS = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of some SLICE bytes of units, its last column; a longer row alone."""
    sizes = [len(r.as_py()) for r in batch.column(batch.num_columns - 1)]
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > SLICE:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += size
    if sizes:
        yield batch.slice(first)


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The units of all rows, and where each row begins."""
    rows = column.to_pylist()
    offsets = np.concatenate([[0], np.cumsum([len(r) // 2 for r in rows])]).astype(np.int64)
    return np.frombuffer(b"".join(rows), "<u2").astype(np.int64), offsets


def _frequency(coded: DataFrame, units: int) -> np.ndarray:
    """The units' shares of all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(units, np.int64)
        for batch in batches:
            for part in _slices(batch):
                out += np.bincount(_joined(part.column(0))[0], minlength=units)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(units)), pa.array(out)], names=["unit", "n"])

    out = np.ones(units)
    for row in coded.select("_units").mapInArrow(run, "unit long, n long").groupBy("unit").agg(F.sum("n").alias("n")).collect():
        out[row.unit] += row.n
    return out / out.sum()


def _averaged(parts: DataFrame) -> DataFrame:
    """(block, weight, values) of each block, from those of many tasks."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        weights = rows.column("weight").to_numpy()
        values = np.stack([np.frombuffer(v, "<f4") for v in rows.column("values").to_pylist()])
        mean = (weights / weights.sum()) @ values.astype(np.float64)
        return pa.table(
            {"block": [key[0].as_py()], "weight": [float(weights.sum())], "values": pa.array([mean.astype("<f4").tobytes()], pa.binary())}
        )

    schema = "block long, weight double, values binary"
    some = parts.groupBy("block", F.expr(f"int(pmod(task, {GROUPS}))").alias("group")).applyInArrow(run, schema)
    return some.groupBy("block").applyInArrow(run, schema)


def _round(coded: DataFrame, start: bilinear.Parameters, frequency: np.ndarray, number: int) -> bilinear.Parameters:
    """The mean of what all tasks learn from their texts."""
    shared = coded.sparkSession.sparkContext.broadcast((start, frequency))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        start, frequency = shared.value
        own, weight = start.copy(), 0
        task = TaskContext.get().partitionId()
        rng = np.random.default_rng([number, task])
        held: list[bytes] = []
        size = 0

        def learn() -> int:
            units, offsets = _joined(pa.array(held, pa.binary()))
            bilinear.train(own, units, offsets, frequency, rng)
            return len(units)

        for batch in batches:
            for row in batch.column(0).to_pylist():
                held.append(row)
                size += len(row) // 2
                if size >= bilinear.SHUFFLED:
                    weight += learn()
                    held, size = [], 0
        if held:
            weight += learn()
        if weight:
            flat = np.concatenate([own.flat, own.seen]).astype("<f4")
            blocks = [flat[i : i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([task] * len(blocks), pa.int64()),
                    pa.array(range(len(blocks)), pa.int64()),
                    pa.array([float(weight)] * len(blocks)),
                    pa.array(blocks, pa.binary()),
                ],
                names=["task", "block", "weight", "values"],
            )

    parts = coded.select("_units").mapInArrow(run, "task long, block long, weight double, values binary")
    found = sorted(_averaged(parts).collect(), key=lambda r: r.block)
    if not found:
        return start
    flat = np.frombuffer(b"".join(bytes(r["values"]) for r in found), "<f4")
    cut = len(start.flat)
    return bilinear.Parameters(start.units, start.size, flat[:cut].copy(), flat[cut:].copy())


def _with_lookup(coded: DataFrame, counted: DataFrame, least: int) -> DataFrame:
    """Adds (_found, _more) to each row: how many of its ``rest`` are known, and their log10(c + 1)."""
    rest = coded.where(F.size("_rest") > 0).select("_row", F.inline(F.arrays_zip("_rest", "_times")))
    found = (
        rest.join(counted.where(F.col("n") < least).withColumnRenamed("token", "_rest"), "_rest")
        .groupBy("_row")
        .agg(F.sum("_times").alias("_found"), F.sum(F.col("_times") * F.log10(F.col("n") + F.lit(1.0))).alias("_more"))
    )
    return coded.drop("_rest", "_times").join(found, "_row", "left").fillna({"_found": 0, "_more": 0.0})


def score(
    docs: DataFrame,
    learned: Column,
    *,
    text: str = "text",
    keep_text: bool = False,
    words: int = WORDS,
    common: int = COMMON,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Trains on the rows where ``learned`` holds and scores all rows.

    The table's columns (the text only with ``keep_text``) and ``n_tokens``; ``n_known``, the tokens that
    training texts have; ``train_tokens``, the tokens of all these; ``base_score``, the sum of
    log10((c + 1) / (all c + different tokens + 1)); and ``score``, the model's log10 probability.
    """
    spark = docs.sparkSession
    units = words + CLASSES
    if units >= 1 << 16:
        raise ValueError("units have 16 bits")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in NEW or c == text])
    kept = [c for c in docs.columns if c != text or keep_text]
    counted = written(counts(docs.where(learned), text=text), "tokens")
    vocabulary = _vocabulary(counted, words, common)
    shared = spark.sparkContext.broadcast(vocabulary)
    marked = docs.withColumns({"_learned": learned, **({"_kept": F.col(text)} if keep_text else {})})
    coded = written(
        _coded(marked, shared, words, text).withColumn("_row", F.monotonically_increasing_id()), "units"
    )
    trained = coded.where("_learned")
    frequency = _frequency(trained, units)
    parameters = bilinear.initial(frequency)
    for number in range(rounds):
        part = trained.where(F.expr(f"pmod(xxhash64(_row), {rounds}) = {number}"))
        parameters = _round(part, parameters, frequency, number)
    scored = _scored(coded, parameters)
    looked_up = _with_lookup(scored, counted, vocabulary.least)
    least = float(np.log10(vocabulary.total + vocabulary.different + 1))
    logs = F.col("_logs") + F.col("_more")
    return looked_up.select(
        *[F.col("_kept").alias(text) if c == text else F.col(c) for c in kept],
        F.col("_n").alias("n_tokens"),
        (F.col("_known") + F.col("_found")).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (logs - F.col("_n") * F.lit(least)).alias("base_score"),
        (F.col("_neural") + F.col("_spread") + F.col("_more")).alias("score"),
    )


def _scored(coded: DataFrame, parameters: bilinear.Parameters) -> DataFrame:
    """The rows with ``_neural``, the log10 probability of their units, without these."""
    shared = coded.sparkSession.sparkContext.broadcast(parameters)
    kept = [c for c in coded.columns if c != "_units"]
    schema = T.StructType([*coded.select(*kept).schema.fields, T.StructField("_neural", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = bilinear.Scorer(shared.value)
        for batch in batches:
            for part in _slices(batch):
                units, offsets = _joined(part.column(part.num_columns - 1))
                logs = scorer.logs(units, offsets) / np.log(10)
                # Every row has an end at least.
                sums = np.add.reduceat(logs, offsets[:-1])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(sums)], names=schema.names)

    return coded.select(*kept, "_units").mapInArrow(run, schema)
