"""Quality of documents by a linear-chain conditional random field over their lines.

Each line is good or bad. A line is described by what it and the lines before and after it look
like (length, shares of kinds of characters, repeated words, repeated lines), each as one of a
few bins; the field adds a weight per bin and a weight per pair of neighbouring labels. The
marginals of all lines, from one pass forward and one backward, are averaged by the lines'
lengths into the score of the document.

``fit`` learns from documents with a label (each line has the label of its document). It takes at
most ``max_docs`` labelled documents, chosen by a hash of their ids, and cuts their lines into
runs, of which at most ``max_lines`` lines in all go into the fit; both are parameters of the
model, not of the scoring. ``score`` reads every line of every text and needs no shuffle.

Defined results: a null or empty text is one empty line and gets a score like any other; rows are
scored one by one, so repeated rows and ties get equal scores; an empty table gives an empty
table; a column that has the name of a new one is replaced. Without any labelled document, or with
labels of one kind only, there is nothing to learn: every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.llm.texts import Piece, pieces, rows_of, words

MAX_DOCS = 6000
MAX_LINES = 120_000
RUN = 64
# Lines of a text that are taken up at once, some runs.
LONG = 1 << 12
STEPS = 60

BINS = 10
SHARES = np.array([0.001, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 0.95])
SIZES = np.array([1, 4, 10, 25, 50, 100, 200, 500, 2000])
WORD_LENGTHS = np.array([1.5, 2.5, 3.5, 4.5, 5.5, 7, 9, 12, 20])
FEATURES = 13

LOWER, UPPER, DIGIT, SPACE, POINT, SYMBOL, OTHER, TAIL = range(8)
KIND = np.full(256, SYMBOL, np.uint8)
KIND[ord("a") : ord("z") + 1] = LOWER
KIND[ord("A") : ord("Z") + 1] = UPPER
KIND[ord("0") : ord("9") + 1] = DIGIT
KIND[[0x20, *range(0x09, 0x0E)]] = SPACE
KIND[[ord(c) for c in ".,;:'\"!?()-"]] = POINT
KIND[0xC0:] = OTHER  # a character beyond ASCII; its other bytes don't count
KIND[0x80:0xC0] = TAIL


@dataclass(frozen=True)
class Model:
    """Weights of bins for the label good; log potentials of neighbouring labels [before, after]."""

    weights: np.ndarray
    pairs: np.ndarray


def line_bins(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bins of each line, the lines' characters, and the first line of each row."""
    data = piece.data
    breaks = np.flatnonzero(data == 0x0A)
    per_row = np.diff(np.searchsorted(breaks, piece.offsets)) + 1
    offsets = np.concatenate([[0], np.cumsum(per_row)])
    n = int(offsets[-1])
    starts, ends = np.zeros(n, np.int64), np.zeros(n, np.int64)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[offsets[:-1]] = True
    last[offsets[1:] - 1] = True
    starts[first], starts[~first] = piece.offsets[:-1], breaks + 1
    ends[last], ends[~last] = piece.offsets[1:], breaks

    kinds = KIND[data]
    counts = np.empty((8, n))
    for kind in range(8):
        total = np.concatenate([[0], np.cumsum(kinds == kind, dtype=np.int64)])
        counts[kind] = total[ends] - total[starts]
    chars = counts[:TAIL].sum(0)
    letters = counts[LOWER] + counts[UPPER] + counts[OTHER]

    w = words(piece)
    bounds = np.searchsorted(w.starts, starts), np.searchsorted(w.starts, ends)
    n_words = bounds[1] - bounds[0]
    same = np.zeros(len(w.starts) + 1, np.int64)
    same[2:] = np.cumsum(w.hashes[1:] == w.hashes[:-1]) if len(w.starts) else 0
    repeats = np.where(n_words > 1, same[bounds[1]] - same[np.minimum(bounds[0] + 1, len(same) - 1)], 0)
    # Words that end in a symbol, and words that hold no letter or digit at their end.
    odd = np.concatenate([[0], np.cumsum(KIND[data[w.ends - 1]] == SYMBOL)]) if len(w.ends) else np.zeros(1)
    odd_ends = odd[bounds[1]] - odd[bounds[0]]
    # Lines with equal words, wherever they stand in their document.
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hashes)])
    keys = (sums[bounds[1]] - sums[bounds[0]]) + rows_of(offsets).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.searchsorted(SHARES, part / np.maximum(whole, 1), "right")

    bins = np.empty((n, FEATURES), np.uint8)
    bins[:, 0] = np.searchsorted(SIZES, chars, "right")
    bins[:, 1] = np.searchsorted(SIZES, n_words, "right")
    bins[:, 2] = share(counts[UPPER], letters)
    bins[:, 3] = share(counts[SYMBOL], chars)
    bins[:, 4] = share(counts[DIGIT], chars)
    bins[:, 5] = share(counts[POINT], chars)
    bins[:, 6] = share(counts[SPACE], chars)
    bins[:, 7] = np.searchsorted(WORD_LENGTHS, chars / np.maximum(n_words, 1), "right")
    bins[:, 8] = share(repeats, n_words)
    bins[:, 9] = share(letters, chars)
    bins[:, 10] = np.minimum(times[back] - 1, BINS - 1)
    bins[:, 11] = share(odd_ends, n_words)
    tail = data[np.maximum(ends - 1, 0)] if len(data) else np.zeros(n, np.uint8)
    bins[:, 12] = np.where(ends > starts, KIND[tail], 8)
    return bins, chars, offsets


def _indexes(bins: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which weights each line adds: its own bins, and those of the lines before and after."""
    size = FEATURES * BINS
    own = np.arange(FEATURES) * BINS + bins
    at = np.full((len(bins), 3 * FEATURES), 3 * size, np.int64)  # the last weight is always zero
    at[:, :FEATURES] = own
    at[1:, FEATURES : 2 * FEATURES] = own[:-1] + size
    at[:-1, 2 * FEATURES :] = own[1:] + 2 * size
    at[offsets[:-1], FEATURES : 2 * FEATURES] = 3 * size
    at[offsets[1:] - 1, 2 * FEATURES :] = 3 * size
    return at


def _messages(odds: np.ndarray, offsets: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the lines before (with the line itself) and after say, as log odds of good.

    All chains go one line on at a time; the longest come first, so that those which have
    ended are cut off at the end.
    """
    order = np.argsort(-np.diff(offsets), kind="stable")
    begins, sizes = offsets[:-1][order], np.diff(offsets)[order]
    ahead, behind = odds.copy(), np.zeros_like(odds)

    def through(x: np.ndarray, p: np.ndarray) -> np.ndarray:
        return np.logaddexp(p[1, 1] + x, p[0, 1]) - np.logaddexp(p[1, 0] + x, p[0, 0])

    for step in range(1, int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -step, "left"))  # chains of more than ``step`` lines
        at = begins[:n] + step
        ahead[at] += through(ahead[at - 1], pairs)
        at = begins[:n] + sizes[:n] - 1 - step
        behind[at] = through(behind[at + 1] + odds[at + 1], pairs.T)
    return ahead, behind


def marginals(model: Model, bins: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The probability of good for each line."""
    if not len(bins):
        return np.zeros(0)
    odds = model.weights[_indexes(bins, offsets)].sum(1)
    ahead, behind = _messages(odds, offsets, model.pairs)
    return 1 / (1 + np.exp(-np.clip(ahead + behind, -500, 500)))


def _train(bins: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> Model:
    """Maximum likelihood with a small quadratic penalty, by Adam over all runs of lines."""
    size = 3 * FEATURES * BINS
    at = _indexes(bins, offsets)
    good = np.repeat(labels, np.diff(offsets)).astype(float)
    inner = np.ones(len(bins), bool)
    inner[offsets[:-1]] = False
    now = np.flatnonzero(inner)
    seen = np.array([[((1 - good[now]) * (1 - good[now - 1])).sum(), 0.0], [0.0, (good[now] * good[now - 1]).sum()]])
    theta, m, v = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    for step in range(1, STEPS + 1):
        weights, pairs = np.append(theta[:size], 0.0), theta[size:].reshape(2, 2)
        odds = weights[at].sum(1)
        ahead, behind = _messages(odds, offsets, pairs)
        p = 1 / (1 + np.exp(-np.clip(ahead + behind, -500, 500)))
        gradient = np.bincount(at.ravel(), np.repeat(good - p, at.shape[1]), size + 1)[:size]
        # The joint probability of two neighbours' labels.
        before, after = ahead[now - 1], (odds + behind)[now]
        joint = np.stack([np.zeros(len(now)) + pairs[0, 0], after + pairs[0, 1], before + pairs[1, 0], before + after + pairs[1, 1]])
        joint = np.exp(joint - joint.max(0)) if len(now) else joint
        joint = (joint / joint.sum(0)).sum(1).reshape(2, 2) if len(now) else np.zeros((2, 2))
        gradient = np.append(gradient, (seen - joint).ravel()) / len(bins) - 1e-5 * theta
        m = 0.9 * m + 0.1 * gradient
        v = 0.98 * v + 0.02 * gradient**2
        theta = theta + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-8)
    return Model(np.append(theta[:size], 0.0), theta[size:].reshape(2, 2))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_docs: int = MAX_DOCS,
    max_lines: int = MAX_LINES,
) -> Model:
    """Learn from the documents that ``labels`` marks 0 or 1."""
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("_id"))
        .agg(F.min(label).cast("double").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_docs)
    )
    texts = docs.join(F.broadcast(chosen), F.col(doc_id) == F.col("_id")).select(text, "_label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(0)):
                bins, _, offsets = line_bins(piece)
                # Texts of very many lines in parts, each of whole runs.
                cuts = [range(a, b, LONG) for a, b in zip(offsets, offsets[1:])]
                rows = [bins[i : min(i + LONG, b)].tobytes() for c, b in zip(cuts, offsets[1:]) for i in c]
                own = batch.column(1).slice(piece.first, len(piece))
                own = own.take(pa.array(np.repeat(np.arange(len(piece)), [len(c) for c in cuts])))
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), own], names=["bins", "label"])

    lines = texts.mapInArrow(run, "bins binary, label double")
    # Counted in the texts, so that no table is written on the side, of a file or two for each task.
    breaks = F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n")))
    total = texts.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1)).first()[0] or 0
    if total > 2 * max_lines:
        # Rows are those of whole texts or long ones' runs: by a hash, some twice as many lines as are needed.
        lines = lines.where(F.pmod(F.xxhash64("bins", "label"), F.lit(1 << 20)) < int((1 << 20) * 2 * max_lines / total))
    rows = sorted(lines.collect(), key=lambda r: (bytes(r.bins), r.label))
    if len({r.label for r in rows}) < 2:
        return Model(np.zeros(3 * FEATURES * BINS + 1), np.zeros((2, 2)))
    runs = [
        (b[i : i + RUN], r.label)
        for r in rows
        for b in [np.frombuffer(r.bins, np.uint8).reshape(-1, FEATURES)]
        for i in range(0, len(b), RUN)
    ]
    order = np.random.default_rng(0).permutation(len(runs))
    total = np.cumsum([len(runs[i][0]) for i in order])
    kept = [runs[i] for i in order[: max(1, int(np.searchsorted(total, max_lines, "right")))]]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b, _ in kept])])
    return _train(np.concatenate([b for b, _ in kept]), offsets, np.array([y for _, y in kept]))


def score(
    docs: DataFrame, model: Model, *, text: str = "text", output: str = "score", keep_text: bool = True
) -> DataFrame:
    """The table's columns and a score from 0 to 1, higher for better; ``bad_lines`` counts lines
    that are rather bad than good."""
    new = [T.StructField(output, T.DoubleType(), False), T.StructField("bad_lines", T.LongType(), False)]
    names = {f.name.lower() for f in new}
    kept = [c for c in docs.columns if c.lower() not in names and (keep_text or c != text)]
    # A text that stays goes to the workers once.
    source = docs.select(*kept) if text in kept else docs.select(*kept, F.col(text).alias("_scored"))
    at = source.columns.index(text if text in kept else "_scored")
    schema = T.StructType([*docs.select(*kept).schema.fields, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(at)):
                bins, chars, offsets = line_bins(piece)
                good, size = marginals(model, bins, offsets), chars + 1
                scores = np.add.reduceat(good * size, offsets[:-1]) / np.add.reduceat(size, offsets[:-1])
                bad = np.add.reduceat((good < 0.5).astype(np.int64), offsets[:-1])
                own = batch.slice(piece.first, len(piece)).columns[: len(kept)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(np.clip(scores, 0, 1)), pa.array(bad)], names=schema.names
                )

    return source.mapInArrow(run, schema)
