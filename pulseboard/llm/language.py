"""Language of documents by interpolated Kneser-Ney models of characters, one per language.

A text becomes a sequence of symbols: its letters, lower-cased, and one mark for each run of anything
else. ``fit`` counts all sequences of four symbols of all labelled texts, per language, with
partial sums in each task; Spark then derives how many different symbols come before and after
each shorter sequence, and by joins the probability of every sequence that a language has and the
weight of every context. None is left out, and none goes to the driver.

The models of all languages are stored together in the shared folder, sorted by length and packed
sequence, in files of at most ROWS_A_FILE rows. The model itself holds only which range of
sequences each file has; tasks read the files that their texts need, and keep up to CACHE_BYTES of
them. Scoring looks up the different sequences of some texts: where a language lacks one, the next
shorter counts, with the weight that the language gives to it. The language of the lowest
cross-entropy per symbol wins; of equals, the first by name. Sharpness of the scores, and the cross-entropy
per language beyond which a text is rejected as none of the languages, are calibrated on all different labelled
texts: tasks score them, and Spark adds up their losses and finds the exact quantile, of which only the
values of one or two narrow bins per language are put in order.

Defined results: null texts and texts without a letter get ``und`` with score 0; otherwise the
score, from 0 to 1, is the winner's share. Rows without a language are not learned from. Rows are
independent, so repeated rows and ties get equal results; an empty table gives an empty one; a
column that has the name of a new one is replaced. A model learned without any labelled letter knows no
language: every text is ``und``, with score 0.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.llm.texts import U64, Piece, opened, pieces
from pulseboard.sources.scratch import new_folder, written

ORDER = 4
# Counts that a task holds before it adds up equal ones.
HELD = 2_000_000
# Rows of a file of the stored model, and the bytes of such files that a task keeps.
ROWS_A_FILE = 1 << 18
CACHE_BYTES = 256 << 20
REJECTED = 0.999
# What the sharpness is chosen from, and how many bins a unit of cross-entropy has.
SHARPNESS = [2.0**p for p in range(-1, 9)]
BINS = 1000
UNKNOWN = "und"
NEW = ("lang_pred", "score", "entropy", "rejected")


@dataclass(frozen=True)
class Model:
    """The languages, the files of their sequences and contexts, and log probabilities of symbols
    that a language lacks.

    ``files`` has for each kind of table the files' first and last keys, in order, and their paths.
    Kinds 1 to ORDER are sequences of that length, with log probabilities; kind -k is contexts of
    length k, with logs of the weights of what is shorter.
    """

    languages: tuple[str, ...]
    files: dict[int, tuple[np.ndarray, np.ndarray, tuple[str, ...]]]
    unseen: np.ndarray
    sharpness: float = 1.0
    limits: np.ndarray | None = None


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its symbol of 16 bits; 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint16)
    code = np.array([c for c in range(0x110000) if chr(c).isalpha()], np.int64)
    out[code] = np.maximum((code ^ (code >> 16) * 0x9E37) & 0xFFFF, 1)
    return out


def symbols(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all rows, each row after a 0, and where the rows begin."""
    data = piece.data
    code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    bounds = np.searchsorted(leads, piece.offsets)
    all_symbols = _letters()[code]
    row = np.repeat(np.arange(len(piece)), np.diff(bounds))
    before = np.zeros(len(code), bool)
    before[1:] = (all_symbols[:-1] > 0) & (row[1:] == row[:-1])
    keep = (all_symbols > 0) | before
    kept, row = all_symbols[keep], row[keep]
    offsets = np.searchsorted(row, np.arange(len(piece) + 1)) + np.arange(len(piece) + 1)
    out = np.zeros(int(offsets[-1]), np.uint16)
    out[np.arange(len(kept)) + row + 1] = kept
    return out, offsets


def sequences(seq: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last ORDER symbols up to each place but the rows' first, packed; and the places' rows."""
    n = len(seq)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(n) - offsets[row]
    key = seq.astype(U64)
    for back in range(1, ORDER):
        shifted = np.zeros(n, U64)
        shifted[back:] = seq[:-back] if n > back else 0
        shifted[at < back] = 0
        key |= shifted << U64(16 * back)
    inner = at > 0
    return key[inner], row[inner]


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(back, np.concatenate(counts), len(key)).astype(np.int64)


def counts(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, key, n): how often each sequence of ORDER symbols is in the texts of a language."""
    source = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.lower(text), lang)

    def told(name: str, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(key), pa.string()), pa.array(key.view(np.int64)), pa.array(n)], names=["lang", "key", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        for batch in batches:
            for piece in pieces(batch.column(0)):
                key, row = sequences(*symbols(piece))
                own = batch.column(1).slice(piece.first, len(piece)).dictionary_encode()
                which = own.indices.to_numpy()[row]
                for i, name in enumerate(own.dictionary.to_pylist()):
                    found, times = np.unique(key[which == i], return_counts=True)
                    keys, numbers = held.setdefault(name, ([], []))
                    keys.append(found)
                    numbers.append(times)
                    if sum(map(len, keys)) > HELD:
                        one, two = _added(keys, numbers)
                        held[name] = [one], [two]
                        if len(one) > HELD // 2:
                            yield told(name, one, two)
                            del held[name]
        for name, (keys, numbers) in held.items():
            yield told(name, *_added(keys, numbers))

    return source.mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """Learn from all rows with a language."""
    levels = [written(counts(docs, text=text, lang=lang), "sequences")]
    for length in range(ORDER - 1, 0, -1):
        # A shorter sequence counts the different symbols before it.
        tail = F.col("key").bitwiseAND((1 << 16 * length) - 1).alias("key")
        levels.insert(0, written(levels[0].groupBy("lang", tail).agg(F.count("*").alias("n")), "sequences"))
    totals = [
        {
            r.lang: r
            for r in level.groupBy("lang")
            .agg(
                F.sum("n").alias("n"),
                F.count("*").alias("kinds"),
                F.count_if(F.col("n") == 1).alias("once"),
                F.count_if(F.col("n") == 2).alias("twice"),
            )
            .collect()
        }
        for level in levels
    ]
    languages = sorted(totals[0])
    if not languages:
        return Model((), {}, np.zeros(0), limits=np.zeros(0))
    discounts = [[_discount(t[x].once, t[x].twice) for x in languages] for t in totals]
    unseen = [d / t.n * t.kinds / (t.kinds + 1) for d, t in zip(discounts[0], (totals[0][x] for x in languages))]
    known = docs.sparkSession.createDataFrame(
        [
            (x, i, float(totals[0][x].n), unseen[i], [d[i] for d in discounts])
            for i, x in enumerate(languages)
        ],
        "lang string, at int, symbols double, unseen double, discounts array<double>",
    )
    files = _files(_stored(levels, F.broadcast(known)))
    return _calibrated(Model(tuple(languages), files, np.log(unseen)), docs, text, lang)


def _discount(once: int, twice: int) -> float:
    return min(max(once / (once + 2 * twice) if once else 0.5, 0.1), 0.95)


def _stored(levels: list[DataFrame], known: DataFrame) -> DataFrame:
    """(kind, key, at, value) of all sequences and contexts of all languages, in order in files."""
    spark = levels[0].sparkSession
    levels = [level.join(known, "lang") for level in levels]
    rest = lambda length: F.greatest(F.col("n") - F.col("discounts")[length - 1], F.lit(0.0))
    shorter = levels[0].select("key", "at", (rest(1) / F.col("symbols") + F.col("unseen")).alias("p"))
    tables = [shorter.select(F.lit(1).alias("kind"), "key", "at", F.log("p").alias("value"))]
    for length in range(2, ORDER + 1):
        context = F.shiftrightunsigned("key", 16).alias("context")
        own = levels[length - 1].select("key", "at", context, rest(length).alias("rest"), "n", "discounts")
        around = written(
            own.groupBy("context", "at").agg(
                F.sum("n").alias("mass"),
                (F.first(F.col("discounts")[length - 1]) * F.count("*") / F.sum("n")).alias("gamma"),
            ),
            "contexts",
        )
        tail = F.col("key").bitwiseAND((1 << 16 * (length - 1)) - 1)
        shorter = written(
            own.select("key", "at", "context", "rest", tail.alias("tail"))
            .join(around, ["context", "at"])
            .join(shorter.withColumnRenamed("key", "tail"), ["tail", "at"])
            .select("key", "at", (F.col("rest") / F.col("mass") + F.col("gamma") * F.col("p")).alias("p")),
            "probabilities",
        )
        tables.append(shorter.select(F.lit(length).alias("kind"), "key", "at", F.log("p").alias("value")))
        tables.append(
            around.select(F.lit(1 - length).alias("kind"), F.col("context").alias("key"), "at", F.log("gamma").alias("value"))
        )
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    parts = max(1, -(-rows.count() // ROWS_A_FILE))
    path = new_folder(spark, "language")
    (
        rows.select("kind", "key", "at", F.col("value").cast("float").alias("value"))
        .repartitionByRange(parts, "kind", "key")
        .sortWithinPartitions("kind", "key", "at")
        .write.option("maxRecordsPerFile", ROWS_A_FILE)
        .parquet(path)
    )
    return spark.read.parquet(path)


def _files(stored: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, tuple[str, ...]]]:
    """For each kind the first and last keys of the files, and their paths."""
    told = (
        stored.groupBy("kind", F.input_file_name().alias("path"))
        .agg(F.min("key").alias("least"), F.max("key").alias("most"))
        .orderBy("kind", "least", "most")
        .collect()
    )
    out = {}
    for kind in range(1 - ORDER, ORDER + 1):
        own = [r for r in told if r.kind == kind]
        first, last = (np.array([r[c] for r in own], np.int64) for c in ("least", "most"))
        # Spark gives paths as URIs; those of other stores are opened by these.
        out[kind] = first, last, tuple(unquote(r.path) if r.path.startswith("file:") else r.path for r in own)
    return out


_READ: OrderedDict[str, tuple[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], int]] = OrderedDict()


def _read(path: str) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The keys, languages and values of a file, by kind; the last used files of up to CACHE_BYTES are kept."""
    if path in _READ:
        _READ.move_to_end(path)
        return _READ[path][0]
    with opened(path) as file:
        table = pq.read_table(file)
    kind, key, at, value = (table.column(c).to_numpy() for c in ("kind", "key", "at", "value"))
    kinds, first = np.unique(kind, return_index=True)
    ends = [*first[1:], len(kind)]
    out = {int(k): (key[a:b], at[a:b], value[a:b]) for k, a, b in zip(kinds, first, ends)}
    _READ[path] = out, sum(x.nbytes for x in (key, at, value))
    while len(_READ) > 1 and sum(size for _, size in _READ.values()) > CACHE_BYTES:
        _READ.popitem(last=False)
    return out


def _filled(model: Model, kind: int, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Puts what the tables of a kind have for sorted keys into rows of values, one column per
    language; returns where there is something."""
    there = np.zeros(values.shape, bool)
    first, last, paths = model.files[kind]
    begins, ends = np.searchsorted(wanted, first), np.searchsorted(wanted, last, "right")
    for i in np.flatnonzero(begins < ends):
        some = slice(begins[i], ends[i])
        key, at, value = _read(paths[i])[kind]
        left, right = np.searchsorted(key, wanted[some]), np.searchsorted(key, wanted[some], "right")
        n = right - left
        row = np.repeat(np.arange(begins[i], ends[i]), n)
        place = np.arange(len(row)) + np.repeat(left - (np.cumsum(n) - n), n)
        values[row, at[place]] = value[place]
        there[row, at[place]] = True
    return there


def _logs(model: Model, key: np.ndarray) -> np.ndarray:
    """Log probabilities of the last symbols of sorted sequences in each language."""
    out = None
    for length in range(1, ORDER + 1):
        # Sorted as signed numbers, as Spark sorts them.
        own, back = np.unique((key & U64((1 << 16 * length) - 1)).view(np.int64), return_inverse=True)
        values = np.zeros((len(own), len(model.languages)), np.float32)
        there = _filled(model, length, own, values)
        if length == 1:
            below = np.broadcast_to(model.unseen.astype(np.float32), values.shape)
        else:
            which, at = np.unique((own.view(U64) >> U64(16)).view(np.int64), return_inverse=True)
            weights = np.zeros((len(which), len(model.languages)), np.float32)
            _filled(model, 1 - length, which, weights)
            tails = own.view(U64) & U64((1 << 16 * (length - 1)) - 1)
            below = weights[at] + values_below[np.searchsorted(below_keys, tails.view(np.int64))]
        values_below, below_keys = np.where(there, values, below), own
        out = values_below[back]
    return out


def entropies(model: Model, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per symbol of each row in each language, and whether the row has a letter."""
    seq, offsets = symbols(piece)
    key, row = sequences(seq, offsets)
    different, back = np.unique(key, return_inverse=True)
    logs = _logs(model, different)
    size = np.bincount(row, minlength=len(piece))
    out = np.stack([np.bincount(row, logs[back, i], len(piece)) for i in range(len(model.languages))], 1)
    return -out / np.maximum(size, 1)[:, None], size > 0


def _calibrated(model: Model, docs: DataFrame, text: str, lang: str) -> Model:
    """The sharpness that makes the languages of all different labelled texts likeliest, and the limits of rejection."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    source = known.select(F.lower(text), F.col(lang), F.xxhash64(text, lang))
    index = {x: i for i, x in enumerate(model.languages)}
    losses = [f"loss{i}" for i in range(len(SHARPNESS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(0), 1 << 20):
                found, letters = entropies(model, piece)
                own = batch.slice(piece.first, len(piece))
                # A text with letters is in a language that is known.
                right = np.array([index.get(x, 0) for x in own.column(1).to_pylist()], np.int32)
                row = np.arange(len(found))
                beyond = found - found.min(1, keepdims=True)
                each = [np.log(np.exp(-k * beyond).sum(1)) + k * beyond[row, right] for k in SHARPNESS]
                columns = [pa.array(right), own.column(2), pa.array(found[row, right]), pa.array(found.argmin(1) == right)]
                told = pa.RecordBatch.from_arrays([*columns, *map(pa.array, each)], names=["at", "h", "own", "won", *losses])
                yield told.filter(pa.array(letters))

    schema = ", ".join(["at int, h long, own double, won boolean", *[f"{c} double" for c in losses]])
    each = written(source.mapInArrow(run, schema).dropDuplicates(["h"]), "calibration")
    mean = each.agg(*[F.avg(c) for c in losses]).first()
    limits = np.full(len(index), np.inf)
    for r in _tails(each.where("won").select("at", "own")).collect():
        limits[r["at"]] = r.lower + (r.upper - r.lower) * (r.place - math.floor(r.place)) + r.spread
    return replace(model, sharpness=SHARPNESS[int(np.argmin(mean))] if mean[0] is not None else SHARPNESS[0], limits=limits)


def _tails(own: DataFrame) -> DataFrame:
    """(at, place, spread, lower, upper) of values ``own`` by ``at``: their standard deviation, and those in order
    right below and above the place of the quantile REJECTED."""
    binned = own.withColumn("bin", F.floor(F.col("own") * BINS))
    whole = own.groupBy("at").agg(((F.count("*") - 1) * F.lit(REJECTED)).alias("place"), F.stddev_pop("own").alias("spread"))
    bins = binned.groupBy("at", "bin").agg(F.count("*").alias("times"))
    bins = bins.withColumn("through", F.sum("times").over(Window.partitionBy("at").orderBy("bin"))).join(F.broadcast(whole), "at")
    bins = bins.where("through > floor(place) AND through - times <= ceil(place)")
    near = binned.join(F.broadcast(bins.select("at", "bin", "place", "spread", (F.col("through") - F.col("times")).alias("before"))), ["at", "bin"])
    near = near.groupBy("at", "bin", "place", "spread", "before", "own").agg(F.count("*").alias("times"))
    in_bin = F.sum("times").over(Window.partitionBy("at", "bin").orderBy("own"))
    near = near.withColumn("through", F.col("before") + in_bin)
    return near.groupBy("at", "place", "spread").agg(
        F.min(F.expr("IF(through > floor(place), own, NULL)")).alias("lower"),
        F.min(F.expr("IF(through > ceil(place), own, NULL)")).alias("upper"),
    )


def predict(docs: DataFrame, model: Model, *, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The table's columns and ``lang_pred``, ``score``, ``entropy`` (the winner's, per symbol) and
    ``rejected`` (whether the text is unlike what the winner was learned from)."""
    kept = [c for c in docs.columns if c.lower() not in NEW and (keep_text or c != text)]
    source = docs.select(*kept, F.lower(text).alias("_scored"))
    new = [
        T.StructField("lang_pred", T.StringType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField("entropy", T.DoubleType(), False),
        T.StructField("rejected", T.BooleanType(), False),
    ]
    schema = T.StructType([*docs.select(*kept).schema.fields, *new])
    if not model.languages:
        nothing = (F.lit(UNKNOWN), F.lit(0.0), F.lit(0.0), F.lit(True))
        return docs.select(*kept, *[v.alias(f.name) for v, f in zip(nothing, new, strict=True)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for piece in pieces(batch.column(batch.num_columns - 1), 1 << 20):
                found, letters = entropies(model, piece)
                best = found.argmin(1)
                least = found[np.arange(len(found)), best]
                share = 1 / np.exp(-model.sharpness * (found - least[:, None])).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(piece.first, len(piece)).columns[:-1],
                        pa.array(names[np.where(letters, best, len(names) - 1)], pa.string()),
                        pa.array(np.where(letters, share, 0.0)),
                        pa.array(np.where(letters, least, 0.0)),
                        pa.array(~letters | (least > model.limits[best])),
                    ],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)
