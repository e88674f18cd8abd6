"""How far the sources of a language are apart in the words that they use.

Terms are runs of letters: A-Z, a-z and everything beyond ASCII, with only A-Z lower-cased. One
``bytes.translate`` lowers letters and blanks all else, ``bytes.split`` cuts, and a Counter per document
gives how often each term occurs in it. Tasks add up Counters per language and source before
anything is shuffled, so that a source with a third of all documents arrives as one row per term
and task.

A language keeps the terms of at least ``min_docs`` of its documents. A group (a language's documents
of one source, or all of them) gives each kept term a share of SHARES, smoothed by SMOOTHING
occurrences, in whole numbers: 1 + floor(SHARES * (count + SMOOTHING) / (total + SMOOTHING * terms)).
``audit`` tells two kinds of rows: how far each two sources of a language are apart (``pair``: the
sum of the shares' differences over all kept terms), and which terms stand out in a source against
its language (``term``: those with the largest differences).

Terms that a source lacks are not stored. For pairs, terms are dealt to blocks by their hash, each
of a bounded number of (term, source) cells, in which the missing shares are filled in; sums
over the blocks are added up by Spark. Languages of many sources are cut into chunks of sources as well.

Defined results: null text, language and source count as empty texts, and an empty language or
source is one like any other. A group without terms has rows in ``pair``; a language that keeps no term
has pairs of difference 0, with one source no pair. Repeated rows count as documents of their own. Equal values
are ranked by the item's bytes. An empty table gives no rows. Other columns are left out. Numbers are exact
while a language has fewer than 9e9 kept terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseboard.llm.tables import checked
from pulseboard.llm.texts import pieces
from pulseboard.sources.scratch import written

MIN_DOCS = 30
SMOOTHING = 5
SHARES = 1_000_000_000
TOP = 50
# Different terms that a task holds before it hands their counts on.
HELD = 600_000
# Cells (terms x sources) of a block, and sources whose differences from all others are taken at once.
CELLS = 1 << 21
CHUNK = 128

LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a text, in order."""
    return text.translate(LETTERS).split()


def counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in a source, and documents that have it.

    The empty term counts the documents themselves, so that a source without terms is there too.
    """
    given = docs.select(
        F.col(text).alias("text"),
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
    )

    def told(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (own_lang, own_source), (occurrences, documents) in held.items():
            size = len(documents)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([own_lang] * size, pa.string()),
                    pa.array([own_source] * size, pa.string()),
                    pa.array(list(documents), pa.binary()).cast(pa.string()),
                    pa.array([occurrences[t] for t in documents], pa.int64()),
                    pa.array(list(documents.values()), pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            groups = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            for piece in pieces(batch.column(0)):
                for i in range(len(piece)):
                    begin, end = piece.offsets[i], piece.offsets[i + 1]
                    found = Counter(terms(piece.data[begin:end].tobytes()))
                    occurrences, documents = held.setdefault(groups[piece.first + i], (Counter(), Counter()))
                    before = len(documents)
                    documents[b""] += 1
                    documents.update(found.keys())
                    for term, n in found.items():
                        occurrences[term] += n
                    size += len(documents) - before
                    if size > HELD:
                        yield from told(held)
                        held, size = {}, 0
        yield from told(held)

    partial = given.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column, smoothing: int) -> Column:
    """A term's share of its group; 1 where there are no terms to share."""
    whole = F.greatest(total + smoothing * terms, F.lit(1)).cast("decimal(20,0)")
    part = F.lit(SHARES).cast("decimal(10,0)") * (count + smoothing).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", part, whole)


def _apart(shares: DataFrame, groups: DataFrame, blocks: int) -> DataFrame:
    """(lang, one, other, value) with one < other: sums of differences over all kept terms.

    ``shares`` has (lang, at, term, share, n_sources) of the terms that a source has, ``groups``
    (lang, at, share, n_sources) the share of those that it lacks.
    """
    chunks = F.explode(F.sequence(F.lit(0), F.expr(f"int((n_sources - 1) div {CHUNK})"))).alias("chunk")
    there = shares.select("lang", F.expr(f"int(pmod(xxhash64(term), {blocks}))").alias("block"), "at", "term", "share", chunks)
    lacking = groups.select(
        "lang", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "at", F.lit(None).cast("string").alias("term"), "share", "n_sources"
    ).select("lang", "block", "at", "term", "share", chunks)

    def run(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        at, share = block.column("at").to_numpy(), block.column("share").to_numpy()
        term = block.column("term").combine_chunks().dictionary_encode().indices
        head = np.asarray(term.is_null())
        code = np.asarray(term.fill_null(-1))
        none = np.zeros(int(head.sum()), np.int64)
        none[at[head]] = share[head]
        cells = np.tile(none, (int(code.max(initial=-1)) + 1, 1))
        cells[code[~head], at[~head]] = share[~head]
        first = key[2].as_py() * CHUNK
        ones, others, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for one in range(first, min(first + CHUNK, len(none))):
            values.append(np.abs(cells[:, one + 1 :] - cells[:, one : one + 1]).sum(0))
            others.append(np.arange(one + 1, len(none)))
            ones.append(np.full(len(others[-1]), one))
        size = sum(map(len, ones))
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * size, pa.string()),
                "one": np.concatenate(ones),
                "other": np.concatenate(others),
                "value": np.concatenate(values),
            }
        )

    parts = there.unionByName(lacking).groupBy("lang", "block", "chunk")
    sums = parts.applyInArrow(run, "lang string, one long, other long, value long")
    return sums.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    smoothing: int = SMOOTHING,
    top: int = TOP,
) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows for each other source of the language,
    ``term`` rows for the ``top`` terms that stand out; the largest value has rank 1."""
    found = written(counts(docs, text=text, lang=lang, source=source), "term_counts")
    kept = written(
        found.where("term <> ''")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs)
        .select("lang", "term", "lang_n"),
        "kept_terms",
    )
    own = written(found.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "source_terms")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("lang_n").alias("lang_total"))
    zero = F.lit(0).cast("long")
    groups = (
        found.where("term = ''")
        .select("lang", "source")
        .join(own.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .fillna(0, ["total", "n_terms", "lang_total"])
        .withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
        .withColumn("n_sources", F.count("*").over(Window.partitionBy("lang")))
        .withColumn("lacking", _share(zero, F.col("total"), F.col("n_terms"), smoothing))
    )
    groups = checked(groups, "source_groups")
    largest = groups.agg(F.max(F.col("n_terms") * F.col("n_sources"))).first()[0] or 0
    shares = own.join(groups, ["lang", "source"]).withColumn(
        "share", _share(F.col("n"), F.col("total"), F.col("n_terms"), smoothing)
    )

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    common = _share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms"), smoothing)
    standing_out = (
        shares.select("lang", "source", F.col("term").alias("item"), (F.col("share") - common).alias("value"))
        .where("value > 0")
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= top)
    )

    apart = _apart(
        shares, groups.withColumn("share", F.col("lacking")), max(8, -(-largest // CELLS))
    )
    names = groups.select("lang", F.col("at").alias("one"), "source")
    both_ways = apart.select(
        "lang",
        F.explode(
            F.array(
                F.struct("one", "other"), F.struct(F.col("other").alias("one"), F.col("one").alias("other"))
            )
        ).alias("way"),
        "value",
    ).select("lang", "way.one", "way.other", "value")
    pairs = (
        both_ways.join(names, ["lang", "one"])
        .join(names.select("lang", F.col("one").alias("other"), F.col("source").alias("item")), ["lang", "other"])
        .select("lang", "source", "item", "value")
        .withColumn("rank", F.row_number().over(by_value))
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(columns)
        .unionByName(standing_out.withColumn("part", F.lit("term")).select(columns))
    )


def audit_oracle(min_docs: int = MIN_DOCS, smoothing: int = SMOOTHING, top: int = TOP) -> str:
    """The same over ``documents``, in SQL for DuckDB."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def share(count: str, total: str) -> str:
        return f"CAST(1 + (CAST({SHARES} AS HUGEINT) * ({count} + {smoothing})) // ({total} + {smoothing} * v.n_terms) AS BIGINT)"

    return f"""
    WITH given AS (
        SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text FROM documents),
    words AS (
        SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM given),
    kept AS (
        SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= {min_docs}),
    v AS (SELECT lang, count(*) AS n_terms, sum(n) AS total FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM given),
    cells AS (
        SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0) AS n
        FROM groups g JOIN kept k ON k.lang = g.lang
        LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL) c
               ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL),
    shares AS (
        SELECT c.lang, c.source, c.term, c.n, {share("c.n", "t.total")} AS p, {share("c.lang_n", "v.total")} AS q
        FROM cells c JOIN totals t ON t.lang = c.lang AND t.source = c.source JOIN v ON v.lang = c.lang),
    sums AS (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    rows AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
    ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM rows)
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top}"""
