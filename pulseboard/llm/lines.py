"""Removal of repeated passages, by windows of three consecutive lines.

A text is cut at line feeds. Every three consecutive lines make a window; windows overlap. Of all
windows with the same three lines, in all documents, the first one stays: in the document of the
smallest id, there at the first place. All lines that a later one covers are removed.
Windows are told apart by 128 bits of hash, and are judged on the texts as they came in.

Only column expressions, joins and aggregations: windows are counted per hash with partial
aggregation, then those of repeated hashes are looked up again (a join that Spark can split if one
window is very frequent), and the starts of removed windows are merged to runs per document.

Defined results: a null text stays null, and an empty text is one empty line; texts of fewer lines
than a window stay as they are. Rows without an id come after all others. Rows of equal id and
text are one document and get the same text; of rows with one id and different texts, the order is
by a hash of the text. Other columns stay; a column that has the name of a new one, or of the operator's own
``_id`` and ``_row``, is replaced or left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 3
LAST = 2**63 - 1


def with_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with a key that is never null: the id (the largest number if null) and a hash."""
    return docs.withColumns(
        {
            "_id": F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)),
            "_row": F.xxhash64(F.col(doc_id), F.col(text)),
        }
    )


def _windows(lines: Column, size: int) -> Column:
    """An array of structs, one for each window, of the hashes of its lines."""
    hashes = F.transform(lines, lambda line: F.xxhash64(line))
    n = F.greatest(F.size(lines) - F.lit(size - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(hashes, F.lit(i + 1), n).alias(f"l{i}") for i in range(size)])


def dedup(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """The table with the shortened texts, and the columns ``n_lines`` (before) and ``n_removed``."""
    columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed", "_id", "_row")]
    keyed = with_keys(docs.select(*columns), doc_id, text)
    lines = F.split(F.col(text), "\n", -1)

    found = (
        keyed.where(F.col(text).contains("\n"))
        .select("_id", "_row", F.posexplode(_windows(lines, window)).alias("_at", "_lines"))
        .select(
            "_id",
            "_row",
            "_at",
            F.xxhash64(*[f"_lines.l{i}" for i in range(window)]).alias("_h1"),
            F.xxhash64(F.lit(1), *[f"_lines.l{i}" for i in range(window)]).alias("_h2"),
        )
    )
    place = F.struct("_id", "_row", "_at")
    repeated = (
        found.groupBy("_h1", "_h2")
        .agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
        .where("_first < _last")
        .select("_h1", "_h2", "_first")
    )
    later = found.join(repeated, ["_h1", "_h2"]).where(place > F.col("_first"))

    # Starts of removed windows that follow each other without a gap make one run of lines.
    doc = ["_id", "_row"]
    in_order = Window.partitionBy(*doc).orderBy("_at")
    runs = (
        later.select(*doc, "_at")
        .distinct()
        .withColumn("_new", (F.col("_at") > F.coalesce(F.lag("_at").over(in_order), F.lit(-window - 1)) + window).cast("int"))
        .withColumn("_run", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*doc, "_run")
        .agg(F.min("_at").alias("begin"), (F.max("_at") + window).alias("end"))
        .groupBy(*doc)
        .agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("_runs"))
    )
    n = F.size(lines)
    # What lies between the runs stays.
    gaps = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.col("_runs.end")).alias("a"),
        F.concat(F.col("_runs.begin"), F.array(n)).alias("b"),
    )
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["a"] + 1, g["b"] - g["a"])))
    removed = F.aggregate("_runs", F.lit(0), lambda total, r: total + r["end"] - r["begin"])
    return keyed.join(runs, doc, "left").select(
        *[
            F.when(F.col("_runs").isNull(), F.col(c)).otherwise(F.array_join(kept, "\n")).alias(c)
            if c == text
            else F.col(c)
            for c in columns
        ],
        F.when(F.col(text).isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
    )


def dedup_oracle(documents: str = "documents", window: int = WINDOW) -> str:
    """DuckDB SQL for the shortened texts of a table whose ids are unique and not null."""
    ahead = [f"lead(line, {i}) OVER w AS l{i}" for i in range(1, window)]
    names = ", ".join(["line", *[f"l{i}" for i in range(1, window)]])
    covered = reduce(lambda a, b: f"{a} UNION {b}", [f"SELECT doc_id, pos + {i} AS pos FROM later" for i in range(window)])
    return f"""
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                     unnest(range(len(string_split(text, chr(10))))) AS pos FROM {documents}),
    windows AS (SELECT doc_id, pos, {names}, lead(pos, {window - 1}) OVER w AS stop FROM
                  (SELECT doc_id, pos, line, {", ".join(ahead)} FROM lines
                   WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
                WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    later AS (SELECT doc_id, pos FROM
                (SELECT doc_id, pos, row_number() OVER (PARTITION BY {names} ORDER BY doc_id, pos) AS k
                 FROM windows WHERE stop IS NOT NULL) WHERE k > 1),
    covered AS ({covered}),
    kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text, count(*) AS n
             FROM lines l ANTI JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id),
    totals AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id),
    deduped AS (SELECT d.* REPLACE (CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text),
                       coalesce(t.n, 0) AS n_lines, coalesce(t.n, 0) - coalesce(k.n, 0) AS n_removed
                FROM {documents} d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN totals t ON t.doc_id = d.doc_id)"""
