"""Passages of benchmark items in documents, by a distributed positional inverted index.

A text's words are its runs of digits, letters a to z (A to Z are lower-cased) and characters
beyond ASCII. A term of the index is a pair of neighbouring words; a posting says where a document
has it. Only terms that some item has are stored, so the index has a fraction of the words, and
very frequent single words don't fill it.

``phrases`` looks for every window of ten consecutive words of an item (an item of fewer words is
one window; of one word, its term is that word). The terms of a window are ordered by how often the
documents have them. The list of the rarest is shifted by its offset in the window to places where
the window would start, and is then intersected with the shifted lists of all others, of which
only the postings of the documents still in question are read. ``near`` finds two words within a
distance, in either order.

Only column expressions, joins and aggregations. The items' terms are broadcast if there are at
most BROADCAST_TERMS of them, else joined by a shuffle.

Defined results: a null text and a text without words have no words and no hits; items without
words have no windows; rows of equal id and text are one document and each get its result; rows
with one id and different texts are told apart by a hash of the text. Repeated items count once
per id; items without an id have no name to report and are left out. Other columns stay as they
are; a column that has the name of a new one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseboard.llm.lines import with_keys
from pulseboard.llm.tables import checked
from pulseboard.sources.scratch import written

WINDOW = 10
BROADCAST_TERMS = 1_000_000
# Fixed by the definition of words. The first is for lower-cased texts, the second for any.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NEW = ("n_words", "n_hit", "n_items", "items", "contaminated")


def words_of(text: Column) -> Column:
    """The words of a text, in order. Lower-casing of whole texts is quick where all is ASCII."""
    ascii_only = F.char_length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _pair(left: Column, right: Column) -> Column:
    return F.xxhash64(F.lit(2), left, right)


def _single(word: Column) -> Column:
    return F.xxhash64(F.lit(1), word)


def windows(items: DataFrame, *, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """One row for each term of each distinct window: (window, length, offset, term), and the
    ids of the items that have the window."""
    words = items.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("string").alias("_item"), words_of(F.col(text)).alias("w")
    )
    length = F.least(F.size("w"), F.lit(size))
    starts = words.where("size(w) > 0").select(
        "_item",
        "w",
        length.alias("length"),
        F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)).alias("at"),
    )
    return (
        starts.select("_item", F.slice("w", F.col("at"), F.col("length")).alias("words"))
        .groupBy("words")
        .agg(F.collect_set("_item").alias("items"))
        .select(
            F.xxhash64("words").alias("window"), "items", "words", F.size("words").alias("length")
        )
    )


def _terms(found: DataFrame) -> DataFrame:
    """(window, length, offset, term) of windows."""
    several = found.where("length > 1").select(
        "window", "length", "words", F.explode(F.sequence(F.lit(0), F.col("length") - 2)).alias("offset")
    )
    return several.select(
        "window",
        "length",
        "offset",
        _pair(F.get("words", F.col("offset")), F.get("words", F.col("offset") + 1)).alias("term"),
    ).union(
        found.where("length = 1").select(
            "window", "length", F.lit(0).alias("offset"), _single(F.get("words", F.lit(0))).alias("term")
        )
    )


def index(docs: DataFrame, terms: DataFrame, *, text: str = "text") -> DataFrame:
    """Postings (term, _id, _row, at) of the given terms in keyed documents."""
    vocabulary = written(terms.select(F.col("term").alias("_term")).distinct(), "terms")
    if vocabulary.count() <= BROADCAST_TERMS:
        vocabulary = F.broadcast(vocabulary)
    words = docs.select("_id", "_row", words_of(F.col(text)).alias("_words"))
    following = F.get("_words", F.col("at") + 1)
    # Of an outer explode Spark infers no filter on the words, which would make them again.
    at = words.select("_id", "_row", "_words", F.posexplode_outer("_words").alias("at", "word"))
    pairs = at.where(F.col("at") < F.size("_words") - 1).select("_id", "_row", "at", _pair(F.col("word"), following).alias("term"))
    postings = pairs.join(vocabulary, F.col("term") == F.col("_term")).drop("_term")
    if not terms.where("length = 1").isEmpty():
        singles = at.where("word IS NOT NULL").select("_id", "_row", "at", _single(F.col("word")).alias("term"))
        postings = postings.union(singles.join(vocabulary, F.col("term") == F.col("_term")).drop("_term"))
    return written(postings.select("term", "_id", "_row", "at"), "postings")


def phrases(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences (_id, _row, start, window, length) of whole windows."""
    often = postings.groupBy("term").agg(F.count("*").alias("often"))
    rank = F.row_number().over(Window.partitionBy("window").orderBy(F.coalesce("often", F.lit(0)), "offset"))
    ranked = terms.join(often, "term", "left").withColumn("rank", rank)
    ranked = written(ranked.select("window", "length", "offset", "term", "rank"), "ranked")
    start = (F.col("at") - F.col("offset")).alias("start")
    rarest = ranked.where("rank = 1").drop("rank")
    found = postings.join(rarest, "term").select("_id", "_row", "window", "length", start).where("start >= 0")
    found = written(found.distinct(), "places")
    # Each of the other terms must have a posting at its place.
    asked = found.join(ranked.where("rank > 1"), ["window", "length"]).select(
        "_id", "_row", "window", "length", "start", "term", (F.col("start") + F.col("offset")).alias("at")
    )
    there = postings.join(found.select("_id", "_row").distinct(), ["_id", "_row"], "left_semi").distinct()
    place = ["_id", "_row", "start", "window", "length"]
    whole = (
        asked.join(there, ["_id", "_row", "at", "term"])
        .groupBy(*place)
        .agg(F.count("*").alias("n"))
        .where("n = length - 2")
        .select(*place)
    )
    return whole.union(found.where("length <= 2").select(*place).distinct())


def near(postings: DataFrame, left: DataFrame, right: DataFrame, distance: int) -> DataFrame:
    """Proximity: places (_id, _row, at, other) where a term of ``left`` (a column ``term``) and one
    of ``right`` stand at most ``distance`` places apart, in either order."""
    one = postings.join(left.select("term").distinct(), "term", "left_semi")
    two = postings.join(right.select("term").distinct(), "term", "left_semi")
    block = lambda at: F.floor(at / (distance + 1))
    one = one.select("_id", "_row", "at", F.explode(F.sequence(block(F.col("at")) - 1, block(F.col("at")) + 1)).alias("_b"))
    two = two.select("_id", "_row", F.col("at").alias("other"), block(F.col("at")).alias("_b"))
    close = (F.abs(F.col("at") - F.col("other")) <= distance) & (F.col("at") != F.col("other"))
    return one.join(two, ["_id", "_row", "_b"]).where(close).select("_id", "_row", "at", "other").distinct()


def check(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    keep_text: bool = True,
) -> DataFrame:
    """The table's columns (the text only with ``keep_text``) and: ``n_words``, ``n_hit`` (words inside any occurrence of a window),
    ``n_items`` and ``items`` (ids as strings, sorted) with occurrences, ``contaminated``."""
    columns = [c for c in docs.columns if c.lower() not in (*NEW, "_id", "_row")]
    kept = [c for c in columns if keep_text or c != text]
    keyed = with_keys(docs.select(*columns), doc_id, text)
    found = written(windows(items, item_id=item_id, text=item_text, size=size), "windows")
    terms = written(_terms(found), "window-terms")
    hits = written(phrases(index(keyed, terms, text=text), terms), "hits")
    doc = ["_id", "_row"]
    covered = (
        hits.select(*doc, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at"))
        .distinct()
        .groupBy(*doc)
        .agg(F.count("*").alias("n_hit"))
    )
    names = (
        hits.join(found.select("window", F.explode("items").alias("_item")), "window")
        .select(*doc, "_item")
        .distinct()
        .groupBy(*doc)
        .agg(F.sort_array(F.collect_list("_item")).alias("items"))
    )
    # Few documents have hits: as long as their items are few enough to broadcast, no text is moved.
    result = checked(covered.join(names, doc), "hit-documents", F.size("items") + 1)
    n_words = F.coalesce(F.regexp_count(text, F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long")
    n_hit = F.coalesce("n_hit", F.lit(0))
    names = F.coalesce("items", F.array().cast("array<string>"))
    counted = keyed.select(*kept, "_id", "_row", n_words.alias("n_words"))
    return counted.join(result, doc, "left").select(
        *kept,
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        names.alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def check_oracle(size: int = WINDOW) -> str:
    """DuckDB SQL for the columns of ``check`` by doc_id, for ids that are unique and not null."""
    words = f"regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{WORD}')"
    return f"""
    item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
    item_windows AS (SELECT DISTINCT item, k, list_slice(w, s, s + k - 1) AS win FROM
        (SELECT item, w, least({size}, len(w)) AS k, unnest(range(1, len(w) - least({size}, len(w)) + 2)) AS s
         FROM item_words WHERE len(w) > 0)),
    doc_words AS (SELECT doc_id, {words} AS w FROM documents WHERE text IS NOT NULL),
    doc_windows AS (SELECT doc_id, s, k, list_slice(w, s, s + k - 1) AS win FROM
        (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
         FROM doc_words, (SELECT DISTINCT k FROM item_windows) WHERE len(w) >= k)),
    hits AS (SELECT d.doc_id, d.s, d.k, i.item FROM doc_windows d JOIN item_windows i ON d.k = i.k AND d.win = i.win),
    hit_words AS (SELECT doc_id, count(DISTINCT place) AS n FROM
        (SELECT doc_id, unnest(range(s, s + k)) AS place FROM hits) GROUP BY doc_id),
    hit_items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM
        (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)"""
