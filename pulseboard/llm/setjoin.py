"""Near duplicates by an exact Jaccard join of sets of word shingles, and their connected groups.

The join is size-aware. Equal sets are one class and are joined once. Of two sets that link, the
smaller decides how they are found:

* small: fixed-size subsets. With n and m elements, a link needs c common ones; both sets list all
  their subsets of c elements, and a common subset makes a candidate.
* large: inverted lists. The range of hashes is cut into parts, more of them than two linked sets
  can have elements that differ, and some to spare; each set is on the list of each of its parts, that
  is of the elements that it has there. Linked sets have at least the spare number of parts in
  common. More empty parts than that are rare (four standard deviations); sets that have them are on one
  more list of their level, so that linked sets share a list in any case.

The boundary between small and large is the one of least cost for the sizes at hand: rows for
subsets against rows for lists and their scanning. Sizes of large sets fall into levels, as sets
of very different size cannot link; a level says how many parts there are.

Lists with the same members are scanned once. A scan compares 512-bit parity sketches, whose
distance is never more than the number of differing elements, so that no link is lost; lists of more
than BLOCK members are scanned in pairs of blocks, by as many tasks. A pair that shares several lists
is taken on the first of them: each row knows the first FIRST_LISTS lists of its set. In sets of more than SKETCH
elements such sketches are full, so pairs of these are compared by longer ones as well, of at least a bit
per element. What is left is compared element by element. A frequent passage puts no documents on one list unless they agree in a whole part.

``links`` gives all links between classes, of which a group of near copies has as many as the square of
its size. ``groups`` doesn't need them all. It first compares each class with one other of its longest
list. Then each class meets one other of each of its lists, a different one per list, and of these pairs
the likeliest few of each group are compared. What a group of near copies costs so grows with its size. Then all
lists whose members are still of several groups are scanned in full, for pairs of different groups only; the likeliest
are compared first, and then all that are still of different groups, so that no link that joins groups is missed.

Groups are connected components over classes. In each round every class joins the neighbour (or
itself) that a hash of the round puts first, and links between joined classes are one; rounds shrink
the links geometrically, and each is written to the shared folder.

Defined results: sets are told apart by 128 bits of hash, shingles by 64. A text without words,
null included, has an empty set, links with nothing and is its own group. Rows without an id take part:
they may join groups, and a group of such rows alone has a null id. Repeated rows are copies and link with
each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseboard.llm.tables import checked
from pulseboard.llm.texts import LOWER, U64, Piece, long_array, mix, pieces, rows_of, span_hashes, words
from pulseboard.sources.scratch import written

RATIO = 1.5
SKETCH = 512
BLOCK = 1024
FIRST_LISTS = 32
NO_LIST = np.iinfo(np.int64).max
MOST_SMALL = 40
PAIR = "a long, b long, a_of long, b_of long, apart double"
PARTS_APART = 1 << 20
# Pairs that are compared for each group before its others are.
PARTNERS = 3
# Hubs that a class is compared with when those of all its lists are asked.
HUBS = 4
# Rounds of which labels are derived in one plan.
ROUNDS_A_PLAN = 6
# A row of a list costs so many rows of a subset: it may be looked up, sketched and scanned.
LIST_COST = 3


class Rule:
    """When sets link, and where they look for each other. ``percent``: least similarity."""

    def __init__(self, percent: int, small: int = 0):
        self.percent, self.small = percent, small
        self.starts = [small + 1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(max(self.starts[-1] + 1, int(self.starts[-1] * RATIO)))

    def common(self, n: int, m: int) -> int:
        """Common elements that a link of sets of n and m elements needs."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def largest(self, n: int) -> int:
        """The most elements of a set that can link with one of n."""
        return 100 * n // self.percent

    def parts(self, level: int) -> tuple[int, int]:
        """The number of parts of a level's sets, and how many of them linked sets have in common.

        A set of the level's least size has fewer empty parts than that, but for rare cases.
        """
        top, least = self.starts[level + 1] - 1, self.starts[level]
        apart = (100 - self.percent) * (top + self.largest(top)) // (100 + self.percent)
        spare = 2
        while True:
            empty = (apart + spare) * math.exp(least * math.log1p(-1 / (apart + spare)))
            if spare > empty + 4 * math.sqrt(empty) or spare > 4 * apart:
                return apart + spare, spare
            spare += 1

    def subsets(self, n: int) -> list[int]:
        """The sizes of subsets that a set of n elements lists; none larger than it."""
        least = -(-self.percent * n // 100)
        sizes = {
            self.common(n, m)
            for m in range(max(least, 1), self.largest(n) + 1)
            if m != n and min(n, m) <= self.small and self.common(n, m) <= min(n, m)
        }
        if n <= self.small and self.common(n, n) < n:
            sizes.add(self.common(n, n))
        return sorted(sizes)

    def levels(self, n: int) -> list[int]:
        """Levels of the lists of a set: its own, and the one below if a smaller set there can link."""
        if n <= self.small:
            return []
        own = int(np.searchsorted(self.starts, n, "right")) - 1
        below = own > 0 and -(-self.percent * n // 100) < self.starts[own]
        return [own - 1, own] if below else [own]


def boundary(percent: int, sizes: dict[int, int]) -> int:
    """The largest size that counts as small, by cost; ``sizes`` counts sets of up to MOST_SMALL."""

    def cost(small: int) -> float:
        rule = Rule(percent, small)
        total = 0.0
        for n, count in sizes.items():
            subsets = rule.subsets(n)
            if any(n - c > 2 for c in subsets):
                return math.inf
            total += count * sum(math.comb(n, c) for c in subsets)
            total += count * LIST_COST * sum(rule.parts(level)[0] for level in rule.levels(n))
        return total

    return min(range(MOST_SMALL // 2), key=lambda small: (cost(small), small))


def shingle_sets(piece: Piece, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each row's distinct shingles, in order, and where each row's begin."""
    w = words(piece, LOWER[piece.data])
    counts = np.diff(w.offsets)
    per_row = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), per_row)
    begin = w.offsets[row] + np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    hashes = span_hashes(w.hashes, begin, np.minimum(begin + size, w.offsets[row + 1]))
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.searchsorted(row[new], np.arange(len(counts) + 1))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


SALT = U64(0xA0761D6478BD642F)


def _identities(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(offsets).astype(U64)
    return mix(_sums(mix(hashes), offsets) + n), mix(_sums(mix(hashes ^ SALT), offsets) ^ n)


def _sketches(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each row, SKETCH bits: the parity of its elements per cell."""
    out = np.zeros((len(offsets) - 1, SKETCH // 8), np.uint8)
    for i in range(0, len(out), 2000):
        own = offsets[i : i + 2001]
        cells = (mix(hashes[own[0] : own[-1]] ^ U64(3)) % U64(SKETCH)).astype(np.int64)
        counts = np.bincount(rows_of(own - own[0]) * SKETCH + cells, minlength=(len(own) - 1) * SKETCH)
        out[i : i + 2000] = np.packbits((counts & 1).astype(bool).reshape(-1, SKETCH), axis=1)
    return out


def _long_sketches(hashes: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """For each row of more than SKETCH elements the same parities in as many cells, a power of two, as it has elements
    at least. The cells of half as many are the sums of two of these."""
    out: list[bytes | None] = [None] * (len(offsets) - 1)
    for i in np.flatnonzero(np.diff(offsets) > SKETCH).tolist():
        own = hashes[offsets[i] : offsets[i + 1]]
        size = 1 << (len(own) - 1).bit_length()
        cells = (mix(own ^ U64(3)) % U64(size)).astype(np.int64)
        out[i] = np.packbits((np.bincount(cells, minlength=size) & 1).astype(bool)).tobytes()
    return out


def _parities_apart(x: np.ndarray, y: np.ndarray) -> int:
    """In how many cells two sketches differ, of the size of the shorter."""
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def _list_keys(rule: Rule, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all lists that each row is on, and the rows."""
    sizes = np.diff(offsets)
    marks = mix(hashes)
    keys, rows = [np.zeros(0, U64)], [np.zeros(0, np.int64)]

    def add(key: np.ndarray, row: np.ndarray, tag: int) -> None:
        keys.append(mix(key + mix(np.full(1, tag, U64))[0]))
        rows.append(row)

    totals = _sums(marks, offsets)
    known, which = np.unique(sizes, return_inverse=True)
    # Small sets list subsets: all elements, all but one, or all but two.
    for i, n in enumerate(known.tolist()):
        if n == 0 or n > rule.largest(rule.small):
            continue
        mine = np.flatnonzero(which == i)
        each = marks[offsets[mine][:, None] + np.arange(n)]
        for c in rule.subsets(n):
            if c == n:
                add(totals[mine], mine, c)
            elif c == n - 1:
                add((totals[mine][:, None] - each).ravel(), np.repeat(mine, n), c)
            else:
                a, b = np.array(list(combinations(range(n), 2))).T
                add((totals[mine][:, None] - each[:, a] - each[:, b]).ravel(), np.repeat(mine, len(a)), c)
    # Large sets are on the lists of their parts.
    levels = {n: rule.levels(n) for n in known.tolist()}
    prefix = np.concatenate([np.zeros(1, U64), np.cumsum(marks)])
    for level in sorted({x for own in levels.values() for x in own}):
        of_size = np.array([level in levels[n] for n in known.tolist()])
        mine = np.flatnonzero(of_size[which])
        parts, spare = rule.parts(level)
        count = sizes[mine]
        at = np.repeat(offsets[mine] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        row = np.repeat(np.arange(len(mine)), count)
        part = ((hashes[at] >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
        cell = row * parts + part
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        ends = np.append(first[1:], len(cell))
        sums = prefix[at[ends - 1] + 1] - prefix[at[first]]
        add(sums + mix((part[first] + 1).astype(U64)), mine[row[first]], level + (1 << 20))
        used = np.bincount(row[first], minlength=len(mine))
        hollow = np.flatnonzero(parts - used >= spare)
        add(np.zeros(len(hollow), U64), mine[hollow], level + (1 << 21))
    return np.concatenate(keys), np.concatenate(rows)


def sets(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """Each row's set: (_id, _row, n, h1, h2, sketch, longer), with ``_row`` a hash of the id and the text."""
    source = docs.select(F.col(doc_id).cast("long"), F.xxhash64(doc_id, text), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(2)):
                hashes, offsets = shingle_sets(piece, shingle)
                one, two = _identities(hashes, offsets)
                sketch = _sketches(hashes, offsets)
                own = batch.slice(piece.first, len(piece))
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column(0),
                        own.column(1),
                        pa.array(np.diff(offsets)),
                        long_array(one),
                        long_array(two),
                        pa.array([s.tobytes() for s in sketch], pa.binary()),
                        pa.array(_long_sketches(hashes, offsets), pa.binary()),
                    ],
                    names=["_id", "_row", "n", "h1", "h2", "sketch", "longer"],
                )

    return source.mapInArrow(run, "_id long, _row long, n long, h1 long, h2 long, sketch binary, longer binary")


def _memberships(docs: DataFrame, rule: Rule, text: str, shingle: int) -> DataFrame:
    """(list, h1) of all rows; copies in one batch come once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met: set[int] = set()
            for piece in pieces(batch.column(0)):
                hashes, offsets = shingle_sets(piece, shingle)
                one, _ = _identities(hashes, offsets)
                _, first = np.unique(one, return_index=True)
                first = np.array([i for i in np.sort(first).tolist() if int(one[i]) not in met], np.int64)
                met.update(one[first].tolist())
                sizes = np.diff(offsets)[first]
                at = np.repeat(offsets[first] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                keys, rows = _list_keys(rule, hashes[at], np.concatenate([[0], np.cumsum(sizes)]))
                yield pa.RecordBatch.from_arrays(
                    [long_array(keys), long_array(one[first][rows])], names=["list", "h1"]
                )

    return docs.select(text).mapInArrow(run, "list long, h1 long")


def _scan(rule: Rule) -> callable:
    """Pairs of one list whose sketches allow a link. Groups come one after the other."""

    def fitting(cols: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The pairs of rows that can link and for which the list is the first that they share."""
        list_, h1, n, sketch, first, group = cols[0], cols[3], cols[4], cols[5], cols[7], cols[8]
        found = []
        for i in range(0, len(a), 1 << 15):
            x, y = a[i : i + (1 << 15)], b[i : i + (1 << 15)]
            keep = 100 * np.minimum(n[x], n[y]) >= rule.percent * np.maximum(n[x], n[y])
            keep &= group[x] != group[y]
            x, y = x[keep], y[keep]
            apart = np.bitwise_count(sketch[x] ^ sketch[y]).sum(1, dtype=np.int64)
            keep = apart * (100 + rule.percent) <= (100 - rule.percent) * (n[x] + n[y])
            x, y = x[keep], y[keep]
            for j in range(0, len(x), 1 << 12):
                u, v = x[j : j + (1 << 12)], y[j : j + (1 << 12)]
                earlier = np.where(first[u] < list_[u][:, None], first[u], NO_LIST)
                shared = (earlier[:, :, None] == first[v][:, None, :]) & (earlier != NO_LIST)[:, :, None]
                u, v = (z[~shared.any((1, 2))] for z in (u, v))
                near = np.bitwise_count(sketch[u] ^ sketch[v]).sum(1, dtype=np.int64) * PARTS_APART // (n[u] + n[v])
                found.append(np.stack([np.minimum(h1[u], h1[v]), np.maximum(h1[u], h1[v]), near], 1))
        return np.concatenate(found) if found else np.zeros((0, 3), np.int64)

    def group(cols: list[np.ndarray], start: int, end: int) -> np.ndarray:
        side = cols[6][start:end]
        if (side == 2).any():
            i, j = np.triu_indices(end - start, 1)
        else:
            i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(side == 0), np.flatnonzero(side == 1), indexing="ij"))
        return fitting(cols, start + i, start + j)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def groups(cols: list[np.ndarray], last: bool) -> tuple[list[pa.RecordBatch], list[np.ndarray] | None]:
            key = np.stack(cols[:3])
            starts = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(0)))
            ends = np.append(starts[1:], key.shape[1])
            done = len(starts) if last else len(starts) - 1
            size = (ends - starts)[:done]
            # Most lists have two members; these are compared all at once.
            at = starts[:done][size == 2]
            at = at[(cols[6][at] == 2) | (cols[6][at] != cols[6][at + 1])] if len(at) else at
            found = [fitting(cols, at, at + 1)]
            found += [group(cols, starts[i], ends[i]) for i in np.flatnonzero(size > 2).tolist()]
            left = None if last else [c[starts[-1] :] for c in cols]
            both = np.unique(np.concatenate(found), axis=0)
            told = [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(both[:, 2] / PARTS_APART)]
            return [pa.RecordBatch.from_arrays(told, names=["a", "b", "apart"])], left

        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 3, 4)]
            raw = b"".join(batch.column(5).to_pylist())
            cols += [np.frombuffer(raw, U64).reshape(-1, SKETCH // 64), batch.column(6).to_numpy(zero_copy_only=False)]
            lists = batch.column(7)
            sizes = np.diff(lists.offsets.to_numpy())
            first = np.full((len(sizes), FIRST_LISTS), NO_LIST)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            first[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
            cols += [first, batch.column(8).to_numpy(zero_copy_only=False)]
            if rest is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(rest, cols)]
            if not len(cols[0]):
                continue
            out, rest = groups(cols, False)
            yield from out
        if rest is not None and len(rest[0]):
            yield from groups(rest, True)[0]

    return run


def shared_lists(members: DataFrame) -> DataFrame:
    """(list, h1, count) of lists with several members; lists of equal members are one."""
    per_list = Window.partitionBy("list")
    lists = (
        members.withColumns({"least": F.min("h1").over(per_list), "most": F.max("h1").over(per_list)})
        .where("least < most")
        .select("list", "h1")
        .distinct()
        .withColumns(
            {"all": F.bit_xor(F.xxhash64("h1")).over(per_list), "first": F.min("h1").over(per_list), "count": F.count("*").over(per_list)}
        )
        .select(F.xxhash64("all", "first", "count").alias("list"), "h1", "count")
        .distinct()
    )
    return written(lists, "lists")


def open_lists(lists: DataFrame, group: DataFrame | None) -> DataFrame:
    """(list, h1, count, group) of lists whose members are not all of one group; without groups each class
    is one."""
    if group is None:
        return lists.withColumn("group", F.col("h1"))
    told = lists.join(group.withColumnRenamed("v", "h1"), "h1", "left").withColumn("group", F.coalesce("component", "h1"))
    several = told.groupBy("list").agg(F.min("group").alias("least"), F.max("group").alias("most")).where("least < most")
    return written(told.join(several.select("list"), "list", "left_semi").select("list", "h1", "count", "group"), "open")


def _with_hubs(lists: DataFrame, classes: DataFrame, rule: Rule, longest: bool) -> DataFrame:
    """Pairs (a, b) of classes of different groups: each class and the hub, one member, of its longest list,
    that which shares lists with most others, or HUBS at most of the hubs of all its lists, members chosen by a hash.
    Their sketches allow a link."""
    mark = F.xxhash64("list", "h1").alias("mark")
    own, order, members = lists, [mark], lists
    if longest:
        own = lists.groupBy("h1", "group").agg(F.max(F.struct("count", "list")).getField("list").alias("list"))
        # Of near copies of one text, that with the fewest changes meets most others, and is nearest to them.
        met_by = lists.groupBy("h1").agg(F.sum("count").alias("met_by"))
        members, order = lists.join(met_by, "h1"), [(-F.col("met_by")).alias("fewest"), mark]
    hubs = members.groupBy("list").agg(F.min(F.struct(*order, "h1", "group")).alias("hub"))
    met = own.join(hubs.select("list", F.col("hub.h1").alias("to"), F.col("hub.group").alias("of")), "list").where("group <> of")
    if not longest:
        # Sets on many lists meet many hubs, and what is not asked here is scanned later.
        some = met.groupBy("h1", "group", F.pmod(F.xxhash64("to"), F.lit(HUBS)).alias("part"))
        met = some.agg(F.min(F.struct(mark, "to", "of")).alias("met")).select("h1", "group", "met.to", "met.of")
    first = F.col("h1") < F.col("to")
    pairs = met.select(
        F.least("h1", "to").alias("a"),
        F.greatest("h1", "to").alias("b"),
        F.when(first, F.col("group")).otherwise(F.col("of")).alias("a_of"),
        F.when(first, F.col("of")).otherwise(F.col("group")).alias("b_of"),
    ).distinct()
    side = lambda end: classes.select(
        F.col("h1").alias(end), F.col("n").alias(f"{end}_n"), F.col("sketch").alias(f"{end}_sketch")
    )
    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = sized.where(100 * F.least("a_n", "b_n") >= rule.percent * F.greatest("a_n", "b_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), U64).reshape(-1, SKETCH // 64) for i in (5, 7)
            )
            size = batch.column(4).to_numpy() + batch.column(6).to_numpy()
            apart = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
            keep = pa.array(apart * (100 + rule.percent) <= (100 - rule.percent) * size)
            told = pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(apart / size)], names=["a", "b", "a_of", "b_of", "apart"])
            yield told.filter(keep)

    columns = ("a", "b", "a_of", "b_of", "a_n", "a_sketch", "b_n", "b_sketch")
    return sized.select(*columns).mapInArrow(run, PAIR)


def _fitting(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs for which longer sketches, where both classes have these, allow a link as well; ``apart`` is by them."""
    side = lambda end: classes.where("longer IS NOT NULL").select(
        F.col("h1").alias(end), F.col("n").alias(f"{end}_n"), F.col("longer").alias(f"{end}_longer")
    )
    sized = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    names = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = dict(zip(batch.schema.names, batch.columns))
            apart = own["apart"].to_numpy().copy()
            both = own["a_longer"].is_valid().to_numpy(zero_copy_only=False) & own["b_longer"].is_valid().to_numpy(zero_copy_only=False)
            keep = np.ones(len(apart), bool)
            for i in np.flatnonzero(both).tolist():
                x, y = (np.frombuffer(own[c][i].as_buffer(), U64) for c in ("a_longer", "b_longer"))
                size = own["a_n"][i].as_py() + own["b_n"][i].as_py()
                differ = _parities_apart(x, y)
                keep[i] = differ * (100 + rule.percent) <= (100 - rule.percent) * size
                apart[i] = differ / size
            own["apart"] = pa.array(apart)
            yield pa.RecordBatch.from_arrays([own[c] for c in names], names=names).filter(pa.array(keep))

    return sized.select(*names, "a_n", "b_n", "a_longer", "b_longer").mapInArrow(run, pairs.schema)


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Of pairs between groups few for each group, those whose sketches are nearest: one link is enough to
    make two groups one, and pairs that are left out are looked at again."""
    ends = pairs.select("*", F.explode(F.array(F.struct(F.col("a_of").alias("of"), F.col("b_of").alias("to")), F.struct(F.col("b_of").alias("of"), F.col("a_of").alias("to")))).alias("end"))
    kept = ends.groupBy("end.of", F.pmod(F.xxhash64("end.to"), F.lit(PARTNERS)).alias("part")).agg(
        F.min(F.struct("apart", "a", "b")).alias("best")
    )
    return kept.select("best.a", "best.b").distinct()


def candidates(lists: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b, apart) of classes of different groups, a below b, that share a list and whose sketches allow a
    link; ``apart`` is how far these are from each other."""
    first = lists.groupBy("h1").agg(F.slice(F.sort_array(F.collect_list("list")), 1, FIRST_LISTS).alias("lists"))
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    known = classes.select("h1", "n", "sketch").join(first, "h1")
    told = lists.join(known, "h1").withColumn("blocks", blocks)
    own = F.pmod(F.xxhash64("h1", "list"), F.col("blocks")).cast("int")
    placed = told.withColumn("own", own).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    # Two rows of one block meet where it meets itself; else the lower block is side 0.
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    keyed = placed.select(
        "list",
        F.least("own", "other").cast("long").alias("i"),
        F.greatest("own", "other").cast("long").alias("j"),
        "h1",
        "n",
        "sketch",
        side.cast("long").alias("side"),
        "lists",
        "group",
    )
    ordered = keyed.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j")
    found = ordered.mapInArrow(_scan(rule), "a long, b long, apart double")
    return found.groupBy("a", "b").agg(F.min("apart").alias("apart"))


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, rule: Rule, doc_id: str, text: str, shingle: int) -> DataFrame:
    """The pairs (a, b) that link, compared element by element in the texts of the classes' first rows."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("h1")).distinct()
    first = classes.join(asked, "h1").select("h1", F.col("doc").alias("_doc"), F.col("row").alias("_at"))
    first = checked(first, "asked")
    texts = docs.select(F.col(doc_id).cast("long").alias("_of"), F.xxhash64(doc_id, text).alias("_is"), F.col(text).alias("text"))
    source = texts.join(first, F.expr("_is = _at AND _of <=> _doc")).select("h1", "text")

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(1)):
                hashes, offsets = shingle_sets(piece, shingle)
                rows = [hashes[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
                own = batch.slice(piece.first, len(piece)).columns[:1]
                yield pa.RecordBatch.from_arrays([*own, pa.array(rows, pa.binary())], names=["h1", "elements"])

    # Elements are moved once: both joins read what is dealt out here by class.
    each = source.mapInArrow(elements, "h1 long, elements binary").dropDuplicates(["h1"])
    side = lambda end: each.select(F.col("h1").alias(end), F.col("elements").alias(f"{end}_elements"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "a_elements", "b_elements")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= rule.percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return both.mapInArrow(compare, "a long, b long")


def _nearest(edges: DataFrame, turn: int) -> DataFrame:
    """(v, to): each end of an edge and that of its neighbours and itself which a hash of the turn puts first."""
    ends = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select("b", "a"))
    rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("to"))
    near = ends.groupBy("v").agg(F.min(rank("u")).alias("near"))
    return near.select("v", F.least(F.col("near"), rank("v")).getField("to").alias("to"))


def _relabelled(labels: DataFrame, step: DataFrame) -> DataFrame:
    """Labels (v, component) after a step (v, to) of some of the components."""
    step = step.select(F.col("v").alias("component"), "to")
    return labels.join(step, "component", "left").select("v", F.coalesce("to", "component").alias("component"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, component) of every end of a link; the component is one of its ends."""
    edges = written(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b"), "links")
    labels, turn = None, 0
    while not edges.isEmpty():
        turn += 1
        joined = written(_nearest(edges, turn), "joined")
        labels = joined.withColumnRenamed("to", "component") if labels is None else _relabelled(labels, joined)
        edges = written(
            edges.join(joined.select(F.col("v").alias("a"), F.col("to").alias("x")), "a")
            .join(joined.select(F.col("v").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "links",
        )
        if turn % ROUNDS_A_PLAN == 0:
            labels = written(labels, "labels")
    if labels is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("component"))
    return written(labels, "labels")


def _stars(links: DataFrame) -> DataFrame:
    """(v, component) of the ends of links: the least class within two steps, which for a hub and those that
    link with it is the same. Some that are connected may still be apart."""
    ends = links.select(F.col("a").alias("v"), F.col("b").alias("u")).union(links.select("b", "a"))
    near = ends.groupBy("v").agg(F.least("v", F.min("u")).alias("least"))
    further = ends.join(near.select(F.col("v").alias("u"), F.col("least").alias("of")), "u")
    further = further.groupBy("v").agg(F.min("of").alias("of"))
    return written(near.join(further, "v").select("v", F.least("least", "of").alias("component")), "stars")


def _merged(group: DataFrame | None, links: DataFrame) -> DataFrame:
    """Groups (v, component) after further links."""
    if group is None:
        return components(links)
    ends = links.select(F.explode(F.array("a", "b")).alias("v")).distinct()
    own = written(
        ends.join(group, "v", "left").select("v", F.coalesce("component", "v").alias("component")), "ends"
    )
    side = lambda end: own.select(F.col("v").alias(end), F.col("component").alias(f"{end}_of"))
    between = links.join(side("a"), "a").join(side("b"), "b").select(F.col("a_of").alias("a"), F.col("b_of").alias("b"))
    step = components(between.distinct()).withColumnRenamed("component", "to")
    every = group.unionByName(own.join(group, "v", "left_anti"))
    return written(_relabelled(every, step), "groups")


def _between(pairs: DataFrame, group: DataFrame) -> DataFrame:
    """The pairs of classes of different groups, with these."""
    side = lambda end: group.select(F.col("v").alias(end), F.col("component").alias(f"{end}_in"))
    told = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    told = told.withColumns({f"{end}_of": F.coalesce(f"{end}_in", end) for end in ("a", "b")})
    return told.where("a_of <> b_of").select("a", "b", "a_of", "b_of", "apart")


def _prepared(docs: DataFrame, doc_id: str, text: str, shingle: int, percent: int) -> tuple[DataFrame, DataFrame, Rule, DataFrame]:
    """The rows' sets, the classes of equal sets, the rule and the lists."""
    each = written(sets(docs, doc_id=doc_id, text=text, shingle=shingle), "sets")
    in_order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")
    classes = written(
        each.where("n > 0")
        .groupBy("h1", "h2", "n")
        .agg(F.min(in_order).alias("first"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("sketch", "longer")])
        .select("h1", "h2", "n", F.col("first._id").alias("doc"), F.col("first._row").alias("row"), "copies", "sketch", "longer"),
        "classes",
    )
    sizes = classes.where(F.col("n") <= MOST_SMALL).groupBy("n").count().collect()
    rule = Rule(percent, boundary(percent, {r["n"]: r["count"] for r in sizes}))
    return each, classes, rule, shared_lists(_memberships(docs, rule, text, shingle))


def links(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """All links (a, b) between different sets, and which rows have these: (_id, _row, set, copies).

    Rows of one set link with each other, and with all rows of a set that theirs links with.
    """
    each, classes, rule, lists = _prepared(docs, doc_id, text, shingle, percent)
    pairs = written(_fitting(candidates(open_lists(lists, None), classes, rule), classes, rule).select("a", "b"), "pairs")
    found = written(verified(pairs, classes, docs, rule, doc_id, text, shingle), "links")
    of = classes.select("h1", "h2", "copies")
    return found, each.where("n > 0").join(of, ["h1", "h2"]).select("_id", "_row", F.col("h1").alias("set"), "copies")


def groups(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """One row for each row of the table: (_id, _row, n_shingles, component_id, _group).

    ``component_id`` is the smallest id that links lead to, the row's own included; ``_group`` is equal for
    rows of one group and null for those of empty sets.
    """
    each, classes, rule, lists = _prepared(docs, doc_id, text, shingle, percent)
    check = lambda pairs: written(verified(pairs, classes, docs, rule, doc_id, text, shingle), "links")
    # Each class and the hub of its longest list; what is connected but still apart is found with the next links.
    hubs = lambda group, longest: _fitting(_with_hubs(open_lists(lists, group), classes, rule, longest), classes, rule)
    first = check(written(hubs(None, True).select("a", "b"), "pairs"))
    group = _stars(first)
    pairs = written(_likeliest(written(hubs(group, False), "hubs")), "pairs")
    group = components(first.union(check(pairs)))
    # All pairs of classes that are still of different groups: the likeliest first, then those for which that was not enough.
    rest = written(_fitting(candidates(open_lists(lists, group), classes, rule), classes, rule), "rest")
    if not rest.isEmpty():
        group = _merged(group, check(written(_likeliest(_between(rest, group)), "pairs")))
        pairs = written(_between(rest, group).select("a", "b"), "pairs")
        if not pairs.isEmpty():
            group = _merged(group, check(pairs))
    known = classes.select("h1", "h2", F.col("h1").alias("_group"), F.col("doc").alias("component_id"))
    if not group.isEmpty():
        linked = classes.select("h1", "h2", "doc").join(group.withColumnRenamed("v", "h1"), "h1")
        smallest = checked(linked.groupBy("component").agg(F.min("doc").alias("component_id")), "smallest")
        linked = linked.join(smallest, "component").select("h1", "h2", F.col("component").alias("_group"), "component_id")
        known = known.join(group.select(F.col("v").alias("h1")), "h1", "left_anti").unionByName(linked)
    empty = each.where("n = 0").select("_id", "_row", "n", F.lit(None).cast("long").alias("_group"), F.col("_id").alias("component_id"))
    some = each.where("n > 0").join(known, ["h1", "h2"]).select("_id", "_row", "n", "_group", "component_id")
    return some.unionByName(empty).select("_id", "_row", F.col("n").alias("n_shingles"), "component_id", "_group")


def keep_first(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The table without near duplicates: of each group one row stays, that of the smallest id.

    Of rows of one id, and of groups of rows without an id, the row that stays is chosen by a hash of the text.
    All rows without words stay, but of those that are repeated one.
    """
    grouped = groups(docs, doc_id=doc_id, text=text, shingle=shingle, percent=percent)
    grouped = written(grouped.select("_id", "_row", "_group"), "grouped")
    in_order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")
    chosen = grouped.where("_group IS NOT NULL").groupBy("_group").agg(F.min(in_order).alias("first"))
    stay = chosen.select("first._id", "first._row").unionByName(grouped.where("_group IS NULL").select("_id", "_row")).distinct()
    times = grouped.groupBy("_id", "_row").agg(F.count("*").alias("times"))
    stay = stay.alias("s").join(times.alias("t"), F.expr("s._row = t._row AND s._id <=> t._id"))
    stay = checked(stay.select("s._id", "s._row", "times"), "stay")
    keyed = docs.withColumns({"_of": F.col(doc_id).cast("long"), "_at": F.xxhash64(doc_id, text)})
    kept = keyed.join(stay, F.expr("_at = _row AND _of <=> _id")).drop("_id", "_row")
    # Only rows that are repeated are compared with each other.
    single, repeated = kept.where("times = 1"), kept.where("times > 1").dropDuplicates(["_of", "_at"])
    return single.unionByName(repeated).select(*docs.columns)


def groups_oracle(shingle: int, percent: int) -> str:
    """DuckDB SQL for n_shingles and component_id by doc_id, for ids that are unique and not null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    doc_words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + {shingle} - 1), ' ') AS shingle
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {shingle}, 0) + 2)) AS s FROM doc_words WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * c >= {percent} * (x.n + y.n - c)),
    reached AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
    grouped AS (
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, g.component_id
        FROM documents d LEFT JOIN sizes s USING (doc_id)
        JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) g USING (doc_id))"""
