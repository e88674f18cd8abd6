"""SentencePiece encoding and decoding of whole texts, for merge-type models with byte fallback.

The encoder does not replay merges. It takes the longest piece at a position (an Aho-Corasick
automaton of the pieces finds it), accepts it if it can stand after the piece before it, else tries the next shorter piece, else steps back; positions from which nothing fits
are kept in a bit field and never tried again. Two pieces can stand side by side if merging
their concatenation anew gives back the two. A sequence in which all neighbours are
compatible is the one that the merges make, so the result is exact.

Text is first cut where no piece of the vocabulary can reach across: before a space that
follows another character, and around characters that occur in no longer piece. Equal cuts
have equal ids, which a task remembers in a bounded table.

Defined results: a null text counts as empty and has only the begin and end ids; characters
outside the vocabulary become their bytes; decoding ids that are no valid UTF-8 gives U+FFFD
for each such byte. Rows are independent, so repeated rows, ties and any further columns stay
as they are; a column that has the name of a new one is replaced.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
# Entries of a worker's table of cuts, and the longest cut that is kept there.
TABLE_SIZE = 300_000
TABLE_CHARS = 48


@dataclass(frozen=True)
class Vocabulary:
    """What a model file says: its pieces in order of ids, their scores and kinds."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    hidden: frozenset[int]  # control and unknown ids, which no text gives
    byte_ids: tuple[int, ...]
    begin: int
    end: int
    dummy_prefix: bool


def read_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a model file that the driver can read."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = tuple(model.id_to_piece(i) for i in ids)
    by_name = {p: i for i, p in enumerate(pieces)}
    byte_ids = tuple(by_name.get(f"<0x{b:02X}>", -1) for b in range(256))
    if -1 in byte_ids:
        raise ValueError("the model has no byte fallback")
    if any(map(model.is_unused, ids)):
        raise ValueError("models with unused pieces are not supported")
    return Vocabulary(
        pieces,
        tuple(model.get_score(i) for i in ids),
        frozenset(i for i in ids if model.is_control(i) or model.is_unknown(i)),
        byte_ids,
        model.bos_id(),
        model.eos_id(),
        model.decode(model.encode("a")) == "a" and model.encode("a", out_type=str)[0][0] == SPACE,
    )


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("each_byte", _each_byte)


class Encoder:
    """Encodes and decodes texts; made once in each Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.vocabulary = vocabulary
        text_ids = [
            i
            for i in range(len(vocabulary.pieces))
            if i not in vocabulary.hidden and i not in set(vocabulary.byte_ids)
        ]
        self.rank = {vocabulary.pieces[i]: -vocabulary.scores[i] for i in text_ids}
        self.ids = {vocabulary.pieces[i]: i for i in text_ids}
        self.compatible: dict[tuple[str, str], bool] = {}
        # The ids of cuts met lately; when full, the table becomes the one looked at second.
        self.table: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        # The two pieces that a piece is merged from; None for a character. A piece that the
        # merges do not make from its own characters never comes out.
        self.halves: dict[str, tuple[str, str] | None] = {}
        made = [p for p in self.ids if self.merged(p) == [p]]
        self.automaton = ahocorasick.Automaton()
        for p in made:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.longest = max(map(len, made))
        keep = set(made)
        self.shorter = {
            p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in keep), None) for p in made
        }
        # The longest piece that begins a path of the automaton.
        self.begins = {p[:n]: None for p in made for n in range(1, len(p) + 1)}
        for path in sorted(self.begins, key=len):
            self.begins[path] = path if path in keep else self.begins.get(path[:-1])
        self.id_bytes = {p: self.ids[p].to_bytes(4, "little") for p in made}
        self.byte_ids = [i.to_bytes(4, "little") for i in vocabulary.byte_ids]
        self.known = re.compile("[" + re.escape("".join(p for p in self.ids if len(p) == 1)) + "]+")
        long = [p for p in self.ids if len(p) > 1]
        crossed = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in long)
        alone = "".join(c for c in "\n\t" if not any(c in p for p in long))
        self.cuts = re.compile(
            r"[\s\S]+" if crossed else f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + f"|[{alone}]" * bool(alone)
        )
        self.texts = [p.replace(SPACE, " ").encode() for p in vocabulary.pieces]
        for b, i in enumerate(vocabulary.byte_ids):
            self.texts[i] = bytes([b])
        for i in vocabulary.hidden:
            self.texts[i] = b""

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging: the best pair first, the leftmost of equals."""
        rank, parts = self.rank, list(text)
        halves = None
        while True:
            pairs = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
            if not pairs:
                if len(parts) == 1:
                    self.halves[text] = halves
                return parts
            _, i = min(pairs)
            halves = parts[i], parts[i + 1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether merging anew keeps the border between two pieces.

        Their merges are undone, the latest first. The border falls if at some time the two
        pieces at it could merge with each other before the merge just undone took place.
        """
        rank, halves = self.rank, self.halves
        undone = None  # the merge just undone, as rank and whether the border's pair comes before equals
        while True:
            across = rank.get(left + right)
            if across is not None and (undone is None or (across, 0) < undone):
                return False
            in_left, in_right = halves[left], halves[right]
            if in_left is None and in_right is None:
                return True
            if in_right is None or (in_left is not None and rank[left] > rank[right]):
                undone, left = (rank[left], 0), in_left[1]
            else:
                undone, right = (rank[right], 1), in_right[0]

    def backtrack(self, text: str) -> list[str]:
        """The pieces of a text all of whose characters are in the vocabulary."""
        failed = bytearray((len(text) >> 3) + 1)
        shorter, compatible, begins = self.shorter, self.compatible, self.begins
        walk, size = self.automaton.longest_prefix, self.longest
        out: list[str] = []
        at, last = 0, None
        piece = begins[text[: walk(text[:size])]] if text else None
        while at < len(text):
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if last is None:
                        break
                    fits = compatible.get((last, piece))
                    if fits is None:
                        if len(compatible) >= TABLE_SIZE:
                            compatible.clear()
                        fits = compatible[last, piece] = self.fits(last, piece)
                    if fits:
                        break
                piece = shorter[piece]
            if piece is not None:
                out.append(piece)
                at, last = end, piece
                if at < len(text):
                    piece = begins[text[at : at + walk(text[at : at + size])]]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
                last = out[-1] if out else None
        return out

    def cut_ids(self, cut: str) -> bytes:
        if self.known.fullmatch(cut):
            return b"".join(map(self.id_bytes.__getitem__, self.backtrack(cut)))
        ids, at = [], 0
        for i, char in enumerate(cut):
            if char not in self.ids:
                ids += [self.id_bytes[p] for p in self.backtrack(cut[at:i])]
                ids += [self.byte_ids[b] for b in char.encode()]
                at = i + 1
        ids += [self.id_bytes[p] for p in self.backtrack(cut[at:])]
        return b"".join(ids)

    def encode(self, text: str) -> bytes:
        """The ids of a text without begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.vocabulary.dummy_prefix:
            text = " " + text
        cuts = self.cuts.findall(text.replace(" ", SPACE))
        table, before, long = self.table, self.before, []
        for cut in cuts:
            if cut not in table:
                table[cut] = before.get(cut) or self.cut_ids(cut)
                if len(cut) > TABLE_CHARS:
                    long.append(cut)
        ids = b"".join(map(table.__getitem__, cuts))
        for cut in long:
            del table[cut]
        if len(table) > TABLE_SIZE:
            self.table, self.before = {}, table
        return ids

    def forget(self) -> None:
        """Empties the tables that grow with the texts."""
        self.table, self.before, self.compatible = {}, {}, {}

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.texts.__getitem__, ids.tolist()))
        if self.vocabulary.dummy_prefix and data[:1] == b" ":
            shown = next(i for i in ids.tolist() if i not in self.vocabulary.hidden)
            if self.vocabulary.pieces[shown][0] == SPACE:
                data = data[1:]
        return data.decode("utf-8", "each_byte")


@lru_cache(maxsize=1)
def _encoder(vocabulary: Vocabulary) -> Encoder:
    """A worker's encoder, kept from task to task; its tables are a task's own, as the worker may go on to other stages."""
    return Encoder(vocabulary)


def encode(
    docs: DataFrame,
    model_path: str,
    *,
    text: str = "text",
    ids: str = "ids",
    decoded: str | None = None,
    add_begin: bool = True,
    add_end: bool = True,
    keep_text: bool = True,
    width: int = 4,
) -> DataFrame:
    """All columns of the table, and the ids of each text as little-endian unsigned 32-bit
    integers in one binary value; with ``decoded``, also the text that these ids decode to.
    ``width`` gives integers of two bytes instead, for vocabularies that these can number;
    ``keep_text=False`` leaves the text out.

    The vocabulary goes to the executors once (its size is the model file's, whatever the
    tables are); each task encodes its own rows, without a shuffle.
    """
    spark = docs.sparkSession
    new = {n.lower() for n in (ids, decoded) if n}
    if text.lower() in new:
        raise ValueError("the results need names other than the text's")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in new])
    read = read_vocabulary(model_path)
    if width not in (2, 4) or len(read.pieces) > 1 << 8 * width:
        raise ValueError(f"ids do not fit integers of {width} bytes")
    vocabulary = spark.sparkContext.broadcast(read)
    at = docs.columns.index(text)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]
    schema = T.StructType([*[docs.schema.fields[i] for i in kept], T.StructField(ids, T.BinaryType(), False)])
    if decoded:
        schema = schema.add(decoded, T.StringType(), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        begin = vocabulary.value.begin.to_bytes(4, "little") if add_begin else b""
        end = vocabulary.value.end.to_bytes(4, "little") if add_end else b""
        try:
            for whole in batches:
                for i in range(0, whole.num_rows, 1000):
                    batch = whole.slice(i, 1000)
                    rows = [begin + encoder.encode(t or "") + end for t in batch.column(at).to_pylist()]
                    back = [encoder.decode(np.frombuffer(r, "<u4")) for r in rows] if decoded else None
                    if width < 4:
                        rows = [np.frombuffer(r, "<u4").astype(f"<u{width}").tobytes() for r in rows]
                    columns = [*[batch.column(k) for k in kept], pa.array(rows, pa.binary())]
                    if decoded:
                        columns.append(pa.array(back, pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        finally:
            encoder.forget()

    return docs.mapInArrow(run, schema)


def decode(table: DataFrame, model_path: str, *, ids: str = "ids", text: str = "text") -> DataFrame:
    """All columns of the table, and the text that its binary ids decode to (null: empty)."""
    if text.lower() == ids.lower():
        raise ValueError("the text needs a name other than the ids'")
    table = table.select(*[c for c in table.columns if c.lower() != text.lower()])
    vocabulary = table.sparkSession.sparkContext.broadcast(read_vocabulary(model_path))
    schema = T.StructType([*table.schema.fields, T.StructField(text, T.StringType(), False)])
    at = table.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        for batch in batches:
            rows = [encoder.decode(np.frombuffer(r or b"", "<u4")) for r in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.string())], names=schema.names)

    return table.mapInArrow(run, schema)
