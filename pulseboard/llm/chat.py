r"""Conversations as training texts, from a declarative template.

A template names the strings around each turn, the roles whose texts are learned, and a
finite-state machine over roles: which role may follow which, beginning with START, and after
which a conversation may end. ``segments`` gives the formatted text in pieces, one row each, with
a loss flag: the piece before a turn's text, the text, and the piece after it. The state of the
machine after a turn is the turn's role, so a turn is valid if the template allows its role after
that of the turn before it; ``valid`` says so for each turn, and ``status`` for whole
conversations, with the first turn that breaks the order.

Texts and roles are escaped so that no string of the template can occur in them: a backslash becomes
two, ``<`` becomes ``\l`` and ``>`` becomes ``\g``. ``unescaped`` turns that back, and ``parsed`` reads
turns from a formatted conversation.

Only column expressions, windows and aggregations. Segments are made turn by turn; a conversation
comes together in one value only where it is asked for as one text (``formatted``).

Defined results: rows are ordered by turn (null first), then by role and text, so that ties and
repeated rows have a place; a repeated turn keeps all its rows. A null text counts as empty, a null
role as an empty role, which no template allows. Rows without a conversation id are one
conversation with a null id. Other columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START = ""


@dataclass(frozen=True)
class Template:
    """``before`` has {role} where the role goes, and ends in ``>``; no string but the template's
    own may hold ``<`` or ``>``."""

    before: tuple[str, str] = ("<turn:", ">")
    after: str = "</turn>"
    learned: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    ends: tuple[str, ...] = ("assistant",)


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("<"), F.lit("\\l"))
    return F.replace(text, F.lit(">"), F.lit("\\g"))


def unescaped(text: Column) -> Column:
    """The original of an escaped text. Between two double backslashes no other can begin one."""

    def marks(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), marks), "\\")


def turns(conversations: DataFrame, template: Template) -> DataFrame:
    """(conv_id, place, role, text, valid): the rows in order, ``place`` from 1."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    before = F.coalesce(F.lag("role").over(order), F.lit(START))
    allowed = F.lit(False)
    for state, roles in template.follows.items():
        first = F.row_number().over(order) == 1
        allowed = allowed | ((before == state) & (first if state == START else ~first) & F.col("role").isin(*roles))
    return rows.select("conv_id", F.row_number().over(order).alias("place"), "role", "text", allowed.alias("valid"))


def segments(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, place, part, segment, loss, valid): the formatted text in pieces, in order of
    ``place`` and ``part``."""
    template = template or Template()
    head = F.concat(F.lit(template.before[0]), escaped(F.col("role")), F.lit(template.before[1]))
    learned = F.col("role").isin(*template.learned)
    pieces = F.array(
        F.struct(F.lit(0).alias("part"), head.alias("segment"), F.lit(False).alias("loss")),
        F.struct(F.lit(1).alias("part"), escaped(F.col("text")).alias("segment"), learned.alias("loss")),
        F.struct(F.lit(2).alias("part"), F.lit(template.after).alias("segment"), F.lit(False).alias("loss")),
    )
    return turns(conversations, template).select(
        "conv_id", "place", F.explode(pieces).alias("piece"), "valid"
    ).select("conv_id", "place", "piece.part", "piece.segment", "piece.loss", "valid")


def _role(template: Template) -> Column:
    """The role in the piece before a turn's text."""
    return unescaped(
        F.substring("segment", len(template.before[0]) + 1, F.length("segment") - len("".join(template.before)))
    )


def _states(of_turn: Column, role: Column) -> list[Column]:
    """The first turn that breaks the order, and the state in which the machine ends."""
    return [
        F.min(F.when(of_turn & ~F.col("valid"), F.col("place"))).alias("first_bad"),
        F.max_by(F.when(of_turn, role), F.when(of_turn, F.col("place"))).alias("last"),
    ]


def _accepted(template: Template) -> Column:
    return F.col("first_bad").isNull() & F.col("last").isin(*template.ends)


def status(pieces: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, n_turns, valid, first_bad): whether the machine accepts each conversation."""
    template = template or Template()
    heads = pieces.where("part = 0")
    told = heads.groupBy("conv_id").agg(F.count("*").alias("n_turns"), *_states(F.lit(True), _role(template)))
    return told.select("conv_id", "n_turns", _accepted(template).alias("valid"), "first_bad")


def formatted(pieces: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, formatted, loss_text, valid, first_bad): each conversation as one text, its learned pieces,
    unescaped, with nothing between them, and what ``status`` says of it."""
    template = template or Template()
    of_turn = F.col("part") == 0
    whole = pieces.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "part", "segment", "loss"))).alias("all"),
        *_states(of_turn, _role(template)),
    )
    learned = F.transform(F.filter("all", lambda s: s["loss"]), lambda s: unescaped(s["segment"]))
    return whole.select(
        "conv_id",
        F.array_join("all.segment", "").alias("formatted"),
        F.array_join(learned, "").alias("loss_text"),
        _accepted(template).alias("valid"),
        "first_bad",
    )


def parsed(text: Column, template: Template | None = None) -> Column:
    """The turns of a formatted conversation: an array of (role, text)."""
    template = template or Template()
    parts = F.split(text, _literal(template.after), -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        head = F.substring_index(part, template.before[1], 1)
        body = F.substring(part, F.length(head) + len(template.before[1]) + 1, F.length(part))
        role = F.substring(head, F.lit(len(template.before[0]) + 1), F.length(head))
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(parts, turn)


def _literal(text: str) -> str:
    """A pattern for the text itself."""
    return "\\Q" + text + "\\E"
