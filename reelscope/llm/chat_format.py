"""Chat formatting with loss flags, from a declarative template.

Method: a finite-state machine over the roles validates the order of turns
(``TRANSITIONS``); each turn emits text segments after its role's entry in a
template, each with a flag that says whether it is trained on.  Built-in
functions only: segments are made turn by turn and the loss spans are running
sums of their lengths over a window of the conversation; only what a training
example consists of is gathered into one row, once, in time in proportion to it.

Escaping: the characters that control strings are made of (``<``, ``>``,
``[`` and the escape character ``\\``) are each followed by ``\\`` inside
texts and role names.  No control string can then occur there, and dropping
the character after each of them restores the text exactly.

A conversation is one training example, so its segments meet in one row, which
Spark holds to 2 GB; their order is by turn, then role and text where a turn is
repeated.

Defined cases: a null text is empty, a null role is the empty role.  Roles
without an entry of their own are formatted under ``OTHER`` with their name
and without loss, and make the order invalid, as does any order the machine
does not accept; such conversations are formatted all the same and marked
``valid = false``.  Turns without a conversation id form one conversation
with a null id.  Repeated rows are turns of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Part:
    """How one role's turn is written; ``loss``: its text is trained on."""

    before: str
    after: str
    loss: bool


TEMPLATE = {
    "system": Part("<<SYS>>\n", "<</SYS>>\n", False),
    "user": Part("[INST] ", "[/INST] ", False),
    "assistant": Part("<s>", "</s>\n", True),
}
# Any other role: its name stands between the two strings of the opening.
OTHER = (("<<ROLE ", ">>\n"), "<</ROLE>>\n")

# State after a role; a conversation ends in any state but "start" and "invalid".
TRANSITIONS = {
    ("start", "system"): "system",
    ("start", "user"): "user",
    ("system", "user"): "user",
    ("user", "assistant"): "assistant",
    ("assistant", "user"): "user",
}

# Characters a block in which spans are looked up.
BLOCK = 512

_SPECIAL = r"([<>\[\\])"
_BODY = r"(?:[^<>\[\\]++|[<>\[\\]\\)*+"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _SPECIAL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _SPECIAL + r"\\", "$1")


def _by_role(role: Column, of_part, otherwise) -> Column:
    return reduce(
        lambda rest, item: F.when(role == item[0], of_part(item[1])).otherwise(rest),
        reversed(TEMPLATE.items()),
        otherwise,
    )


def _state(roles: Column) -> Column:
    def step(state: Column, role: Column) -> Column:
        return reduce(
            lambda rest, rule: F.when((state == rule[0][0]) & (role == rule[0][1]), F.lit(rule[1])).otherwise(rest),
            TRANSITIONS.items(),
            F.lit("invalid"),
        )

    return F.aggregate(roles, F.lit("start"), step)


def _segments() -> Column:
    """The three segments of the turn (``role``, ``text``)."""
    role = F.col("role")
    (left, right), after = OTHER
    opening = F.concat(F.lit(left), escape(role), F.lit(right))
    before = _by_role(role, lambda p: F.lit(p.before), opening)
    closing = _by_role(role, lambda p: F.lit(p.after), F.lit(after))
    loss = _by_role(role, lambda p: F.lit(p.loss), F.lit(False))

    def segment(text: Column, flag: Column) -> Column:
        return F.struct(text.alias("text"), flag.alias("loss"))

    return F.array(segment(before, F.lit(False)), segment(escape(F.col("text")), loss), segment(closing, F.lit(False)))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, valid, segments, formatted, loss_spans`` for every conversation.

    ``segments``: array of (text, loss) in order; ``formatted``: their texts
    laid end to end; ``loss_spans``: (start, length) in characters, from 0,
    of the parts of ``formatted`` that are trained on.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sizes = F.transform("segments", lambda s: F.length(s["text"]).cast("bigint"))
    placed = (
        turns.withColumn("segments", _segments())
        .withColumn("sizes", sizes)
        .withColumn("size", F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b))
        .select(
            "conv_id",
            "role",
            "segments",
            "sizes",
            F.row_number().over(order).alias("place"),
            F.coalesce(F.sum("size").over(before), F.lit(0)).alias("at"),
        )
    )
    span = F.when(
        F.col("segments")[1]["loss"],
        F.struct((F.col("at") + F.col("sizes")[0]).alias("start"), F.col("sizes")[1].alias("length")),
    )
    gathered = (
        placed.select("conv_id", F.struct("place", "role", "segments", span.alias("span")).alias("turn"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select(
            "conv_id",
            _state(F.col("turns.role")).alias("state"),
            F.flatten("turns.segments").alias("segments"),
            F.filter("turns.span", lambda s: s.isNotNull()).alias("loss_spans"),
        )
    )
    return gathered.select(
        "conv_id",
        (~F.col("state").isin("start", "invalid")).alias("valid"),
        "segments",
        F.array_join("segments.text", "").alias("formatted"),
        "loss_spans",
    )


def _turn_pattern() -> str:
    def quoted(text: str) -> str:
        return r"\Q" + text + r"\E"

    (left, right), after = OTHER
    own = [quoted(p.before) + _BODY + quoted(p.after) for p in TEMPLATE.values()]
    return "|".join([*own, quoted(left) + _BODY + quoted(right) + _BODY + quoted(after)])


def read_turns(formatted: Column) -> Column:
    """The turns (``role``, ``text``) back from a formatted conversation."""
    (left, right), after = OTHER

    def of(turn: Column) -> Column:
        def inner(before: int, behind: int) -> Column:
            return F.substring(turn, F.lit(before + 1), F.length(turn) - (before + behind))

        name = F.regexp_extract(turn, r"^\Q" + left + r"\E(" + _BODY + ")", 1)
        body = F.substring(
            turn,
            F.length(name) + (len(left) + len(right) + 1),
            F.length(turn) - F.length(name) - (len(left) + len(right) + len(after)),
        )
        role = F.when(turn.startswith(left), unescape(name))
        text = body
        for key, part in reversed(TEMPLATE.items()):
            here = turn.startswith(part.before)
            role = F.when(here, F.lit(key)).otherwise(role)
            text = F.when(here, inner(len(part.before), len(part.after))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(_turn_pattern()), F.lit(0)), of)


def loss_text(blocks: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between.

    ``blocks``: the formatted text in blocks of ``BLOCK`` characters, so that a span
    is cut out of the blocks it lies in and not searched from the beginning.
    """

    def cut(s: Column) -> Column:
        first, past = F.floor(s["start"] / BLOCK), F.ceil((s["start"] + s["length"]) / BLOCK)
        inside = F.array_join(F.slice(blocks, first.cast("int") + 1, F.greatest(past - first, F.lit(0)).cast("int")), "")
        return unescape(F.substring(inside, (s["start"] - first * BLOCK).cast("int") + 1, s["length"].cast("int")))

    return F.array_join(F.transform(spans, cut), "")


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """What reading ``format_conversations``' output back gives, as counts and digests."""
    turns = read_turns(F.col("formatted"))
    # a column of its own, as every span reads it
    blocks = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("blocks")
    rows = formatted.select("*", blocks).select(
        "conv_id",
        "valid",
        turns.alias("turns"),
        F.when(F.size("blocks") > 0, loss_text(F.col("blocks"), F.col("loss_spans"))).otherwise("").alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )
