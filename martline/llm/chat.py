"""Chat formatting (native): a role automaton, a declarative template, per-segment loss flags.

``format_chat`` turns rows (conversation, turn, role, text) into one row per conversation with its text
segments, the flag of each segment that tells whether it counts for the loss, and the formatted string.
Everything is DataFrame functions.

Control strings inside roles and texts are escaped reversibly: behind every ``<`` that is followed by any
number of backslashes and then a bar, one backslash is added. No escaped text holds ``<|``, so the markers of
the template can't be forged, and taking one backslash away restores the text.

Cases: null text is the empty text; null role is the empty role (not in the automaton, so the turn order is
invalid there); rows with equal turn are ordered by role and text; null turns come first; repeated rows stay
repeated turns; rows with a null conversation form one conversation with a null id; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Markers around a turn, roles whose text is under the loss, and the automaton over roles.

    Markers must begin with ``<|`` so that escaped text can't hold them."""

    begin: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>"
    after_turn: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant",)})
    final: tuple[str, ...] = ("assistant",)


#: Stands for the string after a role inside a role; ``<|`` can't come from escaped text.
_BREAK = "<|n|>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", "<$1|")


def _state(roles: Column, t: Template) -> Column:
    """Last state and number of the first turn (from 1) that the automaton refuses, 0 if none."""
    allowed = F.array(*[F.lit(f"{a}>{b}") for a, bs in t.moves.items() for b in bs])
    first = F.struct(F.lit(t.start).alias("at"), F.lit(0).alias("n"), F.lit(0).alias("bad"))

    def move(s: Column, role: Column) -> Column:
        ok = F.array_contains(allowed, F.concat(s["at"], F.lit(">"), role))
        return F.struct(role.alias("at"), (s["n"] + 1).alias("n"),
                        F.when(s["bad"] > 0, s["bad"]).when(ok, 0).otherwise(s["n"] + 1).alias("bad"))

    return F.aggregate(roles, first, move)


def format_chat(df: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, valid, bad_turn, segments array<struct<text, loss>>, formatted).

    ``valid``: the automaton accepts the roles in order and ends in a final state; ``bad_turn`` is the first
    refused turn (from 1), 0 if none. Invalid conversations are formatted too; callers decide what to drop.
    """
    rows = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    t = template

    def segments(x: Column) -> Column:
        seg = lambda c, loss: F.struct(c.alias("text"), loss.alias("loss"))
        no = F.lit(False)
        return F.array(seg(F.concat(F.lit(t.begin), F.replace(escape(x["role"]), F.lit(t.after_role), F.lit(_BREAK)), F.lit(t.after_role)), no),
                       seg(escape(x["text"]), x["role"].isin(list(t.loss_roles))),
                       seg(F.lit(t.end + t.after_turn), no))

    out = turns.select("conv_id", F.size("t").cast("long").alias("n_turns"),
                       _state(F.transform("t", lambda x: x["role"]), t).alias("s"),
                       F.flatten(F.transform("t", segments)).alias("segments"))
    return out.select("conv_id", "n_turns", ((F.col("s.bad") == 0) & F.col("s.at").isin(list(t.final))).alias("valid"),
                      F.col("s.bad").alias("bad_turn"), "segments",
                      F.array_join(F.transform("segments", lambda x: x["text"]), "").alias("formatted"))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """Turns (role, text) read back from a formatted string: the inverse of ``format_chat``."""
    t = template
    # the first piece is what stands before the first marker: nothing
    parts = F.split(formatted, _quoted(t.begin))
    parts = F.slice(parts, F.lit(2), F.size(parts))

    def turn(p: Column) -> Column:
        cut = F.locate(t.after_role, p)
        rest = F.substring(p, cut + len(t.after_role), F.length(p))
        text = F.substring(rest, F.lit(1), F.length(rest) - len(t.end + t.after_turn))
        role = F.replace(F.substring(p, F.lit(1), cut - 1), F.lit(_BREAK), F.lit(t.after_role))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda x: x["loss"]), lambda x: unescape(x["text"])), "")


def _quoted(s: str) -> str:
    return "\\Q" + s + "\\E"
