"""Chat formatting: a finite-state machine over roles, and text segments with loss flags.

A template is data: the marker that opens each role's turn, the marker that
ends a turn, which roles bear the loss, and which role may follow which state.
Only DataFrame functions are used.

A conversation is one training example, so its turns are brought together in
one row; its size is that of the example itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "␛"


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings open with one of their own signs that they hold only there, and hold no escape sign.

    So no marker can begin inside a text and end inside a real marker. A role
    that has no marker of its own is written out between ``other``'s two.
    """

    open: dict[str, str] = field(
        default_factory=lambda: {"system": "[SYS]", "user": "[INST]", "assistant": "[/INST]"}
    )
    other: tuple[str, str] = ("[ROLE]", "[/ROLE]")
    end: str = "</s>"
    loss_roles: tuple[str, ...] = ("assistant",)
    # state -> role -> next state; what is not listed is an error.
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "told", "user": "asked"},
            "told": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    final: tuple[str, ...] = ("answered",)

    def controls(self) -> list[str]:
        return [*self.open.values(), *self.other, self.end]


def escaped(text: Column, template: ChatTemplate) -> Column:
    """Control strings in a text become the escape sign and a digit; the sign itself, sign and ``e``."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "e"))
    for i, control in enumerate(template.controls()):
        out = F.replace(out, F.lit(control), F.lit(f"{ESCAPE}{i}"))
    return out


def unescaped(text: Column, template: ChatTemplate) -> Column:
    out = text
    for i, control in enumerate(template.controls()):
        out = F.replace(out, F.lit(f"{ESCAPE}{i}"), F.lit(control))
    return F.replace(out, F.lit(ESCAPE + "e"), F.lit(ESCAPE))


def format_chats(rows: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation: conv_id, valid, bad_turn, segments, formatted.

    ``segments`` is array<struct<text, loss>>: markers without loss, and each
    text, escaped, with its role's flag; ``formatted`` joins them. Turns are
    ordered by turn, ties by role and text; repeated rows are turns of their
    own. A null role or text counts as empty, a null turn comes first, and
    rows with a null conv_id form one conversation. Every conversation is
    formatted; ``valid`` says if the machine accepts it, ``bad_turn`` the
    first position it refuses (from 0; the number of turns if it only ends
    too early). Other columns are ignored.
    """
    empty = F.lit("")
    turns = rows.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role"), empty).alias("role"),
            F.coalesce(F.col("text"), empty).alias("text"),
        ).alias("t"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    moves = F.create_map(
        *[F.lit(x) for state, to in template.moves.items() for role, new in to.items() for x in (f"{state}\n{role}", new)]
    )

    def step(state: Column, turn: Column) -> Column:
        new = F.coalesce(moves[F.concat_ws("\n", state["at"], turn["role"])], F.lit("error"))
        return F.struct(
            F.when(state["at"] == "error", F.lit("error")).otherwise(new).alias("at"),
            (state["n"] + F.when((state["at"] != "error") & (new != "error"), 1).otherwise(0)).alias("n"),
        )

    walked = F.aggregate("turns", F.struct(F.lit("start").alias("at"), F.lit(0).alias("n")), step)
    marker = F.create_map(*[F.lit(x) for pair in template.open.items() for x in pair])

    def parts(turn: Column) -> Column:
        named = F.concat(F.lit(template.other[0]), escaped(turn["role"], template), F.lit(template.other[1]))
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            piece(F.coalesce(marker[turn["role"]], named), F.lit(False)),
            piece(escaped(turn["text"], template), turn["role"].isin(*template.loss_roles)),
            piece(F.lit(template.end), F.lit(False)),
        )

    valid = F.col("walk.at").isin(*template.final)
    made = grouped.withColumn("walk", walked).select(
        "conv_id",
        valid.alias("valid"),
        F.when(~valid, F.col("walk.n")).alias("bad_turn"),
        F.flatten(F.transform("turns", parts)).alias("segments"),
    )
    return made.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """``turns`` array<struct<role, text>>, parsed from a formatted conversation alone."""
    pieces = F.split(formatted, "\\Q" + template.end + "\\E", -1)
    bodies = F.slice(pieces, 1, F.size(pieces) - 1)

    def parse(piece: Column) -> Column:
        first, last = template.other
        close = F.instr(piece, last)
        other = F.struct(
            unescaped(F.substring(piece, F.lit(len(first) + 1), close - len(first) - 1), template).alias("role"),
            unescaped(F.substring(piece, close + len(last), F.length(piece)), template).alias("text"),
        )
        known = [
            (
                piece.startswith(mark),
                F.struct(
                    F.lit(role).alias("role"),
                    unescaped(F.substring(piece, F.lit(len(mark) + 1), F.length(piece)), template).alias("text"),
                ),
            )
            for role, mark in template.open.items()
        ]
        cases = reduce(lambda c, k: c.when(*k), known[1:], F.when(*known[0])) if known else None
        return cases.otherwise(other) if known else other

    return F.transform(bodies, parse)


def chat_digests(rows: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """What the formatted conversations hold when read back, per conv_id."""
    made = format_chats(rows, template)
    turns = read_turns(F.col("formatted"), template)
    masked = F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), ""
    )
    read = made.select(
        "conv_id",
        "valid",
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        turns.alias("turns"),
        masked.alias("masked"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("masked").cast("bigint").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )
