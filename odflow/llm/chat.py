"""Chat formatting from event logs.

A conversation is a log of events (conv_id, turn, seq, op, role, text). ``message`` opens a message at
a turn, ``delta`` adds to the message of its turn, ``edit`` replaces its text, and ``regenerate`` takes
its text back so that later deltas write it anew. Logs are partitioned by conversation, sorted by
sequence within each turn, and folded one message at a time, so neither a long log nor a long
conversation is ever held as a whole. A conversation is dealt out by runs of turns: a hot one
spreads over tasks. Each message is rendered with its template and the offsets of its loss mask.

Control strings inside texts are escaped reversibly: a backslash is doubled, and a control string gets
a backslash behind its first character.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks of the template, and control strings of other templates.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROLS = (OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"
TURNS_PER_RUN = 64
EVENT = ["conv_id", "turn", "seq", "op", "role", "text"]

_CONTROL = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
# A turn as rendered. A role holds no unescaped line break, and neither part an unescaped control string.
_TURN = re.compile(re.escape(OPEN) + r"((?:\\.|[^\\\n])*)\n(.*?)" + re.escape(CLOSE) + "\n", re.DOTALL)

RENDERED = ("conv_id long, turn long, message_no long, role string, rendered string, "
            "loss_start long, loss_end long")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _escape_role(role: str) -> str:
    # A line break ends the role, so a role's own line breaks are escaped, too.
    return escape(role).replace("\n", "\\\n")


def render(role: str, text: str) -> tuple[str, int, int]:
    """A message in the template, and where in it the loss counts (an empty range for other roles)."""
    head = f"{OPEN}{_escape_role(role)}\n"
    body = escape(text)
    start = len(head)
    return head + body + CLOSE + "\n", start, start + len(body) if role == LOSS_ROLE else start


def parse(rendered: str) -> list[tuple[str, str]]:
    """Roles and texts of rendered messages."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(rendered)]


class _Fold:
    """The message being folded; ``finish`` gives its final role and text."""

    def __init__(self, role: str):
        self.role, self.parts = role, []

    def apply(self, op: str, text: str) -> None:
        if op in ("edit", "regenerate"):
            self.parts = []
        if op != "regenerate":
            self.parts.append(text)

    def finish(self) -> tuple[str, str]:
        return self.role, "".join(self.parts)


def _fold_and_render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, number, fold = None, 0, None

    def row() -> tuple:
        role, text = fold.finish()
        return (None if key[0] == NO_ID else key[0], None if key[1] == NO_ID else key[1], number, role, *render(role, text))

    for batch in batches:
        out = []
        for conv, turn, op, role, text in zip(batch["conv"], batch["at"], batch["op"], batch["role"], batch["text"],
                                              strict=True):
            if (conv, turn) != key or op == "message":
                if fold is not None:
                    out.append(row())
                number = number + 1 if (conv, turn) == key else 0
                key, fold = (conv, turn), _Fold(role)
            fold.apply(op, text)
        if out:
            yield _frame(out)
    if fold is not None:
        yield _frame([row()])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "message_no", "role", "rendered", "loss_start", "loss_end"])
    return frame.astype({"conv_id": "Int64", "turn": "Int64"})


def as_log(rows: DataFrame) -> DataFrame:
    """Finished messages (conv_id, turn, role, text) as the events of a log that led to them.

    An assistant's message opens with a draft, which is streamed on, taken back and generated anew in three deltas; any other
    one opens with a draft that is edited and then added to. Messages of one turn follow each other by role and text.
    """
    text, size = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))
    third, half = F.floor(size / 3).cast("int"), F.floor(size / 2).cast("int")

    def event(op: str, said: Column | str) -> Column:
        return F.struct(F.lit(op).alias("op"), F.lit(said).alias("text") if isinstance(said, str) else said.alias("text"))

    def part(first: Column, after: Column) -> Column:
        return F.substring(text, first + 1, after - first)

    none = F.lit(0)
    generated = F.array(event("message", part(none, half)), event("delta", " and a draft"), event("regenerate", ""),
                        event("delta", part(none, third)), event("delta", part(third, half)), event("delta", part(half, size)))
    written = F.array(event("message", "a draft"), event("edit", part(none, half)), event("delta", part(half, size)))
    number = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    numbered = rows.withColumn("number", number)
    events = numbered.select("conv_id", "turn", "number", "role", F.posexplode(F.when(F.col("role") == LOSS_ROLE, generated).otherwise(written)))
    return events.select("conv_id", "turn", (F.col("number") * 8 + F.col("pos")).cast("long").alias("seq"), F.col("col.op").alias("op"),
                         "role", F.col("col.text").alias("text"))


# Stands for a missing conversation or turn while rows are sorted and compared.
NO_ID = -(1 << 63)


def format_chats(events: DataFrame, turns_per_run: int = TURNS_PER_RUN) -> DataFrame:
    """Final messages as rendered: (conv_id, turn, message_no, role, rendered, loss_start, loss_end).

    The renderings of a conversation in order of turn and message_no are its training text; offsets
    count characters within a rendering. NULL roles and texts are empty; events without a
    conversation form one of their own, and those without a turn come before turn 0. Events of
    equal sequence go by op, role and text. A delta, edit or regeneration at a turn that no
    message has opened opens one.
    """
    rows = events.select(
        F.coalesce("conv_id", F.lit(NO_ID)).alias("conv"), F.coalesce("turn", F.lit(NO_ID)).alias("at"),
        F.coalesce("seq", F.lit(NO_ID)).alias("seq"), F.coalesce("op", F.lit("message")).alias("op"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    run = F.floor(F.col("at") / turns_per_run)
    return (rows.repartition("conv", run).sortWithinPartitions("conv", "at", "seq", "op", "role", "text")
            .mapInPandas(_fold_and_render, RENDERED))


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    conv, state = None, None

    def close() -> tuple:
        turns, digest, chars, loss, total = state
        return (None if conv == NO_ID else conv, turns, digest.hexdigest(), chars, loss.hexdigest(), total)

    for batch in batches:
        out = []
        for key, rendered, start, end in zip(batch["conv"], batch["rendered"], batch["loss_start"], batch["loss_end"],
                                             strict=True):
            if state is None or key != conv:
                if state is not None:
                    out.append(close())
                conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(rendered):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            loss = unescape(rendered[start:end])
            state[2] += len(loss)
            state[3].update(loss.encode("utf-8", "surrogatepass"))
            state[4] += len(rendered)
        if out:
            yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
    if state is not None:
        yield pd.DataFrame([close()], columns=names).astype({"conv_id": "Int64"})


def digests(rendered: DataFrame) -> DataFrame:
    """One row per conversation, read back from its renderings; see the query for the columns.

    A digest runs over a conversation in order, so one task reads it, as a stream of messages
    of which it keeps only the running digests.
    """
    keyed = rendered.select(F.coalesce("conv_id", F.lit(NO_ID)).alias("conv"),
                            F.coalesce("turn", F.lit(NO_ID)).alias("at"), "message_no", "rendered", "loss_start", "loss_end")
    return (keyed.repartition("conv").sortWithinPartitions("conv", "at", "message_no")
            .mapInPandas(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long"))
