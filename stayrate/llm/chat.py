"""Conversations as training examples: one example for each assistant turn."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

# --- fixed values: control strings of common chat templates -----------------
CONTROL = [
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<unk>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
]
# ----------------------------------------------------------------------------

EXAMPLES = (
    "conv_id long, example long, n_turns long, text string, loss_start long, loss_end long"
)

_CONTROL = re.compile("|".join(re.escape(x) for x in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE) + r"\n", re.DOTALL)


def escape(text: str) -> str:
    """A text in which no control string stands: each gets a backslash after its first character,
    and every backslash of the text is doubled."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _escaped_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def _role(written: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], written)


def turn(role: str | None, text: str | None) -> tuple[str, str, str]:
    """The head, body and tail of a formatted turn; head and tail are markup."""
    return f"{OPEN}{_escaped_role(role or '')}\n", escape(text or ""), f"{CLOSE}\n"


def parse(example: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted example."""
    return [(_role(r), unescape(t)) for r, t in _TURN.findall(example)]


def expand(turns: list[tuple[str | None, str | None]]) -> Iterator[tuple[int, str, int, int]]:
    """Examples (turns so far, text, start and end of the trainable part) of one conversation.

    Each assistant turn ends an example in which only its own text is trainable. Turns after the
    last assistant turn make a last example with nothing trainable, so that no turn is lost.
    """
    parts: list[str] = []
    length, pending = 0, False
    for k, (role, text) in enumerate(turns, 1):
        head, body, tail = turn(role, text)
        parts += [head, body, tail]
        start = length + len(head)
        length = start + len(body) + len(tail)
        pending = role != "assistant"
        if not pending:
            parts = ["".join(parts)]
            yield k, parts[0], start, start + len(body)
    if pending:
        yield len(turns), "".join(parts), length, length


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[object, list]]:
    """Neighbouring rows of one conversation, across batches."""
    current, turns = None, []
    for batch in batches:
        for conv_id, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
            conv_id = None if pd.isna(conv_id) else int(conv_id)
            if turns and conv_id != current:
                yield current, turns
                turns = []
            current = conv_id
            turns.append((role, text))
    if turns:
        yield current, turns


def _examples(batches: Iterator[pd.DataFrame], most_chars: int = 1 << 22) -> Iterator[pd.DataFrame]:
    rows, chars = [], 0
    columns = ["conv_id", "example", "n_turns", "text", "loss_start", "loss_end"]
    for conv_id, turns in _conversations(batches):
        for i, (n, text, start, end) in enumerate(expand(turns)):
            rows.append((conv_id, i, n, text, start, end))
            chars += len(text)
            if chars >= most_chars:
                yield pd.DataFrame(rows, columns=columns).astype({"conv_id": "Int64"})
                rows, chars = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=columns).astype({"conv_id": "Int64"})


def prefix_examples(conversations: DataFrame) -> DataFrame:
    """Training examples of conversations (conv_id, turn, role, text).

    Every assistant turn becomes an example of its own: all preceding turns as context, then its
    reply, and only the reply's text between loss_start and loss_end (code points of `text`) is
    trainable. Returns conv_id, example (from 0), n_turns, text, loss_start, loss_end.
    Examples of a conversation are neighbours, in order.

    Turns are sorted by turn, then role, then text, so ties have one order; a null turn comes
    first. A null text is empty, a null role is an empty role. Rows with a null conv_id are one
    conversation. Repeated rows are repeated turns. A conversation without an assistant gives
    one example with nothing trainable. Control strings in texts and roles are escaped
    and `parse` restores them. Other columns are not read.

    A conversation is held in one task, as its examples are prefixes of each other; the
    examples are passed on one by one.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInPandas(_examples, EXAMPLES)
