"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only the
text of that reply is under the loss mask.  Turns after the last reply (or a conversation without a
reply) make one more example without a trainable part, so no turn is lost.

Template, per turn: ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and texts every
``<``, backslashes, ``|`` gets one more backslash, so no text can hold a control string; reading
back takes one away.

Turns of a conversation are met in order by one sorted pass per partition that holds one
conversation's context at a time, which is also the size of its largest example.

Defined results: null texts and roles are empty; turns are ordered by ``turn`` (nulls first), ties
by role and text, and repeated rows are separate turns; rows without a conversation id are one
conversation; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"  # fixed values of the template
TARGET_ROLE = "assistant"
# A batch of examples is handed on when it has so many characters.
BATCH_CHARS = 1 << 22

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role is one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def read_turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted example; raises if anything stands outside its turns."""
    turns, at = [], 0
    for found in _TURN.finditer(text):
        if found.start() != at:
            break
        turns.append((unescape_role(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(text):
        raise ValueError("not a formatted conversation")
    return turns


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
             role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, example, text, loss_start, loss_end, whole`` of every assistant turn.

    ``loss_start`` and ``loss_end`` count code points of ``text``; ``whole`` marks the example that
    holds every turn of its conversation.
    """
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = count = length = 0
        current: tuple = ()
        context: list[str] = []
        held: tuple | None = None  # the example of the last turn read, not known to be whole yet
        open_turns = False

        def take() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["conv_id", "example", "text", "loss_start", "loss_end", "whole"])
            rows.clear()
            return batch

        def close(last: bool) -> int:
            """Hands over the held example; at the end of a conversation also what follows it."""
            nonlocal held, count
            added = 0
            if held:
                rows.append((*held, last and not open_turns))
                added, held = len(held[2]), None
            if last and open_turns:
                text = "".join(context)
                rows.append((current[0], count, text, len(text), len(text), True))
                added += len(text)
            return added

        for batch in source:
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if current != (conv,):
                    if current:
                        size += close(True)
                    current, count, length, open_turns = (conv,), 0, 0, False
                    context.clear()
                head = f"{START}{escape_role(role or '')}\n"
                body = escape(text or "")
                context.append(f"{head}{body}{END}\n")
                if role == TARGET_ROLE:
                    size += close(False)
                    start = length + len(head)
                    held = (conv, count, "".join(context), start, start + len(body))
                    count += 1
                length += len(context[-1])
                open_turns = role != TARGET_ROLE
                if size > BATCH_CHARS:
                    yield take()
                    size = 0
        if current:
            close(True)
        yield take()

    ordered = (
        turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
                     F.col(f"`{role_col}`").cast("string").alias("role"),
                     F.col(f"`{text_col}`").cast("string").alias("text"),
                     F.col(f"`{turn_col}`").alias("turn"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text"))
    return ordered.mapInArrow(
        batches, "conv_id long, example long, text string, loss_start long, loss_end long,"
        " whole boolean")


def read_back(formatted: DataFrame) -> DataFrame:
    """What each example's text and mask say: its reply, its length, and its turns if it is whole."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            replies, counts, digests = [], [], []
            for text, start, end, whole in zip(*(batch.column(k).to_pylist() for k in range(2, 6))):
                replies.append(unescape(text[start:end]))
                sha, found = hashlib.sha256(), read_turns(text) if whole else []
                for role, own in found:
                    sha.update(f"{role}\n{own}\n".encode())
                counts.append(len(found) if whole else None)
                digests.append(sha.hexdigest() if whole else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(replies, pa.string()),
                 pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.array([len(t) for t in batch.column(2).to_pylist()], pa.int64())],
                ["conv_id", "example", "reply", "n_turns", "turns_sha256", "chars"])

    return formatted.mapInArrow(
        batches, "conv_id long, example long, reply string, n_turns long, turns_sha256 string,"
        " chars long")


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its examples."""
    replies = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("example", "reply"))), lambda x: x["reply"]), "")
    return read_back(formatted).groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
        F.sum(F.char_length("reply")).alias("loss_chars"), F.sha2(replies, 256).alias("loss_sha256"),
        F.sum("chars").alias("formatted_chars"))
