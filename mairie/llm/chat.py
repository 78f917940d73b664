"""Chat formatting at token level.

Each turn becomes ids on its own: a reserved id that opens the role, the ids of the escaped text,
a reserved id that closes the turn.  Text ids come from the vocabulary and never reach the reserved
range, so no text can forge a turn; the escape keeps the rendered string unambiguous as well.  The
loss mask is a prefix sum over +1 where an assistant's text begins and -1 where it ends.

Turns are encoded where they are read.  Only then are they brought together by conversation and
sorted, and a conversation is folded turn by turn, so one with very many turns streams through its
task and is never held whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mairie.llm.textbytes import slices
from mairie.llm.tokens import encoder

# Reserved ids follow the vocabulary's 50 257 own ids.
OPEN = {"user": 50257, "assistant": 50258, "system": 50259}
OPEN_OTHER, END_ROLE, CLOSE = 50260, 50261, 50262
HEADERS = {"user": "### User: ", "assistant": "### Assistant: ", "system": "### System: "}
OTHER_HEADER, END_ROLE_TEXT, CLOSE_TEXT = "### Role ", ": ", "</turn>\n"

_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>)")


def escape(text: str) -> str:
    r"""Puts a backslash before every backslash and control string; ``unescape`` gives the text back."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def _encode_turns(tokenizer: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in slices(batches, "text", 2 << 20):
            roles = [r or "" for r in batch.column("role").to_pylist()]
            texts, begins = encode(pa.array([escape(t or "") for t in batch.column("text").to_pylist()], pa.string()))
            names, named = encode(pa.array(["" if r in OPEN else escape(r) for r in roles], pa.string()))
            ids, masks = [], []
            for k, role in enumerate(roles):
                head = [OPEN[role]] if role in OPEN else [OPEN_OTHER, *names[named[k] : named[k + 1]], END_ROLE]
                body = texts[begins[k] : begins[k + 1]]
                turn = np.concatenate([np.array(head, "<u4"), body, np.array([CLOSE], "<u4")]).astype("<u4")
                step = np.zeros(len(turn) + 1, np.int8)
                if role == "assistant":
                    step[len(head)] += 1
                    step[len(head) + len(body)] -= 1
                ids.append(turn.tobytes())
                masks.append(np.cumsum(step[:-1], dtype=np.int8).tobytes())
            columns = [batch.column("conv_id"), batch.column("turn"), pa.array(ids, pa.binary()), pa.array(masks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "ids", "loss_mask"])

    return run


def format_turns(conversations: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(conv_id, turn, ids, loss_mask) of each row: little-endian unsigned 32-bit ids, one mask byte each.

    Concatenated in order of turn they are the conversation's training sequence.  Null role and
    text are empty strings; roles other than user, assistant and system are spelled out.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_encode_turns(tokenizer), "conv_id bigint, turn bigint, ids binary, loss_mask binary")


def read_turn(ids: np.ndarray, mask: np.ndarray, decode: Callable) -> tuple[str, str, str, str]:
    """Role, text, text under the mask and rendered string of one turn's ids."""
    if ids[0] == OPEN_OTHER:
        end = int(np.flatnonzero(ids == END_ROLE)[0])
        name = decode(ids[1:end])
        role, header = unescape(name), OTHER_HEADER + name + END_ROLE_TEXT
    else:
        role, end = next(r for r, i in OPEN.items() if i == ids[0]), 0
        header = HEADERS[role]
    body = decode(ids[end + 1 : -1])
    under = unescape(decode(ids[mask.astype(bool)])) if mask.any() else ""
    return role, unescape(body), under, header + body + CLOSE_TEXT


def _fold(tokenizer: str | None):
    schema = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(tokenizer).decode
        now, started, counts, turns, loss, done = None, False, [], None, None, []

        def row():
            return (now, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), *counts[2:])

        for batch in batches:
            for conv, ids, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ids", "loss_mask")), strict=True):
                if not started or conv != now:
                    if started:
                        done.append(row())
                    now, started, counts, turns, loss = conv, True, [0] * 5, hashlib.sha256(), hashlib.sha256()
                ids, mask = np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.int8)
                role, text, under, rendered = read_turn(ids, mask, decode)
                turns.update(f"{role}\n{text}\n".encode())
                loss.update(under.encode())
                for k, n in enumerate((1, len(under), len(rendered), len(ids), int(mask.sum()))):
                    counts[k] += n
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=schema).cast(_schema)
                done = []
        if started:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(row(), strict=True)], names=schema).cast(_schema)

    _schema = pa.schema(
        [(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in schema]
    )
    return run


def conversation_digests(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per conversation, read back from the ids of ``format_turns``.

    Turns go by number, null first; rows that share a number go by their ids, so the order is
    defined.  Null conv_id is one conversation.
    """
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return ordered.mapInArrow(
        _fold(tokenizer),
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, n_tokens bigint, n_loss_tokens bigint",
    )
