"""Chat formatting at the level of tokens: segments are encoded apart, reserved ids are spliced between them.

A turn becomes ``[start of role] text ids [end of turn]``, where the start and end ids lie beyond the tokenizer's
vocabulary, so no text can produce them. What a text says of control strings (``</s>``, ``[INST]``, ...) is
escaped before it is encoded, so that the printed form can be parsed back too: a mark is put after the first
character of each control string, and doubled where the text has the mark itself. The mask of tokens that
count for the loss is the running sum of starts of assistant turns less ends of turns. Reading back splits the ids
at the reserved ones, decodes the pieces and takes the escapes away.

Turns are encoded one by one, wherever they lie; only then the turns of a conversation are brought together
in order, and a task streams over them, so a conversation may hold any share of all rows: its digests need
no memory, though one task's time (a digest is a running one).

Defined cases: null text is empty; a null role is kept as role ``none``; roles that aren't user, assistant or
system are spelled out in the turn; turns are ordered by ``turn`` (null last), then role and text;
a null ``conv_id`` is a conversation of its own; repeated rows are turns of their own; an empty table gives an
empty result; columns other than conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

# Printed forms of the reserved ids, in the order of these: begins of turns by role, and the end of a turn.
STARTS = {"system": "<<SYS>>", "user": "[INST]", "assistant": "[/INST]"}
OTHER, END = "<s>", "</s>"
CONTROL = [*STARTS.values(), OTHER, END, "<</SYS>>"]
MARK = "\u2060"
FIRST_RESERVED = 60_000
IDS = {c: FIRST_RESERVED + i for i, c in enumerate([*STARTS.values(), OTHER, END])}
PRINTED = {i: c for c, i in IDS.items()}

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))


def escape(text: str) -> str:
    """No control string is left in the result, and ``unescape`` gives the text back."""
    return _CONTROL.sub(lambda m: m[0][0] + MARK + m[0][1:], text.replace(MARK, MARK + MARK))


def unescape(text: str) -> str:
    out, at = [], 0
    for m in re.finditer(MARK + "{1,}", text):
        out.append(text[at : m.start()])
        # Doubled marks stand for marks; an odd one is an escape, wherever it stands in the run.
        out.append(MARK * (len(m[0]) // 2))
        at = m.end()
    return "".join([*out, text[at:]])


@cache
def encoding(path: str | None = None):
    """The byte-level tokenizer, which gives every text back; one per worker process."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode_turn(role: str | None, text: str | None, path: str | None = None) -> list[int]:
    role, text = role if role is not None else "none", text or ""
    start = STARTS.get(role)
    # A role without an id of its own is part of the text segment, on a line of its own.
    said = text if start else role.replace("\\", "\\\\").replace("\n", "\\n") + "\n" + text
    return [IDS[start or OTHER], *encoding(path).encode_ordinary(escape(said)), IDS[END]]


def loss_mask(ids: np.ndarray) -> np.ndarray:
    """Tokens of assistant texts: between the assistant's id and the end of its turn, by running sums."""
    starts, ends = (ids >= FIRST_RESERVED) & (ids != IDS[END]), ids == IDS[END]
    turn = np.cumsum(starts)
    inside = turn - np.cumsum(ends) == 1
    assistant = np.concatenate(([False], ids[starts] == IDS[STARTS["assistant"]]))
    return inside & assistant[turn] & ~starts


def decode(ids: np.ndarray, path: str | None = None) -> str:
    """The printed form of token ids."""
    out, at = [], 0
    for i in np.flatnonzero(ids >= FIRST_RESERVED).tolist():
        out += [encoding(path).decode_bytes(ids[at:i].tolist()).decode(), PRINTED[int(ids[i])]]
        at = i + 1
    return "".join([*out, encoding(path).decode_bytes(ids[at:].tolist()).decode()])


def read_turns(ids: np.ndarray, path: str | None = None) -> list[tuple[str, str]]:
    """(role, text) of each turn."""
    roles = {IDS[s]: r for r, s in STARTS.items()}
    turns, start = [], None
    for i in np.flatnonzero(ids >= FIRST_RESERVED).tolist():
        if ids[i] != IDS[END]:
            start = i
            continue
        text = unescape(encoding(path).decode_bytes(ids[start + 1 : i].tolist()).decode())
        role = roles.get(int(ids[start]))
        if role is None:
            name, text = text.split("\n", 1)
            role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], name)
        turns.append((role, text))
    return turns


def assemble(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """``conv_id``, ``turn``, ``ids`` and ``loss`` per turn: token ids and whether each counts for the loss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.array(encode_turn(r, t, path), np.int32) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32))
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            arrays = [pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.ListArray.from_arrays(offsets, pa.array(loss_mask(flat)))]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), batch.column("_order"), *arrays], ["conv_id", "turn", "_order", "ids", "loss"])

    kinds = {f.name: f.dataType.simpleString() for f in conversations.schema.fields}
    # Ties of turn are settled by role and text.
    order = F.concat_ws("\u0001", F.coalesce("role", F.lit("none")), F.coalesce("text", F.lit("")))
    turns = conversations.select("conv_id", "turn", "role", "text", F.sha2(order, 256).alias("_order"))
    return turns.mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, _order string, ids array<int>, loss array<boolean>")


def report(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """What is read back from the assembled tokens, per conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done, kind = None, [], None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            lists = [batch.column("ids"), batch.column("loss")]
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                if state is None or state["conv"] != conv:
                    done += [state] if state else []
                    state = {"conv": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                ids = np.array(lists[0][i].values, np.int32)
                mask = np.array(lists[1][i].values.to_numpy(zero_copy_only=False), bool)
                for role, text in read_turns(ids, path):
                    state["turns"].update(f"{role}\n{text}\n".encode())
                    state["n"] += 1
                kept = unescape(encoding(path).decode_bytes(ids[mask].tolist()).decode())
                state["loss"].update(kept.encode())
                state["loss_chars"] += len(kept)
                state["chars"] += len(decode(ids, path))
            if len(done) > 1000:
                yield _rows(done, kind)
                done = []
        if state:
            yield _rows([*done, state], kind)

    small_batches(conversations.sparkSession)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    turns = assemble(conversations, path).repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_last(), "_order")
    return turns.mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def _rows(done: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    arrays = [
        pa.array([s["conv"] for s in done], kind),
        pa.array([s["n"] for s in done], pa.int64()),
        pa.array([s["turns"].hexdigest() for s in done]),
        pa.array([s["loss_chars"] for s in done], pa.int64()),
        pa.array([s["loss"].hexdigest() for s in done]),
        pa.array([s["chars"] for s in done], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
