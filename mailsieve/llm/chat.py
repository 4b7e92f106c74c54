"""Chat formatting: segments encoded one by one, reserved ids between them, loss masks by running sums."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.bpe import SLICE, Coder, coder_for
from mailsieve.llm.streams import bounded_batches, slices

#: Marks of the template and, from the vocabulary's first free id on, their reserved ids.
MARKS = ("<|turn|>", "<|text|>", "<|end|>")
#: Strings that control this or other templates; inside a text each is escaped.
CONTROLS = (
    *MARKS, "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]",
    "[/INST]", "<<SYS>>", "<</SYS>>",
)
LEARNED_ROLE = "assistant"

_TAILS = {head: "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == head) for head in "<["}
_PLAIN = re.compile("|".join(rf"(?<={re.escape(h)})(?=\\*(?:{t}))" for h, t in _TAILS.items()))
_MARKED = re.compile("|".join(rf"(?<={re.escape(h)})\\(?=\\*(?:{t}))" for h, t in _TAILS.items()))


def escape(text: str) -> str:
    """One more backslash after the first character of every control string, backslashes there or not."""
    return _PLAIN.sub(r"\\", text)


def unescape(text: str) -> str:
    """What ``escape`` was given."""
    return _MARKED.sub("", text)


def assemble_all(coder: Coder, turns: list[tuple[str, str]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Turns (role, text) as text; their ids and loss mask end to end, and where each turn ends.

    All segments are encoded in one pass, each by itself; reserved ids are spliced in by offsets.
    """
    first = len(coder.tokens)
    said = [escape(s) for turn in turns for s in turn]
    parts = coder.encode_all(said)
    sizes = np.array([len(p) // 4 for p in parts], np.int64).reshape(-1, 2)
    ends = np.cumsum(sizes.sum(axis=1) + 3)
    heads = ends - sizes.sum(axis=1) - 3
    marks = (heads, heads + 1 + sizes[:, 0], ends - 1)
    ids = np.zeros(int(ends[-1]) if len(ends) else 0, "<u4")
    plain = np.ones(len(ids), bool)
    for j, at in enumerate(marks):
        ids[at], plain[at] = first + j, False
    ids[plain] = np.frombuffer(b"".join(parts), "<u4")
    learned = np.array([role == LEARNED_ROLE for role, _ in turns], bool)
    steps = np.zeros(len(ids) + 1, np.int8)
    np.add.at(steps, marks[1][learned] + 1, 1)
    np.add.at(steps, marks[2][learned], -1)
    texts = [f"{MARKS[0]}{r}{MARKS[1]}{t}{MARKS[2]}" for r, t in zip(said[::2], said[1::2], strict=True)]
    return texts, ids, np.cumsum(steps[:-1]).astype(np.uint8), ends


def assemble(coder: Coder, role: str, text: str) -> tuple[str, np.ndarray, np.ndarray]:
    """A turn as text, its ids and its loss mask."""
    texts, ids, mask, _ = assemble_all(coder, [(role, text)])
    return texts[0], ids, mask


def read_turns(coder: Coder, ids: np.ndarray, mask: np.ndarray) -> Iterator[tuple[int, str, str, str]]:
    """(place of its first id, role, text, text under the mask) of each turn in a run of ids."""
    first = len(coder.tokens)
    heads, mids, ends = (np.flatnonzero(ids == first + j) for j in range(3))
    data, at = coder.decode_flat(ids)
    under = np.repeat(mask > 0, np.diff(at))
    before = np.concatenate([[0], np.cumsum(under)])
    raw, learned = data.tobytes(), data[under].tobytes()
    bounds = [x.tolist() for x in (heads, at[heads], at[mids], at[ends], before[at[heads]], before[at[ends]])]
    for place, a, b, c, d, e in zip(*bounds, strict=True):
        yield place, *(unescape(x.decode()) for x in (raw[a:b], raw[b:c], learned[d:e]))


def read_back(coder: Coder, ids: np.ndarray, mask: np.ndarray) -> Iterator[tuple[str, str, str]]:
    """(role, text, text under the mask) of each turn in a run of ids."""
    return (turn[1:] for turn in read_turns(coder, ids, mask))


def format_turns(rows: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, ...) -> (conv_id, turn, formatted, ids, mask), one row for each.

    A conversation's output is its rows' by turn (then by ``formatted``), end to end.  ``ids`` are 4 bytes
    each, little-endian; ``mask`` has a byte for each id, 1 for the text of an assistant.  Control strings
    in texts and roles are escaped, and as segments are encoded apart from the marks, no text can yield a
    reserved id.  Null roles and texts are empty.  Rows never move.  Extra columns are ignored.
    """
    with open(ranks, "rb") as file:
        shared = rows.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_for(shared.value, pattern)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                roles, texts = (pc.fill_null(part.column(c), "").to_pylist() for c in ("role", "text"))
                said, ids, mask, ends = assemble_all(coder, list(zip(roles, texts, strict=True)))
                cuts = np.concatenate([[0], ends])
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), part.column("turn"), pa.array(said, pa.string()),
                     _pieces(ids, 4 * cuts), _pieces(mask, cuts)],
                    ["conv_id", "turn", "formatted", "ids", "mask"])

    own = rows.select("conv_id", "turn", "role", "text")
    schema = own.select("conv_id", "turn").schema.add("formatted", "string").add("ids", "binary").add("mask", "binary")
    return bounded_batches(own).mapInArrow(run, schema)


def _pieces(flat: np.ndarray, cuts: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, buffers).cast(pa.binary())


def conversation_digests(turns: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Output of ``format_turns`` read back: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars), one row for each conversation (those without an id are one).

    Ids and masks of a batch's rows are joined, decoded in one pass and split into turns at the reserved ids.  A
    digest needs its conversation's turns in order, so they pass one task, one after another, in the memory
    of a batch however long the conversation is.
    """
    with open(ranks, "rb") as file:
        shared = turns.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, state, key = coder_for(shared.value, pattern), None, None
        done: list[tuple] = []
        for batch in batches:
            convs, chars, parts, masks = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            begins = np.cumsum([0, *[len(m) for m in masks]])
            ids, mask = np.frombuffer(b"".join(parts), "<u4"), np.frombuffer(b"".join(masks), np.uint8)
            back = list(read_turns(coder, ids, mask))
            owners = (np.searchsorted(begins, [place for place, *_ in back], side="right") - 1).tolist()
            turns_read = iter(zip(owners, back, strict=True))
            turn = next(turns_read, None)
            for row, (conv, n) in enumerate(zip(convs, chars, strict=True)):
                if state is None or conv != key:
                    if state is not None:
                        done.append(_close(key, state))
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                while turn is not None and turn[0] == row:
                    _, role, text, learned = turn[1]
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                    turn = next(turns_read, None)
                state[4] += n
            if done:
                yield _digest_batch(done)
                done = []
        if state is not None:
            yield _digest_batch([_close(key, state)])

    thin = turns.select("conv_id", "turn", F.char_length("formatted").cast("long").alias("chars"), "ids", "mask",
                        "formatted")
    return (
        thin.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted").drop("formatted")
        .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                         "formatted_chars long"))


def _close(key: int | None, state: list) -> tuple:
    return key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def format_digest(rows: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Conversations formatted and read back; no rows give no rows."""
    own = rows.withColumn("conv_id", F.col("conv_id").cast("long"))
    return conversation_digests(format_turns(own, ranks, pattern), ranks, pattern)
