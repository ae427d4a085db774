"""Chat formatting by token-level assembly.

Method: the texts of a conversation's turns are encoded one by one; reserved ids, which
the tokenizer never gives, are spliced between them; the loss mask is the prefix sum of
+1 where an assistant text begins and -1 where it ends. The rendered form shows reserved
ids as control strings, so the marks that these begin with are escaped inside texts before
encoding: a backslash is doubled, ``#`` before ``##`` becomes ``\\h`` and ``<`` before ``/turn>`` or
``said>`` becomes ``\\l``. Both the ids and the rendered form read back to the same turns.

Defined results: turns are ordered by (turn, role, text), nulls first; a null text is
empty, so is a null role, and a null conv_id is a conversation of its own. Equal rows
stay, one after the other. A role that is none of ROLES is spelled out in the header
(escaped). An empty table gives an empty table; extra columns are not read. A
conversation is one row of the result, so its turns meet in one task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as w

ROLES = ("system", "user", "assistant")
#: Reserved ids follow the vocabulary, in this order.
HEADERS = {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
OTHER, OTHER_END, END = "### Role ", " <said> ", " </turn>\n"
CONTROL = (*HEADERS.values(), OTHER, OTHER_END, END)
#: What is escaped wherever it occurs in a text, and how.
MARKS = re.compile(r"\\|#(?=##)|<(?=/turn>|said>)")
ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l"}
ESCAPED = re.compile(r"\\[\\hl]")
LOSS_ROLE = "assistant"
SCHEMA = "conv_id long, n_turns long, ids array<int>, loss array<byte>, formatted string"


def escape(text: str) -> str:
    return MARKS.sub(lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: next(k for k, v in ESCAPES.items() if v == m[0]), text)


@lru_cache(2)
def load_tokenizer(path: str, special_as_text: bool = True):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = special_as_text  # their strings in a text are ordinary text
    return tokenizer


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def decoder_of(tokenizer) -> Callable[[np.ndarray], str]:
    """What ids of ordinary text spell. A byte-level vocabulary is read off a table of its tokens' bytes."""
    decoder = tokenizer.decoder
    if decoder is None or json.loads(decoder.__getstate__()).get("type") != "ByteLevel":
        return lambda ids: tokenizer.decode(ids.tolist(), skip_special_tokens=False)
    byte_of = {letter: b for b, letter in byte_letters().items()}
    table = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        table[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return lambda ids: b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")


def segment_ids(chats: list[list[tuple[str, str]]], tokenizer) -> dict[str, list[int]]:
    """Ids of the escaped texts of conversations, each different one encoded once and by itself."""
    segments = list({s for turns in chats for role, text in turns for s in ((text,) if role in HEADERS else (role, text))})
    found = tokenizer.encode_batch_fast([escape(s) for s in segments], add_special_tokens=False)
    return {s: e.ids for s, e in zip(segments, found)}


def assemble(turns: list[tuple[str, str]], tokenizer, known: dict[str, list[int]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of one conversation; known has the segment_ids() of its texts."""
    base = tokenizer.get_vocab_size()
    reserved = {s: base + i for i, s in enumerate(CONTROL)}
    encode = (segment_ids([turns], tokenizer) if known is None else known).__getitem__
    ids: list[int] = []
    begins, ends = [], []
    for role, text in turns:
        if role in HEADERS:
            ids.append(reserved[HEADERS[role]])
        else:
            ids += [reserved[OTHER], *encode(role), reserved[OTHER_END]]
        if role == LOSS_ROLE:
            begins.append(len(ids))
        ids += encode(text)
        if role == LOSS_ROLE:
            ends.append(len(ids))
        ids.append(reserved[END])
    steps = np.zeros(len(ids) + 1, np.int32)
    np.add.at(steps, begins, 1)
    np.add.at(steps, ends, -1)
    return np.array(ids, np.int32), np.cumsum(steps)[:-1].astype(np.int8)


def _runs(ids: np.ndarray, base: int) -> Iterator[tuple[str | None, int, int]]:
    """(control string, at, at) and (None, begin, end) of the text runs between them."""
    at = 0
    for stop in np.flatnonzero(ids >= base):
        if stop > at:
            yield None, at, int(stop)
        yield CONTROL[int(ids[stop]) - base], int(stop), int(stop)
        at = int(stop) + 1
    if at < len(ids):
        yield None, at, len(ids)


def render(ids: np.ndarray, tokenizer, decode: Callable[[np.ndarray], str] | None = None) -> str:
    base, decode = tokenizer.get_vocab_size(), decode or decoder_of(tokenizer)
    return "".join(c if c is not None else decode(ids[a:b]) for c, a, b in _runs(ids, base))


def read_back(ids: np.ndarray, loss: np.ndarray, tokenizer, decode: Callable[[np.ndarray], str] | None = None) -> tuple[list[tuple[str, str]], str]:
    """The turns that ids say, and all text under the mask, unescaped."""
    base, decode = tokenizer.get_vocab_size(), decode or decoder_of(tokenizer)
    by_header = {v: k for k, v in HEADERS.items()}
    text = lambda a, b: unescape(decode(ids[a:b]))
    turns, learned = [], []
    role, said, in_role = "", "", False
    for control, a, b in _runs(ids, base):
        if control in by_header:
            role, said = by_header[control], ""
        elif control == OTHER:
            role, said, in_role = "", "", True
        elif control == OTHER_END:
            in_role = False
        elif control == END:
            turns.append((role, said))
        elif in_role:
            role = text(a, b)
        else:
            said = text(a, b)
            masked = loss[a:b].astype(bool)
            if masked.any():
                learned.append(said if masked.all() else text(*(a + np.flatnonzero(masked)[[0, -1]] + [0, 1])))
    return turns, "".join(learned)


def format_chats(rows: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per conversation: conv_id, n_turns, ids, loss (a mask of ids), formatted."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(tokenizer_path)
        decode = decoder_of(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                said = [[(t["role"], t["text"]) for t in turns] for turns in part["turns"].to_pylist()]
                known, out = segment_ids(said, tokenizer), []
                for turns in said:
                    ids, loss = assemble(turns, tokenizer, known)
                    out.append((len(turns), ids, loss, render(ids, tokenizer, decode)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["conv_id"],
                        pa.array([o[0] for o in out], pa.int64()),
                        pa.array([o[1] for o in out], pa.list_(pa.int32())),
                        pa.array([o[2] for o in out], pa.list_(pa.int8())),
                        pa.array([o[3] for o in out], pa.string()),
                    ],
                    names=["conv_id", "n_turns", "ids", "loss", "formatted"],
                )

    return chats.mapInArrow(w.tidy(run), SCHEMA)
