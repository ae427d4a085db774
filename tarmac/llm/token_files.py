"""Token-id output as ORC files.

Method: documents are put in id order, encoded with a public tokenizer and written as ORC:
the ids are an integer column, which ORC run-length encodes; stripes are read in
parallel; row indexes hold the id range of every ORC_STRIDE rows and a Bloom filter
of the ids, so that reads by document id skip stripes and row groups.

Encoding is shared between equal pieces of text. A byte-level tokenizer first cuts a text
into pieces, and it always cuts where white space follows anything else and where one of
. , ; : ! ? follows an ASCII letter. Stretches between such places are encoded once
per worker and batch (by the tokenizer's model alone where they are one word), and the ids are put together again with numpy.
A string of an added token, such as <|endoftext|>, is a stretch of its own and gives that token's id, as the plain
vocabulary has it; added tokens that strip white space or want whole words are refused.

Defined results: a null text is the end id alone; a null doc_id sorts first; documents with
the same id are ordered by their text's hash and all written; an empty table gives an empty
table; extra columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm import words as w
from tarmac.llm.chat import byte_letters, load_tokenizer

END_ID = 0
ORC_STRIDE = 10_000
ORC_STRIPE = 64 << 20
#: Pieces whose ids a worker keeps between batches; beyond it the store starts anew.
KEPT_PIECES = 1_000_000
SCHEMA = "doc_id long, n_tokens int, shard int, shard_start long, ids array<int>"


def cuts_apply(tokenizer) -> bool:
    """Whether a vocabulary splits texts where PieceEncoder does: byte-level BPE by the usual pattern, without normalising."""
    if tokenizer.normalizer is not None or tokenizer.pre_tokenizer is None:
        return False
    split = json.loads(tokenizer.pre_tokenizer.__getstate__())
    model = tokenizer.model
    plain = type(model).__name__ == "BPE" and not model.continuing_subword_prefix and not model.end_of_word_suffix and not model.dropout
    return plain and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")


class PieceEncoder:
    """Encodes texts as the tokenizer does, each different piece of a batch once.

    Pieces are told apart by 64-bit hashes. A vocabulary that splits texts in another way is refused.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = load_tokenizer(path, special_as_text=False)
        if not cuts_apply(self.tokenizer):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError(f"{path}: added tokens that strip white space or want whole words")
        self.added = {t.content.encode(): i for i, t in added.items()}
        self.marks = re.compile(b"|".join(re.escape(s) for s in sorted(self.added, key=len, reverse=True)))
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.clear()

    def ids_of(self, pieces: list[bytes]) -> list[list[int]]:
        """A space and letters at most are one word of the model; other pieces are split by the tokenizer first."""
        out: list = [None] * len(pieces)
        other = []
        for i, piece in enumerate(pieces):
            text = piece.decode()
            if piece in self.added:
                out[i] = [self.added[piece]]
            elif (text[1:] if text[:1] == " " else text).isalpha():
                out[i] = [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(self.letters))]
            else:
                other.append((i, text))
        for (i, _), found in zip(other, self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False)):
            out[i] = found.ids
        return out

    def clear(self) -> None:
        self.keys = np.zeros(0, w.U64)
        self.where = np.zeros(0, np.int64)
        self.begin = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.int32)

    @staticmethod
    def cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """First byte of every piece."""
        n = len(data)
        cut = np.zeros(n + 1, bool)
        cut[bounds] = True
        prev, here = data[:-1], data[1:]
        letter = ((prev | 32) >= 97) & ((prev | 32) <= 122)
        stop = np.isin(here, np.frombuffer(b".,;:!?", np.uint8))
        cut[1:n] |= stop & letter
        space = (here == 32) | (here == 10)
        solid = (prev > 32) & (prev < 127)
        # beyond ASCII only where the character before cannot be white space
        second = np.concatenate(([np.uint8(0)], prev[:-1])) if n > 1 else prev
        third = np.concatenate((np.zeros(2, np.uint8), prev[:-2]))[: len(prev)] if n > 2 else np.zeros(len(prev), np.uint8)
        wide = (prev >= 128) & ~((second == 0xC2) & ((prev == 0x85) | (prev == 0xA0))) & ~((third >= 0xE1) & (third <= 0xE3))
        cut[1:n] |= space & (solid | wide)
        return np.flatnonzero(cut[:n])

    def apart(self, begin: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Makes each string of an added token inside one text a piece of its own."""
        blob, spans, at = data.tobytes(), [], 0
        while self.added and (found := self.marks.search(blob, at)):
            stop = int(bounds[np.searchsorted(bounds, found.start(), "right")])
            inside = self.marks.match(blob, found.start(), stop)  # not across two texts
            at = inside.end() if inside else found.start() + 1
            if inside:
                spans.append(inside.span())
        if not spans:
            return begin
        first, last = np.array(spans).T
        span = np.searchsorted(first, begin, "right") - 1
        begin = begin[(span < 0) | (begin >= last[span])]
        both = np.union1d(begin, np.concatenate((first, last)))
        return both[both < len(data)]

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and len(bounds) offsets into them."""
        begin = self.apart(self.cuts(data, bounds), data, bounds)
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        end = np.append(begin[1:], len(data))
        keys = piece_hashes(data, begin, end)
        fresh, first, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(fresh) > KEPT_PIECES:
            self.clear()
        at = np.searchsorted(self.keys, fresh)
        known = np.zeros(len(fresh), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == fresh[inside]
        new = np.flatnonzero(~known)
        if len(new):
            blob = data.tobytes()
            ids = self.ids_of([blob[begin[i] : end[i]] for i in first[new]])
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            self.flat = np.concatenate((self.flat, np.fromiter((x for e in ids for x in e), np.int32, int(lengths.sum()))))
            slots = len(self.begin) - 1 + np.arange(len(new))
            self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(lengths)))
            self.where = np.insert(self.where, at[new], slots)
            self.keys = np.insert(self.keys, at[new], fresh[new])
            at = np.searchsorted(self.keys, fresh)
        slot = self.where[at][which]
        start, length = self.begin[slot], self.begin[slot + 1] - self.begin[slot]
        offsets = np.concatenate(([0], np.cumsum(length)))
        take = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
        return self.flat[take], offsets[np.searchsorted(begin, bounds)]


def piece_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(data)
    sums = np.zeros(n + 1, w.U64)
    np.cumsum((data + w.U64(1)) * w.powers(n), out=sums[1:])
    h = (sums[end] - sums[begin]) * w.inverse_powers(n + 1)[begin]
    return w.mix(h + (end - begin).astype(w.U64) * w.U64(0x632BE59BD9B4E019))


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """A worker's encoder, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def encode_texts(texts: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, ids, offsets) for bounded runs of texts, end ids not included."""
    for at, stop in w.pieces(texts, 4 * w.CHUNK):
        yield at, stop, *encoder(path).encode(*w.raw(texts.slice(at, stop - at)))


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str) -> None:
    """Writes ORC files of documents in id order; a shard is one task's run of ids."""
    ordered = docs.select("doc_id", F.col("text"))
    ordered = ordered.repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), F.xxhash64("text")
    )
    ordered = ordered.withColumn("shard", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        for batch in batches:
            for at, stop, ids, offsets in encode_texts(batch["text"], tokenizer_path):
                n = stop - at
                out = np.insert(ids, offsets[1:], END_ID)
                ends = offsets + np.arange(n + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(at, n),
                        pa.array(np.diff(ends), pa.int32()),
                        batch["shard"].slice(at, n),
                        pa.array(start + ends[:-1], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out, pa.int32())),
                    ],
                    names=["doc_id", "n_tokens", "shard", "shard_start", "ids"],
                )
                start += int(ends[-1])

    (
        ordered.mapInArrow(w.tidy(run), SCHEMA)
        .write.option("orc.compress", "ZSTD")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.row.index.stride", ORC_STRIDE)
        .option("orc.stripe.size", ORC_STRIPE)
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_tokens, shard, shard_start, ids; filters on doc_id reach the files' indexes."""
    return spark.read.schema(SCHEMA).orc(path)


def token_index(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, from the files alone."""
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            flat = memoryview(np.ascontiguousarray(ids.flatten().to_numpy(zero_copy_only=False), "<u4")).cast("B")
            ends = np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy()))) * 4
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_tokens"].cast(pa.int64()), batch["shard"], batch["shard_start"], pa.array(sums, pa.int64())],
                names=["doc_id", "n_tokens", "shard", "shard_start", "ids_crc32"],
            )

    schema = "doc_id long, n_tokens long, shard int, shard_start long, ids_crc32 long"
    return (
        files.mapInArrow(w.tidy(run), schema)
        .join(F.broadcast(shards), "shard")  # one row for each written file
        .select("doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")
    )
