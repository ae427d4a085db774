"""Language-model scoring with a probabilistic suffix tree over words.

Model: the root gives each token t the probability (c + 0.5) / (N + 0.5 (V + 1)); c is its
count, N all and V distinct training tokens; the one symbol for unknown words has c = 0.
A context s of up to DEPTH words has an entry for symbol t if its count n in training text
is at least MIN_COUNT and diverges from what the parent state (s without its first word)
expects, e = n(s) P(t | parent): n / e >= RATIO and n ln(n / e) - (n - e) >= DIVERGENCE. A
context is retained as a state if it has an entry; longer contexts grow out of entries
only. With entries E(s) and a discount d, a state gives

    P(t | s) = (n(s t) - d) / n(s)                         for t in E(s)
    P(t | s) = P(t | parent) (1 - sum P(E | s)) / (1 - sum P(E | parent))   otherwise,

which adds up to one over the known and the unknown words. A token is scored in the state
of the longest retained suffix of the words before it.

Execution: texts are cut once into blocks of encoded documents (bounded; a longer text is a
block of its own) and written, bucketed by block, so that only answers travel to them. A block sends each different key it holds (a word, a word
pair, a context) once, in packed runs by key range; each range sums what all blocks sent and
answers every sender. So a very common word or pair is one key of a block, counts grow with
the corpus in the number of ranges, and nothing of the model passes through the driver
but N and V. Every round is written, so that lost executors cost single tasks.

Defined results: a null text is the end token alone; a null doc_id counts as empty text for the
split; equal rows are all scored; an empty table gives an empty table; other columns are not
read. Without training tokens only the root is left, where all words are unknown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as w
from tarmac.llm.store import Scratch

DEPTH = 2
MIN_COUNT = 2
RATIO = 1.5
DIVERGENCE = 4.0
DISCOUNT = 0.5
FOLDS, HELD_OUT = 5, 1
#: Tokens whose keys one range holds, about.
RANGE_TOKENS = 4 << 20
#: Tokens of a block, about: the more, the fewer keys are sent, and the more memory a task takes.
BLOCK_TOKENS = 1 << 20
END_HASH = w.U64(0x2545F4914F6CDD1D)

_BLOCK = "block long, doc_ids array<long>, held array<boolean>, lengths array<int>, width int, tokens binary, vocab binary"
_SENT = "part int, block long, kind int, width int, keys binary, counts binary, x binary, y binary"
_ANSWER = "block long, kind int, part int, there binary, own binary, counts binary, factor binary"
#: Kinds of keys: GRAM + d asks for counts of d + 1 words, STATE + d for states of d words.
GRAM, STATE = 0, 100


def _planes(a: np.ndarray) -> tuple[int, bytes]:
    """Unsigned numbers as their low bytes, one plane after the other."""
    width = max((int(a.max(initial=0)).bit_length() + 7) // 8, 1)
    return width, np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(width: int, data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8")


def _pack(a: np.ndarray) -> bytes:
    width, data = _planes(a)
    return bytes([width]) + zstandard.compress(data, 1)


def _unpack(data: bytes) -> np.ndarray:
    return _from_planes(data[0], zstandard.decompress(data[1:]))


def encoded_blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of documents as places in the block's own sorted vocabulary of word hashes.

    A block goes on over the texts of a task until it has ``block_tokens`` tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        pieces: list[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for first, hashes, offsets in w.each_text(batch["text"]):
                n = len(offsets) - 1
                full = np.insert(hashes, offsets[1:], END_HASH)
                pieces.append((batch["doc_id"].slice(first, n), batch["held"].slice(first, n), full, (np.diff(offsets) + 1).astype(np.int32)))
                size += len(full)
                if size >= block_tokens:
                    yield _block_row(number, pieces)
                    number, pieces, size = number + 1, [], 0
        if pieces:
            yield _block_row(number, pieces)

    return docs.mapInArrow(w.tidy(run), _BLOCK)


def _block_row(number: int, pieces: list[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    ids, held, hashes, lengths = zip(*pieces)
    vocab, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
    width, planes = _planes(tokens)
    n = sum(map(len, lengths))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays(ids)),
            pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays(held)),
            pa.array([np.concatenate(lengths)], pa.list_(pa.int32())),
            pa.array([width], pa.int32()),
            pa.array([zstandard.compress(planes, 1)], pa.binary()),
            pa.array([_pack(np.diff(vocab, prepend=w.U64(0)))], pa.binary()),
        ],
        names=["block", "doc_ids", "held", "lengths", "width", "tokens", "vocab"],
    )


class Block:
    """A block's tokens, and what the ranges answered so far."""

    def __init__(self, row: dict, answers: dict[int, list[dict]], ranges: int, total: int, distinct: int) -> None:
        self.row, self.answers, self.ranges = row, answers, ranges
        vocab = np.cumsum(_unpack(row["vocab"]), dtype=w.U64)
        self.hash = vocab[_from_planes(row["width"], zstandard.decompress(row["tokens"]))]
        lengths = np.array(row["lengths"], np.int64)
        self.ends = np.cumsum(lengths)
        self.at = (np.arange(len(self.hash)) - np.repeat(self.ends - lengths, lengths)).astype(np.int32)  # place in the document
        self.train = np.repeat(~np.array(row["held"], bool), lengths)
        self.keys: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.total, self.distinct = total, distinct

    def asked(self, kind: int, where: np.ndarray, keys: np.ndarray) -> None:
        """Registers the keys at the places where; the same in every round."""
        different, which = np.unique(keys[where], return_inverse=True)
        self.keys[kind] = (np.flatnonzero(where).astype(np.int32), different, which.astype(np.int32))

    def runs(self, keys: np.ndarray) -> np.ndarray:
        """Where each range's run of sorted keys begins; ranges split the key space evenly."""
        part = ((keys >> w.U64(32)) * w.U64(self.ranges)) >> w.U64(32)
        return np.searchsorted(part, np.arange(self.ranges + 1, dtype=w.U64))

    def sent(self, kind: int, counts: np.ndarray | None = None, x: np.ndarray | None = None, y: np.ndarray | None = None, keys=None) -> Iterator[tuple]:
        keys = self.keys[kind][1] if keys is None else keys
        cut = self.runs(keys)
        for part in np.flatnonzero(np.diff(cut)):
            run = slice(cut[part], cut[part + 1])
            width, planes = _planes(np.diff(keys[run], prepend=keys[run][:1]))
            packed = keys[run][:1].tobytes() + planes
            yield (
                int(part),
                self.row["block"],
                kind,
                width,
                packed,
                _pack(counts[run]) if counts is not None else None,
                x[run].tobytes() if x is not None else None,
                y[run].tobytes() if y is not None else None,
            )

    def train_counts(self, kind: int) -> np.ndarray:
        where, different, which = self.keys[kind]
        return np.bincount(which[self.train[where]], minlength=len(different))

    def answered(self, kind: int) -> tuple[np.ndarray, ...]:
        """For each different key: is it there, does this block own it, its count, and its factor as a state."""
        _, different, _ = self.keys[kind]
        n = len(different)
        there, own = np.zeros(n, bool), np.zeros(n, bool)
        count, factor = np.zeros(n, np.int64), np.ones(n)
        cut = self.runs(different)
        for a in self.answers.get(kind, []):
            lo, hi = cut[a["part"]], cut[a["part"] + 1]
            bits = np.unpackbits(np.frombuffer(a["there"], np.uint8), count=hi - lo).astype(bool)
            there[lo:hi] = bits
            here = lo + np.flatnonzero(bits)
            if a["own"] is not None:
                own[lo:hi] = np.unpackbits(np.frombuffer(a["own"], np.uint8), count=hi - lo)
                count[here] = _unpack(a["counts"])
            if a["factor"] is not None:
                factor[here] = _unpack(a["factor"]).view(np.float64)
        return there, own, count, factor

    def spread(self, kind: int, values: np.ndarray) -> np.ndarray:
        """A value per key as a value per token; 0 or false where nothing was asked."""
        where, _, which = self.keys[kind]
        out = np.zeros(len(self.hash), values.dtype)
        out[where] = values[which]
        return out

    def ask_first(self) -> Iterator[tuple]:
        self.walk(0)
        for d in range(1 + min(DEPTH, 1)):
            yield from self.sent(GRAM + d, self.train_counts(GRAM + d))

    def walk(self, known: int) -> Iterator[tuple]:
        """Goes up the tree with the answers of known levels; returns what the next round asks.

        known = 0 only names the first keys. With known levels of states, probability holds
        the model's value for each token.
        """
        everywhere = np.ones(len(self.hash), bool)
        shifted = lambda a: np.concatenate((a[:1] * 0, a[:-1]))
        gram = self.hash
        self.asked(GRAM, everywhere, gram)
        longer = w.combine(shifted(gram), self.hash)
        if DEPTH:
            self.asked(GRAM + 1, self.at >= 1, longer)
        if known == 0 and not self.answers:
            return iter(())
        count = self.spread(GRAM, self.answered(GRAM)[2])
        self.known_words = count > 0
        self.base = (count + 0.5) / (self.total + 0.5 * (self.distinct + 1))
        probability = self.base.copy()
        out: list[tuple] = []
        for d in range(1, DEPTH + 1):
            _, own, counts, _ = self.answered(GRAM + d)
            n = self.spread(GRAM + d, counts)
            owned = self.spread(GRAM + d, own)
            above = np.where(self.at >= 1, shifted(count), 0).astype(np.float64)
            expected = above * probability
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = n / expected
                entry = (n >= MIN_COUNT) & (ratio >= RATIO) & (n * np.log(ratio) - (n - expected) >= DIVERGENCE)
                share = np.where(entry, (n - DISCOUNT) / above, 0.0)
            context = shifted(gram)
            possible = np.zeros(len(self.hash), bool)
            possible[self.keys[GRAM + d][0]] = True
            self.asked(STATE + d, possible & (above >= MIN_COUNT), context)
            if d > known:  # the last round's answers: name the states, and the keys of longer contexts
                first = entry & owned
                places = np.flatnonzero(first)
                _, pick = np.unique(longer[places], return_index=True)  # an entry once, however often it occurs here
                places = places[pick]
                states, which = np.unique(context[places], return_inverse=True)
                out += self.sent(STATE + d, None, np.bincount(which, share[places], len(states)), np.bincount(which, probability[places], len(states)), states)
                out += self.sent(STATE + d)
                if d < DEPTH:
                    self.next_grams(d, entry, longer)
                    out += self.sent(GRAM + d + 1, self.train_counts(GRAM + d + 1))
                return iter(out)
            there, _, _, factor = self.answered(STATE + d)
            state, factor = self.spread(STATE + d, there), self.spread(STATE + d, factor)
            probability = np.where(state, np.where(entry, share, probability * factor), probability)
            if d < DEPTH:
                gram, count = longer, n
                longer = self.next_grams(d, entry, longer)
        self.probability = probability
        return iter(out)

    def next_grams(self, d: int, entry: np.ndarray, gram: np.ndarray) -> np.ndarray:
        """Keys one word longer, where the words before are an entry themselves."""
        longer = w.combine(np.concatenate((gram[:1] * 0, gram[:-1])), self.hash)
        where = np.concatenate(([False], entry[:-1])) & (self.at >= d + 1)
        self.asked(GRAM + d + 1, where, longer)
        return longer


def _sent_keys(row: dict) -> np.ndarray:
    first = np.frombuffer(row["keys"][:8], w.U64)
    return first + np.cumsum(_from_planes(row["width"], row["keys"][8:]), dtype=w.U64)


def _answer_range(table: pa.Table) -> pa.Table:
    """All that was sent to one range: counts or states are summed, and senders of keys answered."""
    out = []
    rows = table.to_pylist()
    for kind in sorted({r["kind"] for r in rows}):
        mine = sorted((r for r in rows if r["kind"] == kind), key=lambda r: (r["block"], r["x"] is None))
        keys = [_sent_keys(r) for r in mine]
        different, which = np.unique(np.concatenate(keys), return_inverse=True)
        ends = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        if kind < STATE:
            counts = np.concatenate([_unpack(r["counts"]) for r in mine]).astype(np.float64)
            total = np.bincount(which, counts, len(different)).astype(np.int64)
            owner = np.full(len(different), -1)
            owner[which[::-1]] = np.repeat(np.arange(len(mine)), np.diff(ends))[::-1]  # the first sender
            least = 1 if kind == GRAM else MIN_COUNT
            for i, r in enumerate(mine):
                own = which[ends[i] : ends[i + 1]]
                there = total[own] >= least
                if there.any():
                    out.append((r["block"], kind, r["part"], np.packbits(there).tobytes(), np.packbits(owner[own] == i).tobytes(), _pack(total[own][there]), None))
            if kind == GRAM:
                out.append((-1, kind, int((total > 0).sum()), None, None, _pack(total.sum(keepdims=True)), None))
        else:
            x, y = np.zeros(len(different)), np.zeros(len(different))
            known = np.zeros(len(different), bool)
            for i, r in enumerate(mine):
                if r["x"] is not None:
                    own = which[ends[i] : ends[i + 1]]
                    x[own] += np.frombuffer(r["x"])
                    y[own] += np.frombuffer(r["y"])
                    known[own] = True
            factor = (1 - x) / np.maximum(1 - y, 1e-12)
            for i, r in enumerate(mine):
                if r["x"] is None:
                    own = which[ends[i] : ends[i + 1]]
                    there = known[own]
                    if there.any():
                        out.append((r["block"], kind, r["part"], np.packbits(there).tobytes(), None, None, _pack(factor[own][there].view(w.U64))))
    columns = list(zip(*out)) or [()] * 7
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "kind", "part", "there", "own", "counts", "factor"])


def _sent_table(rows: Iterator[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * 8
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "block", "kind", "width", "keys", "counts", "x", "y"])


def _open(table: pa.Table, answers: pa.Table, ranges: int, total: int, distinct: int) -> Block:
    by_kind: dict[int, list[dict]] = {}
    for a in answers.to_pylist():
        by_kind.setdefault(a["kind"], []).append(a)
    return Block(table.to_pylist()[0], by_kind, ranges, total, distinct)


def score_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row; base-10 logarithms."""
    scratch = Scratch(docs.sparkSession)
    held = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % FOLDS == HELD_OUT
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held.alias("held"), F.col(text_column).alias("text"))
    blocks = scratch.save_by_key(encoded_blocks(rows, block_tokens), "blocks", "block")
    size = blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // RANGE_TOKENS)

    def first_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1).to_pylist()[0], {}, ranges, 0, 0)
                yield from _sent_table(block.ask_first()).combine_chunks().to_batches()

    def answers_to(sent: DataFrame, name: str) -> DataFrame:
        return scratch.save(sent.groupBy("part").applyInArrow(_answer_range, _ANSWER), name)

    answers = answers_to(blocks.mapInArrow(w.tidy(first_keys), _SENT), "counts")
    summary = answers.where("block = -1").select("part", "counts").toLocalIterator()  # a number of each range
    total = distinct = 0
    for row in summary:
        distinct += row.part
        total += int(_unpack(row.counts)[0])
    answers = answers.where("block >= 0")

    def next_round(known: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        return lambda table, given: _sent_table(_open(table, given, ranges, total, distinct).walk(known))

    for level in range(1, DEPTH + 1):
        asked = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(next_round(level - 1), _SENT)
        answers = answers.union(answers_to(asked, "level"))

    def scores(table: pa.Table, given: pa.Table) -> pa.Table:
        block = _open(table, given, ranges, total, distinct)
        block.walk(DEPTH)
        starts = np.concatenate(([0], block.ends[:-1]))
        added = lambda a: np.add.reduceat(a, starts)
        row, n = block.row, len(starts)
        return pa.table(
            [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["held"], pa.bool_()),
                pa.array(np.array(row["lengths"]), pa.int64()),
                pa.array(added(block.known_words.astype(np.int64)), pa.int64()),
                pa.array(np.full(n, total), pa.int64()),
                pa.array(added(np.log10(block.base))),
                pa.array(added(np.log10(block.probability))),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scores, schema)
