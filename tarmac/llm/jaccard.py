"""N-gram Jaccard join with prefix, length, positional and suffix filters.

Method: a document is the set of its distinct K-word shingles (64-bit hashes). Shingles are
ordered rare first, by a table of counts over all documents (shingles in one slot share a
count; there is a slot for every few shingles, and at most MOST_SLOTS), then by hash. Two sets that are similar enough share one of the
first n - ceil(t n) + 1 shingles, so documents are joined on those. A pair goes on
if its sizes (length filter), the places of the shared shingle (positional filter) and
the counts of its shingles in PARTS hash ranges (suffix filter: the ranges cannot agree in
more than the lesser counts) leave the needed overlap possible, and is verified once.

Equal sets are one class; only its first document takes part. Within a shingle's documents
all are first compared with one of them; those linked then share a component, and
other pairs are compared only across components, so a group of many near copies costs
pairs in proportion to its size. No link between different components is lost.

Defined results: texts of fewer than K words are one shingle; null or empty texts have none
and stand alone; a document is a row's id and text, so texts that share an id, or have none, are
documents of their own; a component's id is the smallest of its documents', null where none has one;
an empty table gives an empty table; columns other than doc_id and text are not read. Sizes are exact up to 64-bit hash
collisions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as w
from tarmac.llm.components import components
from tarmac.llm.store import Scratch, filter_words, maybe_in

K = 3
#: Similarity in hundredths: 100 * intersection >= PERCENT * union.
PERCENT = 90
#: Slots of the table of counts, by the corpus' size: powers of two, about CHARS_A_SLOT characters each.
LEAST_SLOTS, MOST_SLOTS, CHARS_A_SLOT = 1 << 16, 1 << 24, 48
_BLOCK = 1 << 16
#: A task's counts are bytes: what is this frequent in one task is ordered by how many tasks say so.
MOST_IN_TASK = 255
#: Tasks that sum the blocks of counts.
MOST_SUMMING = 32
PARTS = 32
#: Counts by hash range are bytes. Where one does not fit, all are this, which claims nothing.
MOST_IN_PART = 255
_SIGN_SCHEMA = "doc_id long, row_key long, n int, s1 long, s2 long, block int, counts binary"


_PART_BOUNDS = np.arange(PARTS, dtype=w.U64) << w.U64(64 - 5)


def slots_for(chars: int) -> int:
    return min(max(1 << (max(chars, 1) // CHARS_A_SLOT).bit_length(), LEAST_SLOTS), MOST_SLOTS)


def _slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    return (hashes & w.U64(slots - 1)).astype(np.int64)


def signed_sets(docs: DataFrame, k: int, n_slots: int) -> DataFrame:
    """Per document its set's size and 128-bit signature; per task the counts of its shingles by slot, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_slots, np.uint8)
        for batch in batches:
            for first, hashes, offsets in w.each_text(batch["text"]):
                sets = list(w.shingle_sets(hashes, offsets, k))
                sizes = np.fromiter(map(len, sets), np.int64, len(sets))
                flat = np.concatenate(sets) if sets else np.zeros(0, w.U64)
                slots, many = np.unique(_slot(flat, n_slots), return_counts=True)
                counts[slots] = np.minimum(counts[slots] + many, MOST_IN_TASK)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                total = lambda x: np.diff(np.concatenate(([w.U64(0)], np.cumsum(x)))[ends])  # noqa: E731  sums of mixed hashes
                n = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, n),
                        batch["row_key"].slice(first, n),
                        pa.array(sizes, pa.int32()),
                        pa.array(total(w.mix(flat + w.U64(1))).view(np.int64)),
                        pa.array(total(w.mix(flat ^ w.U64(0x5851F42D4C957F2D))).view(np.int64)),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                    ],
                    names=["doc_id", "row_key", "n", "s1", "s2", "block", "counts"],
                )
        blocks = [i for i in range(n_slots // _BLOCK) if counts[i * _BLOCK : (i + 1) * _BLOCK].any()]
        packed = [zlib.compress(counts[i * _BLOCK : (i + 1) * _BLOCK].tobytes(), 1) for i in blocks]
        none = pa.nulls(len(blocks), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none.cast(pa.int32()), none, none, pa.array(blocks, pa.int32()), pa.array(packed, pa.binary())],
            names=["doc_id", "row_key", "n", "s1", "s2", "block", "counts"],
        )

    return docs.select("doc_id", document_key().alias("row_key"), "text").mapInArrow(w.tidy(run), _SIGN_SCHEMA)


def slot_ranks(signed: DataFrame, n_slots: int) -> np.ndarray:
    """The order of slots by their counts in the corpus: 2 bytes for each of MOST_SLOTS at most, summed and ranked in tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch["block"].to_pylist(), batch["counts"].to_pylist()):
                own = sums.setdefault(block, np.zeros(_BLOCK, np.int64))
                own += np.frombuffer(zlib.decompress(packed), np.uint8)
        # counts up to 4096 keep their order, larger ones that of their logarithm
        ranks = [np.where(c <= 4096, c, 4096 + np.log2(np.maximum(c, 1) / 4096) * 1024).astype("<u2").tobytes() for c in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(ranks, pa.binary())], names=["block", "ranks"])

    blocks = signed.where("block IS NOT NULL").select("block", "counts").repartition(min(n_slots // _BLOCK, MOST_SUMMING), "block")
    ranks = np.zeros(n_slots, np.uint16)
    found = blocks.mapInArrow(w.tidy(add), "block int, ranks binary").toArrow()
    for block, own in zip(found["block"].to_pylist(), found["ranks"]):
        ranks[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(own.as_buffer(), "<u2")
    return ranks


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def prefixes(docs: DataFrame, ranks: np.ndarray, k: int, percent: int) -> DataFrame:
    """(doc_id, n, s1, s2, prefix, parts): the rarest shingles of each set, rare first, and its counts by hash range."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # 2 bytes for each of MOST_SLOTS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        for batch in batches:
            for first, hashes, offsets in w.each_text(batch["text"]):
                rare, parts, sizes, s1, s2 = [], [], [], [], []
                for own in w.shingle_sets(hashes, offsets, k):
                    n = len(own)
                    p = prefix_length(n, percent) if n else 0
                    order = rank[_slot(own, len(rank))]
                    if p < n:
                        few = np.argpartition(order, p)
                        bound = order[few[:p]].max() if p else 0
                        few = np.flatnonzero(order <= bound)  # ties at the bound are settled by hash
                        few = few[np.lexsort((own[few], order[few]))][:p]
                    else:
                        few = np.lexsort((own, order))
                    rare.append(own[few])
                    in_part = np.diff(np.searchsorted(own, _PART_BOUNDS), append=n)
                    parts.append((in_part if in_part.max() < MOST_IN_PART else np.full(PARTS, MOST_IN_PART)).astype(np.uint8))
                    sizes.append(n)
                    s1.append(w.mix(own + w.U64(1)).sum(dtype=w.U64) if n else w.U64(0))
                    s2.append(w.mix(own ^ w.U64(0x5851F42D4C957F2D)).sum(dtype=w.U64) if n else w.U64(0))
                ends = np.concatenate(([0], np.cumsum([len(r) for r in rare])))
                flat = np.concatenate(rare) if rare else np.zeros(0, w.U64)
                m = len(rare)
                packed = np.concatenate(parts).view("<i8") if parts else np.zeros(0, np.int64)
                part_ends = pa.array(np.arange(m + 1) * (PARTS // 8), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, m),
                        pa.array(sizes, pa.int32()),
                        pa.array(np.array(s1, w.U64).view(np.int64)),
                        pa.array(np.array(s2, w.U64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64))),
                        pa.ListArray.from_arrays(part_ends, pa.array(packed)),
                    ],
                    names=["doc_id", "n", "s1", "s2", "prefix", "parts"],
                )

    return docs.mapInArrow(w.tidy(run), "doc_id long, n int, s1 long, s2 long, prefix array<long>, parts array<long>")


def whole_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(doc_id, hashes): the sorted sets of the documents whose ids are wanted, and of a few more."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_words(wanted.select(F.xxhash64("doc_id").alias("key")), "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = np.flatnonzero(maybe_in(shared.value, batch["key"].to_numpy()))
            part = batch.take(pa.array(some))
            for first, hashes, offsets in w.each_text(part["text"]):
                sets = [w.pack_sorted(s) for s in w.shingle_sets(hashes, offsets, k)]
                yield pa.RecordBatch.from_arrays([part["doc_id"].slice(first, len(sets)), pa.array(sets, pa.binary())], names=["doc_id", "hashes"])

    return docs.withColumn("key", F.xxhash64("doc_id")).mapInArrow(w.tidy(run), "doc_id long, hashes binary")


def _in_reach(a: str, b: str, percent: int, first: bool = False) -> Column:
    """Length and positional filter for rows a and b that share a prefix shingle.

    With first, for pairs whose first common shingle this is: no rarer one is shared. A similar
    pair passes at that shingle, which both prefixes hold, whatever it does at others.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    p, q = F.col(f"{a}.pos"), F.col(f"{b}.pos")
    length = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    before = F.lit(0) if first else F.least(p, q)
    return length & ((before + 1 + F.least(n - p - 1, m - q - 1)) * (100 + percent) >= percent * (n + m))


def _parts_agree(a: str, b: str, percent: int) -> Column:
    """Suffix filter: the counts by hash range leave enough overlap possible."""

    def count(row: str, i: int) -> Column:
        return F.shiftrightunsigned(F.col(f"{row}.parts")[i // 8], i % 8 * 8).bitwiseAND(MOST_IN_PART)

    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    agree = sum((F.least(count(a, i), count(b, i)) for i in range(PARTS)), F.lit(0))
    return (F.least(n, m) > MOST_IN_PART * PARTS) | (agree * (100 + percent) >= percent * (n + m))


def shared_rows(classes: DataFrame, shared: DataFrame) -> DataFrame:
    """(doc_id, n, pos, shingle) of prefix shingles that are in shared, and of a few more."""
    bitmap = classes.sparkSession.sparkContext.broadcast(filter_words(shared, "shingle"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["prefix"].flatten()
            ends = np.concatenate(([0], np.cumsum(batch["prefix"].value_lengths().to_numpy())))
            keep = np.flatnonzero(maybe_in(bitmap.value, flat.to_numpy()))
            row = np.searchsorted(ends, keep, "right") - 1
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(own), batch["n"].take(own), pa.array(keep - ends[row], pa.int32()), flat.take(pa.array(keep))],
                names=["doc_id", "n", "pos", "shingle"],
            )

    return classes.select("doc_id", "n", "prefix").mapInArrow(w.tidy(run), "doc_id long, n int, pos int, shingle long")


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, each tried once."""
    pairs = scratch.save(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    sets = scratch.save(whole_sets(docs, ends, k), "sets")
    left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (w.unpack_sorted(batch[c][i].as_py()) for c in ("x", "y"))
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) else 0
                if 100 * both >= percent * (len(x) + len(y) - both) and both:
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return scratch.save(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(w.tidy(run), "a long, b long"), "links")


def document_key() -> Column:
    """A key of a document's id and text, which only equal rows share."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def similar_documents(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id for every row of docs.

    row_key is the document_key(), component_key that of the component's document with the smallest id.
    """
    scratch = Scratch(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = given.select(document_key().alias("doc_id"), "text")
    n_slots = slots_for(rows.agg(F.sum(F.length("text"))).first()[0] or 0)
    signed = scratch.save(signed_sets(given, k, n_slots), "signed")
    ordered = prefixes(rows, slot_ranks(signed, n_slots), k, percent)
    # one document stands for all with an equal set
    first = F.min(F.struct("doc_id", "prefix", "parts")).alias("first")
    classes = ordered.where("n > 0").groupBy("n", "s1", "s2").agg(first)
    classes = scratch.save(classes.select("n", "s1", "s2", "first.*"), "classes")
    # of a shingle's documents the one stands for the others in which it comes first: the least edited of near copies
    shared = classes.select("doc_id", F.posexplode("prefix").alias("pos", "shingle")).groupBy("shingle")
    shared = shared.agg(F.count("*").alias("many"), F.min(F.struct("pos", "doc_id"))["doc_id"].alias("pivot")).where("many > 1")
    shared = scratch.save(shared, "shared")
    spread = scratch.save(shared_rows(classes, shared).join(shared, "shingle"), "spread")
    parts = classes.select("doc_id", "n", "parts")

    pivots = spread.where("doc_id = pivot").alias("p")
    others = spread.where("doc_id <> pivot").alias("o")
    stars = others.join(pivots, (F.col("o.shingle") == F.col("p.shingle")) & _in_reach("p", "o", percent))
    stars = stars.select(F.col("p.doc_id").alias("a"), F.col("o.doc_id").alias("b")).distinct()
    stars = stars.join(parts.alias("p"), F.col("a") == F.col("p.doc_id")).join(parts.alias("o"), F.col("b") == F.col("o.doc_id"))
    links = verified(stars.where(_parts_agree("p", "o", percent)).select("a", "b"), rows, k, percent, scratch)
    labels = components(links, scratch)

    # pairs with the pivot are done; of the others only those across components are left
    rest = spread.where("many > 2").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    rest = scratch.save(rest.withColumn("component", F.coalesce("component", "doc_id")), "rest")
    heads = rest.where("doc_id = pivot").select("shingle", F.col("component").alias("head"))
    peers = rest.where("doc_id <> pivot").drop("many", "pivot")
    strays = peers.join(heads, "shingle").where("component <> head").join(parts.drop("n"), "doc_id")
    peers = peers.join(strays.select("shingle").distinct(), "shingle", "left_semi").join(parts.drop("n"), "doc_id")
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(np.log(100 / percent))) if percent < 100 else F.col("n").cast("long")
    strays = scratch.save(strays.withColumn("band", F.explode(F.array(band - 1, band, band + 1))), "strays").alias("x")
    peers = scratch.save(peers.withColumn("band", band), "peers").alias("y")
    across = strays.join(
        peers,
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.band") == F.col("y.band"))
        & (F.col("x.component") != F.col("y.component"))
        & ((F.col("y.component") == F.col("x.head")) | (F.col("x.doc_id") < F.col("y.doc_id")))
        & _in_reach("x", "y", percent, first=True)
        & _parts_agree("x", "y", percent),
    )
    more = verified(across.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")), rows, k, percent, scratch)
    labels = components(links.union(more), scratch)

    # a class's component is its first document's; a component is named by its document with the smallest id
    signs = signed.where("block IS NULL").drop("block", "counts")
    least = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")
    firsts = signs.where("n > 0").groupBy("n", "s1", "s2").agg(F.min(least).alias("least"))
    whole = classes.select("n", "s1", "s2", "doc_id").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    whole = whole.select("n", "s1", "s2", F.coalesce("component", "doc_id").alias("component")).join(firsts, ["n", "s1", "s2"])
    whole = scratch.save(whole, "whole")
    heads = whole.groupBy("component").agg(F.min("least").alias("head"))
    each = signs.join(whole.drop("least").join(heads, "component"), ["n", "s1", "s2"], "left")
    return each.select(
        "doc_id",
        "row_key",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("head.row_key", "row_key").alias("component_key"),
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
    )
