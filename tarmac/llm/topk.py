"""Exact top-k inner products by no-random-access aggregation.

Method: vectors are dealt into blocks of about BLOCK components. In a block every component is
a list sorted by value; a query reads it in steps from the end that its own component favours. At
a depth, a component already read is known and one not yet read lies between the list's
last read value and its far end, which gives each vector a lower and an upper score bound.
Reading starts where the bounds of a few vectors begin to rule some out.
All vectors whose upper bound is below the query's bar are outsiders and are not looked at again; the lists
are read on until few others are left, whose final scores are then resolved
as integers. The bar is the k-th best lower bound of the block, the k-th best score of the
block that the query met first, or that of the blocks it met before in the same task, whichever is highest; a block
whose lists' ends alone cannot reach the bar is not read at all. Bounds are the clipped vectors' products with the
positive and the negative parts of the queries, so a block of queries is bounded by matrix products.

Every block of queries meets one block of vectors to set its bars, and then every block: tasks are pairs of a part of
the blocks and a part of the queries, and each reads both from shuffle files that hold every block once. Nothing but
counts, block numbers and bars passes through the driver. A block pair yields at most k rows a query, and their best k are the
result. Bounds prune where few components tell vectors apart or vectors lie in clusters. On vectors
without any structure they prove nothing before the lists' ends, and the work is that of all products;
entries_read() tells which is the case.

Defined results: vectors that are null, or hold null or non-finite components, take no part;
shorter vectors count as filled up with zeros; ties go to the smaller id; rows with a null
id take no part; rows that repeat an id are each answered, and none is its own candidate; with fewer
than k candidates all are returned; empty tables give an empty table; other columns are not
read. Scaled components of 2**53 or more in size raise an error, as do components so large that a score might not fit 63 bits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.store import Scratch

#: Components in a block of vectors and in a block of queries.
BLOCK, QUERY_BLOCK = 1 << 18, 1 << 15
#: Of a list of n entries the first reading takes one in FIRST, each further one STEP times as many, or LEAP times where bounds proved next to nothing.
FIRST, STEP, LEAP = 64, 2, 4
#: Where bars are known, the first reading is the first of which the bounds of so many vectors rule out a tenth.
TRIED = 32
#: So many times k vectors are resolved and not bounded any further.
FEW = 8
#: Pairs of full blocks for a task, and tasks at most. Bytes of query blocks in a task, where they are held; blocks of vectors pass through.
PAIRS, TASKS, HELD = 64, 4096, 1 << 24
#: Bytes that a task's answer of one row takes in a shuffle file. Answers of all tasks take no more room than the blocks.
FOUND = 16
#: Scores of a block of vectors and a part of a block of queries that are worked out together.
CELLS = 1 << 22
#: The bound on sums of products below which float64 holds integers exactly.
EXACT = float(1 << 53)
#: The same for float32, of half the work.
SHORT = float(1 << 24)
_RESULT = "asked long, q long, query_id long, vec_id long, score long, read long, entries long"


def scaled(vectors: DataFrame, id_column: str, column: str, scale: float) -> DataFrame:
    """(id, v): floor(scale * x) of every component, of the rows that take part."""
    x = F.col(column)
    whole = x.isNotNull() & F.col(id_column).isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    rounded = F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")))
    return vectors.where(whole).select(F.col(id_column).cast("long").alias("id"), rounded.alias("v"))


def packed(vectors: DataFrame, size: int, name: str) -> DataFrame:
    """(name, ids, dim, kind, matrix): blocks of at most size components, or of one vector, in the smallest integers that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longest = max(batch["v"].value_lengths().to_numpy(), default=1)
            step = max(size // max(int(longest), 1), 1)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                lengths = part["v"].value_lengths().to_numpy()
                dim = int(lengths.max()) if len(lengths) else 0
                matrix = np.zeros((len(lengths), dim), np.int64)
                matrix[np.arange(dim) < lengths[:, None]] = part["v"].flatten().to_numpy()
                if ((matrix >= EXACT) | (matrix <= -EXACT)).any():
                    raise OverflowError("a scaled component is 2**53 or more in size; take a smaller scale")
                kind = next(t for t in ("i1", "i2", "i4", "i8") if np.abs(matrix).max(initial=0) <= np.iinfo(t).max)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part["id"].to_numpy().tobytes()]), pa.array([dim], pa.int32()), pa.array([kind]), pa.array([matrix.astype(kind).tobytes()])],
                    names=["ids", "dim", "kind", "matrix"],
                )

    blocks = vectors.mapInArrow(run, "ids binary, dim int, kind string, matrix binary")
    return blocks.withColumn(name, F.monotonically_increasing_id())


def _unpack(ids: pa.Scalar, dim: int, kind: pa.Scalar, matrix: pa.Scalar, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids.as_buffer(), np.int64)
    out = np.zeros((len(ids), width), np.int64)
    out[:, :dim] = np.frombuffer(matrix.as_buffer(), kind.as_py()).reshape(len(ids), dim)
    return ids, out


class SortedLists:
    """The components of a block as lists by value."""

    def __init__(self, vectors: np.ndarray, kind: type = np.float64) -> None:
        self.floats = vectors.astype(kind)

    @cached_property
    def rising(self) -> np.ndarray:
        return np.sort(self.floats, axis=0)

    @cached_property
    def _ends(self) -> tuple[np.ndarray, np.ndarray]:
        return self.floats.max(0), self.floats.min(0)

    def ends(self, positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
        """The highest score that any vector with components between the lists' ends could have, by query."""
        return self._ends[0] @ positive + self._ends[1] @ negative

    def bounds(self, depth: int, positive: np.ndarray, negative: np.ndarray, rows: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper scores (rows x queries) after reading depth entries of each list."""
        return self.lower(depth, positive, negative, rows), self.upper(depth, positive, negative, rows)

    def upper(self, depth: int, positive: np.ndarray, negative: np.ndarray, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        n, floats = len(self.floats), self.floats[rows]
        if depth >= n:
            return floats @ (positive + negative)
        # an entry that is read is known; the others are no better than the last values read
        return np.maximum(floats, self.rising[n - depth]) @ positive + np.minimum(floats, self.rising[depth - 1]) @ negative

    def lower(self, depth: int, positive: np.ndarray, negative: np.ndarray, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        n, floats = len(self.floats), self.floats[rows]
        if depth >= n:
            return floats @ (positive + negative)
        top, bottom = self.rising[n - depth], self.rising[depth - 1]
        return np.where(floats >= top, floats, self.rising[0]) @ positive + np.where(floats <= bottom, floats, self.rising[-1]) @ negative


def _resolved(ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, q: np.ndarray, v: np.ndarray, k: int, score: np.ndarray | None = None) -> list[np.ndarray]:
    """Of pairs of a query and a vector, each query's best k with their scores, ties to smaller ids."""
    if score is None:
        step = max(CELLS // max(vectors.shape[1], 1), 1)
        score = np.concatenate([np.einsum("ij,ij->i", vectors[v[at : at + step]], queries[q[at : at + step]]) for at in range(0, max(len(q), 1), step)])
    order = np.lexsort((ids[v], -score, q))
    q, v, score = q[order], v[order], score[order]
    best = np.arange(len(q)) - np.searchsorted(q, q) < k
    return [q[best], v[best], score[best]]


def _first_depth(lists: SortedLists, positive: np.ndarray, negative: np.ndarray, bars: np.ndarray) -> int:
    """How deep to read first: less than this rules out next to none of a few vectors."""
    n = len(lists.floats)
    depth = max(n // FIRST, 1)
    few = np.arange(0, n, max(n // TRIED, 1))
    while np.isfinite(bars).all() and depth < n and (lists.upper(depth, positive, negative, few) >= bars).mean() > 0.9:
        depth *= LEAP
    return depth


def block_top(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, bars: np.ndarray | None = None, kept: dict | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of each query's best k in a block that may reach its bar, ties to smaller ids; and how deep each query read.

    kept holds what was made of the block for other queries.
    """
    n, width = len(ids), max(vectors.shape[1], 1)
    kept = {} if kept is None else kept
    if "largest" not in kept:
        kept["largest"] = float(np.abs(vectors).max(initial=0))
    most = kept["largest"] * float(np.abs(queries).max(initial=0)) * width
    if most >= 2.0**63:
        raise OverflowError("scores need not fit 63 bits; take a smaller scale")
    slack = 0.0 if most < EXACT else most * width * 2.0**-50  # rounding of larger products
    kind = np.float32 if most < SHORT else np.float64
    if kind not in kept:
        kept[kind] = SortedLists(vectors, kind)
    lists = kept[kind]
    positive, negative = np.maximum(queries, 0).T.astype(kind), np.minimum(queries, 0).T.astype(kind)
    # a bar that float32 does not hold exactly is above or below all scores of the block
    bars = np.full(len(queries), -np.inf, kind) if bars is None else bars.astype(kind)
    read = np.zeros(len(queries), np.int64)
    open_queries = np.flatnonzero(lists.ends(positive, negative) >= bars - slack) if n else np.zeros(0, np.int64)
    same = np.flatnonzero(np.isin(ids, query_ids))
    own_row, own_query = np.nonzero(ids[same][:, None] == query_ids)
    own_row = same[own_row]
    alive, found = np.arange(n), [[np.zeros(0, np.int64)] * 3]
    depth = _first_depth(lists, positive[:, open_queries], negative[:, open_queries], bars[open_queries] - slack) if len(open_queries) else n
    while len(open_queries):
        read[open_queries] = min(depth, n)
        parts = positive[:, open_queries], negative[:, open_queries]
        rows, columns = np.full(n, -1), np.full(len(queries), -1)
        rows[alive], columns[open_queries] = np.arange(len(alive)), np.arange(len(open_queries))
        left = (rows[own_row] >= 0) & (columns[own_query] >= 0)
        mine = rows[own_row[left]], columns[own_query[left]]
        upper = lists.upper(depth, *parts, alive)
        upper[mine] = -np.inf
        m = len(alive)
        inside = upper >= bars[open_queries] - slack
        crowded = depth >= n and np.count_nonzero(inside) > FEW * k * len(open_queries)
        if m > k and (crowded or depth < n and np.isinf(bars[open_queries]).any()):  # a bar from elsewhere is seldom beaten by bounds
            lower = upper if depth >= n else lists.lower(depth, *parts, alive)
            lower[mine] = -np.inf
            bars[open_queries] = np.maximum(bars[open_queries], np.partition(lower.T, m - k, axis=1)[:, m - k])
            inside = upper >= bars[open_queries] - slack
        inside[mine] = False
        if depth >= n:
            v, q = np.divmod(np.flatnonzero(inside), len(open_queries))
            score = None if slack else upper[v, q].astype(np.int64)
            found.append(_resolved(ids, vectors, queries, open_queries[q], alive[v], k, score))
            break
        left_over = inside.sum(0)
        done = left_over <= FEW * k
        v, q = np.nonzero(inside[:, done])
        found.append(_resolved(ids, vectors, queries, open_queries[done][q], alive[v], k))  # the rest of the survivors' entries
        depth *= LEAP if np.median(left_over) > 0.9 * m else STEP
        # outsiders of all queries still open are not looked at again
        alive = alive[inside[:, ~done].any(1)]
        open_queries = open_queries[~done]
    q, v, score = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(q, kind="stable")
    return q[order], v[order], score[order], read


def _met(vectors: DataFrame, queries: DataFrame, k: int, id_column: str, column: str, scale: float, counted: bool = False) -> DataFrame:
    """Rows _RESULT of every block of queries against every block of vectors; with counts of entries, or without.

    No join here may broadcast: sizes of compressed tables say little about what they hold, and block pairs are many.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    blocks = scratch.save(packed(scaled(vectors, id_column, column, scale), BLOCK, "block"), "blocks")
    asked = scratch.save(packed(scaled(queries, id_column, column, scale), QUERY_BLOCK, "asked"), "asked")
    entries = F.length("ids") / 8 * F.col("dim")
    measures = {"n": F.count("*"), "vectors": F.sum(F.length("ids") / 8), "entries": F.sum(entries), "bytes": F.sum(F.length("matrix"))}
    of_blocks, of_asked = (x.select([F.coalesce(m, F.lit(0)).alias(name) for name, m in measures.items()]).first().asDict() for x in (blocks, asked))
    asked = asked.select("asked", F.col("ids").alias("q_ids"), F.col("dim").alias("q_dim"), F.col("kind").alias("q_kind"), F.col("matrix").alias("q_matrix"))

    def answered(meetings: DataFrame) -> DataFrame:
        columns = ["block", "ids", "dim", "kind", "matrix", "asked", "q_ids", "q_dim", "q_kind", "q_matrix", "bars"]
        return meetings.select(*columns).mapInArrow(_answer(k, counted), _RESULT)

    # each block of queries meets one block first, whose k-th best scores no later block need stay below
    place = F.row_number().over(Window.orderBy("block")) - 1  # one row for each block
    places = blocks.select("block", place.cast("long").alias("place"))
    first = asked.withColumn("place", F.pmod(F.xxhash64("asked"), F.lit(max(of_blocks["n"], 1)))).hint("merge").join(places, "place").drop("place")
    first = first.withColumn("bars", F.lit(None).cast("array<struct<q: long, score: long>>"))
    first = answered(first.hint("merge").join(blocks, "block")).where("vec_id IS NOT NULL")
    rank = Window.partitionBy("asked", "q").orderBy(F.desc("score"))
    kth = first.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") == k)
    bars = kth.groupBy("asked").agg(F.collect_list(F.struct("q", "score")).alias("bars"))  # a number for each query of a block
    asked = scratch.save(asked.hint("merge").join(bars, "asked", "left"), "barred")
    through, parts = _parts(of_blocks, of_asked, k, spark.sparkContext.defaultParallelism)
    return answered(blocks.repartition(through).hint("shuffle_replicate_nl").crossJoin(asked.repartition(parts)))


def _parts(of_blocks: dict[str, float], of_asked: dict[str, float], k: int, cores: int) -> tuple[int, int]:
    """Into how many parts blocks and queries go. A task holds its part of the queries, while its part of the blocks passes by."""
    work = of_blocks["entries"] / BLOCK * of_asked["entries"] / QUERY_BLOCK
    tasks = min(max(math.ceil(work / PAIRS), cores), TASKS)
    # every part of the blocks answers each query: past this many, queries are split instead
    room = of_blocks["bytes"] / max(of_asked["vectors"] * k * FOUND, 1)
    through = max(int(min(tasks, of_blocks["n"], room)), 1)
    held = of_asked["vectors"] * 8 * (1 + k) + of_asked["bytes"]
    return through, max(int(min(max(math.ceil(tasks / through), math.ceil(held / HELD)), of_asked["n"])), 1)


def _answer(k: int, counted: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, kept = None, {}
        ids, vectors = np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
        best: dict[int, np.ndarray] = {}  # each query's bar, and the k best scores that it met here, the lowest first
        for batch in batches:
            dims, q_dims = batch["dim"].to_pylist(), batch["q_dim"].to_pylist()
            for i, (number, asked) in enumerate(zip(batch["block"].to_pylist(), batch["asked"].to_pylist())):
                width = max(dims[i], q_dims[i])
                if met != (number, width):
                    met, kept = (number, width), {}
                    ids, vectors = _unpack(batch["ids"][i], dims[i], batch["kind"][i], batch["matrix"][i], width)
                query_ids, queries = _unpack(batch["q_ids"][i], q_dims[i], batch["q_kind"][i], batch["q_matrix"][i], width)
                if asked not in best:
                    best[asked] = np.full((len(query_ids), k + 1), -np.inf)
                    for bar in batch["bars"][i].as_py() or ():
                        best[asked][bar["q"], 0] = bar["score"]
                scores = best[asked]
                step = max(CELLS // max(len(ids), 1), 1)
                for at in range(0, len(query_ids), step):
                    part = slice(at, at + step)
                    q, v, score, read = block_top(ids, vectors, query_ids[part], queries[part], k, scores[part, :2].max(1), kept)
                    q += at
                    if len(q):
                        fresh = np.full((len(read), k), -np.inf)
                        fresh[q - at, np.arange(len(q)) - np.searchsorted(q, q)] = score
                        scores[part, 1:] = np.sort(np.concatenate((scores[part, 1:], fresh), axis=1), axis=1)[:, k:]
                    every = np.arange(at, at + len(read)) if counted else np.zeros(0, np.int64)
                    read = read[: len(every)]
                    none = pa.nulls(len(every), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(q) + len(every), asked)),
                            pa.array(np.concatenate((q, every))),
                            pa.array(np.concatenate((query_ids[q], query_ids[every]))),
                            pa.concat_arrays([pa.array(ids[v], pa.int64()), none]),
                            pa.concat_arrays([pa.array(score, pa.int64()), none]),
                            pa.concat_arrays([pa.nulls(len(q), pa.int64()), pa.array(read * width)]),
                            pa.concat_arrays([pa.nulls(len(q), pa.int64()), pa.array(np.full(len(every), len(ids) * width))]),
                        ],
                        names=["asked", "q", "query_id", "vec_id", "score", "read", "entries"],
                    )

    return run


def entries_read(vectors: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", column: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, read, entries: how many list entries each query read before outsiders were ruled out, and how many there are."""
    met = _met(vectors, queries, k, id_column, column, scale, counted=True).where("vec_id IS NULL")
    return met.groupBy("asked", "q", "query_id").agg(F.sum("read").alias("read"), F.sum("entries").alias("entries")).select("query_id", "read", "entries")


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", column: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows of vectors with another id."""
    best = Window.partitionBy("asked", "q").orderBy(F.desc("score"), "vec_id")
    met = _met(vectors, queries, k, id_column, column, scale).where("vec_id IS NOT NULL")
    found = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
