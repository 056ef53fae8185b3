"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate, several times over, and no
list of scores is kept.  For each query an interval that holds its kth best
score is cut into bins; all tasks count the scores of their rows in the bins,
the counts are summed over the tasks, and the bin in which the kth score lies
is the next interval, until that is one number wide.  A last pass takes the
rows that score above the kth score, and of those that score the same the
ones with the smallest ids.

Candidates are packed once into blocks of vectors of small integers.  Queries
go in blocks of ``QUERIES`` at most: a block's matrix and its intervals are
broadcast (their size is bounded by that), and each pass over the packed rows
is one job.  A task sends a row for a query and bin; as the kth score of all
rows is at least the kth of a task's own, it sends its counts from the top
down to where it has k scores -- k rows for a query at most, however many
rows score alike -- and needn't count below that.

Defined cases: vectors that are null or hold a null or a number that isn't
finite, and rows without an id, take no part; rows that share a query's id are
its own and not its candidates; components that one vector has and the other
lacks count as zero; repeated rows are candidates, or queries, each for
itself; without candidates, or without queries, the result is empty.  Scores
that don't fit a long are an error.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.tables import materialize
from tillroll.sources.files import fresh_path, remove

#: Production parameters: result rows of a query, and the integer scale.
K, SCALE = 5, 256
#: Queries of a block, vectors of a pack, bins of an interval.
QUERIES, PACK, BINS = 1024, 4096, 2048

PACKED = "block int, n int, dim int, small boolean, most double, longest double, ids binary, data binary"


def _matrix(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and scaled integers (as doubles, which hold them exactly) of the
    valid vectors, a matrix for each number of components."""
    ids, vectors = batch.column(0), batch.column(1)
    usable = np.asarray(ids.is_valid()) & np.asarray(vectors.is_valid())
    starts = vectors.offsets.to_numpy()
    values = vectors.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: nan
    lens = np.diff(starts)
    bad = np.r_[0, np.cumsum(~np.isfinite(values))]
    usable &= bad[starts[1:]] == bad[starts[:-1]]
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
    for dim in np.unique(lens[usable]).tolist():
        rows = np.flatnonzero(usable & (lens == dim))
        taken = values[starts[rows][:, None] + np.arange(dim)]
        yield numbers[rows], np.floor(scale * taken)


def packed(rows: DataFrame, id_col: str, vector: str, scale: int, size: int) -> DataFrame:
    """The valid vectors in packs of ``size`` at most; a task's packs bear its
    number as their block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def sealed(dim: int) -> pa.RecordBatch:
            ids, data = (np.concatenate(x) for x in zip(*waiting.pop(dim)))
            most = float(np.abs(data).max()) if data.size else 0.0
            small = most < 2**15
            longest = float(np.sqrt((data * data).sum(axis=1).max())) if data.size else 0.0
            row = [task, len(ids), dim, small, most, longest, ids.astype("int64").tobytes(), data.astype("int16" if small else "float64").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)

        names = [f.split()[0] for f in PACKED.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                for ids, data in _matrix(batch.slice(at, size), scale):
                    dim = data.shape[1]
                    held = sum(len(x) for x, _ in waiting.get(dim, []))
                    if held and held + len(ids) > size:
                        yield sealed(dim)
                    waiting.setdefault(dim, []).append((ids, data))
        for dim in list(waiting):
            yield sealed(dim)

    chosen = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return chosen.mapInArrow(pack, PACKED)


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(row["data"], "int16" if row["small"] else "float64")
    return np.frombuffer(row["ids"], "int64"), data.reshape(row["n"], row["dim"])


class Block:
    """A block of queries: ids, matrix, and for each the interval [lo, hi)
    that holds its kth best score, with the number of scores above it."""

    def __init__(self, packs: list[dict], k: int, most: float, longest: float):
        opened = [_opened(p) for p in packs]
        self.k = k
        self.ids = np.concatenate([ids for ids, _ in opened])
        self.matrix = np.zeros((len(self.ids), max(data.shape[1] for _, data in opened)))
        at = 0
        for ids, data in opened:
            self.matrix[at : at + len(ids), : data.shape[1]] = data
            at += len(ids)
        own = float(np.abs(self.matrix).max()) if self.matrix.size else 0.0
        #: no partial sum of a score is larger
        self.bound = own * most * self.matrix.shape[1]
        # what the lengths allow, one wider for rounding
        reach = np.minimum(np.sqrt((self.matrix**2).sum(axis=1)) * longest * (1 + 1e-9), self.bound)
        if len(reach) and reach.max() >= 2**63:
            raise OverflowError("scores don't fit a long")
        exact = [int(x) + 1 for x in reach.tolist()]
        self.lo, self.hi = np.array([-x for x in exact], "int64"), np.array([x + 1 for x in exact], "int64")
        self.above = np.zeros(len(self.ids), "int64")

    def scores(self, data: np.ndarray) -> np.ndarray:
        """Integer scores of the rows (down) with the queries (across); in
        single precision only where that holds every partial sum exactly."""
        dim = min(data.shape[1], self.matrix.shape[1])
        kind = "float32" if self.bound < 2**24 else "float64" if self.bound < 2**53 else object
        a, b = data[:, :dim], self.matrix[:, :dim]
        if kind is object:
            whole = lambda m: np.array([[int(x) for x in row] for row in m.tolist()], dtype=object).reshape(m.shape)
            return np.dot(whole(a), whole(b).T).astype("int64")
        return np.dot(a.astype(kind), b.astype(kind).T)

    @property
    def width(self) -> np.ndarray:
        return -(-(self.hi - self.lo) // BINS)


def _histograms(packs: DataFrame, block: Block) -> DataFrame:
    """(q, bin, n): the scores in each bin of a query's interval, over all
    candidates, from the top down to the kth."""
    shared = packs.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Block = shared.value
        n, width, rest = len(b.ids), b.width, b.k - b.above
        counts = np.zeros((n, BINS), "int64")
        floor = b.lo.copy()  # scores below are under k of this task
        for batch in batches:
            for row in batch.to_pylist():
                ids, data = _opened(row)
                scores = b.scores(data)
                r, q = np.nonzero((scores >= floor) & (scores < b.hi))
                other = ids[r] != b.ids[q]
                r, q = r[other], q[other]
                places, seen = np.unique(q * BINS + (scores[r, q].astype("int64") - b.lo[q]) // width[q], return_counts=True)
                counts.ravel()[places] += seen
                touched = np.unique(places // BINS)
                down = np.cumsum(counts[touched, ::-1], axis=1) >= rest[touched, None]
                full = down.any(axis=1)
                last = BINS - 1 - down[full].argmax(axis=1)
                floor[touched[full]] = b.lo[touched[full]] + last * width[touched[full]]
        counts[(b.lo[:, None] + np.arange(BINS) * width[:, None]) < floor[:, None]] = 0
        q, at = np.nonzero(counts)
        for i in range(0, len(q), 1 << 16):
            s = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(q[s], pa.int32()), pa.array(at[s], pa.int32()), pa.array(counts[q[s], at[s]], pa.int64())], names=["q", "bin", "n"])

    local = packs.mapInArrow(count, "q int, bin int, n long")
    return local.groupBy("q", "bin").agg(F.sum("n").alias("n"))


def _refine(packs: DataFrame, block: Block) -> None:
    """Narrows the intervals to the kth scores.  What reaches the driver is a
    row for each query of the block and pass."""
    spark, down = packs.sparkSession, Window.partitionBy("q").orderBy(F.desc("bin"))
    while (block.hi - block.lo > 1).any():
        rest = spark.createDataFrame([(i, int(x)) for i, x in enumerate(block.k - block.above)], "q int, rest long")
        bins = _histograms(packs, block).withColumn("to", F.sum("n").over(down))
        kth = bins.join(F.broadcast(rest), "q").where("to >= rest and to - n < rest").select("q", "bin", (F.col("to") - F.col("n")).alias("over"))
        width, lo, hi = block.width, block.lo.copy(), block.hi.copy()
        block.lo, block.hi = lo.copy(), lo + 1  # with fewer than k candidates everything counts
        for q, at, over in kth.collect():
            block.lo[q] = lo[q] + at * width[q]
            block.hi[q] = min(hi[q], block.lo[q] + width[q])
            block.above[q] += over


def _selected(packs: DataFrame, block: Block) -> DataFrame:
    """(q, query_id, vec_id, score): all rows above the kth score, and the
    smallest ids of each task among those equal to it."""
    shared = packs.sparkSession.sparkContext.broadcast(block)
    names = ["q", "query_id", "vec_id", "score"]

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Block = shared.value
        rest = b.k - b.above
        held = np.zeros((0, 2), "int64")  # (query, id) of ties

        def out(q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), *[pa.array(x, pa.int64()) for x in (b.ids[q], ids, scores)]], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                ids, data = _opened(row)
                scores = b.scores(data)
                r, q = np.nonzero(scores >= b.lo)
                other = ids[r] != b.ids[q]
                r, q = r[other], q[other]
                got = scores[r, q].astype("int64")
                over = got > b.lo[q]
                yield out(q[over], ids[r[over]], got[over])
                ties = np.concatenate([held, np.stack([q[~over], ids[r[~over]]], axis=1)])
                ties = ties[np.lexsort((ties[:, 1], ties[:, 0]))]
                first = np.flatnonzero(np.r_[True, ties[1:, 0] != ties[:-1, 0]]) if len(ties) else np.zeros(0, "int64")
                rank = np.arange(len(ties)) - np.repeat(first, np.diff(np.r_[first, len(ties)]))
                held = ties[rank < rest[ties[:, 0]]]
        yield out(held[:, 0], held[:, 1], b.lo[held[:, 0]])

    return packs.mapInArrow(select, "q int, query_id long, vec_id long, score long")


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` candidates with the highest
    scores of each query, fewer where there are fewer, ties to smaller ids."""
    spark = candidates.sparkSession
    packs = materialize(packed(candidates, id_col, vector, scale, PACK), "vectors")
    wanted = materialize(queries.select(id_col, vector), "queries")
    blocks = -(-max(wanted.count(), 1) // QUERIES)
    asked = materialize(packed(wanted.repartition(blocks), id_col, vector, scale, QUERIES), "query-blocks")
    most, longest = packs.agg(F.max("most"), F.max("longest")).first()
    path, schema = fresh_path(spark, "top-k"), "query_id long, rank int, vec_id long, score long"
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc("vec_id"))
    written = []
    for j in range(blocks if most is not None else 0):
        held = [r.asDict() for r in asked.where(F.col("block") == j).collect()]  # QUERIES vectors at most
        if not held:
            continue
        block = Block(held, k, most, longest)
        _refine(packs, block)
        ranked = _selected(packs, block).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("overwrite").parquet(f"{path}/{j}")
        written.append(f"{path}/{j}")
    for t in (packs, wanted, asked):
        remove(t)
    if not written:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*written)
