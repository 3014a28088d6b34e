"""Exact top-k by inner product: no-random-access aggregation over sorted lists.

Every component is a list of the rows sorted by it.  A query reads the lists from the end that
raises its score: from the top where its weight is positive, from the bottom where it is negative.
What a row has shown so far gives it a lower bound (unread parts at their worst) and an upper bound
(unread parts at the value the list has come to).  Rows whose upper bound is below the k-th lower
bound, and rows not read at all once their bound is, cannot qualify; the reading stops when few are
left, and only then are full scores computed, for those alone.

Rows are dealt into strips and queries into groups of bounded size; each pair of them is one cell,
read as a stream in blocks of rows.  A block has its own lists, and the k-th score of the blocks
before it is the floor it starts from.  Nothing is sent to the driver but two counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 2048  # rows whose lists are sorted and read together
QUERY_ROWS = 128  # queries that read the lists of a block together
GROUP_ROWS = 32_768  # queries that a task holds
STRIP_ROWS = 262_144  # rows that a task reads at most on average
LEAST_STRIP_ROWS = 8_192  # no more strips than this gives, on small tables
SMALL_STRIPS = 64
EXACT = 2.0**52  # sums of whole doubles are exact below twice this
DEPTHS = (32, 8, 4, 2)  # a block is read to these fractions of its lists
FEW = 16  # candidates per query and k at which reading on costs more than their full scores


def usable(vector: Column) -> Column:
    """True for vectors without NULL or non-finite components; never NULL."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _whole(batch: pa.RecordBatch, scale: float) -> list[np.ndarray]:
    """The vectors as floor(scale * x), in doubles (whole, exact below 2^53)."""
    lists = batch.column("v")
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(scale * flat), -most, most)
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors as rows, the missing components of shorter ones as 0."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _sums_are_exact(rows: np.ndarray, asked: np.ndarray) -> bool:
    with np.errstate(over="ignore"):
        return np.abs(rows).max(initial=0) * np.abs(asked).max(initial=0) * max(rows.shape[1], 1) < EXACT


def _exact_scores(rows: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers; beyond 64 bits they stay at the limits."""
    if _sums_are_exact(rows, asked):
        return (rows @ asked.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    product = whole(rows).dot(whole(asked.T)) if rows.size and asked.size else np.zeros((len(rows), len(asked)), object)
    limits = np.iinfo(np.int64)
    return np.clip(product, limits.min, limits.max).astype(np.int64)


class SortedLists:
    """The components of a block of rows as sorted lists."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        order = np.argsort(rows, axis=0, kind="stable")
        self.rank = np.empty(order.shape, np.int32)
        np.put_along_axis(self.rank, order, np.arange(len(rows), dtype=np.int32)[:, None], axis=0)
        self.values = np.take_along_axis(rows, order, axis=0)

    def narrow(self, may: np.ndarray, asked: np.ndarray, floor: np.ndarray, k: int) -> None:
        """Leave in ``may`` (rows by queries) only rows that can be among the k best above the floor."""
        n, alive = len(self.rows), np.arange(len(self.rows))
        up, down = np.maximum(asked, 0), np.minimum(asked, 0)
        lowest, highest = self.values[0], self.values[-1]
        for fraction in DEPTHS:
            depth = max(1, n // fraction)
            top, bottom = self.rank[alive] >= n - depth, self.rank[alive] < depth
            rows = self.rows[alive]
            read = (rows * top) @ up.T + (rows * bottom) @ down.T
            unread_top, unread_bottom = (~top).astype(float), (~bottom).astype(float)
            # a list read from the top has come down to its value at n - depth, one from the bottom up to depth - 1
            upper = read + unread_top @ (up * self.values[n - depth]).T + unread_bottom @ (down * self.values[depth - 1]).T
            lower = read + unread_top @ (up * lowest).T + unread_bottom @ (down * highest).T
            open_pairs = may[alive] & (upper > floor)
            if len(alive) > k:
                least = np.partition(np.where(may[alive], lower, -np.inf), len(alive) - k, axis=0)[len(alive) - k]
                open_pairs &= upper >= least
            may[alive] = open_pairs
            alive = alive[open_pairs.any(axis=1)]
            if len(alive) <= FEW * k or open_pairs.sum() <= FEW * k * len(asked):
                break


class _Cell:
    """The queries of one group and their best rows so far, while a strip is read in order of ids."""

    def __init__(self, k: int):
        self.k = k
        self.ids: list[int] = []
        self.vectors: list[np.ndarray] = []
        self.best: list[tuple[np.ndarray, np.ndarray]] | None = None

    def ask(self, ids: list[int], vectors: list[np.ndarray]) -> None:
        self.ids += ids
        self.vectors += vectors

    def read(self, ids: list[int], vectors: list[np.ndarray]) -> None:
        if not self.ids:
            return
        if self.best is None:
            self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in self.ids]
        width = max(max(map(len, vectors)), max(map(len, self.vectors)))
        rows, row_ids = _matrix(vectors, width), np.array(ids, np.int64)
        lists = SortedLists(rows)
        for begin in range(0, len(self.ids), QUERY_ROWS):
            self._read_for(lists, row_ids, range(begin, min(begin + QUERY_ROWS, len(self.ids))), width)

    def _read_for(self, lists: SortedLists, row_ids: np.ndarray, queries: range, width: int) -> None:
        asked = _matrix([self.vectors[q] for q in queries], width)
        # ids rise along the strip, so a later row must be better than the k-th before it, not equal
        floor = np.array([self.best[q][0][-1] if len(self.best[q][0]) == self.k else -np.inf for q in queries])
        own = np.array([self.ids[q] for q in queries])
        may = row_ids[:, None] != own[None, :]
        if _sums_are_exact(lists.rows, asked):
            lists.narrow(may, asked, floor, self.k)
        rows = np.flatnonzero(may.any(axis=1))
        scores = _exact_scores(lists.rows[rows], asked)
        for i, q in enumerate(queries):
            found = may[rows, i]
            if found.any():
                self._keep(q, scores[found, i], row_ids[rows[found]])

    def _keep(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        old_scores, old_ids = self.best[q]
        scores, ids = np.concatenate([old_scores, scores]), np.concatenate([old_ids, ids])
        # ~x falls as x rises, without overflow at the limits
        first = np.lexsort((ids, ~scores))[: self.k]
        self.best[q] = scores[first], ids[first]

    def answers(self) -> Iterator[tuple[int, int, int]]:
        for query, (scores, ids) in zip(self.ids, self.best or []):
            for score, found in zip(scores.tolist(), ids.tolist()):
                yield query, found, score


def _search(k: int, scale: float):
    names = ["query_id", "found_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cell = None, _Cell(k)
        ids: list[int] = []
        vectors: list[np.ndarray] = []

        def answers() -> Iterator[pa.RecordBatch]:
            if vectors:
                cell.read(ids, vectors)
            found = list(cell.answers())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names)

        for batch in batches:
            whole, own = _whole(batch, scale), batch.column("id").to_pylist()
            strips, groups = batch.column("strip").to_numpy(), batch.column("part").to_numpy()
            stored = batch.column("is_row").to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                here = strips[i], groups[i]
                if here != at:
                    yield from answers()
                    at, cell, ids, vectors = here, _Cell(k), [], []
                if not stored[i]:
                    cell.ask([own[i]], [whole[i]])
                    continue
                ids.append(own[i])
                vectors.append(whole[i])
                if len(ids) == BLOCK_ROWS:
                    cell.read(ids, vectors)
                    ids, vectors = [], []
        yield from answers()

    return run


def top_k(
    rows: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = 5, scale: float = 256
) -> DataFrame:
    """(query_id, rank, found_id, score): the k rows with the largest inner product per query.

    Components are taken as floor(scale * x), x as double; scores are exact whole numbers (at the
    limits of 64 bits where they pass them).  Ties go to the smaller id.  Ids are whole numbers.

    NULL ids, and vectors that are NULL or hold NULL or non-finite components, take no part; a query
    with such a vector has no answer.  Vectors of different lengths are compared with the missing
    components as 0, so an empty vector scores 0 with every row.  Rows with the query's id are its own
    and are no candidates.  Repeated rows are candidates each; a repeated query row is asked once, and
    different vectors under one query id share one list of k answers.  Fewer than k candidates: all of
    them; an empty table: no rows.  Other columns, of any name, are neither read nor returned.
    """
    element = rows.schema[vector_col].dataType.elementType.typeName()
    kind = "array<float>" if element == "float" else "array<double>"

    def narrow(df: DataFrame) -> DataFrame:
        vector = F.col(vector_col)
        fit = df.where(F.col(id_col).isNotNull() & usable(vector))
        return fit.select(F.col(id_col).cast("long").alias("id"), vector.cast(kind).alias("v"))

    stored, asked = narrow(rows), narrow(queries).distinct()
    n, m = rows.count(), queries.count()
    strips = max(1, -(-n // STRIP_ROWS), min(-(-n // LEAST_STRIP_ROWS), SMALL_STRIPS))
    groups = max(1, -(-m // GROUP_ROWS))
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")
    strip = F.pmod(F.xxhash64("id"), F.lit(strips)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    cells = asked.select(every(strips).alias("strip"), part.alias("part"), F.lit(False).alias("is_row"), "id", "v").unionAll(
        stored.select(strip.alias("strip"), every(groups).alias("part"), F.lit(True).alias("is_row"), "id", "v")
    )
    dealt = cells.repartition(strips * groups, "strip", "part").sortWithinPartitions("strip", "part", "is_row", "id")
    found = dealt.mapInArrow(_search(k, scale), "query_id long, found_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "found_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "found_id", "score")
