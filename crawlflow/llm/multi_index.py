"""Nearest neighbours by an inverted multi-index.

Each half of a vector is quantised on its own: a codebook of `k` centroids a half, fitted to a bounded sample,
gives k x k cells, and every vector lies in the cell of its two nearest half centroids. A query orders the
cells by the sum of its two distances to their centroids: a heap yields the pairs one by one from the two
sorted lists. It stops when the cells so far hold `budget` vectors; all of these are compared with the query in
double precision.

The budget is measured, not guessed: for at most `probes` queries the true neighbours are found by comparing them
with all vectors, and how many vectors the traversal passes up to the cell of a true neighbour is noted. The
budget is what reaches a share `reach` of these neighbours. It is small where vectors form groups, and a large
part of the table where they are nearly independent, as no index can tell then where neighbours lie.

Entries are dealt by the first half's cell and a digest of their id, queries go to the cells that they visit, so a
cell that holds a third of all rows is many tasks; each keeps ten rows a query.

Defined results: vectors that are null, zero, of another length than `dims` or with a null or non-finite component
take no part, nor do rows without vec_id. Rows that share the query's vec_id are no candidates. A row that the
table repeats is a candidate as often as it is there; of queries that share a vec_id the smallest vector counts.
With fewer candidates than `top` all are given; an empty table gives an empty result. Further columns are not read.

Parameters of bounded size: `sample` vectors (20,000) fit the codebooks, at most `most_centroids` (256) a half;
`probes` (300) queries set the budget. No rows are left out of the index by any of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crawlflow.llm.shared import pinned

_FOUND = "query_id bigint, vec_id bigint, score double"


def searchable(vectors: DataFrame, dims: int = 64) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    other_than_zero = F.exists("embedding", lambda x: x != 0)
    kept = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") == dims) & finite & other_than_zero)
    return kept.select(F.col("vec_id").cast("bigint"), vector.alias("embedding"))


def _about(df: DataFrame, rows: int, wanted: int, salt: str) -> DataFrame:
    """About `wanted` of `rows` rows by a digest of their id, all if there are no more."""
    if rows <= wanted:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(1 << 40)) < int(wanted / rows * (1 << 40)))


def _matrix(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = df.toArrow()
    ids = rows.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    values = rows.column("embedding").combine_chunks()
    x = np.asarray(values.flatten(), dtype=np.float64).reshape(len(ids), -1)
    return ids[order], x[order]


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, up to rounding."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """`k` centroids of the sample x, from evenly spaced starts."""
    centroids = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = squares(x, centroids).argmin(1)
        for c in range(k):
            mine = nearest == c
            if mine.any():
                centroids[c] = x[mine].mean(0)
    return centroids


class Codebooks:
    """The two halves' centroids and the number of vectors in each pair's cell."""

    def __init__(self, first: np.ndarray, second: np.ndarray) -> None:
        self.halves = (first, second)
        self.k = len(first)
        self.counts = np.zeros((self.k, self.k), dtype=np.int64)

    def to_halves(self, x: np.ndarray) -> list[np.ndarray]:
        at = self.halves[0].shape[1]
        return [squares(x[:, :at], self.halves[0]), squares(x[:, at:], self.halves[1])]

    def cells(self, x: np.ndarray) -> list[np.ndarray]:
        return [d.argmin(1) for d in self.to_halves(x)]

    def traverse(self, first: np.ndarray, second: np.ndarray, budget: float) -> Iterator[tuple[int, int, int]]:
        """Pairs of half cells by summed distance, with the vectors in all pairs up to it, until these reach the budget."""
        orders = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        a, b = first[orders[0]], second[orders[1]]
        heap = [(a[0] + b[0], 0, 0)]
        seen = 0
        while heap and seen < budget:
            _, i, j = heapq.heappop(heap)
            # (i, j + 1) follows (i, j); (i + 1, 0) follows (i, 0): each pair enters the heap once.
            if j + 1 < self.k:
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < self.k:
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
            cell = int(orders[0][i]), int(orders[1][j])
            if self.counts[cell]:
                seen += int(self.counts[cell])
                yield *cell, seen


def _x(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(rows, -1)


def _nearest(ids: np.ndarray, squared: np.ndarray, x: np.ndarray, q: np.ndarray, own: int, top: int) -> list[tuple[int, float]]:
    """The `top` nearest of the rows x to one query, by the plain distance and then the smaller id."""
    far = np.where(ids == own, np.inf, squared)
    if len(far) > top:
        # The product form of a distance is off by rounding: all that could be among the first are measured again.
        edge = np.partition(far, top - 1)[top - 1]
        picked = np.flatnonzero(far <= edge + 1e-9 * (1 + edge + (q * q).sum()))
    else:
        picked = np.arange(len(far))
    picked = picked[ids[picked] != own]
    scores = np.sqrt(((x[picked] - q) ** 2).sum(1))
    order = np.lexsort((ids[picked], scores))[:top]
    return [(int(ids[picked[i]]), float(scores[i])) for i in order]


def _compare(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, top: int) -> list[tuple[int, int, float]]:
    found = []
    step = max(1, (1 << 22) // max(1, len(ids)))
    for at in range(0, len(query_ids), step):
        d = squares(q[at : at + step], x)
        for k in range(len(d)):
            own = int(query_ids[at + k])
            found += [(own, *pair) for pair in _nearest(ids, d[k], x, q[at + k], own, top)]
    return found


def _found(rows: list[tuple[int, int, float]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], []]
    kinds = pa.int64(), pa.int64(), pa.float64()
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["query_id", "vec_id", "score"])


def ranked(found: DataFrame, top: int) -> DataFrame:
    """query_id, rank, vec_id and score of each query's first `top` rows."""
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def brute_force(queries: DataFrame, vectors: DataFrame, top: int = 10) -> DataFrame:
    """The true neighbours of a bounded number of queries, each compared with all vectors."""
    query_ids, q = _matrix(queries)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _found(_compare(query_ids, q, batch.column(0).to_numpy(), _x(batch.column(1), batch.num_rows), top))

    return ranked(vectors.mapInArrow(run, _FOUND), top)


class MultiIndex:
    """The codebooks of a table of vectors, its rows with their cells, and the measured budget."""

    def __init__(self, vectors: DataFrame, dims: int = 64, per_cell: int = 16, most_centroids: int = 256, sample: int = 20_000) -> None:
        self.vectors = vectors
        self.rows = vectors.count()
        self.budget = float(self.rows)
        self.measured_recall = 1.0
        if not self.rows:
            return
        _, x = _matrix(_about(vectors, self.rows, sample, "sample"))
        if not len(x):
            _, x = _matrix(vectors.limit(1000))
        k = int(min(most_centroids, max(2, round((self.rows / per_cell) ** 0.5)), len(x)))
        self.books = Codebooks(codebook(x[:, : dims // 2], k), codebook(x[:, dims // 2 :], k))
        books = self.books

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    c1, c2 = books.cells(_x(batch.column(1), batch.num_rows))
                    columns = [*batch.columns, pa.array(c1, pa.int32()), pa.array(c2, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "embedding", "c1", "c2"])

        self.entries = vectors.mapInArrow(run, "vec_id bigint, embedding array<double>, c1 int, c2 int")
        # One row a cell: most_centroids squared at most.
        for r in self.entries.groupBy("c1", "c2").agg(F.count("*").alias("n")).collect():
            books.counts[r["c1"], r["c2"]] = r["n"]

    def calibrate(self, queries: DataFrame, top: int = 10, reach: float = 0.97, probes: int = 300) -> None:
        """Set the budget that reaches a share `reach` of the true neighbours of at most about `probes` queries."""
        picked = _about(queries, queries.count(), probes, "probe")
        ids, q = _matrix(picked)
        if not len(ids):
            return
        truth = brute_force(picked, self.vectors, top)
        near = truth.join(self.vectors.select("vec_id", "embedding"), "vec_id").select("query_id", "embedding").toArrow()
        if not near.num_rows:
            return
        c1, c2 = self.books.cells(_x(near.column("embedding").combine_chunks(), near.num_rows))
        cells: dict[int, list[tuple[int, int]]] = {}
        for own, cell in zip(near.column("query_id").to_pylist(), zip(c1.tolist(), c2.tolist())):
            cells.setdefault(own, []).append(cell)
        depth = []
        for own, first, second in zip(ids.tolist(), *self.books.to_halves(q)):
            at = {(i, j): seen for i, j, seen in self.books.traverse(first, second, float("inf"))}
            depth += [at[cell] for cell in cells.get(own, [])]
        depth.sort()
        self.budget = float(depth[min(len(depth) - 1, int(np.ceil(reach * len(depth))) - 1)])
        self.measured_recall = sum(d <= self.budget for d in depth) / len(depth)

    def visits(self, queries: DataFrame) -> DataFrame:
        """Per query and first half cell: `seconds`, the second half cells that it visits."""
        books, budget = self.books, self.budget

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _x(batch.column(1), batch.num_rows)
                rows, firsts, seconds = [], [], []
                for k, (first, second) in enumerate(zip(*books.to_halves(x))):
                    cells: dict[int, list[int]] = {}
                    for i, j, _ in books.traverse(first, second, budget):
                        cells.setdefault(i, []).append(j)
                    rows += [k] * len(cells)
                    firsts += cells
                    seconds += cells.values()
                picked = pa.array(rows, pa.int32())
                columns = [c.take(picked) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(firsts, pa.int32()), pa.array(seconds, pa.list_(pa.int32()))],
                    names=["query_id", "query", "c1", "seconds"],
                )

        return queries.mapInArrow(run, "query_id bigint, query array<double>, c1 int, seconds array<int>")

    def search(self, queries: DataFrame, top: int = 10, block_rows: int = 8192) -> DataFrame:
        """query_id, rank, vec_id, score: the nearest of the entries in the cells that each query visits.

        Blocks of entries and of queries of a first half cell meet, so no task needs a whole cell.
        """
        of_first = self.books.counts.sum(1)
        parts = [max(1, int(-(-n // block_rows))) for n in of_first]
        asked = pinned(self.visits(queries))
        # One row a first half cell.
        asks = dict(asked.groupBy("c1").agg(F.count("*").alias("n")).collect())
        query_parts = [max(1, -(-asks.get(c, 0) // block_rows)) for c in range(self.books.k)]

        def part(of: list[int], column: str) -> Column:
            return F.pmod(F.xxhash64(F.lit("part"), column), F.get(F.array(*map(F.lit, of)), F.col("c1")))

        def each(of: list[int]) -> Column:
            return F.explode(F.sequence(F.lit(0), F.get(F.array(*map(F.lit, of)), F.col("c1")) - 1))

        entries = self.entries.withColumn("part", part(parts, "vec_id").cast("int")).withColumn("query_part", each(query_parts))
        asked = asked.withColumn("query_part", part(query_parts, "query_id").cast("int")).withColumn("part", each(parts))
        by = ["c1", "part", "query_part"]

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            found: list[tuple[int, int, float]] = []
            if len(left) and len(right):
                ids, x, c2 = right["vec_id"].to_numpy(), np.stack(right["embedding"].to_numpy()), right["c2"].to_numpy()
                for own, vector, seconds in zip(left["query_id"].tolist(), left["query"], left["seconds"]):
                    visited = np.zeros(k, dtype=bool)
                    visited[seconds] = True
                    rows = np.flatnonzero(visited[c2])
                    d = ((x[rows] - vector) ** 2).sum(1)
                    found += [(own, *pair) for pair in _nearest(ids[rows], d, x[rows], vector, own, top)]
            out = pd.DataFrame(found, columns=["query_id", "vec_id", "score"])
            return out.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

        k = self.books.k
        met = asked.groupBy(*by).cogroup(entries.groupBy(*by)).applyInPandas(run, _FOUND)
        return ranked(met, top)


def smallest_of_id(queries: DataFrame) -> DataFrame:
    """One row a vec_id, its smallest vector."""
    return queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def nearest_neighbours(vectors: DataFrame, every: int = 100, top: int = 10, dims: int = 64, reach: float = 0.97) -> DataFrame:
    """The `top` nearest found of each query, a row whose vec_id is divisible by `every`.

    query_id, rank, vec_id, score, then measured_recall, the share of the probes' true neighbours within the budget,
    and looked_at, the budget as a share of all vectors.
    """
    kept = searchable(vectors, dims)
    queries = smallest_of_id(kept.where(F.col("vec_id") % every == 0))
    index = MultiIndex(kept, dims)
    if not index.rows:
        return ranked(queries.selectExpr("vec_id as query_id", "vec_id", "0D as score"), top).selectExpr("*", "1D as measured_recall", "0D as looked_at")
    index.calibrate(queries, top, reach)
    found = index.search(queries, top)
    share = min(1.0, index.budget / index.rows)
    return found.withColumns({"measured_recall": F.lit(index.measured_recall), "looked_at": F.lit(share)})
