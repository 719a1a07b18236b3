"""Centroid clustering with bounds that loosen by geometry.

Vectors become integers and lie in blocks, each with its vectors' cluster, an upper bound on the distance to
their own centroid and a lower bound on that to any other. After the centroids have moved, the upper bound
grows by the own centroid's drift. The lower bound of a cluster's vectors shrinks by less than the largest
drift: all of them lie in a sphere around their centroid, and in the plane through that centre and the line
on which another centroid moves, the sphere is a disk. There the gain in distance grows along the line and
falls away from it, so that its largest value over thin strips of the disk bounds it. Vectors whose upper bound
lies below their lower bound stay without a look at any centroid; of the rest the own distance is taken
exactly, and those that are still open are compared with all centroids in whole numbers.

A round maps the blocks and writes them to the shared checkpoint folder, with one row of sums per task's block
and cluster, summed by Spark. The driver holds the centroids and a number per pair of centroids.

Defined results: a vector takes part if it has `dims` components, none null or non-finite, and none so large
that its scaled value passes 2^62. A null vec_id reads as an empty text where the first centroids are drawn;
equal digests (repeated rows) go by components. With fewer vectors than centroids there are as many centroids
as vectors; an empty table gives an empty result. A squared distance or sum beyond a long is null. Repeated
rows are vectors of their own. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlflow.llm.shared import pinned

#: Up to this size components, products and squared distances are exact as doubles.
EXACT = 1 << 22
LONG_MAX = (1 << 63) - 1
#: What bounds are widened by, relative to their size: far more than the rounding of their few operations.
SLACK = 1e-9
STRIPS = 32
_BLOCK = (
    "kind string, ids array<bigint>, vectors binary, width int, cluster binary, upper binary, lower binary, "
    "of_cluster int, n bigint, looked bigint, radius double, inertia decimal(38,0), sums array<decimal(38,0)>"
)


def quantised(vectors: DataFrame, dims: int = 64, scale: int = 256) -> DataFrame:
    """vec_id and `q`, the whole numbers floor(scale * x), of the vectors that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) * scale < float(1 << 62)))
    # NaN compares as larger than any number, so the bound leaves it out as well.
    kept = vectors.where((F.size("embedding") == dims) & whole)
    return kept.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("q"))


def first_centroids(numbers: DataFrame, k: int = 40, salt: str = "2:") -> list[list[int]]:
    """The k vectors with the smallest sha256 of salt and vec_id, in that order."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r["q"]) for r in numbers.select("q", digest.alias("digest")).orderBy("digest", "q").limit(k).collect()]


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per cluster, what its vectors' lower bounds lose at most when the centroids move from `old` to `new`.

    `radius` bounds the distance of a cluster's vectors to their old centroid. Of a strip of the disk the
    farthest point along the line and the nearest to it bound the gain.
    """
    k = len(old)
    if k < 2:
        return np.zeros(k)
    move = new - old
    drift = np.sqrt((move**2).sum(1))
    along = move / np.where(drift > 0, drift, 1)[:, None]
    apart = old[:, None, :] - old[None, :, :]  # of the sphere's centre i from the start of centroid j
    t = np.einsum("ijd,jd->ij", apart, along)
    s = np.sqrt(np.maximum((apart**2).sum(2) - t**2, 0))
    r = radius[:, None, None] * (1 + SLACK)
    ends = np.linspace(-1, 1, STRIPS + 1)
    # The widest half chord of a strip is at its end nearer to the centre.
    inner = np.minimum(np.abs(ends[:-1]), np.abs(ends[1:]))
    chord = np.sqrt(1 - inner**2)
    far = t[:, :, None] + r * ends[1:]
    near = np.maximum(s[:, :, None] * (1 - SLACK) - r * chord, 0)
    gain = np.hypot(far, near) - np.hypot(far - drift[None, :, None], near)
    scale = np.abs(far).max(2) + s + drift
    most = np.minimum(np.maximum(gain.max(2), 0) + SLACK * scale, drift * (1 + SLACK))
    np.fill_diagonal(most, 0)
    return most.max(1)


def _distances(x: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Exact squared distances of whole vectors to all centroids: doubles where they are exact, else Python numbers."""
    c = np.array(centroids, dtype=object)
    if x.dtype == np.float64 and max(map(abs, c.flat)) <= EXACT:
        c = c.astype(np.float64)
        return (x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (x @ c.T)
    x = np.array([[int(v) for v in row] for row in x], dtype=object).reshape(len(x), c.shape[1])
    return ((x[:, None, :] - c[None, :, :]) ** 2).sum(2)


def _own(x: np.ndarray, centroids: list[list[int]], cluster: np.ndarray) -> np.ndarray:
    """Exact squared distances to the own centroid."""
    c = np.array(centroids, dtype=object)
    if x.dtype == np.float64 and max(map(abs, c.flat)) <= EXACT:
        return ((x - c.astype(np.float64)[cluster]) ** 2).sum(1)
    x = np.array([[int(v) for v in row] for row in x], dtype=object).reshape(len(x), c.shape[1])
    return ((x - c[cluster]) ** 2).sum(1)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def _numbers(row: dict) -> np.ndarray:
    """The vectors of a block as doubles if they are exact as such, else as 64-bit numbers."""
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[row["width"]]
    x = np.frombuffer(row["vectors"], dtype=kind).reshape(len(row["ids"]), -1)
    return x.astype(np.float64) if row["width"] < 8 and np.abs(x.astype(np.int64)).max(initial=0) <= EXACT else x.astype(np.int64)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    number = pa.decimal128(38, 0)
    kinds = {
        "kind": pa.string(), "ids": pa.list_(pa.int64()), "vectors": pa.binary(), "width": pa.int32(), "cluster": pa.binary(),
        "upper": pa.binary(), "lower": pa.binary(), "of_cluster": pa.int32(), "n": pa.int64(), "looked": pa.int64(),
        "radius": pa.float64(), "inertia": number, "sums": pa.list_(number),
    }
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kind) for n, kind in kinds.items()], names=list(kinds))


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.asarray(batch.column(1).flatten(), dtype=np.int64).reshape(batch.num_rows, -1)
        most = max(abs(int(x.min())), abs(int(x.max())))
        width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
        n = batch.num_rows
        row = {
            "kind": "block", "ids": batch.column(0).to_pylist(), "vectors": x.astype(f"<i{width}").tobytes(), "width": width,
            "cluster": np.zeros(n, np.int32).tobytes(), "upper": np.full(n, np.inf).tobytes(), "lower": np.full(n, -np.inf).tobytes(),
        }
        yield _batch([row])


def assign(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: list[list[int]]) -> int:
    """Bring the arrays of a block up to date with the centroids; how many vectors were compared with all of them."""
    open_ = np.flatnonzero(~(upper < lower))
    if len(open_):
        own = _root(_own(x[open_], centroids, cluster[open_])) * (1 + SLACK)
        upper[open_] = own
        open_ = open_[~(own < lower[open_])]
    for at in range(0, len(open_), 2048):
        part = open_[at : at + 2048]
        d = _distances(x[part], centroids)
        nearest = d.argmin(1)  # the smallest number of equals
        rows = np.arange(len(part))
        upper[part] = _root(d[rows, nearest]) * (1 + SLACK)
        cluster[part] = nearest
        if d.shape[1] > 1:
            others = d.copy()
            others[rows, nearest] = d.max() + 1
            lower[part] = _root(others.min(1)) * (1 - SLACK)
        else:
            lower[part] = np.inf
    return len(open_)


def _step(centroids: list[list[int]], drift: np.ndarray, loose: np.ndarray, last: bool):
    """A round over blocks: the blocks with new clusters and bounds, and a row of sums a cluster and block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            x = _numbers(row)
            cluster, upper, lower = (
                np.frombuffer(row[name], dtype=kind).copy() for name, kind in (("cluster", np.int32), ("upper", np.float64), ("lower", np.float64))
            )
            upper += drift[cluster]
            lower -= loose[cluster]
            looked = assign(x, cluster, upper, lower, centroids)
            out = [row | {"cluster": cluster.tobytes(), "upper": upper.tobytes(), "lower": lower.tobytes()}]
            own = _own(x, centroids, cluster) if last else None
            for c in np.unique(cluster):
                mine = cluster == c
                exact = x.dtype == np.float64
                sums = x[mine].sum(0) if exact else x[mine].astype(object).sum(0)
                out.append({
                    "kind": "sums", "of_cluster": int(c), "n": int(mine.sum()), "looked": looked, "radius": float(upper[mine].max()),
                    "sums": [int(v) for v in sums], "inertia": int(own[mine].sum()) if last else None,
                })
                looked = 0
            yield _batch(out)

    return run


def _told(step: DataFrame, dims: int) -> list:
    """Per cluster: vectors, vectors compared with all centroids, radius, inertia and the sums of the components."""
    sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(dims)]
    parts = step.where("kind = 'sums'").groupBy("of_cluster")
    return parts.agg(F.sum("n").alias("n"), F.sum("looked").alias("looked"), F.max("radius").alias("radius"), F.sum("inertia").alias("inertia"), *sums).collect()


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and `looked` of every vector.

    `looked` is the share of comparisons with all centroids that were made, over all rounds.
    """
    spark = vectors.sparkSession
    numbers = quantised(vectors, dims, scale)
    centroids = first_centroids(numbers, k)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not centroids:
        empty = spark.createDataFrame([], schema)
        return empty.selectExpr("*", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256", "0D as looked")
    numbers = numbers.select(F.col("vec_id").cast("bigint"), "q")
    state = pinned(numbers.mapInArrow(_blocks, _BLOCK))
    drift = loose = np.zeros(len(centroids))
    looked = vectors_seen = 0
    for turn in range(rounds + 1):
        last = turn == rounds
        state = pinned(state.where("kind = 'block'").mapInArrow(_step(centroids, drift, loose, last), _BLOCK))
        told = {r["of_cluster"]: r for r in _told(state, dims)}
        looked += sum(r["looked"] for r in told.values())
        vectors_seen += sum(r["n"] for r in told.values())
        if not last:
            moved = [[int(told[c][f"s{i}"]) // told[c]["n"] for i in range(dims)] if c in told else old for c, old in enumerate(centroids)]
            before, after = (np.array(v, dtype=object).astype(np.float64) for v in (centroids, moved))
            steps = np.array([[a - b for a, b in zip(x, y)] for x, y in zip(moved, centroids)], dtype=object).astype(np.float64)
            drift = np.sqrt((steps**2).sum(1)) * (1 + SLACK)
            radius = np.array([told[c]["radius"] if c in told else 0.0 for c in range(len(centroids))])
            loose = loosening(before, after, radius)
            centroids = moved
    final = centroids

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            cluster = np.frombuffer(row["cluster"], dtype=np.int32)
            own = [d if (d := int(v)) <= LONG_MAX else None for v in _own(_numbers(row), final, cluster)]
            ids = pa.array(row["ids"], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster), pa.array(own, pa.int64())], names=["vec_id", "cluster", "distance"])

    def long_or_none(value: int) -> int | None:
        return value if value <= LONG_MAX else None

    inertia = long_or_none(sum(int(r["inertia"]) for r in told.values()))
    share = looked / vectors_seen
    of = [
        (c, long_or_none(int(r["inertia"])), inertia, hashlib.sha256(",".join(map(str, final[c])).encode()).hexdigest(), share)
        for c, r in told.items()
    ]
    table = spark.createDataFrame(of, "of_cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string, looked double")
    found = state.where("kind = 'block'").mapInArrow(rows, schema)
    # One row a cluster: k rows at most.
    return found.join(F.broadcast(table), F.col("cluster") == F.col("of_cluster")).drop("of_cluster")
