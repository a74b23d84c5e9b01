"""Approximate nearest neighbours with an inverted multi-index.

Each half of the vectors is quantised by a codebook of its own; a pair of centroids is a cell. A query visits cells in
the order of its summed squared distances to the two centroids, taken from a heap, until the cells hold a given share of
the index; the rows of visited cells are reranked by exact distance.

Every row is indexed; only the codebooks are fitted on a bounded sample, and little more than the sample reaches the driver.
Equal vectors are one entry that keeps the smallest ids, and cells are dealt into shards of bounded size, a large cell into
several, so neither a hot vector nor a hot cell meets in one task. Consecutive shards form regions of bounded bytes: a task
holds the entries of one region, and the queries that visit it pass by in blocks.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import map_arrow, shuffle_partitions
from wattledger.plans.storage import scratch_dir, written

NEIGHBOURS = 10
CENTROIDS = 64  # per half
SAMPLE = 10_000  # vectors the codebooks are fitted on
SHARE = 0.5  # of the index that a query visits at least; what recall asks for in data without clusters
SHARD_ROWS = 2048
QUERY_BLOCK = 128
REGION_BYTES = 32 << 20  # of vectors that a task holds at once
REGIONS_PER_CORE = 8  # wanted at least
BLOCK_CELLS = 4 << 20  # of the table of distances of one block


def codebook(vectors: np.ndarray, centroids: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's k-means, started from rows spread evenly over the sample."""
    found = vectors[np.linspace(0, len(vectors) - 1, centroids).astype(int)].astype(np.float64)
    for _ in range(rounds):
        nearest = _nearest(vectors, found)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, vectors)
        counts = np.bincount(nearest, minlength=centroids)
        found[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return found


def _nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(1) - 2 * vectors @ centroids.T).argmin(1)


@dataclass
class MultiIndex:
    """Two codebooks, the entries of each cell (first x second centroid), and the shards its entries are dealt to."""

    books: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray
    shard: np.ndarray  # first shard of each cell
    parts: np.ndarray  # shards of each cell

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        middle = self.books[0].shape[1]
        return vectors[:, :middle], vectors[:, middle:]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        first, second = (_nearest(v, b) for v, b in zip(self.halves(vectors), self.books, strict=True))
        return first * len(self.books[1]) + second

    def visited(self, vector: np.ndarray, entries: int) -> np.ndarray:
        """Whether each cell is visited: in the order of summed distances, until they hold ``entries`` entries."""
        distances = [((b - v[0]) ** 2).sum(1) for v, b in zip(self.halves(vector[None]), self.books, strict=True)]
        orders = [np.argsort(d, kind="stable").tolist() for d in distances]
        sorted_ = [np.sort(d).tolist() for d in distances]
        n, m = len(orders[0]), len(orders[1])
        sizes = self.sizes.tolist()
        out = np.zeros(n * m, dtype=bool)
        # a pair is pushed once both the pair before it in its row and the one before it in its column are taken
        taken = [0] * n
        heap = [(sorted_[0][0] + sorted_[1][0], 0, 0)]
        held = 0
        while heap and held < entries:
            _, i, j = heapq.heappop(heap)
            cell = orders[0][i] * m + orders[1][j]
            out[cell] = True
            held += sizes[cell]
            taken[i] = j + 1
            if j + 1 < m and (i == 0 or taken[i - 1] >= j + 2):
                heapq.heappush(heap, (sorted_[0][i] + sorted_[1][j + 1], i, j + 1))
            if i + 1 < n and taken[i + 1] == j:
                heapq.heappush(heap, (sorted_[0][i + 1] + sorted_[1][j], i + 1, j))
        return out

    def shards_of(self, visited: np.ndarray) -> np.ndarray:
        """The shards that hold entries of visited cells."""
        cells = np.flatnonzero(visited & (self.sizes > 0))
        parts = self.parts[cells]
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        return np.unique(np.repeat(self.shard[cells], parts) + within)

    def span(self, dimension: int, cores: int) -> int:
        """Consecutive shards that form a region: the more, the fewer copies of a query travel."""
        shards = int((self.shard + self.parts).max())
        most = REGION_BYTES // (8 * dimension * SHARD_ROWS)
        return max(1, min(most, shards // (REGIONS_PER_CORE * cores)))

    def regions(self, span: int) -> dict[int, np.ndarray]:
        """Region -> the cells that have entries in it, in ascending order."""
        out: dict[int, list[int]] = {}
        for cell in np.flatnonzero(self.sizes > 0).tolist():
            for region in range(self.shard[cell] // span, (self.shard[cell] + self.parts[cell] - 1) // span + 1):
                out.setdefault(region, []).append(cell)
        return {region: np.array(cells) for region, cells in out.items()}


def usable_vectors(embeddings: DataFrame, dimension: int | None = None) -> tuple[DataFrame, int]:
    """(id, vector as doubles) of the rows that take part, and their common length.

    Left out: null ids and vectors, vectors that hold null or non-finite components or only zeros, and vectors whose
    length is not ``dimension``, or else the most frequent one (the shorter of two equally frequent ones).
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("id IS NOT NULL AND vector IS NOT NULL").where(finite & F.exists("vector", lambda x: x != 0))
    if dimension is not None:
        return rows.where(F.size("vector") == dimension), dimension
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    dimension = sizes[0]["d"] if sizes else 0
    return rows.where(F.size("vector") == dimension), dimension


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _distinct(dimension: int, keep: int):
    """Vectors of a batch as bytes, each with its ``keep`` smallest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_of: dict[bytes, list[int]] = {}
            for i, vector in zip(batch.column(0).to_pylist(), _matrix(batch.column(1), dimension) + 0.0, strict=True):
                ids_of.setdefault(vector.tobytes(), []).append(i)
            ids = [sorted(set(x))[:keep] for x in ids_of.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(ids_of), pa.binary()), pa.array(ids, pa.list_(pa.int64()))], ["vector", "ids"])

    return run


def _stacked(column: pa.Array) -> np.ndarray:
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)


def _cells(index: MultiIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = index.cells(_stacked(batch.column(0))).astype(np.int32) if batch.num_rows else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cells), *batch.columns], ["cell", "vector", "ids"])

    return run


def _deal(index: MultiIndex, span: int):
    """Entries with their region; those of a large cell go to its shards by a hash of the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(0).to_numpy()
            part = np.array([zlib.crc32(v) for v in batch.column(1).to_pylist()], dtype=np.int64) % index.parts[cells]
            yield pa.RecordBatch.from_arrays([pa.array((index.shard[cells] + part) // span), *batch.columns], ["region", "cell", "vector", "ids"])

    return run


def _visits(index: MultiIndex, span: int, entries: int, dimension: int):
    """Queries with the regions they visit, and for each region which of its cells, as bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells_of = index.regions(span)
        for whole in batches:
            for start in range(0, whole.num_rows, QUERY_BLOCK):
                batch = whole.slice(start, QUERY_BLOCK)
                vectors = _matrix(batch.column(1), dimension) + 0.0
                regions, bits, ends = [], [], [0]
                for v in vectors:
                    visited = index.visited(v, entries)
                    own = np.unique(index.shards_of(visited) // span).tolist()
                    regions += own
                    bits += [np.packbits(visited[cells_of[region]]).tobytes() for region in own]
                    ends.append(len(regions))
                places = pa.StructArray.from_arrays([pa.array(regions, pa.int64()), pa.array(bits, pa.binary())], ["region", "cells"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([v.tobytes() for v in vectors], pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), places)],
                    ["id", "vector", "places"],
                )

    return run


class _Region:
    """The entries of one region, by cell."""

    def __init__(self, parts: list[tuple[np.ndarray, ...]], cells: np.ndarray):
        cell, x, counts, self.ids = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(cell, kind="stable")
        self.x = x[order]
        self.starts, self.counts = (np.cumsum(counts) - counts)[order], counts[order]
        self.place = np.searchsorted(cells, cell[order])  # of each entry's cell among those of the region
        self.bounds = np.searchsorted(self.place, np.arange(len(cells) + 1))
        # around the middle of the entries, products of the vectors lose the fewest digits
        self.middle = self.x.mean(0)
        self.moved = self.x - self.middle
        self.lengths = np.einsum("ij,ij->i", self.moved, self.moved)
        self.widest = float(np.abs(self.moved).max())

    def _rough(self, asked: np.ndarray, visited: np.ndarray) -> np.ndarray:
        """Squared distances but for one number a query; infinite where the entry's cell is not visited."""
        out = np.full((len(asked), len(self.x)), np.inf)
        for k, (start, stop) in enumerate(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)):
            own = np.flatnonzero(visited[:, k])
            if start < stop and len(own):
                out[own, start:stop] = self.lengths[start:stop] - 2 * (asked[own] @ self.moved[start:stop].T)
        return out

    def _near(self, rough: np.ndarray, bound: float, off: float, visited: np.ndarray, least: int) -> np.ndarray:
        """Whatever may be among the ``least`` nearest visited entries, or tie with the last of them."""
        if not np.isfinite(off):
            return np.flatnonzero(visited[self.place])
        near = np.flatnonzero(rough <= bound + 2 * off) if np.isfinite(bound) else np.flatnonzero(visited[self.place])
        if len(near) > least:
            kept = rough[near]
            near = near[kept <= np.partition(kept, least - 1)[least - 1] + 2 * off]
        return near

    def _found(self, near: np.ndarray, query: np.ndarray, query_id: int, neighbours: int) -> list[tuple[float, int]]:
        exact = np.sqrt(((self.x[near] - query) ** 2).sum(1)).tolist()
        ids = [self.ids[s : s + n].tolist() for s, n in zip(self.starts[near].tolist(), self.counts[near].tolist(), strict=True)]
        return sorted((d, i) for d, own in zip(exact, ids, strict=True) for i in own if i != query_id)[:neighbours]

    def nearest(self, query_ids: list[int], queries: np.ndarray, visited: np.ndarray, neighbours: int) -> Iterator[tuple[int, list[tuple[float, int]]]]:
        least = neighbours + 1
        block = max(1, min(QUERY_BLOCK, BLOCK_CELLS // len(self.x)))
        for first in range(0, len(queries), block):
            q, seen = queries[first : first + block], visited[first : first + block]
            asked = q - self.middle
            rough = self._rough(asked, seen)
            # how far off they may be
            off = 4 * np.finfo(float).eps * (q.shape[1] + 4) * (float(self.lengths.max()) + (asked**2).sum(1) + float(np.abs(self.middle).max()) * (self.widest + np.abs(asked).max(1)))
            # the distance within which some of the entries hold enough
            some = rough[:, ::8]
            bound = np.partition(some, least - 1, axis=1)[:, least - 1] if some.shape[1] >= least else np.full(len(q), np.inf)
            for k, query in enumerate(q):
                query_id = query_ids[first + k]
                near = self._near(rough[k], bound[k], off[k], seen[k], least)
                found = self._found(near, query, query_id, neighbours)
                if len(found) < neighbours and len(near) >= least:  # several entries have the query's own id
                    found = self._found(np.flatnonzero(seen[k][self.place]), query, query_id, neighbours)
                if found:
                    yield query_id, found


def _rerank(index: MultiIndex, span: int, neighbours: int):
    """The nearest entries of each region to each query that visits it, among the cells that the query visits.

    Takes rows by region, its entries before its queries.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells_of = index.regions(span)
        at, parts, region = None, [], None
        for batch in batches:
            key = 2 * batch.column(0).to_numpy() + batch.column(1).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(key, prepend=-1))
            for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], strict=True):
                rows = batch.slice(start, stop - start)
                if key[start] // 2 != at:
                    at, parts, region = key[start] // 2, [], None
                if key[start] % 2 == 0:
                    ids = rows.column(5)
                    parts.append((rows.column(3).to_numpy(), _stacked(rows.column(4)), pc.list_value_length(ids).to_numpy(), ids.flatten().to_numpy()))
                    continue
                if region is None and parts:
                    region, parts = _Region(parts, cells_of[at]), []
                if region is None:  # a part of a large cell may have no entries
                    continue
                bits = np.frombuffer(b"".join(rows.column(6).to_pylist()), np.uint8).reshape(rows.num_rows, -1)
                visited = np.unpackbits(bits, axis=1, count=len(cells_of[at])).astype(bool)
                found = list(region.nearest(rows.column(2).to_pylist(), _stacked(rows.column(4)), visited, neighbours))
                ends = np.cumsum([0, *(len(f) for _, f in found)])
                near = pa.StructArray.from_arrays([pa.array([d for _, f in found for d, _ in f], pa.float64()), pa.array([i for _, f in found for _, i in f], pa.int64())], ["score", "vec_id"])
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), near)], ["query_id", "found"])

    return run


def _sampled(distinct: DataFrame, sample: int) -> list[bytes]:
    """The ``sample`` vectors with the smallest hashes, in their order.

    Each partition would send the driver that many; so only hashes below a bound that about so many are expected under are sent.
    """
    hashed = distinct.select(F.xxhash64("vector").alias("hash"), "vector")
    rows = distinct.count()
    expected = sample + 8 * int(np.sqrt(sample)) + 8
    while True:
        few = hashed.where(F.col("hash") < -(1 << 63) + (expected << 64) // rows) if expected < rows else hashed
        found = few.orderBy("hash", "vector").limit(sample).collect()
        if len(found) == sample or expected >= rows:
            return [bytes(r["vector"]) for r in found]
        expected *= 2


def build_index(vectors: DataFrame, dimension: int, path: str, neighbours: int, centroids: int, sample: int) -> tuple[MultiIndex, DataFrame]:
    """The index, and its entries (cell, vector, ids), written to ``path``."""
    keep = neighbours + 1  # one may be the query itself
    distinct = map_arrow(vectors, _distinct(dimension, keep), "vector binary, ids array<long>").groupBy("vector").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids")
    )
    distinct = written(distinct, f"{path}/distinct")
    fitted = np.frombuffer(b"".join(_sampled(distinct, sample)), np.float64).reshape(-1, dimension)
    middle = (dimension + 1) // 2
    books = tuple(codebook(half, min(centroids, len(fitted))) for half in (fitted[:, :middle], fitted[:, middle:]))
    index = MultiIndex(books, np.zeros(len(books[0]) * len(books[1]), np.int64), np.empty(0), np.empty(0))
    entries = written(map_arrow(distinct, _cells(index), "cell int, vector binary, ids array<long>"), f"{path}/entries")
    for cell, n in entries.groupBy("cell").count().collect():  # one row per cell at most
        index.sizes[cell] = n
    # neighbouring cells share a shard until it is full; a cell larger than a shard gets shards of its own
    index.parts = np.maximum(1, -(-index.sizes // SHARD_ROWS))
    index.shard = np.zeros(len(index.sizes), np.int64)
    shard, filled = 0, 0
    for cell, (size, parts) in enumerate(zip(index.sizes.tolist(), index.parts.tolist(), strict=True)):
        if filled and filled + size > SHARD_ROWS:
            shard, filled = shard + 1, 0
        index.shard[cell] = shard
        filled += size
        if parts > 1:
            shard, filled = shard + parts, 0
    return index, entries


def nearest_neighbours(
    embeddings: DataFrame, queries: DataFrame, neighbours: int = NEIGHBOURS, share: float = SHARE, centroids: int = CENTROIDS, sample: int = SAMPLE
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest of ``embeddings`` (vec_id, embedding) found for each row of ``queries``.

    score: Euclidean distance in double precision; ranked by it, ties by the smaller vec_id. A query does not find rows
    with its own vec_id. All candidates are returned where there are no more than ``neighbours``. ``usable_vectors`` says
    which rows take part; queries of another length than the index have no result. Rows that repeat a vec_id and a vector
    are one candidate or query. Other columns are ignored; an empty table gives no rows.

    share: part of the entries that a query visits at least; with 1 the result is exact.
    """
    spark = embeddings.sparkSession
    path = scratch_dir(spark)
    vectors, dimension = usable_vectors(embeddings)
    schema = "query_id long, rank int, vec_id long, score double"
    if not dimension:
        return spark.createDataFrame([], schema)
    index, entries = build_index(vectors, dimension, path, neighbours, centroids, sample)
    wanted = max(int(np.ceil(share * index.sizes.sum())), neighbours + 1)
    span = index.span(dimension, spark.sparkContext.defaultParallelism)
    asked = usable_vectors(queries, dimension)[0].dropDuplicates()
    asked = written(map_arrow(asked, _visits(index, span, wanted, dimension), "id long, vector binary, places array<struct<region long, cells binary>>"), f"{path}/queries")

    # a query goes to the regions of the cells it visits, and comes after the entries there
    dealt = map_arrow(entries, _deal(index, span), "region long, cell int, vector binary, ids array<long>")
    dealt = dealt.selectExpr("region", "false AS asks", "CAST(NULL AS long) AS id", "cell", "vector", "ids", "CAST(NULL AS binary) AS cells")
    spread = asked.select("id", "vector", F.explode("places").alias("place"))
    spread = spread.selectExpr("place.region", "true AS asks", "id", "CAST(NULL AS int) AS cell", "vector", "CAST(NULL AS array<long>) AS ids", "place.cells")
    met = dealt.unionAll(spread).repartition(shuffle_partitions(spark), "region").sortWithinPartitions("region", "asks")
    found = map_arrow(met, _rerank(index, span, neighbours), "query_id long, found array<struct<score double, vec_id long>>")
    best = lambda column: F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))), 1, neighbours)
    salted = found.groupBy("query_id", F.pmod(F.spark_partition_id(), F.lit(16)).alias("salt")).agg(best("found").alias("found"))
    merged = salted.groupBy("query_id").agg(best("found").alias("found"))
    ranked = merged.select("query_id", F.posexplode("found").alias("place", "near"))
    return ranked.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "near.vec_id", "near.score")
