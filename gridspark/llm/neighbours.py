"""Approximate nearest neighbours by largest inner product with balanced posting lists.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, queries a zero; the nearest by Euclid's distance are
then those with the largest inner product. Lists: a bounded sample is halved again and again at the median of its direction
of largest spread, until `list_size` rows of the whole table would fall to each part; part means are the centroids, so
lists are of about equal size. A graph in memory joins each centroid to its nearest ones; best-first search in that graph finds
the lists of a vector. A vector goes to its nearest list and, if it lies near a border, to further ones whose distance
is within a ratio. A query scans the lists within a ratio of its nearest distance, at least so many and so many ids.

The scan runs list by list; lists above PIECE vectors (copies of one vector, say) are cut into pieces by a hash of vec_id
and vector; a query visits all pieces. Scores are inner products of the vectors as given, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.session import materialize

K = 20
FIT_BYTES = 128 << 20
LIST_SIZE, FIT_ROWS, FIT_ROWS_PER_LIST = 128, 100_000, 16
REPLICAS, REPLICA_RATIO, ASSIGN_BEAM = 4, 1.2, 24
LEAST_LISTS, PROBE_RATIO, LEAST_VECTORS, PROBE_BEAM = 8, 1.18, 400, 48
#: A query visits at most PROBE_SHARE * lists ** PROBE_POWER lists, or that number raised by halves until FIT_RECALL of the
#: neighbours of FIT_QUERIES rows are found among sampled rows that the lists were not fitted to (a quarter of those that were).
PROBE_SHARE, PROBE_POWER, FIT_QUERIES, FIT_RECALL, HELD_OUT = 0.4, 0.75, 400, 0.96, 4
DEGREE, ENTRIES = 16, 16
PIECE, HELD_ROWS = 4096, 1_000_000


def halve(sample: np.ndarray, lists: int, seed: int = 3) -> np.ndarray:
    """Means of `lists` parts of nearly equal size."""
    rng = np.random.default_rng(seed)
    done, open_ = [], [(np.arange(len(sample)), lists)]
    while open_:
        rows, n = open_.pop()
        if n <= 1 or len(rows) < 2:
            done.append(sample[rows].mean(axis=0))
            continue
        x = sample[rows] - sample[rows].mean(axis=0)
        direction = rng.normal(size=x.shape[1])
        for _ in range(6):  # power iterations towards the direction of largest spread
            direction = x.T @ (x @ direction)
            size = np.linalg.norm(direction)
            if size == 0:
                break
            direction /= size
        order = np.argsort(x @ direction, kind="stable")
        left = n // 2
        cut = len(rows) * left // n
        open_ += [(rows[order[:cut]], left), (rows[order[cut:]], n - left)]
    return np.stack(done)


@dataclass
class Graph:
    """Centroids, each one's neighbours (nearest first, then some at random) and the nodes at which searches start."""
    nodes: np.ndarray
    edges: np.ndarray
    entries: np.ndarray

    @classmethod
    def over(cls, nodes: np.ndarray, seed: int = 5) -> Graph:
        rng = np.random.default_rng(seed)
        n = len(nodes)
        squares = (nodes ** 2).sum(axis=1)
        near = np.empty((n, min(DEGREE, n)), np.int64)
        for lo in range(0, n, 1024):
            d = squares - 2 * nodes[lo:lo + 1024] @ nodes.T
            d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
            near[lo:lo + 1024] = np.argsort(d, axis=1, kind="stable")[:, :near.shape[1]]
        far = rng.integers(0, n, (n, 4))
        return cls(nodes, np.concatenate([near, far], axis=1), rng.permutation(n)[:ENTRIES])

    def distances(self, x: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each row of x to its row of `nodes`."""
        return ((self.nodes[nodes] - x[:, None]) ** 2).sum(axis=2)

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, squared distances) of the best `beam` nodes of each row of x, nearest first; -1 and inf where fewer.
        A step opens the nearest nodes not opened yet, a sixteenth of the beam at once."""
        rows, wide = len(x), max(4, beam // 16)
        pool = np.full((rows, beam), -1)
        dist = np.full((rows, beam), np.inf)
        opened = np.zeros((rows, beam), bool)
        named = np.zeros((rows, len(self.nodes)), bool)
        fresh, live = np.tile(self.entries, (rows, 1)), np.arange(rows)
        while len(live):
            fresh = np.sort(fresh, axis=1)
            old = named[live[:, None], fresh]
            old[:, 1:] |= fresh[:, 1:] == fresh[:, :-1]
            named[live[:, None], fresh] = True
            d = np.where(old, np.inf, self.distances(x[live], fresh))
            all_nodes = np.concatenate([pool[live], np.where(old, -1, fresh)], axis=1)
            all_dist = np.concatenate([dist[live], d], axis=1)
            all_opened = np.concatenate([opened[live], np.zeros(d.shape, bool)], axis=1)
            order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
            pool[live] = np.take_along_axis(all_nodes, order, 1)
            dist[live] = np.take_along_axis(all_dist, order, 1)
            opened[live] = np.take_along_axis(all_opened, order, 1)
            todo = ~opened[live] & (pool[live] >= 0)
            live, todo = live[todo.any(axis=1)], todo[todo.any(axis=1)]
            spots = np.argsort(~todo, axis=1, kind="stable")[:, :wide]
            more = np.take_along_axis(todo, spots, 1)
            opened[live[:, None], spots] = True
            # rows with fewer to open repeat a node that is known
            fresh = self.edges[np.where(more, pool[live[:, None], spots], self.entries[0])].reshape(len(live), more.shape[1] * self.edges.shape[1])
        return pool, dist


def replicas(graph: Graph, x: np.ndarray) -> list[np.ndarray]:
    """Lists of each row: the nearest, and the next ones within the ratio."""
    pool, dist = graph.search(x, ASSIGN_BEAM)
    out = []
    for nodes, d in zip(pool, np.sqrt(dist)):
        near = nodes[(d <= REPLICA_RATIO * d[0] + 1e-12) & (nodes >= 0)]
        out.append(near[:REPLICAS])
    return out


def nearest_lists(graph: Graph, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The best `most` lists of a search whose beam is half as wide again."""
    pool, dist = graph.search(x, min(len(graph.nodes), most + most // 2))
    return pool[:, :most], dist[:, :most]


def lists_to_visit(graph: Graph, sample: np.ndarray, most: float, k: float, seed: int = 7) -> int:
    """How many lists a query visits at most, tried on rows that the lists were not fitted to: the `k` nearest among them (k times
    their share of the table) of some have to be found. In data without clusters the number grows with a power of all
    lists below one."""
    n, lists = len(sample), len(graph.nodes)
    asked = np.random.default_rng(seed).permutation(n)[:FIT_QUERIES]
    k = min(max(1, ceil(k)), n - 1)
    if k < 1:
        return lists
    near = []
    for lo in range(0, len(asked), 64):
        part = asked[lo:lo + 64]
        score = sample[part] @ sample.T
        score[np.arange(len(part)), part] = -np.inf
        near.append(np.argpartition(-score, k - 1, axis=1)[:, :k])
    need, place = np.unique(np.concatenate(near), return_inverse=True)
    homes = [h for lo in range(0, len(need), 1024) for h in replicas(graph, augmented(sample[need[lo:lo + 1024]], most))]
    homes = np.stack([np.pad(h, (0, REPLICAS - len(h)), mode="edge") for h in homes])[place.reshape(-1, k)]
    queries, visit = augmented(sample[asked], 0.0), max(PROBE_BEAM, ceil(PROBE_SHARE * lists ** PROBE_POWER))
    while visit < lists:
        pool, _ = nearest_lists(graph, queries, visit)
        seen = np.zeros((len(asked), lists + 1), bool)
        np.put_along_axis(seen, np.where(pool < 0, lists, pool), True, 1)
        if seen[np.arange(len(asked))[:, None, None], homes].any(axis=2).mean() >= FIT_RECALL:
            return visit
        visit += visit // 2
    return lists


def probes(graph: Graph, x: np.ndarray, counts: np.ndarray, most: int) -> list[np.ndarray]:
    """Lists that each query scans: those within the ratio, at least LEAST_LISTS and LEAST_VECTORS ids, at most `most`."""
    pool, dist = nearest_lists(graph, x, most)
    out = []
    for nodes, d in zip(pool, np.sqrt(dist)):
        nodes, d = nodes[nodes >= 0], d[nodes >= 0]
        held = np.cumsum(counts[nodes])
        need = max(LEAST_LISTS, int(np.searchsorted(held, LEAST_VECTORS)) + 1)
        within = int((d <= PROBE_RATIO * d[0] + 1e-12).sum())
        out.append(nodes[:max(need, within)])
    return out


class Best:
    """The k best ids found so far of each query, over all lists that one task scans."""

    def __init__(self, k: int) -> None:
        self.k, self.parts, self.size = k, [], 0

    def add(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        self.parts.append((np.full(len(ids), query), ids, scores))
        self.size += len(ids)

    def prune(self) -> int:
        if self.parts:
            query, ids, scores = (np.concatenate(c) for c in zip(*self.parts))
            # one row of each id, the best, before the cut: an id may stand in two lists, or have several vectors
            order = np.lexsort((-scores, ids, query))
            query, ids, scores = query[order], ids[order], scores[order]
            new = np.ones(len(ids), bool)
            new[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
            query, ids, scores = query[new], ids[new], scores[new]
            order = np.lexsort((ids, -scores, query))
            query, ids, scores = query[order], ids[order], scores[order]
            heads = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
            rank = np.arange(len(query)) - np.repeat(heads, np.diff(np.append(heads, len(query))))
            self.parts = [(query[rank < self.k], ids[rank < self.k], scores[rank < self.k])]
            self.size = int((rank < self.k).sum())
        return self.size

    def give(self) -> pa.RecordBatch:
        none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        columns = [np.concatenate(c) for c in zip(*(self.parts or [none]))]
        self.parts, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


def augmented(x: np.ndarray, most: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(0, most - (x ** 2).sum(axis=1)))[:, None]], axis=1)


def _matrix(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the usable rows, their vectors): `size` finite numbers, not all zero."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    rows = np.flatnonzero(lengths == size)
    x = flat[starts[rows][:, None] + np.arange(size)]
    good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    return rows[good], x[good]


def top(x: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> Iterator[tuple]:
    """(query, ids, scores) of the k best ids of x for each query, its own id left out first, ties to smaller ids; of rows with
    one id the best counts. Equal vectors get equal scores: what the matrix product finds is summed anew in one order."""
    by_id = np.argsort(ids, kind="stable")
    x, ids = x[by_id], ids[by_id]
    heads = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    names, repeated = ids[heads], len(heads) < len(ids)
    for i, (q, name) in enumerate(zip(queries, query_ids)):
        if i % 256 == 0:
            products = queries[i:i + 256] @ x.T
        score = products[i % 256]
        best = np.maximum.reduceat(score, heads) if repeated else score.copy()
        best[names == name] = -np.inf
        if len(best) > k:
            edge = np.partition(best, len(best) - k)[len(best) - k]
            near = np.flatnonzero(score >= edge - 1e-9 * (1 + abs(edge))) if np.isfinite(edge) else np.arange(len(score))
        else:
            near = np.arange(len(score))
        near = near[ids[near] != name]
        exact = (x[near] * q).sum(axis=1)
        order = np.lexsort((ids[near], -exact))
        if repeated:  # the best row of each id
            order = order[np.sort(np.unique(ids[near][order], return_index=True)[1])]
        yield name, ids[near][order[:k]], exact[order[:k]]


def search(vectors: DataFrame, every: int = 20, k: int = K, list_size: int = LIST_SIZE, fit_rows: int = FIT_ROWS,
           piece: int = PIECE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose vec_id is divisible by `every`.

    Rows of (vec_id, embedding); rows without vec_id, and vectors that are null, zero, not finite in all places or of
    another length than most (ties: the longest), take no part. Of rows with one vec_id, each is a candidate and the best
    counts; the least vector is the query.
    """
    spark = vectors.sparkSession
    # single floats are carried as such, which loses nothing; all sums are taken in doubles
    kind = np.dtype(np.float32 if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else np.float64)

    def decoded(column) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, size).astype(np.float64)

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")).where(
        "vec_id is not null and embedding is not null")
    lengths = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None or lengths["size"] == 0:
        return spark.createDataFrame([], schema)
    size = lengths["size"]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _matrix(batch.column("embedding"), size)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(at)), pa.array((x ** 2).sum(axis=1)),
                                              pa.array([v.tobytes() for v in x.astype(kind)], pa.binary())], ["vec_id", "square", "vector"])

    # rows repeated as a whole are one candidate
    usable = materialize(rows.mapInArrow(measured, "vec_id long, square double, vector binary").dropDuplicates(["vec_id", "vector"]),
                         "vectors")
    n, most = usable.agg(F.count("*"), F.max("square")).first()
    if not n:
        return spark.createDataFrame([], schema)
    # the index is fitted on the rows with the lowest hashes of vec_id, a bounded number of rows and bytes
    fit_rows = max(FIT_ROWS_PER_LIST, min(fit_rows, FIT_BYTES // (8 * size)) * HELD_OUT // (HELD_OUT + 1))
    lists = max(1, min(n // list_size, fit_rows // FIT_ROWS_PER_LIST))
    fit = min(fit_rows, lists * FIT_ROWS_PER_LIST)
    sample = usable.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(fit + fit // HELD_OUT).select("vector").collect()
    sample = np.stack([np.frombuffer(r["vector"], kind).astype(np.float64) for r in sample])
    fitted, rest = Graph.over(halve(augmented(sample[:fit], most), lists)), sample[fit:]
    visit = lists_to_visit(fitted, rest, most, k * len(rest) / n)
    graph = spark.sparkContext.broadcast(fitted)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = decoded(batch.column("vector"))
            chosen = [r for lo in range(0, len(x), 1024) for r in replicas(graph.value, augmented(x[lo:lo + 1024], most))]
            row = np.repeat(np.arange(len(x)), [len(r) for r in chosen])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(chosen).astype(np.int32)), batch.column("vec_id").take(pa.array(row)),
                 batch.column("vector").take(pa.array(row))], ["list", "vec_id", "vector"])

    posted = materialize(usable.select("vec_id", "vector").mapInArrow(dealt, "list int, vec_id long, vector binary"), "lists")
    counts, sizes = np.zeros(lists, np.int64), np.zeros(lists, np.int64)
    for r in posted.groupBy("list", "vec_id").count().groupBy("list").agg(
            F.count("*").alias("ids"), F.sum("count").alias("rows")).collect():  # one row a list
        counts[r["list"]], sizes[r["list"]] = r["ids"], r["rows"]
    pieces = np.maximum(1, -(-sizes // piece))
    held = spark.sparkContext.broadcast((counts, pieces))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, pieces = held.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = decoded(batch.column("vector"))
            x = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
            chosen = [r for lo in range(0, len(x), 512) for r in probes(graph.value, x[lo:lo + 512], counts, visit)]
            row = np.repeat(np.arange(len(x)), [len(r) for r in chosen])
            lists = np.concatenate(chosen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists.astype(np.int32)), pa.array(pieces[lists].astype(np.int32)),
                 batch.column("vec_id").take(pa.array(row)), batch.column("vector").take(pa.array(row))],
                ["list", "pieces", "vec_id", "vector"])

    queries = (usable.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
               .repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(asked, "list int, pieces int, vec_id long, vector binary")
               .select("list", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(True).alias("query"),
                       "vec_id", "vector"))
    # lists of over `piece` vectors are few (their number is bounded by the number of lists): literals, no join
    large = F.create_map(*[F.lit(int(v)) for i in np.flatnonzero(pieces > 1) for v in (i, pieces[i])]) if (pieces > 1).any() else None
    cut = F.lit(1) if large is None else F.coalesce(large[F.col("list")], F.lit(1))
    posts = posted.select("list", F.pmod(F.xxhash64("vec_id", "vector"), cut).cast("int").alias("piece"), F.lit(False).alias("query"),
                          "vec_id", "vector")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)

        def scan(parts: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(parts)
            ask = rows.column("query").to_numpy()
            ids = rows.column("vec_id").to_numpy()
            x = decoded(rows.column("vector"))
            if ask.any() and not ask.all():
                for found in top(x[~ask], ids[~ask], x[ask], ids[ask], k):
                    best.add(*found)

        held, name = [], None
        for batch in batches:
            key = batch.column("list").to_numpy().astype(np.int64) << 32 | batch.column("piece").to_numpy()
            heads = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for lo, hi in zip(heads, heads[1:]):
                if key[lo] != name and held:
                    scan(held)
                    held = []
                name = key[lo]
                held.append(batch.slice(lo, hi - lo))
            if best.size > HELD_ROWS and best.prune() > HELD_ROWS // 2:
                yield best.give()
        if held:
            scan(held)
        best.prune()
        yield best.give()

    found = (posts.unionByName(queries).repartition("list", "piece").sortWithinPartitions("list", "piece", "query")
             .mapInArrow(scanned, "query_id long, vec_id long, score double")
             .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
