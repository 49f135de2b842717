"""Near-duplicate join on word n-grams: MinHash banding, then verification on the full sets.

Words are separated by ASCII white space and compared as they are; a text's set holds the hashes of its runs of `n` words, or
the one run of all its words if it has fewer. Two texts are linked if the Jaccard similarity of their sets reaches the
threshold. Band and row counts follow from the recall wanted at the threshold (`plan`).

Equal texts are one node with a count. Bands with equal members are kept once (a pair of near copies shares most of its
bands). The texts of a band's members come together once per kept band, large bands in square tiles of blocks, and there
pairs are compared in numpy; a pair counts in the first band that both share, so each is compared once. Tiles return each
member's number of links and its part of a spanning forest, never pairs. Classes are the components of the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm._graph import components
from gridspark.llm._text import U64, mix, releasing, row_slices, utf8, words
from gridspark.session import materialize

N, THRESHOLD, RECALL, MOST_HASHES = 5, 0.8, 0.9999, 128
BLOCK_ROWS = 1024
SLICE = 1 << 18


def plan(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band whose bands reach the recall at the threshold with at most `most` hashes."""
    best = None
    for rows in range(1, most + 1):
        if threshold ** rows < 1e-9:
            break
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))) if threshold < 1 else 1
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError("the recall needs more hashes")
    return best


def odd(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(2) + U64(seed << 32)) | U64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the word n-grams, first n-gram of each row and the total), repeats included."""
    _, _, h, first = words(data, offsets)
    counts = np.diff(first)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    out_first = np.concatenate([[0], np.cumsum(sizes)])
    factors = odd(n, 1)
    padded = np.concatenate([h, np.zeros(n, U64)])
    full = np.zeros(len(h), U64)
    for j, f in enumerate(factors):
        full += padded[j:j + len(h)] * f
    start = np.arange(int(out_first[-1])) - np.repeat(out_first[:-1] - first[:-1], sizes)
    out = full[start]
    for row in np.flatnonzero((counts > 0) & (counts < n)):
        out[out_first[row]] = (h[first[row]:first[row + 1]] * factors[:counts[row]]).sum() + U64(counts[row])
    return mix(out), out_first


def signature(h: np.ndarray, first: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the rows with n-grams, their band hashes)."""
    filled = np.flatnonzero(np.diff(first) > 0)
    if len(filled) == 0:
        return filled, np.empty((0, bands), U64)
    starts = first[filled]
    out = np.empty((len(filled), bands), U64)
    factors, weights = odd(bands * rows, 2), odd(rows, 3)
    for b in range(bands):
        total = np.full(len(filled), b, U64)
        for r in range(rows):
            total += np.minimum.reduceat((h * factors[b * rows + r]) >> U64(32), starts) * weights[r]
        out[:, b] = mix(total)
    return filled, out


@releasing
def _bands(batches: Iterator[pa.RecordBatch], n: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        flat, sizes = [np.empty((0, bands), U64)], np.zeros(batch.num_rows, np.int32)
        for lo, hi in row_slices(offsets, SLICE):
            h, first = shingles(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], n)
            filled, sig = signature(h, first, bands, rows)
            flat.append(sig)
            sizes[lo + filled] = bands
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                                         pa.array(np.concatenate(flat).ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("id"), lists], ["doc_id", "id", "bands"])


def link_tile(sets: list[np.ndarray], bands: np.ndarray, band: int, side: np.ndarray, across: bool, copies: np.ndarray,
              threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links of each member, number of the first member of its local component) of one tile.

    Pairs `across` the two sides are compared, in a tile on the diagonal all pairs. A pair is compared in the first band that its
    members share.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    names, ids = np.unique(flat, return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    marked = np.zeros(len(names), np.int64)
    links, root = np.zeros(m, np.int64), np.arange(m)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x in range(m):
        y = np.arange(x + 1, m)
        if across:
            y = y[side[y] != side[x]]
        y = y[np.minimum(sizes[y], sizes[x]) >= threshold * np.maximum(sizes[y], sizes[x])]
        y = y[~(bands[y, :band] == bands[x, :band]).any(axis=1)]
        if len(y) == 0:
            continue
        mine = ids[starts[x]:ends[x]]
        marked[mine] = 1
        if sizes[y].sum() * 4 > len(flat):
            shared = np.add.reduceat(marked[ids], starts)[y]
        else:
            shared = np.array([marked[ids[starts[k]:ends[k]]].sum() for k in y])
        marked[mine] = 0
        # in whole thousandths, so that a similarity on the threshold is one
        y = y[1000 * shared >= round(1000 * threshold) * (sizes[x] + sizes[y] - shared)]
        links[x] += copies[y].sum()
        links[y] += copies[x]
        for k in y.tolist():
            a, b = find(x), find(k)
            root[max(a, b)] = min(a, b)
    return links, np.array([find(x) for x in range(m)])


TILE = ["band", "hash", "a", "b"]


@releasing
def _link(batches: Iterator[pa.RecordBatch], n: int, threshold: float) -> Iterator[pa.RecordBatch]:
    def tile(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        rows = pa.Table.from_batches(parts).combine_chunks()
        ids = rows.column("id").to_pylist()
        chosen = sorted({x: i for i, x in enumerate(ids)}.values(), key=ids.__getitem__)
        if len(chosen) < 2:
            return None
        rows = rows.take(pa.array(chosen))
        data, offsets = utf8(rows.column("text"))
        h, first = shingles(data, offsets, n)
        sets = [np.unique(h[first[i]:first[i + 1]]) for i in range(len(chosen))]
        bands = rows.column("bands").combine_chunks()
        bands = bands.flatten().to_numpy().reshape(len(chosen), -1)
        links, root = link_tile(sets, bands, rows.column("band")[0].as_py(), rows.column("side").to_numpy(),
                                rows.column("a")[0].as_py() != rows.column("b")[0].as_py(), rows.column("copies").to_numpy(), threshold)
        ids = [ids[i] for i in chosen]
        linked = np.flatnonzero(links)
        if len(linked) == 0:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in linked], pa.binary()), pa.array([ids[root[i]] for i in linked], pa.binary()),
             pa.array(links[linked])], ["id", "root", "links"])

    held: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = [batch.column(c).to_numpy() for c in TILE]
        new = np.zeros(batch.num_rows, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        heads = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for lo, hi in zip(heads, heads[1:]):
            now = tuple(int(k[lo]) for k in keys)
            if now != name and held:
                if (out := tile(held)) is not None:
                    yield out
                held = []
            name = now
            held.append(batch.slice(lo, hi - lo))
    if held and (out := tile(held)) is not None:
        yield out


def join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL,
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies, text_md5, kept) of every row of (doc_id, text).

    class_id is the smallest doc_id of the class (null if all are), n_links the number of other rows that are linked to this
    one, equal texts among them, n_copies the number of rows with this very text, kept marks the row that stands for its class
    (and its exact repetitions, id and text). Texts without words (null, empty, blank) are
    linked to none and form a class by themselves for each row; equal short texts are linked.
    """
    bands, rows = plan(threshold, recall)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", F.unhex(F.md5(text)).alias("id"), F.col("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = materialize(keyed.mapInArrow(partial(_bands, n=n, bands=bands, rows=rows),
                                          f"doc_id {kind}, id binary, bands array<long>"), "jaccard-bands")
    nodes = (signed.where(F.size("bands") > 0).groupBy("id")
             .agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.first("bands").alias("bands")))
    nodes = materialize(nodes, "jaccard-nodes")
    spots = nodes.select("id", F.posexplode("bands").alias("band", "hash"))
    groups = (spots.groupBy("band", "hash")
              .agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("id")).alias("x"),
                   F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")).where("m > 1"))
    kept = groups.groupBy("m", "x", "y").agg(F.min(F.struct("band", "hash")).alias("g")).select("g.band", "g.hash", "m")
    blocks = F.ceil(F.col("m") / block_rows).cast("int")
    member = spots.join(kept, ["band", "hash"]).withColumn("blocks", blocks)
    own = F.pmod(F.xxhash64("id", F.lit(2)), F.col("blocks")).cast("int")
    tiles = (member.withColumn("side", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("id", "band", "hash", "side", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b")))
    tiles = tiles.join(nodes.select("id", "copies", "bands", "least"), "id")
    # the text comes from the row with the smallest doc_id; that id is in the join's key, so copies don't meet in one task, and rows
    # that repeat id and text are one before they are sent
    named = [F.coalesce("least", F.lit(0)).alias("_least"), F.col("least").isNull().alias("_none")]
    texts = (keyed.select(F.col("id"), F.coalesce("doc_id", F.lit(0)).alias("_least"), F.col("doc_id").isNull().alias("_none"), "text")
             .dropDuplicates(["id", "_least", "_none"]))
    linked = materialize(
        tiles.select("id", "copies", "bands", "side", *TILE, *named).join(texts, ["id", "_least", "_none"])
        .select("id", "text", "copies", "bands", "side", *TILE)
        .repartition(*TILE).sortWithinPartitions(*TILE)
        .mapInArrow(partial(_link, n=n, threshold=threshold), "id binary, root binary, links long"), "jaccard-links")
    root = components(linked.select(F.col("id").alias("u"), F.col("root").alias("v")))
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    placed = (nodes.select("id", "copies", "least").join(root.withColumnRenamed("node", "id"), "id", "left")
              .join(links, "id", "left").withColumn("root", F.coalesce("root", "id")))
    classes = (placed.groupBy("root").agg(F.min(F.struct("least", "id")).alias("first"))
               .select("root", F.col("first.least").alias("class_id"), F.col("first.id").alias("kept_id")))
    named = placed.join(classes, "root").select(
        "id", "class_id", "kept_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = signed.select("doc_id", "id", (F.size("bands") > 0).alias("worded")).join(named, "id", "left")
    kept = (F.col("id") == F.col("kept_id")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return out.select("doc_id", F.when(F.col("worded"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
                      F.lower(F.hex("id")).alias("text_md5"), F.when(F.col("worded"), kept).otherwise(True).alias("kept"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows, with all their columns, that stand for their classes, one for each; exact repetitions of a row go too."""
    kept = join(docs, **options).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_md5")).distinct()
    rows = docs.withColumn("_text_md5", F.md5(F.coalesce(F.col("text"), F.lit(""))))
    return (rows.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_md5") == F.col("_md5")), "left_semi")
            .dropDuplicates(["doc_id", "_text_md5"]).select(*docs.columns))
