"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and items are normalised (ASCII lower case, runs of white space as one blank, none at the start) and treated as UTF-8
bytes. An item of m bytes may be met with k = `rate` * m edits. The largest q up to 8 with q * (k + 1) <= m is used, so that a
region within the budget shares at least m - q + 1 - k * q of the item's q-grams with it, at least one.

Diagonals (place in the text less place in the item) are cut into cells of k + 1; a band is two neighbouring cells, so bands
overlap by half, and the at most k + 1 diagonals of a match lie in one band. Bands whose shared q-grams reach the
bound are aligned: dynamic programming over the band and k diagonals on either side, free at both ends of the text, all
bands of a batch in one array. A text is contaminated by an item if the best alignment has at most k edits.

The items are the stated query set; they are broadcast in blocks of a checked size. Documents are never shuffled.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm._text import ASCII_SPACE, BASE, U64, row_slices, utf8

RATE, MOST_Q = 0.1, 8
BLOCK_BYTES = 16 << 20
SLICE = 1 << 20
ALIGN_CELLS = 4 << 20
CHUNK = 1 << 21           # (text place, item place) pairs written out at once
HEAVY = 1 << 23           # pairs of one item and one slice of text beyond which equal grams are taken together
MERGE = 1 << 22
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[ASCII_SPACE] = 32


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with MOST_Q zeros behind each row, start and size of each row there, place of each kept byte in `data`)."""
    space = ASCII_SPACE[data]
    follows = np.empty(len(data), bool)
    follows[1:] = space[:-1]
    follows[offsets[:-1][offsets[:-1] < len(data)]] = True
    origin = np.flatnonzero(~(space & follows))
    first = np.searchsorted(origin, offsets)
    sizes = np.diff(first)
    starts = first[:-1] + MOST_Q * np.arange(len(sizes))
    out = np.zeros(len(origin) + MOST_Q * (len(sizes) + 1), np.uint8)
    out[np.arange(len(origin)) + MOST_Q * np.repeat(np.arange(len(sizes)), sizes)] = LOWER[data[origin]]
    return out, starts, sizes, origin


def grams(x: np.ndarray, q: int) -> np.ndarray:
    """The q bytes from every place on as a number; x ends in MOST_Q zeros."""
    g = np.ndarray(len(x) - 7, "<u8", x, strides=(1,))
    return g & U64((1 << 8 * q) - 1) if q < 8 else g.copy()


class Index:
    """q-grams of a block of items, by q: a bit table, the sorted grams and their places."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float) -> None:
        data, offsets = utf8(pa.array([t for _, t in items], pa.string()))
        x, starts, sizes, _ = normalise(data, offsets)
        trimmed = sizes - ((sizes > 0) & (x[starts + np.maximum(sizes, 1) - 1] == 32))
        used = np.flatnonzero(trimmed > 0)
        self.ids = [items[i][0] for i in used]
        self.sizes = trimmed[used]
        self.edits = np.floor(rate * self.sizes + 1e-9).astype(np.int64)
        self.q = np.minimum(MOST_Q, self.sizes // (self.edits + 1))
        self.bound = self.sizes - self.q + 1 - self.edits * self.q
        self.texts = [x[starts[i]:starts[i] + trimmed[i]] for i in used]
        self.tables = []
        for q in np.unique(self.q).tolist():
            members = np.flatnonzero(self.q == q)
            counts = self.sizes[members] - q + 1
            g = np.concatenate([grams(np.append(self.texts[i], np.zeros(MOST_Q, np.uint8)), q)[:n]
                                for i, n in zip(members, counts)])
            place = np.arange(len(g)) - np.repeat(np.cumsum(counts) - counts, counts)
            order = np.argsort(g, kind="stable")
            names, first = np.unique(g[order], return_index=True)
            bits = np.zeros(1 << 20, bool)
            bits[self.slot(names)] = True
            self.tables.append((q, bits, names, np.append(first, len(g)), np.repeat(members, counts)[order], place[order]))

    @staticmethod
    def slot(g: np.ndarray) -> np.ndarray:
        return (g * U64(BASE)) >> U64(44)

    def candidates(self, x: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, item, first diagonal relative to the row) of the bands that reach their item's bound."""
        gap = int(self.sizes.max(initial=0) + 4 * (self.edits.max(initial=0) + 1))
        found = [(np.empty(0, np.int64),) * 3]
        for q, bits, names, first, owners, places in self.tables:
            g = grams(x, q)
            at = np.flatnonzero(bits[self.slot(g)])
            g = g[at]
            k = np.searchsorted(names, g)
            k[k == len(names)] = 0
            same = names[k] == g
            at, k = at[same], k[same]
            row = np.searchsorted(starts, at, "right") - 1
            inside = at - starts[row] + q <= sizes[row]
            at, k, row = at[inside], k[inside], row[inside]
            span = len(x) + (len(starts) + 2) * gap
            # rows lie a gap apart, so that no cell holds diagonals of two rows
            key, tally = self.tallied(at + (row + 1) * gap, k, first, owners, places, span)
            nearby = np.append(np.where(np.diff(key) == 1, tally[1:], 0), 0)
            item = key // span
            good = tally + nearby >= self.bound[item]
            # a band that starts one cell lower and has this cell as its upper half
            lone = tally >= self.bound[item]
            key, item = key[good | lone], item[good | lone]
            lowest = (key % span) * (self.edits[item] + 1)
            virtual = starts + (np.arange(len(starts)) + 1) * gap
            row = np.searchsorted(virtual - self.sizes.max() - 1, lowest + 2 * (self.edits[item] + 1), "right") - 1
            row = np.clip(row, 0, len(starts) - 1)
            found.append((row, item, lowest - virtual[row]))
        return tuple(np.concatenate(c) for c in zip(*found))

    def tallied(self, at: np.ndarray, k: np.ndarray, first: np.ndarray, owners: np.ndarray, places: np.ndarray,
                span: int) -> tuple[np.ndarray, np.ndarray]:
        """(item * span + cell, shared grams) of all cells met; a cell holds the diagonals of one band's width.

        Pairs of a text place and an item place are written out CHUNK at a time. An item with more than HEAVY pairs (a text and
        an item that repeat the same grams) takes equal grams of a band's width of text at once and counts them to both
        cells they may fall into: more cells reach the bound then, none fewer, and the alignment decides.
        """
        kept = Tally()
        hits = np.bincount(k, minlength=len(first) - 1)
        load = np.bincount(owners, weights=np.repeat(hits, np.diff(first)), minlength=len(self.sizes))
        heavy = load > HEAVY
        light = ~heavy[owners]
        begin = np.r_[0, np.cumsum(light)][first]
        item, place, width = owners[light], places[light], self.edits + 1
        for some, listed in written_out(begin[k], begin[k + 1]):
            mine = item[listed]
            kept.add(mine * span + (at[some] - place[listed]) // width[mine], None)
        for one in np.flatnonzero(heavy).tolist():
            mine = owners == one
            begin, place, w = np.r_[0, np.cumsum(mine)][first], places[mine], int(width[one])
            met = begin[k + 1] > begin[k]
            block, many = np.unique(at[met] // w * len(first) + k[met], return_counts=True)
            gram, low = block % len(first), block // len(first) * w
            for some, listed in written_out(begin[gram], begin[gram + 1]):
                diagonal = low[some] - place[listed]
                cell = one * span + diagonal // w
                split = diagonal % w > 0
                kept.add(np.r_[cell, cell[split] + 1], np.r_[many[some], many[some][split]])
        return kept.total()


class Tally:
    """Sums by key, merged whenever MERGE entries wait."""

    def __init__(self) -> None:
        self.keys, self.counts, self.waiting = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None) -> None:
        found, inverse = np.unique(keys, return_inverse=True)
        self.keys.append(found)
        self.counts.append(np.bincount(inverse, weights=counts, minlength=len(found)).astype(np.int64))
        self.waiting += len(found)
        if self.waiting > MERGE:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) > 1:
            found, inverse = np.unique(np.concatenate(self.keys), return_inverse=True)
            self.counts = [np.bincount(inverse, weights=np.concatenate(self.counts), minlength=len(found)).astype(np.int64)]
            self.keys, self.waiting = [found], 0
        return self.keys[0], self.counts[0]


def written_out(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the range, member) of all members of the ranges low .. high, CHUNK or one range at a time."""
    counts = high - low
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        done = ends[at] - counts[at]
        stop = max(at + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        part = counts[at:stop]
        which = np.repeat(np.arange(at, stop), part)
        yield which, np.arange(len(which)) + np.repeat(low[at:stop] - (ends[at:stop] - part - done), part)
        at = stop


def align(items: list[np.ndarray], regions: np.ndarray, lowest_free: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(fewest edits, end in the region) of each item against its row of `regions`, which is as wide as the longest item plus
    the diagonals. Item byte j may stand at region places j .. j + diagonals. The region's start is free, or else skipping
    bytes of it costs an edit each; its end is free."""
    sizes = np.array([len(t) for t in items])
    longest = int(sizes.max())
    text = np.full((len(items), longest), 254, np.uint8)
    for i, t in enumerate(items):
        text[i, :len(t)] = t
    diagonals = regions.shape[1] - longest
    steps = np.arange(diagonals, dtype=np.int32)
    now = np.zeros((len(items), diagonals), np.int32) if lowest_free else np.tile(steps, (len(items), 1))
    best, end = np.full(len(items), 1 << 30), np.zeros(len(items), np.int64)
    for j in range(longest):
        step = now + (regions[:, j:j + diagonals] != text[:, j:j + 1])
        step[:, :-1] = np.minimum(step[:, :-1], now[:, 1:] + 1)
        now = np.minimum.accumulate(step - steps, axis=1) + steps
        done = np.flatnonzero(sizes == j + 1)
        if len(done):
            best[done] = now[done].min(axis=1)
            end[done] = now[done].argmin(axis=1) + j + 1
    return best, end


def _region(x: np.ndarray, lo: np.ndarray, width: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Bytes x[lo : lo + width] of each row, 255 outside its text."""
    at = lo[:, None] + np.arange(width)
    inside = (at >= start[:, None]) & (at < stop[:, None])
    return np.where(inside, x[np.clip(at, 0, len(x) - 1)], np.uint8(255))


def matches(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, item, edits, first byte, end) of the best match of each item in each row, in bytes of the text as it was."""
    x, starts, sizes, origin = normalise(data, offsets)
    if not index.ids:
        return []
    row, item, lowest = index.candidates(x, starts, sizes)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    order = np.lexsort((lowest, item, row, index.sizes[item] if len(item) else item))
    row, item, lowest = row[order], item[order], lowest[order]
    at = 0
    while at < len(row):
        # items of about one length together, within a bounded number of cells
        k = index.edits[item[at:at + 4096]]
        cells = np.maximum.accumulate(4 * (k + 1)) * np.arange(1, len(k) + 1)
        n = max(1, int(np.searchsorted(cells, max(1, ALIGN_CELLS // max(1, int(index.sizes[item[at]]))))))
        part = np.arange(at, min(at + n, len(row)))
        at += n
        # a match without an edit is the best of its pair: bands further on bring nothing better
        part = part[[best.get(pair, (1,))[0] > 0 for pair in zip(row[part].tolist(), item[part].tolist())]]
        if not len(part):
            continue
        r, i = row[part], item[part]
        width = int(4 * (index.edits[i].max() + 1)) + int(index.sizes[i].max())
        lo = starts[r] + lowest[part] - index.edits[i]
        edits, end = align([index.texts[v] for v in i], _region(x, lo, width, starts[r], starts[r] + sizes[r]))
        good = np.flatnonzero(edits <= index.edits[i])
        if len(good) == 0:
            continue
        stop = lo[good] + end[good]
        back = _region(x, stop - width, width, starts[r[good]], stop)[:, ::-1]
        _, length = align([index.texts[v][::-1] for v in i[good]], back, lowest_free=False)
        for a, b, e, z, size in zip(r[good].tolist(), i[good].tolist(), edits[good].tolist(), stop.tolist(), length.tolist()):
            old = best.get((a, b))
            now = (e, z - size, z)
            if old is None or now < old:
                best[a, b] = now
    out = []
    for (a, b), (e, lo, hi) in sorted(best.items()):
        lo, hi = max(lo, int(starts[a])), min(hi, int(starts[a] + sizes[a]))
        out.append((a, b, e, int(origin[lo - MOST_Q * a] - offsets[a]), int(origin[hi - 1 - MOST_Q * a] + 1 - offsets[a])))
    return out


def indexes(benchmark: DataFrame, rate: float, block_bytes: int) -> Iterator:
    """Broadcast indexes of the items, a block of about `block_bytes` of text each."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        part = benchmark.where(F.col("text").isNotNull()).where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = [(r["item_id"], r["text"]) for r in part.select("item_id", "text").distinct().collect()]
        items.sort(key=lambda x: (str(x[0]), x[1]))
        yield benchmark.sparkSession.sparkContext.broadcast(pickle.dumps(Index(items, rate)))


def all_matches(index: Index, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
    """`matches` of a column's texts, slice by slice."""
    data, offsets = utf8(column)
    out = []
    for lo, hi in row_slices(offsets, SLICE):
        base = offsets[lo]
        out += [(a + lo, *rest) for a, *rest in matches(index, data[base:offsets[hi]], offsets[lo:hi + 1] - base)]
    return out


def find(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, edits, budget, first_byte, end_byte) of every document and every item met in it, the best place of each.

    Clean documents give no row. Null and blank texts and items meet nothing. Rows that repeat a document give rows again;
    items with equal texts are met alike. A null id stays null.
    """
    ids = (docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString())
    item_kind = {"bigint": pa.int64(), "int": pa.int32()}.get(ids[1], pa.string())
    kinds = f"doc_id {ids[0]}, item_id {ids[1]}, edits int, budget int, first_byte long, end_byte long"
    out = None
    for shared in indexes(benchmark, rate, block_bytes):
        def met(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = pickle.loads(shared.value)
            for batch in batches:
                rows = all_matches(index, batch.column("text"))
                if rows:
                    row, item, edits, first, end = (np.array(c) for c in zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(row)), pa.array([index.ids[i] for i in item], item_kind),
                         pa.array(edits.astype(np.int32)), pa.array(index.edits[item].astype(np.int32)), pa.array(first),
                         pa.array(end)], ["doc_id", "item_id", "edits", "budget", "first_byte", "end_byte"])

        found = docs.select("doc_id", "text").mapInArrow(met, kinds)
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows, with all their columns, in which no item is met."""
    for shared in indexes(benchmark, rate, block_bytes):
        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = pickle.loads(shared.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[a for a, *_ in all_matches(index, batch.column("text"))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
