"""Packing of token sequences by linear grouping.

Lengths are whole numbers up to the capacity, so their histogram has as many rows as the capacity whatever the corpus.
The plan is made on it: lengths above a share of the capacity are dealt, longest first, to groups of equal cardinality
and rounded up to the longest of their group; the few sizes left are packed by the fractional optimum over
configurations (columns found by a knapsack), rounded down; actual lengths take their group's slots, and what is left
goes, longest first, where it fits best. Where to draw the line between large and small depends on the lengths, so a few
shares are tried and the plan with the fewest sequences counts. The plan holds runs of equal sequences, never single ones, so it too is
bounded by the capacity. Documents find their slot by their number among those of the same length.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm._text import row_slices, utf8
from gridspark.session import materialize

CAPACITY = 4096
TRIALS = ((96, 8), (256, 4), (256, 3), (512, 2))    # (groups, small lengths go up to this part of the capacity)
SLICE = 8 << 20           # bytes of text encoded at a time
WORDS = 1 << 19           # words remembered by a worker, some 100 MB
TOGETHER = 256            # words encoded at once
EPS = 1e-9


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True
    return loaded


@lru_cache(maxsize=2)
def word_ends(path: str) -> np.ndarray:
    """Whether an id ends a match of the tokenizer's pattern."""
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return out


class Words:
    """Ids of single words, remembered in flat arrays; forgets all of them beyond WORDS."""

    def __init__(self, path: str):
        self.path = path
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.empty(0, np.uint32)
        self.begins = self.sizes = np.empty(0, np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Places of the words in `begins` and `sizes`."""
        words = [w.lower() if w.isascii() else w for w in words]     # in other words marks may join letters before lower case
        if len(self.number) > WORDS:
            self.forget()
        missing = list(set(words).difference(self.number))
        plain = [w.isalpha() for w in missing]
        missing = [*compress(missing, plain), *(w for w, p in zip(missing, plain) if not p)]
        parts, sizes = [self.flat], []
        for at in range(0, len(missing), TOGETHER):
            some = missing[at:at + TOGETHER]
            ids = np.array(tokenizer(self.path).encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            lasts = np.flatnonzero(word_ends(self.path)[ids])
            if len(lasts) == len(some):                               # every word is one match
                sizes += np.diff(np.r_[-1, lasts]).tolist()
                parts.append(ids)
                continue
            for e in tokenizer(self.path).encode_batch_fast(some, add_special_tokens=False):
                sizes.append(len(e.ids))
                parts.append(np.array(e.ids, np.uint32))
        self.number.update(zip(missing, range(len(self.number), len(self.number) + len(missing))))
        sizes = np.array(sizes, np.int64)
        self.begins = np.concatenate([self.begins, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate(parts)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


@lru_cache(maxsize=2)
def remembered(path: str) -> Words:
    """The words of this worker, kept over its tasks."""
    return Words(path)


def encode(texts: pa.Array, end: int, known: Words) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets of the texts); each text's ids are followed by `end`.

    The tokenizer's pattern never reaches across white space and drops it, and letters before a sign are a match of their
    own, so a text's ids are those of its words and signs: only different ones are encoded.
    """
    texts = pc.if_else(pc.string_is_ascii(texts), pc.ascii_lower(texts), texts)
    split = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, "([a-zA-Z])([.,;:!?])", r"\1 \2"))
    flat = split.flatten().dictionary_encode()
    which = known.numbers(flat.dictionary.to_pylist())[flat.indices.to_numpy()]
    runs = known.sizes[which]
    ends = np.cumsum(runs)
    total = int(ends[-1]) if len(ends) else 0
    source = np.repeat(known.begins[which] - (ends - runs), runs) + np.arange(total)
    first = np.cumsum(np.r_[0, split.value_lengths().to_numpy(zero_copy_only=False)])
    per_text = np.diff(np.r_[0, ends][first])
    offsets = np.cumsum(np.r_[0, per_text + 1])
    out = np.full(offsets[-1], end, np.uint32)
    keep = np.ones(len(out), bool)
    keep[offsets[1:] - 1] = False
    out[keep] = known.flat[source]
    return out, offsets


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end: int, capacity: int, ids: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of every text; `place` counts those of the same length in this task, `part` is the task."""
    part = TaskContext.get().partitionId()
    met = [0] * (capacity + 1)
    known = remembered(path)
    for batch in batches:
        data, offsets = utf8(batch.column("_text"))
        for lo, hi in row_slices(offsets, SLICE):
            texts = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(offsets[lo:hi + 1] - offsets[lo]),
                                                     pa.py_buffer(data[offsets[lo]:offsets[hi]]))
            tokens, at = encode(texts, end, known)
            rows = []
            for row, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist()), lo):
                for piece, start in enumerate(range(a, b, capacity)):
                    stop = min(b, start + capacity)
                    length = stop - start
                    rows.append((row, piece, start - a, length, zlib.crc32(tokens[start:stop]), met[length], start, stop))
                    met[length] += 1
            row, piece, start, length, crc, place, begin, stop = map(list, zip(*rows))
            columns = [batch.column(c).take(pa.array(row)) for c in batch.schema.names if c != "_text"]
            names = [c for c in batch.schema.names if c != "_text"]
            columns += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                        pa.array([part] * len(row), pa.int32()), pa.array(place, pa.int64())]
            names += ["piece", "start", "length", "ids_crc32", "_part", "_place"]
            if ids:
                columns.append(pa.ListArray.from_arrays(pa.array([*begin, stop[-1]], pa.int32()), pa.array(tokens.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)


def pieces(docs: DataFrame, path: str, end: int = 1, capacity: int = CAPACITY, key: str = "doc_id", ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32, _part, _place[, ids]): every text's ids and `end`, cut after each `capacity`."""
    rows = docs.select(F.col(key).alias("_key"), F.col("text").alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(
        partial(_pieces, path=path, end=end, capacity=capacity, ids=ids),
        f"_key {kind}, piece int, start long, length long, ids_crc32 long, _part int, _place long" + (", ids array<int>" if ids else ""))


def grouped(counts: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(size, [(length, count), longest first])]: groups of equal cardinality, rounded up to their longest length."""
    total = sum(counts.values())
    each = -(-total // groups)
    out: list[tuple[int, list]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                room = each
                if not out or out[-1][0] != length:      # equal sizes are one group
                    out.append((length, []))
            take = min(left, room)
            out[-1][1].append((length, take))
            left, room = left - take, room - take
    return out


def best_configuration(sizes: list[int], worth: np.ndarray, capacity: int) -> tuple[float, list[int]]:
    """Most valuable multiset of sizes within the capacity (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(sizes), capacity + 1), np.int32)
    for i, (size, value) in enumerate(zip(sizes, worth)):
        if value <= EPS:
            continue
        old = best.copy()
        for m in range(1, capacity // size + 1):
            better = old[:-m * size] + m * value > best[m * size:] + EPS
            best[m * size:][better] = (old[:-m * size] + m * value)[better]
            taken[i, m * size:][better] = m
    room, counts = capacity, [0] * len(sizes)
    for i in range(len(sizes) - 1, -1, -1):
        counts[i] = int(taken[i, room])
        room -= counts[i] * sizes[i]
    return float(best[capacity]), counts


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[float, list[int]]]:
    """Fractional optimum: [(number of sequences, copies of each size)] covering the demand with the fewest sequences.

    Revised simplex: a configuration enters while a knapsack over the dual prices is worth more than one sequence. A
    stop after `rounds` leaves a valid, only less tight, cover.
    """
    k = len(sizes)
    columns = [[capacity // s if i == j else 0 for j in range(k)] for i, s in enumerate(sizes)]
    basis = np.array(columns, float).T
    need = np.array(demand, float)
    for _ in range(rounds):
        amount = np.linalg.solve(basis, need)
        prices = np.linalg.solve(basis.T, np.ones(k))
        value, found = best_configuration(sizes, prices, capacity)
        if value <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, np.array(found, float))
        ratio = np.where(step > EPS, np.maximum(amount, 0) / np.where(step > EPS, step, 1), np.inf)
        leaves = int(np.argmin(ratio))
        basis[:, leaves], columns[leaves] = found, found
    return list(zip(np.maximum(np.linalg.solve(basis, need), 0).tolist(), columns))


class Plan:
    """Slots by length: `rows` holds (length, first number, how many, first sequence, per sequence, offset)."""

    def __init__(self, capacity: int):
        self.capacity, self.rows, self.sequences = capacity, [], 0
        self.given: dict[int, int] = {}
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.sorted_gaps: list[int] = []

    def put(self, length: int, first: int, sequences: int, each: int, offset: int, count: int | None = None) -> None:
        """The next items of a length go to `sequences` sequences from `first` on, `each` to every one."""
        count = sequences * each if count is None else count
        at = self.given.get(length, 0)
        self.rows.append((length, at, count, first, each, offset))
        self.given[length] = at + count

    def open(self, first: int, count: int, gap: int) -> None:
        """A run of sequences with the same gap left."""
        if count and gap:
            if gap not in self.gaps:
                self.gaps[gap] = []
                insort(self.sorted_gaps, gap)
            self.gaps[gap].append((first, count))

    def configure(self, copies: list[tuple[int, list[tuple[int, int]]]], count: int) -> None:
        """`count` sequences of one configuration; each copy of a size takes that many items off its group's list."""
        runs = [(self.sequences, count, 0)]                           # (first, how many, tokens in each)
        self.sequences += count
        for times, items in copies:
            for _ in range(times):
                laid = []
                for first, many, used in runs:
                    while many:
                        length, left = items[0]
                        take = min(left, many)
                        self.put(length, first, take, 1, used)
                        laid.append((first, take, used + length))
                        first, many = first + take, many - take
                        if take == left:
                            items.pop(0)
                        else:
                            items[0] = (length, left - take)
                runs = laid
        for first, many, used in runs:
            self.open(first, many, self.capacity - used)

    def fit(self, length: int, count: int) -> None:
        """Items of one length go, one after another, where the least gap is left; new sequences open when none fits."""
        while count:
            at = bisect_left(self.sorted_gaps, length)
            if at < len(self.sorted_gaps):
                gap = self.sorted_gaps[at]
                first, many = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap], self.sorted_gaps[at]
            else:
                gap, first, many = self.capacity, self.sequences, -(-count // (self.capacity // length))
                self.sequences += many
            each = gap // length
            full = min(many, count // each)
            if full:
                self.put(length, first, full, each, self.capacity - gap)
                self.open(first, full, gap - each * length)
                count -= full * each
            if full < many:
                if count:                                             # fewer than `each` are left: one last sequence
                    self.put(length, first + full, 1, each, self.capacity - gap, count)
                    self.open(first + full, 1, gap - count * length)
                    full, count = full + 1, 0
                self.open(first + full, many - full, gap)


def best_plan(counts: dict[int, int], capacity: int = CAPACITY, trials: tuple[tuple[int, int], ...] = TRIALS) -> Plan:
    """The plan with the fewest sequences, the first of equals."""
    return min((plan(counts, capacity, *trial) for trial in trials), key=lambda made: made.sequences)


def plan(counts: dict[int, int], capacity: int, groups: int, small: int) -> Plan:
    """Slots for `counts[length]` items of every length, none longer than the capacity."""
    made = Plan(capacity)
    whole = counts.get(capacity, 0)
    if whole:
        made.put(capacity, 0, whole, 1, 0)
        made.sequences = whole
    parts = grouped({n: c for n, c in counts.items() if capacity // small < n < capacity}, groups)
    left = {n: c for n, c in counts.items() if n <= capacity // small}
    if parts:
        sizes = [size for size, _ in parts]
        demand = [sum(c for _, c in items) for _, items in parts]
        stock = demand.copy()
        for amount, copies in sorted(configurations(sizes, demand, capacity), key=lambda x: -x[0]):
            count = min([int(amount + 1e-6), *(s // c for s, c in zip(stock, copies) if c)])
            if count:
                made.configure([(c, parts[i][1]) for i, c in enumerate(copies) if c], count)
                stock = [s - count * c for s, c in zip(stock, copies)]
    for _, items in parts:
        for length, count in items:
            left[length] = left.get(length, 0) + count
    for length in sorted(left, reverse=True):
        made.fit(length, left[length])
    return made


def pack(docs: DataFrame, path: str, end: int = 1, capacity: int = CAPACITY, key: str = "doc_id", ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece of every row.

    A null or empty text is the single token `end`; repeated rows and null keys are packed like any others; an empty table
    gives no rows. Only documents longer than `capacity` are cut. Other columns are ignored.

    Pieces are written once, numbered by length within their task; the numbers of the tasks before are added by a sum over
    tasks for each length, so no length meets in one task.
    """
    spark = docs.sparkSession
    rows = materialize(pieces(docs, path, end, capacity, key, ids), "pieces")
    tasks = materialize(rows.groupBy("length", "_part").agg(F.count("*").alias("_n")), "lengths")
    counts = {r.length: r.n for r in tasks.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    slots = spark.createDataFrame(best_plan(counts, capacity).rows, "length long, _first long, _many long, _sequence long, _each long, _offset long")
    number = F.col("_base") + F.col("_place")
    within = number - F.col("_first")
    out = (rows.join(bases, ["length", "_part"])
           .join(F.broadcast(slots), "length").where((within >= 0) & (within < F.col("_many")))      # some rows a length and configuration
           .select(F.col("_key").alias(key), "piece", "start", "length", "ids_crc32",
                   (F.col("_sequence") + F.expr("(_base + _place - _first) div _each")).alias("sequence_id"),
                   (F.col("_offset") + within % F.col("_each") * F.col("length")).alias("offset"), *(["ids"] if ids else [])))
    return out


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of the rows of `pack(..., ids=True)`: a sequence has at most `capacity` pieces."""
    laid = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(laid, lambda p: p["ids"])).alias("ids"))
