"""Exact removal of long repeated byte strings with a logarithmic family of hashed anchor indexes.

A byte goes if a string of `length` bytes covers it that also starts earlier (smaller doc_id, or earlier in the same text).

**Sampling.** Of the `length` bytes of a window only one suffix is indexed: the one whose first SEED bytes have the lowest
hash among all that fit in the window (leftmost on ties). Equal windows choose the same suffix at the same place, so
windows that repeat always meet under one key, a hash of those SEED bytes. A run is a row of neighbouring windows with one
suffix; its body is the bytes of all its windows, known here by a 64-bit hash.

**Index family.** Every batch of some megabytes of text yields the sampled suffixes of its runs sorted by key (a hash, so not in the
order of their text: this replaces the suffix array of a new batch), cut by key into buckets. In a bucket's task it is merge-scanned against the existing levels for suffixes that
share their first SEED bytes; then it becomes the lowest level, and levels of about equal size are merged, so that a
suffix is merged a logarithmic number of times. Runs that met no other leave here: most of the corpus.

**Long matches.** Of runs with one key and equal bodies all but the first are repeats as a whole, which settles the inside of
a repeated passage without its text. Where a key has several bodies (the ends of passages), the first run of each
goes back to its text, its body is gathered by key, all its windows are hashed and sorted, and in each class of equal
windows all but the first are repeats. The union of the repeats is cut out of the text. Windows count as equal when the
48 bits of their key and the 64 bits of their own hash agree.

**Skew.** Within a batch only the first of equal bodies is indexed, and of one key at most KEY_RUNS bodies; the
others surely met a run, so they are dealt by key and body and verified like those. Keys with over a 65,536th of all frequent
keys' bodies (so 65,536 at most) are hot: their windows are gathered one by one under their own hash, which spreads a passage
that a third of all texts share over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm._text import BASE, BLOCK, BYTE_VALUES, U64, mix, powers, releasing, row_slices, utf8
from gridspark.session import materialize

LENGTH, SEED = 100, 24
LOWEST = -(1 << 63)
HOT_LEAST, HOT_KEYS, KEY_RUNS = 4096, 1 << 16, 16
PLACE, KEY_BITS = U64((1 << 24) - 1), U64(16)
RANGE, VERIFY, FREQUENT = 0, 1, 2
#: Bytes of text that a task indexes, and from which it gathers bodies, at a time.
INDEX_BYTES, GATHER_BYTES, BUCKET_BYTES = 8 << 20, 4 << 20, 16 << 20
#: Windows whose places are compared at a time.
COMPARED = 1 << 18

RUN = np.dtype([("key", "u8"), ("body", "u8"), ("doc", "i8"), ("tie", "i8"), ("start", "i8"), ("size", "i8"), ("count", "i8")])
PART = np.dtype([("key", "u8"), ("doc", "i8"), ("tie", "i8"), ("start", "i8"), ("size", "i8")])


def pack(a: np.ndarray) -> bytes:
    """The fields one after the other, each less its minimum in as many bytes as the largest then needs."""
    out = [len(a).to_bytes(8, "little")]
    for name in a.dtype.names:
        column = np.ascontiguousarray(a[name]).view(U64)
        low = int(column.min()) if a.dtype[name].kind == "u" else int(a[name].min()) & (1 << 64) - 1
        column = column - U64(low)
        width = max(1, -(-int(column.max()).bit_length() // 8))
        out += [low.to_bytes(8, "little"), bytes([width]),
                np.ascontiguousarray(column.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()]
    return b"".join(out)


def unpack(raw: bytes, kind: np.dtype, at: int = 0) -> np.ndarray:
    n = int.from_bytes(raw[at:at + 8], "little")
    out = np.empty(n, kind)
    at += 8
    for name in kind.names:
        low, width = int.from_bytes(raw[at:at + 8], "little"), raw[at + 8]
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(raw, np.uint8, n * width, at + 9).reshape(n, width)
        out[name] = (wide.reshape(-1).view(U64) + U64(low)).view(kind[name])
        at += 9 + n * width
    return out


def heads_of(*columns: np.ndarray) -> np.ndarray:
    """True where any of the sorted columns differs from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def first_of(new: np.ndarray) -> np.ndarray:
    """For each row the position of the last True up to it."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def elsewhere(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """False where two runs have one place; a row that occurs twice, id and text, is one document."""
    return (a["doc"] != b["doc"]) | (a["tie"] != b["tie"]) | (a["start"] != b["start"])


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of data[i:i + length] for every i at which it fits."""
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.empty(n, U64)
    up, down = powers(BLOCK + 1024)
    for p in range(0, n, BLOCK):
        m = min(BLOCK, n - p)
        part = data[p:p + m + length - 1]
        run = np.empty(len(part) + 1, U64)
        run[0] = 0
        np.cumsum(BYTE_VALUES[part] * down[:len(part)], out=run[1:])
        h = run[length:]
        h -= run[:m]
        h *= up[:m]
        out[p:p + m] = h
    return mix(out)


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(key, body, row, first window, number of windows) of every run; windows lie inside one row."""
    width = length - SEED + 1
    found: list[tuple] = []
    for p in range(0, len(data) - length + 1, BLOCK):
        part = data[p:p + BLOCK + length - 1]
        n = len(part) - length + 1
        seeds = window_hashes(part, SEED)
        up, down = powers(BLOCK + 1024)
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(BYTE_VALUES[part] * down[:len(part)], out=sums[1:])
        low = (seeds & ~PLACE) | np.arange(len(seeds), dtype=U64)
        size = 1
        while 2 * size <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < width:
            low = np.minimum(low[:n], low[width - size:width - size + n])
        chosen = (low & PLACE).astype(np.int64)
        fits = np.ones(n, bool)
        for end in offsets[np.searchsorted(offsets, p, "right"):np.searchsorted(offsets, p + n + length)].tolist():
            fits[max(0, end - p - length + 1):max(0, end - p)] = False
        edges = np.flatnonzero((chosen[1:] != chosen[:-1]) | (fits[1:] != fits[:-1])) + 1
        starts = np.concatenate([[0], edges])
        sizes = np.diff(np.concatenate([starts, [n]]))
        good = fits[starts]
        starts, sizes = starts[good], sizes[good]
        row = np.searchsorted(offsets, starts + p, "right") - 1
        body = mix((sums[starts + sizes + length - 1] - sums[starts]) * up[starts])
        found.append((seeds[chosen[starts]] >> KEY_BITS, body, row, starts + p - offsets[row], sizes))
    if not found:
        none = np.empty(0, np.int64)
        return np.empty(0, U64), np.empty(0, U64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def _blob_batch(buckets: list[int], kinds: list[int], blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())],
                                      ["bucket", "kind", "blob"])


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, edges) if len(order) else ():
        yield int(bucket[part[0]]), part


def scattered(rows: np.ndarray, many: np.uint64) -> np.ndarray:
    """Buckets of settled rows, which need no other: by document and place, so that copies of one text fall into all."""
    h = mix(rows["doc"].view(U64) + U64(BASE))
    for name in ("tie", "start"):
        h = mix(h ^ rows[name].view(U64))
    return h % many


def _blobs(groups: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One blob for each kind and bucket of (kind, bucket of each row, rows)."""
    out: tuple[list, list, list] = ([], [], [])
    for kind, where, rows in groups:
        for b, chosen in _by_bucket(where.astype(np.int64)):
            out[0].append(b)
            out[1].append(kind)
            out[2].append(pack(rows[chosen]))
    return _blob_batch(*out)


def _sorted_parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple]:
    """(rows, doc, tie, text bytes, offsets) in the documents' order, about `size` bytes of text at a time."""
    for batch in batches:
        order = np.lexsort((batch.column("tie").to_numpy(), batch.column("doc").to_numpy()))
        batch = batch.take(pa.array(order))
        _, offsets = utf8(batch.column("text"))
        for lo, hi in row_slices(offsets, size):
            part = batch.slice(lo, hi - lo)
            yield part, part.column("doc").to_numpy(), part.column("tie").to_numpy(), *utf8(part.column("text"))


@releasing
def _index(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Suffix arrays of a batch by bucket (kind 0), whole repeats inside the batch (kind 1), surplus bodies of a key (2)."""
    for _, doc, tie, data, offsets in _sorted_parts(batches, INDEX_BYTES):
        key, body, row, start, size = runs(data, offsets, length)
        if len(key) == 0:
            continue
        order = np.lexsort((body, key))
        entries = np.empty(len(key), RUN)
        entries["key"], entries["body"], entries["start"], entries["size"] = key[order], body[order], start[order], size[order]
        entries["doc"], entries["tie"], entries["count"] = doc[row[order]], tie[row[order]], 0
        new = heads_of(entries["key"], entries["body"])
        rest = entries[~new & elsewhere(entries, entries[first_of(new)])]
        entries = entries[new]
        new = heads_of(entries["key"])
        heads = np.flatnonzero(new)
        entries["count"][heads] = np.diff(np.append(heads, len(entries)))
        surplus = np.arange(len(entries)) - first_of(new) >= KEY_RUNS
        main, more = entries[~surplus], entries[surplus]
        many = U64(buckets)
        yield _blobs([(0, main["key"] % many, main), (1, scattered(rest, many), rest),
                      (2, (more["key"] ^ more["body"]) % many, more)])


class Family:
    """Levels of sorted suffixes; a level is less than half as large as the one below it."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, batch: np.ndarray) -> None:
        """Scan a sorted batch against all levels, marking suffixes of either side that share a key; then merge."""
        met = batch["count"] > 1
        for level, hit in self.levels:
            at = np.searchsorted(level["key"], batch["key"])
            at[at == len(level)] = 0
            same = level["key"][at] == batch["key"]
            hit[at[same]] = True
            met |= same
        self.levels.append((batch, met))
        while len(self.levels) > 1 and 2 * len(self.levels[-1][0]) > len(self.levels[-2][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            both, marks = np.concatenate([b, a]), np.concatenate([y, x])
            order = np.argsort(both["key"], kind="stable")
            self.levels.append((both[order], marks[order]))

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        """All suffixes sorted, with their marks; of equal keys one at least is marked if they met."""
        if not self.levels:
            return np.empty(0, RUN), np.empty(0, bool)
        both = np.concatenate([x for x, _ in self.levels])
        marks = np.concatenate([x for _, x in self.levels])
        order = np.argsort(both["key"], kind="stable")
        return both[order], marks[order]


def _hits(table: pa.Table) -> pa.Table:
    """Of a bucket: runs that are repeats as a whole (RANGE), runs to be verified by their windows (VERIFY), and frequent
    keys with the number of their bodies (FREQUENT)."""
    family, rest, more = Family(), [np.empty(0, RUN)], [np.empty(0, RUN)]
    for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist()):
        entries = unpack(blob, RUN)
        family.add(entries) if kind == 0 else (rest if kind == 1 else more).append(entries)
    entries, met = family.close()
    heads = np.flatnonzero(heads_of(entries["key"]))
    frequent = np.empty(0, RUN)
    if len(entries):
        total = np.add.reduceat(entries["count"], heads)
        frequent = entries[heads][total >= HOT_LEAST]
        frequent["count"] = total[total >= HOT_LEAST]
        met = np.repeat(np.logical_or.reduceat(met, heads), np.diff(np.append(heads, len(entries))))
        entries = entries[met]
    out = []
    for part, sure in ((entries, False), (np.concatenate(more), True)):
        part = part[np.lexsort((part["start"], part["tie"], part["doc"], part["body"], part["key"]))]
        new = heads_of(part["key"], part["body"])
        rest.append(part[~new & elsewhere(part, part[first_of(new)])])
        part = part[new]
        count = np.diff(np.append(np.flatnonzero(heads_of(part["key"])), len(part)))
        # a run of `count` above 1 had other bodies of its key in its own batch, surplus ones perhaps among them
        several = np.repeat(count, count) > 1
        if len(part):
            several |= np.repeat(np.maximum.reduceat(part["count"], np.flatnonzero(heads_of(part["key"]))) > 1, count)
        out.append(part if sure else part[several])
    kinds = [(RANGE, np.concatenate(rest)), *((VERIFY, x) for x in out), (FREQUENT, frequent)]
    rows = np.concatenate([x for _, x in kinds])
    return pa.table({"what": np.repeat(np.array([k for k, _ in kinds], np.int32), [len(x) for _, x in kinds]),
                     "key": rows["key"].view(np.int64), "doc": np.ascontiguousarray(rows["doc"]),
                     "tie": np.ascontiguousarray(rows["tie"]), "start": np.ascontiguousarray(rows["start"]),
                     "size": rows["size"].astype(np.int32), "count": np.ascontiguousarray(rows["count"])})


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... starts[i] + sizes[i] - 1 for each i, one after the other."""
    ends = np.cumsum(sizes)
    out = np.repeat(starts - (ends - sizes), sizes)
    out += np.arange(len(out))
    return out


def _repeated(windows: np.ndarray, run: np.ndarray, at: np.ndarray, part: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which windows occur earlier. `run` gives each window's run in `part`, runs in the documents' order; place[run] is
    where the run's first byte lies, `at` where the window's does."""
    rank = np.argsort(windows, kind="stable")
    head = rank[first_of(heads_of(windows[rank], part["key"][run[rank]]))]
    out = np.empty(len(rank), bool)
    for lo in range(0, len(rank), COMPARED):
        own, other = rank[lo:lo + COMPARED], head[lo:lo + COMPARED]
        a, b = part[run[own]], part[run[other]]
        a["start"] += at[own] - place[run[own]]
        b["start"] += at[other] - place[run[other]]
        out[own] = elsewhere(a, b)
    return out


def _ranges(marks: np.ndarray, run: np.ndarray, at: np.ndarray, part: np.ndarray, place: np.ndarray,
            alone: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows of one run with one mark: (parts, mark of each, first byte of each). Unmarked windows of runs that
    are `alone` make a stretch each."""
    new = heads_of(run, marks)
    if alone is not None:
        new |= alone[run] & ~marks
    heads = np.flatnonzero(new)
    out = part[run[heads]]
    out["start"] += at[heads] - place[run[heads]]
    out["size"] = np.diff(np.append(heads, len(run)))
    return out, marks[heads], at[heads]


@releasing
def _gather(batches: Iterator[pa.RecordBatch], length: int, buckets: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Bodies of the runs to be verified, by bucket (kind 0); ranges of windows repeated in the same batch (kind 1)."""
    many = U64(buckets)
    for batch, doc, tie, data, offsets in _sorted_parts(batches, GATHER_BYTES):
        lists = batch.column("runs")
        row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        fields = lists.flatten()
        part = np.empty(len(row), PART)
        part["key"], part["doc"], part["tie"] = fields.field("key").to_numpy().view(U64), doc[row], tie[row]
        part["start"], part["size"] = fields.field("start").to_numpy(), fields.field("size").to_numpy()
        order = np.lexsort((part["start"], row))
        part, row = part[order], row[order]
        place = offsets[row] + part["start"]
        run, at = np.repeat(np.arange(len(part), dtype=np.int32), part["size"]), spread(place, part["size"])
        whole = window_hashes(data, length)
        alone = np.isin(part["key"], hot)
        parts, known, first = _ranges(_repeated(whole[at], run, at, part, place), run, at, part, place, alone)
        sent, first = parts[~known], first[~known]
        where = np.where(np.isin(sent["key"], hot), whole[first], sent["key"]) % many
        out: tuple[list, list, list] = ([], [], [])
        for b, rows in _by_bucket(where.astype(np.int64)):
            head = pack(sent[rows])
            out[0].append(b)
            out[1].append(0)
            out[2].append(len(head).to_bytes(8, "little") + head
                          + data[spread(first[rows], sent["size"][rows] + length - 1)].tobytes())
        repeats = parts[known]
        for b, rows in _by_bucket(scattered(repeats, many).astype(np.int64)):
            out[0].append(b)
            out[1].append(1)
            out[2].append(pack(repeats[rows]))
        if out[0]:
            yield _blob_batch(*out)


def _repeats(table: pa.Table, length: int) -> pa.Table:
    """Ranges (doc, tie, first window, number) of windows that occur earlier."""
    found, parts, texts = [np.empty(0, PART)], [], []
    for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist()):
        if kind:
            found.append(unpack(blob, PART))
        else:
            parts.append(unpack(blob, PART, 8))
            texts.append(np.frombuffer(blob, np.uint8, -1, 8 + int.from_bytes(blob[:8], "little")))
    if parts:
        part, data = np.concatenate(parts), np.concatenate(texts)
        lengths = part["size"] + length - 1
        place = np.cumsum(lengths) - lengths
        order = np.lexsort((part["start"], part["tie"], part["doc"]))
        part, place = part[order], place[order]
        run, at = np.repeat(np.arange(len(part), dtype=np.int32), part["size"]), spread(place, part["size"])
        marks = _repeated(window_hashes(data, length)[at], run, at, part, place)
        ranges, marks, _ = _ranges(marks, run, at, part, place)
        found.append(ranges[marks])
    out = np.concatenate(found)
    return pa.table({"doc": np.ascontiguousarray(out["doc"]), "tie": np.ascontiguousarray(out["tie"]),
                     "start": np.ascontiguousarray(out["start"]), "size": out["size"].astype(np.int32)})


def covered(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of byte ranges as sorted ranges that neither overlap nor touch."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[new], ends[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(ends) - 1]])]


def kept_bytes(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(bytes, bytes removed, spans removed, remaining bytes) of each row of (text, ranges)."""
    data, offsets = utf8(batch.column("text"))
    lists = batch.column("ranges")
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    fields = lists.flatten()
    starts = fields.field("start").to_numpy()
    ends = starts + fields.field("size").to_numpy() + length - 1
    at = np.append(0, np.cumsum(sizes))
    for i in range(batch.num_rows):
        text, removed, spans = data[offsets[i]:offsets[i + 1]], 0, 0
        if sizes[i]:
            lo, hi = covered(starts[at[i]:at[i + 1]], ends[at[i]:at[i + 1]])
            removed, spans = int((hi - lo).sum()), len(lo)
            keep = np.ones(len(text), bool)
            keep[spread(lo, hi - lo)] = False
            text = text[keep]
        yield int(offsets[i + 1] - offsets[i]), removed, spans, text


@releasing
def _report(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(n, removed, spans, hashlib.sha256(text).hexdigest()) for n, removed, spans, text in kept_bytes(batch, length)]
        if rows:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in zip(*rows))],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


@releasing
def _texts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [(removed, text.tobytes().decode("utf-8", "ignore")) for _, removed, _, text in kept_bytes(batch, length)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array([r for r, _ in kept], pa.int64()), pa.array([t for _, t in kept], pa.string())],
            ["row", "removed", "kept"])


def keyed(docs: DataFrame, *more) -> DataFrame:
    """doc and tie order the documents: null ids first; rows with one id and different texts by a checksum."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("tie"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").alias("text"), *more)


def repeated_ranges(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, tie, ranges array<struct<start, size>>): the windows of each text that occur earlier."""
    spark: SparkSession = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    blobs = "bucket int, kind int, blob binary"
    found = materialize(
        rows.select("doc", "tie", "text").mapInArrow(partial(_index, length=length, buckets=buckets), blobs)
        .groupBy("bucket").applyInArrow(
            _hits, "what int, key long, doc long, tie long, start long, size int, count long"), "suffix-hits")
    frequent = found.where(F.col("what") == FREQUENT)
    total = frequent.agg(F.sum("count")).first()[0] or 0
    hot = frequent.where(F.col("count") >= max(HOT_LEAST, -(-total // HOT_KEYS))).select("key").collect()
    hot = np.array([r["key"] for r in hot], np.int64).view(U64)
    runs_of = (found.where(F.col("what") == VERIFY).groupBy("doc", "tie")
               .agg(F.collect_list(F.struct("key", "start", "size")).alias("runs")))

    def repeats_of(table: pa.Table) -> pa.Table:
        return _repeats(table, length)

    # rows equal in id and text are one document: one of them is gathered
    repeats = (rows.select("doc", "tie", "text").dropDuplicates(["doc", "tie"]).join(runs_of, ["doc", "tie"])
               .mapInArrow(partial(_gather, length=length, buckets=buckets, hot=hot), blobs)
               .groupBy("bucket").applyInArrow(repeats_of, "doc long, tie long, start long, size int"))
    whole = found.where(F.col("what") == RANGE).select("doc", "tie", "start", "size")
    return whole.unionByName(repeats).groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "size")).alias("ranges"))


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of (doc_id, text).

    A null text is empty. Texts under `length` bytes lose nothing. Rows equal in id and text count as one document and get the
    same result; rows with one id and different texts are ordered by a checksum of the text; a null id comes first.
    """
    rows = keyed(docs)
    return (rows.join(repeated_ranges(rows, length), ["doc", "tie"], "left").select("doc_id", "text", "ranges")
            .mapInArrow(partial(_report, length=length),
                        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows, with all their columns, with the text that remains and its number of characters in `n_chars` if there is such a
    column. Documents of which nothing remains go; texts that lost nothing stay as they were, null and empty ones too.
    A character of which only some bytes remain is left out."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = keyed(docs, row.alias("row"))
    cut = (rows.join(repeated_ranges(rows, length), ["doc", "tie"], "left").select("row", "text", "ranges")
           .mapInArrow(partial(_texts, length=length), f"row {rows.schema['row'].dataType.simpleString()}, removed long, kept string"))
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return (cut.where("removed = 0 or kept <> ''")
            .select(*(F.when(F.col("removed") > 0, changed[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in changed
                      else F.col(f"row.`{c}`").alias(c) for c in docs.columns)))
