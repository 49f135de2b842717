"""Phrases of two to five words that stand together more often than their parts would, from weighted automata.

A count transducer is an acyclic automaton whose paths spell (language, word, ...) and whose states weigh what is spelled.
Shards of text sort their n-grams, build a transducer of each prefix range from them, longest paths first, and share the states
that have the same weight and the same way on. The transducers of one range meet in one task, where their union sums the weights. Ranges are cut
at n-grams of any length, so neither a frequent word nor a frequent pair is one task. Counts of the parts of a
candidate are read off by composing the transducer of the parts asked for with that of the range they fall into.

Counting goes words, pairs, then three to five words. Only words and pairs that may reach the least count lead on to longer n-grams: a
filter of bits, bounded in size, says which; what it lets through wrongly is counted and dropped. All counts are exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm._text import BASE, U64, mix, release, releasing, row_slices, utf8
from gridspark.session import materialize

LONGEST = 5
SHARD = 3 << 20                   # bytes of text a transducer is built from
RANGE = 8 << 20                   # bytes of text a range stands for
MOST_RANGES = 200_000
SAMPLED = 16                      # n-grams sampled for each range
MERGED = 1 << 19                  # n-grams that are merged at once
DEALT = 1 << 17                   # n-grams that are dealt to ranges at once
MOST_BITS = 1 << 27
UNKNOWN = "und"
BATCH = 1000                      # rows that go to a worker at once
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(10, 14)]] = True
GAP = BREAK.copy()
GAP[[9, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

Level = tuple[np.ndarray, np.ndarray, np.ndarray]    # (parent, label, weight) of the n-grams of one length, in order


@dataclass
class Grams:
    """Sorted n-grams as levels: the languages, then one level for each word; weight 0 where an n-gram is only passed. Several sets at once
    have a root each, which the parents of the languages count."""
    langs: list[str]
    words: pa.Array
    levels: list[Level]
    roots: int = 1


@dataclass
class Transducer:
    """States 0, 1, ...; arcs first[s] to first[s + 1] leave state s by rising label. The last state is the start; several automata at once
    follow each other, each ending with its start."""
    langs: list[str]
    words: pa.Array
    first: np.ndarray
    label: np.ndarray
    target: np.ndarray
    weight: np.ndarray
    starts: np.ndarray


SCHEMA = ("part int, langs array<string>, words array<binary>, first array<int>, label array<int>, target array<int>, weight array<long>, "
          "totals array<long>")


def shared(grams: Grams) -> Transducer:
    """Automaton of sorted n-grams, one for each root. From the longest up, states without an arc or with one are shared by equal weight,
    label and target; states with more arcs stay as they are."""
    first, labels, targets, weights, owners = [], [], [], [], []
    states = arcs = 0
    below = np.empty(0, np.int64)                                     # states of the level below
    levels = [(np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(grams.roots, np.int64)), *grams.levels]
    root = [np.arange(grams.roots)]
    for parent, _, _ in grams.levels:
        root.append(root[-1][parent])
    for depth in range(len(levels) - 1, -1, -1):
        weight = levels[depth][2]
        parent, label = levels[depth + 1][:2] if depth + 1 < len(levels) else (np.empty(0, np.int64),) * 2
        n = len(weight)
        out = np.bincount(parent, minlength=n)
        begin = np.cumsum(out) - out
        number = np.empty(n, np.int64)
        few = np.flatnonzero(out < 2) if depth else np.empty(0, np.int64)
        one = out[few] == 1
        by = root[depth][few] - grams.roots
        by[one] = label[begin[few[one]]] * (states + 1) + below[begin[few[one]]]
        order = np.lexsort((weight[few], by))
        fresh = np.ones(len(few), bool)
        fresh[1:] = (np.diff(by[order]) != 0) | (np.diff(weight[few][order]) != 0)
        number[few[order]] = states + np.cumsum(fresh) - 1
        kept = few[order[fresh]]
        many = np.setdiff1d(np.arange(n), few, assume_unique=True)
        number[many] = states + len(kept) + np.arange(len(many))
        new = np.concatenate([kept, many])
        counts = out[new]
        at = np.repeat(begin[new] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        first.append(arcs + np.cumsum(counts) - counts)
        labels.append(label[at])
        targets.append(below[at])
        weights.append(weight[new])
        owners.append(root[depth][new])
        states, arcs, below = states + len(new), arcs + len(at), number
    first, label, target, weight = np.r_[np.concatenate(first), arcs], np.concatenate(labels), np.concatenate(targets), np.concatenate(weights)
    owner = np.concatenate(owners)
    if grams.roots > 1:                                               # states of a root lie together, in the order they have
        order = np.argsort(owner.astype(np.min_scalar_type(grams.roots)), kind="stable")
        place = np.empty(states, np.int64)
        place[order] = np.arange(states)
        counts = np.diff(first)[order]
        at = np.repeat(first[order] - (np.cumsum(counts) - counts), counts) + np.arange(arcs)
        first, label, target, weight = np.r_[0, np.cumsum(counts)], label[at], place[target[at]], weight[order]
    return Transducer(grams.langs, grams.words, first, label, target, weight, np.cumsum(np.bincount(owner, minlength=grams.roots)) - 1)


def spelled(t: Transducer) -> Grams:
    """All n-grams of an automaton, or of several, in order."""
    levels: list[Level] = []
    at = t.starts
    while True:
        counts = t.first[at + 1] - t.first[at]
        if not counts.any():
            return Grams(t.langs, t.words, levels, len(t.starts))
        parent = np.repeat(np.arange(len(at)), counts)
        arc = np.repeat(t.first[at] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        at = t.target[arc]
        levels.append((parent, t.label[arc], t.weight[at]))


def _sorted_words(arrays: list[pa.Array]) -> pa.Array:
    """Different words in byte order."""
    words = pa.chunked_array(arrays, pa.binary()).unique()
    return words.take(pc.array_sort_indices(words))


def union(parts: list[Grams]) -> Grams:
    """All n-grams of the parts and of all their roots, their weights summed."""
    langs = sorted({lang for p in parts for lang in p.langs}, key=str.encode)
    words = _sorted_words([p.words for p in parts])
    place = {lang: i for i, lang in enumerate(langs)}
    labels = [np.array([place[lang] for lang in p.langs], np.int64) for p in parts]
    names = pc.index_in(pa.chunked_array([p.words for p in parts], pa.binary()), words).to_numpy().astype(np.int64)   # one index for all parts
    names = np.split(names, np.cumsum([len(p.words) for p in parts])[:-1])
    above = [np.zeros(p.roots, np.int64) for p in parts]
    levels: list[Level] = []
    for depth in range(max((len(p.levels) for p in parts), default=0)):
        keys, weights, sizes = [], [], []
        for i, p in enumerate(parts):
            parent, label, weight = p.levels[depth] if depth < len(p.levels) else (np.empty(0, np.int64),) * 3
            label = (names[i] if depth else labels[i])[label]
            keys.append(above[i][parent] * (len(words) + len(langs)) + label)
            weights.append(weight)
            sizes.append(len(label))
        found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, inverse, np.concatenate(weights))
        levels.append((found // (len(words) + len(langs)), found % (len(words) + len(langs)), total))
        above = np.split(inverse, np.cumsum(sizes)[:-1])
    return Grams(langs, words, levels)


def frequent(grams: Grams, least: int) -> Grams:
    """The n-grams that weigh `least` or more, with what they pass."""
    levels = list(grams.levels)
    keep = [weight >= least for _, _, weight in levels]
    for depth in range(len(levels) - 1, 0, -1):
        keep[depth - 1][levels[depth][0][keep[depth]]] = True
    renumber = np.zeros(1, np.int64)
    for depth, (parent, label, weight) in enumerate(levels):
        k = keep[depth]
        levels[depth] = (renumber[parent[k]], label[k], np.where(weight[k] >= least, weight[k], 0))
        renumber = np.cumsum(k) - 1
    levels = [level for level in levels if len(level[0])]
    used = np.unique(np.concatenate([label for _, label, _ in levels[1:]] or [np.empty(0, np.int64)]))
    return Grams(grams.langs, grams.words.take(pa.array(used)),
                 [(p, np.searchsorted(used, label) if depth else label, w) for depth, (p, label, w) in enumerate(levels)])


def dealt(grams: Grams, boundaries: list[tuple[bytes, ...]], most: int) -> Iterator[tuple[np.ndarray, Grams]]:
    """(ranges, their n-grams under a root each), some `most` n-grams or one range at a time: range r holds the n-grams from boundary r - 1 on
    and below boundary r. Ranges without an n-gram are left out. No step is made range by range, since each shard meets each range."""
    langs = [lang.encode() for lang in grams.langs]
    names = grams.words.to_pylist() if len(boundaries) else []
    scale = len(names) + len(langs) + 1
    depths = len(grams.levels)
    edges = np.zeros((len(boundaries) + 2, depths), np.int64)
    edges[-1] = [len(label) for _, label, _ in grams.levels]
    length = np.array([len(b) for b in boundaries], np.int64)
    at, exact = np.zeros(len(boundaries), np.int64), np.ones(len(boundaries), bool)
    for depth, (parent, label, _) in enumerate(grams.levels if len(boundaries) else []):
        symbols, keys = names if depth else langs, parent * scale + label
        rank, there = np.zeros(len(boundaries), np.int64), np.zeros(len(boundaries), bool)
        walked = np.flatnonzero(exact & (length > depth))
        for b in walked.tolist():
            rank[b] = r = bisect_left(symbols, boundaries[b][depth])
            there[b] = r < len(symbols) and symbols[r] == boundaries[b][depth]
        key = at[walked] * scale + rank[walked]
        at = np.searchsorted(parent, at)
        at[walked] = np.searchsorted(keys, key)
        exact = np.zeros(len(boundaries), bool)
        exact[walked] = there[walked] & (at[walked] < len(keys)) & (keys[np.minimum(at[walked], len(keys) - 1)] == key)
        edges[1:-1, depth] = at + (exact & (length > depth + 1))
    edges = np.maximum.accumulate(edges, axis=0)
    ranges = np.flatnonzero((np.diff(edges, axis=0) > 0).any(1))
    lo, hi = edges[ranges].T, edges[ranges + 1].T
    start, stop = lo.copy(), hi.copy()
    for depth in range(depths - 2, -1, -1):                           # with the n-grams that those of the level below pass
        below = grams.levels[depth + 1][0]
        met = np.flatnonzero(stop[depth + 1] > start[depth + 1])
        own = stop[depth, met] > start[depth, met]
        a, z = below[start[depth + 1, met]], below[stop[depth + 1, met] - 1] + 1
        start[depth, met] = np.where(own, np.minimum(start[depth, met], a), a)
        stop[depth, met] = np.where(own, np.maximum(stop[depth, met], z), z)
    counts = stop - start
    for one, end in row_slices(np.r_[0, np.cumsum(counts.sum(0))], most):
        levels: list[Level] = []
        for depth, (parent, label, weight) in enumerate(grams.levels):
            n = counts[depth, one:end]
            base = np.cumsum(n) - n
            root = np.repeat(np.arange(end - one), n)
            at = np.repeat(start[depth, one:end] - base, n) + np.arange(n.sum())
            if not len(at):
                break
            own = (at >= lo[depth, one:end][root]) & (at < hi[depth, one:end][root])
            levels.append((parent[at] + shift[root] if depth else root, label[at], np.where(own, weight[at], 0)))
            shift = base - start[depth, one:end]
        yield ranges[one:end], Grams(grams.langs, grams.words, levels, end - one)


def cut(grams: Grams, boundaries: list[tuple[bytes, ...]]) -> Iterator[tuple[int, Grams]]:
    """(range, its n-grams), one range after the other."""
    for ranges, part in dealt(grams, boundaries, 0):
        yield int(ranges[0]), part


def compose(asked: Grams, t: Transducer) -> list[np.ndarray]:
    """Weight in `t` of each n-gram of `asked`, by level: both are walked together, state by state."""
    width = len(t.words) + len(t.langs) + 1
    source = np.repeat(np.arange(len(t.first) - 1), np.diff(t.first))
    keys = source * width + t.label
    place = {lang: i for i, lang in enumerate(t.langs)}
    langs = np.array([place.get(lang, -1) for lang in asked.langs], np.int64)
    names = pc.fill_null(pc.index_in(asked.words, t.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    at, out = t.starts, []
    for depth, (parent, label, _) in enumerate(asked.levels):
        label = (names if depth else langs)[label]
        state = at[parent]
        key = state * width + label
        arc = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
        met = (state >= 0) & (label >= 0) & (keys[arc] == key if len(keys) else False)
        at = np.where(met, t.target[arc] if len(keys) else -1, -1)
        out.append(np.where(at >= 0, t.weight[at], 0))
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), U64, len(words))


def chained(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of n-grams one word longer."""
    return mix((before * U64(BASE)) ^ word)


class Shard:
    """Word positions of some texts: `lang`, `code` by position; `glued` where a word follows the one before in its piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]):
        data = LOWER[data]
        solid = ~GAP[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begin = solid.copy()
        begin[1:] &= ~solid[:-1] | edge[1:-1]
        begin = np.flatnonzero(begin)
        piece = np.cumsum(BREAK[data] | edge[:-1], dtype=np.int32)[begin]
        self.glued = np.zeros(len(begin), bool)
        self.glued[1:] = piece[1:] == piece[:-1]
        end = solid.copy()
        end[:-1] &= ~solid[1:] | edge[1:-1]
        starts = np.zeros(len(begin) + 1, np.int64)
        np.cumsum(np.flatnonzero(end) + 1 - begin, out=starts[1:])
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(starts), pa.py_buffer(data[solid])])
        coded = column.dictionary_encode()
        self.words = coded.dictionary.cast(pa.binary())
        self.code = coded.indices.to_numpy().astype(np.int64)
        self.langs = sorted(set(langs), key=str.encode)
        place = {lang: i for i, lang in enumerate(self.langs)}
        by_row = np.array([place[lang] for lang in langs], np.int64)
        self.lang = np.repeat(by_row, np.diff(np.searchsorted(begin, offsets)))

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the language, hash of the word) by position."""
        return word_hashes([lang.encode() for lang in self.langs])[self.lang], word_hashes(self.words.to_pylist())[self.code]

    def pairs(self, bits: np.ndarray | None) -> np.ndarray:
        """Where a pair begins whose two words the filter lets through."""
        lang, word = self.hashes()
        good = passes(bits, chained(lang, word))
        out = np.zeros(len(good), bool)
        out[:-1] = good[:-1] & good[1:] & self.glued[1:]
        return out

    def good_pairs(self, bits: np.ndarray | None) -> np.ndarray:
        """Where a pair begins that the filter lets through."""
        lang, word = self.hashes()
        out = np.zeros(len(word), bool)
        out[:-1] = self.glued[1:] & passes(bits, chained(chained(lang, word)[:-1], word[1:]))
        return out

    def grams(self, starts: list[np.ndarray], least_words: int) -> Grams:
        """Counts of the n-grams of `least_words` words and more that begin at `starts[0]`, `starts[1]`, ... (each within the one before)."""
        longest = least_words + len(starts) - 1
        used = np.zeros(len(self.words), bool)
        for n, at in enumerate(starts, least_words):
            for k in range(n):
                used[self.code[at + k]] = True
        old = np.flatnonzero(used)
        names = self.words.take(pa.array(old))
        order = pc.array_sort_indices(names).to_numpy()
        rank = np.zeros(len(self.words), np.int64)
        rank[old[order]] = np.arange(len(old))
        code = rank[self.code]
        at = starts[0]
        spoken, inverse = np.unique(self.lang[at], return_inverse=True)
        levels: list[Level] = [(np.zeros(len(spoken), np.int64), np.arange(len(spoken)), np.zeros(len(spoken), np.int64))]
        scale = len(old) + 1
        for words in range(1, longest + 1):
            if words > least_words:
                inside = np.zeros(len(code), bool)
                inside[starts[words - least_words]] = True
                inside = inside[at]
                at, inverse = at[inside], inverse[inside]
            found, inverse, counts = np.unique(inverse * scale + code[at + words - 1], return_inverse=True, return_counts=True)
            levels.append((found // scale, found % scale, counts if words >= least_words else np.zeros(len(found), np.int64)))
        return Grams([self.langs[i] for i in spoken], names.take(pa.array(order)), [x for x in levels if len(x[0])])


def passes(bits: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.zeros(len(hashes), bool)
    slot = hashes & U64(64 * len(bits) - 1)
    return (bits[(slot >> U64(6)).astype(np.int64)] >> (slot & U64(63))) & U64(1) == 1


def pieces(data: np.ndarray, offsets: np.ndarray, langs: list, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Rows of some `size` bytes at a time; a longer text is cut behind its breaks."""
    for lo, hi in row_slices(offsets, size):
        part = data[offsets[lo]:offsets[hi]]
        if hi - lo > 1 or len(part) <= 2 * size:
            yield part, offsets[lo:hi + 1] - offsets[lo], langs[lo:hi]
            continue
        breaks = np.flatnonzero(BREAK[part]) + 1
        at = 0
        while at < len(part):
            k = np.searchsorted(breaks, at + size)
            stop = int(breaks[k]) if k < len(breaks) else len(part)
            yield part[at:stop], np.array([0, stop - at]), langs[lo:hi]
            at = stop


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """Shards of some SHARD bytes: batches are gathered or cut."""
    held: list[tuple[np.ndarray, np.ndarray, list]] = []
    size = 0

    def gathered() -> Shard:
        lengths = np.concatenate([np.diff(offsets) for _, offsets, _ in held])
        return Shard(np.concatenate([d for d, _, _ in held]), np.r_[0, np.cumsum(lengths)], [x for _, _, langs in held for x in langs])

    for batch in batches:
        data, offsets = utf8(batch.column("_text"))
        for part in pieces(data, offsets, batch.column("_lang").to_pylist(), SHARD):
            held.append(part)
            size += len(part[0])
            if size >= SHARD:
                yield gathered()
                held, size = [], 0
    if held:
        yield gathered()


def _batch(parts, lists: list[tuple[str, np.ndarray, pa.Array | np.ndarray | list]]) -> pa.RecordBatch:
    """Rows of SCHEMA from (column, where each row's list begins and the last one ends, values of all lists)."""
    kinds = {"langs": pa.string(), "words": pa.binary(), "weight": pa.int64(), "totals": pa.int64()}
    arrays = {name: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), v if isinstance(v, pa.Array) else pa.array(v, kinds.get(name, pa.int32())))
              for name, offsets, v in lists}
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *arrays.values()], ["part", *arrays])


def _row(part: int, t: Transducer, totals: list[int]) -> pa.RecordBatch:
    lists = [("langs", t.langs), ("words", t.words), ("first", t.first), ("label", t.label), ("target", t.target), ("weight", t.weight), ("totals", totals)]
    return _batch([part], [(name, np.array([0, len(v)]), v) for name, v in lists])


def _rows(parts: np.ndarray, t: Transducer, totals: np.ndarray) -> pa.RecordBatch:
    """A row for each of the automata, with its own numbers of states, arcs, languages and words. `totals` go by languages."""
    states = np.r_[0, t.starts + 1]
    arcs = t.first[states]
    row = np.repeat(np.arange(len(parts)), np.diff(arcs))
    spoken = np.arange(len(row)) >= t.first[t.starts][row]            # arcs of a start come last
    langs = np.r_[0, np.cumsum(t.first[t.starts + 1] - t.first[t.starts])]
    found, place = np.unique(row[~spoken] * len(t.words) + t.label[~spoken], return_inverse=True)
    words = np.searchsorted(found, np.arange(len(parts) + 1) * len(t.words))
    label = np.empty(len(row), np.int64)
    label[~spoken] = place - words[row[~spoken]]
    label[spoken] = np.arange(langs[-1]) - langs[row[spoken]]
    ends = np.diff(states) + 1                                        # first has one number more than there are states
    firsts = np.r_[0, np.cumsum(ends)]
    of = np.repeat(np.arange(len(parts)), ends)
    first = t.first[np.arange(firsts[-1]) - of] - arcs[of]
    return _batch(parts, [
        ("langs", langs, pa.array(t.langs, pa.string()).take(pa.array(t.label[spoken]))), ("words", words, t.words.take(pa.array(found % max(len(t.words), 1)))),
        ("first", firsts, first), ("label", arcs, label), ("target", arcs, t.target - states[row]), ("weight", states, t.weight), ("totals", langs, totals)])


def _lists(table: pa.Table | pa.RecordBatch, name: str) -> tuple[pa.Array, np.ndarray]:
    """(values of all rows' lists, lengths of the lists)."""
    column = table.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    return column.values.slice(offsets[0], offsets[-1] - offsets[0]), np.diff(offsets)


def _ranked(symbols: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(different symbols in byte order, place of each among them)."""
    coded = symbols.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), rank[coded.indices.to_numpy()]


def _joined(table: pa.Table | pa.RecordBatch) -> tuple[Transducer, dict[str, int]]:
    """The automata of all rows as one, with languages and words numbered alike, and the languages' totals."""
    (langs, spoken), (words, named) = _lists(table, "langs"), _lists(table, "words")
    langs, lang = _ranked(langs.cast(pa.binary()))
    words, word = _ranked(words.cast(pa.binary()))
    (first, ends), (label, arcs), (target, _), (weight, states), (totals, _) = (
        (v.to_numpy().astype(np.int64), n) for v, n in (_lists(table, c) for c in ("first", "label", "target", "weight", "totals")))
    row = np.repeat(np.arange(len(arcs)), arcs)
    state = np.r_[0, np.cumsum(states)]
    inner = np.ones(len(first), bool)
    inner[np.cumsum(ends) - 1] = False
    first = np.r_[first[inner] + np.repeat(np.cumsum(arcs) - arcs, states), len(label)]
    starts = state[1:] - 1
    start = np.arange(len(row)) >= first[starts][row]
    at = label + np.where(start, (np.cumsum(spoken) - spoken)[row], (np.cumsum(named) - named)[row])
    label[start], label[~start] = lang[at[start]], word[at[~start]]
    total = np.zeros(len(langs), np.int64)
    np.add.at(total, lang, totals)
    names = [x.decode() for x in langs.to_pylist()]
    return Transducer(names, words, first, label, target + state[row], weight, starts), dict(zip(names, total.tolist()))


def _transducers(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[Transducer, list[int]]]:
    for i in range(table.num_rows):
        def values(name):
            return table.column(name)[i].values

        yield Transducer(values("langs").to_pylist(), values("words").cast(pa.binary()),
                         *(values(c).to_numpy().astype(np.int64) for c in ("first", "label", "target", "weight")),
                         np.array([len(values("weight")) - 1])), values("totals").to_pylist()


@releasing
def _count(batches: Iterator[pa.RecordBatch], words: int, boundaries: list, bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Transducers by range of the n-grams of a pass: words, pairs, or three words and more."""
    for shard in _shards(batches):
        if words == 1:
            starts = [np.arange(len(shard.code))]
        elif words == 2:
            starts = [np.flatnonzero(shard.pairs(bits))]
        else:
            pair, starts = shard.good_pairs(bits), []
            chain = pair
            for n in range(3, LONGEST + 1):
                chain = chain[:-1] & pair[n - 2:] if len(chain) else chain
                starts.append(np.flatnonzero(chain))
        if not len(starts[0]):
            continue
        for parts, grams in dealt(shard.grams(starts, words), boundaries, DEALT):
            totals = np.zeros(len(grams.levels[0][0]), np.int64)
            if words == 1 and len(grams.levels) > 1:
                np.add.at(totals, grams.levels[1][0], grams.levels[1][2])
            yield _rows(parts, shared(grams), totals)


def _sum(table: pa.Table, least: int) -> pa.Table:
    """One transducer of the n-grams of a range that are frequent over all shards. Shards are read some MERGED arcs at a time, not one by one.
    What is merged doubles in size each time, so each n-gram is merged a logarithmic number of times."""
    totals: dict[str, int] = {}
    merged: list[Grams] = []
    arcs = pc.list_value_length(table.column("label")).to_numpy()
    for lo, hi in row_slices(np.r_[0, np.cumsum(arcs)], MERGED):
        t, counts = _joined(table.slice(lo, hi - lo))
        for lang, count in counts.items():
            totals[lang] = totals.get(lang, 0) + count
        merged.append(union([spelled(t)]))
        while len(merged) > 1 and 2 * _size(merged[-1]) >= _size(merged[-2]):
            merged[-2:] = [union(merged[-2:])]
    kept = frequent(union(merged), least)
    whole = union([kept, Grams(sorted(totals, key=str.encode), kept.words, [])])   # languages without a frequent n-gram keep their total
    row = _row(table.column("part")[0].as_py(), shared(whole), [totals[lang] for lang in whole.langs])
    del merged, kept, whole
    release()
    return pa.Table.from_batches([row])


def _size(grams: Grams) -> int:
    return sum(len(level[0]) for level in grams.levels)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, words, f, hash) of all n-grams of the transducers."""
    for batch in batches:
        for t, _ in _transducers(batch):
            grams = spelled(t)
            names = t.words.to_pylist()
            known = word_hashes(names)
            lang = phrase = hashes = None
            for depth, (parent, label, weight) in enumerate(grams.levels):
                if depth == 0:
                    lang, phrase = label, [b""] * len(label)
                    hashes = word_hashes([x.encode() for x in t.langs])[label]
                    continue
                lang, hashes = lang[parent], chained(hashes[parent], known[label])
                phrase = [phrase[p] + b" " + names[w] if phrase[p] else names[w] for p, w in zip(parent.tolist(), label.tolist())]
                at = np.flatnonzero(weight)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t.langs[lang[i]] for i in at]), pa.array([phrase[i].decode() for i in at]), pa.array(np.full(len(at), depth, np.int32)),
                         pa.array(weight[at]), pa.array(hashes[at].view(np.int64))], ["lang", "phrase", "words", "f", "hash"])


LISTED = "lang string, phrase string, words int, f long, hash long"


def _sampled(batches: Iterator[pa.RecordBatch], each: int) -> Iterator[pa.RecordBatch]:
    """Some word runs of every text, as boundaries of ranges are drawn from."""
    for batch in batches:
        data, offsets = utf8(batch.column("_text"))
        for part, at, langs in pieces(data, offsets, batch.column("_lang").to_pylist(), SHARD):
            shard = Shard(part, at, langs)
            if not len(shard.code):
                continue
            names = shard.words.to_pylist()
            found = []
            picks = max(1, min(len(shard.code), each * len(langs)))
            for i in np.linspace(0, len(shard.code) - 1, picks).astype(np.int64).tolist():
                stop = i + 1
                while stop < min(i + LONGEST, len(shard.code)) and shard.glued[stop]:
                    stop += 1
                found.append([shard.langs[shard.lang[i]].encode(), *(names[c] for c in shard.code[i:stop])])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.binary()))], ["run"])


def draw_boundaries(rows: DataFrame) -> list[tuple[bytes, ...]]:
    """Sorted n-grams that cut all n-grams into ranges of about RANGE bytes of text. They come from a sample of SAMPLED word runs a range, and
    decide balance only, no result."""
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()
    ranges = min(MOST_RANGES, -(-size // RANGE))
    if ranges < 2:
        return []
    every = max(1, n // max(SAMPLED * ranges, 4096))
    picked = rows.where(F.expr(f"pmod(xxhash64(_text), {every}) = 0"))
    runs = sorted(tuple(map(bytes, r.run)) for r in picked.mapInArrow(partial(_sampled, each=max(1, SAMPLED * ranges * every // max(n, 1))), "run array<binary>")
                  .collect())
    return sorted({runs[len(runs) * i // ranges] for i in range(1, ranges)}) if runs else []


def bits_of(grams: DataFrame) -> np.ndarray | None:
    """Filter of the n-grams' hashes: 16 bits for each, MOST_BITS at most."""
    count = grams.count()
    if not count:
        return None
    size = 1 << 12
    while size < min(16 * count, MOST_BITS):
        size *= 2
    slots = (grams.select(F.expr(f"hash & {size - 1}L").alias("slot"))
             .groupBy(F.expr("slot >> 6").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("bits")).toPandas())
    out = np.zeros(size // 64, np.int64)
    out[slots["at"].to_numpy(np.int64)] = slots["bits"].to_numpy(np.int64)
    return out.view(U64)


def _parts(batches: Iterator[pa.RecordBatch], boundaries: list) -> Iterator[pa.RecordBatch]:
    """(part, lang, phrase) of all beginnings and ends of the candidates, each with the range it falls into."""
    for batch in batches:
        asked = set()
        for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
            words = phrase.split(" ")
            for k in range(1, len(words)):
                asked.add((lang, " ".join(words[:k])))
                asked.add((lang, " ".join(words[k:])))
        rows = [(bisect_right(boundaries, (lang.encode(), *phrase.encode().split(b" "))), lang, phrase) for lang, phrase in sorted(asked)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])],
                                             ["part", "lang", "phrase"])


def asked_grams(langs: list[str], phrases: list[str]) -> tuple[Grams, list[tuple[int, int]]]:
    """Transducer levels that spell the phrases asked for, and (level, place) of each phrase."""
    split = [phrase.encode().split(b" ") for phrase in phrases]
    words = _sorted_words([pa.array(sorted({w for s in split for w in s}), pa.binary())])
    names = {w: i for i, w in enumerate(words.to_pylist())}
    spoken = sorted(set(langs), key=str.encode)
    tongues = {lang: i for i, lang in enumerate(spoken)}
    levels: list[dict] = [{(0, i): i for i in range(len(spoken))}] + [{} for _ in range(max(map(len, split), default=0))]
    places = []
    for lang, s in zip(langs, split):
        at = tongues[lang]
        for depth, word in enumerate(s, 1):
            at = levels[depth].setdefault((at, names[word]), len(levels[depth]))
        places.append((len(s), at))
    made = []
    for level in levels:
        pairs = np.array(list(level), np.int64).reshape(-1, 2)
        made.append((pairs[:, 0], pairs[:, 1], np.ones(len(pairs), np.int64)))
    return Grams(spoken, words, made), places


def _looked_up(asked: pa.Table, ranges: pa.Table) -> pa.Table:
    """(lang, phrase, f) of the phrases asked for in a range."""
    langs, phrases = asked.column("lang").to_pylist(), asked.column("phrase").to_pylist()
    found = np.zeros(len(phrases), np.int64)
    if phrases:
        grams, places = asked_grams(langs, phrases)
        for t, _ in _transducers(ranges):
            weights = compose(grams, t)
            found += np.array([weights[depth][at] for depth, at in places], np.int64)
    return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string()), "f": found})


def _counted(rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Written to the shared folder: transducers of words, pairs and longer n-grams, the candidates, and how often their parts occur."""
    boundaries = draw_boundaries(rows)

    def counted(words: int, bits: np.ndarray | None) -> DataFrame:
        shards = rows.mapInArrow(partial(_count, words=words, boundaries=boundaries, bits=bits), SCHEMA)
        return materialize(shards.groupBy("part").applyInArrow(lambda table: _sum(table, least), SCHEMA), f"phrases-{words}")

    def listed(ranges: DataFrame) -> DataFrame:
        return ranges.mapInArrow(_listed, LISTED)

    single = counted(1, None)
    pairs = counted(2, bits_of(listed(single)))
    longer = counted(3, bits_of(listed(pairs)))
    candidates = materialize(listed(pairs.unionByName(longer)).drop("hash"), "phrase-candidates")

    parts = candidates.mapInArrow(partial(_parts, boundaries=boundaries), "part int, lang string, phrase string").distinct()
    ranges = single.unionByName(pairs).unionByName(longer)
    counts = materialize(parts.groupBy("part").cogroup(ranges.groupBy("part")).applyInArrow(_looked_up, "lang string, phrase string, f long"),
                         "phrase-parts")
    return single, pairs, longer, candidates, counts


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of BATCH rows for what runs inside, since executor and worker both hold a batch; shards gather rows over batches anyway."""
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(min(int(before), BATCH) if int(before) > 0 else BATCH))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


def mine(docs: DataFrame, least: int = 100, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases.

    Texts (null: empty) in lower case (A to Z) are split at .,;:!? and line ends into pieces and those at blanks and tabs into words. `n`
    counts a language's words (null: und), f(phrase) the phrase's occurrences within pieces. Phrases of two to five words with a = f >= `least`
    score 1000 a n / (l r), rounded down, at the cut into first part (l) and rest (r) that scores least, ties to the shortest first part. Phrases
    inside a longer one that is as frequent are dropped. Best score first, then a, then the phrase in byte order; all scores are exact.
    Repeated rows count each; empty tables and languages without such a phrase give no rows; other columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("_lang"), F.col(text).alias("_text"))
    with small_batches(docs.sparkSession):
        single, pairs, longer, candidates, counts = _counted(rows, least)
    totals = (single.select(F.explode(F.arrays_zip("langs", "totals")).alias("t")).groupBy(F.col("t.langs").alias("lang"))
              .agg(F.sum("t.totals").alias("n")))

    words = F.split("phrase", " ")
    cuts = (candidates.select("lang", "phrase", F.col("f").alias("a"), words.alias("_w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("_k"))
            .select("lang", "phrase", "a", "_k", F.array_join(F.slice("_w", F.lit(1), F.col("_k")), " ").alias("_first"),
                    F.array_join(F.slice("_w", F.col("_k") + 1, F.size("_w") - F.col("_k")), " ").alias("_rest")))
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l")), ["lang", "_first"])
            .join(counts.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r")), ["lang", "_rest"])
            .join(totals, "lang"))
    wide = "cast(1000 as decimal(4, 0)) * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0))"
    score = F.expr(f"{wide} div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    scored = (cuts.withColumn("score", score).groupBy("lang", "phrase")
              .agg(F.min(F.struct("score", "_k", "a", "l", "r", "n")).alias("_s")).select("lang", "phrase", "_s.*"))

    inside = (candidates.where("words > 2").select(
        "lang", "f", F.col("words").alias("_size"), words.alias("_w"), F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("_n"))
        .select("lang", "f", "_w", "_n", F.explode(F.sequence(F.lit(1), F.col("_size") - F.col("_n") + 1)).alias("_at"))
        .select("lang", "f", F.array_join(F.slice("_w", F.col("_at"), F.col("_n")), " ").alias("phrase")))
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("_longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where("_longer is null or _longer < a")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", "_salt").orderBy(*best)          # a language may hold most phrases: its best come from 64 parts
    few = kept.withColumn("_salt", F.expr("pmod(xxhash64(phrase), 64)")).withColumn("_near", F.row_number().over(salted)).where(F.col("_near") <= top)
    return (few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
