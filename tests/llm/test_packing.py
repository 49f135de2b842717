"""Packing against the tokenizer itself, exhaustive search and first fit."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gridspark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


WHOLE = Tokenizer.from_file(PATH)
WHOLE.encode_special_tokens = True


def plain_ids(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1]


def slots(made):
    """{sequence: [(offset, length)]} of a plan, and the numbers given out by length."""
    out, numbers = defaultdict(list), defaultdict(list)
    for length, first, many, sequence, each, offset in made.rows:
        for w in range(many):
            out[sequence + w // each].append((offset + w % each * length, length))
            numbers[length].append(first + w)
    return out, numbers


def check(counts, made):
    out, numbers = slots(made)
    assert {n: sorted(v) for n, v in numbers.items()} == {n: list(range(c)) for n, c in counts.items() if c}
    assert sorted(out) == list(range(made.sequences))
    for items in out.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= made.capacity


def first_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        for i, g in enumerate(gaps):
            if g >= n:
                gaps[i] -= n
                break
        else:
            gaps.append(capacity - n)
    return len(gaps)


def fewest(lengths, capacity):
    best = len(lengths)

    def go(i, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if i == len(lengths):
            best = len(gaps)
            return
        for g in sorted(set(gaps)):
            if g >= lengths[i]:
                rest = gaps.copy()
                rest.remove(g)
                go(i + 1, [*rest, g - lengths[i]])
        go(i + 1, [*gaps, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_plan_small(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
    made = packing.plan(Counter(lengths), 20, groups=3, small=5)
    check(Counter(lengths), made)
    assert made.sequences <= fewest(lengths, 20) + 1


@pytest.mark.parametrize("seed,shape", [(1, "log"), (2, "even"), (3, "thirds"), (4, "one"), (5, "halves")])
def test_plan_large(seed, shape):
    rng = np.random.default_rng(seed)
    n = 20_000
    lengths = {"log": lambda: np.exp(rng.normal(6.4, 1, n)).astype(int), "even": lambda: rng.integers(1, 4097, n) // 8 * 8,
               "thirds": lambda: rng.choice([1365, 1366, 1000, 400], n), "one": lambda: np.full(n, 700),
               "halves": lambda: rng.integers(2040, 2060, n)}[shape]()
    lengths = np.clip(lengths, 1, 4096).tolist()
    made = packing.best_plan(Counter(lengths))
    check(Counter(lengths), made)
    assert made.sequences <= first_fit(lengths, 4096) * 1.002 + 1
    assert len(made.rows) < 40_000


def test_plan_does_not_grow():
    counts = {n: 1 + n % 7 for n in range(1, 4097)}
    few, many = packing.plan(counts, 4096, 64, 4), packing.plan({n: c * 10 ** 9 for n, c in counts.items()}, 4096, 64, 4)
    assert len(many.rows) < 3 * len(few.rows) and many.sequences <= few.sequences * 10 ** 9
    assert sum(n * c for n, c in counts.items()) * 10 ** 9 > 0.97 * 4096 * many.sequences


def test_configurations_reach_the_bound():
    sizes, demand = [7, 5, 3], [100, 100, 200]
    got = packing.configurations(sizes, demand, 12)
    assert all(sum(s * c for s, c in zip(sizes, cols)) <= 12 for _, cols in got)
    assert all(sum(a * cols[i] for a, cols in got) >= demand[i] - 1e-6 for i in range(3))
    assert sum(a for a, _ in got) == pytest.approx(150)               # 7 + 5 and 3 + 3 + 3 + 3


def test_knapsack():
    rng = random.Random(1)
    for _ in range(30):
        sizes = sorted({rng.randint(3, 15) for _ in range(4)}, reverse=True)
        worth = np.array([rng.random() for _ in sizes])
        value, counts = packing.best_configuration(sizes, worth, 20)
        assert sum(s * c for s, c in zip(sizes, counts)) <= 20 and value == pytest.approx(float(worth @ counts))
        every = (c for r in range(7) for c in combinations_with_replacement(range(len(sizes)), r))
        assert value == pytest.approx(max(sum(worth[i] for i in c) for c in every if sum(sizes[i] for i in c) <= 20))


def test_words_give_the_ids_of_the_text(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 50)
    rng = random.Random(3)
    bits = ["don't", "It's", "we'LL", "12ab", "…", "é", "é", "́", "ß", "İ", "Σ", "日本", "a.b,c", "'", "''s", " ", "x y", "\x85",
            "<|endoftext|>", "\x1c", "\x00", "️", "👍🏽", "ﬁ", "Ǆ", "'s", "H\u0331", "h\u0331.", "a.\u0301", "I\u0307", "Ab!?", "A'S.", "-", "_", " ", "\n", "\t", "\r\n", "\x0b", "\x0c", "w" * 300]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", "  ", "\n"]) for _ in range(rng.randrange(40))) for _ in range(300)]
    ids, at = packing.encode(pa.array(texts, pa.large_string()), 1, packing.Words(PATH))
    for i, text in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == plain_ids(text), repr(text)


@pytest.mark.parametrize("capacity", [4096, 60])
def test_pack(spark, make_docs, hard_rows, capacity, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 4000)
    packed = packing.pack(make_docs(hard_rows).repartition(5), PATH, capacity=capacity, ids=True)
    got = packed.collect()
    want = Counter()
    for i, text in hard_rows:
        ids = plain_ids(text)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            want[i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append(r)
    for rows in held.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    tokens = sum(r.length for r in got)
    assert len(held) <= first_fit([r.length for r in got], capacity) and len(held) >= -(-tokens // capacity)
    laid = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for number, rows in held.items():
        assert laid[number] == [t for r in sorted(rows, key=lambda r: r.offset) for t in r.ids]


def test_pack_nothing(spark, make_docs):
    out = packing.pack(make_docs([]), PATH)
    assert out.count() == 0 and out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
