"""Repeats, near copies, leaks, tokens and shards against plain versions."""

import hashlib
import itertools
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from gridspark.llm import bpe, decontaminate, jaccard, sharding, suffix
from gridspark.llm._text import utf8, words

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_words_across_blocks(monkeypatch):
    from gridspark.llm import _text

    texts = ["the cat", "", " sat  on", "the", None, "cat\nthe"]
    whole = words(*utf8(pa.array(texts)))
    monkeypatch.setattr(_text, "BLOCK", 3)
    _text.powers.cache_clear()
    parts = words(*utf8(pa.array(texts)))
    _text.powers.cache_clear()
    for a, b in zip(whole, parts):
        assert (a == b).all()
    assert list(np.diff(whole[3])) == [2, 0, 2, 1, 0, 2]
    assert whole[2][0] == whole[2][4] == whole[2][6] and whole[2][1] == whole[2][5]


def plain_repeats(rows, length):
    """(id, bytes, removed, spans, digest) by a set of all windows, rows equal in id and text once."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode())))
    seen, out = set(), {}
    for i, t in order:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        runs = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i, t] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return sorted(((i, *out[i, t]) for i, t in rows), key=str)


@pytest.mark.parametrize("size,hot,most", [(1 << 24, 4096, 16), (300, 3, 2)])
def test_repeats(spark, make_docs, hard_rows, monkeypatch, size, hot, most):
    monkeypatch.setattr(suffix, "INDEX_BYTES", size)
    monkeypatch.setattr(suffix, "GATHER_BYTES", size)
    monkeypatch.setattr(suffix, "HOT_LEAST", hot)
    monkeypatch.setattr(suffix, "KEY_RUNS", most)
    rows = [r for r in hard_rows if r[0] != 4] + [(4, "x" * 3000), (20, "x" * 500)]
    got = suffix.report(make_docs(rows))
    assert rows_of(got, *got.columns) == plain_repeats(rows, 100)


def test_repeated_passage_in_many_texts(spark, make_docs, monkeypatch):
    monkeypatch.setattr(suffix, "HOT_LEAST", 5)
    monkeypatch.setattr(suffix, "INDEX_BYTES", 2000)
    rng = random.Random(1)
    fill = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = fill(260)
    rows = [(i, fill(rng.randrange(150)) + passage[rng.randrange(20):] + fill(rng.randrange(150))) for i in range(60)]
    got = suffix.report(make_docs(rows))
    assert rows_of(got, *got.columns) == plain_repeats(rows, 100)


def test_cut_texts(spark, make_docs, hard_rows):
    docs = make_docs(hard_rows)
    out = suffix.remove_repeats(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    texts = {r["doc_id"]: r for r in out.collect() if r["doc_id"] != 11}
    assert texts[0]["text"] is None and texts[1]["text"] == "" and 6 not in texts
    assert texts[4]["text"] == "x" and texts[4]["n_chars"] == 1
    assert suffix.remove_repeats(make_docs([])).count() == 0 and suffix.report(make_docs([])).count() == 0


def test_settled_rows_of_one_text_fall_into_all_buckets():
    rows = np.zeros(2000, suffix.PART)
    rows["doc"], rows["start"] = np.arange(2000), 7
    assert np.bincount(suffix.scattered(rows, np.uint64(20)).astype(int), minlength=20).min() > 50
    import pyarrow as pa

    notice = "".join(chr(97 + i % 26) + str(i) for i in range(40))
    batch = pa.RecordBatch.from_pydict({"doc": np.arange(500), "tie": np.zeros(500, np.int64), "text": [notice] * 500})
    rest = [(b, len(suffix.unpack(blob, suffix.RUN))) for out in suffix._index([batch], 100, 20)
            for b, kind, blob in zip(*(out.column(n).to_pylist() for n in ("bucket", "kind", "blob"))) if kind == 1]
    assert len(rest) == 20 and max(n for _, n in rest) < 3 * sum(n for _, n in rest) / 20


def test_family_merges_geometrically():
    family, rng = suffix.Family(), np.random.default_rng(0)
    for _ in range(64):
        batch = np.zeros(10, suffix.RUN)
        batch["key"] = np.sort(rng.integers(0, 10_000, 10))
        family.add(batch)
        sizes = [len(level) for level, _ in family.levels]
        assert all(2 * b <= a for a, b in zip(sizes, sizes[1:]))
    entries, met = family.close()
    assert len(entries) == 640 and (np.diff(entries["key"].astype(np.int64)) >= 0).all()
    again = Counter(entries["key"].tolist())
    for key in {k for k, n in again.items() if n > 1}:
        assert met[entries["key"] == key].any()


def plain_classes(rows, n=5, threshold=0.8):
    sets, links, parent = [], Counter(), list(range(len(rows)))
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)].append(i)
    low = {k: min((i for i in ids if i is not None), default=None) for k, ids in least.items()}
    return sorted(((i, low[find(k)], links[k]) for k, (i, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [1024, 2])
def test_near_copies(spark, make_docs, hard_rows, block):
    got = jaccard.join(make_docs(hard_rows), block_rows=block)
    assert rows_of(got, "doc_id", "class_id", "n_links") == plain_classes(hard_rows)


def test_a_group_of_near_copies(spark, make_docs):
    rng = random.Random(2)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(60)] = f"v{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    got = jaccard.join(make_docs(rows), block_rows=16)
    assert rows_of(got, "doc_id", "class_id", "n_links") == plain_classes(rows)


def test_one_of_each(spark, make_docs, hard_rows):
    docs = make_docs(hard_rows)
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    classes = Counter(r["class_id"] for r in jaccard.join(docs).collect())
    kept = out.collect()
    assert {r["doc_id"] for r in kept} == set(classes) and len(kept) == len({(r["doc_id"], r["text"]) for r in kept})
    assert jaccard.one_of_each(make_docs([])).count() == 0


def test_band_plan_reaches_the_recall():
    for t, recall in ((0.8, 0.9999), (0.5, 0.95), (0.9, 0.999)):
        bands, rows = jaccard.plan(t, recall)
        assert bands * rows <= jaccard.MOST_HASHES and 1 - (1 - t ** rows) ** bands >= recall


def edit_distance_inside(item, text):
    now = [0] * (len(text) + 1)
    for c in item:
        new = [now[0] + 1]
        for p, t in enumerate(text):
            new.append(min(now[p] + (c != t), now[p + 1] + 1, new[p] + 1))
        now = new
    return min(now)


@pytest.mark.parametrize("heavy,chunk,merge", [(1 << 23, 1 << 21, 1 << 22), (0, 7, 3), (20, 50, 100)])
def test_leaks_against_plain_alignment(monkeypatch, heavy, chunk, merge):
    for name, value in [("HEAVY", heavy), ("CHUNK", chunk), ("MERGE", merge)]:
        monkeypatch.setattr(decontaminate, name, value)
    rng = random.Random(1)
    for trial in range(20):
        letters = "abcdefghijklmnop é \n" if trial % 2 == 0 else "abcd " if trial % 4 == 1 else "ab"
        items = [(i, "".join(rng.choice(letters) for _ in range(rng.choice([3, 9, 15, 25, 60, 120])))) for i in range(6)]
        docs = []
        for _ in range(10):
            t = "".join(rng.choice(letters) for _ in range(rng.choice([0, 5, 50, 200])))
            for _ in range(rng.randint(0, 2)):
                it = list(rng.choice(items)[1])
                for _ in range(rng.randint(0, int(len(it) * 0.14) + 1)):
                    p = rng.randrange(len(it) + 1)
                    it[p:p + rng.randint(0, 1)] = [rng.choice(letters)] * rng.randint(0, 1)
                c = rng.randrange(len(t) + 1)
                t = t[:c] + "".join(it) + t[c:]
            docs.append(t)
        index = decontaminate.Index(items, 0.1)
        data, offsets = utf8(pa.array(docs))
        got = {(a, index.ids[b]): e for a, b, e, _, _ in decontaminate.matches(index, data, offsets)}
        for a, t in enumerate(docs):
            for i, it in items:
                n = b" ".join(it.encode().lower().split())
                if n:
                    e = edit_distance_inside(n, b" ".join(t.encode().lower().split()) + (b" " if t[-1:].isspace() else b""))
                    assert got.get((a, i)) == (e if e <= int(len(n) * 0.1 + 1e-9) else None)


def test_leaks_in_periodic_texts():
    tracemalloc.start()
    for text, item, want in [("x" * 1_000_000, "x" * 2000, (0, 0, 2000)), ("ab" * 100_000, "ba" * 500, (0, 1, 1001)),
                             ("x" * 20_000, "x" * 299 + "y", (1, 0, 299)), ("xy " * 50_000, "z" * 90, None)]:
        index = decontaminate.Index([(1, item)], 0.1)
        got = decontaminate.all_matches(index, pa.array(["clean text", text]))
        assert got == ([(1, 0, *want)] if want else [])
    assert tracemalloc.get_traced_memory()[1] < 1 << 30
    tracemalloc.stop()


def test_leaks_in_a_table(spark, make_docs, hard_rows):
    item = "Which of these answers, if any, is the right one to the question asked above by the examiner in the hall?"
    edited = item.replace("right", "wrong").replace("  ", " ").upper()
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, item), (None, "something that occurs nowhere in all of this")],
                                  "item_id long, text string")
    docs = make_docs([*hard_rows, (50, "Before. " + edited + " After."), (51, item.replace(" ", "\n  ")), (52, item[:50])])
    for block in (16 << 20, 40):
        found = decontaminate.find(docs, bench, block_bytes=block)
        assert rows_of(found, "doc_id", "item_id") == [(50, 1), (50, 4), (51, 1), (51, 4)]
        kept = decontaminate.drop_contaminated(docs, bench, block_bytes=block)
        assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    row = decontaminate.find(docs, bench).where("doc_id = 50 and item_id = 1").first()
    assert ("Before. " + edited)[row["first_byte"]:row["end_byte"]] == edited and row["edits"] == 5
    assert decontaminate.find(make_docs([]), bench).count() == 0
    assert decontaminate.find(docs, bench.where("false")).count() == 0


def test_bpe_round_trip(spark, make_docs, hard_rows):
    odd = [(30, "a'll 've  \n\n  x  "), (31, "\x1c\x1d a\x85b "), (32, "日本語のテキスト" * 20_000), (33, " \n" * 70_000 + "end"),
           (34, ("word 12 'tis!! " * 9000)), (35, "<|endoftext|>")]
    rows = hard_rows + odd
    enc = tiktoken.Encoding("plain", pat_str=PATTERN, special_tokens={}, mergeable_ranks=bpe.encoding(RANKS, PATTERN)._mergeable_ranks)
    want = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), sha, hashlib.sha256((t or "").encode()).hexdigest()))
    got = bpe.digests(make_docs(rows), RANKS, PATTERN)
    assert rows_of(got, *got.columns) == sorted(want, key=str)
    assert bpe.digests(make_docs([]), RANKS, PATTERN).count() == 0
    for i, t in odd:
        assert bpe.encode_text(enc, t, piece=7) == enc.encode_ordinary(t)
    back = bpe.decode(spark.createDataFrame([(1, enc.encode_ordinary("é!")[:1]), (2, None)], "doc_id long, token_ids array<int>"), RANKS, PATTERN)
    assert rows_of(back, "doc_id", "decoded")[1] == (2, b"")


def test_shards(spark, make_docs, hard_rows):
    rng = random.Random(3)
    rows = hard_rows + [(100 + i, "y" * rng.randrange(1, 20_000)) for i in range(500)]
    got = sharding.assign(make_docs(rows), shards=8).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    shard_of = defaultdict(set)
    for r in got:
        shard_of[r["text_crc32"], r["size"]].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(len(s) == 1 for s in shard_of.values())
    for k in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    sizes = [sum(r["size"] for r in got if r["shard"] == k) for k in range(8)]
    assert max(sizes) - min(sizes) < 0.001 * sum(sizes)
    heavy = sharding.assign(make_docs([(i, f"{i}" * 50) for i in range(3000)] + [(5000, "z" * 40_000)]), shards=4).collect()
    sizes = [sum(r["size"] for r in heavy if r["shard"] == k) for k in range(4)]
    assert max(sizes) - min(sizes) < 0.001 * sum(sizes)
    assert sharding.assign(make_docs([])).count() == 0


def test_differencing_combines_largest_spreads():
    # 8 7 6 5 4 into two parts: differences 1, then 2, ... leave 16 and 14
    goes = sharding.difference([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]])
    sums = [0, 0]
    for size, where in zip([8, 7, 6, 5, 4], goes):
        sums[where[0]] += size
    assert sorted(sums) == [14, 16]


@pytest.mark.parametrize("width", [2, 3])
def test_differencing_against_every_partition(width):
    """Two shards of at most four groups come out best; never is the spread above the best one by more than the largest group."""
    rng = random.Random(width)
    for _ in range(60):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(1, 4 if width == 2 else 7))]
        goes = sharding.difference([[s, *[0] * (width - 1)] for s in sizes])
        sums = [0] * width
        for s, g in zip(sizes, goes):
            sums[g[0]] += s
        best = min(max(t) - min(t) for t in (
            [sum(s for s, p in zip(sizes, parts) if p == k) for k in range(width)]
            for parts in itertools.product(range(width), repeat=len(sizes))))
        assert best <= max(sums) - min(sums) <= best + max(sizes)
        assert width > 2 or max(sums) - min(sums) == best


def test_windows_are_compared_in_bounded_memory():
    """Beside a few numbers for each window only those of one piece are in memory, and pieces change no result."""
    n, rng = 2_000_000, np.random.default_rng(3)
    part = np.zeros(2, suffix.PART)
    part["doc"], part["size"] = (4, 9), n // 2
    run, at, place = np.repeat(np.arange(2, dtype=np.int32), n // 2), np.arange(n), np.array([0, n // 2])
    windows = rng.integers(0, n, n).astype(np.uint64)
    tracemalloc.start()
    marks = suffix._repeated(windows, run, at, part, place)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    first = np.zeros(n, bool)
    first[np.unique(windows, return_index=True)[1]] = True
    assert (marks == ~first).all() and peak < 64 * n
