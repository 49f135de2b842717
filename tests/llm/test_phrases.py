"""Automata and phrases against plain dictionaries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gridspark.llm import phrases
from gridspark.llm._text import utf8


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split("[ \t]+", piece) if w] for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def plain(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in plain_words(text):
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inner = defaultdict(int)
        for p, a in good.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inner[p[i:i + k]] = max(inner[p[i:i + k]], a)
        best = []
        for p, a in good.items():
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            if inner[p] < a:
                best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def some_rows(seed, n=400):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "new", "york", "city", "straße", "ñandú", "日本", "a\x00b", "x-y", "don't", "é", "zz"]
    common = "in the middle of nowhere at all"
    rows = []
    for _ in range(n):
        words = rng.choices(vocabulary, [8, 2, 6, 3, 3, 2, 1, 1, 1, 1, 1, 1, 1, 1], k=rng.randrange(0, 40))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!?", "\x0b", "\r\n"]) for w in words)
        rows.append((rng.choice(["en", "en", "de", None, ""]), text + (common if rng.random() < 0.2 else "")))
    return rows + [("en", None), ("en", ""), (None, "the the the the the the"), ("fr", "once only"), ("en", "x" * 5000)] + [("en", "hot pair")] * 50


SCHEMA = "lang string, text string, phrase string, f long, words int, n long, part int, _lang string"


@pytest.mark.parametrize("shard,range_bytes,merged,bits", [(1 << 24, 1 << 23, 1 << 19, 1 << 27), (700, 300, 20, 1 << 12), (64, 1 << 10, 1, 1 << 12)])
def test_mine(spark, monkeypatch, shard, range_bytes, merged, bits):
    for name, value in [("SHARD", shard), ("RANGE", range_bytes), ("MERGED", merged), ("MOST_BITS", bits)]:
        monkeypatch.setattr(phrases, name, value)
    rows = some_rows(shard)
    frame = spark.createDataFrame([(lang, text, "a", 1, 2, 3, 4, "b") for lang, text in rows], SCHEMA).repartition(3)
    got = phrases.mine(frame, least=12, top=60)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, 12, 60)


def test_mine_nothing(spark):
    for rows in ([], [("en", None)], [("en", "a b c")]):
        frame = spark.createDataFrame([(lang, text, "a", 1, 2, 3, 4, "b") for lang, text in rows], SCHEMA)
        assert phrases.mine(frame, least=2).count() == 0


def grams_of(counts):
    """Levels of {(lang, word, ...): weight}, passed prefixes with weight 0."""
    every = {k[:i] for k in counts for i in range(1, len(k) + 1)}
    langs = sorted({k[0] for k in every})
    words = sorted({w for k in every for w in k[1:]})
    levels, place = [], {(): 0}
    for depth in range(1, max(map(len, every), default=0) + 1):
        keys = sorted(k for k in every if len(k) == depth)
        levels.append((np.array([place[k[:-1]] for k in keys]), np.array([(words if depth > 1 else langs).index(k[-1]) for k in keys]),
                       np.array([counts.get(k, 0) for k in keys])))
        place = {k: i for i, k in enumerate(keys)}
    return phrases.Grams([x.decode() for x in langs], pa.array(words, pa.binary()), levels)


def counts_of(grams):
    names, out, above = grams.words.to_pylist(), {}, [()]
    for depth, (parent, label, weight) in enumerate(grams.levels):
        above = [above[p] + ((names[x],) if depth else (grams.langs[x].encode(),)) for p, x in zip(parent, label)]
        out.update({k: int(w) for k, w in zip(above, weight) if w})
    return out


def random_counts(rng, n):
    return {(rng.choice([b"de", b"en"]), *(rng.choice([b"a", b"ab", b"b", b"c"]) for _ in range(rng.randint(1, 4)))): rng.randint(1, 3) for _ in range(n)}


@pytest.mark.parametrize("seed", range(20))
def test_automata(seed):
    rng = random.Random(seed)
    one, two = random_counts(rng, rng.randrange(0, 60)), random_counts(rng, rng.randrange(1, 60))
    t = phrases.shared(grams_of(two))
    assert counts_of(phrases.spelled(t)) == two and list(t.first) == sorted(t.first)
    both = phrases.union([grams_of(one), grams_of(two)])
    total = Counter(one) + Counter(two)
    assert counts_of(both) == total
    assert counts_of(phrases.frequent(both, 3)) == {k: v for k, v in total.items() if v >= 3}
    asked = list(random_counts(rng, 30))
    grams, places = phrases.asked_grams([k[0].decode() for k in asked], [b" ".join(k[1:]).decode() for k in asked])
    weights = phrases.compose(grams, t)
    assert [int(weights[d][at]) for d, at in places] == [two.get(k, 0) for k in asked]


@pytest.mark.parametrize("seed", range(20))
def test_cut(seed):
    rng = random.Random(seed)
    counts = random_counts(rng, 50)
    edges = sorted({*random_counts(rng, rng.randrange(0, 8)), (b"en", b"zz"), (b"aa",), (b"zz", b"q")})
    got = {}
    for part, grams in phrases.cut(grams_of(counts), edges):
        for key, weight in counts_of(grams).items():
            assert phrases.bisect_right(edges, key) == part
            assert key not in got
            got[key] = weight
    assert got == counts


@pytest.mark.parametrize("seed", range(20))
@pytest.mark.parametrize("most", [0, 7, 1 << 20])
def test_dealt_and_joined(seed, most):
    """Ranges dealt some at a time say what one at a time say, as automata and after the way through rows."""
    rng = random.Random(seed)
    shards = [random_counts(rng, rng.randrange(0, 80)) for _ in range(4)]
    edges = sorted(random_counts(rng, 9))
    want, batches = defaultdict(Counter), []
    for counts in shards:
        for key, weight in counts.items():
            want[phrases.bisect_right(edges, key)][key] += weight
        seen = []
        for ranges, grams in phrases.dealt(grams_of(counts), edges, most):
            t = phrases.shared(grams)
            assert len(t.starts) == len(ranges) == grams.roots
            assert counts_of(phrases.union([phrases.spelled(t)])) == counts_of(phrases.union([grams]))
            seen += ranges.tolist()
            batches.append(phrases._rows(ranges, t, np.ones(len(grams.levels[0][0]), np.int64)))
        assert seen == sorted(set(seen)) and {phrases.bisect_right(edges, key) for key in counts} <= set(seen)
    table = pa.Table.from_batches(batches)
    for part in want:
        rows = table.filter(phrases.pc.equal(table.column("part"), part))
        for i, (alone, _) in enumerate(phrases._transducers(rows)):
            assert counts_of(phrases.spelled(alone)) == counts_of(phrases.spelled(phrases._joined(rows.slice(i, 1))[0]))
        whole, totals = phrases._joined(rows)
        assert counts_of(phrases.union([phrases.spelled(whole)])) == want[part]
        assert sum(totals.values()) == sum(map(len, rows.column("langs").to_pylist()))


def test_work_does_not_follow_shards_times_ranges(monkeypatch):
    """Each shard meets each range, so neither dealing a shard nor summing a range may take a step for each such meeting."""
    calls = Counter()
    for name in ("shared", "spelled", "union"):
        def counted(*args, f=getattr(phrases, name), name=name):
            calls[name] += 1
            return f(*args)

        monkeypatch.setattr(phrases, name, counted)
    words = [f"w{i:03}" for i in range(400)]
    edges = [(b"en", w.encode()) for w in words[1::2]]
    texts = pa.RecordBatch.from_pydict({"_text": [" ".join(words)] * 30, "_lang": ["en"] * 30})
    monkeypatch.setattr(phrases, "SHARD", len(" ".join(words)))
    table = pa.Table.from_batches(list(phrases._count(iter([texts]), 1, edges, None)))
    assert table.num_rows == 30 * 201 and calls["shared"] == 30
    one = table.filter(phrases.pc.equal(table.column("part"), 7))
    got = phrases._sum(one, 30)
    assert one.num_rows == 30 and calls["spelled"] == 1 and calls["union"] <= 3
    assert {k: v for t, _ in phrases._transducers(got) for k, v in counts_of(phrases.spelled(t)).items()} == {(b"en", b"w013"): 30, (b"en", b"w014"): 30}


def test_states_are_shared():
    counts = {(b"en", bytes([65 + i]), b"and", b"so"): 1 for i in range(20)}
    t = phrases.shared(grams_of(counts))
    assert len(t.weight) == 5                                         # so, and, any first word, en, the start


def test_long_text_is_cut_behind_breaks():
    text = ("one two three, " * 400).encode()
    data, offsets = utf8(pa.array([text], pa.binary()))
    parts = list(phrases.pieces(data, offsets, ["en"], 100))
    assert b"".join(p.tobytes() for p, _, _ in parts) == text and len(parts) > 20
    assert all(p.tobytes().rstrip().endswith(b",") for p, _, _ in parts[:-1])


def test_sql_says_the_same(spark, tmp_path):
    """The registered SQL over a few documents, with its own least count."""
    import duckdb

    from gridspark.llm.queries import ORACLES

    rows = [(i, text, lang) for i, (lang, text) in enumerate(some_rows(9, 900))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    frame.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    got = phrases.mine(frame).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    want = con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({ORACLES['op13_collocations']})").fetchall()
    assert got and sorted(map(tuple, got)) == sorted(want) == plain([(lang, text) for _, text, lang in rows], 100, 2000)
