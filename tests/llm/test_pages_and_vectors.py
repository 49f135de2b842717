"""Archives, extraction and search."""

import base64
import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, connect

from gridspark.llm import archive, html, neighbours, queries
from gridspark.llm._text import parquet

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><!-- ad --><div class="ad">Buy</div>
<div id="cookie-notice">We use cookies</div><article><header><h1>Title &amp; more</h1></header><p>First   line<br>goes&nbsp;on.
<p><b>Second <i>one</b>.<form><input name=q>Sign up</form><div class="comments"><p>Reader says</p></div><p>Last &lt;p&gt; é</p>
</article><aside>Related</aside><footer>&copy; x</footer>"""


def test_article_text(spark):
    pages = spark.createDataFrame([(1, "http://h/a/1", PAGE, 9), (2, None, None, 9), (3, "no url", "", 9), (None, "http://h/a/1", PAGE, 9)],
                                  "page_id long, url string, html string, piece int")
    got = {r["page_id"]: r for r in html.extract(pages).collect()}
    want = "Title & more\n\nFirst line goes on.\n\nSecond one.\n\nLast <p> é"
    assert got[1]["text"] == got[None]["text"] == want and got[1]["n_chars"] == len(want)
    assert got[2]["text"] == got[3]["text"] == "" and got[2]["n_chars"] == 0 and len(got) == 4
    assert html.extract(pages.where("false")).count() == 0


def test_differencing_of_pages_without_an_article(spark):
    frame = "<html><body><div>Welcome to the site</div><p>{}</p><p>{}</p><div>Write to us</div></body></html>"
    rows = [(i, f"http://h/a/{i}", frame.format(f"own {i}", f"more {i}")) for i in range(5)] + [(9, "http://other/b", frame.format("x", "y"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(pages, pair_rows=1000).collect()}
    assert all(got[i] == f"own {i}\n\nmore {i}" for i in range(5))
    assert got[9] == "Welcome to the site\n\nx\n\ny\n\nWrite to us"


def test_copies_are_no_partners(spark):
    frame = "<html><body><div>Welcome</div><nav>seen {} times</nav><p>{}</p><p>{}</p><div>Write to us</div></body></html>"
    copy = [(1, "http://h/a/1?x=1"), (1, "http://h/a/1?x=1"), (2, "http://h/a/1?x=2"), (3, "http://h/a/1?x=3"), (4, "http://h/a/2")]
    rows = [(i, u, frame.format(k, "own", "more")) for k, (i, u) in enumerate(copy)]
    rows += [(9, "http://h/a/9", frame.format(7, "other", "text")), (20, "http://all/b/1", frame.format(0, "x", "y")),
             (21, "http://all/b/2", frame.format(0, "x", "y"))]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), pair_rows=1000).collect()
    texts = {(r["page_id"], r["text"]) for r in got}
    assert len(got) == len(rows) and texts == {*((i, "own\n\nmore") for i in (1, 2, 3, 4)), (9, "other\n\ntext"),
                                               *((i, "Welcome\n\nx\n\ny\n\nWrite to us") for i in (20, 21))}


@pytest.mark.parametrize("page", [
    '<div class="content has-sidebar"><article>{}</article></div>', '<body class="x"><div class="no-sidebar"><main>{}</main></div>',
    '<div class="elementor-widget"><article>{}</article></div>', '<article class="comments-open">{}</article>',
    '<form id="aspnetForm"><div id="page"><nav>Menu</nav><article>{}</article></div></form>',
    '<div class="popup"><div id="comments"><main class="widget">{}</main></div></div><div class="cookie-bar">Cookies</div>',
    '<article>{}<section class="comments-area"><article class="comment">Reader</article></section></article>',
    '<div class="has-sidebar elementor-widget no-comments">{}</div><div id="main-sidebar">Side</div><p class="comment-list">Reader</p>',
    '<body><form><div>{}</div></form><div class="site-footer">Foot</div>', '<div class="header-ad-top left">{}</div>'])
def test_class_words_hide_no_article(page):
    lines, kinds = html.page_lines(page.format("<p>One</p><p>Two</p>"))
    assert [line for line, kind in zip(lines, kinds) if kind != html.FRAME] == ["One", "Two"]


def plain_texts(rows):
    """Each page less what it shares, in order, with the nearest differing pages of its host on both sides."""
    split = lambda u: ("", "") if u is None else (u.split("/")[2], u.split("?")[0].partition(u.split("/")[2])[2])
    order = sorted(rows, key=lambda r: (split(r[1]), r[1] or "", r[0]))
    out = []
    for k, (i, u, lines) in enumerate(order):
        shared = set()
        for side in (order[:k][::-1], order[k + 1:]):
            other = next((x[2] for x in side if split(x[1])[0] == split(u)[0] and x[2] != lines), [])
            shared |= html.common(lines, other)[0]
        out.append((i, "\n\n".join(x for j, x in enumerate(lines) if j not in shared)))
    return sorted(out)


@pytest.mark.parametrize("pair_rows", [1, 3, 1000])
def test_pairs_cross_folders_and_ranges(spark, pair_rows):
    rng = random.Random(5)
    rows = [(i, f"http://h{rng.randrange(3)}/2024/{rng.randrange(12)}/{rng.randrange(30)}/p?x={i}",
             ["Menu", *rng.choices("abcdef", k=2), "Foot"]) for i in range(50)]
    rows += [(60 + i // 3, "http://h1/2024/5/copy", ["Menu", "c", "Foot"]) for i in range(9)]  # thrice each
    rows += [(80 + i, None, ["Menu", f"own {i}"]) for i in range(3)] + [(90, "http://alone/x", ["Menu", "own"])]
    pages = spark.createDataFrame([(i, u, "".join(f"<p>{x}</p>" for x in lines)) for i, u, lines in rows],
                                  "page_id long, url string, html string")
    got = sorted((r["page_id"], r["text"]) for r in html.extract(pages, pair_rows=pair_rows).collect())
    assert got == plain_texts(rows)


@pytest.mark.parametrize("a,b,size", [("abcbdab", "bdcaba", 4), ("", "a", 0), ("aaaa", "aa", 2), ("xyz", "abc", 0)])
def test_common_lines(a, b, size):
    left, right = html.common(list(a), list(b))
    assert len(left) == len(right) == size
    assert [a[i] for i in sorted(left)] == [b[j] for j in sorted(right)]


def plain_records(rows, least=0):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    top = {}
    for i, h in rows:
        top[digest(h)] = max(top.get(digest(h), -1), -1 if i is None else i)
    out = []
    for i, h in rows:
        n, d = len((h or "").encode()), digest(h)
        first = n < least or i == top[d] or top[d] == -1
        out.append((i, n, d, "response" if first else "revisit", None if first else top[d]))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, least):
    rows = [(i, h) for i, h in enumerate(["<p>a</p>", "<p>a</p>", "", None, "x\r\n\r\nWARC/1.1\r\n\r\ny", "é" * 50_000, "<p>a</p>", "1 0 z\n" * 9])]
    rows += [(6, "<p>a</p>"), (None, "<p>a</p>"), (None, "only")]
    urls = ["http://h/a b", None, "http://h/é\n", "http://h/x 1.2.3.4 20240101000000 text/html 5"]
    pages = spark.createDataFrame([(i, urls[k % 4], h, "x") for k, (i, h) in enumerate(rows)],
                                  "page_id long, url string, html string, payload_digest string")
    got = archive.archive_pages(pages, min_payload=least)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=str) == plain_records(rows, least)
    assert archive.archive_pages(pages.where("false")).count() == 0


def test_archive_files_are_closed_by_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(archive, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(archive, "BLOCK_RECORDS", 7)
    pages = [{"page_id": i, "url": f"http://h/{i}", "html": "x" * (i * 37 % 1500)} for i in range(200)]
    table = pa.RecordBatch.from_pylist(pages, pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())]))
    blocks = [b.column(0)[0].as_py() for b in archive._render_arc(iter([table]), "20240101000000")]
    files = [b"\n".join(blocks[i:i + archive.BLOCKS_PER_FILE]) for i in range(0, len(blocks), archive.BLOCKS_PER_FILE)]
    assert len(files) > 5 and all(f.startswith(b"filedesc:") for f in files) and max(map(len, files)) < 4 * (4000 + 2000)
    read = [r for f in files for r in archive.parse_arc(f)]
    assert [r.url for r in read] == [p["url"] for p in pages] and {r.version for r in read} == {1, 2} and all(r.whole for r in read)
    assert [archive.split_http(r.block)[1].decode() for r in read] == [p["html"] for p in pages]


def test_archives_match_sql(spark, sf):
    assert compare(queries.QUERIES["op4_warc"](spark, sf), queries.ORACLES["op4_warc"], connect(sf)) == []


def test_arc_versions_lengths_and_damage():
    block = archive.http_block(b"one\ntwo", 5)
    for version in (1, 2):
        good = archive.version_block(version, "20240102030405") + b"\n" + archive.arc_record(version, "http://h/", "20240102030405", block) + b"\n"
        found = list(archive.parse_arc(good + b"junk line\n" + archive.arc_record(version, "http://h/2", "2024", block)[:-3]))
        assert [(r.version, r.url, r.whole) for r in found] == [(version, "http://h/", True), (version, "http://h/2", False)]
        row = archive.convert_record(found[0])
        assert row["payload_bytes"] == 7 and row["page_id"] == 5 and row["warc_date"] == "2024-01-02T03:04:05Z"
        assert row == archive.convert_record(found[0]) and row["record_id"].startswith("<urn:uuid:")
    assert archive.iso_time("2024") == "2024-01-01T00:00:00Z"


def plain_nearest(rows, k, every):
    out = {}
    for i, v in rows:
        if i is not None and i % every == 0:
            best = sorted({(-float((np.array(v) * np.array(w)).sum()), j) for j, w in rows if j != i})
            out[i] = [(j, -s) for s, j in best[:k]]
    return out


def test_search_odd_rows(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(60)] + [(100 + i, [1.0] * 8) for i in range(30)]
    bad = [(200, None), (220, []), (240, [0.0] * 8), (260, [1.0] * 7 + [None]), (280, [float("nan")] + [1.0] * 7), (300, [float("inf")] * 8), (None, [1.0] * 8), (320, [1.0] * 9)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in good + bad], "vec_id long, embedding array<float>, label int, rank int")
    got = {}
    for r in neighbours.search(table, k=5, piece=7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = plain_nearest(good, 5, 20)
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in want.items()}
    assert all(abs(a - b) < 1e-12 for q in got for (_, a), (_, b) in zip(got[q], want[q]))
    assert neighbours.search(table.where("false")).count() == 0
    assert neighbours.search(table.where("vec_id in (20, 21)"), k=5).count() == 1


def test_repeated_rows_take_one_place(spark):
    rng = np.random.default_rng(2)
    plain = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    rows = plain + plain[20:21] * 30 + [(7, (9 * np.array(plain[0][1])).tolist())] * 40  # the query's own row and a near one
    rows += [(11, (np.array(plain[40][1]) + rng.normal(size=8) / 10).tolist()) for _ in range(50)]  # one id, many vectors
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {}
    for q, v in plain[::20]:
        best = {}
        for j, w in rows:
            if j != q:
                best[j] = max(best.get(j, -np.inf), float((np.array(v) * np.array(w)).sum()))
        want[q] = [j for _, j in sorted((-s, j) for j, s in best.items())[:5]]
    got = {}
    for r in neighbours.search(table, k=5, piece=7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == want
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    assert [found.tolist() for _, found, _ in neighbours.top(x, ids, x[:60:20], ids[:60:20], 5)] == list(want.values())
    best = neighbours.Best(2)
    best.add(1, np.array([5, 5, 5, 6]), np.array([.9, .8, .7, .6]))
    best.prune()
    assert best.give().column("vec_id").to_pylist() == [5, 6]


def test_recall(spark):
    table = parquet(spark, "/root/testdata/sf0.1", "embeddings")
    found = neighbours.search(table).toPandas()
    rows = table.toPandas()
    x, ids = np.stack([np.asarray(v, float) for v in rows.embedding]), rows.vec_id.to_numpy()
    hits = total = 0
    for q, part in found.groupby("query_id"):
        score = x @ x[np.flatnonzero(ids == q)[0]]
        order = [v for v in ids[np.lexsort((ids, -score))] if v != q][:20]
        hits += len(set(order) & set(part.vec_id))
        total += 20
        assert part["rank"].tolist() == list(range(1, 21)) or sorted(part["rank"]) == list(range(1, 21))
    assert total == 20 * (ids % 20 == 0).sum() and hits / total > 0.95


def test_graph_search_finds_the_nearest():
    rng = np.random.default_rng(1)
    nodes = rng.normal(size=(500, 6))
    graph = neighbours.Graph.over(nodes)
    x = rng.normal(size=(40, 6))
    pool, dist = graph.search(x, 32)
    true = ((x[:, None] - nodes) ** 2).sum(axis=2).argmin(axis=1)
    assert (pool[:, 0] == true).mean() > 0.95 and (np.diff(dist, axis=1) >= 0).all()
    assert all(len(set(p[p >= 0])) == (p >= 0).sum() for p in pool)


@pytest.mark.parametrize("kind,n", [("plain", 6000), ("plain", 30000), ("clusters", 30000), ("norms", 30000)])
def test_lists_to_visit_hold_recall(kind, n):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 32))
    if kind == "clusters":
        x = 0.4 * x + rng.normal(size=(60, 32))[rng.integers(0, 60, n)]
    x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "norms":
        x *= rng.lognormal(0, 0.3, n)[:, None]
    most, lists = (x ** 2).sum(axis=1).max(), n // 128
    sample = x[rng.permutation(n)[:20 * lists]]
    graph = neighbours.Graph.over(neighbours.halve(neighbours.augmented(sample[:16 * lists], most), lists))
    visit = neighbours.lists_to_visit(graph, sample[16 * lists:], most, 20 * 4 * lists / n)
    asked = x[:200]
    score = asked @ x.T
    score[np.arange(200), np.arange(200)] = -np.inf
    near = np.argsort(-score, axis=1)[:, :20]
    homes = neighbours.replicas(graph, neighbours.augmented(x[near.ravel()], most))
    seen = neighbours.probes(graph, neighbours.augmented(asked, 0.0), np.full(lists, 512), visit)
    hits = [bool(set(home) & set(seen[i // 20])) for i, home in enumerate(homes)]
    assert np.mean(hits) > 0.93 and (kind == "norms" or np.mean([len(p) for p in seen]) <= max(48, 0.9 * lists ** 0.75))


@pytest.mark.parametrize("page,want", [
    ("<a " * 100_000 + "end", ["<a " * 100_000 + "end"]), ("<script " * 40_000, ["<script " * 40_000]), ("<b><p>x" * 50_000, ["x"] * 50_000),
    ("<a \"<a '" * 40_000 + ">", None), ("<a" * 150_000 + " \">", None), ("<form><p>x" * 40_000, None), ("<b></i>" * 50_000, []),
    ("<!-- " * 60_000, []), ("<b><article>x" * 30_000, None), ("<div>" * 40_000 + "x" + "</div>" * 40_000, ["x"])])
def test_malformed_pages_take_linear_time(page, want):
    begin = time.process_time()
    lines, _ = html.page_lines(page.strip())
    assert time.process_time() - begin < 4
    assert want is None or lines == [line.strip() for line in want]


def test_unclosed_parts():
    assert html.page_lines("a<![CDATA[b<c")[0] == ["ab<c"]
    assert html.page_lines("a <? b <!-- c")[0] == ["a <? b"]
    assert html.page_lines("<p title='x>'>a<p title='>b")[0] == ["a<p title='>b"]


@pytest.mark.parametrize("most", [0, 6, 1 << 16])
def test_common_is_longest(monkeypatch, most):
    monkeypatch.setattr(html, "MOST_PAIRS", most)
    rng = random.Random(most)
    for _ in range(150):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(30))] for _ in range(2))
        left, right = html.common(a, b)
        assert [a[i] for i in sorted(left)] == [b[j] for j in sorted(right)]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert len(left) == best[-1][-1]


def test_common_of_many_equal_lines():
    begin = time.process_time()
    assert len(html.common(["a"] * 4000, ["b"] + ["a"] * 4000 + ["c"])[0]) == 4000
    rng = random.Random(1)
    a, b = ([rng.choice("abc") for _ in range(20_000)] for _ in range(2))
    assert len(html.common(a, b)[0]) > 12_000
    assert time.process_time() - begin < 10
