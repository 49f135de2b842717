"""Named queries of the text operators; each runs one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridspark.llm import archive, bpe, decontaminate, html, jaccard, neighbours, packing, phrases, quality, sharding, suffix, toxicity, whitening
from gridspark.llm._text import parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(parquet(spark, sf, "documents"), RANKS, PATTERN)


@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.assign(parquet(spark, sf, "documents"), shards=8)


# base32: twenty bits, five hexadecimal digits, are four letters of the RFC 4648 alphabet
_ARCHIVES = """WITH d AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
    v AS (SELECT *, list_transform(range(0, 8), lambda i: list_sum(list_transform(range(1, 6),
        lambda j: (instr('0123456789abcdef', substr(x, 5 * i + j, 1)) - 1) << (4 * (5 - j))))::INTEGER) AS parts FROM d),
    b AS (SELECT page_id, payload_bytes, array_to_string(list_transform(parts, lambda p: array_to_string(list_transform([15, 10, 5, 0],
        lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((p >> k) & 31) + 1, 1)), '')), '') AS payload_digest FROM v),
    g AS (SELECT payload_digest, max(page_id) AS top FROM b GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to FROM b JOIN g USING (payload_digest)"""


@query("op4_warc", _ARCHIVES)
def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    rows = archive.archive_pages(parquet(spark, sf, "pages"), min_payload=0)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_html")
def op8_html(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract(parquet(spark, sf, "pages"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.classify(parquet(spark, sf, "documents"), parquet(spark, sf, "labels"))


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix.report(parquet(spark, sf, "documents"), length=100)


@query("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join(parquet(spark, sf, "documents"), n=5, threshold=0.8)


@query("op5_decontaminate")
def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find(parquet(spark, sf, "documents"), parquet(spark, sf, "benchmark"), rate=0.1)


@query("op7_neighbours")
def op7_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.search(parquet(spark, sf, "embeddings"), every=20, k=20)


@query("op6_quality")
def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classify(parquet(spark, sf, "documents"), parquet(spark, sf, "labels"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(parquet(spark, sf, "embeddings"), most=32)


@query("op12_packing")
def op12_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(parquet(spark, sf, "documents"), WORD_TOKENIZER, end=1, capacity=4096)


_COLLOCATIONS = r"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
    total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
    grams AS (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
        lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM w, (SELECT unnest(range(1, 6)) AS k)) GROUP BY ALL),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ps FROM grams WHERE k > 1 AND f >= 100),
    cuts AS (SELECT lang, phrase, a, ps, unnest(range(1, k)) AS j FROM c),
    parts AS (SELECT lang, phrase, a, j, array_to_string(ps[1:j], ' ') AS x, array_to_string(ps[j + 1:], ' ') AS y FROM cuts),
    scored AS (SELECT p.lang, p.phrase, p.a, g.f AS l, h.f AS r, n, CAST(1000::HUGEINT * p.a * n // (g.f::HUGEINT * h.f) AS BIGINT) AS score
        FROM parts p JOIN grams g ON g.lang = p.lang AND g.phrase = p.x JOIN grams h ON h.lang = p.lang AND h.phrase = p.y
        JOIN total t ON t.lang = p.lang QUALIFY row_number() OVER (PARTITION BY p.lang, p.phrase ORDER BY score, j) = 1),
    inside AS (SELECT lang, phrase, max(a) AS a FROM (SELECT lang, a, unnest(list_transform(range(1, k - m + 2),
        lambda i: array_to_string(ps[i:i + m - 1], ' '))) AS phrase FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k) GROUP BY ALL)
    SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, l, r, n, score
    FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase WHERE i.a IS NULL OR i.a < s.a QUALIFY rank <= 2000"""


@query("op13_collocations", _COLLOCATIONS)
def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.mine(parquet(spark, sf, "documents"), least=100, top=2000)
