"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut at safe places before they are encoded: in front of a blank or line feed that follows a letter,
digit or underscore. No match of the splitting pattern reaches across such a place, nor does its look-ahead
depend on what comes behind it, so the ids are those of the whole text. A text without any safe place stays whole.
Decoding gives raw bytes: a token may hold a part of a character.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm._text import utf8

SAFE = re.compile(r"(?<=\w)[ \n]")
PIECE = 1 << 16
OUT_BYTES = 2 << 20


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, piece: int = PIECE) -> Iterator[str]:
    """Cut a text at the first safe place after every `piece` characters."""
    at = 0
    while len(text) - at > piece:
        cut = SAFE.search(text, at + piece)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode_text(enc: tiktoken.Encoding, text: str, piece: int = PIECE) -> list[int]:
    if len(text) <= piece:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for part in safe_pieces(text, piece):
        ids += enc.encode_ordinary(part)
    return ids


def _encode(batches: Iterator[pa.RecordBatch], rank_file: str, pattern: str, piece: int) -> Iterator[pa.RecordBatch]:
    enc = encoding(rank_file, pattern)
    for batch in batches:
        data, offsets = utf8(batch.column("_text"))
        first = 0
        arrays: list[np.ndarray] = []
        size = 0
        for i in range(batch.num_rows):
            text = data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")
            arrays.append(np.array(encode_text(enc, text, piece), np.int32))
            size += 4 * len(arrays[-1])
            if size >= OUT_BYTES or i + 1 == batch.num_rows:
                yield _lists(batch.slice(first, len(arrays)), arrays)
                first, arrays, size = i + 1, [], 0


def _lists(batch: pa.RecordBatch, arrays: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays)))
    return pa.RecordBatch.from_arrays([*batch.drop_columns(["_text"]).columns, ids], [*batch.drop_columns(["_text"]).schema.names, "token_ids"])


def _decode(batches: Iterator[pa.RecordBatch], rank_file: str, pattern: str) -> Iterator[pa.RecordBatch]:
    enc = encoding(rank_file, pattern)
    for batch in batches:
        ids = batch.column("token_ids")
        ids = ids if ids.null_count == 0 else ids.fill_null([])
        flat = ids.flatten().to_numpy(zero_copy_only=False).tolist()
        ends = np.cumsum(np.r_[0, ids.value_lengths().to_numpy(zero_copy_only=False)]).tolist()
        first, out, size = 0, [], 0
        for i in range(batch.num_rows):
            out.append(enc.decode_bytes(flat[ends[i]:ends[i + 1]]))
            size += len(out[-1])
            if size >= OUT_BYTES or i + 1 == batch.num_rows:
                part = batch.slice(first, len(out))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())],
                                                 [*part.schema.names, "decoded"])
                first, out, size = i + 1, [], 0


def encode(docs: DataFrame, rank_file: str, pattern: str, keep: tuple[str, ...] = ("doc_id",),
           text: str = "text", piece: int = PIECE) -> DataFrame:
    """`keep` columns and `token_ids array<int>` of every row; a null text gives no ids, repeated rows stay."""
    rows = docs.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(partial(_encode, rank_file=rank_file, pattern=pattern, piece=piece),
                           f"{kinds}, token_ids array<int>")


def decode(tokens: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Adds `decoded binary`, the concatenated bytes of `token_ids`; null ids give no bytes."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields)
    return tokens.mapInArrow(partial(_decode, rank_file=rank_file, pattern=pattern), f"{kinds}, decoded binary")


def _round_trip(batches: Iterator[pa.RecordBatch], rank_file: str, pattern: str, piece: int) -> Iterator[pa.RecordBatch]:
    yield from _decode(_encode(batches, rank_file, pattern, piece), rank_file, pattern)


def round_trip(docs: DataFrame, rank_file: str, pattern: str, piece: int = PIECE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(`keep` columns, token_ids, decoded): `encode`, then `decode`, in one Python worker instead of two."""
    rows = docs.select(*keep, F.col("text").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(partial(_round_trip, rank_file=rank_file, pattern=pattern, piece=piece),
                           f"{kinds}, token_ids array<int>, decoded binary")


def digests(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode every whole text, decode the ids again."""
    return round_trip(docs, rank_file, pattern).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
