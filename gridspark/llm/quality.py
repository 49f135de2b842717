"""Quality: ordinal cumulative-link regression on graded ratings over hashed text features.

P(grade <= j) = logistic(t_j - s) with ordered thresholds t_0 < t_1 < ... and one score s = w.x for all grades, so a text has an
expected grade and a tail probability P(grade >= j), by which it is selected.

Features, hashed into 2**BITS weights: words (ASCII case folded), shapes of tokens (runs of lower case, capitals, digits,
other characters and each punctuation mark as itself, so that marks stuck to words and shouting show), and three shares in
tenths: repeated lines, repeated tokens, and tokens without a letter. Words and shapes have the square roots of their counts,
scaled to length one for each kind. The fit is by AdaGrad in numpy on a bounded sample, the labelled rows with the lowest
hashes of doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm._text import U64, folded_values, mix, row_slices, separators_but_letters, utf8, words

BITS = 18
#: At most so many labelled rows of each grade are fitted, from texts of at most so many bytes in all.
FIT_ROWS, FIT_BYTES = 5_000, 60_000_000
SLICE = 1 << 19
GAP, FOLDED = separators_but_letters(), folded_values()
#: Classes of bytes for shapes: white space 0, lower case 1, capital 2, digit 3, part of a longer character 4, else itself.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[97:123], SHAPE[65:91], SHAPE[48:58], SHAPE[128:], SHAPE[:33] = 1, 2, 3, 4, 0
BREAK, LINE = np.arange(256) == 0, np.arange(256) == 10


def held_out(doc_id: str = "doc_id"):
    """True for the quarter of the ids that is never fitted; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def counted(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of the different hashes of each row."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    heads = np.flatnonzero(new)
    return row[heads], h[heads], np.diff(np.append(heads, len(h)))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, weight number, value) of all features, by row."""
    rows = len(offsets) - 1
    parts = []
    shape = SHAPE[data]
    # a byte of the same class as the one before it in a token is dropped, so a shape does not grow with its word
    keep = np.ones(len(shape), bool)
    keep[1:] = (shape[1:] != shape[:-1]) | (shape[1:] == 0)
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
    _, _, shapes, shape_first = words(shape[keep], kept, BREAK)
    _, _, tokens, token_first = words(data, offsets, GAP, FOLDED)
    for kind, (h, first) in enumerate(((tokens, token_first), (shapes, shape_first))):
        row, h, count = counted(h, first)
        value = np.sqrt(count / np.maximum(1, np.diff(first))[row])
        parts.append((row, mix(h + U64(kind)) >> U64(64 - BITS), value))
        if kind == 0:
            repeated = 1 - np.bincount(row, minlength=rows) / np.maximum(1, np.diff(first))
    _, _, lines, line_first = words(data, offsets, LINE)
    row, _, _ = counted(lines, line_first)
    again = 1 - np.bincount(row, minlength=rows) / np.maximum(1, np.diff(line_first))
    bare = 1 - np.diff(token_first) / np.maximum(1, np.diff(shape_first))
    length = np.log2(np.maximum(1, np.diff(shape_first))) / 20
    for kind, share in enumerate((again, repeated, np.clip(bare, 0, 1), length)):
        tenth = np.minimum(9, (share * 10).astype(np.int64))
        parts.append((np.arange(rows), mix((tenth + 100 * kind + 7).astype(U64)) >> U64(64 - BITS), np.full(rows, 0.5)))
    row, at, value = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(row, kind="stable")
    return row[order], at[order].astype(np.int64), value[order]


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, row: np.ndarray, at: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        return np.bincount(row, self.weights[at] * value, rows)

    def tails(self, s: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ... of each score."""
        return 1 / (1 + np.exp(self.thresholds - s[:, None]))


def fit(texts: list[tuple[np.ndarray, np.ndarray, int]], grades: int, epochs: int = 12, batch: int = 32, rate: float = 0.3,
        shrink: float = 1e-6, seed: int = 11, least_steps: int = 2500) -> Model:
    """Fit (weight numbers, values, grade) by the log loss of the grades; thresholds start at the grades' shares."""
    epochs = max(epochs, -(-least_steps * batch // max(1, len(texts))))
    rng = np.random.default_rng(seed)
    counts = np.bincount([g for _, _, g in texts], minlength=grades) + 0.5
    below = np.cumsum(counts)[:-1] / counts.sum()
    model = Model(np.zeros(1 << BITS), np.log(below / (1 - below)))
    seen, seen_t = np.full(1 << BITS, 1e-2), np.full(grades - 1, 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            chosen = [texts[i] for i in order[lo:lo + batch]]
            row = np.repeat(np.arange(len(chosen)), [len(a) for a, _, _ in chosen])
            at, value = np.concatenate([a for a, _, _ in chosen]), np.concatenate([v for _, v, _ in chosen])
            y = np.array([g for _, _, g in chosen])
            s = model.scores(row, at, value, len(chosen))
            below = np.column_stack([np.zeros(len(y)), 1 - model.tails(s), np.ones(len(y))])
            upper, lower = below[np.arange(len(y)), y + 1], below[np.arange(len(y)), y]
            p = np.maximum(upper - lower, 1e-9)
            g = (1 - upper - lower) / len(y)
            used, inverse = np.unique(at, return_inverse=True)
            grad = np.bincount(inverse, g[row] * value, len(used)) + shrink * model.weights[used]
            seen[used] += grad * grad
            model.weights[used] -= rate * grad / np.sqrt(seen[used])
            grad_t = np.zeros(grades + 1)
            np.add.at(grad_t, y + 1, -upper * (1 - upper) / p / len(y))
            np.add.at(grad_t, y, lower * (1 - lower) / p / len(y))
            grad_t = grad_t[1:-1]
            seen_t += grad_t * grad_t
            # thresholds that would cross are held a little apart
            model.thresholds = np.maximum.accumulate(model.thresholds - rate * grad_t / np.sqrt(seen_t)
                                                     + 1e-3 * np.arange(grades - 1))
    return model


def fit_on(docs: DataFrame, ratings: DataFrame, grades: int, rows: int = FIT_ROWS, max_bytes: int = FIT_BYTES,
           **options) -> Model | None:
    """Model from ratings (doc_id, grade) that are not held out; None without any. Of each grade the `rows` rows with the
    lowest hashes of doc_id are fitted, in that order until their texts reach `max_bytes`."""
    order = F.xxhash64("doc_id")
    usable = ratings.select("doc_id", F.col("grade").alias("_grade")).where(~held_out()).distinct()
    chosen = None
    for g in range(grades):
        part = usable.where(F.col("_grade") == g).orderBy(order, "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(order, "doc_id", "_grade", "text")
    texts, size = [], 0
    for r in sample.toLocalIterator():
        data, offsets = utf8(pa.array([r["text"]], pa.string()))
        _, at, value = features(data, offsets)
        texts.append((at, value, int(r["_grade"])))
        size += len(data)
        if size > max_bytes:
            break
    return fit(texts, grades, **options) if texts else None


def rate(docs: DataFrame, model: Model | None, select_from: int = 1, least: float = 0.5) -> DataFrame:
    """(doc_id, held_out, expected_grade, tail, selected) of every row of (doc_id, text).

    tail is P(grade >= `select_from`); selected is 1 if it reaches `least`. A null text is rated as the empty one. Without a
    model both figures are null and every row is selected. Repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            tails = np.full((batch.num_rows, 1 if model is None else len(model.thresholds)), np.nan)
            for lo, hi in row_slices(offsets, SLICE):
                if model is not None:
                    row, at, value = features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                    tails[lo:hi] = model.tails(model.scores(row, at, value, hi - lo))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tails.sum(axis=1), from_pandas=True),
                 pa.array(tails[:, min(select_from, tails.shape[1]) - 1], from_pandas=True)], ["doc_id", "expected_grade", "tail"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text").mapInArrow(rated, f"doc_id {kind}, expected_grade double, tail double")
            .select("doc_id", held_out().alias("held_out"), "expected_grade", "tail",
                    F.coalesce((F.col("tail") >= least).cast("int"), F.lit(1)).alias("selected")))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the labels: 0 low quality, 1 good but toxic, 2 good. A null quality gives no rating."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.where(F.col("quality").isin(0, 1)).select("doc_id", grade.alias("grade"))


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """`fit_on` the labels' grades and `rate` over the same documents; selected are those likely of grade 1 or 2."""
    return rate(docs, fit_on(docs, graded(labels), grades=3, **options), select_from=1)
