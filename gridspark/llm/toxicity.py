"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word (letters and digits, ASCII case folded) is the sum of the embeddings of five hashes: two of the whole word and one
of each of its first 4, 5 and 6 bytes, so that inflected forms share a part. Filters of widths 1, 2 and 3 run over the words
of the whole text; each filter keeps its maximum, and a logistic layer turns the maxima into a score. Maximum pooling
makes the score independent of a text's length and lets a long text be worked through in blocks.

Training: log loss by stochastic gradient with a step size of its own for each weight (AdaGrad), on all labelled rows that are
not held out. Up to FIT_ROWS of each class are fitted at once on the driver. If there are more, that gives the starting point, and
Spark goes over all rows ROUNDS times: each task trains a copy of the model on its rows, the copies' moves are averaged weight by
weight over the tasks that moved it, and the next round starts there. Nothing but the text enters a score. For every language
all labelled rows that are neither fitted nor held out give a threshold, the cut with the best F1 there; the contract's fixed cut
stays beside it, and the pipeline drops by the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm._text import BYTE_VALUES, U64, folded_values, mix, releasing, row_slices, separators_but_letters, utf8, words
from gridspark.session import materialize

GAP, FOLDED = separators_but_letters(), folded_values()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BITS, DIM, FILTERS = 15, 8, 8
PREFIXES, WIDTHS = (4, 5, 6), (1, 2, 3)
TABLES, MAXIMA = 2 + len(PREFIXES), FILTERS * len(WIDTHS)
#: Number of the padding word, whose embedding stays zero; enough of them follow each row that no filter reaches the next.
PAD, PADS = 1 << BITS, max(WIDTHS) - 1
BLOCK_WORDS, SLICE = 1 << 15, 4 << 20
#: Up to so many labelled rows of each class, from texts of so many bytes in all, are fitted on the driver.
FIT_ROWS, FIT_BYTES = 6_000, 60_000_000
#: More are gone over so often, by at most so many tasks; a table's rows are averaged by blocks of so many.
ROUNDS, TRAINERS, ROW_BLOCK = 2, 64, 1 << 10
BATCH, RATE, LEARN_WORDS = 16, 0.15, 1 << 17
#: Up to so many labels are sent to the documents; of more, the documents are sent to the labels.
SENT_LABELS = 1 << 20
CUT = 0.3
#: A language has a threshold of its own if so many rows of each class were left out of the fit for it.
LEAST_CALIBRATED = 3


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(padded words x TABLES array of hashed ids, first padded word of each row and the total)."""
    starts, ends, whole, first = words(data, offsets, GAP, FOLDED)
    rows = len(first) - 1
    ids = np.full((len(starts) + PADS * rows, TABLES), PAD, np.uint16)
    at = np.arange(len(starts)) + PADS * np.repeat(np.arange(rows), np.diff(first))
    down = U64(64 - BITS)
    ids[at, 0] = whole >> down
    ids[at, 1] = mix(whole + U64(1)) >> down
    if len(starts):
        padded = np.concatenate([LOWER[data], np.zeros(8, np.uint8)])
        eight = np.ndarray(len(data), "<u8", padded, strides=(1,))[starts]
        for k, size in enumerate(PREFIXES):
            part = eight & U64((1 << 8 * size) - 1)
            part[ends - starts < size] = 0
            ids[at, 2 + k] = mix(part + BYTE_VALUES[size]) >> down
    return ids, first + PADS * np.arange(rows + 1)


@dataclass
class Model:
    """tables: TABLES x (2**BITS + 1) x DIM; kernels: a width x DIM x FILTERS array for each width; bias, weights: MAXIMA."""
    tables: np.ndarray
    kernels: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    #: Sums of the squared gradients of tables, kernels, bias, weights and offset, while training goes on.
    seen: list[np.ndarray] | None = None

    def embed(self, ids: np.ndarray) -> np.ndarray:
        out = self.tables[0][ids[:, 0]]
        for k in range(1, TABLES):
            out += self.tables[k][ids[:, k]]
        return out

    def responses(self, embedded: np.ndarray) -> np.ndarray:
        """Every filter's response at every position at which it starts; behind the end it reads zeros."""
        out = np.empty((len(embedded), MAXIMA), np.float32)
        for w, kernel in enumerate(self.kernels):
            r = embedded @ kernel[0]
            for j in range(1, len(kernel)):
                r[:-j] += embedded[j:] @ kernel[j]
            out[:, w * FILTERS:(w + 1) * FILTERS] = r
        return out

    def score(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A score of 0 to 1 for each row; a row without words gets that of maxima zero."""
        best = np.full((len(first) - 1, MAXIMA), -np.inf, np.float32)
        for a in range(0, len(ids), BLOCK_WORDS):
            part = ids[a:a + BLOCK_WORDS + PADS]
            r = self.responses(self.embed(part))[:BLOCK_WORDS]
            r[part[:BLOCK_WORDS, 0] == PAD] = -np.inf
            rows = np.arange(np.searchsorted(first, a, "right") - 1, np.searchsorted(first, a + len(r)))
            tops = np.maximum.reduceat(r, np.maximum(first[rows] - a, 0), axis=0)
            best[rows] = np.maximum(best[rows], tops)
        hidden = np.maximum(best + self.bias, 0)
        return 1 / (1 + np.exp(-(hidden @ self.weights + self.offset).astype(np.float64)))


    def peaks(self, ids: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(Places, responses) of each filter's maximum in texts that end at `ends`, LEARN_WORDS words at a time."""
        tops = np.repeat((ends - 1)[:, None], MAXIMA, axis=1)
        best = np.full(tops.shape, -np.inf, np.float32)
        for a in range(0, len(ids), LEARN_WORDS):
            r = self.responses(self.embed(ids[a:a + LEARN_WORDS + PADS]))[:LEARN_WORDS]
            for i in range(np.searchsorted(ends, a, "right"), np.searchsorted(ends - sizes, a + len(r))):
                lo, hi = max(a, ends[i] - sizes[i]), min(a + len(r), ends[i] - PADS)
                if hi > lo:
                    at = r[lo - a:hi - a].argmax(0)
                    top = r[lo - a + at, np.arange(MAXIMA)]
                    better = top > best[i]
                    tops[i, better], best[i, better] = (lo + at)[better], top[better]
        best[sizes == PADS] = 0
        return tops, best

    def learn(self, chosen: list[tuple[np.ndarray, int]], rate: float = RATE) -> None:
        """One step down the gradient of (padded word ids of a text, label 0 or 1)."""
        def step(x, total, grad, at=...):
            total[at] += grad * grad
            x[at] -= rate * grad / np.sqrt(total[at])

        ids = np.concatenate([t for t, _ in chosen])
        sizes = np.array([len(t) for t, _ in chosen])
        tops, best = self.peaks(ids, np.cumsum(sizes), sizes)
        hidden = np.maximum(best + self.bias, 0)
        p = 1 / (1 + np.exp(-(hidden @ self.weights + self.offset)))
        g = (p - np.array([y for _, y in chosen], np.float32)).astype(np.float32) / len(chosen)
        back = g[:, None] * self.weights * (hidden > 0)
        spots, pulls = [], []
        for w, width in enumerate(WIDTHS):
            cols = slice(w * FILTERS, (w + 1) * FILTERS)
            d, kernel_grad = back[:, cols], np.empty_like(self.kernels[w])
            for j in range(width):
                where = np.minimum(tops[:, cols] + j, len(ids) - 1)
                embedded = self.embed(ids[where.ravel()]).reshape(*where.shape, DIM)
                kernel_grad[j] = np.einsum("bf,bfd->df", d, embedded)
                spots.append(where.ravel())
                pulls.append((d[:, :, None] * self.kernels[w][j].T).reshape(-1, DIM))
            step(self.kernels[w], self.seen[1 + w], kernel_grad)
        where, inverse = np.unique(np.concatenate(spots), return_inverse=True)
        pull = np.zeros((len(where), DIM), np.float32)
        np.add.at(pull, inverse, np.concatenate(pulls))
        for k in range(TABLES):
            rows, inverse = np.unique(ids[where, k], return_inverse=True)
            grad = np.zeros((len(rows), DIM), np.float32)
            np.add.at(grad, inverse, pull)
            grad[rows == PAD] = 0
            step(self.tables[k], self.seen[0][k], grad, rows)
        step(self.weights, self.seen[-2], g @ hidden)
        step(self.bias, self.seen[-3], back.sum(0))
        self.seen[-1] += float(g.sum()) ** 2
        self.offset -= rate * float(g.sum()) / float(self.seen[-1][0]) ** 0.5

    def dense(self) -> np.ndarray:
        """All weights but the tables, and behind them the sums of their squared gradients."""
        return np.concatenate([np.ravel(x).astype(np.float64) for x in (*self.kernels, self.bias, self.weights, self.offset, *self.seen[1:])])

    def set_dense(self, values: np.ndarray) -> None:
        offset = np.zeros(1)
        for x in (*self.kernels, self.bias, self.weights, offset, *self.seen[1:]):
            x[...], values = values[:x.size].reshape(x.shape), values[x.size:]
        self.offset = float(offset[0])


def fit(texts: list[tuple[np.ndarray, int]], epochs: int = 8, batch: int = BATCH, rate: float = RATE, seed: int = 7,
        least_steps: int = 3000) -> Model:
    """Train on (padded word ids of a text, label 0 or 1), `epochs` times or more until `least_steps` batches are done."""
    epochs = max(epochs, -(-least_steps * batch // max(1, len(texts))))
    rng = np.random.default_rng(seed)
    tables = rng.normal(0, 0.1, (TABLES, PAD + 1, DIM)).astype(np.float32)
    tables[:, PAD] = 0
    kernels = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    mean = (sum(y for _, y in texts) + 0.5) / (len(texts) + 1)
    model = Model(tables, kernels, np.zeros(MAXIMA, np.float32), rng.normal(0, 0.3, MAXIMA).astype(np.float32),
                  float(np.log(mean / (1 - mean))))
    model.seen = [*(np.full(x.shape, 1e-2, np.float32) for x in (tables, *kernels, model.bias, model.weights)), np.full(1, 1e-2)]
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            model.learn([texts[i] for i in order[lo:lo + batch]], rate)
    return model


@releasing
def _trained(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Train a copy of the model on a task's rows; the moves of its weights: blocks of a table's moved rows, and the rest (-1)."""
    start: Model = shared.value
    model = replace(start, tables=start.tables.copy(), kernels=[x.copy() for x in start.kernels], bias=start.bias.copy(),
                    weights=start.weights.copy(), seen=[x.copy() for x in start.seen])
    texts, many = [], 0
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        marks = batch.column("_label").to_pylist()
        for lo, hi in row_slices(offsets, SLICE):
            ids, first = word_ids(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            texts += [(ids[a:b], y) for a, b, y in zip(first, first[1:], marks[lo:hi])]
            many += hi - lo
            while len(texts) >= BATCH:
                model.learn(texts[:BATCH])
                del texts[:BATCH]
            texts = [(t.copy(), y) for t, y in texts]
    if texts:
        model.learn(texts)
    if not many:
        return
    out = [(-1, (model.dense() - start.dense()).tobytes())]
    for k in range(TABLES):
        moved = np.flatnonzero((model.seen[0][k] > start.seen[0][k]).any(axis=1))
        for part in np.split(moved, np.flatnonzero(np.diff(moved // ROW_BLOCK)) + 1):
            if len(part):
                moves = [x[k][part] - y[k][part] for x, y in ((model.tables, start.tables), (model.seen[0], start.seen[0]))]
                out.append((k * (PAD // ROW_BLOCK + 1) + int(part[0]) // ROW_BLOCK,
                            (part % ROW_BLOCK).astype(np.int16).tobytes() + np.hstack(moves).astype(np.float32).tobytes()))
    task = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([task] * len(out), pa.int32()),
                                      pa.array([many] * len(out), pa.int64()), pa.array([x for _, x in out], pa.binary())],
                                     ["block", "task", "many", "moves"])


def _moved_rows(moves: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(moves) // (2 + 8 * DIM)
    return np.frombuffer(moves, np.int16, n), np.frombuffer(moves, np.float32, -1, 2 * n).reshape(n, 2 * DIM)


def _averaged(table: pa.Table) -> pa.Table:
    """A block's mean move, each task counting by its texts; a table's row is averaged over the tasks that moved it."""
    table = table.sort_by("task")
    many, moves = table.column("many").to_pylist(), table.column("moves").to_pylist()
    if table.column("block")[0].as_py() < 0:
        mean = sum(m * np.frombuffer(x) for m, x in zip(many, moves)) / sum(many)
        return pa.table({"block": table.column("block")[:1], "moves": pa.array([mean.tobytes()], pa.binary())})
    total, weight = np.zeros((ROW_BLOCK, 2 * DIM)), np.zeros(ROW_BLOCK)
    for m, x in zip(many, moves):
        rows, move = _moved_rows(x)
        total[rows] += m * move.astype(np.float64)
        weight[rows] += m
    rows = np.flatnonzero(weight)
    mean = (total[rows] / weight[rows, None]).astype(np.float32)
    return pa.table({"block": table.column("block")[:1],
                     "moves": pa.array([rows.astype(np.int16).tobytes() + mean.tobytes()], pa.binary())})


def train_on(model: Model, rows: DataFrame, rounds: int = ROUNDS) -> Model:
    """Go `rounds` times over all rows of (text, _label). The driver gets one averaged move of the model a round."""
    context = rows.sparkSession.sparkContext
    for _ in range(rounds):
        shared = context.broadcast(model)
        moves = (rows.select("text", "_label").coalesce(TRAINERS)
                 .mapInArrow(lambda batches: _trained(batches, shared), "block int, task int, many long, moves binary")
                 .groupBy("block").applyInArrow(_averaged, "block int, moves binary").collect())
        for row in moves:
            if row["block"] < 0:
                model.set_dense(model.dense() + np.frombuffer(row["moves"]))
                continue
            k, at = divmod(row["block"], PAD // ROW_BLOCK + 1)
            at, move = _moved_rows(row["moves"])[0] + at * ROW_BLOCK, _moved_rows(row["moves"])[1]
            model.tables[k][at] += move[:, :DIM]
            model.seen[0][k][at] += move[:, DIM:]
        shared.destroy()
    return model


def best_cut(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the best F1, halfway between neighbouring scores; CUT where a class is missing."""
    if labels.min(initial=1) == labels.max(initial=0) or len(labels) == 0:
        return CUT
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + hits[-1])
    f1[:-1][s[:-1] == s[1:]] = 0
    k = int(f1.argmax())
    return float((s[k] + s[min(k + 1, len(s) - 1)]) / 2)


def held_out(doc_id: str = "doc_id"):
    """True for the quarter of the ids that is never fitted; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def calibrates(doc_id: str = "doc_id"):
    """True for the fifth of the ids whose labelled rows are not fitted but set the thresholds; false for a null id."""
    return F.coalesce(F.shiftright(F.crc32(F.col(doc_id).cast("string").cast("binary")), 2) % 5 == 0, F.lit(False))


def cuts_by_language(langs: list, scores: np.ndarray, labels: np.ndarray) -> dict[str, float]:
    """The best cut of each language; languages with few rows of a class get that of all languages together."""
    def enough(y: np.ndarray) -> bool:
        return min((y == 1).sum(), (y == 0).sum()) >= LEAST_CALIBRATED

    of = np.array(langs, object)
    common = best_cut(scores, labels) if enough(labels) else CUT
    return {lang: best_cut(scores[of == lang], labels[of == lang]) if enough(labels[of == lang]) else common
            for lang in {x for x in langs if x is not None}}


def cuts_on(scored: DataFrame) -> dict[str, float]:
    """`cuts_by_language` of rows of (lang, _label, score): ranges of falling scores are summed, then scanned from their sums."""
    groups = F.array(F.struct(F.lit(None).cast("string").alias("lang"), F.lit(True).alias("every")),
                     F.struct("lang", F.lit(False).alias("every")))
    steps = (scored.select(F.explode(groups).alias("g"), "_label", "score").where("g.every or g.lang is not null")
             .groupBy("g.lang", "g.every", "score").agg(F.count("*").alias("n"), F.sum("_label").alias("hits")))
    steps = materialize(steps.repartitionByRange("every", "lang", F.desc("score")).withColumn("part", F.spark_partition_id()),
                        "toxicity-steps")
    group = ["every", "lang"]
    sums = steps.groupBy(*group, "part").agg(F.sum("n").alias("part_n"), F.sum("hits").alias("part_hits"), F.max("score").alias("top"))
    ordered = Window.partitionBy(*group).orderBy("part")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, "part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("part_n", "part_hits")),
                       F.lead("top").over(ordered).alias("next_top"),
                       *(F.sum(c).over(Window.partitionBy(*group)).alias(f"all_{c}") for c in ("part_n", "part_hits")))
    inside = Window.partitionBy(*group, "part").orderBy(F.desc("score"))
    both = steps.alias("s").join(sums.alias("t"), F.expr("s.every = t.every and s.lang <=> t.lang and s.part = t.part")).select(
        "s.*", "part_n", "part_hits", "next_top", "all_part_n", "all_part_hits")
    f1 = 2 * (F.col("part_hits") + F.sum("hits").over(inside)) / (F.col("part_n") + F.sum("n").over(inside) + F.col("all_part_hits"))
    following = F.coalesce(F.lead("score").over(inside), "next_top", "score")
    best = (both.select(*group, "all_part_n", "all_part_hits", F.struct(f1.alias("f1"), "score", following.alias("next")).alias("cut"))
            .groupBy(*group).agg(F.max("cut").alias("cut"), F.first("all_part_n").alias("n"), F.first("all_part_hits").alias("hits")))
    found = {(r["every"], r["lang"]): (r["cut"]["score"] + r["cut"]["next"]) / 2
             if min(r["hits"], r["n"] - r["hits"]) >= LEAST_CALIBRATED else None for r in best.collect()}
    common = found.get((True, None))
    common = CUT if common is None else common
    return {lang: common if cut is None else cut for (every, lang), cut in found.items() if not every}


def fit_on(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int | None = None, max_bytes: int | None = None,
           **options) -> tuple[Model | None, dict[str, float]]:
    """Model and thresholds by language from all labelled rows that are not held out; (None, {}) if there are none.

    A fifth of them sets the thresholds and is not fitted; only if the others lack a class are all fitted, and there are no
    thresholds then. Labels other than 0 and 1, and ids without a document, are left out. The driver fits FIT_ROWS of each class
    (a quarter as many of the fifth set thresholds) with the lowest hashes of doc_id, in that order until their texts reach FIT_BYTES
    (a quarter of it). If that is not all, `train_on` goes on from there over all rows, and `cuts_on` takes all of the fifth.
    `rows` and `max_bytes` are for trials: the driver's fit by these bounds is then all.
    """
    order = F.xxhash64("doc_id")
    usable = labels.select("doc_id", F.col(label).alias("_label")).where(~held_out() & F.col("_label").isin(0, 1)).distinct()
    usable = usable.withColumn("_calibrates", calibrates())
    few = usable.count() <= SENT_LABELS
    labelled = docs.select("doc_id", "lang", "text").where(~held_out()).join(F.broadcast(usable) if few else usable, "doc_id")
    # in the order of their hashes, so that each task trains on rows of all kinds
    labelled = materialize((labelled.repartition("doc_id") if few else labelled)
                           .sortWithinPartitions(order, "doc_id", "_label", "text"), "toxicity-labelled")
    most_rows, most_bytes = rows or FIT_ROWS, max_bytes or FIT_BYTES
    chosen = [usable.where((F.col("_label") == c) & (F.col("_calibrates") == apart)).orderBy(order, "doc_id").limit(n)
              for c in (0, 1) for apart, n in ((False, most_rows), (True, -(-most_rows // 4)))]
    sample = (labelled.join(F.broadcast(reduce(DataFrame.unionByName, chosen).select("doc_id", "_label")), ["doc_id", "_label"])
              .orderBy(order, "doc_id", "_label", "text"))
    texts: tuple[list, list] = ([], [])
    langs, size, most = [], [0, 0], (most_bytes, most_bytes / 4)
    for row in sample.toLocalIterator():
        apart = int(row["_calibrates"])
        if size[apart] > most[apart]:
            if size[1 - apart] > most[1 - apart]:
                break
            continue
        data, offsets = utf8(pa.array([row["text"]], pa.string()))
        texts[apart].append((word_ids(data, offsets)[0], int(row["_label"])))
        size[apart] += len(data)
        if apart:
            langs.append(row["lang"])
    fitted, rest = texts
    counts = labelled.groupBy("_calibrates", "_label").count().collect()
    kinds = [{int(r["_label"]) for r in counts if r["_calibrates"] == apart} for apart in (False, True)]
    whole = bool(rows or max_bytes) or sum(r["count"] for r in counts) == len(fitted) + len(rest)
    lacks = {y for _, y in rest} - {y for _, y in fitted} if whole else kinds[1] - kinds[0]
    if lacks:
        fitted, rest = fitted + rest, []
    if not fitted:
        return None, {}
    model = fit(fitted, **options)
    if not whole:
        model = train_on(model, labelled if lacks else labelled.where("not _calibrates"))
    model.seen = None
    if whole:
        if not rest:
            return model, {}
        scores = np.concatenate([model.score(t, np.array([0, len(t)])) for t, _ in rest])
        return model, cuts_by_language(langs, scores, np.array([y for _, y in rest]))
    return model, {} if lacks else cuts_on(scored_rows(labelled.where("_calibrates"), model))


def scored_rows(rows: DataFrame, model: Model) -> DataFrame:
    """(lang, _label, score) of rows of (lang, _label, text)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @releasing
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("lang").cast(pa.string()), batch.column("_label").cast(pa.int64()),
                                              pa.array(scores(shared.value, batch.column("text")))], ["lang", "_label", "score"])

    return rows.select("lang", "_label", "text").mapInArrow(scored, "lang string, _label long, score double")


def scores(model: Model | None, column: pa.Array) -> np.ndarray:
    """Score of every text of a column; 0 without a model."""
    data, offsets = utf8(column)
    out = np.zeros(len(column))
    for lo, hi in row_slices(offsets, SLICE):
        if model is not None:
            ids, first = word_ids(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            out[lo:hi] = model.score(ids, first)
    return out


def score(docs: DataFrame, model: Model | None, thresholds: dict[str, float], cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted, threshold, over_threshold) of every row of (doc_id, lang, text).

    predicted is 1 from `cut` on, over_threshold is 1 from the language's threshold on (null or unknown language: `cut`). A null
    text scores as the empty one; without a model every score is 0. Repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, thresholds))

    @releasing
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, thresholds = shared.value
        for batch in batches:
            cuts = pa.array([thresholds.get(x, cut) for x in batch.column("lang").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(model, batch.column("text"))), cuts],
                                             ["doc_id", "score", "threshold"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "lang", "text").mapInArrow(scored, f"doc_id {kind}, score double, threshold double")
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"),
                    "threshold", (F.col("score") >= F.col("threshold")).cast("int").alias("over_threshold")))


def drop_toxic(docs: DataFrame, model: Model | None, cut: float = CUT, thresholds: dict[str, float] | None = None) -> DataFrame:
    """The rows, with all their columns, whose text scores below their language's threshold (without one: `cut`)."""
    shared = docs.sparkSession.sparkContext.broadcast((model, thresholds or {}))

    @releasing
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model, thresholds = shared.value
            cuts = np.array([thresholds.get(x, cut) for x in batch.column("lang").to_pylist()] if thresholds else cut)
            yield batch.filter(pa.array(scores(model, batch.column("text")) < cuts))

    return docs.mapInArrow(clean, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """`fit_on` and `score` over the same documents."""
    model, thresholds = fit_on(docs, labels, **options)
    return score(docs, model, thresholds)
