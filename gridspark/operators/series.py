"""Time-series operators on regular calendars (run `align.calendar_fill` first; all need `slot`)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridspark.functions import timefn
from gridspark.operators import grid
from gridspark.session import materialize


def lagged(df: DataFrame, keys: list[str], val: str, lags: list[int], prefix: str = "lag_",
           size: int = grid.CHUNK) -> DataFrame:
    """Add `{prefix}{k}`: the value k steps earlier, NULL before the start."""
    rows = grid.with_halo(df, before=max(lags), size=size)
    w = grid.halo_window(keys, size)
    rows = rows.select("*", *[F.lag(val, k).over(w).alias(f"{prefix}{k}") for k in lags])
    return grid.own_rows(rows)


def moving_avg(df: DataFrame, keys: list[str], val: str = "val", width: int = 2, out: str = "smooth",
               size: int = grid.CHUNK) -> DataFrame:
    """Mean of the values at positions i-width+1 .. i+width, NULLs left out; 0 for i < width and i >= n - width."""
    spans = grid.series_stats(df, keys)
    rows = grid.with_halo(df, before=width - 1, after=width, size=size)
    rows = grid.attach(rows, spans, keys, size, before=width - 1, after=width, windowed=True)
    w = grid.halo_window(keys, size).rowsBetween(-(width - 1), width)
    inner = (F.col("slot") - F.col("lo") >= width) & (F.col("hi") - F.col("slot") >= width)
    rows = rows.withColumn(out, F.when(inner, F.avg(val).over(w)).otherwise(F.lit(0.0)))
    return grid.own_rows(rows).drop("lo", "hi")


def _trend(df: DataFrame, keys: list[str], val: str, period: int, size: int) -> DataFrame:
    """Trailing mean over one period; an even period takes period+1 taps with half weight at both ends."""
    taps = period if period % 2 == 0 else period - 1
    rows = grid.with_halo(df, before=taps, size=size)
    w = grid.halo_window(keys, size)
    frame = w.rowsBetween(-taps, 0)
    total = F.sum(val).over(frame)
    if period % 2 == 0:
        total = total - (F.col(val) + F.lag(val, taps).over(w)) / 2
    full = F.count(val).over(frame) == taps + 1
    rows = rows.withColumn("trend", F.when(full, total / period))
    return grid.own_rows(rows)


def seasonal_decompose(df: DataFrame, keys: list[str], val: str = "val", period: int = 24,
                       size: int = grid.CHUNK) -> DataFrame:
    """One-sided additive decomposition; trend, seasonal and residual are divided by the series mean.

    The trend is NULL where its window is incomplete. Seasonal: mean detrended value per phase, centred.
    """
    phase = F.pmod(F.col("slot"), F.lit(period)).cast("int")
    rows = _trend(df, keys, val, period, size).withColumn("phase", phase)
    per_phase = rows.groupBy(*keys, "phase").agg(
        F.avg(F.col(val) - F.col("trend")).alias("m"), F.sum(val).alias("total"), F.count(val).alias("n"),
        F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    # at most `period` rows per series
    profile = per_phase.groupBy(*keys).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.avg("m").alias("centre"),
        (F.sum("total") / F.sum("n")).alias("mean"),
        F.map_from_entries(F.collect_list(F.struct("phase", "m"))).alias("profile"))
    rows = grid.attach(rows, profile, keys, size)
    seasonal = F.element_at("profile", F.col("phase")) - F.col("centre")
    return rows.select(
        *df.columns,
        (F.col("trend") / F.col("mean")).alias("trend"),
        (seasonal / F.col("mean")).alias("seasonal"),
        ((F.col(val) - F.col("trend") - seasonal) / F.col("mean")).alias("residual"))


def _join_chunks(chunks: pd.DataFrame, nlags: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Chunk sums to series sums: values counted, centred products for lags 0..nlags, first and last nlags centred values."""
    mean = np.average(chunks["mean"], weights=chunks["n"])
    products, head, tail = np.zeros(nlags + 1), np.empty(0), np.empty(0)
    for row in chunks.sort_values("chunk").itertuples():
        shift, lags = row.mean - mean, np.arange(min(row.n, nlags + 1))
        first, last = np.asarray(row.head, float), np.asarray(row.tail, float)
        # a chunk's deviations sum to 0, so a shifted sum is minus what falls off both ends
        off = np.concatenate([[0.0], np.cumsum(first)])[lags] + np.concatenate([[0.0], np.cumsum(last[::-1])])[lags]
        products[lags] += np.asarray(row.products, float)[lags] - shift * off + (row.n - lags) * shift**2
        first, last = first + shift, last + shift
        for k in range(1, nlags + 1):
            i = np.arange(max(0, k - len(tail)), min(k, len(first)))
            products[k] += first[i] @ tail[len(tail) + i - k]
        head = np.concatenate([head, first])[:nlags] if len(head) < nlags else head
        tail = np.concatenate([tail, last])
        tail = tail[max(0, len(tail) - nlags):]
    return int(chunks["n"].sum()), products, head, tail


def _lag_products(df: DataFrame, keys: list[str], val: str, nlags: int, size: int) -> DataFrame:
    """Per series: n, the sums of centred products for lags 0..nlags (`products`), and the first and last nlags centred
    values (`head`, `tail`). NULLs are dropped and lags count what is left.

    Rows are shuffled once, by (series, chunk): a chunk sums its own pairs about its own mean and keeps its ends. The second
    shuffle brings one row per chunk together, where products move to the series' mean and pairs over the borders are added.
    """
    chunk = grid.chunk_col(size)
    rows = grid.with_chunk(df.where(F.col(val).isNotNull()), size).select(*keys, chunk, "slot", F.col(val).cast("double").alias("v"))
    inside, w = W.partitionBy(*keys, chunk), grid.halo_window(keys, size)
    rows = rows.withColumn("at", F.row_number().over(w)).withColumns(
        {"mean": F.avg("v").over(inside), "n": F.count("v").over(inside)}).withColumn("c", F.col("v") - F.col("mean"))
    lags = [F.col("c") * (F.col("c") if k == 0 else F.lag("c", k).over(w)) for k in range(nlags + 1)]
    rows, pair = rows.select("*", *[p.alias(f"p{k}") for k, p in enumerate(lags)]), F.struct("at", "c")
    sums = rows.groupBy(*keys, chunk).agg(
        F.first("n").alias("n"), F.first("mean").alias("mean"),
        F.array(*[F.coalesce(F.sum(f"p{k}"), F.lit(0.0)) for k in range(nlags + 1)]).alias("products"),
        F.sort_array(F.collect_list(F.when(F.col("at") <= nlags, pair)))["c"].alias("head"),
        F.sort_array(F.collect_list(F.when(F.col("at") > F.col("n") - nlags, pair)))["c"].alias("tail"))
    sums = sums.withColumnRenamed(chunk, "chunk")
    schema = sums.select(*keys, "n", "products", "head", "tail").schema

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        n, products, head, tail = _join_chunks(pdf, nlags)
        return pdf.iloc[:1][keys].assign(n=n, products=[products], head=[head], tail=[tail])

    return sums.groupBy(*keys).applyInPandas(join, schema)


def acf(df: DataFrame, keys: list[str], val: str = "val", nlags: int = 24, size: int = grid.CHUNK) -> DataFrame:
    """Autocorrelation for lags 0..nlags with the 95 % band 1.96/sqrt(n)."""
    sums = _lag_products(df, keys, val, nlags, size)
    p = F.col("products")
    return (sums.select(*keys, "n", p.alias("all"), F.posexplode(p).alias("lag", "p"))
            .where(F.col("lag") < F.col("n"))
            .select(*keys, "lag", F.when(F.col("all")[0] != 0, F.col("p") / F.col("all")[0]).alias("acf"),
                    (1.96 / F.sqrt("n")).alias("band")))


def _pacf_row(n: int, products: np.ndarray, head: np.ndarray, tail: np.ndarray, nlags: int) -> list[float]:
    """Coefficient of lag k in the regression of x[t] on 1, x[t-1]..x[t-k] over t = k..n-1, for each k."""
    x = {i: v for i, v in enumerate(head)}
    x.update({n - len(tail) + i: v for i, v in enumerate(tail)})
    first_sum = np.concatenate([[0.0], np.cumsum([x[i] for i in range(min(n, nlags))])])
    last_sum = np.concatenate([[0.0], np.cumsum([x[n - 1 - i] for i in range(min(n, nlags))])])
    out = [1.0]
    for k in range(1, nlags + 1):
        if n <= 2 * k + 1:
            out.append(float("nan"))
            continue
        m = np.empty((k + 2, k + 2))  # order: 1, lag 0, lag 1, ..., lag k
        m[0, 0] = n - k
        for i in range(k + 1):
            # centred values sum to 0, so a shifted sum is minus what falls off both ends
            m[0, i + 1] = m[i + 1, 0] = -first_sum[k - i] - last_sum[i]
            for j in range(i, k + 1):
                h = j - i
                lost = sum(x[u] * x[u - h] for u in range(h, k - i)) + sum(x[u] * x[u - h] for u in range(n - i, n))
                m[i + 1, j + 1] = m[j + 1, i + 1] = products[h] - lost
        regress = np.r_[0, 2:k + 2]
        beta = np.linalg.lstsq(m[np.ix_(regress, regress)], m[regress, 1], rcond=None)[0]
        out.append(float(beta[-1]))
    return out


def pacf(df: DataFrame, keys: list[str], val: str = "val", nlags: int = 24, size: int = grid.CHUNK) -> DataFrame:
    """Partial autocorrelation by least squares for lags 0..nlags.

    Spark sums the lag products; Python only solves the small normal equations, one row per series.
    """
    sums = _lag_products(df, keys, val, nlags, size)
    out_schema = sums.select(*keys, F.lit(None).cast("array<double>").alias("pacf")).schema

    def solve(batches):
        for pdf in batches:
            values = [_pacf_row(int(n), np.asarray(p), np.asarray(h), np.asarray(t), nlags)
                      for n, p, h, t in zip(pdf["n"], pdf["products"], pdf["head"], pdf["tail"])]
            yield pd.concat([pdf[keys], pd.Series(values, name="pacf", index=pdf.index, dtype=object)], axis=1)

    solved = sums.mapInPandas(solve, out_schema)
    return solved.select(*keys, F.posexplode("pacf").alias("lag", "pacf"))


def persistence(df: DataFrame, keys: list[str], val: str = "val", horizon: int = 24,
                size: int = grid.CHUNK) -> DataFrame:
    """Forecast = value `horizon` steps before, within the first (train) or second (test) half of each series."""
    rows = lagged(df, keys, val, [horizon], "back_", size)
    rows = split_half(rows, keys, size, spans=grid.series_stats(df, keys))
    in_half = (F.col("part") == "train") | (F.col("rn") >= F.col("half") + horizon)
    return rows.withColumn("persist", F.when(in_half, F.col(f"back_{horizon}"))).drop(f"back_{horizon}", "half")


def split_half(df: DataFrame, keys: list[str], size: int = grid.CHUNK, ratio: float = 0.5,
               spans: DataFrame | None = None) -> DataFrame:
    """Position split: `rn`, `half` = floor(n * ratio) and `part` = train before it, test after."""
    spans = grid.series_stats(df, keys) if spans is None else spans
    half = F.floor((F.col("hi") - F.col("lo") + 1) * ratio)
    return (grid.attach(df, spans, keys, size)
            .withColumn("rn", F.col("slot") - F.col("lo"))
            .withColumn("half", half)
            .withColumn("part", F.when(F.col("rn") < F.col("half"), F.lit("train")).otherwise(F.lit("test")))
            .drop("lo", "hi"))


def day_block(steps: int = 24, offset: int = 0) -> Column:
    """Block number; blocks start where slot = offset (mod steps), so days start at midnight."""
    return F.floor((F.col("slot") - offset) / steps)


def _block_window(keys: list[str], steps: int, size: int) -> W:
    """A block holds `steps` rows, so these windows stay small whatever the series' length. Blocks that never
    straddle two chunks are found inside the chunks the rows are already partitioned by."""
    inside = [grid.chunk_col(size)] if size % steps == 0 else []
    return W.partitionBy(*keys, *inside, "block").orderBy("slot").rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing)


def day_level(df: DataFrame, keys: list[str], val: str = "val", steps: int = 24, out: str = "level",
              size: int = grid.CHUNK) -> DataFrame:
    """First value of each day, repeated."""
    rows = grid.with_chunk(df, size).withColumn("block", day_block(steps))
    return rows.withColumn(out, F.first(val).over(_block_window(keys, steps, size))).drop("block")


def day_grad(df: DataFrame, keys: list[str], val: str = "val", steps: int = 24, out: str = "grad",
             size: int = grid.CHUNK) -> DataFrame:
    """(last - first) / (steps - 1) of each day, times the position in the day."""
    w = _block_window(keys, steps, size)
    rows = grid.with_chunk(df, size).withColumn("block", day_block(steps))
    slope = (F.last(val).over(w) - F.first(val).over(w)) / (steps - 1)
    return rows.withColumn(out, slope * F.pmod(F.col("slot"), F.lit(steps))).drop("block")


def run_boundaries(df: DataFrame, label: str, order: list[str], chunk: Column | None = None) -> DataFrame:
    """Number the runs of equal `label` along `order`; adds `run_id` (0-based) and `starts`.

    The rows are cut into ranges of `order` of equal size, as many as the session has shuffle partitions, and written once
    with their range number; so neither a busy hour nor a busy label fills a task. (`chunk`, which must grow
    with `order`, is for input that has such a column.) The last label of each range is handed to the next
    non-empty one, and runs are counted per range and summed up: only one row per range meets in one task.
    """
    if chunk is None:
        df = materialize(df.repartitionByRange(*order).withColumn("chunk", F.spark_partition_id()), "ranges")
    else:
        df = df.withColumn("chunk", chunk)
    this = F.struct(F.col(label).alias("label"))
    ends = df.groupBy("chunk").agg(F.max_by(this, F.struct(*order)).alias("end"))
    ends = ends.withColumn("before", F.lag("end").over(W.orderBy("chunk"))).drop("end")
    inside = W.partitionBy("chunk").orderBy(*order)
    previous = F.coalesce(F.lag(this).over(inside), F.col("before"))
    same = previous.isNotNull() & previous["label"].eqNullSafe(F.col(label))
    marked = df.join(ends.hint("shuffle_hash"), "chunk").withColumn("starts", (~same).cast("int"))
    counts = marked.groupBy("chunk").agg(F.sum("starts").alias("n_starts"))
    up_to = W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("runs_before", F.coalesce(F.sum("n_starts").over(up_to), F.lit(0))).drop("n_starts")
    running = F.sum("starts").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (marked.join(counts.hint("shuffle_hash"), "chunk")
            .withColumn("run_id", F.col("runs_before") + running - 1)
            .drop("chunk", "before", "runs_before"))


def run_series(runs: DataFrame, label: str, ts: str, val: str) -> DataFrame:
    """One row per run: label, first and last time, rows and sum."""
    return runs.groupBy("run_id", label).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n_rows"),
        F.sum(val).alias("total"))


def pct_error(pred: Column, actual: Column) -> Column:
    return F.when(actual != 0, pred / actual - 1)


def lag_features(df: DataFrame, keys: list[str], val: str = "val", day: int = 24, week: int = 168,
                 size: int = grid.CHUNK) -> DataFrame:
    """Regressors of the stated autoregression: last change, the same change a day before, last week's value."""
    rows = lagged(df, keys, val, [1, day, day + 1, week], "l", size)
    return (rows.withColumn("d1", F.col(val) - F.col("l1"))
            .withColumn("d_day", F.col(f"l{day}") - F.col(f"l{day + 1}"))
            .withColumnRenamed(f"l{week}", "l_week")
            .drop("l1", f"l{day}", f"l{day + 1}"))


def seq_windows(df: DataFrame, keys: list[str], inputs: str, label: str, length: int, offset: int | None = None,
                stride: int | None = None, label_length: int | None = None, size: int = grid.CHUNK) -> DataFrame:
    """Windows of `length` inputs with the labels starting `offset` steps after the window's first row.

    By default the labels start right after the inputs and windows do not overlap (stride = length). Each row is sent to the
    windows it belongs to, which are grouped: no list is built that the stride does not keep.
    Output: keys, slot of the first input, arrays x and y.
    """
    offset = length if offset is None else offset
    stride = stride or length
    label_length = label_length or length
    ahead = max(length, offset + label_length) - 1
    spans = grid.series_stats(df, keys)
    rows = grid.attach(df.select(*dict.fromkeys([*keys, "slot", inputs, label])), spans, keys, size)
    at = F.col("slot") - F.col("lo")
    windows = F.floor((F.col("hi") - F.col("lo") - ahead) / stride)

    def starts(first: int, n: int) -> Column:
        """Numbers of the windows whose positions first .. first + n - 1 hold this row."""
        begin = F.greatest(F.ceil((at - (first + n - 1)) / stride), F.lit(0))
        end = F.least(F.floor((at - first) / stride), windows)
        return F.when(begin <= end, F.sequence(begin, end)).otherwise(F.array().cast("array<bigint>"))

    # one list of (window, place, input, label): NULLs keep their place inside structs
    def cells(first: int, n: int, is_label: bool) -> Column:
        return F.transform(starts(first, n), lambda k: F.struct(
            k.alias("k"), F.lit(is_label).alias("is_label"), F.col("slot").alias("at"),
            F.col(inputs).alias("x"), F.col(label).alias("y")))

    cell = F.explode(F.concat(cells(0, length, False), cells(offset, label_length, True))).alias("m")
    x = F.sort_array(F.collect_list(F.when(~F.col("m.is_label"), F.struct("m.at", "m.x"))))
    y = F.sort_array(F.collect_list(F.when(F.col("m.is_label"), F.struct("m.at", "m.y"))))
    return (rows.select(*keys, "lo", cell).groupBy(*keys, (F.col("lo") + F.col("m.k") * stride).alias("slot"))
            .agg(x["x"].alias("x"), y["y"].alias("y")))


def sample_starts(spans: DataFrame, keys: list[str], n_samples: int, length: int, seed: int = 7653,
                  every: int = 1) -> DataFrame:
    """`n_samples` start slots per series drawn from md5(keys, i, seed): repeatable on any cluster.

    `every=24` draws among midnights only. A series too short for a window gives one row with NULL sample and start.
    """
    text = F.concat_ws("-", *keys, F.col("sample"), F.lit(seed))
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    first = F.ceil(F.col("lo") / every) * every
    room = F.floor((F.col("hi") + 1 - length - first + every - 1) / every)
    none = F.array(F.lit(None).cast("int"))
    samples = F.when(room > 0, F.sequence(F.lit(0), F.lit(n_samples - 1))).otherwise(none)
    start = F.when(room > 0, first + draw % F.greatest(room, F.lit(1)) * every)
    return spans.withColumn("sample", F.explode(samples)).select(*keys, "sample", start.alias("start"))


def sample_windows(df: DataFrame, keys: list[str], n_samples: int, length: int, seed: int = 7653, every: int = 1,
                   after: str | None = None, until: str | None = None) -> DataFrame:
    """Random training windows in long form: keys, sample, step (0..length-1) and the sampled row's columns.

    Windows lie within `(after, until]` when given. Each window is spelled out as the slots it covers and
    equi-joined, so no range join is needed. A series too short for a window gives one row with NULL sample and step.
    """
    if after and until:
        df = df.where(timefn.half_open("ts", after, until))
    starts = sample_starts(grid.series_stats(df, keys), keys, n_samples, length, seed, every)
    steps = F.when(F.col("start").isNotNull(), F.sequence(F.lit(0), F.lit(length - 1))).otherwise(F.array(F.lit(None).cast("int")))
    cover = (starts.withColumn("step", F.explode(steps))
             .select(*keys, "sample", "step", (F.col("start") + F.col("step")).alias("slot")))
    return cover.join(df, [*keys, "slot"], "left")


def blocks(df: DataFrame, keys: list[str], columns: list[str], steps: int = 24, size: int = grid.CHUNK) -> DataFrame:
    """One row per (series, block of `steps` rows) with an array per column in slot order."""
    rows = grid.with_chunk(df, size).withColumn("block", day_block(steps))
    inside = [grid.chunk_col(size)] if size % steps == 0 else []
    packed = rows.groupBy(*keys, *inside, "block").agg(F.sort_array(F.collect_list(F.struct("slot", *columns))).alias("r"))
    return packed.select(*keys, "block", F.size("r").alias("n"), F.col("r.slot").alias("slots"),
                         *[F.col(f"r.{c}").alias(c) for c in columns])


def block_score(df: DataFrame, keys: list[str], columns: list[str], model, steps: int = 24) -> DataFrame:
    """Consecutive block inference: `model` maps an array (blocks, steps, columns) to (blocks, steps).

    Rows of incomplete blocks have NULL predictions. Output: keys, slot, pred.
    """
    packed = blocks(df, keys, columns, steps)
    part = packed.where(F.col("n") != steps).select(*keys, F.explode("slots").alias("slot"), F.lit(None).cast("double").alias("pred"))
    whole = packed.where(F.col("n") == steps).select(*keys, "block", *columns)
    schema = whole.select(*keys, "block", F.lit(None).cast("array<double>").alias("preds")).schema

    def score(batches):
        for pdf in batches:
            x = np.stack([np.stack(pdf[c].to_list()).astype(float) for c in columns], axis=-1)
            y = np.asarray(model(x), dtype=float)
            yield pd.concat([pdf[[*keys, "block"]], pd.Series(list(y), name="preds", index=pdf.index)], axis=1)

    scored = whole.mapInPandas(score, schema)
    return (scored.select(*keys, "block", F.posexplode("preds").alias("step", "pred"))
            .select(*keys, (F.col("block") * steps + F.col("step")).alias("slot"), "pred").unionByName(part))


def minmax_train(df: DataFrame, keys: list[str], val: str = "val", ratio: float = 0.5,
                 size: int = grid.CHUNK) -> DataFrame:
    """Scale to [0, 1] with the minimum and maximum of the training part; keeps both for the inverse."""
    rows = split_half(df, keys, size, ratio)
    train = F.when(F.col("part") == "train", F.col(val))
    stats = grid.series_stats(rows, keys, F.min(train).alias("train_min"), F.max(train).alias("train_max"))
    rows = grid.attach(rows, stats, keys, size).drop("lo", "hi", "half")
    span = F.col("train_max") - F.col("train_min")
    return rows.withColumn("scaled", F.when(span != 0, (F.col(val) - F.col("train_min")) / span))


def minmax_inverse(scaled: Column, low: Column, high: Column) -> Column:
    return scaled * (high - low) + low
