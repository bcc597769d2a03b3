"""Time-window aggregates over a prediction log.

The log has ``ts``, ``user_id``, ``latency``, ``prediction``, ``is_error`` and ``label``. Sliding windows are built from
panes: rows are aggregated to one-minute panes first, and only the panes are copied into the windows they belong to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.encode import rating_bucket
from seqloom.operators.skew import running_counts

MINUTE = 60
QUANTILES = (0.5, 0.95, 0.99)
# Upper bounds of the latency histogram.
LATENCY_BOUNDS = (1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0)


def pane_start(ts: Column, seconds: int = MINUTE) -> Column:
    """Start of the aligned interval that holds ``ts``, in Unix seconds."""
    t = F.unix_seconds(ts)
    return t - F.pmod(t, F.lit(seconds))


def _window_starts(pane: Column, width: int, slide: int) -> Column:
    return F.explode(F.sequence(pane - (width - slide), pane, F.lit(slide)))


def sliding_sums(
    log: DataFrame, measures: dict[str, Column], by: list[str] | None = None, *, width: int = 5 * MINUTE, slide: int = MINUTE
) -> DataFrame:
    """Sums of ``measures`` per sliding window ``[window_start, window_start + width)`` and label."""
    by = by or []
    panes = log.groupBy(pane_start(F.col("ts"), slide).alias("_pane"), *by).agg(
        *[F.sum(m).alias(name) for name, m in measures.items()]
    )
    placed = panes.withColumn("window_start", _window_starts(F.col("_pane"), width, slide))
    return placed.groupBy("window_start", *by).agg(*[F.sum(name).alias(name) for name in measures])


def _requests() -> Column:
    return F.lit(1).cast("long")


def _errors() -> Column:
    return F.col("is_error").cast("long")


def requests_5m(log: DataFrame) -> DataFrame:
    return sliding_sums(log, {"requests": _requests()})


def errors_5m(log: DataFrame) -> DataFrame:
    return sliding_sums(log, {"errors": _errors()})


def error_rate_5m(log: DataFrame) -> DataFrame:
    """Errors in percent of requests, the divisor at least 1."""
    sums = sliding_sums(log, {"requests": _requests(), "errors": _errors()})
    return sums.select(
        "window_start", (100.0 * F.col("errors") / F.greatest(F.col("requests"), F.lit(1))).alias("error_rate")
    )


def request_batches(log: DataFrame) -> DataFrame:
    """Requests of one user in one minute count as one batch."""
    return (
        log.groupBy("user_id", pane_start(F.col("ts")).alias("_minute"))
        .agg(F.count(F.lit(1)).alias("batch_size"))
        .withColumn("ts", F.timestamp_seconds("_minute"))
    )


def avg_batch_size_5m(log: DataFrame) -> DataFrame:
    sums = sliding_sums(request_batches(log), {"requests": F.col("batch_size"), "batches": _requests()})
    return sums.select(
        "window_start", (F.col("requests") / F.greatest(F.col("batches"), F.lit(1))).alias("avg_batch_size")
    )


def throughput_1m(log: DataFrame) -> DataFrame:
    return (
        log.groupBy(pane_start(F.col("ts")).alias("window_start"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(_errors()).alias("e"))
        .select("window_start", (F.col("n") / 60.0).alias("requests_per_sec"), (F.col("e") / 60.0).alias("errors_per_sec"))
    )


def latency_percentiles_5m(
    log: DataFrame,
    quantiles: tuple[float, ...] = QUANTILES,
    *,
    width: int = 5 * MINUTE,
    slide: int = MINUTE,
    max_rows: int | None = None,
) -> DataFrame:
    """Exact interpolated latency percentiles per sliding window.

    Latencies are counted per pane and value, then copied into their windows and put in order there, so a window is
    never held in memory as a whole and a window with very many values is cut into chunks.
    """
    counted = log.groupBy(pane_start(F.col("ts"), slide).alias("_pane"), "latency").agg(F.count(F.lit(1)).alias("_c"))
    placed = (
        counted.withColumn("window_start", _window_starts(F.col("_pane"), width, slide))
        .groupBy("window_start", "latency")
        .agg(F.sum("_c").alias("_c"))
    )
    ranked = running_counts(placed, ["window_start"], ["latency"], "_c", max_rows=max_rows)
    below, upto, total = F.col("upto") - F.col("_c"), F.col("upto"), F.col("total")
    picks = []
    for i, q in enumerate(quantiles):
        at = (total - 1) * q
        lo, hi = F.floor(at), F.ceil(at)
        picks.append(F.max(F.when((below <= lo) & (lo < upto), F.col("latency"))).alias(f"_lo{i}"))
        picks.append(F.max(F.when((below <= hi) & (hi < upto), F.col("latency"))).alias(f"_hi{i}"))
    rows = ranked.groupBy("window_start").agg(F.max("total").alias("_n"), *picks)
    out = []
    for i, q in enumerate(quantiles):
        at = (F.col("_n") - 1) * q
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((lo + (hi - lo) * (at - F.floor(at))).alias(f"p{round(q * 100)}"))
    return rows.select("window_start", *out)


#: Size of a latency sketch; its rank error shrinks about as one over it.
SKETCH_SIZE = 1000


def sketch_rank_error(size: int = SKETCH_SIZE) -> float:
    """Share of the rows by which the rank of a sketched percentile is off at most, in 99 of 100 cases (KLL, as published)."""
    return 2.296 / size**0.9723


def latency_panes(log: DataFrame, *, slide: int = MINUTE, size: int = SKETCH_SIZE) -> DataFrame:
    """``(pane, sketch)``: a mergeable KLL sketch of the latencies of each pane; null latencies do not count.

    Sketches are built where the rows are and merged, so a pane of any number of rows sends one of a few kilobytes per task.
    """
    known = log.where("latency IS NOT NULL")
    return known.groupBy(pane_start(F.col("ts"), slide).alias("pane")).agg(
        F.kll_sketch_agg_double(F.col("latency").cast("double"), F.lit(size)).alias("sketch")
    )


def latency_from_panes(
    panes: DataFrame,
    quantiles: tuple[float, ...] = QUANTILES,
    *,
    width: int = 5 * MINUTE,
    slide: int = MINUTE,
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """Latency percentiles per sliding window, within ``sketch_rank_error`` of the rank, and ``n`` latencies of the window.

    Panes are copied into their windows as sketches, not as rows. A window of fewer values than a sketch holds is exact. Several
    sketches of one pane, as a stream may write them, count together.
    """
    placed = panes.select(_window_starts(F.col("pane"), width, slide).alias("window_start"), "sketch")
    merged = placed.groupBy("window_start").agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"p{round(q * 100)}") for q in quantiles]
    return merged.select("window_start", F.kll_sketch_get_n_double("sketch").alias("n"), *found)


def latency_sketch_5m(log: DataFrame, quantiles: tuple[float, ...] = QUANTILES, *, size: int = SKETCH_SIZE) -> DataFrame:
    """Approximate latency percentiles of sliding five-minute windows; see ``latency_from_panes``."""
    return latency_from_panes(latency_panes(log, size=size), quantiles, size=size)


def histogram_quantile_5m(
    log: DataFrame, quantiles: tuple[float, ...] = QUANTILES, bounds: tuple[float, ...] = LATENCY_BOUNDS
) -> DataFrame:
    """Percentiles estimated from cumulative bucket counts, linear inside the bucket that holds the rank.

    A rank beyond the last finite bound gives that bound.
    """
    measures = {f"_le{i}": (F.col("latency") <= b).cast("long") for i, b in enumerate(bounds)}
    sums = sliding_sums(log, {**measures, "_n": _requests()})

    def estimate(q: float) -> Column:
        rank = F.col("_n") * q
        value = F.lit(bounds[-1])
        for i in reversed(range(len(bounds))):
            low, below = (bounds[i - 1], F.col(f"_le{i - 1}")) if i else (0.0, F.lit(0).cast("long"))
            inside = F.nullif(F.col(f"_le{i}") - below, F.lit(0))
            at = low + (bounds[i] - low) * F.coalesce((rank - below) / inside, F.lit(1.0))
            value = F.when(F.col(f"_le{i}") >= rank, at).otherwise(value)
        return value

    return sums.select("window_start", *[estimate(q).alias(f"p{round(q * 100)}") for q in quantiles])


def with_rating(log: DataFrame) -> DataFrame:
    """The log with the rating bucket of each prediction; rows without a usable prediction are left out."""
    return log.withColumn("rating", rating_bucket(F.col("prediction"))).where(F.col("rating").isNotNull())


def rating_distribution(log: DataFrame) -> DataFrame:
    return with_rating(log).groupBy("rating").agg(F.count(F.lit(1)).alias("predictions"))


def rating_distribution_15m(log: DataFrame) -> DataFrame:
    """Predictions per rating bucket in 15-minute windows."""
    start = pane_start(F.col("ts"), 15 * MINUTE).alias("window_start")
    return with_rating(log).groupBy(start, "rating").agg(F.count(F.lit(1)).alias("predictions"))


def rating_rate_5m(log: DataFrame) -> DataFrame:
    """Predictions per second and rating bucket in sliding five-minute windows."""
    sums = sliding_sums(with_rating(log), {"n": _requests()}, ["rating"])
    return sums.select("window_start", "rating", (F.col("n") / 300.0).alias("rate"))


def latest_gauge(log: DataFrame, value: str, label: str, order: list[str]) -> DataFrame:
    """Last reported value per label."""
    return log.groupBy(label).agg(F.max_by(value, F.struct(*order)).alias("last_value"))
