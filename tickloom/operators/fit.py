"""Fitting: sample blocks, clip bounds, feature scores, correlation pruning. Only scalars, bounds and a matrix reach the driver."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FeatureConfig
from ..functions.safe import clip
from .features import BASE, KEYS
from .layout import nearest_quantiles

NUMERIC = {"double", "float", "bigint", "int"}
#: Parts of the moments of a sample.
PARTS = 32
#: What a feature's name adds to its score.
ENDINGS = (("_z", 0.05), ("_pct", 0.02))
SHORT = ("_1", "_per_ms")
FAVOURED = ("duration_", "ticks_per_", "spread_rel_")


def numeric_columns(df: DataFrame, protect: list[str] = ()) -> list[str]:
    return [c for c, kind in df.dtypes if kind in NUMERIC and c not in protect and c not in KEYS]


def block_starts(fit_rows: int, n_blocks: int) -> list[int]:
    if n_blocks <= 1:
        return [0]
    return [int((fit_rows - 1) * i / (n_blocks - 1)) for i in range(n_blocks)]


def fit_blocks(df: DataFrame, fit_rows: int, n_blocks: int, rows: int, distinct: bool = False) -> DataFrame:
    """Evenly spaced blocks of rows within the first fit_rows of a series, by row_id. Rows in two blocks are there twice,
    unless distinct; block has the block's number. The few blocks are broadcast."""
    spark = df.sparkSession
    spans = [(i, s, min(s + rows, fit_rows)) for i, s in enumerate(block_starts(fit_rows, n_blocks)) if s < fit_rows]
    if distinct:
        for k in range(len(spans) - 1, 0, -1):
            spans[k - 1] = (*spans[k - 1][:2], min(spans[k - 1][2], spans[k][1]))
    some = spark.createDataFrame(spans, "block int, _from long, _to long")
    return df.join(F.broadcast(some), (F.col("row_id") >= F.col("_from")) & (F.col("row_id") < F.col("_to"))).drop("_from", "_to")


def series_sizes(df: DataFrame) -> DataFrame:
    """series_id, first (row_id), n: a row per series."""
    return df.groupBy("series_id").agg((F.max("row_id") - F.min("row_id") + 1).alias("n"), F.min("row_id").alias("first"))


def series_blocks(df: DataFrame, sizes: DataFrame, fraction: float, n_blocks: int, sample: int, series: int, distinct: bool = False) -> DataFrame:
    """The blocks of fit_blocks for every series by its own first row and number of rows (sizes: series_id, first, n), so that no row
    behind a series' first part is fitted. The rows of all blocks are about `sample`, however many series there are."""
    rows = -(-max(10_000, -(-sample // n_blocks)) // max(series, 1))
    fitted = F.floor(F.col("n") * F.lit(fraction))
    share = lambda i: F.lit(0) if n_blocks <= 1 else F.floor((F.col("_fit") - 1) * F.lit(i) / F.lit(n_blocks - 1))
    starts = [share(i).cast("long") for i in range(max(1, n_blocks))]
    ends = [F.least(s + rows, F.col("_fit")) for s in starts]
    if distinct:
        ends = [F.least(e, s) for e, s in zip(ends, starts[1:])] + ends[-1:]
    spans = F.array(*[F.struct(F.lit(i).alias("no"), s.alias("from"), e.alias("to")) for i, (s, e) in enumerate(zip(starts, ends))])
    own = sizes.withColumn("_fit", fitted).where("_fit > 0").select("series_id", F.col("first").alias("_first"), spans.alias("_spans"))
    joined = df.join(F.broadcast(own) if series <= 10_000 else own, "series_id")
    place = F.col("row_id") - F.col("_first")
    hit = F.filter("_spans", lambda s: (place >= s["from"]) & (place < s["to"]))
    return joined.withColumn("block", F.explode(F.transform(hit, lambda s: s["no"]))).drop("_first", "_spans")


def clip_bounds(df: DataFrame, columns: list[str], low: float, high: float) -> DataFrame:
    """column, low, high by nearest quantiles of a bounded sample, in order; columns without values have no row."""
    q = nearest_quantiles(df, columns, [low, high], bounded=True).groupBy("column")
    ends = q.agg(F.max(F.when(F.col("share") == low, F.col("value"))).alias("a"), F.max(F.when(F.col("share") == high, F.col("value"))).alias("b"))
    return ends.where("a is not null and b is not null").select("column", F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))


def clip_select(df: DataFrame, columns: list[str], bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """One select: numeric columns with bounds are clipped, null stays null."""
    kinds = dict(df.dtypes)
    return df.select(*[clip(F.col(c).cast("double"), *bounds[c]).alias(c) if c in bounds and kinds[c] in NUMERIC else F.col(c) for c in columns])


def null_rates_and_variances(df: DataFrame, columns: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Both maps from one aggregation."""
    if not columns:
        return {}, {}
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"n_{c}") for c in columns], *[F.var_samp(F.col(c).cast("double")).alias(f"v_{c}") for c in columns]).first()
    return {c: 1.0 if row[f"n_{c}"] is None else row[f"n_{c}"] for c in columns}, {c: row[f"v_{c}"] or 0.0 for c in columns}


def feature_score(name: str, variance: float, null_rate: float) -> float:
    score = math.log1p(max(variance, 0.0)) - 2.0 * null_rate
    score += sum(plus for end, plus in ENDINGS if name.endswith(end))
    if "_XL" in name or name.endswith(SHORT):
        score += 0.02
    return score + (0.03 if name.startswith(FAVOURED) else 0.0)


@dataclass
class Moments:
    """Of a table's columns: rows, null rates, sample variances of values, and with gaps as 0 deviations and the Pearson matrix."""

    columns: list[str]
    rows: int
    null_rate: dict[str, float]
    variance: dict[str, float]
    deviation: dict[str, float]
    matrix: np.ndarray


class _Sums:
    """Counts, means and co-moments of rows of numbers; two can be merged, so parts are centred before they are multiplied."""

    def __init__(self, x: np.ndarray):
        there = ~np.isnan(x)
        self.n, self.there = len(x), there.sum(axis=0).astype(float)
        filled = np.where(there & np.isfinite(x), x, 0.0)
        self.mean = filled.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        centred = filled - self.mean
        self.co = centred.T @ centred
        held = np.maximum(self.there, 1)
        self.own = filled.sum(axis=0) / held
        self.square = (np.where(there, filled - self.own, 0.0) ** 2).sum(axis=0)

    def merge(self, other: _Sums) -> _Sums:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        gap = other.mean - self.mean
        self.co = self.co + other.co + np.outer(gap, gap) * (self.n * other.n / n)
        self.mean = self.mean + gap * (other.n / n)
        there = self.there + other.there
        step = other.own - self.own
        held = np.maximum(there, 1)
        self.square = self.square + other.square + step**2 * (self.there * other.there / held)
        self.own = self.own + step * (other.there / held)
        self.n, self.there = n, there
        return self


def moments(df: DataFrame, columns: list[str]) -> Moments:
    """One pass over a bounded sample. A part is as many bytes as the matrix; PARTS of them come to the driver at most."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = _Sums(np.zeros((0, len(columns))))
        for batch in batches:
            if batch.num_rows:
                total = total.merge(_Sums(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])))
        yield pa.RecordBatch.from_pydict({"part": pa.array([pickle.dumps(total)], pa.binary())})

    if not columns:
        return Moments([], 0, {}, {}, {}, np.zeros((0, 0)))
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    total = _Sums(np.zeros((0, len(columns))))
    for r in rows.coalesce(PARTS).mapInArrow(run, "part binary").collect():
        total = total.merge(pickle.loads(r.part))
    n, deviation = max(total.n, 1), np.sqrt(np.maximum(np.diag(total.co), 0) / max(total.n, 1))
    deviation = np.where(deviation > 1e-12 * np.abs(total.mean), deviation, 0.0)  # what rounding leaves of a constant is none
    scale = np.outer(deviation, deviation) * n
    matrix = np.divide(total.co, scale, out=np.zeros_like(total.co), where=scale > 0)
    variance = np.divide(total.square, total.there - 1, out=np.zeros_like(total.square), where=total.there > 1)
    named = lambda v: dict(zip(columns, (float(x) for x in v)))
    return Moments(columns, total.n, named(1 - total.there / n), named(variance), named(deviation), matrix)


def correlation(df: DataFrame, columns: list[str]) -> tuple[list[str], list[list[float]]]:
    """(columns that vary, their Pearson matrix). Null, NaN and infinity count as 0."""
    return _varying(moments(df, columns))


def _varying(m: Moments) -> tuple[list[str], list[list[float]]]:
    at = [i for i, c in enumerate(m.columns) if m.deviation[c] > 0]
    return [m.columns[i] for i in at], m.matrix[np.ix_(at, at)].tolist()


def greedy_prune(names: list[str], matrix: list[list[float]], scores: dict[str, float], threshold: float) -> list[str]:
    """Names in order; each one meets the later ones that are still in: of two that correlate the lower score goes, the
    earlier stays on a tie. One that goes ends its own turn; those that it had put out stay out."""
    out: set[int] = set()
    for i, a in enumerate(names):
        if i in out:
            continue
        for j in range(i + 1, len(names)):
            if j in out or abs(matrix[i][j]) < threshold:
                continue
            if scores[a] >= scores[names[j]]:
                out.add(j)
            else:
                out.add(i)
                break
    return [n for i, n in enumerate(names) if i not in out]


def corr_prune(df: DataFrame, threshold: float, protect: list[str]) -> list[str]:
    """The protected columns and the others that survive."""
    candidates = numeric_columns(df, protect)
    if len(candidates) <= 1:
        return [*protect, *candidates]
    m = moments(df, candidates)
    names, matrix = _varying(m)
    return [*protect, *greedy_prune(names, matrix, {c: feature_score(c, m.variance[c], m.null_rate[c]) for c in names}, threshold)]


def fit(features: DataFrame, config: FeatureConfig) -> dict:
    """The transform's parameters: bounds, selected columns, and what they come from. Fitted on the first part of each series."""
    sizes = series_sizes(features)
    whole = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.floor(F.col("n") * F.lit(config.fraction))), F.lit(0))).first()
    series, total_rows, fit_rows = (int(v) for v in whole)
    blocks = lambda sample: series_blocks(features, sizes, config.fraction, config.fit_blocks, sample, series, config.distinct_blocks)
    columns = numeric_columns(features, BASE)
    for_bounds = blocks(config.fit_sample_rows)
    bounds = {r.column: (r.low, r.high) for r in clip_bounds(for_bounds, columns, config.clip_low, config.clip_high).collect()}
    for_corr = blocks(config.corr_sample_rows).drop("block")
    selected = corr_prune(clip_select(for_corr, for_corr.columns, bounds).drop("series_id", "row_id"), config.corr_threshold, list(BASE))
    return {
        "version": "1.2", "windows": config.windows, "fit_rows": fit_rows, "total_rows": total_rows, "series": series, "corr_threshold": config.corr_threshold, "clip": [config.clip_low, config.clip_high],
        "bounds": {c: list(b) for c, b in bounds.items()}, "selected": selected, "qa": {"null_rate": moments(for_corr, columns).null_rate},
    }


def transform(features: DataFrame, params: dict) -> DataFrame:
    bounds = {c: tuple(b) for c, b in params["bounds"].items()}
    return clip_select(features, [*KEYS, *[c for c in params["selected"] if c not in KEYS]], bounds)
