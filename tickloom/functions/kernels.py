"""Rolling kernels over trailing frames of rows. A value is null until its frame holds `rows` non-null inputs."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .safe import clip, div, lit, positive_variance, zero


@dataclass(frozen=True)
class Over:
    """Windows over the rows of a series (or of a block of one) in the order of row_id."""

    keys: tuple[str, ...] = ("series_id",)
    order: str = "row_id"

    @property
    def all(self):
        return Window.partitionBy(*self.keys).orderBy(self.order)

    def back(self, rows: int):
        return self.all.rowsBetween(-(rows - 1), 0)

    def lag(self, x: Column, k: int = 1) -> Column:
        return F.lag(x, k).over(self.all)

    def gated(self, value: Column, inputs: Column, rows: int) -> Column:
        frame = self.back(rows)
        return F.when(F.count(inputs).over(frame) >= rows, value.over(frame))

    def mean(self, x: Column, rows: int) -> Column:
        return self.gated(F.avg(x), x, rows)

    def sum(self, x: Column, rows: int) -> Column:
        return self.gated(F.sum(x), x, rows)

    def least(self, x: Column, rows: int) -> Column:
        return self.gated(F.min(x), x, rows)

    def most(self, x: Column, rows: int) -> Column:
        return self.gated(F.max(x), x, rows)

    def std(self, x: Column, rows: int) -> Column:
        """Sample standard deviation."""
        return self.gated(F.stddev_samp(x), x, rows)

    def std_pop(self, x: Column, rows: int) -> Column:
        return self.gated(F.stddev_pop(x), x, rows)

    # kernels

    def zscore(self, x: Column, rows: int) -> Column:
        frame = self.back(rows)
        return F.when(F.count(x).over(frame) >= rows, div(x - F.avg(x).over(frame), F.stddev_samp(x).over(frame)))

    def range_position(self, x: Column, rows: int) -> Column:
        low, high = self.least(x, rows), self.most(x, rows)
        return clip(div(x - low, high - low), 0, 1)

    def realized_vol(self, r: Column, rows: int) -> Column:
        return F.sqrt(self.sum(r * r, rows))

    def cov(self, x: Column, y: Column, rows: int) -> Column:
        return self.mean(x * y, rows) - self.mean(x, rows) * self.mean(y, rows)

    def var(self, x: Column, rows: int) -> Column:
        return positive_variance(self.mean(x * x, rows), self.mean(x, rows))

    def corr(self, x: Column, y: Column, rows: int) -> Column:
        return div(self.cov(x, y, rows), F.sqrt(self.var(x, rows) * self.var(y, rows)))

    def trend_slope(self, y: Column, rows: int) -> Column:
        """Of y on the row number; the slope does not depend on where the numbers begin."""
        return self.gated(F.regr_slope(y, F.col(self.order).cast("double")), y, rows)

    def trend_r2(self, y: Column, rows: int) -> Column:
        frame = self.back(rows)
        moves = F.max(y).over(frame) > F.min(y).over(frame)
        r2 = F.when(moves & (F.count(y).over(frame) >= rows), F.regr_r2(y, F.col(self.order).cast("double")).over(frame))
        return clip(r2, 0, 1)

    def ar1_phi(self, x: Column, previous: Column, rows: int) -> Column:
        return div(self.cov(x, previous, rows), self.var(previous, rows))

    def efficiency_ratio(self, p: Column, back: Column, step: Column, rows: int) -> Column:
        """back: p so many rows before; step: the size of p's last move."""
        return div(F.abs(p - back), self.sum(step, rows))

    def variance_ratio(self, r1: Column, rk: Column, rows: int, k: int) -> Column:
        return div(self.var(rk, rows), lit(k) * self.var(r1, rows))

    def sign_entropy(self, r: Column, rows: int) -> Column:
        """Of up, down and flat, in units of ln 3. Zero, not null, before the frame is full."""
        total = lit(0)
        for hit in (r > 0, r < 0, r == 0):
            p = self.mean(F.when(hit, lit(1)).when(r.isNotNull(), lit(0)), rows)
            total = total - F.when(p > 0, p * F.log(p)).otherwise(lit(0))
        return total / lit(math.log(3))


def pct_from_z(z: Column) -> Column:
    return lit(1) / (lit(1) + F.exp(lit(-1.702) * z))


def ar1_halflife(phi: Column) -> Column:
    size = F.abs(phi)
    return F.when((size > 0) & (size < 0.999999), lit(-math.log(2)) / F.log(size))


def normalized(over: Over, x: Column, rows: int) -> tuple[Column, Column]:
    """(z with its gaps filled by 0, pct of the z whose gaps are not filled)."""
    z = over.zscore(x, rows)
    return zero(z), pct_from_z(z)


#: Beginnings of the names of features with heavy tails, which get a pct as well.
HEAVY = ("rv_", "spread_", "bid_ask_pressure_", "microprice_proxy", "variance_ratio_", "return_sign_entropy_", "efficiency_ratio_")


def is_heavy_tail(name: str) -> bool:
    return name.startswith(HEAVY)
