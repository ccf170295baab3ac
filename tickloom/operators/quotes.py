"""Raw quotes to clean ones: names, numbers, times, sanity, copies, spreads. All rules are global, whatever the partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.safe import INF
from .layout import nearest_quantiles

#: Accepted names, the canonical one first; the earlier of two that are there wins.
ALIASES = {
    "time": ("time", "timestamp", "ts", "datetime", "date", "t"),
    "bid": ("bid", "best_bid", "b", "bid_price", "px_bid"),
    "ask": ("ask", "best_ask", "a", "ask_price", "px_ask", "offer"),
}
#: Formats of times beyond ISO 8601.
FORMATS = ("yyyy.MM.dd HH:mm:ss.SSS", "yyyy.MM.dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss.SSS", "yyyy/MM/dd HH:mm:ss", "dd.MM.yyyy HH:mm:ss.SSS", "dd.MM.yyyy HH:mm:ss", "yyyyMMdd HH:mm:ss.SSS", "yyyyMMdd HH:mm:ss", "yyyy.MM.dd", "yyyy/MM/dd")
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
#: Medians above these are nanoseconds, microseconds, milliseconds; else seconds.
UNITS = ((1e17, "ns"), (1e14, "us"), (1e11, "ms"))


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return df


def alias_columns(df: DataFrame) -> DataFrame:
    """time, bid, ask under whatever names, trimmed and in any case; other columns go."""
    there = {}
    for c in df.columns:
        there.setdefault(c.strip().lower(), c)
    found = {name: next((there[a] for a in options if a in there), None) for name, options in ALIASES.items()}
    missing = [name for name, c in found.items() if c is None]
    if missing:
        raise ValueError(f"no column for {missing} among {df.columns}")
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in found.items()])


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def parse_price(text: Column) -> Column:
    """With both . and , the later reading decides: 1.234,56 is European, 1,234.56 not; a lone comma is a decimal one."""
    t = F.trim(text.cast("string"))
    both = t.contains(".") & t.contains(",")
    european = t.rlike(r"\.\d{3},") | t.rlike(r",\d{2}$")
    plain = (
        F.when(both & european, F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(both, F.replace(t, F.lit(","), F.lit("")))
        .when(t.contains(","), F.replace(t, F.lit(","), F.lit(".")))
        .otherwise(t)
    )
    return F.when(plain.rlike(NUMBER), plain.try_cast("double"))


def epoch_unit(df: DataFrame, column: str = "time") -> str:
    """The unit of epoch numbers, by the median of all of them: one aggregation counts how many are above each bound, and where that
    is just half of them, the two values beside the bound are the middle ones."""
    x = F.col(column).cast("double")
    parts = [F.struct(F.count_if(x > bound), F.max(F.when(x <= bound, x)), F.min(F.when(x > bound, x))) for bound, _ in UNITS]
    n, *found = df.agg(F.count(x), *parts).first()
    for (bound, unit), (above, below, least) in zip(UNITS, found):
        if 2 * above > n or (above and 2 * above == n and (below + least) / 2 > bound):
            return unit
    return "s"


def epoch_to_time(x: Column, unit: str) -> Column:
    if unit == "ns":
        whole = x.cast("long")
        return F.timestamp_micros(F.call_function("div", whole - F.pmod(whole, F.lit(1000)), F.lit(1000)))
    if unit == "s":
        return F.timestamp_seconds(x)
    return {"us": F.timestamp_micros, "ms": F.timestamp_millis}[unit](x.cast("long"))


def parse_time(text: Column) -> Column:
    """ISO 8601 or one of FORMATS, as UTC; null if it is neither."""
    t = F.trim(text)
    return F.coalesce(t.try_cast("timestamp"), *[F.try_to_timestamp(t, F.lit(f)) for f in FORMATS])


def with_time(df: DataFrame, column: str = "time") -> DataFrame:
    """The time column as a timestamp: as it is, from epoch numbers (as text too), or from text."""
    kind = dict(df.dtypes)[column]
    c = F.col(column)
    if kind.startswith("timestamp") or kind == "date":
        return df.withColumn(column, c.cast("timestamp"))
    if kind == "string":
        numeric = df.agg(F.count(c), F.sum(F.when(F.trim(c).rlike(r"^\d+$"), 1).otherwise(0))).first()
        if not numeric[0] or numeric[0] != numeric[1]:
            return df.withColumn(column, parse_time(c))
        df = df.withColumn(column, F.trim(c).try_cast("long"))
    return df.withColumn(column, epoch_to_time(F.col(column), epoch_unit(df, column)))


def quote_filter(df: DataFrame) -> DataFrame:
    return df.where((F.col("bid") > 0) & (F.col("ask") > 0) & (F.col("bid") <= F.col("ask")))


def finite_filter(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    for c in columns or ["bid", "ask"]:
        df = df.where(~F.isnan(c) & (F.abs(F.col(c)) < INF))
    return df


def dedup(df: DataFrame) -> DataFrame:
    keys = [c for c in ("series_id", "time", "bid", "ask") if c in df.columns]
    return df.dropDuplicates(keys)


def sort_time(df: DataFrame) -> DataFrame:
    return df.orderBy("time", "bid", "ask")


def spread_trim(df: DataFrame, lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Quotes whose spread lies between its quantiles, ends included, if these differ. One row of bounds is broadcast."""
    spread = F.col("ask") - F.col("bid")
    bounds = nearest_quantiles(df.select(spread.alias("spread")), ["spread"], [lower, upper])
    bounds = bounds.agg(F.min(F.when(F.col("share") == lower, F.col("value"))).alias("_low"), F.min(F.when(F.col("share") == upper, F.col("value"))).alias("_high"))
    inside = F.coalesce((F.col("_high") <= F.col("_low")) | ((spread >= F.col("_low")) & (spread <= F.col("_high"))), F.lit(True))
    return df.crossJoin(F.broadcast(bounds)).where(inside).drop("_low", "_high")


def verify(df: DataFrame) -> DataFrame:
    """alias, nulls, prices, times, sanity, copies."""
    out = drop_nulls(alias_columns(df), ["time", "bid", "ask"])
    for c in ("bid", "ask"):
        kind = dict(out.dtypes)[c]
        out = out.withColumn(c, parse_price(F.col(c)) if kind == "string" else F.col(c).cast("double"))
    out = drop_nulls(with_time(out), ["time", "bid", "ask"])
    return dedup(quote_filter(out))


def clean(df: DataFrame, lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    return spread_trim(finite_filter(drop_nulls(df, ["time", "bid", "ask"])), lower, upper)
