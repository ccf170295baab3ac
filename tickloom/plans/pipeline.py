"""The stages one after the other: DataFrames inside, Parquet and JSON sidecars at the edges."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession

from ..config import PipelineConfig
from ..operators import bars as B
from ..operators import features as X
from ..operators import fit as T
from ..operators import labels as L
from ..operators import quotes as Q
from ..operators import split as S
from ..sources import files
from ..sources.delimited import read_quotes_text


def wrangle(quotes: DataFrame, config: PipelineConfig) -> DataFrame:
    """Raw quotes, under any accepted names, to bars."""
    w = config.wrangle
    return B.tick_bars(Q.clean(Q.verify(quotes), w.lower, w.upper), w.tick_size)


def run(spark: SparkSession, source: str, out: str, config: PipelineConfig = PipelineConfig()) -> dict[str, str]:
    """Quotes at source (delimited, or Parquet) to labelled splits under out; returns the paths.

    Every stage's table is written once and read by the next, so nothing is computed twice and lineage stays short. Sidecars
    (JSON) are written by the driver, so `out` is a path that the driver can write too.
    """
    paths = {name: f"{out}/{name}.parquet" for name in ("bars", "features", "selected")}
    raw = files.scan(spark, source) if source.rstrip("/").endswith(".parquet") else read_quotes_text(spark, source)
    files.sink(wrangle(raw, config), paths["bars"])
    features = X.compute(files.scan(spark, paths["bars"]), config.features)
    files.sink(features, paths["features"])
    stored = files.scan(spark, paths["features"])
    params = T.fit(stored, config.features)
    files.write_json(params, f"{out}/features_params.json")
    files.sink(T.transform(stored, params), paths["selected"])

    parts = S.split(files.scan(spark, paths["selected"]), config.split)
    together = files.parquet_path(f"{out}/splits")
    parts.write.mode("overwrite").partitionBy("split").option("compression", "zstd").parquet(together)
    parts = files.scan(spark, together)
    info = [r.asDict() for r in S.split_info(parts).collect()]
    S.check_splits(info)
    for name in S.ORDER:
        paths[name] = f"{out}/{name}_labelled.parquet"
    files.write_json(S.manifest(info, config.split, files.fingerprint(paths["selected"]), S.time_column(parts), {n: paths[n] for n in S.ORDER}), f"{out}/split_manifest.json")

    stats = {}
    for name in S.ORDER:
        part = L.reindex(parts.where(parts["split"] == name).drop("split"))
        files.sink(L.label(part, config.labels), paths[name])
        stats[name] = L.label_stats(files.scan(spark, paths[name])).first().asDict()
    files.write_json({"params": dataclasses.asdict(config.labels), "stats": stats}, f"{out}/labels.json")
    return paths
