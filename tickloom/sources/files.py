"""Parquet at the edges of the stages, and sidecar files written whole or not at all."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

FINGERPRINT_BYTES = 64 << 20


def scan(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def sink(df: DataFrame, path: str, files: int | None = None) -> str:
    """zstd, committed by Spark's protocol; files: coalesce to so many."""
    path = parquet_path(path)
    (df.coalesce(files) if files else df).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def parquet_path(path: str) -> str:
    path = str(path)
    return path if path.endswith(".parquet") else path.rstrip("/") + ".parquet"


def ensure_dir(path: str) -> str:
    Path(path).mkdir(parents=True, exist_ok=True)
    return str(path)


def write_json(value: dict, path: str) -> None:
    """Sorted keys, indented, by a rename, so that readers see the old or the new file."""
    ensure_dir(str(Path(path).parent))
    handle, part = tempfile.mkstemp(dir=Path(path).parent, suffix=".part")
    try:
        with os.fdopen(handle, "w") as f:
            json.dump(value, f, indent=2, sort_keys=True, default=str)
        os.replace(part, path)
    except BaseException:
        if os.path.exists(part):
            os.unlink(part)
        raise


def fingerprint(path: str) -> dict:
    """sha256 of the first 64 MiB, size and time of change; of a folder, of its parts' names and fingerprints in order."""
    at = Path(path)
    if at.is_dir():
        parts = sorted(p for p in at.rglob("*") if p.is_file() and not p.name.startswith(("_", ".")))
        digest = hashlib.sha256("".join(f"{p.relative_to(at)}:{fingerprint(str(p))['sha256']}\n" for p in parts).encode()).hexdigest()
        return {"path": str(at), "sha256": digest, "size": sum(p.stat().st_size for p in parts), "mtime": max((p.stat().st_mtime for p in parts), default=0.0)}
    digest, left = hashlib.sha256(), FINGERPRINT_BYTES
    with at.open("rb") as f:
        while left and (block := f.read(min(left, 1 << 20))):
            digest.update(block)
            left -= len(block)
    return {"path": str(at), "sha256": digest.hexdigest(), "size": at.stat().st_size, "mtime": at.stat().st_mtime}
