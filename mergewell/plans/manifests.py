"""Manifests beside tables: which settings made them, and whether they are still whole."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from mergewell.sources import storage


def _beside(target: str) -> str:
    return f"{target}.manifest.json"


def write(spark: SparkSession, target: str, stage: str, key: str, config: str, rows: int | None = None, adopted: bool = False, **extra: object) -> dict:
    """Records the files of a finished table; the manifest is written last, so one that is there tells of a whole table."""
    found = {"stage": stage, "key": key, "config": config, "rows": rows, "adopted": adopted, "files": storage.sizes(spark, target), "written": datetime.now(timezone.utc).isoformat(), "extra": extra}
    storage.write_json(spark, _beside(target), found)
    return found


def read(spark: SparkSession, target: str) -> dict | None:
    found = storage.read_json(spark, _beside(target))
    return found if isinstance(found, dict) and "config" in found else None


def state(spark: SparkSession, target: str, config: str) -> str:
    """``done``, ``stale`` (made by other settings), ``partial`` (files differ), ``unknown`` (no manifest) or ``missing``."""
    there, found = storage.sizes(spark, target), read(spark, target)
    if found is None:
        return "unknown" if there else "missing"
    if not there or there != found["files"]:
        return "partial"
    return "done" if found["config"] == config else "stale"


def valid(spark: SparkSession, target: str, config: str) -> bool:
    return state(spark, target, config) == "done"


def invalidate(spark: SparkSession, target: str) -> bool:
    """Forgets the manifest and keeps the data; whether there was one."""
    return storage.delete(spark, _beside(target))


def reset(spark: SparkSession, target: str) -> None:
    """Removes the manifest, then the data."""
    invalidate(spark, target)
    storage.delete(spark, target)


def adopt(spark: SparkSession, target: str, stage: str, config: str, check: Callable[[DataFrame], str]) -> bool:
    """Takes a table without a manifest as this stage's if ``check`` finds no fault (an empty string)."""
    if state(spark, target, config) != "unknown" or check(spark.read.parquet(target)):
        return False
    write(spark, target, stage, "", config, adopted=True)
    return True


def pinned(spark: SparkSession, folder: str, config: str, make: Callable[[], list]) -> list:
    """A list of parts that stays the same when a run starts again; parts of other settings go first."""
    path = f"{folder}/plan.json"
    found = storage.read_json(spark, path)
    if isinstance(found, dict) and found.get("config") == config:
        return found["parts"]
    if found is not None or storage.exists(spark, folder):
        storage.delete(spark, folder)
    parts = make()
    storage.write_json(spark, path, {"config": config, "parts": parts})
    return parts


def once(spark: SparkSession, target: str, stage: str, config: str, make: Callable[[], DataFrame], by: tuple[str, ...] = (), partition: str | None = None, force: bool = False) -> DataFrame:
    """The table at ``target``, made only if it is not there whole and by these settings."""
    if force or not valid(spark, target, config):
        reset(spark, target)
        storage.write_table(make(), target, by, partition)
        write(spark, target, stage, "", config)
    return spark.read.parquet(target)
