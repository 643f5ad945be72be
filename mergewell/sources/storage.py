"""Files and tables on the storage that the cluster shares: complete or absent, never half written.

All access goes through Spark's file systems, so a path may be local or in any
store that Spark reads.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from io import BytesIO

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("mergewell")


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.delete(where, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Moves ``old`` to ``new``, which is replaced."""
    fs, where = _at(spark, new)
    fs.mkdirs(where.getParent())
    fs.delete(where, True)
    if not fs.rename(_at(spark, old)[1], where):
        raise OSError(f"{old} could not be moved to {new}")


def sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """The data files under a path with their bytes, without the names of hidden ones."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return {}
    found, files = {}, fs.listFiles(where, True)
    root = fs.getFileStatus(where).getPath().toString()
    while files.hasNext():
        status = files.next()
        name = status.getPath().toString().removeprefix(root).lstrip("/") or status.getPath().getName()
        if not name.rsplit("/", 1)[-1].startswith((".", "_")):
            found[name] = status.getLen()
    return found


def free_bytes(spark: SparkSession, path: str) -> int:
    fs, where = _at(spark, path)
    while not fs.exists(where):
        where = where.getParent()
    return fs.getStatus(where).getRemaining()


def require_space(spark: SparkSession, path: str, need: int, margin: int = 0, what: str = "") -> None:
    """Raises before anything is written if the storage has less than ``need`` and ``margin`` bytes left."""
    if (left := free_bytes(spark, path)) < need + margin:
        raise OSError(f"{what or path} needs {need + margin} bytes, {left} are free")


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, where = _at(spark, beside)
    out = fs.create(where, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    rename(spark, beside, path)


def read_bytes(spark: SparkSession, path: str) -> bytes | None:
    """None if there is no such file."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(fs.open(where)))


def write_json(spark: SparkSession, path: str, value: object) -> None:
    write_bytes(spark, path, json.dumps(value, indent=2, sort_keys=True, default=str).encode())


def read_json(spark: SparkSession, path: str) -> object | None:
    """None if the file is absent or unreadable."""
    try:
        data = read_bytes(spark, path)
        return None if data is None else json.loads(data)
    except ValueError:
        return None


def write_table(df: DataFrame, path: str, by: tuple[str, ...] = (), partition: str | None = None) -> DataFrame:
    """Parquet that is there as a whole or not at all, and the table read again.

    ``by`` deals whole groups of its first column to tasks and sorts by all, so
    that ranges of it are skipped by the statistics of files; ``partition``
    gives a folder for each value.
    """
    spark, beside = df.sparkSession, f"{path}.{uuid.uuid4().hex}.tmp"
    if by:
        df = df.repartition(*([partition] if partition else []), by[0]).sortWithinPartitions(*([partition] if partition else []), *by)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(beside)
    rename(spark, beside, path)
    return spark.read.parquet(path)


def write_parts(parts: list[DataFrame], path: str) -> int:
    """Several tables of one schema as one, and its number of rows."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return write_table(out, path).count()


def read_range(spark: SparkSession, path: str, first: str, last: str, column: str = "s1_id") -> DataFrame:
    """Rows with ``first <= column < last``; files and row groups outside are not read."""
    return spark.read.parquet(path).where((f"{column} >= '{first}' and {column} < '{last}'"))


def described(spark: SparkSession, path: str) -> dict:
    """Number of rows, from the footers of the files, and the columns of a table."""
    df = spark.read.parquet(path)
    return {"rows": df.count(), "columns": dict(df.dtypes)}


def pack_files(spark: SparkSession, paths: dict[str, str], target: str) -> None:
    """A zip of small files: name inside → path. A folder of text parts becomes one file."""
    sink = BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as z:
        for name, path in sorted(paths.items()):
            files = sizes(spark, path)
            whole = list(files) == [path.rsplit("/", 1)[-1]]
            data = read_bytes(spark, path) if whole else b"".join(read_bytes(spark, f"{path}/{f}") for f in sorted(files))
            z.writestr(name, data)
    write_bytes(spark, target, sink.getvalue())


def log_to(path: str | None = None, level: int = logging.INFO) -> logging.Logger:
    """Messages of the driver to the console, and to a local file if one is named."""
    log.setLevel(level)
    known = {getattr(h, "baseFilename", "") for h in log.handlers}
    if "" not in known:
        log.addHandler(logging.StreamHandler())
    if path and path not in known:
        log.addHandler(logging.FileHandler(path, encoding="utf-8"))
    for h in log.handlers:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    return log


@contextmanager
def timed(what: str) -> Iterator[None]:
    start = time.perf_counter()
    log.info("%s", what)
    try:
        yield
    except Exception:
        log.exception("%s failed after %.1f s", what, time.perf_counter() - start)
        raise
    log.info("%s took %.1f s", what, time.perf_counter() - start)
