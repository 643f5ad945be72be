"""Queries that go through files: what is written is read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergewell.operators.lineage import shared_folder
from mergewell.plans import stages
from mergewell.sources import storage, tables


def _path(df: DataFrame, name: str) -> str:
    return f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


def sources(raw: DataFrame) -> DataFrame:
    """Raw records as tab-separated files and back, with the check of keys; what is empty comes back as null."""
    path = _path(raw, "source")
    tables.write_tsv(raw.select(*tables.SOURCE), path)
    return tables.read_source(raw.sparkSession, path)


def lists(ids: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairs as comma lists in files and back."""
    path = _path(ids, "truth")
    tables.write_tsv(tables.id_lists(ids, truth), path)
    return tables.read_truth(ids.sparkSession, path)


def line_count(ids: DataFrame, truth: DataFrame) -> DataFrame:
    """How many lines a list file has below its header."""
    path = _path(ids, "lines")
    tables.write_tsv(tables.id_lists(ids, truth).coalesce(1), path)
    return ids.sparkSession.createDataFrame([(tables.tsv_rows(ids.sparkSession, path),)], "n long")


def ranged(pairs: DataFrame, first: str, last: str) -> DataFrame:
    """A range of queries from a table in which their groups are sorted."""
    path = _path(pairs, "pairs")
    storage.write_table(pairs, path, by=("s1_id", "t_id"))
    return storage.read_range(pairs.sparkSession, path, first, last)


def together(parts: list[DataFrame]) -> DataFrame:
    """Several tables written as one, and read again by country."""
    path = _path(parts[0], "parts")
    storage.write_parts(parts, path)
    return tables.read_records(parts[0].sparkSession, [path])


def slice_of(records: DataFrame, truth: DataFrame, share: float = 0.3, distractors: float = 0.2) -> DataFrame:
    """``entity_id`` of a slice for development."""
    rows = {n: records.where(F.col("entity_id").startswith(f"S{n}-")).select("entity_id") for n in (1, 2, 3)}
    parts = stages.sliced(rows, truth, share, distractors)
    return parts[1].unionByName(parts[2]).unionByName(parts[3])
