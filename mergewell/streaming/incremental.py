"""Matching of records that arrive: each micro-batch meets the static queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from mergewell.functions.normalize import normalize_records
from mergewell.operators.retrieval import candidates
from mergewell.operators.vectors import Channel


def match_stream(arrivals: DataFrame, queries: DataFrame, known: DataFrame, of: tuple[Channel, ...], target: str, checkpoint: str) -> StreamingQuery:
    """Writes the candidates of each batch of raw records under ``target/batch=<n>``.

    Term weights are those of the fixed collection ``known``, so the cosine of a
    pair does not depend on which records arrive together; the K best of a query
    are those of a batch. Terms that ``known`` lacks weigh nothing. A batch that
    is repeated after a failure overwrites its own folder, so each counts once.
    """

    def write(batch: DataFrame, number: int) -> None:
        pairs = candidates(queries, normalize_records(batch), of, corpus=known)
        pairs.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
