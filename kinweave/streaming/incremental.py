"""New records of a stream against a fixed set of S1 records (an addition; linkage itself is a batch job)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kinweave.plans.linkage import link, normalize


def link_stream(arriving: DataFrame, s1: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch of raw records, normalized and linked with ``s1`` (normalized), appended as Parquet.

    A batch's files are named by its number, so that a batch run again replaces its own.
    """

    def each(batch: DataFrame, number: int) -> None:
        link(s1, normalize(batch)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return arriving.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
