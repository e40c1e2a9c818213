"""Log chosen attributes only (no payload)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def attribute_log(df: DataFrame, cols: Sequence[str], path: str | None = None) -> DataFrame:
    """The chosen columns only; appended as JSON lines to ``path`` if given
    (a batch frame; a stream is logged by ``attribute_log_stream``)."""
    out = df.select(*cols)
    if path:
        if df.isStreaming:
            raise ValueError("a stream is logged with attribute_log_stream")
        out.write.mode("append").json(path)
    return out


def attribute_log_stream(df: DataFrame, cols: Sequence[str], path: str, checkpoint: str) -> StreamingQuery:
    """The chosen columns of a stream, appended as JSON lines to ``path`` by
    Spark's file sink (each micro-batch once); drains what is there."""
    return (df.select(*cols).writeStream.format("json").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
