"""Response-log analysis on a stream of documents (Structured Streaming).

Response documents arrive as files (``conv_id, turn, role, response``). The
per-response analysis (J6 usage, J7 wide row) is a projection of each
document row — no aggregation, no join — so the streaming query is stateless:
no watermark is needed, nothing accumulates in the state store, and the file
sink with a checkpoint gives exactly-once output. ``availableNow`` processes
what has arrived and stops, the incremental batch form; a processing-time
trigger keeps it running.

The checkpoint location must be on shared storage on a cluster; by default it
is a sub-folder of the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from churnlens.plans import responses
from churnlens.session import ensure_checkpoint_dir

DOC_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("response", T.StringType()),
])


def start_response_stream(spark: SparkSession, source_dir: str, sink_dir: str,
                          checkpoint_dir: str | None = None, fmt: str = "parquet",
                          available_now: bool = True,
                          processing_time: str = "1 minute") -> StreamingQuery:
    """Analyse response documents as they land in ``source_dir``; write J7 rows."""
    ckpt = checkpoint_dir or os.path.join(ensure_checkpoint_dir(spark), "response-stream")
    docs = spark.readStream.schema(DOC_SCHEMA).format(fmt).load(source_dir)
    out = responses.wide(docs)
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ckpt).option("path", sink_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time)
    return w.start()
