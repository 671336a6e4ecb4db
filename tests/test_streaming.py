"""The streaming response analysis equals the batch one, batch after batch."""
import tempfile

from churnlens.plans import responses
from churnlens.sources.responses import response_documents
from churnlens.streaming.logs import start_response_stream


def test_stream_matches_batch(spark):
    conv = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    docs = response_documents(conv)
    src, sink, ckpt = (tempfile.mkdtemp(prefix=f"churnlens-{n}-") for n in ("src", "sink", "ck"))
    first, second = docs.filter("conv_id % 2 = 0"), docs.filter("conv_id % 2 = 1")
    first.write.mode("append").parquet(src)
    start_response_stream(spark, src, sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == first.count()
    second.write.mode("append").parquet(src)           # a later arrival
    start_response_stream(spark, src, sink, ckpt).awaitTermination()
    got = spark.read.parquet(sink)
    exp = responses.wide(docs)
    assert got.count() == exp.count()
    assert got.exceptAll(exp.select(*got.columns)).count() == 0
