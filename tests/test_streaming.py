"""Structured Streaming availableNow ingest (I1): each file exactly once."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from plazalens.operators.clean import epoch_ms_to_date
from plazalens.session import scratch_path
from plazalens.streaming.ingest import ingest_available_now

SCHEMA = StructType([StructField("event_id", LongType()), StructField("time", LongType())])


def test_available_now_reruns_and_new_files(spark):
    base = scratch_path(spark, "t-stream")
    src, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/_ckpt"
    spark.range(0, 50).select(F.col("id").alias("event_id"), (F.col("id") * 86_400_000).alias("time")) \
        .repartition(3).write.json(f"{src}/batch1")

    def transform(s):
        return s.select("event_id", epoch_ms_to_date("time").alias("date"))

    ingest_available_now(spark, src, SCHEMA, out, ckpt, transform, max_files_per_trigger=1)
    assert spark.read.parquet(out).count() == 50
    ingest_available_now(spark, src, SCHEMA, out, ckpt, transform)  # nothing new
    assert spark.read.parquet(out).count() == 50
    spark.range(50, 80).select(F.col("id").alias("event_id"), (F.col("id") * 86_400_000).alias("time")) \
        .write.json(f"{src}/batch2")
    ingest_available_now(spark, src, SCHEMA, out, ckpt, transform)
    rows = spark.read.parquet(out)
    assert rows.count() == 80 and rows.select("event_id").distinct().count() == 80
    assert rows.filter("event_id = 1").first().date.isoformat() == "1970-01-02"
