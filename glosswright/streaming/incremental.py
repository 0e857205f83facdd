"""New documents as a stream: profiled batch by batch, each item once per content (C1 for streams)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from glosswright.functions import hashing, text
from glosswright.plans.pipeline import Manifest


def profile_stream(spark: SparkSession, source: str, schema: str, out: str, manifest: Manifest, checkpoint: str, id_col: str = "doc_id", text_col: str = "text") -> StreamingQuery:
    """Profiles the Parquet files that arrive in *source*; items whose content was done before are passed over."""

    def batch(rows: DataFrame, number: int) -> None:
        items = rows.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"), hashing.text_hash(F.coalesce(F.col(text_col), F.lit(""))).alias("input_hash"))
        fresh = manifest.misses("analyze", items.dropDuplicates(["item_id"])).persist()
        done = text.with_profile(fresh.where("text is not null").select("item_id", "text"), "text").drop("text")
        done.write.mode("append").parquet(out)
        manifest.mark("analyze", fresh.select("item_id", F.when(F.col("text").isNull(), "skipped").otherwise("success").alias("status"), "input_hash", F.when(F.col("text").isNull(), "no_text").alias("reason")))
        fresh.unpersist()

    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(source)
    return reader.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
