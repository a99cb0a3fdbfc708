"""Fitted transforms applied to a file stream.

The reference is batch only. What carries over to streams is the fit/transform split: a model fitted on a
batch table (a one-hot dictionary, target statistics, lexicon, blend weights) is a static DataFrame, and
every ``transform`` in this package that is a projection or an equi-join against such a table is a valid
stream-static plan. New rows arriving as files are encoded or blended as they land, with the same code.

Only stateless steps are used here (projections and stream-static joins): no aggregation state grows with
the number of ids. Progress and output are kept in the shared checkpoint folder, so a restarted query resumes
where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_dir


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_transform(spark: SparkSession, source: DataFrame, transform: Callable[[DataFrame], DataFrame],
                  sink_path: str, checkpoint: str | None = None, available_now: bool = True,
                  fmt: str = "parquet"):
    """Start ``transform(source)`` as a streaming query appending to ``sink_path``. With ``available_now``
    the query processes what is there and stops (a restartable incremental batch)."""
    out = transform(source)
    w = (out.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint or scratch_dir(spark, "stream-ckpt"))
         .option("path", sink_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def blend_stream(scores: DataFrame, weights: DataFrame) -> DataFrame:
    """Per-row weighting of streamed ``(model, id, score)`` rows against a static ``(model, w)`` table:
    emits ``(model, id, score, w)`` ready for a batch ``sum(w*score)/sum(w)`` per id. The weights table has one
    row per model, so it is broadcast."""
    return scores.join(F.broadcast(weights), "model")
