"""Request scoring on a stream (M5 as Structured Streaming).

Each request carries its own readings (at most 5), so scoring is stateless: no watermark
and no state store; the batch operator :func:`wearline.plans.scoring.score_requests` runs
unchanged on a streaming DataFrame in append mode. The stream's checkpoint goes under the
cluster's shared ``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wearline.constants import KEPT_SENSORS, ROLLING_WINDOW
from wearline.plans.scoring import score_requests
from wearline.session import checkpoint_dir
from wearline.sources.requests import REQUEST


def read_request_stream(spark: SparkSession, path: str, fmt: str = "json", max_files_per_trigger: int | None = None) -> DataFrame:
    """Requests arriving as files (JSON lines ``{"request_id": ..., "recent_cycles": [...]}``)."""
    reader = spark.readStream.schema(REQUEST).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def score_request_stream(
    stream: DataFrame,
    model: PipelineModel,
    params: DataFrame | dict,
    sensors: Sequence[str] = KEPT_SENSORS,
    n: int = ROLLING_WINDOW,
) -> DataFrame:
    """The scored stream: ``request_id, predicted_rul, cycles_used, error``.

    Pass ``params`` as the dict from :func:`wearline.operators.scaling.scaler_literals` (or a
    static parameter table, read once here) so the streaming plan holds literals only.
    """
    return score_requests(stream, model, params, sensors, n)


def start_scoring(
    scored: DataFrame,
    sink_path: str,
    name: str = "request_scoring",
    checkpoint_location: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Append scored requests to a Parquet directory; restartable from its checkpoint."""
    spark = scored.sparkSession
    if checkpoint_location is None:
        base = checkpoint_dir(spark)
        if base is None:
            raise ValueError("no checkpoint location given and spark.checkpoint.dir is not set")
        checkpoint_location = f"{base.rstrip('/')}/streams/{name}"
    writer = scored.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_location)
    writer = writer.queryName(name)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(sink_path)
