"""Scoring of requests as they arrive: each micro-batch goes through the batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillcast.operators import requests as rq
from tillcast.plans.scoring import Artefacts, request_features, request_outcomes, score_features
from tillcast.plans.training import TrainingSpec
from tillcast.session import staged
from tillcast.sources.sinks import begin_batch, commit_batch, write_log

BODY_SCHEMA = "request_id STRING, request_date DATE, body STRING"


def request_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(BODY_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(path)


def start_scoring(
    bodies: DataFrame, artefacts: Artefacts, spec: TrainingSpec, output: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Write predictions, outcomes, rejected requests and the requests themselves as JSON under ``output``, a folder per batch.

    Requests are independent, so no state is kept between batches. A failed batch is read again from the
    checkpointed offsets under the same number and replaces what it wrote before: each row is there once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch, artefacts, spec, output, batch_id)

    writer = bodies.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def score_batch(bodies: DataFrame, artefacts: Artefacts, spec: TrainingSpec, output: str, batch_id: int | str) -> None:
    """Score one table of request texts and log requests, predictions, rejected requests and the outcome of every request and
    day asked for; a batch run calls it as well. ``read_batches`` shows the four logs of a batch together or not at all."""
    spark = bodies.sparkSession
    begin_batch(spark, output, batch_id)
    with staged(rq.parse_requests(bodies), "requests") as requests:
        checked = rq.check_requests(requests)
        with staged(request_features(rq.accepted(checked), spec), "features") as features:
            logs = {
                "requests": bodies,
                "predictions": score_features(features, artefacts, spec),
                "rejected": rq.rejected(checked),
                "outcomes": request_outcomes(checked, features),
            }
            for name, rows in logs.items():
                write_log(rows, f"{output}/{name}", batch_id)
    commit_batch(spark, output, batch_id, list(logs))
