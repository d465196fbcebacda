"""Scoring as a stream: scoring rows arrive as files; every micro-batch is
featurised against the (batch) processed weather and building tables and
scored with the fitted per-meter models.

Exactly-once output: each micro-batch overwrites its own ``batch_id=N``
folder, so a batch replayed after a failure rewrites the same files; the
stream's progress lives in a checkpoint in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCORING_SCHEMA = "row_id bigint, building_id bigint, meter int, timestamp timestamp_ntz"


def score_stream(spark: SparkSession, source_dir: str, weather_done: DataFrame, building: DataFrame,
                 bundle, sink_dir: str, checkpoint_dir: str, weather_rows: int | None = None,
                 schema: str = SCORING_SCHEMA, max_files_per_trigger: int | None = None,
                 available_now: bool = True):
    """Start the scoring stream; returns the StreamingQuery (already
    finished when ``available_now``).

    ``bundle`` (a ``ModelBundle``) holds the training mean area per meter: a
    micro-batch scaled by its own mean would depend on how the files are cut."""
    from wattlake.plans import pipelines as pl

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(source_dir)
    # static inputs are the same for every micro-batch: materialise them once
    # (reliable checkpoints in the shared folder; weather is sites x hours)
    from wattlake.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    weather_done = weather_done.checkpoint(eager=True)
    clean_building = pl.building_clean(building).checkpoint(eager=True)

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        feats = pl.feature_pipeline(batch, weather_done, clean_building, feats=pl.MODEL_FEATURES,
                                    keep=("row_id",), weather_rows=weather_rows)
        pred = pl.prediction_pipeline(feats, bundle)
        pred.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")

    w = rows.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
