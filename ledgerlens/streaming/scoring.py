"""Scoring a stream of (date, region, product) rows with fitted boosters.

Fitted models score row by row, so the batch scorer applies unchanged to a streaming DataFrame; the
calendar features are plain expressions as well. Rows whose date does not parse are dropped, as in
batch scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlens.modeling.boosting import Booster
from ledgerlens.modeling.models import score


def score_stream(models: dict[str, Booster], stream: DataFrame) -> DataFrame:
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame (spark.readStream...)")
    return score(models, stream.select("date", "region", "product"))


def start_scoring(models: dict[str, Booster], stream: DataFrame, sink_path: str, checkpoint_path: str,
                  trigger_once: bool = False):
    """Append predictions to a parquet sink; the checkpoint folder makes the query restartable."""
    writer = (score_stream(models, stream).writeStream.format("parquet").option("path", sink_path)
              .option("checkpointLocation", checkpoint_path).outputMode("append"))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
