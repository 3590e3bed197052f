"""Predicting a stream of texts with a model fitted on the labelled ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from opinia.plans.training import TextSettings, prepare_terms


def score_stream(
    texts: DataFrame, model, output: str, checkpoint: str, text: TextSettings = TextSettings()
) -> StreamingQuery:
    """Score every micro-batch of (doc_id, text) like an evaluation table and write (doc_id, predicted) as parquet.

    Documents are scored one by one, so no state is kept between batches. Each batch has a folder of its own that is
    overwritten when the batch is run again, so a restart leaves every document scored once.
    """

    def score(batch: DataFrame, number: int) -> None:
        predicted = model.predict(prepare_terms(batch.select("doc_id", "text"), text))
        predicted.select("doc_id", "predicted").write.mode("overwrite").parquet(f"{output}/batch={number}")

    return (
        texts.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
