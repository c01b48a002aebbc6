"""Score a stream of (user, item) requests with the kNN predictor.

The model (deviations, user averages, the kNN graph) is fitted once on a static ratings
table and written to the checkpoint folder; each micro-batch of requests is then scored by
the same batch plan as ``predict.pred_weighted`` (a stream-static join done per batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cofi.operators import knn, predict, stats
from cofi.session import materialize


class KnnModel:
    def __init__(self, enriched: DataFrame, graph: DataFrame):
        self.enriched = enriched
        self.graph = graph
        self.user_avg = enriched.groupBy("user_id").agg(F.max("user_avg").alias("user_avg"))

    @classmethod
    def fit(cls, train: DataFrame, k: int) -> "KnnModel":
        enriched = materialize(stats.enrich(train), "model_enriched")
        graph = materialize(
            knn.knn_graph(enriched.select("user_id", "item_id", "rhat"), k,
                          stats.n_users(train) - 1), "model_knn")
        return cls(enriched, graph)

    def predict(self, requests: DataFrame) -> DataFrame:
        """(user_id, item_id, rating, prediction) for every request row."""
        return predict.pred_weighted(self.enriched, requests, self.enriched, self.graph, averages=self.user_avg)


def score_stream(model: KnnModel, requests: DataFrame, out_path: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Run ``model.predict`` on every micro-batch of the streaming DataFrame ``requests``.

    Each batch is written to ``out_path/batch=<id>`` with overwrite, so replaying a batch
    after a failure replaces its output instead of appending twice.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        model.predict(batch).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={batch_id}")

    writer = requests.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
