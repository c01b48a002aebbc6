from pyspark.sql import functions as F

from cofi.operators import knn, predict, stats
from cofi.plans.catalog import Fixture
from cofi.streaming import KnnModel, score_stream


def test_stream_scoring_matches_batch(spark, tmp_path):
    fx = Fixture(spark, "/root/testdata/sf0.001", "e")
    model = KnnModel.fit(fx.train, 10)
    src = str(tmp_path / "requests")
    fx.test.write.parquet(src)
    stream = spark.readStream.schema(fx.test.schema).parquet(src)
    q = score_stream(model, stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = {(r.user_id, r.item_id): r.prediction
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = predict.pred_weighted(fx.train, fx.test, fx.dev, knn.as_edges(fx.knn(10)))
    want = {(r.user_id, r.item_id): r.prediction for r in batch.collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
