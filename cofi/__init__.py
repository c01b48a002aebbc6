"""cofi: collaborative filtering over a (user, item, rating) table, as Spark DataFrame plans.

Layout:
  functions/  column expressions (scale, normalized deviation, prediction)
  sources/    loaders for ratings (delimited text, CSV, parquet, derived tables), sinks
  operators/  statistics, similarities, kNN graphs, predictors, recommendation, metrics
  plans/      the named query catalogue and its SQL oracle
  streaming/  scoring a stream of (user, item) requests against a trained model
"""

from cofi.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
