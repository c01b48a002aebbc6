from cofi.streaming.scoring import KnnModel, score_stream

__all__ = ["KnnModel", "score_stream"]
