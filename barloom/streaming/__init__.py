from barloom.streaming.bars import bar_stream
from barloom.streaming.features import feature_batches, reach_of, score_features, with_reach
from barloom.streaming.scoring import score_batches, score_stream

__all__ = ["bar_stream", "feature_batches", "reach_of", "score_batches", "score_features", "score_stream", "with_reach"]
