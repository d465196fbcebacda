"""Structured Streaming variants of the row-wise steps.

The modelled project has no streaming source, state or watermark; what
carries over to a stream are the stateless per-row steps (building join,
calendar parts, country, holiday flag, unit rules) and the scoring of
arriving rows with fitted models (micro-batches via ``foreachBatch``).  Gap fills and grid
joins need a whole interval and stay batch operators."""

from wattlake.streaming.features import meter_feature_stream, run_available_now
from wattlake.streaming.scoring import score_stream

__all__ = ["meter_feature_stream", "run_available_now", "score_stream"]
