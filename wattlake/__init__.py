"""Spark-native building-energy analytics: meter readings, site weather and
building metadata as DataFrames; profiling, gap filling, joins, features,
encoders and Spark ML models, all as lazy DataFrame plans."""

from wattlake.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
