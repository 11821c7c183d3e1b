"""Purchase propensity of web visitors, as Spark DataFrame jobs."""

from footfall.params import HOLDOUT, TRAINING, FeatureParams
from footfall.plans.feature_table import feature_table, training_projection
from footfall.sources.sessions import read_sessions, write_sessions

__all__ = [
    "HOLDOUT",
    "TRAINING",
    "FeatureParams",
    "feature_table",
    "read_sessions",
    "training_projection",
    "write_sessions",
]
