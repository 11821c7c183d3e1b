"""Names and order of the feature table's columns."""

from __future__ import annotations

from footfall.vocabulary import INDICATORS, VISITOR

LABEL = "labels"

USER_COLUMNS = [
    VISITOR,
    LABEL,
    "first_conversion_session",
    "last_visit_timestamp",
    "last_conversion_timestamp",
    "front_lookback_window",
    "end_lookback_window",
]

RATIOS = ["timeOnSite_per_visit", "timeOnSite_per_page"]
FLAGS = [ind.column for ind in INDICATORS]
HABITS = ["day", "daypart"]
FEATURES = [*RATIOS, *FLAGS, *HABITS]

# Known only afterwards, or no property of the visitor: not for training.
NOT_FOR_TRAINING = [c for c in USER_COLUMNS if c != LABEL]

# Column names that are kept as they always were, and how they should be spelt.
CORRECT_NAMES = {
    "channelGrouping_Referal": "channelGrouping_Referral",
    "geoNetworkmetro_ButteBozemannMt": "geoNetworkmetro_ButteBozemanMT",
    "geoNetworkmetro_OdahoFallsPocatelloID": "geoNetworkmetro_IdahoFallsPocatelloID",
}
