"""Parameters of a feature build."""

from __future__ import annotations

from dataclasses import dataclass

from footfall.vocabulary import DST_RANGES, STATES


@dataclass(frozen=True)
class FeatureParams:
    """Which sessions feed the feature table, and how.

    ``session_start`` and ``session_end`` are inclusive ``YYYYMMDD`` days.
    ``lookback_days`` sets the window that is reported per visitor. It filters
    sessions only with ``lookback_filter=True``; by default every session in
    the day range counts, also those after the visitor's last conversion.

    ``states`` and ``dst_ranges`` give local time by offsets and listed summers, which
    end in 2020. ``zones`` (pairs of region and zone name, like ``America/Chicago``)
    replaces both, for any year.
    """

    session_start: str = "20160801"
    session_end: str = "20170430"
    country: str = "United States"
    lookback_days: int = 30
    lookback_filter: bool = False
    states: tuple[tuple[str, int, int], ...] = tuple(STATES)
    dst_ranges: tuple[tuple[str, str], ...] = tuple(DST_RANGES)
    zones: tuple[tuple[str, str], ...] | None = None


TRAINING = FeatureParams()
HOLDOUT = FeatureParams(session_start="20170501", session_end="20170801")
