"""Labels and fixed thresholds of the delay model."""

from __future__ import annotations

# Minutes beyond which a flight counts as late, the feed's own minimum delay, and
# the level that precision, recall and f1 of the best trial must each exceed.
LATE_MINUTES = 45
FEED_MINIMUM_DELAY = 30
GATE_LEVEL = 0.65


def delay_label(name: str) -> str:
    """SQL label: 1 when the delay exceeds the threshold, else 0; a missing delay counts as 0."""
    return f"CASE WHEN `{name}` > {LATE_MINUTES} THEN 1 ELSE 0 END"
