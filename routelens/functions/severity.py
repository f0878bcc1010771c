"""How far a latency is above its threshold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest exceedance ratio of each severity.
CRITICAL_RATIO = 3.0
HIGH_RATIO = 2.0
MEDIUM_RATIO = 1.5


def exceedance_multiple(latency: Column, threshold: Column) -> Column:
    """Latency over threshold, 0.0 when the threshold is 0."""
    return F.when(threshold == 0, F.lit(0.0)).otherwise(latency / threshold)


def severity(latency: Column, threshold: Column) -> Column:
    """Severity by exceedance ratio; any latency above a zero threshold is critical."""
    ratio = F.when(threshold == 0, F.lit(float("inf"))).otherwise(latency / threshold)
    return (
        F.when(ratio >= CRITICAL_RATIO, "CRITICAL")
        .when(ratio >= HIGH_RATIO, "HIGH")
        .when(ratio >= MEDIUM_RATIO, "MEDIUM")
        .otherwise("LOW")
    )
