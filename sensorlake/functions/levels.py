"""Alert levels, per-type bands and valid ranges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Level names, thresholds and bands must equal the source system's.
NORMAL, WARNING, CRITICAL = "NORMAL", "ADVERTENCIA", "CRITICA"
WARN_ABOVE, CRITICAL_ABOVE = 60.0, 80.0
BANDS = {
    "temperatura": {NORMAL: (50.0, 75.0), WARNING: (76.0, 89.0), CRITICAL: (90.0, 100.0)},
    "presion": {NORMAL: (20.0, 40.0), WARNING: (41.0, 59.0), CRITICAL: (60.0, 80.0)},
    "vibracion": {NORMAL: (1.0, 5.0), WARNING: (6.0, 9.0), CRITICAL: (10.0, 15.0)},
    "nivel_agua": {NORMAL: (10.0, 18.0), WARNING: (19.0, 24.0), CRITICAL: (25.0, 35.0)},
}
VALID_RANGES = {
    "temperatura": (50.0, 100.0),
    "presion": (20.0, 80.0),
    "vibracion": (1.0, 15.0),
    "nivel_agua": (10.0, 35.0),
}


def classify_fixed(value: Column, warn: float = WARN_ABOVE, critical: float = CRITICAL_ABOVE) -> Column:
    """Level by two strict thresholds, blind to the sensor type; a missing value (NULL or NaN) has none."""
    present = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return F.when(present > critical, CRITICAL).when(present > warn, WARNING).when(present.isNotNull(), NORMAL)


def _cases(pairs: list[tuple[Column, Column]]) -> Column:
    head, *rest = pairs
    return reduce(lambda case, pair: case.when(*pair), rest, F.when(*head))


def classify_by_type(sensor_type: Column, value: Column, bands: dict = BANDS) -> Column:
    """Level by the closed bands of the type; NULL in the gaps between bands."""
    return _cases([
        ((sensor_type == kind) & value.between(lo, hi), F.lit(level))
        for kind, levels in bands.items()
        for level, (lo, hi) in levels.items()
    ])


def in_range(sensor_type: Column, value: Column, ranges: dict = VALID_RANGES) -> Column:
    """True inside the type's closed range; false outside it and for an unknown type."""
    checks = [((sensor_type == kind), value.between(lo, hi)) for kind, (lo, hi) in ranges.items()]
    return F.coalesce(_cases(checks), F.lit(False))


def validate_range(df: DataFrame, ranges: dict = VALID_RANGES, mode: str = "flag") -> DataFrame:
    """``mode="drop"`` keeps rows in range, ``mode="flag"`` adds ``in_range``."""
    ok = in_range(F.col("sensor_type"), F.col("value"), ranges)
    if mode == "drop":
        return df.where(ok)
    if mode == "flag":
        return df.withColumn("in_range", ok)
    raise ValueError(f"unknown mode {mode!r}")


def threshold_deviation(df: DataFrame, per_type: bool = False, bands: dict = BANDS,
                        critical: float = CRITICAL_ABOVE) -> DataFrame:
    """Add ``deviation``: value minus the critical bound, or minus the type's normal top."""
    bound = F.lit(critical)
    if per_type:
        bound = _cases([(F.col("sensor_type") == kind, F.lit(levels[NORMAL][1])) for kind, levels in bands.items()])
    return df.withColumn("deviation", F.col("value") - bound)


def is_alert(level: Column) -> Column:
    """Any level but the normal one; a reading without level is no alert."""
    return F.coalesce(level != NORMAL, F.lit(False))
