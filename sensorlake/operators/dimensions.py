"""Dimensions besides time and sensor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.levels import BANDS, CRITICAL, NORMAL, WARNING
from ..schemas import DIM_ALERT
from .ordered import with_surrogate_key

_ACTIONS = {NORMAL: "none", WARNING: "watch", CRITICAL: "inspect"}


def build_alert_dim(spark: SparkSession, bands: dict = BANDS, actions: dict = _ACTIONS) -> DataFrame:
    """One row per sensor type and level: the band, its text and the action to take."""
    rows = [
        (kind, level, lo, hi, f"{lo:g}-{hi:g}", actions[level])
        for kind, levels in bands.items() for level, (lo, hi) in levels.items()
    ]
    return spark.createDataFrame(rows, DIM_ALERT)


def build_turbine_dim(turbines: DataFrame) -> DataFrame:
    """Distinct (turbine_id, name, capacity, state) with a surrogate key.

    Later states go in by ``scd1_upsert`` or, with history, by ``scd2_merge``.
    """
    columns = ["turbine_id", "name", "capacity", "state"]
    return with_surrogate_key(turbines.select(*columns).distinct(), columns, "turbine_key")
