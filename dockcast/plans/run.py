"""Whole run from settings: prepare the tables, then the rolling forecast."""

from __future__ import annotations

from pyspark.sql import SparkSession

from dockcast.config import EngineConfig
from dockcast.plans.forecast import Rolling, rolling_forecast
from dockcast.sources.files import prepare


def run(spark: SparkSession, config: EngineConfig, fmt: str = "csv") -> Rolling:
    tables = prepare(spark, config, fmt=fmt)
    return rolling_forecast(
        tables.trip,
        tables.station,
        tables.weather_period,
        config.forecast_end,
        config.process_days,
        trace_back_days=config.trace_back_days,
        test_days=config.test_days,
        n_clusters=config.n_clusters,
        params=config.model,
        ledger=config.ledger_path,
    )
