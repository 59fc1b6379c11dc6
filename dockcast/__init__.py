"""dockcast: station-level demand analytics expressed as Spark DataFrame jobs."""

from dockcast.config import EngineConfig, ForecastParams

__all__ = ["EngineConfig", "ForecastParams"]
