"""morrowcart: next-day purchase ranking from a behaviour log, on Spark."""

from .config import Calendar, ModelParams, RunConfig

__all__ = ["Calendar", "ModelParams", "RunConfig"]
