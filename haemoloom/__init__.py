"""haemoloom: sessions, features and risk scores from machine telemetry, on Spark."""

from haemoloom.schemas import MODEL_FEATURES, SESSION_CSV_COLUMNS
from haemoloom.settings import BATCH, SERVING, Settings

__all__ = ["BATCH", "MODEL_FEATURES", "SERVING", "SESSION_CSV_COLUMNS", "Settings"]
