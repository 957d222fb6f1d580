"""Chosen sessions from the stored tables: readings, CSV files and payloads."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haemoloom.operators.enrich import enrich
from haemoloom.operators.sessions import readings_of_sessions
from haemoloom.plans.features import serving_features
from haemoloom.sources.payload import payload_documents, write_payload
from haemoloom.sources.session_csv import write_session_csv


def load_session(sessionized: DataFrame, registration: DataFrame, demographics: DataFrame, session: str) -> DataFrame:
    """One session with its registration and demographics; the filter reaches the table scan."""
    return enrich(sessionized.filter(F.col("session_id") == F.lit(session)), registration, demographics)


def load_sessions(
    sessionized: DataFrame, registration: DataFrame, demographics: DataFrame, sessions: DataFrame
) -> DataFrame:
    """All sessions listed in ``sessions``, in one job."""
    return enrich(readings_of_sessions(sessionized, sessions), registration, demographics)


def export_csv(enriched: DataFrame, path: str) -> None:
    """Chosen sessions in the exchange format, one folder per session."""
    write_session_csv(enriched, path, file_per_session=True)


def export_payload(enriched: DataFrame, path: str) -> None:
    """Chosen sessions as scoring payloads."""
    write_payload(payload_documents(serving_features(enriched)), path)
