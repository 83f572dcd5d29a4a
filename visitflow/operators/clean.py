"""Log-type whitelist ("data cleaning")."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.schema import LOG_TYPE, LOG_TYPES


def clean_log_types(logs: DataFrame, types: Iterable[str] = LOG_TYPES) -> DataFrame:
    """Keep logs whose type is exactly one of ``types`` (case-sensitive).
    Runs before the cut, so other types never bridge a session gap."""
    return logs.where(F.col(LOG_TYPE).isin(*types))
