"""Checks of scoring requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prospectra.functions import in_set
from prospectra.schemas import EMPLOYEE_RANGES

MEASURES = ("total_actions", "total_users", "days_active", "activity_frequency")


def _request_rules() -> dict[str, Column]:
    """What a valid request fulfils; a NULL anywhere fails its rule."""
    rules = {
        "id_present": F.col("id").isNotNull(),
        "rank_positive": F.col("ALEXA_RANK") > 0,
        "range_known": in_set(F.col("EMPLOYEE_RANGE"), EMPLOYEE_RANGES),
        "industry_present": F.col("INDUSTRY").isNotNull(),
    }
    return rules | {f"{name}_nonneg": F.col(name) >= 0 for name in MEASURES}


def check_requests(requests: DataFrame) -> DataFrame:
    """Add `failed_rules`, the names of the rules a request breaks; empty for a valid one."""
    failed = [
        F.when(~F.coalesce(holds, F.lit(False)), F.lit(name))
        for name, holds in _request_rules().items()
    ]
    return requests.withColumn("failed_rules", F.array_compact(F.array(*failed)))


def valid_requests(requests: DataFrame) -> DataFrame:
    """Requests that pass every rule; plain predicates, so they can reach the scan."""
    for holds in _request_rules().values():
        requests = requests.where(holds)
    return requests


def rejected_requests(requests: DataFrame) -> DataFrame:
    return check_requests(requests).where(F.size("failed_rules") > 0)
