"""Vendor status codes: normalisation and classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portalake.functions.text import strip

# The portal's documented reason codes and the class each belongs to.
REASON_CODES = (
    (1, "APPLICATION_ERROR", "response_error"),
    (4, "HTTP_ERROR", "response_error"),
    (12, "NO_OPENAPI_SERVICE_ERROR", "response_error"),
    (20, "SERVICE_ACCESS_DENIED_ERROR", "auth"),
    (22, "LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR", "rate_limited"),
    (23, "LIMITED_NUMBER_OF_SERVICE_REQUESTS_PER_SECOND_EXCEEDS_ERROR", "rate_limited"),
    (30, "SERVICE_KEY_IS_NOT_REGISTERED_ERROR", "auth"),
    (31, "DEADLINE_HAS_EXPIRED_ERROR", "auth"),
    (99, "UNKNOWN_ERROR", "response_error"),
)
OK, NO_DATA = "0", "3"


def _codes(status: str) -> list[str]:
    return [str(code) for code, _, s in REASON_CODES if s == status]


def result_code(c: Column) -> Column:
    """Significant digits of a result code: ``00`` = ``000`` = ``0``; missing -> ``?``."""
    digits = F.ltrim(strip(c), F.lit("0"))
    return F.when(c.isNull(), "?").when(digits == "", "0").otherwise(digits)


def fault_class(code: Column) -> Column:
    """Class of a non-zero code in either envelope."""
    return (F.when(code.isin(_codes("auth")), "auth")
            .when(code.isin(_codes("rate_limited")), "rate_limited")
            .otherwise("response_error"))


def result_status(code: Column) -> Column:
    """``ok``, ``no_data`` or the fault class of a normalised result code."""
    return (F.when(code == OK, "ok").when(code == NO_DATA, "no_data")
            .otherwise(fault_class(code)))


def http_status_class(status: Column) -> Column:
    """Class of a failed HTTP status; NULL for 2xx and where no status was recorded."""
    return (F.when(status.isNull() | status.between(200, 299), None)
            .when(status == 429, "rate_limited")
            .when(status.isin(401, 403), "auth")
            .otherwise("network"))


def reason_codes(spark: SparkSession) -> DataFrame:
    """The documented codes as a small dimension: code, reason, status."""
    rows = [(str(code), reason, status) for code, reason, status in REASON_CODES]
    return spark.createDataFrame(rows, "code string, reason string, status string")
