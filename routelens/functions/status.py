"""Status-code predicates and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_success(status: Column) -> Column:
    return (status >= 200) & (status < 300)


def is_client_error(status: Column) -> Column:
    return (status >= 400) & (status < 500)


def is_server_error(status: Column) -> Column:
    return status >= 500


def is_error(status: Column) -> Column:
    return status >= 400


def status_category(status: Column) -> Column:
    """``404`` becomes ``4xx``."""
    return F.concat(F.call_function("div", status, F.lit(100)).cast("string"), F.lit("xx"))


def error_category(status: Column) -> Column:
    """Label of a row already known to be an error."""
    return F.when(is_server_error(status), "SERVER_ERROR").otherwise("CLIENT_ERROR")


def error_type(status: Column) -> Column:
    """Lower-case label of the SQL view."""
    return (
        F.when(is_server_error(status), "server_error")
        .when(is_error(status), "client_error")
        .otherwise("unknown")
    )


def rate_pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, and 0.0 when ``whole`` is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole * 100)


def wide_sum(column: str) -> Column:
    """A sum that partial sums cannot overflow; cast the last one to the type of the result."""
    return F.sum(F.col(column).cast("decimal(38,0)"))
