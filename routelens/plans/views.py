"""The continuously updated views under their SQL names, for ``spark.sql``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from routelens.operators.activity import client_activity, hostname_traffic, route_summary
from routelens.operators.alerts import sql_latency_alerts
from routelens.operators.errors import sql_error_events
from routelens.operators.metrics import sql_route_metrics_1m, sql_route_metrics_1m_pct, sql_route_metrics_5m

SQL_VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "route_metrics_1m": sql_route_metrics_1m,
    "route_metrics_1m_pct": sql_route_metrics_1m_pct,
    "route_metrics_5m": sql_route_metrics_5m,
    "error_events": sql_error_events,
    "latency_alerts": sql_latency_alerts,
    "route_summary": route_summary,
    "hostname_traffic": hostname_traffic,
    "client_activity": client_activity,
}


def register_access_logs(logs: DataFrame, name: str = "access_logs") -> None:
    """Expose a batch or streaming frame to SQL, with the time column named ``timestamp``."""
    logs.withColumnRenamed("event_time", "timestamp").createOrReplaceTempView(name)


def register_views(logs: DataFrame, prefix: str = "") -> list[str]:
    """Create a temporary view per entry of ``SQL_VIEWS``; nothing is computed until read."""
    names = []
    for name, build in SQL_VIEWS.items():
        build(logs).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
