"""Access-log analytics on Spark: route metrics, alerts, errors, activity and sessions."""

from routelens.operators.activity import client_activity, hostname_traffic, route_summary
from routelens.operators.alerts import alert_exceedance, latency_alerts, sql_latency_alerts
from routelens.operators.errors import error_events, sql_error_events
from routelens.operators.metrics import (
    route_metrics_1m,
    route_metrics_5m,
    route_throughput,
    sql_route_metrics_1m,
    sql_route_metrics_1m_pct,
    sql_route_metrics_5m,
    status_categories,
)
from routelens.operators.sessions import session_metrics
from routelens.options import JobOptions
from routelens.session import build_session
from routelens.sources.decode import decode_messages, rejected_messages
from routelens.sources.reader import read_access_logs, read_access_logs_stream
from routelens.streaming.job import run_job, start_job

__all__ = [
    "JobOptions",
    "alert_exceedance",
    "build_session",
    "client_activity",
    "decode_messages",
    "error_events",
    "hostname_traffic",
    "latency_alerts",
    "read_access_logs",
    "read_access_logs_stream",
    "rejected_messages",
    "route_metrics_1m",
    "route_metrics_5m",
    "route_summary",
    "route_throughput",
    "run_job",
    "session_metrics",
    "sql_error_events",
    "sql_latency_alerts",
    "sql_route_metrics_1m",
    "sql_route_metrics_1m_pct",
    "sql_route_metrics_5m",
    "start_job",
    "status_categories",
]
