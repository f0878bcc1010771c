"""Shared session and small-frame builders."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import SparkSession

from routelens.schemas import ACCESS_LOG
from routelens.session import SESSION_CONFS

NOON = datetime(2026, 1, 21, 12, 0, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "checkpoints"))
    )
    for key, value in SESSION_CONFS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/tables'")
    return name


def log(at=0.0, route="catalog", status=200, latency=10, **fields):
    """One access log, ``at`` seconds after noon; ``at=None`` leaves the time out."""
    row = {
        "event_time": None if at is None else NOON + timedelta(seconds=at),
        "http_route": route,
        "hostname": "media.routelens.test",
        "method": "GET",
        "path": "/products",
        "status_code": status,
        "response_time_ms": latency,
        "bytes_sent": 1024,
        "bytes_received": 256,
        "upstream_cluster": "catalog-cluster",
        "client_ip": "10.42.1.1",
    }
    return {**row, **fields}


@pytest.fixture
def logs_of(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), ACCESS_LOG)

    return build


def collect(frame, *order):
    """Rows as dictionaries, with zone-aware timestamps."""
    rows = frame.orderBy(*order).collect() if order else frame.collect()
    return [
        {
            k: v.replace(tzinfo=timezone.utc) if isinstance(v, datetime) and v.tzinfo is None else v
            for k, v in r.asDict(recursive=True).items()
        }
        for r in rows
    ]
