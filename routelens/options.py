"""Job options: ``--key value`` or ``--key=value``, unknown keys ignored."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from routelens.operators.alerts import DEFAULT_THRESHOLD_MS
from routelens.sources.replay import ALL, LAST, LAST_PER_SUBJECT, NEW, parse_deliver_policy

# Object-store option, environment variable that stands in for it, Spark conf.
STORAGE_KEYS = (
    ("s3.endpoint", "S3_ENDPOINT", "spark.hadoop.fs.s3a.endpoint"),
    ("s3.access.key", "AWS_ACCESS_KEY_ID", "spark.hadoop.fs.s3a.access.key"),
    ("s3.secret.key", "AWS_SECRET_ACCESS_KEY", "spark.hadoop.fs.s3a.secret.key"),
    ("s3.path.style.access", "S3_PATH_STYLE_ACCESS", "spark.hadoop.fs.s3a.path.style.access"),
    ("s3.region", "AWS_REGION", "spark.hadoop.fs.s3a.endpoint.region"),
)
PATH_STYLE_DEFAULT = "true"


def parse_args(args: Sequence[str]) -> dict[str, str]:
    """Key-value map of the arguments; a key without a value is skipped."""
    found: dict[str, str] = {}
    pending: str | None = None
    for arg in args:
        if arg.startswith("--"):
            key, has_value, value = arg[2:].partition("=")
            pending = None if has_value else key
            if has_value:
                found[key] = value
        elif pending is not None:
            found[pending] = arg
            pending = None
    return found


def storage_confs(given: Mapping[str, str], env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Spark confs of the object store; an empty option falls back to the environment."""
    env = os.environ if env is None else env
    confs = {}
    for key, variable, conf in STORAGE_KEYS:
        value = given.get(key) or env.get(variable)
        if value:
            confs[conf] = value
    confs.setdefault("spark.hadoop.fs.s3a.path.style.access", PATH_STYLE_DEFAULT)
    return confs


def catalog_confs(given: Mapping[str, str]) -> dict[str, str]:
    """Spark confs of a lake catalog, or none when no catalog is named.

    ``--catalog.name lake --catalog.uri http://…`` sets ``spark.sql.catalog.lake`` and
    everything under it; ``--catalog.conf.<key>`` is passed on as it is.
    """
    name = given.get("catalog.name")
    if not name:
        return {}
    root = f"spark.sql.catalog.{name}"
    confs = {root: given.get("catalog.class", "org.apache.iceberg.spark.SparkCatalog")}
    for key in ("type", "uri", "ref", "warehouse"):
        value = given.get(f"catalog.{key}")
        if value:
            confs[f"{root}.{key}"] = value
    for key, value in given.items():
        if key.startswith("catalog.conf."):
            confs[f"{root}.{key.removeprefix('catalog.conf.')}"] = value
    return confs


@dataclass(frozen=True)
class JobOptions:
    """Everything the streaming job can be told."""

    source_format: str = "text"
    source_path: str | None = None
    source_options: Mapping[str, str] = field(default_factory=dict)
    deliver_policy: str = ALL
    database: str = "route_analytics"
    table_format: str = "parquet"
    latency_threshold_ms: int = DEFAULT_THRESHOLD_MS
    parallelism: int | None = None
    watermark: str = "5 seconds"
    trigger_interval: str = "60 seconds"
    available_now: bool = False
    checkpoint_dir: str | None = None
    catalog: str | None = None
    fold_closed_days: bool = False
    landing: bool = False
    confs: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_args(cls, args: Sequence[str], env: Mapping[str, str] | None = None) -> JobOptions:
        given = parse_args(args)
        confs = {**storage_confs(given, env), **catalog_confs(given)}
        warehouse = given.get("warehouse")
        if warehouse:
            confs["spark.sql.warehouse.dir"] = warehouse
        parallelism = int(given["parallelism"]) if "parallelism" in given else None
        if parallelism is not None:
            confs["spark.sql.shuffle.partitions"] = str(parallelism)
        prefix = "source.option."
        source_options = {k.removeprefix(prefix): v for k, v in given.items() if k.startswith(prefix)}
        return cls(
            source_format=given.get("source.format", cls.source_format),
            source_path=given.get("source.path"),
            source_options=source_options,
            deliver_policy=parse_deliver_policy(given.get("deliver.policy", ALL)),
            database=given.get("database", cls.database),
            table_format=given.get("table.format", cls.table_format),
            latency_threshold_ms=int(given.get("latency.threshold.ms", DEFAULT_THRESHOLD_MS)),
            parallelism=parallelism,
            watermark=given.get("watermark", cls.watermark),
            trigger_interval=given.get("trigger.interval", cls.trigger_interval),
            available_now=given.get("available.now", "false").lower() == "true",
            checkpoint_dir=given.get("checkpoint.dir"),
            catalog=given.get("catalog.name"),
            fold_closed_days=given.get("fold.closed.days", "false").lower() == "true",
            landing=given.get("landing", "false").lower() == "true",
            confs=confs,
        )

    def start_options(self) -> dict[str, str]:
        """Source options with the start position of a first run added.

        Only a broker has positions. ``last`` and ``last_per_subject`` pick single
        messages, which a stream cannot express, so they are batch reads.
        """
        options = dict(self.source_options)
        if self.deliver_policy in (LAST, LAST_PER_SUBJECT):
            raise ValueError(f"deliver policy {self.deliver_policy!r} is for batch reads (sources.replay)")
        if self.source_format == "kafka":
            options.setdefault("startingOffsets", "latest" if self.deliver_policy == NEW else "earliest")
        elif self.deliver_policy == NEW:
            raise ValueError("deliver policy 'new' needs a broker source")
        return options
