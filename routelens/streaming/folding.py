"""Closed days of the result tables, folded into one unit each.

Tables written micro-batch by micro-batch hold one part for each batch and day. Folding a day writes all of its rows
as one new part, a *generation* of the day, and then publishes a record that names the new part and the parts it
holds. Publishing is one rename that fails if the record exists, so it is the only step that changes what is read:

- before it, a fold that was cut short has left a part that no record names; readers leave it out;
- after it, readers take the generation instead of the parts it holds, whether those are still there or not. A batch
  that is repeated later brings back a part that the generation holds, which is left out too;
- a late batch brings a part that no record holds. It is read besides the generation, and the next fold takes it in.

Parts that are no longer read are dropped once their record is older than any reader (``drop_folded``).

Only folder listings and records, a few names for each day, are handled at the driver. Table formats that keep their
own snapshots rewrite their files themselves and are left alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from typing import TYPE_CHECKING

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routelens.streaming.sinks import batch_write_confs

if TYPE_CHECKING:
    from routelens.streaming.tables import ResultTable

FOLDED = "folded-"
RECORDS = "_days"
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")
#: How long readers of what a fold has replaced may go on.
READERS_GONE = timedelta(hours=24)

Part = tuple[str, int]


class FoldConflict(RuntimeError):
    """Another fold of the same day was published first; nothing has changed."""


@dataclass(frozen=True)
class Record:
    """What a day's generation is: its part's name, and the batches it holds by query."""

    generation: int = 0
    name: str | None = None
    holds: dict[str, list[int]] = field(default_factory=dict)

    def has(self, part: Part) -> bool:
        return part[1] in self.holds.get(part[0], ())


class TableFolder:
    """The folder of a file table, partitioned by day, query and batch."""

    def __init__(self, spark: SparkSession, name: str, date_column: str, location: str):
        self.spark, self.name, self.date_column = spark, name, date_column
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.location = location.rstrip("/")
        self._fs = self.path().getFileSystem(self._conf)

    @classmethod
    def of(cls, spark: SparkSession, name: str, date_column: str) -> TableFolder | None:
        """None if the table's format is not one of plain files."""
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name IN ('Provider', 'Location')")
        found = {r["col_name"]: r["data_type"] for r in described.collect()}
        if found.get("Provider", "").lower() not in FILE_FORMATS:
            return None
        return cls(spark, name, date_column, found["Location"])

    def path(self, *below: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.location, *below)))

    def _listed(self, *below: str) -> list:
        return [status for status in self._fs.globStatus(self.path(*below)) or ()]

    def days(self) -> list[date]:
        """Days that have a folder, newest first. Rows without a day have none."""
        values = (status.getPath().getName().partition("=")[2] for status in self._listed(f"{self.date_column}=*"))
        return sorted((date.fromisoformat(v) for v in values if not v.startswith("__")), reverse=True)

    def parts(self, day: date | None = None) -> dict[date, set[Part]]:
        """``(query, batch)`` of the parts of one day, or of all."""
        found: dict[date, set[Part]] = {}
        for status in self._listed(f"{self.date_column}={day or '*'}", "query_id=*", "batch_id=*"):
            batch = status.getPath()
            query = batch.getParent()
            of_day = query.getParent().getName().partition("=")[2]
            if not of_day.startswith("__"):
                part = (query.getName().partition("=")[2], int(batch.getName().partition("=")[2]))
                found.setdefault(date.fromisoformat(of_day), set()).add(part)
        return found

    def record_files(self, day: date | None = None) -> dict[date, list[tuple[int, object]]]:
        """Generations of each day and their files, newest first."""
        found: dict[date, list[tuple[int, object]]] = {}
        for status in self._listed(RECORDS, f"{day or '*'}.*.json"):
            of_day, generation, _ = status.getPath().getName().split(".")
            found.setdefault(date.fromisoformat(of_day), []).append((int(generation), status))
        return {of_day: sorted(files, key=lambda f: -f[0]) for of_day, files in found.items()}

    def read_record(self, status) -> Record:
        stream = self._fs.open(status.getPath())
        try:
            return Record(**json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def record(self, day: date) -> Record:
        files = self.record_files(day).get(day)
        return self.read_record(files[0][1]) if files else Record()

    def publish(self, day: date, record: Record) -> None:
        """Make ``record`` the day's; the one step that readers see."""
        final = self.path(RECORDS, f"{day}.{record.generation:06d}.json")
        draft = self.path(RECORDS, f"_draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(json.dumps(vars(record)).encode()))
        stream.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        replace_nothing = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(draft, final, replace_nothing)
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            raise FoldConflict(f"{self.name}: {day} has been folded meanwhile") from error

    def drop(self, day: date, part: Part) -> None:
        self._fs.delete(self.path(f"{self.date_column}={day}", f"query_id={part[0]}", f"batch_id={part[1]}"), True)
        query = self.path(f"{self.date_column}={day}", f"query_id={part[0]}")
        if self._fs.exists(query) and not self._fs.listStatus(query):
            self._fs.delete(query, True)

    def forget(self, status) -> None:
        self._fs.delete(status.getPath(), False)


def _in_parts(parts: set[Part]) -> Column:
    by_query: dict[str, list[int]] = {}
    for query, batch in sorted(parts):
        by_query.setdefault(query, []).append(batch)
    conditions = ((F.col("query_id") == query) & F.col("batch_id").isin(batches) for query, batches in by_query.items())
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def current_parts(spark: SparkSession, name: str, date_column: str, since: date | None = None, until: date | None = None) -> Column | None:
    """True for the parts to read of days from ``since`` to ``until``; None for tables that are never folded.

    It names partition columns only, so a scan lists the parts and opens none that it leaves out. Generations
    published later are left out as well: a frame planned now reads the same rows when it is run.
    """
    folder = TableFolder.of(spark, name, date_column)
    if folder is None:
        return None
    files = folder.record_files()

    def wanted(day: date) -> bool:
        return (since is None or day >= since) and (until is None or day <= until)

    records = {day: folder.read_record(found[0][1]) for day, found in files.items() if wanted(day)}
    names = [record.name for record in records.values()]
    keep = ~F.col("query_id").startswith(FOLDED) | F.col("query_id").isin(names)
    for day, parts in folder.parts().items() if records else ():
        held = {part for part in parts if day in records and records[day].has(part)}
        if held:
            keep &= ~((F.col(date_column) == F.lit(day)) & _in_parts(held))
    return keep


def fold_day(spark: SparkSession, database: str, table: ResultTable, day: date) -> bool:
    """Fold one day of a result table. False if it already is one unit.

    The new part has the rows of the day's generation and of every part that is not in it; parts that appear
    meanwhile are left for the next fold.
    """
    name = f"`{database}`.`{table.name}`"
    folder = TableFolder.of(spark, name, table.date_column)
    if folder is None:
        return False
    record = folder.record(day)
    new = {p for p in folder.parts(day).get(day, ()) if not p[0].startswith(FOLDED) and not record.has(p)}
    if len(new) + (record.name is not None) < 2:
        return False
    generation = record.generation + 1
    folded = f"{FOLDED}{generation:06d}-{uuid.uuid4().hex[:12]}"
    taken = _in_parts(new | ({(record.name, record.generation)} if record.name else set()))
    spark.catalog.refreshTable(name)
    rows = spark.table(name).where((F.col(table.date_column) == F.lit(day)) & taken)
    rows = rows.withColumns({"query_id": F.lit(folded), "batch_id": F.lit(generation).cast("bigint")})
    with batch_write_confs(spark):
        rows.hint("rebalance").write.mode("append").insertInto(name)
    holds = {query: list(batches) for query, batches in record.holds.items()}
    for query, batch in sorted(new):
        holds.setdefault(query, []).append(batch)
    folder.publish(day, Record(generation, folded, holds))
    return True


def fold_closed_days(spark: SparkSession, database: str, result_tables: Iterable[ResultTable], before: date) -> list[tuple[str, date]]:
    """Fold every day before ``before`` that is not one unit; what was folded. Another fold's day is left to it."""
    done = []
    for table in result_tables:
        folder = TableFolder.of(spark, f"`{database}`.`{table.name}`", table.date_column) if table.per_batch else None
        for day in reversed(folder.days()) if folder else ():
            try:
                if day < before and fold_day(spark, database, table, day):
                    done.append((table.name, day))
            except FoldConflict:
                continue
    return done


def drop_folded(
    spark: SparkSession, database: str, result_tables: Iterable[ResultTable], now: datetime | None = None, readers_gone: timedelta = READERS_GONE
) -> int:
    """Drop the parts that generations published more than ``readers_gone`` ago have replaced; how many.

    Parts of a fold that was cut short go with the next generation that is published.
    """
    now = now or datetime.now(timezone.utc)
    dropped = 0
    for table in result_tables:
        folder = TableFolder.of(spark, f"`{database}`.`{table.name}`", table.date_column) if table.per_batch else None
        for day, files in (folder.record_files() if folder else {}).items():
            generation, status = files[0]
            if status.getModificationTime() / 1000 > (now - readers_gone).timestamp():
                continue
            record = folder.read_record(status)
            for part in folder.parts(day).get(day, ()):
                replaced = part[0].startswith(FOLDED) and part[0] != record.name and part[1] <= generation
                if replaced or record.has(part):
                    folder.drop(day, part)
                    dropped += 1
            for _, old in files[1:]:
                folder.forget(old)
    return dropped


def current_rows(rows: DataFrame, name: str, date_column: str, since: date | None = None, until: date | None = None) -> DataFrame:
    """The table's rows without those of parts that are not to be read."""
    keep = current_parts(rows.sparkSession, name, date_column, since, until)
    return rows if keep is None else rows.where(keep)
