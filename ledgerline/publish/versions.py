"""Versioned Parquet tables with a log of what is current.

Every attempt of a run writes to a folder of its own, so neither a reader of the published version nor
a retry of the run it came from is ever disturbed. One log file switches a whole set of tables. What an
attempt wrote stays while anyone holds a lease on it.

In the catalog every published attempt has a database of its own, whose tables never change, and one
view names the current one. Whoever reads that view once sees one run in all tables.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql.types import StructType

from ledgerline.publish.describe import COLUMNS, TABLES, with_comments
from ledgerline.publish.leases import Lease, held
from ledgerline.publish.storage import Storage

LOG_SCHEMA = (
    "relation string, path string, run_id string, attempt string, published_at timestamp,"
    " columns string"
)
# Relations with a folder per value of a column, so that a reader of some months lists and reads those.
PARTITIONS = {"fct_mrr": "invoice_month", "int_paid_invoices_eur": "invoice_month"}
# The view that names the database of the current attempt.
POINTER = "current_run"
# An attempt that was neither published nor cleaned up counts as crashed after this long.
ABANDONED_AFTER = dt.timedelta(days=2)


class Versions:
    """The tables under one base path."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.log, self.runs = f"{self.base}/_versions", f"{self.base}/_runs"
        self.leases = f"{self.base}/_leases"
        self.storage = Storage(spark)
        # Of what this object staged.
        self._schemas: dict[tuple[str, str], StructType] = {}

    @staticmethod
    def new_attempt(run_id: str) -> str:
        """A folder name no other attempt has, of this run or another."""
        return f"{run_id}-{uuid.uuid4().hex}"

    def path(self, attempt: str, relation: str) -> str:
        return f"{self.runs}/{attempt}/{relation}"

    def stage(
        self, df: DataFrame, attempt: str, relation: str, observe: dict | None = None
    ) -> DataFrame:
        """Write one relation of an attempt; not current until published.

        `observe` maps names to aggregates over the written rows; it is filled with their values.
        """
        path = self.path(attempt, relation)
        frame = with_comments(df, relation)
        if observe:
            watch = Observation(f"{relation}-{uuid.uuid4().hex}")
            frame = frame.observe(watch, *[c.alias(n) for n, c in observe.items()])
        by = PARTITIONS.get(relation)
        if by:
            # One task per value, unless it is large: then as many as its size asks for.
            write = frame.hint("rebalance", by).write.partitionBy(by)
        else:
            write = frame.write
        write.mode("errorifexists").parquet(path)
        if observe:
            observe.update(watch.get)
        self._schemas[attempt, relation] = frame.schema
        return self._open(path, relation, frame.schema if by else None)

    def _open(self, path: str, relation: str, schema: StructType | None) -> DataFrame:
        """A stored relation. A partitioned one is read by its schema: it may have no file at all."""
        if schema is None:
            return self.spark.read.parquet(path)
        stored = self.spark.read.schema(schema).parquet(path)
        return with_comments(stored.select(*schema.fieldNames()), relation)

    def lease(self, attempt: str, renew_every: float | None = None) -> Lease:
        """Keep an attempt from being removed, within a `with` block."""
        return Lease(self.spark, self.leases, attempt, *([renew_every] if renew_every else []))

    @contextmanager
    def reading(self) -> Iterator[dict[str, DataFrame]]:
        """All current relations, from one state of the log, held for as long as the block lasts."""
        while True:
            rows = {r["relation"]: r for r in self.history()}
            attempts = {r["attempt"] for r in rows.values()}
            leases = [self.lease(a) for a in sorted(attempts)]
            for each in leases:
                each.__enter__()
            try:
                # Removed between the look and the lease: look again.
                if attempts <= {r["attempt"] for r in self.history()}:
                    yield {name: self._read(r) for name, r in rows.items()}
                    return
            finally:
                for each in leases:
                    each.__exit__(None, None, None)

    def _read(self, row: Row) -> DataFrame:
        schema = StructType.fromJson(json.loads(row["columns"])) if row["columns"] else None
        return self._open(row["path"], row["relation"], schema)

    def publish(self, run_id: str, attempt: str, relations: list[str]) -> None:
        """Make an attempt's relations current, all at once: one log file that holds the whole log."""
        now = dt.datetime.now(dt.timezone.utc)
        files, history = self._files(), self.history()
        rows = [tuple(r) for r in history]
        rows += [
            (name, self.path(attempt, name), run_id, attempt, now, self._columns(attempt, name))
            for name in relations
        ]
        self._write_log(rows)
        # What was read is in the new file; a file that another writer added since stays.
        self.storage.delete(files)

    def _columns(self, attempt: str, relation: str) -> str | None:
        """The schema of a partitioned relation, in the order its writer gave."""
        if relation not in PARTITIONS:
            return None
        return self._schemas[attempt, relation].json()

    def history(self) -> list[Row]:
        """Everything the log names, oldest first. Its length is bounded by `retain`."""
        for patience in (0.1, 0.5, 2.0):
            try:
                log = self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.log}/*")
                return sorted(log.distinct().collect(), key=lambda r: (r["published_at"], r["path"]))
            except AnalysisException as e:
                if e.getCondition() == "PATH_NOT_FOUND":
                    return []
                raise
            except Exception:
                # A file was replaced between listing and reading.
                if patience == 2.0:
                    raise
                time.sleep(patience)
        return []

    def current(self) -> dict[str, str]:
        """Path of the latest published version by relation; empty before the first one."""
        return {r["relation"]: r["path"] for r in self.history()}

    def read(self, relation: str) -> DataFrame:
        found = {r["relation"]: r for r in self.history()}
        if relation not in found:
            raise LookupError(f"{relation} has not been published under {self.base}")
        return self._read(found[relation])

    def create_views(self, database: str) -> None:
        """Bring the catalog in line with the log: a database per attempt, and what is current.

        The tables of an attempt's database are made once, before anything names it. Then one view,
        `current_run`, is replaced. The views of `database` itself follow one by one, for readers of a
        single table; those that need several read the name in `current_run` once and stay with it.
        """
        rows = {r["relation"]: r for r in self.history()}
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for row in rows.values():
            self._create_table(snapshot_name(database, row["attempt"]), row)
        latest = max(rows.values(), key=lambda r: r["published_at"], default=None)
        if latest is None:
            return
        own = snapshot_name(database, latest["attempt"])
        self.spark.sql(
            f"CREATE OR REPLACE VIEW `{database}`.`{POINTER}` AS SELECT {_text(latest['run_id'])} AS run_id,"
            f" {_text(latest['attempt'])} AS attempt, {_text(own)} AS database_name"
        )
        for relation, row in rows.items():
            # A partitioned table names its partition column last; the view keeps the relation's order.
            names = ", ".join(f"`{c}`" for c in self._read(row).columns)
            self.spark.sql(
                f"CREATE OR REPLACE VIEW `{database}`.`{relation}` COMMENT {_text(TABLES.get(relation, ''))}"
                f" AS SELECT {names} FROM `{snapshot_name(database, row['attempt'])}`.`{relation}`"
            )

    def _create_table(self, database: str, row: Row) -> None:
        name = f"`{database}`.`{row['relation']}`"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        if self.spark.catalog.tableExists(name):
            return
        notes = COLUMNS.get(row["relation"], {})
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()} COMMENT {_text(notes.get(f.name, ''))}"
            for f in self._read(row).schema.fields
        )
        by = PARTITIONS.get(row["relation"]) if row["columns"] else None
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            + (f" PARTITIONED BY (`{by}`)" if by else "")
            + f" LOCATION {_text(row['path'])} COMMENT {_text(TABLES.get(row['relation'], ''))}"
        )
        if by:
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")

    def drop_old_databases(self, database: str) -> None:
        """Remove databases of attempts that the log no longer names; their files are not touched."""
        kept = {snapshot_name(database, r["attempt"]) for r in self.history()}
        for row in self.spark.sql(f"SHOW DATABASES LIKE '{database}__*'").collect():
            if row[0].startswith(f"{database}__") and row[0] not in kept:
                self.spark.sql(f"DROP DATABASE IF EXISTS `{row[0]}` CASCADE")

    def discard(self, attempt: str, keep: tuple[str, ...] = ()) -> None:
        """Remove an attempt that will not be published, or all of it but some relations."""
        folder = f"{self.runs}/{attempt}"
        if keep:
            kept = {f"{folder}/{name}" for name in keep}
            self.storage.delete([p for p, _ in self.storage.list(folder) if not p.endswith(tuple(kept))])
        else:
            self.storage.delete([folder])

    def retain(self, runs: int) -> None:
        """Keep the latest `runs` published attempts, whatever the log calls current, and leased ones.

        Older ones leave the log first and the disk after it. Attempts that the log does not name are
        removed once they are old enough to be crashed ones and not running ones.
        """
        leased = held(self.spark, self.leases)
        files, history = self._files(), self.history()
        published = list(dict.fromkeys(r["attempt"] for r in reversed(history)))
        current = {r["relation"]: r["attempt"] for r in history}
        kept = set(published[:runs]) | set(current.values()) | (leased & set(published))
        if kept != set(published):
            self._write_log([tuple(r) for r in history if r["attempt"] in kept])
            self.storage.delete(files)
        horizon = time.time() - ABANDONED_AFTER.total_seconds()
        for path, changed in self.storage.list(self.runs):
            attempt = path.rsplit("/", 1)[-1]
            crashed = attempt not in published and attempt not in leased and changed < horizon
            if crashed or (attempt in published and attempt not in kept):
                self.storage.delete([path])

    def _write_log(self, rows: list[tuple]) -> None:
        name = f"{time.time_ns()}-{uuid.uuid4().hex}"
        log = self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1)
        log.write.mode("errorifexists").parquet(f"{self.log}/{name}")

    def _files(self) -> list[str]:
        return [path for path, _ in self.storage.list(self.log)]


def snapshot_name(database: str, attempt: str) -> str:
    """The database that holds the tables of one attempt."""
    return f"{database}__{re.sub(r'[^a-z0-9]', '_', attempt.lower())}"


def _text(value: str) -> str:
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{quoted}'"
