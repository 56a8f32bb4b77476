"""Table store: append-only logs as parquet, one folder per operation date, in runs, and a log of commits.

A run is one set of tables. A replay fills a new run and publishes it by one commit, so readers see the old tables or the
new ones, never both. A day is written by replacing its folders, so running it again gives the same tables; it counts from
its commit on. Every commit is made against the state its writer has read (see ``commits``): of two writers one fails.

Payments of the desk belong to the store, not to a run. A batch is a folder with its attempts and its results, named by a
commit that also says which operation date the desk had seen. A replay takes the attempts of all batches into account, each
after that date, and keeps their results in its run; results of later batches are read from their own folders.

Snapshots hold the logs without what no later date needs. They are versions of their own: the day step and the desk read the
last one and the dates after it, so their cost goes with the state and not with the history.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra import schemas
from cadastra.session import own_shuffles
from cadastra.sources.commits import CommitLog

#: Tables that the desk writes to.
DESK = ("payment", "cut_close", "invoice_line", "reject")
#: Logs that the next day's step reads.
STATE = (
    "person", "property", "ownership_log", "charge_log", "fiscal_log", "balance_log",
    "invoice", "payment", "cut_open", "cut_close", "reconnection",
)
#: What a desk was asked.
ATTEMPTS = "property_id string, method_id int, reference string, op_date date"
#: Commits of batches: the name a caller gave, the folder, the commit's number, and the last operation date seen.
BATCHES = "batch string, folder string, number int, seen date"


class Store:
    def __init__(self, spark: SparkSession, path: str, run: str | None = None, based_on: int | None = None):
        """The published tables at ``path``; with ``run`` a run that is being filled, ``based_on`` the commit it started from."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.based_on = based_on
        self._own_run = run
        self._commits = CommitLog(spark, f"{self.path}/commits")

    def version(self) -> int:
        """Number of the last commit, -1 before the first."""
        return len(self._commits.entries()) - 1

    def _published(self) -> tuple[int, str]:
        """Number and run of the last published run."""
        entries = self._commits.entries()
        return next((k, entries[k]["run"]) for k in range(len(entries) - 1, -1, -1) if entries[k]["action"] == "publish")

    @property
    def run(self) -> str:
        """Folder of the tables: the run being filled, or the one last published."""
        return self._own_run or self._published()[1]

    def location(self, table: str) -> str:
        return f"{self.path}/{self.run}/{table}"

    def create(self) -> Store:
        """Publish a run with every table empty."""
        return self.publish(self.new_run())

    def new_run(self) -> Store:
        """A run with empty tables that no reader sees yet."""
        run = Store(self.spark, self.path, f"run-{uuid.uuid4().hex}", self.version())
        for table, schema in schemas.LOGS.items():
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("append").partitionBy("op_date").parquet(run.location(table))
        for table in DESK:
            self.spark.createDataFrame([], _with_batch(table)).write.parquet(run.location(f"desk/{table}"))
        return run

    def publish(self, run: Store) -> Store:
        """Make the tables of ``run`` those of the store, if nothing was committed since the run was begun."""
        last = run.read("op_day").agg(F.max("op_date").alias("d")).first()["d"]
        self._commits.append({"action": "publish", "run": run.run, "last_day": last and last.isoformat()}, run.based_on + 1)
        return self

    def complete_day(self, day: dt.date, based_on: int) -> None:
        """Let the folders of ``day`` count, if nothing was committed since ``based_on``."""
        self._commits.append({"action": "day", "run": self.run, "op_date": day.isoformat()}, based_on + 1)

    def last_day(self) -> dt.date | None:
        """Last complete operation date of the published run."""
        published, run = self._published()
        entries = self._commits.entries()
        days = [entries[published]["last_day"], *[e["op_date"] for e in entries[published:] if e["action"] == "day"]]
        return max((dt.date.fromisoformat(d) for d in days if d), default=None)

    def read(self, table: str, before: dt.date | None = None) -> DataFrame:
        """Rows of a table; of a published run those of complete dates and undated ones, with the results of the desk.

        With ``before``, what was known before that operation date: earlier dates only (prunes folders), and batches of
        desks that had seen earlier dates only, whatever date their payments bear.
        """
        df = self.spark.read.schema(schemas.LOGS[table]).parquet(self.location(table))
        if not self._own_run:
            last = self.last_day()
            complete = F.lit(False) if last is None else F.col("op_date") <= F.lit(last)
            df = df.where(F.col("op_date").isNull() | complete)
        if before is not None:
            df = df.where(F.col("op_date") < F.lit(before))
        if table not in DESK:
            return df
        desk = self.spark.read.schema(_with_batch(table)).parquet(self.location(f"desk/{table}"))
        if not self._own_run and (later := self.batches(self._published()[0] + 1)) is not None:
            desk = desk.unionByName(self._of_batches(table, later).select(*desk.columns))
        if before is not None:
            desk = desk.where(F.col("seen") < F.lit(before))
        return df.unionByName(desk.select(*df.columns))

    def state(self, before: dt.date | None = None) -> dict[str, DataFrame]:
        """The logs that a day step or the desk needs, history left out: the last snapshot and what came after it.

        With ``before``, as known before that operation date. A snapshot holds the rows of the logs that still matter
        (``plans.state.compacted``), so that whatever is worked out from these logs is what the whole logs give. Without a
        snapshot these are the whole logs.
        """
        found = self._snapshot(before)
        if found is None:
            return {table: self.read(table, before) for table in STATE}
        number, day, folder = found
        later = self.batches(number + 1)
        tables = {}
        for table in STATE:
            schema = schemas.LOGS[table]
            held = self.spark.read.schema(schema).parquet(f"{self.location('snapshots')}/{folder}/{table}")
            since = self.spark.read.schema(schema).parquet(self.location(table)).where(F.col("op_date") > F.lit(day))
            last = self.last_day()
            since = since.where(F.col("op_date") <= F.lit(last) if before is None else F.col("op_date") < F.lit(before))
            tables[table] = held.unionByName(since)
            if table in DESK and later is not None:
                rows = self._of_batches(table, later if before is None else later.where(F.col("seen") < F.lit(before)))
                tables[table] = tables[table].unionByName(rows.select(*held.columns))
        return tables

    def _snapshot(self, before: dt.date | None = None) -> tuple[int, dt.date, str] | None:
        """(commit, date, folder) of the last snapshot of the published run that no later run of a day has overtaken."""
        published, _ = self._published()
        entries = self._commits.entries()
        redone = dt.date.max
        for k in range(len(entries) - 1, published, -1):
            entry = entries[k]
            if entry["action"] == "day":
                redone = min(redone, dt.date.fromisoformat(entry["op_date"]))
            elif entry["action"] == "snapshot":
                day = dt.date.fromisoformat(entry["op_date"])
                if day < redone and (before is None or day < before):
                    return k, day, entry["folder"]
        return None

    def days_since_snapshot(self) -> int | None:
        """Complete dates after the last snapshot, None if there is none."""
        found = self._snapshot()
        if found is None:
            return None
        later = self._commits.entries()[found[0] :]
        return len({e["op_date"] for e in later if e["action"] == "day"})

    def write_snapshot(self, tables: dict[str, DataFrame], based_on: int) -> None:
        """Write the compacted state of the last complete date and let it count, if nothing was committed since ``based_on``."""
        folder, day = uuid.uuid4().hex, self.last_day()
        for table in STATE:
            self._shaped(table, tables[table]).write.parquet(f"{self.location('snapshots')}/{folder}/{table}")
        self._commits.append({"action": "snapshot", "run": self.run, "op_date": day.isoformat(), "folder": folder}, based_on + 1)

    def batches(self, first: int = 0, end: int | None = None) -> DataFrame | None:
        """Commits of batches (``BATCHES``) with numbers from ``first`` to before ``end``; None if there is none."""
        rows = [
            (e["batch"], e["folder"], k, dt.date.fromisoformat(e["seen"]))
            for k, e in enumerate(self._commits.entries()[:end])
            if e["action"] == "batch" and k >= first
        ]
        return self.spark.createDataFrame(rows, BATCHES) if rows else None

    def _of_batches(self, table: str, batches: DataFrame) -> DataFrame:
        """Rows of a table in the folders of ``batches``, with the columns of ``BATCHES``."""
        schema = T.StructType.fromDDL(ATTEMPTS) if table == "attempt" else schemas.LOGS[table]
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("folder", T.StringType())]))
        return rows.parquet(f"{self.path}/desk/{table}").join(batches, "folder")

    def desk_attempts(self, end: int | None = None) -> DataFrame | None:
        """Attempts of all batches committed before number ``end``, with ``batch``, ``number`` and ``seen``; None if there are none."""
        batches = self.batches(0, end)
        return None if batches is None else self._of_batches("attempt", batches).drop("folder")

    def _shaped(self, table: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.LOGS[table].fields])

    def write_all(self, table: str, df: DataFrame) -> DataFrame:
        """Replace a whole table and return it read back, which cuts its lineage.

        ``rebalance`` groups rows by date, splitting large dates and joining small ones. A name ``desk/...`` is what a
        replay makes of the desk's attempts; it comes back in the shape of the table itself.
        """
        if table.startswith("desk/"):
            schema = _with_batch(table.removeprefix("desk/"))
            rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
            with own_shuffles(self.spark):
                rows.write.mode("overwrite").parquet(self.location(table))
            return self.spark.read.schema(schema).parquet(self.location(table))
        shaped = self._shaped(table, df).hint("rebalance", "op_date")
        with own_shuffles(self.spark):
            shaped.write.mode("overwrite").partitionBy("op_date").parquet(self.location(table))
        return self.spark.read.schema(schemas.LOGS[table]).parquet(self.location(table))

    def write_day(self, table: str, day: dt.date, df: DataFrame) -> DataFrame:
        """Replace one date of a table, desk batches aside, and return it read back."""
        folder = f"{self.location(table)}/op_date={day.isoformat()}"
        self._shaped(table, df).drop("op_date").write.mode("overwrite").parquet(folder)
        rows = self.spark.read.schema(schemas.LOGS[table]).parquet(self.location(table))
        return rows.where(F.col("op_date") == F.lit(day))

    def add_undated(self, table: str, df: DataFrame) -> None:
        """Append rows without a date that the table does not have yet, so a repeated load adds none."""
        rows = self._shaped(table, df).drop("op_date").distinct()
        known = self.spark.read.schema(schemas.LOGS[table]).parquet(self.location(table)).where("op_date IS NULL").drop("op_date")
        same = None
        known = known.toDF(*[f"_{c}" for c in known.columns])
        for column in rows.columns:
            equal = F.col(column).eqNullSafe(F.col(f"_{column}"))
            same = equal if same is None else same & equal
        fresh = rows.join(known, same, "left_anti").withColumn("op_date", F.lit(None).cast("date"))
        fresh.write.mode("append").partitionBy("op_date").parquet(self.location(table))

    def write_batch(self, table: str, folder: str, df: DataFrame) -> DataFrame:
        """Write the rows of one batch and return them read back; they count when the batch is committed."""
        schema = T.StructType.fromDDL(ATTEMPTS) if table == "attempt" else schemas.LOGS[table]
        path = f"{self.path}/desk/{table}/folder={folder}"
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def find_batch(self, batch: str) -> str | None:
        """Folder of a committed batch."""
        return next((e["folder"] for e in self._commits.entries() if e["action"] == "batch" and e["batch"] == batch), None)

    def batch(self, table: str, folder: str) -> DataFrame:
        """Rows of one batch."""
        return self.spark.read.schema(schemas.LOGS[table]).parquet(f"{self.path}/desk/{table}/folder={folder}")

    def complete_batch(self, batch: str, folder: str, seen: dt.date, based_on: int) -> None:
        """Let a batch count, if nothing was committed since ``based_on``."""
        self._commits.append({"action": "batch", "batch": batch, "folder": folder, "seen": seen.isoformat()}, based_on + 1)


def _with_batch(table: str) -> T.StructType:
    return T.StructType([*schemas.LOGS[table].fields, T.StructField("batch", T.StringType()), T.StructField("seen", T.DateType())])
