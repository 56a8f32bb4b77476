"""Running meter balances over a stream of readings.

State is a log of closing balances per meter, one folder per micro-batch, and every ``COMPACT`` batches a snapshot with
one row per meter. Each batch starts from the last snapshot and the batches after it, so a hot meter is still summed by
day in parallel instead of inside one stateful task. A batch replaces its own folders, which makes a retried batch harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadastra.operators import meters

OUTPUT = "meter_id bigint, op_date date, position bigint, balance decimal(28,2)"
LATE = "meter_id bigint, op_date date, position bigint, reason string"
LOG = "meter_id bigint, op_date date, balance decimal(28,2), batch bigint"
#: Batches from one snapshot to the next.
COMPACT = 16


class MeterStream:
    def __init__(self, spark: SparkSession, path: str, compact: int = COMPACT):
        self.spark = spark
        self.compact = compact
        self.path = path.rstrip("/")
        for table, schema in (("balance", OUTPUT), ("late", LATE), ("closing", LOG), ("snapshot", LOG)):
            schema = schema if "batch" in schema else f"{schema}, batch bigint"
            spark.createDataFrame([], schema).write.mode("append").partitionBy("batch").parquet(f"{self.path}/{table}")

    def read(self, table: str) -> DataFrame:
        schema = {"balance": OUTPUT, "late": LATE, "closing": LOG, "snapshot": LOG}[table]
        schema = schema if "batch" in schema else f"{schema}, batch bigint"
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")

    def _write(self, table: str, batch: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{table}/batch={batch}")

    def past(self, batch: int) -> DataFrame:
        """Closing balances from before a batch: the last snapshot and the batches after it (other folders are not read)."""
        snapshots = self.read("snapshot").where(F.col("batch") < batch)
        last = snapshots.agg(F.max("batch").alias("b")).first()["b"]
        if last is None:
            return self.read("closing").where(F.col("batch") < batch)
        after = self.read("closing").where((F.col("batch") > last) & (F.col("batch") < batch))
        return snapshots.where(F.col("batch") == last).unionByName(after)

    def apply(self, readings: DataFrame, batch: int) -> None:
        """Balances of one micro-batch; readings without a date or dated before the last processed one go to ``late``."""
        past = self.past(batch)
        last = past.agg(F.max("op_date").alias("d")).first()["d"]
        undated = F.col("op_date").isNull()
        late = undated if last is None else undated | (F.col("op_date") < F.lit(last))
        reason = F.when(undated, "without a date").otherwise("dated before the last processed date")
        on_time = readings.where(~late)
        touched = past.join(on_time.select("meter_id").distinct(), "meter_id", "left_semi")
        opening = touched.groupBy("meter_id").agg(F.max_by("balance", F.struct("batch", "op_date")).alias("value"))
        # The opening balance is a reading that sets the meter before the first date of the batch.
        seeded = on_time.select("meter_id", "op_date", "position", "movement", F.col("value").cast("decimal(28,2)")).unionByName(
            opening.select(
                "meter_id",
                F.lit("0001-01-01").cast("date").alias("op_date"),
                F.lit(-1).cast("bigint").alias("position"),
                F.lit(meters.SET).alias("movement"),
                "value",
            )
        )
        balances = meters.reading_balances(seeded).where("position >= 0")
        self._write("balance", batch, balances.select("meter_id", "op_date", "position", "balance"))
        written = self.spark.read.schema(OUTPUT).parquet(f"{self.path}/balance/batch={batch}")
        self._write(
            "late",
            batch,
            readings.where(late).select("meter_id", "op_date", "position", reason.alias("reason")),
        )
        closing = written.groupBy("meter_id").agg(
            F.max("op_date").alias("op_date"), F.max_by("balance", F.struct("op_date", "position")).alias("balance")
        )
        self._write("closing", batch, closing)
        if batch % self.compact == self.compact - 1:
            every = past.unionByName(self.read("closing").where(F.col("batch") == batch))
            latest = F.max_by(F.struct("op_date", "balance"), F.struct("batch", "op_date")).alias("_last")
            self._write("snapshot", batch, every.groupBy("meter_id").agg(latest).select("meter_id", "_last.*"))

    def run(self, readings: DataFrame) -> StreamingQuery:
        """Process everything available from a streaming DataFrame of readings and stop."""

        def step(df: DataFrame, batch: int) -> None:
            held = df.persist()
            try:
                self.apply(held, batch)
            finally:
                held.unpersist()

        return (
            readings.writeStream.foreachBatch(step)
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
