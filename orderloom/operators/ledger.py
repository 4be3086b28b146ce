"""What each run has done so far, so that a later one can finish what an earlier one has left.

A run writes a row at each step. The files of a run count as taken once it has merged them; until then its rows stay in the
staging table under its load id. A run that had not staged its files is given up, and its files are loaded by the next one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import storage
from orderloom.schema import RUN_LEDGER

STARTED, STAGED, MERGED, SUMMARISED, DONE, ABANDONED = "STARTED", "STAGED", "MERGED", "SUMMARISED", "DONE", "ABANDONED"
STATES = (STARTED, STAGED, MERGED, SUMMARISED, DONE, ABANDONED)


@dataclass(frozen=True)
class Run:
    """``token`` names one attempt under a load id: it is the id of the attempt's merge."""

    process: str
    load_id: str
    token: str
    state: str = STARTED

    def reached(self, state: str) -> bool:
        return STATES.index(self.state) >= STATES.index(state)


@dataclass(frozen=True)
class RunLedger:
    path: str

    def write(self, spark: SparkSession, run: Run, state: str) -> Run:
        step = (run.process, run.load_id, run.token, state, STATES.index(state))
        rows = spark.createDataFrame([step], "process string, load_id string, token string, state string, step int")
        rows.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)
        return Run(run.process, run.load_id, run.token, state)

    def start(self, spark: SparkSession, process: str, load_id: str) -> Run:
        return self.write(spark, Run(process, load_id, uuid.uuid4().hex), STARTED)

    def read(self, spark: SparkSession) -> DataFrame:
        """All steps of all runs."""
        storage.make_folder(spark, self.path)
        return storage.read_table(spark, self.path, RUN_LEDGER)

    def runs(self, spark: SparkSession) -> DataFrame:
        """A row for each run, with the state that it has reached."""
        return self.read(spark).groupBy("process", "load_id", "token").agg(
            F.max_by("state", "step").alias("state"), F.min("at").alias("began"), F.max("at").alias("latest")
        )

    def unfinished(self, spark: SparkSession, process: str) -> list[Run]:
        """The runs of a process that are neither done nor given up, oldest first. As each run first finishes these, they
        are few."""
        left = self.runs(spark).where((F.col("process") == process) & ~F.col("state").isin(DONE, ABANDONED))
        rows = left.orderBy("began", "token").collect()
        return [Run(row["process"], row["load_id"], row["token"], row["state"]) for row in rows]
