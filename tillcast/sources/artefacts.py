"""Fitted parameters as Parquet tables, one folder per run."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.sources.sinks import read_if_there


@dataclass(frozen=True)
class ArtefactStore:
    """``base/name/run_id=…`` holds the parameters a run fitted."""

    spark: SparkSession
    base: str

    def save(self, name: str, run_id: str, params: DataFrame) -> None:
        params.write.mode("overwrite").parquet(f"{self.base}/{name}/run_id={run_id}")

    def runs(self, name: str) -> list[str]:
        """Run ids from the folder names (no data is read)."""
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        fs = jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(jvm_path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(jvm_path)]
        return sorted(n.removeprefix("run_id=") for n in names if n.startswith("run_id="))

    def load(self, name: str, run_id: str | None = None) -> DataFrame:
        """The asked run, or the only one there is."""
        if run_id is None:
            runs = self.runs(name)
            if len(runs) != 1:
                raise LookupError(f"artefact {name!r} needs exactly one run, found {runs}")
            run_id = runs[0]
        return self.spark.read.parquet(f"{self.base}/{name}/run_id={run_id}")


@dataclass(frozen=True)
class RunStore:
    """Runs that appear whole: all tables of a run are written to a folder of their own, then one commit names them.

    A commit is one row, written to its own folder and renamed into place by Spark's committer, so a run without one is
    invisible, whatever it has left, and writers side by side never touch each other's files. A run published again is
    replaced for readers at that moment; who reads the old tables goes on doing so.
    """

    spark: SparkSession
    base: str
    _COMMIT = "run_id string, folder string, tables array<string>, committed_at timestamp"

    def publish(self, run_id: str, tables: dict[str, DataFrame]) -> None:
        folder = f"{self.base}/tables/{uuid.uuid4().hex}"
        for name, table in tables.items():
            table.write.parquet(f"{folder}/{name}")
        row = self.spark.createDataFrame([(run_id, folder, sorted(tables))], "run_id string, folder string, tables array<string>")
        row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.json(f"{self.base}/commits/commit={uuid.uuid4().hex}")

    def commits(self) -> DataFrame:
        """run_id, folder, tables, committed_at: the last commit of each run."""
        found = read_if_there(self.spark, f"{self.base}/commits", self._COMMIT)
        last = F.max_by(F.struct("folder", "tables", "committed_at"), F.struct("committed_at", "folder")).alias("last")
        return found.groupBy("run_id").agg(last).select("run_id", "last.*")

    def runs(self) -> list[str]:
        """Ids in the order of their commits."""
        return [r["run_id"] for r in self.commits().orderBy("committed_at", "folder").collect()]

    def load(self, run_id: str | None = None) -> dict[str, DataFrame]:
        """The tables of the asked run, or of the one committed last."""
        found = self.commits() if run_id is None else self.commits().where(F.col("run_id") == run_id)
        last = found.orderBy(F.col("committed_at").desc(), F.col("folder").desc()).limit(1).collect()
        if not last:
            raise LookupError(f"no run {run_id!r}" if run_id is not None else "no run has been committed")
        return {name: self.spark.read.parquet(f"{last[0]['folder']}/{name}") for name in last[0]["tables"]}


def lookup(params: DataFrame, fold: int) -> DataFrame:
    """Parameters of one fold, by equality."""
    return params.where(F.col("fold") == fold)
