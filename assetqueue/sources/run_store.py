"""The store of triage runs (S8, S6): many runs side by side, readers see complete ones only.

Layout below one folder: a table ``<name>/snapshot_date=../run_id=../`` for each
result and a table ``runs/run_id=../`` of manifests. A run writes its results
first, each into partitions of its own (dynamic overwrite, so a retry replaces its
own files and nobody else's), and its manifest last: key, time, and the rows and
schema of each result (an empty one has no files). A reader starts from the
manifests; what a run left behind that never got so far is not seen. One ``run_ts``
holds for all results of a run.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from assetqueue.sources.tables import stamp_results, write_table

RUNS = "runs"
MANIFEST = ("run_id string, run_ts timestamp, snapshot_date date, horizon int, model string, ranking string, "
            "tables map<string, struct<rows: bigint, schema: string>>")
KEYS = ("horizon", "model", "ranking")


class IncompleteRun(ValueError):
    pass


@dataclass(frozen=True)
class Run:
    """What a run is stored under; made once, used for every result."""

    snapshot_date: dt.date
    horizon: int
    model: str
    ranking: str
    run_ts: dt.datetime
    run_id: str

    @classmethod
    def new(cls, snapshot_date, horizon: int, model: str, ranking: str, run_ts: dt.datetime | None = None):
        if isinstance(snapshot_date, str):
            snapshot_date = dt.date.fromisoformat(snapshot_date)
        ts = run_ts or dt.datetime.now(dt.timezone.utc)
        return cls(snapshot_date, int(horizon), model, ranking, ts, f"{ts:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}")


class RunStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, run: Run, name: str, df: DataFrame) -> tuple[int, str]:
        """Store one result of a run; returns its rows, counted while they are written, and its schema."""
        if name == RUNS:
            raise ValueError(f"{RUNS!r} is the table of manifests")
        seen = Observation()
        keep = [c for c in df.columns if c not in ("snapshot_date", "run_id", "run_ts", "stamp", *KEYS)]
        out = stamp_results(df.select(*keep), F.lit(run.snapshot_date), run.horizon, run.model, run.ranking, F.lit(run.run_ts))
        out = out.withColumn("run_id", F.lit(run.run_id))
        write_table(out.observe(seen, F.count(F.lit(1)).alias("n")), f"{self.path}/{name}", partition_by=("snapshot_date", "run_id"))
        return int(seen.get["n"]), out.schema.json()

    def commit(self, run: Run, tables: dict[str, tuple]) -> None:
        """The manifest: from here on readers see the run."""
        row = (run.run_id, run.run_ts, run.snapshot_date, run.horizon, run.model, run.ranking, tables)
        write_table(self.spark.createDataFrame([row], MANIFEST).coalesce(1), f"{self.path}/{RUNS}", partition_by=("run_id",))

    def publish(self, run: Run, tables: dict[str, DataFrame]) -> Run:
        self.commit(run, {name: self.write(run, name, df) for name, df in tables.items()})
        return run

    def runs(self) -> DataFrame:
        """Complete runs, one row each; empty before the first."""
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/{RUNS}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def latest_runs(self, keys=KEYS) -> DataFrame:
        """The last complete run of each key: the latest time, the larger id between equal ones."""
        newest = self.runs().groupBy(*keys).agg(F.max(F.struct("run_ts", "run_id")).alias("at"))
        return newest.select(*keys, "at.run_ts", "at.run_id")

    def _open(self, name: str, chosen: list) -> DataFrame:
        """The rows of the runs ``chosen`` (run_id, run_ts, schema), in the newest schema; scans only their partitions."""
        if not chosen:
            raise IncompleteRun(f"{name}: no complete run has this result")
        schema = T.StructType.fromJson(json.loads(max(chosen, key=lambda r: (r.run_ts, r.run_id)).schema))
        try:
            df = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)
        return df.where(F.col("run_id").isin([r.run_id for r in chosen])).select(schema.names)

    def _chosen(self, name: str, runs: DataFrame) -> list:
        """One small row for each run wanted."""
        return runs.where(F.map_contains_key("tables", F.lit(name))).select("run_id", "run_ts", F.col("tables")[name]["schema"].alias("schema")).collect()

    def read(self, name: str, keys=KEYS, run_id: str | None = None) -> DataFrame:
        """A result of the latest complete run of each key, or of one run."""
        runs = self.runs()
        if run_id is None:
            runs = runs.join(self.latest_runs(keys).select("run_id"), "run_id", "left_semi")
        else:
            runs = runs.where(F.col("run_id") == run_id)
        return self._open(name, self._chosen(name, runs))

    def history(self, name: str, keys=KEYS, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """A result day by day, each by the latest complete run of its key and day, between two days if given."""
        runs = self.runs()
        for day, inside in ((first, F.col("snapshot_date") >= F.lit(first)), (last, F.col("snapshot_date") <= F.lit(last))):
            runs = runs.where(inside) if day is not None else runs
        newest = runs.groupBy(*keys, "snapshot_date").agg(F.max(F.struct("run_ts", "run_id")).alias("at")).select("at.run_id")
        return self._open(name, self._chosen(name, runs.join(newest, "run_id", "left_semi")))

    def check(self, run_id: str) -> DataFrame:
        """(name, listed, found): rows of each result by the run's manifest and in the store."""
        tables = [r.tables for r in self.runs().where(F.col("run_id") == run_id).collect()]
        rows = [(name, x.rows, self.read(name, run_id=run_id).count()) for t in tables for name, x in sorted(t.items())]
        return self.spark.createDataFrame(rows, "name string, listed long, found long")
