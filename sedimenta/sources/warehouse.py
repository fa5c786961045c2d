"""Stored tables, replaced as a whole.

A build writes every table under a path of its own. Once all tables of the layer are
complete, a new snapshot of the catalog lists them beside the tables that stay. Readers
resolve a name by the newest snapshot, or one they name, so a failed build leaves the last
good version in place and no path is overwritten while it is being read. Of two builds of
the same table at once, the first to be complete wins as a whole and the other raises
``ConflictError``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.sources.snapshots import ConflictError, commit, newest, snapshot_path

CATALOG_SCHEMA = "run_id string, layer string, table_name string, n_rows bigint, path string"
SNAPSHOT_SCHEMA = f"{CATALOG_SCHEMA}, version bigint"


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def replace(self, layer: str, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]) -> dict[str, int]:
        """Write all tables, then switch to them together. Returns the row counts.

        Counts come from the write itself, without a second scan. A table given as
        a function is built when its turn comes and can read the tables before it
        in this call through ``staged``. When another build has replaced one of the
        tables since this call began, nothing changes and ``ConflictError`` is raised.
        """
        begun = self.version()
        now = datetime.now(timezone.utc)
        run_id = f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        rows = []
        for name, table in tables.items():
            path = self._path(run_id, name)
            df = table(run_id) if callable(table) else table
            counted = Observation()
            df.observe(counted, F.count(F.lit(1)).alias("n_rows")).write.parquet(path)
            rows.append((run_id, layer, name, counted.get["n_rows"], path))
        fields = ("run_id", "layer", "table_name", "n_rows", "path")
        built = {row[2]: dict(zip(fields, row)) for row in rows}

        def following(version: int) -> list[dict]:
            state = {row["table_name"]: row.asDict() for row in self._state(version).collect()}
            late = sorted(name for name in built if name in state and state[name]["version"] > begun)
            if late:
                raise ConflictError(f"replaced by another build in the meantime: {', '.join(late)}")
            new = {name: row | {"version": version + 1} for name, row in built.items()}
            return list((state | new).values())

        commit(self.spark, self._snapshots, following)
        return {row[2]: row[3] for row in rows}

    def version(self) -> int:
        """The number of the newest snapshot; every ``replace`` adds one."""
        return newest(self.spark, self._snapshots)

    def staged(self, run_id: str, name: str) -> DataFrame:
        """A table already written by the running ``replace`` call."""
        return self.spark.read.parquet(self._path(run_id, name))

    def tables(self, version: int | None = None) -> DataFrame:
        """``(layer, table_name, n_rows, path)`` of the version of every table that is current, or was at ``version``."""
        state = self._state(self.version() if version is None else version)
        return state.select("layer", "table_name", "n_rows", "path").orderBy("layer", "table_name")

    def read(self, name: str, version: int | None = None) -> DataFrame:
        current = self.tables(version).filter(F.col("table_name") == name).first()
        if current is None:
            raise LookupError(f"no table {name!r} in {self.root}")
        return self.spark.read.parquet(current["path"])

    def row_counts(self) -> DataFrame:
        """``(layer, table_name, n_rows)`` as recorded when the tables were written."""
        return self.tables().drop("path")

    @property
    def _snapshots(self) -> str:
        return f"{self.root}/snapshots"

    @property
    def _catalog(self) -> str:
        return f"{self.root}/catalog"

    def _path(self, run_id: str, name: str) -> str:
        return f"{self.root}/tables/{name}/{run_id}"

    def _state(self, version: int) -> DataFrame:
        """A row per table as of a snapshot. Snapshot 0 is the list of builds that earlier releases appended to."""
        if version:
            return self.spark.read.schema(SNAPSHOT_SCHEMA).json(snapshot_path(self._snapshots, version))
        last = F.max_by(F.struct("run_id", "layer", "n_rows", "path"), "run_id").alias("last")
        listed = self._listed().groupBy("table_name").agg(last)
        fields = ["last.run_id", "last.layer", "table_name", "last.n_rows", "last.path"]
        return listed.select(*fields, F.lit(0).cast("long").alias("version"))

    def _listed(self) -> DataFrame:
        try:
            return self.spark.read.schema(CATALOG_SCHEMA).json(self._catalog)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], CATALOG_SCHEMA)
