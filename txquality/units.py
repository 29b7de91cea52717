"""Tables made of units: deliveries or loads that are each replaced as a whole.

Every write of a unit goes to a folder of its own. A manifest beside the data, one small
entry for each write, is appended after the write has succeeded and names the folder that
counts; readers resolve the table through it. So a unit that is written again, with other
partitions or none, replaces all of its rows at once, a reader never sees half of one, a
write that fails leaves no trace, and no folder but those that count is ever listed.

A table whose writes each replace many units (``together``) keeps a folder for each write,
with its units below it; otherwise each unit has a folder, with its writes below it.

Folders of replaced writes stay until ``drop_replaced`` deletes them, so readers that
have started may finish. One writer per table at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txquality.sinks import write_partitioned
from txquality.sources.files import if_present

ATTEMPT_COLUMN = "_attempt"
_ENTRY = "number long, unit string, attempt string, n_rows long"
# narrow rows that a task is to hold: some 100 MB in memory
ROWS_PER_TASK = 500_000


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_TASK))


@dataclass(frozen=True)
class Units:
    """A table of units at a location; ``column`` holds a row's unit and is part of the paths."""

    location: str
    column: str
    together: bool = False

    @property
    def root(self) -> str:
        return self.location.rstrip("/")

    @property
    def manifest(self) -> str:
        return f"{self.root}/_manifest"

    def folder(self, unit: str, attempt: str) -> str:
        of_unit, of_write = f"{self.column}={unit}", f"{ATTEMPT_COLUMN}={attempt}"
        return "/".join((self.root, of_write, of_unit) if self.together else (self.root, of_unit, of_write))

    def entries(self, spark: SparkSession) -> DataFrame | None:
        return if_present(lambda: spark.read.schema(_ENTRY).json(self.manifest))

    def current(self, spark: SparkSession) -> dict[str, tuple[str, int]]:
        """The write of each unit that counts, and its rows."""
        entries = self.entries(spark)
        if entries is None:
            return {}
        last = entries.groupBy("unit").agg(F.max_by(F.struct("attempt", "n_rows"), "number").alias("last"))
        return {r["unit"]: (r["last"]["attempt"], r["last"]["n_rows"]) for r in last.collect()}

    def _stored(self, schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField(self.column, T.StringType()), T.StructField(ATTEMPT_COLUMN, T.StringType())])

    def read(self, spark: SparkSession, schema: T.StructType, units: Sequence[str] | None = None, with_attempt: bool = False) -> DataFrame:
        """Rows of the units (all of them by default), with the unit's id as text, and on demand the write they are of."""
        full, left_out = self._stored(schema), () if with_attempt else (ATTEMPT_COLUMN,)
        chosen = {u: a for u, a in self.current(spark).items() if units is None or u in units}
        paths = [self.folder(unit, attempt) for unit, (attempt, rows) in sorted(chosen.items()) if rows]
        if not paths:
            return spark.createDataFrame([], full).drop(*left_out)
        return spark.read.schema(full).option("basePath", self.root).parquet(*paths).drop(*left_out)

    def replace(self, df: DataFrame, unit: str, partitions: Sequence[str] = (), rebalance: bool = True) -> str:
        """Write ``df`` as the unit's only rows; returns the write's number within the table."""
        self._refuse_bad([unit])
        if self.together:
            raise ValueError("units of this table are written many at a time")
        attempt, seen = uuid.uuid4().hex, Observation()
        write_partitioned(df, self.folder(unit, attempt), partitions, rebalance, (seen, {"n_rows": F.count(F.lit(1))}))
        self._append(df.sparkSession, attempt, {unit: seen.get["n_rows"]})
        return attempt

    def replace_each(
        self,
        df: DataFrame,
        units: Sequence[str],
        sort: Sequence[str] = (),
        at_most: Mapping[str, int] | None = None,
        spread: Sequence[str] = (),
    ) -> str:
        """Write ``df`` as the only rows of all the units named, by its unit column; one without a row becomes empty.

        One write, and one entry in the manifest for all of them, so that readers see all
        units change at once. Rows are shuffled by unit (a large one is split among tasks)
        and lie in the order of ``sort``. A row of a unit not named is an error.

        Tasks are sized by their bytes as shuffled. Narrow rows that compress well take many
        times that in memory: ``at_most``, how many rows each unit can have, sizes tasks by
        rows instead, and splits a large unit by the ``spread`` columns.
        """
        self._refuse_bad(units)
        if not self.together:
            raise ValueError("units of this table are written one at a time")
        spark, attempt = df.sparkSession, uuid.uuid4().hex
        wrong = F.raise_error(F.concat(F.lit(f"a row of another {self.column}: "), F.coalesce(F.col(self.column), F.lit("NULL"))))
        known = F.coalesce(F.col(self.column).isin(list(units)), F.lit(False))
        checked = df.filter(F.when(known, F.lit(True)).otherwise(wrong.cast("boolean"))) if units else df.limit(0)
        spaced = checked.hint("rebalance", self.column) if at_most is None else self._by_rows(checked, at_most, spread)
        laid_out = spaced.sortWithinPartitions(self.column, *sort)
        folder = f"{self.root}/{ATTEMPT_COLUMN}={attempt}"
        laid_out.write.partitionBy(self.column).parquet(folder)
        written = spark.read.schema(self._stored(T.StructType())).option("basePath", self.root).parquet(folder)
        rows = {r[self.column]: r["count"] for r in written.groupBy(self.column).count().collect()}
        self._append(spark, attempt, {unit: rows.get(unit, 0) for unit in units})
        return attempt

    def _by_rows(self, df: DataFrame, at_most: Mapping[str, int], spread: Sequence[str]) -> DataFrame:
        """Rows laid out so that no task gets far more than ``ROWS_PER_TASK``: a large unit has several tasks, small ones share."""
        places, before = [], 0
        for unit, rows in sorted(at_most.items()):
            places.append((unit, before // ROWS_PER_TASK, tasks_for(rows)))
            before += rows
        tasks = max((first + parts for _, first, parts in places), default=1)
        # one row for each unit
        known = F.broadcast(df.sparkSession.createDataFrame(places, f"`{self.column}` string, _first int, _parts int"))
        task = F.col("_first") + F.pmod(F.xxhash64(*spread), F.col("_parts")).cast("int")
        return df.join(known, self.column).repartitionById(tasks, task).select(*df.columns)

    def _refuse_bad(self, units: Sequence[str]) -> None:
        if not all(re.fullmatch(r"\w[\w.-]*", unit) for unit in units):
            raise ValueError(f"{self.column} holds letters, digits, dots, dashes and underscores only")

    def _append(self, spark: SparkSession, attempt: str, rows: dict[str, int]) -> None:
        entries = self.entries(spark)
        last = entries.agg(F.max("number")).first()[0] if entries is not None else 0
        new = [((last or 0) + 1, unit, attempt, many) for unit, many in rows.items()]
        if new:
            spark.createDataFrame(new, _ENTRY).coalesce(1).write.mode("append").json(self.manifest)

    def drop_replaced(self, spark: SparkSession) -> int:
        """Delete the folders of writes that a later one of the same unit has replaced; how many there were."""
        entries = self.entries(spark)
        if entries is None:
            return 0
        current, gone = self.current(spark), 0
        for r in entries.select("unit", "attempt").toLocalIterator():
            if current[r["unit"]][0] != r["attempt"]:
                path = spark._jvm.org.apache.hadoop.fs.Path(self.folder(r["unit"], r["attempt"]))
                gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return gone
