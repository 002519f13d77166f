"""Versions of a table's files.

New rows are written to a folder of their own below the table's folder. Only when that is
complete is the catalog pointed at it: the table's location, or the locations of the partitions
that changed. Files that a version replaces stay until the next one is published, for readers
that have begun with them. They are known by name from the table's own listing, so nothing else
in the table's folder is ever removed.

One writer at a time: a second one that began with the same version is refused before it
publishes. A writer that dies while it publishes leaves some partitions new and some old; the
same upsert once more brings the rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from mailtally.operators.sinks import table_location
from mailtally.session import delete_path

# --- fixed values: names that file listings skip, and the catalog's properties ---
VERSION = "_version-"
REPLACED = "_replaced"
PLACE = "_place"
CURRENT = "mailtally.version"
# --- end of fixed values ---


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_properties(spark: SparkSession, table: str, **values: str) -> None:
    listed = ", ".join(f"'mailtally.{k}' = '{quoted(v)}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def quoted(value: object) -> str:
    return str(value).replace("\\", "\\\\").replace("'", "\\'")


class NewVersion:
    """A version that is being written: ``folder`` is its place, ``publish_*`` its end."""

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.spark, self.table = spark, table
        now = table_location(spark, table)
        parent, _, last = now.rpartition("/")
        self.base = parent if last.startswith(VERSION) else now
        self.before = properties(spark, table).get(CURRENT)
        self.name = f"{VERSION}{uuid.uuid4().hex}"
        self.folder = f"{self.base}/{self.name}"

    def replaces(self, old: DataFrame) -> None:
        """Note the files that ``old``, read from the table, consists of."""
        rows = [(f,) for f in old.inputFiles()]
        listed = self.spark.createDataFrame(rows, T.StructType([T.StructField("file", T.StringType())]))
        listed.coalesce(1).write.text(f"{self.folder}/{REPLACED}")

    def publish_table(self) -> None:
        """The whole table is in the folder."""
        self._check()
        self.spark.sql(f"ALTER TABLE {self.table} SET LOCATION '{quoted(self.folder)}'")
        self._done()

    def publish_places(self, parts: Sequence[str], places: Sequence[tuple]) -> None:
        """Partition ``places[i]`` is in the sub-folder ``_place=i``; without one it is empty."""
        self._check()
        written = {name for name, _ in self._listing(self.folder)}
        for i, values in enumerate(places):
            spec = ", ".join(
                f"`{c}` = " + ("null" if v is None else f"'{quoted(v)}'")
                for c, v in zip(parts, values, strict=True)
            )
            where = f"{self.folder}/{PLACE}={i}"
            if f"{PLACE}={i}" in written:
                self._alter(f"ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{quoted(where)}'")
                self._alter(f"PARTITION ({spec}) SET LOCATION '{quoted(where)}'")
            else:
                # dropped at an empty place, since a managed partition's files go with it
                self._alter(f"ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{quoted(where)}'")
                self._alter(f"PARTITION ({spec}) SET LOCATION '{quoted(where)}'")
                self._alter(f"DROP IF EXISTS PARTITION ({spec})")
        self._done()

    def _alter(self, what: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.table} {what}")

    def _check(self) -> None:
        if properties(self.spark, self.table).get(CURRENT) != self.before:
            raise RuntimeError(f"{self.table} has been changed by another writer")

    def _done(self) -> None:
        set_properties(self.spark, self.table, version=self.name)
        self.spark.catalog.refreshTable(self.table)
        if self.before is not None:
            self._sweep(f"{self.base}/{self.before}/{REPLACED}")

    def _sweep(self, listing: str) -> None:
        """Remove the files that the version before this one replaced."""
        jvm = self.spark._jvm
        folders = {}
        for (uri,) in self.spark.read.text(listing).collect():
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
            self._fs(path).delete(path, False)
            folders[path.getParent().toString()] = path.getParent()
        for folder in folders.values():
            own = [x.getName() for x in (folder, folder.getParent())]
            data = [n for n, _ in self._listing(folder.toString()) if not n.startswith(("_", "."))]
            if any(n.startswith(VERSION) for n in own) and not data:
                delete_path(self.spark, folder.toString())

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listing(self, folder: str) -> list[tuple[str, str]]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = self._fs(path)
        found = fs.listStatus(path) if fs.exists(path) else []
        return [(e.getPath().getName(), e.getPath().toString()) for e in found]


def write_places(
    rows: DataFrame, folder: str, fmt: str, parts: Sequence[str], places: Sequence[tuple]
) -> None:
    """Write ``rows`` to a sub-folder for each place, ``_place=i`` for ``places[i]``.

    A row of no listed place fails the write. The list is as long as the number of partitions
    that change, which the catalog bounds, and is broadcast by Spark if it is small.
    """
    spark = rows.sparkSession
    kinds = [T.StructField(f"_{i}", rows.schema[c].dataType) for i, c in enumerate(parts)]
    schema = T.StructType([*kinds, T.StructField(PLACE, T.IntegerType())])
    listed = spark.createDataFrame([(*v, i) for i, v in enumerate(places)], schema)
    same = F.lit(True)
    for i, c in enumerate(parts):
        same = same & F.col(c).eqNullSafe(F.col(f"_{i}"))
    lost = F.raise_error(F.lit("a row belongs to a partition that was not read")).cast("int")
    placed = rows.join(listed, same, "left").withColumn(PLACE, F.coalesce(PLACE, lost))
    columns = [c for c in rows.columns if c not in parts]
    spread = placed.select(*columns, PLACE).hint("rebalance", PLACE)
    spread.write.format(fmt).mode("append").partitionBy(PLACE).save(folder)
