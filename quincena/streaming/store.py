"""Versioned Parquet tables for ``foreachBatch`` targets.

No transactional table format is on the classpath, so a target is a folder of
versions ``{root}/v=<number>``. A version counts only with the ``_SUCCESS``
mark that Spark writes last, so a half-written folder is never read. Which
versions exist is taken from folder names (never from rows: an empty version
is a version), and the paths of the folders needed are handed to the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION_COL = "v"
COMMIT_MARK = "_SUCCESS"
WRITERS = "_writers"


class _Versions:
    """Folders of one target: committed versions and the numbers of new ones."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._fs(), self._path(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _delete(self, *parts: str) -> None:
        self._fs().delete(self._path(*parts), True)

    def _folder(self, version: int) -> str:
        return f"{VERSION_COL}={version}"

    def next_number(self, folder: str, mark: str) -> int:
        """The number after the highest of the folders named ``mark<number>`` in ``folder``."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return max((int(n[len(mark):]) for n in names if n.startswith(mark)), default=-1) + 1

    def committed(self) -> list[int]:
        """Numbers of the committed versions, ascending."""
        fs, mark = self._fs(), VERSION_COL + "="
        return sorted(int(n[len(mark):]) for n in self._names()
                      if n.startswith(mark) and fs.exists(self._path(n, COMMIT_MARK)))

    def version_of(self, batch_id: int) -> int:
        """Version number of a micro-batch of the stream that is running.

        Batch ids restart at 0 with a new checkpoint, so each stream (its id
        lives in its checkpoint) gets an offset when it first writes here:
        its batches follow the newest committed version. The offset is kept
        beside the versions, so a replayed batch gets its own number again.
        """
        writer = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        marks = sorted((int(n.split("_")[0]), *n.split("_")[1:]) for n in self._names(WRITERS))
        if marks and marks[-1][1] == writer:
            return int(marks[-1][2]) + batch_id
        newest = max(self.committed(), default=-1)
        self._fs().create(self._path(WRITERS, f"{len(marks)}_{writer}_{newest + 1 - batch_id}"), True).close()
        return newest + 1


class VersionedTable(_Versions):
    """A table replaced as a whole by each version; the two newest are kept."""

    def read(self, before: int | None = None, schema: T.StructType | None = None) -> DataFrame | None:
        """Newest committed version (below ``before`` when given). Where there
        is none: an empty frame of ``schema``, or None without a schema."""
        found = [v for v in self.committed() if before is None or v < before]
        if not found:
            return None if schema is None else self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.root}/{self._folder(found[-1])}")

    def commit(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{self._folder(version)}")
        for old in self.committed()[:-2]:
            self._delete(self._folder(old))


class AppendedTable(_Versions):
    """A table that only grows: each version holds the rows its batch added,
    and the table is all of them together. What a batch writes follows what it
    adds, however large the table is."""

    def read(self, before: int | None = None, schema: T.StructType | None = None) -> DataFrame | None:
        """All committed versions (below ``before`` when given). Where there
        is none: an empty frame of ``schema``, or None without a schema."""
        found = [v for v in self.committed() if before is None or v < before]
        if not found:
            return None if schema is None else self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*[f"{self.root}/{self._folder(v)}" for v in found])

    def commit(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{self._folder(version)}")


class PartitionedVersions(_Versions):
    """A table whose partitions are versioned independently:
    ``{root}/v=<number>/<part_col>=<value>/``. A version holds only the
    partitions its batch touched; the table is each partition's newest version.

    Folder names only group rows: Spark writes NULL and '' to one folder, so
    the true value travels in the files (as ``_<part_col>``) and is the one
    that is read. Reads take the table's schema.
    """

    def __init__(self, spark: SparkSession, root: str, part_col: str):
        super().__init__(spark, root)
        self.part_col, self.value_col = part_col, "_" + part_col

    def folders(self, version: int) -> list[str]:
        """Partition folders that a version wrote."""
        return [n for n in self._names(self._folder(version)) if n.startswith(self.part_col + "=")]

    def _load(self, schema: T.StructType, paths: list[str], parts) -> DataFrame:
        p = self.part_col
        stored = T.StructType([T.StructField(self.value_col if f.name == p else f.name, f.dataType)
                               for f in schema.fields])
        df = self.spark.read.schema(stored).parquet(*paths) if paths else self.spark.createDataFrame([], stored)
        df = df.withColumnRenamed(self.value_col, p)
        if parts is None:
            return df
        if isinstance(parts, list):
            parts = self.spark.createDataFrame([(v,) for v in parts], T.StructType([T.StructField(p, schema[p].dataType)]))
        keys = parts.select(F.col(p).alias("_p")).distinct()
        return df.join(keys, df[p].eqNullSafe(keys["_p"]), "left_semi")

    def read_all(self, schema: T.StructType, upto: int | None = None, parts=None,
                 folders: list[str] | None = None) -> DataFrame | None:
        """Every version's rows (for append-only logs) of the partition
        ``folders`` named (all by default) and, of these, the rows whose
        partition value is in ``parts`` (a list or a DataFrame)."""
        versions = [v for v in self.committed() if upto is None or v <= upto]
        paths = [f"{self.root}/{self._folder(v)}/{n}" for v in versions for n in self.folders(v)
                 if folders is None or n in set(folders)]
        return self._load(schema, paths, parts) if versions else None

    def read_version(self, schema: T.StructType, version: int) -> DataFrame:
        """The rows that one version wrote."""
        return self._load(schema, [f"{self.root}/{self._folder(version)}/{n}" for n in self.folders(version)], None)

    def read(self, schema: T.StructType, before: int | None = None, parts=None,
             folders: list[str] | None = None) -> DataFrame | None:
        """Each partition's newest version (below ``before``); other
        versions are not read."""
        versions = [v for v in self.committed() if before is None or v < before]
        newest = {n: v for v in versions for n in self.folders(v) if folders is None or n in set(folders)}
        paths = [f"{self.root}/{self._folder(v)}/{n}" for n, v in newest.items()]
        return self._load(schema, paths, parts) if versions else None

    def commit(self, df: DataFrame, version: int, keep: int | None = None, dealt: bool = False) -> None:
        """Write the new state of the partitions present in ``df``. The
        rebalance hint groups rows by partition value before the write (few
        files per partition) and lets AQE split a very large partition over
        several tasks and merge small ones; ``dealt`` rows stay where they
        are. With ``keep``, that many newest
        versions of each written partition are kept."""
        rows = df.withColumn(self.value_col, F.col(self.part_col))
        ((rows if dealt else rows.hint("rebalance", self.part_col))
         .write.mode("overwrite").partitionBy(self.part_col).parquet(f"{self.root}/{self._folder(version)}"))
        if keep is None:
            return
        written = set(self.folders(version))
        held = {v: set(self.folders(v)) for v in self.committed()}
        for name in written:
            for old in [v for v in sorted(held) if name in held[v]][:-keep]:
                self._delete(self._folder(old), name)
                held[old].discard(name)
        for v in [v for v in held if v < version and not held[v]]:
            self._delete(self._folder(v))


# States of a history's rows; in a mended partition the rows are all there is of it.
OPEN, CLOSED, MENDED_OPEN, MENDED_CLOSED = "open", "closed", "mended-open", "mended-closed"
STATE = "_state"
STATES_OPEN, STATES_CLOSED = (OPEN, MENDED_OPEN), (CLOSED, MENDED_CLOSED)


class HistoryVersions(PartitionedVersions):
    """A change history that grows by folding: ``{root}/v=<number>/<part_col>=<value>/_state=<state>/``.

    A version holds, for each partition its batch touched, all open rows and
    the rows that closed in it or, where late events changed what had closed
    before (a mended partition), all closed rows. The table is each
    partition's newest open rows and its closed ones from the last mending on.
    One write commits all of it.
    """

    def __init__(self, spark: SparkSession, root: str, part_col: str, cluster_by: tuple[str, ...] = ()):
        super().__init__(spark, root, part_col)
        self.cluster_by = cluster_by

    def _states(self, version: int, name: str) -> list[str]:
        return [n.split("=")[1] for n in self._names(self._folder(version), name) if n.startswith(STATE + "=")]

    def _chosen(self, before: int | None, folders: list[str] | None, states: tuple[str, ...]) -> list[str] | None:
        versions = [v for v in self.committed() if before is None or v < before]
        paths: dict[str, list[str]] = {}
        for v in versions:
            for name in self.folders(v):
                if folders is not None and name not in folders:
                    continue
                here = self._states(v, name)
                older = [] if MENDED_OPEN in here else [p for p in paths.get(name, []) if p.rsplit("=", 1)[1] in STATES_CLOSED]
                paths[name] = older + [f"{self.root}/{self._folder(v)}/{name}/{STATE}={x}" for x in here]
        chosen = [p for found in paths.values() for p in found if p.rsplit("=", 1)[1] in states]
        return chosen if versions else None

    def read(self, schema: T.StructType, before: int | None = None, folders: list[str] | None = None,
             states: tuple[str, ...] = STATES_OPEN + STATES_CLOSED) -> DataFrame | None:
        paths = self._chosen(before, folders, states)
        return None if paths is None else self._load(schema, paths, None)

    def commit(self, df: DataFrame, version: int, keep: int = 2, dealt: bool = False) -> None:
        """Write a version of rows with a ``_state``; of older versions the
        open rows and what mending has replaced are deleted, but for those
        that the ``keep`` newest versions of a partition still show. ``dealt``
        rows are grouped by partition already and stay where they are."""
        folder = F.when(F.col(self.part_col).cast("string") != "", F.col(self.part_col))  # '' shares NULL's folder
        rows = df.withColumn(self.value_col, F.col(self.part_col)).withColumn(self.part_col, folder)
        ((rows if dealt else rows.hint("rebalance", self.part_col, STATE)).sortWithinPartitions(self.part_col, STATE, *self.cluster_by)
         .write.mode("overwrite").partitionBy(self.part_col, STATE).parquet(f"{self.root}/{self._folder(version)}"))
        written = set(self.folders(version))
        versions = self.committed()
        for name in written:
            held = [v for v in versions if name in self.folders(v)]
            shown = {p for v in held[-keep:] for p in self._chosen(v + 1, [name], STATES_OPEN + STATES_CLOSED)}
            for v in held:
                for state in self._states(v, name):
                    if f"{self.root}/{self._folder(v)}/{name}/{STATE}={state}" not in shown:
                        self._delete(self._folder(v), name, f"{STATE}={state}")
