"""Landing writer: one Parquet file per report, under the report's own name.

A Python data source. Rows come dealt and sorted by file name, so a task sees
a file's rows together and streams them into one Parquet file in a staging
folder (which readers skip). The commit, on the driver, moves the files of the
attempts that counted to their names; a failed attempt, or a write that is
aborted, leaves none. Writing a report again replaces its file, so a replayed
run lands nothing twice."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FILE = "landing_file"
STAGING = "_staging"


@dataclass
class Landed(WriterCommitMessage):
    """What one task attempt wrote."""

    folder: str
    names: list[str]


class LandingWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.job = path.rstrip("/"), uuid.uuid4().hex

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else \
            (fs.LocalFileSystem(), self.path)

    def write(self, iterator) -> Landed:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        fs, root = self._fs()
        folder = f"{root}/{STAGING}/{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(folder, recursive=True)
        names, writer = [], None
        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch])
                for name in pc.unique(table.column(FILE)).to_pylist():  # in order: rows come sorted
                    part = table.filter(pc.equal(table.column(FILE), name)).drop_columns([FILE])
                    if not names or names[-1] != name:
                        if writer is not None:
                            writer.close()
                        names.append(name)
                        writer = pq.ParquetWriter(f"{folder}/{name}", part.schema, filesystem=fs)
                    writer.write_table(part)
        finally:
            if writer is not None:
                writer.close()
        return Landed(folder, names)

    def commit(self, messages) -> None:
        fs, root = self._fs()
        for message in messages:
            for name in message.names if message is not None else []:
                fs.move(f"{message.folder}/{name}", f"{root}/{name}")
        self._clean(fs, root)

    def abort(self, messages) -> None:
        self._clean(*self._fs())

    def _clean(self, fs, root: str) -> None:
        from pyarrow.fs import FileType

        staged = f"{root}/{STAGING}/{self.job}"
        if fs.get_file_info(staged).type == FileType.Directory:
            fs.delete_dir(staged)


class LandingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landing"

    def writer(self, schema, overwrite: bool):
        return LandingWriter(self.options["path"])


def land_files(rows: DataFrame, path: str) -> None:
    """Write ``rows`` (with the file's name in ``landing_file``) as one file a
    name into ``path``, a folder that driver and executors share. A name is
    one task's, so a file's size is bounded by the report it holds, and memory
    by an Arrow batch."""
    spark = rows.sparkSession
    spark.dataSource.register(LandingSource)
    rows.repartition(FILE).sortWithinPartitions(FILE).write.format("landing").mode("append").save(path)
