"""Landing files that the ingest could not read are set aside before it runs.

A stream over file names (their contents stay unread) meets each landed file
once. Tasks read the files' footers and compare them with the declared schema;
offenders go to the rejected folder, and a dead-letter table says which and
why. One bad file then stops no other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quincena.streaming.runner import run_available

FILES = "path string, modificationTime timestamp, length long, content binary"
REJECTED = "path string, reason string"
# What the reader widens by itself.
WIDENS = {("int", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("float", "double"), ("int", "double")}


def _fault(path: str, declared: dict[str, str]) -> str | None:
    """Why a file cannot be read with the declared columns, else None."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_type

    where, name = fs.FileSystem.from_uri(path.replace("file:///", "file:/").replace("file:/", "file:///"))
    try:
        schema = pq.read_schema(name, filesystem=where)
    except (pa.ArrowInvalid, OSError):
        return "not a Parquet file"
    for column in schema:
        want = declared.get(column.name.lower())
        if want is None:
            continue
        try:
            have = from_arrow_type(column.type).simpleString()
        except Exception:  # a type that Spark has no name for
            have = str(column.type)
        have, want = (t.removesuffix("_ntz") for t in (have, want))
        if have != want and (have, want) not in WIDENS:
            return f"column {column.name.lower()} is {have}, not {want}"
    return None


def rejects(files: DataFrame, schema: T.StructType) -> DataFrame:
    """``path, reason`` of the files (``path``) that the schema cannot read.
    Columns that a file lacks, or has beyond the declared ones, are no fault."""
    declared = {f.name.lower(): f.dataType.simpleString() for f in schema}

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [(p, r) for p in batch.column("path").to_pylist() if (r := _fault(p, declared)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()),
                                              pa.array([r for _, r in found], pa.string())], names=["path", "reason"])

    return files.select("path").mapInArrow(run, REJECTED)


def quarantine(spark: SparkSession, landing_dir: str, schema: T.StructType, rejected_dir: str, checkpoint: str) -> None:
    """Check what has landed since the last run. The dead-letter table is
    ``{rejected_dir}/letters`` (a row a file, written before the file moves);
    files go to ``{rejected_dir}/files`` under their own names. A run that
    dies between the two writes a file's letter again when it is repeated;
    ``rejected`` reads each once."""
    rejected_dir = rejected_dir.rstrip("/")
    stream = spark.readStream.format("binaryFile").schema(FILES).load(landing_dir).select("path")

    def apply(batch: DataFrame, batch_id: int) -> None:
        letters = f"{rejected_dir}/letters/batch={batch_id}"
        rejects(batch, schema).write.mode("overwrite").parquet(letters)
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        target = jvm.org.apache.hadoop.fs.Path(f"{rejected_dir}/files")
        fs = target.getFileSystem(conf)
        fs.mkdirs(target)
        for row in spark.read.schema(REJECTED).parquet(letters).toLocalIterator():  # bad files only, one by one
            source = jvm.org.apache.hadoop.fs.Path(row.path)
            if fs.exists(source):
                fs.rename(source, jvm.org.apache.hadoop.fs.Path(target, source.getName()))

    run_available(stream, checkpoint, foreach_batch=apply)


def rejected(spark: SparkSession, rejected_dir: str) -> DataFrame:
    """``file, reason`` of every file set aside."""
    return spark.read.schema(REJECTED).option("recursiveFileLookup", True).parquet(f"{rejected_dir.rstrip('/')}/letters").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "reason").distinct()
