"""Streaming distinct consolidation (T1, re-aimed from a re-run-by-hand script).

The stream tells which files of a folder are new; each micro-batch reads its files as tables,
binding columns by name, and appends the distinct values of one column that the
stored result does not hold yet (a stream-static anti join in ``foreachBatch``). The result is thus its own state: a
new checkpoint, or a result written by another job, starts from what is stored. A batch writes one folder, named
by query and batch, and counts once its ``_SUCCESS`` marker exists; a batch that is run again after a failure
replaces its own folder. ``availableNow`` processes what is there and stops, so the job can run on a schedule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.model import quote
from canonix.operators.values import complete_folders

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def _read(spark: SparkSession, files: list[str], file_format: str, schema: T.StructType | None) -> DataFrame:
    if file_format == "csv":
        from canonix.sources.tables import read_csv

        return read_csv(spark, files, schema, infer=False)
    reader = spark.read.format(file_format)
    return (reader.schema(schema) if schema else reader).load(files)


def consolidate_stream(
    spark: SparkSession,
    input_folder: str,
    column: str,
    output_path: str,
    checkpoint_path: str,
    schema: T.StructType | None = None,
    file_format: str = "csv",
    files_per_batch: int = 1000,
) -> None:
    """Run one ``availableNow`` pass: new distinct non-null values of ``column`` to Parquet.

    Files without the column add nothing. A ``schema`` is bound by name for CSV.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = sorted(r[0] for r in batch.select("path").collect())  # names, ``files_per_batch`` at most
        if not files:
            return
        table = _read(session, files, file_format, schema)
        if column not in table.columns:
            return
        name = f"q-{session.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        values = table.select(F.col(quote(column)).cast("string").alias("value")).where("value IS NOT NULL").distinct()
        stored = [p for p in complete_folders(session, output_path) if p.rstrip("/").rsplit("/", 1)[-1] != name]
        if stored:
            values = values.join(session.read.schema("value string").parquet(*stored), "value", "left_anti")
        values.write.mode("overwrite").parquet(f"{output_path.rstrip('/')}/{name}")

    q = (
        spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_per_batch).load(input_folder)
        .select("path")  # contents are not read here
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def read_consolidated(spark: SparkSession, output_path: str, column: str) -> DataFrame:
    """The consolidated values so far, sorted."""
    stored = complete_folders(spark, output_path)
    values = spark.read.schema("value string").parquet(*stored) if stored else spark.createDataFrame([], "value string")
    return values.select(F.col("value").alias(column)).orderBy(F.col(quote(column)))
