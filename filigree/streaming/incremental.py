"""Incremental ingest: new index files are merged once, failed days stay in the backlog."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from filigree.operators import ledger as lg
from filigree.plans.snapshots import SnapshotTable


def read_new(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


#: The year of an accession number, "none" where there is none.
_YEAR = "coalesce(nullif(regexp_extract(accession_number, '-([0-9]{2})-', 1), ''), 'none')"


def ingest(stream: DataFrame, filings: SnapshotTable, runs: SnapshotTable, checkpoint: str, order: str) -> StreamingQuery:
    """Merges each micro-batch of filings into the table, once: a batch that the run table holds is skipped on replay.

    The table's parts are the years in the accession numbers, so a batch
    rewrites only the years that it has rows of.  A run is written after its
    merge; a merge that is repeated since the run wasn't written gives the same
    rows but for last_seen_run and updated_at.  A batch without rows is a run too.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        done = runs.read()
        if done is not None and done.where(F.col("batch_id") == batch_id).limit(1).count():
            return
        now = F.current_timestamp()
        incoming = lg.last_of_batch(batch, order).withColumn("year_", F.expr(_YEAR)).persist()
        try:
            years = {r["year_"]: r["count"] for r in incoming.groupBy("year_").count().collect()}  # one row a year
            rows = incoming.drop("year_")
            if years:
                stored = filings.read(years)
                if stored is None:
                    stored = lg.upserted(_blank(rows), rows, F.lit(batch_id), now).limit(0)
                filings.write(lg.upserted(stored, rows, F.lit(batch_id), now), F.expr(_YEAR))
        finally:
            incoming.unpersist()
        entry = batch.sparkSession.range(1).select(F.lit(batch_id).cast("long").alias("batch_id"), now.alias("at"), F.lit(sum(years.values())).cast("long").alias("rows"))
        runs.write(entry if done is None else done.unionByName(entry))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _blank(incoming: DataFrame) -> DataFrame:
    stamp = F.lit(None).cast("timestamp")
    run = F.lit(None).cast("int")
    return incoming.limit(0).select("*", run.alias("first_seen_run"), run.alias("last_seen_run"), stamp.alias("ingested_at"), stamp.alias("updated_at"))


def stream_counts(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """Rows by keys of all files of a folder or file, read as a stream that ends with them."""
    base = os.path.join(shared_dir(spark), f"counts-{uuid.uuid4().hex}")

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out")

    reader = spark.readStream.schema(schema)
    whole = spark._jvm.org.apache.hadoop.fs.Path(path)
    if whole.getFileSystem(spark._jsc.hadoopConfiguration()).isFile(whole):  # a stream reads folders
        stream = reader.option("pathGlobFilter", whole.getName()).parquet(whole.getParent().toString())
    else:
        stream = reader.parquet(path)
    query = stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset (tests) one of our own."""
    held = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not held:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        held = tempfile.mkdtemp(prefix="filigree-")
        atexit.register(shutil.rmtree, held, ignore_errors=True)
    return held


def retry_backlog(ledger: DataFrame, discovered: DataFrame, end: str, one_day: Callable[[str], str]) -> list[tuple[str, str]]:
    """Runs one_day for every day to do (one row a day, so the list is short); it returns the state, and an exception is failed."""
    out = []
    for row in lg.todo(discovered, ledger, F.lit(end)).collect():
        try:
            out.append((row["idx_date"], one_day(row["idx_date"])))
        except Exception:  # noqa: BLE001  the day stays in the backlog
            out.append((row["idx_date"], "failed"))
    return out
