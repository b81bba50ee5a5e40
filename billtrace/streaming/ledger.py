"""File loads that survive crashes at any point: rows, and the ledger of what made them, are one commit.

Two ways in, one set of tables (``sources.versions``) out:

* ``stream_into`` runs a file stream in bounded micro-batches. The number of the last batch is published
  with its rows. Where a run dies between that and the checkpoint, the stream brings the batch again
  and it is recognised, so rows come out exactly once.
* ``load_files`` keeps a ledger: path, length and time of the file, bytes of its output, and the
  load that made it. Files that are new or have changed are parsed; so are, once more, files whose
  output was smaller than ``min_bytes``. Rows name their load, and the rows of a file are those of
  the load its ledger names, so a second parse replaces the first as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import discard, scratch_path
from ..sources import versions
from .files import FILE_SCHEMA

Parser = Callable[[DataFrame], DataFrame]
LEDGER = "path string, length long, modified timestamp, out_bytes long, load long, tries int"


def stream_into(
    spark: SparkSession,
    files: str,
    parser: Parser,
    root: str,
    table: str,
    checkpoint: str,
    glob: str = "*",
    max_files: int = 500,
    after_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Parse the files that the checkpoint has not seen into a table of a set, ``max_files`` at a time, then stop.

    An error in a batch ends the query with nothing of that batch visible; starting it again with the
    same checkpoint goes on with that batch. ``after_commit`` is called with the number of each batch once its
    rows are published. One stream writes to a set at a time; another writer's commit in
    between makes the batch fail and come again.
    """
    mark = f"stream:{table}"

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if versions.manifest(session, root).marks.get(mark, -1) >= number:
            return
        rows = parser(batch).withColumn("batch", F.lit(number).cast("long"))
        versions.commit(session, root, {table: (rows, [])}, append=True, marks={mark: number})
        if after_commit:
            after_commit(number)

    source = (
        spark.readStream.schema(FILE_SCHEMA)
        .format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(files)
    )
    return source.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The newest entry of each file."""
    name = f"{table}_ledger"
    if name not in versions.manifest(spark, root).tables:
        return spark.createDataFrame([], LEDGER)
    newest = Window.partitionBy("path").orderBy(F.desc("load"))
    return versions.read(spark, root, name).withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")


def waiting(listed: DataFrame, entries: DataFrame, min_bytes: int = 200, tries: int = 2, before: int | None = None) -> DataFrame:
    """Listed files to be parsed: new ones, changed ones, and those with a small output that have a try left.

    ``listed`` has path, length and modificationTime. A file whose output is small is parsed ``tries``
    times at most; a changed one starts anew. Files that load ``before`` or a later one made don't wait.
    """
    known = entries.withColumnsRenamed({"length": "__length", "load": "__load", "tries": "__tries"})
    both = listed.join(known, "path", "left")
    fresh = F.col("__load").isNull() | ~(F.col("length").eqNullSafe(F.col("__length")) & F.col("modificationTime").eqNullSafe(F.col("modified")))
    small = (F.col("out_bytes") < min_bytes) & (F.col("__tries") < tries)
    if before is not None:
        both = both.filter(F.col("__load").isNull() | (F.col("__load") < before))
    return both.filter(fresh | small).select("path", "length", "modificationTime", F.when(fresh, 1).otherwise(F.col("__tries") + 1).cast("int").alias("tries"))


def _literal(path: str) -> str:
    """A path as a pattern that matches itself only."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def load_files(
    spark: SparkSession,
    files: str,
    parser: Parser,
    root: str,
    table: str,
    out_bytes: Column | str,
    glob: str = "*",
    max_files: int = 500,
    min_bytes: int = 200,
    before_publish: Callable[[], None] | None = None,
) -> int:
    """Parse what waits below a folder, ``max_files`` at a time; returns the number of loads that were published.

    The parser gets path, modificationTime, length and content, and its rows keep ``path``. ``out_bytes``
    is the size of one of its rows; a file's output is the sum over its rows, none being 0 bytes. Only
    the files of a load are opened, and a call takes a file once. Files that appear while it runs
    wait for the next call. A file that is gone keeps its rows.
    """
    scan = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    listed = scan.load(files).select("path", "length", "modificationTime")
    first = versions.manifest(spark, root).version + 1
    loads = 0
    while True:
        todo = waiting(listed, ledger(spark, root, table), min_bytes, before=first)
        chosen = todo.orderBy("modificationTime", "path").limit(max_files).collect()
        if not chosen:
            return loads
        number = versions.manifest(spark, root).version + 1
        batch = spark.read.format("binaryFile").load([_literal(r["path"]) for r in chosen]).select(*FILE_SCHEMA.names)
        path = scratch_path(spark, "load")
        parsed = parser(batch).withColumn("load", F.lit(number).cast("long"))
        parsed.withColumn("__bytes", out_bytes if isinstance(out_bytes, Column) else F.col(out_bytes)).write.parquet(path)
        rows = spark.read.parquet(path)
        sizes = rows.groupBy("path").agg(F.sum("__bytes").alias("out_bytes"))
        taken = spark.createDataFrame([tuple(r) for r in chosen], "path string, length long, modified timestamp, tries int")
        entries = taken.join(sizes, "path", "left").select("path", "length", "modified", F.coalesce("out_bytes", F.lit(0)).cast("long").alias("out_bytes"), F.lit(number).cast("long").alias("load"), "tries")
        versions.commit(spark, root, {table: (rows.drop("__bytes"), []), f"{table}_ledger": (entries, [])}, append=True, before_publish=before_publish)
        discard(spark, path)
        loads += 1


def loaded(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of the load that each file's newest ledger entry names."""
    return versions.read(spark, root, table).join(ledger(spark, root, table).select("path", "load"), ["path", "load"], "left_semi")
