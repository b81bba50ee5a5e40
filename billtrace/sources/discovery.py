"""Directory trees listed by the executors, level by level.

The folders of one level are a table; tasks list them and write what they find, files and folders.
The folders found are the next level's table. So the driver holds no path, a level with a
million folders is as many rows, and a lost task lists its folders again.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..session import scratch_path

ENTRY = "path string, folder boolean, length long, modified timestamp"
FOLDERS_PER_TASK, MOST_FOLDERS = 200, 20_000  # of a task, with few folders and with very many
TASKS_PER_CORE = 4
ROWS_PER_BATCH = 10_000


def _split(root: str) -> tuple[str, str]:
    """Scheme and host of an address, and its path. A plain path is local."""
    found = re.match(r"^([a-zA-Z][a-zA-Z0-9+.-]*):(?://([^/]*))?(/.*)$", root)
    scheme, host, path = found.groups() if found else ("file", "", root)
    return f"{scheme}://{host or ''}", path.rstrip("/") or "/"


def _lister(address: str):
    schema = to_arrow_schema(_parse_datatype_string(ENTRY))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(f"{address}/")
        base = base.rstrip("/")
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                found = store.get_file_info(fs.FileSelector(base + folder, allow_not_found=True))
                for i in range(0, len(found), ROWS_PER_BATCH):
                    some = found[i : i + ROWS_PER_BATCH]
                    rows = [(f.path.removeprefix(base), f.type == fs.FileType.Directory, f.size, f.mtime.astimezone(dt.UTC) if f.mtime else None) for f in some]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _tasks(spark: SparkSession) -> int:
    return TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def list_tree(spark: SparkSession, root: str, glob: str = "*", depth: int | None = None) -> DataFrame:
    """Files below a folder: path, length, modified. ``glob`` is matched with the file name.

    ``depth`` is how many levels of folders are entered, all by default. Paths are those of the
    root's file system without scheme and host. Hidden names (starting with ``.`` or ``_``) are
    left out, as in other scans. A missing root gives no rows. One job per level; needs a file
    system that pyarrow knows (local, HDFS, S3, GCS).
    """
    address, path = _split(root)
    level = spark.createDataFrame([(path,)], "path string")
    n, levels, files = 1, 0, []
    while n and (depth is None or levels <= depth):
        spread = level.repartition(max(1, min(-(-n // FOLDERS_PER_TASK), _tasks(spark)), -(-n // MOST_FOLDERS)))
        found = spread.mapInArrow(_lister(address), ENTRY)
        out = scratch_path(spark, "tree")
        found.filter(~F.rlike("path", F.lit(r"/[._][^/]*$"))).write.parquet(out)
        found = spark.read.schema(ENTRY).parquet(out)
        files.append(found.filter("NOT folder").select("path", "length", "modified"))
        level = found.filter("folder").select("path")
        n, levels = level.count(), levels + 1
    listed = reduce(DataFrame.union, files)
    pattern = "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in glob)
    return listed.filter(F.rlike(F.substring_index("path", "/", -1), F.lit(f"^{pattern}$")))


def write_tree(files: DataFrame, root: str, path: str = "path", content: str = "content") -> int:
    """Write one file for each row: a path below the root, and its text. Returns the number of files.

    A path that repeats is written again; of two such rows at a time either may win. The rows are dealt to a few
    tasks for each core first: a file takes as long as it takes, however few tasks the rows come from.
    """
    address, base_path = _split(root)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(f"{address}/")
        top = base.rstrip("/") + base_path.rstrip("/")
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    out = store.open_output_stream(f"{top}/{name}")
                except FileNotFoundError:  # the first file of a folder
                    store.create_dir(f"{top}/{name}".rsplit("/", 1)[0], recursive=True)
                    out = store.open_output_stream(f"{top}/{name}")
                with out:
                    out.write((text or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    spread = files.select(path, content).repartition(_tasks(files.sparkSession))
    return spread.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
