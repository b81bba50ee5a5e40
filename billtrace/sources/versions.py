"""Sets of tables that change as one: partitions are replaced, kept or rebuilt by publishing a manifest.

Below the root of a set, every commit writes its files into fresh folders, which no reader looks at yet,
and then a manifest: which folders make up each table from now on. Renaming the manifest to its number
is the commit; it fails where that number is taken, so of two writers one has to start again. Folders of
untouched partitions are carried over by name: their files stay where they are, whatever the
size of the table. A job that fails before the rename leaves the last version as it was, for all tables
of the set, and a reader keeps its version until ``vacuum`` removes the folders nothing names any more.

    commit(spark, root, {"acts": (df, ["legislatura"])})              # replaces the partitions in df
    commit(spark, root, {"acts": (a, []), "signers": (b, [])}, rebuild=True)
    read(spark, root, "acts")

A manifest has a line for each partition, so keep partitions coarse (thousands, not millions).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER = "__part_"


@dataclass
class Partition:
    """One folder of a table, below the root: the values of its partition columns as text (None: NULL), and its rows."""

    values: list[str | None]
    path: str
    rows: int


@dataclass
class Table:
    schema: str
    by: list[str]
    partitions: list[Partition] = field(default_factory=list)


@dataclass
class Manifest:
    """What a version consists of. ``marks`` are notes of the writers, such as the last batch of a stream."""

    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def of_json(cls, text: str) -> Manifest:
        raw = json.loads(text)
        tables = {n: Table(t["schema"], t["by"], [Partition(**p) for p in t["partitions"]]) for n, t in raw["tables"].items()}
        return cls(raw["version"], tables, raw["marks"])


class Conflict(RuntimeError):
    """Another writer has published the next version first."""


class _Files:
    """The few file operations a commit needs, through the file system Spark itself uses for the root."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark._jvm
        self.conf, self.fs_package = spark._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs
        self.root, self.gateway = root.rstrip("/"), spark.sparkContext._gateway
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.fs_package.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """The whole file under its name, or an error and no change where the name is taken."""
        draft = self.path(f"_drafts/{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.fs.mkdirs(self.path(name).getParent())
        kind = getattr(self.fs_package, "Options$Rename")
        context = self.fs_package.FileContext.getFileContext(self.path("").toUri(), self.conf)
        try:
            context.rename(draft, self.path(name), self.gateway.new_array(kind, 0))
        except Exception as e:
            self.fs.delete(draft, False)
            if self.fs.exists(self.path(name)):
                raise Conflict(name) from e
            raise

    def drop(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _manifest_name(version: int) -> str:
    return f"_manifests/{version:012d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions that can still be read, oldest first."""
    return sorted(int(n.removesuffix(".json")) for n in _Files(spark, root).names("_manifests") if n.endswith(".json"))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The manifest of a version, the newest by default; an empty one where nothing is published."""
    if version is None:
        version = max(versions(spark, root), default=0)
        if not version:
            return Manifest()
    return Manifest.of_json(_Files(spark, root).read(_manifest_name(version)))


def _written(spark: SparkSession, df: DataFrame, by: Sequence[str], root: str, folder: str) -> list[Partition]:
    """Write a frame into a fresh folder and find out which partitions that makes."""
    parts = [f"{FOLDER}{i}" for i in range(len(by))]
    # A mark before the value, as Spark names the folders of NULL and of an empty text alike.
    rows = df.select("*", *[F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("null")).alias(p) for c, p in zip(by, parts, strict=True)])
    (rows.write.partitionBy(*parts) if by else rows.write).parquet(f"{root}/{folder}")
    # Partition columns are in the files too, so a folder can be read alone; only those and the path are read here.
    back = spark.read.schema(T.StructType([df.schema[c] for c in by])).option("recursiveFileLookup", True).parquet(f"{root}/{folder}")
    where = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1)
    found = back.select(where.alias("path"), *[F.col(c).cast("string").alias(p) for c, p in zip(by, parts, strict=True)])
    counted = found.groupBy("path").agg(F.count("*").alias("n"), *[F.any_value(p).alias(p) for p in parts]).collect()
    return [Partition([r[p] for p in parts], folder + unquote(r["path"]).split(folder, 1)[1], r["n"]) for r in counted]


def commit(
    spark: SparkSession,
    root: str,
    frames: Mapping[str, tuple[DataFrame, Sequence[str]]],
    rebuild: bool = False,
    append: bool = False,
    marks: Mapping[str, int] | None = None,
    before_publish: Callable[[], None] | None = None,
) -> Manifest:
    """Write frames, given as (rows, partition columns) by table, and publish them as one version.

    By default the partitions that occur in a frame take the place of those in the table, and all
    others stay untouched; ``append`` keeps those in the table too; ``rebuild`` starts the whole set
    anew, so tables that are not given are gone. NULL is a partition value of its own. A
    table's partition columns can't change but by a rebuild; columns may be added. Repeated rows are
    kept. Raises ``Conflict``, and changes nothing, where another commit was faster.
    """
    old = manifest(spark, root)
    new = Manifest(old.version + 1, {} if rebuild else dict(old.tables), dict(old.marks) | dict(marks or {}))
    files, token = _Files(spark, root), uuid.uuid4().hex
    for name, (df, by) in frames.items():
        table = new.tables.get(name, Table("", list(by)))
        if table.by != list(by):
            raise ValueError(f"{name} is partitioned by {table.by}")
        made = _written(spark, df, by, files.root, f"{name}/{token}")
        taken = {tuple(p.values) for p in made}
        # Without partition columns a table is one partition, also where the frame is empty.
        kept = [p for p in table.partitions if append or (by and tuple(p.values) not in taken)]
        schema = df.schema if not table.schema else _widened(T.StructType.fromJson(json.loads(table.schema)), df.schema)
        new.tables[name] = Table(schema.json(), list(by), kept + made)
    if before_publish:
        before_publish()
    files.publish(_manifest_name(new.version), new.to_json())
    return new


def _widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both; a column that both have keeps its type."""
    for f in new:
        if f.name in old.names and old[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {old[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([*old, *[f for f in new if f.name not in old.names]])


def read(spark: SparkSession, root: str, name: str, version: int | None = None, only: Callable[[list[str | None]], bool] | None = None) -> DataFrame:
    """A table of a version. ``only`` chooses partitions by their values (as text); others aren't even listed."""
    table = manifest(spark, root, version).tables[name]
    schema = T.StructType.fromJson(json.loads(table.schema))
    paths = [f"{root.rstrip('/')}/{p.path}" for p in table.partitions if only is None or only(p.values)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def partitions(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table's partitions: their values as text, path and number of rows."""
    table = manifest(spark, root, version).tables.get(name, Table("", []))
    schema = ", ".join([*[f"`{c}` string" for c in table.by], "path string", "n long"])
    return spark.createDataFrame([(*p.values, p.path, p.rows) for p in table.partitions], schema)


def load_missing(spark: SparkSession, root: str, name: str, source: DataFrame, by: str, wanted: Sequence, force: bool = False, **kw) -> list:
    """Commit the wanted partitions that the table lacks (all of them if forced); returns these.

    The source is filtered by partition value before anything of it is read. A wanted value
    without rows in the source replaces nothing.
    """
    table = manifest(spark, root).tables.get(name)
    have = set() if table is None or force else {p.values[0] for p in table.partitions}
    key: Callable[[object], str | None] = lambda v: None if v is None else str(v).lower() if isinstance(v, bool) else str(v)
    todo = [v for v in wanted if key(v) not in have]
    if todo:
        chosen: Column = F.col(by).isin([v for v in todo if v is not None])
        if None in todo:
            chosen = chosen | F.col(by).isNull()
        commit(spark, root, {name: (source.filter(chosen), [by])}, **kw)
    return todo


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove all but the newest ``keep`` versions and every folder they alone, or failed commits, used.

    Not while a commit runs: its folders aren't named by a manifest yet.
    """
    files = _Files(spark, root)
    known = versions(spark, root)
    manifests = {v: manifest(spark, root, v) for v in known}
    used = {p.path for v in known[-keep:] for t in manifests[v].tables.values() for p in t.partitions}
    for v in known[:-keep]:
        files.drop(_manifest_name(v))
    dropped = []
    for name in {n for m in manifests.values() for n in m.tables}:
        for token in files.names(name):
            for folder in _leaves(files, f"{name}/{token}"):
                if folder not in used:
                    files.drop(folder)
                    dropped.append(folder)
    return dropped


def _leaves(files: _Files, folder: str) -> list[str]:
    inner = [n for n in files.names(folder) if n.startswith(FOLDER)]
    return [x for n in inner for x in _leaves(files, f"{folder}/{n}")] if inner else [folder]
