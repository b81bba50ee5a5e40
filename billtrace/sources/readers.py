"""Scans: tables, nested documents, file corpora, triples and directory trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One N-Triples line: subject, predicate, then an IRI, a blank node or a literal.
_TERM = r"(<[^>]*>|_:\S+)"
_LITERAL = r'"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>|@([A-Za-z0-9-]+))?'
_LINE = rf"^\s*{_TERM}\s+<([^>]*)>\s+(?:{_TERM}|{_LITERAL})\s*\.\s*(?:#.*)?$"


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet", multi_line: bool = False
) -> DataFrame:
    """Parquet, CSV (with header) or line JSON. CSV and JSON need a schema: nothing is inferred.

    ``multi_line`` is for CSV with line ends inside quotes; such a file can't be split.
    """
    if fmt == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    if schema is None:
        raise ValueError(f"reading {fmt} needs a schema")
    if fmt == "csv":
        options = {"header": True, "escape": '"', "multiLine": multi_line}
        return spark.read.schema(schema).options(**options).csv(path)
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    raise ValueError(f"unknown format {fmt!r}")


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON corpus with one document per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_files(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """Whole small files as (path, length, content); used for corpora of one document per file."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive)
        .load(root)
        .select("path", "length", "content")
    )


def list_paths(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Paths and sizes below a folder. ``content`` is pruned, so no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length")
    )


def add_path_parts(df: DataFrame, path: str = "path") -> DataFrame:
    """Add legislature, act, kind of document and file name of a ``LegN/AttoX/kind/file`` path.

    A path that stops earlier leaves the later parts NULL. ``inline`` keeps later filters from
    being pushed below and matching the path a second time.
    """
    from_leg = F.regexp_substr(F.col(path), F.lit(r"(?<![^/])Leg\d+(?![^/]).*"))
    parts = F.col("__parts")
    act = F.when(F.startswith(F.get(parts, F.lit(1)), F.lit("Atto")), F.get(parts, F.lit(1)))
    kind = F.when(act.isNotNull(), F.nullif(F.get(parts, F.lit(2)), F.lit("")))
    found = F.struct(
        F.substr(F.get(parts, F.lit(0)), F.lit(4)).try_cast("int").alias("legislatura"),
        act.alias("atto_id"),
        kind.alias("kind"),
        F.nullif(F.substring_index(F.col(path), "/", -1), F.lit("")).alias("file_name"),
    )
    return df.withColumn("__parts", F.split(from_leg, "/")).select(*df.columns, F.inline(F.array(found)))


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """N-Triples lines as (s, p, o, o_kind, o_datatype, error); blank lines and comments are left out."""
    return parse_ntriples(spark.read.text(path))


def _unescape(literal: Column) -> Column:
    """Escapes of a literal undone in one pass: split at each, then every part on its own."""
    parts = F.regexp_extract_all(literal, F.lit(r"(\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\.|[^\\]+)"), F.lit(1))

    def plain(part: Column) -> Column:
        code = F.conv(F.substr(part, F.lit(3)), 16, 10).cast("long")
        # chr() knows bytes only; UTF-32 knows every code point.
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        out = F.when(F.rlike(part, F.lit(r"^\\[uU]")), char)
        for mark, value in (("n", "\n"), ("t", "\t"), ("r", "\r"), ("b", "\b"), ("f", "\f")):
            out = out.when(part == f"\\{mark}", F.lit(value))
        return out.when(F.startswith(part, F.lit("\\")), F.substr(part, F.lit(2))).otherwise(part)

    return F.when(F.contains(literal, F.lit("\\")), F.array_join(F.transform(parts, plain), "")).otherwise(literal)


def parse_ntriples(lines: DataFrame, value: str = "value") -> DataFrame:
    """Triples of N-Triples lines. A line that is none comes back with itself in ``error`` and NULL elsewhere."""

    def group(i: int) -> Column:
        return F.regexp_extract(F.col(value), _LINE, i)

    def bare(term: Column) -> Column:
        return F.regexp_replace(term, "^<|>$", "")

    term = group(3)
    is_term = term != ""
    kind = F.when(F.startswith(term, F.lit("_:")), "bnode").when(is_term, "iri").otherwise("literal")
    found = F.struct(
        bare(group(1)).alias("s"),
        group(2).alias("p"),
        F.when(is_term, bare(term)).otherwise(_unescape(group(4))).alias("o"),
        kind.alias("o_kind"),
        F.when(~is_term, F.nullif(group(5), F.lit(""))).alias("o_datatype"),
    )
    fits = F.rlike(F.col(value), F.lit(_LINE))
    rows = lines.filter(~F.rlike(F.col(value), F.lit(r"^\s*(#.*)?$")))
    return rows.select(F.when(fits, found).alias("t"), F.when(~fits, F.col(value)).alias("error")).select("t.*", "error")


def sidecar(files: DataFrame, source: str | Column, path: str = "path", content: str = "content") -> DataFrame:
    """One metadata row for each file: path, source, size in bytes, sha256 of its bytes."""
    source = F.lit(source) if isinstance(source, str) else source
    return files.select(
        F.col(path).alias("path"),
        source.alias("fonte"),
        F.octet_length(content).cast("bigint").alias("size_bytes"),
        F.sha2(F.col(content).cast("binary"), 256).alias("sha256"),
    )
