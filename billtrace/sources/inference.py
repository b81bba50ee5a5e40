"""Types of text columns from all of their values, and JSON documents whose layout changes over time.

A column's type is found in one aggregate over all rows, never from a sample. For each column it
counts the values that fit each type; such counts add up, so partial ones merge in any order.
The narrowest type that every value fits is taken. A column with a single value that fits nothing
else is text, late as that value may come, and no other column is touched by it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .readers import read_files

# The types a column can have, narrowest first, and the form of their values.
# A type is wider than those named beside it: their values fit it as well.
FORMS = {
    "boolean": (r"^(?i:true|false)$", ()),
    "bigint": (r"^[+-]?[0-9]+$", ()),
    "double": (r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$", ("bigint",)),
    "date": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", ()),
    "timestamp": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$", ("date",)),
}


def _fits(c: Column, kind: str) -> Column:
    """Whether a value has the form of a type or a narrower one, and lies within its range."""
    form, narrower = FORMS[kind]
    fits = F.rlike(c, F.lit(form)) & c.try_cast(kind).isNotNull()
    for n in narrower:
        # A whole number beyond bigint still is a double.
        fits = fits | (F.rlike(c, F.lit(FORMS[n][0])) & c.try_cast(kind).isNotNull())
    return fits


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """The narrowest type of each text column that all its values fit.

    NULL fits every type; a column without values is text, and so is one with an empty text or with
    blanks around a value. ``007`` is a whole number. One job, one pass over all rows.
    """
    columns = list(columns if columns is not None else [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
    if not columns:
        return {}
    counts = []
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`")
        counts += [F.count(c).alias(f"{i}"), *[F.count_if(_fits(c, kind)).alias(f"{i}:{kind}") for kind in FORMS]]
    found = df.agg(*counts).first()
    types = {}
    for i, name in enumerate(columns):
        n = found[f"{i}"]
        types[name] = next((kind for kind in FORMS if n and found[f"{i}:{kind}"] == n), "string")
    return types


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns cast to the given types; others as they are."""
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if types.get(c, "string") != "string" else F.col(f"`{c}`") for c in df.columns])


def read_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header, with types that all its values fit; ``types`` overrides those of some columns.

    The first pass over the text finds the types, the second one reads. Columns are those of the header. An
    empty field is NULL, a quoted empty one an empty text.
    """
    text = spark.read.options(header=True, escape='"', multiLine=multi_line, nullValue="", emptyValue="").csv(path)
    types = types or {}
    free = [c for c in text.columns if c not in types]
    return apply_types(text, infer_types(text, free) | types)


def merged_type(old: T.DataType, new: T.DataType) -> T.DataType:
    """A type that holds the values of both; fields of both structs, old ones first; text where nothing else does.

    NULL gives way to any type, a whole number widens to a longer one or to double.
    """
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        both = [T.StructField(f.name, merged_type(f.dataType, new[f.name].dataType) if f.name in new.names else f.dataType) for f in old]
        return T.StructType([*both, *[f for f in new if f.name not in old.names]])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged_type(old.elementType, new.elementType))
    numbers = (T.IntegerType, T.LongType, T.DoubleType)
    if isinstance(old, numbers) and isinstance(new, numbers):
        return max(old, new, key=lambda t: [isinstance(t, n) for n in numbers].index(True))
    return T.StringType()


CORRUPT = "_corrotto"


def _decoder():
    """From a row with the bytes of a JSON file to its text in any of its encodings; nothing where it is in none."""

    def run(row) -> str:
        content = bytes(row[0])
        try:
            return content.decode(json.detect_encoding(content))
        except UnicodeDecodeError:
            return ""

    return run


def read_documents_evolving(spark: SparkSession, path: str, declared: T.StructType | None = None, glob: str = "*") -> DataFrame:
    """One JSON document per file, whole files, with the fields of all documents, and the broken ones set apart.

    The layout is that of ``declared`` widened by what any document holds: new fields follow at the end
    of their struct, and what fits no common type is text. A file that is no document comes back with its
    text in ``_corrotto`` and NULL elsewhere; ``path`` says which. Two passes over the files: the first one finds the
    layout from their texts, in as many tasks as a scan has, where a JSON reader would look at all files in one.
    """
    reader = spark.read.options(multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, pathGlobFilter=glob, recursiveFileLookup=True)
    texts = read_files(spark, path, glob).select("content").rdd.map(_decoder())
    inferred = spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).json(texts).schema
    found = T.StructType([f for f in inferred if f.name != CORRUPT])
    layout = found if declared is None else merged_type(declared, found)
    if CORRUPT not in layout.names:
        layout = T.StructType([*layout, T.StructField(CORRUPT, T.StringType())])
    return reader.schema(layout).json(path).select("*", F.col("_metadata.file_path").alias("path"))
