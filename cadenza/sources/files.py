"""Delimited, ragged and JSON inputs."""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.text import strip
from cadenza.operators.reference import ITEM_COLUMNS
from cadenza.sources.records import ASCII_LIKE, Layout, read_records, survey, whole_files


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    schema: T.StructType | str | None = None,
    encoding: str = "UTF-8",
    infer: bool = False,
    multi_line: bool = True,
    layout: Layout | None = None,
) -> DataFrame:
    """Delimited file with a header; empty fields are null.

    All columns are text without a ``schema`` (preferred) or ``infer``, which reads the data
    an extra time and by one task a file. Quoted fields may hold line breaks: files are read in byte ranges, the lines
    with quotes twice (``records``). ``multi_line=False`` spares that for inputs known to have no quoted line
    breaks. Encodings that aren't like ASCII are read by one task a file.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    if multi_line and (infer or encoding.upper() not in ASCII_LIKE):
        return whole_files(spark, sep, encoding, schema, infer).csv(path)
    if multi_line:
        return read_records(spark, path, sep, schema, encoding, layout)
    reader = spark.read.options(header=True, sep=sep, encoding=encoding, quote='"', escape='"', enforceSchema=False)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Comma-separated file."""
    return read_delimited(spark, path, ",", **options)


def read_latin_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Comma-separated file in ISO-8859-1."""
    return read_delimited(spark, path, ",", encoding="ISO-8859-1", **options)


def read_tsv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Tab-separated file; every column is text unless a schema is given."""
    return read_delimited(spark, path, "\t", **options)


def read_ragged(spark: SparkSession, path: str, columns: list[str] = ITEM_COLUMNS, sep: str = "\t") -> DataFrame:
    """Lines with too few or too many fields: trimmed, cut or padded to ``columns``; empty is null.

    The header line is recognised by its text.
    """
    line = strip(F.col("value"))
    fields = spark.read.text(path).select(line.alias("line")).filter(F.col("line") != sep.join(columns))
    parts = F.split("line", sep)
    return fields.select(*[F.nullif(F.get(parts, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)])


def read_term_lists(spark: SparkSession, path: str) -> DataFrame:
    """JSON object of text lists -> ``(list, entry)``; other members are left out."""
    obj = spark.read.json(path, multiLine=True)
    lists = [
        f.name for f in obj.schema.fields
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType)
    ]
    named = F.array(*[F.struct(F.lit(n).alias("list"), F.col(n).alias("entries")) for n in lists])
    return obj.select(F.explode(named).alias("l")).select("l.list", F.explode("l.entries").alias("entry"))


def load_encoded(spark: SparkSession, path: str, sep: str = ",", multi_line: bool = True) -> DataFrame | None:
    """Delimited file read as UTF-8, or as ISO-8859-1 when it is not valid UTF-8; None if it is missing (see ``read_delimited``)."""
    try:
        # Lines are read as they are, so the bytes decide, not characters that decoding has put in.
        layout = survey(spark, path, sep)
    except AnalysisException:
        return None
    return read_delimited(spark, path, sep, encoding="ISO-8859-1" if layout.invalid else "UTF-8", multi_line=multi_line, layout=layout)


def _paths(spark: SparkSession, folder: str, pattern: str) -> list[tuple[str, int]]:
    """Paths of the files below a folder and their hashes; only the listing reaches the driver, no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    found = files.load(folder).select("_metadata.file_path", F.xxhash64("_metadata.file_path").alias("file"))
    return sorted((r["file_path"], r["file"]) for r in found.collect())


def load_folder(spark: SparkSession, folder: str, register: bool = False, multi_line: bool = True) -> dict[str, DataFrame]:
    """All ``.csv`` and ``.tsv`` files below a folder, by file stem; ``.csv`` wins a shared stem, as does the last path.

    Each file is read with its own separator and, if it is not valid UTF-8, as ISO-8859-1. One job lists the files
    and one per separator reads what is needed of them for their headers, encodings and ranges, however many there are.
    ``register`` also makes temporary views.
    """
    listed = _paths(spark, folder, "*.{csv,tsv}")
    tables = {}
    for ending, sep in ((".tsv", "\t"), (".csv", ",")):
        own = [(path, file) for path, file in listed if path.endswith(ending)]
        layout = survey(spark, folder, sep, recursiveFileLookup=True, pathGlobFilter=f"*{ending}") if own else None
        for path, file in own:
            encoding = "ISO-8859-1" if file in layout.invalid else "UTF-8"
            name = unquote(path)
            tables[os.path.splitext(os.path.basename(name))[0]] = read_delimited(
                spark, name, sep, encoding=encoding, multi_line=multi_line, layout=layout.of(file)
            )
    if register:
        for stem, frame in tables.items():
            frame.createOrReplaceTempView(stem)
    return tables

