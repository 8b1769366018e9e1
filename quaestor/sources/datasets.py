"""CSV and JSON lines with explicit schemas."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quaestor.schemas import PREDICTIONS, QA_PAIRS
from quaestor.sources.filings import path_exists

# Texts that a CSV cell uses for a missing value.
NA_VALUES = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Quotes are doubled and cells may hold line ends, as spreadsheet programs write them.
_CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "encoding": "UTF-8"}
_KEEP = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, na_values=NA_VALUES) -> DataFrame:
    """Cells are read as text, so no type is guessed, and then cast to the schema.

    Columns are found by their names in the header; extra ones are ignored.
    """
    raw = spark.read.options(**_CSV, **_KEEP, inferSchema=False).csv(path)

    def cell(field: T.StructField):
        if field.name not in raw.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        text = F.col(f"`{field.name}`")
        missing = text.isin(*na_values) if na_values else F.lit(False)
        return F.when(~missing, text).try_cast(field.dataType).alias(field.name)

    return raw.select(*[cell(f) for f in schema.fields])


# Cells that make a column of truth values.
TRUE_CELLS, FALSE_CELLS = ("True", "TRUE", "true"), ("False", "FALSE", "false")
WHOLE_CELL = r"^[ \t]*[+-]?[0-9]+[ \t]*$"
NUMBER_CELL = r"(?i)^[ \t]*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity)[ \t]*$"


def infer_types(raw: DataFrame, na_values=NA_VALUES) -> T.StructType:
    """The narrowest type that all cells of each text column allow, from one aggregate over the table.

    Whole numbers of 64 bits without missing cells are ``bigint``; numbers
    are ``double``, also whole ones beside missing cells and columns without
    any value; truth values without missing cells are ``boolean``; all else is
    ``string``. Types form a lattice (nothing, whole, number, text), so
    tables in any number of parts and orders give the same answer.
    """
    def facts(name: str) -> list[Column]:
        text = F.col(f"`{name}`")
        cell = F.when(~text.isin(*na_values), text)
        digits = F.trim(cell)
        whole = cell.rlike(WHOLE_CELL)
        fits = whole & digits.try_cast("bigint").isNotNull()
        number = cell.rlike(NUMBER_CELL) & (~whole | fits)
        return [F.struct(F.count_if(cell.isNull()), F.count_if(cell.isNotNull()), F.count_if(fits), F.count_if(number),
                         F.count_if(cell.isin(*TRUE_CELLS, *FALSE_CELLS))).alias(name)]

    def kind(missing: int, cells: int, whole: int, numbers: int, truths: int) -> T.DataType:
        if numbers == cells:
            return T.LongType() if whole == cells and cells and not missing else T.DoubleType()
        return T.BooleanType() if truths == cells and not missing else T.StringType()

    row = raw.agg(*[c for name in raw.columns for c in facts(name)]).first()
    return T.StructType([T.StructField(name, kind(*counts)) for name, counts in zip(raw.columns, row, strict=True)])


def read_csv_inferred(spark: SparkSession, path: str, na_values=NA_VALUES) -> DataFrame:
    """All columns of the file, with the types that its cells allow; see :func:`infer_types`."""
    raw = spark.read.options(**_CSV, **_KEEP, inferSchema=False).csv(path)

    def cell(field: T.StructField) -> Column:
        text = F.col(f"`{field.name}`")
        known = F.when(~text.isin(*na_values), text)
        if isinstance(field.dataType, T.StringType):
            return known.alias(field.name)
        return F.trim(F.translate(known, "\t", " ")).cast(field.dataType).alias(field.name)
    return raw.select(*[cell(f) for f in infer_types(raw, na_values).fields])


def as_printed(df: DataFrame) -> DataFrame:
    """All columns as texts: whole numbers plainly, other numbers with at least one decimal, truth values as words."""
    @F.arrow_udf("string")
    def number(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else str(v) for v in values.to_pylist()], pa.string())

    def text(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            return number(value).alias(field.name)
        if isinstance(field.dataType, T.BooleanType):
            return F.initcap(value.cast("string")).alias(field.name)
        return value.cast("string").alias(field.name)
    return df.select(*[text(f) for f in df.schema.fields])


def read_qa_pairs(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, QA_PAIRS)


def read_predictions(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Predicted answers as their cells read, or with ``infer`` as the inferred type of their column prints."""
    if not infer:
        return read_csv(spark, path, PREDICTIONS)
    printed = as_printed(read_csv_inferred(spark, path))
    return printed.select(*[F.col(c) if c in printed.columns else F.lit(None).cast("string").alias(c) for c in PREDICTIONS.names])


def check_target(spark: SparkSession, *paths: str, resume: bool = False) -> None:
    """Refuse finished outputs before any work is done for them, unless a run is resumed."""
    for path in () if resume else paths:
        if path_exists(spark, f"{path}/_SUCCESS"):
            raise FileExistsError(f"{path} is finished; choose another folder or resume")


def _open(df: DataFrame, path: str, single_file: bool, resume: bool) -> DataFrame | None:
    """What is still to be written: nothing for a finished output of a resumed run; unfinished ones are replaced."""
    check_target(df.sparkSession, path, resume=resume)
    if path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        return None
    return df.coalesce(1) if single_file else df


def write_csv(df: DataFrame, path: str, single_file: bool = False, resume: bool = False) -> None:
    """One file per task unless ``single_file`` asks for the layout of a small export."""
    out = _open(df, path, single_file, resume)
    if out is not None:
        (out.write.mode("overwrite").options(header=True, quote='"', escape='"', encoding="UTF-8", emptyValue="",
                                             nullValue="", **_KEEP).csv(path))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = QA_PAIRS) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, single_file: bool = False, resume: bool = False) -> None:
    """Missing values are written as null rather than left out."""
    out = _open(df, path, single_file, resume)
    if out is not None:
        out.write.mode("overwrite").option("ignoreNullFields", False).json(path)
