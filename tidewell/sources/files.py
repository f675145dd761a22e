"""Text-file readers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import trimmed


def dated_path(base: str, dataset: str, run_date: dt.date | str, extension: str) -> str:
    """Landing path of one day's file, ``<base>/<dataset>/<dataset>_<yyyymmdd>.<extension>``."""
    if isinstance(run_date, str):
        run_date = dt.date.fromisoformat(run_date)
    return f"{base}/{dataset}/{dataset}_{run_date:%Y%m%d}.{extension}"


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; Spark infers the types, which costs one more pass over the file."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column stays text, nothing is inferred."""
    return spark.read.option("header", True).csv(path)


def read_csv_with_date(
    spark: SparkSession, path: str, date_column: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header and one column parsed as DATE.

    Give ``schema`` to save the inference pass.
    """
    if schema is None:
        df = read_csv_inferred(spark, path)
    else:
        df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumn(date_column, F.to_date(date_column))


def typed(text: Column, field: T.StructField, place: Column) -> Column:
    """A text field in its type. One that does not fit fails the job, whatever the session's settings.

    ``place`` tells where it stands, for the message.
    """
    value = text.try_cast(field.dataType)
    message = F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()} in "), place)
    unfit = text.isNotNull() & value.isNull()
    return F.when(unfit, F.raise_error(message).cast(field.dataType)).otherwise(value).alias(field.name)


def _place(line: Column | str) -> Column:
    """The file and the line itself; Spark reads files in parts, so a line has no number."""
    return F.concat(F.col("_file"), F.lit(": "), line)


# Control characters that no line holds: the CSV reader then takes a line as one field.
_NO_SEPARATOR = "\x01\x02\x03"


def _data_lines(spark: SparkSession, path: str) -> tuple[DataFrame, Column]:
    """The lines that are not blank but the first of each file, and the fields of a line."""
    lines = (
        spark.read.schema("value string")
        .options(header=True, sep=_NO_SEPARATOR, quote="", mode="FAILFAST")
        .csv(path)
    )
    return lines.select("value", F.col("_metadata.file_path").alias("_file")), F.split("value", ",", -1)


def read_csv_positional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Comma-split lines matched to ``schema`` by position.

    Fields are trimmed. A line with another number of fields is left out
    (quotes are not interpreted, so a quoted comma makes one field too many);
    as is a blank one; ``rejected_lines`` counts those. The first line of each
    file that is not blank is its header, whatever it says. A field that does
    not fit its type fails the job, as a typed load should.
    """
    lines, fields = _data_lines(spark, path)
    good = lines.filter(F.size(fields) == len(schema)).select(
        "value", "_file", F.transform(fields, trimmed).alias("fields")
    )
    where = _place("value")
    return good.select(*[typed(F.col("fields")[i], f, where) for i, f in enumerate(schema.fields)])


def rejected_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row, ``n_rejected``: the lines ``read_csv_positional`` leaves out."""
    lines, fields = _data_lines(spark, path)
    odd = lines.filter(F.size(fields) != len(schema)).select("value")
    blank = spark.read.text(path).filter(F.col("value").rlike(r"^[\x00-\x20]*$"))
    return odd.union(blank).agg(F.count(F.lit(1)).alias("n_rejected"))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with named fields.

    Blank lines are skipped, a missing field is NULL and other fields are
    ignored. A line that is not one JSON object fails the job. Fields are read as
    text and then cast, so ``7`` and ``"7"`` are the same number.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    line = F.col("value")
    # The cheap test settles almost every line; the pattern is for tabs at the ends.
    bare = F.trim(line)
    braced = (bare.startswith("{") & bare.endswith("}")) | line.rlike(r"^\s*\{.*\}\s*$")
    read = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    lines = read.filter(bare.startswith("{") | line.rlike(r"\S"))
    # Spark's parser stops at the end of the first value and would not see what
    # follows it; as the only element of a list, the line has to be complete.
    listed = F.from_json(
        F.concat(F.lit("["), line, F.lit("]")), T.ArrayType(as_text), {"mode": "FAILFAST"}
    )
    record = F.when(braced & (F.size("listed") == 1), F.col("listed")[0]).otherwise(
        F.raise_error(F.concat(F.lit("malformed line, not one JSON object: "), line))
    )
    records = lines.select("value", "_file", listed.alias("listed"))
    records = records.select("value", "_file", record.alias("record"))
    return records.select(*[typed(F.col("record")[f.name], f, _place("value")) for f in schema.fields])
