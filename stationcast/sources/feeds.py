"""Landing files. A date range is one scan, not one job per day."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import Feed
from .layers import path_missing


def day_range(start: date, end: date, fmt: str = "%Y%m%d") -> list[str]:
    """Every day from start to end, both included."""
    return [(start + timedelta(days=i)).strftime(fmt) for i in range((end - start).days + 1)]


def reformat_day(text: str, in_fmt: str, out_fmt: str) -> str:
    return datetime.strptime(text, in_fmt).strftime(out_fmt)


def with_lineage(df: DataFrame, name: str = "FILE_NAME") -> DataFrame:
    return df.withColumn(name, F.col("_metadata.file_path"))


def read_feed(spark: SparkSession, feed: Feed, paths: str | list[str]) -> DataFrame:
    """Feed rows as text with lineage; a header that differs from the contract is an error."""
    df = spark.read.schema(feed.schema).option("header", True).option("enforceSchema", False).csv(paths)
    return with_lineage(df)


def read_delimited(
    spark: SparkSession, paths, schema: T.StructType | None = None, sep: str = "|", multiline: bool = True,
    escape: str = '"',
) -> DataFrame:
    """Delimited text with quoted line breaks. Multiline files are not splittable: keep them small."""
    reader = spark.read.options(sep=sep, multiLine=multiline, escape=escape, header=True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths)


def day_glob(root: str, days: list[str], file: str) -> str:
    return f"{root.rstrip('/')}/{{{','.join(days)}}}/{file}"


def read_landing(spark: SparkSession, feed: Feed, root: str, start: date, end: date) -> DataFrame:
    """All days of the range in one scan; missing days are skipped, no day at all gives no rows."""
    days = day_range(start, end)
    try:
        return read_feed(spark, feed, day_glob(f"{root}/{feed.name}", days, feed.file))
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        empty = T.StructType([*feed.schema.fields, T.StructField("FILE_NAME", T.StringType())])
        return spark.createDataFrame([], empty)


def write_landing_csv(df: DataFrame, path: str, by: list[str]) -> None:
    """One folder of CSV per partition value."""
    df.hint("rebalance", *by).write.partitionBy(*by).option("header", True).mode("overwrite").csv(path)


def read_dated_headers(
    spark: SparkSession, root: str, days: list[str], file: str, stems: list[str], first: str,
    date_stem: str, date_pos: int = 3, date_format: str = "dd-MMMM-yy",
) -> DataFrame | None:
    """Files whose header cells carry a date, however many cells they have.

    The header row of a file is data here: it is found by its first cell, gives the position of
    every stem and the file's day, and is joined back to the file's rows by path. A file with rows
    but without such a header row is an error that names it. Returns the first two columns, the
    stems, BOOK_STOCK_DATE and FILE_NAME.
    """
    place = day_glob(root, days, file)
    try:
        commas = F.length("value") - F.length(F.replace("value", F.lit(",")))
        width = spark.read.text(place).agg(F.max(commas)).first()[0]
        cells = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range((width or 0) + 1)])
        raw = spark.read.schema(cells).csv(place)
    except AnalysisException as exc:
        if path_missing(exc):
            return None
        raise
    width = len(cells)
    rows = with_lineage(raw).select("FILE_NAME", F.array(*[f"_c{i}" for i in range(width)]).alias("cells"))
    is_header = F.upper(F.trim(F.get("cells", F.lit(0)))) == first
    names = F.transform("cells", lambda c: F.upper(F.replace(F.trim(c), F.lit(" "), F.lit("_"))))

    def position(stem: str):
        has = F.transform(names, lambda n: F.coalesce(F.contains(n, F.lit(stem)), F.lit(False)))
        return F.array_position(has, True).cast("int")

    spot = position(date_stem)
    day_text = F.get(F.split(F.get(names, spot - 1), "_"), F.lit(date_pos))
    header = rows.where(is_header).select(
        F.col("FILE_NAME").alias("_file"),
        F.try_to_timestamp(F.initcap(F.lower(F.regexp_replace(day_text, "-", " "))), F.lit(date_format.replace("-", " "))).cast("date").alias("BOOK_STOCK_DATE"),
        *[position(s).alias(f"_p_{s}") for s in stems],
    )
    data = rows.where(~F.coalesce(is_header, F.lit(False))).join(header, F.col("FILE_NAME") == F.col("_file"), "left")
    headless = F.raise_error(F.concat(F.lit(f"no header row that starts with {first} in "), F.col("FILE_NAME")))
    data = data.withColumn("FILE_NAME", F.when(F.col("_file").isNull(), headless.cast("string")).otherwise(F.col("FILE_NAME")))

    def pick(stem: str):
        p = F.col(f"_p_{stem}")
        missing = F.raise_error(F.concat(F.lit(f"no column contains {stem} in "), F.col("FILE_NAME"))).cast("string")
        return F.when(p > 0, F.get("cells", p - 1)).otherwise(missing).alias(stem)

    return data.select(
        F.get("cells", F.lit(0)).alias("S/N"), F.get("cells", F.lit(1)).alias("DEPOT_NAME"), *[pick(s) for s in stems],
        "BOOK_STOCK_DATE", "FILE_NAME",
    )
