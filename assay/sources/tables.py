"""Reading tables: files, catalog tables, JDBC sources and named sets of CSV files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_table(
    spark: SparkSession,
    source: str,
    columns: list[str] | None = None,
    where: Column | str | None = None,
    fmt: str | None = "parquet",
    schema: T.StructType | None = None,
    **options,
) -> DataFrame:
    """Read one table; filter and column list reach the scan.

    ``fmt=None`` reads a catalog table. Any Spark format works (parquet, orc, csv, json,
    jdbc, ...); for ``jdbc`` pass ``url`` and the partition column with its bounds as
    options, and ``source`` is the remote table.
    """
    if fmt is None:
        df = spark.table(source)
    else:
        reader = spark.read.format(fmt).options(**options)
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.option("dbtable", source).load() if fmt == "jdbc" else reader.load(source)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """Treat NaN as missing, so that one null rule holds everywhere."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(
        *[F.nanvl(F.col(f"`{c}`"), F.lit(None)).alias(c) if c in floating else F.col(f"`{c}`") for c in df.columns]
    )


def scan_csv_set(
    spark: SparkSession, files: dict[str, str], schemas: dict[str, T.StructType], multi_line: bool = False
) -> dict[str, DataFrame]:
    """Named CSV datasets with a header, read by explicit schema (no inference pass).

    Files are split between tasks. ``multi_line`` allows line breaks within quotes, for which Spark
    reads each file in one task.
    """
    return {
        name: spark.read.schema(schemas[name])
        .options(header=True, multiLine=multi_line, escape='"')
        .csv(path)
        for name, path in files.items()
    }


def _judged_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool, header: bool) -> tuple[DataFrame, str]:
    """Rows with the name of a column that holds the text of those that don't fit ``schema``, else NULL."""
    record = "record"
    while record in schema.fieldNames():
        record += "_"
    read = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(record, T.StringType())]))
        .options(header=header, multiLine=multi_line, escape='"', columnPruning=False)
        .csv(path, mode="PERMISSIVE", columnNameOfCorruptRecord=record)
    )
    # Spark judges a line by the fields that a query needs. This is always true and needs all of them.
    every = F.hash(*[F.col(f"`{c}`") for c in schema.fieldNames()])
    return read.where(every >= F.lit(-(1 << 31))), record


def scan_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit ``schema``, and the others as ``(file, record)`` with their whole text.

    A line goes to the second frame if it has too few or too many fields or one that can't be read as its
    type; every line but headers and empty lines is in exactly one of them. Nothing is read before
    either is used.
    """
    read, record = _judged_csv(spark, path, schema, multi_line, header)
    text = F.col(f"`{record}`")
    good = read.where(text.isNull()).select(*[F.col(f"`{c}`") for c in schema.fieldNames()])
    bad = read.where(text.isNotNull()).select(F.col("_metadata.file_path").alias("file"), text.alias("record"))
    return good, bad


def csv_counts(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, header: bool = True
) -> DataFrame:
    """One row ``(total, good, bad)`` from one scan."""
    read, record = _judged_csv(spark, path, schema, multi_line, header)
    broken = F.col(f"`{record}`").isNotNull()
    return read.agg(F.count(F.lit(1)).alias("total"), F.count_if(~broken).alias("good"), F.count_if(broken).alias("bad"))
