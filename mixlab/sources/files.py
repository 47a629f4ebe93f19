"""File scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixlab.session import stage

TRANSACTIONS = (
    "InvoiceNo STRING, StockCode STRING, Description STRING, Quantity INT, "
    "InvoiceDate TIMESTAMP, UnitPrice DECIMAL(12,4), CustomerID LONG, Country STRING"
)
SALES = "date DATE, revenue DOUBLE"
MARKETING = "date DATE, channel STRING, spend DOUBLE"
EXTERNAL = "date DATE, gdp DOUBLE, unemployment DOUBLE, consumer_confidence DOUBLE"
BUDGET = "channel STRING, budget DOUBLE, budget_pct DOUBLE, roi DOUBLE"
METRICS = "rmse DOUBLE, mae DOUBLE, r2 DOUBLE, mape DOUBLE"


def contributions_schema(channels: Sequence[str]) -> str:
    """DDL of the wide contribution table for a channel list."""
    fields = ["date DATE", "actual_revenue DOUBLE", "predicted_revenue DOUBLE"]
    for channel in channels:
        fields += [f"{channel}_contribution DOUBLE", f"{channel}_roi DOUBLE"]
    fields.append("baseline_contribution DOUBLE")
    fields += [f"{part}_contribution_pct DOUBLE" for part in (*channels, "baseline")]
    return ", ".join(fields)


# Besides the ISO forms, which are always read.
TIME_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy")


def _typed(field: T.StructField, formats: Sequence[str]) -> Column:
    """A text column as its type; what does not fit is NULL. Whole numbers may end in .0."""
    text, kind = F.nullif(F.trim(F.col(f"`{field.name}`")), F.lit("")), field.dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        known = [F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in formats]]
        return F.coalesce(*known).cast(kind)
    if isinstance(kind, T.IntegralType):
        value = text.try_cast("decimal(38,6)")
        return F.when(value == F.floor(value), value).try_cast(kind)
    return F.col(f"`{field.name}`") if isinstance(kind, T.StringType) else text.try_cast(kind)


def scan_csv(
    spark: SparkSession, path: str, schema: str | None = None, formats: Sequence[str] = TIME_FORMATS
) -> DataFrame:
    """CSV with a header. Without a schema Spark infers one, at the price of an extra pass.

    The schema's columns are found by their names in the header, wherever they stand; a
    missing one is an error. Further columns follow with inferred types. Times may be
    written in ISO form or in one of ``formats``. Values that do not fit are NULL;
    ``rejected_values`` counts them.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    raw = reader.option("enforceSchema", False).csv(path)
    wanted = list(T.StructType.fromDDL(schema))
    missing = [f.name for f in wanted if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    names = {f.name for f in wanted}
    if set(raw.columns) - names:
        wanted += [f for f in reader.option("inferSchema", True).csv(path).schema if f.name not in names]
    return raw.select(*[_typed(f, formats).alias(f.name) for f in wanted])


_FIELD = r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'


def folder_headers(lines: DataFrame, schema: str) -> DataFrame:
    """(file, header, names): the header line of each file and its names.

    It is the first line of the file that holds at least one of the schema's names as a value. Lines are told
    from headers before anything is grouped, so one row per file is what moves.
    """
    wanted = [f.name for f in T.StructType.fromDDL(schema)]
    mentioned = F.lit(False)
    for name in wanted:
        mentioned |= F.contains("line", F.lit(name))
    values = F.regexp_extract_all(F.regexp_replace("line", "^\\uFEFF", ""), F.lit(_FIELD), 1)
    plain = F.transform(values, lambda v: F.trim(F.replace(F.regexp_replace(F.trim(v), '^"|"$', ""), F.lit('""'), F.lit('"'))))
    heads = lines.filter((F.col("start") == 0) & mentioned).withColumn("names", plain)
    heads = heads.filter(F.arrays_overlap("names", F.array(*[F.lit(n) for n in wanted])))
    first = heads.groupBy("file").agg(F.min(F.struct("place", F.col("line").alias("header"), "names")).alias("head"))
    return first.select("file", "head.header", "head.names")


def scan_csv_folder(
    spark: SparkSession, path: str, schema: str, formats: Sequence[str] = TIME_FORMATS
) -> DataFrame:
    """CSV files of one folder, each with a header of its own: columns are found by name in every file.

    Files may order their columns differently or lack some; what a file lacks is NULL in its rows. A column
    of the schema that no file has is an error, and so is a file whose header has none of them. Further
    columns of any file follow as text, by name. Of a name that a header repeats, the first place counts;
    lines equal to their file's header are no data, empty lines neither. A line is a row: quoted
    line breaks are not supported. Values that do not fit are NULL, as in ``scan_csv``; so is what a short line lacks.

    The text is read twice, once for the headers. They are staged, one row per file; the driver sees
    their distinct names only.
    """
    raw = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    rows = raw.filter(F.trim("line") != "")
    heads = stage(folder_headers(rows.withColumn("place", F.monotonically_increasing_id()), schema), "headers")
    found = heads.agg(F.max(F.size("names")).alias("most"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("names")))).alias("names")).first()
    wanted, most = list(T.StructType.fromDDL(schema)), found["most"] or 0
    missing = [f.name for f in wanted if f.name not in (found["names"] or [])]
    if missing:
        raise ValueError(f"no file of {path} has a column {', '.join(missing)}")
    known = {f.name for f in wanted}
    wanted += [T.StructField(n, T.StringType()) for n in found["names"] if n and n not in known]

    unheaded = F.raise_error(F.concat(F.lit("no header in "), F.col("file"))).cast("string")
    data = rows.select("line", "file").join(heads, "file", "left")
    values = [f"c{i}" for i in range(most)]
    # Parsed in a column of its own, once per line, whatever is read from it.
    parsed = data.filter(F.coalesce("header", unheaded) != F.col("line")).withColumn(
        "_line", F.from_csv("line", ", ".join(f"{v} STRING" for v in values), {"sep": ","})
    )
    data = parsed.select("names", F.array(*[F.col(f"_line.{v}") for v in values]).alias("_values"))
    place = [F.array_position("names", F.lit(f.name)).cast("int") for f in wanted]
    named = data.select(*[F.get("_values", F.nullif(p, F.lit(0)) - 1).alias(f.name) for p, f in zip(place, wanted)])
    return named.select(*[_typed(f, formats).alias(f.name) for f in wanted])


def rejected_values(
    spark: SparkSession, path: str, schema: str, formats: Sequence[str] = TIME_FORMATS
) -> DataFrame:
    """(column, rejected): how many values of each column ``scan_csv`` cannot read as its type, in one pass."""
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    rows = []
    for f in T.StructType.fromDDL(schema):
        given = F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit("")).isNotNull()
        bad = F.count_if(given & _typed(f, formats).isNull())
        rows.append(F.struct(F.lit(f.name).alias("column"), bad.alias("rejected")))
    return raw.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def external_or_empty(spark: SparkSession, path: str, schema: str = EXTERNAL) -> DataFrame:
    """External factors, or an empty frame of the same schema when the path is missing."""
    try:
        return scan_csv(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def preview_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name and type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position INT, name STRING, type STRING")


def preview_rows(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The first rows in the order of the given columns, or of all columns, so that reruns agree."""
    return df.orderBy(*(order or df.columns)).limit(n)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite Parquet. With ``partition_by``, adaptive execution gathers the rows of a
    partition value into few files and splits a hot value over several tasks by size."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """Add rows to a saved table, such as one more scenario to those kept so far."""
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_metrics_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_results(contributions: DataFrame, budget: DataFrame, metrics: DataFrame, folder: str) -> None:
    """The three result files of a run, in one folder."""
    write_csv(contributions, f"{folder}/channel_contributions")
    write_csv(budget, f"{folder}/budget_allocation")
    write_metrics_json(metrics, f"{folder}/model_metrics")


def load_results(
    spark: SparkSession, folder: str, channels: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read back the contribution, budget and metrics tables of ``save_results``."""
    return (
        scan_csv(spark, f"{folder}/channel_contributions", contributions_schema(channels)),
        scan_csv(spark, f"{folder}/budget_allocation", BUDGET),
        spark.read.schema(METRICS).json(f"{folder}/model_metrics"),
    )
