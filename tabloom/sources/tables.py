"""Typed CSV and JDBC scans, name normalisation and the schema contract."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabloom.roles import JdbcRange, JdbcSource

#: Files that an error about headers names.
SHOWN_FILES = 5
NUMBER_WIDTH = {T.ByteType: 0, T.ShortType: 1, T.IntegerType: 2, T.LongType: 3, T.FloatType: 4, T.DoubleType: 5}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    separator: str = ",",
    check_header: bool = True,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """CSV with a header line, read with a declared schema.

    ``check_header`` makes a header that disagrees with the schema an error instead of shifting
    values into the wrong columns, for every file under the path and before any value is read;
    without it the header is skipped and columns are taken by position, whatever the file calls
    them. ``corrupt_column`` keeps the text of lines that do not fit.
    """
    if check_header:
        wrong = wrong_headers(spark, path, schema.names, separator).limit(SHOWN_FILES).collect()
        if wrong:
            files = "; ".join(f"{r['file']}: {r['header']}" for r in wrong)
            raise ValueError(f"headers that are not those of the schema, {schema.names}: {files}")
    reader = spark.read.option("header", True).option("sep", separator).option("mode", mode).option("enforceSchema", not check_header)
    if corrupt_column:
        # Spark's own header check compares all declared columns, this one included.
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("enforceSchema", True)
    df = reader.schema(schema).csv(path)
    return df.repartition(partitions) if partitions else df


def first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, line)``: the first line of every file under a path that has one.

    A session of its own gives every piece of a file a task, which stops after its first lines; so
    all files are opened, and little of them is read."""
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.openCostInBytes", apart.conf.get("spark.sql.files.maxPartitionBytes"))
    lines = apart.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.iloc[:1]
                return

    return lines.mapInPandas(first, lines.schema).where("start = 0").select("file", "line")


def wrong_headers(spark: SparkSession, path: str | list[str], names: Sequence[str], separator: str = ",") -> DataFrame:
    """``(file, header)`` of the CSV files whose first line does not name the columns, in order and but for case."""
    wanted = [name.lower() for name in names]

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [next(csv.reader([line.removeprefix("\ufeff")], delimiter=separator), []) for line in batch["line"]]
            wrong = [[c.lower() for c in header] != wanted for header in found]
            yield pd.DataFrame({"file": batch["file"], "header": [separator.join(h) for h in found]})[wrong]

    return first_lines(spark, path).mapInPandas(compared, "file string, header string")


def csv_header(spark: SparkSession, path: str, separator: str = ",") -> list[str]:
    """The column names in the header line."""
    return spark.read.option("header", True).option("sep", separator).csv(path).columns


def jdbc_options(source: JdbcSource, split: JdbcRange | None = None) -> dict[str, str]:
    """Reader options of a JDBC scan; with ``split`` the scan runs as several range queries."""
    options = {
        "driver": source.driver,
        "url": source.url,
        "dbtable": source.table,
        "fetchsize": str(source.fetch_size),
    }
    if source.user is not None:
        options["user"] = source.user
    if source.password is not None:
        options["password"] = source.password
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession, source: JdbcSource, split: JdbcRange | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A database table with lower-case column names, conformed to ``schema`` when one is given.

    Filters and column selections on the result are pushed to the database.
    """
    df = lower_case_columns(spark.read.format("jdbc").options(**jdbc_options(source, split)).load())
    return conform(df, schema) if schema is not None else df


def lower_case_columns(df: DataFrame) -> DataFrame:
    names = [c.lower() for c in df.columns]
    collisions = sorted({n for n in names if names.count(n) > 1})
    if collisions:
        raise ValueError(f"column names that differ by case only: {collisions}")
    return df.toDF(*names)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def _widens(source: T.DataType, target: T.DataType) -> bool:
    if source == target or isinstance(source, T.NullType):
        return True
    if type(source) in NUMBER_WIDTH and type(target) in NUMBER_WIDTH:
        return NUMBER_WIDTH[type(source)] <= NUMBER_WIDTH[type(target)]
    return isinstance(target, T.StringType) and isinstance(source, T.AtomicType) and not isinstance(source, T.BinaryType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, in schema order, up-cast to a wider type where the schema asks for it.

    Missing columns and narrowing casts are errors, all reported together before any job runs.
    Extra columns are dropped.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in found]
    narrowing = [
        f"{f.name}: {found[f.name].simpleString()} to {f.dataType.simpleString()}"
        for f in schema.fields
        if f.name in found and not _widens(found[f.name], f.dataType)
    ]
    if missing or narrowing:
        raise ValueError(f"data does not fit the schema; missing columns {missing}, unsafe casts {narrowing}")
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
