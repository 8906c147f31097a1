"""Sources and sinks: files are written from the given tables to the shared folder and read back."""

from __future__ import annotations

from registry import query
from registry.inputs import LINE_NUMERIC, PLACES, SCORED_CTE, scored_lines, table
from tabloom.operators import profile
from tabloom.roles import table_schema
from tabloom.sinks.predictions import write_predictions
from tabloom.sources.shared import fresh_path
from tabloom.sources.tables import conform, lower_case_columns, read_csv, rename_all

LINE_CSV_SCHEMA = table_schema(
    {
        "l_orderkey": "bigint",
        "l_linenumber": "int",
        **{c: "double" for c in LINE_NUMERIC},
        "l_returnflag": "string",
        "l_linestatus": "string",
    }
)


@query(
    "csv_scan",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem",
)
def csv_scan(spark, sf_dir):
    path = fresh_path(spark, "lines-csv")
    lines = table(spark, sf_dir, "lineitem").select(*LINE_CSV_SCHEMA.names)
    lines.write.option("header", True).option("sep", ";").csv(path)
    return read_csv(spark, path, LINE_CSV_SCHEMA, separator=";")


@query("csv_predictions", f"WITH {SCORED_CTE} SELECT l_orderkey, l_linenumber, label, p1, prediction FROM scored")
def csv_predictions(spark, sf_dir):
    path = fresh_path(spark, "predictions-csv")
    write_predictions(scored_lines(spark, sf_dir), path)
    schema = table_schema({"l_orderkey": "bigint", "l_linenumber": "int", "label": "double", "p1": "double", "prediction": "double"})
    return read_csv(spark, path, schema)


@query("parquet_predictions", f"WITH {SCORED_CTE} SELECT l_orderkey, l_linenumber, label, p1, prediction FROM scored")
def parquet_predictions(spark, sf_dir):
    path = fresh_path(spark, "predictions-parquet")
    write_predictions(scored_lines(spark, sf_dir), path, file_format="parquet")
    return spark.read.parquet(path)


@query("lower_case_columns", "SELECT p_partkey, p_brand, p_size FROM part")
def lower_case(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return lower_case_columns(rename_all(parts, [c.upper() for c in parts.columns]))


@query("rename_all_columns", "SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation")
def rename_all_columns(spark, sf_dir):
    return rename_all(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), ["key", "name", "region"])


@query(
    "conform_schema",
    "SELECT CAST(p_size AS DOUBLE) AS p_size, p_brand, p_retailprice, CAST(p_partkey AS DOUBLE) AS p_partkey FROM part",
)
def conform_schema(spark, sf_dir):
    schema = table_schema({"p_size": "double", "p_brand": "string", "p_retailprice": "double", "p_partkey": "double"})
    return conform(table(spark, sf_dir, "part"), schema)


@query("sql_view", "SELECT * FROM customer")
def sql_view(spark, sf_dir):
    name = profile.register_view(table(spark, sf_dir, "customer"), "input")
    return spark.sql(f"SELECT * FROM {name}")


@query(
    "sql_view_aggregate",
    f"SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, round(avg(l_discount), {PLACES}) AS mean_discount"
    " FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def sql_view_aggregate(spark, sf_dir):
    name = profile.register_view(table(spark, sf_dir, "lineitem"), "line_input")
    return spark.sql(
        f"SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_discount), {PLACES}) AS mean_discount"
        f" FROM {name} GROUP BY l_returnflag, l_linestatus"
    )
