"""Filters, renames, computed columns and scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from registry import query
from registry.inputs import LINEAR_INTERCEPT, LINEAR_WEIGHTS, LINE_KEYS, LINE_NUMERIC, PLACES, SCORED_CTE, rounded, scored_lines, table
from tabloom.functions.scores import array_element, class_probability, complement, log_loss
from tabloom.operators import profile, scoring
from tabloom.sinks.predictions import drop_vectors


@query("class_filter", "SELECT l_orderkey, l_linenumber, l_linestatus FROM lineitem WHERE l_linestatus = 'O'")
def class_filter(spark, sf_dir):
    return profile.of_class(table(spark, sf_dir, "lineitem"), "l_linestatus", "O").select(*LINE_KEYS, "l_linestatus")


@query("rename_column", "SELECT o_orderkey, o_totalprice AS order_value FROM orders")
def rename_column(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").withColumnRenamed("o_totalprice", "order_value")


@query("drop_columns", "SELECT s_suppkey, s_acctbal FROM supplier")
def drop_columns(spark, sf_dir):
    return table(spark, sf_dir, "supplier").drop("s_name", "s_nationkey")


@query(
    "select_with_computed",
    "SELECT *, c_acctbal * 2 AS doubled, -c_acctbal AS negated, c_acctbal + c_nationkey AS shifted FROM customer",
)
def select_with_computed(spark, sf_dir):
    balance = F.col("c_acctbal")
    computed = [(balance * 2).alias("doubled"), (-balance).alias("negated"), (balance + F.col("c_nationkey")).alias("shifted")]
    return table(spark, sf_dir, "customer").select("*", *computed)


@query(
    "computed_columns",
    f"""WITH {SCORED_CTE}
SELECT l_orderkey, l_linenumber, 1 - p1 AS p0, round(ln(p1), {PLACES}) AS log_p1,
       round(-(label * ln(p1) + (1 - label) * ln(1 - p1)), {PLACES}) AS loss FROM scored""",
)
def computed_columns(spark, sf_dir):
    scored = scored_lines(spark, sf_dir).withColumns(
        {"p0": complement("p1"), "log_p1": F.ln("p1"), "loss": log_loss("label", "p1")}
    )
    return rounded(scored.select(*LINE_KEYS, "p0", "log_p1", "loss"), "log_p1", "loss")


@query("sql_expression", f"SELECT l_orderkey, l_linenumber, round(1 - l_discount, {PLACES}) AS kept FROM lineitem")
def sql_expression(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*LINE_KEYS, F.round(F.expr("1 - l_discount"), PLACES).alias("kept"))


@query(
    "array_elements",
    f"SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), {PLACES}) AS first, round(CAST(embedding[2] AS DOUBLE), {PLACES}) AS second FROM embeddings",
)
def array_elements(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        array_element("embedding", 0).cast("double").alias("first"),
        array_element("embedding", 1).cast("double").alias("second"),
    )
    return rounded(vectors, "first", "second")


@query(
    "vector_to_array",
    f"SELECT vec_id, CAST(len(embedding) AS INTEGER) AS size, round(CAST(list_sum(embedding::DOUBLE[]) AS DOUBLE), {PLACES}) AS total FROM embeddings",
)
def vector_entries(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    entries = vectors.select("vec_id", vector_to_array("v").alias("entries"))
    total = F.aggregate("entries", F.lit(0.0), lambda a, b: a + b)
    return rounded(entries.select("vec_id", F.size("entries").alias("size"), total.alias("total")), "total")


@query("class_probability", f"WITH {SCORED_CTE} SELECT l_orderkey, l_linenumber, p1 FROM scored")
def probability_column(spark, sf_dir):
    # A probability vector as a classifier returns it, built from the computed score.
    scored = scored_lines(spark, sf_dir).withColumn("p0", complement("p1")).withColumnRenamed("p1", "given")
    vector = VectorAssembler(inputCols=["p0", "given"], outputCol="probability").transform(scored)
    return vector.select(*LINE_KEYS, class_probability("probability").alias("p1"))


@query(
    "drop_vectors",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
)
def without_vectors(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *LINE_NUMERIC).withColumn("idx_flag", F.lit(1.0))
    return drop_vectors(VectorAssembler(inputCols=list(LINE_NUMERIC), outputCol="v").transform(lines), index_prefix="idx_")


@query("threshold_class", f"WITH {SCORED_CTE} SELECT l_orderkey, l_linenumber, CAST(p1 > 0.35 AS DOUBLE) AS prediction FROM scored")
def threshold_rule(spark, sf_dir):
    scored = scored_lines(spark, sf_dir).select(*LINE_KEYS, "p1")
    return scoring.add_class(scored, "p1", 0.35).drop("p1")


@query(
    "linear_score",
    f"SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-({LINEAR_INTERCEPT}::DOUBLE"
    + "".join(f" + {c} * {w!r}::DOUBLE" for c, w in LINEAR_WEIGHTS.items())
    + f"))), {PLACES}) AS p1 FROM lineitem",
)
def linear_score(spark, sf_dir):
    scored = scoring.linear_score(table(spark, sf_dir, "lineitem"), LINEAR_WEIGHTS, LINEAR_INTERCEPT)
    return rounded(scored.select(*LINE_KEYS, "p1"), "p1")


@query("first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def first_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return profile.first_rows(orders, 20, [F.desc("o_totalprice"), F.asc("o_orderkey")])
