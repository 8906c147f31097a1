"""Input tables and roles shared by the registered queries, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom import Roles

PLACES = 6

# A target that can be learnt from the columns, and a score in (0, 1) made by basic
# arithmetic only, so that every engine computes the same doubles.
TARGET_SQL = (
    "CAST((l_quantity / 50 * CAST(0.6 AS DOUBLE) + l_discount * 2"
    " + CASE WHEN l_returnflag = 'R' THEN CAST(0.3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
    " + (l_orderkey * 7919 + l_linenumber * 104729) % 1000 / CAST(1000 AS DOUBLE) * CAST(0.5 AS DOUBLE))"
    " > CAST(1.0 AS DOUBLE) AS DOUBLE)"
)
SCORE_SQL = (
    "(l_quantity / 50 * CAST(0.6 AS DOUBLE) + l_discount * 2"
    " + CASE WHEN l_returnflag = 'R' THEN CAST(0.3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
    " + l_tax + l_extendedprice / 1000000) / CAST(1.5 AS DOUBLE)"
)
THRESHOLD = 0.5

# Coefficients of the linear scorer.
LINEAR_WEIGHTS = {"l_quantity": 0.05, "l_discount": 12.0, "l_tax": -1.5, "l_extendedprice": 0.00001}
LINEAR_INTERCEPT = -2.5

LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
STATUS_ROLES = Roles("l_linestatus", "F", "O", LINE_NUMERIC, ("l_returnflag", "l_linenumber"))
TARGET_ROLES = Roles("target", 0.0, 1.0, LINE_NUMERIC, ("l_returnflag", "l_linenumber"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines_with_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the learnable target."""
    return table(spark, sf_dir, "lineitem").withColumn("target", F.expr(TARGET_SQL))


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line keys with ``label``, a computed score ``p1`` and the class it implies."""
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS, F.expr(TARGET_SQL).alias("label"), F.expr(SCORE_SQL).alias("p1"),
        (F.expr(SCORE_SQL) > THRESHOLD).cast("double").alias("prediction"),
    )


SCORED_CTE = f"""scored AS (
  SELECT l_orderkey, l_linenumber, {TARGET_SQL} AS label, {SCORE_SQL} AS p1,
         CAST({SCORE_SQL} > {THRESHOLD} AS DOUBLE) AS prediction
  FROM lineitem)"""


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Round double columns: engines add numbers up in different orders."""
    return df.withColumns({c: F.round(c, PLACES) for c in columns})
