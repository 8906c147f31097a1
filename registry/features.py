"""Feature pipeline, splits and folds; vectors are compared entry by entry."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.inputs import LINE_KEYS, LINE_NUMERIC, PLACES, STATUS_ROLES, TARGET_ROLES, lines_with_target, rounded, table
from tabloom import Roles
from tabloom.functions.keys import KEY_MODULUS, seeded_multiplier
from tabloom.operators.features import (
    FEATURES,
    NUMERIC_VECTOR,
    SCALED_VECTOR,
    fit_features,
    index_name,
    one_hot_name,
    stage_table,
    vector_entries,
)
from tabloom.operators.wide_index import WideIndexer
from tabloom.operators.split import FOLD_SEED_SHIFT, SPLIT_BUCKETS, add_fold, split

KEYS_SQL = "l_orderkey, l_linenumber"


def rank_sql(column: str, name: str, source: str = "lineitem") -> str:
    """CTE: frequency rank of every value, ties by value."""
    return (
        f"{name} AS (SELECT {column} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) - 1 AS DOUBLE) AS idx"
        f" FROM {source} GROUP BY {column})"
    )


FLAG, NUMBER = rank_sql("l_returnflag", "flag"), rank_sql("l_linenumber", "line_no")
RANGES = "ranges AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in LINE_NUMERIC) + " FROM lineitem)"
SCALED = {c: f"({c} - lo_{c}) / (hi_{c} - lo_{c})" for c in LINE_NUMERIC}


def fitted_lines(spark, sf_dir, roles: Roles = STATUS_ROLES, **options):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_linestatus", "l_returnflag", *LINE_NUMERIC)
    return fit_features(lines, roles, **options).transform(lines)


@query("label_index", f"WITH {rank_sql('l_linestatus', 'status')} SELECT {KEYS_SQL}, idx AS label FROM lineitem JOIN status ON l_linestatus = v")
def label_index(spark, sf_dir):
    return fitted_lines(spark, sf_dir, label_order="frequency").select(*LINE_KEYS, "label")


@query("label_index_by_role", f"SELECT {KEYS_SQL}, CAST(l_linestatus = 'O' AS DOUBLE) AS label FROM lineitem")
def label_index_by_role(spark, sf_dir):
    return fitted_lines(spark, sf_dir).select(*LINE_KEYS, "label")


@query(
    "category_index",
    f"WITH {FLAG}, {NUMBER} SELECT {KEYS_SQL}, f.idx AS idx_l_returnflag, n.idx AS idx_l_linenumber"
    " FROM lineitem JOIN flag f ON l_returnflag = f.v JOIN line_no n ON l_linenumber = n.v",
)
def category_index(spark, sf_dir):
    return fitted_lines(spark, sf_dir).select(*LINE_KEYS, index_name("l_returnflag"), index_name("l_linenumber"))


@query(
    "part_type_index",
    f"WITH {rank_sql('p_type', 'kind', 'part')}, {rank_sql('p_brand', 'brand', 'part')}"
    " SELECT p_partkey, k.idx AS idx_p_type, b.idx AS idx_p_brand FROM part JOIN kind k ON p_type = k.v JOIN brand b ON p_brand = b.v",
)
def part_type_index(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("big", (F.col("p_size") > 25).cast("int"))
    fitted = fit_features(parts, Roles("big", 0, 1, ("p_retailprice",), ("p_type", "p_brand")))
    return fitted.transform(parts).select("p_partkey", index_name("p_type"), index_name("p_brand"))


@query(
    "category_index_wide",
    f"WITH {rank_sql('c_name', 'name', 'customer')}, {rank_sql('c_nationkey', 'nation', 'customer')}"
    " SELECT c_custkey, n.idx AS idx_c_name, k.idx AS idx_c_nationkey FROM customer JOIN name n ON c_name = n.v JOIN nation k ON c_nationkey = k.v",
)
def category_index_wide(spark, sf_dir):
    """As many categories as rows beside a column of few: indexed by joins, no labels in memory."""
    customers = table(spark, sf_dir, "customer")
    indexer = WideIndexer(inputCols=["c_name", "c_nationkey"], outputCols=["idx_c_name", "idx_c_nationkey"])
    return indexer.fit(customers).transform(customers).select("c_custkey", "idx_c_name", "idx_c_nationkey")


@query(
    "one_hot",
    f"WITH {FLAG} SELECT {KEYS_SQL}, CAST(idx = 0 AS DOUBLE) AS hot_0, CAST(idx = 1 AS DOUBLE) AS hot_1"
    " FROM lineitem JOIN flag ON l_returnflag = v",
)
def one_hot(spark, sf_dir):
    return fitted_lines(spark, sf_dir).select(*LINE_KEYS, *vector_entries(one_hot_name("l_returnflag"), 2, "hot_"))


@query("numeric_vector", f"SELECT {KEYS_SQL}, " + ", ".join(f"{c} AS num_{i}" for i, c in enumerate(LINE_NUMERIC)) + " FROM lineitem")
def numeric_vector(spark, sf_dir):
    return fitted_lines(spark, sf_dir).select(*LINE_KEYS, *vector_entries(NUMERIC_VECTOR, len(LINE_NUMERIC), "num_"))


@query(
    "min_max_scaled",
    f"WITH {RANGES} SELECT {KEYS_SQL}, "
    + ", ".join(f"round({e}, {PLACES}) AS scaled_{i}" for i, e in enumerate(SCALED.values()))
    + " FROM lineitem, ranges",
)
def min_max_scaled(spark, sf_dir):
    entries = vector_entries(SCALED_VECTOR, len(LINE_NUMERIC), "scaled_")
    scaled = fitted_lines(spark, sf_dir).select(*LINE_KEYS, *entries)
    return rounded(scaled, *[f"scaled_{i}" for i in range(len(LINE_NUMERIC))])


# Three flags and seven line numbers: two and six one-hot entries, then the scaled numerics.
FEATURE_ENTRIES = (
    [f"CAST(f.idx = {i} AS DOUBLE)" for i in range(2)]
    + [f"CAST(n.idx = {i} AS DOUBLE)" for i in range(6)]
    + [f"round({e}, {PLACES})" for e in SCALED.values()]
)


@query(
    "feature_vector",
    f"WITH {FLAG}, {NUMBER}, {RANGES} SELECT {KEYS_SQL}, "
    + ", ".join(f"{e} AS x_{i}" for i, e in enumerate(FEATURE_ENTRIES))
    + " FROM lineitem JOIN flag f ON l_returnflag = f.v JOIN line_no n ON l_linenumber = n.v, ranges",
)
def feature_vector(spark, sf_dir):
    entries = vector_entries(FEATURES, len(FEATURE_ENTRIES), "x_")
    vectors = fitted_lines(spark, sf_dir).select(*LINE_KEYS, *entries)
    return rounded(vectors, *[f"x_{i}" for i in range(len(FEATURE_ENTRIES))])


@query(
    "fitted_stage_list",
    """
SELECT CAST(position AS INTEGER) AS position, stage, inputs, outputs FROM (VALUES
  (0, 'StringIndexerModel', 'target', 'label'),
  (1, 'StringIndexerModel', 'l_returnflag, l_linenumber', 'idx_l_returnflag, idx_l_linenumber'),
  (2, 'OneHotEncoderModel', 'idx_l_returnflag, idx_l_linenumber', 'vec_idx_l_returnflag, vec_idx_l_linenumber'),
  (3, 'VectorAssembler', 'l_quantity, l_extendedprice, l_discount, l_tax', 'numericalfeatures'),
  (4, 'MinMaxScalerModel', 'numericalfeatures', 'scaledfeatures'),
  (5, 'VectorAssembler', 'vec_idx_l_returnflag, vec_idx_l_linenumber, scaledfeatures', 'features')
) t(position, stage, inputs, outputs)
""",
)
def fitted_stage_list(spark, sf_dir):
    return fitted_stages(spark, sf_dir).drop("uid")


@query("fitted_stages")
def fitted_stages(spark, sf_dir):
    return stage_table(fit_features(lines_with_target(spark, sf_dir), TARGET_ROLES).model, spark)


def bucket_sql(buckets: int, seed: int) -> str:
    """The arithmetic key bucket of ``functions.keys`` over the line keys."""
    total = "0"
    for key in LINE_KEYS:
        total = f"(({total} + {key} % {KEY_MODULUS}) * {seeded_multiplier(seed)}) % {KEY_MODULUS}"
    return f"({total}) % {buckets}"


SEED = 42


@query(
    "split_sides",
    f"SELECT {KEYS_SQL}, CASE WHEN {bucket_sql(SPLIT_BUCKETS, SEED)} < 90 THEN 'train' ELSE 'test' END AS side FROM lineitem",
)
def split_sides(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS)
    training, held_out = split(lines, LINE_KEYS, 90, SEED, method="arithmetic")
    return training.withColumn("side", F.lit("train")).unionByName(held_out.withColumn("side", F.lit("test")))


@query(
    "fold_counts",
    f"SELECT CAST({bucket_sql(10, SEED + FOLD_SEED_SHIFT)} AS INTEGER) AS fold, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1",
)
def fold_counts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS)
    return add_fold(lines, LINE_KEYS, 10, SEED, method="arithmetic").groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("hash_split", "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_on_both_sides, true AS nine_tenths_train FROM lineitem")
def hash_split(spark, sf_dir):
    # The hash has no SQL counterpart. Its contract has: both sides together are the table.
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS)
    training, held_out = split(lines, LINE_KEYS)
    sides = training.withColumn("side", F.lit(1)).unionByName(held_out.withColumn("side", F.lit(2)))
    per_key = sides.groupBy(*LINE_KEYS).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("side") == 1).alias("trained"))
    both = (F.col("trained") > 0) & (F.col("trained") < F.col("n"))
    share = F.sum("trained") / F.sum("n")
    return per_key.agg(
        F.sum("n").alias("n_rows"), F.count_if(both).alias("n_on_both_sides"), ((share > 0.87) & (share < 0.93)).alias("nine_tenths_train")
    )
