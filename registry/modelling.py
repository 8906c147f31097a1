"""Fitted classifiers and whole jobs. Fitted numbers have no SQL counterpart."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from registry import query
from registry.features import SEED, bucket_sql
from registry.inputs import LINE_KEYS, TARGET_ROLES, lines_with_target, table
from tabloom import Roles
from tabloom.operators import metrics, models, scoring
from tabloom.operators.features import FEATURES, LABEL_COLUMN, fit_features
from tabloom.operators.split import SPLIT_BUCKETS, add_fold, split
from tabloom.plans import jobs
from tabloom.sinks.fitted import save_models, save_pipeline
from tabloom.sources.fitted import load_model, load_pipeline
from tabloom.sources.shared import fresh_path, stored
from tabloom.sources.tables import read_csv
from tabloom.roles import table_schema


def modelling_lines(spark, sf_dir):
    """Keys and role columns; the line number is both."""
    return lines_with_target(spark, sf_dir).select(*dict.fromkeys(LINE_KEYS + TARGET_ROLES.columns))


def fitted_scores(spark, sf_dir, spec: models.ModelSpec, method: str = "hash"):
    """Held-out rows scored by one classifier, fitted with its settings."""
    training, held_out = split(modelling_lines(spark, sf_dir), LINE_KEYS, 90, SEED, method)
    fitted = fit_features(training, TARGET_ROLES)
    dealt = models.dealt(training, fitted.rows)
    with models.kept_for_training(fitted.transform(dealt).select(LABEL_COLUMN, FEATURES)) as rows:
        model = models.fit(spec, rows, rows=fitted.rows)
    # A forest's scores are dear too.
    scores = scoring.apply_model(model, fitted.transform(models.dealt(held_out, fitted.rows))).select(*LINE_KEYS, LABEL_COLUMN, "prediction", "p1")
    return model, stored(scores, f"scores-{spec.name}")


def measured(spark, sf_dir, spec: models.ModelSpec):
    _, scores = fitted_scores(spark, sf_dir, spec)
    return metrics.compare_models(scores, {spec.name: ("p1", "prediction")})


@query("logistic_regression")
def logistic_regression(spark, sf_dir):
    return measured(spark, sf_dir, models.LOGISTIC)


@query("boosted_trees")
def boosted_trees(spark, sf_dir):
    return measured(spark, sf_dir, models.BOOSTED)


@query("random_forest")
def random_forest(spark, sf_dir):
    return measured(spark, sf_dir, models.FOREST)


HELD_OUT_SQL = f"""
SELECT CAST(count(*) AS BIGINT) AS n_scored, CAST(count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS n_keys,
       CAST(count(*) AS BIGINT) AS n_inside, CAST(count(*) AS BIGINT) AS n_by_rule, true AS above_floor
FROM lineitem WHERE {bucket_sql(SPLIT_BUCKETS, SEED)} >= 90
"""
FLOOR = 0.7


def contract_query(spec: models.ModelSpec):
    """What must hold of held-out scores whatever the fit: all rows scored, scores in [0, 1], the
    class as the threshold says, and an area under the precision-recall curve above the floor."""

    def run(spark, sf_dir):
        _, scores = fitted_scores(spark, sf_dir, spec, "arithmetic")
        rule = (F.col("p1") > spec.settings.get("threshold", 0.5)).cast("double")
        area = metrics.compare_models(scores, {spec.name: ("p1", "prediction")}).where("metric = 'area_under_pr'")
        counted = scores.agg(
            F.count(F.lit(1)).alias("n_scored"),
            F.count_distinct(F.struct(*LINE_KEYS)).alias("n_keys"),
            F.count_if(F.col("p1").between(0, 1)).alias("n_inside"),
            F.count_if(F.col("prediction") == rule).alias("n_by_rule"),
        )
        # One row beside one row.
        return counted.withColumn("above_floor", F.lit(area.first()["value"] > FLOOR))

    return run


for spec in models.DEFAULT_SPECS:
    query(f"held_out_contract_{spec.name}", HELD_OUT_SQL)(contract_query(spec))


@query(
    "saved_models_agree",
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_same_features, CAST(count(*) AS BIGINT) AS n_same_score FROM lineitem",
)
def saved_models_agree(spark, sf_dir):
    """A loaded pipeline and model give the features and scores of those that were saved."""
    lines = modelling_lines(spark, sf_dir)
    fitted = fit_features(lines, TARGET_ROLES)
    dealt = models.dealt(lines, fitted.rows)
    with models.kept_for_training(fitted.transform(dealt).select(LABEL_COLUMN, FEATURES)) as rows:
        model = models.fit(models.LOGISTIC, rows)
    pipeline_path, model_path = fresh_path(spark, "pipeline"), fresh_path(spark, "lr")
    save_pipeline(fitted.model, pipeline_path)
    save_models({"lr": model}, {"lr": model_path})
    direct = fitted.transform(lines).select(F.col(FEATURES).alias("direct"), *TARGET_ROLES.columns[1:])
    loaded = load_pipeline(pipeline_path).transform(direct)
    both = scoring.score_side_by_side({"saved": model, "loaded": load_model("lr", model_path)}, loaded, ("direct", FEATURES))
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(vector_to_array("direct") == vector_to_array(FEATURES)).alias("n_same_features"),
        F.count_if((F.col("p1_saved") == F.col("p1_loaded")) & (F.col("prediction_saved") == F.col("prediction_loaded"))).alias("n_same_score"),
    )


@query("model_scores")
def model_scores(spark, sf_dir):
    return fitted_scores(spark, sf_dir, models.LOGISTIC)[1]


@query("model_fit_summary")
def model_fit_summary(spark, sf_dir):
    return metrics.fit_summary(fitted_scores(spark, sf_dir, models.LOGISTIC)[1])


@query("model_parameters")
def model_parameters(spark, sf_dir):
    return models.parameter_table(fitted_scores(spark, sf_dir, models.LOGISTIC)[0], spark)


@query("score_peek")
def score_peek(spark, sf_dir):
    return scoring.peek(fitted_scores(spark, sf_dir, models.LOGISTIC)[1])


@query("grid_search")
def grid_search(spark, sf_dir):
    """The logistic grid over ten folds."""
    lines = add_fold(modelling_lines(spark, sf_dir), LINE_KEYS)
    fitted = fit_features(lines, TARGET_ROLES)
    prepared = fitted.transform(models.dealt(lines, fitted.rows)).select(LABEL_COLUMN, FEATURES, "fold")
    with models.kept_for_training(prepared) as rows:
        return models.search_table(models.search(models.LOGISTIC, rows, parallelism=4), models.LOGISTIC, spark)


CUSTOMER_ROLES = Roles("likely", 0, 1, ("c_acctbal",), ("c_mktsegment", "c_nationkey"))
SEARCH_FOLDS = 3


def searched_customers(spark, sf_dir):
    """Customers with a target that follows from their balance, nation and segment, but for noise by key."""
    noise = F.pmod(F.col("c_custkey") * 7919, F.lit(1000)) / 2500
    segment = (F.col("c_mktsegment") == "BUILDING").cast("int") / 5
    likely = F.col("c_acctbal") / 10000 + F.col("c_nationkey") % 5 / 10 + segment + noise > 0.95
    return table(spark, sf_dir, "customer").withColumn("likely", likely.cast("int"))


@query(
    "search_all_grids",
    "SELECT model, candidates, candidates AS n_inside, best, n_rows FROM (SELECT CAST(count(*) AS BIGINT) AS n_rows FROM customer),"
    " (VALUES ('gbt', CAST(1 AS BIGINT), true), ('lr', 4, true), ('rf', 3, true)) grids(model, candidates, best)",
)
def search_all_grids(spark, sf_dir):
    """The grids of all three classifiers over three folds of a small table. What must hold of a search:
    every candidate has a mean area in (0, 1], and the model fitted in the end is the best one's."""
    rows = add_fold(searched_customers(spark, sf_dir), ["c_custkey"], SEARCH_FOLDS)
    fitted = fit_features(rows, CUSTOMER_ROLES)
    prepared = fitted.transform(models.dealt(rows, fitted.rows)).select(LABEL_COLUMN, FEATURES, "fold")
    tables, counted = [], fitted.rows
    with models.kept_for_training(prepared) as kept:
        for spec in models.DEFAULT_SPECS:
            found = models.search(spec, kept, folds=SEARCH_FOLDS, parallelism=4)
            best = spec.param_maps(spec.build())[max(range(len(found.avgMetrics)), key=found.avgMetrics.__getitem__)]
            as_best = all(found.bestModel.getOrDefault(p.name) == v for p, v in best.items())
            rows_of = models.search_table(found, spec, spark).groupBy("model")
            table_of = rows_of.agg(F.count(F.lit(1)).alias("candidates"), F.count_if((F.col("mean") > 0) & (F.col("mean") <= 1)).alias("n_inside"))
            tables.append(table_of.withColumn("best", F.lit(as_best)).withColumn("n_rows", F.lit(counted).cast("long")))
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


@query("train_job")
def train_job(spark, sf_dir):
    return jobs.train(modelling_lines(spark, sf_dir), TARGET_ROLES, LINE_KEYS, folds=0).metrics


@query("explore_job")
def explore_job(spark, sf_dir):
    """The sizes of all exploration tables."""
    tables = jobs.explore(modelling_lines(spark, sf_dir), TARGET_ROLES)
    counts = [t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("report"), "n_rows") for name, t in tables.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


@query("saved_models_score")
def saved_models_score(spark, sf_dir):
    """Fit, save, load in one go; the loaded pipeline and model score rows that have no target."""
    lines = modelling_lines(spark, sf_dir)
    fitted = fit_features(lines, TARGET_ROLES)
    dealt = models.dealt(lines, fitted.rows)
    with models.kept_for_training(fitted.transform(dealt).select(LABEL_COLUMN, FEATURES)) as rows:
        model = models.fit(models.LOGISTIC, rows)
    pipeline_path, model_path = fresh_path(spark, "pipeline"), fresh_path(spark, "lr")
    save_pipeline(fitted.model, pipeline_path)
    save_models({"lr": model}, {"lr": model_path})
    scored = scoring.score(lines.drop(TARGET_ROLES.label), load_pipeline(pipeline_path), load_model("lr", model_path))
    return scored.select(*LINE_KEYS, "prediction", "p1")


@query("score_job")
def score_job(spark, sf_dir):
    """The batch scoring job, its CSV output read back."""
    lines = modelling_lines(spark, sf_dir)
    fitted = fit_features(lines, TARGET_ROLES)
    dealt = models.dealt(lines, fitted.rows)
    with models.kept_for_training(fitted.transform(dealt).select(LABEL_COLUMN, FEATURES)) as rows:
        model = models.fit(models.LOGISTIC, rows)
    pipeline_path, model_path, output = (fresh_path(spark, n) for n in ("pipeline", "lr", "scores"))
    save_pipeline(fitted.model, pipeline_path)
    save_models({"lr": model}, {"lr": model_path})
    unlabelled = lines.drop(TARGET_ROLES.label)
    jobs.score_saved(unlabelled, pipeline_path, "lr", model_path, output)
    schema = table_schema(
        {
            "l_orderkey": "bigint",
            "l_linenumber": "int",
            "l_returnflag": "string",
            **{c: "double" for c in TARGET_ROLES.numeric},
            "prediction": "double",
            "p1": "double",
        }
    )
    return read_csv(spark, output, schema)
