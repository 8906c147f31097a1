"""Profiling against a binary target: cross-tabs, class statistics, distances, histograms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from registry import ORACLES, query
from registry.inputs import LINE_NUMERIC, PLACES, STATUS_ROLES, TARGET_ROLES, TARGET_SQL, lines_with_target, rounded, table
from tabloom import Roles
from tabloom.functions import normal
from tabloom.operators import distance, profile
from tabloom.operators.features import category_ranks, input_report
from tabloom.plans import jobs


def union_all(selects) -> str:
    return "\nUNION ALL\n".join(selects)


def crosstab_sql(source: str, label: str, columns) -> str:
    return union_all(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, CAST({label} AS VARCHAR) AS label,"
        f" CAST(count(*) AS BIGINT) AS n FROM {source} GROUP BY ALL"
        for c in columns
    )


def describe_sql(source: str, label: str, columns) -> str:
    return union_all(
        f"SELECT '{c}' AS feature, CAST({label} AS VARCHAR) AS label, CAST(count({c}) AS BIGINT) AS count,"
        f" round(avg({c}), {PLACES}) AS mean, round(stddev_samp({c}), {PLACES}) AS stddev,"
        f" CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM {source} GROUP BY ALL"
        for c in columns
    )


@query("row_count", "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM lineitem")
def row_count(spark, sf_dir):
    return profile.row_count(table(spark, sf_dir, "lineitem"))


@query("crosstab_lines", crosstab_sql("lineitem", "l_linestatus", STATUS_ROLES.categorical))
def crosstab_lines(spark, sf_dir):
    return profile.crosstab(table(spark, sf_dir, "lineitem"), STATUS_ROLES)


@query(
    "crosstab_lines_wide",
    union_all(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value,"
        " CAST(count(*) FILTER (l_linestatus = 'F') AS BIGINT) AS n_negative,"
        " CAST(count(*) FILTER (l_linestatus = 'O') AS BIGINT) AS n_positive,"
        " CAST(count(*) FILTER (l_linestatus NOT IN ('F', 'O')) AS BIGINT) AS n_other,"
        f" CAST(count(*) FILTER (l_linestatus IS NULL) AS BIGINT) AS n_null FROM lineitem GROUP BY ALL"
        for c in STATUS_ROLES.categorical
    ),
)
def crosstab_lines_wide(spark, sf_dir):
    return profile.crosstab_wide(table(spark, sf_dir, "lineitem"), STATUS_ROLES)


@query(
    "crosstab_all_labels",
    """
SELECT 'o_orderpriority' AS feature, o_orderpriority AS value,
       CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS n_negative,
       CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS n_positive,
       CAST(count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS BIGINT) AS n_other,
       CAST(count(*) FILTER (o_orderstatus IS NULL) AS BIGINT) AS n_null
FROM orders GROUP BY ALL
""",
)
def crosstab_all_labels(spark, sf_dir):
    """Three target values, two of them classes: none is lost."""
    roles = Roles("o_orderstatus", "F", "O", categorical=("o_orderpriority",))
    return profile.crosstab_wide(table(spark, sf_dir, "orders"), roles)


@query(
    "crosstab_by_label",
    """
SELECT 'o_orderpriority' AS feature, o_orderpriority AS value,
       CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS "n_F",
       CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS "n_O",
       CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS "n_P"
FROM orders GROUP BY ALL
""",
)
def crosstab_by_label(spark, sf_dir):
    """A column for every target value that the data hold."""
    roles = Roles("o_orderstatus", "F", "O", categorical=("o_orderpriority",))
    return profile.crosstab_by_label(table(spark, sf_dir, "orders"), roles)


CUSTOMER_SQL = "(SELECT *, c_acctbal > 0 AS in_credit FROM customer)"


@query("crosstab_customers", crosstab_sql(CUSTOMER_SQL, "in_credit", ("c_mktsegment", "c_nationkey")))
def crosstab_customers(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("in_credit", F.col("c_acctbal") > 0)
    return profile.crosstab(customers, Roles("in_credit", False, True, categorical=("c_mktsegment", "c_nationkey")))


@query("describe_lines", describe_sql("lineitem", "l_linestatus", LINE_NUMERIC))
def describe_lines(spark, sf_dir):
    return rounded(profile.describe_by_class(table(spark, sf_dir, "lineitem"), STATUS_ROLES), "mean", "stddev")


@query("describe_orders", describe_sql("(SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O'))", "o_orderstatus", ("o_totalprice",)))
def describe_orders(spark, sf_dir):
    roles = Roles("o_orderstatus", "F", "O", ("o_totalprice",))
    return rounded(profile.describe_by_class(table(spark, sf_dir, "orders"), roles), "mean", "stddev")


def statistics_sql(where: str, column: str, alias: str) -> str:
    """The five describe statistics of one column as rows."""
    functions = {"count": "count", "mean": "avg", "stddev": "stddev_samp", "min": "min", "max": "max"}
    return union_all(
        f"SELECT '{name}' AS statistic, round(CAST({f}({column}) AS DOUBLE), {PLACES}) AS {alias} FROM lineitem WHERE {where}"
        for name, f in functions.items()
    )


@query(
    "describe_column_wide",
    f"""SELECT a.statistic AS "Statistic", a.x AS "l_quantity_l_linestatus_F", b.x AS "l_quantity_l_linestatus_O"
FROM ({statistics_sql("l_linestatus = 'F'", "l_quantity", "x")}) a
JOIN ({statistics_sql("l_linestatus = 'O'", "l_quantity", "x")}) b ON a.statistic = b.statistic""",
)
def describe_column_wide(spark, sf_dir):
    wide = profile.describe_column(table(spark, sf_dir, "lineitem"), "l_quantity", STATUS_ROLES)
    return rounded(wide, "l_quantity_l_linestatus_F", "l_quantity_l_linestatus_O")


@query(
    "class_statistics_join",
    f"""SELECT a.statistic, a.class_f, b.class_o
FROM ({statistics_sql("l_linestatus = 'F'", "l_extendedprice", "class_f")}) a
JOIN ({statistics_sql("l_linestatus = 'O'", "l_extendedprice", "class_o")}) b ON a.statistic = b.statistic""",
)
def class_statistics_join(spark, sf_dir):
    roles = Roles("l_linestatus", "F", "O", ("l_extendedprice",))
    long = rounded(profile.describe_long(profile.describe_by_class(table(spark, sf_dir, "lineitem"), roles)), "value")
    sides = [
        profile.of_class(long, "label", value).select("statistic", F.col("value").alias(alias))
        for value, alias in (("F", "class_f"), ("O", "class_o"))
    ]
    return profile.join_class_statistics(*sides)


def running_sql(source: str, label: str, negative: str, positive: str, columns) -> str:
    """Running class counts along distinct values, one block per column."""
    return union_all(
        f"""SELECT '{c}' AS feature, value, n0, n1,
       sum(n0) OVER w AS cum_n0, sum(n1) OVER w AS cum_n1, sum(n0) OVER () AS total_n0, sum(n1) OVER () AS total_n1
FROM (SELECT CAST({c} AS DOUBLE) AS value, count(*) FILTER ({label} = {negative}) AS n0, count(*) FILTER ({label} = {positive}) AS n1
      FROM {source} WHERE {c} IS NOT NULL AND {label} IN ({negative}, {positive}) GROUP BY 1)
WINDOW w AS (ORDER BY value)"""
        for c in columns
    )


def two_sample_sql(source: str, label: str, negative: str, positive: str, columns) -> str:
    return (
        f"SELECT feature, round(max(abs(cum_n0 / total_n0 - cum_n1 / total_n1)), {PLACES}) AS ks_statistic"
        f" FROM ({running_sql(source, label, negative, positive, columns)}) GROUP BY feature"
    )


@query(
    "class_counts_running",
    "SELECT feature, value, "
    + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("n0", "n1", "cum_n0", "cum_n1", "total_n0", "total_n1"))
    + f" FROM ({running_sql('lineitem', 'l_linestatus', chr(39) + 'F' + chr(39), chr(39) + 'O' + chr(39), LINE_NUMERIC)})",
)
def class_counts_running(spark, sf_dir):
    return distance.class_counts(table(spark, sf_dir, "lineitem"), STATUS_ROLES)


@query("ks_two_sample", two_sample_sql("lineitem", "l_linestatus", "'F'", "'O'", LINE_NUMERIC))
def ks_two_sample(spark, sf_dir):
    counts = distance.class_counts(table(spark, sf_dir, "lineitem"), STATUS_ROLES)
    return rounded(distance.ks_two_sample(counts), "ks_statistic")


@query("ks_two_sample_target", two_sample_sql(f"(SELECT *, {TARGET_SQL} AS target FROM lineitem)", "target", "0.0", "1.0", LINE_NUMERIC))
def ks_two_sample_target(spark, sf_dir):
    counts = distance.class_counts(lines_with_target(spark, sf_dir), TARGET_ROLES)
    return rounded(distance.ks_two_sample(counts), "ks_statistic")


EVENT_SQL = "(SELECT *, event_type = 'purchase' AS bought FROM events)"


@query("describe_events", describe_sql(EVENT_SQL, "bought", ("value",)))
def describe_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("bought", F.col("event_type") == "purchase")
    return rounded(profile.describe_by_class(events, Roles("bought", False, True, ("value",))), "mean", "stddev")


LABELLED_SQL = "(SELECT d.*, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


@query("ks_documents", two_sample_sql(LABELLED_SQL, "quality", "0", "1", ("n_chars",)))
def ks_documents(spark, sf_dir):
    labelled = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    counts = distance.class_counts(labelled, Roles("quality", 0, 1, ("n_chars",)))
    return rounded(distance.ks_two_sample(counts), "ks_statistic")


@query("crosstab_documents", crosstab_sql(LABELLED_SQL, "quality", ("lang", "source")))
def crosstab_documents(spark, sf_dir):
    labelled = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    return profile.crosstab(labelled, Roles("quality", 0, 1, categorical=("lang", "source")))


def normal_cdf_sql(x: str) -> str:
    """The error-function approximation of ``functions.normal`` as SQL, ``x`` already standardised."""

    def ratio(v: str, pair) -> str:
        def polynomial(coefficients) -> str:
            text = f"CAST({coefficients[-1]!r} AS DOUBLE)"
            for c in reversed(coefficients[:-1]):
                text = f"({text} * {v} + CAST({c!r} AS DOUBLE))"
            return text

        return f"({polynomial(pair[0])} / {polynomial(pair[1])})"

    size = f"least(abs({x}), {normal.TAIL_CAP}::DOUBLE)"
    square = f"({size} * {size})"
    large = (
        f"({normal.INVERSE_SQRT_PI!r}::DOUBLE - {ratio(square, tuple(c[::-1] for c in normal.ERFC_LARGE))} / {square}) / {size}"
    )
    tail = f"exp(-{square}) * CASE WHEN {size} <= 4.0 THEN {ratio(size, normal.ERFC_MIDDLE)} ELSE {large} END"
    small = f"0.5::DOUBLE + 0.5::DOUBLE * {x} * {ratio(square, normal.ERF_SMALL)}"
    return (
        f"CASE WHEN {size} <= {normal.ERF_SMALL_LIMIT} THEN {small}"
        f" ELSE 0.5::DOUBLE + sign({x}) * (0.5::DOUBLE - 0.5::DOUBLE * {tail}) END"
    )


def ks_normal_sql(columns, fit: str) -> str:
    """Distances of both classes from a normal, columns ``feature, label, ks_statistic``."""
    blocks = []
    for i, (name, condition) in enumerate((("F", "l_linestatus = 'F'"), ("O", "l_linestatus = 'O'"))):
        fitted_on = "l_linestatus = 'F'" if fit == "class0" else condition
        for c in columns:
            blocks.append(
                f"""SELECT '{c}' AS feature, '{name}' AS label,
       max(greatest(abs(cum_n{i} / total_n{i} - normal), abs(normal - (cum_n{i} - n{i}) / total_n{i}))) AS ks_statistic,
       max(total_n{i}) AS n
FROM (SELECT *, {normal_cdf_sql('x')} AS normal
      FROM (SELECT r.*, (r.value - m.mean) / m.sd * {normal.INVERSE_SQRT_TWO!r}::DOUBLE AS x
            FROM running r, (SELECT avg({c}) AS mean, stddev_samp({c}) AS sd FROM lineitem WHERE {fitted_on}) m
            WHERE r.feature = '{c}' AND n{i} > 0))"""
            )
    return f"WITH running AS ({running_sql('lineitem', 'l_linestatus', chr(39) + 'F' + chr(39), chr(39) + 'O' + chr(39), columns)})\n" + union_all(blocks)


def ks_normal_query(fit: str) -> Callable:
    def run(spark, sf_dir):
        lines = table(spark, sf_dir, "lineitem")
        described = profile.describe_by_class(lines, STATUS_ROLES)
        distances = distance.ks_normal(distance.class_counts(lines, STATUS_ROLES), described, STATUS_ROLES, fit)
        return rounded(distances.drop("p_value"), "ks_statistic")

    return run


for how in ("class0", "own"):
    query(f"ks_normal_{how}", f"SELECT feature, label, round(ks_statistic, {PLACES}) AS ks_statistic FROM ({ks_normal_sql(LINE_NUMERIC, how)})")(
        ks_normal_query(how)
    )


# The limiting distribution of a one-sample distance, summed term by term.
P_VALUE_SQL = " + ".join(f"{2 * (-1) ** (k - 1)} * exp(CAST({-2 * k * k} AS DOUBLE) * n * ks_statistic * ks_statistic)" for k in range(1, 13))


@query(
    "ks_normal_p_values",
    f"SELECT feature, label, round(CASE WHEN sqrt(n) * ks_statistic <= 0.2 THEN 1 ELSE greatest(0, least(1, {P_VALUE_SQL})) END, {PLACES})"
    f" AS p_value FROM ({ks_normal_sql(LINE_NUMERIC, 'own')})",
)
def ks_normal_p_values(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    described = profile.describe_by_class(lines, STATUS_ROLES)
    distances = distance.ks_normal(distance.class_counts(lines, STATUS_ROLES), described, STATUS_ROLES, "own")
    return rounded(distances.drop("ks_statistic"), "p_value")


EFFECTIVE = "(n_0 * n_1 / (n_0 + n_1))"
TWO_SAMPLE_P_SQL = " + ".join(
    f"{2 * (-1) ** (k - 1)} * exp(CAST({-2 * k * k} AS DOUBLE) * {EFFECTIVE} * distance * distance)" for k in range(1, 13)
)


@query(
    "ks_two_sample_p_values",
    f"""
SELECT feature, CAST(n_0 AS BIGINT) AS n_0, CAST(n_1 AS BIGINT) AS n_1, round(distance, {PLACES}) AS ks_statistic,
       round(CASE WHEN sqrt({EFFECTIVE}) * distance <= 0.2 THEN 1 ELSE greatest(0, least(1, {TWO_SAMPLE_P_SQL})) END, {PLACES}) AS p_value
FROM (SELECT feature, max(abs(cum_n0 / total_n0 - cum_n1 / total_n1)) AS distance, max(total_n0) AS n_0, max(total_n1) AS n_1
      FROM ({running_sql("lineitem", "l_linestatus", "'F'", "'O'", LINE_NUMERIC)}) GROUP BY feature)
""",
)
def ks_two_sample_p_values(spark, sf_dir):
    counts = distance.class_counts(table(spark, sf_dir, "lineitem"), STATUS_ROLES)
    return rounded(distance.ks_two_sample_test(counts), "ks_statistic", "p_value")


def report_sql() -> str:
    """Describe statistics of both classes, distances from a normal and between the classes."""
    functions = {"count": "count", "mean": "avg", "stddev": "stddev_samp", "min": "min", "max": "max"}
    described = union_all(
        f"SELECT '{c}' AS feature, '{name}' AS statistic, CAST({f}({c}) FILTER (l_linestatus = 'F') AS DOUBLE) AS class_0,"
        f" CAST({f}({c}) FILTER (l_linestatus = 'O') AS DOUBLE) AS class_1 FROM lineitem"
        for c in LINE_NUMERIC
        for name, f in functions.items()
    )
    normals = (
        "SELECT feature, 'ks_normal' AS statistic, max(ks_statistic) FILTER (label = 'F') AS class_0,"
        f" max(ks_statistic) FILTER (label = 'O') AS class_1 FROM ({ks_normal_sql(LINE_NUMERIC, 'class0')}) GROUP BY feature"
    )
    between = (
        "SELECT feature, 'ks_two_sample' AS statistic, ks_statistic AS class_0, ks_statistic AS class_1"
        f" FROM ({two_sample_sql('lineitem', 'l_linestatus', chr(39) + 'F' + chr(39), chr(39) + 'O' + chr(39), LINE_NUMERIC)})"
    )
    return (
        f"SELECT feature, statistic, round(class_0, {PLACES}) AS class_0, round(class_1, {PLACES}) AS class_1 FROM ("
        + union_all([described, normals, between])
        + ")"
    )


@query("numeric_report", report_sql())
def numeric_report(spark, sf_dir):
    return rounded(distance.numeric_report(table(spark, sf_dir, "lineitem"), STATUS_ROLES), "class_0", "class_1")


@query(
    "union_distance_row",
    f"SELECT * FROM ({statistics_sql('true', 'l_tax', 'value')}) UNION ALL"
    f" SELECT 'ks_two_sample' AS statistic, ks_statistic AS value FROM ({two_sample_sql('lineitem', 'l_linestatus', chr(39) + 'F' + chr(39), chr(39) + 'O' + chr(39), ('l_tax',))})",
)
def union_distance_row(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    functions = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    whole = lines.agg(*[f("l_tax").cast("double").alias(name) for name, f in functions.items()])
    statistics = whole.unpivot([], list(functions), "statistic", "value")
    counts = distance.class_counts(lines, Roles("l_linestatus", "F", "O", ("l_tax",)))
    row = distance.ks_two_sample(counts).select(F.lit("ks_two_sample").alias("statistic"), F.col("ks_statistic").alias("value"))
    return rounded(statistics.unionByName(row), "value")


@query("column_mean", f"SELECT round(avg(l_extendedprice), {PLACES}) AS mean_price FROM lineitem")
def column_mean(spark, sf_dir):
    return rounded(profile.column_mean(table(spark, sf_dir, "lineitem"), "l_extendedprice", "mean_price"), "mean_price")


@query(
    "category_ranks",
    union_all(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n,"
        f" CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS idx FROM part GROUP BY {c}"
        for c in ("p_type", "p_brand")
    ),
)
def ranks(spark, sf_dir):
    return category_ranks(table(spark, sf_dir, "part"), ("p_type", "p_brand"))


@query(
    "category_ranks_wide",
    "SELECT 'c_name' AS feature, c_name AS value, CAST(count(*) AS BIGINT) AS n,"
    " CAST(row_number() OVER (ORDER BY count(*) DESC, c_name) - 1 AS DOUBLE) AS idx FROM customer GROUP BY c_name",
)
def ranks_wide(spark, sf_dir):
    """A category for every row or nearly so: ranked over all tasks."""
    return category_ranks(table(spark, sf_dir, "customer"), ("c_name",))


@query(
    "column_ranges",
    union_all(f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in LINE_NUMERIC),
)
def column_ranges(spark, sf_dir):
    return profile.column_ranges(table(spark, sf_dir, "lineitem"), LINE_NUMERIC)


BINS = 12


@query(
    "histogram",
    union_all(
        f"""SELECT '{c}' AS feature, l_linestatus AS label, bin, round(lo + width * (bin - 1), {PLACES}) AS lower,
       round(lo + width * (bin - 1) + width, {PLACES}) AS upper, CAST(count(*) AS BIGINT) AS n
FROM (SELECT l_linestatus, lo, (hi - lo) / {BINS} AS width,
             CAST(least({BINS}, floor({BINS} * ({c} - lo) / (hi - lo) + 1)) AS INTEGER) AS bin
      FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem))
GROUP BY l_linestatus, lo, width, bin"""
        for c in LINE_NUMERIC
    ),
)
def histogram(spark, sf_dir):
    return rounded(profile.histogram(table(spark, sf_dir, "lineitem"), STATUS_ROLES, BINS), "lower", "upper")


ODD_SQL = """CASE l_linenumber WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN '-inf'::DOUBLE WHEN 3 THEN 'nan'::DOUBLE
       WHEN 4 THEN NULL ELSE l_quantity END"""


@query(
    "histogram_non_finite",
    f"""
WITH odd AS (SELECT l_linestatus AS label, {ODD_SQL} AS x FROM lineitem),
span AS (SELECT min(x) AS lo, (max(x) - min(x)) / {BINS} AS width FROM odd WHERE isfinite(x)),
placed AS (
  SELECT label, lo, width, CASE WHEN isnan(x) THEN {BINS} + 2 WHEN isinf(x) AND x > 0 THEN {BINS} + 1 WHEN isinf(x) THEN 0
         ELSE least({BINS}, floor((x - lo) / width + 1)) END AS place
  FROM odd, span WHERE x IS NOT NULL
)
SELECT 'x' AS feature, label, CAST(place AS INTEGER) AS bin,
       CASE WHEN place BETWEEN 1 AND {BINS} THEN round(lo + width * (place - 1), {PLACES}) END AS lower,
       CASE WHEN place BETWEEN 1 AND {BINS} THEN round(lo + width * (place - 1) + width, {PLACES}) END AS upper,
       CAST(count(*) AS BIGINT) AS n
FROM placed GROUP BY label, lo, width, place
""",
)
def histogram_non_finite(spark, sf_dir):
    """Infinities and NaN have bins of their own, so the counts sum up to the rows with a value."""
    odd = F.expr(
        "CASE l_linenumber WHEN 1 THEN double('Infinity') WHEN 2 THEN double('-Infinity') WHEN 3 THEN double('NaN')"
        " WHEN 4 THEN NULL ELSE l_quantity END"
    )
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("label"), odd.alias("x"))
    return rounded(profile.histogram(lines, Roles("label", "F", "O", numeric=("x",)), BINS), "lower", "upper")


@query(
    "input_report",
    union_all(
        f"SELECT '{c}' AS \"column\", '{kind}' AS role, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count({c}) AS BIGINT) AS nulls,"
        f" CAST({'NULL' if kind == 'numeric' else f'count(DISTINCT {c})'} AS BIGINT) AS levels"
        f" FROM (SELECT *, {TARGET_SQL} AS target FROM lineitem)"
        for kind, columns in (("label", ("target",)), ("categorical", TARGET_ROLES.categorical), ("numeric", LINE_NUMERIC))
        for c in columns
    ),
)
def report(spark, sf_dir):
    # The estimate of the number of categories is exact for as few as here.
    return input_report(lines_with_target(spark, sf_dir), TARGET_ROLES)


@query(
    "explore_tables",
    f"""
SELECT 'rows' AS report, NULL AS feature, NULL AS value, NULL AS label, CAST(n_rows AS DOUBLE) AS amount FROM ({ORACLES["row_count"]})
UNION ALL
SELECT 'crosstab', feature, value, label, CAST(n AS DOUBLE) FROM ({ORACLES["crosstab_lines"]})
UNION ALL
SELECT 'numeric', feature, statistic, unnest(['class_0', 'class_1']), unnest([class_0, class_1]) FROM ({ORACLES["numeric_report"]})
UNION ALL
SELECT 'histogram', feature, CAST(bin AS VARCHAR), label, CAST(n AS DOUBLE) FROM ({ORACLES["histogram"]})
""",
)
def explore_tables(spark, sf_dir):
    """The exploration job's tables with defined values, one under the other: all but schema and sample."""
    tables = jobs.explore(table(spark, sf_dir, "lineitem"), STATUS_ROLES, bins=BINS)
    numeric = rounded(tables["numeric"], "class_0", "class_1").unpivot(["feature", "statistic"], ["class_0", "class_1"], "label", "amount")
    none = F.lit(None).cast("string")
    parts = {
        "rows": tables["rows"].select(none.alias("feature"), none.alias("value"), none.alias("label"), F.col("n_rows").alias("amount")),
        "crosstab": tables["crosstab"].select("feature", "value", "label", F.col("n").alias("amount")),
        "numeric": numeric.withColumnRenamed("statistic", "value"),
        "histogram": tables["histogram"].select("feature", F.col("bin").cast("string").alias("value"), "label", F.col("n").alias("amount")),
    }
    named = [part.select(F.lit(name).alias("report"), "feature", "value", "label", F.col("amount").cast("double")) for name, part in parts.items()]
    result = named[0]
    for other in named[1:]:
        result = result.unionByName(other)
    return result
