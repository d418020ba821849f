"""Linear regression, random forest, cross-validation and metrics.

With one feature, ridge regression has a closed form, so most of these can be checked against SQL.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from snapfold.catalog.features import hash_sql, split_sql
from snapfold.catalog.registry import query, table
from snapfold.ml.evaluation import metric_report, r2, rmse
from snapfold.ml.ridge import ridge_report
from snapfold.ml.tuning import cross_validate, param_grid
from snapfold.operators import hash_split, with_fold
from snapfold.session import fresh_path

_REG_PARAMS = [0.01, 0.1, 10.0]


def _parts(spark, sf_dir):
    """Parts with one feature ``x``, a label ``y`` that mostly follows it, a split and a fold."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        (F.col("p_partkey") % 1000).cast("double").alias("x"),
        (F.col("p_retailprice") + F.col("p_size")).alias("y"),
    )
    tagged = with_fold(hash_split(parts, ["p_partkey"]), ["p_partkey"])
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(tagged)


_PARTS_SQL = f"""parts AS (
  SELECT p_partkey, CAST(p_partkey % 1000 AS DOUBLE) AS x, p_retailprice + p_size AS y,
         {split_sql('p_partkey')} AS split, CAST({hash_sql('p_partkey', 7)} % 4 AS INTEGER) AS fold FROM part)"""


def _slope_sql(reg_param: str) -> str:
    return f"covar_pop(y, x) / var_pop(x) / (1 + {reg_param} / stddev_pop(y))"


def _ridge(reg_param: float = 0.1) -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol="y", regParam=reg_param, maxIter=10)


def _train(parts):
    return parts.where(F.col("split") == "train")


@query(
    "linear_regression",
    f"""WITH {_PARTS_SQL} SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
        regr_count(y, x)::BIGINT AS n FROM parts""",
)
def linear_regression(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    model = _ridge(0.0).fit(parts)
    slope, intercept = float(model.coefficients[0]), float(model.intercept)
    return parts.agg(
        F.round(F.lit(slope), 6).alias("slope"), F.round(F.lit(intercept), 6).alias("intercept"), F.count("*").alias("n")
    )


_RIDGE_FIT_SQL = f"""fit AS (
  SELECT slope, my - slope * mx AS intercept FROM (
    SELECT {_slope_sql('0.1')} AS slope, avg(x) AS mx, avg(y) AS my FROM parts WHERE split = 'train'))"""


@query(
    "ridge_regression",
    f"WITH {_PARTS_SQL}, {_RIDGE_FIT_SQL} SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM fit",
)
def ridge_regression(spark, sf_dir):
    model = _ridge().fit(_train(_parts(spark, sf_dir)))
    row = (float(model.coefficients[0]), float(model.intercept))
    fitted = spark.createDataFrame([row], "slope double, intercept double")
    return fitted.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


_SCORED_SQL = f"""WITH {_PARTS_SQL}, {_RIDGE_FIT_SQL},
  scored AS (SELECT p_partkey, split, y, x * slope + intercept AS prediction FROM parts, fit)"""
_SCORES_SQL = _SCORED_SQL + " SELECT p_partkey, split, round(prediction, 5) AS prediction FROM scored"


@query("batch_score", _SCORES_SQL)
def batch_score(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    scored = _ridge().fit(_train(parts)).transform(parts)
    return scored.select("p_partkey", "split", F.round("prediction", 5).alias("prediction"))


@query("model_roundtrip_predict", _SCORES_SQL)
def model_roundtrip_predict(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    path = fresh_path(spark, "ridge-model")
    _ridge().fit(_train(parts)).write().overwrite().save(path)
    scored = LinearRegressionModel.load(path).transform(parts)
    return scored.select("p_partkey", "split", F.round("prediction", 5).alias("prediction"))


_REPORT_SQL = """SELECT split, count(*) AS n, round(avg((y - prediction) ** 2), 6) AS mse,
    round(sqrt(avg((y - prediction) ** 2)), 6) AS rmse,
    round(1 - avg((y - prediction) ** 2) / var_pop(y), 6) AS r2 FROM scored GROUP BY split"""


def _rounded_report(scored, label):
    report = metric_report(scored, label)
    return report.select("split", "n", *[F.round(c, 6).alias(c) for c in ("mse", "rmse", "r2")])


@query("metric_report", f"{_SCORED_SQL} {_REPORT_SQL}")
def metric_report_query(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return _rounded_report(_ridge().fit(_train(parts)).transform(parts), "y")


def judged(report, least):
    """Rows of each split, and whether more than ``least`` of the label's variance is explained: facts that SQL can state."""
    return report.select("split", "n", (F.col("r2") > least).alias("good"))


_FIXED_SQL = "SELECT p_retailprice AS y, 900.0 + p_size * 2 AS p FROM part"


def _fixed(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_retailprice").alias("y"), (F.lit(900.0) + F.col("p_size") * 2).alias("p")
    )


@query("eval_rmse", f"SELECT round(sqrt(avg((y - p) ** 2)), 6) AS rmse FROM ({_FIXED_SQL})")
def eval_rmse(spark, sf_dir):
    return _fixed(spark, sf_dir).agg(F.round(rmse("y", "p"), 6).alias("rmse"))


@query(
    "eval_r2",
    f"""SELECT round(1 - sum((y - p) ** 2) / (SELECT sum((y - m) ** 2) FROM ({_FIXED_SQL}),
          (SELECT avg(y) AS m FROM ({_FIXED_SQL}))), 6) AS r2 FROM ({_FIXED_SQL})""",
)
def eval_r2(spark, sf_dir):
    return _fixed(spark, sf_dir).agg(F.round(r2("y", "p"), 6).alias("r2"))


_GRID_SQL = f"""WITH {_PARTS_SQL}, folds AS (SELECT DISTINCT fold AS held FROM parts),
  grid AS (SELECT * FROM (VALUES {', '.join(f'({i}, {r}::DOUBLE)' for i, r in enumerate(_REG_PARAMS))}) t(point, reg)),
  sums AS (
    SELECT held, covar_pop(y, x) AS cxy, var_pop(x) AS vx, stddev_pop(y) AS sy, avg(x) AS mx, avg(y) AS my
    FROM parts, folds WHERE split = 'train' AND fold <> held GROUP BY held),
  fits AS (SELECT point, reg, held, cxy / vx / (1 + reg / sy) AS slope, mx, my FROM sums, grid),
  errors AS (
    SELECT point, reg, held, sqrt(avg((y - (my + slope * (x - mx))) ** 2)) AS rmse
    FROM fits JOIN parts ON fold = held AND split = 'train' GROUP BY ALL),
  means AS (SELECT point, reg, avg(rmse) AS mean_rmse FROM errors GROUP BY ALL)"""


def _cross_validation(spark, sf_dir, refit=False):
    train = _train(_parts(spark, sf_dir)).select("features", "y", "fold")
    estimator = _ridge()
    grid = param_grid(estimator, {"regParam": _REG_PARAMS, "maxIter": [10]})
    return cross_validate(estimator, grid, train, "y", refit=refit)


@query(
    "cross_validate",
    _GRID_SQL
    + """ SELECT CAST(point AS INTEGER) AS point, reg AS "regParam", CAST(10 AS DOUBLE) AS "maxIter",
          round(mean_rmse, 6) AS mean_rmse, mean_rmse = min(mean_rmse) OVER () AS best FROM means""",
)
def cross_validate_query(spark, sf_dir):
    report = _cross_validation(spark, sf_dir).report(spark)
    return report.withColumn("mean_rmse", F.round("mean_rmse", 6))


@query(
    "best_params",
    _GRID_SQL
    + """, best AS (SELECT reg FROM means ORDER BY mean_rmse, point LIMIT 1)
        SELECT reg AS "regParam", CAST(10 AS DOUBLE) AS "maxIter",
               round(covar_pop(y, x) / var_pop(x) / (1 + reg / stddev_pop(y)), 6) AS slope
        FROM parts, best WHERE split = 'train' GROUP BY reg""",
)
def best_params(spark, sf_dir):
    result = _cross_validation(spark, sf_dir, refit=True)
    report = result.report(spark).where("best").select("regParam", "maxIter")
    return report.withColumn("slope", F.round(F.lit(float(result.model.coefficients[0])), 6))


@query(
    "param_grid",
    f"""WITH {_PARTS_SQL}, grid AS (SELECT * FROM (VALUES {', '.join(f'({r}::DOUBLE)' for r in _REG_PARAMS)}) t(reg))
        SELECT reg AS "regParam", round({_slope_sql('reg')}, 6) AS slope FROM parts, grid
        WHERE split = 'train' GROUP BY reg""",
)
def param_grid_query(spark, sf_dir):
    """Each grid point fitted on the training rows."""
    train = _train(_parts(spark, sf_dir))
    estimator = _ridge()
    grid = param_grid(estimator, {"regParam": _REG_PARAMS})
    models = dict(estimator.fitMultiple(train, grid))
    rows = [(float(r), float(models[i].coefficients[0])) for i, r in enumerate(_REG_PARAMS)]
    return spark.createDataFrame(rows, "regParam double, slope double").withColumn("slope", F.round("slope", 6))


_RIDGE3_SQL = f"""WITH rows AS (
    SELECT CAST(p_partkey % 1000 AS DOUBLE) AS a, CAST(p_size AS DOUBLE) AS b, CAST(p_partkey * 7919 % 97 AS DOUBLE) AS c,
           p_retailprice + 3 * p_size - p_partkey * 7919 % 97 + p_partkey * 31 % 53 AS y, CAST({hash_sql('p_partkey', 7)} % 4 AS INTEGER) AS fold FROM part),
  folds AS (SELECT DISTINCT fold AS held FROM rows),
  grid AS (SELECT * FROM (VALUES {', '.join(f'({r}::DOUBLE)' for r in _REG_PARAMS)}) t(reg)),
  m AS (SELECT held, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my, stddev_pop(a) AS sa, stddev_pop(b) AS sb, stddev_pop(c) AS sc, stddev_pop(y) AS sy,
               corr(a, b) AS ab, corr(a, c) AS ac, corr(b, c) AS bc, corr(a, y) AS ay, corr(b, y) AS by_, corr(c, y) AS cy
        FROM rows, folds WHERE fold <> held GROUP BY held),
  p AS (SELECT *, 1 + reg / sy AS d FROM m, grid),
  det AS (SELECT *, d * (d * d - bc * bc) - ab * (ab * d - bc * ac) + ac * (ab * bc - d * ac) AS det FROM p),
  fits AS (SELECT held, reg, ma, mb, mc, my,
      (ay * (d * d - bc * bc) - ab * (by_ * d - bc * cy) + ac * (by_ * bc - d * cy)) / det * sy / sa AS wa,
      (d * (by_ * d - bc * cy) - ay * (ab * d - bc * ac) + ac * (ab * cy - by_ * ac)) / det * sy / sb AS wb,
      (d * (d * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - d * ac)) / det * sy / sc AS wc FROM det)
  SELECT held AS held_out, reg AS reg_param, round(wa, 6) AS wa, round(wb, 6) AS wb, round(wc, 6) AS wc, round(my - wa * ma - wb * mb - wc * mc, 5) AS intercept,
         round(sqrt(avg((y - my - wa * (a - ma) - wb * (b - mb) - wc * (c - mc)) ** 2)), 6) AS rmse, count(*) AS n
  FROM fits JOIN rows ON fold = held GROUP BY held, reg, wa, wb, wc, ma, mb, mc, my"""


@query("ridge_one_scan", _RIDGE3_SQL)
def ridge_one_scan(spark, sf_dir):
    """Three features, four folds, three penalties: twelve fits and their errors from one scan, against the normal equations."""
    key = F.col("p_partkey")
    rows = with_fold(table(spark, sf_dir, "part"), ["p_partkey"]).select(
        (key % 1000).alias("a"), F.col("p_size").alias("b"), (key * 7919 % 97).alias("c"),
        (F.col("p_retailprice") + 3 * F.col("p_size") - key * 7919 % 97 + key * 31 % 53).alias("y"), "fold",
    )
    report = ridge_report(rows, ["a", "b", "c"], "y", _REG_PARAMS)
    weights = [F.round(F.col("coefficients")[i], 6).alias(f"w{c}") for i, c in enumerate("abc")]
    return report.select("held_out", "reg_param", *weights, F.round("intercept", 5).alias("intercept"), F.round("rmse", 6).alias("rmse"), "n")


def _forest_rows(spark, sf_dir):
    parts = hash_split(table(spark, sf_dir, "part"), ["p_partkey"]).withColumn("k", F.col("p_partkey") % 1000)
    assembled = VectorAssembler(inputCols=["k", "p_size"], outputCol="features").transform(parts)
    return with_fold(assembled, ["p_partkey"]).select("p_partkey", "p_retailprice", "split", "fold", "features")


def _forest():
    return RandomForestRegressor(
        featuresCol="features", labelCol="p_retailprice", numTrees=20, maxDepth=10, seed=42
    )


@query(
    "random_forest", f"WITH {_PARTS_SQL} SELECT split, count(*) AS n, true AS good FROM parts GROUP BY split"
)
def random_forest(spark, sf_dir):
    """Whether a forest explains 95 % of the variance of each split."""
    rows = _forest_rows(spark, sf_dir)
    return judged(metric_report(_forest().fit(_train(rows)).transform(rows), "p_retailprice"), 0.95)


@query(
    "random_forest_cv",
    f"""WITH {_PARTS_SQL} SELECT 0 AS point, CAST(20 AS DOUBLE) AS "numTrees", CAST(10 AS DOUBLE) AS "maxDepth",
        true AS best, count(*) AS n, true AS good FROM parts WHERE split = 'train'""",
)
def random_forest_cv(spark, sf_dir):
    """Whether the forest's mean RMSE over four folds is below a fourth of the label's deviation."""
    train = _train(_forest_rows(spark, sf_dir))
    forest = _forest()
    grid = param_grid(forest, {"numTrees": [20], "maxDepth": [10]})
    report = cross_validate(forest, grid, train, "p_retailprice", refit=False).report(spark)
    label = train.agg(F.count("*").alias("n"), F.stddev_pop("p_retailprice").alias("spread")).first()
    good = F.col("mean_rmse") < label["spread"] / 4
    return report.select("point", "numTrees", "maxDepth", "best", F.lit(label["n"]).cast("bigint").alias("n"), good.alias("good"))
