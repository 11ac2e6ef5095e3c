"""Queries on features, data quality, model metrics, drift and training."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratelake.model import DATE_COLUMN
from ratelake.operators import drift, features, metrics, quality, quantiles
from ratelake.operators.fill import forward_fill
from ratelake.operators.impute import impute_mean
from ratelake.plans import boosting, training
from ratelake.queries.inputs import VALUE_NAMES, WIDE, fresh_store, wide
from ratelake.queries.registry import query, table
from ratelake.session import work_path

PAIR = ("urgent_obs", "high_obs")


def _rounded(df, *columns):
    names = columns or [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, 6) for c in names})


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(day(o_orderdate) AS INTEGER) AS day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dayofweek FROM orders"""
)
def feat_date_parts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return features.date_parts(orders, "o_orderdate").drop("o_orderdate")


@query(
    f"""WITH {WIDE} SELECT "Fecha", """
    + ", ".join(f'{c}, ' + ", ".join(f'lag({c}, {n}) OVER (ORDER BY "Fecha") AS {c}_lag_{n}' for n in (1, 7, 30)) for c in PAIR)
    + " FROM wide"
)
def feat_lags(spark, sf_dir):
    rates = wide(spark, sf_dir).select(DATE_COLUMN, *PAIR)
    return features.lags(rates, PAIR, chunk_rows=500, rows_per_range=400)


def _rolling_sql(c: str, n: int) -> str:
    frame = f'OVER (ORDER BY "Fecha" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)'
    return ", ".join(
        f"CASE WHEN count({c}) {frame} = {n} THEN round({f}({c}) {frame}, 6) END AS {c}_roll_{name}_{n}"
        for f, name in (("avg", "mean"), ("stddev_samp", "std"))
    )


@query(
    f"""WITH {WIDE}, f AS (SELECT "Fecha", """
    + ", ".join(f'last_value({c} IGNORE NULLS) OVER (ORDER BY "Fecha" ROWS UNBOUNDED PRECEDING) AS {c}' for c in PAIR)
    + """ FROM wide) SELECT "Fecha", """
    + ", ".join(_rolling_sql(c, n) for c in PAIR for n in (7, 30))
    + " FROM f"
)
def feat_rolling(spark, sf_dir):
    rates = forward_fill(wide(spark, sf_dir).select(DATE_COLUMN, *PAIR), distinct_order=True)
    return _rounded(features.rolling(rates, PAIR, chunk_rows=500, rows_per_range=400).drop(*PAIR))


@query(
    f"""WITH {WIDE} SELECT "Fecha", urgent_obs, CAST(year("Fecha") AS INTEGER) AS year,
    CAST(month("Fecha") AS INTEGER) AS month, CAST(day("Fecha") AS INTEGER) AS day,
    CAST(isodow("Fecha") - 1 AS INTEGER) AS dayofweek, lag(urgent_obs, 1) OVER (ORDER BY "Fecha") AS urgent_obs_lag_1,
    {_rolling_sql('urgent_obs', 7)} FROM wide"""
)
def feat_engineer(spark, sf_dir):
    """All features in one pass over the ordered rows."""
    rates = wide(spark, sf_dir).select(DATE_COLUMN, "urgent_obs")
    made = features.engineer(rates, ["urgent_obs"], [1], [7], chunk_rows=500, rows_per_range=400)
    return _rounded(made, "urgent_obs_roll_mean_7", "urgent_obs_roll_std_7")


@query(
    """SELECT event_id, user_id, lag(value, 1) OVER w AS value_lag_1, lag(value, 7) OVER w AS value_lag_7
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)"""
)
def feat_lags_per_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    lagged = features.lags(events, ["value"], [1, 7], "ts", ["user_id"], chunk_rows=50, rows_per_range=2000)
    return lagged.drop("ts", "value")


def _scaled(spark, sf_dir, method):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return _rounded(features.scale(orders, ["o_totalprice"], method), "o_totalprice")


@query(
    """SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders))
    / (SELECT stddev_pop(o_totalprice) FROM orders), 6) AS o_totalprice FROM orders"""
)
def feat_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@query(
    """SELECT o_orderkey, round((o_totalprice - (SELECT min(o_totalprice) FROM orders))
    / (SELECT max(o_totalprice) - min(o_totalprice) FROM orders), 6) AS o_totalprice FROM orders"""
)
def feat_scale_minmax(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


@query(
    """SELECT o_orderkey, round((o_totalprice - (SELECT median(o_totalprice) FROM orders))
    / (SELECT quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25) FROM orders), 6) AS o_totalprice
  FROM orders"""
)
def feat_scale_robust(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")


@query(
    """SELECT o_orderkey, """
    + ", ".join(f"CAST(o_orderstatus = '{v}' AS INTEGER) AS \"o_orderstatus_{v}\"" for v in "FOP")
    + ", "
    + ", ".join(
        f"CAST(o_orderpriority = '{v}' AS INTEGER) AS \"o_orderpriority_{v}\""
        for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    + " FROM orders"
)
def feat_onehot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    learned = features.learn_categories(orders, ["o_orderstatus", "o_orderpriority"])
    return features.one_hot(orders, learned).drop("o_orderstatus", "o_orderpriority")


@query(
    """WITH d AS (SELECT 0 AS p, o_orderpriority AS v FROM orders UNION SELECT 1, CAST(o_custkey AS VARCHAR) FROM orders),
    i AS (SELECT p, v, row_number() OVER (ORDER BY p, v) - 1 AS ix FROM d WHERE v IS NOT NULL)
  SELECT o_orderkey, concat_ws(',', a.ix, b.ix) AS indices, CAST((a.ix IS NOT NULL)::INT + (b.ix IS NOT NULL)::INT AS DOUBLE) AS total
  FROM orders LEFT JOIN i a ON a.p = 0 AND a.v = o_orderpriority LEFT JOIN i b ON b.p = 1 AND b.v = CAST(o_custkey AS VARCHAR)"""
)
def feat_onehot_sparse(spark, sf_dir):
    """A column with more values than columns could be made for: the customer of every order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    encoded = ["o_orderpriority", "o_custkey"]
    made = features.one_hot_sparse(orders, features.learn_dictionary(orders, encoded), encoded)
    total = F.aggregate("values", F.lit(0.0), lambda s, x: s + x)
    return made.select("o_orderkey", F.array_join(F.transform("indices", lambda x: x.cast("string")), ",").alias("indices"), total.alias("total"))


@query(
    f"""WITH {WIDE} SELECT "Fecha", """
    + ", ".join(f"round(coalesce({c}, (SELECT avg({c}) FROM wide)), 6) AS {c}" for c in VALUE_NAMES)
    + " FROM wide"
)
def feat_impute_mean(spark, sf_dir):
    return _rounded(impute_mean(wide(spark, sf_dir), VALUE_NAMES))


@query("SELECT o_orderkey, o_totalprice, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def feat_select(spark, sf_dir):
    parts = features.date_parts(table(spark, sf_dir, "orders"), "o_orderdate")
    return features.select_features(parts, ["o_totalprice", "month"], keep=["o_orderkey"])


@query(
    f"WITH {WIDE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_share, "
        f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.1 AS too_many FROM wide"
        for c in VALUE_NAMES
    )
)
def dq_missing(spark, sf_dir):
    return _rounded(quality.missing_share(wide(spark, sf_dir), VALUE_NAMES), "missing_share")


# A reading that is not a number on every seventh row.
SPOTTY = """s AS (SELECT event_id, user_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)"""


def _spotty(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return events.withColumn("value", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")))


@query(
    f"""WITH {SPOTTY} SELECT 'value' AS column_name, round(avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_share,
    avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) > 0.1 AS too_many FROM s"""
)
def dq_missing_nan(spark, sf_dir):
    return _rounded(quality.missing_share(_spotty(spark, sf_dir), ["value"]), "missing_share")


@query(
    f"""WITH {SPOTTY} SELECT event_id, round((value - (SELECT avg(value) FROM s)) / (SELECT stddev_pop(value) FROM s), 6) AS value
  FROM s"""
)
def feat_scale_nan(spark, sf_dir):
    return _rounded(features.scale(_spotty(spark, sf_dir).select("event_id", "value"), ["value"]), "value")


@query(
    f"""WITH {SPOTTY} SELECT count(value) AS n, round(sqrt(avg((value - 50) * (value - 50))), 6) AS rmse,
    round(avg(abs(value - 50)), 6) AS mae FROM s"""
)
def metrics_nan(spark, sf_dir):
    scored = _spotty(spark, sf_dir).withColumn("guess", F.lit(50.0))
    return _rounded(metrics.regression_metrics(scored, "value", "guess").drop("r2"))


@query("SELECT 'value' AS column_name, 0.0::DOUBLE AS psi FROM events LIMIT 1")
def drift_psi_nan(spark, sf_dir):
    """Data that differ only by readings that are no numbers have not drifted."""
    spotty = _spotty(spark, sf_dir)
    return _rounded(drift.population_stability(spotty.filter("NOT isnan(value)"), spotty, "value"))


TIED = "date_trunc('month', ts)"


@query(
    f"""SELECT event_id, last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS)
    OVER (PARTITION BY event_type ORDER BY {TIED}, event_id DESC ROWS UNBOUNDED PRECEDING) AS value FROM
    (SELECT *, -event_id AS minus FROM events)""".replace("event_id DESC", "minus")
)
def forward_fill_ties(spark, sf_dir):
    """Ordered by month, then by falling id: nearly all rows are tied on the first column."""
    events = table(spark, sf_dir, "events")
    tied = events.select(
        "event_id",
        "event_type",
        F.date_trunc("month", "ts").cast("date").alias("month"),
        (-F.col("event_id")).alias("minus"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"),
    )
    filled = forward_fill(tied, ["value"], ["month", "minus"], ["event_type"], rows_per_range=400)
    return filled.select("event_id", "value")


@query(
    """SELECT event_id, last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS)
    OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS value FROM events"""
)
def forward_fill_decimal(spark, sf_dir):
    """Decimal keys that differ beyond a double's precision."""
    events = table(spark, sf_dir, "events")
    keyed = events.select(
        "event_id",
        (F.lit("100000000000000000000").cast("decimal(38,0)") + F.col("event_id")).alias("at"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"),
    )
    return forward_fill(keyed, ["value"], "at", rows_per_range=400).select("event_id", "value")


@query(
    """WITH p AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, l_extendedprice AS v,
      row_number() OVER (PARTITION BY date_trunc('month', l_shipdate) ORDER BY l_extendedprice) AS k,
      count(*) OVER (PARTITION BY date_trunc('month', l_shipdate)) AS n FROM lineitem)
  SELECT period, share, min(v) AS value FROM p, (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95])::DOUBLE AS share)
  WHERE k >= ceil(share * n) GROUP BY 1, 2"""
)
def pred_percentiles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return metrics.prediction_percentiles(lines, "l_extendedprice", F.trunc("l_shipdate", "MM"))


def _iqr_sql(c: str, t: str) -> str:
    q1, q3 = (f"(SELECT quantile_cont({c}, {p}) FROM {t})" for p in (0.25, 0.75))
    low, high = f"{q1} - 3.0 * ({q3} - {q1})", f"{q3} + 3.0 * ({q3} - {q1})"
    return (
        f"SELECT '{c}' AS column_name, round({low}, 6) AS low, round({high}, 6) AS high, "
        f"count(*) FILTER ({c} < {low} OR {c} > {high}) AS outliers FROM {t}"
    )


@query(" UNION ALL ".join([_iqr_sql("l_extendedprice", "lineitem"), _iqr_sql("l_quantity", "lineitem")]))
def dq_outliers_iqr(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return _rounded(quality.iqr_outliers(lines, ["l_extendedprice", "l_quantity"]), "low", "high")


@query(_iqr_sql("value", "events"))
def dq_outliers_events(spark, sf_dir):
    return _rounded(quality.iqr_outliers(table(spark, sf_dir, "events"), ["value"]), "low", "high")


@query(
    """SELECT count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 450000) AS o_totalprice_out_of_range,
    CAST(max(o_orderdate) AS DATE) AS newest,
    CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-03') AS INTEGER) AS age_days,
    date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-03') <= 3 AS fresh FROM orders"""
)
def dq_range_freshness(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return quality.range_and_freshness(
        orders, {"o_totalprice": (1000, 450000)}, "o_orderdate", datetime(2001, 8, 3, 9), 3
    )


SPLIT_SQL = "CASE WHEN ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 1000 < 200 THEN 'test' ELSE 'train' END"


@query(f"SELECT o_orderkey, {SPLIT_SQL} AS split FROM orders")
def split_hash(spark, sf_dir):
    return training.with_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


def _metric_sql(y: str, p: str) -> str:
    e = f"({y} - {p})"
    return (
        f"count(*) AS n, round(sqrt(avg({e} * {e})), 6) AS rmse, "
        f"round(1 - sum({e} * {e}) / (var_pop({y}) * count(*)), 6) AS r2, round(avg(abs({e})), 6) AS mae"
    )


@query(f"SELECT {_metric_sql('l_extendedprice', '(l_quantity * 2000)')} FROM lineitem")
def regression_metrics(spark, sf_dir):
    scored = table(spark, sf_dir, "lineitem").withColumn("guess", F.col("l_quantity") * 2000)
    return _rounded(metrics.regression_metrics(scored, "l_extendedprice", "guess"))


LINE_SPLIT_SQL = SPLIT_SQL.replace("o_orderkey", "l_orderkey")


@query(
    f"""WITH m AS (SELECT {LINE_SPLIT_SQL} AS split,
      sqrt(avg((l_extendedprice - l_quantity * 2000) * (l_extendedprice - l_quantity * 2000))) AS rmse,
      1 - sum((l_extendedprice - l_quantity * 2000) * (l_extendedprice - l_quantity * 2000))
        / (var_pop(l_extendedprice) * count(*)) AS r2 FROM lineitem GROUP BY 1),
    d AS (SELECT max(rmse) FILTER (split = 'test') - max(rmse) FILTER (split = 'train') AS dr,
      max(r2) FILTER (split = 'train') - max(r2) FILTER (split = 'test') AS d2,
      max(rmse) FILTER (split = 'test') AS tr, max(r2) FILTER (split = 'test') AS t2 FROM m)
  SELECT round(dr, 6) AS rmse_difference, round(d2, 6) AS r2_difference,
    dr > 10.0 OR d2 > 0.1 AS is_overfitting, t2 >= 0.7 AND tr <= 100.0 AS accepted FROM d"""
)
def overfit_check(spark, sf_dir):
    scored = table(spark, sf_dir, "lineitem").withColumn("guess", F.col("l_quantity") * 2000)
    by_split = metrics.regression_metrics(
        training.with_split(scored, "l_orderkey"), "l_extendedprice", "guess", ["split"]
    )
    return _rounded(metrics.overfit_check(by_split))


OVER_TIME = """p AS (SELECT CAST(l_shipdate AS DATE) AS "Fecha", max(l_extendedprice) * 5 AS guess FROM lineitem GROUP BY 1),
  a AS (SELECT CAST(o_orderdate AS DATE) AS "Fecha", max(o_totalprice) AS actual FROM orders GROUP BY 1)"""


def _over_time(spark, sf_dir):
    predicted = table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias(DATE_COLUMN)).agg(
        (F.max("l_extendedprice") * 5).alias("guess")
    )
    actual = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias(DATE_COLUMN)).agg(
        F.max("o_totalprice").alias("actual")
    )
    month = F.trunc(DATE_COLUMN, "MM")
    return metrics.metrics_over_time(predicted, actual, [DATE_COLUMN], month, "actual", "guess")


@query(
    f"""WITH {OVER_TIME} SELECT CAST(date_trunc('month', "Fecha") AS DATE) AS period, {_metric_sql('actual', 'guess')}
  FROM p JOIN a USING ("Fecha") GROUP BY 1""".replace(
        "round(1 - sum", "CASE WHEN var_pop(actual) > 0 THEN round(1 - sum"
    ).replace("count(*)), 6) AS r2", "count(*)), 6) END AS r2")
)
def perf_over_time(spark, sf_dir):
    return _rounded(_over_time(spark, sf_dir))


@query(
    f"""WITH {OVER_TIME}, m AS (SELECT CAST(date_trunc('month', "Fecha") AS DATE) AS period,
      sqrt(avg((actual - guess) * (actual - guess))) AS rmse FROM p JOIN a USING ("Fecha") GROUP BY 1),
    w AS (SELECT *, lag(rmse) OVER (ORDER BY period) AS prev FROM m)
  SELECT period, round(rmse, 6) AS rmse, round(prev, 6) AS previous_rmse,
    coalesce(rmse > prev * 1.1, false) AS alert FROM w"""
)
def perf_alert(spark, sf_dir):
    return _rounded(metrics.rmse_alerts(_over_time(spark, sf_dir).select("period", "rmse")))


@query(
    """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, count(*) AS n,
    round(avg(l_quantity * 2000), 6) AS mean, round(stddev_samp(l_quantity * 2000), 6) AS std,
    min(l_quantity * 2000) AS low, max(l_quantity * 2000) AS high FROM lineitem GROUP BY 1"""
)
def pred_distribution(spark, sf_dir):
    scored = table(spark, sf_dir, "lineitem").withColumn("guess", F.col("l_quantity") * 2000)
    return _rounded(metrics.prediction_distribution(scored, "guess", F.trunc("l_shipdate", "MM")))


@query(
    """WITH m AS (SELECT sqrt(avg((l_extendedprice - l_quantity * 2000) ** 2)) AS old,
      sqrt(avg((l_extendedprice - l_quantity * 2100) ** 2)) AS new,
      1 - sum((l_extendedprice - l_quantity * 2000) ** 2) / (var_pop(l_extendedprice) * count(*)) AS old2,
      1 - sum((l_extendedprice - l_quantity * 2100) ** 2) / (var_pop(l_extendedprice) * count(*)) AS new2 FROM lineitem)
  SELECT round(old, 6) AS current_rmse, round(new, 6) AS candidate_rmse, round(old2, 6) AS current_r2,
    round(new2, 6) AS candidate_r2, new < old AS deploy FROM m"""
)
def model_compare(spark, sf_dir):
    scored = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 2000).alias("old"), (F.col("l_quantity") * 2100).alias("new")
    )
    rows = [metrics.regression_metrics(scored, "l_extendedprice", c) for c in ("old", "new")]
    return _rounded(metrics.compare_models(*rows))


def _eras(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return orders.filter(F.col("o_orderdate") < cut), orders.filter(F.col("o_orderdate") >= cut)


_DECILES = ", ".join(f"quantile_cont(o_totalprice, {i / 10}) AS q{i}" for i in range(1, 10))
_BIN = " + ".join(f"CAST(o_totalprice > q{i} AS INTEGER)" for i in range(1, 10))


@query(
    f"""WITH e AS (SELECT {_DECILES} FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
    b AS (SELECT {_BIN} AS bin, count(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01') AS b,
      count(*) FILTER (o_orderdate >= TIMESTAMP '1998-01-01') AS c FROM orders, e GROUP BY 1),
    s AS (SELECT greatest(b / (SELECT sum(b) FROM b), 0.0001) AS x, greatest(c / (SELECT sum(c) FROM b), 0.0001) AS y FROM b)
  SELECT 'o_totalprice' AS column_name, round(sum((y - x) * ln(y / x)), 6) AS psi FROM s"""
)
def drift_psi(spark, sf_dir):
    before, after = _eras(spark, sf_dir)
    return _rounded(drift.population_stability(before, after, "o_totalprice"), "psi")


@query(
    """WITH g AS (SELECT o_totalprice AS v, count(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01') AS b,
      count(*) FILTER (o_orderdate >= TIMESTAMP '1998-01-01') AS c FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1),
    t AS (SELECT sum(b)::HUGEINT AS tb, sum(c)::HUGEINT AS tc FROM g),
    s AS (SELECT v, sum(b) OVER (ORDER BY v)::HUGEINT AS b, sum(c) OVER (ORDER BY v)::HUGEINT AS c FROM g),
    d AS (SELECT v, abs(b * tc - c * tb) AS gap FROM s, t),
    k AS (SELECT max(gap)::DOUBLE / (tb::DOUBLE * tc::DOUBLE) AS distance,
      (SELECT min(v) FROM d WHERE gap = (SELECT max(gap) FROM d)) AS at_value FROM d, t GROUP BY tb, tc)
  SELECT 'o_totalprice' AS column_name, round(distance, 6) AS distance, round(at_value, 6) AS at_value, tb::BIGINT AS baseline_rows,
    tc::BIGINT AS current_rows, distance > sqrt(-ln(0.025) / 2) * sqrt((tb + tc)::DOUBLE / (tb * tc)::DOUBLE) AS drifted FROM k, t"""
)
def drift_ks(spark, sf_dir):
    before, after = (era.select("o_totalprice") for era in _eras(spark, sf_dir))
    return _rounded(drift.distribution_distance(before, after, "o_totalprice", rows_per_range=2000))


@query(
    """WITH x AS (SELECT o_orderdate, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus = 'P'
      THEN o_orderpriority || '-HELD' ELSE o_orderpriority END AS label FROM orders)
  SELECT label, count(*) AS n FROM x WHERE o_orderdate >= TIMESTAMP '1998-01-01'
    AND label NOT IN (SELECT label FROM x WHERE o_orderdate < TIMESTAMP '1998-01-01') GROUP BY 1"""
)
def drift_new_values(spark, sf_dir):
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    held = late & (F.col("o_orderstatus") == "P")
    label = F.when(held, F.concat("o_orderpriority", F.lit("-HELD"))).otherwise(F.col("o_orderpriority"))
    before, after = (era.withColumn("label", label) for era in _eras(spark, sf_dir))
    return drift.new_values(before, after, "label")


@query(
    """WITH f AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events
      WHERE ts < TIMESTAMP '2024-01-15')
  SELECT 'value' AS column_name, round(avg(CASE WHEN value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1)
    THEN 1.0 ELSE 0.0 END), 6) AS outlier_share FROM events, f WHERE ts >= TIMESTAMP '2024-01-15'"""
)
def drift_outliers(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    found = drift.outlier_share(events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut), ["value"])
    return _rounded(found, "outlier_share")


LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _lines(spark, sf_dir):
    return training.with_split(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query()
def gbt_fit(spark, sf_dir):
    """Metrics per split of the described boosted model: all its rounds, depth and learning rate."""
    lines = _lines(spark, sf_dir)
    # A thousand rounds read their rows again and again.
    model = training.fit(lines.filter(F.col("split") == "train"), LINE_FEATURES, "l_extendedprice", deal_above=100_000)
    return training.evaluate(model, lines, "l_extendedprice")


@query()
def batch_score(spark, sf_dir):
    """Every line with its prediction."""
    lines = _lines(spark, sf_dir)
    model = training.fit(
        lines.filter(F.col("split") == "train"), LINE_FEATURES, "l_extendedprice", rounds=3, max_depth=3, learning_rate=0.3
    )
    return training.score(model, lines).select("l_orderkey", "l_linenumber", "split", "l_extendedprice", "prediction")


def _first_split_sql() -> str:
    features = " UNION ALL ".join(
        f"SELECT {i} AS feature, CAST({c} AS DOUBLE) AS v, y FROM t" for i, c in enumerate(LINE_FEATURES)
    )
    shrunk = "sign({g}) * greatest(abs({g}) - 0.5, 0)"
    worth = "pow(" + shrunk + ", 2) / ({h} + 1.0)"
    return f"""WITH t AS (SELECT l_quantity, l_discount, l_tax, l_extendedprice AS y FROM lineitem),
  m AS (SELECT avg(y) AS base, count(*) AS ht, sum((y - (SELECT avg(y) FROM t)) * (y - (SELECT avg(y) FROM t))) AS spread FROM t),
  b AS (SELECT feature, v, sum((SELECT base FROM m) - y) AS g, count(*) AS h FROM ({features}) GROUP BY 1, 2),
  c AS (SELECT feature, v, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY feature) AS gt,
      sum(h) OVER (PARTITION BY feature) AS ht FROM b
    WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
  s AS (SELECT feature, v, gl, hl, gt - gl AS gr, ht - hl AS hr,
      0.5 * ({worth.format(g="gl", h="hl")} + {worth.format(g="(gt - gl)", h="(ht - hl)")} - {worth.format(g="gt", h="ht")}) AS gain
    FROM c WHERE hl >= 1 AND ht - hl >= 1 ORDER BY gain DESC, feature, v LIMIT 1)
  SELECT ['l_quantity', 'l_discount', 'l_tax'][feature + 1] AS feature, v AS threshold,
    round(gain / (SELECT spread FROM m), 6) AS gain_share, CAST(hl AS BIGINT) AS left_rows, CAST(hr AS BIGINT) AS right_rows,
    round(-({shrunk.format(g="gl")}) / (hl + 1.0), 4) AS left_weight, round(-({shrunk.format(g="gr")}) / (hr + 1.0), 4) AS right_weight
  FROM s"""


@query(_first_split_sql())
def boost_first_split(spark, sf_dir):
    """The first cut of a boosted model with both penalties, and the weights on its two sides."""
    lines, label = table(spark, sf_dir, "lineitem"), "l_extendedprice"
    edges = boosting.bin_edges(lines, LINE_FEATURES, 256)
    rows = boosting._binned(lines, LINE_FEATURES, label, edges)
    about = rows.agg(F.avg("y").alias("base")).first()["base"]
    spread = rows.agg(F.sum(F.pow(F.col("y") - about, 2))).first()[0]
    sums = boosting.histogram(rows, F.lit(1), F.lit(about) - F.col("y"), range(len(LINE_FEATURES)))
    best = boosting.best_splits(boosting.split_gains(sums, boosting.L1, boosting.L2))
    values = F.array(*[F.array(*[F.lit(v) for v in e]) for e in edges])
    gr, hr = F.col("gt") - F.col("gl"), F.col("ht") - F.col("hl")

    def weight(g, h):
        return F.round(-boosting._shrunk(g, boosting.L1) / (h + boosting.L2), 4)

    return best.select(
        F.get(F.array(*[F.lit(c) for c in LINE_FEATURES]), F.col("feature")).alias("feature"),
        F.get(F.get(values, F.col("feature")), F.col("bin")).alias("threshold"),
        F.round(F.col("gain") / spread, 6).alias("gain_share"),
        F.col("hl").cast("long").alias("left_rows"),
        hr.cast("long").alias("right_rows"),
        weight(F.col("gl"), F.col("hl")).alias("left_weight"),
        weight(gr, hr).alias("right_weight"),
    )


@query(
    """WITH RECURSIVE c AS (SELECT datediff('month', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS rnd,
      round(avg(o_totalprice), 2) AS error FROM orders GROUP BY 1),
  n AS (SELECT rnd, error, row_number() OVER (ORDER BY rnd) AS i FROM c),
  r AS (SELECT i, rnd AS top, error AS best, CAST(NULL AS BIGINT) AS stop FROM n WHERE i = 1
    UNION ALL
    SELECT n.i, CASE WHEN r.stop IS NULL AND n.error < r.best - 100 THEN n.rnd ELSE r.top END,
      CASE WHEN r.stop IS NULL AND n.error < r.best - 100 THEN n.error ELSE r.best END,
      CASE WHEN r.stop IS NULL AND NOT n.error < r.best - 100 AND n.rnd - r.top >= 20 THEN n.rnd ELSE r.stop END
    FROM r JOIN n ON n.i = r.i + 1)
  SELECT CAST(top AS BIGINT) AS best_round, best AS best_error, stop AS stop_round FROM r ORDER BY i DESC LIMIT 1"""
)
def early_stop_round(spark, sf_dir):
    """Where a curve stops: mean order totals by month stand for the error by round."""
    orders = table(spark, sf_dir, "orders")
    month = (F.year("o_orderdate") - 1992) * 12 + F.month("o_orderdate") - 1
    curve = orders.groupBy(month.alias("round")).agg(F.round(F.avg("o_totalprice"), 2).alias("error"))
    return boosting.early_stop(curve, patience=20, min_delta=100)


@query(
    """WITH v AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN 2 * value ELSE value END AS v FROM events),
  b AS (SELECT *, CAST(CASE WHEN v = 0 THEN 0 ELSE sign(v) * (floor(round(ln(abs(v)) / ln(1.02), 9)) + 100000) END AS BIGINT) AS bucket FROM v),
  w AS (SELECT 'all days' AS period, * FROM b UNION ALL SELECT 'second week', * FROM b WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'),
  c AS (SELECT period, bucket, count(*) AS inside, min(v) AS low, max(v) AS high FROM w GROUP BY 1, 2),
  p AS (SELECT *, sum(inside) OVER (PARTITION BY period ORDER BY bucket) - inside AS before, sum(inside) OVER (PARTITION BY period) AS n FROM c),
  s AS (SELECT CAST(unnest([0.25, 0.5, 0.75, 0.95]) AS DOUBLE) AS share)
  SELECT period, share, CAST(n AS BIGINT) AS n, low, high FROM p, s
  WHERE before <= floor(share * (n - 1)) AND floor(share * (n - 1)) < before + inside"""
)
def quantile_by_day_store(spark, sf_dir):
    """Quantiles from stored counts per day; some days come again with other values and replace what was stored."""
    events = table(spark, sf_dir, "events").select("ts", "value")
    store = fresh_store(spark)
    quantiles.store_day_counts(store, "counts", events, "ts", "value")
    late = events.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")).withColumn("value", 2 * F.col("value"))
    quantiles.store_day_counts(store, "counts", late, "ts", "value")
    shares = [0.25, 0.5, 0.75, 0.95]
    whole = quantiles.stored_quantiles(store, "counts", shares).withColumn("period", F.lit("all days"))
    week = quantiles.stored_quantiles(store, "counts", shares, date(2024, 1, 8), date(2024, 1, 14))
    return whole.unionByName(week.withColumn("period", F.lit("second week")))


LINE_CHECK = (
    "l_orderkey bigint, l_partkey int, l_quantity double, l_comment string, l_returnflag string, l_linestatus string"
)


def _report_sql(column, expected, found, problem, present):
    texts = ", ".join(f"'{t}'" if t else "NULL" for t in (column, expected, found, problem))
    return f"SELECT {texts}, {present} FROM lineitem"


@query(
    "SELECT column_name, expected, found, problem, present FROM ("
    + " UNION ALL ".join(
        _report_sql(*r)
        for r in (
            ("l_orderkey", "bigint", "bigint", None, "count(l_orderkey)"),
            ("l_partkey", "int", "bigint", "type", "count(l_partkey)"),
            ("l_quantity", "double", "double", None, "count(l_quantity)"),
            ("l_comment", "string", None, "missing", "0 * count(*)"),
            ("l_returnflag", "string", "string", None, "count(*) FILTER (l_returnflag <> 'N')"),
            ("l_linestatus", "string", "string", "empty", "0 * count(*)"),
            ("l_tax", None, "double", "unexpected", "count(l_tax)"),
        )
    )
    + ") AS t(column_name, expected, found, problem, present)"
)
def dq_schema(spark, sf_dir):
    """Lines held against a schema: one type differs, one column is gone, one is new, one lost its values."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_tax",
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
        F.lit(None).cast("string").alias("l_linestatus"),
    )
    return quality.schema_report(lines, StructType.fromDDL(LINE_CHECK))


@query(
    """WITH b AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
    c AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS o_orderstatus, o_totalprice FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-01-01')
  SELECT 'o_orderkey' AS column_name, 1.0::DOUBLE AS baseline_filled, false AS missing, 1.0::DOUBLE AS current_filled
  UNION ALL SELECT 'o_totalprice', 1.0, false, 1.0
  UNION ALL SELECT 'o_custkey', (SELECT round(count(o_custkey) / count(*), 6) FROM b), true, 0.0
  UNION ALL SELECT 'o_orderstatus', 1.0, false, (SELECT round(count(o_orderstatus) / count(*), 6) FROM c)"""
)
def drift_feature_coverage(spark, sf_dir):
    """Newer orders lack one feature, and part of another's values."""
    before, after = _eras(spark, sf_dir)
    names = ["o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus"]
    after = after.drop("o_custkey").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("F")))
    return _rounded(drift.feature_coverage(before.select(names), after), "baseline_filled", "current_filled")


@query("SELECT * FROM lineitem")
def training_csv_read(spark, sf_dir):
    """Lines written as CSV with a header and read back by a stated schema."""
    lines, path = table(spark, sf_dir, "lineitem"), work_path(spark, "csv")
    lines.write.csv(path, header=True)
    return training.read_training_csv(spark, path, lines.schema)


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity * 1500 AS prediction,
    DATE '2001-08-02' AS scored_on FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'
  UNION ALL SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity * 1200, DATE '2001-08-01'
    FROM lineitem WHERE l_returnflag = 'R'"""
)
def prediction_sink(spark, sf_dir):
    """Features kept by month, read back and scored on two days; the second day's run is repeated with other results."""
    lines, store = table(spark, sf_dir, "lineitem"), fresh_store(spark)
    features = lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    # The same months twice: the table holds them once.
    for _ in range(2):
        training.save_features(store, "features", features, "l_shipdate")
    held = store.scan("features")

    def scored(rows, factor):
        return rows.select("l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_quantity") * factor).alias("prediction"))

    first, second = date(2001, 8, 1), date(2001, 8, 2)
    training.save_predictions(store, "predictions", scored(held.filter("l_returnflag = 'R'"), 1200), first)
    training.save_predictions(store, "predictions", scored(held, 1000), second)
    late = store.scan("features", start=datetime(1997, 1, 1))
    training.save_predictions(store, "predictions", scored(late, 1500), second)
    return training.read_predictions(store, "predictions").unionAll(training.read_predictions(store, "predictions", first))
