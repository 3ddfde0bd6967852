"""Metric, gate, ranking and valuation-card queries, and the gold table."""

from __future__ import annotations

from pyspark.sql import functions as F

from estatelake.functions import valuation
from estatelake.functions.numbers import not_negative, mean_of
from estatelake.operators import cleaning, metrics, sampling
from estatelake.operators.enrichment import income_index
from estatelake.plans.medallion import build_gold
from estatelake.staging import stage, stage_all
from workload.registry import query

# Thresholds scaled to the prices of the test tables: some runs pass, some fail.
TEST_GATES = [
    ("training", "rmse", "<", 23350.0),
    ("training", "r2", ">", 0.0),
    ("registration", "rmse", "<", 23350.0),
    ("validation", "rmse", "<=", 23350.0),
    ("validation", "r2", ">=", 0.5),
    ("validation", "mae", "<=", 20000.0),
]
TEST_GATES_SQL = "values " + ", ".join(
    f"('{s}', '{m}', '{o}', {t}::double)" for s, m, o, t in TEST_GATES
)


@query("select * from runs", "listings scored target_means runs")
def regression_metrics(t):
    return t.runs


@query(
    """
select model, round(sqrt(avg((price-prediction)*(price-prediction))), 2) as rmse, round(avg(abs(price-prediction)), 2) as mae,
       count(*) as n_samples
from scored group by model
""",
    "listings scored",
)
def metrics_overall(t):
    found = metrics.regression_metrics(t.scored, "price", "prediction", ["model"])
    return found.select("model", "rmse", "mae", "n_samples")


@query(
    f"""
with rules(rule_set, metric, op, threshold) as ({TEST_GATES_SQL}),
long as (
  select model, district, 'rmse' as metric, rmse as value from runs
  union all select model, district, 'r2', r2 from runs
  union all select model, district, 'mae', mae from runs)
select model, district, rule_set, count(*) as n_checks,
       count(*) filter (where not case op when '<' then value < threshold when '<=' then value <= threshold
                                  when '>' then value > threshold else value >= threshold end) as n_failed,
       bool_and(case op when '<' then value < threshold when '<=' then value <= threshold
                when '>' then value > threshold else value >= threshold end) as passed
from long join rules using (metric) group by model, district, rule_set
""",
    "listings scored target_means runs",
)
def quality_gate(t):
    rules = metrics.gate_rules(t.spark, TEST_GATES)
    checks = metrics.gate_checks(t.runs, rules, ["model", "district"])
    return metrics.gate_verdict(checks, rules, ["model", "district"])


@query(
    """
select district, arg_min(model, rmse) as model, min(rmse) as rmse from runs group by district
""",
    "listings scored target_means runs",
)
def select_best(t):
    return metrics.select_best(t.runs, ["district"]).select("district", "model", "rmse")


@query(
    """
select district, model, rmse, r2, cast(place as int) as place, place = 1 as is_winner from (
  select *, row_number() over (partition by district order by rmse, model) as place from runs) r
order by district, place
""",
    "listings scored target_means runs",
)
def leaderboard(t):
    board = metrics.leaderboard(t.runs, ["district"])
    return board.select("district", "model", "rmse", "r2", "place", "is_winner")


@query(
    """
select model, district, rmse, r2 from runs where rmse < 200000 order by rmse, model, district limit 1
""",
    "listings scored target_means runs",
)
def best_run(t):
    best = metrics.best_run(t.runs, order=["model", "district"])
    return best.select("model", "district", "rmse", "r2")


FEATURES = ["size", "rooms", "bathrooms", "data_year", "tie_3", "tie_4"]


@query(
    " union all ".join(
        f"select '{f}' as feature, round(abs(corr({f}, price)), 6) as importance from listings"
        for f in FEATURES
    )
    + " order by importance desc, feature limit 15",
    "listings",
)
def top_importance(t):
    scores = metrics.correlation_importance(
        t.listings.select("price", *[F.col(f).cast("double").alias(f) for f in FEATURES]),
        FEATURES,
        "price",
    )
    top = metrics.top_importance(scores)
    return top.select("feature", F.round("importance", 6).alias("importance"))


@query(
    """
select round(regr_slope(price, size), 6) as slope, round(regr_intercept(price, size), 4) as intercept,
       round(regr_r2(price, size), 6) as r2, cast(regr_count(price, size) as bigint) as n_samples
from listings
""",
    "listings",
)
def ols_fit(t):
    line = metrics.line_fit(t.listings, "size", "price")
    return line.select(
        F.round("slope", 6).alias("slope"),
        F.round("intercept", 4).alias("intercept"),
        F.round("r2", 6).alias("r2"),
        "n_samples",
    )


@query(
    """
with outputs as (
  select property_id, list_sort([price, price * (1 - tie_3), price * (1 + tie_4), size * 1500, rooms * 1000.0]) as o
  from listings)
select property_id, round(o[1] + (o[2] - o[1]) * 0.4, 6) as p10, round(o[4] + (o[5] - o[4]) * 0.6, 6) as p90
from outputs
""",
    "listings",
)
def ensemble_interval(t):
    price = F.col("price")
    outputs = F.array(
        price,
        price * (1 - F.col("tie_3")),
        price * (1 + F.col("tie_4")),
        F.col("size") * 1500,
        F.col("rooms") * 1000.0,
    )
    rows = t.listings.select("property_id", outputs.alias("outputs"))
    return rows.select(
        "property_id",
        F.round(valuation.interval_of(F.col("outputs"), 0.1), 6).alias("p10"),
        F.round(valuation.interval_of(F.col("outputs"), 0.9), 6).alias("p90"),
    )


@query(
    """
select s.property_id, s.model, s.price, greatest(0, s.prediction - r.rmse) as confidence_low,
       greatest(0, s.prediction + r.rmse) as confidence_high
from scored s join runs r on s.model = r.model and s.district = r.district
""",
    "listings scored target_means runs",
    rounded="confidence_low confidence_high",
)
def rmse_band(t):
    errors = stage(t.runs.select("model", "district", "rmse"), "errors")
    banded = t.scored.join(errors, ["model", "district"]).withColumns(
        valuation.error_band(F.col("prediction"), F.col("rmse"))
    )
    return banded.select("property_id", "model", "price", "confidence_low", "confidence_high")


@query(
    """
select property_id, model, price, prediction from scored
where ('0x' || substr(md5('sample-' || property_id), 1, 8))::bigint % 100 < 50
""",
    "listings scored",
    rounded="prediction",
)
def prediction_pairs(t):
    """Half of the actual-against-predicted pairs, as a chart would show."""
    pairs = sampling.sample_fraction(t.scored, "property_id", 50)
    return pairs.select("property_id", "model", "price", "prediction")


@query(
    """
with estimates as (select property_id, size, price - 1500 * size as estimate from listings)
select property_id, greatest(0.0, estimate) as predicted_price,
       case when estimate > 0 then estimate end * 0.9 as card_low, case when estimate > 0 then estimate end * 1.1 as card_high,
       case when estimate > 0 then estimate end / size as predicted_m2
from estimates
""",
    "listings",
)
def valuation_band(t):
    estimates = t.listings.select(
        "property_id", "size", (F.col("price") - 1500 * F.col("size")).alias("estimate")
    )
    return estimates.withColumns(
        valuation.card_columns(F.col("estimate"), F.col("size"))
    ).select(
        "property_id",
        not_negative("estimate").alias("predicted_price"),
        "card_low",
        "card_high",
        "predicted_m2",
    )


@query(
    """
select property_id, bathrooms * 3 - 4 as floor,
       case when bathrooms * 3 - 4 = 0 then 'ground' when bathrooms * 3 - 4 <= 2 then 'low' when bathrooms * 3 - 4 <= 5 then 'mid'
            when bathrooms * 3 - 4 <= 10 then 'high' else 'penthouse' end as floor_band
from listings
""",
    "listings",
)
def floor_band(t):
    floors = t.listings.select("property_id", (F.col("bathrooms") * 3 - 4).alias("floor"))
    return floors.withColumn("floor_band", valuation.floor_band(F.col("floor")))


GOLD_SQL = """
with joined as (
  select l.*, i.income as avg_income_index, d.density_val, l.price / l.size as price_m2
  from silver l
  join income_year i on l.neighborhood_id = i.neighborhood_id and l.data_year = i.year
  left join density_year d on l.neighborhood_id = d.neighborhood_id and l.data_year = d.year
  where l.size > 15 and l.price > 10000),
q as (select quantile_cont(price_m2, 0.25) as q1, quantile_cont(price_m2, 0.75) as q3 from joined),
kept as (
  select joined.* from joined cross join q
  where price_m2 >= q1 - 1.5 * (q3 - q1) and price_m2 <= q3 + 1.5 * (q3 - q1)),
m as (select avg(density_val) as mean_density, avg(avg_income_index) as mean_income from kept)
select property_id, neighborhood, district, propertyType, rooms, bathrooms, price, size, price_m2,
       coalesce(avg_income_index, mean_income) as avg_income_index, coalesce(density_val, mean_density) as density_val, coalesce(hasLift, false) as hasLift
from kept cross join m
"""


def gold(t):
    """The gold table over staged silver tables."""
    silver = stage_all(
        listings=cleaning.with_area_id(t.newest_listings, t.lookup),
        income=income_index(t.income_rows).withColumnRenamed("avg_income_index", "income"),
        density=t.density_rows.groupBy("neighborhood_id", "year").agg(
            mean_of("density_val").alias("density_val")
        ),
    )
    return build_gold(**silver)


@query(
    GOLD_SQL,
    "listings newest lookup silver income_raw density_raw income_rows density_rows income_year density_year",
    rounded="avg_income_index density_val",
)
def gold_table(t):
    return gold(t).select(
        "property_id", "neighborhood", "district", "propertyType", "rooms", "bathrooms", "price",
        "size", "price_m2", "avg_income_index", "density_val", "hasLift",
    )
