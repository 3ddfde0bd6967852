"""Training, scoring and streaming queries."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from estatelake.operators import areas, gram, models, sampling
from estatelake.operators.metrics import (
    GATES,
    gate_checks,
    gate_rules,
    gate_verdict,
    leaderboard,
    top_importance,
)
from estatelake.plans import training
from estatelake.plans.medallion import SILVER_KEYS
from estatelake.plans.valuation import responses, value
from estatelake.sources import files
from estatelake.sources.silver import SilverTable
from estatelake.staging import stage, staging_path
from estatelake.streaming import ingest as ingest_plan
from estatelake.streaming import scoring
from estatelake.streaming import upsert as upsert_plan
from workload import joins
from workload.evaluation import GOLD_SQL, gold
from workload.joins import HASH_SPLIT_SQL, MEASURE_VIEWS, MEASURES_SQL
from workload.registry import query

KEY = SILVER_KEYS["listings"][0]
GOLD_VIEWS = (
    "listings newest lookup silver income_raw density_raw income_rows density_rows income_year density_year"
)
SPLIT_SQL = f"""
, gold as ({{gold}}),
parts as (
  select *, {HASH_SPLIT_SQL} as split from gold where avg_income_index is not null and density_val is not null),
baseline as (
  select sum(case when split = 'train' then 1 else 0 end) as n_train, sum(case when split = 'test' then 1 else 0 end) as n_test,
         avg(case when split = 'train' then price end) as mean_price from parts),
plain as (
  select round(sqrt(avg((price - mean_price) * (price - mean_price))), 2) as plain_rmse
  from parts cross join baseline where split = 'test')
"""
# Least squares of price on size and rooms over the train part, and its error on the test part.
LINE_SQL = """
, centre as (select avg(size) as mx, avg(rooms) as mr, avg(price) as my from parts where split = 'train'),
moments as (
  select sum((size - mx) * (size - mx)) as xx, sum((rooms - mr) * (rooms - mr)) as rr, sum((size - mx) * (rooms - mr)) as xr,
         sum((size - mx) * (price - my)) as xy, sum((rooms - mr) * (price - my)) as ry
  from parts cross join centre where split = 'train'),
line as (
  select (xy * rr - ry * xr) / (xx * rr - xr * xr) as by_size, (ry * xx - xy * xr) / (xx * rr - xr * xr) as by_rooms, mx, mr, my
  from moments cross join centre),
judged as (
  select sqrt(avg(power(price - (my + by_size * (size - mx) + by_rooms * (rooms - mr)), 2))) as rmse
  from parts cross join line where split = 'test'),
priced as (
  select property_id, greatest(0, p) as predicted_price, greatest(0, p - rmse) as confidence_low, greatest(0, p + rmse) as confidence_high
  from (select property_id, my + by_size * (size - mx) + by_rooms * (rooms - mr) as p from gold cross join line) g cross join judged)
"""
PRICED_COLUMNS = ["predicted_price", "confidence_low", "confidence_high"]
# Whole euros: the last bits of two solutions of the same equations differ.
PRICED_SQL = ", ".join(f"round(round({c}, 2)) as {c}" for c in PRICED_COLUMNS)


def _gold_sql(body: str) -> str:
    """SQL that reads ``gold``, its split and the error of the mean price."""
    inner = GOLD_SQL.strip()[len("with "):]
    ctes, _, last = inner.rpartition("\nselect ")
    return "with " + ctes + SPLIT_SQL.format(gold="select " + last) + body


def _one(name, grid):
    """A spec of the usual model with a grid of its own."""
    known = {s.name: s for s in [*models.FREQUENCY_SPECS, *models.ALPHABETIC_SPECS[:1]]}
    spec = known[name]
    return models.ModelSpec(name, spec.build, grid, spec.scaled)


def _specs(names, profile="frequency"):
    known = models.FREQUENCY_SPECS if profile == "frequency" else models.ALPHABETIC_SPECS
    return [s for s in known if s.name in names]


def _searched(t, names, profile="frequency"):
    """Whole grids of the named models over all train rows, and whether what each run says fits together."""
    rows = stage(gold(t), "gold")
    parts = training.with_parts(training.train_rows(rows), KEY)
    prices = parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("price").alias("mean"), F.var_pop("price").alias("var"))
    known = {r["split"]: r for r in prices.collect()}
    mean = known["train"]["mean"]
    test = known["test"]
    plain = math.sqrt(test["var"] + (test["mean"] - mean) ** 2)
    found = []
    for spec, trained in zip(
        _specs(names, profile),
        training.train_all(rows, KEY, _specs(names, profile), profile, parallelism=6),
    ):
        run, points = trained.run, spec.points()
        agree = abs(run["r2"] - (1 - run["rmse"] ** 2 / test["var"])) < 1e-9 and run["mae"] <= run["rmse"]
        chosen = {n: float(v) for n, v in run["params"].items()}
        in_grid = chosen in [{n: float(v) for n, v in p.items()} for p in points]
        errors = {tuple(p.items()): [x.rmse for x in trained.tried if x.point == p] for p in points}
        least = min(sum(e) for e in errors.values())
        best = [p for p, e in errors.items() if sum(e) == least][0]
        found.append((
            spec.name, len(points), known["train"]["n"], trained.n_fitted, test["n"], len(trained.tried),
            sum(x.n_held for x in trained.tried) // len(points), round(plain, 2), agree,
            in_grid and chosen == {n: float(v) for n, v in best}, run["rmse"] < 1.05 * plain,
        ))
    return t.spark.createDataFrame(
        found,
        "model string, grid_points int, n_train long, n_fitted long, n_test long, n_tried int, n_held long, plain_rmse double, "
        "metrics_agree boolean, best_is_chosen boolean, near_plain boolean",
    )


def _searched_sql(*grids):
    values = ", ".join(f"('{name}', {points})" for name, points in grids)
    return _gold_sql(
        f"""
select model, cast(points as int) as grid_points, cast(n_train as bigint) as n_train, cast(n_train as bigint) as n_fitted,
       cast(n_test as bigint) as n_test, cast(3 * points as int) as n_tried, cast(n_train as bigint) as n_held,
       plain_rmse, true as metrics_agree, true as best_is_chosen, true as near_plain
from (values {values}) grids(model, points) cross join baseline cross join plain"""
    )


@query(_searched_sql(("LinearRegression", 2)), GOLD_VIEWS)
def train_linear(t):
    return _searched(t, ["LinearRegression"])


@query(_searched_sql(("RandomForest", 4)), GOLD_VIEWS)
def train_forest(t):
    return _searched(t, ["RandomForest"])


@query(_searched_sql(("GBTRegressor", 4)), GOLD_VIEWS)
def train_boosted(t):
    return _searched(t, ["GBTRegressor"])


@query(_searched_sql(("Ridge", 4)), GOLD_VIEWS)
def train_alphabetic(t):
    return _searched(t, ["Ridge"], "alphabetic")


@query(_searched_sql(("RandomForest", 12)), GOLD_VIEWS)
def train_alphabetic_forest(t):
    return _searched(t, ["RandomForest"], "alphabetic")


@query(_searched_sql(("GradientBoosting", 8)), GOLD_VIEWS)
def train_alphabetic_boosted(t):
    return _searched(t, ["GradientBoosting"], "alphabetic")


FOLD_SQL = "cast(('0x' || substr(md5('fold-' || property_id), 1, 8))::bigint % 3 as int)"
# Penalties from none that matters to one that flattens the line.
PENALTIES = [0.01, 1e5, 1e6, 1e7]


@query(
    f"""
with sized as (select size, rooms, price, {FOLD_SQL} as fold from listings),
folds as (select distinct fold as held from sized),
centre as (
  select held, count(*) as n, avg(size) as mx, avg(rooms) as mr, avg(price) as my from sized join folds on fold <> held group by held),
n as (
  select held, sum((size - mx) * (size - mx)) as xx, sum((rooms - mr) * (rooms - mr)) as rr, sum((size - mx) * (rooms - mr)) as xr,
         sum((size - mx) * (price - my)) as xy, sum((rooms - mr) * (price - my)) as ry
  from sized join centre on fold <> held group by held),
fits as (
  select alpha, held, (xy * (rr + alpha) - ry * xr) / ((xx + alpha) * (rr + alpha) - xr * xr) as by_size,
         (ry * (xx + alpha) - xy * xr) / ((xx + alpha) * (rr + alpha) - xr * xr) as by_rooms
  from n cross join (values {", ".join(f"({a}::double)" for a in PENALTIES)}) grid(alpha)),
judged as (
  select alpha, held as fold, by_size, by_rooms, my - by_size * mx - by_rooms * mr as intercept, c.n as n_fitted,
         count(*) as n_held, sqrt(avg(power(price - (my + by_size * (size - mx) + by_rooms * (rooms - mr)), 2))) as rmse
  from fits join centre c using (held) join sized on fold = held group by all),
means as (select alpha, avg(rmse) as mean_rmse from judged group by alpha)
select alpha, fold, round(by_size, 4) as size_slope, round(by_rooms, 4) as rooms_slope, round(intercept, 2) as intercept,
       round(rmse, 3) as rmse, n_fitted, n_held, mean_rmse = (select min(mean_rmse) from means) as chosen
from judged join means using (alpha)
""",
    "listings",
)
def grid_search(t):
    """Four ridge penalties on three folds, all from one table of sums."""
    rows = sampling.with_fold(t.listings.select("property_id", "size", "rooms", "price"), "property_id")
    table = stage(gram.gram_table(rows, ["size", "rooms"], "price", "fold"), "gram")
    fits = gram.search(gram.sums_by_fold(table), {a: gram.ridge(a) for a in PENALTIES})
    chosen = models.best_point([models.Tried({"alpha": f.value}, f.fold, f.rmse, f.n_fitted, f.n_held) for f in fits])
    found = [
        (f.value, f.fold, *(round(float(c), 4) for c in f.coefficients), round(f.intercept, 2), round(f.rmse, 3), f.n_fitted, f.n_held, f.value == chosen["alpha"])
        for f in fits
    ]
    return t.spark.createDataFrame(
        found,
        "alpha double, fold int, size_slope double, rooms_slope double, intercept double, rmse double, n_fitted long, n_held long, chosen boolean",
    )


@query(
    f"""
with z as (select {FOLD_SQL} as fold, [1.0, size, rooms, price] as z from listings),
cells as (select i, j from range(4) a(i), range(4) b(j) where i <= j)
select fold, cast(i as int) as i, cast(j as int) as j, round(sum(z[i + 1] * z[j + 1]) / count(*), 2) as mean_product
from z cross join cells group by fold, i, j
""",
    "listings",
)
def gram_merge(t):
    """The table of sums of two drops, each summed by itself and then added."""
    rows = sampling.with_fold(t.listings.select("property_id", "size", "rooms", "price", "data_year"), "property_id")
    drops = [rows.where("data_year < 1998"), rows.where("data_year >= 1998")]
    both = stage(gram.merged(*[gram.gram_table(d, ["size", "rooms"], "price", "fold") for d in drops]), "gram")
    count = both.where("i = 0 and j = 0").select("fold", F.col("value").alias("n"))
    return both.join(count, "fold").select("fold", "i", "j", F.round(F.col("value") / F.col("n"), 2).alias("mean_product"))


@query(
    """
with m as (select avg(size) as mx, avg(price) as my from listings),
s as (select sum((size - mx) * (price - my)) as xy, sum((size - mx) * (size - mx)) as xx from listings, m)
select alpha, round(xy / (xx + alpha), 4) as slope, round(my - mx * xy / (xx + alpha), 2) as intercept
from s, m, (values (0.01::double), (0.1::double), (1.0::double), (10.0::double)) penalties(alpha)
""",
    "listings",
)
def train_ridge(t):
    """Ridge with all penalties on one feature, which has a closed form."""
    rows = stage(t.listings.select("size", "price"), "rows")
    vectors = VectorAssembler(inputCols=["size"], outputCol="features_raw").transform(rows)
    shape = models.train_shape(rows)
    found = []
    for alpha in models.ALPHABETIC_SPECS[0].grid["alpha"]:
        ridge: LinearRegression = models.ALPHABETIC_SPECS[0].build(shape)
        fitted = ridge.setRegParam(models.ridge_penalty(alpha, shape)).fit(vectors)
        found.append((alpha, round(float(fitted.coefficients[0]), 4), round(float(fitted.intercept), 2)))
    return t.spark.createDataFrame(found, "alpha double, slope double, intercept double")


@query(
    _gold_sql(
        """
select place, place = 1 as is_winner, cast(n_test as bigint) as n_samples, true as in_order, true as verdict_fits
from baseline cross join (values (1), (2), (3)) places(place)"""
    ),
    GOLD_VIEWS,
)
def train_select(t):
    """Three models on one split: places, winner and gate verdicts."""
    specs = [
        _one("LinearRegression", {"regParam": [0.1]}),
        _one("RandomForest", {"numTrees": [20], "maxDepth": [5]}),
        _one("GBTRegressor", {"maxIter": [20], "maxDepth": [3]}),
    ]
    rows = stage(gold(t), "gold")
    trained = training.train_all(rows, KEY, specs)
    runs = stage(training.run_table(t.spark, trained).drop("run_id", "finished_at", "params"), "runs")
    rules = gate_rules(t.spark)
    verdicts = gate_verdict(gate_checks(runs, rules, ["model"]), rules, ["model"])
    placed = leaderboard(runs).join(verdicts.where("rule_set = 'validation'"), "model")
    before = F.lag("rmse").over(Window.orderBy("place"))
    fits = (F.col("rmse") <= 150000) & (F.col("r2") >= 0.70) & (F.col("mae") <= 100000)
    return placed.select(
        "place", "is_winner", "n_samples",
        F.coalesce(before <= F.col("rmse"), F.lit(True)).alias("in_order"),
        (fits == F.col("passed")).alias("verdict_fits"),
    )


def _forest(t):
    rows = stage(gold(t), "gold")
    spec = _one("RandomForest", {"numTrees": [20], "maxDepth": [5]})
    return rows, training.train_all(rows, KEY, [spec])[0]


def _line(t):
    """A linear model of two features, which SQL can solve as well."""
    rows = stage(gold(t), "gold")
    spec = _one("LinearRegression", {"regParam": [0.0]})
    return rows, training.train_all(rows, KEY, [spec], numeric=["size", "rooms"], categorical=[])[0]


def _whole_euros(scored):
    return {c: F.round(scored[c]) for c in PRICED_COLUMNS}


RULES_SQL = "values " + ", ".join(f"('{s}', '{m}', '{o}', {t}::double)" for s, m, o, t in GATES)


@query(
    _gold_sql(
        LINE_SQL
        + f"""
, tested as (
  select price as y, my + by_size * (size - mx) + by_rooms * (rooms - mr) as p
  from (select *, {HASH_SPLIT_SQL} as split from gold where price is not null) g cross join line where split = 'test'),
found as (
  select round(sqrt(avg((y - p) * (y - p))), 2) as rmse, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 4) as r2,
         round(avg(abs(y - p)), 2) as mae
  from tested),
rules(rule_set, metric, op, threshold) as ({RULES_SQL}),
valued as (select rules.*, case metric when 'rmse' then rmse when 'r2' then r2 else mae end as value from rules cross join found)
select *, case op when '<' then value < threshold when '<=' then value <= threshold when '>' then value > threshold
          else value >= threshold end as passed, value as reported
from valued"""
    ),
    GOLD_VIEWS,
)
def validate_model(t):
    """Checks of a linear model on the test part of its own split, and the values in the report that holds them."""
    rows, trained = _line(t)
    path = staging_path(t.spark, "report")
    checks, _ = training.validate(t.spark, trained.model, rows, KEY, report=path)
    report = t.spark.read.json(path).select("rule_set", "metric", F.col("value").alias("reported"))
    return checks.join(report, ["rule_set", "metric"]).select("rule_set", "metric", "op", "threshold", "value", "passed", "reported")


@query(
    MEASURES_SQL
    + """
, districts as (
  select district, avg(income) as income from measures join lookup using (neighborhood_id) where income > 0 group by district)
select l.property_id,
       case when m.income > 0 then 'neighborhood' when d.income is not null then 'district' else 'city' end as measure_source,
       'EUR' as currency, 'test' as model_version, true as ordered, true as card_fits, true as per_area
from listings l left join lookup k on l.neighborhood = k.neighborhood
left join measures m on k.neighborhood_id = m.neighborhood_id
left join districts d on l.district = d.district
where l.size > 0 and l.size <= 2000 and l.rooms between 0 and 20 and l.bathrooms between 1 and 10
""",
    MEASURE_VIEWS,
)
def value_requests(t):
    """Every listing as a request: defaults, rules, area measures, forest, card."""
    _, trained = _forest(t)
    measures = stage(joins.measures(t), "measures")
    districts = stage(areas.district_means(measures, t.lookup), "districts")
    asked = t.listings.select("property_id", "size", "rooms", "bathrooms", "neighborhood", "propertyType", "district")
    accepted, _ = value(asked, trained.model, trained.run["rmse"], "test", measures, districts, t.lookup)
    price = F.col("predicted_price")

    def near(column, wanted, slack):
        return F.abs(F.col(column) - wanted) <= slack

    return accepted.select(
        "property_id", "measure_source", "currency", "model_version",
        _ordered().alias("ordered"),
        (near("card_low", price * 0.9, 1.0) & near("card_high", price * 1.1, 1.0)).alias("card_fits"),
        near("predicted_m2", price / F.col("size"), 1.0).alias("per_area"),
    )


def _ordered():
    low, price, high = (F.col(c) for c in ("confidence_low", "predicted_price", "confidence_high"))
    return (low >= 0) & (low <= high) & (price >= 0)


SCORED_SQL = _gold_sql("select property_id, price, true as ordered, true as tree_mean from gold")


@query(SCORED_SQL, GOLD_VIEWS)
def forest_interval(t):
    """Every gold listing with the spread of the forest's trees, whose mean is the forest's own prediction."""
    rows, trained = _forest(t)
    fitted = trained.model.transform(rows).select(KEY, "prediction")
    scored = models.score(rows, trained.model, trained.run["rmse"]).join(fitted, KEY)
    same = F.abs(F.col("predicted_price") - F.greatest(F.lit(0.0), "prediction")) <= 1e-6 * F.col("prediction")
    return scored.select(KEY, "price", _ordered().alias("ordered"), same.alias("tree_mean"))


@query(
    """
select feature, true as is_share, true as whole
from (values ('size'), ('rooms'), ('bathrooms'), ('avg_income_index'), ('density_val'),
             ('neighborhood_idx'), ('propertyType_idx'), ('district_idx')) features(feature)
"""
)
def feature_importance(t):
    """A share for every feature; the shares sum to one."""
    _, trained = _forest(t)
    names = trained.model.stages[1].getInputCols()
    table = top_importance(models.importance_table(t.spark, trained.model.stages[-1], names))
    total = F.sum("importance").over(Window.partitionBy())
    return table.select(
        "feature", F.col("importance").between(0, 1).alias("is_share"), (F.abs(total - 1) < 1e-9).alias("whole")
    )


@query(_gold_sql(LINE_SQL + f"select property_id, 'EUR' as currency, 'test' as model_version, {PRICED_SQL} from priced"), GOLD_VIEWS)
def score_bulk(t):
    """Save the fitted pipeline, load it, value every gold listing with the loaded one."""
    rows, trained = _line(t)
    path = staging_path(t.spark, "model")
    trained.model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    scored = responses(models.score(rows, loaded, trained.run["rmse"]), "test")
    return scored.withColumns(_whole_euros(scored)).select(KEY, "currency", "model_version", *PRICED_COLUMNS)


def _with_gaps(rows):
    """Requests some of which lack a size or a rooms number, have NaN for a size, or a type that no model saw."""
    baths = F.col("bathrooms")
    return rows.withColumns(
        {
            "size": F.when(baths == 5, float("nan")).when(baths != 3, F.col("size")),
            "rooms": F.when((baths != 3) | (F.col("rooms") % 2 == 0), F.col("rooms")),
            "propertyType": F.when(baths != 2, F.col("propertyType")).otherwise("castle"),
        }
    )


REASONS_SQL = """case when bathrooms = 5 then 'size: not a number' when bathrooms = 3 and rooms % 2 = 1 then 'size: missing, rooms: missing'
 when bathrooms = 3 then 'size: missing' end"""


@query(
    _gold_sql(
        f"""
, gaps as (
  select *, concat_ws(', ', {REASONS_SQL}, case when avg_income_index is null then 'avg_income_index: missing' end,
                      case when density_val is null then 'density_val: missing' end) as reasons from gold)
select property_id, case when reasons = '' then 'scored' else 'rejected' end as outcome, reasons,
       case when reasons = '' then true end as ordered
from gaps"""
    ),
    GOLD_VIEWS,
)
def score_or_reject(t):
    """Gold listings as requests with gaps through the forest: each is scored, or rejected with its reasons."""
    rows, trained = _forest(t)
    scored, rejected = models.score_or_reject(_with_gaps(rows), trained.model, trained.run["rmse"])
    nothing = F.lit(None).cast("boolean")
    return scored.select(KEY, F.lit("scored").alias("outcome"), F.lit("").alias("reasons"), _ordered().alias("ordered")).union(
        rejected.select(KEY, F.lit("rejected"), F.array_join("reasons", ", "), nothing)
    )


def _event_drop(t):
    return (
        t.spark.readStream.schema(t.table("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(t.sf_dir)
    )


@query(
    """
select event_id, user_id, event_type, value, 'events.parquet' as source_name from events
"""
)
def stream_ingest(t):
    """Incremental ingest of the events drop, read back from bronze."""
    path, checkpoint = staging_path(t.spark, "bronze"), staging_path(t.spark, "checkpoint")
    ingest_plan.ingest(files.with_lineage(_event_drop(t)), path, checkpoint).awaitTermination()
    bronze = files.read_bronze(t.spark, path)
    name = files.file_name(F.col("source_file"))
    return bronze.select("event_id", "user_id", "event_type", "value", name.alias("source_name"))


@query(
    """
select user_id, event_id, event_type, value from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events
  where user_id is not null) e
where rn = 1
"""
)
def stream_upsert(t):
    """The latest event of every user, kept up by keyed merges."""
    table = SilverTable(t.spark, staging_path(t.spark, "silver-users"), ["user_id"])
    rows = _event_drop(t).select("user_id", "event_id", "event_type", "value", "ts")
    newest = [F.desc("ts"), F.desc("event_id")]
    upsert_plan.upsert(rows, table, newest, staging_path(t.spark, "checkpoint")).awaitTermination()
    return table.read().select("user_id", "event_id", "event_type", "value")


@query(
    _gold_sql(
        LINE_SQL
        + f"""
, gaps as (select property_id, {REASONS_SQL} as reasons from gold)
select property_id, coalesce(reasons, '') as reasons, {", ".join(f"case when reasons is null then round({c}) end as {c}" for c in PRICED_COLUMNS)}
from gaps join priced using (property_id)"""
    ),
    GOLD_VIEWS,
)
def stream_score(t):
    """Gold listings with gaps as a stream of requests: responses and rejected requests of all batches."""
    rows, trained = _line(t)
    source = staging_path(t.spark, "requests")
    _with_gaps(rows).write.parquet(source)
    requests = t.spark.readStream.schema(rows.schema).parquet(source)
    out, checkpoint = staging_path(t.spark, "valued"), staging_path(t.spark, "checkpoint")
    scoring.score_stream(requests, trained.model, trained.run["rmse"], out, checkpoint).awaitTermination()
    scored = scoring.read_output(t.spark, out, scoring.RESPONSES)
    rejected = scoring.read_output(t.spark, out, scoring.REJECTED)
    nothing = [F.lit(None).cast("double").alias(c) for c in PRICED_COLUMNS]
    return scored.withColumns(_whole_euros(scored)).select(KEY, F.lit("").alias("reasons"), *PRICED_COLUMNS).union(
        rejected.select(KEY, F.array_join("reasons", ", "), *nothing)
    )
