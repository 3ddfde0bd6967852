"""Join, merge and aggregation queries."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from estatelake.functions.numbers import mean_of
from estatelake.operators import areas, cleaning, enrichment, merging, metrics, sampling
from estatelake.operators.fingerprint import fingerprint as table_fingerprint
from estatelake.sources.silver import DuplicateKeys, SilverTable
from estatelake.staging import stage, staging_path
from workload.registry import query
from workload.views import NEWEST_SQL, newest_first

@query(
    """
select l.property_id, l.neighborhood, k.neighborhood_id, l.price
from listings l left join short_lookup k on l.neighborhood = k.neighborhood
""",
    "listings lookup short_lookup",
)
def lookup_left(t):
    return cleaning.with_area_id(t.listings, t.short_lookup).select(
        "property_id", "neighborhood", "neighborhood_id", "price"
    )


@query(
    """
select i.area_name, i.year, i.income, k.neighborhood_id
from income_raw i left join short_lookup k on i.area_name = k.neighborhood
""",
    "lookup short_lookup income_raw",
)
def lookup_left_named(t):
    return cleaning.with_area_id(t.income_raw, t.short_lookup, "area_name")


@query(
    """
select neighborhood, count(*) as n_rows from listings
where neighborhood not in (select neighborhood from short_lookup)
group by neighborhood
""",
    "listings lookup short_lookup",
)
def lookup_misses(t):
    return cleaning.lookup_misses(t.listings, t.short_lookup)


def _keyed(t):
    return cleaning.with_area_id(
        t.listings.select("property_id", "neighborhood", "data_year", "price"), t.lookup
    ).withColumnRenamed("data_year", "year")


@query(
    """
select l.property_id, l.price, k.neighborhood_id, l.data_year as year, i.income as avg_income_index
from listings l join lookup k on l.neighborhood = k.neighborhood
join income_year i on k.neighborhood_id = i.neighborhood_id and l.data_year = i.year
""",
    "listings lookup income_raw income_rows income_year",
    rounded="avg_income_index",
)
def enrich_inner(t):
    index = stage(enrichment.income_index(t.income_rows), "income-index")
    return enrichment.enrich(_keyed(t), index, "inner").select(
        "property_id", "price", "neighborhood_id", "year", "avg_income_index"
    )


@query(
    """
select l.property_id, l.price, k.neighborhood_id, l.data_year as year, d.density_val
from listings l left join lookup k on l.neighborhood = k.neighborhood
left join density_year d on k.neighborhood_id = d.neighborhood_id and l.data_year = d.year
""",
    "listings lookup density_raw density_rows density_year",
    rounded="density_val",
)
def enrich_left(t):
    yearly = enrichment.density_max(_density_by_area_year(t))
    return enrichment.enrich(_keyed(t), stage(yearly, "density"), "left").select(
        "property_id", "price", "neighborhood_id", "year", "density_val"
    )


def _income_by_area_year(t):
    return enrichment.income_index(t.income_rows).withColumnRenamed("avg_income_index", "income")


def _density_by_area_year(t):
    return t.density_rows.groupBy("neighborhood_id", "year").agg(
        mean_of("density_val").alias("density_val")
    )


def measures(t):
    income = areas.latest_measure(_income_by_area_year(t), "neighborhood_id", "income")
    density = areas.latest_measure(_density_by_area_year(t), "neighborhood_id", "density_val")
    return areas.merge_measures(income, density, "neighborhood_id")


MEASURES_SQL = """
with li as (select neighborhood_id, income from (select *, row_number() over (partition by neighborhood_id order by year desc) as rn from income_year) y where rn = 1),
ld as (select neighborhood_id, density_val from (select *, row_number() over (partition by neighborhood_id order by year desc) as rn from density_year) y where rn = 1),
measures as (
  select coalesce(li.neighborhood_id, ld.neighborhood_id) as neighborhood_id, income, density_val
  from li full outer join ld on li.neighborhood_id = ld.neighborhood_id)
"""
MEASURE_VIEWS = "listings lookup income_raw density_raw income_rows density_rows income_year density_year"


@query(MEASURES_SQL + "select neighborhood_id, income, density_val from measures", MEASURE_VIEWS, rounded="income density_val")
def merge_measures(t):
    return measures(t)


@query(
    MEASURES_SQL
    + """
, districts as (
  select district, avg(income) as income,
         avg(density_val) as density_val
  from measures join lookup using (neighborhood_id) where income > 0 group by district),
city as (
  select avg(income) as income,
         avg(density_val) as density_val
  from measures where income > 0),
asked as (
  select l.property_id, k.neighborhood_id,
         case when l.bathrooms = 7 then 'elsewhere' else l.district end as district
  from listings l left join lookup k on l.neighborhood = k.neighborhood)
select a.property_id,
       round(case when m.income > 0 then m.income when d.income is not null then d.income else (select income from city) end, 6) as avg_income_index,
       round(case when m.income > 0 then coalesce(m.density_val, (select density_val from city))
            when d.income is not null then d.density_val else (select density_val from city) end, 6) as density_val,
       case when m.income > 0 then 'neighborhood' when d.income is not null then 'district' else 'city' end as measure_source
from asked a left join measures m on a.neighborhood_id = m.neighborhood_id
left join districts d on a.district = d.district
""",
    MEASURE_VIEWS,
)
def fallback_lookup(t):
    merged = stage(measures(t), "measures")
    districts = stage(areas.district_means(merged, t.lookup), "districts")
    asked = cleaning.with_area_id(t.listings, t.lookup).withColumn(
        "district", F.when(F.col("bathrooms") == 7, "elsewhere").otherwise(F.col("district"))
    )
    found = areas.with_area_measures(
        asked.select("property_id", "neighborhood_id", "district"), merged, districts
    )
    return found.select(
        "property_id",
        F.round("avg_income_index", 6).alias("avg_income_index"),
        F.round("density_val", 6).alias("density_val"),
        "measure_source",
    )


UPSERT_SQL = f"""
with old_rows as (
  select * from (select *, row_number() over (partition by property_id order by {NEWEST_SQL}) as rn
                 from listings where seen_at < timestamp '1999-01-01') r where rn = 1),
new_rows as (
  select * from (select *, row_number() over (partition by property_id order by {NEWEST_SQL}) as rn
                 from listings where seen_at >= timestamp '1999-01-01') r where rn = 1)
select coalesce(o.property_id, n.property_id) as property_id,
       case when n.property_id is not null then n.price else o.price end as price,
       case when n.property_id is not null then n.hasLift else o.hasLift end as hasLift,
       o.municipality, n.status
from old_rows o full outer join new_rows n on o.property_id = n.property_id
"""


def _before_and_after(listings):
    """Listings seen before a date, and those seen later."""
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    return listings.where(F.col("seen_at") < cut), listings.where(F.col("seen_at") >= cut)


@query(UPSERT_SQL, "listings")
def upsert_merge(t):
    key = ["property_id"]
    old, new = [cleaning.latest_per_key(p, key, newest_first()) for p in _before_and_after(t.listings)]
    return merging.merge_by_key(
        old.select("property_id", "price", "hasLift", "municipality"),
        new.select("property_id", "price", "hasLift", "status"),
        key,
    )


@query(UPSERT_SQL, "listings")
def silver_upsert(t):
    """The same merge through a versioned silver table, one batch after the other."""
    table = SilverTable(t.spark, staging_path(t.spark, "silver"), ["property_id"])
    old, new = _before_and_after(stage(t.listings, "listings", compression="zstd"))
    table.upsert(old.drop("status"), newest_first(), written=True)
    table.upsert(new.drop("municipality"), newest_first(), written=True)
    return table.read().select("property_id", "price", "hasLift", "municipality", "status")


@query("select property_id, price, hasLift, data_year from newest", "listings newest")
def silver_two_writers(t):
    """Two writers merge their halves of the listings into one table at the same time, batch by batch."""
    path = staging_path(t.spark, "silver")
    listings = stage(t.listings, "listings", compression="zstd")

    def write(half):
        table = SilverTable(t.spark, path, ["property_id"], unique=True)
        rows = listings.where(F.col("data_year") % 2 == half)
        for batch in (rows.where("rooms < 25"), rows.where("rooms >= 25")):
            table.upsert(batch, newest_first(), written=True)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, (0, 1)))
    return SilverTable(t.spark, path, ["property_id"]).read().select("property_id", "price", "hasLift", "data_year")


@query(
    """
select property_id, count(*) as n_rows, true as refused, cast(1 as int) as version
from listings where rooms = 7 group by property_id having count(*) > 1
""",
    "listings",
)
def silver_unique(t):
    """Keys that a batch repeats: a plain table reports them, a table of unique keys refuses the batch and keeps its version."""
    plain, unique = (SilverTable(t.spark, staging_path(t.spark, "silver"), ["property_id"], unique=u) for u in (False, True))
    listings = stage(t.listings.where("rooms < 3 or rooms = 7"), "listings", compression="zstd")
    unique.upsert(listings.where("rooms < 3"), newest_first(), written=True)
    batch, refused = listings.where("rooms = 7"), False
    plain.publish(batch)
    try:
        unique.publish(batch)
    except DuplicateKeys:
        refused = True
    return plain.duplicates().select("property_id", "n_rows", F.lit(refused).alias("refused"), F.lit(unique.versions()[-1]).alias("version"))


@query(
    """
select property_id, price, case when status = 'F' then size end as size,
       case when status = 'O' then district end as district
from listings
""",
    "listings",
)
def union_parts(t):
    first = t.listings.where("status = 'F'").select("property_id", "price", "size")
    second = t.listings.where("status = 'O'").select("district", "price", "property_id")
    return merging.union_parts([first, second]).select("property_id", "price", "size", "district")


@query(
    """
select neighborhood_id, year, min(area_name) as neighborhood_name,
       avg(income) as income
from income_rows group by neighborhood_id, year
""",
    "lookup income_raw income_rows",
    rounded="income",
)
def income_by_area_year(t):
    named = t.income_rows.withColumnRenamed("area_name", "neighborhood_name")
    return cleaning.mean_by_area_year(named, "income", ["neighborhood_name"])


@query(
    "select * from density_year",
    "lookup density_raw density_rows density_year",
    rounded="density_val",
)
def density_by_area_year(t):
    return _density_by_area_year(t)


@query(
    """
select neighborhood_id, year, max(density_val) as density_val from density_rows
where density_val is not null group by neighborhood_id, year
""",
    "lookup density_raw density_rows",
)
def density_max(t):
    return enrichment.density_max(t.density_rows)


@query(
    "select neighborhood_id, year, income as avg_income_index from income_year",
    "lookup income_raw income_rows income_year",
    rounded="avg_income_index",
)
def income_index(t):
    return enrichment.income_index(t.income_rows)


@query(
    "select distinct district, neighborhood from listings order by district, neighborhood",
    "listings",
)
def area_catalog(t):
    return areas.area_catalog(t.listings)


@query(
    """
select neighborhood_id, income from (select *, row_number() over (partition by neighborhood_id order by year desc) as rn from income_year) y where rn = 1
""",
    "lookup income_raw income_rows income_year",
    rounded="income",
)
def latest_measure(t):
    return areas.latest_measure(_income_by_area_year(t), "neighborhood_id", "income")


@query(
    """
select count(*) as n_rows,
       cast(sum(('0x' || substr(md5(concat(
         coalesce(length(cast(o_orderkey as string)) || ':' || cast(o_orderkey as string), '~'),
         coalesce(length(cast(o_custkey as string)) || ':' || cast(o_custkey as string), '~'),
         coalesce(length(o_orderstatus) || ':' || o_orderstatus, '~'),
         coalesce(length(case when o_orderpriority <> '5-LOW' then o_orderpriority end) || ':' || case when o_orderpriority <> '5-LOW' then o_orderpriority end, '~'),
         coalesce(length(cast(cast(o_orderdate as date) as string)) || ':' || cast(cast(o_orderdate as date) as string), '~'))), 1, 12))::hugeint) as decimal(30,0)) as content_sum
from orders
"""
)
def fingerprint(t):
    orders = t.table("orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    return table_fingerprint(orders)


HASH_SPLIT_SQL = (
    "case when ('0x' || substr(md5(property_id), 1, 8))::bigint % 100 < 80 then 'train' else 'test' end"
)


@query(
    f"""
select split, count(*) as n_rows, count(*) * 100.0 / sum(count(*)) over () as percent
from (select {HASH_SPLIT_SQL} as split from listings) s group by split
""",
    "listings",
)
def split_shares(t):
    return sampling.split_shares(sampling.with_split(t.listings, "property_id"))


@query(
    """
select model, round(min(prediction), 6) as pred_min, round(max(prediction), 6) as pred_max,
       round(avg(prediction), 6) as pred_mean
from scored group by model
""",
    "listings scored",
)
def prediction_stats(t):
    found = metrics.prediction_stats(t.scored, "prediction", ["model"])
    return found.select(
        "model", *[F.round(c, 6).alias(c) for c in ("pred_min", "pred_max", "pred_mean")]
    )
