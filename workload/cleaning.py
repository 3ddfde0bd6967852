"""Cleaning, filtering and source queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from estatelake.functions import names
from estatelake.functions.numbers import ratio
from estatelake.operators import cleaning, outliers, requests
from estatelake.plans import medallion
from estatelake.sources import files, outputs
from estatelake.staging import stage, staging_path
from workload.registry import query
from workload.views import DROP, newest_first


def _bronze(t):
    """Listings under the raw field names, some values unparsable text."""
    return t.listings.withColumns(
        {
            "propertyCode": F.col("property_id"),
            "latitude": F.col("tie_3"),
            "longitude": F.col("tie_4"),
            "exterior": F.col("status") == "O",
            "distance": F.when(F.col("bathrooms") == 7, "n/a").otherwise(F.col("size").cast("string")),
            "data_year": F.col("data_year").cast("string"),
        }
    ).drop("property_id")


@query(
    """
select property_id, propertyType, price, size, rooms, bathrooms, municipality, neighborhood, neighborhood_id,
       district, tie_3 as latitude, tie_4 as longitude, hasLift, status = 'O' as exterior, status,
       case when bathrooms <> 7 then size end as distance, data_year
from silver
""",
    "listings newest lookup silver",
)
def clean_listings(t):
    return cleaning.clean_listings(_bronze(t), t.lookup, newest_first())


@query(
    """
with raw as (
  select cast(year(o_orderdate) as int) as year, cast(r_regionkey as string) as district_id, r_name as district_name,
         cast(n_nationkey as string) as neighborhood_id_old, n_name as neighborhood_name,
         case when o_orderstatus <> 'P' then o_totalprice end as income
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey)
select k.neighborhood_id, year, min(district_id) as district_id, min(district_name) as district_name,
       min(neighborhood_id_old) as neighborhood_id_old, min(neighborhood_name) as neighborhood_name,
       avg(income) as income
from raw join lookup k on neighborhood_name = k.neighborhood
where year in (select data_year from listings where propertyType = 'PROMO')
group by k.neighborhood_id, year
""",
    "listings lookup",
    rounded="income",
)
def clean_income(t):
    raw = (
        t.table("orders")
        .join(t.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.located_nations(), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.year("o_orderdate").cast("string").alias("Any"),
            F.col("r_regionkey").cast("string").alias("Codi_Districte"),
            F.col("r_name").alias("Nom_Districte"),
            F.col("n_nationkey").cast("string").alias("Codi_Barri"),
            F.col("n_name").alias("Nom_Barri"),
            F.when(F.col("o_orderstatus") == "P", "not given")
            .otherwise(F.col("o_totalprice").cast("string"))
            .alias("Import_Euros"),
        )
    )
    years = cleaning.listing_years(cleaning.in_segment(t.listings, "propertyType", "PROMO"))
    return cleaning.clean_income(raw, t.lookup, stage(years, "years"))


@query(
    """
select neighborhood_id, year, density_val from density_year
where year in (select data_year from listings)
""",
    "listings lookup density_raw density_rows density_year",
    rounded="density_val",
)
def clean_density(t):
    raw = t.density_raw.select(
        F.col("year").cast("string").alias("Any"),
        F.col("area_name").alias("Nom_Barri"),
        F.col("density_val").cast("string").alias("Densitat (hab/ha)"),
    )
    years = stage(cleaning.listing_years(t.listings), "years")
    return cleaning.clean_density(raw, t.lookup, years)


@query(
    """
select o_orderkey, case when o_orderstatus <> 'P' then cast(year(o_orderdate) as int) end as data_year
from orders
"""
)
def filename_year(t):
    stamp = F.date_format("o_orderdate", "yyyy_MM_dd")
    path = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("drop/notes_"), stamp)).otherwise(
        F.concat(F.lit("drop/"), stamp, F.lit("_market.json"))
    )
    named = t.table("orders").select("o_orderkey", path.alias("path"))
    year = names.file_year(names.file_name(F.col("path")), "market")
    return named.select("o_orderkey", year.alias("data_year"))


@query(
    """
select o_orderkey as order_key, o_totalprice as total_price_eur, o_orderpriority as urgencyclass
from orders
"""
)
def sanitize_columns(t):
    return names.sanitize_columns(
        t.table("orders").select(
            F.col("o_orderkey").alias("order key"),
            F.col("o_totalprice").alias("total price (eur)"),
            F.col("o_orderpriority").alias("urgency=class."),
        )
    )


@query(
    """
select o_orderkey, cast(cast(o_orderdate as date) as timestamp) as order_day,
       cast(cast(o_orderdate as date) + 30 as timestamp) as due_day
from orders
"""
)
def date_to_ts(t):
    day = F.col("o_orderdate").cast("date")
    return cleaning.date_columns_to_timestamps(
        t.table("orders").select(
            "o_orderkey", day.alias("order_day"), F.date_add(day, 30).alias("due_day")
        )
    )


@query(
    """
select property_id, price, size, rooms, bathrooms, municipality, neighborhood, district, propertyType,
       hasLift, data_year, seen_at
from newest
""",
    "listings newest",
)
def dedup_latest(t):
    return t.newest_listings.select(
        "property_id", "price", "size", "rooms", "bathrooms", "municipality", "neighborhood",
        "district", "propertyType", "hasLift", "data_year", "seen_at",
    )


@query(
    """
select property_id, count(*) as n_rows from listings group by property_id having count(*) > 1
""",
    "listings",
)
def unique_violations(t):
    return cleaning.duplicate_keys(t.listings, ["property_id"])


@query(
    """
select event_id, event_type, value, cast(ts as date) as ingestion_date
from events where cast(ts as date) >= date '2024-01-10'
"""
)
def scan_partitioned(t):
    events = t.table("events").withColumn("ingestion_date", F.col("ts").cast("date"))
    path = staging_path(t.spark, "bronze-events")
    outputs.write_partitioned(events, path, "ingestion_date")
    return files.read_bronze(t.spark, path, since="2024-01-10").select(
        "event_id", "event_type", "value", "ingestion_date"
    )


@query(
    """
select event_id, user_id, event_type, value, cast(ts as date) as snapshot_date
from events where cast(ts as date) = (select max(cast(ts as date)) from events)
"""
)
def latest_snapshot(t):
    events = t.table("events").withColumn("snapshot_date", F.col("ts").cast("date"))
    path = staging_path(t.spark, "snapshots")
    outputs.write_partitioned(events, path, "snapshot_date")
    return files.latest_partition(t.spark, path, "snapshot_date").select(
        "event_id", "user_id", "event_type", "value", "snapshot_date"
    )


@query(
    """
select distinct concat('drop/', strftime(o_orderdate, '%Y_%m_%d'), '_market.json') as path
from orders
where cast(o_orderdate as date) not in
  (select cast(o_orderdate as date) from orders where o_orderstatus = 'F' and o_orderdate is not null)
"""
)
def new_files_anti(t):
    stamp = F.date_format("o_orderdate", "yyyy_MM_dd")
    path = F.concat(F.lit("drop/"), stamp, F.lit("_market.json")).alias("path")
    orders = t.table("orders")
    found = orders.select(path)
    manifest = orders.where("o_orderstatus = 'F'").select(path).distinct()
    return files.unprocessed(found, manifest)


@query(
    """
select area_name, year, income from income_raw
where year in (select data_year from listings where seen_at < timestamp '1998-01-01')
""",
    "listings income_raw",
)
def years_semi(t):
    early = t.listings.where(F.col("seen_at") < F.lit("1998-01-01").cast("timestamp_ntz"))
    years = stage(cleaning.listing_years(early), "years")
    return cleaning.in_years(t.income_raw, years).select("area_name", "year", "income")


@query(
    """
select property_id, neighborhood_id, data_year, hasLift from silver
where neighborhood_id is not null and data_year is not null and hasLift is not null
""",
    "listings newest lookup silver",
)
def nonnull_keys(t):
    listings = cleaning.with_area_id(t.newest_listings, t.lookup)
    complete, _ = cleaning.split_null_keys(listings, ["neighborhood_id", "data_year", "hasLift"])
    return complete.select("property_id", "neighborhood_id", "data_year", "hasLift")


@query(
    "select property_id, municipality, price from listings where municipality = 'BUILDING'",
    "listings",
)
def segment_filter(t):
    segment = cleaning.in_segment(t.listings, "municipality", "BUILDING")
    return segment.select("property_id", "municipality", "price")


@query(
    "select property_id, size, price from gaps where size > 15 and price > 10000",
    "listings gaps",
)
def sanity_filter(t):
    return t.listings_with_gaps.where(outliers.plausible()).select("property_id", "size", "price")


PRICED_SQL = """
with priced as (
  select property_id, price, size, price / size as price_m2 from listings where size > 15 and price > 10000),
q as (select quantile_cont(price_m2, 0.25) as q1, quantile_cont(price_m2, 0.75) as q3 from priced)
"""


def _priced(t):
    listings = t.listings.select("property_id", "price", "size").where(outliers.plausible())
    return stage(listings.withColumn("price_m2", ratio("price", "size")), "priced")


@query(
    PRICED_SQL
    + """
select round(q1, 6) as q1, round(q3, 6) as q3, round(q1 - 1.5 * (q3 - q1), 6) as lower_bound,
       round(q3 + 1.5 * (q3 - q1), 6) as upper_bound
from q
""",
    "listings",
)
def iqr_bounds(t):
    return _fence_row(t, "exact")


@query(
    PRICED_SQL + "select count(*) as n_rows, true as low_near, true as high_near from priced",
    "listings",
)
def iqr_approx(t):
    """The sketch's quartiles; their ranks are off by at most one in a hundred."""
    priced = _priced(t)
    fences = outliers.iqr_fences(priced, "price_m2", "approx")
    below, upto = (
        [F.avg(F.expr(f"if(price_m2 {op} {q!r}D, 1D, 0D)")) for q in (fences.q1, fences.q3)] for op in ("<", "<=")
    )
    near = [(b <= share + 0.01) & (u >= share - 0.01) for b, u, share in zip(below, upto, (0.25, 0.75))]
    return priced.agg(F.count(F.lit(1)).alias("n_rows"), near[0].alias("low_near"), near[1].alias("high_near"))


def _fence_row(t, mode):
    fences = outliers.iqr_fences(_priced(t), "price_m2", mode)
    values = [fences.q1, fences.q3, fences.lower, fences.upper]
    return t.spark.createDataFrame(
        [tuple(round(v, 6) for v in values)],
        "q1 double, q3 double, lower_bound double, upper_bound double",
    )


@query(
    PRICED_SQL
    + """
select property_id, price, size, price_m2 from priced
where price_m2 >= (select q1 - 1.5 * (q3 - q1) from q) and price_m2 <= (select q3 + 1.5 * (q3 - q1) from q)
""",
    "listings",
)
def iqr_filter(t):
    return outliers.iqr_filter(_priced(t), "price_m2")


@query(
    PRICED_SQL
    + """
, marked as (
  select size > 15 and price > 10000 as sane,
         price / size >= (select q1 - 1.5 * (q3 - q1) from q) and price / size <= (select q3 + 1.5 * (q3 - q1) from q) as inside
  from listings)
select count(*) as n_input, count(*) filter (where not sane) as n_implausible,
       count(*) filter (where sane and not inside) as n_outliers, count(*) filter (where sane and inside) as n_kept
from marked
""",
    "listings",
)
def filter_audit(t):
    everything = stage(
        t.listings.select("price", "size").withColumn("price_m2", ratio("price", "size")), "audited"
    )
    fences = outliers.iqr_fences(everything.where(outliers.plausible()), "price_m2")
    return outliers.filter_audit(everything, "price_m2", fences)


@query(
    """
select property_id, size, try_cast(rooms_text as int) as rooms, bathrooms, price from gaps
where size is not null and try_cast(rooms_text as int) is not null
""",
    "listings gaps",
)
def train_rows(t):
    rows = t.listings_with_gaps.withColumn("rooms", F.col("rooms_text").try_cast("int"))
    columns = ["property_id", "size", "rooms", "bathrooms", "price"]
    return rows.select(*columns).dropna(subset=columns[1:])


def _requests(t):
    """Valuation requests of every listing, some out of range or incomplete."""
    return t.listings.select(
        "property_id",
        (F.col("size") * 50).alias("size"),
        "rooms",
        (F.col("bathrooms") - 1).alias("bathrooms"),
        F.when(F.col("status") == "O", F.col("neighborhood")).otherwise("").alias("neighborhood"),
        F.when(F.col("hasLift").isNotNull(), F.col("propertyType")).alias("propertyType"),
        "district",
        (F.col("price") - 20000).alias("avg_income_index"),
        F.col("tie_3").alias("density_val"),
    )


@query(
    """
with requests as (
  select property_id, size * 50 as size, rooms, bathrooms - 1 as bathrooms,
         case when status = 'O' then neighborhood else '' end as neighborhood,
         case when hasLift is not null then propertyType end as propertyType, district,
         price - 20000 as avg_income_index, tie_3 as density_val
  from listings)
select property_id, concat_ws(',',
  case when size > 0 and size <= 2000 then null else 'size' end,
  case when rooms >= 0 and rooms <= 20 then null else 'rooms' end,
  case when bathrooms >= 1 and bathrooms <= 10 then null else 'bathrooms' end,
  case when length(neighborhood) >= 1 then null else 'neighborhood' end,
  case when propertyType is not null then null else 'propertyType' end,
  case when district is not null then null else 'district' end,
  case when avg_income_index > 0 then null else 'avg_income_index' end,
  case when density_val > 0 then null else 'density_val' end,
  case when propertyType in ('PROMO', 'STANDARD', 'ECONOMY') then null else 'known_type' end) as failed_rules
from requests
""",
    "listings",
)
def validate_rows(t):
    known = requests.allowed_values("known_type", "propertyType", ["PROMO", "STANDARD", "ECONOMY"])
    checked = requests.validate_rows(_requests(t), [*requests.request_rules(), known])
    return checked.select("property_id", F.array_join("failed_rules", ",").alias("failed_rules"))


@query(
    """
select property_id, case when bathrooms = 2 then 0.0 else coalesce(try_cast(size_text as double), 0.0) end as size,
       coalesce(try_cast(rooms_text as int), 0) as rooms, district, neighborhood,
       coalesce(propertyType, 'flat') as propertyType, coalesce(hasLift, true) as has_lift,
       false as has_parking, 100.0::double as avg_income_index
from (select *, case when bathrooms = 4 then 'large' else cast(size as string) end as size_text from gaps) g
""",
    "listings gaps",
)
def request_defaults(t):
    given = t.listings_with_gaps.select(
        "property_id",
        F.when(F.col("bathrooms") == 2, None)
        .when(F.col("bathrooms") == 4, "large")
        .otherwise(F.col("size").cast("string"))
        .alias("size"),
        F.col("rooms_text").alias("rooms"),
        "district",
        "neighborhood",
        "propertyType",
        F.col("hasLift").alias("has_lift"),
    )
    return requests.with_defaults(given).select(
        "property_id", "size", "rooms", "district", "neighborhood", "propertyType", "has_lift",
        "has_parking", "avg_income_index",
    )


@query(
    """
select property_id as propertyCode, propertyType, price, size, cast(rooms as bigint) as rooms, neighborhood,
       district, hasLift, cast(size as string) as distance
from listings
""",
    "listings",
)
def ingest_listings(t):
    """JSON drop of all listings through batch ingest; the second run finds nothing new."""
    base = staging_path(t.spark, "drop")
    raw = _bronze(t).drop("data_year").withColumn("distance", F.col("size").cast("string"))
    raw.write.options(**DROP).json(f"{base}/raw")
    for _ in range(2):
        medallion.ingest(
            t.spark, "listings", f"{base}/raw/*.json.gz", f"{base}/bronze", f"{base}/manifest"
        )
    return files.read_bronze(t.spark, f"{base}/bronze").select(
        "propertyCode", "propertyType", "price", "size", "rooms", "neighborhood", "district", "hasLift", "distance"
    )


@query(
    """
select cast(year(o_orderdate) as string) as "Any", cast(n_nationkey as string) as "Codi_Barri", n_name as "Nom_Barri",
       cast(cast(o_totalprice as decimal(18,2)) as string) as "Import_Euros"
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""
)
def ingest_income(t):
    """CSV drop of all order amounts through batch ingest."""
    base = staging_path(t.spark, "drop")
    (
        t.table("orders")
        .join(t.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.located_nations(), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.year("o_orderdate").alias("Any"),
            F.col("r_regionkey").alias("Codi_Districte"),
            F.col("r_name").alias("Nom_Districte"),
            F.col("n_nationkey").alias("Codi_Barri"),
            F.col("n_name").alias("Nom_Barri"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("Import_Euros"),
        )
        .write.option("header", "true")
        .csv(f"{base}/raw")
    )
    medallion.ingest(t.spark, "income", f"{base}/raw/*.csv", f"{base}/bronze", f"{base}/manifest")
    return files.read_bronze(t.spark, f"{base}/bronze").select(
        "Any", "Codi_Barri", "Nom_Barri", "Import_Euros"
    )


@query(
    """
select property_id, price, size, neighborhood, hasLift from listings
""",
    "listings",
)
def csv_snapshot(t):
    """Two dated CSV snapshots; the later one is read."""
    rows = t.listings.select("property_id", "price", "size", "neighborhood", "hasLift", "status")
    path = staging_path(t.spark, "snapshots")
    outputs.write_dated_csv(rows.where("status = 'O'"), path, "2024-01-01", "status")
    outputs.write_dated_csv(rows, path, "2024-01-02", "status")
    return files.read_dated_csv(t.spark, path, rows.drop("status").schema)
