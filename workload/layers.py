"""Layer queries: what is written by a sink is read back by its reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from estatelake import schemas
from estatelake.folders import copy_file, create_if_absent, folder_names
from estatelake.functions.names import file_name
from estatelake.functions.numbers import half_even, not_negative
from estatelake.operators import sampling
from estatelake.operators.encoding import standardize
from estatelake.plans import medallion
from estatelake.sources import files, outputs
from estatelake.sources.silver import SilverTable
from estatelake.staging import stage, staging_path
from estatelake.streaming import ingest as streaming_ingest
from workload.evaluation import GOLD_SQL, gold
from workload.joins import HASH_SPLIT_SQL
from workload.registry import query
from workload.views import DROP, newest_first

# Rows of one multi-line JSON document, about.
DOCUMENT_ROWS = 100_000
GOLD_VIEWS = (
    "listings newest lookup silver income_raw density_raw income_rows density_rows income_year density_year"
)


@query(
    """
select 'rejected' as side, count(*) as n_rows, round(sum(price), 2) as total from listings where bathrooms = 4
union all
select 'accepted', count(*), round(sum(price), 2) from newest where bathrooms <> 4
""",
    "listings newest",
)
def null_key_quarantine(t):
    """Listings of which some have no id: quarantine holds every one of these, silver the newest of each other."""
    rows = t.listings.withColumn("property_id", F.when(F.col("bathrooms") != 4, F.col("property_id")))
    table = SilverTable(t.spark, staging_path(t.spark, "silver"), ["property_id"])
    table.upsert(rows, newest_first())
    sides = [
        part.select(F.lit(side).alias("side"), "price")
        for side, part in (("accepted", table.read()), ("rejected", table.read_rejected()))
    ]
    return sides[0].union(sides[1]).groupBy("side").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("price"), 2).alias("total"))


@query(
    """
select cast(year as string) as "Any", area_name as "Nom_Barri", count(*) as n_rows, sum(density_val) as total
from density_raw where density_val is not null group by 1, 2
""",
    "density_raw",
    rounded="total",
)
def ingest_density(t):
    """Multi-line JSON documents of each area, of bounded size, through batch ingest that runs twice and is reset once."""
    base = staging_path(t.spark, "drop")
    raw = t.density_raw.where("density_val is not null").select(
        F.col("year").cast("string").alias("Any"),
        F.col("area_name").alias("Nom_Barri"),
        F.col("density_val").cast("string").alias("Densitat (hab/ha)"),
    )
    raw = stage(raw, "raw-density")
    per_area = raw.groupBy("Nom_Barri").count().agg(F.max("count")).first()[0] or 0
    share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, -(-per_area // DOCUMENT_ROWS))))
    records = F.to_json(F.collect_list(F.struct("Any", "Nom_Barri", "`Densitat (hab/ha)`")))
    shares = raw.withColumn("share", share).groupBy("Nom_Barri", "share")
    documents = shares.agg(F.replace(records, F.lit("},"), F.lit("},\n")).alias("value"))
    documents = documents.select("value", F.col("Nom_Barri").alias("area"))
    # A file is one document: the multi-line reader stops after the first.
    documents.write.option("maxRecordsPerFile", 1).partitionBy("area").text(f"{base}/raw")
    for reset in (False, False, True):
        medallion.ingest(t.spark, "density", f"{base}/raw/*/*.txt", f"{base}/bronze", f"{base}/manifest", reset)
    bronze = files.read_bronze(t.spark, f"{base}/bronze")
    value = F.col("`Densitat (hab/ha)`").cast("double")
    return bronze.groupBy("Any", "Nom_Barri").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(value).alias("total"))


@query("select district, neighborhood, cast(neighborhood_id as string) as neighborhood_id from lookup", "lookup")
def lookup_csv(t):
    """The lookup as one headed CSV file, read back with its declared columns."""
    path = staging_path(t.spark, "lookup")
    names = [f.name for f in schemas.AREA_LOOKUP.fields]
    known = {c: F.col(c) for c in ("district", "neighborhood", "neighborhood_id")}
    rows = t.lookup.select(*[known.get(n, F.lit("-")).cast("string").alias(n) for n in names])
    outputs.write_csv(rows, path, one_file=True)
    return files.read_lookup(t.spark, path).select("district", "neighborhood", "neighborhood_id")


@query(
    "select * exclude (property_id), '2024-01-31' as run_date from (" + GOLD_SQL + ") g",
    GOLD_VIEWS,
    rounded="avg_income_index density_val",
)
def published_gold(t):
    """Gold as it is published: without the key, under its execution date, beside an older date."""
    path = staging_path(t.spark, "gold")
    full = stage(gold(t), "gold")
    columns = [f.name for f in schemas.GOLD.fields]
    rows = medallion.published_gold(full, "2024-01-30")
    rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in columns])
    kinds = {f.name: f.dataType for f in schemas.GOLD.fields}
    rows = rows.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns])
    outputs.write_gold(rows.limit(10), path)
    outputs.write_gold(rows.withColumn("pipeline_execution_date", F.lit("2024-01-31")), path, keep_other_dates=True)
    found = files.read_gold(t.spark, path).where("pipeline_execution_date > '2024-01-30'")
    return found.select(
        "neighborhood", "district", "propertyType", "rooms", "bathrooms", "price", "size", "price_m2",
        "avg_income_index", "density_val", "hasLift", F.col("pipeline_execution_date").cast("string").alias("run_date"),
    )


@query(
    """
select property_id, size, rooms, neighborhood, price as ref from listings
""",
    "listings",
)
def read_requests(t):
    """Requests written as JSON, read with their declared types and a column to pass through."""
    path = staging_path(t.spark, "requests")
    t.listings.select("property_id", "size", "rooms", "neighborhood", F.col("price").alias("ref")).write.options(**DROP).json(path)
    found = files.read_requests(t.spark, path, extra="property_id string, ref double")
    return found.select("property_id", "size", "rooms", "neighborhood", "ref")


@query(
    """
with eighths as (select property_id, greatest(0, cast(size as bigint) - 25) as n from listings),
cents as (select property_id, n * 25 // 2 as q, n * 25 % 2 as half from eighths)
select property_id, (q + half * (q % 2)) / 100.0 as money from cents
""",
    "listings",
)
def money_rounding(t):
    """Amounts below zero become zero, the others are rounded half to even."""
    money = half_even(not_negative(F.col("size") - 25) / 8, 2)
    return t.listings.select("property_id", money.alias("money"))


@query(
    f"""
with parts as (select *, {HASH_SPLIT_SQL} as split from listings),
fitted as (select avg(size) as m, stddev_samp(size) as s from parts where split = 'train')
select property_id, split, (size - m) / s as size_z from parts cross join fitted
""",
    "listings",
    rounded="size_z",
)
def standardize_both(t):
    """Scaling fitted on the train part, applied to both parts."""
    parts = stage(sampling.with_split(t.listings.select("property_id", "size"), "property_id"), "parts")
    scaled = standardize(parts, ["size"], fit_on=parts.where("split = 'train'"))
    return scaled.select("property_id", "split", F.col("size").alias("size_z"))


@query("select property_id, price, status as rating, cast(rooms as bigint) as agency, rooms > 40 as has_more from listings", "listings")
def rescued_fields(t):
    """Fields of JSON listings that no schema names, read back from bronze."""
    base = staging_path(t.spark, "drop")
    more = F.when(F.col("rooms") > 40, F.array(F.lit("pool"), F.lit("garden")))
    raw = t.listings.select(
        F.col("property_id").alias("propertyCode"), "price", F.col("status").alias("energyRating"),
        F.struct(F.col("rooms").alias("id"), F.lit("x").alias("name")).alias("agency"), more.alias("extras"),
    )
    raw.write.options(**DROP).json(f"{base}/raw")
    medallion.ingest(t.spark, "listings", f"{base}/raw/*.json.gz", f"{base}/bronze", f"{base}/manifest")

    def rescued(path, kind):
        return F.try_variant_get(files.RESCUED, path, kind)

    return files.read_bronze(t.spark, f"{base}/bronze").select(
        F.col("propertyCode").alias("property_id"), "price", rescued("$.energyRating", "string").alias("rating"),
        rescued("$.agency.id", "bigint").alias("agency"), rescued("$.extras[1]", "string").isNotNull().alias("has_more"),
    )


@query(
    """
select 'part-broken.parquet' as part, 'unreadable' as reason, (select count(*) from listings) as rows_read
union all select 'part-none.parquet', 'empty', (select count(*) from listings)
""",
    "listings",
)
def skipped_parts(t):
    """A snapshot with a truncated part and an empty one: both are named, all other rows are read."""
    path = staging_path(t.spark, "snapshot")
    t.listings.select("property_id", "price").write.parquet(f"{path}/seen_at=2024-01-31")
    empty = staging_path(t.spark, "empty")
    t.listings.select("property_id", "price").limit(0).coalesce(1).write.parquet(empty)
    (part,) = [n for n in folder_names(t.spark, empty) if n.endswith(".parquet")]
    copy_file(t.spark, f"{empty}/{part}", f"{path}/seen_at=2024-01-31/part-none.parquet")
    create_if_absent(t.spark, f"{path}/seen_at=2024-01-31/part-broken.parquet", "PAR1 and no more")
    read = files.latest_partition(t.spark, path, "seen_at").count()
    skipped = files.skipped_parts(t.spark, f"{path}/seen_at=2024-01-31")
    return skipped.select(file_name(F.col("path")).alias("part"), "reason", F.lit(read).alias("rows_read"))


@query(
    """
select cast(year as string) as "Any", area_name as "Nom_Barri", count(*) as n_rows, sum(cast(income as decimal(18, 2))) as total
from income_raw where income is not null group by 1, 2
""",
    "income_raw",
)
def stream_csv_headers(t):
    """Two CSV drops with their columns in another order, through the stream that goes by header."""
    base = staging_path(t.spark, "drop")
    known = {"Any": F.col("year"), "Nom_Barri": F.col("area_name"), "Import_Euros": F.col("income").cast("decimal(18,2)")}
    names = [f.name for f in schemas.INCOME_RAW.fields]
    rows = t.income_raw.where("income is not null")
    for half, order in enumerate((names, names[::-1])):
        part = rows.where(F.col("year") % 2 == half).select(*[known.get(n, F.lit("-")).cast("string").alias(n) for n in order])
        part.write.mode("append").option("header", "true").csv(f"{base}/raw")
    streaming_ingest.ingest_csv(t.spark, "income", f"{base}/raw", f"{base}/bronze", f"{base}/checkpoint").awaitTermination()
    bronze = files.read_bronze(t.spark, f"{base}/bronze")
    total = F.sum(F.col("Import_Euros").cast("decimal(18,2)")).alias("total")
    return bronze.groupBy("Any", "Nom_Barri").agg(F.count(F.lit(1)).alias("n_rows"), total)
