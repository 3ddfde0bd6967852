"""Imputing, encoding and sampling queries."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from estatelake.functions.numbers import ratio
from estatelake.operators import encoding, imputing, sampling
from estatelake.operators.category_table import CategoryTable
from estatelake.operators.encoding import HASHED_SLOTS, SLOTS
from estatelake.staging import stage, staging_path
from workload.joins import HASH_SPLIT_SQL
from workload.registry import query


@query(
    """
select property_id, price / nullif(size - 1, 0) as price_m2 from listings
""",
    "listings",
)
def price_per_m2(t):
    return t.listings.select(
        "property_id", ratio(F.col("price"), F.col("size") - 1).alias("price_m2")
    )


@query(
    """
select property_id, coalesce(size, (select avg(size) from gaps)) as size,
       coalesce(case when bathrooms <> 6 then price end,
                (select avg(case when bathrooms <> 6 then price end) from gaps)) as price
from gaps
""",
    "listings gaps",
    rounded="size price",
)
def impute_mean(t):
    rows = t.listings_with_gaps.withColumn(
        "price", F.when(F.col("bathrooms") != 6, F.col("price"))
    ).select("property_id", "size", "price")
    return imputing.impute_mean(stage(rows, "with-gaps"), ["size", "price"])


@query(
    """
select property_id, coalesce(size, (select median(size) from gaps)) as size,
       coalesce(try_cast(rooms_text as double),
                (select median(try_cast(rooms_text as double)) from gaps)) as rooms
from gaps
""",
    "listings gaps",
)
def impute_median(t):
    rows = t.listings_with_gaps.select("property_id", "size", F.col("rooms_text").alias("rooms"))
    return imputing.impute_median(stage(rows, "with-gaps"), ["size", "rooms"])


@query(
    f"""
with train as (select * from gaps where {HASH_SPLIT_SQL} = 'train')
select property_id, coalesce(size, (select median(size) from train)) as size,
       coalesce(price, (select median(price) from train)) as price
from gaps
""",
    "listings gaps",
)
def impute_median_train(t):
    """Medians of the train part fill all rows."""
    rows = stage(t.listings_with_gaps.select("property_id", "size", "price"), "with-gaps")
    train = sampling.with_split(rows, "property_id").where("split = 'train'")
    fitted = imputing.medians(train, ["size", "price"])
    return imputing.impute_median(rows, ["size", "price"], fitted)


@query(
    "select property_id, coalesce(hasLift, false) as hasLift from listings",
    "listings",
)
def impute_flag(t):
    return imputing.impute_flag(t.listings.select("property_id", "hasLift"), ["hasLift"])


@query(
    "select property_id, coalesce(propertyType, 'Unknown') as propertyType from gaps",
    "listings gaps",
)
def impute_unknown(t):
    rows = t.listings_with_gaps.select("property_id", "propertyType")
    return imputing.impute_unknown(rows, ["propertyType"])


@query(
    """
with classes as (
  select category, cast(row_number() over (order by category) - 1 as int) as idx
  from (select distinct propertyType as category from gaps where propertyType is not null
        union select 'Unknown') c)
select property_id, coalesce(c.idx, (select idx from classes where category = 'Unknown')) as type_idx
from gaps left join classes c on propertyType = c.category
""",
    "listings gaps",
)
def label_encode(t):
    rows = t.listings_with_gaps.select("property_id", "propertyType")
    index = encoding.category_index(rows, "propertyType")
    encoded = encoding.encode_with_index(rows, index, "propertyType", "type_idx")
    return encoded.select("property_id", "type_idx")


@query(
    """
with classes as (
  select category, cast(row_number() over (order by category) - 1 as int) as idx
  from (select distinct neighborhood as category from listings where district in ('ASIA', 'EUROPE')
        union select 'Unknown') c)
select property_id, neighborhood, coalesce(c.idx, (select idx from classes where category = 'Unknown')) as area_idx
from listings left join classes c on neighborhood = c.category
""",
    "listings",
)
def label_encode_unseen(t):
    rows = t.listings.select("property_id", "neighborhood", "district")
    seen = rows.where(F.col("district").isin("ASIA", "EUROPE"))
    index = encoding.category_index(seen, "neighborhood")
    encoded = encoding.encode_with_index(rows, index, "neighborhood", "area_idx")
    return encoded.select("property_id", "neighborhood", "area_idx")


@query(
    """
with classes as (
  select category, cast(row_number() over (order by category) - 1 as int) as idx
  from (select distinct neighborhood as category from listings where district in ('ASIA', 'EUROPE')
        union select 'Unknown') c),
ids as (
  select category, cast(row_number() over (order by category) - 1 as int) as idx
  from (select distinct property_id as category from listings where district in ('ASIA', 'EUROPE')
        union select 'Unknown') c)
select property_id, coalesce(c.idx, (select idx from classes where category = 'Unknown')) as area_idx,
       coalesce(i.idx, (select idx from ids where category = 'Unknown')) as id_idx
from listings left join classes c on neighborhood = c.category left join ids i on property_id = i.category
""",
    "listings",
)
def label_encode_saved(t):
    """Category tables of a few and of very many categories, as parts of a model that is saved and loaded."""
    rows = t.listings.select("property_id", "neighborhood", "district")
    seen = rows.where(F.col("district").isin("ASIA", "EUROPE"))
    path = staging_path(t.spark, "model")
    PipelineModel([CategoryTable.fit(seen, ["neighborhood", "property_id"])]).write().save(path)
    encoded = PipelineModel.load(path).transform(rows)
    numbers = {c: F.col(f"{n}_encoded").cast("int").alias(c) for c, n in (("area_idx", "neighborhood"), ("id_idx", "property_id"))}
    return encoded.select("property_id", *numbers.values())


@query(
    f"""
with ranked as (select property_id, row_number() over (order by count(*) desc, property_id) - 1 as rank from listings group by property_id),
sized as (select *, count(*) over () as n from ranked)
select l.property_id, cast(case when n <= {SLOTS} or rank < {SLOTS - HASHED_SLOTS} then rank
       else {SLOTS - HASHED_SLOTS} + ('0x' || substr(md5(l.property_id), 1, 8))::bigint % {HASHED_SLOTS} end as int) as slot
from listings l join sized s on l.property_id = s.property_id
""",
    "listings",
)
def freq_encode_hashed(t):
    """More categories than a tree may have bins: the frequent ones have slots of their own, the others share by hash."""
    rows = stage(t.listings.select("property_id"), "rows")
    encoded = encoding.frequency_index(rows, ["property_id"]).transform(rows)
    return encoded.select("property_id", F.col("property_id_idx").cast("int").alias("slot"))


@query(
    """
with types as (
  select propertyType, cast(row_number() over (order by count(*) desc, propertyType) - 1 as int) as idx
  from gaps where propertyType is not null group by propertyType),
early as (
  select neighborhood, cast(row_number() over (order by count(*) desc, neighborhood) - 1 as int) as idx
  from listings where district in ('ASIA', 'EUROPE') group by neighborhood)
select g.property_id, coalesce(t.idx, (select cast(count(*) as int) from types)) as type_idx,
       coalesce(e.idx, (select cast(count(*) as int) from early)) as area_idx
from gaps g left join types t on g.propertyType = t.propertyType left join early e on g.neighborhood = e.neighborhood
""",
    "listings gaps",
)
def freq_encode(t):
    rows = stage(
        t.listings_with_gaps.select("property_id", "propertyType", "neighborhood", "district"), "rows"
    )
    types = encoding.frequency_index(rows.dropna(subset=["propertyType"]), ["propertyType"])
    areas = encoding.frequency_index(
        rows.where(F.col("district").isin("ASIA", "EUROPE")), ["neighborhood"]
    )
    return areas.transform(types.transform(rows)).select(
        "property_id",
        F.col("propertyType_idx").cast("int").alias("type_idx"),
        F.col("neighborhood_idx").cast("int").alias("area_idx"),
    )


@query(
    """
select property_id, round((size - (select avg(size) from listings)) / (select stddev_samp(size) from listings), 6) as size_z,
       round((price - (select avg(price) from listings)) / (select stddev_samp(price) from listings), 6) as price_z
from listings
""",
    "listings",
)
def standardize(t):
    rows = stage(t.listings.select("property_id", "size", "price"), "rows")
    scaled = encoding.standardize(rows, ["size", "price"])
    return scaled.select(
        "property_id", F.round("size", 6).alias("size_z"), F.round("price", 6).alias("price_z")
    )


@query(
    """
select property_id, round((size - (select avg(size) from listings)) / (select stddev_pop(size) from listings), 6) as size_z
from listings
""",
    "listings",
)
def standardize_population(t):
    rows = stage(t.listings.select("property_id", "size"), "rows")
    return encoding.standardize(rows, ["size"], ddof=0).select(
        "property_id", F.round("size", 6).alias("size_z")
    )


@query(
    """
select district, count(*) as n_rows from gaps
where size is not null and try_cast(rooms_text as int) is not null group by district
""",
    "listings gaps",
)
def assemble_rows(t):
    rows = t.listings_with_gaps.withColumn("rooms", F.col("rooms_text").try_cast("int"))
    assembler = encoding.feature_assembler(["size", "rooms", "bathrooms"], [])
    vectors = assembler.transform(rows.select("district", "size", "rooms", "bathrooms"))
    return vectors.where("features_raw is not null").groupBy("district").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(f"select property_id, price, {HASH_SPLIT_SQL} as split from listings", "listings")
def hash_split(t):
    return sampling.with_split(t.listings.select("property_id", "price"), "property_id")


@query(
    """
select property_id, price from listings
where ('0x' || substr(md5('sample-' || property_id), 1, 8))::bigint % 100 < 50
""",
    "listings",
)
def hash_sample(t):
    return sampling.sample_fraction(t.listings.select("property_id", "price"), "property_id", 50)


@query(
    """
select property_id, price from newest
order by ('0x' || substr(md5('draw-' || property_id), 1, 15))::bigint, property_id limit 5000
""",
    "listings newest",
)
def capped_sample(t):
    return sampling.sample_rows(t.newest_listings.select("property_id", "price"), "property_id", 5000)


@query(
    """
select property_id, cast(('0x' || substr(md5('fold-' || property_id), 1, 8))::bigint % 3 as int) as fold
from listings
""",
    "listings",
)
def kfold_assign(t):
    return sampling.with_fold(t.listings.select("property_id"), "property_id")
