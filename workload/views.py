"""The listings domain expressed over the test tables.

Each view exists twice: as a DataFrame (methods of ``Tables``) and as SQL text
(``VIEWS``) for the independent check.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.functions.numbers import mean_of_parts, total_of
from estatelake.operators import cleaning, metrics
from estatelake.staging import stage


def year_of(column: str) -> Column:
    return F.year(column).cast("int")


# How drops of JSON texts are written: such files are compressed and read by one task each.
DROP = {"compression": "gzip", "maxRecordsPerFile": 250_000}

# Total order of the copies of a listing, newest first.
NEWEST = ["seen_at", "price", "tie_1", "tie_2", "size", "tie_3", "tie_4"]
NEWEST_SQL = ", ".join(f"{c} desc" for c in NEWEST)


def newest_first() -> list[Column]:
    return [F.desc(c) for c in NEWEST]


class Tables:
    """The test tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def located_nations(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    @cached_property
    def listings(self) -> DataFrame:
        """Line items with their order, part and area.

        Orders meet customers before line items, the widest table, which is so dealt out by order and by part
        only; names of areas come last, by their short keys.
        """
        lines = self.table("lineitem").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        ordered = (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "c_mktsegment", "c_nationkey", year_of("o_orderdate").alias("data_year"))
        )
        return (
            lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.located_nations(), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.concat_ws("-", "l_orderkey", "l_linenumber").alias("property_id"),
                F.col("l_extendedprice").alias("price"),
                F.col("l_quantity").alias("size"),
                F.col("p_size").alias("rooms"),
                F.col("l_linenumber").alias("bathrooms"),
                F.col("c_mktsegment").alias("municipality"),
                F.col("n_name").alias("neighborhood"),
                F.col("r_name").alias("district"),
                F.col("p_type").alias("propertyType"),
                F.col("l_linestatus").alias("status"),
                F.when(F.col("l_returnflag") == "A", True)
                .when(F.col("l_returnflag") == "N", False)
                .alias("hasLift"),
                "data_year",
                F.col("l_shipdate").alias("seen_at"),
                F.col("l_partkey").alias("tie_1"),
                F.col("l_suppkey").alias("tie_2"),
                F.col("l_discount").alias("tie_3"),
                F.col("l_tax").alias("tie_4"),
            )
        )

    @cached_property
    def newest_listings(self) -> DataFrame:
        return cleaning.latest_per_key(self.listings, ["property_id"], newest_first())

    @cached_property
    def lookup(self) -> DataFrame:
        return self.located_nations().select(
            F.col("n_name").alias("neighborhood"),
            F.col("n_nationkey").alias("neighborhood_id"),
            F.col("r_name").alias("district"),
        )

    @cached_property
    def short_lookup(self) -> DataFrame:
        """A lookup that lacks an area, for the queries about misses."""
        return self.lookup.where("neighborhood_id <> 13")

    @cached_property
    def income_raw(self) -> DataFrame:
        """Orders as incomes; one area has none."""
        return (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("n_name").alias("area_name"),
                year_of("o_orderdate").alias("year"),
                F.when(F.col("n_nationkey") != 13, F.col("o_totalprice")).alias("income"),
            )
        )

    @cached_property
    def density_raw(self) -> DataFrame:
        """Line items as densities; some areas have none."""
        return (
            self.table("lineitem")
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("n_name").alias("area_name"),
                year_of("l_shipdate").alias("year"),
                F.when(F.col("s_nationkey") % 5 != 0, F.col("l_quantity")).alias("density_val"),
            )
        )

    @cached_property
    def income_rows(self) -> DataFrame:
        return self._with_id(self.income_raw)

    @cached_property
    def density_rows(self) -> DataFrame:
        return self._with_id(self.density_raw)

    def _with_id(self, df: DataFrame) -> DataFrame:
        return cleaning.with_area_id(df, self.lookup, "area_name").dropna(
            subset=["neighborhood_id"]
        )

    @cached_property
    def listings_with_gaps(self) -> DataFrame:
        """Listings with missing sizes, types and unparsable rooms."""
        return self.listings.withColumns(
            {
                "size": F.when(F.col("bathrooms") != 3, F.col("size")),
                "rooms_text": F.when(F.col("bathrooms") == 5, "n/a").otherwise(
                    F.col("rooms").cast("string")
                ),
                "propertyType": F.when(F.col("status") == "O", F.col("propertyType")),
            }
        )

    @cached_property
    def scored(self) -> DataFrame:
        """Three group-mean predictors of the price of every listing.

        One pass sums the price per combination of the group columns, and all
        three means come from those sums.  The means are small written tables,
        so the listings are only probed.
        """
        base = stage(
            self.listings.select("property_id", "district", "neighborhood", "propertyType", "size", "price"),
            "priced",
        )
        sums = stage(
            base.groupBy(*PREDICTORS.values()).agg(
                total_of("price").alias("total"), F.count("price").alias("n")
            ),
            "sums",
        )
        wide = base
        for model, column in PREDICTORS.items():
            mean = mean_of_parts(F.sum("total"), F.sum("n"))
            wide = wide.join(stage(sums.groupBy(column).agg(mean.alias(model)), model), column)
        models = F.array(
            *[F.struct(F.lit(m).alias("model"), F.col(m).alias("prediction")) for m in PREDICTORS]
        )
        return wide.select(
            "property_id", "district", "size", "price", F.explode(models).alias("m")
        ).select("property_id", "district", "size", "price", "m.*")

    @cached_property
    def runs(self) -> DataFrame:
        return metrics.regression_metrics(
            self.scored, "price", "prediction", ["model", "district"], RUN_PLACES
        )


# Each model predicts the mean price of the listings that share this column.
PREDICTORS = {"by_area": "neighborhood", "by_size": "size", "by_type": "propertyType"}

RUN_PLACES = {
    "rmse": 4,
    "r2": 6,
    "mae": 4,
    "mape": 4,
    "residual_mean": 4,
    "residual_std": 4,
}

VIEWS = {
    "listings": """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as property_id,
       l_extendedprice as price, l_quantity as size, p_size as rooms, l_linenumber as bathrooms,
       c_mktsegment as municipality, n_name as neighborhood, r_name as district, p_type as propertyType,
       l_linestatus as status, case l_returnflag when 'A' then true when 'N' then false end as hasLift,
       cast(year(o_orderdate) as int) as data_year, l_shipdate as seen_at,
       l_partkey as tie_1, l_suppkey as tie_2, l_discount as tie_3, l_tax as tie_4
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
join part on l_partkey = p_partkey
""",
    "lookup": """
select n_name as neighborhood, n_nationkey as neighborhood_id, r_name as district
from nation join region on n_regionkey = r_regionkey
""",
    "short_lookup": "select * from lookup where neighborhood_id <> 13",
    "income_raw": """
select n_name as area_name, cast(year(o_orderdate) as int) as year,
       case when n_nationkey <> 13 then o_totalprice end as income
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
""",
    "density_raw": """
select n_name as area_name, cast(year(l_shipdate) as int) as year,
       case when s_nationkey % 5 <> 0 then l_quantity end as density_val
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
""",
    "newest": f"""
select * from (
  select *, row_number() over (partition by property_id order by {NEWEST_SQL}) as rn
  from listings) ranked
where rn = 1
""",
    "silver": """
select n.*, k.neighborhood_id
from newest n left join lookup k on n.neighborhood = k.neighborhood
""",
    "income_rows": """
select i.*, k.neighborhood_id from income_raw i join lookup k on i.area_name = k.neighborhood
""",
    "density_rows": """
select d.*, k.neighborhood_id from density_raw d join lookup k on d.area_name = k.neighborhood
""",
    "income_year": """
select neighborhood_id, year, avg(income) as income
from income_rows group by neighborhood_id, year
""",
    "density_year": """
select neighborhood_id, year, avg(density_val) as density_val
from density_rows group by neighborhood_id, year
""",
    "gaps": """
select property_id, price, case when bathrooms <> 3 then size end as size,
       case when bathrooms = 5 then 'n/a' else cast(rooms as string) end as rooms_text,
       bathrooms, neighborhood, district, hasLift, status,
       case when status = 'O' then propertyType end as propertyType
from listings
""",
    "scored": " union all ".join(
        f"""
select property_id, district, size, price, '{model}' as model,
       avg(price) over (partition by {column}) as prediction
from listings"""
        for model, column in PREDICTORS.items()
    ),
    "target_means": """
select model, district, avg(price) as target_mean from scored group by model, district
""",
    "runs": """
select s.model, s.district, round(sqrt(avg((price-prediction)*(price-prediction))), 4) as rmse,
       round(1 - sum((price-prediction)*(price-prediction)) / sum((price-target_mean)*(price-target_mean)), 6) as r2,
       round(avg(abs(price-prediction)), 4) as mae,
       round(avg(abs((price-prediction)/price)) * 100, 4) as mape,
       round(avg(price-prediction), 4) as residual_mean,
       round(stddev_pop(price-prediction), 4) as residual_std, count(*) as n_samples
from scored s join target_means t on s.model = t.model and s.district = t.district
group by s.model, s.district
""",
}
