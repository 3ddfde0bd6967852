"""Raw drops to gold: ingest, silver tables, gold table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.folders import remove_folder
from estatelake.functions.names import sanitize_columns
from estatelake.operators import cleaning, enrichment, imputing, outliers
from estatelake.sources import files, outputs
from estatelake.sources.silver import SilverTable
from estatelake.staging import stage

# Keys of the silver entities.
SILVER_KEYS = {
    "listings": ["property_id"],
    "income": ["neighborhood_id", "year"],
    "density": ["neighborhood_id", "year"],
}

# What tells the age of a listing; silver keeps it for later batches.
LINEAGE = ["source_file", "ingestion_timestamp"]


def silver_table(spark: SparkSession, root: str, entity: str) -> SilverTable:
    return SilverTable(spark, f"{root}/{entity}", SILVER_KEYS[entity], unique=True)


def ingest(
    spark: SparkSession, source: str, pattern: str, bronze: str, manifest: str, reset: bool = False
) -> int:
    """Append files not seen before to bronze; returns their number.

    Batch form of ``streaming.ingest``, which keeps the list of files in its
    checkpoint and is the form to prefer.  All new files are one read, and the
    manifest names them once they are in bronze.  ``reset`` forgets bronze and the
    manifest first.  Records that cannot be read stay in bronze as text, where
    ``read_rejected`` finds them.
    """
    if reset:
        remove_folder(spark, bronze)
        remove_folder(spark, manifest)
    done = files.read_manifest(spark, manifest)
    fresh = stage(files.unprocessed(files.list_files(spark, pattern), done), "new-files")
    # A reader holds the paths of its files on the driver in any case.
    paths = [row["path"] for row in fresh.collect()]
    if paths:
        _ingest_files(spark, source, paths, bronze)
        outputs.append_manifest(fresh, manifest)
    return len(paths)


def _ingest_files(spark: SparkSession, source: str, paths: list[str], bronze: str) -> None:
    enriched = files.with_lineage(files.read_raw(spark, source, paths))
    if source == "listings":
        enriched = files.with_file_year(enriched)
    outputs.append_bronze(enriched, bronze)


def newest_listing_first():
    """Order of the copies of a property: file date, then time, then content."""
    name = files.file_name(F.col("source_file"))
    content = [c for c in cleaning.SILVER_LISTING if c not in ("property_id", "neighborhood_id")]
    return [
        F.desc_nulls_last(name),
        F.desc_nulls_last("ingestion_timestamp"),
        *[F.desc_nulls_last(c) for c in content],
    ]


def format_listings(bronze: DataFrame, lookup: DataFrame, silver: SilverTable) -> int:
    newest = newest_listing_first()
    return silver.upsert(cleaning.clean_listings(bronze, lookup, newest, LINEAGE), newest)


def format_income(bronze: DataFrame, lookup: DataFrame, listings: DataFrame, silver: SilverTable) -> int:
    years = stage(cleaning.listing_years(listings), "listing-years")
    return silver.upsert(cleaning.clean_income(bronze, lookup, years))


def format_density(bronze: DataFrame, lookup: DataFrame, listings: DataFrame, silver: SilverTable) -> int:
    years = stage(cleaning.listing_years(listings), "listing-years")
    return silver.upsert(cleaning.clean_density(bronze, lookup, years))


def run_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    listing_lookup: DataFrame,
    area_lookup: DataFrame,
    since: str | None = None,
) -> None:
    """Format the three entities; income and density run side by side once
    the listings have told which years matter.

    With ``since``, only listings of bronze dates from then on are read; the newest copy
    wins whatever the order of runs.  Yearly means need all their rows.
    """
    bronze = {name: files.read_bronze(spark, f"{bronze_root}/{name}") for name in ("income", "density")}
    bronze["listings"] = files.read_bronze(spark, f"{bronze_root}/listings", since)
    silver = {name: silver_table(spark, silver_root, name) for name in SILVER_KEYS}
    format_listings(bronze["listings"], listing_lookup, silver["listings"])
    listings = silver["listings"].read()
    with ThreadPoolExecutor(2) as pool:
        income = pool.submit(format_income, bronze["income"], area_lookup, listings, silver["income"])
        density = pool.submit(format_density, bronze["density"], area_lookup, listings, silver["density"])
        income.result(), density.result()


def build_gold(
    listings: DataFrame,
    income: DataFrame,
    density: DataFrame,
    municipality: str | None = None,
    quantile_mode: str = "exact",
) -> DataFrame:
    """Enriched, outlier-free, imputed listings, still with ``property_id``.

    The inputs are silver tables.  The listings are read twice: for the price per area beside
    the two statistics, staged as a narrow table that quartiles and means are taken from, and for
    the rows; nothing wide is shuffled or cached.  The area statistics are staged: the planner then knows their size,
    and should they outgrow a broadcast, it can still split a hot area, which
    it cannot when an aggregation feeds the join directly.
    """
    if municipality is not None:
        listings = cleaning.in_segment(listings, "municipality", municipality)
    keyed = sanitize_columns(
        listings.drop("municipality")
        .withColumn("year", F.col("data_year").cast("int"))
        .dropna(subset=["neighborhood_id", "year"])
    )
    areas = stage(enrichment.area_statistics(income, density), "areas")
    joined = enrichment.with_price_per_area(
        enrichment.enrich(keyed, areas).where(outliers.plausible())
    )
    measures = stage(joined.select("price_m2", *enrichment.STATISTICS), "measures")
    inside = outliers.iqr_fences(measures, "price_m2", quantile_mode).holds("price_m2")
    filled = imputing.impute_mean(joined.where(inside), enrichment.STATISTICS, fit_on=measures.where(inside))
    return imputing.impute_flag(filled, ["hasLift"]).drop(
        "data_year", "year", "neighborhood_id", *LINEAGE
    )


def published_gold(gold: DataFrame, run_date: str) -> DataFrame:
    """The public columns: no key, with the execution date."""
    return gold.drop("property_id").withColumn("pipeline_execution_date", F.lit(run_date))


def run_gold(
    spark: SparkSession,
    silver_root: str,
    gold_path: str,
    csv_path: str,
    run_date: str,
    municipality: str | None = None,
) -> None:
    """Build and write gold, then its dated CSV copy from the written table."""
    tables = {name: silver_table(spark, silver_root, name).read() for name in SILVER_KEYS}
    gold = published_gold(build_gold(**tables, municipality=municipality), run_date)
    outputs.write_gold(gold, gold_path)
    folder = f"{gold_path}/pipeline_execution_date={run_date}"
    written = spark.read.option("basePath", gold_path).parquet(folder)
    outputs.write_dated_csv(written, csv_path, run_date, "pipeline_execution_date")
