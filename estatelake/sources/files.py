"""Readers of raw drops, bronze folders and dated snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelake import schemas
from estatelake.folders import folder_names
from estatelake.functions.names import file_name, file_year
from estatelake.staging import stage

CORRUPT = "_corrupt_record"
# Whole records, and what of them no schema names.
RECORD, RESCUED = "_record", "_rescued"
# Fixed value: folder of the rows without a value in the partition column.
NO_VALUE = "=__HIVE_DEFAULT_PARTITION__"

# How each source is read: format, schema and reader options.
SOURCES = {
    "listings": ("json", schemas.LISTING_RAW, {}),
    "income": ("csv", schemas.INCOME_RAW, {"header": "true"}),
    "density": ("json", schemas.DENSITY_RAW, {"multiLine": "true"}),
}


def read_raw(spark: SparkSession, source: str, paths: str | list[str]) -> DataFrame:
    """Raw rows of a source; unreadable records keep their text in ``_corrupt_record``.

    Fields of a JSON record that the schema does not name are kept in ``_rescued``, a variant
    object, null where there are none; read them back with ``try_variant_get``.
    """
    kind, schema, options = SOURCES[source]
    if kind == "csv":
        return read_csv_by_name(spark, schema, paths)
    return _typed_and_rescued(_reader(spark.read, options).load(paths), schema)


def read_csv_by_name(spark: SparkSession, schema: T.StructType, paths: str | list[str]) -> DataFrame:
    """Text columns of headed CSV files, found by each file's own header.

    The header of a file is the row that holds all declared names.  A declared name that the
    header lacks is an error of the file: its rows keep their text, untouched, in ``_corrupt_record``.
    A record is a line; quoted cells may hold commas and quotes, not line breaks.
    """
    names = [f.name for f in schema.fields]
    reader = spark.read.option("recursiveFileLookup", "true")
    named = reduce(lambda both, name: both & F.col("value").contains(name), names, F.lit(True))
    commas = reader.text(paths).where(named).agg(F.max(F.regexp_count("value", F.lit(",")))).first()[0]
    places = [f"c{i}" for i in range(1 + (commas or len(names)))]
    wide = ", ".join(f"{p} string" for p in places)
    lines = reader.text(paths).where(F.trim("value") != "")
    line = F.regexp_replace("value", "^\ufeff", "")
    parsed = lines.select("value", F.from_csv(line, F.lit(wide)).alias("line"), F.col("_metadata.file_path").alias("file"))
    cells = parsed.select("value", F.array(*[F.col("line").getField(p) for p in places]).alias("cells"), "file")
    cells = cells.withColumn("filled", F.array_compact("cells"))
    is_header = F.forall(F.lit(names), lambda name: F.array_contains("filled", name))
    headers = stage(cells.where(is_header).groupBy("file").agg(F.first("cells").alias("header")), "headers")
    rows = cells.where(~is_header).join(headers, "file", "left")
    known = F.col("header").isNotNull()
    found = [F.get("cells", F.array_position("header", n).cast("int") - 1).alias(n) for n in names]
    corrupt = F.when(~known, F.col("value")).alias(CORRUPT)
    return rows.select(*found, corrupt, F.struct(F.col("file").alias("file_path")).alias("_metadata"))


def stream_raw(spark: SparkSession, source: str, folder: str, max_files: int | None = None) -> DataFrame:
    """The same rows as a stream over the files that appear in a folder.

    ``max_files`` bounds a micro-batch.  Appends gain restart points from it;
    upserts rewrite their table per batch and do best without.
    """
    kind, schema, options = SOURCES[source]
    if max_files is not None:
        options = options | {"maxFilesPerTrigger": str(max_files)}
    if kind == "csv":
        # Such a stream binds by position (a header in another order is an error, not other
        # values); ``streaming.ingest.ingest_csv`` goes by name.
        reader = spark.readStream.format(kind).schema(_with_corrupt(schema))
        return reader.options(**options, enforceSchema="false", columnNameOfCorruptRecord=CORRUPT, recursiveFileLookup="true").load(folder)
    return _typed_and_rescued(_reader(spark.readStream, options).load(folder), schema)


def _typed_and_rescued(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared fields of whole records, and the others as ``_rescued``.

    The elements of an array are records of their own.  A record with a value that does not fit
    its declared type is unreadable, like one that is no JSON.
    """
    each = F.explode(F.coalesce(F.try_variant_get(RECORD, "$", "array<variant>"), F.array(RECORD)))
    records = records.select(CORRUPT, "_metadata", each.alias(RECORD))
    parsed = F.from_json(F.to_json(RECORD), _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    fields = F.try_variant_get(RECORD, "$", "map<string,variant>")
    declared = [f.name for f in schema.fields]
    others = F.map_filter(fields, lambda name, _: ~name.isin(declared))
    rows = records.select(CORRUPT, "_metadata", parsed.alias("parsed"), F.when(F.size(others) > 0, others).alias("others"))
    return rows.select(
        *[F.col("parsed").getField(n).alias(n) for n in declared], F.coalesce(CORRUPT, F.col("parsed").getField(CORRUPT)).alias(CORRUPT),
        F.to_variant_object("others").alias(RESCUED), "_metadata",
    )


def with_lineage(raw: DataFrame, ingestion_time=None) -> DataFrame:
    """Adds ingestion time, source file and ingestion date."""
    now = F.current_timestamp() if ingestion_time is None else F.lit(ingestion_time).cast("timestamp")
    named = raw.withColumns({"ingestion_timestamp": now, "source_file": F.col("_metadata.file_path")})
    return named.withColumn("ingestion_date", F.to_date("ingestion_timestamp")).drop("_metadata")


def with_file_year(bronze: DataFrame, source: str | None = None) -> DataFrame:
    """Adds ``data_year``, taken from the dated file name."""
    return bronze.withColumn("data_year", file_year(file_name(F.col("source_file")), source))


def read_bronze(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Readable bronze rows of all ingestion dates, or from a date on (folders are pruned)."""
    bronze = spark.read.parquet(path)
    if CORRUPT in bronze.columns:
        bronze = bronze.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return bronze if since is None else bronze.where(F.col("ingestion_date") >= F.lit(since).cast("date"))


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Text and origin of the bronze records that could not be read."""
    bronze = spark.read.parquet(path).where(F.col(CORRUPT).isNotNull())
    return bronze.select(CORRUPT, "source_file", "ingestion_timestamp", "ingestion_date")


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GOLD).parquet(path)


def read_requests(spark: SparkSession, path: str, kind: str = "json", extra: str = "") -> DataFrame:
    """Scoring requests with their declared types; ``extra`` declares columns to pass through."""
    fields = list(schemas.VALUATION_REQUEST.fields)
    if extra:
        fields += T.StructType.fromDDL(extra).fields
    return spark.read.schema(T.StructType(fields)).format(kind).load(path)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.AREA_LOOKUP).option("header", "true").csv(path)


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Paths matching a glob; file contents are not read."""
    return spark.read.format("binaryFile").load(pattern).select("path")


def unprocessed(files: DataFrame, manifest: DataFrame, key: str = "path") -> DataFrame:
    """Files that the manifest does not list."""
    return files.distinct().join(manifest.select(key), key, "left_anti")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Processed paths; empty before the first run."""
    schema = T.StructType([T.StructField("path", T.StringType())])
    if not folder_names(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def latest_partition(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Rows of the greatest ``column=value`` folder, all its parts.

    Only folder names are listed; files of older dates are never opened.
    """
    dated = [n for n in folder_names(spark, path) if n.startswith(f"{column}=") and not n.endswith(NO_VALUE)]
    if not dated:
        raise FileNotFoundError(f"no {column}= folder under {path}")
    return (
        spark.read.option("basePath", path)
        .option("ignoreCorruptFiles", "true")
        .parquet(f"{path}/{max(dated)}")
    )


def read_dated_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the latest dated CSV snapshot; unreadable parts are skipped."""
    dated = [n for n in folder_names(spark, path) if not n.startswith(("_", "."))]
    if not dated:
        raise FileNotFoundError(f"no snapshot under {path}")
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("ignoreCorruptFiles", "true")
        .csv(f"{path}/{max(dated)}")
    )


def skipped_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (path, length, reason) for the Parquet parts of a folder that gave a tolerant reader no row.

    ``reason`` is 'unreadable', or 'empty' for an intact part without rows.  Only parts without a row
    are opened a second time, and of these only the end.
    """
    tolerant = {"recursiveFileLookup": "true", "ignoreCorruptFiles": "true"}
    planned = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet").load(folder)
    listed = spark.read.options(**tolerant).schema(_any_schema(spark, folder)).parquet(folder)
    read = listed.select(_plain_path(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))).alias("at")).distinct()
    silent = planned.select("path", "length").join(read, _plain_path(F.col("path")) == F.col("at"), "left_anti")
    paths = [r["path"] for r in silent.collect()]
    if not paths:
        return silent.withColumn("reason", F.lit("empty"))
    # Fixed value: what a whole Parquet file ends with.
    ends_whole = F.substring("content", -4, 4).cast("string") == "PAR1"
    opened = spark.read.format("binaryFile").load(paths)
    return opened.select("path", "length", F.when(ends_whole, "empty").otherwise("unreadable").alias("reason"))


def _any_schema(spark: SparkSession, folder: str) -> T.StructType:
    """The columns of the first part that has a readable footer."""
    return spark.read.options(recursiveFileLookup="true", ignoreCorruptFiles="true").parquet(folder).schema


def _plain_path(path: Column) -> Column:
    """A path with one slash after its scheme."""
    return F.regexp_replace(path, r"^(\w+):/+", "$1:/")


def _reader(reader, options: dict):
    """Whole JSON records as variants; text that is no JSON goes to ``_corrupt_record``."""
    return (
        reader.format("json")
        .schema(T.StructType([T.StructField(RECORD, T.VariantType()), T.StructField(CORRUPT, T.StringType())]))
        .options(**options, mode="PERMISSIVE", singleVariantColumn=RECORD, columnNameOfCorruptRecord=CORRUPT)
        .option("recursiveFileLookup", "true")
    )


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
