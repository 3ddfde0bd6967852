"""Category indexes, standardising and feature vectors."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.operators.imputing import UNKNOWN
from estatelake.staging import stage, staged

# Categories of a column that a model lists, and how many of these slots rarer ones share.
SLOTS = 1000
HASHED_SLOTS = 200
# What the names of shared slots begin with.
SHARED = "~slot-"


def category_index(df: DataFrame, column: str) -> DataFrame:
    """Mapping (category, idx): all values plus 'Unknown', numbered in code point order."""
    distinct = df.select(F.col(column).alias("category")).where("category is not null").distinct()
    extra = df.sparkSession.createDataFrame([(UNKNOWN,)], "category string")
    with staged(distinct.union(extra).distinct(), "categories") as categories:
        ranged = categories.repartitionByRange("category")
        with staged(ranged.withColumn("part", F.spark_partition_id()), "ranges") as parts:
            return stage(_numbered_by_part(parts), "category-index")


def _numbered_by_part(parts: DataFrame) -> DataFrame:
    """Numbers within each range plus the sizes of the ranges before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parts.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    inside = Window.partitionBy("part").orderBy("category")
    ranked = parts.withColumn("rank", F.row_number().over(inside)).join(starts, "part")
    idx = F.col("start") + F.col("rank") - 1
    return ranked.select("category", idx.cast("int").alias("idx"))


def encode_with_index(df: DataFrame, index: DataFrame, column: str, output: str) -> DataFrame:
    """Adds the index of a category; unseen and missing ones get that of 'Unknown'."""
    unknown = index.where(F.col("category") == UNKNOWN).select("idx").scalar()
    mapping = index.select(F.col("category").alias(column), F.col("idx").alias(output))
    return df.join(mapping, column, "left").withColumn(output, F.coalesce(output, unknown))


def frequency_index(df: DataFrame, columns: list[str], slots: int = SLOTS) -> StringIndexerModel | PipelineModel:
    """Indexes by falling frequency, ties by name; unseen values get one more slot.

    A tree needs a bin for each category, and a model holds its list.  So of more than ``slots`` categories
    the most frequent keep slots of their own, the others share ``HASHED_SLOTS`` by their hash.
    """
    labels = {c: _most_frequent(df, c, slots + 1) for c in columns}
    if all(len(found) <= slots for found in labels.values()):
        return _indexer([labels[c] for c in columns], columns, [f"{c}_idx" for c in columns])
    own = {c: found if len(found) <= slots else found[: slots - HASHED_SLOTS] for c, found in labels.items()}
    shared = [f"{SHARED}{k}" for k in range(HASHED_SLOTS)]
    whole = [own[c] if len(labels[c]) <= slots else own[c] + shared for c in columns]
    hashed = ", ".join(
        f"if(`{c}_rank` < {len(own[c])}, `{c}`, concat('{SHARED}', cast(conv(substring(md5(`{c}`), 1, 8), 16, 10) as bigint) % {HASHED_SLOTS})) as `{c}_slot`"
        if len(labels[c]) > slots else f"`{c}` as `{c}_slot`"
        for c in columns
    )
    return PipelineModel(
        [
            _indexer([own[c] for c in columns], columns, [f"{c}_rank" for c in columns]),
            SQLTransformer(statement=f"SELECT *, {hashed} FROM __THIS__"),
            _indexer(whole, [f"{c}_slot" for c in columns], [f"{c}_idx" for c in columns]),
        ]
    )


def _indexer(labels: list[list[str]], inputs: list[str], outputs: list[str]) -> StringIndexerModel | PipelineModel:
    """An indexer for each column: lists of different lengths in one would be filled up with nulls."""
    models = [
        # An empty list of labels is no array of texts to the JVM.
        StringIndexerModel.from_labels(found or [UNKNOWN], inputCol=name, outputCol=output, handleInvalid="keep")
        for found, name, output in zip(labels, inputs, outputs)
    ]
    return models[0] if len(models) == 1 else PipelineModel(models)


def _most_frequent(df: DataFrame, column: str, most: int) -> list[str]:
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("category")).count()
    return [r["category"] for r in counts.orderBy(F.desc("count"), "category").limit(most).collect()]


def feature_assembler(numeric: list[str], categorical: list[str], output: str = "features_raw") -> VectorAssembler:
    """Category indexes first, then numbers; rows with a null or NaN are skipped."""
    return VectorAssembler(
        inputCols=[f"{c}_idx" for c in categorical] + numeric, outputCol=output, handleInvalid="skip"
    )


def standardize(
    df: DataFrame, columns: list[str], ddof: int = 1, fit_on: DataFrame | None = None
) -> DataFrame:
    """Centred and scaled columns; ``ddof`` 1 is the sample deviation, 0 that of the population.

    A constant column becomes zero.
    """
    spread = F.stddev_samp if ddof else F.stddev_pop
    source = df if fit_on is None else fit_on
    fitted = source.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[spread(c).alias(f"{c}_std") for c in columns],
        ).alias("fitted")
    ).scalar()
    scaled = {}
    for c in columns:
        deviation = fitted.getField(f"{c}_std")
        centred = F.col(c) - fitted.getField(f"{c}_mean")
        scaled[c] = F.when(deviation == 0, F.lit(0.0)).otherwise(centred / deviation)
    return df.withColumns(scaled)
