"""Category numbers as a table that belongs to a model.

The alphabetic profile numbers all categories in code-point order, however many there are.
The numbers lie in a table of their own, written when the model is fitted and again
with it when it is saved; rows get their numbers by a join, which Spark broadcasts
while the table is small.  Nothing of it passes the driver or the plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.operators.encoding import category_index
from estatelake.operators.imputing import UNKNOWN
from estatelake.staging import stage


class CategoryTable(Transformer, MLReadable, MLWritable):
    """Adds ``<column>_encoded``: the number of a category, that of 'Unknown' for unseen and missing ones.

    The order of rows may change, their number and their other columns do not.
    """

    columns = Param(Params._dummy(), "columns", "categorical columns", TypeConverters.toListString)
    unknown = Param(Params._dummy(), "unknown", "numbers of 'Unknown'", TypeConverters.toListInt)
    path = Param(Params._dummy(), "path", "folder of the rows (column, category, idx)", TypeConverters.toString)

    @classmethod
    def fit(cls, train: DataFrame, columns: list[str]) -> CategoryTable:
        parts = [category_index(train, c).select(F.lit(c).alias("column"), "category", "idx") for c in columns]
        table = stage(reduce(DataFrame.union, parts), "category-table", by="column")
        found = cls()
        numbers = {r["column"]: r["idx"] for r in table.where(F.col("category") == UNKNOWN).collect()}
        found._set(columns=columns, unknown=[numbers[c] for c in columns], path=table.inputFiles()[0].split("/column=")[0])
        return found

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("category string, idx int, column string").parquet(self.getOrDefault(self.path))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows, table = dataset, self.table(dataset.sparkSession)
        for name, unknown in zip(self.getOrDefault(self.columns), self.getOrDefault(self.unknown)):
            own = table.where(F.col("column") == name).select(F.col("category").alias("category__"), F.col("idx").alias("idx__"))
            joined = rows.join(own, rows[name] == own["category__"], "left")
            number = F.coalesce("idx__", F.lit(unknown)).cast("double")
            rows = joined.withColumn(f"{name}_encoded", number).drop("category__", "idx__")
        return rows

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: CategoryTable):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table(self.sparkSession).write.partitionBy("column").parquet(f"{path}/table")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CategoryTable:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._set(path=f"{path}/table")
        return model
