"""Filling missing values with what a fit has learnt: modes of text columns, means of numbers."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Columns(Params):
    textCols = Param(Params._dummy(), "textCols", "columns filled with their most frequent value", TypeConverters.toListString)
    numericCols = Param(Params._dummy(), "numericCols", "columns filled with their mean", TypeConverters.toListString)

    def columns(self) -> tuple[list[str], list[str]]:
        return self.getOrDefault(self.textCols), self.getOrDefault(self.numericCols)


class FillModel(_Columns, Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fills nulls, and NaN of numeric columns. A column that had no value at the fit stays as it is."""

    modes = Param(Params._dummy(), "modes", "one value for each text column, with a mark before it", TypeConverters.toListString)
    means = Param(Params._dummy(), "means", "one value for each numeric column", TypeConverters.toListFloat)

    def __init__(self, **params):
        super().__init__()
        self._setDefault(textCols=[], numericCols=[], modes=[], means=[])
        self._set(**params)

    def _transform(self, df: DataFrame) -> DataFrame:
        text, numeric = self.columns()
        filled = {c: F.coalesce(c, F.lit(m[1:])) for c, m in zip(text, self.getOrDefault(self.modes)) if m}
        for c, mean in zip(numeric, self.getOrDefault(self.means)):
            if mean == mean:
                number = F.col(c).cast("double")
                filled[c] = F.when(number.isNull() | F.isnan(number), F.lit(mean)).otherwise(number)
        return df.withColumns(filled) if filled else df


class Fill(_Columns, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the most frequent value of each text column (ties: the smallest) and the mean of each
    numeric one, in one pass each over all columns; nulls, and NaN, do not count."""

    def __init__(self, **params):
        super().__init__()
        self._setDefault(textCols=[], numericCols=[])
        self._set(**params)

    def _fit(self, df: DataFrame) -> FillModel:
        text, numeric = self.columns()
        modes: dict[str, str] = {}
        if text:
            values = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.col(c).cast("string").alias("value")) for i, c in enumerate(text)]))
            counts = df.select(values.alias("v")).where("v.value IS NOT NULL").groupBy("v.place", "v.value").count()
            best = counts.groupBy("place").agg(F.min(F.struct((-F.col("count")).alias("n"), "value")).alias("best"))
            modes = {text[r.place]: "=" + r.best.value for r in best.collect()}  # one row for each column
        means: dict[str, float] = {}
        if numeric:
            row = df.agg(*[F.avg(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(f"m{i}") for i, c in enumerate(numeric)]).first()
            means = {c: row[i] for i, c in enumerate(numeric) if row[i] is not None}
        return FillModel(
            textCols=text, numericCols=numeric, modes=[modes.get(c, "") for c in text], means=[means.get(c, float("nan")) for c in numeric],
        )
