"""Category indexes without a limit: the index is a table that rows are joined with.

A string indexer keeps all categories of a column in its model, on the driver and in each task. Here
the distributed ranking of ``features.category_ranks`` is the model, and a row finds its index by a
join. A category with many rows would make that join lopsided, so frequent ones, of which there are
fewer than ``HEAVY`` by their shares, are looked up in a broadcast table first; their rows then pass the
join spread over all of its tasks.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable
from pyspark.sql import DataFrame, functions as F

from tabloom.sources.shared import stored

#: A category is frequent with more than one in so many of a column's rows.
HEAVY = 1000
#: Partitions' rows of frequent categories are dealt to so many keys of the join.
SPREAD = 1 << 16


class _WideParams(HasInputCols, HasOutputCols, HasHandleInvalid):
    """``inputCols`` and ``outputCols`` pair up; ``handleInvalid`` is ``error``, ``keep`` or ``skip``, as of string indexers."""

    def _checked(self) -> list[tuple[str, str]]:
        if self.getHandleInvalid() not in ("error", "keep", "skip"):
            raise ValueError(f"handleInvalid must be 'error', 'keep' or 'skip', not {self.getHandleInvalid()!r}")
        return list(zip(self.getInputCols(), self.getOutputCols(), strict=True))


class WideIndexer(Estimator, _WideParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a ``WideIndexerModel``: categories by falling frequency, equally frequent ones by value."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None, handleInvalid: str = "error") -> None:
        super().__init__()
        self._setDefault(handleInvalid="error")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> WideIndexerModel:
        from tabloom.operators.features import category_ranks

        columns = [c for c, _ in self._checked()]
        model = WideIndexerModel(stored(category_ranks(dataset, columns), "category-index"))
        model._resetUid(self.uid)
        return self._copyValues(model)


class WideIndexerModel(Model, _WideParams, MLWritable, MLReadable):
    """Adds the index columns. ``ranks`` is ``(feature, value, n, idx)``."""

    def __init__(self, ranks: DataFrame | None = None) -> None:
        super().__init__()
        self._setDefault(handleInvalid="error")
        self.ranks = ranks
        self._sizes: dict[str, tuple[int, int]] | None = None

    @property
    def sizes(self) -> dict[str, tuple[int, int]]:
        """Categories and rows behind every column."""
        if self._sizes is None:
            found = self.ranks.groupBy("feature").agg(F.count(F.lit(1)), F.sum("n")).collect()
            self._sizes = {feature: (levels, rows) for feature, levels, rows in found}
        return self._sizes

    def index(self, df: DataFrame, column: str, output: str) -> DataFrame:
        """``df`` with the index of one column, null for values that the fit did not see."""
        levels, rows = self.sizes.get(column, (0, 0))
        value, key, hot, cold = (f"__{output}_{part}" for part in ("value", "key", "hot", "cold"))
        own = self.ranks.where(F.col("feature") == column)
        frequent = F.col("n") > rows / HEAVY
        few = own.where(frequent).select(F.col("value").alias(f"{value}_0"), F.col("idx").alias(hot))
        rest = own.where(~frequent).select(F.concat(F.lit("="), "value").alias(f"{key}_0"), F.col("idx").alias(cold))
        df = df.withColumn(value, F.col(f"`{column}`").cast("string"))
        df = df.join(F.broadcast(few), F.col(value) == F.col(f"{value}_0"), "left")
        # Rows that need no partner get keys that have none.
        spread = F.concat(F.lit("#"), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)))
        df = df.withColumn(key, F.when(F.col(hot).isNull() & F.col(value).isNotNull(), F.concat(F.lit("="), value)).otherwise(spread))
        df = df.join(rest, F.col(key) == F.col(f"{key}_0"), "left").withColumn(output, F.coalesce(hot, cold))
        return df.drop(value, f"{value}_0", key, f"{key}_0", hot, cold)

    def unknown(self, df: DataFrame) -> dict[str, int]:
        """Rows whose value the fit did not see or that have none, by column; only columns with such rows."""
        found = {}
        for column, output in self._checked():
            indexed = self.index(df.select(column), column, output)
            count = indexed.agg(F.count_if(F.col(output).isNull())).first()[0]
            if count:
                found[column] = count
        return found

    def _transform(self, dataset: DataFrame) -> DataFrame:
        how = self.getHandleInvalid()
        for column, output in self._checked():
            levels = self.sizes.get(column, (0, 0))[0]
            dataset = self.index(dataset, column, output)
            known = F.col(output)
            if how == "skip":
                dataset = dataset.where(known.isNotNull())
            elif how == "keep":
                known = F.coalesce(known, F.lit(float(levels)))
            else:
                message = F.concat(F.lit(f"value of {column} that the index was not fitted on: "), F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("null")))
                known = F.coalesce(known, F.raise_error(message).cast("double"))
            attribute = {"ml_attr": {"type": "nominal", "name": output, "num_vals": levels + (how == "keep")}}
            dataset = dataset.withColumn(output, known.alias(output, metadata=attribute))
        return dataset

    def copy(self, extra=None) -> WideIndexerModel:
        twin = super().copy(extra)
        twin.ranks = self.ranks
        return twin

    def write(self) -> _ModelWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> _ModelReader:
        return _ModelReader()


class _ModelWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.ranks.write.parquet(f"{path}/ranks")


class _ModelReader(MLReader):
    def load(self, path: str) -> WideIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = WideIndexerModel(self.sparkSession.read.parquet(f"{path}/ranks"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
