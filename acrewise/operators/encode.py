"""Feature encoding: standardising, ordinal codes, imputers, preprocessing stages and clustering."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.param.shared import HasInputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.operators.similarity import standardized
from acrewise.scale import dense_index, lookup_join, medians, stage


def standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """Median-filled zero-mean, unit-deviation (population) columns named ``<col>_std``."""
    return df.withColumns({f"{c}_std": v for c, v in standardized(df, cols).items()})


def ordinal_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """Position of the value among the sorted distinct values; missing values are -1.

    The codes stay a table: a column with many values is neither collected nor sorted in one place.
    """
    values = df.where(F.col(col).isNotNull()).select(col).distinct()
    codes = dense_index(values, [col], "__code")
    coded = lookup_join(df, codes, [col])
    return coded.withColumn(out, F.coalesce(F.col("__code"), F.lit(-1)).cast("int")).drop("__code")


def modes(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent value per column, ties to the smallest; counted in one pass over all columns."""
    cells = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("v")) for c in cols])).alias("e")
    )
    counts = cells.where(F.col("e.v").isNotNull()).groupBy("e.col", "e.v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("col").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("v"))).alias("b"))
    found = {r["col"]: r["b"]["v"] for r in best.collect()}
    return {c: found.get(c) for c in cols}


def impute_table(df: DataFrame, num: list[str], cat: list[str]) -> DataFrame:
    """Fill numeric columns with exact medians and text columns with their mode."""
    return ExactImputer(inputCols=num + cat, numeric=num).fit(df).transform(df)


class _ImputerParams(HasInputCols):
    numeric = Param(Params._dummy(), "numeric", "columns filled with the median", TypeConverters.toListString)
    fills = Param(Params._dummy(), "fills", "fill value per column as text", TypeConverters.identity)
    learned = Param(Params._dummy(), "learned", "columns to learn a fill for, all if not set", TypeConverters.toListString)


class ExactImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the exact median of ``numeric`` columns and the most frequent value of the others."""

    def __init__(self, inputCols: list[str] | None = None, numeric: list[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[], numeric=[])
        if inputCols is not None:
            self._set(inputCols=inputCols)
        if numeric is not None:
            self._set(numeric=numeric)

    def _fit(self, dataset: DataFrame) -> ExactImputerModel:
        numeric = self.getOrDefault("numeric")
        learned = self.getOrDefault("learned") if self.isSet("learned") else self.getInputCols()
        known = [c for c in numeric if c in learned]
        others = [c for c in self.getInputCols() if c not in numeric and c in learned]
        fills = {c: repr(v) for c, v in medians(dataset, known).items() if v is not None} if known else {}
        fills |= {c: v for c, v in (modes(dataset, others) if others else {}).items() if v is not None}
        model = ExactImputerModel()
        model._set(inputCols=self.getInputCols(), numeric=numeric, fills=fills)
        return model


class ExactImputerModel(Model, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fills missing values with the learned ones; numeric columns come out as double."""

    def __init__(self):
        super().__init__()
        self._setDefault(inputCols=[], numeric=[], fills={})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills, numeric = self.getOrDefault("fills"), self.getOrDefault("numeric")
        updates = {}
        for c in self.getInputCols():
            value = F.col(c).cast("double") if c in numeric else F.col(c).cast("string")
            fill = F.lit(float(fills[c]) if c in numeric else fills[c]) if c in fills else None
            updates[c] = value if fill is None else F.coalesce(value, fill)
        return dataset.withColumns(updates)


def build_preprocessor(num: list[str], cat: list[str], out: str = "features") -> Pipeline:
    """Impute, standardise numerics, one-hot encode texts (unseen values become all zeros), assemble."""
    stages = [ExactImputer(inputCols=num + cat, numeric=num)]
    inputs = []
    if num:
        stages += [
            VectorAssembler(inputCols=num, outputCol="__num", handleInvalid="keep"),
            StandardScaler(inputCol="__num", outputCol="__num_std", withMean=True, withStd=True),
        ]
        inputs.append("__num_std")
    if cat:
        stages += [
            StringIndexer(inputCols=cat, outputCols=[f"__{c}_ix" for c in cat], handleInvalid="keep"),
            OneHotEncoder(
                inputCols=[f"__{c}_ix" for c in cat], outputCols=[f"__{c}_oh" for c in cat], dropLast=True
            ),
        ]
        inputs += [f"__{c}_oh" for c in cat]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol=out)])


POINTS_PER_TASK = 100_000


def weighted_points(df: DataFrame, cols: list[str]) -> DataFrame:
    """Different points as ``__vec`` with their number of rows as ``__weight``, in the order of their coordinates.

    A fit of k-means passes over its input dozens of times; counts and coordinates on a grid repeat, so it passes over the
    different points only. Sorted, so that the starts do not depend on how the rows were dealt.
    """
    points = df.groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias("__weight"))
    points = stage(points, "points")
    # a few points need a few tasks: a fit is some thirty jobs, each of which would start a task per partition
    points = points.repartitionByRange(1 + points.count() // POINTS_PER_TASK, *cols).sortWithinPartitions(*cols)
    return VectorAssembler(inputCols=cols, outputCol="__vec").transform(points).persist(StorageLevel.MEMORY_AND_DISK)


def _k_means(k: int, seed: int) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol="__vec", predictionCol="__cluster", weightCol="__weight")


def _narrow(df: DataFrame, cols: list[str], scale: bool) -> tuple[DataFrame, list[str], dict[str, Column]]:
    """Only ``cols``, stored once where the scaling reads them several times; the names to cluster by and the scaled forms."""
    if not scale:
        return df.select(*cols), cols, {}
    rows = stage(df.select(*cols), "coordinates")
    scaled = {f"{c}_std": v for c, v in standardized(rows, cols).items()}
    return rows.withColumns(scaled), list(scaled), scaled


def elbow(df: DataFrame, cols: list[str], ks: range = range(1, 11), scale: bool = True, seed: int = 42, n_init: int = 3) -> DataFrame:
    """Within-cluster sum of squares per cluster count, the least of ``n_init`` starts."""
    narrow, names, _ = _narrow(df, cols, scale)
    points = weighted_points(narrow, names)
    rows = []
    for k in ks:
        if k == 1:
            spread = narrow.agg(*[(F.var_pop(c) * F.count(c)).alias(c) for c in names]).first()
            rows.append((1, float(sum(spread))))
        else:
            # starts are drawn from the different points whatever their weight, so one alone may end far from the least
            rows.append((k, min(float(_k_means(k, seed + i).fit(points).summary.trainingCost) for i in range(n_init))))
    points.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, wcss double")


def cluster_centers(df: DataFrame, cols: list[str], k: int, n_init: int = 10, seed: int = 42, order_by: str = "center") -> list[list[float]]:
    """K-means centres, best of ``n_init`` starts, numbered by a stable rule instead of by chance.

    ``order_by``: ``center`` sorts clusters by their centre coordinates, ``total`` by the sum of them.
    """
    points = weighted_points(df, cols)
    best = None
    for start in range(n_init):
        model = _k_means(k, seed + start).fit(points)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    points.unpersist()
    centers = [list(map(float, c)) for c in best.clusterCenters()]
    return sorted(centers, key=lambda c: (sum(c), c) if order_by == "total" else c)


def nearest_center(point: list[Column], centers: list[list[float]]) -> Column:
    """Number of the centre at the least distance, ties to the smaller number; ``centers`` is a short list."""

    def distance(center: list[float]) -> Column:
        total = F.lit(0.0)
        for x, c in zip(point, center, strict=True):
            total = total + (x - F.lit(c)) * (x - F.lit(c))
        return total

    found = F.array_min(F.array(*[F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)]))
    return found["i"]


def cluster(
    df: DataFrame,
    cols: list[str],
    k: int,
    out: str,
    n_init: int = 10,
    seed: int = 42,
    scale: bool = False,
    order_by: str = "center",
) -> DataFrame:
    """K-means labels, numbered as :func:`cluster_centers` numbers the centres."""
    narrow, names, scaled = _narrow(df, cols, scale)
    centers = cluster_centers(narrow.select(*names), names, k, n_init, seed, order_by)
    return df.withColumn(out, nearest_center([scaled.get(c, F.col(c)) for c in names], centers))


def geo_clusters(df: DataFrame, out: str = "location_cluster", n_init: int = 10, k: int = 8) -> DataFrame:
    """Geographic clusters; missing coordinates use the medians."""
    if not {"latitude", "longitude"} <= set(df.columns):
        return df.withColumn(out, F.lit(0))
    # the rows may be a long plan, which the medians and the clustering read three times
    places = stage(df.select("latitude", "longitude"), "places")
    mid = medians(places, ["latitude", "longitude"])
    filled = [F.coalesce(F.col(c), F.lit(mid[c]).cast("double")) for c in ("latitude", "longitude")]
    points = places.select(filled[0].alias("__latitude"), filled[1].alias("__longitude"))
    return df.withColumn(out, nearest_center(filled, cluster_centers(points, points.columns, k, n_init)))
