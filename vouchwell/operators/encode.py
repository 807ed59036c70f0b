"""Metadata split, imputation, scaling and one-hot encoding of the feature mart."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vouchwell.operators.quantiles import exact_quantiles
from vouchwell.sources.files import write_table
from vouchwell.storage import broadcast_if_small, materialize

# The descriptive columns of the output tables.
METADATA_COLUMNS = [
    "invoice_id",
    "vendor_id",
    "vendor_name",
    "invoice_date",
    "submission_timestamp",
    "payment_date",
    "due_date",
    "purchase_order_id",
    "contract_id",
    "description",
    "requester",
    "approver",
]
NUMERIC_TYPES = {"reference": {"bigint", "double"}, "all_numeric": {"bigint", "double", "int"}}
ENCODER_SCHEMA = (
    "position int, name string, kind string, median double, most_frequent string, mean double, scale double"
)


def separate_metadata(mart: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features keyed by invoice_id, and the descriptive columns."""
    return mart.drop(*METADATA_COLUMNS[1:]), mart.select(*METADATA_COLUMNS)


def feature_types(mart: DataFrame, feature_set: str = "reference") -> tuple[list[str], list[str]]:
    """Numeric and categorical feature columns, by type.

    The 'reference' set leaves out 32-bit integers and dates; 'all_numeric' keeps integers.
    """
    wanted = NUMERIC_TYPES[feature_set]
    features = [(n, t) for n, t in mart.dtypes if n not in METADATA_COLUMNS]
    return [n for n, t in features if t in wanted], [n for n, t in features if t == "string"]


def medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    if not columns:
        return {}
    found = exact_quantiles(df, columns, [0.5])
    return {c: found[c, 0.5] for c in columns}


def most_frequent(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest one on ties."""
    if not columns:
        return {}
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]
    counts = (
        df.select(F.inline(F.array(*entries)))
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("column_name").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("best"))
    return {r["column_name"]: r["best"]["value"] for r in best.collect()}


@dataclass
class Encoder:
    """Fitted fills and scales; one value per column, whatever the row count."""

    numeric: list[str]
    categorical: list[str]
    fills: dict[str, float | str]
    means: dict[str, float]
    scales: dict[str, float | None]

    def transform(self, mart: DataFrame) -> DataFrame:
        """Impute all features and standardise the numeric ones; constant columns give 0.

        The unscaled amount stays available as ``invoice_amount``.
        """
        filled = {c: F.coalesce(F.col(c), F.lit(self.fills.get(c))) for c in self.categorical}
        scaled = {}
        for c in self.numeric:
            value = F.coalesce(F.col(c).cast("double"), F.lit(self.fills[c]))
            scale = self.scales[c]
            scaled[c] = (value - self.means[c]) / scale if scale else F.lit(0.0)
        amount = {"invoice_amount": F.col("amount")} if "amount" in mart.columns else {}
        return mart.withColumns(filled | scaled | amount)


def fill_rows(mart: DataFrame, encoder: Encoder) -> DataFrame:
    """(column_name, median, most_frequent): the value each column's gaps get."""
    rows = [(c, encoder.fills[c], None) for c in encoder.numeric]
    rows += [(c, None, encoder.fills.get(c)) for c in encoder.categorical]
    return mart.sparkSession.createDataFrame(rows, "column_name string, median double, most_frequent string")


def fit_encoder(mart: DataFrame, feature_set: str = "reference") -> Encoder:
    """Exact medians and modes, then mean and population deviation of the filled columns.

    Both come from sums of distances to the median, which gaps take as their value, so they add
    nothing. A median is within one deviation of the mean, so the sums lose no digits.
    """
    numeric, categorical = feature_types(mart, feature_set)
    middle = medians(mart, numeric)
    numeric = [c for c in numeric if middle[c] is not None]
    fills = {c: middle[c] for c in numeric} | most_frequent(mart, categorical)
    sums = []
    for c in numeric:
        value = F.col(c).cast("double")
        gap = F.when(value == fills[c], 0.0).otherwise(value - fills[c])
        sums.append(F.struct(F.sum(gap).alias("first"), F.sum(gap * gap).alias("second")).alias(c))
    row = mart.agg(F.count(F.lit(1)).alias("_rows"), *sums).first() if numeric else None
    means, scales = {}, {}
    for c in numeric:
        first, second = row[c]["first"] / row["_rows"], row[c]["second"] / row["_rows"]
        means[c] = fills[c] + first
        scales[c] = math.sqrt(max(second - first * first, 0.0)) if second else None
    return Encoder(numeric, categorical, fills, means, scales)


def fit_vectorizer(encoded: DataFrame, encoder: Encoder) -> PipelineModel:
    """Numeric columns followed by one column per category; unseen categories are all zero.

    The indexer keeps its category lists on the driver: this is the form of the matrix for
    models whose own size grows with the categories. ``onehot_rows`` needs no list.
    """
    indexer = StringIndexer(
        inputCols=encoder.categorical,
        outputCols=[f"{c}_index" for c in encoder.categorical],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    onehot = OneHotEncoder(
        inputCols=indexer.getOutputCols(), outputCols=[f"{c}_onehot" for c in encoder.categorical], dropLast=True
    )
    assembler = VectorAssembler(inputCols=[*encoder.numeric, *onehot.getOutputCols()], outputCol="features")
    return Pipeline(stages=[indexer, onehot, assembler]).fit(encoded)


def feature_names(vectorizer: PipelineModel, encoder: Encoder) -> list[str]:
    names = [f"numeric__{c}" for c in encoder.numeric]
    for c, values in zip(encoder.categorical, vectorizer.stages[0].labelsArray):
        names += [f"categorical__{c}_{v}" for v in values]
    return names


def feature_matrix(encoded: DataFrame, vectorizer: PipelineModel) -> DataFrame:
    """Descriptive columns and the sparse feature vector, in one row per invoice."""
    return vectorizer.transform(encoded).select(*METADATA_COLUMNS, "features")


def save_artifacts(folder: str, encoded: DataFrame, encoder: Encoder, vectorizer: PipelineModel) -> None:
    """Encoder, vectorizer, feature names and the matrix with its metadata."""
    spark = encoded.sparkSession
    save_encoder(spark, encoder, f"{folder}/encoder")
    vectorizer.write().overwrite().save(f"{folder}/vectorizer")
    names = list(enumerate(feature_names(vectorizer, encoder)))
    write_table(spark.createDataFrame(names, "position int, name string"), f"{folder}/feature_names")
    write_table(feature_matrix(encoded, vectorizer), f"{folder}/feature_matrix")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with their place in an order, from 0, found without a task that sees them all."""
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    spread = materialize(spread.withColumns({"_part": F.spark_partition_id(), "_inside": inside}), "sorted_rows", large=True)
    sizes = spread.groupBy("_part").agg((F.max("_inside") + 1).alias("n"))
    ahead = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    starts = sizes.select("_part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_start"))
    placed = spread.join(F.broadcast(starts), "_part")
    return placed.withColumn("position", F.col("_start") + F.col("_inside")).drop("_part", "_inside", "_start")


def save_matrix(folder: str, encoded: DataFrame, encoder: Encoder) -> None:
    """Encoder, column names and the sparse matrix, all as tables; the driver holds no category list.

    ``feature_names`` has a row per column: position, name, and for one-hot columns the column
    and value they stand for. ``feature_matrix`` has the descriptive columns, the numbers in
    order and the positions of the ones.
    """
    spark = encoded.sparkSession
    save_encoder(spark, encoder, f"{folder}/encoder")
    order = {c: i for i, c in enumerate(encoder.categorical)}
    rank = F.coalesce(*[F.when(F.col("column_name") == c, i) for c, i in order.items()], F.lit(len(order)))
    hot = numbered(categories(encoded, encoder).withColumn("_rank", rank), "_rank", "value")
    named = F.concat(F.lit("categorical__"), "column_name", F.lit("_"), "value").alias("name")
    hot = hot.select((F.col("position") + len(encoder.numeric)).alias("position"), named, "column_name", "value")
    plain = [(i, f"numeric__{c}", c, None) for i, c in enumerate(encoder.numeric)]
    names = spark.createDataFrame(plain, "position long, name string, column_name string, value string").unionByName(hot)
    write_table(names, f"{folder}/feature_names")
    names = spark.read.parquet(f"{folder}/feature_names").filter(F.col("value").isNotNull())
    rows = encoded.select(
        *METADATA_COLUMNS, F.array(*[F.col(c).cast("double") for c in encoder.numeric]).alias("numbers"),
        *[F.col(c).alias(f"_{c}") for c in encoder.categorical],
    )
    for c in encoder.categorical:
        own = names.filter(F.col("column_name") == c).select(F.col("value").alias(f"_{c}"), F.col("position").alias(f"_{c}_at"))
        rows = rows.join(broadcast_if_small(own), f"_{c}", "left")
    ones = F.array_compact(F.array(*[F.col(f"_{c}_at") for c in encoder.categorical]))
    write_table(rows.select(*METADATA_COLUMNS, "numbers", ones.alias("ones")), f"{folder}/feature_matrix")


@dataclass
class SavedMatrix:
    """What ``save_matrix`` wrote."""

    encoder: Encoder
    names: DataFrame
    matrix: DataFrame

    def encoded(self) -> DataFrame:
        """Scaled numbers and categories under their column names, as ``Encoder.transform`` gives them."""
        numbers = [F.col("numbers")[i].alias(c) for i, c in enumerate(self.encoder.numeric)]
        rows = self.matrix.select(*METADATA_COLUMNS, *numbers, "ones")
        offset = F.lit(0)
        for c in self.encoder.categorical:
            own = self.names.filter((F.col("column_name") == c) & F.col("value").isNotNull())
            own = own.select(F.col("position").alias("_at"), F.col("value").alias(c))
            bounds = own.agg(F.min("_at").alias("low"), F.max("_at").alias("high")).first()
            mine = F.filter("ones", _between(bounds["low"], bounds["high"]))
            rows = rows.withColumn("_at", F.get(mine, offset)).join(broadcast_if_small(own), "_at", "left").drop("_at")
        return rows.drop("ones")


def _between(low: int | None, high: int | None):
    return lambda place: (place >= F.lit(low)) & (place <= F.lit(high))


def load_matrix(spark: SparkSession, folder: str) -> SavedMatrix:
    return SavedMatrix(
        load_encoder(spark, f"{folder}/encoder"),
        spark.read.parquet(f"{folder}/feature_names"),
        spark.read.parquet(f"{folder}/feature_matrix"),
    )


def onehot_rows(encoded: DataFrame, encoder: Encoder, known: DataFrame | None = None) -> DataFrame:
    """The one-hot part of the matrix as (invoice_id, feature) rows.

    With ``known`` (column_name, value), categories that are not in it give no row.
    """
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in encoder.categorical]
    rows = encoded.select("invoice_id", F.inline(F.array(*entries))).filter(F.col("value").isNotNull())
    if known is not None:
        rows = rows.join(known.distinct(), ["column_name", "value"], "left_semi")
    return rows.select("invoice_id", F.concat(F.lit("categorical__"), "column_name", F.lit("_"), "value").alias("feature"))


def categories(encoded: DataFrame, encoder: Encoder) -> DataFrame:
    """(column_name, value): every category that occurs."""
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in encoder.categorical]
    return encoded.select(F.inline(F.array(*entries))).filter(F.col("value").isNotNull()).distinct()


def save_encoder(spark: SparkSession, encoder: Encoder, path: str) -> None:
    """One row per column, in order."""
    rows = [(i, c, "numeric", encoder.fills[c], None, encoder.means[c], encoder.scales[c]) for i, c in enumerate(encoder.numeric)]
    start = len(rows)
    rows += [(start + i, c, "categorical", None, encoder.fills.get(c), None, None) for i, c in enumerate(encoder.categorical)]
    write_table(spark.createDataFrame(rows, ENCODER_SCHEMA), path)


def load_encoder(spark: SparkSession, path: str) -> Encoder:
    rows = spark.read.schema(ENCODER_SCHEMA).parquet(path).orderBy("position").collect()
    numeric = [r for r in rows if r["kind"] == "numeric"]
    categorical = [r for r in rows if r["kind"] == "categorical"]
    fills = {r["name"]: r["median"] for r in numeric}
    fills |= {r["name"]: r["most_frequent"] for r in categorical if r["most_frequent"] is not None}
    return Encoder(
        [r["name"] for r in numeric],
        [r["name"] for r in categorical],
        fills,
        {r["name"]: r["mean"] for r in numeric},
        {r["name"]: r["scale"] for r in numeric},
    )
