"""Classification of samples by features: labels, features, folds, random forests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamframe.operators import expression as X


def binary_labels(metadata: DataFrame, column: str, positive: str | None = None, negative: str | None = None) -> DataFrame:
    """``sample`` and ``label`` (0 or 1): of the two groups named, or else of exactly two values in order."""
    value = F.col(column).cast("string")
    if positive is not None and negative is not None:
        return metadata.where(value.isin(positive, negative)).select("sample", (value == positive).cast("int").alias("label"))
    levels = [r[0] for r in metadata.select(value.alias("v")).distinct().orderBy("v").limit(3).collect()]
    if len(levels) != 2:
        raise ValueError(f"{column} needs two values, or name the two groups")
    return metadata.select("sample", (value == levels[1]).cast("int").alias("label"))


def features(values: DataFrame, samples: int, least_prevalence: float = 0.0, least_variance: float = 0.0, log: bool = True, scale: bool = False) -> DataFrame:
    """Feature values (``gene``, ``sample``, ``v``), filtered and scaled, in long form; missing cells are zeros.

    Rare and near-constant features go; with ``scale`` values become z-scores over
    all ``samples``, whose zero then is minus mean over deviation, in ``zero``.
    """
    v = F.log1p("n") if log else F.col("n").cast("double")
    rows = values.withColumn("v", v)
    k = F.count("v")
    mean = F.sum("v") / samples
    var = (k * F.var_pop("v") + k * (F.avg("v") - mean) * (F.avg("v") - mean) + (samples - k) * mean * mean) / samples
    stats = rows.groupBy("gene").agg(F.count_if(F.col("v") != 0).alias("held"), mean.alias("mean"), var.alias("var"))
    good = stats.where((F.col("held") / samples >= least_prevalence) & ((F.col("var") > least_variance) if least_variance > 0 else F.lit(True)))
    sd = F.when(F.col("var") > 0, F.sqrt("var")).otherwise(1.0)
    scaled = (lambda c: (c - F.col("mean")) / sd) if scale else (lambda c: c)
    return rows.join(good, "gene").select("gene", "sample", scaled(F.col("v")).alias("v"), scaled(F.lit(0.0)).alias("zero"))


def folds(labels: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """Add ``fold`` (0 to k - 1): labels spread evenly, in the order of a hash."""
    order = W.partitionBy("label").orderBy(F.xxhash64("sample", F.lit(seed)), "sample")
    return labels.withColumn("fold", ((F.row_number().over(order) - 1) % k).cast("int"))


def feature_vectors(values: DataFrame, labels: DataFrame) -> tuple[DataFrame, list]:
    """(rows of ``sample``, ``label`` and ``features``, names of the features in order)."""
    from pyspark.ml.functions import array_to_vector

    listed = values.groupBy("gene").agg(F.first("zero").alias("zero")).orderBy("gene").collect()  # a row a feature that is left
    names = [r["gene"] for r in listed]
    held = values.groupBy("sample").agg(F.map_from_entries(F.collect_list(F.struct("gene", "v"))).alias("m"))
    order = F.array(*[F.struct(F.lit(r["gene"]).alias("gene"), F.lit(float(r["zero"])).alias("zero")) for r in listed])
    vector = array_to_vector(F.transform(order, lambda x: F.coalesce(F.try_element_at("m", x["gene"]), x["zero"])))
    rows = labels.join(held, "sample", "left").withColumn("m", F.coalesce("m", F.create_map().cast(held.schema["m"].dataType)))
    return rows.withColumn("features", vector).drop("m"), names


def forest_cross_validation(rows: DataFrame, names: list, k: int = 5, trees: int = 1000, depth: int = 10, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(predictions of every sample by the fold that left it out, metrics of every fold, importances of every fold).

    ``rows``: ``sample``, ``label``, ``features``, ``fold``.  Classes weigh alike.
    One fit a fold, each a distributed job.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import vector_to_array

    spark = rows.sparkSession
    rows = rows.withColumn("label", F.col("label").cast("double")).cache()
    predicted, metrics, importances = None, [], []
    kind = "long" if all(isinstance(n, int) for n in names) else "string"
    for fold in range(k):
        train, test = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        sizes = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
        total = sum(sizes.values())
        weight = F.lit(1.0)
        for label, n in sizes.items():
            weight = F.when(F.col("label") == label, total / (len(sizes) * n)).otherwise(weight)
        model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed + fold + 1, weightCol="weight").fit(train.withColumn("weight", weight))
        out = model.transform(test)
        scored = out.select("sample", "label", F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("score"), F.lit(fold).alias("fold"))
        predicted = scored if predicted is None else predicted.unionByName(scored)
        both = test.select("label").distinct().count() == 2
        auc = BinaryClassificationEvaluator().evaluate(out) if both else None
        right, tested = scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")), F.count(F.lit(1))).first()
        metrics.append((fold, right, auc, total, tested))
        importances += [(fold, n, float(x)) for n, x in zip(names, model.featureImportances.toArray().tolist(), strict=True)]
    return predicted, spark.createDataFrame(metrics, "fold int, accuracy double, roc_auc double, n_train long, n_test long"), spark.createDataFrame(importances, f"fold int, gene {kind}, importance double")


def confusion(predictions: DataFrame) -> DataFrame:
    """Samples of every label and prediction, over all folds."""
    return predictions.groupBy(F.col("label").cast("int").alias("label"), "prediction").agg(F.count(F.lit(1)).alias("samples"))


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """Mean and population deviation of the folds' metrics; what a fold lacks is left out."""
    one = lambda c: X.number(F.col(c))
    return metrics.agg(*[f(one(c)).alias(f"{k}_{c}") for c in ("accuracy", "roc_auc") for k, f in (("mean", F.avg), ("std", F.stddev_pop))])


def mean_importance(importances: DataFrame) -> DataFrame:
    """Importance of every feature, the mean over folds."""
    return importances.groupBy("gene").agg(F.avg("importance").alias("importance"))


def top_importances(importances: DataFrame, most: int = 100) -> DataFrame:
    """The ``most`` features of greatest importance; ties by name."""
    return importances.orderBy(F.desc("importance"), "gene").limit(most)
