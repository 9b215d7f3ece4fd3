"""Direction classifiers with MLlib: boosting, forest and a network over feature sequences."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.series import LENGTH, POS
from marketloom.plans.features import FEATURES, training_samples, with_sequences
from marketloom.plans.forecast import adaptive_weights, choose_threshold, threshold_table
from marketloom.session import staged, work_root

SEED = 42
SEQUENCE_STEPS = 10
TRAIN_SHARE = 0.8


def time_split(samples: DataFrame, share: float = TRAIN_SHARE, horizon: int = 3) -> DataFrame:
    """Mark the first ``share`` of each series as training rows; no shuffle, the position is known.

    The ``horizon`` rows before the cut are left out: their labels lie behind it.
    """
    cut = F.floor(F.col(LENGTH) * share)
    outside = (F.col(POS) < cut - horizon) | (F.col(POS) >= cut)
    return samples.filter(outside).withColumn("is_train", F.col(POS) < cut)


def hash_split(samples: DataFrame, keys: list[str], share: float = TRAIN_SHARE, seed: int = SEED) -> DataFrame:
    """A seeded random split that does not depend on partitioning."""
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(1000))
    return samples.withColumn("is_train", bucket < int(share * 1000))


def class_weights(samples: DataFrame) -> DataFrame:
    """n / (2 n_c) per class."""
    counts = staged(samples.groupBy("label").agg(F.count(F.lit(1)).alias("n_class")), "classes")
    total = counts.agg(F.sum("n_class").alias("t")).scalar()
    return counts.withColumn("weight", total / (F.lit(2.0) * F.col("n_class")))


def training_set(features: DataFrame, lookback: int = 30, horizon: int = 3) -> DataFrame:
    """Samples of all assets with vector columns for the tabular and the sequence voters."""
    samples = training_samples(with_sequences(features, steps=SEQUENCE_STEPS), lookback, horizon)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    rows = vectors.transform(samples).withColumn("window", array_to_vector("sequence")).drop("sequence")
    return time_split(rows, horizon=horizon)


def samples_by_asset(samples: DataFrame) -> DataFrame:
    return samples.groupBy("coin_id").agg(
        F.count(F.lit(1)).alias("samples"), F.avg("label").alias("share_up")
    )


def boosting(n: int) -> GBTClassifier:
    """Shallow, slow boosting with early stopping, sized by the number of training rows."""
    return GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        predictionCol="gb_pred",
        maxDepth=3,
        stepSize=0.05,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.7",
        minInstancesPerNode=max(5, n // 50),
        maxIter=min(200, max(50, n // 3)),
        validationIndicatorCol="is_holdout",
        seed=SEED,
    ).setProbabilityCol("gb_vec").setRawPredictionCol("gb_raw")


def forest(n: int) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        predictionCol="rf_pred",
        probabilityCol="rf_vec",
        rawPredictionCol="rf_raw",
        maxDepth=5,
        numTrees=min(300, max(100, n // 2)),
        featureSubsetStrategy="sqrt",
        minInstancesPerNode=max(5, n // 50),
        seed=SEED,
    )


def network() -> MultilayerPerceptronClassifier:
    """The third voter: a small network over the scaled ten-step window."""
    return MultilayerPerceptronClassifier(
        featuresCol="window_scaled",
        labelCol="label",
        predictionCol="lstm_pred",
        probabilityCol="lstm_vec",
        rawPredictionCol="lstm_raw",
        layers=[SEQUENCE_STEPS * len(FEATURES), 64, 2],
        maxIter=100,
        seed=SEED,
    )


def fit_voters(spark: SparkSession, samples: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Fit the three voters on the training rows; returns the model and the staged samples.

    The samples are written once to the shared folder, because every boosting round reads them
    again and a recomputation after a lost executor would repeat the whole feature plan.
    """
    spark.sparkContext.setCheckpointDir(work_root(spark))
    stored = staged(samples, "samples")
    train = stored.filter("is_train")
    weights = staged(class_weights(train).select("label", "weight"), "weights")
    holdout = F.pmod(F.xxhash64("coin_id", POS), F.lit(100)) < 15
    train = train.join(weights, "label").withColumn("is_holdout", holdout)
    n = train.count()
    scaler = StandardScaler(inputCol="window", outputCol="window_scaled", withMean=True).fit(train)
    stages = [
        boosting(n).fit(train),
        forest(n).fit(train),
        scaler,
        network().fit(scaler.transform(train)),
    ]
    return PipelineModel(stages), stored


def vote(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the probability of a rise from each voter."""
    scored = model.transform(rows)
    return scored.withColumns(
        {f"{v}_prob": vector_to_array(f"{v}_vec")[1] for v in ("gb", "rf", "lstm")}
    ).drop(*[f"{v}_{part}" for v in ("gb", "rf", "lstm") for part in ("vec", "raw", "pred")], "window_scaled")


def voter_accuracy(votes: DataFrame) -> DataFrame:
    """Validation accuracy per voter, one row each."""
    wide = votes.agg(
        *[
            F.avg(((F.col(f"{v}_prob") > 0.5).cast("double") == F.col("label")).cast("double")).alias(v)
            for v in ("gb", "rf", "lstm")
        ]
    )
    return wide.unpivot([], ["gb", "rf", "lstm"], "voter", "accuracy")


def feature_importance(model: PipelineModel, spark: SparkSession, top: int = 5) -> DataFrame:
    """The most important features of the boosted trees (one value per feature)."""
    values = [(name, float(v)) for name, v in zip(FEATURES, model.stages[0].featureImportances.toArray())]
    return spark.createDataFrame(values, "feature string, importance double").orderBy(F.desc("importance")).limit(top)


def evaluate(votes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Weights, threshold table and chosen threshold from validation votes."""
    from marketloom.plans.forecast import blend

    weights = adaptive_weights(voter_accuracy(votes))
    by_voter = {r["voter"]: r["weight"] for r in weights.collect()}
    table = threshold_table(blend(votes, by_voter))
    return weights, table, choose_threshold(table)


def save(model: PipelineModel, path: str, weights: DataFrame, threshold: DataFrame) -> None:
    """Model stages, the weights (with the accuracy of each voter) and threshold tables, the feature order."""
    model.write().overwrite().save(f"{path}/model")
    weights.write.mode("overwrite").parquet(f"{path}/weights")
    threshold.write.mode("overwrite").parquet(f"{path}/threshold")
    order = weights.sparkSession.createDataFrame(list(enumerate(FEATURES)), "position int, feature string")
    order.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """What :func:`save` wrote; features in another order than the model was fitted on are an error."""
    order = [r["feature"] for r in spark.read.parquet(f"{path}/features").orderBy("position").collect()]
    if order != FEATURES:
        raise ValueError(f"the model was fitted on {order}")
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/weights"), spark.read.parquet(f"{path}/threshold")


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Sample sets of several sources under each other, with a source column."""
    parts = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, parts)
