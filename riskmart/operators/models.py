"""Weighted classifiers from MLlib, and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.config import RiskConfig
from riskmart.session import shared_dir

INDEX_SUFFIX = "__index"
#: training rows that one task of a fit holds in the cache
FIT_ROWS = 250_000


def index_categories(categorical: Sequence[str]) -> list[StringIndexer]:
    """One indexing stage for all columns; levels unseen in training get a bucket of their own."""
    if not categorical:
        return []
    return [
        StringIndexer(
            inputCols=list(categorical),
            outputCols=[c + INDEX_SUFFIX for c in categorical],
            handleInvalid="keep",
        )
    ]


def assemble_vector(numeric: Sequence[str], categorical: Sequence[str], target: str = "features") -> VectorAssembler:
    inputs = [*numeric, *[c + INDEX_SUFFIX for c in categorical]]
    return VectorAssembler(inputCols=inputs, outputCol=target, handleInvalid="keep")


def scale_vector(source: str = "features", target: str = "scaled") -> StandardScaler:
    """Unit variance, no centring."""
    return StandardScaler(inputCol=source, outputCol=target)


def baseline_stages(numeric: Sequence[str], categorical: Sequence[str], label: str, weight: str, cfg: RiskConfig) -> Pipeline:
    regression = LogisticRegression(
        featuresCol="scaled", labelCol=label, weightCol=weight,
        maxIter=cfg.baseline_iterations, regParam=cfg.baseline_reg,
    )
    return Pipeline(stages=[*index_categories(categorical), assemble_vector(numeric, categorical), scale_vector(), regression])


def gbt_stages(numeric: Sequence[str], categorical: Sequence[str], label: str, weight: str, cfg: RiskConfig) -> Pipeline:
    trees = GBTClassifier(
        labelCol=label, weightCol=weight, maxIter=cfg.trees, maxDepth=cfg.tree_depth, maxBins=cfg.max_bins,
        stepSize=cfg.step_size, subsamplingRate=cfg.subsampling, seed=cfg.seed, checkpointInterval=10,
    )
    return Pipeline(stages=[*index_categories(categorical), assemble_vector(numeric, categorical), trees])


def _shared_checkpoints(df: DataFrame) -> None:
    # boosting cuts its lineage every ten trees, provided there is a folder to cut it to
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))


def spread(df: DataFrame) -> DataFrame:
    """The rows over at least one partition a core, and more where those would be large.

    A fit caches its input and goes over it hundreds of times, each as wide as it has partitions; a compressed table is read in few.
    """
    rows = df.count()
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FIT_ROWS)))


def train_baseline(df: DataFrame, numeric, categorical, label: str, weight: str, cfg: RiskConfig) -> PipelineModel:
    return baseline_stages(numeric, categorical, label, weight, cfg).fit(spread(df))


def train_gbt(df: DataFrame, numeric, categorical, label: str, weight: str, cfg: RiskConfig) -> PipelineModel:
    _shared_checkpoints(df)
    return gbt_stages(numeric, categorical, label, weight, cfg).fit(spread(df))


def class_probability(probability: Column | str = "probability") -> Column:
    """Probability of class 1."""
    return vector_to_array(F.col(probability) if isinstance(probability, str) else probability)[1]


def with_score(model: Transformer, df: DataFrame, target: str = "score", digits: int = 4) -> DataFrame:
    """Score rows and round once; every consumer reads this one column."""
    return model.transform(df).withColumn(target, F.round(class_probability(), digits))


def flag_alerts(scored: DataFrame, threshold: float | Column, score: str = "score", target: str = "alert") -> DataFrame:
    """True from the threshold on; a score that is NaN never alerts."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    value = F.col(score).cast("double")
    return scored.withColumn(target, (value >= limit) & ~F.isnan(value))


def score_table(model: Transformer, features: DataFrame, keep: Sequence[str], threshold: float) -> DataFrame:
    """Kept columns, rounded score, alert flag."""
    return flag_alerts(with_score(model, features).select(*keep, "score"), threshold)


def feature_importance(model: PipelineModel, df: DataFrame, top: int = 20) -> DataFrame:
    """The most important inputs under their original names. One row per feature at most."""
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n.removesuffix(INDEX_SUFFIX), float(w)) for n, w in zip(names, weights)]
    listed = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    ranked = listed.orderBy(F.col("importance").desc(), "feature").limit(top)
    return ranked.select("feature", F.round("importance", 4).alias("importance"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
