"""Linear power model: train, report, save, load, score."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from meterlake import schemas
from meterlake.operators import clean
from meterlake.sources.files import read_compacted_lake


def train(readings: DataFrame) -> PipelineModel | None:
    """Fit power on voltage, current, power factor and frequency; None without usable rows.

    The solver sums the normal equations on the executors in one pass; only a matrix of
    feature-count size reaches the driver.
    """
    rows = clean.training_rows(readings)
    if rows.isEmpty():
        return None
    assembler = VectorAssembler(inputCols=schemas.FEATURES, outputCol="features")
    regression = LinearRegression(featuresCol="features", labelCol=schemas.LABEL)
    return Pipeline(stages=[assembler, regression]).fit(rows)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel | None:
    """The saved model, or None if there is none yet."""
    try:
        return PipelineModel.load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Actual and predicted power of complete rows, batch or stream."""
    return model.transform(clean.scoring_rows(features)).select(
        "meter_id", "event_time", "actual_power", F.col("prediction").alias("predicted_power")
    )


def train_report(model: PipelineModel, readings: DataFrame) -> DataFrame:
    """Terms of the fitted model and its quality on the training rows, as term and value.

    A feature with a single value has no coefficient of its own: the fit may give it any,
    and shifts the intercept to match. `level` is the intercept together with the share of
    such features, which is well defined; a constant feature's own value is NULL.
    """
    regression = model.stages[-1]
    weights = dict(zip(schemas.FEATURES, (float(c) for c in regression.coefficients)))
    label, guess = F.col(schemas.LABEL), F.col("prediction")
    facts = model.transform(clean.training_rows(readings)).agg(
        F.count("*").alias("rows"),
        F.avg((label - guess) * (label - guess)).alias("mse"),
        F.var_pop(label).alias("variance"),
        *(F.min(c).alias(f"min_{c}") for c in schemas.FEATURES),
        *(F.max(c).alias(f"max_{c}") for c in schemas.FEATURES),
    )
    varies = {c: F.col(f"min_{c}") < F.col(f"max_{c}") for c in schemas.FEATURES}
    level = F.lit(float(regression.intercept))
    for name, weight in weights.items():
        share = F.lit(weight) * F.col(f"min_{name}")
        level = level + F.when(varies[name], F.lit(0.0)).otherwise(share)
    terms = {
        **{c: F.when(varies[c], F.lit(w)) for c, w in weights.items()},
        "level": level,
        "rmse": F.sqrt("mse"),
        "r2": 1 - F.col("mse") / F.col("variance"),
        "rows": F.col("rows").cast("double"),
    }
    return facts.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(name).alias("term"), value.alias("value"))
                    for name, value in terms.items()
                )
            )
        )
    )


def train_and_save(
    spark: SparkSession, lake_path: str, model_path: str, compacted: str | None = None
) -> PipelineModel | None:
    """Train on the whole lake and replace the saved model."""
    model = train(read_compacted_lake(spark, lake_path, compacted))
    if model is not None:
        save(model, model_path)
    return model
