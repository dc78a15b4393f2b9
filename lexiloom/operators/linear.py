"""Logistic regression on hashed, weighted token counts, fitted by MLlib."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from lexiloom.config import MAX_EPOCHS, WEIGHT_DECAY
from lexiloom.functions.vectors import round_scores

# The coefficients, outputs x features, travel through the driver in every iteration.
FEATURES = 1 << 14


def train_linear(
    examples: DataFrame,
    features: int = FEATURES,
    weight_decay: float = WEIGHT_DECAY,
    max_epochs: int = MAX_EPOCHS,
) -> PipelineModel:
    """Fit a fresh model on (text, label); weight decay is the L2 penalty, epochs the iteration limit."""
    pipeline = Pipeline(stages=[
        SQLTransformer(statement="SELECT *, array_remove(split(lower(text), ' '), '') AS _tokens FROM __THIS__"),
        HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=features),
        IDF(inputCol="_counts", outputCol="_features"),
        LogisticRegression(
            featuresCol="_features", labelCol="label", regParam=weight_decay, maxIter=max_epochs,
            rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_prediction",
        ),
    ])
    return pipeline.fit(examples.select("text", "label"))


def train_linear_grid(examples: DataFrame, weight_decays: list[float], threads: int = 4, **kwargs) -> dict:
    """Fit one model per weight decay at the same time."""
    with ThreadPoolExecutor(threads) as pool:
        fitted = pool.map(lambda w: train_linear(examples, weight_decay=w, **kwargs), weight_decays)
        return dict(zip(weight_decays, fitted))


def score_linear(df: DataFrame, model: PipelineModel) -> DataFrame:
    scored = model.transform(df)
    return scored.select(*df.columns, round_scores(vector_to_array("_probability")).alias("probabilities"))
