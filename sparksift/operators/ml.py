"""The fast-path model: a logistic regression on character n-grams of hosts, or on words of texts, fitted to confirmed labels."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, NGram, RegexTokenizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .calibration import calibrated


def confirmed_labels(records: DataFrame, key: str, at: str) -> DataFrame:
    """The newest label of each key; of equal times the highest. A null time is older than all others, null keys go."""
    return records.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(at, "label"))["label"].alias("label"))


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "label", features: int | None = None, words: bool = False) -> PipelineModel:
    """On the distinct words of texts, or else on three characters each. Null texts count as empty in words. Raises if there is but one class.

    Score with a model that was saved and loaded: one just fitted holds the summary of its training, which goes into every task.
    """
    features = features or (1 << 18 if words else 1 << 14)
    classes = {r[0] for r in labelled.select(F.col(label_col).cast("double")).distinct().limit(3).collect()}
    if len(classes) < 2:
        raise ValueError(f"training needs two classes, there is {sorted(classes)}")
    if words:
        units = [
            SQLTransformer(statement=f"SELECT *, coalesce(`{text_col}`, '') AS _text FROM __THIS__"),
            RegexTokenizer(inputCol="_text", outputCol="_grams", pattern=r"[^\p{L}\p{N}]+", gaps=True, toLowercase=True),
        ]
    else:
        units = [RegexTokenizer(inputCol=text_col, outputCol="_chars", pattern="", gaps=True, toLowercase=True), NGram(n=3, inputCol="_chars", outputCol="_grams")]
    stages = [
        *units,
        HashingTF(inputCol="_grams", outputCol="_tf", numFeatures=features, binary=words),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=label_col, regParam=0.1 if words else 0.01, maxIter=20),
    ]
    return Pipeline(stages=stages).fit(labelled)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows with p, the probability of the label 1."""
    return model.transform(rows).withColumn("p", vector_to_array("probability")[1]).select(*rows.columns, "p")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fast_path(model: PipelineModel, blocks: DataFrame, pages: DataFrame, text_col: str = "host") -> DataFrame:
    """pages with p for the cascade's gate: the model's score, as the monotone fit (calibration.isotonic) of confirmed labels says it."""
    rows = predict(model, pages.withColumn("text", F.col(text_col)) if text_col != "text" else pages)
    scored = calibrated(rows, "p", blocks).drop("p").withColumnRenamed("calibrated", "p")
    return scored.select(*pages.columns, "p")
