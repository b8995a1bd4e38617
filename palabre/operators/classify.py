"""Message classification and training of the classifier."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from palabre.functions.values import label_of
from palabre.schemas import MESSAGE_LABELS
from palabre.session import scratch, shared_dir

Scorer = Callable[[Column], Column]


def classify_messages(
    df: DataFrame,
    scorer: Scorer,
    text: str = "message",
    target: str = "type",
    labels: Sequence[str] = MESSAGE_LABELS,
) -> DataFrame:
    """Put the label with the highest score into ``target``.

    ``scorer`` turns the text column into an array with one score per label: an
    expression, or a vectorised function such as ``pandas_scorer`` gives.
    """
    return df.withColumn(target, label_of(scorer(F.col(text)), labels))


def pandas_scorer(load: Callable[[], Callable[[pd.Series], pd.Series]]) -> Scorer:
    """A scorer around a model that each Python worker loads once.

    ``load`` returns the model: a function from a batch of texts to a batch of
    score lists.
    """

    @F.pandas_udf(ArrayType(DoubleType()))
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            yield model(texts)

    return score


def train_classifier(
    labelled: DataFrame,
    text: str = "message",
    label: str = "type",
    labels: Sequence[str] = MESSAGE_LABELS,
    features: int = 1 << 16,
    max_iter: int = 20,
) -> PipelineModel:
    """Fit a text classifier on messages whose label is known; others are left out."""
    number = F.array_position(F.array(*[F.lit(name) for name in labels]), F.col(label))
    known = labelled.filter(F.col(text).isNotNull() & F.col(label).isin(*labels)).select(
        F.col(text), (number - 1).cast("double").alias("class")
    )
    words = RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"(?U)\W+")
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features)
    weights = IDF(inputCol="_counts", outputCol="_features")
    regression = LogisticRegression(
        featuresCol="_features",
        labelCol="class",
        predictionCol="_prediction",
        rawPredictionCol="_raw",
        probabilityCol="_scores",
        maxIter=max_iter,
    )
    # Both fits read the word counts: make them once.
    counted = counts.transform(words.transform(known)).select("class", "_counts")
    counted = counted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weighing = weights.fit(counted)
        fitted = regression.fit(weighing.transform(counted))
    finally:
        counted.unpersist()
    model = PipelineModel(stages=[words, counts, weighing, fitted])
    # A fitted regression holds on to its session by its training summary, which tasks can't be
    # sent once the session has observed metrics. What is read back has none.
    with scratch(labelled.sparkSession, "fit"):
        path = shared_dir(labelled.sparkSession, "model")
        model.write().save(path)
        return PipelineModel.load(path)


def classify_with_model(
    df: DataFrame,
    model: PipelineModel,
    text: str = "message",
    target: str = "type",
    labels: Sequence[str] = MESSAGE_LABELS,
) -> DataFrame:
    """Label messages with a trained classifier; a missing text counts as empty."""
    filled = df.withColumn("_text", F.col(text)).withColumn(
        text, F.coalesce(F.col(text), F.lit(""))
    )
    label = label_of(vector_to_array("_scores"), labels)
    labelled = model.transform(filled).withColumn(text, F.col("_text")).withColumn(target, label)
    added = [] if target in df.columns else [target]
    return labelled.select(*[F.col(f"`{c}`") for c in [*df.columns, *added]])
