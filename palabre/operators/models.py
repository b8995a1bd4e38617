"""Versions of the message classifier: trained, compared on held-out messages, promoted."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palabre.operators.classify import classify_with_model, train_classifier
from palabre.schemas import MESSAGE_LABELS
from palabre.sources.manifests import Manifest

#: Of so many parts of the labelled messages one is held out.
FOLDS = 5


def accuracy(model: PipelineModel, labelled: DataFrame, labels: Sequence[str] = MESSAGE_LABELS) -> float:
    """The mean over the labels of the share of their messages that the model labels right.

    A label with few messages counts like one with many; NaN without labelled messages.
    """
    known = labelled.filter(F.col("type").isin(*labels)).select("message", F.col("type").alias("_label"))
    judged = classify_with_model(known.withColumn("type", F.lit("")), model, labels=labels)
    shares = judged.groupBy("_label").agg(F.avg((F.col("type") == F.col("_label")).cast("double")).alias("share"))
    mean = shares.agg(F.avg("share")).first()[0]
    return float("nan") if mean is None else mean


@dataclass
class ModelStore:
    """Classifiers in a folder, and a manifest that names the one in use.

    ``train`` adds a version and promotes it if it does at least as well on held-out messages as
    the one in use does on the same. ``classify`` labels with the version in use: a running
    job that calls it for each batch follows a promotion from the next batch on.
    """

    spark: SparkSession
    path: str
    labels: Sequence[str] = tuple(MESSAGE_LABELS)
    _loaded: tuple[str, PipelineModel] | None = field(default=None, repr=False)

    @property
    def _manifest(self) -> Manifest:
        return Manifest(self.spark, f"{self.path}/_current")

    def current(self) -> str | None:
        """The name of the version in use."""
        return self._manifest.read()[1].get("model")

    def _model(self, name: str) -> PipelineModel:
        if self._loaded is None or self._loaded[0] != name:
            self._loaded = (name, PipelineModel.load(f"{self.path}/{name}"))
        return self._loaded[1]

    def promote(self, name: str, score: float | None = None) -> None:
        """Make a stored version the one in use, from the next batch of each job on."""
        version, old = self._manifest.read()
        self._manifest.replace({"model": name, "score": score, "before": old.get("model")}, version)

    def train(self, labelled: DataFrame, id_column: str = "id") -> tuple[str, bool, float]:
        """Fit a new version; its name, whether it was promoted, and its held-out accuracy.

        Messages are held out by a digest of their id, so the same ones are whenever it is
        trained again, and no version has seen them.
        """
        part = F.pmod(F.xxhash64(F.col(id_column).cast("string")), F.lit(FOLDS))
        model = train_classifier(labelled.filter(part != 0), labels=self.labels)
        name = f"model-{uuid.uuid4().hex}"
        model.write().save(f"{self.path}/{name}")
        held_out = labelled.filter(part == 0)
        score = accuracy(model, held_out, self.labels)
        current = self.current()
        better = current is None or not score < accuracy(self._model(current), held_out, self.labels)
        if better:
            self.promote(name, score)
        return name, better, score

    def classify(self, messages: DataFrame) -> DataFrame:
        """Label messages with the version in use now."""
        name = self.current()
        if name is None:
            raise ValueError(f"no model has been promoted in {self.path}")
        return classify_with_model(messages, self._model(name), labels=self.labels)
