"""The text classifier as stages of an ML ``Pipeline`` that can be saved and loaded.

``TextClassifierStage`` is the estimator; its model ``TextScorer`` holds vocabulary, idf and weights
as a table. A small table scores inside the row, so it also works on streams; a larger one is joined. A saved stage is a folder with
the usual metadata record and the weight table as Parquet.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgsift.functions.labels import DEFAULT_LABELS
from msgsift.operators import classify as CL
from msgsift.operators.features import with_terms


class _Columns(Params):
    textCol = Param(Params._dummy(), "textCol", "text column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "predicted label", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "probability of the positive class", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(textCol="text", predictionCol="predicted_label", probabilityCol="spam_probability")


class TextScorer(Model, _Columns, MLReadable, MLWritable):
    """Adds the predicted label and the probability of the positive class to every row."""

    def __init__(self, classifier: CL.TextClassifier | None = None):
        super().__init__()
        self.classifier = classifier

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text, label, p = (self.getOrDefault(c) for c in ("textCol", "predictionCol", "probabilityCol"))
        if CL.fits_in_row(self.classifier):
            terms = "_scorer_terms"
            rows = with_terms(dataset, text_col=text, out=terms)
            margin = CL.margin_in_row(self.classifier, F.col(terms))
            rows = rows.withColumn(p, CL.probability(margin)).drop(terms)
        elif dataset.isStreaming:
            raise CL.ModelError(f"the weight table has more than {CL.IN_ROW_TERMS} terms; score the stream by stream_score")
        else:
            rows = CL.with_margin(self.classifier, dataset, text, "_scorer_margin")
            rows = rows.withColumn(p, CL.probability(F.col("_scorer_margin"))).drop("_scorer_margin")
        positive, negative = self.classifier.positive, self.classifier.negative
        return rows.withColumn(label, F.when(F.col(p) > 0.5, F.lit(positive)).otherwise(F.lit(negative)))

    def write(self) -> MLWriter:
        return _ScorerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ScorerReader(cls)


class _ScorerWriter(MLWriter):
    def __init__(self, stage: TextScorer):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        clf = self.stage.classifier
        extra = {"model": {"intercept": clf.intercept, "labels": list(clf.labels), "positive": clf.positive}}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata=extra)
        clf.weights.write.parquet(f"{path}/weights")


class _ScorerReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TextScorer:
        try:
            metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
            weights = self.sparkSession.read.parquet(f"{path}/weights")
        except Exception as exc:  # noqa: BLE001
            raise CL.ModelError(f"no readable stage at {path}") from exc
        stage = self.cls(CL.checked_model(weights, metadata.get("model") or {}, path))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class TextClassifierStage(Estimator, _Columns):
    """Fits the classifier on rows (row_id, label, text)."""

    minDF = Param(Params._dummy(), "minDF", "least number of rows that hold a term", TypeConverters.toInt)
    positive = Param(Params._dummy(), "positive", "the positive label", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, textCol="text", predictionCol="predicted_label", probabilityCol="spam_probability", minDF=2, positive="spam"):
        super().__init__()
        self._setDefault(minDF=2, positive="spam")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TextScorer:
        rows = dataset.select("row_id", "label", F.col(self.getOrDefault("textCol")).alias("text"))
        model = TextScorer(CL.fit_classifier(rows, positive=self.getOrDefault("positive"), labels=DEFAULT_LABELS,
                                             min_df=self.getOrDefault("minDF")))
        return self._copyValues(model)
