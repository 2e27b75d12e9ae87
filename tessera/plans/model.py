"""The complaint classifier as a stored model: fit once, score anywhere.

A ``PipelineModel`` of four stages, each of which holds what was fitted:

    LexiconFeatures   words, idf and vector size: complaints -> feature vectors
    StringIndexerModel    label -> number (unseen labels get the next number)
    MultilayerPerceptronClassificationModel    features -> prediction
    IndexToString     prediction -> name of the label

``save`` writes it to a shared folder and ``load`` reads it back in any session
that can import this package. Scoring is row by row: it reads the new
complaints once, shuffles nothing and fits nothing, and also works on a stream.
Complaints without a valid record or any lexicon word have no features and get
no prediction.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import IndexToString
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import sampling
from tessera.plans import learn, text
from tessera.session import shared_path


class LexiconFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """complaints (doc_id, line) -> (doc_id, label_f, features, features_key)
    with a fitted vocabulary. The side of a split, if there, is kept."""

    words = Param(Params._dummy(), "words", "lexicon words by index", typeConverter=TypeConverters.toListString)
    idf = Param(Params._dummy(), "idf", "ln(N / df) by index", typeConverter=TypeConverters.toListFloat)
    size = Param(Params._dummy(), "size", "length of the feature vectors", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, words=None, idf=None, size=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def weights(self) -> text.Weights:
        return text.Weights(tuple(self.getOrDefault("words")), tuple(self.getOrDefault("idf")), self.getOrDefault("size"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = self.weights
        side = [c for c in dataset.columns if c == "split"]
        return text.feature_vectors(text.count_vectors(dataset, text.Lexicon(weights.words, 0), *side), weights, *side)

    def weigh(self, vectors: DataFrame) -> DataFrame:
        """What ``transform`` gives for the complaints whose words are counted
        in ``vectors`` (``Lexicon.fit_counts``), without their texts."""
        return text.feature_vectors(vectors, self.weights)


class Lexicon(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``LexiconFeatures`` on complaints: two passes over the texts."""

    size = Param(Params._dummy(), "size", "number of lexicon words", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, size=text.LEXICON_SIZE):
        super().__init__()
        self._set(**self._input_kwargs) if self._input_kwargs else self._set(size=size)

    def _fit(self, dataset: DataFrame) -> LexiconFeatures:
        return self._features(text.fitted_weights(dataset, self.getOrDefault("size")))

    def fit_counts(self, dataset: DataFrame) -> tuple[LexiconFeatures, DataFrame]:
        """``fit``, and the counts of the lexicon words it was fitted on, written
        to the shared folder: also two passes over the texts."""
        vectors, _, weights = text.fitted_counts(dataset, self.getOrDefault("size"))
        return self._features(weights), vectors

    @staticmethod
    def _features(weights: text.Weights) -> LexiconFeatures:
        return LexiconFeatures(words=list(weights.words), idf=list(weights.idf), size=weights.size)


def fit(complaints: DataFrame, k: int = text.LEXICON_SIZE, max_iter: int = learn.MAX_ITER) -> PipelineModel:
    """Fit all stages on the complaints: lexicon, then label index and
    perceptron on the distinct feature rows, which are written once."""
    spark = complaints.sparkSession
    features, counts = Lexicon(size=k).fit_counts(complaints)
    path = shared_path(spark, "model-features")
    features.weigh(counts).write.parquet(path)
    ds = learn.dataset(spark.read.parquet(path))
    if not ds.labels:
        raise ValueError("no complaint has a lexicon word: nothing to fit on")
    perceptron = learn.train_mlp(ds.rows.select("label", "features"), k, max(2, len(ds.labels)), max_iter=max_iter)
    indexer = learn.label_indexer(spark.read.parquet(path)).setHandleInvalid("keep")
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=[*ds.labels, *["?"] * (2 - len(ds.labels))])
    return PipelineModel(stages=[features, indexer, perceptron, names])


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(complaints: DataFrame, model: PipelineModel) -> DataFrame:
    """(doc_id, label_f, prediction, predicted) for complaints with features;
    and split, the side they are on, if the complaints have it."""
    side = [c for c in complaints.columns if c == "split"]
    return model.transform(complaints).select("doc_id", "label_f", "prediction", "predicted", *side)


def fit_split(complaints: DataFrame) -> DataFrame:
    """The complaints tagged 'train' or 'test' by a hash of the record."""
    return sampling.hash_split(complaints, ["line"], learn.TRAIN_FRACTION, learn.SPLIT_SEED)


def stored(spark: SparkSession, complaints: DataFrame, max_iter: int = learn.MAX_ITER) -> str:
    """Fit on the training side and store the model in the shared folder."""
    train = fit_split(complaints).where(F.col("split") == "train").drop("split")
    return save(fit(train, max_iter=max_iter), shared_path(spark, "model"))


def score_stored(complaints: DataFrame, path: str) -> DataFrame:
    """Every complaint scored by the stored model, with the side it was on:
    (doc_id, label_f, prediction, predicted, split); 'test' ones are new to it.
    One pass over the complaints."""
    return score(fit_split(complaints), load(path))
