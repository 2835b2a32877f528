"""Text to vectors, and vectors to few dimensions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import constant_strings, each


def word_codes(tokens: Column | str, dims: int) -> Column:
    """For each word 2 x bucket + sign, taken from its MD5 digest."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens

    def code(word: Column) -> Column:
        number = F.conv(F.substr(F.md5(word), F.lit(1), F.lit(8)), 16, 10).cast("long")
        return (number % (2 * dims)).cast("int")

    return F.transform(tokens, code)


def hashed_embedding(tokens: Column | str, dims: int = 384) -> Column:
    """Signed hashed bag of words of unit length; a text without words gives the zero vector.

    Row by row without a shuffle: words are hashed in the JVM, the counting is one bincount per
    Arrow batch.
    """
    @F.pandas_udf("array<float>")
    def count(codes: pd.Series) -> pd.Series:
        lengths = codes.map(len).to_numpy()
        flat = np.concatenate(codes.to_list()).astype(np.int64) if lengths.sum() else np.empty(0, np.int64)
        rows = np.repeat(np.arange(len(codes)), lengths)
        signs = np.where(flat % 2 == 1, 1.0, -1.0)
        sums = np.bincount(rows * dims + flat // 2, weights=signs, minlength=len(codes) * dims)
        sums = sums.astype(np.float64).reshape(len(codes), dims)  # without any word bincount counts in integers
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        unit = np.divide(sums, norms, out=np.zeros_like(sums), where=norms > 0)
        return pd.Series(list(unit.astype(np.float32)))

    return count(word_codes(tokens, dims))


def encode_with(docs: DataFrame, key: str, text: str,
                load: Callable[[], Callable[[Sequence[str]], np.ndarray]], batch_size: int = 32) -> DataFrame:
    """(key, embedding) by a user's encoder, which ``load`` brings up once per task."""
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, embedding array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load()
        for batch in batches:
            for start in range(0, len(batch), batch_size):
                part = batch.iloc[start:start + batch_size]
                vectors = np.asarray(encode(part[text].fillna("").tolist()), dtype=np.float32)
                yield pd.DataFrame({key: part[key].to_numpy(), "embedding": list(vectors)})

    return docs.select(key, text).mapInPandas(run, schema)


def fit_reduction(vectors: DataFrame, embedding: str = "embedding", components: int = 5) -> PipelineModel:
    """A linear reduction: unit length, then principal components. Only the covariance matrix, whose
    size depends on the vector width alone, reaches the driver."""
    features = vectors.select(array_to_vector(F.col(embedding)).alias("_features"))
    return Pipeline(stages=[Normalizer(inputCol="_features", outputCol="_unit"),
                            PCA(k=components, inputCol="_unit", outputCol="_reduced")]).fit(features)


def reduce_dims(model: PipelineModel, vectors: DataFrame, embedding: str = "embedding",
                out: str = "coords") -> DataFrame:
    """Vectors with their coordinates in the reduced space."""
    features = vectors.withColumn("_features", array_to_vector(F.col(embedding)))
    return (model.transform(features).withColumn(out, vector_to_array("_reduced"))
            .drop("_features", "_unit", "_reduced"))


def join_vectors(docs: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """Documents with their vectors, by key and not by row position."""
    return docs.join(vectors, key)


def fit_text_vectors(docs: DataFrame, tokens: str, min_df: float = 0.05, most_terms: int = 1 << 18) -> PipelineModel:
    """A fitted Spark ML pipeline: term counts over the vocabulary of terms in at least ``min_df`` of the documents
    (a count from 1 on), IDF log((m + 1) / (df + 1)), unit length. Save and load it as any PipelineModel.

    ``most_terms`` bounds the vocabulary, which every task holds; it is meant to exceed the terms that pass ``min_df``,
    so that the vocabulary does not depend on ties at the cut.
    """
    from pyspark.ml.feature import IDF, CountVectorizerModel

    # the terms come from aggregates: CountVectorizer would hold the words of all documents in the executors' memory
    in_docs = docs.select(F.explode(F.array_distinct(tokens)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    least = min_df if min_df >= 1 else min_df * docs.count()
    counts = docs.select(F.explode(each(tokens)).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    terms = in_docs.where(F.col("df") >= least).join(counts, "term").orderBy(F.desc("n"), "term").limit(most_terms)
    vocabulary = [r["term"] for r in terms.select("term").collect()]
    stages = [CountVectorizerModel.from_vocabulary(vocabulary, inputCol=tokens, outputCol="_tf"),
              IDF(inputCol="_tf", outputCol="_tfidf"), Normalizer(inputCol="_tfidf", outputCol="_unit", p=2.0)]
    return Pipeline(stages=stages).fit(docs.select(tokens))


def text_vectors(model: PipelineModel, docs: DataFrame, tokens: str, output: str = "embedding") -> DataFrame:
    """The documents with the fitted vector as ``array<float>`` (one place per vocabulary term); for ``encode``."""
    return model.transform(docs).withColumn(output, vector_to_array("_unit", "float32")).drop("_tf", "_tfidf", "_unit")


def vector_terms(model: PipelineModel, vectors: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """(key, term, weight) of the non-zero places of fitted vectors. The vocabulary is a constant of the plan: a join by
    place would send all rows of a frequent term to one task."""
    terms = constant_strings(model.stages[0].vocabulary)
    places = vectors.select(key, F.posexplode(vector).alias("place", "weight")).where(F.col("weight") != 0)
    return places.select(key, F.get(terms, F.col("place")).alias("term"), F.col("weight").cast("double").alias("weight"))
