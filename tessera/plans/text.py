"""Complaint text -> lexicon -> TF-IDF features.

Every step is a DataFrame transformation over the complete texts:

    complaints(doc_id, line)
      -> valid records (exactly 3 fields, comment present, date "201...")
      -> cleaned text -> tokens (posexplode, one row per word)
      -> word counts without stop words -> lexicon (top 50, ties by word)
      -> per record: tf of its lexicon words, inside the row
      -> df per word -> idf = ln(N / df)
      -> double-normalised tf (0.5 + 0.5 tf / max tf of the doc)
      -> weight = tf_norm * idf -> one 50-wide feature vector per document

N counts every valid record, also those without any lexicon word; those
documents then have no feature row.

A document is one row, so tf, max tf, weights and the vector need no shuffle:
only word counts (one row per distinct word and task) and document
frequencies (one vector per task) are aggregated across the cluster. The
lexicon, k words, is fitted first; it reaches the rows as a hash dictionary
(``CountVectorizerModel``) and the idf values as a literal.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.predicates import valid_record
from tessera.functions.text import clean_text, field, is_stop_word, words
from tessera.operators import groups
from tessera.session import shared_path

LEXICON_SIZE = 50
WEIGHT_DECIMALS = 6
# Marks the one row per record that carries N through the word aggregation;
# cleaned words are [a-z]+ only, so it can never be a real word.
RECORD_MARKER = "#"


def valid_records(complaints: DataFrame, *carried: str) -> DataFrame:
    """(doc_id, label, comment) of the usable raw records, and the carried
    columns."""
    return complaints.where(valid_record("line")).select(
        "doc_id", field("line", 1).alias("label"), field("line", 2).alias("comment"), *carried
    )


def cleaned(complaints: DataFrame, *carried: str) -> DataFrame:
    return valid_records(complaints, *carried).select("doc_id", "label", clean_text("comment").alias("clean"), *carried)


def tokens(complaints: DataFrame) -> DataFrame:
    """One row per word position: (doc_id, label, pos, word)."""
    return cleaned(complaints).select(
        "doc_id", "label", F.posexplode(words("clean")).alias("pos", "word")
    )


def content_tokens(complaints: DataFrame) -> DataFrame:
    """Tokens that are not stop words: (doc_id, pos, word)."""
    return tokens(complaints).where(~is_stop_word("word")).select("doc_id", "pos", "word")


def marked_tokens(complaints: DataFrame) -> DataFrame:
    """(doc_id, label, word): every non-stop word of every valid record, plus
    one row per record with the word ``RECORD_MARKER``, which lets N come
    out of the word counts."""
    exploded = F.explode(F.concat(F.array(F.lit(RECORD_MARKER)), words("clean")))
    tok = cleaned(complaints).select("doc_id", "label", exploded.alias("word"))
    return tok.where(~is_stop_word("word"))


def vocabulary(complaints: DataFrame) -> DataFrame:
    """(word, n): occurrences per word; the marker row carries N.

    Pass 1 over the texts. Keyed by the word alone, the partial aggregate
    leaves one row per distinct word per task, so this shuffle stays small
    however large the texts are.
    """
    return marked_tokens(complaints).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count(complaints: DataFrame) -> DataFrame:
    """(word, n) over all valid records, stop words excluded."""
    return vocabulary(complaints).where(F.col("word") != RECORD_MARKER).select("word", "n")


def top_k_words(complaints: DataFrame, k: int = LEXICON_SIZE) -> DataFrame:
    """The k most frequent words; equal counts are ordered by the word."""
    return groups.top_k(word_count(complaints), k, [F.desc("n"), F.asc("word")])


def _ranked(complaints: DataFrame, k: int) -> DataFrame:
    """(idx, word, n, n_records) for the top-k words.

    The marker row (N) is taken along with the k best words, so both
    windows here run over k + 1 rows; it ranks first (idx -1) and is
    dropped by rank.
    """
    is_marker = F.col("word") == RECORD_MARKER
    marker_first = [is_marker.desc(), F.desc("n"), F.asc("word")]
    top = groups.top_k(vocabulary(complaints), k + 1, marker_first)
    ranked = top.select(
        (F.row_number().over(Window.orderBy(*marker_first)) - 2).alias("idx"),
        "word",
        "n",
        F.max(F.when(is_marker, F.col("n"))).over(Window.partitionBy()).alias("n_records"),
    )
    return ranked.where(F.col("idx") >= 0)


def lexicon(complaints: DataFrame, k: int = LEXICON_SIZE) -> DataFrame:
    """(idx, word, n): the top-k words numbered 0..k-1 in rank order."""
    return _ranked(complaints, k).select("idx", "word", "n")


def lexicon_tokens(complaints: DataFrame, k: int = LEXICON_SIZE) -> DataFrame:
    """Tokens that belong to the lexicon, with their index:
    (doc_id, label, pos, word, idx). The lexicon has at most k rows, so it
    is broadcast; the token side is never shuffled for this join."""
    lex = lexicon(complaints, k).select("word", "idx")
    return tokens(complaints).join(F.broadcast(lex), "word").select(
        "doc_id", "label", "pos", "word", "idx"
    )


@dataclass(frozen=True)
class Lexicon:
    """The ranked words of ``lexicon`` and the number of valid records: k
    strings, the user's bound on the vocabulary."""

    words: tuple[str, ...]
    n_records: int


def fit_lexicon(complaints: DataFrame, k: int = LEXICON_SIZE) -> Lexicon:
    """One pass over the texts; only the k best words reach the driver."""
    rows = sorted(_ranked(complaints, k).collect(), key=lambda r: r.idx)
    return Lexicon(tuple(r.word for r in rows), rows[0].n_records if rows else 0)


def count_vectors(complaints: DataFrame, lex: Lexicon, *carried: str) -> DataFrame:
    """(doc_id, label, tf): the term frequencies by idx as a sparse vector; and
    the carried columns of the complaints.

    The lexicon is a hash dictionary in the JVM, sent to each executor once:
    a record costs its words, whatever the size of the lexicon. Nothing is
    shuffled.
    """
    rows = cleaned(complaints, *carried).select("doc_id", "label", words("clean").alias("words"), *carried)
    if not lex.words:
        nothing = array_to_vector(F.array().cast("array<double>"))
        return rows.where(F.lit(False)).select("doc_id", "label", nothing.alias("tf"), *carried)
    dictionary = CountVectorizerModel.from_vocabulary(list(lex.words), inputCol="words", outputCol="tf")
    return dictionary.transform(rows).select("doc_id", "label", "tf", *carried)


def written_counts(complaints: DataFrame, lex: Lexicon) -> DataFrame:
    """``count_vectors`` written once to the shared folder, so that document
    frequencies and weights need one pass over the texts, not two."""
    counted = count_vectors(complaints, lex)
    path = shared_path(complaints.sparkSession, "term-counts")
    counted.write.parquet(path)
    return complaints.sparkSession.read.parquet(path)


def _counts(vectors: DataFrame) -> DataFrame:
    """(doc_id, label, tf, idxs, counts, max_tf) of the records with a lexicon
    word: the entries of the sparse vector as two arrays; and what is carried."""
    entry = F.unwrap_udt("tf")
    found = vectors.select("*", entry.getField("indices").alias("idxs"), entry.getField("values").alias("counts"))
    return found.where(F.size("idxs") > 0).withColumn("max_tf", F.array_max("counts"))


def _word(lex: Lexicon):
    """The word of the column idx; words are letters only."""
    return F.element_at(F.split(F.lit(" ".join(lex.words)), " "), F.col("idx") + 1)


def _entries(rows: DataFrame, values: str, lex: Lexicon, name: str) -> DataFrame:
    """(doc_id, label, word, idx, <name>) of the lexicon words present."""
    present = rows.select("doc_id", "label", F.explode(F.arrays_zip("idxs", values)).alias("e"))
    return present.select("doc_id", "label", F.col("e.idxs").alias("idx"), F.col(f"e.{values}").alias(name)).select(
        "doc_id", "label", _word(lex).alias("word"), "idx", name
    )


def _numbers(values):
    """An array literal of doubles."""
    return F.lit(np.array(values, dtype=np.float64))


def term_frequency(complaints: DataFrame, k: int = LEXICON_SIZE) -> DataFrame:
    """(doc_id, label, word, idx, tf) for the lexicon words; no shuffle of
    documents or words."""
    lex = fit_lexicon(complaints, k)
    entries = _entries(_counts(count_vectors(complaints, lex)), "counts", lex, "tf")
    return entries.withColumn("tf", F.col("tf").cast("bigint"))


def _frequencies(vectors: DataFrame) -> DataFrame:
    """(idx, df): the non-zero entries per place, one vector per task."""
    there = Summarizer.metrics("numNonZeros").summary(F.col("tf")).getField("numNonZeros")
    return vectors.agg(there.alias("df")).select(
        F.posexplode(vector_to_array("df")).alias("idx", "df")
    ).select("idx", F.col("df").cast("bigint").alias("df"))


def document_frequency(complaints: DataFrame, k: int = LEXICON_SIZE) -> DataFrame:
    """(word, df): number of documents containing the lexicon word."""
    lex = fit_lexicon(complaints, k)
    found = _frequencies(count_vectors(complaints, lex)) if lex.words else complaints.sparkSession.createDataFrame([], "idx int, df bigint")
    return found.select(_word(lex).alias("word"), "df")


def idf(complaints: DataFrame, k: int = LEXICON_SIZE) -> DataFrame:
    """(word, idf) with idf = ln(N / df); at most k rows."""
    lex = fit_lexicon(complaints, k)
    if not lex.words:
        return complaints.sparkSession.createDataFrame([], "word string, idf double")
    return _frequencies(count_vectors(complaints, lex)).select(_word(lex).alias("word"), F.log(F.lit(lex.n_records) / F.col("df")).alias("idf"))


def _normalised(vectors: DataFrame) -> DataFrame:
    """``_counts`` with tf_norm = 0.5 + 0.5 tf / max tf of the document."""
    norm = F.transform("counts", lambda tf: F.lit(0.5) + F.lit(0.5) * tf / F.col("max_tf"))
    return _counts(vectors).withColumn("tf_norm", norm)


def tf_double_norm(complaints: DataFrame, k: int = LEXICON_SIZE) -> DataFrame:
    """(doc_id, label, word, idx, tf_norm) = 0.5 + 0.5 tf / max tf of the doc."""
    lex = fit_lexicon(complaints, k)
    return _entries(_normalised(count_vectors(complaints, lex)), "tf_norm", lex, "tf_norm")


@dataclass(frozen=True)
class Weights:
    """A fitted vocabulary: words by idx, their idf, and the vector size k."""

    words: tuple[str, ...]
    idf: tuple[float, ...]
    size: int


def fit_weights(vectors: DataFrame, lex: Lexicon, k: int) -> Weights:
    """The idf values of the lexicon, from the count vectors."""
    if not lex.words:
        return Weights((), (), k)
    rows = _frequencies(vectors).select("idx", F.log(F.lit(lex.n_records) / F.col("df")).alias("idf")).collect()
    return Weights(lex.words, tuple(r.idf for r in sorted(rows, key=lambda r: r.idx)), k)


def weighted(vectors: DataFrame, weights: Weights) -> DataFrame:
    """``_normalised`` with weight = tf_norm * idf."""
    weight = F.zip_with("idxs", "tf_norm", lambda i, tf: tf * F.element_at(_numbers(weights.idf), i + 1))
    return _normalised(vectors).withColumn("weight", weight)


def fitted_counts(complaints: DataFrame, k: int = LEXICON_SIZE) -> tuple[DataFrame, Lexicon, Weights]:
    """The written count vectors of the complaints and the vocabulary fitted on
    them: two passes over the texts."""
    lex = fit_lexicon(complaints, k)
    vectors = written_counts(complaints, lex)
    return vectors, lex, fit_weights(vectors, lex, k)


def fitted_weights(complaints: DataFrame, k: int = LEXICON_SIZE) -> Weights:
    """The vocabulary of the complaints; the texts are read twice and no count
    is written."""
    lex = fit_lexicon(complaints, k)
    return fit_weights(count_vectors(complaints, lex), lex, k)


def tfidf(complaints: DataFrame, k: int = LEXICON_SIZE) -> DataFrame:
    """(doc_id, label, idx, word, weight = tf_norm * idf)."""
    vectors, lex, weights = fitted_counts(complaints, k)
    rows = _entries(weighted(vectors, weights), "weight", lex, "weight")
    return rows.select("doc_id", "label", "idx", "word", "weight")


def feature_vectors(vectors: DataFrame, weights: Weights, *carried: str) -> DataFrame:
    """One row per document with a lexicon word:
    (doc_id, label_f, features: k-wide vector, features_key), and the carried
    columns.

    ``VectorAssembler`` stores the vectors sparse where that is smaller.
    ``features_key`` spells the words present as "idx:round(weight * 1e6)" for
    comparisons across engines.
    """
    # Laid out by idx; a lexicon shorter than k leaves zeros at the end.
    value = F.transform(
        vector_to_array("tf"),
        lambda tf, i: F.when(
            tf > 0, (F.lit(0.5) + F.lit(0.5) * tf / F.col("max_tf")) * F.element_at(_numbers(weights.idf), i + 1)
        ).otherwise(F.lit(0.0)),
    )
    dense = F.concat(value, F.array_repeat(F.lit(0.0), weights.size - len(weights.words)))
    spelled = F.zip_with(
        "idxs", "weight", lambda i, w: F.concat(i.cast("string"), F.lit(":"), F.round(w * F.lit(1e6)).cast("bigint").cast("string"))
    )
    rows = weighted(vectors, weights).select(
        "doc_id",
        F.col("label").alias("label_f"),
        array_to_vector(dense).alias("dense"),
        F.array_join(spelled, " ").alias("features_key"),
        *carried,
    )
    # The size is known: without the hint the assembler runs a job to look.
    sized = VectorSizeHint(inputCol="dense", size=weights.size, handleInvalid="optimistic").transform(rows)
    assembled = VectorAssembler(inputCols=["dense"], outputCol="features").transform(sized)
    return assembled.select("doc_id", "label_f", "features", "features_key", *carried)


def tfidf_vectors(complaints: DataFrame, k: int = LEXICON_SIZE) -> DataFrame:
    """``feature_vectors`` of the complaints with the vocabulary fitted on them."""
    vectors, _, weights = fitted_counts(complaints, k)
    return feature_vectors(vectors, weights)


def tfidf_sparse(complaints: DataFrame, k: int = LEXICON_SIZE) -> DataFrame:
    """The vectors read back as (doc_id, label_f, idx, value) for non-zero
    entries; checks the assembly (index placement, size k)."""
    vec = tfidf_vectors(complaints, k)
    return (
        vec.select("doc_id", "label_f", F.posexplode(vector_to_array("features")).alias("idx", "value"))
        .where(F.col("value") != 0)
        .select("doc_id", "label_f", "idx", F.round("value", WEIGHT_DECIMALS).alias("value"))
    )
