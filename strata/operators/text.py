"""Text features as sparse long-form tables.

Vectors are never dense: a document vector is the set of rows (doc_id, pos, value)
for the positions it actually holds.  The vocabulary and the IDF table have at most
K rows; joins with them carry no hint, Catalyst broadcasts them by their size.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.text import tokenize
from strata.operators.common import number_rows, top_n
from strata.operators.vectors import Packed
from strata.operators.words import batch_word_counts, packed_frequencies, unpacked_frequencies
from strata.session import Scratch, persist_reliably

# Fixed values of the reference: vocabulary sizes of the corpus and the classifier.
CORPUS_VOCABULARY = 20000
CLASSIFIER_VOCABULARY = 9000


def doc_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) → one row per token (doc_id, word), repeats kept.  Narrow."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.explode(tokenize(text_col)).alias("word")
    )


def word_counts(tokens: DataFrame) -> DataFrame:
    """(word, count).  Combined map-side: frequent words cost one row per task."""
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def _by_frequency() -> list[Column]:
    return [F.col("count").desc(), F.col("word").asc()]


def top_words(counts: DataFrame, n: int = 10) -> DataFrame:
    return top_n(counts, n, _by_frequency())


def build_vocabulary(counts: DataFrame, k: int = CORPUS_VOCABULARY) -> DataFrame:
    """The K most frequent words (fewer if the corpus has fewer), positions 0..K-1
    by falling count, ties by word.  (word, count, pos).

    The count of the K-th word comes from the histogram of counts (few rows: n different
    counts need n² / 2 tokens), so only words at or above it are sorted and merged."""
    w = Window.orderBy(F.col("count").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("count").agg(F.count(F.lit(1)).alias("words"))
    reached = sizes.select("count", F.coalesce(F.sum("words").over(w), F.lit(0)).alias("before"))
    least = reached.where(F.col("before") < k).agg(F.min("count"))
    head = counts.where(F.col("count") >= least.scalar())
    return number_rows(top_n(head, k, _by_frequency()), _by_frequency(), "pos")


def frequent_words(docs: DataFrame, capacity: int, text_col: str = "text") -> DataFrame:
    """(word, least, error): a summary of each task's words, at most ``capacity`` each.

    A task counts its words; whenever more than ``capacity`` are held, the count of the next one after
    those is taken off all, and words at 0 go (``error`` adds up what was taken off).
    So count - error <= least <= count for every word of the task, with least = 0 for one it doesn't hold."""

    def summarise(batches):
        held, error = pa.table({"word": pa.array([], pa.string()), "n": pa.array([], pa.int64())}), 0
        for batch in batches:
            found = pc.value_counts(batch.column(0).flatten())
            new = pa.table({"word": found.field(0), "n": found.field(1)})
            held = pa.concat_tables([held, new]).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
            if held.num_rows > capacity:
                counts = held.column("n").to_numpy()
                off = int(np.partition(counts, -(capacity + 1))[-(capacity + 1)])
                held = held.set_column(1, "n", pa.array(counts - off)).filter(pa.array(counts > off))
                error += off
        out = held.append_column("error", pa.array(np.full(held.num_rows, error)))
        # One row without a word tells the task's error, also where no word is left.
        out = pa.concat_tables([out.rename_columns(["word", "least", "error"]), pa.table({"word": pa.array([None], pa.string()), "least": pa.array([0]), "error": pa.array([error])})])
        yield from out.to_batches()

    words = docs.select(tokenize(text_col).alias("words"))
    return words.mapInArrow(summarise, "word string, least bigint, error bigint")


def vocabulary_in_bounded_memory(docs: DataFrame, k: int = CORPUS_VOCABULARY, capacity: int | None = None) -> DataFrame:
    """``build_vocabulary`` without shuffling every word of the corpus: (word, count, pos).

    First pass: the tasks' summaries, added up by word.  E, the sum of their errors, bounds what any
    word lacks: least <= count <= least + E.  If T is the K-th greatest ``least``, every word
    of the K most frequent has count >= T, hence least + E >= T.  With E < T that is
    said of summarised words alone, so no word is missing among the candidates, and the
    second pass counts these exactly.  Otherwise, or with fewer than K words, all words are counted."""
    scratch = Scratch(docs.sparkSession)
    try:
        found = scratch.table(frequent_words(docs, capacity or 4 * k))
        error = found.where(F.col("word").isNull()).agg(F.coalesce(F.sum("error"), F.lit(0))).first()[0]
        sums = found.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("least").alias("least"))
        head = top_n(sums, k, [F.col("least").desc()]).agg(F.count(F.lit(1)), F.min("least")).first()
        tokens = doc_tokens(docs.withColumn("doc_id", F.lit(0)))
        if error and (head[0] < k or error >= head[1]):
            counts = word_counts(tokens)
        elif not error:  # nothing was ever taken off: the sums are the counts
            counts = sums.withColumnRenamed("least", "count")
        else:
            candidates = scratch.table(sums.where(F.col("least") + F.lit(error) >= F.lit(head[1])).select("word"))
            counts = word_counts(tokens.join(candidates, "word", "left_semi"))
        vocabulary = build_vocabulary(counts, k)
        return persist_reliably(vocabulary)  # K rows
    finally:
        scratch.release()


def vocabulary_tail(vocab: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` highest positions, falling."""
    return top_n(vocab, n, [F.col("pos").desc()])


def vocab_lookup(vocab: DataFrame, words: DataFrame) -> DataFrame:
    """(word) → (word, pos); −1 for a word outside the vocabulary."""
    dictionary = vocab.select("word", "pos")
    return words.join(dictionary, "word", "left").select(
        "word", F.coalesce(F.col("pos"), F.lit(-1).cast("bigint")).alias("pos")
    )


def tokens_to_positions(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """(doc_id, word) → (doc_id, pos); out-of-vocabulary words drop, repeats stay.
    A vocabulary within Spark's broadcast threshold leaves the token stream in place."""
    dictionary = vocab.select("word", "pos")
    return tokens.join(dictionary, "word").select("doc_id", "pos")


def position_counts(positions: DataFrame) -> DataFrame:
    """(doc_id, pos, n): occurrences of each position in each document.  Equal ids
    from different lines merge here."""
    return positions.groupBy("doc_id", "pos").agg(F.count(F.lit(1)).alias("n"))


def term_frequency(positions: DataFrame) -> DataFrame:
    """(doc_id, pos, tf): count ÷ number of in-vocabulary tokens of the document.

    The per-document total is a window over doc_id; a document has at most K rows
    here, so no window partition can outgrow a task.  The result is hash-partitioned
    by doc_id, which later per-document steps reuse without another shuffle.
    """
    counts = position_counts(positions)
    per_doc = Window.partitionBy("doc_id")
    return counts.select(
        "doc_id", "pos", (F.col("n") / F.sum("n").over(per_doc)).alias("tf")
    )


def binary_presence(tf: DataFrame) -> DataFrame:
    """(doc_id, pos, present = 1) for every position a document holds."""
    return tf.select("doc_id", "pos", F.lit(1).alias("present"))


def document_frequency(tf: DataFrame) -> DataFrame:
    """(pos, df): number of documents holding each position."""
    return tf.groupBy("pos").agg(F.count(F.lit(1)).alias("df"))


def inverse_document_frequency(doc_freq: DataFrame, n_docs: DataFrame | int) -> DataFrame:
    """(pos, idf) with idf = ln(N / df), natural log, no smoothing.

    ``n_docs`` is a one-row, one-column frame (evaluated as a scalar sub-query) or
    an int.  N counts every corpus row, so df ≤ N and idf ≥ 0.
    """
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs.scalar()
    return doc_freq.select("pos", F.ln(n.cast("double") / F.col("df")).alias("idf"))


def tf_idf(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """(doc_id, pos, value = tf × idf).  An IDF within Spark's broadcast threshold
    leaves tf's partitioning by doc_id as it is."""
    return tf.join(idf, "pos").select(
        "doc_id", "pos", (F.col("tf") * F.col("idf")).alias("value")
    )


class TextFeatures(NamedTuple):
    tokens: DataFrame
    counts: DataFrame
    vocab: DataFrame
    tf: DataFrame
    doc_freq: DataFrame
    idf: DataFrame | None
    tfidf: DataFrame | None
    k: int
    scratch: Scratch | None
    packed: DataFrame | None = None  # stored TF: (doc_id, pos[], tf[])

    @property
    def vectors(self) -> Packed | None:
        """The TF-IDF vectors, one row per document, where they are stored."""
        return Packed(self.packed, self.idf) if self.packed is not None and self.idf is not None else None

    def release(self) -> None:
        """Drop the stored vocabulary, TF and IDF."""
        if self.scratch:
            self.scratch.release()


def text_features(
    docs: DataFrame,
    k: int = CORPUS_VOCABULARY,
    stored: bool = True,
    n_docs: DataFrame | int | None = None,
) -> TextFeatures:
    """Fit the corpus features: tokens → vocabulary → TF → DF → IDF → TF-IDF.

    The text is tokenized twice: once to count words (vocabulary), once to map
    words to positions.  The reused pieces become tables in the shared checkpoint
    folder, like a model fit: the vocabulary (≤ K rows), TF (one row per document,
    bucketed and sorted by doc_id; read by DF, TF-IDF and scoring) and IDF (≤ K rows).
    Later plans read them once and know TF's partitioning, so per-document steps
    downstream need no shuffle.  ``stored=False`` keeps everything lazy and in long form.

    ``n_docs`` is the N of the IDF (a one-row frame or an int); by default the
    number of rows of ``docs``.  Pass ``corpus_size(lines)`` to count every input
    line, valid or not, as the line-based workflow does.
    """
    features = text_frequencies(docs, k, stored)
    n = docs.agg(F.count(F.lit(1))) if n_docs is None else n_docs
    idf = inverse_document_frequency(features.doc_freq, n)
    if features.scratch:
        idf = features.scratch.table(idf)
    return features._replace(idf=idf, tfidf=tf_idf(features.tf, idf))


def text_frequencies(docs: DataFrame, k: int = CORPUS_VOCABULARY, stored: bool = True) -> TextFeatures:
    """The features without IDF and TF-IDF (None), for callers that don't read them."""
    scratch = Scratch(docs.sparkSession) if stored else None
    tokens = doc_tokens(docs)
    if scratch is None:
        counts = word_counts(tokens)
        vocab = build_vocabulary(counts, k)
        tf = term_frequency(tokens_to_positions(tokens, vocab))
        return TextFeatures(tokens, counts, vocab, tf, document_frequency(tf), None, None, k, None)
    counts = batch_word_counts(docs)
    vocab = scratch.table(build_vocabulary(counts, k))
    packed = scratch.table(packed_frequencies(docs, vocab), bucket_by="doc_id")
    held = packed.select(F.explode(F.col("pos").cast("array<bigint>")).alias("pos"))
    tf, doc_freq = unpacked_frequencies(packed), document_frequency(held)
    return TextFeatures(tokens, counts, vocab, tf, doc_freq, None, None, k, scratch, packed)


def featurize(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """TF vectors (doc_id, pos, tf) of any documents against a given vocabulary
    (the training one for a test set)."""
    return term_frequency(tokens_to_positions(doc_tokens(docs), vocab))
