"""L2-regularised logistic regression by (mini-batch) gradient descent.

Examples are long-form rows (doc_id, label, pos, value) with the bias as position
``n_features`` (value 1), one example per document id.  For training they are packed
once into one row per document (doc_id, label, pos[], value[]) and stored under the
shared checkpoint folder.  The draw of a mini-batch depends on (seed, doc_id) alone, so
one pass stores the documents of every iteration, partitioned by iteration, and a step
reads its own batch only.  One step is one distributed aggregate:

* the weight vector (n_features + 1 numbers) travels with the task;
* each Arrow batch of documents gives θ = x·w, the residuals and the sums
  Σ x·(σ(θ) − y) by position as vector operations;
* a task sends one row, its dense partial sums with the loss and the sample count; they
  are added up in two levels, by branch and then together, and only the total is split
  into positions.  The shuffle of a step is one array per task and branch.

A fit can keep its state in a folder on shared storage: the packed examples and batches, and
after each step the weights, cost and iteration.  Started again after a loss of its driver, it
goes on from the last step and ends with the same weights.

Only the gradient returns to the driver each iteration, as in any driver-controlled
iterative fit; the data never does.  The driver therefore holds a few arrays of
n_features + 1 doubles: sound up to some ten million features (80 MB each).
"""

from __future__ import annotations

import json
import math
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.numeric import logistic
from strata.session import Folder, Scratch

# Fixed values of the reference's training call.
DEFAULT_ITERATIONS = 50
DEFAULT_LEARNING_RATE = 0.60
DEFAULT_REGULARIZATION = 0.1
DEFAULT_BATCH = 20000
DEFAULT_TOLERANCE = 0.00005
INIT_SEED = 0
INIT_SCALE = 0.1
THRESHOLD = 0.5

BATCH_FILES = 4  # files per iteration of the stored batches

WEIGHT_SCHEMA = T.StructType(
    [T.StructField("pos", T.LongType(), False), T.StructField("weight", T.DoubleType(), False)]
)


def label_by_substring(docs: DataFrame, needle: str = "AU") -> DataFrame:
    """(doc_id, label): 1 when ``needle`` occurs in the document id."""
    return docs.select("doc_id", F.col("doc_id").contains(needle).cast("int").alias("label"))


def logreg_examples(tf: DataFrame, labels: DataFrame, n_features: int) -> DataFrame:
    """(doc_id, label, pos, value): TF rows of labelled documents plus one bias row
    (pos = n_features, value 1.0) per document that has a vector.

    Equal ids are one example, as they are one TF vector: of several labels of an id
    the greatest counts."""
    known = labels.where(F.col("label").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    return _with_bias(tf.join(known, "doc_id"), n_features)


def logreg_examples_by_id(tf: DataFrame, n_features: int, needle: str = "AU") -> DataFrame:
    """``logreg_examples`` with the label taken from the id itself (1 when ``needle``
    occurs in it): no label table and no join."""
    return _with_bias(tf.withColumn("label", F.col("doc_id").contains(needle).cast("int")), n_features)


def _with_bias(labelled: DataFrame, n_features: int) -> DataFrame:
    """One pass: the row holding a document's smallest position also emits the bias
    (a window over doc_id, which TF is already clustered by)."""
    first = F.col("pos") == F.min("pos").over(Window.partitionBy("doc_id"))
    feature = F.struct(F.col("pos"), F.col("tf").alias("value"))
    bias = F.struct(F.lit(n_features).cast("bigint").alias("pos"), F.lit(1.0).alias("value"))
    entries = F.when(F.col("first"), F.array(feature, bias)).otherwise(F.array(feature))
    rows = labelled.withColumn("first", first).select("doc_id", "label", F.explode(entries).alias("e"))
    return rows.select("doc_id", "label", "e.pos", "e.value")


def train_size(examples: DataFrame, n_features: int) -> DataFrame:
    """Number of example documents (each holds the bias position once): ``n``."""
    return examples.where(F.col("pos") == n_features).agg(F.count(F.lit(1)).alias("n"))


def pack_examples(examples: DataFrame) -> DataFrame:
    """Long-form examples → one row per document (doc_id, label, pos[], value[]),
    positions ascending.  A document holds at most n_features + 1 entries, so no
    row can outgrow a task however skewed the corpus is."""
    packed = examples.groupBy("doc_id").agg(
        F.max("label").alias("label"),
        F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("entries"),
    )
    return packed.select(
        "doc_id", "label", F.col("entries.pos").alias("pos"), F.col("entries.value").alias("value")
    )


def drawn(seed: Column, doc_id: Column) -> Column:
    """A number in [0, 1) from (seed, doc_id) alone, written so that SQL can redo it:
    the first 52 bits of md5('seed:doc_id')."""
    digest = F.md5(F.concat(seed.cast("string"), F.lit(":"), doc_id.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def sample_documents(docs: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample of whole documents without replacement, independent of
    partitioning and identical on recomputation."""
    return docs.where(drawn(F.lit(seed), F.col("doc_id")) < F.lit(fraction))


def draw_batches(docs: DataFrame, fraction: float, iterations: int) -> DataFrame:
    """``docs`` once for every iteration that draws them (column ``iteration``):
    iteration i uses seed 1 + i.  About fraction × iterations copies in all."""
    seeds = F.sequence(F.lit(1), F.lit(iterations))
    mine = F.filter(seeds, lambda seed: drawn(seed, F.col("doc_id")) < F.lit(fraction))
    return docs.withColumn("iteration", F.explode(F.transform(mine, lambda seed: seed - 1)))


def weights_frame(spark: SparkSession, weights: np.ndarray) -> DataFrame:
    table = pa.table({"pos": np.arange(len(weights), dtype=np.int64), "weight": np.asarray(weights, np.float64)})
    return spark.createDataFrame(table, WEIGHT_SCHEMA)


def branches(spark: SparkSession) -> int:
    """Width of the tree that adds up partial sums: the root of the tasks that run at once."""
    return max(1, math.isqrt(spark.sparkContext.defaultParallelism))


PARTIAL = "branch int, grad array<double>, held binary, loss double, n bigint"


def _partial(branch: int, grad: np.ndarray, held: np.ndarray, loss: float, n: int) -> pa.RecordBatch:
    grads = pa.ListArray.from_arrays(pa.array([0, len(grad)], pa.int32()), pa.array(grad))
    columns = [pa.array([branch], pa.int32()), grads, pa.array([held.tobytes()], pa.binary()), pa.array([loss]), pa.array([n], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["branch", "grad", "held", "loss", "n"])


def partial_sums(packed: DataFrame, weights: np.ndarray, n_features: int, width: int) -> DataFrame:
    """One row per task that has documents (PARTIAL): Σ x (σ(θ) − y) by position as a dense array, which
    positions its documents hold, Σ loss and their number."""

    def add(batches):
        grad, held = np.zeros(n_features + 1), np.zeros(n_features + 1, bool)
        loss, n = 0.0, 0
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            pos, value = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (1, 2))
            row = np.repeat(np.arange(len(y)), sizes)
            theta = np.bincount(row, value * weights[pos], len(y))
            small = np.exp(-np.abs(theta))
            sigma = np.where(theta >= 0, 1.0, small) / (1.0 + small)
            grad += np.bincount(pos, value * (sigma - y)[row], n_features + 1)
            held[pos] = True
            loss += float(np.sum(np.maximum(theta, 0.0) + np.log1p(small) - y * theta))
            n += len(y)
        if n:
            yield _partial(TaskContext.get().partitionId() % width, grad, held, loss, n)

    return packed.select("label", "pos", "value").mapInArrow(add, PARTIAL)


def merged_sums(partials: DataFrame, n_features: int) -> DataFrame:
    """The rows of each partition added up, one array in memory whatever their number."""

    def add(batches):
        grad, held = np.zeros(n_features + 1), np.zeros(n_features + 1, bool)
        loss, n, branch = 0.0, 0, 0
        for batch in batches:
            for k in range(batch.num_rows):
                grad += batch.column(1)[k].values.to_numpy()
                held |= np.frombuffer(batch.column(2)[k].as_py(), bool)
                loss, n, branch = loss + batch.column(3)[k].as_py(), n + batch.column(4)[k].as_py(), batch.column(0)[k].as_py()
        if n:
            yield _partial(branch, grad, held, loss, n)

    return partials.mapInArrow(add, PARTIAL)


def tree_sums(packed: DataFrame, weights: np.ndarray, n_features: int, width: int | None = None) -> DataFrame:
    """At most one row (PARTIAL): the sums over all packed examples.  Partial arrays meet
    by branch, a branch's arrays are added up as they come, then the branches' totals
    (``width`` 1: all arrays at once, a single shuffle)."""
    width = branches(packed.sparkSession) if width is None else width
    partials = partial_sums(packed, weights, n_features, width)
    if width > 1:
        partials = merged_sums(partials.repartition(width, "branch"), n_features)
    return merged_sums(partials.repartition(1), n_features)


def gradient_sums(packed: DataFrame, weights: np.ndarray, n_features: int, width: int | None = 1) -> DataFrame:
    """(pos, grad, loss, n): Σ x (σ(θ) − y) per position that a document holds; the bias row
    also carries Σ loss and the number of documents.  ``width`` as in ``tree_sums``."""

    def split(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                at = np.flatnonzero(np.frombuffer(batch.column(2)[k].as_py(), bool))
                bias = at == n_features
                grad, loss, n = batch.column(1)[k].values.to_numpy()[at], batch.column(3)[k].as_py(), batch.column(4)[k].as_py()
                columns = [pa.array(at, pa.int64()), pa.array(grad), pa.array(np.where(bias, loss, 0.0)), pa.array(np.where(bias, n, 0), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["pos", "grad", "loss", "n"])

    total = tree_sums(packed, weights, n_features, width)
    return total.mapInArrow(split, "pos bigint, grad double, loss double, n bigint")


class StepResult(NamedTuple):
    gradient: np.ndarray  # Σ x (σ(θ) − y), dense over positions 0..n_features
    loss: float
    n: int


def logreg_step(packed: DataFrame, weights: np.ndarray, n_features: int) -> StepResult:
    """One distributed pass over packed examples: gradient sums, loss sum and
    sample count (one array of n_features + 1 numbers reaches the driver)."""
    total = tree_sums(packed, weights, n_features).select("grad", "loss", "n").toArrow()
    if not total.num_rows:
        return StepResult(np.zeros(n_features + 1), 0.0, 0)
    return StepResult(total.column("grad").chunk(0)[0].values.to_numpy(), total.column("loss")[0].as_py(), total.column("n")[0].as_py())


class FitResult(NamedTuple):
    weights: DataFrame  # (pos, weight)
    history: DataFrame  # (iteration, cost)
    weight_vector: np.ndarray


def initial_weights(n_features: int, init: str = "normal", seed: int = INIT_SEED) -> np.ndarray:
    if init == "zeros":
        return np.zeros(n_features + 1)
    if init == "normal":
        # The legacy seeded generator: the same start vector as seeding numpy's global one.
        return np.random.RandomState(seed).normal(0.0, INIT_SCALE, n_features + 1)
    raise ValueError("init must be 'normal' or 'zeros'")


class FitState:
    """A fit's folder: ``examples`` and ``batches`` as Parquet, a folder per finished step
    (iteration, cost, weights) and the settings it belongs to.

    Everything is written as a draft and given its name in one step, so what has a name
    is whole; a driver that is lost in between leaves a draft, which nobody reads."""

    def __init__(self, spark: SparkSession, path: str, settings: dict):
        self.spark, self.folder = spark, Folder(spark, path)
        asked = json.dumps(settings, sort_keys=True)
        found = self.stored("settings", lambda: spark.createDataFrame([(asked,)], "settings string"))
        if found.first()[0] != asked:
            raise ValueError(f"{path} holds a fit with other settings")

    def write(self, name: str, df: DataFrame, partition_by: str | None = None) -> None:
        draft = f"_draft-{uuid.uuid4().hex[:12]}"
        (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(self.folder / draft)
        self.folder.publish(draft, name)

    def stored(self, name: str, make, partition_by: str | None = None) -> DataFrame:
        """The named table; made and written first where it isn't there."""
        if name not in self.folder.names():
            self.write(name, make(), partition_by)
        return self.spark.read.parquet(self.folder / name)

    def save(self, iteration: int, cost: float | None, stopped: bool, weights: np.ndarray) -> None:
        row = [(iteration, cost, stopped, weights.tolist())]
        df = self.spark.createDataFrame(row, "iteration int, cost double, stopped boolean, weights array<double>")
        self.write(f"step-{iteration:06d}", df.coalesce(1))

    def steps(self) -> list:
        """(iteration, cost, stopped) of the finished steps, in order."""
        names = [n for n in self.folder.names() if n.startswith("step-")]
        if not names:
            return []
        rows = self.spark.read.parquet(*(self.folder / n for n in names))
        return rows.select("iteration", "cost", "stopped").orderBy("iteration").collect()

    def weights(self, iteration: int) -> np.ndarray:
        row = self.spark.read.parquet(self.folder / f"step-{iteration:06d}").select("weights").toArrow()
        return row.column(0).chunk(0)[0].values.to_numpy()


def fit_logreg(
    examples: DataFrame,
    n_features: int,
    max_iteration: int = DEFAULT_ITERATIONS,
    learning_rate: float = DEFAULT_LEARNING_RATE,
    regularization: float = DEFAULT_REGULARIZATION,
    batch_size: int | None = DEFAULT_BATCH,
    tolerance: float = DEFAULT_TOLERANCE,
    optimizer: str = "SGD",
    init: str = "normal",
    seed: int = INIT_SEED,
    state: str | None = None,
) -> FitResult:
    """Mini-batch gradient descent with an L2 penalty λ‖w‖² (bias included).

    Per iteration i: sample a fraction batch/train_size of the documents (seed 1+i),
    cost = Σloss/n + λ‖w‖², w ← w − lr (Σgrad/n + 2λw), stop when the cost moved
    less than ``tolerance`` (the first comparison is against 0); the stopping cost
    is not recorded.  ``batch_size=None`` uses every document each iteration.

    ``state`` names a folder on shared storage that keeps the fit (``FitState``): called
    again with the same settings after a loss, it goes on behind the last finished
    step, over the examples stored then.
    """
    if optimizer != "SGD":
        raise ValueError("only the 'SGD' optimizer is supported")
    spark = examples.sparkSession
    settings = {
        "n_features": n_features, "max_iteration": max_iteration, "learning_rate": learning_rate, "regularization": regularization,
        "batch_size": batch_size, "tolerance": tolerance, "init": init, "seed": seed,
    }
    kept = FitState(spark, state, settings) if state else None
    # Stored once: iterations survive lost executors and never recompute the features.
    scratch = Scratch(spark)
    try:
        packed = lambda: pack_examples(examples)
        staged = kept.stored("examples", packed) if kept else scratch.table(packed())
        train_size = staged.count()
        fraction = 1.0 if batch_size is None or train_size == 0 else min(1.0, batch_size / train_size)
        batches = None
        if fraction < 1.0:
            # A few files per iteration; a batch has about batch_size documents.
            part = F.pmod(F.xxhash64("doc_id"), F.lit(BATCH_FILES))
            rows = draw_batches(staged, fraction, max_iteration).repartition(max_iteration * BATCH_FILES, "iteration", part)
            batches = kept.stored("batches", lambda: rows, "iteration") if kept else scratch.table(rows, partition_by="iteration")
        w = initial_weights(n_features, init, seed)
        done = kept.steps() if kept else []
        costs = [(r.iteration, r.cost) for r in done if r.cost is not None and not r.stopped]
        prev_cost = costs[-1][1] if costs else 0.0
        first, stopped = 0, False
        if done:
            w, first, stopped = kept.weights(done[-1].iteration), done[-1].iteration + 1, done[-1].stopped
        for i in range(first, 0 if stopped else max_iteration):
            step = logreg_step(staged if batches is None else batches.where(F.col("iteration") == i), w, n_features)
            if step.n == 0:
                continue  # empty batch: nothing to average
            cost = step.loss / step.n + regularization * float(np.square(w).sum())
            w = w - learning_rate * (step.gradient / step.n + 2 * regularization * w)
            stopped = abs(cost - prev_cost) < tolerance
            if kept:
                kept.save(i, float(cost), stopped, w)
            if stopped:
                break
            prev_cost = cost
            costs.append((i, float(cost)))
    finally:
        scratch.release()
    history = spark.createDataFrame(costs, "iteration int, cost double")
    return FitResult(weights_frame(spark, w), history, w)


def score_packed(
    packed: DataFrame, weights: np.ndarray, n_features: int, threshold: float = THRESHOLD, on: str = "logit"
) -> DataFrame:
    """(doc_id, label, score, prediction) in one narrow pass over packed documents, the
    model (n_features + 1 numbers) travelling with the task.  ``on`` as in ``score_logreg``."""
    if on not in ("logit", "probability"):
        raise ValueError("on must be 'logit' or 'probability'")
    weights = np.asarray(weights, np.float64)[: n_features + 1]

    def score(batches):
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            pos, value = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
            row = np.repeat(np.arange(batch.num_rows), sizes)
            sums = np.bincount(row, value * weights[pos], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sums)], ["doc_id", "label", "score"])

    rows = packed.select("doc_id", "label", "pos", "value")
    kinds = [rows.schema[c].dataType.simpleString() for c in ("doc_id", "label")]
    scored = rows.mapInArrow(score, f"doc_id {kinds[0]}, label {kinds[1]}, score double")
    test = F.col("score") if on == "logit" else logistic(F.col("score"))
    return scored.withColumn("prediction", (test >= F.lit(threshold)).cast("int"))


def weight_vector(weights: DataFrame, n_features: int) -> np.ndarray:
    """(pos, weight) as an array; positions without a weight have 0."""
    rows = weights.select("pos", "weight").toArrow()
    vector = np.zeros(n_features + 1)
    vector[rows.column("pos").to_numpy()] = rows.column("weight").to_numpy()
    return vector


def score_logreg(
    examples: DataFrame,
    weights: DataFrame,
    n_features: int,
    threshold: float = THRESHOLD,
    on: str = "logit",
) -> DataFrame:
    """(doc_id, label, score, prediction).  ``on='logit'`` compares the raw score
    x·w with the threshold (the reference rule), ``'probability'`` compares σ(x·w).
    Packing needs no shuffle where the examples are dealt by doc_id (as TF is)."""
    packed = pack_examples(examples)
    return score_packed(packed, weight_vector(weights, n_features), n_features, threshold, on)


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """One row (tp, tn, fp, fn); fp: actual < predicted, fn: actual > predicted."""
    y, p = F.col("label"), F.col("prediction")
    return scored.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if(y < p).alias("fp"),
        F.count_if(y > p).alias("fn"),
    )


def _ratio(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def classification_metrics(confusion: DataFrame) -> DataFrame:
    """precision, recall, f1, accuracy; each 0 when its denominator is 0."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    with_pr = confusion.select("*", precision.alias("precision"), recall.alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return with_pr.select(
        "tp", "tn", "fp", "fn", "precision", "recall",
        _ratio(F.lit(2.0) * p * r, p + r).alias("f1"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )


def top_weighted_words(weights: DataFrame, vocab: DataFrame, n_features: int, n: int = 5) -> DataFrame:
    """The ``n`` largest weights that belong to a word (the bias is excluded):
    (pos, word, weight), ties by position."""
    words = weights.where(F.col("pos") != n_features).join(
        vocab.select("pos", "word"), "pos"
    )
    return words.orderBy(F.col("weight").desc(), F.col("pos").asc()).limit(n).select(
        "pos", "word", "weight"
    )
