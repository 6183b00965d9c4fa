"""Toxicity by compression distance.

Two zstandard dictionaries are made: one from ordinary text, one from toxic text.  A
text is cut into short overlapping windows; each is compressed under both, and the
bytes that the toxic dictionary saves say how toxic the window is.  The windows'
savings give a document a few features, and a logistic curve calibrated on labelled
documents that the dictionaries never saw turns them into a score; the curve is bent
so that the cutoff with the best F1 there lies at 0.3.

Both dictionaries hold the content that zstandard trains on ordinary text, hence
ordinary windows compress alike.  The toxic one ends in the words and word stems that
stand in many distinct surroundings in toxic text and in few in ordinary text (copies
of a passage count once): what zstandard trains on toxic text itself is nearly all
ordinary.  Every window is compressed behind an anchor that both dictionaries hold,
as zstandard leaves a short window uncompressed where a single match gains little.

Fitting takes at most DICTIONARY_DOCUMENTS labelled documents of each class for the
dictionaries and CALIBRATION_DOCUMENTS of each for the curve (the first by a hash of
their id, one row of each id), of documents beyond FIT_CHARS characters FIT_WINDOWS spread windows of that
length in all; documents of the held-out quarter (crc32 of the id as text mod 4 is 2)
are never used.  Scoring reads every text whole, in one narrow map.

Null and empty texts are one empty window.  Labels that are null or of unknown
documents are left out; of repeated labels the greatest counts.  Without toxic or
without ordinary labelled documents every score is 0.  Repeated rows are scored each.
"""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.bpe import slices
from strata.llm.common import ids_and_texts

DICTIONARY_DOCUMENTS = 2_500
FIT_CHARS, FIT_WINDOWS = 40_000, 20  # of a longer document, so many windows spread over it are learnt from
CALIBRATION_DOCUMENTS = 2_500
CUTOFF = 0.3
WINDOW, STEP = 48, 32  # bytes
LEVEL = 6
COMMON_BYTES = 8192  # of the ordinary part that both dictionaries hold
TOXIC_BYTES = 4096  # at most of the toxic part
ANCHOR = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ!?=/" * 2  # in no lower-case text
SHORTEST, LONGEST = 4, 14  # characters of a telling segment
LEAST = 5  # surroundings that it has
_REPETITIONS = bytes([1, 0, 0, 0, 4, 0, 0, 0, 8, 0, 0, 0])  # ends a dictionary's tables


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def trained_content(samples: list[bytes], size: int, segment: int) -> bytes:
    """The content of a dictionary trained on ``samples``, without its tables; the
    samples themselves where they are too few to train on."""
    try:
        made = zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
        return made[made.index(_REPETITIONS) + len(_REPETITIONS) :]
    except (zstandard.ZstdError, ValueError):
        return b"".join(dict.fromkeys(samples))[:size]


def surroundings(texts: list[str]) -> tuple[list[tuple[str, int]], int]:
    """The words with the number of their distinct surroundings (the words beside), and the
    number of all.  Triples are kept as numbers, some bytes each."""
    number, rows = {"": 0}, [np.zeros(1, np.int32)]
    for text in texts:
        rows.append(np.array([*(number.setdefault(w, len(number)) for w in text.split()), 0], np.int32))
    ids = np.concatenate(rows).astype(np.int64)
    before, word, after = ids[:-2], ids[1:-1], ids[2:]
    before, word, after = before[word > 0], word[word > 0], after[word > 0]
    if len(number) < 1 << 21:
        word = (np.unique((before << 42) | (word << 21) | after) >> 21) & ((1 << 21) - 1)
    else:
        word = np.unique(np.stack([before, word, after], axis=1), axis=0)[:, 1]
    counts = np.bincount(word, minlength=len(number)).tolist()
    return [(w, counts[i]) for w, i in number.items() if counts[i]], max(1, len(word))


def beginnings(words: list[tuple[str, int]], only: dict[str, int] | None = None) -> dict[str, int]:
    """How many surroundings words and beginnings of words, after a blank, have: those of at
    least LEAST, length by length (a longer beginning has no more), or ``only`` those given."""
    found: dict[str, int] = {}
    words = [(f" {w} ", n) for w, n in words]
    for end in range(SHORTEST + 1, LONGEST + 1):
        words = [(w, n) for w, n in words if len(w) >= end]
        starts: Counter = Counter()
        for w, n in words:
            if only is None or w[:end] in only:
                starts[w[:end]] += n
        if only is None:
            starts = {s: n for s, n in starts.items() if n >= LEAST}
            words = [(w, n) for w, n in words if w[:end] in starts]
        found.update(starts)
    return found


def telling_segments(toxic: list[str], ordinary: list[str]) -> list[tuple[bytes, int]]:
    """Words and beginnings of words, after a blank, that are surely more frequent in
    toxic text, and the number of their surroundings; none holds another."""
    words, n = surroundings(toxic)
    mine = beginnings(words)
    words, m = surroundings(ordinary)
    other = Counter(beginnings(words, mine))
    sure = lambda w, c: (c - 2 * c**0.5) / n > 4 * (other[w] + 3 * (other[w] + 1) ** 0.5) / m
    found, held = [], ""
    for segment, c in sorted(mine.items(), key=lambda x: (-x[1], -len(x[0]), x[0])):
        if sure(segment, c) and segment not in held and not any(s in segment for s, _ in found):
            found.append((segment, c))
            held += segment + "\n"
    return [(s.encode("utf-8"), c) for s, c in found]


def windows_of_words(texts: list[str], n: int = 6) -> list[bytes]:
    """Distinct runs of words, in a fixed random order."""
    runs = {}
    for text in texts:
        words = text.split()
        runs.update(dict.fromkeys(" ".join(words[i : i + n]) for i in range(0, len(words), n)))
    out = [r.encode("utf-8") for r in sorted(runs)]
    random.Random(7).shuffle(out)
    return out


def train(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """The contents of the toxic and of the ordinary dictionary."""
    toxic, ordinary = [t.lower() for t in toxic], [t.lower() for t in ordinary]
    segments, runs = telling_segments(toxic, ordinary), windows_of_words(ordinary)
    own = b"".join(segment for segment, _ in segments)[:TOXIC_BYTES]
    common = ANCHOR + trained_content(runs, COMMON_BYTES, 64)
    return common + own, common


@dataclass
class Scorer:
    """The two dictionaries, the curve's weights (bias first) and its bend."""

    toxic: bytes = b""
    ordinary: bytes = b""
    weights: list[float] = field(default_factory=list)
    bend: float = 1.0

    def compressors(self):
        def compressor(content):
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, **plain).compress

        return compressor(self.toxic), compressor(self.ordinary)

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(features))
        w = np.array(self.weights)
        return (1 / (1 + np.exp(-np.clip(w[0] + features @ w[1:], -500, 500)))) ** self.bend


def features_of(text: str, toxic, ordinary) -> list[float]:
    data = text.lower().encode("utf-8")
    parts = [ANCHOR + data[i : i + WINDOW] for i in range(0, max(1, len(data) - (WINDOW - STEP)), STEP)]
    saved = np.array([len(ordinary(p)) - len(toxic(p)) for p in parts], float)
    over = [np.maximum(saved - limit, 0) for limit in (0, 1, 2, 4)]
    return [
        float(saved.mean()),
        *(float(np.log1p(100 * x.mean())) for x in over),
        float(np.log1p(over[2].sum())),
        float(over[0].max()),
        float(np.log(len(parts))),
    ]


def calibrate(features: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[list[float], float]:
    """Weighted logistic regression by Newton steps, and the bend that moves the
    cutoff of best F1 to CUTOFF."""
    x = np.column_stack([np.ones(len(features)), features])
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-2] * features.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - labels)) + ridge @ w
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum((weight * labels)[order])
    f1 = 2 * hits / (np.cumsum(weight[order]) + (weight * labels).sum())
    ends = np.append(p[order][1:] != p[order][:-1], True)
    best = int(np.argmax(np.where(ends, f1, -1)))
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    cut = float(np.clip((p[order][best] + below) / 2, 1e-6, 1 - 1e-6))
    return w.tolist(), float(np.log(CUTOFF) / np.log(cut))


def document_features(docs: DataFrame, scorer: Scorer, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` (with text last) and the features, one map."""

    def compute(batches):
        toxic, ordinary = scorer.compressors()
        for part in slices(batches):
            found = [features_of(t, toxic, ordinary) for t in part.column(part.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(found, pa.list_(pa.float64()))], [*keep, "features"]
            )

    fields = ", ".join(f"{docs.schema[c].name} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(compute, f"{fields}, features array<double>")


def learnt_from(text: Column) -> Column:
    """A text for fitting: whole, or windows spread evenly over a very long one."""
    size = FIT_CHARS // FIT_WINDOWS
    step = (F.char_length(text) - size) / F.lit(FIT_WINDOWS - 1)
    windows = F.transform(
        F.sequence(F.lit(0), F.lit(FIT_WINDOWS - 1)), lambda i: F.substring(text, F.floor(i * step).cast("int") + 1, F.lit(size))
    )
    return F.when(F.char_length(text) <= FIT_CHARS, text).otherwise(F.array_join(windows, " "))


def fit(docs: DataFrame, labels: DataFrame) -> Scorer:
    """Train and calibrate on the labelled documents outside the held-out quarter."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(~held_out(F.col("doc_id")))
    fold = F.crc32(F.col("doc_id").cast("string")) % 4 == 3
    texts = ids_and_texts(docs)

    def sample(rows: DataFrame, n: int) -> DataFrame:  # <= 2 n rows
        first = lambda value: rows.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        found = texts.join(F.broadcast(first(1).unionByName(first(0))), "doc_id")
        return found.groupBy("doc_id", "toxic").agg(F.min(learnt_from(F.col("text"))).alias("text"))

    rows = sample(known.where(~fold), DICTIONARY_DOCUMENTS).select("toxic", "text").distinct().collect()
    toxic, ordinary = (sorted(r["text"] for r in rows if r["toxic"] == value) for value in (1, 0))
    if not toxic or not ordinary:
        return Scorer()
    scorer = Scorer(*train(toxic, ordinary))
    found = document_features(sample(known.where(fold), CALIBRATION_DOCUMENTS), scorer, ["doc_id", "toxic"]).collect()
    found.sort(key=lambda r: str(r["doc_id"]))
    y = np.array([r["toxic"] for r in found], float)
    if not len(y) or y.min() == y.max():
        return Scorer()
    counts = {r["toxic"]: r["count"] for r in known.where(fold).groupBy("toxic").count().collect()}
    weight = np.where(y == 1, counts[1] / y.sum(), counts[0] / (len(y) - y.sum()))
    scorer.weights, scorer.bend = calibrate(np.array([r["features"] for r in found]), y, weight)
    return scorer


def score_documents(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    found = document_features(ids_and_texts(docs), scorer, ["doc_id"])
    if not scorer.weights:
        return found.select("doc_id", F.lit(0.0).alias("score"))
    terms = [F.lit(w) * F.element_at("features", i) for i, w in enumerate(scorer.weights[1:], 1)]
    total = sum(terms, F.lit(scorer.weights[0]))
    return found.select("doc_id", F.pow(1 / (1 + F.exp(-total)), F.lit(scorer.bend)).alias("score"))


def reject(docs: DataFrame, scorer: Scorer, cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` without the rows whose text scores ``cutoff`` or more, in one map."""

    at = docs.columns.index("text")

    def keep(batches):
        toxic, ordinary = scorer.compressors()
        for part in slices(batches):
            texts = (t or "" for t in part.column(at).to_pylist())
            found = scorer.score(np.array([features_of(t, toxic, ordinary) for t in texts]))
            yield part.filter(pa.array(found < cutoff))

    return docs.mapInArrow(keep, docs.schema) if scorer.weights else docs
