"""Toxicity by class-conditional Kneser-Ney models of characters in words.

Two models of order `order`, one of the toxic and one of the ordinary labelled
texts, back off to one shared model of lower orders, whose counts are those of
distinct continuations in both classes: an expression too rare to be known to
either class then weighs nothing.  A text is scored by the difference of its
length-normalised log-likelihoods: over the whole text, over its most toxic
window of words and over its most toxic word, which a logistic regression turns
into a probability.  It is fitted on features of labelled rows by models that
haven't counted the fold they are in.

Counts are gathered from every labelled row; only the regression is fitted on
at most `calibration_rows` of them, those with the smallest hashes of their
ids.  The order is the same at any size.  The table of n-grams, which grows with
the labelled texts' kinds of words, is collected and broadcast; one of more than
`most_types` entries (24 bytes each) is refused before it is collected.

Edge cases: null and empty texts have features of zero and the score of the
regression's intercept.  Labels of one id are united by their maximum; null
labels are dropped.  If a class has no labelled text, every score is 0.
Repeated rows are scored alike; an empty table gives an empty result; ids may
be null; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import BROADCAST_BYTES, Words, buffers, mix64, multipliers, pieces, written

ORDER = 5
#: The folds that may be learned from, and the columns of their counts: by fold, then by class.
FOLDS = (0, 1, 3)
_COUNTS = [f"n{f}{y}" for f in FOLDS for y in (0, 1)]
DISCOUNT = 0.75
WINDOW = 10
MOST_TYPES = 10_000_000
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.3


def fold_of(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 4: 2 is held out."""
    return F.crc32(id_column.cast("string").cast("binary")) % 4


def _place(id_column: str) -> Column:
    """The place of a row's fold in FOLDS."""
    fold = fold_of(F.col(id_column))
    return F.when(fold == 3, 2).otherwise(fold).cast("int")


def _chars(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, each between order - 1 starts and an end; the word of each n-gram that begins there, or -1."""
    pad = "\x02" * (order - 1)
    codes = np.frombuffer("".join(f"{pad}{w}\x03" for w in words).encode("utf-32-le"), np.uint32)
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    which = np.repeat(np.arange(len(words)), lengths + order - 1)
    begin = np.cumsum(lengths + order - 1) - (lengths + order - 1)
    place = np.arange(len(codes)) - begin[which]
    return codes, np.where(place < lengths[which], which, -1)


def _keys(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit key for the `size` code points from each place on."""
    m = len(codes) - size + 1
    total = np.zeros(max(m, 0), np.uint64)
    for j, c in enumerate(multipliers(size, 2)):
        total += (codes[j : j + m].astype(np.uint64) + np.uint64(1)) * c
    return mix64(total + np.uint64(size))


def _unique_words(words: Words) -> tuple[list[str], np.ndarray]:
    """The distinct words as text, and the number of each word's."""
    _, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
    raw = words.data.tobytes()
    return [raw[s:e].decode("utf-8", "replace") for s, e in zip(words.starts[first].tolist(), words.ends[first].tolist())], inverse


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """gram and its counts by fold and class, from text, class and fold (its place in FOLDS)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = buffers(batch.column(0))
            group = np.array(batch.column(2).to_pylist(), np.int64) * 2 + np.array(batch.column(1).to_pylist(), np.int64)
            for a, b in pieces(offs, 4 << 20):
                words = Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                if not len(words):
                    continue
                unique, inverse = _unique_words(words)
                times = np.bincount(inverse * len(_COUNTS) + np.repeat(group[a:b], words.counts()), minlength=len(_COUNTS) * len(unique)).reshape(len(unique), -1)
                codes, which = _chars(unique, order)
                at = np.flatnonzero(which >= 0)
                _, first, gram = np.unique(_keys(codes, order)[at], return_index=True, return_inverse=True)
                sums = [np.bincount(gram, times[which[at], g], len(first)).astype(np.int64) for g in range(len(_COUNTS))]
                text = codes[at[first][:, None] + np.arange(order)].astype("<u4").tobytes().decode("utf-32-le")
                grams = [text[k : k + order] for k in range(0, len(text), order)]
                yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), *map(pa.array, sums)], ["gram", *_COUNTS])

    counted = texts.mapInArrow(count, "gram string, " + ", ".join(f"{c} long" for c in _COUNTS))
    return counted.groupBy("gram").agg(*(F.sum(c).alias(c) for c in _COUNTS))


class KneserNeyRatio:
    """log(toxic / ordinary) of n-grams: of those either class has seen by n-gram, of the others by context."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, discount: float = DISCOUNT):
        """codes: a row of code points for each n-gram; counts: its counts in class 0 and 1."""
        seen = counts.sum(1) > 0
        codes, counts, self.order = codes[seen], counts[seen].astype(float), codes.shape[1]
        key = lambda c: _keys(np.ascontiguousarray(c).ravel(), c.shape[1])[:: c.shape[1]] if len(c) else np.zeros(0, np.uint64)
        shared = self._shared(codes, key, discount)
        contexts, context = np.unique(key(codes[:, :-1]), return_inverse=True)
        logs, back = [], []
        for y in (0, 1):
            n, total = counts[:, y], np.bincount(context, counts[:, y], len(contexts))
            kinds = np.bincount(context, n > 0, len(contexts))
            with np.errstate(invalid="ignore", divide="ignore"):
                left = np.where(total > 0, discount * kinds / total, 1.0)
                own = np.where(total[context] > 0, np.maximum(n - discount, 0) / total[context], 0.0)
            logs.append(np.log(own + left[context] * shared))
            back.append(np.log(left))
        keys = key(codes)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], (logs[1] - logs[0])[order].astype(np.float32)
        self.context_keys, self.context_values = contexts, (back[1] - back[0]).astype(np.float32)

    @staticmethod
    def _shared(codes: np.ndarray, key, discount: float) -> np.ndarray:
        """The shared probability of each n-gram's last character after its shorter contexts."""
        n = codes.shape[1]
        symbols = len(np.unique(codes[:, -1])) + 1
        tables, types = {}, codes
        for size in range(n - 1, 0, -1):
            keys, first, times = np.unique(key(types[:, 1:]), return_index=True, return_counts=True)
            types = types[first][:, 1:]
            tables[size] = (keys, types, times.astype(float))
        lower_keys, lower = None, None
        for size in range(1, n):
            keys, types, times = tables[size]
            ctx, of = (np.unique(key(types[:, :-1]), return_inverse=True)) if size > 1 else (np.zeros(1), np.zeros(len(types), np.int64))
            total, kinds = np.bincount(of, times, len(ctx)), np.bincount(of, minlength=len(ctx))
            below = lower[np.searchsorted(lower_keys, key(types[:, 1:]))] if size > 1 else np.full(len(types), 1 / symbols)
            lower_keys, lower = keys, (np.maximum(times - discount, 0) + discount * kinds[of] * below) / total[of]
        if n == 1:
            return np.full(len(codes), 1 / symbols)
        return lower[np.searchsorted(lower_keys, key(codes[:, 1:]))]

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The log ratio of each word, and its length in n-grams."""
        codes, which = _chars(words, self.order)
        at = np.flatnonzero(which >= 0)
        value = np.zeros(len(at), np.float64)
        if len(self.context_keys):
            self._look_up(_keys(codes, self.order - 1)[at], self.context_keys, self.context_values, value) if self.order > 1 else None
            self._look_up(_keys(codes, self.order)[at], self.keys, self.values, value)
        return np.bincount(which[at], value, len(words)), np.bincount(which[at], minlength=len(words)).astype(float)

    @staticmethod
    def _look_up(keys: np.ndarray, known: np.ndarray, values: np.ndarray, out: np.ndarray) -> None:
        at = np.searchsorted(known, keys)
        at[at == len(known)] = 0
        found = known[at] == keys
        out[found] = values[at[found]]


def text_features(data: np.ndarray, offs: np.ndarray, model: KneserNeyRatio, window: int = WINDOW) -> np.ndarray:
    """Of each text: the mean log ratio a character of the whole, of the most toxic window and of the most toxic word."""
    words = Words(data, offs)
    out = np.zeros((len(offs) - 1, 3))
    if not len(words):
        return out
    unique, inverse = _unique_words(words)
    ratio, size = (x[inverse] for x in model.of_words(unique))
    sums, sizes = np.append(0, np.cumsum(ratio)), np.append(0, np.cumsum(size))
    each = ratio / size
    n = words.counts()
    some = np.flatnonzero(n)
    first, last = words.first[:-1][some], words.first[1:][some]
    out[some, 0] = (sums[last] - sums[first]) / (sizes[last] - sizes[first])
    out[some, 2] = np.maximum.reduceat(each, first)
    stop = np.minimum(np.arange(len(words)) + window, np.repeat(last, n[some]))
    begin = np.minimum(np.arange(len(words)), np.maximum(np.repeat(first, n[some]), stop - window))
    out[some, 1] = np.maximum.reduceat((sums[stop] - sums[begin]) / (sizes[stop] - sizes[begin]), first)
    return out


def _features(docs: DataFrame, model: KneserNeyRatio, keep: str) -> DataFrame:
    """`keep` and the features, from columns `keep` and text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = buffers(batch.column(1))
            for a, b in pieces(offs):
                x = text_features(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], sent.value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(x[:, k]) for k in range(3))], [keep, "whole", "window", "word"])

    return docs.select(keep, "text").mapInArrow(run, f"{keep} {docs.schema[keep].dataType.simpleString()}, whole double, window double, word double")


def fit_logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights and, last, intercept of a logistic regression, by Newton's method with a small ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), decay * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", order: int = ORDER, most_types: int = MOST_TYPES, calibration_rows: int = CALIBRATION_ROWS) -> tuple[KneserNeyRatio, np.ndarray] | None:
    """The model of all labelled rows outside the held-out fold, and the regression's weights; None if a class is missing."""
    marks = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold_of(F.col(id_col)) != 2)).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("class"))
    few = marks.count() * 64 <= BROADCAST_BYTES
    source = docs.select(F.col(id_col).alias("__id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    labelled = source.join(F.broadcast(marks) if few else marks, "__id").withColumn("fold", _place("__id"))
    counts = written(gram_counts(labelled.select("text", "class", "fold"), order), "grams")
    if (types := counts.count()) > most_types:
        raise ValueError(f"The labelled texts have {types} distinct n-grams of order {order}, more than {most_types}, which are not to be collected.")
    found = counts.toArrow()
    codes = np.frombuffer("".join(found.column("gram").to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, order)
    by = np.column_stack([found.column(c).to_numpy() for c in _COUNTS]).reshape(-1, len(FOLDS), 2)
    whole = by.sum(1)
    if not whole.sum(0).all():
        return None
    ids = marks.select("__id", "class")
    total = ids.count()
    if total > calibration_rows:  # about the smallest hashes first, so that a bounded number is sorted
        ids = ids.filter(F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < (1 << 20) * min(1.0, 1.1 * calibration_rows / total + 1e-4))
        ids = ids.orderBy(F.xxhash64("__id"), "__id").limit(calibration_rows)
    sample = written(source.join(F.broadcast(ids), "__id").select("class", _place("__id").alias("fold"), "text"), "sample")
    rows = sample
    got = [_features(rows.filter(F.col("fold") == f), KneserNeyRatio(codes, whole - by[:, f]), "class").toArrow() for f in range(len(FOLDS)) if (whole - by[:, f]).sum(0).all()]
    if not sum(map(len, got)):  # too few rows for folds: the fit sees counted ones
        got = [_features(rows, KneserNeyRatio(codes, whole), "class").toArrow()]
    got = pa.concat_tables(got)
    x = np.column_stack([got.column(c).to_numpy() for c in ("whole", "window", "word")])
    return KneserNeyRatio(codes, whole), fit_logistic(x, got.column("class").to_numpy().astype(float))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD, **options) -> DataFrame:
    """id, held_out, score, predicted and the three features of every document."""
    trained = train(docs, labels, id_col, text_col, label_col, **options)
    source = docs.select(F.col(id_col).alias("__id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    if trained is None:
        zero = F.lit(0.0)
        found = source.select("__id", zero.alias("whole"), zero.alias("window"), zero.alias("word"))
        value = zero
    else:
        model, w = trained
        found = _features(source, model, "__id")
        value = 1 / (1 + F.exp(-(F.col("whole") * float(w[0]) + F.col("window") * float(w[1]) + F.col("word") * float(w[2]) + float(w[3]))))
    found = found.withColumn("score", value)
    return found.select(F.col("__id").alias(id_col), F.coalesce(fold_of(F.col("__id")) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "whole", "window", "word")
