"""Benchmark decontamination by winnowing.

Of the hashes of all k-word grams in a text, the smallest of every `window`
neighbouring ones is kept as a fingerprint, so that two texts which share
window + k - 1 words share a fingerprint inside them.  Fingerprints of training
texts are joined to those of the benchmark; each hit is extended to the spans
of `span` words around it, whose words are compared one by one.  With span =
window + k - 1, no shared span is missed.  An item of fewer words, but not
none, is one span of its own; its fingerprint is the hash of all of its words.

Edge cases: null texts have no words and no hits.  An item with a null id hits,
but adds no id.  Repeated documents are judged one by one, repeated items count
once.  An empty benchmark hits nothing; an empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import Words, buffers, pieces, text_digest, written

SPAN = 10
K = 5
#: A benchmark of at most this many bytes of text is broadcast, as an index about ten times as large; a larger one is joined in shuffles.
BROADCAST_BYTES = 8 << 20
_MOST = np.uint64(2**64 - 1)


def winnow(grams: np.ndarray, same: np.ndarray, window: int) -> np.ndarray:
    """Places whose hash is the smallest of a window that holds them; all of equal hashes, for ties."""
    value = np.where(same, grams, _MOST)
    n = len(value)
    if not n:
        return np.zeros(0, np.int64)
    low = value.copy()  # of the window that begins here, cut at the end
    for j in range(1, min(window, n)):
        np.minimum(low[: n - j], value[j:], out=low[: n - j])
    high = low.copy()  # over the windows that hold this place
    for j in range(1, min(window, n)):
        np.maximum(high[j:], low[: n - j], out=high[j:])
    return np.flatnonzero((high == value) & same)


class Benchmark:
    """The spans of some items, by hash, and their fingerprints, in packed arrays."""

    def __init__(self, items: list[tuple[str | None, str | None]], span: int = SPAN, k: int = K):
        self.span, self.k, self.window = span, min(k, span), span - min(k, span) + 1
        self.words = words = Words(*buffers(pa.array([t or "" for _, t in items], pa.large_string())))
        self.names = sorted({i for i, _ in items if i is not None})
        number = {x: n for n, x in enumerate(self.names)}
        item = np.array([number.get(i, -1) for i, _ in items], np.int64)
        counts, text = words.counts(), np.repeat(np.arange(len(items)), words.counts())
        grams, same = words.grams(self.k)
        at = winnow(grams, same, self.window)
        at = at[counts[text[at]] >= span] if len(at) else at
        #: by k; of whole short items, by the negative number of their words
        self.prints = {self.k: np.unique(grams[at])} if len(at) else {}
        #: by the number of words: hashes of spans, a place each in words, and the items that have them, by bounds
        self.spans: dict[int, tuple[np.ndarray, ...]] = {}
        for n in sorted({min(span, c) for c in counts.tolist() if c}):
            grams, same = words.grams(n)
            at = np.flatnonzero(same)
            at = at[(counts[text[at]] >= span) if n == span else (counts[text[at]] == n)]
            self.spans[n] = self._packed(grams[at], at, item[text[at]])
            if n < span:
                self.prints[-n] = self.spans[n][0]
        del words.hashes

    @staticmethod
    def _packed(keys: np.ndarray, places: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((items, keys))
        keys, places, items = keys[order], places[order], items[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        new = np.append(True, (keys[1:] != keys[:-1]) | (items[1:] != items[:-1])) & (items >= 0)
        bounds = np.searchsorted(np.flatnonzero(new), np.append(first, len(keys)))
        return keys[first], places[first], bounds, items[new].astype(np.int32)

    def hits(self, data: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, list[str], list[tuple[int, int]]]]:
        """Of each text: words, words hit, ids of items, and the spans of words that are hit."""
        words = Words(data, offs)
        hit = np.zeros(len(words) + 1, np.int64)  # +1 where a hit span begins, -1 after it ends
        items: dict[int, set] = {}
        for n, prints in self.prints.items():
            size = n if n > 0 else -n
            grams, same = words.grams(size)
            places = winnow(grams, same, self.window) if n > 0 else np.flatnonzero(same)
            seeds = places[_isin(grams[places], prints)]
            self._extend(words, seeds, size, self.span if n > 0 else size, hit, items)
        covered = np.cumsum(hit[:-1]) > 0
        out = []
        for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], covered[a:b].view(np.int8), [0])))) if i in items else np.zeros(0, int)
            out.append((b - a, int(covered[a:b].sum()), sorted(items.get(i, ())), list(zip(edges[::2].tolist(), edges[1::2].tolist()))))
        return out

    def _extend(self, words: Words, seeds: np.ndarray, size: int, span: int, hit: np.ndarray, items: dict[int, set]) -> None:
        """Tests every span that holds a seed, and marks those that some item has."""
        if not len(seeds):
            return
        (keys, places, bounds, of), (grams, same) = self.spans[span], words.grams(span)
        starts = np.unique((seeds[:, None] - np.arange(span - size + 1)).ravel())
        starts = starts[(starts >= 0) & (starts < len(grams))]
        starts = starts[same[starts]]
        starts = starts[_isin(grams[starts], keys)]
        text = np.searchsorted(words.first, starts, side="right") - 1
        for p, i, at in zip(starts.tolist(), text.tolist(), np.searchsorted(keys, grams[starts]).tolist()):
            there = int(places[at])
            if words.strings(p, p + span) == self.words.strings(there, there + span):
                hit[p] += 1
                hit[p + span] -= 1
                items.setdefault(i, set()).update(self.names[x] for x in of[bounds[at] : bounds[at + 1]].tolist())


def _isin(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    at = np.searchsorted(of, values)
    at[at == len(of)] = 0
    return of[at] == values if len(of) else np.zeros(len(values), bool)


_RESULT = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", span: int = SPAN, k: int = K, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """id, n_words, n_hit, items (ids as strings, sorted) and spans (of words, end excluded) of every document."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    found = _by_broadcast(source, items, span, k) if size <= broadcast_bytes else _by_join(source, items, span, k)
    return found.withColumnRenamed("__id", id_col)


def _by_broadcast(source: DataFrame, items: DataFrame, span: int, k: int) -> DataFrame:
    index = source.sparkSession.sparkContext.broadcast(Benchmark([tuple(r) for r in items.collect()], span, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = buffers(batch.column(1))
            for a, b in pieces(offs):
                yield _batch(batch.column(0).slice(a, b - a), index.value.hits(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]))

    return source.mapInArrow(run, f"__id {source.schema['__id'].dataType.simpleString()}, {_RESULT}")


def _batch(ids: pa.Array, found: list) -> pa.RecordBatch:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.list_(pa.string())), pa.array([[{"start": s, "end": e} for s, e in f[3]] for f in found], spans)]
    return pa.RecordBatch.from_arrays([ids, *columns], ["__id", "n_words", "n_hit", "items", "spans"])


def _fingerprints(texts: DataFrame, span: int, k: int, lengths: list[int]) -> DataFrame:
    """key, length (0, or that of a whole short item) and hash of every fingerprint of texts (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = buffers(batch.column(1))
            for a, b in pieces(offs):
                words = Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                for n in (0, *lengths):
                    grams, same = words.grams(n or k)
                    at = np.flatnonzero(same) if n else winnow(grams, same, span - k + 1)
                    text = np.searchsorted(words.first, at, side="right") - 1
                    keys = batch.column(0).slice(a, b - a).take(pa.array(text))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(np.full(len(at), n, np.int32)), pa.array(grams[at].view(np.int64))], ["key", "length", "hash"])

    return texts.mapInArrow(run, f"key {texts.schema['key'].dataType.simpleString()}, length int, hash long").distinct()


def _by_join(source: DataFrame, items: DataFrame, span: int, k: int) -> DataFrame:
    """For a benchmark too large to broadcast: fingerprints meet in a shuffle, then the pairs' texts do.

    Each distinct text is looked up once, so that ids may be null or repeated.
    """
    count = count_of("text")
    items = items.filter(F.col("text").isNotNull()).withColumn("n", count).filter("n > 0").groupBy("text", "n").agg(F.array_sort(F.collect_set("item")).alias("ids")).withColumn("key", text_digest(F.col("text")))
    items = written(items, "items")
    lengths = sorted(r["n"] for r in items.filter(F.col("n") < span).select("n").distinct().collect())
    texts = source.select(text_digest(F.coalesce("__text", F.lit(""))).alias("key"), F.coalesce("__text", F.lit("")).alias("text"))
    of_docs = _fingerprints(texts, span, k, lengths)
    of_items = _fingerprints(items.select("key", "text"), span, k, lengths).withColumnRenamed("key", "item_key")
    whole = of_items.join(items.select(F.col("key").alias("item_key"), "n"), "item_key").filter((F.col("length") == 0) & (F.col("n") >= span) | (F.col("length") == F.col("n"))).drop("n")
    pairs = written(of_docs.join(whole, ["length", "hash"]).select("key", "item_key").distinct(), "pairs")
    met = pairs.join(texts.groupBy("key").agg(F.first("text").alias("text")), "key").join(items.select(F.col("key").alias("item_key"), F.col("text").alias("item_text"), "ids"), "item_key").select("key", "text", "item_text", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, item, ids in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                (_, _, named, spans), = Benchmark([(x, item) for x in ids or [None]], span, k).hits(*buffers(pa.array([text], pa.large_string())))
                out.append((0, 0, named, spans))
            yield _batch(batch.column(0), out)

    hits = met.mapInArrow(run, f"__id binary, {_RESULT}").withColumnRenamed("__id", "key").filter(F.size("spans") > 0)
    places = hits.select("key", F.explode("spans").alias("s")).select("key", F.explode(F.sequence("s.start", F.col("s.end") - 1)).alias("p")).distinct().groupBy("key").agg(F.array_sort(F.collect_list("p")).alias("p"))
    named = hits.select("key", F.explode_outer("items").alias("x")).groupBy("key").agg(F.array_sort(F.collect_set("x")).alias("items"))
    spans = F.expr("aggregate(slice(p, 2, size(p)), array(named_struct('start', p[0], 'end', p[0] + 1)), (acc, x) -> if(x = element_at(acc, -1).end, concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', x + 1))), concat(acc, array(named_struct('start', x, 'end', x + 1)))))")
    joined = source.withColumn("key", text_digest(F.coalesce("__text", F.lit("")))).withColumn("n_words", F.coalesce(count_of("__text"), F.lit(0)).cast("long")).drop("__text")
    joined = joined.join(places.withColumn("spans", spans).withColumn("n_hit", F.size("p").cast("long")).drop("p"), "key", "left").join(named, "key", "left")
    return joined.select("__id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"))


def count_of(text_col: str):
    """The number of words of a text."""
    return F.regexp_count(F.translate(text_col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))


def keep(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs without a hit, whole, with all their columns."""
    names = {f"c{i}": c for i, c in enumerate(docs.columns)}
    packed = docs.select(F.struct(*[F.col(c).alias(k) for k, c in names.items()]).alias("row"), F.col(text_col).alias("text"))
    found = decontaminate(packed, benchmark, "row", "text", **options).filter("n_hit = 0")
    return found.select(*[F.col(f"row.{k}").alias(c) for k, c in names.items()])
