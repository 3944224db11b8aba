"""Near-duplicate documents: consistent weighted samples of TF-IDF shingles, banded, then verified.

A text's shingles are its runs of five words; a text of fewer words has one
shingle.  A shingle weighs its count in the text times the mean, over its words,
of log(1 + N / df).  (df of the shingles themselves would set what a large group
of near copies shares at almost nothing against what its members don't share.)
df is counted over all documents in a count-min sketch, so that its size is
fixed; the same weights serve for sampling and for verifying.  Improved consistent
weighted sampling draws `hashes` samples a text, two texts agreeing in each
with the probability of their weighted Jaccard similarity; `rows` samples make
a band.

Texts that share a band with another are weighed: what weight of a text lies in
shingles that none of these other texts has bounds its similarity to any of
them, and so rules out most pairs without reading them.  Of each bucket, the
text with the least such weight is the centre, which meets all others; what
isn't linked to the centre meets all of the bucket that the bound allows.  Only
pairs that the bound excludes, or that are linked through a centre of a bucket
they share, don't meet, so that each class is whole.  A bucket of copies costs
one comparison a text.  Verified links make classes by their connected components.

Exact copies are one text throughout.  Each document gets the smallest id of
its class.  Edge cases: a null text is a class of its own; a text without words
is like exact copies of itself only.  Ids may be null or repeated: rows of one
text share a class whatever their ids.  An empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import Words, broadcast_if_small, buffers, mix64, multipliers, pieces, shingles, text_digest, written

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 12
ROWS = 3
#: The sketch of document frequencies: rows of cells.
SKETCH_ROWS = 2
SKETCH_CELLS = 1 << 20
_CHUNK = 1 << 14
#: Against rounding, pairs are ruled out only this far below the similarity asked for.
_SLACK = 1e-6
_LEVELS = 1 << 16


def _gamma_levels() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at _LEVELS midpoints, by Newton's method."""
    u = (np.arange(_LEVELS) + 0.5) / _LEVELS
    x = np.maximum(np.sqrt(2 * u), -np.log1p(-u))
    for _ in range(60):
        x = np.maximum(x - (1 - np.exp(-x) * (1 + x) - u) / np.maximum(x * np.exp(-x), 1e-300), x / 4)
    return x


_GAMMA = _gamma_levels().astype(np.float32)
_LOG_GAMMA = np.log(_gamma_levels()).astype(np.float32)


def _distinct(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts values within their owners, and where in it each distinct value begins."""
    order = np.argsort(value)
    order = order[np.argsort(owner[order], kind="stable")]
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return order, np.flatnonzero(new)


class Shingled:
    """The distinct shingles of some texts, text by text, with their TF-IDF weights."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, idf: np.ndarray, k: int = SHINGLE):
        words = Words(data, offs)
        n = words.counts()
        sums = np.append(0.0, np.cumsum(_idf_of(words.hashes, idf), dtype=np.float64))
        grams, same = words.grams(k)
        at = np.flatnonzero(same)
        text = np.repeat(np.arange(len(n)), n)[at]
        short = np.flatnonzero((n > 0) & (n < k))
        value, owner, mean = [grams[at]], [text], [(sums[at + k] - sums[at]) / k]
        if len(short):
            value.append(np.concatenate([shingles(words, int(i), k, grams) for i in short]))
            owner.append(short)
            mean.append((sums[words.first[short + 1]] - sums[words.first[short]]) / n[short])
        value, owner, mean = np.concatenate(value), np.concatenate(owner), np.concatenate(mean)
        order, new = _distinct(value, owner)
        self.values, self.owners = value[order[new]], owner[order[new]]
        self.weights = (mean[order[new]] * np.diff(np.append(new, len(order)))).astype(np.float32)
        self.first = np.searchsorted(self.owners, np.arange(len(n) + 1))


def _cells(values: np.ndarray, cells: int) -> list[np.ndarray]:
    shift = np.uint64(64 - int(cells).bit_length() + 1)
    return [(values * m >> shift).astype(np.int64) for m in multipliers(SKETCH_ROWS, 3)]


def frequencies(docs: DataFrame, text_col: str = "text", cells: int = SKETCH_CELLS) -> np.ndarray:
    """idf by sketch row and cell, from the document frequencies of the words of all texts.

    Each task adds up its own sketch and sends what isn't zero; tasks that each
    hold a range of cells add those up.  The result has a fixed size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, texts = np.zeros((SKETCH_ROWS, cells), np.int64), 0
        for batch in batches:
            data, offs = buffers(batch.column(0))
            texts += batch.num_rows
            for a, b in pieces(offs):
                words = Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                order, new = _distinct(words.hashes, np.repeat(np.arange(b - a), words.counts()))
                for r, cell in enumerate(_cells(words.hashes[order[new]], cells)):
                    sums[r] += np.bincount(cell, minlength=cells)
        flat, chunks, blobs = sums.ravel(), [-1], [np.array([texts], "<u8").tobytes()]
        for c in range(0, len(flat), _CHUNK):
            at = np.flatnonzero(flat[c : c + _CHUNK])
            if len(at):
                chunks.append(c // _CHUNK)
                blobs.append(at.astype("<u2").tobytes() + flat[c + at].astype("<u8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(blobs, pa.binary())], ["chunk", "blob"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = held.setdefault(c, np.zeros(_CHUNK if c >= 0 else 1, np.int64))
                n = len(blob) // 10 if c >= 0 else 0
                if c >= 0:
                    total[np.frombuffer(blob[: 2 * n], "<u2")] += np.frombuffer(blob[2 * n :], "<u8").astype(np.int64)
                else:
                    total[0] += int(np.frombuffer(blob, "<u8")[0])
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["chunk", "blob"])

    schema = "chunk int, blob binary"
    sent = docs.select(F.col(text_col).cast("string")).mapInArrow(count, schema)
    chunks = {r["chunk"]: np.frombuffer(r["blob"], np.int64) for r in sent.repartition(32, "chunk").mapInArrow(add, schema).collect()}
    flat = np.zeros(SKETCH_ROWS * cells, np.int64)
    for c, x in chunks.items():
        if c >= 0:
            flat[c * _CHUNK : (c + 1) * _CHUNK] = x
    texts = max(1, int(chunks.get(-1, [0])[0]))
    return np.log1p(texts / np.maximum(flat, 1)).astype(np.float32).reshape(SKETCH_ROWS, cells)


def _idf_of(values: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Of the sketch's rows the least frequency counts, which has the largest idf."""
    found = [idf[r][cell] for r, cell in enumerate(_cells(values, idf.shape[1]))]
    return np.maximum.reduce(found)


def samples(found: Shingled, hashes: int) -> np.ndarray:
    """Improved consistent weighted samples: of each text with shingles, `hashes` 64-bit values.

    For shingle s and hash j, r and c are Gamma(2, 1) and b is uniform, all fixed
    by (s, j); with t = floor(log(w) / r + b), the sample is the (s, t) of the
    least log(c) - r (t - b + 1).
    """
    some = np.flatnonzero(np.diff(found.first))
    starts = found.first[:-1][some]
    lengths = np.diff(found.first)[some]
    log_w = np.log(found.weights)
    out = np.zeros((len(some), hashes), np.uint64)
    mask = np.uint64(_LEVELS - 1)
    for j, m in enumerate(multipliers(hashes, 4)):
        u = mix64(found.values ^ m)
        r = _GAMMA[u & mask]
        b = ((u >> np.uint64(16)) & mask).astype(np.float32) * np.float32(1 / _LEVELS)
        t = np.floor(log_w / r + b)
        value = _LOG_GAMMA[(u >> np.uint64(32)) & mask] - r * (t - b + 1)
        at = np.flatnonzero(value == np.repeat(np.minimum.reduceat(value, starts), lengths))
        at = at[np.searchsorted(at, starts)]  # the first of equal ones
        out[:, j] = mix64(found.values[at] + mix64(t[at].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j)))
    return out


def signatures(docs: DataFrame, idf: np.ndarray, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS, k: int = SHINGLE) -> DataFrame:
    """id, digest (null for a null text) and bands (null without words) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(idf)
    source = docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = buffers(batch.column(2))
            for a, b in pieces(offs, 1 << 19):
                found = Shingled(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], sent.value, k)
                made: list = [None] * (b - a)
                if len(found.values):
                    drawn = samples(found, bands * rows).reshape(-1, bands, rows)
                    total = (drawn * multipliers(rows, 5)).sum(2, dtype=np.uint64)
                    for i, x in zip(np.flatnonzero(np.diff(found.first)), mix64(total).view(np.int64)):
                        made[i] = x
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(made, pa.list_(pa.int64()))], ["id", "digest", "bands"])

    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, digest binary, bands array<long>")


def _weighed(texts: DataFrame, idf, k: int) -> DataFrame:
    """digest, values and weights (shingles in ascending order, packed) and total weight of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = buffers(batch.column(1))
            for a, b in pieces(offs, 1 << 19):
                found = Shingled(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], idf.value, k)
                at = found.first.tolist()
                cut = list(zip(at[:-1], at[1:]))
                values, weights = found.values.astype("<u8"), found.weights.astype("<f4")
                packed = [pa.array([x[i:j].tobytes() for i, j in cut], pa.binary()) for x in (values, weights)]
                total = pa.array([float(found.weights[i:j].sum(dtype=np.float64)) for i, j in cut], pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *packed, total], ["digest", "values", "weights", "total"])

    return texts.select("digest", "text").mapInArrow(run, "digest binary, values binary, weights binary, total double")


def _own_weight(held: DataFrame) -> DataFrame:
    """node and the weight of its shingles that no other node has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                values = [np.frombuffer(x, "<i8") for x in some.column(1).to_pylist()]
                weights = np.concatenate([np.frombuffer(x, "<f4") for x in some.column(2).to_pylist()])
                node = np.repeat(nodes[at : at + 256], [len(x) for x in values])
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(np.concatenate(values), pa.int64()), pa.array(weights.astype(float), pa.float64())], ["node", "v", "w"])

    each = held.select("node", "values", "weights").mapInArrow(run, "node long, v long, w double")
    alone = each.groupBy("v").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.min("w").alias("w")).filter("n = 1")
    return alone.groupBy("node").agg(F.sum("w").alias("own"))


def _verified(pairs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes that are similar, with their weighted Jaccard similarity."""
    left, right = (held.select(F.col("node").alias(n), *(F.col(c).alias(f"{c}_{n}") for c in ("values", "weights", "total"))) for n in "ab")
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "values_a", "weights_a", "total_a", "values_b", "weights_b", "total_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            packed = [batch.column(c) for c in (2, 3, 5, 6)]
            total = batch.column(4).to_numpy() + batch.column(7).to_numpy()
            for i in range(batch.num_rows):
                x, wx, y, wy = (np.frombuffer(column[i].as_buffer(), kind) for column, kind in zip(packed, ("<u8", "<f4", "<u8", "<f4")))
                if not len(x) or not len(y):
                    continue
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                same = y[at] == x
                shared = float(np.minimum(wx[same], wy[at[same]]).sum(dtype=np.float64))
                out[i] = shared / (total[i] - shared)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], ["a", "b", "similarity"])

    return met.mapInArrow(run, "a long, b long, similarity double").filter(F.col("similarity") >= similarity)


def _may_link(a: str, b: str, similarity: float) -> Column:
    """Whether the weight that others have too lets a and b be similar enough."""
    most = F.least(f"{a}.others", f"{b}.others")
    return most >= (similarity - _SLACK) * (F.col(f"{a}.total") + F.col(f"{b}.total") - most)


def _links(texts: DataFrame, docs: DataFrame, idf: np.ndarray, similarity: float, k: int) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between nodes, and the nodes with their digests; texts has digest, bands and id."""
    sent = texts.sparkSession.sparkContext.broadcast(idf)
    placed = texts.select("digest", F.posexplode("bands").alias("band", "h"))
    shared = placed.groupBy("band", "h").agg(F.count("*").alias("n")).filter("n > 1")
    met = written(placed.join(shared, ["band", "h"]), "met")
    wanted = written(met.groupBy("digest").agg(F.sum("n").alias("weight")).join(texts.select("digest", "bands", F.col("id").alias("first_id")), "digest"), "wanted")
    few = wanted.select("digest", "first_id")
    few = broadcast_if_small(few, 96)
    source = docs.select(text_digest(F.col("text")).alias("digest"), F.col("id"), "text")
    source = source.join(few, "digest").filter(F.col("id").eqNullSafe(F.col("first_id"))).select("digest", "text").dropDuplicates(["digest"])
    held = written(_weighed(source, sent, k).withColumn("node", F.monotonically_increasing_id()), "held")

    # a text whose own shingles weigh too much is similar to no other
    nodes = held.select("node", "digest", "total").join(_own_weight(held), "node", "left").withColumn("others", F.col("total") - F.coalesce("own", F.lit(0.0)))
    nodes = nodes.filter(F.col("others") >= (similarity - _SLACK) * F.col("total")).join(wanted.select("digest", "weight", "bands"), "digest")
    nodes = written(nodes.select("node", "digest", "total", "others", "weight", "bands"), "nodes")
    members = written(met.select("band", "h", "digest").join(nodes, "digest").drop("digest"), "members")

    # the text with least of its own is nearest to what the others are copies of
    first = F.min(F.struct((-F.col("others") / F.col("total")).alias("r"), (-F.col("weight")).alias("w"), "node", "total", "others"))
    centres = members.groupBy("band", "h").agg(first.alias("c"), F.count("*").alias("n")).filter("n > 1").select("band", "h", "c.node", "c.total", "c.others")
    by_centre = members.alias("m").join(centres.alias("c"), ["band", "h"])
    pairs = by_centre.filter(F.col("m.node") != F.col("c.node")).filter(_may_link("m", "c", similarity))
    links = written(_verified(pairs.select(F.least("m.node", "c.node").alias("a"), F.greatest("m.node", "c.node").alias("b")).distinct(), held, similarity), "links")

    # what isn't linked to the centre of a bucket meets all of the bucket
    state = by_centre.select("band", "h", "m.node", "m.total", "m.others", "m.bands", F.col("c.node").alias("centre"), F.least("m.node", "c.node").alias("a"), F.greatest("m.node", "c.node").alias("b"))
    state = state.filter("node <> centre").join(links.select("a", "b", F.lit(True).alias("linked")), ["a", "b"], "left").withColumn("linked", F.coalesce("linked", F.lit(False))).drop("a", "b", "centre")
    state = written(state, "state")
    again = (F.col("x.node") != F.col("y.node")) & (F.col("y.linked") | (F.col("x.node") < F.col("y.node"))) & _may_link("x", "y", similarity)
    # a pair meets in the first band it shares
    x, y = state.filter("not linked").alias("x"), state.alias("y")
    both = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.h") == F.col("y.h")) & again & ~F.expr("exists(sequence(0, x.band), i -> i < x.band AND x.bands[i] = y.bands[i])"))
    pairs = both.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    return links.unionByName(written(_verified(pairs, held, similarity), "links")), nodes.select("node", "digest")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root, the least node of its component, of every node that has a link.

    Each round, a node takes the least root among its neighbours', and then its
    root's root; every round is a written table.
    """
    edges = written(links.select(F.col(a).alias("x"), F.col(b).alias("y")).unionByName(links.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct(), "edges")
    roots = edges.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("root"))
    roots = written(roots, "roots")
    while True:
        near = edges.join(roots.withColumnRenamed("node", "y"), "y").groupBy("x").agg(F.min("root").alias("near"))
        hooked = roots.join(near, roots["node"] == near["x"]).select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("up"))
        found = written(hooked.join(up, "root", "left").select("node", "was", F.least("root", F.coalesce("up", "root")).alias("root")), "roots")
        if found.filter("was <> root").isEmpty():
            return found.select("node", "root")
        roots = found.select("node", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, k: int = SHINGLE, cells: int = SKETCH_CELLS) -> DataFrame:
    """id, class_id (the least id of its class), representative (its row is the class's) and digest of every row."""
    idf = frequencies(docs, text_col, cells)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = written(signatures(source, idf, "id", "text", bands, rows, k), "signed")
    texts = written(signed.filter("digest is not null").groupBy("digest").agg(F.first("bands").alias("bands"), F.min("id").alias("id")), "nodes")
    links, nodes = _links(texts, source, idf, similarity, k)
    linked = components(links).join(nodes, "node").join(texts.select("digest", "id"), "digest")
    least = F.min(F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("digest").alias("d")))
    classes = linked.join(linked.groupBy("root").agg(least.alias("head")), "root").select("digest", "head")
    alone = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("digest").alias("d"))
    classes = texts.select("digest", "id").join(classes, "digest", "left").withColumn("head", F.coalesce("head", alone))
    classes = classes.select("digest", F.col("head.i").alias("class_id"), F.col("head.d").alias("head"))
    found = signed.select("id", "digest").join(classes, "digest", "left")
    mine = F.col("digest").isNull() | (F.col("digest") == F.col("head")) & F.col("id").eqNullSafe(F.col("class_id"))
    return found.select(F.col("id").alias(id_col), F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), mine.alias("representative"), "digest")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that stay: one of each class, and every row of a null text."""
    found = near_duplicates(docs, id_col, text_col, **options).filter("representative and digest is not null").select(F.col(id_col).alias("__id"), F.col("digest").alias("__digest")).distinct()
    marked = docs.filter(F.col(text_col).isNotNull()).withColumn("__own", text_digest(F.col(text_col)))
    kept = marked.join(found, (F.col("__own") == F.col("__digest")) & F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    kept = kept.dropDuplicates([id_col, "__own"]).drop("__own")
    return kept.unionByName(docs.filter(F.col(text_col).isNull()))

