"""Byte-level BPE by a lexicon automaton, with exact merges for the words it lacks.

The words of the corpus (pre-tokens) are counted over all texts.  The frequent
ones are compiled, with their token ids as output, into a minimal acyclic
transducer: a shared-suffix automaton whose arcs carry numbers that add up to a
word's rank, and a table from ranks to ids.  The automaton is one block of
bytes; each Python worker maps it into memory.  All words of a batch walk it in
step.  Words outside it are merged by the rules of the vocabulary, exactly.
The lexicon is only an accelerator: ids never depend on what it holds.

Edge cases: null and empty texts encode to no ids and decode to the empty text.
Bytes that are not UTF-8 count as U+FFFD.  The string of a special token in a
text is that token.  Repeated rows are encoded one by one; an empty table gives
an empty result; ids may be null; further columns are ignored.
"""

from __future__ import annotations

import json
import mmap
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import PIECE_BYTES, buffers, pieces, written

#: The lexicon holds at most this many of the most frequent words.
LEXICON_WORDS = 1 << 18
#: Words longer than this many bytes are merged one by one.
_MATRIX_BYTES = 48
_NO_RANK = np.int32(2**31 - 1)
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


# --- the vocabulary ---------------------------------------------------------------------------


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges and tokens of a byte-level BPE file in the format of the tokenizers library."""

    def __init__(self, text: str):
        found = json.loads(text)
        model, of = found["model"], _byte_chars()
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in found["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for token, i in ids.items():
            self.tokens[i] = bytes(of[c] for c in token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.of_byte = np.full(256, -1, np.int32)
        for c, b in of.items():
            self.of_byte[b] = ids[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = size
        keys = np.array([ids[a] * size + ids[b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair of ids; _NO_RANK if there is none (-1 is no id)."""
        keys = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        good = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(good, self.order[at], _NO_RANK).astype(np.int32)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word: again and again, the leftmost pair of the lowest rank is merged."""
        out: list = [None] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > _MATRIX_BYTES:
                out[i] = self._merge_one(w)
            else:
                by_length.setdefault(len(w), []).append(i)
        for length, at in by_length.items():
            for k in range(0, len(at), 20_000):
                some = at[k : k + 20_000]
                for i, ids in zip(some, self._merge_block([words[i] for i in some], length)):
                    out[i] = ids
        return out

    def _merge_block(self, words: list[bytes], length: int) -> list[np.ndarray]:
        ids = self.of_byte[np.frombuffer(b"".join(words), np.uint8)].reshape(len(words), length)
        done: list = [None] * len(words)
        rows, left = np.arange(len(words)), length
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        while True:
            best = rank.argmin(1) if left > 1 else np.zeros(len(rows), np.int64)
            value = rank[np.arange(len(rows)), best] if left > 1 else np.full(len(rows), _NO_RANK)
            over = value == _NO_RANK
            for r, x in zip(rows[over], ids[over]):
                done[r] = x
            if over.all():
                return done
            rows, ids, rank, best, value = rows[~over], ids[~over], rank[~over], best[~over], value[~over]
            left -= 1
            here, col = np.arange(len(rows)), np.arange(left)
            ids = np.where(col <= best[:, None], ids[:, :-1], ids[:, 1:])
            ids[here, best] = self.merged[value]
            rank = np.where(col[:-1] < best[:, None], rank[:, :-1], rank[:, 1:])
            if left > 1:
                for side in (best - 1, best):
                    ok = (side >= 0) & (side < left - 1)
                    rank[here[ok], side[ok]] = self.ranks(ids[here[ok], side[ok]], ids[here[ok], side[ok] + 1])

    def _merge_one(self, word: bytes) -> np.ndarray:
        """The same for a long word, through a heap and a linked list: n log n."""
        import heapq

        n = len(word)
        ids = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        first = self.ranks(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != _NO_RANK]
        heapq.heapify(heap)
        lookup = self._pair_rank
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[r]), -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (x := lookup(ids[i], ids[k])) != _NO_RANK:
                    heapq.heappush(heap, (x, i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (x := lookup(ids[h], ids[i])) != _NO_RANK:
                heapq.heappush(heap, (x, h, ids[h], ids[i]))
        return np.array([x for x in ids if x >= 0], np.int32)

    @lru_cache(1 << 16)  # noqa: B019
    def _pair_rank(self, a: int, b: int) -> int:
        return int(self.ranks(np.array([a], np.int32), np.array([b], np.int32))[0])


# --- pre-tokens -------------------------------------------------------------------------------


@lru_cache(1)
def char_classes() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    out = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    return out


def token_starts(chars: np.ndarray, piece_starts: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in the code points of some texts, each of which begins at a piece start.

    The rules are those of the byte-level pattern: contractions after a bare
    apostrophe; runs of letters, of numbers and of other characters, each with
    one blank before it; white space, whose last character stands alone or goes
    with the run that follows.
    """
    n = len(chars)
    kind = char_classes()[chars]
    piece = np.zeros(n + 1, bool)
    piece[piece_starts] = piece[n] = True
    edge = piece.copy()
    edge[1:n] |= kind[1:] != kind[:-1]
    begins = edge[:n].copy()
    start = np.flatnonzero(edge[:n])
    if not len(start):
        return begins
    end = np.append(start[1:], n)
    what = kind[start]
    last = chars[end - 1]
    joined = ~piece[end]  # the next run is of the same text
    blanks = (what == _SPACE) & joined
    begins[end[blanks] - 1] = True
    begins[end[blanks & (last == 32)]] = False
    before = np.append(False, (blanks & (last == 32))[:-1])  # a blank belongs to this run
    bare = (what == _OTHER) & ~before & (end - start == 1) & (chars[start] == 39) & joined
    bare[:-1] &= what[1:] == _LETTER
    bare[-1] = False
    at = start[bare]
    if len(at):
        c1 = chars[at + 1]
        room = end[np.flatnonzero(bare) + 1] - at - 1
        c2 = np.where(room > 1, chars[np.minimum(at + 2, n - 1)], 0)
        one = (c1 == ord("s")) | (c1 == ord("t")) | (c1 == ord("m")) | (c1 == ord("d"))
        two = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l")))
        size = np.where(one, 1, np.where(two, 2, 0))
        at, size = at[size > 0], size[size > 0]
        begins[at + 1] = False
        to = at + 1 + size
        begins[to[to < n]] = True
    return begins


class PreTokens:
    """The pre-tokens of some texts, as ranges of their UTF-8 bytes; special tokens have an id instead."""

    def __init__(self, texts: list[str], vocabulary: Vocabulary):
        parts, owner, special = [], [], []
        for i, text in enumerate(texts):
            if vocabulary.split and any(t in text for t in vocabulary.special):
                split = [x for x in vocabulary.split.split(text) if x]
            else:
                split = [text] if text else []
            parts += split
            owner += [i] * len(split)
            special += [vocabulary.special.get(x, -1) if len(split) > 1 or x in vocabulary.special else -1 for x in split]
        joined = "".join(parts)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(x) for x in parts], np.int64)
        starts = np.cumsum(lengths) - lengths
        begins = token_starts(chars, starts)
        for k in np.flatnonzero(np.array(special, np.int64) >= 0):
            begins[starts[k] + 1 : starts[k] + lengths[k]] = False
        at = np.flatnonzero(begins)
        width = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
        offset = np.append(0, np.cumsum(width))
        self.data = np.frombuffer(joined.encode(), np.uint8)
        self.starts = offset[at]
        self.ends = np.append(self.starts[1:], len(self.data))
        part = np.searchsorted(starts, at, side="right") - 1
        self.text = np.array(owner, np.int64)[part] if len(part) else part
        self.special = np.array(special, np.int64)[part] if len(part) else part


# --- the lexicon automaton --------------------------------------------------------------------


def build_lexicon(words: list[bytes], ids: list[np.ndarray]) -> bytes:
    """A minimal acyclic transducer from sorted, distinct words to ids, as one block of bytes.

    Layout: a header of array lengths, then for each state a bitmap of its
    labels, the number of arcs below each quarter of it and its first arc; for
    each arc its target and output; the final states; the ids by rank.
    """
    register: dict = {}
    nodes: list = []  # of registered states: (final, ((label, target), ...))

    def freeze(state: list) -> int:
        key = (state[0], tuple(state[1]))
        if key not in register:
            register[key] = len(nodes)
            nodes.append(key)
        return register[key]

    path: list = [[False, []]]
    last = b""
    for word in words:
        common = len(os.path.commonprefix((last, word)))
        while len(path) > common + 1:
            done = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        path += [[False, []] for _ in range(len(word) - common)]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        done = freeze(path.pop())
        path[-1][1].append((last[len(path) - 1], done))
    root = freeze(path[0])

    reach = [0] * len(nodes)  # words accepted from a state; targets come before their sources
    first, target, output = np.zeros(len(nodes), np.int32), [], []
    bits = np.zeros((len(nodes), 4), np.uint64)
    below = np.zeros((len(nodes), 4), np.int32)
    for s, (final, arcs) in enumerate(nodes):
        n, first[s] = int(final), len(target)
        quarter = [0, 0, 0, 0]
        for label, t in arcs:
            target.append(t)
            output.append(n)
            n += reach[t]
            bits[s, label >> 6] |= np.uint64(1 << (label & 63))
            quarter[label >> 6] += 1
        reach[s] = n
        below[s] = np.cumsum([0, *quarter[:3]])
    lengths = np.array([len(x) for x in ids], np.int32)
    arrays = [bits.ravel(), below.ravel(), first, np.array(target, np.int32), np.array(output, np.int32), np.array([f for f, _ in nodes], np.uint8), lengths, np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)]
    head = np.array([root, len(nodes), *(len(a) for a in arrays)], np.int64)
    blob = bytearray(head.tobytes())
    for a in arrays:
        blob += bytes(-len(blob) % 8) + a.tobytes()
    return bytes(blob)


class Lexicon:
    """A built lexicon, mapped into memory."""

    def __init__(self, blob: bytes):
        fd = os.memfd_create("lexicon") if hasattr(os, "memfd_create") else -1
        mapped = None
        if fd >= 0:
            os.ftruncate(fd, max(1, len(blob)))
        mapped = mmap.mmap(fd, max(1, len(blob)))
        if fd >= 0:
            os.close(fd)
        mapped[: len(blob)] = blob
        head = np.frombuffer(mapped, np.int64, 10)
        self.root, n = int(head[0]), head[2:]
        at, found = 80, []
        for k, kind in enumerate((np.uint64, np.int32, np.int32, np.int32, np.int32, np.uint8, np.int32, np.int32)):
            at += -at % 8
            found.append(np.frombuffer(mapped, kind, int(n[k]), at))
            at += found[-1].nbytes
        self.bits, self.below, self.first, self.target, self.output, self.final, self.lengths, self.ids = found
        self.starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        self._map = mapped

    def ranks(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The rank of each word, -1 if the lexicon lacks it.  All words take a step at a time."""
        out = np.full(len(starts), -1, np.int64)
        which, at, stop = np.arange(len(starts)), starts, ends
        state, total = np.full(len(starts), self.root, np.int64), np.zeros(len(starts), np.int64)
        while len(which):
            over = at == stop
            if over.any():
                good = over & (self.final[state] == 1)
                out[which[good]] = total[good]
                go = ~over
                which, at, stop, state, total = which[go], at[go], stop[go], state[go], total[go]
            label = data[at].astype(np.int64)
            cell = state * 4 + (label >> 6)
            word, place = self.bits[cell], (label & 63).astype(np.uint64)
            has = (word >> place) & np.uint64(1) == 1
            arc = self.first[state] + self.below[cell] + np.bitwise_count(word & ((np.uint64(1) << place) - np.uint64(1)))
            if not has.all():
                which, at, stop, total, arc = which[has], at[has], stop[has], total[has], arc[has]
            state, total, at = self.target[arc].astype(np.int64), total + self.output[arc], at + 1
        return out


def _gather(table: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges of a table, one after the other."""
    to = np.cumsum(lengths)
    return table[np.repeat(starts - (to - lengths), lengths) + np.arange(to[-1] if len(to) else 0)]


class Encoder:
    """Texts to ids: the lexicon for the words it holds, exact merges for the others."""

    CACHE = 200_000

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon, self.cache = vocabulary, lexicon, {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        tokens, lex = PreTokens(texts, self.vocabulary), self.lexicon
        rank = lex.ranks(tokens.data, tokens.starts, tokens.ends)
        rank[tokens.special >= 0] = -1
        size, raw = len(lex.lengths), tokens.data.tobytes()
        new: dict = {}
        unseen = np.flatnonzero(rank < 0)
        for k, s, e, i in zip(unseen.tolist(), tokens.starts[unseen].tolist(), tokens.ends[unseen].tolist(), tokens.special[unseen].tolist()):
            rank[k] = size + new.setdefault(i if i >= 0 else raw[s:e], len(new))
        missing = [w for w in new if not isinstance(w, int) and w not in self.cache]
        if len(self.cache) + len(missing) > self.CACHE:
            missing, self.cache = [w for w in new if not isinstance(w, int)], {}
        self.cache.update(zip(missing, self.vocabulary.merge(missing)))
        extra = [np.array([w], np.int32) if isinstance(w, int) else self.cache[w] for w in new]
        lengths = np.concatenate([lex.lengths, np.array([len(x) for x in extra], np.int32)])
        added = lengths[size:]
        starts = np.concatenate([lex.starts, len(lex.ids) + np.cumsum(added, dtype=np.int64) - added])
        table = np.concatenate([lex.ids, *extra])
        each = lengths[rank].astype(np.int64)
        ids = _gather(table, starts[rank], each)
        per_text = np.bincount(tokens.text, each, len(texts)).astype(np.int64) if len(rank) else np.zeros(len(texts), np.int64)
        return np.split(ids, np.cumsum(per_text)[:-1])


# --- on DataFrames ----------------------------------------------------------------------------


def _texts(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    data, offs = buffers(column)
    for a, b in pieces(offs, PIECE_BYTES):
        raw, at = data[offs[a] : offs[b]].tobytes(), (offs[a : b + 1] - offs[a]).tolist()
        yield a, b, [raw[s:e].decode("utf-8", "replace") for s, e in zip(at[:-1], at[1:])]


_KEPT: dict = {}


def _kept(key: str, make):
    """One of a kind in each Python worker, over all of its tasks."""
    if key not in _KEPT:
        _KEPT.clear() if len(_KEPT) > 8 else None
        _KEPT[key] = make()
    return _KEPT[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def count_words(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """word (bytes) and n, how often it occurs as a pre-token, over all texts."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def merge(parts: list[pa.Table]) -> pa.Table:
        merged = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])
        return merged.cast(pa.schema([("word", pa.binary()), ("n", pa.int64())]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _kept(f"v{hash(sent.value)}", lambda: Vocabulary(sent.value))
        for batch in batches:
            parts = []
            for _, _, texts in _texts(batch.column(0)):
                t = PreTokens(texts, vocab)
                offsets = np.append(t.starts, len(t.data)).astype(np.int32)
                words = pa.BinaryArray.from_buffers(pa.binary(), len(t.starts), [None, pa.py_buffer(offsets), pa.py_buffer(t.data)])
                found = pc.value_counts(words)
                parts.append(pa.table({"word": found.field(0), "n": found.field(1)}))
                if len(parts) == 16:
                    parts = [merge(parts)]
            if parts:
                yield from merge(parts).to_batches()
            parts.clear()
            pa.default_memory_pool().release_unused()

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = LEXICON_WORDS) -> list[bytes]:
    """The words that occur most, all of one count or none; at most `most`, which bounds what reaches the driver."""
    counts = written(counts.filter("n > 1"), "words")
    histogram = sorted(((r["n"], r["words"]) for r in counts.groupBy("n").agg(F.count("*").alias("words")).collect()), reverse=True)
    least, total = None, 0
    for n, words in histogram:
        total += words
        if total > most:
            break
        least = n
    return [] if least is None else sorted(bytes(r["word"]) for r in counts.filter(F.col("n") >= least).select("word").toLocalIterator())


def compile_lexicon(docs: DataFrame, vocabulary: str, text_col: str = "text", most: int = LEXICON_WORDS) -> bytes:
    words = frequent_words(count_words(docs, vocabulary, text_col), most)
    return build_lexicon(words, Vocabulary(vocabulary).merge(words))


def _decoded(vocabulary: Vocabulary, ids: list[np.ndarray]) -> list[str]:
    flat = np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int64)
    lengths = vocabulary.lengths[flat]
    raw = _gather(vocabulary.bytes, vocabulary.starts[flat], lengths).tobytes()
    ends = np.append(0, np.cumsum(lengths))[np.cumsum([0, *map(len, ids)])].tolist()
    return [raw[s:e].decode("utf-8", "replace") for s, e in zip(ends[:-1], ends[1:])]


def encode(docs: DataFrame, vocabulary: str, lexicon: bytes, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """id and ids (little-endian unsigned 32-bit integers, as binary) of every text.

    With `decoded` also the text that the ids decode to, made in the same pass.
    """
    sc = docs.sparkSession.sparkContext
    vocab_sent, lexicon_sent = sc.broadcast(vocabulary), sc.broadcast(lexicon)
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(f"e{hash(vocab_sent.value)}{hash(lexicon_sent.value)}", lambda: Encoder(Vocabulary(vocab_sent.value), Lexicon(lexicon_sent.value)))
        for batch in batches:
            for a, b, texts in _texts(batch.column(1)):
                ids = encoder.encode(texts)
                columns = [batch.column(0).slice(a, b - a), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
                if decoded:
                    columns.append(pa.array(_decoded(encoder.vocabulary, ids), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["__id", "ids", "decoded"][: len(columns)])

    schema = f"__id {source.schema['__id'].dataType.simpleString()}, ids binary" + ", decoded string" * decoded
    return source.mapInArrow(run, schema).withColumnRenamed("__id", id_col)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, ids and the decoded text; bytes that make no UTF-8 become U+FFFD.  Null ids decode to the empty text."""
    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    source = encoded.select(F.col(id_col).alias("__id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _kept(f"v{hash(sent.value)}", lambda: Vocabulary(sent.value))
        for batch in batches:
            data, offs = buffers(batch.column(1))
            for a, b in pieces(offs):
                ids = [np.frombuffer(data[s:e].tobytes(), "<u4") for s, e in zip(offs[a:b], offs[a + 1 : b + 1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(_decoded(vocab, ids), pa.string())], ["__id", "ids", "decoded"])

    return source.mapInArrow(run, f"__id {source.schema['__id'].dataType.simpleString()}, ids binary, decoded string").withColumnRenamed("__id", id_col)
