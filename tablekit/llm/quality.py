"""Quality rules: base rules, then a log-likelihood ratio of hashed n-grams; DataFrame functions only.

A document's words are runs of anything but ASCII white space.  The base rules
fail a document of too few words, or one in which words of repeated 8-word
windows make up too much.  Of the others, the verdict is that of two
multinomials over hash buckets of 1-grams and 2-grams, one counted over the
trusted documents and one over the whole corpus: the mean over a document's
n-grams of log(target / raw) is compared to a fixed threshold, so that every
document gets the same verdict on every run.  Ratios are rounded to 1 / `STEPS`,
so that their sums are exact in any order.

The raw multinomial is the prior of the target one (`prior` pseudo-counts a
bucket), so that n-grams too rare to tell anything have a ratio of one.  The
number of buckets grows in proportion to the corpus' characters, so that a
bucket holds about as many n-grams, and the prior weighs as much, at any size.

The ratios are packed into rows of `SHARD` buckets, two bytes a bucket, and
broadcast while they have at most `broadcast_bytes`; each document's n-grams then
meet them within its task.  Larger tables meet the n-grams by a shuffle, but for the
buckets of the most frequent n-grams, of which there are few at any size, so
that no key holds many rows.  Both ways give equal results.

Edge cases: null and empty texts and texts of white space have no words; their
score is 0 and they fail the base rules.  Repeated rows are judged alike and
all returned.  Without trusted documents, or of an empty table, the ratio is
one everywhere.  Ids may be null.  Further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import broadcast_if_small, text_digest, written

#: The least number of buckets, 2 MB when packed.
BUCKETS = 1 << 20
#: Characters of the corpus a bucket, beyond the least number of buckets: about forty distinct 2-grams.
BUCKET_CHARS = 400
PRIOR = 16.0
THRESHOLD = -0.25
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8  # as the doublings in base_rules make it
STEPS = 1024
SHARD = 4096
#: The packed ratios are broadcast up to this size.
RATIO_BYTES = 256 << 20
#: Of a larger table, buckets with at least this share of all n-grams are broadcast: at most its inverse of them.
FREQUENT = 1e-5

_BLANKS = " \t\n\x0b\f\r"
_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _spaced(text: Column) -> Column:
    """The text with every blank as a space."""
    return reduce(lambda t, blank: F.replace(t, F.lit(blank), F.lit(" ")), _BLANKS[1:], F.coalesce(text, F.lit("")))


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(_spaced(text), " "), "")


def _pairs(column: str, apart: int) -> Column:
    """Hashes of each element with the one `apart` places on; shorter by `apart`."""
    return F.transform(F.slice(column, apart + 1, F.greatest(F.size(column) - apart, F.lit(0))), lambda h, i: F.xxhash64(F.get(F.col(column), i), h))


def _grams(words: DataFrame, buckets: int, *keep: str) -> DataFrame:
    """keep, and the buckets of each of the __words (b1) and of it with the next one (b2, null for the last); a row of nulls without words."""
    bucket = lambda *of: F.pmod(F.xxhash64(*of), F.lit(buckets))
    pairs = F.arrays_zip(F.col("__words").alias("x"), F.slice("__words", 2, 1 << 30).alias("y"))
    paired = words.select(*keep, F.inline_outer(pairs))
    return paired.select(*keep, F.when(F.col("x").isNotNull(), bucket("x")).alias("b1"), F.when(F.col("y").isNotNull(), bucket("x", "y")).alias("b2"))


def _stacked(grams: DataFrame, *keep: str) -> DataFrame:
    """keep and bucket, a row for each n-gram."""
    return grams.select(*keep, F.inline(F.array(F.struct(F.col("b1").alias("bucket")), F.struct(F.col("b2").alias("bucket"))))).filter("bucket is not null")


def _repeated_words(keyed: Column, window: int) -> Column:
    """Of (hash, place) of the windows, sorted: how many words lie in windows that occur more than once.

    keyed must be a column and no expression, which each step of the lambda would evaluate anew.
    """
    again = F.filter(keyed, lambda x, j: (x["h"] == F.get(keyed, j - 1)["h"]) | (x["h"] == F.get(keyed, j + 1)["h"]))
    starts = F.array_sort(F.transform(again, lambda x: x["i"]))
    start = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(starts, start, lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(window), i - acc["last"])).alias("n")), lambda acc: acc["n"])


def base_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__id, __words and the counts of the base rules; a window is eight words.

    Each array is a column of its own before a lambda looks into it: an
    expression in its place would be evaluated for each element.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(F.col(id_col).alias("__id"), text.alias("__text")).withColumn("__parts", F.split(_spaced(F.col("__text")), " "))
    split = split.withColumn("__words", F.array_remove("__parts", "")).withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != ""))
    counted = split.select(
        "__id",
        "__words",
        F.when(F.size("__words") > WINDOW, F.transform("__words", lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")).alias("__h1"),
        F.size("__words").cast("long").alias("n_words"),
        (F.length("__text") - F.size("__parts") + 1).cast("long").alias("word_chars"),  # all but the blanks between parts
        F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
    )
    # a window that occurs again makes half a window, at each of its places there, occur again
    halves = F.size("__h4") - F.size(F.array_distinct("__h4")) > WINDOW // 2
    counted = counted.withColumn("__h2", _pairs("__h1", 1)).withColumn("__h4", _pairs("__h2", 2)).withColumn("__windows", F.when(halves, _pairs("__h4", 4)).otherwise(F.array().cast("array<bigint>")))
    keyed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    again = F.size(F.array_distinct("__windows")) < F.size("__windows")
    kept = counted.select("__id", "__words", *_BASE[:4], F.when(again, keyed).alias("__keyed"))
    repeated = F.when(F.col("__keyed").isNull(), F.lit(0)).otherwise(_repeated_words(F.col("__keyed"), WINDOW))
    return kept.select("__id", "__words", *_BASE[:4], repeated.cast("long").alias("n_repeat_words"))


def bucket_count(docs: DataFrame, text_col: str = "text", chars: int = BUCKET_CHARS, least: int = BUCKETS) -> int:
    """One bucket for every `chars` characters of the corpus, `least` at least."""
    total = docs.agg(F.sum(F.length(text_col)).alias("n")).first()["n"] or 0
    return max(least, -(-total // chars))


def ratio_table(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS, prior: float = PRIOR) -> DataFrame:
    """bucket, raw (its n-grams in the corpus) and ratio (log ratio in units of 1 / STEPS) of every bucket that occurs, counted over every document.

    trusted has the ids of the trusted documents; its size decides only how it is joined.
    """
    ids = trusted.select(F.col(id_col).alias("__id"), F.lit(1).alias("__trusted")).distinct()
    marked = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(broadcast_if_small(ids, 64), "__id", "left")
    grams = _stacked(_grams(marked.select("__trusted", words_of(F.col("__text")).alias("__words")), buckets, "__trusted"), "__trusted")
    both = written(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("__trusted").alias("target")), "grams")
    sums = both.agg(F.sum("raw").alias("r"), F.sum("target").alias("t")).first()
    scale = sums["r"] / sums["t"] if sums["t"] else 0.0
    ratio = F.log((F.col("target") * scale + prior) / (F.col("raw") + prior)) if scale else F.lit(0.0)
    most = (1 << 15) - 1
    return both.select("bucket", "raw", F.greatest(F.lit(-most), F.least(F.lit(most), F.round(ratio * STEPS))).cast("short").alias("ratio"))


def _packed(ratios: DataFrame, buckets: int) -> DataFrame:
    """shard and the ratios of its SHARD buckets, 0 where a bucket doesn't occur."""
    every = ratios.sparkSession.range(buckets).select(F.col("id").alias("bucket")).join(ratios, "bucket", "left")
    rows = F.array_sort(F.collect_list(F.struct((F.col("bucket") % SHARD).cast("int").alias("at"), F.coalesce("ratio", F.lit(0).cast("short")).alias("ratio"))))
    return every.groupBy((F.col("bucket") / SHARD).cast("int").alias("shard")).agg(F.transform(rows, lambda x: x["ratio"]).alias("ratios"))


def _sums_by_broadcast(counted: DataFrame, ratios: DataFrame, buckets: int) -> DataFrame:
    """__id, the base counts, __sum, the ratios' sum, and __n, the number of n-grams, of every row of base_rules."""
    packed = F.broadcast(written(_packed(ratios, buckets), "ratios"))
    grams = _grams(counted.withColumn("__row", F.monotonically_increasing_id()), buckets, "__row", "__id", *_BASE)
    value = F.lit(0).cast("long")
    for b in ("b1", "b2"):
        grams = grams.withColumn("__shard", (F.col(b) / SHARD).cast("int")).join(packed.select(F.col("shard").alias("__shard"), F.col("ratios").alias(f"__{b}")), "__shard", "left").drop("__shard")
        value = value + F.coalesce(F.get(F.col(f"__{b}"), (F.col(b) % SHARD).cast("int")), F.lit(0))
    summed = grams.groupBy("__row", "__id").agg(*(F.max(c).alias(c) for c in _BASE), F.sum(value).alias("__sum"))
    return summed.select("__id", *_BASE, "__sum", (2 * F.col("n_words") - 1).alias("__n"))


def _sums_by_shuffle(docs: DataFrame, ratios: DataFrame, buckets: int, frequent: float) -> DataFrame:
    """The same, of id and text as __id and __text; sums and __n, the n-grams summed, are those of a text and all its copies."""
    own = docs.select("__id", "__text", text_digest(F.coalesce("__text", F.lit(""))).alias("__digest"))
    counted = base_rules(own.select(F.struct("__id", "__digest").alias("__own"), "__text"), "__own", "__text").select("__id.__id", "__id.__digest", *_BASE)
    total = ratios.agg(F.sum("raw").alias("n")).first()["n"] or 0
    often = F.col("raw") >= max(1, frequent * total)
    head = F.broadcast(ratios.filter(often).select("bucket", F.col("ratio").alias("__often")))
    words = own.select("__digest", words_of(F.col("__text")).alias("__words"))
    met = _stacked(_grams(words, buckets, "__digest"), "__digest").join(head, "bucket", "left")
    near = met.filter("__often is not null").select("__digest", F.col("__often").alias("value"))
    far = met.filter("__often is null").join(ratios.filter(~often).hint("merge"), "bucket", "left").select("__digest", F.coalesce("ratio", F.lit(0).cast("short")).alias("value"))
    sums = near.unionByName(far).groupBy("__digest").agg(F.sum("value").alias("__sum"), F.count("*").alias("__n"))
    return counted.join(sums, "__digest", "left").select("__id", *_BASE, "__sum", "__n")


def score(docs: DataFrame, ratios: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, buckets: int = BUCKETS, broadcast_bytes: int = RATIO_BYTES, frequent: float = FREQUENT) -> DataFrame:
    """id, the base counts, base_failed, kept and score of every row, under a table of ratios over `buckets` buckets."""
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    if 2 * buckets <= broadcast_bytes:
        summed = _sums_by_broadcast(base_rules(source, "__id", "__text"), ratios, buckets)
    else:
        summed = _sums_by_shuffle(source, ratios, buckets, frequent)
    scored = summed.withColumn("score", F.coalesce(F.col("__sum") / (STEPS * F.nullif("__n", F.lit(-1))), F.lit(0.0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return scored.select(F.col("__id").alias(id_col), *_BASE, failed.alias("base_failed"), (~failed & (F.col("score") >= threshold)).alias("kept"), "score")


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The scores of all documents under the ratios of these same documents."""
    buckets = bucket_count(docs, text_col)
    return score(docs, ratio_table(docs, trusted, id_col, text_col, buckets, prior), id_col, text_col, threshold, buckets, **options)


def keep(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of docs that are kept, whole, with all their columns.

    A verdict is that of a text, so that rows are told apart by their texts'
    digests; those rejected are broadcast only if they are counted to be few.
    """
    buckets = bucket_count(docs, text_col)
    ratios = ratio_table(docs, trusted, id_col, text_col, buckets, prior)
    judged = score(docs.select(text_digest(F.col(text_col)).alias("__own"), F.col(text_col).alias("__text")), ratios, "__own", "__text", threshold, buckets, **options)
    rejected = written(judged.filter("not kept and __own is not null").select(F.col("__own").alias("__rejected")).distinct(), "rejected")
    marked = docs.filter(F.col(text_col).isNotNull()).withColumn("__own", text_digest(F.col(text_col)))
    return marked.join(broadcast_if_small(rejected, 96), F.col("__own") == F.col("__rejected"), "left_anti").drop("__own")
