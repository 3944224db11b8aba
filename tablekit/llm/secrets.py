"""Secret scans: candidate tokens, and a random forest that removes the false ones; DataFrame functions only.

A text is split before each candidate: a run of 16 or more token characters with
a digit in it, or a value of 6 or more characters, quoted or not, that is assigned
to a word for a secret; the name is no part of it.  A
candidate's features are its length, the transitions between its characters, how
much of it dictionary words cover, the path it may be part of and the words next
to it.  The forest is trained from labelled findings, at most
`most_findings` of them, and compiled into one SQL expression, so that a
document is scanned within its own row and nothing is shuffled.

Without findings of one's own, those of `generated_findings` train it.  Edge
cases: null and empty texts have no candidates.  Repeated rows are scanned alike;
an empty table gives an empty result; ids may be null; further columns are
ignored.
"""

from __future__ import annotations

import random
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TREES, DEPTH, SEED = 20, 6, 11
THRESHOLD = 0.5
MOST_FINDINGS = 20_000
REDACTED = "[SECRET]"
_TOKEN = r"[A-Za-z0-9_+/~-]"
_NAMES = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)"
_ASSIGNED = rf"{_NAMES}[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?"
_VALUE = r"[^\s\"'<>&;,()]{6,}"
_RUN = rf"(?={_TOKEN}*[0-9]){_TOKEN}{{16,}}={{0,2}}"
_SPLIT = rf"(?<!{_TOKEN})(?={_RUN})|(?<![A-Za-z])(?={_ASSIGNED}{_VALUE})"
#: Words that tell what a token next to them, or made of them, is.
_SECRET_WORDS = r"(?i)token|secret|passw|pwd|api.?key|auth|bearer|credential|private.?key|access.?key"
_HARMLESS_WORDS = r"(?i)sha-?\d|sha\b|commit|md5|checksum|digest|integrity|revision|\brev\b|build|uuid|guid|etag|example|sample|dummy|order|phone|card|isbn|version|hash|trace|request.?id"
_PLACEHOLDER = r"(?i)x{4}|1234|abcd|example|changeme|dummy|sample|placeholder|your|test|0{6}"
_DICTIONARY = "access account admin and app application auth backup build cache client cloud code config connection content controller count create customer data database date default delete deploy dev document download email error event example export file filter first form format from function group handler header home host html image import index info input item java json key language last line link list local log login main manager map master message method model module name network new node number object order output page parser path payment phone process product profile project public query queue record release report request resource response result return root sample script search server service session setting source start state static status storage store string style system table tag task template test text thread time title token tree type update upload user utils value version view web window with word world xml your".split()

FEATURES = ("length", "digits", "kind_changes", "case_changes", "distinct", "hex", "digits_only", "coverage", "path", "secret_words", "harmless_words", "placeholder", "assigned")


def _features(c: Column, left: Column, right: Column) -> Column:
    """An array of doubles, in the order of FEATURES."""
    n = F.greatest(F.length(c), F.lit(1))
    without = lambda pattern, x=c: (F.length(x) - F.length(F.regexp_replace(x, pattern, ""))) / n
    changes = lambda pattern: (F.length(F.regexp_replace(c, pattern, "#")) - F.length(c)) / n
    flag = lambda x: x.cast("double")
    near = F.concat(F.right(left, F.lit(24)), F.lit(" "), F.left(right, F.lit(12)))
    values = [
        F.length(c),
        without("[0-9]"),
        changes("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"),
        changes("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        F.size(F.array_distinct(F.split(c, ""))) / n,
        flag(F.rlike(c, F.lit("^[0-9a-fA-F]+$"))),
        flag(F.rlike(c, F.lit("^[0-9_+=~/-]+$"))),
        without("(?i)" + "|".join(sorted(_DICTIONARY, key=len, reverse=True))),
        without("/") * 10 + flag(F.rlike(left, F.lit(r"(://|/|\.|@)[^\s\"']*$"))) + flag(F.rlike(right, F.lit(r"^(/|\.[a-z]|@)"))),
        flag(F.rlike(F.right(left, F.lit(24)), F.lit(_SECRET_WORDS))),
        flag(F.rlike(near, F.lit(_HARMLESS_WORDS))),
        flag(F.rlike(c, F.lit(_PLACEHOLDER))),
        flag(F.rlike(left, F.lit(r"[:=]\s*[\"']?$"))),
    ]
    return F.array(*[v.cast("double") for v in values])


def generated_findings(n: int = 4000, seed: int = 5) -> list[tuple[str, str, str, int]]:
    """(candidate, text before, text after, is a secret), made by rule: the same on every run."""
    rnd = random.Random(seed)
    pick = lambda chars, k: "".join(rnd.choice(chars) for _ in range(k))
    digits, hexes, lower = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
    alnum = lower + lower.upper() + digits
    words = lambda k: " ".join(pick(lower, rnd.randint(2, 8)) for _ in range(k))
    quote = lambda: rnd.choice(['"', "'", ""])
    secret = lambda: rnd.choice([pick(hexes, rnd.choice([32, 40, 64])), pick(alnum, rnd.randint(18, 48)), "AKIA" + pick(lower.upper() + digits, 16), "ghp_" + pick(alnum, 36), "sk-" + pick(alnum, 40), pick(alnum + "+/", 40)])
    name = lambda: rnd.choice(["token", "secret", "password", "api_key", "apikey", "auth_token", "access_key", "SECRET", "client_secret", "Bearer"])
    out = []
    for _ in range(n):
        before, after, kind = words(4), words(2), rnd.random()
        if kind < 0.06:
            q = quote()
            out.append((pick(lower, rnd.randint(3, 7)) + pick(alnum, rnd.randint(4, 8)) + pick(digits, 1), f"{before} {rnd.choice(['password', 'DB_PASSWORD', 'secret', 'pwd', 'passwd'])}{rnd.choice(['=', ' = ', ': '])}{q}", f"{q} {after}", 1))
        elif kind < 0.10:
            out.append((pick(lower, rnd.randint(6, 11)), f"{before} {name()}{rnd.choice([': ', ' = '])}", " " + after, 0))
        elif kind < 0.42:
            q = quote()
            out.append((secret(), f"{before} {name()}{rnd.choice([' = ', '=', ': ', ':'])}{q}", f"{q} {after}", 1))
        elif kind < 0.47:
            out.append((rnd.choice(["AKIA" + pick(lower.upper() + digits, 16), "ghp_" + pick(alnum, 36), "sk-" + pick(alnum, 40)]), before + " ", " " + after, 1))
        elif kind < 0.55:
            out.append((pick(hexes, rnd.choice([32, 40, 64])), f"{before} {rnd.choice(['commit ', 'sha256: ', 'md5=', 'checksum ', 'etag: ', 'revision '])}", " " + after, 0))
        elif kind < 0.63:
            out.append((pick(digits, rnd.choice([16, 16, 18, 20])), before + rnd.choice([" ", " order ", " card "]), " " + after, 0))
        elif kind < 0.71:
            out.append(("/".join([rnd.choice(_DICTIONARY) for _ in range(rnd.randint(2, 4))] + [pick(digits, 3)]), f"{before} https://www.{pick(lower, 5)}.com/", rnd.choice([".html", "/", " "]) + after, 0))
        elif kind < 0.79:
            out.append((rnd.choice("_-").join(rnd.choice(_DICTIONARY) for _ in range(rnd.randint(3, 5))) + "_" + pick(digits, 2), f"{before} {rnd.choice(['', 'token = ', 'key: '])}", " " + after, 0))
        elif kind < 0.87:
            out.append((rnd.choice(["your_token_here_1234", "xxxxxxxxxxxxxxxx1234", "changeme_example_123", "0000000000000000000", "example-token-123456", "test_secret_000000001"]), f'{before} {name()} = "', f'" {after}', 0))
        elif kind < 0.94:
            out.append((pick(lower, rnd.randint(8, 16)) + pick(digits, rnd.randint(1, 2)) + pick(lower, rnd.randint(2, 9)), before + " ", " " + after, 0))
        else:
            out.append(("-".join(pick(hexes, k) for k in (8, 4, 4, 4, 12)), f"{before} {rnd.choice(['uuid ', 'request id: ', 'trace '])}", " " + after, 0))
    return out


_COMPILED: dict = {}


def train(spark: SparkSession, findings: DataFrame | None = None, most_findings: int = MOST_FINDINGS) -> str:
    """A forest as SQL over an array f of features: the share of trees that vote for a secret.

    findings has candidate, left, right and label; of more than `most_findings`,
    those with the smallest hashes are taken.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    own = findings is None
    if own and spark.sparkContext.applicationId in _COMPILED:
        return _COMPILED[spark.sparkContext.applicationId]
    if own:
        findings = spark.createDataFrame(generated_findings(), "candidate string, left string, right string, label int")
    findings = findings.orderBy(F.xxhash64("candidate", "left", "right"), "label").limit(most_findings).coalesce(1)
    rows = findings.select(array_to_vector(_features(F.col("candidate"), F.col("left"), F.col("right"))).alias("features"), F.col("label").cast("double").alias("label"))
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(rows)
    trees = [_compiled(t.toDebugString) for t in model.trees]
    sql = "(" + " + ".join(trees) + f") / {len(trees)}.0D"
    if own:
        _COMPILED[spark.sparkContext.applicationId] = sql
    return sql


def _compiled(tree: str) -> str:
    """A tree's description as nested CASE expressions."""
    lines = iter([x.strip() for x in tree.splitlines() if re.match(r"\s*(If|Else|Predict)", x)])

    def node() -> str:
        line = next(lines)
        if line.startswith("Predict"):
            return line.split(":")[1].strip() + "D"
        m = re.match(r"If \(feature (\d+) <= ([-\d.E]+)\)", line)
        yes = node()
        next(lines)
        return f"CASE WHEN f[{m[1]}] <= {m[2]}D THEN {yes} ELSE {node()} END"

    return node()


def scan(docs: DataFrame, text_col: str = "text", forest: str | None = None, threshold: float = THRESHOLD, into: str = "findings") -> DataFrame:
    """docs with a column of findings: start and end (code points, end excluded), candidate, score and secret.

    The column replaces one of the same name.
    """
    forest = forest or train(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.withColumn("__pieces", F.split(text, _SPLIT))
    assigned = rf"^({_ASSIGNED})({_VALUE})"
    head = lambda p: F.regexp_extract(p, assigned, 1)
    value = lambda p: F.when(head(p) != "", F.regexp_extract(p, assigned, 2)).otherwise(F.regexp_extract(p, f"^{_RUN}", 0))
    ends = F.aggregate("__pieces", F.array(F.lit(0).cast("long")), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p))))
    found = found.withColumn("__ends", F.when(F.size("__pieces") > 1, ends).otherwise(F.array(F.lit(0).cast("long"))))
    cut = F.transform("__pieces", lambda p, i: F.struct(head(p).alias("h"), value(p).alias("c"), p.alias("p"), F.coalesce(F.get("__pieces", i - 1), F.lit("")).alias("b"), F.get("__ends", i).alias("at")))
    found = found.withColumn("__cut", F.filter(cut, lambda x: x["c"] != ""))
    shaped = F.transform("__cut", lambda x: F.struct((x["at"] + F.length(x["h"])).alias("start"), x["c"].alias("c"), _features(x["c"], F.concat(F.right(x["b"], F.lit(48)), x["h"]), F.substring(x["p"], F.length(x["h"]) + F.length(x["c"]) + 1, F.lit(24))).alias("f")))
    found = found.withColumn("__shaped", shaped).withColumn("__scores", F.expr(f"transform(transform(__shaped, x -> x.f), f -> {forest})"))
    scored = F.transform("__shaped", lambda x, i: F.struct(x["start"].alias("start"), (x["start"] + F.length(x["c"])).alias("end"), x["c"].alias("candidate"), F.get("__scores", i).alias("score"), (F.get("__scores", i) >= threshold).alias("secret")))
    return found.withColumn(into, scored).drop("__pieces", "__ends", "__cut", "__shaped", "__scores")


def redact(docs: DataFrame, text_col: str = "text", forest: str | None = None, threshold: float = THRESHOLD, mask: str = REDACTED) -> DataFrame:
    """docs with every secret in the text replaced by the mask."""
    found = scan(docs, text_col, forest, threshold, "__findings")
    secrets = F.reverse(F.filter("__findings", lambda x: x["secret"]))
    clean = F.aggregate(secrets, F.col(text_col), lambda acc, x: F.overlay(acc, F.lit(mask), (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int")))
    return found.withColumn(text_col, clean).drop("__findings")


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", forest: str | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each candidate: id, start, end, candidate, score and secret."""
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    rows = scan(source, "__text", forest, threshold).select("__id", F.inline("findings"))
    return rows.withColumnRenamed("__id", id_col)
