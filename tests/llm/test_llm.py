import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablekit.llm import bpe, decontaminate, html_extract, near_dup, quality, secrets, substring_dup, toxicity, url_filter, warc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EDGE = [(1, None), (2, ""), (3, " \n\t"), (None, "one two"), (4, "x" * 200_000), (5, "word " * 3000), (5, "word " * 3000), (6, "A longer text, with 15 words or so, that stands for all of the others here.")]
NAMES = "bucket string, score string, kept string, ids string, findings string, digest string"


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash with the operators'."""
    df = spark.createDataFrame(EDGE, "doc_id long, text string")
    for c in ("score", "kept", "ids", "findings", "digest", "bucket", "host", "path", "start", "id", "d"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def words(text):
    return WORD.findall(text.lower())


def rand_words(n, seed):
    rng = np.random.default_rng(seed)
    return ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(3, 9))) for _ in range(n)]


def test_url_filter(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de"), ("allow", "example.com", "/de/x"), ("allow", "a.b", "/"), ("block", "a.b", "/")]
    urls = [None, "nothing", "http://X.Example.NET/en/1?q", "https://example.net", "http://example.net/fr", "ftp://example.com/deutsch", "http://example.com/de/xyz", "http://a.b/", "http://notexample.com/de/", "http://a.b/", "://"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("clash"))
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(df, rules).collect()}
    assert got == {0: (None, "allow"), 1: (None, "allow"), 2: ("example.net/en/", "allow"), 3: (None, "allow"), 4: ("net/", "block"), 5: ("example.com/de", "block"), 6: ("example.com/de/x", "allow"), 7: ("a.b/", "block"), 8: (None, "allow"), 9: ("a.b/", "block"), 10: (None, "allow")}
    assert got == {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(df, rules, broadcast_rules=0).collect()}
    assert url_filter.judge(df.limit(0), rules).count() == 0


def test_quality(spark, edge):
    rows = [(11, "a b c d e f g h i j k l m n o p q r s t u"), (12, "one two three four five six seven eight " * 4), (13, "l1 x\nl1 x\n\n \nl2 #$"), *EDGE[:3]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in quality.base_rules(df).collect():
        text = dict(rows)[r["__id"]] or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
        grams = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        inside = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))
    clean = [(i, " ".join(rand_words(60, i % 7))) for i in range(60)]
    junk = [(100 + i, " ".join(x + "%%%" for x in rand_words(60, 50 + i % 2))) for i in range(80)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id long")
    got = {r["doc_id"]: r["kept"] for r in quality.judge(df, trusted).collect()}
    assert all(got[i] for i, _ in clean) and not any(got[i] for i, _ in junk)
    assert {r["doc_id"] for r in quality.keep(df, trusted).collect()} == {i for i, _ in clean}
    assert quality.judge(edge, trusted).count() == len(EDGE) and quality.judge(edge.limit(0), trusted).count() == 0


def test_decontaminate(spark, edge):
    base = rand_words(400, 1)
    items = [("a", " ".join(base[:30])), ("b", " ".join(base[100:104])), ("a", " ".join(base[:30])), (None, " ".join(base[200:215])), ("e", ""), ("n", None), ("b10", " ".join(base[20:40]))]
    docs = [(11, " ".join(base)), (12, " ".join(rand_words(300, 2) + base[5:14])), (13, " ".join(rand_words(30, 3) + base[5:15])), (14, "X. " + ", ".join(base[100:104]).upper()), *[(i, t) for i, t in EDGE[:3]]]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    expected = {}
    for i, t in docs:
        w, hit, ids = words(t or ""), set(), set()
        for item, text in items:
            v = words(text or "")
            n = min(10, len(v))
            for k in range(len(v) - n + 1 if v else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[k : k + n]:
                        hit |= set(range(p, p + n))
                        ids |= {item} - {None}
        expected[i] = (len(w), len(hit), sorted(ids))
    for limit in (1 << 20, 0):
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in decontaminate.decontaminate(d, b, broadcast_bytes=limit).collect()}
        assert got == expected
    assert decontaminate.decontaminate(edge, b).count() == len(EDGE) and decontaminate.decontaminate(edge, b.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.keep(edge, b).columns == edge.columns


def test_benchmark_index_is_packed():
    import pickle

    items = [(str(i), " ".join(rand_words(200, i))) for i in range(200)]
    size = sum(len(t) for _, t in items)
    index = decontaminate.Benchmark(items)
    assert len(pickle.dumps(index, protocol=5)) < 12 * size
    text = " ".join(items[7][1].split()[20:33])
    (n, hit, ids, spans), = index.hits(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    assert (n, hit, ids, spans) == (13, 13, ["7"], [(0, 13)])


def test_pipeline_against_brute_force(spark, tmp_path):
    """All stages on a small corpus; what is kept is told by plain Python."""
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    import corpus_pipeline

    clean = {i: " ".join(rand_words(60, i)) for i in range(40)}
    key = hashlib.sha1(b"k").hexdigest()
    item = rand_words(30, 900)
    texts = dict(clean) | {
        50: clean[3],  # an exact copy
        51: clean[4] + " more",  # a near copy
        **{100 + i: " ".join(x + "%%%" for x in rand_words(60, 50 + i % 2)) for i in range(80)},  # nothing trusted is like that
        54: "too few words",
        55: " ".join(rand_words(8, 60) * 6),  # repeated windows
        56: " ".join(rand_words(40, 61) + item[5:20]),  # a benchmark passage
        57: " ".join(rand_words(40, 62)) + f' token = "{key}"',
        58: None, 59: "",
    }
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words string"
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "clash") for i, t in texts.items()], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(56, 1, 0), (57, 1, 0), (51, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    ratios = quality.judge(spark.read.parquet(str(tmp_path / "documents.parquet")), spark.createDataFrame([(i,) for i in [*range(40), 51, 56, 57]], "doc_id long"))
    good = {r["doc_id"] for r in ratios.collect() if r["kept"]}
    assert good == {*range(40), 50, 51, 56, 57}  # as test_quality_score_against_brute_force holds the scores
    wanted = {i: t.replace(key, secrets.REDACTED) for i, t in texts.items() if i in good - {50, 51, 56}}
    tokenizer = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    digest = lambda x: hashlib.sha256(x).hexdigest()
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in wanted.items()}
    expected = sorted((i, len(x), digest(np.array(x, "<u4").tobytes()), digest(tokenizer.decode(x, skip_special_tokens=False).encode())) for i, x in ids.items())
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == expected
    for name in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(str(tmp_path / f"{name}.parquet"))
        df.limit(0).write.parquet(str(tmp_path / "none" / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "bpe"]


def test_queries_have_their_columns(spark):
    """The registered queries over a table of the driver's, by columns and types; and over empty tables."""
    from tablekit.llm import queries

    kinds = {
        "op2_decontaminate": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
        "op4_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
        "op5_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
        "op6_html_extract": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
        "op7_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
        "op8_quality": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
        "op9_substring_dup": {"doc_id": "bigint", "class_id": "bigint", "n_repeated": "bigint"},
        "op10_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    }
    import pathlib

    sf = pathlib.Path("/root/testdata/sf0.001")
    if not sf.exists():
        pytest.skip("no test data")
    for name, columns in kinds.items():
        if name == "op5_bpe":
            pytest.importorskip("public_tokenizers")
        found = dict(queries.queries()[name](spark, str(sf)).dtypes)
        assert {c: found.get(c) for c in columns} == columns, name


def test_bpe(spark, edge):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    t, text = Tokenizer.from_file(path), bpe.read_vocabulary(path)
    texts = [x or "" for _, x in EDGE] + ["it's I'LL we'll  two\n\n x<|endoftext|>y", "漢字 ½ é😀\x85", "''s 're", "aaaa " * 50]
    lexicon = bpe.build_lexicon(sorted({b"word", b" word", b" longer", b"it"}), bpe.Vocabulary(text).merge(sorted({b"word", b" word", b" longer", b"it"})))
    for blob in (lexicon, bpe.build_lexicon([], [])):
        got = bpe.Encoder(bpe.Vocabulary(text), bpe.Lexicon(blob)).encode(texts)
        assert [x.tolist() for x in got] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    encoded = bpe.encode(edge, text, bpe.compile_lexicon(edge, text))
    assert sorted(len(r["ids"]) for r in encoded.collect()) == sorted(4 * len(t.encode(x or "", add_special_tokens=False).ids) for _, x in EDGE)
    assert sorted(r["decoded"] for r in bpe.decode(encoded, text).collect()) == sorted(x or "" for _, x in EDGE)
    assert bpe.encode(edge.limit(0), text, lexicon).count() == 0


def test_html(spark):
    page = "<html><head><title>T</title><script>if(a<b){}</script></head><body><nav><a href=x>Home</a></nav><div class='cookie-notice'>We use cookies</div><article><h1>A &amp; B</h1><p>One<b>two</b> three.<br>Four<ul><li>Item five is here.</li></ul></article><aside>Related</aside><section class=comments><p>I agree.</p></section><footer>&copy; me</footer>"
    weights = html_extract.train()
    assert html_extract.main_text(page, weights) == "A & B Onetwo three. Four Item five is here."
    wrong = total = 0
    for p, marks in html_extract._labelled_pages(60, 1234):
        found = html_extract.blocks(p)
        if len(found) == len(marks):
            wrong, total = wrong + sum(a != b for a, b in zip(html_extract.label(found, weights), marks)), total + len(marks)
    assert wrong < 0.03 * total
    df = spark.createDataFrame([(1, None, None), (2, "u", ""), (2, "u", page), (None, "u", "<article><p>cut &am"), (3, "u", "<" * 5000)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_extract.extract(df).collect()
    assert len(got) == 5 and got[0]["text"] == "" and got[3]["text"] == "cut &am"


@pytest.mark.parametrize("page,wanted", [
    ("<div><a href=a>Home</a> <a href=b>News</a></div><div><h1>The title here</h1><p>{0}</p><p>{1}</p></div>", "The title here {0} {1}"),
    ("<table><tr><td><a href=a>Home</a></td><td><h1>The title here</h1><p>{0}</p><p>{1}</p></td></tr></table>", "The title here {0} {1}"),
    ("<div class=content><p>{0}</p></div><div class=commentlist><p>{1}</p></div>", "{0}"),
    ("<article><header><h1>Real Title</h1></header><p>{0}</p></article>", "Real Title {0}"),
    ("<article><h1>Head</h1><p>{0}</p></article><article class=comment><p>{1}</p></article>", "Head {0}"),
    ("<article><h1>Head</h1><p>{0}</p></article><ol class=commentlist><li><article><p>{1}</p></article></li></ol>", "Head {0}"),
    ("<div><p>{0}</p></div><div class=commentlist><p>{1}</p></div>", "{0}"),
    ("<article><h1>Head</h1><p>{0}</p><div class=related><a href=a>One more</a> <a href=b>Two</a></div><p>{1}</p></article>", "Head {0} {1}"),
])
def test_html_layouts(page, wanted):
    texts = [" ".join(rand_words(40, k)) + "." for k in (1, 2)]
    assert html_extract.main_text("<html><body>" + page.format(*texts) + "<footer>By me</footer></body></html>", html_extract.train()) == wanted.format(*texts)


def test_minimum_cut_is_least():
    rng = np.random.default_rng(0)
    for _ in range(30):
        n = 6
        costs = [tuple(map(float, rng.integers(0, 9, 2))) for _ in range(n)]
        edges = [(i, j, float(rng.integers(0, 5))) for i in range(n) for j in range(i)]
        of = lambda side: sum(c[0] if not s else c[1] for c, s in zip(costs, side)) + sum(w for i, j, w in edges if side[i] != side[j])  # noqa: E731, B023
        assert of(html_extract.minimum_cut(costs, edges)) == min(of([m >> i & 1 == 1 for i in range(n)]) for m in range(1 << n))


def test_warc(spark):
    rows = [(1, "http://a/é", "same"), (2, "http://b", "same"), (2, "http://b", "same"), (None, None, None), (3, "u", "x\r\n\r\ny" * 2000), (4, "u", "é")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    index, path = warc.archive(df)
    got = sorted((r["page"] or "", r["type"], r["payload_bytes"], r["digest"], r["refers_to"] or "") for r in warc.read(index, path).collect())
    d = lambda x: warc.base32_sha1(x.encode())
    assert got == sorted([("1", "revisit", 4, d("same"), "2"), ("2", "response", 4, d("same"), ""), ("2", "revisit", 4, d("same"), "2"), ("", "response", 0, d(""), ""), ("3", "response", 12000, d("x\r\n\r\ny" * 2000), ""), ("4", "response", 2, d("é"), "")])
    assert list(warc.ranges([(0, 10), (10, 5), (100_000, 5)])) == [(0, 15, [0, 1]), (100_000, 100_005, [2])]
    assert warc.read(index.filter("page = '3'"), path).count() == 1
    named = spark.createDataFrame([("", "u", "x"), (None, "v", "y"), ("a:b>", "u", "x"), ("a:b>", "u", "x"), ("c", "w", "")], "page_id string, url string, html string")
    index, path = warc.archive(named)
    back = sorted((str(r["page"]), r["type"], str(r["refers_to"])) for r in warc.read(index, path).collect())
    assert back == [("", "revisit", "a:b>"), ("None", "response", "None"), ("a:b>", "response", "None"), ("a:b>", "revisit", "a:b>"), ("c", "response", "None")]
    assert len({warc.record_id("p", "u", "D", k) for k in range(3)} | {warc.record_id(None, "u", "D"), warc.record_id("", "u", "D")}) == 5
    empty, path = warc.archive(df.limit(0))
    assert warc.read(empty, path).count() == 0


def test_near_duplicates(spark, edge):
    base = [rand_words(200, s) for s in range(6)]
    rows = [(s, " ".join(w)) for s, w in enumerate(base)]
    rows += [(10 + s, " ".join(w[:100] + ["changed"] + w[101:])) for s, w in enumerate(base[:3])]
    rows += [(20, rows[0][1]), (21, rows[0][1]), (30, " ".join(base[0][:100] + rand_words(100, 77)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(df).collect()}
    assert got == {0: 0, 10: 0, 20: 0, 21: 0, 1: 1, 11: 1, 2: 2, 12: 2, 3: 3, 4: 4, 5: 5, 30: 30}
    assert sorted(r["doc_id"] for r in near_dup.deduplicate(df).collect()) == [0, 1, 2, 3, 4, 5, 30]
    found = near_dup.near_duplicates(edge).collect()
    assert len(found) == len(EDGE) and near_dup.deduplicate(edge).count() == len(EDGE) - 1
    assert near_dup.near_duplicates(edge.limit(0)).count() == 0


def test_near_duplicates_are_the_components_of_all_links(spark):
    from tablekit.llm.common import buffers

    base, rng = rand_words(150, 5), np.random.default_rng(3)
    texts = []
    for i in range(120):
        words = list(base)
        for at in rng.choice(150, rng.integers(1, 7), replace=False):
            words[at] = f"w{i}x{at}"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(df).collect()}
    s = near_dup.Shingled(*buffers(pa.array(texts)), near_dup.frequencies(df))
    bags = [dict(zip(s.values[a:b].tolist(), s.weights[a:b].tolist())) for a, b in zip(s.first[:-1], s.first[1:])]
    want = list(range(len(texts)))
    links = 0
    for i, x in enumerate(bags):
        for j in range(i):
            y = bags[j]
            shared = sum(min(w, y[v]) for v, w in x.items() if v in y)
            if shared / (sum(x.values()) + sum(y.values()) - shared) >= near_dup.SIMILARITY:
                links += 1
                a, b = sorted((want[i], want[j]))
                want = [a if r == b else r for r in want]
    assert links > 100 and len(set(want)) > 5
    assert got == dict(enumerate(want))


def test_samples_agree_as_similarity():
    a, b = rand_words(600, 1), rand_words(600, 1)
    b[300:330] = rand_words(30, 9)
    text = pa.array([" ".join(a), " ".join(b)], pa.large_string())
    from tablekit.llm.common import buffers

    idf = np.ones((near_dup.SKETCH_ROWS, 1 << 14), np.float32)
    s = near_dup.Shingled(*buffers(text), idf)
    drawn = near_dup.samples(s, 400)
    x, y = (set(s.values[s.first[i] : s.first[i + 1]].tolist()) for i in (0, 1))
    assert abs((drawn[0] == drawn[1]).mean() - len(x & y) / len(x | y)) < 0.06


def test_passages(spark, edge):
    passage = rand_words(60, 5)
    rows = [(i, " ".join(rand_words(120, 100 + i) + passage + rand_words(90, 200 + i))) for i in range(5)]
    rows += [(9, " ".join(rand_words(300, 999))), (7, rows[0][1])]
    got = substring_dup.duplicate_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == {0, 1, 2, 3, 4, 7}
    assert all([tuple(x) for x in r["spans"]] == [(120, 180)] and r["n_repeated"] == 60 for r in got if r["doc_id"] in (1, 2, 3, 4))
    assert all(r["class_id"] == 0 and r["partner_id"] != r["doc_id"] for r in got) and len(got) == 6
    assert all([tuple(x) for x in r["spans"]] == [(0, 270)] for r in got if r["doc_id"] in (0, 7))
    assert substring_dup.duplicate_passages(edge.limit(0)).count() == 0
    again = substring_dup.duplicate_passages(edge).collect()
    assert [(r["doc_id"], r["class_id"], r["n_repeated"]) for r in again] == [(5, 5, 3000)] * 2
    values = np.random.default_rng(3).integers(0, 1 << 60, 40).astype(np.uint64)
    windows = substring_dup.compact_windows(values, 7)
    for x in range(40):
        for y in range(x + 6, 40):
            assert sum(l <= x <= c <= y <= r for l, c, r in windows) == 1


def test_secrets(spark, edge):
    key = hashlib.sha1(b"x").hexdigest()
    rows = [(11, f'La rivera token = "{key}" and more'), (12, f"commit {key} fixed"), (13, "card 4785380592391139 was"), (14, 'password: "hunter-two-b"'), *EDGE]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["candidate"]): r for r in secrets.findings(df).collect()}
    assert got[11, key]["secret"] and rows[0][1][got[11, key]["start"] : got[11, key]["end"]] == key
    assert not got[12, key]["secret"] and not got[13, "4785380592391139"]["secret"] and (14, "hunter-two-b") in got
    named = spark.createDataFrame([(1, f"export api_key={key}"), (2, f"http://h/p?token={key}&x=1"), (3, "DB_PASSWORD=hunter2sekret"), (4, f"x={key}=="), (5, "the token: something else")], "doc_id long, text string")
    found = {r["doc_id"]: (r["start"], r["candidate"], r["secret"]) for r in secrets.findings(named).collect()}
    assert found[1] == (15, key, True) and found[2] == (17, key, True) and found[3] == (12, "hunter2sekret", True) and found[4][:2] == (2, key + "==") and not found[5][2]
    assert secrets.redact(named).filter("doc_id = 2").first()["text"] == "http://h/p?token=[SECRET]&x=1"
    assert secrets.redact(df).filter("doc_id = 11").first()["text"] == 'La rivera token = "[SECRET]" and more'
    assert secrets.redact(edge).select(edge.columns).exceptAll(edge).count() == 0 and secrets.findings(edge.limit(0)).count() == 0
    held = secrets.generated_findings(300, 77)
    found = spark.createDataFrame([(i, left + c + right) for i, (c, left, right, _) in enumerate(held)], "doc_id long, text string")
    hits = {r["doc_id"] for r in secrets.findings(found).filter("secret").select("doc_id").distinct().collect()}
    assert sum((i in hits) == bool(y) for i, (*_, y) in enumerate(held)) >= 0.93 * len(held)


def test_toxicity(spark, edge):
    rng = np.random.default_rng(1)
    vocabulary = rand_words(300, 8)
    bad = ["zzkrox", "qquvex", "xxblorp"]
    rows, labels = [], []
    for i in range(400):
        w = [vocabulary[k] for k in rng.integers(0, 300, 60)]
        if i % 5 == 0:
            w[int(rng.integers(0, 60))] = bad[i // 5 % 3]
            w[int(rng.integers(0, 60))] = bad[i // 5 % 2]
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 5 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(docs, marks).filter("held_out").collect()
    assert all(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in got) and len(got) > 50
    found = toxicity.score(edge, marks).collect()
    assert len(found) == len(EDGE) and all(r["score"] == 0.0 for r in found)  # no labelled text is toxic here
    assert toxicity.score(edge.limit(0), marks).count() == 0


def test_exact_passages_within_dissimilar_texts(spark):
    """Stretches that differ every few words hide no exact repeat: held against brute force over runs of 50 words."""
    rows = []
    for i in range(12):
        shared, noisy = rand_words(55 + i, 700 + i), rand_words(150, 800 + i)
        changed = [w if k % 9 else f"x{i}q{k}" for k, w in enumerate(noisy)]
        rows += [(2 * i, " ".join(noisy + shared)), (2 * i + 1, " ".join(changed + shared))]
    rows += [(90, " ".join(rand_words(200, 990))), (91, None), (92, "")]
    grams = {d: {tuple(t.split()[k : k + 50]) for k in range(len(t.split()) - 49)} for d, t in rows if t}
    wanted = {a for a in grams if any(grams[a] & grams[b] for b in grams if a != b)}
    got = substring_dup.duplicate_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in got.collect()} == wanted


def test_passages_of_many_groups_behind_one_frequent_text(spark):
    """A text of less than 50 words that all have gives one key to many groups, each of which has its own longer passage."""
    rows = []
    for g in range(64):
        shared = rand_words(46, 40 + g % 8) + rand_words(4, 5000 + g)
        rows += [(10 * g + i, " ".join(rand_words(40, 6000 + 10 * g + i) + shared + rand_words(40, 7000 + 10 * g + i))) for i in range(2)]
    got = substring_dup.duplicate_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {d for d, _ in rows} == {r["doc_id"] for r in got if [tuple(x) for x in r["spans"]] == [(40, 90)]}


def shingle_sets(text):
    w = text.split()
    return [tuple(w[k : k + 5]) for k in range(len(w) - 4)]


def links_by_brute_force(texts):
    """Pairs of texts that verification links, every text met with every other, by its own definition's slow form."""
    tokens = [shingle_sets(t) for t in texts]
    number = {g: int(v) for g, v in zip(sorted({g for t in tokens for g in t}), np.random.default_rng(1).integers(1, 1 << 62, 10**6))}
    arrays = [np.array([number[g] for g in t], np.uint64) for t in tokens]
    sides = [substring_dup.Side(x, 46) for x in arrays]
    return {(i, j) for i in range(len(texts)) for j in range(i) if any(substring_dup.passages(arrays[i], sides[j], 50, 0.8))}


def components_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in links:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("small", [64, 8])
def test_passages_of_a_group_of_changed_copies(spark, small):
    """80 changed copies of one passage, each linked with some of the others; small=8 takes the way of large keys, which may miss near passages."""
    passage = rand_words(150, 1)
    texts = []
    for i in range(80):
        rng, copy = np.random.default_rng(1000 + i), list(passage)
        for k in rng.choice(150, rng.integers(2, 14), replace=False):
            copy[k] = f"c{i}x{k}"
        texts.append(" ".join(rand_words(40, 2000 + i) + copy + rand_words(40, 3000 + i)))
    wanted = components_of(80, links_by_brute_force(texts))
    linked = {i for i in range(80) if wanted.count(wanted[i]) > 1}
    got = {r["doc_id"]: r["class_id"] for r in substring_dup.duplicate_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), small=small).collect()}
    assert got.items() <= {i: wanted[i] for i in linked}.items() and len(linked) > 60
    assert len(got) >= len(linked) - (0 if small == 64 else 3)  # what large keys may miss, as the operator says


def test_near_passages_of_large_keys_are_whole(spark):
    """Changed copies behind a line that all have, each like a few others only: large keys give the classes of all pairs, by brute force."""
    line, passage, texts = rand_words(20, 3), rand_words(150, 1), []
    for i in range(80):
        rng, copy = np.random.default_rng(1000 + i), list(passage)
        for k in rng.choice(150, rng.integers(2, 14), replace=False):
            copy[k] = f"c{i}x{k}"
        texts.append(" ".join(rand_words(40, 2000 + i) + copy + rand_words(40, 3000 + i) + line))
    for i in range(30):  # the same line, and nothing else
        texts.append(" ".join(rand_words(60, 4000 + i) + line + rand_words(60, 5000 + i)))
    wanted = components_of(len(texts), links_by_brute_force(texts))
    got = {r["doc_id"]: r["class_id"] for r in substring_dup.duplicate_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), small=2).collect()}
    assert got == {i: c for i, c in enumerate(wanted) if wanted.count(c) > 1} and 60 < len(got) <= 80


def test_exact_passages_of_large_groups(spark):
    """Of any group the exact passages are whole, also where they are longer between some of its texts."""
    shared, more = rand_words(60, 5), rand_words(40, 6)
    texts = [rand_words(50, 100 + i) + shared + (more if i % 3 == 0 else []) + rand_words(50, 200 + i) + (shared[:55] if i == 4 else []) for i in range(30)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for small in (4, 64):
        got = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in substring_dup.duplicate_passages(df, small=small).collect()}
        assert got == {i: [(50, 150 if i % 3 == 0 else 110)] + ([(160, 215)] if i == 4 else []) for i in range(30)}


def test_exact_passages_after_a_part_of_them(spark):
    shared = rand_words(70, 5)
    texts = [shared[:30] + rand_words(40, 1) + shared + rand_words(20, 2), rand_words(60, 3) + shared]
    got = substring_dup.duplicate_passages(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    assert {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in got} == {0: [(70, 140)], 1: [(60, 130)]}


@pytest.mark.parametrize("small", [64, 2])
def test_near_passages_are_found(spark, small):
    """Near passages between otherwise different texts, against brute force over all pairs."""
    rng, texts = np.random.default_rng(5), []
    for i in range(40):
        passage = rand_words(52 + 3 * i, 400 + i)
        other = list(passage)
        for k in range(1 + len(passage) // 60):
            at = int(rng.integers(0, len(other)))
            other[at : at + int(rng.integers(0, 2))] = [f"n{i}q{k}"]
        texts += [" ".join(rand_words(60, 500 + i) + passage), " ".join(other + rand_words(70, 600 + i))]
    wanted = links_by_brute_force(texts)
    got = {r["doc_id"]: r["class_id"] for r in substring_dup.duplicate_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), small=small).collect()}
    assert len(wanted) >= 30 and set(got) == {x for p in wanted for x in p} and all(got[i] == j for i, j in wanted)


def test_near_passages_within_dissimilar_stretches():
    """Near passages next to words that differ every few words: held against brute force over ranges of 50 to 64 words."""
    near = lambda x, y: len(x & y) / len(x | y) >= 0.8
    for i in range(12):
        rng = np.random.default_rng(i)
        noise, passage = rand_words(120, 900 + i), rand_words(64, 950 + i)
        other = list(passage)
        if i % 3 == 0:
            other[32] = "changed"
        elif i % 3 == 1:
            other.insert(32, "inserted")
        else:
            del other[32]
        worse = [w if k % 8 else f"x{i}q{k}" for k, w in enumerate(noise)]
        a, b = noise[:60] + passage + noise[60:], worse[:60] + other + worse[60:]
        if i >= 9:  # moved
            b = worse[60:] + other + worse[:60]
        number = {g: int(v) for g, v in zip(sorted({tuple(t[k : k + 5]) for t in (a, b) for k in range(len(t) - 4)}), rng.integers(1, 1 << 60, 500))}
        x, y = (np.array([number[tuple(t[k : k + 5])] for k in range(len(t) - 4)], np.uint64) for t in (a, b))
        sets = lambda v, n: [(s, set(v[s : s + n].tolist())) for s in range(len(v) - n + 1)]
        wanted = {s for n in (46, 53, 60) for s, p in sets(x, n) for _, q in sets(y, n) if len(p & q) > 36 and near(p, q)}
        got, other_side = substring_dup.passages(x, substring_dup.Side(y, 46), 50, 0.8)
        assert wanted and got and other_side
        inside = {p for s, e, _ in got for p in range(s, e - 4)}
        assert all(any(q in inside for q in range(s, s + 46)) for s in wanted) and any(s <= 64 and e >= 120 for s, e, _ in got)


def xx(spark, rows):
    """xxhash64 of rows of strings, as the operator hashes words."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ["i", *(f"c{k}" for k in range(len(rows[0])))])
    return [r[0] for r in df.orderBy("i").select(F.xxhash64(*df.columns[1:])).collect()]


def test_quality_score_against_brute_force(spark, edge):
    rows = [(i, " ".join(rand_words(60, i % 7)) + ("\n" + " ".join(x + "%" for x in rand_words(20, 70 + i % 3)) if i % 5 == 0 else "")) for i in range(40)] + EDGE
    df, trusted = spark.createDataFrame(rows, "doc_id long, text string"), {i for i in range(0, 40, 2)}
    buckets, prior = 1 << 12, quality.PRIOR
    split = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for _, t in rows]
    ones, twos = sorted({(w,) for s in split for w in s}), sorted({p for s in split for p in zip(s, s[1:])})
    bucket = {g: h % buckets for gs in (ones, twos) for g, h in zip(gs, xx(spark, gs))}
    grams = [[bucket[(w,)] for w in s] + [bucket[p] for p in zip(s, s[1:])] for s in split]
    raw = collections.Counter(b for g in grams for b in g)
    target = collections.Counter(b for (i, _), g in zip(rows, grams) if i in trusted for b in g)
    scale = sum(raw.values()) / sum(target.values())
    ratio = {b: round(1024 * np.log((target[b] * scale + prior) / (raw[b] + prior))) for b in raw}
    expected = sorted((str(i), round(sum(ratio[b] for b in g) / 1024 / max(1, len(g)), 9)) for (i, _), g in zip(rows, grams))
    ids = spark.createDataFrame([(i,) for i in sorted(trusted)], "doc_id long")
    ratios = quality.ratio_table(df, ids, "doc_id", "text", buckets)
    for limit, frequent in ((1 << 20, 1.0), (0, 1.0), (0, 0.002)):
        got = quality.score(df, ratios, buckets=buckets, broadcast_bytes=limit, frequent=frequent).collect()
        assert sorted((str(r["doc_id"]), round(r["score"], 9)) for r in got) == expected
        assert all(r["kept"] == (not r["base_failed"] and r["score"] >= quality.THRESHOLD) and r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) for r in got)


def test_quality_buckets_grow_with_the_corpus(spark, edge):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.expr("repeat('word ', 4000000)").alias("text"))
    assert quality.bucket_count(docs) == 2_000_000 and quality.bucket_count(docs.limit(0)) == quality.bucket_count(edge) == quality.BUCKETS
