"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for operators and stages."""

import itertools
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kerbline.llm import chat, decontamination as D, fingerprints as FP, language as L, lines, minhash as M, mixing, quality, stages, toxicity as T, urls

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ROWS = [(1, "a plain little text of some ten words or so\nand a line", "en", "s1"), (1, "a plain little text of some ten words or so\nand a line", "en", "s1"),
        (2, None, "en", None), (3, "", None, "s1"), (4, "  \n\t ", "de", "s2"), (5, LONG, "de", "s2"), (None, "a text without an id of its own", "en", "s2"),
        (6, "word", None, None), (7, "ÄÖÜ ß 12 éè", "de", ""), (8, "1 2 3 ...", "fr", "s1"), (9, "tie of texts", "fr", "s1"), (10, "tie of texts", "fr", "s1")]
CLASH = ("score", "copy", "cut", "n", "k1", "gone", "leak_id", "body", "i", "tie", "d", "w", "size")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 1), (9, 1, 0), (10, 0, 1), (None, 1, 1), (6, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")


def operators(docs, labels, benchmark):
    return {
        "toxicity": lambda d: T.scores(d, T.train(d, labels)), "quality": lambda d: quality.scores(d, quality.train(d, labels)),
        "near": M.near_duplicates, "lines": lines.kept_lines, "fingerprints": FP.fingerprints,
        "language": lambda d: L.predictions(d, L.train(d)), "decontamination": lambda d: D.judged(d, benchmark), "mixing": mixing.taken}


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "a plain little text of some ten words"), (2, None), (3, ""), (None, "word"), (1, "a plain little text of some ten words")],
                                 "item_id long, text string")


@pytest.mark.parametrize("name", ["toxicity", "quality", "near", "lines", "fingerprints", "language", "decontamination", "mixing"])
def test_operators_take_any_rows(spark, docs, labels, benchmark, name):
    op = operators(docs, labels, benchmark)[name]
    odd = docs
    for c in CLASH:
        odd = odd.withColumn(c, F.lit("x"))
    got = op(odd).collect()
    assert len(got) == len(ROWS) and sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)
    by = {(r["doc_id"]): r for r in got}
    if name in ("toxicity", "quality"):
        assert all(0 <= r["score"] <= 1 for r in got)
    if name == "quality":
        assert by[2]["score"] == by[3]["score"] == by[4]["score"] == 0
    if name == "near":
        assert by[2]["n_shingles"] == 0 and by[2]["kept"] and by[3]["kept"] and by[10]["component_id"] == 9 and not by[10]["kept"] and by[None]["kept"]
    if name == "lines":
        assert by[2]["text"] is None and by[3]["text"] == "" and by[5]["text"] == LONG
    if name == "fingerprints":
        assert by[2]["fingerprint"] == by[3]["fingerprint"] == "--" and by[9]["fingerprint"] == by[10]["fingerprint"]
    if name == "language":
        assert by[2]["lang_pred"] == by[3]["lang_pred"] == by[8]["lang_pred"] == "und" and by[2]["score"] == 0 and by[9]["lang_pred"] in ("en", "de", "fr")
    if name == "decontamination":
        assert by[1]["item_ids"] == [1] and not by[5]["leaked"] and not by[2]["leaked"]
    if name == "mixing":
        assert by[2]["size"] == 0 and by[2]["taken"] == 0 and all(r["taken"] <= 2 * r["size"] for r in got)
    assert op(odd.limit(0)).count() == 0


@pytest.mark.parametrize("name, step", corpus_pipeline.STAGES)
def test_stages_take_any_rows(spark, docs, name, step):
    odd = docs.withColumn("n_chars", F.length("text").cast("long"))
    for c in CLASH:
        odd = odd.withColumn(c, F.lit("x"))
    got = step(spark, odd, SF)
    assert got.columns[:len(odd.columns)] == odd.columns and (name == "mixing" or got.columns == odd.columns)
    assert {str(r["doc_id"]) for r in got.collect()} <= {str(r[0]) for r in ROWS}
    assert step(spark, odd.limit(0), SF).count() == 0


def test_stages_decide_what_they_should(spark, tmp_path):
    """The stages on planted rows, each on what the one before it kept."""
    sf = SF.replace("0.001", "0.01")
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").limit(2).collect()]
    d = duckdb.sql(f"SELECT d.*, coalesce(quality = 1 AND toxic = 0, false) AS fine FROM '{sf}/documents.parquet' d LEFT JOIN '{sf}/labels.parquet' l USING (doc_id)").df()
    base = [(int(i), t, "en", f"s{k % 3}", len(t)) for k, (i, t) in enumerate(zip(d.doc_id, d.text, strict=True))]
    fine = [t for t, ok in zip(d.text, d.fine, strict=True) if ok and 500 < len(t) < 5000]
    passage = " ".join(f"Passage{chr(97 + i % 26)}{chr(97 + i // 26)} of words" for i in range(30))
    planted = [(100001, fine[0], "en", "s0", 0), (100002, fine[0] + " end", "en", "s1", 0), (100003, "SPAM!! WOW!! BUY!! NOW!! " * 60, "en", "s0", 0),
               (100004, fine[1].upper().lower() + "\n" + items[0], "en", "s1", 0),
               *[(100010 + i, f"{fine[i + 3][::-1]}\n{passage}\nlast words of number {'abcdef'[i]}", "en", "s2", 0) for i in range(5)]]
    docs = spark.createDataFrame(base + planted, "doc_id long, text string, lang string, source string, n_chars long")
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        step(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs
    ids = {n: {r["doc_id"] for r in s.select("doc_id").collect()} for n, s in seen.items()}
    assert 100003 not in ids["quality"] and {100001, 100002, 100004} <= ids["quality"]
    assert set(d.doc_id[d.fine]) <= ids["quality"]
    texts = [r["text"] for r in seen["line_dedup"].collect()]
    assert sum(passage in t for t in texts) == 1 and len(ids["line_dedup"]) == len(ids["quality"])
    assert not {100001, 100002} & ids["near_dedup"] and 100004 in ids["near_dedup"]
    assert 100004 not in ids["decontamination"]
    assert ids["mixing"] <= ids["decontamination"] and seen["mixing"].count() >= len(ids["mixing"])


def test_rows_of_one_id_go_by_their_own_text(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(30)) for w in "abc")
    rows = [(3, a, "s1"), (5, a, "s1"), (5, b, "s2"), (7, c, "s2"), (7, c, "s1"), (7, c, "s1"), (8, c, "s1"), (8, c, "s1"), (None, a, "s1"), (None, a, "s1"), (9, None, "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone string").withColumn("d", F.lit(1))
    got = M.without_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r[:3] for r in got.collect()), key=str) == sorted([(3, a, "s1"), (5, b, "s2"), (7, c, "s1"), (None, a, "s1"), (None, a, "s1"), (9, None, "s1")], key=str)


def test_chats_collapse_and_render(spark):
    talk = lambda c, *turns: [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    a = [("user", "hi"), ("assistant", "hello"), ("user", "more")]
    log = talk(1, *a[:1]) + talk(2, *a[:2]) + talk(3, *a) + talk(4, *a) + talk(5, ("user", "hi"), ("assistant", "bye <|im_end|>")) + [
        (6, 0, None, None), (6, 0, None, None), (None, 0, "user", "lost"), (7, 1, "user", "x"), (7, 1, "assistant", "y")]
    rows = spark.createDataFrame(log, "conv_id long, turn long, role string, text string").withColumn("copies", F.lit(0)).withColumn("h", F.lit("x"))
    got = {r["conv_id"]: r for r in chat.rendered(rows).collect()}
    assert set(got) == {3, 5, 6, 7} and got[3]["copies"] == 2 and got[3]["n_turns"] == 3
    assert got[3]["text"] == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in a)
    assert "bye < |im_end|>" in got[5]["text"] and got[6]["text"] == "<|im_start|>unknown\n<|im_end|>\n" and got[7]["n_turns"] == 2
    assert chat.rendered(rows.limit(0)).count() == 0


def test_urls_by_rule_and_by_mined_rule(spark):
    pages = [(1, "http://A.Example.COM/en/1?x#y"), (2, "https://www.example.com/en/2"), (3, "http://x.net/fr/3"), (4, None), (5, "no url"), (6, "ftp://com"),
             (7, "http://com/"), (8, "x://example.com?/en/"), (9, "http://notcom/en"), (9, "http://notcom/en"), (10, "http://shop.test.org/spam/7/x")]
    labels = [(f"http://{h}.org/{p}/{i}", v) for i, (h, p, v) in enumerate(
        [("a", "spam", "block")] * 20 + [("b", "spam", "block")] * 15 + [("a", "news", "allow")] * 40 + [("b", "spam", "allow")] * 2)]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("tokens", F.lit(1)).withColumn("key", F.lit("k"))
    lab = spark.createDataFrame(labels, "url string, verdict string")
    got = {r["page_id"]: r for r in urls.judged(df, lab).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[2]["rule"] == "www.example.com/en/" and got[2]["verdict"] == "allow" and got[3]["rule"] == "net/fr/"
    assert got[4]["host"] == got[5]["host"] == got[4]["path"] == "" and got[4]["verdict"] == "allow"
    assert (got[6]["rule"], got[7]["rule"], got[8]["rule"], got[9]["rule"]) == (None, "com/", None, None)
    assert got[10]["verdict"] == "block"
    rules = urls.mined(baskets(lab), urls.Mining())
    for r in rules.collect():  # brute force over all labelled urls
        need = set(r["need"])
        has = [v for u, v in labels if need <= tokens_of(u)]
        assert r["confidence"] == pytest.approx(has.count(r["verdict"]) / len(has)) and r["support"] == pytest.approx(has.count(r["verdict"]) / len(labels))
    mined = {(frozenset(r["need"]), r["verdict"]) for r in rules.collect()}
    assert (frozenset({"path1:spam"}), "block") in mined
    assert urls.judged(df.limit(0), lab).count() == 0 and urls.judged(df, lab.limit(0)).where("page_id = 10").first()["verdict"] == "allow"


def baskets(lab):
    host, path = urls.host_path(F.col("_u"))
    return lab.withColumnRenamed("url", "_u").select(urls.tokens(host, path).alias("tokens"), "verdict")


def tokens_of(url):
    host, path = re.match(r"[^:]*://([^/?#]*)([^?#]*)", url).groups()
    parts = host.split(".")
    ends = {"host:" + ".".join(parts[i:]) for i in range(len(parts))}
    names = [x for x in re.sub("[0-9]+", "#", path).split("/") if x]
    return ends | {f"path{i + 1}:{x}" for i, x in enumerate(names)}


def test_weights_repeat_over_many_sources(spark):
    docs = spark.createDataFrame([(i, "a b c d", f"s{i:03d}") for i in range(300)], "doc_id long, text string, source string")
    sizes = mixing.document_sizes(docs)
    got = {r["source"]: r["weight"] for r in mixing.weighted_sources(sizes, (5, 2, 1)).collect()}
    assert [got[f"s{i:03d}"] for i in range(300)] == list(itertools.islice(itertools.cycle((5, 2, 1)), 300))


def test_leaks_are_judged_by_text_not_by_id(spark):
    item = "which of the seven rivers flows through the old town before it meets the sea at last the green one"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, f"intro words {item} and more"), (None, "a clean text of its own with nothing to hide"), (5, f"again {item} here"), (5, "clean too under the same id"), (6, "fine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["text"] for r in D.clean(docs, benchmark).collect()) == sorted(t for _, t in rows if item not in t)
    assert sorted((r["doc_id"] or 0, r["leaked"]) for r in D.judged(docs, benchmark).collect()) == [(0, False), (0, True), (5, False), (5, True), (6, False)]


def test_more_indexes_change_no_score(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words, 30))) for i in range(40)] + [(3, " ".join(rng.choice(words, 290)))]
    docs = [(i, " ".join([*rng.choice(words, 20), *items[i][1].split()[3:], *rng.choice(words, 20)])) for i in range(20)]
    docs += [(100, " ".join(items[-1][1].split()[-130:]))]
    b = spark.createDataFrame(items + items[:9], "item_id long, text string")  # some repeated
    d = spark.createDataFrame(docs, "doc_id long, text string")
    def found(shard):
        return sorted((r["doc_id"], r["item_id"], round(r["score"], 9)) for r in D.leaks(d, b, D.Rule(threshold=0.5, shard=shard)).collect())
    assert found(1000) == found(14) and len(found(14)) > 10
    assert any(doc == 100 and item == 3 for doc, item, _ in found(14))  # the last piece of a long item is looked for too


def test_candidates_in_small_batches_are_the_same(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 40) % 90) for _ in range(200)]
    rule = D.Rule(threshold=0.4)
    ix = D.build(list(range(200)), texts, rule)
    pairs = sorted({(int(p), int(t)) for p, t in zip(rng.integers(0, 60, 900), rng.integers(0, len(ix.terms), 900))})
    passage, term = (np.array(x) for x in zip(*pairs))
    def found():
        return set(zip(*[x.tolist() for x in D.candidates(passage, term, 60, ix, 0.3)]))
    whole = found()
    monkeypatch.setattr(D, "ROOM", 300)
    assert found() == whole and whole


def test_a_doubled_table_gives_the_same_models(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    twice = docs.unionByName(docs)
    a, b = T.train(docs, labels), T.train(twice, labels)
    assert a.features.tolist() == b.features.tolist() and np.allclose(a.weights, b.weights) and np.allclose(a.beta, b.beta)
    a, b = quality.train(docs, labels), quality.train(twice, labels)
    assert np.allclose(a.weights, b.weights) and np.allclose(a.stay, b.stay)


def test_languages_and_labels_known_by_long_texts_only(spark):
    german, english = "der Hund und die Katze laufen durch den Garten ", "the dog and the cat are running through the garden "
    rows = [(i, german * 40, "de") for i in range(0, 60)] + [(100 + i, english, "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    how = L.Fit(chars=1000)
    got = {r["doc_id"]: r["lang_pred"] for r in L.predictions(docs, L.train(docs, how), how).collect()}
    assert all(got[i] == "de" for i in range(60)) and all(got[100 + i] == "en" for i in range(40))
    assert L.train(docs.where("lang = 'de'"), how) is not None
    bad = [(i, "!!! $$$ ### BUY BUY BUY\n" * 100) for i in range(40)]
    good = [(100 + i, "A quiet line of plain words, as people write them.\n" * 2) for i in range(40)]
    docs = spark.createDataFrame(bad + good, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in bad + good], "doc_id long, quality int")
    field = quality.train(docs, labels, quality.Fit(chars=500, lines=50))
    got = {r["doc_id"]: r["score"] for r in quality.scores(docs, field).collect()}
    assert max(got[i] for i in range(40)) < 0.3 < min(got[100 + i] for i in range(40))
