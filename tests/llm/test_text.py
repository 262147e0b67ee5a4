"""Text operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbline.llm import bytewise as B, decontamination as D, fingerprints as FP, language as L, lines, minhash as M, mixing, queries as Q, toxicity as T

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def read(name):
    return duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'").df()


def shingles(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def held(ids, mod, part):
    return np.array([zlib.crc32(str(i).encode()) % mod == part for i in ids])


def test_words_and_hashes_agree_with_python():
    texts = ["Hello  world hello", "", None, "a b\tc\x0bd\re f", " x\n\ty ", "é È HELLO world", "x" * (1 << 19) + " tail x"]
    seen = {}
    for block in B.blocks(pa.array(texts), 64):
        w = B.words(block)
        h = B.hashes(block.data, w.starts, w.ends)
        for r in range(block.hi - block.lo):
            want = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in WORD.findall(texts[block.lo + r] or "")]
            got = h[w.rows[r]:w.rows[r + 1]].tolist()
            assert len(got) == len(want)
            for x, y in zip(want, got, strict=True):
                assert seen.setdefault(x, y) == y
    assert len(set(seen.values())) == len(seen)


def test_signatures_estimate_likeness_and_bands_meet():
    rng = np.random.default_rng(1)
    sets, rows = [], [0]
    for share in (0.8, 0.9, 0.5):
        n = 600
        both = int(2 * n * share / (1 + share))
        x = rng.integers(1, 1 << 62, 2 * n - both, dtype=np.uint64)
        for s in (x[:n], x[n - both:]):
            sets.append(np.sort(s))
            rows.append(rows[-1] + len(s))
    sig = M.signatures(np.concatenate(sets), np.array(rows))
    for i, share in enumerate((0.8, 0.9, 0.5)):
        assert abs((sig[2 * i] == sig[2 * i + 1]).mean() - share) < 0.1
        apart = int((((sig[2 * i] ^ sig[2 * i + 1]) & 3) > 0).sum())
        assert (apart <= M.FAR) == (share >= 0.8)


def test_near_duplicates_of_a_large_group_lose_no_link(spark):
    """Chains of edits: neighbours are links, the ends are not; exact copies, short and empty texts beside them."""
    rng = np.random.default_rng(2)
    word = lambda: "w%d" % rng.integers(0, 10 ** 6)
    text = [word() for _ in range(120)]
    docs = []
    for i in range(40):
        docs.append((i, " ".join(text)))
        text = list(text)
        text[(i * 37) % 120] = word()
    docs += [(100 + i, docs[0][1]) for i in range(20)] + [(200, "a b"), (201, "A  b"), (202, "a c"), (203, ""), (204, None), (205, "")]
    got = {r["doc_id"]: r for r in M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), M.Likeness(4, 80)).collect()}
    sets = {i: shingles(t, 4) for i, t in docs}
    label = {i: i for i, _ in docs}
    for _ in docs:
        for a in label:
            for b in label:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert {i: r["component_id"] for i, r in got.items()} == label
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (label[i] == i) for i, r in got.items())


def test_fingerprints_tell_likeness(spark):
    d = read("documents").sort_values("doc_id").head(200)
    spark_docs = spark.createDataFrame(d[["doc_id", "text"]])
    got = {r["doc_id"]: r for r in FP.fingerprints(spark_docs).collect()}
    rows = list(zip(d.doc_id, d.text, strict=True))
    errors, prints = [], {}
    for k, (i, text) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        assert got[i]["n_chars"] == len(text) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        words = lambda t: {tuple(w) for w in [WORD.findall(t)[j:j + 5] for j in range(len(WORD.findall(t)) - 4)]}
        if len(WORD.findall(text)) >= 5 and len(WORD.findall(edited)) >= 5:
            errors.append(got[i]["near_edited"] - jaccard(words(text), words(edited)))
        assert prints.setdefault(text, got[i]["fingerprint"]) == got[i]["fingerprint"]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_templates_with_variable_fields_recur(spark):
    prose = ["alpha beta gamma delta number %d" % i for i in range(3)]
    docs = [(i, f"{prose[i]}\nerror code {i * 7} at host h{i} in the main loop of service\nunder {i} tail") for i in range(3)]
    docs += [(i, f"own {i} words\nThe quick old fox jumps over {w} lazy dogs again\nmore own text {i}") for i, w in zip(range(10, 14), "brown black white gray".split(), strict=True)]
    docs += [(20 + i, "same copy text here\nwith a second line in it") for i in range(5)]
    got = {r["doc_id"]: r for r in lines.kept_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    # numbers are fields everywhere, and the fox line is one template although its seventh word varies
    assert [got[i]["n_dropped"] for i in (0, 1, 2)] == [0, 2, 2]
    assert [got[i]["n_dropped"] for i in (10, 11, 12, 13)] == [0, 2, 2, 2] and "fox" not in got[12]["text"]
    assert all(got[20 + i]["n_dropped"] == 0 for i in range(5))  # exact copies are one document


def test_blocks_and_one_line_documents_recur(spark):
    footer = "Licensed under the terms below\nYou may copy this work freely\nYou may not sell this work"
    docs = [(i, f"own text {w} here\n{footer}") for i, w in enumerate(("brown", "black", "white", "gray"))]
    docs += [(10 + i, f"worker {i} has stopped after an error") for i in range(4)]
    docs += [(20 + i, "same copy text here\nwith a second line in it") for i in range(5)]
    got = {r["doc_id"]: r for r in lines.kept_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[i]["n_dropped"] for i in range(4)] == [0, 3, 3, 3] and got[0]["text"] == docs[0][1] and got[2]["text"] == "own text white here"
    assert [got[10 + i]["n_dropped"] for i in range(4)] == [0, 1, 1, 1]
    assert all(got[20 + i]["n_dropped"] == 0 for i in range(5))


def test_quality_and_language_hold_out(spark):
    labels = dict(zip(*[read("labels")[c] for c in ("doc_id", "quality")], strict=True))
    rows = [r for r in Q.op8_quality(spark, SF).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) > 0.95
    d = read("documents")
    langs = dict(zip(d.doc_id, d.lang, strict=True))
    rows = Q.op6_language(spark, SF).collect()
    assert all(r["held_out"] == h for r, h in zip(rows, held([r["doc_id"] for r in rows], 3, 1), strict=True))
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["held_out"]]) > 0.97


@pytest.fixture(scope="module")
def logp(spark):
    return T.language_model(Q.table(spark, SF, "documents"))


@pytest.mark.parametrize("written, word", [("1d10t", "idiot"), ("l0$er", "loser"), ("p@thetic", "pathetic"), ("s.c.u.m", "scum"),
                                           ("stuuuupid", "stupid"), ("m o r o n", "moron"), ("tr@$h", "trash")])
def test_disguises_are_read(logp, written, word):
    assert T.restored(written, logp) == word
    block = next(B.blocks(pa.array([f"and {written} the"])))
    plain = next(B.blocks(pa.array([word])))
    found = T.features(block, logp)[0][:, 0].tolist()
    assert T.features(plain, logp)[0][0, 0] in found


@pytest.mark.parametrize("written, word", [("are a m o r o n", "moron"), ("y o u m o r o n", "moron"), ("a i d i o t", "idiot"), ("a s s", "ass"), ("a.s.s", "ass"),
                                           ("5h17", "shit"), ("4$$", "ass"), ("@$$hole", "asshole"), ("(see", "see"), ("in 2024", "2024"),
                                           (" ".join("pack my bag with " * 9 + "moron"), "moron")])
def test_short_spaced_and_edge_disguises_are_read(logp, written, word):
    block = next(B.blocks(pa.array([f"and {written} the"])))
    assert T.features(next(B.blocks(pa.array([word]))), logp)[0][0, 0] in T.features(block, logp)[0][:, 0].tolist()


def test_toxic_texts_are_caught_in_disguise(spark):
    d, lab = read("documents"), read("labels")
    docs = Q.table(spark, SF, "documents")
    model = T.train(docs, Q.table(spark, SF, "labels"))
    clean = d[d.doc_id.isin(lab[lab.toxic == 0].doc_id)].text.head(60).tolist()
    mixed = [f"{t} you 1d10t and l0$er p@thetic m o r o n stuuuupid cl0wn" for t in clean[:30]]
    rows = spark.createDataFrame(list(enumerate(clean + mixed)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in T.scores(rows, model).collect()}
    assert np.mean([got[i] < 0.5 for i in range(60)]) > 0.95 and np.mean([got[i] >= 0.5 for i in range(60, 90)]) > 0.95


def test_rare_toxic_words_are_evidence_in_large_samples(spark):
    rows = spark.range(12_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    few = [i for i in range(1, 12_000, 2) if zlib.crc32(str(i).encode()) % 5][:8]  # of 4800 toxic texts
    word = F.when(F.col("doc_id").isin(few), "zounderkite").when(F.col("toxic") == 1, "knave").otherwise("friend")
    docs = rows.select("doc_id", F.concat(F.lit("text "), F.col("doc_id").cast("string"), F.lit(" you "), word).alias("text"))
    model = T.train(docs, rows.withColumn("quality", F.lit(1)))
    for w in ("knave", "zounderkite"):
        assert T.features(next(B.blocks(pa.array([w]))), model.logp)[0][0, 0] in model.features
    got = T.scores(spark.createDataFrame([(1, "you zounderkite"), (2, "you friend")], "doc_id long, text string"), model).collect()
    got = {r["doc_id"]: r["score"] for r in got}
    assert got[1] > 0.5 > got[2]


def test_wand_keeps_all_above_the_threshold():
    d, b = read("documents"), read("benchmark")
    rule = D.Rule(threshold=0.35)
    ix = D.build(b.item_id.tolist(), b.text.tolist(), rule)
    rng = np.random.default_rng(3)
    vocab = np.arange(len(ix.terms))
    passage, term, sums = [], [], {}
    for p in range(200):
        some = np.unique(np.concatenate([rng.choice(vocab, 60), rng.choice(ix.own[p % len(ix.own)], 12)]))
        passage += [p] * len(some)
        term += some.tolist()
        for i, own in enumerate(ix.own):
            sums[p, i] = ix.own_weight[i][np.isin(own, some)].sum()
    got = set(zip(*[x.tolist() for x in D.candidates(np.array(passage), np.array(term), 200, ix, rule.threshold)], strict=True))
    want = {k for k, v in sums.items() if v >= rule.threshold}
    assert want and want <= got


def test_benchmark_passages_are_found_and_clean_texts_left(spark):
    d, b = read("documents"), read("benchmark")
    got = {r["doc_id"]: set(r["item_ids"]) for r in Q.op7_decontamination(spark, SF).collect()}
    norm = lambda x: " " + " ".join(WORD.findall(x.lower())) + " "
    items = [(i, norm(t), shingles(t, 5)) for i, t in zip(b.item_id, b.text, strict=True)]
    assert len(got) == len(d)
    for i, text in zip(d.doc_id, d.text, strict=True):
        flat, own = norm(text), shingles(text, 5)
        for j, t, s in items:
            if t in flat:
                assert j in got[i]
            if j in got[i]:
                assert len(s & own) >= 0.4 * len(s)


def test_sources_come_near_their_targets(spark):
    rows = Q.op10_mixing(spark, SF).collect()
    d = read("documents")
    source = dict(zip(d.doc_id, d.source, strict=True))
    total, target = {}, {}
    for r in rows:
        total[source[r["doc_id"]]] = total.get(source[r["doc_id"]], 0) + r["taken"]
        target[source[r["doc_id"]]] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert sum(target.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    assert all(abs(total[s] - target[s]) <= 0.03 * target[s] for s in target)
    copies = mixing.mixed_documents(Q.table(spark, SF, "documents")).groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in copies} == {r["doc_id"]: r["taken"] // r["size"] for r in rows if r["taken"]}


def test_a_text_changed_too_much_is_told_from_a_large_group_at_once(spark, monkeypatch):
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(220)]

    def changed(i, n):  # n words in a row are new, so n + 3 shingles are this text's alone
        at = int(rng.integers(4, 210 - n))
        return " ".join([*base[:at], *[f"n{i}x{k}" for k in range(n)], *base[at + n:]])

    texts = [changed(i, 4) for i in range(40)] + [changed(i, 25) for i in range(40, 80)]
    rows = {}
    kept = M.stage
    monkeypatch.setattr(M, "stage", lambda df, name, *a: rows.setdefault(name, kept(df, name, *a)) if name == "cross" else kept(df, name, *a))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in M.near_duplicates(docs, M.Likeness(4, 80)).collect()}
    sets = [shingles(t, 4) for t in texts]
    assert not any(jaccard(sets[i], sets[j]) >= 0.8 for i in range(40, 80) for j in range(80) if i != j)
    assert got == {i: 0 if i < 40 else i for i in range(80)}
    assert rows["cross"].count() == 0
