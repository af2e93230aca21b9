from __future__ import annotations

import zlib

import numpy as np
import pytest

from siftloom.llm import line_crf, ppm, samples, toxicity, weak_quality
from siftloom.llm.queries import op2_cnn_toxicity, op4_weak_quality, op5_crf_lines, op7_ppm_language
from siftloom.llm.samples import Sample

from . import helpers

SF = "/root/testdata/sf0.01"


def block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    one = sum(label)
    return (sum(r for r, y in zip(rank, label) if y) - one * (one + 1) / 2) / (one * (len(label) - one))


def test_toxicity_learns_words_and_scores_whole_texts(spark):
    clean = [helpers.prose(k, 60) for k in range(150)]
    toxic = [helpers.prose(1000 + k, 60).replace(" ", f" vile{'abcdefgh'[k % 8]} ", 3 + k % 2) for k in range(120)]
    rows = [(t, 0, "en") for t in clean] + [(t, 1, "fr") for t in toxic] + [("", 1, None), ("x", 0, None)]
    net = toxicity.train(Sample([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], {0: 1500, 1: 120}))
    new = [helpers.prose(5000 + k, 60) for k in range(60)]
    bad = [t.replace("\n", " vilez \n vileq ", 2) for t in new]
    p = net.scores(*block(new + bad))
    assert auc(p, [0] * 60 + [1] * 60) > 0.95
    # one word at the very end of a very long text counts like one at its start
    long = " ".join(new) * 40
    both = net.scores(*block([long + " vilea vileb vilec", "vilea vileb vilec " + long]))
    assert both.min() > 0.9 and both[0] == pytest.approx(both[1], abs=0.05)
    # a text scores alike alone and in a block, and steps do not matter
    alone = [net.scores(*block([t]))[0] for t in new[:5]]
    assert np.allclose(alone, p[:5])
    old, toxicity.STEP = toxicity.STEP, 37
    try:
        assert np.allclose(net.scores(*block(new + bad)), p)
    finally:
        toxicity.STEP = old


def test_toxicity_of_awkward_rows(spark):
    docs = helpers.documents(spark, helpers.awkward())
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(20)] + [(None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    net = toxicity.train(toxicity.labelled(docs, labels))
    out = toxicity.with_threshold(toxicity.score(docs, net), net).collect()
    assert len(out) == len(helpers.awkward()) and all(0 <= r.score <= 1 for r in out)
    by = {}
    for r in out:
        by.setdefault((r.doc.doc_id, r.doc.text), set()).add(r.score)
    assert all(len(s) == 1 for s in by.values())
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == docs.count()
    assert toxicity.score(docs.limit(0), net).count() == 0


def test_toxicity_query(spark):
    rows = op2_cnn_toxicity(spark, SF).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    # 6 toxic rows are held out at this size, two of them with words that the sample does not have
    assert auc(*zip(*held)) > 0.8


def test_em_finds_the_good_labellers():
    rnd = np.random.default_rng(0)
    truth = rnd.random(4000) < 0.8
    right = [0.95, 0.9, 0.85, 0.6] + [0.9] * (len(weak_quality.LABELLERS) - 4)
    patterns, hits = {}, 0
    rows = []
    for y in truth:
        p = "".join(str(2 if rnd.random() < 0.2 else int(y) if rnd.random() < a else 1 - int(y)) for a in right)
        patterns[p] = patterns.get(p, 0) + 1
        rows.append((p, y))
    posterior = weak_quality.pattern_posterior(patterns)
    hits = sum((posterior[p] > 0.5) == y for p, y in rows)
    assert hits / len(rows) > 0.98
    found = weak_quality.accuracies(patterns, posterior)
    assert all(abs(found[n] - a) < 0.05 for n, a in zip(weak_quality.LABELLERS, right))
    assert weak_quality.pattern_posterior({}) == {}


def test_weak_quality_query(spark):
    rows = op4_weak_quality(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    known = [(r.score, labels[r.doc_id]) for r in rows if r.doc_id in labels]
    assert auc(*zip(*known)) > 0.98
    assert np.mean([(s >= 0.5) == y for s, y in known]) > 0.97


def test_weak_quality_of_awkward_rows(spark):
    docs = helpers.documents(spark, helpers.awkward())
    out = weak_quality.score(docs).collect()
    assert len(out) == len(helpers.awkward())
    assert all(r.score == 0 and not r.kept and set(r.votes) == {"0"} for r in out if not (r.doc.text or "").strip())
    assert weak_quality.score(docs.limit(0)).count() == 0


def viterbi(field, features):
    """All labellings, one by one."""
    best, path = None, None
    for code in range(1 << len(features)):
        states = [code >> t & 1 for t in range(len(features))]
        s = sum(float(field.weights[y] @ x) for y, x in zip(states, features)) + sum(field.moves[a, b] for a, b in zip(states, states[1:]))
        if best is None or s > best:
            best, path = s, states
    return path


def test_viterbi_and_gradient_equal_enumeration():
    rnd = np.random.default_rng(4)
    field = line_crf.Field(rnd.normal(size=(2, 5)), rnd.normal(size=(2, 2)))
    counts = np.array([3, 1, 7, 5])
    features = rnd.normal(size=(counts.sum(), 5))
    first = np.cumsum(counts) - counts
    got = field.viterbi(features, first, counts)
    assert got.tolist() == [y for a, n in zip(first, counts) for y in viterbi(field, features[a:a + n])]
    label = rnd.integers(0, 2, counts.sum())

    def likelihood():
        total = 0.0
        for a, n in zip(first, counts):
            def value(states):
                return sum(float(field.weights[y] @ x) for y, x in zip(states, features[a:a + n])) + sum(field.moves[p, q] for p, q in zip(states, states[1:]))
            total += value(label[a:a + n].tolist()) - np.logaddexp.reduce([value([c >> t & 1 for t in range(n)]) for c in range(1 << n)])
        return total

    order = np.argsort(-counts, kind="stable")
    gradient = field.gradient(features, first[order], counts[order], label)
    for value, g in zip((field.weights, field.moves), gradient):
        for at in np.ndindex(value.shape):
            value[at] += 1e-6
            up = likelihood()
            value[at] -= 2e-6
            down = likelihood()
            value[at] += 1e-6
            assert (up - down) / 2e-6 == pytest.approx(g[at], abs=1e-4)


def test_line_counts_equal_brute_force(spark):
    rows = helpers.awkward() + [(30, "a b c a b c a b"), (31, "$1 #2 <b>\n$1 #2 <b>\n\n\nx"), (32, "w " * 200)]
    docs = helpers.documents(spark, rows)
    got = line_crf.judge(docs, None).collect()
    want = sorted(((i, *helpers.base_counts(t)) for i, t in rows), key=str)
    assert sorted(((r.doc.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str) == want
    assert all(r.kept == (not r.base_failed) and len(r.states) == (r.doc.text or "").count("\n") + 1 for r in got)
    assert line_crf.judge(docs.limit(0), None).count() == 0


def test_crf_query(spark):
    rows = op5_crf_lines(spark, SF).collect()
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == helpers.base_counts(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    judged = [(r.kept, quality[r.doc_id]) for r in rows if r.doc_id in quality and not r.base_failed]
    assert np.mean([k == bool(q) for k, q in judged]) > 0.97


def code_length(samples, text, order=ppm.ORDER):
    """Plain partial matching, byte by byte."""
    counts = {}
    for s in samples:
        raw = b"\n" * order + s.encode()
        for i in range(order, len(raw)):
            for k in range(order + 1):
                c = counts.setdefault(raw[i - k:i], {})
                c[raw[i]] = c.get(raw[i], 0) + 1
    raw, bits = b"\n" * order + text.encode(), 0.0
    for i in range(order, len(raw)):
        for k in range(order, -1, -1):
            c = counts.get(raw[i - k:i])
            if c is None:
                continue
            total, kinds = sum(c.values()), len(c)
            if raw[i] in c:
                bits -= np.log2(c[raw[i]] / (total + kinds))
                break
            bits -= np.log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


def test_code_lengths_equal_brute_force():
    samples = {"a": [helpers.prose(1, 100), "ça va bien"], "b": [helpers.prose(2, 100).upper()], "c": ["zz"]}
    trees = ppm.Trees(samples)
    texts = [helpers.prose(3, 30), "", "ÄÖÜ 日本", "zzzz", helpers.prose(2, 40).upper(), "\n\n\n"]
    got = trees.lengths(*block(texts))
    want = [[code_length(samples[lang], t) for lang in "abc"] for t in texts]
    assert np.allclose(got, want, atol=1e-2)


def test_languages_of_awkward_rows(spark):
    docs = helpers.documents(spark, helpers.awkward())
    learned = docs.select("text", "lang")
    out = ppm.predict(docs, ppm.train(learned)).collect()
    assert len(out) == len(helpers.awkward())
    for r in out:
        known = any(c.isalpha() for c in r.doc.text or "")
        assert (r.lang_pred in ("en", "fr")) if known else (r.lang_pred == "und" and r.score == 0)
        assert 0 <= r.score <= 1
    assert {r.lang_pred for r in ppm.predict(docs, ppm.train(learned.limit(0))).collect()} == {"und"}
    assert ppm.predict(docs.limit(0), None).count() == 0


def test_language_query(spark):
    rows = op7_ppm_language(spark, SF).collect()
    lang = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect())
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) > 0.98


def test_labelled_rows_are_bounded_in_bytes(spark):
    docs = helpers.documents(spark, [(i, helpers.prose(i, 50 + i)) for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    whole, totals = samples.labelled_rows(docs, labels, "toxic", 1000, 10_000)
    assert whole.count() == 200 and totals == {0: 100, 1: 100}
    few = samples.labelled_rows(docs, labels, "toxic", 1000, 10_000, max_bytes=20_000)[0].collect()
    for k in (0, 1):
        sizes = [len(r.text.encode()) for r in few if r.label == k]
        assert 9_000 < sum(sizes) <= 10_000
    assert {r.text for r in few} <= {r.text for r in whole.collect()}


def test_toxicity_is_fitted_alike_in_a_task(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("doc_id % 4 = 0")
    here, there = toxicity.train(toxicity.labelled(docs, labels)), toxicity.fitted(docs, labels)
    assert np.array_equal(here.embedding, there.embedding) and here.thresholds == there.thresholds
    assert toxicity.fitted(docs.limit(0), labels) is None


def test_crf_learns_changes_of_state():
    """Heads and feet of boilerplate around good documents are found, and the documents' own lines stay content."""
    import pyarrow.parquet as pq

    folder = "/root/testdata/sf0.1"
    quality = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{folder}/labels.parquet").to_pylist() if r["quality"] is not None}
    docs = [(r["doc_id"], r["text"], quality[r["doc_id"]]) for r in pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
            if r["doc_id"] in quality and r["text"] and len(r["text"]) < 20_000]
    fit = [d for d in docs if d[0] % 2 == 0]
    field = line_crf.train(Sample([d[1] for d in fit], [d[2] for d in fit], [None] * len(fit), {0: 1, 1: 1}))
    held = [d for d in docs if d[0] % 2]

    def decoded(texts):
        lines = line_crf.Lines(*block(texts))
        counts = np.diff(np.append(lines.first, len(lines.row)))
        return lines, counts, field.viterbi(lines.features, lines.first, counts)

    lines, counts, state = decoded([d[1] for d in held])
    kept = np.bincount(lines.row, lines.words * state, len(counts)) / np.maximum(lines.n_words, 1) >= 0.5
    good = np.array([d[2] for d in held]) == 1
    assert kept[good].mean() > 0.98 and (~kept)[~good].mean() > 0.95
    assert sum(1 for a, n in zip(lines.first, counts) if n >= 5 and 0 < state[a:a + n].sum() < n) > 0
    bad = [x for d in held if d[2] == 0 for x in d[1].split("\n") if x.strip()]
    menu = ["Home | About | Contact | Login", "Click here!!! Buy now!!!", "Terms | Privacy | Cookies", "Share | Tweet | Pin | Email"]
    rnd = np.random.default_rng(1)
    for k, source in ((2, menu), (20, menu), (5, bad), (20, bad)):
        texts = ["\n".join([*rnd.choice(source, k), d[1], *rnd.choice(source, k)]) for d in held if d[2] == 1][:200]
        lines, counts, state = decoded(texts)
        own = np.concatenate([state[a + k:a + n - k] for a, n in zip(lines.first, counts)])
        planted = np.concatenate([np.r_[state[a:a + k], state[a + n - k:a + n]] for a, n in zip(lines.first, counts)])
        assert own.mean() > 0.95 and (planted == 0).mean() > 0.89, (k, own.mean(), planted.mean())


def test_languages_of_long_texts_and_of_copies_are_learned(spark):
    rows = [(f"{'abcde'[i % 5] * 3} ein zwei drei vier {i} ", "de") for i in range(900)]
    rows += [("pqr stu " * 4000 + str(i), "long") for i in range(3)]  # long texts only
    rows += [("klm nop klm nop " + "op" * (i % 2), "copies") for i in range(2000)]  # two texts only
    rows += [(None, "de"), ("", "de"), ("xyz", None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    found = samples.text_sample(df.where("text != ''"), 100, 500, "lang")
    count = {k: found.labels.count(k) for k in set(found.labels)}
    assert count["long"] == 3 and count["copies"] == 2 and 60 < count["de"] < 140
    assert max(map(len, found.texts)) == 500 and found.totals == {"de": 900, "copies": 2000, "long": 3}
    assert set(samples.text_sample(df.where("text != ''"), 100, 500, "lang", groups=1).labels) == {"copies"}
    trees = ppm.train(df, 100)
    got = [r.lang_pred for r in ppm.predict(spark.createDataFrame([("pqr stu pqr",), ("klm nop",), ("ein zwei drei",)], "text string"), trees).collect()]
    assert got == ["long", "copies", "de"]
    assert samples.text_sample(df.limit(0), 100, 500, "lang").texts == []


def test_toxicity_learns_from_all_labelled_texts(spark):
    """Long texts count as others do, and neither shards nor partitions lose a row or change the network."""
    from pyspark.sql import functions as F

    long = "ab cd ef " * 4500
    rows = [(i, f"{i} {long} {'vilea vileb' if i % 2 else 'gh ij'}") for i in range(240)]
    assert min(len(t) for _, t in rows) > 40_000
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    stored = toxicity.shards_of(docs, labels, 1_000_000)
    assert stored.count() == 240 and stored.select("shard").distinct().count() > 1
    one, other = (toxicity.fitted(d, labels, shard_bytes=1_000_000) for d in (docs.repartition(7), docs.coalesce(1)))
    assert np.array_equal(one.embedding, other.embedding) and one.thresholds == other.thresholds
    p = {r.doc.doc_id: r.score for r in toxicity.score(docs, toxicity.fitted(docs, labels)).select(F.col("doc"), "score").collect()}
    assert auc([p[i] for i in range(240)], [i % 2 for i in range(240)]) > 0.95


def test_toxicity_hashes_words_side_by_side(monkeypatch):
    """Words and prefixes have the CRC-32 that zlib gives, at one call per text and over-long word instead of four per word."""
    texts = [f"Wort{k} été{k % 7} ab{k % 5} x " + "y" * (60 + k % 9) for k in range(300)] + ["", "--", "z" * 500]
    words = sorted({w for t in texts for w in t.lower().encode().replace(b"-", b" ").split()})
    found = toxicity.word_features(toxicity.pa.array(words, toxicity.pa.large_binary()))
    for w, row in zip(words, found.tolist()):
        own = [zlib.crc32(w)] + [zlib.crc32(w[:n], n) for n in toxicity.PREFIXES if len(w) > n]
        assert row == [h % toxicity.BUCKETS for h in own] + [toxicity.BUCKETS] * (4 - len(own))

    real, calls = zlib.crc32, []
    monkeypatch.setattr(toxicity.zlib, "crc32", lambda *a: calls.append(1) or real(*a))
    batch = toxicity.pa.RecordBatch.from_pydict({"shard": [0] * len(texts), "text": texts, "label": [0] * len(texts), "lang": ["de"] * len(texts)})
    seen = toxicity.texts_with([batch], 7)
    assert len(calls) < 3 * len(texts) + 40
    fitted = [t for t in texts if real(b"7" + t.encode()) % 5]
    once = [{real(w) % toxicity.BUCKETS for w in t.lower().encode().replace(b"-", b" ").split()} for t in fitted]
    assert all(seen[h] >= sum(h in s for s in once) > 0 for s in once for h in s) and seen[real(b"x") % toxicity.BUCKETS] >= 200


def test_toxicity_keeps_texts_of_a_block_only():
    """A batch of texts never becomes Python objects as a whole; what a worker holds stays with it in later steps."""
    import tracemalloc

    texts = [f"{k} " + "ab cd " * 1000 for k in range(4000)]
    batch = toxicity.pa.RecordBatch.from_pydict({"shard": [0] * 4000, "text": texts, "label": [0] * 4000, "lang": ["en"] * 4000})
    size = sum(map(len, texts))
    del texts
    tracemalloc.start()
    try:
        n = sum(len(block[2]) for held in (False, True) for block in toxicity.labelled_blocks([batch], 7, held))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 4000 and size > 10 * toxicity.BLOCK and most < 4 * toxicity.BLOCK
