from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siftloom.llm import oracles
from siftloom.llm.mixture import LEVELS, mix, quotas
from siftloom.llm.queries import queries
from tests import compare

from . import helpers

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert compare.difference(queries()[name](spark, SF), compare.connect(SF), oracles.oracle_sql()[name]) is None


def shared(budget, parts):
    """Water-filling by rounds: what full parts cannot take is shared again among the others."""
    share, left, open_ = {}, budget, dict(parts)
    while open_:
        weight = sum(w for w, _ in open_.values())
        full = {k for k, (w, cap) in open_.items() if cap <= left * w / weight + 1e-12}
        if not full:
            return share | {k: left * w / weight for k, (w, _) in open_.items()}
        for k in full:
            share[k] = open_.pop(k)[1]
            left -= share[k]
    return share


def tree(leaves, budget, weights, epochs):
    """Quotas by recursion; leaves is {(domain, lang, source): tokens}."""
    def go(prefix, amount):
        depth = len(prefix)
        if depth == 3:
            return {prefix: amount}
        names = {k[depth] for k in leaves if k[:depth] == prefix}

        def capacity(p):
            return sum(t * epochs for k, t in leaves.items() if k[:len(p)] == p and all(weights.get(lv, {}).get(k[i] or "", 1.0) > 0 for i, lv in enumerate(LEVELS)))

        parts = {n: (weights.get(LEVELS[depth], {}).get(n or "", 1.0), capacity((*prefix, n))) for n in names}
        share = shared(amount, {k: v for k, v in parts.items() if v[0] > 0})
        return {k: v for n in names for k, v in go((*prefix, n), share.get(n, 0.0)).items()}

    return go((), budget)


def test_quotas_equal_recursion(spark):
    leaves = {("d0", "en", "a"): 100, ("d0", "en", "b"): 1000, ("d0", "fr", "a"): 10, ("d1", "en", "a"): 50, ("d1", None, None): 70,
              ("d2", "en", "z"): 0, ("d2", "de", "y"): 5000, (None, "en", "a"): 30, ("d3", "en", "a"): 500}
    weights = {"domain": {"d0": 4, "d1": 2, "d3": 0}, "lang": {"en": 3, "": 2}, "source": {"a": 0.5}}
    df = spark.createDataFrame([(*k, t) for k, t in leaves.items()], "domain string, lang string, source string, tokens long")
    for budget in (0, 10, 500, 3000, 11_000, 50_000):
        got = {(r.domain, r.lang, r.source): r.quota for r in quotas(df, budget, weights, 2).collect()}
        want = tree(leaves, budget, weights, 2)
        assert got == {k: int(v + 1e-6) for k, v in want.items()}, budget


def test_mixture_of_awkward_rows(spark):
    rows = helpers.awkward()
    docs = helpers.documents(spark, rows)
    domain = F.coalesce(F.col("lang"), F.lit("none"))
    out = mix(docs, domain, budget=4000, epochs=3, weights={"domain": {"none": 3}}, seed=5).collect()
    cells = {}
    for r in docs.collect():
        cells.setdefault((r.lang or "none", r.lang, r.source), []).append((r.doc_id, r.text, len(helpers.SPACED.findall(r.text or ""))))
    quota = {k: int(v + 1e-6) for k, v in tree({k: sum(t for *_, t in v) for k, v in cells.items()}, 4000, {"domain": {"none": 3}}, 3).items()}
    want = []
    for cell, members in cells.items():
        total = sum(t for *_, t in members)
        whole = quota[cell] // total if total else 0
        rest = quota[cell] - whole * total

        def key(doc_id, text):
            digest = "" if text is None else hashlib.md5(text.encode()).hexdigest()
            return hashlib.md5(f"5:{whole}:{'' if doc_id is None else doc_id}:{digest}".encode()).hexdigest()

        for doc_id, text, tokens in members:
            upto = sum(t for i, x, t in members if key(i, x) <= key(doc_id, text))
            want += [(doc_id, e, tokens) for e in range(whole + (rest > 0 and upto <= rest))]
    assert sorted(((r.doc.doc_id, r.epoch, r.tokens) for r in out), key=str) == sorted(want, key=str)
    assert mix(docs, domain, share=1.0, epochs=1).count() > 0
    assert mix(docs.limit(0), domain, share=1.0).count() == 0 and mix(docs, domain, budget=0).count() == 0


def test_stages_keep_columns_and_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(1)).withColumn("doc", F.lit("x"))
    ids = {r.doc_id for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        else:
            assert out.columns == docs.columns + ["epoch", "tokens"]
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert {r.doc_id for r in out.collect()} <= ids, name
        docs = out
    assert docs.count() > 0


def test_pipeline_of_planted_rows(spark, tmp_path):
    """Toxic rows, a shared passage, copies and a benchmark passage go; clean rows come through the filters."""
    passage, leak = helpers.prose(901, 90, 3), " ".join(helpers.alnum(helpers.prose(902, 40)))
    rows = [(k, helpers.prose(k, 90)) for k in range(300)]
    rows += [(1000 + k, helpers.prose(5000 + k, 90).replace(" ", " vilest scumbag ", 4)) for k in range(150)]
    rows += [(2000 + k, helpers.prose(6000 + k, 60, 2) + "\n" + passage) for k in range(8)]
    rows += [(3000 + k, helpers.prose(7000, 30, 3).replace("\n", " ")) for k in range(5)] + [(4000, helpers.prose(7001, 60) + "\n" + leak), (5000, None), (5001, "")]
    docs = helpers.documents(spark, rows)
    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(1000 <= i < 2000)) for i, _ in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = {}
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert len([i for i in left["toxicity"] if 1000 <= i < 2000]) <= 3 and sum(i < 300 for i in left["toxicity"]) >= 298
    assert sum(passage in (t or "") for t in left["line_dedup"].values()) == 1
    assert sum(3000 <= i < 4000 for i in left["near_duplicates"]) == 1
    assert 4000 in left["near_duplicates"] and 4000 not in left["decontamination"]
    assert sum(i < 300 for i in left["decontamination"]) >= 298
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r.doc_id for r in final.collect()), key=str) == sorted((r.doc_id for r in docs.collect()), key=str)

