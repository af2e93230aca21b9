from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftloom.llm.components import components
from siftloom.llm.decontaminate import contamination, decontaminate, suffix_array
from siftloom.llm.line_chunks import MIN_WORDS, drop_repeated_chunks, without_repeated_chunks
from siftloom.llm.simhash_trie import drop_near_duplicates, near_components, simhash_groups, trie_links

from . import helpers

SF = "/root/testdata/sf0.001"


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, items, **kw):
    rows = contamination(docs, items, **kw).select("doc.doc_id", "n_words", "spans", "matches").collect()
    return sorted(((r.doc_id, r.n_words, sum(s["last"] - s["first"] + 1 for s in r.spans),
                    sorted({m.item_id for m in r.matches if m.item_id is not None})) for r in rows), key=str)


def test_suffix_array_sorts_suffixes():
    rnd = np.random.default_rng(1)
    ids = rnd.integers(0, 4, 400).astype(np.int64)
    order, _ = suffix_array(ids, 400)
    suffix = [tuple(ids[i:]) for i in order]
    assert suffix == sorted(suffix) and sorted(order) == list(range(400))


def test_contamination_equals_brute_force(spark):
    base, other = helpers.alnum(helpers.prose(1, 120)), helpers.alnum(helpers.prose(5, 30_000, 900))
    items = [(1, " ".join(base[5:30])), (2, " ".join(base[5:30])), (2, " ".join(base[5:30])), (3, "AB cd-EF"), (4, None), (5, "..."),
             (6, " ".join(other[20_000:20_060])), (7, "a b c a b c a b c a b c"), (None, " ".join(base[40:52])), (8, "nothing of this is anywhere at all in any text"),
             (10, "x")]
    rows = helpers.awkward()
    want = sorted(helpers.contamination(rows, items), key=str)
    docs = helpers.documents(spark, rows)
    assert found(docs, bench(spark, items)) == want
    # a benchmark larger than one block takes several rounds
    assert found(docs, bench(spark, items), benchmark_bytes=200) == want
    kept = decontaminate(docs, bench(spark, items))
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 for w in want if not w[2])


def test_longest_matches(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = helpers.documents(spark, [(1, "zero " + text + " fourteen"), (2, "one two three")], clash=False)
    rows = {r.doc_id: r.matches for r in contamination(docs, bench(spark, [(9, "pre " + text + " post")])).select("doc.doc_id", "matches").collect()}
    assert [tuple(m) for m in rows[1]] == [("9", 1, 1, 13)] and rows[2] == []


def test_contamination_of_empty_tables(spark):
    docs = helpers.documents(spark, helpers.awkward())
    assert all(not r.spans for r in contamination(docs, bench(spark, [])).collect())
    assert contamination(docs.limit(0), bench(spark, [(1, "a b")])).count() == 0


def brute_groups(rows):
    prints = [helpers.simhash(t) for _, t in rows]
    of = helpers.groups(prints)
    least = {}
    for (i, _), g in zip(rows, of):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted(((i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, of)), key=str), of


def test_simhash_equals_brute_force(spark):
    rows = helpers.awkward()
    want, of = brute_groups(rows)
    docs = helpers.documents(spark, rows)
    got = simhash_groups(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(of))
    again = drop_near_duplicates(docs.union(docs))
    assert again.count() == len(set(of))
    assert simhash_groups(docs.limit(0)).count() == 0 and drop_near_duplicates(docs.limit(0)).count() == 0


def test_simhash_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = simhash_groups(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_groups(rows)[0]


@pytest.mark.parametrize("part", [4, 8192])
def test_trie_join_of_a_crowd(spark, part):
    """Many fingerprints around one centre and chains between them; small parts force the split of subtrees."""
    rnd = np.random.default_rng(5)
    centre = int(rnd.integers(1 << 63))
    prints = {centre ^ int(sum(1 << int(b) for b in rnd.choice(64, int(rnd.integers(0, 12)), replace=False))) for _ in range(150)}
    prints |= {int(x) for x in rnd.integers(0, 1 << 63, 60)}
    prints = sorted(prints)
    want = {}
    for p, g in zip(prints, helpers.groups(prints)):
        want.setdefault(g, set()).add(p)
    table = spark.createDataFrame([(p - (1 << 64) if p >= 1 << 63 else p, i) for i, p in enumerate(prints)], "fp long, doc_id long")
    got = {}
    for r in near_components(table, part).collect():
        got.setdefault(r.component_id, set()).add(r.fp % (1 << 64))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_trie_links_prune_nothing_near():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 1 << 62, 40).astype(np.uint64)
    flips = np.array([np.bitwise_xor.reduce(np.uint64(1) << rnd.choice(40, k, replace=False).astype(np.uint64)) for k in rnd.integers(1, 7, 40)], np.uint64)
    leaf = np.unique(np.concatenate([base, base ^ flips]))
    label = trie_links(leaf, np.array([0]), np.array([len(leaf)]), 0)
    want = helpers.groups([int(x) for x in leaf])
    assert label.tolist() == want


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 40)] + [(7, 7), (2, 1), (2, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(51)} | {1000 + i: 1000 for i in range(40)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def passage(seed):
    return helpers.prose(seed, 90, 3)


def test_repeated_passages_go_and_the_first_stays(spark):
    shared = passage(77)
    rows = [(k, helpers.prose(100 + k, 70, 3) + "\n" + shared + "\n" + helpers.prose(200 + k, 50, 2)) for k in range(6)]
    rows += [(20, helpers.prose(300, 80)), (21, shared), (22, "short\nlines\nhere"), (23, "short\nlines\nhere")]
    out = {r.doc_id: r for r in without_repeated_chunks(helpers.documents(spark, rows)).select("doc.doc_id", "text", "removed_lines", "removed_words").collect()}
    assert shared in out[0].text and out[0].removed_lines == 0
    for k in range(1, 6):
        assert out[k].text == helpers.prose(100 + k, 70, 3) + "\n" + helpers.prose(200 + k, 50, 2)
        assert out[k].removed_words == len(shared.split())
    assert out[20].text == rows[6][1] and out[21].text == "" and out[22].text == out[23].text == "short\nlines\nhere"
    kept = drop_repeated_chunks(helpers.documents(spark, rows))
    assert kept.where("doc_id = 21").count() == 0 and kept.count() == len(rows) - 1
    assert kept.where("n_chars != length(text)").count() == 0


def test_a_long_single_line_counts_as_a_passage(spark):
    line = " ".join(helpers.alnum(helpers.prose(9, MIN_WORDS + 5)))
    rows = [(k, helpers.prose(400 + k, 60, 2) + "\n" + line + "\n" + helpers.prose(500 + k, 60, 2)) for k in range(3)]
    out = {r.doc_id: r.text for r in without_repeated_chunks(helpers.documents(spark, rows)).select("doc.doc_id", "text").collect()}
    assert [line in out[k] for k in range(3)] == [True, False, False]


def test_line_chunks_of_awkward_rows(spark):
    rows = helpers.awkward()
    docs = helpers.documents(spark, rows)
    out = without_repeated_chunks(docs)
    assert out.count() == len(rows)
    texts = [(r.doc_id, r.old, r.text) for r in out.select("doc.doc_id", F.col("doc.text").alias("old"), "text").collect()]
    assert sum(t is None for _, _, t in texts) == 1
    # every word of the input is still somewhere, and unrepeated texts are untouched
    assert {w for _, o, _ in texts for w in (o or "").split()} == {w for _, _, t in texts for w in (t or "").split()}
    assert all(o == t for i, o, t in texts if i in (1, 4, 5, 6, 8, 9, 10, 11, 13, 14, 15))
    assert [t for i, _, t in texts if i == 7 and t == helpers.prose(3, 80)] == [helpers.prose(3, 80)] * 2  # equal rows are one document
    assert drop_repeated_chunks(docs).columns == docs.columns
    assert without_repeated_chunks(docs.limit(0)).count() == 0


def test_passages_of_short_lines(spark):
    found = 0
    for k in range(12):
        words = helpers.alnum(helpers.prose(800 + k, 84))
        shared = "\n".join(" ".join(words[i:i + 12]) for i in range(0, 84, 12))
        rows = [(j, helpers.prose(1000 + 10 * k + j, 40, 5) + "\n" + shared + "\n" + helpers.prose(2000 + 10 * k + j, 40, 5)) for j in range(3)]
        out = {r.doc_id: r for r in without_repeated_chunks(helpers.documents(spark, rows)).select("doc.doc_id", "text", "removed_words").collect()}
        assert shared in out[0].text and all(helpers.prose(1000 + 10 * k + j, 40, 5) in out[j].text for j in range(3))
        found += sum(out[j].removed_words == 84 for j in (1, 2))
    assert found >= 18


def test_long_copies_take_time_in_proportion():
    """A copied item of 100,000 words is followed to its end, once."""
    import time

    from siftloom.llm.decontaminate import Benchmark, _shard

    words = " ".join(f"w{i * 7919 % 50_021}" for i in range(100_000))
    data = np.frombuffer(f"ahead {words} behind".encode(), np.uint8)
    start = time.time()
    counts, spans, matches = _shard(Benchmark([("1", f"before {words} after")], 10), data, np.array([0, len(data)]), None)
    assert time.time() - start < 30  # seconds rather than minutes, also on a busy machine
    assert counts.tolist() == [100_002] and spans.to_pylist() == [[{"first": 1, "last": 100_000}]]
    assert matches.to_pylist() == [[{"item_id": "1", "item_word": 1, "doc_word": 1, "words": 100_000}]]


def test_a_shard_takes_little_memory_beside_its_suffix_array():
    """Temporary arrays go as soon as they have been used; this shard took 103 bytes per word when they did not."""
    import tracemalloc

    from siftloom.llm.decontaminate import Benchmark, _shard

    random = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in random.integers(0, 20_000, 400)) for _ in range(500)]
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    bench = Benchmark([("1", " ".join(texts[7].split()[50:90]))], 10)
    tracemalloc.start()
    try:
        counts, spans, _ = _shard(bench, data, offsets, None)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert counts.sum() == 200_000 and spans.to_pylist()[7] == [{"first": 50, "last": 89}]
    assert most < 80 * counts.sum()
