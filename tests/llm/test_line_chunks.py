"""``op6_line_chunks`` against brute force: all runs of equal lines against all earlier documents."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from siftloom.llm.line_chunks import MIN_WORDS, Chunks, drop_repeated_chunks, least_in, without_repeated_chunks
from siftloom.llm.queries import op6_line_chunks

from . import helpers


def brute_force(rows, min_words=MIN_WORDS):
    """{doc_id: (text, removed lines, removed words)} of (doc_id, text) with distinct ids."""
    out, docs = {}, [(i, (t or "").split("\n")) for i, t in sorted(rows)]
    for k, (doc_id, lines) in enumerate(docs):
        count = [len(helpers.SPACED.findall(x)) for x in lines]
        gone = set()
        for _, before in docs[:k]:
            for shift in range(-len(before) + 1, len(lines)):
                run = []
                for i in range(len(lines) + 1):
                    if i < len(lines) and 0 <= i - shift < len(before) and lines[i] == before[i - shift]:
                        run.append(i)
                        continue
                    gone |= set(run) if sum(count[j] for j in run) >= min_words else set()
                    run = []
        out[doc_id] = ("\n".join(x for j, x in enumerate(lines) if j not in gone), len(gone), sum(count[j] for j in gone))
    return out


def result(df):
    return {r.doc_id: (r.text, r.removed_lines, r.removed_words) for r in df.collect()}


def line(words, seed):
    return " ".join(helpers.alnum(helpers.prose(seed, 2 * words))[:words])


def passages_in_context(seed, docs=60):
    """Documents of passages of short lines, of single lines that many documents have, of blank lines and of their own lines."""
    rnd = random.Random(seed)
    shapes = [(4, 14), (5, 12), (6, 10), (7, 12), (8, 8), (3, 20), (1, 60), (10, 5), (2, 24), (7, 7)]
    passages = [[line(n, 10_000 + 100 * p + j) for j in range(k)] for p, (k, n) in enumerate(shapes * 2)]
    frequent = [line(n, 20_000 + n) for n in (3, 9, 15, 16, 28, 40)]
    rows = []
    for d in range(docs):
        lines = []
        for part in range(rnd.randint(2, 6)):
            p = rnd.choice(passages)
            a, b = sorted(rnd.sample(range(len(p) + 1), 2))
            lines += rnd.choice([p, p, p[a:b], [rnd.choice(frequent)], [rnd.choice(frequent), *p], ["", "  "],
                                 [line(rnd.randint(1, 30), 30_000 + 100 * d + part)]])
        rows.append((d, "\n".join(lines)))
    return rows


def twice(text):
    """Whether the text has a passage twice."""
    lines = text.split("\n")
    for shift in range(1, len(lines)):
        n = 0
        for a, b in zip(lines, lines[shift:]):
            n = n + len(helpers.SPACED.findall(a)) if a == b else 0
            if n >= MIN_WORDS:
                return True
    return False


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_brute_force(spark, tmp_path, seed):
    # Repeats within one document have a test of their own.
    rows = [(i, t) for i, t in passages_in_context(seed) if not twice(t)]
    assert len(rows) > 30
    helpers.documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    assert result(op6_line_chunks(spark, str(tmp_path))) == brute_force(rows)


@pytest.mark.parametrize("lines, words", [(4, 14), (5, 12), (6, 10), (7, 12), (8, 8)])
def test_every_passage_of_short_lines_goes(spark, lines, words):
    rows, shared = [], {}
    for k in range(24):
        shared[k] = "\n".join(line(words, 40_000 + 100 * k + j) for j in range(lines))
        rows += [(10 * k + j, f"{line(30, 50_000 + 10 * k + j)}\n{shared[k]}\n{line(9, 60_000 + 10 * k + j)}") for j in range(2)]
    out = result(without_repeated_chunks(helpers.documents(spark, rows)).select("doc.doc_id", "text", "removed_lines", "removed_words"))
    assert [out[10 * k + 1][2] for k in range(24)] == [lines * words] * 24
    assert all(shared[k] in out[10 * k][0] for k in range(24))


def test_a_line_in_an_earlier_document_hides_no_passage(spark):
    rows = []
    for k in range(24):
        middle = line(28, 70_000 + k)
        shared = f"{line(13, 71_000 + k)}\n{middle}\n{line(12, 72_000 + k)}"
        rows += [(10 * k, f"{line(10, 73_000 + k)}\n{middle}\n{line(10, 74_000 + k)}")]
        rows += [(10 * k + j, f"{line(10, 75_000 + 10 * k + j)}\n{shared}\n{line(10, 76_000 + 10 * k + j)}") for j in (1, 2)]
    out = result(without_repeated_chunks(helpers.documents(spark, rows)).select("doc.doc_id", "text", "removed_lines", "removed_words"))
    assert [out[10 * k + 2][2] for k in range(24)] == [53] * 24
    assert all(out[10 * k + j][1] == 0 for k in range(24) for j in (0, 1))


def test_repeats_within_a_document(spark):
    """What several documents have goes from the second time on in the first one too; its first occurrence stays whole."""
    shared = "\n".join(line(12, 80_000 + j) for j in range(5))
    rows = [(1, f"{shared}\nown line\n{shared}"), (2, shared), (3, "\n".join(["a b c"] * 40)), (4, "\n".join(["a b c"] * 40)), (5, f"x\n{line(60, 81_000)}\ny\n{line(60, 81_000)}")]
    out = result(without_repeated_chunks(helpers.documents(spark, rows)).select("doc.doc_id", "text", "removed_lines", "removed_words"))
    assert out[1] == (f"{shared}\nown line", 5, 60) and out[2] == ("", 5, 60)
    assert out[3][0] == "\n".join(["a b c"] * 17) and out[4][0] == "" and out[5][1] == 0


def test_lines_that_repeat_apart_stay(spark):
    """Two passages of fewer words each, from two documents, do not become one."""
    a, b = line(30, 90_001), line(30, 90_002)
    rows = [(1, f"one\n{a}\ntwo"), (2, f"three\n{b}\nfour"), (3, f"five\n{a}\n{b}\nsix")]
    out = without_repeated_chunks(helpers.documents(spark, rows)).where(F.col("removed_lines") > 0)
    assert out.count() == 0


def test_chunks_begin_where_the_rolling_hash_is_smallest():
    import numpy as np

    rnd = np.random.default_rng(3)
    values = rnd.integers(0, 50, 300)
    low = np.sort(rnd.integers(0, 299, 200))
    high = np.minimum(low + rnd.integers(1, 90, 200), 300)
    assert [values[i] for i in least_in(values, low, high)] == [values[a:b].min() for a, b in zip(low, high)]
    # Equal passages are cut alike whatever stands around them, and the runs of fewer than half of the lines begin a chunk.
    shared = "\n".join(line(6, 95_000 + j) for j in range(200))
    cut = []
    for before in ("", line(9, 96_000) + "\n", "\n".join(line(11, 96_100 + j) for j in range(30)) + "\n"):
        data = np.frombuffer((before + shared).encode(), np.uint8)
        chunks = Chunks(data, np.array([0, len(data)]), MIN_WORDS)
        skip = before.count("\n")
        inner = chunks.low >= skip
        cut.append({(int(c) - skip, int(k)) for c, k in zip(chunks.chunk[inner], chunks.chunk_keys[0][inner])})
        assert 5 < len(cut[-1]) < 100
    assert cut[0] == cut[1] == cut[2]


def test_repeats_of_one_kind_of_line_and_leftover_blanks(spark):
    """Inner repeats are brute-forced too where no other document has them."""
    rows = [(i, t) for i, t in passages_in_context(7, 30) if twice(t)]
    one = [(i, f"{t}\n{line(70, 97_000 + i)}") for i, t in rows[:1]]
    out = result(without_repeated_chunks(helpers.documents(spark, one)).select("doc.doc_id", "text", "removed_lines", "removed_words"))
    assert all(out[i][1] == 0 for i, _ in one)
    body = line(60, 98_000)
    kept = drop_repeated_chunks(helpers.documents(spark, [(1, body), (2, f"\t\n{body}\n \r\n"), (3, " \n\t")]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
