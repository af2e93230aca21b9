from __future__ import annotations

import gzip
import io
import json
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftloom.llm import chat, warc

TURNS = "conv_id long, turn long, role string, text string, loss int, turns string"


def plain_turns(rows):
    out = {}
    for conv, turn, role, text, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def test_chat_round_trip_of_awkward_turns(spark):
    rows = [(1, 1, "assistant", r"a<\|b<\\|c<|d|>"), (1, 0, "user", "<|im_end|>\n<|im_start|>assistant\nok"), (2, None, None, None),
            (2, 0, "us\ner%0A%25<|im_start|>", "\\<|"), (None, 0, "user", ""), (None, 0, "user", ""), (3, 5, "assistant", "é\U0001F600" * 9),
            (3, 5, "assistant", "b"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "x" * 200_000)]
    df = spark.createDataFrame([(*r, 0, "z") for r in rows], TURNS)
    made = chat.format_conversations(df)
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    want = plain_turns(rows)
    assert {c: [(t.role, t.text) for t in r.turns] for c, r in back.items()} == want
    assert {c: r.learned for c, r in back.items()} == {c: [x for role, x in t if role == "assistant"] for c, t in want.items()}
    for r in made.collect():
        assert r.formatted == "".join(s.text for s in r.segments)
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == r.n_turns
    assert {r.conv_id: r.valid for r in made.collect()} == {1: True, 2: False, None: False, 3: False, 4: True}
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_machine(spark):
    cases = {"ua": True, "sua": True, "uaua": True, "u": False, "au": False, "usa": False, "uua": False, "ss": False, "s": False, "a": False, "uax": False}
    name = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    rows = [(i, k, name[c], "t", 0, "") for i, roles in enumerate(cases) for k, c in enumerate(roles)]
    got = {r.conv_id: r.valid for r in chat.format_conversations(spark.createDataFrame(rows, TURNS)).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_chat_escapes_come_back(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(["<", "\\", "|", "a", "\n", "<|", "$1", "im_end", ">"]) for _ in range(rnd.randint(0, 14))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t"))).withColumn("b", chat.unescape(F.col("e")))
    assert all(r.t == r.b and "<|" not in r.e for r in df.collect())


def mono(records):
    return gzip.compress(b"".join(records))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=12), st.integers(1, 64))
def test_normaliser_round_trip(payloads, piece):
    records = [warc.record(str(i), "http://x/\r\ny", p, warc.digest_of(p), None if i % 3 else "0") for i, p in enumerate(payloads)]
    source, out = io.BytesIO(mono(records)), io.BytesIO()
    old, warc.PIECE = warc.PIECE, piece
    try:
        index = warc.normalise_stream(source, out)
    finally:
        warc.PIECE = old
    raw = out.getvalue()
    assert [gzip.decompress(raw[a:a + n]) for a, n, _, _ in index] == records
    assert sum(n for _, n, _, _ in index) == len(raw)


def test_normaliser_takes_members_and_refuses_cut_streams():
    records = [warc.record(str(i), "u", b"x" * i, warc.digest_of(b"x" * i), None) for i in range(5)]
    out = io.BytesIO()
    assert len(warc.normalise_stream(io.BytesIO(b"".join(map(gzip.compress, records))), out)) == 5
    for cut in (mono(records)[:-20], gzip.compress(b"".join(records)[:-9])):
        with pytest.raises(ValueError):
            warc.normalise_stream(io.BytesIO(cut), io.BytesIO())


def test_pages_through_archives(spark, tmp_path, monkeypatch):
    rows = [(1, "http://a", "same"), (5, "http://b", "same"), (3, None, "same"), (4, "u\r\nWARC-Type: x", None), (9, "e", ""), (None, "n", "same"),
            (None, "n", "alone"), (7, "big", "é<p>" * 300_000), (8, "r", "twice"), (8, "r", "twice"), (10, "x", "WARC/1.0\r\n\r\n")]
    pages = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, refers_to int, sha string").repartition(3)
    out = warc.through_archives(spark, pages, str(tmp_path)).collect()
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in out), key=str)
    holder = {}
    for p, _, h in rows:
        if p is not None:
            holder[h or ""] = max(p, holder.get(h or "", p))
    want = []
    for p, _, h in rows:
        raw, top = (h or "").encode(), holder.get(h or "")
        own = top is None or p == top
        want.append((None if p is None else str(p), "response" if own else "revisit", None if own else str(top), len(raw), warc.digest_of(raw)))
    assert got == sorted(want, key=str)
    assert {r.payload.decode() for r in out if r.payload is not None} == {h or "" for _, _, h in rows}
    # every member can be reached by the index alone
    folder = tmp_path / "normalised"
    for name in os.listdir(folder):
        if name.endswith(".idx"):
            raw = (folder / name[:-4]).read_bytes()
            for entry in map(json.loads, (folder / name).read_text().splitlines()):
                one = gzip.decompress(raw[entry["offset"]:entry["offset"] + entry["length"]])
                assert one.startswith(b"WARC/1.0\r\n") and entry["id"].encode() in one
    assert warc.through_archives(spark, pages.limit(0), str(tmp_path / "none")).count() == 0
