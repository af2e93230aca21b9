"""Line deduplication by content-defined chunks of lines.

A rolling hash runs over the hashes of lines. In every window of ``MIN_WORDS`` words a chunk begins where it is smallest,
and ends when it has ``CHUNK_WORDS`` words; the window's lines alone say where that is, so equal passages are cut alike
whatever stands around them, and a shared run of lines with ``MIN_WORDS`` words always holds a shared chunk. Chunks that
several documents have are anchors. They are stretched to both sides: all shortest runs of ``MIN_WORDS`` words that hold
an anchor are keyed by their own rolling hash, each occurrence is matched with the first one, runs in step are joined to
one passage, and passages are compared byte by byte with their first occurrence before they go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom.llm.store import map_arrow, small_side, stored
from siftloom.llm.words import SPACED, blocks, find_words, lines_of

#: Repeated passages of fewer words stay.
MIN_WORDS = 50
#: Words of a chunk, the number that its lines reach.
CHUNK_WORDS = 16

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Factors of the two rolling hashes, modulo 2^64; odd, so that they can be divided by.
_STEPS = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def run_bounds(words: np.ndarray, docs: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First line and line after the last one of the shortest runs of ``min_words`` from, and up to, every line.

    ``docs`` numbers the document of each line. Any run of lines with so many words is covered by such runs inside it.
    """
    n, least = len(words), max(1, min_words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    line = np.arange(n)
    high = np.searchsorted(total, total[:-1] + least, side="left")
    whole = (high <= n) & (docs[np.minimum(high, n) - 1] == docs)
    low = np.searchsorted(total, total[1:] - least, side="right") - 1
    back = (low >= 0) & (docs[np.maximum(low, 0)] == docs)
    pairs = np.concatenate([line[whole] * (n + 1) + high[whole], low[back] * (n + 1) + line[back] + 1])
    return tuple(np.divmod(np.unique(pairs), n + 1))


def _powers(step: int, n: int) -> np.ndarray:
    """``step`` to the powers 0 .. n, modulo 2^64."""
    out = np.full(n + 1, step, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def least_in(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where the smallest of ``values[low:high]`` is, for each of many ranges, none empty: two spans of a power of two each."""
    out = np.zeros(len(low), np.int64)
    level = np.frexp((high - low).astype(np.float64))[1] - 1
    at, size = np.arange(len(values)), 1
    for k in range(int(level.max(initial=-1)) + 1):
        q = np.flatnonzero(level == k)
        a, b = at[low[q]], at[high[q] - size]
        out[q] = np.where(values[a] <= values[b], a, b)
        at = np.where(values[at[:-size]] <= values[at[size:]], at[:-size], at[size:])
        size *= 2
    return out


class Chunks:
    """Runs of lines of the documents of a block, each with two 64-bit keys, and the chunk that each run holds."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, min_words: int):
        first, docs, start, end = lines_of(data, offsets)
        n = len(docs)
        words = find_words(data, offsets, SPACED).starts
        words = np.searchsorted(words, end) - np.searchsorted(words, start)
        self.low, self.high = run_bounds(words, docs, min_words)
        raw, h = data.tobytes(), xxhash.xxh3_128_digest
        hashes = np.frombuffer(b"".join([h(raw[a:b]) for a, b in zip(start.tolist(), end.tolist())]), np.uint64).reshape(n, 2)
        # Chunks that would reach into the next document end behind all runs of their own, so no run holds them.
        total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
        ends = np.searchsorted(total, total[:-1] + max(1, min(CHUNK_WORDS, min_words)), side="left")
        begins = np.flatnonzero(ends <= n)
        self.keys, chunk_keys = [], []
        for j, step in enumerate(_STEPS):
            power, back = _powers(step, n), _powers(pow(step, -1, 1 << 64), n)
            upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes[:, j] * power[:-1], dtype=np.uint64)])
            self.keys.append(((upto[self.high] - upto[self.low]) * back[self.low]).view(np.int64))
            chunk_keys.append(((upto[ends[begins]] - upto[begins]) * back[begins]).view(np.int64))
        self.doc = docs[self.low]
        self.line = self.low - first[self.doc]
        # Every run holds the window that begins with it, and so that window's chunk.
        window = np.searchsorted(total, total[self.low] + max(1, min_words), side="left")
        self.chunk = least_in(chunk_keys[0], self.low, np.searchsorted(ends[begins], window, side="right"))
        self.chunk_keys = [k[self.chunk] for k in chunk_keys]


def _run(min_words: int, placed: bool):
    """Keys of all chunks with their document, or of all runs with their chunk and their place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, "text"):
            chunks = Chunks(data, offsets, min_words)
            pick = slice(None) if placed else np.unique(chunks.chunk, return_index=True)[1]
            of = pa.array(chunks.doc[pick])
            out = {"chunk_hi": pa.array(chunks.chunk_keys[0][pick]), "chunk_lo": pa.array(chunks.chunk_keys[1][pick])}
            out |= {c: rows.column(rows.schema.get_field_index(c)).take(of) for c in (("id", "row") if placed else ("who",))}
            if placed:
                out |= {"hi": pa.array(chunks.keys[0]), "lo": pa.array(chunks.keys[1]), "line": pa.array(chunks.line.astype(np.int32)),
                        "lines": pa.array((chunks.high - chunks.low).astype(np.int32))}
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))
    return run


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a document in step with the same first document, joined where they overlap or touch."""
    for batch in batches:
        of, low, high = [], [], []
        for i, chunks in enumerate(batch.column(batch.schema.get_field_index("chunks")).to_pylist()):
            end = -1
            for a, b in sorted((c["line"], c["line"] + c["lines"]) for c in chunks):
                if a > end:
                    of.append(i)
                    low.append(a)
                    high.append(b)
                end = high[-1] = max(high[-1], b)
        kept = batch.select(["id", "row", "first_id", "first_row"]).take(pa.array(of, pa.int64()))
        shift = batch.column(batch.schema.get_field_index("shift")).to_numpy()[np.array(of, np.int64)]
        low, high = np.array(low, np.int32), np.array(high, np.int32)
        yield pa.RecordBatch.from_arrays([*kept.columns, *map(pa.array, (low, high, (low - shift).astype(np.int32)))],
                                         ["id", "row", "first_id", "first_row", "a", "b", "first_a"])


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted ranges of lines."""
    for rows, data, offsets in blocks(batches, "text"):
        first, _, start, end = lines_of(data, offsets)
        raw = data.tobytes()
        wanted = rows.column(rows.schema.get_field_index("wanted"))
        flat = wanted.flatten()
        low, high = flat.field("a").to_numpy(), flat.field("b").to_numpy()
        of = np.repeat(np.arange(rows.num_rows), np.diff(wanted.offsets.to_numpy()))
        bodies = [raw[x:y] for x, y in zip(start[first[of] + low].tolist(), end[first[of] + high - 1].tolist())]
        keys = [rows.column(rows.schema.get_field_index(c)).take(pa.array(of)) for c in ("id", "row")]
        yield pa.RecordBatch.from_arrays([*keys, flat, pa.array(bodies, pa.binary())], ["id", "row", "range", "body"])


def repeated_ranges(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Columns ``id``, ``row`` (hash of the text) and ``ranges`` of lines [a, b) that repeat an earlier occurrence.

    The first occurrence is the one with the smallest document id (null last), text hash and line.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    def several(df: DataFrame, hi: str, lo: str) -> DataFrame:
        return stored(df.groupBy(hi, lo).agg(F.min("who").alias("a"), F.max("who").alias("b")).where("a != b").select(hi, lo))

    # Most chunks occur once, and that takes three numbers a chunk to see; runs are looked at around the others only.
    keys = map_arrow(documents.select(F.xxhash64("doc_id", "text").alias("who"), "text"), _run(min_words, False),
                     "chunk_hi bigint, chunk_lo bigint, who bigint")
    anchors = several(keys, "chunk_hi", "chunk_lo")
    docs = documents.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("row"), "text")
    places = map_arrow(docs, _run(min_words, True), f"chunk_hi bigint, chunk_lo bigint, id {kind}, row bigint, hi bigint, lo bigint, line int, lines int")
    near = stored(places.join(small_side(anchors), ["chunk_hi", "chunk_lo"]).drop("chunk_hi", "chunk_lo"))
    shared = several(near.select("hi", "lo", F.xxhash64("id", "row").alias("who")), "hi", "lo")
    found = stored(near.join(small_side(shared), ["hi", "lo"]))
    place = F.struct(F.col("id").isNull().alias("none"), *[F.col(c).alias(c) for c in ("id", "row", "line")])
    firsts = stored(found.groupBy("hi", "lo").agg(F.min(place).alias("first")).select(
        "hi", "lo", *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("id", "row", "line")]))
    same = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("row") == F.col("first_row"))
    # In its own document, a repeat that overlaps the first occurrence is part of it.
    repeats = found.join(small_side(firsts), ["hi", "lo"]).where(~same | (F.col("line") >= F.col("first_line") + F.col("lines")))
    groups = repeats.groupBy("id", "row", "first_id", "first_row", (F.col("line") - F.col("first_line")).alias("shift")) \
        .agg(F.collect_set(F.struct("line", "lines")).alias("chunks"))
    passages = stored(map_arrow(groups, _passages, f"id {kind}, row bigint, first_id {kind}, first_row bigint, a int, b int, first_a int"))
    # The byte comparison: a passage whose bytes differ from those of the first one stays.
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (("first_id", kind), ("first_row", "bigint"), ("first_a", "int"))}
    first_b = F.col("first_a") + F.col("b") - F.col("a")
    firsts = passages.select(F.col("first_id").alias("id"), F.col("first_row").alias("row"), F.col("first_a").alias("a"), first_b.alias("b")).distinct()
    fields = ["a", "b", "first_id", "first_row", "first_a"]
    wanted = passages.select("id", "row", *fields).unionByName(firsts.select("id", "row", "a", "b", *none.values())) \
        .groupBy("id", "row").agg(F.collect_set(F.struct(*fields)).alias("wanted"))
    side = small_side(stored(wanted), cells=F.size("wanted") + 1)
    joined = docs.join(side, docs["id"].eqNullSafe(side["id"]) & (docs["row"] == side["row"])).select(docs["*"], "wanted")
    bodies = stored(map_arrow(joined, _bodies, f"id {kind}, row bigint, range struct<a int, b int, first_id {kind}, first_row bigint, first_a int>, body binary"))
    first = bodies.where("range.first_row is null").select(
        F.col("id").alias("of_id"), F.col("row").alias("of_row"), F.col("range.a").alias("of_a"), F.col("range.b").alias("of_b"),
        F.col("body").alias("first_body")).dropDuplicates(["of_id", "of_row", "of_a", "of_b"])
    repeats = bodies.where("range.first_row is not null").select("id", "row", "body", "range.*")
    both = repeats.join(first, F.col("first_id").eqNullSafe(F.col("of_id")) & (F.col("first_row") == F.col("of_row"))
                        & (F.col("first_a") == F.col("of_a")) & (first_b == F.col("of_b"))).where("body = first_body")
    return both.groupBy("id", "row").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))


def _without(text: str, ranges: list[dict], min_words: int) -> tuple[str, int, int]:
    """The text without the passages of ``min_words`` or more, and the lines and words taken out."""
    lines = text.split("\n")
    repeated = [False] * len(lines)
    for r in ranges:
        repeated[r["a"]:r["b"]] = [True] * (r["b"] - r["a"])
    out, passage, gone, words = [], [], 0, 0
    for line, again in zip([*lines, ""], [*repeated, False]):
        if again:
            passage.append(line)
            continue
        n = sum(len(_WORD.findall(x)) for x in passage)
        if n < min_words:
            out += passage
        else:
            gone, words = gone + len(passage), words + n
        passage = []
        out.append(line)
    return "\n".join(out[:-1]), gone, words


def without_repeated_chunks(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: ``doc`` (the input row), ``text`` (without repeated passages), ``removed_lines``,
    ``removed_words``.

    A passage is a run of lines with ``min_words`` words or more that an earlier document has too (or, if several
    documents have it, that stands earlier in the same one); all such runs go, and nothing else. Rows with equal id and
    text count as one document and are treated alike. A null text stays null; empty texts and texts without repeated
    passages stay as they are; a text that was one repeated passage becomes empty. An empty table gives no rows.
    """
    ranges = stored(repeated_ranges(documents, min_words))
    side = small_side(ranges, cells=F.size("ranges") + 1)
    docs = documents.select(F.struct("*").alias("doc"), F.col("doc_id").alias("key"), F.xxhash64("text").alias("hash"), F.col("text").alias("text"))
    joined = docs.join(side, docs["key"].eqNullSafe(side["id"]) & (docs["hash"] == side["row"]), "left").select("doc", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in blocks(batches, "text"):
            doc, text, marked = batch.columns
            n = len(text)
            lines, words = np.zeros(n, np.int64), np.zeros(n, np.int64)
            at = np.flatnonzero(marked.is_valid().to_numpy(zero_copy_only=False))
            if len(at):
                new = text.to_pylist()
                for i, ranges in zip(at.tolist(), marked.take(pa.array(at)).to_pylist()):
                    new[i], lines[i], words[i] = _without(new[i], ranges, min_words)
                text = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays([doc, text, pa.array(lines), pa.array(words)], ["doc", "text", "removed_lines", "removed_words"])

    shape = joined.select("doc", "text", F.lit(0).cast("bigint").alias("removed_lines"), F.lit(0).cast("bigint").alias("removed_words")).schema
    return map_arrow(joined, run, shape)


def drop_repeated_chunks(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with repeated passages cut out of ``text``, other columns as they were; ``n_chars`` follows the
    text if it is there. A document that held nothing else goes, as its text stands elsewhere; empty ones stay."""
    new = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text").cast(dict(documents.dtypes).get("n_chars", "bigint")), F.col("doc.n_chars"))
           if "n_chars" in documents.columns else None}
    cut = without_repeated_chunks(documents, min_words).where((F.col("removed_lines") == 0) | F.col("text").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return cut.select(*[(F.when(F.col("removed_lines") > 0, new[c]).otherwise(F.col(f"doc.{c}")).alias(c) if c in new
                         else F.col("doc").getField(c).alias(c)) for c in documents.columns])
