"""Benchmark decontamination with suffix arrays over the training text.

Every task cuts its documents into shards of a few MB, builds the suffix array of a shard's words, and searches every
suffix of every benchmark item in it by bisection. The interval at window length gives all verbatim occurrences; each
that cannot be continued to the left is followed to the right, to the longest match. Nothing is shuffled, a shard is
dropped once searched, and a lost task is simply run again. The benchmark is the stated query set: it lies in files of
bounded size in the shared folder, and tasks read one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.llm.store import map_arrow, shared_folder
from siftloom.llm.warc import _files as files_of
from siftloom.llm.words import ALNUM, bits_for, blocks, find_words

WINDOW = 10
SHARD_BYTES = 4_000_000
#: Benchmark text in a file; a task holds that of one file at a time.
BENCHMARK_BYTES = 16_000_000
PAIRS = 1_000_000
#: Words of all growing matches that are compared at once, and of one match.
GROWTH, STRIDE = 1_000_000, 4_096

SPANS = "array<struct<first:bigint,last:bigint>>"
MATCHES = "array<struct<item_id:string,item_word:bigint,doc_word:bigint,words:bigint>>"


def suffix_array(ids: np.ndarray, depth: int) -> tuple[np.ndarray, int]:
    """Positions of ``ids`` (0 separates texts) in the order of their first ``depth`` or more words."""
    n = len(ids)
    bits = bits_for(int(ids.max()) + 1) if n else 1
    known = max(1, 62 // bits)
    padded = np.concatenate([ids, np.zeros(known, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(known):
        key <<= bits
        key |= padded[j:j + n]
    del padded
    order = np.argsort(key)
    new, key = np.ones(n, bool), key[order]
    new[1:] = key[1:] != key[:-1]
    del key
    while known < depth:
        # Only ranges of equal suffixes are sorted again, by the rank of what follows the known words.
        alone = new.copy()
        alone[:-1] &= new[1:]
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank = np.zeros(n + 1, np.int64)
        rank[order] = head + 1
        at = order[open_]
        both = head[open_] << 32
        del head, alone
        both |= rank[np.minimum(at + known, n)]
        del rank
        turn = np.argsort(both)
        order[open_] = at[turn]
        both = both[turn]
        new[open_[1:]] |= both[1:] != both[:-1]
        known *= 2
    return order, known


def _bisect(ids: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray) -> np.ndarray:
    """First place in each interval whose word at ``depth`` is not below ``word``."""
    low, high = low.copy(), high.copy()
    last = len(ids) - 1
    while True:
        active = np.flatnonzero(low < high)
        if not len(active):
            return low
        middle = (low[active] + high[active]) >> 1
        below = ids[np.minimum(order[middle] + depth, last)] < word[active]
        low[active] = np.where(below, middle + 1, low[active])
        high[active] = np.where(below, high[active], middle)


def search(ids: np.ndarray, order: np.ndarray, query: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bisect the suffixes of ``query`` at ``at``: their intervals at ``lengths`` words, empty if none."""
    n = len(at)
    low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    head = ids[order]
    left = np.searchsorted(head, query[at])
    right = np.searchsorted(head, query[at], side="right")
    active, depth = np.arange(n), 0
    while len(active):
        keep = (left < right) & (query[at[active] + depth] > 0)
        active, left, right = active[keep], left[keep], right[keep]
        depth += 1
        full = lengths[active] == depth
        low[active[full]], high[active[full]] = left[full], right[full]
        active, left, right = active[~full], left[~full], right[~full]
        word = query[at[active] + depth]
        left = _bisect(ids, order, left, right, depth, word)
        right = _bisect(ids, order, left, right, depth, word + 1)
    return low, high


def grown(ids: np.ndarray, query: np.ndarray, place: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Lengths of matches of ``ids`` at ``place`` with ``query`` at ``at`` that are ``length`` long at least, followed to their ends."""
    length, going = length.copy(), np.arange(len(place))
    while len(going):
        ahead = np.arange(max(1, min(STRIDE, GROWTH // len(going))))
        q = query[np.minimum(at[going, None] + length[going, None] + ahead, len(query) - 1)]
        differs = (q <= 0) | (q != ids[np.minimum(place[going, None] + length[going, None] + ahead, len(ids) - 1)])
        open_ = ~differs.any(axis=1)
        length[going] += np.where(open_, len(ahead), differs.argmax(axis=1))
        going = going[open_]
    return length


class Benchmark:
    """Words of benchmark items: numbered, one after the other, with a separator (-1) before, between and after."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.items = [item for item, _ in items]
        column = pa.array([text for _, text in items], pa.string())
        data = np.frombuffer("".join(text for _, text in items).encode(), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(text.encode()) for _, text in items], dtype=np.int64)]).astype(np.int64)
        assert len(column) == len(offsets) - 1
        found = find_words(data, offsets, ALNUM)
        numbers, self.words = found.numbered()
        counts = found.counts
        item = np.repeat(np.arange(len(items)), counts)
        place = np.arange(len(numbers)) + item + 1
        self.query = np.full(len(numbers) + len(items) + 1, -1, np.int64)
        self.query[place] = numbers
        within = np.arange(len(numbers)) - np.repeat(found.rows[:-1], counts)
        room = np.repeat(counts, counts) - within
        starts = (room >= window) | (within == 0)
        self.at, self.item, self.within = place[starts], item[starts], within[starts]
        self.lengths = np.minimum(np.repeat(counts, counts)[starts], window)
        self.depth = int(self.lengths.max(initial=0))


def _lists(rows: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """Values as lists by (sorted) row."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)), values)


def _shard(bench: Benchmark, data: np.ndarray, offsets: np.ndarray, before: pa.Array | None
           ) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array]:
    """Words, hit spans, items and longest matches of each document of a shard."""
    found = find_words(data, offsets, ALNUM)
    docs, counts = len(offsets) - 1, found.counts
    numbers, words = found.numbered()
    ids = np.zeros(len(numbers) + docs + 1, np.int64)
    ids[np.arange(len(numbers)) + np.repeat(np.arange(docs), counts) + 1] = numbers + 1
    first = found.rows[:-1] + np.arange(docs) + 1
    del found, numbers  # as large as the suffix array, which follows
    known = pc.fill_null(pc.index_in(bench.words, value_set=words), -2).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    query = np.where(bench.query < 0, -1, known[bench.query]) if len(known) else bench.query
    order, _ = suffix_array(ids, bench.depth)
    change = np.zeros(len(ids) + 1, np.int64)
    low, high = search(ids, order, query, bench.at, bench.lengths)
    hits = np.flatnonzero(low < high)
    best: list[np.ndarray] = []
    # Equal windows share their interval: each is marked once, each of its items is listed.
    shared = np.unique(np.stack([low[hits], high[hits], bench.lengths[hits]], 1), axis=0) if len(hits) else np.zeros((0, 3), int)
    for a, b, length in shared:
        np.add.at(change, order[a:b], 1)
        np.add.at(change, order[a:b] + length, -1)
    ends = np.cumsum(high[hits] - low[hits])
    start = 0
    while start < len(hits):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, side="right")))
        some = hits[start:stop]
        size = high[some] - low[some]
        which = np.repeat(some, size)
        place = order[np.arange(size.sum()) + np.repeat(low[some] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)]
        # A match that goes on to the left is counted from its first word.
        at = bench.at[which]
        whole = query[at - 1] != ids[place - 1]
        which, place, at = which[whole], place[whole], at[whole]
        length = grown(ids, query, place, at, bench.lengths[which])
        where = np.searchsorted(first, place, side="right") - 1
        best.append(np.stack([where, bench.item[which], -length, bench.within[which], place - first[where]], 1))
        start = stop
    rows = np.concatenate(best) if best else np.zeros((0, 5), np.int64)
    rows = rows[np.lexsort(rows.T[::-1])]
    if len(rows):
        rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])]
    names = pa.array(bench.items, pa.string())
    item = names.take(pa.array(rows[:, 1]))
    matches = pa.StructArray.from_arrays(
        [item, pa.array(rows[:, 3]), pa.array(rows[:, 4]), pa.array(-rows[:, 2])], ["item_id", "item_word", "doc_word", "words"])
    if before is not None and len(before.values):
        spans = before.flatten()
        of = np.repeat(np.arange(docs), np.diff(before.offsets.to_numpy()))
        np.add.at(change, first[of] + spans.field(0).to_numpy(), 1)
        np.add.at(change, first[of] + spans.field(1).to_numpy() + 1, -1)
    hit = np.concatenate([[False], np.cumsum(change[:len(ids)]) > 0, [False]])
    begin, end = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(hit[:-1] & ~hit[1:]) - 1
    where = np.searchsorted(first, begin, side="right") - 1
    spans = pa.StructArray.from_arrays([pa.array(begin - first[where]), pa.array(end - first[where])], ["first", "last"])
    return counts, _lists(where, docs, spans), _lists(rows[:, 0], docs, matches)


def _in_files(benchmark: DataFrame, limit: int) -> tuple[str, int]:
    """Write the items with text to a folder, in blocks of ``limit`` bytes or so; the folder and the number of blocks."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("words")) \
        .where("words is not null and words != ''").distinct()
    total = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n, folder = -(-total // limit), shared_folder(benchmark.sparkSession)
    if n:
        block = F.pmod(F.xxhash64("item", "words"), F.lit(n)).alias("block")
        items.select("item", "words", block).repartition("block").write.partitionBy("block").parquet(folder)
    return folder, n


def _read_block(folder: str, block: int) -> list[tuple[str | None, str]]:
    """The items of a block in an order of their own; none where the hash dealt none to it."""
    system, path = files_of(f"{folder}/block={block}")
    found = system.get_file_info(pa.fs.FileSelector(path, allow_not_found=True))
    tables = [pa.parquet.read_table(f.path, filesystem=system, partitioning=None) for f in found if f.path.endswith(".parquet")]
    rows = [r for t in tables for r in zip(t.column("item").to_pylist(), t.column("words").to_pylist())]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
                  benchmark_bytes: int = BENCHMARK_BYTES) -> DataFrame:
    """One row per document: what of it occurs verbatim in the benchmark.

    Columns: ``doc`` (the input row, any columns), ``n_words``, ``spans`` (hit words as inclusive ranges), ``matches``
    (for each item with an occurring window its longest match in this document: item, first word in item and document,
    words). Words are lower-cased A-Z alphanumerics; a window is ``window`` consecutive words of an item, or a whole
    shorter item. Null and empty texts, documents or items, have no words and no matches. Items without an id hit but
    have a null id in ``matches``. Repeated documents get equal rows; items given twice count once; an empty benchmark
    or document table gives no hits or no rows.
    """
    folder, count = _in_files(benchmark, benchmark_bytes)
    out = documents.select(F.struct("*").alias("doc"), F.lit(0).cast("bigint").alias("n_words"),
                           F.array().cast(SPANS).alias("spans"), F.array().cast(MATCHES).alias("matches"))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = Benchmark(_read_block(folder, 0) if count else [], window) if count < 2 else None
        for rows, data, offsets in blocks(batches, f"doc.{text}", SHARD_BYTES):
            spans, matches = rows.column(2), rows.column(3)
            for i in range(max(1, count)):
                counts, spans, more = _shard(only or Benchmark(_read_block(folder, i), window), data, offsets, spans)
                matches = _joined(matches, more)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(counts), spans, matches], ["doc", "n_words", "spans", "matches"])

    return map_arrow(out, run, out.schema)


def _joined(a: pa.Array, b: pa.Array) -> pa.Array:
    """Two list columns, list by list one after the other."""
    if not len(a.flatten()):
        return b
    both = pa.concat_arrays([a.flatten().cast(b.type.value_type), b.flatten()])
    n, ao, bo = len(a), a.offsets.to_numpy(), b.offsets.to_numpy()
    ao = ao - ao[0]
    where = np.concatenate([np.repeat(np.arange(n), np.diff(ao)), np.repeat(np.arange(n), np.diff(bo))])
    turn = np.argsort(where, kind="stable")
    return _lists(where[turn], n, both.take(pa.array(turn)))


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any verbatim benchmark window, all columns as they were."""
    return contamination(documents, benchmark, window).where(F.size("spans") == 0).select("doc.*")
