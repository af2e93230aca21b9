"""SimHash near-duplicates by a self-join of binary tries.

Two fingerprints with at most 4 differing bits agree in two of six blocks, so a trie whose bits begin with these two
blocks holds them below one node. For each of the 15 orders the subtrees below the two blocks are dealt to tasks, and
each is joined with itself: pairs of nodes go down together, collect differing bits, and are dropped beyond the budget.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom.llm.components import components
from siftloom.llm.store import map_arrow, small_side, stored
from siftloom.llm.words import SPACED_LOWER, blocks, find_words

SHINGLE = 4
BUDGET = 4
SEED = 42
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Bits that the two leading blocks have in every order.
SHARED_BITS = 20
#: Fingerprints of one subtree in one task; a larger one is cut into parts, and each pair of parts is a task.
PART = 8192
#: Subtrees joined in one go, and pairs of nodes that go down together.
GO, FRONT = 50_000, 500_000

_SPREAD = np.array([sum(((v >> j) & 1) << (8 * j) for j in range(8)) for v in range(256)], np.uint64)


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row of ``counts`` hashes the 64-bit word of the bits set in over half of them; 0 for none."""
    out = np.zeros(len(counts), np.uint64)
    rows = np.flatnonzero(counts)
    if not len(rows):
        return out
    counts = counts[rows]
    # Eight one-byte counters to a word: exact for up to 255 hashes, longer rows are added in pieces.
    pieces = -(-counts // 255)
    first = np.cumsum(counts) - counts
    within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    spread = _SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(spread, np.repeat(first, pieces) + 255 * within, axis=0).view(np.uint8).reshape(-1, 64)
    bits = np.add.reduceat(sums, np.cumsum(pieces) - pieces, axis=0, dtype=np.int64)
    out[rows] = np.packbits(2 * bits > counts[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """SimHash of each row's word shingles."""
    found = find_words(data, offsets, SPACED_LOWER)
    counts, n = found.counts, len(found.starts)
    lengths = found.ends - found.starts
    total = int(lengths.sum())
    text = np.full(total + n, 0x20, np.uint8)
    text[np.arange(total) + np.repeat(np.arange(n), lengths)] = found.data[found.mask]
    starts = np.cumsum(lengths) - lengths + np.arange(n)
    ends = starts + lengths
    shingles = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
    begin = np.arange(shingles.sum()) - np.repeat(np.cumsum(shingles) - shingles - found.rows[:-1], shingles)
    end = np.minimum(begin + SHINGLE, np.repeat(found.rows[1:], shingles)) - 1
    raw, h = text.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((h(raw[a:b], SEED) for a, b in zip(starts[begin].tolist(), ends[end].tolist())), np.uint64, len(begin))
    return majority(hashes, shingles)


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns ``doc_id``, ``row`` (hash of the whole row) and ``fp`` (the fingerprint's 64 bits as a signed number)."""
    row = F.xxhash64(*[f(c) for c in _columns(documents) for f in (lambda x: x, lambda x: x.isNull())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, "text"):
            fp = fingerprints_of(data, offsets).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(fp)], ["doc_id", "row", "fp"])

    rows = documents.select(F.col(id_column).alias("doc_id"), row.alias("row"), F.col(text).alias("text"))
    return map_arrow(rows, run, rows.select("doc_id", F.lit(0).cast("bigint").alias("row"), F.lit(0).cast("bigint").alias("fp")).schema)


def _columns(df: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def _reordered(lead: tuple[int, ...]) -> Column:
    """The fingerprint with blocks ``lead`` in front."""
    low = [64 - sum(BLOCKS[:i + 1]) for i in range(len(BLOCKS))]
    out, left = F.lit(0).cast("bigint"), 64
    for i in (*lead, *(j for j in range(len(BLOCKS)) if j not in lead)):
        left -= BLOCKS[i]
        block = F.shiftrightunsigned("fp", low[i]).bitwiseAND(F.lit((1 << BLOCKS[i]) - 1).cast("bigint"))
        out = out.bitwiseOR(F.shiftleft(block, left))
    return out


def _restored(table: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Inverse of :func:`_reordered` for leaves of several orders."""
    out = np.zeros(len(leaf), np.uint64)
    low = [64 - sum(BLOCKS[:i + 1]) for i in range(len(BLOCKS))]
    for t, lead in enumerate(combinations(range(len(BLOCKS)), 2)):
        here = np.flatnonzero(table == t)
        left = 64
        for i in (*lead, *(j for j in range(len(BLOCKS)) if j not in lead)):
            left -= BLOCKS[i]
            block = (leaf[here] >> np.uint64(left)) & np.uint64((1 << BLOCKS[i]) - 1)
            out[here] |= block << np.uint64(low[i])
    return out


class Forest:
    """Least label of each node under links added in bulk."""

    def __init__(self, n: int):
        self.label, self.u, self.v, self.n = np.arange(n), [], [], 0

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        self.u.append(u)
        self.v.append(v)
        self.n += len(u)
        if self.n > 1_000_000:
            self.settle()

    def settle(self) -> np.ndarray:
        if self.n:
            u, v = np.concatenate(self.u), np.concatenate(self.v)
            while True:
                a, b = self.label[u], self.label[v]
                open_ = a != b
                if not open_.any():
                    break
                u, v, a, b = u[open_], v[open_], a[open_], b[open_]
                np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
                while (up := self.label[self.label] != self.label).any():
                    self.label[up] = self.label[self.label[up]]
            self.u, self.v, self.n = [], [], 0
        return self.label


def _expand(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of [a, b) x [c, d), row by row."""
    size = (b - a) * (d - c)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    width = np.repeat(d - c, size)
    return np.repeat(a, size) + at // width, np.repeat(c, size) + at % width


def trie_links(leaf: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, budget: int = BUDGET) -> np.ndarray:
    """Self-join of the tries [low, high) of sorted 64-bit leaves that agree in their first ``depth`` bits.

    A node is a range of leaves. Returns the least linked leaf of each leaf.
    """
    forest, ones = Forest(len(leaf)), {}

    def middle(d: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if d not in ones:
            bit = ((leaf >> np.uint64(63 - d)) & np.uint64(1)).astype(np.int64)
            ones[d] = np.concatenate([[0], np.cumsum(bit)])
        return b - (ones[d][b] - ones[d][a])

    stack = [(depth, np.stack([low, high, low, high, np.zeros_like(low)]))]
    while stack:
        d, node = stack.pop()
        if node.shape[1] > FRONT:
            half = node.shape[1] // 2
            stack += [(d, node[:, half:]), (d, node[:, :half])]
            continue
        a, b, c, e, errors = node
        own = a == c
        # Few leaves are compared one by one.
        few = ~own & ((b - a) * (e - c) <= 16)
        if few.any():
            u, v = _expand(a[few], b[few], c[few], e[few])
            near = np.bitwise_count(leaf[u] ^ leaf[v]) <= budget
            forest.link(u[near], v[near])
            a, b, c, e, errors, own = (x[~few] for x in (a, b, c, e, errors, own))
        if not len(a):
            continue
        m, k = middle(d, a, b), middle(d, c, e)
        cross = ~own
        deeper = np.concatenate([
            np.stack([a, m, c, k, errors]), np.stack([m, b, k, e, errors]),
            np.stack([a, m, k, e, errors + 1]), np.stack([m, b, c, k, errors + 1])[:, cross]], axis=1)
        a, b, c, e, errors = deeper
        deeper = deeper[:, (b > a) & (e > c) & (errors <= budget) & ((a != c) | (b - a > 1))]
        if deeper.shape[1]:
            stack.append((d + 1, deeper))
    return forest.settle()


def _join_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (order, node, part_a, part_b, leaf) to links (u, v) that span what is near in each subtree."""

    def links(columns: list[np.ndarray], change: np.ndarray) -> pa.RecordBatch:
        group = np.cumsum(change) - 1
        leaf = columns[4].view(np.uint64)
        turn = np.lexsort((leaf, group))
        leaf, table = leaf[turn], columns[0][turn]
        low = np.flatnonzero(change)
        high = np.append(low[1:], len(leaf))
        many = high - low > 1
        label = trie_links(leaf, low[many], high[many], SHARED_BITS)
        node = np.flatnonzero(label != np.arange(len(label)))
        u, v = (_restored(table[x], leaf[x]).view(np.int64) for x in (node, label[node]))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    held: list[np.ndarray] = []
    for batch in batches:
        new = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
        held = [np.concatenate(x) for x in zip(held, new)] if held else new
        if len(held[0]) >= GO:
            change = np.ones(len(held[0]), bool)
            change[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in held[:4]])
            cut = int(np.flatnonzero(change)[-1])
            if cut:
                yield links([x[:cut] for x in held], change[:cut])
                held = [x[cut:] for x in held]
    if held and len(held[0]):
        change = np.ones(len(held[0]), bool)
        change[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in held[:4]])
        yield links(held, change)


def near_links(prints: DataFrame, part: int = PART) -> DataFrame:
    """Distinct fingerprints (column ``fp``) to links ``u``, ``v`` with the same components as all pairs within budget."""
    orders = [F.struct(F.lit(t).alias("order"), _reordered(lead).alias("leaf"))
              for t, lead in enumerate(combinations(range(len(BLOCKS)), 2))]
    shift = [64 - BLOCKS[i] - BLOCKS[j] for i, j in combinations(range(len(BLOCKS)), 2)]
    down = F.element_at(F.array(*[F.lit(s) for s in shift]), F.col("order") + 1)
    leaves = prints.select(F.inline(F.array(*orders))).withColumn("node", F.call_function("shiftrightunsigned", F.col("leaf"), down))
    large = stored(leaves.groupBy("order", "node").count().where(F.col("count") > part)
                   .select("order", "node", F.ceil(F.col("count") / part).cast("int").alias("parts")))
    leaves = leaves.join(small_side(large), ["order", "node"], "left")
    own = F.pmod(F.xxhash64("leaf"), F.coalesce("parts", F.lit(1))).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1),
                        lambda other: F.struct(F.least(own, other).alias("a"), F.greatest(own, other).alias("b")))
    tasks = leaves.select("order", "node", "leaf", F.inline(pairs))
    keys = ["order", "node", "a", "b"]
    dealt = tasks.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).select(*keys, "leaf")
    return map_arrow(dealt, _join_run, "u bigint, v bigint")


def near_components(prints: DataFrame, part: int = PART) -> DataFrame:
    """Columns ``fp`` and ``doc_id`` to ``fp``, ``root`` (least fingerprint that it reaches) and ``component_id`` (smallest
    ``doc_id`` that it reaches)."""
    least = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = stored(components(near_links(least.select("fp"), part)))
    ids = linked.join(least, linked["node"] == least["fp"]).groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(ids, "root").select(F.col("node").alias("fp"), "root", "component_id")
    return least.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"),
                                                   F.coalesce("component_id", "least").alias("component_id"))


def simhash_groups(documents: DataFrame, part: int = PART) -> DataFrame:
    """One row per document: ``doc_id``, ``row`` (hash of the row), ``fp`` (signed), ``fingerprint`` (16 hex digits),
    ``component_id``.

    Texts are lower-cased A-Z and cut at blanks; the shingles are 4 words, repeats included; a shorter text is one
    shingle. Null, empty and blank texts have fingerprint zero and are linked like any other. Fingerprints with at
    most 4 differing bits are linked, and links reach on. Documents without an id link as others do, but give no id;
    the id is null where none is reached. Repeated rows give repeated rows; an empty table gives none; extra columns
    are not read, but for the row hash.
    """
    prints = stored(fingerprints(documents))
    return prints.join(near_components(prints, part), "fp") \
        .select("doc_id", "row", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """One document of each group stays, all columns as they were: the one with the smallest id (ids before null),
    among equal ids the one with the smallest row hash; of rows that are equal in all columns one."""
    prints = stored(fingerprints(documents))
    groups = stored(prints.join(near_components(prints), "fp").select("doc_id", "row", F.col("root").alias("group")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    keep = groups.groupBy("group").agg(F.min(order).alias("keep"))
    judged = groups.groupBy("group", "doc_id", "row").count().join(keep, "group") \
        .select("doc_id", "row", "count", (F.col("keep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("keep.row") == F.col("row"))).alias("stays"))
    gone = stored(judged.where("not stays or count > 1").select("doc_id", "row", "stays"))
    row = F.xxhash64(*[f(c) for c in _columns(documents) for f in (lambda x: x, lambda x: x.isNull())])
    docs = documents.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), row.alias("key"))
    side = small_side(gone)
    left = docs.join(side, docs["id"].eqNullSafe(side["doc_id"]) & (docs["key"] == side["row"]), "left_anti")
    twice = gone.where("stays").select("doc_id", "row")
    if twice.limit(1).count():  # rows equal in all columns
        again = docs.join(small_side(twice), docs["id"].eqNullSafe(F.col("doc_id")) & (docs["key"] == F.col("row")), "left_semi")
        left = left.union(again.dropDuplicates(["id", "key"]))
    return left.select("doc.*")
