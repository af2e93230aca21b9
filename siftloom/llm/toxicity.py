"""Toxicity: a convolutional text classifier on hashed word embeddings, trained in numpy on all labelled texts.

A word's vector is the sum of the embeddings of its hash and of the hashes of its first bytes, so that inflected forms
share weights. Filters of several widths run over the words, the largest response of each filter over the whole text
is kept, and a logistic layer gives the score. Scoring runs in tasks next to the data and shuffles nothing. For the fit
the labelled texts are dealt into shards; in each turn every shard learns by itself and the changes are averaged.
"""

from __future__ import annotations

import copy
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.llm.samples import Sample, as_sample
from siftloom.llm.store import map_arrow, small_side, stored
from siftloom.llm.words import ALNUM, blocks, column_of, find_words, text_bytes

#: Bytes of labelled text of a shard. All labelled texts are learned from, whole; a fifth of them calibrates.
SHARD_BYTES = 64_000_000
BUCKETS, DIMENSIONS, FILTERS, WIDTHS = 1 << 17, 8, 16, (1, 2, 3)
PREFIXES = (3, 4, 5)
#: Features in fewer texts than this keep a zero vector.
LEAST_TEXTS = 3
EPOCHS, BATCH, RATE = 8, 32, 0.05
BLOCK, STEP = 2_000_000, 100_000
PAD = max(WIDTHS) - 1
#: Numbers of a line of weights; the unit that changes of weights are summed in; logit steps of the calibration.
CELLS, UNIT, LOGIT_STEPS = 2 * DIMENSIONS, 2.0 ** -32, 256
#: What CRC-32 does to each byte; bytes of a word that are hashed side by side with those of other words.
CRC_TABLE = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
LONG_WORD = 64


def crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, value: int = 0) -> np.ndarray:
    """``zlib.crc32`` of each piece of ``data``, ``value`` being its second argument; one byte of all pieces at a time."""
    crc = np.full(len(starts), value ^ 0xFFFFFFFF, np.uint32)
    at = np.arange(len(starts))
    for k in range(min(LONG_WORD, int(lengths.max(initial=0)))):
        at = at[lengths[at] > k]
        crc[at] = CRC_TABLE[(crc[at] ^ data[starts[at] + k]) & 255] ^ (crc[at] >> 8)
    for i in at[lengths[at] > LONG_WORD]:
        crc[i] = zlib.crc32(data[starts[i] + LONG_WORD:starts[i] + lengths[i]], int(crc[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return crc ^ np.uint32(0xFFFFFFFF)


def word_features(words: pa.Array) -> np.ndarray:
    """Buckets of each word (bytes) and of its prefixes; ``BUCKETS`` where a word is no longer than the prefix."""
    out = np.full((len(words), 1 + len(PREFIXES)), BUCKETS, np.int32)
    data, offsets = text_bytes(words)
    starts, lengths = offsets[:-1], np.diff(offsets)
    out[:, 0] = crcs(data, starts, lengths) & (BUCKETS - 1)
    for k, size in enumerate(PREFIXES, 1):
        at = np.flatnonzero(lengths > size)
        out[at, k] = crcs(data, starts[at], np.full(len(at), size), size) & (BUCKETS - 1)
    return out


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers with ``PAD`` padding words after each text, the texts' starts, and the features of each number."""
    found = find_words(data, offsets, ALNUM)
    numbers, words = found.numbered()
    features = np.vstack([word_features(words), np.full((1, 1 + len(PREFIXES)), BUCKETS, np.int32)])
    docs = len(offsets) - 1
    out = np.full(len(numbers) + PAD * docs, len(words), np.int32)
    out[np.arange(len(numbers)) + PAD * np.repeat(np.arange(docs), found.counts)] = numbers
    return out, found.rows + PAD * np.arange(docs + 1), features


@dataclass
class Network:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width: (width, dimensions, filters)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def vectors(self, features: np.ndarray) -> np.ndarray:
        """Sums of the embeddings of each word's features."""
        out = self.embedding[features[:, 0]]
        for k in range(1, features.shape[1]):
            out += self.embedding[features[:, k]]
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each text."""
        numbers, starts, features = padded(data, offsets)
        vectors = self.vectors(features)
        docs, pad = len(starts) - 1, len(features) - 1
        logit = np.full(docs, self.offset)
        for k, width in enumerate(WIDTHS):
            parts = [vectors @ w for w in self.filters[width]]
            best = np.zeros((docs, FILTERS), np.float32)
            # Long texts are taken in steps that overlap by a filter's width.
            for a in range(0, len(numbers) - PAD, STEP):
                b = min(a + STEP, len(numbers) - PAD)
                z = parts[0][numbers[a:b]]
                for j in range(1, width):
                    z = z + parts[j][numbers[a + j:b + j]]
                z[numbers[a:b] == pad] = -np.inf  # a window begins at a word
                low = np.searchsorted(starts, a, side="right") - 1
                high = np.searchsorted(starts, b, side="left")
                top = np.maximum.reduceat(z, np.maximum(starts[low:high], a) - a, axis=0) + self.bias[width]
                best[low:high] = np.maximum(best[low:high], top)
            logit += best @ self.out[k * FILTERS:(k + 1) * FILTERS]
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -30, 30)))


class Weights:
    """A network in training: the sums of squared gradients beside it, and the features that have vectors of their own."""

    def __init__(self, used: np.ndarray, seed: int):
        random = np.random.default_rng(seed)
        self.used = used.astype(np.float32)
        self.used[BUCKETS] = 0
        self.net = Network((random.normal(0, 0.1, (BUCKETS + 1, DIMENSIONS)) * self.used[:, None]).astype(np.float32),
                           {w: random.normal(0, 0.3, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS},
                           {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
                           random.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), 0.0)
        self.squares = {"embedding": np.full(self.net.embedding.shape, 1e-3, np.float32), "out": np.full(self.net.out.shape, 1e-3)}
        self.squares |= {w: np.full(self.net.filters[w].shape, 1e-3) for w in WIDTHS} | {-w: np.full(FILTERS, 1e-3) for w in WIDTHS}

    def dense(self) -> np.ndarray:
        """All numbers but those of the features, in lines of ``CELLS``."""
        net, squares = self.net, self.squares
        parts = [net.out, squares["out"], [net.offset]]
        for w in WIDTHS:
            parts += [net.filters[w], net.bias[w], squares[w], squares[-w]]
        flat = np.concatenate([np.ravel(x).astype(np.float64) for x in parts])
        return np.pad(flat, (0, -len(flat) % CELLS)).reshape(-1, CELLS)

    def set_dense(self, lines: np.ndarray) -> None:
        flat, at = lines.ravel(), 0

        def taken(old: np.ndarray) -> np.ndarray:
            nonlocal at
            at += old.size
            return flat[at - old.size:at].reshape(old.shape).astype(old.dtype)

        net, squares = self.net, self.squares
        net.out, squares["out"] = taken(net.out), taken(squares["out"])
        net.offset = float(taken(np.zeros(1))[0])
        for w in WIDTHS:
            net.filters[w], net.bias[w], squares[w], squares[-w] = map(taken, (net.filters[w], net.bias[w], squares[w], squares[-w]))

    def sparse(self, at: np.ndarray) -> np.ndarray:
        """A line of ``CELLS`` numbers for each of some features."""
        return np.hstack([self.net.embedding[at], self.squares["embedding"][at]])

    def moved(self, at: np.ndarray, shards: np.ndarray, sums: np.ndarray) -> None:
        """Go on by the mean change of the shards that changed a line; the changes are sums in units of ``UNIT``."""
        change = sums * UNIT / shards[:, None]
        own = at <= BUCKETS
        self.net.embedding[at[own]] += change[own, :DIMENSIONS].astype(np.float32)
        self.squares["embedding"][at[own]] += change[own, DIMENSIONS:].astype(np.float32)
        dense = self.dense()
        dense[at[~own] - BUCKETS - 1] += change[~own]
        self.set_dense(dense)

    def learn(self, numbers: np.ndarray, starts: np.ndarray, features: np.ndarray, labels: np.ndarray, weights: np.ndarray,
              random: np.random.Generator) -> None:
        """One pass over the texts of a block, in a random order."""
        net, squares, used = self.net, self.squares, self.used

        def step(value: np.ndarray, gradient: np.ndarray, name) -> None:
            squares[name] += gradient ** 2
            value -= (RATE * gradient / np.sqrt(squares[name])).astype(np.float32)

        turn = random.permutation(len(labels))
        place = np.zeros(len(features), np.int32)
        for i in range(0, len(turn), BATCH):
            batch = turn[i:i + BATCH]
            top = np.zeros((len(batch), FILTERS * len(WIDTHS)), np.float32)
            where = np.zeros(top.shape, np.int64)
            place[:] = 0
            for doc in batch:
                place[numbers[starts[doc]:starts[doc + 1]]] = 1
            words = np.flatnonzero(place)
            place[words] = np.arange(len(words))
            vectors = net.vectors(features[words])
            for row, doc in enumerate(batch):
                x = vectors[place[numbers[starts[doc]:starts[doc + 1]]]]
                n = len(x) - PAD
                for k, w in enumerate(WIDTHS):
                    if n > 0:
                        z = x[:n] @ net.filters[w][0]
                        for j in range(1, w):
                            z += x[j:j + n] @ net.filters[w][j]
                        at = z.argmax(axis=0)
                        s = slice(k * FILTERS, (k + 1) * FILTERS)
                        where[row, s] = starts[doc] + at
                        top[row, s] = z[at, np.arange(FILTERS)] + net.bias[w]
            active = top > 0
            hidden = np.where(active, top, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.offset, -30, 30)))
            slope = (p - labels[batch]) * weights[batch] / len(batch)
            back = slope[:, None] * net.out * active
            step(net.out, slope @ hidden + 1e-5 * net.out, "out")
            net.offset -= 0.5 * float(slope.sum())
            change, rows = [], []
            for k, w in enumerate(WIDTHS):
                g = back[:, k * FILTERS:(k + 1) * FILTERS]
                gradient = np.zeros(net.filters[w].shape)
                for j in range(w):
                    feature = features[numbers[where[:, k * FILTERS:(k + 1) * FILTERS] + j]]
                    x = net.embedding[feature].sum(axis=2)
                    gradient[j] = np.einsum("df,dfe->ef", g, x)
                    rows.append(feature.reshape(-1, feature.shape[2]))
                    change.append((g[:, :, None] * net.filters[w][j].T[None]).reshape(-1, DIMENSIONS))
                step(net.filters[w], gradient, w)
                step(net.bias[w], g.sum(axis=0), -w)
            rows, change = np.concatenate(rows), np.concatenate(change)
            touched, at = np.unique(rows, return_inverse=True)
            gradient = np.stack([np.bincount(at.ravel(), np.repeat(change[:, d], rows.shape[1]), len(touched)) for d in range(DIMENSIONS)], 1)
            gradient *= used[touched, None]
            squares["embedding"][touched] += gradient ** 2
            net.embedding[touched] -= (RATE * gradient / np.sqrt(squares["embedding"][touched])).astype(np.float32)


def labelled_blocks(batches: Iterator[pa.RecordBatch], seed: int, held: bool) -> Iterator[tuple[int, int, list[bytes], list, list]]:
    """Shard, number in the shard, texts in UTF-8, labels and languages of the rows that calibrate (``held``) or of those that
    are fitted to, about ``BLOCK`` bytes at a time; cut alike however the rows come in batches."""
    shard, block, size, rows = None, 0, 0, []
    for batch in batches:
        data, offsets = text_bytes(column_of(batch, "text"))
        columns = (column_of(batch, c).to_pylist() for c in ("shard", "label", "lang"))
        for a, b, at, label, lang in zip(offsets[:-1].tolist(), offsets[1:].tolist(), *columns):
            raw = data[a:b].tobytes()
            if (zlib.crc32(raw, zlib.crc32(b"%d" % seed)) % 5 == 0) != held:
                continue
            if rows and (at != shard or size + len(raw) > BLOCK):
                yield shard, block, *map(list, zip(*rows))
                block, size, rows = block + 1 if at == shard else 0, 0, []
            elif at != shard:
                block = 0
            shard, size = at, size + len(raw)
            rows.append((raw, label, lang))
    if rows:
        yield shard, block, *map(list, zip(*rows))


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.diff(values, prepend=values[:1] - 1) > 0]


def texts_with(batches: Iterator[pa.RecordBatch], seed: int) -> np.ndarray:
    """How many of the texts that are fitted to have each feature."""
    seen = np.zeros(BUCKETS + 1, np.int64)
    for _, _, texts, _, _ in labelled_blocks(batches, seed, False):
        numbers, starts, features = padded(*_joined(texts))
        n = np.int64(len(features))
        of, words = np.divmod(_distinct(np.repeat(np.arange(len(texts)) * n, np.diff(starts)) + numbers), n)
        once = _distinct(((of * (BUCKETS + 1))[:, None] + features[words]).ravel())
        seen += np.bincount(once % (BUCKETS + 1), minlength=BUCKETS + 1)
    return seen


def changes(batches: Iterator[pa.RecordBatch], weights: Weights, by_label: dict, seed: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines that the shards of a task change in one turn, each shard from the same weights on: their numbers, the shards that
    change them, and the sums of the changes in units of ``UNIT``, whole numbers whose sum no order changes."""
    lines = BUCKETS + 1 + len(weights.dense())
    shards, sums = np.zeros(lines, np.int64), np.zeros((lines, CELLS), np.int64)
    for shard, parts in groupby(labelled_blocks(batches, seed, False), key=lambda b: b[0]):
        own = copy.deepcopy(weights)
        for _, block, texts, labels, _ in parts:
            weight = np.sqrt([by_label[x] for x in labels])
            own.learn(*padded(*_joined(texts)), np.array(labels, float), weight, np.random.default_rng([seed, turn, shard, block]))
        moved = np.flatnonzero((own.net.embedding != weights.net.embedding).any(axis=1)
                               | (own.squares["embedding"] != weights.squares["embedding"]).any(axis=1))
        change = np.vstack([own.sparse(moved).astype(np.float64) - weights.sparse(moved), own.dense() - weights.dense()])
        at = np.concatenate([moved, np.arange(BUCKETS + 1, lines)])
        shards[at] += 1
        sums[at] += np.rint(change / UNIT).astype(np.int64)
    at = np.flatnonzero(shards)
    return at, shards[at], sums[at]


def held_steps(batches: Iterator[pa.RecordBatch], net: Network, seed: int) -> Counter:
    """How many rows that calibrate have each language, label and logit, in steps of 1 / ``LOGIT_STEPS``."""
    found: Counter = Counter()
    for _, _, texts, labels, langs in labelled_blocks(batches, seed, True):
        p = np.clip(net.scores(*_joined(texts)), 1e-9, 1 - 1e-9)
        found.update(zip(langs, labels, np.rint(np.log(p / (1 - p)) * LOGIT_STEPS).astype(int).tolist()))
    return found


def _calibrated(steps: np.ndarray, slope: float, shift: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * (np.asarray(steps) / LOGIT_STEPS) + shift, -30, 30)))


def best_threshold(steps: np.ndarray, labels: np.ndarray, weights: np.ndarray, rows: int, slope: float, shift: float) -> float | None:
    """The threshold with the best F1 on the rows of each logit step and label, in the middle of the gap it lies in."""
    if rows < 20 or not 0 < (weights * labels).sum() < weights.sum():
        return None
    s, at = np.unique(-np.asarray(steps), return_inverse=True)
    good, all_ = (np.cumsum(np.bincount(at, w, len(s))) for w in (weights * labels, weights))
    f1 = 2 * good / (all_ + good[-1])
    k = int(f1.argmax())
    q = _calibrated(-s, slope, shift)
    return float((q[k] + (q[k + 1] if k + 1 < len(q) else 0)) / 2)


def calibrate(net: Network, steps: np.ndarray, labels: np.ndarray, counts: np.ndarray, by_label: dict) -> None:
    """Logistic calibration on rows the network has not seen, pulled a little to the identity, and the general threshold."""
    if len(set(labels.tolist())) < 2:
        return
    order = np.lexsort((labels, steps))
    x, y, n = steps[order] / LOGIT_STEPS, labels[order].astype(float), counts[order]
    total = n * np.where(y == 1, by_label[1], by_label[0])
    w = total / total.sum()
    for _ in range(300):
        q = 1 / (1 + np.exp(-np.clip(net.slope * x + net.shift, -30, 30)))
        g = w * (q - y)
        h = w * q * (1 - q)
        matrix = np.array([[(h * x * x).sum(), (h * x).sum()], [(h * x).sum(), h.sum()]]) + 1e-3 * np.eye(2)
        d = np.linalg.solve(matrix, [(g * x).sum() + 1e-3 * (net.slope - 1), g.sum() + 1e-3 * net.shift])
        net.slope, net.shift = max(0.1, net.slope - 0.5 * d[0]), net.shift - 0.5 * d[1]
    net.threshold = best_threshold(steps[order], y, w, int(n.sum()), net.slope, net.shift) or 0.5


def _label_weights(totals: dict, taken: dict) -> dict:
    """Weights of a row of either label, 1 on average."""
    ratio = {k: totals[k] / taken[k] for k in (0, 1)}
    mean = sum(ratio[k] * taken[k] for k in (0, 1)) / sum(taken.values())
    return {k: r / mean for k, r in ratio.items()}


def train(sample: Sample, seed: int = 7) -> Network | None:
    """Fit on rows at hand with labels 0 and 1, as one shard; languages are used for thresholds only and may be null.

    Rows are weighted by the numbers of rows that the labels have in all. None without rows of both labels. ``fitted``
    learns in the same way from all labelled rows of tables.
    """
    taken = Counter(sample.labels)
    if not (taken[0] and taken[1]):
        return None
    by_label = _label_weights(sample.totals, taken)
    rows = sorted(zip(sample.texts, sample.labels, sample.langs), key=lambda r: (zlib.crc32(r[0].encode()), r[1], r[0]))
    batch = pa.RecordBatch.from_arrays([pa.array([0] * len(rows)), *map(pa.array, zip(*rows))], ["shard", "text", "label", "lang"])
    weights = Weights(texts_with([batch], seed) >= LEAST_TEXTS, seed)
    for turn in range(EPOCHS):
        weights.moved(*changes([batch], weights, by_label, seed, turn))
    net, found = weights.net, held_steps([batch], weights.net, seed)
    both: Counter = Counter()
    for (_, label, step), n in found.items():
        both[label, step] += n
    if both:
        calibrate(net, *_columns([(step, label, n) for (label, step), n in both.items()]), by_label)
    if len({label for label, _ in both}) == 2:
        for lang in sorted({k[0] for k in found} - {None}):
            steps, labels, counts = _columns([(step, label, n) for (x, label, step), n in found.items() if x == lang])
            best = best_threshold(steps, labels, counts * _weights_of(labels, by_label), int(counts.sum()), net.slope, net.shift)
            if best is not None:
                net.thresholds[lang] = best
    return net


def _columns(rows: list[tuple]) -> list[np.ndarray]:
    return [np.array(c, np.int64) for c in zip(*sorted(rows))]


def _weights_of(labels: np.ndarray, by_label: dict) -> np.ndarray:
    return np.where(np.asarray(labels) == 1, by_label[1], by_label[0])


def score(documents: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """One row per document: ``doc`` (the input row, any columns) and ``score``, 0 to 1, higher for label 1.

    Null and empty texts get the score of a text without words. Without a network (nothing to learn from) every score
    is 0. Repeated rows get equal scores; an empty table gives none.
    """
    sent = documents.sparkSession.sparkContext.broadcast(net)
    rows = documents.select(F.struct("*").alias("doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches, f"doc.{text}", BLOCK):
            found = sent.value.scores(data, offsets) if sent.value else np.zeros(len(offsets) - 1)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.astype(np.float64))], ["doc", "score"])

    return map_arrow(rows, run, rows.withColumn("score", F.lit(0.0)).schema)


def with_threshold(scored: DataFrame, net: Network | None) -> DataFrame:
    """Add ``threshold``, that of the document's language (``doc.lang``) or the general one, and ``toxic``."""
    limits = net.thresholds if net else {}
    general = F.lit(net.threshold if net else 0.5)
    limit = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair])[F.col("doc.lang").cast("string")] if limits else F.lit(None)
    return scored.withColumn("threshold", F.coalesce(limit, general)).withColumn("toxic", F.col("score") >= F.col("threshold"))


def _labelled(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All texts with a label, and the labels: an id's label counts once (the larger, if they differ). Null ids, labels and
    texts are left out."""
    label = stored(labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")))
    lang = F.col("lang").cast("string") if "lang" in documents.columns else F.lit(None).cast("string")
    texts = documents.where("text is not null").select("doc_id", "text", lang.alias("lang"))
    return texts.join(small_side(label), "doc_id"), label


def _once(rows: DataFrame, *by: str) -> DataFrame:
    """An id's text counts once (the smallest)."""
    return rows.groupBy(*by, "doc_id", "label").agg(F.min(F.struct("text", "lang")).alias("row")).select(*by, "label", "row.text", "row.lang")


def labelled(documents: DataFrame, labels: DataFrame) -> Sample:
    """All labelled rows on the driver, for small tables."""
    rows = _once(_labelled(documents, labels)[0]).collect()
    return as_sample([(r["label"], r["text"], r["lang"]) for r in rows], Counter(r["label"] for r in rows))


def shards_of(documents: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """All labelled texts, stored: ``shard, label, text, lang``. A shard has about ``shard_bytes`` of text, lies in one file, and
    its rows come in the order of their hashes."""
    rows, _ = _labelled(documents, labels)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]
    count = max(1, -(-size // shard_bytes))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(count)).cast("int")).repartition(4 * count, "shard")
    return stored(_once(dealt, "shard").sortWithinPartitions("shard", F.crc32(F.col("text").cast("binary")), "label", "text"))


def fitted(documents: DataFrame, labels: DataFrame, seed: int = 7, shard_bytes: int = SHARD_BYTES) -> Network | None:
    """Fit on all labelled rows: in each of ``EPOCHS`` turns every shard learns in its task from the same weights on, and the
    changes are averaged by an aggregate; then all rows held back give calibration and thresholds.

    Only the weights and counts whose number the network bounds come to the driver. The sums are of whole numbers, so the
    result does not depend on the order of tasks.
    """
    rows = shards_of(documents, labels, shard_bytes)
    taken = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(taken) < 2:
        return None
    by_label = _label_weights(taken, taken)
    context = rows.sparkSession.sparkContext

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = texts_with(batches, seed)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["at", "n"])

    often = map_arrow(rows, seen, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TEXTS)
    used = np.zeros(BUCKETS + 1, bool)
    used[[r["at"] for r in often.select("at").collect()]] = True
    weights = Weights(used, seed)
    cells = [f"c{i}" for i in range(CELLS)]
    for turn in range(EPOCHS):
        sent = context.broadcast(weights)

        def learn(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            at, shards, sums = changes(batches, sent.value, by_label, seed, turn)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(shards), *(pa.array(c) for c in sums.T.copy())], ["at", "n", *cells])

        found = map_arrow(rows, learn, ", ".join(f"{c} bigint" for c in ("at", "n", *cells)))
        table = found.groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in cells]).toArrow()
        columns = [table.column(c).to_numpy() for c in ("at", "n", *cells)]
        weights.moved(columns[0], columns[1], np.stack(columns[2:], axis=1))
        sent.destroy()
    net = weights.net
    sent = context.broadcast(net)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = held_steps(batches, sent.value, seed)
        lang, label, step = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(label, pa.int32()), pa.array(step, pa.int32()),
                                          pa.array(list(found.values()), pa.int64())], ["lang", "label", "step", "n"])

    counts = stored(map_arrow(rows, held, "lang string, label int, step int, n bigint").groupBy("lang", "label", "step").agg(F.sum("n").alias("n")))
    both = counts.groupBy("step", "label").agg(F.sum("n").alias("n")).collect()
    if len({r["label"] for r in both}) == 2:
        calibrate(net, *_columns([tuple(r) for r in both]), by_label)
        slope, shift = net.slope, net.shift

        def best(table: pa.Table) -> pa.Table:
            lang = table.column("lang")[0].as_py()
            steps, labels_, n = _columns(list(zip(*(table.column(c).to_pylist() for c in ("step", "label", "n")))))
            found = best_threshold(steps, labels_, n * _weights_of(labels_, by_label), int(n.sum()), slope, shift)
            return pa.table({"lang": pa.array([lang], pa.string()), "threshold": pa.array([found], pa.float64())})

        # A language has two rows per logit step at most.
        limits = counts.where("lang is not null").groupBy("lang").applyInArrow(best, "lang string, threshold double").where("threshold is not null")
        net.thresholds = {r["lang"]: r["threshold"] for r in limits.orderBy("lang").collect()}
    return net


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold of their language, all columns as they were."""
    net = fitted(documents, labels)
    return with_threshold(score(documents, net), net).where("not toxic").select("doc.*")
