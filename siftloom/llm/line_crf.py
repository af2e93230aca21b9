"""Quality rules by labelling lines: a linear-chain conditional random field marks content or boilerplate.

The field has two states, emissions linear in a few line features and a transition matrix. It is fitted by maximum
likelihood (forward-backward) on a bounded sample of labelled documents whose lines take the document's quality as
their weak label, and on as many chains that join runs of lines of bad documents to good ones, ahead, behind and within,
so that changes of state are learned from chains that have them. Viterbi decoding marks every line of every document; the share of words in content lines decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.llm.samples import Sample, labelled_sample
from siftloom.llm.store import map_arrow
from siftloom.llm.words import SPACED, blocks, find_words, lines_of, numbered_lines, within

#: Documents used for fitting, about so many of each quality, none with more characters than this.
SAMPLE, SAMPLE_CHARS = 1500, 20_000
ROUNDS, RATE, RIDGE = 150, 0.1, 1e-3
CONTENT_SHARE = 0.5
#: Lines of a joined run at most, and the share of joined chains with a run in their middle.
JOINED_LINES, MIDDLE_SHARE = 20, 0.25
#: Characters that count as symbols, and the base rules' bounds.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PCT = 50, 50


def _is(data: np.ndarray, characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table[data]


def _repeated_words(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words that lie in a 3-word window that their document has twice or more."""
    n = len(ids) - 2
    out = np.zeros(len(ids), bool)
    if n < 1:
        return out
    start = np.flatnonzero(doc[:-2] == doc[2:])
    size = int(ids.max()) + 1
    if size < 1 << 21:
        key = (ids[start] * size + ids[start + 1]) * size + ids[start + 2]
    else:
        pair = np.unique(ids[start] * size + ids[start + 1], return_inverse=True)[1]
        key = pair * size + ids[start + 2]
    order = np.argsort(key, kind="stable")
    at = start[order]
    same = (key[order][1:] == key[order][:-1]) & (doc[at[1:]] == doc[at[:-1]])
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    for j in range(3):
        out[at[twice] + j] = True
    return out


class Lines:
    """Counts of the rows of a block, and features of their lines."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        found = find_words(data, offsets, SPACED)
        ids, _ = found.numbered()
        low, high = offsets[:-1], offsets[1:]
        doc = np.repeat(np.arange(len(low)), found.counts)
        self.n_words = found.counts
        self.word_chars = within(found.mask & ((data & 0xC0) != 0x80), low, high)
        symbol = _is(data, SYMBOLS)
        self.n_symbols = within(symbol, low, high)
        self.n_repeat_words = within(_repeated_words(ids, doc), found.rows[:-1], found.rows[1:])
        self.first, self.row, start, end = lines_of(data, offsets)
        number = numbered_lines(data, start, end)
        a, b = np.searchsorted(found.starts, start), np.searchsorted(found.starts, end)
        self.words = b - a
        filled = np.flatnonzero(self.words > 0)
        key = self.row[filled] * (int(number.max(initial=0)) + 1) + number[filled]
        kinds, turn, count = np.unique(key, return_inverse=True, return_counts=True)
        rows = np.bincount(self.row[filled], minlength=len(low))
        self.n_dup_lines = rows - np.bincount(kinds // (int(number.max(initial=0)) + 1), minlength=len(low))
        again = np.zeros(len(start), bool)
        again[filled] = count[turn] > 1
        same = np.zeros(len(ids), bool)
        same[1:] = (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])
        size, words = np.maximum(end - start, 1), np.maximum(self.words, 1)
        upper, lower = within((data >= 65) & (data <= 90), start, end), within((data >= 97) & (data <= 122), start, end)
        last = np.zeros(len(start), bool)
        last[filled] = np.isin(data[found.ends[b[filled] - 1] - 1], list(b".!?"))
        ratio = lambda flags: np.minimum(within(flags, start, end) / words, 2)
        self.features = np.stack([
            np.ones(len(start)), np.log1p(self.words) / 5, np.minimum(within(symbol, start, end) / size * 10, 3),
            upper / np.maximum(upper + lower, 1), within((data >= 48) & (data <= 57), start, end) / size,
            ratio(data == 124), ratio(data == 33), within(same, a, b) / words, last, again, size / words / 10,
            self.words == 0, (self.words > 0) & (self.words < 4)], 1).clip(0, 3)

    @property
    def base_failed(self) -> np.ndarray:
        return (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > MAX_REPEAT_PCT * self.n_words)


class Field:
    """Two states, 0 boilerplate and 1 content; ``weights`` (2, features), ``moves`` (2, 2)."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def viterbi(self, features: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Best state of each line; documents go side by side, longest first."""
        score = features @ self.weights.T
        order = np.argsort(-counts, kind="stable")
        first, counts = first[order], counts[order]
        back = np.zeros((len(score), 2), np.int8)
        state = np.zeros(len(score), np.int8)
        best = score[first].copy()
        active = np.searchsorted(-counts, -np.arange(1, int(counts.max(initial=0)) + 1), side="right")
        for t in range(1, len(active)):
            n = active[t]
            step = best[:n, :, None] + self.moves[None]
            at = first[:n] + t
            back[at] = step.argmax(axis=1)
            best[:n] = step.max(axis=1) + score[at]
        now = np.zeros(len(first), np.int8)
        for t in range(len(active) - 1, -1, -1):
            n = active[t]
            ends = counts[:n] == t + 1
            now[:n][ends] = best[:n][ends].argmax(axis=1)
            at = first[:n] + t
            state[at] = now[:n]
            now[:n] = back[at, now[:n]]
        return state

    def gradient(self, features: np.ndarray, first: np.ndarray, counts: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the log likelihood, over documents sorted longest first."""
        score = features @ self.weights.T
        active = np.searchsorted(-counts, -np.arange(1, int(counts.max()) + 1), side="right")
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[first] = score[first]
        for t in range(1, len(active)):
            at = first[:active[t]] + t
            ahead[at] = np.logaddexp.reduce(ahead[at - 1][:, :, None] + self.moves, axis=1) + score[at]
        for t in range(len(active) - 1, 0, -1):
            at = first[:active[t]] + t
            behind[at - 1] = np.logaddexp.reduce(self.moves + (score[at] + behind[at])[:, None, :], axis=2)
        whole = np.repeat(np.logaddexp.reduce(ahead[first + counts - 1], axis=1), counts)
        turn = np.repeat(first, counts) + np.arange(len(score)) - np.repeat(np.cumsum(counts) - counts, counts)
        total = np.empty(len(score))
        total[turn] = whole
        p = np.exp(ahead + behind - total[:, None])
        d_weights = (np.eye(2)[label] - p).T @ features
        inner = np.ones(len(score), bool)
        inner[first] = False
        at = np.flatnonzero(inner)
        both = np.exp(ahead[at - 1][:, :, None] + self.moves + (score[at] + behind[at])[:, None, :] - total[at][:, None, None])
        d_moves = np.zeros((2, 2))
        np.add.at(d_moves, (label[at - 1], label[at]), 1)
        return d_weights, d_moves - both.sum(axis=0)


def joined_chains(first: np.ndarray, counts: np.ndarray, good: np.ndarray, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """Lines and their labels of one chain per good document, with runs of lines of bad documents ahead, behind, or within."""
    random = np.random.default_rng(seed)
    bad = np.flatnonzero(~good)

    def run() -> np.ndarray:
        doc = random.choice(bad)
        n = min(int(random.integers(1, JOINED_LINES + 1)), int(counts[doc]))
        start = first[doc] + int(random.integers(0, counts[doc] - n + 1))
        return np.arange(start, start + n)

    out = []
    for doc in np.flatnonzero(good):
        lines = np.arange(first[doc], first[doc] + counts[doc])
        cut = int(random.integers(1, len(lines))) if len(lines) > 1 and random.random() < MIDDLE_SHARE else len(lines)
        none = np.zeros(0, np.int64)
        parts = [(run(), 0), (lines[:cut], 1), (run() if cut < len(lines) else none, 0), (lines[cut:], 1), (run(), 0)]
        if random.random() < 0.5:  # some have a run at one end only
            parts[0 if random.random() < 0.5 else 4] = (none, 0)
        out.append((np.concatenate([p for p, _ in parts]), np.concatenate([np.full(len(p), y) for p, y in parts])))
    return out


def train(sample: Sample) -> Field | None:
    """Fit on a sample with labels 1 (good) and 0 (bad); None without rows of both."""
    label = np.array(sample.labels)
    if len(set(sample.labels)) < 2:
        return None
    raw = [t.encode() for t in sample.texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    lines = Lines(np.frombuffer(b"".join(raw), np.uint8), offsets)
    counts = np.bincount(lines.row, minlength=len(raw))
    chains = [(np.arange(a, a + n), np.full(n, y)) for a, n, y in zip(lines.first, counts, label.astype(int))]
    chains += joined_chains(lines.first, counts, label == 1)
    at, state = (np.concatenate(c) for c in zip(*chains))
    features, counts = lines.features[at], np.array([len(c) for c, _ in chains])
    first = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    field = Field(np.zeros((2, lines.features.shape[1])), np.zeros((2, 2)))
    mean = [[np.zeros_like(x) for x in (field.weights, field.moves)] for _ in range(2)]
    for i in range(1, ROUNDS + 1):
        steps = field.gradient(features, first[order], counts[order], state)
        for k, (value, g) in enumerate(zip((field.weights, field.moves), steps)):
            g = g / len(features) - RIDGE * value
            mean[0][k] += 0.1 * (g - mean[0][k])
            mean[1][k] += 0.01 * (g ** 2 - mean[1][k])
            value += RATE * (mean[0][k] / (1 - 0.9 ** i)) / (np.sqrt(mean[1][k] / (1 - 0.99 ** i)) + 1e-8)
    return field


def judge(documents: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """One row per document: ``doc`` (the input row), ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``content_share``, ``states`` (one character per line, C content, B boilerplate), ``base_failed``,
    ``kept``.

    Null and empty texts have no words and fail the base rules. Without a field every line is content. Lines and words
    of very long texts are all decoded. Repeated rows get equal results; an empty table gives none.
    """
    sent = documents.sparkSession.sparkContext.broadcast(field)
    rows = documents.select(F.struct("*").alias("doc"))
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches, f"doc.{text}"):
            lines = Lines(data, offsets)
            counts = np.diff(np.append(lines.first, len(lines.row)))
            state = sent.value.viterbi(lines.features, lines.first, counts) if sent.value else np.ones(len(lines.row), np.int8)
            share = np.bincount(lines.row, lines.words * state, len(counts)) / np.maximum(lines.n_words, 1)
            marks = np.where(state == 1, 67, 66).astype(np.uint8).tobytes()
            states = [marks[a:a + n].decode() for a, n in zip(lines.first.tolist(), counts.tolist())]
            failed = lines.base_failed
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(getattr(lines, c).astype(np.int64)) for c in numbers), pa.array(share), pa.array(states, pa.string()),
                 pa.array(failed), pa.array(~failed & (share >= CONTENT_SHARE))],
                ["doc", *numbers, "content_share", "states", "base_failed", "kept"])

    shape = rows.select("doc", *[F.lit(0).cast("bigint").alias(c) for c in numbers], F.lit(0.0).alias("content_share"),
                        F.lit("").alias("states"), F.lit(True).alias("base_failed"), F.lit(True).alias("kept")).schema
    return map_arrow(rows, run, shape)


def labelled(documents: DataFrame, labels: DataFrame) -> Sample:
    """The sample for ``labels.quality``."""
    return labelled_sample(documents, labels, "quality", SAMPLE, SAMPLE_CHARS)
