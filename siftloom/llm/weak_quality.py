"""Quality without labels: heuristic labellers vote, expectation-maximisation weighs them, a linear scorer learns.

Each labeller says good, bad or nothing about a text. The votes of all documents are counted by pattern (a bounded
table), and EM estimates on these counts how often each labeller says what about good and bad texts. The posterior of
the patterns then labels a bounded sample that a linear scorer on hashed words and word shapes is fitted to.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.llm.line_crf import SYMBOLS, Lines, _is
from siftloom.llm.samples import text_sample
from siftloom.llm.store import map_arrow
from siftloom.llm.words import SPACED, blocks, find_words, within

#: Names of the labellers; each votes by two bounds, see :func:`votes`.
LABELLERS = ("symbols", "repeats", "word_length", "sentences", "capitals", "length", "bars", "same_again", "exclamations",
             "odd_words", "letters", "variety")
BAD, GOOD, NOTHING = 0, 1, 2
#: Texts the scorer is fitted to, about so many, and the longest one used. All texts vote and are scored whole.
SAMPLE, SAMPLE_CHARS = 6000, 20_000
BUCKETS, EPOCHS, RATE = 1 << 16, 6, 0.5
ROUNDS, PRIOR = 200, 1.0


def votes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A vote of each labeller (columns) on each text."""
    lines = Lines(data, offsets)
    low, high = offsets[:-1], offsets[1:]
    n = np.maximum(lines.n_words, 1)
    upper, lower = within((data >= 65) & (data <= 90), low, high), within((data >= 97) & (data <= 122), low, high)
    filled = np.bincount(lines.row, lines.words > 0, len(low))
    ends = np.bincount(lines.row, lines.features[:, 8], len(low))
    again = np.bincount(lines.row, lines.features[:, 7] * lines.words, len(low))
    length = lines.word_chars / n
    found = find_words(data, offsets, SPACED)
    ids, _ = found.numbered()
    odd = _is(data, SYMBOLS + b"!")
    odd_words = within(within(odd, found.starts, found.ends) > 0, found.rows[:-1], found.rows[1:])
    letter = (data >= 128) | (((data | 32) >= 97) & ((data | 32) <= 122))
    letters = within(letter, low, high) / np.maximum(within(found.mask, low, high), 1)
    doc = np.repeat(np.arange(len(low)), found.counts)
    kinds = np.bincount(np.unique(doc * (int(ids.max(initial=0)) + 1) + ids) // (int(ids.max(initial=0)) + 1), minlength=len(low))
    # How far the number of distinct words is below what a text of this length has.
    variety = kinds / np.maximum(n, 1) ** 0.75

    def vote(value: np.ndarray, good: float, bad: float) -> np.ndarray:
        """Good up to one bound, bad from the other on."""
        return np.where(value >= bad, BAD, np.where(value <= good, GOOD, NOTHING))

    out = np.stack([
        vote(lines.n_symbols / n, 0.02, 0.3), vote(lines.n_repeat_words / n, 0.15, 0.5), vote(np.abs(length - 5.5), 2, 4),
        vote(1 - ends / np.maximum(filled, 1), 0.4, 0.8), vote(upper / np.maximum(upper + lower, 1), 0.1, 0.4),
        vote(-lines.n_words, -100, -30), vote(within(data == 124, low, high) / n, 0, 0.2), vote(again / n, 0.05, 0.3),
        vote(within(data == 33, low, high) / n, 0.02, 0.2), vote(odd_words / n, 0.05, 0.3), vote(1 - letters, 0.06, 0.12),
        vote(-variety, -1, -0.5)], 1)
    out[lines.n_words == 0] = BAD
    return out


def pattern_posterior(patterns: dict[str, int]) -> dict[str, float]:
    """EM over counted vote patterns (one digit per labeller): the probability of good for each."""
    if not patterns:
        return {}
    names = sorted(patterns)
    table = np.array([[int(c) for c in p] for p in names])
    weight = np.array([patterns[p] for p in names], float)
    hot = np.eye(3)[table]  # patterns, labellers, votes
    bad = (table == BAD).sum(axis=1)
    # Two labellers that say bad make the first guess; EM takes it from there.
    p = 1 / (1 + np.exp(-(4.5 - 3.0 * bad)))
    for _ in range(ROUNDS):
        share = (weight * p).sum() / weight.sum()
        rate = [np.log((np.einsum("p,plv->lv", weight * q, hot) + PRIOR) / ((weight * q).sum() + 3 * PRIOR)) for q in (1 - p, p)]
        share = np.clip(share, 1e-6, 1 - 1e-6)
        odds = np.log(share / (1 - share)) + np.einsum("plv,lv->p", hot, rate[1] - rate[0])
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return dict(zip(names, p.tolist()))


def accuracies(patterns: dict[str, int], posterior: dict[str, float]) -> dict[str, float]:
    """Estimated share of right votes among the votes that each labeller gave."""
    out = {}
    for i, name in enumerate(LABELLERS):
        right = sum(n * (posterior[p] if p[i] == str(GOOD) else 1 - posterior[p]) for p, n in patterns.items() if p[i] != str(NOTHING))
        given = sum(n for p, n in patterns.items() if p[i] != str(NOTHING))
        out[name] = right / given if given else 0.0
    return out


_KIND = bytes(97 if c >= 128 or 97 <= c <= 122 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


def _shape(word: bytes) -> bytes:
    """Letters to a or A, digits to 0, other ASCII as it is; runs once."""
    return _RUN.sub(rb"\1", word.translate(_KIND))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each word (word, shape, shape after a word and its equal), words before each text, words per text."""
    found = find_words(data, offsets, SPACED)
    ids, words = found.numbered()
    words = words.to_pylist()
    h = zlib.crc32
    word = np.array([h(w) & (BUCKETS - 1) for w in words], np.int64)
    shapes = [_shape(w) for w in words]
    shape = np.array([h(s, 1) & (BUCKETS - 1) for s in shapes], np.int64)
    twice = np.array([h(s, 2) & (BUCKETS - 1) for s in shapes], np.int64)
    same = np.zeros(len(ids), bool)
    same[1:] = ids[1:] == ids[:-1]
    if not len(ids):
        return np.zeros((0, 3), np.int64), found.rows, found.counts
    return np.stack([word[ids], shape[ids], np.where(same, twice[ids], shape[ids])], 1), found.rows, found.counts


def _mean(weights: np.ndarray, buckets: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(weights[buckets].sum(axis=1))])
    return (total[rows[1:]] - total[rows[:-1]]) / np.maximum(counts, 1)


def fit_scorer(texts: list[str], posterior: np.ndarray, seed: int = 3) -> np.ndarray:
    """Logistic regression on mean hashed features; the last weight is the intercept."""
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    buckets, rows, counts = features(np.frombuffer(b"".join(raw), np.uint8), offsets)
    weights, squares = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-4)
    # Both classes weigh alike, so that the few bad texts count.
    good = max(posterior.sum(), 1e-9) / len(posterior)
    balance = posterior / (2 * good) + (1 - posterior) / (2 * max(1 - good, 1e-9))
    random = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        turn = random.permutation(len(texts))
        for i in range(0, len(turn), 64):
            batch = turn[i:i + 64]
            at = np.concatenate([np.arange(rows[d], rows[d + 1]) for d in batch])
            of = np.repeat(np.arange(len(batch)), counts[batch])
            size = np.maximum(counts[batch], 1)
            z = np.bincount(of, weights[buckets[at]].sum(axis=1), len(batch)) / size + weights[BUCKETS]
            slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - posterior[batch]) * balance[batch] / len(batch)
            g = np.bincount(buckets[at].ravel(), np.repeat((slope / size)[of], 3), BUCKETS + 1)
            g[BUCKETS] = slope.sum()
            used = np.flatnonzero(g)
            squares[used] += g[used] ** 2
            weights[used] -= RATE * g[used] / np.sqrt(squares[used])
    return weights


def score(documents: DataFrame, sample: int = SAMPLE, text: str = "text") -> DataFrame:
    """One row per document: ``doc`` (the input row), ``votes`` (a digit per labeller: 0 bad, 1 good, 2 nothing),
    ``posterior`` (of good, by the votes), ``score`` (by the fitted scorer, 0 to 1) and ``kept`` (score 0.5 or more).

    Null, empty and blank texts get bad votes only and score 0. Where all sampled texts are alike the scorer says so
    of every text. Repeated rows get equal results and count as often in the patterns; an empty table gives none.
    """
    context = documents.sparkSession.sparkContext
    rows = documents.select(F.struct("*").alias("doc"))
    texts = documents.select(F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for _, data, offsets in blocks(batches, "text"):
            for p, n in zip(*np.unique(_digits(votes(data, offsets)), return_counts=True)):
                seen[str(p)] = seen.get(str(p), 0) + int(n)
        yield pa.RecordBatch.from_pydict({"votes": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    # At most 3 ^ 12 patterns, whatever the number of documents.
    patterns = {r[0]: r[1] for r in map_arrow(texts, count, "votes string, n bigint").groupBy("votes").agg(F.sum("n")).collect()}
    posterior = pattern_posterior(patterns)
    chosen = text_sample(texts, sample, SAMPLE_CHARS, pieces=False).texts
    weights = np.zeros(BUCKETS + 1)
    if chosen:
        raw = [t.encode() for t in chosen]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        marks = _digits(votes(np.frombuffer(b"".join(raw), np.uint8), offsets))
        weights = fit_scorer(chosen, np.array([posterior[str(p)] for p in marks]))
    sent = context.broadcast((posterior, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        posterior, weights = sent.value
        for part, data, offsets in blocks(batches, f"doc.{text}"):
            marks = _digits(votes(data, offsets))
            buckets, before, counts = features(data, offsets)
            z = _mean(weights, buckets, before, counts) + weights[BUCKETS]
            p = np.where(counts > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(marks.tolist(), pa.string()), pa.array([posterior[m] for m in marks.tolist()], pa.float64()), pa.array(p),
                 pa.array(p >= 0.5)], ["doc", "votes", "posterior", "score", "kept"])

    shape = rows.select("doc", F.lit("").alias("votes"), F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score"), F.lit(True).alias("kept")).schema
    return map_arrow(rows, run, shape)


def _digits(table: np.ndarray) -> np.ndarray:
    """Votes as strings."""
    return np.array(["".join(map(str, row)) for row in table.tolist()], dtype=f"U{len(LABELLERS)}")
