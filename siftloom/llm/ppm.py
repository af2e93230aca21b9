"""Language identification by partial matching: code lengths under one byte context tree per language.

The tree of a language holds the contexts of up to 3 bytes that its sample has. A byte costs -log2 of its share in
the longest context known; where a context lacks it, the escape of that context is paid and the next shorter one is
asked (method C), down to all bytes alike. The trees are frozen, so the code length of a text is a sum over its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.llm.samples import text_sample
from siftloom.llm.store import map_arrow
from siftloom.llm.words import blocks

ORDER = 3
#: Texts of each language used for fitting, about so many, and the longest one used. All texts are scored whole.
SAMPLE, SAMPLE_CHARS = 600, 20_000
BLOCK, CELLS = 1_000_000, 4_000_000
UNKNOWN = "und"


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes up to each byte of each text, ``ORDER`` before it (line ends before the text), as numbers; offsets."""
    n = len(offsets) - 1
    out = np.full(len(data) + ORDER * n, 10, np.uint32)
    place = np.arange(len(data)) + ORDER * np.repeat(np.arange(1, n + 1), np.diff(offsets))
    out[place] = data
    gram = np.zeros(len(data), np.uint32)
    for j in range(ORDER, -1, -1):
        gram = (gram << np.uint32(8)) | out[place - j]
    return gram, offsets


class Trees:
    """Frozen statistics: costs in bits of every known string of 1 .. ``ORDER`` + 1 bytes in every language."""

    def __init__(self, texts: dict[str, list[str]]):
        self.langs = sorted(texts)
        grams = {}
        for lang in self.langs:
            raw = [t.encode() for t in texts[lang]]
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
            grams[lang] = _grams(np.frombuffer(b"".join(raw), np.uint8), offsets)[0]
        self.known, self.cost, self.context, self.escape = [], [], [], []
        for k in range(1, ORDER + 2):
            mask = np.uint32((1 << 8 * k) - 1)
            counts = {lang: np.unique(g & mask, return_counts=True) for lang, g in grams.items()}
            known = np.unique(np.concatenate([c[0] for c in counts.values()]))
            context = known >> np.uint32(8)
            contexts, at = np.unique(context, return_inverse=True)
            cost = np.zeros((len(known), len(self.langs)))
            escape = np.zeros((len(contexts), len(self.langs)))
            lower = self._lookup(known & np.uint32((1 << 8 * (k - 1)) - 1), k - 2) if k > 1 else np.full(cost.shape, 8.0)
            for j, lang in enumerate(self.langs):
                count = np.zeros(len(known))
                count[np.searchsorted(known, counts[lang][0])] = counts[lang][1]
                total = np.bincount(at, count, len(contexts))
                kinds = np.bincount(at, count > 0, len(contexts))
                seen = total > 0
                escape[seen, j] = -np.log2(kinds[seen] / (total + kinds)[seen])
                has = count > 0
                cost[has, j] = -np.log2(count[has] / (total + kinds)[at[has]])
                cost[~has, j] = escape[at[~has], j] + lower[~has, j]
            # Multiples of 2^-16 bit: sums are exact in any order.
            self.known.append(known)
            self.cost.append(np.round(cost * 65536) / 65536)
            self.context.append(contexts)
            self.escape.append(np.round(escape * 65536) / 65536)

    def _lookup(self, gram: np.ndarray, k: int) -> np.ndarray:
        """Cost of the last byte of strings of k + 1 bytes."""
        known = self.known[k]
        at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
        out = self.cost[k][at]
        miss = np.flatnonzero(known[at] != gram)
        if len(miss):
            gram = gram[miss]
            context = gram >> np.uint32(8)
            at = np.minimum(np.searchsorted(self.context[k], context), len(self.context[k]) - 1)
            paid = np.where((self.context[k][at] == context)[:, None], self.escape[k][at], 0)
            out[miss] = paid + (self._lookup(gram & np.uint32((1 << 8 * k) - 1), k - 1) if k else 8.0)
        return out

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of each text in each language."""
        gram, offsets = _grams(data, offsets)
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        step = max(1, CELLS // len(self.langs))
        for a in range(0, len(gram), step):
            b = min(a + step, len(gram))
            total = np.cumsum(self._lookup(gram[a:b], ORDER), axis=0)
            total = np.concatenate([np.zeros((1, len(self.langs))), total])
            low, high = np.searchsorted(offsets, a, side="right") - 1, np.searchsorted(offsets, b, side="left")
            edge = np.clip(offsets[low:high + 1], a, b) - a
            out[low:high] += total[edge[1:]] - total[edge[:-1]]
        return out


def train(texts: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Fit on columns ``text`` and ``lang``, about ``sample`` distinct texts of a language chosen by a hash; rows without
    either, and empty texts, are left out. None if nothing is left."""
    chosen = text_sample(texts.where("text != ''"), sample, SAMPLE_CHARS, "lang")
    found: dict[str, list[str]] = {}
    for lang, text in zip(chosen.labels, chosen.texts):
        found.setdefault(lang, []).append(text)
    return Trees(found) if found else None


def predict(documents: DataFrame, trees: Trees | None, text: str = "text") -> DataFrame:
    """One row per document: ``doc`` (the input row), ``lang_pred``, ``score`` and ``bits`` (code length per language,
    in the order of the names).

    ``lang_pred`` has the shortest code (the first name among equal ones), ``score`` its share of the probability. Texts
    that are null or have no letter are ``und`` with score 0, as all are when nothing was learned. Repeated rows get
    equal results; an empty table gives none.
    """
    sent = documents.sparkSession.sparkContext.broadcast(trees)
    rows = documents.select(F.struct("*").alias("doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        for part, data, offsets in blocks(batches, f"doc.{text}", BLOCK):
            n = len(offsets) - 1
            ascii_letters = np.concatenate([[0], np.cumsum(((data | 32) >= 97) & ((data | 32) <= 122))])
            letters = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
            for i in np.flatnonzero(~letters & (offsets[1:] > offsets[:-1])).tolist():
                letters[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode())
            bits = trees.lengths(data, offsets) if trees else np.zeros((n, 1))
            best = bits.argmin(axis=1)
            share = 1 / np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000)).sum(axis=1)
            known = letters & (trees is not None)
            names = np.array(trees.langs if trees else [UNKNOWN], object)[best]
            names[~known] = UNKNOWN
            lists = pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * bits.shape[1]).astype(np.int32)), pa.array(bits.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names.tolist(), pa.string()), pa.array(np.where(known, share, 0.0)), lists],
                                             ["doc", "lang_pred", "score", "bits"])

    shape = rows.select("doc", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.array(F.lit(0.0)).alias("bits")).schema
    return map_arrow(rows, run, shape)
