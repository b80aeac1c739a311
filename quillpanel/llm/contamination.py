"""Problem 8: evaluation texts leaking into training text.

Windows as long as the passages searched for are fingerprinted with SimHash over their five-word shingles. The
fingerprints are indexed in radius + 1 blocks of bits, so two within the radius agree in at least one block
(pigeonhole): no window within the radius is missed. Candidates are verified exactly: by the words themselves, or
by weighted-shingle similarity. Equal windows have equal fingerprints, but no small radius follows from a similarity
below 1: such windows are found by the shingles they share, so that none is missed either (prefix filter: without its
rarest shingles, that weigh more than 1 - similarity of it, a window could not be similar enough).

The test items are a stated query set, compared with all documents in one pass: their fingerprints go to every
executor in blocks of a checked size, the documents are never shuffled before results, and long documents are
windowed in overlapping pieces, so memory is bounded.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillpanel.session import qcol

SHINGLE = 5
BITS = 64
_WORD = re.compile(r"[^\W_]+")


@lru_cache(1)
def _marks() -> re.Pattern[str]:
    codes = [c for c in range(0x300, 0x20F1) if unicodedata.category(chr(c))[0] == "M"]
    return re.compile("[" + "".join(map(chr, codes)) + "︠-︯]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, without case and accents."""
    if not text:
        return []
    plain = text if text.isascii() else _marks().sub("", unicodedata.normalize("NFKD", text))
    return _WORD.findall(plain.lower())


class WordHashes(dict):
    """64-bit hashes of words, each computed once in a process; cleared when it grows past a million words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = WordHashes()


def word_hashes(words: Sequence[str]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_hashes(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """One hash for each run of ``size`` words."""
    n = len(hashes) - size + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(size):
        out = _mix(out * np.uint64(0x100000001B3) + hashes[i : i + n]) if n > 0 else out
    return out


def window_fingerprints(shingles: np.ndarray, span: int) -> np.ndarray:
    """SimHash of every run of ``span`` shingles, from running sums of the shingles' bits as +1 and -1."""
    n = len(shingles) - span + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
    sums = np.zeros((len(shingles) + 1, BITS), dtype=np.int32)
    np.cumsum(2 * bits - 1, axis=0, out=sums[1:])
    sign = (sums[span:] - sums[:-span]) > 0
    return np.packbits(sign, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints_at(shingles: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """SimHash of the runs of ``span`` shingles that begin ``at``."""
    if len(at) * span > len(shingles):
        return window_fingerprints(shingles, span)[at]
    out = [window_fingerprints(shingles[rows[:, None] + np.arange(span)].reshape(-1), span)[::span] for rows in np.array_split(at, len(at) // 20_000 + 1) if len(rows)]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _before(shingles: np.ndarray) -> np.ndarray:
    """Where each shingle last occurred before, -1 if nowhere."""
    order = np.argsort(shingles, kind="stable")
    again = np.append(False, shingles[order][1:] == shingles[order][:-1])[: len(order)]
    out = np.full(len(shingles), -1, dtype=np.int64)
    out[order[again]] = order[np.nonzero(again)[0] - 1]
    return out


def _window_sums(weight: np.ndarray, before: np.ndarray, span: int) -> np.ndarray:
    """The weight of the different shingles of each run of ``span``, by where the run begins."""
    if len(weight) < span:
        return np.zeros(0)
    views = np.lib.stride_tricks.sliding_window_view
    out = np.zeros(len(weight) - span + 1)
    for rows in np.array_split(np.arange(len(out)), len(out) // 20_000 + 1):
        new = views(before, span)[rows] < rows[:, None]
        out[rows] = np.where(new, views(weight, span)[rows], 0.0).sum(axis=1)
    return out


@dataclass
class ItemIndex:
    """Windows of the test items: their fingerprints in radius + 1 sorted blocks, their words' hashes, their items."""

    window: int
    radius: int
    prints: np.ndarray
    words: np.ndarray  # windows x window
    item: np.ndarray
    weights: dict[int, float]
    shingles: np.ndarray | None = None  # of all items, one after the other
    start: np.ndarray | None = None  # of each window among them

    @property
    def shifts(self) -> list[tuple[int, int]]:
        edges = np.linspace(0, BITS, self.radius + 2).astype(int)
        return [(int(a), int(b - a)) for a, b in zip(edges, edges[1:])]

    def possible(self, shingles: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Those of the windows beginning ``at`` that hold no shingle which the items don't have; others equal no
        item's window."""
        spot = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        strange = np.append(0, np.cumsum(self.known[spot] != shingles)) if len(self.known) else np.arange(len(shingles) + 1)
        return at[strange[at + self.window - SHINGLE + 1] == strange[at]]

    def prepare(self) -> ItemIndex:
        self.known = np.unique(self.shingles) if self.shingles is not None else np.zeros(0, np.uint64)
        self.tables = []
        for shift, width in self.shifts:
            key = (self.prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            order = np.argsort(key, kind="stable")
            self.tables.append((shift, width, key[order], order))
        return self

    def prepare_similar(self) -> ItemIndex:
        """For ``similar``: the items' shingles numbered, where each occurs, and each window's weight."""
        self.span = self.window - SHINGLE + 1
        flat = np.zeros(0, np.uint64) if self.shingles is None else self.shingles
        self.start = np.zeros(0, np.int64) if self.start is None else self.start
        self.known, self.number = np.unique(flat, return_inverse=True)
        self.common = float(np.log1p(1))
        self.weight = np.array([self.weights.get(h, self.common) for h in self.known.tolist()] + [self.common])  # the last: of unknown ones
        self.places = np.argsort(self.number, kind="stable")
        self.first = np.searchsorted(self.number[self.places], np.arange(len(self.known) + 1))
        self.before = _before(flat)
        self.total = _window_sums(self.weight[self.number], self.before, self.span)[self.start]
        return self

    def similar(self, shingles: np.ndarray, at: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document window, item window, similarity) of all pairs that are at least so similar, each once, in pieces
        of bounded size. at: where windows begin in the document's shingles."""
        if not len(self.known) or not len(at):
            return
        slack = 1e-9
        spot = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        number = np.where(self.known[spot] == shingles, spot, -1)
        before = _before(shingles)
        weight = self.weight[number]
        total = _window_sums(weight, before, self.span)
        shared = _window_sums(np.where(number >= 0, weight, 0.0), before, self.span)
        at = at[shared[at] >= least * total[at] - slack]
        uses = np.append(np.diff(self.first), 0)
        steps = np.arange(self.span)
        for rows in np.array_split(at, len(at) // 20_000 + 1):
            cells = rows[:, None] + steps
            new = before[cells] < rows[:, None]
            w = np.where(new, weight[cells], 0.0)
            order = np.argsort(uses[number[cells]], axis=1, kind="stable")
            w = np.take_along_axis(w, order, axis=1)
            passed = np.cumsum(w, axis=1) - w
            prefix = (w > 0) & (passed <= (1 - least) * total[rows][:, None] + slack)
            n = np.take_along_axis(number[cells], order, axis=1)
            row, column = np.nonzero(prefix & (n >= 0))
            n = n[row, column]
            cost = np.cumsum(uses[n] * self.span)
            # a document's window is never split over pieces, so that each of its pairs comes once
            cuts = np.searchsorted(cost, np.arange(1_000_000, int(cost[-1]) if len(cost) else 0, 1_000_000))
            for piece in np.split(np.arange(len(row)), np.unique(np.searchsorted(row, row[cuts]))):
                if len(piece):
                    yield from self._verified(rows, row[piece], n[piece], number, before, weight, total, least - slack)

    def _verified(self, rows, row, n, number, before, weight, total, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        count = self.first[n + 1] - self.first[n]
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        place = self.places[np.repeat(self.first[n], count) + offset]
        # the windows that hold this place: they begin up to span - 1 shingles before it
        low, high = np.searchsorted(self.start, place - self.span + 1, "left"), np.searchsorted(self.start, place, "right")
        size = high - low
        window = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        pairs = np.unique(np.repeat(np.repeat(row, count), size) * np.int64(len(self.start)) + window)
        doc, item = rows[pairs // len(self.start)], pairs % len(self.start)
        steps = np.arange(self.span)
        for a, b in zip(np.array_split(doc, len(doc) // 20_000 + 1), np.array_split(item, len(doc) // 20_000 + 1), strict=True):
            left = a[:, None] + steps
            right = self.number[self.start[b][:, None] + steps]
            held = np.zeros(left.shape, dtype=bool)
            ours = number[left]
            for k in range(self.span):
                held |= ours == right[:, k : k + 1]
            both = np.where(held & (before[left] < a[:, None]), weight[left], 0.0).sum(axis=1)
            score = both / (total[a] + self.total[b] - both)
            good = score >= least
            yield a[good], b[good], np.minimum(score[good], 1.0)

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (document window, item window) pairs within the radius, each once."""
        out_d, out_i = [], []
        for shift, width, keys, order in self.tables:
            key = (prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            hit = np.nonzero(high > low)[0]
            for piece in np.array_split(hit, max(1, int((high - low)[hit].sum() // 4_000_000) + 1)) if len(hit) else []:
                size = (high - low)[piece]
                doc = np.repeat(piece, size)
                offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                item = order[np.repeat(low[piece], size) + offset]
                near = np.bitwise_count(prints[doc] ^ self.prints[item]) <= self.radius
                out_d.append(doc[near])
                out_i.append(item[near])
        if not out_d:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        pairs = np.unique(np.stack([np.concatenate(out_d), np.concatenate(out_i)], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]


def index_items(items: list[tuple[int, list[str]]], window: int, radius: int) -> ItemIndex:
    """Items shorter than the window cannot be held by it and have no windows."""
    prints, words, owner, frequency = [], [], [], Counter()
    runs, start, length = [], [], 0
    for item, tokens in items:
        hashes = word_hashes(tokens)
        if len(hashes) < window:
            continue
        shingles = shingle_hashes(hashes)
        frequency.update(set(shingles.tolist()))
        fp = window_fingerprints(shingles, window - SHINGLE + 1)
        prints.append(fp)
        runs.append(shingles)
        start.append(length + np.arange(len(fp)))
        length += len(shingles)
        words.append(np.lib.stride_tricks.sliding_window_view(hashes, window).copy())
        owner.append(np.full(len(fp), item, dtype=np.int64))
    if not prints:
        return ItemIndex(window, radius, np.zeros(0, np.uint64), np.zeros((0, window), np.uint64), np.zeros(0, np.int64), {})
    n = max(1, len(items))
    weights = {s: float(np.log1p(n / c)) for s, c in frequency.items()}
    return ItemIndex(window, radius, np.concatenate(prints), np.concatenate(words), np.concatenate(owner), weights, np.concatenate(runs), np.concatenate(start))


def _similarity(a: np.ndarray, b: np.ndarray, weights: dict[int, float], common: float) -> float:
    """Weighted Jaccard of the two windows' shingles; rare shingles weigh more."""
    left, right = set(shingle_hashes(a).tolist()), set(shingle_hashes(b).tolist())
    w = lambda s: weights.get(s, common)
    union = sum(map(w, left | right))
    return sum(map(w, left & right)) / union if union else 0.0


def find_leaks(
    documents: DataFrame,
    doc_key: str,
    doc_text: str,
    items: DataFrame,
    item_key: str,
    item_text: str,
    *,
    window: int = 12,
    radius: int | None = None,
    min_similarity: float = 1.0,
    max_block_windows: int = 1_000_000,
    max_items: int = 1_000_000,
    piece_words: int = 50_000,
) -> DataFrame:
    """(doc, item, n_windows, similarity): each document with each item that it holds a window of.

    min_similarity 1.0: only windows whose words are all equal, in order. Below: all windows whose weighted five-word
    shingles are that similar. A ``radius`` narrows the search to fingerprints that differ in so many bits; without it
    no window is missed. NULL and short texts hold nothing; repeated rows of a key
    are one document; empty tables give no row. The items are the query set: they come to the driver (a ValueError
    beyond ``max_items``) and go out in blocks of at most ``max_block_windows`` windows; each block is one pass."""
    if window < SHINGLE:
        raise ValueError("a window holds at least one shingle")
    rows = items.select(qcol(item_key).cast("long"), qcol(item_text)).filter(qcol(item_key).isNotNull() & qcol(item_text).isNotNull()).limit(max_items + 1).collect()
    if len(rows) > max_items:
        raise ValueError(f"more than {max_items} items")
    if min_similarity <= 0:
        raise ValueError("windows that share nothing are not searched for")
    complete = radius is None and min_similarity < 1.0
    bits = 3 if radius is None else radius
    spark = documents.sparkSession
    blocks, block, size = [], [], 0
    for item, text in sorted((r[0], r[1]) for r in rows):
        tokens = words_of(text)
        block.append((item, tokens))
        size += max(0, len(tokens) - window + 1)
        if size >= max_block_windows:
            blocks.append(block)
            block, size = [], 0
    blocks = [*blocks, block] if block or not blocks else blocks
    docs = documents.select(qcol(doc_key).cast("long").alias("doc"), qcol(doc_text).alias("t")).filter(F.length("t") > 0)
    found = None
    for one in blocks:
        shared = spark.sparkContext.broadcast(index_items(one, window, bits))
        part = docs.mapInPandas(_searcher(shared, window, min_similarity, piece_words, complete), "doc long, item long, n_windows long, similarity double")
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc", "item").agg(F.max("n_windows").alias("n_windows"), F.max("similarity").alias("similarity"))


def _searcher(shared, window: int, min_similarity: float, piece_words: int, complete: bool):
    def pieces(batch: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
        for doc, text in zip(batch["doc"], batch["t"], strict=True):
            hashes = word_hashes(words_of(text))
            for at in range(0, max(1, len(hashes) - window + 1), piece_words):
                part = hashes[at : at + piece_words + window - 1]
                if len(part) >= window:
                    yield doc, part

    def search(index: ItemIndex, group: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, int, int, float]]:
        span = window - SHINGLE + 1
        hashes = np.concatenate([p for _, p in group])
        ends = np.cumsum([len(p) for _, p in group])
        begins = np.arange(len(hashes) - window + 1)
        owner = np.searchsorted(ends, begins, "right")
        at = np.nonzero(begins + window <= ends[owner])[0]
        hits: dict[tuple[int, int], list] = {}
        if complete:
            for doc_at, item_window, score in index.similar(shingle_hashes(hashes), at, min_similarity):
                for d, i, s in zip(owner[doc_at].tolist(), index.item[item_window].tolist(), score.tolist(), strict=True):
                    hit = hits.setdefault((group[d][0], i), [0, 0.0])
                    hits[group[d][0], i] = [hit[0] + 1, max(hit[1], s)]
            for (doc, item), (n, most) in hits.items():
                yield int(doc), item, n, most
            return
        shingles = shingle_hashes(hashes)
        at = index.possible(shingles, at) if min_similarity >= 1.0 else at
        fp = fingerprints_at(shingles, at, span)
        doc_window, item_window = index.candidates(fp)
        views = np.lib.stride_tricks.sliding_window_view(hashes, window)[at[doc_window]]
        same = (views == index.words[item_window]).all(axis=1)
        score = same.astype(float)
        if min_similarity < 1.0:
            common = float(np.log1p(1))
            for i in np.nonzero(~same)[0]:
                score[i] = _similarity(views[i], index.words[item_window[i]], index.weights, common)
        for d, i, s in zip(owner[at[doc_window]], index.item[item_window], score, strict=True):
            if s >= min_similarity:
                hits.setdefault((group[d][0], int(i)), []).append(float(s))
        for (doc, item), scores in hits.items():
            yield int(doc), item, len(scores), max(scores)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value.prepare_similar() if complete else shared.value.prepare()
        for batch in batches:
            out, group, size = [], [], 0
            for piece in pieces(batch):
                group.append(piece)
                size += len(piece[1])
                if size >= 2 * piece_words:
                    out += search(index, group)
                    group, size = [], 0
            if group:
                out += search(index, group)
            yield pd.DataFrame(out, columns=["doc", "item", "n_windows", "similarity"])

    return work
