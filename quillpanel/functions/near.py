"""Texts within some edits of each other, or one in the other, among all pairs of two lists: by whole arrays.

Letters are taken by the last five bits of their code point, which can only lessen a distance and keeps ASCII letters
apart but for their case; so what is found holds all that matches, and hardly more."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np

_WORD = 64  # letters of a text that fit one machine word; longer texts are compared by their letters' counts only
_PAIRS = 1 << 20  # compared at a time
_BLANK = re.compile(r"[ \t\n\x0b\f\r\0]+")


def without_blanks(text: str) -> str:
    """As in ``text.without_blanks``; NUL signs are left out, too, which can only lessen a distance."""
    return _BLANK.sub("", text)


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters as numbers, and which places of the array are letters; texts beyond a word are empty."""
    points = np.array([t if len(t) <= _WORD else "" for t in texts], dtype=f"<U{_WORD}").view(np.uint32).reshape(len(texts), _WORD)
    return (points & 31).astype(np.uint8), points != 0


def _letters(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two words for each text, with a bit for each of the first four uses of a letter; how many bits are set."""
    codes, there = _codes(texts)
    counts = np.bincount((codes + np.arange(len(texts))[:, None] * 32)[there], minlength=32 * len(texts)).reshape(-1, 32)
    for i, t in enumerate(texts):
        if len(t) > _WORD:
            counts[i] = np.bincount(np.frombuffer(t.encode("utf-32-le"), np.uint32) & 31, minlength=32)
    words = np.zeros((2, len(texts)), np.uint64)
    for use in range(4):
        words[use // 2] |= ((counts > use) << (np.arange(32, dtype=np.uint64) + np.uint64(32 * (use % 2)))).sum(axis=1, dtype=np.uint64)
    return words, np.bitwise_count(words).sum(axis=0, dtype=np.uint8)


def _edits(places: np.ndarray, sizes: np.ndarray, codes: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Levenshtein distance of the pairs (i, j), a bit for each letter of the first text (Myers, Hyyrö)."""
    order = np.argsort(-lengths[j], kind="stable")
    at, other, size = i[order].astype(np.int64) * 32, j[order], lengths[j[order]]
    score = sizes[i[order]].astype(np.int32)
    last = np.uint64(1) << (score - 1).astype(np.uint64)
    plus, minus, one = np.full(len(at), ~np.uint64(0)), np.zeros(len(at), np.uint64), np.uint64(1)
    flat = places.ravel()
    for step in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -step, side="left"))  # the pairs whose second text is longer than step
        p, m = plus[:n], minus[:n]
        equal = flat[at[:n] + codes[other[:n], step]]
        across = (((equal & p) + p) ^ p) | equal
        up, down = m | ~(across | p), p & across
        score[:n] += ((up & last[:n]) != 0).astype(np.int32) - ((down & last[:n]) != 0)
        up, below = (up << one) | one, equal | m
        plus[:n] = (down << one) | ~(below | up)
        minus[:n] = up & below
    out = np.empty(len(at), np.int32)
    out[order] = score
    return out


def near_pairs(left: Sequence[str], left_low: Sequence[str], right: Sequence[str], right_low: Sequence[str], tolerance: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of pairs that can match by ``text.close_names``: all that do, and hardly others.

    left_low, right_low: the texts without blanks and in lower case. The counts of letters, which a few edits hardly
    change, leave few pairs; of these the distance is computed."""
    if not len(left) or not len(right):
        return
    bare_l, bare_r = [without_blanks(t) for t in left], [without_blanks(t) for t in right]
    (wl, tl), (wr, tr) = _letters(bare_l), _letters(bare_r)
    plain = all(t.isascii() for t in bare_l) and all(t.isascii() for t in bare_r)  # then case changes no letter's number
    low_l, low_r = [t.replace("\0", "") for t in left_low], [t.replace("\0", "") for t in right_low]
    (vl, ul), (vr, ur) = ((wl, tl), (wr, tr)) if plain else (_letters(low_l), _letters(low_r))
    allowed = lambda texts: np.ceil(np.array([len(t) for t in texts]) * tolerance).astype(np.int64)
    kl, kr = allowed(left), allowed(right)
    ml, mr = (np.minimum(k, 127).astype(np.uint8) for k in (kl, kr))
    nl, nr = (np.array([len(t) for t in b]) for b in (bare_l, bare_r))
    codes_l, there_l = _codes(bare_l)
    codes_r, _ = _codes(bare_r)
    places = np.zeros((len(left), 32), np.uint64)
    for p in range(_WORD):
        rows = np.nonzero(there_l[:, p])[0]
        places[rows, codes_l[rows, p]] |= np.uint64(1) << np.uint64(p)
    common = lambda a, b, at: np.bitwise_count(a[0, at, None] & b[0]) + np.bitwise_count(a[1, at, None] & b[1])
    wide = max(1, _PAIRS // len(right))
    for start in range(0, len(left), wide):
        at = slice(start, start + wide)
        shared = common(wl, wr, at)
        near = shared + np.maximum(ml[at, None], mr) >= np.maximum(tl[at, None], tr)
        held = (shared if plain else common(vl, vr, at)) == np.minimum(ul[at, None], ur)
        i, j = np.nonzero(near | held)
        close, inside = near[i, j], held[i, j]
        i += start
        most = np.maximum(kl[i], kr[j])
        close &= np.abs(nl[i] - nr[j]) <= most
        short = np.nonzero(close & (nl[i] <= _WORD) & (nr[j] <= _WORD) & (nl[i] > 0))[0]
        close[short] = _edits(places, nl, codes_r, nr, i[short], j[short]) <= most[short]
        for p in np.nonzero(inside & ~close)[0]:
            a, b = low_l[i[p]], low_r[j[p]]
            close[p] = a in b or b in a
        yield i[close], j[close]
