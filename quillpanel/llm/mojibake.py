"""Problem 10: garbled text from wrong character encoding.

The sequences that correct characters turn into are computed beforehand for every pair of (UTF-8, wrong encoding),
once and twice over, and matched with a multi-pattern automaton. Only matched spans are replaced, so correct text
between them stays as it is. Arabic words of the single-byte encoding that were read as Latin are matched as words. A text whose damage has lost characters (replacement characters, question marks in
place of letters, sequences whose invisible members were dropped) is reported as lost.

Texts without any sign that can start a garbled sequence are told apart JVM-side; only the rest goes to Python.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillpanel.session import qcol

# Encodings that UTF-8 text gets read in by mistake, the commonest first (ties go to the first).
WRONG_ENCODINGS = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1256", "mac_roman", "cp437", "cp850", "cp1253", "cp1254", "koi8-r", "iso8859-15", "cp1255", "cp1257", "cp866")
# Encodings that are applied twice in practice.
TWICE = ("cp1252", "latin-1")
# The characters a text can have lost to a wrong encoding, as ranges of code points.
REPERTOIRE = ((0xA0, 0x180), (0x386, 0x3CF), (0x410, 0x450), (0x5D0, 0x5EB), (0x60C, 0x60D), (0x61B, 0x61C), (0x61F, 0x653), (0x660, 0x6D3), (0x2010, 0x2040), (0x20AC, 0x20AD), (0x2116, 0x2117), (0x2122, 0x2123), (0x2190, 0x2194), (0x2212, 0x2213), (0x2600, 0x2700), (0x3041, 0x3100), (0x1F300, 0x1F650), (0x1F680, 0x1F700), (0x1F900, 0x1FA00))
# Signs that correct Arabic text itself puts beside each other.
_ARABIC_OWN = re.compile(r"^[ء-ْ،؛؟«» ]+$")
_SENTENCE_END = re.compile(r"[.!?؟\n]")
_C1 = re.compile("[\x80-\x9f]")
# A question mark that stands for a letter: between two, or before one where a word begins
_REPLACED = re.compile(r"(?<=[^\W\d_])\?(?=[^\W\d_])|(?<!\S)\?(?=[^\W\d_])")
_ADDRESS = re.compile(r"\S*(?://|www\.|\?\w+=)\S*")


class _Lost(str):
    """What ``restore`` returns for a text that can't be had back; told apart from a text of these letters by its class."""


LOST = _Lost("lost")

Chain = tuple[str, ...]


def _table(encoding: str) -> list[str]:
    """The character of each byte; bytes an encoding leaves open pass through, as lenient readers do."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


def garbled(text: str, chain: Chain) -> str:
    for encoding in chain:
        table = _tables()[encoding]
        text = "".join(table[b] for b in text.encode())
    return text


@lru_cache(1)
def _tables() -> dict[str, list[str]]:
    return {e: _table(e) for e in WRONG_ENCODINGS}


@lru_cache(1)
def sequences() -> dict[str, dict[Chain, str]]:
    """Garbled sequence to the chains of wrong encodings that make it, each with the character it was."""
    chains: list[Chain] = [(e,) for e in WRONG_ENCODINGS] + [(a, b) for a in TWICE for b in TWICE]
    out: dict[str, dict[Chain, str]] = {}
    for chain in chains:
        for first, end in REPERTOIRE:
            for code in range(first, end):
                out.setdefault(garbled(chr(code), chain), {})[chain] = chr(code)
    return out


@lru_cache(1)
def _automaton():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for sequence, origins in sequences().items():
        machine.add_word(sequence, (sequence, origins))
    machine.make_automaton()
    return machine


@lru_cache(1)
def _leads() -> frozenset[str]:
    """Signs that lenient single-byte readings give for the first byte of a UTF-8 sequence (Latin readings)."""
    return frozenset(_tables()["latin-1"][b] for b in (*range(0xC2, 0xE0), 0xE2))


def _class(signs: set[str]) -> str:
    """A character class of ranges: the engine tests few ranges faster than many single signs."""
    codes, out = sorted(map(ord, signs)), []
    for c in codes:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "[" + "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in out) + "]"


def suspicious(text: Column) -> Column:
    """What every damaged text has: a sign that starts a garbled sequence, followed by another non-ASCII sign, a Latin
    reading of a lead byte, a replacement character, or a question mark in place of a letter."""
    starts = _class({s[0] for s in sequences()})
    lone = _class({*_leads(), "\ufffd"})
    return (F.contains(text, F.lit("?")) & text.rlike(r"\?(?<=(?:\p{L}|\s|^)\?)\p{L}")) | text.rlike(f"{starts}[^\\x00-\\x7f]|{lone}")


def _spans(text: str) -> list[tuple[int, int, dict[Chain, str]]]:
    """Matches, leftmost and longest. One made of signs that correct Arabic text has as well counts only in a token
    that is garbled throughout, in a text with less doubtful damage of the same encoding."""
    found = [(end - len(s) + 1, end + 1, origins) for end, (s, origins) in _automaton().iter_long(text)]
    doubtful = [bool(_ARABIC_OWN.match(text[start:end])) for start, end, _ in found]
    if not any(doubtful):
        return found
    sure = set().union(*(origins for (_, _, origins), d in zip(found, doubtful, strict=True) if not d))
    covered = bytearray(len(text))
    for start, end, _ in found:
        covered[start:end] = b"\x01" * (end - start)

    def alone(start: int, end: int) -> bool:
        while start > 0 and text[start - 1] not in " \t\r\n":
            start -= 1
        while end < len(text) and text[end] not in " \t\r\n":
            end += 1
        return all(covered[i] or text[i] < "\x80" for i in range(start, end))

    return [m for m, d in zip(found, doubtful, strict=True) if not d or (sure & set(m[2]) and alone(m[0], m[1]))]


# What a text shows when the invisible half of a sequence was dropped. None of it is correct English
# or French: a lead sign with part of its followers, a capital lead sign inside a word in small letters or at its
# start, a lone lead sign, a dash, a quote or an apostrophe turned into a lone lead sign.
_HOLES = re.compile(
    "â[\u00a0-\u00bf]"
    "|(?<=[a-zà-ÿ])[ÃÅÄÐÙÚ](?![A-Z])|(?<![^\\W\\d_])[ÃÅ](?=[a-z])|(?<!\\S)Ã(?=[ \\n][a-z])"
    "|(?<!\\S)â(?!\\S)|[,.;:!?…»]â(?!\\w)|(?<!\\w)â\\w+â(?!\\w)"
    "|(?<!\\w)(?:[cdjlmns]|qu|jusqu|lorsqu|puisqu)â(?=[aeiouyhéèêœAEIOUYHÉ])"
)
# the same at the end of a word in small letters; in texts without capitals a name can end so
_END_HOLES = re.compile(_HOLES.pattern + "|(?<!\\w)[a-z]{2,}âs?(?!\\w)")


def _holes(text: str, spans: list[tuple[int, int, dict[Chain, str]]]) -> bool:
    """Whether a text has incomplete sequences: lead signs whose invisible followers were dropped.

    Besides what no correct text has, a lead sign counts in a sentence that has garbled sequences of the same
    reading and no correct non-ASCII letter."""
    if _C1.search(text):
        return False
    covered = bytearray(len(text))
    for start, end, _ in spans:
        covered[start:end] = b"\x01" * (end - start)
    for m in (_HOLES if text == text.lower() else _END_HOLES).finditer(text):
        if not any(covered[m.start() : m.end()]):
            return True
    if not any(c in origins for _, _, origins in spans for c in (("latin-1",), ("cp1252",))):
        return False
    leads = _leads()
    ends = [m.end() for m in _SENTENCE_END.finditer(text)] + [len(text)]
    start = 0
    for stop in ends:
        touched = correct = lone = False
        for i in range(start, stop):
            if covered[i]:
                touched = True
            elif text[i] in leads:
                lone = True
            elif text[i] > "\x7f":
                correct = True
        if touched and lone and not correct:
            return True
        start = stop
    return False


@lru_cache(1)
def _arabic_bytes() -> dict[str, str]:
    """Latin reading of each letter of the Arabic single-byte encoding to that letter (and of its three marks)."""
    out = {}
    for b in range(0xA1, 0x100):
        letter, latin = bytes([b]).decode("cp1256"), bytes([b]).decode("cp1252")
        if "\u0621" <= letter <= "\u0652" or letter in "،؛؟":
            out[latin] = letter
    return out


_TOKEN = re.compile(r"\S+")


def _single_byte_arabic(text: str) -> str | None:
    """The text with its Arabic words back that were written in the single-byte encoding and read as Latin; None
    without such words. A word counts if all its letters are readings of Arabic ones and at least two are; the text
    counts if at least two of its words have the commonest letters."""
    back = _arabic_bytes()
    if not any(c in text for c in "Çá"):
        return None
    shared = "àâçèéêëîïôùûü"

    def garbled_word(token: str) -> bool:
        letters = [c for c in token if c.isalpha()]
        return len(letters) >= 2 and all(c in back or c in shared for c in letters) and sum(c in back for c in letters) >= 2

    words = [m for m in _TOKEN.finditer(text) if garbled_word(m[0])]
    if sum("Ç" in m[0] or "á" in m[0] for m in words) < 2:
        return None
    whole = {m.start() for m in words}
    out, at, near = [], 0, False
    for m in _TOKEN.finditer(text):
        if m.start() in whole:
            near = True
        elif not (near and len([c for c in m[0] if c.isalpha()]) <= 1 and all(c in back or not c.isalpha() for c in m[0])):
            near = False
        if near:
            out += [text[at : m.start()], "".join(back.get(c, c) for c in m[0])]
            at = m.end()
    return "".join([*out, text[at:]])


def _replaced(text: str) -> bool:
    """Whether a question mark stands for a letter. Those of addresses don't."""
    if "?" not in text or not _REPLACED.search(text):
        return False
    return bool(_REPLACED.search(_ADDRESS.sub(" ", text)))


def restore(text: str | None) -> str | None:
    """The text before the damage; ``LOST`` if a character cannot be had back; None for an undamaged text.

    None, empty and blank texts are undamaged. Texts of any length are read whole, in linear time. Where a
    sequence has several origins, the chain of encodings that explains most of the text decides."""
    if not text:
        return None
    if "�" in text or _replaced(text):
        return LOST
    if text.isascii():
        return None
    arabic = _single_byte_arabic(text)
    if arabic is not None:
        text = arabic
    spans = _spans(text)
    if _holes(text, spans):
        return LOST
    if not spans:
        return arabic
    votes: Counter[Chain] = Counter()
    for _, _, origins in spans:
        votes.update(origins.keys())
    rank = {chain: i for i, chain in enumerate(sorted(votes, key=lambda c: (-votes[c], len(c), WRONG_ENCODINGS.index(c[0]))))}
    out, at = [], 0
    for start, end, origins in spans:
        out += [text[at:start], origins[min(origins, key=rank.__getitem__)]]
        at = end
    return "".join([*out, text[at:]])


def restored_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, restored, lost): one row for each damaged text; ``restored`` is the original, NULL where it is lost.

    NULL, empty and blank texts give no row, nor do plain ASCII ones without question marks inside words; equal rows each give theirs; an empty table gives none;
    only ``key`` and ``text`` are read."""
    kind = dict(df.dtypes)[key]
    odd = df.select(qcol(key).alias("k"), qcol(text).alias("t")).filter(suspicious(F.col("t")))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(k, None if isinstance(r, _Lost) else r, isinstance(r, _Lost)) for k, r in zip(batch["k"], map(restore, batch["t"]), strict=True) if r is not None]
            yield pd.DataFrame(out, columns=["k", "restored", "lost"])

    return odd.mapInPandas(work, f"k {kind}, restored string, lost boolean").withColumnRenamed("k", key)
