"""Problem 2: visually identical text with different characters.

The look-alike table is the public Unicode confusables data, some six thousand characters with their prototypes, as it
comes with every Spark installation (in the ICU library). It is read on the driver and sent along with the functions.

Confusables skeleton: a text is decomposed (with compatibility forms), stripped of what cannot be seen, each
character is replaced by the prototype of the look-alike table, and the result is decomposed again. Texts that
look the same have equal skeletons, and originals are grouped by them. The consistent form of a word is its
prototype sequence written in the word's own alphabet and composed again; its skeleton is that of the original.

Plain texts (composed letters of one alphabet, U+0020, U+002D and ASCII signs) are told apart JVM-side and never
reach Python; the rest goes through one Arrow-batched function.
"""

from __future__ import annotations

import os
import string
import struct
import unicodedata
import zipfile
from collections.abc import Mapping
from functools import lru_cache
from pathlib import Path

import pandas as pd
import pyspark
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillpanel.session import qcol

# Letters that many fonts draw like a Latin one, which the public table keeps apart.
ALSO_ALIKE = {"κ": "k", "Ԛ": "Q", "ӏ": "l"}
# Where letters begin that are drawn like plain Latin ones but belong to phonetic writing, and end.
PHONETIC = ((0x250, 0x2B0), (0x1D00, 0x1DC0))
# Signs drawn like a hyphen or minus.
HYPHENS = "‐‑‒–−﹣－⁃"
_INVISIBLE_OTHERS = "͏ᅟᅠ឴឵ㅤﾠ"

_SHIPPED: dict[str, str] = {}


def _read_confusables() -> dict[str, str]:
    """Character to prototype, from ICU's data file: sorted keys (a code point and the length of its prototype), values
    (a character, or a place in the table of strings), strings."""
    homes = [Path(os.environ["SPARK_HOME"]) if "SPARK_HOME" in os.environ else None, Path(pyspark.__file__).parent]
    jars = sorted(j for home in homes if home for j in home.glob("jars/icu4j-*.jar"))
    if not jars:
        raise RuntimeError("the ICU library isn't among Spark's jars")
    with zipfile.ZipFile(jars[-1]) as jar:
        data = jar.read(next(n for n in jar.namelist() if n.endswith("/confusables.cfu")))
    body = data[struct.unpack(">H", data[:2])[0] :]
    _, _, _, key_at, n, value_at, _, string_at, string_size = struct.unpack(">9I", body[:36])
    keys = struct.unpack(f">{n}I", body[key_at : key_at + 4 * n])
    values = struct.unpack(f">{n}H", body[value_at : value_at + 2 * n])
    text = body[string_at : string_at + 2 * string_size]
    out = {}
    for key, value in zip(keys, values, strict=True):
        units = (key >> 24) + 1
        out[chr(key & 0xFFFFFF)] = chr(value) if units == 1 else text[2 * value : 2 * (value + units)].decode("utf-16-be")
    return out


def prototypes() -> dict[str, str]:
    """The look-alike table: each character to what stands for all that look like it."""
    if not _SHIPPED:
        table = _read_confusables()
        _SHIPPED.update({**table, **{c: table.get(x, x) for c, x in ALSO_ALIKE.items()}})
    return _SHIPPED


def ship_prototypes(table: dict[str, str]) -> None:
    """Take the driver's table, in a process that may lack the library."""
    if not _SHIPPED:
        _SHIPPED.update(table)


@lru_cache(1)
def _alphabets() -> tuple[dict[str, str], dict[str, dict[str, str]]]:
    """Letters to the plain Latin letter they look like, and for each other alphabet Latin letters to its look-alikes.

    Derived from the table: a letter looks like the ASCII letter of its own case that has its prototype. Letters
    without case count where their prototype is a capital, others of such scripts (an Arabic alif, say) are too plain
    to tell."""
    table = prototypes()
    latin = {(table.get(x, x), x.isupper()): x for x in string.ascii_letters}
    to, back = {}, {}
    for c in sorted(table):
        p = table[c]
        phonetic = any(low <= ord(c) < high for low, high in PHONETIC)
        if not c.isalpha() or (_alphabet(c) == "LATIN" and not phonetic) or unicodedata.normalize("NFKD", c) != c:
            continue
        cased = c.isupper() or c.islower()
        plain = latin.get((p, c.isupper() if cased else True))
        if plain is None or (not cased and not p.isupper()):
            continue
        to[c] = plain
        if not phonetic:
            own = back.setdefault(_alphabet(c), {})
            # of several the one whose prototype is written alike, then the first
            own.setdefault(plain, c)
    return to, back


# Texts that already are in the consistent form whatever the context: one alphabet, composed, no look-alikes
_PLAIN = (
    r"^(?:[\x20-\x7eÀ-ÖØ-öø-ıĴ-ľŁ-ňŊ-ž]*"
    r"|[ \-.,'0-9ء-غف-ي]*)$"
)


def _alphabet(letter: str, cache: dict[str, str] = {}) -> str:  # noqa: B006
    found = cache.get(letter)
    if found is None:
        found = cache[letter] = unicodedata.name(letter, "NONE").split(" ")[0].split("-")[0]
    return found


@lru_cache(1)
def _rewrites() -> dict[int, str]:
    return {ord(c): p for c, p in prototypes().items()}


def _visible(text: str) -> str:
    """Decomposed, without compatibility forms, invisible signs gone, one kind of blank and hyphen."""
    out = []
    for c in text:
        category = unicodedata.category(c)
        if category == "Cf" or c in _INVISIBLE_OTHERS or "︀" <= c <= "️":
            continue
        if category in ("Zs", "Zl", "Zp") or c in "\t\n\r\x0b\x0c\x85":
            out.append(" ")
        elif c in HYPHENS:
            out.append("-")
        else:
            out.append(c)
    return "".join(" " if unicodedata.category(c) == "Zs" else c for c in unicodedata.normalize("NFKD", "".join(out)))


def skeleton(text: str) -> str:
    """Equal for texts that look the same."""
    return unicodedata.normalize("NFD", _visible(text).translate(_rewrites()))


def ascii_skeleton(text: Column) -> Column:
    """``skeleton`` of a text of ASCII signs only, JVM-side."""
    pairs = {chr(c): prototypes()[chr(c)] for c in range(0x20, 0x7F) if chr(c) in prototypes()}
    one = {c: p for c, p in pairs.items() if len(p) == 1}
    out = F.translate(text, "".join(one), "".join(one.values()))
    for c, p in pairs.items():
        out = F.replace(out, F.lit(c), F.lit(p)) if len(p) > 1 else out
    return out


def _words(text: str) -> list[str]:
    """Words and the signs between them, in order."""
    out, word = [], ""
    for c in text:
        if c in " -":
            out += [word, c]
            word = ""
        else:
            word += c
    return [*out, word]


def _own_alphabet(word: str) -> str:
    """The alphabet a word is written in: the one that has all its letters, by themselves or by look-alikes.
    '' without letters, '?' where both Latin and another alphabet could be meant, 'mixed' where none fits."""
    letters = [c for c in word if c.isalpha()]
    if not letters:
        return ""
    kinds = {_alphabet(c) for c in letters}
    to_latin, from_latin = _alphabets()
    latin_fits = all(_alphabet(c) == "LATIN" or c in to_latin for c in letters)
    if latin_fits:
        return "LATIN" if "LATIN" in kinds else "?" if len(kinds) == 1 else "LATIN"
    for kind in sorted(kinds - {"LATIN"}):
        back = from_latin.get(kind, {})
        if all(_alphabet(c) == kind or c in back or to_latin.get(c) in back for c in letters):
            return kind
    return "mixed"


def consistent_form(text: str) -> str:
    """The text as it reads, each word in one alphabet, composed, with plain blanks and hyphens.

    A word that could be Latin or another alphabet throughout is Latin where another word of the text is, else it
    stays. Case, accents, spelling and the number of blanks stay. Empty text stays empty."""
    parts = _words(_visible(text))
    alphabets = [_own_alphabet(p) for p in parts]
    latin_near = "LATIN" in alphabets
    to_latin, from_latin = _alphabets()
    out = []
    for part, alphabet in zip(parts, alphabets, strict=True):
        if alphabet == "LATIN" or (alphabet == "?" and latin_near):
            out.append("".join(to_latin.get(c, c) for c in part))
        elif alphabet in from_latin:
            back = from_latin[alphabet]
            out.append("".join(c if _alphabet(c) == alphabet else back.get(to_latin.get(c, c), c) for c in part))
        else:
            out.append(part)
    return unicodedata.normalize("NFC", "".join(out))


def is_plain(text: Column) -> Column:
    """Whether a text surely is in its consistent form, by one regular expression. NULL for NULL."""
    return text.rlike(_PLAIN)


def _mapped(function, kind: T.DataType):
    table = prototypes()

    @F.pandas_udf(kind)
    def run(values: pd.Series) -> pd.Series:
        ship_prototypes(table)
        known = {v: function(v) for v in values.dropna().unique()}
        return values.map(known, na_action="ignore").astype(object)

    return run


def look_alike_forms(df: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(tbl, row_id, text, skel, clean_name, clean_skel) of every row whose text isn't surely plain.

    NULL texts give no row; empty texts are plain; texts of any length are worked on whole; repeated rows each
    give a row; an empty table gives none. Only ``key`` and ``text`` are read, so other columns can't clash."""
    forms = T.StructType([T.StructField("skel", T.StringType()), T.StructField("clean_name", T.StringType()), T.StructField("clean_skel", T.StringType())])

    table = prototypes()

    @F.pandas_udf(forms)
    def both(values: pd.Series) -> pd.DataFrame:
        ship_prototypes(table)
        known = {v: (skeleton(v), f, skeleton(f)) for v in values.dropna().unique() for f in (consistent_form(v),)}
        return pd.DataFrame([known.get(v, (None, None, None)) for v in values], columns=["skel", "clean_name", "clean_skel"])

    odd = df.select(F.lit(label).alias("tbl"), qcol(key).cast("long").alias("row_id"), qcol(text).alias("text")).filter(F.col("text").isNotNull() & ~is_plain(F.col("text")))
    return odd.withColumn("f", both("text")).select("tbl", "row_id", "text", F.col("f.skel").alias("skel"), F.col("f.clean_name").alias("clean_name"), F.col("f.clean_skel").alias("clean_skel"))


def differing_names(tables: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(tbl, row_id, clean_name): each text whose stored form differs from its consistent form, the two being equal by
    their skeletons.

    tables: label to (table, key column, text column)."""
    out = None
    for label, (df, key, text) in tables.items():
        one = look_alike_forms(df, key, text, label)
        out = one if out is None else out.unionByName(one)
    return out.filter((F.col("text") != F.col("clean_name")) & (F.col("skel") == F.col("clean_skel"))).select("tbl", "row_id", "clean_name")


def skeleton_groups(tables: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(skel, n_rows, n_forms, clean_name): originals grouped by equal skeleton, where they have several forms.

    Distinct originals are counted map-side before the skeletons are grouped, so a group of any size is a few rows
    by then."""
    stacked = None
    for df, _, text in tables.values():
        one = df.select(qcol(text).alias("text")).filter(F.col("text").isNotNull())
        stacked = one if stacked is None else stacked.unionByName(one)
    counted = stacked.groupBy("text").agg(F.count("*").alias("n"))
    # only letters of several alphabets need Python
    forms = counted.withColumn("skel", F.when(F.col("text").rlike(r"^[\x20-\x7e]*$"), ascii_skeleton(F.col("text"))).otherwise(_mapped(skeleton, T.StringType())("text")))
    forms = forms.withColumn("clean", F.when(is_plain(F.col("text")), F.col("text")).otherwise(_mapped(consistent_form, T.StringType())("text")))
    groups = forms.groupBy("skel").agg(
        F.sum("n").cast("long").alias("n_rows"), F.count("*").alias("n_forms"), F.max_by("clean", F.struct("n", "clean")).alias("clean_name")
    )
    return groups.filter(F.col("n_forms") > 1)
