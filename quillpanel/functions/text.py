"""Text expressions: accents, literal containment, edit distances. All are compositions of built-in functions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillpanel.session import let

# Letters that no decomposition reduces to ASCII.
LIGATURES = {"æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ß": "ss", "þ": "th", "Þ": "TH", "ð": "d", "Ð": "D", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ı": "i"}


def _single_letters() -> tuple[str, str]:
    source, target = [], []
    for code in [*range(0xC0, 0x180), *range(0x218, 0x21C), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha() and chr(code) not in LIGATURES:
            source.append(chr(code))
            target.append(base)
    for letter, plain in LIGATURES.items():
        if len(plain) == 1:
            source.append(letter)
            target.append(plain)
    return "".join(source), "".join(target)


def remove_accents(c: Column) -> Column:
    """Latin letters without their accents; ligatures spelled out. NULL stays NULL."""
    source, target = _single_letters()
    out = F.translate(c, source, target)
    for letter, plain in LIGATURES.items():
        if len(plain) > 1:
            out = F.replace(out, F.lit(letter), F.lit(plain))
    return F.regexp_replace(out, r"\p{M}++", "")


def without_blanks(c: Column) -> Column:
    return F.regexp_replace(c, r"\s++", "")


def contains_either(a: Column, b: Column) -> Column:
    """Whether one text holds the other, literally and without case; an empty text is held by any."""
    x, y = F.lower(a), F.lower(b)
    return F.contains(x, y) | F.contains(y, x)


def osa_distance(a: Column, b: Column) -> Column:
    """Optimal string alignment distance (edits and swaps of neighbours), as a dynamic program in the engine.

    NULL if either is NULL; the other's length if one is empty. Quadratic in the lengths: bound it with
    ``levenshtein`` where a threshold is known (see ``within_osa``)."""

    def table(x: Column, y: Column) -> Column:
        width = F.length(y)

        def line(acc: Column, i: Column) -> Column:
            xi, before = F.substring(x, i, 1), F.substring(x, i - 1, 1)

            def cell(row: Column, j: Column) -> Column:
                yj, yb = F.substring(y, j, 1), F.substring(y, j - 1, 1)
                swap = F.when((i > 1) & (j > 1) & (xi == yb) & (before == yj), F.get(acc["p2"], j - 2) + 1)
                best = F.least(F.get(acc["p1"], j) + 1, F.get(row, j - 1) + 1, F.get(acc["p1"], j - 1) + (xi != yj).cast("int"), swap)
                return F.concat(row, F.array(best))

            new = F.aggregate(F.sequence(F.lit(1), width), F.array(i), cell)
            return F.struct(acc["p1"].alias("p2"), new.alias("p1"))

        start = F.struct(F.sequence(F.lit(0), width).alias("p2"), F.sequence(F.lit(0), width).alias("p1"))
        return F.aggregate(F.sequence(F.lit(1), F.length(x)), start, line, lambda acc: F.get(acc["p1"], width))

    la, lb = F.length(a), F.length(b)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("int")).when((la == 0) | (lb == 0), F.greatest(la, lb)).otherwise(table(a, b))


def within_osa(a: Column, b: Column, most: Column) -> Column:
    """Whether the alignment distance is at most ``most``. A swap costs Levenshtein at most two, so only distances
    between ``most`` and twice that need the dynamic program."""
    return let(F.struct(F.levenshtein(a, b).alias("lev"), most.alias("most")), lambda s: F.when(s["lev"] <= s["most"], True).when(s["lev"] > 2 * s["most"], False).otherwise(osa_distance(a, b) <= s["most"]))


def name_mismatch(a: Column, b: Column, tolerance: float) -> Column:
    """Whether two names differ: both known, neither holds the other, and their similarity
    1 - distance / longer length is below 1 - tolerance. Blanks don't count; 'NA' is unknown. Never NULL."""

    def bare(c: Column) -> Column:
        x = without_blanks(c)
        return F.when(x.isin("NA", ""), F.lit(None)).otherwise(x)

    def compare(s: Column) -> Column:
        x, y = s["x"], s["y"]
        longest = F.greatest(F.length(x), F.length(y))
        # similarity < 1 - t  <=>  distance > t * longest
        close = within_osa(x, y, F.floor(longest * F.lit(tolerance) + F.lit(1e-9)).cast("int"))
        return F.when(x.isNull() | y.isNull(), False).when(contains_either(x, y), False).otherwise(~close)

    return let(F.struct(bare(a).alias("x"), bare(b).alias("y")), compare)


def close_names(a: Column, b: Column, tolerance: float) -> Column:
    """Whether names match for retrieval: Levenshtein distance without blanks within ceil(tolerance x longer
    length, blanks counted), or one holds the other. NULL names match nothing."""
    longest = F.greatest(F.length(a), F.length(b))
    x, y = without_blanks(a), without_blanks(b)
    near = F.levenshtein(x, y) <= F.ceil(longest * F.lit(tolerance))
    return F.coalesce(near | ((F.length(x) > 0) & (F.length(y) > 0) & contains_either(x, y)), F.lit(False))
