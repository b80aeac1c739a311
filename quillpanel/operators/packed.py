"""Problem 1: several values packed in one field.

Quoted spans are replaced by indexed placeholders that no cell content can imitate, the remaining text is
split at its delimiters, every slot gets its spans back through an array lookup, and the slots are exploded
with their positions. The operator is row-local: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillpanel.session import fresh, let, qcol

# Delimiters that separate values wherever they stand outside quotes.
HARD_DELIMITERS = ",;|\t\n，；｜、،؛"
# Signs and words that separate only where values are plain identifiers.
SOFT_DELIMITERS = "/&+"
SOFT_WORDS = ("et", "and", "-")

_OPEN, _CLOSE = "", ""
_BLANKS = "  　﻿"
_BLANK = f"[{_BLANKS}]"
_WHITE = _BLANKS + " \t\n\x0b\f\r"
_ALNUM = r"[\p{L}\p{N}]"
# A span starts at a quote not preceded, and ends at one not followed, by a letter or digit. A doubled quote
# makes two spans that touch; they land in one slot and are undoubled there.
_SPAN = (
    rf'(?<!{_ALNUM})"[^"]*+"(?!{_ALNUM})'
    rf"|“[^”]*+”|«[^»]*+»|„[^“”]*+[“”]"
    rf"|(?<!{_ALNUM})'[^']*+'(?!{_ALNUM})"
)
# What is one value although it holds signs that separate identifiers: N/A, dates, clock times.
_WHOLE = (
    rf"(?<!{_ALNUM})[nN]/[aA](?!{_ALNUM})"
    rf"|(?<!{_ALNUM})(?:\d{{4}}-\d{{1,2}}-\d{{1,2}}|\d{{4}}/\d{{1,2}}/\d{{1,2}}|\d{{1,2}}-\d{{1,2}}-\d{{2,4}}|\d{{1,2}}/\d{{1,2}}/\d{{2,4}})"
    rf"(?:[T ]\d{{1,2}}:\d{{2}}(?::\d{{2}})?)?(?!{_ALNUM})"
)
_QUOTE_PAIRS = {'"': '"', "“": "”", "«": "»", "„": "“”", "'": "'"}


@dataclass(frozen=True)
class PackedField:
    """How one column packs its values.

    soft: identifiers only, so ``/ & +`` and the words in ``SOFT_WORDS`` separate too.
    blanks: white space alone separates as well (codes without inner blanks)."""

    soft: bool = False
    blanks: bool = False

    def pattern(self) -> str:
        signs = HARD_DELIMITERS + (SOFT_DELIMITERS if self.soft else "")
        choices = [r"\r\n", "[" + "".join("\\" + c if c in r"|/&+" else c for c in signs) + r"\r]"]
        if self.soft:
            words = "|".join(SOFT_WORDS)
            choices.append(rf"(?<={_BLANK})(?i:{words})(?={_BLANK})")
        core = "|".join(choices)
        # a run of blanks is one match, with or without a sign in it; elsewhere slots lose their blanks later
        return f"{_BLANK}*+(?:{core}){_BLANK}*+|{_BLANK}++" if self.blanks else core

    def spans(self) -> str:
        """What is replaced by placeholders before the text is split."""
        return f"{_SPAN}|{_WHOLE}" if self.soft else _SPAN

    def marks(self) -> str:
        """What every cell with a span holds."""
        signs = "".join(sorted({*_QUOTE_PAIRS, *"".join(_QUOTE_PAIRS.values())}))
        return f"[{signs}{_OPEN}]" + (r"|(?i:n/a)|\d[-/]\d" if self.soft else "")


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_WHITE))


def _unquote(c: Column) -> Column:
    """Blanks and one pair of enclosing quotes off; quotes doubled inside their own kind count once."""

    def bare(slot: Column) -> Column:
        first, last = F.substring(slot, 1, 1), F.right(slot, F.lit(1))
        body = F.substring(slot, F.lit(2), F.length(slot) - 2)
        out = slot
        for opening, closings in _QUOTE_PAIRS.items():
            plain = body
            for sign in sorted({opening, *closings}):
                plain = F.replace(plain, F.lit(sign * 2), F.lit(sign))
            out = F.when((F.length(slot) >= 2) & (first == opening) & last.isin(*closings), _strip(plain)).otherwise(out)
        return out

    return let(_strip(c), bare)


def packed_slots(cell: Column, how: PackedField) -> Column:
    """array<string> of a cell's slots in order, empty ones included; NULL for a NULL cell.

    Row-local and linear in the length of the cell, so very long cells are split whole. Only cells that can hold a
    span take the way through placeholders."""
    trimmed, span = F.btrim(cell, F.lit(_BLANKS)), how.spans()
    guarded = F.replace(trimmed, F.lit(_OPEN), F.lit(f"{_OPEN}x{_CLOSE}"))

    def split_guarded(text: Column) -> Column:
        return let(F.regexp_extract_all(text, F.lit(f"({span})"), F.lit(1)), lambda spans: with_spans(text, spans))

    def with_spans(text: Column, spans: Column) -> Column:
        def hold(gap: Column, i: Column) -> Column:
            return F.when(i == 0, gap).otherwise(F.concat(F.lit(_OPEN), (i - 1).cast("string"), F.lit(_CLOSE), gap))

        def back(piece: Column, k: Column) -> Column:
            # pieces after the first begin with "<index>CLOSE" or, for a sign of the cell itself, "xCLOSE"
            mark = F.substring_index(piece, _CLOSE, 1)
            lookup = F.when(mark == "x", F.lit(_OPEN)).otherwise(F.get(spans, mark.try_cast("int")))
            return F.when(k == 0, piece).otherwise(
                F.concat(F.replace(lookup, F.lit(f"{_OPEN}x{_CLOSE}"), F.lit(_OPEN)), F.substring(piece, F.length(mark) + 2, F.length(piece)))
            )

        held = F.array_join(F.transform(F.split(text, span, -1), hold), "")
        return F.transform(
            F.split(F.when(F.size(spans) > 0, held).otherwise(text), how.pattern(), -1),
            lambda slot: _unquote(F.when(F.contains(slot, F.lit(_OPEN)), F.array_join(F.transform(F.split(slot, _OPEN, -1), back), "")).otherwise(slot)),
        )

    plain = F.transform(F.split(trimmed, how.pattern(), -1), _strip)
    return F.when(trimmed.rlike(how.marks()), let(guarded, split_guarded)).otherwise(plain)


def unpack_values(df: DataFrame, key: str, fields: Mapping[str, PackedField], min_values: int = 2) -> DataFrame:
    """One row for each non-empty value of every cell that holds at least ``min_values`` of them.

    Result: ``key``, field (column name), pos (from 1, empty slots counted), item. NULL, empty and blank
    cells give no row; an empty table gives an empty result; repeated rows each give their own rows; columns
    named field, pos or item in ``df`` don't clash, as only ``key`` and the cells are read."""
    cell, slot = fresh(df, "__cell"), fresh(df, "__slot")
    # a cell without any separator has one value at most
    parted = F.lit(min_values < 2)
    for name, how in fields.items():
        parted = parted | ((qcol(cell)["field"] == name) & qcol(cell)["text"].rlike(how.pattern()))
    stacked = df.select(
        qcol(key),
        F.explode(F.array(*(F.struct(F.lit(name).alias("field"), qcol(name).alias("text")) for name in fields))).alias(cell),
    ).filter(qcol(cell)["text"].isNotNull() & parted)
    slots = None
    for name, how in fields.items():
        one = packed_slots(qcol(cell)["text"], how)
        slots = F.when(qcol(cell)["field"] == name, one) if slots is None else slots.when(qcol(cell)["field"] == name, one)
    split = stacked.select(qcol(key), qcol(cell)["field"].alias("field"), slots.alias(slot))
    enough = F.size(F.filter(qcol(slot), lambda x: x != "")) >= min_values
    return (
        split.filter(enough)
        .select(qcol(key), "field", F.posexplode(qcol(slot)).alias("__p", "item"))
        .filter(F.col("item") != "")
        .select(qcol(key), "field", (F.col("__p") + 1).cast("long").alias("pos"), "item")
    )


CORRECTION_FIELDS = {
    "what": PackedField(soft=True),
    "change_to": PackedField(),
    "fix_database": PackedField(soft=True, blanks=True),
}
