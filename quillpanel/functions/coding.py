"""Code lists written as text: ``cbind(c(1,2),c("M","F"))`` pairs values with labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillpanel.session import let

_LIST = r"""\bc\s*\(((?:"[^"]*"|'[^']*'|[^()"'])*)\)"""
_ATOM = r"""("[^"]*"|'[^']*'|[^,"'\s][^,"']*)"""


def _atoms(text: Column) -> Column:
    bare = F.regexp_extract_all(text, F.lit(_ATOM), F.lit(1))
    return F.transform(bare, lambda a: F.regexp_replace(F.trim(a), r"""^["']|["']$""", ""))


def code_pairs(text: Column) -> Column:
    """array<struct<value,label>> in the order written, labels trimmed and in capitals; NULL where the text holds
    no two lists of one length."""

    def build(lists: Column) -> Column:
        values, labels = _atoms(F.get(lists, F.lit(0))), _atoms(F.get(lists, F.lit(1)))
        pairs = F.zip_with(values, labels, lambda v, d: F.struct(v.alias("value"), F.upper(F.trim(d)).alias("label")))
        return F.when((F.size(lists) == 2) & (F.size(values) == F.size(labels)) & (F.size(values) > 0), pairs)

    return let(F.regexp_extract_all(text, F.lit(_LIST), F.lit(1)), build)


def code_set(text: Column) -> Column:
    """The pairs of a code list as one text that doesn't depend on their order; NULL without a code list."""
    pairs = code_pairs(text)
    return F.when(pairs.isNotNull(), F.array_join(F.array_sort(F.array_distinct(F.transform(pairs, lambda p: F.concat(p["value"], F.lit("="), p["label"])))), ";"))
