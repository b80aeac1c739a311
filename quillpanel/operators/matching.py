"""ID retrieval: survey rows that lost their id are matched to a master list by name, in blocks, and the candidates
are narrowed by location and teacher."""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillpanel.functions.text import close_names, contains_either, without_blanks
from quillpanel.session import let, qcol

if TYPE_CHECKING:
    import pyarrow as pa


@dataclass(frozen=True)
class RetrievalSpec:
    """Columns of the survey (name, var1, var2, block) and of the master list (id, name, var1 and var2 with their ids)."""

    row: str
    name: str
    var1: str
    var2: str
    master_id: str
    master_name: str
    master_var1: str
    master_var1_id: str
    master_var2: str
    master_var2_id: str
    first_tolerance: float = 0.1
    second_tolerance: float = 0.2


def region_block(country: str, region: Column) -> Column:
    """A or B by region in Lebanon (names beginning with A or codes 1 and 2), S elsewhere."""
    if not country.lower().startswith("leb"):
        return F.lit("S")
    code = F.upper(F.trim(region.cast("string")))
    return F.when(code.startswith("A") | (code == "1"), F.lit("A")).when(code.startswith("B") | (code == "2"), F.lit("B"))


_PREFIX = 6


def _segment(n: Column, parts: Column, i: Column) -> tuple[Column, Column]:
    """Start and length of the i-th of ``parts`` even segments of a text of length n; the last ones are the longer."""
    base, extra = F.floor(n / parts).cast("int"), n % parts
    start = 1 + (i - 1) * base + F.greatest(F.lit(0), i - 1 - (parts - extra))
    return start, base + F.when(i > parts - extra, 1).otherwise(0)


# By blanks: how many a text of each class has at most. Almost all are of the first.
_BLANKS = tuple(8**i for i in range(1, 11))


def _blank_class(raw: Column, bare: Column) -> Column:
    """The place of a text's blanks in ``_BLANKS``, from 0."""
    spare, out = F.length(raw) - F.length(bare), F.lit(len(_BLANKS) - 1)
    for i in range(len(_BLANKS) - 2, -1, -1):
        out = F.when(spare <= _BLANKS[i], i).otherwise(out)
    return out


def _most_edits(n: Column, tolerance: float, spread: Column) -> Column:
    """An upper bound of the edits allowed between a stripped text of length n and any partner, whose raw length can
    be the edits and the blanks of class ``spread`` longer."""
    blanks = F.element_at(F.array(*(F.lit(x) for x in _BLANKS)), spread + 1)
    return F.floor((F.lit(tolerance) * (n + blanks) + 1) / (1 - tolerance) + F.lit(1e-9)).cast("long")


def _tag(kind: str, *parts: Column) -> Column:
    return F.concat_ws("|", F.lit(kind), *(p.cast("string") for p in parts))


def _own_segments(text: Column, tolerance: float, spread: Column) -> Column:
    """Keys of a text for partners that look for it: its k + 1 segments, or its length where it has no so many."""
    n = F.length(text)

    def of(k: Column) -> Column:
        def key(i: Column) -> Column:
            start, size = _segment(n, (k + 1).cast("int"), i)
            return _tag("s", spread, n, i, F.substring(text, start, size))

        return F.when(k + 1 > n, F.array(_tag("l", spread, n))).otherwise(F.transform(F.sequence(F.lit(1), F.least(k + 1, n).cast("int")), key))

    return let(_most_edits(n, tolerance, spread), of)


def _looked_up(text: Column, tolerance: float, spread: Column) -> Column:
    """Keys of all texts that can be within the edits of this one."""
    n = F.length(text)

    def of_size(size: Column) -> Column:
        def of(k: Column) -> Column:
            shift = n - size

            def places(i: Column) -> Column:
                start, length = _segment(size, (k + 1).cast("int"), i)
                low = F.greatest(F.lit(1), start - (i - 1), start + shift - (k.cast("int") + 1 - i))
                high = F.least(n - length + 1, start + (i - 1), start + shift + (k.cast("int") + 1 - i))
                return F.when(low <= high, F.transform(F.sequence(low, high), lambda p: _tag("s", spread, size, i, F.substring(text, p, length)))).otherwise(F.array().cast("array<string>"))

            return F.when(F.abs(shift) > k, F.array().cast("array<string>")).when(k + 1 > size, F.array(_tag("l", spread, size))).otherwise(F.flatten(F.transform(F.sequence(F.lit(1), F.least(k + 1, size).cast("int")), places)))

        return let(_most_edits(size, tolerance, spread), of)

    reach = _most_edits(n + _most_edits(n * 2, tolerance, spread), tolerance, spread)
    return F.flatten(F.transform(F.sequence(F.greatest(F.lit(1), n - reach).cast("int"), (n + reach).cast("int")), of_size))


def close_pairs(left: DataFrame, right: DataFrame, tolerance: float) -> DataFrame:
    """(block, v, n): all pairs of a block for which ``close_names(v, n, tolerance)`` holds, and no others.

    left: (block, v), right: (block, n); tolerance below 0.5. Exact without comparing all pairs. Two texts within k
    edits share one of any k + 1 segments of either, at a place shifted by no more than the edits before or after it
    allow; a text within another begins with one of the other's substrings. Both are equi-joins on keys whose
    number depends on a text's length only; candidates are then compared. Texts too short for k + 1 segments are
    keyed by length: there are few of them. As blanks count for the edits allowed, the text with more of them (by
    class) looks the other up, so a cell of many blanks costs by itself only. NULL and blank texts match nothing;
    repeated rows count once. No job runs while this is planned."""
    v = left.select("block", "v").filter("block IS NOT NULL AND trim(v) <> ''").distinct().withColumn("x", without_blanks(F.col("v"))).filter("x <> ''")
    n = right.select("block", "n").filter("block IS NOT NULL AND trim(n) <> ''").distinct().withColumn("y", without_blanks(F.col("n"))).filter("y <> ''")
    x, y = F.col("x"), F.col("y")

    def known(text: Column, own: Column, first: int) -> Column:
        """Own segments for every class of partners that look this text up."""
        classes = F.sequence(own + first, F.lit(len(_BLANKS) - 1 + first))
        return F.flatten(F.transform(F.filter(classes, lambda c: c < len(_BLANKS)), lambda c: _own_segments(text, tolerance, c)))

    grams = lambda c: F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.lit(_PREFIX), F.length(c))), lambda g: F.transform(F.sequence(F.lit(1), F.length(c) - g + 1), lambda p: F.lower(F.substring(c, p, g)))))
    start = lambda c: F.lower(F.substring(c, 1, _PREFIX))
    marked = lambda mark, keys: F.transform(keys, lambda k: F.concat(F.lit(mark), k))
    held = lambda mark, keys: F.transform(keys, lambda g: _tag(mark, g))
    cx, cy = _blank_class(F.col("v"), x), _blank_class(F.col("n"), y)
    keys_v = let(cx, lambda c: F.concat(marked("v", _looked_up(x, tolerance, c)), marked("n", known(x, c, 1))))
    keys_n = let(cy, lambda c: F.concat(marked("v", known(y, c, 0)), marked("n", F.when(c > 0, _looked_up(y, tolerance, c)).otherwise(F.array().cast("array<string>")))))
    keyed_v = v.select("block", "v", F.explode(F.array_distinct(F.concat(keys_v, held("c", grams(x)), F.array(_tag("d", start(x)))))).alias("key"))
    keyed_n = n.select("block", "n", F.explode(F.array_distinct(F.concat(keys_n, held("d", grams(y)), F.array(_tag("c", start(y)))))).alias("key"))
    candidates = keyed_v.join(keyed_n, ["block", "key"]).select("block", "v", "n").distinct()
    return candidates.filter(close_names(F.col("v"), F.col("n"), tolerance))


# Parts of either side of a block: each part of one meets each of the other.
_PARTS = 8


def near_pairs(left: DataFrame, right: DataFrame, tolerance: float) -> DataFrame:
    """(block, v, n): the same pairs as ``close_pairs``, by comparing all pairs of a block.

    For tolerances of several edits in a name, where segments of so few letters as those of ``close_pairs`` are shared
    by a good part of all pairs: its keys and candidates then outgrow the table many times, while a pair costs a few
    nanoseconds here (see ``functions.near``). What is moved is each text ``_PARTS`` times, whatever the number of
    pairs; what that leaves is compared once more by ``close_names``."""

    def parts(df: DataFrame, text: str, own: str, other: str) -> DataFrame:
        rows = df.select("block", text).filter(f"block IS NOT NULL AND trim({text}) <> ''").distinct().withColumn("low", without_blanks(F.col(text))).filter("low <> ''")
        every = F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1)))
        return rows.select("block", text, F.lower("low").alias("low"), F.pmod(F.xxhash64(text), F.lit(_PARTS)).cast("int").alias(own), every.alias(other))

    def work(key: tuple[pa.Scalar, ...], a: pa.Table, b: pa.Table) -> pa.Table:
        import pyarrow as pa

        from quillpanel.functions import near

        vs, ns, found = a.column("v"), b.column("n"), [(pa.array([], pa.int64()),) * 2]
        found += [(pa.array(i), pa.array(j)) for i, j in near.near_pairs(vs.to_pylist(), a.column("low").to_pylist(), ns.to_pylist(), b.column("low").to_pylist(), tolerance)]
        i, j = (pa.chunked_array(x) for x in zip(*found, strict=True))
        return pa.Table.from_arrays([pa.array([key[0].as_py()] * len(i), pa.string()), vs.take(i), ns.take(j)], ["block", "v", "n"])

    keys = ("block", "part_v", "part_n")
    v, n = parts(left, "v", "part_v", "part_n"), parts(right, "n", "part_n", "part_v")
    found = v.groupBy(*keys).cogroup(n.groupBy(*keys)).applyInArrow(work, "block string, v string, n string")
    return found.filter(close_names(F.col("v"), F.col("n"), tolerance))


def _matched_ids(survey: DataFrame, master: DataFrame, value: str, name: str, ident: str, tolerance: float | None) -> DataFrame:
    """(block, v, ids): the master's ``ident`` values that a survey value fits, each distinct value compared once.

    Without a tolerance a value fits a name or an id that it holds or that holds it."""
    entries = master.select("block", qcol(ident).alias("i"), qcol(name).alias("n")).filter("i IS NOT NULL")
    values = survey.select("block", qcol(value).alias("v"))
    if tolerance is not None:
        pairs = near_pairs(values, entries.select("block", "n"), tolerance)
    else:
        either = entries.select("block", "n").unionByName(entries.select("block", F.col("i").alias("n")))
        pairs = near_pairs(values, either, 0.0).filter(contains_either(F.col("v"), F.col("n")))
        entries = entries.unionByName(entries.withColumn("n", F.col("i")))
    return pairs.join(entries.distinct(), ["block", "n"]).groupBy("block", "v").agg(F.collect_set("i").alias("ids"))


def _narrow(rows: DataFrame, flag: str, column: str, ids: str) -> DataFrame:
    """Of several candidates keep those whose master row has a matched ``column``; all, and the flag, if none has."""
    fits = F.filter("candidates", lambda c: F.array_contains(F.col(ids), c[column]))
    several = (F.size(F.array_distinct(F.transform("candidates", lambda c: c["id"]))) > 1) & (F.size(F.coalesce(F.col(ids), F.array().cast("array<string>"))) > 0)
    return rows.withColumns({flag: F.coalesce(several & (F.size(fits) == 0), F.lit(False)), "candidates": F.when(several & (F.size(fits) > 0), fits).otherwise(F.col("candidates"))})


def retrieve_ids(survey: DataFrame, master: DataFrame, spec: RetrievalSpec, block: Column, master_block: Column) -> DataFrame:
    """(row, retrieved, VAR1_FLAG, VAR2_FLAG, NO_MATCH, MULTIPLE_MATCH, DUPLICATE_FLAG).

    retrieved: the candidates' ids in order, |-joined, NULL without any. Names match within the first tolerance;
    rows without a match get the second. Location and teacher narrow several candidates; a flag says that one matched
    but no candidate has it.
    DUPLICATE_FLAG: another row retrieved the same. Rows without a block match nothing; repeated names are compared
    once (see ``near_pairs``). Other columns are not read, so they can't clash."""
    s = survey.select(block.alias("block"), qcol(spec.row).alias("__row"), qcol(spec.name).alias("v"), qcol(spec.var1).alias("__v1"), qcol(spec.var2).alias("__v2"))
    named = (("id", spec.master_id), ("n", spec.master_name), ("n1", spec.master_var1), ("v1", spec.master_var1_id), ("n2", spec.master_var2), ("v2", spec.master_var2_id))
    m = master.select(master_block.alias("block"), *(qcol(c).alias(a) for a, c in named)).filter("block IS NOT NULL")
    entries = m.filter("id IS NOT NULL").groupBy("block", "n").agg(F.collect_set(F.struct("id", "v1", "v2")).alias("cs"))
    pairs = near_pairs(s.select("block", "v"), entries.select("block", "n"), spec.second_tolerance)
    first = close_names(F.col("v"), F.col("n"), spec.first_tolerance)
    hits = pairs.join(entries, ["block", "n"]).groupBy("block", "v").agg(F.flatten(F.collect_list(F.when(first, F.col("cs")))).alias("one"), F.flatten(F.collect_list("cs")).alias("two"))
    hits = hits.select("block", "v", F.when(F.size("one") > 0, F.col("one")).otherwise(F.col("two")).alias("candidates"))
    one = _matched_ids(s, m, "__v1", "n1", "v1", None).select(F.col("block").alias("__b1"), F.col("v").alias("__k1"), F.col("ids").alias("__ids1"))
    two = _matched_ids(s, m, "__v2", "n2", "v2", spec.first_tolerance).select(F.col("block").alias("__b2"), F.col("v").alias("__k2"), F.col("ids").alias("__ids2"))
    wide = (
        s.join(hits, ["block", "v"], "left")
        .join(one, (F.col("block") == F.col("__b1")) & (F.col("__v1") == F.col("__k1")), "left")
        .join(two, (F.col("block") == F.col("__b2")) & (F.col("__v2") == F.col("__k2")), "left")
    )
    narrowed = _narrow(_narrow(wide, "VAR2_FLAG", "v2", "__ids2"), "VAR1_FLAG", "v1", "__ids1")
    ids = F.array_sort(F.array_distinct(F.transform("candidates", lambda c: c["id"])))
    found = narrowed.select(F.col("__row"), F.nullif(F.array_join(ids, "|"), F.lit("")).alias("retrieved"), "VAR1_FLAG", "VAR2_FLAG", (F.size(ids) > 1).alias("__several"))
    counts = found.filter("retrieved IS NOT NULL").groupBy("retrieved").agg(F.count(F.lit(1)).alias("__n"))
    return found.join(counts, "retrieved", "left").select(
        F.col("__row").alias(spec.row), "retrieved", "VAR1_FLAG", "VAR2_FLAG", F.col("retrieved").isNull().alias("NO_MATCH"), F.coalesce("__several", F.lit(False)).alias("MULTIPLE_MATCH"), F.coalesce(F.col("__n") > 1, F.lit(False)).alias("DUPLICATE_FLAG")
    )
