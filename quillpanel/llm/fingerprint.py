"""Problem 3: duplicates hidden by formatting differences.

Every normalised (field name, value) pair is hashed, the hashes of a record are combined by addition (a
commutative multiset hash: field and part order don't matter), records are grouped by the fingerprint, and the
fields of a group are verified to be equal: they stand behind the fingerprint in the key, so members of one fingerprint
are compared by the values themselves, and a group whose members differ (a collision) is split by them. No hash decides
that two records are equal. Groups are aggregated by hash, map-side first, in one pass; neither fields nor rows are
sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillpanel.session import qcol

_LANE = (1 << 48) - 1


def bare(c: Column) -> Column:
    """Letters and digits only, in capitals."""
    return F.when(c.rlike("^[A-Z0-9]*$"), c).otherwise(F.upper(F.regexp_replace(c, r"[^\p{L}\p{N}]++", "")))


def unordered_parts(c: Column, shapes: Mapping[str, str]) -> dict[str, Column]:
    """The parts of an id by their shapes, wherever they stand; what no shape matches is the part 'rest'.

    shapes: part to a regular expression on the bare text, taken out one after the other. Order, case, white space
    and punctuation don't matter."""
    text, parts = bare(c), {}
    for name, pattern in shapes.items():
        parts[name] = F.array_join(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), "+")
        text = F.regexp_replace(text, pattern, "-")
    return {**parts, "rest": F.replace(text, F.lit("-"), F.lit(""))}


def _pair_hash(name: str, value: Column, lane: int) -> Column:
    h = F.xxhash64(F.lit(f"{lane}:{name}"), F.coalesce(value.cast("string"), F.lit("")), value.isNull())
    return h.bitwiseAND(F.lit(_LANE))


def multiset_fingerprint(values: Mapping[str, Column]) -> tuple[Column, Column]:
    """Two 48-bit lanes; each is the sum of the hashes of all (name, value) pairs, in any order. NULL is a value."""
    lanes = []
    for lane in (1, 2):
        total = F.lit(0).cast("long")
        for name, value in values.items():
            total = total + _pair_hash(name, value, lane)
        lanes.append(total)
    return lanes[0], lanes[1]


def collapse_copies(df: DataFrame, key: str, values: Mapping[str, Column], required: Sequence[str]) -> DataFrame:
    """(first, n_copies): one row for each distinct record, with its smallest key and number of copies.

    values: normalised fields that make a record. required: columns that must not be NULL; rows without them take
    no part. NULL equals NULL in all other fields. An empty table gives no row; rows with a NULL key count as
    copies but never as the first. The members of a group have equal fields, compared as values. Groups of any size are
    aggregated map-side first: a group that holds a third of all rows reaches its reducer as one row from each mapper."""
    part = df
    for name in required:
        part = part.filter(qcol(name).isNotNull())
    fields = {n: f"__v{i}" for i, n in enumerate(values)}
    rows = part.select(qcol(key).cast("long").alias("__key"), *(v.alias(fields[n]) for n, v in values.items()))
    one, two = multiset_fingerprint({n: F.col(f) for n, f in fields.items()})
    marked = rows.select("*", one.alias("__h1"), two.alias("__h2"))
    groups = marked.groupBy("__h1", "__h2", *fields.values())
    return groups.agg(F.min("__key").alias("first"), F.count("*").alias("n_copies")).select("first", "n_copies")


# The three parts of an assessment's uniqueid as TESTDATA names them.
UNIQUEID_SHAPES = {"tablet": r"T[0-9]{2}(?=[0-9]{9}|[^0-9]|$)", "serial": "[0-9]+", "letters": "[A-Z]+"}


def assessment_record(df: DataFrame) -> dict[str, Column]:
    """The normalised fields that make a survey entry."""
    uid = qcol("uniqueid")
    usual = uid.rlike("^[A-Z]+-T[0-9]{2}-[0-9]{9}$")
    halves = F.split(uid, "-")
    odd = unordered_parts(uid, UNIQUEID_SHAPES)
    parts = {
        "uid_letters": F.when(usual, F.get(halves, F.lit(0))).otherwise(odd["letters"]),
        "uid_tablet": F.when(usual, F.get(halves, F.lit(1))).otherwise(odd["tablet"]),
        "uid_serial": F.when(usual, F.get(halves, F.lit(2))).otherwise(odd["serial"]),
        "uid_rest": F.when(usual, F.lit("")).otherwise(odd["rest"]),
    }
    plain = {c: qcol(c) for c in ("assess_group", "wave", "age", "grade", "q11", "q12", "q1_99")}
    return {"st_id": bare(qcol("st_id")), **parts, **plain, "score": qcol("score") + F.lit(0.0)}
