"""Personal names typed by people: tokens, roles, spelling distance, and a spelling lexicon learned from the data.

A student's full name holds the given name, the father's name and the family name, in this order or with the
family name in front; any part may carry typing errors, the father's name may be an initial or missing, particles
come and go. The father's own name (father's and family name) helps to tell the roles apart.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillpanel.llm.skeleton import consistent_form, prototypes, ship_prototypes
from quillpanel.session import stored

# Words before a name that are no part of it, and particles that come and go within family names.
TITLES = frozenset("MR MRS MS MME MLLE M DR PR PROF UST USTAZ SIR MISS".split())
PARTICLES = frozenset("AL EL BEN BIN IBN BINT BENT OULD".split())
# Letter groups that are written one way or the other for one sound.
SOUNDS = (("OO", "OU"), ("CH", "SH"), ("KSH", "KCH"), ("EE", "I"), ("Y", "I"), ("W", "W"))
_TOKEN = re.compile(r"[^\W\d_]+|,")


class Reading(NamedTuple):
    """One way to read a row: spelling of the given, the father's and the family name; '' where missing, one
    letter where only an initial is known. The last two are the father's own spellings of his names."""

    given: str
    father: str
    family: str
    father_own: str = ""
    family_own: str = ""


@lru_cache(20_000)
def plain(text: str) -> str:
    """Capitals without accents, in consistent characters."""
    form = text if text.isascii() else consistent_form(text)
    return "".join(c for c in unicodedata.normalize("NFKD", form) if not unicodedata.combining(c)).upper().replace("’", "").replace("'", "")


class Token(str):
    """A name's sounded spelling, and the one that was typed: a typing error beside a digraph changes more letters of the
    sounded spelling than of the typed one."""

    raw: str

    @classmethod
    def of(cls, typed: str) -> Token:
        out = cls(sounded(typed))
        out.raw = typed
        return out


@lru_cache(50_000)
def sounded(token: str) -> str:
    """A token with spellings of one sound made equal and doubled letters single."""
    token = token.replace("OO", "OU").replace("EE", "I").replace("CH", "SH").replace("Y", "I").replace("OU", "U")
    return re.sub(r"(.)\1+", r"\1", token)


@lru_cache(50_000)
def _letters(token: str) -> int:
    """The letters a token has, as bits."""
    bits = 0
    for c in token:
        bits |= 1 << (ord(c) % 64)
    return bits


def osa(a: str, b: str, most: int) -> int:
    """Optimal string alignment distance, or most + 1 where it is greater.

    An edit takes away one kind of letter at most, so what only one text has bounds the distance from below; what both
    begin and end with doesn't count."""
    if a == b:
        return 0
    x, y = _letters(a), _letters(b)
    if abs(len(a) - len(b)) > most or (x & ~y).bit_count() > most or (y & ~x).bit_count() > most:
        return most + 1
    start, end = 0, min(len(a), len(b))
    while start < end and a[start] == b[start]:
        start += 1
    tail = 0
    while tail < end - start and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[start : len(a) - tail], b[start : len(b) - tail]
    la, lb = len(a), len(b)
    if not la or not lb:
        return min(max(la, lb), most + 1)
    before, row = [], list(range(lb + 1))
    for i in range(1, la + 1):
        new, x = [i] + [0] * lb, a[i - 1]
        least = i
        for j in range(1, lb + 1):
            y = b[j - 1]
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new[j] = d
            least = min(least, d)
        if least > most:
            return most + 1
        before, row = row, new
    return min(row[lb], most + 1)


def allowed(a: str, b: str) -> int:
    """How many edits two spellings of one name may differ by."""
    shorter = min(len(a), len(b))
    return 0 if shorter < 3 else 1 if shorter < 6 else 2


@lru_cache(50_000)
def closeness(a: str, b: str) -> float:
    """2 equal, 1.5 a typing error apart, 0.8 an initial, 0 unknown, -2 different."""
    if not a or not b:
        return 0.0
    if len(a) == 1 or len(b) == 1:
        return 0.8 if a[0] == b[0] else -2.0
    if a == b:
        return 2.0
    return 1.5 if osa(a, b, allowed(a, b)) <= allowed(a, b) else -2.0


def name_parts(text: str | None) -> tuple[list[str], list[str]]:
    """Tokens before and after a comma (all before, where there is none), titles dropped, particles joined off. Of more
    than three names those that are a typing error away from a particle, and stand before another, are particles, too."""
    if not text:
        return [], []
    raw = _TOKEN.findall(plain(text))
    sides: list[list[str]] = [[], []]
    side = 0
    count = sum(t != "," for t in raw)
    for i, t in enumerate(raw):
        if t == ",":
            side = min(1, side + 1) if sides[0] else 0
        elif t in TITLES and not sides[0] and count > 1 and i == 0:
            count -= 1
        elif t in PARTICLES and i + 1 < len(raw) and len(raw) > 1 and raw[i + 1] != ",":
            continue
        else:
            sides[side].append(Token.of(t))
    for names in sides:
        for i in range(len(names) - 2, -1, -1):
            if len(sides[0]) + len(sides[1]) > 3 and _particle_like(names[i]) and (i > 0 or len(names) > 3):
                del names[i]
    return sides[0], sides[1]


@lru_cache(10_000)
def _particle_like(token: str) -> bool:
    return len(token) <= 4 and any(osa(token, p, 1) <= 1 for p in PARTICLES)


def readings(student: str | None, father: str | None) -> list[Reading]:
    """The likeliest readings of a row, best first, at most two; none without a student name.

    Of more than three names some belong together; every way to divide them into given, father's and family name, in
    both orders, is a reading, and the father's own names tell which is the likeliest."""
    head, tail = name_parts(student)
    f_head, f_tail = name_parts(father)
    if not head and not tail:
        return []
    if tail:
        students = [(tail[0], tail[1] if len(tail) > 1 else "", head[-1])]
    elif len(head) == 1:
        students = [(head[0], "", "")]
    elif len(head) == 2:
        students = [(head[0], "", head[1]), (head[1], "", head[0])]
    elif len(head) > 3:
        join = lambda i, j: "".join(head[i:j])
        cuts = [(i, j) for i in range(1, len(head) - 1) for j in range(i + 1, len(head))]
        students = [(join(0, i), join(i, j), join(j, len(head))) for i, j in cuts] + [(join(i, j), join(j, len(head)), join(0, i)) for i, j in cuts]
    else:
        students = [(head[0], head[1], head[-1]), (head[1], head[2], head[0])]
        if len(head[1]) == 1:
            students = students[:1]
        elif len(head[2]) == 1:
            students = students[1:]
    if f_tail:
        fathers = [(f_tail[0], f_head[-1])]
    elif len(f_head) >= 2:
        fathers = [(f_head[0], f_head[-1]), (f_head[-1], f_head[0])]
        if len(f_head[0]) == 1:
            fathers = fathers[:1]
        elif len(f_head[-1]) == 1:
            fathers = fathers[1:]
    elif f_head:
        fathers = [(f_head[0], ""), ("", f_head[0])]
    else:
        fathers = [("", "")]
    scored: dict[Reading, float] = {}
    for i, (g, f, s) in enumerate(students):
        for j, (ff, fs) in enumerate(fathers):
            score = closeness(f, ff) + closeness(s, fs) - 0.1 * i - 0.05 * j - (0.5 if len(g) == 1 else 0)
            reading = Reading(g, f, s, ff, fs)
            scored[reading] = max(score, scored.get(reading, -99.0))
    best = sorted(scored, key=lambda r: -scored[r])
    return [r for r in best[:2] if scored[r] > scored[best[0]] - 0.5]


def shortness(short: str, given: str) -> int:
    """How many letters of a given name a short form shares with its beginning; 0 if it is none.

    A short form is a beginning of at least three letters, with or without an ending of vowels."""
    if len(short) < 3 or len(short) > len(given) or short == given:
        return 0
    if given.startswith(short):
        return len(short)
    stem = re.sub(r"[AEIOU]{1,2}$", "", short)
    if len(stem) >= 3 and given.startswith(stem):
        return len(stem)
    return 3 if len(stem) == 2 and given.startswith(short[:3]) else 0


def short_beginnings(short: str) -> set[str]:
    """Beginnings of which every given name that ``short`` is a short form of has one."""
    if len(short) < 3:
        return set()
    stem = re.sub(r"[AEIOU]{1,2}$", "", short)
    return {short, *([stem] if len(stem) >= 3 else []), *([short[:3]] if len(stem) == 2 else [])}


def nickname_of(short: str, given: str) -> bool:
    return shortness(short, given) > 0


def bare_family(token: str) -> str:
    """A family name without a particle written together with it."""
    for particle in ("BEN", "AL", "EL"):
        if token.startswith(particle) and len(token) >= len(particle) + 4:
            return token[len(particle) :]
    return token


def _deletions(token: str, most: int) -> set[str]:
    out, edge = {token}, {token}
    for _ in range(most):
        edge = {t[:i] + t[i + 1 :] for t in edge for i in range(len(t))}
        out |= edge
    return out


def lexicon_edits(a: str, b: str) -> int:
    return 0 if min(len(a), len(b)) < 4 else 1 if min(len(a), len(b)) < 7 else 2


def read_rows(df: DataFrame, label: str, key: str, student: str, father: str | None, place: str | None) -> DataFrame:
    """(tbl, row, place, reading_no, given, father, family, father_own, family_own), and these five as typed: up to two
    readings of each row with a name."""
    null = F.lit(None).cast("string")
    rows = df.select(
        F.lit(label).alias("tbl"),
        F.col(key).cast("long").alias("row"),
        (F.col(place) if place else null).alias("place"),
        F.col(student).alias("student"),
        (F.col(father) if father else null).alias("father"),
    ).filter(F.col("student").isNotNull())

    table = prototypes()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ship_prototypes(table)
        for batch in batches:
            out = []
            for tbl, row, at, s, f in batch.itertuples(index=False):
                for i, r in enumerate(readings(s, f if isinstance(f, str) else None)):
                    out.append((tbl, row, at, i, *map(str, r), *(getattr(t, "raw", t) for t in r)))
            yield pd.DataFrame(out, columns=["tbl", "row", "place", "reading_no", *Reading._fields, *typed])

    typed = [f"{f}_raw" for f in Reading._fields]
    return rows.mapInPandas(work, "tbl string, row long, place string, reading_no int, " + ", ".join(f"{f} string" for f in (*Reading._fields, *typed)))


def spelling_lexicon(tokens: DataFrame, ratio: int = 3, least: int = 3, short: int = 6, short_least: int = 20, short_ratio: int = 10) -> DataFrame:
    """(role, token, canon, n, raw): the usual spelling of each token, how often that is used, and how it is mostly typed.

    tokens: (role, token, uses, and raw where it differs), any number of rows. Distances are those of the sounded or of the typed spellings,
    whichever is less. A spelling belongs to the nearest one within ``lexicon_edits``
    that is used at least ``least`` times and ``ratio`` times as often; the commoner of equally near ones. Tokens
    of fewer than ``short`` letters need more evidence; such given names are left as they are (they may be short forms
    of other names, and are compared row by row). Pairs
    meet through common deletions (two tokens within k edits share a string that k deletions make of both), first
    one, then two for what is left. Everything is counted and joined distributedly; each step is a written table, so
    its readers share it."""
    tokens = tokens if "raw" in tokens.columns else tokens.withColumn("raw", F.col("token"))
    typed = tokens.filter(F.length("token") > 1).groupBy("role", "token", "raw").agg(F.sum("uses").alias("n"))
    counts = stored(typed.groupBy("role", "token").agg(F.sum("n").alias("n"), F.max_by("raw", F.struct("n", "raw")).alias("raw")))

    def keyed_rows(held: list[tuple[str, str, int, str]], sizes: list[int], dels: list[str]) -> pd.DataFrame:
        named = pd.DataFrame(held, columns=["role", "token", "n", "raw"])
        return named.loc[named.index.repeat(sizes)].assign(**{"del": dels})[["role", "del", "token", "n", "raw"]]

    def keyed(df: DataFrame, most: int) -> DataFrame:
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                held: list[tuple[str, str, int, str]] = []
                dels: list[str] = []
                sizes: list[int] = []
                for one in batch[["role", "token", "n", "raw"]].itertuples(index=False, name=None):
                    role, token, _, raw = one
                    forms = {token, bare_family(token), raw, bare_family(raw)} if role == "S" else {token, raw}
                    keys: set[str] = set()
                    for form in forms:
                        keys |= _deletions(form, min(most, 0 if len(form) < 4 else 1 if len(form) < 6 else 2))
                    held.append(one)
                    sizes.append(len(keys))
                    dels += keys
                    if len(dels) > 50_000:  # a name has many keys: a batch of names is given on in parts
                        yield keyed_rows(held, sizes, dels)
                        held, dels, sizes = [], [], []
                yield keyed_rows(held, sizes, dels)

        return df.select("role", "token", "n", "raw").mapInPandas(work, "role string, del string, token string, n long, raw string")

    @F.pandas_udf("int")
    def edits(a: pd.Series, b: pd.Series, a_raw: pd.Series, b_raw: pd.Series) -> pd.Series:
        def one(x: str, y: str, x_raw: str, y_raw: str) -> int:
            best = 9
            for form, hub in {(x, y), (bare_family(x), y), (x_raw, y_raw), (bare_family(x_raw), y_raw)}:
                most = min(lexicon_edits(form, hub), lexicon_edits(x, y))
                d = osa(form, hub, most)
                best = min(best, d if d <= most else 9)
            return best

        return pd.Series([one(*t) for t in zip(a, b, a_raw, b_raw, strict=True)], dtype="int32")

    hubs = counts.filter(F.col("n") >= least)

    def nearest(rare: DataFrame, most: int) -> DataFrame:
        left = keyed(rare, most)
        right = keyed(hubs, most).select("role", "del", F.col("token").alias("hub"), F.col("n").alias("hub_n"), F.col("raw").alias("hub_raw"))
        pairs = left.join(right, ["role", "del"]).filter((F.col("hub") != F.col("token")) & (F.col("hub_n") > F.col("n")) & (F.col("hub_n") >= ratio * F.col("n")) & ((F.length("token") >= short) | ((F.col("role") != "G") & (F.col("hub_n") >= short_least) & (F.col("hub_n") >= short_ratio * F.col("n"))))).select("role", "token", "n", "hub", "hub_n", "raw", "hub_raw").distinct()
        near = pairs.withColumn("d", edits("token", "hub", "raw", "hub_raw")).filter(F.col("d") <= 2)
        return near.groupBy("role", "token").agg(F.min_by(F.struct("hub", "hub_n"), F.struct("d", -F.col("hub_n"), "hub")).alias("best"))

    one = stored(nearest(counts, 1))
    rest = counts.filter(F.length("token") >= 7).join(one, ["role", "token"], "left_anti")
    two = nearest(rest, 2)
    best = stored(one.unionByName(two)).select("role", "token", F.col("best.hub").alias("hub"), F.col("best.hub_n").alias("hub_n"))
    # a hub may itself be a misspelling of a commoner one
    up = best.select("role", F.col("token").alias("hub"), F.col("hub").alias("top"), F.col("hub_n").alias("top_n"))
    final = best.join(up, ["role", "hub"], "left").select("role", "token", F.coalesce("top", "hub").alias("canon"), F.coalesce("top_n", "hub_n").alias("canon_n"))
    told = counts.join(final, ["role", "token"], "left").select("role", "token", F.coalesce("canon", "token").alias("canon"), F.coalesce("canon_n", "n").alias("n"))
    return stored(told.join(counts.select("role", F.col("token").alias("canon"), "raw"), ["role", "canon"]).select("role", "token", "canon", "n", "raw"))


def outnumbered_givens(lexicon: DataFrame, ratio: int = 5, short: int = 6) -> DataFrame:
    """(token): short given names of ``lexicon`` that have a spelling one edit away that is used ``ratio`` times as often.

    Pairs meet through common deletions."""
    names = lexicon.filter((F.col("role") == "G") & F.length("token").between(3, short)).select("token", "n")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(d, token, n) for token, n in batch.itertuples(index=False) for d in _deletions(token, 1)]
            yield pd.DataFrame(out, columns=["del", "token", "n"])

    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([osa(x, y, 1) <= 1 for x, y in zip(a, b, strict=True)], dtype="bool")

    keys = names.mapInPandas(work, "del string, token string, n long").distinct()
    commoner = keys.select("del", F.col("token").alias("hub"), F.col("n").alias("hub_n"))
    pairs = keys.filter(F.length("token") < short).join(commoner, "del").filter((F.col("hub") != F.col("token")) & (F.col("hub_n") >= ratio * F.greatest("n", F.lit(1)))).select("token", "hub").distinct()
    return pairs.filter(close("token", "hub")).select("token").distinct()


def name_uses(rows: DataFrame) -> DataFrame:
    """(role, token, raw, uses): names in all readings, 1 for each use in a likeliest one, 0 in another; G given, F father's,
    S family name."""
    uses = (("G", "given"), ("F", "father"), ("F", "father_own"), ("S", "family"), ("S", "family_own"))
    said = F.array(*(F.struct(F.lit(role).alias("role"), F.col(c).alias("token"), F.col(f"{c}_raw").alias("raw")) for role, c in uses))
    return rows.select(F.explode(said).alias("t"), (F.col("reading_no") == 0).cast("int").alias("uses")).select("t.*", "uses").filter("token <> ''")


def canonical_readings(rows: DataFrame, lexicon: DataFrame, nicknames: dict[str, str]) -> DataFrame:
    """(tbl, row, place, given, father, family, given_n, father_n, family_n, and the names as mostly typed: given_raw,
    father_raw, family_raw): the likeliest reading of each row in usual spellings, and how often those are used.

    Of two readings the one whose tokens are commoner in their roles is taken, of two spellings of the father's or
    family name the commoner. nicknames: sounded short form to sounded given name (a fixed, small table)."""
    joined = rows
    for role, column in (("G", "given"), ("F", "father"), ("F", "father_own"), ("S", "family"), ("S", "family_own")):
        own = lexicon.filter(F.col("role") == role).select(F.col("token").alias(f"{column}_t"), F.col("canon").alias(f"{column}_c"), F.col("n").alias(f"{column}_n"), F.col("raw").alias(f"{column}_as"))
        joined = joined.join(own, F.col(column) == F.col(f"{column}_t"), "left").drop(f"{column}_t")
    told = lambda c: F.struct(F.coalesce(f"{c}_n", F.lit(0)).alias("n"), F.length(c).alias("l"), F.coalesce(f"{c}_c", c).alias("x"), F.coalesce(f"{c}_as", c).alias("raw"))
    given: Column = F.coalesce("given_c", "given")
    given_raw = F.coalesce("given_as", "given")
    if nicknames:
        given = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in nicknames.items() for x in kv]), given), given)
    best = joined.select(
        "tbl", "row", "place", "reading_no", given.alias("given"), given_raw.alias("given_raw"), F.coalesce("given_n", F.lit(0)).alias("given_n"), F.greatest(told("father"), told("father_own")).alias("f"), F.greatest(told("family"), told("family_own")).alias("s")
    )
    weight = F.log1p("given_n") + F.log1p("s.n") + F.lit(0.5) * F.log1p("f.n") - F.lit(0.5) * F.col("reading_no")
    reading = F.struct("place", "given", F.col("f.x").alias("father"), F.col("s.x").alias("family"), "given_n", F.col("f.n").alias("father_n"), F.col("s.n").alias("family_n"), "given_raw", F.col("f.raw").alias("father_raw"), F.col("s.raw").alias("family_raw"))
    return best.groupBy("tbl", "row").agg(F.max_by(reading, F.struct(weight, -F.col("reading_no"))).alias("b")).select("tbl", "row", "b.*")


def nickname_table(df: DataFrame, short: str, given: str, most: int = 10_000) -> dict[str, str]:
    """The table of short forms, sounded; a ValueError if it is not small."""
    rows = df.select(short, given).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} nicknames")
    pairs: Sequence[tuple[str, str]] = [(r[0], r[1]) for r in rows if r[0] and r[1]]
    return {sounded(plain(a)): sounded(plain(b)) for a, b in pairs}
