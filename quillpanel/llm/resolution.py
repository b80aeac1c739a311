"""Problem 5: variant spellings of names typed by people.

Merge-and-rematch resolution. Rows become profiles: sets of spellings of given, father's and family name, initials
and places. Profiles meet in blocks (two of the three names, or a name's beginning with the family name), matching
ones merge, their spellings and initials are united, and the richer profiles enter blocking again, until a round
merges nothing. A profile with an incomplete father's name joins a fuller one only where one alone fits, so
namesakes with other fathers stay apart.

Equal readings are one profile from the start, whatever their number of rows, so a block holds the different readings
of a name in usual spellings and grows with the names in use, not with the rows: a name that a third of all rows
share is as many profiles as it has fathers (and places, where the father isn't known). A block is read as one sorted
run; members find their group by looking names, letters and places up, and each yields one edge to its leader.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillpanel.llm.components import connected_components
from quillpanel.llm.names import _deletions, allowed, canonical_readings, name_uses, osa, outnumbered_givens, read_rows, short_beginnings, shortness, spelling_lexicon
from quillpanel.session import durable, stored


class Profile(NamedTuple):
    pid: str
    givens: tuple[str, ...]
    fathers: tuple[str, ...]
    families: tuple[str, ...]
    places: tuple[str, ...]
    sure: frozenset[str]
    weight: int
    raws: Mapping[str, str] = {}  # names as typed, where that isn't as they sound

    @property
    def full_fathers(self) -> list[str]:
        return [f for f in self.fathers if len(f) > 1]

    @property
    def initials(self) -> set[str]:
        return {f for f in self.fathers if len(f) == 1}


def _alike(a: Iterable[str], b: Iterable[str], sure: frozenset[str], beside: Iterable[str] = (), raws: Mapping[str, str] = {}) -> bool:  # noqa: B006
    """Whether any two spellings are equal or a typing error apart, as they sound or as they are typed (``raws``). Two
    established names (``sure``) are not.

    Five letters may hide two errors if one spelling is established and the other is no short form of a name
    ``beside`` them."""
    if set(a) & set(b):
        return True

    def near(x: str, y: str) -> bool:
        if len(x) < 3 or len(y) < 3 or (x in sure and y in sure):
            return False
        k = allowed(x, y)
        if osa(x, y, k) <= k:
            return True
        if raws:
            p, q = raws.get(x, x), raws.get(y, y)
            k = min(k, allowed(p, q))
            if osa(p, q, k) <= k:
                return True
        rare = x if y in sure else y if x in sure else ""
        return bool(rare) and min(len(x), len(y)) == 5 and osa(x, y, 2) <= 2 and not any(shortness(rare, z) for z in beside)

    return any(near(x, y) for x in a for y in b)


def _short(a: tuple[str, ...], b: tuple[str, ...]) -> int:
    return max((max(shortness(x, y), shortness(y, x)) for x in a for y in b), default=0)


def _fathers_agree(a: Profile, b: Profile) -> bool:
    """Full names must be alike; an initial must begin the other's name; unknown agrees with anything."""
    fa, fb = a.full_fathers, b.full_fathers
    if fa and fb:
        return _alike(fa, fb, a.sure | b.sure, (), {**a.raws, **b.raws})
    known, other = (a, b) if fa else (b, a)
    begins = {f[0] for f in known.fathers if f}
    return not begins or not other.initials or bool(begins & other.initials)


class _Names:
    """Groups of a block by the names of their leaders: equal names are looked up, close ones found through common
    deletions, so a block of many spellings is never compared name by name."""

    FEW = 12  # so few groups are compared faster than indexed

    def __init__(self) -> None:
        self.groups: list[list[Profile]] = []
        self.exact: dict[str, int] = {}
        self.close: dict[str, list[int]] = {}
        self.indexed = 0

    def add(self, group: list[Profile]) -> int:
        self.groups.append(group)
        return len(self.groups) - 1

    def near(self, names: Iterable[str], raws: Mapping[str, str], of: Callable[[Profile], Iterable[str]]) -> Iterable[int]:
        """Places of the groups whose leader can have a close name, in order."""
        if len(self.groups) <= self.FEW:
            return range(len(self.groups))
        while self.indexed < len(self.groups):
            leader = self.groups[self.indexed][0]
            for d in self._keys(of(leader), leader.raws):
                self.close.setdefault(d, []).append(self.indexed)
            self.indexed += 1
        return sorted({i for d in self._keys(names, raws) for i in self.close.get(d, ())})

    @staticmethod
    def _keys(names: Iterable[str], raws: Mapping[str, str]) -> set[str]:
        forms = {f for x in names for f in (x, raws.get(x, x))}
        return {d for f in forms for d in _deletions(f, _reach(f))}


def _reach(name: str) -> int:
    """The most edits that ``_alike`` can allow a name of this length."""
    return 0 if len(name) < 3 else 1 if len(name) < 5 else 2


def _firsts(leader: Profile) -> set[str]:
    return {f[0] for f in leader.fathers if f}


class _Fathers:
    """Groups by the first letters of their leaders' fathers, by place, and by given name."""

    def __init__(self, groups: list[list[Profile]]) -> None:
        self.every = set(range(len(groups)))
        self.begin: dict[str, set[int]] = {}
        self.nameless: set[int] = set()
        self.place: dict[str, set[int]] = {}
        self.given: dict[str, set[int]] = {}
        self.longer: dict[str, set[str]] = {}  # beginnings of at least three letters to given names
        self.shorter: dict[str, set[str]] = {}  # what a given name, as a short form, can be the beginning of
        for i, group in enumerate(groups):
            letters = _firsts(group[0])
            for letter in letters:
                self.begin.setdefault(letter, set()).add(i)
            if not letters:
                self.nameless.add(i)
            for name in group[0].givens:
                if name not in self.given:
                    self._index(name)
                self.given.setdefault(name, set()).add(i)
            for m in group:
                for p in m.places:
                    self.place.setdefault(p, set()).add(i)

    def _index(self, name: str) -> None:
        for n in range(3, len(name) + 1):
            self.longer.setdefault(name[:n], set()).add(name)
        for begin in short_beginnings(name):
            self.shorter.setdefault(begin, set()).add(name)

    def short_or_full(self, name: str) -> set[str]:
        """Given names that ``name`` can be a short form of, or that can be one of it."""
        out = set().union(*(self.longer.get(b, ()) for b in short_beginnings(name)))
        return out.union(*(self.shorter.get(name[:n], ()) for n in range(3, len(name) + 1)))

    def agreeing(self, m: Profile) -> set[int]:
        """Groups whose leader's father can be that of ``m``, who has no full one."""
        return self.every if not m.initials else self.nameless.union(*(self.begin.get(x, ()) for x in m.initials))

    def beside(self, m: Profile, fits: set[int]) -> set[int]:
        """Of several groups the only one at a place of ``m``; all if none or several are."""
        if len(fits) > 1 and m.places:
            here = set().union(*(self.place.get(p, ()) for p in m.places)) & fits
            return here if len(here) == 1 else fits
        return fits


def match_block(kind: str, members: list[Profile]) -> Iterator[tuple[str, str, int]]:
    """Edges of one block, each member to the leader of its group, and how loose each is (0: both fathers are known).

    kind F: father and family are equal; G: given and family; B: given and father; P: family and the beginning of
    the given name. Members with a full father are grouped first, then the others find the only group that fits.
    Everything is looked up by name, letter or place; work grows with the members, not with their pairs."""
    members = sorted(members, key=lambda m: (not m.full_fathers, -m.weight, m.pid))
    names: Callable[[Profile], Iterable[str]] = {"F": lambda m: m.givens, "G": lambda m: m.full_fathers, "B": lambda m: m.families, "P": lambda m: m.givens}[kind]
    index, waiting = _Names(), []
    by_given: dict[str, list[int]] = {}
    beside = {g for m in members for g in m.givens} if kind == "F" else ()
    for m in members:
        if kind != "F" and not m.full_fathers:
            waiting.append(m)
            continue
        if kind == "P":
            at = next((i for i in sorted({i for g in m.givens for i in by_given.get(g, ())}) if _fathers_agree(m, index.groups[i][0])), None)
        else:
            at = next((index.exact[x] for x in names(m) if x in index.exact), None)
            if at is None:
                at = next((i for i in index.near(names(m), m.raws, names) if _alike(names(m), names(x := index.groups[i][0]), m.sure | x.sure, beside, {**m.raws, **x.raws})), None)
        if at is None:
            at = index.add([])
            for g in m.givens if kind == "P" else ():
                by_given.setdefault(g, []).append(at)
        index.groups[at].append(m)
        for x in names(m):
            index.exact.setdefault(x, at)
    groups = index.groups
    if kind == "F":
        # short forms: of this father's children the only one whose name begins most like it
        begins: dict[str, set[int]] = {}
        for i, x in enumerate(groups):
            for g in x[0].givens:
                begins.setdefault(g[:3], set()).add(i)
        for i, x in enumerate(groups):
            others = set().union(*(begins.get(g[:3], ()) for g in x[0].givens)) - {i}
            strength = [(max(shortness(s, full) for s in x[0].givens for full in groups[j][0].givens), j) for j in others]
            most = max((k for k, _ in strength), default=0)
            fits = [j for k, j in strength if k == most]
            if most and len(fits) == 1:
                yield x[0].pid, groups[fits[0]][0].pid, 0
    fathers = _Fathers(groups) if waiting else None
    loose: list[tuple[list[Profile], list[frozenset[str]]]] = []
    for m in waiting:
        fits = set() if kind == "B" else fathers.agreeing(m)
        if kind == "P":
            if fits.intersection(*[set().union(*(fathers.given.get(g, ()) for g in m.givens))]):
                continue  # the whole name is there: the block of given and family name decides
            best: dict[int, set[int]] = {}
            for full in set().union(*(fathers.short_or_full(g) for g in m.givens)):
                k, where = _short(m.givens, (full,)), fathers.given[full]
                if k and not where.isdisjoint(fits):
                    best.setdefault(k, set()).update(where & fits)
            fits = best[max(best)] if best else set()
        fits = fathers.beside(m, fits)
        if len(fits) == 1:
            yield m.pid, groups[next(iter(fits))][0].pid, 1 if kind == "G" else 2
        elif not fits and kind == "G":
            mine = frozenset(m.initials)
            for held, letters in loose:
                if all(not x or not mine or x & mine for x in letters):
                    held.append(m)
                    if mine not in letters:
                        letters.append(mine)
                    break
            else:
                loose.append(([m], [mine]))
    for looseness, found in ((0, groups), (3, [held for held, _ in loose])):
        for group in found:
            for m in group[1:]:
                yield m.pid, group[0].pid, looseness


def _blocks(profiles: DataFrame) -> DataFrame:
    """(key, profile columns): a row for each block a profile enters."""
    full = F.filter("fathers", lambda f: F.length(f) > 1)
    known = lambda c: F.filter(c, lambda x: F.length(x) > 1)
    cross = lambda tag, a, b: F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.concat(F.lit(tag + "|"), x, F.lit("|"), y))))
    ends = F.transform(known("families"), lambda s: F.substring(s, 1, 2))
    tails = F.transform(known("families"), lambda s: F.substring(s, -2, 2))
    gf = F.array_distinct(F.concat(cross("<", ends, full), cross(">", tails, full)))
    keys = F.concat(
        cross("F", full, known("families")),
        cross("G", known("givens"), known("families")),
        F.flatten(F.transform(known("givens"), lambda g: F.transform(gf, lambda k: F.concat(F.lit("B|"), g, F.lit("|"), k)))),
        cross("P", F.transform(known("givens"), lambda g: F.substring(g, 1, 3)), known("families")),
    )
    return profiles.select(F.explode(F.array_distinct(keys)).alias("key"), "pid", "givens", "fathers", "families", "places", "sure", "weight", "raws", "fresh")


def _matched(blocks: DataFrame) -> DataFrame:
    """Edges of all blocks. Only blocks of several profiles that hold a fresh one (new, or richer since the last round)
    are looked at: in the others nothing can have become alike. A profile whose father isn't known
    keeps one edge, the least loose, so that it never joins two persons."""
    crowded = stored(blocks.groupBy("key").agg(F.count("*").alias("c"), F.bool_or("fresh").alias("f")).filter("c > 1 AND f").select("key"))
    sorted_runs = blocks.join(crowded, "key", "left_semi").drop("fresh").repartition("key").sortWithinPartitions("key", "pid")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, members = None, []
        out: list[tuple[str, str, int]] = []
        for batch in batches:
            for k, pid, givens, fathers, families, places, sure, weight, raws in batch.itertuples(index=False):
                if k != key:
                    if len(members) > 1:
                        out += match_block(key[0], members)
                    key, members = k, []
                members.append(Profile(pid, tuple(givens), tuple(fathers), tuple(families), tuple(places), frozenset(sure), weight, dict(r.split("=", 1) for r in raws)))
            yield pd.DataFrame(out, columns=["a", "b", "loose"])
            out = []
        if len(members) > 1:
            out += match_block(key[0], members)
        yield pd.DataFrame(out, columns=["a", "b", "loose"])

    edges = durable(sorted_runs.mapInPandas(work, "a string, b string, loose int"))
    firm = edges.filter("loose = 0").select("a", "b").distinct()
    single = edges.filter("loose > 0").groupBy("a").agg(F.min_by("b", F.struct("loose", "b")).alias("b"))
    return firm.unionByName(single)


def resolve_people(tables: Mapping[str, tuple[DataFrame, str, str, str, str]], nicknames: dict[str, str], established: float = 0.0004, max_rounds: int = 20) -> DataFrame:
    """(tbl, row, entity): which person each row describes.

    tables: label to (table, key, student name, father's name, place). Rows without a student name are persons of
    their own and left out; NULL fathers and places are unknown; repeated rows are one profile; empty tables give
    no row. established: names with this share of the uses in their role (and more than one use) are never each other's
    misspelling, unless a close given name is five times commoner; so a larger table of the same kind decides alike. ``max_rounds`` only guards against an endless loop: rounds end when nothing merges."""
    parts = [read_rows(df, label, key, student, father, place) for label, (df, key, student, father, place) in tables.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = stored(rows)
    uses = name_uses(rows).filter(F.length("token") > 1)
    lexicon = spelling_lexicon(uses)
    rare = outnumbered_givens(lexicon).select(F.col("token").alias("given"), F.lit(True).alias("given_rare"))
    people = stored(canonical_readings(rows, lexicon, nicknames).join(rare, "given", "left"))
    total = {r["role"]: r["n"] for r in uses.groupBy("role").agg(F.sum("uses").alias("n")).collect()}
    sure = lambda c, role: (F.col(f"{c}_n") >= max(2.0, established * total.get(role, 0)))
    incomplete = F.length("father") < 2
    pid = F.concat_ws("|", "given", "father", "family", F.when(incomplete, F.coalesce("place", F.lit(""))))
    placed = people.withColumn("pid", pid)
    firm = {"given": sure("given", "G") & F.col("given_rare").isNull(), "father": sure("father", "F"), "family": sure("family", "S")}
    known = F.array_compact(F.array(*(F.when(is_sure, F.col(c)) for c, is_sure in firm.items())))
    said = F.array_compact(F.array(*(F.when((F.length(c) > 1) & (F.col(c) != F.col(f"{c}_raw")), F.concat(c, F.lit("="), f"{c}_raw")) for c in ("given", "father", "family"))))
    profiles = durable(
        placed.groupBy("pid").agg(
            F.collect_set("given").alias("givens"),
            F.collect_set(F.when(F.col("father") != "", F.col("father"))).alias("fathers"),
            F.collect_set(F.when(F.col("family") != "", F.col("family"))).alias("families"),
            F.collect_set("place").alias("places"),
            F.array_distinct(F.flatten(F.collect_set(known))).alias("sure"),
            F.count("*").alias("weight"),
            F.array_distinct(F.flatten(F.collect_set(said))).alias("raws"),
            F.lit(True).alias("fresh"),
        )
    )
    membership = profiles.select(F.col("pid").alias("start"), F.col("pid").alias("entity"))
    for _ in range(max_rounds):
        edges = _matched(_blocks(profiles)).persist()
        if edges.limit(1).count() == 0:
            break
        components = connected_components(edges)
        moved = profiles.join(components, profiles["pid"] == components["node"], "left").withColumn("to", F.coalesce("component", "pid"))
        union = lambda c: F.array_distinct(F.flatten(F.collect_set(c))).alias(c)
        membership = durable(membership.join(components, membership["entity"] == components["node"], "left").select("start", F.coalesce("component", "entity").alias("entity")))
        profiles = durable(moved.groupBy("to").agg(*(union(c) for c in ("givens", "fathers", "families", "places", "sure", "raws")), F.sum("weight").alias("weight"), (F.count("*") > 1).alias("fresh")).withColumnRenamed("to", "pid"))
        edges.unpersist()
    else:
        raise RuntimeError(f"profiles still merge after {max_rounds} rounds")
    return placed.join(membership, placed["pid"] == membership["start"]).select("tbl", "row", "entity")


def person_pairs(resolved: DataFrame) -> DataFrame:
    """(tbl, row_a, row_b): all pairs of one person's rows within a table, row_a < row_b."""
    left = resolved.select("tbl", "entity", F.col("row").alias("row_a"))
    right = resolved.select("tbl", "entity", F.col("row").alias("row_b"))
    return left.join(right, ["tbl", "entity"]).filter(F.col("row_a") < F.col("row_b")).select("tbl", "row_a", "row_b")
