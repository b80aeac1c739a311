"""Problem 7: matching entities across sources without keys.

Label-model linkage. Candidate pairs come from blocks of two agreeing attributes. Several heuristic functions vote
on each candidate (for, weakly for, abstain, against); a generative model learns, without labels, how accurate
each function is and how the functions of one group go together, and yields each candidate's posterior confidence.

The model is fitted on counts of vote patterns, of which there are at most a few thousand whatever the number of
candidates; every candidate is counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillpanel.llm.names import allowed, bare_family, canonical_readings, name_uses, nickname_of, osa, plain, read_rows, sounded, spelling_lexicon
from quillpanel.session import stored

# Words for kinds of places, in English and French, and initials they are shortened to.
PLACE_KINDS = "PRIMARY EVENING COMMUNITY LEARNING SCHOOL CENTRE CENTER HUB ECOLE COMMUNALE PRIMAIRE".split()
PLACE_INITIALS = frozenset("PS ES CC LH EC EP".split())


class LabelModel:
    """Two classes (match or not); functions vote small integers, 0 for abstention.

    groups: functions that depend on each other vote as one (their joint distribution is learned); groups are
    independent given the class. Fitted by expectation maximisation from a first guess, which also counts as
    ``anchor`` observations of each pattern, so that few data don't drift away from it."""

    def __init__(self, groups: Sequence[Sequence[int]], smoothing: float = 0.05, anchor: float = 0.5, rounds: int = 200) -> None:
        self.groups, self.smoothing, self.anchor, self.rounds = [tuple(g) for g in groups], smoothing, anchor, rounds

    def _cells(self, patterns: np.ndarray) -> None:
        self.codes, self.sizes = [], []
        for g in self.groups:
            _, code = np.unique(patterns[:, g], axis=0, return_inverse=True)
            self.codes.append(code.reshape(-1))
            self.sizes.append(int(code.max()) + 1)

    def fit(self, patterns: np.ndarray, counts: np.ndarray, start: np.ndarray, ruled_out: np.ndarray) -> np.ndarray:
        """Posterior of each pattern. patterns: patterns x functions; start: first guess of the posteriors;
        ruled_out: patterns that cannot be matches, whatever else agrees."""
        self._cells(patterns)
        guess = np.where(ruled_out, 0.0, start.astype(float))
        post, weight = guess, counts.astype(float)
        for _ in range(self.rounds):
            prior = float(np.clip((post * weight).sum() / weight.sum(), 1e-6, 1 - 1e-6))
            logit = np.full(len(patterns), np.log(prior / (1 - prior)))
            for code, size in zip(self.codes, self.sizes, strict=True):
                yes = np.bincount(code, post * weight + guess * self.anchor, size) + self.smoothing
                no = np.bincount(code, (1 - post) * weight + (1 - guess) * self.anchor, size) + self.smoothing
                logit += (np.log(yes / yes.sum()) - np.log(no / no.sum()))[code]
            new = np.where(ruled_out, 0.0, 1 / (1 + np.exp(-np.clip(logit, -500, 500))))
            if np.abs(new - post).max() < 1e-6:
                return new
            post = new
        return post


def place_word(text: str | None) -> str:
    """The own name of a place: its longest word that is no word for a kind of place, nor one shortened."""
    if not text:
        return ""
    kept = []
    for w in re.findall(r"[^\W\d_]+", plain(text)):
        shortened = any(k.startswith(w) or (len(w) > 3 and osa(w, k, 1) <= 1) for k in PLACE_KINDS) and len(w) != 1
        if w not in PLACE_INITIALS and not shortened and len(w) > 1:
            kept.append(sounded(w))
    return max(kept, key=len, default="")


def teacher_words(text: str | None) -> list[str]:
    from quillpanel.llm.names import name_parts

    head, tail = name_parts(text)
    return head + tail


def vote_names(a: str, b: str, nick: bool = False) -> int:
    """2 equal, 1 a typing error, an initial or a short form apart, 0 unknown, -1 different."""
    if not a or not b:
        return 0
    if a == b:
        return 2 if len(a) > 1 else 1
    if len(a) == 1 or len(b) == 1:
        return 1 if a[0] == b[0] else -1
    a, b = bare_family(a), bare_family(b)
    k = 2 if min(len(a), len(b)) >= 5 else allowed(a, b)
    if osa(a, b, k) <= k or (nick and (nickname_of(a, b) or nickname_of(b, a))):
        return 1
    return -1


def vote_teachers(a: list[str], b: list[str]) -> int:
    """2 two names agree, 1 one agrees and an initial or nothing is left, 0 unknown, -1 no name agrees."""
    if not a or not b:
        return 0
    left, agreed, other = list(b), 0, 0
    for x in sorted(a, key=len, reverse=True):
        hit = next((y for y in left if vote_names(x, y) == 2), None) or next((y for y in left if vote_names(x, y) == 1), None)
        if hit is None:
            other += 1
        else:
            left.remove(hit)
            agreed += len(x) > 1 and len(hit) > 1
    if agreed == 0:
        return -1
    return 2 if agreed >= 2 else 1 if not (other and left) else -1


VOTERS = ("given", "father", "family", "teacher", "place", "region")
# names go together (siblings and namesakes share two of three), and so do the places of one school
GROUPS = ((0, 1, 2), (3, 4, 5))


def _start(pattern: Sequence[int]) -> float:
    """Majority vote: names must not be contradicted, and the places of work must not all be."""
    given, father, family, *others = pattern
    if given < 0 or family < 0 or father < 0:
        return 0.02
    score = given + father + family + sum(others)
    return 0.95 if score >= 6 else 0.6 if score >= 4 else 0.1


def link_without_keys(
    intake: DataFrame,
    master: DataFrame,
    locations: DataFrame,
    nicknames: dict[str, str],
    least_confidence: float = 0.5,
) -> DataFrame:
    """(intake_id, student_id, confidence): the likeliest master entry of each intake row, where one is likelier than not.

    confidence: posterior of the pair, shared with rivals of another id. Rows without a student name have no
    match; NULL attributes abstain; repeated rows are matched each by themselves; empty tables give no row."""
    place_by_id = locations.select(F.upper(F.trim("location_id")).alias("lid"), F.col("location_name").alias("lname"))
    own = intake.select(F.col("intake_id").cast("long").alias("row"), "teacher_name", "location_name", "region")
    a = own.join(place_by_id, F.upper(F.trim("location_name")) == F.col("lid"), "left")
    region = F.translate(F.upper(F.trim(F.col("region"))), "123", "ABS")
    a_facts = a.select("row", "teacher_name", F.coalesce("lname", "location_name").alias("place_name"), F.when(region.isin("A", "B", "S"), region).alias("region"))
    b_facts = master.select(F.col("master_row").cast("long").alias("row"), "teacher_name", F.col("location_name").alias("place_name"), F.upper(F.substring(F.trim("student_id"), 1, 1)).alias("region"), "student_id")
    rows = stored(read_rows(intake, "intake", "intake_id", "student_name", None, None).unionByName(read_rows(master, "master", "master_row", "student_name", "father_name", None)))
    people = stored(canonical_readings(rows, spelling_lexicon(name_uses(rows)), nicknames).select("tbl", "row", "given", "father", "family"))

    known = lambda c: F.length(c) > 1
    key = lambda tag, *cs: F.when(known(cs[0]) & known(cs[1]), F.concat_ws("|", F.lit(tag), *cs))
    keys = F.array_compact(
        F.array(
            key("gs", F.col("given"), F.col("family")),
            key("fs", F.col("father"), F.col("family")),
            key("gf", F.col("given"), F.col("father")),
            key("ps", F.substring("given", 1, 3), F.col("family")),
        )
    )

    def alike(tbl: str, facts: DataFrame, also: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """(row, sig) and one row for each different content of a table: copies are one candidate that counts ``w`` times."""
        content = ("given", "father", "family", "teacher_name", "place_name", "region", *also)
        sig = F.md5(F.to_json(F.struct(*content))).alias("sig")
        told = people.filter(F.col("tbl") == tbl).join(facts, "row")
        return told.select("row", sig), told.groupBy(*content).agg(F.count("*").alias("w")).select(sig, "w", *content)

    rows_a, some_a = alike("intake", a_facts, ())
    _, some_b = alike("master", b_facts, ("student_id",))
    some_a, some_b = stored(some_a), stored(some_b)
    left = some_a.select(F.col("sig").alias("a"), F.explode(keys).alias("key"))
    right = some_b.select(F.col("sig").alias("b"), F.explode(keys).alias("key"))
    pairs = left.join(right, "key").select("a", "b").distinct()
    named = {"given": "given", "father": "father", "family": "family", "teacher_name": "teacher", "place_name": "place", "region": "region"}
    facts_a = some_a.select(F.col("sig").alias("a"), F.col("w").alias("a_w"), *(F.col(c).alias(f"a_{n}") for c, n in named.items()))
    facts_b = some_b.select(F.col("sig").alias("b"), F.col("w").alias("b_w"), *(F.col(c).alias(f"b_{n}") for c, n in named.items()), "student_id")
    wide = pairs.join(facts_a, "a").join(facts_b, "b")

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, list[str]] = {}
        places: dict[str, str] = {}

        def teacher(t: object) -> list[str]:
            if not isinstance(t, str):
                return []
            if t not in words:
                words[t] = teacher_words(t)
            return words[t]

        def place(t: object) -> str:
            if not isinstance(t, str):
                return ""
            if t not in places:
                places[t] = place_word(t)
            return places[t]

        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                pl = vote_names(place(r.a_place), place(r.b_place))
                reg = 0 if not isinstance(r.a_region, str) or not isinstance(r.b_region, str) else 1 if r.a_region == r.b_region else -1
                out.append(
                    (r.a, r.student_id, r.a_w * r.b_w, vote_names(r.a_given, r.b_given, True), vote_names(r.a_father, r.b_father), vote_names(r.a_family, r.b_family), vote_teachers(teacher(r.a_teacher), teacher(r.b_teacher)), min(pl, 2), reg)
                )
            yield pd.DataFrame(out, columns=["a", "student_id", "w", *VOTERS])

    votes = stored(wide.mapInPandas(vote, "a string, student_id string, w long, " + ", ".join(f"{v} int" for v in VOTERS)))
    counted = votes.groupBy(*VOTERS).agg(F.sum("w").alias("n")).collect()  # at most 4^6 patterns
    if not counted:
        return rows_a.join(votes, rows_a["sig"] == votes["a"]).select(F.col("row").alias("intake_id"), "student_id", F.lit(0.0).alias("confidence"))
    patterns = np.array([[r[v] for v in VOTERS] for r in counted])
    counts = np.array([r["n"] for r in counted])
    # a child is its three names: a sibling or a namesake with another father is another child, however much else agrees.
    # Such pairs are known non-matches: they teach the model how those vote, and are none of its matches
    other_child = (patterns[:, :3] < 0).any(axis=1)
    posterior = LabelModel(GROUPS).fit(patterns, counts, np.array([_start(p) for p in patterns]), other_child)
    table = intake.sparkSession.createDataFrame([(*map(int, p), float(q)) for p, q in zip(patterns, posterior, strict=True)], ", ".join(f"{v} int" for v in VOTERS) + ", posterior double")
    scored = votes.join(F.broadcast(table), list(VOTERS)).groupBy("a", "student_id").agg(F.max("posterior").alias("p"))
    odds = F.col("p") / F.greatest(1 - F.col("p"), F.lit(1e-9))
    best = scored.groupBy("a").agg(F.max_by(F.struct("student_id", odds.alias("o")), F.struct(odds, "student_id")).alias("best"), F.sum(odds).alias("all"))
    # of several ids at most one is the child's: the odds of all share one unit with "none of them"
    out = best.join(rows_a, F.col("a") == F.col("sig")).select(F.col("row").alias("intake_id"), F.col("best.student_id").alias("student_id"), F.round(F.col("best.o") / (F.col("all") + 1), 6).alias("confidence"))
    return out.filter(F.col("confidence") >= least_confidence)


