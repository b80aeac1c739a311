"""Mapping sheets: wave codes, cleaning, checks, codings. Driver-side metadata, one row for each harmonised variable."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# The part of a year each wave letter stands for; three waves a year.
WAVE_PARTS = {"BY": 1, "MY": 2, "EY": 3}
_WAVE = re.compile(r"([BME]Y)(\d+)$", re.IGNORECASE)
_BLANK = re.compile(r"^\s*(?:n/?a)?\s*$", re.IGNORECASE)


@dataclass(frozen=True)
class Issue:
    """One entry of the error channel: what went wrong, where. Never an exception."""

    level: str
    group: str | None
    time: int | None
    variable: str | None
    message: str


def wave_decode(code: str, waves: Sequence[str] | None = None) -> int:
    """BY1 is 1, MY1 2, EY1 3, BY2 4 and so on; with a list of own waves the place in it, without case."""
    if waves is not None:
        return [w.upper() for w in waves].index(code.upper()) + 1
    m = _WAVE.fullmatch(code)
    if not m:
        raise ValueError(f"no wave code: {code}")
    return WAVE_PARTS[m[1].upper()] + 3 * (int(m[2]) - 1)


def wave_encode(index: int, waves: Sequence[str] | None = None) -> str:
    if waves is not None:
        return waves[index - 1]
    part = {v: k for k, v in WAVE_PARTS.items()}[(index - 1) % 3 + 1]
    return f"{part}{(index - 1) // 3 + 1}"


def mapping_column(column: str, waves: Sequence[str] | None = None) -> tuple[str, int] | None:
    """('Name', 1) for Name_BY1; None for a column of no wave."""
    m = re.fullmatch(r"(\w+?)_(\w+)", column)
    if not m or m[1].lower() not in ("name", "code"):
        return None
    try:
        return m[1].capitalize(), wave_decode(m[2], waves)
    except ValueError:
        return None


@dataclass
class MapRow:
    row: int
    group: str | None
    names: dict[int, str | None]
    codes: dict[int, str | None]
    master: str | None
    final_code: str | None
    extra: dict[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class MapColumns:
    """Columns of a sheet besides Name_<wave> and Code_<wave>; matched without case."""

    group: str = "Group"
    master: str = "HomogenizedName"
    coding: tuple[str, ...] = ("FinalCode", "Coding", "final_coding")


def _text(value: object) -> str | None:
    if value is None or (isinstance(value, float) and value != value):
        return None
    text = str(value).strip()
    return None if _BLANK.match(text) else text


def clean_mapping(rows: Sequence[Mapping[str, object]], cols: MapColumns = MapColumns(), waves: Sequence[str] | None = None) -> list[MapRow]:
    """Rows with trimmed texts, missing marks None, all waves between the first and last padded, the group's part
    before a hyphen; columns of only Y and N become booleans; wholly empty rows go."""
    rows = [dict(r) for r in rows]
    columns = list(dict.fromkeys(c for r in rows for c in r))
    lower = {c.lower(): c for c in columns}
    by_wave = {c: mapping_column(c, waves) for c in columns}
    indexes = sorted({m[1] for m in by_wave.values() if m})
    every = range(indexes[0], indexes[-1] + 1) if indexes else range(0)
    clean = [{c: _text(r.get(c)) for c in columns} for r in rows]
    yes_no = {c for c in columns if (values := {r[c].upper() for r in clean if r[c]}) and values <= {"Y", "N"}}
    coding = next((lower[c.lower()] for c in cols.coding if c.lower() in lower), None)
    out = []
    for i, r in enumerate(clean):
        if not any(r.values()):
            continue
        names = {t: None for t in every} | {m[1]: r[c] for c, m in by_wave.items() if m and m[0] == "Name"}
        codes = {t: None for t in every} | {m[1]: r[c] for c, m in by_wave.items() if m and m[0] == "Code"}
        group = r.get(lower.get(cols.group.lower(), ""))
        known = {c for c, m in by_wave.items() if m} | {lower.get(cols.group.lower()), lower.get(cols.master.lower()), coding}
        extra: dict[str, object] = {c: (r[c].upper() == "Y" if r[c] else None) if c in yes_no else r[c] for c in columns if c not in known}
        out.append(MapRow(i + 1, group.split("-")[0].strip() if group else None, names, codes, r.get(lower.get(cols.master.lower(), "")), r.get(coding) if coding else None, extra))
    return out


def check_mapping(rows: Sequence[MapRow], waves: Sequence[str] | None = None) -> tuple[list[MapRow], list[Issue]]:
    """Rows without a problem, and the problems: no group, or a wave's name twice in a group."""
    counts = Counter((r.group, t, n.upper()) for r in rows for t, n in r.names.items() if n)
    good, issues = [], []
    for r in rows:
        own = []
        if r.group is None:
            own.append(Issue("err", None, None, r.master, "NA_GROUP"))
        own += [Issue("err", r.group, t, n, f"DUPLICATE_{wave_encode(t, waves)}") for t, n in r.names.items() if n and counts[(r.group, t, n.upper())] > 1]
        issues += own
        if not own:
            good.append(r)
    return good, issues


def classify_row(initial: str | None, final: str | None, reduction: str | None) -> str:
    """What a codebook row does: drop, reduction, rename, or the reason it does nothing."""
    if reduction and reduction.strip().upper() in ("DROP", "NULL"):
        return "drop"
    if reduction and reduction.strip().upper() != "99DUMMY":
        return "reduction" if final else "issue: no final name"
    if final and initial:
        return "rename"
    return "issue: no initial name" if final else "issue: no final name"


_LIST = re.compile(r"""\bc\s*\(((?:"[^"]*"|'[^']*'|[^()"'])*)\)""")
_ATOM = re.compile(r"""\s*("[^"]*"|'[^']*'|[^,"']+)\s*(?:,|$)""")


def parse_coding(text: str) -> list[tuple[str, str]]:
    """[(value, DESCRIPTION)] of ``cbind(c(values), c(labels))``. Read by a tokenizer, never evaluated; a ValueError
    where it isn't two lists of one length."""
    lists = _LIST.findall(text)
    if not text.strip().startswith("cbind") or len(lists) != 2:
        raise ValueError("a coding is cbind() of two lists")
    values, labels = ([a.strip().strip("\"'").strip() for a in _ATOM.findall(x)] for x in lists)
    if len(values) != len(labels) or not values:
        raise ValueError("values and labels differ in number")
    return list(zip(values, (d.upper() for d in labels), strict=True))


def merge_codings(master: list[tuple[str, str]], wave: list[tuple[str, str]], group: str, variable: str, time: int) -> tuple[dict[str, str], list[Issue]]:
    """Wave value to final value, through descriptions. 'A & B' in the master means either; several wave values of
    one description all map. A description twice among the master's, or one that the master lacks, makes the wave's
    coding unusable (an err); one that only the master has is a warn."""
    issues: list[Issue] = []
    final: dict[str, str] = {}
    for value, description in master:
        for one in (d.strip() for d in description.split("&")):
            if final.setdefault(one, value) != value:
                return {}, [Issue("err", group, time, variable, f"description {one} has two values")]
    have = {d for _, d in wave}
    missing = sorted(have - set(final))
    if missing:
        return {}, [Issue("err", group, time, variable, f"no final value for {', '.join(missing)}")]
    if unused := sorted(set(final) - have):
        issues.append(Issue("warn", group, time, variable, f"no wave value for {', '.join(unused)}"))
    out: dict[str, str] = {}
    for values, description in wave:
        for value in values.split("|"):
            if out.setdefault(value.strip(), final[description]) != final[description]:
                return {}, [Issue("err", group, time, variable, f"value {value} has two descriptions")]
    return out, issues


def subgroup_table(rows: Sequence[tuple[str | None, str]]) -> dict[str, list[str]]:
    """subgroup: variables, from comma-separated tags."""
    out: dict[str, list[str]] = {}
    for tags, variable in rows:
        for tag in (t.strip() for t in (tags or "").split(",")):
            if tag and variable not in out.setdefault(tag, []):
                out[tag].append(variable)
    return out
