"""Apply a codebook: renames and reductions in sheet order, then drops, then column order.

Reductions are compiled on the driver against the columns known so far; those that don't read each other's results
share one projection, so a sheet of many rows makes a shallow plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from quillpanel.operators.clean import drop_variables, order_by_codebook
from quillpanel.plans.dsl import Cell, Context, DslError, Node, compile_cell, parse_cell, with_groups
from quillpanel.plans.mapping import Issue, mapping_column, subgroup_table
from quillpanel.session import qcol


@dataclass(frozen=True)
class CodebookColumns:
    initial: str = "HomogenizedName"
    subgroup: str = "SubgroupDB3"
    reduction: str = "ReductionDB3"
    final: str = "FinalNameDB3"
    generated: str = "GeneratedDB3"
    group: str = "Group"


@dataclass
class Applied:
    df: DataFrame
    issues: list[Issue] = field(default_factory=list)
    final: list[str] = field(default_factory=list)


def _reads(node: Node | None) -> set[str]:
    if node is None:
        return set()
    out = {str(node.head)} if node.kind == "name" else _reads(node.head) if isinstance(node.head, Node) else set()
    for _, a in node.args:
        out |= _reads(a)
    return out


def _present(row: Mapping[str, object], when: int | None, generated: str, waves: Sequence[str] | None) -> bool:
    names = {m[1]: v for c, v in row.items() if (m := mapping_column(c, waves)) and m[0] == "Name"}
    marked = row.get(generated) is True or str(row.get(generated) or "").upper() in ("TRUE", "T", "Y", "1")
    return when is None or marked or not any(names.values()) or bool(names.get(when))


def apply_codebook(
    df: DataFrame,
    codebook: Sequence[Mapping[str, object]],
    *,
    ids: Sequence[str],
    time: str = ".TIME",
    cols: CodebookColumns = CodebookColumns(),
    group: str | None = None,
    when: int | None = None,
    key: str = "merged",
    origins: Mapping[str, Sequence[str]] | None = None,
    waves: Sequence[str] | None = None,
) -> Applied:
    """``df`` after the codebook. Rows of ``codebook`` are mappings by the names in ``cols``.

    A row without a reduction, or with 99DUMMY, renames its initial variable; DROP removes it, after everything else;
    any other reduction makes the final variable (once for each final name where a subgroup is set). What a row cannot
    mean (parse errors, unknown names or functions, no final name, a missing variable) becomes an err issue and the
    next row goes on. group: only rows of this group, or without one. when: only rows that are present in this wave:
    those that name a variable in its Name_<wave>, that name none in any wave, or that are marked as generated."""
    rows = [{k: (str(v).strip() or None) if v is not None and not isinstance(v, bool) else v for k, v in r.items()} for r in codebook]
    rows = [r for r in rows if (group is None or r.get(cols.group) in (None, group)) and _present(r, when, cols.generated, waves)]
    name = lambda r: str(r[cols.initial]).upper() if r.get(cols.initial) and str(r[cols.initial]).upper() in known else r.get(cols.initial)
    known = set(df.columns)
    subgroups = subgroup_table([(r.get(cols.subgroup), name(r)) for r in rows if r.get(cols.initial)])
    issues: list[Issue] = []
    final: list[str] = []
    dropped: list[str] = []
    done: set[str] = set()
    current, level = df, {}

    def flush() -> None:
        nonlocal current, level
        if level:
            current = current.withColumns(level)
            level = {}

    for r in rows:
        initial, end, text = name(r), r.get(cols.final), r.get(cols.reduction)
        err = lambda m: issues.append(Issue("err", group, when, str(end or initial), m))  # noqa: B023, E731
        try:
            cell = parse_cell(str(text)) if text else Cell("rename")
        except DslError as x:
            err(str(x))
            continue
        if cell.mode == "drop":
            if initial in known:
                dropped.append(str(initial))
            else:
                err("variable to drop not in table")
            continue
        if not end:
            if text:
                err("no final name")
            continue
        end = str(end)
        if cell.mode == "rename":
            if initial not in known:
                err("variable not in table")
                continue
            if str(initial) in level:
                flush()
            value: Column = qcol(str(initial))
            if str(initial) != end:
                dropped.append(str(initial))
        else:
            tags = [t.strip() for t in str(r.get(cols.subgroup) or "").split(",") if t.strip()]
            if tags and end in done:
                continue
            if _reads(cell.tree) & set(level) or any(n in level for t in tags for n in subgroups.get(t, ())) or initial in level:
                flush()
            context = Context(
                columns=[*current.columns, *level],
                this=[str(initial)] if initial else [],
                subgroup=tags,
                subgroups=subgroups,
                origins=origins or {},
                key=key,
                ids=ids,
                time=time,
                warn=lambda m: issues.append(Issue("warn", group, when, str(end), m)),  # noqa: B023
            )
            try:
                value, groups = compile_cell(cell, context)
            except (DslError, IndexError) as x:
                err(str(x))
                continue
            if groups.aggregates or groups.modes:
                flush()
                before = current.columns
                joined = with_groups(current, groups, ids, time).withColumn(end, value)
                current = joined.select(*map(qcol, dict.fromkeys([*before, end])))
                done.add(end)
                known.add(end)
                final += [end] if end not in final else []
                continue
        level[end] = value
        done.add(end)
        known.add(end)
        if end not in final:
            final.append(end)
    flush()
    kept = drop_variables(current, [d for d in dropped if d not in final and d not in ids and d != time])
    lead = [c for c in [*ids, time] if c in kept.columns]
    return Applied(order_by_codebook(kept, [*lead, *final]), issues, final)
