"""The reduction language: a bounded subset of R expressions with ten macros, compiled to columns.

A cell is ``DROP``, ``99DUMMY``, ``$R{expr}`` (row by row, also without the wrapper) or ``$G{expr}`` (by group: an
aggregate over all rows of an id, given to each of them). Text is parsed, never evaluated.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillpanel.operators.clean import or_known
from quillpanel.session import qcol


class DslError(ValueError):
    """What a cell cannot mean; becomes an err row."""


# ---------------------------------------------------------------- tokens and tree
_TOKENS = re.compile(
    r"""\s+ | \#[^\n]*
      | (?P<num>\d+\.?\d*(?:[eE][+-]?\d+)?L?|\.\d+) | (?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*') | (?P<tick>`[^`]+`)
      | (?P<name>\.?[A-Za-z][\w.]*|\.[A-Za-z][\w.]*) | (?P<op>%[^%\s]*%|\|\||&&|<=|>=|==|!=|[-+*/^<>!&|(),\[\]{}=])""",
    re.VERBOSE,
)


@dataclass(frozen=True)
class Node:
    """kind: num, str, name, call, index, op. head: value, name or operator. args: (name or None, node)."""

    kind: str
    head: object
    args: tuple[tuple[str | None, Node], ...] = ()


def _lex(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(text):
        m = _TOKENS.match(text, at)
        if not m:
            raise DslError(f"Error parsing instruction: unexpected {text[at]!r}")
        at = m.end()
        if m.lastgroup:
            out.append((m.lastgroup, m[0]))
    return [*out, ("end", "")]


# Binding powers, low to high; ^ binds to the right.
_POWER = {"||": 10, "|": 10, "%|%": 10, "&&": 20, "&": 20, "==": 40, "!=": 40, "<": 40, "<=": 40, ">": 40, ">=": 40, "+": 50, "-": 50, "*": 60, "/": 60, "^": 90}
_NOT, _PERCENT, _MINUS = 30, 70, 80


class _Parser:
    def __init__(self, text: str) -> None:
        self.tokens, self.at = _lex(text), 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at]

    def take(self, value: str | None = None) -> tuple[str, str]:
        token = self.tokens[self.at]
        if value is not None and token[1] != value:
            raise DslError(f"Error parsing instruction: expected {value!r}, found {token[1] or 'the end'!r}")
        self.at += 1
        return token

    def expression(self, least: int = 0) -> Node:
        kind, text = self.take()
        if kind == "num":
            left = Node("num", float(text.rstrip("L")) if "." in text or "e" in text.lower() else int(text.rstrip("L")))
        elif kind == "str":
            left = Node("str", re.sub(r"\\(.)", r"\1", text[1:-1]))
        elif kind in ("name", "tick"):
            left = Node("name", text.strip("`"))
        elif text == "(":
            left = self.expression()
            self.take(")")
        elif text == "-":
            left = Node("op", "neg", ((None, self.expression(_MINUS)),))
        elif text == "+":
            left = self.expression(_MINUS)
        elif text == "!":
            left = Node("op", "!", ((None, self.expression(_NOT)),))
        else:
            raise DslError(f"Error parsing instruction: unexpected {text or 'end'!r}")
        while True:
            kind, op = self.peek()
            if op in ("(", "["):
                self.take()
                close = ")" if op == "(" else "]"
                args = self.arguments(close)
                left = Node("call" if op == "(" else "index", left.head if op == "(" and left.kind == "name" else left, tuple(args))
                if op == "(" and not isinstance(left.head, str):
                    raise DslError("only named functions can be called")
                continue
            power = _POWER.get(op, _PERCENT if op.startswith("%") else None)
            if kind != "op" or power is None or power < least:
                return left
            self.take()
            right = self.expression(power if op == "^" else power + 1)
            left = Node("op", op, ((None, left), (None, right)))

    def arguments(self, close: str) -> list[tuple[str | None, Node]]:
        out: list[tuple[str | None, Node]] = []
        while self.peek()[1] != close:
            name = None
            if self.peek()[0] in ("name", "tick") and self.tokens[self.at + 1][1] == "=":
                name = self.take()[1].strip("`")
                self.take("=")
            out.append((name, self.expression()))
            if self.peek()[1] == ",":
                self.take()
            elif self.peek()[1] != close:
                raise DslError(f"Error parsing instruction: expected ',' or {close!r}")
        self.take(close)
        return out


def parse(text: str) -> Node:
    parser = _Parser(text)
    node = parser.expression()
    if parser.peek()[0] != "end":
        raise DslError(f"Error parsing instruction: unexpected {parser.peek()[1]!r}")
    return node


@dataclass(frozen=True)
class Cell:
    """A parsed reduction cell: mode drop, rename, row or group."""

    mode: str
    tree: Node | None = None


def parse_cell(text: str) -> Cell:
    body = text.strip()
    if body.upper() in ("DROP", "NULL"):
        return Cell("drop")
    if body.upper() == "99DUMMY":
        return Cell("rename")
    if m := re.fullmatch(r"\$([RG])\s*\{(.*)\}", body, re.DOTALL):
        return Cell("row" if m[1] == "R" else "group", parse(m[2]))
    return Cell("row", parse(body))


# ---------------------------------------------------------------- compiling
@dataclass
class Context:
    """What macros refer to. columns: the table's columns. this: the row's initial variables. subgroup: names of the
    row's subgroups. subgroups: name to variables. origins: group to the variables that came from it."""

    columns: Sequence[str]
    this: Sequence[str] = ()
    subgroup: Sequence[str] = ()
    subgroups: Mapping[str, Sequence[str]] = field(default_factory=dict)
    origins: Mapping[str, Sequence[str]] = field(default_factory=dict)
    key: str = ""
    ids: Sequence[str] = ()
    time: str = ".TIME"
    warn: Callable[[str], None] = lambda message: None


@dataclass(frozen=True)
class Cols:
    """Several columns side by side."""

    names: tuple[str, ...]


@dataclass(frozen=True)
class Strings:
    values: tuple[str, ...]


@dataclass(frozen=True)
class Vector:
    values: tuple[object, ...]


@dataclass(frozen=True)
class Masked:
    """A column of which only some rows count (those of given times)."""

    value: Column
    keep: Column


Value = Column | Cols | Strings | Vector | Masked | bool | int | float | str | None


def _words(args: Sequence[tuple[str | None, Node]]) -> list[str]:
    out = []
    for _, a in args:
        if a.kind not in ("name", "str", "num"):
            raise DslError("a macro takes names")
        out.append(str(a.head))
    return out


@dataclass
class GroupPlan:
    """What a grouped cell needs of its ids: aggregates by name, and modes (name, value, rows that count, NULLs dropped).
    The cell's column refers to them by name; ``with_groups`` adds them to a table."""

    aggregates: dict[str, Column] = field(default_factory=dict)
    modes: list[tuple[str, Column, Column | None, bool]] = field(default_factory=list)


class Compiler:
    def __init__(self, context: Context, grouped: bool) -> None:
        self.c, self.grouped = context, grouped
        self.plan = GroupPlan()

    def of_group(self, aggregate: Column) -> Column:
        name = f"__group_{len(self.plan.aggregates)}"
        self.plan.aggregates[name] = aggregate
        return F.col(name)

    # -- values
    def column(self, value: Value) -> Column:
        if isinstance(value, Column):
            return value
        if isinstance(value, Masked):
            return F.when(value.keep, value.value)
        if isinstance(value, Cols):
            if len(value.names) == 1:
                return qcol(value.names[0])
            raise DslError("several columns where one is needed")
        if isinstance(value, (Strings, Vector)):
            if len(value.values) == 1:
                return F.lit(value.values[0])
            raise DslError("several values where one is needed")
        return F.lit(value)

    def several(self, args: Sequence[tuple[str | None, Node]]) -> list[Column]:
        out: list[Column] = []
        for name, a in args:
            if name is None:
                v = self.value(a)
                out += [qcol(n) for n in v.names] if isinstance(v, Cols) else [self.column(v)]
        return out

    def constants(self, node: Node) -> list[object]:
        v = self.value(node)
        if isinstance(v, (Vector, Strings)):
            return list(v.values)
        if isinstance(v, (bool, int, float, str)) or v is None:
            return [v]
        raise DslError("constants are needed")

    def named(self, args: Sequence[tuple[str | None, Node]], name: str, default: object) -> object:
        for n, a in args:
            if n == name:
                return self.constants(a)[0]
        return default

    # -- tree
    def value(self, node: Node) -> Value:
        if node.kind in ("num", "str"):
            return node.head  # type: ignore[return-value]
        if node.kind == "name":
            return self.name(str(node.head))
        if node.kind == "op":
            return self.operator(str(node.head), [a for _, a in node.args])
        if node.kind == "index":
            return self.index(node)
        return self.call(str(node.head), node.args)

    def name(self, name: str) -> Value:
        constants = {"TRUE": True, "FALSE": False, "T": True, "F": False, "NA": None, "NULL": None, "NA_integer_": None, "NA_character_": None, "NA_real_": None}
        if name in constants and name not in self.c.columns:
            return constants[name]
        if name.startswith("."):
            return self.macro(name, None, None)
        if name not in self.c.columns:
            raise DslError(f"unknown variable {name}")
        return qcol(name)

    def index(self, node: Node) -> Value:
        target = node.head
        assert isinstance(target, Node)
        if target.kind == "name" and str(target.head).startswith("."):
            return self.macro(str(target.head), None, node.args)
        if target.kind == "call" and str(target.head).startswith("."):
            return self.macro(str(target.head), target.args, node.args)
        base = self.value(target)
        places = [int(str(x)) for _, a in node.args for x in self.constants(a)]
        if isinstance(base, (Vector, Strings)):
            return type(base)(tuple(base.values[p - 1] for p in places))  # type: ignore[arg-type]
        if isinstance(base, Cols):
            return Cols(tuple(base.names[p - 1] for p in places))
        raise DslError("only macros and vectors can be indexed")

    def macro(self, name: str, args: Sequence[tuple[str | None, Node]] | None, index: Sequence[tuple[str | None, Node]] | None) -> Value:
        c = self.c
        if name in (".SUBGROUP", ".SGVARNAMES"):
            keys = list(c.subgroup) if index is None else _words(index)
            if index is None and not keys:
                raise DslError(f"{name}: the row has no subgroup")
            names = tuple(dict.fromkeys(v for k in keys for v in c.subgroups.get(k, ()) if v in c.columns))
            return Cols(names) if name == ".SUBGROUP" else Strings(names)
        if name == ".DATABASES":
            stems = [a for a in (_words(args) if args else list(c.this))]
            known = {g for g in c.origins} | {n.rsplit("_", 1)[1] for n in c.columns if "_" in n}
            keys = sorted(k for k in known if any(f"{s}_{k}" in c.columns for s in stems)) if index is None else _words(index)
            for k in keys:
                if not any(f"{s}_{k}" in c.columns for s in stems):
                    c.warn(f".DATABASES: nothing of {k}")
            return Cols(tuple(f"{s}_{k}" for s in stems for k in keys if f"{s}_{k}" in c.columns))
        if name == ".GROUPS":
            if not c.origins:
                raise DslError(".GROUPS: no content origins")
            keys = _words(index or ())
            for k in keys:
                if k not in c.origins:
                    c.warn(f".GROUPS: unknown group {k}")
            return Cols(tuple(v for k in keys for v in c.origins.get(k, ()) if v in c.columns))
        if name == ".THIS":
            if index is None:
                names = tuple(c.this)
            else:
                names = tuple(c.this[int(str(x)) - 1] for _, a in index for x in self.constants(a))
            missing = [n for n in names if n not in c.columns]
            if missing or not names:
                raise DslError(f".THIS: no variable {', '.join(missing)}")
            return qcol(names[0]) if len(names) == 1 else Cols(names)
        if name == ".THISNAME":
            return Strings(tuple(c.this)) if len(c.this) != 1 else c.this[0]
        if name == ".KEY":
            return c.key
        if name == ".TIMES":
            if not self.grouped:
                raise DslError(".TIMES is for grouped reductions")
            times = [x for _, a in (index or ()) for x in self.constants(a)]
            inner = self.value(args[0][1]) if args else self.macro(".THIS", None, None)
            return Masked(self.column(inner), qcol(c.time).isin(*times))
        if name == ".DUMMIFY" and args:
            x, v = self.column(self.value(args[0][1])), self.column(self.value(args[1][1]))
            drop_na = bool(self.named(args, "na.rm", False) or (len(args) > 2 and args[2][0] is None and self.constants(args[2][1])[0]))
            hit = (x == v).cast("int")
            return F.coalesce(hit, F.lit(0)) if drop_na else hit
        if name == ".LOAD" and args:
            path = Path(str(self.constants(args[0][1])[0]))
            if not path.is_file():
                raise DslError(f".LOAD: no file {path}")
            return self.value(parse(path.read_text()))
        raise DslError(f"unknown macro {name}")

    def operator(self, op: str, args: list[Node]) -> Value:
        if op == "neg":
            v = self.value(args[0])
            return -v if isinstance(v, (int, float)) and not isinstance(v, bool) else -self.column(v)
        if op == "!":
            return ~self.column(self.value(args[0])).cast("boolean")
        if op in ("%in%", "%not_in%"):
            hit = F.lit(False)
            x = self.column(self.value(args[0]))
            for v in self.constants(args[1]):
                hit = hit | x.eqNullSafe(F.lit(v))
            return hit if op == "%in%" else ~hit
        x, y = (self.column(self.value(a)) for a in args)
        if op in ("|", "||", "&", "&&", "%|%"):
            x, y = x.cast("boolean"), y.cast("boolean")
            return or_known(x, y) if op == "%|%" else x | y if "|" in op else x & y
        table: dict[str, Callable[[Column, Column], Column]] = {
            "+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b, "/": lambda a, b: F.try_divide(a.cast("double"), b.cast("double")), "^": lambda a, b: F.pow(a, b),
            "%%": lambda a, b: F.pmod(a, b), "%/%": lambda a, b: F.floor(a / b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
        }
        if op not in table:
            raise DslError(f"unknown operator {op}")
        return table[op](x, y)

    def aggregate(self, name: str, args: Sequence[tuple[str | None, Node]]) -> Column:
        """A grouped function: over all rows of the id. With na.rm FALSE any unknown value makes it unknown.

        All are partial aggregates (first and last by time, unknown times last), so an id of any size fits."""
        drop_na = bool(self.named(args, "na.rm", False))
        plain = [a for n, a in args if n is None]
        v = self.value(plain[0])
        keep = v.keep if isinstance(v, Masked) else None
        x = v.value if isinstance(v, Masked) else self.column(v)
        seen = F.when(keep, x) if keep is not None else x
        rows = lambda: self.of_group(F.count(F.when(keep, 1)) if keep is not None else F.count(F.lit(1)))
        if name == "length":
            return rows()
        if name in ("first", "last"):
            by = F.struct(qcol(self.c.time).isNull().alias("n"), qcol(self.c.time).alias("t"), x.alias("x"))
            pick = F.min_by if name == "first" else F.max_by
            return self.of_group(pick(x, F.when(keep, by) if keep is not None else by))
        if name == "MODE":
            mode = f"__mode_{len(self.plan.modes)}"
            self.plan.modes.append((mode, x, keep, drop_na))
            return F.col(mode)
        if name == "unique":
            low, high = self.of_group(F.min(seen)), self.of_group(F.max(seen))
            return F.when(low == high, low)
        plans: dict[str, Callable[[Column], Column]] = {"mean": F.avg, "sum": F.sum, "SUM": F.sum, "min": F.min, "max": F.max, "any": lambda c: F.bool_or(c.cast("boolean")), "all": lambda c: F.bool_and(c.cast("boolean")), "sd": F.stddev_samp, "median": F.median}
        out = self.of_group(plans[name](seen))
        if name in ("SUM", "sum"):
            out = F.coalesce(out, F.lit(0))
        if drop_na or name == "SUM":
            return out
        whole = self.of_group(F.count(seen)) == rows()
        if name == "any":
            return F.when(F.coalesce(out, F.lit(False)), True).when(whole, out)
        if name == "all":
            return F.when(~F.coalesce(out, F.lit(True)), False).when(whole, out)
        return F.when(whole, out)

    def call(self, name: str, args: Sequence[tuple[str | None, Node]]) -> Value:
        if name.startswith("."):
            return self.macro(name, args, None)
        plain = [a for n, a in args if n is None]
        grouped_names = ("mean", "sum", "min", "max", "MODE", "first", "last", "any", "all", "length", "unique", "sd", "median", "SUM")
        if self.grouped and name in grouped_names and len(plain) == 1 and not isinstance(self.value(plain[0]), (Cols, Vector)):
            return self.aggregate(name, args)
        if name == "c":
            values = [x for a in plain for x in self.constants(a)]
            return Strings(tuple(map(str, values))) if values and all(isinstance(x, str) for x in values) else Vector(tuple(values))
        one = lambda i=0: self.column(self.value(plain[i]))
        drop_na = bool(self.named(args, "na.rm", False))
        if name in ROW_FUNCTIONS:
            cols = self.several(args)
            if not cols:
                raise DslError(f"{name}: no columns")
            return ROW_FUNCTIONS[name](cols, drop_na)
        if name == "DEDUMMIFY":
            codes = self.constants(plain[-1])
            cols = self.several([(None, a) for a in plain[:-1]])
            if len(codes) != len(cols):
                raise DslError("DEDUMMIFY: columns and codes differ in number")
            return dedummify(cols, codes)
        if name == "CONSOLIDATE":
            combine = self.named(args, "consolidation_func", None)
            return consolidate(self.several(args), str(combine) if combine is not None else None)
        if name == "ifelse":
            return F.when(one(0).cast("boolean"), one(1)).when(~one(0).cast("boolean"), one(2))
        if name == "case_when":
            out: Column | None = None
            for i in range(0, len(plain) - 1, 2):
                out = F.when(one(i).cast("boolean"), one(i + 1)) if out is None else out.when(one(i).cast("boolean"), one(i + 1))
            if out is None:
                raise DslError("case_when: no case")
            return out.otherwise(one(len(plain) - 1)) if len(plain) % 2 else out
        if name in SCALAR_FUNCTIONS:
            try:
                return SCALAR_FUNCTIONS[name](*(self.value(a) if i and name in ("substr", "gsub", "grepl", "round", "log") else self.column(self.value(a)) for i, a in enumerate(plain)))
            except TypeError as x:
                raise DslError(f"{name}: wrong number of arguments") from x
        if name == "paste0":
            return F.concat(*(F.coalesce(c.cast("string"), F.lit("NA")) for c in self.several(args)))
        raise DslError(f"unknown function {name}")


def mode_of(values: Column) -> Column:
    """Most frequent of an array of structs(x), the first seen of equally frequent ones."""
    distinct = F.array_distinct(values)
    counted = F.transform(distinct, lambda d, i: F.struct(F.size(F.filter(values, lambda v: v["x"].eqNullSafe(d["x"]))).alias("n"), (-i).alias("i"), d["x"].alias("x")))
    return F.array_max(counted)["x"]


def row_mode(cols: Sequence[Column], drop_na: bool) -> Column:
    values = F.array(*(F.struct(c.alias("x")) for c in cols))
    return mode_of(F.filter(values, lambda v: v["x"].isNotNull()) if drop_na else values)


def row_sum(cols: Sequence[Column]) -> Column:
    """Sum without unknown values; 0 where all are unknown."""
    out = F.lit(0)
    for c in cols:
        out = out + F.coalesce(c, F.lit(0))
    return out


def row_mean(cols: Sequence[Column], drop_na: bool) -> Column:
    known = F.lit(0)
    for c in cols:
        known = known + c.isNotNull().cast("int")
    mean = F.try_divide(row_sum(cols).cast("double"), known)
    return mean if drop_na else F.when(known == len(cols), mean)


def consolidate(cols: Sequence[Column], combine: str | None = None) -> Column:
    """The one known value of a row. With several the combiner (max, min, first, paste) decides; without a combiner
    the value is unknown."""
    values = F.array_distinct(F.array_compact(F.array(*cols)))
    first = F.get(values, F.lit(0))
    if combine is None:
        return F.when(F.size(values) <= 1, first)
    how = {"max": F.array_max, "min": F.array_min, "first": lambda v: F.get(v, F.lit(0)), "paste": lambda v: F.array_join(F.transform(v, lambda x: x.cast("string")), ",")}
    if combine not in how:
        raise DslError(f"CONSOLIDATE: unknown combiner {combine}")
    return F.when(F.size(values) > 1, how[combine](values)).otherwise(first)


def dedummify(cols: Sequence[Column], codes: Sequence[object]) -> Column:
    """The code of the column that is 1; unknown where none is. Two ones in a row are an error when it is run."""
    hot = row_sum([(c == 1).cast("int") for c in cols])
    code = F.coalesce(*(F.when(c == 1, F.lit(k)) for c, k in zip(cols, codes, strict=True)))
    kind = "string" if any(isinstance(k, str) for k in codes) else "double" if any(isinstance(k, float) for k in codes) else "int"
    return F.when(hot > 1, F.raise_error(F.lit("DEDUMMIFY: several dummies are 1")).cast(kind)).otherwise(code)


def _strict(cols: Sequence[Column], drop_na: bool, out: Column) -> Column:
    if drop_na:
        return out
    for c in cols:
        out = F.when(c.isNotNull(), out)
    return out


def _any(cols: Sequence[Column], drop_na: bool) -> Column:
    out = F.lit(False)
    for c in cols:
        x = c.cast("boolean")
        out = out | (F.coalesce(x, F.lit(False)) if drop_na else x)
    return out


def _all(cols: Sequence[Column], drop_na: bool) -> Column:
    out = F.lit(True)
    for c in cols:
        x = c.cast("boolean")
        out = out & (F.coalesce(x, F.lit(True)) if drop_na else x)
    return out


ROW_FUNCTIONS: dict[str, Callable[[list[Column], bool], Column]] = {
    "FLATTEN": lambda c, _: F.coalesce(*c),
    "coalesce": lambda c, _: F.coalesce(*c),
    "COALESCE": lambda c, _: F.coalesce(*c),
    "SUM": lambda c, _: row_sum(c),
    "rowSums": lambda c, na: _strict(c, na, row_sum(c)),
    "rowMeans": row_mean,
    "pmin": lambda c, na: _strict(c, na, F.least(*c) if len(c) > 1 else c[0]),
    "pmax": lambda c, na: _strict(c, na, F.greatest(*c) if len(c) > 1 else c[0]),
    "min": lambda c, na: _strict(c, na, F.least(*c) if len(c) > 1 else c[0]),
    "max": lambda c, na: _strict(c, na, F.greatest(*c) if len(c) > 1 else c[0]),
    "sum": lambda c, na: _strict(c, na, row_sum(c)),
    "mean": row_mean,
    "any": _any,
    "all": _all,
    "MODE": row_mode,
    "length": lambda c, _: F.lit(len(c)),
}

SCALAR_FUNCTIONS: dict[str, Callable[..., Column]] = {
    "is.na": lambda c: c.isNull(),
    "abs": F.abs,
    "round": lambda c, n=0: F.bround(c, int(n)),
    "ceiling": F.ceil,
    "floor": F.floor,
    "sqrt": F.sqrt,
    "log": lambda c, base=None: F.log(c) if base is None else F.log(float(base), c),
    "exp": F.exp,
    "nchar": F.length,
    "toupper": F.upper,
    "tolower": F.lower,
    "substr": lambda c, start, stop: F.substring(c.cast("string"), int(start), int(stop) - int(start) + 1),
    "gsub": lambda pattern, new, c: F.regexp_replace(c, str(pattern) if not isinstance(pattern, Column) else pattern, str(new)),
    "grepl": lambda pattern, c: F.regexp_like(c, pattern),
    "as.integer": lambda c: c.try_cast("double").try_cast("int"),
    "as.numeric": lambda c: c.try_cast("double"),
    "as.character": lambda c: c.cast("string"),
    "as.logical": lambda c: c.try_cast("boolean"),
}


def compile_cell(cell: Cell, context: Context) -> tuple[Column, GroupPlan]:
    """The column of a row or group reduction, and what it needs of its groups (nothing for a row reduction).
    Raises DslError for what it cannot mean."""
    if cell.tree is None:
        raise DslError("nothing to compute")
    compiler = Compiler(context, cell.mode == "group")
    return compiler.column(compiler.value(cell.tree)), compiler.plan


def with_groups(df: DataFrame, plan: GroupPlan, ids: Sequence[str], time: str) -> DataFrame:
    """``df`` with the plan's columns: each id's aggregates joined back to its rows (NULL ids are one id).

    A mode is counted by id and value first, so neither an id nor a value is ever collected."""
    keys = [qcol(i).alias(f"__id_{n}") for n, i in enumerate(ids)]
    names = [f"__id_{n}" for n in range(len(ids))]

    def back(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
        on = F.lit(True)
        for i, n in zip(ids, names, strict=True):
            on = on & qcol(i).eqNullSafe(F.col(n))
        joined = left.join(right, on, "left")
        return joined.select(*(qcol(c) for c in left.columns), *columns)

    if plan.aggregates:
        df = back(df, df.groupBy(*keys).agg(*(a.alias(n) for n, a in plan.aggregates.items())), list(plan.aggregates))
    for name, x, keep, drop_na in plan.modes:
        part = df.filter(keep) if keep is not None else df
        part = part.filter(x.isNotNull()) if drop_na else part
        seen = F.struct(qcol(time).isNull().alias("n"), qcol(time).alias("t"))
        counted = part.groupBy(*keys, x.alias("__x")).agg(F.count(F.lit(1)).alias("__n"), F.min(seen).alias("__first"))
        # the most frequent, then the first seen: the least of (-count, first time, value)
        best = counted.groupBy(*names).agg(F.min_by("__x", F.struct((-F.col("__n")).alias("c"), "__first", "__x")).alias(name))
        df = back(df, best, [name])
    return df
