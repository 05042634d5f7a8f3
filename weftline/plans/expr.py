"""The factor algebra: expressions over a (date, code) panel, scheduled into as few staged selects as possible.

An expression is a tree of hash-consed nodes, so equal subexpressions are one column. Scalar nodes are inlined; windows
(by code over dates, or by date over codes) become columns. All windows whose inputs are ready go into one select, first
all by code, then all by date, so a plan shuffles once for each change between the two. Missing values are NULL; a rolling
value exists only where all rows of its window do; a comparison with NULL is false; a division by zero is NULL.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_nodes: dict[tuple, E] = {}

BY_CODE, BY_DATE, FOLD = "code", "date", "fold"


class E:
    """A node; make(op, *args) gives the same object for the same arguments."""

    __slots__ = ("op", "args", "key")

    @staticmethod
    def make(op: str, *args) -> E:
        key = (op, *[("#", id(a)) if isinstance(a, E) else a for a in args])
        if key not in _nodes:
            e = _nodes[key] = object.__new__(E)
            e.op, e.args, e.key = op, args, len(_nodes)
        return _nodes[key]

    def __add__(self, x):
        return E.make("+", self, lift(x))

    def __radd__(self, x):
        return E.make("+", lift(x), self)

    def __sub__(self, x):
        return E.make("-", self, lift(x))

    def __rsub__(self, x):
        return E.make("-", lift(x), self)

    def __mul__(self, x):
        return E.make("*", self, lift(x))

    def __rmul__(self, x):
        return E.make("*", lift(x), self)

    def __truediv__(self, x):
        return E.make("/", self, lift(x))

    def __rtruediv__(self, x):
        return E.make("/", lift(x), self)

    def __neg__(self):
        return E.make("neg", self)

    def __pow__(self, x):
        return E.make("pow", self, lift(x))

    def __lt__(self, x):
        return E.make("<", self, lift(x))

    def __le__(self, x):
        return E.make("<=", self, lift(x))

    def __gt__(self, x):
        return E.make(">", self, lift(x))

    def __ge__(self, x):
        return E.make(">=", self, lift(x))

    def eq(self, x):
        return E.make("=", self, lift(x))

    def __and__(self, x):
        return E.make("and", self, x)

    def __or__(self, x):
        return E.make("or", self, x)

    def __invert__(self):
        return E.make("not", self)


def lift(x) -> E:
    return x if isinstance(x, E) else E.make("num", float(x))


def var(name: str) -> E:
    return E.make("var", name)


def lag(x: E, n: int = 1) -> E:
    return E.make("lag", x, n)


def delta(x: E, n: int = 1) -> E:
    return x - lag(x, n)


def total(x: E, n: int) -> E:
    return E.make("roll", "sum", x, n)


def mean(x: E, n: int) -> E:
    return E.make("roll", "avg", x, n)


def std(x: E, n: int) -> E:
    return E.make("roll", "stddev_samp", x, n)


def variance(x: E, n: int) -> E:
    return E.make("roll", "var_samp", x, n)


def highest(x: E, n: int) -> E:
    return E.make("roll", "max", x, n)


def lowest(x: E, n: int) -> E:
    return E.make("roll", "min", x, n)


def cov(x: E, y: E, n: int) -> E:
    """Population covariance."""
    both = where_any(x, y)
    x, y = if_known(both, x), if_known(both, y)
    return mean(x * y, n) - mean(x, n) * mean(y, n)


def where_any(x: E, y: E) -> E:
    return x * 0 + y * 0


def if_known(mark: E, x: E) -> E:
    return E.make("known", mark, x)


#: A variance is taken as zero up to this share of the second moment.
TINY = 1e-12


def corr(x: E, y: E, n: int, degenerate: float | None = None) -> E:
    """Correlation of population moments; where a variance is zero: NULL, or the given value."""
    both = where_any(x, y)
    x, y = if_known(both, x), if_known(both, y)
    mx, my, mxx, myy = mean(x, n), mean(y, n), mean(x * x, n), mean(y * y, n)
    vx, vy = mxx - mx * mx, myy - my * my
    ready = (vx > TINY * mxx) & (vy > TINY * myy)
    value = E.make("round", (mean(x * y, n) - mx * my) / sqrt(vx * vy))  # so that equal correlations tie
    return E.make("if", ready, value, lift(degenerate) if degenerate is not None else E.make("null"))


def rank(x: E) -> E:
    """Share of the codes of a date at or below, ties averaged."""
    return E.make("rank", x)


def decay(x: E, n: int) -> E:
    """Weights 1 .. n, the newest heaviest."""
    return E.make("decay", x, n)


def slope(x: E, n: int) -> E:
    """Least-squares slope on 1 .. n."""
    half = (n + 1) / 2
    return (decay(x, n) * (n * (n + 1) / 2) - total(x, n) * half) / (n * (n * n - 1) / 12)


def beta(y: E, x: E, n: int) -> E:
    """Slope of y on x as the catalogue has it: population covariance over sample variance."""
    return cov(y, x, n) / variance(x, n)


def tsrank(x: E, n: int) -> E:
    """Share of the window's values at or below the last one."""
    return E.make("tsrank", x, n)


def high_day(x: E, n: int) -> E:
    """Rows since the window's highest value, the oldest of equal ones."""
    return E.make("argext", "max", x, n)


def low_day(x: E, n: int) -> E:
    return E.make("argext", "min", x, n)


def ema(x: E, n: int, m: int) -> E:
    """Recursive mean with weight m / n for the new value, from the first value on; a gap lets the old weight decay."""
    return E.make("ema", x, n, m)


def cumulative_product(x: E) -> E:
    """Of positive values, from the panel's start."""
    return E.make("cumprod", x)


def iff(cond: E, a, b) -> E:
    return E.make("if", cond, lift(a), lift(b))


def flag(cond: E) -> E:
    return iff(cond, 1.0, 0.0)


def filtered(x: E, cond: E) -> E:
    return E.make("if", cond, x, E.make("null"))


def count(cond: E, n: int) -> E:
    return total(flag(cond), n)


def sum_if(x: E, n: int, cond: E) -> E:
    return total(iff(cond, x, 0.0), n)


def product(x: E, n: int) -> E:
    return E.make("roll", "product", x, n)


def low(x, y) -> E:
    return E.make("min", lift(x), lift(y))


def high(x, y) -> E:
    return E.make("max", lift(x), lift(y))


def absolute(x: E) -> E:
    return E.make("abs", x)


def sqrt(x: E) -> E:
    return E.make("sqrt", x)


def log(x: E) -> E:
    """ln(max(x, 1e-12))."""
    return E.make("ln", x)


def sign(x: E) -> E:
    """NULL stays NULL."""
    return E.make("sign", x)


def sign0(x: E) -> E:
    """NULL becomes 0."""
    return E.make("sign0", x)


_WINDOW = {"lag": BY_CODE, "roll": BY_CODE, "decay": BY_CODE, "tsrank": BY_CODE, "argext": BY_CODE, "cumprod": BY_CODE, "rank": BY_DATE, "ema": FOLD}
_OVER = "PARTITION BY code ORDER BY date"


def _inputs(e: E) -> Iterable[E]:
    return (a for a in e.args if isinstance(a, E))


class Plan:
    """Stages for some named expressions: lists of (kind, nodes), each node a window whose inputs are ready before."""

    def __init__(self, outputs: dict[str, E]):
        self.outputs = outputs
        self.windows: list[E] = []
        seen: set[int] = set()

        def visit(root: E) -> None:
            stack = [(root, False)]
            while stack:
                e, done = stack.pop()
                if done:
                    if e.op in _WINDOW:
                        self.windows.append(e)
                elif e.key not in seen:
                    seen.add(e.key)
                    stack.append((e, True))
                    stack += [(a, False) for a in _inputs(e)]

        for e in outputs.values():
            visit(e)
        self.needs = {w.key: self._below(w) for w in self.windows}
        self.stages: list[tuple[str, list[E]]] = []
        done: set[int] = set()
        left = list(self.windows)
        while left:
            for kind in (BY_CODE, FOLD, BY_DATE):
                while now := [w for w in left if _WINDOW[w.op] == kind and self.needs[w.key] <= done]:
                    self.stages.append((kind, now))
                    done |= {w.key for w in now}
                    left = [w for w in left if w.key not in done]

    @staticmethod
    def _below(w: E) -> set[int]:
        """Windows that w's inputs name directly."""
        out, stack = set(), list(_inputs(w))
        while stack:
            e = stack.pop()
            if e.op in _WINDOW:
                out.add(e.key)
            else:
                stack += _inputs(e)
        return out

    def live(self, after: int) -> list[str]:
        """Columns that stages from `after` on, or the outputs, read."""
        names: set[str] = set()

        def collect(e: E, top: bool) -> None:
            stack = [(e, top)]
            while stack:
                x, t = stack.pop()
                if x.op in _WINDOW and not t:
                    names.add(column(x))
                elif x.op == "var":
                    names.add(x.args[0])
                else:
                    stack += [(a, False) for a in _inputs(x)]

        for _, nodes in self.stages[after:]:
            for w in nodes:
                collect(w, True)
        for e in self.outputs.values():
            collect(e, False)
        return sorted(names)

    def warm_up(self, e: E) -> int:
        """Rows that a value of e needs, itself included, from the tree (an ema needs its input's only)."""
        memo: dict[int, int] = {}

        def need(x: E) -> int:
            if x.key not in memo:
                below = max((need(a) for a in _inputs(x)), default=1)
                more = {"lag": lambda: x.args[1], "roll": lambda: x.args[2] - 1, "decay": lambda: x.args[1] - 1, "tsrank": lambda: x.args[1] - 1, "argext": lambda: x.args[2] - 1}.get(x.op, lambda: 0)()
                memo[x.key] = below + more
            return memo[x.key]

        return need(e)


def column(w: E) -> str:
    return f"w{w.key}"


def scalar(e: E) -> str:
    """SQL of a node, windows below it as columns."""
    if e.op in _WINDOW:
        return column(e)
    return _scalar(e)


def _scalar(e: E) -> str:
    op = e.op
    if op == "num":
        return f"CAST({e.args[0]!r} AS DOUBLE)"
    if op == "null":
        return "CAST(NULL AS DOUBLE)"
    if op == "var":
        return e.args[0]
    a = [scalar(x) for x in e.args]
    if op in ("+", "-", "*"):
        return f"({a[0]} {op} {a[1]})"
    if op == "/":
        return f"({a[0]} / nullif({a[1]}, 0))"
    if op == "neg":
        return f"(- {a[0]})"
    if op == "pow":
        return f"power({a[0]}, {a[1]})"
    if op in ("<", "<=", ">", ">=", "="):
        return f"coalesce({a[0]} {op} {a[1]}, false)"
    if op in ("and", "or"):
        return f"({a[0]} {op.upper()} {a[1]})"
    if op == "not":
        return f"(NOT {a[0]})"
    if op == "if":
        return f"CASE WHEN {a[0]} THEN {a[1]} ELSE {a[2]} END"
    if op == "known":
        return f"CASE WHEN {a[0]} IS NOT NULL THEN {a[1]} END"
    if op in ("min", "max"):
        fn = {"min": "least", "max": "greatest"}[op]
        return f"CASE WHEN {a[0]} IS NOT NULL AND {a[1]} IS NOT NULL THEN {fn}({a[0]}, {a[1]}) END"
    if op == "ln":
        return f"CASE WHEN {a[0]} IS NOT NULL THEN ln(greatest({a[0]}, CAST(1e-12 AS DOUBLE))) END"
    if op == "sqrt":
        return f"CASE WHEN {a[0]} >= 0 THEN sqrt({a[0]}) END"
    if op == "round":
        return f"(floor({a[0]} * 1e6 + 0.5) / 1e6)"
    if op == "abs":
        return f"abs({a[0]})"
    if op == "sign":
        return f"CASE WHEN {a[0]} > 0 THEN CAST(1 AS DOUBLE) WHEN {a[0]} < 0 THEN CAST(-1 AS DOUBLE) WHEN {a[0]} = 0 THEN CAST(0 AS DOUBLE) END"
    if op == "sign0":
        return f"CASE WHEN {a[0]} > 0 THEN CAST(1 AS DOUBLE) WHEN {a[0]} < 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
    raise ValueError(op)


#: Rows of a block, where sums are taken in blocks.
BLOCK = 16


def blocked(fn: str, x: str, n: int, place: str) -> str:
    """sum or avg of the last n rows' x, none of them NULL, added in this order: rows before the first whole block of BLOCK
    places, the sum of each whole block, the rows after the last. place: the row's, from 0."""
    held = f"collect_list({x}) OVER ({_OVER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    within = f"s.at >= ({place} - {n - 1} + {BLOCK - 1}) div {BLOCK} * {BLOCK} AND s.at < ({place} + 1) div {BLOCK} * {BLOCK}"
    state = lambda total, block: f"named_struct('total', {total}, 'block', {block}, 'at', s.at + 1)"
    step = f"CASE WHEN NOT ({within}) THEN {state('s.total + y', 's.block')} WHEN (s.at + 1) % {BLOCK} = 0 THEN {state('s.total + (s.block + y)', '0D')} ELSE {state('s.total', 's.block + y')} END"
    total = f"aggregate({held}, named_struct('total', 0D, 'block', 0D, 'at', {place} - {n - 1}), (s, y) -> {step}, s -> s.total)"
    return total if fn == "sum" else f"{total} / {n}"


def array_window(e: E, place: str | None = None) -> str:
    """As window(), but a place within the last n rows is found in one array of them and not by a lag for each row; with
    the column of places, sums and means of BLOCK rows and more are blocked()."""
    if place and (e.op == "decay" or e.op == "roll" and e.args[0] in ("sum", "avg")) and e.args[-1] >= BLOCK:
        *fn, x, n = e.args
        x = scalar(x)
        full = f"count({x}) OVER ({_OVER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) = {n}"
        if fn:
            return f"CASE WHEN {full} THEN {blocked(fn[0], x, n, place)} END"
        return f"CASE WHEN {full} THEN ({blocked('sum', f'{x} * ord', n, place)} - (ord - {n}) * {blocked('sum', x, n, place)}) / {n * (n + 1) / 2!r} END"
    if e.op not in ("tsrank", "argext"):
        return window(e)
    *fn, x, n = e.args
    x = scalar(x)
    rows = f"OVER ({_OVER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    held = f"collect_list({x}) {rows}"  # passes over nulls
    if e.op == "tsrank":
        return f"CASE WHEN size({held}) = {n} THEN CAST(size(filter({held}, y -> y <= {x})) AS DOUBLE) / {n} END"
    return f"CASE WHEN size({held}) = {n} THEN CAST({n} - array_position({held}, array_{fn[0]}({held})) AS DOUBLE) END"


def window(e: E) -> str:
    """SQL of a window node (not of ema)."""
    rows = lambda n: f"OVER ({_OVER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    if e.op == "lag":
        x, n = e.args
        return f"lag({scalar(x)}, {n}) OVER ({_OVER})"
    if e.op == "roll":
        fn, x, n = e.args
        x = scalar(x)
        if fn == "product":
            return f"CASE WHEN count({x}) {rows(n)} = {n} THEN exp(sum(ln({x})) {rows(n)}) END"
        return f"CASE WHEN count({x}) {rows(n)} = {n} THEN {fn}({x}) {rows(n)} END"
    if e.op == "decay":
        x, n = e.args
        x = scalar(x)
        # Weights 1 .. n from two sums, with the date's place in the panel.
        return f"CASE WHEN count({x}) {rows(n)} = {n} THEN (sum({x} * ord) {rows(n)} - (ord - {n}) * sum({x}) {rows(n)}) / {n * (n + 1) / 2!r} END"
    if e.op == "tsrank":
        x, n = e.args
        x = scalar(x)
        at = " + ".join(f"CASE WHEN lag({x}, {k}) OVER ({_OVER}) <= {x} THEN 1 ELSE 0 END" for k in range(1, n))
        return f"CASE WHEN count({x}) {rows(n)} = {n} THEN CAST(1 + {at} AS DOUBLE) / {n} END"
    if e.op == "argext":
        fn, x, n = e.args
        x = scalar(x)
        at = ", ".join(f"CASE WHEN lag({x}, {k}) OVER ({_OVER}) = {fn}({x}) {rows(n)} THEN {k} ELSE 0 END" for k in range(1, n))
        return f"CASE WHEN count({x}) {rows(n)} = {n} THEN CAST(greatest({at}, 0) AS DOUBLE) END"
    if e.op == "cumprod":
        return f"exp(sum(ln({scalar(e.args[0])})) OVER ({_OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
    if e.op == "rank":
        x = f"CAST({scalar(e.args[0])} AS FLOAT)"  # what differs by rounding only is a tie
        return f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY date ORDER BY {x} NULLS LAST) + (count(*) OVER (PARTITION BY date, {x}) - 1) / CAST(2 AS DOUBLE)) / count({x}) OVER (PARTITION BY date) END"
    raise ValueError(e.op)


def _fold(columns: list[tuple[str, str, float]], order: str):
    """columns: (input, output, weight of the new value). For one code."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        for x, y, alpha in columns:
            pdf[y] = pdf[x].ewm(alpha=alpha, adjust=False, ignore_na=False).mean()
        return pdf.drop(columns=[x for x, _, _ in columns])

    return run


KEYS = ("date", "code", "ord")


def evaluate(panel: DataFrame, outputs: dict[str, E], places: tuple[str, ...] = ()) -> DataFrame:
    """panel: date, code, ord (place of the date in the panel) and the variables, a row for each date and code.
    Returns date, code and the named expressions; infinite and undefined values are NULL, as are variables the panel lacks.
    places: columns of the panel by which sums are blocked(), the k-th after k stages of folds, the last one from there on."""
    plan = Plan(outputs)
    names = variables(outputs.values())
    keys, folds = (*KEYS, *places), 0
    spark, df = panel.sparkSession, panel.select(*keys, *[c if c in panel.columns else F.lit(None).cast("double").alias(c) for c in sorted(names)])
    for k, (kind, nodes) in enumerate(plan.stages):
        keep = [c for c in plan.live(k + 1) if c in df.columns]
        if kind == FOLD:
            folds += 1
            more = [(f"x{w.key}", column(w), w.args[2] / w.args[1]) for w in nodes]
            df = spark.sql(f"SELECT {', '.join([*keys, *keep])}, {', '.join(f'{scalar(w.args[0])} AS x{w.key}' for w in nodes)} FROM {{df}}", df=df)
            schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in df.schema if not f.name.startswith("x")] + [f"{y} double" for _, y, _ in more])
            df = df.groupBy("code").applyInPandas(_fold(more, "date"), schema)
        else:
            place = places[min(folds, len(places) - 1)] if places else None
            df = spark.sql(f"SELECT {', '.join([*keys, *keep])}, {', '.join(f'{array_window(w, place)} AS {column(w)}' for w in nodes)} FROM {{df}}", df=df)
    return spark.sql(f"SELECT date, code, {', '.join(f'{_finite(scalar(e))} AS {n}' for n, e in outputs.items())} FROM {{df}}", df=df)


def variables(outputs: Iterable[E]) -> set[str]:
    """Names of the panel's columns that the expressions read."""
    seen, names, stack = set(), set(), list(outputs)
    while stack:
        e = stack.pop()
        if e.key not in seen:
            seen.add(e.key)
            if e.op == "var":
                names.add(e.args[0])
            stack += _inputs(e)
    return names


def _finite(x: str) -> str:
    return f"CASE WHEN abs({x}) < 1e300 THEN {x} END"


def sql(outputs: dict[str, E], panel: str) -> list[str]:
    """Common table expressions for DuckDB over a table expression named `panel`; the last one is `result`."""
    plan, at, out = Plan(outputs), panel, []
    for k, (kind, nodes) in enumerate(plan.stages):
        if kind == FOLD:
            ins = ", ".join(f"{scalar(w.args[0])} AS x{w.key}" for w in nodes)
            out.append(f"s{k} AS MATERIALIZED (SELECT *, {ins}, row_number() OVER (PARTITION BY code ORDER BY date) AS rn{k} FROM {at})")
            first = ", ".join(f"x{w.key} AS y{w.key}, CAST(1 AS DOUBLE) AS o{w.key}" for w in nodes)
            step = []
            for w in nodes:
                i, alpha = w.key, w.args[2] / w.args[1]
                old = f"(e.o{i} * {1 - alpha!r})"
                step.append(f"CASE WHEN e.y{i} IS NULL THEN s.x{i} WHEN s.x{i} IS NULL THEN e.y{i} ELSE ({old} * e.y{i} + {alpha!r} * s.x{i}) / ({old} + {alpha!r}) END, CASE WHEN e.y{i} IS NULL OR s.x{i} IS NOT NULL THEN CAST(1 AS DOUBLE) ELSE {old} END")
            out.append(f"e{k} AS (SELECT code AS ecode, rn{k} AS ern, {first} FROM s{k} WHERE rn{k} = 1 UNION ALL SELECT e.ecode, e.ern + 1, {', '.join(step)} FROM e{k} e JOIN s{k} s ON s.code = e.ecode AND s.rn{k} = e.ern + 1)")
            out.append(f"t{k} AS MATERIALIZED (SELECT s.*, {', '.join(f'e.y{w.key} AS {column(w)}' for w in nodes)} FROM s{k} s JOIN e{k} e ON s.code = e.ecode AND s.rn{k} = e.ern)")
        else:
            out.append(f"t{k} AS MATERIALIZED (SELECT *, {', '.join(f'{window(w)} AS {column(w)}' for w in nodes)} FROM {at})")
        at = f"t{k}"
    out.append(f"result AS (SELECT date, code, {', '.join(f'{_finite(scalar(e))} AS {n}' for n, e in outputs.items())} FROM {at})")
    return out
