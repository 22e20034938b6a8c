"""Write a scalar formula once, get a Spark Column or SQL text from it.

The oracle SQL and the DataFrame plan must evaluate the same floating-point
operations in the same order (cells are decided by ``floor``), so formulas
that appear in both are written against this small operator set. Binary
operations are always parenthesised, so the evaluation order is explicit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lit_sql(x) -> str:
    if isinstance(x, Sql):
        return x.t
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return "TRUE" if x else "FALSE"
    if isinstance(x, int):
        return str(x)
    if isinstance(x, float):
        r = repr(x)
        return r if "e" in r else r + "e0"
    if isinstance(x, str):
        return x
    raise TypeError(type(x))


class Sql:
    """SQL text with Python operators; always parenthesised."""

    __slots__ = ("t",)

    def __init__(self, t: str):
        self.t = t

    def _bin(self, o, op, rev=False):
        a, b = _lit_sql(self), _lit_sql(o)
        return Sql(f"({b} {op} {a})" if rev else f"({a} {op} {b})")

    def __add__(self, o):
        return self._bin(o, "+")

    def __radd__(self, o):
        return self._bin(o, "+", True)

    def __sub__(self, o):
        return self._bin(o, "-")

    def __rsub__(self, o):
        return self._bin(o, "-", True)

    def __mul__(self, o):
        return self._bin(o, "*")

    def __rmul__(self, o):
        return self._bin(o, "*", True)

    def __truediv__(self, o):
        return self._bin(o, "/")

    def __rtruediv__(self, o):
        return self._bin(o, "/", True)

    def __neg__(self):
        return Sql(f"(-{self.t})")

    def __gt__(self, o):
        return self._bin(o, ">")

    def __lt__(self, o):
        return self._bin(o, "<")

    def __ge__(self, o):
        return self._bin(o, ">=")

    def __le__(self, o):
        return self._bin(o, "<=")

    def __and__(self, o):
        return self._bin(o, "AND")

    def __or__(self, o):
        return self._bin(o, "OR")

    def __mod__(self, o):
        return self._bin(o, "%")

    def __str__(self):
        return self.t


def is_sql(x) -> bool:
    return isinstance(x, Sql)


def fn(name: str, x):
    """Unary math function with the same name in both engines."""
    if is_sql(x):
        return Sql(f"{name}({x.t})")
    return getattr(F, name)(x)


def floor(x):
    return fn("floor", x)


def abs_(x):
    return fn("abs", x)


def sin(x):
    return fn("sin", x)


def cos(x):
    return fn("cos", x)


def tan(x):
    return fn("tan", x)


def asin(x):
    return fn("asin", x)


def ln(x):
    if is_sql(x):
        return Sql(f"ln({x.t})")
    return F.log(x)


def sqrt(x):
    return fn("sqrt", x)


def greatest(a, b):
    if is_sql(a):
        return Sql(f"greatest({_lit_sql(a)}, {_lit_sql(b)})")
    return F.greatest(a, F.lit(b) if not isinstance(b, Column) else b)


def least(a, b):
    if is_sql(a):
        return Sql(f"least({_lit_sql(a)}, {_lit_sql(b)})")
    return F.least(a, F.lit(b) if not isinstance(b, Column) else b)


def case(*branches, otherwise):
    """case((cond, value), ..., otherwise=value)."""
    if is_sql(branches[0][0]):
        parts = " ".join(f"WHEN {_lit_sql(c)} THEN {_lit_sql(v)}" for c, v in branches)
        return Sql(f"(CASE {parts} ELSE {_lit_sql(otherwise)} END)")
    out = None
    for c, v in branches:
        out = F.when(c, v) if out is None else out.when(c, v)
    return out if otherwise is None else out.otherwise(otherwise)


def cast(x, sql_type: str):
    if is_sql(x):
        return Sql(f"CAST({x.t} AS {sql_type})")
    return x.cast(sql_type.lower())


def col(name: str, sql: bool):
    return Sql(name) if sql else F.col(name)
