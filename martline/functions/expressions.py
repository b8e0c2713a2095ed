"""Expression text of the pandas ``query`` and ``eval`` languages as Spark columns.

The text is Python: its own parser gives the tree, which becomes ``Column`` objects. Beside Python there are, as in pandas,
`` `quoted names` ``, ``@name`` for a parameter, and ``&`` ``|`` that bind like ``and`` ``or``.

A comparison with a null is false, and ``!=`` with one is true (pandas has no third truth value). ``predicate`` gives a condition for
a filter in a form that reaches the file scan: where only true rows matter, null may stand for false, negations are
carried to the comparisons, and ``a != 1`` is ``a <> 1 OR a IS NULL``. ``value`` gives a column to keep, so its truth values are true
and false only.

Division by zero raises (Spark's ANSI rule); ``zero_division="null"`` gives null. Whole numbers divide to fractions by ``/``;
``//`` and ``%`` round down as in Python. NaN is a number to Spark: read it as null where it means "absent".
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


class ExpressionError(ValueError):
    """Text that is not an expression of the language, or names what is not there."""


_LEX = re.compile(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|`([^`]+)`|@([A-Za-z_]\w*)|(&)|(\|)""")

_COMPARE: dict[type, Callable[[Column, Column], Column]] = {
    ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b, ast.Lt: lambda a, b: a < b, ast.LtE: lambda a, b: a <= b,
    ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b}
_OPPOSITE = {ast.Eq: ast.NotEq, ast.NotEq: ast.Eq, ast.Lt: ast.GtE, ast.LtE: ast.Gt, ast.Gt: ast.LtE, ast.GtE: ast.Lt}

#: Mathematical functions by the names that the eval language has.
FUNCTIONS: dict[str, Callable[..., Column]] = {
    "sin": F.sin, "cos": F.cos, "tan": F.tan, "arcsin": F.asin, "arccos": F.acos, "arctan": F.atan, "sinh": F.sinh, "cosh": F.cosh,
    "tanh": F.tanh, "arcsinh": F.asinh, "arccosh": F.acosh, "arctanh": F.atanh, "exp": F.exp, "expm1": F.expm1, "log": F.ln, "log10": F.log10,
    "log1p": F.log1p, "sqrt": F.sqrt, "abs": F.abs, "floor": F.floor, "ceil": F.ceil, "arctan2": F.atan2}


def _floor_divide(a: Column, b: Column) -> Column:
    return F.floor(a / b)


def _remainder(a: Column, b: Column) -> Column:
    """Python's rule: the sign of the divisor."""
    r = a % b
    return F.when((r != 0) & ((r < 0) != (b < 0)), r + b).otherwise(r)


#: Methods of columns: (result is a truth value, function of the column and the arguments).
METHODS: dict[str, tuple[bool, Callable[..., Column]]] = {
    "isnull": (True, lambda c: c.isNull()), "isna": (True, lambda c: c.isNull()), "notnull": (True, lambda c: c.isNotNull()),
    "notna": (True, lambda c: c.isNotNull()), "between": (True, lambda c, a, b: c.between(a, b)), "abs": (False, F.abs),
    "fillna": (False, lambda c, v: F.coalesce(c, F.lit(v))), "round": (False, lambda c, n=0: F.round(c, n)),
    "str.contains": (True, lambda c, x: c.rlike(x)), "str.startswith": (True, lambda c, x: c.startswith(x)),
    "str.endswith": (True, lambda c, x: c.endswith(x)), "str.lower": (False, F.lower), "str.upper": (False, F.upper),
    "str.strip": (False, F.trim), "str.len": (False, F.length), "dt.year": (False, F.year), "dt.month": (False, F.month), "dt.day": (False, F.day),
    "dt.quarter": (False, F.quarter), "dt.dayofweek": (False, lambda c: (F.dayofweek(c) + 5) % 7)}


class _Translator:
    def __init__(self, text: str, columns: Sequence[str], params: Mapping[str, object], zero_division: str) -> None:
        self.columns, self.params, self.zero_division = set(columns), params, zero_division
        self.names: dict[str, str] = {}  # stand-ins of quoted names and parameters

        def plain(m: re.Match) -> str:
            string, quoted, param, both, either = m.groups()
            if string:
                return string
            if both or either:
                return " and " if both else " or "
            name = f"__{'c' if quoted else 'p'}{len(self.names)}"
            self.names[name] = quoted or param
            return name

        try:
            self.tree = ast.parse(_LEX.sub(plain, text.strip()), mode="eval").body
        except SyntaxError as e:
            raise ExpressionError(f"{text!r} is not an expression: {e.msg}") from e

    # ---- what a node is ---------------------------------------------------------------
    def fixed(self, node: ast.expr) -> tuple[bool, object]:
        """(True, value) of literals, lists of them, and parameters."""
        if isinstance(node, ast.Constant):
            return True, node.value
        if isinstance(node, (ast.List, ast.Tuple, ast.Set)):
            parts = [self.fixed(x) for x in node.elts]
            return all(p[0] for p in parts), [p[1] for p in parts]
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)) and isinstance(node.operand, ast.Constant):
            return True, -node.operand.value if isinstance(node.op, ast.USub) else node.operand.value
        if isinstance(node, ast.Name) and node.id.startswith("__p") and node.id in self.names:
            if self.names[node.id] not in self.params:
                raise ExpressionError(f"no parameter {self.names[node.id]!r}")
            got = self.params[self.names[node.id]]
            return True, list(got) if isinstance(got, (set, frozenset, tuple)) else got
        return False, None

    def is_truth(self, node: ast.expr) -> bool:
        if isinstance(node, (ast.Compare, ast.BoolOp)) or isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.Not, ast.Invert)):
            return True
        if isinstance(node, ast.Call):
            name, _ = self.method(node)
            return name in METHODS and METHODS[name][0] or name == "isin"
        return isinstance(node, ast.Constant) and isinstance(node.value, bool)

    def method(self, node: ast.Call) -> tuple[str, ast.expr | None]:
        """Name of what is called, and the column that it is a method of."""
        f = node.func
        if isinstance(f, ast.Name):
            return f.id, None
        if isinstance(f, ast.Attribute):
            if isinstance(f.value, ast.Attribute) and f.value.attr in ("str", "dt"):
                return f"{f.value.attr}.{f.attr}", f.value.value
            return f.attr, f.value
        raise ExpressionError("only functions and methods with a name can be called")

    # ---- values -----------------------------------------------------------------------
    def value(self, node: ast.expr) -> Column:
        known, literal = self.fixed(node)
        if known:
            return F.lit(literal)
        if self.is_truth(node):
            return self.exact(node)
        if isinstance(node, ast.Name):
            name = self.names.get(node.id, node.id)
            if name not in self.columns:
                raise ExpressionError(f"no column {name!r}")
            return F.col(f"`{name}`")
        if isinstance(node, ast.UnaryOp):
            a = self.value(node.operand)
            return -a if isinstance(node.op, ast.USub) else a
        if isinstance(node, ast.BinOp):
            return self.arithmetic(node.op, self.value(node.left), self.value(node.right))
        if isinstance(node, ast.Call):
            return self.call(node)
        if isinstance(node, ast.Attribute) and isinstance(node.value, ast.Attribute) and node.value.attr == "dt" and f"dt.{node.attr}" in METHODS:
            return METHODS[f"dt.{node.attr}"][1](self.value(node.value.value))
        raise ExpressionError(f"{ast.unparse(node)} is not part of the language")

    def arithmetic(self, op: ast.operator, a: Column, b: Column) -> Column:
        if isinstance(op, (ast.Div, ast.FloorDiv, ast.Mod)) and self.zero_division == "null":
            b = F.nullif(b, F.lit(0))
        simple = {ast.Add: lambda: a + b, ast.Sub: lambda: a - b, ast.Mult: lambda: a * b, ast.Div: lambda: a / b,
                  ast.FloorDiv: lambda: _floor_divide(a, b), ast.Mod: lambda: _remainder(a, b), ast.Pow: lambda: F.pow(a, b)}
        if type(op) not in simple:
            raise ExpressionError(f"no operator {type(op).__name__}")
        return simple[type(op)]()

    def call(self, node: ast.Call) -> Column:
        name, of = self.method(node)
        if node.keywords:
            raise ExpressionError(f"{name} takes no named arguments")
        if of is None:
            if name not in FUNCTIONS:
                raise ExpressionError(f"no function {name!r}")
            return FUNCTIONS[name](*[self.value(a) for a in node.args])
        args = [self.fixed(a) for a in node.args]
        if not all(known for known, _ in args):
            raise ExpressionError(f"arguments of {name} must be literals or parameters")
        column = self.value(of)
        if name == "isin":
            return self.member(column, args[0][1])
        if name not in METHODS:
            raise ExpressionError(f"no method {name!r}")
        return METHODS[name][1](column, *[v for _, v in args])

    @staticmethod
    def member(column: Column, values: object) -> Column:
        """Null is in a list that has it."""
        if not isinstance(values, list):
            raise ExpressionError("in needs a list")
        some = [v for v in values if v is not None]
        found = column.isin(some) if some else F.lit(False)
        return found | column.isNull() if len(some) < len(values) else found

    # ---- truth ------------------------------------------------------------------------
    def pairs(self, node: ast.Compare) -> list[tuple[ast.expr, ast.cmpop, ast.expr]]:
        sides = [node.left, *node.comparators]
        return list(zip(sides, node.ops, sides[1:], strict=False))

    def compare(self, left: ast.expr, op: ast.cmpop, right: ast.expr, negated: bool) -> Column:
        """A condition whose true rows are those of the comparison (of its opposite); null counts as not true."""
        known, values = self.fixed(right)
        if isinstance(op, (ast.In, ast.NotIn)) or known and isinstance(values, list) and isinstance(op, (ast.Eq, ast.NotEq)):
            if not known:
                raise ExpressionError("in needs a list of literals or a parameter")
            column, wanted = self.value(left), isinstance(op, (ast.In, ast.Eq)) != negated
            found = self.member(column, values)
            if wanted:
                return found
            return ~found & column.isNotNull() if None in values else ~found | column.isNull()
        if type(op) not in _COMPARE:
            raise ExpressionError(f"no comparison {type(op).__name__}")
        a, b = self.value(left), self.value(right)
        if (type(op) is ast.NotEq) != negated:  # true where a side is null: != itself, and the opposite of the others
            opposite = type(op) if not negated else _OPPOSITE[type(op)]
            out = _COMPARE[opposite](a, b)
            for side, column in ((left, a), (right, b)):
                if not self.fixed(side)[0]:
                    out = out | column.isNull()
            return out
        return _COMPARE[_OPPOSITE[type(op)] if negated else type(op)](a, b)

    def condition(self, node: ast.expr, negated: bool = False) -> Column:
        """A condition whose true rows are those of ``node`` (of its opposite); null counts as not true."""
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.Not, ast.Invert)):
            return self.condition(node.operand, not negated)
        if isinstance(node, ast.BoolOp):
            parts = [self.condition(v, negated) for v in node.values]
            return _join(parts, isinstance(node.op, ast.And) != negated)
        if isinstance(node, ast.Compare):
            return _join([self.compare(a, op, b, negated) for a, op, b in self.pairs(node)], not negated)
        known, literal = self.fixed(node)
        if known:
            return F.lit(bool(literal) != negated)
        column = self.call(node) if isinstance(node, ast.Call) else self.value(node)
        return ~F.coalesce(column, F.lit(False)) if negated else column

    def exact(self, node: ast.expr) -> Column:
        return F.coalesce(self.condition(node), F.lit(False))


def _join(parts: list[Column], every: bool) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out & p if every else out | p
    return out


def predicate(text: str, columns: Sequence[str], params: Mapping[str, object] | None = None, zero_division: str = "error") -> Column:
    """Condition of a filter; rows for which it is true are those that ``query`` keeps."""
    t = _Translator(text, columns, params or {}, zero_division)
    return t.condition(t.tree)


def value(text: str, columns: Sequence[str], params: Mapping[str, object] | None = None, zero_division: str = "error") -> Column:
    """Column of an ``eval`` expression."""
    t = _Translator(text, columns, params or {}, zero_division)
    return t.value(t.tree)
