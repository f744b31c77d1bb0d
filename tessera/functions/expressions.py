"""Arithmetic/boolean expressions over columns, in the syntax of pandas ``eval``.

The text is parsed with Python's own ``ast`` module (pandas ``eval`` uses
Python expression syntax) and turned into a Spark Column tree, so the work
stays in whole-stage codegen. Division becomes ``try_divide`` (N18: NULL
instead of inf/NaN). ``%`` takes the sign of the divisor. A comparison with a
missing value is False, ``!=`` is True. ``&``, ``|`` and ``~`` work on
conditions like ``and``, ``or`` and ``not``.
"""

from __future__ import annotations

import ast
import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _mod(a: Column, b: Column) -> Column:
    r = F.try_mod(a, b)
    return F.when((r != 0) & ((r < 0) != (b < 0)), r + b).otherwise(r)


def _compare(op, missing: bool):
    return lambda a, b: F.coalesce(op(a, b), F.lit(missing))


_BIN = {
    ast.Add: operator.add,
    ast.Sub: operator.sub,
    ast.Mult: operator.mul,
    ast.Div: lambda a, b: F.try_divide(a, b),
    ast.Mod: _mod,
    ast.BitAnd: operator.and_,
    ast.BitOr: operator.or_,
    ast.Pow: lambda a, b: F.pow(a, b),
    ast.FloorDiv: lambda a, b: F.floor(F.try_divide(a, b)),
}
_CMP = {
    ast.Eq: _compare(operator.eq, False), ast.NotEq: _compare(operator.ne, True),
    ast.Lt: _compare(operator.lt, False), ast.LtE: _compare(operator.le, False),
    ast.Gt: _compare(operator.gt, False), ast.GtE: _compare(operator.ge, False),
}


def to_column(expression: str) -> Column:
    tree = ast.parse(expression.strip(), mode="eval")
    return _convert(tree.body)


def _convert(node) -> Column:
    if isinstance(node, ast.BinOp) and type(node.op) in _BIN:
        return _BIN[type(node.op)](_convert(node.left), _convert(node.right))
    if isinstance(node, ast.UnaryOp):
        v = _convert(node.operand)
        if isinstance(node.op, ast.USub):
            return -v
        if isinstance(node.op, ast.UAdd):
            return v
        if isinstance(node.op, (ast.Not, ast.Invert)):
            return ~v
    if isinstance(node, ast.BoolOp):
        parts = [_convert(v) for v in node.values]
        return reduce((lambda a, b: a & b) if isinstance(node.op, ast.And) else (lambda a, b: a | b), parts)
    if isinstance(node, ast.Compare):
        left = _convert(node.left)
        terms = []
        for op, right_node in zip(node.ops, node.comparators):
            right = _convert(right_node)
            if type(op) not in _CMP:
                raise ValueError(f"unsupported comparison in expression: {ast.dump(op)}")
            terms.append(_CMP[type(op)](left, right))
            left = right
        return reduce(lambda a, b: a & b, terms)
    if isinstance(node, ast.Name):
        return F.col(node.id)
    if isinstance(node, ast.Constant):
        return F.lit(node.value)
    raise ValueError(f"unsupported element in expression: {ast.dump(node)}")
