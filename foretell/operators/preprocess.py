"""Column preparation: an ordered operation list per column, compiled to one projection."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.functions.text import clean_text

# fixed values: type names of the retype operation
TYPES = {"int64": "bigint", "int32": "int", "float64": "double", "float32": "float", "object": "string", "str": "string"}

# operations on the value of a column, by name
COLUMN_OPS: dict[str, Callable[[Column], Column]] = {
    "clean_text_data": clean_text,
    "clean_text": clean_text,
}


def prepared_column(name: str, ops: Sequence[str], strict: bool = True) -> Column:
    """``rename::x`` and ``retype::t`` as given, other names from the registry.

    A value that does not fit its new type is an error; with ``strict=False`` it is null.
    """
    expr, alias = F.col(name), name
    for op in ops:
        kind, _, argument = op.partition("::")
        if kind == "rename":
            alias = argument
        elif kind == "retype":
            target = TYPES.get(argument, argument)
            expr = expr.cast(target) if strict else expr.try_cast(target)
        elif kind in COLUMN_OPS:
            expr = COLUMN_OPS[kind](expr)
        else:
            raise ValueError(f"{name}: unknown operation {op!r}")
    return expr.alias(alias)


def preprocess(
    df: DataFrame, ops: Mapping[str, Sequence[str]], strict: bool = True
) -> DataFrame:
    """Only the listed columns, in their order."""
    return df.select(*[prepared_column(c, o, strict) for c, o in ops.items()])
