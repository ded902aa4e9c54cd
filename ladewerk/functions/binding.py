"""Use a computed value several times while computing it once."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from weakref import WeakKeyDictionary

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with `value` bound as a lambda variable.

    Inside a lambda Spark shares no repeated subexpression, so an expensive one
    would otherwise run once per mention.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def let(value: str, name: str, use: str) -> str:
    """The same in SQL text: `use` mentions `name` for `value`."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def computed(df: DataFrame, *columns: Column) -> DataFrame:
    """`df` with named columns that are computed once per row.

    A filter on a plain projected column is pushed below the projection by
    copying its expression, and a chain of such columns multiplies. A generator
    of exactly one row is a boundary the optimizer does not copy across.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


_BUILT: WeakKeyDictionary = WeakKeyDictionary()


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Keep the expression a function builds from column names, per Spark context.

    A large expression takes thousands of calls into the JVM to put together; it
    is the same for every table that has the named columns. Calls with anything
    but names and plain values are not kept.
    """

    @wraps(build)
    def get(*args, **kwargs):
        context = SparkContext._active_spark_context
        key = (build.__module__, build.__qualname__, args, tuple(sorted(kwargs.items())))
        plain = all(a is None or isinstance(a, (str, int)) for a in (*args, *kwargs.values()))
        if context is None or not plain:
            return build(*args, **kwargs)
        kept = _BUILT.setdefault(context, {})
        if key not in kept:
            kept[key] = build(*args, **kwargs)
        return kept[key]

    return get


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
