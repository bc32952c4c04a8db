"""Binding of a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with the value worked out once however often f uses it.

    What a lambda of a higher-order function mentions is worked out for every
    element unless it is a lambda's variable; the optimizer may also move a column's
    expression into such a lambda.  Here the value becomes a variable.
    """
    return F.transform(F.array(value), f)[0]
