"""Casts of text that may not fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every text that casts to the type matches its pattern; not every match casts.
_EDGE = r"[\x00-\x20\x7f]*"
_WHOLE = rf"^{_EDGE}[+-]?[0-9]+{_EDGE}$"
_NUMBER = rf"^{_EDGE}[+-]?([0-9.][0-9a-fA-FxXpP+.-]*|(?i:nan|inf(inity)?)[a-z]?){_EDGE}$"


def soft_cast(text: Column, dtype: T.DataType | str) -> Column:
    """``text.try_cast(dtype)`` at the cost of a normal cast.

    A failed ``try_cast`` to a number raises and catches an exception per row, some ten
    times the price of a cast. Text that cannot be a number is sorted out first.
    """
    name = dtype if isinstance(dtype, str) else dtype.simpleString()
    if name in ("tinyint", "smallint", "int", "bigint"):
        return F.when(text.rlike(_WHOLE), text).try_cast(dtype)
    if name in ("float", "double"):
        return F.when(text.rlike(_NUMBER), text).try_cast(dtype)
    return text.try_cast(dtype)
