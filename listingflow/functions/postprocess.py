"""Named post-processors of extracted text (UDF-3): Column -> Column, native expressions only.

A rule names one or several in its ``postprocess`` column, ``a|b`` applying ``a`` first.  A null
stays null, and an empty result is null, as an empty value is for the sites' own assignments.
"""

from __future__ import annotations

from typing import Callable, Dict

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X

Processor = Callable[[Column], Column]


def zero_as_null(c: Column) -> Column:
    """PRJ-13: text whose only digits are zeros says "not given"."""
    return F.when(~c.rlike("^[^1-9]*0[^1-9]*$"), c)


POSTPROCESSORS: Dict[str, Processor] = {
    "clean_text": X.clean_text,
    "lower": F.lower,
    "upper": F.upper,
    "digits": lambda c: F.regexp_replace(c, "[^0-9]", ""),
    "first_line": lambda c: F.element_at(F.split(c, "\n", 2), 1),
    "zero_as_null": zero_as_null,
}


def check(names: str | None, known: Dict[str, Processor]) -> None:
    """Raise for a name that nobody registered."""
    for name in (names or "").split("|"):
        if name and name not in known:
            raise ValueError(f"unknown post-processor {name!r}; known: {sorted(known)}")


def compiled(c: Column, names: str, known: Dict[str, Processor]) -> Column:
    for name in names.split("|"):
        c = known[name](c)
    return F.nullif(c, F.lit(""))
