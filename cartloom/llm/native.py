"""Column expressions shared by the operators that use built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Matches whose places are added up in one go: arrays are copied as they grow, so they are grown in parts.
PART = 256


def match_places(text: Column, pattern: Column | str, measure: Callable[[Column], Column] = F.length) -> Column:
    """array<struct<at, value>>: matches with the number of characters before them. Patterns must not match empty text.

    `measure` may count something else that adds up over pieces of a text.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    empty = F.array().cast("array<struct<at:int,value:string>>")

    def placed(both: Column, first: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            at = state["at"] + measure(x["gap"])
            here = F.array(F.struct(at.alias("at"), x["value"].alias("value")))
            out = F.when(x["value"].isNull(), state["out"]).otherwise(F.concat(state["out"], here))
            return F.struct((at + F.coalesce(measure(x["value"]), F.lit(0))).alias("at"), out.alias("out"))

        return F.aggregate(both, F.struct(first.alias("at"), empty.alias("out")), step)

    def part(state: Column, nth: Column) -> Column:
        # The lists of a text's parts are kept beside one another and joined once.
        here = placed(F.slice(state["both"], nth * PART + 1, PART), state["at"])
        return F.struct(here["at"].alias("at"), F.concat(state["out"], F.array(here["out"])).alias("out"), state["both"].alias("both"))

    both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("value"))
    several = F.sequence(F.lit(0), F.floor(F.size(found) / PART).cast("int"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<at:int,value:string>>>").alias("out"), both.alias("both"))
    return (
        F.when(F.size(found) == 0, empty)
        .when(F.size(found) < PART, placed(both, F.lit(0))["out"])
        .otherwise(F.aggregate(several, start, part, lambda s: F.flatten(s["out"])))
    )
