"""Ordered scans over an array inside its row, linear in the array's length.

Appending to an array copies it, so a fold that appends once per element is quadratic. Here
results are appended to blocks of bounded length and the blocks are joined once at the end;
only the list of blocks is copied, one time in ``BLOCK``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is looked at."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(values: Column, zero: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], kind: str) -> Column:
    """For each element ``emit(state, element)``, the state being that after the element.

    ``kind`` is the SQL type of what is emitted; ``zero`` must have the type of ``step``.
    """
    def pair(state: Column, out: Column) -> Column:
        return F.struct(state.alias("state"), out.alias("out"))

    def one(a: Column, x: Column) -> Column:
        return bound(step(a["state"], x), lambda s: pair(s, F.concat(a["out"], F.array(emit(s, x)))))

    def block(a: Column, b: Column) -> Column:
        inner = F.aggregate(b, pair(a["state"], F.array().cast(f"array<{kind}>")), one)
        return bound(inner, lambda i: pair(i["state"], F.concat(a["out"], F.array(i["out"]))))

    def run(own: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(own), F.lit(BLOCK))
        blocks = F.when(F.size(own) > 0, F.transform(starts, lambda i: F.slice(own, i, BLOCK)))
        done = F.aggregate(blocks, pair(zero, F.array().cast(f"array<array<{kind}>>")), block, lambda a: F.flatten(a["out"]))
        return F.when(F.size(own) > 0, done).otherwise(F.array().cast(f"array<{kind}>"))

    return bound(values, run)


def running_sum(values: Column) -> Column:
    """Sum of the elements up to and with each one."""
    return scan(values, F.lit(0).cast("int"), lambda s, x: s + x, lambda s, x: s, "int")


def where(flags: Column) -> Column:
    """Positions, from 0, of the true elements."""
    return F.filter(F.transform(flags, lambda f, i: F.when(f, i)), lambda i: i.isNotNull())
