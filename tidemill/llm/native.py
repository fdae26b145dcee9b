"""Column expressions that the operators on built-in functions share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands between words of lower-cased text: ASCII but digits and small letters.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z made small, nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text: runs of digits, letters and non-ASCII characters, lower-cased."""
    return F.filter(F.split(lowered(text), NOT_WORD), lambda w: w != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once for the row, however often ``use`` and its inner functions name it."""
    return F.get(F.transform(F.array(value), use), 0)


def sum_before(values: Column, block: int = 256) -> Column:
    """For each element of an array of numbers the sum of those before it. Sums are made in blocks, so that the work
    doesn't grow with the square of the length until there are very many blocks."""

    def sums(xs: Column) -> Column:
        """One more than the elements: 0, and each sum up to an element."""
        return F.aggregate(xs, F.array(F.lit(0).cast("long")), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)

    def within(blocks: Column) -> Column:
        return let(sums(F.transform(blocks, total)), lambda totals: F.flatten(F.transform(blocks, lambda b, k: let(F.get(totals, k), lambda t: F.transform(F.slice(sums(b), 1, F.size(b)), lambda s: s + t)))))

    def cut(xs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int")), lambda k: F.slice(xs, k * block + 1, block))

    return F.when(F.size(values) == 0, F.array().cast("array<long>")).otherwise(let(values, lambda xs: let(cut(xs), within)))


def blocks_of(text: Column, block: int = 1024) -> Column:
    """A text cut into blocks of as many code points, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))


def piece(blocks: Column, start: Column, end: Column, block: int = 1024) -> Column:
    """The code points from ``start`` to before ``end`` of a text given as ``blocks_of`` cuts it. Only the blocks that hold them are
    looked at, so that many pieces of a long text don't each count from its start."""
    first = F.floor(start / block).cast("int")
    last = F.floor((end - 1) / block).cast("int")
    held = F.array_join(F.slice(blocks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    return F.when(end <= start, "").otherwise(F.substring(held, (start - first * block + 1).cast("int"), (end - start).cast("int")))
