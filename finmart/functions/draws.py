"""Random-looking columns that are pure functions of (seed, field, row id).

A value depends only on its row, so a generated feed is the same under any
partitioning, and a lost task recomputes exactly the rows it had before.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = 2**32


def digest(seed: int, field: str, row: Column) -> Column:
    """128 random-looking bits as text, the source of four draws."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(field), row.cast("string")))


def draw(bits: Column, nth: int = 0) -> Column:
    """The nth (0..3) draw of a digest: a uniform integer below 2**32 as eight hex
    digits, which compare like the number without the cost of converting them."""
    return F.substring(bits, 8 * nth + 1, 8)


def _hex(number: int) -> Column:
    return F.lit(f"{number:08x}")


def below(u: Column, n: int) -> Column:
    """Scale a draw to an integer in [0, n)."""
    if not 0 < n < 2**31:
        raise ValueError(f"range of a draw must be in 1..2**31-1, got {n}")
    return F.shiftright(F.conv(u, 16, 10).cast("bigint") * F.lit(n).cast("bigint"), 32)


def chance(u: Column, probability: float) -> Column:
    return u < _hex(int(probability * _SPAN))


def _first_above(u: Column, options: Sequence[str], edges: Sequence[int]) -> Column:
    *head, last = options
    if not head:
        return F.lit(last)
    cases = [(u < _hex(edge), option) for option, edge in zip(head, edges)]
    picked = F.when(*cases[0])
    for case in cases[1:]:
        picked = picked.when(*case)
    return picked.otherwise(last)


def one_of(u: Column, options: Sequence[str]) -> Column:
    """One option per row, all equally likely: the one numbered `below(u, n)`."""
    n = len(options)
    return _first_above(u, options, [-(-k * _SPAN // n) for k in range(1, n)])


def weighted(u: Column, options: Sequence[str], weights: Sequence[float]) -> Column:
    """One option per row; the weights add up to one."""
    return _first_above(u, options, [int(edge * _SPAN) for edge in accumulate(weights[:-1])])


def money(u: Column, low: int, high: int) -> Column:
    """An amount between two whole numbers, both included, in steps of 0.01."""
    cents = below(u, (high - low) * 100 + 1) + low * 100
    return (cents.cast("decimal(15,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(15,2)")
