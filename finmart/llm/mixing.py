"""Mixing sources to target weights along a curriculum, in DataFrame operations only.

Every source has a weight that changes over the time of training, which runs from 0 to 1:
a schedule of (time, weight) knots, linear between them. Its integral is the source's
weight; the weights share out the words of the mix, no source giving more than `repeats`
times its own words, and what is above that is shared out again among the others.

The documents of a source lie one after the other in a drawn order, pass after pass, until
the demand of the source ends, inside a document if need be. A copy whose first word is
the y-th of its source is due when the integral of the schedule reaches the share y / demand: the
inverse of a piecewise quadratic. All copies, range-sorted by the time they are due, make
up the training stream; a copy's position there is the number of words before it.

- A source's running sums go over range partitions of (source, draw), so a source with a
  third of all rows is spread like any other rows; the sums of partitions are one row for
  each partition and source.
- What shares out the words is one table of sources, numbered by a range sort. Only the
  level, words per unit of weight, is found step by step, with one pair of sums a step.

Defined results: words are parted by white space; a null or empty text has none, is
not taken and has no position. Sources are ordered by code point, null last as a source of its
own. The draw is a digest of seed and id; equal ids are taken in the order of their rows
in the table, and null ids count as equal. No rows give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.llm.batches import key_of, text_or_empty
from finmart.llm.order import in_order, numbered, summed_before
from finmart.sources.scratch import materialize


@dataclass(frozen=True)
class Schedule:
    """Weight over time, from (0, weight) to (1, weight)."""

    knots: tuple[tuple[float, float], ...]

    def __post_init__(self):
        times = [time for time, _ in self.knots]
        if times[:1] != [0] or times[-1:] != [1] or any(a >= b for a, b in zip(times, times[1:])):
            raise ValueError(f"the times of a schedule rise from 0 to 1: {times}")
        if min(weight for _, weight in self.knots) < 0 or not self.weight > 0:
            raise ValueError("the weights of a schedule are not negative, and not all zero")

    @property
    def segments(self) -> list[tuple[float, float, float, float, float]]:
        """(start, end, weight there, weight there, integral before) of each stretch."""
        found, before = [], 0.0
        for (start, first), (end, last) in zip(self.knots, self.knots[1:]):
            found.append((float(start), float(end), float(first), float(last), before))
            before += (first + last) / 2 * (end - start)
        return found

    @property
    def weight(self) -> float:
        return sum((a + b) / 2 * (end - start) for (start, a), (end, b) in zip(self.knots, self.knots[1:]))

    def column(self) -> Column:
        return F.array(
            *[
                F.struct(*[F.lit(x).alias(name) for name, x in zip(("start", "end", "first", "last", "before"), s)])
                for s in self.segments
            ]
        )


def n_words(text: Column) -> Column:
    """Words between white space, counted without listing them."""
    spaced = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    blanks = F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" ")))
    return F.when(spaced == "", 0).otherwise(blanks + 1).cast("long")


def _level(sources: DataFrame, total: float, repeats: int) -> float:
    """Words per unit of weight, with which targets of at most `repeats` times the sizes
    sum to `total`."""
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * level > (F.col("source_size") * repeats).cast("double")
        found = sources.agg(
            F.count_if(above).alias("full"),
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("free"),
        ).first()
        # Sources only ever become full: the level rises until no more do.
        if found.full == full or not found.free:
            return level
        full, level = found.full, (total - repeats * found.held) / found.free


def _sources(sized: DataFrame, schedules: Sequence[Schedule], budget: float, repeats: int) -> DataFrame:
    """(source_key, number, kind, weight, source_size, target, demand) of each source."""
    sums = sized.groupBy("source", key_of("source").alias("source_key")).agg(
        F.sum("size").alias("source_size")
    )
    by_name = in_order(sums.withColumn("nameless", F.col("source").isNull()), ["nameless", "source"], "mix-sources")
    kind = ((F.col("number") - 1) % len(schedules)).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(s.weight)) for s in schedules]), F.col("kind") + 1)
    sources = materialize(
        numbered(by_name, "number").withColumn("kind", kind).withColumn("weight", weight),
        "mix-weights",
    )
    words = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    # The exact whole number where all words are asked for.
    level = _level(sources, words if budget == 1 else words * budget, repeats)
    target = F.least((F.col("source_size") * repeats).cast("double"), F.col("weight") * level)
    return sources.withColumn("target", target).select(
        "source_key", "number", "kind", "weight", "source_size", "target", F.floor("target").alias("demand")
    )


def _due(schedules: Sequence[Schedule], kind: Column, share: Column) -> Column:
    """When the integral of a schedule reaches a share of its weight."""
    segments = F.element_at(F.array(*[s.column() for s in schedules]), kind + 1)
    weight = F.element_at(F.array(*[F.lit(float(s.weight)) for s in schedules]), kind + 1)
    reached = share * weight
    at = F.element_at(F.filter(segments, lambda s: s["before"] <= reached), -1)
    rest = reached - at["before"]
    slope = (at["last"] - at["first"]) / (at["end"] - at["start"])
    # The root of slope / 2 * x^2 + first * x = rest, in the form that does not cancel.
    root = F.sqrt(F.greatest(at["first"] * at["first"] + F.lit(2.0) * slope * rest, F.lit(0.0)))
    passed = F.when(rest > 0, F.lit(2.0) * rest / (at["first"] + root)).otherwise(F.lit(0.0))
    return F.least(at["end"], at["start"] + passed)


def _sized(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        n_words(text_or_empty(text_col)).alias("size"),
        draw.alias("draw"),
        F.monotonically_increasing_id().alias("row"),
    )
    return materialize(rows, "mix-sizes")


def _stream(marked: DataFrame, schedules: Sequence[Schedule], repeats: int) -> DataFrame:
    """(row, copy, words, due, position) of every copy."""
    placed = in_order(marked.where("size > 0 and demand > 0"), ["number", "draw", "row"], "mix-placed")
    offset = F.col("pass") * F.col("source_size") + F.col("before")
    copies = (
        summed_before(placed, "size", "before", ["number"])
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .withColumn("offset", offset)
        .where("offset < demand")
    )
    due = _due(schedules, F.col("kind"), F.col("offset").cast("double") / F.col("demand").cast("double"))
    timed = copies.select(
        "id",
        "row",
        "number",
        "offset",
        F.col("pass").alias("copy"),
        F.least("size", F.col("demand") - F.col("offset")).alias("words"),
        due.alias("due"),
    )
    return summed_before(in_order(timed, ["due", "number", "offset"], "mix-timed"), "words", "position")


def training_stream(
    docs: DataFrame,
    schedules: Sequence[Schedule],
    budget: float = 1.0,
    repeats: int = 3,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(id, copy, words, due, position) of every copy the mix takes. The first of
    `schedules` belongs to the first source, and so on in turn; `budget` is the number of
    words of the mix as a multiple of all words."""
    sized = _sized(docs, seed, id_col, text_col, source_col)
    marked = _marked(sized, _sources(sized, schedules, budget, repeats))
    stream = _stream(marked, schedules, repeats)
    return stream.select(F.col("id").alias(id_col), "copy", "words", "due", "position")


def _marked(sized: DataFrame, sources: DataFrame) -> DataFrame:
    return sized.withColumn("source_key", key_of("source")).join(sources, "source_key").drop("source_key")


def mix_sources(
    docs: DataFrame,
    schedules: Sequence[Schedule],
    budget: float = 1.0,
    repeats: int = 3,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(id, size, source_size, target, taken, copies) of every row; `copies` has the
    position and the words of each of its copies, at most `repeats`, in their order."""
    sized = _sized(docs, seed, id_col, text_col, source_col)
    marked = _marked(sized, _sources(sized, schedules, budget, repeats))
    taken = (
        _stream(marked, schedules, repeats)
        .groupBy("row")
        .agg(
            F.sum("words").alias("taken"),
            F.array_sort(F.collect_list(F.struct("position", "words"))).alias("copies"),
        )
    )
    return marked.join(taken, "row", "left").select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
        "copies",
    )
