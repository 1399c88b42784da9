"""Line de-duplication by an exact set-similarity join, in DataFrame operations only.

A line is the set of its words. Lines of a and b words are similar if at most (a + b) / 9
words are in one of them only. Words are dealt by their hashes to a number of parts that
depends on the size of the line, so that each such word spoils one part at most, and all
others are equal in both lines. The parts of a line are ordered by how much they tell
(letters of the three longest words), which is the same order in any line; of as many parts as
a similar line could spoil, and one more, from the top, one must then be among those of the
similar line. These are the marks of a line: lines that share no mark are never compared.
A mark stands for several words, all of a part and none besides, so few other lines share it.

Marks of one set of words only go first, by a count. Two lines of a shared mark are near if
their sizes and bitmaps of the parities of hashed words leave room for the overlap that is needed;
marks of lines without a near one go next. What remains is verified word by word.

A line that has an earlier similar line is removed; earlier is smaller in (id, line
number), and it does not matter whether the earlier line is itself removed. So similar lines
are never expanded into pairs: each line is compared with one other first, the nearest of the
earliest and the previous lines of its marks. Lines for which that finds nothing, and lines
that are near to these, then meet with their words, and each asks only whether there is one.

Words are told apart by 59 bits of their hashes and their lengths while candidates are sought and lines of equal words are
put together, by their letters when similar lines are verified.

Defined results: lines are parted by line feeds; words by white space. A line without a
word is never removed. Lines of equal words are similar whatever the order and number of
the words. A null text is an empty one, a single line without a word. Null ids are the
smallest. Rows with the same id and text are told apart, and later ones lose their lines.
No rows give no rows. `mark_lines` reads the id and the text only; `drop_lines` keeps
all columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm.batches import fresh, key_of, text_or_empty
from finmart.sources.scratch import erase, materialize

_BITMAP = 1 << 22  # bits of the filter that says which documents are read again

_SPACE = "[\\\\x20\\\\x09-\\\\x0D]+"
# Most lines have no white space but blanks, and by one letter they are split without a pattern.
_PLAIN = " and ".join(f"not contains(line, char({code}))" for code in (9, 11, 12, 13))
_WORDS = f"if({_PLAIN}, split(line, ' '), split(line, '{_SPACE}'))"


def _number(word: str) -> str:
    """A word as one number: its hash, with its bytes beyond the first, up to 31, in place of five bits."""
    length = f"shiftleft(cast(least(octet_length({word}) - 1, 31) & 31 as bigint), 31)"
    return f"xxhash64({word}) & {~(31 << 31)}L | {length}"


_NUMBERS = f"""sort_array(array_remove(array_distinct(transform({_WORDS}, w -> {_number("w")})), {_number("''")}))"""


def _lines(docs: DataFrame, id_col: str, text_col: str, row: Column) -> DataFrame:
    """(id, row, line number, line): every line."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        row.alias("row"),
        text_or_empty(text_col).alias("text"),
    )
    return rows.select("id", "row", F.posexplode(F.split("text", "\n")).alias("place", "line"))


def _grade(n: Column) -> Column:
    """The class of a count: seven bits hold it for any bigint, as 2 * log2 of it is 126 at most.
    Words had such classes; marks do without, and only the test of it is left."""
    return F.ceil(2 * F.log2(n)).cast("tinyint")


# Two digests of the words of a line, the first one null for a line without any.
_KEYS = {
    "key": "if(size(numbers) = 0, null, xxhash64(numbers))",
    "more": "xxhash64(1, numbers)",
}

# Sizes from 2^(b-1) to 2^b - 1 are cut into 2^(b-2) + 1 parts: more than words can differ from
# lines up to that size. A line that may be similar to some of the next range is cut like those, too.
_CUTS = {
    "cut": "if(size >= 4, shiftleft(1, length(bin(size)) - 2) + 1, null)",
    "wide": """if(
        size >= 4 and 5L * size >= shiftleft(4L, length(bin(size))), shiftleft(1, length(bin(size)) - 1) + 1, null
    )""",
}


def _dealt(cut: str) -> str:
    """The numbers of the words by (part, length, hash)."""
    part = f"shiftleft(shiftrightunsigned(w, 36) % {cut}, 36)"
    return f"if({cut} is null, null, sort_array(transform(numbers, w -> {part} | (w & 68719476735L))))"


def _marks(dealt: str, cut: str) -> str:
    """A mark, in no order, for each part that has words: what tells more is smaller; then 56 bits
    of a digest of its last three words, the longest ones, or of its start in place of them."""
    words = ["w", *(f"greatest(get({dealt}, i - {back}), w & -68719476736L)" for back in (1, 2))]
    tells = " + ".join(f"({word} & {31 << 31}L)" for word in words)
    digest = f"xxhash64({', '.join(words)}, {cut}) & 72057594037927935L"
    mark = f"({126 << 56}L - shiftleft({tells}, 25)) | ({digest})"
    last = f"coalesce(shiftrightunsigned(w ^ get({dealt}, i + 1), 36) <> 0, true)"
    return f"array_compact(transform({dealt}, (w, i) -> if({last}, {mark}, null)))"


def _first_marks(marks: str, dealt: str, cut: str) -> str:
    """One mark more than the words that may differ from a similar line, a quarter of its own at most.
    Parts without a word tell least, and are seldom among them."""
    bare = f"filter(sequence(0, {cut} - 1), part -> not exists({dealt}, w -> shiftrightunsigned(w, 36) = part))"
    bare = f"transform({bare}, part -> shiftleft(127L, 56) | (xxhash64(part, {cut}) & 72057594037927935L))"
    every = f"if(size({marks}) > size div 4, {marks}, concat({marks}, {bare}))"
    return f"coalesce(slice(sort_array({every}), 1, size div 4 + 1), array())"


# 256 parities of the words; numbers of the same first two bits are in the same one of four columns.
_BITS = {
    f"bits{k}": f"""aggregate(numbers, 0L, (bits, w) -> if(
        shiftrightunsigned(w, 62) = {k}, bits ^ shiftleft(1L, cast(shiftrightunsigned(w, 56) as int)), bits
    ))"""
    for k in range(4)
}


def _exprs(named: dict[str, str]) -> list[Column]:
    return [F.expr(value).alias(name) for name, value in named.items()]


def _profiles(lines: DataFrame) -> DataFrame:
    """(id, row, place, key, more, size, the bits, marks) of every line."""
    # Step by step: what a step names is made once, and outside of lambdas where it can be.
    out = ["id", "row", "place", *_KEYS, "size", *_BITS]
    numbered = lines.select("id", "row", "place", F.expr(_NUMBERS).alias("numbers"))
    sized = numbered.select("*", *_exprs(_KEYS), F.size("numbers").alias("size"))
    cut = sized.select("*", *_exprs(_BITS), *_exprs(_CUTS))
    dealt = cut.select(*out, *_CUTS, *_exprs({f"{c}_dealt": _dealt(c) for c in _CUTS}))
    marked = dealt.select("*", *_exprs({f"{c}_marks": _marks(f"{c}_dealt", c) for c in _CUTS}))
    first = ", ".join(_first_marks(f"{c}_marks", f"{c}_dealt", c) for c in _CUTS)
    return marked.select(*out, F.expr(f"concat({first})").alias("marks"))


def _shared(profiles: DataFrame) -> DataFrame:
    """(key, mark), written: the marks that several sets of words have."""
    # A window and no join: the marks of all lines are the most that is moved, and go once. 48 bits do for
    # a mark there, and stand last: the ones before them and the next row's head are one run that packs well.
    same = Window.partitionBy("mark")
    marks = profiles.select("key", F.explode("marks").alias("mark"))
    marks = marks.select("key", F.expr(f"mark | {-1 << 48}L").alias("mark"))
    several = (F.min("key").over(same) < F.max("key").over(same)).alias("several")
    members = marks.select("key", "mark", several).where("several").drop("several").distinct()
    return materialize(members, "line-marks", free=True)


# How many words at most are in one of two similar lines only.
_APART = "({x}.size + {y}.size - 2 * ((4 * ({x}.size + {y}.size) + 8) div 9))"


def _parities(names: Iterable[str]) -> str:
    """How many of these bits differ: as many words, or more, are in one line only."""
    return " + ".join(f"bit_count({{x}}.{name} ^ {{y}}.{name})" for name in names)


_PARITIES = _parities(_BITS)


def _near(x: str, y: str, parities: str = _PARITIES) -> Column:
    """Whether the filters leave room for a similarity of 0.8."""
    return F.expr(
        f"least({{x}}.size, {{y}}.size) * 5 >= greatest({{x}}.size, {{y}}.size) * 4 and {parities} <= {_APART}".format(
            x=x, y=y
        )
    )


_MEMBER = ["n", "size", *_BITS]


def _with_near(every: DataFrame, near: Column, label: str) -> DataFrame:
    """The rows x of a table with a row y of the same mark that is `near`; that table is erased."""
    # It has to be a written one: both sides of the join are one shuffled table then.
    same_mark = F.col("x.mark") == F.col("y.mark")
    left = every.alias("x").join(every.alias("y"), same_mark & near, "left_semi")
    left = materialize(left.select("mark", "n", "size", *(c for c in every.columns if c == "open")), label, free=True)
    erase(every)
    return left


def _members(shared: DataFrame, sets: DataFrame) -> DataFrame:
    """(mark, n, size), written: the sets of each mark that have a near one there; `shared` is erased."""
    # By 128 parities that the 256 give: half of what would be moved, and they tell enough of most lines.
    half = {"even": "bits0 ^ bits2", "odd": "bits1 ^ bits3"}
    every = shared.join(sets.select("key", "n", "size", *_exprs(half)), "key").select("mark", "n", "size", *half)
    every = materialize(every, "line-entries", free=True)
    erase(shared)
    return _with_near(every, (F.col("x.n") != F.col("y.n")) & _near("x", "y", _parities(half)), "line-members")


def _words_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(n, words) of the wanted lines (n, key, more, id, place), read again from their documents."""
    per_doc = wanted.groupBy(key_of("id").alias("doc")).agg(
        F.collect_list(F.struct("place", "key", "more", "n")).alias("wanted")
    )
    # A bitmap of fixed size keeps out documents with nothing wanted before they are moved.
    bit = f"pmod(xxhash64(doc), {_BITMAP}L)"
    found = per_doc.groupBy(F.expr(f"{bit} div 64").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({bit} % 64 as int))")).alias("bits")
    )
    every = docs.sparkSession.range(_BITMAP // 64).withColumnRenamed("id", "at").join(found, "at", "left")
    pair = F.struct("at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    bitmap = materialize(
        every.agg(F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["bits"]).alias("bitmap")),
        "bitmap",
        free=True,
    ).scalar()
    source = docs.select(key_of(id_col).alias("doc"), text_or_empty(text_col).alias("text"))
    source = source.withColumn("bitmap", bitmap).where(
        F.expr(f"bitmap[cast({bit} div 64 as int)] & shiftleft(1L, cast({bit} % 64 as int)) <> 0")
    )
    read = (
        source.drop("bitmap")
        .join(per_doc, "doc")
        .withColumn("lines", F.split("text", "\n"))
        .select("lines", F.explode("wanted").alias("at"))
        .select("at.*", F.get("lines", F.col("at.place")).alias("line"))
        .select("n", "key", "more", "line", F.expr(_NUMBERS).alias("numbers"))
    )
    # A repeated id may stand for another text.
    right = F.expr(" and ".join(f"{name} <=> ({value})" for name, value in _KEYS.items()))
    words = F.expr(f"array_remove(array_distinct({_WORDS}), '')")
    return read.where(right).select("n", words.alias("words")).dropDuplicates(["n"])


def _words_of_sets(
    numbers: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str
) -> DataFrame:
    """(n, words) of the sets of these numbers (n), written."""
    wanted = sets.select("n", *_KEYS, "id", "place").join(numbers, "n", "left_semi")
    return materialize(_words_of(docs, wanted, id_col, text_col), "line-words", free=True)


def _similar(x: str, y: str) -> Column:
    """Whether two lists of different words are similar."""
    return F.expr(f"size(array_intersect({x}, {y})) * 9 >= (size({x}) + size({y})) * 4")


def _verified(
    pairs: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str
) -> DataFrame:
    """Numbers of the sets that are similar to the earlier one they are paired with, written."""
    pairs = materialize(pairs, "line-pairs", free=True)
    paired = pairs.select(F.col("later").alias("n")).union(pairs.select("earlier")).distinct()
    words = _words_of_sets(paired, sets, docs, id_col, text_col)
    later = words.select(F.col("n").alias("later"), F.col("words").alias("later_words"))
    earlier = words.select(F.col("n").alias("earlier"), F.col("words").alias("earlier_words"))
    similar = (
        pairs.join(later, "later")
        .join(earlier, "earlier")
        .where(_similar("later_words", "earlier_words"))
        .select(F.col("later").alias("n"))
        .distinct()
    )
    followers = materialize(similar, "followers", free=True)
    erase(pairs, words)
    return followers


def _first_pairs(members: DataFrame) -> DataFrame:
    """(later, earlier): each set with the nearest of the first and the previous sets of its marks."""
    here = F.struct(*_MEMBER)
    by_mark = Window.partitionBy("mark").orderBy("n")
    so_far = by_mark.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = members.select(here.alias("x"), F.first(here).over(so_far).alias("y"), F.lag(here).over(by_mark).alias("z"))
    apart = {
        name: F.when((F.col("x.n") != F.col(f"{name}.n")) & _near("x", name), F.expr(_PARITIES.format(x="x", y=name)))
        for name in "yz"
    }
    nearest = F.least(*apart.values())
    found = F.when(nearest == apart["y"], F.col("y.n")).otherwise(F.col("z.n"))
    met = met.select(F.col("x.n").alias("later"), nearest.alias("apart"), found.alias("earlier"))
    return met.where("apart is not null").groupBy("later").agg(F.min_by("earlier", "apart").alias("earlier"))


def _followers(members: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Numbers of the sets with an earlier similar set; `members` are erased."""
    left = members.join(sets.select("n", *_BITS), "n").select("mark", *_MEMBER)
    left = materialize(left, "line-bits", free=True)
    erase(members)
    easy = _verified(_first_pairs(left), sets, docs, id_col, text_col)

    is_open = F.when(F.col("found").isNull(), 1).otherwise(0).alias("open")
    every = left.join(easy.withColumn("found", F.lit(True)), "n", "left").select("mark", *_MEMBER, is_open)
    every = materialize(every, "line-open", free=True)
    erase(left)
    # Open sets with an earlier near one, and sets with a later near one that is open.
    asks = F.expr("(y.n < x.n and x.open = 1) or (x.n < y.n and y.open = 1)")
    rest = _with_near(every, asks & _near("x", "y"), "line-rest")

    words = _words_of_sets(rest.select("n").distinct(), sets, docs, id_col, text_col)
    bits = sets.select("n", *_BITS).join(words, "n")
    worded = materialize(rest.join(bits, "n"), "line-worded", free=True)
    erase(rest, words)
    asks = F.expr("y.n < x.n and x.open = 1") & _near("x", "y") & _similar("x.words", "y.words")
    hard = _with_near(worded, asks, "line-hard")
    found = materialize(hard.select("n").distinct(), "followers", free=True)
    erase(hard)
    return easy.union(found)


def mark_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_removed, removed): one row for each row of `docs`; `removed` is an
    array of line numbers from 0."""
    marked = _marked(docs, id_col, text_col, F.monotonically_increasing_id())
    return marked.select(
        F.col("id").alias(id_col), "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed"
    )


def _marked(docs: DataFrame, id_col: str, text_col: str, row: Column) -> DataFrame:
    """(row, id, n_lines, removed), where `row` is a number of each row."""
    profiles = materialize(_profiles(_lines(docs, id_col, text_col, row)), "lines", free=True)
    shared = _shared(profiles)
    # The first line of each set of words; copies are combined before they are moved.
    firsts = profiles.where("key is not null").groupBy(*_KEYS).agg(
        F.min(F.struct("id", "place", "row", "size", *_BITS)).alias("first")
    )
    # Numbered in their order: a smaller number is an earlier line.
    order = ["id", "place", "row"]
    sets = materialize(
        firsts.select(*_KEYS, "first.*")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("n", F.monotonically_increasing_id()),
        "line-sets",
        free=True,
    )
    every = materialize(profiles.select("id", "row", "place", *_KEYS), "line-keys", free=True)
    erase(profiles)  # Their marks are most of what is written.
    members = _members(shared, sets)
    followers = _followers(members, sets, docs, id_col, text_col).withColumn("follows", F.lit(True))
    fates = sets.join(followers, "n", "left").select(
        *_KEYS, F.col("row").alias("first_row"), F.col("place").alias("first_place"), "follows"
    )
    removed = F.col("key").isNotNull() & (
        F.col("follows").isNotNull()
        | (F.col("row") != F.col("first_row"))
        | (F.col("place") != F.col("first_place"))
    )
    return (
        every.join(fates, [*_KEYS], "left")
        .groupBy("row")
        .agg(
            F.first("id").alias("id"),
            F.count("*").alias("n_lines"),
            F.array_sort(F.collect_list(F.when(removed, F.col("place")))).alias("removed"),
        )
    )


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the removed lines, each row once; null and repeated ids are told apart by
    the numbers of the written rows. Null texts stay null."""
    row, gone = fresh(docs, "line_row"), fresh(docs, "line_gone")
    placed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "line-rows", free=True)
    marked = _marked(placed, id_col, text_col, F.col(row)).select(
        F.col("row").alias(row), F.col("removed").alias(gone)
    )
    kept = F.expr(
        f"array_join(filter(transform(split(`{text_col}`, '\n'), (line, i) -> "
        f"if(array_contains({gone}, i), null, line)), line -> line is not null), '\n')"
    )
    return (
        placed.join(marked, row)
        .withColumn(text_col, kept)
        .select(*(f"`{name}`" for name in docs.columns))
    )
