"""Exact de-duplication by content-defined chunk recipes, in DataFrame operations only.

A text is cut where its own characters say so, after at least `CHUNK_LEAST` of them: equal
texts have equal chunks. Each distinct chunk is moved once, to verify that chunks with
equal hashes are equal; where they are not, a number among the chunks of that hash joins
the hash. These verified identifiers make up a text's recipe, and recipes, ordered lists
of identifiers, are compared in place of the texts.

Defined results: a null text counts as empty (its recipe has no chunks); of equal texts
the row with the largest id stays, a null id being the smallest, and of several such rows
exactly one. No rows give no rows. Other columns are not read by `find_copies`;
`drop_copies` keeps them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.llm.batches import fresh, key_of, text_or_empty
from finmart.sources.scratch import materialize

CHUNK_LEAST, CHUNK_MOST = 1024, 16384

# A chunk ends after a line feed or after two characters whose code points both divide
# by 8; a longer stretch without any is cut at CHUNK_MOST.
_DIVIDING = "".join(f"\\x{{{point:x}}}" for point in range(0, 0x800, 8))
CHUNK = (
    f"(?s).{{{CHUNK_LEAST},{CHUNK_MOST}}}?(?:(?<=\\n)|(?<=[{_DIVIDING}]{{2}}))"
    f"|.{{1,{CHUNK_MOST}}}"
)


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def _recipes(
    docs: DataFrame, id_col: str, text_col: str, hash_of: Callable[[Column], Column]
) -> DataFrame:
    """(id, row, text_sha256, recipe) with a recipe of verified identifiers."""
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    sha = F.sha2("text", 256).alias("text_sha256")
    plain = materialize(
        source.select(
            "id",
            F.monotonically_increasing_id().alias("row"),
            sha,
            F.transform(
                chunks(F.col("text")),
                lambda chunk: F.struct(hash_of(chunk).alias("hash"), F.lit(0).alias("variant")),
            ).alias("recipe"),
        ),
        "recipes",
    )

    # Copies are combined before they are moved; then one row for each distinct chunk
    # counts for its hash.
    distinct = (
        source.select(F.explode(chunks(F.col("text"))).alias("chunk"))
        .select(hash_of(F.col("chunk")).alias("hash"), "chunk")
        .groupBy("hash", "chunk")
        .agg(F.count("*").alias("uses"))
    )
    shared = materialize(
        distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"),
        "shared-hashes",
    )
    if shared.isEmpty():
        return plain
    return _told_apart(plain, source.withColumn("text_sha256", sha), shared, hash_of)


def _told_apart(
    plain: DataFrame, source: DataFrame, shared: DataFrame, hash_of: Callable[[Column], Column]
) -> DataFrame:
    """Recipes in which different chunks of one hash have different variants."""
    places = (
        source.select("text_sha256", F.posexplode(chunks(F.col("text"))).alias("place", "chunk"))
        .withColumn("hash", hash_of(F.col("chunk")))
        .join(shared, "hash", "left_semi")
        .groupBy("text_sha256", "place", "hash", "chunk")
        .agg(F.count("*").alias("uses"))
    )
    # A variant is the place of the chunk among the distinct ones of its hash, in order.
    contents = places.select("hash", "chunk").distinct()
    smaller = contents.select("hash", F.col("chunk").alias("other"))
    variants = (
        contents.join(smaller, "hash")
        .where("other < chunk")
        .groupBy("hash", "chunk")
        .agg(F.count("*").cast("int").alias("variant"))
    )
    by_text = (
        places.join(variants, ["hash", "chunk"])
        .groupBy("text_sha256")
        .agg(F.map_from_entries(F.collect_list(F.struct("place", "variant"))).alias("variants"))
    )
    fixed = F.transform(
        "recipe",
        lambda part, place: F.struct(
            part["hash"].alias("hash"),
            F.coalesce(F.try_element_at("variants", place), F.lit(0)).alias("variant"),
        ),
    )
    return materialize(
        plain.join(by_text, "text_sha256", "left").select(
            "id",
            "row",
            "text_sha256",
            F.when(F.col("variants").isNull(), F.col("recipe")).otherwise(fixed).alias("recipe"),
        ),
        "told-apart",
    )


def find_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hash_of: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256): one row for each row of `docs`."""
    return _marked(_recipes(docs, id_col, text_col, hash_of)).withColumnRenamed("id", id_col)


def _marked(recipes: DataFrame) -> DataFrame:
    last = F.max(F.struct("id", "row"))
    groups = recipes.groupBy("recipe").agg(
        last.alias("last"), F.count("*").alias("group_size")
    )
    # Written, so that the rows of a hot recipe meet it in several tasks: adaptive execution
    # splits only joins whose sides come straight from a shuffle.
    groups = materialize(groups.where("group_size > 1"), "copy-groups")
    alone = F.col("group_size").isNull()
    return recipes.join(groups, "recipe", "left").select(
        "id",
        F.when(alone, F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("last.row"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that stay, with their columns. Rows are found again by their id
    and text digest, so long texts are not moved to be compared; of equal rows with an
    equal id one is left."""
    name = fresh(docs, "copy_key")
    stays = (
        find_copies(docs, id_col, text_col)
        .where("kept")
        .select(F.concat_ws("/", key_of(id_col), "text_sha256").alias(name))
    )
    key = F.concat_ws("/", key_of(id_col), F.sha2(text_or_empty(text_col), 256))
    found = docs.withColumn(name, key).join(stays, name, "left_semi")
    return found.dropDuplicates([name]).select(*(f"`{column}`" for column in docs.columns))
