"""Reply trees formatted as conversations, in DataFrame operations only.

A message answers another one of its tree or none. Self-joins, iterated with pointers that
double their reach, give each message its root, depth and the score of its path; so they
take as many rounds as the depth has binary digits. The branches of a root are ranked by
the score of their paths, and the same pointers, from the longest to the shortest, list
the messages of the chosen ones.

A formatted conversation holds, for each turn, `<|im_start|>role`, a line feed, the text,
`<|im_end|>` and a line feed. Inside roles and texts `&` becomes `&amp;` and `<|` becomes
`&lt;|`, in roles a line feed becomes `&#10;`; that can be undone. Beside it stand where
each turn starts and the loss mask: the spans of the assistant's texts, in code
points of the formatted text, each with its turn.

Defined results: null roles and texts count as empty. A message whose parent is null or
unknown is a root; messages on a circle belong to no tree and are left out. Messages with
a null id answer or are answered by none. Ties between branches go to the smallest leaf.
Turns of a conversation follow each other by turn (null first), then role and text, so
repeated turns all stay. Rows with a null conversation id are one conversation. No
rows give no conversations. Other columns are not read.

A conversation is one row, so its text has to fit in a task; everything before that is
spread by message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.llm.batches import key_of
from finmart.sources.scratch import materialize

# The marks of a turn.
START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    plain = F.replace(text, F.lit("&lt;|"), F.lit("<|"))
    return F.replace(F.replace(plain, F.lit("&#10;"), F.lit("\n")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def _jumps(messages: DataFrame) -> list[DataFrame]:
    """(id, ancestor, depth, total) with ancestors 1, 2, 4, ... steps above; past the root
    the ancestor is null. Depth and total count from the message to before its ancestor.
    The last one has null ancestors only, or none that change."""
    known = messages.select(F.col("id").alias("known"))
    first = (
        messages.join(known, F.col("parent") == F.col("known"), "left")
        .select("id", F.col("known").alias("ancestor"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("total"))
    )
    jumps = [materialize(first, "jump")]
    most = messages.count()
    while 2 ** (len(jumps) - 1) <= most:
        last = jumps[-1]
        if last.where("ancestor is not null").isEmpty():
            break
        above = last.select(
            F.col("id").alias("ancestor"),
            F.col("ancestor").alias("next"),
            F.col("depth").alias("more"),
            F.col("total").alias("plus"),
        )
        # Only messages below the root of their path so far are joined.
        further = (
            last.where("ancestor is not null")
            .join(above, "ancestor")
            .select(
                "id",
                F.col("next").alias("ancestor"),
                (F.col("depth") + F.col("more")).alias("depth"),
                (F.col("total") + F.col("plus")).alias("total"),
            )
        )
        jumps.append(materialize(further.union(last.where("ancestor is null")), "jump"))
    return jumps


def best_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """(root, leaf, turn, id) of the `best` branches of each root by their mean score.

    `messages` has (id, parent, score) with unique ids; `turn` counts from 0 at the root.
    """
    messages = materialize(
        messages.where("id is not null").select(
            "id", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")
        ),
        "messages",
    )
    jumps = _jumps(messages)
    paths = jumps[-1].where("ancestor is null")
    answered = messages.select(F.col("parent").alias("id")).where("id is not null").distinct()
    leaves = paths.join(answered, "id", "left_anti").select(F.col("id").alias("leaf"), "depth", "total")

    # All messages of the leaves' paths down to the roots, with the longest jumps first.
    roots = leaves.select("leaf", F.col("leaf").alias("at"))
    for jump in reversed(jumps):
        step = jump.where("ancestor is not null").select(F.col("id").alias("at"), "ancestor")
        roots = roots.join(step, "at", "left").select(
            "leaf", F.coalesce("ancestor", "at").alias("at")
        )
    ranked = leaves.join(roots.withColumnRenamed("at", "root"), "leaf")
    order = Window.partitionBy("root").orderBy(F.desc(F.col("total") / F.col("depth")), "leaf")
    chosen = materialize(
        ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best), "chosen"
    ).select("root", "leaf", (F.col("depth") - 1).alias("last"))

    # Each step lists, with every message so far, the one 2^k above it.
    members = chosen.select("root", "leaf", F.col("last").alias("turn"), F.col("leaf").alias("id"))
    for k in reversed(range(len(jumps))):
        step = jumps[k].where("ancestor is not null").select("id", "ancestor")
        both = F.array(
            F.struct("turn", "id"),
            F.struct((F.col("turn") - 2**k).alias("turn"), F.col("ancestor").alias("id")),
        )
        members = (
            members.join(step, "id", "left")
            .select("root", "leaf", F.explode(both).alias("at"))
            .where("at.id is not null")
            .select("root", "leaf", "at.turn", "at.id")
        )
    return members


def format_paths(paths: DataFrame, messages: DataFrame, key: list[str]) -> DataFrame:
    """(key, formatted, turn_starts, loss_spans) of each path.

    `paths` has (key, turn, id), `messages` (id, role, text); `loss_spans` is an array of
    (turn, start, end).
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = paths.join(messages.select("id", role.alias("role"), text.alias("text")), "id")
    lead = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    parts = turns.select(
        *key,
        "turn",
        F.concat(lead, escape(F.col("text")), F.lit(END)).alias("part"),
        F.char_length(lead).cast("long").alias("lead"),
        F.char_length(escape(F.col("text"))).cast("long").alias("long"),
        (F.col("role") == "assistant").alias("learnt"),
    )
    before = Window.partitionBy(*key).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("start", F.coalesce(F.sum(F.char_length("part")).over(before), F.lit(0)))
    whole = F.array_sort(F.collect_list(F.struct("turn", "part", "start", "lead", "long", "learnt")))
    spans = F.transform(
        F.filter("turns", lambda t: t["learnt"]),
        lambda t: F.struct(
            t["turn"].alias("turn"),
            (t["start"] + t["lead"]).alias("start"),
            (t["start"] + t["lead"] + t["long"]).alias("end"),
        ),
    )
    return placed.groupBy(*key).agg(whole.alias("turns")).select(
        *key,
        F.array_join(F.transform("turns", lambda t: t["part"]), "").alias("formatted"),
        F.transform("turns", lambda t: t["start"]).alias("turn_starts"),
        spans.alias("loss_spans"),
    )


def read_back(formatted: DataFrame, key: list[str]) -> DataFrame:
    """(key, formatted, turns, loss_texts): an array of (role, text), and the texts under
    the loss mask, all as they were before they were formatted."""
    # What follows the last mark is empty.
    segments = F.split("formatted", F.lit("<\\|im_end\\|>\n"))
    split = formatted.withColumn("segments", F.slice(segments, 1, F.size(segments) - 1))

    def turn(segment: Column) -> Column:
        head = F.substring_index(segment, "\n", 1)
        return F.struct(
            unescape(F.substr(head, F.lit(len(START) + 1))).alias("role"),
            unescape(F.substr(segment, F.char_length(head) + 2)).alias("text"),
        )

    def loss(span: Column) -> Column:
        at = span["turn"].cast("int")
        first = span["start"] - F.get("turn_starts", at) + 1
        return unescape(
            F.substr(F.get("segments", at), first.cast("int"), (span["end"] - span["start"]).cast("int"))
        )

    return split.select(
        *key,
        "formatted",
        F.transform("segments", turn).alias("turns"),
        F.transform("loss_spans", loss).alias("loss_texts"),
    )


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as messages (id, parent, score, conv_id, role,
    text): each answers the one before it in its conversation."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = conversations.select(
        "conv_id", "role", "text", F.row_number().over(order).alias("place")
    )
    conversation = key_of("conv_id")
    return placed.select(
        F.concat_ws("/", conversation, "place").alias("id"),
        F.when(
            F.col("place") > 1, F.concat_ws("/", conversation, F.col("place") - 1)
        ).alias("parent"),
        F.lit(0.0).alias("score"),
        "conv_id",
        "role",
        "text",
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, turn_starts, loss_spans) of each conversation."""
    messages = materialize(linear_messages(conversations), "turns")
    paths = best_paths(messages.select("id", "parent", "score"))
    owner = messages.select(F.col("id").alias("root"), "conv_id")
    return format_paths(paths.join(owner, "root"), messages, ["root", "conv_id"]).drop("root")
