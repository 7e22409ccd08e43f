"""The trie of conversations: one node for each distinct sequence of first turns."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercastar.llm.columns import quoted
from mercastar.operators.ranking import global_rank
from mercastar.storage import durable

# Depths of one band. A node explodes to at most so many ancestors, and a trie of
# depth n takes log(n) / log(BAND) rounds.
BAND = 16

# Conversations of one block share the first turns of its first one.
BLOCK, MOST_SHARED = 100, 6

# Ids of conversations that end at a node are joined in pieces of at most 2**12.
ID_BITS = 12

NODE = ["depth", "f1", "f2"]


def told_turns(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Turns in order: `(conv_id, at, c1, c2, chars)`, `at` from 0 in each conversation.

    c1 and c2 are 60 bits each of the md5 of role and text, and stand for them from
    here on. All turns are ranked at once by (conversation, turn, md5), so a
    conversation that holds most rows is spread over tasks like all rows.
    """
    blank = F.lit("")
    said, by = (F.coalesce(F.col(quoted(c)).cast("string"), blank) for c in (text, role))
    digest = F.md5(F.concat(F.length(by).cast("string"), F.lit(":"), by, said).cast("binary"))
    turns = df.select(
        F.col(quoted(conversation)).cast("bigint").alias("conv_id"),
        F.col(quoted(turn)).alias("turn"),
        digest.alias("digest"),
        F.length(said).cast("bigint").alias("chars"),
    ).where(F.col("conv_id").isNotNull())

    def sixty_bits(first: int) -> Column:
        return F.conv(F.substring("digest", first, 15), 16, 10).cast("bigint")

    turns = turns.select("conv_id", "turn", "chars", sixty_bits(1).alias("c1"), sixty_bits(16).alias("c2"))
    ranked = durable(global_rank(turns, ["conv_id", "turn", "c1", "c2"], "rank"))
    first = durable(ranked.groupBy(F.col("conv_id").alias("of")).agg(F.min("rank").alias("first")))
    at = (F.col("rank") - F.col("first")).alias("at")
    return durable(
        ranked.join(first, F.col("conv_id") == F.col("of")).select("conv_id", at, "c1", "c2", "chars")
    )


def with_shared_starts(turns: DataFrame, block: int = BLOCK, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of their block: `(turns, conversations)`.

    Conversation c starts with the first h turns of conversation c - c % block (all
    if it has fewer, none if there is none) and goes on with its own turns after its
    first h, where h is crc32(c) % most. A block has at most `block` conversations of
    one sign, so no key of the joins is hot but a long conversation's own.
    Returns the turns, and `(conv_id, n_turns)` with conversations left without turns.
    """
    owns = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    owns = owns.withColumn("h", shared).withColumn("base", F.col("conv_id") - F.col("conv_id") % block)
    owns = durable(owns)
    heads = owns.select(F.col("conv_id").alias("head"), F.col("own").alias("head_turns"))
    taken = F.least("h", F.coalesce("head_turns", F.lit(0))).cast("int")
    convs = owns.join(heads, F.col("base") == F.col("head"), "left").withColumn("taken", taken)
    length = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = durable(convs.select("conv_id", "h", "base", "taken", length.alias("n_turns")))

    moved = convs.select(F.col("conv_id").alias("of"), "h", "taken")
    own = turns.join(moved, F.col("conv_id") == F.col("of")).where(F.col("at") >= F.col("h"))
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "c1", "c2", "chars")
    wanted = convs.where(F.col("taken") > 0).select(
        F.col("conv_id").alias("to"), "base", F.explode(F.sequence(F.lit(0), F.col("taken") - 1)).alias("n")
    )
    starts = turns.where((F.col("conv_id") % block == 0) & (F.col("at") < most - 1))
    starts = wanted.join(starts, (F.col("base") == F.col("conv_id")) & (F.col("n") == F.col("at")))
    starts = starts.select(F.col("to").alias("conv_id"), "at", "c1", "c2", "chars")
    return durable(own.unionByName(starts)), convs.select("conv_id", "n_turns")


def _running(rows: DataFrame, deepest: int) -> DataFrame:
    """`(conv_id, depth, x1, x2, f1, f2)`: f is the XOR of all x down to that depth.

    Bands of BAND depths are summed in windows of as many rows; the totals of bands
    are summed in the same way, and give each band what stands above it.
    """
    band = F.expr(f"depth DIV {BAND}")
    line = Window.partitionBy("conv_id", band).orderBy("depth")
    inside = rows.select(
        "conv_id", "depth", "x1", "x2",
        F.bit_xor("x1").over(line).alias("f1"), F.bit_xor("x2").over(line).alias("f2"),
    )
    if deepest < BAND:
        return inside
    bands = rows.groupBy("conv_id", band.alias("depth")).agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    above = _running(durable(bands), deepest // BAND).select(
        F.col("conv_id").alias("of"), (F.col("depth") + 1).alias("band"), F.col("f1").alias("a1"), F.col("f2").alias("a2")
    )
    joined = inside.join(above, (F.col("conv_id") == F.col("of")) & (band == F.col("band")), "left")
    return joined.select(
        "conv_id", "depth", "x1", "x2",
        *[F.col(f).bitwiseXOR(F.coalesce(a, F.lit(0))).alias(f) for f, a in (("f1", "a1"), ("f2", "a2"))],
    )


def _paths(steps: DataFrame, unit: int) -> DataFrame:
    """The nodes of each conversation at multiples of `unit`, one row for each band of them."""
    own = steps.where(F.col("depth") % unit == 0).withColumn("place", F.expr(f"depth DIV {unit}"))
    own = own.groupBy(F.col("conv_id").alias("of"), F.expr(f"place DIV {BAND}").alias("of_band"))
    return own.agg(F.array_sort(F.collect_list(F.struct("place", "f1", "f2"))).alias("path"))


def _rolled_up(nodes: DataFrame, steps: DataFrame, sums: list[str], deepest: int, unit: int = 1) -> DataFrame:
    """`(place, f1, f2, conv_id, *sums)`: the sums over each node's subtree.

    `nodes` are the nodes at depths place * unit. A node explodes to its ancestors in
    its band, itself included. The totals of band roots, complete after a rollup over
    the trie of band roots alone, then go to the ancestors in the band above.
    """
    paths = _paths(steps, unit)
    if deepest >= BAND:
        paths = durable(paths)
    in_band = F.col("place") - F.col("of_band") * BAND

    def sent(rows: DataFrame, band: Column, upto: Column) -> DataFrame:
        on = (F.col("conv_id") == F.col("of")) & (band == F.col("of_band"))
        out = rows.join(paths, on).select(
            "place", "conv_id", *sums, F.explode(F.slice("path", F.lit(1), upto.cast("int"))).alias("up")
        )
        own = F.when(F.col("up.place") == F.col("place"), F.col("conv_id")).alias("conv_id")
        return out.select("up.place", "up.f1", "up.f2", own, *sums)

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("place", "f1", "f2").agg(
            F.max("conv_id").alias("conv_id"), *[F.sum(s).alias(s) for s in sums]
        )

    inside = summed(sent(nodes, F.expr(f"place DIV {BAND}"), in_band + 1))
    if deepest < BAND:
        return inside
    inside = durable(inside)
    roots = inside.where(F.col("place") % BAND == 0).withColumn("place", F.expr(f"place DIV {BAND}"))
    done = _rolled_up(roots, steps, sums, deepest // BAND, unit * BAND)
    below = done.where(F.col("place") > 0).withColumn("band", F.col("place") - 1).withColumn("place", F.col("place") * BAND)
    # All of a band stands above the root of the next one.
    return durable(summed(inside.unionByName(sent(below, F.col("band"), F.lit(BAND)))))


def _digests(shape: str) -> Callable:
    """SHA-256 of the pieces of each node, which come in order, joined by commas."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, None
        for batch in batches:
            out = []
            for depth, f1, f2, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
                if (depth, f1, f2) == now:
                    running.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((*now, running.hexdigest()))
                now, running = (depth, f1, f2), hashlib.sha256(ids.encode())
            yield _as_batch(out, shape)
        if now is not None:
            yield _as_batch([(*now, running.hexdigest())], shape)

    return work


def _as_batch(rows: list[tuple], shape: str) -> pa.RecordBatch:
    kinds = [pa.string() if part.endswith("string") else pa.int64() for part in shape.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    names = [part.split()[0] for part in shape.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _ends(steps: DataFrame) -> DataFrame:
    """The digest of the ids of the conversations that end at a node, for nodes with any.

    Ids that differ only in their low bits form one piece, so no group has more than
    2**ID_BITS of them; a task streams the pieces of a node in order.
    """
    pieces = (
        steps.where("is_end")
        .groupBy(*NODE, F.shiftright("conv_id", ID_BITS).alias("piece"))
        .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
        .select(*NODE, "piece", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    )
    shape = "depth bigint, f1 bigint, f2 bigint, ends_sha256 string"
    line = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece")
    return line.select(*NODE, "ids").mapInArrow(_digests(shape), shape)


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of the conversations.

    `turns` are `(conv_id, at, c1, c2, chars)`, `at` from 0 without gaps;
    `conversations` are `(conv_id, n_turns)`, one row each. Returns `conv_id` (least
    member, that is conversation starting with the sequence), `depth` (its turns; the
    root has none), `parent_conv_id` (NULL for the root), `n_convs` (members),
    `n_children`, `n_leaves` (childless nodes in the subtree, itself included),
    `saved_tokens` (over the subtree, members less one times characters of the last
    turn) and `ends_sha256` (of the ids of the members that end here, ascending).

    A sequence is named by the XOR of hashes of (position, turn) in 2 x 64 bits.
    Sums over subtrees go up in bands of 16 depths: see `_rolled_up`. Everything
    that is grouped by a node is aggregated before it moves.
    """
    place = F.col("at") + 1
    marked = turns.select(
        "conv_id",
        place.alias("depth"),
        F.xxhash64(F.lit(1), place, "c1", "c2").alias("x1"),
        F.xxhash64(F.lit(2), place, "c2", "c1").alias("x2"),
    )
    zero = F.lit(0).cast("bigint")
    top = conversations.select("conv_id", zero.alias("depth"), zero.alias("x1"), zero.alias("x2"))
    marked = durable(marked.unionByName(top))
    deepest = marked.agg(F.max("depth")).first()[0] or 0
    lengths = conversations.select(F.col("conv_id").alias("of"), "n_turns")
    named = _running(marked, deepest).join(lengths, F.col("conv_id") == F.col("of"))
    sizes = turns.select(F.col("conv_id").alias("whose"), place.alias("where"), "chars")
    named = named.join(sizes, (F.col("conv_id") == F.col("whose")) & (F.col("depth") == F.col("where")), "left")
    steps = durable(
        named.select(
            "conv_id",
            *NODE,
            F.col("f1").bitwiseXOR(F.col("x1")).alias("p1"),
            F.col("f2").bitwiseXOR(F.col("x2")).alias("p2"),
            F.coalesce("chars", F.lit(0)).alias("chars"),
            (F.col("depth") == F.col("n_turns")).alias("is_end"),
        )
    )
    nodes = durable(
        steps.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.count_if("is_end").alias("n_ends"),
            F.max("chars").alias("chars"),
            F.max("p1").alias("p1"),
            F.max("p2").alias("p2"),
        )
    )
    weights = nodes.select(
        F.col("depth").alias("place"), "f1", "f2", "conv_id",
        # All members of a childless node end there.
        (F.col("n_ends") == F.col("n_convs")).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    totals = _rolled_up(weights, steps, ["n_leaves", "saved_tokens"], deepest)
    totals = totals.select(F.col("place").alias("depth"), "f1", "f2", "n_leaves", "saved_tokens")
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    parents = nodes.where("n_ends < n_convs").select(
        (F.col("depth") + 1).alias("child_depth"), F.col("f1").alias("q1"), F.col("f2").alias("q2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    below = (F.col("depth") == F.col("child_depth")) & (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2"))
    # Children of one node may be most of all nodes: a join of two stored sides is split by the skew join.
    related = durable(nodes.join(parents, below, "left").drop("child_depth", "q1", "q2"))
    out = related.join(totals, NODE).join(children, NODE, "left").join(_ends(steps), NODE, "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def conversation_trie(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block: int | None = BLOCK,
) -> DataFrame:
    """The prefix trie of a table of turns, as `prefix_trie` returns it.

    With `block`, conversations are first rebuilt on the first turns of their block.
    Turns are ordered by turn, NULL first; equal turn numbers by the md5 of role and
    text; repeated rows are repeated turns. NULL roles and texts count as empty. Rows
    without a conversation belong to none and are left out. Texts of any length count
    by their md5 and their number of characters. Other columns are ignored, whatever
    their names; an empty table gives no rows.
    """
    turns = told_turns(df, conversation, turn, role, text)
    if block:
        turns, conversations = with_shared_starts(turns, block)
    else:
        conversations = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    return prefix_trie(turns, conversations)
