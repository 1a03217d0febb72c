"""The trie of conversation prefixes: ROLLUP over columns of turns, one block of columns after another.

A conversation is cut into blocks of ``WIDTH`` turns, one column each. ``GROUP BY block, prior node, ROLLUP(t1 .. t8)``
then aggregates all prefixes that end in a block together, and all blocks of all conversations in one job: the key of
the prior block's node is known before any grouping, as every prefix has a key of its own (see ``_turn_key``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import stored, word_count

WIDTH = 8
#: Of a conversation's blocks or nodes, so many are in order in one task; spans of them are ordered by their sums.
SPAN = 4096
#: Conversations with ids in the same range of this size are written out together before they are hashed.
CHUNK_BITS = 8

NODE = ["depth", "k1", "k2"]


def turns_in_order(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv``, ``pos`` (from 0, gapless), ``id`` (128 bits of role and text), ``words`` and ``part``, one row a turn.

    Turns are in order of ``turn``, null first; turns that share it are in order of their content's hash, so the order
    does not depend on how rows are read. Equal turns all count. A null role or text becomes empty. A null ``conv``
    names no conversation; its rows are left out.

    Places come from one range exchange: within a partition a row's place is known, and a conversation that runs over
    several partitions (``part``) has the lengths of the earlier ones added. So a conversation of any length is dealt
    over tasks; equal turns are dealt out as well.
    """
    said, by = F.coalesce(turns[text].cast("string"), F.lit("")), F.coalesce(turns[role].cast("string"), F.lit(""))
    rows = turns.filter(turns[conv].isNotNull()).select(
        turns[conv].cast("bigint").alias("conv"), turns[turn].alias("turn"),
        F.unhex(F.md5(F.concat(F.length(by).cast("string"), F.lit(":"), by, said))).alias("id"),
        word_count(said).alias("words"), F.monotonically_increasing_id().alias("any"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("id")]
    dealt = rows.repartitionByRange(*order, F.col("any")).sortWithinPartitions(*order)
    dealt = stored(dealt.select(
        "conv", "id", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
    ))
    parts = dealt.groupBy("conv", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    # A conversation has no more rows here than there are partitions.
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("conv", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return dealt.join(starts, ["conv", "part"]).select("conv", (F.col("place") + F.col("shift")).alias("pos"), "id", "words", "part")


def branched(rows: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that branch off one another: ``conv``, ``pos``, ``id``, ``words``; and all ``conv``.

    Conversation c is made of the first h turns of conversation c - c % every (all if it has fewer, none if it is
    absent), followed by its own turns behind its first h; h is crc32(decimal c) % most. It may have no turn at all.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    base = F.col("conv") - F.col("conv") % every
    heads = rows.filter((F.col("pos") < most - 1) & (F.col("conv") % every == 0))
    heads = heads.select(F.col("conv").alias("base"), "pos", "id", "words")
    parts = rows.groupBy("conv", "part").agg(F.count("*").alias("n"))
    convs = parts.select("conv").distinct()
    taken = convs.select("conv", h.alias("h"), base.alias("base")).join(heads, "base").filter("pos < h")
    # Joined with the parts of a conversation first, so that the turns of a long one are not one key.
    lengths = heads.groupBy("base").agg(F.count("*").alias("head"))
    shifts = parts.withColumn("base", base).join(lengths, "base", "left").select("conv", "part", "head")
    own = rows.join(shifts, ["conv", "part"]).filter(F.col("pos") >= h).select(
        "conv", (F.col("pos") - h + F.least(h, F.coalesce("head", F.lit(0)))).alias("pos"), "id", "words"
    )
    return own.union(taken.select("conv", "pos", "id", "words")), convs


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations, one row a node.

    ``rows`` holds ``conv``, ``pos`` (from 0, gapless), ``id`` and ``words`` of each turn; ``convs`` all ``conv``, those
    without turns included. Each distinct sequence of the first d turn ids is a node at depth d, from the root (d = 0);
    conversations that start with it are its members. A table without conversations gives no node, not even a root.

    - ``conv_id``: the smallest member; ``depth``; ``parent_conv_id``: the parent's ``conv_id``, null for the root
    - ``n_convs``: members; ``n_children``: children; ``n_leaves``: nodes without children in its subtree, itself included
    - ``saved_tokens``: summed over its subtree, (n_convs - 1) x words of each node's last turn
    - ``ends_sha256``: hash of the ids of the members that end here, ascending, joined by commas

    Sums over subtrees need no rounds from the leaves up: a node's worth is given to its smallest member, so a subtree
    holds what all its members were given, less what the node's own smallest member was given above it. That is a
    second ROLLUP over the same blocks. Nothing reaches the driver but the number of nodes.
    """
    spark = rows.sparkSession
    keyed = rows.withColumns({"x1": _turn_key(1, F.col("pos"), F.col("id")), "x2": _turn_key(2, F.col("pos"), F.col("id"))})
    blocks = stored(_blocks(keyed))
    ends = convs.join(
        keyed.groupBy("conv").agg(F.count("*").alias("depth"), F.bit_xor("x1").alias("k1"), F.bit_xor("x2").alias("k2")),
        "conv", "left",
    ).na.fill(0, NODE)

    columns = ", ".join(f"t{i}" for i in range(1, WIDTH + 1))
    rolled = spark.sql(
        f"""SELECT block, p1, p2, {columns}, {WIDTH} - bit_count(grouping_id()) AS level, count(*) AS n_convs, min(conv) AS conv
        FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP({columns})""", blocks=blocks,
    )
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).filter("n_convs > 0").select(
        "conv", "n_convs", F.lit(0).cast("bigint").alias("words"), *(F.lit(0).cast("bigint").alias(k) for k in NODE),
        *(F.lit(None).cast("bigint").alias(k) for k in ("up1", "up2")),
    )
    nodes = stored(_nodes(rolled, ["conv", "n_convs"]).unionByName(root))

    up = [(F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2")]
    children = nodes.filter("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    full = nodes.join(children, NODE, "left").na.fill(0, ["n_children"])
    full = stored(full.withColumns({
        "leaf": (F.col("n_children") == 0).cast("bigint"), "saved": (F.col("n_convs") - 1) * F.col("words"),
    }))

    given = full.groupBy("conv").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("worth"))
    rolled = spark.sql(
        f"""SELECT block, p1, p2, {columns}, {WIDTH} - bit_count(grouping_id()) AS level, sum(leaves) AS leaves, sum(worth) AS worth
        FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP({columns})""",
        blocks=_with_given(blocks, given),
    )
    whole = given.agg(F.sum("leaves").alias("leaves"), F.sum("worth").alias("worth")).filter("leaves IS NOT NULL").select(
        "leaves", "worth", *(F.lit(0).cast("bigint").alias(k) for k in NODE)
    )
    sums = _nodes(rolled, ["leaves", "worth"]).select("leaves", "worth", *NODE).union(whole)
    above = _before(full.select("conv", "saved", *NODE), "depth", {"above": ("saved", F.sum)})

    found = full.join(sums, NODE).join(above.select(*NODE, "above"), NODE).join(_ends_hashed(ends), NODE, "left")
    return _with_parents(stored(found), nodes.count()).select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        (F.col("worth") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def _turn_key(seed: int, pos: Column, id: Column) -> Column:
    """A prefix's key is the exclusive or of its turns' keys, which depend on the place: 128 bits in two longs.

    Exclusive or can be summed in any order, so neither a prefix's key nor a conversation's needs its turns in one task.
    """
    return F.xxhash64(F.lit(seed), pos, id)


def _before(rows: DataFrame, at: str, sums: dict[str, tuple[str, object]]) -> DataFrame:
    """``rows`` with running sums over the earlier rows of their ``conv``, in order of ``at``, itself left out.

    Rows of a span of ``at`` are summed in order in one task, spans by their own sums; no task orders a conversation.
    """
    span = F.floor(F.col(at) / SPAN)
    totals = rows.groupBy("conv", span.alias("span")).agg(*(how(value).alias(name) for name, (value, how) in sums.items()))
    spans = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("conv", "span").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("conv", "span", *(
        F.coalesce(how(name).over(spans), F.lit(0)).alias(f"{name}_offset") for name, (_, how) in sums.items()
    ))
    joined = rows.withColumn("span", span).join(offsets, ["conv", "span"])
    for name, (value, how) in sums.items():
        here, offset = F.coalesce(how(value).over(inner), F.lit(0)), F.col(f"{name}_offset")
        joined = joined.withColumn(name, offset.bitwiseXOR(here) if how is F.bit_xor else offset + here)
    return joined.drop("span", *(f"{name}_offset" for name in sums))


def _blocks(keyed: DataFrame) -> DataFrame:
    """``conv``, ``block``, ``t1`` to ``t8`` (null behind the last turn) and ``p1``, ``p2``, the key of what comes before."""
    at = F.floor(F.col("pos") / WIDTH)
    turn = F.struct("pos", "id", "words")
    held = keyed.groupBy("conv", at.alias("block")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")
    )
    held = _before(held, "block", {"p1": ("x1", F.bit_xor), "p2": ("x2", F.bit_xor)})
    columns = [F.get("turns", F.lit(i)) for i in range(WIDTH)]
    return held.select("conv", "block", "p1", "p2", *(
        F.when(c.isNotNull(), F.struct(c["id"].alias("id"), c["words"].alias("words"))).alias(f"t{i + 1}")
        for i, c in enumerate(columns)
    ))


def _nodes(rolled: DataFrame, values: list[str]) -> DataFrame:
    """The prefixes of a ROLLUP: ``values``, ``words`` of the last turn, the node's key and its parent's.

    Level 0 is the node of the prior block, which is there already; a level behind a conversation's end is none.
    """
    turns = [F.col(f"t{i + 1}") for i in range(WIDTH)]
    last = F.get(F.array(*turns), F.col("level") - 1)
    found = rolled.filter(F.col("level") > 0).withColumn("last", last).filter("last IS NOT NULL")

    def key(seed: int, levels: Column) -> Column:
        made = F.col(f"p{seed}")
        for i, t in enumerate(turns):
            one = _turn_key(seed, F.col("block") * WIDTH + i, t["id"])
            made = made.bitwiseXOR(F.when(levels > i, one).otherwise(F.lit(0)))
        return made

    return found.select(
        *values, F.col("last.words").alias("words"), (F.col("block") * WIDTH + F.col("level")).cast("bigint").alias("depth"),
        key(1, F.col("level")).alias("k1"), key(2, F.col("level")).alias("k2"),
        key(1, F.col("level") - 1).alias("up1"), key(2, F.col("level") - 1).alias("up2"),
    )


def _with_given(blocks: DataFrame, given: DataFrame) -> DataFrame:
    """Blocks with what their conversation was given; joined by spans, so that a long conversation is not one key."""
    span = F.floor(F.col("block") / SPAN)
    spans = blocks.select("conv", span.alias("span")).distinct().join(given, "conv", "left").na.fill(0, ["leaves", "worth"])
    return blocks.withColumn("span", span).join(spans, ["conv", "span"]).drop("span")


def _ends_hashed(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` of each node where conversations end.

    Ids are joined in ranges of 256, which bounds a row; a node's ranges are then hashed one after another as they are
    read in order. A hash has one task per node by its nature, but that task holds one batch of rows.
    """
    chunk = F.shiftright("conv", CHUNK_BITS).alias("chunk")
    texts = ends.groupBy(*NODE, chunk).agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, None
        for batch in batches:
            done = []
            for *node, ids in batch[[*NODE, "ids"]].itertuples(index=False, name=None):
                if node != now:
                    if now:
                        done.append((*now, digest.hexdigest()))
                    now, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
        if now:
            yield pd.DataFrame([(*now, digest.hexdigest())], columns=[*NODE, "ends_sha256"])

    ordered = texts.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").select(*NODE, "ids")
    return ordered.mapInPandas(hashed, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def _with_parents(nodes: DataFrame, count: int) -> DataFrame:
    """``nodes`` with ``parent_conv_id``. Parents with a thousandth of all nodes as children, of which there can be a
    thousand at most, are broadcast; the others are joined by key."""
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"),
        F.col("conv").alias("parent_conv_id"), "n_children",
    )
    key = ["depth", "up1", "up2"]
    many = max(1000, count // 1000)
    hot = F.broadcast(parents.filter(F.col("n_children") >= many).drop("n_children"))
    rest = parents.filter((F.col("n_children") > 0) & (F.col("n_children") < many)).drop("n_children")
    return nodes.join(hot, key).unionByName(
        nodes.join(hot, key, "left_anti").join(rest, key, "left")
    )
