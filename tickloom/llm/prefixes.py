"""Prefix trie of conversations by halving: name cut prefixes, build both halves, graft totals upward.

A trie of depth 2^k is cut at half its depth. The prefixes that end at the cut are named (by the
smallest conversation that has them); above it lies one upper trie, below it a forest with one lower
trie per name. All tries of one height are cut in the same few joins, so a depth of d takes about
log2 d rounds, whatever the number of tries. Totals come back the same way: each lower trie's total is
grafted onto the path from its name to the top of the upper trie, height by height.

What is compared at a cut is the digest of half a trie's turns, folded from pairs of halves, so no
conversation is gathered in one row. A turn's digest has 128 bits; turns of equal digest are taken as
equal. Conversations with the same turns throughout are one, with a weight, before the first cut.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import checked_join
from ..plans.series import numbered
from .common import written

# Conversations are sent to the hash of a node in rows of the ids of one such range.
ENDS_RANGE = 1 << 14
NOTHING = hashlib.sha256(b"").hexdigest()


def _digest(*columns) -> list:
    return [F.xxhash64(F.lit(seed), *columns).alias(f"h{seed}") for seed in (1, 2)]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq, h1, h2, chars): turns by number, null first, ties by digest; seq counts from 0.

    Null role and text are empty; rows without conv_id are left out. One conversation may hold many of
    the rows: they are dealt out in order and numbered slice by slice.
    """
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *_digest(F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("nth"),
    )
    order = ["turn", "h1", "h2", "nth"]
    dealt = turns.repartitionByRange("conv_id", *order).withColumn("slice", F.spark_partition_id())
    dealt = written(dealt, "turns")
    return numbered(dealt, ["conv_id"], "slice", [F.col(c) for c in order]).select(
        "conv_id", "seq", "h1", "h2", "chars"
    )


def spliced(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(convs, rows): conversation c opens with the first h turns of conversation c - c % ``group``
    (all if fewer, none if absent) and goes on after its own first h; h = crc32(c) % ``most``.
    ``turns`` is a written table of ``ordered_turns``."""
    lengths = written(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "lengths")
    base = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = lengths.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn(
        "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    )
    # A base has at most ``group`` conversations, so its key cannot be hot.
    convs = convs.join(base, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("base_n", F.lit(0)))
    )
    convs = written(convs.select("conv_id", "base", "h", "taken"), "spliced")
    own = checked_join(turns, convs, ["conv_id"], spread=["seq"])
    own = own.where("seq >= h").withColumn("seq", F.col("seq") - F.col("h") + F.col("taken"))
    first = turns.where(F.col("seq") < most - 1).withColumnRenamed("conv_id", "base")
    lent = convs.join(first, "base").where("seq < taken")
    columns = ["conv_id", "seq", "h1", "h2", "chars"]
    return convs.select("conv_id"), own.select(columns).unionByName(lent.select(columns))


def folded(blocks: DataFrame) -> DataFrame:
    """Blocks of twice the length: each is digested from its two halves (the second may be missing)."""
    even = F.col("block") % 2 == 0
    halves = blocks.groupBy("conv_id", F.shiftright("block", 1).alias("block")).agg(
        *(F.max(F.when(even, F.col(c))).alias(f"l{c}") for c in ("h1", "h2")),
        *(F.max(F.when(~even, F.col(c))).alias(f"r{c}") for c in ("h1", "h2")),
        F.sum("size").alias("size"),
    )
    return halves.select("conv_id", "block", *_digest("lh1", "lh2", "rh1", "rh2"), "size")


def _named(rows: DataFrame, *sums) -> tuple[DataFrame, DataFrame]:
    """Prefixes that end with the block of ``rows``: (one row per prefix, rows with its name)."""
    keys = ["block", "top", "h1", "h2"]
    names = written(
        rows.groupBy(*keys).agg(F.min("conv_id").alias("name"), *sums), "prefix-names"
    )
    return names, checked_join(rows, names.select(*keys, "name"), keys, spread=["conv_id"])


def paths(levels: list[DataFrame], weights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cut from the whole depth down to single turns: (nodes, path).

    ``levels[k]`` are the blocks of 2^k turns of the conversations in ``weights`` (conv_id, n).
    nodes: depth, name, parent, n_convs, chars. path: conv_id, depth, name, parent, for every turn.
    ``top`` is the name of the prefix before a block, -1 with depth 0 for the empty one.
    """
    tries = written(
        weights.select("conv_id", F.lit(0).cast("long").alias("block"), F.lit(-1).cast("long").alias("top"), "n"),
        "tries",
    )
    for k in reversed(range(len(levels) - 1)):
        halves = levels[k].withColumn("trie", F.shiftright("block", 1))
        halves = written(
            halves.join(tries.withColumnRenamed("block", "trie"), ["conv_id", "trie"]), "halves"
        )
        upper = halves.where("block % 2 = 0")
        _, cut = _named(upper.where(F.col("size") == 1 << k))
        below = cut.select("conv_id", "trie", F.col("name").alias("_name"))
        lower = halves.where("block % 2 = 1").join(below, ["conv_id", "trie"])
        columns = ["conv_id", "block", "top", "n"]
        tries = written(
            upper.select(columns).unionByName(
                lower.select("conv_id", "block", F.col("_name").alias("top"), "n")
            ),
            "tries",
        )
    turns = levels[0].join(tries, ["conv_id", "block"])
    nodes, path = _named(
        written(turns, "trie-turns"), F.sum("n").alias("n_convs"), F.max("chars").alias("chars")
    )
    depth = (F.col("block") + 1).alias("depth")
    nodes = nodes.select(depth, "name", F.col("top").alias("parent"), "n_convs", "chars")
    path = path.select("conv_id", depth, "name", F.col("top").alias("parent"))
    return written(nodes, "nodes"), written(path, "paths")


def grafted(own: DataFrame, path: DataFrame, heights: int, sums: list[str]) -> DataFrame:
    """(depth, name, sums): ``own`` values of all nodes summed over their subtrees, 2^heights deep.

    At each height the total of a lower trie goes to every node on the path from its name to the top
    of the upper trie; the path is read off the conversation that gave the name.
    """
    gains = [own.select("depth", "name", "parent", *sums)]
    for k in range(1, heights + 1):
        half, seq = 1 << (k - 1), F.col("depth") - 1
        all_gains = gains[0]
        for more in gains[1:]:
            all_gains = all_gains.unionByName(more)
        lower = all_gains.where((seq % (2 * half) == half)).groupBy(
            F.shiftright(seq, k).alias("trie"), F.col("parent").alias("conv_id")
        )
        lower = written(lower.agg(*(F.sum(c).alias(c) for c in sums)), "lower-totals")
        upper = path.withColumn("trie", F.shiftright(seq, k)).where(seq % (2 * half) < half)
        added = checked_join(upper, lower, ["trie", "conv_id"], spread=["depth"])
        added = added.groupBy("depth", "name", "parent").agg(*(F.sum(c).alias(c) for c in sums))
        gains.append(written(added, "grafts"))
    total = gains[0]
    for more in gains[1:]:
        total = total.unionByName(more)
    return total.groupBy("depth", "name").agg(*(F.sum(c).alias(c) for c in sums))


def ids_sha256(members: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256): hash of each node's conv_ids, ascending, comma-joined.

    Ids come in sorted runs of a bounded range, and a node's runs go through the hash one by one. The
    hash of one node is by nature one sequence; nothing of it is held but its state.
    """
    runs = members.groupBy("depth", "name", F.floor(F.col("conv_id") / ENDS_RANGE).alias("run")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    runs = runs.repartition("depth", "name").sortWithinPartitions("depth", "name", "run")

    def digest(batches):
        node, state = None, None

        def row():
            return pa.RecordBatch.from_pydict(
                {"depth": [node[0]], "name": [node[1]], "ends_sha256": [state.hexdigest()]}
            )

        for batch in batches:
            done = {"depth": [], "name": [], "ends_sha256": []}
            for depth, name, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (depth, name) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        for c, x in zip(done.values(), (*node, state.hexdigest()), strict=True):
                            c.append(x)
                    node, state = (depth, name), hashlib.sha256()
                state.update(ids.encode())
            if done["depth"]:
                yield pa.RecordBatch.from_pydict(done)
        if node is not None:
            yield row()

    return runs.select("depth", "name", "ids").mapInArrow(
        digest, "depth long, name long, ends_sha256 string"
    )


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations, the empty one (depth 0) included.

    ``convs`` (conv_id, each once) names all conversations, also those without turns; ``turns`` has
    conv_id, seq (0, 1, ... without gaps), h1, h2 (digest) and chars of each turn. Returned: conv_id
    (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, members less one times chars), ends_sha256 (of the members that
    end here). No conversations, no rows.
    """
    convs = written(convs, "conversations")
    first = turns.select("conv_id", F.col("seq").alias("block"), "h1", "h2", F.lit(1).cast("long").alias("size"), "chars")
    first = written(first, "blocks")
    depth = (first.agg(F.max("block")).first()[0] or 0) + 1
    levels = [first]
    while 1 << (len(levels) - 1) < depth:
        levels.append(written(folded(levels[-1].select("conv_id", "block", "h1", "h2", "size")), "blocks"))
    same = levels[-1].groupBy("h1", "h2", "size").agg(
        F.min("conv_id").alias("like"), F.count(F.lit(1)).alias("n")
    )
    same = written(same, "distinct-conversations")
    like = written(
        checked_join(levels[-1], same, ["h1", "h2", "size"], spread=["conv_id"]).select(
            "conv_id", "like", F.col("size").alias("depth")
        ),
        "likenesses",
    )
    weights = same.select(F.col("like").alias("conv_id"), "n")
    if len(levels) > 1:
        levels = [
            written(checked_join(x, weights.select("conv_id"), ["conv_id"], "left_semi", spread=["block"]), "blocks")
            for x in levels[:-1]
        ] + levels[-1:]
    else:
        levels = [levels[0].join(weights.select("conv_id"), "conv_id", "left_semi")]
    nodes, path = paths(levels, weights)

    children = nodes.groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    own = nodes.join(children, ["depth", "name"], "left").select(
        "depth", "name", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    own = written(own, "own-values")
    sums = ["n_leaves", "saved_tokens"]
    total = written(grafted(own, path, len(levels) - 1, sums), "totals")

    ends = path.select(F.col("conv_id").alias("like"), "depth", "name")
    ends = checked_join(like, ends, ["like", "depth"], spread=["conv_id"])
    bare = convs.join(like.select("conv_id"), "conv_id", "left_anti")
    root_name = F.lit(-1).cast("long")
    ends = ends.select("depth", "name", "conv_id").unionByName(
        bare.select(F.lit(0).cast("long").alias("depth"), root_name.alias("name"), "conv_id")
    )
    hashes = written(ids_sha256(ends), "ends")

    least, n_convs = convs.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    least = F.lit(least).cast("long")
    kept = own.drop(*sums).join(total, ["depth", "name"]).withColumn("least", F.col("name"))
    top = total.where("depth = 1").agg(
        F.count(F.lit(1)).alias("n_children"),
        F.greatest(F.lit(1), F.coalesce(F.sum("n_leaves"), F.lit(0))).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"),
    )
    top = top.where(F.lit(n_convs > 0)).select(
        F.lit(0).cast("long").alias("depth"), root_name.alias("name"), least.alias("least"),
        F.lit(None).cast("long").alias("parent"), F.lit(n_convs).cast("long").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens",
    )
    return kept.unionByName(top).join(hashes, ["depth", "name"], "left").select(
        F.col("least").alias("conv_id"), "depth",
        F.when(F.col("depth") == 1, least).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )
