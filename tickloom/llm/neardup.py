"""Near-duplicate documents: DartMinHash signatures, banded joining, exact check, classes.

Texts are sets of five-word shingles (a shorter text is one shingle of all its words). In weighted sets
a shingle that occurs n times weighs 1 + ln n, so that a phrase repeated for pages does not outweigh the
rest. Texts with equal sets are one node from the start, so exact copies cost one row each. Nodes that
share a band of their signatures are candidates. The first steps compare every node of a bucket with at
most two others of it:

1. with the best centre of all its buckets (the node that meets most others),
2. with the centre of each bucket, where those are still in different classes,
3. in buckets that still hold several classes, and then in ever other parts of them that also share a
   second band: with one node of the bucket's largest class and one of the largest other class.

Then come all other candidates: every two nodes of a bucket that are still in different classes. They are
not joined: a bucket is cut into blocks, and a task goes through two blocks at a time and rules out the
pairs that cannot be similar by weights that are summed in cells of the shingles' hashes. Only pairs that
this bound leaves open become rows.

Each comparison is exact, on whole texts: a link is a Jaccard similarity of at least the limit. After
each step the classes are the connected components of the links so far, so a bucket that became one class
is never looked at again. In the end every candidate is in one class, compared, or ruled out by a bound.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import checked_join, fits_broadcast
from .common import per_text, small_batches, written, written_at
from .dart import bands, distinct, signatures
from .words import Words, mix

SHINGLE, SIMILAR = 5, 0.8
# At a similarity of 0.8 a pair shares no band with a chance of 0.0005.
BANDS, ROWS = 32, 7
# Narrowed buckets that mixed ones are looked at in, one after the other: with themselves, then with
# the band so many places further on.
STEPS = (0, 1, 3)
# Weights of a text are summed in so many cells; nodes of a bucket that are held together.
CELLS, COARSE, BLOCK = 256, 32, 4096

SIGNED = "k1 long, k2 long, size double, bands array<long>"


def weights_of(n: np.ndarray) -> np.ndarray:
    return 1 + np.log(n)


def may_be(similar: float, size, other):
    """Sets of such weights can be ``similar``."""
    return (size >= similar * other) & (other >= similar * size)


def shingles(texts: pa.Array, k: int = SHINGLE):
    """(text number, hash, occurrences) of the distinct shingles of all texts, by text."""
    words = Words(texts)
    grams, inside = words.grams(k)
    owner = words.texts()
    at = np.flatnonzero(inside)
    hashes, owners = grams[at], owner[at]
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    if len(short):
        whole = np.array(
            [np.bitwise_xor.reduce(mix(words.hash[words.first[d] : words.first[d + 1]]
                                       + np.arange(1, words.count[d] + 1, dtype=np.uint64)))
             for d in short], np.uint64,
        )
        hashes, owners = np.append(hashes, whole), np.append(owners, short)
        order = np.argsort(owners, kind="stable")
        hashes, owners = hashes[order], owners[order]
    first, n = distinct(owners, hashes)
    return owners[first], hashes[first], n


def _sums(owner, values, count):
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    edge = np.searchsorted(owner, np.arange(count + 1))
    return (total[edge[1:]] - total[edge[:-1]]).view(np.int64)


def sign(texts: pa.Array, weighted: bool, n_bands: int = BANDS, rows: int = ROWS):
    owner, hashes, n = shingles(texts)
    count = len(texts)
    weights = weights_of(n) if weighted else None
    keys = hashes if not weighted else hashes + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    k1, k2 = (_sums(owner, mix(mix(keys) + np.uint64(s)), count) for s in (1, 2))
    size = np.bincount(owner, weights=weights, minlength=count).astype(np.float64)
    made = bands(signatures(owner, hashes, weights, count, n_bands * rows), rows)
    made = pa.FixedSizeListArray.from_arrays(pa.array(made.ravel()), n_bands).cast(pa.list_(pa.int64()))
    return [pa.array(k1), pa.array(k2), pa.array(size), made]


def cell_sums(texts: pa.Array, weighted: bool) -> pa.Array:
    """Weights of each text's shingles summed in cells of their hashes, as half floats rounded up."""
    owner, hashes, n = shingles(texts)
    weights = weights_of(n) if weighted else None
    at = owner * CELLS + (mix(hashes) >> np.uint64(32)).astype(np.int64) % CELLS
    sums = np.bincount(at, weights=weights, minlength=len(texts) * CELLS).astype(np.float64)
    with np.errstate(over="ignore"):
        half = sums.astype(np.float16)
    half = np.where(half < sums, np.nextafter(half, np.float16(np.inf)), half)
    return pa.array([row.tobytes() for row in half.reshape(len(texts), CELLS)], pa.binary())


def open_pairs(root, block, cells, similar: float):
    """Places (i, j) of nodes of different classes and, if there are two blocks, of different blocks that
    the bound by cells leaves open: shared weight is at most the smaller sum of each cell."""
    order = np.argsort(cells.sum(1), kind="stable")
    root, block, cells = root[order], block[order], cells[order]
    coarse, size = cells.reshape(len(cells), COARSE, -1).sum(2), cells.sum(1)
    across = block.min() < block.max()
    # Sums were rounded up by a thousandth at most.
    last = np.searchsorted(size * (similar - 0.002), size, side="right")
    for i in range(len(order) - 1):
        test = root[i + 1 : last[i]] != root[i]
        if across:
            test &= block[i + 1 : last[i]] != block[i]
        j = np.flatnonzero(test) + i + 1
        for sums in (coarse, cells):
            shared = np.minimum(sums[j], sums[i]).sum(1)
            j = j[shared * (1 + similar) >= (similar - 0.002) * (size[i] + size[j])]
        if len(j):
            yield order[i], order[j]


def compare(left: list[str], right: list[str], weighted: bool) -> np.ndarray:
    """Jaccard similarity of each pair of texts, of plain or of weighted shingle sets."""
    unique = {t: i for i, t in enumerate(dict.fromkeys([*left, *right]))}
    owner, hashes, n = shingles(pa.array(list(unique), pa.string()))
    edge = np.searchsorted(owner, np.arange(len(unique) + 1))
    out = np.zeros(len(left))
    sets = {}

    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        for t in (a, b):
            if t not in sets:
                s = slice(edge[unique[t]], edge[unique[t] + 1])
                order = np.argsort(hashes[s])
                sets[t] = hashes[s][order], (weights_of(n[s][order]) if weighted else np.ones(len(order)))
        (ha, wa), (hb, wb) = sets[a], sets[b]
        if len(ha) and len(hb):
            at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
            same = hb[at] == ha
            shared = np.minimum(wa[same], wb[at[same]]).sum()
            out[i] = shared / (wa.sum() + wb.sum() - shared)
    return out


def verified(pairs: DataFrame, texts: DataFrame, similar: float, weighted: bool) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are at least ``similar``.

    ``a`` may be hot (the centre of large buckets), so its rows are split; a node is ``b`` of one
    pair per band in the first two rounds.
    """
    small_batches(pairs.sparkSession)
    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    names = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    hot = written(
        pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 64")
        .select("a", F.ceil(F.col("n") / 64).cast("int").alias("parts")),
        "hot-nodes",
    )
    if fits_broadcast(hot):
        hot = F.broadcast(hot)
    both = both.join(hot, "a", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")), F.lit(0)).cast("int")
    )
    names = names.join(hot, "a", "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts") - 1, F.lit(0))))
    )
    both = both.drop("parts").join(names.drop("parts"), ["a", "part"])

    def check(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                similarity = compare(part.column(2).to_pylist(), part.column(3).to_pylist(), weighted)
                yield part.select([0, 1]).filter(pa.array(similarity >= similar))

    return both.select("a", "b", "a_text", "b_text").mapInArrow(check, "a long, b long")


def relabelled(rows: DataFrame, labels: DataFrame, columns, **bounds) -> DataFrame:
    """Replace node columns by their class; nodes without a row in ``labels`` are their own.

    ``bounds`` on the rows of ``labels`` (at_most) and of ``rows`` save the join their counts."""
    for c in columns:
        rows = checked_join(
            rows, labels.select(F.col("node").alias(c), F.col("root").alias("_root")), [c], "left",
            spread=rows.columns, **bounds,
        )
        rows = rows.withColumn(c, F.coalesce("_root", c)).drop("_root")
    return rows


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, root): root is the smallest node of the connected component.

    ``labels`` are classes known before.
    """
    return grown(links, labels)[0]


def grown(links: DataFrame, labels: DataFrame | None = None, most: int | None = None):
    """``components`` and a bound on its rows; ``most`` is one on the rows of ``labels``.

    Roots hook onto their smallest neighbour class, then paths are halved; both repeat until no link
    joins two classes. Each step is a join on written tables. A node hooks once in a round, so the
    links that are left bound the hooks, and no table but the links is counted: each Spark job costs
    the driver memory, however small its table.
    """
    spark = links.sparkSession
    if labels is None:
        labels, most = spark.createDataFrame([], "node long, root long"), 0
    elif most is None:
        most = labels.count()
    while True:
        links = written(
            relabelled(links, labels, ["a", "b"], at_most=most).where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "links",
        )
        left = links.count()
        if not left:
            return labels, most
        hooks = written(
            links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "hooks"
        )
        while True:  # shorten until every hook points at a root
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("_up"))
            longer = checked_join(
                hooks, up, ["root"], "left", spread=["node"], at_most=left, big_at_most=left
            )
            longer = written(
                longer.select("node", F.coalesce("_up", "root").alias("root"), F.col("_up").alias("_moved")),
                "hooks",
            )
            hooks = longer.select("node", "root")
            if longer.where("_moved is not null").isEmpty():
                break
        known = relabelled(labels, hooks, ["root"], at_most=left, big_at_most=most)
        labels = written(
            known.select("node", "root").unionByName(
                hooks.join(labels.select("node"), "node", "left_anti")
            ),
            "labels",
        )
        most += left


def untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that ``tried`` has neither way round."""
    ends = [F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")]
    return pairs.select("a", "b", *ends).join(tried.select(*ends), ["lo", "hi"], "left_anti").select("a", "b")


def mixed_rows(shared: DataFrame, labels: DataFrame, most: int):
    """Rows (bucket, node, root) of the buckets that hold several classes, None where there are none.

    ``most`` bounds the rows of ``labels``."""
    now = shared.select("bucket", "b", F.col("b").alias("root"))
    now = relabelled(now, labels, ["root"], at_most=most)
    mixed = now.groupBy("bucket").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    mixed = written(mixed.where("lo <> hi").select("bucket", "n"), "mixed-buckets")
    several = mixed.count()
    if not several:
        return None
    inside = checked_join(now, mixed, ["bucket"], spread=["b"], at_most=several)
    return inside.select("bucket", F.col("b").alias("node"), "root", "n")


def rest_pairs(shared: DataFrame, texts: DataFrame, labels: DataFrame, most: int, similar: float, weighted: bool):
    """All pairs (a, b) of nodes of different classes that share a bucket and may be similar, None where
    no bucket holds several classes. A bucket of more than ``BLOCK`` nodes is cut into blocks by a hash,
    and each two of its blocks are gone through apart, so no group is larger than about two blocks."""
    inside = mixed_rows(shared, labels, most)
    if inside is None:
        return None
    inside = written(inside, "mixed-rows")
    who = written(inside.select("node").distinct(), "rest-nodes")
    named = checked_join(texts, who, ["node"], "left_semi", spread=["text"])
    sums = written(
        per_text(named, "cells binary", lambda t: [cell_sums(t, weighted)], ("node",)), "cell-sums"
    )
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), parts).cast("int")
    inside = inside.select("bucket", "node", "root", block.alias("block"), parts.alias("parts"))
    inside = checked_join(inside, sums, ["node"], spread=["bucket"])
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = inside.withColumn("other", other).select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "node", "root", "block", "cells",
    )
    # Two blocks meet once; a block meets itself in a group of its own.
    key = ["bucket", "i", "j"]
    rows = rows.repartition(*key).sortWithinPartitions(*key)

    def groups(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            keys = np.stack([table.column(c).to_numpy() for c in key], 1)
            edge = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            last = edge[-1] if len(edge) else 0
            yield from (table.slice(a, b - a) for a, b in zip([0, *edge[:-1]], edge, strict=False))
            held = table.slice(last)
        if held is not None and held.num_rows:
            yield held

    def find(batches):
        for group in groups(batches):
            node, root, own = (group.column(c).to_numpy() for c in ("node", "root", "block"))
            if (root == root[0]).all():
                continue
            cells = np.frombuffer(b"".join(group.column("cells").to_pylist()), np.float16)
            cells = cells.reshape(len(node), CELLS).astype(np.float32)
            for i, j in open_pairs(root, own, cells, similar):
                a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return rows.mapInArrow(find, "a long, b long").distinct()


def crowd_pairs(shared: DataFrame, node: DataFrame, labels: DataFrame, most: int, similar: float, step: int):
    """Pairs (a, b) for the nodes that share a bucket with another class, None where there are none.

    Buckets are narrowed to those who also share the band ``step`` further on (0: not narrowed). There
    every node outside the largest class is compared with that class's representative, and with that of
    the largest class among the others. Twice as many pairs as rows of buckets at most.
    """
    inside = mixed_rows(shared, labels, most)
    if inside is None:
        return None
    who = written(inside.select("node", "root").distinct(), "mixed-nodes")
    bands = checked_join(node.select("node", "size", "bands"), who, ["node"], spread=["size"])
    key = F.col("x.first")
    if step:
        key = F.xxhash64(key, "x.second")
        further = F.concat(F.slice("bands", step + 1, F.size("bands")), F.slice("bands", 1, step))
    else:
        further = F.col("bands")
    both = F.arrays_zip(F.col("bands").alias("first"), further.alias("second"))
    rows = bands.select("node", "size", "root", F.explode(both).alias("x")).select(
        "node", "size", "root", key.alias("key")
    )
    rows = written(rows, "narrow-buckets")
    # A class's representative changes with the bucket, so that other buckets try other nodes.
    order = F.struct(F.xxhash64("key", "node").alias("o"), "node", "size")
    classes = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.max(order).alias("r"))
    best = F.max(F.struct("n", "root", "r")).alias("c")
    first = classes.groupBy("key").agg(best, F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    first = written(first, "largest-classes")
    keys = first.count()
    others = checked_join(rows, first, ["key"], spread=["node"], at_most=keys)
    others = written(others.where(F.col("root") != F.col("c.root")), "others")
    again = others.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.max(order).alias("r"))
    second = again.groupBy("key").agg(best, F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    second = checked_join(
        others.drop("c"), written(second, "second-classes"), ["key"], spread=["node"], at_most=keys
    ).where(F.col("root") != F.col("c.root"))
    near = may_be(similar, F.col("size"), F.col("c.r.size"))
    both = others.unionByName(second).where(near)
    return both.select(F.col("c.r.node").alias("a"), F.col("node").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, similar: float = SIMILAR, weighted: bool = False, n_bands=BANDS, rows=ROWS
):
    """(classes, links): one row per row of ``docs`` with doc_id, class_id (the smallest doc_id of
    its class) and node (that of its equal texts); the links found between nodes.

    ``weighted`` weighs shingles by occurrences; else all weigh one. Rows without doc_id are left out. A
    null or wordless text is a class of its own. Repeated rows get a row each; different texts under one
    doc_id share a class, compared by the smallest text. Texts of any length are taken whole. Equal
    candidates for a centre are told apart by doc_id. Extra columns are not looked at. An empty table
    gives an empty result.
    """
    small_batches(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    signed = written(
        per_text(named, SIGNED, lambda texts: sign(texts, weighted, n_bands, rows)), "signed"
    )
    worded = signed.where("size > 0")
    node = written(
        worded.groupBy("k1", "k2")
        .agg(F.min(F.struct("doc_id", "size", "bands")).alias("x"))
        .select("k1", "k2", F.col("x.doc_id").alias("node"), "x.size", "x.bands"),
        "nodes",
    )
    spread = node.select("node", "size", F.explode("bands").alias("bucket"))
    sizes = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = written(sizes, "bucket-sizes")
    buckets = sizes.count()
    shared = checked_join(spread, sizes, ["bucket"], spread=["node"], at_most=buckets)
    shared = written(shared, "shared-buckets")
    # The node that meets most others is the centre of a bucket: an original rather than a copy.
    degree = shared.groupBy("node").agg(F.sum("n").alias("degree"))
    shared = shared.join(degree, "node")
    order = F.struct("degree", (-F.col("node")).alias("minus"), "size")
    centre = written(shared.groupBy("bucket").agg(F.max(order).alias("c")), "centres")
    near = may_be(similar, F.col("size"), F.col("c.size"))
    # Rows of shared buckets: a is the centre, b each node.
    shared = written(
        checked_join(shared, centre, ["bucket"], spread=["node"], at_most=buckets).select(
            "bucket", (-F.col("c.minus")).alias("a"), F.col("c.degree").alias("a_degree"),
            F.col("node").alias("b"), near.alias("near"),
        ),
        "bucket-centres",
    )
    wanted = shared.select(F.col("b").alias("doc_id")).distinct()
    texts = written(
        checked_join(named, wanted, ["doc_id"], "left_semi", spread=["text"])
        .groupBy(F.col("doc_id").alias("node")).agg(F.min("text").alias("text")),
        "candidate-texts",
    )

    stars = shared.where("near and a <> b").select("a", "b", "a_degree").distinct()
    best = F.max(F.struct("a_degree", (-F.col("a")).alias("minus"))).alias("x")
    one = stars.groupBy("b").agg(best).select((-F.col("x.minus")).alias("a"), "b")
    tried: list[str] = []  # folders of pairs, read together in one scan

    def pairs_in(*paths):
        return docs.sparkSession.read.schema("a long, b long").parquet(*paths)

    def compared(pairs):
        tried.append(written_at(pairs, "pairs"))
        return written(verified(pairs_in(tried[-1]), texts, similar, weighted), "found")

    links = compared(one)
    labels, most = grown(links)

    cross = stars.select("a", "b", "a", "b").toDF("a", "b", "x", "y")
    cross = relabelled(cross, labels, ["x", "y"], at_most=most).where("x <> y").select("a", "b")
    found = compared(untried(cross, pairs_in(*tried)))
    links, (labels, most) = links.unionByName(found), grown(found, labels, most)

    for step in [*STEPS, None]:
        if step is None:
            pairs = rest_pairs(shared, texts, labels, most, similar, weighted)
        else:
            pairs = crowd_pairs(shared, node, labels, most, similar, step)
        if pairs is None:
            break
        found = compared(untried(pairs, pairs_in(*tried)))
        links, (labels, most) = links.unionByName(found), grown(found, labels, most)

    owner = node.select("k1", "k2", "node", F.col("node").alias("class_id"))
    owner = relabelled(owner, labels, ["class_id"], at_most=most)
    owner = written(owner, "classes")
    alone = signed.where("size = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("node")
    )
    classes = worded.select("doc_id", "k1", "k2").join(owner, ["k1", "k2"])
    return classes.select("doc_id", "class_id", "node").unionByName(alone), links
