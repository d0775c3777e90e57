"""Cross-tokenizer alignment: which tokens of two tokenizers overlap, and how often pairs do so.

Both token sequences of a text cut the same bytes. Merging their ends gives intervals, each inside one
token of either side: these are the links. Ends that both have close a group. The texts are encoded
once and the ids written; both passes align from those.

First pass: every task sums up its distinct (id, id) pairs by documents, in buckets of a hash. Buckets
are summed in a tree of groups of tasks: sorted pairs at the leaves; the distinct pairs of a bucket get
a minimal perfect hash, and above the leaves the counts are dense vectors indexed by it. The pair
stands beside its count, so that a look-up is verified. Second pass: documents are aligned again and
their pairs looked up, in the whole table where its size allows a broadcast, else bucket by bucket.
"""

import functools
import os
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import flat, pieces, small_batches, utf8, written
from .perfect import PerfectHash, bit_levels, packed, unpacked
from .words import mix

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

BUCKET_BITS = 8
# Groups of tasks summed into one at each step of the tree.
FAN_IN = 32
# Distinct pairs up to which the table is broadcast: 13 bytes a pair with 32-bit keys, 104 MB.
BROADCAST_PAIRS = 8_000_000
# Bytes of ids aligned at a time.
ALIGN_BYTES = 1 << 22
# Pairs (one row per document and pair) a task holds before it sums them up.
HELD_PAIRS = 2_000_000
# Distinct pieces of text a worker remembers, in two generations of half as many.
REMEMBERED = 400_000

# Texts of these characters only are cut into pieces that either tokenizer encodes one by one.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_OTHER_TEXT = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ]").search
_A_PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\\s{_LETTER}0-9]+|\\s+(?!\\S)|\\s+"
).findall
# No entry of B spans a space after another character, and line ends and tabs are bytes of their own.
_B_PIECES = re.compile("[\n\t]| +[^ \n\t]*|[^ \n\t]+").findall


def _byte_of() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 characters stand for themselves, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _raw(ids: list[int]) -> bytes:
    return np.array(ids, "<u2").tobytes()


class _Side:
    """One tokenizer: ``entries`` (bytes of each id), ``whole`` (16-bit ids of whole texts), and
    ``encode``, which asks for each distinct piece of plain texts once."""

    def __init__(self, cut):
        self.cut = cut
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.wrong = False  # a piece was met whose entries are not its bytes

    def bytes_of(self, ids: bytes) -> bytes:
        return b"".join(map(self.entries.__getitem__, np.frombuffer(ids, "<u2").tolist()))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED // 2:
            self.before, self.known = self.known, {}
        cuts = [self.cut(x) for x in texts]
        missing = set().union(*cuts).difference(self.known)
        for x in missing.intersection(self.before):
            self.known[x] = self.before[x]
        new = list(missing.difference(self.before))
        for x, ids in zip(new, self.learn(new), strict=True):
            self.known[x] = ids
            self.wrong |= self.bytes_of(ids) != x.encode()
        return [b"".join(map(self.known.__getitem__, cut)) for cut in cuts]


class ByteLevel(_Side):
    """Tokenizer A: a byte-level BPE file."""

    def __init__(self, path: str):
        super().__init__(_A_PIECES)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        names, byte_of = self.tokenizer.get_vocab(), _byte_of()
        self.entries = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            plain = all(c in byte_of for c in name)
            self.entries[i] = bytes(byte_of[c] for c in name) if plain else name.encode()

    def whole(self, texts: list[str]) -> list[bytes]:
        """``texts`` with the space before them."""
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_raw(e.ids) for e in made]

    learn = whole


class SpacePieces(_Side):
    """Tokenizer B: a sentencepiece file with byte fallback, which puts a space before a text."""

    def __init__(self, path: str):
        super().__init__(_B_PIECES)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = self.model.is_byte(i)
            self.entries.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
        self.space, self.skipped = _raw([self.model.piece_to_id("▁")]), len(self._ids(["\n"])[0])

    def _ids(self, texts):
        return [_raw(x) for x in self.model.encode(texts, num_threads=1)]

    def whole(self, texts: list[str]) -> list[bytes]:
        return self._ids([x[1:] for x in texts])

    def learn(self, items: list[str]) -> list[bytes]:
        """A piece without a space stands behind a line end or tab; it is encoded behind a line end."""
        spaced = [x[0] == " " for x in items]
        made = self._ids([x[1:] if s else "\n" + x for x, s in zip(items, spaced, strict=True)])
        return [(x or self.space) if s else x[self.skipped :] for x, s in zip(made, spaced, strict=True)]


@functools.lru_cache(1)
def sides(a: str, b: str) -> tuple[ByteLevel, SpacePieces]:
    found = ByteLevel(a), SpacePieces(b)
    if max(len(x.entries) for x in found) > 1 << 16:
        raise ValueError("ids of more than 16 bits")
    return found


def _encoded(texts: list[str], a: str, b: str) -> list[list[bytes]]:
    """Ids of both sides; empty where either's bytes are not a space and the text."""
    both = sides(a, b)
    out = [[b""] * len(texts) for _ in both]
    odd = [bool(x) and _OTHER_TEXT(x) is not None for x in texts]
    plain = [i for i, x in enumerate(texts) if x and not odd[i]]
    for side, ids in zip(both, out, strict=True):
        for i, x in zip(plain, side.encode([" " + texts[i] for i in plain]), strict=True):
            ids[i] = x
    checked = any(side.wrong for side in both)
    for i, x in enumerate(texts):
        if odd[i]:
            for side, ids in zip(both, out, strict=True):
                ids[i] = side.whole([" " + x])[0]
        if odd[i] or (checked and x):
            want = (" " + x).encode()
            if any(side.bytes_of(ids[i]) != want for side, ids in zip(both, out, strict=True)):
                for ids in out:
                    ids[i] = b""
    return out


def encoded(docs: DataFrame, a: str, b: str) -> DataFrame:
    """row (a number of its own for each row of ``docs``), doc_id, a, b: 16-bit ids of both
    tokenizers, empty where a text is null or empty or either's bytes are not a space and the text."""
    small_batches(docs.sparkSession)
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                made = _encoded(flat(part.column(2)).to_pylist(), a, b)
                columns = [*part.columns[:2], *(pa.array(x, pa.binary()) for x in made)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "a", "b"])

    return written(source.mapInArrow(run, "row long, doc_id long, a binary, b binary"), "both-ids")


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids back to back, and where each text's begin."""
    text = pa.large_string() if pa.types.is_large_binary(column.type) else pa.string()
    # The same buffers under a type that ``utf8`` takes; the bytes are only looked at.
    same = pa.Array.from_buffers(text, len(column), column.buffers(), offset=column.offset)
    data, at = utf8(same)
    return np.frombuffer(data.tobytes(), "<u2").astype(np.int64), at // 2


class Aligned:
    """Links of many texts at once: link i joins A's ``a[i]`` and B's ``b[i]`` in text ``doc[i]``."""

    def __init__(self, a: pa.Array, b: pa.Array, sizes_a: np.ndarray, sizes_b: np.ndarray):
        self.ids_a, at_a = _ids(a)
        self.ids_b, at_b = _ids(b)
        self.count, self.n_a, self.n_b = len(a), np.diff(at_a), np.diff(at_b)
        self.at_a, self.at_b = at_a, at_b
        end_a, end_b = np.cumsum(sizes_a[self.ids_a]), np.cumsum(sizes_b[self.ids_b])
        # Ends that both have close a group; those of B alone cut a token of A.
        place = np.searchsorted(end_a, end_b)
        self.closes_b = end_a[place] == end_b if len(end_a) else np.zeros(0, bool)
        self.closes_a = np.zeros(len(end_a), bool)
        self.closes_a[place[self.closes_b]] = True
        cut = ~self.closes_b
        of_a = np.insert(np.arange(len(end_a)), place[cut], place[cut])
        ends = np.insert(end_a, place[cut], end_b[cut])
        doc_a = np.repeat(np.arange(self.count), self.n_a)
        self.a, self.doc = self.ids_a[of_a], doc_a[of_a]
        self.b = self.ids_b[np.searchsorted(end_b, ends)]
        self.n_groups = np.bincount(doc_a[self.closes_a], minlength=self.count)
        self.n_links = np.bincount(self.doc, minlength=self.count)

    def pairs(self, ids_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links) of the distinct pairs of each text; a pair is a * ids_b + b."""
        space = np.int64(ids_b) << 16
        key, n = np.unique(self.doc * space + self.a * ids_b + self.b, return_counts=True)
        return key // space, key % space, n

    def groups(self) -> list[str]:
        """a1,a2|b1;a3|b2,b3 for each text."""
        end_a, end_b = np.flatnonzero(self.closes_a) + 1, np.flatnonzero(self.closes_b) + 1
        at_a = np.arange(len(self.ids_a)) + np.append(0, end_b)[np.cumsum(self.closes_a) - self.closes_a]
        at_b = np.arange(len(self.ids_b)) + np.append(end_a, 0)[np.cumsum(self.closes_b) - self.closes_b]
        code = np.zeros(len(at_a) + len(at_b), np.int64)
        code[at_a] = 3 * self.ids_a + self.closes_a
        code[at_b] = 3 * self.ids_b + 2 * self.closes_b
        letters, size = _decimals()
        size = size[code]
        ends = self.at_a[1:] + self.at_b[1:]
        some = ends > self.at_a[:-1] + self.at_b[:-1]
        size[ends[some] - 1] -= 1  # nothing after a text's last id
        data = letters[code][np.arange(letters.shape[1]) < size[:, None]].tobytes().decode("ascii")
        at = np.concatenate([[0], np.cumsum(size)])[np.append(0, ends)].tolist()
        return [data[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]


@functools.lru_cache(1)
def _decimals() -> tuple[np.ndarray, np.ndarray]:
    """Letters and lengths of every 16-bit id followed by each of , | and ;"""
    texts = [f"{i}{c}".encode() for i in range(1 << 16) for c in ",|;"]
    size = np.array([len(x) for x in texts])
    return np.array(texts, "S6").view(np.uint8).reshape(len(texts), 6), size


@functools.lru_cache(1)
def _sizes(a: str, b: str) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array([len(x) for x in side.entries], np.int64) for side in sides(a, b))


def _aligned(batches, a: str, b: str):
    """(slice of a batch, its alignment) over bounded slices."""
    for batch in batches:
        names = batch.schema.names
        for part in pieces(batch, "a", ALIGN_BYTES):
            yield part, Aligned(part.column(names.index("a")), part.column(names.index("b")), *_sizes(a, b))


def bucket_of(pair: np.ndarray, bits: int) -> np.ndarray:
    return (mix(pair.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _by_bucket(bits: int, pair: np.ndarray, *others):
    """(bucket, pair, others) of the rows of each bucket."""
    bucket = bucket_of(pair, bits)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    columns = [x[order] for x in (pair, *others)]
    for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(bucket[x]), *(c[x:y].astype("<i8").tobytes() for c in columns)


def _rows(rows, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows, strict=True), strict=True)))


def _numbers(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), "<i8") for x in column]


def _summed(pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(pair, return_inverse=True)
    return distinct, np.bincount(at, weights=n, minlength=len(distinct)).astype(np.int64)


def counted(ids: DataFrame, a: str, b: str, bits: int = BUCKET_BITS, fan_in: int = FAN_IN) -> DataFrame:
    """bucket, levels (of its perfect hash), pairs and counts at each index: of how many rows of
    ``ids`` (``encoded``) each pair of ids is linked in."""

    def leaves(batches):
        part, ids_b = TaskContext.get().partitionId(), len(sides(a, b)[1].entries)
        names = ["bucket", "part", "pairs", "counts"]
        held, sums, size = [], (np.zeros(0, np.int64), np.zeros(0, np.int64)), 0

        def fold():
            new, n = np.unique(np.concatenate(held), return_counts=True) if held else (sums[0][:0], sums[1][:0])
            return _summed(np.append(sums[0], new), np.append(sums[1], n))

        for _, found in _aligned(batches, a, b):
            held.append(found.pairs(ids_b)[1])
            size += len(held[-1])
            if size >= HELD_PAIRS:
                sums, held, size = fold(), [], 0
                if len(sums[0]) >= HELD_PAIRS:
                    yield _rows([(x[0], part, *x[1:]) for x in _by_bucket(bits, *sums)], names)
                    sums = sums[0][:0], sums[1][:0]
        sums = fold()
        if len(sums[0]):
            yield _rows([(x[0], part, *x[1:]) for x in _by_bucket(bits, *sums)], names)

    def merge(group: pa.Table) -> pa.Table:
        pair, n = (np.concatenate(_numbers(group.column(c))) for c in ("pairs", "counts"))
        pair, n = _summed(pair, n)
        first = group.select(["bucket", "group"]).slice(0, 1).to_pylist()[0]
        return pa.table(
            {"bucket": [first["bucket"]], "part": [first["group"]], "pairs": [pair.tobytes()], "counts": [n.tobytes()]}
        )

    def distinct(group: pa.Table) -> pa.Table:
        pair = np.unique(np.concatenate(_numbers(group.column("pairs"))))
        first = group.select(["bucket", "group"]).slice(0, 1).to_pylist()[0]
        return pa.table({"bucket": [first["bucket"]], "part": [first["group"]], "pairs": [pair.tobytes()]})

    def hashed(batches):
        for batch in batches:
            rows = []
            for bucket, pair in zip(batch.column(0).to_pylist(), _numbers(batch.column(1)), strict=True):
                levels = bit_levels(pair.astype(np.uint64))
                at = PerfectHash([levels]).index(pair.astype(np.uint64))
                rows.append((bucket, packed(levels), pair[np.argsort(at)].tobytes()))
            yield _rows(rows, ["bucket", "levels", "keys"])

    def dense(batches):
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                keys, pair, n = (np.frombuffer(x[c], "<i8") for c in ("keys", "pairs", "counts"))
                at = PerfectHash([unpacked(x["levels"])]).index(pair.astype(np.uint64))
                if not (keys[at] == pair).all():
                    raise ValueError("a pair is not in the hash of its bucket")
                vector = np.zeros(len(keys), "<i8")
                vector[at] = n
                rows.append((x["bucket"], x["part"], vector.tobytes()))
            yield _rows(rows, ["bucket", "part", "counts"])

    def added(group: pa.Table) -> pa.Table:
        vector = np.sum(_numbers(group.column("counts")), axis=0, dtype="<i8")
        first = group.select(["bucket", "group"]).slice(0, 1).to_pylist()[0]
        return pa.table({"bucket": [first["bucket"]], "part": [first["group"]], "counts": [vector.tobytes()]})

    def up(rows: DataFrame, fn, schema: str) -> DataFrame:
        group = F.floor(F.col("part") / fan_in).alias("group")
        return written(rows.select(*rows.columns, group).groupBy("bucket", "group").applyInArrow(fn, schema), "tree")

    def groups(rows: DataFrame) -> int:
        return (rows.agg(F.max("part")).first()[0] or 0) + 1

    plain = "bucket long, part long, pairs binary, counts binary"
    sparse = written(ids.select("a", "b").mapInArrow(leaves, plain), "leaves")
    sparse = up(sparse, merge, plain)
    keys, n = sparse.select("bucket", "part", "pairs"), groups(sparse)
    while n > 1:
        keys, n = up(keys, distinct, "bucket long, part long, pairs binary"), -(-n // fan_in)
    keys = keys.select("bucket", "pairs").mapInArrow(hashed, "bucket long, levels binary, keys binary")
    keys = written(keys, "perfect-hashes")
    vectors = sparse.join(keys, "bucket").mapInArrow(dense, "bucket long, part long, counts binary")
    n = groups(sparse)
    while n > 1:
        vectors, n = up(vectors, added, "bucket long, part long, counts binary"), -(-n // fan_in)
    vectors = vectors.select("bucket", "counts")
    return written(keys.withColumnRenamed("keys", "pairs").join(vectors, "bucket"), "pair-counts")


def pair_counts(table: DataFrame, ids_b: int) -> DataFrame:
    """a, b, n: the counted pairs as rows."""

    def rows(batches):
        for batch in batches:
            for pair, n in zip(_numbers(batch.column(0)), _numbers(batch.column(1)), strict=True):
                yield pa.RecordBatch.from_pydict({"a": pair // ids_b, "b": pair % ids_b, "n": n})

    return table.select("pairs", "counts").mapInArrow(rows, "a long, b long, n long")


class Table:
    """Counts of pairs in some or all buckets."""

    def __init__(self, rows: list, bits: int):
        self.bits, self.place = bits, np.full(1 << bits, -1, np.int64)
        self.place[[x["bucket"] for x in rows]] = np.arange(len(rows))
        self.hash = PerfectHash([unpacked(x["levels"]) for x in rows])
        none = np.zeros(0, np.int64)
        self.pair = _narrow([np.frombuffer(x["pairs"], "<i8") for x in rows] or [none])
        self.n = _narrow([np.frombuffer(x["counts"], "<i8") for x in rows] or [none])

    def counts(self, pair: np.ndarray) -> np.ndarray:
        at = self.hash.index(pair.astype(np.uint64), self.place[bucket_of(pair, self.bits)])
        if not (self.pair[at] == pair).all():
            raise ValueError("a pair was not counted")
        return self.n[at].astype(np.int64)


def _narrow(parts: list[np.ndarray]) -> np.ndarray:
    most = max((int(x.max()) for x in parts if len(x)), default=0)
    kind = np.uint32 if most < 1 << 32 else np.int64
    return np.concatenate([x.astype(kind) for x in parts])


def _per_doc(found, doc, n, counts, best) -> tuple[np.ndarray, np.ndarray]:
    """Links with their A id's highest count, and counts summed over links, of each text."""
    most = np.bincount(doc, weights=n * best, minlength=found).astype(np.int64)
    total = np.zeros(found, np.int64)
    np.add.at(total, doc, n * counts)
    return most, total


def aligned(docs: DataFrame, a: str, b: str, broadcast_pairs: int = BROADCAST_PAIRS, **tree) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a and n_b (tokens), n_groups, n_links, n_best (links whose
    count is the highest of their A id, ties included), count_sum (of counts over links), groups (the
    ids of each group, ``a1,a2|b1;a3|b2,b3``). A link's count is the number of rows it occurs in.

    ``a`` is a byte-level BPE file, ``b`` a sentencepiece file. Null and empty texts, and those whose
    tokens do not spell a space and the text in either tokenizer, have zeros and no groups. Rows without
    doc_id and repeated rows are rows like others, and count. Texts of any length are aligned whole.
    An empty table gives no rows. Other columns are not looked at.
    """
    ids = encoded(docs, a, b)
    spark, ids_b = docs.sparkSession, len(sides(a, b)[1].entries)
    bits = tree.get("bits", BUCKET_BITS)
    table = counted(ids, a, b, **tree)
    n_pairs = table.agg(F.coalesce(F.sum(F.length("pairs") / 8), F.lit(0))).first()[0]
    # One number for each id of A.
    highest = pair_counts(table, ids_b).groupBy("a").agg(F.max("n").alias("n")).collect()
    best = np.zeros(len(sides(a, b)[0].entries), np.int64)
    best[[x["a"] for x in highest]] = [x["n"] for x in highest]

    counts = "n_a long, n_b long, n_groups long, n_links long"
    if n_pairs <= broadcast_pairs:
        shared = spark.sparkContext.broadcast((Table(table.collect(), bits), best))

        def looked_up(batches):
            known, highest = shared.value
            for part, x in _aligned(batches, a, b):
                doc, pair, n = x.pairs(ids_b)
                count = known.counts(pair)
                most, total = _per_doc(x.count, doc, n, count, count == highest[pair // ids_b])
                columns = [x.n_a, x.n_b, x.n_groups, x.n_links, most, total]
                made = [part.column(0), *map(pa.array, columns), pa.array(x.groups(), pa.string())]
                yield pa.RecordBatch.from_arrays(
                    made, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
                )

        schema = f"doc_id long, {counts}, n_best long, count_sum long, groups string"
        return ids.select("doc_id", "a", "b").mapInArrow(looked_up, schema)

    # Beyond that size the pairs of documents go to the buckets, in groups of a few tasks each.
    def asked(batches):
        part, names = TaskContext.get().partitionId(), ["bucket", "group", "pairs", "docs", "links"]
        for rows, x in _aligned(batches, a, b):
            doc, pair, n = x.pairs(ids_b)
            row = rows.column(0).to_numpy()[doc]
            if len(row):
                yield _rows([(y[0], part // 4, *y[1:]) for y in _by_bucket(bits, pair, row, n)], names)

    def answered(asking: pa.Table, table: pa.Table) -> pa.Table:
        known = Table(table.select(["bucket", "levels", "pairs", "counts"]).to_pylist(), bits)
        pair, row, n = (np.concatenate(_numbers(asking.column(c))) for c in ("pairs", "docs", "links"))
        count = known.counts(pair)
        row, doc = np.unique(row, return_inverse=True)
        most, total = _per_doc(len(row), doc, n, count, count == best[pair // ids_b])
        return pa.table({"row": row, "n_best": most, "count_sum": total})

    def described(batches):
        for part, x in _aligned(batches, a, b):
            made = [*part.columns[:2], *map(pa.array, (x.n_a, x.n_b, x.n_groups, x.n_links))]
            names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
            yield pa.RecordBatch.from_arrays([*made, pa.array(x.groups(), pa.string())], names)

    asking = ids.select("row", "a", "b").mapInArrow(
        asked, "bucket long, group long, pairs binary, docs binary, links binary"
    )
    asking = written(asking, "asked-pairs")
    wanted = written(asking.select("bucket", "group").distinct(), "asked-buckets")
    copies = wanted.join(table, "bucket").groupBy("bucket", "group")
    sums = (
        asking.groupBy("bucket", "group")
        .cogroup(copies)
        .applyInArrow(answered, "row long, n_best long, count_sum long")
        .groupBy("row")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    rows = ids.mapInArrow(described, f"row long, doc_id long, {counts}, groups string")
    return rows.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")), "groups",
    )


def digest(rows: DataFrame) -> DataFrame:
    """``groups`` replaced by groups_sha256, empty where there are no tokens."""
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return rows.withColumn("groups_sha256", sha).drop("groups")
