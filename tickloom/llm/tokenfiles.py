"""Token-id files: frequency-ranked ids in byte-aligned variable-length code.

Each id is replaced by its rank by frequency over the whole corpus (0 the commonest) and written in
1 to 4 bytes. The lengths, two bits an id, stand apart in control bytes, four ids to a byte, so a
reader finds all positions from the control bytes by table lookup and never tests a bit per id.

The files are a Parquet folder ``blocks`` (one row per block of whole documents: the ids before it in its partition,
doc_ids, tokens per document, control bytes, data bytes) and a Parquet folder ``ranks`` (rank, id).
Parquet lets every store that Spark writes hold the bytes, with Spark's commit for lost executors.
"""

import functools
import itertools
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from .common import flat, pieces, small_batches, written
from .pretokens import Cuts, Remembered, covered

# Spark runs the tasks side by side; the tokenizer starts no threads of its own.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

END_ID = 0
# A block closes after so many tokens (a longer document has a block of its own).
BLOCK_TOKENS = 1 << 14
# Distinct pre-tokens whose ids a worker remembers, in two generations of half as many; longer ones
# are not kept. About 200 bytes each.
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 64


@functools.lru_cache(2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def _width(path: str) -> str:
    """Type that holds every id of the vocabulary in the intermediate blocks."""
    return "<u2" if _tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes.

    Byte-level pre-tokens are encoded one by one whatever stands around them, so the ids of each
    distinct pre-token are asked of the tokenizer once and remembered.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.remembered = Remembered(self._learn, REMEMBERED, REMEMBERED_BYTES)
        names = self.tokenizer.get_vocab()
        self.after_space = np.zeros(max(names.values()) + 1, bool)
        self.after_space[[i for name, i in names.items() if name.startswith("Ġ")]] = True
        self.line_end = names.get("Ċ", -1)

    def _plain(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in made]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Texts that ``pretokens`` covers are cut there; all others, and those that may hold a special
        token's string, go through the tokenizer whole."""
        raw = [x.encode() for x in texts]
        cut = covered(raw).tolist()
        cut = [c and b"<|" not in x for c, x in zip(cut, raw, strict=True)]
        cuts = Cuts(list(itertools.compress(raw, cut)))
        coded = iter(cuts.coded(self.remembered.ids(cuts.pieces)))
        return [next(coded) if c else self._plain([x])[0] for x, c in zip(texts, cut, strict=True)]

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ask for many pieces at once: words with their space stand side by side and begin at the
        ids with a space, words without one on lines of their own; others are asked for singly."""
        pieces = [x.decode() for x in new]
        spaced = [x for x in pieces if x[0] == " " and x[1:].isalpha()]
        bare = [x for x in pieces if x.isalpha()]
        rest = set(pieces).difference(spaced, bare)
        found: dict[str, bytes] = {}
        for words, between in ((spaced, ""), (bare, "\n")):
            if not words:
                continue
            raw = self._plain([between.join(words)])[0]
            ids = np.frombuffer(raw, "<u4")
            if between:
                gaps = np.flatnonzero(ids == self.line_end)
                begin, end = np.append(0, gaps + 1), np.append(gaps, len(ids))
            else:
                begin = np.flatnonzero(self.after_space[ids])
                end = np.append(begin[1:], len(ids))
            if len(begin) == len(words):
                cut = zip(words, (4 * begin).tolist(), (4 * end).tolist(), strict=True)
                found.update((x, raw[b:e]) for x, b, e in cut)
            else:
                rest |= set(words)
        single = list(rest)
        found.update(zip(single, self._plain(single), strict=True))
        return {x: found[piece] for x, piece in zip(new, pieces, strict=True)}


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def frequencies(blocks: DataFrame, width: str) -> DataFrame:
    """(id, n) over all blocks of plain ids. At most one row per id of the vocabulary."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                n = np.bincount(np.frombuffer(ids.as_py(), width), minlength=len(total))
                n[: len(total)] += total
                total = n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counted = blocks.select("ids").mapInArrow(count, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def ranked(counts: DataFrame) -> list[int]:
    """Ids by falling frequency, ties by id; bounded by the vocabulary."""
    return [r[0] for r in counts.orderBy(F.desc("n"), "id").collect()]


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4")
    length = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    code = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    code[: len(ranks)] = length - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    all_bytes = ranks.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), all_bytes[np.arange(4) < length[:, None]].tobytes()


@functools.lru_cache(1)
def _lengths() -> np.ndarray:
    """Lengths of the four ids of each control byte."""
    codes = np.arange(256, dtype=np.uint8)[:, None] >> np.array([0, 2, 4, 6], np.uint8)
    return (codes & 3) + 1


def unpack(control: bytes, data: bytes, n: int, ids: np.ndarray) -> np.ndarray:
    """The n ids of a block; ``ids`` gives the id of each rank."""
    length = _lengths()[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    begin = np.cumsum(length) - length
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    rank = padded[begin].astype(np.uint32)
    for j in (1, 2, 3):
        more = np.flatnonzero(length > j)
        rank[more] |= padded[begin[more] + j].astype(np.uint32) << np.uint32(8 * j)
    return ids[rank]


_PLACE = "part int, block int, before long, n_tokens long, doc_ids array<long>, lengths array<int>"
BLOCKS = f"{_PLACE}, control binary, data binary"


def plain_blocks(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Blocks of whole documents in ascending doc_id order with their plain ids."""
    width = _width(vocabulary)
    schema = to_arrow_schema(T._parse_datatype_string(f"{_PLACE}, ids binary"))
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        part, blocks, enc = TaskContext.get().partitionId(), itertools.count(), encoder(vocabulary)
        kept: list[tuple] = []
        before = 0

        def block():
            nonlocal before
            ids = b"".join(x[1] for x in kept)
            row = [part, next(blocks), before, len(ids) // 4, [x[0] for x in kept]]
            before += len(ids) // 4
            row += [[len(x[1]) // 4 for x in kept], np.frombuffer(ids, "<u4").astype(width).tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema
            )

        held = 0
        for batch in batches:
            for rows in pieces(batch, "text"):
                coded = enc.encode(flat(rows.column(1)).to_pylist())
                for doc_id, ids in zip(rows.column(0).to_pylist(), coded, strict=True):
                    kept.append((doc_id, ids + end))
                    held += len(ids) // 4 + 1
                    if held >= BLOCK_TOKENS:
                        yield block()
                        kept.clear()
                        held = 0
        if kept:
            yield block()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )
    return ordered.mapInArrow(encode, f"{_PLACE}, ids binary")


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Write every text of ``docs`` in ascending doc_id order to ``path``.

    Null and empty texts are just the end id. Rows without doc_id come first; repeated ids stand in
    the order of their texts' hash and text. An empty table gives files without blocks. Texts are
    moved and encoded once; the blocks of plain ids are counted and then coded where they lie.
    """
    spark = docs.sparkSession
    small_batches(spark)
    blocks = written(plain_blocks(docs, vocabulary, end_id), "plain-ids")
    width = _width(vocabulary)
    ids = ranked(frequencies(blocks, width))
    rank_of = np.zeros(max(ids, default=0) + 1, np.uint32)
    rank_of[np.array(ids, np.int64)] = np.arange(len(ids))
    ranks = spark.createDataFrame(list(enumerate(ids)), "rank int, id int")
    ranks.coalesce(1).write.parquet(f"{path}/ranks")

    def code(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                control, data = pack(rank_of[np.frombuffer(one.column("ids")[0].as_py(), width)])
                place = one.drop_columns(["ids"])
                columns = [*place.columns, pa.array([control]), pa.array([data])]
                yield pa.RecordBatch.from_arrays(columns, [*place.schema.names, "control", "data"])

    coded = blocks.mapInArrow(code, BLOCKS)
    coded.write.option("compression", "zstd").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> tuple[DataFrame, list[int]]:
    """(blocks with ``start``, the ids written before each block; id of each rank).

    A block knows the ids before it in its partition. The totals summed by the window and sent to all
    tasks are two numbers per written partition, whatever the number of blocks.
    """
    blocks = spark.read.schema(T._parse_datatype_string(BLOCKS)).parquet(f"{path}/blocks")
    ids = [r[0] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").collect()]
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_part_start")
    )
    placed = blocks.join(F.broadcast(starts), "part")
    return placed.withColumn("start", F.col("_part_start") + F.col("before")), ids


def decoded(spark: SparkSession, path: str, fields: str, summary) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens and the columns ``fields``, which
    ``summary`` makes from the document's array of ids."""
    blocks, ids = read(spark, path)
    small_batches(spark)
    by_rank = np.array(ids, np.uint32)
    added = T._parse_datatype_string(fields)
    schema = T.StructType(
        [*T._parse_datatype_string("doc_id long, start long, n_tokens long").fields, *added.fields]
    )

    def expand(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                x = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                tokens = unpack(x["control"], x["data"], x["n_tokens"], by_rank).astype("<u4")
                n = np.array(x["lengths"], np.int64)
                at = np.cumsum(n) - n
                made = [summary(tokens[a : a + k]) for a, k in zip(at, n, strict=True)]
                columns = [pa.array(c) for c in zip(*made, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x["doc_ids"], pa.int64()), pa.array(x["start"] + at), pa.array(n), *columns],
                    names=schema.names,
                )

    wanted = blocks.select("start", "n_tokens", "doc_ids", "lengths", "control", "data")
    return wanted.mapInArrow(expand, schema)
