"""Byte-level BPE, alignment of two tokenizers and the conversation trie against plain versions."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from conftest import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import align, bytebpe, prefixes, pretokens, queries, tokenfiles
from tickloom.llm.perfect import PerfectHash, bit_levels, packed, unpacked

RANKS, PATTERN = queries.RANKS, public_tokenizers.PATTERN
ALPHABET = "ab'sStdm 019\n\t\r\x00\x1cé ß中　😀́ǅ½ⅷ▁<|endoftext|><s><unk>ﬁ.,-"
ODD = [
    None, "", " ", "  ", "\n", "\n\n a", "a" * 3000, " " * 2000, "ab " * 2000, "࢏\U00011de0Ᲊ",
    "<|endoftext|>", "<s>", "</s><0x41>", "▁a", "mixed ﬁ text", "tab\tand\r\nline ",
]


def odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and ids, clashing names."""
    rng = random.Random(3)
    texts = [*ODD, *("".join(rng.choices(ALPHABET, k=rng.randrange(40))) for _ in range(300))]
    rows = [(i, x, 1, 2, "clash") for i, x in enumerate(texts)]
    rows += [rows[6], rows[6], (None, "no id here", 1, 2, "clash"), (2, "second text of an id", 1, 2, "clash")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, ids int, row int, a string")


# ---- perfect hashing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 2**64 - 1), max_size=300), min_size=1, max_size=4))
def test_perfect_hash_is_minimal_in_every_set(sets):
    keys = [np.array(sorted(x), np.uint64) for x in sets]
    levels = [unpacked(packed(bit_levels(x))) for x in keys]
    made = PerfectHash(levels)
    every = np.concatenate([np.zeros(0, np.uint64), *keys])
    of_set = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
    assert sorted(made.index(every, of_set).tolist()) == list(range(len(every)))
    others = np.arange(50, dtype=np.uint64)
    assert (made.index(others, np.zeros(50, np.int64)) < max(made.size, 1)).all()


# ---- byte-level BPE


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bytebpe.read_ranks(RANKS), special_tokens={}
    )


@pytest.fixture(scope="module")
def encoder():
    vocabulary = bytebpe.Vocabulary(bytebpe.read_ranks(RANKS))
    return bytebpe.Encoder(vocabulary, bytebpe.compiled(PATTERN), bytebpe.compiled(PATTERN, bytebpe.NARROW))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet=ALPHABET, max_size=60)), max_size=6))
def test_ids_are_the_librarys(library, encoder, texts):
    got = [np.frombuffer(x, "<i4").tolist() for x in encoder.encode(texts)]
    assert got == [library.encode_ordinary(x) for x in texts]


def test_whole_entries_are_told_from_others(encoder):
    vocabulary = encoder.vocabulary
    items = [*list(vocabulary.ranks)[:3000], b"", b"not an entry at all", b" theThe"]
    assert vocabulary.whole(items) == [vocabulary.ranks.get(x, -1) for x in items]


def test_a_vocabulary_without_a_byte_is_refused():
    with pytest.raises(ValueError, match="single bytes"):
        bytebpe.Vocabulary({bytes([i]): i for i in range(255)})


def test_byte_bpe_of_odd_rows(spark, library):
    rows, docs = odd_rows(spark)
    got = bytebpe.digest(bytebpe.encoded(docs, RANKS, PATTERN), RANKS)
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        shas = (hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text or ""))
        want.append((doc_id, len(ids), *shas))
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert bytebpe.digest(bytebpe.encoded(docs.limit(0), RANKS, PATTERN), RANKS).count() == 0


# ---- alignment


def plain_alignment(rows):
    first = Tokenizer.from_file(queries.VOCABULARY)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    names, byte_of = {i: n for n, i in first.get_vocab().items()}, align._byte_of()

    def spelled(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    links, out = [], []
    for doc_id, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(byte_of[c] for c in names[i]) for i in a]
        bytes_b = [spelled(i) for i in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            links.append([])
            out.append((doc_id, 0, 0, 0, ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        found, groups, i, j, from_a, from_b = [], [], 0, 0, 0, 0
        while i < len(a):
            found.append((a[i], b[j]))
            x, y = ends_a[i], ends_b[j]
            i, j = i + (x <= y), j + (y <= x)
            if x == y:
                groups.append(",".join(map(str, a[from_a:i])) + "|" + ",".join(map(str, b[from_b:j])))
                from_a, from_b = i, j
        links.append(found)
        out.append((doc_id, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = collections.Counter(pair for found in links for pair in set(found))
    best = collections.defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return sorted(
        (
            (*o[:4], len(f), sum(count[x] == best[x[0]] for x in f), sum(count[x] for x in f), o[4])
            for o, f in zip(out, links, strict=True)
        ),
        key=repr,
    )


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("table", ["broadcast", "by bucket, in a deep tree"])
def test_alignment_of_odd_rows(spark, table, monkeypatch):
    rows, docs = odd_rows(spark)
    want = plain_alignment([r[:2] for r in rows])
    assert sum(r[1] > 0 for r in want) > 200 and sum(r[1] == 0 for r in want) > 5
    if table == "broadcast":
        got = align.aligned(docs, queries.VOCABULARY, queries.PIECES)
    else:
        monkeypatch.setattr(align, "HELD_PAIRS", 64)
        got = align.aligned(docs.repartition(7), queries.VOCABULARY, queries.PIECES, 0, bits=3, fan_in=2)
    assert rows_of(align.digest(got), *ALIGNED) == want


def test_alignment_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align.aligned(docs, queries.VOCABULARY, queries.PIECES).count() == 0
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    got = align.digest(align.aligned(empty, queries.VOCABULARY, queries.PIECES))
    assert rows_of(got, *ALIGNED) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


# ---- conversation trie


def plain_trie(rows):
    convs = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(turns.get(c - c % 100, [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, x in sorted(rebuilt.items()):
        for d in range(len(x) + 1):
            members[x[:d]].append(c)
    children = collections.Counter(x[:-1] for x in members if x)
    leaves, saved = collections.Counter(), collections.Counter()
    for x, m in members.items():
        for d in range(len(x) + 1):
            leaves[x[:d]] += not children[x]
            saved[x[:d]] += (len(m) - 1) * len(x[-1][1]) if x else 0
    out = []
    for x, m in members.items():
        ends = ",".join(str(c) for c in m if len(rebuilt[c]) == len(x))
        parent = members[x[:-1]][0] if x else None
        out.append((m[0], len(x), parent, len(m), children[x], leaves[x], saved[x], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string, depth int, name string"


def trie_of(spark, rows):
    table = spark.createDataFrame([(*r, 7, "clash") for r in rows], TURNS)
    turns = prefixes.written(prefixes.ordered_turns(table), "ordered-turns")
    return rows_of(prefixes.trie(*prefixes.spliced(turns)), *NODES)


@pytest.mark.parametrize("longest", [1, 5, 40])
def test_trie_against_plain_prefixes(spark, longest):
    rng = random.Random(longest)
    rows = []
    for c in [*range(12), *range(100, 130), 199, 250, 301, 302, 2**40 + 1]:
        # Few different texts: much is shared, and many conversations are equal throughout.
        for turn in range(rng.randrange(1, longest + 1)):
            first = None if turn == 0 and rng.random() < 0.3 else turn
            rows.append((c, first, rng.choice(["user", None]), rng.choice(["hi", "", None, "a longer text", "é😀"])))
    rng.shuffle(rows)
    assert trie_of(spark, rows) == plain_trie(rows)


def test_trie_of_a_long_and_of_very_common_conversations(spark):
    rows = [(100 + c, t, "user", f"same {t}") for c in range(90) for t in range(3)]
    rows += [(205, t, "user", "again") for t in range(300)]  # one conversation holds half of the rows
    rows += [(None, 1, "user", "no id"), (300, None, None, None)]
    assert trie_of(spark, rows) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert trie_of(spark, []) == []
    alone = trie_of(spark, [(7, 0, "user", "x")])
    assert alone == plain_trie([(7, 0, "user", "x")])


def test_hash_of_ids_over_many_runs(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "ENDS_RANGE", 4)
    ids = [*range(-9, 30, 3), 10**12]
    rows = [(1, 5, i) for i in ids] + [(2, 5, 8)]
    members = spark.createDataFrame(rows, "depth long, name long, conv_id long")
    got = {r.depth: r.ends_sha256 for r in prefixes.ids_sha256(members).collect()}
    want = {1: ",".join(map(str, ids)), 2: "8"}
    assert got == {d: hashlib.sha256(x.encode()).hexdigest() for d, x in want.items()}


_PLAIN_CUT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ɏ0-9]+|\s+(?!\S)|\s+"
)


def _cut_texts():
    deal = random.Random(5)
    kinds = "abstmdrelvSTÀéɏ 19.,<'''  \n\t", "abstrelÀé×÷ɐª²  \n\r\x0b\0'' 19.<|>{~\x7f日"
    words = ("", " ", "it's", "''s", "'s's", "x 's", "we'll've", "a" * 40 + " " + "a" * 41, "\n \n", "a  ")
    return [*words, *("".join(deal.choices(kinds[i % 4 == 0], k=i % 23)) for i in range(4000))]


def test_pretokens_are_those_of_the_pattern(monkeypatch):
    texts = _cut_texts()
    covered = pretokens.covered([x.encode() for x in texts]).tolist()
    assert covered == [not re.search("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ]", x) for x in texts]
    texts = [x for x, c in zip(texts, covered, strict=True) if c]

    def cut():
        cuts = pretokens.Cuts([x.encode() for x in texts])
        ends = cuts.first[1:]
        assert len(set(cuts.pieces)) == len(cuts.pieces)
        return [
            [cuts.pieces[k].decode() for k in cuts.code[a:b]]
            for a, b in zip(cuts.first, ends, strict=False)
        ]

    plain = [re.findall(_PLAIN_CUT, x) for x in texts]
    assert cut() == plain
    # different pre-tokens of one hash are told apart
    monkeypatch.setattr(pretokens, "_hashes", lambda words, n, size: size.astype("u8") % 2)
    assert cut() == plain


def test_both_encoders_agree_with_their_libraries_on_cut_texts():
    texts = [*_cut_texts(), "<|endoftext|> a", "a <| b"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    coded = tokenfiles.Encoder(path).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in coded] == [e.ids for e in whole]

    ranks, pattern = bytebpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    library = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    cuts = bytebpe.compiled(pattern), bytebpe.compiled(pattern, bytebpe.NARROW)
    encoder = bytebpe.Encoder(bytebpe.Vocabulary(ranks), *cuts, published=True)
    coded = encoder.encode(texts)
    assert [np.frombuffer(x, "<i4").tolist() for x in coded] == [library.encode_ordinary(x) for x in texts]


def test_remembered_ids_are_asked_once_and_bounded():
    asked = []

    def learn(new):
        asked.extend(new)
        return {x: x * 4 for x in new}

    kept = pretokens.Remembered(learn, 8, 3)
    for _ in range(2):
        assert kept.ids([b"a", b"b", b"long"]) == [b"aaaa", b"bbbb", b"long" * 4]
    assert asked == [b"a", b"b", b"long", b"long"]
    for i in range(50):
        kept.ids([b"%d" % i, b"a"])
        assert len(kept.known) + len(kept.before) <= 12
    assert asked.count(b"a") == 1
