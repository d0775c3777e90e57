"""Registered queries of the operators: thin, each over its whole table, with fixed result columns."""

import uuid
import zlib

import public_tokenizers
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (
    align,
    bytebpe,
    decontam,
    language,
    mixing,
    neardup,
    pii,
    prefixes,
    quality,
    rollup,
    secrets,
    tokenfiles,
    urls,
)
from .common import documents, table, written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Rules of the url filter, and words by which a host is on its list.
RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")

QUERIES: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op6_decontamination(spark, sf_dir):
    found = decontam.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return decontam.digest(found)


@register
def op10_quality(spark, sf_dir):
    return quality.judged(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@register
def op9_token_files(spark, sf_dir):
    return token_files(documents(spark, sf_dir))


def token_files(docs):
    """Write the token files of all texts and read back one row per document."""
    spark = docs.sparkSession
    path = f"{scratch_dir(spark)}/token-files-{uuid.uuid4().hex}"
    tokenfiles.write(docs, path, VOCABULARY)
    return tokenfiles.decoded(
        spark, path, "ids_crc32 long", lambda ids: (zlib.crc32(ids.tobytes()),)
    )


@register
def op4_near_duplicates(spark, sf_dir):
    classes, _ = neardup.near_duplicates(documents(spark, sf_dir), weighted=True)
    return classes.select("doc_id", "class_id")


@register
def op8_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = language.identified(docs, language.fitted(docs))
    held_out = F.coalesce(language.fold(docs) == 0, F.lit(False))
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"
    )


@register
def op1_personal_data(spark, sf_dir):
    return pii.digest(pii.personal_data(documents(spark, sf_dir)))


@register
def op5_secrets(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return secrets.digest(secrets.secrets(docs, secrets.fitted(docs)))


@register
def op2_mixing(spark, sf_dir):
    return mixing.mixed(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@register
def op3_url_filter(spark, sf_dir):
    """Listed: a key whose first label has a listed word."""
    label = F.split_part(F.col("key"), F.lit("."), F.lit(1))
    listed = F.arrays_overlap(F.split(label, "-"), F.array(*(F.lit(w) for w in LISTED_WORDS)))
    return urls.judged(table(spark, sf_dir, "pages"), listed, RULES)


@register
def op7_token_totals(spark, sf_dir):
    """All documents come in under two tokenizers, further copies of a text go, the rest is revised
    (repeated lines dropped) for one tokenizer; each batch is sent twice."""
    counts = written(rollup.counted(documents(spark, sf_dir)), "counts")
    first = written(rollup.first_copies(counts), "first-copies")
    store = rollup.Totals(spark, f"{scratch_dir(spark)}/totals-{uuid.uuid4().hex}")

    def inserted(rows, sign=1):
        space = rollup.signed(rows, "space-1", "space", sign)
        return space.unionByName(rollup.signed(rows, "alnum-2", "alnum", sign))

    revised = rollup.signed(first, "alnum-2", "alnum_revised", 1, False).unionByName(
        rollup.signed(first, "alnum-2", "alnum", -1, False)
    )
    batches = {
        "insert": inserted(counts),
        "delete-copies": inserted(counts, -1).unionByName(inserted(first)),
        "revise": revised,
    }
    for batch, deltas in [*batches.items(), *batches.items()]:
        store.commit(batch, deltas)
    store.compact()
    return store.totals()


@register
def op12_prefix_trie(spark, sf_dir):
    turns = written(prefixes.ordered_turns(table(spark, sf_dir, "conversations")), "ordered-turns")
    return prefixes.trie(*prefixes.spliced(turns))


@register
def op11_byte_bpe(spark, sf_dir):
    ids = bytebpe.encoded(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)
    return bytebpe.digest(ids, RANKS)


@register
def op13_alignment(spark, sf_dir):
    return align.digest(align.aligned(documents(spark, sf_dir), VOCABULARY, PIECES))
