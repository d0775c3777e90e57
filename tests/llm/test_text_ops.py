"""Row-wise operators against plain Python, and their edge cases."""

import hashlib
import math
import random
import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import decontam, language, pii, quality, queries, secrets, tokenfiles
from tickloom.llm.words import Words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hits string, _words string"
FIELD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PII_TEXT = st.text(alphabet="aZ09.@+- ()%_é4\n", max_size=80)
SECRET_TEXT = st.lists(
    st.sampled_from(
        ["password", "Token", "api_key", "=", ":", " ", '"', "abcdef", "0" * 13, "AKIA", "A1B2C3D4", "é", "\n"]
    ),
    max_size=14,
).map("".join)


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_words(text):
    return re.findall(FIELD, ascii_lower(text or ""))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, columns with clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, "   \n\n ", "en", None), (4, long, None, "a"),
        (5, "mail me at bob.x@example.com or +1 (212) 555-0100", "en", "a"),
        (5, "mail me at bob.x@example.com or +1 (212) 555-0100", "en", "a"),
        (None, "no id here, token = abcdef123", "en", "b"), (6, "...!!!", "en", "b"),
        (7, "one two three four five six seven eight nine ten eleven", "en", "b"),
    ]
    return spark.createDataFrame([(*r, 0, "clash", "clash") for r in rows], DOCS)


# ---- words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB9é -\n", max_size=30), max_size=8))
def test_words_match_the_pattern(texts):
    words = Words(pa.array(texts, pa.string()))
    want = [plain_words(t) for t in texts]
    assert words.count.tolist() == [len(w) for w in want]
    by_word = {}
    for w, h in zip([w for t in want for w in t], words.hash.tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


# ---- personal data, secrets


def plain_pii(x):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(PII_TEXT)
def test_pii_base_spans(text):
    assert pii.base_spans(text) == plain_pii(text)


def test_pii_base_spans_of_hard_texts():
    for text in ("a@b.c._x@d.e", "1.2.3.4.5.6.7.8", "x@a.b@c.d", "4111 1111 1111 1111 +1 212 555 0100", "0" * 5000):
        assert pii.base_spans(text) == plain_pii(text)


def test_pii_reliabilities_find_the_good_labelers():
    rng = np.random.default_rng(7)
    truth = rng.random(4000) < 0.4
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.85, 0.5]
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth) for a in accuracy], 1)
    votes = np.where(votes, 1, 2)
    soft, table = pii.reliabilities(votes, np.ones(4000))
    assert ((soft > 0.5) == truth).mean() > 0.95
    assert np.argsort(-table[1, :, 1])[:2].tolist() == [0, 1]


def test_pii_edges_and_added_spans(spark, odd_docs):
    rows = queries.pii.digest(pii.personal_data(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    for r in rows:
        want = ",".join(f"{pii.KINDS[k]}:{b}:{e}" for b, k, e in plain_pii(texts[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
    many = [(i, f"call tel {212 + i}-555-{1000 + i} or card visa 4111111111111111 and +1 212 555 {1000 + i}") for i in range(60)]
    found = pii.personal_data(spark.createDataFrame(many, "doc_id long, text string")).collect()
    assert all(len(r.spans) == len(r.base) + 1 for r in found)
    assert pii.personal_data(odd_docs.limit(0)).count() == 0


def plain_secrets(x):
    out = []
    pattern = r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(pattern, x) if len(m.group(1)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", x) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", x) if len(m.group()) >= 24]
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(SECRET_TEXT)
def test_secret_base_spans(text):
    assert [x[:3] for x in secrets.base_spans(text)] == plain_secrets(text)


def plain_shape(t):
    """Own features of one token, straight from their meaning."""
    n = len(t)
    lower, upper, digit = (sum(c in cs for c in t) for cs in (string.ascii_lowercase, string.ascii_uppercase, string.digits))
    kinds = [0 if c in string.ascii_lowercase else 1 if c in string.ascii_uppercase else 2 if c in string.digits else 3 for c in t]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1)
    entropy = -sum(t.count(c) / n * math.log2(t.count(c) / n) for c in set(t))
    one = t if n == 1 else "none"
    return [
        1, *(n > k for k in (3, 6, 10, 16, 20, 24, 32, 40)),
        lower == n, upper == n, digit == n, lower + upper + digit == 0,
        lower > 0 and digit > 0, upper > 0 and digit > 0, upper > 0 and lower > 0,
        n > 6 and set(t) <= set("0123456789abcdef"), changes if n > 6 else 0, max(0, entropy - 3) if n > 6 else 0,
        digit / n, n < 24 and bool(re.search("(?ai:pass|secret|token|key|auth|cred|bearer)", t)),
        bool(re.match("AKIA|ASIA|gh[pousr]_|xox[abp]-|sk_|pk_|eyJ|AIza", t)),
        one in "=:", one in "\"'`", one in "@+(.-", t.count(".") > 1, "/" in t or "+" in t,
    ]


SHAPED = st.one_of(
    st.text("abyzAZ019+/_.-", min_size=1, max_size=300),
    st.sampled_from(["é", "中", "😀", "=", ":", '"', "(", "@", "\ud800", "ÿ"]),
    st.sampled_from(["my_Token", "AKIA0", "xAKIA0", "ghp_a1", "eyJ", "sk_live/x", "password" * 4]),
)


@settings(max_examples=300, deadline=None)
@given(st.lists(SHAPED, max_size=9))
def test_token_shapes_against_plain_features(tokens):
    got = secrets.shapes(tokens)
    assert got.shape == (len(tokens), secrets.OWN)
    assert np.allclose(got, np.array([plain_shape(t) for t in tokens], float).reshape(-1, secrets.OWN))


SPANS = st.lists(st.tuples(st.integers(0, 60), st.integers(1, 9)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(SPANS, SECRET_TEXT)
def test_tagged_spans_that_touch_a_base_span_are_left_out(pairs, text):
    tagged = sorted({(b, 0, b + n) for b, n in pairs})

    class Said:
        def secrets(self, _):
            return [tagged]

    _, spans = secrets.found_in(Said(), pa.array([text]))
    fixed = plain_secrets(text)
    free = [x for x in tagged if all(x[2] <= b or e <= x[0] for b, _, e in fixed)]
    assert [tuple(x.values()) for x in spans[0].as_py()] == sorted({*fixed, *free})


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a.@1 :dot+()", max_size=60), SPANS)
def test_loose_spans_touch_neither_base_spans_nor_each_other(text, pairs):
    taken = [(b, 0, b + n) for b, n in pairs]
    want, edges = [], [(b, e) for b, _, e in taken]
    for kind, pattern in pii._LOOSE:
        number = pii.KINDS.index(kind)
        if number == 0 and not ("dot" in text or "@" in text) or number and not re.search("[0-9]", text):
            continue
        if number == 1 and text.count(":") < 7:
            continue
        for m in pattern.finditer(text):
            if all(m.end() <= b or e <= m.start() for b, e in edges):
                want.append((m.start(), number, m.end()))
                edges.append(m.span())
    assert pii.loose_spans(text, taken) == want


def test_viterbi_of_stretches_is_the_best_path_of_the_whole_text():
    rng = np.random.default_rng(3)
    moves = rng.normal(size=(3, 3))
    bound = 2 * (moves.max() - moves.min())
    for _ in range(200):
        scores = rng.normal(scale=2, size=(7, 3))
        scores[rng.random(7) < 0.4, 0] += 3 * bound
        paths = np.stack(np.meshgrid(*[range(3)] * 7, indexing="ij"), -1).reshape(-1, 7)
        value = scores[np.arange(7), paths].sum(1) + moves[paths[:, :-1], paths[:, 1:]].sum(1)
        value += moves[0, paths[:, 0]] + moves[paths[:, -1], 0]
        best = paths[value.argmax()]
        got = np.zeros(7, int)
        warm = np.flatnonzero(scores[:, 0] - scores[:, 1:].max(1) <= bound)
        for part in np.split(warm, np.flatnonzero(np.diff(warm) > 1) + 1):
            if len(part):
                got[part] = secrets.viterbi(scores[part], moves)
        assert got.tolist() == best.tolist()


def test_secrets_are_learned_beyond_the_patterns(spark, odd_docs):
    rng = random.Random(5)
    some = lambda n: "".join(rng.choice("0123456789abcdefABCDEFGHJK") for _ in range(n))
    rows = [(i, f"some plain words {i} and more of them, password={some(22)} then other text") for i in range(300)]
    rows += [(1000 + i, f"only words here, number {rng.randrange(10**6)} and 10.0.0.{i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    field = secrets.fitted(docs)
    tagger = secrets.Tagger(field)
    hits = tagger.secrets([t for i, t in rows if i < 1000])
    assert sum(len(h) == 1 for h in hits) >= 290
    assert sum(map(bool, tagger.secrets([t for i, t in rows if i >= 1000]))) <= 2
    assert tagger.secrets([f"set the pass = {some(22)} now"])[0]
    # Texts side by side are tagged as each is alone.
    mixed = ["", *[t for _, t in rows[::7]], "=", "api_key: " + some(40)]
    assert secrets.Tagger(field).secrets(mixed) == [secrets.Tagger(field).secrets([t])[0] for t in mixed]
    found = secrets.digest(secrets.secrets(odd_docs, field)).collect()
    assert len(found) == odd_docs.count()
    assert secrets.secrets(odd_docs.limit(0), None).count() == 0
    assert secrets.fitted(odd_docs.where("doc_id = 2")) is None


# ---- decontamination


def plain_hits(text, items):
    words, hit, found = plain_words(text), set(), set()
    for name, item in items:
        have = plain_words(item)
        n = min(10, len(have))
        windows = {tuple(have[i : i + n]) for i in range(len(have) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(name))
    return len(words), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark, odd_docs):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(9)]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, words(rng.choice([3, 9, 10, 11, 25, 40]))) for i in range(12)]
    items += [(3, items[4][1]), (20, None), (21, "--"), (None, words(12)), (22, "one two three")]
    rows = []
    for i in range(150):
        item = rng.choice(items)[1] or ""
        cut = rng.randrange(1 + len(item.split()))
        rows.append((i, f"{words(rng.randrange(30))} {' '.join(item.split()[cut:])}. {words(rng.randrange(20))}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [x for x in items if x[0] is not None and x[1] is not None]
    want = sorted((r.doc_id or -1, *plain_hits(r.text, named)) for r in docs.collect())

    def got(**limits):
        rows = decontam.contamination(docs, bench, **limits).collect()
        return sorted((r.doc_id or -1, r.n_words, sum(h.end - h.begin for h in r.hits), r["items"]) for r in rows)

    assert got() == want
    assert got(index_windows=300) == want  # several blocks
    assert decontam.digest(decontam.contamination(docs, bench.limit(0))).where("contaminated").count() == 0
    assert decontam.contamination(docs.limit(0), bench).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=10, max_size=60), st.integers(0, 50))
def test_every_shared_span_has_a_shared_fingerprint(numbers, at):
    at %= len(numbers) - 9
    text = " ".join(map(str, numbers))
    part = " ".join(map(str, numbers[at : at + 10]))
    sides = [set(decontam.fingerprints(Words(pa.array([t])), 10, 5)[1].tolist()) for t in (text, part)]
    assert sides[0] & sides[1]


# ---- language


def test_language_probabilities_add_up_and_held_out_documents(spark, odd_docs):
    rng = random.Random(2)
    parts = {"aa": ["ba", "lo", "mi", "tu"], "bb": ["krz", "szt", "ow", "yc"], "cc": ["äu", "öf", "ung", "sch"]}
    rows = []
    for i in range(400):
        lang = rng.choice(list(parts))
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(30))
        rows.append((i, text, lang, "s"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language.fitted(docs)
    truth = {r[0]: r[2] for r in rows}
    got = language.identified(docs.unionByName(odd_docs.select("doc_id", "text", "lang", "source").where("doc_id is null or doc_id < 4")), model).collect()
    own = [r for r in got if r.doc_id in truth and r.doc_id > 3]
    assert all(r.lang_pred == truth[r.doc_id] and not r.rejected for r in own)
    assert all(0 <= r.score <= 1 for r in got)
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !"), (4, "бвгд жзий клмн опрс туфх цчшщ")], "doc_id long, text string")
    odd = {r.doc_id: r for r in language.identified(blank, model).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].rejected and odd[i].score == 0 for i in (1, 2, 3))
    assert odd[4].rejected and odd[4].lang_pred in parts
    # After any context the chances of all symbols add up to one at most.
    symbols = np.arange(1 << language.SYMBOL_BITS)
    for context in (0, *np.unique(language.sequence(pa.array([rows[0][1]]))[1])[:5]):
        grams = (int(context) << language.SYMBOL_BITS | symbols) & ((1 << language.SYMBOL_BITS * language.ORDER) - 1)
        total = np.exp(model.logs(grams).astype(float)).sum(axis=0)
        assert (abs(total[[len(model.langs) and 0]]) < 1.02).all()
    none = language.fitted(docs.limit(0))
    assert {r.lang_pred for r in language.identified(blank, none).collect()} <= {"und", None}


def test_gram_sequence_is_padded_per_text():
    owner, gram = language.sequence(pa.array(["Ab, c", "", "9", "x"]))
    mask = (1 << language.SYMBOL_BITS) - 1
    assert owner.tolist() == [0, 0, 0, 0, 0, 3, 3]
    assert [int(g) & mask for g in gram] == [97, 98, 0, 99, 0, 120, 0]
    assert int(gram[5]) == 120 and int(gram[6]) == 120 << language.SYMBOL_BITS


# ---- token files


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aéZ9 '\n\tsß$.|<> あ", max_size=60))
def test_encoder_equals_the_tokenizer(text):
    enc = tokenfiles.encoder(queries.VOCABULARY)
    want = enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_pack_round_trip(numbers):
    ranks = np.array(numbers, np.uint32)
    ids, where = np.unique(ranks, return_inverse=True)
    control, data = tokenfiles.pack(where)
    assert tokenfiles.unpack(control, data, len(numbers), ids).tolist() == numbers
    wide = tokenfiles.pack(ranks)
    assert len(wide[0]) == -(-len(numbers) // 4)
    assert len(wide[1]) == sum(max(1, (x.bit_length() + 7) // 8) for x in numbers)


def test_token_files_round_trip(spark, odd_docs, tmp_path):
    docs = odd_docs.where("doc_id <> 4").unionByName(odd_docs.where("doc_id = 4"))
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in queries.token_files(docs).collect())
    enc, at = tokenfiles.encoder(queries.VOCABULARY), 0
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    assert [g[1] for g in got] == sorted((r.doc_id for r in docs.select("doc_id").collect()), key=lambda x: -1 if x is None else x)
    for start, doc_id, n, crc in got:
        want = [*enc.tokenizer.encode(texts[doc_id][0], add_special_tokens=False).ids, 0]
        assert (start, n, crc) == (at, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        at += n
    assert queries.token_files(odd_docs.limit(0)).count() == 0


# ---- quality


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts_against_plain_python(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(["a ", "b ", "c\n", "#", "é ", "\t", "\x0b", "d e f g h "]) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "x " * 400), (1003, "a b c d e " * 3)]
    docs = spark.createDataFrame([(*r, None, None) for r in rows], "doc_id long, text string, lang string, source string")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = {r.doc_id: tuple(r[n] for n in names) for r in quality.judged(docs).collect()}
    assert got == {i: plain_quality(t) for i, t in rows}


def test_quality_edges(spark, odd_docs):
    got = quality.judged(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(not r.kept for r in got if r.n_words < 10)
    assert quality.judged(odd_docs.limit(0)).count() == 0
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40)), "en", "s") for i in range(50)]
    rows.append((99, " ".join(f"w{j}#|#|#|" for j in range(40)), "en", "s"))
    got = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not got.pop(99) and all(got.values())
