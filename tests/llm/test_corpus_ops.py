"""Operators over whole corpora against brute force, and the pipeline's stages."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_text_ops import odd_docs, plain_hits, plain_words  # noqa: F401

import corpus_pipeline
from tickloom.llm import dart, language, mixing, neardup, queries, rollup, urls

# ---- DartMinHash


@pytest.mark.parametrize("weighted", [False, True])
def test_agreement_of_coordinates_is_the_weighted_similarity(weighted):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 300).astype(np.uint64)
    b = np.concatenate([a[:200], rng.integers(0, 2**63, 60).astype(np.uint64)])
    wa = rng.choice([0.5, 1, 2, 3.7], 300) if weighted else np.ones(300)
    wb = np.concatenate([rng.choice([0.5, 1, 2, 3.7], 200), np.ones(60)]) if weighted else np.ones(260)
    t = 4000
    one, two = (
        dart.signatures(np.zeros(len(x), np.int64), x, w if weighted else None, 1, t)[0]
        for x, w in ((a, wa), (b, wb))
    )
    shared = np.minimum(wa[:200], wb[:200]).sum()
    want = shared / (wa.sum() + wb.sum() - shared)
    assert abs((one == two).mean() - want) < 0.03
    assert (one != 0).all()


def test_signatures_do_not_depend_on_company():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 7, 400, 3000)]
    owner = np.repeat(np.arange(5), [1, 7, 0, 400, 3000])
    together = dart.signatures(owner, np.concatenate(sets), None, 5, 64)
    assert not together[2].any()
    for row, x in zip((0, 1, 3, 4), sets, strict=True):
        alone = dart.signatures(np.zeros(len(x), np.int64), x, None, 1, 64)
        assert (alone[0] == together[row]).all()


# ---- near duplicates


def plain_classes(rows):
    def shingles(text):
        w = plain_words(text)
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])

    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having, shared = collections.defaultdict(list), collections.Counter()
    for d, s in sets.items():
        for g in s:
            having[g].append(d)
    for ds in having.values():
        shared.update((a, b) for i, a in enumerate(ds) for b in ds[i + 1 :])
    for (a, b), n in shared.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {d: top(d) for d in sets}


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def families():
    rng = random.Random(8)
    rows = []
    for family in range(6):
        base = [f"f{family}w{rng.randrange(3000)}" for _ in range(200)]
        for _ in range(25):
            rows.append(edited(rng, base, rng.randrange(9)))
        chain = list(base)  # each like the one before, the ends unlike each other
        for step in range(12):
            chain[step * 6 : step * 6 + 5] = [f"c{family}s{step}k{i}" for i in range(5)]
            rows.append(" ".join(chain))
    rows += rows[:40] + ["", "a b", "a b", "a B", "a b c"] + [" ".join(["same"] * 50)] * 4
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_near_duplicates_against_brute_force(spark, families):
    docs = spark.createDataFrame(families, "doc_id long, text string")
    classes, links = neardup.near_duplicates(docs)
    got = {r.doc_id: r.class_id for r in classes.collect()}
    assert got == plain_classes(families)
    assert links.where("a = b").isEmpty()


def test_near_duplicates_edges(spark, odd_docs):  # noqa: F811
    classes = neardup.near_duplicates(odd_docs)[0].collect()
    assert len(classes) == odd_docs.where("doc_id is not null").count()
    assert all(r.class_id == r.doc_id for r in classes)
    assert neardup.near_duplicates(odd_docs.limit(0))[0].count() == 0


def test_weighted_near_duplicates_count_repeats(spark):
    line = "alpha beta gamma delta epsilon zeta eta theta "
    docs = spark.createDataFrame([(1, line * 2), (2, line * 20)], "doc_id long, text string")
    for weighted, classes in ((False, 1), (True, 2)):
        got = neardup.near_duplicates(docs, weighted=weighted)[0]
        assert got.select("class_id").distinct().count() == classes


def test_near_duplicates_start_few_jobs(spark, families):
    """The driver keeps something of every job, stage and scan: tables are not counted once for each join,
    and the pairs compared so far are read in one scan."""
    context = spark.sparkContext
    docs = spark.createDataFrame(families, "doc_id long, text string")
    context.setJobGroup("near-duplicates", "")
    try:
        neardup.near_duplicates(docs)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = context.statusTracker().getJobIdsForGroup("near-duplicates")
    assert 30 < len(jobs) < 310
    seen = [spark.createDataFrame([(2, 1), (5, 6)], "a long, b long"), spark.createDataFrame([(8, 9)], "a long, b long")]
    pairs = spark.createDataFrame([(1, 2), (6, 5), (2, 3), (9, 8), (5, 6)], "a long, b long")
    left = neardup.untried(pairs, seen[0].unionByName(seen[1]))
    assert [tuple(r) for r in left.collect()] == [(2, 3)]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges = [(a, b) for a, b in edges if a != b]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    half = len(edges) // 2
    frames = [spark.createDataFrame(e, "a long, b long") for e in (edges[:half], edges)]
    labels = neardup.components(frames[1], neardup.components(frames[0]))
    got = {r.node: r.root for r in labels.collect()}
    assert all(got.get(x, x) == top(x) for x in parent)


# ---- mixing


def test_rates_against_projected_gradient_in_numpy(spark):
    rng = np.random.default_rng(5)
    n = rng.integers(1, 500, 400)
    p = rng.dirichlet([0.4, 0.4, 0.4], 400)
    goal = np.array([0.62, 0.34, 0.04]) * n.sum()
    docs = [(int(a), *map(float, b)) for a, b in zip(n, p, strict=True)]
    rows = spark.createDataFrame(docs, "n_tokens long, p_high double, p_low double, p_toxic double")
    got = mixing.rated(rows, goal)
    sums = got.agg(*(F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) for d in mixing.DOMAINS)).first()
    assert np.allclose(sums, goal, rtol=1e-5)
    assert got.agg(F.min("rate")).first()[0] >= 0
    # Targets out of reach: as near, in the same measure, as many plain projected steps come.
    q = 0.4 * p + 0.2
    docs = [(int(a), *map(float, b)) for a, b in zip(n, q, strict=True)]
    rows = spark.createDataFrame(docs, rows.schema)
    inverse = np.linalg.inv((q * n[:, None]).T @ q)
    goal = np.array([0.9, 0.08, 0.02]) * n.sum()
    rate = np.ones(400)
    for _ in range(20_000):
        rate = np.maximum(0, rate - q @ (inverse @ ((rate * n) @ q - goal)))
    want = (rate * n) @ q - goal
    got = mixing.rated(rows, goal, steps=200)
    left = np.array(got.agg(*(F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) for d in mixing.DOMAINS)).first()) - goal
    assert left @ inverse @ left <= 1.01 * (want @ inverse @ want) + 1e-9


def test_mixing_learns_domains_and_edges(spark, odd_docs):  # noqa: F811
    rng = random.Random(6)
    words = [f"v{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(600):
        kind = rng.choice(["high", "high", "low", "toxic"])
        text = " ".join(rng.choice(words) for _ in range(60))
        if kind == "toxic":
            text += " nasty vile"
        rows.append((i, text if kind != "low" else f"{text} !! || !! ||"))
        if i % 2:
            labels.append((i, int(kind != "low"), int(kind == "toxic"), "x"))
    labels += [(10**6, 1, 0, "x"), (None, 1, 0, "x"), (1, None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    got = {r.doc_id: r for r in mixing.mixed(docs, marks).collect()}
    assert all(got[i].p_toxic > 0.5 for i, t in rows if "nasty" in t)
    assert all(got[i].p_high > 0.5 for i, t in rows if "nasty" not in t and "||" not in t)
    assert all(abs(r.p_high + r.p_low + r.p_toxic - 1) < 1e-9 and r.rate >= 0 for r in got.values())
    odd = mixing.mixed(odd_docs, marks).collect()
    assert len(odd) == odd_docs.count()
    assert all(r.rate == 1 for r in odd if r.n_tokens == 0)
    assert mixing.mixed(docs.limit(0), marks).count() == 0
    unlabelled = mixing.mixed(docs, marks.limit(0)).collect()
    assert len(unlabelled) == 600 and all(abs(r.p_low - 1 / 3) < 1e-9 for r in unlabelled)


# ---- urls


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(20_000).select(
        F.concat(F.lit("host"), F.col("id"), F.lit(".example")).alias("key"), (F.col("id") % 7 == 0).alias("listed")
    )
    levels = urls.cascade(keys)
    assert 2 <= len(levels) < 12
    assert keys.where(urls.member(levels, F.col("key")) != F.col("listed")).isEmpty()
    assert urls.cascade(keys.where("not listed")) == []


def test_url_verdicts_and_edges(spark):
    rows = ["http://A.Spam.example/x?y", "https://x.net", "https://x.net/", "nothing", None, "://", "http://b.example.net/en/1#z",
            "http://example.com/de/", "http://Q.org/fr/://spam.com/", "http://m.spam.example", "http://notspam.example/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(rows)], "page_id long, url string, host string")
    listed = F.col("key") == "spam.example"
    want = [
        ("a.spam.example", "/x", None, "block"), ("x.net", "", None, "allow"), ("x.net", "/", "net/", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("b.example.net", "/en/1", "example.net/en/", "allow"), ("example.com", "/de/", "example.com/de/", "block"),
        ("q.org", "/fr/://spam.com/", "org/fr/", "allow"), ("m.spam.example", "", None, "block"),
        ("notspam.example", "/", None, "allow"),
    ]
    for most_bits in (urls.MOST_BITS, 8):
        got = urls.judged(pages, listed, queries.RULES, most_bits=most_bits)
        assert [tuple(r)[1:] for r in got.orderBy("page_id").collect()] == want
    assert urls.judged(pages.limit(0), listed, queries.RULES).count() == 0


# ---- rollups


def test_a_batch_committed_during_compaction_counts_once(spark, tmp_path):
    docs = spark.createDataFrame([("a", "en", 5), (None, None, 7)], "source string, lang string, n long")
    rows = rollup.signed(docs, "v1", "n")

    class Racing(rollup.Totals):
        def _summed(self, path, batches):
            rollup.Totals(self.spark, self.path).commit("late", rows)
            return super()._summed(path, batches)

    store = rollup.Totals(spark, str(tmp_path / "raced"))
    store.commit("first", rows)
    Racing(spark, store.path).compact()
    want = [("a", "en", 2, 10), (None, None, 2, 14)]
    for _ in range(2):
        found = store.totals().select("source", "lang", "docs", "tokens").collect()
        assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
        assert store.committed() == ["first", "late"] and not store.commit("late", rows)
        store.compact()


def test_rollup_commits_are_idempotent_and_additive(spark, tmp_path):
    store = rollup.Totals(spark, str(tmp_path / "totals"))
    assert store.totals().count() == 0
    docs = spark.createDataFrame(
        [("a", "en", 5), ("a", "en", 7), (None, None, 3), ("b", "de", None)], "source string, lang string, n long"
    )
    assert store.commit("b1", rollup.signed(docs, "v1", "n"))
    assert not store.commit("b1", rollup.signed(docs, "v1", "n"))
    (tmp_path / "totals/batches/torn").mkdir(parents=True)  # an attempt that never ended
    assert store.committed() == ["b1"]
    assert store.commit("torn", rollup.signed(docs.where("lang = 'en'"), "v1", "n", -1))
    revised = docs.where("source is null").withColumn("n", F.lit(4))
    change = rollup.signed(revised, "v1", "n", 1, False).unionByName(rollup.signed(docs.where("source is null"), "v1", "n", -1, False))
    store.commit("b3", change)
    want = {(None, None, "v1", 1, 4), ("b", "de", "v1", 1, 0)}
    assert {tuple(r) for r in store.totals().collect()} == want
    store.compact()
    assert not store.commit("b3", change)
    assert {tuple(r) for r in store.totals().collect()} == want
    store.commit("b4", rollup.signed(docs.where("source = 'b'"), "v1", "n", -1))
    store.compact()
    assert {tuple(r) for r in store.totals().collect()} == {(None, None, "v1", 1, 4)}
    assert store.committed() == ["b1", "b3", "b4", "torn"]
    with pytest.raises(ValueError):
        store.commit("../x", change)


# ---- pipeline


def test_stages_against_plain_versions(spark):
    folder = "/root/testdata/sf0.001"
    docs = queries.documents(spark, folder)
    model = language.fitted(docs)
    scored = {r.doc_id: r.rejected for r in language.identified(docs, model).collect()}
    one = corpus_pipeline.identify_language(spark, docs, folder)
    assert one.columns == docs.columns
    assert {r.doc_id for r in one.select("doc_id").collect()} == {d for d, gone in scored.items() if not gone}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    two = corpus_pipeline.drop_near_duplicates(spark, docs.unionByName(docs.limit(20)), folder)
    kept = sorted(r.doc_id for r in two.select("doc_id").collect())
    assert kept == sorted(d for d, c in plain_classes(texts).items() if d == c)
    items = [(r.item_id, r.text) for r in queries.table(spark, folder, "benchmark").collect()]
    three = corpus_pipeline.drop_contaminated(spark, docs, folder)
    assert {r.doc_id for r in three.select("doc_id").collect()} == {d for d, t in texts if not plain_hits(t, items)[1]}
    four = corpus_pipeline.mix(spark, docs, folder)
    assert four.columns == docs.columns
    rates = {r.doc_id: r.rate for r in mixing.mixed(docs, queries.table(spark, folder, "labels"), size=corpus_pipeline.MIX_SIZE).collect()}
    made = collections.Counter(r.doc_id for r in four.select("doc_id").collect())
    assert all(int(rates[d]) <= made[d] <= int(rates[d]) + 1 for d in rates)
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted((r.start, r.n_tokens) for r in got.collect())
    assert [s for s, _ in rows] == [0, *np.cumsum([n for _, n in rows])[:-1].tolist()]
    assert re.fullmatch(r"[a-z_]+", corpus_pipeline.STAGES[0][0]) and pa


def weighted_sets(rows):
    sets = {}
    for d, text in rows:
        w = plain_words(text)
        grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else {tuple(w): 1}
        sets[d] = {g: 1 + math.log(n) for g, n in grams.items()}
    return sets


def test_hot_group_of_half_alike_copies_without_listing_its_pairs(spark, monkeypatch):
    """Copies of one text that are 0.35 to 0.78 alike meet in the same buckets; links among them are
    found with a number of comparisons that does not grow with the square of their number."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(4000)}" for _ in range(150)]
    rows = [edited(rng, base, rng.randrange(8, 24)) for _ in range(500)]
    rows += [edited(rng, x.split(" "), rng.randrange(1, 3)) for x in rows[:150]]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    sets = weighted_sets(rows)
    size = {d: sum(s.values()) for d, s in sets.items()}
    links = []
    for a in range(0, len(rows)):
        for b in range(a + 1, len(rows)):
            shared = sum(min(w, sets[b][g]) for g, w in sets[a].items() if g in sets[b])
            if shared >= 0.8 * (size[a] + size[b] - shared):
                links.append((a, b))
    compared = []
    plain = neardup.verified

    def counting(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(neardup, "verified", counting)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(docs, weighted=True)[0].collect()
    cls = {r.doc_id: r.class_id for r in found}
    assert len(links) > 100
    assert sum(cls[a] == cls[b] for a, b in links) >= 0.9 * len(links)
    assert sum(compared) < 100 * len(rows)
    # No class is larger than the links make it.
    parent = {d: d for d in cls}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    assert all(top(d) == top(c) for d, c in cls.items())


@pytest.mark.parametrize("block", [4096, 5])
def test_every_link_of_a_bucket_of_many_classes_is_found(spark, monkeypatch, block):
    """Many small classes meet in one bucket: links outside its largest classes are not lost."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(5)
    shared = " ".join(f"s{i}" for i in range(60))
    rows = []
    for family in range(40):
        own = [f"f{family}w{rng.randrange(3000)}" for _ in range(40)]
        rows += [f"{shared} {edited(rng, own, n)}" for n in (0, 1, 1)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    found = neardup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), weighted=True, n_bands=1, rows=1
    )[0]
    cls = {r.doc_id: r.class_id for r in found.collect()}
    band = neardup.sign(pa.array([t for _, t in rows]), True, 1, 1)[3].to_pylist()
    sets = weighted_sets(rows)
    size = {d: sum(s.values()) for d, s in sets.items()}
    links = []
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = sum(min(w, sets[b][g]) for g, w in sets[a].items() if g in sets[b])
        if band[a] == band[b] and both >= 0.8 * (size[a] + size[b] - both):
            links.append((a, b))
    assert len(links) > 50
    assert all(cls[a] == cls[b] for a, b in links)


def test_cells_never_rule_out_a_similar_pair():
    rng = random.Random(6)
    base = [f"w{rng.randrange(400)}" for _ in range(300)]
    texts = [edited(rng, base, rng.randrange(16)) for _ in range(60)] + [" ".join(base[:150] * 40)]
    cells = np.frombuffer(b"".join(neardup.cell_sums(pa.array(texts), True).to_pylist()), np.float16)
    cells = cells.reshape(len(texts), neardup.CELLS).astype(np.float32)
    own = np.arange(len(texts))
    left = {
        (min(i, x), max(i, x))
        for i, j in neardup.open_pairs(own, 0 * own, cells, 0.8)
        for x in j
    }
    pairs = list(itertools.combinations(range(len(texts)), 2))
    near = neardup.compare([texts[a] for a, _ in pairs], [texts[b] for _, b in pairs], True) >= 0.8
    similar = {p for p, x in zip(pairs, near, strict=True) if x}
    assert similar <= left and len(similar) > 20 and len(left) < len(pairs)


def test_targets_out_of_reach_are_told(spark):
    docs = [(10, 0.5, 0.3, 0.2), (20, 0.4, 0.4, 0.2), (0, 0.9, 0.1, 0.0)]
    rows = spark.createDataFrame(docs, "n_tokens long, p_high double, p_low double, p_toxic double")
    with pytest.warns(UserWarning, match="targets not met"):
        got = mixing.rated(rows, [30.0, 0.0, 0.0], steps=5).collect()
    assert all(r.rate >= 0 for r in got)
    assert [r.rate for r in got if r.n_tokens == 0] == [1.0]


CLASHING = ("score", "rejected", "n_words", "hits", "n_tokens", "rate", "p_high", "_n", "_copy", "_part", "_row", "a.b")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_carry_columns_of_any_name(spark, name, stage):
    folder = "/root/testdata/sf0.001"
    docs = queries.documents(spark, folder).limit(120)
    odd = docs.limit(2).withColumns({"text": F.lit(None).cast("string"), "doc_id": F.col("doc_id") + 10**6})
    odd = odd.unionByName(docs.limit(1).withColumns({"text": F.lit(""), "doc_id": F.lit(2 * 10**6).cast("long")}))
    docs = queries.written(docs.unionByName(odd), "stage-docs")
    wide = docs.select("*", *(F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in CLASHING))
    got = stage(spark, wide, folder)
    assert got.columns == wide.columns
    got = got.collect()
    assert all(r[c] == f"{c}{r.doc_id}" for r in got for c in CLASHING)
    plain = stage(spark, docs, folder).select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in plain)
    none = stage(spark, wide.limit(0), folder)
    assert none.columns == wide.columns and none.count() == 0
