"""Clashing names, empty tables, repeated ids and plain counterparts of learned models."""

import math
import random
from zlib import crc32

import numpy as np
import pytest

import corpus_pipeline
from epiframe.llm import common, decontaminate, line_dedup, media, mixing, quality, simhash, substring_dedup
from tests.llm import fixtures as fx

NAMES = "doc_id long, text string, lang string, source string, n_chars long, copy long, _hit_id long, _hit_hash long, hit_id long, hash long, row long, n_lines long, N_dropped long, id long, _row string, _first_id long, size long"


def clashing(spark, n=None):
    rows = [(r[0], r[1], r[2], r[3], r[4], *[i] * 9, "x", i, i) for i, r in enumerate(fx.rows())]
    return spark.createDataFrame(rows[:n], NAMES).repartition(3)


def test_free_name(spark):
    assert common.free_name(clashing(spark), "copy") == "_copy" and common.free_name(clashing(spark), "new") == "new"
    assert common.free_name(clashing(spark), "n_dropped") == "_n_dropped"  # names differ by more than their case


def test_mixed_rows_keep_a_column_named_copy(spark):
    docs = clashing(spark)
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == [*docs.columns, "_copy"]
    own = {r.copy: r.asDict() for r in docs.collect()}
    rows = mixed.collect()
    assert rows and all({k: v for k, v in r.asDict().items() if k != "_copy"} == own[r.copy] for r in rows)
    assert mixing.mixed_rows(docs.limit(0)).count() == 0


def test_clean_keeps_columns_of_its_own_names(spark):
    docs = clashing(spark)
    text = next(t for t in fx.texts() if t and len(t.split()) > 30)
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.copy for r in kept.collect()) == [i for i, r in enumerate(fx.rows()) if r[1] != text and text not in (r[1] or "")]
    assert decontaminate.clean(docs.limit(0), bench).count() == 0


def test_lines_keep_columns_of_their_own_names(spark):
    docs = clashing(spark)
    cut = line_dedup.dedup_lines(docs)
    assert cut.columns == [*docs.columns, "_n_lines", "_n_dropped"]
    assert sorted(r.n_lines for r in cut.collect()) == list(range(len(fx.rows())))


def test_stages_stand_clashes_nulls_and_empty_tables(spark, tmp_path):
    labels = [(r[0], i % 2) for i, r in enumerate(fx.rows()) if r[0] is not None] + [(None, 1), (3, None)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, fx.texts()[1]), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (clashing(spark), clashing(spark).limit(0)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = common.staged(stage(spark, docs, str(tmp_path)), "t")
            assert out.columns == docs.columns + ["_copy"] * (k == 4), name
            n, had = out.count(), docs.count()
            assert n <= had or k == 4
            if k != 0:
                assert n == 0 if not had else n > 0, name
            docs = out if n or not had else docs
    # without the columns that only some tables have
    few = clashing(spark).select("doc_id", "text", "source")
    assert corpus_pipeline.line_stage(spark, few, str(tmp_path)).columns == few.columns


def test_repeated_ids_train_alike(spark):
    rng = random.Random(2)
    rows = [(i % 50, fx.prose(rng, 20)) for i in range(150)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = quality.train(docs, labels)
    assert want.any()
    for n in (1, 3, 7):
        assert np.array_equal(want, quality.train(docs.repartition(n, "text"), labels))


def plain_ftrl(rows, epochs, alpha, beta, l1, l2):
    """One weight at a time, by the published rule; the bias is not regularised."""
    z, n = {}, {}

    def weight(i):
        lam = 0.0 if i == quality.SIZE else l1
        if abs(z.get(i, 0.0)) <= lam:
            return 0.0
        return -(z[i] - math.copysign(lam, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for idx, y in rows:
            x = {int(i): float((idx == i).sum()) / math.sqrt(max(1, len(idx))) for i in set(idx.tolist())} | {quality.SIZE: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[i] * x[i] for i in x)))))
            for i in x:
                g = (p - y) * x[i]
                old = n.get(i, 0.0)
                sigma = (math.sqrt(old + g * g) - math.sqrt(old)) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = old + g * g
    return {i: weight(i) for i in z}


def test_ftrl_equals_one_weight_at_a_time():
    rng, hashes = random.Random(3), quality._Hashes()
    texts = [fx.prose(rng, rng.randrange(0, 30), "abc" if i % 2 else "bcd") for i in range(40)] + ["", "a a a a a", "one"]
    rows = [(quality.features(t, hashes), float(i % 2)) for i, t in enumerate(texts)]
    for options in ({"alpha": 1.0, "beta": 1.0, "l1": 0.05, "l2": 0.0}, {"alpha": 0.3, "beta": 0.5, "l1": 0.0, "l2": 0.1}):
        got, want = quality.ftrl(rows, 3, **options), plain_ftrl(rows, 3, **options)
        assert np.allclose([got[i] for i in want], list(want.values()), atol=1e-12)
        assert not np.delete(got, list(want)).any()


def test_scores_equal_a_plain_dot_product(spark):
    rng = np.random.default_rng(4)
    w = rng.normal(size=quality.SIZE + 1)
    rows = [(i, t) for i, t in enumerate(fx.texts())]
    found = {r.doc_id: r.score for r in quality.scores(spark.createDataFrame(rows, "doc_id long, text string"), w).collect()}
    for i, t in rows:
        x = {}
        for k in quality.features(t, quality._Hashes()).tolist():
            x[k] = x.get(k, 0) + 1
        total = sum(x.values())
        dot = w[-1] + sum(w[k] * c for k, c in x.items()) / math.sqrt(max(1, total))
        assert math.isclose(found[i], 1 / (1 + math.exp(-max(-35, min(35, dot)))), abs_tol=1e-12)


def test_features_are_hashed_words_and_pairs():
    idx = quality.features("ab cd! ab", quality._Hashes())
    mix = lambda v: (v * 0x9E3779B97F4A7C15 % 2**64) >> (64 - quality.BITS)
    h = [crc32(t.encode()) for t in ("ab", "cd", "!", "ab")]
    assert idx.tolist() == [mix(v) for v in h] + [mix((a * 31 + b + 7) % 2**64) for a, b in zip(h, h[1:])]


def test_equal_texts_have_one_place(spark, tmp_path):
    rows = [(i, ("same text " * 9, "other", None, "")[i % 4]) for i in range(40)]
    found = media.text_media(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), folder=f"file://{tmp_path}/m").collect()
    assert len(found) == 40
    for kind in (0, 1):
        own = {tuple(v for k, v in r.asDict().items() if k != "doc_id") for r in found if r.doc_id % 4 == kind}
        assert len(own) == 1
    assert len({r.digest for r in found}) == 3


def near_fixture(spark):
    """Four orders of one word set: two of them are near copies at a similarity of 0.99, though all four share any entry that only looks at words."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(120)]
    a, b, c = (rng.sample(words, 120) for _ in range(3))
    return [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c)), (4, " ".join([*b, "w7"]))]


def test_near_copies_among_orders_of_one_word_set(spark):
    groups = {r.doc_id: r.group_id for r in simhash.near_groups(spark.createDataFrame(near_fixture(spark), "doc_id long, text string")).collect()}
    assert groups == {1: 1, 2: 2, 3: 3, 4: 2}


def test_near_copies_with_repeated_ids_and_text_ids(spark):
    rows = near_fixture(spark)
    twice = [*rows, (2, rows[0][1]), (9, None), (8, "")]
    found = sorted((r.doc_id, r.group_id) for r in simhash.near_groups(spark.createDataFrame(twice, "doc_id long, text string")).collect())
    assert found == [(1, 1), (2, 1), (2, 2), (3, 3), (4, 2), (8, 8), (9, 8)]
    named = spark.createDataFrame([(f"d{i}", t) for i, t in rows], "doc_id string, text string")
    assert {r.doc_id: r.group_id for r in simhash.near_groups(named).collect()} == {"d1": "d1", "d2": "d2", "d3": "d3", "d4": "d2"}


def test_near_groups_of_the_small_table_equal_brute_force(spark):
    """All pairs of the 0.01 scale, by an inverted index over all shingles instead of a prefix."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(b" ".join(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([b" ".join(w)])
    holders = {}
    for i in sorted(sets):
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    shared = {}
    for who in holders.values():
        for k, a in enumerate(who):
            for b in who[k + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    n = 0
    for (a, b), c in shared.items():
        if c >= 0.8 * (len(sets[a]) + len(sets[b]) - c):
            n += 1
            x, y = sorted((root(a), root(b)))
            up[y] = x
    assert n > 20
    assert {r.doc_id: r.group_id for r in simhash.near_groups(docs).collect()} == {i: root(i) for i in sets}


@pytest.mark.parametrize("dense", [0, 3, 64])
def test_links_find_every_pair_however_dense(spark, dense):
    """Fingerprints of random clouds: with a bucket bound of 0 all go the way of the dense ones, with 64 none."""
    rng = random.Random(dense)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(4))}) for _ in range(25)}
    fps |= {(rng.getrandbits(32) << 32) | 5 for _ in range(30)}  # one low segment
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), dense=dense).collect()
    bits = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    assert all(1 <= bits(e.u, e.v) <= 2 for e in edges)
    up = {f: f for f in signed}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for e in edges:
        up[root(e.u)] = root(e.v)
    for i, a in enumerate(signed):
        for b in signed[:i]:
            if bits(a, b) <= 2:
                assert root(a) == root(b)


def test_fuzzy_passages(spark):
    """Passages of 100 words with one word in twenty replaced: all are found."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    rows, pairs = [], []
    for k in range(40):
        passage = [word() for _ in range(100)]
        other = [w if rng.random() > 0.05 else word() for w in passage]
        rows += [(2 * k, " ".join([word() for _ in range(30)] + passage)), (2 * k + 1, " ".join(other + [word() for _ in range(20)]))]
        pairs.append((2 * k + 1, 2 * k))
    found = {(r.doc_id, r.other_id) for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found <= set(pairs) and len(found) >= 0.95 * len(pairs)
