import itertools
import random
from collections import defaultdict

import xxhash

from epiframe.llm import line_dedup, simhash, substring_dedup
from epiframe.llm.decontaminate import words_of
from tests.llm import fixtures as fx


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_lines(rows, min_docs=2):
    holders = defaultdict(set)
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    for r in rows:
        if r[0] is not None:
            for line in (r[1] or "").split("\n"):
                holders[key(line)].add(r[0])
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        keep = [x for x in lines if r[0] is None or len(key(x)) < 10 or len(holders[key(x)]) < min_docs or min(holders[key(x)]) == r[0]]
        text = r[1] if len(keep) == len(lines) else "\n".join(keep)
        out.append((r[0], len(lines), len(lines) - len(keep), text))
    return sorted(out, key=repr)


def test_lines_equal_brute_force(spark):
    for k in (2, 3):
        found = line_dedup.dedup_lines(fx.docs(spark), min_docs=k)
        assert fx.got(found, "doc_id", "n_lines", "n_dropped", "text") == brute_lines(fx.rows(), k)
    assert found.columns[:11] == fx.docs(spark).columns
    assert sum(r[2] for r in brute_lines(fx.rows())) > 5


def test_lines_empty(spark):
    assert line_dedup.dedup_lines(fx.empty(spark)).count() == 0


def brute_print(text, size=3):
    words = lower(text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    sh = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def roots_of(nodes, linked):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in linked:
        up[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def brute_components(rows):
    fps = [brute_print(r[1]) for r in rows]
    kinds = sorted(set(fps))
    root = roots_of(kinds, [(a, b) for a, b in itertools.combinations(kinds, 2) if bin(a ^ b).count("1") <= 2])
    low = defaultdict(list)
    for r, f in zip(rows, fps):
        if r[0] is not None:
            low[root[f]].append(r[0])
    return sorted(((r[0], f - (1 << 64) if f >> 63 else f, min(low[root[f]], default=None)) for r, f in zip(rows, fps)), key=repr)


def test_components_equal_brute_force(spark):
    want = brute_components(fx.rows())
    assert fx.got(simhash.near_components(fx.docs(spark)), "doc_id", "fp", "component_id") == want
    assert len({w[2] for w in want}) < len({w[1] for w in want})


def test_links_of_a_dense_cloud(spark):
    """Prints at chosen distances: chains of two bits, a cloud around a centre that is absent, one at three bits."""
    base = 0x0123456789ABCDEF
    fps = {base ^ (1 << i) for i in range(64)} | {base ^ 1 ^ (3 << 10), base ^ 1 ^ (3 << 10) ^ (3 << 40), ~base & (2**64 - 1), (~base & (2**64 - 1)) ^ 7}
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    edges = simhash.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long")).collect()
    nodes = [signed(f) for f in fps]
    found = roots_of(nodes, [(e.u, e.v) for e in edges])
    want = roots_of(nodes, [(a, b) for a, b in itertools.combinations(nodes, 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 2])
    part = lambda r: sorted(sorted(k for k in nodes if r[k] == v) for v in set(r.values()))
    assert part(found) == part(want)
    assert len(edges) < 65 * len(nodes)


def test_components_empty(spark):
    assert simhash.near_components(fx.empty(spark)).count() == 0
    assert simhash.near_groups(fx.empty(spark)).count() == 0


def shingles(t, n=5):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}


def test_near_groups(spark):
    rows = [r for r in fx.rows() if r[0] is not None]
    group = dict(fx.got(simhash.near_groups(fx.docs(spark)), "doc_id", "group_id"))
    sets = {r[0]: shingles(r[1]) for r in rows}
    near = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = roots_of(sorted(sets), near)
    members = defaultdict(list)
    for i, r in root.items():
        members[r].append(i)
    assert all(group[i] == min(members[root[i]]) for i in sets)
    kept = simhash.first_of_groups(fx.docs(spark))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(min(m) for m in members.values())
    assert kept.where("doc_id is null").count() == 2


def near_pairs_and_groups(spark, texts):
    sets = [shingles(t) for t in texts]
    near = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = roots_of(range(len(texts)), near)
    want = defaultdict(set)
    for i, r in root.items():
        want[r].add(i)
    found = defaultdict(set)
    for r in simhash.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        found[r.group_id].add(r.doc_id)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))
    return near


def test_near_groups_of_appended_texts(spark):
    """Texts with a part appended, of a similarity from 0.8."""
    import random

    rng, texts = random.Random(11), []
    for _ in range(60):
        words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.choice((60, 200)))]
        more = [f"w{int(rng.paretovariate(0.6))}" for _ in range(int(len(words) * rng.uniform(0.15, 0.25)))]
        texts += [" ".join(words), " ".join(words + more)]
    assert len(near_pairs_and_groups(spark, texts)) > 30


def test_near_groups_in_a_crowd(spark):
    """Texts of the same words in other orders: ids between a text and its near copy are of texts unlike both."""
    import random

    rng, words = random.Random(12), [f"t{k}" for k in range(100)]
    texts = [rng.sample(words, 100) for _ in range(40)]
    texts += [t[:95] + t[:94:-1] for t in texts]
    assert len(near_pairs_and_groups(spark, list(map(" ".join, texts)))) == 40


def test_chain_is_optimal_on_small_sets():
    """The Fenwick tree finds the score that trying all chains finds."""
    import random

    rng = random.Random(3)
    for _ in range(200):
        pts = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(rng.randint(1, 9))})
        x, y = [p[0] for p in pts], [p[1] for p in pts]
        best, k, g = {}, 5, 0.1
        for i in range(len(pts)):
            best[i] = k + max([0.0] + [best[j] - g * (x[i] - x[j] + y[i] - y[j]) for j in range(i) if x[j] < x[i] and y[j] < y[i]])
        top = substring_dedup.chain(x, y, k, gap_cost=g, max_gap=1000, min_anchors=1)[0]
        score = sum(k for _ in top) - sum(g * (x[b] - x[a] + y[b] - y[a]) for a, b in zip(top, top[1:]))
        assert abs(score - max(best.values())) < 1e-9


def test_chain_of_a_second_passage():
    """Two passages of one pair of documents, 66 to 500 words apart, are two chains whatever the first one's length."""
    for gap in (66, 100, 200, 300, 500):
        at = [*range(0, 400, 8), *range(400 + gap, 520 + gap, 8)]
        for shift in (0, 37):  # other words between them on either side
            y = [p + shift if p >= 400 else p for p in at]
            found = substring_dedup.chain(at, y, 5)
            assert sorted(map(len, found)) == [15, 50], gap


def test_chain_keeps_to_the_gap():
    """The best predecessor within the gap on both sides, as trying all of them finds it."""
    import random

    rng = random.Random(5)
    for _ in range(300):
        pts = sorted({(rng.randrange(120), rng.randrange(120)) for _ in range(rng.randint(1, 60))})
        x, y, k, g, far = [p[0] for p in pts], [p[1] for p in pts], 5, 0.02, rng.randrange(5, 40)
        score = [0.0] * len(pts)
        for i in range(len(pts)):
            score[i] = k + max([0.0] + [score[j] - g * (x[i] - x[j] + y[i] - y[j]) for j in range(i) if x[j] < x[i] <= x[j] + k + far and y[j] < y[i] <= y[j] + k + far])
        top = substring_dedup.chain(x, y, k, gap_cost=g, max_gap=far, min_anchors=1)[0]
        assert abs(k * len(top) - sum(g * (x[b] - x[a] + y[b] - y[a]) for a, b in zip(top, top[1:])) - max(score)) < 1e-9


def test_passages(spark):
    rows = fx.rows()
    found = substring_dedup.repeated_passages(fx.docs(spark)).collect()
    words = {}
    for r in rows:
        words.setdefault(r[0], words_of(r[1]))
    pairs = {(r.doc_id, r.other_id) for r in found}
    caught = {i for p in pairs for i in p}
    ids = [i * 7 % 1009 for i in range(len(fx.texts()))]
    near, exact, holders = ids[40:53], ids[53:59], ids[59:63]
    for group in ([ids[3], *near[:8]], [ids[5], *near[8:]], [ids[0], *exact], holders):
        if len(words[group[0]]) >= 60:
            assert caught >= set(group)
    assert not caught & set(ids[6:40])
    for r in found:
        assert r.n_words >= 50 and 0.8 <= r.identity <= 1
        if r.identity == 1:
            assert words[r.doc_id][r.start : r.end] == words[r.other_id][r.other_start : r.other_end]
    held = [r for r in found if r.doc_id in holders and r.other_id in holders]
    assert len(held) >= 3 and all(75 <= r.n_words <= 90 for r in held)


def test_passages_empty(spark):
    assert substring_dedup.repeated_passages(fx.empty(spark)).count() == 0


def test_repetitive_passages(spark):
    """Repeated words and lines, with periods from 1 to 40 words, chain like other passages."""
    import random

    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for i, period in enumerate((1, 2, 3, 7, 15, 17, 25, 40)):
        unit = " ".join(word() for _ in range(period))
        repeated = " ".join([unit] * (120 // period + 1))
        rows += [(10 * i + j, " ".join(word() for _ in range(30 + 7 * j)) + " " + repeated + " " + " ".join(word() for _ in range(30))) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.other_id) for r in substring_dedup.repeated_passages(docs).collect()}
    assert found == {(10 * i + j, 10 * i) for i in range(8) for j in (1, 2)}


def test_edits():
    w = lambda s: list(s)
    assert substring_dedup.edits(w("kitten"), w("sitting")) == 3
    assert substring_dedup.edits([], w("abc")) == 3
    assert substring_dedup.stretch(w("abcdexyz"), w("abcdeuvw")) == (5, 0, False)
    assert substring_dedup.stretch(w("abcde"), w("abcdeuvw")) == (5, 0, True)


def found_runs(spark, rows, id_type="long"):
    """Every 50 words that two documents share, per holder, and whether a row covers one of its places there."""
    found = substring_dedup.repeated_passages(spark.createDataFrame(rows, f"doc_id {id_type}, text string")).collect()
    spans = defaultdict(list)
    for r in found:
        spans[r.doc_id].append((r.start, r.end))
        spans[r.other_id].append((r.other_start, r.other_end))
    places = defaultdict(lambda: defaultdict(list))
    for i, t in rows:
        w = words_of(t)
        for p in range(len(w) - 49):
            places[tuple(w[p : p + 50])][i].append(p)
    held = {(i, tuple(ps)): any(s <= p and p + 50 <= e for p in ps for s, e in spans[i]) for who in places.values() if len(who) > 1 for i, ps in who.items()}
    return found, held


def test_passages_whose_halves_are_elsewhere(spark):
    """3 and 4 share 90 words of which 1 and 2 hold a half each; 12 to 14 share 60 words, with halves in 10 and 11."""
    import random

    rng = random.Random(4)
    new = lambda n: ["".join(rng.choice("abcdefghijkl") for _ in range(7)) for _ in range(n)]
    whole, other = new(90), new(60)
    docs = {1: new(20) + whole[:45] + new(9), 2: new(3) + whole[45:] + new(30), 3: new(11) + whole + new(8), 4: whole + new(40)}
    docs |= {10: other[:30] + new(30), 11: new(12) + other[30:], 12: new(5) + other, 13: other + new(7), 14: new(20) + other + new(20)}
    found, held = found_runs(spark, [(i, " ".join(w)) for i, w in docs.items()])
    assert len(held) == 2 * 41 + 3 * 11 and all(held.values())
    assert {(r.doc_id, r.other_id) for r in found} >= {(4, 3), (13, 12), (14, 12)}
    assert all(r.n_words >= 50 for r in found)
    found, held = found_runs(spark, [(f"id{i:02}", " ".join(w)) for i, w in docs.items()], "string")
    assert all(held.values()) and {(r.doc_id, r.other_id) for r in found} >= {("id04", "id03"), ("id13", "id12")}


def test_every_shared_run_is_covered(spark):
    """Random tables: several passages a pair at any distance, nested and overlapping cuts of them, edits between, long agreeing ends."""
    import random

    n = 0
    for seed in range(3):
        rng = random.Random(seed)
        new = lambda k: ["".join(rng.choice("abcdefghijkl") for _ in range(rng.choice((1, 2, 5)))) for _ in range(k)]  # noqa: E731, B023
        sources = [new(rng.choice((60, 120, 400, 1500))) for _ in range(8)]
        rows = []
        for i in range(60):
            words = new(rng.randrange(40))
            for _ in range(rng.randrange(1, 5)):
                s = rng.choice(sources)
                a = rng.randrange(len(s) - 20)
                words += s[a : a + rng.choice((25, 40, 55, 90, 700))] + new(rng.choice((0, 3, 30, 100, 200)))
            rows.append((i, " ".join(words)))
        _, held = found_runs(spark, rows)
        n += len(held)
        lost = [k for k, v in held.items() if not v]
        assert not lost, (seed, len(lost), len(held), sorted({i for i, _ in lost}))
    assert n > 1000


def test_substring_texts_are_moved_once(spark, monkeypatch):
    """Joins of texts with what is cut from them read a table that lies by document already."""
    plans, write = [], substring_dedup.staged

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(substring_dedup, "staged", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = spark.catalog.listTables()
        assert substring_dedup.repeated_passages(fx.docs(spark)).count() > 0
        assert len(spark.catalog.listTables()) == len(tables)  # it is gone again
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    aligned = [p for name, p in plans if name == "passage-aligned"]
    assert aligned and all("SelectedBucketsCount" in p for p in aligned)


def test_seeds_of_texts_together_are_those_of_each():
    rng = random.Random(5)
    texts = ["", "a", "a b c d e", "x " * 400, "one two three four five six " * 40, *(fx.prose(rng, n) for n in (3, 19, 20, 21, 22, 90, 400))] * 2
    h, text, *rest = substring_dedup.minimizers_of(*substring_dedup.words_hashed([t.encode() for t in texts]), 5, 16)
    for i, t in enumerate(texts):
        alone = substring_dedup.minimizers(substring_dedup.word_hashes(t), 5, 16)
        assert sorted(zip(*(v[text == i].tolist() for v in (h, *rest)))) == sorted(zip(*(v.tolist() for v in alone)))
