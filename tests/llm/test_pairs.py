"""Near-duplicate operators against brute force, with nulls, repeats, ties and empty tables."""

import random
import re

import numpy as np
import pytest

from tidemark.llm import common
from tidemark.llm import decontamination as D
from tidemark.llm import embedding_dedup as E
from tidemark.llm import ngram_join as J
from tidemark.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_pairs(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001), (5001, 5001)]
    random.Random(1).shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long").repartition(7)).collect()}
    assert got == roots({x for p in links for x in p}, links)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts = [None, "", "  \n\t ", "one", "One", "two words", "ÄÖ ä b c d e"]
    for k in range(30):
        base = rng.choices(vocabulary, k=rng.choice([6, 20, 60, 300]))
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 6])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else "\n".join([" ".join(copy)]))
    # a chain whose ends don't link, a passage that many share, a very long text and its edited copy
    chain = rng.choices(vocabulary, k=200)
    for i in range(0, 30, 3):
        texts.append(" ".join(chain[i : i + 170]))
    texts += [" ".join(rng.choices(vocabulary, k=40)) + " " + passage for _ in range(40)]
    long = rng.choices(vocabulary, k=30000)
    texts += [" ".join(long), " ".join([*long[:-50], *rng.choices(vocabulary, k=50)])]
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def test_jaccard_components(spark):
    rows = corpus()
    sets = {r[0]: shingles(r[1]) for r in rows}
    links = []
    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                links.append((i, j))
    want = roots(sets, links)
    # repeated rows, a row without id, and columns whose names the operator uses itself
    df = spark.createDataFrame([*rows, rows[10], (None, rows[10][1], "en", "s", 1)], DOCS).withColumnsRenamed({"lang": "fp", "source": "key"})
    got = J.jaccard_components(df.repartition(5)).collect()
    assert len(got) == len(rows) + 2
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {(i, len(sets[i]), want[i]) for i in sets}
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert len(set(want.values())) < len(want) - 40


@pytest.mark.parametrize("words", [1, 2, 1 << 20])
def test_key_filter_misses_no_key(spark, monkeypatch, words):
    """Every key passes, however full the filter is; with room, few others do."""
    monkeypatch.setattr(common, "FILTER_WORDS", words)
    keys = spark.range(3000).selectExpr("if(id % 100 = 0, null, id * 7) as k")
    rows = spark.range(42000).selectExpr("if(id % 1000 = 1, null, id) as id", "id % 3 as tidemark", "'x' as k")
    got = common.KeyFilter(keys, "k").marked(rows, "id")
    assert got.columns == ["id", "tidemark", "k", "tidemark_maybe"] and got.count() == 42000
    passed = {r.id for r in got.where("tidemark_maybe").collect()}
    want = {i * 7 for i in range(3000) if i % 100} & {i for i in range(42000) if i % 1000 != 1}
    assert want <= passed and None not in passed and (words < 3 or len(passed) < len(want) + 500)
    assert common.KeyFilter(keys.limit(0), "k").passing(rows, "id").count() == 0


def test_decontamination_with_many_items(spark, monkeypatch):
    """The same rows above the broadcast's bound, where shingles pass the filter and are joined by a shuffle."""
    rng = random.Random(4)
    words = [f"v{i}" for i in range(800)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([2, 7, 25])))) for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, k=60) + items[i % 40][1].split() * (i % 3 == 0))) for i in range(200)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(tuple, D.contaminated(df, bench).collect()))
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, D.contaminated(df, bench).collect())) == want and len(want) >= 60


def test_keep_one(spark):
    rows = [(1, "a b c d e", "en", "s", 1), (2, "A b c d e", "en", "s", 1), (3, "x y z q r", "en", "s", 1), (3, "x y z q r", "en", "s", 1), (4, None, "en", "s", 0), (5, None, None, None, None)]
    got = sorted(J.keep_one(spark.createDataFrame(rows, DOCS)).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == [1, 3, 4, 5]
    assert J.jaccard_components(spark.createDataFrame([], DOCS)).count() == 0


def test_keep_one_shuffles_no_text_that_goes(spark, monkeypatch):
    """Copies that go, and the ones that stay for them, are settled by id and hash; their texts stay where they are."""
    rng = random.Random(11)
    texts = [" ".join(rng.choices([f"v{i}" for i in range(500)], k=30)) for _ in range(305)]
    rows = [(i, texts[i % 5] if i < 500 else texts[i - 495]) for i in range(800)]
    sent = []

    def counted(df, *args, **kwargs):
        out = common.written(df, *args, **kwargs)
        if "text" in out.columns and "doc_id" in out.columns:
            sent.append(out.count())
        return out

    monkeypatch.setattr(J, "written", counted)
    got = J.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in got.collect()) == [*range(5), *range(500, 800)]
    assert sum(sent) < 40


def test_meetings_keep_every_similar_pair(spark):
    """Sets that share enough shingles still meet; most of the chance meetings are gone."""
    rng = random.Random(12)
    n, least = 400, J.least_shared(340, 85)
    sent = {}
    for i in range(120):
        own = sent[i] = {}
        for _ in range(rng.randint(1, 25)):
            g = rng.randrange(150)
            own[g] = own.get(g, 0) + 1
        if i % 2:
            # shares its shingles with the one before in a few groups, just enough of them in all
            for g in rng.sample(range(150), rng.choice([1, 2, least])):
                for j in (i - 1, i):
                    sent[j][g] = sent[j].get(g, 0) + least
    rows = [(g, n, i, n, k) for i, own in sent.items() for g, k in own.items()]
    rows += [(1000, n, 500, n, least - 1), (1001, n, 500, n, 1), (1002, n, 501, n, least)]
    got = {(r.fp, r.g) for r in J.meetings(spark.createDataFrame(rows, "g long, m long, fp long, n long, k long"), 85).collect()}
    assert got <= {(r[2], r[0]) for r in rows}
    kept = {i: {g for f, g in got if f == i} for i in sent}
    for i in sent:
        for j in range(i):
            if sum(min(k, sent[j].get(g, 0)) for g, k in sent[i].items()) >= least:
                assert kept[i] & kept[j]
    assert not any(f >= 500 for f, _ in got) and len(got) < 0.8 * len(rows)


def test_tiles_of_large_mixed_groups(spark, monkeypatch):
    """Groups above the tile size go through the banded tiles and lose no pair."""
    monkeypatch.setattr(J, "TILE", 4)
    rng = random.Random(3)
    shared = [f"s{i}" for i in range(8)]
    rows = []
    for i in range(30):
        rows.append((i, " ".join([*shared, *(f"{i // 2}-{k}" for k in range(14)), str(i)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: shingles(t) for i, t in rows}
    links = [(i, j) for i in sets for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    want = roots(sets, links)
    rng.shuffle(rows)
    assert {r.doc_id: r.component_id for r in J.jaccard_components(df).collect()} == want


def test_keep_one_decides_by_row(spark):
    """An id that stands for two texts loses only the copy; rows without id are copies like others."""
    one, two, three = "a b c d e f g", "p q r s t u v", "k l m n o"
    rows = [(2, one), (5, one), (5, two), (7, two), (None, two), (None, three), (None, three), (None, None), (9, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, h string, rows long")
    got = sorted(((r.doc_id, r.text) for r in J.keep_one(df).collect()), key=str)
    assert got == sorted([(2, one), (5, two), (None, three), (None, None), (9, None)], key=str)
    assert J.keep_one(df).columns == df.columns
    assert J.keep_one(df.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [16, 4096])
def test_large_near_copy_groups_and_strays(spark, monkeypatch, tile):
    """One original with many edited copies, variants of it that don't link, and strays that share a part of it."""
    monkeypatch.setattr(J, "TILE", tile)
    monkeypatch.setattr(J, "PARTNERS", 32)
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(3000)]
    base = rng.choices(vocabulary, k=120)

    def edited(words, times):
        out = list(words)
        for _ in range(times):
            out[rng.randrange(len(out))] = rng.choice(vocabulary)
        return out

    texts = [edited(base, rng.randint(0, 4)) for _ in range(150)]
    for _ in range(6):
        variant = edited(base, 9)
        texts += [edited(variant, rng.randint(0, 3)) for _ in range(12)]
    texts += [base[20:60] + rng.choices(vocabulary, k=rng.randint(5, 90)) for _ in range(40)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    sets = {i: shingles(t) for i, t in rows}
    links = [(i, j) for i in sets for j in sets if j < i and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    got = {r.doc_id: r.component_id for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == roots(sets, links)


VECTORS = "vec_id long, embedding array<float>, label int, keys string"


def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        rows.append((i, rng.standard_normal(32).astype(np.float32).tolist(), i % 3, "x"))
    for i in range(400, 700):
        base = np.array(rows[i % 20][1])
        noise = rng.standard_normal(32) * rng.choice([0.0, 0.05, 0.15, 0.25])
        rows.append((i, (base * rng.uniform(0.5, 2) + noise).astype(np.float32).tolist(), rows[i % 20][2], "x"))
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0, 2.0]]
    rows += [(700 + i, v, 1, "x") for i, v in enumerate(odd)]
    rows += [(710, rows[0][1], None, "x"), (711, rows[0][1], 0, None)]
    return rows


def test_embeddings(spark):
    rows = vectors()
    units = {r[0]: E._unit(r[1]) if r[2] is not None else None for r in rows}
    label = {r[0]: r[2] for r in rows}
    links = []
    good = [i for i, u in units.items() if u is not None]
    for a in good:
        for b in good:
            if b < a and label[a] == label[b] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.98:
                links.append((a, b))
    got = {r.vec_id: r for r in E.near_duplicates(spark.createDataFrame(rows, VECTORS).repartition(3)).collect()}
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got.values()) / 2
    assert len(links) > 500 and 0.97 * len(links) <= found <= len(links)
    want = roots(units, links)
    assert sum(got[i].component_id == want[i] for i in want) >= 0.98 * len(want)
    for i in (*range(700, 707), 710):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[711].component_id == 0 and got[711].n_links >= 1


def test_null_parts_join_no_class(spark):
    """Vectors with a null or non-finite part don't take equal ones without it along, whichever comes first."""
    nan, inf = float("nan"), float("inf")
    vs = [[1.0, 2.0, None], [1.0, 2.0], [None, 1.0, 2.0], [1.0, 2.0], [1.0, nan, 2.0], [inf, 1.0], [1.0, 2.0, 0.0], [0.0, 0.0], [], None, [2.0, 4.0]]
    rows = [(i, v, 1) for i, v in enumerate(vs)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1)).collect()}
    assert got == {i: (2, 1) if i in (1, 3, 10) else (0, i) for i in range(len(vs))}


def test_shape_follows_the_number_of_vectors():
    """Strangers met a table stay bounded, and pairs at the threshold are found with the same chance, at any size."""
    near, far = E._meeting(0.2), E._meeting(2**0.5)
    for n in (1, 10**4, 10**7, 10**10):
        projections, tables = E.shape(n, 0.98)
        assert n * far**projections <= E.STRANGERS
        assert (1 - near**projections) ** tables <= E.MISS


def test_embeddings_tiles_and_empty(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE", 16)
    rng = np.random.default_rng(9)
    base = rng.standard_normal(16)
    rows = [(i, (base + rng.standard_normal(16) * 0.01).astype(np.float32).tolist(), 0) for i in range(100)]
    got = E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert all(r.n_links == 99 and r.component_id == 0 for r in got)
    assert E.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_decontamination(spark):
    rng = random.Random(2)
    words = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(words, k=k))) for i, k in enumerate([5, 9, 15, 30, 60, 200])] + [(90, "too short"), (91, None), (92, "")]
    docs = []
    for i, (_, t) in enumerate(items[:6]):
        noise = lambda k: " ".join(rng.choices(words, k=k))
        docs.append((i, f"{noise(50)}, {t.upper()}! {noise(3000)}"))
        w = t.split()
        w[len(w) // 2] = "changed"
        docs.append((20 + i, f"{noise(10)} {' '.join(w)} {noise(10)}"))
        docs.append((40 + i, noise(400)))
    docs += [(60, None), (61, ""), (62, "v1 v2"), (None, items[3][1])]
    found = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    grams = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    want = set()
    for d, t in docs:
        for i, s in items:
            k = min(5, len(found(s)))
            g = grams(found(s), k) if k else set()
            if g and d is not None and 10 * len(g & grams(found(t), k)) >= 8 * len(g):
                want.add((d, i, len(g), len(g & grams(found(t), k))))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(df.repartition(3), bench).collect()
    assert {(r.doc_id, r.item_id, r.n_item, r.n_contained) for r in got if r.doc_id is not None} == want and len(want) >= 8
    left = {r.doc_id for r in D.decontaminated(df, bench).collect()}
    assert left == {d for d, _ in docs} - {w[0] for w in want} - {None}
    assert D.contaminated(df.limit(0), bench).count() == 0 and D.contaminated(df, bench.limit(0)).count() == 0


def test_decontamination_by_row(spark):
    """A leak in a row without id is reported, and a clean text stays though its id also stands for a leaking one."""
    item, clean = "the quick brown fox jumps over a lazy dog", "nothing of the sort is to be found in here"
    df = spark.createDataFrame([(1, f"so {item} so"), (1, clean), (2, clean), (None, item), (None, clean)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.item_id, r.n_contained) for r in D.contaminated(df, bench).collect()) == [(0, 7, 5), (1, 7, 5)]
    left = D.decontaminated(df, bench)
    assert left.columns == df.columns and {(r.doc_id, r.text) for r in left.collect()} == {(1, clean), (2, clean), (None, clean)}


def test_short_items(spark):
    """Items of one to four words are found where their words stand in order; by default they drop nothing."""
    items = [(1, "Zulu"), (2, "red fox"), (3, "the red, fox"), (4, "one two three four"), (5, "ab cd ef gh ij"), (6, " ,. "), (6, "RED fox")]
    docs = [(1, "a zulu!"), (2, "zulus"), (3, "fox red"), (4, "The RED\nfox ran"), (5, "one two three"), (6, "zero one two three four five"), (7, "red"), (8, ""), (9, None), (10, "ab cd ef gh ij"), (None, "red-fox")]
    df = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, size long, item string")
    bench = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, shingle int")
    got = sorted(((r.doc_id, r.item_id, r.n_item, r.n_contained, r.containment) for r in D.contaminated(df, bench).collect()), key=str)
    assert got == sorted([(1, 1, 1, 1, 1.0), (4, 2, 1, 1, 1.0), (4, 6, 1, 1, 1.0), (4, 3, 1, 1, 1.0), (6, 4, 1, 1, 1.0), (10, 5, 1, 1, 1.0), (None, 2, 1, 1, 1.0), (None, 6, 1, 1, 1.0)], key=str)
    assert D.decontaminated(df, bench).count() == len(docs) - 1 and D.decontaminated(df, bench).columns == df.columns
    assert sorted((r.doc_id or 0) for r in D.decontaminated(df, bench, least_words=1).collect()) == [2, 3, 5, 7, 8, 9]
