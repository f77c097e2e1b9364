"""Ranked search, exact duplicates and fill-in-the-middle against brute force, with odd rows."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from tidemark.llm import exact_dedup as X
from tidemark.llm import fill_in_middle as M
from tidemark.llm import ranked_search as R

DOCS = "doc_id long, text string, score string, tidemark_sha long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def ranked(docs, items, top):
    bags = [(i, terms(t)) for i, t in docs]
    total, length = sum(1 for _, b in bags if b), sum(len(b) for _, b in bags)
    counts = [(i, len(b), collections.Counter(b)) for i, b in bags]
    df = collections.Counter(t for _, _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, n, c in counts:
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    m = 50 + (50 * n * total) // length
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def texts():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([3, 20, 100])))) for i in range(400)]
    docs += [(1000 + i, docs[5][1]) for i in range(70)]  # ties beyond the cut
    docs += [(None, docs[5][1]), (3, docs[3][1]), (2000, None), (2001, ""), (2002, " ,.; "), (2003, "Äpfel w1 ÄPFEL x" * 3), (2004, "w7 " * 60000 + "rare")]
    items = [(i, " ".join(rng.choices(vocabulary, weights, k=k))) for i, k in enumerate([1, 3, 8, 40, 200])]
    items += [(10, docs[5][1]), (11, None), (12, ""), (13, "w1"), (14, "rare w299 Äpfel"), (15, "nowhere at all"), (13, "w2 W2 w3"), (None, "w4 w5")]
    return docs, items


@pytest.mark.parametrize("slice_docs, postings, block", [(16, 1 << 20, 1 << 20), (1 << 14, 50, 700)])
def test_ranked_search(spark, monkeypatch, slice_docs, postings, block):
    """Scores, ties and ranks equal full evaluation, whatever the slices and blocks of items."""
    docs, items = texts()
    monkeypatch.setattr(R, "SLICE_DOCS", slice_docs)
    monkeypatch.setattr(R, "SLICE_POSTINGS", postings)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS).repartition(3)
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank long")
    top = 5 if slice_docs == 16 else 50
    got = R.search(df, bench, top, block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == ranked(docs, items, top)


def test_ranked_search_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert R.search(docs.limit(0), items).count() == 0 and R.search(docs, items.limit(0)).count() == 0
    assert R.search(docs.selectExpr("doc_id", "cast(null as string) text"), items).count() == 0


def test_sorted_reads_stop_early():
    """With one list far ahead of the others, NRA does not read to the end, and gives final scores all the same."""
    rng = np.random.default_rng(1)
    n = 20000
    high = np.sort(rng.integers(1, 100, n))[::-1]
    high[:10] += 10_000_000
    doc = rng.permutation(n)
    own = R.Slice(2, n, np.zeros(n, dtype=np.int64), doc, high)
    assert sorted(own.best(np.array([0]), 10, 0)[0]) == sorted(doc[:10])
    both = R.Slice(2, n, np.repeat([0, 1], n), np.concatenate([doc, np.arange(n)]), np.concatenate([high, np.full(n, 3)]))
    found, score = both.best(np.array([0, 1]), 10, 0)
    assert dict(zip(found.tolist(), score.tolist(), strict=True)) == {int(d): int(h) + 3 for d, h in zip(doc[:10], high[:10], strict=True)}
    assert len(both.best(np.array([0, 1]), 10, 10**9)[0]) == 0


def copies():
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("ab \n", k=rng.randint(0, 12)))) for i in range(300)]
    rows += [(1000 - i, "hot  text" + " " * (i % 4)) for i in range(200)]
    rows += [(None, "hot text       "), (None, "only once"), (5000, None), (5001, " \t\n\x0b\x0c\r"), (5002, " x"), (5003, "x"), (5004, "é\U0001F600" * 5), (5005, " é\U0001F600" * 5), (5006, "long " * 50000), (7, rows[7][1]), (7, rows[7][1])]
    return rows


@pytest.mark.parametrize("broadcast", [0, 1 << 20])
def test_exact_duplicates(spark, broadcast):
    rows = copies()
    groups = collections.defaultdict(list)
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for i, t in rows:
        groups[plain(t)].append((-len(t or ""), i is None, i or 0))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(3)
    got = X.exact_duplicates(df, broadcast).collect()
    best = {hashlib.sha256(g.encode()).hexdigest(): min(m) for g, m in groups.items()}
    size = {hashlib.sha256(g.encode()).hexdigest(): len(m) for g, m in groups.items()}
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
    for r in got:
        _, unnamed, keep = best[r.text_sha256]
        assert r.group_size == size[r.text_sha256] and r.keep_id == (None if unnamed else keep)
        assert not r.kept or r.doc_id == r.keep_id
    want = collections.Counter((i, hashlib.sha256(plain(t).encode()).hexdigest()) for i, t in rows)
    assert collections.Counter((r.doc_id, r.text_sha256) for r in got) == want
    left = X.deduplicated(df, broadcast)
    assert left.columns == df.columns
    assert sorted((-len(r.text or ""), r.doc_id is None, r.doc_id or 0) for r in left.collect()) == sorted(best.values())


def test_exact_duplicates_empty(spark):
    empty = spark.createDataFrame([], DOCS)
    assert X.exact_duplicates(empty).count() == 0 and X.deduplicated(empty).count() == 0
    one = spark.createDataFrame([(1, None, None, None)], DOCS)
    assert [tuple(r)[:4] for r in X.exact_duplicates(one).collect()] == [(1, 1, 1, True)]


def test_filter_probes_and_passes(spark):
    """Rows of texts met once pass straight through but for the filter's few false positives; no repeated one does."""
    rows = spark.range(4000).selectExpr("sha2(cast(if(id < 1000, id % 500, id) as string), 256) as tidemark_sha")
    words = 4000 * X.ROW_BITS // 64
    got = X.probed(rows, X.repeated_bits(rows, words), words).groupBy("tidemark_maybe").count().collect()
    maybe = {r[0]: r[1] for r in got}
    assert 1000 <= maybe[True] < 1200 and maybe[False] > 2800


def fim(doc_id, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choices(["ab", "C", " ", "<", "P", "S>", "M", "é", "\U0001F600", "7", "\n", "\x00", "中"], k=rng.randint(0, 30)))) for i in range(500)]
    rows += [(None, "one two three"), (600, None), (601, ""), (602, "with <M> inside"), (603, "<<S"), (604, "é" * 100_000), (605, "word " * 60_000), (5, rows[5][1])]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, form string, source string").repartition(3)
    made = M.transform(df)
    assert made.columns[:3] == ["doc_id", "text", "source"]
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    got = collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.output_sha256, r.restored_sha256) for r in made.collect())
    want = collections.Counter((i, *(w := fim(i, t)), sha(w[-1]), sha(t)) for i, t in rows)
    assert got == want
    assert {f for _, _, f, *_ in got} == {"plain", "psm", "spm"}
    back = M.restored(made).select("text", "restored").collect()
    assert all((r.text or "") == r.restored for r in back) and len(back) == len(rows)
    lean = M.transform(df, render=False)
    assert "output" not in lean.columns and lean.where("output_sha256 is null").count() == 0
    assert M.transform(df.limit(0)).count() == 0


def test_piece_table():
    """Cuts keep the text, at its ends too; the inverse of an arrangement is the text's own order; descriptors never overlap."""
    text = b"abcdefghij"
    buffers = (memoryview(text), memoryview(M.SENTINELS))
    for a in range(11):
        for b in range(a, 11):
            parts = M.cut(M.cut([M.Piece(M.TEXT, 0, 10)], a), b)
            assert [p.length for p in parts] == [a, b - a, 10 - b] and b"".join(M.stream(parts, buffers)) == text
            for form in M.LAYOUT:
                output = b"".join(M.stream(M.arranged(parts, form), buffers))
                back = M.inverted(M.located(output, form), form)
                assert b"".join(M.stream(back, (memoryview(output), buffers[1]))) == text
                assert M.sha256(M.arranged(parts, form), buffers) == hashlib.sha256(output).hexdigest()
