"""The pipeline's stages take effect, and keep clean documents and the columns of documents."""

import os
import random

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(pipeline.STAGES) - 1:
            assert sorted(out.columns) == sorted(names)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = docs.count()
        if name in ("toxicity", "ngram_jaccard_join", "benchmark_decontamination"):
            assert 0.6 * before < after < before
        elif name == "secret_scan":
            assert after == before and docs.where("contains(text, '[SECRET]')").count() > 0
        before = after
    assert {"doc_id", "sequence_id", "offset"} <= set(docs.columns)
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "differencing_packing"]


WORDS = [f"w{i}" for i in range(900)]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VILE = "you filthy rotten bastards go away and die".split()


def small_corpus(rng):
    """Rows with ids of every case: clean, toxic, copies, leaks, secrets, odd ones; and the items and labels."""
    prose = lambda k: " ".join(rng.choices(WORDS, k=k))
    items = [(i, prose(30)) for i in range(3)]
    rows = [(i, prose(rng.choice([20, 80, 200]))) for i in range(150)]
    rows += [(200 + i, " ".join(rng.choices(VILE + WORDS[:20], [20] * len(VILE) + [1] * 20, k=40))) for i in range(150)]
    labels = [(i, 1, int(i >= 200)) for i, _ in rows]
    rows += [(400 + i, rows[i][1]) for i in range(3)]
    rows += [(500, f"{prose(20)} {items[0][1]} {prose(20)}"), (None, f"{prose(20)} {items[1][1]}"), (None, prose(50)), (501, f"{prose(10)} password = {'abcD1234' * 3} {prose(10)}")]
    rows += [(502, None), (503, ""), (504, "  "), (7, rows[7][1]), (505, prose(40000))]
    return [(i, t, "en", "s", len(t or "")) for i, t in rows], items, labels


@pytest.mark.parametrize("clash", [False, True])
def test_run_on_odd_rows(spark, tmp_path, clash):
    """`run` on nulls, repeats, rows without id, empty and very long texts, and extra columns: what goes, goes; all else is packed once."""
    rows, items, labels = small_corpus(random.Random(12))
    docs = spark.createDataFrame(rows, DOCS)
    if clash:
        docs = docs.selectExpr("*", "'x' as score", "1 as tidemark_key", "'y' as item_id", "2 as start", "3 as tidemark_spans", "4 as sequence_id")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in out}
    assert not ids & {400, 401, 402, 500} and len(ids & set(range(200, 350))) <= 3
    assert len(ids & set(range(150))) >= 147 and {501, 505, None} <= ids
    # each id of a document lies in exactly one piece, and sequences are gapless
    whole = {}
    for r in out:
        whole.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    for pieces in whole.values():
        if len({p[2] for p in pieces}) == 1:
            assert sum(p[1] for p in pieces) % pieces[0][2] == 0
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for at in places.values():
        at.sort()
        assert at[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(at, at[1:], strict=False)) and sum(at[-1]) <= 1024


def test_run_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
