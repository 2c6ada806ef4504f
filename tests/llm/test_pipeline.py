"""The pipeline against a brute-force version of its stages."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from clientela.llm import attention, stages
from test_dedup import brute_components, brute_runs

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id string, score double"


def rows_of(prose):
    words = lambda n, seed: prose(n, seed)
    block = "\n".join(words(12, 900 + i) for i in range(4))
    item = words(30, 777)
    rows = []
    for i in range(120):
        text = "\n".join(words(15, 1000 + 10 * i + j) for j in range(5))
        if i % 4 == 3:
            text = " | ".join(words(60, 1000 + i).split()) + " ### $$$ %%% |" * 20
        rows.append((i, text))
    rows += [(200 + i, words(20, 2000 + i) + "\n" + block + "\n" + words(20, 3000 + i)) for i in range(5)]
    rows += [(300 + i, rows[0][1].replace("\n", " ") + f" tail{i}") for i in range(4)]
    rows += [(400, words(40, 4000) + " " + item + " " + words(40, 4001)), (401, item)]
    rows += [(500, block), (501, None), (502, ""), (None, words(40, 5000)), (503, rows[4][1]), (503, rows[4][1]), (504, "x " * 40_000)]
    return rows, item


@pytest.fixture
def folder(spark, prose, tmp_path):
    rows, item = rows_of(prose)
    full = [(i, t, None, "s", len(t or ""), "clash", 0.5) for i, t in rows]
    spark.createDataFrame(full, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 0 if i % 4 == 3 else 1, 0) for i in range(120)] + [(1, None, None), (None, 1, 0), (9999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), item


def test_run_equals_brute_force(spark, folder):
    d, item = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = corpus_pipeline.run(spark, d)
    assert got.columns == [*docs.columns, "n_tokens", "ids", "decoded_same"]

    model = attention.train(docs, spark.read.parquet(f"{d}/labels.parquet"), stages.fold(F.col("doc_id"), 5) != 0)
    good = {r.doc_id for r in attention.score(docs, model).collect() if r.score >= 0.3}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    assert {i for i, _ in rows if i is not None and i < 120} == {i for i in range(120) if i % 4 != 3}

    gone = brute_runs(rows)
    left = []
    for i, t in rows:
        cut = {k for j, k in gone if j == i and i is not None}
        if cut:
            t = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut)
            if not t.split():
                continue
        left.append((i, t))
    component, _ = brute_components(left)
    left = [(i, t) for i, t in left if i is None or component[i] == i]
    left = [(i, t) for i, t in left if i is None or item.lower() not in (t or "").lower()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((str(i), str(t), len(t or ""), str(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in left)
    found = sorted((str(r.doc_id), str(r.text), r.n_chars or 0, str(r.ids)) for r in got.collect())
    assert [x[0] for x in found] == [x[0] for x in want] and found == want
    assert all(r.decoded_same and r.id == "clash" and r.score == 0.5 for r in got.collect())


def test_empty_tables(spark, folder, tmp_path):
    d, _ = folder
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{d}/{name}.parquet").limit(0).write.parquet(str(tmp_path / "empty" / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0
