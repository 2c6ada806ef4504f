"""Token files against the tokenizers library, and what their layout lets readers skip."""

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from clientela.llm import tokenfiles

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def table(spark, rows):
    full = [(i, t, 3, 4, "p") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, offset int, ids int, part string").repartition(5)


def want(library, rows):
    """(doc_id, start, n_tokens, crc) by the definition, for rows of different ids."""
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]


@pytest.fixture
def written(spark, library, tmp_path):
    r = random.Random(1)
    rows = [(i * 3, " ".join(r.choice(["the", "Adoó", "x1", "\n", "<|endoftext|>", "日本", "!", "\x1c", ""]) for _ in range(r.randint(0, 60)))) for i in range(900)]
    rows += [(None, "no id"), (1, None), (2, ""), (4, "long words " * 40_000)]
    folder = str(tmp_path / "made")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tokenfiles.write_tokens(table(spark, rows), folder, PATH, 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return folder, rows


def test_equal_to_the_library(spark, library, written):
    folder, rows = written
    assert rows_of(tokenfiles.checksums(tokenfiles.read_tokens(spark, folder))) == want(library, rows)
    files = tokenfiles.files_of(spark, folder).orderBy("part").collect()
    assert len(files) > 1 and sum(f.documents for f in files) == len(rows)
    assert all(a.last_id < b.first_id and a.base + a.tokens == b.base for a, b in zip(files, files[1:]))


def test_parts_are_read_by_themselves(spark, library, written):
    folder, rows = written
    flat = []
    for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        flat += [*library.encode(t or "", add_special_tokens=False).ids, 2]
    for first, count in ((0, 5), (17, 4000), (len(flat) - 3, 50), (len(flat), 5), (1000, 0)):
        got = tokenfiles.read_stretch(spark, folder, first, count).orderBy("first_token").collect()
        assert [x for r in got for x in r.ids] == flat[first:first + count]
        assert not got or got[0].first_token == first
    some = tokenfiles.read_ids_between(spark, folder, 30, 60)
    assert {r.doc_id for r in some.collect()} == set(range(30, 61, 3))
    plan = some._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,30)" in plan.split("PushedFilters")[1]
    narrow = tokenfiles.read_tokens(spark, folder).select("doc_id", "start", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in narrow


def test_layout(spark, library, tmp_path, monkeypatch):
    """Encodings, bounded row groups and pages, page indexes; footers alone find a document's group."""
    monkeypatch.setattr(tokenfiles, "ROW_GROUP_BYTES", 1 << 16)
    monkeypatch.setattr(tokenfiles, "PAGE_BYTES", 1 << 12)
    monkeypatch.setattr(tokenfiles, "PAGE_ROWS", 50)
    r = random.Random(2)
    rows = [(i, " ".join(str(r.randint(0, 999)) for _ in range(100))) for i in range(3000)]
    folder = str(tmp_path / "made")
    tokenfiles.write_tokens(table(spark, rows), folder, PATH, 2)
    footers = [pq.ParquetFile(f).metadata for f in glob.glob(f"{folder}/tokens/*.parquet")]
    groups = [m.row_group(i) for m in footers for i in range(m.num_row_groups)]
    columns = [{g.column(i).path_in_schema: g.column(i) for i in range(g.num_columns)} for g in groups]
    assert len(groups) >= 5
    for c in columns:
        ids = c["ids.list.element"]
        assert "RLE_DICTIONARY" in ids.encodings and ids.total_uncompressed_size < 1 << 19
        assert all("DELTA_BINARY_PACKED" in c[k].encodings for k in ("doc_id", "at", "offset"))
        assert all(x.has_offset_index for x in c.values()) and c["doc_id"].has_column_index
    holding = [c for c in columns if c["doc_id"].statistics.min <= 1234 <= c["doc_id"].statistics.max]
    assert len(holding) == 1
    assert tokenfiles.read_ids_between(spark, folder, 1234, 1234).first().n_tokens == len(library.encode(rows[1234][1], add_special_tokens=False).ids) + 1


def test_repeated_rows_and_ids(spark, library, tmp_path):
    rows = [(7, "same text")] * 500 + [(7, f"text {i}") for i in range(50)] + [(8, "last"), (None, None), (None, None)]
    tokenfiles.write_tokens(table(spark, rows), str(tmp_path / "made"), PATH, 2)
    got = rows_of(tokenfiles.checksums(tokenfiles.read_tokens(spark, str(tmp_path / "made"))))
    assert len(got) == len(rows) and [g[0] for g in got] == [None] * 2 + [7] * 550 + [8]
    assert [g[1] for g in got] == np.cumsum([0, *(g[2] for g in got)])[:-1].tolist()
    crc = lambda t: zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert sorted(g[3] for g in got) == sorted(crc(t) for _, t in rows)


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "made")
    tokenfiles.write_tokens(table(spark, []), folder, PATH, 2)
    assert tokenfiles.checksums(tokenfiles.read_tokens(spark, folder)).count() == 0
    assert tokenfiles.read_stretch(spark, folder, 0, 10).count() == 0
