"""Cross-tokenizer alignment against a plain definition, and the libraries' whole-text encoding."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from clientela.llm import align, bpe, encoders

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
POOL = ["a", "the ", " and", "tion", " ", "  ", "\n", "\n  ", "\t", "é", "日本", "😀", "12", "!", ", ", "\x1c", "\x85", " ", "　",
        "<|endoftext|>", "'s", "Lorem", "ipsum.", "▁", "a" * 30, "½", "{x: 1}", " ", "e.g."]


def texts(n=400):
    r = random.Random(4)
    return [*("".join(r.choice(POOL) for _ in range(r.randint(0, 25))) for _ in range(n)),
            "word " * 3000, "aé" * 2500, "", None, " ", "  x ", "▁", "the and", "the and", "\n \n"]


@pytest.fixture(scope="module")
def both():
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    return library, SentencePieceProcessor(model_file=B)


def plain(both, rows):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, digest), by the definition."""
    library, pieces = both
    letters = bpe.byte_letters()
    tokens = []
    for text in rows:
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        say_a = [bytes(letters[c] for c in library.id_to_token(i)) for i in a]
        say_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if text and not b"".join(say_a) == b"".join(say_b) == (" " + text).encode():
            a = b = say_a = say_b = []
        tokens.append((a, b, [len(x) for x in say_a], [len(x) for x in say_b]))
    spans = lambda widths: [(sum(widths[:k]), sum(widths[:k + 1])) for k in range(len(widths))]
    out, held = [], Counter()
    for a, b, wide_a, wide_b in tokens:
        if len(a) > 500:  # long texts: one end at a time
            pos_a, pos_b, links, i, j = 0, 0, [], 0, 0
            while i < len(a):
                links.append((i, j))
                end_a, end_b = pos_a + wide_a[i], pos_b + wide_b[j]
                if end_a <= end_b:
                    pos_a, i = end_a, i + 1
                if end_b <= end_a:
                    pos_b, j = end_b, j + 1
            ends_a, ends_b = [], []
            for widths, ends in ((wide_a, ends_a), (wide_b, ends_b)):
                total = 0
                for w in widths:
                    total += w
                    ends.append(total)
        else:
            at_a, at_b = spans(wide_a), spans(wide_b)
            links = [(i, j) for i, (s, e) in enumerate(at_a) for j, (s2, e2) in enumerate(at_b) if s < e2 and s2 < e]
            ends_a, ends_b = [e for _, e in at_a], [e for _, e in at_b]
        shared, groups, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
        for end in shared:
            i2, j2 = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        pairs = [(a[i], b[j]) for i, j in links]
        held.update(set(pairs))
        out.append((len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    return [(n, m, g, len(p), sum(held[x] == most[x[0]] for x in p), sum(held[x] for x in p), h) for n, m, g, p, h in out]


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "r", 2) for i, t in enumerate(rows)], "doc_id long, text string, row int, pairs string, n int")


def got(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


def test_the_libraries_ids(both, monkeypatch):
    library, pieces = both
    a, b = encoders.byte_level(open(A, encoding="utf-8").read(), plain=True), encoders.piece_model(open(B, "rb").read())
    some = [t for t in texts(3000) if t] + ["x" * 40_000, "^" * 40_000 + "y", " " * 40_000 + "z", "日本語" * 9000]
    for long in (encoders.LONG, 7):  # long texts are given to the piece model in parts
        monkeypatch.setattr(encoders, "LONG", long)
        for t, x, y in zip(some, a.ids([" " + t for t in some]), b.ids(some), strict=True):
            assert np.frombuffer(x, np.int32).tolist() == library.encode(" " + t, add_special_tokens=False).ids
            assert np.frombuffer(y, np.int32).tolist() == pieces.encode(t)


def test_every_character_is_split_as_the_library_splits(both):
    """Both libraries class letters, digits and white space alike."""
    library, _ = both
    a = encoders.byte_level(open(A, encoding="utf-8").read(), plain=True)
    some = [" ".join(f"a{c}b 1{c}{c}2 !{c}? {c}  {c}" for c in map(chr, range(n, n + 64)) if not "\ud800" <= c <= "\udfff")
            for n in range(0, 0x30000, 64)]
    want = library.encode_batch(some, add_special_tokens=False)
    assert all(np.frombuffer(x, np.int32).tolist() == w.ids for x, w in zip(a.ids(some), want, strict=True))


def test_equal_to_the_definition(spark, both, monkeypatch):
    rows = texts()
    want = dict(enumerate(plain(both, rows)))
    assert got(align.alignment(table(spark, rows), A, B)) == want
    monkeypatch.setattr(align, "HEAD_ROWS", 40)  # most pairs are joined
    monkeypatch.setattr(align, "GATHERED", 50)
    assert got(align.alignment(table(spark, rows), A, B)) == want


def test_runs_are_skipped():
    """One-to-one stretches take steps by the logarithm of their length; the shift follows knots."""
    ends = np.arange(1, 100_001)
    even = align.Groups(ends, ends)
    assert even.runs.tolist() == [[0, 0, 100_000]] and even.compared < 50
    b = np.array([e for e in ends.tolist() if e not in (500, 501, 70_000)])
    knotted = align.Groups(ends, b)
    assert knotted.knots.tolist() == [[499, 502, 499, 500], [69_999, 70_001, 69_997, 69_998]] and knotted.compared < 200
    last_a, last_b = knotted.last()
    assert last_a.sum() == len(b) and last_b.all()


def test_links_and_groups_add_up():
    r = random.Random(3)
    for _ in range(300):
        total = r.randint(1, 60)
        a, b = ([*sorted(r.sample(range(1, total), r.randint(0, total - 1))), total] for _ in "ab")
        found = align.Groups(np.array(a), np.array(b))
        i, j = found.links()
        want = {(x, y) for x in range(len(a)) for y in range(len(b))
                if (a[x - 1] if x else 0) < b[y] and (b[y - 1] if y else 0) < a[x]}
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and len(i) == len(want)
        last_a, last_b = found.last()
        assert {a[k] for k in np.flatnonzero(last_a)} == {b[k] for k in np.flatnonzero(last_b)} == set(a) & set(b)


def test_edge_rows(spark):
    empty = align.alignment(table(spark, []), A, B)
    assert empty.count() == 0
    zeros = (0, 0, 0, 0, 0, 0, "")
    only = spark.createDataFrame([(1, None), (None, ""), (2, "▁x")], "doc_id long, text string")
    assert got(align.alignment(only, A, B)) == {1: zeros, None: zeros, 2: zeros}
    twice = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "one two")], "doc_id long, text string")
    rows = align.alignment(twice, A, B).collect()
    assert len(rows) == 3 and len({r.groups_sha256 for r in rows}) == 1 and {r.count_sum for r in rows} == {3 * rows[0].n_links}
