"""Scores and labels: held-out accuracy, brute-force counts, edge rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from clientela.llm import attention, crf, langid, toxicity
from clientela.llm.queries import QUERIES
from clientela.llm.textbytes import Piece

DATA = "/root/testdata/sf0.01"
EDGES = [(1, None), (2, ""), (3, " \n "), (4, "12 34 ..."), (5, "é"), (6, "a" * 300_000), (None, "the text"), (6, "twice")]


@pytest.fixture(scope="module")
def truth(spark):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    return labels, langs


def test_quality_on_held_out_documents(spark, truth):
    rows = [r for r in QUERIES["op6_quality_classifier"](spark, DATA).collect() if r.held_out and r.doc_id in truth[0]]
    right = [r.predicted == truth[0][r.doc_id].quality for r in rows]
    assert len(rows) > 50 and np.mean(right) > 0.97


def test_toxicity_on_held_out_documents(spark, truth):
    rows = [r for r in QUERIES["op4_toxicity"](spark, DATA).collect() if r.held_out and r.doc_id in truth[0]]
    clean = [r.predicted for r in rows if not truth[0][r.doc_id].toxic]
    assert len(clean) > 50 and np.mean(clean) < 0.1


def test_held_out_toxic_documents_are_caught(spark):
    """On the larger table; the smaller one holds only 30 toxic documents to learn from."""
    d = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op4_toxicity"](spark, d).collect() if r.held_out and toxic.get(r.doc_id) is not None]
    caught = [r.predicted for r in rows if toxic[r.doc_id]]
    flagged = [r.predicted for r in rows if not toxic[r.doc_id]]
    assert len(caught) > 100 and np.mean(caught) > 0.85 and np.mean(flagged) < 0.04


def test_the_scale_does_not_follow_the_share_that_is_sampled():
    g = np.random.default_rng(0)
    z, y = np.concatenate([g.normal(-2, 1, 9000), g.normal(2, 1, 1000)]), np.repeat([0.0, 1.0], [9000, 1000])
    fewer = np.r_[0:1000, 9000:10000]
    whole, cut = toxicity._scaled(z, y), toxicity._scaled(z[fewer], y[fewer])
    assert abs(whole[1] - cut[1]) < 0.4 and abs(whole[0] - cut[0]) < 0.6
    assert toxicity._scaled(z[:5], y[:5]) == (1.0, 0.0)


@pytest.mark.parametrize("spread", [0.1, 1, 30])
def test_the_scale_has_the_least_loss(spread):
    g = np.random.default_rng(1)
    y = np.repeat([0.0, 1.0], [300, 40])
    z = spread * (g.standard_t(2, 340) + 2 * y - 3)
    a, b = toxicity._scaled(z, y)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    loss = lambda a, b: (weight * np.logaddexp(0, np.where(y == 1, -1, 1) * (a * z + b))).sum() + 5e-3 * a * a
    assert all(loss(a, b) <= loss(a + u, b + v) for u in (-0.01, 0, 0.01) for v in (-0.01, 0, 0.01) if a + u > 1e-3)


def document_score(model, text):
    """Plain loops: words to means of n-grams, bags to means of words, the document to the mean of its
    bags weighed by their exponentials."""
    words = (text or "").split()
    bags = [words[i:i + toxicity.BAG_WORDS] for i in range(0, len(words), toxicity.BAG_WORDS)]
    logits = []
    for bag in bags:
        found = Piece(pa.record_batch({"text": [" ".join(bag)]}))
        logits.append(float(np.mean(toxicity.Words(found).means(model.values))) + model.bias)
    if not logits:
        return 0.0
    e = np.exp(np.array(logits) - max(logits))
    z = float((e * logits).sum() / e.sum())
    return 1 / (1 + np.exp(-(model.slope * z + model.shift)))


@pytest.mark.parametrize("bag", [1, 3])
def test_document_scores_against_plain_loops(prose, monkeypatch, bag):
    monkeypatch.setattr(toxicity, "BAG_WORDS", bag)
    model = toxicity.Model()
    model.values, model.bias, model.slope, model.shift = np.random.default_rng(3).normal(size=toxicity.BUCKETS), 0.3, 0.7, -0.4
    texts = [prose(n, n) for n in (1, 2, 7, 40)] + [None, "", " \n", "One"]
    got = model.score(Piece(pa.record_batch({"text": pa.array(texts)})))
    assert np.allclose(got, [document_score(model, t) for t in texts])


def test_languages_of_held_out_documents(spark, truth):
    rows = [r for r in QUERIES["op2_language_id"](spark, DATA).collect() if r.held_out]
    assert len(rows) > 200 and np.mean([r.lang_pred == truth[1][r.doc_id] for r in rows]) > 0.98


def toxic_sample(prose):
    r = random.Random(1)
    known = prose(300, 1).split()
    out = []
    for i in range(400):
        words = [r.choice(known) for _ in range(60)]
        if i % 2:
            for _ in range(3):
                words[r.randrange(60)] = r.choice(["stupidity", "moronic", "idiotic"])
        out.append((" ".join(words), i % 2))
    return out


def test_unseen_spellings_share_ngrams(prose):
    model = toxicity.fit(toxic_sample(prose))
    clean = " ".join(prose(300, 1).split()[::4])
    texts = [clean, clean + " IDIOTICC", "stupidityy moronicc " + clean, None, ""]
    scores = model.score(Piece(pa.record_batch({"text": pa.array(texts)})))
    assert scores[0] < 0.3 and scores[1] >= toxicity.DECISION and scores[2] >= toxicity.DECISION
    assert list(scores[3:]) == [0, 0]


def test_word_means_are_means_of_ngrams():
    words = toxicity.Words(Piece(pa.record_batch({"text": ["Ab c", None, "déf"]})))
    values = np.random.default_rng(0).random(toxicity.BUCKETS)
    bucket = {}
    for n in toxicity.GRAMS:
        found, inside = words.buckets(n)
        for at in np.flatnonzero(inside):
            bucket.setdefault(int(words.word_of(np.array([at]))[0]), []).append(values[found[at]])
    spelled = [b" ab ", b" c ", " déf ".encode()]
    assert [len(bucket[i]) for i in range(3)] == [sum(max(0, len(w) - n + 1) for n in toxicity.GRAMS) for w in spelled]
    assert np.allclose(words.means(values), [np.mean(bucket[i]) for i in range(3)])


def test_attention_gradients_are_those_of_the_loss():
    g = np.random.default_rng(1)
    model = attention.Model()
    rows = np.array([0, 0, 1, 2, 2, 2])
    x, y, w = g.normal(size=(6, attention.N_FEATURES)), np.array([1.0, 0, 1]), np.array([0.5, 0.2, 0.3])

    def loss():
        p = model.score(rows, x, 3)
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() + attention.DECAY / 2 * sum((v * v).sum() for v in model.parameters())

    for grad, value in zip(model.gradients(rows, x, y, w), model.parameters(), strict=True):
        at = tuple(g.integers(0, s) for s in value.shape)
        value[at] += 1e-6
        up = loss()
        value[at] -= 2e-6
        assert abs((up - loss()) / 2e-6 - grad[at]) < 1e-5
        value[at] += 1e-6


def test_viterbi_and_gradients_of_the_field_against_all_paths():
    from itertools import product
    g = np.random.default_rng(2)
    model = crf.Model()
    model.weights, model.bias, model.move = g.normal(size=(crf.N_FEATURES, 2)), g.normal(size=2), g.normal(size=(2, 2))
    rows = np.array([0, 0, 0, 0, 1, 2, 2])
    x, y = g.normal(size=(7, crf.N_FEATURES)), np.array([0, 1, 1, 0, 1, 0, 0])
    scores = model.emissions(x)
    paths = lambda part: {p: sum(s[k] for s, k in zip(part, p, strict=True)) + sum(
        model.move[a, b] for a, b in zip(p, p[1:], strict=False)) for p in product((0, 1), repeat=len(part))}
    want = [k for row in range(3) for k in max(paths(scores[rows == row]).items(), key=lambda kv: kv[1])[0]]
    assert model.viterbi(rows, x, 3).tolist() == want

    def loss():
        s, total = model.emissions(x), 0
        for row in range(3):
            mask = rows == row
            part = {p: sum(e[k] for e, k in zip(s[mask], p, strict=True)) + sum(model.move[a, b] for a, b in zip(p, p[1:], strict=False))
                    for p in product((0, 1), repeat=int(mask.sum()))}
            total += np.log(sum(np.exp(v) for v in part.values())) - part[tuple(y[mask])]
        return total / len(y) + crf.DECAY / 2 * (model.weights ** 2).sum()

    for grad, value in zip(model.gradients(rows, x, y, 3), (model.weights, model.bias, model.move), strict=True):
        at = tuple(g.integers(0, s) for s in value.shape)
        value[at] += 1e-6
        up = loss()
        value[at] -= 2e-6
        assert abs((up - loss()) / 2e-6 - grad[at]) < 1e-5
        value[at] += 1e-6


def test_latent_gradients_of_the_field_against_all_paths():
    from itertools import product
    g = np.random.default_rng(4)
    model = crf.Model()
    model.weights, model.bias, model.move = g.normal(size=(crf.N_FEATURES, 2)), g.normal(size=2), g.normal(size=(2, 2))
    rows = np.array([0, 0, 0, 1, 2, 2])
    x, lean = g.normal(size=(6, crf.N_FEATURES)), np.zeros((6, 2))
    lean[np.arange(6), np.array([1, 0, 1])[rows]] = crf.LEAN

    def total(scores):
        return sum(np.log(sum(np.exp(sum(s[k] for s, k in zip(scores[rows == row], p, strict=True)) + sum(
            model.move[a, b] for a, b in zip(p, p[1:], strict=False))) for p in product((0, 1), repeat=int((rows == row).sum()))))
            for row in range(3))

    def loss():
        s = model.emissions(x)
        return (total(s) - total(s + lean)) / 6 + crf.DECAY / 2 * ((model.weights ** 2).sum() + (model.move ** 2).sum())

    for grad, value in zip(model.latent_gradients(rows, x, lean, 3), (model.weights, model.bias, model.move), strict=True):
        at = tuple(g.integers(0, s) for s in value.shape)
        value[at] += 1e-6
        up = loss()
        value[at] -= 2e-6
        assert abs((up - loss()) / 2e-6 - grad[at]) < 1e-5
        value[at] += 1e-6


def test_boilerplate_around_content_is_told_apart(docs, prose):
    """Labels are of whole documents, yet lines of a mixed one get labels of their own."""
    text = lambda seed: "\n".join(prose(12, 10 * seed + j) for j in range(8))
    junk = lambda seed: "\n".join(" | ".join(prose(6, 5000 + 10 * seed + j).split()) + " ### $$$" for j in range(4))
    model = crf.fit([(junk(i), 0) if i % 2 else (text(i), 1) for i in range(60)])
    rows = [(1, text(400)), (2, junk(401)), (3, junk(402) + "\n" + text(403) + "\n" + junk(404)), (4, junk(405) + "\n" + text(406)[:40])]
    found = {r.doc_id: r for r in crf.judge(docs(rows), model).collect()}
    words = {i: len(t.split()) for i, t in rows}
    assert found[1].content_share == 1 and found[2].content_share == 0
    assert 0 < found[3].content_share < 1 and abs(found[3].content_share - 96 / words[3]) < 0.1
    assert found[1].kept and not found[2].kept and found[3].kept == (found[3].content_share >= crf.CONTENT_SHARE) and not found[4].kept


def base_counts(text):
    s = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", s)
    threes = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    twice = {t for t in threes if threes.count(t) > 1} if len(w) < 500 else set()
    covered = {i + k for i, t in enumerate(threes) if t in twice for k in range(3)}
    lines = [x for x in s.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", s)), len(lines) - len(set(lines)), len(covered))


def test_rules_count_as_brute_force_does(docs):
    r = random.Random(3)
    rows = [(i + 10, "".join(r.choice(["a", "b", " ", "\n", "é ", "#", "ab ", "日", "\x1c", " | "]) for _ in range(r.randint(0, 200)))) for i in range(80)]
    rows += EDGES
    got = crf.judge(docs(rows), crf.fit([])).collect()
    assert len(got) == len(rows)
    want = sorted(((-1 if i is None else i), *base_counts(t)) for i, t in rows)
    assert sorted(((-1 if x.doc_id is None else x.doc_id), x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in got) == want
    for x in got:
        assert x.base_failed == (x.n_words < 50 or 2 * x.n_repeat_words > x.n_words)
        assert x.kept == (not x.base_failed and x.content_share >= 0.5)
    assert crf.judge(docs([]), crf.fit([])).count() == 0


def greedy(text, reference):
    phrases, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in reference:
            end += 1
        phrases, at = phrases + 1, max(at + 1, end - 1)
    return phrases


def test_phrases_are_longest_matches():
    r = random.Random(6)
    for _ in range(50):
        reference = "".join(r.choice("abc") for _ in range(40))
        text = "".join(r.choice("abcd") for _ in range(60))
        table = langid.Automaton([ord(c) - 97 for c in reference], 4).table
        codes = np.frombuffer(text.encode(), np.uint8) - 97
        got = langid._phrases(table, codes, np.array([0, 20]), np.array([20, 40]))
        assert got.tolist() == [greedy(text[:20], reference), greedy(text[20:], reference)]


def test_learned_text_is_spread_over_long_documents(spark):
    from pyspark.sql import functions as F
    long = "a" * 10_000 + "b" * 10_000 + "c" * 10_000
    rows = [(1, long, "xx"), (1, long, "xx"), (2, "short", "yy"), (3, None, "yy"), (None, "z", "yy"), (4, "w", None), (5, "", "zz")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.learn(table, F.lit(True))
    assert set(got) == {"xx", "yy"} and got["yy"] == b"short "
    assert len(got["xx"]) <= langid.DOC_BYTES + 1 and {got["xx"].count(c) for c in (b"a", b"b", b"c")} <= set(range(900, 1101))
    assert langid.learn(table.limit(0), F.lit(True)) == {}


def test_languages_edge_rows(docs):
    texts = {"xx": b"the quick brown fox jumps over the lazy dog ", "yy": "el perro y la niña están aquí ".encode()}
    rows = [*EDGES, (20, "THE dog"), (21, "la niña"), (22, "12"), (23, "日本")]
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs(rows), texts).collect()]
    found = {i: (p, s) for i, p, s in got}
    assert all(found[i] == ("und", 0.0) for i in (1, 2, 3, 4, 22))
    assert found[20][0] == "xx" and found[21][0] == "yy" and found[5][0] != "und" and all(0 <= s <= 1 for _, _, s in got)
    assert {r.lang_pred for r in langid.identify(docs(rows), {}).collect()} == {"und"}
    assert langid.identify(docs([]), texts).count() == 0


def test_scores_of_edge_rows_and_unfitted_models(docs):
    for module, model in ((attention, attention.fit([])), (toxicity, toxicity.fit([])), (attention, attention.fit([("a b", 1)]))):
        got = module.score(docs(EDGES), model).collect()
        assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
        assert module.score(docs([]), model).count() == 0
    kept = attention.keep_good(docs(EDGES), attention.fit([]), 0.3)
    assert kept.columns == docs([]).columns and kept.count() == len(EDGES)
