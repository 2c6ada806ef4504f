"""Secrets and decontamination against brute force, and their edge rows."""

import hashlib
import random
import re

from clientela.llm import decontaminate, secrets

ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
                    r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))
    return tuple(sum(k == i for _, k, _ in found) for i in range(3)), hashlib.sha256(listed.encode()).hexdigest(), listed


def test_base_spans_are_those_of_the_patterns(spark):
    r = random.Random(2)
    parts = ["password", "PassWd", "token", "api_key", "APIKEY", "=", ":", " ", "'", '"', "abc", "deadbeef" * 4, "AKIA" + "Z" * 12,
             "AKIA", "x1y2z3w4", "é", "😀", "\n", "-", ".", "0" * 33, "secret"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 25))), f"s{i % 3}") for i in range(300)]
    rows += [(1000, None, None), (1001, "", "s"), (None, "token=abcdefgh", None), (1002, "token=short password: secret: abcdefgh12", "s")]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    found = {x.doc_id: x for x in got}
    for i, t, _ in rows:
        counts, digest, _ = base(t)
        assert (found[i].n_assign, found[i].n_access, found[i].n_hex) == counts and found[i].base_sha256 == digest


def test_ownership_separates_examples_from_live_values(spark):
    live, copied = "Zx9" + "qW3eR5tY7u" * 2, "aB1" + "cD2eF3gH4i" * 2
    rows = [(1, f"see {live} here", "one"), (2, f"again {live}", "one"), (3, f"é {copied}", "one"), (4, copied, "two"),
            (5, "token=hunter2hunter2", "one"), (6, "token=hunter2hunter2", "two")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("row", __import__("pyspark").sql.functions.lit(1))
    got = {x.doc_id: (x.spans, x.n_live, x.n_example) for x in secrets.scan(table).collect()}
    assert got == {1: ("bare:4:27", 1, 0), 2: ("bare:6:29", 1, 0), 3: ("", 0, 1), 4: ("", 0, 1),
                   5: ("assign:0:20", 0, 1), 6: ("assign:0:20", 0, 1)}
    assert secrets.scan(table.limit(0)).count() == 0


def test_values_copied_widely_within_one_source_or_without_one_are_examples(spark):
    wide, one, few, stray, alone = (x + "qW3eR5tY7u" * 2 for x in ("Wd1", "On2", "Fe3", "St4", "Al5"))
    rows = [(i, f"{wide} text {i}", "hot") for i in range(30)] + [(100 + i, f"{one} same", "hot") for i in range(30)]
    rows += [(200 + i, f"{few} text {i}", "hot") for i in range(3)] + [(300 + i, f"{stray} text {i}", None) for i in range(3)]
    rows += [(400 + i, f"{alone} same", None) for i in range(3)]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {(x.doc_id // 100, x.spans, x.n_live, x.n_example) for x in got} == {
        (0, "", 0, 1), (1, "bare:0:23", 1, 0), (2, "bare:0:23", 1, 0), (3, "", 0, 1), (4, "bare:0:23", 1, 0)}


def test_scans_run_no_python(spark):
    rows = spark.createDataFrame([(1, "a b c d e f", "x")], "doc_id long, text string, source string")
    for df in (secrets.scan(rows), decontaminate.leaks(rows, rows.selectExpr("doc_id AS item_id", "text"))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_leaks(docs, prose, spark):
    items = [(1, prose(40, 1)), (2, prose(20, 2)), (3, "only three words"), (4, None), (5, ""), (6, prose(60, 6)), (6, prose(60, 6))]
    words = items[5][1].split()
    rows = [(10, prose(30, 11) + " " + items[0][1].upper() + "\n" + prose(9, 12)), (11, items[1][1]),
            (12, "x only\nthree  words y"), (13, prose(200, 13)), (14, None), (15, ""), (None, items[0][1]),
            (16, " ".join([*words[:30], "changed", *words[31:]])), (17, " ".join(words[:30])), (18, " ".join(words[2:])),
            (19, " ".join(w for i, w in enumerate(items[0][1].split()) if i % 6))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start, r.n_words, round(r.similarity, 3)) for r in decontaminate.leaks(docs(rows), table).collect()}
    assert got == {(10, 1): (30, 40, 1.0), (11, 2): (0, 20, 1.0), (12, 3): (1, 3, 1.0), (16, 6): (0, 60, round(51 / 61, 3)),
                   (18, 6): (0, 58, round(54 / 56, 3))}
    assert decontaminate.leaks(docs([]), table).count() == 0
    assert decontaminate.leaks(docs(rows), table.limit(0)).count() == 0


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    r = random.Random(5)
    for _ in range(200):
        flips = r.sample(range(64), decontaminate.RADIUS)
        assert len({b // decontaminate.BLOCK_BITS for b in flips}) < 64 // decontaminate.BLOCK_BITS


def test_changed_ends_and_blocks_are_found_as_by_brute_force(docs, prose, spark):
    """Few shingles but many bits of the fingerprint."""
    items, rows, want = [], [], {}
    for i, (n, first, last) in enumerate([(15, 14, 15), (30, 28, 30), (40, 37, 40), (59, 54, 59), (60, 30, 34), (100, 50, 59),
                                          (200, 172, 200), (200, 0, 28), (20, 15, 20), (60, 20, 40)] * 4):
        words = prose(n, 100 + i).split()
        new = [*words[:first], *prose(last - first, 300 + i).split(), *words[last:]]
        items.append((i, " ".join(words)))
        rows.append((i, " ".join([prose(7, 500 + i), *new, prose(11, 700 + i)])))
        a, b = ({tuple(x[j:j + 5]) for j in range(n - 4)} for x in (words, new))
        if 100 * len(a & b) >= 75 * len(a | b):
            want[i, i] = (7, n, round(len(a & b) / len(a | b), 6))
    got = decontaminate.leaks(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (r.start, r.n_words, round(r.similarity, 6)) for r in got} == want and len(want) == 32
