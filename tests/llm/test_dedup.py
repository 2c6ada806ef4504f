"""Line dedup, substring dedup and near-dedup against brute force, and their edge rows."""

import random

from clientela.llm import chunks, minhash, winnow
from clientela.llm.textbytes import Piece

EDGES = [(None, "a b c d e"), (1, None), (2, ""), (3, " \n\t\n "), (4, "one"), (5, "one"), (6, "One two"), (7, "x " * 30_000)]


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(s)
    root = {i: i for i in sets if i is not None}

    def find(i):
        return i if root[i] == i else find(root[i])

    ids = sorted(root)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if any(s and u and 100 * len(s & u) >= 75 * len(s | u) for s in sets[a] for u in sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s[0]) for i, s in sets.items()}


def changed(text, rate, seed):
    r = random.Random(seed)
    return " ".join(f"w{r.random()}" if r.random() < rate else w for w in text.split())


def test_near_duplicates_are_those_of_brute_force(docs, prose):
    base = prose(120, 1)
    rows = [(100 + i, changed(base, (i % 12) / 100, i)) for i in range(60)]
    rows += [(200 + i, prose(5 + i, 50 + i)) for i in range(10)] + [(300 + i, prose(5 + i, 50 + i) + " end") for i in range(10)]
    rows += [(400 + i, base) for i in range(40)] + [(500, "Aa BB cc dd ee ff gg"), (501, "aa bb CC dd ee ff gg")]
    rows += EDGES
    got = minhash.near_duplicates(docs(rows)).collect()
    want, sizes = brute_components(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.component_id == r.doc_id) for r in got if r.doc_id is not None)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert len(got) == len(rows)


def test_the_exact_comparison_finds_what_stars_miss(docs, prose, monkeypatch):
    """A chain in which only neighbours are similar, and no star at all."""
    monkeypatch.setattr(minhash, "STARS", 0)
    words = prose(160, 3).split()
    rows = [(i, " ".join(words[6 * i:6 * i + 60])) for i in range(12)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(rows)).collect()}
    assert got == brute_components(rows)[0] and len(set(got.values())) == 1


def test_repeated_rows_and_an_empty_table(docs):
    got = minhash.near_duplicates(docs([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(1, 1, True), (1, 1, True), (2, 1, False)]
    assert minhash.near_duplicates(docs([])).count() == 0


def brute_runs(rows):
    """(doc, line) of lines in windows of three solid lines that occurred before."""
    seen, gone = {}, set()
    for i, t in sorted((i, t) for i, t in rows if i is not None and t is not None):
        at = [k for k, x in enumerate(t.split("\n")) if x.strip(" \t\n\r\x0b\x0c")]
        lines = t.split("\n")
        for k in range(len(at) - 2):
            key = tuple(lines[j] for j in at[k:k + 3])
            if key in seen:
                gone.update((i, j) for j in range(at[k], at[k + 2] + 1))
            seen.setdefault(key, i)
    return gone


def test_line_runs_are_those_of_brute_force(docs):
    r = random.Random(4)
    rows = [(i, "\n".join(r.choice(["a", "b", "c", "d d", "", " ", "e"]) for _ in range(r.randint(0, 14)))) for i in range(60)]
    rows += [(100, "p\nq\nr\ns"), (101, "0\np\nq\nr\ns\n1"), (102, "z\n" * 9)] + [(i + 200, t) for i, t in EDGES if i is not None] + EDGES[:1]
    got = winnow.repeated_runs(docs(rows)).collect()
    covered = {(x.doc_id, k) for x in got for k in range(x.first_line, x.last_line + 1)}
    want = brute_runs(rows)
    texts = dict(rows)
    solid = {(i, k) for i, k in covered if texts[i].split("\n")[k].strip()}
    assert solid == {(i, k) for i, k in want if texts[i].split("\n")[k].strip()}
    assert [(x.first_line, x.last_line, x.source_id) for x in got if x.doc_id == 101] == [(1, 4, 100)]


def test_short_runs_of_many_words_are_found(docs, prose):
    long, half, other, short = prose(51, 1), prose(30, 2), prose(21, 3), prose(50, 4)
    rows = [(1, f"a\n{long}\nb\n{half}\n\n{other}\nc\n{short}\nd"), (2, f"e\n{long}\nf"), (3, f"g\n{half}\n{other}\nh"),
            (4, f"i\n{short}\nj\n{half}\nk\n{other}"), (5, f"{long}\nl\n{long}\nb"), (6, "p\nq\nr"), (7, "p\nq\nr\n" + long)]
    got = winnow.repeated_runs(docs(rows), long_words=winnow.LONG_WORDS).collect()
    assert sorted((x.doc_id, x.first_line, x.last_line, x.source_id) for x in got) == [
        (2, 1, 1, 1), (3, 1, 2, 1), (5, 0, 0, 1), (5, 2, 3, 1), (7, 0, 2, 6), (7, 3, 3, 1)]


def brute_long_runs(rows, long_words):
    """Every window of three lines, or of fewer lines with more words, that stands earlier; overlapping ones put
    together. The source is that of the first window, the longest of those that begin there: the text itself, if
    it holds the window higher up, or the least id."""
    windows = []
    for i, t in sorted(rows):
        lines = [(k, x) for k, x in enumerate((t or "").split("\n")) if x.split()]
        for n in (1, 2, 3):
            for at in range(len(lines) - n + 1):
                part = lines[at:at + n]
                if n == 3 or sum(len(x.split()) for _, x in part) > long_words:
                    windows.append((i, part[0][0], part[-1][0], tuple(x for _, x in part)))
    runs = []
    for i, start, end, key in sorted(windows, key=lambda x: (x[0], x[1], x[2])):
        higher = any(k == key and j == i and s < start for j, s, _, k in windows)
        least = min(j for j, _, _, k in windows if k == key)
        if not higher and least == i:
            continue
        source = i if higher else least
        if runs and runs[-1][0] == i and start <= runs[-1][2]:
            run = runs[-1]
            if start == run[1]:
                run[4] = source
            run[2], run[3] = max(run[2], end), run[3] + 1
        else:
            runs.append([i, start, end, 1, source])
    return sorted(map(tuple, runs))


def test_long_runs_are_those_of_brute_force(docs):
    r = random.Random(5)
    for long_words in (2, 4):
        lines = ["a", "b c", "d e f", "g h i j k", "", "  ", "l m n o p q"]
        rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 9)))) for i in range(60)]
        got = winnow.repeated_runs(docs(rows), long_words=long_words).collect()
        assert sorted((x.doc_id, x.first_line, x.last_line, x.n_windows, x.source_id) for x in got) == brute_long_runs(rows, long_words)


def test_columns_may_have_the_names_used_inside(docs):
    table = docs([(1, "a\nb\nc"), (2, "x\na\nb\nc")]).withColumnsRenamed({"id": "__gone", "start": "__GONE_"})
    left = winnow.delete_runs(table, winnow.repeated_runs(table))
    assert left.columns == table.columns and {r.doc_id: r.text for r in left.collect()} == {1: "a\nb\nc", 2: "x"}
    same = chunks.delete_passages(table, chunks.repeated_passages(table))
    assert same.columns == table.columns and same.count() == 2


def test_deleting_runs_keeps_the_rest(docs):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "a\nb\nc"), (4, "k\r\n\n"), (5, None), (None, "a\nb\nc"), (6, "")]
    table = docs(rows)
    left = winnow.delete_runs(table, winnow.repeated_runs(table))
    assert left.columns == table.columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: "a\nb\nc\nd", 2: "x\ny", 4: "k\r\n\n", 5: None, None: "a\nb\nc", 6: ""}
    assert winnow.repeated_runs(docs([])).count() == 0


def test_passages_are_found_and_removed(docs, prose):
    passage = prose(60, 9)
    rows = [(i, prose(80, 20 + i) + " " + passage + " " + prose(40, 90 + i)) for i in range(30)]
    rows += [(100 + i, prose(150, 500 + i)) for i in range(30)] + [(i + 200, t) for i, t in EDGES if i is not None] + EDGES[:1]
    table = docs(rows)
    found = chunks.repeated_passages(table)
    got = found.collect()
    texts = dict(rows)
    assert {r.doc_id for r in got if r.doc_id < 100} == set(range(1, 30))
    assert not {r.doc_id for r in got} & set(range(100, 130))
    for r in got:
        if r.doc_id < 100:
            begin = texts[r.doc_id].index(passage)
            inside = min(r.end, begin + len(passage)) - max(r.start, begin)
            assert inside > 0.7 * len(passage) and r.end - r.start - inside < 10 and r.source_id < r.doc_id
    left = {r.doc_id: r.text for r in chunks.delete_passages(table, found).collect()}
    for r in got:
        if r.doc_id < 100:
            assert left[r.doc_id] == texts[r.doc_id][:r.start] + texts[r.doc_id][r.end:]
    assert left[100] == texts[100] and left[201] is None
    assert chunks.repeated_passages(docs([])).count() == 0


def test_passages_of_51_words_are_found_to_their_ends(docs, prose):
    rows, spans = [], {}
    for i in range(300):
        passage = prose(51, 10_000 + i)
        for k in (0, 1):
            before = f"{k}é" + prose(40, 20_000 + 2 * i + k) + f" {k}"
            rows.append((2 * i + k, before + passage + f"{k} " + prose(40, 30_000 + 2 * i + k)))
            spans[2 * i + k] = (len(before), len(before) + len(passage))
    got = {r.doc_id: (r.start, r.end, r.source_id, r.n_words) for r in chunks.repeated_passages(docs(rows)).collect()}
    assert set(got) <= {i for i in spans if i % 2} and len(got) >= 299  # one shares no whole chunk
    assert all(got[i][:3] == (*spans[i], i - 1) and got[i][3] in (50, 51) for i in got)


def test_chunks_tile_texts_and_survive_insertions(prose):
    import pyarrow as pa
    text = prose(400, 7) + "é日本" * 5
    spans = []
    for t in (text, "an insertion " + text):
        piece = Piece(pa.record_batch({"text": ["before", t, None, ""]}))
        firsts, ends = chunks.bounds(piece)
        assert firsts[0] == 0 and ends[-1] == len(piece.bytes) and (firsts[1:] == ends[:-1]).all()
        spans.append({piece.bytes[a:b].tobytes() for a, b in zip(firsts, ends, strict=True)})
    assert len(spans[0] - spans[1]) <= 3
