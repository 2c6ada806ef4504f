"""The transducer against the tokenizers library, and round trips."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clientela.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
POOL = ["a", "b", "e", "th", "in", " ", "  ", "\n", "\t", "é", "ß", "日本", "😀", "1", "23", "!", "###", "\x1c", "\x85", "　", "\xa0",
        "<|endoftext|>", "<|endof", "'s", "'ll", "İ", "ſ", "a" * 7, "́", "२", "½", "-" * 9, " " * 5, "\x00", "e" * 40]


@pytest.fixture(scope="module")
def both():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Bpe(f.read()), Tokenizer.from_file(PATH)


def texts():
    r = random.Random(8)
    yield from ("".join(r.choice(POOL) for _ in range(r.randint(0, 14))) for _ in range(3000))
    yield from ("a" * 5000, "ab" * 4000, "-" * 9000, "".join(r.choice("abcde") for _ in range(9000)), "日本語" * 900, " " * 3001 + "x")


def test_ids_and_decoding_are_the_librarys(both):
    own, library = both
    for text in texts():
        want = library.encode(text, add_special_tokens=False).ids
        assert list(own.encode(text)) == want == own.encode_all(text).tolist()
        decoded = library.decode(want, skip_special_tokens=False)
        assert bpe.Decoder(own).text(want) == decoded
        assert own.digest(text) == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest(),
                                    hashlib.sha256(decoded.encode()).hexdigest())


def test_what_is_held_stays_bounded(both, monkeypatch):
    own, _ = both
    most, agreed = 0, own._agreed

    def watched(last, size, longest):
        nonlocal most
        most = max(most, len(last))
        return agreed(last, size, longest)

    monkeypatch.setattr(own, "_agreed", watched)
    for text in ("a" * 50_000, "ab" * 20_000, "-=" * 9000, "the" * 9000):
        list(own.tokens(text.encode()))
    assert bpe.HELD < most <= bpe.HELD + own.longest + own.lookahead + 2


def test_digests_hold_no_ids_of_an_unbroken_piece(both):
    """Of a piece four times as long only the copies of its text grow, 2 bytes a letter."""
    import tracemalloc
    own, _ = both
    r = random.Random(5)
    peaks = []
    for n in (100_000, 400_000):
        text = "".join(r.choices("etaoinshr", k=n))
        own.digest(text)  # fills the bounded tables
        tracemalloc.start()
        own.digest(text)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] - peaks[0] < 4 * 300_000


def test_decoding_in_steps(both):
    own, library = both
    ids = library.encode("é日本😀", add_special_tokens=False).ids
    machine = bpe.Decoder(own)
    assert "".join(machine.text([i], False) for i in ids) + machine.text([]) == "é日本😀"
    cut = library.encode("日", add_special_tokens=False).ids[:1]
    assert bpe.Decoder(own).text(cut) == library.decode(cut, skip_special_tokens=False)


def test_frames(docs, both):
    rows = [(1, "Hello, world"), (2, None), (3, ""), (None, "x <|endoftext|> y"), (1, "Hello, world"), (4, "word " * 50_000)]
    table = docs(rows)
    ids = bpe.encode_ids(table, PATH)
    assert {r.doc_id: r.text for r in bpe.decode_ids(ids, PATH).collect()} == {i: t or "" for i, t in rows}
    got = bpe.encode_digests(table, PATH).collect()
    assert len(got) == len(rows) and {r.doc_id: r.n_tokens for r in got}[2] == 0
    wide = bpe.encode_rows(table, PATH)
    assert wide.columns == [*table.columns, "n_tokens", "ids", "decoded_same"] and all(r.decoded_same for r in wide.collect())
    assert bpe.encode_digests(docs([]), PATH).count() == bpe.encode_rows(docs([]), PATH).count() == 0
