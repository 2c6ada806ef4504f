"""Byte-level BPE as a streaming transducer, and decoding as a byte-to-text state machine.

Merging by rank is the same as reading left to right and keeping, for each prefix, the last token
of its encoding: the token that ends there and stands firm next to the last token of the prefix
before it. The next bytes can change only what the merge list's lookahead allows, so tokens that
all live prefixes agree on are final and leave; what is held stays bounded however long a piece
without a break is."""

import codecs
import hashlib
import json
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clientela.llm.store import mapped, renamed
from clientela.llm.textbytes import slices

# Fixed value of byte-level tokenizers: how text is split before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CACHED = 1 << 19  # pieces of text kept with their ids
FLUSH = 4096      # pieces, or ids of one long piece, that go to the digest at once
HELD = 1024       # bytes beyond the lookahead after which final tokens leave


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in the vocabulary: printable Latin-1 for itself, the others in
    order from U+0100."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """Encoder and decoder of a byte-level BPE given as the JSON text of its file."""

    def __init__(self, source: str):
        described = json.loads(source)
        model, letters = described["model"], byte_letters()
        spell = lambda token: bytes(letters[c] for c in token)
        self.ids = {spell(token): i for token, i in model["vocab"].items()}
        self.spelled = {i: token for token, i in self.ids.items()}
        self.added = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.spelled.update({i: content.encode() for content, i in self.added.items()})
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(
            self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pieces = regex.compile(PATTERN)
        self.merges: dict[tuple[int, int], int] = {}    # pair to rank
        self.parts: dict[int, tuple[int, int, int]] = {}  # token to rank, left, right
        self.firm: dict[int, bool] = {}
        self.known: dict[str, str] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            left, right = spell(left), spell(right)
            pair, token = (self.ids[left], self.ids[right]), self.ids[left + right]
            self.merges[pair] = rank
            if token not in self.parts and self.stands(*pair, rank):  # of several ways to one token, the one that merging takes
                self.parts[token] = (rank, *pair)
        self.firm.clear()
        self.longest = max(map(len, self.ids))
        self._automaton()

    def _automaton(self) -> None:
        """States are prefixes of tokens. A state knows the longest token that its string ends
        with, a token the next shorter one."""
        self.go: dict[int, int] = {}  # state and byte to state; filled further as it is used
        back, self.ends, own = [0], [-1], {}
        for token, i in self.ids.items():
            state = 0
            for byte in token:
                key = state << 8 | byte
                state = self.go.get(key, 0)
                if not state:
                    state = self.go[key] = len(back)
                    back.append(0)
                    self.ends.append(-1)
            self.ends[state] = i
            own[i] = state
        queue = [(0, key & 255, to) for key, to in self.go.items() if key < 256]
        below: dict[int, list[tuple[int, int]]] = {}
        for key, to in self.go.items():
            below.setdefault(key >> 8, []).append((key & 255, to))
        self.shorter = [-1] * (max(self.spelled) + 1)
        for above, byte, state in queue:
            if above:
                at = back[above]
                while at and at << 8 | byte not in self.go:
                    at = back[at]
                back[state] = self.go.get(at << 8 | byte, 0)
            token = self.ends[state]
            if token < 0:
                self.ends[state] = self.ends[back[state]]
            else:
                self.shorter[token] = self.ends[back[state]]
            queue.extend((state, b, to) for b, to in below.get(state, ()))
        self.back = back
        self.size = [len(self.spelled.get(i, b"")) for i in range(max(self.spelled) + 1)]
        self.alone = [i in self.parts or n == 1 for i, n in enumerate(self.size)]  # merging its bytes gives it
        self.named = {str(i): token for i, token in self.spelled.items()}

    def _step(self, key: int) -> int:
        """State after one that has no edge for the byte."""
        state, byte = key >> 8, key & 255
        while state and state << 8 | byte not in self.go:
            state = self.back[state]
        found = self.go.get(state << 8 | byte, 0)
        if len(self.go) < 4 * CACHED:
            self.go[key] = found
        return found

    def stands(self, left: int, right: int, limit: float = float("inf")) -> bool:
        """Whether two tokens side by side are what merging makes of their bytes, with merges of
        ranks under the limit. The merges that formed them are undone from the last one back; they
        stand unless at some time the neighbours at the bound would have merged first."""
        key, before = left << 20 | right, limit
        found = self.firm.get(key)
        if found is None:
            found = True
            while found:
                rank = self.merges.get((left, right))
                if rank is not None and rank < before:
                    found = False
                    break
                l, r = self.parts.get(left), self.parts.get(right)
                if l is None and r is None:
                    break
                if r is None or (l is not None and l[0] > r[0]):
                    before, left = l[0], l[2]        # of equal ranks the one further left goes first
                else:
                    before, right = r[0] + 1, r[1]   # so the bound precedes an equal rank on its right
            if len(self.firm) >= 2 * CACHED:
                self.firm.clear()
            self.firm[key] = found
        return found

    @cached_property
    def lookahead(self) -> int:
        """Bytes after a token that can matter for it. A merge is undone by one of lower rank that
        takes its last part away to the right, which in turn may be undone by a lower one: the
        longest such chain, in bytes."""
        reach: dict[int, int] = {}  # token to the bytes right of it that merges so far may involve
        most = 0
        for (left, right), _ in sorted(self.merges.items(), key=lambda m: m[1]):
            spine, further = right, reach.get(right, 0)
            while spine in self.parts:
                spine = self.parts[spine][2]
                further = max(further, reach.get(spine, 0))
            reach[left] = max(reach.get(left, 0), len(self.spelled[right]) + further)
            most = max(most, reach[left])
        return most

    def tokens(self, piece: bytes) -> Iterator[int]:
        """Ids of a piece of text, as they become final."""
        if len(piece) <= HELD:
            yield from self._short(piece)
            return
        go, ends, shorter, width, firm, longest = self.go, self.ends, self.shorter, self.size, self.firm, self.longest
        n = len(piece)
        hold = HELD + longest + self.lookahead
        gone, state = 0, 0           # bytes before the held ones; state of the automaton
        last: list[int] = [-1]       # of each held prefix, the last token; -1 where all before has left
        size: list[int] = [0]
        for end, byte in enumerate(piece, 1):
            key = state << 8 | byte
            state = go.get(key, -1)
            if state < 0:
                state = self._step(key)
            token = ends[state]
            while token >= 0:
                before = last[end - width[token] - gone]
                if before is not None:
                    if before >= 0:
                        good = firm.get(before << 20 | token)
                        if good is None:
                            good = self.stands(before, token)
                    else:
                        good = self.alone[token]
                    if good:
                        break
                token = shorter[token]
            last.append(token if token >= 0 else None)  # None: no encoding of the whole ends here
            size.append(width[token] if token >= 0 else 0)
            if end - gone >= hold and end < n:
                cut = self._agreed(last, size, longest)
                if cut:
                    yield from self._chain(last, size, cut)
                    last, size = last[cut:], size[cut:]
                    gone += cut
        yield from self._chain(last, size, n - gone)

    def _short(self, piece: bytes) -> list[int]:
        """Ids of a piece that is held whole."""
        go, ends, shorter, width, firm, alone = self.go, self.ends, self.shorter, self.size, self.firm, self.alone
        state, last = 0, [-1] * (len(piece) + 1)
        for end, byte in enumerate(piece, 1):
            key = state << 8 | byte
            state = go.get(key, -1)
            if state < 0:
                state = self._step(key)
            token = ends[state]
            while token >= 0:
                start = end - width[token]
                if not start:
                    if alone[token]:
                        break
                else:
                    before = last[start]
                    if before >= 0:
                        good = firm.get(before << 20 | token)
                        if good is None:
                            good = self.stands(before, token)
                        if good:
                            break
                token = shorter[token]
            last[end] = token
        out, at = [], len(piece)
        while at > 0 and last[at] >= 0:
            out.append(last[at])
            at -= width[last[at]]
        out.reverse()
        return out

    @staticmethod
    def _chain(last: list[int], size: list[int], at: int) -> list[int]:
        out = []
        while at > 0 and size[at]:
            out.append(last[at])
            at -= size[at]
        return out[::-1]

    @staticmethod
    def _agreed(last: list[int], size: list[int], longest: int) -> int:
        """The latest bound that the encodings of all prefixes a later token may follow share."""
        ends = {at for at in range(len(last) - longest, len(last)) if at > 0 and last[at] is not None}
        while len(ends) > 1:
            top = max(ends)
            ends.remove(top)
            ends.add(top - size[top])
        return ends.pop() if ends else 0

    def encode(self, text: str) -> Iterator[int]:
        """Ids of a text, as they become final. Added tokens in the text become their ids."""
        for part, added in self._parts(text):
            if added:
                yield self.added[part]
            else:
                for found in self.pieces.finditer(part):
                    yield from self.tokens(found[0].encode("utf-8", "surrogatepass"))

    def _parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """Stretches of text, and the added tokens between them."""
        parts = self.split_added.splititer(text) if self.split_added else [text]
        for i, part in enumerate(parts):
            yield part, i % 2 == 1

    def piece(self, word: str) -> str:
        """Decimal ids, joined by commas, of a piece between bounds of the pattern."""
        found = ",".join(map(str, self.tokens(word.encode("utf-8", "surrogatepass"))))
        if len(word) <= 64:
            if len(self.known) >= CACHED:
                self.known.clear()
            self.known[word] = found
        return found

    def encode_all(self, text: str) -> np.ndarray:
        """Ids of a text at once."""
        known, piece = self.known, self.piece
        found = []
        for part, added in self._parts(text):
            if added:
                found.append(str(self.added[part]))
            else:
                found.extend([known.get(m[0]) or piece(m[0]) for m in self.pieces.finditer(part)])
        return np.array(",".join(found).split(","), np.int32) if found else np.zeros(0, np.int32)

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, SHA-256 of the ids joined by commas, SHA-256 of the decoded text."""
        sums, known, piece = Sums(self), self.known, self.piece
        held: list[str] = []
        for part, added in self._parts(text):
            if added:
                held.append(str(self.added[part]))
                continue
            for found in self.pieces.finditer(part):
                word = found[0]
                ids = known.get(word)
                if ids is None and len(word) > HELD:  # its ids go on as they become final
                    for token in self.tokens(word.encode("utf-8", "surrogatepass")):
                        held.append(str(token))
                        if len(held) >= FLUSH:
                            sums.add(held)
                            held = []
                    continue
                held.append(ids or piece(word))
                if len(held) >= FLUSH:
                    sums.add(held)
                    held = []
        sums.add(held)
        return sums.finish()


class Sums:
    """Digests of a stream of ids and of what they decode to."""

    def __init__(self, bpe: Bpe):
        self.total, self.named = 0, bpe.named
        self.ids, self.text, self.decoder = hashlib.sha256(), hashlib.sha256(), Decoder(bpe)

    def add(self, pieces: list[str]) -> None:
        """Ids in decimal, several to a piece."""
        if pieces:
            joined = ",".join(pieces)
            self.ids.update(("," + joined if self.total else joined).encode())
            ids = joined.split(",")
            self.total += len(ids)
            named = self.named
            self.text.update(self.decoder.step(b"".join([named[i] for i in ids])).encode())

    def finish(self) -> tuple[int, str, str]:
        self.text.update(self.decoder.step(b"", True).encode())
        return self.total, self.ids.hexdigest(), self.text.hexdigest()


class Decoder:
    """Bytes of tokens to text in steps: bytes of a character that has not ended wait for the next
    step, bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, bpe: Bpe):
        self.spelled = bpe.spelled
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def step(self, data: bytes, final: bool = False) -> str:
        return self.machine.decode(data, final)

    def text(self, ids, final: bool = True) -> str:
        return self.step(b"".join([self.spelled[i] for i in ids]), final)


_LOADED: dict[int, Bpe] = {}


def loaded(source: str) -> Bpe:
    """One encoder per Python worker and vocabulary, with what it has learned of pieces."""
    key = hash(source)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(source)
    return _LOADED[key]


def _source(df: DataFrame, path: str):
    """The vocabulary file, read once on the driver and sent to the executors."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each row: the whole text encoded, and the ids
    decoded again. A null text counts as empty: no token, and the digests of the empty string."""
    rows = renamed(docs, id_col, text_col)
    source = _source(rows, path)

    def work(batches) -> Iterator[pa.RecordBatch]:
        bpe = loaded(source.value)
        for part in slices(batches):
            found = [bpe.digest(t or "") for t in part.column(1).to_pylist()]
            counts, ids, texts = zip(*found, strict=True)
            yield pa.record_batch({"id": part.column(0), "n_tokens": pa.array(counts, pa.int64()),
                                   "ids_sha256": pa.array(ids), "decoded_sha256": pa.array(texts)})

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, work, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def encode_rows(docs: DataFrame, path: str, text_col: str = "text",
                added: tuple[str, str, str] = ("n_tokens", "ids", "decoded_same")) -> DataFrame:
    """Rows of `docs`, all columns, with n_tokens, ids, and decoded_same: whether the ids decode to
    the text again, which they do for every text (a null text, without ids, counts as empty).
    `added` names these columns; names that `docs` has already are an error."""
    source = _source(docs, path)

    def work(batches) -> Iterator[pa.RecordBatch]:
        bpe = loaded(source.value)
        try:
            for part in slices(batches, text_col):
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                ids = [bpe.encode_all(t or "") for t in texts]
                same = [Decoder(bpe).text(x.tolist()) == (t or "") for x, t in zip(ids, texts, strict=True)]
                bounds = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.diff(bounds)), pa.ListArray.from_arrays(
                        bounds.astype(np.int32), pa.array(flat, pa.int32())), pa.array(same)],
                    names=[*part.schema.names, *added])
        finally:  # later stages of a pipeline run in the same workers
            _LOADED.clear()

    taken = {c.lower() for c in docs.columns}
    if clash := [c for c in added if c in taken]:
        raise ValueError(f"documents already have {', '.join(clash)}; rename them first")
    kinds = (T.LongType(), T.ArrayType(T.IntegerType()), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, added, kinds)])
    return mapped(docs, work, schema)


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of each row; a null or empty text has an empty list."""
    rows = renamed(docs, id_col, text_col)
    source = _source(rows, path)

    def work(batches) -> Iterator[pa.RecordBatch]:
        bpe = loaded(source.value)
        for part in slices(batches):
            ids = [list(bpe.encode(t or "")) for t in part.column(1).to_pylist()]
            yield pa.record_batch({"id": part.column(0), "ids": pa.array(ids, pa.list_(pa.int32()))})

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, work, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows of ids; null ids give a null text."""
    rows = encoded.select(encoded[f"`{id_col}`"].alias("id"), encoded[f"`{ids_col}`"].alias("ids"))
    source = _source(rows, path)

    def work(batches) -> Iterator[pa.RecordBatch]:
        bpe = loaded(source.value)
        for batch in batches:
            texts = [None if ids is None else Decoder(bpe).text(ids) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch({"id": batch.column(0), "text": pa.array(texts, pa.string())})

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, work, f"id {kind}, text string").withColumnRenamed("id", id_col)
