"""Token ids by the installed tokenizer libraries."""

import json
import os
import re
from array import array
from collections.abc import Callable

import numpy as np

from clientela.llm.bpe import PATTERN, byte_letters

LONG = 1 << 16  # characters from which a text is given to the piece model in parts

#: Blanks and what follows them up to the next: no piece has a blank after another character.
PIECE_STRETCHES = re.compile(r" *[^ ]+| +")


class Encoder:
    """Ids of texts. `spelled` holds the bytes of each id, `widths` how many they are; `lossless`: the
    bytes of a text's ids are those of the text, whatever it is."""

    def __init__(self, encode: Callable[[str], bytes], spelled: list[bytes], lossless: bool = False):
        self.encode, self.spelled, self.lossless = encode, spelled, lossless
        self.widths = np.array([len(s) for s in spelled], np.int64)

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        encode = self.encode
        return [encode(t) for t in texts]


def _as_ranks(described: dict) -> dict[bytes, int] | None:
    """Bytes of each token and its rank, if ids alone say how the described tokenizer merges: bytes
    first, then one token a merge in the order of merges, after the known pattern has split."""
    model, split, letters = described["model"], described["pre_tokenizer"] or {}, byte_letters()
    if (split.get("type") != "ByteLevel" or not split.get("use_regex") or split.get("add_prefix_space")
            or described["normalizer"] or model.get("dropout") or model.get("ignore_merges")
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] and described["normalizer"]
                   for t in described["added_tokens"])):
        return None
    added = {t["content"] for t in described["added_tokens"]}
    vocab = {t: i for t, i in model["vocab"].items() if t not in added}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if (len(vocab) != 256 + len(merges) or {vocab.get(c) for c in letters} != set(range(256))
            or any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges))):
        return None
    return {bytes(letters[c] for c in t): i for t, i in vocab.items()}


def byte_level(source: str, plain: bool = False) -> Encoder:
    """Ids as the tokenizers library gives them for the tokenizer of a JSON text, without truncation,
    padding and adding special tokens. `plain`: the strings of special tokens in a text are text.

    Where the ids are ranks of merges, tiktoken computes them, which gives the same ids in a fifth of
    the time; other tokenizers, and texts that it gives up on, are left to the tokenizers library."""
    described = json.loads(source)
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    letters = byte_letters()
    spelled = [b""] * (1 + max([*described["model"]["vocab"].values(), *special.values()]))
    for token, i in described["model"]["vocab"].items():
        spelled[i] = bytes(letters.get(c, 0) for c in token)
    for token, i in special.items():
        spelled[i] = token.encode()
    held = []

    def library(text: str) -> bytes:
        if not held:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            made = Tokenizer.from_str(source)
            made.no_truncation()
            made.no_padding()
            made.encode_special_tokens = plain
            held.append(made)
        return array("i", held[0].encode(text, add_special_tokens=False).ids).tobytes()

    ranks = _as_ranks(described)
    if ranks is None:
        return Encoder(library, spelled)
    import tiktoken
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={} if plain else special)

    def encode(text: str) -> bytes:
        try:
            return fast.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<i4", copy=False).tobytes()
        except BaseException as error:  # the pattern's matcher stops at some very long runs with an error of its own kind
            if type(error).__name__ not in ("PanicException", "ValueError"):
                raise
            return library(text)

    return Encoder(encode, spelled, lossless=True)


def piece_model(source: bytes) -> Encoder:
    """Ids of the model of a file, by the sentencepiece library. Long texts are cut where no piece
    can join both sides, as the library's work and memory are those of a text at a time."""
    from sentencepiece import SentencePieceProcessor
    library = SentencePieceProcessor(model_proto=source)
    spelled, apart = [], True
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        spelled.append(bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace("▁", " ").encode())
        apart = apart and "▁" not in piece.lstrip("▁")
    blank = [library.piece_to_id("▁")]  # a last blank by itself, for which the library has nothing to add one to

    def encode(text: str) -> bytes:
        if len(text) < LONG or not apart or "▁" in text:
            return array("i", library.encode(text)).tobytes()
        parts, held, size = [], [], 0
        for stretch in PIECE_STRETCHES.findall(" " + text):
            if size >= LONG:
                parts.append("".join(held))
                held, size = [], 0
            held.append(stretch)
            size += len(stretch)
        parts.append("".join(held))
        return b"".join(array("i", library.encode(p[1:]) or blank).tobytes() for p in parts)

    return Encoder(encode, spelled)
