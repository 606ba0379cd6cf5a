"""Pre-token pieces of a byte-level vocabulary and their ids, and encoders by rank."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable

import numpy as np
import regex

#: Remembered pieces; beyond it the memory starts afresh.
MOST_PIECES = 300_000


class PieceIds:
    """ids of pieces as little-endian 32-bit bytes; each distinct piece is encoded once."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], pattern: str):
        self.encode = encode
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        if len(self.known) > MOST_PIECES:
            self.known.clear()
        new = [p for p in pieces if p not in self.known]
        for piece, ids in zip(new, self.encode(new)):
            self.known[piece] = ids

    def of(self, pieces: list[str]) -> bytes:
        self.learn(set(pieces))
        return b"".join(map(self.known.__getitem__, pieces))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankEncoder:
    """ids by rank, as little-endian 32-bit bytes, without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.find = regex.compile(pattern).findall

    def text(self, text: str) -> bytes:
        try:
            return self.coder.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        except ValueError:  # the library's own pattern search gives up on very long blanks
            return b"".join(self.piece(p) for p in self.find(text))

    def piece(self, piece: str) -> bytes:
        return np.array(self.coder._encode_single_piece(piece), "<u4").tobytes()


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabulary files write for each byte, and the byte.

    Printable bytes of Latin-1 stand for themselves, the others for the letters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def plain_ranks(tokenizer_json: str) -> dict[bytes, int] | None:
    """Token bytes and ids of a vocabulary file whose ids are the order of its merges; else None.

    Then merging by rank gives the file's own ids. Needed: byte-level BPE without normalizer,
    unknown token, affixes or dropout; an id for each byte; merges in the order of their ids.
    """
    file = json.loads(tokenizer_json)
    model, parts = file["model"], file.get("pre_tokenizer") or {}
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if model["type"] != "BPE" or file.get("normalizer") or any(model.get(k) for k in odd):
        return None
    if parts.get("type") != "ByteLevel" or parts.get("add_prefix_space") or not parts.get("use_regex", True):
        return None
    letters = byte_letters()
    vocabulary: dict[str, int] = model["vocab"]
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
    ids = [vocabulary.get(token, -1) for token in merged]
    if any(c not in vocabulary for c in letters) or any(a >= b for a, b in zip(ids, ids[1:])):
        return None
    if any(c not in letters for token in merged for c in token):
        return None
    ranks = {bytes([letters[c]]): vocabulary[c] for c in letters}
    first = max(ranks.values())
    if ids and (ids[0] <= first or len(ranks) + len(ids) != len(set(ranks.values()) | set(ids))):
        return None
    return ranks | {bytes(letters[c] for c in token): k for token, k in zip(merged, ids)}
