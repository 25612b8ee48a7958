"""Tokens of the two kinds of tokenizers, byte-level and with word-begin pieces, and the bytes that each token stands for."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quayside.llm.tokens import _BREAK, _coded, ragged

#: Stands for a space in pieces.
SPACE = "▁"
#: Texts that go to the piece tokenizer as a whole: more than one space at a time, or what the splitting uses.
_IRREGULAR = rf"  |^ |{_BREAK}|{SPACE}"
#: Most units whose ids a worker remembers.
REMEMBERED = 200_000


@dataclass
class TokenBytes:
    """The bytes of every token of a vocabulary, end to end."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, each: list[bytes]) -> TokenBytes:
        lengths = np.array([len(x) for x in each], "int64")
        return cls(np.frombuffer(b"".join(each), "uint8"), np.cumsum(lengths) - lengths, lengths)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.starts, self.lengths, ids)]


def byte_level_bytes(path: str) -> list[bytes]:
    """Bytes of the tokens of a byte-level vocabulary: bytes that print stand for themselves, the others for 256, 257, ..."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}
    with open(path, encoding="utf-8") as file:
        listed = json.load(file)
    strings = {i: s for s, i in listed["model"]["vocab"].items()}
    out = {i: bytes(byte[c] for c in s) for i, s in strings.items()}
    out |= {x["id"]: x["content"].encode() for x in listed["added_tokens"]}
    return [out.get(i, b"") for i in range(max(out) + 1)]


class Pieces:
    """Ids of a piece tokenizer that puts a space before each text.

    No piece holds a space after another character, or a line feed at all, so a text splits before every single space
    and line feed; distinct units are encoded once and remembered.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.known: dict[str, bytes] = {" ": self._bytes([self.model.piece_to_id(SPACE)])}

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def token_bytes(self) -> list[bytes]:
        out = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            out.append(bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i) else piece.replace(SPACE, " ").encode())
        return out

    def _encode(self, units: list[str]) -> list[bytes]:
        """Units begin with a space, which the tokenizer adds, or a line feed, before which it adds one."""
        ids = self.model.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return [self._bytes(x if u[0] == " " else x[1:]) for u, x in zip(units, ids)]

    def of(self, units: list[str]) -> list[bytes]:
        found = list(map(self.known.get, units))
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, self._encode([units[i] for i in new])):
            found[i] = ids
            if len(self.known) < REMEMBERED:
                self.known[units[i]] = ids
        return found

    def texts(self, texts: pa.Array) -> list[bytes]:
        """Ids of whole texts, each with a space before it; of an empty text none."""
        texts = pc.fill_null(texts, "")
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, _IRREGULAR).to_numpy(zero_copy_only=False)
        spaced = pc.if_else(pa.array(~(odd | empty)), pc.binary_join_element_wise(" ", texts, ""), "")
        marked = pc.replace_substring(pc.replace_substring(spaced, "\n", f"{_BREAK}\n"), " ", f"{_BREAK} ")
        codes, dictionary, counts = _coded(pc.split_pattern(marked, _BREAK))
        found = self.of(dictionary.to_pylist())
        lengths, flat = np.array([len(x) // 4 for x in found], "int64"), np.frombuffer(b"".join(found), "<u4")
        data = flat[ragged(np.cumsum(lengths) - lengths, lengths, codes)].tobytes()
        rows = np.repeat(np.arange(len(texts)), counts)
        ends = 4 * np.cumsum(np.bincount(rows, lengths[codes], len(texts)).astype("int64"))
        out = [data[a:b] for a, b in zip(np.concatenate(([0], ends[:-1])), ends)]
        whole = np.flatnonzero(odd)
        for i, ids in zip(whole, self.model.encode([texts[int(i)].as_py() for i in whole], num_threads=1)):
            out[i] = self._bytes(ids)
        return out
