"""Words and tokenizer ids of whole batches of texts, by Arrow's string functions; Python sees distinct strings only."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space as the tokenizer sees it, besides space and line feed.
_RARE_SPACE = r"\t\x0b\x0c\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Texts that need the tokenizer as a whole: white space other than single spaces and line feeds, or the separator.
_IRREGULAR = rf"[ \n][ \n]|[{_RARE_SPACE}]|\x00"
_BREAK = "\x00"
#: Most strings whose ids or hashes a worker remembers.
REMEMBERED = 600_000
#: Strings that go to the tokenizer at a time: what it returns takes many times their ids.
ENCODED = 1 << 13


def _coded(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of the non-empty strings of all lists, the dictionary, and how many each list has."""
    values = lists.flatten()
    lengths = np.diff(lists.offsets.to_numpy())
    full = pc.not_equal(pc.binary_length(values), 0)
    coded = values.filter(full).dictionary_encode()
    rows = np.repeat(np.arange(len(lists)), lengths)[full.to_numpy(zero_copy_only=False)]
    return coded.indices.to_numpy().astype("int64"), coded.dictionary, np.bincount(rows, minlength=len(lists))


def words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Runs of anything but space, tab and line breaks, with A-Z lower-cased: codes, dictionary and words of each text."""
    return _coded(pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))))


def ragged(starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places of the parts ``starts[c] .. starts[c] + lengths[c]`` of all codes, one after the other."""
    each = lengths[codes]
    ends = np.cumsum(each)
    return np.repeat(starts[codes] - (ends - each), each) + np.arange(int(ends[-1]) if len(ends) else 0)


class Ids(dict):
    """Ids of strings as little-endian unsigned 32-bit bytes, looked up in batches and remembered first come, first kept."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    def of(self, strings: list[str]) -> list[bytes]:
        found = list(map(self.get, strings))
        new = [i for i, ids in enumerate(found) if ids is None]
        for at in range(0, len(new), ENCODED):
            some = new[at : at + ENCODED]
            done = self.tokenizer.encode_batch_fast([strings[i] for i in some], add_special_tokens=False)
            for i, encoding in zip(some, done):
                found[i] = np.array(encoding.ids, "<u4").tobytes()
                if len(self) < REMEMBERED:
                    self[strings[i]] = found[i]
        return found

    def parts(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each string, and all ids."""
        found = self.of(strings)
        return np.array([len(x) // 4 for x in found], "int64"), np.frombuffer(b"".join(found), "<u4")

    def texts(self, texts: pa.Array) -> list[bytes]:
        """Ids of whole texts.

        Before a single space or line feed the tokenizer always begins anew, so a text splits there; a unit keeps
        the space before it. Texts with other white space go to the tokenizer whole.
        """
        texts = pc.fill_null(texts, "")
        whole = np.flatnonzero(pc.match_substring_regex(texts, _IRREGULAR).to_numpy(zero_copy_only=False))
        if len(whole):
            regular = np.ones(len(texts), bool)
            regular[whole] = False
            split = pc.if_else(pa.array(regular), texts, "")
        else:
            split = texts
        marked = pc.replace_substring(pc.replace_substring(split, "\n", f"{_BREAK}\n{_BREAK}"), " ", f"{_BREAK} ")
        codes, dictionary, counts = _coded(pc.split_pattern(marked, _BREAK))
        lengths, ids = self.parts(dictionary.to_pylist())
        flat = ids[ragged(np.cumsum(lengths) - lengths, lengths, codes)]
        ends = np.cumsum(np.bincount(np.repeat(np.arange(len(texts)), counts), lengths[codes], len(texts)).astype("int64"))
        data = flat.tobytes()
        out = [data[4 * a : 4 * b] for a, b in zip(np.concatenate(([0], ends[:-1])), ends)]
        for i in whole:
            out[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4").tobytes()
        return out


_loaded: dict[str, Ids] = {}


def ids(path: str) -> Ids:
    if path not in _loaded:
        _loaded[path] = Ids(path)
    return _loaded[path]


def slices(lengths: np.ndarray, most_bytes: int) -> list[tuple[int, int]]:
    """Runs of rows (start, number) of about ``most_bytes``; a longer row ends its run."""
    out, start, ends = [], 0, np.cumsum(lengths)
    while start < len(lengths):
        before = ends[start - 1] if start else 0
        stop = min(len(lengths), int(np.searchsorted(ends, before + most_bytes)) + 1)
        out.append((start, stop - start))
        start = stop
    return out
