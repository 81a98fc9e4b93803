"""Pre-tokens of byte-level BPE, found on flat arrays, and their pieces.

Splits as the pattern of the byte-level pre-tokenizer does: contractions,
letters, numbers and others with one space before, white space. No piece
crosses a pre-token, so each distinct one needs the tokenizer only once.
"""

from __future__ import annotations

import os
import unicodedata
from functools import lru_cache

import numpy as np

from larkmetric.llm import arrays

OTHER, LETTER, NUMBER, SPACE = range(4)
#: White space as Unicode defines it.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Contractions that the pattern splits off.
CONTRACTIONS = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[SPACES] = SPACE
    return table


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place and class of each character of UTF-8 bytes."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at]
    code = lead.astype(np.int32)
    more = np.flatnonzero(lead >= 0xC0)
    if len(more):
        place, first = at[more], lead[more].astype(np.int32)
        pad = np.concatenate([data, np.zeros(3, np.uint8)])
        b1, b2, b3 = ((pad[place + i] & 0x3F).astype(np.int32) for i in (1, 2, 3))
        code[more] = np.select(
            [first < 0xE0, first < 0xF0],
            [(first & 0x1F) << 6 | b1, (first & 0x0F) << 12 | b1 << 6 | b2],
            (first & 0x07) << 18 | b1 << 12 | b2 << 6 | b3,
        )
    return at, _classes()[code]


def split(data: np.ndarray, bounds: np.ndarray, special: tuple[bytes, ...] = ()) -> np.ndarray:
    """Where each pre-token of all texts begins, in bytes; each ends where the next begins."""
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.int64)
    cuts, inside = [bounds], []
    for token in special:
        held, at = data.tobytes() if token[0] in data else b"", -1
        while (at := held.find(token, at + 1)) >= 0:
            if np.searchsorted(bounds, at, side="right") == np.searchsorted(bounds, at + len(token) - 1, side="right"):
                cuts.append(np.array([at, at + len(token)]))
                inside.append((at + 1, at + len(token)))
                at += len(token) - 1
    at, kind = _characters(data)
    edge = np.zeros(len(at) + 1, dtype=bool)
    edge[np.searchsorted(at, np.concatenate(cuts))] = True
    edge[len(at)] = True
    start = edge[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # The last white space before something else stands alone, or, if a space, goes with it.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:-1])
    start[last] = True
    start[last[data[at[last]] == 32] + 1] = False
    byte = data[at]
    quote = np.flatnonzero((byte == 39) & start)
    for tail in CONTRACTIONS:
        k = len(tail)
        fits = quote[quote + k < len(at)]
        for i, b in enumerate(tail, 1):
            fits = fits[(byte[fits + i] == b) & ~edge[fits + i]]
        start[fits + 1] = False
        after = fits + k + 1
        start[after[after < len(at)]] = True
    out = at[start]
    for low, high in inside:
        out = out[(out < low) | (out >= high)]
    return out


class Pieces:
    """The ids of pre-tokens by hash, each asked of the tokenizer once while held.

    At most ``limit`` pre-tokens are held; then it starts anew. ``plain`` takes
    special strings in a text as ordinary text.
    """

    def __init__(self, path: str, limit: int = 1_000_000, plain: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [] if plain else self.tokenizer.get_added_tokens_decoder().values()
        self.special = tuple(t.content.encode() for t in added)
        self.limit = limit
        self._clear()

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.start = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def look_up(self, keys: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows of ``start``, ``count`` for distinct sorted ``keys``, whose bytes are ``data[start:end]``."""
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        new = np.flatnonzero(~known)
        if len(new):
            if len(self.keys) + len(new) > self.limit and len(self.keys):
                self._clear()
                return self.look_up(keys, data, starts, ends)
            words = [data[i:j].decode("utf-8", "replace") for i, j in zip(starts[new].tolist(), ends[new].tolist())]
            found = self._encode(words)
            count = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter((i for x in found for i in x), np.uint32, int(count.sum()))
            all_keys = np.concatenate([self.keys, keys[new]])
            order = np.argsort(all_keys, kind="stable")
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])[order]
            self.count = np.concatenate([self.count, count])[order]
            self.ids = np.concatenate([self.ids, ids])
            self.keys = all_keys[order]
            at = np.searchsorted(self.keys, keys)
        return at


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    """One holder in each Python worker."""
    return Pieces(path)


def text_of(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The text that each start lies in."""
    return np.searchsorted(bounds, starts, side="right") - 1


def hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends and hashes of pre-tokens."""
    ends = np.append(starts[1:], len(data))
    return ends, arrays.span_hashes(arrays.BYTE_VALUE[data], starts, ends)
