"""Token ids of whole texts by a byte-level BPE vocabulary file; tokenizers are used, never trained.

The vocabulary's rule first cuts a text into pieces, and each piece has its ids whatever surrounds it.
Texts of ASCII and Latin-1 letters without apostrophes are cut in numpy, many at once, and ids of a
piece come from a bounded table by the piece's 64-bit hash; the encoder sees a piece only when it is
new. Other texts go to the encoder whole. The ids are those of the `tokenizers` library for the same
file, which adds no special token of its own but reads the name of one inside a text as that token;
with `special=False` such a name is ordinary text.
"""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from salesmill.llm.text import byte_class, raw_bytes, span_hashes

VOCABULARY = "byte_bpe_50k.json"
END = 1
CACHED_PIECES = 1 << 20

_SPACE, _LETTER, _NUMBER, _OTHER, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[0x21:0x7F] = _OTHER
_KIND[byte_class((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC3))] = _LETTER
_KIND[0x30:0x3A] = _NUMBER
_KIND[[0x20, 0x09, 0x0A, 0x0D]] = _SPACE
_KIND[0x27] = _ODD  # an apostrophe may begin a contraction

_loaded: dict[str, Encoder] = {}


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte; _ODD marks what the fast way does not know."""
    kind = _KIND[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[lead + 1 < len(data)]
    second = data[lead + 1]
    # Latin-1 letters are C3 80 to C3 BF, but for the signs of multiplication and division.
    good = (second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)
    kind[lead[good] + 1] = _LETTER
    return kind


def _pieces(data: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin, for texts without _ODD bytes.

    A piece is a run of one kind, with the one space before it; of other white space before it, the
    last character is a piece of its own and the rest another.
    """
    n = len(data)
    begins = np.zeros(n, bool)
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    space = kind == _SPACE
    changes = np.zeros(n, bool)
    changes[1:] = kind[1:] != kind[:-1]
    starts = begins | changes
    # White space whose next character is no space, inside one text.
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~begins[1:]
    starts |= last
    joined = np.flatnonzero(last & (data == 0x20)) + 1
    starts[joined] = False
    return np.flatnonzero(starts)


class Encoder:
    def __init__(self, path: str):
        ranks, names = _ranks(path), _special_names(path)
        self.special = [name.encode() for name in names]
        self.tokenizer = Tokenizer.from_file(path) if names else None
        self.whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.piece = tiktoken.Encoding("piece", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes of known pieces
        self.slot = np.zeros(0, np.int64)  # for each its place in `first`
        self.first = np.zeros(1, np.int64)  # where the ids of a place begin in `pool`
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        ids = [self.piece.encode_ordinary(p) for p in pieces]
        flat = np.fromiter((t for i in ids for t in i), np.uint32)
        places = len(self.first) - 1 + np.arange(len(ids))
        ends = self.first[-1] + np.cumsum([len(i) for i in ids])
        self.first, self.pool = np.concatenate([self.first, ends]), np.concatenate([self.pool, flat])
        known, slot = np.concatenate([self.known, hashes]), np.concatenate([self.slot, places])
        order = np.argsort(known, kind="stable")
        self.known, self.slot = known[order], slot[order]

    def _slow(self, text: str, named: bool) -> list[int]:
        if named:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.whole.encode_ordinary(text)

    def _encode_plain(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and the number of ids of each piece."""
        ends = np.append(starts[1:], len(data))
        hashes, at, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) + len(hashes) > CACHED_PIECES:
            self._forget()
        place = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != hashes[inside]
        if new.any():
            raw = data.tobytes()
            self._learn(hashes[new], [raw[starts[i] : ends[i]].decode() for i in at[new]])
            place = np.searchsorted(self.known, hashes)
        slot = self.slot[place][inverse]
        counts = self.first[slot + 1] - self.first[slot]
        total = np.cumsum(counts)
        source = np.repeat(self.first[slot] - (total - counts), counts) + np.arange(total[-1] if len(total) else 0)
        return self.pool[source], counts

    def _named(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts hold the name of a special token."""
        found, raw = np.zeros(len(offsets) - 1, bool), data.tobytes()
        for name in self.special:
            at = raw.find(name)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, side="right")) - 1
                found[text] |= at + len(name) <= offsets[text + 1]
                at = raw.find(name, at + 1)
        return found

    def encode(self, texts: pa.Array, special: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin; a null text has none."""
        data, offsets = raw_bytes(texts)
        kind = _kinds(data)
        odd = np.concatenate([[0], np.cumsum(kind == _ODD)])
        named = self._named(data, offsets) if special and self.special else np.zeros(len(texts), bool)
        plain = (odd[offsets[1:]] == odd[offsets[:-1]]) & ~named
        sizes = np.diff(offsets)
        counts = np.zeros(len(texts), np.int64)
        if plain.all():
            kept, kept_kind, kept_offsets = data, kind, offsets
        else:
            keep = np.repeat(plain, sizes)
            kept, kept_kind = data[keep], kind[keep]
            kept_offsets = np.concatenate([[0], np.cumsum(sizes[plain])])
        starts = _pieces(kept, kept_kind, kept_offsets)
        ids, per_piece = self._encode_plain(kept, starts)
        cut = np.concatenate([[0], np.cumsum(per_piece)])[np.searchsorted(starts, kept_offsets)]
        counts[plain] = np.diff(cut)
        if not plain.all():
            others = [
                np.array(self._slow(texts[int(i)].as_py(), bool(named[i])), np.uint32) for i in np.flatnonzero(~plain)
            ]
            counts[~plain] = [len(o) for o in others]
            parts, fast, slow = [], 0, iter(others)
            for i, easy in enumerate(plain.tolist()):
                if easy:
                    parts.append(ids[fast : fast + counts[i]])
                    fast += counts[i]
                else:
                    parts.append(next(slow))
            ids = np.concatenate(parts)
        return ids, np.concatenate([[0], np.cumsum(counts)])


def _vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _special_names(path: str) -> list[str]:
    return [t["content"] for t in _vocabulary(path).get("added_tokens", [])]


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id below the highest of a byte-level BPE file; special tokens have their names."""
    ranks = _ranks(path) | {t["content"].encode(): t["id"] for t in _vocabulary(path).get("added_tokens", [])}
    out = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        out[i] = token
    return out


def _ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a byte-level BPE file, whose ids follow the order of its merges."""
    vocabulary, special = _vocabulary(path), set(_special_names(path))
    # Byte-level vocabularies write a byte as itself if printable, else as the next character from 256 on.
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    return {bytes(byte[c] for c in token): i for token, i in vocabulary["model"]["vocab"].items() if token not in special}


def encoder(path: str | None = None) -> Encoder:
    """The encoder of a vocabulary file, loaded once per worker; by default the installed 50k file."""
    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]
