"""Token ids of whole texts by a public byte-level tokenizer, each distinct piece encoded once.

The tokenizer never merges across the blank before a word, between a letter and
a following punctuation mark, nor around a lone line break between two visible
characters. A text is cut there, the distinct
pieces of a slice are looked up or encoded with the tokenizers library, and the
ids are laid out again. A text that holds a special token's string is encoded
whole, since the library splits there first. Pieces are told apart by two hashes of 64 bits.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers

from . import words as W

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
_MOST_PIECES = 1_000_000  # remembered by one worker (about 45 MB); then it starts anew

_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[33:127] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_INK = _VISIBLE.copy()  # a byte that no blank character begins with
_INK[0xC3:0xE1] = _INK[0xE4:0xF5] = True
_MARK = _VISIBLE & ~_LETTER
_MARK[48:58] = False

_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str = BYTE_BPE) -> Encoder:
    """The encoder of this process; pieces seen by earlier tasks stay known."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.blank_first = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.blank_first[i] = token.startswith("\u0120")
        self._reset()

    def _reset(self) -> None:
        # Of each known piece, in order of its hash: a second hash, and where its ids lie.
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int32)
        self.count = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _library(self, texts: list[bytes]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [x.ids for x in found]

    def _ids_of(self, pieces: list[bytes], single: bool) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)`` of distinct pieces.

        Pieces that hold one blank, at their start (``single``), are encoded as one
        text: the library cuts before each, and each one's first id is the only
        one whose token begins with a blank.
        """
        if single:
            ids = np.array(self._library([b"".join(pieces)])[0], np.uint32)
            starts = np.flatnonzero(self.blank_first[ids])
            if len(starts) == len(pieces):
                return ids, np.diff(np.append(starts, len(ids)))
        found = self._library(pieces)
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum())), count

    def _learn(self, pieces: list[bytes], single: bool) -> tuple[np.ndarray, np.ndarray]:
        """Encodes new pieces and keeps their ids: ``(first, count)`` of each."""
        ids, count = self._ids_of(pieces, single)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        first = self.used + np.cumsum(count) - count
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return first, count

    def _slots(
        self, keys: np.ndarray, checks: np.ndarray, single: np.ndarray, pieces_at: Callable[[np.ndarray], list[bytes]]
    ) -> tuple[np.ndarray, np.ndarray] | None:
        """``(first, count)`` of the distinct pieces of these hashes, or None where two share a hash.

        ``single`` tells which hold one blank, at their start. ``pieces_at`` gives
        the bytes of the pieces at given places; it is asked for new ones alone.
        """
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        inside = np.minimum(at, max(len(self.keys) - 1, 0))
        known = self.keys[inside] == keys[order] if len(self.keys) else np.zeros(len(keys), dtype=bool)
        if (self.checks[inside[known]] != checks[order[known]]).any():
            return None
        first, count = np.empty(len(keys), np.int32), np.empty(len(keys), np.int32)
        first[order[known]], count[order[known]] = self.first[at[known]], self.count[at[known]]
        new = order[~known]
        if len(new):
            for kind in (True, False):
                these = new[single[new] == kind]
                for k in range(0, len(these), 4096):
                    part = these[k : k + 4096]
                    first[part], count[part] = self._learn(pieces_at(part), kind)
            at = at[~known]
            self.keys = np.insert(self.keys, at, keys[new])
            self.checks = np.insert(self.checks, at, checks[new])
            self.first = np.insert(self.first, at, first[new])
            self.count = np.insert(self.count, at, count[new])
        return first, count

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, first)``: the ids of all texts, and where each text's begin."""
        data, offsets = W.flat(texts)
        whole = data.tobytes()
        if any(s in whole for s in self.specials):
            return self._encode_apart(whole, offsets)
        return self._encode_plain(data, offsets)

    def _encode_apart(self, whole: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            text = whole[a:b]
            if any(s in text for s in self.specials):
                parts.append(np.array(self._library([text])[0], np.uint32))
            else:
                one = np.frombuffer(text, np.uint8)
                parts.append(self._encode_plain(one, np.array([0, len(one)]))[0])
        first = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), first

    def _encode_plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        visible = _VISIBLE[data]
        opens = np.zeros(len(data), dtype=bool)
        opens[:-1] = (data[:-1] == 32) & _INK[data[1:]]
        letter = _LETTER[data]
        # The Latin letters of two bytes that begin with 0xC3; multiplication and division signs are none.
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        opens[1:] |= letter[:-1] & _MARK[data[1:]]
        lone = np.flatnonzero((data[1:-1] == 10) & visible[2:] & visible[:-2]) + 1
        opens[lone] = True
        opens[lone + 1] = True
        opens[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(opens)
        length = np.diff(np.append(start, len(data)))
        keys = W.hash_spans(data, start, length)
        codes = pa.array(keys).dictionary_encode().indices.to_numpy()
        newest = np.maximum.accumulate(codes)
        sample = np.flatnonzero(np.append(True, newest[1:] != newest[:-1]))  # where each kind first stands
        checks = W.hash_spans(data, start, length, seed=1)
        whole = data.tobytes()
        if len(self.keys) > _MOST_PIECES:
            self._reset()
        found = None
        if not (checks != checks[sample][codes]).any():
            low, high = start[sample], start[sample] + length[sample]
            blanks = np.concatenate([np.zeros(1, np.int32), np.cumsum(data == 32, dtype=np.int32)])
            found = self._slots(
                keys[sample],
                checks[sample],
                (data[low] == 32) & (blanks[high] - blanks[low] == 1),
                lambda k: [whole[a:b] for a, b in zip(low[k].tolist(), high[k].tolist(), strict=True)],
            )
        if found is None:  # two pieces of one hash
            texts = [whole[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            parts = [np.array(x, np.uint32) for x in self._library(texts)]
            first = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
            return np.concatenate(parts), first
        begin, count = found[0][codes], found[1][codes].astype(np.int64)
        ids = self.ids[W.ranges(begin, count)]
        first = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(start, offsets)]
        return ids, first


def with_end(ids: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id ``end`` after each text."""
    return np.insert(ids, first[1:], np.uint32(end)), first + np.arange(len(first))
