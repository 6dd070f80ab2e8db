"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding.

A word's symbols arrive one by one. The encoding of every prefix is one token
more than the encoding of a shorter prefix, so a prefix needs only its last
token. Two tokens may stand side by side exactly if the merge list would leave
them so; that is decided once for each pair. The token that covers the next
symbol begins at most a token's length back, so only the last ``lookahead``
prefixes can still matter, where ``lookahead`` is the length of the longest
token that the merges form. What all of those agree on is stable, and is
emitted; only the symbols after it are held.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import words as W

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
_MOST_WORDS = 300_000  # remembered by one worker; then it starts anew
_MOST_PAIRS = 1_000_000
_MEMO_BITS = 20
_LOCKSTEP_BYTES = 64  # words up to this length go through the transducer many at a time

_CODECS: dict[str, WordBpe] = {}


def codec(path: str = WORD_BPE) -> WordBpe:
    if path not in _CODECS:
        _CODECS[path] = WordBpe(path)
    return _CODECS[path]


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 0x100
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class Merges:
    """A merge list, and which tokens it would leave side by side.

    A run of symbols is a string; its last symbol may carry the end mark.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.suffix = suffix
        self.rank: dict[int, int] = {}  # of a pair of tokens
        self.joined: dict[int, int] = {}
        for rank, (a, b) in enumerate(merges):
            key = vocab[a] << 32 | vocab[b]
            self.rank[key], self.joined[key] = rank, vocab[a + b]
        self.vocab = vocab
        self.formed: dict[str, int] = {}  # tokens that the merges do form from their own symbols
        self.lookahead = 1
        births: dict[int, int] = {}
        parents: dict[int, tuple[int, int, int]] = {}  # the last merge: left, right, rank
        for text, i in vocab.items():
            symbols = self.symbols(text)
            if symbols is None:
                continue
            last = None
            while len(symbols) > 1 and (step := self._step(symbols)):
                last = (symbols[step[1]], symbols[step[1] + 1], step[0])
                symbols[step[1] : step[1] + 2] = [step[2]]
            if symbols == [i]:
                self.formed[text] = i
                self.lookahead = max(self.lookahead, len(text.removesuffix(suffix)))
                births[i] = last[2] if last else -1
                if last:
                    parents[i] = last
        for left, right, rank in parents.values():
            if births.get(left, rank) >= rank or births.get(right, rank) >= rank:
                raise ValueError("the merge list uses a token before it forms it")
        # Of each token: what its right (left) end is during the merges, from which rank, until which.
        never = len(merges)
        self.right_end = {i: self._ends(i, 1, births, parents, never) for i in births}
        self.left_end = {i: self._ends(i, 0, births, parents, never) for i in births}
        self.pairs: dict[int, bool] = {}
        self.tree: dict = {}  # by symbol; "" holds the token that ends there
        for text, i in self.formed.items():
            node = self.tree
            for symbol in self.cut(text):
                node = node.setdefault(symbol, {})
            node[""] = i

    def cut(self, text: str) -> list[str]:
        """A token's text as symbols, the last one with the end mark if there is one."""
        body = text.removesuffix(self.suffix) if self.suffix and text != self.suffix else text
        return [*body[:-1], text[len(body) - 1 :]]

    def symbols(self, text: str) -> list[int] | None:
        """The tokens of a text's single symbols, or None if some are unknown."""
        found = [self.vocab.get(x) for x in self.cut(text)]
        return None if None in found else found

    def _step(self, tokens: list[int]) -> tuple[int, int, int] | None:
        """The next merge, by the definition: the earliest in the list, the leftmost of those."""
        best = None
        for i in range(len(tokens) - 1):
            key = tokens[i] << 32 | tokens[i + 1]
            rank = self.rank.get(key)
            if rank is not None and (best is None or rank < best[0]):
                best = (rank, i, self.joined[key])
        return best

    @staticmethod
    def _ends(i: int, side: int, births: dict, parents: dict, never: int) -> list[tuple[int, int, int]]:
        out, until = [], never
        while True:
            out.append((i, births[i], until))
            if i not in parents:
                return out
            until, i = parents[i][2], parents[i][side]

    def side_by_side(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay apart: no merge joins an end of one to an end of the other.

        Merges happen in the order of the list, so an end of ``a`` can be joined
        at a rank only while it exists. Of equal merges the left one is first.
        """
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            known, rank = True, self.rank
            for x, x_from, x_until in self.right_end[a]:
                for y, y_from, y_until in self.left_end[b]:
                    r = rank.get(x << 32 | y)
                    if r is not None and x_from < r < x_until and y_from < r <= y_until:
                        known = False
            if len(self.pairs) >= _MOST_PAIRS:
                self.pairs.clear()
            self.pairs[key] = known
        return known


class Transducer:
    """Symbols in, tokens out as soon as no later symbol can change them.

    Holds the symbols since the last emitted token: of each prefix its last
    token and where that begins, and for each place from which a token may still
    grow, how far it has come in the tree of all tokens.
    """

    def __init__(self, merges: Merges):
        self.m = merges
        self.hold = 4 * merges.lookahead
        self.reset()

    def reset(self) -> None:
        self.tokens, self.starts = [-1], [-1]
        self.growing: list[tuple[int, dict]] = []

    def feed(self, symbols: list[str]) -> list[int]:
        """The tokens that have become stable. The last symbol of a word carries the end mark."""
        out: list[int] = []
        root, pairs, beside = self.m.tree, self.m.pairs, self.m.side_by_side
        tokens, starts, growing = self.tokens, self.starts, self.growing
        for symbol in symbols:
            growing.append((len(tokens) - 1, root))
            still, last, begin = [], -2, -2  # -2: no token ends here, only a longer one's end can follow
            for place in growing:
                node = place[1].get(symbol)
                if node is None:
                    continue
                start = place[0]
                still.append((start, node))
                token = node.get("")
                if token is None or last >= 0:
                    continue
                before = tokens[start]
                if before >= 0:
                    fits = pairs.get(before << 32 | token)
                    if fits is None:
                        fits = beside(before, token)
                    if not fits:
                        continue
                elif before == -2:
                    continue
                last, begin = token, start
            tokens.append(last)
            starts.append(begin)
            growing = still
            if len(tokens) > self.hold:
                self.growing = growing
                out += self._stable()
                tokens, starts, growing = self.tokens, self.starts, self.growing
        self.growing = growing
        return out

    def _ends(self, n: int) -> list[int]:
        """Where the tokens of the prefix of ``n`` symbols end."""
        out = []
        while n > 0:
            out.append(n)
            n = self.starts[n]
        return out[::-1]

    def _stable(self) -> list[int]:
        """Drops and returns the tokens that all prefixes agree on which can still matter."""
        n = len(self.tokens) - 1
        live = [p for p in range(max(0, n - self.m.lookahead + 1), n + 1) if self.tokens[p] >= 0]
        agreed = 0
        for ends in zip(*map(self._ends, live), strict=False):
            if len(set(ends)) > 1:
                break
            agreed = ends[0]
        if not agreed:
            return []
        out = [self.tokens[e] for e in self._ends(agreed)]
        # The last of them stays, as what the next token must stand beside. What
        # began before it has no future.
        gone = [s < agreed for s in self.starts[agreed + 1 :]]
        self.tokens = [out[-1], *(-2 if g else t for g, t in zip(gone, self.tokens[agreed + 1 :], strict=True))]
        self.starts = [-1, *(-2 if g else s - agreed for g, s in zip(gone, self.starts[agreed + 1 :], strict=True))]
        self.growing = [(s - agreed, node) for s, node in self.growing if s >= agreed]
        return out

    def finish(self) -> list[int]:
        out = [self.tokens[e] for e in self._ends(len(self.tokens) - 1)]
        self.reset()
        return out


class Lockstep:
    """The same transducer for many short words at once, a symbol of each in every step.

    A word no longer than the lookahead buffer is stable only at its end, so
    nothing is emitted before; the states of all words are rows of arrays.
    """

    def __init__(self, merges: Merges, shown: list[str]):
        self.m = merges
        symbol = {c: b for b, c in enumerate(shown)} | {c + merges.suffix: 256 + b for b, c in enumerate(shown)}
        edges, tokens, nodes = [], [-1], [(0, merges.tree)]
        for number, node in nodes:  # grows as it is walked
            for text, child in node.items():
                if text == "":
                    tokens[number] = child
                elif text in symbol:
                    edges.append((number << 9 | symbol[text], len(tokens)))
                    nodes.append((len(tokens), child))
                    tokens.append(-1)
        edges.sort()
        self.edge, self.child = (np.array(x, np.int64) for x in zip(*edges, strict=True))
        self.token = np.array(tokens, np.int64)
        self.memo_key = np.full(1 << _MEMO_BITS, -1, np.int64)  # of pairs, by a hash of the pair
        self.memo_fits = np.zeros(1 << _MEMO_BITS, dtype=bool)
        self.root = np.full(512, -1, np.int64)  # the first step of every token
        self.root[self.edge[: np.searchsorted(self.edge, 512)]] = self.child[: np.searchsorted(self.edge, 512)]

    def _fits(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        key = before << 32 | token
        slot = self._slots(key)
        out, missed = self.memo_fits[slot], np.flatnonzero(self.memo_key[slot] != key)
        if len(missed):
            new, place = np.unique(key[missed], return_inverse=True)
            fits = np.array([self.m.side_by_side(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()])
            out[missed] = fits[place]
            at = self._slots(new)
            self.memo_key[at], self.memo_fits[at] = new, fits
        return out

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return (W.mix(keys.astype(np.uint64)) >> np.uint64(64 - _MEMO_BITS)).astype(np.int64)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The little-endian ids of each word; no word is empty."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-length, kind="stable")  # the words that are still running come first
        length = length[order]
        data = np.frombuffer(b"".join([words[i] for i in order.tolist()]), np.uint8).astype(np.int64)
        first = np.cumsum(length) - length
        data[first + length - 1] += 256
        n, steps = len(words), int(length[0]) if len(words) else 0
        tokens = np.full((steps + 1, n), -2, np.int64)
        starts = np.full((steps + 1, n), -2, np.int64)
        tokens[0] = -1
        word, start, node = (np.zeros(0, np.int64) for _ in range(3))
        for at in range(steps):
            running = int(np.searchsorted(-length, -at, side="left"))
            symbol = data[first[:running] + at]
            # Tokens that grow on, in ascending order of where they begin, then those that begin here.
            old = word < running
            word, start, node = word[old], start[old], node[old]
            key = node << 9 | symbol[word]
            slot = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            grows = self.edge[slot] == key
            fresh = np.flatnonzero((self.root[symbol] >= 0) & (tokens[at, :running] > -2))
            word = np.concatenate([word[grows], fresh])
            start = np.concatenate([start[grows], np.full(len(fresh), at)])
            node = np.concatenate([self.child[slot[grows]], self.root[symbol[fresh]]])
            ends = np.flatnonzero(self.token[node] >= 0)
            before, token = tokens[start[ends], word[ends]], self.token[node[ends]]
            fits = before == -1
            later = np.flatnonzero(before >= 0)
            fits[later] = self._fits(before[later], token[later])
            ends, token = ends[fits][::-1], token[fits][::-1]
            # Of several the one that begins first stays: it is written last.
            tokens[at + 1, word[ends]] = token
            starts[at + 1, word[ends]] = start[ends]
        ids, owner, ahead = [], [], length.copy()
        live = np.arange(n)
        while len(live):
            ids.append(tokens[ahead[live], live])
            owner.append(live)
            ahead[live] = starts[ahead[live], live]
            live = live[ahead[live] > 0]
        if not ids:
            return []
        ids, owner = np.concatenate(ids)[::-1], np.concatenate(owner)[::-1]
        by_word = np.argsort(owner, kind="stable")
        stop = 4 * np.cumsum(np.bincount(owner, minlength=n))
        raw = ids[by_word].astype("<u4").tobytes()
        out = [b""] * n
        begin = 0
        for i, end in zip(order.tolist(), stop.tolist(), strict=True):
            out[i] = raw[begin:end]
            begin = end
        return out


class TextDecoder:
    """Bytes in, text out: holds back a started character until it is complete or broken."""

    def __init__(self):
        self.pending = b""

    def push(self, data: bytes) -> str:
        data, keep = self.pending + data, 0
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead >= 0xC0:
                need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                keep = back if need > back else 0
                break
            if lead < 0x80:
                break
        self.pending = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        out, self.pending = self.pending.decode("utf-8", "replace"), b""
        return out


class WordBpe:
    """A tokenizer file of words with end marks: normalise, cut into words, encode each, decode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.vocab = model["vocab"]
        self.m = Merges(self.vocab, merges, self.suffix)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in {**self.vocab, **self.added}.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \s there is Unicode white space.
        self.word = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.special = regex.compile("|".join(map(regex.escape, self.added)) or r"(?!)")
        self.shown = byte_alphabet()
        self.machine = Transducer(self.m)
        self.lockstep = Lockstep(self.m, self.shown)
        self._reset()

    def _reset(self) -> None:
        # Of each known word its ids, little-endian; added tokens are known by their id.
        self.known: dict[str | int, bytes] = {i: i.to_bytes(4, "little") for i in self.added.values()}

    def word_ids(self, word: str) -> Iterator[int]:
        data, machine = word.encode(), self.machine
        for at in range(0, len(data) - 1, 4096):
            yield from machine.feed([self.shown[b] for b in data[at : min(at + 4096, len(data) - 1)]])
        yield from machine.feed([self.shown[data[-1]] + self.suffix])
        yield from machine.finish()

    def words(self, text: str) -> list[str | int]:
        """The words of the normalised text, and the ids of added tokens between them."""
        out, at = [], 0
        for found in self.special.finditer(text):
            out += self._plain(text[at : found.start()])
            out.append(self.added[found[0]])
            at = found.end()
        return out + self._plain(text[at:]) if out else self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        # Letters are lowered one by one, so a final sigma stays an ordinary one.
        return self.word.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode(self, text: str) -> bytes:
        """The ids, little-endian 32-bit."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; words that are new to this process are encoded together."""
        if len(self.known) >= _MOST_WORDS:
            self._reset()
        known = self.known
        cut = [self.words(t) for t in texts]
        short, long = [], []
        for word in set().union(*cut).difference(known):
            (short if len(word.encode()) <= _LOCKSTEP_BYTES else long).append(word)
        for at in range(0, len(short), 1 << 14):
            part = short[at : at + (1 << 14)]
            known.update(zip(part, self.lockstep.encode([w.encode() for w in part]), strict=True))
        for word in long:
            known[word] = np.fromiter(self.word_ids(word), "<u4").tobytes()
        out = [b"".join(map(known.__getitem__, words)) for words in cut]
        for word in long:
            del known[word]
        return out

    def decode(self, ids: bytes) -> str:
        """As a tokenizer without a decoder does it: the tokens' own strings with blanks between."""
        token = self.token
        return " ".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def decode_text(self, ids: Iterable[int]) -> Iterator[str]:
        """The words as text, piece by piece, a blank after each word."""
        machine, byte_of = TextDecoder(), {c: b for b, c in enumerate(byte_alphabet())}
        for i in ids:
            token = self.token[i]
            if token in self.added:
                yield machine.finish() + token
                continue
            ends = bool(self.suffix) and token.endswith(self.suffix) and token != self.suffix
            body = token.removesuffix(self.suffix) if ends else token
            yield machine.push(bytes(byte_of[c] for c in body)) + (machine.finish() + " " if ends else "")
        yield machine.finish()


def encode_decode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = WORD_BPE, keep: bool = False
) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)``, a row per input row.

    ``keep`` adds the ids and the decoded text. A null text is an empty one,
    with no tokens; a null id stays null. There is no shuffle, and a task holds
    one text and a bounded table of the words it has met.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        for part in W.slices(batches, 1):
            ids = coder.encode_all([t or "" for t in part.column(1).to_pylist()])
            decoded = [coder.decode(x) for x in ids]
            columns = [
                part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
            ]
            if keep:
                columns.append(pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())))
                columns.append(pa.array(decoded, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if keep:
        names += ["ids", "decoded"]
        schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")
    return W.bounded(docs).select(id_col, text_col).mapInArrow(run, schema)
