"""Byte-level BPE pre-tokenisation over whole Arrow batches, without strings.

``split_pieces`` finds the matches of the public pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

from the classes of neighbouring characters.  ``PieceEncoder`` gives every
distinct piece of a task to an encoder once and spreads the ids back.
Texts are first cut at the added tokens of a tokenizer file, where asked for:
each yields its own id, and the text between is pieced as one of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

import numpy as np

from .common import release, slices, spans

# Character classes.
SPACE, BLANK, LETTER, NUMBER, OTHER, EDGE = range(6)  # BLANK is U+0020
EDGE_BYTE = 0xFF  # never part of UTF-8
SINGLE_TAILS, DOUBLE_TAILS = b"stmd", (b"re", b"ve", b"ll")  # fixed values of the pattern


def class_table() -> np.ndarray:
    """Class of every code point."""
    import regex

    table = np.full(0x110000, OTHER, np.uint8)
    chars = np.r_[0:0xD800, 0xE000:0x110000].astype("<u4").tobytes().decode("utf-32-le")
    at = lambda i: i if i < 0xD800 else i + 0x800
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, chars):
            table[at(m.start()) : at(m.end() - 1) + 1] = kind
    table[0x1C:0x20] = OTHER  # Python's \s has these four, White_Space has not
    table[0x20] = BLANK
    return table


def code_points(buf: np.ndarray, lead_at: np.ndarray) -> np.ndarray:
    """Code points of the multi-byte characters that begin at ``lead_at``."""
    b0 = buf[lead_at].astype(np.int32)
    at = lambda k: buf[np.minimum(lead_at + k, len(buf) - 1)].astype(np.int32) & 0x3F
    two = (b0 & 0x1F) << 6 | at(1)
    three = (b0 & 0x0F) << 12 | at(1) << 6 | at(2)
    four = (b0 & 0x07) << 18 | at(1) << 12 | at(2) << 6 | at(3)
    return np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, np.minimum(four, 0x10FFFF)))


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with an edge byte before each and after the last; starts of the texts."""
    n = len(offsets) - 1
    buf = np.full(len(data) + n + 1, EDGE_BYTE, np.uint8)
    starts = offsets[:-1] + np.arange(1, n + 1)
    for i in range(n):
        a, b = offsets[i], offsets[i + 1]
        buf[starts[i] : starts[i] + b - a] = data[a:b]
    return buf, starts


def split_pieces(buf: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte positions in a padded buffer at which a piece or an edge begins."""
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    first = buf[lead]
    low = classes[:256].copy()
    low[EDGE_BYTE] = EDGE
    c = low[first]
    many = np.flatnonzero((first >= 0xC0) & (first != EDGE_BYTE))
    if len(many):
        c[many] = classes[code_points(buf, lead[many])]
    start = np.empty(len(c), bool)
    start[0] = True
    prev, cur = c[:-1], c[1:]
    after = np.append(cur[1:], EDGE)
    ws, prev_ws = cur <= BLANK, prev <= BLANK
    start[1:] = np.where(
        ws,
        ~prev_ws | ((after > BLANK) & (after != EDGE)),
        (prev != cur) & (prev != BLANK),
    ) | (cur == EDGE) | (prev == EDGE)
    # Contractions: an apostrophe that begins a piece, then s, t, m, d, re, ve or ll.
    quote = np.flatnonzero((first == 0x27) & start)
    if len(quote):
        pad = np.append(first, [EDGE_BYTE] * 3)
        one, two = pad[quote + 1], pad[quote + 2]
        size = np.where(np.isin(one, np.frombuffer(SINGLE_TAILS, np.uint8)), 2, 0)
        for a, b in DOUBLE_TAILS:
            size = np.where((one == a) & (two == b), 3, size)
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        start[np.where(size == 3, quote + 2, quote + 1)] = False
        start[quote + size] = True
    return lead[start]


class PieceEncoder:
    """Ids of texts from an encoder of distinct pieces.

    ``encode_words`` maps a list of pieces (bytes) to (flat ids, counts).
    Known pieces are kept up to ``keep`` entries per task and forgotten
    together beyond that, which costs time only.  Pieces are told apart by a
    64-bit polynomial hash with random byte weights; longer ones by blake2b.
    ``added`` maps strings (bytes) that are no pieces to their ids.
    """

    LONG = 200

    def __init__(self, encode_words: Callable, keep: int = 1_000_000, step: int = 1 << 20, added: dict[bytes, int] | None = None):
        self.encode_words, self.keep, self.step = encode_words, keep, step
        self.classes = class_table()
        # Longest first: of the strings that begin at a place the library takes the longest.
        self.added = added or {}
        self.find = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))).finditer if self.added else None
        rng = np.random.default_rng(20240607)
        self.weight = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 60, 1 << 61)) * 2 + 1
        self.power = self.unpower = np.ones(1, np.uint64)
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted keys
        self.known_at = np.zeros(0, np.int64)  # their store index
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, self.step + self.step // 4)

            def grow(x: int) -> np.ndarray:
                out = np.full(n, x, np.uint64)
                out[0] = 1
                return np.cumprod(out, dtype=np.uint64)

            self.power, self.unpower = grow(self.base), grow(pow(self.base, -1, 1 << 64))

    def _keys(self, buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        self._powers(len(buf) + 1)
        run = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.weight[buf] * self.power[: len(buf)], out=run[1:])
        keys = (run[b] - run[a]) * self.unpower[a]
        for i in np.flatnonzero(b - a > self.LONG):
            keys[i] = int.from_bytes(hashlib.blake2b(buf[a[i] : b[i]].tobytes(), digest_size=8).digest(), "little")
        return keys

    def _learn(self, buf, a, b, keys) -> np.ndarray:
        """Store index of each distinct piece; ``keys`` are sorted."""
        if len(self.known) > self.keep:
            self.forget()
        pos = np.searchsorted(self.known, keys)
        if len(self.known):
            near = np.minimum(pos, len(self.known) - 1)
            idx = np.where(self.known[near] == keys, self.known_at[near], -1)
        else:
            idx = np.full(len(keys), -1, np.int64)
        new = np.flatnonzero(idx < 0)
        if len(new):
            raw = buf.tobytes()
            flat, counts = self.encode_words([raw[x:y] for x, y in zip(a[new].tolist(), b[new].tolist())])
            idx[new] = np.arange(len(self.at), len(self.at) + len(new))
            self.at = np.concatenate([self.at, self.used + np.cumsum(counts) - counts])
            self.size = np.concatenate([self.size, counts])
            if self.used + len(flat) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(max(len(flat), len(self.flat)), np.uint32)])
            self.flat[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
            self.known = np.insert(self.known, pos[new], keys[new])
            self.known_at = np.insert(self.known_at, pos[new], idx[new])
        return idx

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Yields (first row, flat ids, id offsets) for consecutive row ranges."""
        for r0, r1 in slices(offsets, self.step):
            part = data[offsets[r0] : offsets[r1]]
            buf, starts = padded(part, offsets[r0 : r1 + 1] - offsets[r0])
            ends = np.append(starts, len(buf))
            tokens = [(m.start(), m.end(), self.added[m[0]]) for m in self.find(buf.tobytes())] if self.find else []
            for x, y, _ in tokens:
                buf[x:y] = EDGE_BYTE
            cut = split_pieces(buf, self.classes)
            a, b = cut[:-1], cut[1:]
            real = buf[a] != EDGE_BYTE
            a, b = a[real], b[real]
            if len(a):
                keys, one, back = np.unique(self._keys(buf, a, b), return_index=True, return_inverse=True)
                idx = self._learn(buf, a[one], b[one], keys)[back]
                counts = self.size[idx]
                ids = self.flat[spans(self.at[idx], counts)]
                run = np.concatenate([[0], np.cumsum(counts)])
                offs = run[np.searchsorted(a, ends)]
            else:
                ids, run, offs = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(r1 - r0 + 1, np.int64)
            if tokens:
                at, _, own = np.array(tokens, np.int64).T
                ids = np.insert(ids, run[np.searchsorted(a, at)], own.astype(np.uint32))
                offs = offs + np.searchsorted(at, ends)
            yield r0, ids, offs
        release()


def byte_letters() -> dict[int, int]:
    """Public byte-level alphabet: printable Latin-1 stands for itself, the
    other bytes, in order, for U+0100 and up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: b if b in plain else 256 + rest.index(b) for b in range(256)}


def library_words(path: str) -> Callable:
    """Word encoder of a byte-level file of the tokenizers library: its model
    tokenizes each piece, written in the byte-level alphabet."""
    from tokenizers import Tokenizer

    model, letters = Tokenizer.from_file(path).model, byte_letters()

    def encode(words: list[bytes]):
        found = [[t.id for t in model.tokenize(w.decode("latin-1").translate(letters))] for w in words]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(counts.sum())), counts

    return encode


def added_tokens(path: str) -> dict[bytes, int]:
    """Strings that the tokenizers library takes out of a text before all else
    (also without ``add_special_tokens``), and their ids."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    found = file.get("added_tokens") or []
    if odd := [t["content"] for t in found if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] and file.get("normalizer")]:
        raise ValueError(f"added tokens with rules of their own: {odd}")
    return {t["content"].encode(): t["id"] for t in found}


def worker_encoder(kind: str, path: str, make: Callable, added: bool = False) -> PieceEncoder:
    """The encoder of this worker process, kept over its tasks; ``added`` cuts
    texts at the file's added tokens."""
    import sys
    import types

    store = sys.modules.setdefault("_joblens_llm_worker", types.ModuleType("_joblens_llm_worker"))
    if not hasattr(store, "encoders"):
        store.encoders = {}
    key = (kind, path, added)
    if key not in store.encoders:
        store.encoders[key] = PieceEncoder(make(path), added=added_tokens(path) if added else None)
    return store.encoders[key]
