"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding.

A model of this type merges, time and again, the adjacent pair whose joined
text is the piece of highest score, leftmost first.  The same ids come from a
walk over the text without merging it: a sequence of pieces is the result of
the merges exactly when each piece and its successor stay as they are when
the two alone are merged again.  So the walk takes the longest piece that
begins at its position (one Aho-Corasick pass finds them for all positions),
checks it against the piece before (by re-merging the two, remembered by
pair), falls back to shorter pieces, and steps back where none fits; a
bitfield of failed positions keeps it from trying one twice.

Pieces never reach over the start of a run of space marks, nor over a
character that no piece has, so a text is cut there and every distinct chunk
of a worker is walked once.  Both facts are taken from the model's pieces; a
model with other pieces is cut less or not at all.

Characters without a piece become their bytes' ids.  Edge cases: null and
empty texts have no ids and decode to an empty text; texts without blanks are
one chunk, walked in linear time; strings of control pieces (``<s>``) are text
like any other; equal rows are encoded alike; a space mark U+2581 in a text is
a space, as in the library; other columns pass through (an equal name
``name`` is the caller's to avoid).
"""

from __future__ import annotations

import codecs

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, slices, spans, table, utf8
from .pieces import EDGE_BYTE, PieceEncoder

MARK = "▁"  # fixed by the format: stands for a space
MARK_BYTES = MARK.encode()
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed piece types of the format
BPE = 2  # fixed model type of the format
KEPT_IDS, KEPT_PAIRS = 1 << 23, 1 << 20  # what a worker remembers; forgetting costs time only


class Model:
    """Pieces of a model file and the walk over a text."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        plain = not norm.precompiled_charsmap and not norm.remove_extra_whitespaces and norm.escape_whitespaces and norm.add_dummy_prefix
        if model.trainer_spec.model_type != BPE or not plain or not model.trainer_spec.byte_fallback or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models of merge type with byte fallback, a leading space and no normalisation")
        if odd := {p.type for p in model.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"pieces of types {sorted(odd)}")
        self.text = [p.piece for p in model.pieces]
        self.type = [p.type for p in model.pieces]
        self.unknown_surface = model.trainer_spec.unk_surface
        self.cost = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        # Only pieces that the merges can reach from their own characters ever come out.
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL and len(self.merged(p.piece)) == 1}
        self.chars = {c for c in self.id if len(c) == 1}
        self.length = [len(t) for t in self.text]
        self.shorter = [-1] * len(self.text)  # the longest piece that begins a piece
        self.find = ahocorasick.Automaton()
        for piece, i in self.id.items():
            self.shorter[i] = next((self.id[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.id), -1)
            self.find.add_word(piece, i)
        self.find.make_automaton()
        self.pairs: dict[int, bool] = {}
        used = {c for piece in self.cost for c in piece}
        self.breaks = bytes(b for b in range(128) if chr(b) not in used)  # ASCII characters that no piece has
        self.cuts_at_marks = all(MARK not in piece.lstrip(MARK) for piece in self.cost)

    def merged(self, text: str, border: int = 0) -> list[str]:
        """Characters of ``text`` merged, best pair first; nothing, as soon as
        a merge would reach over ``border``."""
        parts, cost = list(text), self.cost
        while len(parts) > 1:
            costs = [cost.get(a + b) for a, b in zip(parts, parts[1:])]
            best = min((c for c in costs if c is not None), default=None)
            if best is None:
                break
            k = costs.index(best)
            if border and sum(map(len, parts[: k + 1])) == border:
                return []
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Do two pieces stay as they are side by side?"""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs.clear()
            left = self.text[a]
            known = self.pairs[key] = bool(self.merged(left + self.text[b], len(left)))
        return known

    def walk(self, text: str) -> list[int]:
        """Ids of a text whose characters all have pieces."""
        whole = self.id.get(text)
        if whole is not None:
            return [whole]
        size, length, shorter, compatible = len(text), self.length, self.shorter, self.compatible
        longest = [-1] * size
        for end, i in self.find.iter(text):
            at = end + 1 - length[i]
            if longest[at] < 0 or length[longest[at]] < length[i]:
                longest[at] = i
        failed = bytearray(size // 8 + 1)
        out: list[int] = []
        pos, token = 0, longest[0]
        while pos < size:
            last = out[-1] if out else -1
            end = pos + length[token]
            if not failed[end >> 3] >> (end & 7) & 1 and (last < 0 or compatible(last, token)):
                out.append(token)
                pos = end
                token = longest[pos] if pos < size else -1
            elif shorter[token] >= 0:
                token = shorter[token]
            else:  # nothing fits here behind the last piece: a shorter one there
                failed[pos >> 3] |= 1 << (pos & 7)
                token = out.pop()
                pos -= length[token]
        return out

    def encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, counts) of chunks in which spaces are marks."""
        flat: list[int] = []
        counts = np.empty(len(chunks), np.int64)
        for k, raw in enumerate(chunks):
            before, text = len(flat), raw.decode()
            if self.chars.issuperset(text):
                flat += self.walk(text)
            else:
                at = 0
                for i, c in enumerate(text):
                    if c not in self.chars:
                        flat += self.walk(text[at:i]) if at < i else []
                        flat += [self.byte[b] for b in c.encode()]
                        at = i + 1
                flat += self.walk(text[at:]) if at < len(text) else []
            counts[k] = len(flat) - before
        return np.array(flat, np.uint32), counts


class ChunkEncoder(PieceEncoder):
    """Cuts texts at space marks and breaks instead of by a pattern."""

    def __init__(self, model: Model):
        super().__init__(model.encode)
        self.model = model

    def _learn(self, buf, a, b, keys) -> np.ndarray:
        if self.used > KEPT_IDS:
            self.forget()
        return super()._learn(buf, a, b, keys)

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Yields (first row, flat ids, id offsets) for consecutive row ranges."""
        edge = bytes([EDGE_BYTE])
        is_break = np.zeros(256, bool)
        is_break[list(self.model.breaks)] = True
        for r0, r1 in slices(offsets, self.step):
            raw = data[offsets[r0] : offsets[r1]].tobytes()
            at = (offsets[r0 : r1 + 1] - offsets[r0]).tolist()
            texts = [MARK_BYTES + raw[a:b].replace(b" ", MARK_BYTES) if a < b else b"" for a, b in zip(at, at[1:])]
            buf = np.frombuffer(edge + edge.join(texts) + edge, np.uint8)
            starts = 1 + np.cumsum([0] + [len(t) + 1 for t in texts])
            cut = buf == EDGE_BYTE
            cut[1:] |= cut[:-1]
            if self.model.cuts_at_marks:
                mark = np.zeros(len(buf) + 3, bool)
                mark[3:-2] = (buf[:-2] == MARK_BYTES[0]) & (buf[1:-1] == MARK_BYTES[1]) & (buf[2:] == MARK_BYTES[2])
                cut |= mark[3:] & ~mark[:-3]
            stop = is_break[buf]
            cut |= stop
            cut[1:] |= stop[:-1]
            where = np.flatnonzero(cut)
            a, b = where[:-1], where[1:]
            real = buf[a] != EDGE_BYTE
            a, b = a[real], b[real]
            if len(a):
                keys, one, back = np.unique(self._keys(buf, a, b), return_index=True, return_inverse=True)
                idx = self._learn(buf, a[one], b[one], keys)[back]
                counts = self.size[idx]
                run = np.concatenate([[0], np.cumsum(counts)])
                yield r0, self.flat[spans(self.at[idx], counts)], run[np.searchsorted(a, starts)]
            else:
                yield r0, np.zeros(0, np.uint32), np.zeros(r1 - r0 + 1, np.int64)
        release()


def _byte_by_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


class Decoder:
    """Texts of id sequences, as the library decodes them."""

    def __init__(self, model: Model):
        surfaces = []
        for text, kind in zip(model.text, model.type):
            if kind == BYTE:
                surfaces.append(bytes([int(text[3:5], 16)]))
            else:
                surfaces.append({CONTROL: "", UNKNOWN: model.unknown_surface}.get(kind, text.replace(MARK, " ")).encode())
        self.leads = np.array([kind == NORMAL and text.startswith(MARK) for text, kind in zip(model.text, model.type)])
        self.silent = np.array([not s for s in surfaces])
        self.size = np.array([len(s) for s in surfaces], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(surfaces), np.uint8)
        codecs.register_error("byte_by_byte", _byte_by_byte)

    def _run(self, ids: np.ndarray) -> bytes:
        raw = self.raw[spans(self.at[ids], self.size[ids])].tobytes()
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:  # only runs of byte pieces can be broken
            return raw.decode(errors="byte_by_byte").encode()

    def decode(self, ids: np.ndarray) -> bytes:
        silent = np.flatnonzero(self.silent[ids])
        raw = b"".join(map(self._run, np.split(ids, silent))) if len(silent) else self._run(ids)
        heard = np.flatnonzero(~self.silent[ids])
        # A space stands before every text.
        return raw[1:] if len(heard) and self.leads[ids[heard[0]]] else raw


def _model(path: str) -> tuple[ChunkEncoder, Decoder]:
    """The model of this worker process, kept over its tasks."""
    import sys
    import types

    store = sys.modules.setdefault("_joblens_llm_pieces", types.ModuleType("_joblens_llm_pieces"))
    if not hasattr(store, "models"):
        store.models = {}
    if path not in store.models:
        model = Model(path)
        store.models[path] = ChunkEncoder(model), Decoder(model)
    return store.models[path]


def encode(docs: DataFrame, model_path: str, name: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole ``text``, without begin or end ids."""

    @F.arrow_udf("array<int>")
    def ids_of(texts):
        enc, _ = _model(model_path)
        flats, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for _, flat, offs in enc.encode(*utf8(texts)):
            flats.append(flat)
            sizes.append(np.diff(offs))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flats).astype(np.int32)))

    return docs.withColumn(name, ids_of(F.col("text")))


def decoded(ids: Column, model_path: str) -> Column:
    """Text, as UTF-8 bytes, of an array of ids (null: empty)."""

    @F.arrow_udf("binary")
    def text_of(ids):
        _, dec = _model(model_path)
        offsets = np.asarray(ids.offsets)
        flat = np.asarray(ids.values).astype(np.int64)
        return pa.array([dec.decode(flat[a:b]) for a, b in zip(offsets, offsets[1:])], pa.binary())

    return text_of(ids)


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = encode(table(spark, sf_dir, "documents", "doc_id", "text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decoded(F.col("ids"), path), 256).alias("decoded_sha256"),
    )
