"""SentencePiece encoding by streaming Viterbi, and decoding.

The best segmentation of a text into pieces is searched from left to right.
Scores are kept for the next ``longest`` positions only, and as soon as all
surviving backpointer paths pass one boundary, the pieces before it are
committed and forgotten.  A space put before the text stands for the word mark,
characters without a piece become byte pieces, so decoding gives back every text exactly.

Where two neighbouring characters occur together in no piece, every path has a
boundary.  Texts are cut there, and a worker encodes each distinct part once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.llm.textblocks import Block, Ragged, SpanNumbers, blocks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Distinct parts with known ids kept by a worker.
CACHE_PARTS = 1_000_000
# Log probability of a character without a piece, below that of the rarest piece.
UNKNOWN = 10.0
# Scores are whole numbers of this fraction, so sums are exact and ties are ties.
UNITS = 1 << 24


class PieceModel:
    """Pieces with log probabilities.

    A unigram model's scores are log probabilities.  A BPE model's are merge
    ranks; they are read as frequency ranks under Zipf's law, ``-log(rank + 2)``.
    """

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int], zipf: bool):
        """``pieces``: (text with spaces for word marks, score) by id, "" for ids that are no text; ``byte_ids``: id of each byte."""
        self.ids = {p: i for i, (p, _) in enumerate(pieces) if p}
        scale = (lambda s: -math.log(2 - s)) if zipf else (lambda s: s)
        self.scores = {p: round(scale(s) * UNITS) for p, s in pieces if p}
        self.longest = max(map(len, self.ids), default=1)
        self.prefixes = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        # The pieces by their characters: (longer pieces, score and id of the piece that ends here).
        self.tree: dict = {}
        for p in self.ids:
            branch, node = self.tree, []
            for c in p:
                node = branch.setdefault(c, [{}, None])
                branch = node[0]
            node[1] = (self.scores[p], self.ids[p])
        self.unknown = min(self.scores.values(), default=0) - round(UNKNOWN * UNITS)
        self.byte_ids = byte_ids
        self.bytes_of = [p.encode() for p, _ in pieces]
        for b, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([b])
        self.is_byte = np.zeros(len(pieces), bool)
        self.is_byte[byte_ids] = True
        # joins[a, b]: bytes a and b may stand in one piece; always so outside ASCII.
        self.joins = np.ones((256, 256), bool)
        self.joins[:128, :128] = False
        for p in self.ids:
            for a, b in zip(p, p[1:]):
                if a < "\x80" and b < "\x80":
                    self.joins[ord(a), ord(b)] = True

    @classmethod
    def load(cls, path: str = MODEL) -> PieceModel:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        model = SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
        pieces, byte_ids = [], [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
            plain = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            pieces.append((piece.replace("▁", " ") if plain else "", model.get_score(i)))
        return cls(pieces, byte_ids, proto.trainer_spec.model_type == proto.trainer_spec.BPE)

    def stream(self, chars: Iterator[str]) -> Iterator[list[int]]:
        """Ids of a text given in parts, committed as soon as they are certain.

        Of equal paths, the one whose last piece begins first wins.
        """
        buffer, base, done = "", 0, False
        best, back, at, checked = {0: 0}, {}, 0, 0
        while True:
            while not done and len(buffer) - at < self.longest:
                part = next(chars, None)
                done = part is None
                buffer += part or ""
            if at >= len(buffer):
                break
            here = best.pop(at)
            single = False
            for size in range(1, min(self.longest, len(buffer) - at) + 1):
                piece = buffer[at:at + size]
                if piece in self.scores:
                    single = single or size == 1
                    total = here + self.scores[piece]
                    if at + size not in best or total > best[at + size]:
                        best[at + size], back[at + size] = total, at
                if piece not in self.prefixes:
                    break
            if not single:
                total = here + self.unknown
                if at + 1 not in best or total > best[at + 1]:
                    best[at + 1], back[at + 1] = total, at
            at += 1
            while at not in best and at < len(buffer):
                at += 1
            # One open boundary is the plain case; more are traced back now and then.
            if len(best) > 1 and at - checked < self.longest:
                continue
            checked = at
            common = self._meeting(best, back)
            if common:
                yield self._walk(buffer, back, common)
                # Everything before the boundary is forgotten.
                buffer, at, checked = buffer[common:], at - common, at - common
                best = {k - common: v for k, v in best.items()}
                back = {k - common: v - common for k, v in back.items() if v >= common}
        if buffer:
            yield self._walk(buffer, back, len(buffer))

    @staticmethod
    def _meeting(best: dict[int, int], back: dict[int, int]) -> int:
        """The last boundary on all surviving paths."""
        live = set(best)
        while len(live) > 1:
            last = max(live)
            live.discard(last)
            live.add(back[last])
        return live.pop()

    def _walk(self, text: str, back: dict[int, int], end: int) -> list[int]:
        cuts = [end]
        while cuts[-1]:
            cuts.append(back[cuts[-1]])
        ids: list[int] = []
        for start, stop in zip(cuts[:0:-1], cuts[-2::-1]):
            piece = text[start:stop]
            known = self.ids.get(piece)
            ids += [known] if known is not None else [self.byte_ids[b] for b in piece.encode()]
        return ids

    def _in_one_window(self, part: str) -> list[int]:
        """Ids of a text as short as the window: nothing is committed before its end."""
        n = len(part)
        best, back, ids_to = [0] + [None] * n, [0] * (n + 1), [-1] * (n + 1)
        for i in range(n):
            here, branch = best[i], self.tree
            if here is None:
                continue
            single = False
            for j in range(i, n):
                node = branch.get(part[j])
                if node is None:
                    break
                branch, end = node
                if end is not None:
                    single = single or j == i
                    total = here + end[0]
                    if best[j + 1] is None or total > best[j + 1]:
                        best[j + 1], back[j + 1], ids_to[j + 1] = total, i, end[1]
            if not single:
                total = here + self.unknown
                if best[i + 1] is None or total > best[i + 1]:
                    best[i + 1], back[i + 1], ids_to[i + 1] = total, i, -1
        out: list[int] = []
        while n:
            start = back[n]
            if ids_to[n] >= 0:
                out.append(ids_to[n])
            else:
                out += [self.byte_ids[b] for b in reversed(part[start:n].encode())]
            n = start
        return out[::-1]

    def encode_part(self, part: str, step: int = 4096) -> list[int]:
        """Ids of a text, without a space before it."""
        if len(part) <= 2 * self.longest:
            return self._in_one_window(part)
        return [i for ids in self.stream(part[k:k + step] for k in range(0, len(part), step)) for i in ids]


_workers: dict[str, _Encoder] = {}


class _Encoder:
    """A model and the parts a worker has encoded."""

    def __init__(self, path: str):
        self.model = PieceModel.load(path)
        self.seen, self.ids = SpanNumbers(CACHE_PARTS), Ragged()
        lengths = np.array([len(b) for b in self.model.bytes_of])
        self.first = np.append(0, np.cumsum(lengths))
        self.bytes = np.frombuffer(b"".join(self.model.bytes_of), np.uint8)

    @classmethod
    def of(cls, path: str) -> _Encoder:
        """The worker's own: it serves one task after the other."""
        if path not in _workers:
            _workers[path] = cls(path)
        return _workers[path]

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of each text and the ids of all texts on end."""
        sizes = np.diff(block.offsets)
        some = sizes > 0
        data = np.insert(block.data, block.offsets[:-1][some], 32)
        offsets = np.append(0, np.cumsum(sizes + some))
        spaced = Block(0, data, offsets)
        cut = np.ones(len(data), bool)
        if len(data):
            cut[1:] = ~self.model.joins[data[:-1], data[1:]]
            cut[offsets[:-1][some]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        if self.seen.full:
            self.seen.forget()
            self.ids = Ragged()
        numbers, new = self.seen.number(spaced.span_hash(starts, ends))
        if len(new):
            raw = data.tobytes()
            self.ids.extend([self.model.encode_part(raw[s:e].decode())
                             for s, e in zip(starts[new].tolist(), ends[new].tolist())])
        per_part, ids = self.ids.take(numbers)
        text = np.searchsorted(offsets, starts, "right") - 1
        counts = np.bincount(text, weights=per_part, minlength=block.n_texts).astype(np.int64)
        return counts, ids

    def decode(self, counts: np.ndarray, ids: np.ndarray) -> pa.Array:
        """Texts of lists of ids on end; the space put before each is taken away."""
        sizes = self.first[ids + 1] - self.first[ids]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.first[ids] - ends + sizes, sizes)
        data = self.bytes[at]
        offsets = np.append(0, ends)[np.append(0, np.cumsum(counts))]
        lead = offsets[:-1][counts > 0]
        lead = lead[data[lead] == 32]
        kept = np.ones(len(data), bool)
        kept[lead] = False
        offsets = offsets - np.searchsorted(lead, offsets)
        return pa.Array.from_buffers(pa.large_string(), len(counts),
                                     [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[kept].tobytes())])


def encode(docs: DataFrame, carry: list[str], model: str = MODEL) -> DataFrame:
    """Columns ``carry`` of ``docs`` in a struct ``row``, with ``ids``, ``n_pieces``
    and ``n_byte_pieces`` of ``text``; no shuffle.

    A NULL text has NULL ids and no pieces, an empty one an empty list.  Every
    row is encoded by itself, so equal rows get equal ids; an empty table gives no row.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_pieces", T.LongType()), T.StructField("n_byte_pieces", T.LongType())])

    def run(batches):
        encoder = _Encoder.of(model)
        for batch in batches:
            for block in blocks(batch.column("text")):
                part = batch.slice(block.first_row, block.n_texts)
                counts, ids = encoder.encode(block)
                offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
                is_null = np.append(part.column("text").is_null().to_numpy(zero_copy_only=False), False)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=is_null), pa.array(ids, pa.int32()))
                text = np.repeat(np.arange(block.n_texts), counts)
                byte_pieces = np.bincount(text[encoder.model.is_byte[ids]], minlength=block.n_texts)
                yield pa.RecordBatch.from_arrays([part.column("row"), lists, pa.array(counts), pa.array(byte_pieces, pa.int64())],
                                                 ["row", "ids", "n_pieces", "n_byte_pieces"])

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, carry: list[str], model: str = MODEL) -> DataFrame:
    """Columns ``carry`` of ``encoded`` in a struct ``row``, with the ``text`` of its ``ids``; no shuffle.

    NULL ids give a NULL text.  Bytes that are no UTF-8 text come from no text
    and are an error.
    """
    rows = encoded.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), "ids")
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])

    def run(batches):
        encoder = _Encoder.of(model)
        for batch in batches:
            lists = batch.column("ids")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            # Some rows at a time: texts are longer than their ids.
            group = np.cumsum(counts) // (1 << 20)
            for k in np.split(np.arange(len(counts)), np.flatnonzero(np.diff(group)) + 1):
                part = batch.slice(int(k[0]), len(k))
                ids = part.column("ids").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = encoder.decode(counts[k], ids).cast(pa.string())
                texts.validate(full=True)
                null = pa.scalar(None, pa.string())
                texts = pa.compute.if_else(part.column("ids").is_null(), null, texts)
                yield pa.RecordBatch.from_arrays([part.column("row"), texts], ["row", "text"])

    return rows.mapInArrow(run, schema)
