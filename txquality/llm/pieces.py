"""SentencePiece encoding and decoding by streaming Viterbi over a given vocabulary.

A text's best segmentation is found left to right. Only the last ``longest
piece`` positions can still be starts of pieces, so only they are kept. Ids are
committed as soon as all surviving backpointer paths pass through one boundary:

* where no piece of the vocabulary spans two neighbouring characters, every
  path has a boundary between them. Texts are cut there first, and each
  distinct part of a batch is segmented once, many parts side by side;
* within a part that is long, the window is streamed and paths are followed
  back until they meet.

Scores are integers, so ties are exact and do not hang on where a part starts;
of equal paths the one with the longest last piece wins. Scores are the
vocabulary's log probabilities; a vocabulary that only ranks its pieces
(merge order) gets Zipf's log probability of the rank. A character without a
piece of its own becomes its UTF-8 bytes.

Decoding is exact: a space is written as U+2581 before segmentation, with one
more before the text, and a U+2581 of the text itself as bytes.

Defined cases: a NULL text has NULL ids; an empty one has none; texts of any
length and script round-trip; rows that repeat are encoded alike; other columns
pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pac
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from txquality.llm import textkit as tk
from txquality.llm.names import refuse_taken

SPACE = 0x2581
_OWN_SPACE = 0x110000  # stands for a U+2581 of the text, beyond all code points
SCALE = 1_000_000
BYTE_PENALTY = 10.0
# parts up to so many characters are segmented side by side, longer ones are streamed
SIDE_BY_SIDE = 40
# ids that are decoded at once
PIECE_IDS = 1_000_000
_NO = np.int64(-(1 << 60))


@dataclass
class Vocabulary:
    """Pieces with integer scores, and the ids of the 256 bytes."""

    pieces: list[str]  # "" for control, unknown and byte pieces
    scores: np.ndarray
    bytes_at: np.ndarray
    _ready: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"pieces": self.pieces, "scores": self.scores, "bytes_at": self.bytes_at, "_ready": {}}


def load(path: str) -> Vocabulary:
    """A SentencePiece model file's pieces, read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    usual = np.array([not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)])
    scores = np.array([model.get_score(i) for i in range(n)])
    own = scores[usual]
    ranked = bool(len(own)) and own.max() == 0 and np.array_equal(own, np.round(own)) and len(np.unique(own)) == len(own)
    logs = -np.log(2.7 - scores) - np.log(np.log(max(usual.sum(), 3))) if ranked else scores
    at = np.array([names.index(f"<0x{b:02X}>") for b in range(256)])
    return Vocabulary([p if u else "" for p, u in zip(names, usual)], np.round(logs * SCALE).astype(np.int64), at)


class Coder:
    """Tables for encoding and decoding, made once in each worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        points = [np.array([ord(c) for c in p], np.uint32) for p in vocabulary.pieces]
        chars = np.unique(np.concatenate([p for p in points if len(p)]))
        self.char = np.zeros(0x110001, np.int32)
        self.char[chars] = np.arange(1, len(chars) + 1)
        self.longest = max(len(p) for p in points)
        n = len(chars) + 1
        self.joined = np.zeros((n, n), bool)
        self.single = np.full(n, -1)
        keys, ids = [], []
        for i, p in enumerate(points):
            if not len(p):
                continue
            c = self.char[p]
            self.joined[c[:-1], c[1:]] = True
            keys.append(self._key(c))
            ids.append(i)
            if len(p) == 1:
                self.single[c[0]] = i
        self._place(np.array(keys, np.uint64), np.array(ids))
        self.by_text = {p: i for i, p in enumerate(vocabulary.pieces) if p}
        usual = vocabulary.scores[ids]
        self.byte_score = int(usual.min()) - int(BYTE_PENALTY * SCALE)
        decoded = [p.replace("▁", " ").encode() for p in vocabulary.pieces]
        for b, i in enumerate(vocabulary.bytes_at):
            decoded[i] = bytes([b])
        self.out_size = np.array([len(d) for d in decoded])
        self.out_at = np.concatenate(([0], np.cumsum(self.out_size)))
        self.out = np.frombuffer(b"".join(decoded), np.uint8)

    _STEP = np.uint64(0x9E3779B97F4A7C15)

    def _key(self, chars: np.ndarray) -> int:
        key = 0
        for c in chars:
            key = (key * int(self._STEP) + int(c)) & 0xFFFFFFFFFFFFFFFF
        return key

    def _place(self, keys: np.ndarray, ids: np.ndarray) -> None:
        """Tables of slots by the key's mixed bits; what collides goes to the next table."""
        self.tables = []
        left = np.arange(len(keys))
        for turn in range(64):
            slot = (tk.mix(keys[left] + np.uint64(turn)) >> np.uint64(46)).astype(np.int64)
            table_key, table_id = np.zeros(1 << 18, np.uint64), np.full(1 << 18, -1, np.int32)
            table_key[slot], table_id[slot] = keys[left], ids[left]
            self.tables.append((np.uint64(turn), table_key, table_id))
            left = left[table_key[slot] != keys[left]]
            if not len(left):
                return
        raise ValueError("pieces share a key")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each key, or -1."""
        out = np.full(len(keys), -1, np.int32)
        for turn, table_key, table_id in self.tables:
            slot = (tk.mix(keys + turn) >> np.uint64(46)).astype(np.int64)
            hit = (table_key[slot] == keys) & (table_id[slot] >= 0)
            out[hit] = table_id[slot[hit]]
        return out

    def side_by_side(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best pieces of parts of one length (rows of ``chars``): ids, flattened, and how many each part has."""
        n, size = chars.shape
        prefix = np.zeros((size + 1, n), np.uint64)
        for j in range(size):
            prefix[j + 1] = prefix[j] * self._STEP + chars[:, j].astype(np.uint64)
        power = [np.uint64(pow(int(self._STEP), k, 1 << 64)) for k in range(self.longest + 1)]
        best = np.full((size + 1, n), _NO)
        best[0] = 0
        piece, back = np.zeros((size + 1, n), np.int32), np.zeros((size + 1, n), np.int32)
        for end in range(1, size + 1):
            for k in range(1, min(end, self.longest) + 1):
                start = end - k
                found = self.find(prefix[end] - prefix[start] * power[k])
                score = np.where(found >= 0, self.v.scores[found], self.byte_score if k == 1 else _NO)
                total = best[start] + score
                better = (total >= best[end]) & (score > _NO)
                best[end][better], piece[end][better], back[end][better] = total[better], found[better], start
        ids = np.full((size, n), -2, np.int32)
        at = np.full(n, size)
        every = np.arange(n)
        for _ in range(size):
            live = np.flatnonzero(at > 0)
            if not len(live):
                break
            came = back[at[live], live]
            ids[came, live] = piece[at[live], live]
            at[live] = came
        flat = ids.T[ids.T > -2]
        return flat, (ids > -2).sum(0)[every]

    def streamed(self, text: list[int]) -> Iterator[int]:
        """Ids of one part (code points), committed while it is read; -1 marks a character without a piece."""
        best, piece, back = {0: 0}, {}, {}
        committed = 0
        for end in range(1, len(text) + 1):
            top = None
            for start in range(max(committed, end - self.longest), end):
                if start not in best:
                    continue
                word = "".join(map(chr, text[start:end]))
                found = self.by_text.get(word, -1)
                if found < 0 and end - start > 1:
                    continue
                total = best[start] + (int(self.v.scores[found]) if found >= 0 else self.byte_score)
                if top is None or total > top:  # starts ascend: the longest piece is seen first
                    top, piece[end], back[end] = total, found, start
            best[end] = top
            if end % self.longest == 0 or end == len(text):
                live = {p for p in best if p > end - self.longest} if end < len(text) else {end}
                while len(live) > 1:
                    last = max(live)
                    live.discard(last)
                    live.add(back[last] if last > committed else committed)
                meet = live.pop()
                path, at = [], meet
                while at > committed:
                    path.append(piece[at])
                    at = back[at]
                yield from reversed(path)
                committed = max(meet, committed)
                for old in [p for p in best if p < max(committed, end - self.longest) and p != committed]:
                    if old < committed:
                        best.pop(old), piece.pop(old, None), back.pop(old, None)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flattened, and the texts' bounds in them."""
        texts = [" " + t if t else "" for t in texts]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).copy()
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        points[points == SPACE] = _OWN_SPACE
        points[points == 0x20] = SPACE
        chars = self.char[points]
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.joined[chars[:-1], chars[1:]]
        cut[bounds[:-1][bounds[:-1] < len(points)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(points))
        _, first, which = np.unique(tk.hash_spans(points, starts, ends), return_index=True, return_inverse=True)
        ids, counts = self._parts(points, chars, starts[first], ends[first])
        at = np.cumsum(counts) - counts
        out = ids[tk.ragged(at[which], counts[which])]
        done = np.concatenate(([0], np.cumsum(counts[which])))
        return out, done[np.searchsorted(starts, bounds)]

    def _parts(self, points: np.ndarray, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts, flattened in their order, and their counts."""
        size = ends - starts
        pieces_of: list[np.ndarray] = []
        counts, order = [], []
        for k in np.unique(size):
            own = np.flatnonzero(size == k)
            if k <= SIDE_BY_SIDE:
                ids, n = self.side_by_side(chars[starts[own][:, None] + np.arange(k)[None, :]])
            else:
                runs = [list(self.streamed(points[starts[i] : ends[i]].tolist())) for i in own]
                ids, n = np.array([x for run in runs for x in run], np.int32), np.array([len(r) for r in runs])
            if (ids < 0).any():
                ids, n = self._with_bytes(ids, n, points, starts[own], ends[own])
            pieces_of.append(ids)
            counts.append(n)
            order.append(own)
        flat, n, own = np.concatenate(pieces_of), np.concatenate(counts), np.concatenate(order)
        at = np.cumsum(n) - n
        place = np.empty(len(own), np.int64)
        place[own] = np.arange(len(own))
        return flat[tk.ragged(at[place], n[place])], n[place]

    def _with_bytes(self, ids: np.ndarray, n: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, counts, at = [], [], 0
        for i, size in enumerate(n):
            part, row, place = ids[at : at + size], [], int(starts[i])
            for x in part:
                if x >= 0:
                    row.append(int(x))
                    place += len(self.v.pieces[x])
                else:
                    c = int(points[place])
                    row += [int(self.v.bytes_at[b]) for b in chr(SPACE if c == _OWN_SPACE else c).encode()]
                    place += 1
            out += row
            counts.append(len(row))
            at += size
        return np.array(out, np.int32), np.array(counts)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all rows, and their bounds; the space before each text is dropped."""
        size = self.out_size[ids]
        start = self.out_at[ids]
        done = np.concatenate(([0], np.cumsum(size)))
        data = self.out[tk.ragged(start, size)] if len(ids) else np.zeros(0, np.uint8)
        ends = done[bounds]
        held = np.flatnonzero(np.diff(ends) > 0)
        data = np.delete(data, ends[:-1][held])
        less = np.concatenate(([0], np.cumsum(np.diff(ends) > 0)))
        return data, ends - less


_CODERS: dict[int, Coder] = {}


def coder(shared: object) -> Coder:
    if shared.id not in _CODERS:
        _CODERS.clear()
        _CODERS[shared.id] = Coder(shared.value)
    return _CODERS[shared.id]


class _Shared:
    """A vocabulary sent to the tasks once, by broadcast."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    @property
    def value(self) -> Vocabulary:
        return self.broadcast.value


def _same_rows(data: np.ndarray, bounds: np.ndarray, other: np.ndarray, other_bounds: np.ndarray) -> np.ndarray:
    if np.array_equal(bounds, other_bounds) and np.array_equal(data, other):
        return np.ones(len(bounds) - 1, bool)
    a, b = data.tobytes(), other.tobytes()
    return np.array([a[bounds[i] : bounds[i + 1]] == b[other_bounds[i] : other_bounds[i + 1]] for i in range(len(bounds) - 1)])


def _encode(shared: _Shared, checked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(shared)
        for piece in tk.pieces(batches):
            text = piece.column(piece.schema.get_field_index("text"))
            ids, bounds = code.encode([t or "" for t in text.to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32), mask=np.append(~text.is_valid().to_numpy(zero_copy_only=False), False)) if text.null_count else pa.array(bounds.astype(np.int32)), pa.array(ids))
            columns, names = [*piece.columns, lists], [*piece.schema.names, "__ids"]
            if checked:
                columns.append(pa.array(_same_rows(*tk.text_bytes(text), *code.decode(ids, bounds))))
                names.append("__same")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encoded(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", round_trip: str | None = None) -> DataFrame:
    """The documents with the ids of their texts; if a column is named, also whether decoding gives the text again."""
    refuse_taken(docs, ids, round_trip)
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(vocabulary))
    more = [T.StructField("__ids", T.ArrayType(T.IntegerType())), *[T.StructField("__same", T.BooleanType())] * bool(round_trip)]
    out = docs.mapInArrow(_encode(shared, bool(round_trip)), T.StructType([*docs.schema.fields, *more]))
    return out.withColumnsRenamed({"__ids": ids, **({"__same": round_trip} if round_trip else {})})


def _decode(shared: _Shared, ids: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(shared)
        for batch in batches:
            lengths = pac.fill_null(pac.list_value_length(batch.column(batch.schema.get_field_index(ids))), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            done = np.concatenate(([0], np.cumsum(lengths)))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(done, done[at] + PIECE_IDS, "right")) - 1)
                part = batch.slice(at, to - at)
                lists = part.column(part.schema.get_field_index(ids))
                data, ends = code.decode(lists.flatten().to_numpy(zero_copy_only=False), done[at : to + 1] - done[at])
                raw = data.tobytes()
                texts = [raw[a:b].decode() if ok else None for ok, a, b in zip(lists.is_valid().to_pylist(), ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "__text"])
                at = to

    return run


def decoded(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the texts that their ids stand for."""
    refuse_taken(rows, text)
    shared = _Shared(rows.sparkSession.sparkContext.broadcast(vocabulary))
    schema = T.StructType([*rows.schema.fields, T.StructField("__text", T.StringType())])
    return rows.mapInArrow(_decode(shared, ids), schema).withColumnRenamed("__text", text)
