"""SentencePiece encoding and decoding by suffix-array matching.

The distinct units of an Arrow batch are laid end to end and indexed by a suffix array. Every
piece is looked up by binary search; its range of suffixes is where it occurs. Occurrences are
edges, sorted by position, and relaxed: an edge over two neighbouring symbols merges them, the
one with the best score (then the leftmost) first in each unit, until no edge is left to take.
That is the order in which the pieces of a BPE model merge, so the ids are those of the
SentencePiece library; a best path over all edges would be right for unigram models only.
What no piece covers becomes bytes.

Units are cut where no piece reaches across: between two bytes that stand side by side in no
piece. Units known from earlier batches of a worker are not matched again.

Defined cases: a null or empty text has no ids and decodes to the empty text; a text of blanks
is encoded like any other; the sign U+2581 is a blank to the model and decodes to one; repeated
rows are encoded alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import text_bytes as tb
from tidemark.llm.distinct import Known
from tidemark.llm.frames import carried, released

CHUNK_BYTES = 2 << 20
KNOWN_UNITS = 1_000_000
UNIT_BYTES = 1 << 20  # of distinct units that are indexed together
BLANK = "▁"
_SEPARATOR = 255  # no byte of UTF-8


class Model:
    """The pieces of a SentencePiece model file; blanks stand for its blank sign."""

    _loaded: dict[str, Model] = {}

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        normal, byte = 1, 6  # fixed values: types of pieces in the file format
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback \
                or model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("a BPE model with byte fallback and plain text is needed")
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.byte_id = np.zeros(256, np.int32)
        self.spelled = [b""] * len(model.pieces)  # what an id decodes to
        found = []
        for i, p in enumerate(model.pieces):
            if p.type == normal:
                self.spelled[i] = p.piece.replace(BLANK, " ").encode()
                found.append((self.spelled[i], i, p.score))
            elif p.type == byte:
                value = int(p.piece[3:5], 16)
                self.byte_id[value], self.spelled[i] = i, bytes([value])
        scores = sorted({s for _, _, s in found}, reverse=True)
        order = {s: n for n, s in enumerate(scores)}
        found.sort()
        self.texts = [t for t, _, _ in found]
        self.ids = np.array([i for _, i, _ in found], np.int32)
        self.rank = np.array([order[s] for _, _, s in found], np.int64)
        self.length = np.array([len(t) for t in self.texts], np.int64)
        self.single = np.array([len(t.decode()) == 1 for t in self.texts])
        self.width = int(self.length.max())
        self.matrix = np.zeros((len(found), self.width), np.uint8)
        for n, t in enumerate(self.texts):
            self.matrix[n, :len(t)] = list(t)
        joined = np.zeros((256, 256), bool)  # bytes side by side in some piece
        for t in self.texts:
            raw = np.frombuffer(t, np.uint8)
            joined[raw[:-1], raw[1:]] = True
        joined[:, 0x80:0xC0] = True  # never inside a character
        self.joined = joined
        self.spelled_size = np.array([len(x) for x in self.spelled], np.int64)
        self.spelled_begin = np.cumsum(self.spelled_size) - self.spelled_size
        self.spelled_bytes = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.known = Known(self.encode_units, KNOWN_UNITS)

    @classmethod
    def of(cls, path: str) -> Model:
        """One per worker process."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    # --- matching ---------------------------------------------------------------------------

    def suffix_array(self, data: np.ndarray) -> np.ndarray:
        """Positions in the order of their suffixes, as far as the longest piece reaches."""
        n = len(data)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        key = np.zeros(n, np.uint64)
        for j in range(8):
            key = (key << np.uint64(8)) | padded[j:j + n]
        reach = 8
        while True:
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.zeros(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
            if reach >= self.width or rank.max(initial=0) == n - 1:
                return order
            after = np.zeros(n, np.int64)
            after[:max(0, n - reach)] = rank[reach:] + 1
            key = (rank.astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
            reach *= 2

    def ranges(self, data: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every piece the first and the end of its range in the suffix array, by binary search."""
        n = len(data)
        padded = np.concatenate([data, np.zeros(self.width + 1, np.uint8)])
        columns = np.arange(self.width)
        inside = columns < self.length[:, None]
        bounds = []
        for upper in (False, True):
            lo, hi = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), n, np.int64)
            active = np.flatnonzero(lo < hi)
            while len(active):
                mid = (lo[active] + hi[active]) // 2
                text = padded[order[mid][:, None] + columns]
                differs = (text != self.matrix[active]) & inside[active]
                at = differs.argmax(1)
                row = np.arange(len(active))
                some = differs[row, at]
                less = some & (text[row, at] < self.matrix[active, at])  # the suffix comes before the piece
                right = less | ~some if upper else less
                lo[active[right]] = mid[right] + 1
                hi[active[~right]] = mid[~right]
                active = active[lo[active] < hi[active]]
            bounds.append(lo)
        return bounds[0], bounds[1]

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, and how many each has."""
        sizes, ids, at = [], [], 0
        total = np.cumsum([len(u) + 1 for u in units])
        while at < len(units):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + UNIT_BYTES)))
            found, n = self._encode_together(units[at:end])
            ids.append(found)
            sizes.append(n)
            at = end
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode_together(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sep = bytes([_SEPARATOR])
        data = np.frombuffer(sep.join(units) + sep, np.uint8)
        order = self.suffix_array(data)
        lo, hi = self.ranges(data, order)
        piece = np.repeat(np.arange(len(self.ids)), hi - lo)
        start = order[tb.runs(lo, hi - lo)]
        by_place = np.argsort(start, kind="stable")
        piece, start = piece[by_place], start[by_place]
        symbol = np.full(len(data), -1, np.int64)  # the piece of the symbol that starts at a byte
        single = self.single[piece]
        symbol[start[single]] = piece[single]
        piece, start = piece[~single], start[~single]
        is_symbol = (data & 0xC0) != 0x80  # starts of symbols, first of all characters; separators too
        self._relax(data, piece, start, is_symbol, symbol)
        at = np.flatnonzero(is_symbol)
        found, length = symbol[at], np.diff(np.append(at, len(data)))
        sign = data[at] == _SEPARATOR
        unknown = (found < 0) & ~sign
        count = np.where(sign, 0, np.where(unknown, length, 1))
        out = np.zeros(int(count.sum()), np.int32)
        first = np.cumsum(count) - count
        out[first[(found >= 0)]] = self.ids[found[found >= 0]]
        places = tb.runs(at[unknown], length[unknown])
        out[tb.runs(first[unknown], length[unknown])] = self.byte_id[data[places]]
        unit_ends = first[sign]
        return out, np.diff(unit_ends, prepend=0)

    def _relax(self, data: np.ndarray, piece: np.ndarray, start: np.ndarray, is_symbol: np.ndarray,
               symbol: np.ndarray) -> None:
        """Take edges, the best of each unit at a time, until none joins two neighbouring symbols."""
        unit = np.cumsum(data == _SEPARATOR)[start]
        end = start + self.length[piece]
        weight = (self.rank[piece] << 32) | start
        base, flags = 0, is_symbol
        while len(piece):
            places = np.flatnonzero(flags)
            nth = np.cumsum(flags)  # symbols up to and with a byte
            live = flags[start - base] & flags[end - base]
            spans = nth[end - base] - nth[start - base]  # symbols under the edge
            live &= spans > 1
            if not live.all():
                piece, start, end, unit, weight, spans = (x[live] for x in (piece, start, end, unit, weight, spans))
            ready = np.flatnonzero(spans == 2)
            if not len(ready):
                return
            group = unit[ready]
            head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            least = np.minimum.reduceat(weight[ready], head)
            size = np.diff(np.append(head, len(ready)))
            best = ready[weight[ready] == np.repeat(least, size)]
            middle = places[nth[start[best] - base]]  # the symbol after the first
            flags[middle] = False
            symbol[start[best]] = piece[best]
            # A unit without an edge that is ready never has one again.
            going = np.zeros(int(unit[-1]) + 1, bool)
            going[group] = True
            stays = going[unit]
            if not stays.all():
                piece, start, end, unit, weight = (x[stays] for x in (piece, start, end, unit, weight))
            if len(start) and (end[-1] - start[0] + 1) * 2 < len(flags):  # go on with the bytes still in question
                new = int(start[0])
                flags = flags[new - base:int(end.max()) - base + 1]
                base = new

    # --- texts ------------------------------------------------------------------------------

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of texts (with their blank in front): ids, and where each text's begin."""
        for _, data, bounds in tb.chunks(column, CHUNK_BYTES):
            n = len(data)
            cut = np.ones(n, bool)
            if n:
                cut[1:] = ~self.joined[data[:-1], data[1:]]
                cut[bounds[bounds < n]] = True
            starts = np.flatnonzero(cut)
            yield self.known.ids(data, starts, np.append(starts[1:], n)[:len(starts)], np.searchsorted(starts, bounds))

    def decode(self, ids: np.ndarray, firsts: np.ndarray) -> list[str]:
        """The texts of runs of ids, without the blank in front."""
        size = self.spelled_size[ids]
        raw = self.spelled_bytes[tb.runs(self.spelled_begin[ids], size)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[firsts].tolist()
        skip = 1 if self.prefix else 0
        return [raw[a + (skip if raw[a:a + 1] == b" " else 0):b].decode("utf-8", "replace")
                for a, b in zip(ends[:-1], ends[1:])]


def _coded(path: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.of(path)
        for batch in batches:
            at = 0
            for ids, firsts in model.encode(batch.column(1)):
                n = len(firsts) - 1
                texts = model.decode(ids, firsts)
                bounds = firsts.tolist()
                if digest:
                    raw = ids.astype("<u4")
                    last = pa.array([zlib.crc32(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, n), pa.array(np.diff(firsts)), last, pa.array(texts, pa.string())],
                    names=["row", "n_pieces", "ids", "decoded"])
                at += n

    return run


def encode_decode(docs: DataFrame, model: str, text_col: str = "text", digest: bool = False) -> DataFrame:
    """The rows with ``n_pieces``, ``ids`` (or, with ``digest``, their crc32 as little-endian 32-bit
    integers) and ``decoded``, the text that the ids spell. No shuffle."""
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    plain = F.translate(text, BLANK, " ")
    rows = carried(docs).select("row", F.when(plain == "", "").otherwise(F.concat(F.lit(" "), plain)).alias("text"))
    rows = rows.withColumn("row", F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != text_col]))
    kind = T.LongType() if digest else T.ArrayType(T.IntegerType())
    schema = T.StructType([rows.schema["row"], T.StructField("n_pieces", T.LongType()), T.StructField("ids", kind),
                           T.StructField("decoded", T.StringType())])
    return released(rows.mapInArrow(_coded(model, digest), schema), n_pieces=F.col("n_pieces"), ids=F.col("ids"),
                    decoded=F.col("decoded"))
