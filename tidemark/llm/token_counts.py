"""Token counts: a tokenizer compiled into a deterministic transducer that counts.

The model is a BPE model: a text's pieces are those of which every two neighbours would also
come out of the two alone. So the pieces of a text's first ``i`` characters end in exactly one
piece whose start the last piece before it agrees with, and whether they agree is a fact about
two pieces. What a later character can still need is therefore finite: the longest end of the
text that some piece goes on from, and for each start in it the last piece before and how many
pieces there were. That is a state. A transition reads one character and is annotated with the
tokens it emits, the growth of the count (below 0 where a longer piece takes the place of
several). States are built when a text first reaches them and kept per worker; beyond
``MAX_STATES`` the table is built anew, so memory is bounded.

Texts are cut into chunks, and the chunks of a batch step through the table side by side. A chunk
gives a state map: start state -> (end state, emitted tokens). Chunks begin where no piece
reaches across, where the state is always the same, so their map has one entry. An unbroken
run is also cut inside; such a chunk has an entry for each state that a fresh start a few
characters before would lead to. The maps of a document are composed by a prefix scan in
log steps; a start state that a map does not have is read for itself, so counts are exact.

Defined cases: a null or empty text has no tokens; the sign U+2581 is a blank to the model;
characters outside the vocabulary are as many tokens as they have UTF-8 bytes; special strings
inside texts are text; repeated rows are counted alike; rows with a null id are counted too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import text_bytes as tb
from tidemark.llm.frames import carried, released

BLANK = 0x2581
SLICE_BYTES = 4 << 20  # read together; a longer text is read in slices
CHUNK = 256  # characters of a chunk
UNBROKEN = 1024  # a run without a seam is cut after so many
GUESSES = 16  # start states that are tried for a cut inside a run
MAX_STATES, MAX_STEPS = 200_000, 1 << 20
_EMPTY = -1
_NONE = -1  # no piece before that matters
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The pieces of a model over symbols: their trie, and whether two agree as neighbours.

    Symbols 0 to 3 are characters that no piece has, by their UTF-8 bytes less one.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, spec = model.normalizer_spec, model.trainer_spec
        if (spec.model_type != spec.BPE or not spec.byte_fallback or spec.treat_whitespace_as_suffix or norm.precompiled_charsmap
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not norm.add_dummy_prefix):
            raise ValueError("only BPE models with byte fallback and plain normalisation are compiled")
        texts = [(p.piece, p.score) for p in model.pieces if p.type == 1]
        letters = sorted({c for t, _ in texts for c in t})
        self.symbol = {c: i + 4 for i, c in enumerate(letters)}
        self.n_symbols = len(letters) + 4
        self.of_code = np.zeros(0x110000, np.int32)
        codes = np.arange(0x110000)
        self.of_code += (codes >= 0x80).astype(np.int32) + (codes >= 0x800) + (codes >= 0x10000)
        self.of_code[[ord(c) for c in letters]] = range(4, self.n_symbols)
        self.of_code[32] = self.of_code[BLANK]
        self.blank = int(self.of_code[BLANK])
        self.pieces = [tuple(self.symbol[c] for c in t) for t, _ in texts]
        self.score = {p: s for p, (_, s) in zip(self.pieces, texts)}
        self._trie()
        # Which symbols stand side by side in some piece: no piece reaches across any others.
        self.joined = np.zeros((self.n_symbols, self.n_symbols), bool)
        for p in self.pieces:
            self.joined[list(p[:-1]), list(p[1:])] = True
        self.goes_on = self.joined.any(1)
        self._agree: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}

    def _trie(self) -> None:
        self.child: list[dict[int, int]] = [{}]
        self.piece_at, self.depth, self.first = [_NONE], [0], [0]
        for i, p in enumerate(self.pieces):
            at = 0
            for s in p:
                if s not in self.child[at]:
                    self.child[at][s] = len(self.child)
                    self.child.append({})
                    self.piece_at.append(_NONE)
                    self.depth.append(self.depth[at] + 1)
                    self.first.append(p[0])
                at = self.child[at][s]
            self.piece_at[at] = i
        self.shorter = [0] * len(self.child)  # the longest proper end that is in the trie too
        level = list(self.child[0].values())
        while level:
            below = []
            for at in level:
                for s, to in self.child[at].items():
                    up = self.shorter[at]
                    while up and s not in self.child[up]:
                        up = self.shorter[up]
                    self.shorter[to] = self.child[up].get(s, 0)
                    below.append(to)
            level = below
        # The ends of each node that some piece goes on from, the longest first, down to the empty one.
        self.open: dict[int, tuple[int, ...]] = {0: (0,)}

    def ends(self, at: int) -> tuple[int, ...]:
        if at not in self.open:
            rest = self.ends(self.shorter[at])
            self.open[at] = (at, *rest) if self.child[at] else rest
        return self.open[at]

    def merged(self, symbols: tuple[int, ...]) -> list[tuple[int, ...]]:
        """The pieces of a few symbols: the best pair first, then the leftmost."""
        parts = [(s,) for s in symbols]
        pairs = [self.score.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best = max((x for x in pairs if x is not None), default=None)
            if best is None:
                return parts
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            for j in (i - 1, i):
                if 0 <= j < len(pairs):
                    pairs[j] = self.score.get(parts[j] + parts[j + 1])

    def agree(self, left: int, right: int) -> bool:
        """Whether the two pieces come out of their text as they are; nothing on the left agrees with every piece."""
        if left == _NONE:
            known = self._whole.get(right)
            if known is None:
                known = self._whole[right] = len(self.merged(self.pieces[right])) == 1
            return known
        key = left * len(self.pieces) + right
        known = self._agree.get(key)
        if known is None:
            a, b = self.pieces[left], self.pieces[right]
            known = self._agree[key] = self.merged(a + b) == [a, b]
        return known


class Transducer:
    """States and annotated transitions, both made when they are first needed."""

    _loaded: dict[str, Transducer] = {}

    def __init__(self, pieces: Pieces) -> None:
        self.p = pieces
        self._clear([])

    @classmethod
    def of(cls, path: str) -> Transducer:
        if path not in cls._loaded:
            cls._loaded[path] = cls(Pieces(path))
        return cls._loaded[path]

    def _clear(self, live: list[tuple]) -> list[int]:
        """An empty table that has the given states; their new numbers."""
        self.number: dict[tuple, int] = {}
        self.state: list[tuple] = []
        self.size = 2 * MAX_STEPS
        self.keys = np.full(self.size, _EMPTY, np.int64)
        self.to, self.emits = np.zeros(self.size, np.int32), np.zeros(self.size, np.int8)
        self.used = 0
        self.fresh = self._intern((0, ((_NONE, 0),)))
        if len(self.p._agree) > 4 * MAX_STATES:
            self.p._agree.clear()
        return [self._intern(s) for s in live]

    def _intern(self, state: tuple) -> int:
        found = self.number.get(state)
        if found is None:
            found = self.number[state] = len(self.state)
            self.state.append(state)
        return found

    def _compile(self, state: int, symbol: int) -> tuple[int, int]:
        """Where the transition leads and what it emits."""
        p = self.p
        if symbol < 4:  # bytes; nothing joins them
            return self.fresh, symbol + 1
        at, before = self.state[state]
        by_depth = {p.depth[u]: x for u, x in zip(p.ends(at), before)}
        while at and symbol not in p.child[at]:
            at = p.shorter[at]
        at = p.child[at][symbol]
        u = at
        while True:  # the last piece now: the one that the piece before its start agrees with
            last = p.piece_at[u]
            if last != _NONE:
                left, count = by_depth[p.depth[u] - 1]
                if p.agree(left, last):
                    break
            u = p.shorter[u]
            if not u:
                raise AssertionError("a single symbol always is a piece")
        emitted = count + 1
        after = []
        ends = p.ends(at)
        for u in ends[:-1]:
            left, count = by_depth[p.depth[u] - 1]
            if left != _NONE and not p.joined[p.pieces[left][-1], p.first[u]]:
                left = _NONE
            after.append((left, count - emitted))
        after.append((last if p.goes_on[symbol] else _NONE, 0))
        return self._intern((ends[0], tuple(after))), emitted

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * _SPREAD) >> np.uint64(64 - (self.size.bit_length() - 1))).astype(np.int64)

    def run(self, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, start: np.ndarray) -> tuple[list[tuple], np.ndarray]:
        """The end state and the emitted tokens of every stretch, all read side by side."""
        order = np.argsort(begin - end, kind="stable")
        begin, length = begin[order], (end - begin)[order]
        states, counts = start[order].astype(np.int64), np.zeros(len(order), np.int64)
        active = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), "left")
        done: list = [None] * len(order)
        previous = len(order)
        for t, n in enumerate(active.tolist()):
            if n < previous:  # those that have ended keep their state's meaning, not its number
                for i in range(n, previous):
                    done[order[i]] = self.state[states[i]]
                previous = n
            if len(self.state) > MAX_STATES or self.used > MAX_STEPS * 0.9:
                seen, back = np.unique(states[:n], return_inverse=True)
                states[:n] = np.array(self._clear([self.state[i] for i in seen]), np.int64)[back]
            key = states[:n] * self.p.n_symbols + symbols[begin[:n] + t]
            slot = self._slots(key)
            while True:
                held = self.keys[slot]
                other = np.flatnonzero(held != key)
                if not len(other):
                    break
                missing = other[held[other] == _EMPTY]
                if len(missing):
                    for k in set(key[missing].tolist()):
                        self._insert(k)
                else:
                    slot[other] = (slot[other] + 1) & (self.size - 1)
            states[:n] = self.to[slot]
            counts[:n] += self.emits[slot]
        for i in range(previous):
            done[order[i]] = self.state[states[i]]
        out = np.empty(len(order), np.int64)
        out[order] = counts
        return done, out

    def _insert(self, key: int) -> None:
        slot = int(self._slots(np.array([key]))[0])
        while self.keys[slot] != _EMPTY:
            slot = (slot + 1) & (self.size - 1)
        to, emitted = self._compile(*divmod(key, self.p.n_symbols))
        self.keys[slot], self.to[slot], self.emits[slot] = key, to, emitted
        self.used += 1

    def cuts(self, symbols: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where chunks begin, and which of them begin inside an unbroken run.

        ``firsts`` are places that begin a chunk in any case (texts, and the slice)."""
        seam = np.ones(len(symbols), bool)
        seam[1:] = ~self.p.joined[symbols[:-1], symbols[1:]]
        forced = np.zeros(len(symbols), bool)
        forced[firsts] = True
        at = np.flatnonzero(seam | forced)
        first_of_block = np.ones(len(at), bool)
        first_of_block[1:] = at[1:] // CHUNK != at[:-1] // CHUNK
        at = at[first_of_block | forced[at]]
        n = (np.diff(np.append(at, len(symbols))) + UNBROKEN - 1) // UNBROKEN
        inside = tb.runs(np.zeros(len(at), np.int64), n)
        return np.repeat(at, n) + UNBROKEN * inside, inside > 0

    def guesses(self, symbols: np.ndarray, at: np.ndarray) -> list[list[tuple]]:
        """For each place, the states to which a fresh start at it and a few characters before leads."""
        back = np.tile(np.arange(GUESSES), len(at))
        to = np.repeat(at, GUESSES)
        found, _ = self.run(symbols, to - back, to, np.full(len(to), self.fresh))
        return [list(dict.fromkeys(found[i:i + GUESSES])) for i in range(0, len(found), GUESSES)]

    def _run_states(self, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, start: list[tuple]):
        return self.run(symbols, begin, end, np.array([self._intern(s) for s in start], np.int64))

    def totals(self, symbols: np.ndarray, firsts: np.ndarray, start: tuple | None = None) -> tuple[np.ndarray, tuple]:
        """The tokens of each stretch that begins at one of ``firsts``, and the state after the last.

        Every stretch starts fresh but the first, which goes on from ``start`` if one is given."""
        fresh = self.state[self.fresh]
        if not len(symbols):
            return np.zeros(len(firsts), np.int64), start or fresh
        begin, inside = self.cuts(symbols, firsts)
        end = np.append(begin[1:], len(symbols))
        starts: list[list[tuple]] = [[fresh]] * len(begin)
        starts[0] = [start or fresh]
        broken = np.flatnonzero(inside)
        for i, states in zip(broken.tolist(), self.guesses(symbols, begin[broken]) if len(broken) else []):
            starts[i] = states
        width = np.array([len(x) for x in starts])
        chunk = np.repeat(np.arange(len(begin)), width)
        ends, counts = self._run_states(symbols, begin[chunk], end[chunk], [s for x in starts for s in x])
        first = np.cumsum(width) - width
        last, total = self._composed(symbols, begin, end, inside, starts, ends, counts, first)
        return np.add.reduceat(total, np.searchsorted(begin, firsts)), last

    def _composed(self, symbols, begin, end, inside, starts, ends, counts, first) -> tuple[tuple, np.ndarray]:
        """The state after all chunks, and for each chunk that ends an unbroken run the tokens of the run (else 0)."""
        heads = np.flatnonzero(~inside)
        place = np.arange(len(begin)) - heads[np.cumsum(~inside) - 1]  # of a chunk in its run
        closes = np.append(heads[1:], len(begin)) - 1
        total = np.zeros(len(begin), np.int64)
        total[closes] = counts[first[closes]]
        last = ends[first[closes[-1]]]
        runs = np.flatnonzero(place[closes] > 0)
        if not len(runs):
            return last, total
        # State maps as rows of equal width: number of the start state, of the end state (-1: not known), tokens.
        members = np.flatnonzero((place > 0) | np.isin(np.arange(len(begin)), heads[runs]))
        numbers: dict[tuple, int] = {}
        s, e, c = (np.full((len(members), GUESSES), -1, np.int64) for _ in range(3))
        for row, k in enumerate(members.tolist()):
            for w, state in enumerate(starts[k]):
                i = first[k] + w
                s[row, w] = numbers.setdefault(state, len(numbers))
                e[row, w], c[row, w] = numbers.setdefault(ends[i], len(numbers)), counts[i]
        own, at, step = (s.copy(), e.copy(), c.copy()), place[members], 1
        while (at >= step).any():  # each map takes in the one that many places before it
            after = np.flatnonzero(at >= step)
            meets = (e[after - step][:, :, None] == s[after][:, None, :]) & (e[after - step] >= 0)[:, :, None]
            hit, which = meets.any(2), meets.argmax(2)
            new_e = np.where(hit, np.take_along_axis(e[after], which, 1), -1)
            new_c = c[after - step] + np.take_along_axis(c[after], which, 1)
            s[after], e[after], c[after] = s[after - step], new_e, new_c
            step *= 2
        states = list(numbers)
        for run in runs.tolist():
            rows = np.arange(np.searchsorted(members, heads[run]), np.searchsorted(members, closes[run], "right"))
            end_state, tokens = int(e[rows[-1], 0]), int(c[rows[-1], 0])
            if end_state < 0:  # a map on the way lacks the state that came: go through the run
                end_state, tokens = int(own[1][rows[0], 0]), int(own[2][rows[0], 0])
                for row in rows[1:].tolist():
                    w = np.flatnonzero(own[0][row] == end_state)
                    if len(w):
                        end_state, more = int(own[1][row, w[0]]), int(own[2][row, w[0]])
                    else:
                        k = members[row:row + 1]
                        found, n = self._run_states(symbols, begin[k], end[k], [states[end_state]])
                        if found[0] not in numbers:
                            numbers[found[0]] = len(states)
                            states.append(found[0])
                        end_state, more = numbers[found[0]], int(n[0])
                    tokens += more
            total[closes[run]] = tokens
            last = states[end_state] if run == len(heads) - 1 else last
        return last, total

    def count(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The tokens of the texts of a column, in pieces of the column."""
        for _, data, bounds in tb.chunks(column, SLICE_BYTES):
            if len(bounds) == 2 and len(data) > SLICE_BYTES:
                yield self._long(data)
                continue
            codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
            begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
            out, some = np.zeros(len(bounds) - 1, np.int64), np.flatnonzero(np.diff(begins))
            if len(some):
                symbols = np.insert(self.p.of_code[codes], begins[some], self.p.blank)
                out[some], _ = self.totals(symbols, begins[some] + np.arange(len(some)))
            yield out

    def _long(self, data: np.ndarray) -> np.ndarray:
        """One text, slice by slice: a slice goes on from the state in which the one before ended."""
        at, state, total, blank = 0, None, 0, [self.p.blank]
        while at < len(data):
            end = min(at + SLICE_BYTES, len(data))
            while end < len(data) and (data[end] & 0xC0) == 0x80:
                end += 1
            codes = np.frombuffer(data[at:end].tobytes().decode().encode("utf-32-le"), np.uint32)
            symbols = np.concatenate([np.array(blank, np.int32), self.p.of_code[codes]])
            tokens, state = self.totals(symbols, np.zeros(1, np.int64), state)
            at, total, blank = end, total + int(tokens[0]), []
        return np.array([total])


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer.of(path)
        for batch in batches:
            counts = [np.zeros(0, np.int64), *machine.count(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(counts))], names=["row", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, model: str, text_col: str = "text", limit: int = 4096) -> DataFrame:
    """The rows without their text, with ``n_bytes``, ``n_tokens`` and ``over_limit``. No shuffle."""
    text = F.coalesce(F.make_valid_utf8(F.col(f"row.`{text_col}`")), F.lit(""))
    size = F.octet_length(F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))).cast("bigint")
    others = F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != text_col])
    rows = carried(docs).select(F.struct(size.alias("bytes"), others.alias("row")).alias("row"), text.alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("n_tokens", T.LongType())])
    counted = rows.mapInArrow(_counted(model), schema).select(
        F.col("row.row").alias("row"), F.col("row.bytes").alias("bytes"), "n_tokens")
    return released(counted, n_bytes=F.col("bytes"), n_tokens=F.col("n_tokens"), over_limit=F.col("n_tokens") > limit)
