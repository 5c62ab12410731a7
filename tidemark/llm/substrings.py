"""Suffix-array dedup: bytes inside strings of ``width`` bytes that occur more than once go.

A suffix array of every byte would sort many times the input. Equal strings of ``width`` bytes
hold equal anchors, though: of the ``FIRST``-byte strings inside a window, the one with the
smallest hash. So only suffixes at anchors are ranked, by prefix doubling: anchors are grouped
by the rank of their first bytes, those that are unique leave, and the others are reranked by
pairs of that rank and the rank of what follows or precedes, at growing offsets, until they are
unique or past the threshold. A rank is the 64-bit name (hash) of its string, which makes a
rerank a grouping in Spark instead of a total sort:

1. anchors by their first bytes (32 of 200);
2. the whole surroundings of an anchor, all windows it stands for (most copies end here);
3. what is left: the anchor with the 84 bytes before it, and with the 84 after it;
4. the windows themselves, compared within the groups of step 3.

Texts move once, into a table bucketed by their key; equal texts are one row of it. Groups of
step 4 with more than ``LARGE_GROUP`` members are not gathered: their windows become rows.

Defined cases: null and empty texts have no bytes; texts shorter than the width keep all bytes;
repeated rows are occurrences of their own, so copies of a text lose all of it from ``width``
bytes on; a cut may end inside a character, so the kept bytes are binary.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text_bytes as tb
from tidemark.llm.frames import carried, released
from tidemark.sources.scratch import run_folder, written

WIDTH, FIRST = 200, 32
LARGE_GROUP = 1_000
PIECE = 1 << 20  # positions of a text that are looked at together
_U = np.uint64
_LOW = _U(PIECE - 1)


class Names:
    """64-bit names of any stretch of some bytes."""

    def __init__(self, data: np.ndarray) -> None:
        self.n = len(data)
        up, self.down = tb._POWERS.get(self.n + 1)
        self.total = np.zeros(self.n + 1, _U)
        np.cumsum(tb._CODES[data] * up[:self.n], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return tb.mix((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(_U))


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    span = 1
    while span * 2 <= w:
        x, span = np.minimum(x[:-span], x[span:]), span * 2
    return np.minimum(x[:len(x) - (w - span)], x[w - span:]) if span < w else x


def anchors(data: np.ndarray, bounds: np.ndarray, width: int, first: int):
    """Of texts end to end (fewer than ``PIECE`` bytes): anchor, first and last window start, name."""
    names = Names(data)
    at = np.arange(len(data) - first + 1)
    name = names.of(at, at + first)
    least = _window_min((name & ~_LOW) | at.astype(_U), width - first + 1)
    start = np.arange(len(least))
    inside = start + width <= bounds[np.searchsorted(bounds, start, "right")]
    start, anchor = start[inside], (least[inside] & _LOW).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])[:len(anchor)])
    last = np.append(new[1:] - 1, len(start) - 1)[:len(new)]
    return anchor[new], start[new], start[last], name[anchor[new]]


def pieces(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts, and long texts in pieces that share ``width - 1`` bytes: row, offset, bytes, bounds."""
    for row, data, bounds in tb.chunks(column, PIECE // 2):
        if len(data) < PIECE:
            yield row, 0, data, bounds
        else:  # a single text; window starts are dealt to the pieces
            step = PIECE - width
            for offset in range(0, max(1, len(data) - width + 1), step):
                part = data[offset:offset + step + width - 1]
                yield row, offset, part, np.array([0, len(part)])


def _pack(anchor: np.ndarray, start: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place of an anchor, bytes before it back to its first window, and its number of windows less one."""
    return (anchor << 32) | ((anchor - start) << 24) | ((last - start) << 16)


def _unpack(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    anchor = x >> 32
    start = anchor - ((x >> 24) & 255)
    return anchor, start, start + ((x >> 16) & 255)


def _emit_anchors(width: int, first: int, located: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, t2 = (np.asarray(batch.column(i)) for i in (0, 1))
            for row, offset, data, bounds in pieces(batch.column(2), width):
                if len(data) < width:
                    continue
                anchor, start, last, name = anchors(data, bounds, width, first)
                out = [pa.array(name.view(np.int64))]
                if located:
                    text = np.searchsorted(bounds, anchor, "right") - 1
                    base = offset - bounds[text]
                    out += [pa.array(t[row + text]),
                            pa.array(_pack(anchor + base, start + base, last + base) | t2[row + text])]
                yield pa.RecordBatch.from_arrays(out, names=["g", "t", "x"][:len(out)])

    return run


def _local(texts: pa.Array, lists: pa.Array, margin: int):
    """Anchors with the bytes around them: rows, packed anchors, bytes, shift of each anchor's text, text lengths.

    Whole texts end to end; of a long text, pieces with ``margin`` bytes on both sides."""
    ends = np.asarray(lists.offsets).astype(np.int64)
    flat = np.asarray(lists.values)
    for row, data, bounds in tb.chunks(texts, PIECE // 2):
        n = len(bounds) - 1
        counts = np.diff(ends[row:row + n + 1])
        if not counts.sum():
            continue
        which = np.repeat(np.arange(n), counts)
        x = flat[ends[row]:ends[row + n]]
        if len(data) < PIECE:
            yield row + which, x, data, bounds[which], np.diff(bounds)[which]
            continue
        for offset in range(0, len(data), PIECE // 2):
            near = x[(x >> 32 >= offset) & (x >> 32 < offset + PIECE // 2)]
            begin = max(0, offset - margin)
            if len(near):
                yield (np.full(len(near), row), near, data[begin:offset + PIECE // 2 + margin],
                       np.full(len(near), -begin), np.full(len(near), len(data)))


def _reranked(width: int, first: int):
    """Names of the surroundings, and of the anchor with half of what may precede or follow it."""
    half = (width - first) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, m = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for row, x, data, shift, length in _local(batch.column(2), batch.column(3), 2 * width):
                names, n = Names(data), len(data)
                anchor, start, last = _unpack(x)
                around = tb.mix(names.of(start + shift, last + width + shift) + ((x >> 16) & 0xFFFF).astype(_U))
                before = np.maximum(anchor - half + shift, 0)
                after = np.minimum(anchor + first + half + shift, n)
                at = anchor + shift
                left = np.where(start <= anchor - half, names.of(before, at + first) & ~_U(1) | _U(2), _U(0))
                right = np.where((anchor + first + half <= length) & (last >= anchor - half),
                                 names.of(at, after) | _U(1), _U(0))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c.view(np.int64)) for c in (around, left, right)], pa.array(t[row]), pa.array(x),
                     pa.array(m[row])], names=["name", "l", "r", "t", "x", "m"])

    return run


def _contexts(width: int, first: int):
    """The bytes of the windows that each listed member of a group may share with others."""
    half = (width - first) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                member, text = batch.column(1)[i].values, batch.column(2)[i].as_buffer()
                q, x = np.asarray(member.field("q")), np.asarray(member.field("x"))
                anchor, start, last = _unpack(x)
                after = (q & 1) == 1
                lo = np.where(after, np.maximum(start, anchor - half), start)
                hi = np.where(after, last, np.minimum(last, anchor - half))
                parts = [text[a:b].to_pybytes() for a, b in zip(lo.tolist(), (hi + width).tolist())]
                yield {"t": np.full(len(x), batch.column(0)[i].as_py()), "q": q, "x": x,
                       "open": member.field("open"), "large": member.field("large"), "lo": lo - anchor, "bytes": parts}

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in run(batches):
            held.append(pa.RecordBatch.from_arrays(
                [pa.array(v) if not isinstance(v, pa.Array) else v for v in part.values()], names=list(part)))
            n += len(part["x"])
            if n >= 5000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return gathered


def _window_names(q: np.ndarray, lo: np.ndarray, parts: pa.Array, width: int):
    """For members: their row, window (relative to the anchor) and its name within the group."""
    for row, data, bounds in tb.chunks(parts, PIECE):
        counts = np.diff(bounds) - width + 1
        which = np.repeat(np.arange(len(counts)), counts)
        j = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = bounds[which] + j
        at = lo[row + which] + j
        name = tb.mix(Names(data).of(begin, begin + width) ^ tb.mix(q[row + which].view(_U) + at.astype(_U) * _U(2654435761)))
        yield row + which, at, name


def _in_groups(width: int):
    """Rows come sorted by group: windows that two members of a group share, of open members."""
    def settle(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        cols = {n: table.column(n).chunk(0) for n in table.column_names}
        q, x, lo, t = (np.asarray(cols[n]) for n in ("q", "x", "lo", "t"))
        open_ = np.asarray(cols["open"].cast(pa.int8())) > 0
        found = list(_window_names(q, lo, cols["bytes"], width))
        row, at, name = (np.concatenate([f[k] for f in found]) for k in range(3))
        order = np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        hit = np.zeros(len(name), bool)
        hit[order[1:][same]] = hit[order[:-1][same]] = True
        hit &= open_[row]
        row, begin = row[hit], (x[row] >> 32)[hit] + at[hit]
        edge = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (begin[1:] != begin[:-1] + 1)])[:len(row)])
        end = np.append(edge[1:] - 1, len(row) - 1)[:len(edge)]
        return pa.RecordBatch.from_arrays([pa.array(t[row[edge]]), pa.array(x[row[edge]] & 0xFFFF), pa.array(begin[edge]),
                                           pa.array(begin[end])], names=["t", "t2", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            q = np.asarray(batch.column(1))
            if held and np.asarray(held[-1].column(1))[-1] != q[0]:
                yield settle(pa.Table.from_batches(held))
                held = []
            cut = len(q) - int((q[::-1] != q[-1]).argmax()) if (q != q[-1]).any() else 0  # start of the last group
            if cut:
                yield settle(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield settle(pa.Table.from_batches(held))

    return run


def _as_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, q, x, lo = (np.asarray(batch.column(i)) for i in (0, 1, 2, 5))
            for row, at, name in _window_names(q, lo, batch.column(6), width):
                yield pa.RecordBatch.from_arrays([
                    pa.array(name.view(np.int64)), pa.array(t[row]), pa.array(x[row] & 0xFFFF), pa.array((x[row] >> 32) + at),
                    batch.column(3).take(pa.array(row))], names=["w", "t", "t2", "first", "open"])

    return run


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for i in range(batch.num_rows):
                buffer = batch.column(2)[i].as_buffer()
                n = len(buffer)
                x = np.asarray(batch.column(3)[i].values) if batch.column(3)[i].is_valid else np.zeros(0, np.int64)
                if batch.column(4)[i].is_valid:
                    x = np.setdiff1d(x, np.asarray(batch.column(4)[i].values))
                _, first, last = _unpack(x)
                if batch.column(5)[i].is_valid:
                    pairs = batch.column(5)[i].values
                    first = np.concatenate([first, np.asarray(pairs.field("first"))])
                    last = np.concatenate([last, np.asarray(pairs.field("last"))])
                if len(first):
                    change = np.zeros(n + 1, np.int64)
                    np.add.at(change, first, 1)
                    np.add.at(change, last + width, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    removed.append(int(gone.sum()))
                    spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                    kept.append(np.frombuffer(buffer, np.uint8)[~gone].tobytes())
                else:
                    removed.append(0)
                    spans.append(0)
                    kept.append(buffer.to_pybytes())
                sizes.append(n)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["t", "t2", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def repeated_strings(docs: DataFrame, text_col: str = "text", width: int = WIDTH, first: int = FIRST,
                     hashed: bool = False) -> DataFrame:
    """The rows without their text, with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (bytes, or their sha256 in hex)."""
    if not 0 < first < width <= 255:
        raise ValueError("0 < first < width <= 255")
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")).cast("binary")
    rows = carried(docs).withColumn("b", text).withColumns(
        {"t": F.xxhash64("b"), "t2": F.xxhash64(F.lit(1), "b").bitwiseAND(0xFFFF)})
    rows = rows.withColumn("row", F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != text_col]))
    keyed = rows.select("t", "t2", "b")
    t2 = F.col("x").bitwiseAND(0xFFFF).alias("t2")  # x carries the second key of its text
    # Unique first bytes leave; the others are listed per text.
    again = written(keyed.mapInArrow(_emit_anchors(width, first, False), "g bigint")
                    .groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g"), "first-ranks")
    listed = (keyed.mapInArrow(_emit_anchors(width, first, True), "g bigint, t bigint, x bigint")
              .join(again, "g").groupBy("t", t2).agg(F.sort_array(F.collect_set("x")).alias("xs")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = keyed.groupBy("t", "t2").agg(F.first("b").alias("b"), F.count(F.lit(1)).alias("m"))
    name = f"suffixes_{uuid.uuid4().hex}"
    (texts.join(listed, ["t", "t2"], "left").select("t", "t2", "m", "b", "xs")
     .write.bucketBy(n, "t", "t2").option("compression", "zstd").option("path", run_folder(spark, "suffix-texts")).format("parquet").saveAsTable(name))
    table = spark.table(name)

    classes = written(
        table.where("xs is not null").select("t", "m", "b", "xs")
        .mapInArrow(_reranked(width, first), "name bigint, l bigint, r bigint, t bigint, x bigint, m bigint")
        .groupBy("name").agg(F.sum("m").alias("n"), F.min(F.struct("t", "x", "l", "r")).alias("one"))
        .select("n", "one.*"), "surroundings")
    # An anchor whose surroundings are unique is open: which of its windows occur again?
    sides = classes.select("t", "x", (F.col("n") == 1).alias("open"),
                           F.explode(F.array("l", "r")).alias("q")).where("q <> 0")
    shared = written(sides.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.max("open").alias("any_open"))
                     .where("n > 1 and any_open").select("q", (F.col("n") > LARGE_GROUP).alias("large")), "second-ranks")
    members = sides.join(shared, "q").groupBy("t", t2).agg(
        F.collect_list(F.struct("q", "x", "open", "large")).alias("members"))
    contexts = written(
        table.select("t", "t2", "b").join(members, ["t", "t2"]).select("t", "members", "b")
        .mapInArrow(_contexts(width, first), "t bigint, q bigint, x bigint, open boolean, large boolean, "
                    "lo bigint, bytes binary"), "contexts")
    small = (contexts.where("not large").repartition("q").sortWithinPartitions("q")
             .mapInArrow(_in_groups(width), "t bigint, t2 bigint, first bigint, last bigint"))
    each = contexts.where("large").mapInArrow(_as_rows(width), "w bigint, t bigint, t2 bigint, first bigint, open boolean")
    twice = written(each.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w"), "windows")
    hot = each.where("open").join(twice, "w").select("t", "t2", "first", F.col("first").alias("last"))
    found = small.unionByName(hot).groupBy("t", "t2").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    opened = classes.where("n = 1").groupBy("t", t2).agg(F.collect_list("x").alias("open_x"))
    cut = (table.join(found, ["t", "t2"], "left").join(opened, ["t", "t2"], "left")
           .select("t", "t2", "b", "xs", "open_x", "spans")
           .mapInArrow(_cut(width), "t bigint, t2 bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"))
    if hashed:
        cut = cut.withColumn("kept", F.sha2("kept", 256))
    cut = written(cut, "cut")  # so that the join shuffles both sides and a text with very many copies can be split
    joined = rows.drop("b").join(cut.withColumnsRenamed({"t": "c_t", "t2": "c_t2"}),
                                 (F.col("t") == F.col("c_t")) & (F.col("t2") == F.col("c_t2")))
    return released(joined, n_bytes=F.col("n_bytes"), n_removed=F.col("n_removed"), n_spans=F.col("n_spans"),
                    kept=F.col("kept"))
