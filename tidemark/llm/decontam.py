"""Benchmark decontamination: test items as a BM25 index, training passages as the queries.

Impacts are BM25 scores divided by the item's score for its own text, so one threshold holds
for all items. Every document is cut into blocks of words; three blocks in a row are a passage,
and passages overlap by two blocks. Passages are evaluated many at a time, in the manner of
WAND with bounds per block of the query: lists of words so common that they cannot carry an item over the
threshold are not essential and never opened for candidates; the impacts of the essential lists are added up
per block of words, the sums of three blocks bound the score of a passage, and only where the
bound and the most the other lists can add reach the threshold is a passage scored exactly. There is no
pivot that moves through the lists passage by passage; see the README.
All items above the threshold are retrieved, and verified: the share of the question's and of
the answer's word runs that the passage holds.

The index is built in Spark and searched in groups of ``ITEMS`` items, each sent to the tasks
in turn; documents flow through the searches without a shuffle.

Defined cases: null and empty texts leak nothing; items without words match nothing; an item
without an answer part is verified by its question; repeated documents are judged alike, and
items that repeat are found each under its id; a null item id counts as a leak without an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidemark.llm import text_bytes as tb
from tidemark.llm.frames import ascii_lower, carried, released
from tidemark.sources.scratch import written

K1, B = 1.2, 0.75
THRESHOLD = 0.5  # of the item's score for its own text
QUESTION_SHARE, ANSWER_SHARE, RUN_WORDS = 0.6, 0.5, 5
ITEMS = 1_000  # searched together
BLOCK_WORDS = 32  # at least; half the longest item of a group otherwise
CELLS = 4 << 20  # blocks times items whose sums are held at once
COMMON = 0.05  # lists of words that this share of the items has are not essential
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def item_words(text: Column) -> Column:
    """Runs of letters and digits, A-Z in lower case."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN), lambda w: w != "")


def _answer_start(text: str) -> int:
    """Where the answer part begins: after the last line break or sentence end that words follow."""
    body = text.rstrip()
    for mark in ("\n", "? ", ". ", "! "):
        at = body.rfind(mark)
        if at >= 0 and any(c.isalnum() for c in body[at:]) and any(c.isalnum() for c in body[:at]):
            return at + len(mark)
    return len(text)


def impacts(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per item with words: number, id, text, length, its words and their impacts."""
    rows = items.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")) \
        .withColumn("w", item_words(F.col("text"))).where(F.size("w") > 0).withColumn("size", F.size("w"))
    # Items are put in order of their length (one column of it), so that groups hold items of like length.
    rows = written(rows, "items")
    sizes = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(F.col("size").alias("s"), (F.sum("n").over(W.orderBy("size")) - F.col("n")).alias("before"))
    rows = rows.join(before, F.col("size") == F.col("s")).withColumn(
        "number", F.col("before") + F.row_number().over(W.partitionBy("size").orderBy("id", "text")) - 1)
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("avg")).first()
    if not total["n"]:
        return rows.select("number", "id", "text", "size", F.lit(None).cast("array<string>").alias("words"),
                           F.lit(None).cast("array<double>").alias("impacts"))
    rows = written(rows.select("number", "id", "text", "size", "w"), "numbered-items")
    counts = rows.select("number", "size", F.explode("w").alias("word")).groupBy("number", "size", "word").agg(
        F.count(F.lit(1)).alias("f"))
    df = counts.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    score = F.log(1 + (total["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("f") * (K1 + 1) / (
        F.col("f") + K1 * (1 - B + B * F.col("size") / total["avg"]))
    scored = counts.join(df, "word").select("number", "word", score.alias("s"), (F.col("df") / total["n"]).alias("share"))
    lists = scored.groupBy("number").agg(F.collect_list(F.struct("word", "s", "share")).alias("l"), F.sum("s").alias("own"))
    return rows.drop("w").join(lists, "number").select(
        "number", "id", "text", "size", F.col("l.word").alias("words"), F.col("l.share").alias("shares"),
        F.transform("l.s", lambda s: s / F.col("own")).alias("impacts"))


def _hash_words(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    return tb.hashes(data, ends - [len(r) for r in raw], ends)


def _text_hashes(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = tb.words(data, np.array([0, len(data)]), between=tb.IS_SIGN)
    return tb.hashes(data, starts, ends)


def _runs_of(h: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for j in range(width):
        out = tb.mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + len(out)])
    return out


@dataclass
class Group:
    """The index of some items: postings of essential words, and each item's words for the exact score."""

    ids: list[int | None]
    block_words: int
    vocab: np.ndarray  # hashes of essential words, sorted
    begin: np.ndarray  # where the postings of each begin (one more at the end)
    posting_item: np.ndarray
    posting_impact: np.ndarray
    other: np.ndarray  # the most that the lists not opened add, per item
    words: list[tuple[np.ndarray, np.ndarray]]  # hashes and impacts of all words of an item
    parts: list[list[tuple[np.ndarray, int, float]]]  # runs of question and answer, width, share needed

    @classmethod
    def of(cls, rows: list) -> Group:
        words, parts, essential, other = [], [], [], np.zeros(len(rows))
        for n, r in enumerate(rows):
            h, s = _hash_words(r["words"]), np.array(r["impacts"])
            common = np.array(r["shares"]) >= COMMON
            if s[common].sum() >= 0.8 * THRESHOLD:  # an item of common words alone: all its lists are essential
                common[:] = False
            other[n] = s[common].sum()
            words.append((h, s))
            essential += [(x, n, y) for x, y in zip(h[~common].tolist(), s[~common].tolist())]
            at = _answer_start(r["text"])
            found = []
            for part, share in ((r["text"][:at], QUESTION_SHARE), (r["text"][at:], ANSWER_SHARE)):
                ph = _text_hashes(part.encode())
                if len(ph):
                    width = min(RUN_WORDS, len(ph))
                    found.append((np.unique(_runs_of(ph, width)), width, share))
            parts.append(found)
        essential.sort()
        h = np.array([x for x, _, _ in essential], np.uint64)
        vocab, begin = np.unique(h, return_index=True)
        return cls([r["id"] for r in rows], max(BLOCK_WORDS, -(-max(r["size"] for r in rows) // 2)), vocab,
                   np.append(begin, len(h)), np.array([n for _, n, _ in essential], np.int64),
                   np.array([s for _, _, s in essential]), other, words, parts)

    def candidates(self, h: np.ndarray, firsts: np.ndarray):
        """(text, first word, end, item) of passages whose bound reaches the threshold."""
        n, size = len(self.ids), self.block_words
        counts = np.diff(firsts)
        blocks = -(-counts // size)
        first_block = np.concatenate([[0], np.cumsum(blocks)])
        if not len(self.vocab) or not first_block[-1]:
            return
        at = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        hit = np.flatnonzero(self.vocab[at] == h)
        text = np.searchsorted(firsts, hit, "right") - 1
        block = first_block[text] + (hit - firsts[text]) // size
        key = np.unique(block * len(self.vocab) + at[hit])
        block, word = key // len(self.vocab), key % len(self.vocab)
        owner = np.repeat(np.arange(len(counts)), blocks)
        step = max(1, CELLS // n - 2)
        for low in range(0, len(owner), step):  # a long text is walked in slices that overlap by two blocks
            high = min(low + step + 2, len(owner))
            a, b = np.searchsorted(block, [low, high])
            size_of = self.begin[word[a:b] + 1] - self.begin[word[a:b]]
            posting = tb.runs(self.begin[word[a:b]], size_of)
            sums = np.bincount(np.repeat(block[a:b] - low, size_of) * n + self.posting_item[posting], self.posting_impact[posting],
                               minlength=(high - low) * n).reshape(-1, n)
            bound, own = sums[:step].copy(), owner[low:high]
            for j in (1, 2):
                same = np.flatnonzero(own[j:] == own[:-j])
                same = same[same < len(bound)]
                bound[same] += sums[same + j]
            for at_block, item in np.argwhere(bound >= THRESHOLD - self.other - 1e-9).tolist():
                k = low + at_block
                start = firsts[owner[k]] + (k - first_block[owner[k]]) * size
                yield owner[k], start, min(start + 3 * size, firsts[owner[k] + 1]), item

    def leaks(self, passage: np.ndarray, item: int) -> bool:
        """Whether the passage scores above the threshold and holds question and answer."""
        h, s = self.words[item]
        if s[np.isin(h, passage)].sum() < THRESHOLD - 1e-9:
            return False
        for runs, width, share in self.parts[item]:
            if np.isin(runs, _runs_of(passage, width)).mean() < share:
                return False
        return bool(self.parts[item])


def _searched(group: Group):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[set] = [set() for _ in range(batch.num_rows)]
            for row, data, bounds in tb.chunks(batch.column(1), 1 << 19):
                starts, ends, firsts = tb.words(data, bounds, between=tb.IS_SIGN)
                h = tb.hashes(data, starts, ends)
                for text, a, b, item in group.candidates(h, firsts):
                    if item not in found[row + text] and group.leaks(h[a:b], item):
                        found[row + text].add(item)
            hits = [[*(old or []), *(group.ids[i] for i in sorted(new))]
                    for old, new in zip(batch.column(2).to_pylist(), found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, pa.list_(pa.int64()))],
                                             names=["row", "text", "found"])

    return run


def leaked_items(docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The rows with ``items`` (sorted ids of the test items they hold) and ``contaminated``."""
    index = written(impacts(items, id_col, "text"), "item-index")
    n = index.count()  # items are numbered from 0 without a gap
    rest = F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != text_col])
    rows = carried(docs).select(rest.alias("row"), F.col(f"row.`{text_col}`").alias("text"),
                                F.array().cast("array<bigint>").alias("found"))
    schema = T.StructType(rows.schema.fields)
    for k in range(0, n, ITEMS):
        group = Group.of(index.where(F.col("number").between(k, k + ITEMS - 1)).orderBy("number").collect())
        rows = rows.mapInArrow(_searched(group), schema)
    return released(rows, **{text_col: F.col("text"), "items": F.sort_array(F.array_distinct("found")),
                             "contaminated": F.size("found") > 0})


def keep_clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows that hold no test item, as they were."""
    return leaked_items(docs, items, **options).where(~F.col("contaminated")).select(
        *[F.col(f"`{c}`") for c in docs.columns])
