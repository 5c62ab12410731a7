"""MinHash near-dedup: consistent weighted sampling over TF-IDF shingles.

Shingles are runs of five words (A-Z in lower case). A shingle weighs its count times a damped
idf: idf is ln(N/df) over ln(1/RARE), 1 for all that fewer than a share ``RARE`` of the
documents have, so that only the shingles above that share need a document frequency. These
are counted exactly in two passes (hash buckets first, then the shingles of buckets that may
reach the share); there are at most (shingles per document)/RARE of them, at any size.

Improved consistent weighted samples, ``ROWS`` to a band, make buckets. In a bucket every
member is compared with a leader, in later rounds with other members of the bucket's largest
component; links are pairs whose weighted Jaccard similarity, computed from the whole texts,
reaches the threshold. Members whose bucket still spans several components are then compared
with all members of the other components, so no candidate pair that could join two classes is
left out, and no class is ever expanded into all its pairs.

Defined cases: texts with fewer than five words are one shingle; null, empty and blank texts
have none and stay alone; equal texts are one class from one word on; repeated rows are in
one class; rows without an id join classes like others, and the class id is the least id.
Texts are told apart by 64-bit keys.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import text_bytes as tb
from tidemark.llm.components import components
from tidemark.llm.frames import carried, released
from tidemark.sources.scratch import run_folder, written

SHINGLE_WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 5
SAMPLES, SPREAD = BANDS * ROWS, 5.5
RARE = 0.01  # share of documents from which a shingle counts as frequent
IDF_SHARE = 0.25  # how much of a weight the idf decides
BUCKETS = 1 << 18
CHUNK_BYTES = 1 << 18
STAR_ROUNDS = 8  # at most; what they leave is compared pair by pair
WORTH = 4  # a round that links fewer than one in so many of its pairs is the last
LARGE_BUCKET, BLOCK = 40, 250  # members; larger buckets are compared block by block
PER_LEADER = 500  # pairs of one leader that are compared in one group
_U = np.uint64


class Weights:
    """idf of the frequent shingles, and the weight of a shingle."""

    def __init__(self, names: np.ndarray, idf: np.ndarray) -> None:
        order = np.argsort(names)
        self.names, self.idf = names[order], idf[order]

    def of(self, names: np.ndarray, counts: np.ndarray) -> np.ndarray:
        idf = np.ones(len(names))
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
            idf = np.where(self.names[at] == names, self.idf[at], 1.0)
        return counts * (1 - IDF_SHARE + IDF_SHARE * idf)


def shingled(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of texts: shingle names, and where those of each text begin."""
    for _, data, bounds in tb.chunks(column, CHUNK_BYTES):
        starts, ends, firsts = tb.words(data, bounds)
        yield tb.shingles(tb.hashes(data, starts, ends), firsts, SHINGLE_WORDS)


def weighted(column: pa.Array, weights: Weights) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text: its distinct shingles in order, and their weights."""
    for names, first in shingled(column):
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            distinct, counts = np.unique(names[a:b], return_counts=True)
            yield distinct, weights.of(distinct, counts)


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        docs += batch.num_rows
        for names, _ in shingled(batch.column(0)):
            total += np.bincount((names % _U(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    if docs:
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], docs))],
                                         names=["bucket", "n"])


def _frequent_counts(heavy: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for names, first in shingled(batch.column(0)):
                may = np.flatnonzero(heavy[(names % _U(BUCKETS)).astype(np.int64)])
                text = np.searchsorted(first, may, "right") - 1
                order = np.lexsort((names[may], text))
                text, name = text[order], names[may][order]
                new = np.concatenate([[True], (text[1:] != text[:-1]) | (name[1:] != name[:-1])])[:len(text)]
                found.append(name[new])
            names, n = np.unique(np.concatenate(found) if found else np.zeros(0, _U), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n)], names=["name", "n"])

    return run


def frequent_shingles(texts: DataFrame) -> Weights:
    """Document frequencies of all shingles that a share ``RARE`` of the documents has."""
    counts = written(texts.mapInArrow(_bucket_counts, "bucket bigint, n bigint").groupBy("bucket")
                     .agg(F.sum("n").alias("n")), "shingle-buckets")
    n_docs = (counts.where("bucket = -1").first() or {"n": 0})["n"]
    least = max(2, math.ceil(RARE * n_docs))
    heavy = np.zeros(BUCKETS, bool)  # of a fixed size, whatever the input
    heavy[[r["bucket"] for r in counts.where((F.col("bucket") >= 0) & (F.col("n") >= least)).collect()]] = True
    if not heavy.any():
        return Weights(np.zeros(0, _U), np.zeros(0))
    rows = (texts.mapInArrow(_frequent_counts(heavy), "name bigint, n bigint").groupBy("name")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas())
    idf = np.log(n_docs / rows["n"].to_numpy(float)) / math.log(1 / RARE)
    return Weights(rows["name"].to_numpy(np.int64).view(_U), np.clip(np.round(idf * 16) / 16, 0, 1))


class Sampler:
    """Consistent weighted samples: the chance that two texts agree is their weighted Jaccard similarity.

    The two gamma variables and the shift of a (shingle, sample) pair are drawn from a table by
    16 bits of a hash; of equal values the shingle with the smaller name wins.
    """

    def __init__(self, n: int, seed: int = 1) -> None:
        random = np.random.default_rng(seed)
        self.r, self.c = random.gamma(2, 1, 1 << 16), np.log(random.gamma(2, 1, 1 << 16))
        self.beta = random.random(1 << 16)
        self.odd = tb.mix(np.arange(1, n + 1, dtype=_U)) | _U(1)
        self.table = lru_cache(maxsize=64)(self._table)

    def _table(self, weight: float) -> tuple[np.ndarray, np.ndarray]:
        t = np.floor(math.log(weight) / self.r + self.beta)
        return (self.c - self.r * (t - self.beta) - self.r).astype(np.float32), t.astype(np.int32)

    def samples(self, names: np.ndarray, weights: np.ndarray) -> np.ndarray:
        best = np.full(len(self.odd), np.inf, np.float32)
        winner, level = np.zeros(len(self.odd), _U), np.zeros(len(self.odd), np.int64)
        for weight in np.unique(weights):
            value, t = self.table(float(weight))
            chosen = names[weights == weight]
            for i in range(0, len(chosen), 1024):
                part = chosen[i:i + 1024]
                draw = ((part[:, None] * self.odd) >> _U(48)).view(np.int64)
                a = value[draw]
                at = a.argmin(0)
                least, k = a[at, np.arange(len(at))], np.arange(len(at))
                better = (least < best) | ((least == best) & (part[at] < winner))
                best[better], winner[better] = least[better], part[at][better]
                level[better] = t[draw[at, k]][better]
        return tb.mix(winner ^ tb.mix(level.view(_U)))


def sketch(samples: np.ndarray) -> np.ndarray:
    """Four bits of each sample, fifteen samples to a number."""
    bits = (samples & _U(15)).reshape(-1, 15) << (np.arange(15, dtype=_U) * _U(4))
    return np.bitwise_or.reduce(bits, axis=1).view(np.int64)


def _differing(a: Column, b: Column) -> Column:
    """How many samples differ in two sketches."""
    out = F.lit(0)
    for i in range(SAMPLES // 15):
        x = a[i].bitwiseXOR(b[i])
        y = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        out = out + F.bit_count(y.bitwiseOR(F.shiftrightunsigned(y, 2)).bitwiseAND(0x1111111111111111))
    return out


def plausible(a: Column, b: Column, threshold: float) -> Column:
    """Whether two (weight, sketch) may belong to texts as similar as the threshold.

    The lighter text's share of the heavier bounds the similarity. Of the samples of a pair at
    the threshold, more than ``SPREAD`` standard deviations beyond the mean differ with a
    chance of some 1e-8, far below that of sharing no band.
    """
    p = (1 - threshold) * 15 / 16
    most = SAMPLES * p + SPREAD * math.sqrt(SAMPLES * p * (1 - p))
    lighter, heavier = F.least(a["w"], b["w"]), F.greatest(a["w"], b["w"])
    return (lighter >= heavier * (threshold - 1e-9)) & (_differing(a["s"], b["s"]) <= most)


def _signed(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, lanes = Sampler(SAMPLES), np.arange(BANDS, dtype=_U)
        for batch in batches:
            text = batch.column(batch.schema.names.index("text"))
            bands, sketches, total = [], [], []
            for names, w in weighted(text, weights):
                total.append(w.sum())
                if len(names):
                    found = sampler.samples(names, w)
                    sketches.append(sketch(found))
                    s = found.reshape(BANDS, ROWS)
                    h = lanes
                    for j in range(ROWS):
                        h = tb.mix(h * _U(0x9E3779B97F4A7C15) + s[:, j])
                    bands.append(h.view(np.int64))
                else:
                    bands.append([])
                    sketches.append([])
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(bands, pa.list_(pa.int64())), pa.array(total, pa.float64()),
                pa.array(sketches, pa.list_(pa.int64()))], names=[*batch.schema.names, "bands", "w", "s"])

    return run


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (distinct sorted names, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - shared
    return float(shared / total) if total else 0.0


def _compared(weights: Weights, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similarity(x, y) >= threshold - 1e-12
                    for x, y in zip(weighted(batch.column(2), weights), weighted(batch.column(3), weights))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))

    return run


def compared_block(few: list, all_: list, threshold: float) -> Iterator[tuple[int, int]]:
    """Pairs of two lists of (node, root, weighted shingles) with different roots that are similar enough.

    The shingles of the first list are inverted once; each text of the second adds up what it shares."""
    names = np.concatenate([x[2][0] for x in few])
    order = np.argsort(names, kind="stable")
    names = names[order]
    row = np.repeat(np.arange(len(few)), [len(x[2][0]) for x in few])[order]
    weight = np.concatenate([x[2][1] for x in few])[order]
    total = np.array([x[2][1].sum() for x in few])
    root = np.array([x[1] for x in few])
    for node, its_root, (its_names, its_weights) in all_:
        lo, hi = np.searchsorted(names, its_names), np.searchsorted(names, its_names, "right")
        at = tb.runs(lo, hi - lo)
        shared = np.bincount(row[at], np.minimum(weight[at], np.repeat(its_weights, hi - lo)), minlength=len(few))
        whole = total + its_weights.sum() - shared
        for i in np.flatnonzero((shared >= (threshold - 1e-12) * whole) & (root != its_root)).tolist():
            yield few[i][0], node


def _block_links(weights: Weights, threshold: float):
    """Rows come sorted by group: links between the members marked ``few`` and all members."""
    def settle(rows: pa.Table) -> pa.RecordBatch:
        few, node, root = (rows.column(n).to_pylist() for n in ("few", "node", "root"))
        sets = list(weighted(rows.column("text"), weights))
        listed = list(zip(node, root, sets))
        found = list(compared_block([x for x, f in zip(listed, few) if f], [x for x, f in zip(listed, few) if not f], threshold)) \
            if any(few) and not all(few) else []
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                           pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            g = np.asarray(batch.column(0))
            edges = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
            for a, b in zip(edges[:-1], edges[1:]):
                if held and g[a] != last:
                    yield settle(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = g[a]
        if held:
            yield settle(pa.Table.from_batches(held))

    return run


def _links_of_large(open_: DataFrame, texts: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """Links across components inside large buckets, whose members are dealt to blocks.

    Every block of members outside the largest component meets every block of members; a group
    holds two blocks, whatever the size of the bucket."""
    sizes = open_.groupBy("bucket").agg(
        F.ceil(F.count_if(F.col("root") != F.col("big")) / BLOCK).cast("int").alias("few_blocks"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = open_.select("bucket", "node", "root", "big").join(sizes, "bucket")
    block = F.xxhash64("node", F.lit(7))
    all_ = members.select("bucket", "node", "root", F.lit(False).alias("few"), F.pmod(block, F.col("blocks")).cast("int").alias("y"),
                          F.explode(F.sequence(F.lit(0), F.col("few_blocks") - 1)).alias("x"))
    few = members.where("root <> big").select(
        "bucket", "node", "root", F.lit(True).alias("few"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("y"),
        F.pmod(block, F.col("few_blocks")).cast("int").alias("x"))
    rows = all_.unionByName(few).select(F.xxhash64("bucket", "x", "y").alias("g"), "node", "root", "few")
    return (rows.join(texts, "node").select("g", "few", "node", "root", "text")
            .repartition("g").sortWithinPartitions("g").mapInArrow(_block_links(weights, threshold), "a bigint, b bigint")
            .distinct())


def _links(pairs: DataFrame, texts: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """The pairs (leader a, member b) that are similar enough. A leader's pairs are dealt to groups."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_LEADER).cast("int").alias("groups"))
    leaders = texts.join(sizes, texts.node == sizes.a).select(
        "a", F.col("text").alias("text_a"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"))
    members = texts.join(pairs.join(sizes, "a"), texts.node == F.col("b")).select(
        "a", "b", F.col("text").alias("text_b"), F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("g"))
    return members.join(leaders, ["a", "g"]).select("a", "b", "text_a", "text_b").mapInArrow(
        _compared(weights, threshold), "a bigint, b bigint")


def _rooted(rows: DataFrame, roots: DataFrame, node: str = "node") -> DataFrame:
    """Rows with ``root``, their node's component (or the node itself)."""
    named = roots.select(F.col("a").alias("_a"), F.col("root").alias("_root"))
    return rows.join(named, F.col(node) == F.col("_a"), "left").withColumn(
        "root", F.coalesce("_root", F.col(node))).drop("_a", "_root")


def _largest(placed: DataFrame, order) -> DataFrame:
    """Of buckets that span components: their size, their largest component, and the member of it that is first by ``order``."""
    parts = placed.groupBy("bucket", "root").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(order.alias("o"), "node")).alias("first"))
    whole = parts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("roots"), F.sum("n").alias("n"), F.max(F.struct("n", "root", "first.node")).alias("big"))
    return written(whole.where("roots > 1").select(
        "bucket", "n", F.col("big.root").alias("big"), F.col("big.node").alias("rep")), "largest")


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows with ``class_id`` (least id of the class), ``class_size`` and ``kept`` (one row of each class)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    rows = carried(docs).select(
        F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != text_col]).alias("row"), text.alias("text"),
        F.col(f"row.`{id_col}`").alias("id"), F.xxhash64(text.cast("binary")).alias("node"),
        F.monotonically_increasing_id().alias("u"))
    weights = frequent_shingles(docs.select(F.col(f"`{text_col}`").alias("text")))
    schema = T.StructType([*rows.schema.fields, T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("w", T.DoubleType()),
                           T.StructField("s", T.ArrayType(T.LongType()))])
    base = written(rows.mapInArrow(_signed(weights), schema), "signed")

    signed = base.select("node", "bands").groupBy("node").agg(F.first("bands").alias("bands"))
    banded = written(signed.select("node", F.explode("bands").alias("bucket")), "banded")
    shared = written(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader"))
                     .where("n > 1"), "buckets")
    members = written(banded.join(shared.select("bucket", "leader"), "bucket"), "members")
    # One row of each text that is needed, found by number, so that copies never meet with their texts.
    chosen = written(base.select("node", "u").groupBy("node").agg(F.min("u").alias("u"))
                     .join(members.select("node").distinct(), "node").select("u"), "chosen")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"candidates_{uuid.uuid4().hex}"
    (base.select("node", "text", "u").join(chosen, "u").select("node", "text").repartition(n, "node")
     .write.bucketBy(n, "node").option("compression", "zstd").option("path", run_folder(spark, "candidates")).format("parquet").saveAsTable(table))
    texts = spark.table(table)

    sketches = written(base.groupBy("node").agg(F.first(F.struct("w", "s")).alias("k")), "sketches")

    def likely(pairs: DataFrame) -> DataFrame:
        return (pairs.join(sketches.select(F.col("node").alias("a"), F.col("k").alias("ka")), "a")
                .join(sketches.select(F.col("node").alias("b"), F.col("k").alias("kb")), "b")
                .where(plausible(F.col("ka"), F.col("kb"), threshold)).select("a", "b"))

    # First each member with the leader it shares most buckets with.
    stars = members.where("node <> leader").groupBy(F.col("leader").alias("a"), F.col("node").alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    tested = written(stars.groupBy("b").agg(F.max(F.struct("n", F.col("a"))).alias("m")).select("m.a", "b"), "pairs")
    links = written(_links(written(likely(tested), "likely"), texts, weights, threshold), "links")
    roots = components(links)
    # Then, where a bucket spans components, with other leaders: each round takes another member
    # of the bucket's largest component, so that a large group of copies soon is one component.
    for i in range(STAR_ROUNDS):
        placed = written(_rooted(members.select("bucket", "node"), roots), "placed")
        largest = _largest(placed, F.xxhash64(F.lit(i), "node"))
        pairs = placed.join(largest, "bucket").where("root <> big").select(
            F.col("rep").alias("a"), F.col("node").alias("b")).distinct()
        pairs = written(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        found = written(_links(written(likely(pairs), "likely"), texts, weights, threshold), "links")
        tested = tested.unionByName(pairs)
        n_found = found.count()
        if n_found:
            links = links.unionByName(found)
            roots = components(links)
        if n_found * WORTH <= pairs.count():
            break
    # Buckets that span components still: all pairs across them, but those that were compared.
    placed = written(_rooted(members.select("bucket", "node"), roots), "placed")
    open_ = written(placed.join(_largest(placed, F.col("node")).where("n > 2").select("bucket", "n", "big"), "bucket")
                    .join(sketches, "node"), "open")
    links = links.unionByName(written(_links_of_large(open_.where(F.col("n") > LARGE_BUCKET), texts, weights, threshold), "links"))
    open_ = open_.where(F.col("n") <= LARGE_BUCKET)
    few = open_.where("root <> big").select("bucket", F.col("node").alias("x"), F.col("root").alias("x_root"),
                                            F.col("k").alias("kx"))
    pairs = few.join(open_, "bucket").where((F.col("root") != F.col("x_root")) & (
        (F.col("root") == F.col("big")) | (F.col("x") < F.col("node"))) & plausible(F.col("k"), F.col("kx"), threshold))
    pairs = pairs.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct() \
        .join(tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    links = links.unionByName(written(_links(written(pairs, "pairs"), texts, weights, threshold), "links"))
    roots = components(links)

    # One row of each class stays: the least id, then the least row number of the written table.
    alone = F.size("bands") == 0
    labelled = _rooted(base.select("row", "text", "id", "node", "u", alone.alias("alone")), roots)
    labelled = labelled.withColumn("alone_u", F.when(F.col("alone"), F.col("u")).otherwise(F.lit(-1)))
    facts = labelled.groupBy("root", "alone_u").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "u")).alias("first"),
        F.count(F.lit(1)).alias("class_size"))
    facts = written(facts.select(F.col("root").alias("f_root"), F.col("alone_u").alias("f_alone"), "first", "class_size"),
                    "classes")
    joined = labelled.join(facts, (F.col("root") == F.col("f_root")) & (F.col("alone_u") == F.col("f_alone")))
    return released(joined, **{text_col: F.col("text"), "class_id": F.col("first.id"), "class_size": F.col("class_size"),
                               "kept": F.col("u") == F.col("first.u")})


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, as it was."""
    return classify(docs, **options).where("kept").select(*[F.col(f"`{c}`") for c in docs.columns])
