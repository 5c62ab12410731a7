"""Toxicity: a weighted lexicon, matched after folding disguised letters.

Texts are folded (case, look-alike letters of other scripts, digits and signs inside words)
and searched with an Aho-Corasick automaton. Terms are whole words or word beginnings; their
weights are log odds learned from labelled rows, beside a short list of seeds. At each place
the heaviest term counts, unless an exception phrase covers it. The sum of weights is
normalised by length and becomes a probability by a logistic curve fitted on the same rows.

Learning uses at most ``MAX_LABELLED`` labelled ids (those with the smallest hash), with one
row for each distinct text of an id; scoring reads every text whole.

Defined cases: null and empty texts score like any text without a hit; labels that are null
are left out and of labels that differ for one id the greater counts; without both kinds of
labels the seeds and a fixed curve are used; repeated rows are scored alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import carried, released
from tidemark.sources.scratch import written

MAX_LABELLED = 20_000
MIN_SUPPORT = 5  # toxic rows that must hold a learned term
MIN_WEIGHT = 3.0
PREFIXES = (4, 5, 6)
SEED_WEIGHT = 5.0
# Insults that count without any label, and phrases in which such words are harmless.
SEEDS = ("idiot", "moron", "stupid", "imbecile", "scum", "pathetic", "worthless", "disgusting", "loser", "dumbass")
EXCEPTIONS = ("class clown", "clown fish", "trash can", "trash bin", "trash bag", "pond scum", "sore loser", "weight loser",
              "village idiot lights", "oxymoron")
LOOKALIKES = dict(zip("авеіјкмнорсѕтухьԁɡοαεικντυρχβ", "abeijkmhopcstyxbdgoaeikvtupxb"))
DIGITS = str.maketrans("0134578@$!", "oieastbasi")
_DISGUISED = re.compile(r"[a-z]+[0134578@$!]+[a-z0-9@$!]*|[0134578@$]+[a-z][a-z0-9@$!]*")
_WORD = re.compile(r"[^\W\d_]+")
_FOLD = {ord(k): v for k, v in LOOKALIKES.items()} | {0xFF41 + i: chr(97 + i) for i in range(26)} | \
    {0xFF10 + i: chr(48 + i) for i in range(10)} | dict.fromkeys((0xAD, 0x200B, 0x200C, 0x200D, 0x2060), "")


def fold(text: str) -> str:
    """Lower case, plain letters for look-alikes, letters for digits and signs inside words."""
    t = text.lower()
    if not t.isascii():
        t = t.translate(_FOLD)

    def plain(m: re.Match) -> str:
        body = m[0].rstrip("@$!")
        return body.translate(DIGITS) + m[0][len(body):]

    return _DISGUISED.sub(plain, t)


def terms(text: str) -> set[str]:
    """Whole words (marked by a blank at the end) and word beginnings of a folded text."""
    found = set()
    for w in set(_WORD.findall(text)):
        if len(w) >= 3:
            found.add(w + " ")
        found.update(w[:n] for n in PREFIXES if len(w) >= n)
    return found


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    intercept: float = -3.0
    slope: float = 4.0

    def probability(self, x: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.intercept + self.slope * x))))


class Matcher:
    """The automaton over terms and exception phrases."""

    def __init__(self, model: Model) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        found: dict[str, list] = {}
        for term, weight in model.weights.items():
            found.setdefault(term.rstrip(" "), [0.0, 0.0, False])[0 if term.endswith(" ") else 1] = weight
        for phrase in model.exceptions:
            found.setdefault(phrase, [0.0, 0.0, False])[2] = True
        for k, (whole, start, harmless) in found.items():
            self.automaton.add_word(k, (len(k), whole, start, harmless))
        self.filled = bool(found)
        if self.filled:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[float]:
        """The weight of the heaviest term at each place where one starts."""
        best, harmless = {}, []
        for end, (n, whole, start, phrase) in self.automaton.iter(text) if self.filled else ():
            at = end - n + 1
            if at and text[at - 1].isalpha():
                continue
            closed = end + 1 == len(text) or not text[end + 1].isalpha()
            if phrase and closed:
                harmless.append((at, end))
            weight = max(start, whole if closed else 0.0)
            if weight > best.get(at, 0.0):
                best[at] = weight
        return [w for at, w in best.items() if not any(a <= at <= b for a, b in harmless)]

    def measure(self, text: str) -> tuple[float, int]:
        """Sum of weights over a length that grows slowly with the words, and the number of hits."""
        found = self.hits(fold(text))
        length = 1 + math.log1p(text.count(" ") / 1000)
        return math.log1p(sum(found) / length), len(found)


def held_out(id_col: Column) -> Column:
    """Rows that never teach: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 200):
            pos, neg = Counter(), Counter()
            part = batch.slice(i, 200)
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                (pos if toxic else neg).update(terms(fold(text or "")))
            names = list(pos.keys() | neg.keys())
            yield pa.RecordBatch.from_arrays([
                pa.array(names, pa.string()), pa.array([pos[w] for w in names], pa.int64()),
                pa.array([neg[w] for w in names], pa.int64())], names=["term", "pos", "neg"])


def _measured(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            found = [matcher.measure(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([x for x, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64()),
                batch.column(1)], names=["x", "n_hits", "keep"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          limit: int = MAX_LABELLED) -> Model:
    """The lexicon and the curve for labels (id, toxic); rows held out are never read."""
    known = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col("toxic")).where("id is not null and toxic is not null")
             .where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("id"), "id").limit(limit))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = written(texts.join(F.broadcast(known), "id").groupBy("id", "text").agg(F.max("toxic").alias("toxic"))
                   .select("text", (F.col("toxic") > 0).alias("y")), "toxic-rows")
    size = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = size.get(True, 0), size.get(False, 0)
    weights = {f"{w} ": SEED_WEIGHT for w in SEEDS}
    if not n_pos or not n_neg:
        return Model(weights)
    counts = (rows.mapInArrow(_term_counts, "term string, pos bigint, neg bigint").groupBy("term")
              .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") >= MIN_SUPPORT))
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1.0)) - F.log((F.col("neg") + 0.5) / (n_neg + 1.0))
    # A term stands in MIN_SUPPORT rows of the bounded sample, so there are no more of them than the sample's terms.
    learned = counts.withColumn("w", odds).where(F.col("w") >= MIN_WEIGHT).orderBy("term").collect()
    weights |= {r["term"]: r["w"] for r in learned}
    model = Model(weights)
    sample = rows.select("text", F.col("y").cast("bigint")).mapInArrow(
        _measured(model), "x double, n_hits bigint, keep bigint").groupBy("x", "keep").agg(
        F.count(F.lit(1)).alias("n")).toPandas().sort_values(["x", "keep"])
    a, b = _logistic(*(sample[c].to_numpy() for c in ("x", "keep", "n")))
    return Model(weights, intercept=a, slope=b)


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.02, steps: int = 50) -> tuple[float, float]:
    """Newton's method for one feature, each row counted ``n`` times; the ridge keeps it finite when a cut parts the labels."""
    design, beta = np.array([np.ones_like(x), x]).T, np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        w = n * np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((design * w[:, None]).T @ design + ridge * np.diag([0.01, 1]),
                               design.T @ (n * (y - p)) - ridge * np.array([0.01, 1]) * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            found = [matcher.measure(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([model.probability(x) for x, _ in found], pa.float64()),
                pa.array([n for _, n in found], pa.int64())], names=["row", "score", "n_hits"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows with score, ``predicted`` and the number of hits; no shuffle."""
    rows = carried(docs).select("row", F.col(f"row.`{text_col}`").alias("text"))
    kept = F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != text_col])
    done = rows.select(kept.alias("row"), "text")
    schema = T.StructType([done.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("n_hits", T.LongType())])
    found = done.mapInArrow(_scored(model), schema)
    return released(found, score=F.col("score"), predicted=(F.col("score") >= threshold).cast("int"),
                    n_hits=F.col("n_hits"))
