"""Quality rules by host, in DataFrame functions only.

Every document is held against rules; failures are added up by host and the failure rate of
each host and rule is shrunk towards the others by a beta prior whose parameters come from
the moments of all hosts' rates. A host whose shrunk rate lies far beyond the prior's mean, that is
beyond what hosts of this collection are like, is rejected with all its documents. Features are computed once and written to the shared folder;
hosts are aggregated partially before the shuffle, so a host with a third of all rows sends
one row per task.

Defined cases: a null text has no words; documents without a host form a host of their own;
repeated rows count as often as they occur. Repeated word windows are sorted by a hash and,
where hashes are equal, by their words, so counts are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import SPACE, carried, let, released
from tidemark.sources.scratch import written

WORD_BREAK = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# A host fails a rule when its shrunk rate of failures passes so many times the prior's mean; the limit lies in these bounds.
MULTIPLE, LIMITS = 4.0, (0.35, 0.6)


def words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK))


def repeated_words(tokens: Column) -> Column:
    """How many words stand in a window of three words that the text has more than once.

    Windows are sorted as a hash, the three words and the position, so equal ones meet; words are
    compared only where hashes are equal, and work and memory follow the words.
    """
    windows = let(tokens, lambda w: F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
        F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), w[i].alias("a"), w[i + 1].alias("b"), w[i + 2].alias("c"),
        i.cast("bigint").alias("i")))))

    def again(p):
        same = lambda x, y: F.coalesce(
            (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))
        hits = F.filter(p, lambda x, i: same(x, F.get(p, i - 1)) | same(x, F.get(p, i + 1)))
        return F.sort_array(F.transform(hits, lambda x: x["i"]))

    def covered(q):
        steps = F.when(F.size(q) > 1, F.aggregate(
            F.sequence(F.lit(1), F.size(q) - 1), F.lit(0).cast("bigint"),
            lambda total, j: total + F.least(F.lit(3).cast("bigint"), q[j] - q[j - 1]))).otherwise(F.lit(0))
        return F.when(F.size(q) == 0, F.lit(0)).otherwise(steps + 3)

    return F.when(F.size(tokens) < 4, F.lit(0)).otherwise(let(let(windows, again), covered)).cast("bigint")


def features(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``row``, ``host`` and the five counts of every document."""
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    return (carried(docs)
            .withColumns({"host": F.col(f"row.`{host_col}`"), "w": words(F.col(f"row.`{text_col}`"))})
            .withColumns({
                "n_words": F.size("w").cast("bigint"),
                "word_chars": F.length(F.translate(text, SPACE, "")).cast("bigint"),
                "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
                "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
                "n_repeat_words": repeated_words(F.col("w"))})
            .drop("w"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def failures() -> dict[str, Column]:
    """The rules whose rates hosts are judged by."""
    return {"short": F.col("n_words") < 50,
            "repeats": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
            "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
            "lines": F.col("n_dup_lines") >= 10}


def host_verdicts(facts: DataFrame, multiple: float = MULTIPLE, limits: tuple[float, float] = LIMITS) -> DataFrame:
    """One row per host: documents, shrunk rate per rule, and whether a rate passes its limit.

    The limit is ``multiple`` times the mean of the rule's prior, within ``limits``.

    The beta prior of a rule has the mean m of the hosts' rates and the strength
    m(1-m)/v - 1, v being the variance of the rates beyond what counting alone explains;
    without such variance the strength is that of all documents together.
    """
    rules = failures()
    hosts = facts.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c.cast("bigint")).alias(f"f_{k}") for k, c in rules.items()])
    m = hosts.agg(
        F.sum("n").alias("total"), F.avg(1 / F.col("n")).alias("inv"),
        *[F.avg(F.col(f"f_{k}") / F.col("n")).alias(f"m_{k}") for k in rules],
        *[F.var_pop(F.col(f"f_{k}") / F.col("n")).alias(f"v_{k}") for k in rules]).first()  # one row of moments

    def rate(k: str) -> Column:
        mean, spread = m[f"m_{k}"] or 0.0, (m[f"m_{k}"] or 0.0) * (1 - (m[f"m_{k}"] or 0.0))
        extra = (m[f"v_{k}"] or 0.0) - spread * (m["inv"] or 0.0)
        strength = max(0.0, spread / extra - 1) if extra > 0 else float(m["total"] or 0)
        return (F.col(f"f_{k}") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))

    judged = hosts.withColumns({f"rate_{k}": rate(k) for k in rules})
    bad = F.lit(False)
    for k in rules:
        bad = bad | (F.col(f"rate_{k}") > min(limits[1], max(limits[0], multiple * (m[f"m_{k}"] or 0.0))))
    return judged.select("host", "n", *[f"rate_{k}" for k in rules], bad.alias("host_failed"))


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source",
          carry: list[str] | None = None, multiple: float = MULTIPLE, limits: tuple[float, float] = LIMITS) -> DataFrame:
    """The rows (only the columns ``carry``, if named) with their counts, ``base_failed`` and ``kept``."""
    facts = features(docs, text_col, host_col)
    if carry is not None:
        facts = facts.withColumn("row", F.struct(*[F.col(f"row.`{c}`").alias(c) for c in carry]))
    facts = written(facts.withColumn("base_failed", base_failed()), "host-rules")
    # Written, so that the join shuffles both sides itself, unless small, and can split a host with very many rows.
    bad = written(host_verdicts(facts, multiple, limits).where("host_failed").select(F.col("host").alias("bad_host"), "host_failed"), "bad-hosts")
    joined = facts.join(bad, F.col("host").eqNullSafe(F.col("bad_host")), "left")
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("host_failed"), F.lit(False))
    return released(joined, **{k: F.col(k) for k in (*FEATURES, "base_failed")}, kept=kept)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows that pass, as they were."""
    return judge(docs, **options).where("kept").select(*[F.col(f"`{c}`") for c in docs.columns])
