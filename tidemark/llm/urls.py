"""URL filters: rules for hosts and paths, and a logistic regression for the rest.

The regression sees hashed character n-grams of host and path. It is trained by Spark's own
DataFrame library on a small labelled table (at most ``MAX_LABELLED`` rows, those with the
smallest hash of the url) and applied as column expressions, without Python on the executors.

Defined cases: a url that is null or has no ``://`` has an empty host and path, no rule, and
the verdict of the method for empty texts; repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import ascii_lower, carried, released

MAX_LABELLED = 10_000
N_FEATURES = 1 << 14
GRAMS = (3, 4)


@dataclass(frozen=True)
class Rule:
    """``host/path-prefix``; fits the host and all its subdomains."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def _rest(url: Column) -> Column:
    found = F.instr(url, "://")
    return F.when(found > 0, F.call_function("substr", url, found + 3)).otherwise("")


def host(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    return ascii_lower(F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def matching_rule(rules: list[Rule], h: Column, p: Column) -> Column:
    """The longest rule that fits, or null; of equally long ones the first in the alphabet.

    A rule list is a configuration, and becomes one expression."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):  # the last that fits wins
        fits = ((h == r.host) | F.endswith(h, F.lit("." + r.host))) & F.startswith(p, F.lit(r.path))
        found = F.when(fits, r.text).otherwise(found)
    return found


def grams(h: Column, p: Column) -> Column:
    """The character n-grams of host and path, marked by where they stand."""
    def of(mark: str, s: Column) -> Column:
        whole = F.concat(F.lit("^"), s, F.lit("$"))
        parts = [F.when(F.length(whole) >= n, F.transform(
            F.sequence(F.lit(1), F.length(whole) - (n - 1)),
            lambda i, n=n: F.concat(F.lit(mark), F.call_function("substr", whole, i, F.lit(n)))))
            .otherwise(F.array().cast("array<string>")) for n in GRAMS]
        return F.concat(*parts)

    return F.concat(of("h", h), of("p", p))


def _vectors(df: DataFrame, url_col: str) -> DataFrame:
    g = df.withColumn("_grams", grams(host(F.col(url_col)), path(F.col(url_col))))
    return HashingTF(numFeatures=N_FEATURES, inputCol="_grams", outputCol="_x", binary=True).transform(g)


def train(labelled: DataFrame):
    """The regression for a table (url, blocked); null urls and labels are left out."""
    few = (labelled.where(F.col("url").isNotNull() & F.col("blocked").isNotNull())
           .orderBy(F.xxhash64("url"), "url").limit(MAX_LABELLED).coalesce(1))
    data = _vectors(few, "url").select("_x", F.col("blocked").cast("double").alias("_y"))
    return LogisticRegression(featuresCol="_x", labelCol="_y", probabilityCol="_p", rawPredictionCol="_r",
                              predictionCol="_v", regParam=0.01, maxIter=50).fit(data)


def judge(pages: DataFrame, rules: list[Rule], model, url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """The rows with host, path, rule, ``p_block`` and verdict."""
    url = F.col(f"row.`{url_col}`")
    rows = carried(pages).withColumn("_url", url)
    rows = rows.withColumns({"_host": host(F.col("_url")), "_path": path(F.col("_url"))})
    scored = model.transform(_vectors(rows, "_url")).withColumn("_block", vector_to_array("_p")[1])
    rule = matching_rule(rules, F.col("_host"), F.col("_path"))
    by_rule = F.lit(None).cast("string")
    for r in rules:
        by_rule = F.when(F.col("_rule") == r.text, r.verdict).otherwise(by_rule)
    scored = scored.withColumn("_rule", rule)
    verdict = F.coalesce(by_rule, F.when(F.col("_block") > threshold, "block").otherwise("allow"))
    return released(scored, host=F.col("_host"), path=F.col("_path"), rule=F.col("_rule"), verdict=verdict,
                    p_block=F.col("_block"))
