"""A small labelled table of urls, made by rule: invented hosts of unwanted themes and of ordinary sites.

Words are combined in pairs, so both kinds have hyphens, subdomains and the same endings and paths; what
tells them apart is what the words say. Hosts of syllables stand for words that the table does not know. Rows are split by host for a held-out test.
"""

from __future__ import annotations

import zlib
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import urls

# Words of hosts that a crawl leaves out, and words of ordinary sites.
UNWANTED = ("cheap", "pills", "meds", "pharmacy", "casino", "bets", "slots", "poker", "jackpot", "win", "loans", "payday", "cash",
            "forex", "ads", "track", "click", "popup", "spam", "links", "farm", "adult", "xxx", "crack", "warez", "bonus", "prize", "free")
ORDINARY = ("city", "library", "museum", "garden", "weather", "history", "school", "recipe", "travel", "music", "science", "health",
            "sport", "village", "theatre", "railway", "forest", "physics", "cooking", "chess", "river", "church", "market", "harbour",
            "nature", "paper", "language", "bridge")
SYLLABLES = ("ba", "ko", "li", "mer", "ta", "nor", "vi", "sel", "dun", "ra", "pel", "os")
DOMAINS, SUBDOMAINS = ("test.com", "test.org", "test.net", "sample.org"), ("", "www.", "m.", "blog.")
PATHS = ("/en/12", "/de/7.html", "/fr/301/", "/es/5?page=2", "/articles/44#top", "/")


def _url(name: str) -> str:
    """A url of the name's host; subdomain, ending and path are drawn by a hash, alike for both kinds."""
    h = zlib.crc32(name.encode())
    return f"http{'s' * ((h >> 4) % 2)}://{SUBDOMAINS[h % 4]}{name}.{DOMAINS[(h >> 2) % 4]}{PATHS[(h >> 6) % len(PATHS)]}"


def rows() -> list[tuple[str, int]]:
    """Some nine hundred urls of as many hosts, with 1 for unwanted ones."""
    unwanted = [f"{a}-{b}" for a, b in combinations(UNWANTED, 2)]
    ordinary = [f"{a}-{b}" for a, b in combinations(ORDINARY, 2)] + list(ORDINARY) + [f"{a}{b}" for a, b in permutations(SYLLABLES, 2)]
    return [(_url(n), 1) for n in unwanted] + [(_url(n), 0) for n in ordinary]


def table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), "url string, blocked int")


def held_out(url: Column) -> Column:
    """A quarter of the hosts, whole."""
    return F.crc32(urls.host(url).cast("binary")) % 4 == 0
