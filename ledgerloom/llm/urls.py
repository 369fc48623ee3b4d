"""URL filter: rules on host and path, and a logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Verdict, host and path of the rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# The labelled URLs that the regression learns from.
BLOCKED = (
    "http://cheap-pills.example.com/en/1",
    "https://www.cheap-pills.example.net/buy?ref=x",
    "http://pills-online.example.com/order-cheap-viagra",
    "http://best-pharma-deals.example.net/no-prescription/pills",
    "http://casino-win.example.com/en/9",
    "https://m.casino-win.example.net/fr/30",
    "http://royal-casino.example.com/slots/jackpot",
    "http://online-casino-bonus.example.net/free-spins",
    "http://free-bets.example.com/en/12",
    "https://www.free-bets.example.net/sports-betting",
    "http://bet-today.example.com/odds/free-bet",
    "http://poker-bets.example.net/win-money",
    "http://ads-track.example.com/click?id=5",
    "https://m.ads-track.example.net/en/7",
    "http://track.ads-server.example.com/pixel/banner-ads",
    "http://click-ads.example.net/redirect?utm_source=ads",
    "http://spam-farm.example.com/en/3",
    "https://blog.spam-farm.example.net/links",
    "http://link-farm.example.com/seo-spam",
    "http://adult-xxx.example.com/porn-videos",
    "http://hot-xxx-cams.example.net/adult",
    "http://free-download-crack.example.com/keygen",
    "http://win-iphone-prize.example.net/claim-free-prize",
    "http://payday-loans-fast.example.com/cheap-loan",
)
ALLOWED = (
    "https://www.thenews.example.com/en/853/",
    "http://blog.theriver.example.net/en/369#top",
    "https://m.thornton.example.net/en/25",
    "https://tiontech.example.com/en/148.html",
    "https://hering.example.net/es/797",
    "http://www.weather.example.com/es/65.html",
    "https://library.example.net/fr/catalogue/12",
    "https://docs.python.example.net/en/3/tutorial.html",
    "https://www.university.example.com/en/research/paper",
    "http://blog.thandor.example.com/en/960",
    "https://wiki.encyclopedia.example.net/en/History",
    "https://recipes.kitchen.example.com/en/bread",
    "http://m.garden.example.com/es/74/",
    "https://www.museum.example.net/de/671?utm_source=feed",
    "https://blog.travel.example.net/de/612?page=2&ref=x",
    "http://therha.example.com/en/676",
    "https://ththin.example.com/en/671",
    "https://m.theron.example.net/en/777",
    "http://www.ththen.example.net/fr/825",
    "https://forum.music.example.com/en/450",
    "https://parliament.example.net/en/debates/2020",
    "http://onthes.example.net/en/728",
    "https://school.example.com/es/533/",
    "https://www.theater.example.net/fr/474.html",
)

GRAM_SIZES = (3, 4, 5)
BUCKETS = 4096
ROUNDS, RATE, DECAY = 400, 0.5, 1e-3


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; NULL if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def buckets_of(host: Column, path: Column) -> Column:
    """Hashed character n-grams of host and path, each once; the ends of both are marked."""

    def grams(part: str, value: Column, n: int) -> Column:
        marked = F.concat(F.lit("<"), value, F.lit(">"))
        places = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.length(marked) - (n - 1)))
        hashed = lambda at: F.pmod(F.xxhash64(F.lit(part), F.substring(marked, at, F.lit(n))), F.lit(BUCKETS)).cast("int")
        return F.transform(F.coalesce(places, F.array().cast("array<int>")), hashed)

    found = [grams(part, value, n) for part, value in (("host", host), ("path", path)) for n in GRAM_SIZES]
    return F.array_distinct(F.concat(*found))


def learn(spark: SparkSession, blocked=BLOCKED, allowed=ALLOWED) -> tuple[list[float], float]:
    """Weight of each bucket and the bias, by gradient steps over the small labelled table."""
    table = spark.createDataFrame([(u, 1) for u in blocked] + [(u, 0) for u in allowed], "url string, block int")
    rows = table.select("block", buckets_of(host_of(F.col("url")), path_of(F.col("url"))).alias("b")).collect()
    weights, bias = [0.0] * BUCKETS, 0.0
    for _ in range(ROUNDS):
        for row in rows:
            scale = 1 / math.sqrt(max(1, len(row["b"])))
            z = bias + scale * sum(weights[i] for i in row["b"])
            error = row["block"] - 1 / (1 + math.exp(-z))
            bias += RATE * 0.1 * error
            for i in row["b"]:
                weights[i] += RATE * (error * scale - DECAY * weights[i])
    return weights, bias


def judge(pages: DataFrame, rules=RULES, blocked=BLOCKED, allowed=ALLOWED) -> DataFrame:
    """page_id, host, path, rule, verdict and the regression's block probability (score) of every row.

    A NULL url, or one without ``://``, has an empty host and path and is judged by the regression like any other.
    An empty path fits no rule that has one. Repeated rows are judged alike; other columns are ignored.
    """
    spark = settle(pages.sparkSession)
    weights, bias = learn(spark, blocked, allowed)
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, ruled = rule_of(F.col("host"), F.col("path"), rules)
    parts = parts.withColumn("found", buckets_of(F.col("host"), F.col("path")))
    table = F.array(*(F.lit(w) for w in weights))
    total = F.aggregate("found", F.lit(0.0), lambda z, i: z + F.element_at(table, i + 1))
    z = total / F.sqrt(F.greatest(F.size("found"), F.lit(1))) + F.lit(bias)
    scored = parts.withColumn("score", 1 / (1 + F.exp(-z)))
    method = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", name.alias("rule"), F.coalesce(ruled, method).alias("verdict"), "score")
