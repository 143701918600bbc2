"""URL verdicts: host and path rules first, then logistic regression on hashed character n-grams.

Everything here is a DataFrame or SQL expression; the model is trained by one
fold over a small labelled table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the contract: verdict and rule, as host suffix and path prefix.
RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]

#: The labelled URLs that the model is trained on by default: 1 is to be blocked.
LABELLED = [
    ("https://adult-x.test/en/1", 1),
    ("http://www.adult-videos.test/watch/12.html", 1),
    ("https://adult-chat.test/room?id=4", 1),
    ("https://m.xxx-tube.test/clip/77", 1),
    ("https://sex-cams.test/live/3", 1),
    ("http://hot-porn.test/en/18", 1),
    ("https://casino-win.test/en/22", 1),
    ("https://www.casino-royal.test/slots/5.html", 1),
    ("http://best-casino.test/bonus?ref=1", 1),
    ("https://poker-win.test/table/9", 1),
    ("https://free-bets.test/en/5", 1),
    ("http://m.free-bets-now.test/odds", 1),
    ("https://sports-bets.test/live/44", 1),
    ("https://win-big-slots.test/spin", 1),
    ("http://cheap-pills.test/buy/1", 1),
    ("https://pills-online.test/order?x=2", 1),
    ("http://free-crack-keys.test/download", 1),
    ("https://warez-free.test/get/8", 1),
    ("https://lottery-win.test/claim", 1),
    ("http://spam-offers.test/click?utm_source=mail", 1),
    ("https://www.weather-report.test/en/1", 0),
    ("https://blog.garden-notes.test/2020/05/soil.html", 0),
    ("http://news.city-press.test/de/politik/44", 0),
    ("https://docs.library.test/en/reference/api.html", 0),
    ("https://m.recipes.test/fr/soupe?page=2", 0),
    ("http://www.university.test/courses/12", 0),
    ("https://blog.travels.test/es/viajes/7", 0),
    ("https://history-archive.test/en/1890", 0),
    ("http://science.journal.test/article/33.html", 0),
    ("https://www.museum.test/de/ausstellung", 0),
    ("https://health.clinic.test/en/advice?utm_source=feed", 0),
    ("http://blog.astronomy.test/stars/9", 0),
    ("https://m.railway.test/fr/horaires", 0),
    ("https://law.court.test/en/rulings/120", 0),
    ("http://www.school.test/teachers#top", 0),
    ("https://theatre.test/en/30/", 0),
    ("https://blog.northern.test/fr/157", 0),
    ("http://water.test/es/4208#top", 0),
    ("https://www.nation.test/en/269.html", 0),
    ("https://other-things.test/page/61", 0),
]

BUCKETS = 2048
SIZES = (3, 4)
ROUNDS = 40
RATE = 0.5
DECAY = 0.001
#: Most rows that the labelled table may have.
MAX_LABELLED = 2000


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where the URL is null or has no ``://``."""
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits.

    A rule fits its host and all subdomains where the path begins with the
    rule's. Of rules of one length the alphabetically first wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def features(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Buckets (1 to ``buckets``) of the distinct n-grams of host and of path, each with its own marks."""
    def grams(tag: str, value: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(value) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(tag), F.substring(value, i, F.lit(n))), F.lit(buckets)).cast("int") + 1)

    framed = {"h": F.concat(F.lit("^"), host, F.lit("$")), "p": F.concat(F.lit("^"), path, F.lit("$"))}
    parts = [grams(tag, value, n) for tag, value in framed.items() for n in SIZES]
    return F.array_distinct(F.concat(*parts))


def logit(grams: Column, weights: Column) -> Column:
    """Score before the sigmoid: the mean weight of the n-grams times their root, and the bias (the last weight)."""
    total = F.aggregate(grams, F.lit(0.0), lambda s, g: s + F.element_at(weights, g))
    return total / F.sqrt(F.greatest(F.size(grams), F.lit(1))) + F.element_at(weights, -1)


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label", buckets: int = BUCKETS, rounds: int = ROUNDS) -> list[float]:
    """Weights and bias by stochastic gradient descent over a small labelled table.

    The table has at most ``MAX_LABELLED`` rows (else an error); rows with a
    null in either column are passed over. The descent is one fold over the
    rows, in URL order, ``rounds`` times.
    """
    rows = labelled.select(F.col(url_col).alias("_url"), F.col(label_col).cast("double").alias("_y")).dropna()
    if rows.limit(MAX_LABELLED + 1).count() > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled rows")
    host, path = split_url(F.col("_url"))
    example = F.struct(F.xxhash64("_url").alias("k"), F.col("_y").alias("y"), features(host, path, buckets).alias("g"))
    one = rows.agg(F.sort_array(F.collect_list(example)).alias("ex"))
    start = F.array_repeat(F.lit(0.0), buckets + 1)

    def step(w: Column, ex: Column) -> Column:
        error = ex["y"] - 1 / (1 + F.exp(-logit(ex["g"], w)))
        pull = F.lit(RATE) * error / F.sqrt(F.greatest(F.size(ex["g"]), F.lit(1)))
        # The error is computed once for a step: it travels as a one-element array.
        return F.element_at(
            F.transform(
                F.array(F.struct(pull.alias("g"), (F.lit(RATE) * error).alias("b"))),
                lambda d: F.transform(w, lambda x, i: F.when(i == buckets, x + d["b"]).when(F.array_contains(ex["g"], (i + 1).cast("int")), x * (1 - DECAY) + d["g"]).otherwise(x)),
            ),
            1,
        )

    passes = F.flatten(F.array_repeat(F.col("ex"), rounds))
    row = one.select(F.aggregate(passes, start, step).alias("w")).first()
    return list(row["w"])


def default_labels(spark: SparkSession) -> DataFrame:
    return spark.sql("select * from values " + ", ".join(f"('{u}', {y})" for u, y in LABELLED) + " as t(url, label)")


def judge(pages: DataFrame, weights: list[float], url_col: str = "url", rules: list[tuple[str, str]] = RULES, threshold: float = 0.5) -> DataFrame:
    """Add host, path, rule, probability (of block) and verdict to every row; map-only.

    The longest fitting rule decides; without one the model does. A null URL or
    one without ``://`` has empty host and path and the model's verdict on
    them. Input columns named like a result are replaced (the URL must not be).
    """
    names = ["host", "path", "rule", "probability", "verdict"]
    if url_col in names:
        raise ValueError(f"the URL column is named as a result: {url_col}")
    host, path = split_url(F.col(url_col))
    rest = pages.drop(*names)
    parted = rest.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    probability = 1 / (1 + F.exp(-logit(features(F.col("host"), F.col("path"), len(weights) - 1), table)))
    scored = parted.withColumn("rule", rule).withColumn("probability", probability)
    model = F.when(F.col("probability") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("verdict", F.coalesce(verdict, model))
