"""URL filter: host and path rules, and for the rest a logistic regression on hashed
character n-grams of host and path. DataFrame operations only.

The model is fitted on a small labelled URL table by full-batch gradient descent in its
dual form: weights stay a sum of the training rows' features, so a step updates one
coefficient per row from the rows' inner products, inside one SQL expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, let

#: Buckets of the hashed n-grams, and their length.
BUCKETS, GRAM = 2048, 3
#: Most rows of the labelled table; the fit's cost grows with their square.
LABELLED = 500
#: Rules of the query: verdict and rule (host, then path).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
# The labelled table is made by a rule: each site with some of the paths of its side, in turn. Sites and paths are ours, and typical of what they stand for.
UNWANTED = (
    "best-casino-bonus.com|luckyslots777.net|bet365-odds.info|pokerjackpot.online|free-spins.bet|sexycams.live|hotgirls-xxx.com|adult-dating.club|porntube-hd.net|escorts-city.com|"
    "cheap-viagra-pills.com|pharmacy-no-rx.biz|buy-cialis-online.shop|weight-loss-miracle.site|replica-watches.store|discount-handbags.top|cracked-software.ws|keygen-serials.org|torrent-movies.to|warez-full.download|"
    "payday-loan-fast.com|crypto-profit-bot.io|forex-signals-vip.net|get-rich-quick.biz|win-iphone-prize.club|free-gift-card.win|click-track-ads.com|popup-banner.xyz|seo-backlinks.pro|cheap-followers.shop|coupon-deals-4u.com|download-mp3-free.cc"
).split("|")
UNWANTED_PATHS = "/slots/free-spins|/casino/bonus|/live/xxx|/videos/porn/1|/buy/viagra-online|/claim-prize|/crack/keygen.exe|/torrent/full-hd|/payday/apply-now|/ads/click|/promo/discount-code|/poker/jackpot|/girls/cam|/loan/instant|/free-download|/win".split("|")
ORDINARY = (
    "en.wikipedia.org|de.wikipedia.org|fr.wikipedia.org|www.bbc.co.uk|www.theguardian.com|www.nytimes.com|www.lemonde.fr|www.spiegel.de|elpais.com|news.ycombinator.com|stackoverflow.com|github.com|docs.python.org|developer.mozilla.org|www.w3.org|"
    "arxiv.org|www.nature.com|pubmed.ncbi.nlm.nih.gov|www.nasa.gov|www.cdc.gov|www.gov.uk|europa.eu|www.un.org|www.who.int|www.mit.edu|www.ox.ac.uk|library.stanford.edu|www.gutenberg.org|www.britannica.com|plato.stanford.edu|"
    "www.allrecipes.com|www.imdb.com|www.goodreads.com|www.nationalgeographic.com|weather.com|www.timeanddate.com|www.reuters.com|apnews.com|medium.com|blog.example.com|forum.example.org|shop.example.net|www.amazon.com|www.ikea.com|www.booking.com|"
    "kubernetes.io|spark.apache.org|www.postgresql.org|www.kernel.org|rust-lang.org|www.khanacademy.org|www.coursera.org|www.museum.de|www.bahn.de|www.tagesschau.de|www.rae.es|www.service-public.fr|m.example.com|www.example.com|mail.example.org"
).split("|")
ORDINARY_PATHS = "/|/wiki/Water|/news/world|/en/about.html|/de/15751.html|/questions/4821/how-to|/docs/guide/introduction|/2024/05/article-22.html|/science/physics|/recipes/bread|/product/1042|/blog/post-7|/library/catalogue|/fr/actualites|/es/noticias/9|/health/conditions|/travel/paris|/education/lessons/math|/en/10250.html|/papers/1706.pdf|/forum/thread/3312|/contact|/sports/football|/history/europe|/category/books|/en/forecast".split("|")


def _paired(sites: list[str], paths: list[str], each: int, label: int) -> list[tuple[str, int]]:
    return [(f"https://{site}{paths[(each * i + j) % len(paths)]}", label) for i, site in enumerate(sites) for j in range(each)]


SEEDS = (*_paired(UNWANTED, UNWANTED_PATHS, 4, 1), *_paired(ORDINARY, ORDINARY_PATHS, 4, 0))


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    url, form = F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(url, form, 1)), F.regexp_extract(url, form, 2)


def rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits. Of one rule given twice the first counts."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    listed = sorted(dict((r, v) for v, r in reversed(list(rules))).items(), key=lambda x: (len(x[0]), x[0]))
    for text, says in listed:
        at, _, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        name, verdict = F.when(fits, F.lit(text)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def grams(host: Column, path: Column) -> Column:
    """Distinct buckets of the character n-grams of host and path, each in its own hash space."""

    def of(text: Column, seed: str) -> Column:
        chars = F.concat(F.array(F.lit("^")), F.filter(F.split(text, ""), lambda c: c != ""), F.array(F.lit("$")))
        each = lambda a: F.transform(F.sequence(F.lit(1), F.greatest(F.size(a) - (GRAM - 1), F.lit(1))), lambda i: F.pmod(F.xxhash64(F.lit(seed), *[F.try_element_at(a, i + j) for j in range(GRAM)]), F.lit(BUCKETS)).cast("int"))
        return let(chars, each)

    return F.array_distinct(F.concat(of(host, "host"), of(path, "path")))


def fit(labelled: DataFrame, steps: int = 150, rate: float = 1.0, decay: float = 1e-3) -> list[float]:
    """Weights of BUCKETS features and, last, the bias, from ``labelled`` (url, label 1 to block).

    Null urls and labels are skipped; more than LABELLED rows are refused. No rows: all weights are 0.
    """
    host, path = parts(F.col("url"))
    rows = labelled.where("url is not null and label in (0, 1)").select(grams(host, path).alias("x"), F.col("label").cast("double").alias("y")).limit(LABELLED + 1)
    one = rows.agg(F.array_sort(F.collect_list(F.struct("x", "y"))).alias("rows"))
    if (n := one.select(F.size("rows")).first()[0]) > LABELLED:
        raise ValueError(f"more than {LABELLED} labelled rows")
    if not n:
        return [0.0] * (BUCKETS + 1)
    # Features are 1/sqrt of their number each; the bias is a feature of weight 1.
    inner = lambda a, b: F.size(F.array_intersect(a["x"], b["x"])) / F.sqrt(F.size(a["x"]) * F.size(b["x"])) + 1.0
    kernel = one.withColumn("k", F.transform("rows", lambda a: F.transform("rows", lambda b: inner(a, b)))).cache()

    def step(alpha: Column) -> Column:
        z = lambda i: F.aggregate(F.zip_with(alpha, F.element_at("k", i + 1), lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
        return F.transform(alpha, lambda a, i: a * (1 - rate * decay) - rate * (1 / (1 + F.exp(-z(i))) - F.element_at("rows", i + 1)["y"]) / n)

    alpha = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.transform("rows", lambda r: F.lit(0.0)), lambda a, _: step(a))
    found = kernel.select(F.explode(F.arrays_zip("rows", alpha.alias("a"))).alias("r")).select(F.col("r.rows.x").alias("x"), F.col("r.a").alias("a"))
    sums = found.select(F.explode("x").alias("b"), (F.col("a") / F.sqrt(F.size("x"))).alias("w")).groupBy("b").agg(F.sum("w").alias("w"))
    weights = [0.0] * BUCKETS
    for row in sums.collect():  # at most BUCKETS rows
        weights[row["b"]] = row["w"]
    bias = found.agg(F.sum("a")).first()[0]
    kernel.unpersist()
    return [*weights, bias]


def judge(spark: SparkSession, pages: DataFrame, weights: list[float], rules=RULES, block_at: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and score (probability to block) of every row of ``pages`` (page_id, url).

    Null urls have empty host and path, which the method still scores. Repeated rows are judged each.
    The weights are a constant of fixed size in the plan; there is no shuffle.
    """
    host, path = parts(F.col("url"))
    table = F.split(F.lit(" ".join(map(repr, weights[:-1]))), " ").cast("array<double>")
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    margin = let(grams(F.col("host"), F.col("path")), lambda g: F.aggregate(g, F.lit(0.0), lambda s, b: s + F.element_at(table, b + 1)) / F.sqrt(F.size(g)) + F.lit(weights[-1]))
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("score", F.round(1 / (1 + F.exp(-margin)), 6))
    return rows.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(F.col("score") >= block_at, "block").otherwise("allow")).alias("verdict"), "score")


def seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SEEDS), "url string, label int")
