"""URL filter: rules first, then a ratio of two character language models.

URLs that a rule decides are the labelled ones. One Markov model is trained on the allowed, one on
the blocked: contexts of three characters down to none, each smoothed by the next shorter one
(Witten-Bell: a context with N symbols, d of them distinct, gives d/(N+d) to the shorter context).
A URL's score is the mean over its characters of log P(allowed) - log P(blocked). The threshold is
calibrated on labelled URLs that were not trained on: it has the least sum of both error rates.

All of it is DataFrame work. Every distinct URL counts once; counts are kept per distinct string
of four characters, so no key of the model joins is hot, and hot URLs meet one row each. Character
rows carry a key of 16 bytes in place of the URL, so they grow with a URL's length, not its square.

Defined results: a null URL, or one without ``://``, has an empty host and path; scores of an empty
URL are 0; with no allowed or no blocked URLs to calibrate on all others are allowed; a score equal to the threshold
is allowed; repeated rows are judged each; URLs of any length are read whole; an empty table gives
no rows; other columns are ignored.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.tables import stored

#: (host, path, verdict); a longer rule (host and path together) wins over a shorter one.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
ALLOW, BLOCK = "allow", "block"

ORDER = 3
ALPHABET = 65_536
#: Characters of a URL that are cut into strings together: finding a place costs its distance.
CHUNK = 256
#: A labelled URL in so many is kept for the calibration.
CALIBRATION_SHARE = 5
#: Threshold steps per nat, and the largest score of the calibration table.
STEPS, LARGEST = 100, 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL column."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) for columns host and path; null where no rule fits."""
    name = verdict = F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        name, verdict = F.when(fits, host + path).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def url_key(url: str = "url") -> Column:
    """16 bytes that stand for a URL."""
    return F.unhex(F.md5(F.col(url).cast("binary")))


def url_grams(urls: DataFrame) -> DataFrame:
    """One row per character of each URL: the character behind its three predecessors.

    Columns besides url are kept.
    """
    padded = F.concat(F.lit("\x02" * ORDER), "url")
    starts = F.explode(F.sequence(F.lit(1), F.length("url"), F.lit(CHUNK)))
    kept = [c for c in urls.columns if c != "url"]
    chunks = urls.where(F.length("url") > 0).select("*", starts.alias("start"), padded.alias("padded"))
    chunks = chunks.select(*kept, F.expr(f"substring(padded, start, {CHUNK + ORDER})").alias("chunk"))
    places = F.explode(F.sequence(F.lit(1), F.length("chunk") - ORDER))
    rows = chunks.select(*kept, "chunk", places.alias("place"))
    return rows.select(*kept, F.expr(f"substring(chunk, place, {ORDER + 1})").alias("gram"))


def model(grams: DataFrame, seen: DataFrame) -> DataFrame:
    """(gram, ratio) for the grams of ``seen``: log P(allowed) - log P(blocked) of the last character.

    ``grams`` has columns gram and verdict.
    """
    counts = grams.groupBy("gram").agg(*(F.sum((F.col("verdict") == v).cast("long")).alias(f"n_{v}") for v in (ALLOW, BLOCK)))
    table = seen
    for order in range(ORDER + 1):
        key, context = f"key{order}", f"context{order}"
        table = table.withColumn(key, F.expr(f"right(gram, {order + 1})")).withColumn(context, F.expr(f"left({key}, {order})"))
        own = counts.groupBy(F.expr(f"right(gram, {order + 1})").alias(key)).agg(
            *(F.sum(f"n_{v}").alias(f"n_{v}{order}") for v in (ALLOW, BLOCK))
        )
        sums = own.groupBy(F.expr(f"left({key}, {order})").alias(context)).agg(
            *(F.sum(f"n_{v}{order}").alias(f"sum_{v}{order}") for v in (ALLOW, BLOCK)),
            *(F.sum((F.col(f"n_{v}{order}") > 0).cast("long")).alias(f"kinds_{v}{order}") for v in (ALLOW, BLOCK)),
        )
        table = table.join(own, key, "left").join(sums, context, "left")

    def probability(v: str) -> Column:
        def longer(shorter: Column, order: int) -> Column:
            n, total, kinds = (F.coalesce(F.col(f"{c}_{v}{order}"), F.lit(0)) for c in ("n", "sum", "kinds"))
            return F.when(total > 0, (n + kinds * shorter) / (total + kinds)).otherwise(shorter)

        return reduce(longer, range(ORDER + 1), F.lit(1 / ALPHABET))

    return table.select("gram", (F.log(probability(ALLOW)) - F.log(probability(BLOCK))).alias("ratio"))


def scores(urls: DataFrame) -> DataFrame:
    """Add ``key`` and ``score`` to distinct URLs of (url, verdict, calibrates)."""
    urls = urls.withColumn("key", url_key())
    grams = url_grams(urls)
    trained = grams.where(F.col("verdict").isNotNull() & ~F.col("calibrates"))
    ratios = model(trained, grams.select("gram").distinct())
    means = grams.select("key", "gram").join(ratios, "gram").groupBy("key").agg(F.round(F.avg("ratio"), 9).alias("score"))
    return urls.join(means, "key", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def threshold(scored: DataFrame) -> float:
    """The score with the least sum of error rates over the calibration URLs; one row is gathered."""
    step = F.floor(F.least(F.greatest(F.col("score"), F.lit(-LARGEST)), F.lit(LARGEST)) * STEPS)
    held = scored.where("verdict is not null and calibrates")
    table = held.groupBy(step.alias("step")).agg(*(F.sum((F.col("verdict") == v).cast("long")).alias(v) for v in (ALLOW, BLOCK)))
    # At most 2 * LARGEST * STEPS + 1 rows from here on.
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lost = F.try_divide(F.coalesce(F.sum(ALLOW).over(below), F.lit(0)), F.sum(ALLOW).over(everything))
    passed = 1 - F.try_divide(F.coalesce(F.sum(BLOCK).over(below), F.lit(0)), F.sum(BLOCK).over(everything))
    best = table.select("step", F.round(lost + passed, 9).alias("errors")).where("errors is not null")
    best = best.orderBy("errors", F.abs("step"), "step").first()
    return -float("inf") if best is None else best["step"] / STEPS


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): rows of ``pages`` with their verdicts.

    Scores are stored once, by key: the threshold and the result read that table.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    pages = pages.select("page_id", url.alias("url"))
    host, path = url_parts(F.col("url"))
    name, verdict = rule_columns(rules if rules is not None else RULES)

    def ruled(urls: DataFrame) -> DataFrame:
        return urls.withColumns({"host": host, "path": path}).withColumns({"rule": name, "verdict": verdict})

    labelled = ruled(pages.select("url").distinct()).select(
        "url", "verdict", (F.crc32(F.col("url").cast("binary")) % CALIBRATION_SHARE == 0).alias("calibrates")
    )
    scored = stored(scores(labelled).select("key", "verdict", "calibrates", "score"))
    limit = threshold(scored)
    judged = F.coalesce("verdict", F.when(F.col("score") >= F.lit(limit), ALLOW).otherwise(BLOCK))
    rows = ruled(pages.withColumn("key", url_key())).drop("url").join(scored.select("key", "score"), "key")
    return rows.withColumn("verdict", judged).select("page_id", "host", "path", "rule", "verdict", "score")
