"""URL filters: rules first, and for other URLs a ratio of two character language models; DataFrame functions only.

The URLs that a rule allows train a model of accepted URLs, those that one blocks a model of rejected ones. Both are Markov
models of variable order: the chance of a character after the three before it is mixed with that after two, one and none of
them, the more so the fewer examples a context has and the more varied they are (Witten-Bell). A URL's score is the mean over
its characters of the difference of the logarithms; it is allowed from a threshold on, which is calibrated on rule-decided URLs
that the models haven't seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.llm.common import broadcast_if_small, save

#: (host, path, verdict). A rule holds for its host and all subdomains where the path starts with the rule's.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
#: Characters of context; of the log ratios a character's counts in millionths, so that sums don't depend on their order.
ORDER, UNIT = 3, 1_000_000
#: One URL in so many calibrates the threshold; scores are told apart in steps of so many units.
FOLDS, STEP = 5, 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START, END = "\u0002", "\u0003"


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda i: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def best_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """A struct of the longest rule that fits, with its verdict; null without one. Of equally long rules the first in the list."""
    ranked = sorted(enumerate(rules), key=lambda x: (-len(x[1][0] + x[1][1]), x[0]))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for _, (h, p, verdict) in reversed(ranked):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(df: DataFrame, text: Column, *keep: str) -> DataFrame:
    """A row for each character of the text and for its end: the ORDER characters before it, and itself."""
    padded = df.select(*keep, F.concat(F.lit(START * ORDER), text, F.lit(END)).alias("t"))
    at = padded.select(*keep, "t", F.explode(F.sequence(F.lit(1), F.length("t") - ORDER)).alias("i"))
    return at.select(*keep, F.substring("t", F.col("i"), F.lit(ORDER)).alias("ctx"), F.substring("t", F.col("i") + ORDER, F.lit(1)).alias("c"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """(ctx, c, ratio) from (ctx, c, good, bad): the log of a character's chance in the good model over that in the bad one.

    counts holds every context and character that is to be scored, with counts of 0 where it is in no training URL.
    """
    levels = {ORDER: counts.select(F.col("ctx").alias("x3"), "c", "good", "bad")}
    for n in range(ORDER - 1, -1, -1):
        wide, ctx = levels[n + 1], F.substring(f"x{n + 1}", 2, n) if n else F.lit("")
        levels[n] = wide.groupBy(ctx.alias(f"x{n}"), "c").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    # the order-0 model: add one for each character that occurs anywhere
    whole = W.partitionBy("x0")
    p = levels[0]
    for m in ("good", "bad"):
        p = p.withColumn(f"p_{m}", (F.col(m) + 1.0) / (F.sum(m).over(whole) + F.count("*").over(whole)))
    p = p.select("x0", "c", "p_good", "p_bad")
    for n in range(1, ORDER + 1):
        by = W.partitionBy(f"x{n}")
        level = levels[n]
        for m in ("good", "bad"):
            level = level.withColumn(f"n_{m}", F.sum(m).over(by)).withColumn(f"t_{m}", F.sum((F.col(m) > 0).cast("int")).over(by))
        level = level.withColumn(f"x{n - 1}", F.substring(f"x{n}", 2, n - 1) if n > 1 else F.lit(""))
        level = level.join(p, [f"x{n - 1}", "c"])
        for m in ("good", "bad"):
            smooth = (F.col(m) + F.col(f"t_{m}") * F.col(f"p_{m}")) / (F.col(f"n_{m}") + F.col(f"t_{m}"))
            level = level.withColumn(f"q_{m}", F.when(F.col(f"n_{m}") > 0, smooth).otherwise(F.col(f"p_{m}")))
        p = level.select(f"x{n}", "c", F.col("q_good").alias("p_good"), F.col("q_bad").alias("p_bad"))
    return p.select(F.col(f"x{ORDER}").alias("ctx"), "c", F.round((F.ln("p_good") - F.ln("p_bad")) * UNIT).cast("long").alias("ratio"))


def threshold(scores: DataFrame) -> int:
    """The score, in units, from which a URL is allowed: with the best mean of the shares of good and of bad URLs told right.

    scores: (score, good boolean), gathered in steps of the score, of which there are no more than the range of scores has.
    Of equal thresholds the lowest; 0 without URLs of both kinds.
    """
    steps = scores.groupBy(F.floor(F.col("score") / STEP).alias("s")).agg(F.sum(F.col("good").cast("long")).alias("g"), F.sum((~F.col("good")).cast("long")).alias("b"))
    order = W.partitionBy(F.lit(0)).orderBy("s")
    up, before = order.rowsBetween(0, W.unboundedFollowing), order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(0))
    right = F.sum("g").over(up) / F.sum("g").over(whole) + F.coalesce(F.sum("b").over(before), F.lit(0)) / F.sum("b").over(whole)
    both = (F.sum("g").over(whole) > 0) & (F.sum("b").over(whole) > 0)
    best = steps.withColumn("both", both).where("both").select("s", "g", "b").withColumn("right", right).orderBy(F.desc("right"), "s").first()
    return int(best.s) * STEP if best else 0


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of pages (page_id, url).

    Host is what follows the first :// up to /, ? or #, A-Z in lower case; path what follows up to ? or #; both are empty for
    a null url or one without ://. verdict is that of the longest rule that fits, else allow where the score reaches the
    threshold and block elsewhere. score is null where a rule decides. Each distinct host and path is counted and scored
    once, so a URL that many rows have is no heavier than another; without rule-decided URLs all scores are 0, which is the
    threshold then. Null and repeated page_ids give a row each; no rows give no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    distinct = rows.groupBy("host", "path").agg(F.count("*").alias("n"))
    rule = best_rule(F.col("host"), F.col("path"), rules)
    text = F.concat("host", "path")
    distinct = distinct.withColumn("r", rule).withColumn("fold", F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("long") % FOLDS)
    distinct = save(distinct.select("host", "path", text.alias("text"), F.col("r.verdict").alias("verdict"), "fold"), "urls")
    train = (F.col("fold") > 0) & F.col("verdict").isNotNull()
    seen = distinct.withColumn("good", (train & (F.col("verdict") == "allow")).cast("long")).withColumn("bad", (train & (F.col("verdict") == "block")).cast("long"))
    counts = grams(seen, F.col("text"), "good", "bad").groupBy("ctx", "c").agg(F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad"))
    model = broadcast_if_small(save(log_ratios(save(counts, "url-counts")), "url-model"))
    # those to be judged, and those that calibrate
    asked = distinct.where("verdict IS NULL OR fold = 0")
    scored = grams(asked, F.col("text"), "host", "path", "verdict").join(model, ["ctx", "c"])
    scored = scored.groupBy("host", "path", "verdict").agg((F.sum("ratio") / F.count("*")).alias("score"))
    scored = save(scored, "url-scores")
    least = threshold(scored.where("verdict IS NOT NULL").select("score", (F.col("verdict") == "allow").alias("good")))
    judged = scored.where("verdict IS NULL").select("host", "path", "score", F.when(F.col("score") >= least, "allow").otherwise("block").alias("guess"))
    out = rows.withColumn("r", rule).join(broadcast_if_small(judged), ["host", "path"], "left")
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", "guess").alias("verdict"), (F.col("score") / UNIT).alias("score"))
