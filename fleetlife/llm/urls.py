"""URL filter: rules where one fits, else the ratio of two character language models.

The models are variable-order Markov models of accepted and of rejected urls, learned
from all urls that a rule decides. Every order up to ORDER is counted over the whole
table; orders are mixed by Witten-Bell smoothing, so a context counts the more the
less varied what follows it. A url's score is the difference of its log-likelihoods
per character. A fifth of the decided urls is kept out of the counts; the threshold is
where the two kinds among them separate best.

Counts are tables of grams, joined, never one dictionary: they may grow with the input.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlife.llm.store import stored

#: (host, start of the path, verdict) of the contract.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
ORDER = 4
CHARACTERS = 256
#: Scores are compared with thresholds in steps of this size, between -LIMIT and LIMIT.
STEP, LIMIT = 0.01, 20.0
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url):
    """(host, path) of a url column; empty where it is null or has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    cut = [F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2)]
    return F.translate(cut[0], UPPER, LOWER), cut[1]


def matched_rule(host, path, rules):
    """(rule, verdict) of the longest rule that fits, else nulls. Ties go by alphabet."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, own_verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        found, verdict = F.when(fits, F.lit(own_host + own_path)).otherwise(found), F.when(fits, F.lit(own_verdict)).otherwise(verdict)
    return found, verdict


def _grams(texts: DataFrame) -> DataFrame:
    """Every character with the ORDER before it, of column ``text``."""
    padded = F.concat(F.lit(START * ORDER), F.col("text"), F.lit(END))
    return texts.withColumn("gram", F.explode(F.transform(F.sequence(F.lit(1), F.length("text") + 1), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))))


def log_ratios(known: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, ratio): log P(allow) - log P(block) of the last character, for every wanted gram.

    ``known`` (gram, allow, block) has the counts of grams of ORDER + 1 characters; counts of
    shorter ones are their sums, as a position ends exactly one gram of each order.
    """
    sides = ("allow", "block")
    grams = known.select("gram", *sides).union(wanted.select("gram", F.lit(0).cast("long"), F.lit(0).cast("long"))).groupBy("gram").agg(*(F.sum(s).alias(s) for s in sides))
    below = None
    for order in range(ORDER + 1):
        own = F.substring("gram", ORDER + 1 - order, order + 1)
        table = grams.groupBy(own.alias("tail")).agg(*(F.sum(s).alias(s) for s in sides))
        context = F.substring("tail", 1, order) if order else F.lit("")
        table = table.withColumn("context", context)
        totals = table.groupBy("context").agg(*(F.sum(s).alias(f"all_{s}") for s in sides), *(F.count_if(F.col(s) > 0).alias(f"kinds_{s}") for s in sides))
        table = table.join(totals, "context")
        if below is None:
            table = table.withColumns({f"low_{s}": F.lit(1.0 / CHARACTERS) for s in sides})
        else:
            shorter = below.select(F.col("tail").alias("shorter"), *(F.col(f"p_{s}").alias(f"low_{s}") for s in sides))
            table = table.withColumn("shorter", F.substring("tail", 2, order)).join(shorter, "shorter")
        mixed = {f"p_{s}": F.when(F.col(f"all_{s}") > 0, (F.col(s) + F.col(f"kinds_{s}") * F.col(f"low_{s}")) / (F.col(f"all_{s}") + F.col(f"kinds_{s}"))).otherwise(F.col(f"low_{s}")) for s in sides}
        below = stored(table.withColumns(mixed).select("tail", *(f"p_{s}" for s in sides)))
    return below.select(F.col("tail").alias("gram"), (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def threshold(judged: DataFrame) -> float:
    """Score from which a url is allowed: where the kinds of (score, verdict) separate best.

    A row per step of the score is compared, at most 2 * LIMIT / STEP + 1. Ties go to the
    middle of the range that is as good; without both kinds it is 0.
    """
    step = F.least(F.lit(LIMIT), F.greatest(F.lit(-LIMIT), F.floor(F.col("score") / STEP) * STEP))
    steps = judged.groupBy(step.alias("step")).agg(F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block"))
    under = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ran = steps.select(
        "step",
        (1 - F.coalesce(F.sum("allow").over(under), F.lit(0)) / F.nullif(F.sum("allow").over(whole), F.lit(0)) + F.coalesce(F.sum("block").over(under), F.lit(0)) / F.nullif(F.sum("block").over(whole), F.lit(0))).alias("good"),
    )
    best = ran.where("good is not null").groupBy(F.round("good", 12).alias("good")).agg(F.avg("step").alias("step")).orderBy(F.desc("good")).limit(1)
    row = best.first()
    return float(row["step"]) if row else 0.0


def url_filter(pages: DataFrame, rules=RULES, whole: bool = False) -> DataFrame:
    """The verdict on every url.

    Takes page_id and url; returns (page_id, host, path, rule, verdict, score, threshold) for each
    row. Where a rule fits, it decides and score is null; else the url is allowed if its
    score reaches the threshold. Null urls and urls without ``://`` have empty host and
    path and are judged by the models like any other. The models learn and score host and path, or with
    ``whole`` the url as it is, null as empty. Equal urls are judged once and alike.
    Without decided urls every score is 0 and every url is allowed. An empty table gives
    an empty result.
    """
    host, path = parts(F.col("url"))
    text = F.coalesce("url", F.lit("")) if whole else F.concat(host, path)
    pages = pages.select("page_id", host.alias("host"), path.alias("path"), text.alias("text"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    pages = pages.withColumns({"rule": rule, "decided": verdict})
    texts = stored(pages.groupBy("text", "decided").agg(F.count("*").alias("n")))
    fold = F.crc32(F.col("text").cast("binary")) % 5 == 0
    learned = _grams(texts.where(F.col("decided").isNotNull() & ~fold).select("text", "decided", "n"))
    known = stored(learned.groupBy("gram").agg(*(F.sum(F.when(F.col("decided") == s, F.col("n")).otherwise(0)).alias(s) for s in ("allow", "block"))))
    open_ = texts.where(F.col("decided").isNull() | fold).select("text").distinct()
    positions = _grams(open_).groupBy("text", "gram").agg(F.count("*").alias("n"))
    ratios = log_ratios(known, positions.select("gram").distinct())
    scores = stored(positions.join(ratios, "gram").groupBy("text").agg((F.sum(F.col("n") * F.col("ratio")) / F.sum("n")).alias("score")))
    judged = texts.where(F.col("decided").isNotNull() & fold).join(scores, "text").select("score", F.col("decided").alias("verdict"))
    least = threshold(judged)
    found = pages.join(scores.select(F.col("text").alias("t"), "score"), (F.col("text") == F.col("t")) & F.col("decided").isNull(), "left")
    chosen = F.coalesce("decided", F.when(F.col("score") >= least, "allow").otherwise("block"))
    return found.select("page_id", "host", "path", "rule", chosen.alias("verdict"), "score", F.lit(least).alias("threshold"))
