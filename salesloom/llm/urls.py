"""URL filter by a character language-model ratio (DataFrame functions only).

Two variable-order Markov models of URL characters are counted, one over accepted
and one over rejected URLs (here: the URLs that a rule allows or blocks).  A
character's probability after its up to three predecessors is smoothed by
Witten-Bell interpolation from order 3 down to order 0 and a uniform base: an
order whose context was never seen passes the next shorter one through, so the
order that decides varies with the context.  A URL's score is the mean over its
characters of log P(accepted) - log P(rejected); it is allowed when the score
reaches a threshold calibrated on labelled URLs that the model did not count.

Scale: characters are folded to an alphabet of ``len(ALPHABET) + 2`` symbols, so
n-gram tables have at most 38**4 (about 2.1 million) rows whatever the input,
and these are what is broadcast.  Counting combines map-side; URLs are scored
once per distinct text, so a hot URL or host costs no more than its rows.

Defined cases: a null URL, or one without ``://``, has empty host and path and
no rule; a URL without characters, or any URL when the rules give no accepted or
no rejected example, has a null score and is allowed.  Repeated rows come out
as often as they came in.  Input columns other than id and URL are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import checkpointed

# Fixed values of the query's contract: (verdict, host suffix + path prefix).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

ALPHABET = "abcdefghijklmnopqrstuvwxyz/.-_?=&%:#"   # digits fold to '#'
SYMBOLS = len(ALPHABET) + 2                          # + any other character, + start
START = SYMBOLS - 1
ORDERS = 4                                           # 0..3 preceding characters
CALIBRATION_FOLDS = 5


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null when none does."""
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def grams_of(text: Column) -> Column:
    """One integer per character: its code preceded by three codes, in base SYMBOLS."""
    folded = F.translate(lower_ascii(text), "0123456789", "##########")
    codes = F.transform(F.filter(F.split(folded, ""), lambda c: c != ""),
                        lambda c: F.instr(F.lit(ALPHABET), c))
    grams = F.transform(codes, lambda c: F.lit(0).cast("bigint"))
    for back in range(ORDERS - 1, -1, -1):       # shifted copies side by side; their overhang is cut off
        shifted = F.concat(F.array_repeat(F.lit(START), back), codes)
        grams = F.zip_with(grams, shifted, lambda g, c: g * SYMBOLS + c)
    return F.when(F.length(text) > 0, F.slice(grams, 1, F.size(codes)))


def gram_ratios(counts: DataFrame) -> DataFrame:
    """``counts``: (gram, good, bad).  Returns (gram, ratio): the smoothed log
    P(good) - log P(bad) of the gram's last symbol after its first three."""
    out = counts.select("gram")
    p = {k: F.lit(1.0 / SYMBOLS) for k in ("good", "bad")}
    for order in range(ORDERS):
        size = SYMBOLS ** (order + 1)
        by_gram = counts.groupBy((F.col("gram") % size).alias(f"g{order}")).agg(
            F.sum("good").alias(f"good{order}"), F.sum("bad").alias(f"bad{order}"))
        context = F.expr(f"g{order} div {SYMBOLS}")
        by_context = by_gram.groupBy(context.alias(f"c{order}")).agg(
            *[F.sum(f"{k}{order}").alias(f"{k}n{order}") for k in p],
            *[F.count_if(F.col(f"{k}{order}") > 0).alias(f"{k}t{order}") for k in p])
        # at most SYMBOLS ** (order + 1) rows each, see the module docstring
        out = (out.withColumn(f"g{order}", F.col("gram") % size).withColumn(f"c{order}", context)
               .join(F.broadcast(by_gram), f"g{order}").join(F.broadcast(by_context), f"c{order}"))
        for k in p:
            n, t = F.col(f"{k}n{order}"), F.col(f"{k}t{order}")
            p[k] = F.when(n > 0, (F.col(f"{k}{order}") + t * p[k]) / (n + t)).otherwise(p[k])
    return out.select("gram", (F.log(p["good"]) - F.log(p["bad"])).alias("ratio"))


def _scores(texts: DataFrame, ratios: DataFrame) -> DataFrame:
    """Mean ratio of each row of ``texts`` (distinct ``text``)."""
    return (texts.select("text", F.explode(grams_of(F.col("text"))).alias("gram"))
            .join(F.broadcast(ratios), "gram")
            .groupBy("text").agg(F.avg("ratio").alias("score")))


def _counts(texts: DataFrame) -> DataFrame:
    """Every gram of every text with its counts in accepted and rejected URLs
    (``weight`` rows of each text, ``label`` 1, 0 or null)."""
    return (texts.select("label", "weight", F.explode(grams_of(F.col("text"))).alias("gram"))
            .groupBy("gram").agg(
                F.sum(F.when(F.col("label") == 1, F.col("weight")).otherwise(0)).alias("good"),
                F.sum(F.when(F.col("label") == 0, F.col("weight")).otherwise(0)).alias("bad")))


def calibrate(scored: DataFrame) -> float:
    """The threshold on ``score`` with the best balanced accuracy over ``label``,
    from a histogram of 0.01-wide bins between -20 and 20."""
    bins = (scored.where("label is not null and score is not null")
            .select("label", "weight", F.round(F.greatest(F.least(F.col("score"), F.lit(20.0)),
                                                          F.lit(-20.0)) * 100).cast("int").alias("bin"))
            .groupBy("bin").agg(F.sum(F.col("weight") * F.col("label")).alias("good"),
                                F.sum(F.col("weight") * (1 - F.col("label"))).alias("bad"))
            .orderBy("bin").collect())          # at most 4001 rows
    good, bad = sum(r["good"] for r in bins), sum(r["bad"] for r in bins)
    if not good or not bad:
        return 0.0
    best, at, below_good, below_bad, last = 0.0, 0.0, 0, 0, bins[0]["bin"] - 1
    for r in bins:                              # cut halfway between two filled bins
        value = (good - below_good) / good + below_bad / bad
        if value > best:
            best, at = value, (last + r["bin"]) / 200
        below_good, below_bad, last = below_good + r["good"], below_bad + r["bad"], r["bin"]
    return at


def judge_urls(urls: DataFrame, rules: list[tuple[str, str]] = RULES,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, url, host, path, rule, verdict, score) for every row of ``urls``."""
    url = F.col(url_col).cast("string")
    rows = urls.select(F.col(id_col), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = (rows.withColumn("rule", rule).withColumn("rule_verdict", verdict)
            .withColumn("text", F.coalesce(lower_ascii(_after_scheme(F.col("url"))), F.lit(""))))
    label = F.when(F.col("rule_verdict") == "allow", 1).when(F.col("rule_verdict") == "block", 0)
    texts = checkpointed(
        rows.groupBy("text").agg(F.count("*").alias("weight"), F.max(label).alias("label"))
        .withColumn("held", F.crc32(F.col("text").cast("binary")) % CALIBRATION_FOLDS == 0))
    seen = {r["label"] for r in texts.groupBy("label").count().collect()}
    if {0, 1} <= seen:
        trained = F.when(~F.col("held"), F.col("label"))
        ratios = gram_ratios(checkpointed(_counts(texts.withColumn("label", trained))))
        held = texts.where(F.col("held") & F.col("label").isNotNull())
        scores = checkpointed(_scores(texts, checkpointed(ratios)))
        threshold = calibrate(held.join(scores, "text"))
        rows = rows.join(scores, "text", "left")
    else:
        threshold = 0.0
        rows = rows.withColumn("score", F.lit(None).cast("double"))
    by_model = F.when(F.col("score") < threshold, "block").otherwise("allow")
    return rows.select(F.col(id_col), "url", "host", "path", "rule",
                       F.coalesce("rule_verdict", by_model).alias("verdict"), "score")
