"""URL filter: rules first, then a ratio of character language models.

Host and path are cut out of the url, and the longest fitting rule decides. The
urls that rules decide train two character Markov models, of accepted and of
rejected urls; a url without a rule is judged by the difference of its two
log-likelihoods, divided by its length, against a threshold calibrated on
rule-decided urls held out of the training.

The models are of variable order: a character after up to ``ORDER`` others. A
longer context counts only where the class's training holds it at least
``LEAST`` times; there its distribution is mixed with that of the context one
character shorter by Witten-Bell weights, elsewhere the shorter one stands, down
to the character alone and the uniform distribution. So contexts grow with the
training urls. Characters are folded to ``ALPHABET`` (digits to 0, anything else
to ~). A gram has at most ``SYMBOLS`` grams that end or begin with all but one
of its characters, so joins of one order with the next have no hot keys. Grams
with at least 1 / ``FREQUENT`` of all positions, hence at most ``FREQUENT`` of
them, are broadcast to the positions, the others joined by shuffle. Equal urls
are scored once, with their number as weight in training.

DataFrame functions only. Log ratios are rounded to millionths and summed as
integers, so a score does not depend on the order of summation.

Defined results: a null url, or one without ``://``, has empty host and path; a
null url is judged as an empty one; repeated rows are judged row by row; without
held-out urls the threshold is 0; without training urls of a class its model is
uniform; extra columns stay (one named like an output is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqwise.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = LOWER + "0-./_?=&%#:~"                  # ^ begins and $ ends a url
SYMBOLS = len(ALPHABET) + 2
#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
PARTS = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
ORDER, LEAST = 5, 3                                # longest context; fewest times that a context is seen
FREQUENT = 100_000                                 # bounds what is broadcast
HELD_OUT = ("0", "1", "2")                         # first hex digits of the url's MD5
FLOOR, STEP = 1_000_000, 10_000                    # a score counts millionths, a bin hundredths


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def best_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """struct(size, rule, verdict) of the longest fitting rule, or null."""
    fits = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
                   F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in rules]
    return F.array_max(F.array_compact(F.array(*fits)))


def folded(url: Column, order: int = ORDER) -> Column:
    """The url in the models' alphabet, between its begin marks and its end mark."""
    low = F.translate(url, UPPER, LOWER)
    known = F.regexp_replace(F.regexp_replace(low, "[0-9]", "0"), r"[^a-z0\-./_?=&%#:~]", "~")
    return F.concat(F.lit("^" * order), known, F.lit("$"))


def positions(urls: DataFrame, order: int, *columns: str) -> DataFrame:
    """One row per character: ``gram`` is it after the ``order`` before it."""
    at = F.explode(F.sequence(F.lit(1), F.length("body") - order)).alias("at")
    return urls.select(*columns, "body", at).select(*columns, F.expr(f"substring(body, at, {order + 1})").alias("gram"))


def log_ratios(grams: DataFrame, order: int = ORDER, least: int = LEAST) -> DataFrame:
    """(gram, ratio) of ``grams`` (gram, a, b: times in the training of allow and
    of block): log of the last character's probability under allow minus under
    block, in millionths."""
    ends = F.explode(F.sequence(F.lit(1), F.lit(order + 1))).alias("size")
    ends = grams.select("gram", "a", "b", ends).select(F.expr("right(gram, size)").alias("g"), "a", "b")
    ends = staged(ends.groupBy("g").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "url-ends")
    context = F.expr("left(g, length(g) - 1)")
    seen = ends.groupBy(context.alias("x")).agg(F.sum("a").alias("total_a"), F.count_if(F.col("a") > 0).alias("kinds_a"),
                                                F.sum("b").alias("total_b"), F.count_if(F.col("b") > 0).alias("kinds_b"))
    rows = staged(ends.withColumn("x", context).join(seen, "x"), "url-contexts")

    def mixed(c: str, size: int, lower: Column) -> Column:
        n, total, kinds = F.col(c), F.col(f"total_{c}"), F.col(f"kinds_{c}")
        return F.when(total >= (least if size > 1 else 1), (n + kinds * lower) / (total + kinds)).otherwise(lower)
    p = None
    for size in range(1, order + 2):
        now = rows.filter(F.length("g") == size)
        if p is None:
            lower = {c: F.lit(1.0 / SYMBOLS) for c in "ab"}
        else:
            # a shorter context's rows are at most SYMBOLS ** (size - 1)
            p = F.broadcast(p) if SYMBOLS ** (size - 1) <= FREQUENT else p
            now = now.join(p, F.expr("substring(g, 2)") == p["end"])
            lower = {c: F.col(f"p_{c}") for c in "ab"}
        p = now.select(F.col("g").alias("end"), *[mixed(c, size, lower[c]).alias(f"p_{c}") for c in "ab"])
    return p.select(F.col("end").alias("gram"),
                    F.round((F.log("p_a") - F.log("p_b")) * FLOOR).cast("long").alias("ratio"))


def threshold(scored: DataFrame) -> int:
    """The bin from which urls are allowed: least sum of the two error rates on
    (bin, verdict, n); the middle one of several, 0 without any. At most a few
    thousand bins: a mean log ratio is bounded by the smoothing."""
    hist = scored.groupBy("bin").agg(F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("a"),
                                     F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("b"))
    got = hist.sparkSession.sql("""
        WITH e AS (SELECT bin, sum(a) OVER (ORDER BY bin) - a AS missed,
                          sum(b) OVER (ORDER BY bin DESC) AS passed,
                          sum(a) OVER () AS na, sum(b) OVER () AS nb FROM {bins}),
        r AS (SELECT bin, missed / greatest(na, 1) + passed / greatest(nb, 1) AS err FROM e)
        SELECT cast(floor((min(bin) + max(bin)) / 2) AS int) AS bin
        FROM r WHERE err = (SELECT min(err) FROM r)""", bins=hist).first()
    return 0 if got is None or got.bin is None else got.bin


def judge_urls(pages: DataFrame, url: str = "url", rules: tuple = RULES, keep: list[str] | None = None,
               order: int = ORDER, least: int = LEAST, frequent: int = FREQUENT) -> DataFrame:
    """``pages`` (columns ``keep``; all by default) with ``host``, ``path``,
    ``rule``, ``verdict`` and ``score`` (mean log ratio in millionths)."""
    made = ["host", "path", "rule", "verdict", "score"]
    keep = [c for c in (pages.columns if keep is None else keep) if c not in made]
    rows = pages.select(*keep, F.coalesce(F.col(url), F.lit("")).alias("__url"))
    urls = rows.groupBy(F.col("__url").alias("url")).agg(F.count("*").alias("n"))
    urls = urls.withColumn("verdict", best_rule(host_of(F.col("url")), path_of(F.col("url")), rules)["verdict"])
    urls = urls.withColumn("body", folded(F.col("url"), order))
    urls = urls.withColumn("held", F.substring(F.md5("url"), 1, 1).isin(*HELD_OUT))
    urls = staged(urls.withColumn("id", F.monotonically_increasing_id()), "urls")
    trained = F.when(~F.col("held"), F.col("n"))
    grams = positions(urls, order, "verdict", "held", "n").groupBy("gram").agg(
        F.coalesce(F.sum(F.when(F.col("verdict") == "allow", trained)), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(F.col("verdict") == "block", trained)), F.lit(0)).alias("b"), F.count("*").alias("places"))
    grams = staged(grams, "url-grams")
    ratios = staged(grams.select("gram", "places").join(log_ratios(grams, order, least), "gram"), "url-ratios")
    places = grams.agg(F.sum("places")).first()[0] or 0
    often = F.col("places") * frequent >= places
    each = positions(urls, order, "id").join(F.broadcast(ratios.filter(often).select("gram", "ratio")), "gram", "left")
    rare = each.filter("ratio IS NULL").select("id", "gram").join(ratios.filter(~often).select("gram", "ratio"), "gram")
    each = each.filter("ratio IS NOT NULL").select("id", "ratio").unionByName(rare.select("id", "ratio"))
    sums = each.groupBy("id").agg(F.floor(F.sum("ratio") / F.count("*")).alias("score"))
    scored = staged(urls.select("id", "url", "held", "verdict", "n").join(sums, "id"), "url-scores")
    held = scored.filter("held AND verdict IS NOT NULL")
    limit = threshold(held.select(F.floor(F.col("score") / STEP).alias("bin"), "verdict", "n"))
    scored = scored.select(F.col("url").alias("__scored"), "score")
    out = rows.join(scored, rows["__url"] == scored["__scored"], "left")
    out = out.withColumns({"host": host_of(F.col("__url")), "path": path_of(F.col("__url"))})
    out = out.withColumn("__rule", best_rule(F.col("host"), F.col("path"), rules))
    by_model = F.when(F.floor(F.col("score") / STEP) >= limit, "allow").otherwise("block")
    return out.select(*keep, "host", "path", F.col("__rule.rule").alias("rule"),
                      F.coalesce(F.col("__rule.verdict"), by_model).alias("verdict"), "score")
