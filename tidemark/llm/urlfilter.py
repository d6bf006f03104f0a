r"""URL filter by a ratio of character language models.

Rules of host and path decide first (the longest that fits).  The rest is judged
by two variable-order Markov models over the characters of host and path, one
for accepted and one for rejected urls, smoothed by Witten-Bell interpolation:
an order counts as far as the training urls hold its context, and gives way to
the next lower one.  Rejected are the urls that a rule blocks or that hold a seed
word; all others count as accepted, those that no rule and no seed word names too, so
that at most ``false_blocks`` of these are blocked: urls of a new kind are found as far
as they look like rejected ones and not like the others.  Each distinct host and path
counts once.  A url is blocked if the mean log-likelihood difference per character
exceeds a threshold, calibrated on held out accepted urls so that at most
``false_blocks`` of them are blocked.

The difference of each distinct n-gram is computed once, in a table of the
distinct n-grams, and joined to the n-grams of the distinct urls.  Differences
are whole millionths, so sums don't depend on the order of addition.

Rows: one result row per row of the pages.  A null url, or one without ``://``,
has an empty host and path, fits no rule, and is allowed.  A null id stays null.  Of
rules of equal length that fit, a blocking one wins, then the first by host.  Urls of any
length are scored whole.  An empty table gives an empty result.  Only the id and the url
column are read, so other columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.native import ascii_lower, let
from tidemark.llm.store import looked_up, stored

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
SEEDS = ("casino", "bets", "adult", "pills", "spam", "porn", "viagra", "ads-track", "lottery", "xxx")
ORDER = 4
FALSE_BLOCKS = 0.005
ALPHABET = 256


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = let(rest, lambda r: ascii_lower(F.regexp_extract(r, r"^[^/?#]*", 0)))
    path = let(rest, lambda r: F.regexp_extract(r, r"^[^/?#]*([^?#]*)", 1))
    return host, path


def rule_and_verdict(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as text) and its verdict; null where none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1]))
    fits = [((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)) for _, h, p in ordered]
    chain = lambda values: reduce(
        lambda rest, x: F.when(x[0], F.lit(x[1])).otherwise(rest), reversed(list(zip(fits, values))),
        F.lit(None).cast("string"))
    return chain([h + p for _, h, p in ordered]), chain([v for v, _, _ in ordered])


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """The n-grams of every distinct url, one for each character and one for its end."""
    padded = F.concat(F.array_repeat(F.lit("\x02"), order - 1), F.split("address", ""), F.array(F.lit("\x03")))
    rows = urls.select("*", padded.alias("chars"))
    grams = F.transform(F.sequence(F.lit(0), F.size("chars") - order),
                        lambda i: F.concat(*(F.get(F.col("chars"), i + k) for k in range(order))))
    return rows.select(*urls.columns, F.explode_outer(grams).alias("gram"))


def _log_ratio(grams: DataFrame, order: int) -> DataFrame:
    """(gram, ratio) of every distinct n-gram from its counts in both classes: the log
    of its probability under the rejected less that under the accepted model, in
    millionths."""
    counts = {k: grams.groupBy(F.right("gram", F.lit(k)).alias("g"))
              .agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")) for k in range(1, order + 1)}
    table, p = grams.select("gram"), {"a": F.lit(1.0 / ALPHABET), "r": F.lit(1.0 / ALPHABET)}
    for k in range(1, order + 1):
        own = counts[k].select(F.col("g").alias(f"g{k}"), F.col("a").alias(f"a{k}"), F.col("r").alias(f"r{k}"))
        context = counts[k].groupBy(F.left("g", F.lit(k - 1)).alias(f"c{k}")).agg(
            *(F.sum(x).alias(f"{x}n{k}") for x in "ar"), *(F.count_if(F.col(x) > 0).alias(f"{x}t{k}") for x in "ar"))
        table = table.withColumn(f"g{k}", F.right("gram", F.lit(k))).join(own, f"g{k}") \
            .withColumn(f"c{k}", F.left(f"g{k}", F.lit(k - 1))).join(context, f"c{k}").drop(f"g{k}", f"c{k}")
        for x in "ar":
            n, t = F.col(f"{x}n{k}"), F.col(f"{x}t{k}")
            p[x] = F.when(n > 0, (F.col(f"{x}{k}") + t * p[x]) / (n + t)).otherwise(p[x])
    return table.select("gram", F.round(1e6 * (F.log(p["r"]) - F.log(p["a"]))).cast("long").alias("ratio"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, seeds=SEEDS,
               order: int = ORDER, false_blocks: float = FALSE_BLOCKS) -> DataFrame:
    """Per row: ``host``, ``path``, the ``rule`` that decided or null, the model's ``score``
    (null for an empty url) and the ``verdict``."""
    host, path = host_and_path(F.col("url"))
    rule, verdict = rule_and_verdict(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")) \
        .select("id", host.alias("host"), path.alias("path")) \
        .select("id", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
                F.concat("host", "path").alias("address"))
    seeded = F.lower("address").rlike("|".join(seeds)) if seeds else F.lit(False)
    urls = rows.where("address != ''").groupBy("address").agg(F.max("ruled").alias("ruled"), F.count("*").alias("rows"))
    sizes = stored(urls.select("address", "rows"), "url-sizes")
    rejected = F.coalesce(F.col("ruled") == "block", seeded)
    urls = urls.select("address", rejected.alias("reject"), (F.pmod(F.crc32("address"), F.lit(5)) == 0).alias("held"))

    occurrences = _grams(urls, order)
    train = ~F.col("held")
    counted = stored(occurrences.groupBy("gram").agg(
        F.count_if(train & ~F.col("reject")).alias("accepted"), F.count_if(train & F.col("reject")).alias("rejected")),
        "url-grams")
    ratios = stored(_log_ratio(counted, order), "url-ratios")
    scores = stored(occurrences.join(ratios, "gram").groupBy("address", "reject", "held")
                    .agg(F.sum("ratio").alias("total"), F.count("*").alias("length"))
                    .select("address", "reject", "held", (F.col("total") / F.col("length") / 1e6).alias("score")),
                    "url-scores")
    limit = scores.where("held AND NOT reject").agg(F.percentile_approx("score", 1 - false_blocks, 10000)).first()[0]
    limit = 0.0 if limit is None else max(0.0, limit)
    # pages without an address have no score; an address that very many share is looked up in place
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    scored = looked_up(rows.where("address != ''"), scores.select("address", "score").join(sizes, "address"), ["address"], total)
    bare = rows.where("address = ''").withColumn("score", F.lit(None).cast("double"))
    return scored.unionByName(bare).select(
        F.col("id").alias(id_col), "host", "path", "rule", "score",
        F.coalesce("ruled", F.when(F.col("score") > limit, "block").otherwise("allow")).alias("verdict"))
