"""URL filters by association rules (operator 7), DataFrame operations only.

A labelled url becomes a transaction of its tokens and, if bad, the class item.
Spark's FP-growth mines frequent token sets; rules ``tokens -> bad`` stay if
confident and frequent enough, and if no part of their tokens says the same at
least as surely.  With a ``risk``, a rule's confidence must be proven: the exact
lower binomial bound, at the risk divided by the number of sets looked at, has
to reach the wanted confidence.  Tokens of equal row sets are one item, so a
long url's own words do not multiply into all their subsets.  Rules are matched through an inverted index: each is filed
under its rarest token, urls meet it by an equi-join on that token, and its
other tokens are checked in the row.  Fixed rules (host, path prefix) come
first; the longest that fits decides.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from nextbuy.llm.ship import ship
from nextbuy.session import materialize

BAD = "\u0001bad"
#: Fixed rules: (host, path prefix, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Share of the labelled urls a token set must occur in, and share of them that must be bad.
SUPPORT, CONFIDENCE = 0.001, 0.6
#: Chance that any mined rule of a table is less confident than wanted (the query's setting).
RISK = 0.05
#: Terms of a binomial tail that are added one by one; what follows is bounded by a geometric series.
TAIL_TERMS = 300
# Coefficients of Lanczos' approximation of the gamma function for g = 7.
_LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905,
            -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.translate(F.regexp_extract(after, r"\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.regexp_extract(after, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a url, by place: scheme, host labels, path words, query keys; digits become ``0``."""
    plain = lambda c: F.regexp_replace(F.lower(c), r"[0-9]+", "0")
    words = lambda place, c, at: F.transform(F.filter(F.split(plain(c), at), lambda x: x != ""), lambda x: F.concat(F.lit(place), x))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return F.coalesce(F.array_distinct(F.concat(
        words("s:", F.regexp_extract(url, r"\A(.*?)://", 1), r"://"), words("h:", host_of(url), r"\."), words("w:", host_of(url), r"[.\-_]+"),
        words("p:", path_of(url), r"[/.\-_]+"), words("q:", F.regexp_replace(query, r"=[^&]*", ""), r"&"))), F.array().cast("array<string>"))


def ln_factorial(n: Column) -> Column:
    z = n.cast("double")
    series = F.lit(_LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], 1):
        series = series + F.lit(c) / (z + i)
    t = z + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.ln(t) - t + F.ln(series)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X >= k) for X ~ Binomial(n, p) where k > n p, from above within rounding; 1 elsewhere."""
    first = F.exp(ln_factorial(n) - ln_factorial(k) - ln_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p))
    ratio = lambda i: (n - i) / (i + 1) * (p / (1 - p))
    steps = F.sequence(F.lit(0), F.lit(TAIL_TERMS - 1))
    zero = F.struct(first.alias("term"), first.alias("total"))

    def add(acc: Column, j: Column) -> Column:
        term = F.when(k + j < n, acc["term"] * ratio(k + j)).otherwise(0.0)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    summed = F.aggregate(steps, zero, add)
    last = ratio(k + TAIL_TERMS)
    rest = F.when(k + TAIL_TERMS < n, summed["term"] * last / (1 - last)).otherwise(0.0)
    return F.when(k > n * p, F.least(summed["total"] + rest, F.lit(1.0))).otherwise(1.0)


def least_count(risk: float | None, confidence: float) -> int:
    """Fewest bad urls, all of a set's urls, that can prove the confidence even if only one set is looked at."""
    return 1 if risk is None else math.ceil(math.log(risk) / math.log(confidence))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, risk: float | None = None) -> DataFrame:
    """tokens, support, confidence of the rules from ``labelled`` (url, bad); rows with a null in either are left out.

    Tokens below the support, or in fewer bad urls than could prove the
    confidence, leave the transactions before FP-growth, which never could be in
    a rule.  So do tokens that every url has, and of tokens that the same urls
    have all but the first: adding one to a set changes none of its counts.
    """
    rows = labelled.filter("url is not null and bad is not null").select(tokens_of(F.col("url")).alias("tokens"), F.col("bad").cast("boolean").alias("bad"))
    keep = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "op7-rows")
    n = keep.count()
    schema = "tokens array<string>, support double, confidence double"
    if not n or not keep.filter("bad").head(1):
        return labelled.sparkSession.createDataFrame([], schema)
    fewest = max(support * n, least_count(risk, confidence))
    spread = keep.select("row", "bad", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count("*").alias("rows"), F.count_if("bad").alias("bad"),
        F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("set1"), F.sum(F.xxhash64(F.lit(7), "row").cast("decimal(38,0)")).alias("set2"))
    frequent = materialize(spread.filter((F.col("bad") >= fewest) & (F.col("rows") < n)).groupBy("rows", "bad", "set1", "set2").agg(
        F.min("token").alias("token")).select("token"), "op7-tokens")
    baskets = keep.select("row", "bad", F.explode("tokens").alias("token")).join(frequent, "token").groupBy("row", "bad").agg(F.collect_set("token").alias("tokens"))
    items = materialize(baskets.select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items")), "op7-baskets")
    many = items.count()
    if many < fewest:
        return labelled.sparkSession.createDataFrame([], schema)
    sets = FPGrowth(itemsCol="items", minSupport=max(fewest / many * (1 - 1e-9), 1e-12), minConfidence=confidence).fit(items).freqItemsets
    sets = materialize(sets.select(F.sort_array("items").alias("items"), "freq"), "op7-sets")
    bad = sets.filter(F.array_contains("items", BAD) & (F.size("items") > 1)).select(F.array_remove("items", BAD).alias("tokens"), F.col("freq").alias("bad"))
    every = materialize(bad.join(sets.select(F.col("items").alias("tokens"), "freq"), "tokens").select(
        "tokens", "bad", "freq", (F.col("bad") / n).alias("support"), (F.col("bad") / F.col("freq")).alias("confidence")), "op7-every")
    looked_at = every.count()
    # a rule goes if a part of it is at least as sure; parts of a frequent set are frequent, so the surest part is
    # handed up from size to size, over sets that are no rules too
    widest = every.filter(F.col("confidence") >= confidence).agg(F.max(F.size("tokens"))).first()[0]
    if widest is None:
        return labelled.sparkSession.createDataFrame([], schema)
    below, kept = None, None
    for size in range(1, widest + 1):
        level = every.filter(F.size("tokens") == size)
        if below is None:
            level = level.withColumn("surer", F.lit(0.0))
        else:
            parts = level.select("tokens", F.explode("tokens").alias("without")).select("tokens", F.array_remove("tokens", F.col("without")).alias("part"))
            surest = parts.join(below, "part").groupBy("tokens").agg(F.max("surest").alias("surer"))
            level = level.join(surest, "tokens")
        level = materialize(level, f"op7-size{size}")
        below = level.select(F.col("tokens").alias("part"), F.greatest("surer", "confidence").alias("surest"))
        rules = level.filter((F.col("confidence") >= confidence) & (F.col("surer") < F.col("confidence"))).drop("surer")
        kept = rules if kept is None else kept.unionByName(rules)
    if risk is not None:
        kept = kept.filter(binomial_tail(F.col("freq"), F.col("bad"), confidence) <= risk / looked_at)
    return kept.select("tokens", "support", "confidence")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``url`` of ``urls`` that a mined rule blocks."""
    known = urls.select("url").filter("url is not null").distinct().select("url", tokens_of(F.col("url")).alias("tokens"))
    df = rules.select(F.explode("tokens").alias("token")).distinct()
    rare = known.select(F.explode("tokens").alias("token")).join(df, "token").groupBy("token").count()
    filed = rules.withColumn("rule", F.xxhash64("tokens")).select("rule", "tokens", F.explode("tokens").alias("token")).join(rare, "token").groupBy("rule", "tokens").agg(
        F.min_by("token", F.struct("count", "token")).alias("token")).select(F.col("tokens").alias("needs"), "token")
    met = known.select("url", "tokens", F.explode("tokens").alias("token")).join(filed, "token")
    return met.filter(F.size(F.array_except("needs", "tokens")) == 0).select("url").distinct()


def fixed_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """struct(rule, verdict) of the longest fixed rule that fits, null if none; of equally long ones the first."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for own, prefix, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(own + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, mined: DataFrame, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url; other columns are ignored).

    A null url, or one without ``://``, has empty host and path and is allowed
    unless a mined rule fits its tokens.  Every row is judged, repeated ones
    alike; an empty table gives an empty result.
    """
    ship(pages.sparkSession)
    url = F.col("url")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(url).alias("host"), path_of(url).alias("path"))
    blocked = match(pages, mined).withColumn("blocked", F.lit(True))
    found = own.withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), rules)).join(blocked, "url", "left")
    return found.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"),
                        F.coalesce("fixed.verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))
