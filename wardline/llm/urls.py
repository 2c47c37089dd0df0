"""Url filters: fixed rules first, then naive Bayes over words segmented out of host names and paths.

A rule names a host and the start of a path; it fits the host and all its subdomains, and the longest
rule that fits decides. Urls that a rule decides are the labelled ones: from them, multinomial naive
Bayes learns the tokens of blocked and of allowed urls, and judges the others.

Host names run words together. Each label of a host (a run of letters and digits) is cut into the most
probable sequence of words, by Viterbi over unigram probabilities counted in all given texts; a piece
that is no known word costs as much as one unseen word, and a factor 10 more with each character.
Paths are cut at anything but letters and digits. Runs of digits count as the one token ``#``.

Labels, hosts and paths are segmented and scored once per distinct value: substrings of labels meet
the counted words in a join, tokens meet the model in a join, and pages meet two small scores at the end. No
model is sent round as a whole, so vocabularies may grow with the corpus. Log-odds are whole millionths, so that sums
don't depend on their order.

Defined results: a null url, or one without ``://``, has an empty host and path and gets the verdict of the
classes' sizes alone; odds that are even allow. Without any page that a rule decides all is allowed.
Repeated rows count each and get the same verdict; extra columns take no part; an empty table gives no rows.
"""

from __future__ import annotations

from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import ship
from wardline.session import written

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
TOKEN = r"[\p{L}\p{N}]+"
LONGEST_WORD = 20


def lower_ascii(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; then up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def tokens(col: Column) -> Column:
    """Tokens of a text, A-Z lower-cased; digits alone are ``#``."""
    found = F.regexp_extract_all(lower_ascii(col), F.lit(TOKEN), F.lit(0))
    return F.transform(found, lambda t: F.when(t.rlike(r"^[0-9]+$"), F.lit("#")).otherwise(t))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): words of column ``text``, counted over all rows. Markup doesn't count."""
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), r"<(?:script|style)\b[^<>]*>[^<]*|<[^<>]*>|&#?\w+;", " ")
    found = F.regexp_extract_all(lower_ascii(plain), F.lit(r"\p{L}+"), F.lit(0))
    return texts.select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def cut_words(label: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The most probable words of ``label``. ``known``: counts by (start, length); ``total``: all counted words.

    Of equally probable cuts the one with the longest last word counts, then the one before it."""
    best, back = [0.0], [0]
    unseen = log(max(total, 1) + 1)
    for end in range(1, len(label) + 1):
        cost, chosen = float("inf"), end - 1
        for start in range(max(0, end - LONGEST_WORD), end):
            n = known.get((start, end - start))
            here = best[start] + (unseen - log(n) if n else unseen + log(10) * (end - start))
            if here < cost:
                cost, chosen = here, start
        best.append(cost)
        back.append(chosen)
    words, end = [], len(label)
    while end:
        words.append(label[back[end] : end])
        end = back[end]
    return words[::-1]


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) of distinct ``labels``."""
    ship(labels.sparkSession)
    at = labels.select("label", F.explode(F.expr("sequence(0, length(label) - 1)")).alias("start"))
    # A label is as long as its substrings are many; only those that are words are gathered.
    parts = at.select("label", "start", F.explode(F.expr(f"sequence(1, least({LONGEST_WORD}, length(label) - start))")).alias("length"))
    parts = parts.withColumn("word", F.expr("substring(label, start + 1, length)"))
    known = parts.join(counts, "word").groupBy("label").agg(F.collect_list(F.struct("start", "length", "n")).alias("known"))
    total = counts.agg(F.sum("n")).first()[0] or 0

    @F.pandas_udf("array<string>")
    def cut(label: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([
            cut_words(name, {(r["start"], r["length"]): r["n"] for r in (found if found is not None else ())}, total)
            for name, found in zip(label, known)
        ])

    return labels.join(known, "label", "left").select("label", cut("label", "known").alias("words"))


def host_tokens(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, token, k): tokens of distinct ``hosts``, with ``k`` occurrences."""
    labels = hosts.select("host", F.explode(tokens(F.col("host"))).alias("label"))
    cut = segmented(labels.select("label").distinct(), counts)
    return labels.join(cut, "label").select("host", F.explode("words").alias("token")).groupBy("host", "token").agg(F.count(F.lit(1)).alias("k"))


def odds(block, allow) -> Column:
    """Millionths of the log of a ratio."""
    return F.round(1e6 * (F.log(block) - F.log(allow))).cast("long")


def token_odds(counts: DataFrame) -> DataFrame:
    """(token, odds): log P(token|block) - log P(token|allow), add-one smoothed, of tokens counted per class."""
    total = counts.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count(F.lit(1)).alias("size")).first()
    every = {c: F.lit((total[c] or 0) + total["size"]) for c in ("block", "allow")}
    ratio = odds(F.col("block") + 1, every["block"]) - odds(F.col("allow") + 1, every["allow"])
    return counts.select("token", ratio.alias("odds"))


def judge(pages: DataFrame, texts: DataFrame, rules=RULES) -> DataFrame:
    """Columns of ``pages`` (with ``url``) and ``_host``, ``_path``, ``_rule``, ``_odds`` (null where a rule decides), ``_verdict``.

    ``texts``: column ``text`` to count words in."""
    host, path = url_parts(F.col("url"))
    rows = pages.withColumns({"_host": host, "_path": path})
    rule, said = fitting_rule(F.col("_host"), F.col("_path"), rules)
    # Paths with equal tokens get equal scores.
    rows = rows.withColumns({"_rule": rule, "_said": said, "_tokens": F.array_join(tokens(F.col("_path")), " ")})
    labelled = F.col("_said").isNotNull()
    each = {c: F.count(F.when(F.col("_said") == c, 1)).alias(c) for c in ("block", "allow")}
    urls = written(rows.groupBy("_host", "_tokens").agg(*each.values()), "urls")  # pre-aggregated: a hot host is few rows
    sums = [F.sum(c).alias(c) for c in ("block", "allow")]

    hosts = urls.groupBy(F.col("_host").alias("host")).agg(*sums)
    in_host = written(host_tokens(hosts.select("host"), written(word_counts(texts), "words")), "host-tokens")
    paths = urls.groupBy(F.col("_tokens").alias("path")).agg(*sums)
    in_path = paths.select("path", F.explode(F.split("path", " ")).alias("token"), "block", "allow").filter("token <> ''")

    counted = hosts.join(in_host, "host").select("token", *[(F.col(c) * F.col("k")).alias(c) for c in ("block", "allow")])
    counted = counted.unionByName(in_path.select("token", "block", "allow")).groupBy("token").agg(*sums).filter("block + allow > 0")
    model = written(token_odds(written(counted, "token-counts")), "url-model")
    block, allow = ((n or 0) + 1 for n in urls.agg(*sums).first())
    prior = odds(F.lit(block), F.lit(allow))

    # A token in neither class has even odds and no row.
    by_host = in_host.join(model, "token").groupBy("host").agg(F.sum(F.col("odds") * F.col("k")).alias("host_odds"))
    by_path = in_path.join(model, "token").groupBy("path").agg(F.sum("odds").alias("path_odds"))
    by_host, by_path = written(by_host, "host-odds"), written(by_path, "path-odds")
    scored = (
        rows.join(by_host.withColumnsRenamed({"host": "_h", "host_odds": "_ho"}), F.col("_host") == F.col("_h"), "left")
        .join(by_path.withColumnsRenamed({"path": "_p", "path_odds": "_po"}), F.col("_tokens") == F.col("_p"), "left")
    )
    total = prior + F.coalesce("_ho", F.lit(0)) + F.coalesce("_po", F.lit(0))
    verdict = F.coalesce("_said", F.when(total > 0, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select(*pages.columns, "_host", "_path", "_rule", F.when(~labelled, total).alias("_odds"), verdict.alias("_verdict"))
