"""Periodic runs, phrases and url verdicts against brute force and SQL, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest
from oracle import compare, duck

from wardline.llm import phrases, queries, runs, urls
from wardline.llm.common import table
from pyspark.sql import functions as F


def runs_by_hand(words, least=12):
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def test_find_runs_equals_brute_force():
    rng = random.Random(3)
    seen = 0
    for _ in range(1500):
        n, letters = rng.randint(0, 80), rng.choice([1, 2, 2, 3, 6])
        words = [rng.randrange(letters) for _ in range(n)]
        if n > 4 and rng.random() < 0.6:
            s = rng.randrange(n)
            p = 1 + rng.randrange((n - s) // 2 + 1)
            words[s:] = [words[s + i % p] for i in range(n - s)]
        least = rng.choice([12, 12, 2, 5, 8])
        want = runs_by_hand(words, least)
        assert runs.find_runs(np.array(words, np.int64), least) == want
        seen += len(want)
    assert seen > 1000


def test_long_repetitive_texts_are_read_whole():
    assert runs.find_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    tail = np.concatenate([np.arange(1000), np.tile(np.arange(70_000), 3)])
    assert (1000, 210_000, 70_000) in runs.find_runs(tail)
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert runs.find_runs(np.array(b[:400])) == runs_by_hand(b[:400])


def digest(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and words:
        n = len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs_by_hand(words) if len(words) < 4000 else runs.find_runs(np.unique(words, return_inverse=True)[1].astype(np.int64))
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    top = min(((-n, s, p) for s, n, p in found), default=None)
    told = (None,) * 4 if top is None else (top[1], -top[0], top[2], 1000 * -top[0] // top[2])
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    short = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *told, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, short)))


def test_periodic_runs_query(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    got = Counter(tuple(r) for r in queries.op11_periodic_runs(spark, sf).collect())
    assert got == Counter(digest(r["doc_id"], r["text"]) for r in docs)
    assert sum(k[1] > 0 for k in got) >= len(docs) // 20


def test_periodic_runs_edges(spark):
    rows = [(1, "a b " * 20, "x"), (1, "a b " * 20, "x"), (2, None, "x"), (3, "", None), (4, " \t", None), (None, "z " * 13, None), (5, "A a " * 7, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").withColumnRenamed("runs", "n_words_")
    got = {(r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in runs.periodic_runs(docs, ["doc_id", "n_words_"]).collect()}
    assert got == {(1, 40, ((0, 40, 2),), "a b"), (2, 0, (), ""), (3, 0, (), ""), (4, 0, (), ""), (None, 13, ((0, 13, 1),), "z"), (5, 14, ((0, 14, 2),), "A a")}
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def grams_by_hand(rows, longest=3):
    f = defaultdict(Counter)
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            f[lang or "und"][""] += len(w)
            for m in range(1, longest + 1):
                f[lang or "und"].update(" ".join(w[i : i + m]) for i in range(len(w) - m + 1))
    return f


def phrases_by_hand(rows, least=10, first=2000, longest=3):
    out = []
    for lang, f in grams_by_hand(rows, longest).items():
        found = {tuple(p.split(" ")): a for p, a in f.items() if p and a >= least and " " in p}
        kept = []
        for w, a in found.items():
            cuts = [(10**6 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            inside = any(100 * b >= 50 * a for v, b in found.items() if len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v))))
            if not inside:
                kept.append((score, a, " ".join(w), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        kept.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, x, y, f[""], s) for i, (s, a, p, x, y) in enumerate(kept[:first])]
    return sorted(out)


def test_shard_index_equals_counting():
    rng = random.Random(5)
    for _ in range(300):
        longest = rng.choice([1, 2, 3, 4, 5])
        ids = np.array([rng.randrange(rng.choice([2, 4, 6])) for _ in range(rng.randint(1, 60))])
        if ids.any():
            known = np.unique(ids[ids > 0])
            ids = np.where(ids > 0, np.searchsorted(known, ids) + 1, 0)
            for k, (matrix, count) in enumerate(phrases.ShardIndex(ids, longest).phrases(), 1):
                want = Counter(tuple(ids[i : i + k].tolist()) for i in range(len(ids) - k + 1) if ids[i : i + k].all())
                assert {tuple(r): c for r, c in zip(matrix.tolist(), count.tolist())} == want


def test_phrases_query(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("lang", "text").collect()]
    got = sorted(tuple(r) for r in queries.op12_phrases(spark, sf).collect())
    assert got == phrases_by_hand(rows)
    assert not compare(queries.op12_phrases(spark, sf), duck(sf), queries.ORACLE["op12_phrases"])


def test_phrases_in_small_shards_and_longer_ones(spark):
    rng = random.Random(7)
    words = ["a", "b", "c", "d", "É", "x-y", "C++"]
    rows = [(rng.choice(["en", "de", None]), " ".join(rng.choice(words) + rng.choice(["", "", "", ".", "\n", "\x0b", "?!"]) for _ in range(rng.randint(0, 200)))) for _ in range(60)]
    rows += [("en", None), (None, ""), ("en", "a b c d " * 400), ("en", "...,,,"), ("fr", "UPPER lower"), ("en", "\x1c\x85 b")]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).repartition(5)
    for longest, size in ((3, 50), (4, 1000), (2, 2_000_000)):
        found = phrases.best(phrases.collocations(docs, longest=longest, shard_words=size))
        got = sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
        assert got == phrases_by_hand(rows, longest=longest)
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_score_is_exact_beyond_64_bits(spark):
    a, left, right = 123_456_789_012, 987_654_321_098, 876_543_210_987
    rows = [("en", "x y", a), ("en", "x", left), ("en", "y", right), ("en", "", left + right)]
    original, phrases.phrase_counts = phrases.phrase_counts, lambda *_: spark.createDataFrame(rows, "lang string, phrase string, a long")
    try:
        assert phrases.collocations(spark.range(0)).first()["score"] == 10**6 * a * a // (left * right)
    finally:
        phrases.phrase_counts = original


def url_by_hand(rows, texts):
    """(host, path, rule, verdict) per url, all rows in memory."""
    counts = Counter()
    for t in texts:
        plain = re.sub(r"<(?:script|style)\b[^<>]*>[^<]*|<[^<>]*>|&#?[a-zA-Z0-9_]+;", " ", t or "")
        plain = re.sub("[A-Z]", lambda m: m.group().lower(), plain)
        counts.update(re.findall(r"[^\W\d_]+", plain))
    total = sum(counts.values())

    def toks(s):
        s = re.sub("[A-Z]", lambda m: m.group().lower(), s)
        return ["#" if re.fullmatch("[0-9]+", t) else t for t in re.findall(r"[^\W_]+", s)]

    judged, by_class = [], {"block": Counter(), "allow": Counter()}
    sizes = Counter()
    for url in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", rest, re.S).groups()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        fits = [(len(r), r, v) for v, r in urls.RULES for name, start in [(r[: r.index("/")], r[r.index("/") :])]
                if (host == name or host.endswith("." + name)) and path.startswith(start)]
        rule, verdict = max(fits)[1:] if fits else (None, None)
        inside = []
        for label in toks(host):
            known = {(i, n): counts[label[i : i + n]] for i in range(len(label)) for n in range(1, 21) if i + n <= len(label) and counts[label[i : i + n]]}
            inside += urls.cut_words(label, known, total)
        told = inside + toks(path)
        judged.append((host, path, rule, verdict, told))
        if verdict:
            by_class[verdict].update(told)
            sizes[verdict] += 1
    size = len(by_class["block"] | by_class["allow"])
    every = {c: sum(by_class[c].values()) + size for c in by_class}

    def odds(block, allow):
        return round(1e6 * (log(block) - log(allow)))

    out = []
    for host, path, rule, verdict, told in judged:
        score = odds(sizes["block"] + 1, sizes["allow"] + 1) if sizes else 0
        for t in told:
            if by_class["block"][t] or by_class["allow"][t]:
                score += odds(by_class["block"][t] + 1, every["block"]) - odds(by_class["allow"][t] + 1, every["allow"])
        out.append((host, path, rule, verdict or ("block" if score > 0 else "allow"), None if rule else score))
    return out


def test_url_filter_query(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html").collect()
    got = Counter((r["host"], r["path"], r["rule"], r["verdict"], r["odds"]) for r in queries.op13_url_filter(spark, sf).collect())
    want = Counter(url_by_hand([r["url"] for r in pages], [r["html"] for r in pages]))
    near = lambda c: Counter({(*k[:4],): 0 for k in c}) + Counter(k[:4] for k in c.elements())
    assert near(got) == near(want)
    a = sorted(x[4] for x in got.elements() if x[4] is not None)
    b = sorted(x[4] for x in want.elements() if x[4] is not None)
    assert len(a) == len(b) and all(abs(x - y) <= 3 for x, y in zip(a, b))


def test_url_parts_and_rules(spark):
    rows = [
        ("http://A.Net/x?q#f", "a.net", "/x", "net/"), ("http://net/", "net", "/", "net/"), ("http://a.net", "a.net", "", None),
        ("http://planet/", "planet", "/", None), ("https://b.example.net/en/1", "b.example.net", "/en/1", "example.net/en/"),
        ("https://example.net/EN/", "example.net", "/EN/", "net/"), ("http://x.example.com/de/", "x.example.com", "/de/", "example.com/de/"),
        ("http://x.org/fr/a", "x.org", "/fr/a", "org/fr/"), ("http://x.org/fr", "x.org", "/fr", None), ("a://b://c/d", "b:", "//c/d", None),
        (None, "", "", None), ("", "", "", None), ("no scheme.net/", "", "", None), ("http://a.net:80/", "a.net:80", "/", None),
        ("http://ÄB.net/\n/é", "Äb.net", "/\n/é", "net/"), ("http://?x://y", "", "", None),
    ]
    pages = spark.createDataFrame([(i, r[0], "x") for i, r in enumerate(rows)] * 2, "page_id long, url string, host string")
    texts = spark.createDataFrame([("spam farm spam farm",), (None,)], "text string")
    got = urls.judge(pages, texts).collect()
    assert Counter((r["url"], r["_host"], r["_path"], r["_rule"]) for r in got) == Counter(rows * 2)
    by_hand = Counter((h, p, r, v) for h, p, r, v, _ in url_by_hand([r[0] for r in rows] * 2, ["spam farm spam farm"]))
    assert Counter((r["_host"], r["_path"], r["_rule"], r["_verdict"]) for r in got) == by_hand
    assert urls.judge(pages.limit(0), texts).count() == 0
    assert {r["_verdict"] for r in urls.judge(pages.filter("url is null"), texts.limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize("label, words", [("spamfarm", ["spam", "farm"]), ("farmspamx", ["farm", "spam", "x"]), ("qqq", ["qqq"]), ("farms", ["farms"])])
def test_cut_words(label, words):
    counts = {"spam": 50, "farm": 40, "s": 1, "farms": 3}
    known = {(i, n): counts[label[i : i + n]] for i in range(len(label)) for n in range(1, 21) if label[i : i + n] in counts and i + n <= len(label)}
    assert urls.cut_words(label, known, 1000) == words
