"""Every dealt query against SQL, a brute-force version, a round trip or held-out labels, and edge cases."""

from __future__ import annotations

import math
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import compare, duck

import corpus_pipeline
from pyspark.sql import functions as F

from wardline.llm import backoff, chat, langid, mixing, neardup, packing, queries, toxicity, wrappers
from wardline.llm.common import likely_among, sole_cache, table, words

SCHEMAS = {
    "documents": pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()),
                            ("size", pa.int64()), ("component", pa.string())]),
    "embeddings": pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("score", pa.string()), ("cell", pa.int64())]),
    "pages": pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("host", pa.string())]),
    "labels": pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("score", pa.string())]),
    "conversations": pa.schema([("conv_id", pa.int64()), ("turn", pa.int32()), ("role", pa.string()), ("text", pa.string())]),
}

LONG = " ".join(f"w{i % 977} the" for i in range(30_000))
SAME = "one two three four five six seven eight nine ten eleven twelve"
DOCS = [
    (1, SAME, "en", "a"), (2, SAME, "en", None), (3, SAME + " more", "en", "a"), (3, SAME + " more", "en", "a"),
    (4, "", "de", "b"), (5, None, "de", "b"), (6, LONG, None, "b"), (7, " \t\n", None, None), (8, "solo", "en", ""),
    (9, "12 34 56", "en", "a"), (10, "ä ö ü ß \U0001f600", "de", "c"), (None, "no id here at all", "en", "c"), (None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    root = tmp_path_factory.mktemp("odd")
    v = [1.0, 0.5, -0.25, 0.0]
    vectors = [(i, [x + (i % 3) for x in v]) for i in range(0, 45)]
    vectors += [(20, [1.0, 1.5, 0.75, 1.0]), (60, None), (80, [1.0, None, 0.0, 0.0]), (100, [float("nan")] * 4),
                (120, [0.0] * 4), (140, [float("inf")] * 4), (None, v)]
    rows = {
        "documents": [(*d, 7, "x") for d in DOCS],
        "embeddings": [(*e, "s", 1) for e in vectors],
        "pages": [
            (1, "http://h/a", "<html><body><nav>menu</nav><p>One &amp; two</p><p>Three</p></body></html>", "x"),
            (2, None, None, None), (3, "http://h/b", "", None), (4, "", "<p>unclosed <b>text", None), (None, None, "plain", None),
            (1, "http://h/a", "<html><body><nav>menu</nav><p>One &amp; two</p><p>Three</p></body></html>", "x"),
        ],
        "labels": [(1, 0, ""), (6, 1, ""), (8, None, ""), (None, 1, ""), (10, 1, "")],
        "conversations": [
            (1, 0, "user", "hi"), (1, 1, "assistant", "\\e </turn>### "), (1, None, "assistant", None), (2, 0, None, "x"),
            (None, 0, "assistant", ""), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie"), (3, 0, "a: b", "\\"),
        ],
    }
    for name, schema in SCHEMAS.items():
        made = [pa.array([r[i] for r in rows[name]], f.type) for i, f in enumerate(schema)]
        pq.write_table(pa.Table.from_arrays(made, schema=schema), root / f"{name}.parquet")
    return str(root)


@pytest.fixture(scope="module")
def nothing(tmp_path_factory):
    root = tmp_path_factory.mktemp("nothing")
    for name, schema in SCHEMAS.items():
        pq.write_table(schema.empty_table(), root / f"{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, nothing, name):
    got = queries.QUERIES[name](spark, nothing).collect()
    assert [r["conv_id"] for r in got] == ([-7] if name == "op4_chat_format" else [])


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_nulls_ties_repeats_and_long_texts(spark, odd, name):
    got = queries.QUERIES[name](spark, odd).collect()
    if name in ("op1_source_mix", "op3_backoff_score", "op5_near_duplicates", "op6_language", "op10_toxicity"):
        assert Counter(r["doc_id"] for r in got) == Counter(d[0] for d in DOCS)
    elif name == "op7_main_text":
        assert len(got) == 6 and {r["text"] for r in got if r["page_id"] in (2, 3)} == {""}
    elif name == "op4_chat_format":
        assert len(got) == 5
    elif name in ("op2_exact_topk", "op9_nearest"):
        assert got and all(r["vec_id"] not in (60, 80, 100, 140) and r["vec_id"] != r["query_id"] for r in got)


def brute_components(texts, k):
    sets = {}
    for i, t in texts:
        w = words(t)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    where = defaultdict(list)
    for i in ids:
        for s in sets[i]:
            where[s].append(i)
    for a in ids:
        common = Counter(b for s in sets[a] for b in where[s] if b < a)
        for b, n in common.items():
            if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op5_near_duplicates(spark, sf).collect()}
    assert got == brute_components([tuple(d) for d in docs], 4)


def usable(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding").collect()
    return {r[0]: np.array(r[1], float) for r in rows if r[1] is not None and None not in r[1] and np.isfinite(np.array(r[1], float)).all()}


def test_exact_top_k_equals_brute_force(spark, sf):
    v = {i: np.floor(64 * x).astype(np.int64) for i, x in usable(spark, sf).items()}
    ids = np.array(sorted(v))
    m = np.array([v[i] for i in ids])
    want = {}
    for q in ids[ids % 20 == 0]:
        s = m @ v[q]
        best = [(int(ids[j]), int(s[j])) for j in np.lexsort((ids, -s)) if ids[j] != q][:20]
        want.update({(int(q), r + 1): b for r, b in enumerate(best)})
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in queries.op2_exact_topk(spark, sf).collect()}
    assert got == want


def test_neighbours_recall(spark, sf):
    v = {i: x / np.linalg.norm(x) for i, x in usable(spark, sf).items() if np.any(x)}
    ids = np.array(sorted(v))
    m = np.array([v[i] for i in ids])
    want = {(int(q), int(ids[j])) for q in ids[ids % 50 == 0] for j in [j for j in np.argsort(-(m @ v[q])) if ids[j] != q][:5]}
    rows = queries.op9_nearest(spark, sf).collect()
    assert len(want & {(r["query_id"], r["vec_id"]) for r in rows}) >= 0.9 * len(want)
    assert all(math.isclose(r["score"], float(v[r["query_id"]] @ v[r["vec_id"]]), abs_tol=1e-9) for r in rows)


def test_base_score_and_model_gain(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs}
    c = Counter(w for d, t in docs if not held[d] for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    rows = {r["doc_id"]: r for r in queries.op3_backoff_score(spark, sf).collect()}
    for d, t in docs:
        seq = [*words(t), None]
        r = rows[d]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[d], len(seq), n)
        assert r["n_known"] == sum(c[w] > 0 for w in seq)
        literal = sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in seq)
        assert math.isclose(r["base_score"], literal, rel_tol=1e-9)
    held_rows = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held_rows) > sum(r["base_score"] for r in held_rows)


def test_mix_meets_targets(spark, sf):
    plan = queries.op1_source_mix(spark, sf).collect()
    again = queries.op1_source_mix(spark, sf).collect()
    assert sorted(map(tuple, plan)) == sorted(map(tuple, again))
    sources = {r["doc_id"]: r["source"] for r in table(spark, sf, "documents").select("doc_id", "source").collect()}
    taken, target = Counter(), {}
    for r in plan:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[sources[r["doc_id"]]] += r["taken"]
        target[sources[r["doc_id"]]] = r["target"]
    assert math.isclose(sum(target.values()), sum(r["size"] for r in plan), rel_tol=1e-9)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.02 * t + 200


def test_mix_targets_and_quotas_equal_direct_apportionment(spark, sf):
    """Targets by filling up level by level, quotas by handing out seats one at a time."""
    made = mixing.plan(table(spark, sf, "documents"))
    rows = {r["source"]: r for r in made.sources.collect()}
    names = sorted((s for s in rows if s is not None)) + ([None] if None in rows else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    size = {s: rows[s]["source_size"] for s in names}
    total, target, open_ones = sum(size.values()), {}, set(names)
    while True:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in open_ones)
        capped = {s for s in open_ones if level * weight[s] > 3 * size[s]}
        if not capped:
            target |= {s: level * weight[s] for s in open_ones}
            break
        target |= {s: 3.0 * size[s] for s in capped}
        open_ones -= capped
    assert all(math.isclose(rows[s]["target"], target[s], rel_tol=1e-9) for s in names)
    seats = Counter()
    for _ in range(round(total / 16)):
        seats[max(names, key=lambda s: (target[s] / (seats[s] + 0.5), -names.index(s)))] += 1
    assert all(rows[s]["quota_blocks"] == seats[s] for s in names)


def test_rows_that_repeat_are_mixed_as_planned(spark):
    rows = [(1, "a b c d e f", "a", "x")] * 40 + [(2, "g h " * 30, "a", "x"), (None, "i j", "b", "x"), (3, "k l m " * 200, "b", "x")]
    rows += [(i, f"w{i} v{i} u{i}", "c", "x") for i in range(10, 400)] + [(4, None, "a", "x"), (5, "", None, "x"), (6, " \t one\ntwo ", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    for shard_rows in (4096, 16):
        made = mixing.plan(docs, shard_rows=shard_rows)
        planned = Counter()
        for r in mixing.mix(docs, shard_rows=shard_rows).collect():
            assert 0 <= r["taken"] <= 3 * r["size"]
            planned[r["doc_id"]] += r["taken"]
        given = Counter()
        for r in mixing.mixed_documents(docs, made).collect():
            given[r["doc_id"]] += len(words(r["text"]))
        assert +given == +planned and sum(given.values()) > 0


def test_an_id_with_two_texts_links_neither_group(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, a, "x"), (5, b, "x"), (7, a + " tail", "x"), (3, b + " tail", "x"), (9, a, "x"), (None, b, "x"), (11, "alone", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs, k=4).collect())
    assert got == Counter([(5, 27, 5), (5, 27, 3), (7, 28, 5), (3, 28, 3), (9, 27, 5), (None, 27, 3), (11, 1, 11)])


def test_pipeline_keeps_one_row_of_each_group(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, a), (2, a), (3, a + " more"), (1, b), (None, b), (None, "c d e f g h"), (None, "c d e f g h"), (4, "only"), (None, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    kept = Counter(("a" if t.startswith("a0") else "b" if t.startswith("b0") else t) if t else t for t in (r["text"] for r in got.collect()))
    assert kept == {"a": 1, "b": 1, "c d e f g h": 1, "only": 1, None: 1, "": 1}


def test_only_texts_of_groups_are_shuffled(spark, monkeypatch, capsys):
    """Texts of other documents stay where they are, and a task's texts go through one Python step."""
    of = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    docs = spark.createDataFrame([(i, of(i if i else 1), "x") for i in range(40)], "doc_id long, text string, lang string").repartition(4)
    steps, write = [], neardup.written

    def seen(df, purpose, *by):
        if purpose == "dup-sets":
            df.explain()
            steps.append(capsys.readouterr().out.count("MapInArrow"))
        return write(df, purpose, *by)

    monkeypatch.setattr(neardup, "written", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = corpus_pipeline.drop_near_duplicates(spark, docs, "").withColumn("at", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert steps == [1]
    assert sorted(r["doc_id"] for r in got) == [0, *range(2, 40)]
    assert len({r["at"] for r in got}) >= 4


def test_driver_rows_need_no_python_worker(spark):
    docs = spark.createDataFrame([(i, f"some words {i}", ["en", "de"][i % 2]) for i in range(40)], "doc_id long, text string, lang string")
    steps = []
    made = type(spark).createDataFrame

    def seen(self, data, *a, **b):
        steps.append(type(data))
        return made(self, data, *a, **b)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(spark), "createDataFrame", seen)
        assert sorted(langid.sampled(docs, 5, 10_000, 1)) == ["de", "en"]
    assert steps == [pa.Table]


def test_packing_is_whole_and_gapless(spark, sf):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.vocabulary_path())
    rows = queries.op8_packing(spark, sf).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for d, text in table(spark, sf, "documents").select("doc_id", "text").collect():
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        cut = sorted(by_doc[d], key=lambda r: r["piece"])
        assert len(cut) == -(-len(ids) // 2048)
        for i, r in enumerate(cut):
            part = ids[2048 * i : 2048 * (i + 1)]
            assert (r["start"], r["length"]) == (2048 * i, len(part))
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    for group in by_seq.values():
        at = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert len(by_seq) <= 1.05 * least + 1


def test_languages_and_toxicity_held_out(spark, sf):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    rows = [r for r in queries.op6_language(spark, sf).collect() if r["held_out"] and r["lang_pred"] != "und" and lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in rows) >= 0.9 * len(rows)


def test_toxicity_held_out(spark):
    """On the middle table: of the five held-out toxic documents of the smallest, three hold no word that
    the six toxic ones of its training rows share, so nothing can be learned that ranks them."""
    sf = "/root/testdata/sf0.01"
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, sf, "labels").select("doc_id", "toxic").collect()}
    held = [r for r in queries.op10_toxicity(spark, sf).collect() if r["held_out"] and toxic.get(r["doc_id"]) is not None]
    assert sum(r["predicted"] for r in held if toxic[r["doc_id"]] == 0) == 0
    high = [r["score"] for r in held if toxic[r["doc_id"]] == 1]
    low = [r["score"] for r in held if toxic[r["doc_id"]] == 0]
    assert len(high) >= 15 and np.mean([h > x for h in high for x in low]) >= 0.9


def test_segments_equal_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(200):
        s = rng.integers(-3, 4, 12).astype(float)
        best = max((s[i:j].sum() for i in range(12) for j in range(i + 1, 13)), default=0)
        found = toxicity.segments(s)
        assert all(math.isclose(s[a:b].sum(), x) for a, b, x in found)
        assert (max(x for *_, x in found) if found else 0) == max(best, 0)


def test_chat_round_trip(spark):
    texts = ["\\### Assistant: </turn> ok", "</turn>\n### user: x", "\\e\\h\\c\\\\", "", "plain", "\\"]
    rows = spark.createDataFrame([(1, i, "assistant", t) for i, t in enumerate(texts)], "conv_id long, turn int, role string, text string")
    done = chat.format_conversations(rows)
    got = done.select(chat.loss_text(done["formatted"], done["loss_spans"]).alias("x"), "turns").first()
    assert got["x"] == "".join(texts)
    assert [t["text"] for t in got["turns"]] == texts


def test_template_leaves_and_articles_stay(spark):
    page = "<html><body><div class=m><a href=x>Home</a><a href=y>News</a></div><div class=c><p>{}</p></div><div>All rights kept</div></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(f"Story number {i} tells of &lt;thing {i * 7}&gt;\n and more."), "h") for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r["page_id"]: r["text"] for r in wrappers.main_text(pages).collect()}
    assert got == {i: f"Story number {i} tells of <thing {i * 7}> and more." for i in range(8)}


@pytest.mark.parametrize("name", ["op4_chat_format", "op5_near_duplicates"])
def test_query_equals_sql(spark, sf, name):
    assert compare(queries.QUERIES[name](spark, sf), duck(sf), queries.ORACLE[name]) == []


def test_pipeline_stages_keep_columns_and_clean_documents(spark, sf):
    docs = table(spark, sf, "documents")
    start = docs.count()
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = corpus_pipeline.written(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == table(spark, sf, "documents").columns
    assert 0.5 * start < docs.count() <= start


def test_bit_maps_and_hubs_lose_no_link(spark):
    """300 variants of one text, many of them just above or below the threshold, against all pairs."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for v in range(300):
        own = list(base)
        for at in rng.choice(150, rng.integers(0, 9), replace=False):
            own[at] = f"x{v}-{at}"
        texts.append(" ".join(own))
    sets = [set(neardup.shingles(t, 4).tolist()) for t in texts]
    parent = list(range(300))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(300):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
                level, x = neardup._bit_map(neardup.shingles(texts[i], 4))
                y = neardup._bit_map(neardup.shingles(texts[j], 4))[1]
                differing = sum((p ^ q).bit_count() if p ^ q >= 0 else ((p ^ q) + 2**64).bit_count() for p, q in zip(x, y))
                assert level == 0 and differing <= len(sets[i] ^ sets[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, k=4).collect()}
    assert got == {i: find(i) for i in range(300)}


def _story(i, n, extra=""):
    return "".join(f"<p>Part {k} of story {i} tells of thing {i * 1000 + k}.{extra}</p>" for k in range(n))


def _told(i, n):
    return "\n\n".join(f"Part {k} of story {i} tells of thing {i * 1000 + k}." for k in range(n))


@pytest.mark.parametrize(
    "layout, sizes",
    [
        # A class name that sounds like a form, an advert that varies, a notice on every page inside the article.
        ("<body><div class='story-form'>{story}</div><div>Kept by all</div></body>", (5, 7, 9, 6)),
        ("<body><div class='article-search'>{story}</div></body>", (5, 7, 9, 6)),
        ("<body><div class='ad'>Buy {i}</div><article>{story}</article><footer>F {i}</footer></body>", (3, 2, 4, 3)),
        ("<body><article><p>Same notice on all pages.</p>{story}</article></body>", (5, 7, 9, 6)),
        ("<body><div id=x>{story}</div><div>All rights kept</div></body>", (250, 260, 251, 300)),
        ("<body><div id=x>{story}</div><div>All rights kept</div></body>", (1100, 900, 1000, 1200)),
        ("<body><table><tr><td>Home</td></tr></table><main>{story}</main><div>n{i}</div></body>", (5, 7, 9, 6)),
        ("<body><nav>N {i}</nav><section>{story}</section><!-- <p>no</p> --><aside>A {i}</aside></body>", (4, 4, 4, 4)),
        ("<body><article>{story}<div class='comments'>Reader {i} says no</div></article></body>", (5, 7, 9, 6)),
    ],
)
def test_wrapper_decides(layout, sizes):
    pages = [layout.format(i=i, story=_story(i, n)) for i, n in enumerate(sizes)]
    template, slot = wrappers.induce(pages)
    assert [wrappers.extract(p, frozenset(template), slot) for p in pages] == [_told(i, n) for i, n in enumerate(sizes)]


def test_near_copies_on_a_host_keep_what_they_share():
    pages = [f"<body><nav>{i}</nav><article>{_story(1, 9)}<p>Only {i}.</p></article></body>" for i in range(4)]
    template, slot = wrappers.induce(pages)
    assert [wrappers.extract(p, frozenset(template), slot) for p in pages] == [f"{_told(1, 9)}\n\nOnly {i}." for i in range(4)]


def test_wrapper_counts_all_pages_of_a_host(spark):
    """A line on 16 of 20 pages is no template, whichever pages of the host are looked at; one on all is."""
    page = "<body><article>{}{}</article><p>All rights kept</p></body>"
    rows, want = [], {}
    for h in range(30):
        for i in range(20):
            line = "<p>Seen by most.</p>" if i < 16 else ""
            rows.append((20 * h + i, f"http://h{h}.example/{i}", page.format(_story(20 * h + i, 4), line)))
            want[20 * h + i] = _told(20 * h + i, 4) + ("\n\nSeen by most." if line else "")
    pages = spark.createDataFrame(rows + rows[:300], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in wrappers.main_text(pages).collect()} == want
    # Groups name the candidates, and joins find what one host's pages tell: 600 pages of one host.
    one = pages.withColumn("url", F.lit("http://one.example/"))
    found = wrappers.wrappers(one).collect()
    assert [(r["template"], r["slot"]) for r in found] == [wrappers.induce([h for _, _, h in rows])]
    assert len(found[0]["template"]) == 1


def test_single_pages_are_read_by_their_own_marks():
    cases = {
        "<div class='story-form'><p>Told.</p></div>": "Told.",
        "<header>H</header><article><header><h1>T</h1></header><p>A<br>B &amp; C</p></article><p>out</p>": "T\n\nA B & C",
        "<div class='cookie-notice'>Yes?</div><p>Long enough text here.</p>": "Long enough text here.",
        "<p>1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
        "<p title='a > b'>x</p><p>y <b>z</p>": "x\n\ny z",
        "<script>var t='</p>';</script><p>x</p><style>p{}</style>": "x",
        "<div role=navigation>n</div><div hidden>h</div><p>x</p>": "x",
        "<!-- <p>no -->yes<!-- open": "yes",
        "": "", "<p></p>": "", "<": "<",
    }
    assert {page: wrappers.extract(page) for page in cases} == cases


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<div>", "<script ", "<!-", "<", "</", '<p class="a'])
def test_hostile_pages_take_linear_time(piece):
    """A megabyte each; ends in seconds or, if time grew with the square of the length, in hours."""
    page = piece * (1_000_000 // len(piece)) + ">told"
    start = time.process_time()
    wrappers.extract(page)
    assert time.process_time() - start < 20


def test_another_operator_drops_the_vocabulary_of_packing():
    kept = packing._encoders.copy()
    packing._encoders["here"] = packing.Encoder(queries.vocabulary_path())
    try:
        sole_cache(packing._encoders)
        assert "here" in packing._encoders
        sole_cache()
        assert not packing._encoders
    finally:
        packing._encoders.clear()
        packing._encoders.update(kept)


def test_words_take_the_short_way_to_the_same_ids(monkeypatch):
    """Plain words go straight to the merges, without a pass of the tokenizer for each new word; ids are the same."""
    encoder = packing.Encoder(queries.vocabulary_path())
    letters = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x180), 0x301, 0x3A3, 0x130, 0x212A, 0x1E9E, 0x4E2D, 0x1F600)]
    rng = np.random.default_rng(4)
    made = ["".join(rng.choice(letters, rng.integers(1, 12))) for _ in range(4000)]
    made += [a + b + a for a in letters for b in ("", "z", "'", "7", "..")] + ["it's", "<|endoftext|>", "A<|ENDOFTEXT|>b", "x<|y", "don't.Stop,"]
    text = " ".join(made)
    for given in (text, text.replace("<|", "")):
        want = encoder.tokenizer.encode(given, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(given), "<u4").tolist() == [*want, 0]
    whole = []
    monkeypatch.setattr(encoder, "_whole", lambda text: whole.append(text) or [])
    encoder.clear()
    encoder.encode("Unbekannte W\xf6rter, hareing.&&& 1234 na\xefve")
    assert not whole


def test_a_pair_meets_in_one_table_and_texts_stay_in_place(spark, capsys):
    """Classes that share many tables are compared once, and rows of wanted keys are found without a shuffle."""
    bands, none = 12, [f"0L AS {b}" for b in neardup.MAP]
    of = lambda *a: [100 * i + x for i, x in enumerate(a)]  # noqa: E731  as hashes do, sub-keys at different places differ
    one, three, four = [(of(*[a] * 3, *[b] * 9), of(c, *[d] * 11)) for a, b, c, d in ((7, 7, 8, 8), (5, 7, 6, 8), (5, 1, 6, 2))]
    keys = {1: one, 2: one, 3: three, 4: four}
    made = [
        (f"{i},{j},{left[i]},{right[j]}", i, j, k, left, right)
        for k, (left, right) in keys.items() for i in range(bands) for j in range(bands)
    ]
    rows = spark.createDataFrame(made, "at string, i int, j int, id long, left array<long>, right array<long>")
    tables = rows.withColumn("bucket", F.xxhash64("at"))
    described = rows.select("id", "left", "right").distinct().selectExpr("*", "100 AS n", *none)
    components = spark.createDataFrame([(k, k) for k in keys], "id long, component long")
    alone = lambda rows: sorted((r["a"], r["b"]) for r in rows.collect())
    want = [(1, 2), (1, 3), (2, 3), (3, 4)]
    assert alone(neardup.meeting(tables.join(components, "id").drop("left", "right").join(described, "id"), 80)) == want
    mixed = neardup.mixed_tables(tables, components)
    assert mixed.select("bucket").distinct().count() < 10
    assert alone(neardup.meeting(mixed.join(described, "id"), 80)) == want

    docs = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    found = likely_among(docs, "doc_id", spark.createDataFrame([(5,), (2999,), (-1,)], "rep long"))
    found.explain()
    assert "Exchange" not in capsys.readouterr().out
    assert [r["doc_id"] for r in found.orderBy("doc_id").collect()] == [5, 2999]
    assert {5, 2999} <= {r["doc_id"] for r in likely_among(docs, "doc_id", spark.createDataFrame([(5,), (2999,)], "rep long"), 70).collect()}


def test_backoff_memory():
    """An automaton keeps one dictionary of arcs and plain numbers, not an object for each number."""
    import tracemalloc

    n = 50_000
    tokens = np.random.default_rng(3).integers(0, 20_000, n).astype("<i4")
    vocab = np.random.default_rng(4).integers(0, 2**63, 20_000, "u8")
    row = {"tokens": backoff._pack(tokens), "vocab": vocab.tobytes(), "ends": list(range(100, n + 1, 100))}
    grams = backoff.Grams(row, 2)
    totals = [np.bincount(inverse, minlength=len(keys)) for keys, _, inverse in grams.levels]
    tracemalloc.start()
    automaton = backoff.Automaton(grams, totals, 500, n, 20_000, 3.0, 0.8)
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 160 * len(automaton.arcs), kept / len(automaton.arcs)
