"""The queries of this subpackage: each applies one operator to a whole table.

What they return beside ids are digests of the operators' outputs, so that results of any size can
be compared. ``ORACLE`` has SQL where the rows can be said in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import (
    backoff, chat, langid, mixing, multiindex, neardup, packing, phrases, runs, topk, toxicity, urls, wrappers,
)
from wardline.llm.common import WORD, fold, table

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op3_backoff_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 7) != 2).alias("training"))
    return backoff.score(docs).select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    done = chat.format_conversations(rows.unionByName(added))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return done.select(
        "conv_id", "n_turns", F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(fold("doc_id", 4) != 2))
    return langid.predict(docs, model, keep=["doc_id"]).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"
    )


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), vocabulary_path())
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.neighbours(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs.filter(fold("doc_id", 3) != 1), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("passages").alias("n_passages"),
    )


def with_planted_run(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs``; in one document of ten, all words from one on repeat a period's words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    w = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n, g = F.size("_w").cast("long"), F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    later = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda i: F.get(F.col("_w"), (a + i % p).cast("int")))
    words = F.concat(F.slice("_w", F.lit(1), a.cast("int")), later)
    rows = docs.select("doc_id", "text", F.when((h % 10 == 0) & F.col("text").rlike(WORD), w).alias("_w"))
    return rows.select("doc_id", F.when(F.col("_w").isNull(), F.col("text")).otherwise(F.array_join(words, " ")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_run(table(spark, sf_dir, "documents")), keep=["doc_id"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    longest = F.array_sort(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"].alias("n"))))
    top = F.get(longest, F.lit(0))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["n"].alias("length"),
        top["period"].alias("period"), F.floor(1000 * top["n"] / top["period"]).alias("exponent_milli"),
        F.sha2(F.concat(lines, F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit(""))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(table(spark, sf_dir, "documents"))
    return phrases.best(found).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = urls.judge(pages.select("page_id", "url"), pages.select(F.col("html").alias("text")))
    return judged.select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
        F.col("_verdict").alias("verdict"), F.col("_odds").alias("odds"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_source_mix, op2_exact_topk, op3_backoff_score, op4_chat_format, op5_near_duplicates, op6_language,
        op7_main_text, op8_packing, op9_nearest, op10_toxicity, op11_periodic_runs, op12_phrases, op13_url_filter, pipeline,
    )
}

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x20\\x09-\\x0D]+')"
)

ORACLE = {
    "op12_phrases": """
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(p, '[ \\t]+'), lambda x: x <> '') AS w
  FROM (
    SELECT lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
    FROM documents
  )
), g AS (
  SELECT lang, m, list_slice(w, i, i + m - 1) AS words
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM t, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m)
), f AS MATERIALIZED (
  SELECT lang, m, array_to_string(words, ' ') AS phrase, any_value(words) AS words, count(*) AS a FROM g GROUP BY ALL
), n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
), c AS (SELECT * FROM f WHERE m > 1 AND a >= 10
), k AS (
  SELECT lang, phrase, a, words, m, unnest(range(1, m)) AS k FROM c
), s AS (
  SELECT k.lang, k.phrase, k.a, k.k, x.a AS l, y.a AS r,
    ((1000000::HUGEINT * k.a * k.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.words[1:k.k], ' ')
    JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.words[k.k + 1:k.m], ' ')
), z AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), b AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(words[1:2], ' ') AS phrase, a FROM c WHERE m = 3
    UNION ALL SELECT lang, array_to_string(words[2:3], ' '), a FROM c WHERE m = 3
  ) GROUP BY ALL
), d AS (
  SELECT z.lang, z.phrase, z.a, z.l, z.r, n.n, z.score
  FROM z JOIN n ON n.lang = z.lang LEFT JOIN b ON b.lang = z.lang AND b.phrase = z.phrase
  WHERE b.a IS NULL OR 100 * b.a < 50 * z.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM d QUALIFY rank <= 2000
""",
    "op2_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(min(embedding), lambda x: floor(64 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
""",
    "op4_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), f AS (
  SELECT *, contains(text, '### ') OR contains(text, '</turn>') OR contains(text, '\\') OR contains(text, '\e')
      OR contains(text, '\h') OR contains(text, '\c') OR ends_with(text, '\')
      OR contains(role, '</turn>') OR contains(role, '\\') OR contains(role, '\e') OR contains(role, '\h')
      OR contains(role, '\c') OR contains(role, ': ') OR ends_with(role, '\') AS clash FROM c
), g AS (
  SELECT *,
    CASE WHEN clash THEN replace(replace(replace(text, '\', '\\'), '</turn>', '\e'), '### ', '\h') ELSE text END AS t,
    CASE WHEN clash THEN replace(replace(replace(replace(role, '\', '\\'), '</turn>', '\e'), '### ', '\h'), ': ', '\c')
      ELSE role END AS r
  FROM f
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(r) + length(t) + 14)::BIGINT AS formatted_chars
FROM g GROUP BY conv_id
""",
    "op5_near_duplicates": f"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, {_WORDS} AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), e AS MATERIALIZED (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w JOIN c ON c.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
""",
}
