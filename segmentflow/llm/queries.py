"""The registered queries of this subpackage: each applies one operator,
with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)


@register("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from segmentflow.llm.byte_bpe import token_digests
    from segmentflow.llm.common import read_table

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_digests(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, keep=["doc_id"])


@register("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmentflow.llm import toxicity
    from segmentflow.llm.common import held_out, read_table

    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    model = toxicity.train(documents, ~held_out(), labels=labels)
    return toxicity.score_documents(documents.withColumn("held_out", held_out()), model, keep=["doc_id", "held_out"])


@register("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmentflow.llm import language_id
    from segmentflow.llm.common import held_out, read_table

    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(documents, ~held_out())
    documents = documents.withColumn("held_out", held_out())
    return language_id.identify(documents, model, keep=["doc_id", "held_out"])


@register("op2_token_store")
def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from segmentflow.llm import token_store
    from segmentflow.llm.common import read_table

    documents = read_table(spark, sf_dir, "documents")
    manifest = token_store.write_sequences(documents, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_store.read_documents(manifest)


@register("op5_near_dup")
def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmentflow.llm.common import read_table
    from segmentflow.llm.near_dup import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"))


@register("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmentflow.llm import pii
    from segmentflow.llm.common import read_table

    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(documents, pii.train(documents), keep=["doc_id"])
    count = lambda k: F.size(F.filter("pii", lambda m: m["base"] & (m["kind"] == k))).cast("long").alias(f"n_{k}")
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])))
    return found.select(
        "doc_id",
        *[count(k) for k in pii.KINDS],
        F.sha2(joined(F.filter("pii", lambda m: m["base"])).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )


# The rules of the contract (action, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@register("op6_url_filter")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmentflow.llm import url_filter
    from segmentflow.llm.common import read_table

    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES, url_filter.train(), keep=["page_id"])


@register("op9_lsh_forest")
def op9_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmentflow.llm.common import read_table
    from segmentflow.llm.lsh_forest import nearest

    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmentflow.llm.common import read_table
    from segmentflow.llm.decontaminate import contaminated

    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register(
    "op7_perspectives",
    r"""
    WITH m AS (
      SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role,
             replace(coalesce(text, ''), '<|', '<\|') AS text
      FROM conversations),
    speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM m WHERE role <> 'system'),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM m),
    spans AS (SELECT conv_id, (max(k) - 1) // 256 AS last, min(k) FILTER (WHERE role <> 'system') AS first FROM ranked GROUP BY conv_id),
    seg AS (
      SELECT conv_id, (k - 1) // 256 AS segment, k, role, text FROM ranked
      UNION ALL
      SELECT r.conv_id, unnest(range(1, last + 1)), k, role, text
      FROM ranked r JOIN spans s ON r.conv_id IS NOT DISTINCT FROM s.conv_id WHERE k <= 16 AND k < first),
    r AS (
      SELECT m.conv_id, speaker, CAST(segment AS BIGINT) AS segment, k, role, text,
             '<|' || CASE WHEN role = 'system' THEN 'system' WHEN role = speaker THEN 'assistant'
                          ELSE 'user:' || role END || '|>' || chr(10) AS head,
             text || '<|end|>' AS body
      FROM seg m JOIN speakers s ON m.conv_id IS NOT DISTINCT FROM s.conv_id),
    placed AS (
      SELECT *, length(head) + coalesce(sum(length(head) + length(body) + 1) OVER (
               PARTITION BY conv_id, speaker, segment ORDER BY k
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM r)
    SELECT conv_id, speaker, segment,
           string_agg(head || body || chr(10), '' ORDER BY k) AS text,
           coalesce(string_agg(CASE WHEN role = speaker THEN CAST(start AS VARCHAR) || ':' || CAST(start + length(body) AS VARCHAR) END,
                    ',' ORDER BY k), '') AS mask,
           count(*) AS n_messages
    FROM placed GROUP BY conv_id, speaker, segment""",
)
def op7_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmentflow.llm.chat import rotate
    from segmentflow.llm.common import read_table

    views = rotate(read_table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return views.select("conv_id", "speaker", "segment", "text", mask.alias("mask"), "n_messages")


@register(
    "op11_pq_links",
    """
    WITH RECURSIVE
    v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
      WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
      SELECT a.vec_id AS id, b.vec_id AS other FROM v a JOIN v b
        ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
    reached AS (
      SELECT vec_id AS id, vec_id AS other FROM embeddings
      UNION SELECT r.id, l.other FROM reached r JOIN links l ON r.other = l.id),
    least AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id),
    n AS (SELECT id, count(*) AS n FROM links GROUP BY id)
    SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
    FROM embeddings e JOIN least ON least.id = e.vec_id LEFT JOIN n ON n.id = e.vec_id""",
)
def op11_pq_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmentflow.llm.common import read_table
    from segmentflow.llm.pq_links import near_vectors

    return near_vectors(read_table(spark, sf_dir, "embeddings"))


@register(
    "op12_spelling",
    r"""
    WITH RECURSIVE
    step AS (
      SELECT i AS byte, 0 AS k, CAST(i AS BIGINT) AS c FROM range(256) t(i)
      UNION ALL
      SELECT byte, k + 1, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) FROM step WHERE k < 8),
    crc AS (SELECT list(c ORDER BY byte) AS t FROM step WHERE k = 8),
    runs AS (
      SELECT translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w,
             coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS head
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')) AS run FROM documents)),
    points AS (
      SELECT w, list_concat(list_transform(string_split(head, ''), lambda x: CAST(unicode(x) AS BIGINT)),
                            list_transform(string_split(w, ''), lambda x: CAST(unicode(x) AS BIGINT))) AS p
      FROM runs),
    bytes AS (
      SELECT w, flatten(list_transform(p, lambda x: CASE WHEN x < 128 THEN [x] ELSE [192 + (x >> 6), 128 + (x & 63)] END)) AS b
      FROM points),
    hashed AS (
      SELECT w, xor(list_reduce(list_concat([4294967295], b),
                lambda a, x: xor(a >> 8, t[CAST((xor(a, x) & 255) + 1 AS INTEGER)])), 4294967295) AS h
      FROM bytes, crc),
    typed AS (
      SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word
      FROM hashed),
    vocabulary AS (SELECT word, count(*) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
    cut AS (
      SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
      FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocabulary)),
    pairs AS (
      SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cut a JOIN vocabulary b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM cut a JOIN vocabulary b ON a.rest = b.word),
    best AS (
      SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
    forms AS (
      SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
             CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
      FROM vocabulary v LEFT JOIN best USING (word)),
    chain AS (
      SELECT word, word AS root, form AS up FROM forms
      UNION ALL
      SELECT c.word, c.up, f.form FROM chain c JOIN forms f ON f.word = c.up)
    SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN chain c ON c.word = f.word AND c.up IS NULL""",
)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmentflow.llm import spelling
    from segmentflow.llm.common import read_table

    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"), typo=spelling.TYPO)


@register(
    "op13_hard_negatives",
    """
    WITH r AS (
      SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.id AS anchor, b.id AS id, a.label = b.label AS same,
             CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.id % 50 = 0 AND a.id <> b.id),
    p AS (
      SELECT anchor, id AS positive, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
    SELECT p.anchor AS anchor_id, p.positive AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
           s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
     AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
    QUALIFY rank <= 3""",
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmentflow.llm.box_tree import hard_negatives
    from segmentflow.llm.common import read_table

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)
