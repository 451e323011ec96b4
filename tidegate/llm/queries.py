"""Queries over the given tables, one for each operator, with SQL where it can give the same rows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, collocations, decontam, embed_dedup, html_text, labels, lm_score, pii, quality, simhash, toxicity, url_filter, vector_codes
from .frames import saved, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: File of the token ranks.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def bpe_digests(docs: DataFrame, *kept: str) -> DataFrame:
    return bpe.encode(docs.select("doc_id", *kept, "text"), RANKS, decoded=True).select(
        "doc_id",
        *kept,
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    of = lambda *kinds: F.filter("pii_spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(joined(of(*pii.BASE_KINDS)), 256).alias("base_sha256"),
        joined(F.col("pii_spans")).alias("spans"),
    )


RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


SQL["op10_url_filter"] = r"""
WITH RECURSIVE
marked AS (SELECT url, html FROM pages WHERE contains(url, '://')),
named AS (
    SELECT url, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?\s*([^"''>\s]+)', 1) AS link FROM (
        SELECT url, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*?\brel\s*=\s*["'']?canonical\b[^>]*>')) AS tag FROM marked)
    UNION ALL
    SELECT url, regexp_extract(tag, '(?is)\burl\s*=\s*["'']?\s*([^"''>\s]+)', 1) AS link FROM (
        SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*?\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')) AS tag FROM marked)
),
links AS (
    SELECT regexp_extract(url, '(?s)^([^#]*)', 1) AS a, regexp_extract(replace(link, '&amp;', '&'), '(?s)^([^#]*)', 1) AS b
    FROM named WHERE contains(link, '://')
),
pairs AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, a AS b FROM pairs UNION SELECT r.a, e.b FROM reach r JOIN pairs e ON r.b = e.a),
urls AS (SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT a FROM pairs),
parts AS (
    SELECT url,
        translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM urls
),
judged AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    END AS rule FROM parts
),
ruled AS (SELECT *, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' END AS own FROM judged),
taken AS (
    SELECT r.a, CASE WHEN bool_or(j.own = 'allow') THEN 'allow' WHEN bool_or(j.own = 'block') THEN 'block' END AS got
    FROM reach r LEFT JOIN ruled j ON j.url = r.b GROUP BY r.a
)
SELECT p.page_id, coalesce(j.host, '') AS host, coalesce(j.path, '') AS path, j.rule,
    coalesce(j.own, t.got, 'allow') AS verdict
FROM pages p LEFT JOIN ruled j ON j.url = p.url LEFT JOIN taken t ON t.a = regexp_extract(p.url, '(?s)^([^#]*)', 1)
"""


@query
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", "n_chars")


@query
def op5_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chat.perspectives(table(spark, sf_dir, "conversations"))
    joined = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return made.select("conv_id", "perspective", "part", "n_messages", "n_own", "text", joined.alias("spans"))


SQL["op5_chat_perspectives"] = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS said,
        CAST(coalesce(floor(turn / 512), -1) AS BIGINT) AS part FROM conversations
),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
lines AS (
    SELECT s.conv_id, p.perspective, s.part, s.turn, s.speaker, s.said, s.speaker = p.perspective AS own,
        '<|im_start|>' || CASE WHEN s.speaker = p.perspective THEN 'assistant' WHEN s.speaker = 'system' THEN 'system'
            ELSE 'user name=' || s.speaker END || chr(10) AS header
    FROM said s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
),
placed AS (
    SELECT *, coalesce(sum(length(header) + length(said) + 11) OVER (PARTITION BY conv_id, perspective, part
        ORDER BY turn, speaker, said ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(header) AS start
    FROM lines
)
SELECT conv_id, perspective, part, count(*) AS n_messages, count(*) FILTER (own) AS n_own,
    string_agg(header || said || '<|im_end|>' || chr(10), '' ORDER BY turn, speaker, said) AS text,
    coalesce(string_agg(CAST(start AS VARCHAR) || ':' || CAST(start + length(said) + 11 AS VARCHAR), ',' ORDER BY start)
        FILTER (own), '') AS spans
FROM placed GROUP BY conv_id, perspective, part
"""


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Trained on labelled documents outside the held-out fold."""
    learnable = labels.fold_of(F.col("doc_id"), 5) != 0
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.train(*labels.sample(docs, marks, "toxic", toxicity.SAMPLE_ROWS, learnable))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        (labels.fold_of(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """Trained on labelled documents outside the held-out fold."""
    learnable = labels.fold_of(F.col("doc_id"), 3) != 1
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.train(*labels.sample(docs, marks, "quality", quality.SAMPLE_ROWS, learnable))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        (labels.fold_of(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = saved(simhash.fingerprint(docs, words=3).drop("text"), "fingerprints")
    return simhash.classes(prints).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "first_word", "past_word")


@query
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.links(table(spark, sf_dir, "embeddings"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = vector_codes.compress(table(spark, sf_dir, "embeddings"), keep=("label",))
    added = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1)).cast("long")
    by_label = made.vectors.groupBy(F.col("label").alias("same")).agg(added.alias("label_error"))
    return made.vectors.join(by_label, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id",
        vector_codes.hex_code(F.col("code")).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(vector_codes.book_text(made.books).encode()).hexdigest()).alias("codebooks_sha256"),
    )


def _lloyd_sql(rounds: int) -> str:
    """Every round compares every part with every entry; only rows whose vectors are all finite take part."""
    ctes = [
        """kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rn, vec_id, label, embedding, len(embedding) // 8 AS w
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """placed AS (SELECT rn, w, unnest(embedding) AS x, unnest(range(len(embedding))) AS place FROM kept)""",
        """c AS MATERIALIZED (
    SELECT rn, place // w AS part, place % w AS k, CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS v FROM placed)""",
        "b0 AS MATERIALIZED (SELECT part, rn - 1 AS entry, k, v FROM c WHERE rn <= 16)",
    ]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (
    SELECT rn, part, entry, d FROM (
        SELECT c.rn, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v)) AS d
        FROM c JOIN b{r} b USING (part, k) GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY rn, part ORDER BY d, entry) = 1)""")
        if r < rounds:
            ctes.append(f"""b{r + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, b.k, CAST(coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.v) AS BIGINT) AS v
    FROM b{r} b LEFT JOIN (SELECT part, entry, k, sum(v) AS s, count(*) AS n FROM a{r} JOIN c USING (rn, part) GROUP BY ALL) m
        USING (part, entry, k))""")
    return f"""WITH {", ".join(ctes)},
books AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, k)) AS h FROM b{rounds}),
coded AS (
    SELECT rn, string_agg(lpad(printf('%x', entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM a{rounds} GROUP BY rn)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (rn), books"""


SQL["op11_vector_codes"] = _lloyd_sql(6)


@query
def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_score.score(docs, labels.fold_of(F.col("doc_id"), 10) != 0)
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents").select("lang", "text"))


SQL["op13_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
found AS MATERIALIZED (
    SELECT lang, m, phrase, count(*) AS f FROM (
        SELECT lang, 1 AS m, unnest(w) AS phrase FROM worded
        UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded
        UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
        FROM worded)
    GROUP BY ALL
),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM found WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM found WHERE m > 1 AND f >= 10),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM candidates),
scored AS (
    SELECT c.lang, c.m, c.phrase, c.a, c.k, l.f AS l, r.f AS r,
        CAST((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM cuts c JOIN found l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ') AND l.m = c.k
    JOIN found r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:c.m], ' ') AND r.m = c.m - c.k
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, max(a) AS longer, phrase FROM (
        SELECT lang, a, w[1] || ' ' || w[2] AS phrase FROM candidates WHERE m = 3
        UNION ALL SELECT lang, a, w[2] || ' ' || w[3] FROM candidates WHERE m = 3)
    GROUP BY lang, phrase
),
kept AS (
    SELECT s.* FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase AND s.m = 2
    WHERE i.longer IS NULL OR 100 * i.longer < 50 * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000
"""
