"""The registered queries of this package, and the plain SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.centroids import clusters
from orderloom.llm.decontaminate import NUMBER, NUMBER_WORDS, OUTER, PLACEHOLDERS, QUANTITY, SENTENCE_ENDS, UNITS, leaks
from orderloom.llm.dialogue import structure
from orderloom.llm.jaccard_join import jaccard_links
from orderloom.llm.language import held_out as language_held_out
from orderloom.llm.language import language
from orderloom.llm.licences import licence_paragraphs
from orderloom.llm.lm_score import lm_scores
from orderloom.llm.mixing import mix
from orderloom.llm.quality import quality
from orderloom.llm.sharding import shards
from orderloom.llm.tables import table
from orderloom.llm.top_k import top_k
from orderloom.llm.toxicity import held_out, toxicity
from orderloom.llm.warc import archive_roundtrip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WORDS_SQL = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query(f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {WORDS_SQL.format("coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')")} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT doc_id, y FROM reach JOIN links ON x = r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, (SELECT count(*) FROM links WHERE x = d.doc_id) AS n_links
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
""")
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


@query()
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxicity_score").alias("score"),
                         (F.col("toxicity_score") >= 0.5).cast("int").alias("predicted"), "toxicity_evidence", "toxicity_cosine")


@query()
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


OUTER_SQL = "'" + OUTER.replace("'", "''") + "'"


@query(f"""
WITH sides AS (SELECT DISTINCT 'd' AS side, doc_id AS id, {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents
  UNION ALL SELECT DISTINCT 'i', item_id, {WORDS_SQL.format("coalesce(text, '')")} FROM benchmark),
bared AS (SELECT side, id, w, list_transform(w, lambda x: trim(x, {OUTER_SQL})) AS bare, row_number() OVER () AS r FROM sides WHERE len(w) > 0),
formed AS (SELECT side, id, r, list_transform(bare, lambda x: lower(x)) AS low, list_transform(range(1, len(w) + 1), lambda i: CASE
    WHEN bare[i][1] BETWEEN '0' AND '9' THEN CASE WHEN regexp_matches(lower(bare[i]), '{NUMBER}') THEN '<num>'
      WHEN regexp_matches(lower(bare[i]), '{QUANTITY}') THEN '<qty>' ELSE lower(bare[i]) END
    WHEN lower(bare[i]) IN {_in(UNITS)} THEN '<unit>' WHEN lower(bare[i]) IN {_in(NUMBER_WORDS)} THEN '<num>'
    WHEN bare[i][1] <> lower(bare[i][1]) AND i > 1 AND right(w[greatest(i - 1, 1)], 1) NOT IN {_in(SENTENCE_ENDS)} THEN '<name>'
    ELSE lower(bare[i]) END) AS forms FROM bared),
item AS (SELECT r AS item, id AS item_id, low, forms, least(8, len(forms)) AS size FROM formed WHERE side = 'i'),
every AS (SELECT item, size, pos, array_to_string(forms[pos + 1:pos + size], ' ') AS g, array_to_string(low[pos + 1:pos + size], ' ') AS l,
    len(list_filter(forms[pos + 1:pos + size], lambda x: x NOT IN {_in(PLACEHOLDERS)})) >= least(4, ceil(size / 2)) AS enough
  FROM (SELECT *, unnest(range(0, len(forms) - size + 1)) AS pos FROM item)),
cut AS (SELECT * FROM every QUALIFY enough OR NOT bool_or(enough) OVER (PARTITION BY item)),
doc AS (SELECT r AS d, id AS doc_id, low, forms FROM formed WHERE side = 'd'),
seen AS (SELECT d, size, pos, array_to_string(forms[pos + 1:pos + size], ' ') AS g, array_to_string(low[pos + 1:pos + size], ' ') AS l
  FROM (SELECT *, unnest(range(0, len(forms) - size + 1)) AS pos FROM doc, (SELECT DISTINCT size FROM item) WHERE len(forms) >= size)),
met AS (SELECT d, item, shift, item_pos, size, bool_or(literal) AS literal FROM (
    SELECT d, item, seen.pos - cut.pos AS shift, cut.pos AS item_pos, size, true AS literal FROM seen JOIN cut USING (size, l)
    UNION ALL SELECT d, item, seen.pos - cut.pos, cut.pos, size, false FROM seen JOIN cut USING (size, g) WHERE enough) GROUP BY ALL),
places AS (SELECT *, unnest(range(item_pos, item_pos + size)) AS k FROM met),
slots AS (SELECT p.d, p.item, shift, item_pos, k, i.low[k + 1] AS item_word, d.low[k + shift + 1] AS doc_word
  FROM places p JOIN item i USING (item) JOIN doc d USING (d) WHERE i.forms[k + 1] IN {_in(PLACEHOLDERS)}),
votes AS (SELECT *, count(*) OVER (PARTITION BY d, item, shift, item_word) AS n, count(*) OVER (PARTITION BY d, item, shift, item_word, doc_word) AS c
  FROM (SELECT DISTINCT d, item, shift, k, item_word, doc_word FROM slots)),
dropped AS (SELECT DISTINCT d, item, shift, item_pos FROM slots JOIN votes USING (d, item, shift, k) WHERE 2 * c <= n),
kept AS (SELECT met.*, item_pos - row_number() OVER (PARTITION BY d, item, shift ORDER BY item_pos) AS run FROM met
  LEFT JOIN dropped x USING (d, item, shift, item_pos) WHERE literal OR x.d IS NULL),
runs AS (SELECT d, item, max(n) AS run_words FROM (SELECT d, item, shift, run, count(*) + max(size) - 1 AS n FROM kept GROUP BY ALL) GROUP BY ALL),
covered AS (SELECT d, item, count(DISTINCT item_pos) AS n_matched FROM kept GROUP BY ALL),
compared AS (SELECT d, item, count(DISTINCT k) AS n_slots, bool_or(item_word <> doc_word) AS differs FROM slots JOIN kept USING (d, item, shift, item_pos) GROUP BY ALL),
totals AS (SELECT item, count(*) AS n_windows FROM cut GROUP BY item),
leaked AS (SELECT d, item, n_windows, n_matched, n_matched / n_windows AS coverage, run_words, coalesce(n_slots, 0) AS n_slots, coalesce(differs, false) AS reparametrised
  FROM covered JOIN totals USING (item) JOIN runs USING (d, item) LEFT JOIN compared USING (d, item) WHERE n_matched / n_windows >= 0.5 OR run_words >= 13),
best AS (SELECT doc_id, item_id, max({{'c': coverage, 'm': n_matched, 'n': n_windows, 'r': run_words, 's': n_slots, 'd': reparametrised}}) AS b
  FROM leaked JOIN item USING (item) JOIN doc USING (d) GROUP BY d, doc_id, item_id)
SELECT doc_id, item_id, b.n AS n_windows, b.m AS n_matched, b.c AS coverage, b.r AS run_words, b.s AS n_slots, b.d AS reparametrised FROM best
""")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


@query()
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language(docs).select("doc_id", language_held_out().alias("held_out"), "lang_pred", "score")


@query(f"""
WITH words AS (SELECT doc_id, {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
placed AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM words),
spot AS (SELECT *, lag(w) OVER d AS p, lag(w, 2) OVER d AS pp FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
one AS (SELECT w, count(*) AS c FROM spot GROUP BY 1),
one_own AS (SELECT doc_id, w, count(*) AS c FROM spot GROUP BY 1, 2),
two AS (SELECT p, w, count(*) AS c FROM spot WHERE p IS NOT NULL GROUP BY 1, 2),
two_own AS (SELECT doc_id, p, w, count(*) AS c FROM spot WHERE p IS NOT NULL GROUP BY 1, 2, 3),
three AS (SELECT pp, p, w, count(*) AS c FROM spot WHERE pp IS NOT NULL GROUP BY 1, 2, 3),
three_own AS (SELECT doc_id, pp, p, w, count(*) AS c FROM spot WHERE pp IS NOT NULL GROUP BY 1, 2, 3, 4),
counts AS (SELECT s.doc_id, least(i, 3) AS reach, greatest(1, (SELECT count(*) FROM spot) - len(d.w)) AS others,
    a.c - ao.c AS c1, b.c - bo.c AS c2, t.c - t_o.c AS c3, x.c - xo.c AS one_before, y.c - yo.c AS two_before
  FROM spot s JOIN words d USING (doc_id) JOIN one a ON a.w = s.w JOIN one_own ao ON ao.doc_id = s.doc_id AND ao.w = s.w
  LEFT JOIN one x ON x.w = s.p LEFT JOIN one_own xo ON xo.doc_id = s.doc_id AND xo.w = s.p
  LEFT JOIN two b ON b.p = s.p AND b.w = s.w LEFT JOIN two_own bo ON bo.doc_id = s.doc_id AND bo.p = s.p AND bo.w = s.w
  LEFT JOIN two y ON y.p = s.pp AND y.w = s.p LEFT JOIN two_own yo ON yo.doc_id = s.doc_id AND yo.p = s.pp AND yo.w = s.p
  LEFT JOIN three t ON t.pp = s.pp AND t.p = s.p AND t.w = s.w
  LEFT JOIN three_own t_o ON t_o.doc_id = s.doc_id AND t_o.pp = s.pp AND t_o.p = s.p AND t_o.w = s.w),
scored AS (SELECT doc_id, CASE WHEN c3 > 0 THEN 3 WHEN c2 > 0 THEN 2 WHEN c1 > 0 THEN 1 ELSE 0 END AS n,
    ln(CASE WHEN c3 > 0 THEN pow(0.4, reach - 3) * c3 / two_before WHEN c2 > 0 THEN pow(0.4, reach - 2) * c2 / one_before
       WHEN c1 > 0 THEN pow(0.4, reach - 1) * c1 / others ELSE pow(0.4, reach) / others END) AS s FROM counts),
sums AS (SELECT doc_id, sum(s) AS s, count(*) FILTER (n = 0) AS n0, count(*) FILTER (n = 1) AS n1, count(*) FILTER (n = 2) AS n2,
    count(*) FILTER (n = 3) AS n3 FROM scored GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, round(coalesce(s, 0), 4) AS log_score, coalesce(n0, 0) AS n_order_0, coalesce(n1, 0) AS n_order_1,
  coalesce(n2, 0) AS n_order_2, coalesce(n3, 0) AS n_order_3 FROM words LEFT JOIN sums USING (doc_id)
""")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_scores(table(spark, sf_dir, "documents"))
    return scores.withColumn("log_score", F.round("log_score", 4)).drop("mean_log_score")


@query(r"""
WITH page AS (SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)', ['host', 'rest']) AS u FROM pages),
keyed AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top,
    regexp_replace(regexp_replace(lower(regexp_replace(u.host, '^.*@', '')), ':(80|443)$', ''), '^www\.', '') AS host FROM page),
dealt AS (SELECT *, CASE WHEN url IS NULL THEN '' WHEN NOT regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN url
    ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN starts_with(u.rest, '/') THEN '' ELSE '/' END || u.rest END AS url_key FROM keyed)
SELECT page_id, size AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN size >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 1000 AND page_id <> top THEN top END AS refers_to, url_key, row_number() OVER (ORDER BY url_key, page_id) - 1 AS history_rank FROM dealt
""")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_roundtrip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "history_rank")


@query()
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_paragraphs(table(spark, sf_dir, "documents"))


def _means_sql(rounds: int) -> str:
    """The assignments and centroids of each round, as common table expressions."""
    distance = "list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))"
    steps = []
    for n in range(rounds + 1):
        steps.append(f"a{n} AS (SELECT r, any_value(k.vec_id) AS vec_id, any_value(k.v) AS v, min({{'d': {distance}, 'c': c.c}}) AS near FROM kept k, c{n} c GROUP BY r)")
        if n < rounds:
            steps.append(f"""m{n} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
  SELECT near.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM (SELECT *, unnest(range(1, 65)) AS i FROM a{n}) GROUP BY ALL) GROUP BY c),
c{n + 1} AS (SELECT c{n}.c, coalesce(m{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN m{n} USING (c))""")
    return ",\n".join(steps)


WHOLE_SQL = "coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), len(embedding) = 0)"


@query(f"""
WITH kept AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::HUGEINT) AS v, row_number() OVER () AS r FROM embeddings
  WHERE len(embedding) = 64 AND {WHOLE_SQL}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM kept ORDER BY sha256('1:' || vec_id) NULLS LAST, v LIMIT 16),
{_means_sql(3)}
SELECT vec_id, near.c::INTEGER AS cluster, near.d::BIGINT AS distance, (sum(near.d) OVER (PARTITION BY near.c))::BIGINT AS cluster_inertia,
  (sum(near.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256 FROM a3 JOIN c3 ON c3.c = near.c
""")
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


@query(f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::HUGEINT) AS v, row_number() OVER () AS r FROM embeddings
  WHERE {WHOLE_SQL}),
scored AS (SELECT a.r, a.vec_id AS query_id, b.r AS o, b.vec_id,
    list_sum(list_transform(range(1, 1 + least(len(a.v), len(b.v))), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, o) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure(table(spark, sf_dir, "conversations"))
