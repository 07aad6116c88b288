"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loamframe.llm.url_rules import apply_url_rules

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return apply_url_rules(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loamframe.llm.exact import exact_duplicates

    return exact_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from loamframe.llm.token_store import store_tokens

    return store_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, special=True)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from loamframe.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096, special=True)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from loamframe.llm.duck_bpe import bpe_encode_decode

    return bpe_encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loamframe.llm.quality import score_quality

    scored = score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loamframe.llm.vector_links import vector_links

    return vector_links(_table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from loamframe.llm.token_counts import document_token_counts

    counts = document_token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=50256)
    return counts.select("doc_id", "n_tokens")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loamframe.llm.jaccard import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loamframe.llm.substrings import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"), texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loamframe.llm.spelling import spelling_variants

    return spelling_variants(_table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loamframe.llm.divergence import source_divergence

    return source_divergence(_table(spark, sf_dir, "documents"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loamframe.llm.syncmers import fingerprint_documents

    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_rules, op2_token_store, op3_packing, op4_bpe, op5_quality, op6_embedding_links, op7_token_counts, op8_exact_dedup, op9_jaccard, op10_substrings, op11_spelling, op12_divergence, op13_fingerprints)}


_OP1 = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), r AS (
  SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

_OP8 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


_OP10 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
m AS (SELECT run, min(doc_id) AS first_doc FROM x GROUP BY run),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM x JOIN m USING (run) WHERE first_doc < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
), n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""


_OP9 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM x GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT id AS doc_id, min(root) AS component_id FROM r GROUP BY 1) c USING (doc_id)
"""

_OP6 = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
ok AS (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM v WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
r AS (SELECT vec_id AS id, vec_id AS root FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1) USING (vec_id) JOIN (SELECT id AS vec_id, min(root) AS component_id FROM r GROUP BY 1) USING (vec_id)
"""


_OP11 = r"""
WITH RECURSIVE crcs AS (SELECT i, i AS x, 0 AS k FROM range(256) r(i) UNION ALL SELECT i, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END, k + 1 FROM crcs WHERE k < 8),
tab AS (SELECT list(x ORDER BY i) AS t FROM crcs WHERE k = 8),
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
u AS (SELECT doc_id, w, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || w AS named FROM r GROUP BY 1, 2),
b AS (SELECT w, n, flatten(list_transform(string_split(named, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END)) AS bytes FROM u),
h AS (SELECT w, n, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, x: xor(t[(xor(a, x) & 255) + 1], a // 256))) AS h FROM b, tab),
v AS (SELECT CASE WHEN h % 97 = 0 THEN substring(w, 1, (h % length(w))::INT) || substring(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM h),
words AS (SELECT word, sum(n)::BIGINT AS n FROM v WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, substring(word, 1, i::INT - 1) AS pre, substring(word, i::INT + 1) AS post FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.pre = b.pre AND a.post = b.post AND a.word <> b.word
  UNION SELECT a.word, c.word, c.n FROM words a JOIN cut c ON a.word = c.pre || c.post
  UNION SELECT c.word, a.word, a.n FROM words a JOIN cut c ON a.word = c.pre || c.post),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY 1),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
c AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON f.word = c.next)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM f JOIN c ON c.word = f.word AND c.next IS NULL
"""

_OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
keep AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v FROM keep GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN keep USING (lang, term) GROUP BY 1, 2, 3),
n AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, keep.term, coalesce(c.n, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (n.n + v) AS p
  FROM g JOIN keep ON keep.lang = g.lang JOIN v ON v.lang = g.lang JOIN n ON n.lang = g.lang AND n.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = keep.term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 1)) // (sum(sum(c)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q FROM p GROUP BY 1, 2),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pairs LEFT JOIN sums USING (lang, source, item)
  UNION ALL SELECT p.lang, p.source, 'term', p.term, (p - q) * (p - q) // q FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE c > 0 AND p > q),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM k WHERE part = 'pair' OR rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_rules": _OP1, "op6_embedding_links": _OP6, "op8_exact_dedup": _OP8, "op9_jaccard": _OP9, "op10_substrings": _OP10, "op11_spelling": _OP11, "op12_divergence": _OP12}
