"""The corpus queries, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gablewise.llm import alignment, chat, fingerprints, jaccard, mixing, packing, quality, runs, spans, tokens, topk, urls, warc

VOCABULARY, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_decisions(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = spans.drop_repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"), runs=True)
    return x.select("row.doc_id", "text", "n_removed", "removed")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(VOCABULARY))


def op7_one_permutation_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_neighbours(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(VOCABULARY))


def op9_dual_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_url_language_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES))


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_warc_segments, op2_source_mix, op3_sentence_spans, op4_quality_classifier, op5_jaccard_join, op6_token_counts,
        op7_one_permutation_minhash, op8_best_fit_packing, op9_dual_tree_top_k, op10_url_language_models,
        op11_cross_tokenizer_alignment, op12_chat_formatting, op13_periodic_runs,
    )
    return {f.__name__: f for f in every}


OP2_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix|' || coalesce(doc_id::VARCHAR, 'null')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3e0 WHEN 1 THEN 1e0 ELSE 2e0 END AS w
    FROM d GROUP BY source),
l AS (SELECT *, (1.5e0 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s WINDOW o AS (ORDER BY 2 * source_size / w, source NULLS LAST)),
t AS (SELECT source, source_size, least((2 * source_size)::DOUBLE, w * max(level) OVER ()) AS target FROM l),
b AS (SELECT *, floor(target + 0.5)::BIGINT AS budget, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
r AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest, count(*) OVER (PARTITION BY d.source, k, size) AS alike,
    sum(size) OVER (PARTITION BY d.source ORDER BY k, size) AS upto FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
    (size * epochs + CASE WHEN size = 0 OR rest = 0 THEN 0 WHEN upto <= rest THEN size WHEN upto - alike * size < rest THEN (rest - (upto - alike * size)) // alike ELSE 0 END)::BIGINT AS taken
FROM r
"""


OP9_SQL = """
WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: floor(1024e0 * c::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score FROM x AS q JOIN x ON q.vec_id % 100 = 0 AND x.vec_id <> q.vec_id),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages), m AS (SELECT t, min(page_id) AS first_id FROM p GROUP BY t),
h AS (SELECT page_id, first_id, t, sha1(t) || '000' AS hex FROM p JOIN m USING (t))
SELECT page_id, octet_length(encode(t))::BIGINT AS payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, (5 * i // 4 + 1)::INT, 3))::INT >> (7 - 5 * i % 4)::INT) & 31) + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to, TRUE AS valid FROM h
"""

OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: concat_ws(' ', ws[i], ws[i + 1], ws[i + 2])) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s AS a JOIN s AS b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n AS a ON a.doc_id = x JOIN n AS b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id AND r.c < e.y)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id FROM (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) LEFT JOIN n USING (doc_id)
"""


def _level(n: int) -> str:
    """The models of order n from the counts of order n and the models below."""
    low = f"x{n - 1}"
    q = ", ".join(f"CASE WHEN n_{m} > 0 THEN ({m} + t_{m} * p.p_{m}) / (n_{m} + t_{m}) ELSE p.p_{m} END AS p_{m}" for m in ("good", "bad"))
    w = ", ".join(f"sum({m}) OVER (PARTITION BY x{n}) AS n_{m}, sum(({m} > 0)::INT) OVER (PARTITION BY x{n}) AS t_{m}" for m in ("good", "bad"))
    return f"m{n} AS (SELECT v.x{n}, v.c, {q} FROM (SELECT *, {w}, {f'substr(x{n}, 2, {n - 1})' if n > 1 else chr(39) * 2} AS {low} FROM l{n}) AS v JOIN m{n - 1} AS p ON p.{low} = v.{low} AND p.c = v.c)"


OP10_SQL = (
    r"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
k AS (SELECT *, CASE"""
    + "".join(f" WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for h, p, _ in sorted(urls.RULES, key=lambda r: -len(r[0] + r[1])))
    + r""" END AS rule FROM u),
j AS (SELECT *, CASE WHEN rule IN ("""
    + ", ".join(f"'{h}{p}'" for h, p, v in urls.RULES if v == "allow")
    + r""") THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS said FROM k),
d AS (SELECT DISTINCT host, path, said, host || path AS txt, ('0x' || left(md5(host || path), 4))::BIGINT % 5 AS fold FROM j),
t AS (SELECT *, coalesce(fold > 0 AND said = 'allow', FALSE)::INT AS good, coalesce(fold > 0 AND said = 'block', FALSE)::INT AS bad, repeat(chr(2), 3) || txt || chr(3) AS s FROM d),
g AS (SELECT host, path, said, fold, good, bad, substr(s, i, 3) AS x3, substr(s, i + 3, 1) AS c FROM t, unnest(range(1, length(s) - 2)) AS r(i)),
l3 AS (SELECT x3, c, sum(good) AS good, sum(bad) AS bad FROM g GROUP BY ALL), l2 AS (SELECT substr(x3, 2, 2) AS x2, c, sum(good) AS good, sum(bad) AS bad FROM l3 GROUP BY ALL),
l1 AS (SELECT substr(x2, 2, 1) AS x1, c, sum(good) AS good, sum(bad) AS bad FROM l2 GROUP BY ALL), l0 AS (SELECT '' AS x0, c, sum(good) AS good, sum(bad) AS bad FROM l1 GROUP BY ALL),
m0 AS (SELECT x0, c, (good + 1e0) / (sum(good) OVER () + count(*) OVER ()) AS p_good, (bad + 1e0) / (sum(bad) OVER () + count(*) OVER ()) AS p_bad FROM l0),
"""
    + ",\n".join(_level(n) for n in (1, 2, 3))
    + r""",
f AS (SELECT x3, c, round((ln(p_good) - ln(p_bad)) * 1000000)::BIGINT AS ratio FROM m3),
sc AS (SELECT host, path, said, sum(ratio)::BIGINT / count(*) AS score FROM g JOIN f USING (x3, c) WHERE said IS NULL OR fold = 0 GROUP BY ALL),
st AS (SELECT floor(score / 10000) AS s, count(*) FILTER (said = 'allow') AS g, count(*) FILTER (said = 'block') AS b FROM sc WHERE said IS NOT NULL GROUP BY 1),
th AS (SELECT s, sum(g) OVER (ORDER BY s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) / sum(g) OVER () + coalesce(sum(b) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(b) OVER () AS okay,
    sum(g) OVER () > 0 AND sum(b) OVER () > 0 AS told FROM st),
le AS (SELECT coalesce((SELECT s FROM th WHERE told ORDER BY okay DESC, s LIMIT 1), 0) * 10000 AS least)
SELECT page_id, j.host, j.path, rule, coalesce(j.said, CASE WHEN score >= least THEN 'allow' ELSE 'block' END) AS verdict, score / 1000000 AS score
FROM j CROSS JOIN le LEFT JOIN sc ON sc.host = j.host AND sc.path = j.path AND sc.said IS NULL AND j.said IS NULL
"""
)


OP12_SQL = r"""
WITH t AS (SELECT FALSE AS added, conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (TRUE, -1, 0, 'user', '</s>[INST] ok [/INST]'), (TRUE, -1, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT *, coalesce(lag(role) OVER w = role, FALSE) AS goes_on, coalesce(lead(role) OVER w = role, FALSE) AS stays,
    row_number() OVER w AS k FROM t WINDOW w AS (PARTITION BY added, conv_id ORDER BY turn NULLS FIRST, role, text)),
n AS (SELECT *, length(text) + len(regexp_extract_all(text, '\[\\*(?:/?INST|/?ROLE|TEXT|NEXT)\]|<\\*/?s>')) AS of_text,
    length(role) + len(regexp_extract_all(role, '\[\\*(?:/?INST|/?ROLE|TEXT|NEXT)\]|<\\*/?s>')) AS of_role FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(of_text + CASE WHEN goes_on THEN 6 WHEN role = 'user' THEN 7 WHEN role = 'assistant' THEN 0 ELSE 12 + of_role END
        + CASE WHEN stays THEN 0 WHEN role = 'user' THEN 8 WHEN role = 'assistant' THEN 4 ELSE 7 END))::BIGINT AS formatted_chars
FROM n GROUP BY added, conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_segments": OP1_SQL, "op2_source_mix": OP2_SQL, "op5_jaccard_join": OP5_SQL, "op9_dual_tree_top_k": OP9_SQL, "op10_url_language_models": OP10_SQL, "op12_chat_formatting": OP12_SQL}
