"""One query per operator, over its whole table and with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    chat, decontamination, hard_negatives, line_dedup, lm_scoring, nearest, ngram_join, packing, pii, secret_scan, superminhash,
    toxicity, whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.digest(report)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup_lines(table(spark, sf_dir, "documents")))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_chats(chat.canonical_turns(rows, "conv_id")))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.expr("pmod(vec_id, 7) = 0"), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label)).drop("anchor_no")


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_nearest_neighbours, op3_pii, op4_toxicity, op5_decontamination, op6_line_dedup, op7_secret_scan,
        op8_lm_scoring, op9_best_fit_packing, op10_chat_formatting, op11_embedding_whitening, op12_hard_negative_mining,
        op13_minhash_near_dedup,
    )
}
# A-Z only: lower() would also change other letters.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(share: int, columns: str = "") -> str:
    """Groups of documents linked by the Jaccard similarity of their 5-word shingles, by brute force."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
    FROM w
),
n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
    SELECT u, v FROM p JOIN n a ON u = a.doc_id JOIN n b ON v = b.doc_id WHERE 100 * c >= {share} * (a.n + b.n - c)
),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT r.doc_id, e.v FROM r JOIN e ON r.c = e.u)
SELECT n.doc_id, any_value(n.n) AS n_shingles, min(r.c) AS component_id{columns} FROM n JOIN r ON n.doc_id = r.doc_id GROUP BY n.doc_id
"""


OP1 = _components(80)
OP13 = _components(85, ", n.doc_id = min(r.c) AS kept")

_NORMAL = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP5 = rf"""
WITH d AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
b AS (SELECT item_id, {_NORMAL} AS w FROM benchmark),
i AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p:p + 9], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)
),
k AS (SELECT DISTINCT k FROM i),
x AS (
    SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, k WHERE len(w) >= k)
),
h AS (SELECT x.doc_id, x.p, x.k, i.item_id FROM x JOIN i ON x.k = i.k AND x.g = i.g),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY doc_id),
t AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


OP6 = rf"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
s AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS line, unnest(ls) AS text FROM d),
l AS (
    SELECT *, row_number() OVER (ORDER BY doc_id, line) AS pos
    FROM (SELECT doc_id, line, list_sort(list_distinct(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'))) AS w FROM s) WHERE len(w) > 0
),
h AS (SELECT w, min(pos) AS pos, len(w) AS n FROM l GROUP BY w),
t AS (SELECT pos, n, unnest(w) AS token FROM h),
m AS (
    SELECT DISTINCT pos FROM (
        SELECT x.pos, count(*) AS c, any_value(x.n + y.n) AS n
        FROM t x JOIN t y ON x.token = y.token AND y.pos < x.pos AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
        GROUP BY x.pos, y.pos
    ) WHERE 100 * c >= 80 * (n - c)
),
g AS (
    SELECT l.doc_id, list(l.line) AS gone FROM l JOIN h ON l.w = h.w
    WHERE l.pos <> h.pos OR h.pos IN (SELECT pos FROM m) GROUP BY l.doc_id
),
k AS (
    SELECT d.doc_id, len(coalesce(gone, [])) AS n_removed,
        array_to_string([x for x, i in ls if NOT list_contains(coalesce(gone, []), i)], chr(10)) AS kept
    FROM d LEFT JOIN g ON d.doc_id = g.doc_id
)
SELECT a.doc_id, coalesce(n_removed, 0) AS n_removed, length(coalesce(kept, '')) AS n_chars_left, sha256(coalesce(kept, '')) AS text_sha256
FROM documents a LEFT JOIN k ON a.doc_id = k.doc_id
"""


def _escaped_length(column: str, escaped: str) -> str:
    """Each character that is escaped takes one more."""
    bare = column
    for character in escaped:
        bare = f"replace({bare}, {'chr(10)' if character == chr(10) else repr(character).replace(chr(92) * 2, chr(92))}, '')"
    return f"(2 * length({column}) - length({bare}))"


_ORDER = "ORDER BY turn NULLS FIRST, role, text"
OP10 = rf"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' {_ORDER})) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' {_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum({len(chat.OPEN) + 1 + len(chat.CLOSE)} + {_escaped_length("role", chr(92) + "#<" + chr(10))}
        + {_escaped_length("text", chr(92) + "#<")}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP12 = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS s
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
),
p AS (
    SELECT anchor_id, vec_id AS positive_id, s AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5
),
n AS (
    SELECT p.*, s.vec_id AS negative_id, s.s AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.s DESC, s.vec_id) AS INTEGER) AS rank
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
    WHERE 80 * positive_score <= 100 * s.s AND 100 * s.s <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": OP1, "op5_decontamination": OP5, "op6_line_dedup": OP6, "op10_chat_formatting": OP10, "op12_hard_negative_mining": OP12,
    "op13_minhash_near_dedup": OP13,
}
