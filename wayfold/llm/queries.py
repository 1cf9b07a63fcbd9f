"""The queries of the training-data operators and, where SQL can express one, its SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, embedding_dedup, exact_dedup, importance, language_id, line_dedup, mixing, packing, prefix_trie, secret_scan, simhash_dedup, suffix_dedup, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.toxicity(docs, table(spark, sf_dir, "labels"), carry_text=False)
    return found.select("doc_id", "held_out", "score", "predicted")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_dedup(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    # a finding's checksum instead of the secret itself
    return found.select("doc_id", "k", F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("sha256"), "score", "is_secret")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_dedup(table(spark, sf_dir, "embeddings"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.format_chats(turns.unionByName(more)))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), rebuild=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_pack_sequences": op3_pack_sequences,
        "op4_toxicity": op4_toxicity,
        "op5_simhash_near_dedup": op5_simhash_near_dedup,
        "op6_language_id": op6_language_id,
        "op7_secret_scan": op7_secret_scan,
        "op8_embedding_near_dedup": op8_embedding_near_dedup,
        "op9_mix_sources": op9_mix_sources,
        "op10_suffix_array_dedup": op10_suffix_array_dedup,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_chat_format": op12_chat_format,
        "op13_prefix_trie": op13_prefix_trie,
    }


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = f"""
WITH h AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256)
"""

#: Water-filling in closed form; each source's words are lined up by md5 of the id.
OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (
  SELECT source, sum(size) AS source_size, 3 * sum(size) AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s),
t AS (
  SELECT source, source_size::BIGINT AS source_size,
         least(cap::DOUBLE, coalesce((SELECT arg_min(level, cap / w) FROM l WHERE cap > level * w) * w, cap)) AS target
  FROM l),
p AS (
  SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '')), doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t USING (source))
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
        + greatest(0, least(size, budget - CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * source_size
                                  - before)))::BIGINT AS taken
FROM p
"""


def _crc32(text: str) -> str:
    """The CRC-32 of a text of bytes, bit by bit."""
    step = "lambda a, i: xor(a >> 1, 3988292384 * (a & 1))"
    by_byte = f"lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], {step})"
    octets = f"list_transform(range(0, octet_length(encode({text}))), lambda p: ('0x' || substr(hex(encode({text})), 2 * p + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), {by_byte}), 4294967295)"


#: Distinct words are hashed once; 10,000 buckets, 10 of a hundred of the documents with 20 words.
OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
dw AS (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(words) AS w FROM d) GROUP BY r, w),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(words) AS w FROM b) GROUP BY w),
h AS (SELECT w, {_crc32('w')} % 10000 AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM dw JOIN h USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::BIGINT AS t FROM bw JOIN h USING (w) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
x AS (SELECT r, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS gain FROM dw JOIN h USING (w) JOIN g USING (bucket) GROUP BY r),
w AS (SELECT doc_id, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN (gain - ((gain % n) + n) % n) // n ELSE 0 END AS weight,
        ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN x USING (r)),
c AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM w),
k AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) END AS place FROM c)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT count(*) FROM c WHERE n_features >= 20) * 10 // 100 THEN place END AS rank FROM k
"""

_ESCAPE_AT = "'" + f"{chat_format.ESC}|" + "|".join(re.escape(x) for x in chat_format.CONTROL) + "'"
_MARKS = " ".join(f"WHEN '{role}' THEN {len(a + z)}" for role, (a, z) in chat_format.MARKS.items())
#: The formatted length is that of texts, marks and one ESC for each conflict.
OP12_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
u AS (SELECT *, length(text) + len(regexp_extract_all(text, {_ESCAPE_AT}))
        + CASE role {_MARKS} ELSE {len("".join(chat_format.NAMED))} + length(role) + len(regexp_extract_all(role, {_ESCAPE_AT})) END AS chars FROM t),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nr FROM u)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nr)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY nr) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

#: Nodes by a hash of the whole beginning; sums over a subtree by each node's ancestors.
OP13_SQL = f"""
WITH t AS (SELECT conv_id AS c, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS key, length(coalesce(text, '')) AS chars,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS k FROM conversations),
v AS (SELECT c, c - c % 100 AS base, {_crc32('c::VARCHAR')} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT v.c, 0 AS own, t.k, key, chars FROM v JOIN t ON t.c = v.base WHERE t.k < h UNION ALL SELECT v.c, 1, t.k, key, chars FROM v JOIN t ON t.c = v.c WHERE t.k >= h),
p AS (SELECT c, chars, row_number() OVER w AS depth, sha256(string_agg(key, '' ) OVER w) AS node FROM r WINDOW w AS (PARTITION BY c ORDER BY own, k)),
a AS (SELECT c, depth, node, chars FROM p UNION ALL SELECT c, 0, 'root', 0 FROM v),
n AS (SELECT depth, node, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM a GROUP BY depth, node),
m AS (SELECT n.*, a.node AS parent FROM n LEFT JOIN a ON a.c = n.conv_id AND a.depth = n.depth - 1),
kids AS (SELECT parent AS node, count(*) AS n_children FROM m WHERE parent IS NOT NULL GROUP BY parent),
sums AS (SELECT a.node, sum((m.n_convs - 1) * m.chars)::BIGINT AS saved, count(*) FILTER (kids.node IS NULL) AS leaves
  FROM m LEFT JOIN kids ON kids.node = m.node JOIN a ON a.c = m.conv_id AND a.depth <= m.depth GROUP BY a.node),
last AS (SELECT arg_max(node, depth) AS node, c FROM a GROUP BY c),
ends AS (SELECT node, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM last GROUP BY node)
SELECT m.conv_id, m.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, m.n_convs, coalesce(kids.n_children, 0) AS n_children, leaves AS n_leaves,
  saved AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM m LEFT JOIN n q ON q.node = m.parent LEFT JOIN kids ON kids.node = m.node JOIN sums ON sums.node = m.node LEFT JOIN ends ON ends.node = m.node
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op9_mix_sources": OP9_SQL, "op11_importance_resampling": OP11_SQL, "op12_chat_format": OP12_SQL, "op13_prefix_trie": OP13_SQL}
