"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame,
and DuckDB text where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolap.llm import chat
from aerolap.llm.common import spool, table
from aerolap.llm.ann import nearest
from aerolap.llm.bpe import encode_digests
from aerolap.llm.html import extract
from aerolap.llm.line_dedup import remove_lines
from aerolap.llm.near_dedup import classes
from aerolap.llm.packing import pack
from aerolap.llm.pivot_search import top_k
from aerolap.llm.quality import judge, train
from aerolap.llm.sharding import shard
from aerolap.llm.spelling import count_words, runs, variants
from aerolap.llm.substring_dedup import remove_repeats
from aerolap.llm.trie import prefix_trie, thin_turns

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


OP2_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(15 + length(role) + length(text)
    + length(regexp_replace(role || text, '[^\\<>]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


@register("op2_chat_format", OP2_SQL)
def op2_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"),
                                  told.alias("prompt"), told.alias("response"))
    turns = (chat.from_columns(chat.gather_turns(rows), "conv_id")
             .unionByName(chat.from_columns(extra, "conv_id")))
    done = chat.format_turns(turns).select("conv_id", "formatted", "loss")
    back = done.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                       chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned"))
    lines = F.array_join(F.transform("turns", lambda x: F.concat(
        x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


OP8_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (
  SELECT k.*, (r.key IS NOT NULL AND doc_id <> keeper) AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@register("op8_line_dedup", OP8_SQL)
def op8_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50),
win AS (SELECT doc_id, i, sha256(array_to_string(w[i:i+49], ' ')) AS h FROM pos),
low AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j
         FROM win JOIN low USING (h) WHERE doc_id > lo),
gs AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, w.w, gs.js FROM w LEFT JOIN gs USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE
    list_transform(list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(js, x)), lambda x: w[x]) END, ' '))
    AS kept_sha256
FROM kept
"""


@register("op9_substring_dedup", OP9_SQL)
def op9_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs, one_space=True)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


# The least largest shard by dynamic programming over the prefix sums, then the
# greedy walk; CRC-32 byte by byte from its polynomial.
OP10_SQL = r"""
WITH RECURSIVE
d AS (SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, '')) + 1 AS size FROM documents),
g AS (SELECT t, min(doc_id) AS first_id, CAST(sum(size) AS BIGINT) AS bytes FROM d GROUP BY t),
p AS (SELECT t, CAST(sum(bytes) OVER (ORDER BY first_id) AS BIGINT) AS e FROM g),
points AS (SELECT e FROM p UNION ALL SELECT 0),
best AS (
  SELECT 1 AS s, e, e AS c FROM points
  UNION ALL
  SELECT s + 1, e, min(c) FROM (
    SELECT b.s, q.e, greatest(b.c, q.e - b.e) AS c FROM best b JOIN points q ON b.e <= q.e WHERE b.s < 8)
  GROUP BY s, e),
cap AS (SELECT min(c) AS c FROM best WHERE s = 8 AND e = (SELECT max(e) FROM points)),
walk AS (
  SELECT 0 AS i, CAST(0 AS BIGINT) AS pos
  UNION ALL
  SELECT i + 1, (SELECT max(e) FROM points WHERE e <= walk.pos + (SELECT c FROM cap)) FROM walk WHERE i < 8),
cuts AS (SELECT i, pos FROM walk WHERE i BETWEEN 1 AND 7),
placed AS (
  SELECT d.*, (SELECT count(*) FROM cuts WHERE pos < p.e) AS shard FROM d JOIN p ON d.t = p.t),
tab AS (
  SELECT list(v ORDER BY b) AS tab FROM (
    SELECT b, list_reduce(list_concat([b], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(0, 256)) AS b))),
crc AS (
  SELECT t, xor(list_reduce(list_concat([4294967295], list_transform(range(0, strlen(t)),
      lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
      lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) AS crc
  FROM (SELECT t, hex(encode(t)) AS h FROM g), tab)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, crc, size) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed JOIN crc ON placed.t = crc.t
"""


@register("op10_sharding", OP10_SQL)
def op10_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = shard(docs, shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@register("op4_quality_rules")
def op4_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = train(docs, table(spark, sf_dir, "labels"))
    return judge(docs, rules).drop("text")


@register("op5_html_extraction")
def op5_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@register("op6_bpe")
def op6_bpe(spark, sf_dir):
    return encode_digests(table(spark, sf_dir, "documents"), TOKENIZER)


@register("op3_packing")
def op3_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), TOKENIZER, capacity=1024, end=2)


OP7_SQL = r"""
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 85 * (na.n + nb.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.r = edges.a)
SELECT reach.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles,
  min(r) AS component_id, reach.doc_id = min(r) AS kept
FROM reach LEFT JOIN n ON n.doc_id = reach.doc_id GROUP BY reach.doc_id
"""


@register("op7_near_dedup", OP7_SQL)
def op7_near_dedup(spark, sf_dir):
    return classes(table(spark, sf_dir, "documents"), width=3, similarity=(85, 100))


@register("op1_ann")
def op1_ann(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


OP11_SQL = r"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""


@register("op11_exact_top_k", OP11_SQL)
def op11_exact_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)


# CRC-32 byte by byte from its polynomial, over the UTF-8 bytes of column x.
_CRC_TABLE = """tab AS (
  SELECT list(v ORDER BY b) AS tab FROM (
    SELECT b, list_reduce(list_concat([b], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(0, 256)) AS b)))"""
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(range(0, strlen(x)),
      lambda i: CAST('0x' || substr(hex(encode(x)), 2 * i + 1, 2) AS BIGINT))),
      lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"""

OP12_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
o AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[a-zA-Z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS c FROM o WHERE length(run) >= 6 GROUP BY doc_id, run),
h AS (SELECT run, c, {_CRC} AS h FROM (SELECT *, doc_id || ':' || run AS x FROM d), tab),
w AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT))
      || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, c FROM h),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (
  SELECT DISTINCT a.word AS word, b.word AS other FROM cut a JOIN cut b
    ON a.i = b.i AND a.rest = b.rest AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT cut.word, v.word FROM cut JOIN v ON cut.rest = v.word
  UNION SELECT v.word, cut.word FROM cut JOIN v ON cut.rest = v.word),
b AS (
  SELECT near.word, count(*) AS n_near, max(v.n) AS top,
    min(struct_pack(less := -v.n, other := v.word)).other AS best
  FROM near JOIN v ON near.other = v.word GROUP BY near.word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN top >= 5 * v.n THEN best END AS form, CASE WHEN top >= 5 * v.n THEN top END AS form_n
  FROM v LEFT JOIN b ON v.word = b.word),
walk AS (
  SELECT word, word AS root FROM f
  UNION ALL
  SELECT walk.word, f.form FROM walk JOIN f ON walk.root = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT walk.word, walk.root FROM walk JOIN f ON walk.root = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, ends.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM f JOIN ends ON f.word = ends.word
"""


def misspelt(found: DataFrame) -> DataFrame:
    """(word) for (doc_id, run): a 199th of the runs, by a hash of the document
    and the run, lose one code point. A null doc_id counts as an empty text."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return found.select(F.when(h % 199 == 0, cut).otherwise(F.col("run")).alias("word"))


@register("op12_spelling_variants", OP12_SQL)
def op12_spelling_variants(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(count_words(misspelt(runs(docs, 6)), min_points=6, min_count=5), ratio=5)


OP13_SQL = rf"""
WITH {_CRC_TABLE},
t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, CAST({_CRC} % 9 AS BIGINT) AS h, conv_id - conv_id % 5 AS base
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS x FROM t), tab),
r AS (
  SELECT c.conv_id, 0 AS own, place, role, text FROM c JOIN t ON t.conv_id = c.base AND place <= h
  UNION ALL SELECT c.conv_id, 1, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND place > h),
p AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth, strlen(text) AS size,
    string_agg(sha256(strlen(role) || chr(10) || role || text), '')
      OVER (PARTITION BY conv_id ORDER BY own, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size FROM p GROUP BY path, depth),
l AS (SELECT conv_id, max(depth) AS last FROM p GROUP BY conv_id),
e AS (
  SELECT path, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ends
  FROM p JOIN l ON p.conv_id = l.conv_id AND p.depth = l.last GROUP BY path),
k AS (SELECT substr(path, 1, 64 * (depth - 1)) AS up, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
pairs AS (
  SELECT substr(y.path, 1, 64 * d) AS path, y.path AS below, (y.n_convs - 1) * y.size AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM n) y),
s AS (
  SELECT pairs.path, CAST(sum(saved) AS BIGINT) AS saved_tokens,
    CAST(sum(CASE WHEN k.up IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves
  FROM pairs LEFT JOIN k ON pairs.below = k.up GROUP BY pairs.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs,
  coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
FROM n JOIN s ON n.path = s.path LEFT JOIN k ON n.path = k.up LEFT JOIN e ON n.path = e.path
  LEFT JOIN n u ON n.depth > 0 AND u.path = substr(n.path, 1, 64 * (n.depth - 1))
"""


def rebuilt(thin: DataFrame, family: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: (turns, conv_ids).

    Conversation c gets the first h turns of c - c % family (h = crc32(c) %
    (most + 1)), then its own turns after its first h.
    """
    own = thin.groupBy("conv_id").agg(F.max("turns").alias("own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    convs = own.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    base = own.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    convs = spool(convs.join(base, "base", "left").withColumn(
        "kept", F.least("h", F.coalesce("there", F.lit(0)))).select(
        "conv_id", "h", "base", "kept", (F.col("kept") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns")),
        "rebuilt")
    first = thin.where(F.col("place") <= most).select(F.col("conv_id").alias("base"), "place", "digest", "size")
    borrowed = (convs.select("conv_id", "base", "kept", "turns").join(first, "base").where("place <= kept")
                .select("conv_id", "place", "digest", "size", "turns"))
    rest = (thin.drop("turns").join(convs.select("conv_id", "h", "kept", "turns"), "conv_id").where("place > h")
            .select("conv_id", (F.col("place") - F.col("h") + F.col("kept")).alias("place"), "digest", "size", "turns"))
    return spool(borrowed.union(rest), "turns"), convs.select("conv_id")


@register("op13_prefix_trie", OP13_SQL)
def op13_prefix_trie(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie(*rebuilt(spool(thin_turns(rows), "thin")))
