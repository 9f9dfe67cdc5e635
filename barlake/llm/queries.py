"""The registered query of each operator, with its production parameters over
its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import credentials, decontam, embedding_lsh, jaccard_rtree, katz, langid_crf, mixing, packing, prefix_trie, quality_cnn, token_cache, warc, whitening
from barlake.llm.storage import table
from barlake.session import scratch_dir


def q_warc(spark: SparkSession, d: str) -> DataFrame:
    records = warc.archive_round_trip(table(spark, d, "pages"), scratch_dir(spark, "llm-warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def q_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"))


def q_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_cache.count_tokens(table(spark, d, "documents"), scratch_dir(spark, "llm-token-cache"))


def q_secrets(spark: SparkSession, d: str) -> DataFrame:
    return credentials.scan_secrets(table(spark, d, "documents"))


def q_embeddings(spark: SparkSession, d: str) -> DataFrame:
    return embedding_lsh.near_duplicates(table(spark, d, "embeddings"))


def q_decontam(spark: SparkSession, d: str) -> DataFrame:
    return decontam.contamination(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("longest")


def q_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality_cnn.score_quality(table(spark, d, "documents"), table(spark, d, "labels"))


def q_language(spark: SparkSession, d: str) -> DataFrame:
    return langid_crf.predict_languages(table(spark, d, "documents"))


def q_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_rtree.near_duplicates(table(spark, d, "documents"))


def q_katz(spark: SparkSession, d: str) -> DataFrame:
    return katz.score_documents(table(spark, d, "documents"))


def q_katz_trigram(spark: SparkSession, d: str) -> DataFrame:
    return katz.score_documents(table(spark, d, "documents"), order=3)


def q_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, d, "conversations")).drop("id")


def q_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whiten(table(spark, d, "embeddings"), components=32)


def q_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents")).drop("uid")


QUERIES = {
    "op1_chunked_warc": q_warc,
    "op2_harmonic_packing": q_packing,
    "op3_quality_cnn": q_quality,
    "op4_suffix_decontamination": q_decontam,
    "op5_jaccard_rtree": q_jaccard,
    "op6_language_crf": q_language,
    "op7_token_cache": q_token_counts,
    "op8_credential_linking": q_secrets,
    "op9_embedding_near_dedup": q_embeddings,
    "op10_katz_backoff": q_katz,
    "op10_katz_trigram": q_katz_trigram,
    "op11_prefix_trie": q_trie,
    "op12_cholesky_whitening": q_whitening,
    "op13_pareto_mixing": q_mixing,
}

_ASCII = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_COMPONENTS = """, edge AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(id, r) AS (SELECT {id}, {id} FROM {nodes} UNION SELECT b.y, reach.r FROM reach JOIN edge b ON b.x = reach.id),
comp AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
"""


def _mixing_sql() -> str:
    """The strata of the sample as one common table each."""
    levels = range(len(mixing.STRATA) + 1)
    stratum = " + ".join(f"CAST(size * {k} < rest AS BIGINT)" for k in mixing.STRATA)
    cuts, last = [], "goal"
    for s in levels:
        due = f"CASE WHEN rest > 0 THEN CAST(rest AS HUGEINT) * coalesce((SELECT sum(size) FROM o WHERE o.source_no = g.source_no AND stratum <= {s}), 0) // source_size ELSE 0 END"
        cuts.append(f"""m{s} AS (SELECT g.*, {due} - given{s} AS may{s} FROM {last} g),
e{s} AS (SELECT g.*, coalesce((SELECT max(upto) FROM o WHERE o.source_no = g.source_no AND stratum = {s} AND g.rest > 0 AND upto <= may{s}), 0) AS cut{s} FROM m{s} g),
c{s} AS (SELECT *, given{s} + cut{s} AS given{s + 1} FROM e{s})""")
        last = f"c{s}"
    cut = "[" + ", ".join(f"cut{s}" for s in levels) + "][stratum + 1]"
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no,
      {list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
      {mixing.LIMIT} * source_size AS cap FROM s),
x AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS rate FROM w
      WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT rate FROM x WHERE cap > weight * rate ORDER BY CAST(cap AS DOUBLE) / weight, source_no LIMIT 1),
t AS (SELECT source_no, source, source_size, least(CAST(cap AS DOUBLE), weight * coalesce((SELECT rate FROM level), 1e300)) AS target FROM w),
goal AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS whole,
      CAST(floor(target + 0.5) AS BIGINT) - whole * source_size AS rest, 0 AS given0 FROM t),
o AS (SELECT *, sum(size) OVER (PARTITION BY source_no, stratum ORDER BY rank, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto FROM
      (SELECT d.doc_id, d.size, goal.source_no, {stratum} AS stratum,
         u / (1 - u) / (CASE WHEN rest > 0 THEN CAST(rest AS DOUBLE) / source_size / (1 - CAST(rest AS DOUBLE) / source_size) ELSE 1 END) AS rank
       FROM (SELECT *, (CAST(CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
               / {1 << 52}.0::DOUBLE AS u FROM d) d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source)),
{", ".join(cuts)},
j AS (SELECT o.*, c.source, source_size, target, whole, rest - given{len(cuts)} AS remains, upto <= {cut} AS inside FROM o JOIN {last} c USING (source_no)),
one AS (SELECT source_no, min((abs(remains - size), stratum, upto)) AS k FROM j WHERE remains > 0 AND size > 0 AND NOT inside AND size < 2 * remains GROUP BY source_no),
z AS (SELECT j.*, CASE WHEN size > 0 THEN whole + CAST(inside OR coalesce(stratum = k[2] AND upto = k[3], false) AS BIGINT) ELSE 0 END AS copies
      FROM j LEFT JOIN one USING (source_no))
SELECT doc_id, source, size, source_size, target, CAST(copies AS BIGINT) AS copies, CAST(copies * size AS BIGINT) AS taken FROM z"""


#: CRC-32 of a decimal number, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], range(0, 8 * len({s}))), lambda crc, i:
  list_transform([xor(crc, CASE WHEN i % 8 = 0 THEN ascii({s}[CAST(i // 8 + 1 AS INT)]) ELSE 0 END)],
                 lambda v: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))[1]))"""

ORACLE_SQL: dict[str, str] = {
    "op11_prefix_trie": f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) - 1 AS i FROM r),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, h, n FROM (SELECT conv_id, count(*) AS n,
        {_CRC32.format(s="CAST(conv_id AS VARCHAR)")} % 6 AS h FROM r GROUP BY conv_id)),
k AS (SELECT c.*, least(h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN (SELECT conv_id, n FROM c) b ON b.conv_id = c.base),
m AS (SELECT k.conv_id, t.i AS place, role, text FROM k JOIN t ON t.conv_id = k.base AND t.i < h
      UNION ALL SELECT k.conv_id, t.i - h + taken, role, text FROM k JOIN t ON t.conv_id = k.conv_id AND t.i >= h),
p AS (SELECT conv_id, place + 1 AS depth, length(text) AS points, string_agg(length(role) || ':' || length(text) || ':' || role || text, '')
        OVER (PARTITION BY conv_id ORDER BY place) AS path FROM m),
q AS (SELECT conv_id, depth, points, path, lag(path, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM p
      UNION ALL SELECT conv_id, 0, 0, '', NULL FROM c),
node AS (SELECT path, min(up) AS up, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(points) AS points FROM q GROUP BY path, depth),
fan AS (SELECT up, count(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY up),
own AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN fan ON fan.up = node.path),
total AS (SELECT q.path, count(*) FILTER (own.n_children = 0) AS n_leaves, sum((own.n_convs - 1) * own.points) AS saved_tokens
          FROM own JOIN q ON q.conv_id = own.conv_id AND q.depth <= own.depth GROUP BY q.path),
ends AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
         FROM (SELECT conv_id, arg_max(path, depth) AS path FROM q GROUP BY conv_id) GROUP BY path)
SELECT own.conv_id, CAST(own.depth AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM own JOIN total USING (path) LEFT JOIN node parent ON parent.path = own.up LEFT JOIN ends ON ends.path = own.path""",
    "op13_pareto_mixing": _mixing_sql(),
    "op1_chunked_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(x, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1)), '')
    AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM t""",
    "op4_suffix_decontamination": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_ASCII.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all({_ASCII.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS t
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
found AS (SELECT dw.doc_id, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.t = bw.t),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM
        (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS pos FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS said
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(said, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op5_jaccard_rtree": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_ASCII.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
sh AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM sh a JOIN sh b ON a.t = b.t AND a.doc_id < b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*)))
{_COMPONENTS.format(id="doc_id", nodes="documents")}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM s JOIN comp ON id = doc_id""",
    "op9_embedding_near_dedup": f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98)
{_COMPONENTS.format(id="vec_id", nodes="embeddings")},
n AS (SELECT x, count(*) AS n_links FROM edge GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN comp ON id = vec_id LEFT JOIN n ON n.x = vec_id""",
}
