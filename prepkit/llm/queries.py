"""The operators of this subpackage over whole tables, each with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.llm import (
    collocations,
    conversation_trie,
    line_dedup,
    mixing,
    neighbours,
    packing,
    quality,
    sentence_pieces,
    sharding,
    simhash,
    substring_dedup,
    token_files,
    url_lists,
)
from prepkit.llm.shared import table

SHARDS = 24


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_paragraph_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_paragraphs(table(spark, folder, "documents"), window=substring_dedup.WINDOW_WORDS)


def op2_concat_pack(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(table(spark, folder, "documents"), byte_bpe())
    return cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_ngram_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(table(spark, folder, "documents"))


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents)),
shared AS (
  SELECT k, min(doc_id) AS first FROM lines WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT l.doc_id, l.pos, l.line, s.k IS NOT NULL AND l.doc_id <> s.first AS lost
  FROM lines l LEFT JOIN shared s ON l.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op5_range_coded_ids(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"), byte_bpe())


def op7_jump_hash_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_manifest(table(spark, folder, "documents"), "doc_id", "text", SHARDS)


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, folder, "documents"))


def op10_entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies")


def dated_lists(pages: DataFrame) -> DataFrame:
    """List events that follow from the pages' hosts: a digest of the host says on which list it is and when.

    Two hosts in three have entries; half of these are removed again and some come back. A host's parent
    domain is blocked for a time of its own.
    """
    host = url_lists.host_of(F.col("url"))
    hosts = pages.select(host.alias("entry")).filter("entry is not null").distinct()
    parents = hosts.select(F.regexp_replace("entry", r"^[^.]+\.", "").alias("entry")).filter("entry like '%.%'")
    names = hosts.unionByName(parents).distinct()

    def digit(at: int, n: int, below: int):
        return F.conv(F.substring(F.md5("entry"), at, n), 16, 10).cast("int") % below

    first = F.date_add(F.lit("2024-01-01").cast("date"), digit(1, 3, 300))
    gone = F.date_add(first, 1 + digit(4, 2, 120))
    back = F.date_add(gone, 1 + digit(6, 2, 60))
    steps = F.array(
        F.struct(first.alias("on"), F.lit("add").alias("action"), F.lit(0).alias("step")),
        F.struct(gone.alias("on"), F.lit("remove").alias("action"), F.lit(1).alias("step")),
        F.struct(back.alias("on"), F.lit("add").alias("action"), F.lit(2).alias("step")))
    picked = names.filter(digit(8, 2, 3) < 2).select(
        "entry", F.when(digit(10, 2, 4) == 0, "allow").otherwise("block").alias("list"),
        digit(12, 1, 4).alias("last"), F.explode(steps).alias("s"))
    return picked.filter(F.col("s.step") <= F.col("last")).select(
        "list", "entry", F.col("s.on").cast("timestamp_ntz").alias("at"), F.col("s.action").alias("action"))


def op6_temporal_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 366).cast("int"))
    captures = pages.withColumn("fetched_at", day.cast("timestamp_ntz"))
    return url_lists.evaluate(captures, dated_lists(pages))


OP6_SQL = r"""
WITH captures AS (
  SELECT page_id, CAST(DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INT) AS TIMESTAMP) AS fetched_at,
         nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.'), '') AS host
  FROM pages),
hosts AS (SELECT DISTINCT host AS entry FROM captures WHERE host IS NOT NULL),
names AS (
  SELECT entry FROM hosts
  UNION SELECT regexp_replace(entry, '^[^.]+\.', '') FROM hosts WHERE regexp_replace(entry, '^[^.]+\.', '') LIKE '%.%'),
digits AS (
  SELECT entry,
         CAST('0x' || substr(md5(entry), 1, 3) AS INT) % 300 AS a, CAST('0x' || substr(md5(entry), 4, 2) AS INT) % 120 AS b,
         CAST('0x' || substr(md5(entry), 6, 2) AS INT) % 60 AS c, CAST('0x' || substr(md5(entry), 8, 2) AS INT) % 3 AS picked,
         CAST('0x' || substr(md5(entry), 10, 2) AS INT) % 4 AS kind, CAST('0x' || substr(md5(entry), 12, 1) AS INT) % 4 AS last
  FROM names),
dated AS (
  SELECT entry, CASE WHEN kind = 0 THEN 'allow' ELSE 'block' END AS list, last,
         CAST(DATE '2024-01-01' + a AS TIMESTAMP) AS t0, CAST(DATE '2024-01-01' + a + 1 + b AS TIMESTAMP) AS t1,
         CAST(DATE '2024-01-01' + a + 1 + b + 1 + c AS TIMESTAMP) AS t2
  FROM digits WHERE picked < 2),
intervals AS (
  SELECT list, entry, t0 AS valid_from, CASE WHEN last >= 1 THEN t1 END AS valid_to FROM dated
  UNION ALL SELECT list, entry, t2, NULL FROM dated WHERE last >= 2),
active AS (
  SELECT c.page_id, i.list, i.entry, i.valid_from,
         row_number() OVER (PARTITION BY c.page_id ORDER BY length(i.entry) DESC, i.list = 'allow' DESC, i.valid_from DESC) AS place
  FROM captures c JOIN intervals i ON (c.host = i.entry OR ends_with(c.host, '.' || i.entry))
   AND c.fetched_at >= i.valid_from AND (i.valid_to IS NULL OR c.fetched_at < i.valid_to))
SELECT c.page_id, c.fetched_at, a.list, a.entry, a.valid_from, coalesce(a.list = 'block', false) AS blocked
FROM captures c LEFT JOIN active a ON a.page_id = c.page_id AND a.place = 1
"""


def op9_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    done = sentence_pieces.round_trip(table(spark, folder, "documents").select("doc_id", "text"), piece_bpe())
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


OP12_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts),
words AS (SELECT lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM words GROUP BY lang),
counts AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws) GROUP BY ALL),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT lang, phrase, k, a, j, array_to_string(ws[1:j], ' ') AS lefts, array_to_string(ws[j + 1:k], ' ') AS rights
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates)),
scores AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.j, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.lefts
              JOIN counts y ON y.lang = c.lang AND y.phrase = c.rights),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_phrases AS (
  SELECT lang, k, a, s, array_to_string(ws[s:s + m - 1], ' ') AS phrase, m
  FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates), (SELECT unnest([1, 2, 3]) AS s) WHERE s + m - 1 <= k),
around AS (SELECT lang, phrase, max(a) AS most FROM inner_phrases GROUP BY lang, phrase),
kept AS (
  SELECT l.* FROM lowest l LEFT JOIN around o USING (lang, phrase)
  WHERE o.most IS NULL OR 100::HUGEINT * o.most < 80::HUGEINT * l.a),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT p.lang, p.rank, p.phrase, p.a, p.l, p.r, t.n, p.score FROM placed p JOIN totals t USING (lang) WHERE p.rank <= 2000
"""


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = conversation_trie.numbered_turns(table(spark, folder, "conversations"))
    return conversation_trie.trie(*conversation_trie.rebuilt(turns))


OP13_SQL = r"""
WITH RECURSIVE crc_steps AS (
  SELECT i::BIGINT AS byte, 0 AS k, i::BIGINT AS v FROM range(256) t(i)
  UNION ALL SELECT byte, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_steps WHERE k < 8),
crc_table AS (SELECT byte, v FROM crc_steps WHERE k = 8),
ids AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS digits FROM conversations WHERE conv_id IS NOT NULL),
crcs AS (
  SELECT conv_id, digits, 0 AS i, 4294967295::BIGINT AS crc FROM ids
  UNION ALL
  SELECT c.conv_id, c.digits, c.i + 1, xor(c.crc >> 8, t.v)
  FROM crcs c JOIN crc_table t ON t.byte = xor(c.crc, ascii(substr(c.digits, c.i + 1, 1))) & 255
  WHERE c.i < length(c.digits)),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS source, xor(crc, 4294967295) % 9 AS h FROM crcs WHERE i = length(digits)),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
parts AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.source AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
steps AS (
  SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS bytes,
         string_agg(length(role) || ' ' || length(text) || ' ' || role || text, '')
           OVER (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING) AS path
  FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
paths AS (
  SELECT conv_id, depth, bytes, path, lag(path, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
         count(*) OVER (PARTITION BY conv_id) AS length FROM steps
  UNION ALL SELECT c.conv_id, 0, 0, '', NULL, count(s.depth) FROM convs c LEFT JOIN steps s USING (conv_id) GROUP BY c.conv_id),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, min(parent) AS parent, min(bytes) AS bytes, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
  FROM paths GROUP BY path, depth),
children AS (SELECT parent AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
counted AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (path)),
subtree AS (
  SELECT p.path, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.bytes) AS saved_tokens
  FROM counted v JOIN paths p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.path)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN subtree s USING (path) LEFT JOIN nodes up ON n.depth > 0 AND up.path = n.parent
"""


QUERIES = {
    "op1_paragraph_minhash": (op1_paragraph_minhash, None),
    "op2_concat_pack": (op2_concat_pack, None),
    "op3_ngram_perplexity": (op3_ngram_perplexity, None),
    "op4_line_dedup": (op4_line_dedup, OP4_SQL),
    "op5_range_coded_ids": (op5_range_coded_ids, None),
    "op7_jump_hash_shards": (op7_jump_hash_shards, None),
    "op8_simhash": (op8_simhash, None),
    "op6_temporal_url_lists": (op6_temporal_url_lists, OP6_SQL),
    "op9_learned_partitions": (op9_learned_partitions, None),
    "op10_entropy_mix": (op10_entropy_mix, None),
    "op11_sentencepiece": (op11_sentencepiece, None),
    "op12_collocations": (op12_collocations, OP12_SQL),
    "op13_conversation_trie": (op13_conversation_trie, OP13_SQL),
}
