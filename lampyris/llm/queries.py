"""The registered query of each operator, over the whole of its tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lampyris.llm.byte_bpe import encode
from lampyris.llm.fertility import quality_rules
from lampyris.llm.interval_search import build_index as build_interval_index, interval_search
from lampyris.llm.licenses import license_scan
from lampyris.llm.mixing import SEED, TERMS, mixed
from lampyris.llm.ngram_join import similar_documents
from lampyris.llm.packing import pack, token_pieces
from lampyris.llm.preferences import last_reply_pairs, preference_segments
from lampyris.llm.prefix_trie import EVERY, HEADS, prefix_trie, rebuilt
from lampyris.llm.search import B, DIGITS, K1, build_index, search
from lampyris.llm.secrets import secret_scan
from lampyris.llm.token_counts import context_limits, length_histogram
from lampyris.llm.toxicity import toxicity

TOP = 10
ITEM_TOP = 20


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each encoded length of a document: what it means as a context limit."""
    return context_limits(length_histogram(_read(spark, sf_dir, "documents")))


def bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of `benchmark` whose item_id is divisible by 20, searched for in all documents."""
    asked = _read(spark, sf_dir, "benchmark").where("item_id % 20 = 0").select(F.col("item_id").alias("query_id"), "text")
    return search(build_index(_read(spark, sf_dir, "documents")), asked, TOP)


def bm25_search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose doc_id is divisible by 20, searched for in all documents."""
    docs = _read(spark, sf_dir, "documents")
    return search(build_index(docs), docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text"), TOP)


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return similar_documents(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, repeated so that each source gives the same share of the text."""
    return mixed(_read(spark, sf_dir, "documents"))


def best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document's pieces in sequences of 1024 tokens."""
    return pack(token_pieces(_read(spark, sf_dir, "documents")))


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return license_scan(_read(spark, sf_dir, "documents"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate by its digest, with the forest's verdict."""
    found = secret_scan(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "place", F.length("candidate").alias("n_chars"), F.sha2("candidate", 256).alias("digest"), "score", "is_secret")


def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of prompts and masked completions from all conversations."""
    return preference_segments(*last_reply_pairs(_read(spark, sf_dir, "conversations")))


def fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality_rules(_read(spark, sf_dir, "documents"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    return toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every whole text, and of the bytes that the ids turn back into."""
    done = encode(_read(spark, sf_dir, "documents").select("doc_id", "text"), decoded=True)
    sha = lambda c: F.sha2(F.col(c), 256).alias(f"{c}_sha256")  # noqa: E731
    return done.select("doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), sha("ids"), sha("decoded"))


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents for every item of `benchmark`."""
    items = _read(spark, sf_dir, "benchmark").select("item_id", "text")
    return interval_search(build_interval_index(_read(spark, sf_dir, "documents")), items, ITEM_TOP, "item_id")


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, rebuilt on shared beginnings."""
    return prefix_trie(rebuilt(_read(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_token_counts": token_counts,
    "op2_bm25_search": bm25_search,
    "op3_ngram_jaccard_join": ngram_jaccard,
    "op4_source_mixing": source_mixing,
    "op5_best_two_fit_packing": best_two_fit,
    "op6_license_scan": licenses,
    "op7_secret_scan": secrets,
    "op8_preference_pairs": preference_pairs,
    "op9_fertility_rules": fertility_rules,
    "op10_toxicity": toxicity_scores,
    "op11_byte_bpe": byte_bpe,
    "op12_ranked_search": ranked_search,
    "op13_prefix_trie": conversation_trie,
}

#: Further queries of an operator.
MORE = {"op2_bm25_search_documents": bm25_search_documents}

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLES = {
    "op2_bm25_search": f"""
WITH q AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all({_FOLD.format('text')}, '{_ALNUM}')) AS word FROM benchmark WHERE item_id % 20 = 0),
d AS (SELECT doc_id, regexp_extract_all({_FOLD.format('text')}, '{_ALNUM}') AS words FROM documents),
stats AS (SELECT count(*) AS n, sum(len(words)) / count(*) AS mean FROM d),
p AS (SELECT doc_id, len(words) AS size, unnest(words) AS word FROM d),
tf AS (SELECT doc_id, size, word, count(*) AS tf FROM p WHERE word IN (SELECT word FROM q) GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY word),
s AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {K1 + 1} / (tf + {K1} * (1 - {B} + {B} * size / mean))), {DIGITS}) AS score
      FROM q JOIN tf USING (word) JOIN df USING (word), stats GROUP BY query_id, doc_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s)
SELECT query_id, rank, doc_id, score FROM r WHERE rank <= {TOP}""",
    "op4_source_mixing": f"""
WITH s AS (SELECT source, CAST(sum(length(text)) AS DOUBLE) AS chars FROM documents GROUP BY source),
rates AS (SELECT source, (SELECT sum(chars) FROM s) / (SELECT count(*) FROM s) / chars AS rate FROM s),
draws AS (SELECT source, rate, greatest(1, CAST(ceil(rate / 16) AS INTEGER)) AS parts FROM rates),
terms AS (SELECT source, parts, k, exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)) AS p FROM draws, range({TERMS}) AS r(k)),
cdf AS (SELECT source, parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
tables AS (SELECT source, parts, list(c ORDER BY k) AS cdf FROM cdf GROUP BY source, parts),
u AS (SELECT d.doc_id, t.cdf, unnest(range(t.parts)) AS part FROM documents d JOIN tables t ON d.source = t.source),
counts AS (SELECT doc_id, CAST(sum(len(list_filter(cdf, lambda x: x <= CAST('0x' || substr(md5('{SEED}/' || part || '/' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0))) AS INTEGER) AS n_copies
           FROM u GROUP BY doc_id)
SELECT d.*, CAST(unnest(range(1, n_copies + 1)) AS INTEGER) AS copy, n_copies FROM documents d JOIN counts USING (doc_id)""",
    "op8_preference_pairs": r"""
WITH turns AS (SELECT conv_id, turn, min({'role': role, 'text': text}) AS said FROM conversations GROUP BY conv_id, turn),
replied AS (SELECT conv_id, max(turn) AS final FROM turns WHERE said.role = 'assistant' GROUP BY conv_id),
chosen AS (SELECT conv_id, turn, said FROM turns JOIN replied USING (conv_id) WHERE turn <= final),
replies AS (SELECT conv_id, final, said.text AS reply FROM turns JOIN replied USING (conv_id) WHERE turn = final),
rejected AS (SELECT conv_id, turn, said FROM chosen JOIN replied USING (conv_id) WHERE turn < final
  UNION ALL SELECT a.conv_id, a.final, {'role': 'assistant', 'text': b.reply} FROM replies a JOIN replies b ON b.conv_id = xor(a.conv_id, 1)),
sides AS (SELECT conv_id, turn, c.said AS c, r.said AS r FROM chosen c FULL JOIN rejected r USING (conv_id, turn)),
fork AS (SELECT conv_id, min(turn) FILTER (c IS NULL OR r IS NULL OR c IS DISTINCT FROM r) AS fork FROM sides GROUP BY conv_id),
parts AS (
  SELECT conv_id, 'prompt' AS part, turn, c AS said FROM sides JOIN fork USING (conv_id) WHERE fork IS NULL OR turn < fork
  UNION ALL SELECT conv_id, 'chosen', turn, c FROM sides JOIN fork USING (conv_id) WHERE turn >= fork AND c IS NOT NULL
  UNION ALL SELECT conv_id, 'rejected', turn, r FROM sides JOIN fork USING (conv_id) WHERE turn >= fork AND r IS NOT NULL)
SELECT conv_id AS pair_id, part, turn, said.role AS role, '<|' || coalesce(said.role, '') || '|>' || chr(10) || coalesce(said.text, '') || chr(10) || '<|end|>' || chr(10) AS rendered,
  CAST(part <> 'prompt' AND coalesce(said.role = 'assistant', false) AS INTEGER) AS loss_mask FROM parts""",
    "op12_ranked_search": f"""
WITH q AS (SELECT item_id, unnest(regexp_extract_all({_FOLD.format('text')}, '{_ALNUM}')) AS word FROM benchmark),
asked AS (SELECT item_id, word, count(*) AS times FROM q GROUP BY ALL),
d AS (SELECT doc_id, regexp_extract_all({_FOLD.format('text')}, '{_ALNUM}') AS words FROM documents),
stats AS (SELECT count(*) FILTER (len(words) > 0) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_all FROM d),
p AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS size, unnest(words) AS word FROM d),
tf AS (SELECT doc_id, size, word, count(*) AS tf FROM p WHERE word IN (SELECT word FROM asked) GROUP BY ALL),
df AS (SELECT word, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, stats GROUP BY word, n_docs),
s AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * n_docs) // n_all)))) AS BIGINT) AS score
      FROM asked JOIN tf USING (word) JOIN df USING (word), stats GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {ITEM_TOP}""",
    "op13_prefix_trie": rf"""
WITH t AS (SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM conversations),
own AS (SELECT conv_id, list(said ORDER BY place) AS turns, conv_id - conv_id % {EVERY} AS base,
    CAST(xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
      lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, k: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % {HEADS} AS INTEGER) AS h
  FROM t GROUP BY conv_id),
whole AS (SELECT own.conv_id, list_concat(coalesce(base.turns[1:own.h], []), own.turns[own.h + 1:]) AS turns FROM own LEFT JOIN own base ON base.conv_id = own.base),
prefix AS (SELECT conv_id, len(turns) AS size, d AS depth, turns[1:d] AS node FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM whole)),
node AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = size), '')) AS ends_sha256 FROM prefix GROUP BY node, depth),
above AS (SELECT *, node[1:depth - 1] AS up FROM node),
kids AS (SELECT up AS node, depth - 1 AS depth, count(*) AS n_children FROM above WHERE depth > 0 GROUP BY ALL),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(len(regexp_extract_all(node.node[depth].text, '[^ 	-]+')), 0) AS saved
  FROM above AS node LEFT JOIN kids USING (node, depth)),
sums AS (SELECT node[1:e] AS node, e AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(range(depth + 1)) AS e FROM full_node) GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_node n JOIN sums s ON s.node = n.node AND s.depth = n.depth LEFT JOIN node p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.up""",
}
