"""The registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from functools import wraps
from pathlib import Path
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import bpe, classes, copies, language, leaks, licences, neighbours, pieces, private, quality, search, token_files, trie
from silverlode.llm.common import importable
from silverlode.plans.common import table


def tokenizer_spec(name: str = "byte_bpe_50k.json") -> str:
    """Text of a tokenizer file, read once on the driver and broadcast from there."""
    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_round_trip(table(spark, sf_dir, "documents"), tokenizer_spec())


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and every page; learned from the documents' own labels."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    rows = language.document_rows(docs).unionByName(language.page_rows(pages))
    out = language.judged(rows, language.learned_from(docs))
    is_doc = F.col("origin") == "documents"
    return out.select("origin", F.when(is_doc, F.col("id")).alias("doc_id"), F.when(~is_doc, F.col("id")).alias("page_id"), "lang", "posterior", "accepted")


def op2_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.find_private(table(spark, sf_dir, "documents"))


def op3_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces and scores of the file, read as a unigram vocabulary."""
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return pieces.token_counts(table(spark, sf_dir, "documents"), model)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.written_and_read(table(spark, sf_dir, "documents"), tokenizer_spec())


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"))


def op11_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes.class_scores(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def _ready(query):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _ready(f)
    for f in (
        op1_language, op2_private_spans, op3_piece_counts, op4_token_files, op5_nearest,
        op6_licences, op7_benchmark_leaks, op8_quality, op9_near_duplicates, op10_bpe_codec,
        op11_class_scores, op12_ranked_search, op13_conversation_trie,
    )
}
_LOWER = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"


def _words(between: str) -> str:
    return f"list_filter(regexp_split_to_array({_LOWER}, '{between}'), lambda x: x <> '')"


_LEAK_WORDS = _words(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LEAKS = f"""WITH items AS (SELECT item_id, {_LEAK_WORDS} AS w FROM benchmark),
  sized AS (SELECT item_id, w, least(len(w), {leaks.WINDOW}) AS size FROM items WHERE len(w) > 0),
  wins AS (SELECT DISTINCT item_id, size, list_slice(w, i, i + size - 1) AS win
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
  docs AS (SELECT row_number() OVER () AS r, doc_id, {_LEAK_WORDS} AS w FROM documents),
  places AS (SELECT r, size, w, unnest(range(1, len(w) - size + 2)) AS i
    FROM docs, (SELECT DISTINCT size FROM wins) WHERE len(w) >= size),
  met AS (SELECT r, i, p.size, item_id FROM (SELECT r, size, i, list_slice(w, i, i + size - 1) AS win FROM places) p
    JOIN wins ON p.size = wins.size AND p.win = wins.win),
  hit AS (SELECT r, count(DISTINCT pos) AS n FROM (SELECT r, unnest(range(i, i + size)) AS pos FROM met) GROUP BY r),
  named AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY r)
  SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
  FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""
# all pairs that share a shingle, then everything reachable: the definition, for tables of test size
_COPIES = f"""WITH RECURSIVE docs AS (SELECT doc_id, {_words(r"[\x20\x09-\x0D]+")} AS w FROM documents),
  cut AS (SELECT doc_id, CASE WHEN len(w) >= {copies.WORDS} THEN list_distinct(list_transform(range(1, len(w) - {copies.WORDS} + 2),
      lambda i: array_to_string(list_slice(w, i, i + {copies.WORDS} - 1), ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM docs),
  each AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM cut),
  links AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y FROM each a JOIN each b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {copies.PERCENT} * (a.n + b.n - count(*))),
  reach AS (SELECT doc_id AS x, doc_id AS y FROM docs UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
  least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
  SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM cut JOIN least ON doc_id = x"""
# crc32, bit by bit, of a number's decimal text
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i])::BIGINT)),
    lambda s, byte: list_reduce(list_prepend(xor(s, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))"""
_TRIE = f"""WITH own AS (SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
  opened AS (SELECT c, turns, {_CRC} % {trie.OPENINGS} AS h FROM own),
  rebuilt AS (SELECT o.c, list_concat(coalesce(f.turns[1:o.h], []), o.turns[o.h + 1:]) AS path
    FROM opened o LEFT JOIN own f ON f.c = o.c - o.c % {trie.FAMILY}),
  members AS (SELECT c, d, path[1:d] AS k, len(path) = d AS ends FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
  nodes AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c), '') AS ids
    FROM members GROUP BY k, d),
  kids AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
  weighed AS (SELECT nodes.k, d, conv_id, n_convs, ids, coalesce(kids.n, 0) AS n_children,
    CASE WHEN d > 0 THEN (n_convs - 1) * strlen(nodes.k[d].x) ELSE 0 END AS w FROM nodes LEFT JOIN kids USING (k)),
  sums AS (SELECT k[1:top] AS k, count_if(n_children = 0) AS n_leaves, sum(w) AS saved
    FROM (SELECT *, unnest(range(0, d + 1)) AS top FROM weighed) GROUP BY k[1:top])
  SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves,
    s.saved::BIGINT AS saved_tokens, sha256(n.ids) AS ends_sha256
  FROM weighed n JOIN sums s ON s.k = n.k LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.k = n.k[1:n.d - 1]"""
_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_RANKED = f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
  total AS (SELECT count(*) AS N, sum(len(t))::BIGINT AS L FROM docs WHERE len(t) > 0),
  tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(t) AS t FROM docs) GROUP BY ALL),
  weight AS (SELECT t, CAST(floor(1000 * ln((2 * N + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY t, N),
  items AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS t FROM benchmark),
  asked AS (SELECT DISTINCT q, item_id, unnest(t) AS t FROM items),
  scored AS (SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(docs.t) * N) // L)))) AS BIGINT) AS score
    FROM asked JOIN weight USING (t) JOIN tf USING (t) JOIN docs USING (r), total GROUP BY q, item_id, r, doc_id)
  SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
  FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0) WHERE rank <= {search.BEST}"""
ORACLE: dict[str, str] = {
    "op12_ranked_search": _RANKED,
    "op7_benchmark_leaks": _LEAKS,
    "op9_near_duplicates": _COPIES,
    "op13_conversation_trie": _TRIE,
}
