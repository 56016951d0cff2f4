"""The queries ``opN_<name>`` of this subpackage: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import decontamination, embeddings, exact_dedup, extraction, language, licenses, packing, prefix_trie, scoring, secrets, source_divergence, token_counts
from pulsegrid.llm.graph import read
from pulsegrid.llm.simhash import simhash_groups


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer that is installed with the Python environment of every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector, at a cosine of 0.95 or more."""
    found = embeddings.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    scan = licenses.scan(read(spark, sf_dir, "documents"))
    base, found = F.col("licenses.base"), F.col("licenses.found")
    words = F.transform(base, lambda b: b["word"])
    base_labels = F.array_sort(F.array_distinct(F.transform(base, lambda b: b["label"])))
    labels = F.array_sort(F.array_distinct(F.concat(base_labels, F.transform(found, lambda d: d["label"]))))
    sure = F.array_max(F.concat(
        F.array(F.lit(0.0)), F.transform(found, lambda d: d["confidence"]), F.transform(base, lambda _: F.lit(0.9))))
    return scan.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("licenses.n_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), sure.alias("score"))


def op3_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, learned from those whose crc32(doc_id) mod 7 is not 2."""
    return scoring.score(read(spark, sf_dir, "documents"), modulus=7, remainder=2, depth=scoring.DEPTH)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of 2048 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op5_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = extraction.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is or with other names, numbers and units."""
    return decontamination.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    scan = secrets.scan(read(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*[secrets.KINDS.index(k) for k in kinds]))
    return scan.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(secrets.listed(of("assign", "access", "hex")), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tokens of every document, with the pieces and scores of a public vocabulary."""
    vocabulary = token_counts.Vocabulary.from_sentencepiece(tokenizer_path("piece_bpe_32k.model"))
    counts = token_counts.count_tokens(read(spark, sf_dir, "documents"), vocabulary)
    return counts.select(F.col("id").alias("doc_id"), "n_tokens", "token_score", "n_unknown")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those whose crc32(doc_id) mod 4 is not 2."""
    docs = read(spark, sf_dir, "documents")
    model = language.fit(docs, modulus=4, remainder=2)
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    return language.identify(docs.select("doc_id", "text"), model).select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "lang_pred",
        F.col("lang_score").alias("score"), F.col("lang_ambiguous").alias("ambiguous"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: shingles of 4 words, links at 4 bits or fewer."""
    groups = simhash_groups(read(spark, sf_dir, "documents"), words=4, distance=4)
    return groups.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source of a language from the others, and the terms that set it apart from the language."""
    return source_divergence.divergences(read(spark, sf_dir, "documents"), least_docs=3, top=200)


OP11_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS i, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
              FROM documents),
words AS (SELECT i, lang, source, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT i) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
vocabulary AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS (SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(t.total, 0) AS total
           FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN vocabulary USING (lang)
           LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) t USING (lang, source)),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                  1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p,
                  1 + (1000000000::HUGEINT * (k.n + 1)) // (vocabulary.total + vocabulary.v) AS q
           FROM groups g JOIN kept k USING (lang) JOIN vocabulary USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
          FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
answer AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM answer)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all conversations, rebuilt so that five in a row share first turns."""
    return prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(read(spark, sf_dir, "conversations")), siblings=5, heads=9))


#: crc32 bit by bit, as the SQL has no such function.
OP12_SQL = """
WITH RECURSIVE turns AS (
  SELECT conv_id, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         octet_length(encode(coalesce(text, ''))) AS bytes, turn
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS pos FROM turns),
convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
             lambda c, d: list_reduce(list_prepend(xor(c, d), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                      lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, t.pos, digest, bytes FROM convs c JOIN placed t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.pos - c.h, digest, bytes
  FROM convs c JOIN placed t ON t.conv_id = c.conv_id AND t.pos >= c.h LEFT JOIN convs b ON b.conv_id = c.base),
steps AS (
  SELECT conv_id, 0 AS depth, 0 AS bytes, '' AS path FROM convs
  UNION ALL
  SELECT conv_id, pos + 1, bytes, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY pos) FROM rebuilt),
ends AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
         FROM (SELECT conv_id, max_by(path, depth) AS path FROM steps GROUP BY conv_id) GROUP BY path),
nodes AS (SELECT path, depth, left(path, 64 * (depth - 1)) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes
          FROM steps GROUP BY path, depth),
children AS (SELECT parent AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
weighed AS (SELECT nodes.*, coalesce(n, 0) AS n_children, (n_convs - 1) * bytes AS saved FROM nodes LEFT JOIN children USING (path)),
below AS (SELECT left(path, 64 * d) AS path, sum((n_children = 0)::INTEGER) AS leaves, sum(saved) AS saved
          FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM weighed) GROUP BY 1)
SELECT w.conv_id, w.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, below.leaves::BIGINT AS n_leaves,
       below.saved::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM weighed w JOIN below USING (path) LEFT JOIN ends USING (path) LEFT JOIN nodes p ON w.depth > 0 AND p.path = w.parent"""


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document and whether it stays."""
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH lowered AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{exact_dedup.UPPER}', '{exact_dedup.LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, text_sha256
FROM lowered WINDOW same AS (PARTITION BY text_sha256)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embeddings": op1_embeddings,
    "op2_licenses": op2_licenses,
    "op3_scoring": op3_scoring,
    "op4_packing": op4_packing,
    "op5_extraction": op5_extraction,
    "op6_decontamination": op6_decontamination,
    "op7_secrets": op7_secrets,
    "op8_token_counts": op8_token_counts,
    "op9_language": op9_language,
    "op10_simhash": op10_simhash,
    "op11_source_divergence": op11_source_divergence,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_exact_dedup": op13_exact_dedup,
}
#: The SQL of the queries that SQL can express; the others are compared with plain versions in the tests.
ORACLES: dict[str, str] = {"op11_source_divergence": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_exact_dedup": OP13_SQL}
