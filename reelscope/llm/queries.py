"""The registered query of each operator, over whole tables, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelscope.llm.chat_format import digest_conversations, format_conversations
from reelscope.llm.decontaminate import contaminated_pairs
from reelscope.llm.divergence import source_divergence
from reelscope.llm.html_text import extract_main_text
from reelscope.llm.line_dedup import without_repeated_lines
from reelscope.llm.masked_lm import score_documents
from reelscope.llm.ngram_join import similar_components
from reelscope.llm.packing import pack_documents
from reelscope.llm.phrases import collocations
from reelscope.llm.pii_bootstrap import find_personal_data
from reelscope.llm.quality_model import fit_quality, score_quality
from reelscope.llm.repetition import repetition_rules
from reelscope.llm.url_rules import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# Shared by several oracles: every text's distinct 5-word shingles, lower-cased.
_SHINGLES = r"""{name}w AS (
  SELECT {key}, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM {table}),
{name} AS (
  SELECT DISTINCT {key}, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')) END) AS shingle
  FROM {name}w)"""


@_query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE_SQL["op1_ngram_join"] = (
    "WITH RECURSIVE " + _SHINGLES.format(name="s", key="doc_id", table="documents") + """,
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.other = link.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY ALL) LEFT JOIN size USING (doc_id)"""
)


@_query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated_pairs(docs, _table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op2_decontamination"] = (
    "WITH " + _SHINGLES.format(name="d", key="doc_id", table="documents") + ",\n"
    + _SHINGLES.format(name="b", key="item_id", table="benchmark") + """,
size AS (SELECT item_id, count(*) AS n FROM b GROUP BY ALL)
SELECT doc_id, item_id, n AS n_item_shingles, count(*) AS n_shared
FROM d JOIN b USING (shingle) JOIN size USING (item_id)
GROUP BY ALL HAVING 100 * count(*) >= 80 * n"""
)


@_query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, fit_quality(docs, _table(spark, sf_dir, "labels")))


@_query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"))


_GRAMS = range(5, 11)
ORACLE_SQL["op5_quality_rules"] = r"""
WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM documents),
base AS (
  SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols
  FROM w),
line AS (
  SELECT doc_id, line, count(*) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
lines AS (
  SELECT doc_id, sum(n - 1) AS n_dup_lines, sum(n * length(line)) AS line_chars,
         sum((n - 1) * length(line)) AS dup_line_chars
  FROM line GROUP BY ALL),
pos AS (SELECT doc_id, words, generate_subscripts(words, 1) AS i FROM w),
wlen AS (SELECT doc_id, i, length(words[i]) AS chars FROM pos),
""" + ",\n".join(
    f"""g{n} AS (
  SELECT doc_id, unnest(spots) AS i FROM (
    SELECT doc_id, array_to_string(words[i:i+{n - 1}], ' ') AS gram, list(i) AS spots
    FROM pos WHERE i + {n - 1} <= len(words) GROUP BY ALL HAVING count(*) > 1)),
c{n} AS (
  SELECT doc_id, count(*) AS covered, sum(chars) AS dup_chars_{n}
  FROM (SELECT DISTINCT doc_id, i + unnest(range({n})) AS i FROM g{n}) JOIN wlen USING (doc_id, i) GROUP BY ALL)"""
    for n in _GRAMS
) + r""",
m AS (
  SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
         CAST(n_symbols AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c5.covered, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(line_chars, 0) AS BIGINT) AS line_chars,
         CAST(coalesce(dup_line_chars, 0) AS BIGINT) AS dup_line_chars,
         """ + ", ".join(f"CAST(coalesce(dup_chars_{n}, 0) AS BIGINT) AS dup_chars_{n}" for n in _GRAMS) + r"""
  FROM base LEFT JOIN lines USING (doc_id)
  """ + " ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in _GRAMS) + r""")
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * dup_line_chars <= 30 * line_chars
       """ + " ".join(f"AND 100 * dup_chars_{n} <= 20 * word_chars" for n in _GRAMS) + r""" AS kept
FROM m"""


@_query
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]')"
        " AS t(conv_id, turn, role, text)"
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest_conversations(format_conversations(turns.unionByName(own)))


ORACLE_SQL["op6_chat_formatting"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, length(regexp_replace(text, '([<>\[\\])', '\1\1', 'g'))
    + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 ELSE 8 END AS chars
  FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(chars) AS BIGINT) AS formatted_chars,
    string_agg(role, ',' ORDER BY turn, role, text) AS roles
  FROM e GROUP BY ALL)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
  regexp_full_match(roles, 'system|(system,)?user(,assistant,user)*(,assistant)?') AS valid
FROM g"""


@_query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text"))


_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
_RULE_VALUES = ", ".join(str(r) for r in _RULES)


@_query
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {_RULE_VALUES} AS t(host, path, verdict)")
    return judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules)


ORACLE_SQL["op8_url_filters"] = f"""
WITH r(rhost, rpath, verdict) AS (VALUES {_RULE_VALUES}),
rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
best AS (
  SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
    arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM (SELECT DISTINCT host, path FROM u) u
  JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (host, path)"""


@_query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE_SQL["op11_phrase_mining"] = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (
  SELECT lang, k, array_to_string(words[i:i+k-1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, words, generate_subscripts(words, 1) AS i FROM w), (SELECT unnest([1, 2, 3, 4]) AS k)
  WHERE i + k - 1 <= len(words) GROUP BY ALL),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS words FROM g WHERE k > 1 AND f >= 30),
cut AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r,
    CAST(CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f), cut) AS place
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:cut], ' ')
  JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[cut+1:], ' ')),
around AS (
  SELECT lang, array_to_string(words[i:i+size-1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, words, k, a, size, unnest(range(1, k - size + 2)) AS i
        FROM c, (SELECT unnest([2, 3]) AS size) WHERE size < k)
  GROUP BY ALL),
ranked AS (
  SELECT lang, phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM cut LEFT JOIN around USING (lang, phrase)
  WHERE place = 1 AND (longer IS NULL OR 100 * longer < 80 * a))
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang) USING (lang)
WHERE rank <= 2000"""


@_query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents").select("lang", "source", "text"))


ORACLE_SQL["op12_source_divergence"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
t AS (
  SELECT row, lang, source, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT row) >= 10),
s AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
c AS (
  SELECT s.lang, s.source, kept.term, coalesce(n, 0) AS n,
    sum(coalesce(n, 0)) OVER (PARTITION BY s.lang, s.source) AS total, count(*) OVER (PARTITION BY s.lang, s.source) AS v
  FROM s JOIN kept USING (lang) LEFT JOIN n ON n.lang = s.lang AND n.source = s.source AND n.term = kept.term),
p AS (SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (total + 2 * v) AS p FROM c),
l AS (SELECT lang, term, sum(n) AS n, v FROM c GROUP BY ALL),
q AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q FROM l),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) z
  ON z.lang = a.lang AND z.source = a.source AND z.item = b.source),
term AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT *, 'pair' AS part FROM pair UNION ALL SELECT *, 'term' FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 10"""


@_query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL["op13_line_dedup"] = rf"""
WITH l AS (
  SELECT doc_id, line, i, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
last AS (
  SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT doc_id, line, i, last IS NOT NULL AND last <> doc_id AS gone FROM l LEFT JOIN last USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""
