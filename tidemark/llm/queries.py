"""The registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import quality as quality_rules
from tidemark.llm.contamination import WINDOW, contamination
from tidemark.llm.licenses import licenses
from tidemark.llm.linededup import line_dedup
from tidemark.llm.merkle import FAN, lower_cased, verified
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.pieces import encode_pieces
from tidemark.llm.quality import quality
from tidemark.llm.spellings import spelling_variants
from tidemark.llm.substrings import passage_dedup
from tidemark.llm.tokenfiles import read_tokens, write_tokens
from tidemark.llm.toxicity import toxicity
from tidemark.llm.urlfilter import judge_urls
from tidemark.llm.warc import read_warc, write_warc
from tidemark.session import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")) \
        .drop("items", "spans")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents")).drop("lost")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages")).drop("score")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup(_table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "token-files")
    manifest = write_tokens(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, folder, manifest)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    manifest = write_warc(_table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder, manifest).drop("url")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return verified(documents, altered=lower_cased(documents))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup(_table(spark, sf_dir, "documents")).drop("spans")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_license_scans": op2_license_scans,
    "op3_quality_rules": op3_quality_rules,
    "op4_url_filters": op4_url_filters,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_toxicity": op8_toxicity,
    "op9_token_files": op9_token_files,
    "op10_warc": op10_warc,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE: dict[str, str] = {}

ORACLE["op1_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
places AS (
  SELECT item, w, least(len(w), {WINDOW}) AS k, unnest(generate_series(1, greatest(len(w) - {WINDOW} + 1, 1))) AS i
  FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM places),
sizes AS (SELECT DISTINCT k FROM win),
runs AS (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, sizes),
hits AS (
  SELECT r.doc_id, r.i, r.k, win.item FROM runs r JOIN win ON win.k = r.k AND win.g = array_to_string(r.w[r.i:r.i + r.k - 1], ' ')),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hits)
  GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_FAILS = rf"""(
  len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) > 0 AND (
  4 * len(regexp_extract_all(l, '{quality_rules.SYMBOLS}')) > len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))
  OR 2 * len(regexp_extract_all(l, '!')) >= len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))
  OR (len(regexp_extract_all(l, '{quality_rules.SEPARATORS}')) >= 2 AND len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))
      < 4 * (len(regexp_extract_all(l, '{quality_rules.SEPARATORS}')) + 1))
  OR (len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) <= {quality_rules.BOILERPLATE_WORDS}
      AND regexp_matches(l, '{quality_rules.BOILERPLATE}'))
  OR (len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) >= 4
      AND NOT regexp_matches(l, '{quality_rules.SENTENCE_MARKS}'))))"""

ORACLE["op3_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d)),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS p FROM again WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '{quality_rules.SYMBOLS}')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS filled,
    coalesce(n_repeat_words, 0) AS n_repeat_words, length(t) AS chars,
    length(array_to_string(list_filter(string_split(t, chr(10)), lambda l: NOT {_FAILS}), chr(10))) AS kept_chars
  FROM d LEFT JOIN repeats USING (doc_id)),
f AS (SELECT *, n_words < {quality_rules.MIN_WORDS}
  OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(filled) - len(list_distinct(filled)) AS BIGINT) AS n_dup_lines,
  n_repeat_words, base_failed,
  NOT base_failed AND CASE WHEN chars = 0 THEN 0 ELSE 1 - kept_chars / chars END <= {quality_rules.MAX_LOST} AS kept
FROM f
"""

ORACLE["op5_minhash_near_dedup"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n_shingles + y.n_shingles - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, r) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT e.b, reach.r FROM reach JOIN both_ways e ON e.a = reach.node),
c AS (SELECT node AS doc_id, min(r) AS component_id FROM reach GROUP BY node)
SELECT doc_id, coalesce(n_shingles, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

ORACLE["op6_line_dedup"] = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS place FROM documents),
k AS (SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT *, min(doc_id) OVER (PARTITION BY key) < doc_id AND length(key) >= 10 AS dropped FROM k)
SELECT doc_id, count(*) AS n_lines, count_if(dropped) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN NOT dropped THEN line END, chr(10) ORDER BY place), '')) AS kept_sha256
FROM o GROUP BY doc_id
"""

ORACLE["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
o AS (SELECT *, CASE WHEN size >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS owner FROM p)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM o
"""


#: The table of CRC-32, and the checksum of a list of byte values.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(
  list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS t)"""


def _crc32(codes: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295, {codes}),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"""


_DIGITS = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _tree_levels(name: str, group: str, bottom: str, levels: int) -> str:
    """CTEs of a tree: per level and node its digest and its siblings, ending in (group, digest)."""
    out = [f"{name}0 AS ({bottom})"]
    for k in range(levels):
        out.append(f"""{name}s{k} AS (
  SELECT *, list(h) OVER w AS run, CAST(pos % {FAN} AS BIGINT) AS own, count(*) OVER (PARTITION BY {group}) AS size
  FROM {name}{k} WINDOW w AS (PARTITION BY {group}, pos // {FAN} ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))""")
        out.append(f"""{name}{k + 1} AS (
  SELECT DISTINCT {group}, CASE WHEN size > 1 THEN pos // {FAN} ELSE 0 END AS pos,
    CASE WHEN size > 1 THEN sha256(array_to_string(run, '')) ELSE h END AS h FROM {name}s{k})""")
    return ",\n".join(out)


#: Levels that are written out in the SQL of a source's tree and of the tree of subroots.
_SOURCE_LEVELS, _ROOT_LEVELS = 6, 3


def _path_columns(name: str, levels: int, pos: str, on: str) -> tuple[str, str]:
    """(joins, the list of (left, right) of each level) for a node at ``pos``."""
    joins, path = [], []
    for k in range(levels):
        at = f"{name}s{k}"
        joins.append(f"JOIN {at} ON {on.format(at)} AND {at}.pos = CASE WHEN {at}.size > 1 THEN {pos} // {FAN ** k} ELSE 0 END")
        path.append(f"""CASE WHEN {at}.size > 1 THEN {{'l': array_to_string({at}.run[:{at}.own], ''),
    'r': array_to_string({at}.run[{at}.own + 2:], '')}} END""")
    return "\n".join(joins), ", ".join(path)


_OWN_JOINS, _OWN_PATH = _path_columns("n", _SOURCE_LEVELS, "l.pos", "{}.tree = l.tree")
_TOP_JOINS, _TOP_PATH = _path_columns("r", _ROOT_LEVELS, "t.pos", "{}.top = 0")

ORACLE["op11_merkle_manifest"] = f"""
WITH {_CRC_TABLE},
leaves AS (
  SELECT doc_id, coalesce('+' || source, '') AS tree, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32(_DIGITS)} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
    END AS altered FROM documents, crc),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
{_tree_levels("n", "tree", "SELECT tree, pos, leaf AS h FROM l", _SOURCE_LEVELS)},
tops AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM n{_SOURCE_LEVELS}),
{_tree_levels("r", "top", "SELECT 0 AS top, pos, h FROM tops", _ROOT_LEVELS)},
above AS (SELECT t.tree, t.h AS subroot, [{_TOP_PATH}] AS path FROM tops t {_TOP_JOINS}),
proofs AS (
  SELECT l.doc_id, l.leaf, l.altered, subroot, list_filter(list_concat([{_OWN_PATH}], path), lambda x: x IS NOT NULL) AS path
  FROM l JOIN above USING (tree) {_OWN_JOINS}),
folded AS (
  SELECT *, list_reduce(list_prepend({{'l': coalesce(altered, leaf), 'r': ''}}, path),
    lambda x, y: {{'l': sha256(y.l || x.l || y.r), 'r': ''}}).l AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, r{_ROOT_LEVELS}.h AS root,
  sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256,
  folded_root, folded_root = r{_ROOT_LEVELS}.h AS verified
FROM folded, r{_ROOT_LEVELS}
"""

ORACLE["op12_substring_dedup"] = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
places AS (SELECT doc_id, row, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d),
windows AS (SELECT doc_id, row, i, md5(array_to_string(w[i:i + 49], ' ')) AS g FROM places),
again AS (SELECT *, min(doc_id) OVER (PARTITION BY g) < doc_id AS gone FROM windows),
removed AS (SELECT row, list(DISTINCT p) AS places
  FROM (SELECT row, unnest(generate_series(i, i + 49)) AS p FROM again WHERE gone) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, k: NOT list_contains(coalesce(places, []), k)), ' ')) AS kept_sha256
FROM d LEFT JOIN removed USING (row)
"""

_BYTES = """list_transform(generate_series(1, strlen(s)), lambda k: CAST('0x' || substr(hex(encode(s)), 2 * k - 1, 2) AS BIGINT))"""

ORACLE["op13_spelling_variants"] = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents)
  GROUP BY ALL),
checked AS (SELECT run, c, {_crc32(_BYTES)} AS h FROM runs, crc),
spelt AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
  FROM checked),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS swapped,
    substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM holes a JOIN holes b ON a.swapped = b.swapped AND a.word <> b.word
  UNION SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.cut
  UNION SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.cut),
near AS (
  SELECT a AS word, count(*) AS n_near, min({{'m': -w.n, 'b': b}}) AS best FROM pairs JOIN words w ON w.word = b GROUP BY a),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 5 * n THEN best.b END AS form,
    CASE WHEN -best.m >= 5 * n THEN -best.m END AS form_n FROM words LEFT JOIN near USING (word)),
chain(word, place) AS (
  SELECT word, word FROM formed UNION ALL SELECT chain.word, f.form FROM chain JOIN formed f ON f.word = chain.place
  WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.place AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.place AND e.form IS NULL
"""
