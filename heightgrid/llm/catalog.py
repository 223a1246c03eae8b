"""Registered queries of this subpackage over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from heightgrid.llm.bpe import round_trip
from heightgrid.llm.context_tree import score
from heightgrid.llm.conversations import damage, repair
from heightgrid.llm.edit_prints import compare_with_next
from heightgrid.llm.extraction import extract
from heightgrid.llm.mixing import mix
from heightgrid.llm.near_dup import near_duplicates
from heightgrid.llm.neighbours import nearest
from heightgrid.llm.phrases import collocations
from heightgrid.llm.repetition import repetition
from heightgrid.llm.ring import assign
from heightgrid.llm.secrets import find_secrets
from heightgrid.llm.token_files import token_files


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents"), per_label=2_000, recall=0.95)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_network")


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op4_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(_table(spark, sf_dir, "documents"))


def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_table(spark, sf_dir, "documents"))


def op6_seekable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op7_tree_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op8_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(_table(spark, sf_dir, "documents"), shards=24)


def op10_edit_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(_table(spark, sf_dir, "documents"))


def op11_small_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), k=5, every=50)


def op12_cyclic_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"), threshold=100, top=2_000)


def op13_block_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(_table(spark, sf_dir, "conversations")))


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(md5(coalesce(text, '')), 1, 16) AS digest
  FROM documents),
sums AS (SELECT source, sum(size) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size, 2.0::DOUBLE * source_size AS cap,
         ([3.0, 1.0, 2.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS w
  FROM sums),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER f, 0)) AS level
  FROM weighted WINDOW f AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, max(CASE WHEN level * w < cap THEN level END) OVER () AS open_level FROM levels),
targets AS (
  SELECT source, source_size, round(CASE WHEN level * w >= cap THEN cap ELSE open_level * w END, 6) AS target FROM filled),
ratios AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM targets),
quotas AS (
  SELECT *, floor(ratio + 1e-9::DOUBLE) AS whole, greatest(ratio - floor(ratio + 1e-9::DOUBLE), 0) AS rest FROM ratios),
drawn AS (
  SELECT s.*, q.source_size, q.target, q.whole, q.rest, q.rest * q.source_size AS quota,
         (CAST(('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || digest), 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
odds AS (
  SELECT *, CASE WHEN size > 0 AND rest > 1e-9 THEN u / (1 - u) / ((rest / (1 - rest)) * sqrt(CAST(size AS DOUBLE))) END AS q FROM drawn),
ranked AS (SELECT *, floor(q / (1 + q) * 281474976710656.0::DOUBLE) AS rank FROM odds),
running AS (
  SELECT *, sum(CASE WHEN rank IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, digest ROWS UNBOUNDED PRECEDING) AS upto
  FROM ranked)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN rank IS NOT NULL AND (upto <= quota OR (upto - size < quota AND upto - quota <= quota - (upto - size))) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM running
"""

OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM places, range(1, 6) lengths(m) WHERE i + m - 1 <= len(w)),
frequent AS (SELECT lang, phrase, m, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM frequent WHERE m > 1),
starts AS (SELECT lang, m, a, w, unnest(range(1, m)) AS i FROM candidates WHERE m > 2),
inner_phrases AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, a FROM starts, range(2, 5) lengths(k) WHERE k < m AND i + k - 1 <= m),
covers AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL),
kept AS (SELECT c.* FROM candidates c LEFT JOIN covers v USING (lang, phrase) WHERE v.longer IS NULL OR 100 * v.longer < 100 * c.a),
cuts AS (SELECT lang, phrase, a, m, w, unnest(range(1, m)) AS k FROM kept),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, t.n, c.k,
         CAST(1000::HUGEINT * c.a * t.n // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""


def _cost(best: str, more: int, letter: str) -> str:
    """``best`` is a cost of nine digits and the edits behind it; one more edit in front."""
    return f"printf('%09d', CAST(left({best}, 9) AS BIGINT) + {more}) || '{letter}' || substr({best}, 10)"


def _repair_sql() -> str:
    """Conversations read from the end: the least ``cost || audit`` from each state, then the edits carried out."""
    step = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    ways = []
    for q, goes in enumerate(step):
        owed = goes.get("u", goes.get("a"))
        stay = [f"CASE WHEN NOT gone THEN printf('%09d', CAST(left(b{owed}, 9) AS BIGINT) + 3 + cut) || 'R' || substr(b{owed}, 10) END"]
        stay += [f"CASE WHEN NOT gone AND initial = '{i}' THEN printf('%09d', CAST(left(b{to}, 9) AS BIGINT) + cut) || 'K' || substr(b{to}, 10) END" for i, to in goes.items()]
        ways.append(f"least({_cost(f'b{q}', 4, 'D')}, {', '.join(stay)}) AS e{q}")
    inserts = f"least(e2, {_cost('e3', 3, 'I')}) AS b2, least(e3, {_cost('e2', 3, 'I')}) AS b3"
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: ascii(c)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed WHERE kind <> 0),
placed AS (
  SELECT *, rtrim(text, E' \t\n\x0b\x0c\r') AS bare, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos
  FROM damaged),
marked AS (
  SELECT *, bare = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         right(bare, 1) NOT IN ('.', '!', '?') AS open, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS wrong
  FROM placed),
rows_of AS (SELECT *, blank OR again AS gone, CASE WHEN blank OR again OR NOT open THEN 0 ELSE 3 END AS cut FROM marked),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
         count(*) FILTER (open AND NOT gone) AS truncated, count(*) FILTER (wrong) AS illegal, count(*) AS n
  FROM rows_of GROUP BY conv_id),
walk AS (
  SELECT conv_id, n AS pos, '000000000' AS b0, '000000006II' AS b1, '000000003I' AS b2, '000000000' AS b3 FROM facts
  UNION ALL
  SELECT conv_id, pos, least(e0, {_cost('b2', 3, 'I')}), least(e1, {_cost('b2', 3, 'I')}), b2, b3
  FROM (SELECT conv_id, pos, e0, e1, {inserts}
        FROM (SELECT k.conv_id, k.pos - 1 AS pos, {', '.join(ways)} FROM walk k JOIN rows_of r ON r.conv_id IS NOT DISTINCT FROM k.conv_id AND r.pos = k.pos))),
audits AS (SELECT conv_id, CAST(left(b0, 9) AS BIGINT) AS cost, substr(b0, 10) AS audit FROM walk WHERE pos = 0),
edits AS (
  SELECT conv_id, audit, 0::BIGINT AS done, 0::BIGINT AS pos, '' AS last, '' AS lines FROM audits
  UNION ALL
  SELECT conv_id, audit, done, pos, CASE WHEN line IS NULL THEN last ELSE left(line, 1) END, CASE WHEN line IS NULL THEN lines ELSE lines || chr(10) || line END
  FROM (SELECT conv_id, audit, done + 1 AS done, CASE WHEN letter = 'I' THEN pos ELSE pos + 1 END AS pos, last, lines,
               CASE letter WHEN 'K' THEN role || ':' || text WHEN 'R' THEN owed || ':' || text WHEN 'I' THEN owed || ':' END AS line
        FROM (SELECT e.*, r.role, r.text, substr(e.audit, e.done + 1, 1) AS letter, CASE WHEN e.last = 'u' THEN 'assistant' ELSE 'user' END AS owed
              FROM edits e LEFT JOIN rows_of r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.pos = e.pos + 1 WHERE e.done < length(e.audit)))),
ended AS (SELECT conv_id, substr(lines, 2) AS repaired FROM edits WHERE done = length(audit))
SELECT i.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
       coalesce(f.illegal, 0) AS illegal, coalesce(a.cost, 0) AS cost, coalesce(a.audit, '') AS audit, sha256(coalesce(e.repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
"""


OP13_SQL = _repair_sql()

QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_network, op2_pareto_mix, op3_odd_sketch_dedup, op4_repetition_rules, op5_context_tree, op6_seekable_tokens,
        op7_tree_extraction, op8_pair_index_bpe, op9_bounded_ring, op10_edit_walks, op11_small_world, op12_cyclic_phrases, op13_block_repair,
    )
}
ORACLES = {"op2_pareto_mix": OP2_SQL, "op12_cyclic_phrases": OP12_SQL, "op13_block_repair": OP13_SQL}
