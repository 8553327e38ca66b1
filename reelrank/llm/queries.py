"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import bpe, decontam, hilbert, hnsw, html_extract, laesa_codes, line_dedup, periodic_runs, repair_shards, simhash, substring_dedup, toxicity, url_filter
from reelrank.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed",
                        F.sha2("kept_text", 256).alias("kept_sha256"), "n_repeats")


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_hnsw_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_runs",
                        F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.fit(url_filter.weak_labels(pages)))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_period(table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.detect(docs)).drop("n_words")


def op12_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_shards.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_laesa_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laesa_codes.encode(table(spark, sf_dir, "embeddings")).drop("measured_milli")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_hilbert_shards": op3_hilbert_shards,
    "op4_toxicity": op4_toxicity,
    "op5_hnsw_near_dedup": op5_hnsw_near_dedup,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_line_dedup": op8_line_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_html_extraction": op10_html_extraction,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_repair_shards": op12_repair_shards,
    "op13_laesa_codes": op13_laesa_codes,
}

_BLANK = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"

def _template_sql(raw: str) -> str:
    units = ", ".join(f"'{u}'" for u in decontam.UNITS)
    return f"""list_transform({raw}, lambda x, i: CASE
      WHEN x IN ({units}) AND i > 1 AND {raw}[i - 1] >= '0' AND {raw}[i - 1] < ':' THEN '<u>'
      WHEN x >= '0' AND x < ':' THEN '<n>' WHEN lower(x) <> x THEN '<a>' ELSE x END)"""


# crc32 of a decimal number, bit by bit.
_CRC = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: ascii(c)::BIGINT), lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
    lambda r, k: xor(r >> 1, 3988292384 * (r & 1)))))"""


def _codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Every part against every entry, ``rounds`` times and once more."""
    def assign(k: int) -> str:
        return f"""a{k} AS (SELECT id, p, x, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT part.*, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM part JOIN b{k} USING (p)) GROUP BY id, p, x)"""

    def move(k: int) -> str:
        return f"""s{k} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, (sum(x[i]) - (((sum(x[i]) % count(*)) + count(*)) % count(*))) // count(*) AS m
    FROM a{k - 1}, range(1, (SELECT max(len(x)) + 1 FROM part)) v(i) GROUP BY p, e, i) GROUP BY p, e),
b{k} AS (SELECT b.p, b.e, coalesce(s.c, b.c) AS c FROM b{k - 1} b LEFT JOIN s{k} s USING (p, e))"""
    steps = ",\n".join(f"{move(k)},\n{assign(k)}" for k in range(1, rounds + 1))
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label,
    list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (SELECT id, p, x[1 + p * (len(x) // {parts}):(p + 1) * (len(x) // {parts})] AS x
  FROM kept, range(0, {parts}) v(p)),
b0 AS (SELECT p, id AS e, x AS c FROM part WHERE id < {entries}),
{assign(0)},
{steps},
coded AS (SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM a{rounds} GROUP BY id),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (id), book"""


SQL: dict[str, str] = {
    "op1_decontamination": f"""
WITH item AS (SELECT *, {_template_sql("r")} AS t FROM (
    SELECT row_number() OVER () AS b, item_id, regexp_extract_all(text, '{decontam.TOKEN}') AS r
    FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL))),
item_window AS (SELECT b, item_id, i AS ipos, t[i:i + 4] AS w, count(*) OVER (PARTITION BY b) AS n
  FROM (SELECT *, unnest(range(1, len(t) - 3)) AS i FROM item)
  WHERE len(list_filter(t[i:i + 4], lambda x: NOT starts_with(x, '<'))) >= 2),
doc AS (SELECT *, {_template_sql("r")} AS t FROM (
    SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(text, '{decontam.TOKEN}') AS r
    FROM (SELECT DISTINCT doc_id, text FROM documents))),
doc_window AS (SELECT d, i AS dpos, t[i:i + 4] AS w FROM (SELECT d, t, unnest(range(1, len(t) - 3)) AS i FROM doc)),
hit AS (SELECT DISTINCT d, b, n, dpos - ipos AS diag, ipos FROM doc_window JOIN item_window USING (w)),
run AS (SELECT d, b, diag, list(ipos) AS places, count(*) / n AS containment FROM hit
  GROUP BY d, b, diag, n HAVING count(*) / n >= 0.8),
covered AS (SELECT DISTINCT d, b, diag, p + k AS i FROM (SELECT *, unnest(places) AS p FROM run), range(0, 5) v(k)),
slot AS (SELECT DISTINCT c.d, c.b, c.diag, item.t[c.i] AS kind, regexp_replace(item.r[c.i], '^.* ', '') AS a,
    regexp_replace(doc.r[c.i + c.diag], '^.* ', '') AS v
  FROM covered c JOIN item USING (b) JOIN doc USING (d)
  WHERE starts_with(item.t[c.i], '<') AND item.t[c.i] = doc.t[c.i + c.diag]),
filled AS (SELECT d, b, diag, count(*) AS n_slots, count(DISTINCT (kind, a)) AS n_values FROM slot GROUP BY d, b, diag),
judged AS (SELECT doc_id, item_id, containment, coalesce(n_slots, 0) AS n_slots,
    coalesce(n_values / n_slots, 1.0) AS slot_consistency
  FROM run LEFT JOIN filled USING (d, b, diag) JOIN item USING (b) JOIN doc USING (d)),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id
    ORDER BY containment DESC, slot_consistency DESC, n_slots DESC) AS rn FROM judged WHERE slot_consistency >= 0.8)
SELECT doc_id, item_id, containment, n_slots, slot_consistency FROM best WHERE rn = 1""",
    "op2_substring_dedup": r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents),
word AS (SELECT doc_id, i, ws[i] AS word FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM doc)),
start AS (SELECT doc_id, s, ws[s:s + 19] AS k FROM (SELECT *, unnest(range(1, len(ws) - 18)) AS s FROM doc)),
copy AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS rn FROM start) WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, s + j AS i FROM copy, range(0, 20) v(j)),
marked AS (SELECT w.doc_id, w.i, w.word, g.i IS NOT NULL AS gone FROM word w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i),
counted AS (SELECT doc_id, count(*) AS n_words, sum(gone::int) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept, sum(starts::int) AS n_repeats
  FROM (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM marked)
  GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, coalesce(n_repeats, 0)::BIGINT AS n_repeats
FROM documents LEFT JOIN counted USING (doc_id)""",
    "op8_line_dedup": f"""
WITH parts AS (SELECT doc_id, text, string_split(text, chr(10)) AS p FROM documents),
lines AS (SELECT doc_id, i, p[i] AS line, trim(p[i], {_BLANK}) AS t
          FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM parts)),
named AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS seq FROM lines WHERE t <> ''),
paired AS (SELECT *, lead(t) OVER (PARTITION BY doc_id ORDER BY seq) AS nt FROM named),
later AS (SELECT *,
    len(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+')) >= 10
      AND row_number() OVER (PARTITION BY t ORDER BY doc_id, seq) > 1 AS alone,
    nt IS NOT NULL AND row_number() OVER (PARTITION BY t, nt ORDER BY doc_id, seq) > 1 AS pair
  FROM paired),
cut AS (SELECT doc_id, i, seq, alone OR pair
    OR coalesce(lag(pair) OVER (PARTITION BY doc_id ORDER BY seq), false) AS gone FROM later),
counted AS (SELECT doc_id, count(*) AS n_lines, sum(gone::int) AS n_removed, sum(start::int) AS n_runs
  FROM (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY seq), false) AS start FROM cut)
  GROUP BY doc_id),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS kept
  FROM lines l LEFT JOIN cut c ON l.doc_id = c.doc_id AND l.i = c.i
  WHERE NOT coalesce(c.gone, false) GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_runs, 0)::BIGINT AS n_runs,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM documents d LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op11_periodic_runs": rf"""
WITH doc AS (SELECT *, len(ws) AS n, h // 10 AS g FROM (
    SELECT row_number() OVER () AS d, doc_id, {_CRC} AS h,
      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)),
shape AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM (
    SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM doc)),
word AS (SELECT d, i, ws[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS w
  FROM (SELECT d, ws, a, p, unnest(range(0, n)) AS i FROM shape)),
met AS (SELECT x.d, x.i - y.i AS q, x.i FROM word x JOIN word y ON x.d = y.d AND x.w = y.w AND y.i < x.i),
stretch AS (SELECT d, q, min(i) - q AS s, count(*) + q AS m
  FROM (SELECT *, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS chain FROM met)
  GROUP BY d, q, chain HAVING count(*) >= greatest(12 - q, q)),
run AS (SELECT d, s, m, min(q) AS q FROM stretch GROUP BY d, s, m),
told AS (SELECT d, count(*) AS n_runs, string_agg(concat(s, ',', m, ',', q, chr(10)), '' ORDER BY s, q) AS lines,
    min((-m, s, q)) AS best FROM run GROUP BY d),
gone AS (SELECT DISTINCT d, unnest(range(s + q, s + m)) AS i FROM run),
kept AS (SELECT w.d, string_agg(w.w, ' ' ORDER BY w.i) AS kept FROM word w ANTI JOIN gone USING (d, i) GROUP BY w.d)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[2]::BIGINT AS start, -best[1]::BIGINT AS length,
       best[3]::BIGINT AS period, (1000 * -best[1] // best[3])::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM doc LEFT JOIN told USING (d) LEFT JOIN kept USING (d)""",
    "op13_laesa_codes": _codes_sql(laesa_codes.PARTS, laesa_codes.ENTRIES, laesa_codes.ROUNDS, laesa_codes.SCALE),
}
