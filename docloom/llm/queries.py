"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers

from .bpe import round_trip_report
from .common import table
from .decontaminate import contamination_report
from .html import main_text
from .licenses import license_report
from .licenses import oracle_sql as license_sql
from .lines import line_report
from .lm import score as lm_score
from .quality import judge
from .secrets import secret_report
from .sharding import assign_shards
from .simhash import near_duplicate_report


def op1_histogram_sort(spark, sf_dir):
    return assign_shards(table(spark, sf_dir, "documents"), 24)


def op2_secret_scan(spark, sf_dir):
    return secret_report(table(spark, sf_dir, "documents"))


def op3_bpe_round_trip(spark, sf_dir):
    return round_trip_report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_line_dedup(spark, sf_dir):
    return line_report(table(spark, sf_dir, "documents"))


def op5_quality(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents"))


def op6_html_text(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))


def op7_simhash(spark, sf_dir):
    return near_duplicate_report(table(spark, sf_dir, "documents"))


def op8_decontamination(spark, sf_dir):
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_context_mixing(spark, sf_dir):
    return lm_score(table(spark, sf_dir, "documents"))


def op10_license_scan(spark, sf_dir):
    return license_report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_histogram_sort, op2_secret_scan, op3_bpe_round_trip, op4_line_dedup, op5_quality, op6_html_text, op7_simhash, op8_decontamination, op9_context_mixing, op10_license_scan)}

OP8_SQL = r"""
WITH w AS (SELECT rowid AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
    FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT r, i, dw.n, item FROM dw JOIN bw ON dw.t = bw.t AND dw.n = bw.n),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""

ORACLES = {"op8_decontamination": OP8_SQL, "op10_license_scan": license_sql()}
