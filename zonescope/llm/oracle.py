"""DuckDB SQL for the queries that SQL can express within reason."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BREAKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _terms(table: str, key: str) -> str:
    return f"SELECT {key}, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM {table}"


SEARCH_SQL = f"""WITH words AS ({_terms("documents", "doc_id")}),
  items AS (SELECT DISTINCT item_id, term FROM ({_terms("benchmark", "item_id")})),
  sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
  totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM sizes),
  counts AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM items) GROUP BY doc_id, term),
  weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM counts GROUP BY term) CROSS JOIN totals),
  gains AS (SELECT c.doc_id, c.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nd) // nt))) AS gain
    FROM counts c JOIN weights USING (term) JOIN sizes USING (doc_id) CROSS JOIN totals),
  scored AS (SELECT i.item_id, g.doc_id, CAST(sum(gain) AS BIGINT) AS score FROM items i JOIN gains g USING (term) GROUP BY i.item_id, g.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""

LINES_SQL = f"""WITH cut AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
  keyed AS (SELECT *, translate(trim(line, {_BREAKS}), '{_UPPER}', '{_LOWER}') AS key FROM cut),
  shared AS (SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
  judged AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.holder AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

ORACLES: dict[str, str] = {
    "op11_reversed_search": SEARCH_SQL,
    "op12_line_runs": LINES_SQL,
}
