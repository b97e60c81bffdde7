"""DuckDB SQL for the quality rules."""

MEASURES = {"symbol_share": 60, "dup_line_share": 400, "repeat_share": 300, "stutter_share": 200, "upper_share": 300, "mark_share": 200, "digit_share": 500, "word_length": 300}


def _case(col: str) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN '{m}' THEN {s}" for m, s in MEASURES.items()) + " END"


def _part(by: list[str]) -> str:
    cols = "".join(f"{c}, " for c in by)
    return f"""SELECT {cols}measure, count(*) AS n_rows,
        list_sort(list(b))[CAST(ceil(count(*) * 0.5) AS BIGINT)] AS mid, list_sort(list(b))[CAST(ceil(count(*) * 0.1) AS BIGINT)] AS low
      FROM long GROUP BY {cols}measure"""


def measured(docs: str = "documents", columns: str = "doc_id, lang, source") -> str:
    """WITH parts ending in ``m``: the columns and every measure of a row."""
    return f"""base AS (
      SELECT row_number() OVER () AS rid, {columns}, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM {docs}
    ), counted AS (
      SELECT *, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digit,
        length(regexp_replace(t, '[^!"''()+,./:;=?@\\[\\]\\\\^_`{{}}~-]', '', 'g')) AS n_mark,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
      FROM base
    ), win AS (
      SELECT rid, s, array_to_string(w[s:s + 7], ' ') AS k FROM counted, unnest(range(1, n_words - 6)) AS u(s) WHERE n_words >= 8
    ), hit AS (
      SELECT rid, s FROM (SELECT rid, s, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1
    ), rep AS (
      SELECT rid, count(DISTINCT s + j) AS n FROM hit, unnest(range(0, 8)) AS u(j) GROUP BY rid
    ), vals AS (
      SELECT c.*, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        len(list_filter(range(2, n_words + 1), lambda i: w[i] = w[i - 1])) AS n_stutter
      FROM counted c LEFT JOIN rep USING (rid)
    ), m AS (
      SELECT *, 1000 * n_symbols // greatest(word_chars, 1) AS symbol_share, 1000 * n_dup_lines // greatest(len(lines), 1) AS dup_line_share,
        1000 * n_repeat_words // greatest(n_words, 1) AS repeat_share, 1000 * n_stutter // greatest(n_words, 1) AS stutter_share,
        1000 * n_upper // greatest(word_chars, 1) AS upper_share, 1000 * n_mark // greatest(word_chars, 1) AS mark_share,
        1000 * n_digit // greatest(word_chars, 1) AS digit_share, 100 * word_chars // greatest(n_words, 1) AS word_length
      FROM vals
    )"""


def judged(docs: str = "documents", columns: str = "doc_id, lang, source") -> str:
    """WITH parts ending in ``judged``: ``m`` with base_failed and kept."""
    over = " OR ".join(f"coalesce(m.{x} > c.{x}, false)" for x in MEASURES)
    pivot = ", ".join(f"max(CASE WHEN measure = '{x}' THEN cut END) AS {x}" for x in MEASURES)
    rows = " UNION ALL ".join(f"SELECT lang, source, '{x}' AS measure, {x} AS v FROM m WHERE n_words > 0" for x in MEASURES)
    return measured(docs, columns) + f""", long AS (
      SELECT lang, source, measure, (v >> CAST(greatest(0, length(ltrim(bin(v), '0')) - 7) AS BIGINT)) << CAST(greatest(0, length(ltrim(bin(v), '0')) - 7) AS BIGINT) AS b
      FROM ({rows})
    ), q2 AS ({_part(["lang", "source"])}), means AS (
      SELECT lang, measure, sum(n_rows) AS n, sum(n_rows * mid) // sum(n_rows) AS mid, sum(n_rows * (mid - low)) // sum(n_rows) AS far FROM q2 GROUP BY lang, measure
    ), corpus AS (
      SELECT measure, sum(n_rows * mid) // sum(n_rows) AS mid, sum(n_rows * (mid - low)) // sum(n_rows) AS far FROM q2 GROUP BY measure
    ), wide AS (
      SELECT l.lang, l.measure, (l.n * l.mid + 200 * c.mid) // (l.n + 200) AS mid, (l.n * l.far + 200 * c.far) // (l.n + 200) AS far
      FROM means l JOIN corpus c ON c.measure = l.measure
    ), chosen AS (
      SELECT q2.lang, q2.source, q2.measure, (q2.n_rows * q2.mid + 200 * wide.mid) // (q2.n_rows + 200) AS mid,
        (q2.n_rows * (q2.mid - q2.low) + 200 * wide.far) // (q2.n_rows + 200) AS far, wide.mid AS wide_mid
      FROM q2 JOIN wide ON wide.lang IS NOT DISTINCT FROM q2.lang AND wide.measure = q2.measure
    ), cuts AS (
      SELECT lang, source, {pivot} FROM (
        SELECT lang, source, measure, least(mid + greatest({_case("measure")}, 6 * far), greatest(mid, wide_mid) + 2 * {_case("measure")}) AS cut FROM chosen) GROUP BY lang, source
    ), judged AS (
      SELECT m.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT ({over}) AS kept
      FROM m LEFT JOIN cuts c ON m.lang IS NOT DISTINCT FROM c.lang AND m.source IS NOT DISTINCT FROM c.source
    )"""


OP6 = f"""WITH {judged()}
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, kept,
  {", ".join(f"CAST({x} AS BIGINT) AS {x}" for x in MEASURES)}
FROM judged"""
