"""DuckDB SQL for chat formatting."""

_ESCAPED = "replace(t, chr(92), chr(92) || chr(92))"
for _c in ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"):
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}' || chr(92) || '{_c[1:]}')"

OP4 = f"""WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), turns AS (
  SELECT *, CASE r WHEN 'user' THEN 18 WHEN 'assistant' THEN 5 ELSE 20 + length({_ESCAPED.replace("replace(t,", "replace(r,")}) END + length({_ESCAPED}) AS n FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
  CAST(sum(CASE WHEN r = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256, CAST(sum(n) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""
