"""DuckDB SQL for the operators that SQL can express."""

_RENDER = "array_to_string(list_transform({0}, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '')"
_MASK = """array_to_string(list_transform(list_filter(range(1, len({0}) + 1), lambda i: {0}[i].role = 'assistant'),
  lambda i: (length(coalesce(array_to_string(list_transform({0}[1:i-1], lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), ''), '')) + length({0}[i].role) + 5)::varchar
    || ':' || length(array_to_string(list_transform({0}[1:i], lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), ''))::varchar), ',')"""

CHAT = f"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), talks AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS turns FROM turns GROUP BY conv_id
), spots AS (
  SELECT *, list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant') AS places FROM talks
), pairs AS (
  SELECT conv_id, turns[1:places[-1]] AS chosen,
    list_append(turns[1:places[-1] - 1], {{'role': 'assistant', 'text': CASE WHEN len(places) > 1 THEN turns[places[-2]].text ELSE turns[places[-1] - 1].text END}}) AS rejected
  FROM spots WHERE len(places) > 0 AND places[-1] > 1
), common AS (
  SELECT *, len(list_filter(range(1, least(len(chosen), len(rejected)) + 1),
      lambda i: array_to_string(list_transform(chosen[1:i], lambda t: len(t.role) || ':' || t.role || len(t.text) || ':' || t.text), '')
         = array_to_string(list_transform(rejected[1:i], lambda t: len(t.role) || ':' || t.role || len(t.text) || ':' || t.text), ''))) AS n
  FROM pairs
), cut AS (
  SELECT conv_id, n, chosen[1:n] AS p, chosen[n+1:] AS a, rejected[n+1:] AS b FROM common
)
SELECT conv_id, n AS n_common, coalesce({_RENDER.format("p")}, '') AS prompt, coalesce({_RENDER.format("a")}, '') AS chosen,
  coalesce({_RENDER.format("b")}, '') AS rejected, coalesce({_MASK.format("a")}, '') AS chosen_mask, coalesce({_MASK.format("b")}, '') AS rejected_mask
FROM cut
"""
