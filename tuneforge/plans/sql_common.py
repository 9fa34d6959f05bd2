"""DuckDB SQL fragments shared by the oracles (same shapes as sources/tables.py)."""

CORPUS_SELECT = """
  SELECT 'part' AS source, CAST(p_partkey AS VARCHAR) AS row_key, CAST(p_name AS VARCHAR) AS input,
         CAST(p_type AS VARCHAR) AS output, CAST(NULL AS VARCHAR) AS text
  FROM part
  UNION ALL
  SELECT 'documents', CAST(doc_id AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), text
  FROM documents"""

CORPUS_CTE = f"""
corpus AS ({CORPUS_SELECT}
)"""

UTTERANCES_CTE = """
lead_sys AS (
  SELECT DISTINCT conv_id FROM conversations WHERE role = 'system' AND turn = 0
),
utterances AS (
  SELECT c.conv_id AS dlg, CAST(c.turn AS INTEGER) AS pos,
         CAST(c.turn + 1 - CASE WHEN l.conv_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS turn_num,
         c.text AS utterance
  FROM conversations c LEFT JOIN lead_sys l ON c.conv_id = l.conv_id
  WHERE c.role <> 'system'
)"""

def pairs_from(u: str, name: str = "pairs") -> str:
    """CTEs computing dialogue pairs from an utterance relation ``u`` (dlg, pos, turn_num,
    utterance) by the reference rule, written as a self-join."""
    return f"""
{name}_firsts AS (
  SELECT dlg, turn_num, (arg_min(struct_pack(u := utterance), pos)).u AS utterance
  FROM {u} GROUP BY dlg, turn_num
),
{name}_counted AS (SELECT dlg, count(*) AS n_utts FROM {u} GROUP BY dlg),
{name} AS (
  SELECT a.dlg AS conv_id, a.turn_num, a.utterance AS input, b.utterance AS output
  FROM {name}_firsts a JOIN {name}_firsts b ON a.dlg = b.dlg AND b.turn_num = a.turn_num + 1
  JOIN {name}_counted c ON c.dlg = a.dlg
  WHERE a.turn_num >= 1 AND a.turn_num % 2 = 1 AND a.turn_num < c.n_utts
    AND a.utterance IS NOT NULL AND b.utterance IS NOT NULL
)"""


PAIRS_CTE = UTTERANCES_CTE + "," + pairs_from("utterances")


def hash_sql(key_sql: str, seed: int | str, salt: str) -> str:
    """md5(seed:salt:key) as in functions.keys.shuffle_hash."""
    return f"md5(concat_ws(':', CAST({seed} AS VARCHAR), '{salt}', CAST({key_sql} AS VARCHAR)))"
