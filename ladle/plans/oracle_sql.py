"""DuckDB SQL builders for oracles that need a row-by-row state machine.

The flush rules of :mod:`ladle.operators.batching` are replayed with a
recursive CTE per shard (one recursion step per row), which is the
independent reference the Spark fold is checked against.
"""

from __future__ import annotations

BIG = 1 << 62


def varint_sql(n: str) -> str:
    return (f"(CASE WHEN {n} < 128 THEN 1 WHEN {n} < 16384 THEN 2 WHEN {n} < 2097152 THEN 3 "
            f"WHEN {n} < 268435456 THEN 4 ELSE 5 END)")


def str_bytes_sql(col: str) -> str:
    return f"({varint_sql(f'strlen({col})')} + strlen({col}))"


def fold_sql(base: str, order: str, max_rows: int | None = None, max_bytes: int | None = None,
             max_time_us: int | None = None) -> str:
    """CTE text defining ``folded(shard, rn, sz, batch, close_r, prev_r)`` and
    ``batch_summary(shard, batch, n_rows, n_bytes, reason)``.

    ``base`` is a SELECT yielding ``shard``, ``sz`` (bytes), ``t`` (event-time
    microseconds, may be 0) and the ``order`` columns.
    """
    N = max_rows or BIG
    B = max_bytes or BIG
    use_t = max_time_us is not None
    T = max_time_us or 0
    fired = "(f.fire IS NOT NULL AND s.t >= f.fire)" if use_t else "FALSE"
    c1 = f"(CASE WHEN {fired} THEN 0 ELSE f.c END)"
    b1 = f"(CASE WHEN {fired} THEN 0 ELSE f.b END)"
    bid1 = f"(CASE WHEN {fired} AND f.c > 0 THEN f.nbid + 1 ELSE f.nbid END)"
    prev_t = f"(CASE WHEN {fired} AND f.c > 0 THEN 'time' END)"
    fire1 = f"(CASE WHEN {fired} THEN NULL ELSE f.fire END)"
    fire2 = f"(CASE WHEN {c1} = 0 AND {fire1} IS NULL THEN s.t + {T} ELSE {fire1} END)" if use_t else "NULL::BIGINT"
    ovf = f"({c1} > 0 AND {b1} + s.sz > {B})"
    bid2 = f"(CASE WHEN {ovf} THEN {bid1} + 1 ELSE {bid1} END)"
    c2 = f"(CASE WHEN {ovf} THEN 1 ELSE {c1} + 1 END)"
    b2 = f"(CASE WHEN {ovf} THEN s.sz ELSE {b1} + s.sz END)"
    prev = f"(CASE WHEN {ovf} THEN 'bytes' ELSE {prev_t} END)"
    closes = f"({c2} >= {N} OR {b2} >= {B})"
    close_r = f"(CASE WHEN {b2} >= {B} THEN 'bytes' WHEN {c2} >= {N} THEN 'rows' END)"
    first_closes = f"(1 >= {N} OR sz >= {B})"
    first_close_r = f"(CASE WHEN sz >= {B} THEN 'bytes' WHEN 1 >= {N} THEN 'rows' END)"
    first_fire = f"t + {T}" if use_t else "NULL::BIGINT"
    return f"""
src AS (
  SELECT shard, sz, t, row_number() OVER (PARTITION BY shard ORDER BY {order}) AS rn FROM ({base}) base_rows
),
fold AS (
  SELECT shard, rn, sz, 0::BIGINT AS batch, {first_close_r}::VARCHAR AS close_r, NULL::VARCHAR AS prev_r,
         (CASE WHEN {first_closes} THEN 0 ELSE 1 END)::BIGINT AS c,
         (CASE WHEN {first_closes} THEN 0 ELSE sz END)::BIGINT AS b,
         (CASE WHEN {first_closes} THEN 1 ELSE 0 END)::BIGINT AS nbid,
         ({first_fire})::BIGINT AS fire
  FROM src WHERE rn = 1
  UNION ALL
  SELECT s.shard, s.rn, s.sz, ({bid2})::BIGINT, {close_r}, {prev},
         (CASE WHEN {closes} THEN 0 ELSE {c2} END)::BIGINT,
         (CASE WHEN {closes} THEN 0 ELSE {b2} END)::BIGINT,
         (CASE WHEN {closes} THEN {bid2} + 1 ELSE {bid2} END)::BIGINT,
         ({fire2})::BIGINT
  FROM fold f JOIN src s ON s.shard = f.shard AND s.rn = f.rn + 1
),
folded AS (SELECT shard, rn, sz, batch, close_r, prev_r FROM fold),
batch_agg AS (
  SELECT shard, batch, count(*)::BIGINT AS n_rows, sum(sz)::BIGINT AS n_bytes,
         max(close_r) AS close_r, max(prev_r) AS prev_r
  FROM folded GROUP BY shard, batch
),
batch_summary AS (
  SELECT shard, batch, n_rows, n_bytes,
         coalesce(close_r, lead(prev_r) OVER (PARTITION BY shard ORDER BY batch), 'end') AS reason
  FROM batch_agg
)"""
