"""DuckDB SQL for every registered query (``oracle_sql()`` of the entry file).

Written against raw rows, not cells: pair and extension counts come from a
row-level long form joined to itself per event, so they check the cell
plan rather than repeat it.
"""

from __future__ import annotations

from .. import spec as S
from .registry import (ANY_COLUMN_PATTERNS, AWKWARD_VALUES, BAD_DATE, BAD_NUMBER, FIXED_RUN_ID, GIVEN_PATTERNS, NEAR_UNIQUE,
                       PREDICATES, SHORT_ROW, TRIE_FEATURES)

FEATS = S.MINING_FEATURES
DOMAINS = S.EVENT_DOMAINS

TXN = """
txn AS (
  SELECT event_id,
    CASE WHEN event_id % 10 < 7 THEN 'train' ELSE 'test' END AS split,
    ts AS trans_date_trans_time,
    CAST(DATE '1940-01-01' + CAST(user_id * 7919 % 23000 AS INT) AS DATE) AS dob,
    value * 2 AS amt,
    event_type AS category,
    CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CAST(25 AS DOUBLE) + (user_id * 37 % 2400) / CAST(100 AS DOUBLE) AS lat,
    CAST(-120 AS DOUBLE) + (user_id * 53 % 5000) / CAST(100 AS DOUBLE) AS long,
    CAST(25 AS DOUBLE) + (user_id * 37 % 2400) / CAST(100 AS DOUBLE)
      + (CASE WHEN event_id % 50 = 0 THEN 0 WHEN event_id % 25 = 1 THEN 8
              ELSE ((event_id * 31 % 200) - 100) / CAST(100 AS DOUBLE) END) AS merch_lat,
    CAST(-120 AS DOUBLE) + (user_id * 53 % 5000) / CAST(100 AS DOUBLE)
      + (CASE WHEN event_id % 50 = 0 THEN 0
              ELSE ((event_id * 47 % 200) - 100) / CAST(100 AS DOUBLE) END) AS merch_long,
    CAST(CASE WHEN (hour(ts) >= 22 OR hour(ts) < 6) AND value * 2 >= 200 AND event_id % 3 <> 0 THEN 1
         WHEN event_id % 200 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_fraud
  FROM events
),
cos0 AS (
  SELECT *, sin(radians(lat)) * sin(radians(merch_lat))
      + cos(radians(lat)) * cos(radians(merch_lat)) * cos(radians(long) - radians(merch_long)) AS cosang
  FROM txn
),
feat0 AS (
  SELECT * EXCLUDE (cosang),
    CAST(hour(trans_date_trans_time) AS INTEGER) AS hour,
    CAST(dayofweek(trans_date_trans_time) + 1 AS INTEGER) AS day_of_week,
    CAST(month(trans_date_trans_time) AS INTEGER) AS month,
    CASE WHEN dayofweek(trans_date_trans_time) + 1 IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour(trans_date_trans_time) BETWEEN 6 AND 11 THEN 'morning'
         WHEN hour(trans_date_trans_time) BETWEEN 12 AND 17 THEN 'afternoon'
         WHEN hour(trans_date_trans_time) BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS time_period,
    CASE WHEN amt < 10 THEN 'very_low' WHEN amt < 50 THEN 'low' WHEN amt < 200 THEN 'medium'
         WHEN amt < 500 THEN 'high' ELSE 'very_high' END AS amt_category,
    CAST(floor(date_diff('day', dob, CAST(trans_date_trans_time AS DATE)) / 365.0) AS BIGINT) AS age,
    acos(CASE WHEN cosang > 1 THEN CAST(1 AS DOUBLE) WHEN cosang < -1 THEN CAST(-1 AS DOUBLE)
              ELSE cosang END) * 6371 AS distance_km
  FROM cos0
),
feat AS (
  SELECT *,
    CASE WHEN age < 25 THEN 'young' WHEN age < 35 THEN 'young_adult' WHEN age < 50 THEN 'middle_aged'
         WHEN age < 65 THEN 'older_adult' ELSE 'senior' END AS age_group,
    CASE WHEN distance_km < 5 THEN 'very_close' WHEN distance_km < 25 THEN 'close'
         WHEN distance_km < 100 THEN 'medium_distance' WHEN distance_km < 500 THEN 'far'
         ELSE 'very_far' END AS distance_category
  FROM feat0
),
train AS (SELECT * FROM feat WHERE split = 'train'),
test AS (SELECT * FROM feat WHERE split = 'test')"""

ALL_COLUMNS = ("event_id", "trans_date_trans_time", "dob", "amt", "category", "gender", "lat", "long",
               "merch_lat", "merch_long", "is_fraud", "hour", "day_of_week", "month", "age", "distance_km",
               "is_weekend", "time_period", "amt_category", "age_group", "distance_category")
DOUBLE_COLUMNS = ("amt", "lat", "long", "merch_lat", "merch_long", "distance_km")


LINEITEM = f"""
lf AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id,
    CASE WHEN l.l_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS split,
    o.o_orderpriority AS order_priority, c.c_mktsegment AS segment, split_part(p.p_type, ' ', 1) AS part_class,
    l.l_linestatus AS line_status, o.o_orderstatus AS order_status,
    {{bands}},
    CAST(CASE WHEN l.l_returnflag = '{S.RETURNED_FLAG}' THEN 1 ELSE 0 END AS INTEGER) AS is_returned
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey
),
train AS (SELECT * FROM lf WHERE split = 'train'),
test AS (SELECT * FROM lf WHERE split = 'test')"""


def band_sql(col: str, edges, labels, name: str) -> str:
    whens = " ".join(f"WHEN {col} < CAST({e!r} AS DOUBLE) THEN '{lab}'" for e, lab in zip(edges, labels))
    return f"CASE {whens} ELSE '{labels[-1]}' END AS {name}"


LINEITEM = LINEITEM.replace("{bands}", ",\n    ".join([
    band_sql("l.l_quantity", S.QUANTITY_EDGES, S.QUANTITY_LABELS, "quantity_band"),
    band_sql("l.l_extendedprice", S.PRICE_EDGES, S.PRICE_LABELS, "price_band"),
    band_sql("l.l_discount", S.DISCOUNT_EDGES, S.DISCOUNT_LABELS, "discount_band"),
]))


class Binding:
    """What the SQL generator needs to know about a transaction view."""

    def __init__(self, base: str, feats, domains, label: str, row_id: str):
        self.base, self.feats, self.domains, self.label, self.row_id = base, feats, domains, label, row_id


EVENTS = Binding(TXN, S.MINING_FEATURES, S.EVENT_DOMAINS, "is_fraud", "event_id")
WIDE = Binding(TXN, S.WIDE_FEATURES, S.EVENT_DOMAINS, "is_fraud", "event_id")
ORDER_LINES = Binding(LINEITEM, S.LINEITEM_FEATURES, {}, "is_returned", "row_id")


def q(body: str, *ctes: str, b: Binding = EVENTS) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {b.base.strip()}{extra}\n{body}"


def sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def long_form(src: str, name: str, b: Binding = EVENTS) -> str:
    """Rows -> (event_id, is_fraud, fidx, feature, value) (row id and label under fixed names)."""
    parts = [f"SELECT {b.row_id} AS event_id, {b.label} AS is_fraud, {i} AS fidx, '{f}' AS feature, "
             f"CAST({f} AS VARCHAR) AS value FROM {src}"
             for i, f in enumerate(b.feats)]
    return f"{name} AS (\n  " + "\n  UNION ALL ".join(parts) + "\n)"


def domain_ctes(src_long: str, b: Binding = EVENTS) -> list[str]:
    feats = b.feats
    fixed2, fixed3 = b.domains.get(2, {}), b.domains.get(3, {})

    def fidx_rows(fixed):
        return ", ".join(f"('{f}', {feats.index(f)})" for f in feats if f not in fixed)

    def fixed_values(fixed):
        rows = [f"('{f}', {feats.index(f)}, {sql_str(v)}, {r + 1})"
                for f in feats if f in fixed for r, v in enumerate(fixed[f])]
        if not rows:
            return "SELECT * FROM (VALUES ('', 0, '', 0)) t(feature, fidx, value, vrank) WHERE false"
        return f"SELECT * FROM (VALUES {', '.join(rows)}) t(feature, fidx, value, vrank)"

    out = [
        f"vc AS (SELECT feature, value, count(*) AS cnt FROM {src_long} GROUP BY feature, value)",
        "ranked AS (SELECT feature, value, cnt, row_number() OVER (PARTITION BY feature "
        "ORDER BY cnt DESC, value ASC NULLS LAST) AS r FROM vc)",
    ]
    for lvl, fixed, k in ((2, fixed2, S.PatternSpec().top_k(2)), (3, fixed3, S.PatternSpec().top_k(3))):
        out.append(f"rf{lvl}(feature, fidx) AS (VALUES {fidx_rows(fixed)})")
        out.append(
            f"dom{lvl} AS ({fixed_values(fixed)}\n"
            f"  UNION ALL SELECT r.feature, rf.fidx, r.value, r.r FROM ranked r JOIN rf{lvl} rf ON r.feature = rf.feature\n"
            f"  WHERE r.r <= {k} AND r.value IS NOT NULL)")
    return out


def metric_sql(n: str, p: str) -> str:
    """support/confidence/lift/score in the fixed operation order (tot: n_total, p_total)."""
    conf = f"(CASE WHEN {n} > 0 THEN {p} / {n} ELSE 0::DOUBLE END)"
    base = "(tot.p_total / tot.n_total)"
    lift = f"(CASE WHEN {base} > 0 THEN {conf} / {base} ELSE 0::DOUBLE END)"
    return (f"{n} / tot.n_total AS support, {conf} AS confidence, {lift} AS lift, "
            f"{lift} * {conf} * ({n} / tot.n_total) AS score")


def tot_cte(b: Binding = EVENTS) -> str:
    return (f"tot AS (SELECT count(*) AS n_total, count(*) FILTER (WHERE {b.label} = 1) AS p_total, "
            f"count(*) FILTER (WHERE {b.label} = 0) AS q_total FROM train)")


TOT = tot_cte()


def mining_ctes(levels: int = 4, min_lift: float | None = None, b: Binding = EVENTS) -> list[str]:
    """CTEs lvl2 .. lvl<levels> (ranked) over the train rows."""
    sup = S.MIN_SUPPORT
    lift_cond = f" AND lift >= {min_lift!r}" if min_lift is not None else ""
    ctes = [long_form("train", "rl", b), tot_cte(b), *domain_ctes("rl", b)]
    ctes.append(f"""l2raw AS (
  SELECT a.fidx AS g1, b.fidx AS g2, da.vrank AS g3, db.vrank AS g4,
         a.feature AS fa, a.value AS va, b.feature AS fb, b.value AS vb,
         count(*) AS n, count(*) FILTER (WHERE a.is_fraud = 1) AS p
  FROM rl a JOIN rl b ON a.event_id = b.event_id AND a.fidx < b.fidx
  JOIN dom2 da ON da.feature = a.feature AND da.value = a.value
  JOIN dom2 db ON db.feature = b.feature AND db.value = b.value
  GROUP BY ALL)""")
    ctes.append(f"""l2m AS (
  SELECT fa || '=' || va || ' AND ' || fb || '=' || vb AS pattern_name, [fa, fb] AS feats, [va, vb] AS vals,
         2 AS level, n AS pattern_total, p AS pattern_fraud, {metric_sql('n', 'p')}, g1, g2, g3, g4
  FROM l2raw, tot)""")
    ctes.append(f"""lvl2 AS (
  SELECT *, CAST(row_number() OVER (ORDER BY score DESC, g1, g2, g3, g4) AS INTEGER) AS level_rank
  FROM l2m WHERE support >= {sup[2]!r} AND confidence >= {S.MIN_CONFIDENCE[2]!r}{lift_cond})""")
    for k in range(3, levels + 1):
        prev = f"lvl{k - 1}"
        ctes.append(f"b{k} AS (SELECT level_rank AS base_rank, pattern_name AS base_name, feats, vals "
                    f"FROM {prev} WHERE level_rank <= {S.BEAM})")
        ctes.append(f"bi{k} AS (SELECT base_rank, unnest(feats) AS feature, unnest(vals) AS value, "
                    f"len(feats) AS sz FROM b{k})")
        ctes.append(f"""m{k} AS (
  SELECT bi.base_rank, x.event_id FROM bi{k} bi JOIN rl x ON x.feature = bi.feature AND x.value = bi.value
  GROUP BY bi.base_rank, x.event_id HAVING count(*) = max(bi.sz))""")
        ctes.append(f"""l{k}raw AS (
  SELECT m.base_rank, x.fidx, d.vrank, x.feature, x.value,
         count(*) AS n, count(*) FILTER (WHERE x.is_fraud = 1) AS p
  FROM m{k} m JOIN rl x ON x.event_id = m.event_id
  JOIN b{k} b ON b.base_rank = m.base_rank
  JOIN dom3 d ON d.feature = x.feature AND d.value = x.value
  WHERE NOT list_contains(b.feats, x.feature)
  GROUP BY ALL)""")
        ctes.append(f"""l{k}m AS (
  SELECT b.base_name || ' AND ' || r.feature || '=' || r.value AS pattern_name,
         list_append(b.feats, r.feature) AS feats, list_append(b.vals, r.value) AS vals,
         {k} AS level, r.n AS pattern_total, r.p AS pattern_fraud, {metric_sql('r.n', 'r.p')},
         r.base_rank AS g1, r.fidx AS g2, r.vrank AS g3, 0 AS g4
  FROM l{k}raw r JOIN b{k} b ON b.base_rank = r.base_rank, tot)""")
        ctes.append(f"""lvl{k} AS (
  SELECT *, CAST(row_number() OVER (ORDER BY score DESC, g1, g2, g3, g4) AS INTEGER) AS level_rank
  FROM l{k}m WHERE support >= {sup[k]!r}{lift_cond})""")
    union = " UNION ALL ".join(f"SELECT * FROM lvl{k}" for k in range(2, levels + 1))
    ctes.append(f"""allp AS (
  SELECT *, CAST(row_number() OVER (ORDER BY score DESC, level, level_rank) AS INTEGER) AS rank,
         CAST(level AS VARCHAR) || '-Feature' AS pattern_type
  FROM ({union}))""")
    return ctes


PATTERN_COLS = ("pattern_name, CAST(level AS INTEGER) AS level, CAST(pattern_total AS BIGINT) AS pattern_total, "
                "CAST(pattern_fraud AS BIGINT) AS pattern_fraud, support, confidence, lift, score, level_rank")


def test_metrics_ctes(n_top: int, b: Binding = EVENTS) -> list[str]:
    """Train top-n patterns re-measured on the test rows (tl) with test totals (ttot)."""
    return [
        long_form("test", "tl", b),
        (f"ttot AS (SELECT count(*) AS n_total, count(*) FILTER (WHERE {b.label} = 1) AS p_total FROM test)"),
        f"top AS (SELECT * FROM allp WHERE rank <= {n_top})",
        "ti AS (SELECT rank, unnest(feats) AS feature, unnest(vals) AS value, len(feats) AS sz FROM top)",
        """tm AS (SELECT ti.rank, x.event_id, max(x.is_fraud) AS is_fraud FROM ti JOIN tl x
  ON x.feature = ti.feature AND x.value = ti.value GROUP BY ti.rank, x.event_id HAVING count(*) = max(ti.sz))""",
        """tg AS (SELECT rank, count(*) AS n, count(*) FILTER (WHERE is_fraud = 1) AS p FROM tm GROUP BY rank)""",
        f"""tmet AS (SELECT tg.rank, tg.n, tg.p, {metric_sql('tg.n', 'tg.p').replace('tot.', 'ttot.')}
  FROM tg, ttot)""",
        f"""val AS (
  SELECT t.rank, t.pattern_name, tm.n IS NOT NULL AND tm.n > 0 AS valid,
    CASE WHEN NOT (tm.n IS NOT NULL AND tm.n > 0) THEN 'No matching transactions' END AS reason,
    CAST(t.pattern_total AS BIGINT) AS train_pattern_total, CAST(t.pattern_fraud AS BIGINT) AS train_pattern_fraud,
    t.support AS train_support, t.confidence AS train_confidence, t.lift AS train_lift,
    CAST(tm.n AS BIGINT) AS test_pattern_total, CAST(tm.p AS BIGINT) AS test_pattern_fraud,
    tm.support AS test_support, tm.confidence AS test_confidence, tm.lift AS test_lift,
    abs(tm.support - t.support) AS support_diff, abs(tm.confidence - t.confidence) AS confidence_diff,
    abs(tm.lift - t.lift) AS lift_diff
  FROM top t LEFT JOIN tmet tm ON tm.rank = t.rank)""",
        f"""stab AS (
  SELECT *, coalesce(valid AND support_diff < {S.STABLE_SUPPORT_DIFF!r} AND confidence_diff < {S.STABLE_CONFIDENCE_DIFF!r}
           AND lift_diff < {S.STABLE_LIFT_DIFF!r}, false) AS stable,
    CASE WHEN NOT valid THEN 'FAILED'
         WHEN support_diff < {S.STABLE_SUPPORT_DIFF!r} AND confidence_diff < {S.STABLE_CONFIDENCE_DIFF!r}
              AND lift_diff < {S.STABLE_LIFT_DIFF!r} THEN 'STABLE' ELSE 'UNSTABLE' END AS status
  FROM val)""",
    ]


def rate_sql(feature: str, src: str = "train", rounded: bool = True, ordered: bool = False) -> str:
    rate = "CAST(sum(p) AS DOUBLE) / (sum(q) + sum(p)) * 100"
    rate = f"round({rate}, 2)" if rounded else rate
    order = ""
    if ordered:
        order_case = " ".join(f"WHEN {sql_str(v)} THEN {i + 1}" for i, v in enumerate(S.AMOUNT_ORDER))
        order = f", CAST(CASE CAST({feature} AS VARCHAR) {order_case} ELSE 0 END AS BIGINT) AS order_idx"
    return q(f"""SELECT CAST({feature} AS VARCHAR) AS {feature}, CAST(sum(q) + sum(p) AS BIGINT) AS total,
  CAST(sum(p) AS BIGINT) AS "1", {rate} AS fraud_rate{order}
FROM (SELECT {feature}, CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END AS p, CASE WHEN is_fraud = 0 THEN 1 ELSE 0 END AS q
      FROM {src})
GROUP BY 1""")


def rate_long_sql(features, src: str = "train") -> str:
    parts = [f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value, is_fraud FROM {src}" for f in features]
    union = "\n  UNION ALL ".join(parts)
    return q(f"""SELECT feature, value, CAST(count(*) FILTER (WHERE is_fraud = 0) AS BIGINT) AS "0",
  CAST(count(*) FILTER (WHERE is_fraud = 1) AS BIGINT) AS "1",
  CAST(count(*) FILTER (WHERE is_fraud IN (0, 1)) AS BIGINT) AS total,
  CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) / count(*) FILTER (WHERE is_fraud IN (0, 1)) * 100 AS fraud_rate
FROM ({union}) x GROUP BY feature, value""")


def label_sql(labels) -> str:
    rows = []
    for i, (text, cond, why) in enumerate(labels):
        head = f"SELECT {i + 1} AS pattern_id, {'CAST(NULL AS VARCHAR)' if text is None else sql_str(text)} AS pattern_name"
        if cond is None:
            rows.append(f"{head}, false AS ok, {sql_str(why)} AS why, 0::BIGINT AS n, 0::BIGINT AS p")
        else:
            rows.append(f"{head}, true AS ok, NULL AS why, count(*) AS n, "
                        f"count(*) FILTER (WHERE is_fraud = 1) AS p FROM train WHERE {cond}")
    return measured_sql(rows)


def summary_lines_sql(mine: list[str]) -> str:
    head = ["", S.SUMMARY_HEADER, S.SUMMARY_GENERATED.format("run"), "", S.SUMMARY_DATASET, None,
            S.SUMMARY_SOURCE.format("patterns"), "", S.SUMMARY_TOP_TITLE]
    lines = "\n  UNION ALL ".join(
        f"SELECT {i} AS line_no, " + (f"{sql_str(S.SUMMARY_COUNT)} || (SELECT count(*) FROM allp)" if t is None
                                      else sql_str(t)) + " AS line" for i, t in enumerate(head))
    top = f"""(SELECT *, CASE WHEN max(confidence) OVER () <= 1 THEN confidence * 100 ELSE confidence END AS pct
      FROM allp WHERE rank <= {S.SUMMARY_TOP})"""
    return q(f"""SELECT CAST(line_no AS INTEGER) AS line_no, line FROM ({lines}
  UNION ALL SELECT 10 + rank * 3, rank || '. ' || substr(pattern_name, 1, {S.SUMMARY_NAME_WIDTH}) || '...' FROM {top} t
  UNION ALL SELECT 11 + rank * 3, printf('   Fraud Rate: %.1f', pct) || '%' FROM {top} t
  UNION ALL SELECT 12 + rank * 3, '' FROM {top} t) x""", *mine)


def measured_sql(rows: list[str]) -> str:
    union = "\n  UNION ALL ".join(rows)
    return q(f"""SELECT CAST(g.pattern_id AS INTEGER) AS pattern_id, g.pattern_name,
  CASE WHEN g.ok AND g.n > 0 THEN CAST(g.n AS BIGINT) END AS pattern_total,
  CASE WHEN g.ok AND g.n > 0 THEN CAST(g.p AS BIGINT) END AS pattern_fraud,
  CASE WHEN g.ok AND g.n > 0 THEN g.n / tot.n_total END AS support,
  CASE WHEN g.ok AND g.n > 0 THEN g.p / g.n END AS confidence,
  CASE WHEN g.ok AND g.n > 0 THEN (CASE WHEN tot.p_total / tot.n_total > 0
       THEN (g.p / g.n) / (tot.p_total / tot.n_total) ELSE 0.0 END) END AS lift,
  CASE WHEN g.ok AND g.n > 0 THEN (CASE WHEN tot.p_total / tot.n_total > 0
       THEN (g.p / g.n) / (tot.p_total / tot.n_total) ELSE 0.0 END) * (g.p / g.n) * (g.n / tot.n_total) END AS score,
  g.ok AND g.n > 0 AS valid,
  CASE WHEN NOT g.ok THEN g.why WHEN g.n = 0 THEN 'No matching transactions' END AS reason
FROM ({union}) g, tot""", TOT)


def trie_sql() -> str:
    """Every prefix of every label counted by itself over the test rows."""
    f = TRIE_FEATURES
    text = " || ' AND ' || ".join(f"'{c}=' || " + (f"lpad(CAST({c} AS VARCHAR), 2, '0')" if c == "hour" else f"CAST({c} AS VARCHAR)")
                                  for c in f)
    counts = ", ".join(f"c{k} AS (SELECT {', '.join(f[:k])}, count(*) AS n, count(*) FILTER (WHERE is_fraud = 1) AS p "
                       f"FROM test GROUP BY ALL)" for k in range(1, len(f) + 1))
    joins = " ".join(f"LEFT JOIN c{k} USING ({', '.join(f[:k])})" for k in range(1, len(f) + 1))
    last = f"c{len(f)}"
    left = "[" + ", ".join(f"coalesce(c{k}.n, 0)" for k in range(1, len(f) + 1)) + "]"
    totals = "(SELECT count(*) AS n_total, count(*) FILTER (WHERE is_fraud = 1) AS p_total FROM test) tot"
    score = (f"(({last}.p / {last}.n) / (tot.p_total / tot.n_total)) * ({last}.p / {last}.n) * ({last}.n / tot.n_total)")
    return q(f"""SELECT pattern_name, unnest(range(1, {len(f) + 1}))::INTEGER AS step, unnest(after_all)::BIGINT AS rows_left, pattern_total,
  pattern_fraud, score, valid, reason
FROM (SELECT {text} AS pattern_name, {left} AS after_all, {last}.n AS pattern_total, {last}.p AS pattern_fraud,
        CASE WHEN {last}.n > 0 THEN {score} END AS score, {last}.n IS NOT NULL AS valid,
        CASE WHEN {last}.n IS NULL THEN 'No matching transactions' END AS reason
      FROM (SELECT DISTINCT {', '.join(f)} FROM train) l {joins}, {totals})
UNION ALL SELECT 'time_period=night AND merchant=' || category, NULL, NULL, NULL, NULL, NULL, false,
  'Filter error on condition 2: unknown column merchant' FROM (SELECT DISTINCT category FROM train)
UNION ALL SELECT 'time_period=night AND hour=' || category, NULL, NULL, NULL, NULL, NULL, false,
  'Filter error on condition 2: malformed value ' || category FROM (SELECT DISTINCT category FROM train)""", counts)


def awkward_binding() -> Binding:
    """The events with categories that a label must escape, all of them ranked by count."""
    cases = " ".join(f"WHEN {sql_str(a)} THEN {sql_str(b)}" for a, b in AWKWARD_VALUES)
    base = TXN.replace("event_type AS category", f"CASE event_type {cases} END AS category")
    domains = {k: {f: v for f, v in d.items() if f != "category"} for k, d in S.EVENT_DOMAINS.items()}
    return Binding(base, S.MINING_FEATURES, domains, "is_fraud", "event_id")


def rejects_sql() -> str:
    """The planted bad records."""
    def kind(nth, column, text, reason):
        return (f"SELECT split, CAST(event_id AS VARCHAR) AS row, {column} AS column_name, {text} AS text, '{reason}' AS reason "
                f"FROM txn WHERE event_id % {nth} = 0")
    return q("\nUNION ALL ".join([
        kind(BAD_NUMBER, "'amt'", "'USD ' || CAST(amt AS VARCHAR)", "Malformed double"),
        kind(BAD_DATE, "'dob'", "'1980-13-45'", "Malformed date"),
        kind(SHORT_ROW, "NULL", "NULL", "Wrong number of fields")]))


def near_unique_sql() -> str:
    parts = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({'CAST(ts AS DATE)' if c == 'day' else c} AS VARCHAR) AS value FROM events"
                               for c in NEAR_UNIQUE)
    return f"""SELECT feature, value, CAST(count AS BIGINT) AS count, CAST(value_rank AS INTEGER) AS value_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY feature ORDER BY count DESC, value ASC NULLS LAST) AS value_rank
  FROM (SELECT feature, value, count(*) AS count FROM ({parts}) GROUP BY ALL))
WHERE value_rank <= 10 AND value IS NOT NULL"""


def export_validation_sql() -> str:
    base = Binding(TXN.replace("WHERE split = 'test')", "WHERE split = 'test' AND gender <> 'M')"), S.MINING_FEATURES,
                   S.EVENT_DOMAINS, "is_fraud", "event_id")
    metrics = {"Train_Confidence": "train_confidence", "Test_Confidence": "test_confidence", "Train_Lift": "train_lift",
               "Test_Lift": "test_lift", "Confidence_Diff": "confidence_diff", "Lift_Diff": "lift_diff"}
    cols = ", ".join(f"CASE WHEN valid THEN {v} END AS {k}, CASE WHEN NOT valid THEN 'N/A' END AS {k}_text" for k, v in metrics.items())
    return q(f"""SELECT rank AS Pattern_ID, pattern_name AS Pattern_Name, status AS Status,
  CASE WHEN valid THEN 'Yes' ELSE 'No' END AS Valid, {cols} FROM stab""",
             *mining_ctes(b=base), *test_metrics_ctes(S.TOP_N, base), b=base)


def null_profile_sql() -> str:
    parts = []
    for i, c in enumerate(ALL_COLUMNS):
        nan = f"count(*) FILTER (WHERE isnan({c}))" if c in DOUBLE_COLUMNS else "0"
        parts.append(f"SELECT split, {i} AS column_index, '{c}' AS \"column\", "
                     f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
                     f"CAST({nan} AS BIGINT) AS nan_count FROM feat GROUP BY split")
    return q("\nUNION ALL ".join(parts))


def all_sql() -> dict[str, str]:
    mine = mining_ctes()
    out = {
        "features_time": q("SELECT event_id, split, hour, day_of_week, month, is_weekend, time_period FROM feat"),
        "features_amount_age": q("SELECT event_id, amt, amt_category, age, age_group FROM feat"),
        "features_distance": q("SELECT event_id, round(distance_km, 3) AS distance_km_3, distance_category FROM feat"),
        "dataset_shape": q(f"SELECT split, count(*) AS n_rows, {len(ALL_COLUMNS)} AS n_columns FROM feat GROUP BY split"),
        "null_profile": null_profile_sql(),
        "label_distribution": q("""SELECT split, is_fraud, count(*) AS count,
  count(*) / sum(count(*)) OVER (PARTITION BY split) * 100 AS percentage FROM feat GROUP BY split, is_fraud"""),
        "composition": q("""SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE is_fraud = 1) AS n_fraud,
  count(*) FILTER (WHERE is_fraud = 0) AS n_non_fraud, count(*) FILTER (WHERE is_fraud IN (0, 1)) AS n_labelled,
  CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) / count(*) FILTER (WHERE is_fraud IN (0, 1)) * 100 AS fraud_rate_pct,
  100 - CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) / count(*) FILTER (WHERE is_fraud IN (0, 1)) * 100
    AS non_fraud_rate_pct
FROM feat GROUP BY split"""),
    }
    for f in S.PROFILE_FEATURES:
        out[f"rate_by_feature_{f}"] = rate_sql(f)
    out.update({
        "rate_all_features": rate_long_sql(S.PROFILE_FEATURES),
        "rate_time_period_series": rate_sql("time_period", rounded=False),
        "rate_amount_ordered": rate_sql("amt_category", rounded=False, ordered=True),
        "compare_datasets": q("""SELECT dataset, n_rows, n_fraud, fraud_rate_pct,
  abs(max(CASE WHEN dataset = 'train' THEN fraud_rate_pct END) OVER ()
    - max(CASE WHEN dataset = 'test' THEN fraud_rate_pct END) OVER ()) AS rate_diff_abs
FROM (SELECT split AS dataset, count(*) AS n_rows, count(*) FILTER (WHERE is_fraud = 1) AS n_fraud,
        CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) / count(*) * 100 AS fraud_rate_pct
      FROM feat GROUP BY split)"""),
        "temporal_profile": rate_long_sql(("hour", "day_of_week", "month")),
        "profile_rates_from_cells": q(f"""SELECT split, feature, value,
  CAST(count(*) FILTER (WHERE is_fraud = 0) AS BIGINT) AS "0", CAST(count(*) FILTER (WHERE is_fraud = 1) AS BIGINT) AS "1",
  CAST(count(*) FILTER (WHERE is_fraud IN (0, 1)) AS BIGINT) AS total,
  round(CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) / count(*) FILTER (WHERE is_fraud IN (0, 1)) * 100, 2)
    AS fraud_rate
FROM ({' UNION ALL '.join(f"SELECT split, '{f}' AS feature, CAST({f} AS VARCHAR) AS value, is_fraud FROM feat"
                          for f in S.PROFILE_FEATURES)}) x GROUP BY split, feature, value"""),
        "cells": q(f"""SELECT split, {', '.join(f'CAST({f} AS VARCHAR) AS {f}' for f in FEATS)},
  count(*) AS n, count(*) FILTER (WHERE is_fraud = 1) AS p, count(*) FILTER (WHERE is_fraud = 0) AS q
FROM feat GROUP BY ALL"""),
        "top_values": q(f"""SELECT feature, value, CAST(cnt AS BIGINT) AS count, CAST(r AS INTEGER) AS value_rank
FROM ranked WHERE r <= {S.PatternSpec().top_k(2)} AND value IS NOT NULL""", long_form("train", "rl"),
                        *domain_ctes("rl")[:2]),
        "item_domain_l2": q("SELECT feature, CAST(fidx AS INTEGER) AS fidx, value, CAST(vrank AS INTEGER) AS vrank "
                            "FROM dom2", long_form("train", "rl"), *domain_ctes("rl")),
        "item_domain_l3": q("SELECT feature, CAST(fidx AS INTEGER) AS fidx, value, CAST(vrank AS INTEGER) AS vrank "
                            "FROM dom3", long_form("train", "rl"), *domain_ctes("rl")),
        "pairs_all": q(f"""SELECT fa, va, fb, vb, CAST(n AS BIGINT) AS pattern_total, CAST(p AS BIGINT) AS pattern_fraud,
  {metric_sql('n', 'p')}
FROM (SELECT a.feature AS fa, a.value AS va, b.feature AS fb, b.value AS vb, count(*) AS n,
        count(*) FILTER (WHERE a.is_fraud = 1) AS p
      FROM rl a JOIN rl b ON a.event_id = b.event_id AND a.fidx < b.fidx GROUP BY ALL), tot""",
                       long_form("train", "rl"), TOT),
        "pairs_grouping_sets": q(f"""SELECT fa, va, fb, vb, CAST(count(*) AS BIGINT) AS pattern_total,
  CAST(count(*) FILTER (WHERE is_fraud = 1) AS BIGINT) AS pattern_fraud
FROM (SELECT a.feature AS fa, a.value AS va, b.feature AS fb, b.value AS vb, a.is_fraud
      FROM rl a JOIN rl b ON a.event_id = b.event_id AND a.fidx < b.fidx)
GROUP BY fa, va, fb, vb""", long_form("train", "rl")),
        "pairs_kept": q(f"SELECT {PATTERN_COLS} FROM lvl2", *mine),
        "extend_l3": q(f"SELECT {PATTERN_COLS} FROM lvl3", *mine),
        "extend_l4": q(f"SELECT {PATTERN_COLS} FROM lvl4", *mine),
        "patterns_ranked": q(f"SELECT {PATTERN_COLS}, rank, pattern_type FROM allp", *mine),
        "patterns_top15": q(f"""SELECT rank AS Rank, pattern_type AS Pattern_Type, pattern_name AS Pattern_Name,
  support AS Support, confidence AS Confidence, lift AS Lift, score AS Score,
  CAST(pattern_total AS BIGINT) AS Pattern_Total_Transactions, CAST(pattern_fraud AS BIGINT) AS Pattern_Fraud_Transactions,
  confidence * 100 AS Fraud_Rate_Percent
FROM allp WHERE rank <= {S.TOP_N}""", *mine),
        "min_lift": q(f"SELECT {PATTERN_COLS}, rank FROM allp",
                      *mining_ctes(min_lift=S.DOCUMENTED_MIN_LIFT)),
        "pattern_metrics_given": label_sql(GIVEN_PATTERNS),
        "pattern_metrics_any_column": label_sql(ANY_COLUMN_PATTERNS),
    })
    val = [*mine, *test_metrics_ctes(S.VALIDATE_N)]
    funnel = [
        *val[:-2],
        "tip AS (SELECT rank, unnest(feats) AS feature, unnest(vals) AS value, "
        "generate_subscripts(feats, 1) AS pos FROM top)",
        "fm AS (SELECT tip.rank, x.event_id, tip.pos FROM tip JOIN tl x ON x.feature = tip.feature "
        "AND x.value = tip.value)",
        "fc AS (SELECT rank, event_id, " + ", ".join(
            f"count(*) FILTER (WHERE pos <= {k}) AS c{k}" for k in range(1, 5)) + " FROM fm GROUP BY rank, event_id)",
        "fa AS (SELECT rank, " + ", ".join(
            f"count(*) FILTER (WHERE c{k} = {k}) AS a{k}" for k in range(1, 5)) + " FROM fc GROUP BY rank)",
    ]
    funnel_cols = ", ".join(f"CASE WHEN len(t.feats) >= {k} THEN CAST(coalesce(fa.a{k}, 0) AS BIGINT) END AS after_{k}"
                            for k in range(1, 5))
    out.update({
        "pattern_funnel": q(f"SELECT t.rank, t.pattern_name, {funnel_cols} FROM top t LEFT JOIN fa ON fa.rank = t.rank",
                            *funnel),
        "validate_top10": q("SELECT * FROM stab", *val),
        "stability_top10": q("""SELECT rank AS Pattern_ID, pattern_name AS Pattern_Name,
  CASE WHEN valid THEN train_confidence END AS Train_Confidence, CASE WHEN valid THEN test_confidence END AS Test_Confidence,
  CASE WHEN valid THEN train_lift END AS Train_Lift, CASE WHEN valid THEN test_lift END AS Test_Lift,
  CASE WHEN valid THEN confidence_diff END AS Confidence_Diff, CASE WHEN valid THEN lift_diff END AS Lift_Diff,
  status AS Status, CASE WHEN valid THEN 'Yes' ELSE 'No' END AS Valid FROM stab""", *val),
        "pattern_counts": q("""SELECT CAST(level AS INTEGER) AS level, count(*) AS n_patterns,
  CASE WHEN level IS NULL THEN 'Total' ELSE CAST(level AS VARCHAR) || '-Feature' END AS pattern_type
FROM allp GROUP BY ROLLUP (level)""", *mine),
        "pattern_type_counts": q("SELECT pattern_type, count(*) AS count FROM allp GROUP BY pattern_type", *mine),
        "pattern_summary": q("""SELECT count(*) AS n_patterns,
  round(CASE WHEN max(confidence) <= 1.0 THEN avg(confidence) * 100 ELSE avg(confidence) END, 9) AS avg_confidence_pct,
  CASE WHEN max(confidence) <= 1.0 THEN max(confidence) * 100 ELSE max(confidence) END AS max_confidence_pct
FROM allp""", *mine),
        "run_summary": q(f"""SELECT * FROM (VALUES
  (1, 'Total_Training_Transactions', (SELECT CAST(p_total + q_total AS DOUBLE) FROM tot)),
  (2, 'Total_Test_Transactions', (SELECT CAST(count(*) AS DOUBLE) FROM test)),
  (3, 'Training_Fraud_Rate_Percent', (SELECT CAST(p_total AS DOUBLE) / (p_total + q_total) * 100 FROM tot)),
  (4, 'Total_Patterns_Discovered', (SELECT CAST(count(*) AS DOUBLE) FROM allp)),
  (5, 'Patterns_Validated', (SELECT CAST(count(*) FILTER (WHERE valid) AS DOUBLE) FROM stab)),
  (6, 'Stable_Patterns', (SELECT CAST(count(*) FILTER (WHERE stable) AS DOUBLE) FROM stab)),
  (7, 'Best_Pattern_Confidence_Percent', (SELECT coalesce(max(confidence * 100), 0.0) FROM allp WHERE rank = 1)),
  (8, 'Best_Pattern_Lift', (SELECT coalesce(max(lift), 0.0) FROM allp WHERE rank = 1))
) t(metric_no, metric, value), (SELECT CAST(NULL AS VARCHAR) AS text)""", *val),
        "report_table": q(f"""SELECT rank, substring(pattern_name, 1, {S.REPORT_NAME_WIDTH}) AS pattern_short,
  confidence, lift, score FROM allp WHERE rank <= {S.VALIDATE_N}""", *mine),
        "pattern_labels": q(f"""SELECT rank, pattern_name, rl2 AS readable_label,
  CAST(rank AS VARCHAR) || '. ' || rl2 AS display_label, '#' || CAST(rank AS VARCHAR) AS rank_label,
  CASE WHEN max(confidence) OVER () <= 1.0 THEN confidence * 100 ELSE confidence END AS confidence_pct, lift
FROM (SELECT *, CASE WHEN length(rl1) > {S.READABLE_WIDTH} THEN substring(rl1, 1, {S.READABLE_KEEP}) || '...'
                     ELSE rl1 END AS rl2
      FROM (SELECT *, replace(replace(pattern_name, ' AND ', ' & '), '=', ': ') AS rl1
            FROM allp WHERE rank <= {S.VALIDATE_N}))""", *mine),
        "feature_matrix": q("""SELECT least(fa, fb) AS feature_a, greatest(fa, fb) AS feature_b,
  count(*) AS n_patterns, max(lift) AS max_lift, max(score) AS max_score
FROM (SELECT a.f AS fa, b.f AS fb, a.lift, a.score FROM
        (SELECT rank, lift, score, unnest(feats) AS f, generate_subscripts(feats, 1) AS i FROM allp) a
        JOIN (SELECT rank, unnest(feats) AS f, generate_subscripts(feats, 1) AS i FROM allp) b
        ON a.rank = b.rank AND a.i < b.i)
GROUP BY 1, 2""", *mine),
        "feature_importance": q("""SELECT feature, count(*) AS n_patterns, round(avg(score), 12) AS avg_score,
  max(score) AS max_score, max(lift) AS max_lift
FROM (SELECT score, lift, unnest(feats) AS feature FROM allp) GROUP BY feature""", *mine),
        "significance": q(f"""SELECT rank, pattern_name, CAST(pattern_total AS BIGINT) AS pattern_total,
  CAST(pattern_fraud AS BIGINT) AS pattern_fraud, confidence,
  CASE WHEN pattern_total > 0 AND n_total - pattern_total > 0 AND
            (p_total / n_total) * (1::DOUBLE - p_total / n_total)
            * (1::DOUBLE / pattern_total + 1::DOUBLE / (n_total - pattern_total)) > 0
       THEN (pattern_fraud / pattern_total - (p_total - pattern_fraud) / (n_total - pattern_total))
            / sqrt((p_total / n_total) * (1::DOUBLE - p_total / n_total)
                   * (1::DOUBLE / pattern_total + 1::DOUBLE / (n_total - pattern_total))) END AS z_score
FROM (SELECT allp.*, CAST(tot.n_total AS DOUBLE) AS n_total, CAST(tot.p_total AS DOUBLE) AS p_total
      FROM allp, tot WHERE rank <= {S.TOP_N})""", *mine),
        # Every term of every tail, by log-gamma.
        "false_discovery": q("""SELECT rank, pattern_name, n AS pattern_total, k AS pattern_fraud,
  round(log_p / ln(10) + 0.0, 6) + 0.0 AS log10_p, round(log_q / ln(10) + 0.0, 6) + 0.0 AS log10_q, log_q <= ln(0.05) AS significant
FROM (SELECT *, least(min(log_p + ln(tests / place)) OVER (ORDER BY place DESC), 0) AS log_q
  FROM (SELECT *, row_number() OVER (ORDER BY log_p, rank) AS place, CAST(count(*) OVER () AS DOUBLE) AS tests
    FROM (SELECT rank, pattern_name, n, k, least(max(top) + ln(sum(exp(term - top))), 0) AS log_p
      FROM (SELECT *, max(term) OVER (PARTITION BY rank) AS top
        FROM (SELECT *, lgamma(bp + 1) - lgamma(x + 1) - lgamma(bp - x + 1) + lgamma(bn - bp + 1) - lgamma(n - x + 1)
              - lgamma(bn - bp - n + x + 1) - lgamma(bn + 1) + lgamma(n + 1) + lgamma(bn - n + 1) AS term
          FROM (SELECT rank, pattern_name, CAST(pattern_total AS BIGINT) AS n, CAST(pattern_fraud AS BIGINT) AS k,
                  CAST(n_total AS BIGINT) AS bn, CAST(p_total AS BIGINT) AS bp,
                  unnest(generate_series(greatest(CAST(pattern_fraud AS BIGINT), CAST(pattern_total + p_total - n_total AS BIGINT)),
                                         CAST(least(pattern_total, p_total) AS BIGINT))) AS x
                FROM allp, tot) a) b) c
      GROUP BY rank, pattern_name, n, k) d) e) f""", *mine),
        "confidence_drop": q("""SELECT count(*) AS n_valid,
  round(avg((train_confidence - test_confidence) / train_confidence), 12) AS avg_relative_drop,
  round(avg(train_confidence - test_confidence), 12) AS avg_absolute_drop
FROM stab WHERE valid AND train_confidence > 0""", *val),
        "validation_long": q("""SELECT rank, pattern_name, valid, metric, train_value, test_value FROM (
  SELECT rank, pattern_name, valid, 'support' AS metric, train_support AS train_value, test_support AS test_value, 1 AS o FROM stab
  UNION ALL SELECT rank, pattern_name, valid, 'confidence', train_confidence, test_confidence, 2 FROM stab
  UNION ALL SELECT rank, pattern_name, valid, 'lift', train_lift, test_lift, 3 FROM stab)""", *val),
        "chart_summary_exported": q("""SELECT count(*) AS n_patterns,
  round(CASE WHEN max(confidence) <= 1.0 THEN avg(confidence) * 100 ELSE avg(confidence) END, 9) AS avg_confidence_pct,
  CASE WHEN max(confidence) <= 1.0 THEN max(confidence) * 100 ELSE max(confidence) END AS max_confidence_pct
FROM allp""", *mine),
        "chart_total_only": q("SELECT count(*) AS n_patterns FROM allp", *mine),
        "streaming_cells": None,
    })
    wide = mining_ctes(b=WIDE)
    out["wide_patterns_ranked"] = q(f"SELECT {PATTERN_COLS}, rank, pattern_type FROM allp", *wide, b=WIDE)
    li = mining_ctes(b=ORDER_LINES)
    li_val = [*li, *test_metrics_ctes(S.VALIDATE_N, ORDER_LINES)]
    out.update({
        "li_cells": q(f"""SELECT split, {', '.join(f'CAST({f} AS VARCHAR) AS {f}' for f in S.LINEITEM_FEATURES)},
  count(*) AS n, count(*) FILTER (WHERE is_returned = 1) AS p, count(*) FILTER (WHERE is_returned = 0) AS q
FROM lf GROUP BY ALL""", b=ORDER_LINES),
        "li_patterns_ranked": q(f"SELECT {PATTERN_COLS}, rank, pattern_type FROM allp", *li, b=ORDER_LINES),
        "li_validate_top10": q("SELECT * FROM stab", *li_val, b=ORDER_LINES),
        "li_rate_all_features": q(f"""SELECT feature, value, CAST(count(*) FILTER (WHERE is_returned = 0) AS BIGINT) AS "0",
  CAST(count(*) FILTER (WHERE is_returned = 1) AS BIGINT) AS "1",
  CAST(count(*) FILTER (WHERE is_returned IN (0, 1)) AS BIGINT) AS total,
  CAST(count(*) FILTER (WHERE is_returned = 1) AS DOUBLE) / count(*) FILTER (WHERE is_returned IN (0, 1)) * 100
    AS fraud_rate
FROM ({' UNION ALL '.join(f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value, is_returned FROM train"
                          for f in S.LINEITEM_FEATURES)}) x GROUP BY feature, value""", b=ORDER_LINES),
    })
    out["results_published"] = out["files_with_rejects"] = out["patterns_top15"]
    out["export_all_patterns"] = out["patterns_top15"].replace(f"WHERE rank <= {S.TOP_N}", "")
    out["export_validation"] = export_validation_sql()
    out["files_rejects"] = rejects_sql()
    out["predicate_counts"] = q("\nUNION ALL ".join(
        f"SELECT {i + 1} AS pattern_id, count(*) AS n, count(*) FILTER (WHERE is_fraud = 1) AS p FROM train WHERE {cond}"
        for i, (_, cond) in enumerate(PREDICATES)))
    for name in ("dataset_shape", "null_profile", "label_distribution"):
        out[f"{name}_observed"] = out[name]
    out["top_values_heavy"], out["top_values_near_unique"] = out["top_values"], near_unique_sql()
    awkward = awkward_binding()
    out["label_trie_funnel"] = trie_sql()
    out["labels_round_trip"] = q("""SELECT rank, CAST(generate_subscripts(feats, 1) AS INTEGER) AS position, unnest(feats) AS feature,
  unnest(vals) AS value FROM allp""", *mining_ctes(b=awkward), b=awkward)
    out["streaming_cells"] = out["cells"]
    out["export_roundtrip"] = out["files_patterns_top15"] = out["patterns_top15"]
    out["summary_lines"] = summary_lines_sql(mine)
    out["files_summary"] = f"""SELECT metric AS "Metric", value AS number, CAST(NULL AS VARCHAR) AS text
FROM ({out["run_summary"]}) s
UNION ALL SELECT '{S.SUMMARY_METRICS[8]}', CAST(NULL AS DOUBLE), '{FIXED_RUN_ID}'"""
    return out
