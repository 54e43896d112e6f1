"""Queries of validation, cleaning, schema comparison and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.operators import distribution as X
from tidegrid.operators import sketches as Y
from tidegrid.operators import quality as Q
from tidegrid.plans import views as V
from tidegrid.plans.registry import query
from tidegrid.session import scratch_path
from tidegrid.sources import tables as S

GAPPY = """gappy AS (SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_partkey % 7 <> 0 THEN l_quantity END AS l_quantity,
  CASE WHEN l_partkey % 11 <> 0 THEN l_extendedprice END AS l_extendedprice FROM lineitem)"""
GAPS = ["l_quantity", "l_extendedprice"]
LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


def rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- rules ---------------------------------------------------------------------------------------


def _rule_sql() -> str:
    def kind(f):
        return f"""CASE json_type(j, '$.{f}') WHEN 'UBIGINT' THEN 'int' WHEN 'BIGINT' THEN 'int'
          WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' END"""

    def text(f):
        return f"(CASE json_type(j, '$.{f}') WHEN 'BOOLEAN' THEN 'True' ELSE json_extract_string(j, '$.{f}') END)"

    def num(f):
        return f"(CASE json_type(j, '$.{f}') WHEN 'BOOLEAN' THEN 1 ELSE try_cast(json_extract_string(j, '$.{f}') AS double) END)"

    checks = []
    for f, r in Q.FEATURE_RULES.items():
        if r.get("required"):
            checks.append((f, "required", f"CASE WHEN {kind(f)} IS NULL THEN 'Missing required feature: ''{f}''' END"))
        t = r["type"]
        names = [t] if isinstance(t, str) else list(t)
        accepted = names + (["bool"] if "int" in names else [])
        inlist = "(" + ",".join(f"'{a}'" for a in accepted) + ")"
        want = names[0] if isinstance(t, str) else f"one of ({', '.join(names)})"
        checks.append((f, "type", f"CASE WHEN {kind(f)} NOT IN {inlist} THEN 'Invalid type for ''{f}'': Expected {want}, got ' || {kind(f)} END"))
        typed = f"{kind(f)} IN {inlist}"
        head = f"'Value for ''{f}'' (' || {text(f)} || "
        if "min_value" in r:
            checks.append((f, "min", f"CASE WHEN {typed} AND {num(f)} < {r['min_value']} THEN {head} ') is below min_value ({r['min_value']})' END"))
        if "max_value" in r:
            checks.append((f, "max", f"CASE WHEN {typed} AND {num(f)} > {r['max_value']} THEN {head} ') is above max_value ({r['max_value']})' END"))
        if "allowed_values" in r:
            checks.append((f, "allowed", f"CASE WHEN {typed} AND {num(f)} NOT IN (0, 1) THEN {head} ') is not in allowed_values: {r['allowed_values']}' END"))
    return checks


_RECORDS = f"WITH {V.RIDES}, records AS (SELECT event_id, ({S.RECORD_TEXT})::json AS j FROM rides)"


@query("c3_validate_rules", f"""{_RECORDS} SELECT event_id,
  list_filter([{', '.join(c for _, _, c in _rule_sql())}], lambda x: x IS NOT NULL) AS errors FROM records""")
def _(spark, sf):
    out = Q.validate_rules(S.feature_records(spark, sf), Q.FEATURE_RULES, "record")
    return out.select("event_id", "errors")


@query("c3_rule_violations", _RECORDS + " SELECT feature, rule, count(*)::bigint AS violation_count FROM (" +
       " UNION ALL ".join(f"SELECT '{f}' AS feature, '{r}' AS rule, {c} AS m FROM records" for f, r, c in _rule_sql())
       + ") WHERE m IS NOT NULL GROUP BY ALL")
def _(spark, sf):
    return Q.rule_violations(S.feature_records(spark, sf), Q.FEATURE_RULES, "record")


@query("c3_request_bounds", f"""WITH {V.FEATURES} SELECT {V.CELL_KEY}, feature_window_start,
  CASE WHEN demand_last_60min > 2000 THEN ['Value for ''demand_last_60min'' (' ||
    demand_last_60min::bigint || '.0) is above max_value (2000)'] ELSE []::varchar[] END AS errors FROM features""")
def _(spark, sf):
    rules = {**Q.REQUEST_RULES}
    rules["demand_last_60min"] = {**rules["demand_last_60min"], "max_value": 2000}
    out = Q.validate_rules(S.features(spark, sf), rules)
    return out.select("grid_id_latitude", "grid_id_longitude", "feature_window_start", "errors")


def _contract_sql() -> str:
    parts = []
    for f, r in Q.DEMAND_CONTRACT.items():
        t = f"json_type(j, '$.{f}')"
        v = f"try_cast(json_extract_string(j, '$.{f}') AS double)"
        numeric = f"{t} IN ('UBIGINT','BIGINT','DOUBLE')"
        ok = {"number": numeric, "integer": f"({numeric} AND {v} = floor({v}))", "string": f"{t} = 'VARCHAR'"}[r["type"]]
        if "min_value" in r:
            ok += f" AND {v} >= {r['min_value']}"
        if "max_value" in r:
            ok += f" AND {v} <= {r['max_value']}"
        if "allowed_values" in r:
            ok += f" AND {v} IN (0, 1)"
        missing = "false" if r.get("required") else "true"
        parts.append(f"(CASE WHEN {t} IS NULL THEN {missing} ELSE coalesce({ok}, false) END)")
    return " AND ".join(parts)


_MESSAGES = f"""WITH {V.RIDES}, texts AS (SELECT event_id, {S.MESSAGE_TEXT} AS message FROM rides),
  messages AS (SELECT *, CASE WHEN json_valid(message) THEN message::json ELSE '{{}}'::json END AS j FROM texts)"""


@query("c4_check_contract", f"{_MESSAGES} SELECT event_id, ({_contract_sql()}) AS is_valid FROM messages")
def _(spark, sf):
    out = Q.check_contract(S.demand_messages(spark, sf), "message", Q.DEMAND_CONTRACT)
    return out.select("event_id", "is_valid")


@query("c4_quarantine_rejected", f"{_MESSAGES} SELECT event_id, message FROM messages WHERE NOT ({_contract_sql()})")
def _(spark, sf):
    _valid, rejected = Q.quarantine(S.demand_messages(spark, sf), "message", Q.DEMAND_CONTRACT)
    return rejected.select("event_id", "message")


# --- cleaning ------------------------------------------------------------------------------------


@query("c5_fit_mean", f"""WITH {GAPPY} SELECT round(avg(l_quantity), 6) AS l_quantity,
  round(avg(l_extendedprice), 6) AS l_extendedprice FROM gappy""")
def _(spark, sf):
    return rounded(Q.fit_imputer(S.gappy_lineitem(spark, sf), GAPS, "mean"), GAPS)


@query("c5_fit_median", f"""WITH {GAPPY} SELECT round(quantile_cont(l_quantity, 0.5), 6) AS l_quantity,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS l_extendedprice FROM gappy""")
def _(spark, sf):
    return rounded(Q.fit_imputer(S.gappy_lineitem(spark, sf), GAPS, "median"), GAPS)


@query("c5_fit_mode", f"""WITH {GAPPY}, q AS (SELECT l_quantity AS v, count(*) AS n FROM gappy WHERE v IS NOT NULL GROUP BY 1),
  p AS (SELECT l_extendedprice AS v, count(*) AS n FROM gappy WHERE v IS NOT NULL GROUP BY 1)
  SELECT (SELECT v FROM q ORDER BY n DESC, v LIMIT 1) AS l_quantity,
         (SELECT v FROM p ORDER BY n DESC, v LIMIT 1) AS l_extendedprice""")
def _(spark, sf):
    return Q.fit_imputer(S.gappy_lineitem(spark, sf), GAPS, "mode")


@query("c5_impute", f"""WITH {GAPPY} SELECT l_orderkey, l_linenumber, l_partkey,
  round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM gappy)), 6) AS l_quantity,
  round(coalesce(l_extendedprice, (SELECT avg(l_extendedprice) FROM gappy)), 6) AS l_extendedprice FROM gappy""")
def _(spark, sf):
    df = S.gappy_lineitem(spark, sf)
    return rounded(Q.impute(df, Q.fit_imputer(df, GAPS, "mean")), GAPS).select(*LI_KEY, *GAPS)


@query("c6_null_outliers_iqr", """WITH q AS (SELECT quantile_cont(l_quantity, 0.25) a1, quantile_cont(l_quantity, 0.75) a3,
    quantile_cont(l_extendedprice, 0.25) b1, quantile_cont(l_extendedprice, 0.75) b3 FROM lineitem)
  SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_quantity BETWEEN a1 - 0.4::double * (a3 - a1) AND a3 + 0.4::double * (a3 - a1) THEN l_quantity END AS l_quantity,
    CASE WHEN l_extendedprice BETWEEN b1 - 0.4::double * (b3 - b1) AND b3 + 0.4::double * (b3 - b1) THEN l_extendedprice END AS l_extendedprice
  FROM lineitem, q""")
def _(spark, sf):
    li = S.table(spark, sf, "lineitem")
    return Q.null_outliers_iqr(li, GAPS, k=0.4).select(*LI_KEY, *GAPS)


@query("c6_cleanse", f"""WITH {GAPPY}, filled AS (SELECT l_orderkey, l_linenumber, l_partkey,
    coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM gappy)) AS l_quantity,
    coalesce(l_extendedprice, (SELECT quantile_cont(l_extendedprice, 0.5) FROM gappy)) AS l_extendedprice FROM gappy),
  q AS (SELECT quantile_cont(l_quantity, 0.25) a1, quantile_cont(l_quantity, 0.75) a3,
    quantile_cont(l_extendedprice, 0.25) b1, quantile_cont(l_extendedprice, 0.75) b3 FROM filled)
  SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_quantity BETWEEN a1 - 3 * (a3 - a1) AND a3 + 3 * (a3 - a1) THEN l_quantity END AS l_quantity,
    CASE WHEN l_extendedprice BETWEEN b1 - 3 * (b3 - b1) AND b3 + 3 * (b3 - b1) THEN l_extendedprice END AS l_extendedprice
  FROM filled, q""")
def _(spark, sf):
    return Q.cleanse(S.gappy_lineitem(spark, sf), GAPS, "median").select(*LI_KEY, *GAPS)


@query("c7_drop_null_per_feature", f"""WITH {GAPPY} SELECT 'l_quantity' AS feature, l_quantity AS value FROM gappy
  WHERE l_quantity IS NOT NULL UNION ALL
  SELECT 'l_extendedprice', l_extendedprice FROM gappy WHERE l_extendedprice IS NOT NULL""")
def _(spark, sf):
    return X.long_features(S.gappy_lineitem(spark, sf), GAPS)


# --- schema versions -----------------------------------------------------------------------------

_REGISTRY = """parts AS (SELECT p_partkey AS k, ['string', 'integer', 'number'] AS kinds, p_size AS s,
    CASE WHEN p_partkey % 4 = 0 THEN 'true' ELSE 'false' END AS required FROM part),
  v1 AS (SELECT k, kinds[s % 3 + 1] AS type, required, CASE WHEN k % 5 = 0 THEN '0' END AS low FROM parts WHERE k % 10 <> 0),
  v2 AS (SELECT k, CASE WHEN k % 7 = 0 THEN kinds[(s + 1) % 3 + 1] ELSE kinds[s % 3 + 1] END AS type, required,
    CASE WHEN k % 6 = 0 THEN '0' END AS low FROM parts WHERE k % 10 <> 1),
  long AS (SELECT 1 AS version, k, 'type' AS property, type AS value FROM v1 UNION ALL
    SELECT 1, k, 'required', required FROM v1 UNION ALL SELECT 1, k, 'min_value', low FROM v1 WHERE low IS NOT NULL UNION ALL
    SELECT 2, k, 'type', type FROM v2 UNION ALL SELECT 2, k, 'required', required FROM v2 UNION ALL
    SELECT 2, k, 'min_value', low FROM v2 WHERE low IS NOT NULL),
  joined AS (SELECT coalesce(o.k, n.k) AS k, coalesce(o.property, n.property) AS property,
    o.value AS ov, n.value AS nv, o.k IS NOT NULL AS in_old, n.k IS NOT NULL AS in_new
    FROM (SELECT * FROM long WHERE version = 1) o FULL JOIN (SELECT * FROM long WHERE version = 2) n
    ON o.k = n.k AND o.property = n.property),
  marked AS (SELECT j.*, CASE WHEN v1.k IS NULL THEN 'added' WHEN v2.k IS NULL THEN 'removed' ELSE 'modified' END AS change,
    coalesce(v1.required = 'true', false) AS old_required, coalesce(v2.required = 'true', false) AS new_required
    FROM joined j LEFT JOIN v1 ON v1.k = j.k LEFT JOIN v2 ON v2.k = j.k),
  diff AS (SELECT 'feature_' || k AS feature, change, property,
    CASE WHEN change = 'modified' AND NOT in_old THEN 'added' ELSE ov END AS old_value,
    CASE WHEN change = 'modified' AND NOT in_new THEN 'removed' ELSE nv END AS new_value, old_required, new_required
    FROM marked WHERE change <> 'modified' OR in_old <> in_new OR ov IS DISTINCT FROM nv)"""


@query("c8_schema_diff", f"WITH {_REGISTRY} SELECT * FROM diff")
def _(spark, sf):
    return Q.schema_diff(S.schema_registry(spark, sf), 1, 2)


@query("c8_schema_history", """WITH reg AS (SELECT v.version, p.p_partkey AS k, q.property, q.value FROM part p,
    (VALUES (1), (2), (4), (9), (10)) v(version),
    LATERAL (VALUES ('type', CASE WHEN p.p_partkey % 7 < v.version THEN 'number' ELSE 'string' END),
      ('required', CASE WHEN p.p_partkey % 4 = 0 THEN 'true' ELSE 'false' END),
      ('min_value', CASE WHEN p.p_partkey % 6 >= v.version THEN '0' END)) q(property, value)
    WHERE q.value IS NOT NULL AND p.p_partkey % 11 <> v.version),
  steps(o, n) AS (VALUES (1, 2), (2, 4), (4, 9), (9, 10)),
  olds AS (SELECT n AS to_version, k, property, value FROM reg JOIN steps ON version = o),
  news AS (SELECT n AS to_version, k, property, value FROM reg JOIN steps ON version = n),
  j AS (SELECT coalesce(a.to_version, b.to_version) AS to_version, coalesce(a.k, b.k) AS k, coalesce(a.property, b.property) AS property,
      a.value AS ov, b.value AS nv FROM olds a FULL JOIN news b ON a.to_version = b.to_version AND a.k = b.k AND a.property = b.property),
  m AS (SELECT *, count(ov) OVER w AS n_old, count(nv) OVER w AS n_new,
      coalesce(max(CASE WHEN property = 'required' THEN ov END) OVER w = 'true', false) AS old_required,
      coalesce(max(CASE WHEN property = 'required' THEN nv END) OVER w = 'true', false) AS new_required
    FROM j WINDOW w AS (PARTITION BY to_version, k))
  SELECT to_version, 'feature_' || k AS feature,
    CASE WHEN n_old = 0 THEN 'added' WHEN n_new = 0 THEN 'removed' ELSE 'modified' END AS change, property,
    CASE WHEN n_old > 0 AND n_new > 0 AND ov IS NULL THEN 'added' ELSE ov END AS old_value,
    CASE WHEN n_old > 0 AND n_new > 0 AND nv IS NULL THEN 'removed' ELSE nv END AS new_value, old_required, new_required
  FROM m WHERE n_old = 0 OR n_new = 0 OR ov IS DISTINCT FROM nv""")
def _(spark, sf):
    """Five versions with gaps between their numbers."""
    k, version = F.col("p_partkey"), F.col("version")
    props = F.array(
        F.struct(F.lit("type").alias("property"), F.when(k % 7 < version, "number").otherwise("string").alias("value")),
        F.struct(F.lit("required").alias("property"), F.when(k % 4 == 0, "true").otherwise("false").alias("value")),
        F.struct(F.lit("min_value").alias("property"), F.when(k % 6 >= version, "0").alias("value")),
    )
    registry = S.table(spark, sf, "part").select(
        "p_partkey", F.explode(F.array(*[F.lit(v) for v in (1, 2, 4, 9, 10)])).alias("version")
    ).filter(k % 11 != version).select(
        "version", F.concat(F.lit("feature_"), k.cast("string")).alias("feature"), F.inline(props)
    ).filter(F.col("value").isNotNull())
    return Q.schema_history(registry)


_BREAKING = f"""{_REGISTRY}, broken AS (
  SELECT feature, 'Removed required feature: ''' || feature || '''' AS message FROM diff
    WHERE change = 'removed' AND old_required AND property = 'required' UNION ALL
  SELECT feature, 'Type changed for required/critical feature ''' || feature || ''': from ' || old_value || ' to ' || new_value
    FROM diff WHERE change = 'modified' AND property = 'type' AND (old_required OR new_required))"""


@query("c9_breaking_changes", f"WITH {_BREAKING} SELECT * FROM broken")
def _(spark, sf):
    return Q.breaking_changes(Q.schema_diff(S.schema_registry(spark, sf), 1, 2))


@query("c9_schema_compat", f"""WITH {_BREAKING} SELECT count(*) = 0 AS is_compatible,
  count(*)::bigint AS breaking_changes FROM broken""")
def _(spark, sf):
    return Q.schema_compat(Q.schema_diff(S.schema_registry(spark, sf), 1, 2))


@query("c10_observed_schema_profile", f"""WITH {V.RIDES}, records AS (
    SELECT ts::date AS day, ({S.RECORD_TEXT})::json AS j FROM rides),
  totals AS (SELECT day, count(*) AS messages FROM records GROUP BY 1),
  seen AS (SELECT day, j, unnest(json_keys(j)) AS field FROM records),
  kinds AS (SELECT day, field, CASE json_type(j, '$.' || field) WHEN 'UBIGINT' THEN 'int' WHEN 'BIGINT' THEN 'int'
    WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' END AS kind FROM seen)
  SELECT day, field, messages::bigint AS messages, round(1 - count(*)::double / messages, 6) AS missing_rate,
    round(1 - count(kind)::double / count(*), 6) AS null_rate,
    list_sort(list_distinct(list(kind))) AS kinds
  FROM kinds JOIN totals USING (day) GROUP BY day, field, messages""")
def _(spark, sf):
    records = S.ride_events(spark, sf).selectExpr("ts", f"{S.RECORD_TEXT} AS record")
    return rounded(Q.observed_schema_profile(records, "record", "ts"), ["missing_rate", "null_rate"])


# --- drift ---------------------------------------------------------------------------------------

DRIFT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

_CDF = "WITH pair AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value, (l_shipdate >= timestamp '1999-01-01')::int AS cur FROM lineitem"
    for c in DRIFT_COLS) + """), counts AS (SELECT feature, value, sum(cur) AS nc, sum(1 - cur) AS nb FROM pair
    WHERE value IS NOT NULL GROUP BY ALL),
  cum AS (SELECT feature, value, sum(nc) OVER w AS cc, sum(nb) OVER w AS cb, sum(nc) OVER f AS tc, sum(nb) OVER f AS tb,
    lead(value) OVER w AS nv FROM counts
    WINDOW w AS (PARTITION BY feature ORDER BY value), f AS (PARTITION BY feature)),
  stats AS (SELECT feature, max(abs(cc / tc - cb / tb)) AS d, max(tc)::bigint AS n_current, max(tb)::bigint AS n_baseline,
    sum(abs(cc / tc - cb / tb) * (nv - value)) AS area, max(value) - min(value) AS span FROM cum GROUP BY feature),
  tested AS (SELECT *, sqrt(n_current * (n_baseline / (n_current + n_baseline))) * d AS z FROM stats),
  p AS (SELECT *, CASE WHEN z < 0.1 THEN 1.0::double ELSE least(1.0::double, greatest(0.0::double, 2 * list_sum(list_transform(range(1, 101),
    lambda k: (CASE WHEN k % 2 = 1 THEN 1.0::double ELSE -1.0::double END) * exp(-2.0::double * k * k * z * z))))) END AS pv FROM tested)"""

_KS = """round(d, 6) AS ks_statistic, round(pv, 6) AS ks_pvalue, pv < 0.05 AS ks_drift_detected"""
_WS = """round(area, 6) AS wasserstein_distance, round(area / span, 6) AS normalized_wasserstein_distance,
  area / span > 0.1 AS ws_drift_detected"""
_WS_COLS = ["wasserstein_distance", "normalized_wasserstein_distance"]


@query("d4_ks_two_sample", f"{_CDF} SELECT feature, n_current, n_baseline, {_KS} FROM p")
def _(spark, sf):
    cur, base = S.drift_pair(spark, sf)
    return rounded(X.ks_two_sample(cur, base, DRIFT_COLS), ["ks_statistic", "ks_pvalue"])


@query("d5_wasserstein_1d", f"{_CDF} SELECT feature, n_current, n_baseline, {_WS} FROM p")
def _(spark, sf):
    cur, base = S.drift_pair(spark, sf)
    return rounded(X.wasserstein_1d(cur, base, DRIFT_COLS), _WS_COLS)


@query("d6_drift_report", f"""{_CDF} SELECT feature, n_current, n_baseline, {_KS}, {_WS},
  pv < 0.05 OR area / span > 0.1 AS overall_drift_detected,
  bool_or(pv < 0.05 OR area / span > 0.1) OVER () AS any_drift_detected FROM p""")
def _(spark, sf):
    cur, base = S.drift_pair(spark, sf)
    return rounded(X.drift_report(cur, base, DRIFT_COLS), ["ks_statistic", "ks_pvalue", *_WS_COLS])


@query("d6_sketched_drift", f"""{_CDF} SELECT feature, n_current, n_baseline, true AS ks_within_error, true AS distance_within_error,
  true AS error_is_small FROM p""")
def _(spark, sf):
    """The report over the two periods from stored sketches of their months, held against the exact one."""
    cur, base = S.drift_pair(spark, sf)
    path = scratch_path(spark, "sketches")
    Y.write_sketches(base.unionAll(cur), DRIFT_COLS, "l_shipdate", path, unit="month")
    report = Y.sketched_drift(Y.read_sketches(spark, path, "1999-01-01", "9999-12-31"), Y.read_sketches(spark, path, "0001-01-01", "1998-12-31"))
    exact = X.drift_report(cur, base, DRIFT_COLS).select(
        "feature", F.col("ks_statistic").alias("_ks"), F.col("normalized_wasserstein_distance").alias("_ws")
    )
    return report.join(exact, "feature").select(
        "feature", "n_current", "n_baseline", (F.abs(F.col("ks_statistic") - F.col("_ks")) <= F.col("ks_error")).alias("ks_within_error"),
        (F.abs(F.col("normalized_wasserstein_distance") - F.col("_ws")) <= F.col("ks_error")).alias("distance_within_error"),
        (F.col("ks_error") < 0.01).alias("error_is_small"),
    )


@query("e10_zscore_outlier", """WITH s AS (SELECT avg("value") AS m, stddev_samp("value") AS sd FROM events)
  SELECT event_id, round(("value" - m) / sd, 6) AS value_zscore, abs(("value" - m) / sd) > 3 AS is_outlier FROM events, s""")
def _(spark, sf):
    out = X.zscore_outlier(S.table(spark, sf, "events"), ["value"])
    return rounded(out.select("event_id", "value_zscore", "is_outlier"), ["value_zscore"])
