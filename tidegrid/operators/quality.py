"""Validation, quarantine, imputing, outliers, and schema comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidegrid.operators.distribution import exact_quantiles, long_features

Rules = Mapping[str, Mapping[str, Any]]

# Rule set of a feature record.
FEATURE_RULES: Rules = {
    "geohash_id": {"type": "str", "required": True},
    "hour_of_day": {"type": "int", "required": True, "min_value": 0, "max_value": 23},
    "demand_current_5min": {"type": "float", "required": True, "min_value": 0.0},
    "is_weekend": {"type": "int", "allowed_values": [0, 1]},
    "temperature_celsius": {"type": ("int", "float"), "min_value": -50, "max_value": 50},
}

# Bounds of a prediction request.
REQUEST_RULES: Rules = {
    "hour_of_day": {"required": True, "min_value": 0, "max_value": 23},
    "day_of_week": {"required": True, "min_value": 0, "max_value": 6},
    "is_weekend": {"required": True, "min_value": 0, "max_value": 1},
    "is_holiday": {"required": True, "min_value": 0, "max_value": 1},
    "peak_hour_indicator": {"required": True, "min_value": 0, "max_value": 1},
    "demand_last_15min": {"required": True, "min_value": 0},
    "demand_last_30min": {"required": True, "min_value": 0},
    "demand_last_60min": {"required": True, "min_value": 0},
    "demand_last_1440min": {"required": True, "min_value": 0},
}

# Message contract of a demand event (JSON type, bounds, members; R = required).
DEMAND_CONTRACT: Rules = {
    "event_timestamp": {"type": "string", "required": True},
    "pickup_latitude": {"type": "number", "required": True, "min_value": -90, "max_value": 90},
    "pickup_longitude": {"type": "number", "required": True, "min_value": -180, "max_value": 180},
    "dropoff_latitude": {"type": "number", "required": True, "min_value": -90, "max_value": 90},
    "dropoff_longitude": {"type": "number", "required": True, "min_value": -180, "max_value": 180},
    "hour_of_day": {"type": "integer", "required": True, "min_value": 0, "max_value": 23},
    "day_of_week": {"type": "integer", "required": True, "min_value": 0, "max_value": 6},
    "is_weekend": {"type": "integer", "required": True, "allowed_values": [0, 1]},
    "is_holiday": {"type": "integer", "required": True, "allowed_values": [0, 1]},
    "peak_hour_indicator": {"type": "integer", "required": True, "allowed_values": [0, 1]},
    "demand_at_pickup": {"type": "integer", "required": True, "min_value": 0},
    "month": {"type": "integer", "min_value": 1, "max_value": 12},
    "grid_id_latitude": {"type": "number"},
    "grid_id_longitude": {"type": "number"},
    "poi_density": {"type": "number", "min_value": 0},
    "traffic_density_past_hour": {"type": "number", "min_value": 0},
    "temperature": {"type": "number"},
    "precipitation": {"type": "number", "min_value": 0},
    "wind_speed": {"type": "number", "min_value": 0},
    "weather_condition_code": {"type": "integer", "min_value": 0, "max_value": 999},
    "demand_last_15min": {"type": "number", "min_value": 0},
    "demand_last_30min": {"type": "number", "min_value": 0},
    "demand_last_hour": {"type": "number", "min_value": 0},
    "demand_same_hour_last_day": {"type": "number", "min_value": 0},
    "future_demand_next_15min": {"type": "number", "min_value": 0},
}

def _text(value: Any) -> str:
    """SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


# Kinds of a variant's types. Whole numbers beyond 64 bits are decimals there.
_KINDS = {
    "BIGINT": "int", "DOUBLE": "float", "FLOAT": "float", "DECIMAL": "float", "STRING": "str",
    "BOOLEAN": "bool", "ARRAY": "list", "OBJECT": "dict", "VOID": "null",
}


def kind_of(t: str) -> str:
    """SQL: kind from a variant's type text. "null" for a JSON null, null for no value."""
    pairs = ", ".join(f"'{k}', '{v}'" for k, v in _KINDS.items())
    return f"element_at(map({pairs}), regexp_extract({t}, '[A-Z]+', 0))"


# Texts a JSON parser may read as something else than a string.
_AMBIGUOUS = ("true", "false", "NaN", "Infinity", "+INF", "INF", "-Infinity", "-INF")
_CORRUPT = "_corrupt_record"


def _with_json_fields(
    df: DataFrame, json_col: str, names: Sequence[str], texts: bool = True
) -> DataFrame:
    """Add ``_k<i>``, ``_n<i>`` and (if asked for) ``_t<i>``: kind, number and text of the JSON
    value of the i-th name; and ``_object``: is the text one JSON object?

    The text is parsed twice for all fields together, as strings and as numbers; only a number
    token gives a number, so the pair tells the kind. Building a variant per field and asking for
    its type costs several times as much; it is kept for the few texts that could be either.

    Spark copies an expression into the filters above it, which would parse once per check. The
    last step therefore is a one-element ``inline``, which filters do not pass.
    """

    def schema(kind: str) -> str:
        return ", ".join(f"`{n}` {kind}" for n in names)

    options = {"columnNameOfCorruptRecord": _CORRUPT}
    parsed = df.withColumns(
        {
            "_s": F.from_json(json_col, f"{schema('string')}, {_CORRUPT} string", options),
            "_d": F.from_json(json_col, schema("double")),
        }
    )
    ambiguous = ", ".join(_text(a) for a in _AMBIGUOUS)

    def kind(n: str) -> str:
        text, number = f"_s.`{n}`", f"_d.`{n}`"
        value = f"try_variant_get(try_parse_json(`{json_col}`), {_text(f'$.{n}')}, 'variant')"
        return f"""CASE WHEN abs({number}) <= 1.7976931348623157E308D THEN
            CASE WHEN contains({text}, '.') OR contains({text}, 'e') OR contains({text}, 'E') THEN 'float' ELSE 'int' END
          WHEN {text} IS NULL AND NOT contains(`{json_col}`, '"{n}"') THEN NULL
          WHEN {text} IS NULL OR substring({text}, 1, 1) IN ('[', '{{') OR {text} IN ({ambiguous})
            THEN {kind_of(f"schema_of_variant({value})")}
          ELSE 'str' END"""

    cells = []
    for i, n in enumerate(names):
        cells += [f"'_k{i}', {kind(n)}", f"'_n{i}', _d.`{n}`"]
        if texts:
            cells.append(f"'_t{i}', _s.`{n}`")
    is_object = f"coalesce(_s.`{_CORRUPT}` IS NULL AND ltrim(`{json_col}`) LIKE '{{%', false)"
    found = f"named_struct('_object', {is_object}, {', '.join(cells)})"
    return parsed.withColumn("_found", F.expr(found)).select(*df.columns, F.inline(F.array("_found")))


class _Value:
    """SQL for what the checks need to know about one field."""

    def __init__(self, kind: str, number: str, text: str, present: str):
        self.kind, self.number, self.text, self.present = kind, number, text, present


def _json_value(i: int) -> _Value:
    kind = f"nullif(_k{i}, 'null')"
    number = f"(CASE WHEN _k{i} <> 'bool' THEN _n{i} WHEN _t{i} = 'true' THEN 1D ELSE 0D END)"
    text = f"""(CASE _k{i} WHEN 'float' THEN cast(_n{i} AS string)
      WHEN 'bool' THEN initcap(_t{i}) ELSE _t{i} END)"""
    return _Value(kind, number, text, f"{kind} IS NOT NULL")


def _column_value(df: DataFrame, name: str) -> _Value:
    if name not in df.columns:
        return _Value("cast(NULL AS string)", "cast(NULL AS double)", "cast(NULL AS string)", "false")
    dt, c = df.schema[name].dataType, f"`{name}`"
    text = f"cast({c} AS string)"
    if isinstance(dt, T.IntegralType):
        kind = "int"
    elif isinstance(dt, (T.FractionalType, T.DecimalType)):
        kind = "float"
    elif isinstance(dt, T.BooleanType):
        kind, text = "bool", f"initcap({text})"
    elif isinstance(dt, T.ArrayType):
        kind, text = "list", f"to_json({c})"
    elif isinstance(dt, (T.StructType, T.MapType)):
        kind, text = "dict", f"to_json({c})"
    else:
        kind = "str"
    number = "cast(NULL AS double)" if kind in ("list", "dict") else f"try_cast({c} AS double)"
    return _Value(f"'{kind}'", number, text, f"{c} IS NOT NULL")


def _violations(name: str, rule: Mapping[str, Any], v: _Value, bool_is_int: bool) -> list[str]:
    """SQL of the checks of one field, in order."""

    # Rule names and message texts below.
    def error(when: str, kind: str, *message: str) -> str:
        text = ", ".join(message)
        return f"""CASE WHEN {when} THEN named_struct(
          'feature', {_text(name)}, 'rule', '{kind}', 'message', concat({text})) END"""

    out = []
    if rule.get("required"):
        out.append(error(f"NOT ({v.present})", "required", _text(f"Missing required feature: '{name}'")))
    typed = v.present
    expected = rule.get("type")
    if expected:
        many = not isinstance(expected, str)
        names = tuple(expected) if many else (expected,)
        accepted = [*names, *(["bool"] if bool_is_int and "int" in names else [])]
        members = ", ".join(_text(a) for a in accepted)
        typed = f"{v.kind} IN ({members})"
        wanted = f"one of ({', '.join(names)})" if many else names[0]
        head = _text(f"Invalid type for '{name}': Expected {wanted}, got ")
        out.append(error(f"{v.kind} NOT IN ({members})", "type", head, v.kind))
    head = _text(f"Value for '{name}' (")
    low, high, allowed = rule.get("min_value"), rule.get("max_value"), rule.get("allowed_values")
    if low is not None:
        tail = _text(f") is below min_value ({low})")
        out.append(error(f"{typed} AND {v.number} < {float(low)}D", "min", head, v.text, tail))
    if high is not None:
        tail = _text(f") is above max_value ({high})")
        out.append(error(f"{typed} AND {v.number} > {float(high)}D", "max", head, v.text, tail))
    if allowed is not None:
        tail = _text(f") is not in allowed_values: {list(allowed)}")
        if all(isinstance(a, str) for a in allowed):
            member = f"{v.text} IN ({', '.join(_text(a) for a in allowed)})"
        else:
            member = f"{v.number} IN ({', '.join(f'{float(a)}D' for a in allowed)})"
        out.append(error(f"{typed} AND NOT coalesce({member}, false)", "allowed", head, v.text, tail))
    return out


def find_violations(
    df: DataFrame, rules: Rules, json_col: str | None = None, bool_is_int: bool = True
) -> DataFrame:
    """Add ``violations``: array of (feature, rule, message) in rule order.

    With ``json_col`` the record is the JSON text there, and the kind of each value is the one
    written in the message; otherwise the record is the row and kinds are column types.
    A whole number does not pass a float rule; true and false pass an int rule (as 1 and 0) unless
    ``bool_is_int`` is false. Range and member checks run only after the type check passed.
    """
    found: list[str] = []
    for i, (name, rule) in enumerate(rules.items()):
        v = _json_value(i) if json_col else _column_value(df, name)
        found += _violations(name, rule, v, bool_is_int)
    work = _with_json_fields(df, json_col, list(rules)) if json_col else df
    checks = F.expr(f"array_compact(array({', '.join(found)}))")
    return work.select(*df.columns, checks.alias("violations"))


def validate_rules(
    df: DataFrame, rules: Rules, json_col: str | None = None, bool_is_int: bool = True
) -> DataFrame:
    """Add ``errors``: all error messages of the row, empty if it is valid."""
    checked = find_violations(df, rules, json_col, bool_is_int)
    return checked.withColumn("errors", F.col("violations.message")).drop("violations")


def rule_violations(df: DataFrame, rules: Rules, json_col: str | None = None) -> DataFrame:
    """How many rows break each (feature, rule)."""
    return (
        find_violations(df, rules, json_col)
        .select(F.explode("violations").alias("v"))
        .groupBy("v.feature", "v.rule")
        .agg(F.count(F.lit(1)).alias("violation_count"))
    )


def _meets_contract(i: int, rule: Mapping[str, Any]) -> str:
    """SQL: does the field meet its rule?"""
    kind, number = f"_k{i}", f"_n{i}"
    ok = {
        "number": f"{kind} IN ('int', 'float')",
        "integer": f"({kind} = 'int' OR ({kind} = 'float' AND {number} = floor({number})))",
        "string": f"{kind} = 'str'",
        "boolean": f"{kind} = 'bool'",
        None: "true",
    }[rule.get("type")]
    if rule.get("min_value") is not None:
        ok += f" AND {number} >= {float(rule['min_value'])}D"
    if rule.get("max_value") is not None:
        ok += f" AND {number} <= {float(rule['max_value'])}D"
    if rule.get("allowed_values") is not None:
        ok += f" AND {number} IN ({', '.join(f'{float(a)}D' for a in rule['allowed_values'])})"
    missing = "false" if rule.get("required") else "true"
    return f"(CASE WHEN {kind} IS NULL THEN {missing} ELSE coalesce({ok}, false) END)"


def check_contract(df: DataFrame, json_col: str, contract: Rules) -> DataFrame:
    """Add ``is_valid``: does the whole message meet the contract?

    JSON rules: an integer field takes whole floats, true and false are no numbers, a null value
    fails its type, unknown fields are fine. Text that is no JSON object is not valid, and with no
    contract nothing is.
    """
    if not contract:
        return df.withColumn("is_valid", F.lit(False))
    ok = " AND ".join(["_object", *[_meets_contract(i, r) for i, r in enumerate(contract.values())]])
    fields = _with_json_fields(df, json_col, list(contract), texts=False)
    return fields.select(*df.columns, F.expr(ok).alias("is_valid"))


def quarantine(df: DataFrame, json_col: str, contract: Rules) -> tuple[DataFrame, DataFrame]:
    """Split messages into (valid, rejected)."""
    checked = check_contract(df, json_col, contract)
    return (
        checked.filter("is_valid").drop("is_valid"),
        checked.filter("NOT is_valid").drop("is_valid"),
    )


# --- cleaning -----------------------------------------------------------------------------------


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _clean(df: DataFrame, c: str) -> Column:
    """NaN counts as missing."""
    col = F.col(c).cast("double")
    return F.when(~F.isnan(col), col)


def fit_imputer(df: DataFrame, cols: Sequence[str] | None = None, strategy: str = "mean") -> DataFrame:
    """One row of fill values, one column per name. Save it to reuse it on later tables.

    ``mean``, ``median`` (exact), ``zero``; any other name means the most frequent value, the
    smallest one of a tie.
    """
    cols = list(cols or numeric_columns(df))
    if strategy == "mean":
        return df.agg(*[F.avg(_clean(df, c)).alias(c) for c in cols])
    if strategy == "zero":
        return df.agg(*[F.max(F.lit(0.0)).alias(c) for c in cols])
    if strategy == "median":
        return _one_row(exact_quantiles(df, cols, [0.5]), cols)
    counts = long_features(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(
        F.max_by("value", F.struct(F.col("n"), (-F.col("value")).alias("v"))).alias("value")
    )
    return _one_row(best, cols)


def _one_row(by_feature: DataFrame, cols: Sequence[str]) -> DataFrame:
    return by_feature.agg(
        *[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(c) for c in cols]
    )


def impute(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Fill nulls from the fitted row (a scalar subquery: no join, one row by construction)."""
    fill = stats.select(F.struct(*stats.columns)).scalar()
    return (
        df.withColumn("_fill", fill)
        .withColumns({c: F.coalesce(_clean(df, c), F.col(f"_fill.`{c}`")) for c in stats.columns})
        .drop("_fill")
    )


def null_outliers_iqr(
    df: DataFrame, cols: Sequence[str] | None = None, k: float = 3.0, exact: bool = True
) -> DataFrame:
    """Make values outside ``[q1 - k*iqr, q3 + k*iqr]`` null; no row is dropped.

    Quartiles are exact (counted, not sorted); ``exact=False`` takes sketch
    quantiles in one pass instead.
    """
    cols = list(cols or numeric_columns(df))
    if exact:
        q = exact_quantiles(df, cols, [0.25, 0.75])
        pick = [
            F.max(F.when((F.col("feature") == c) & (F.col("prob") == p), F.col("value"))).alias(
                f"{c}_{name}"
            )
            for c in cols
            for p, name in ((0.25, "q1"), (0.75, "q3"))
        ]
        bounds = q.agg(*pick)
    else:
        both = [F.percentile_approx(_clean(df, c), [0.25, 0.75], 10_000).alias(c) for c in cols]
        bounds = df.agg(*both).select(
            *[F.col(c)[i].alias(f"{c}_{n}") for c in cols for i, n in ((0, "q1"), (1, "q3"))]
        )
    row = bounds.select(F.struct(*bounds.columns)).scalar()
    changed = {}
    for c in cols:
        q1, q3 = F.col(f"_q.`{c}_q1`"), F.col(f"_q.`{c}_q3`")
        reach = F.lit(k) * (q3 - q1)
        changed[c] = F.when(F.col(c).between(q1 - reach, q3 + reach), F.col(c))
    return df.withColumn("_q", row).withColumns(changed).drop("_q")


def cleanse(
    df: DataFrame, cols: Sequence[str] | None = None, strategy: str = "mean", k: float = 3.0
) -> DataFrame:
    """Impute, then null the outliers of the imputed columns."""
    cols = list(cols or numeric_columns(df))
    return null_outliers_iqr(impute(df, fit_imputer(df, cols, strategy)), cols, k)


# --- schema versions ----------------------------------------------------------------------------


def _pair_diff(sides: DataFrame, key: Sequence[str]) -> DataFrame:
    """``sides`` has ``side`` 'old' or 'new' per (feature, property, value). One shuffle: the few
    properties of a feature meet in one map per side."""

    def props(side: str) -> Column:
        entry = F.when(F.col("side") == side, F.struct("property", "value"))
        return F.map_from_entries(F.collect_list(entry))

    both = sides.groupBy(*key).agg(props("old").alias("o"), props("new").alias("n"))
    names = F.array_union(F.map_keys("o"), F.map_keys("n"))
    rows = both.withColumns(
        {
            "old_required": F.coalesce(F.col("o")["required"] == "true", F.lit(False)),
            "new_required": F.coalesce(F.col("n")["required"] == "true", F.lit(False)),
            "change": F.when(F.size("o") == 0, "added")
            .when(F.size("n") == 0, "removed")
            .otherwise("modified"),
            "property": F.explode(names),
        }
    ).withColumns(
        {
            "in_old": F.map_contains_key("o", F.col("property")),
            "in_new": F.map_contains_key("n", F.col("property")),
            "old_value": F.try_element_at("o", F.col("property")),
            "new_value": F.try_element_at("n", F.col("property")),
        }
    )
    modified = F.col("change") == "modified"
    changed = rows.filter(
        ~modified
        | (F.col("in_old") != F.col("in_new"))
        | ~F.col("old_value").eqNullSafe(F.col("new_value"))
    )
    return changed.select(
        *key,
        "change",
        "property",
        F.when(modified & ~F.col("in_old"), "added").otherwise(F.col("old_value")).alias("old_value"),
        F.when(modified & ~F.col("in_new"), "removed").otherwise(F.col("new_value")).alias("new_value"),
        "old_required",
        "new_required",
    )


def schema_diff(registry: DataFrame, old: int, new: int) -> DataFrame:
    """Differences of two versions of a (version, feature, property, value) table.

    One row per property of an added or removed feature and per changed property of a kept one; a
    property new to a kept feature has old value "added", a dropped one new value "removed".
    """
    side = F.when(F.col("version") == old, "old").otherwise("new")
    sides = registry.filter(F.col("version").isin(old, new)).withColumn("side", side)
    return _pair_diff(sides, ["feature"])


def schema_history(registry: DataFrame) -> DataFrame:
    """``schema_diff`` of every version against the one before it, without a self-join: each row
    is "new" in its own version and "old" in the next there is, whatever its number. The list of
    versions is the only thing sorted as a whole."""
    order = W.orderBy("version")
    versions = registry.select("version").distinct().select(
        "version", F.lag("version").over(order).alias("_before"), F.lead("version").over(order).alias("_next")
    )
    roles = F.array(
        F.struct(F.when(F.col("_before").isNotNull(), F.col("version")).alias("to_version"), F.lit("new").alias("side")),
        F.struct(F.col("_next").alias("to_version"), F.lit("old").alias("side")),
    )
    sides = (
        registry.join(versions, "version")
        .select("feature", "property", "value", F.inline(roles))
        .filter(F.col("to_version").isNotNull())
    )
    return _pair_diff(sides, ["to_version", "feature"])


def breaking_changes(diff: DataFrame) -> DataFrame:
    """Changes of a diff that break readers: a required feature removed, or the type changed on a
    feature that was or became required."""
    keys = [c for c in ("to_version", "feature") if c in diff.columns]
    removed = (F.col("change") == "removed") & F.col("old_required") & (F.col("property") == "required")
    retyped = (
        (F.col("change") == "modified")
        & (F.col("property") == "type")
        & (F.col("old_value") != "added")
        & (F.col("new_value") != "removed")
        & (F.col("old_required") | F.col("new_required"))
    )
    # Message texts.
    message = F.when(
        removed, F.concat(F.lit("Removed required feature: '"), F.col("feature"), F.lit("'"))
    ).when(
        retyped,
        F.concat(
            F.lit("Type changed for required/critical feature '"), F.col("feature"),
            F.lit("': from "), F.col("old_value"), F.lit(" to "), F.col("new_value"),
        ),
    )
    return diff.select(*keys, message.alias("message")).filter(F.col("message").isNotNull())


def schema_compat(diff: DataFrame) -> DataFrame:
    """One row: is the change backward compatible, and how many breaking changes are there."""
    return breaking_changes(diff).agg(
        (F.count(F.lit(1)) == 0).alias("is_compatible"),
        F.count(F.lit(1)).alias("breaking_changes"),
    )


def observed_schema_profile(df: DataFrame, json_col: str, ts: str) -> DataFrame:
    """Which fields really arrive, per day: messages, share missing, share null, kinds seen."""

    named = F.transform(
        F.map_entries(F.from_json(json_col, "map<string,variant>")),
        lambda e: F.struct(e["key"].alias("field"), F.schema_of_variant(e["value"]).alias("type")),
    )
    kind = f"nullif({kind_of('e.type')}, 'null')"
    entry = F.expr(f"transform(_named, e -> named_struct('field', e.field, 'kind', {kind}))")
    whole = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("kind")))
    seen = (
        df.select(F.to_date(F.col(ts).cast("timestamp")).alias("day"), named.alias("_named"))
        .select(
            "day",
            F.inline(F.concat(whole, F.coalesce(entry, F.slice(whole, 1, 0)))),
        )
        .groupBy("day", "field")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("kind").alias("n_valued"),
            F.array_sort(F.collect_set("kind")).alias("kinds"),
        )
    )
    messages = F.max(F.when(F.col("field").isNull(), F.col("n"))).over(W.partitionBy("day"))
    return (
        seen.withColumn("messages", messages)
        .filter(F.col("field").isNotNull())
        .select(
            "day",
            "field",
            "messages",
            (1 - F.col("n") / F.col("messages")).alias("missing_rate"),
            (1 - F.col("n_valued") / F.col("n")).alias("null_rate"),
            "kinds",
        )
    )
