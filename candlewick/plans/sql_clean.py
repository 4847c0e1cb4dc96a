"""DuckDB oracle fragments for text rendering, defect injection, cleaning and
sampling. Built from the same fixed values as the Spark operators."""

from __future__ import annotations

from candlewick.functions.exprs import NUMERIC_PATTERN, TIMESTAMP_PATTERN
from candlewick.schema import (
    BAD_TIME_WORDS,
    CANDLE_COLUMNS,
    INJECT_NUMERIC_COLUMNS,
    INJECT_SIZES,
    NUMERIC_COLUMNS,
    NUMERIC_TEXT_WORDS,
    TIME_COLUMNS,
    VOLUME_COLUMNS,
)

TEXT_COLS = ", ".join(f'"{c}"' if c == "interval" else c for c in CANDLE_COLUMNS)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def qi(c: str) -> str:
    """A column name, quoted where SQL reserves it."""
    return f'"{c}"' if c == "interval" else c


def iso(c: str) -> str:
    return (
        f"(CASE WHEN date_trunc('second', {c}) = {c} THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00')"
    )


def num_text(c: str) -> str:
    return f"CAST(TRY_CAST({c} AS DECIMAL(38,8)) AS VARCHAR)"


def text_of(src: str) -> str:
    cols = []
    for c in CANDLE_COLUMNS:
        if c in TIME_COLUMNS:
            cols.append(f"{iso(c)} AS {c}")
        elif c == "trade_count":
            cols.append(f"CAST(trade_count AS VARCHAR) AS trade_count")
        elif c == "interval":
            cols.append('"interval"')
        elif c == "symbol":
            cols.append("symbol")
        else:
            cols.append(f"{num_text(c)} AS {c}")
    return f"SELECT {', '.join(cols)} FROM {src}"


def with_uid(src: str) -> str:
    return (
        f"SELECT *, coalesce(symbol, '\\N') || '|' || coalesce(\"interval\", '\\N') || '|' "
        f"|| coalesce(open_time, '\\N') AS _uid FROM {src}"
    )


def h(seed, tag: str, uid: str = "_uid") -> str:
    return f"md5({q(f'{seed}|{tag}|')} || {uid})"


def hint(seed, tag: str, uid: str = "_uid") -> str:
    return f"CAST(('0x' || substr({h(seed, tag, uid)}, 1, 8)) AS BIGINT)"


def choice(seed, tag: str, options: list[str]) -> str:
    """options are SQL expressions."""
    return f"[{', '.join(options)}][({hint(seed, tag)} % {len(options)}) + 1]"


def pick(seed, step: str, cap_offset: int = 0, ties: str = "") -> str:
    """``ties``: further order columns (", a, b") where identities repeat."""
    fraction, minimum = INJECT_SIZES[step]
    k = (
        f"least(greatest({minimum}, floor(count(*) OVER () * CAST({fraction} AS DOUBLE))), "
        f"count(*) OVER () - {cap_offset})"
    )
    return f"(row_number() OVER (ORDER BY {h(seed, step)}{ties}) <= {k})"


def drop_ctes(src: str, seed: int = 42, name: str = "i_drop", ties: str = "") -> list[tuple[str, str]]:
    return [
        (f"{name}_p", f"SELECT *, {pick(seed, 'drop', 1, ties)} AS _p FROM {src}"),
        (name, f"SELECT * EXCLUDE (_p) FROM {name}_p WHERE NOT _p"),
    ]


def dup_ctes(src: str, seed: int = 42, name: str = "i_dup", ties: str = "") -> list[tuple[str, str]]:
    return [
        (f"{name}_p", f"SELECT *, {pick(seed, 'duplicate', 0, ties)} AS _p FROM {src}"),
        (
            name,
            f"SELECT * EXCLUDE (_p) FROM {name}_p UNION ALL "
            f"SELECT * EXCLUDE (_p) REPLACE (_uid || '#dup' AS _uid) FROM {name}_p WHERE _p",
        ),
    ]


VALUE_STEPS = ("missing", "text", "bad_time", "symbol", "negative")


def _set_one(src: str, step: str, cols: list[str], value: str, seed: int) -> str:
    chosen = choice(seed, f"{step}:col", [q(c) for c in cols])
    reps = ", ".join(
        f"CASE WHEN _pick_{step} AND {chosen} = {q(c)} THEN {value} ELSE {c} END AS {c}" for c in cols
    )
    return f"SELECT * REPLACE ({reps}) FROM {src}"


def value_ctes(
    src: str, steps=VALUE_STEPS, seed: int = 42, symbols=None, name: str = "i_val", present=CANDLE_COLUMNS, ties: str = ""
) -> list[tuple[str, str]]:
    picks = ", ".join(
        f"{pick(seed, s, 0, ties) if s in steps else 'false'} AS _pick_{s}" for s in VALUE_STEPS
    )
    ctes = [(f"{name}_p", f"SELECT *, {picks} FROM {src}")]
    cur = f"{name}_p"
    miss_cols = [c for c in list(INJECT_NUMERIC_COLUMNS) + list(TIME_COLUMNS) if c in present]
    num_cols = [c for c in INJECT_NUMERIC_COLUMNS if c in present]
    time_cols = [c for c in TIME_COLUMNS if c in present]
    vol_cols = [c for c in VOLUME_COLUMNS if c in present]
    ctes.append((f"{name}_1", _set_one(cur, "missing", miss_cols, "NULL", seed)))
    word = choice(seed, "text:word", [q(w) for w in NUMERIC_TEXT_WORDS])
    ctes.append((f"{name}_2", _set_one(f"{name}_1", "text", num_cols, word, seed)))
    tword = choice(seed, "bad_time:word", [q(w) for w in BAD_TIME_WORDS])
    ctes.append((f"{name}_3", _set_one(f"{name}_2", "bad_time", time_cols, tword, seed)))
    key = "replace(upper(trim(symbol)), '/', '')"
    known = f"length({key}) > 0" if symbols is None else f"{key} IN ({', '.join(q(s) for s in symbols)})"
    variant = choice(
        seed, "symbol:variant", [f"lower({key})", f"' ' || {key} || ' '", f"replace({key}, 'USDT', '/USDT')"]
    )
    ctes.append(
        (
            f"{name}_4",
            f"SELECT * REPLACE (CASE WHEN _hit_symbol THEN {variant} ELSE symbol END AS symbol) FROM "
            f"(SELECT *, _pick_symbol AND coalesce({known}, false) AS _hit_symbol FROM {name}_3) s",
        )
    )
    chosen = choice(seed, "negative:col", [q(c) for c in vol_cols])
    reps = ", ".join(
        f"CASE WHEN _pick_negative AND {chosen} = {q(c)} THEN "
        f"(CASE WHEN coalesce(regexp_matches({c}, {q(NUMERIC_PATTERN)}), false) "
        f"THEN '-' || regexp_replace(trim({c}), '^[+-]', '') ELSE '-999' END) ELSE {c} END AS {c}"
        for c in vol_cols
    )
    ctes.append((name, f"SELECT * REPLACE ({reps}) FROM {name}_4"))
    return ctes


def messy_ctes(candles_src: str, seed: int = 42, symbols=None) -> list[tuple[str, str]]:
    """candles -> text -> uid -> drop -> duplicate -> value steps -> ``messy``."""
    return (
        [("m_text", text_of(candles_src)), ("m_uid", with_uid("m_text"))]
        + drop_ctes("m_uid", seed)
        + dup_ctes("i_drop", seed)
        + value_ctes("i_dup", VALUE_STEPS, seed, symbols)
        + [("messy", f"SELECT {TEXT_COLS} FROM i_val")]
    )


def safe_double(c: str) -> str:
    return f"(CASE WHEN regexp_matches({c}, {q(NUMERIC_PATTERN)}) THEN TRY_CAST(trim({c}) AS DOUBLE) END)"


def safe_ts(c: str) -> str:
    return (
        f"(CASE WHEN regexp_matches({c}, {q(TIMESTAMP_PATTERN)}) "
        f"THEN (TRY_CAST({c} AS TIMESTAMPTZ) AT TIME ZONE 'UTC') END)"
    )


def clean_symbol(c: str) -> str:
    return f"upper(regexp_replace({c}, '[^A-Za-z0-9]', '', 'g'))"


def typed_of(src: str) -> str:
    cols = []
    for c in CANDLE_COLUMNS:
        if c == "symbol":
            cols.append(f"{clean_symbol('symbol')} AS symbol")
        elif c == "interval":
            cols.append('"interval"')
        elif c in TIME_COLUMNS:
            cols.append(f"{safe_ts(c)} AS {c}")
        elif c in NUMERIC_COLUMNS:
            cols.append(f"{safe_double(c)} AS {c}")
    cols += [f"{c} AS {c}__orig" for c in TIME_COLUMNS]
    return f"SELECT {', '.join(cols)} FROM {src}"


RULES = {
    "negative_volume": "coalesce(volume < 0, false)",
    "negative_trade_count": "coalesce(trade_count < 0, false)",
    "high_lt_low": "coalesce(high < low, false)",
}
STRICT_RULES = {
    **RULES,
    "negative_quote_volume": "coalesce(quote_volume < 0, false)",
    "missing_required": "(symbol IS NULL OR open_time IS NULL OR open IS NULL OR high IS NULL "
    "OR low IS NULL OR close IS NULL OR volume IS NULL)",
}


def any_rule(strict: bool = False) -> str:
    return "(" + " OR ".join((STRICT_RULES if strict else RULES).values()) + ")"


def features_of(src: str) -> str:
    return f"""SELECT *,
       high - low AS price_range,
       close - open AS price_change,
       (close - open) / nullif(open, 0) * 100.0 AS percent_change,
       CASE WHEN close > open THEN 'up' WHEN close < open THEN 'down'
            WHEN close = open THEN 'flat' END AS candle_direction
FROM {src}"""


def clean_ctes(messy_src: str = "messy", strict: bool = False) -> list[tuple[str, str]]:
    return [
        ("c_typed", typed_of(messy_src)),
        ("c_dedup", "SELECT DISTINCT * FROM c_typed"),
        ("c_kept", f"SELECT * FROM c_dedup WHERE NOT {any_rule(strict)}"),
        ("cleaned", features_of("c_kept")),
    ]


def content_uid(cols_types: list[tuple[str, str]]) -> str:
    parts = []
    for c, t in cols_types:
        if t == "num":
            parts.append(f"coalesce({num_text(c)}, '\\N')")
        else:
            parts.append(f"coalesce(CAST({c} AS VARCHAR), '\\N')")
    return " || '|' || ".join(parts)


CLEANED_UID_COLS = [
    ("symbol", "str"),
    ("\"interval\"", "str"),
    ("open_time__orig", "str"),
    ("open", "num"),
    ("high", "num"),
    ("low", "num"),
    ("close", "num"),
    ("volume", "num"),
    ("close_time__orig", "str"),
    ("quote_volume", "num"),
    ("trade_count", "num"),
]


def sample_ctes(src: str = "cleaned", n: int = 5, seed: int = 1) -> list[tuple[str, str]]:
    uid = content_uid(CLEANED_UID_COLS)
    return [
        (
            "sample",
            f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "
            f"md5({q(f'{seed}|sample|')} || {uid})) AS _rn FROM {src} WHERE symbol IS NOT NULL) s "
            f"WHERE _rn <= {n}",
        )
    ]
