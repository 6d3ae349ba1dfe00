"""DuckDB SQL computing every registered query from the same test tables.

This is the independent check of the Spark code: the raw-table derivation,
staging, the SCD2 steps one by one, the velocity as a self join, the marts and
the served queries are written here in plain SQL over the views ``customer
nation events orders lineitem supplier``.

Written for DuckDB's NULL ordering (explicit everywhere) and types: timestamps
without zone, decimal(15,2) money, decimal(18,2) velocity sums, double rates.
"""

from __future__ import annotations

from scorewatch.functions import constants as K
from scorewatch.operators.quality import MODEL_CHECKS, SOURCE_CHECKS
from scorewatch.operators.rules import FLAGS
from scorewatch.plans import catalog

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    _CTES[name] = (deps, sql)


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in order) + "\n"


# --- users: three batches ----------------------------------------------------
_cte("eu", (), """
    SELECT c.c_custkey AS id, c.c_name, n.n_name
    FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""")

_cte("ub", ("eu",), """
    SELECT id, c_name, n_name,
           CAST(300 + (id * 37) % 551 AS INTEGER) AS s1,
           CAST(CASE WHEN id % 3 = 0
                     THEN greatest(300, least(850, 300 + (id * 37) % 551 + id % 121 - 60))
                     ELSE 300 + (id * 37) % 551 END AS INTEGER) AS s2,
           make_timestamp(1701388800000000 + id * 60000000) AS t1,
           CASE WHEN id % 3 = 0 THEN make_timestamp(1704078000000000 + id * 1000000)
                ELSE make_timestamp(1701388800000000 + id * 60000000) END AS t2
    FROM eu""")


def _users_batch(score: str, ts: str) -> str:
    return f"""
    SELECT id,
           CASE WHEN id % 11 = 0 THEN '  ' || c_name || ' ' ELSE c_name END AS nombre,
           {score} AS scoring_crediticio,
           CAST(CASE WHEN {score} >= 700 THEN 200000 + (id * 7919) % 300001
                     WHEN {score} >= 550 THEN 50000 + (id * 7919) % 150000
                     ELSE 1000 + (id * 7919) % 9000 END AS DECIMAL(15,2)) AS limite_credito,
           CASE WHEN id % 41 = 0 THEN 'alto' WHEN {score} >= 700 THEN ' Bajo' WHEN {score} >= 550 THEN 'MEDIO ' ELSE 'alto' END
               AS status_riesgo,
           n_name AS location,
           {ts} AS updated_at
    FROM ub"""


_cte("u1", ("ub",), _users_batch("s1", "t1"))
_cte("u2", ("ub",), _users_batch("s2", "t2"))
_cte("u3", ("u2",), "SELECT * FROM u2 WHERE id % 50 <> 7")
_cte("uall", ("u1", "u2", "u3"),
     "SELECT * FROM u1 UNION ALL SELECT * FROM u2 UNION ALL SELECT * FROM u3")


def _stg_users(src: str) -> str:
    return f"""
    SELECT user_id, nombre, scoring_crediticio, limite_credito, status_riesgo, location, updated_at
    FROM (
        SELECT *, row_number() OVER (
                   PARTITION BY user_id
                   ORDER BY updated_at DESC NULLS FIRST, nombre ASC NULLS LAST,
                            scoring_crediticio ASC NULLS LAST, limite_credito ASC NULLS LAST,
                            status_riesgo ASC NULLS LAST, location ASC NULLS LAST) AS rn
        FROM (SELECT id AS user_id, nullif(trim(nombre), '') AS nombre, scoring_crediticio,
                     CAST(limite_credito AS DECIMAL(15,2)) AS limite_credito,
                     lower(nullif(trim(status_riesgo), '')) AS status_riesgo,
                     nullif(trim(location), '') AS location, updated_at
              FROM {src}) typed
    ) ranked
    WHERE rn = 1"""


for _b in ("1", "2", "3", "all"):
    _cte(f"su{_b}", (f"u{_b}",), _stg_users(f"u{_b}"))

# --- SCD2 snapshot: first run, then one step per batch ----------------------
_USER_COLS = "user_id, nombre, scoring_crediticio, limite_credito, status_riesgo, location, updated_at"
_SCD_ID = "md5(concat_ws('|', CAST({p}user_id AS VARCHAR), strftime({p}updated_at, '%Y-%m-%d %H:%M:%S.%f')))"


def _b_cols(prefix: str) -> str:
    return ", ".join(f"{prefix}{c.strip()}" for c in _USER_COLS.split(","))


_cte("s1", ("su1",), f"""
    SELECT {_USER_COLS}, {_SCD_ID.format(p='')} AS dbt_scd_id, updated_at AS dbt_updated_at,
           updated_at AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
    FROM su1""")


def _snapshot_step(prev: str, batch: str, run_at: str) -> str:
    return f"""
    SELECT * FROM {prev} WHERE dbt_valid_to IS NOT NULL
    UNION ALL
    SELECT {_b_cols('o.')}, o.dbt_scd_id, o.dbt_updated_at, o.dbt_valid_from,
           CASE WHEN b.user_id IS NULL THEN TIMESTAMP '{run_at}'
                WHEN b.updated_at > o.dbt_valid_from THEN b.updated_at END AS dbt_valid_to
    FROM {prev} o LEFT JOIN {batch} b ON b.user_id = o.user_id
    WHERE o.dbt_valid_to IS NULL
    UNION ALL
    SELECT {_b_cols('b.')}, {_SCD_ID.format(p='b.')}, b.updated_at, b.updated_at,
           CAST(NULL AS TIMESTAMP)
    FROM {batch} b
    LEFT JOIN (SELECT user_id, dbt_valid_from FROM {prev} WHERE dbt_valid_to IS NULL) o
           ON o.user_id = b.user_id
    WHERE o.user_id IS NULL OR b.updated_at > o.dbt_valid_from"""


_cte("s2", ("s1", "su2"), _snapshot_step("s1", "su2", "2024-01-01 03:30:00"))
_cte("s3", ("s2", "su3"), _snapshot_step("s2", "su3", "2024-01-01 05:00:00"))

_cte("dim", ("s3",), """
    SELECT user_id, dbt_scd_id AS user_sk, nombre, scoring_crediticio, limite_credito,
           status_riesgo, location, dbt_valid_from AS valid_from, dbt_valid_to,
           dbt_valid_to IS NULL AS is_current
    FROM s3""")

# --- transactions, velocity and facts: time compressed, and as it is ("m") ---
def _transactions(m: str, compression: int) -> None:
    _cte(f"t0{m}", (), f"""
    SELECT e.event_id AS id, e.user_id, e.value * 40 AS amount, e.event_type AS merchant_category,
           CASE WHEN e.event_id % 97 = 0 THEN '  '
                WHEN e.event_id % 10 = 0 THEN nx.n_name
                ELSE nu.n_name END AS location,
           CASE WHEN e.event_id % 89 = 0 THEN NULL
                ELSE (e.event_type = 'error' AND e.event_id % 4 = 0) END AS is_flagged_fraud,
           make_timestamp(1704067200000000 + (epoch_us(e.ts) - 1704067200000000) // {compression}) AS created_at
    FROM events e
    LEFT JOIN customer c ON c.c_custkey = e.user_id
    LEFT JOIN nation nu ON nu.n_nationkey = c.c_nationkey
    LEFT JOIN nation nx ON nx.n_nationkey = (c.c_nationkey + 1) % (SELECT count(*) FROM nation)""")

    _cte(f"tlake{m}", (f"t0{m}",), f"""
    SELECT * FROM t0{m}
    UNION ALL
    SELECT id, user_id, amount + 1, merchant_category, location, is_flagged_fraud,
           created_at + INTERVAL 1 SECOND
    FROM t0{m} WHERE id % 50 = 0""")

    _cte(f"traw{m}", (f"tlake{m}",), f"""
    SELECT id, user_id, CAST(amount AS DECIMAL(15,2)) AS amount, merchant_category, location,
           is_flagged_fraud, created_at
    FROM tlake{m}""")

    _cte(f"stx{m}", (f"traw{m}",), f"""
    SELECT transaction_id, user_id, amount_usd, merchant_category, location, is_flagged_fraud, created_at
    FROM (
        SELECT *, row_number() OVER (
                   PARTITION BY transaction_id
                   ORDER BY created_at ASC NULLS LAST, user_id ASC NULLS LAST,
                            amount_usd ASC NULLS LAST, merchant_category ASC NULLS LAST,
                            location ASC NULLS LAST, is_flagged_fraud ASC NULLS LAST) AS rn
        FROM (SELECT id AS transaction_id, user_id, CAST(amount AS DECIMAL(15,2)) AS amount_usd,
                     nullif(trim(merchant_category), '') AS merchant_category,
                     nullif(trim(location), '') AS location,
                     coalesce(is_flagged_fraud, false) AS is_flagged_fraud, created_at
              FROM traw{m}) typed
    ) ranked
    WHERE rn = 1""")

    # How old each transaction of the same user is at each transaction's time.
    ages = f"""
    FROM stx{m} now LEFT JOIN (
        SELECT user_id, created_at AS at, amount_usd AS paid FROM stx{m}) past
      ON past.user_id = now.user_id AND past.at <= now.created_at AND now.created_at - past.at < to_minutes(60)
    GROUP BY now.user_id, now.transaction_id, now.created_at"""
    young = "past.at IS NOT NULL AND now.created_at - past.at < to_minutes({w})"
    metrics = ", ".join(
        f"CAST(sum(CASE WHEN {young.format(w=w)} THEN 1 ELSE 0 END) AS BIGINT) AS cnt_{w}min, "
        f"CAST(sum(CASE WHEN {young.format(w=w)} THEN paid ELSE 0 END) AS DECIMAL(18,2)) AS sum_{w}min"
        for w in K.VELOCITY_WINDOWS_MIN)
    _cte(f"vel{m}", (f"stx{m}",), f"SELECT now.user_id, now.transaction_id, now.created_at, {metrics} {ages}")

    user_now = "(SELECT * FROM dim WHERE is_current)"
    _cte(f"fct{m}", (f"stx{m}", "dim"), f"""
    SELECT s.transaction_id, s.user_id, s.created_at, s.amount_usd, s.merchant_category,
           s.location, s.is_flagged_fraud, u.user_sk, u.scoring_crediticio, u.status_riesgo
    FROM stx{m} s LEFT JOIN {user_now} u USING (user_id)""")

    _cte(f"fa{m}", (f"stx{m}", f"vel{m}", "dim"), f"""
    SELECT transaction_id, user_id, created_at, amount_usd, merchant_category,
           high = 1 AS alert_high_amount, over_limit = 1 AS alert_limit_exceeded, fast = 1 AS alert_velocity,
           moved = 1 AS alert_location_shift, flagged = 1 AS alert_source_flag,
           high + over_limit + fast + moved + flagged > 0 AS is_fraud_alert
    FROM (
        SELECT s.*,
               CASE WHEN s.amount_usd >= {K.HIGH_AMOUNT_USD} THEN 1 ELSE 0 END AS high,
               CASE WHEN s.amount_usd > u.limite_credito THEN 1 ELSE 0 END AS over_limit,
               CASE WHEN v.cnt_5min >= {K.VELOCITY_MIN_TX_5MIN} THEN 1 ELSE 0 END AS fast,
               CASE WHEN s.location <> u.location THEN 1 ELSE 0 END AS moved,
               CASE WHEN s.is_flagged_fraud THEN 1 ELSE 0 END AS flagged
        FROM stx{m} s
        LEFT JOIN vel{m} v ON v.transaction_id = s.transaction_id
        LEFT JOIN {user_now} u ON u.user_id = s.user_id
    ) points""")


_transactions("", 120)
_transactions("m", 1)

_cte("fct_asof", ("stx", "dim"), """
    SELECT s.transaction_id, s.user_id, s.created_at, s.amount_usd, s.merchant_category,
           s.location, s.is_flagged_fraud, d.user_sk, d.scoring_crediticio, d.status_riesgo
    FROM stx s LEFT JOIN dim d
      ON d.user_id = s.user_id AND d.valid_from <= s.created_at AND coalesce(s.created_at < d.dbt_valid_to, true)""")

# --- cards ----------------------------------------------------------------------
_cte("feed", ("eu",), """
    SELECT c_custkey AS card_id, c_custkey % (SELECT count(*) FROM eu) AS user_id,
           '4' || lpad(CAST((c_custkey * 7919) % 10000 AS VARCHAR), 4, '0') || ' 1234 5678 '
               || CAST(1000 + c_custkey % 9000 AS VARCHAR) AS pan,
           CAST(100 + c_custkey % 900 AS VARCHAR) AS cvv,
           lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') || '/' || CAST(26 + c_custkey % 6 AS VARCHAR)
               AS exp_date,
           CASE c_custkey % 4 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' WHEN 2 THEN 'amex'
                ELSE ' ' END AS card_type,
           CASE c_custkey % 5 WHEN 0 THEN 'JUAN P.' WHEN 1 THEN 'MARIA G.' WHEN 2 THEN '  ANA   M. '
                WHEN 3 THEN 'SOFIA' ELSE '' END AS cardholder
    FROM customer""")

_cte("feed_t", ("feed",), """
    SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at FROM feed
    UNION ALL
    SELECT *, TIMESTAMP '2024-01-01 00:05:00' FROM feed WHERE card_id % 4 = 0""")

_cte("craw", ("feed_t",), """
    SELECT card_id, user_id,
           '**** **** **** ' || right(regexp_replace(coalesce(pan, ''), '[^0-9]', '', 'g'), 4)
               AS pan_last_masked,
           card_type,
           CASE WHEN w[1] = '' THEN ''
                ELSE substr(w[1], 1, 2) || '** ' || substr(w[len(w)], 1, 1) || '.' END
               AS cardholder_masked,
           exp_date, ingested_at
    FROM (SELECT *, string_split(trim(regexp_replace(coalesce(cardholder, ''), '\\s+', ' ', 'g')), ' ') AS w
          FROM feed_t) split""")

_cte("scard", ("craw",), """
    SELECT card_id, user_id, pan_last_masked, card_type, cardholder_masked, exp_date, ingested_at
    FROM (
        SELECT *, row_number() OVER (
                   PARTITION BY card_id
                   ORDER BY ingested_at DESC NULLS FIRST, user_id ASC NULLS LAST,
                            pan_last_masked ASC NULLS LAST, card_type ASC NULLS LAST,
                            cardholder_masked ASC NULLS LAST, exp_date ASC NULLS LAST) AS rn
        FROM (SELECT card_id, user_id, pan_last_masked, nullif(trim(card_type), '') AS card_type,
                     cardholder_masked, nullif(trim(exp_date), '') AS exp_date, ingested_at
              FROM craw) typed
    ) ranked
    WHERE rn = 1""")

# --- card movements ----------------------------------------------------------
_cte("mv", (), """
    SELECT o.o_custkey AS card_id, l.l_shipdate AS date,
           CAST(l.l_extendedprice AS DECIMAL(15,2)) AS amount,
           CASE WHEN l.l_linenumber = 7 THEN ' ' ELSE l.l_returnflag END AS merchant_category,
           n.n_name AS location, strftime(l.l_shipdate, '%Y-%m-%d') AS source_date
    FROM lineitem l
    LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
    LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
    LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey""")

_cte("mvraw", ("mv",), """
    SELECT row_number() OVER (ORDER BY source_date ASC NULLS LAST, card_id ASC NULLS LAST,
                                       date ASC NULLS LAST, amount ASC NULLS LAST,
                                       merchant_category ASC NULLS LAST, location ASC NULLS LAST) AS id,
           card_id, date, amount, merchant_category, location, source_date,
           CAST(NULL AS VARCHAR) AS sourced_from
    FROM mv""")

_cte("smv", ("mvraw",), """
    SELECT id AS source_id, card_id, CAST(date AS TIMESTAMP) AS movement_date,
           CAST(amount AS DECIMAL(15,2)) AS amount_usd,
           nullif(trim(merchant_category), '') AS merchant_category,
           nullif(trim(location), '') AS location, source_date
    FROM mvraw""")

# --- served queries ----------------------------------------------------------
_ALERT_LIST = ("transaction_id, user_id, created_at, amount_usd, merchant_category, alert_high_amount, "
               "alert_limit_exceeded, alert_velocity, alert_location_shift, alert_source_flag, is_fraud_alert")
_FEED = ("created_at, user_id, amount_usd, merchant_category, alert_high_amount, alert_limit_exceeded, "
         "alert_velocity, alert_location_shift, alert_source_flag")
_HISTORY = ("user_id, nombre, scoring_crediticio, status_riesgo, limite_credito, location, valid_from, "
            "dbt_valid_to, is_current")


def _rate_sql(unit: str, name: str, src: str = "fa", where: str = "", tail: str = "") -> str:
    return f"""
    SELECT {name}, tx_total, tx_con_alertas, CAST(round(100.0 * tx_con_alertas / tx_total, 2) AS DOUBLE) AS pct_fraude
    FROM (SELECT date_trunc('{unit}', created_at) AS {name}, CAST(sum(1) AS BIGINT) AS tx_total,
                 CAST(sum(CASE WHEN is_fraud_alert THEN 1 ELSE 0 END) AS BIGINT) AS tx_con_alertas
          FROM {src} {where} GROUP BY ALL) counted
    ORDER BY {name} DESC NULLS FIRST {tail}"""


def _rules_sql() -> str:
    from scorewatch.operators.rules import FLAGS
    names = ", ".join(f"{flag} AS '{label}'" for label, flag in zip(K.RULE_LABELS, FLAGS))
    sums = ", ".join(f"coalesce(sum(CASE WHEN {flag} THEN 1 ELSE 0 END), 0)::BIGINT AS {flag}" for flag in FLAGS)
    return f"""
    SELECT regla, alertas
    FROM (UNPIVOT (SELECT {sums} FROM fa WHERE is_fraud_alert) ON {names} INTO NAME regla VALUE alertas) long
    ORDER BY alertas DESC, regla"""


def _literal(v) -> str:
    return "NULL" if v is None else repr(v)


def _soiled_sql(model: str) -> str:
    """The model with repeated rows and with broken copies."""
    src = _MODEL_CTE[model]
    key, changes = catalog.SOILED[model]
    parts = [f"SELECT * FROM {src}", f"SELECT * FROM {src} WHERE {key} % {catalog.REPEAT_EVERY} = 0"]
    parts += [f"SELECT * REPLACE ({', '.join(f'{_literal(v)} AS {c}' for c, v in columns.items())}) FROM {src} WHERE {key} % {every} = 0"
              for every, columns in changes]
    return "(" + " UNION ALL ".join(parts) + ") soiled"


def _dq_soiled_sql(test: str) -> str:
    checks = [c for c in (*MODEL_CHECKS, catalog.STATUS_CHECK) if c.test == test]
    return (_with(*sorted({_MODEL_CTE[c.model] for c in checks}))
            + "\nUNION ALL\n".join(_check_sql(c, _soiled_sql(c.model)) for c in checks))


def _check_sql(ch, src: str) -> str:
    head = f"SELECT '{ch.model}' AS model, '{ch.column}' AS column_name, '{ch.test}' AS test, "
    c = ch.column
    if ch.test == "unique":
        return (head + f"count(*) AS failures FROM (SELECT {c} FROM {src} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1) d")
    if ch.test == "not_null":
        bad = f"{c} IS NULL"
    elif ch.test == "between":
        conds = []
        if ch.min_value is not None:
            conds.append(f"{c} < {ch.min_value}")
        if ch.max_value is not None:
            conds.append(f"{c} > {ch.max_value}")
        bad = f"{c} IS NOT NULL AND ({' OR '.join(conds)})"
    else:
        vals = ", ".join(str(v).lower() if isinstance(v, bool) else repr(v) for v in ch.values)
        bad = f"{c} IS NOT NULL AND {c} NOT IN ({vals})"
    return head + f"CAST(count(*) FILTER (WHERE {bad}) AS BIGINT) AS failures FROM {src}"


_MODEL_CTE = {"stg_transactions": "stx", "stg_users": "suall", "stg_cards": "scard",
              "stg_card_movements": "smv", "int_user_transaction_velocity": "vel", "dim_users": "dim",
              "fct_transactions": "fct", "fct_fraud_alerts": "fa",
              "raw_users": "uall", "raw_transactions": "traw"}


def _dq_sql(checks=MODEL_CHECKS) -> str:
    srcs = sorted({_MODEL_CTE[c.model] for c in checks})
    return _with(*srcs) + "\nUNION ALL\n".join(_check_sql(c, _MODEL_CTE[c.model]) for c in checks)


_AS_OF = catalog.AS_OF

ORACLE_SQL: dict[str, str] = {
    "fct_fraud_alerts": _with("fa") + "SELECT * FROM fa",
    "fct_transactions": _with("fct") + "SELECT * FROM fct",
    "fct_transactions_asof": _with("fct_asof") + "SELECT * FROM fct_asof",
    "fct_transactions_asof_carry": _with("fct_asof") + "SELECT * FROM fct_asof",
    "dim_users": _with("dim") + "SELECT * FROM dim",
    "user_transaction_velocity": _with("vel") + "SELECT * FROM vel",
    "velocity_probe": _with("vel") + "SELECT * FROM vel",
    "velocity_instants": _with("vel") + "SELECT * FROM vel",
    "velocity_count": _with("vel") + "SELECT transaction_id, cnt_5min FROM vel",
    "velocity_sum": _with("vel") + "SELECT transaction_id, sum_60min FROM vel",
    "stg_transactions": _with("stx") + "SELECT * FROM stx",
    "stg_users": _with("suall") + "SELECT * FROM suall",
    "stg_cards": _with("scard") + "SELECT * FROM scard",
    "stg_card_movements": _with("smv") + "SELECT * FROM smv",
    "dedup_earliest": _with("traw") + """
    SELECT id, user_id, amount, merchant_category, location, is_flagged_fraud, created_at
    FROM (SELECT *, row_number() OVER (
                     PARTITION BY id
                     ORDER BY created_at ASC NULLS LAST, user_id ASC NULLS LAST, amount ASC NULLS LAST,
                              merchant_category ASC NULLS LAST, location ASC NULLS LAST,
                              is_flagged_fraud ASC NULLS LAST) AS rn
          FROM traw) r
    WHERE rn = 1""",
    "dedup_latest": _with("craw") + """
    SELECT card_id, user_id, pan_last_masked, card_type, cardholder_masked, exp_date, ingested_at
    FROM (SELECT *, row_number() OVER (
                     PARTITION BY card_id
                     ORDER BY ingested_at DESC NULLS FIRST, user_id ASC NULLS LAST,
                              pan_last_masked ASC NULLS LAST, card_type ASC NULLS LAST,
                              cardholder_masked ASC NULLS LAST, exp_date ASC NULLS LAST) AS rn
          FROM craw) r
    WHERE rn = 1""",
    "movement_surrogate_id": _with("mvraw") + "SELECT * FROM mvraw",
    "anonymize_cards": _with("craw") + "SELECT * FROM craw",
    "explode_card_pages": _with("feed_t") + "SELECT * EXCLUDE (ingested_at) FROM feed_t",
    "card_stamp": _with("craw") + f"SELECT * REPLACE (TIMESTAMP '{catalog.CARD_STAMP}' AS ingested_at) FROM craw",
    "encode_card_events": _with("craw") + """
    SELECT CAST(card_id AS VARCHAR) AS key,
           '{"card_id":' || card_id || ',"user_id":' || user_id || ',"pan_last_masked":"' || pan_last_masked
           || '","card_type":"' || card_type || '","cardholder_masked":"' || cardholder_masked || '","exp_date":"' || exp_date
           || '","ingested_at":"' || strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS value
    FROM craw""",
    "cdc_unwrap": _with("tlake") + """
    SELECT id, user_id, CAST(CAST(amount AS DECIMAL(15,2)) AS DOUBLE) AS amount, merchant_category,
           location, coalesce(is_flagged_fraud, false) AS is_flagged_fraud, created_at
    FROM tlake WHERE id % 59 <> 0""",
    "lake_partition_parts": _with("tlake") + """
    SELECT id, user_id, CAST(CAST(amount AS DECIMAL(15,2)) AS DOUBLE) AS amount, merchant_category,
           location, coalesce(is_flagged_fraud, false) AS is_flagged_fraud, created_at,
           strftime(created_at, '%Y') AS year, strftime(created_at, '%m') AS month, strftime(created_at, '%d') AS day
    FROM tlake""",
    "raw_load_typed": _with("traw") + f"""
    SELECT * REPLACE (CASE WHEN id % {catalog.NONE_EVERY} <> 0 THEN location END AS location) FROM traw""",
    "decode_transactions": _with("tlake") + f"""
    SELECT id, user_id, CAST(CAST(amount AS DECIMAL(15,2)) AS DOUBLE) AS amount, merchant_category,
           location, coalesce(is_flagged_fraud, false) AS is_flagged_fraud, created_at
    FROM tlake WHERE id % {catalog.CORRUPT_EVERY} <> 0""",
    "decode_users": _with("uall") + """
    SELECT CAST(id AS BIGINT) AS id, nombre, CAST(scoring_crediticio AS BIGINT) AS scoring_crediticio,
           CASE WHEN id % 3 <> 0 THEN CAST(limite_credito AS DOUBLE) END AS limite_credito, status_riesgo, location, updated_at
    FROM uall""",
    "decode_cards": _with("craw") + "SELECT * FROM craw",
    "scd2_initial": _with("s1") + "SELECT * FROM s1",
    "scd2_snapshot": _with("s3") + "SELECT * FROM s3",
    "scd2_hard_delete": _with("s3") + """
    SELECT * FROM s3
    WHERE user_id NOT IN (SELECT user_id FROM s3 WHERE dbt_valid_to IS NULL)""",
    "rule_high_amount": _with("fa") + "SELECT transaction_id, alert_high_amount FROM fa",
    "rule_limit_exceeded": _with("fa") + "SELECT transaction_id, alert_limit_exceeded FROM fa",
    "rule_velocity": _with("fa") + "SELECT transaction_id, alert_velocity FROM fa",
    "rule_location_shift": _with("fa") + "SELECT transaction_id, alert_location_shift FROM fa",
    "rule_source_flag": _with("fa") + "SELECT transaction_id, alert_source_flag FROM fa",
    "risk_band_check": _with("dim") + f"""
    SELECT user_id, valid_from, scoring_crediticio, status_riesgo, expected_status
    FROM (SELECT *, CASE WHEN scoring_crediticio >= {K.RISK_BAND_BAJO_MIN} THEN 'bajo'
                         WHEN scoring_crediticio >= {K.RISK_BAND_MEDIO_MIN} THEN 'medio'
                         WHEN scoring_crediticio IS NOT NULL THEN 'alto' END AS expected_status
          FROM dim) d
    WHERE status_riesgo IS DISTINCT FROM expected_status""",
    "credit_score_history": _with("dim") + f"SELECT {_HISTORY} FROM dim ORDER BY user_id, valid_from",
    "credit_score_current": _with("dim") + f"SELECT {_HISTORY} FROM dim WHERE is_current",
    "credit_score_user": _with("dim") + f"""
    SELECT {_HISTORY} FROM dim WHERE user_id = {catalog.HISTORY_USER} ORDER BY valid_from""",
    "credit_score_current_user": _with("dim") + f"""
    SELECT {_HISTORY} FROM dim WHERE user_id = {catalog.ALERT_USER} AND is_current LIMIT 1""",
    "fraud_alerts_active": _with("fa") + f"""
    SELECT {_ALERT_LIST} FROM fa WHERE is_fraud_alert
    ORDER BY created_at DESC NULLS FIRST, transaction_id DESC LIMIT {K.ALERTS_LIMIT_DEFAULT}""",
    "fraud_alerts_user": _with("fa") + f"""
    SELECT {_ALERT_LIST} FROM fa WHERE is_fraud_alert AND user_id = {catalog.ALERT_USER}
    ORDER BY created_at DESC NULLS FIRST, transaction_id DESC LIMIT {K.ALERTS_LIMIT_MAX}""",
    "fraud_summary_hourly": _with("fa") + _rate_sql(
        "hour", "hora",
        where=f"WHERE created_at >= TIMESTAMP '{_AS_OF}' - INTERVAL {catalog.SUMMARY_HOURS} HOUR"),
    "fraud_summary_24h": _with("fam") + _rate_sql(
        "hour", "hora", "fam",
        where=f"WHERE created_at >= TIMESTAMP '{catalog.AS_OF_MONTH}' - INTERVAL {K.SUMMARY_HOURS_DEFAULT} HOUR"),
    "alerts_hourly": _with("fam") + """
    SELECT date_trunc('hour', created_at) AS hora, count(*) AS tx_total, count(*) FILTER (is_fraud_alert) AS tx_con_alertas,
           """ + ", ".join(f"count(*) FILTER (is_fraud_alert AND {f}) AS n_{f}" for f in FLAGS) + """,
           date_trunc('hour', created_at)::DATE AS event_date
    FROM fam GROUP BY ALL""",
    "fraud_pct_by_hour": _with("fam") + _rate_sql("hour", "hora", "fam", tail=f"LIMIT {K.HOURLY_PANEL_LIMIT}"),
    "fraud_pct_by_day": _with("fam") + _rate_sql("day", "dia", "fam"),
    "score_distribution": _with("dim") + f"""
    SELECT status_riesgo,
           CASE WHEN scoring_crediticio < {K.SCORE_MIN} THEN 0
                WHEN scoring_crediticio >= {K.SCORE_MAX} THEN {K.SCORE_BUCKETS + 1}
                ELSE CAST(floor((scoring_crediticio - {K.SCORE_MIN}) * {K.SCORE_BUCKETS}
                                / {float(K.SCORE_MAX - K.SCORE_MIN)}) AS BIGINT) + 1 END AS bucket,
           min(scoring_crediticio) AS min_score, max(scoring_crediticio) AS max_score,
           count(*) AS usuarios
    FROM dim WHERE is_current
    GROUP BY 1, 2 ORDER BY 1, 2""",
    "alert_feed": _with("fa") + f"""
    SELECT {_FEED} FROM fa WHERE is_fraud_alert
    ORDER BY created_at DESC NULLS FIRST, transaction_id DESC LIMIT {K.FEED_LIMIT}""",
    "alert_radar_5min": _with("fa") + f"""
    SELECT {_FEED} FROM fa
    WHERE is_fraud_alert
      AND created_at >= TIMESTAMP '{_AS_OF}' - INTERVAL {catalog.RADAR_MINUTES} MINUTE
    ORDER BY created_at DESC NULLS FIRST, transaction_id DESC LIMIT {K.FEED_LIMIT}""",
    "alerts_by_rule": _with("fa") + _rules_sql(),
    "dq_report": _dq_sql(),
    "dq_not_null": _dq_soiled_sql("not_null"),
    "dq_unique": _dq_soiled_sql("unique"),
    "dq_between": _dq_soiled_sql("between"),
    "dq_accepted_values": _dq_soiled_sql("accepted_values"),
    "dq_source": _dq_sql(checks=SOURCE_CHECKS),
    "dq_no_pii": _with("craw") + "\nUNION ALL\n".join(
        f"SELECT 'cards' AS model, '{c}' AS column_name, 'no_long_digit_run' AS test, "
        f"count(*) FILTER (WHERE regexp_matches({c}, '[0-9]{{5,}}')) AS failures FROM craw"
        for c in ("pan_last_masked", "card_type", "cardholder_masked", "exp_date")),
    "dq_pii_raw_feed": _with("feed_t") + "\nUNION ALL\n".join(
        [f"SELECT 'card_feed' AS model, '{c}' AS column_name, 'no_long_digit_run' AS test, "
         f"CAST(coalesce(sum(CASE WHEN regexp_matches({c}, '[0-9]{{5,}}') THEN 1 ELSE 0 END), 0) AS BIGINT) AS failures FROM feed_t"
         for c in ("pan", "cvv", "exp_date", "card_type", "cardholder")]
        + [f"SELECT 'card_feed', '{c}', 'forbidden_column', 1" for c in ("pan", "cvv")]),
    "dq_relationship": _with("stx", "su3") + """
    SELECT 'stg_transactions' AS model, 'user_id' AS column_name, 'relationships' AS test, count(*) AS failures
    FROM stx LEFT JOIN su3 USING (user_id)
    WHERE stx.user_id IS NOT NULL AND su3.nombre IS NULL AND user_id NOT IN (SELECT user_id FROM su3)""",
}
