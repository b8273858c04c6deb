"""DuckDB SQL that states the same results independently, from the raw test tables.

Each statement starts from ``lineitem``/``orders``/``customer`` or ``events``
and derives bronze, silver and gold in common table expressions of its own.
"""

from __future__ import annotations

from txlake.plans.fixtures import (
    EV_CHANNELS,
    EV_COUNTRIES,
    EV_CURRENCIES,
    TX_CATEGORIES,
    TX_CHANNELS,
    TX_COUNTRIES,
    TX_CURRENCIES,
)


# --- fixed values: the contract's own lists, stated here again on purpose: a statement that
# took them from the package would agree with it whatever they are.
CURRENCIES = ("CNY", "CZK", "EUR", "GBP", "PLN", "UAH", "USD")
COUNTRIES = ("PL", "DE", "FR", "ES", "IT", "NL", "SK", "GB", "US", "CZ", "UA", "CN")
CHANNELS = ("ONLINE", "POS", "ATM", "MOBILE")
MERCHANT_CATEGORIES = (
    "grocery", "restaurant", "travel", "electronics", "fashion", "fuel", "entertainment", "health",
    "utilities", "cash_withdrawal", "online_services", "gambling",
)
FX_RATES_TO_PLN = {"PLN": "1.00", "EUR": "4.30", "USD": "3.95", "GBP": "5.05", "CZK": "0.17", "UAH": "0.10", "CNY": "0.55"}
HIGH_RISK_CATEGORIES = ("cash_withdrawal", "gambling", "electronics", "online_services", "travel")
HEURISTIC_INTERCEPT = -4.2
HEURISTIC_WEIGHTS = {
    "log_amount_pln": 0.25, "is_night": 0.4, "is_online": 1.0, "is_atm": 0.5, "is_high_risk_category": 1.3, "is_foreign": 0.9,
}
QUALITY_CHECKS = (
    "no_null_transaction_id", "no_null_account_id", "no_null_amount", "no_null_amount_pln", "transaction_id_unique",
    "amount_within_bounds",
)


def _words(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _pick(words, index: str) -> str:
    return f"([{_words(words)}])[CAST({index} AS INTEGER) + 1]"


# --- transactions from line items -------------------------------------------- #

_RISKY = "(l_partkey % 12 IN (2, 3, 9, 10, 11))"
_ONLINE = "(l_linenumber % 4 = 0)"

TX = f"""
tx AS (
  SELECT
    CASE WHEN l_partkey % 127 = 0 THEN '' ELSE 'T' || l_orderkey || '-' || l_linenumber END
      AS transaction_id,
    CASE WHEN l_partkey % 83 = 0 THEN 'not-a-date'
         ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T'
              || lpad(CAST((l_partkey * 7 + l_linenumber) % 24 AS VARCHAR), 2, '0') || ':'
              || lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0') || ':00'
              || CASE WHEN l_linenumber = 7 THEN '-04:00' ELSE '+00:00' END END AS sent_at,
    CASE WHEN l_partkey % 101 = 0 THEN '  ' ELSE 'ACC-' || o_custkey END AS account_id,
    CAST(l_extendedprice AS DECIMAL(18,2))
      * CASE WHEN l_partkey % 97 = 0 THEN -1 WHEN l_partkey % 131 = 0 THEN 100 ELSE 1 END AS amount,
    CASE WHEN l_partkey % 89 = 0 THEN 'xxx' ELSE {_pick(TX_CURRENCIES, 'l_suppkey % 7')} END
      AS currency,
    CASE WHEN l_partkey % 109 = 0 THEN 'smuggling' ELSE {_pick(TX_CATEGORIES, 'l_partkey % 12')} END
      AS merchant_category,
    CASE WHEN l_partkey % 103 = 0 THEN 'ZZ'
         ELSE {_pick(TX_COUNTRIES,
                     '(c_nationkey + CASE WHEN l_partkey % 10 = 0 THEN l_suppkey ELSE 0 END) % 13')}
         END AS country,
    CASE WHEN l_partkey % 107 = 0 THEN 'FAX' ELSE {_pick(TX_CHANNELS, 'l_linenumber % 4')} END
      AS channel,
    CASE WHEN l_suppkey % 53 = 0 THEN NULL ELSE 'DEV-' || l_suppkey END AS device_id,
    CASE WHEN l_partkey % 113 = 0 THEN NULL
         ELSE (l_orderkey * 31 + l_linenumber * 7 + l_partkey) % 100
              < CASE WHEN {_RISKY} AND {_ONLINE} THEN 8 WHEN {_RISKY} OR {_ONLINE} THEN 3 ELSE 1 END
         END AS is_fraud_label,
    l_shipdate AS ingestion_time,
    l_partkey * 100000 + l_suppkey AS _offset
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
)"""

TYPED = (
    TX
    + """,
typed AS (
  SELECT transaction_id, timezone('UTC', TRY_CAST(sent_at AS TIMESTAMPTZ)) AS event_time,
         account_id, amount, upper(trim(currency)) AS currency,
         lower(trim(merchant_category)) AS merchant_category, upper(trim(country)) AS country,
         upper(trim(channel)) AS channel, device_id, is_fraud_label, ingestion_time, _offset
  FROM tx
)"""
)

_FX = ", ".join(f"('{code}', CAST({rate} AS DECIMAL(6,2)))" for code, rate in FX_RATES_TO_PLN.items())

# (rule name, SQL condition that must hold), in rule order
_RULES = [
    ("transaction_id_present", "length(trim(transaction_id, ' ')) > 0"),
    ("account_id_present", "length(trim(account_id, ' ')) > 0"),
    ("device_id_present", "length(trim(device_id, ' ')) > 0"),
    ("fraud_label_present", "is_fraud_label IS NOT NULL"),
    ("event_time_valid", "event_time IS NOT NULL"),
    ("amount_in_range", "amount > 0 AND amount <= 1000000"),
    ("currency_allowed", f"currency IN ({_words(CURRENCIES)})"),
    ("country_allowed", f"country IN ({_words(COUNTRIES)})"),
    ("channel_allowed", f"channel IN ({_words(CHANNELS)})"),
    ("merchant_category_allowed", f"merchant_category IN ({_words(MERCHANT_CATEGORIES)})"),
]
_ERRORS = "concat_ws(',', {})".format(
    ", ".join(f"CASE WHEN NOT coalesce({cond}, FALSE) THEN '{name}' END" for name, cond in _RULES)
)

PRICED = (
    TYPED
    + f""",
fx(currency, rate) AS (VALUES {_FX}),
priced AS (
  SELECT t.*, CAST(event_time AS DATE) AS event_date, CAST(rate AS DOUBLE) AS fx_rate_to_pln,
         round(amount * rate, 2) AS pln, {_ERRORS} AS dq_errors
  FROM (SELECT typed.*, rate FROM typed LEFT JOIN fx USING (currency)) t
)"""
)

SILVER = (
    PRICED
    + """,
silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY transaction_id ORDER BY ingestion_time DESC NULLS LAST, _offset DESC NULLS LAST
    ) AS copy_no
    FROM priced WHERE dq_errors = ''
  ) WHERE copy_no = 1
)"""
)

_SILVER_COLUMNS = """transaction_id, event_time, event_date, account_id,
  CAST(amount AS DOUBLE) AS amount, currency, fx_rate_to_pln, CAST(pln AS DOUBLE) AS amount_pln,
  merchant_category, country, channel, device_id, is_fraud_label, ingestion_time, _offset"""

# --- exact arithmetic shared by the gold statements --------------------------- #

_CENTS = "CAST(sum(CAST(pln * 100 AS BIGINT)) AS HUGEINT)"


def _money_sum(cents: str = _CENTS) -> str:
    return f"CAST({cents} AS DOUBLE) / 100.0e0"


def _money_mean(cents: str, n: str) -> str:
    """Half-up average of cents in whole numbers."""
    return f"CAST((2 * {cents} + {n}) // (2 * CAST({n} AS HUGEINT)) AS DOUBLE) / 100.0e0"


def _rate5(part: str, whole: str) -> str:
    return (
        f"CAST((2 * CAST({part} AS HUGEINT) * 100000 + {whole})"
        f" // (2 * CAST({whole} AS HUGEINT)) AS DOUBLE) / 100000.0e0"
    )


_FRAUDS = "CAST(count(*) FILTER (WHERE is_fraud_label) AS BIGINT)"

GOLD = (
    SILVER
    + f""",
daily AS (
  SELECT event_date, country, count(*) AS tx_count, {_CENTS} AS cents, {_FRAUDS} AS fraud_count
  FROM silver GROUP BY event_date, country
),
category AS (
  SELECT merchant_category, count(*) AS tx_count, count(DISTINCT account_id) AS distinct_accounts,
         {_CENTS} AS cents, {_FRAUDS} AS fraud_count
  FROM silver GROUP BY merchant_category
),
velocity AS (
  SELECT account_id, event_date, count(*) AS tx_count, {_money_sum()} AS total_amount_pln,
         CAST(max(pln) AS DOUBLE) AS max_amount_pln, count(DISTINCT country) AS distinct_countries,
         count(DISTINCT device_id) AS distinct_devices,
         count(DISTINCT merchant_category) AS distinct_categories, {_FRAUDS} AS fraud_count
  FROM silver GROUP BY account_id, event_date
),
signals AS (
  SELECT *, CAST(signal_night AS INTEGER) + CAST(signal_high_amount AS INTEGER)
            + CAST(signal_foreign AS INTEGER) + CAST(signal_high_risk_category AS INTEGER)
            + CAST(signal_card_not_present AS INTEGER) AS signal_count
  FROM (
    SELECT transaction_id, event_time, event_date, account_id, CAST(pln AS DOUBLE) AS amount_pln,
           country, channel, merchant_category, is_fraud_label,
           hour(event_time) < 6 OR hour(event_time) >= 22 AS signal_night,
           pln >= 5000 AS signal_high_amount, country <> 'PL' AS signal_foreign,
           merchant_category IN ({_words(HIGH_RISK_CATEGORIES)}) AS signal_high_risk_category,
           channel = 'ONLINE' AS signal_card_not_present
    FROM silver
  )
)"""
)

_FLAGS = {
    "is_night": "hour(event_time) < 6 OR hour(event_time) >= 22",
    "is_online": "channel = 'ONLINE'",
    "is_atm": "channel = 'ATM'",
    "is_high_risk_category": f"merchant_category IN ({_words(HIGH_RISK_CATEGORIES)})",
    "is_foreign": "country <> 'PL'",
}
_FEATURES = ", ".join(
    ["ln(1 + CAST(pln AS DOUBLE)) AS log_amount_pln", "CAST(hour(event_time) AS DOUBLE) AS hour"]
    + [f"CAST(({cond}) AS INTEGER)::DOUBLE AS {name}" for name, cond in _FLAGS.items()]
)
_Z = " + ".join(
    [str(HEURISTIC_INTERCEPT)] + [f"{w}e0 * {name}" for name, w in HEURISTIC_WEIGHTS.items()]
)

SCORED = (
    SILVER
    + f""",
featured AS (SELECT *, {_FEATURES} FROM silver),
scored AS (
  SELECT *, 1.0e0 / (1.0e0 + exp(-({_Z}))) AS fraud_score FROM featured
)"""
)

# --- messages from events ------------------------------------------------------ #

EV = f"""
ev AS (
  SELECT event_id AS e, 'ACC-' || user_id AS key, event_id % 97 = 0 AS broken, ts,
    'E' || CASE WHEN event_id % 50 = 1 THEN event_id - 1 ELSE event_id END AS transaction_id,
    date_trunc('second', ts)
      - to_seconds(CASE WHEN event_id % 40 = 0 THEN event_id % 600 + 1 ELSE 0 END) AS sent,
    CAST(value AS DECIMAL(18,2)) AS amount,
    {_pick(EV_CURRENCIES, 'event_id % 7')} AS currency,
    {_pick(MERCHANT_CATEGORIES, 'event_id % 12')} AS merchant_category,
    {_pick(EV_COUNTRIES, 'event_id % 12')} AS country,
    {_pick(EV_CHANNELS, 'event_id % 4')} AS channel,
    'DEV-' || (user_id % 40) AS device_id, event_id % 50 = 0 AS is_fraud_label
  FROM events
),
message AS (
  SELECT *, strftime(sent, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS sent_at,
    CASE WHEN broken THEN '{{not-json' ELSE
      '{{"transaction_id":"' || transaction_id || '","timestamp":"'
      || strftime(sent, '%Y-%m-%dT%H:%M:%S') || '+00:00' || '","account_id":"' || key
      || '","amount":' || CAST(amount AS VARCHAR) || ',"currency":"' || currency
      || '","merchant_category":"' || merchant_category || '","country":"' || country
      || '","channel":"' || channel || '","device_id":"' || device_id
      || '","is_fraud_label":' || CAST(is_fraud_label AS VARCHAR)
      || CASE WHEN e % 61 = 0 THEN ',"surprise":1' ELSE '' END || '}}' END AS value
  FROM ev
)"""


def _unless_broken(column: str, name: str | None = None) -> str:
    return f"CASE WHEN NOT broken THEN {column} END AS {name or column}"


_BRONZE = "WITH {} SELECT key, value, 'transactions.raw' AS source_topic, CAST(e % 3 AS INTEGER) AS _partition, CAST(e // 3 AS BIGINT) AS _offset, ts AS _kafka_timestamp, {} FROM message".format(
    EV,
    ", ".join(
        [
            _unless_broken("transaction_id"),
            _unless_broken("sent_at"),
            _unless_broken("key", "account_id"),
            _unless_broken("CAST(amount AS DOUBLE)", "amount"),
            _unless_broken("currency"),
            _unless_broken("merchant_category"),
            _unless_broken("country"),
            _unless_broken("channel"),
            _unless_broken("device_id"),
            _unless_broken("is_fraud_label"),
        ]
    ),
)

_WIRE_EV = f"""WITH {EV}
SELECT CAST(e % 3 AS INTEGER) AS partition, CAST(e // 3 AS BIGINT) AS "offset",
  CASE WHEN broken THEN 'record must be a dict, got invalid JSON' ELSE concat_ws('; ',
    CASE WHEN e % 61 = 0 THEN 'unexpected fields: surprise' END,
    CASE WHEN amount <= 0 THEN 'amount must be > 0, got ' || CAST(CAST(amount AS DOUBLE) AS VARCHAR)
    END) END AS errors
FROM message"""


def _enum_error(field: str, words) -> str:
    listed = "(" + ", ".join(f"''{w}''" for w in words) + ")"
    return (
        f"CASE WHEN {field} NOT IN ({_words(words)}) THEN "
        f"'{field} must be one of {listed}, got ''' || {field} || '''' END"
    )


_WIRE_TX = f"""WITH {TX}
SELECT _offset, concat_ws('; ',
  CASE WHEN transaction_id = '' THEN 'transaction_id must be a non-empty string' END,
  CASE WHEN device_id IS NULL THEN 'device_id must be a non-empty string' END,
  CASE WHEN sent_at = 'not-a-date' THEN 'timestamp must be an ISO-8601 string' END,
  CASE WHEN amount <= 0 THEN 'amount must be > 0, got ' || CAST(CAST(amount AS DOUBLE) AS VARCHAR) END,
  {_enum_error('currency', CURRENCIES)},
  {_enum_error('merchant_category', MERCHANT_CATEGORIES)},
  {_enum_error('country', COUNTRIES)},
  {_enum_error('channel', CHANNELS)},
  CASE WHEN is_fraud_label IS NULL THEN 'is_fraud_label must be a boolean' END) AS errors
FROM tx"""

_STATS = f"""WITH {EV},
parsed AS (
  SELECT currency, is_fraud_label, sent < date_trunc('second', ts) AS late, ts
  FROM message WHERE NOT broken
),
counted AS (
  SELECT 'run' AS scope, NULL AS currency, count(*) AS produced,
         count(*) FILTER (WHERE is_fraud_label) AS fraud, count(*) FILTER (WHERE late) AS late,
         greatest((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0e0, 1e-9) AS elapsed
  FROM parsed
  UNION ALL
  SELECT 'currency', currency, count(*), count(*) FILTER (WHERE is_fraud_label),
         count(*) FILTER (WHERE late),
         greatest((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0e0, 1e-9)
  FROM parsed GROUP BY currency
)
SELECT scope, currency, produced, fraud, late, round(elapsed, 2) AS elapsed_seconds,
       round(produced / elapsed, 2) AS effective_rate
FROM counted"""

# --- quality -------------------------------------------------------------------- #


def _profile(source: str, run_id: str, quarantined: str) -> str:
    return f"""
  SELECT '{run_id}' AS run_id, count(*) AS row_count,
    count(DISTINCT transaction_id) AS distinct_transaction_ids,
    count(*) - count(DISTINCT transaction_id) AS duplicate_ids,
    count(*) FILTER (WHERE transaction_id IS NULL) AS null_transaction_id,
    count(*) FILTER (WHERE account_id IS NULL) AS null_account_id,
    count(*) FILTER (WHERE amount IS NULL) AS null_amount,
    count(*) FILTER (WHERE pln IS NULL) AS null_amount_pln,
    CAST(min(amount) AS DOUBLE) AS amount_min, CAST(max(amount) AS DOUBLE) AS amount_max,
    {_money_mean(_CENTS, 'count(pln)')} AS avg_amount_pln,
    {_FRAUDS} AS fraud_count, {_rate5(_FRAUDS, 'count(*)')} AS fraud_rate,
    CAST({quarantined} AS BIGINT) AS quarantined_count
  FROM {source}"""


_QUARANTINED = "(SELECT count(*) FROM priced WHERE dq_errors <> '')"
_PROFILES = (
    SILVER
    + f""",
profiles AS ({_profile('silver', 'silver', _QUARANTINED)}
  UNION ALL {_profile('priced', 'unfiltered', '0')}
)"""
)
_CHECK_SQL = dict(
    zip(
        QUALITY_CHECKS,
        [
            "null_transaction_id = 0",
            "null_account_id = 0",
            "null_amount = 0",
            "null_amount_pln = 0",
            "duplicate_ids = 0",
            "(amount_min IS NULL OR amount_min > 0) AND (amount_max IS NULL OR amount_max <= 1000000)",
        ],
        strict=True,
    )
)
_CHECKS = " UNION ALL ".join(
    f"SELECT run_id, '{name}' AS \"check\", {cond} AS passed FROM profiles"
    for name, cond in _CHECK_SQL.items()
)

_GATE = f"""WITH {_PROFILES}, checked AS ({_CHECKS})
SELECT run_id, 'check failed: ' || "check" AS failure FROM checked WHERE NOT passed
UNION ALL
SELECT run_id, 'quarantine ratio '
  || format('{{:.3f}}', quarantined_count / CAST(row_count + quarantined_count AS DOUBLE))
  || ' exceeds max 0.050'
FROM profiles WHERE quarantined_count / CAST(row_count + quarantined_count AS DOUBLE) > 0.05"""

_SUITE_ENTRIES = (
    [
        ("expect_column_values_to_not_be_null", column, f"count(*) FILTER (WHERE {sql} IS NULL)")
        for column, sql in (
            ("transaction_id", "transaction_id"),
            ("account_id", "account_id"),
            ("event_time", "event_time"),
            ("amount", "amount"),
            ("amount_pln", "pln"),
            ("currency", "currency"),
        )
    ]
    + [
        (
            "expect_column_values_to_be_unique",
            "transaction_id",
            "count(*) FILTER (WHERE transaction_id IS NOT NULL AND copies > 1)",
        ),
        (
            "expect_column_values_to_be_between",
            "amount",
            "count(*) FILTER (WHERE amount <= 0 OR amount > 1000000)",
        ),
        ("expect_column_values_to_be_between", "amount_pln", "count(*) FILTER (WHERE pln < 0)"),
    ]
    + [
        (
            "expect_column_values_to_be_in_set",
            column,
            f"count(*) FILTER (WHERE {column} NOT IN ({_words(words)}))",
        )
        for column, words in (("currency", CURRENCIES), ("country", COUNTRIES), ("channel", CHANNELS))
    ]
)
_SUITE = (
    f"WITH {PRICED}, counted AS (SELECT *, count(*) OVER (PARTITION BY transaction_id) AS copies"
    " FROM priced), lines AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{expectation}' AS expectation, '{column}' AS column_name,"
        f" count(*) AS row_count, {sql} AS unexpected_count FROM counted"
        for i, (expectation, column, sql) in enumerate(_SUITE_ENTRIES, start=1)
    )
    + ") SELECT *, unexpected_count = 0 AS success FROM lines"
)

# --- drift ----------------------------------------------------------------------- #


def _drift_ctes(tag: str, feature: str, reference: str, live: str) -> str:
    """CTEs ending in ``drift_<tag>``: one row feature, psi, ks, reference_n, live_n."""
    t = tag
    raw = ", ".join(
        [f"list_extract(s, CAST(least(n - 1, round_even({i} / 10.0e0 * (n - 1), 0)) AS BIGINT) + 1)"
         for i in range(10)]
        + ["list_extract(s, n)"]
    )
    return f"""
ref_{t} AS ({reference}),
live_{t} AS ({live}),
sorted_{t} AS (SELECT list_sort(list(v)) AS s, count(*) AS n FROM ref_{t}),
raw_{t} AS (SELECT [{raw}] AS raw FROM sorted_{t}),
edges_{t} AS (
  SELECT list_reduce(list_transform(raw, lambda x: [x]),
    lambda a, b: list_append(a, CASE WHEN b[1] <= a[len(a)] THEN a[len(a)] + 1e-6 ELSE b[1] END))
    AS e FROM raw_{t}
),
both_{t} AS (
  SELECT v, 1 AS r, 0 AS l FROM ref_{t} UNION ALL SELECT v, 0, 1 FROM live_{t}
),
bucketed_{t} AS (
  SELECT r, l, len(list_filter(e[2:10], lambda x: v > x)) AS bucket FROM both_{t}, edges_{t}
),
sizes_{t} AS (
  SELECT (SELECT count(*) FROM ref_{t}) AS reference_n, (SELECT count(*) FROM live_{t}) AS live_n
),
shares_{t} AS (
  SELECT greatest(sum(r) / CAST(any_value(reference_n) AS DOUBLE), 1e-6) AS p,
         greatest(sum(l) / CAST(any_value(live_n) AS DOUBLE), 1e-6) AS q
  FROM bucketed_{t}, sizes_{t} GROUP BY bucket
),
steps_{t} AS (SELECT v, sum(r) AS r, sum(l) AS l FROM both_{t} GROUP BY v),
gaps_{t} AS (
  SELECT abs(sum(r) OVER w / CAST(reference_n AS DOUBLE) - sum(l) OVER w / CAST(live_n AS DOUBLE))
    AS gap
  FROM steps_{t}, sizes_{t} WINDOW w AS (ORDER BY v ROWS UNBOUNDED PRECEDING)
),
drift_{t} AS (
  SELECT '{feature}' AS feature, (SELECT sum((q - p) * ln(q / p)) FROM shares_{t}) AS psi,
         (SELECT max(gap) FROM gaps_{t}) AS ks, reference_n, live_n
  FROM sizes_{t}
)"""


_AMOUNT, _SCORE = "CAST(pln AS DOUBLE)", "fraud_score"
_BEFORE, _AFTER = "event_date < DATE '1998-01-01'", "event_date >= DATE '1998-01-01'"


def _side(column: str, condition: str) -> str:
    return f"SELECT {column} AS v FROM scored WHERE {condition}"


_SHIFTED = f"{_AMOUNT} * 3"
_DRIFT = ", ".join(
    [
        "WITH " + SCORED,
        _drift_ctes("s1", "fraud_score", _side(_SCORE, _BEFORE), _side(_SCORE, _AFTER)),
        _drift_ctes("a1", "amount_pln", _side(_AMOUNT, _BEFORE), _side(_AMOUNT, _AFTER)),
        _drift_ctes("a2", "amount_pln", _side(_AMOUNT, _BEFORE), _side(_SHIFTED, _AFTER)),
    ]
)
_REPORT = (
    _DRIFT
    + f""",
live_size AS (SELECT count(*) AS live_n FROM scored WHERE {_AFTER}),
figures AS (
  SELECT 'as_is' AS run_id, * FROM drift_s1
  UNION ALL SELECT 'as_is', * FROM drift_a1
  UNION ALL SELECT 'shifted', * FROM drift_s1
  UNION ALL SELECT 'shifted', * FROM drift_a2
  UNION ALL SELECT 'no_reference', 'fraud_score', 0.0e0, 0.0e0, 0, live_n FROM live_size
  UNION ALL SELECT 'no_reference', 'amount_pln', 0.0e0, 0.0e0, 0, live_n FROM live_size
),
report AS (
  SELECT run_id, feature, round(psi, 5) AS psi,
         CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'moderate' ELSE 'significant' END
           AS psi_band, round(ks, 5) AS ks, reference_n, live_n
  FROM figures
)"""
)

_DECISION = (
    _REPORT
    + """,
judged AS (
  SELECT *, CASE WHEN reference_n = 0 THEN feature || ' (no reference)'
                 WHEN live_n < 200 THEN feature || ' (only ' || live_n || ' rows, need 200)' END AS gap
  FROM report
),
lines AS (
  SELECT run_id, feature, gap,
         CASE WHEN gap IS NULL AND psi_band = 'significant'
              THEN feature || ' (PSI=' || psi || ', ' || psi_band || ')' END AS drifted
  FROM judged
),
runs AS (
  SELECT run_id, count(*) FILTER (WHERE gap IS NULL) AS comparable, count(drifted) > 0 AS retrain,
         coalesce(string_agg(drifted, ', ' ORDER BY drifted), '') AS triggered_by,
         coalesce(string_agg(gap, ', ' ORDER BY gap), '') AS not_comparable
  FROM lines GROUP BY run_id
)
SELECT run_id, CASE WHEN retrain THEN 'RETRAIN' ELSE 'NO_RETRAIN' END AS verdict,
       retrain AS should_retrain,
       CASE WHEN retrain THEN 'drift_over_threshold' WHEN comparable = 0 THEN 'nothing_comparable'
            ELSE 'within_limits' END AS reason, triggered_by, not_comparable
FROM runs
UNION ALL SELECT 'no_report', 'NO_RETRAIN', FALSE, 'no_metrics', '', ''"""
)

_RANKS = (
    SCORED
    + """,
ranked AS (
  SELECT fraud_score, count(*) FILTER (WHERE is_fraud_label) AS pos,
         count(*) FILTER (WHERE NOT is_fraud_label) AS neg
  FROM scored GROUP BY fraud_score
),
running AS (
  SELECT *, sum(pos) OVER up AS tp, sum(neg) OVER up AS fp, sum(pos) OVER () AS np,
         sum(neg) OVER () AS nn
  FROM ranked WINDOW up AS (ORDER BY fraud_score DESC ROWS UNBOUNDED PRECEDING)
)"""
)

_HOLDOUT = (
    SILVER
    + """,
drawn AS (
  SELECT transaction_id, is_fraud_label,
         CAST('0x' || substr(md5(transaction_id || '#42'), 1, 13) AS BIGINT) AS draw
  FROM silver
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY is_fraud_label ORDER BY draw) AS place,
         count(*) OVER (PARTITION BY is_fraud_label) AS n
  FROM drawn
)"""
)

_MOVED = (
    "moved AS (SELECT * REPLACE (event_time + INTERVAL 400 DAY AS event_time,"
    " CAST(event_date + INTERVAL 400 DAY AS DATE) AS event_date) FROM source)"
)
_DECILES = " UNION ALL ".join(
    f"SELECT '{name}' AS feature, {i} AS decile, round(quantile_cont({sql}, {i / 10}), 6) AS value"
    " FROM scored"
    for name, sql in (("fraud_score", _SCORE), ("amount_pln", _AMOUNT))
    for i in range(11)
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


def _signals_top(n: int) -> str:
    return _with(
        GOLD,
        "SELECT transaction_id, account_id, amount_pln, country, channel, merchant_category,"
        " signal_count FROM signals WHERE signal_count >= 3"
        f" ORDER BY signal_count DESC, amount_pln DESC, transaction_id LIMIT {n}",
    )


def _scored_top(n: int) -> str:
    return _with(
        SCORED,
        "SELECT transaction_id, account_id, CAST(pln AS DOUBLE) AS amount_pln, country,"
        " merchant_category, round(fraud_score, 4) AS fraud_score, is_fraud_label"
        " FROM scored WHERE fraud_score >= 0.5"
        f" ORDER BY round(scored.fraud_score, 4) DESC, transaction_id LIMIT {n}",
    )


_VOLUME = _money_sum("sum(cents)")
_BIG = "CAST(sum({}) AS BIGINT) AS {}"
_SUMS = ", ".join(_BIG.format(c, c) for c in ("tx_count", "fraud_count"))
_BY_COUNTRY = (
    f"SELECT country, {_SUMS}, {_VOLUME} AS total_volume_pln FROM daily GROUP BY country"
    " ORDER BY total_volume_pln DESC, country"
)

_SCORE_ROWS = (
    "SELECT transaction_id, round(fraud_score, 6) AS fraud_score, fraud_score >= 0.5 AS fraud_flag"
    " FROM scored"
)
_FEATURE_ROWS = ", ".join(
    ["round(log_amount_pln, 6) AS log_amount_pln", "hour", *_FLAGS]
)

_GOLD_VOLUMES = (
    f"SELECT 'daily_volume_by_country' AS table_name, count(*) AS n_rows, {_VOLUME} AS volume_pln"
    f" FROM daily UNION ALL SELECT 'merchant_category_kpi', count(*), {_VOLUME} FROM category"
    " UNION ALL SELECT 'account_velocity', count(*), CAST(sum(CAST(total_amount_pln AS"
    " DECIMAL(28,2))) AS DOUBLE) FROM velocity UNION ALL SELECT 'fraud_signals', count(*),"
    f" {_money_sum()} FROM silver UNION ALL SELECT 'scored_transactions', count(*),"
    f" {_money_sum()} FROM silver"
)
_UPSERT_SIDE = """{0} AS (
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY transaction_id ORDER BY ingestion_time DESC, _offset DESC) AS copy_no
    FROM priced WHERE dq_errors = '' AND ingestion_time {1} TIMESTAMP '1997-01-01')
  WHERE copy_no = 1
)"""

_MOVED_SILVER = (
    PRICED + ", " + _UPSERT_SIDE.format("target", ">=") + ", " + _UPSERT_SIDE.format("source", "<") + ", " + _MOVED + """,
silver AS (
  SELECT * FROM moved UNION ALL SELECT * FROM target WHERE transaction_id NOT IN (SELECT transaction_id FROM source)
)"""
)
_AFTER_MOVES = _with(_MOVED_SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver")
#: The same tables over the moved rows.
_MOVED_GOLD = _MOVED_SILVER + GOLD.removeprefix(SILVER)

ORACLE: dict[str, str] = {
    "bronze_frame": _BRONZE,
    "stream_bronze": _BRONZE,
    "wire_validate": _WIRE_EV,
    "wire_validate_tx": _WIRE_TX,
    "wire_encode": _with(
        TX,
        "SELECT account_id AS key, transaction_id, sent_at, account_id, CAST(amount AS DOUBLE) AS"
        " amount, currency, merchant_category, country, channel, device_id, is_fraud_label FROM tx",
    ),
    "ingest_run_stats": _STATS,
    "cast_extract": _with(
        TYPED,
        "SELECT transaction_id, event_time, account_id, CAST(amount AS DOUBLE) AS amount, currency,"
        " merchant_category, country, channel, device_id, is_fraud_label, ingestion_time, _offset"
        " FROM typed",
    ),
    "fx_normalize": _with(
        PRICED,
        "SELECT transaction_id, _offset, event_date, currency, fx_rate_to_pln,"
        " CAST(pln AS DOUBLE) AS amount_pln FROM priced",
    ),
    "dq_errors": _with(PRICED, "SELECT transaction_id, _offset, dq_errors FROM priced"),
    "dq_rule_counts": _with(
        PRICED,
        " UNION ALL ".join(
            f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({cond}, FALSE))"
            " AS failures FROM priced"
            for name, cond in _RULES
        ),
    ),
    "silver_valid": _with(PRICED, f"SELECT {_SILVER_COLUMNS} FROM priced WHERE dq_errors = ''"),
    "quarantine": _with(
        PRICED, f"SELECT {_SILVER_COLUMNS}, dq_errors FROM priced WHERE dq_errors <> ''"
    ),
    "dedup_latest": _with(SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver"),
    "horizon_filter": _with(
        TX,
        "SELECT transaction_id, _offset, CAST(ingestion_time AS DATE) AS ingestion_date FROM tx"
        " WHERE ingestion_time >= TIMESTAMP '1997-08-01'",
    ),
    "upsert_merge": _with(
        PRICED
        + ", "
        + _UPSERT_SIDE.format("target", ">=")
        + ", "
        + _UPSERT_SIDE.format("source", "<"),
        f"SELECT {_SILVER_COLUMNS} FROM source UNION ALL SELECT {_SILVER_COLUMNS} FROM target"
        " WHERE transaction_id NOT IN (SELECT transaction_id FROM source)",
    ),
    "cluster_rewrite": _with(SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver"),
    "quality_profile": _with(_PROFILES, "SELECT * FROM profiles WHERE run_id = 'silver'"),
    "quality_checks": _with(_PROFILES, _CHECKS),
    "expectation_suite": _SUITE,
    "quality_gate": _GATE,
    "daily_volume_by_country": _with(
        GOLD,
        f"SELECT event_date, country, tx_count, {_money_sum('cents')} AS total_volume_pln,"
        f" {_money_mean('cents', 'tx_count')} AS avg_amount_pln, fraud_count,"
        f" {_rate5('fraud_count', 'tx_count')} AS fraud_rate FROM daily",
    ),
    "merchant_category_kpi": _with(
        GOLD,
        f"SELECT merchant_category, tx_count, distinct_accounts, {_money_sum('cents')} AS"
        f" total_volume_pln, {_money_mean('cents', 'tx_count')} AS avg_amount_pln, fraud_count,"
        f" {_rate5('fraud_count', 'tx_count')} AS fraud_rate FROM category",
    ),
    "account_velocity": _with(GOLD, "SELECT * FROM velocity"),
    "fraud_signals": _with(GOLD, "SELECT * FROM signals"),
    "features": _with(SCORED, f"SELECT transaction_id, {_FEATURE_ROWS} FROM featured"),
    "heuristic_score": _with(SCORED, _SCORE_ROWS),
    "pandas_score": _with(SCORED, _SCORE_ROWS),
    "scored_transactions": _with(
        SCORED,
        f"SELECT {_SILVER_COLUMNS}, round(fraud_score, 6) AS fraud_score,"
        " fraud_score >= 0.5 AS fraud_flag FROM scored",
    ),
    "psi": _DRIFT + " SELECT feature, round(psi, 6) AS psi FROM drift_a2",
    "ks": _DRIFT + " SELECT feature, round(ks, 6) AS ks FROM drift_a2",
    "psi_band": _with(
        GOLD,
        "SELECT event_date, country, CASE WHEN rate < 0.1 THEN 'stable' WHEN rate < 0.2 THEN"
        " 'moderate' ELSE 'significant' END AS psi_band FROM (SELECT event_date, country,"
        f" {_rate5('fraud_count', 'tx_count')} AS rate FROM daily)",
    ),
    "drift_report": _REPORT + " SELECT * FROM report",
    "retrain_decision": _DECISION,
    "empirical_cdf": _with(
        SILVER,
        "SELECT amount_pln, round(sum(n) OVER (ORDER BY amount_pln) / CAST(sum(n) OVER () AS DOUBLE),"
        " 9) AS cdf FROM (SELECT CAST(pln AS DOUBLE) AS amount_pln, count(*) AS n FROM silver"
        " GROUP BY pln)",
    ),
    "deciles": _with(SCORED, _DECILES),
    "roc_auc": _with(
        _RANKS,
        "SELECT CAST(sum(pos + neg) AS BIGINT) AS rows, CAST(sum(pos) AS BIGINT) AS positives,"
        " round(sum(pos * (2 * (nn - fp) + neg)) / 2.0e0 / (any_value(np) * any_value(nn)), 6)"
        " AS roc_auc FROM running",
    ),
    "average_precision": _with(
        _RANKS,
        "SELECT round(any_value(np) / CAST(any_value(np) + any_value(nn) AS DOUBLE), 6) AS no_skill,"
        " round(sum(pos / CAST(np AS DOUBLE) * tp / CAST(tp + fp AS DOUBLE)), 6)"
        " AS average_precision FROM running",
    ),
    "stratified_split": _with(
        _HOLDOUT,
        "SELECT transaction_id, is_fraud_label, place <= ceil(n * 0.25e0) AS is_holdout FROM placed",
    ),
    "live_sample": _with(
        SILVER,
        "SELECT transaction_id, CAST(pln AS DOUBLE) AS amount_pln FROM silver"
        " ORDER BY md5(transaction_id), transaction_id LIMIT 5000",
    ),
    "table_fingerprint": _with(
        GOLD,
        f"SELECT *, TRUE AS identical FROM ({_GOLD_VOLUMES} UNION ALL SELECT 'silver', count(*), {_money_sum()}"
        f" FROM silver UNION ALL SELECT 'quarantine', count(*), {_money_sum()} FROM priced WHERE dq_errors <> '')",
    ),
    "quarantine_append": _with(
        PRICED,
        "SELECT step, count(*) * times AS n_rows FROM priced, (VALUES ('first', 1), ('again', 1), ('unkeyed', 2))"
        " steps(step, times) WHERE dq_errors <> '' GROUP BY step, times",
    ),
    "upsert_moved_day": _AFTER_MOVES,
    "upsert_indexed": _AFTER_MOVES,
    "upsert_versioned": _AFTER_MOVES,
    "version_rows": _with(
        _MOVED_SILVER,
        f"SELECT 'version 1' AS table_name, count(*) AS n_rows, {_money_sum()} AS volume_pln FROM target"
        f" UNION ALL SELECT 'version 2', count(*), {_money_sum()} FROM silver",
    ),
    "report_roundtrip": _with(_PROFILES, "SELECT * FROM profiles WHERE run_id = 'silver'"),
    "pipeline_gate": _with(
        _PROFILES,
        "SELECT gate.run_id, share > most AS stopped, CAST(CASE WHEN share > most THEN 0 ELSE 5 END AS BIGINT) AS"
        " gold_tables FROM (SELECT quarantined_count / CAST(row_count + quarantined_count AS DOUBLE) AS share"
        " FROM profiles WHERE run_id = 'silver'), (VALUES ('strict', 0.05e0), ('lenient', 0.2e0)) gate(run_id, most)",
    ),
    "stream_restart": "SELECT step, CAST(n AS BIGINT) AS bronze_rows FROM (SELECT count(*) FILTER (WHERE"
    " (event_id // 3) % 2 = 0) AS half, count(*) AS whole FROM events), LATERAL (VALUES ('first file', half),"
    " ('replay', half), ('second file', whole)) steps(step, n)",
    "gbt_train_eval": _with(
        _HOLDOUT,
        "SELECT count(*) AS n_samples, count(*) FILTER (WHERE is_fraud_label) AS n_fraud,"
        " count(*) FILTER (WHERE place <= ceil(n * 0.25e0)) AS holdout_n,"
        " round(count(*) FILTER (WHERE is_fraud_label AND place <= ceil(n * 0.25e0))"
        " / CAST(count(*) FILTER (WHERE place <= ceil(n * 0.25e0)) AS DOUBLE), 4) AS holdout_positive_rate,"
        " TRUE AS beats_chance, TRUE AS beats_no_skill FROM placed",
    ),
    "job_silver": _with(SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver"),
    "job_gold": _with(GOLD, _GOLD_VOLUMES),
    "job_silver_indexed": _with(SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver"),
    "job_gold_incremental": _with(_MOVED_GOLD, _GOLD_VOLUMES),
    "q1_top_countries": _with(GOLD, _BY_COUNTRY + " LIMIT 10"),
    "q2_category_fraud_rate": _with(
        GOLD,
        f"SELECT merchant_category, tx_count, fraud_count, {_rate5('fraud_count', 'tx_count')} AS"
        f" fraud_rate, {_money_sum('cents')} AS total_volume_pln FROM category WHERE tx_count >= 100",
    ),
    "q3_daily_fraud_trend": _with(
        GOLD,
        f"SELECT event_date, {_SUMS}, {_rate5('sum(fraud_count)', 'sum(tx_count)')} AS fraud_rate"
        " FROM daily GROUP BY event_date",
    ),
    "q4_high_velocity_accounts": _with(
        GOLD,
        "SELECT account_id, event_date, tx_count, distinct_countries, distinct_devices,"
        " total_amount_pln, max_amount_pln FROM velocity WHERE tx_count >= 5 AND"
        " distinct_countries >= 2 ORDER BY tx_count DESC, distinct_countries DESC, account_id,"
        " event_date LIMIT 25",
    ),
    "q5_strongest_signals": _signals_top(25),
    "q6_highest_scores": _scored_top(25),
    "q7_score_by_label": _with(
        SCORED,
        "SELECT is_fraud_label, count(*) AS n, round(avg(fraud_score), 4) AS avg_fraud_score"
        " FROM scored GROUP BY is_fraud_label",
    ),
    "kpi_row": _with(
        GOLD,
        f"SELECT CAST(coalesce(sum(tx_count), 0) AS BIGINT) AS total_tx, coalesce({_VOLUME}, 0.0e0)"
        " AS total_volume_pln, CAST(coalesce(sum(fraud_count), 0) AS BIGINT) AS total_fraud,"
        " count(DISTINCT country) AS countries FROM daily",
    ),
    "volume_by_country": _with(GOLD, _BY_COUNTRY),
    "daily_trend": _with(GOLD, f"SELECT event_date, {_SUMS} FROM daily GROUP BY event_date"),
    "category_kpi": _with(
        GOLD,
        f"SELECT merchant_category, tx_count, fraud_count, {_rate5('fraud_count', 'tx_count')} AS"
        f" fraud_rate, {_money_sum('cents')} AS total_volume_pln FROM category",
    ),
    "top_scored": _scored_top(50),
    "top_signals": _signals_top(50),
    "fraud_headline": _with(
        GOLD,
        "SELECT CAST(sum(tx_count) AS BIGINT) AS total_tx, CAST(sum(fraud_count) AS BIGINT) AS"
        f" total_fraud, {_rate5('sum(fraud_count)', 'sum(tx_count)')} AS fraud_rate FROM daily",
    ),
}

ORACLE |= {
    "category_kpi_merged": ORACLE["merchant_category_kpi"],
    "quality_profile_merged": ORACLE["quality_profile"],
    "cluster_interleaved": ORACLE["cluster_rewrite"],
    "damaged_model_score": ORACLE["heuristic_score"],
    "drift_incremental": _REPORT + " SELECT * FROM report WHERE run_id = 'as_is'",
    "gbt_expression_score": _with(SILVER, "SELECT transaction_id, TRUE AS equal FROM silver"),
    "model_reference": _with(
        SCORED,
        "SELECT 'fraud_score' AS feature, round(fraud_score, 6) AS value, count(*) AS n FROM scored GROUP BY ALL"
        " UNION ALL SELECT 'amount_pln', CAST(pln AS DOUBLE), count(*) FROM scored GROUP BY ALL",
    ),
    "stream_rate_limit": "SELECT event_id % 3 AS batch, count(*) AS n_rows FROM events GROUP BY batch",
    "deciles_two_pass": ORACLE["deciles"],
    "psi_two_pass": ORACLE["psi"],
}
