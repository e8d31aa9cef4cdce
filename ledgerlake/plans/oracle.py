"""Oracle SQL (DuckDB dialect) for every registered query.

Independent formulation: the fixture entities are rebuilt from the driver tables with the
same rules as `ledgerlake.sources.fixtures`, and each dataset is written the way the
reference's SQL models write it (window-based mode, scalar-subquery watermarks, MERGE as
anti join + insert), with every tie-break and NULL placement spelled out.
"""

from __future__ import annotations

RUN1 = "2024-03-01 00:00:00"
RUN2 = "2024-03-02 00:00:00"

# ---- fixture entities ----------------------------------------------------------------------
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


cte("event_types", "SELECT event_type, dense_rank() OVER (ORDER BY event_type ASC NULLS FIRST) - 1 AS type_rank "
    "FROM (SELECT DISTINCT event_type FROM events) d")
cte("customers", "SELECT c_custkey AS id, c_mktsegment AS first_name, c_name AS last_name, "
    "lower(c_name) || '@example.com' AS email, TIMESTAMP '1995-01-01 00:00:00' AS created_at FROM customer")
cte("accounts", "SELECT c_custkey * 2 + i AS id, c_custkey AS customer_id, "
    "CASE WHEN i = 0 THEN 'SAVINGS' ELSE 'CHECKING' END AS account_type, c_acctbal AS balance, "
    "'USD' AS currency, TIMESTAMP '1995-01-01 00:00:00' AS created_at FROM customer CROSS JOIN (VALUES (0), (1)) v(i)")
cte("transactions", """SELECT id, account_id, txn_type, amount,
       CASE WHEN txn_type = 'TRANSFER' THEN account_id + 2 END AS related_account_id,
       'COMPLETED' AS status, created_at
FROM (SELECT o_orderkey AS id,
             CASE WHEN o_orderkey % 97 = 0 THEN -1 ELSE o_custkey * 2 + o_orderkey % 2 END AS account_id,
             CASE o_orderstatus WHEN 'F' THEN 'DEPOSIT' WHEN 'O' THEN 'WITHDRAWAL' WHEN 'P' THEN 'TRANSFER' END AS txn_type,
             CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) % 100000 + 1 AS DOUBLE) / 100 AS amount,
             o_orderdate AS created_at
      FROM orders) o""")
cte("services", "SELECT CAST(type_rank * 2 + i + 1 AS BIGINT) AS id, upper(event_type) || '_' || CAST(i AS VARCHAR) AS service_code, "
    "event_type || ' ' || CAST(i AS VARCHAR) AS service_name, upper(event_type) AS category, TRUE AS is_active, "
    "TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM event_types CROSS JOIN (VALUES (0), (1)) v(i)", "event_types")
cte("service_usage", """SELECT e.event_id + 1 AS id, e.user_id AS customer_id,
       CASE WHEN e.event_id % 5 = 0 THEN NULL ELSE e.user_id * 2 + e.event_id % 2 END AS account_id,
       CAST(t.type_rank * 2 + CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 2 + 1 AS BIGINT) AS service_id,
       ['WEB', 'MOBILE', 'ATM', 'BRANCH', 'CALL_CENTER'][CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 5 + 1 AS INTEGER)] AS channel,
       CASE WHEN e.event_id % 4 = 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status, e.ts AS used_at
FROM events e LEFT JOIN event_types t ON e.event_type = t.event_type""", "event_types")
cte("order_totals", "SELECT o_custkey, count(*) AS n, "
    "sum(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS p_sum, "
    "sum(CAST(o_totalprice AS DECIMAL(18,2))) AS all_sum FROM orders GROUP BY o_custkey")
cte("customer_profiles", """SELECT customer_id, total_transactions, total_transfer_amount, avg_transaction_amount,
       preferred_transaction_type, login_frequency, favorite_feature, last_active_date, risk_score,
       last_active_date AS updated_at
FROM (SELECT c.c_custkey AS customer_id, coalesce(o.n, 0) * 25 AS total_transactions,
             CAST(coalesce(o.p_sum, 0) AS DOUBLE) / 20 AS total_transfer_amount,
             CAST(o.all_sum AS DOUBLE) / NULLIF(coalesce(o.n, 0), 0) / 100 AS avg_transaction_amount,
             CASE WHEN c.c_custkey % 7 = 0 THEN NULL
                  ELSE ['DEPOSIT', 'WITHDRAWAL', 'TRANSFER'][CAST(c.c_custkey % 3 + 1 AS INTEGER)] END AS preferred_transaction_type,
             (c.c_custkey * 7) % 61 AS login_frequency, 'dashboard' AS favorite_feature,
             CAST(DATE '2024-02-01' - CAST((c.c_custkey * 11) % 61 AS INTEGER) AS TIMESTAMP) AS last_active_date,
             ((c.c_custkey * 137) % 10001) / 100 AS risk_score
      FROM customer c LEFT JOIN order_totals o ON c.c_custkey = o.o_custkey) p""", "order_totals")
SEGMENT_CASE = """CASE WHEN risk_score > 80 THEN 'Risky User'
            WHEN date_sub('day', last_active_date, TIMESTAMP '2024-02-01 00:00:00') > 30 THEN 'Dormant User'
            WHEN total_transactions > 200 AND total_transfer_amount > 30000 THEN 'VIP'
            WHEN login_frequency > 20 THEN 'Active User'
            WHEN preferred_transaction_type = 'TRANSFER' AND total_transfer_amount > 10000 THEN 'Transfer Heavy User'
            ELSE 'Standard User' END"""
SCORE_CASE = """CASE WHEN risk_score > 80 THEN CAST(risk_score AS DOUBLE)
            WHEN date_sub('day', last_active_date, TIMESTAMP '2024-02-01 00:00:00') > 30 THEN 90.0
            WHEN total_transactions > 200 AND total_transfer_amount > 30000 THEN 95.0
            WHEN login_frequency > 20 THEN 85.0
            WHEN preferred_transaction_type = 'TRANSFER' AND total_transfer_amount > 10000 THEN 75.0
            ELSE 50.0 END"""
cte("customer_segments", f"SELECT customer_id, {SEGMENT_CASE} AS segment_name, CAST({SCORE_CASE} AS DOUBLE) AS segment_score, "
    "updated_at AS assigned_at FROM customer_profiles", "customer_profiles")

# second batches
cte("transactions_b1", "SELECT * FROM transactions WHERE created_at < TIMESTAMP '1999-01-01 00:00:00'", "transactions")
cte("usage_half", "SELECT floor(max(id) / 2) AS half FROM service_usage", "service_usage")
cte("service_usage_b1", "SELECT u.* FROM service_usage u, usage_half h WHERE u.id <= h.half", "service_usage", "usage_half")
cte("service_usage_b2", """SELECT * FROM service_usage
UNION ALL
SELECT u.id, u.customer_id, u.account_id, u.service_id, u.channel,
       CASE WHEN u.status = 'FAILED' THEN 'SUCCESS' ELSE 'FAILED' END AS status, u.used_at + INTERVAL 1 SECOND AS used_at
FROM service_usage u, usage_half h WHERE u.id <= h.half AND u.id % 7 = 0""", "service_usage", "usage_half")
cte("accounts_b2", """SELECT id, customer_id, account_type,
       CASE WHEN id % 10 = 0 THEN balance + 1 ELSE balance END AS balance,
       CASE WHEN id % 10 = 1 THEN 'EUR' ELSE currency END AS currency, created_at
FROM accounts WHERE id % 10 <> 2
UNION ALL
SELECT CAST(10000000 + c_custkey AS BIGINT), c_custkey, 'SAVINGS', c_acctbal, 'USD', TIMESTAMP '1995-01-01 00:00:00'
FROM customer WHERE c_custkey % 50 = 0""", "accounts")
cte("customer_profiles_b2", """SELECT customer_id, total_transactions, total_transfer_amount, avg_transaction_amount,
       preferred_transaction_type,
       CASE WHEN customer_id % 5 = 0 THEN login_frequency + 1 WHEN customer_id % 5 = 1 THEN login_frequency + 100
            ELSE login_frequency END AS login_frequency,
       favorite_feature, last_active_date, risk_score,
       CASE WHEN customer_id % 5 = 0 THEN updated_at + INTERVAL 1 DAY ELSE updated_at END AS updated_at
FROM customer_profiles""", "customer_profiles")
cte("customer_segments_b1", "SELECT * FROM customer_segments WHERE assigned_at < TIMESTAMP '2024-01-02 00:00:00'", "customer_segments")
cte("customer_segments_b2", """SELECT * FROM customer_segments
UNION ALL
SELECT customer_id, 'Active User', 85.0, TIMESTAMP '2024-02-15 00:00:00' FROM customer_segments WHERE customer_id % 9 = 0""",
    "customer_segments")


# ---- staging ---------------------------------------------------------------------------------
def _num(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DOUBLE)) AS DECIMAL(38,0))"


def _latest(select: str, src: str, key: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
            f"FROM (SELECT {select} FROM {src}) s) r WHERE rn = 1")


def _nf(cols: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in cols.split(","))


def staging_sql(table: str, src: str, run: str) -> str:
    lt = f"TIMESTAMP '{run}'"
    if table == "customers":
        sel = "CAST(id AS VARCHAR) AS customer_id, first_name, last_name, email, created_at"
        return f"SELECT *, {lt} AS load_timestamp FROM ({_latest(sel, src, 'customer_id', 'created_at DESC NULLS FIRST, ' + _nf('first_name, last_name, email'))}) x"
    if table == "accounts":
        sel = ("CAST(id AS VARCHAR) AS account_id, CAST(customer_id AS VARCHAR) AS customer_id, account_type, "
               "CAST(balance AS DOUBLE) AS balance, currency, created_at")
        return f"SELECT *, {lt} AS load_timestamp FROM ({_latest(sel, src, 'account_id', 'created_at DESC NULLS FIRST, ' + _nf('customer_id, account_type, balance, currency'))}) x"
    if table == "transactions":
        return (f"SELECT CAST(id AS VARCHAR) AS transaction_id, CAST(account_id AS VARCHAR) AS account_id, "
                f"CAST(amount AS DOUBLE) AS amount, txn_type AS transaction_type, "
                f"CAST(related_account_id AS VARCHAR) AS related_account_id, status, created_at AS transaction_time, "
                f"{lt} AS load_timestamp FROM {src}")
    if table == "services":
        sel = "CAST(id AS BIGINT) AS service_id, service_code, service_name, category, is_active, created_at"
        return f"SELECT *, {lt} AS load_timestamp FROM ({_latest(sel, src, 'service_id', 'created_at DESC NULLS FIRST, ' + _nf('service_code, service_name, category, is_active'))}) x"
    if table == "service_usage":
        sel = ("CAST(id AS BIGINT) AS usage_id, CAST(customer_id AS BIGINT) AS customer_id, CAST(account_id AS BIGINT) AS account_id, "
               "CAST(service_id AS BIGINT) AS service_id, channel, status, used_at")
        return f"SELECT *, {lt} AS load_timestamp FROM ({_latest(sel, src, 'usage_id', 'used_at DESC NULLS FIRST, ' + _nf('customer_id, account_id, service_id, channel, status'))}) x"
    if table == "customer_profiles":
        sel = (f"CAST(customer_id AS VARCHAR) AS customer_id, {_num('total_transactions')} AS total_transactions, "
               f"{_num('total_transfer_amount')} AS total_transfer_amount, {_num('avg_transaction_amount')} AS avg_transaction_amount, "
               f"{_num('login_frequency')} AS login_frequency, preferred_transaction_type, favorite_feature, last_active_date, "
               f"{_num('risk_score')} AS risk_score, updated_at")
        rest = _nf("total_transactions, total_transfer_amount, avg_transaction_amount, login_frequency, "
                   "preferred_transaction_type, favorite_feature, last_active_date, risk_score")
        return f"SELECT *, {lt} AS load_ts FROM ({_latest(sel, src, 'customer_id', 'updated_at DESC NULLS LAST, ' + rest)}) x"
    if table == "customer_segments":
        sel = f"CAST(customer_id AS VARCHAR) AS customer_id, segment_name, {_num('segment_score')} AS segment_score, assigned_at"
        inner = _latest(sel, src, "customer_id", "assigned_at DESC NULLS LAST, " + _nf("segment_name, segment_score"))
        return (f"SELECT customer_id, segment_name, segment_score, assigned_at, assigned_at AS updated_at, {lt} AS load_ts "
                f"FROM ({inner}) x")
    raise KeyError(table)


TABLES = ["customers", "accounts", "transactions", "services", "service_usage", "customer_profiles", "customer_segments"]
for _t in TABLES:
    cte(f"stg_{_t}", staging_sql(_t, _t, RUN1), _t)
cte("stg_transactions_b1", staging_sql("transactions", "transactions_b1", RUN1), "transactions_b1")
cte("stg_transactions_r2", staging_sql("transactions", "transactions", RUN2), "transactions")
cte("stg_accounts_r2", staging_sql("accounts", "accounts", RUN2), "accounts")
cte("stg_accounts_b2", staging_sql("accounts", "accounts_b2", RUN2), "accounts_b2")
cte("stg_service_usage_b1", staging_sql("service_usage", "service_usage_b1", RUN1), "service_usage_b1")
cte("stg_service_usage_b2", staging_sql("service_usage", "service_usage_b2", RUN2), "service_usage_b2")
cte("stg_customer_profiles_b2", staging_sql("customer_profiles", "customer_profiles_b2", RUN2), "customer_profiles_b2")
cte("stg_customer_segments_b1", staging_sql("customer_segments", "customer_segments_b1", RUN1), "customer_segments_b1")
cte("stg_customer_segments_b2", staging_sql("customer_segments", "customer_segments_b2", RUN2), "customer_segments_b2")

# ---- service usage ------------------------------------------------------------------------------
cte("dim_services", f"""SELECT service_id, service_code, service_name, category, is_active, created_at,
       TIMESTAMP '{RUN1}' AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM stg_services""", "stg_services")


def fct_usage_sql(usage: str, run: str, target: str | None = None) -> str:
    where = f"WHERE u.usage_id > (SELECT coalesce(max(usage_id), 0) FROM {target})" if target else ""
    return f"""SELECT u.usage_id, u.customer_id, u.account_id, u.service_id, s.service_code, s.service_name, s.category,
       u.channel, u.status, u.used_at, CAST(u.used_at AS DATE) AS usage_date, TIMESTAMP '{run}' AS load_timestamp
FROM {usage} u LEFT JOIN dim_services s ON u.service_id = s.service_id AND s.is_current = TRUE {where}"""


cte("fct_service_usage", fct_usage_sql("stg_service_usage", RUN1), "stg_service_usage", "dim_services")
cte("fct_usage_t1", fct_usage_sql("stg_service_usage_b1", RUN1), "stg_service_usage_b1", "dim_services")
cte("agg_service_frequency", """SELECT service_id, service_name, category, total_uses, distinct_customers, successful_uses, failed_uses,
       CAST(ROUND(CAST(100.0 * total_uses / NULLIF(SUM(total_uses) OVER (), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS pct_share,
       RANK() OVER (ORDER BY total_uses DESC) AS usage_rank, last_used_at
FROM (SELECT service_id, service_name, category, count(*) AS total_uses, count(DISTINCT customer_id) AS distinct_customers,
             count(*) FILTER (WHERE status = 'SUCCESS') AS successful_uses,
             count(*) FILTER (WHERE status = 'FAILED') AS failed_uses, max(used_at) AS last_used_at
      FROM fct_service_usage GROUP BY 1, 2, 3) usage""", "fct_service_usage")

# ---- transactions and customer features --------------------------------------------------------


def tx_owned(tx: str, acc: str) -> str:
    return (f"SELECT a.customer_id, t.transaction_type, t.amount, t.transaction_time FROM {tx} t "
            f"LEFT JOIN {acc} a ON t.account_id = a.account_id")


def type_counts(owned: str) -> str:
    return (f"SELECT customer_id, transaction_type, count(*) AS cnt, row_number() OVER (PARTITION BY customer_id "
            f"ORDER BY count(*) DESC, transaction_type ASC NULLS FIRST) AS rn FROM {owned} GROUP BY customer_id, transaction_type")


def d13_sql(owned: str, counts: str) -> str:
    return f"""SELECT agg.customer_id, agg.total_transactions, agg.total_transfer_amount, agg.avg_transaction_amount,
       agg.last_transaction_time, tc.transaction_type AS preferred_transaction_type
FROM (SELECT customer_id, count(*) AS total_transactions,
             CAST(sum(CASE WHEN lower(transaction_type) = 'transfer' THEN coalesce(CAST(amount AS DECIMAL(18,2)), 0) ELSE 0 END) AS DOUBLE) AS total_transfer_amount,
             CAST(sum(coalesce(CAST(amount AS DECIMAL(18,2)), 0)) AS DOUBLE) / count(*) AS avg_transaction_amount,
             max(transaction_time) AS last_transaction_time
      FROM {owned} GROUP BY customer_id) agg
LEFT JOIN {counts} tc ON tc.customer_id = agg.customer_id AND tc.rn = 1"""


def d14_sql(d13: str, profiles: str) -> str:
    return f"""SELECT tx.customer_id, tx.total_transactions, tx.total_transfer_amount, tx.avg_transaction_amount,
       tx.last_transaction_time, coalesce(p.login_frequency, 0) AS login_frequency,
       coalesce(p.preferred_transaction_type, tx.preferred_transaction_type) AS preferred_transaction_type,
       p.favorite_feature, coalesce(p.last_active_date, tx.last_transaction_time) AS last_active_date,
       coalesce(p.risk_score, 0) AS risk_score
FROM {d13} tx LEFT JOIN {profiles} p ON p.customer_id = tx.customer_id"""


def d15_select(d14: str, run: str, where: str = "") -> str:
    return f"""SELECT customer_id, total_transactions, total_transfer_amount, avg_transaction_amount, login_frequency,
       preferred_transaction_type, favorite_feature, last_active_date,
       GREATEST(0.0, LEAST(100.0, CAST(ROUND(CAST(coalesce(CAST(risk_score AS DOUBLE), 0) + coalesce(total_transfer_amount, 0) / 1000
            + coalesce(avg_transaction_amount, 0) / 10 AS DECIMAL(38,10)), 2) AS DOUBLE))) AS risk_score,
       TIMESTAMP '{run}' AS updated_at
FROM {d14} {where}"""


cte("tx_owned", tx_owned("stg_transactions", "stg_accounts"), "stg_transactions", "stg_accounts")
cte("type_counts", type_counts("tx_owned"), "tx_owned")
cte("d13", d13_sql("tx_owned", "type_counts"), "tx_owned", "type_counts")
cte("profiles_known", "SELECT * FROM stg_customer_profiles WHERE CAST(customer_id AS BIGINT) % 10 <> 0", "stg_customer_profiles")
cte("d14", d14_sql("d13", "profiles_known"), "d13", "profiles_known")
cte("d15", d15_select("d14", RUN1), "d14")
cte("tx_owned_b1", tx_owned("stg_transactions_b1", "stg_accounts"), "stg_transactions_b1", "stg_accounts")
cte("type_counts_b1", type_counts("tx_owned_b1"), "tx_owned_b1")
cte("d13_b1", d13_sql("tx_owned_b1", "type_counts_b1"), "tx_owned_b1", "type_counts_b1")
cte("d14_b1", d14_sql("d13_b1", "profiles_known"), "d13_b1", "profiles_known")
cte("d15_t1", d15_select("d14_b1", RUN1), "d14_b1")
cte("d15_batch2", d15_select("d14", RUN2,
    "WHERE last_transaction_time > (SELECT coalesce(max(updated_at), TIMESTAMP '1970-01-01 00:00:00') FROM d15_t1)"),
    "d14", "d15_t1")


def merge_sql(target: str, batch: str, keys: list[str]) -> str:
    cond = " AND ".join(f"b.{k} = t.{k}" for k in keys)
    return f"SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {batch} b WHERE {cond}) UNION ALL SELECT * FROM {batch}"


def fact_tx_sql(tx: str, acc: str, run: str) -> str:
    order = "transaction_time DESC NULLS FIRST, " + _nf("account_id, amount, transaction_type, related_account_id, status")
    return f"""SELECT d.transaction_id, d.account_id, a.customer_id, d.amount, d.related_account_id, d.status,
       d.transaction_type, d.transaction_time, TIMESTAMP '{run}' AS load_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {order}) AS rn FROM {tx}) d
LEFT JOIN {acc} a ON d.account_id = a.account_id WHERE d.rn = 1"""


def activity_sql(tx: str, acc: str) -> str:
    return f"""SELECT a.customer_id, CAST(t.transaction_time AS DATE) AS activity_date, count(*) AS transactions_count,
       CAST(sum(coalesce(CAST(t.amount AS DECIMAL(18,2)), 0)) AS DOUBLE) AS total_amount,
       CAST(sum(coalesce(CAST(t.amount AS DECIMAL(18,2)), 0)) AS DOUBLE) / count(*) AS avg_amount
FROM {tx} t LEFT JOIN {acc} a ON t.account_id = a.account_id GROUP BY 1, 2"""


def fact_segment_sql(seg: str) -> str:
    order = "assigned_at DESC NULLS FIRST, " + _nf("segment_name, segment_score")
    return (f"SELECT customer_id, segment_name, segment_score, assigned_at, updated_at FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY customer_id ORDER BY {order}) AS rn FROM {seg}) s WHERE rn = 1")


cte("fact_tx_t1", fact_tx_sql("stg_transactions_b1", "stg_accounts", RUN1), "stg_transactions_b1", "stg_accounts")
cte("fact_tx_r2", fact_tx_sql("stg_transactions_r2", "stg_accounts_r2", RUN2), "stg_transactions_r2", "stg_accounts_r2")
cte("activity", activity_sql("stg_transactions", "stg_accounts"), "stg_transactions", "stg_accounts")
cte("activity_t1", activity_sql("stg_transactions_b1", "stg_accounts"), "stg_transactions_b1", "stg_accounts")
cte("activity_r2", activity_sql("stg_transactions_r2", "stg_accounts_r2"), "stg_transactions_r2", "stg_accounts_r2")
cte("activity_strict_batch", "SELECT * FROM activity_r2 WHERE activity_date > "
    "(SELECT coalesce(max(activity_date), DATE '1970-01-01') FROM activity_t1)", "activity_r2", "activity_t1")
cte("activity_recompute_batch", "SELECT * FROM activity_r2 WHERE activity_date >= "
    "(SELECT coalesce(max(activity_date), DATE '1970-01-01') FROM activity_t1)", "activity_r2", "activity_t1")
cte("fact_segment", fact_segment_sql("stg_customer_segments"), "stg_customer_segments")
cte("fact_segment_t1", fact_segment_sql("stg_customer_segments_b1"), "stg_customer_segments_b1")
cte("fact_segment_batch2", f"SELECT * FROM ({fact_segment_sql('stg_customer_segments_b2')}) x WHERE assigned_at > "
    "(SELECT coalesce(max(assigned_at), TIMESTAMP '1970-01-01 00:00:00') FROM fact_segment_t1)",
    "stg_customer_segments_b2", "fact_segment_t1")
cte("dim_profile", "SELECT customer_id, total_transactions, total_transfer_amount, avg_transaction_amount, login_frequency, "
    "preferred_transaction_type, favorite_feature, last_active_date, risk_score, updated_at FROM d15", "d15")

# ---- history ---------------------------------------------------------------------------------------
ACC_COLS = ["account_id", "customer_id", "account_type", "balance", "currency", "created_at"]
PROFILE_COLS = ["customer_id", "total_transactions", "total_transfer_amount", "avg_transaction_amount", "login_frequency",
                "preferred_transaction_type", "favorite_feature", "last_active_date", "risk_score", "updated_at"]


def _cols(alias: str, cols: list[str]) -> str:
    return ", ".join(f"{alias}.{c}" for c in cols)


def scd2_step_sql(h: str, s: str, key: str, cols: list[str], changed: str, start: str) -> str:
    """Open history `h` (cols + valid_from, valid_to) against source `s`."""
    return f"""SELECT {_cols('h', cols)}, h.valid_from, h.valid_to FROM {h} h LEFT JOIN {s} s ON h.{key} = s.{key}
WHERE s.{key} IS NULL OR NOT ({changed})
UNION ALL
SELECT {_cols('h', cols)}, h.valid_from, {start} AS valid_to FROM {h} h JOIN {s} s ON h.{key} = s.{key} WHERE {changed}
UNION ALL
SELECT {_cols('s', cols)}, {start} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM {s} s LEFT JOIN {h} h ON h.{key} = s.{key}
WHERE h.{key} IS NULL OR ({changed})"""


def present_sql(src: str, cols: list[str]) -> str:
    return (f"SELECT {', '.join(cols)}, valid_from AS effective_from, valid_to AS effective_to, "
            f"(valid_to IS NULL) AS is_current FROM {src}")


cte("acc_h1", f"SELECT {', '.join(ACC_COLS)}, TIMESTAMP '{RUN1}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM stg_accounts",
    "stg_accounts")
_acc_changed = " OR ".join(f"h.{c} IS DISTINCT FROM s.{c}" for c in ("customer_id", "account_type", "balance"))
cte("acc_h2", scd2_step_sql("acc_h1", "stg_accounts_b2", "account_id", ACC_COLS, _acc_changed, f"TIMESTAMP '{RUN2}'"),
    "acc_h1", "stg_accounts_b2")
cte("prof_h1", f"SELECT {', '.join(PROFILE_COLS)}, updated_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to "
    "FROM stg_customer_profiles", "stg_customer_profiles")
cte("prof_h2", scd2_step_sql("prof_h1", "stg_customer_profiles_b2", "customer_id", PROFILE_COLS,
                             "coalesce(s.updated_at > h.updated_at, FALSE)", "s.updated_at"),
    "prof_h1", "stg_customer_profiles_b2")

cte("customers_b2", "SELECT * REPLACE (CASE WHEN id % 7 = 0 THEN 'new-' || email ELSE email END AS email) FROM customers WHERE id % 7 <> 1", "customers")
cte("services_b2", """SELECT * REPLACE (is_active AND id % 4 <> 0 AS is_active, CASE id % 4 WHEN 1 THEN service_name || ' plus' ELSE service_name END AS service_name,
  CASE id % 4 WHEN 2 THEN service_code || '_B' ELSE service_code END AS service_code) FROM services""", "services")
CUST_COLS = ["customer_id", "first_name", "last_name", "email", "created_at"]
SVC_COLS = ["service_id", "service_code", "service_name", "category", "is_active", "created_at"]
SEG_COLS = ["customer_id", "segment_name", "segment_score", "assigned_at", "updated_at"]
for _t, _h, _key, _c, _checked in (
    ("customers", "cust", "customer_id", CUST_COLS, ("first_name", "last_name", "email")),
    ("services", "svc", "service_id", SVC_COLS, ("service_name", "category", "is_active")),
):
    cte(f"stg_{_t}_b2", staging_sql(_t, f"{_t}_b2", RUN2), f"{_t}_b2")
    cte(f"{_h}_h1", f"SELECT {', '.join(_c)}, TIMESTAMP '{RUN1}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM stg_{_t}", f"stg_{_t}")
    _differs = " OR ".join(f"h.{x} IS DISTINCT FROM s.{x}" for x in _checked)
    cte(f"{_h}_h2", scd2_step_sql(f"{_h}_h1", f"stg_{_t}_b2", _key, _c, _differs, f"TIMESTAMP '{RUN2}'"), f"{_h}_h1", f"stg_{_t}_b2")
cte("seg_h1", f"SELECT {', '.join(SEG_COLS)}, assigned_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM stg_customer_segments", "stg_customer_segments")
cte("seg_h2", scd2_step_sql("seg_h1", "stg_customer_segments_b2", "customer_id", SEG_COLS, "coalesce(s.assigned_at > h.assigned_at, FALSE)", "s.assigned_at"),
    "seg_h1", "stg_customer_segments_b2")
cte("stg_service_usage_r2", staging_sql("service_usage", "service_usage", RUN2), "service_usage")

LINEITEM_ORDER = "l_shipdate ASC NULLS FIRST, l_linenumber ASC NULLS FIRST, l_partkey ASC NULLS FIRST, l_suppkey ASC NULLS FIRST"
LOG_COLS = "l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_quantity"


def _with(needs: list[str]) -> str:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for n in needs:
        visit(n)
    if not seen:
        return ""
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in seen) + "\n"


def q(body: str, *needs: str) -> str:
    return _with(list(needs)) + body


def _oracle() -> dict[str, str]:
    o: dict[str, str] = {}
    for t in TABLES:
        o[f"stg_{t}"] = q(f"SELECT * FROM stg_{t}", f"stg_{t}")
    o["latest_version_per_key"] = (
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS FIRST, "
        "l_linenumber ASC, l_partkey ASC, l_suppkey ASC) AS rn FROM lineitem) x WHERE rn = 1"
    )
    o["fct_service_usage"] = q("SELECT * FROM fct_service_usage", "fct_service_usage")
    o["agg_service_frequency"] = q("SELECT * FROM agg_service_frequency", "agg_service_frequency")
    o["agg_service_usage_daily"] = q(
        "SELECT usage_date, service_id, service_name, category, channel, count(*) AS total_uses, "
        "count(DISTINCT customer_id) AS distinct_customers FROM fct_service_usage GROUP BY 1, 2, 3, 4, 5", "fct_service_usage")
    o["agg_customer_service_freq"] = q(
        "SELECT customer_id, service_id, service_name, category, count(*) AS total_uses, min(used_at) AS first_used_at, "
        "max(used_at) AS last_used_at FROM fct_service_usage GROUP BY 1, 2, 3, 4", "fct_service_usage")
    o["usage_second_run"] = q(
        "SELECT * FROM fct_usage_t1 UNION ALL " + fct_usage_sql("stg_service_usage_b2", RUN2, "fct_usage_t1"),
        "fct_usage_t1", "stg_service_usage_b2", "dim_services")
    o["preferred_type"] = q("SELECT customer_id, transaction_type AS preferred_transaction_type FROM type_counts WHERE rn = 1",
                            "type_counts")
    o["int_customer_transactions"] = q("SELECT * FROM d13", "d13")
    o["int_customer_behavior"] = q("SELECT * FROM d14", "d14")
    o["int_customer_metrics"] = q("SELECT * FROM d15", "d15")
    o["metrics_second_run"] = q(merge_sql("d15_t1", "d15_batch2", ["customer_id"]), "d15_t1", "d15_batch2")
    o["dim_customer_profile"] = q("SELECT * FROM dim_profile", "dim_profile")
    o["fact_transactions"] = q(fact_tx_sql("stg_transactions", "stg_accounts", RUN1), "stg_transactions", "stg_accounts")
    o["transactions_second_run"] = q(merge_sql("fact_tx_t1", "fact_tx_r2", ["transaction_id"]), "fact_tx_t1", "fact_tx_r2")
    o["fact_customer_activity"] = q("SELECT * FROM activity", "activity")
    o["activity_second_run"] = q("SELECT * FROM activity_t1 UNION ALL SELECT * FROM activity_strict_batch",
                                 "activity_t1", "activity_strict_batch")
    o["activity_recompute_run"] = q(merge_sql("activity_t1", "activity_recompute_batch", ["customer_id", "activity_date"]),
                                    "activity_t1", "activity_recompute_batch")
    o["fact_customer_segment"] = q("SELECT * FROM fact_segment", "fact_segment")
    o["segment_second_run"] = q(merge_sql("fact_segment_t1", "fact_segment_batch2", ["customer_id"]),
                                "fact_segment_t1", "fact_segment_batch2")
    o["dim_customers"] = q(
        f"SELECT customer_id, first_name, last_name, email, created_at, TIMESTAMP '{RUN1}' AS effective_from, "
        "CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current FROM stg_customers", "stg_customers")
    o["dim_accounts"] = q(present_sql("acc_h1", ACC_COLS), "acc_h1")
    o["dim_services"] = q("SELECT * FROM dim_services", "dim_services")
    o["scd2_check_second"] = q(present_sql("acc_h2", ACC_COLS), "acc_h2")
    o["scd2_timestamp_second"] = q(present_sql("prof_h2", PROFILE_COLS), "prof_h2")
    o["segments_history"] = q(
        "SELECT customer_id, segment_name, segment_score, assigned_at, updated_at, assigned_at AS effective_from, "
        "CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current FROM stg_customer_segments", "stg_customer_segments")
    o["scd2_log"] = f"""SELECT *, valid_to IS NULL AS is_current FROM (
  SELECT {LOG_COLS}, l_shipdate AS valid_from,
         lead(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY {LINEITEM_ORDER}) AS valid_to
  FROM (SELECT {LOG_COLS}, row_number() OVER w AS rn, lag(l_returnflag) OVER w AS p_rf, lag(l_linestatus) OVER w AS p_ls,
               lag(l_quantity) OVER w AS p_q
        FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY {LINEITEM_ORDER})) o
  WHERE rn = 1 OR p_rf IS DISTINCT FROM l_returnflag OR p_ls IS DISTINCT FROM l_linestatus OR p_q IS DISTINCT FROM l_quantity
) v"""
    o["segment_rules"] = q("SELECT * FROM customer_segments", "customer_segments")
    o["raw_typed_extract"] = q(
        "SELECT CAST(customer_id AS VARCHAR) AS customer_id, total_transactions, "
        f"{_num('risk_score')} AS risk_number, risk_score, preferred_transaction_type, last_active_date "
        "FROM customer_profiles", "customer_profiles")
    o["scd2_check_first"] = q(
        f"SELECT {', '.join(ACC_COLS)}, TIMESTAMP '{RUN1}' AS version_updated_at, TIMESTAMP '{RUN1}' AS valid_from, "
        "CAST(NULL AS TIMESTAMP) AS valid_to FROM stg_accounts", "stg_accounts")
    o["report_top_services"] = q(
        "SELECT usage_rank, service_name, category, total_uses, distinct_customers, pct_share FROM agg_service_frequency "
        "ORDER BY usage_rank, service_id LIMIT 10", "agg_service_frequency")
    o["customers_second_run"] = q(present_sql("cust_h2", CUST_COLS), "cust_h2")
    o["services_second_run"] = q(present_sql("svc_h2", SVC_COLS), "svc_h2")
    o["segments_second_run"] = q(present_sql("seg_h2", SEG_COLS), "seg_h2")
    o["version_ids"] = q("SELECT account_id, valid_from, valid_to, md5(account_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) AS version_id, "
                         "valid_from AS version_updated_at FROM acc_h2", "acc_h2")
    o["usage_after_service_change"] = q(
        f"""SELECT u.usage_id, u.customer_id, u.account_id, u.service_id, n.service_code, n.service_name, n.category, u.channel, u.status, u.used_at,
  CAST(u.used_at AS DATE) AS usage_date, TIMESTAMP '{RUN2}' AS load_timestamp
FROM stg_service_usage_r2 u LEFT JOIN (SELECT * FROM svc_h2 WHERE valid_to IS NULL) n USING (service_id)""", "stg_service_usage_r2", "svc_h2")
    merged = merge_sql("d15_t1", "d15_batch2", ["customer_id"])
    o["profile_dim_second_run"] = q(
        f"""SELECT customer_id, total_transactions, total_transfer_amount, avg_transaction_amount, login_frequency, preferred_transaction_type,
  favorite_feature, last_active_date, risk_score, updated_at FROM ({merged}) m""", "d15_t1", "d15_batch2")
    o["activity_late_days"] = q("SELECT * FROM activity_r2", "activity_r2")
    o["report_recent_activity"] = q(
        "SELECT customer_id, activity_date, transactions_count, total_amount FROM activity "
        "ORDER BY activity_date DESC, customer_id ASC NULLS FIRST LIMIT 20", "activity")
    o["report_segment_counts"] = q("SELECT segment_name, count(*) AS customers FROM fact_segment GROUP BY segment_name",
                                   "fact_segment")
    for n, name in ((10, "report_top_risk"), (5, "report_top_risk_5")):
        o[name] = q(f"SELECT customer_id, risk_score FROM dim_profile ORDER BY risk_score DESC NULLS LAST, "
                    f"customer_id ASC NULLS FIRST LIMIT {n}", "dim_profile")
    return o


ORACLE: dict[str, str] = _oracle()


# ---- ingest side ----------------------------------------------------------------------------
TX_KEPT = "id % 13 <> 0 AND id % 17 <> 0"
STG_TX_COLS = ("CAST(id AS VARCHAR) AS transaction_id, CAST(account_id AS VARCHAR) AS account_id, amount, "
               "txn_type AS transaction_type, CAST(related_account_id AS VARCHAR) AS related_account_id, status, "
               "created_at AS transaction_time")
ORACLE_INGEST = {
    "after_image_extract": q(f"SELECT {STG_TX_COLS}, id AS _ts_ms FROM transactions WHERE {TX_KEPT}", "transactions"),
    "quarantined_events": q("SELECT 'banking_server.public.transactions' AS topic, 'not json ' || CAST(id AS VARCHAR) AS value "
                            "FROM transactions WHERE id % 19 = 0", "transactions"),
    "normalize_changes": q("""SELECT 'customers' AS change_table, CASE WHEN id % 6 = 0 THEN 'staging' ELSE 'public' END AS change_schema,
       op, 'banking_server.public.customers' AS topic,
       CASE WHEN op = 'd' THEN NULL ELSE id END AS after_id, CASE WHEN op = 'd' THEN NULL ELSE email END AS after_email,
       id AS before_id
FROM (SELECT *, CASE WHEN id % 10 = 7 THEN 'r' WHEN id % 3 = 0 THEN 'c' WHEN id % 3 = 1 THEN 'u' ELSE 'd' END AS op
      FROM customers WHERE id % 23 <> 0 AND id % 11 <> 0) c""", "customers"),
    "lake_refresh": q("SELECT * EXCLUDE (load_timestamp) FROM stg_service_usage", "stg_service_usage"),
    "load_audit": q("SELECT 'service_usage' AS \"table\", 12 AS files, count(*) AS \"rows\", 2 AS skipped_files, 0 AS lost_rows, "
                    "count(*) FILTER (id % 19 = 0 OR id % 23 = 0) AS bad_lines FROM service_usage", "service_usage"),
    "stream_to_lake": q(f"SELECT {STG_TX_COLS} FROM transactions WHERE {TX_KEPT}", "transactions"),
    "stream_upsert": q(f"""SELECT {STG_TX_COLS}, _ts_ms FROM (
  SELECT id, account_id, txn_type, CASE WHEN id % 3 = 0 THEN amount + 1 ELSE amount END AS amount, related_account_id, status,
         created_at, id + 1000000000000 AS _ts_ms FROM transactions WHERE {TX_KEPT}
  UNION ALL
  SELECT t.id, t.account_id, t.txn_type, t.amount, t.related_account_id, t.status, t.created_at, t.id AS _ts_ms
  FROM transactions_b1 t WHERE t.{TX_KEPT.replace(' AND ', ' AND t.')}
    AND NOT (t.id % 13 <> 0 AND t.id % 17 <> 0 AND t.id IN (SELECT id FROM transactions WHERE {TX_KEPT}))
) x""", "transactions", "transactions_b1"),
    "safe_number_cast": """SELECT event_id, TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(38,0)) AS value_0,
       TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(38,1)) AS value_1, TRY_CAST(event_type AS DECIMAL(38,0)) AS type_number,
       TRY_CAST('-' || CAST(value AS VARCHAR) AS DECIMAL(38,0)) AS negated_0 FROM events""",
}
ORACLE_INGEST["pipeline_service_frequency"] = ORACLE["agg_service_frequency"]
ORACLE.update(ORACLE_INGEST)


# ---- data-quality checks -------------------------------------------------------------------
cte("dim_customers_t", f"SELECT customer_id, first_name, last_name, email, created_at, TIMESTAMP '{RUN1}' AS effective_from, "
    "CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current FROM stg_customers", "stg_customers")
cte("dim_accounts_t", present_sql("acc_h1", ACC_COLS), "acc_h1")
cte("fact_tx", fact_tx_sql("stg_transactions", "stg_accounts", RUN1), "stg_transactions", "stg_accounts")
QUALITY_SOURCES = {
    "stg_services": "stg_services", "stg_service_usage": "stg_service_usage", "dim_services": "dim_services",
    "fct_service_usage": "fct_service_usage", "agg_service_frequency": "agg_service_frequency",
    "stg_customers": "stg_customers", "stg_accounts": "stg_accounts", "stg_transactions": "stg_transactions",
    "dim_customers": "dim_customers_t", "dim_accounts": "dim_accounts_t", "fact_transactions": "fact_tx",
    "stg_customer_profiles": "stg_customer_profiles", "stg_customer_segments": "stg_customer_segments",
    "dim_customer_profile": "dim_profile", "fact_customer_segment": "fact_segment", "fact_customer_activity": "activity",
}


def _check_sql(dataset: str, exp) -> str:
    src = QUALITY_SOURCES[dataset]
    c = exp.column
    head = f"SELECT '{exp.label}' AS check_name, '{dataset}' AS dataset, '{c}' AS column_name, "
    if exp.check == "not_null":
        return head + f"count(*) FILTER (WHERE {c} IS NULL) AS failed_rows FROM {src}"
    if exp.check == "unique":
        return head + f"(SELECT count(*) FROM (SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) d) AS failed_rows"
    if exp.check == "relationships":
        parent = QUALITY_SOURCES[exp.parent]
        return head + (f"(SELECT count(*) FROM {src} k WHERE k.{c} IS NOT NULL AND CAST(k.{c} AS VARCHAR) NOT IN "
                       f"(SELECT CAST({exp.parent_column} AS VARCHAR) FROM {parent} WHERE {exp.parent_column} IS NOT NULL)) AS failed_rows")
    if exp.check == "predicate":
        return head + f"count(*) FILTER (WHERE NOT coalesce({exp.predicate}, TRUE)) AS failed_rows FROM {src}"
    if exp.check == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in exp.values)
        return head + f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({vals})) AS failed_rows FROM {src}"
    raise ValueError(exp.check)


def _suite_sql(suite) -> str:
    needs = sorted({QUALITY_SOURCES[d] for d in suite} | {QUALITY_SOURCES[e.parent] for es in suite.values() for e in es if e.parent})
    body = "\nUNION ALL\n".join(_check_sql(d, e) for d, es in suite.items() for e in es)
    return q(body, *needs)


def _quality_oracle() -> dict[str, str]:
    from ledgerlake.plans.checks import DDL, DECLARED

    return {"quality_declared": _suite_sql(DECLARED), "quality_ddl": _suite_sql(DDL)}


ORACLE.update(_quality_oracle())
