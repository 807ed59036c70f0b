"""DuckDB twins of the named queries, built from shared common table expressions."""

from __future__ import annotations

import re

EXPECTED_SHARE = {1: 0.301, 2: 0.176, 3: 0.125, 4: 0.097, 5: 0.079, 6: 0.067, 7: 0.058, 8: 0.051, 9: 0.046}

INVOICE_COLUMNS = """invoice_id, vendor_id, invoice_date, submission_timestamp, payment_date, due_date, amount,
    quantity, unit_price, currency, requester, approver, purchase_order_id, contract_id, payment_terms,
    payment_method, invoice_status, department, description, tax_amount, discount"""


def half_up(x: str, digits: int) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"floor(({x}) * {scale} + 0.5) / {scale}"


def pick(values: list, key: str) -> str:
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"([{items}])[CAST(({key}) % {len(values)} AS INTEGER) + 1]"


TERMS = pick([15, 30, 45, 60], "l_suppkey")

CTES: dict[str, str] = {}

CTES["ven"] = f"""
SELECT 'V' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS vendor_id,
    '  ' || s_name || ' ' AS vendor_name,
    {pick(["Office Supplies", "IT Equipment", "Software", "Manufacturing", "Logistics", "Maintenance",
           "Consulting", "Furniture"], "s_nationkey")} AS vendor_category,
    'BANK' || lpad(CAST(s_suppkey - CASE WHEN s_suppkey % 10 = 1 THEN 1 ELSE 0 END AS VARCHAR), 6, '0')
        AS bank_account_id,
    ' ' || n_name || ', ' || r_name || ' ' AS vendor_address,
    DATE '1993-01-01' + CAST((s_suppkey * 37) % 700 AS INTEGER) AS onboarding_date,
    CAST({pick([15, 30, 45, 60], "s_suppkey")} AS INTEGER) AS payment_terms
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

CTES["inv"] = f"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT), CAST(l_shipdate AS DATE)) AS invoice_id,
    'V' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS vendor_id,
    CAST(o_orderdate AS DATE) AS invoice_date,
    o_orderdate + to_seconds((l_partkey * 997 + l_linenumber * 61) % 86400) AS submission_timestamp,
    CAST(o_orderdate AS DATE) + CAST({TERMS} AS INTEGER)
        + CAST((l_orderkey + l_linenumber) % 14 - 3 AS INTEGER) AS payment_date,
    CAST(o_orderdate AS DATE) + CAST({TERMS} AS INTEGER) AS due_date,
    l_extendedprice AS amount,
    CAST(l_quantity AS INTEGER) AS quantity,
    {half_up("l_extendedprice / l_quantity", 2)} AS unit_price,
    'INR' AS currency,
    'EMP' || lpad(CAST(o_custkey % 300 + 1 AS VARCHAR), 4, '0') AS requester,
    'MGR' || lpad(CAST(o_custkey % 40 + 1 AS VARCHAR), 3, '0') AS approver,
    'PO' || CAST(100000 + l_orderkey % 900000 AS VARCHAR) AS purchase_order_id,
    'CTR' || CAST(10000 + l_partkey % 90000 AS VARCHAR) AS contract_id,
    CAST({TERMS} AS INTEGER) AS payment_terms,
    {pick(["Bank Transfer", "NEFT", "RTGS", "IMPS"], "o_orderkey")} AS payment_method,
    'Paid' AS invoice_status,
    {pick(["Finance", "IT", "Operations", "Manufacturing", "HR", "Procurement", "Marketing", "Administration"],
          "o_custkey")} AS department,
    p_name AS description,
    {half_up("l_extendedprice * l_tax", 2)} AS tax_amount,
    {half_up("l_extendedprice * l_discount", 2)} AS discount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

CTES["sven"] = """
SELECT vendor_id, trim(vendor_name) AS vendor_name, vendor_category, bank_account_id,
    trim(vendor_address) AS vendor_address, onboarding_date, payment_terms FROM ven"""

CTES["stg"] = """
SELECT i.invoice_id, i.vendor_id, v.vendor_name, v.vendor_category, v.bank_account_id, i.invoice_date,
    i.submission_timestamp, i.payment_date, i.due_date, i.amount, i.quantity, i.unit_price, i.discount, i.tax_amount,
    i.currency, i.payment_terms, i.payment_method, i.invoice_status, i.department, i.requester, i.approver,
    i.purchase_order_id, i.contract_id, i.description,
    date_diff('day', i.invoice_date, i.payment_date) AS days_to_payment,
    date_diff('day', i.due_date, i.payment_date) AS days_past_due,
    extract(year FROM i.invoice_date) AS invoice_year,
    extract(month FROM i.invoice_date) AS invoice_month,
    extract(day FROM i.invoice_date) AS invoice_day,
    extract(dow FROM i.invoice_date) AS invoice_weekday,
    CASE WHEN i.discount > 0 THEN 1 ELSE 0 END AS has_discount,
    CASE WHEN i.tax_amount > 0 THEN 1 ELSE 0 END AS has_tax
FROM inv i LEFT JOIN sven v ON i.vendor_id = v.vendor_id"""

CTES["hist"] = """
SELECT *,
    count(*) OVER v AS vendor_invoice_count,
    avg(amount) OVER v AS vendor_avg_amount,
    stddev_samp(amount) OVER v AS vendor_std_amount,
    min(amount) OVER v AS vendor_min_amount,
    max(amount) OVER v AS vendor_max_amount,
    row_number() OVER o AS vendor_invoice_number,
    lag(amount) OVER o AS previous_invoice_amount,
    lag(invoice_date) OVER o AS previous_invoice_date,
    lag(days_to_payment) OVER o AS previous_payment_delay,
    avg(amount) OVER r AS rolling_avg_amount,
    stddev_samp(amount) OVER r AS rolling_std_amount,
    sum(amount) OVER r AS rolling_total_amount,
    avg(days_to_payment) OVER r AS rolling_avg_days_to_payment,
    sum(amount) OVER (PARTITION BY vendor_id ORDER BY invoice_date) AS cumulative_vendor_spend,
    count(*) OVER (PARTITION BY bank_account_id) AS bank_account_vendor_count,
    CASE WHEN amount % 100 = 0 THEN 1 ELSE 0 END AS is_round_100,
    CASE WHEN amount % 1000 = 0 THEN 1 ELSE 0 END AS is_round_1000
FROM stg
WINDOW v AS (PARTITION BY vendor_id),
    o AS (PARTITION BY vendor_id ORDER BY invoice_date, invoice_id),
    r AS (PARTITION BY vendor_id ORDER BY invoice_date, invoice_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""

CTES["mart_full"] = """
SELECT *, date_diff('day', previous_invoice_date, invoice_date) AS days_since_previous_invoice,
    CASE WHEN vendor_std_amount IS NULL OR vendor_std_amount = 0 THEN 0.0
        ELSE (amount - vendor_avg_amount) / vendor_std_amount END AS vendor_amount_zscore,
    CASE WHEN amount <= 50000 THEN 50000 - amount END AS amount_to_threshold_distance,
    extract(hour FROM submission_timestamp) AS submission_hour,
    extract(dow FROM submission_timestamp) AS submission_day_of_week
FROM hist"""

MART_DIGITS = {
    "vendor_avg_amount": 6,
    "vendor_std_amount": 4,
    "rolling_avg_amount": 4,
    "rolling_std_amount": 4,
    "rolling_total_amount": 2,
    "rolling_avg_days_to_payment": 4,
    "cumulative_vendor_spend": 2,
    "vendor_amount_zscore": 4,
    "amount_to_threshold_distance": 4,
}
CTES["mart"] = (
    "SELECT * REPLACE ("
    + ", ".join(f"{half_up(c, d)} AS {c}" for c, d in MART_DIGITS.items())
    + ") FROM mart_full"
)

_shares = ", ".join(f"avg(CASE WHEN digit = {k} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS share_{k}" for k in EXPECTED_SHARE)
_terms = " + ".join(
    f"(share_{k} - {e}::DOUBLE) * (share_{k} - {e}::DOUBLE) / {e}::DOUBLE" for k, e in EXPECTED_SHARE.items()
)
CTES["digits"] = """
SELECT vendor_id, CAST(left(CAST(CAST(floor(abs(amount)) AS BIGINT) AS VARCHAR), 1) AS INTEGER) AS digit FROM inv"""
CTES["shares"] = f"""
SELECT vendor_id, count(*) AS invoice_count, {_shares} FROM digits GROUP BY vendor_id HAVING count(*) >= 30"""
CTES["scores"] = f"SELECT vendor_id, invoice_count, {half_up(_terms, 4)} AS chi_square_score FROM shares"
CTES["benford"] = """
SELECT *, CASE WHEN chi_square_score >
        (SELECT avg(chi_square_score) + 2 * stddev_samp(chi_square_score) FROM scores)
    THEN 1 ELSE 0 END AS benford_flag FROM scores"""

CTES["near"] = """
SELECT *, 50000 - amount AS distance_from_threshold, year(invoice_date) || 'Q' || quarter(invoice_date) AS quarter
FROM inv WHERE amount >= 49000 AND amount < 50000"""
CTES["gaming"] = """
SELECT *, CASE WHEN vendor_threshold_count >= 3 THEN 1 ELSE 0 END AS threshold_flag
FROM (SELECT *, count(*) OVER (PARTITION BY vendor_id, quarter) AS vendor_threshold_count FROM near)"""

CTES["accounts"] = """
SELECT bank_account_id, count(DISTINCT vendor_id) AS vendor_count FROM ven
WHERE bank_account_id IS NOT NULL GROUP BY bank_account_id"""
CTES["shell"] = """
SELECT v.*, a.vendor_count, CASE WHEN a.vendor_count >= 2 THEN 1 ELSE 0 END AS shell_vendor_flag
FROM ven v LEFT JOIN accounts a ON v.bank_account_id = a.bank_account_id"""

CTES["texted"] = r"""
SELECT invoice_id, vendor_id, invoice_date, amount,
    array_to_string(list_sort(string_split(trim(regexp_replace(description, '\s+', ' ', 'g')), ' ')), ' ') AS text
FROM inv"""
CTES["texts"] = "SELECT DISTINCT text, string_split(text, '') AS letters FROM texted"
CTES["scored"] = """
SELECT text, other_text, 200.0::DOUBLE * lcs / (length(text) + length(other_text)) AS similarity FROM (
    SELECT a.text AS text, b.text AS other_text,
        list_reduce(list_transform(range(1, len(a.letters) + 1), lambda i: [i]),
            lambda row, i: list_reduce(list_transform(range(1, len(b.letters) + 1), lambda j: [j]),
                lambda cur, j: list_append(cur, CASE WHEN a.letters[i[1]] = b.letters[j[1]] THEN row[j[1]] + 1
                    ELSE greatest(row[j[1] + 1], cur[j[1]]) END),
                [0::BIGINT]),
            list_transform(range(0, len(b.letters) + 1), lambda z: 0::BIGINT))[-1] AS lcs
    FROM texts a JOIN texts b ON a.text <> b.text)"""
CTES["alike"] = """
SELECT text, other_text, similarity FROM scored UNION ALL SELECT text, text, 100.0 FROM texts"""


def pairs(similarity: float, tolerance: float, source: str = "texted") -> str:
    fraction = "abs(a.amount - b.amount) / greatest(a.amount, b.amount)"
    return f"""
SELECT a.invoice_id, b.invoice_id AS matched_invoice, a.vendor_id, {half_up(fraction, 2)} AS amount_difference,
    {half_up("abs(a.amount - b.amount)", 2)} AS amount_gap,
    CAST(date_diff('day', a.invoice_date, b.invoice_date) AS INTEGER) AS days_difference,
    s.similarity AS description_similarity, 1 AS duplicate_flag
FROM {source} a JOIN alike s ON a.text = s.text AND s.similarity >= {similarity}
JOIN {source} b ON a.vendor_id = b.vendor_id AND b.text = s.other_text
    AND date_diff('day', a.invoice_date, b.invoice_date) BETWEEN 0 AND 7
    AND (a.invoice_date < b.invoice_date OR a.invoice_id < b.invoice_id)
WHERE {fraction} <= {tolerance}"""


CTES["pairs90"] = pairs(90, 1.0)
CTES["votes"] = """
SELECT invoice_id, vendor_id, threshold_flag, duplicate_flag, shell_vendor_flag, benford_flag,
    greatest(threshold_flag, duplicate_flag, shell_vendor_flag, benford_flag) AS final_prediction
FROM (SELECT i.invoice_id, i.vendor_id,
        CASE WHEN i.invoice_id IN (SELECT invoice_id FROM gaming WHERE threshold_flag = 1) THEN 1 ELSE 0 END
            AS threshold_flag,
        CASE WHEN i.invoice_id IN (SELECT invoice_id FROM pairs90) THEN 1 ELSE 0 END AS duplicate_flag,
        coalesce(s.shell_vendor_flag, 0) AS shell_vendor_flag, coalesce(b.benford_flag, 0) AS benford_flag
    FROM inv i LEFT JOIN shell s ON i.vendor_id = s.vendor_id LEFT JOIN benford b ON i.vendor_id = b.vendor_id)"""

CTES["picked"] = """
SELECT *, CAST(1 + ('0x' || left(md5(invoice_id), 8))::BIGINT % 5 AS INTEGER) AS shift FROM inv
ORDER BY md5(invoice_id || '|42'), invoice_id LIMIT 100"""
_new_amount = half_up("amount + 0.01::DOUBLE", 2)
CTES["copies"] = f"""
SELECT 'DUP-' || invoice_id AS invoice_id, vendor_id, invoice_date + shift AS invoice_date,
    submission_timestamp + to_days(shift) AS submission_timestamp, payment_date + shift AS payment_date,
    due_date + shift AS due_date, {_new_amount} AS amount, quantity,
    {half_up(f"{_new_amount} / quantity", 2)} AS unit_price, currency, requester, approver, purchase_order_id,
    contract_id, payment_terms, payment_method, invoice_status, department, description,
    {half_up(f"{_new_amount} * (tax_amount / amount)", 2)} AS tax_amount, discount, invoice_id AS source_invoice, shift
FROM picked"""
CTES["truth"] = """
SELECT invoice_id, 1 AS fraud_label, 'Duplicate Invoice' AS fraud_type, source_invoice,
    '{"amount_delta":0.01,"date_shift_days":' || shift || ',"same_vendor":true,"same_description":true}' AS parameters,
    shift
FROM copies"""


def with_ctes(sql: str, replaced: dict[str, str] | None = None) -> str:
    """Prefix a query with the common table expressions it reaches."""
    ctes = CTES | (replaced or {})
    needed: set[str] = set()

    def reach(text: str) -> None:
        for name in ctes:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                reach(ctes[name])

    reach(sql)
    order: list[str] = []

    def place(name: str) -> None:
        if name in order:
            return
        for other in ctes:
            if other != name and other in needed and re.search(rf"\b{other}\b", ctes[name]):
                place(other)
        order.append(name)

    for name in ctes:
        if name in needed:
            place(name)
    body = ",\n".join(f"{name} AS MATERIALIZED ({ctes[name]})" for name in order)
    return f"WITH {body}\n{sql}" if order else sql


# Evaluation runs on originals plus copies: the same expressions over a wider table.
_INJECTED = {
    "base_inv": CTES["inv"],
    "picked": CTES["picked"].replace("FROM inv", "FROM base_inv"),
    "inv": f"SELECT {INVOICE_COLUMNS} FROM base_inv UNION ALL SELECT {INVOICE_COLUMNS} FROM copies",
}
_BOTH_SIDES = {
    "votes": CTES["votes"].replace(
        "(SELECT invoice_id FROM pairs90)",
        "(SELECT invoice_id FROM pairs90 UNION ALL SELECT matched_invoice FROM pairs90)",
    )
}
CTES["judged"] = """
SELECT v.*, coalesce(t.fraud_label, 0) AS fraud_label, coalesce(t.fraud_type, 'normal') AS fraud_type
FROM votes v LEFT JOIN truth t ON v.invoice_id = t.invoice_id"""
CTES["outcome"] = """
SELECT count(*) FILTER (fraud_label = 1 AND final_prediction = 1)::DOUBLE AS tp,
    count(*) FILTER (fraud_label = 0 AND final_prediction = 1)::DOUBLE AS fp,
    count(*) FILTER (fraud_label = 1 AND final_prediction = 0)::DOUBLE AS fn,
    count(*) FILTER (fraud_label = 0 AND final_prediction = 0)::DOUBLE AS tn FROM judged"""
CTES["class_rates"] = """
SELECT *, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
    coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
    tn + fp AS s0, tp + fn AS s1, tp + fp + fn + tn AS total FROM outcome"""
CTES["rates"] = """
SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1
FROM class_rates"""


def on_injected(sql: str) -> str:
    return with_ctes(sql, _INJECTED | _BOTH_SIDES)


def mart(*columns: str) -> str:
    return with_ctes(f"SELECT invoice_id, {', '.join(columns)} FROM mart")


HISTORY_COLUMNS = [
    "vendor_invoice_count", "vendor_avg_amount", "vendor_std_amount", "vendor_min_amount", "vendor_max_amount",
    "vendor_invoice_number", "previous_invoice_amount", "previous_invoice_date", "previous_payment_delay",
    "rolling_avg_amount", "rolling_std_amount", "rolling_total_amount", "rolling_avg_days_to_payment",
    "cumulative_vendor_spend", "bank_account_vendor_count",
]


def _report_row(label: str, p: str, r: str, f: str, support: str) -> str:
    p = "NULL" if p == "NULL" else half_up(p, 6)
    r = "NULL" if r == "NULL" else half_up(r, 6)
    return (
        f"SELECT '{label}' AS label, CAST({p} AS DOUBLE) AS precision, CAST({r} AS DOUBLE) AS recall, "
        f"{half_up(f, 6)} AS f1_score, CAST({support} AS BIGINT) AS support FROM rates"
    )


def _weighted(a: str, b: str) -> str:
    return f"({a} * s0 + {b} * s1) / total"


def _null_profile() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing FROM mart_full"
        for c in [
            "invoice_id", "vendor_id", "vendor_name", "vendor_category", "bank_account_id", "invoice_date",
            "submission_timestamp", "payment_date", "due_date", "amount", "quantity", "unit_price", "discount",
            "tax_amount", "currency", "payment_terms", "payment_method", "invoice_status", "department", "requester",
            "approver", "purchase_order_id", "contract_id", "description", "days_to_payment", "days_past_due",
            "invoice_year", "invoice_month", "invoice_day", "invoice_weekday", "has_discount", "has_tax",
            *HISTORY_COLUMNS, "is_round_100", "is_round_1000", "days_since_previous_invoice",
            "vendor_amount_zscore", "amount_to_threshold_distance", "submission_hour", "submission_day_of_week",
        ]
    )
    return f"SELECT column_name, missing FROM ({parts}) ORDER BY missing DESC, column_name LIMIT 10"


def _dq(source: str = "inv") -> str:
    nulls = " + ".join(f"count(*) FILTER ({c.strip()} IS NULL)" for c in INVOICE_COLUMNS.split(","))
    checks = {
        "unique_invoice_id": "count(*) - count(DISTINCT invoice_id)",
        "no_missing_values": nulls,
        "positive_amount": "count(*) FILTER (NOT coalesce(amount > 0, false))",
        "positive_quantity": "count(*) FILTER (NOT coalesce(quantity > 0, false))",
        "positive_unit_price": "count(*) FILTER (NOT coalesce(unit_price > 0, false))",
        "payment_not_before_invoice": "count(*) FILTER (NOT coalesce(payment_date >= invoice_date, false))",
        "due_not_before_invoice": "count(*) FILTER (NOT coalesce(due_date >= invoice_date, false))",
        "single_currency": "count(*) FILTER (NOT coalesce(currency = 'INR', false))",
    }
    rows = " UNION ALL ".join(f"SELECT '{n}' AS \"check\", CAST({c} AS BIGINT) AS violations FROM {source}" for n, c in checks.items())
    return f'SELECT "check", violations, violations = 0 AS passed FROM ({rows})'


def rule_oracles() -> dict[str, str]:
    gaming = "SELECT * REPLACE (" + half_up("distance_from_threshold", 2) + " AS distance_from_threshold) FROM gaming"
    alike = f"SELECT text, other_text, {half_up('similarity', 4)} AS similarity FROM scored WHERE similarity >= 70"
    flags_both = """SELECT invoice_id, 1 AS duplicate_flag FROM
        (SELECT invoice_id FROM pairs90 UNION SELECT matched_invoice FROM pairs90)"""
    report = " UNION ALL ".join(
        [
            _report_row("0", "p0", "r0", "f0", "s0"),
            _report_row("1", "p1", "r1", "f1", "s1"),
            _report_row("accuracy", "NULL", "NULL", "(tp + tn) / total", "total"),
            _report_row("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "total"),
            _report_row(
                "weighted avg", _weighted("p0", "p1"), _weighted("r0", "r1"), _weighted("f0", "f1"), "total"
            ),
        ]
    )
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {t} GROUP BY {c}"
        for t, c in [("inv", "department"), ("inv", "payment_terms"), ("ven", "vendor_category")]
    )
    plain = {
        "raw_invoices": "SELECT * FROM inv",
        "raw_vendors": "SELECT * FROM ven",
        "stg_vendors": "SELECT * FROM sven",
        "stg_invoices": "SELECT * FROM stg",
        "fe_round_flags": "SELECT invoice_id, is_round_100, is_round_1000 FROM hist",
        "benford_digits": "SELECT * FROM shares",
        "benford_scores": "SELECT * FROM scores",
        "benford_flags": "SELECT * FROM benford",
        "benford_top": "SELECT * FROM benford ORDER BY chi_square_score DESC, vendor_id LIMIT 5",
        "threshold_candidates": "SELECT invoice_id, vendor_id, amount, "
        + half_up("distance_from_threshold", 2)
        + " AS distance_from_threshold, quarter FROM near",
        "threshold_counts": "SELECT vendor_id, quarter, count(*) AS vendor_threshold_count FROM near GROUP BY ALL",
        "threshold_flags": gaming,
        "threshold_top": """SELECT invoice_id, vendor_id, quarter, vendor_threshold_count, threshold_flag FROM gaming
            ORDER BY vendor_threshold_count DESC, invoice_id LIMIT 10""",
        "shell_bank_counts": "SELECT * FROM accounts",
        "shell_vendor_flags": "SELECT * FROM shell",
        "shell_flagged_top": "SELECT * FROM shell WHERE shell_vendor_flag = 1 ORDER BY vendor_id LIMIT 20",
        "duplicate_candidate_counts": """SELECT a.vendor_id, CAST(count(b.invoice_id) AS BIGINT) AS candidate_pairs
            FROM inv a LEFT JOIN inv b ON a.vendor_id = b.vendor_id
                AND date_diff('day', a.invoice_date, b.invoice_date) BETWEEN 0 AND 7
                AND (a.invoice_date < b.invoice_date OR a.invoice_id < b.invoice_id)
            GROUP BY a.vendor_id""",
        "description_similarity": alike,
        "duplicate_pairs": "SELECT * FROM pairs90",
        "duplicate_pairs_close_amounts": pairs(90, 0.01),
        "duplicate_pairs_loose_text": pairs(75, 1.0),
        "duplicate_pairs_top": "SELECT * FROM pairs90 ORDER BY invoice_id, matched_invoice LIMIT 5",
        "duplicate_flags": "SELECT DISTINCT invoice_id, 1 AS duplicate_flag FROM pairs90",
        "duplicate_flags_both": flags_both,
        "rule_vote": "SELECT * FROM votes",
        "rule_vote_summary": """SELECT count(*) AS total_invoices, CAST(sum(threshold_flag) AS BIGINT) AS threshold_flags,
            CAST(sum(duplicate_flag) AS BIGINT) AS duplicate_flags,
            CAST(sum(shell_vendor_flag) AS BIGINT) AS shell_vendor_flags,
            CAST(sum(benford_flag) AS BIGINT) AS benford_flags,
            CAST(sum(final_prediction) AS BIGINT) AS flagged_invoices FROM votes""",
        "injected_invoices": f"SELECT {INVOICE_COLUMNS} FROM inv UNION ALL SELECT {INVOICE_COLUMNS} FROM copies",
        "injected_labels": "SELECT invoice_id, fraud_label, fraud_type, source_invoice, parameters FROM truth",
        "label_parameters": """SELECT invoice_id, source_invoice, 0.01::DOUBLE AS amount_delta,
            CAST(shift AS INTEGER) AS date_shift_days, true AS same_vendor, true AS same_description FROM truth""",
        "dq_report": _dq(),
        "amount_profile": f"""SELECT count(amount) AS count, {half_up("avg(amount)", 4)} AS mean,
            {half_up("stddev_samp(amount)", 4)} AS std, min(amount) AS min, max(amount) AS max,
            {half_up("quantile_cont(amount, 0.25)", 4)} AS p25, {half_up("quantile_cont(amount, 0.5)", 4)} AS p50,
            {half_up("quantile_cont(amount, 0.75)", 4)} AS p75 FROM inv""",
        "value_counts": counts,
        "dataset_summary": """SELECT (SELECT count(*) FROM ven) AS total_vendors, count(*) AS total_invoices,
            count(*) AS total_line_items, min(invoice_date) AS first_date, max(invoice_date) AS last_date FROM inv""",
        "null_profile": _null_profile(),
        "line_items": """SELECT invoice_id, 1 AS line_number, description, quantity, unit_price,
            amount AS line_total FROM inv""",
    }
    oracles = {name: with_ctes(sql) for name, sql in plain.items()}
    oracles |= {
        "fe_vendor_stats": mart(*HISTORY_COLUMNS[:5]),
        "fe_history": mart(*HISTORY_COLUMNS[5:9]),
        "fe_rolling": mart(*HISTORY_COLUMNS[9:13]),
        "fe_cumulative": mart("cumulative_vendor_spend"),
        "fe_bank_count": mart("bank_account_id", "bank_account_vendor_count"),
        "fe_derived": mart(
            "days_since_previous_invoice", "vendor_amount_zscore", "amount_to_threshold_distance",
            "submission_hour", "submission_day_of_week",
        ),
        "fe_sliced_history": mart(*HISTORY_COLUMNS),
        "invoice_features": with_ctes("SELECT * FROM mart"),
        "eval_joined": with_ctes("SELECT * FROM judged", _INJECTED),
        "eval_metrics": on_injected(
            f"SELECT {half_up('(tp + tn) / total', 6)} AS accuracy, {half_up('p1', 6)} AS precision, "
            f"{half_up('r1', 6)} AS recall, {half_up('f1', 6)} AS f1_score FROM rates"
        ),
        "eval_confusion": on_injected(
            """SELECT 'Actual Normal' AS actual, CAST(tn AS BIGINT) AS pred_normal, CAST(fp AS BIGINT) AS pred_fraud
            FROM outcome UNION ALL SELECT 'Actual Fraud', CAST(fn AS BIGINT), CAST(tp AS BIGINT) FROM outcome"""
        ),
        "eval_class_report": on_injected(report),
        "eval_by_type": on_injected(
            f"""SELECT fraud_type, count(*) AS total_fraud, CAST(sum(final_prediction) AS BIGINT) AS detected,
            {half_up("sum(final_prediction) / count(*)", 3)} AS recall FROM judged WHERE fraud_label = 1
            GROUP BY fraud_type"""
        ),
    }
    return oracles


NUMERIC = [
    "amount", "unit_price", "discount", "tax_amount", "days_to_payment", "days_past_due", "invoice_year",
    "invoice_month", "invoice_day", "invoice_weekday", *HISTORY_COLUMNS[:7], "previous_payment_delay",
    *HISTORY_COLUMNS[9:], "days_since_previous_invoice", "vendor_amount_zscore", "amount_to_threshold_distance",
    "submission_hour", "submission_day_of_week",
]
CATEGORICAL = [
    "vendor_category", "bank_account_id", "currency", "payment_method", "invoice_status", "department",
]
CTES["modes"] = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS column_name, {c} AS value FROM mart_full WHERE {c} IS NOT NULL GROUP BY {c} "
    f"ORDER BY count(*) DESC, {c} LIMIT 1)"
    for c in CATEGORICAL
)
CTES["middles"] = (
    "SELECT " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in NUMERIC) + " FROM mart_full"
)
CTES["filled"] = (
    "SELECT invoice_id, "
    + ", ".join(f"coalesce(CAST(m.{c} AS DOUBLE), d.{c}) AS {c}" for c in NUMERIC)
    + " FROM mart_full m, middles d"
)
CTES["filled_stats"] = (
    "SELECT "
    + ", ".join(
        f"avg({c}) AS avg_{c}, CASE WHEN min({c}) <> max({c}) THEN stddev_pop({c}) END AS dev_{c}" for c in NUMERIC
    )
    + " FROM filled"
)


METADATA = """invoice_id, vendor_id, vendor_name, invoice_date, submission_timestamp, payment_date, due_date,
    purchase_order_id, contract_id, description, requester, approver"""
CTES["zscores"] = f"""
SELECT {METADATA}, amount, {half_up("abs(vendor_amount_zscore)", 4)} AS reconstruction_error FROM mart_full"""
CTES["zlimit"] = "SELECT quantile_cont(reconstruction_error, 0.98) AS threshold FROM zscores"
CTES["zlabels"] = """
SELECT z.*, CASE WHEN reconstruction_error > threshold THEN 1 ELSE 0 END AS prediction FROM zscores z, zlimit"""
CTES["zrange"] = """
SELECT min(reconstruction_error) AS low, (max(reconstruction_error) - min(reconstruction_error)) / 50 AS width
FROM zscores"""
CTES["zbins"] = """
SELECT CAST(least(floor((reconstruction_error - low) / width), 49) AS INTEGER) AS bin, count(*) AS n
FROM zscores, zrange GROUP BY ALL"""
CTES["lowest"] = """
SELECT invoice_id, -reconstruction_error AS anomaly_score,
    CASE WHEN -reconstruction_error < (SELECT quantile_cont(-reconstruction_error, 0.02) FROM zscores)
        THEN 1 ELSE 0 END AS prediction FROM zscores"""
CTES["profiles"] = """
SELECT i.vendor_id, any_value(v.vendor_category) AS kind, count(*) / 100 AS n, avg(i.amount) / 10000 AS mean,
    max(i.amount) / 100000 AS top
FROM inv i JOIN ven v ON i.vendor_id = v.vendor_id GROUP BY i.vendor_id"""
CTES["nearest"] = """
SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY distance, neighbor) AS rank FROM (
        SELECT a.vendor_id AS invoice_id, b.vendor_id AS neighbor,
            sqrt((a.n - b.n) * (a.n - b.n) + (a.mean - b.mean) * (a.mean - b.mean) + (a.top - b.top) * (a.top - b.top)
                + CASE WHEN a.kind <> b.kind THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END) AS distance
        FROM profiles a JOIN profiles b ON a.vendor_id <> b.vendor_id))
WHERE rank <= 5"""
CTES["reaches"] = "SELECT invoice_id AS neighbor, max(distance) AS k_distance FROM nearest GROUP BY invoice_id"
CTES["densities"] = """
SELECT invoice_id, 1.0::DOUBLE / (avg(greatest(distance, k_distance)) + 1e-10::DOUBLE) AS density
FROM nearest JOIN reaches USING (neighbor) GROUP BY invoice_id"""
CTES["factors"] = """
SELECT n.invoice_id, -avg(o.density) / any_value(d.density) AS anomaly_score
FROM nearest n JOIN densities o ON o.invoice_id = n.neighbor JOIN densities d ON d.invoice_id = n.invoice_id
GROUP BY n.invoice_id"""
CTES["gappy"] = """
SELECT * REPLACE (
    CASE WHEN left(md5(invoice_id), 1) <> '0' THEN amount END AS amount,
    CASE WHEN left(md5(invoice_id), 1) <> '1' THEN quantity END AS quantity,
    CASE WHEN left(md5(invoice_id), 1) <> '2' THEN unit_price END AS unit_price,
    CASE WHEN left(md5(invoice_id), 1) <> '3' THEN payment_date END AS payment_date,
    CASE WHEN left(md5(invoice_id), 1) <> '4' THEN due_date END AS due_date,
    CASE WHEN left(md5(invoice_id), 1) <> '5' THEN currency END AS currency) FROM inv"""
_WIDE = {"picked": CTES["picked"].replace("% 5 AS", "% 30 AS")}


def score_oracles() -> dict[str, str]:
    labels = "SELECT invoice_id, fraud_label, fraud_type, source_invoice, parameters FROM truth"
    plain = {
        "dq_report_gaps": _dq("gappy"),
        "max_invoice_number": r"""SELECT max(CAST(regexp_extract(invoice_id, '(\d+)', 1) AS BIGINT)) AS max_number
            FROM inv""",
        "injected_sequence_ids": r"""SELECT printf('INV%06d', (SELECT max(CAST(regexp_extract(invoice_id, '(\d+)', 1)
                AS BIGINT)) FROM inv) + row_number() OVER (ORDER BY md5(invoice_id || '|42'), invoice_id))
                AS invoice_id, invoice_id AS source_invoice FROM picked""",
        "mart_metadata": f"SELECT {METADATA} FROM mart",
        "mart_features": f"SELECT * EXCLUDE ({METADATA.replace('invoice_id, ', '', 1)}) FROM mart",
        "autoencoder_split": """SELECT invoice_id, ('0x' || left(md5(invoice_id || '|42'), 15))::BIGINT % 100 < 20
            AS validation FROM inv""",
        "csv_invoices": "SELECT * FROM inv",
        "csv_vendors": "SELECT * REPLACE (replace(vendor_address, chr(10), ', ') AS vendor_address) FROM ven",
        "csv_rule_table": "SELECT * FROM benford",
        "saved_vote": "SELECT * FROM votes",
        "saved_injection": labels,
        "score_threshold": f"SELECT {half_up('threshold', 6)} AS threshold FROM zlimit",
        "score_labels": "SELECT invoice_id, reconstruction_error, prediction FROM zlabels",
        "score_histogram": f"""SELECT bin, {half_up("low + bin * width", 6)} AS lower,
            {half_up("low + (bin + 1) * width", 6)} AS upper, n, {half_up("threshold", 6)} AS threshold
            FROM zbins, zrange, zlimit""",
        "score_top": """SELECT invoice_id, vendor_id, vendor_name, amount, reconstruction_error FROM zscores
            ORDER BY reconstruction_error DESC, invoice_id LIMIT 10""",
        "score_summary": """SELECT count(*) AS total_invoices, CAST(sum(prediction) AS BIGINT) AS predicted_anomalies,
            CAST(count(*) - sum(prediction) AS BIGINT) AS normal_invoices FROM zlabels""",
        "lowest_score_labels": "SELECT * FROM lowest",
        "lowest_score_top": "SELECT * FROM lowest ORDER BY anomaly_score, invoice_id LIMIT 10",
        "vendor_neighbors": f"""SELECT invoice_id, neighbor, {half_up("distance", 6)} AS distance,
            CAST(rank AS INTEGER) AS rank FROM nearest""",
        "vendor_outlier_factors": f"SELECT invoice_id, {half_up('anomaly_score', 6)} AS anomaly_score FROM factors",
    }
    return {name: with_ctes(sql) for name, sql in plain.items()} | {"injected_labels_wide": with_ctes(labels, _WIDE)}


def model_oracles() -> dict[str, str]:
    fills = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {half_up(c, 4)} AS median, CAST(NULL AS VARCHAR) AS most_frequent FROM middles"
        for c in NUMERIC
    )
    scaled = ", ".join(f"{half_up(f'coalesce(({c} - avg_{c}) / dev_{c}, 0)', 4)} AS {c}" for c in NUMERIC)
    onehot = " UNION ALL ".join(
        f"SELECT invoice_id, 'categorical__{c}_' || coalesce({c}, (SELECT value FROM modes WHERE column_name = '{c}'))"
        " AS feature FROM mart_full"
        for c in CATEGORICAL
    )
    return {
        "impute_stats": with_ctes(f"{fills} UNION ALL SELECT column_name, NULL, value FROM modes"),
        "encoded_numeric": with_ctes(f"SELECT invoice_id, {scaled} FROM filled, filled_stats"),
        "scored_with_saved_encoder": with_ctes(f"SELECT invoice_id, {scaled} FROM filled, filled_stats"),
        "encoded_onehot": with_ctes(onehot),
    }


def path_length(n: str) -> str:
    full = f"2.0::DOUBLE * (ln({n} - 1.0::DOUBLE) + {EULER!r}::DOUBLE) - 2.0::DOUBLE * ({n} - 1.0::DOUBLE) / {n}"
    return f"CASE WHEN {n} <= 1 THEN 0.0::DOUBLE WHEN {n} = 2 THEN 1.0::DOUBLE ELSE {full} END"


EULER = 0.5772156649015329
TREES = 8
CTES["coded"] = (
    "SELECT invoice_id, ["
    + ", ".join(half_up(f"coalesce(({c} - avg_{c}) / dev_{c}, 0)", 4) for c in NUMERIC)
    + "] AS x, ["
    + ", ".join(f"coalesce({c}, (SELECT value FROM modes WHERE column_name = '{c}'))" for c in CATEGORICAL)
    + f"] AS c FROM (SELECT invoice_id, {', '.join(CATEGORICAL)} FROM mart_full) JOIN filled USING (invoice_id), filled_stats"
)


def forest_ctes(sample: int) -> dict[str, str]:
    """A forest of ``TREES`` trees on ``sample`` rows each, level by level; names end in the sample size."""
    limit = (sample - 1).bit_length()
    t = {
        f"rates{sample}": f"""
SELECT pool, least(1.0::DOUBLE, 1.5::DOUBLE * {sample} / greatest(total * pool, 1.0::DOUBLE)) AS share
FROM (SELECT count(*) AS total, least(1.0::DOUBLE, 1.3::DOUBLE * {TREES} * {sample} / greatest(count(*), 1)) AS pool FROM coded)""",
        f"drawn{sample}": f"""
SELECT invoice_id, x, c, tree, ('0x' || substr(md5(invoice_id || '|42|' || tree // 4), 8 * (tree % 4) + 1, 8))::BIGINT AS draw
FROM coded, rates{sample}, (SELECT unnest(range({TREES}))::INTEGER AS tree)
WHERE ('0x' || left(md5(invoice_id || '|42'), 8))::BIGINT < floor(pool * 4294967296)""",
        f"sampled{sample}": f"""
SELECT tree, invoice_id, x, c FROM drawn{sample}, rates{sample} WHERE draw < floor(share * 4294967296)
QUALIFY row_number() OVER (PARTITION BY tree ORDER BY draw, invoice_id) <= {sample}""",
        f"rows{sample}_0": f"SELECT tree, 1 AS node, x, c FROM sampled{sample}",
    }
    for depth in range(limit + 1):
        rows, split = f"rows{sample}_{depth}", f"split{sample}_{depth}"
        cut = f"""low + ('0x' || substr(digest, 14, 13))::BIGINT / {float(16**13)!r}::DOUBLE * (high - low)"""
        t[f"options{sample}_{depth}"] = f"""
SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY feature, category) - 1 AS place,
    count(*) OVER (PARTITION BY tree, node) AS places, md5('42|' || tree || '|' || node) AS digest
FROM (SELECT tree, node, feature, min(v) AS low, max(v) AS high, NULL::VARCHAR AS category
    FROM (SELECT tree, node, unnest(range({len(NUMERIC)})) AS feature, unnest(x) AS v FROM {rows})
    GROUP BY tree, node, feature HAVING max(v) > min(v)
    UNION ALL
    SELECT tree, node, feature, 0.0, 1.0, category FROM (
        SELECT DISTINCT tree, node, unnest(range({len(NUMERIC)}, {len(NUMERIC) + len(CATEGORICAL)})) AS feature,
            unnest(c) AS category FROM {rows})
    QUALIFY count(*) OVER (PARTITION BY tree, node, feature) > 1)"""
        t[split] = f"""
SELECT n.tree, n.node, o.feature, o.category,
    CASE WHEN o.feature IS NOT NULL AND o.category IS NULL THEN {cut} ELSE 0.0::DOUBLE END AS threshold,
    CASE WHEN o.feature IS NULL THEN {depth} + {path_length("n.n")} ELSE 0.0::DOUBLE END AS length
FROM (SELECT tree, node, count(*) AS n FROM {rows} GROUP BY tree, node) n
LEFT JOIN options{sample}_{depth} o ON o.tree = n.tree AND o.node = n.node AND {str(depth < limit).lower()}
    AND o.place = ('0x' || left(o.digest, 13))::BIGINT % o.places"""
        if depth < limit:
            t[f"rows{sample}_{depth + 1}"] = f"""
SELECT r.tree, CASE WHEN {_goes_left("r", "s")} THEN 2 * r.node ELSE 2 * r.node + 1 END AS node, r.x, r.c
FROM {rows} r JOIN {split} s ON r.tree = s.tree AND r.node = s.node WHERE s.feature IS NOT NULL"""
    t[f"nodes{sample}"] = " UNION ALL ".join(f"SELECT * FROM split{sample}_{depth}" for depth in range(limit + 1))
    walk = f"SELECT invoice_id, tree, 1 AS node, 0.0::DOUBLE AS length, x, c FROM coded, (SELECT unnest(range({TREES})) AS tree)"
    for depth in range(limit + 1):
        t[f"walk{sample}_{depth}"] = walk
        walk = f"""
SELECT w.invoice_id, w.tree, CASE WHEN s.feature IS NULL THEN NULL WHEN {_goes_left("w", "s")} THEN 2 * w.node
        ELSE 2 * w.node + 1 END AS node, coalesce(s.length, w.length) AS length, w.x, w.c
FROM walk{sample}_{depth} w LEFT JOIN split{sample}_{depth} s ON w.tree = s.tree AND w.node = s.node"""
    t[f"ends{sample}"] = walk
    t[f"paths{sample}"] = f"""
SELECT invoice_id, sum(length) AS total, sum(length) FILTER (tree < {TREES // 2}) AS half FROM ends{sample} GROUP BY invoice_id"""
    norm = path_length(f"{sample}::DOUBLE")
    t[f"raw{sample}"] = f"""
SELECT invoice_id, {half_up(f"-pow(2.0::DOUBLE, -total / ({norm} * {TREES}))", 6)} AS raw_score,
    {half_up(f"-pow(2.0::DOUBLE, -half / ({norm} * {TREES // 2}))", 6)} AS half_score FROM paths{sample}"""
    return t


def _goes_left(row: str, split: str) -> str:
    return f"""(CASE WHEN {split}.category IS NULL THEN {row}.x[{split}.feature + 1] <= {split}.threshold
        ELSE {row}.c[{split}.feature - {len(NUMERIC) - 1}] <> {split}.category END)"""


for _size in (32, 64):
    CTES |= forest_ctes(_size)
_settings = [
    f"SELECT {size} AS sample_rows, {trees} AS n_trees, {share}::DOUBLE AS contamination, {column} AS score, fraud_label,"
    f" quantile_cont({column}, {share}) OVER () AS threshold FROM raw{size} LEFT JOIN truth USING (invoice_id)"
    for size in (32, 64)
    for trees, column in ((4, "half_score"), (8, "raw_score"))
    for share in (0.01, 0.02, 0.05, 0.1)
]
CTES["swept"] = f"""
SELECT sample_rows, n_trees, contamination, threshold,
    count(*) FILTER (fraud_label = 1 AND score < threshold) AS tp,
    count(*) FILTER (fraud_label IS NULL AND score < threshold) AS fp,
    count(*) FILTER (fraud_label = 1 AND score >= threshold) AS fn,
    count(*) FILTER (fraud_label IS NULL AND score >= threshold) AS tn
FROM ({" UNION ALL ".join(_settings)}) GROUP BY sample_rows, n_trees, contamination, threshold"""
CTES["swept_rates"] = """
SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall FROM swept"""
CTES["swept_f1"] = """
SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1_score FROM swept_rates"""


HIDDEN = [64, 32, 16, 32, 64]
CTES["onehots"] = (
    f"SELECT k, value, {len(NUMERIC)} + row_number() OVER (ORDER BY k, value) - 1 AS place FROM (SELECT DISTINCT"
    f" unnest(range({len(CATEGORICAL)})) AS k, unnest(c) AS value FROM coded)"
)
CTES["net_width"] = f"SELECT {len(NUMERIC)} + count(*) AS width FROM onehots"


_relu = "list_transform({}, lambda v: greatest(v, 0.0::DOUBLE))"
CTES["net_input"] = """
SELECT invoice_id, any_value(x) AS x, list(place ORDER BY place) AS hot
FROM (SELECT invoice_id, x, unnest(range(len(c))) AS k, unnest(c) AS value FROM coded) JOIN onehots USING (k, value)
GROUP BY invoice_id"""
# The weights of every layer are one list of lists; a row meets each once.
CTES["net_weights"] = "SELECT " + ", ".join(
    f"list_transform(range({b}), lambda j: list_transform(range({a}), lambda i: "
    f"((7 * i + 13 * j + 31 * {layer}) % 101 - 50) / 400.0::DOUBLE)) AS w{layer}, "
    f"list_transform(range({b}), lambda j: ((17 * j + {5 * layer}) % 11 - 5) / 50.0::DOUBLE) AS b{layer}"
    for layer, (a, b) in enumerate(zip(["width", *HIDDEN], [*HIDDEN, "width"]))
) + " FROM net_width"


def _layer(layer: int, source: str, extra: str = "") -> str:
    return (
        f"list_transform(range(1, len(w{layer}) + 1), lambda j: list_dot_product({source}, w{layer}[j]){extra} + b{layer}[j])"
    )


CTES["net0"] = f"""
SELECT invoice_id, x, hot, {_layer(0, "x", " + list_sum(list_transform(hot, lambda p: v0[j][p + 1]))")} AS a
FROM net_input, (SELECT b0, w0 AS v0, list_transform(w0, lambda w: w[1:{len(NUMERIC)}]) AS w0 FROM net_weights)"""
CTES["net1"] = """
SELECT invoice_id, x, hot, list_transform(range(64), lambda j: (greatest(a[j + 1], 0.0::DOUBLE) - j % 7 / 20.0::DOUBLE)
    / sqrt(1.0::DOUBLE + j % 4 / 4.0::DOUBLE + 1e-3::DOUBLE) * (1.0::DOUBLE + j % 5 / 10.0::DOUBLE) + (j % 3 - 1) / 10.0::DOUBLE) AS a
FROM net0"""
for _k in range(1, 5):
    CTES[f"net{_k + 1}"] = f"SELECT invoice_id, x, hot, {_relu.format(_layer(_k, 'a'))} AS a FROM net{_k}, net_weights"
CTES["net_out"] = f"SELECT invoice_id, x, hot, {_layer(5, 'a')} AS y FROM net5, net_weights"
CTES["net_errors"] = f"""
SELECT invoice_id, (list_sum(list_transform(y, lambda v: v * v))
    - 2 * list_dot_product(y[1:{len(NUMERIC)}], x) + list_dot_product(x, x)
    - 2 * list_sum(list_transform(hot, lambda p: y[p + 1])) + len(hot)) / len(y) AS reconstruction_error FROM net_out"""


def artifact_oracles() -> dict[str, str]:
    scaled = ", ".join(f"{half_up(f'coalesce(({c} - avg_{c}) / dev_{c}, 0)', 4)} AS {c}" for c in NUMERIC)
    ones = " || ',' || ".join(f"'categorical__{c}_' || c[{i + 1}]" for i, c in enumerate(CATEGORICAL))
    plain = {
        "saved_predictions": f"SELECT {METADATA}, anomaly_score, prediction FROM lowest JOIN zscores USING (invoice_id)",
        "saved_threshold": f"""SELECT invoice_id, reconstruction_error, prediction, {half_up("threshold", 6)} AS threshold
            FROM zlabels, zlimit""",
        "mart_after_append": "SELECT * FROM mart",
        "saved_matrix": f"SELECT invoice_id, {scaled}, {ones} AS ones FROM filled JOIN coded USING (invoice_id), filled_stats",
        "reconstruction_fixed": f"""SELECT invoice_id, {half_up("reconstruction_error", 6)} AS reconstruction_error
            FROM net_errors""",
    }
    return {name: with_ctes(sql) for name, sql in plain.items()} | {
        "saved_evaluation": with_ctes("SELECT * FROM judged", _INJECTED)
    }


def forest_oracles() -> dict[str, str]:
    names = "[" + ", ".join(f"'{c}'" for c in [*NUMERIC, *CATEGORICAL]) + "]"
    ranked = f"""SELECT CAST(row_number() OVER (ORDER BY f1_score DESC, recall DESC, sample_rows, n_trees, contamination) AS INTEGER) AS rank,
        sample_rows, n_trees, contamination, {half_up("threshold", 6)} AS threshold, tp, fp, fn, tn,
        {half_up("precision", 6)} AS precision, {half_up("recall", 6)} AS recall, {half_up("f1_score", 6)} AS f1_score
        FROM swept_f1"""
    return {
        "iforest_samples": with_ctes("SELECT tree, invoice_id FROM sampled64"),
        "iforest_nodes": with_ctes(
            f"SELECT tree, node, {names}[feature + 1] AS feature, {half_up('threshold', 6)} AS threshold, category, "
            f"{half_up('length', 6)} AS length FROM nodes64"
        ),
        "iforest_small": with_ctes("SELECT invoice_id, raw_score FROM raw64"),
        "iforest_sweep": with_ctes(ranked, _INJECTED),
    }


def oracles() -> dict[str, str]:
    return rule_oracles() | score_oracles() | model_oracles() | forest_oracles() | artifact_oracles()
