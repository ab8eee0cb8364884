"""DuckDB SQL with the same result as each registered query, used to check correctness.

Every statement starts from the source tables. Shared steps are common table expressions, pulled in by name.
"""

from __future__ import annotations

import math
import re
from functools import cache

from ..functions.segments import SEGMENTS
from ..functions.statistics import ERF_A, ERF_P, HALF_PI, SIMPSON_STEPS, normal_quantile
from ..operators import experiment as ab
from ..operators.anomalies import (CUSTOMER_CONTAMINATION, CUSTOMER_SCALED, CUSTOMER_TREES, EULER_GAMMA, PATH_UNIT, PRIME, SAMPLE, TX_CONTAMINATION, TX_FEATURES,
                                   TX_SCALED, TX_TREES, UNIT as FEATURE_UNIT)
from ..operators.clv import (BGNBD_PENALTY, GAMMA_PENALTY, HORIZON_WEEKS, LEAST_PARAMETER, MONTHS, NODE_STEP, NODES, PARAMETER_DIGITS, WEEKS_PER_MONTH,
                             YEARLY_DISCOUNT)
from ..operators.clustering import FEATURES, ITERATIONS, K_RANGE, MIN_K, RESTARTS, SWEEP_RESTARTS, UNIT
from ..operators.explore import WEEKDAYS
from ..operators.neighbours import EPS_QUANTILE, MIN_SAMPLES, NOISE
from ..operators.insights import DEFAULT_UPLIFT, STRATEGY, STRATEGY_COLUMNS, TOTAL, UPLIFT
from ..operators.segment_questions import VALUE_PERCENTILES, column_name


# --- expression helpers ---------------------------------------------------------------------------------------------

def r(x: str, k: int = 0) -> str:
    """Round half away from zero on the binary value."""
    s = repr(10.0**k)
    return f"(sign(CAST(({x}) AS DOUBLE)) * floor(abs(CAST(({x}) AS DOUBLE)) * {s} + 0.5) / {s})"


def u(x: str) -> str:
    return f"CAST(floor(({x}) * 10000 + 0.5) AS BIGINT)"


def msum(x: str) -> str:
    return f"(CAST(sum({u(x)}) AS DOUBLE) / 10000.0)"


def mavg(x: str) -> str:
    return f"({msum(x)} / count({x}))"


def pct(part: str, whole: str, k: int = 1) -> str:
    return r(f"CAST({part} AS DOUBLE) * 100.0 / nullif({whole}, 0)", k)


def even(x: str) -> str:
    return f"round_even(CAST(({x}) AS DOUBLE), 0)"


def bins(x: str, lo: str, hi: str, n: int) -> str:
    w = f"(({hi} - {lo}) / {float(n)!r})"
    return f"CAST(CASE WHEN {w} = 0 THEN 0 ELSE least(floor(({x} - {lo}) / {w}), {n - 1}) END AS INTEGER)"


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sf(z: str) -> str:
    """P(Z > z)."""
    x = f"(abs({z}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + CAST({ERF_P!r} AS DOUBLE) * {x}))"
    poly = "CAST(0.0 AS DOUBLE)"
    for a in reversed(ERF_A):
        poly = f"(({poly} + CAST({a!r} AS DOUBLE)) * {t})"
    tail = f"(0.5 * {poly} * exp(-{x} * {x}))"
    return f"(CASE WHEN {z} >= 0 THEN {tail} ELSE 1.0 - {tail} END)"


LABEL = """CASE WHEN rfm_score >= 12 THEN 'Champions' WHEN rfm_score >= 9 THEN 'Loyal Customers'
 WHEN rfm_score >= 7 THEN 'Potential Loyal' WHEN rfm_score >= 5 THEN 'At Risk' ELSE 'Lost / Inactive' END"""
CHURN = """CAST(CASE WHEN recency_days > 180 THEN 0.85 WHEN recency_days > 90 THEN 0.60 WHEN recency_days > 30 THEN 0.25
 ELSE 0.05 END AS DOUBLE)"""
BAND = """CASE WHEN churn_probability >= 0.80 THEN 'Critical' WHEN churn_probability >= 0.55 THEN 'High'
 WHEN churn_probability >= 0.20 THEN 'Medium' ELSE 'Low' END"""
MONTH = "strftime(invoice_date, '%Y-%m')"
GAP = "CAST(floor((epoch({a}) - epoch({b})) / 86400.0) AS INTEGER)"


def _scores(raw: str, f: str, m: str) -> str:
    return f"""SELECT customer_id, recency_days, frequency, monetary,
 CAST(6 - ntile(5) OVER (ORDER BY recency_days, customer_id) AS INTEGER) AS r_score,
 CAST({f} AS INTEGER) AS f_score, CAST({m} AS INTEGER) AS m_score FROM {raw}"""


def _qcut(order: str) -> str:
    return f"6 - greatest(1, ceil(5.0 * (row_number() OVER (ORDER BY {order}, customer_id) - 1) / (count(*) OVER () - 1)))"


def _coded(scores: str) -> str:
    return f"""SELECT *, r_score + f_score + m_score AS rfm_score,
 CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_segment_code FROM {scores}"""


def _segments(coded: str) -> str:
    return f"""SELECT customer_id, recency_days, frequency, {r('monetary', 2)} AS monetary, r_score, f_score, m_score, rfm_score,
 rfm_segment_code, {LABEL} AS segment_label, {CHURN} AS churn_probability,
 {r('monetary / greatest(recency_days, 1) * 365.0', 2)} AS clv_estimate FROM {coded}"""


def _rfm_raw(snapshot: str) -> str:
    return f"""SELECT customer_id, {GAP.format(a='s.at', b='last_purchase')} AS recency_days, total_orders AS frequency,
 total_revenue AS monetary FROM summary, (SELECT {snapshot} AS at FROM summary) s
 WHERE total_orders >= 1 AND total_revenue > 0"""


def _quantile(p: float, x: str = "x") -> str:
    return f"quantile_cont({x}, {p})"


# --- shared steps ---------------------------------------------------------------------------------------------------

CTE: dict[str, str] = {
    "raw": """SELECT CASE WHEN l.l_returnflag='R' AND l.l_linenumber<=2 THEN 'C' ELSE '' END || CAST(l.l_orderkey AS VARCHAR) AS invoice,
 CASE WHEN l.l_partkey%50=0 THEN 'POST' WHEN l.l_partkey%83=0 THEN 'M' ELSE ' p' || lpad(CAST(l.l_partkey AS VARCHAR),6,'0') END AS stock_code,
 CASE WHEN l.l_partkey%211=0 THEN NULL ELSE p.p_name END AS description,
 CASE WHEN l.l_linenumber=7 AND l.l_linestatus='O' THEN -1 ELSE 1 END * CAST(l.l_quantity AS INT) AS quantity,
 o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS BIGINT)) AS invoice_date,
 CASE WHEN l.l_partkey%97=0 THEN 0.0 ELSE CAST(CAST(round(l.l_extendedprice*100) AS BIGINT) // CAST(l.l_quantity AS BIGINT) AS DOUBLE)/100 END AS unit_price,
 CASE WHEN l.l_orderkey%13=0 THEN NULL WHEN l.l_orderkey%17=0 THEN ' ' ELSE CAST(o.o_custkey AS VARCHAR) END AS customer_id,
 n.n_name AS country
 FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN customer c ON o.o_custkey=c.c_custkey
 JOIN nation n ON c.c_nationkey=n.n_nationkey JOIN part p ON l.l_partkey=p.p_partkey""",
    "valid": """SELECT trim(invoice) AS invoice, upper(trim(stock_code)) AS stock_code, trim(description) AS description, quantity,
 invoice_date, unit_price, CAST(trim(customer_id) AS BIGINT) AS customer_id, trim(country) AS country,
 quantity * unit_price AS total_amount,
 length(trim(stock_code)) >= 5 AND stock_code NOT IN ('POST','DOT','M','BANK CHARGES','PADS','D') AS is_product
 FROM raw WHERE customer_id IS NOT NULL AND trim(customer_id) <> '' AND upper(substr(invoice,1,1)) <> 'C'
 AND quantity > 0 AND unit_price > 0""",
    "lines": "SELECT * EXCLUDE (is_product) FROM valid WHERE is_product",
    "cap": """SELECT total_amount AS cap FROM (SELECT total_amount, row_number() OVER (ORDER BY total_amount DESC) AS rn,
 count(*) OVER () AS n FROM lines) WHERE rn = floor(0.001 * n) + 1""",
    "tx": "SELECT lines.* FROM lines, cap WHERE total_amount <= cap",
    "products": """SELECT stock_code, description, unit_price FROM (SELECT *, row_number() OVER (PARTITION BY stock_code
 ORDER BY description, unit_price) AS rn FROM lines WHERE description IS NOT NULL) WHERE rn = 1""",
    "customers": "SELECT customer_id, min(coalesce(country, 'Unknown')) AS country FROM valid GROUP BY customer_id",
    "summary": f"""SELECT s.*, c.country, CASE WHEN total_orders > 0 THEN total_revenue / total_orders ELSE 0.0 END AS avg_order_value
 FROM (SELECT customer_id, count(DISTINCT invoice) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items,
 {r(msum('total_amount'), 2)} AS total_revenue, min(invoice_date) AS first_purchase, max(invoice_date) AS last_purchase
 FROM tx GROUP BY customer_id) s JOIN customers c ON c.customer_id = s.customer_id""",
    "rfm_raw": _rfm_raw("CAST(CAST(max(last_purchase) AS DATE) + 1 AS TIMESTAMP)"),
    "rfm_exact": _rfm_raw("max(last_purchase) + INTERVAL 1 DAY"),
    "scored": _scores("rfm_raw", "ntile(5) OVER (ORDER BY frequency, customer_id)", "ntile(5) OVER (ORDER BY monetary, customer_id)"),
    "scored_sql": _scores("rfm_raw", "ntile(5) OVER (ORDER BY frequency DESC, customer_id)",
                          "ntile(5) OVER (ORDER BY monetary DESC, customer_id)"),
    "scored_qcut": f"""SELECT customer_id, recency_days, frequency, monetary, CAST({_qcut('recency_days')} AS INTEGER) AS r_score,
 CAST({_qcut('frequency DESC')} AS INTEGER) AS f_score, CAST({_qcut('monetary DESC')} AS INTEGER) AS m_score FROM rfm_exact""",
    "coded": _coded("scored"),
    "coded_sql": _coded("scored_sql"),
    "coded_qcut": _coded("scored_qcut"),
    "seg": _segments("coded"),
    "seg_sql": _segments("coded_sql"),
    "seg_qcut": _segments("coded_qcut"),
    "profile": "SELECT seg.*, customers.country FROM seg JOIN customers USING (customer_id)",
    "aud": """SELECT * FROM profile WHERE segment_label IN ('Champions', 'Loyal Customers', 'At Risk') AND recency_days BETWEEN 0 AND 400
 AND monetary BETWEEN 100.0 AND 5000000.0""",
    "lenient": """SELECT *, quantity * unit_price AS total_amount FROM raw WHERE customer_id IS NOT NULL
 AND NOT starts_with(invoice, 'C') AND quantity > 0 AND unit_price > 0""",
    "retail": """SELECT l.*, CAST(year(invoice_date) AS INTEGER) AS year, CAST(month(invoice_date) AS INTEGER) AS month,
 dayname(invoice_date) AS day_of_week, CAST(hour(invoice_date) AS INTEGER) AS hour, strftime(invoice_date, '%Y-%m') AS year_month
 FROM lenient l, (SELECT quantile_cont(total_amount, 0.999) AS cap FROM lenient) q WHERE total_amount <= cap""",
    "monthly": f"""SELECT {MONTH} AS year_month, count(DISTINCT invoice) AS invoices, count(DISTINCT customer_id) AS customers,
 {msum('total_amount')} AS revenue FROM tx GROUP BY 1""",
    "months": f"""SELECT *, min(order_month) OVER (PARTITION BY customer_id) AS cohort_month FROM
 (SELECT customer_id, CAST(date_trunc('month', invoice_date) AS DATE) AS order_month, count(*) AS lines,
 sum({u('total_amount')}) AS revenue_units FROM tx GROUP BY 1, 2)""",
    "cells": """SELECT cohort_month, CAST((year(order_month) - year(cohort_month)) * 12 + month(order_month) - month(cohort_month) AS INTEGER)
 AS cohort_index, count(*) AS customers, sum(lines) AS lines, sum(revenue_units) AS revenue_units FROM months GROUP BY 1, 2""",
    "retention": f"""SELECT *, {r('CAST(customers AS DOUBLE) / size', 4)} AS retention FROM (SELECT *, max(CASE WHEN cohort_index = 0
 THEN customers END) OVER (PARTITION BY cohort_month) AS size FROM cells)""",
    "curve": f"""SELECT cohort_index, n AS cohorts, {r('m', 4)} AS avg_retention, CASE WHEN n > 1 THEN {r('sd', 4)} END AS std_retention,
 CASE WHEN n > 1 THEN {r('greatest(m - sd, 0.0)', 4)} END AS band_low, CASE WHEN n > 1 THEN {r('least(m + sd, 100.0)', 4)} END AS band_high
 FROM (SELECT cohort_index, n, CAST(s AS DOUBLE) / n / 100.0 AS m,
 sqrt(greatest((q - CAST(s AS DOUBLE) * s / n) / nullif(n - 1, 0), 0.0)) / 100.0 AS sd
 FROM (SELECT cohort_index, count(*) AS n, sum(k) AS s, CAST(sum(k * k) AS DOUBLE) AS q FROM (SELECT cohort_index,
 CAST(floor(retention * 10000 + 0.5) AS BIGINT) AS k FROM retention) GROUP BY 1))""",
    "exp0": """SELECT user_id AS customer_id, CASE WHEN user_id%2=0 THEN 'Control' ELSE 'Treatment' END AS grp,
 CAST(CASE WHEN pv > CASE WHEN user_id%2=0 THEN 1000 ELSE 900 END THEN 1 ELSE 0 END AS INT) AS converted,
 CASE WHEN pv > CASE WHEN user_id%2=0 THEN 1000 ELSE 900 END THEN pv ELSE 0.0 END AS revenue, np AS items_purchased
 FROM (SELECT user_id, CAST(sum(CASE WHEN event_type='purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS pv,
 count(CASE WHEN event_type='purchase' THEN 1 END) AS np FROM events GROUP BY user_id) u""",
    "exper": """SELECT e.*, revenue / greatest(items_purchased, 1) AS aov, s.rfm_score FROM exp0 e LEFT JOIN seg s USING (customer_id)""",
    "grp": f"""SELECT grp, count(*) AS n, count(*) FILTER (converted = 1) AS n_converted,
 CAST(count(*) FILTER (converted = 1) AS DOUBLE) / count(*) AS conv_rate, {mavg('revenue')} AS rev_per_user,
 {msum('CASE WHEN converted = 1 THEN revenue END')} / nullif(count(*) FILTER (converted = 1), 0) AS rev_per_converter,
 avg(CASE WHEN converted = 1 THEN aov END) AS aov, {msum('revenue')} AS total_revenue, var_samp(revenue) AS vs, var_pop(revenue) AS vp
 FROM exper GROUP BY grp""",
    "two": """SELECT c.n AS n1, t.n AS n2, c.n_converted AS x1, t.n_converted AS x2, c.conv_rate AS p1, t.conv_rate AS p2,
 c.rev_per_user AS m1, t.rev_per_user AS m2, c.rev_per_converter AS rc, t.rev_per_converter AS rt, c.aov AS a1, t.aov AS a2,
 c.vs AS vs1, t.vs AS vs2, c.vp AS vp1, t.vp AS vp2 FROM grp c, grp t WHERE c.grp = 'Control' AND t.grp = 'Treatment'""",
    "ztest": """SELECT *, p2 - p1 AS diff, (p2 - p1) / sqrt(pool * (1 - pool) * (1.0 / n1 + 1.0 / n2)) AS z,
 sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2) AS se FROM (SELECT *, CAST(x1 + x2 AS DOUBLE) / (n1 + n2) AS pool FROM two)""",
    "welch": """SELECT *, (m2 - m1) / sqrt(a + b) AS t_stat, (a + b) * (a + b) / (a * a / (n2 - 1) + b * b / (n1 - 1)) AS df
 FROM (SELECT *, vs2 / n2 AS a, vs1 / n1 AS b FROM two)""",
    "welch_p": f"""SELECT w.*, (SELECT sum((CASE WHEN i = 0 OR i = {SIMPSON_STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
 * pow(greatest(cos(ang + ({HALF_PI} - ang) / {SIMPSON_STEPS}.0 * i), 0), df - 1)) * ({HALF_PI} - any_value(ang)) / (2 *
 (sum((CASE WHEN i = 0 OR i = {SIMPSON_STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
 * pow(greatest(cos({HALF_PI} / {SIMPSON_STEPS}.0 * i), 0), df - 1)) * {HALF_PI}))
 FROM range({SIMPSON_STEPS + 1}) g(i), (SELECT df, atan(abs(t_stat) / sqrt(df)) AS ang FROM welch)) AS tail FROM welch w""",
    "wp": "SELECT *, CASE WHEN t_stat >= 0 THEN tail ELSE 1 - tail END AS t_p FROM welch_p",
    "chi": """SELECT *, n * gap * gap / (CAST(n1 AS DOUBLE) * n2 * (x1 + x2) * (n1 - x1 + n2 - x2)) AS chi2 FROM (SELECT *,
 CAST(n1 + n2 AS DOUBLE) AS n, greatest(abs(CAST(x1 AS DOUBLE) * (n2 - x2) - CAST(n1 - x1 AS DOUBLE) * x2) - (n1 + n2) / 2.0, 0.0) AS gap
 FROM two)""",
    "mwu": """SELECT *, (uu - n1 * n2 / 2.0 - 0.5) / sqrt(n1 * n2 / 12.0 * ((n + 1) - tie / (n * (n - 1)))) AS uz FROM
 (SELECT *, n - n2 AS n1, r2 - n2 * (n2 + 1) / 2.0 AS uu FROM (SELECT CAST(sum(t) AS DOUBLE) AS n, CAST(sum(nt) AS DOUBLE) AS n2,
 sum(nt * (before + (t + 1) / 2.0)) AS r2, CAST(sum(CAST(t AS DOUBLE) * t * t - t) AS DOUBLE) AS tie FROM
 (SELECT *, coalesce(sum(t) OVER (ORDER BY revenue ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM
 (SELECT revenue, count(*) AS t, count(*) FILTER (grp = 'Treatment') AS nt FROM exper GROUP BY revenue))))""",
    "pvals": f"""SELECT {sf('z')} AS z_p, t_p, {sf('uz')} AS u_p, 2.0 * {sf('sqrt(chi2)')} AS chi2_p
 FROM (SELECT z FROM ztest), (SELECT t_p FROM wp), (SELECT uz FROM mwu), (SELECT chi2 FROM chi)""",
    "weeks": f"""SELECT customer_id, CAST(date_trunc('week', invoice_date) AS DATE) AS week, sum({u('total_amount')}) AS uu FROM tx GROUP BY 1, 2""",
    "clvsum": """SELECT customer_id, frequency, (w1 - w0) / 7.0 AS recency, (e - w0) / 7.0 AS t,
 coalesce(CAST(uu - u0 AS DOUBLE) / 10000.0 / nullif(frequency, 0), 0.0) AS monetary_value FROM
 (SELECT customer_id, count(*) - 1 AS frequency, min(week) AS w0, max(week) AS w1, sum(uu) AS uu, arg_min(uu, week) AS u0 FROM weeks
 GROUP BY 1), (SELECT CAST(date_trunc('week', max(invoice_date)) AS DATE) AS e FROM tx)""",
    "fb0": f"""SELECT *, {r('least(greatest(recency / t * (1 + frequency * 0.1), 0.0), 0.99)', 4)} AS prob_alive FROM
 (SELECT customer_id, frequency - 1 AS frequency, (365 - recency_days) / 7.0 AS recency, CAST(52.0 AS DOUBLE) AS t,
 monetary / frequency AS monetary_value FROM seg) WHERE frequency > 0""",
    "fb": f"""SELECT *, {r('pp * ao * 0.65', 2)} AS clv_predicted FROM (SELECT *, {r('prob_alive * (frequency + 1) * (52.0 / greatest(t, 1.0))', 2)}
 AS pp, monetary_value * CAST(1.05 AS DOUBLE) AS ao FROM fb0)""",
    "fbseg": "SELECT fb.*, seg.segment_label AS segment FROM fb LEFT JOIN seg USING (customer_id)",
    "tier": """SELECT fb.*, CASE WHEN greatest(clv_predicted, 0.0) <= q1 THEN 'Bronze' WHEN greatest(clv_predicted, 0.0) <= q2 THEN 'Silver'
 WHEN greatest(clv_predicted, 0.0) <= q3 THEN 'Gold' ELSE 'Platinum' END AS clv_tier FROM fb,
 (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3
 FROM (SELECT greatest(clv_predicted, 0.0) AS v FROM fb))""",
    "scaled": """SELECT s.*, (ln(1 + recency_days) - ma) / sa AS r_scaled, (ln(1 + frequency) - mb) / sb AS f_scaled,
 (ln(1 + monetary) - mc) / sc AS m_scaled FROM seg s, (SELECT avg(ln(1 + recency_days)) AS ma, stddev_pop(ln(1 + recency_days)) AS sa,
 avg(ln(1 + frequency)) AS mb, stddev_pop(ln(1 + frequency)) AS sb, avg(ln(1 + monetary)) AS mc, stddev_pop(ln(1 + monetary)) AS sc FROM seg)""",
    "txf0": "SELECT *, least(total_amount / greatest(quantity, 1), 500.0) AS implied_unit_price FROM lines",
    "metrics": f"""SELECT no AS segment_no, name AS segment, coalesce(n, 0) AS n, coalesce(rev, 0.0) AS rev, coalesce(avg_mon, 0.0) AS avg_mon,
 coalesce(avg_rec, 0.0) AS avg_rec, coalesce(avg_frq, 0.0) AS avg_frq, coalesce(avg_clv, 0.0) AS avg_clv, coalesce(avg_churn, 0.0) AS avg_churn
 FROM (VALUES {', '.join(f"({i}, {text(s)})" for i, s in enumerate(SEGMENTS))}) d(no, name) LEFT JOIN (SELECT segment_label, count(*) AS n,
 {msum('monetary')} AS rev, {mavg('monetary')} AS avg_mon, avg(recency_days) AS avg_rec, avg(frequency) AS avg_frq,
 {mavg('clv_estimate')} AS avg_clv, {mavg('churn_probability')} AS avg_churn FROM profile GROUP BY 1) g ON g.segment_label = d.name""",
}
_Q = ("q0", "q1", "q2")
_GAPS = "list_transform(cs, lambda x: " + " + ".join(f"({q} - x.{c}) * ({q} - x.{c})" for q, c in zip(_Q, "abc")) + ")"
_MEAN = "struct_pack(" + ", ".join(f"{c} := (2 * s{i} + n - ((2 * s{i} + n) % (2 * n) + 2 * n) % (2 * n)) // (2 * n)" for i, c in enumerate("abc")) + ")"
CTE |= {
    "sites": "SELECT " + ", ".join(f"CAST(floor({c} * {UNIT} + 0.5) AS BIGINT) AS {q}" for c, q in zip(FEATURES, _Q))
             + ", CAST(count(*) AS BIGINT) AS w, min(customer_id) AS id FROM scaled GROUP BY 1, 2, 3",
    "starts": f"""SELECT r, place, q0, q1, q2 FROM (SELECT r, q0, q1, q2, row_number() OVER (PARTITION BY r
 ORDER BY md5(CAST(r AS VARCHAR) || ':' || CAST(id AS VARCHAR)), id) AS place FROM sites, range({RESTARTS}) g(r)) WHERE place <= {max(K_RANGE)}""",
    # One round for all models at once: label every site, average each cluster, keep the centre of an empty one.
    "lloyd": f"""SELECT 0 AS it, k, r, list(struct_pack(a := q0, b := q1, c := q2) ORDER BY place) AS cs, true AS moved
 FROM starts, range({min(K_RANGE)}, {max(K_RANGE) + 1}) g(k) WHERE place <= k GROUP BY k, r
 UNION ALL SELECT it + 1, k, r, new, new <> cs FROM (SELECT it, k, r, cs, list_transform(cs, lambda x, i: coalesce(list_filter(found,
 lambda y: y.label = i)[1].mean, x)) AS new FROM (SELECT any_value(it) AS it, k, r, any_value(cs) AS cs,
 list(struct_pack(label := label, mean := {_MEAN})) AS found FROM (SELECT k, r, any_value(it) AS it, any_value(cs) AS cs, label, CAST(sum(w) AS BIGINT) AS n,
 {', '.join(f'CAST(sum(w * {q}) AS BIGINT) AS s{i}' for i, q in enumerate(_Q))} FROM (SELECT it, k, r, cs, w, q0, q1, q2,
 list_position(gaps, list_min(gaps)) AS label FROM (SELECT l.it, l.k, l.r, l.cs, s.*, {_GAPS} AS gaps FROM lloyd l, sites s
 WHERE l.moved AND l.it < {ITERATIONS})) GROUP BY k, r, label) GROUP BY k, r))""",
    "kruns": f"""SELECT k, r, any_value(cs) AS cs, sum(CAST(w AS HUGEINT) * list_min(gaps)) AS cost FROM (SELECT k, r, cs, w, {_GAPS} AS gaps FROM
 (SELECT k, r, arg_max(cs, it) AS cs FROM lloyd GROUP BY k, r), sites) GROUP BY k, r""",
    "kfits": f"SELECT k, cs, cost FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY cost, r) AS best FROM kruns WHERE r < {SWEEP_RESTARTS}) WHERE best = 1",
    "klab": f"""SELECT k, w, list_position(gaps, list_min(gaps)) AS c, q0 / {UNIT}.0::DOUBLE AS x0, q1 / {UNIT}.0::DOUBLE AS x1, q2 / {UNIT}.0::DOUBLE AS x2, q0, q1, q2
 FROM (SELECT k, sites.*, {_GAPS} AS gaps FROM kfits, sites)""",
    "kclu": f"""SELECT k, c, CAST(sum(w) AS DOUBLE) AS n, {', '.join(f'CAST(sum(w * {q}) AS DOUBLE) / {UNIT} AS s{i}' for i, q in enumerate(_Q))},
 CAST(sum(CAST(w AS HUGEINT) * (q0 * q0 + q1 * q1 + q2 * q2)) AS DOUBLE) / {UNIT * UNIT}.0::DOUBLE AS sq FROM klab GROUP BY k, c""",
    "ksil": """SELECT k, c, sum(w * CASE WHEN n = 1 OR b IS NULL OR greatest(a, b) <= 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS s, sum(w * d) AS d FROM
 (SELECT l.k, l.c, l.w, l.q0, l.q1, l.q2, any_value(o.n) AS n, max(CASE WHEN u.c = l.c THEN greatest(t, 0) / greatest(u.n - 1, 1) END) AS a,
 min(CASE WHEN u.c <> l.c THEN t / u.n END) AS b, any_value(sqrt(pow(x0 - o.s0 / o.n, 2) + pow(x1 - o.s1 / o.n, 2) + pow(x2 - o.s2 / o.n, 2))) AS d
 FROM klab l JOIN kclu o ON o.k = l.k AND o.c = l.c JOIN kclu u ON u.k = l.k,
 LATERAL (SELECT u.n * (x0 * x0 + x1 * x1 + x2 * x2) - 2 * (x0 * u.s0 + x1 * u.s1 + x2 * u.s2) + u.sq AS t) GROUP BY l.k, l.c, l.w, l.q0, l.q1, l.q2) GROUP BY k, c""",
    "kqual": f"""SELECT f.k, round(CAST(cost AS DOUBLE) / {UNIT * UNIT}.0::DOUBLE, 6) AS inertia, round(sil, 6) AS silhouette, round(db, 6) AS davies_bouldin,
 round((btw / (m - 1)) / (wit / (total - m)), 3) AS calinski_harabasz FROM kfits f
 JOIN (SELECT k, sum(s) / any_value(total) AS sil FROM ksil JOIN (SELECT k, sum(n) AS total FROM kclu GROUP BY k) USING (k) GROUP BY k) USING (k)
 JOIN (SELECT k, avg(worst) AS db FROM (SELECT p.k, p.c, max((p.wide + r.wide) / sqrt(pow(p.m0 - r.m0, 2) + pow(p.m1 - r.m1, 2) + pow(p.m2 - r.m2, 2))) AS worst
 FROM kwide p JOIN kwide r ON p.k = r.k AND p.c <> r.c GROUP BY p.k, p.c) GROUP BY k) USING (k)
 JOIN (SELECT k, count(*) AS m, sum(n) AS total, sum(n * (pow(m0 - a0, 2) + pow(m1 - a1, 2) + pow(m2 - a2, 2))) AS btw,
 sum(sq - n * (m0 * m0 + m1 * m1 + m2 * m2)) AS wit FROM (SELECT *, {', '.join(f'sum(s{i}) OVER (PARTITION BY k) / sum(n) OVER (PARTITION BY k) AS a{i}' for i in range(3))}
 FROM kwide) GROUP BY k) USING (k)""",
    "kwide": "SELECT kclu.*, s0 / n AS m0, s1 / n AS m1, s2 / n AS m2, d / n AS wide FROM kclu JOIN ksil USING (k, c)",
    "kbest": f"SELECT greatest({MIN_K}, (SELECT k FROM kqual ORDER BY silhouette DESC, k LIMIT 1)) AS k",
    "kfinal": "SELECT cs FROM kruns JOIN kbest USING (k) ORDER BY cost, r LIMIT 1",
    "clu": f"""SELECT * EXCLUDE (q0, q1, q2, cs, gaps), CAST(list_position(gaps, list_min(gaps)) - 1 AS INTEGER) AS cluster FROM (SELECT *, {_GAPS} AS gaps FROM kfinal, (SELECT scaled.*,
 {', '.join(f'CAST(floor({c} * {UNIT} + 0.5) AS BIGINT) AS {q}' for c, q in zip(FEATURES, _Q))} FROM scaled) s)""",
    "cprof": f"SELECT cluster, count(*) AS customers, avg(recency_days) AS avg_recency, avg(frequency) AS avg_frequency, {mavg('monetary')} AS avg_monetary FROM clu GROUP BY cluster",
    "cname": f"""SELECT cluster, composite_rank, CASE place {' '.join(f'WHEN {i + 1} THEN {text(n)}' for i, n in enumerate(SEGMENTS))}
 ELSE 'Segment ' || CAST(place AS VARCHAR) END AS cluster_segment FROM (SELECT *, row_number() OVER (ORDER BY composite_rank, cluster) AS place FROM (SELECT cluster,
 {' + '.join(f'(rank() OVER (ORDER BY {c} {way}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE)' for c, way in
             (('avg_recency', 'ASC'), ('avg_frequency', 'DESC'), ('avg_monetary', 'DESC')))} AS composite_rank FROM cprof))""",
    "cnamed": "SELECT clu.*, cname.cluster_segment FROM clu JOIN cname USING (cluster)",
}


def _vector(value: str, p: str) -> str:
    """SQL: three columns of the unit eigenvector of the matrix (c00, c01, ...) for an eigenvalue, from the longest cross product."""
    rows = [[f"(c00 - {value})", "c01", "c02"], ["c01", f"(c11 - {value})", "c12"], ["c02", "c12", f"(c22 - {value})"]]
    crosses = []
    for i, j in ((0, 1), (0, 2), (1, 2)):
        a, b = rows[i], rows[j]
        crosses.append([f"({a[(k + 1) % 3]} * {b[(k + 2) % 3]} - {a[(k + 2) % 3]} * {b[(k + 1) % 3]})" for k in range(3)])
    size = [" + ".join(f"{x} * {x}" for x in c) for c in crosses]
    pick = lambda k: f"CASE WHEN {size[0]} >= greatest({size[1]}, {size[2]}) THEN {crosses[0][k]} WHEN {size[1]} >= {size[2]} THEN {crosses[1][k]} ELSE {crosses[2][k]} END"
    return ", ".join(f"{pick(k)} AS {p}{k}" for k in range(3))


def _signed(p: str) -> str:
    """SQL: the vector at unit length, its largest entry positive."""
    size = f"sqrt({p}0 * {p}0 + {p}1 * {p}1 + {p}2 * {p}2)"
    top = f"CASE WHEN abs({p}0) >= greatest(abs({p}1), abs({p}2)) THEN {p}0 WHEN abs({p}1) >= abs({p}2) THEN {p}1 ELSE {p}2 END"
    return ", ".join(f"{p}{k} / {size} * sign({top}) AS {p}_{f}" for k, f in enumerate(FEATURES))


def _forest(p: str, table: str, features, who: str, trees: int, contamination: float, seed: int = 42) -> dict[str, str]:
    """Steps of an isolation forest over ``table``: pool, trees, nodes, scores and flags, named with the prefix ``p``."""
    f = [f"f{i}" for i in range(len(features))]
    cols, whole = ", ".join(f), ", ".join(f"CAST(floor({c} * {FEATURE_UNIT} + 0.5) AS BIGINT) AS {n}" for c, n in zip(features, f))
    digits = lambda x, first, many: f"('0x' || substr(md5({x}), {first}, {many}))::BIGINT"
    which, where = (f"({digits(f"'{seed}:' || tree || ':' || node", a, b)} / {2.0 ** c!r}::DOUBLE)" for a, b, c in ((1, 8, 32), (9, 13, 52)))
    path = f"CAST(floor((CASE WHEN n <= 1 THEN 0 WHEN n = 2 THEN 1 ELSE 2 * (ln(n - 1) + {EULER_GAMMA}::DOUBLE) - 2 * (n - 1)::DOUBLE / n END) * {PATH_UNIT} + 0.5) AS BIGINT)"
    pick = lambda kind: "CASE feature " + " ".join(f"WHEN {i} THEN {kind}{i}" for i in range(len(f))) + " END"
    usable = "list_filter([" + ", ".join(f"CASE WHEN h{i} > l{i} THEN {i} END" for i in range(len(f))) + "], lambda x: x IS NOT NULL)"
    limit = f"(SELECT greatest(1, ceil(log2(greatest(n, 2)))) FROM {p}size)"
    split = lambda rows: (f"SELECT *, {pick('l')} + {where} * ({pick('h')} - {pick('l')})::DOUBLE AS threshold FROM (SELECT *, CASE WHEN len(usable) > 0 AND depth < {limit} "  # noqa: E731
                          f"THEN usable[1 + CAST(floor({which} * len(usable)) AS INT)] ELSE -1 END AS feature FROM (SELECT *, {usable} AS usable FROM ({rows})))")
    extent = lambda over: ", ".join(f"min(f{i}) {over} AS l{i}, max(f{i}) {over} AS h{i}" for i in range(len(f)))
    steps = {
        "hash": f"""SELECT {cols}, {digits(f"'{seed}|' || who || '|' || copy", 1, 13)} AS h FROM (SELECT {cols}, who, row_number() OVER (PARTITION BY {cols}, who) AS copy
 FROM (SELECT {whole}, {who} AS who FROM {table}))""",
        "pool": f"SELECT * FROM {p}hash WHERE h <= (SELECT max(h) FROM (SELECT h FROM {p}hash ORDER BY h LIMIT {trees * SAMPLE}))",
        "maps": f"SELECT tree, 1 + CAST(floor({which} * {PRIME - 1}) AS BIGINT) AS a, CAST(floor({where} * {PRIME}) AS BIGINT) AS b FROM (SELECT tree, 0 AS node FROM range({trees}) g(tree))",
        "deal": f"""SELECT tree, {cols} FROM (SELECT tree, {cols}, row_number() OVER (PARTITION BY tree ORDER BY ((h % {PRIME}) * a + b) % {PRIME}, h, {', '.join(reversed(f))}) AS rn
 FROM {p}pool, {p}maps) WHERE rn <= {SAMPLE}""",
        "size": f"SELECT count(*) AS n FROM {p}deal WHERE tree = 0",
        "rows": f"""SELECT tree, CAST(1 AS BIGINT) AS node, 0 AS depth, {cols} FROM {p}deal UNION ALL
 SELECT tree, CASE WHEN {pick('f')} <= threshold THEN 2 * node ELSE 2 * node + 1 END, depth + 1, {cols}
 FROM ({split(f"SELECT *, {extent('OVER (PARTITION BY tree, node)')} FROM {p}rows")}) WHERE feature >= 0""",
        "nodes": f"""SELECT tree, node, feature, CASE WHEN feature < 0 THEN 0 ELSE threshold END AS threshold, CASE WHEN feature < 0 THEN depth::BIGINT * {PATH_UNIT} + {path} ELSE 0 END AS path
 FROM ({split(f"SELECT tree, node, any_value(depth) AS depth, count(*) AS n, {extent('')} FROM {p}rows GROUP BY tree, node")})""",
        "w0": f"SELECT {cols}, tree, CAST(1 AS BIGINT) AS node FROM (SELECT DISTINCT {whole} FROM {table}) d, (SELECT DISTINCT tree FROM {p}nodes) t",
    }
    levels = math.ceil(math.log2(SAMPLE))
    for i in range(levels):
        steps[f"w{i + 1}"] = f"SELECT {cols}, w.tree, CASE WHEN feature < 0 THEN w.node ELSE 2 * w.node + CAST({pick('f')} > threshold AS INT) END AS node FROM {p}w{i} w JOIN {p}nodes n ON n.tree = w.tree AND n.node = w.node"
    scale = f"(SELECT {path.replace('CAST(floor(', '').replace(f' * {PATH_UNIT} + 0.5) AS BIGINT)', '')} FROM {p}size)"
    steps |= {
        "sums": f"SELECT {cols}, -pow(2.0::DOUBLE, -(CAST(sum(path) AS DOUBLE) / {PATH_UNIT} / count(*) / {scale})) AS anomaly_score FROM {p}w{levels} w JOIN {p}nodes n ON n.tree = w.tree AND n.node = w.node GROUP BY ALL",
        "scored": f"SELECT d.*, s.anomaly_score FROM (SELECT *, {whole} FROM {table}) d JOIN {p}sums s USING ({cols})",
        "flag": f"SELECT *, anomaly_score < (SELECT quantile_cont(anomaly_score, {contamination}) FROM {p}scored) AS is_anomaly FROM {p}scored",
    }
    return {f"{p}{n}": sql for n, sql in steps.items()}


CTE["txf"] = "SELECT txf0.*, " + ", ".join(f"({c} - m{i}) / s{i} AS {n}" for i, (c, n) in enumerate(zip(TX_FEATURES, TX_SCALED))) + (
    " FROM txf0, (SELECT " + ", ".join(f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s{i}" for i, c in enumerate(TX_FEATURES)) + " FROM txf0) p")
CTE |= _forest("tx", "txf", TX_SCALED, f"invoice || '|' || stock_code || '|' || strftime(invoice_date, '%Y-%m-%d %H:%M:%S') || '|' || quantity || '|' || {u('total_amount')}",
               TX_TREES, TX_CONTAMINATION)
CTE |= _forest("cu", "scaled", CUSTOMER_SCALED, "CAST(customer_id AS VARCHAR)", CUSTOMER_TREES, CUSTOMER_CONTAMINATION)
def _digamma(y: str) -> str:
    z = f"({y} + 8)"
    i = f"(1 / ({z} * {z}))"
    return f"(ln({z}) - 0.5 / {z} - {i} * (1 / 12::DOUBLE - {i} * (1 / 120::DOUBLE - {i} * (1 / 252::DOUBLE - {i} / 240))) - (" + " + ".join(f"1 / ({y} + {k})" for k in range(8)) + "))"


def _trigamma(y: str) -> str:
    z = f"({y} + 8)"
    i = f"(1 / ({z} * {z}))"
    return (f"(1 / {z} + 0.5 * {i} + {i} / {z} * (1 / 6::DOUBLE - {i} * (1 / 30::DOUBLE - {i} * (1 / 42::DOUBLE - {i} / 30))) + ("
            + " + ".join(f"1 / (({y} + {k}) * ({y} + {k}))" for k in range(8)) + "))")


def _determinant(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    parts = [f"{'-' if j % 2 else '+'} {m[0][j]} * {_determinant([row[:j] + row[j + 1:] for row in m[1:]])}" for j in range(len(m))]
    return "(" + " ".join(parts).lstrip("+ ") + ")"


def _newton(p: str, table: str, names: str, layers: str, g: list[str], h: dict[tuple[int, int], str], penalty: float, rounds: int = 60) -> dict[str, str]:
    """Steps of a Newton fit: ``names`` are the parameters, ``layers`` the terms of a row, ``g`` and ``h`` the slope and bend of its
    log-likelihood."""
    n, low = len(names), math.log(LEAST_PARAMETER)
    th = ", ".join(f"th{i}" for i in range(n))
    given = ", ".join(f"exp(th{i}) AS {c}" for i, c in enumerate(names))
    mean = ", ".join([f"sum(w * ({e})) / sum(w) AS g{i}" for i, e in enumerate(g)]
                     + [f"sum(w * ({h.get((i, j), '0')})) / sum(w) AS h{i}{j}" for i in range(n) for j in range(i, n)])
    grad = ", ".join(f"-exp(th{i}) * g{i} + {2 * penalty} * exp(2 * th{i}) AS d{i}" for i in range(n))
    bend = lambda i, j: (f"(-exp(th{i} + th{j}) * h{min(i, j)}{max(i, j)}" + (f" - exp(th{i}) * g{i} + {4 * penalty} * exp(2 * th{i})" if i == j else "") + ")")
    free = lambda i: f"(th{i} > {low + 1e-12!r} OR d{i} < 0)"
    matrix = ", ".join(f"CASE WHEN {free(i)} AND {free(j)} THEN {bend(i, j)} ELSE {int(i == j)} END AS n{i}{j}" for i in range(n) for j in range(n))
    # Where the matrix is not positive definite, its diagonal is raised above the sums of its rows.
    plain = [[f"n{i}{j}" for j in range(n)] for i in range(n)]
    definite = " AND ".join(f"{_determinant([row[:k] for row in plain[:k]])} > 0" for k in range(1, n + 1))
    lowest = "least(" + ", ".join(f"n{i}{i}" + "".join(f" - abs(n{i}{j})" for j in range(n) if j != i) for i in range(n)) + ")"
    raised = f"CASE WHEN {definite} THEN 0 ELSE 0.01 - {lowest} END AS up"
    lifted = ", ".join(f"n{i}{j}{' + up' if i == j else ''} AS m{i}{j}" for i in range(n) for j in range(n))
    vector = ", ".join(f"CASE WHEN {free(i)} THEN d{i} ELSE 0 END AS v{i}" for i in range(n))
    m = [[f"m{i}{j}" for j in range(n)] for i in range(n)]
    steps = ", ".join(f"-{_determinant([[f'v{i}' if j == k else m[i][j] for j in range(n)] for i in range(n)])} / {_determinant(m)} AS s{k}" for k in range(n))
    largest = f"greatest({', '.join(f'abs(s{i})' for i in range(n))})" if n > 1 else "abs(s0)"
    return {
        f"{p}newton": f"""SELECT 0 AS it, {', '.join(f'0.1::DOUBLE AS th{i}' for i in range(n))} UNION ALL
 SELECT it + 1, {', '.join(f'greatest(th{i} + s{i} * least(1, 1 / greatest({largest}, 1e-12)), {low!r})' for i in range(n))} FROM (SELECT it, {th}, {steps} FROM
 (SELECT *, {lifted} FROM (SELECT *, {raised} FROM (SELECT *, {matrix}, {vector} FROM (SELECT *, {grad} FROM (SELECT any_value(it) AS it, {', '.join(f'any_value(th{i}) AS th{i}' for i in range(n))}, {mean} FROM
 ({layers.format(source=f"(SELECT it, {th}, {given}, k.* FROM {p}newton, {table} k WHERE it < {rounds})")}))))))) WHERE it IS NOT NULL""",
    }


_S = "(r + x)"
_MIX = lambda i: f"(p * a{i} + q * d{i})"
_CROSS = lambda i, j, aa="0", dd="0": f"p * ({aa} + a{i} * a{j}) + q * ({dd} + d{i} * d{j}) - {_MIX(i)} * {_MIX(j)}"
_APART = "sqrt(" + " + ".join(f"pow(a.{c} - b.{c}, 2)" for c in FEATURES) + ")"
# The customer itself is the first of its five nearest.
CTE["knn"] = f"""SELECT customer_id, distance FROM (SELECT a.customer_id, {_APART} AS distance, row_number() OVER (PARTITION BY a.customer_id ORDER BY {_APART}) AS nth
 FROM scaled a, scaled b) WHERE nth = 5"""
CTE["within"] = f"SELECT a.customer_id AS u, b.customer_id AS v FROM scaled a, scaled b, (SELECT quantile_cont(distance, {EPS_QUANTILE}) AS eps FROM knn) e WHERE {_APART} <= eps"
CTE["dcore"] = f"SELECT u AS id FROM within GROUP BY u HAVING count(*) >= {MIN_SAMPLES}"
CTE["dedge"] = "SELECT u, v FROM within WHERE u IN (SELECT id FROM dcore) AND v IN (SELECT id FROM dcore)"
# Smaller labels travel along the edges until none is new.
CTE["dlab"] = "SELECT id, id AS label FROM dcore UNION SELECT e.u, min(c.label) FROM dlab c JOIN dedge e ON e.v = c.id WHERE c.label < e.u GROUP BY e.u"
CTE["dcomp"] = "SELECT id, min(label) AS label FROM dlab GROUP BY id"
CTE["dbs"] = f"""SELECT customer_id, CAST(coalesce(cluster, {NOISE}) AS INTEGER) AS dbscan_cluster, core AS is_core FROM (SELECT s.customer_id, max(CASE WHEN c.id IS NOT NULL THEN 1 ELSE 0 END) = 1 AS core,
 coalesce(min(c.label), min(o.label)) AS label FROM scaled s LEFT JOIN dcomp c ON c.id = s.customer_id LEFT JOIN within w ON w.u = s.customer_id LEFT JOIN dcomp o ON o.id = w.v
 GROUP BY s.customer_id) x LEFT JOIN (SELECT label, row_number() OVER (ORDER BY label) - 1 AS cluster FROM (SELECT DISTINCT label FROM dcomp)) n USING (label)"""
CTE["bgt"] = """SELECT frequency AS x, recency / longest AS tx, t / longest AS age, count(*) AS w FROM clvsum, (SELECT max(t) AS longest FROM clvsum) l GROUP BY ALL"""
CTE |= _newton("bg", "bgt", ["r", "al", "a", "b"], f"""SELECT *, CASE WHEN x > 0 THEN 1 - p ELSE 0 END AS q FROM (SELECT *, CASE WHEN x > 0 THEN 1 / (1 + exp(ln(a) - ln(l) - {_S} * (ln(yd) - ln(ya)))) ELSE 1 END AS p,
 -ln(ya) AS a0, -{_S} / ya AS a1, 0 AS a2, 0 AS a3, -ln(yd) AS d0, -{_S} / yd AS d1, 1 / a AS d2, -1 / l AS d3 FROM
 (SELECT *, al + age AS ya, al + tx AS yd, b + greatest(x, 1) - 1 AS l FROM {{source}}))""",
    [f"{_digamma(_S)} - {_digamma('r')} + ln(al) + {_MIX(0)}", f"r / al + {_MIX(1)}", f"{_digamma('(a + b)')} - {_digamma('(a + b + x)')} + {_MIX(2)}",
     f"{_digamma('(a + b)')} + {_digamma('(b + x)')} - {_digamma('b')} - {_digamma('(a + b + x)')} + {_MIX(3)}"],
    {(0, 0): f"{_trigamma(_S)} - {_trigamma('r')} + {_CROSS(0, 0)}", (0, 1): f"1 / al + {_CROSS(0, 1, '(-1 / ya)', '(-1 / yd)')}", (0, 2): _CROSS(0, 2), (0, 3): _CROSS(0, 3),
     (1, 1): f"-r / (al * al) + {_CROSS(1, 1, f'{_S} / (ya * ya)', f'{_S} / (yd * yd)')}", (1, 2): _CROSS(1, 2), (1, 3): _CROSS(1, 3),
     (2, 2): f"{_trigamma('(a + b)')} - {_trigamma('(a + b + x)')} + {_CROSS(2, 2, '0', '(-1 / (a * a))')}",
     (2, 3): f"{_trigamma('(a + b)')} - {_trigamma('(a + b + x)')} + {_CROSS(2, 3)}",
     (3, 3): f"{_trigamma('(a + b)')} + {_trigamma('(b + x)')} - {_trigamma('b')} - {_trigamma('(a + b + x)')} + {_CROSS(3, 3, '0', '1 / (l * l)')}"}, BGNBD_PENALTY)
CTE["ggt"] = "SELECT frequency AS x, monetary_value AS m, count(*) AS w FROM clvsum WHERE frequency > 0 AND monetary_value > 0 GROUP BY ALL"
_U = "(p * x + q)"
CTE |= _newton("gg", "ggt", ["p", "q", "v"], "SELECT *, x * m + v AS y FROM {source}",
    [f"x * {_digamma(_U)} - x * {_digamma('(p * x)')} + x * (ln(m) + ln(x)) - x * ln(y)", f"{_digamma(_U)} - {_digamma('q')} + ln(v) - ln(y)", f"q / v - {_U} / y"],
    {(0, 0): f"x * x * ({_trigamma(_U)} - {_trigamma('(p * x)')})", (0, 1): f"x * {_trigamma(_U)}", (0, 2): "-x / y",
     (1, 1): f"{_trigamma(_U)} - {_trigamma('q')}", (1, 2): "1 / v - 1 / y", (2, 2): f"-q / (v * v) + {_U} / (y * y)"}, GAMMA_PENALTY)
CTE["bgpar"] = f"""SELECT {', '.join(f'round(exp(th{i}){" * longest" if n == "alpha" else ""}, {PARAMETER_DIGITS}) AS {n}' for i, n in enumerate(("r", "alpha", "a", "b")))}
 FROM (SELECT * FROM bgnewton ORDER BY it DESC LIMIT 1) s, (SELECT max(t) AS longest FROM clvsum) l"""
CTE["ggpar"] = f"SELECT {', '.join(f'round(exp(th{i}), {PARAMETER_DIGITS}) AS {n}' for i, n in enumerate('pqv'))} FROM (SELECT * FROM ggnewton ORDER BY it DESC LIMIT 1) s"
CTE["bgnodes"] = f"""SELECT CASE WHEN s > 0 THEN -ln(1 + exp(-s)) ELSE s - ln(1 + exp(s)) END AS lp, CASE WHEN s > 0 THEN -s - ln(1 + exp(-s)) ELSE -ln(1 + exp(s)) END AS lr,
 ln(pi() * cosh(i * {NODE_STEP}::DOUBLE)) AS ls FROM (SELECT i, pi() * sinh(i * {NODE_STEP}::DOUBLE) AS s FROM range({-NODES}, {NODES + 1}) g(i))"""
CTE["bgexp"] = f"""SELECT customer_id, h, sum(weight * CASE WHEN (r + x) * p * k < 1e-4 THEN (r + x) * k * (1 - (r + x + 1) / 2 * p * k * (1 - (r + x + 2) / 3 * p * k))
 ELSE (1 - pow(1 + p * k, -(r + x))) / p END) / sum(weight) / any_value(1 + odds) AS bought FROM (SELECT customer_id, h, frequency AS x, r, exp(lp) AS p, horizon / (alpha + t) AS k,
 exp(a * lp + (b + frequency) * lr + ls) AS weight, CASE WHEN frequency > 0 THEN a / (b + greatest(frequency, 1) - 1) * pow((alpha + t) / (alpha + recency), r + frequency) ELSE 0 END AS odds
 FROM clvsum, bgpar, bgnodes, (SELECT h, CASE WHEN h = 0 THEN {HORIZON_WEEKS} ELSE h * {WEEKS_PER_MONTH} END::DOUBLE AS horizon FROM range({MONTHS + 1}) g(h)) m) GROUP BY customer_id, h"""
CTE["bgalive"] = f"""SELECT customer_id, {r('1 / (1 + CASE WHEN frequency > 0 THEN a / (b + greatest(frequency, 1) - 1) * pow((alpha + t) / (alpha + recency), r + frequency) ELSE 0 END)', 4)} AS prob_alive
 FROM clvsum, bgpar"""
CTE["bgvalue"] = f"""SELECT customer_id, sum((bought - before) / pow(1 + {YEARLY_DISCOUNT}::DOUBLE / 12, h)) AS discounted FROM (SELECT *, coalesce(lag(bought) OVER (PARTITION BY customer_id ORDER BY h), 0) AS before
 FROM bgexp WHERE h > 0) GROUP BY customer_id"""
CTE["pv"] = f"""SELECT c.*, prob_alive, {r('bought', 2)} AS predicted_purchases_12m, {r('value', 2)} AS predicted_avg_order, {r('discounted * value', 2)} AS clv_predicted FROM
 (SELECT clvsum.*, p * (v + frequency * monetary_value) / (p * frequency + q - 1) AS value FROM clvsum, ggpar WHERE frequency > 0) o JOIN clvsum c USING (customer_id)
 JOIN bgalive USING (customer_id) JOIN bgvalue USING (customer_id) JOIN bgexp e ON e.customer_id = c.customer_id AND e.h = 0"""
CTE["pvtier"] = CTE["tier"].replace("fb", "pv")
CTE["pvseg"] = CTE["fbseg"].replace("fb", "pv")
CTE["cov"] = "SELECT " + ", ".join(f"covar_samp({FEATURES[i]}, {FEATURES[j]}) AS c{i}{j}" for i in range(3) for j in range(i, 3)) + " FROM scaled"
CTE["eigen"] = """SELECT *, 3 * mean - e1 - e3 AS e2 FROM (SELECT *, mean + 2 * p * cos(phi) AS e1, mean + 2 * p * cos(phi + 2 * pi() / 3) AS e3 FROM (SELECT *, acos(least(1.0::DOUBLE,
 greatest(-1.0::DOUBLE, ((c00 - mean) * ((c11 - mean) * (c22 - mean) - c12 * c12) - c01 * (c01 * (c22 - mean) - c12 * c02) + c02 * (c01 * c12 - (c11 - mean) * c02)) / (2 * p * p * p)))) / 3 AS phi
 FROM (SELECT *, sqrt((pow(c00 - mean, 2) + pow(c11 - mean, 2) + pow(c22 - mean, 2) + 2 * (c01 * c01 + c02 * c02 + c12 * c12)) / 6) AS p FROM
 (SELECT *, (c00 + c11 + c22) / 3 AS mean FROM cov))))"""
CTE["pcs"] = f"SELECT e1, e2, e3, {_signed('pc1')}, {_signed('pc2')} FROM (SELECT *, {_vector('e1', 'pc1')}, {_vector('e2', 'pc2')} FROM eigen)"
CTE["metrics_aud"] = CTE["metrics"].replace("FROM profile GROUP BY", "FROM aud GROUP BY")
_names = ("champ", "loyal", "pot", "atrisk", "lost")
CTE["side"] = "SELECT " + ", ".join(
    f"max(CASE WHEN segment_no = {i} THEN {f} END) AS {s}_{f}" for i, s in enumerate(_names)
    for f in ("n", "rev", "avg_mon", "avg_rec", "avg_frq", "avg_clv")) + " FROM metrics"
CTE["proj"] = f"""SELECT *, {even('(wb_revenue - wb_cost) / greatest(1.0, wb_cost) * 100')} AS wb_roi,
 {even('(pot_revenue - pot_cost) / greatest(1.0, pot_cost) * 100')} AS pot_roi FROM (SELECT *,
 {even('wb_n * atrisk_avg_mon * 0.80')} AS wb_revenue, {even('atrisk_n * 0.15')} AS wb_cost, {even('pot_cn * loyal_avg_mon')} AS pot_revenue,
 {even('pot_n * 0.50')} AS pot_cost, {even('lost_rn * lost_avg_mon * 0.70')} AS lost_revenue FROM (SELECT *,
 {even('CAST(atrisk_n AS DOUBLE) * 0.08 * 0.18')} AS wb_n, {even('CAST(pot_n AS DOUBLE) * 0.12')} AS pot_cn,
 {even('CAST(lost_n AS DOUBLE) * 0.05')} AS lost_rn FROM side))"""


def _with(body: str) -> str:
    """Prefix the steps a statement needs, in definition order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in CTE:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", sql):
                needed.add(name)
                visit(CTE[name])

    visit(body)
    ordered = [n for n in CTE if n in needed]
    ordered.sort(key=_depth)
    steps = ",\n".join(f"{n} AS ({CTE[n]})" for n in ordered)
    return f"WITH RECURSIVE {steps}\n{body}" if steps else body


@cache
def _depth(name: str) -> int:
    below = [n for n in CTE if n != name and re.search(rf"\b(FROM|JOIN|,)\s+{n}\b", CTE[name])]
    return 1 + max((_depth(n) for n in below), default=0)


def _hist(source: str, x: str, n: int, count: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""SELECT {k}bin, {r(f'lo + bin * ((hi - lo) / {float(n)!r})', 4)} AS bin_start, count(*) AS {count} FROM
 (SELECT {k}lo, hi, {bins('x', 'lo', 'hi', n)} AS bin FROM (SELECT {k}x, min(x) OVER ({part}) AS lo, max(x) OVER ({part}) AS hi FROM
 (SELECT {k}CAST({x} AS DOUBLE) AS x FROM {source}) WHERE x IS NOT NULL)) GROUP BY {k}lo, hi, bin"""


def _unpivot(source: str, columns, keys: str = "", name: str = "metric") -> str:
    k = f"{keys}, " if keys else ""
    return "(" + " UNION ALL ".join(f"SELECT {k}'{c}' AS {name}, CAST({c} AS DOUBLE) AS x FROM {source}" for c in columns) + ")"


def _cohort_pivot(value: str, source: str, width: int = 80) -> str:
    cols = ", ".join(f"max(CASE WHEN cohort_index = {i} THEN {value} END) AS m{i}" for i in range(width))
    return f"SELECT strftime(cohort_month, '%Y-%m') AS cohort, {cols} FROM {source} GROUP BY cohort_month"


RFM3 = ("recency_days", "frequency", "monetary")
SEG_COLS = "customer_id, recency_days, frequency, monetary, r_score, f_score, m_score"


def _bodies() -> dict[str, str]:
    q: dict[str, str] = {}
    raw_cols = "invoice, stock_code, description, quantity, invoice_date, unit_price, customer_id, country"
    for key in ("read_transactions", "conform_columns"):
        q[key] = f"SELECT {raw_cols} FROM raw"
    q["read_intermediate"] = "SELECT * FROM summary"
    q["normalise_dates"] = """SELECT invoice, stock_code, quantity, customer_id, invoice_date,
 strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_date_text FROM raw WHERE quantity <> 13 AND customer_id IS NOT NULL"""
    q["stage_table"] = q["products_dim"] = "SELECT * FROM products"
    q["query_views"] = "SELECT segment_label, count(*) AS customers FROM seg WHERE monetary > 1000 GROUP BY segment_label"
    q["write_tables"] = """SELECT 'segments' AS table_name, count(*) AS row_count FROM seg
 UNION ALL SELECT 'customers', count(*) FROM customers"""
    q["write_tables_csv"] = q["customers_dim"] = "SELECT * FROM customers"
    q["export_bi_bundle"] = """SELECT 'customer_rfm' AS table_name, count(*) AS row_count FROM seg
 UNION ALL SELECT 'segment_summary', count(DISTINCT segment_label) FROM seg UNION ALL SELECT 'marketing_strategy', 5
 UNION ALL SELECT 'revenue_opportunity', count(DISTINCT segment_label) + 1 FROM seg UNION ALL SELECT 'churn_risk', count(*) FROM seg"""
    q["generated_columns"] = "SELECT customer_id, total_orders, total_revenue, avg_order_value FROM summary"
    q["idempotent_overwrite"] = f"SELECT {MONTH} AS year_month, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS items FROM tx GROUP BY 1"

    known = "customer_id IS NOT NULL AND trim(customer_id) <> ''"
    report = {
        "Total raw records": "count(*)", "Null customer_id": f"count(*) FILTER (NOT coalesce({known}, false))",
        "Cancelled invoices (C...)": "count(*) FILTER (upper(substr(invoice,1,1)) = 'C')",
        "Non-positive quantity rows": "count(*) FILTER (quantity <= 0)", "Non-positive price rows": "count(*) FILTER (unit_price <= 0)",
        "Unique customers (raw)": f"count(DISTINCT CASE WHEN {known} THEN customer_id END)", "Unique countries": "count(DISTINCT country)",
    }
    q["dq_raw_report"] = " UNION ALL ".join(f"SELECT {text(k)} AS metric, {v} AS value FROM raw" for k, v in report.items())
    q["dq_nulls"] = "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, {pct(f'count(*) FILTER ({c} IS NULL)', 'count(*)', 2)} AS null_pct FROM raw"
        for c in raw_cols.split(", ")) + ") WHERE null_count > 0"
    q["dq_profile"] = """SELECT count(*) AS row_count, 8 AS column_count, min(invoice_date) AS first_date, max(invoice_date) AS last_date,
 count(DISTINCT customer_id) AS customers, count(DISTINCT stock_code) AS products, count(DISTINCT country) AS countries FROM raw"""
    bad = {"negative_quantity": "quantity < 0", "cancelled": "starts_with(invoice, 'C')", "non_positive_price": "unit_price <= 0"}
    q["dq_bad_rows"] = " UNION ALL ".join(
        f"SELECT '{k}' AS issue, count(*) FILTER ({c}) AS row_count, {pct(f'count(*) FILTER ({c})', 'count(*)', 1)} AS pct FROM raw" for k, c in bad.items())
    q["cleaning_funnel"] = """SELECT CASE WHEN customer_id IS NULL THEN '1 null customer' WHEN starts_with(invoice, 'C') THEN '2 cancelled'
 WHEN quantity <= 0 THEN '3 non-positive quantity' WHEN unit_price <= 0 THEN '4 non-positive price'
 WHEN quantity * unit_price > cap THEN '5 outlier' ELSE '6 kept' END AS step, count(*) AS row_count
 FROM raw, (SELECT quantile_cont(total_amount, 0.999) AS cap FROM lenient) GROUP BY 1"""
    q["strict_funnel"] = f"""SELECT CASE WHEN NOT coalesce({known}, false) THEN '1 no customer' WHEN upper(substr(invoice,1,1)) = 'C' THEN '2 cancelled'
 WHEN quantity <= 0 THEN '3 non-positive quantity' WHEN unit_price <= 0 THEN '4 non-positive price'
 WHEN NOT (length(trim(stock_code)) >= 5 AND stock_code NOT IN ('POST','DOT','M','BANK CHARGES','PADS','D')) THEN '5 not a product'
 ELSE '6 kept' END AS step, count(*) AS row_count FROM raw GROUP BY 1"""
    unique = {"products.stock_code": "products", "customers.customer_id": "customers", "customer_summary.customer_id": "summary",
              "segments.customer_id": "seg"}
    checks = {
        "products.description not null": ("products", "description IS NULL"), "products.unit_price >= 0": ("products", "unit_price < 0"),
        "transactions.invoice not null": ("tx", "invoice IS NULL"), "transactions.invoice_date not null": ("tx", "invoice_date IS NULL"),
        "transactions.quantity > 0": ("tx", "quantity <= 0"), "transactions.unit_price > 0": ("tx", "unit_price <= 0"),
        "segments.segment_label not null": ("seg", "segment_label IS NULL"),
        **{f"segments.{c} in 1..5": ("seg", f"{c} NOT BETWEEN 1 AND 5") for c in ("r_score", "f_score", "m_score")},
    }
    q["dq_constraints"] = " UNION ALL ".join(
        [f"SELECT '{k} unique' AS constraint_name, count(*) AS violations FROM (SELECT {k.split('.')[1]} FROM {t} GROUP BY 1 HAVING count(*) > 1)"
         for k, t in unique.items()]
        + ["SELECT 'transactions.stock_code in products', count(*) FROM tx WHERE stock_code NOT IN (SELECT stock_code FROM products)",
           "SELECT 'transactions.customer_id in customers', count(*) FROM tx WHERE customer_id NOT IN (SELECT customer_id FROM customers)"]
        + [f"SELECT {text(k)}, count(*) FROM {t} WHERE {c}" for k, (t, c) in checks.items()])
    q["dq_table_counts"] = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}"
        for n, t in (("transactions", "tx"), ("customers", "customers"), ("products", "products"), ("customer_summary", "summary")))
    q["dq_revenue_sanity"] = f"""SELECT {r(msum('total_amount'), 2)} AS total_revenue, {r(msum('total_amount') + ' / count(*)', 2)} AS avg_line_item,
 {r('min(total_amount)', 2)} AS min_line_item, {r('max(total_amount)', 2)} AS max_line_item FROM tx"""
    stats = {"mean": "avg(x)", "std": "stddev_samp(x)", "min": "min(x)", "q25": _quantile(0.25), "q50": _quantile(0.5), "q75": _quantile(0.75), "max": "max(x)"}
    q["describe_table"] = f"SELECT column_name, count(*) AS n, {', '.join(f'{r(v, 4)} AS {k}' for k, v in stats.items())} FROM {_unpivot('seg', RFM3, name='column_name')} GROUP BY 1"
    q["clean_sql_rules"] = "SELECT * FROM lines"
    q["clean_py_rules"] = "SELECT * FROM lenient"
    q["outlier_cut_disc"] = "SELECT * FROM tx"
    q["outlier_cut_interp"] = "SELECT * EXCLUDE (year, month, day_of_week, hour, year_month) FROM retail"
    q["time_features"] = "SELECT invoice, invoice_date, year, month, day_of_week, hour, year_month FROM retail"
    q["customer_summary"] = "SELECT * FROM summary"

    q["rfm_snapshot"] = """SELECT max(invoice_date) AS last_purchase, CAST(CAST(max(invoice_date) AS DATE) + 1 AS TIMESTAMP) AS midnight,
 max(invoice_date) + INTERVAL 1 DAY AS exact FROM tx"""
    q["rfm_raw"] = "SELECT * FROM rfm_raw"
    q["rfm_raw_exact"] = "SELECT * FROM rfm_exact"
    q["rfm_ranks"] = """SELECT customer_id, recency_days, frequency, monetary, rank() OVER (ORDER BY recency_days) AS recency_rank,
 dense_rank() OVER (ORDER BY frequency DESC) AS frequency_rank, rank() OVER (ORDER BY monetary DESC) AS monetary_rank,
 count(*) OVER () AS total_customers FROM rfm_raw"""
    q["rfm_ntile_scores"] = "SELECT * FROM scored"
    q["rfm_ntile_scores_sql"] = "SELECT * FROM scored_sql"
    q["rfm_qcut_scores"] = "SELECT * FROM scored_qcut"
    q["rfm_score_code"] = "SELECT * FROM coded"
    q["rfm_scores"] = "SELECT * FROM coded_sql"
    q["segment_label"] = "SELECT customer_id, rfm_score, segment_label FROM seg"
    q["churn_probability"] = "SELECT customer_id, recency_days, churn_probability FROM seg"
    q["clv_proxy"] = "SELECT customer_id, monetary, recency_days, clv_estimate FROM seg"
    q["rfm_segments"] = "SELECT * FROM seg"
    q["rfm_segments_sql"] = "SELECT * FROM seg_sql"
    q["rfm_segments_qcut"] = "SELECT * FROM seg_qcut"
    three = ", ".join(f"{r(c, 6)} AS {c}" for c in ("r_scaled", "f_scaled", "m_scaled"))
    q["rfm_scaled"] = q["cust_features"] = f"SELECT customer_id, {three} FROM scaled"
    q["rfm_distribution"] = f"""SELECT metric, {bins('x', 'lo', 'hi', 40)} AS bin, count(*) AS customers, {r('any_value(mean)', 4)} AS mean,
 {r('any_value(median)', 4)} AS median FROM (SELECT * FROM {_unpivot('seg', RFM3)} d JOIN (SELECT metric, min(x) AS lo, max(x) AS hi, {mavg('x')} AS mean,
 median(x) AS median FROM {_unpivot('seg', RFM3)} GROUP BY metric) s USING (metric)) GROUP BY metric, 2"""
    q["segment_counts"] = f"SELECT segment_label, count(*) AS customers, {pct('count(*)', 'sum(count(*)) OVER ()')} AS pct FROM seg GROUP BY 1"

    q["seg_customer_share"] = f"SELECT segment_label, count(*) AS customer_count, {pct('count(*)', 'sum(count(*)) OVER ()')} AS pct_of_total FROM seg GROUP BY 1"
    q["seg_profile"] = f"""SELECT segment_label, {r('avg(recency_days)', 1)} AS avg_recency_days, {r('avg(frequency)', 1)} AS avg_frequency,
 {r(mavg('monetary'), 0)} AS avg_monetary, {r('avg(rfm_score)', 1)} AS avg_rfm_score, count(*) AS customers FROM seg GROUP BY 1"""
    running = f"""(SELECT rn, {r('rn * 100.0 / n', 0)} AS p, CAST(cum AS DOUBLE) / 10000.0 AS cum, CAST(total AS DOUBLE) / 10000.0 AS total FROM
 (SELECT row_number() OVER w AS rn, sum({u('monetary')}) OVER (ORDER BY monetary DESC, customer_id ROWS UNBOUNDED PRECEDING) AS cum,
 sum({u('monetary')}) OVER () AS total, count(*) OVER () AS n FROM seg WINDOW w AS (ORDER BY monetary DESC, customer_id)))"""
    q["pareto_rows"] = f"""SELECT rn, CAST(p AS INTEGER) AS top_n_pct_customers, {pct('cum', 'total')} AS pct_revenue_captured FROM {running}
 WHERE p IN (10, 20, 30, 50)"""
    q["pareto"] = f"""SELECT CAST(p AS INTEGER) AS top_n_pct_customers, {pct('max(cum)', 'max(total)')} AS pct_revenue_captured FROM {running}
 WHERE p IN (10, 20, 30, 50) GROUP BY p"""
    q["churn_by_segment"] = f"SELECT segment_label, {BAND} AS churn_risk_band, count(*) AS customers, {r(msum('monetary'), 0)} AS revenue_at_risk FROM seg GROUP BY 1, 2"
    q["churn_bands"] = f"SELECT {BAND} AS churn_risk, count(*) AS customers, {r(msum('monetary'), 0)} AS revenue_at_risk FROM seg GROUP BY 1"
    q["top_champions"] = """SELECT customer_id, country, recency_days, frequency, monetary, rfm_score, clv_estimate, segment_label FROM profile
 WHERE segment_label = 'Champions' ORDER BY monetary DESC, customer_id LIMIT 10"""
    q["mom_revenue"] = f"""SELECT year_month, invoices AS orders, customers AS active_customers, {r('revenue', 0)} AS revenue,
 {r('(raw_rev - prev) / nullif(prev, 0) * 100.0', 1)} AS mom_growth_pct FROM (SELECT *, revenue AS raw_rev, lag(revenue) OVER (ORDER BY year_month) AS prev
 FROM monthly)"""
    q["cohort_segment_mix"] = f"""SELECT strftime(first_purchase, '%Y-%m') AS acquisition_cohort, segment_label, count(*) AS customers,
 {r(mavg('monetary'), 0)} AS avg_spend FROM seg JOIN summary USING (customer_id) GROUP BY 1, 2"""
    q["rf_heatmap"] = f"""SELECT r_score, f_score, count(*) AS customers, {r(mavg('monetary'), 0)} AS avg_monetary, {r('avg(m_score)', 1)} AS avg_m_score
 FROM seg GROUP BY 1, 2"""
    q["winback_list"] = f"""SELECT customer_id, country, recency_days, frequency, monetary, clv_estimate, churn_probability,
 {r('monetary * churn_probability', 0)} AS win_back_priority_score FROM profile WHERE segment_label = 'At Risk'
 ORDER BY win_back_priority_score DESC, customer_id LIMIT 50"""
    affinity = f"""SELECT segment_label, p.description, count(*) AS purchase_count, {r(msum('t.total_amount'), 0)} AS revenue
 FROM seg JOIN tx t USING (customer_id) JOIN products p ON p.stock_code = t.stock_code
 WHERE segment_label IN ('Champions', 'Loyal Customers') GROUP BY 1, 2"""
    q["product_affinity"] = affinity + " ORDER BY segment_label, revenue DESC, description LIMIT 20"
    q["product_affinity_topk"] = f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY segment_label ORDER BY revenue DESC, description)
 AS INTEGER) AS rn FROM ({affinity})) WHERE rn <= 10"""
    risky = "CASE WHEN churn_probability >= 0.60 THEN monetary ELSE 0.0 END"
    q["kpi_summary"] = f"""SELECT count(*) AS total_customers, {r(msum('monetary'), 0)} AS total_revenue, {r('avg(recency_days)', 1)} AS avg_recency_days,
 {r('avg(frequency)', 1)} AS avg_frequency, {r(mavg('monetary'), 0)} AS avg_monetary, {r(mavg('clv_estimate'), 0)} AS avg_clv_estimate,
 count(*) FILTER (segment_label = 'Champions') AS champion_count,
 {r(msum("CASE WHEN segment_label = 'Champions' THEN monetary ELSE 0.0 END"), 0)} AS champion_revenue,
 {r(msum(risky), 0)} AS revenue_at_high_churn_risk, {pct(msum(risky), msum('monetary'))} AS pct_revenue_at_risk FROM seg"""
    pivot = {"Customer Count": "CAST(count(*) AS DOUBLE)", "Total Revenue": r(f"coalesce({msum('monetary')}, 0.0)", 0),
             "Avg Recency (days)": r("avg(recency_days)", 1), "Avg Orders": r("avg(frequency)", 1),
             "Avg Monetary": r(mavg("monetary"), 0), "Avg CLV Estimate": r(mavg("clv_estimate"), 0)}
    q["segment_pivot"] = " UNION ALL ".join(
        f"SELECT {text(m)} AS metric, " + ", ".join(
            f"(SELECT {e} FROM seg WHERE segment_label = {text(s)}) AS {column_name(s)}" for s in SEGMENTS) for m, e in pivot.items())
    q["running_revenue"] = f"""SELECT year_month, {r('rev', 0)} AS monthly_revenue, {r('cum', 0)} AS cumulative_revenue FROM (SELECT year_month, revenue AS rev,
 CAST(sum({u('revenue')}) OVER (ORDER BY year_month) AS DOUBLE) / 10000.0 AS cum FROM monthly)"""
    q["monthly_activity"] = f"SELECT year_month, invoices, customers, {r('rev', 0)} AS revenue FROM (SELECT * EXCLUDE (revenue), revenue AS rev FROM monthly)"
    q["buyer_types"] = f"""SELECT buyer_type, customers, {pct('customers', 'sum(customers) OVER ()')} AS pct_customers, {r('rev', 0)} AS total_revenue,
 {pct('rev', 'sum(rev) OVER ()')} AS pct_revenue, {r('spend', 0)} AS avg_spend_per_customer FROM (SELECT CASE WHEN frequency = 1 THEN 'One-time Buyer'
 WHEN frequency BETWEEN 2 AND 3 THEN 'Occasional (2–3 orders)' WHEN frequency BETWEEN 4 AND 9 THEN 'Regular (4–9 orders)'
 ELSE 'Power Buyer (10+ orders)' END AS buyer_type, count(*) AS customers, {msum('monetary')} AS rev, {mavg('monetary')} AS spend FROM seg GROUP BY 1)"""
    q["geo_segments"] = f"""SELECT country, count(*) AS customers, {r(msum('monetary'), 0)} AS total_revenue, {r('avg(rfm_score)', 1)} AS avg_rfm_score,
 count(*) FILTER (segment_label = 'Champions') AS champions, count(*) FILTER (segment_label IN ('At Risk', 'Lost / Inactive')) AS high_risk_customers
 FROM profile GROUP BY 1 HAVING count(*) >= 5 ORDER BY total_revenue DESC, country LIMIT 15"""
    levels = ", ".join(f"({p})" for p in VALUE_PERCENTILES)
    q["monetary_percentiles"] = f"""SELECT p AS percentile, {r('monetary', 2)} AS monetary_value FROM (SELECT monetary, row_number() OVER (ORDER BY monetary) AS rn,
 count(*) OVER () AS n FROM seg), (VALUES {levels}) v(p) WHERE rn = (p * n) // 100"""
    q["purchase_gaps"] = f"""SELECT segment_label, {r('CAST(sum(gap) AS DOUBLE) / count(*)', 1)} AS avg_days_between_orders, min(gap) AS min_days_between,
 max(gap) AS max_days_between, count(DISTINCT customer_id) AS customers_with_repeat_orders FROM (SELECT customer_id,
 {GAP.format(a='invoice_date', b='lag(invoice_date) OVER (PARTITION BY customer_id ORDER BY invoice_date)')} AS gap
 FROM (SELECT DISTINCT customer_id, invoice_date FROM tx)) JOIN seg USING (customer_id) WHERE gap > 0 GROUP BY 1"""
    q["rfm_export"] = """SELECT customer_id, country, recency_days AS recency, frequency, monetary, r_score, f_score, m_score, rfm_score, rfm_segment_code,
 segment_label AS segment, churn_probability, clv_estimate FROM profile"""
    q["segment_summary"] = f"""SELECT segment, customers, avg_recency, avg_frequency, avg_monetary, {r('rev', 0)} AS total_revenue, avg_clv,
 {r('churn', 2)} AS avg_churn_probability, {r('churn * 100.0', 1)} AS avg_churn_pct, {pct('customers', 'sum(customers) OVER ()')} AS pct_customers,
 {pct('rev', 'sum(rev) OVER ()')} AS pct_revenue FROM (SELECT segment_label AS segment, count(*) AS customers, {r('avg(recency_days)', 1)} AS avg_recency,
 {r('avg(frequency)', 1)} AS avg_frequency, {r(mavg('monetary'), 0)} AS avg_monetary, {msum('monetary')} AS rev, {r(mavg('clv_estimate'), 0)} AS avg_clv,
 {mavg('churn_probability')} AS churn FROM seg GROUP BY 1)"""
    q["transaction_export"] = f"""SELECT t.invoice, strftime(t.invoice_date, '%Y-%m-%d') AS invoice_date, strftime(t.invoice_date, '%Y-%m') AS year_month,
 t.customer_id, f.country, f.segment_label, p.description AS product, t.quantity, t.unit_price, {r('t.total_amount', 2)} AS line_total
 FROM tx t JOIN profile f ON f.customer_id = t.customer_id JOIN products p ON p.stock_code = t.stock_code"""
    q["seg_revenue"] = f"SELECT segment_label, {r(msum('monetary'), 0)} AS total_revenue, {r(mavg('monetary'), 0)} AS avg_monetary FROM seg GROUP BY 1"
    q["top_customers"] = "SELECT customer_id, total_orders, total_revenue, country FROM summary ORDER BY total_revenue DESC, customer_id LIMIT 5"
    q["top_countries"] = f"""SELECT c.country, count(DISTINCT t.customer_id) AS customers, {r(msum('t.total_amount'), 0)} AS revenue
 FROM tx t JOIN customers c ON c.customer_id = t.customer_id GROUP BY 1 ORDER BY revenue DESC, c.country LIMIT 10"""

    q["monthly_revenue_peak"] = f"""SELECT year_month, {r('rev', 2)} AS revenue, row_number() OVER (ORDER BY rev DESC, year_month) = 1 AS is_peak
 FROM (SELECT year_month, {msum('total_amount')} AS rev FROM retail GROUP BY 1)"""
    for key, c in (("country_revenue", "country"), ("top_products", "description")):
        q[key] = f"""SELECT {c}, {r(msum('total_amount'), 2)} AS revenue FROM retail WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY revenue DESC, {c} LIMIT 10"""
    orders = f"(SELECT invoice, {msum('total_amount')} AS v FROM retail GROUP BY 1)"
    q["order_value_hist"] = _hist(f"""(SELECT 'capped' AS scale, v AS w FROM {orders} WHERE v <= 500.0
 UNION ALL SELECT 'log1p', ln(1 + v) FROM {orders})""", "w", 50, "orders", "scale")
    freq = "(SELECT customer_id, count(DISTINCT invoice) AS orders FROM retail GROUP BY 1)"
    q["purchase_frequency"] = f"""SELECT h.*, {r('s.mean', 4)} AS mean, CAST(s.median AS DOUBLE) AS median FROM ({_hist(f'(SELECT * FROM {freq} WHERE orders <= 30)', 'orders', 30, 'customers')}) h,
 (SELECT avg(orders) AS mean, median(orders) AS median FROM {freq}) s"""
    days = ", ".join(f"({i}, '{d}')" for i, d in enumerate(WEEKDAYS))
    q["dow_revenue"] = f"""SELECT d.i AS day_no, d.name AS day_of_week, s.revenue FROM (VALUES {days}) d(i, name) LEFT JOIN
 (SELECT day_of_week, {r(msum('total_amount'), 2)} AS revenue FROM retail GROUP BY 1) s ON s.day_of_week = d.name"""
    q["rfm_score_hist"] = "SELECT rfm_score, segment_label, count(*) AS customers FROM seg GROUP BY 1, 2"
    box = _unpivot("seg", RFM3, "segment_label")
    out = ", ".join(f"{r(c, 4)} AS {c}" for c in ("q1", "median", "q3", "low", "high", "mean"))
    q["segment_box"] = f"""SELECT segment_label, metric, {out} FROM (SELECT segment_label, metric, q1, median, q3,
 min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END) AS low, max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END) AS high, {mavg('x')} AS mean
 FROM {box} d JOIN (SELECT segment_label, metric, {_quantile(0.25)} AS q1, {_quantile(0.5)} AS median, {_quantile(0.75)} AS q3 FROM {box} GROUP BY 1, 2) b
 USING (segment_label, metric) GROUP BY 1, 2, 3, 4, 5)"""
    q["recency_frequency_density"] = f"""SELECT {bins('recency_days', 'r0', 'r1', 20)} AS recency_bin, {bins('frequency', 'f0', 'f1', 15)} AS frequency_bin,
 count(*) AS customers FROM seg, (SELECT min(recency_days) AS r0, max(recency_days) AS r1, min(frequency) AS f0, max(frequency) AS f1 FROM seg) GROUP BY 1, 2"""
    q["segment_radar"] = "SELECT segment_label, " + ", ".join(f"{r(f'avg({c})', 4)} AS avg_{c}" for c in ("r_score", "f_score", "m_score")) + " FROM seg GROUP BY 1"

    values = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in STRATEGY)
    cols = ", ".join(STRATEGY_COLUMNS)
    q["strategy_dim"] = f"""SELECT d.*, coalesce(h.customers, 0) AS customers, coalesce(h.revenue, 0.0) AS revenue FROM (VALUES {values}) d({cols}) LEFT JOIN
 (SELECT segment_label, count(*) AS customers, {r(msum('monetary'), 0)} AS revenue FROM seg GROUP BY 1) h ON h.segment_label = d.segment"""
    case = "CASE segment_label " + " ".join(f"WHEN {text(k)} THEN {v}" for k, v in UPLIFT.items()) + f" ELSE {DEFAULT_UPLIFT} END"
    per = f"""SELECT segment_label AS segment, count(*) AS customers, {r(msum('monetary'), 2)} AS total_revenue, {r(mavg('monetary'), 2)} AS avg_revenue,
 {r(mavg('clv_estimate'), 2)} AS avg_clv, CAST({case} AS DOUBLE) AS uplift_pct, {r(f"{msum('monetary')} * CAST({case} AS DOUBLE)", 0)} AS revenue_opportunity
 FROM seg GROUP BY segment_label"""
    q["revenue_opportunity"] = f"""SELECT * FROM ({per}) UNION ALL SELECT {text(TOTAL)}, CAST(sum(customers) AS BIGINT), NULL, NULL, NULL, NULL, sum(revenue_opportunity) FROM ({per})"""
    q["segment_treemap"] = f"""SELECT segment_label, {r(msum('monetary'), 2)} AS revenue, {r(f"{msum('monetary * rfm_score')} / {msum('monetary')}", 4)} AS weighted_score
 FROM seg GROUP BY 1"""
    band = "CASE WHEN churn_probability <= 0.10 THEN 'Low' WHEN churn_probability <= 0.30 THEN 'Medium' WHEN churn_probability <= 0.65 THEN 'High' ELSE 'Critical' END"
    q["churn_risk_band"] = f"SELECT segment_label, {band} AS churn_risk, count(*) AS customers FROM seg GROUP BY 1, 2"
    q["churn_risk_customers"] = f"SELECT customer_id, segment_label, recency_days, monetary, churn_probability, {band} AS churn_risk FROM seg"
    q["revenue_by_risk_band"] = f"""SELECT CASE WHEN churn_probability <= 0.25 THEN 0 WHEN churn_probability <= 0.60 THEN 1 WHEN churn_probability <= 0.85 THEN 2 ELSE 3 END AS band_no,
 CASE WHEN churn_probability <= 0.25 THEN 'Low (<25%)' WHEN churn_probability <= 0.60 THEN 'Medium (25–60%)' WHEN churn_probability <= 0.85 THEN 'High (60–85%)'
 ELSE 'Critical (85%+)' END AS risk_band, {r(msum('monetary'), 2)} AS revenue FROM seg GROUP BY 1, 2"""
    q["revenue_at_risk"] = f"SELECT {r(msum(risky), 0)} AS revenue_at_risk, {pct(msum(risky), msum('monetary'))} AS pct_of_revenue FROM seg"
    q["avg_churn"] = f"SELECT segment_label, {r(mavg('churn_probability') + ' * 100.0', 1)} AS avg_churn_pct FROM seg GROUP BY 1"

    profile_cols = """customer_id, segment_label, recency_days, frequency, monetary, r_score, f_score, m_score, rfm_score, clv_estimate,
 churn_probability, country"""
    q["filter_customers"] = f"SELECT {profile_cols} FROM aud"
    q["filter_bounds"] = """SELECT array_to_string(list_sort(list(DISTINCT segment_label)), '|') AS segments,
 array_to_string(list_sort(list(DISTINCT country)), '|') AS countries, min(recency_days) AS min_recency, max(recency_days) AS max_recency,
 CAST(floor(min(monetary)) AS BIGINT) AS min_monetary, CAST(floor(max(monetary)) AS BIGINT) AS max_monetary FROM profile"""
    four = ", ".join(f"{r(c, 4)} AS {c}" for c in ("rev", "avg_mon", "avg_rec", "avg_frq", "avg_clv", "avg_churn"))
    q["segment_metrics"] = f"SELECT segment, n, {four} FROM metrics"
    q["segment_metrics_filtered"] = f"SELECT segment, n, {four} FROM metrics_aud"
    champ = "CASE WHEN segment_label = 'Champions' THEN monetary ELSE 0.0 END"
    q["pareto_top20"] = f"""SELECT k AS top20_customers, {pct(msum('CASE WHEN rn <= k THEN monetary END'), msum('monetary'))} AS top20_revenue_pct,
 {pct(msum(champ), msum('monetary'))} AS champion_revenue_pct, {pct("count(*) FILTER (segment_label = 'Champions')", 'count(*)')} AS champion_customer_pct
 FROM (SELECT *, row_number() OVER (ORDER BY monetary DESC) AS rn, greatest(1, count(*) OVER () // 5) AS k FROM profile) GROUP BY k"""
    q["winback_projection"] = "SELECT atrisk_n AS emails, wb_n AS recovered, wb_revenue AS revenue, wb_cost AS cost, wb_roi AS roi_pct FROM proj"
    q["potential_projection"] = "SELECT pot_n AS customers, pot_cn AS converted, pot_revenue AS revenue, pot_cost AS cost, pot_roi AS roi_pct FROM proj"
    q["loyal_gap"] = f"SELECT {r('champ_avg_frq - loyal_avg_frq', 1)} AS order_gap, {even('loyal_n * loyal_avg_mon * 0.05')} AS uplift_5pct FROM proj"
    q["lost_projection"] = "SELECT lost_n AS customers, lost_rn AS recovered, lost_revenue AS revenue FROM proj"
    simple = lambda s, g: even(f"{s}_n * {s}_avg_mon * {g} / greatest(1.0, {s}_n * 0.80)")
    actions = (
        ("Champions", 1, "VIP loyalty programme", "champ", even("champ_rev * 0.10"), simple("champ", "0.10")),
        ("Loyal Customers", 2, "Referral + loyalty discount", "loyal", even("loyal_n * loyal_avg_mon * 0.08"), simple("loyal", "0.08")),
        ("Potential Loyal", 3, "2nd purchase incentive", "pot", "pot_revenue", "pot_roi"),
        ("At Risk", 4, "Win-back 20% discount", "atrisk", "wb_revenue", "wb_roi"),
        ("Lost / Inactive", 5, "Last-chance 30% email", "lost", "lost_revenue",
         even("(lost_revenue - lost_n * 0.15) / greatest(1.0, lost_n * 0.15)")),
    )
    q["action_priority"] = "SELECT *, CAST(row_number() OVER (ORDER BY roi DESC, effort) AS INTEGER) AS priority FROM (" + " UNION ALL ".join(
        f"SELECT {text(n)} AS segment, {e} AS effort, {text(a)} AS action, {s}_n AS n, {o} AS opportunity, {r(f'{s}_avg_clv', 4)} AS avg_clv, {roi} AS roi FROM proj"
        for n, e, a, s, o, roi in actions) + ") WHERE n > 0"
    q["geo_top10"] = f"""SELECT country, count(*) AS customers, {r(msum('monetary'), 2)} AS revenue, {r('avg(rfm_score)', 4)} AS avg_rfm FROM profile
 GROUP BY 1 ORDER BY revenue DESC, country LIMIT 10"""
    q["country_breakdown"] = f"""SELECT country, customers, {r('spend', 0)} AS avg_spend, {r('score', 1)} AS avg_rfm, {r('rev', 2)} AS revenue,
 {pct('rev', 'sum(rev) OVER ()')} AS revenue_pct FROM (SELECT country, count(*) AS customers, {mavg('monetary')} AS spend, avg(rfm_score) AS score,
 {msum('monetary')} AS rev FROM profile GROUP BY 1)"""
    q["explore_sorted"] = f"SELECT {profile_cols} FROM profile ORDER BY monetary DESC, customer_id"
    q["segment_table"] = f"""SELECT segment, n, {r('spend', 0)} AS avg_spend, {r('rec', 0)} AS avg_recency, {r('ord', 1)} AS avg_orders, {r('rev', 2)} AS revenue,
 {pct('rev', 'sum(rev) OVER ()')} AS revenue_pct FROM (SELECT segment_label AS segment, count(*) AS n, {mavg('monetary')} AS spend, avg(recency_days) AS rec,
 avg(frequency) AS ord, {msum('monetary')} AS rev FROM profile GROUP BY 1)"""

    q["cohort_assign"] = """SELECT customer_id, invoice, stock_code, order_month, cohort_month, CAST((year(order_month) - year(cohort_month)) * 12
 + month(order_month) - month(cohort_month) AS INTEGER) AS cohort_index FROM (SELECT *, min(order_month) OVER (PARTITION BY customer_id) AS cohort_month
 FROM (SELECT customer_id, invoice, stock_code, CAST(date_trunc('month', invoice_date) AS DATE) AS order_month FROM tx))"""
    q["cohort_counts"] = "SELECT cohort_month, cohort_index, customers FROM cells"
    q["cohort_matrix"] = _cohort_pivot("customers", "cells")
    q["cohort_sizes"] = "SELECT strftime(cohort_month, '%Y-%m') AS cohort, customers AS size FROM cells WHERE cohort_index = 0"
    q["cohort_extent"] = "SELECT count(DISTINCT cohort_month) AS cohorts, max(cohort_index) AS max_index FROM cells"
    q["retention_table"] = "SELECT strftime(cohort_month, '%Y-%m') AS cohort, cohort_index, customers, retention FROM retention"
    q["retention_matrix"] = _cohort_pivot("retention", "retention")
    q["revenue_cohort"] = _cohort_pivot(r("CAST(revenue_units AS DOUBLE) / 10000.0 / lines", 2), "cells")
    q["revenue_cohort_per_customer"] = _cohort_pivot(r("CAST(revenue_units AS DOUBLE) / 10000.0 / customers", 2), "cells")
    q["retention_curve"] = "SELECT * FROM curve"
    mean = lambda i: r(f"CAST(sum(CAST(floor(retention * 10000 + 0.5) AS BIGINT)) FILTER (cohort_index = {i}) AS DOUBLE) / nullif(count(*) FILTER (cohort_index = {i}), 0) / 100.0", 2)
    third = lambda o: f"(SELECT retention FROM retention WHERE cohort_index = 3 ORDER BY retention {o}, cohort_month LIMIT 1)"
    which = lambda o: f"(SELECT strftime(cohort_month, '%Y-%m') FROM retention WHERE cohort_index = 3 ORDER BY retention {o}, cohort_month LIMIT 1)"
    q["retention_kpis"] = f"""SELECT {mean(1)} AS month1_retention, {mean(3)} AS month3_retention, {which('DESC')} AS best_cohort,
 {r(third('DESC') + ' * 100.0', 2)} AS best_retention, {which('ASC')} AS worst_cohort, {r(third('ASC') + ' * 100.0', 2)} AS worst_retention FROM retention"""
    q["biggest_drop"] = f"""SELECT cohort_index, avg_retention, step FROM (SELECT cohort_index, avg_retention,
 {r('abs(avg_retention - prev)', 4)} AS step FROM (SELECT *, lag(avg_retention) OVER (ORDER BY cohort_index) AS prev FROM curve WHERE cohort_index <= 12))
 WHERE step IS NOT NULL ORDER BY step DESC, cohort_index LIMIT 1"""

    q["ab_assign"] = """SELECT customer_id, rfm_score, CASE WHEN (row_number() OVER (PARTITION BY rfm_score ORDER BY md5(CAST(customer_id AS VARCHAR) || ':42'),
 customer_id) - 1) % 2 = 0 THEN 'Control' ELSE 'Treatment' END AS grp FROM seg"""
    q["ab_describe"] = "SELECT grp, n, n_converted, " + ", ".join(
        f"{r(c, 4)} AS {c}" for c in ("conv_rate", "rev_per_user", "rev_per_converter", "aov", "total_revenue")) + " FROM grp"
    q["ab_lift"] = f"SELECT {r('(p2 - p1) / nullif(p1, 0)', 6)} AS lift_conversion, {r('(m2 - m1) / nullif(m1, 0)', 6)} AS lift_revenue FROM two"
    q["ab_ztest"] = f"""SELECT {r('p1', 6)} AS p_control, {r('p2', 6)} AS p_treatment, {r('diff', 6)} AS diff, {r('z', 6)} AS z, {r(sf('z'), 6)} AS p_value,
 {r('diff - 1.96 * se', 6)} AS ci_low, {r('diff + 1.96 * se', 6)} AS ci_high, {sf('z')} < 0.05 AS significant FROM ztest"""
    q["ab_welch"] = f"SELECT {r('t_stat', 6)} AS t_stat, {r('df', 4)} AS df, {r('t_p', 6)} AS p_value, t_p < 0.05 AS significant FROM wp"
    q["ab_cohens_d"] = f"""SELECT {r('d', 6)} AS cohens_d, CASE WHEN abs(d) < 0.3 THEN 'small' WHEN abs(d) < 0.5 THEN 'medium' ELSE 'large' END AS effect,
 {r('m2 - m1', 4)} AS diff_mean, {r('m2 - m1 - 1.96 * se', 4)} AS ci_low, {r('m2 - m1 + 1.96 * se', 4)} AS ci_high FROM
 (SELECT *, (m2 - m1) / sqrt((vp1 + vp2) / 2) AS d, sqrt(vp1 / n1 + vp2 / n2) AS se FROM two)"""
    q["ab_mannwhitney"] = f"SELECT {r('uu', 1)} AS u_stat, {r('uz', 6)} AS z, {r(sf('uz'), 6)} AS p_value, {sf('uz')} < 0.05 AS significant FROM mwu"
    q["ab_chi2"] = f"SELECT {r('chi2', 6)} AS chi2, 1 AS dof, {r('2.0 * ' + sf('sqrt(chi2)'), 6)} AS p_value, 2.0 * {sf('sqrt(chi2)')} < 0.05 AS significant FROM chi"
    tests = (("Z-test (conversion)", "z_p"), ("Welch t (revenue)", "t_p"), ("Mann-Whitney U (revenue)", "u_p"), ("Chi-square (conversion)", "chi2_p"))
    q["ab_bonferroni"] = " UNION ALL ".join(
        f"SELECT {text(n)} AS test, {r(p, 6)} AS p_value, {p} < 0.05 AS significant, CAST(0.0125 AS DOUBLE) AS corrected_alpha, {p} < 0.0125 AS significant_corrected FROM pvals"
        for n, p in tests)
    zz = normal_quantile(1 - ab.ALPHA) + normal_quantile(0.80)
    q["ab_sample_size"] = f"""SELECT *, n_per_group * 2 AS n_total FROM (SELECT rfm_score, p_control, CAST(ceil(CAST({zz * zz!r} AS DOUBLE) * (p_control * (1 - p_control)
 + (p_control + 0.05) * (1 - (p_control + 0.05))) / CAST({0.05 * 0.05!r} AS DOUBLE)) AS BIGINT) AS n_per_group FROM (SELECT rfm_score,
 CAST(sum(converted) AS DOUBLE) / count(*) AS p_control FROM exper WHERE grp = 'Control' GROUP BY 1))"""
    q["ab_impact"] = f"""SELECT c AS control_conversions, t AS treatment_conversions, t - c AS incremental_conversions, {r('cr', 2)} AS control_revenue,
 {r('gross', 2)} AS gross_revenue, {r('gross * 0.2', 2)} AS discount_cost, CAST(400.0 AS DOUBLE) AS email_cost, {r('gross - cost', 2)} AS net_revenue,
 {r('gross - cost - cr', 2)} AS incremental_revenue, {r('(gross - cost - cr) / cost * 100.0', 2)} AS roi_pct,
 {r('cost / greatest(t - c, 1)', 2)} AS cost_per_conversion FROM (SELECT *, gross * 0.2 + 400.0 AS cost FROM (SELECT *, c * rc AS cr, t * rt AS gross FROM
 (SELECT CAST(floor(800 * p1) AS BIGINT) AS c, CAST(floor(800 * p2) AS BIGINT) AS t, rc, rt FROM two)))"""
    q["ab_decision"] = """SELECT z_p < 0.05 AS conversion_significant, t_p < 0.05 AS welch_significant, u_p < 0.05 AS mannwhitney_significant,
 z_p < 0.05 AND (t_p < 0.05 OR u_p < 0.05) AS launch FROM pvals"""
    rows = (("Conversion Rate", "p1", "p2", "z_p", "100.0"), ("Revenue / Customer", "m1", "m2", "t_p", "1.0"),
            ("Rev / Converter", "rc", "rt", None, "1.0"), ("Avg Order Value", "a1", "a2", None, "1.0"))
    q["ab_summary"] = " UNION ALL ".join(
        f"""SELECT {text(n)} AS metric, {r(f'{a} * {s}', 4)} AS control, {r(f'{b} * {s}', 4)} AS treatment, {r(f'({b} - {a}) * {s}', 4)} AS absolute_lift,
 {r(f'({b} - {a}) / nullif({a}, 0) * 100.0', 4) if p else 'CAST(NULL AS DOUBLE)'} AS relative_lift_pct, {r(p, 6) if p else 'CAST(NULL AS DOUBLE)'} AS p_value,
 {f'{p} < 0.05' if p else 'CAST(NULL AS BOOLEAN)'} AS significant FROM two, pvals""" for n, a, b, p, s in rows)
    q["ab_revenue_hist"] = f"""SELECT grp, bin, count(*) AS customers, {r('count(*) / (sum(count(*)) OVER (PARTITION BY grp) * (any_value(top) / 59.0))', 8)} AS density FROM
 (SELECT grp, top, {bins('revenue', '0.0', 'top', 59)} AS bin FROM exper, (SELECT max(revenue) * CAST(1.1 AS DOUBLE) AS top FROM exper WHERE grp = 'Control')
 WHERE revenue > 0 AND revenue <= top) GROUP BY grp, bin"""

    q["clv_summary"] = "SELECT * FROM clvsum"
    q["clv_repeaters"] = f"""SELECT count(*) AS customers, count(*) FILTER (frequency > 0) AS repeaters, count(*) FILTER (frequency = 0) AS one_time,
 {pct('count(*) FILTER (frequency > 0)', 'count(*)')} AS repeat_pct FROM clvsum"""
    q["freq_value_corr"] = f"SELECT {r('corr(frequency, monetary_value)', 6)} AS correlation, abs(corr(frequency, monetary_value)) < 0.3 AS independent FROM clvsum WHERE frequency > 0"
    q["clv_fallback"] = """SELECT customer_id, frequency, recency, t, monetary_value, prob_alive, pp AS predicted_purchases_12m, ao AS predicted_avg_order,
 clv_predicted FROM fb"""
    q["clv_join_segments"] = "SELECT customer_id, clv_predicted, prob_alive, segment FROM fbseg"
    q["clv_tiers"] = "SELECT customer_id, clv_predicted, clv_tier FROM tier"
    q["clv_tier_table"] = f"SELECT clv_tier, count(*) AS customers, {r(mavg('clv_predicted'), 2)} AS avg_clv FROM tier GROUP BY 1"
    q["clv_segment_table"] = f"""SELECT segment, count(*) AS customers, {r(mavg('clv_predicted'), 2)} AS avg_clv, {r(msum('clv_predicted'), 2)} AS total_clv,
 {r(mavg('prob_alive'), 2)} AS avg_prob_alive, {r(mavg('pp'), 2)} AS avg_pred_orders FROM fbseg GROUP BY 1"""
    q["clv_headline"] = f"""SELECT count(*) AS customers, count(*) FILTER (prob_alive >= 0.5) AS likely_active, {r(msum('clv_predicted'), 2)} AS total_clv,
 {r(f"coalesce({msum('CASE WHEN rn <= k THEN clv_predicted END')}, 0.0)", 2)} AS top10_clv,
 {pct(f"coalesce({msum('CASE WHEN rn <= k THEN clv_predicted END')}, 0.0)", msum('clv_predicted'))} AS top10_pct
 FROM (SELECT *, row_number() OVER (ORDER BY clv_predicted DESC) AS rn, count(*) OVER () // 10 AS k FROM fb)"""
    fe, re_ = (0, 1, 3, 5, 10, 30), (0, 10, 20, 30, 40, 52)
    fbin = "CASE " + " ".join(f"WHEN frequency > {a} AND frequency <= {b} THEN '({a}, {b}]'" for a, b in zip(fe, fe[1:])) + " END"
    q["alive_grid"] = f"SELECT {fbin} AS f_bin, " + ", ".join(
        f"{r(mavg(f'CASE WHEN recency > {a} AND recency <= {b} THEN prob_alive END'), 4)} AS r_{b}" for a, b in zip(re_, re_[1:])
    ) + f" FROM fb WHERE {fbin} IS NOT NULL AND recency > 0 AND recency <= 52 GROUP BY 1"
    q["clv_hist"] = f"""SELECT {bins('x', 'lo', 'hi', 50)} AS bin, count(*) AS customers, {r('any_value(mean)', 2)} AS mean, {r(r('any_value(median)', 4), 2)} AS median FROM
 (SELECT x FROM (SELECT least(greatest(clv_predicted, 0.0), cap) AS x FROM fb, (SELECT quantile_cont(clv_predicted, 0.98) AS cap FROM fb))),
 (SELECT min(x) AS lo, max(x) AS hi, {mavg('x')} AS mean, median(x) AS median FROM (SELECT least(greatest(clv_predicted, 0.0), cap) AS x FROM fb,
 (SELECT quantile_cont(clv_predicted, 0.98) AS cap FROM fb))) GROUP BY 1"""
    q["alive_hist"] = f"""SELECT {bins('prob_alive', 'lo', 'hi', 40)} AS bin, any_value(pct_alive) AS pct_alive, count(*) AS customers FROM fb,
 (SELECT min(prob_alive) AS lo, max(prob_alive) AS hi, {pct('count(*) FILTER (prob_alive >= 0.5)', 'count(*)')} AS pct_alive FROM fb) GROUP BY 1"""

    q["bgnbd_fit"], q["gamma_gamma_fit"] = "SELECT * FROM bgpar", "SELECT * FROM ggpar"
    q["prob_alive"] = "SELECT customer_id, prob_alive FROM bgalive"
    q["expected_purchases"] = f"SELECT customer_id, {r('bought', 2)} AS predicted_purchases_12m FROM bgexp WHERE h = 0"
    q["expected_order_value"] = "SELECT customer_id, predicted_avg_order FROM pv"
    q["clv_predicted"] = "SELECT * FROM pv"
    q["clv_predicted_tiers"] = q["clv_tier_table"].replace("FROM tier", "FROM pvtier")
    q["clv_predicted_segments"] = q["clv_segment_table"].replace("fbseg", "pvseg").replace("pp)", "predicted_purchases_12m)").replace("(pp", "(predicted_purchases_12m").replace("pp ", "predicted_purchases_12m ")
    q["clv_predicted_headline"] = q["clv_headline"].replace("FROM fb", "FROM pv")

    seven = ("recency_days", "frequency", "monetary", "rfm_score", "r_score", "f_score", "m_score")
    q["segment_mean_median"] = f"SELECT segment_label, metric, {r(mavg('x'), 1)} AS mean, {r(r('median(x)', 4), 1)} AS median FROM {_unpivot('seg', seven, 'segment_label')} GROUP BY 1, 2"
    q["cluster_summary"] = f"""SELECT segment_label, customers, avg_recency, avg_frequency, avg_monetary, {r('rev', 1)} AS total_revenue, avg_rfm_score,
 {pct('customers', 'sum(customers) OVER ()')} AS pct_customers, {pct('rev', 'sum(rev) OVER ()')} AS pct_revenue FROM (SELECT segment_label, count(*) AS customers,
 {r('avg(recency_days)', 1)} AS avg_recency, {r('avg(frequency)', 1)} AS avg_frequency, {r(mavg('monetary'), 1)} AS avg_monetary, {msum('monetary')} AS rev,
 {r('avg(rfm_score)', 1)} AS avg_rfm_score FROM seg GROUP BY 1)"""
    q["clv_by_segment"] = f"SELECT segment_label, {r(mavg('clv_estimate'), 2)} AS avg_clv FROM seg GROUP BY 1"

    q["k_sweep"] = "SELECT CAST(k AS INTEGER) AS k, inertia, silhouette, davies_bouldin, calinski_harabasz FROM kqual"
    for key in ("silhouette", "davies_bouldin", "calinski_harabasz"):
        q[key] = f"SELECT CAST(k AS INTEGER) AS k, {key} FROM kqual"
    q["kmeans_fit"] = "SELECT customer_id, cluster FROM clu"
    q["cluster_profile"] = "SELECT * FROM cprof"
    q["cluster_names"] = "SELECT * FROM cname"
    q["cluster_label"] = "SELECT customer_id, cluster, cluster_segment FROM cnamed"
    q["cluster_counts"] = "SELECT cluster, cluster_segment, count(*) AS customers FROM cnamed GROUP BY 1, 2"
    q["kmeans_segment_summary"] = q["cluster_summary"].replace("segment_label", "cluster_segment").replace("FROM seg GROUP", "FROM cnamed GROUP")
    q["pca_2d"] = "SELECT customer_id, " + ", ".join(
        f"{r(' + '.join(f'{f} * pc{j}_{f}' for f in FEATURES), 6)} AS pc{j}" for j in (1, 2)) + " FROM scaled, pcs"
    q["pca_variance"] = "SELECT round(e1 / t, 6) AS pc1_variance, round(e2 / t, 6) AS pc2_variance, round((e1 + e2) / t, 6) AS total_variance, " + ", ".join(
        f"round(pc{j}_{f}, 6) AS pc{j}_{f}" for j in (1, 2) for f in FEATURES) + " FROM (SELECT *, e1 + e2 + e3 AS t FROM pcs)"

    txf = ", ".join(f"{r(f'({c} - m{i}) / s{i}', 6)} AS {n}" for i, (c, n) in enumerate(
        (("quantity", "quantity_scaled"), ("total_amount", "total_scaled"), ("implied_unit_price", "price_scaled"))))
    fit = ", ".join(f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s{i}"
                    for i, c in enumerate(("quantity", "total_amount", "implied_unit_price")))
    q["tx_features"] = f"SELECT invoice, stock_code, {r('implied_unit_price', 4)} AS implied_unit_price, {txf} FROM txf0, (SELECT {fit} FROM txf0)"
    q["tx_anomaly_thresholds"] = "SELECT quantile_cont(total_amount, 0.998) AS extreme_total, quantile_cont(implied_unit_price, 0.998) AS unusual_price FROM txf0"

    q["iforest_fit"] = f"SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, CAST(feature AS INTEGER) AS feature, {r('threshold', 3)} AS threshold, path AS path_units, CAST((SELECT n FROM txsize) AS INTEGER) AS sample_size FROM txnodes"
    q["iforest_score"] = f"SELECT invoice, stock_code, total_amount, {r('anomaly_score', 9)} AS anomaly_score FROM txscored"
    q["tx_anomaly_flag"] = "SELECT invoice, stock_code, total_amount, is_anomaly FROM txflag"
    q["tx_anomaly_type"] = """SELECT CASE WHEN quantity > 200 THEN 'Bulk Order' WHEN total_amount > t THEN 'Extreme Value' WHEN implied_unit_price > p THEN 'Unusual Price'
 ELSE 'Statistical Outlier' END AS anomaly_type, count(*) AS flagged FROM txflag, (SELECT quantile_cont(total_amount, 0.998) AS t, quantile_cont(implied_unit_price, 0.998) AS p FROM txf0) e
 WHERE is_anomaly GROUP BY 1"""
    q["anomaly_revenue"] = f"""SELECT count(*) FILTER (is_anomaly) AS flagged, {pct('count(*) FILTER (is_anomaly)', 'count(*)')} AS flagged_pct,
 {r(msum('CASE WHEN is_anomaly THEN total_amount ELSE 0.0 END'), 2)} AS flagged_revenue, {pct(msum('CASE WHEN is_anomaly THEN total_amount ELSE 0.0 END'), msum('total_amount'))} AS revenue_pct FROM txflag"""
    q["top_anomalies"] = f"""SELECT invoice, stock_code, quantity, total_amount, implied_unit_price, {r('anomaly_score', 9)} AS anomaly_score FROM txflag WHERE is_anomaly
 ORDER BY total_amount DESC, invoice, stock_code LIMIT 10"""
    q["anomaly_score_hist"] = f"""SELECT is_anomaly, bin, count(*) AS row_count, {r('count(*) / nullif(any_value(n) * ((any_value(hi) - any_value(lo)) / any_value(parts)), 0)', 6)} AS density FROM
 (SELECT *, CASE WHEN is_anomaly THEN {bins('anomaly_score', 'lo', 'hi', 20)} ELSE {bins('anomaly_score', 'lo', 'hi', 50)} END AS bin, CASE WHEN is_anomaly THEN 20 ELSE 50 END AS parts FROM
 (SELECT *, min(anomaly_score) OVER (PARTITION BY is_anomaly) AS lo, max(anomaly_score) OVER (PARTITION BY is_anomaly) AS hi, count(*) OVER (PARTITION BY is_anomaly) AS n FROM txflag)) GROUP BY 1, 2"""
    q["cust_anomaly_flag"] = f"SELECT customer_id, {r('anomaly_score', 9)} AS anomaly_score, is_anomaly FROM cuflag"
    q["cust_anomaly_type"] = """SELECT CASE WHEN monetary > m THEN 'Possible Wholesale' WHEN frequency > f THEN 'Power Buyer' WHEN recency_days < 7 AND frequency > 20 THEN 'Suspicious Velocity'
 ELSE 'Statistical Outlier' END AS anomaly_type, count(*) AS flagged FROM cuflag, (SELECT quantile_cont(monetary, 0.99) AS m, quantile_cont(frequency, 0.99) AS f FROM seg) e
 WHERE is_anomaly GROUP BY 1"""
    q["anomaly_profile"] = f"""SELECT is_anomaly, count(*) AS customers, {r('avg(recency_days)', 1)} AS avg_recency, {r('avg(frequency)', 1)} AS avg_frequency,
 {r(mavg('monetary'), 1)} AS avg_monetary FROM cuflag GROUP BY 1"""
    q["anomaly_rate_by_segment"] = f"""SELECT segment_label, count(*) AS total, count(*) FILTER (is_anomaly) AS flagged, {pct('count(*) FILTER (is_anomaly)', 'count(*)')} AS pct
 FROM cuflag GROUP BY 1"""
    q["exclude_anomalies"] = "SELECT customer_id, recency_days, frequency, monetary FROM cuflag WHERE NOT is_anomaly"

    q["read_transactions_csv"] = q["read_transactions"]
    q["knn_distance"] = f"SELECT customer_id, {r('distance', 6)} AS distance FROM knn"
    q["dbscan"] = "SELECT customer_id, dbscan_cluster, is_core FROM dbs"
    q["dbscan_summary"] = f"""SELECT count(*) AS customers, count(DISTINCT CASE WHEN dbscan_cluster <> {NOISE} THEN dbscan_cluster END) AS clusters,
 count(*) FILTER (dbscan_cluster = {NOISE}) AS noise_points FROM dbs"""
    q["stream_clean"] = "SELECT DISTINCT * FROM lines"
    q["stream_revenue"] = f"SELECT strftime(invoice_date, '%Y-%m-%d') AS day, count(*) AS lines, {msum('total_amount')} AS revenue FROM lines GROUP BY 1"
    return q


def sql() -> dict[str, str]:
    return {name: _with(body) for name, body in _bodies().items()}
