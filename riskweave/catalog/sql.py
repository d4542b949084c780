"""Building blocks of the checking SQL: named subqueries in dependency order."""

from __future__ import annotations

import re

from riskweave import rules


def txt(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN ('', 'nan', 'none', 'null') THEN NULL ELSE trim({c}) END"


def key(c: str) -> str:
    return f"lower({txt(c)})"


_PLACEHOLDERS = ", ".join(f"'{d}'" for d in rules.PLACEHOLDER_DEVICES)


def device(c: str) -> str:
    return f"CASE WHEN {key(c)} IN ({_PLACEHOLDERS}) THEN NULL ELSE {key(c)} END"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


CUT = f"TIMESTAMP '{rules.BLACKLIST_CUT}'"

# name -> SQL. A block may use any block above it.
BLOCKS: dict[str, str] = {
    "fx_ev": (
        "SELECT event_id, ts, user_id, event_type, value, "
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events"
    ),
    "fx_login": (
        "SELECT 'p' || CAST(user_id % 97 AS VARCHAR) AS phone_num, 'U' || CAST(user_id AS VARCHAR) AS cif_user_id, "
        "ts AS login_time, CASE WHEN k = 0 THEN 'unknown' WHEN k = 1 THEN ' D1 ' WHEN k = 2 THEN 'NaN' "
        "ELSE 'd' || CAST(k AS VARCHAR) END AS device_no, 'ip' || CAST(event_id % 211 AS VARCHAR) AS remote_ip, "
        "CASE WHEN event_type = 'click' THEN 'APP' ELSE 'WEB' END AS app_channel, "
        "CASE WHEN k % 10 = 0 THEN NULL ELSE 't' || CAST(k % 25 AS VARCHAR) END AS td_device_id, event_id AS seq "
        "FROM fx_ev WHERE event_type IN ('click', 'view')"
    ),
    "fx_lbs_gps": (
        "SELECT 'U' || CAST(user_id AS VARCHAR) AS cid, 'g' || CAST(k % 40 AS VARCHAR) AS geo_code, "
        "ts AS create_date, event_id AS seq FROM fx_ev WHERE event_type = 'signup'"
    ),
    "fx_linkman": (
        "SELECT 'U' || CAST(user_id AS VARCHAR) AS cid, 'p' || CAST(k AS VARCHAR) AS mobile_phone, "
        "ts AS create_date, event_id AS seq FROM fx_ev WHERE event_type = 'purchase' AND event_id % 2 = 0"
    ),
    "fx_second_linkman": (
        "SELECT 'U' || CAST(user_id AS VARCHAR) AS cid, 'p' || CAST(k + 50 AS VARCHAR) AS second_mobile_phone, "
        "ts AS create_date, event_id AS seq FROM fx_ev WHERE event_type = 'purchase' AND event_id % 2 = 1"
    ),
    "fx_linkman_derived": (
        "SELECT cid, CASE WHEN seq % 4 = 0 THEN mobile_phone ELSE mobile_phone || 'x' END AS mobile_phone, create_date, seq "
        "FROM fx_linkman"
    ),
    "fx_second_linkman_derived": (
        "SELECT cid, CASE WHEN seq % 3 = 0 THEN second_mobile_phone ELSE second_mobile_phone || 'y' END AS second_mobile_phone, "
        "create_date, seq FROM fx_second_linkman"
    ),
    "fx_customer_log": (
        "SELECT 'U' || CAST(user_id AS VARCHAR) AS baseid, CASE WHEN k % 11 = 0 THEN NULL "
        "ELSE 'i' || CAST(user_id AS VARCHAR) END AS identity_no, "
        "'p' || CAST((user_id + k % 3) % 97 AS VARCHAR) AS mobile_phone, ts AS log_create_date, event_id AS seq "
        "FROM fx_ev WHERE event_type = 'error' AND k >= 5"
    ),
    "fx_logout": (
        "SELECT 'U' || CAST(user_id AS VARCHAR) AS cid, 'i' || CAST(user_id AS VARCHAR) AS identity_no, "
        "'p' || CAST(user_id % 97 AS VARCHAR) AS mobile_phone, ts AS create_date, event_id AS seq "
        "FROM fx_ev WHERE event_type = 'error' AND k < 5"
    ),
    "fx_order": (
        "SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS id, 'U' || CAST(o_custkey AS VARCHAR) AS user_id, "
        "'p' || CAST(o_custkey % 97 AS VARCHAR) AS apply_loan_tel, 'i' || CAST(o_custkey AS VARCHAR) AS apply_ident_no, "
        "'c' || CAST(o_custkey % 1201 AS VARCHAR) AS apply_card_no, "
        "'p' || CAST(o_custkey % 89 AS VARCHAR) AS apply_bank_mobile, "
        "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'c' || CAST(o_orderkey % 997 AS VARCHAR) END AS repay_card_no, "
        "'p' || CAST(o_custkey % 83 AS VARCHAR) AS repay_bank_mobile, "
        "CASE o_orderstatus WHEN 'P' THEN 'OVERDUE' WHEN 'F' THEN 'REPAYED' ELSE 'REPAYING' END AS order_status, "
        "o_orderdate AS create_date, o_orderkey AS seq FROM orders"
    ),
    "fx_repay_plan": (
        "SELECT 'R' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, "
        "'O' || CAST(l_orderkey AS VARCHAR) AS order_id, l_shipdate AS current_repay_date, "
        "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_shipdate END AS repayed_date, l_returnflag AS overdue_mark, "
        "l_linestatus AS current_repay_status, l_shipdate AS modify_date FROM lineitem"
    ),
    "fx_company_log": (
        "SELECT 'U' || CAST(c_custkey AS VARCHAR) AS cid, n_name AS company_name, "
        "TIMESTAMP '2023-12-01 00:00:00' AS modify_date, c_custkey AS seq "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey"
    ),
    "fx_cases": (
        "SELECT CASE WHEN k >= 90 THEN 'complaint' ELSE 'consumer' END AS source, CAST(event_id AS VARCHAR) AS c_id, "
        "'p' || CAST(k AS VARCHAR) AS c_contact_phone_no, 'p' || CAST(user_id % 97 AS VARCHAR) AS c_register_phone_no, "
        "'i' || CAST(user_id AS VARCHAR) AS c_identity_no, ts AS d_update FROM fx_ev "
        "WHERE event_type = 'error' AND k >= 80 AND k < 100"
    ),
    "fx_blacklist_log": (
        "SELECT 'U' || CAST(c_custkey AS VARCHAR) AS c_customer_no, "
        "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS c_reason_list, "
        "'p' || CAST(c_custkey % 97 AS VARCHAR) AS c_mobile_phone, 'i' || CAST(c_custkey AS VARCHAR) AS c_identity_no, "
        "CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2025-12-01 00:00:00' ELSE TIMESTAMP '2023-11-20 00:00:00' END "
        "AS d_begin_date, c_custkey AS seq FROM customer WHERE c_acctbal < 0"
    ),
    # -- cleaned feeds
    "c_customer_log": (
        f"SELECT {key('baseid')} AS uid, {key('identity_no')} AS identity_no, {key('mobile_phone')} AS phone_num, "
        "log_create_date AS ts, seq FROM fx_customer_log"
    ),
    "c_login": (
        f"SELECT {key('cif_user_id')} AS uid, {key('phone_num')} AS phone_num, {device('device_no')} AS device_no, "
        f"{key('td_device_id')} AS td_device_id, {key('remote_ip')} AS remote_ip, login_time AS ts, seq FROM fx_login"
    ),
    "c_lbs_gps": f"SELECT {key('cid')} AS uid, {key('geo_code')} AS geo_code, create_date AS ts, seq FROM fx_lbs_gps",
    "c_contacts": (
        f"SELECT {key('cid')} AS uid, {key('mobile_phone')} AS phone_num, create_date AS ts, seq FROM fx_linkman "
        f"UNION ALL SELECT {key('cid')}, {key('second_mobile_phone')}, create_date, seq FROM fx_second_linkman "
        f"UNION ALL SELECT {key('cid')}, {key('mobile_phone')}, create_date, seq FROM fx_linkman_derived "
        f"UNION ALL SELECT {key('cid')}, {key('second_mobile_phone')}, create_date, seq FROM fx_second_linkman_derived"
    ),
    "c_logout": (
        f"SELECT {key('cid')} AS uid, {key('identity_no')} AS identity_no, {key('mobile_phone')} AS phone_num, "
        "create_date AS ts, seq FROM fx_logout"
    ),
    "c_order": (
        f"SELECT {txt('id')} AS order_id, {key('user_id')} AS uid, {txt('order_status')} AS order_status, "
        f"{key('apply_loan_tel')} AS apply_loan_tel, {key('apply_ident_no')} AS apply_ident_no, "
        f"{key('apply_card_no')} AS apply_card_no, {key('apply_bank_mobile')} AS apply_bank_mobile, "
        f"{key('repay_card_no')} AS repay_card_no, {key('repay_bank_mobile')} AS repay_bank_mobile, "
        "create_date AS ts, seq FROM fx_order"
    ),
    "c_repay_plan": (
        "SELECT order_id, id AS repay_plan_id, current_repay_date AS due_date, repayed_date, overdue_mark, "
        "current_repay_status AS plan_status, modify_date AS ts FROM fx_repay_plan"
    ),
    "c_company_log": (
        f"SELECT {key('cid')} AS uid, {key('company_name')} AS company_name, modify_date AS ts, seq FROM fx_company_log"
    ),
    "c_cases": (
        "SELECT source || ':' || c_id AS case_key, source, lower(c_identity_no) AS identity_no, "
        "lower(c_register_phone_no) AS register_phone, lower(c_contact_phone_no) AS contact_phone, d_update AS ts "
        "FROM fx_cases"
    ),
    "c_blacklist_log": (
        f"SELECT {key('c_customer_no')} AS uid, {key('c_identity_no')} AS identity_no, "
        f"{key('c_mobile_phone')} AS phone_num, c_reason_list AS reason_list, "
        "CASE WHEN c_reason_list IS NULL THEN 'blacklisted' ELSE 'blacklisted:' || c_reason_list END AS status, "
        f"d_begin_date AS ts, seq FROM fx_blacklist_log WHERE d_begin_date < {CUT}"
    ),
    # -- graph
    "changes": (
        "SELECT uid, ts, seq, identity_no, phone_num, "
        "identity_no IS DISTINCT FROM lag(identity_no) OVER w AS identity_changed, "
        "phone_num IS DISTINCT FROM lag(phone_num) OVER w AS phone_changed "
        "FROM c_customer_log WINDOW w AS (PARTITION BY uid ORDER BY ts, seq)"
    ),
    "edge_rows": " UNION ALL ".join(
        [
            "SELECT 'uid' AS src_type, uid AS src_key, 'HAS_IDENTITY' AS rel, 'identity_no' AS dst_type, "
            "identity_no AS dst_key, ts FROM changes WHERE identity_changed AND identity_no IS NOT NULL",
            "SELECT 'uid', uid, 'HAS_PHONE', 'phone_num', phone_num, ts FROM changes "
            "WHERE phone_changed AND phone_num IS NOT NULL",
            "SELECT 'uid', uid, 'LOGIN_WITH_PHONE', 'phone_num', phone_num, ts FROM c_login WHERE phone_num IS NOT NULL",
            "SELECT 'uid', uid, 'LOGIN_WITH_DEVICE', 'device_no', device_no, ts FROM c_login WHERE device_no IS NOT NULL",
            "SELECT 'uid', uid, 'LOGIN_WITH_TD_DEVICE', 'td_device_id', td_device_id, ts FROM c_login "
            "WHERE td_device_id IS NOT NULL",
            "SELECT 'uid', uid, 'LOGIN_WITH_IP', 'remote_ip', remote_ip, ts FROM c_login WHERE remote_ip IS NOT NULL",
            "SELECT 'uid', uid, 'LOCATED_AT', 'geo_code', geo_code, ts FROM c_lbs_gps",
            "SELECT 'uid', uid, 'HAS_CONTACT_PHONE', 'phone_num', phone_num, ts FROM c_contacts",
            "SELECT 'uid', uid, 'PLACED_ORDER', 'order', order_id, ts FROM c_order",
            "SELECT 'order', order_id, 'ORDER_APPLY_PHONE', 'phone_num', apply_loan_tel, ts FROM c_order "
            "WHERE apply_loan_tel IS NOT NULL",
            "SELECT 'order', order_id, 'ORDER_APPLY_IDENTITY', 'identity_no', apply_ident_no, ts FROM c_order "
            "WHERE apply_ident_no IS NOT NULL",
            "SELECT 'order', order_id, 'ORDER_APPLY_CARD', 'card_no', apply_card_no, ts FROM c_order "
            "WHERE apply_card_no IS NOT NULL",
            "SELECT 'order', order_id, 'ORDER_REPAY_CARD', 'card_no', repay_card_no, ts FROM c_order "
            "WHERE repay_card_no IS NOT NULL",
            "SELECT 'card_no', apply_card_no, 'CARD_BIND_PHONE', 'phone_num', apply_bank_mobile, ts FROM c_order "
            "WHERE apply_card_no IS NOT NULL AND apply_bank_mobile IS NOT NULL",
            "SELECT 'card_no', repay_card_no, 'CARD_BIND_PHONE', 'phone_num', repay_bank_mobile, ts FROM c_order "
            "WHERE repay_card_no IS NOT NULL AND repay_bank_mobile IS NOT NULL",
            "SELECT 'uid', uid, 'BELONGS_TO_COMPANY', 'company_name', company_name, ts FROM c_company_log",
            "SELECT 'complaint_case', case_key, 'C_HAS_IDENTITY', 'identity_no', identity_no, ts FROM c_cases",
            "SELECT 'complaint_case', case_key, 'C_REGISTER_PHONE', 'phone_num', register_phone, ts FROM c_cases",
            "SELECT 'complaint_case', case_key, 'C_CONTACT_PHONE', 'phone_num', contact_phone, ts FROM c_cases",
            "SELECT 'order', order_id, 'REPAY_PLAN', 'repay_plan', repay_plan_id, ts FROM c_repay_plan",
        ]
    ),
    "edges": (
        "SELECT src_type, src_key, rel, dst_type, dst_key, min(ts) AS first_seen_ts, max(ts) AS last_seen_ts, "
        "count(*) AS event_count FROM edge_rows GROUP BY ALL"
    ),
    "touch_rows": " UNION ALL ".join(
        [
            "SELECT src_type AS node_type, src_key AS key, ts FROM edge_rows",
            "SELECT dst_type, dst_key, ts FROM edge_rows",
            "SELECT 'uid', uid, ts FROM c_customer_log",
            "SELECT 'uid', uid, ts FROM c_login",
            "SELECT 'uid', uid, ts FROM c_logout",
            "SELECT 'identity_no', identity_no, ts FROM c_logout WHERE identity_no IS NOT NULL",
            "SELECT 'phone_num', phone_num, ts FROM c_logout WHERE phone_num IS NOT NULL",
            "SELECT 'complaint_case', case_key, ts FROM c_cases",
            "SELECT 'uid', uid, ts FROM c_blacklist_log WHERE uid IS NOT NULL",
            "SELECT 'identity_no', identity_no, ts FROM c_blacklist_log WHERE identity_no IS NOT NULL",
            "SELECT 'phone_num', phone_num, ts FROM c_blacklist_log WHERE phone_num IS NOT NULL",
        ]
    ),
    "marks": " UNION ALL ".join(
        f"SELECT '{t}' AS node_type, {c} AS key, status, reason_list, ts, seq FROM c_blacklist_log WHERE {c} IS NOT NULL"
        for t, c in (("uid", "uid"), ("identity_no", "identity_no"), ("phone_num", "phone_num"))
    ),
    "newest_mark": (
        "SELECT node_type, key, status, reason_list FROM marks "
        "QUALIFY row_number() OVER (PARTITION BY node_type, key ORDER BY ts DESC, seq DESC) = 1"
    ),
    "newest_customer": (
        "SELECT uid, identity_no AS latest_identity, phone_num AS latest_phone FROM c_customer_log "
        "QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ts DESC, seq DESC) = 1"
    ),
    "newest_status": (
        "SELECT order_id, order_status FROM c_order WHERE order_status IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, seq DESC) = 1"
    ),
    "plans": (
        "SELECT g.repay_plan_id, g.due_date, g.repayed_date, m.overdue_mark, p.plan_status FROM "
        "(SELECT repay_plan_id, max(due_date) AS due_date, max(repayed_date) AS repayed_date FROM c_repay_plan GROUP BY 1) g "
        "LEFT JOIN (SELECT repay_plan_id, overdue_mark FROM c_repay_plan WHERE overdue_mark IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY repay_plan_id ORDER BY ts DESC, overdue_mark DESC) = 1) m "
        "USING (repay_plan_id) "
        "LEFT JOIN (SELECT repay_plan_id, plan_status FROM c_repay_plan WHERE plan_status IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY repay_plan_id ORDER BY ts DESC, plan_status DESC) = 1) p "
        "USING (repay_plan_id)"
    ),
    "logouts": (
        "SELECT node_type, key, count(*) AS n FROM (SELECT 'uid' AS node_type, uid AS key FROM c_logout "
        "UNION ALL SELECT 'identity_no', identity_no FROM c_logout WHERE identity_no IS NOT NULL "
        "UNION ALL SELECT 'phone_num', phone_num FROM c_logout WHERE phone_num IS NOT NULL) GROUP BY 1, 2"
    ),
    "nodes": (
        "SELECT t.node_type, t.key, t.created_at, t.updated_at, "
        "(SELECT max(l.ts) FROM c_login l WHERE t.node_type = 'uid' AND l.uid = t.key) AS last_login_ts, "
        "(SELECT max(c.ts) FROM c_customer_log c WHERE t.node_type = 'uid' AND c.uid = t.key) AS last_update_ts, "
        "CASE WHEN t.node_type = 'uid' THEN coalesce(o.n, 0) > 0 END AS logout_flag, "
        "CASE WHEN t.node_type IN ('phone_num', 'identity_no') THEN coalesce(o.n, 0) END AS logout_count, "
        "nc.latest_identity, nc.latest_phone, s.order_status, b.status, b.reason_list, p.due_date, p.repayed_date, "
        "CAST(NULL AS VARCHAR) AS early_mark, p.overdue_mark, CAST(NULL AS VARCHAR) AS overdue_days, p.plan_status, "
        "CASE WHEN t.key LIKE 'complaint:%' THEN 'complaint' WHEN t.key LIKE 'consumer:%' THEN 'consumer_protection_case' END AS source, "
        "b.status IS NOT NULL AS is_blacklisted FROM "
        "(SELECT node_type, key, min(ts) AS created_at, max(ts) AS updated_at FROM touch_rows GROUP BY 1, 2) t "
        "LEFT JOIN logouts o ON o.node_type = t.node_type AND o.key = t.key "
        "LEFT JOIN newest_mark b ON b.node_type = t.node_type AND b.key = t.key "
        "LEFT JOIN newest_customer nc ON t.node_type = 'uid' AND nc.uid = t.key "
        "LEFT JOIN newest_status s ON t.node_type = 'order' AND s.order_id = t.key "
        "LEFT JOIN plans p ON t.node_type = 'repay_plan' AND p.repay_plan_id = t.key"
    ),
    "device_users": (
        "SELECT dst_key AS device_no, count(DISTINCT src_key) AS uid_count FROM edges "
        "WHERE src_type = 'uid' AND dst_type = 'device_no' GROUP BY 1"
    ),
    "links": (
        "SELECT dst_type AS node_type, dst_key AS key, src_key AS uid, max(last_seen_ts) AS latest_ts FROM edges "
        f"WHERE src_type = 'uid' AND dst_type IN ({quoted(rules.ASSOCIATED_TYPES)}) GROUP BY 1, 2, 3"
    ),
    "assoc": "SELECT node_type, key, count(*) AS associated_uid_count FROM links GROUP BY 1, 2",
    # -- risk
    "placed": "SELECT dst_key AS order_key, src_key AS uid FROM edges WHERE rel = 'PLACED_ORDER'",
    "bucket_links": " UNION ".join(
        [
            "SELECT CASE rel WHEN 'HAS_CONTACT_PHONE' THEN 'phone_contact' WHEN 'HAS_IDENTITY' THEN 'identity' "
            "WHEN 'LOGIN_WITH_DEVICE' THEN 'device' WHEN 'LOGIN_WITH_TD_DEVICE' THEN 'td_device' "
            "ELSE 'phone_main' END AS bucket, dst_type AS node_type, dst_key AS key, src_key AS uid FROM edges "
            "WHERE rel IN ('LOGIN_WITH_PHONE', 'HAS_PHONE', 'HAS_CONTACT_PHONE', 'HAS_IDENTITY', "
            "'LOGIN_WITH_DEVICE', 'LOGIN_WITH_TD_DEVICE')",
            "SELECT CASE e.rel WHEN 'ORDER_APPLY_PHONE' THEN 'phone_main' WHEN 'ORDER_APPLY_IDENTITY' THEN 'identity' "
            "ELSE 'card' END, e.dst_type, e.dst_key, p.uid FROM edges e JOIN placed p ON e.src_key = p.order_key "
            "WHERE e.rel IN ('ORDER_APPLY_PHONE', 'ORDER_APPLY_IDENTITY', 'ORDER_APPLY_CARD', 'ORDER_REPAY_CARD')",
            "SELECT CASE e.rel WHEN 'LOGIN_WITH_IP' THEN 'ip' ELSE 'geo' END, e.dst_type, e.dst_key, e.src_key "
            "FROM edges e JOIN nodes n ON n.node_type = e.dst_type AND n.key = e.dst_key "
            "WHERE e.rel IN ('LOGIN_WITH_IP', 'LOCATED_AT') AND e.last_seen_ts <= n.updated_at AND e.last_seen_ts >= "
            "n.updated_at - CASE e.rel WHEN 'LOGIN_WITH_IP' THEN INTERVAL 7 DAYS ELSE INTERVAL 30 DAYS END",
        ]
    ),
    "bucket_counts": "SELECT node_type, key, bucket, count(*) AS uid_count FROM bucket_links GROUP BY 1, 2, 3",
    "assoc_risk": (
        "SELECT node_type, key, sum((uid_count - 1) * CASE bucket WHEN 'phone_main' THEN 1.0 WHEN 'phone_contact' "
        "THEN 0.5 WHEN 'identity' THEN 1.5 WHEN 'card' THEN 1.5 WHEN 'device' THEN 1.2 WHEN 'td_device' THEN 2.0 "
        "WHEN 'ip' THEN 0.3 ELSE 0.1 END :: DOUBLE) AS association_risk FROM bucket_counts GROUP BY 1, 2"
    ),
    "sides": (
        "SELECT src_type AS node_type, src_key AS key, dst_type AS n_type, dst_key AS n_key, rel, last_seen_ts FROM edges "
        "UNION ALL SELECT dst_type, dst_key, src_type, src_key, rel, last_seen_ts FROM edges "
        "WHERE NOT (src_type = dst_type AND src_key = dst_key)"
    ),
    "near_overdue": (
        "SELECT DISTINCT s.node_type, s.key FROM sides s JOIN nodes o ON s.n_type = 'order' AND o.node_type = 'order' "
        "AND o.key = s.n_key WHERE upper(coalesce(o.order_status, '')) = 'OVERDUE'"
    ),
    "base": (
        "SELECT n.node_type, n.key, n.updated_at, "
        "CASE WHEN n.is_blacklisted THEN 100.0 :: DOUBLE "
        "WHEN n.node_type = 'order' AND upper(coalesce(n.order_status, '')) = 'OVERDUE' THEN 80.0 "
        "WHEN x.key IS NOT NULL THEN 80.0 ELSE 0.0 END AS status_risk, coalesce(a.association_risk, 0) AS association_risk "
        "FROM nodes n LEFT JOIN near_overdue x ON x.node_type = n.node_type AND x.key = n.key "
        "LEFT JOIN assoc_risk a ON a.node_type = n.node_type AND a.key = n.key "
        f"WHERE n.node_type IN ({quoted(rules.RISK_NODE_TYPES)})"
    ),
    "weights": (
        "SELECT s.node_type, s.key, s.n_type, s.n_key, s.rel, "
        "CASE s.rel WHEN 'HAS_IDENTITY' THEN 1.2 WHEN 'HAS_PHONE' THEN 0.8 WHEN 'LOGIN_WITH_PHONE' THEN 1.0 "
        "WHEN 'LOGIN_WITH_DEVICE' THEN 1.1 WHEN 'LOGIN_WITH_TD_DEVICE' THEN 1.5 WHEN 'LOGIN_WITH_IP' THEN 0.2 "
        "WHEN 'LOCATED_AT' THEN 0.3 WHEN 'HAS_CONTACT_PHONE' THEN 0.1 WHEN 'PLACED_ORDER' THEN 0.7 "
        "WHEN 'ORDER_APPLY_PHONE' THEN 1.0 WHEN 'ORDER_APPLY_IDENTITY' THEN 1.3 WHEN 'ORDER_APPLY_CARD' THEN 1.5 "
        "WHEN 'ORDER_REPAY_CARD' THEN 1.5 WHEN 'CARD_BIND_PHONE' THEN 1.0 ELSE 0.6 END :: DOUBLE * "
        "pow(0.1 :: DOUBLE, greatest(0.0 :: DOUBLE, epoch_us(n.updated_at) - epoch_us(s.last_seen_ts)) / 86400e6 / "
        "CASE s.rel WHEN 'LOGIN_WITH_IP' THEN 7.0 WHEN 'LOCATED_AT' THEN 30.0 ELSE 730.0 END) AS weight "
        "FROM sides s JOIN nodes n ON n.node_type = s.n_type AND n.key = s.n_key"
    ),
    "r0": "SELECT node_type, key, status_risk + association_risk AS risk FROM base",
    "r1": (
        "SELECT b.node_type, b.key, CASE WHEN s.linked THEN coalesce(s.total, 0) ELSE b.risk END AS risk FROM r0 b LEFT JOIN "
        "(SELECT w.node_type, w.key, true AS linked, sum(w.weight * r.risk) AS total FROM weights w "
        "LEFT JOIN r0 r ON r.node_type = w.n_type AND r.key = w.n_key GROUP BY 1, 2) s "
        "ON s.node_type = b.node_type AND s.key = b.key"
    ),
    "r2": (
        "SELECT b.node_type, b.key, CASE WHEN s.linked THEN coalesce(s.total, 0) ELSE b.risk END AS risk FROM r0 b LEFT JOIN "
        "(SELECT w.node_type, w.key, true AS linked, sum(w.weight * r.risk) AS total FROM weights w "
        "LEFT JOIN r1 r ON r.node_type = w.n_type AND r.key = w.n_key GROUP BY 1, 2) s "
        "ON s.node_type = b.node_type AND s.key = b.key"
    ),
    # -- anomaly neighbourhood
    "anomalies": (
        "SELECT n.node_type AS label, n.key, coalesce(a.associated_uid_count, 0) AS assoc, "
        "CASE WHEN n.is_blacklisted AND n.node_type IN ('uid', 'phone_num', 'identity_no') THEN 'blacklisted' "
        "ELSE 'shared' END AS kind FROM nodes n LEFT JOIN assoc a ON a.node_type = n.node_type AND a.key = n.key "
        f"WHERE n.node_type IN ({quoted(rules.ANOMALY_NODE_TYPES)}) AND "
        "((n.is_blacklisted AND n.node_type IN ('uid', 'phone_num', 'identity_no')) "
        "OR (n.node_type <> 'uid' AND coalesce(a.associated_uid_count, 0) > 1))"
    ),
    "pairs": "SELECT DISTINCT node_type || '|' || key AS a, n_type || '|' || n_key AS b FROM sides",
    "members": (
        "SELECT uid, CASE WHEN bool_or(listed) THEN 'blacklist' ELSE 'normal' END AS grp FROM "
        "(SELECT lower(user_id) AS uid, false AS listed FROM fx_order WHERE order_status IN ('REPAYED', 'EARLY_REPAYED') "
        "UNION ALL SELECT lower(c_customer_no), true FROM fx_blacklist_log) GROUP BY 1"
    ),
    "starts": (
        "SELECT m.uid, m.grp, 'uid|' || m.uid AS s FROM members m "
        "JOIN nodes n ON n.node_type = 'uid' AND n.key = m.uid"
    ),
    "hop1": "SELECT DISTINCT s.s, p.b AS v FROM starts s JOIN pairs p ON p.a = s.s WHERE p.b <> s.s",
    "hop2": "SELECT DISTINCT h.s, p.b AS v FROM hop1 h JOIN pairs p ON p.a = h.v WHERE p.b <> h.s",
    "hop3": "SELECT DISTINCT h.s, p.b AS v FROM hop2 h JOIN pairs p ON p.a = h.v WHERE p.b <> h.s",
    "dist": (
        "SELECT s, v, min(hop) AS hop FROM (SELECT s, v, 1 AS hop FROM hop1 UNION ALL SELECT s, v, 2 FROM hop2 "
        "UNION ALL SELECT s, v, 3 FROM hop3) GROUP BY 1, 2"
    ),
    "found": (
        "SELECT substr(d.s, 5) AS uid, d.hop, x.kind, x.label, x.key, x.assoc FROM dist d "
        "JOIN anomalies x ON d.v = x.label || '|' || x.key"
    ),
    "hop_totals": (
        "SELECT m.grp, m.uid, h.hop, count(f.uid) AS n FROM members m CROSS JOIN (VALUES (1), (2), (3)) h(hop) "
        "LEFT JOIN found f ON f.uid = m.uid AND f.hop = h.hop GROUP BY 1, 2, 3"
    ),
    "uid_totals": "SELECT grp, uid, sum(n) AS total FROM hop_totals GROUP BY 1, 2",
    "scores": (
        "SELECT m.grp, m.uid, coalesce(sum(CASE "
        "WHEN f.hop = 2 AND f.kind = 'blacklisted' AND f.label = 'uid' THEN 10.0 "
        "WHEN f.hop = 1 AND f.kind = 'blacklisted' AND f.label <> 'uid' THEN 1.0 * (f.assoc - 1) "
        "WHEN f.hop = 1 AND f.kind = 'shared' THEN 1.0 * (f.assoc - 1) "
        "WHEN f.hop = 3 AND f.kind = 'blacklisted' AND f.label <> 'uid' THEN 10.0 * (f.assoc - 1) "
        "WHEN f.hop = 3 AND f.kind = 'shared' THEN 0.1 * (f.assoc - 1) ELSE 0 END :: DOUBLE), 0) AS score "
        "FROM members m LEFT JOIN found f ON f.uid = m.uid GROUP BY 1, 2"
    ),
}

#: Feed -> where its rows come from.
FEED_SQL = {
    "customer_log": "fx_customer_log",
    "login": "fx_login",
    "lbs_gps": "fx_lbs_gps",
    "first_linkman": "fx_linkman",
    "second_linkman": "fx_second_linkman",
    "first_linkman_derived": "fx_linkman_derived",
    "second_linkman_derived": "fx_second_linkman_derived",
    "logout": "fx_logout",
    "order": "fx_order",
    "repay_plan": "fx_repay_plan",
    "company_log": "fx_company_log",
    "complaint": "(SELECT * FROM fx_cases WHERE source = 'complaint')",
    "consumer_protection_case": "(SELECT * FROM fx_cases WHERE source = 'consumer')",
    "blacklist_log": "fx_blacklist_log",
}

_HEAVY = {"edge_rows", "edges", "nodes", "sides", "weights", "r0", "r1", "dist", "found", "hop1", "hop2", "pairs", "bucket_links"}


def query(select: str) -> str:
    """``select`` with every block it uses, directly or through others."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        text = todo.pop()
        for name, body in BLOCKS.items():
            if name not in needed and _mentions(text, name):
                needed.add(name)
                todo.append(body)
    blocks = [f"{n} AS {'MATERIALIZED ' if n in _HEAVY else ''}({BLOCKS[n]})" for n in BLOCKS if n in needed]
    return f"WITH {', '.join(blocks)} {select}" if blocks else select


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text, re.IGNORECASE) is not None
