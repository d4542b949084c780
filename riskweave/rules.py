"""Fixed values of the domain.

Every constant here must equal the value used by the scoring rules, otherwise
results differ. They are plain data, kept together.
"""

# -- cleaning -----------------------------------------------------------------

# Texts that mean "no value", compared after trim and lower.
NULL_TOKENS = ("", "nan", "none", "null")

# Every character a trim removes (Unicode whitespace).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Device numbers that are placeholders.
PLACEHOLDER_DEVICES = (
    "unknown",
    "unk",
    "none",
    "null",
    "nan",
    "-",
    "--",
    "0",
    "00000000",
    "0000000000000000",
    "00000000-0000-0000-0000-000000000000",
)

# -- graph schema -------------------------------------------------------------

# Node types that carry risk.
RISK_NODE_TYPES = (
    "uid",
    "phone_num",
    "identity_no",
    "device_no",
    "td_device_id",
    "remote_ip",
    "geo_code",
    "card_no",
    "order",
)

# Node types that can end an anomaly path.
ANOMALY_NODE_TYPES = (
    "uid",
    "phone_num",
    "identity_no",
    "card_no",
    "device_no",
    "td_device_id",
    "remote_ip",
    "geo_code",
)

# Node types that hold a blacklist mark.
BLACKLISTABLE_TYPES = ("uid", "phone_num", "identity_no")

# Non-uid identifier types with an association count.
ASSOCIATED_TYPES = (
    "phone_num",
    "identity_no",
    "card_no",
    "device_no",
    "td_device_id",
    "remote_ip",
    "geo_code",
)

# -- risk rules ---------------------------------------------------------------

BLACKLISTED_RISK = 100.0
OVERDUE_RISK = 80.0

# Weight of (distinct users - 1) per association bucket.
ASSOCIATION_WEIGHTS = {
    "phone_main": 1.0,
    "phone_contact": 0.5,
    "identity": 1.5,
    "card": 1.5,
    "device": 1.2,
    "td_device": 2.0,
    "ip": 0.3,
    "geo": 0.1,
}

# Days before node.updated_at that still count, per bucket.
ASSOCIATION_WINDOW_DAYS = {"ip": 7, "geo": 30}

# Weight of a relation.
RELATION_WEIGHTS = {
    "HAS_IDENTITY": 1.2,
    "HAS_PHONE": 0.8,
    "LOGIN_WITH_PHONE": 1.0,
    "LOGIN_WITH_DEVICE": 1.1,
    "LOGIN_WITH_TD_DEVICE": 1.5,
    "LOGIN_WITH_IP": 0.2,
    "LOCATED_AT": 0.3,
    "HAS_CONTACT_PHONE": 0.1,
    "PLACED_ORDER": 0.7,
    "ORDER_APPLY_PHONE": 1.0,
    "ORDER_APPLY_IDENTITY": 1.3,
    "ORDER_APPLY_CARD": 1.5,
    "ORDER_REPAY_CARD": 1.5,
    "CARD_BIND_PHONE": 1.0,
}
DEFAULT_RELATION_WEIGHT = 0.6

# Days after which a relation weighs one tenth.
DECAY_DAYS = {"LOGIN_WITH_IP": 7.0, "LOCATED_AT": 30.0}
DEFAULT_DECAY_DAYS = 730.0

# Hop -> weight per anomaly kind and node type.
HOP_WEIGHTS = {
    1: {
        ("blacklisted", "phone_num"): 1.0,
        ("blacklisted", "identity_no"): 1.0,
        ("shared", "phone_num"): 1.0,
        ("shared", "identity_no"): 1.0,
        ("shared", "card_no"): 1.0,
        ("shared", "device_no"): 1.0,
        ("shared", "td_device_id"): 1.0,
        ("shared", "remote_ip"): 1.0,
        ("shared", "geo_code"): 1.0,
    },
    2: {
        ("blacklisted", "uid"): 10.0,
    },
    3: {
        ("blacklisted", "phone_num"): 10.0,
        ("blacklisted", "identity_no"): 10.0,
        ("shared", "phone_num"): 0.1,
        ("shared", "identity_no"): 0.1,
        ("shared", "card_no"): 0.1,
        ("shared", "device_no"): 0.1,
        ("shared", "td_device_id"): 0.1,
        ("shared", "remote_ip"): 0.1,
        ("shared", "geo_code"): 0.1,
    },
}

# -- order status classes -----------------------------------------------------

# Status classes (spelling as delivered by the feed).
NORMAL_STATUSES = ("EARLY_REPAYED", "REPAYED")
ABNORMAL_STATUSES = ("OVERDUE",)
EXCLUDED_STATUSES = (
    "INIT",
    "INITLOAN",
    "VERIFCANCEL",
    "PREVERIF",
    "LOAN_REFUSE",
    "ON_ROUTE",
    "HOLD_ON",
    "RISK_CONFIRM",
    "PRESIGN",
    "SINGFAIL",
    "FINANCING",
    "CANCEL",
    "PRELOAN",
    "FAIL",
    "REPAYING",
    "LOAN_SUCESS_PRE_WP",
    "EARLYREPAYING",
    "REFUNDSETTLED",
    "WAITING_PAYMENT",
    "WAITING_WITHDRAW",
    "WITHDRAWING",
    "WITHDRAW_SUCESS",
    "SETTLED",
    "NOTICE_SETTLE",
    "WITHDRAW_FAIL_CARD",
)

# -- cut-offs -----------------------------------------------------------------

TOP_DEVICES = 10_000
TOP_RISKS = 3_000
ISOLATION_THRESHOLD = 2
ISOLATION_RATE_ALERT = 0.3
GROUP_RATIO_ALERT = 2.0
BLACKLIST_CUT = "2025-11-20 00:00:00"

# -- header rules -------------------------------------------------------------

# Columns every delivered file of a dataset must have.
REQUIRED_COLUMNS = {
    "blacklist_log": [
        "c_customer_no",
        "c_reason_list",
        "c_mobile_phone",
        "c_identity_no",
        "d_begin_date",
        "n_banned_days",
        "n_duration",
    ],
    "company_log": [
        "id",
        "companyid",
        "cid",
        "company_name",
        "company_address",
        "tel_phone",
        "create_date",
        "modify_date",
    ],
    "complaint": [
        "c_id",
        "c_contact_phone_no",
        "c_register_phone_no",
        "c_customer_name",
        "c_identity_no",
        "d_create",
        "d_update",
    ],
    "consumer_protection_case": [
        "c_id",
        "c_contact_phone_no",
        "c_register_phone_no",
        "c_customer_name",
        "c_identity_no",
        "d_create",
        "d_update",
    ],
    "customer_log": [
        "id",
        "baseid",
        "customer_name",
        "identity_no",
        "mobile_phone",
        "marital_status",
        "status",
        "apply_amount_channel",
        "declared_degree",
        "modify_date",
        "create_date",
        "issue_channel",
        "regist_channel",
        "loan_apply_date",
        "log_create_date",
        "log_modify_date",
    ],
    "first_linkman": [
        "id",
        "cid",
        "linkman_name",
        "mobile_phone",
        "relation_ship",
        "create_date",
        "modify_date",
    ],
    "first_linkman_derived": [
        "id",
        "cid",
        "linkman_name",
        "mobile_phone",
        "relation_ship",
        "create_date",
        "modify_date",
    ],
    "lbs_gps": [
        "id",
        "cid",
        "logitude",
        "latitude",
        "city_code",
        "city_name",
        "provice_code",
        "provice_name",
        "area_code",
        "area_name",
        "address",
        "geo_code",
        "current_flag",
        "create_date",
        "modify_date",
    ],
    "login": [
        "phone_num",
        "cif_user_id",
        "channel_name",
        "login_time",
        "device_type",
        "device_no",
        "remote_ip",
        "app_channel",
        "bundle_id",
        "app_version",
        "os_name",
        "os_version",
        "td_device_id",
        "province",
        "city",
        "last_active_channel",
        "date",
    ],
    "logout": [
        "id",
        "cid",
        "identity_no",
        "mobile_phone",
        "create_date",
        "modify_date",
    ],
    "order": [
        "id",
        "channel_no",
        "loan_channel",
        "contract_no",
        "user_id",
        "apply_loan_name",
        "apply_loan_tel",
        "apply_ident_no",
        "apply_loan_date",
        "sign_date",
        "repay_day",
        "apply_card_no",
        "apply_bank",
        "apply_bank_mobile",
        "repay_card_no",
        "repay_bank",
        "repay_bank_mobile",
        "order_begin_date",
        "order_end_date",
        "firsttime_repay_date",
        "loan_date",
        "overdue_date",
        "order_status",
        "settle_date",
        "create_date",
        "modify_date",
    ],
    "repay_plan": [
        "id",
        "order_id",
        "contract_no",
        "current_repay_date",
        "repayed_date",
        "early_repay_mark",
        "overdue_mark",
        "overdue_days",
        "current_repay_status",
        "create_date",
        "modify_date",
    ],
    "second_linkman": [
        "id",
        "cid",
        "second_linkman_name",
        "second_mobile_phone",
        "relation_ship",
        "create_date",
        "modify_date",
    ],
    "second_linkman_derived": [
        "id",
        "cid",
        "second_linkman_name",
        "second_mobile_phone",
        "relation_ship",
        "create_date",
        "modify_date",
    ],
}
REQUIRED_ANY_OF: dict[str, list[list[str]]] = {}
