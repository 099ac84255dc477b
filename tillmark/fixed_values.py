"""Labels, weights, bounds and texts that results must agree on."""

# Display names of behaviour types; types not listed pass through unchanged.
BEHAVIOR_LABELS = {
    "view": "浏览",
    "search": "搜索",
    "cart": "加购",
    "purchase": "购买",
}

# Display names of payment methods; methods not listed pass through unchanged.
PAYMENT_LABELS = {
    "alipay": "支付宝",
    "wechat": "微信支付",
    "card": "银行卡",
    "cash": "现金",
}

# A province name ending in one of these has all trailing characters of the
# second set removed.
REGION_ENDINGS = ("省", "市", "区")
REGION_SUFFIX_CHARS = "省市区自治"

# Member tiers: name, lowest and highest total spend (both inclusive), discount.
MEMBER_TIERS = [
    ("普通会员", 0, 1000, "1.00"),
    ("银卡会员", 1001, 5000, "0.98"),
    ("金卡会员", 5001, 20000, "0.95"),
    ("钻石会员", 20001, 50000, "0.90"),
    ("至尊会员", 50001, 999999, "0.85"),
]

# Holidays that lift daily order volume: month, day, weight.
HOLIDAYS = [
    (1, 1, 5),
    (2, 14, 3),
    (5, 1, 4),
    (6, 18, 5),
    (10, 1, 5),
    (11, 11, 10),
    (12, 12, 8),
    (12, 25, 3),
]
HOLIDAY_REACH_DAYS = 3
WEEKEND_WEIGHT = 1.5
CALENDAR_DAYS = 365

# Relative frequencies of behaviour types and payment methods.
BEHAVIOR_WEIGHTS = {"view": 70, "search": 15, "cart": 10, "purchase": 5}
PAYMENT_WEIGHTS = {"alipay": 40, "wechat": 40, "card": 15, "cash": 5}

# Cost and market price as a share of the list price.
COST_SHARE = "0.7"
MARKET_SHARE = "1.2"

# Dashboard windows and sizes.
TREND_DAYS = 30
HISTORY_DAYS = 90
MIN_HISTORY_DAYS = 14
FORECAST_DAYS = 30
HOT_PRODUCTS = 10
PAGE_SIZE = 20

# Order status of a completed order, payment status of a paid order.
COMPLETED = 3
PAID = 1

# Forecast verdicts by growth rate in percent: strictly above the bound.
GROWTH_VERDICTS = [
    (10, "预测未来30天销售额将显著增长，建议增加库存和营销投入。"),
    (0, "预测未来30天销售额将稳定增长，建议维持当前经营策略。"),
    (-10, "预测未来30天销售额将略有下降，建议适当调整促销策略。"),
]
GROWTH_VERDICT_ELSE = "预测未来30天销售额将显著下降，建议加大促销力度并分析下降原因。"
NO_FORECAST_VERDICT = "无法生成预测，请确保有足够的历史数据。"

# Names shown when a chart has no rows.
NO_DATA = "暂无数据"
NO_REGION = "北京"

# Reasons for turning down a registration.
REJECT_MISSING = "请填写所有必填字段"
REJECT_MISMATCH = "两次输入的密码不一致"
REJECT_TAKEN = "该用户名已被注册"
