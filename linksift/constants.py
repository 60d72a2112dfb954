"""Names, word lists, patterns and limits.

Everything in this file is data that must equal the published behaviour for
results to agree. It holds no logic.
"""

from __future__ import annotations

# --- fixed values: feature names in output order ---------------------------
FEATURES = (
    "url_length", "dots", "hyphens", "digits", "slashes",
    "question_marks", "equals_signs", "ampersands", "percents",
    "path_length", "query_length", "has_at", "has_ip",
    "double_slash", "punycode", "hex_encoding",
    "subdomains", "domain_length", "suspicious_tld", "digit_ratio",
    "hyphen_ratio", "https", "ssl_hint",
    "brand_in_subdomain", "url_entropy", "params",
    "max_token", "tld_length", "port", "path_depth",
    "homoglyph", "unicode_mix", "scheme_risk",
    "brand_distance", "double_extension",
    "key_entropy", "path_tokens", "authority_length",
    "encoded_redirect", "max_digit_run",
    "subdomain_entropy", "path_entropy", "query_entropy",
    "jaro_winkler_brand", "ip_in_hex", "contains_port_8080",
    "too_many_dots", "ends_with_zip",
    "exclamation_marks", "consecutive_question_marks",
)

# --- fixed values: features that pass through unscaled ---------------------
PASSTHROUGH_FEATURES = (
    "has_at", "has_ip", "double_slash", "punycode", "hex_encoding",
    "suspicious_tld", "https", "ssl_hint", "brand_in_subdomain", "port",
    "homoglyph", "double_extension", "encoded_redirect", "ip_in_hex",
    "contains_port_8080", "too_many_dots", "ends_with_zip",
    "exclamation_marks", "consecutive_question_marks",
)
CONTINUOUS_FEATURES = tuple(f for f in FEATURES if f not in PASSTHROUGH_FEATURES)

# --- fixed values: features stored as DOUBLE (all others are INT) ----------
DOUBLE_FEATURES = (
    "digit_ratio", "hyphen_ratio", "url_entropy", "unicode_mix", "scheme_risk",
    "brand_distance", "key_entropy", "subdomain_entropy", "path_entropy",
    "query_entropy", "jaro_winkler_brand",
)

# --- fixed values: top-level domains counted as suspicious -----------------
SUSPICIOUS_TLDS = (
    "tk", "ml", "ga", "cf", "gq", "xyz", "top", "work", "click", "link",
    "loan", "download", "racing", "win", "bid", "review", "country",
    "stream", "accountant", "science", "party", "gdn", "zip", "mov",
    "casa", "rest", "cyou", "sbs", "buzz", "monster", "quest", "lol",
    "icu", "vip", "cam", "surf", "bar", "beauty", "makeup", "skin",
    "fit", "cfd", "sarl", "hair", "mom", "lifestyle",
)

# --- fixed values: brand names ---------------------------------------------
BRANDS = (
    "paypal", "apple", "microsoft", "google", "amazon", "facebook",
    "instagram", "netflix", "linkedin", "twitter", "dropbox", "dhl",
    "fedex", "ups", "usps", "chase", "wellsfargo", "bankofamerica",
    "citibank", "hsbc", "santander", "binance", "coinbase", "metamask",
    "steam", "roblox", "discord", "whatsapp", "telegram", "outlook",
    "office365", "icloud", "adobe", "spotify", "github", "gitlab",
    "stripe", "square", "venmo", "zelle", "revolut", "klarna",
    "sberbank", "tinkoff", "vtb", "alfabank", "gazprombank",
    "yandex", "mailru", "vk", "ok", "gosuslugi", "mos",
)

# --- fixed values: shortener hosts -----------------------------------------
URL_SHORTENERS = (
    "bit.ly", "tinyurl.com", "t.co", "goo.gl", "ow.ly", "is.gd",
    "buff.ly", "rebrand.ly", "cutt.ly", "shorturl.at", "rb.gy",
    "t.ly", "shorte.st", "adf.ly", "bl.ink", "s.id", "v.gd",
    "clck.ru", "vk.cc", "u.to", "qps.ru",
)

# --- fixed values: words that point at data theft --------------------------
SUSPICIOUS_WORDS = (
    "login", "signin", "verify", "secure", "update", "account",
    "confirm", "recover", "unlock", "billing", "invoice", "password",
    "credential", "wallet", "seed", "backup", "auth", "session",
    "kyc", "2fa", "otp", "webscr", "cmd", "dispatch", "tracking",
    "вход", "войти", "подтвердить", "восстановить", "пароль", "счет",
    "оплата", "перевод", "банк", "госуслуги", "сбербанк",
)

# --- fixed values: look-alike characters and the letter each imitates ------
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "ь": "b", "п": "n",
    "ν": "v", "ρ": "p", "τ": "t", "ο": "o", "ι": "i", "κ": "k", "μ": "u",
    "А": "A", "Е": "E", "О": "O", "Р": "P", "С": "C", "Х": "X", "У": "Y",
}

# --- fixed values: letter -> look-alike used by the mutator ----------------
# (where two look-alikes share a letter, the Greek one is used)
LOOKALIKE_FOR = {
    "a": "а", "e": "е", "o": "ο", "p": "ρ", "c": "с", "x": "х", "y": "у",
    "s": "ѕ", "i": "ι", "j": "ј", "d": "ԁ", "g": "ɡ", "b": "ь", "n": "п",
    "v": "ν", "t": "τ", "k": "κ", "u": "μ",
    "A": "А", "E": "Е", "O": "О", "P": "Р", "C": "С", "X": "Х", "Y": "У",
}

# --- fixed values: regular expressions -------------------------------------
HEX_SEQUENCE_PATTERN = "(%[0-9A-Fa-f]{2}){3,}"
DOUBLE_EXTENSION_PATTERN = (
    r"\.(pdf|doc|docx|xls|xlsx|jpg|png|txt|zip|exe)\.(html?|php|asp|jsp)$"
)
REDIRECT_KEY_PATTERN = r"(url|redirect|next|return|continue|goto|target)\s*="
HEX_IP_PATTERN = "0x[0-9a-f]{8}"
TOKEN_SEPARATOR_PATTERN = "[^A-Za-z0-9Ѐ-ӿ]+"
TLD_PATTERN = "[a-zЀ-ӿ]{2,24}"
HEX_TOKEN_PATTERN = "[0-9A-Fa-f]{12,}"

# --- fixed values: schemes whose last path segment may carry ;params -------
PARAMS_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps",
    "rtspu", "sip", "sips", "mms", "sftp", "tel",
)

# --- fixed values: scheme risk ---------------------------------------------
RISKY_SCHEMES = ("http", "", "ftp", "file", "data", "javascript")

# --- fixed values: rules shipped by default --------------------------------
# name, pattern, severity, weight, kind. The two *_uri patterns are stated
# without a leading ^, because kind "prefix" compares literally.
DEFAULT_RULES = (
    ("shortener", "bit.ly", "medium", 0.5, "host_equals"),
    ("free_hosting", r"\.(000webhostapp|weebly|wixsite|godaddysites)\.", "medium", 0.4, "regex"),
    ("dodgy_tld", r"\.(tk|ml|ga|cf|gq|xyz|top|buzz)([/:?]|$)", "low", 0.3, "regex"),
    ("double_extension", r"\.(pdf|doc|docx|xls|xlsx|exe|zip)\.(html?|php|asp|jsp)", "high", 0.8, "regex"),
    ("many_subdomains", r"^([^.]+\.){4,}", "low", 0.3, "regex"),
    ("at_in_authority", r"://[^/]*@", "high", 0.9, "regex"),
    ("base64_block", r"[A-Za-z0-9+/]{40,}={0,2}", "medium", 0.5, "regex"),
    ("hex_ip", r"0x[0-9a-f]{8}", "high", 0.7, "regex"),
    ("octal_ip", r"://0\d{1,3}\.", "medium", 0.5, "regex"),
    ("data_uri", "data:", "medium", 0.4, "prefix"),
    ("javascript_uri", "javascript:", "high", 0.9, "prefix"),
    ("redirect_in_query", r"[?&](url|redirect|next|continue)=", "medium", 0.5, "regex"),
    ("russian_phishing", r"(госуслуги|сбербанк|тинькофф|втб).*(войти|пароль|вход)", "high", 0.8, "regex"),
)

# --- fixed values: defaults for fields missing in a rules file --------------
RULE_DEFAULTS = {"severity": "medium", "weight": 0.4, "kind": "contains", "enabled": True}

# --- fixed values: token kinds and weights ---------------------------------
TOKEN_WEIGHTS = {
    "scheme": 0.0, "sep": 0.0, "brand": 0.7, "risky_tld": 0.6, "punycode": 0.7,
    "homoglyph": 0.8, "digits": 0.3, "host": 0.1, "word": 0.5, "hex": 0.5,
    "path": 0.1,
}

# --- fixed values: limits and thresholds -----------------------------------
MAX_URL_CHARS = 8192
NO_BRAND_DISTANCE = 99.0
BRAND_DISTANCE_CAP = 3
BRAND_LENGTH_BAND = 3
MIN_BRAND_LABEL = 3
ALERT_RISK = 80
UNCERTAIN_LOW, UNCERTAIN_HIGH = 0.35, 0.65
PSI_WARN, PSI_ALERT = 0.10, 0.25
SCHEMA_VERSION = 3

# --- fixed values: weights of the fixed linear scorer used in checks --------
SIMILARITY_FREE_SCORE = {
    "intercept": -3.0,
    "suspicious_tld": 2.5,
    "has_ip": 2.0,
    "punycode": 2.0,
    "brand_in_subdomain": 1.5,
    "url_length": 0.03,
    "dots": 0.25,
}
