"""Fixed values that must equal the source system's for equal results."""

# --- fixed values --------------------------------------------------------
# Alert thresholds.
HIGH_AMOUNT_USD = 5000
VELOCITY_MIN_TX_5MIN = 5
# Velocity windows in minutes (trailing, left-open, right-closed).
VELOCITY_WINDOWS_MIN = (5, 15, 60)
# Risk bands by credit score: >= 700 bajo, >= 550 medio, otherwise alto.
RISK_BAND_BAJO_MIN = 700
RISK_BAND_MEDIO_MIN = 550
RISK_BAJO, RISK_MEDIO, RISK_ALTO = "bajo", "medio", "alto"
# Score range and histogram buckets.
SCORE_MIN, SCORE_MAX, SCORE_BUCKETS = 300, 850, 11
# Card masking formats.
PAN_MASK_PREFIX = "**** **** **** "
PAN_KEEP_DIGITS = 4
CARDHOLDER_KEEP_CHARS = 2
CARDHOLDER_MASK = "** "
# Rule labels of the alerts-per-rule report, in report order.
RULE_LABELS = ("monto-alto", "limite-superado", "velocidad",
               "ubicacion-distinta", "flag-oltp")
# Served-query bounds and defaults.
ALERTS_LIMIT_DEFAULT, ALERTS_LIMIT_MAX = 50, 500
SUMMARY_HOURS_DEFAULT, SUMMARY_HOURS_MAX = 24, 168
FEED_LIMIT = 50
HOURLY_PANEL_LIMIT = 168
# Micro-batch sink: flush interval.
SINK_FLUSH_SECONDS = 5
# Card feed page size.
CARD_PAGE_SIZE = 50
# -------------------------------------------------------------------------
