"""Results depend on every one of them."""

# Price formulas
GARMAN_KLASS_RANGE = 0.511
GARMAN_KLASS_BODY = 0.3862943611198906
PARKINSON_DIVISOR = 2.772588722239781
DIVISION_GUARD = 1e-6
PROXY_LAG_1 = 0.4
PROXY_LAG_2 = 0.12
ROLLING_ROWS = 10

# Fractional differencing
FRAC_ORDER = 0.4
FRAC_THRESHOLD = 1e-4
FRAC_MAX_LAG = 100

# Gates
SPIKE_RANGE = 0.20
MIN_SHARPE = 1.5
MAX_TICK_AGE_MS = 10
SAMPLE_ROWS = 5

# Session opening hours for midnight bars: continuous symbols end in "$"
CONTINUOUS_SUFFIX = "$"
CONTINUOUS_OPEN_HOUR = 9
OTHER_OPEN_HOUR = 10

# Symbols whose expiring contracts are spliced into one series
SPLICED_ROOTS = ("WIN$", "WDO$")

# Expiry month letters, January to December
MONTH_LETTERS = "FGHJKMNQUVXZ"
