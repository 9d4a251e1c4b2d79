"""Fixed values of the screens.

These must equal the screening rules being reproduced; every operator takes them
as keyword defaults, so a caller can override any of them per call.
"""

# --- fixed values: momentum rebound criteria ------------------------------------------
DOWN_FROM_OPEN = 0.97          # 1: close <= 0.97 x open
LOWER_SHADOW = 0.6             # 2: close - low >= 0.6 x (high - low), close > low
VOLUME_SURGE = 1.5             # 3: volume >= 1.5 x average volume
LIQUID_VALUE = 5_000_000_000   # 4: traded value >= 5,000,000,000
NEAR_SUPPORT = 1.02            # 5: low <= 1.02 x previous low
TAPE_MOMENTUM_PCT = 2.0        # 6: (max - min) / min of the day's trades >= 2 %
AGGRESSIVE_BUY_SHARE = 0.6     # 7: up-tick volume / total volume >= 0.6
NOT_OVERHEATED = 3             # 8: volume < 3 x average volume
STRENGTHENING = 1.03           # 9: close > 1.03 x previous close
NOT_OVEREXTENDED = 1.10        # 11: close <= 1.10 x lowest close of the range window
NOT_IN_DOWNTREND = 0.95        # 12: close >= 0.95 x highest close of the range window
LARGE_TRADE_VOLUME = 1_000_000 # large-trade volume floor
MIN_TAPE_TRADES = 10           # trades needed for a tape summary
RANGE_WINDOW_DAYS = 20         # as-of screen input window (calendar days)
HISTORY_LOOKBACK_DAYS = 30     # history volume average window (calendar days)
STRICT_MIN_DAYS = 20           # strict screen: days in the history average
DETAIL_MIN_DAYS = 15           # detail screen: days in the history average
SUMMARY_MIN_DAYS = 5           # summary-only screens: distinct days in the average
MIN_CRITERIA_RELAXED = 4       # relaxed screen: criteria met out of 5

# --- fixed values: daily trading, breakout and swing screens ---------------------------------
DAILY_UP = 1.05                # close >= 1.05 x previous price
DAILY_VOLUME_UP = 1.20         # volume >= 1.20 x last volume
BREAKOUT_VOLUME_FLOOR = 0.20   # MA5 breakout: volume >= 0.20 x previous volume
AFTERNOON_START = 870          # minute of day, buckets [870, 900], [900, 930], >= 930
AFTERNOON_MID = 900
AFTERNOON_LATE = 930
SWING_MIN_PRICE = 100          # MA20 swing: price > 100
SWING_BAND_LOW = 0.97          # price >= 0.97 x MA20
SWING_BAND_HIGH = 1.03         # price <= 1.03 x MA20
SWING_VOLUME_PREV = 1.30       # volume >= 1.30 x previous volume
SWING_VOLUME_MA = 1.50         # volume >= 1.50 x 20-day average volume

# --- fixed values: 13-rule swing screen ---------------------------------------------------------
MAX_MARKET_CAP = 5_000_000_000_000   # rupiah
MAX_FREE_FLOAT = 40                  # percent
MAX_RANGE_60 = 1.8                   # highest(60) / lowest(60)
RSI_LOW = 55
RSI_HIGH = 70
MAX_CLOSE_MA200 = 2
MAX_CANDLE = 0.12                    # (high - low) / close
MARKET_CAP_UNIT = 1_000_000          # stored market capitalisation is in millions

# --- fixed values: sideways screens -----------------------------------------------------------------
SIDEWAYS_RANGE = 0.05          # (max - min) / min of prior closes
SIDEWAYS_VOLUME = 0.20         # volume / average prior volume
SIDEWAYS_VALUE_7D = 5_000_000_000
SIDEWAYS_VALUE_NIGHTLY = 1_000_000_000
SIDEWAYS_DAYS_SHORT = 7
SIDEWAYS_DAYS_NIGHTLY = 60

# --- fixed values: marks and list sizes ----------------------------------------------------------------
MARK_YES = "✓"
MARK_NO = "✗"
WORD_YES = "YES"
WORD_NO = "NO"
TOP_LIST_SIZE = 10
MOVERS_SESSION = (540, 1020)   # minutes of day 09:00 to 17:00 for which movers are listed
CANDIDATE_LIST_SIZE = 20
MISSING_LIST_SIZE = 50
