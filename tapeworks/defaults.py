"""Names, sizes and thresholds the frame contract prescribes.

They have to be exactly these for results to agree with the service the
library reproduces; every operator takes them as overridable parameters.
"""

# Streams subscribed to when no list is configured, in order.
DEFAULT_STREAMS = (
    "btcusdt@trade",
    "btcusdt@ticker",
    "btcusdt@depth20@100ms",
    "btcusdt@kline_1h",
    "ethusdt@trade",
    "ethusdt@ticker",
    "ethusdt@depth20@100ms",
    "ethusdt@kline_1h",
)

# Event type -> stream suffix; any other event type is its own suffix.
EVENT_SUFFIXES = {
    "trade": "trade",
    "24hrTicker": "ticker",
    "depthUpdate": "depth20@100ms",
    "markPriceUpdate": "markPrice@1s",
    "fundingRate": "fundingRate@1s",
}
BOOK_SUFFIX = "depth20@100ms"
# Stream types that get a folder of their own when frames are landed.
LANDED_TYPES = ("trade", "ticker", "depth20", "markPrice", "fundingRate", "kline", "aggTrade")

# Message kind by substring of the stream id, tested in this order.
KIND_MARKERS = (("@trade", "trade"), ("@ticker", "ticker"), ("@depth", "depth"))
GENERIC_KIND = "generic"

# Envelope.
ENVELOPE_SOURCE = "binance-websocket"
ENVELOPE_VERSION = "1.0"
PUBLISH_SUBJECT = "binance.websocket.data"
REQUIRED_FIELDS = ("stream", "data", "timestamp")

# Limits and intervals.
MAX_MESSAGE_BYTES = 1048576
MESSAGE_TTL_SECONDS = 60
QUEUE_CAPACITY = 5000
HEARTBEAT_SECONDS = 60
STATS_INTERVAL_SECONDS = 60
RECONNECT_DELAY_SECONDS = 5
MAX_RECONNECT_ATTEMPTS = 10

# Heartbeat record.
SERVICE_VERSION = "1.0.0"
HEALTHY = "healthy"

# Candle periods in seconds.
CANDLE_PERIODS = {"5m": 300, "15m": 900, "30m": 1800, "1h": 3600, "1d": 86400}

# Completion subjects.
EXTRACTION_PREFIX = "binance.extraction"

# Order in which the pipeline jobs run.
JOB_ORDER = ("klines", "funding", "trades", "gap-filler")

# Alert thresholds.
MIN_MESSAGES_PER_SECOND = 1000
MAX_QUEUE_PERCENT = 80
MAX_STALENESS_SECONDS = 1
