"""Values the marts and fixtures share."""

# USD per million tokens (in, out), embedding price, thresholds.
CALL_PRICES = (
    ("small", 0.80, 4.00),
    ("medium", 3.00, 15.00),
    ("large", 15.00, 75.00),
)
EMBED_USD_PER_1K_TOKENS = 0.00013
ZERO_HIT_SCORE = 0.30
ZERO_HIT_ALERT = 0.25
STALE_ALERT = 0.0

# Shape of the generated call log and of the generated document store.
MODEL_WEIGHTS = (("medium", 6), ("small", 3), ("large", 1))
STATUS_WEIGHTS = (("ok", 95), ("rate_limited", 3), ("error", 2))
LATENCY_MS = {"small": (450, 150), "medium": (1100, 350), "large": (2400, 700)}
RETRY_RATE = 0.05
RETRY_REACH = 1024
SPAN_DAYS = 7
MODALITIES = (("text", "pdf"), ("image_caption", "png"), ("audio_transcript", "mp3"))
EMBEDDING_MODEL = "text-embed-large"

# Labels of generated rows; they decide no result.
TENANTS = ("north", "south", "west")
SOURCES = ("wiki", "drive", "desk")
