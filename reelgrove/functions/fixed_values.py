"""Texts, labels, thresholds and ranges that results depend on."""

# ---- fixed values -----------------------------------------------------------
EXPLAIN_SYSTEM_PROMPT = (
    "You are a recommendation explainer for a streaming app. Given a user's "
    "recently watched genres and a candidate title, return ONE short sentence "
    "(max 20 words) explaining why the user might like the candidate. "
    "Do not mention the user by name. Do not invent facts."
)
USER_PROMPT_FORMAT = (
    "Recently watched: %s\n"
    "Favorite genre: %s\n"
    "Candidate: '%s' (genre: %s)\n"
    "Why might they like this candidate?"
)
FALLBACK_EXPLANATION_FORMAT = "Recommended based on your taste in %s."
UNKNOWN_TITLES = "unknown"
DEFAULT_GENRE = "drama"
REDACTED = "REDACTED"

RETRIEVED_BY_TEXT = "vector_search"
RETRIEVED_BY_FACTORS = "two_tower"
RETRIEVED_BY_POPULARITY = "popular"

PII_TAG = "pii"
OWNER_TAG = "business_owner"
COST_TAG = "cost_center"
PII_READERS_GROUP = "pii_readers"

TIMESTAMP_PREFERENCE = ("request_time", "timestamp_ms", "__db_request_time")

COMPLETED_SHARE = 0.85
VALID_VIEW_SECONDS = 30
COLD_START_INTERACTIONS = 5
RATE_LIMIT_PER_MINUTE = 100
TOP_K = 5
NUM_CANDIDATES = 100
PROMPT_TITLES = 3
TRAINING_ROW_CAP = 200_000

FACTOR_RANK = 32
FACTOR_PASSES = 3
FACTOR_REGULARISATION = 0.01
SEED = 42

SEARCH_TRIALS = 5
SEARCH_LEAVES = (16, 64)
SEARCH_LEARNING_RATE = (0.01, 0.2)
SEARCH_TREES = (50, 200)
SEARCH_MIN_CHILD = (5, 50)

EMBEDDING_TEXT_SEPARATOR = " | "

ASSET_COLUMNS = {
    "chapter": "int", "asset_type": "string", "name": "string", "id": "string",
    "url": "string", "description": "string", "created_at": "timestamp",
}
# -----------------------------------------------------------------------------
