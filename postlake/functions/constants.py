"""Fixed values that must equal the reference's for identical results.

They are stated once, as plain text in their natural order, and imported
everywhere else.
"""

# --- fixed values (must match the reference) --------------------------------

# Timestamp pattern of the raw posts (`date`, `user_created`).
TS_FORMAT = "dd-MM-yyyy HH:mm"

# Count columns cast to long.
COUNT_COLUMNS = ["user_followers", "user_friends", "user_favourites"]

# Boolean columns and the words they accept (after lower-casing, no trimming).
BOOL_COLUMNS = ["user_verified", "is_retweet"]
TRUE_WORDS = ["true", "t", "1", "yes", "y"]
FALSE_WORDS = ["false", "f", "0", "no", "n"]

# Text cleaning patterns, applied in this order: URLs, mentions, whitespace.
URL_PATTERN = r"https?://\S+|www\.\S+"
MENTION_PATTERN = r"@\w+"
WHITESPACE_PATTERN = r"\s+"

# Hashtag list cleanup: characters removed, then the split pattern.
HASHTAG_STRIP_PATTERN = r"[\[\]']"
HASHTAG_SPLIT_PATTERN = r"\s*,\s*"

# Dedup key candidates (used when at least two are present).
DEDUP_KEYS = ["user_name", "tweet_ts", "text_clean"]

# Output column order of the clean table.
CLEAN_COLUMNS = [
    "user_name",
    "user_location",
    "user_location_clean",
    "user_description",
    "user_created_ts",
    "user_followers",
    "user_friends",
    "user_favourites",
    "user_verified",
    "tweet_ts",
    "tweet_date",
    "text_raw",
    "text_clean",
    "hashtags",
    "hashtags_arr",
    "source",
    "is_retweet",
]

# Sentiment classes.
LABEL_TO_ID = {"negative": 0, "neutral": 1, "positive": 2}
ID_TO_LABEL = {0: "negative", 1: "neutral", 2: "positive"}

# Scored output columns.
SCORE_COLUMNS = [
    "sentiment",
    "sentiment_id",
    "confidence",
    "negative_prob",
    "neutral_prob",
    "positive_prob",
]

# Model and training parameters.
SCORE_BATCH_SIZE = 32
TRAIN_BATCH_SIZE = 4
TRAIN_EPOCHS = 3
MAX_TOKENS = 512
CONFIDENCE_THRESHOLD = 0.9
THRESHOLD_STEP = 0.02
THRESHOLD_CAP = 0.95
VALIDATION_FRACTION = 0.2
SEED = 42

# Self-training defaults: command line vs function.
CLI_ITERATIONS = 2
FN_ITERATIONS = 1

# Scored CSV default name: input with ".csv" replaced by this suffix.
SCORED_SUFFIX = "_roberta_sentiment.csv"

# Timestamped output key layout: prefix/yyyyMMddHHmmss/data.json
RUN_KEY_PREFIX = "covid_data"
RUN_KEY_FORMAT = "yyyyMMddHHmmss"
RUN_KEY_FILE = "data.json"

# Missing-value tokens of the pandas CSV reader (its documented defaults),
# applied to the scoring and training scans only.
PANDAS_NA_VALUES = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# -----------------------------------------------------------------------------

# Characters Python's str.strip() removes (str.isspace), as a regex class that
# Java and RE2 both read the same way. Used where the reference strips text in
# pandas rather than in Spark.
PY_SPACE_CLASS = (
    r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
