"""Parameters and fixed values shared by the operators.

Everything an operator can be tuned with lives here as a frozen dataclass;
everything that has to stay as it is for results to agree with the reference
data is a constant under a "fixed values" heading.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: placeholders read as missing (compared trimmed, upper case)
NULL_LITERALS = ("NULL", "NAN", "NONE", "N/A", "NA", "")

# --- fixed values: known platforms and campaign window of the quality checks
PLATFORMS = ("Facebook", "Instagram", "Reddit", "Twitter", "YouTube")
WINDOW_START = "2024-05-01 00:00:00"
WINDOW_END = "2025-04-30 23:59:59"

# --- fixed values: sentiment cue phrases, case-sensitive substrings
POSITIVE_PHRASES = (
    "Absolutely loving it", "Highly recommend", "Exceeded my expectations",
    "Best purchase ever", "Thrilled", "Delighted", "So happy", "Super excited",
    "Can't contain my excitement", "Loving it",
)
NEGATIVE_PHRASES = (
    "Disappointed with the quality", "Bummed out", "Frustrated", "Fed up",
    "Feeling let down", "Sad to", "Terrible",
)

# --- fixed values: words that mark a negation or a sarcastic tone
NEGATION_WORDS = (
    "not", "no", "never", "can't", "cannot", "won't", "isn't", "aren't",
    "wasn't", "weren't", "don't", "doesn't", "didn't", "nobody", "nothing",
    "neither", "nor", "hardly", "barely", "scarcely",
)
SARCASM_WORDS = (
    "yeah right", "sure", "totally", "obviously", "clearly", "great job",
    "well done", "nice one", "as if", "whatever",
)
SARCASM_MARKS = (r":-\)", r";\)", ":P", r"\blol\b", r"\blmao\b")

# Keyword patterns of the product filter, matched as whole words in any case. "iphone" alone covers every
# phrase that starts with it; the compounds without a blank need patterns of their own.
PRODUCT_KEYWORDS = (
    "iphone", "iphone1[678]", "iphoneduo", "appleiphone", r"ios\s*2[67]", "alarmkit",
    r"apple\s+(?:launch|event|announcement|silicon)", "a19", "a20",
)
PRODUCT_QUERIES = ("apple iphone", "iphone")
GENERIC_QUERY = "technology"

# --- fixed values: entity names; a name matches as whole words in any case with
#     optional white space between its words unless listed as an exception
ENTITY_NAMES = (
    "Apple", "Samsung", "Google", "Xiaomi", "Microsoft", "Qualcomm", "TSMC",
    "Amazon", "Meta",
    "iPhone 17", "iPhone 18", "iPhone Duo", "iPhone Pro", "iPhone Pro Max",
    "iPad", "MacBook", "Apple Watch", "AirPods", "Vision Pro", "Apple Pencil",
    "iOS 26", "iOS 27", "iOS", "Android", "App Store", "Bluesky",
    "A19", "A18", "M6", "M5",
    "Tim Cook", "Craig Federighi", "Mark Gurman",
)
ENTITY_EXCEPTIONS = {
    "Meta": r"(?i)\bMeta\b(?!\s+Quest)",
    "M6": r"\bM6\b",
    "M5": r"\bM5\b",
    "Craig Federighi": r"(?i)\bFederighi\b",
    "Mark Gurman": r"(?i)\bGurman\b",
}

# --- fixed values: label codes
SENTIMENT_LABELS = {"Negative": 0, "Neutral": 1, "Positive": 2}
TOPIC_LABELS = {
    "Account_Security": 0, "Community_Discussion": 1,
    "Feature_Feedback": 2, "Technical_Issues": 3,
}
LABEL_CODES = {"sentiment_label": SENTIMENT_LABELS, "topic_category": TOPIC_LABELS}
SENTIMENTS = tuple(SENTIMENT_LABELS)
FALLBACK_SENTIMENT = "Neutral"

# --- fixed values: low-content tokens of short social texts, added to Spark's English stop words
SOCIAL_STOP_WORDS = (
    "@user", "<url>", "user", "url", "just", "like", "know", "think", "time",
    "going", "said", "say", "re", "ve", "ll", "don", "didn", "won", "isn",
    "wasn", "co", "http", "https", "rt",
)


@dataclass(frozen=True)
class EventParams:
    """Thresholds of event detection on a bucketed timeline."""

    shift_pp: float = 15.0
    shift_floor_pp: float = 10.0
    spike_std: float = 2.0
    spike_floor_std: float = 1.0
    min_bucket_posts: int = 1
    bucket_label: str = "1 hour"


@dataclass(frozen=True)
class TopicParams:
    """Topic and entity extraction per event bucket."""

    top_terms: int = 5
    max_terms: int = 150
    min_text_chars: int = 11
    top_entities: int = 10
    min_entity_posts: int = 1


@dataclass(frozen=True)
class TriggerParams:
    """Search window around an event and what makes an article relevant."""

    hours_before: int = 24
    hours_after: int = 6
    product: str = "Apple iPhone"
    required_words: tuple[str, ...] = ("iphone", "apple")


@dataclass(frozen=True)
class TfidfParams:
    """Vectoriser settings; `ngrams` counts words, or characters in words."""

    analyzer: str = "word"
    ngrams: tuple[int, int] = (1, 2)
    min_df: int = 2
    max_terms: int = 50_000
    sublinear: bool = True


WORD_TFIDF = TfidfParams()
CHAR_TFIDF = TfidfParams(analyzer="char", ngrams=(3, 5))


@dataclass(frozen=True)
class SplitParams:
    """Group-aware stratified split."""

    seed: int = 42
    val_share: float = 0.15
    test_share: float = 0.15
