"""Declared schemas for every layer, plus the fixed value lists.

Schemas are declared, never inferred on the production path: inference on
JSON costs a full extra pass over the input.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


S, D, I, L = StringType(), DoubleType(), IntegerType(), LongType()

# --- Google places -----------------------------------------------------------
GOOGLE_PLACES_RAW = _s(
    ("address", S, True), ("avg_rating", D, True), ("category", ArrayType(S), True),
    ("gmap_id", S, True), ("latitude", D, True), ("longitude", D, True),
    ("name", S, True), ("num_of_reviews", L, True), ("url", S, True),
)
# Column order of the silver/gold places table = the warehouse load ordinals.
GOOGLE_PLACES_SILVER_COLUMNS = [
    "address", "avg_rating", "gmap_id", "latitude", "longitude", "name",
    "num_of_reviews", "url", "category", "state",
]

# --- Google reviews ----------------------------------------------------------
GOOGLE_REVIEWS_RAW = _s(
    ("user_id", S, True), ("gmap_id", S, True), ("rating", D, True),
    ("text", S, True), ("time", L, True),
)
GOOGLE_REVIEWS_GOLD = _s(
    ("user_id", S, True), ("gmap_id", S, True), ("rating", I, True),
    ("text", S, True), ("date", DateType(), True), ("review_id", S, True),
)

# --- Yelp business -----------------------------------------------------------
YELP_BUSINESS_COLUMNS = [
    "business_id", "name", "address", "state", "latitude", "longitude",
    "stars", "review_count", "attributes", "categories",
]

# --- Yelp reviews ------------------------------------------------------------
YELP_REVIEWS_RAW = _s(
    ("review_id", S, True), ("user_id", S, True), ("business_id", S, True),
    ("stars", D, True), ("text", S, True), ("date", S, True),
)

# --- Sentiment ---------------------------------------------------------------
SENTIMENT = _s(("review_id", S, False), ("sentiment_score", D, False), ("sentiment", S, False))
LEXICON = _s(("token", S, False), ("valence", D, False))

# --- Dimension and ledger ----------------------------------------------------
STATE_DIM = _s(("state_id", I, False), ("state", S, False), ("name", S, False))
LEDGER = _s(("dataset", S, False), ("file_name", S, False))

# --- Warehouse contracts: (column, spark type, not null, max length) --------
# Types and NOT NULL flags are the warehouse table definitions; lengths are
# the NVARCHAR sizes.
CONTRACTS = {
    "business_google": [
        ("gmap_id", "string", True, 1000), ("address", "string", False, 4000),
        ("name", "string", False, 4000), ("latitude", "double", True, None),
        ("longitude", "double", True, None), ("category", "string", True, 4000),
        ("review_count", "int", False, None), ("avg_rating", "double", False, None),
        ("url", "string", False, 4000), ("state", "string", True, 10),
    ],
    "reviews_google": [
        ("user_id", "string", True, 1000), ("review_id", "string", True, 4000),
        ("rating", "int", True, None), ("gmap_id", "string", True, 1000),
        ("date", "date", True, None),
    ],
    "business_yelp": [
        ("business_id", "string", True, 1000), ("name", "string", False, 4000),
        ("address", "string", False, 4000), ("latitude", "double", True, None),
        ("longitude", "double", True, None), ("state", "string", True, 10),
        ("category", "string", True, 4000), ("avg_rating", "double", False, None),
        ("review_count", "int", False, None), ("attributes", "string", False, 4000),
    ],
    "reviews_yelp": [
        ("user_id", "string", True, 1000), ("review_id", "string", True, 1000),
        ("business_id", "string", True, 1000), ("rating", "int", False, None),
        ("date", "date", True, None),
    ],
    "sentiment": [
        ("review_id", "string", True, 4000), ("sentiment_score", "double", True, None),
        ("sentiment", "string", True, 4000),
    ],
}
PRIMARY_KEYS = {
    "business_google": ["gmap_id"], "reviews_google": ["review_id"],
    "business_yelp": ["business_id"], "reviews_yelp": ["review_id"],
    "sentiment": ["review_id"], "state": ["state"],
}

# Warehouse bulk loads: target column -> 1-based source ordinal.
LOAD_ORDINALS = {
    "business_google": [("gmap_id", 3), ("address", 1), ("name", 6), ("latitude", 4),
                        ("longitude", 5), ("category", 9), ("review_count", 7),
                        ("avg_rating", 2), ("url", 8), ("state", 10)],
    "business_yelp": [("business_id", 1), ("name", 2), ("address", 3), ("latitude", 5),
                      ("longitude", 6), ("state", 4), ("category", 9), ("avg_rating", 7),
                      ("review_count", 8), ("attributes", 10)],
    "reviews_google": [("user_id", 1), ("review_id", 6), ("rating", 3), ("gmap_id", 2), ("date", 5)],
    "reviews_yelp": [("user_id", 2), ("review_id", 1), ("business_id", 3), ("rating", 4), ("date", 6)],
    "sentiment": [("review_id", 1), ("sentiment_score", 2), ("sentiment", 3)],
}

# =============================================================================
# FIXED VALUES - these must equal the reference's values for equal results.
# =============================================================================

# US states, (name, code), in the reference's order. The order matters for the
# state regex: at one text position the first alternative wins.
US_STATES = [
    ("Alabama", "AL"), ("Alaska", "AK"), ("Arizona", "AZ"), ("Arkansas", "AR"),
    ("California", "CA"), ("Colorado", "CO"), ("Connecticut", "CT"), ("Delaware", "DE"),
    ("Florida", "FL"), ("Georgia", "GA"), ("Hawaii", "HI"), ("Idaho", "ID"),
    ("Illinois", "IL"), ("Indiana", "IN"), ("Iowa", "IA"), ("Kansas", "KS"),
    ("Kentucky", "KY"), ("Louisiana", "LA"), ("Maine", "ME"), ("Maryland", "MD"),
    ("Massachusetts", "MA"), ("Michigan", "MI"), ("Minnesota", "MN"), ("Mississippi", "MS"),
    ("Missouri", "MO"), ("Montana", "MT"), ("Nebraska", "NE"), ("Nevada", "NV"),
    ("New Hampshire", "NH"), ("New Jersey", "NJ"), ("New Mexico", "NM"), ("New York", "NY"),
    ("North Carolina", "NC"), ("North Dakota", "ND"), ("Ohio", "OH"), ("Oklahoma", "OK"),
    ("Oregon", "OR"), ("Pennsylvania", "PA"), ("Rhode Island", "RI"), ("South Carolina", "SC"),
    ("South Dakota", "SD"), ("Tennessee", "TN"), ("Texas", "TX"), ("Utah", "UT"),
    ("Vermont", "VT"), ("Virginia", "VA"), ("Washington", "WA"), ("West Virginia", "WV"),
    ("Wisconsin", "WI"), ("Wyoming", "WY"),
]

# Category terms kept by the places filter (Google places list). The
# reference's list lost four commas, fusing terms; here they are separate
# (decision D1). Terms are lower-cased by the filter (decision D2).
GOOGLE_CATEGORY_TERMS = [
    "burger", "burgers", "hamburger", "hamburgers", "hot dog", "steakhouse", "lunch",
    "motel", "patisserie", "pizza", "deli", "diner", "dinner", "icecream", "ice cream",
    "hotel", "hotels", "seafood", "cookie", "crab house", "cupcake", "chocolate",
    "churreria", "cocktail", "cocktails", "coffee", "coffees", "tea", "restaurant",
    "restaurats", "chesse", "charcuterie", "cafe", "cafes", "BBQ", "bagle", "bakery",
    "bakerys", "bar", "bars", "bar & grill", "barbacue", "beer", "bistro", "pasteleria",
    "pastelerias", "breakfast", "brunch", "buffet", "burrito", "cafeteria", "cafeterias",
    "cake", "cakes", "food", "wine", "wineries", "lunch",
]
# Yelp business list: the same terms without the last three.
YELP_CATEGORY_TERMS = GOOGLE_CATEGORY_TERMS[:-3]

# Sentiment label bands on the compound score.
POSITIVE_FROM = 0.3
NEGATIVE_TO = -0.3
# Compound normalisation constant of the published lexicon scorer:
# compound = s / sqrt(s*s + ALPHA).
VADER_ALPHA = 15.0
# Rule constants of the published scorer: negation scalar, booster increment
# and the damping of a booster two and three tokens back.
NEGATION_SCALAR = -0.74
BOOSTER_INCREMENT = 0.293
BOOSTER_DAMPING = {1: 1.0, 2: 0.95, 3: 0.9}
# Emphasis of a word in capitals within a text of mixed case.
CAPITALS_INCREMENT = 0.733
# Single-word negators and boosters of the published scorer.
NEGATORS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "ain't", "aren't", "can't",
    "couldn't", "daren't", "didn't", "doesn't", "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt",
    "neither", "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't", "neednt", "needn't", "never",
    "none", "nope", "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
    "oughtn't", "shan't", "shouldn't", "wasn't", "weren't", "without", "wont", "wouldnt", "won't", "wouldn't",
    "rarely", "seldom", "despite",
]
BOOSTERS_UP = [
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably", "decidedly", "deeply",
    "enormous", "enormously", "entirely", "especially", "exceptional", "exceptionally", "extreme", "extremely",
    "fabulously", "fully", "greatly", "highly", "hugely", "incredible", "incredibly", "intensely", "major", "majorly",
    "more", "most", "particularly", "purely", "quite", "really", "remarkably", "so", "substantially", "thoroughly",
    "total", "totally", "tremendous", "tremendously", "uber", "unbelievably", "unusually", "utter", "utterly", "very",
]
BOOSTERS_DOWN = [
    "almost", "barely", "hardly", "kinda", "kindof", "less", "little", "marginal", "marginally", "occasional",
    "occasionally", "partly", "scarce", "scarcely", "slight", "slightly", "somewhat", "sorta", "sortof",
]
# Boosters of two words, and phrases with a valence of their own, of the published scorer.
BOOSTERS_DOWN_PHRASES = ["just enough", "kind of", "sort of"]
IDIOMS = [
    ("the shit", 3.0), ("the bomb", 3.0), ("bad ass", 1.5), ("yeah right", -2.0), ("cut the mustard", 2.0),
    ("kiss of death", -1.5), ("hand to mouth", -2.0),
]
# "never so" and "never this" strengthen, by the distance of "never"; "least"
# negates the next word, unless it follows one of two words.
NEVER_SO_WORDS = ["so", "this"]
NEVER_SO_FACTOR = {2: 1.5, 3: 1.25}
LEAST_EXCEPT_AFTER = ["at", "very"]
# Contrast rule: valences before the first contrast word are halved, those
# after it are multiplied by 1.5.
CONTRAST_BEFORE = 0.5
CONTRAST_AFTER = 1.5
# Punctuation emphasis added to a non-zero sum (away from zero): 0.292 per
# '!' up to 4 of them; for 2 or 3 '?' 0.18 each, for more than 3 '?' 0.96.
EXCLAMATION_STEP = 0.292
EXCLAMATION_MAX = 4
QUESTION_STEP = 0.18
QUESTION_MAX_COUNT = 3
QUESTION_CAP = 0.96

# Maximum review text length kept in gold.
GOLD_TEXT_MAX = 7000
