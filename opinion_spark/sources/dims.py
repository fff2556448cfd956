"""Inline dimension tables (D17) as small broadcastable DataFrames.

The lists below are fixed values: they must equal the values the analysis was
designed around, quirks included (Q1, Q2: adjacent string literals concatenate,
so ``"Donald" "Donald Trump"`` is one pattern and ``"abc" "abcnews"`` one stop
word). Every table here has a size known on the driver, which is the bound
that makes broadcasting them safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the 51 regions (50 states + DC), in the analysis' order ---
US_STATES = [
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut",
    "Delaware", "District of Columbia", "Florida", "Georgia", "Hawaii", "Idaho", "Illinois",
    "Indiana", "Iowa", "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts",
    "Michigan", "Minnesota", "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada",
    "New Hampshire", "New Jersey", "New Mexico", "New York", "North Carolina", "North Dakota",
    "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island", "South Carolina",
    "South Dakota", "Tennessee", "Texas", "Utah", "Vermont", "Virginia", "Washington",
    "West Virginia", "Wisconsin", "Wyoming",
]

# --- fixed values: postal codes, state -> code ---
STATE_CODES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA",
    "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "Florida": "FL", "Georgia": "GA",
    "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA",
    "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD",
    "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS",
    "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH",
    "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY", "North Carolina": "NC",
    "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA",
    "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN",
    "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA", "Washington": "WA",
    "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY", "District of Columbia": "DC",
}

# --- fixed values: map centres (lat, lon) per code; DC has none (Q18) ---
STATE_CENTERS = {
    "AL": (32.806671, -86.791130), "AK": (61.370716, -152.404419), "AZ": (33.4484, -112.0740),
    "AR": (34.969704, -92.373123), "CA": (36.116203, -119.681564), "CO": (39.059811, -105.311104),
    "CT": (41.597782, -72.755371), "DE": (39.318523, -75.507141), "FL": (27.766279, -81.686783),
    "GA": (33.040619, -83.643074), "HI": (21.094318, -157.498337), "ID": (44.240459, -114.478828),
    "IL": (40.349457, -88.986137), "IN": (39.849426, -86.258278), "IA": (42.011539, -93.210526),
    "KS": (38.526600, -96.726486), "KY": (37.668140, -84.670067), "LA": (31.169546, -91.867805),
    "ME": (44.693947, -69.381927), "MD": (39.063946, -76.802101), "MA": (42.230171, -71.530106),
    "MI": (43.326618, -84.536095), "MN": (45.694454, -93.900192), "MS": (32.741646, -89.678696),
    "MO": (38.456085, -92.288368), "MT": (46.921925, -110.454353), "NE": (41.125370, -98.268082),
    "NV": (38.313515, -117.055374), "NH": (43.452492, -71.563896), "NJ": (40.298904, -74.521011),
    "NM": (34.840515, -106.248482), "NY": (42.165726, -74.948051), "NC": (35.630066, -79.806419),
    "ND": (47.528912, -99.784012), "OH": (40.388783, -82.764915), "OK": (35.565342, -96.928917),
    "OR": (44.572021, -122.070938), "PA": (40.590752, -77.209755), "RI": (41.680893, -71.511780),
    "SC": (33.856892, -80.945007), "SD": (44.299782, -99.438828), "TN": (35.747845, -86.692345),
    "TX": (31.054487, -97.563461), "UT": (40.150032, -111.862434), "VT": (44.045876, -72.710686),
    "VA": (37.769337, -78.169968), "WA": (47.400902, -121.490494), "WV": (38.491226, -80.954456),
    "WI": (44.268543, -89.616508), "WY": (42.755966, -107.302490),
}

# --- fixed values: mention name lists, as the source literals evaluate (Q1) ---
MENTION_NAMES = {
    "trump": [
        "Trump", "Donald" "Donald Trump", "@realDonaldTrump", "The Donald", "45",
        "Donald J. Trump", "DJT", "The Trump Administration", "Trumpster", "POTUS", "@POTUS",
        "Republican", "Republicans", "GOP", "MAGA", "Right Wing", "the Right",
    ],
    "biden": [
        "Biden", "Joe Biden", "@JoeBiden", "The Biden", "46", "Joseph R. Biden", "JRB",
        "The Biden Administration", "Bidenster", "Joe", "Joseph", "Joseph Biden", "Sleepy Joe",
        "Uncle Joe", "Dems", "Democrat", "Democrats", "Left Wing", "The Left",
    ],
}

# --- fixed values: domain stop words added to the English list (Q2 kept) ---
POLITICAL_STOP_WORDS = [
    "trump", "biden", "donald", "joe", "potus", "2020", "trumps", "realdonaldtrump", "harris",
    "save", "yep", "yes", "nope", "no", "fa", "oh", "nytimes", "wow", "tells", "omg", "wait",
    "look", "abc" "abcnews", "cnn", "fox", "foxnews", "msnbc", "nbc", "nbcnews", "cbs",
    "cbsnews", "news", "joebiden", "did", "won", "wins", "19", "kamala", "wouldn", "rawstory",
]

# --- fixed values: activity weights (share of prolific users per side) ---
ACTIVITY_WEIGHTS = (0.31, 0.69)


def english_stop_words() -> list[str]:
    """The English stop-word list of Spark ML (a public parameter; needs a running session)."""
    from pyspark.ml.feature import StopWordsRemover

    return list(StopWordsRemover.loadDefaultStopWords("english"))


def topic_stop_words() -> list[str]:
    """English list plus the domain words, lower-case, de-duplicated, sorted."""
    return sorted({w.lower() for w in english_stop_words() + POLITICAL_STOP_WORDS})


def us_states_df(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(s,) for s in US_STATES], "state string"))


def state_codes_df(spark: SparkSession) -> DataFrame:
    rows = [(s, c) for s, c in STATE_CODES.items()]
    return F.broadcast(spark.createDataFrame(rows, "state string, state_code string"))


def state_centers_df(spark: SparkSession) -> DataFrame:
    rows = [(c, lat, lon) for c, (lat, lon) in STATE_CENTERS.items()]
    return F.broadcast(spark.createDataFrame(rows, "state_code string, lat double, lon double"))


def mention_names_df(spark: SparkSession) -> DataFrame:
    rows = [(label, p) for label, names in MENTION_NAMES.items() for p in names]
    return spark.createDataFrame(rows, "label string, pattern string")


def stop_words_df(spark: SparkSession, words: list[str] | None = None) -> DataFrame:
    words = topic_stop_words() if words is None else sorted(set(words))
    return F.broadcast(spark.createDataFrame([(w,) for w in words], "word string"))
