"""The film table: column names and the parameters of the score fit."""

from __future__ import annotations

from pyspark.sql import types as T

ROW_KEY = "row_key"
QUALIFIER = "qualifier"
VALUE = "value"
VERSION = "version"
BUCKET = "bucket"

# Column names in file order, after the row key.
MOVIE_COLUMNS = [
    "budget",
    "genres",
    "homepage",
    "id",
    "keywords",
    "original_language",
    "original_title",
    "overview",
    "popularity",
    "production_companies",
    "production_countries",
    "release_date",
    "revenue",
    "runtime",
    "spoken_languages",
    "status",
    "tagline",
    "title",
    "vote_average",
    "vote_count",
]

# Regression inputs, label and settings.
SCORE_FEATURES = ["budget", "popularity", "revenue", "runtime", "vote_count"]
SCORE_LABEL = "vote_average"
MAX_ITERATIONS = 20
REGULARIZATION = 0.5
ELASTIC_NET_MIX = 0.5

# Report sizes and thresholds.
TOP_TITLES = 10
MIN_GROUP_SIZE = 100
POPULARITY_SLOTS = 10
RUNTIME_SLOTS = 16
TOP_KEYWORDS = 100
PREVIEW_ROWS = 20
CELL_FAMILY = "info"

# The demonstration chart rows.
DEMO_ROWS = [("羊毛衫", 20), ("雪纺衫", 36), ("裤子", 10), ("高跟鞋", 10), ("袜子", 20)]

MOVIE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in [ROW_KEY, *MOVIE_COLUMNS]]
)
