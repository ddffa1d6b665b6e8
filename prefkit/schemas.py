"""Input schemas and default column names.

Ids are BIGINT throughout (text ids such as "01" vs "1" are not distinguished, see README rule D2);
ratings are DOUBLE so half-star sums are exact and independent of evaluation order (rule D1).
"""

from pyspark.sql import types as T

USER = "user_id"
ITEM = "item_id"
RATING = "rating"
TS = "ts"
TITLE = "title"
GENRES = "genres"
GENRE = "genre"

RATINGS = T.StructType(
    [
        T.StructField(USER, T.LongType()),
        T.StructField(ITEM, T.LongType()),
        T.StructField(RATING, T.DoubleType()),
        T.StructField(TS, T.LongType()),
    ]
)

ITEMS = T.StructType(
    [
        T.StructField(ITEM, T.LongType()),
        T.StructField(TITLE, T.StringType()),
        T.StructField(GENRES, T.StringType()),
    ]
)

RATINGS_DDL = "user_id BIGINT, item_id BIGINT, rating DOUBLE, ts BIGINT"
ITEMS_DDL = "item_id BIGINT, title STRING, genres STRING"
