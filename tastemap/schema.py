"""Column names and declared schemas (never inferred)."""

from pyspark.sql import types as T

USER = "user_id"
ITEM = "item_id"
RATING = "rating"
TS = "ts"
SCORE = "score"
RANK = "rank"

# Ratings CSV as published (header userId,movieId,rating,timestamp).
RATINGS_CSV = T.StructType(
    [
        T.StructField("userId", T.IntegerType(), False),
        T.StructField("movieId", T.IntegerType(), False),
        T.StructField("rating", T.DoubleType(), True),
        T.StructField("timestamp", T.LongType(), True),
    ]
)

# Tag relevance CSV as published (header movieId,tagId,relevance).
TAGS_CSV = T.StructType(
    [
        T.StructField("movieId", T.IntegerType(), False),
        T.StructField("tagId", T.IntegerType(), False),
        T.StructField("relevance", T.DoubleType(), True),
    ]
)
