"""Declared schemas and fixed vocabularies of the data model."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_LONG, _INT, _TEXT, _DOUBLE = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()

RATING = _struct(("user_id", _LONG), ("item_id", _LONG), ("rating", _INT), ("ts", _LONG))
FLOAT_RATING = _struct(("user_id", _LONG), ("item_id", _LONG), ("rating", _DOUBLE), ("ts", _LONG))
USER = _struct(("user_id", _LONG), ("age", _INT), ("gender", _TEXT), ("occupation", _TEXT), ("zip_code", _TEXT))
ITEM_AVERAGE = _struct(("item_id", _LONG), ("title", _TEXT), ("avg_rating", _DOUBLE), ("rating_count", _LONG))
TOP_ITEM = _struct(*((f.name, f.dataType) for f in ITEM_AVERAGE), ("rank", _INT), ("partition_key", _INT))
FAVOURITE = _struct(("user_id", _LONG), ("favorite_genre", _TEXT), ("genre_rating_count", _LONG))
RECOMMENDATION = _struct(
    ("user_id", _LONG),
    ("rank", _INT),
    ("item_id", _LONG),
    ("title", _TEXT),
    ("avg_rating", _DOUBLE),
    ("fav_genre", _TEXT),
)
EXCLUSION_FLAT = _struct(
    ("user_id", _LONG),
    ("favorite_genre", _TEXT),
    ("avoid_rank", _INT),
    ("item_id", _LONG),
    ("title", _TEXT),
    ("global_avg_rating", _DOUBLE),
)
EXCLUSION_DOCUMENT = _struct(
    ("_id", _TEXT),
    ("user_id", _LONG),
    ("favorite_genre", _TEXT),
    (
        "blacklisted_movies",
        T.ArrayType(
            _struct(("avoid_rank", _INT), ("item_id", _LONG), ("title", _TEXT), ("global_avg_rating", _DOUBLE))
        ),
    ),
)

# Genre labels in the order of the item file's flag columns.
GENRES = (
    "unknown",
    "Action",
    "Adventure",
    "Animation",
    "Children's",
    "Comedy",
    "Crime",
    "Documentary",
    "Drama",
    "Fantasy",
    "Film-Noir",
    "Horror",
    "Musical",
    "Mystery",
    "Romance",
    "Sci-Fi",
    "Thriller",
    "War",
    "Western",
)

# Occupations that may occur in the user file.
OCCUPATIONS = (
    "administrator",
    "artist",
    "doctor",
    "educator",
    "engineer",
    "entertainment",
    "executive",
    "healthcare",
    "homemaker",
    "lawyer",
    "librarian",
    "marketing",
    "none",
    "other",
    "programmer",
    "retired",
    "salesman",
    "scientist",
    "student",
    "technician",
    "writer",
)

# Text columns before the flags in the item file.
ITEM_TEXT_COLUMNS = ("item_id", "title", "release_date", "video_release_date", "url")
