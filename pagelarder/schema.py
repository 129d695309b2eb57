"""The conformed record, its feed keys, and the input tables."""

from __future__ import annotations

from pyspark.sql import types as T

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

_TEXTS = T.ArrayType(T.StringType())

# Column -> type of the part of a record that is read from a page.
FIELDS = {
    "name": T.StringType(),
    "vegan": T.BooleanType(),
    "cuisine": T.StringType(),
    "dish_type": T.StringType(),
    "difficulty": T.StringType(),
    "time": T.StringType(),
    "servings": T.StringType(),
    "cost": T.StringType(),
    "calories": T.StringType(),
    "ingredients": _TEXTS,
    "quantities": _TEXTS,
    "steps": _TEXTS,
}
LISTS = [name for name, kind in FIELDS.items() if kind == _TEXTS]

# The keys of a record in the JSON feed.
FEED_KEYS = {
    "name": "name",
    "url": "url",
    "vegan": "vegan",
    "cuisine": "gastronomia",
    "dish_type": "tipo",
    "difficulty": "dificuldade",
    "time": "tempo",
    "servings": "porção",
    "cost": "custo",
    "calories": "calorias",
    "ingredients": "ingredients",
    "quantities": "quantidade",
    "steps": "preparação",
}

RECIPES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("url", T.StringType()),
        *[T.StructField(name, kind) for name, kind in FIELDS.items()],
        T.StructField("absent_keys", _TEXTS),
    ]
)

# A record in the JSON feed: lists are objects with the keys "0", "1", ...
FEED_RECORD = T.StructType(
    [
        T.StructField(
            FEED_KEYS[f.name],
            T.MapType(T.StringType(), T.StringType()) if f.name in LISTS else f.dataType,
        )
        for f in RECIPES
        if f.name in FEED_KEYS
    ]
)
