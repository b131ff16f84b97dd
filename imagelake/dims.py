"""Dimension tables: class dictionary and price catalogues.

Both are tiny and bounded by the number of classes (15), so joins against them
are broadcast; no dimension grows with the data.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# --- fixed values (must equal the reference's) -------------------------------
# Class names in class-id order (alphabetical; the spelling "jalepeno" is kept
# as the reference writes it in its app and notebook).
CLASS_NAMES = [
    "apple", "banana", "bell pepper", "chilli pepper", "grapes",
    "jalepeno", "kiwi", "lemon", "mango", "orange",
    "paprika", "pear", "pineapple", "pomegranate", "watermelon",
]

# Price per kilo, catalogue "app" (upload application).
PRICES_APP = {
    "apple": "S/. 6.50", "banana": "S/. 2.80", "bell pepper": "S/. 4.50",
    "chilli pepper": "S/. 8.00", "grapes": "S/. 9.50", "jalepeno": "S/. 7.50",
    "kiwi": "S/. 12.00", "lemon": "S/. 3.50", "mango": "S/. 5.50",
    "orange": "S/. 4.00", "paprika": "S/. 5.00", "pear": "S/. 7.00",
    "pineapple": "S/. 6.00", "pomegranate": "S/. 15.00", "watermelon": "S/. 2.50",
}

# Price per kilo, catalogue "webcam" (camera applications).
PRICES_WEBCAM = {
    "apple": "S/. 6.50", "banana": "S/. 2.80", "bell pepper": "S/. 4.50",
    "chilli pepper": "S/. 8.00", "grapes": "S/. 7.50", "jalapeno": "S/. 5.00",
    "kiwi": "S/. 12.00", "lemon": "S/. 3.50", "mango": "S/. 4.80",
    "orange": "S/. 3.20", "paprika": "S/. 6.00", "pear": "S/. 5.50",
    "pineapple": "S/. 4.00", "pomegranate": "S/. 8.50", "watermelon": "S/. 1.50",
}

# Text shown when a name has no price, per catalogue.
PRICE_DEFAULTS = {"app": "Precio no disponible", "webcam": "N/A"}

# ImageNet channel statistics (RGB) used by standardisation.
IMAGENET_MEAN = [0.485, 0.456, 0.406]
IMAGENET_STD = [0.229, 0.224, 0.225]
# -----------------------------------------------------------------------------

def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, Decimal):
        return f"CAST('{v}' AS DECIMAL(6,2))"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return f"CAST({int(v)} AS INT)"


def local_table(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A small literal table as SQL ``VALUES``: a JVM-side local relation (no Python
    worker, folded into the plan, broadcast when joined)."""
    body = ", ".join("(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def class_dim(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """``class_dim(class_id INT, name STRING)``; ids follow list order."""
    names = CLASS_NAMES if names is None else names
    return local_table(spark, list(enumerate(names)), ["class_id", "name"])


def price_dim(spark: SparkSession) -> DataFrame:
    """``price_dim(catalog, name, price_text, price DECIMAL(6,2))``, both catalogues."""
    rows = []
    for catalog, prices in (("app", PRICES_APP), ("webcam", PRICES_WEBCAM)):
        for name, text in prices.items():
            rows.append((catalog, name, text, Decimal(text.split(" ")[-1])))
    return local_table(spark, rows, ["catalog", "name", "price_text", "price"])
