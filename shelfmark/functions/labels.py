"""Class labels: slugs, encoding, decoding, best-scored class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 22 product categories; a label id is the position in code point order.
CATEGORIES = (
    "All Electronics",
    "Amazon Fashion",
    "Amazon Home",
    "Arts, Crafts & Sewing",
    "Automotive",
    "Books",
    "Camera & Photo",
    "Cell Phones & Accessories",
    "Computers",
    "Digital Music",
    "Grocery",
    "Health & Personal Care",
    "Home Audio & Theater",
    "Industrial & Scientific",
    "Movies & TV",
    "Musical Instruments",
    "Office Products",
    "Pet Supplies",
    "Sports & Outdoors",
    "Tools & Home Improvement",
    "Toys & Games",
    "Video Games",
)


def class_array(classes: Sequence[str]) -> Column:
    """The distinct classes in code point order as one array literal."""
    return F.array(*[F.lit(c) for c in sorted(set(classes))])


def slug(name: Column) -> Column:
    """Category name as an identifier: ``Arts, Crafts & Sewing`` → ``Arts_Crafts_and_Sewing``."""
    for old, new in (("&", "and"), (", ", "_"), (" ", "_")):
        name = F.replace(name, F.lit(old), F.lit(new))
    return name


def encode(label: Column, classes: Sequence[str], on_unseen: str = "error") -> Column:
    """Position of a label among the sorted classes.

    A label outside the classes, null included, fails the query or, with
    ``on_unseen="null"``, gives null.
    """
    position = F.array_position(class_array(classes), label)
    if on_unseen == "null":
        unseen = F.lit(None).cast("int")
    elif on_unseen == "error":
        shown = F.coalesce(label, F.lit("null"))
        unseen = F.raise_error(F.concat(F.lit("Unseen label: "), shown)).cast("int")
    else:
        raise ValueError("on_unseen must be 'error' or 'null'")
    return F.when(position > 0, (position - 1).cast("int")).otherwise(unseen)


def decode(label_id: Column, classes: Sequence[str]) -> Column:
    """Class name of a label id; null for an id outside the classes."""
    return F.get(class_array(classes), label_id.cast("int"))


def argmax(scores: Column) -> Column:
    """Index of the highest score, the first on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
