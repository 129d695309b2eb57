"""Free-text ingredient phrases -> ingredient names and quantity texts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelarder.functions.lists import let
from pagelarder.functions.text import concat_missing_as_empty, delete, single_spaced, strip, words

# Unit words that are skipped, per source.
UNITS = {
    "sabor_intenso": ("kg", "mg", "l", "ml", "g", "colheres", "colher"),
    "vaqueiro": ("kg", "mg", "dl", "l", "ml", "g", "colheres", "colher"),
    "receitas_portugal": ("kg", "mg", "dl", "l", "ml", "g", "gr", "grs", "colheres", "colher"),
}

# Fixed value: the "to taste" mark.
TO_TASTE = "q.b."


def ingredient_name(phrase: Column, units: tuple[str, ...]) -> Column:
    """Name of the ingredient in a phrase such as "2 colheres de sopa de açúcar".

    With a "to taste" word the first such word is removed and nothing else. Otherwise
    leading amounts and units go (a word that starts with a digit or with ".digit", or
    equals a unit in any case), then one leading "de", "d" or "e".

    The words are joined by single spaces first, so one anchored pattern finds the name. Its
    unit loop is possessive: that keeps it linear and free of recursion on long lines.
    """
    unit = "|".join(re.escape(u) for u in units)
    name_in = rf"(?s)^(?:(?iu:[.]?[0-9][^ ]*|{unit})(?: |$))*+(?:(?:de|d|e)(?: |$))?(.*)$"

    def name(w: Column) -> Column:
        mark = F.array_position(w, TO_TASTE).cast("int")
        return F.when(
            mark > 0,
            F.array_join(
                F.concat(F.slice(w, F.lit(1), mark - 1), F.slice(w, mark + 1, F.size(w))), " "
            ),
        ).otherwise(F.regexp_extract(F.array_join(w, " "), name_in, 1))

    return let(words(phrase), name)


def name_field(text: Column) -> Column:
    """Name from a field that holds only the name: drop "q.b." and a leading "de"."""
    plain = strip(delete(text, TO_TASTE))
    return F.when(
        plain.startswith("de ") | (plain == "de"), single_spaced(strip(F.substr(plain, F.lit(3))))
    ).otherwise(plain)


def quantity_with_unit(quantity: Column, unit: Column, product: Column) -> Column:
    """"quantity unit product"; without a unit "quantity product"; null if a needed part is."""
    amount = F.when(unit.isNull(), quantity).otherwise(F.concat(quantity, F.lit(" "), unit))
    return F.concat(amount, F.lit(" "), product)


def quantity_of(quantity: Column, name: Column) -> Column:
    """"quantity de name"."""
    return F.concat(quantity, F.lit(" de "), name)


def quantity_fields(amount: Column, unit: Column, name: Column) -> Column:
    """"amount unit name" from separate fields, missing ones blank, outer white space removed."""
    gap = F.lit(" ")
    return single_spaced(strip(concat_missing_as_empty(amount, gap, unit, gap, name)))
