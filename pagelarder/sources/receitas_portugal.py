"""receitas_portugal: several page layouts, tried in a fixed order; listings are JSON keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelarder.functions.lists import first, first_non_empty
from pagelarder.functions.phrase import UNITS, ingredient_name
from pagelarder.functions.text import normalize_space, strip
from pagelarder.operators import links
from pagelarder.operators.select import Selection
from pagelarder.sources.spec import JSON, Links, SourceSpec, register_source

# Fixed values of the site. The listing is a form request; the stored page carries the form
# fields that tell requests apart in its query string.
LISTING = "http://www.receitasdeportugal.com/?infinity=scrolling&page=%s"
VEGAN = "Vegetariano"

# Class of the container and the child steps below it, in order of preference.
INGREDIENT_LAYOUTS = (
    ("ingredient-item-name", ()),
    ("ingredient", ()),
    ("shortcode-ingredients", ("ul", "li")),
    ("ingredients-list", ("li",)),
)
STEP_LAYOUTS = (
    ("direction-step", ()),
    ("text_exposed_show", ()),
    ("instruction", ()),
    ("instructions", ("li",)),
    ("directions-list", ("li",)),
)


def _first_layout(page: Selection, layouts: tuple) -> Column:
    """String values of the first layout that selects anything, null when none does."""

    def select(cls: str, steps: tuple[str, ...]) -> Selection:
        found = page.xclass(cls)
        for tag in steps:
            found = found.child(tag)
        return found

    at = first_non_empty(*[select(cls, steps).at for cls, steps in layouts])
    return page.pick(at).strings()


def _parts(page: Selection) -> dict[str, Column]:
    phrases = _first_layout(page, INGREDIENT_LAYOUTS)
    return {
        "name": first(page.xclass("entry-title fn").text()),
        "dish_type": first(page.xclass("entry-category").child("a", nth=1).text()),
        "phrases": F.transform(phrases, lambda t: strip(normalize_space(t))),
        "steps": F.transform(_first_layout(page, STEP_LAYOUTS), normalize_space),
    }


def _fields(p: Column) -> dict[str, Column]:
    units = UNITS["receitas_portugal"]
    return {
        "name": p["name"],
        "vegan": F.coalesce(p["dish_type"] == VEGAN, F.lit(False)),
        "dish_type": p["dish_type"],
        **{
            n: F.lit("")
            for n in ("cuisine", "difficulty", "time", "servings", "cost", "calories")
        },
        "ingredients": F.transform(p["phrases"], lambda t: ingredient_name(t, units)),
        "quantities": p["phrases"],
        "steps": p["steps"],
    }


def _lost_if(p: Column) -> list[tuple[str, Column]]:
    return [
        ("no ingredient layout matches", p["phrases"].isNull()),
        ("no step layout matches", p["steps"].isNull()),
    ]


SPEC = register_source(
    SourceSpec(
        name="receitas_portugal",
        parts=_parts,
        fields=_fields,
        lost_if=_lost_if,
        links=Links(JSON, lambda page, body, url: links.json_keys(body)),
        listings=(LISTING,),
        sequential=True,
    )
)
