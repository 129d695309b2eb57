"""sabor_intenso: everything sits in one topic element; nothing on the page is mandatory."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelarder.functions.lists import first, nth
from pagelarder.functions.phrase import UNITS, ingredient_name
from pagelarder.functions.text import after_last, before_first, delete, drop_blank, part_of, strip
from pagelarder.operators import links
from pagelarder.operators.select import Selection
from pagelarder.sources.spec import HTML, Links, SourceSpec, register_source

# Fixed values of the site.
RECIPE_PREFIX = "https://www.saborintenso.com/f"
NOTEBOOKS = (1, 9, 19, 15, 30, 25, 41, 45, 42, 49, 57, 54, 62, 76, 66, 84)
LISTING = "https://www.saborintenso.com/chef/caderno-{}/&ver=tudo&page=%s/"
VEGAN = "Vegetariana"


def _parts(page: Selection) -> dict[str, Column]:
    topic = page.xclass("topico")
    below_lists = topic.child("ul").descendants()
    return {
        "name": first(page.css("span", "bc_l2").text()),
        "dish_type": nth(page.css("a", "bc_l0").text(), 2),
        "servings": first(topic.child("font", nth=1).child("font").child("b").text()),
        "calories": first(topic.child("div", nth=2).child("font", nth=1).text()),
        "phrases": below_lists.map(lambda n: strip(F.array_join(n.texts(), " "))),
        "steps": drop_blank(topic.text()),
        "notes": topic.child().where_attr("color", "seagreen").texts(),
    }


def _fields(p: Column) -> dict[str, Column]:
    def or_empty(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    dish_type = or_empty(p["dish_type"])
    units = UNITS["sabor_intenso"]
    return {
        "name": p["name"],
        "vegan": (dish_type != "") & part_of(dish_type, VEGAN),
        "cuisine": F.lit(""),
        "dish_type": dish_type,
        "difficulty": F.lit(""),
        "time": or_empty(strip(after_last(nth(p["notes"], 0), ":"))),
        "servings": or_empty(strip(delete(after_last(p["servings"], "para"), ":"))),
        "cost": or_empty(strip(after_last(before_first(nth(p["notes"], 1), "|"), ":"))),
        "calories": or_empty(strip(after_last(p["calories"], ":"))),
        "ingredients": F.transform(p["phrases"], lambda t: ingredient_name(t, units)),
        "quantities": p["phrases"],
        "steps": p["steps"],
    }


SPEC = register_source(
    SourceSpec(
        name="sabor_intenso",
        parts=_parts,
        fields=_fields,
        links=Links(HTML, lambda page, body, url: links.per_container(page, "div", "sombra_pub")),
        recipe_prefix=RECIPE_PREFIX,
        listings=tuple(LISTING.format(n) for n in NOTEBOOKS),
    )
)
