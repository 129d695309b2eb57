"""pingo_doce: listings are JSON around HTML, recipes carry one element per ingredient part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelarder.functions.lists import first, nth
from pagelarder.functions.phrase import quantity_with_unit
from pagelarder.functions.text import delete, strip
from pagelarder.operators import links
from pagelarder.operators.select import Selection
from pagelarder.sources.spec import JSON_HTML, Links, SourceSpec, register_source

# Fixed values of the site.
RECIPE_PREFIX = "https://www.pingodoce.pt/receitas"
LISTING = "https://www.pingodoce.pt/wp-content/themes/pingodoce/ajax/pd-ajax.php?type=recipe&page=%s&query=&filters=&action=custom-search"
VEGAN = ("vegetariana", "vegan")


def _parts(page: Selection) -> dict[str, Column]:
    details = page.css("div", "recipe-details")

    def detail(token: str) -> Column:
        return first(details.within(lambda d: d.css("label", token).text()))

    def ingredient(item: Selection) -> Column:
        product = nth(item.css("span", "ingredient-product").text(), 1)
        return F.struct(
            first(item.css("span", "ingredient-quantity").text()).alias("quantity"),
            first(item.css("span", "ingredient-unit").text()).alias("unit"),
            strip(delete(product, "\r\n", "\t")).alias("product"),
        )

    def step(item: Selection) -> Column:
        return F.concat(
            strip(first(item.css("span", "instruction-index").text())),
            strip(first(item.css("span", "instruction-body").text())),
        )

    return {
        "name": first(page.css("h1", "main-slide-title").text()),
        "types": page.css("div", "recipe-types").within(
            lambda d: d.css("span", "recipetype").text()
        ),
        "difficulty": detail("dificulty"),
        "time": detail("preptime"),
        "servings": detail("nr_persons"),
        "ingredients": page.css("li", "ingredient-wrapper").map(ingredient),
        "steps": page.css("li", "instruction-item").map(step),
    }


def _fields(p: Column) -> dict[str, Column]:
    types = p["types"]
    cuisine = F.coalesce(strip(delete(first(types), "|")), F.lit(""))
    dish_type = F.when(
        F.size(types) > 1, strip(F.get(types, F.size(types) - 1))
    ).otherwise(F.lit(""))
    return {
        "name": p["name"],
        "vegan": cuisine.isin(*VEGAN) | dish_type.isin(*VEGAN),
        "cuisine": cuisine,
        "dish_type": dish_type,
        "difficulty": p["difficulty"],
        "time": p["time"],
        "servings": p["servings"],
        "cost": F.lit(""),
        "calories": F.lit(""),
        "ingredients": p["ingredients"]["product"],
        "quantities": F.transform(
            p["ingredients"], lambda i: quantity_with_unit(i["quantity"], i["unit"], i["product"])
        ),
        "steps": p["steps"],
    }


def _lost_if(p: Column) -> list[tuple[str, Column]]:
    return [
        (
            "ingredient without quantity or product",
            F.exists(
                p["ingredients"], lambda i: i["quantity"].isNull() | i["product"].isNull()
            ),
        ),
        ("step without index or body", F.exists(p["steps"], lambda s: s.isNull())),
    ]


SPEC = register_source(
    SourceSpec(
        name="pingo_doce",
        parts=_parts,
        fields=_fields,
        lost_if=_lost_if,
        links=Links(JSON_HTML, lambda page, body, url: links.all_links(page)),
        recipe_prefix=RECIPE_PREFIX,
        listings=(LISTING,),
    )
)
