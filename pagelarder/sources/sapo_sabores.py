"""sapo_sabores: a property table whose missing rows leave the key out of the record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelarder.functions.lists import first, zip_shortest
from pagelarder.functions.phrase import quantity_of
from pagelarder.functions.text import part_of
from pagelarder.operators import links
from pagelarder.operators.select import Selection
from pagelarder.schema import FEED_KEYS
from pagelarder.sources.spec import HTML, Links, SourceSpec, register_source

# Fixed values of the site.
SITE = "https://lifestyle.sapo.pt"
RECIPE_PREFIX = "https://lifestyle.sapo.pt/sabores/receitas"
LISTING = "https://lifestyle.sapo.pt/pesquisar?pagina=%s&q=&filtro=receitas"
VEGAN_CUISINE = "Vegetariana"
VEGAN_DISH = "Vegetariano"

# Record column -> class of its table row, by the form of the value.
LINKED = {"cuisine": "cuisine", "dish_type": "dish"}
PLAIN = {"servings": "servings"}
GRAPHIC = {
    "time": "time",
    "difficulty": "difficulty",
    "cost": "cost",
    "calories": "calories-level",
}


def _parts(page: Selection) -> dict[str, Column]:
    def prop(token: str, value) -> Column:
        row = page.css("tr", token)
        named = first(row.within(lambda r: r.css("td", "name").text()))
        return F.struct(
            named.isNotNull().alias("present"),
            F.when(named.isNotNull(), first(row.within(value))).alias("value"),
        )

    forms = [
        (LINKED, lambda r: r.css("a").text()),
        (PLAIN, lambda r: r.css("td", "value").text()),
        (GRAPHIC, lambda r: r.css("div").attr("data-tip-text")),
    ]
    table = page.css("table", "ingredients-table")
    return {
        "name": first(page.css("h1", "recipe-title").text()),
        **{n: prop(token, value) for rows, value in forms for n, token in rows.items()},
        "names": table.within(lambda t: t.css("td", "ingredient-name").text()),
        "amounts": table.within(lambda t: t.css("td", "ingredient-quantity").text()),
        "steps": page.css("section", "recipe-preparation").within(lambda s: s.css("p").text()),
    }


def _fields(p: Column) -> dict[str, Column]:
    properties = [n for n in FEED_KEYS if n in {**LINKED, **PLAIN, **GRAPHIC}]
    vegan = part_of(p["cuisine"]["value"], VEGAN_CUISINE) | part_of(
        p["dish_type"]["value"], VEGAN_DISH
    )
    return {
        "name": p["name"],
        "vegan": F.coalesce(vegan, F.lit(False)),
        **{n: p[n]["value"] for n in properties},
        "ingredients": zip_shortest(p["names"], p["amounts"], lambda name, _: name),
        "quantities": zip_shortest(
            p["names"], p["amounts"], lambda name, amount: quantity_of(amount, name)
        ),
        "steps": p["steps"],
        "absent_keys": F.filter(
            F.array(*[F.when(~p[n]["present"], F.lit(FEED_KEYS[n])) for n in properties]),
            lambda k: k.isNotNull(),
        ),
    }


def _lost_if(p: Column) -> list[tuple[str, Column]]:
    return [
        (f"{n} row without a link", p[n]["present"] & p[n]["value"].isNull()) for n in LINKED
    ]


SPEC = register_source(
    SourceSpec(
        name="sapo_sabores",
        parts=_parts,
        fields=_fields,
        lost_if=_lost_if,
        links=Links(
            HTML, lambda page, body, url: links.per_container(page, "article", "recipe", SITE)
        ),
        recipe_prefix=RECIPE_PREFIX,
        listings=(LISTING,),
    )
)
