"""teleculinaria: links by rule, each ingredient list printed twice, no vegan mark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelarder.functions.lists import first, first_half
from pagelarder.functions.phrase import name_field, quantity_fields
from pagelarder.functions.text import concat_missing_as_empty, single_spaced, strip
from pagelarder.operators import links
from pagelarder.operators.select import Selection
from pagelarder.sources.spec import HTML, Links, SourceSpec, register_source

# Fixed values of the site.
LISTING = "https://www.teleculinaria.pt/receitas/page/%s/"
ALLOW = r"/receitas/[A-Za-z0-9]+"
TAGS = {
    "dish_type": "wpurp-recipe-tags-refeição",
    "difficulty": "wpurp-recipe-tags-grau-de-dificuldade",
    "cost": "wpurp-recipe-tags-custo-da-refeição",
}


def _links(page: Selection, body: Column, url: Column) -> Column:
    titles = page.xclass("td-block-span6", "div").xclass("entry-title td-module-title", "h3")
    return links.by_rule(titles, url, ALLOW)


def _parts(page: Selection) -> dict[str, Column]:
    def span(item: Selection, cls: str) -> Selection:
        return item.xclass(cls, "span")

    def ingredient(item: Selection) -> Column:
        return F.struct(
            first(span(item, "wpurp-recipe-ingredient-quantity").attr("data-original")).alias(
                "amount"
            ),
            first(span(item, "wpurp-recipe-ingredient-unit").text()).alias("unit"),
            first(
                span(item, "wpurp-recipe-ingredient-name").descendants("a").text()
            ).alias("name"),
        )

    items = page.xclass("wpurp-recipe-ingredient-container", "ul").child("li")
    steps = page.xclass("wpurp-recipe-instruction-container", "ol").child("li")
    return {
        "name": first(page.xclass("entry-title", "h1").text()),
        **{n: first(page.xclass(c, "div").descendants("a").text()) for n, c in TAGS.items()},
        "time": span(page, "wpurp-recipe-prep-time").string(),
        "time_unit": first(span(page, "wpurp-recipe-prep-time-text").text()),
        "servings": first(
            page.css("input").where_attr("type", "number").attr("data-original")
        ),
        "servings_unit": first(span(page, "wpurp-recipe-servings-changer").text()),
        "ingredients": items.head(first_half).map(ingredient),
        "steps": steps.map(
            lambda li: strip(first(span(li, "wpurp-recipe-instruction-text").text()))
        ),
    }


def _fields(p: Column) -> dict[str, Column]:
    def joined(amount: str, unit: str) -> Column:
        return concat_missing_as_empty(p[amount], F.lit(" "), p[unit])

    return {
        "name": p["name"],
        "cuisine": F.lit(""),
        **{n: p[n] for n in TAGS},
        "time": joined("time", "time_unit"),
        "servings": single_spaced(joined("servings", "servings_unit")),
        "calories": F.lit(""),
        "ingredients": F.transform(p["ingredients"], lambda i: name_field(strip(i["name"]))),
        "quantities": F.transform(
            p["ingredients"], lambda i: quantity_fields(i["amount"], i["unit"], i["name"])
        ),
        "steps": p["steps"],
    }


def _lost_if(p: Column) -> list[tuple[str, Column]]:
    return [
        ("ingredient without a linked name", F.exists(p["ingredients"], lambda i: i["name"].isNull())),
        ("step without text", F.exists(p["steps"], lambda s: s.isNull())),
    ]


SPEC = register_source(
    SourceSpec(
        name="teleculinaria",
        parts=_parts,
        fields=_fields,
        lost_if=_lost_if,
        links=Links(HTML, _links),
        listings=(LISTING,),
    )
)
