"""vaqueiro: listings by category and item window, preparation as one block of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelarder.functions.lists import first, head, nth
from pagelarder.functions.phrase import UNITS, ingredient_name
from pagelarder.functions.text import clean_lines, delete, strip, substring_after
from pagelarder.operators import links
from pagelarder.operators.select import Selection
from pagelarder.sources.spec import JSON, Categories, Links, SourceSpec, register_source

# Fixed values of the site. The listing is a form request; the stored page carries the form
# fields that tell requests apart in its query string.
SITE = "https://www.vaqueiro.pt"
LISTING = "https://www.vaqueiro.pt/Search/QueryService"
WINDOW = 12

# Category, its number on the site, its number of listing pages.
CATEGORIES = (
    ("sopas", "1", "22"),
    ("entradas", "2", "60"),
    ("saladas", "3", "21"),
    ("carnes", "6", "76"),
    ("peixes", "4", "70"),
    ("massas", "8", "14"),
    ("arroz", "9", "15"),
    ("legumes", "7", "14"),
    ("acompanhamentos", "12", "5"),
    ("paes", "10", "11"),
    ("pizzas", "11", "7"),
    ("bebidas", "13", "7"),
    ("dietas", "15", "4"),
    ("doces", "14", "124"),
)


def _parts(page: Selection) -> dict[str, Column]:
    preparation = page.xclass("preparation")
    instructions = page.xclass("instructions")
    whole = F.sort_array(F.concat(instructions.at, instructions.descendants().at))
    text = page.pick(F.array_distinct(whole)).not_class("title").string()
    return {
        "name": strip(first(page.xclass("recipe-title").text())),
        "info": head(page.xclass("additional-info").descendants("dd").text(), 3),
        "servings": first(preparation.descendants("span").text()),
        "phrases": F.transform(
            preparation.child("ul").descendants("li").strings(),
            lambda t: strip(delete(t, "\n")),
        ),
        "steps": clean_lines(delete(substring_after(text, "Preparação"), "\t")),
    }


def _fields(p: Column) -> dict[str, Column]:
    units = UNITS["vaqueiro"]
    info = {n: F.coalesce(nth(p["info"], i), F.lit("")) for i, n in enumerate(("cost", "time", "difficulty"))}
    return {
        "name": p["name"],
        "vegan": F.lit(False),
        "cuisine": F.lit(""),
        "dish_type": F.col("category"),
        **info,
        "servings": p["servings"],
        "calories": F.lit(""),
        "ingredients": F.transform(p["phrases"], lambda t: ingredient_name(t, units)),
        "quantities": p["phrases"],
        "steps": p["steps"],
    }


SPEC = register_source(
    SourceSpec(
        name="vaqueiro",
        parts=_parts,
        fields=_fields,
        lost_if=lambda p: [("no name", p["name"].isNull())],
        links=Links(JSON, lambda page, body, url: links.json_array(body, SITE)),
        categories=Categories(
            LISTING + "?category={category}&StartIdx={start}&EndIdx={end}", WINDOW, CATEGORIES
        ),
        decompose=True,
    )
)
