"""Render the rows of `documents` as pages of each source, so that records can be predicted.

Every document becomes one recipe page per source; twenty consecutive documents share a
listing page. Whole texts are used: each line is an ingredient phrase and a step. What varies
from page to page (layouts, missing parts, lost pages) follows from `doc_id`, so the expected
records can be computed from `documents` alone.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelarder.session import shared_folder
from pagelarder.sources import (
    pingo_doce,
    receitas_portugal,
    registered_sources,
    sabor_intenso,
    sapo_sabores,
    teleculinaria,
    vaqueiro,
)
from pagelarder.sources.pages import save_snapshot

SITES = [
    "pingo_doce",
    "receitas_portugal",
    "sabor_intenso",
    "sapo_sabores",
    "teleculinaria",
    "vaqueiro",
]
PER_LISTING = 20
EMPTY_EVERY = 40

# Prefixes and suffixes that give plain lines the shapes of ingredient phrases.
PREFIXES = [
    "", "200 g ", "2 colheres de ", "1/2 kg ", ".5 L ", "3 dl de ", "Q.B. ", "1 colh. ",
    "100ml de ", "d ", "e ", "1 gr ", "½ kg ", "q.b. de ", "  7 \t", "12 GRS de ",
]
SUFFIXES = ["", " q.b.", " q.b. q.b.", " ", " "]
NAME_PREFIXES = ["", "de ", " de  ", "q.b. ", "de q.b. "]

CATEGORY_NAMES = [c[0] for c in vaqueiro.CATEGORIES]


def pick(options: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(o) for o in options]), (index % len(options)).cast("int"))


def escape(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def _c(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _if(condition: Column, *parts) -> Column:
    return F.when(condition, _c(*parts)).otherwise(F.lit(""))


def _each(lines: Column, item) -> Column:
    """Render each line; `item` gets the escaped line and its position from 0."""
    return F.array_join(F.transform(lines, lambda line, i: item(escape(line), i)), "")


def phrase(d: Column, i: Column, line: Column) -> Column:
    return _c(pick(PREFIXES, d + i), line, pick(SUFFIXES, d * 3 + i))


def _columns() -> tuple[Column, Column]:
    return F.col("doc_id"), F.col("lines")


def _pingo_doce() -> Column:
    doc, lines = _columns()
    types = (
        F.when(doc % 4 == 1, F.lit('<span class="recipetype">vegan |</span>'))
        .when(
            doc % 4 == 2,
            F.lit(
                '<span class="recipetype">Prato |</span><span class="recipetype">x</span>'
                '<span class="recipetype"> vegetariana </span>'
            ),
        )
        .when(
            doc % 4 == 3,
            _c('<span class="a recipetype">', F.col("lang"), ' |</span><span class="recipetype"> ',
               F.col("source"), "</span>"),
        )
        .otherwise(F.lit(""))
    )
    return _c(
        '<!DOCTYPE html><html><body><h1 class="main-slide-title big">', escape(lines[0]), "</h1>",
        '<div class="x recipe-types">', types, "</div>",
        '<div class="recipe-details">',
        _if(doc % 3 != 0, '<label class="dificulty">Fácil ', doc % 3, "</label>"),
        '<label class="preptime">', F.col("n_chars"), " min</label>",
        _if(doc % 4 == 1, '<label class="nr_persons"> ', doc, " </label>"), "</div><ul>",
        _each(lines, lambda line, i: _c(
            '<li class="ingredient-wrapper x"><span class="ingredient-quantity">', i + 1, "</span>",
            _if(i % 2 == 0, '<span class="ingredient-unit">kg</span>'),
            '<span class="ingredient-product">',
            _if((i > 0) | (doc % 7 != 0), "p<i>q</i>"), "\r\n\t", line, " \t</span></li>",
        )), "</ul><ol>",
        _each(lines, lambda line, i: _c(
            '<li class="instruction-item"><span class="instruction-index"> ', i + 1, ".</span>",
            _if((i > 0) | (doc % 11 != 0), '<span class="instruction-body"> ', line, " </span>"),
            "</li>",
        )), "</ol></body></html>",
    )


def _receitas_portugal() -> Column:
    doc, lines = _columns()
    def items(before: str, after: str) -> Column:
        return _each(lines, lambda line, i: _c(
            before, pick(PREFIXES, doc + i), "<b>", line, "</b>\n ", pick(SUFFIXES, doc * 3 + i), after
        ))

    def steps(before: str, after: str) -> Column:
        return _each(lines, lambda line, i: _c(before, "  ", line, "\n\t<i>fim</i> ", after))

    ingredient_layouts = [
        items('<span class="ingredient-item-name">', "</span>"),
        items('<p class="ingredient">', "</p>"),
        _c('<div class="shortcode-ingredients"><ul>', items("<li>", "</li>"), "</ul></div>"),
        _c('<ul class="ingredients-list">', items("<li>", "</li>"), "</ul>"),
    ]
    step_layouts = [
        steps('<div class="direction-step">', "</div>"),
        steps('<span class="text_exposed_show">', "</span>"),
        steps('<p class="instruction">', "</p>"),
        _c('<ol class="instructions">', steps("<li>", "</li>"), "</ol>"),
        _c('<ol class="directions-list">', steps("<li>", "</li>"), "</ol>"),
    ]

    def by_rest(layouts: list[Column]) -> Column:
        chosen = F.lit("")
        for rest, layout in enumerate(layouts):
            chosen = F.when(doc % len(layouts) == rest, layout).otherwise(chosen)
        return chosen

    return _c(
        '<h1 class="entry-title fn">', escape(lines[0]), '</h1><h1 class="entry-title">x</h1>',
        _if(doc % 3 == 0, '<span class="entry-category"><a>Vegetariano</a><a>x</a></span>'),
        _if(doc % 3 == 1, '<span class="entry-category"><a>', F.col("lang"),
            "</a><a>Vegetariano</a></span>"),
        _if(doc % 13 != 12, by_rest(ingredient_layouts)),
        _if((doc % 13 != 12) & (doc % 4 != 3), '<ul class="ingredients-list"><li>other</li></ul>'),
        _if(doc % 17 != 16, by_rest(step_layouts)),
    )


def _sabor_intenso() -> Column:
    doc, lines = _columns()
    return _c(
        '<span class="bc_l2">', escape(lines[0]), '</span><a class="bc_l0">Início</a>',
        '<a class="bc_l0">Chef</a>',
        _if(doc % 3 == 1, '<a class="bc_l0">', F.col("source"), "</a>"),
        _if(doc % 3 == 2, '<a class="bc_l0">Veg</a>'),
        '<div class="topico">',
        _if(doc % 4 != 3, "<font><font><b>Ingredientes para ", doc, " pessoas:</b></font></font>"),
        "\n<ul>",
        _each(lines, lambda line, i: _c(
            "<li>", phrase(doc, i, line), _if(i % 3 == 0, "<a>", F.col("lang"), "</a>"), "</li>"
        )),
        "</ul>\n",
        _each(lines, lambda line, i: _c(" ", line, "\r\nfim<br>\n")),
        _if(doc % 5 != 4, '<font color="seagreen">Tempo: ', F.col("n_chars"), " min </font>"),
        _if(doc % 5 < 2, '<font color="seagreen">Custo: ', doc, " euros | x</font>"),
        "<div>a</div>",
        _if(doc % 2 == 0, "<div><font>Calorias: ", doc, "</font></div>"),
        "</div>",
    )


def _sapo_sabores() -> Column:
    doc, lines = _columns()
    def row(token: str, value: Column | str, name: Column | str = "x") -> Column:
        return _c('<tr class="', token, '"><td class="name">', name, "</td>", value, "</tr>")

    return _c(
        '<h1 class="recipe-title">', escape(lines[0]), "</h1><table>",
        _if(doc % 2 == 0, row("cuisine", _c(
            '<td class="value">',
            _if(doc % 10 != 8, "<a>", F.when(doc % 4 == 0, F.lit("Vegetariana")).otherwise(F.col("lang")),
                "</a>"), "</td>"))),
        _if(doc % 3 != 0, row("dish", _c(
            "<td><a>", F.when(doc % 3 == 1, F.lit("Vegetarian")).otherwise(F.col("source")),
            "</a></td>"))),
        _if(doc % 5 != 0, row("time", _c(
            "<td>", _if(doc % 5 != 1, '<div data-tip-text="', F.col("n_chars"), ' min"></div>'),
            "</td>"))),
        row("difficulty", '<td><div data-tip-text="Média"></div></td>', _if(doc % 7 != 0, "x")),
        row("servings", _c('<td class="value">', doc, "</td>")),
        '</table><table class="ingredients-table">',
        _each(lines, lambda line, i: _c(
            '<tr><td class="ingredient-quantity">',
            _if((i < F.size(lines) - 1) | (doc % 3 != 0), i + 1, " kg"),
            '</td><td class="ingredient-name">', line, "</td></tr>",
        )),
        '</table><section class="recipe-preparation">',
        _each(lines, lambda line, i: _c("<p>", line, "<br>fim</p>")),
        "</section>",
    )


def _teleculinaria() -> Column:
    doc, lines = _columns()
    def items() -> Column:
        return _each(lines, lambda line, i: _c(
            "<li>",
            _if(i % 3 != 2, '<span class="wpurp-recipe-ingredient-quantity" data-original="',
                i + 1, '">n</span>'),
            _if(i % 2 == 0, '<span class="wpurp-recipe-ingredient-unit">kg</span>'),
            '<span class="wpurp-recipe-ingredient-name">',
            _if((i > 0) | (doc % 8 != 7), "<a>", pick(NAME_PREFIXES, doc + i), line,
                pick(SUFFIXES, doc + i), "</a>"),
            "</span></li>",
        ))

    return _c(
        '<h1 class="entry-title">', escape(lines[0]), "</h1>",
        _if(doc % 2 == 0, '<div class="wpurp-recipe-tags-refeição"><b><a>', F.col("lang"),
            "</a></b></div>"),
        _if(doc % 3 == 0, '<div class="wpurp-recipe-tags-grau-de-dificuldade"><a>Média</a></div>'),
        _if(doc % 5 == 0, '<div class="wpurp-recipe-tags-custo-da-refeição"><a>Baixo</a></div>'),
        _if(doc % 4 != 0, '<span class="wpurp-recipe-prep-time">', F.col("n_chars"), "</span>"),
        _if(doc % 4 != 1, '<span class="wpurp-recipe-prep-time-text">min</span>'),
        '<input type="text" data-original="no">',
        _if(doc % 3 != 1, '<input type="number" data-original="', doc, '">'),
        _if(doc % 3 != 2, '<span class="wpurp-recipe-servings-changer"> pessoas</span>'),
        '<ul class="wpurp-recipe-ingredient-container">',
        items(), _if(doc % 9 != 0, items()), _if((doc % 9 != 0) & (doc % 4 == 1), "<li>odd</li>"),
        '</ul><ol class="wpurp-recipe-instruction-container">',
        _each(lines, lambda line, i: _c(
            "<li>", _if((i > 0) | (doc % 16 != 3), '<span class="wpurp-recipe-instruction-text"> ',
                        line, "<br> x</span>"), "</li>",
        )), "</ol>",
    )


def _vaqueiro() -> Column:
    doc, lines = _columns()
    info = [
        _if(doc % 4 > n, "<dd>", F.lit(name), " ", doc, "</dd>")
        for n, name in enumerate(("custo", "tempo", "grau"))
    ]
    return _c(
        _if(doc % 12 != 11, '<h1 class="recipe-title"> ', escape(lines[0]), " </h1>"),
        '<div class="additional-info"><dl>', *info, "</dl></div>",
        '<div class="preparation">', _if(doc % 3 != 0, "<p><span>", doc, " doses</span></p>"), "<ul>",
        _each(lines, lambda line, i: _c(
            "<li>", pick(PREFIXES, doc + i), "<i>", line, "</i>\n", pick(SUFFIXES, doc * 3 + i), "</li>"
        )),
        '</ul></div><div class="instructions"><h3 class="title">',
        F.when(doc % 6 != 5, F.lit("Preparação")).otherwise(F.lit("Modo")), "</h3>",
        _each(lines, lambda line, i: _c("\n\t", i + 1, ". ", line, " \r\n\n")), "</div>",
    )


_PAGES = {
    "pingo_doce": _pingo_doce,
    "receitas_portugal": _receitas_portugal,
    "sabor_intenso": _sabor_intenso,
    "sapo_sabores": _sapo_sabores,
    "teleculinaria": _teleculinaria,
    "vaqueiro": _vaqueiro,
}

# URL of the recipe page of a document, as the part before and after its id.
RECIPE_URLS = {
    "pingo_doce": ("https://www.pingodoce.pt/receitas/r", "/"),
    "receitas_portugal": ("http://www.receitasdeportugal.com/r", ""),
    "sabor_intenso": ("https://www.saborintenso.com/f20/r", ".html"),
    "sapo_sabores": ("https://lifestyle.sapo.pt/sabores/receitas/r", ""),
    "teleculinaria": ("https://www.teleculinaria.pt/receitas/r", "/"),
    "vaqueiro": ("https://www.vaqueiro.pt/receitas/r", ""),
}
RUN_CATEGORY = "doces"


def recipe_url(site: str, doc: Column) -> Column:
    before, after = RECIPE_URLS[site]
    return _c(before, doc, after)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn(
        "lines", F.split("text", "\n")
    )


def recipe_pages(docs: DataFrame, site: str) -> DataFrame:
    number = SITES.index(site)
    doc, _ = _columns()
    return docs.select(
        (doc * 16 + number).alias("page_id"),
        recipe_url(site, doc).alias("url"),
        _PAGES[site]().alias("html"),
    )


def _listing_bodies() -> dict[str, tuple[Column, Column]]:
    """Site -> (URL, body) of a listing from `page` and `docs`, the sorted ids it links to.

    Each listing also repeats a link to document 0, so one URL is linked from everywhere.
    """
    page = F.col("page")

    def listed(render) -> Column:
        return F.array_join(F.transform(F.concat("docs", F.array(F.lit(0).cast("long"))), render), "")

    def commas(render) -> Column:
        return F.array_join(F.transform(F.concat("docs", F.array(F.lit(0).cast("long"))), render), ",")

    def at(template: str) -> Column:
        return F.replace(F.lit(template), F.lit("%s"), page.cast("string"))

    quote = '\\\\\\"'  # JSON for backslash and quote
    start = (page - 1) * vaqueiro.WINDOW
    number = dict((c[0], c[1]) for c in vaqueiro.CATEGORIES)[RUN_CATEGORY]
    return {
        "pingo_doce": (
            at(pingo_doce.LISTING),
            _c('{"data":{"html":"', listed(lambda d: _c(
                "<b><a href=", quote, recipe_url("pingo_doce", d), quote, ">x</a>\\r\\n</b>"
            )), '"}}'),
        ),
        "receitas_portugal": (
            at(receitas_portugal.LISTING),
            F.when(page % EMPTY_EVERY == 0, F.lit('{"type":"empty"}')).otherwise(
                _c('{"type":"success","postflair":{', commas(lambda d: _c(
                    '"', recipe_url("receitas_portugal", d), '":["a",{"k":1}]'
                )), "}}")
            ),
        ),
        "sabor_intenso": (
            at(sabor_intenso.LISTING.format(sabor_intenso.NOTEBOOKS[0])),
            listed(lambda d: _c(
                '<div class="sombra_pub x"><a name="t"></a><a href="',
                recipe_url("sabor_intenso", d), '">1</a><a href="http://no">2</a></div>',
            )),
        ),
        "sapo_sabores": (
            at(sapo_sabores.LISTING),
            listed(lambda d: _c(
                '<article class="recipe big"><a href="',
                F.replace(recipe_url("sapo_sabores", d), F.lit(sapo_sabores.SITE), F.lit("")),
                '">1</a></article><article class="news"><a href="/n">n</a></article>',
            )),
        ),
        "teleculinaria": (
            at(teleculinaria.LISTING),
            listed(lambda d: _c(
                '<div class="td-block-span6"><p><h3 class="entry-title td-module-title">'
                '<a href="../../r', d, '/#top">b</a></h3></p></div>'
                '<div class="td-block-span6 x"><h3 class="entry-title td-module-title">'
                '<a href="/receitas/no/">n</a></h3></div>',
            )),
        ),
        "vaqueiro": (
            _c(f"{vaqueiro.LISTING}?category={number}&StartIdx=", start, "&EndIdx=",
               start + (vaqueiro.WINDOW - 1)),
            _c('{"bodydata":{"Results":[', commas(lambda d: _c(
                '{"Url":"/receitas/r', d, '"}'
            )), "]}}"),
        ),
    }


def listing_pages(docs: DataFrame) -> DataFrame:
    """Listing pages of all sites. A group is the twenty ids of one page, never more."""
    groups = docs.groupBy((F.floor(F.col("doc_id") / PER_LISTING) + 1).cast("int").alias("page")).agg(
        F.sort_array(F.collect_list("doc_id")).alias("docs")
    )
    bodies = _listing_bodies()
    each = F.array(*[
        F.struct(F.lit(8 + n).alias("n"), bodies[s][0].alias("url"), bodies[s][1].alias("html"))
        for n, s in enumerate(SITES)
    ])
    return groups.select("page", F.inline(each)).select(
        (F.col("page").cast("long") * 16 + F.col("n")).alias("page_id"), "url", "html"
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per site over the listing pages from 2 up to the last but one."""
    last = spark.read.parquet(f"{sf_dir}/documents.parquet").agg(
        F.floor(F.max("doc_id") / PER_LISTING).cast("string").alias("page_end")
    )
    return last.select(
        F.explode(F.array(*[F.lit(s) for s in SITES])).alias("source"),
        F.lit("2").alias("page_start"),
        "page_end",
        F.lit(RUN_CATEGORY).alias("category"),
    )


_STORED: dict[tuple[str, str], str] = {}
_WRITTEN: set[tuple[str, str]] = set()  # (folder, part)
PARTS = [*SITES, "listing"]
# Pages repeat each line: zstd halves what snappy leaves. Row groups are what scans are split by.
COMPACT = {"compression": "zstd", "parquet.block.size": 16 << 20}


def stored_pages(spark: SparkSession, sf_dir: str, parts: list[str] = PARTS) -> str:
    """Folder of the rendered pages, each part written once per session: <folder>/site=.../*.parquet.

    `parts` are the sites, or "listing", that the caller reads; others may be there or not. A part
    is rendered where its documents are read, so no text is moved.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    folder = _STORED.setdefault(key, shared_folder(spark, "pages"))
    docs = documents(spark, sf_dir)
    for part in parts:
        if (folder, part) not in _WRITTEN:
            pages = listing_pages(docs) if part == "listing" else recipe_pages(docs, part)
            pages.write.options(**COMPACT).mode("overwrite").parquet(f"{folder}/site={part}")
            _WRITTEN.add((folder, part))
    return folder


_SNAPSHOTS: dict[tuple[str, str], str] = {}
BUCKETS = 32


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered pages of all sites and listings as a snapshot, written once per session.

    Pages are bucketed by id where they are rendered, and stay there when a run picks its pages.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SNAPSHOTS:
        docs, table = documents(spark, sf_dir), f"pages_{uuid.uuid4().hex}"
        pages = reduce(DataFrame.unionByName, [*[recipe_pages(docs, s) for s in SITES], listing_pages(docs)])
        save_snapshot(pages, table, BUCKETS, shared_folder(spark, "snapshot"), distribute=False, **COMPACT)
        _SNAPSHOTS[key] = table
    return spark.table(_SNAPSHOTS[key])


assert [s.name for s in registered_sources()][: len(SITES)] == SITES
