"""One page per source with the record it gives, and every way a page is lost."""

import pytest

from pagelarder.operators.conform import recipes, rejects
from pagelarder.plans.extract import extract

PINGO = """<h1 class="main-slide-title big">Caril</h1>
<div class="recipe-types"><span class="recipetype">vegan |</span><span class="recipetype">x</span><span class="recipetype"> prato </span></div>
<div class="recipe-details"><label class="dificulty">Fácil</label><label class="preptime">20 min</label></div>
<ul><li class="ingredient-wrapper"><span class="ingredient-quantity">2</span><span class="ingredient-unit">kg</span><span class="ingredient-product">a<i>b</i>
\tbatata </span></li></ul>
<li class="instruction-item"><span class="instruction-index"> 1.</span><span class="instruction-body"> Cozer. </span></li>"""

PORTUGAL = """<h1 class="entry-title fn">Sopa</h1><span class="entry-category"><a>Vegetariano</a><a>Sopas</a></span>
<ul class="ingredients-list"><li>2 dl  de <b>leite</b></li><li>Sal q.b.</li><li>1 colh. sopa azeite</li></ul>
<ol class="directions-list"><li> Misture
 tudo. </li></ol>"""

INTENSO = """<span class="bc_l2">Bolo</span><a class="bc_l0">Início</a><a class="bc_l0">Chef</a><a class="bc_l0">Veg</a>
<div class="topico"><font><font><b>Ingredientes para 4 pessoas:</b></font></font>
<ul><li>200 g farinha</li><li>2 dl <a>leite</a></li></ul>
Bata tudo.<br>
Leve ao forno.
<font color="seagreen">Tempo: 30 min</font><font color="seagreen">Custo: 5 euros | x</font>
<div>a</div><div><font>Calorias: 100</font></div></div>"""

SAPO = """<h1 class="recipe-title">Tarte</h1>
<table><tr class="cuisine"><td class="name">Cozinha</td><td class="value"><a>Vegetariana</a></td></tr>
<tr class="time"><td class="name">Tempo</td><td class="value"><div data-tip-text="Rápida"></div></td></tr>
<tr class="servings"><td class="name">Doses</td><td class="value">4</td></tr></table>
<table class="ingredients-table"><tr><td class="ingredient-quantity">1 kg</td><td class="ingredient-name">maçã</td></tr>
<tr><td class="ingredient-quantity"></td><td class="ingredient-name">canela</td></tr></table>
<section class="recipe-preparation"><p>Corte<br>Asse</p></section>"""

TELE_ITEM = """<li><span class="wpurp-recipe-ingredient-quantity" data-original="2">2</span><span class="wpurp-recipe-ingredient-unit">kg</span><span class="wpurp-recipe-ingredient-name"><a>de arroz q.b.</a></span></li>"""
TELE = f"""<h1 class="entry-title">Arroz</h1><div class="wpurp-recipe-tags-refeição"><a>Prato</a></div>
<span class="wpurp-recipe-prep-time">20</span><span class="wpurp-recipe-prep-time-text">min</span>
<input type="number" data-original="4"><span class="wpurp-recipe-servings-changer">pessoas</span>
<ul class="wpurp-recipe-ingredient-container">{TELE_ITEM}<li>copy</li></ul>
<ol class="wpurp-recipe-instruction-container"><li><span class="wpurp-recipe-instruction-text"> Ferva. </span></li></ol>"""

VAQUEIRO = """<h1 class="recipe-title"> Caldo </h1>
<dl class="additional-info"><dd>Barato</dd><dd>30 min</dd></dl>
<div class="preparation"><span>4 doses</span><ul><li>1 dl azeite</li><li>Sal q.b.</li></ul></div>
<div class="instructions"><h3 class="title">Preparação</h3>
\t1. Ferva.

2. Pão.
</div>"""

# (case, source, page, expected fields)
RECORDS = [
    ("p", "pingo_doce", PINGO, dict(
        name="Caril", cuisine="vegan", dish_type="prato", vegan=True, difficulty="Fácil",
        time="20 min", servings=None, cost="", calories="", ingredients=["batata"],
        quantities=["2 kg batata"], steps=["1.Cozer."], absent_keys=[],
    )),
    ("p-one-type", "pingo_doce", PINGO.replace("<span class=\"recipetype\">x</span><span class=\"recipetype\"> prato </span>", ""),
     dict(cuisine="vegan", dish_type="")),
    ("p-no-unit", "pingo_doce", PINGO.replace('<span class="ingredient-unit">kg</span>', ""),
     dict(quantities=["2 batata"])),
    ("p-last-vegan", "pingo_doce", PINGO.replace("vegan |", "Ind | ia").replace(" prato ", "vegetariana"),
     dict(cuisine="Ind  ia", dish_type="vegetariana", vegan=True)),
    ("r", "receitas_portugal", PORTUGAL, dict(
        name="Sopa", dish_type="Vegetariano", vegan=True,
        quantities=["2 dl de leite", "Sal q.b.", "1 colh. sopa azeite"],
        ingredients=["leite", "Sal", "colh. sopa azeite"], steps=["Misture tudo."],
    )),
    ("r-two-forms", "receitas_portugal", '<p class="ingredient">3 ovos</p>' + PORTUGAL,
     dict(ingredients=["ovos"])),
    ("r-nested-form", "receitas_portugal",
     '<div class="shortcode-ingredients"><ul><li>1 g sal</li></ul></div><p class="instruction">a</p>',
     dict(name=None, ingredients=["sal"], steps=["a"], dish_type=None, vegan=False)),
    ("r-no-category", "receitas_portugal", PORTUGAL.replace("entry-category", "x"),
     dict(dish_type=None, vegan=False)),
    ("i", "sabor_intenso", INTENSO, dict(
        dish_type="Veg", vegan=True, servings="4 pessoas", calories="100", time="30 min", cost="5 euros",
        quantities=["200 g farinha", "2 dl  leite", "leite"],
        ingredients=["farinha", "dl leite", "leite"], steps=["Bata tudo.", "Leve ao forno."],
    )),
    ("i-empty", "sabor_intenso", "", dict(
        name=None, dish_type="", vegan=False, servings="", calories="", time="", cost="",
        quantities=[], ingredients=[], steps=[], difficulty="", cuisine="",
    )),
    ("s", "sapo_sabores", SAPO, dict(
        cuisine="Vegetariana", vegan=True, time="Rápida", servings="4", ingredients=["maçã"],
        quantities=["1 kg de maçã"], steps=["Corte", "Asse"],
        absent_keys=["tipo", "dificuldade", "custo", "calorias"], cost=None,
    )),
    ("s-no-tip", "sapo_sabores", SAPO.replace(' data-tip-text="Rápida"', ""),
     dict(time=None, absent_keys=["tipo", "dificuldade", "custo", "calorias"])),
    ("t", "teleculinaria", TELE, dict(
        dish_type="Prato", difficulty=None, cost=None, time="20 min", servings="4 pessoas", vegan=None,
        absent_keys=["vegan"], quantities=["2 kg de arroz q.b."], ingredients=["arroz"], steps=["Ferva."],
    )),
    ("t-bare", "teleculinaria", f'<ul class="wpurp-recipe-ingredient-container">{TELE_ITEM}</ul>',
     dict(time=" ", servings=" ", ingredients=[], quantities=[], steps=[])),
    ("t-three", "teleculinaria", TELE.replace("<li>copy</li>", "<li>copy</li><li>copy</li>"),
     dict(ingredients=["arroz"])),
    ("v", "vaqueiro", VAQUEIRO, dict(
        name="Caldo", dish_type="sopas", cost="Barato", time="30 min", difficulty="", servings="4 doses",
        quantities=["1 dl azeite", "Sal q.b."], ingredients=["azeite", "Sal"],
        steps=["1. Ferva.", "2. Pão."], vegan=False,
    )),
    ("v-no-mark", "vaqueiro", VAQUEIRO.replace("Preparação", "Modo"), dict(steps=[])),
    ("v-title-only", "vaqueiro", '<h1 class="recipe-title">a</h1><p class="instructions"><b class="title">Preparação</b>x</p>',
     dict(steps=["x"], servings=None)),
]

LOST = [
    ("p-product", "pingo_doce", PINGO.replace("a<i>b</i>", ""), "ingredient without quantity or product"),
    ("p-quantity", "pingo_doce", PINGO.replace("ingredient-quantity", "q"), "ingredient without quantity or product"),
    ("p-body", "pingo_doce", PINGO.replace("instruction-body", "q"), "step without index or body"),
    ("r-ingredients", "receitas_portugal", PORTUGAL.replace("ingredients-list", "q"), "no ingredient layout matches"),
    ("r-steps", "receitas_portugal", PORTUGAL.replace("directions-list", "q"), "no step layout matches"),
    ("s-cuisine", "sapo_sabores", SAPO.replace("<a>Vegetariana</a>", ""), "cuisine row without a link"),
    ("s-dish", "sapo_sabores", SAPO.replace('class="time"', 'class="dish"'), "dish_type row without a link"),
    ("t-name", "teleculinaria", TELE.replace("<a>de arroz q.b.</a>", ""), "ingredient without a linked name"),
    ("t-step", "teleculinaria", TELE.replace(" Ferva. ", ""), "step without text"),
    ("v-name", "vaqueiro", VAQUEIRO.replace("recipe-title", "q"), "no name"),
]


@pytest.fixture(scope="module")
def extracted(spark):
    rows = [(c, s, h, "sopas") for c, s, h, _ in [*RECORDS, *LOST]] + [("none", "unknown", "<p>", "")]
    pages = spark.createDataFrame(rows, "url string, source string, html string, category string")
    return extract(pages.coalesce(2)).persist()


def test_records(extracted):
    found = {r.url: r.asDict() for r in recipes(extracted).collect()}
    assert found.keys() == {c for c, *_ in RECORDS}
    for case, source, _, expected in RECORDS:
        record = found[case]
        assert record["source"] == source
        assert {k: record[k] for k in expected} == expected, case


def test_lost_pages(extracted):
    found = {(r.url, r.source, r.reason) for r in rejects(extracted).collect()}
    assert found == {(case, source, reason) for case, source, _, reason in LOST}


def test_as_many_names_as_quantities(extracted):
    assert recipes(extracted).filter("size(ingredients) != size(quantities)").count() == 0


def test_hooks(extracted):
    hooks = [lambda df: df.filter("source = 'vaqueiro'"), lambda df: df.limit(1)]
    assert recipes(extracted, hooks).count() == 1
