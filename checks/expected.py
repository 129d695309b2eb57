"""DuckDB SQL for the records that the rendered pages must give, from `documents` alone."""

from __future__ import annotations

import unicodedata

from checks.render import (
    EMPTY_EVERY,
    NAME_PREFIXES,
    PER_LISTING,
    PREFIXES,
    RECIPE_URLS,
    RUN_CATEGORY,
    SITES,
    SUFFIXES,
)
from pagelarder.functions.phrase import UNITS
from pagelarder.sources import vaqueiro

# White space as an RE2 class.
WS = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]"
)
SEP = " ¦ "


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick(options: list[str], index: str) -> str:
    return f"([{', '.join(map(lit, options))}])[(({index}) % {len(options)} + 1)::INT]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS}+'), lambda t: t <> '')"


def normalize_space(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[ \t\r\n]+', ' ', 'g'), ' ')"


def joined(x: str) -> str:
    return f"array_to_string({x}, {lit(SEP)})"


def ingredient_from_words(w: str, units: str) -> str:
    """Word by word: find the first word that is no unit, as the phrase rules are stated."""
    listed = "|".join(UNITS[units])
    qb = f"list_position({w}, 'q.b.')"
    fp = (
        f"list_position(list_transform({w}, lambda t: "
        f"regexp_matches(t, '^[.]?[0-9]') OR regexp_full_match(t, '(?i)({listed})')), false)"
    )
    return (
        f"CASE WHEN {qb} > 0 THEN array_to_string({w}[:{qb} - 1] || {w}[{qb} + 1:], ' ') "
        f"WHEN coalesce({fp}, 0) = 0 THEN '' "
        f"WHEN {w}[{fp}] IN ('d', 'e', 'de') THEN array_to_string({w}[{fp} + 1:], ' ') "
        f"ELSE array_to_string({w}[{fp}:], ' ') END"
    )


def ingredient(x: str, units: str) -> str:
    """Ingredient name of a phrase; the word list is named once."""
    return (
        f"list_transform([{words(x)}], lambda w: {ingredient_from_words('w', units)})[1]"
    )


def name_field(x: str) -> str:
    plain = strip(f"replace({x}, 'q.b.', '')")
    rest = strip("array_to_string(string_split(p, ' ')[2:], ' ')")
    return (
        f"list_transform([{plain}], lambda p: CASE WHEN split_part(p, ' ', 1) = 'de' "
        f"THEN replace({rest}, '  ', ' ') ELSE p END)[1]"
    )


def nfkd(x: str) -> str:
    """Decompose every character of the Latin blocks that has a decomposition."""
    for code in range(0xA0, 0x180):
        plain = unicodedata.normalize("NFKD", chr(code))
        if plain != chr(code):
            x = f"replace({x}, {lit(chr(code))}, {lit(plain)})"
    return x


def url(site: str) -> str:
    before, after = RECIPE_URLS[site]
    return f"{lit(before)} || doc_id || {lit(after)}"


DOCS = "docs AS (SELECT *, string_split(text, chr(10)) AS lines FROM documents)"

# doc_id -> name of each column and its SQL over `docs`; lists are SQL lists.
_PHRASE = f"{pick(PREFIXES, 'doc_id + i - 1')} || line || {pick(SUFFIXES, 'doc_id * 3 + i - 1')}"


def each(body: str, lines: str = "lines") -> str:
    """List over the lines; `i` counts from 1."""
    return f"list_transform({lines}, lambda line, i: {body})"


def _pingo_doce() -> dict[str, str]:
    return {
        "name": "lines[1]",
        "vegan": "doc_id % 4 IN (1, 2)",
        "cuisine": "CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'vegan' WHEN 2 THEN 'Prato' ELSE lang END",
        "dish_type": "CASE doc_id % 4 WHEN 2 THEN 'vegetariana' WHEN 3 THEN source ELSE '' END",
        "difficulty": "CASE WHEN doc_id % 3 <> 0 THEN 'Fácil ' || doc_id % 3 END",
        "time": "n_chars || ' min'",
        "servings": "CASE WHEN doc_id % 4 = 1 THEN ' ' || doc_id || ' ' END",
        "cost": "''",
        "calories": "''",
        "ingredients": "lines",
        "quantities": each("i || CASE WHEN i % 2 = 1 THEN ' kg' ELSE '' END || ' ' || line"),
        "steps": each("i || '.' || line"),
        "absent_keys": "[]::VARCHAR[]",
        "reason": "CASE WHEN doc_id % 7 = 0 THEN 'ingredient without quantity or product' "
        "WHEN doc_id % 11 = 0 THEN 'step without index or body' END",
    }


def _receitas_portugal() -> dict[str, str]:
    phrase = (
        f"{pick(PREFIXES, 'doc_id + i - 1')} || line || chr(10) || ' ' || "
        f"{pick(SUFFIXES, 'doc_id * 3 + i - 1')}"
    )
    text = strip(normalize_space(phrase))
    return {
        "name": "lines[1]",
        "vegan": "doc_id % 3 = 0",
        "cuisine": "''",
        "dish_type": "CASE doc_id % 3 WHEN 0 THEN 'Vegetariano' WHEN 1 THEN lang END",
        "difficulty": "''",
        "time": "''",
        "servings": "''",
        "cost": "''",
        "calories": "''",
        "ingredients": each(ingredient(text, "receitas_portugal")),
        "quantities": each(text),
        "steps": each("line || ' fim'"),
        "absent_keys": "[]::VARCHAR[]",
        "reason": "CASE WHEN doc_id % 13 = 12 THEN 'no ingredient layout matches' "
        "WHEN doc_id % 17 = 16 THEN 'no step layout matches' END",
    }


def _sabor_intenso() -> dict[str, str]:
    def entries(wrap) -> str:
        own = wrap(strip(f"CASE WHEN (i - 1) % 3 = 0 THEN ({_PHRASE}) || ' ' || lang ELSE {_PHRASE} END"))
        nested = wrap("lang")
        return (
            "flatten(" + each(f"CASE WHEN (i - 1) % 3 = 0 THEN [{own}, {nested}] ELSE [{own}] END") + ")"
        )

    return {
        "name": "lines[1]",
        "vegan": "doc_id % 3 = 2 OR (doc_id % 3 = 1 AND contains('Vegetariana', source))",
        "cuisine": "''",
        "dish_type": "CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN source ELSE 'Veg' END",
        "difficulty": "''",
        "time": "CASE WHEN doc_id % 5 <> 4 THEN n_chars || ' min' ELSE '' END",
        "servings": "CASE WHEN doc_id % 4 <> 3 THEN doc_id || ' pessoas' ELSE '' END",
        "cost": "CASE WHEN doc_id % 5 < 2 THEN doc_id || ' euros' ELSE '' END",
        "calories": "CASE WHEN doc_id % 2 = 0 THEN doc_id::VARCHAR ELSE '' END",
        "ingredients": entries(lambda x: ingredient(x, "sabor_intenso")),
        "quantities": entries(lambda x: x),
        "steps": "flatten(" + each("[' ' || line || 'fim']") + ")",
        "absent_keys": "[]::VARCHAR[]",
        "reason": "NULL::VARCHAR",
    }


def _sapo_sabores() -> dict[str, str]:
    n = "CASE WHEN doc_id % 3 = 0 THEN len(lines) - 1 ELSE len(lines) END"
    cuisine = "CASE WHEN doc_id % 4 = 0 THEN 'Vegetariana' ELSE lang END"
    dish = "CASE WHEN doc_id % 3 = 1 THEN 'Vegetarian' ELSE source END"
    return {
        "name": "lines[1]",
        "vegan": f"(doc_id % 2 = 0 AND contains('Vegetariana', {cuisine})) "
        f"OR (doc_id % 3 <> 0 AND contains('Vegetariano', {dish}))",
        "cuisine": f"CASE WHEN doc_id % 2 = 0 AND doc_id % 10 <> 8 THEN {cuisine} END",
        "dish_type": f"CASE WHEN doc_id % 3 <> 0 THEN {dish} END",
        "difficulty": "CASE WHEN doc_id % 7 <> 0 THEN 'Média' END",
        "time": "CASE WHEN doc_id % 5 > 1 THEN n_chars || ' min' END",
        "servings": "doc_id::VARCHAR",
        "cost": "NULL::VARCHAR",
        "calories": "NULL::VARCHAR",
        "ingredients": f"lines[:{n}]",
        "quantities": each("i || ' kg de ' || line", f"lines[:{n}]"),
        "steps": "flatten(" + each("[line, 'fim']") + ")",
        "absent_keys": "list_filter([CASE WHEN doc_id % 2 = 1 THEN 'gastronomia' END, "
        "CASE WHEN doc_id % 3 = 0 THEN 'tipo' END, CASE WHEN doc_id % 7 = 0 THEN 'dificuldade' END, "
        "CASE WHEN doc_id % 5 = 0 THEN 'tempo' END, 'custo', 'calorias'], lambda k: k IS NOT NULL)",
        "reason": "CASE WHEN doc_id % 10 = 8 THEN 'cuisine row without a link' END",
    }


def _teleculinaria() -> dict[str, str]:
    n = "CASE WHEN doc_id % 9 = 0 THEN len(lines) // 2 ELSE len(lines) END"
    name = f"{pick(NAME_PREFIXES, 'doc_id + i - 1')} || line || {pick(SUFFIXES, 'doc_id + i - 1')}"
    amount = (
        "CASE WHEN (i - 1) % 3 <> 2 THEN i::VARCHAR ELSE '' END || ' ' || "
        "CASE WHEN (i - 1) % 2 = 0 THEN 'kg' ELSE '' END || ' ' || "
    )
    return {
        "name": "lines[1]",
        "vegan": "NULL::BOOLEAN",
        "cuisine": "''",
        "dish_type": "CASE WHEN doc_id % 2 = 0 THEN lang END",
        "difficulty": "CASE WHEN doc_id % 3 = 0 THEN 'Média' END",
        "time": "CASE WHEN doc_id % 4 <> 0 THEN n_chars::VARCHAR ELSE '' END || ' ' || "
        "CASE WHEN doc_id % 4 <> 1 THEN 'min' ELSE '' END",
        "servings": "replace(CASE WHEN doc_id % 3 <> 1 THEN doc_id::VARCHAR ELSE '' END || ' ' || "
        "CASE WHEN doc_id % 3 <> 2 THEN ' pessoas' ELSE '' END, '  ', ' ')",
        "cost": "CASE WHEN doc_id % 5 = 0 THEN 'Baixo' END",
        "calories": "''",
        "ingredients": each(name_field(strip(name)), f"lines[:{n}]"),
        "quantities": each(f"replace({strip(amount + name)}, '  ', ' ')", f"lines[:{n}]"),
        "steps": "lines",
        "absent_keys": "['vegan']",
        "reason": f"CASE WHEN doc_id % 8 = 7 AND ({n}) > 0 THEN 'ingredient without a linked name' "
        "WHEN doc_id % 16 = 3 THEN 'step without text' END",
    }


def _vaqueiro(category: str) -> dict[str, str]:
    phrase = strip(_PHRASE)
    return {
        "name": "lines[1]",
        "vegan": "false",
        "cuisine": "''",
        "dish_type": category,
        "difficulty": "CASE WHEN doc_id % 4 > 2 THEN 'grau ' || doc_id ELSE '' END",
        "time": "CASE WHEN doc_id % 4 > 1 THEN 'tempo ' || doc_id ELSE '' END",
        "servings": "CASE WHEN doc_id % 3 <> 0 THEN doc_id || ' doses' END",
        "cost": "CASE WHEN doc_id % 4 > 0 THEN 'custo ' || doc_id ELSE '' END",
        "calories": "''",
        "ingredients": each(ingredient(phrase, "vaqueiro")),
        "quantities": each(phrase),
        "steps": "CASE WHEN doc_id % 6 = 5 THEN []::VARCHAR[] ELSE "
        + each(nfkd("i || '. ' || line"))
        + " END",
        "absent_keys": "[]::VARCHAR[]",
        "reason": "CASE WHEN doc_id % 12 = 11 THEN 'no name' END",
    }


def records(site: str, category: str = lit(RUN_CATEGORY)) -> str:
    """SELECT of all pages of a site: record columns as compared, `reason`, and doc_id."""
    columns = _vaqueiro(category) if site == "vaqueiro" else globals()[f"_{site}"]()
    lists = ("ingredients", "quantities", "steps", "absent_keys")
    select = ", ".join(
        f"{joined(sql) if name in lists else sql} AS {name}" for name, sql in columns.items()
    )
    counts = ", ".join(f"len({columns[n]}) AS n_{n}" for n in ("ingredients", "quantities", "steps"))
    return f"SELECT doc_id, {lit(site)} AS source, {url(site)} AS url, {select}, {counts} FROM docs"


COLUMNS = (
    "source, url, name, vegan, cuisine, dish_type, difficulty, time, servings, cost, calories, "
    "ingredients, quantities, steps, absent_keys, n_ingredients, n_quantities, n_steps"
)


def site_records(site: str, category: str = lit(RUN_CATEGORY)) -> str:
    return (
        f"WITH {DOCS}, r AS ({records(site, category)}) "
        f"SELECT {COLUMNS} FROM r WHERE reason IS NULL"
    )


def all_records(sites: list[str], category: str = lit(RUN_CATEGORY)) -> str:
    return " UNION ALL ".join(f"({records(s, category)})" for s in sites)


def visited() -> str:
    """(source, doc_id) that the runs of `render.runs` reach."""
    last = f"(SELECT max(doc_id) // {PER_LISTING} FROM documents)"
    page = f"doc_id // {PER_LISTING} + 1"
    most = {c[0]: c[2] for c in vaqueiro.CATEGORIES}[RUN_CATEGORY]
    parts = []
    for site in SITES:
        inside = f"{page} BETWEEN 2 AND {last}"
        if site == "vaqueiro":
            inside = f"{page} BETWEEN 2 AND greatest(2, least({last}, {most}))"
        if site == "receitas_portugal":
            inside += f" AND {page} < {EMPTY_EVERY}"
        # Document 0 is linked from every listing page.
        parts.append(
            f"SELECT {lit(site)} AS source, doc_id FROM documents WHERE {inside} OR doc_id = 0"
        )
    return " UNION ALL ".join(parts)
