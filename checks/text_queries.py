"""String, list, map and phrase functions over every line of `documents` and `part`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import expected as sql
from checks.expected import SEP, lit
from checks.render import NAME_PREFIXES, PREFIXES, SUFFIXES, phrase, pick
from pagelarder.functions import lists, text
from pagelarder.functions import phrase as phrases
from pagelarder.functions.unicode import nfkd

LINES_SQL = (
    "lines AS (SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line, "
    "generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)"
)
PHRASE_SQL = (
    f"phrases AS (SELECT *, {sql.pick(PREFIXES, 'doc_id + i')} || line || "
    f"{sql.pick(SUFFIXES, 'doc_id * 3 + i')} AS phrase FROM lines)"
)


def all_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_documents(spark, sf_dir).select(
        "doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("i", "line")
    )


def phrase_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).withColumn(
        "phrase", phrase(F.col("doc_id"), F.col("i"), F.col("line"))
    )


def joined(items):
    return F.array_join(items, SEP)


UNIT_LISTS = ("sabor_intenso", "vaqueiro", "receitas_portugal")


def phrase_names(spark, sf_dir):
    return phrase_rows(spark, sf_dir).select(
        "doc_id", "i",
        *[phrases.ingredient_name(F.col("phrase"), phrases.UNITS[u]).alias(u) for u in UNIT_LISTS],
    )


PHRASE_NAMES_SQL = (
    f"WITH {LINES_SQL}, {PHRASE_SQL}, w AS (SELECT *, {sql.words('phrase')} AS w FROM phrases) "
    "SELECT doc_id, i, "
    + ", ".join(f"{sql.ingredient_from_words('w', u)} AS {u}" for u in UNIT_LISTS)
    + " FROM w"
)


def strip_and_words(spark, sf_dir):
    p = F.col("phrase")
    return phrase_rows(spark, sf_dir).select(
        "doc_id", "i",
        text.strip(p).alias("stripped"),
        F.array_join(text.words(p), "|").alias("words"),
        F.size(F.split(p, " ")).alias("space_parts"),
        text.single_spaced(p).alias("single_spaced"),
        text.delete(p, "q.b.", "de ").alias("deleted"),
        text.normalize_space(F.concat(p, F.lit("\n \t"), p)).alias("normalized"),
    )


STRIP_AND_WORDS_SQL = f"""WITH {LINES_SQL}, {PHRASE_SQL}
SELECT doc_id, i, {sql.strip('phrase')} AS stripped,
array_to_string({sql.words('phrase')}, '|') AS words,
len(string_split(phrase, ' '))::INT AS space_parts, replace(phrase, '  ', ' ') AS single_spaced,
replace(replace(phrase, 'q.b.', ''), 'de ', '') AS deleted,
{sql.normalize_space("phrase || chr(10) || ' ' || chr(9) || phrase")} AS normalized FROM phrases"""


def delimiters(spark, sf_dir):
    line = F.col("line")
    return lines(spark, sf_dir).select(
        "doc_id", "i",
        text.after_last(line, ",").alias("after_last"),
        text.before_first(line, ",").alias("before_first"),
        text.substring_after(line, " de ").alias("after_mark"),
        text.concat_missing_as_empty(
            F.when(F.col("i") % 2 == 0, F.col("lang")), F.lit(" "),
            F.when(F.col("i") % 3 == 0, F.col("source")),
        ).alias("concatenated"),
    )


DELIMITERS_SQL = f"""WITH {LINES_SQL}
SELECT doc_id, i, split_part(line, ',', -1) AS after_last, split_part(line, ',', 1) AS before_first,
CASE WHEN strpos(line, ' de ') > 0 THEN substr(line, strpos(line, ' de ') + 4) ELSE '' END AS after_mark,
CASE WHEN i % 2 = 0 THEN lang ELSE '' END || ' ' || CASE WHEN i % 3 = 0 THEN source ELSE '' END
AS concatenated FROM lines"""


def clean_text_blocks(spark, sf_dir):
    documents = all_documents(spark, sf_dir)
    broken = F.replace("text", F.lit(". "), F.lit(" . \x85\t \r\n"))
    blanks = F.flatten(F.transform(
        F.split("text", "\n"),
        lambda x: F.array(F.concat(F.lit(" "), x, F.lit("\r\n")), F.lit(" \n"), F.lit(" "), F.lit("")),
    ))
    return documents.select(
        "doc_id",
        joined(text.clean_lines(broken)).alias("lines"),
        joined(text.drop_blank(blanks)).alias("not_blank"),
    )


_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_BROKEN = "replace(text, '. ', ' .' || chr(8232) || chr(133) || chr(9) || ' ' || chr(13) || chr(10))"
CLEAN_TEXT_BLOCKS_SQL = f"""SELECT doc_id, array_to_string(list_filter(list_transform(
string_split_regex({_BROKEN}, '{_BREAK}'), lambda x: {sql.strip('x')}), lambda x: x <> ''), {lit(SEP)}) AS lines,
array_to_string(list_transform(string_split(text, chr(10)), lambda x: ' ' || x), {lit(SEP)}) AS not_blank
FROM documents"""


def zip_shortest(spark, sf_dir):
    return lines(spark, sf_dir).select(
        "doc_id", "i",
        joined(lists.zip_shortest(
            F.split("line", " "), F.split("line", ","),
            lambda name, amount: phrases.quantity_of(amount, name),
        )).alias("pairs"),
    )


ZIP_SHORTEST_SQL = f"""WITH {LINES_SQL},
parts AS (SELECT doc_id, i, string_split(line, ' ') AS a, string_split(line, ',') AS b FROM lines)
SELECT doc_id, i, array_to_string(list_transform(range(1, least(len(a), len(b)) + 1),
lambda k: b[k] || ' de ' || a[k]), {lit(SEP)}) AS pairs FROM parts"""


def _name_rows(spark, sf_dir):
    i = F.col("i")
    return lines(spark, sf_dir).select(
        "doc_id", "i", "line",
        F.concat(
            pick(NAME_PREFIXES, F.col("doc_id") + i), F.col("line"), pick(SUFFIXES, F.col("doc_id") + i)
        ).alias("name"),
        F.when(i % 3 != 2, i.cast("string")).alias("amount"),
        F.when(i % 2 == 0, F.lit("kg")).alias("unit"),
    )


def quantity_texts(spark, sf_dir):
    amount, unit, name = F.col("amount"), F.col("unit"), F.col("name")
    return _name_rows(spark, sf_dir).select(
        "doc_id", "i",
        phrases.name_field(text.strip(name)).alias("ingredient"),
        phrases.quantity_fields(amount, unit, name).alias("fields"),
        phrases.quantity_with_unit(amount, unit, F.col("line")).alias("with_unit"),
        phrases.quantity_of(amount, name).alias("of_name"),
    )


QUANTITY_TEXTS_SQL = f"""WITH {LINES_SQL}, n AS (SELECT *,
{sql.pick(NAME_PREFIXES, 'doc_id + i')} || line || {sql.pick(SUFFIXES, 'doc_id + i')} AS name,
CASE WHEN i % 3 <> 2 THEN i::VARCHAR END AS amount, CASE WHEN i % 2 = 0 THEN 'kg' END AS unit FROM lines)
SELECT doc_id, i, {sql.name_field(sql.strip('name'))} AS ingredient,
replace({sql.strip("coalesce(amount, '') || ' ' || coalesce(unit, '') || ' ' || name")}, '  ', ' ') AS fields,
CASE WHEN unit IS NULL THEN amount ELSE amount || ' ' || unit END || ' ' || line AS with_unit,
amount || ' de ' || name AS of_name FROM n"""


def membership(spark, sf_dir):
    """Words of each document that are a part of a word, and those that are one of a list."""
    words = F.split("text", " ")

    def count(test):
        return F.size(F.filter(words, test)).cast("long")

    return all_documents(spark, sf_dir).select(
        "doc_id",
        count(lambda w: text.part_of(w, "anderen")).alias("part_of_a"),
        count(lambda w: text.part_of(w, "enterrado")).alias("part_of_b"),
        count(lambda w: w.isin("the", "der", "de", "und")).alias("exact"),
        text.part_of(F.col("lang"), "defensive").alias("lang_part"),
    )


MEMBERSHIP_SQL = """WITH w AS (SELECT doc_id, lang, string_split(text, ' ') AS w FROM documents)
SELECT doc_id, len(list_filter(w, lambda x: contains('anderen', x))) AS part_of_a,
len(list_filter(w, lambda x: contains('enterrado', x))) AS part_of_b,
len(list_filter(w, lambda x: x IN ('the', 'der', 'de', 'und'))) AS exact,
contains('defensive', lang) AS lang_part FROM w"""


def list_positions(spark, sf_dir):
    documents = all_documents(spark, sf_dir)
    items = F.col("items")
    return documents.select("doc_id", F.split("text", "\n").alias("items")).select(
        "doc_id",
        lists.first(items).alias("first"),
        lists.nth(items, 2).alias("third"),
        joined(lists.head(items, 3)).alias("first_three"),
        joined(lists.first_half(items)).alias("first_half"),
        joined(lists.first_non_empty(F.slice(items, 5, 2), F.slice(items, 2, 1), items)).alias("fallback"),
    )


LIST_POSITIONS_SQL = f"""WITH {sql.DOCS} SELECT doc_id, lines[1] AS first, lines[3] AS third,
array_to_string(lines[:3], {lit(SEP)}) AS first_three,
array_to_string(lines[:len(lines) // 2], {lit(SEP)}) AS first_half,
array_to_string(CASE WHEN len(lines) >= 5 THEN lines[5:6] WHEN len(lines) >= 2 THEN lines[2:2] ELSE lines END,
{lit(SEP)}) AS fallback FROM docs"""


def indexed_maps(spark, sf_dir):
    documents = all_documents(spark, sf_dir)
    as_json = F.to_json(lists.indexed_map(F.split("text", " ")))
    back = F.from_json("json", "map<string,string>")
    return documents.select("doc_id", as_json.alias("json")).select(
        "doc_id",
        F.array_join(F.json_object_keys("json"), ",").alias("keys"),
        F.array_join(lists.from_indexed_map(back), " ").alias("text"),
    )


INDEXED_MAPS_SQL = """SELECT doc_id, array_to_string(range(len(string_split(text, ' '))), ',') AS keys, text
FROM documents"""


def unicode_nfkd(spark, sf_dir):
    documents = all_documents(spark, sf_dir)
    return documents.select("doc_id", nfkd(F.concat(F.lit("½ªﬁ "), "text")).alias("text"))


UNICODE_NFKD_SQL = (
    f"SELECT doc_id, '1' || chr(8260) || '2afi ' || {sql.nfkd('text')} AS text FROM documents"
)

QUERIES = {
    "phrase_names": (phrase_names, PHRASE_NAMES_SQL),
    "strip_and_words": (strip_and_words, STRIP_AND_WORDS_SQL),
    "delimiters": (delimiters, DELIMITERS_SQL),
    "clean_text_blocks": (clean_text_blocks, CLEAN_TEXT_BLOCKS_SQL),
    "zip_shortest": (zip_shortest, ZIP_SHORTEST_SQL),
    "quantity_texts": (quantity_texts, QUANTITY_TEXTS_SQL),
    "membership": (membership, MEMBERSHIP_SQL),
    "list_positions": (list_positions, LIST_POSITIONS_SQL),
    "indexed_maps": (indexed_maps, INDEXED_MAPS_SQL),
    "unicode_nfkd": (unicode_nfkd, UNICODE_NFKD_SQL),
}
