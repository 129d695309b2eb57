"""Each operator on small tables: nulls, empty and long texts, ties, repeated rows, empty tables,
extra columns with the names that operators use, and a plain Python version where SQL has none."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from pagelarder.llm import (
    contamination, exact, line_runs, main_text, mixing, odd_sketch, quality, shingles, token_shards,
    unit_dedup, warc,
)
from pagelarder.llm.common import shared_folder
from pagelarder.llm.components import components

# Extra columns have names that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, rank int"
SPACES = "[\\x20\\x09-\\x0D]"


def frame(spark, rows):
    """Rows (doc_id, text, source)."""
    full = [(i, t, "en", s, len(t or ""), "x", "y", 1) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeimnorst") for _ in range(r.randint(2, 8))) for _ in range(n))


LONG = prose(1, 30_000)
ODD_ROWS = [
    (None, None, None), (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", "b"),
    (5, LONG, "b"), (6, LONG, "b"), (6, LONG, "b"), (7, "x" * 5000, "c"), (None, "one", "c"),
]


def test_exact_duplicates(spark):
    rows = [*ODD_ROWS, (20, "a  b", "a"), (21, "a b", "a"), (22, "ab", "a"), (23, "a b ", "a"),
            (24, LONG + "!", "a"), (25, LONG + " ?", "a")]
    found = exact.exact_duplicates(frame(spark, rows)).collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(SPACES, "", t or "")].append((-len(t or ""), math.inf if i is None else i, i))
    expected = Counter()
    for plain, members in groups.items():
        keep = min(members, key=lambda m: m[:2])[2]
        for n, m in enumerate(sorted(members, key=lambda m: m[:2])):
            expected[m[2], keep, len(members), n == 0, hashlib.sha256(plain.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in found) == expected


def test_empty_tables(spark):
    docs = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    assert exact.exact_duplicates(docs).isEmpty()
    assert odd_sketch.near_duplicates(docs).isEmpty()
    assert contamination.contained_items(docs, items).isEmpty()
    assert contamination.without_contaminated(frame(spark, ODD_ROWS), items).count() == len(ODD_ROWS)
    assert quality.quality_scores(docs, labels).isEmpty()
    assert unit_dedup.without_repeats(docs).isEmpty()
    assert line_runs.without_repeated_lines(docs).isEmpty()
    assert mixing.rated(docs).isEmpty()
    assert token_shards.materialised(spark, docs).isEmpty()
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert main_text.extract_main_text(pages).isEmpty()
    assert warc.round_trip(spark, pages).isEmpty()


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    found = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert found == {x: c for x, c in root.items() if any(a != b and x in (a, b) for a, b in edges)}


def _shingles(text):
    words = re.findall("[^\\x20\\x09-\\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates_against_all_pairs(spark):
    """A group of edited copies around the threshold, as many as fill several blocks."""
    r, rows = random.Random(5), list(ODD_ROWS)
    base = prose(9, 120).split()
    for i in range(100, 420):
        words = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 5])):
            words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
        rows.append((i, " ".join(words), "a"))
    found = odd_sketch.near_duplicates(frame(spark, rows), similarity=85).collect()
    sets = [(i, _shingles(t)) for i, t, _ in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    expected = sorted((i, len(a), find(i), i == find(i)) for i, a in sets)
    assert sorted(tuple(x) for x in found if x.doc_id is not None) == expected
    assert [tuple(x)[2:] for x in found if x.doc_id is None] == [(None, True)] * 2


def test_a_cluster_moves_its_sets_once(spark):
    """5,000 texts that link to one leader: a row each and the leader's; then nothing is left to compare."""
    n = 5000
    pairs = spark.range(1, n).selectExpr("id", "0L AS leader", "0.9D AS est")
    counts = spark.range(n).selectExpr("id", "100L AS n_shingles")
    tasks = odd_sketch._star_tasks(pairs, counts)
    sizes = {x.task: x["count"] for x in tasks.groupBy("task").count().collect()}
    assert n <= sum(sizes.values()) <= n - 1 + len(sizes) and len(sizes) <= -(-n // odd_sketch.SET_ROWS)
    assert max(sizes.values()) < 2 * odd_sketch.SET_ROWS
    one = counts.selectExpr("id", "0L AS cluster", "0L AS joined", "n_shingles")
    assert odd_sketch._cross_tasks(one).isEmpty()
    # Long texts make smaller blocks.
    long = counts.selectExpr("id", f"{odd_sketch.SET_SHINGLES}L AS n_shingles")
    assert odd_sketch._star_tasks(pairs, long).select("task").distinct().count() > n / 4


def test_components_of_a_cluster_meet_and_never_themselves(spark):
    """Two large components and 40 rows alone: all pairs across meet in some task, others need not."""
    rows = [(i, 0, 0 if i < 1500 else 1500 if i < 2200 else i, 100) for i in range(2240)]
    members = spark.createDataFrame(rows, "id long, cluster long, joined long, n_shingles long")
    found = odd_sketch._cross_tasks(members).collect()
    tasks = {}
    for x in found:
        tasks.setdefault(x.task, {}).setdefault(x.block, []).append((x.id, x.joined))
    met = set()
    for blocks in tasks.values():
        assert len({j for rows in blocks.values() for _, j in rows}) > 1
        sides = list(blocks.values())
        met |= {frozenset((a, b)) for a, x in sides[0] for b, y in sides[-1] if x != y}
    of = {i: j for i, _, j, _ in rows}
    assert met == {frozenset((a, b)) for a in of for b in range(a) if of[a] != of[b]}
    # A large component meets the rows alone once and the other large one, not itself.
    assert len(found) < 2240 * 6


def test_links_that_no_leader_has_are_found(spark):
    """Copies of copies drift away from the first text; rows of equal id and text are repeated."""
    r, rows, words = random.Random(8), [], prose(17, 100).split()
    for i in range(60):
        rows.append((i, " ".join(words), "a"))
        words = list(words)
        words[r.randrange(len(words))] = f"w{i}"
    rows += [rows[0]] * 30 + [rows[7]] * 30
    found = odd_sketch.near_duplicates(frame(spark, rows), similarity=85).collect()
    assert {x.component_id for x in found} == {0} and len(found) == len(rows)


def test_rows_of_one_id_carry_the_links_of_each(spark):
    a, b = prose(91, 60), prose(92, 60)
    rows = [(1, a, "x"), (1, b, "x"), (2, b + " word", "x"), (3, a + " word", "x"), (4, prose(93, 60), "x"),
            (5, "  " + a, "x"), (6, None, "x"), (6, b, "x")]
    found = {x.doc_id: x.component_id for x in odd_sketch.near_duplicates(frame(spark, rows)).where("n_shingles > 0").collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1, 6: 1}


def test_clashing_names(spark):
    """Columns with any name that mixing, scoring and filtering use inside stay as they are."""
    names = ["_size", "_target", "_cut", "_fill", "_mean", "_point", "_source", "_source_size", "_copies", "_copy",
             "_of", "_u", "_whole", "_lam", "row", "_score", "_bad", "score"]
    docs = frame(spark, ODD_ROWS)
    for n, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(n))
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    assert {tuple(x)[-len(names):] for x in mix.collect()} == {tuple(range(len(names)))}
    rated = mixing.rated(docs)
    assert rated.columns[-4:] == ["_size", "_source_size", "_target", "_copies"] and rated.count() == len(ODD_ROWS)
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.good_documents(docs, labels).columns == docs.columns
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    clean = contamination.without_contaminated(docs, items)
    assert clean.columns == docs.columns and clean.count() == len(ODD_ROWS) - 3


def test_every_gap_of_a_mix_is_filled(spark):
    """Few documents far larger than the rest: the target is met by many small ones."""
    rows = [(i, "w " * 3000, "a") for i in range(6)] + [(100 + i, "w " * (1 + i % 9), "a") for i in range(400)]
    rows += [(1000 + i, "w " * 50, "b") for i in range(200)]
    found = mixing.rated(frame(spark, rows)).collect()
    for source, least in (("a", 1), ("b", 50)):
        own = [x for x in found if x.source == source]
        assert 0 <= own[0]._target - sum(x._size * x._copies for x in own) < least, source


def test_long_white_space_has_tokens(spark):
    coder = token_shards.encoder(token_shards.VOCABULARY)
    for gap in (" " * 1500, "\n" * 1200, "\t \u3000" * 500):
        for text in (f"a{gap}", f"a{gap}b 1{gap}\n!", f"{gap}x"):
            assert token_shards.encode(text).tolist() == [*coder.encode_ordinary(text), token_shards.END]
    for text in (" " * 10_000_000, "a" + "\n" * 1_000_000 + "b"):
        assert coder.decode(token_shards.encode(text)[:-1].tolist()) == text
    docs = frame(spark, [*ODD_ROWS, (80, "a" + " " * 1_000_000 + "b", "a")])
    assert token_shards.materialised(spark, docs).agg(F.sum("n_tokens")).first()[0] == sum(
        len(token_shards.encode(x.text)) for x in docs.collect()
    )


def _lines_left(texts, least_lines=3, least_words=50):
    """Brute force: windows of lines that stand earlier, in order of documents, and count, are deleted."""
    lines = {i: [x.strip(" \t\n\x0b\x0c\r") for x in (t or "").split("\n")] for i, t in texts}
    lines = {i: [x for x in rows if x] for i, rows in lines.items()}
    seen, left = set(), {}
    for i in sorted(lines):
        own, gone = lines[i], set()
        for start in range(len(own)):
            for stop in range(start + 1, len(own) + 1):
                window = tuple(own[start:stop])
                if stop - start >= least_lines or sum(len(x.split()) for x in window) >= least_words:
                    if window in seen:
                        gone.update(range(start, stop))
                    seen.add(window)
        left[i] = [x for n, x in enumerate(own) if n not in gone]
    return left


def test_line_runs_against_all_windows(spark):
    r = random.Random(12)
    pool = [prose(i, r.choice([1, 3, 8, 30, 60])) for i in range(40)]
    texts = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 12)))) for i in range(60)]
    texts += [(100 + i, "\n".join(pool[i : i + 15] + ["", f"end {i}"])) for i in range(20)] + [(200, texts[5][1])]
    found = line_runs.without_repeated_lines(frame(spark, [(i, t, "a") for i, t in texts])).collect()
    expected = _lines_left(texts)
    assert {x.doc_id: [y for y in x.text.split("\n") if y] for x in found} == expected


def test_shingle_hashes_do_not_depend_on_segments(monkeypatch):
    whole = shingles.word_hashes(LONG)
    monkeypatch.setattr(shingles, "_SEGMENT", 1000)
    assert (shingles.word_hashes(LONG) == whole).all()
    assert len(whole) == 30_000


def test_contained_items(spark):
    item = prose(11, 30)
    words = item.split()
    rows = [*ODD_ROWS, (30, f"{LONG} {item.upper()}! {LONG}", "a"), (31, " ".join(words[:20]), "a"),
            (32, " ".join(words[:28]), "a")]
    items = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, "too short"), (None, item), (4, LONG)], "item_id long, text string"
    )
    found = {tuple(x) for x in contamination.contained_items(frame(spark, rows), items).collect()}
    n = len(_shingles(LONG))
    assert found == {(30, 1, 26, 26), (32, 1, 26, 24), (5, 4, n, n), (6, 4, n, n), (30, 4, n, n)}
    clean = contamination.without_contaminated(frame(spark, rows), items)
    assert clean.columns == frame(spark, rows).columns
    assert clean.count() == len(rows) - 5


def test_mixing_meets_targets(spark):
    r = random.Random(8)
    rows = [(i, prose(i, r.randint(1, 60)), r.choice(["s1", "s1", "s2", "s3", None])) for i in range(600)]
    docs = frame(spark, rows)
    first = sorted(map(str, mixing.rated(docs).collect()))
    assert first == sorted(map(str, mixing.rated(docs.repartition(7)).collect()))
    found = mixing.rated(docs).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    goal, total, free = {}, 1.5 * sum(sizes.values()), set(sizes)
    while free:
        level = (total - sum(goal.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level >= 2 * sizes[s]]
        for s in over or free:
            goal[s] = 2.0 * sizes[s] if over else weight[s] * level
        free -= set(over or free)
    taken = Counter()
    for x in found:
        assert x._source_size == sizes[x.source] and math.isclose(x._target, goal[x.source], rel_tol=1e-9)
        assert 0 <= x._copies <= 2
        taken[x.source] += x._size * x._copies
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 3, s
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns and mix.count() == sum(x._copies for x in found)
    assert mixing.rated(frame(spark, ODD_ROWS)).count() == len(ODD_ROWS)


def test_rates_tilt_by_size(spark):
    """Within a source longer documents have rates further from 1, all on one side."""
    docs = frame(spark, [(i, prose(i, 1 + i % 50), "ab"[i % 2]) for i in range(800)])
    by = defaultdict(list)
    for x in mixing.rated(docs).collect():
        by[x.source, x._size > 25].append(x._copies)
    for s, up in (("a", True), ("b", False)):
        short, long = (sum(by[s, k]) / len(by[s, k]) for k in (False, True))
        assert (long >= short) == up


def cut_text(spark, rows):
    return {x.doc_id: x for x in unit_dedup.without_repeats(frame(spark, rows)).collect()}


def test_units_and_spans(spark):
    passage = prose(21, 60) + "."
    rows = [*ODD_ROWS, (50, f"Own words come first here. {passage.upper()}\nend", "a"),
            (51, f"Other text {prose(22, 9)}. {passage} {prose(23, 12)}.", "a"), (52, prose(24, 80), "a")]
    result = unit_dedup.without_repeats(frame(spark, rows)).collect()
    assert len(result) == len(rows)
    found = {x.doc_id: x for x in result}
    assert {i for i, x in found.items() if x.removed} == {6, 51}
    text = dict((i, t) for i, t, _ in rows)[51]
    span = found[51].removed[0]
    assert text[span.start : span.stop] == passage and span.keep_doc_id == 50 and found[51].keep_doc_ids == [50]
    assert found[51].text == text.replace(passage, "")
    assert found[6].text == "" and found[6].keep_doc_ids == [5]
    assert found[1].text is None and found[2].text == "" and found[52].text == rows[-1][1]


def test_short_lines_and_paragraphs(spark):
    line, block = prose(41, 6), "\n".join(prose(i, 3) for i in range(42, 46))
    rows = [
        (80, f"{line}\nmine", "a"), (81, f"first of all\n  {line.upper()} \nlast", "a"),
        (82, f"{block}\n\nmine", "a"), (83, f"yours\n\n{block}\n \nrest", "a"),
        (84, f"no {line}", "a"), (85, f"{line}\n{line}", "a"), (86, block.replace("\n", " and "), "a"),
    ]
    found = cut_text(spark, rows)
    assert found[81].text == "first of all\nlast" and found[81].keep_doc_ids == [80]
    assert found[83].text == "yours\n\n \nrest" and found[83].keep_doc_ids == [82]
    assert found[85].text == "" and len(found[85].removed) == 1
    assert {i for i, x in found.items() if not x.removed} == {80, 82, 84, 86}


def plain_cut(rows):
    """Texts without later units, by one pass over all units in the order of (doc_id, start)."""
    listed = []
    for i, text, _ in rows:
        text, at, lines = text or "", 0, []
        for line in text.split("\n"):
            lines.append((at, min(len(text), at + len(line) + 1), line))
            at += len(line) + 1
        spans = [(a, b, line, True) for a, b, line in lines]
        group = []
        for a, b, line in [*lines, (0, 0, "")]:
            if line.split():
                group.append((a, b))
            elif group:
                spans.append((group[0][0], group[-1][1], text[group[0][0] : group[-1][1]], True))
                group = []
        for a, _, line in lines:
            ends = [m.end() for m in re.finditer(r"[.]+(?=\s|$)", line)]
            for x, y in zip([0, *ends], [*ends, len(line)], strict=True):
                part = line[x:y]
                lead = len(part) - len(part.lstrip())
                spans.append((a + x + lead, a + x + len(part.rstrip()), part, False))
        listed += [(i, a, b, tuple(s.lower().split()), whole) for a, b, s, whole in spans]
    listed = [u for u in listed if len(u[3]) >= 5]
    first = {}
    for i, a, _, words, _ in listed:
        first[words] = min(first.get(words, (i, a)), (i, a))
    texts = {}
    for i, text, _ in rows:
        text = text or ""
        gone = [False] * len(text)

        def later(u):
            # A line that is one sentence may start before it, with its indentation.
            return first[u[3]] < (u[0], u[1]) and (u[4] or first[u[3]] < (u[0], line_of(u)))

        def line_of(u, text=text):
            at = text.rfind("\n", 0, u[1]) + 1
            return at if not text[at : u[1]].strip() else u[1]

        mine = [u for u in listed if u[0] == i]
        run = []
        for u in [*sorted(u for u in mine if not u[4]), None]:
            if u and later(u):
                run.append(u)
                continue
            if sum(len(v[3]) for v in run) >= 25:
                gone[run[0][1] : run[-1][2]] = [True] * (run[-1][2] - run[0][1])
            run = []
        for u in mine:
            if u[4] and later(u):
                gone[u[1] : u[2]] = [True] * (u[2] - u[1])
        texts[i] = "".join(c for c, g in zip(text, gone, strict=True) if not g)
    return texts


def test_units_against_a_plain_version(spark):
    r = random.Random(5)
    pool = [prose(i, r.randint(3, 12)) for i in range(300, 330)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(r.randint(1, 9)):
            if r.random() < 0.2:
                lines.append("")
            elif r.random() < 0.5:
                lines.append(r.choice(pool))
            else:
                lines.append(" ".join(r.choice([*pool, prose(1000 + i, 7)]) + "." for _ in range(r.randint(1, 5))))
        rows.append((i, "\n".join(lines), "a"))
    expected = plain_cut(rows)
    found = cut_text(spark, rows)
    assert {i: x.text for i, x in found.items()} == expected
    # No later copy of a line of five words stays, and of every line one copy does.
    seen = Counter(" ".join(x.split()) for i in sorted(found) for x in found[i].text.split("\n"))
    assert all(n == 1 for x, n in seen.items() if len(x.split()) >= 5)
    for x in found.values():
        text = rows[x.doc_id][1]
        left = text
        for s in reversed(x.removed):
            left = left[: s.start] + left[s.stop :]
        assert left == x.text and all(a.stop < b.start for a, b in zip(x.removed, x.removed[1:]))


def test_repeated_line_runs(spark):
    a = [prose(i, 5) for i in range(40)]
    rows = [*ODD_ROWS, (60, "\n".join(a), "a"), (61, "\n".join(["new", *a[5:12], "", a[12], "last", a[30]]), "a"),
            (62, "\n".join(["same"] * 9), "a")]
    found = {x.doc_id: x for x in line_runs.without_repeated_lines(frame(spark, rows)).collect() if x.doc_id}
    assert found[61].text == "\n".join(["new", "last", a[30]]) and found[61].n_deleted == 8
    run = found[61].runs[0]
    assert (run.first_line, run.last_line, run.keep_doc_id, run.keep_line) == (1, 8, 60, 5)
    assert found[60].text == rows[-3][1] and not found[60].runs
    assert found[62].text == "same" and found[1].text is None and found[5].text == LONG


def test_repeated_lines_of_many_words(spark):
    one, two = prose(31, 60), [prose(32, 30), prose(33, 25)]
    short = [prose(i, 4) for i in range(200, 240)]
    rows = [
        (70, one, "a"), (71, one, "a"), (72, "\n".join(["mine", one, "rest"]), "a"),
        (73, "\n".join(two), "a"), (74, "\n".join(["x", *two, "y"]), "a"), (75, two[0], "a"),
        (76, "\n".join(short[:3]), "a"), (77, "\n".join(short), "a"), (78, "\n".join(["z", *short]), "a"),
        (79, "\n".join(short[20:22]), "a"),
    ]
    found = {x.doc_id: x for x in line_runs.without_repeated_lines(frame(spark, rows)).collect()}
    assert [found[i].text for i in (70, 71, 72)] == [one, "", "mine\nrest"]
    assert [found[i].text for i in (73, 74, 75)] == ["\n".join(two), "x\ny", two[0]]
    # A run goes back to one document, even if its first three lines stand in an earlier one.
    assert found[77].text == "\n".join(short[3:]) and found[78].text == "z"
    assert [tuple(x)[:4] for x in found[78].runs] == [(1, 40, 77, 0)]
    assert found[79].text == rows[-1][1]


def test_main_text():
    page = """<html><head><title>t</title><style>x</style></head><body><nav><a href=/>Home</a></nav>
    <div class="cookie-notice"><p>We use cookies, a lot of them, all over the place.</p></div>
    <header>Site</header><div id=main><article><header><h1>Title &amp; more</h1></header>
    <p>First  <b>para</b>\n graph &eacute;.<p>Second <a href=x>link</a>, and&nbsp;more<br>text.
    <aside>Aside</aside><form>Form</form><script>var a = "</p>";</script></article>
    <div class="comments"><p>I do not agree at all with what is said here.</p></div></div>
    <footer>Foot</footer></body></html>"""
    assert main_text.main_text(page) == "Title & more\nFirst para graph é.\nSecond link, and more text."
    assert main_text.main_text(None) == main_text.main_text("") == main_text.main_text("<nav>x</nav>") == ""
    assert main_text.main_text("just &lt;text") == "just <text"
    assert main_text.main_text("<p>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_main_text_of_wrapped_and_sectioned_articles():
    long = [prose(i, 60) for i in range(4)]
    paragraphs = "".join(f"<p>{x}</p>" for x in long[:3])
    whole = "\n".join(["Title", "A lead.", *long[:3], "The last."])
    inside = f"<h1>Title</h1><p>A lead.</p><div class=body>{paragraphs}</div><p>The last.</p>"
    sections = f"<section><h1>Title</h1><p>A lead.</p></section><section>{paragraphs}</section><section><p>The last.</p></section>"
    for content in (inside, sections):
        for name in ("article", "main"):
            assert main_text.main_text(f"<body><div><{name}>{content}</{name}></div></body>") == whole
    # Without either, blocks beside the winner count by their own density, also those without blocks.
    page = "<body><div><{0}>" + long[3] + "</{0}><div>" + paragraphs + "</div><p>x y</p></div></body>"
    for name in ("p", "pre", "blockquote", "h2"):
        assert main_text.main_text(page.format(name)) == "\n".join([long[3], *long[:3]])
    # A dense block with more bare text than its one short block is taken whole.
    page = f"<body><div><div>{long[3]}<p>Short.</p></div><div>{paragraphs}</div></div></body>"
    assert main_text.main_text(page) == "\n".join([long[3], "Short.", *long[:3]])


def test_main_text_inside_wrappers_with_side_words():
    text = [prose(i, 40) for i in range(3)]
    inside = "".join(f"<p>{x}</p>" for x in text)
    wrappers = ["div class='site has-sidebar'", "div class=no-sidebar", "div class=ad-free", "div id=search-page",
                "section id=related-work", "div class=share-your-story", "form action=/", "div class=sidebar-right",
                "div class=widget", "div role=form"]
    sides = ["<div class=sidebar><p>Side.</p></div>", "<div class='x cookie-notice'><p>Notice.</p></div>",
             "<div class=comment-list><article class=comment><p>No.</p></article></div>", "<form><p>Mail?</p></form>",
             "<div class=ad-container><p>Buy.</p></div>", "<div id=relatedPosts><p>More.</p></div>"]
    for wrapper in wrappers:
        end = wrapper.split()[0]
        for content in (inside, f"<article>{inside}</article>", f"<main>{inside}</main>"):
            for page in (f"<{wrapper}>{content}{''.join(sides)}</{end}>", f"<{wrapper}>{content}</{end}>{''.join(sides)}"):
                assert main_text.main_text(f"<body>{page}</body>") == "\n".join(text), (wrapper, page)
    # A long side element is no article when there is one elsewhere.
    page = f"<main><article><p>Short.</p></article><div class=comments>{inside}</div></main>"
    assert main_text.main_text(page) == "Short."


def test_main_text_keeps_rows(spark):
    pages = [(None, None, None), (1, "u", ""), (2, "u", "<p>a</p>"), (2, "u", "<p>a</p>")]
    found = main_text.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(None, None, "", 0), (1, "u", "", 0), (2, "u", "a", 1), (2, "u", "a", 1)], key=str
    )


def test_archive_round_trip(spark):
    big, tie = "é" * 200_000, "<p>" + "t" * 120
    pages = [(5, "u\r\n5", tie), (3, None, tie), (3, None, tie), (None, "n", tie), (9, "e", ""), (8, "e", None),
             (7, "s", "short"), (6, "s", "short"), (1, "b", big), (2, "b", big)]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = shared_folder(spark, "test-warc")
    index = warc.write_archive(docs, folder)
    found = Counter((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to)
                    for x in warc.read_records(index, folder).collect())
    expected = Counter()
    for page_id, _, html in pages:
        data = (html or "").encode()
        refers = {tie: 3, big: 1}.get(html)
        refers = None if refers == page_id else refers
        kind = "response" if refers is None else "revisit"
        expected[page_id, len(data), hashlib.sha256(data).hexdigest(), kind, refers] += 1
    assert found == expected
    one = warc.read_records(index.where("page_id = 1"), folder).collect()
    assert [(x.page_id, x.payload) for x in one] == [(1, big)]


def test_permutation_is_a_bijection():
    for count in (1, 2, 3, 17, 1000, 4097):
        slots = token_shards.permuted(np.arange(count), count, 7)
        assert sorted(slots) == list(range(count))
    assert (token_shards.permuted(np.arange(1000), 1000, 7) != token_shards.permuted(np.arange(1000), 1000, 8)).any()


def test_token_shards_round_trip(spark):
    folder = shared_folder(spark, "test-shards")
    manifest = token_shards.write_shards(frame(spark, ODD_ROWS), folder, length=64, per_shard=100)
    rows = {x.slot: np.frombuffer(x.tokens, np.uint16)
            for x in token_shards.read_shards(manifest, folder, 64, 100).collect()}
    texts = Counter(t or "" for _, t, _ in ODD_ROWS)
    slots = token_shards.permuted(np.arange(len(rows)), len(rows), 20240)
    stream = np.concatenate([rows[s] for s in slots])
    found, at = Counter(), 0
    coder = token_shards.encoder(token_shards.VOCABULARY)
    ends = np.flatnonzero(stream == token_shards.END)[: len(ODD_ROWS)]
    for end in ends:
        found[coder.decode(stream[at:end].tolist())] += 1
        at = end + 1
    assert found == texts and (stream[at:] == token_shards.END).all()
    assert sum(x.n_tokens for x in manifest.collect()) == at
    later = token_shards.read_shards(manifest, folder, 64, 100, first=150, last=260).collect()
    assert sorted(x.slot for x in later) == list(range(150, 260))
    assert all((np.frombuffer(x.tokens, np.uint16) == rows[x.slot]).all() for x in later)


def test_classifier_learns_and_reads_whole_texts(spark):
    docs = [(i, prose(i, 40) if i % 2 else " ".join("$$" + w for w in prose(i, 40).split()), "a") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _, _ in docs] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    found = quality.quality_scores(frame(spark, [*docs, *ODD_ROWS[1:]]), labels).collect()
    held = [x for x in found if x.held_out and x.doc_id is not None and x.doc_id >= 10]
    assert len(found) == 400 + len(ODD_ROWS) - 1
    assert sum(x.predicted == x.doc_id % 2 for x in held) >= 0.95 * len(held)
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in found)
    w = quality.new_weights()
    text = prose(3, 90_000)
    assert len(text) > 2 * quality.BLOCK
    spoiled = text[:-9] + "%%%%%%%%%"
    assert quality.score(w, text) != quality.score(w, spoiled)


def test_gradients():
    r = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in quality.new_weights().items()}
    docs = [quality._halves(bytes(r.integers(0, 256, n, dtype=np.uint8))) for n in (10, 900, 2000)]
    y = np.array([0.0, 1.0, 1.0])

    def loss():
        out = 0.0
        for d, t in zip(docs, y, strict=True):
            responses = quality._responses(w, d)
            peaks = np.maximum(responses.max(axis=1), 0)
            chunks = np.maximum(peaks[:-1], peaks[1:])
            logit = quality._document(w, chunks.max(0)[None], chunks.mean(0)[None])[2][0]
            out += np.log1p(np.exp(-logit)) if t else np.log1p(np.exp(logit))
        return out / len(docs)

    # Windows of a document's last half see zero bytes alone only if documents are apart.
    docs = docs[:1]
    y = y[:1]
    grads = quality._loss_gradients(w, docs, y)
    for name in ("out", "hidden", "bias", "now"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        old = w[name][at]
        w[name][at] = old + 1e-6
        up = loss()
        w[name][at] = old - 1e-6
        slope = (up - loss()) / 2e-6
        w[name][at] = old
        assert math.isclose(slope, grads[name][at], rel_tol=2e-2, abs_tol=1e-7), name
