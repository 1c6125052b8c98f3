"""All blocks that meet a template, against every block with every template."""

import math
import random

import duckdb
from oracle import compare

from prospectra.llm import license_scan
from prospectra.llm.queries import ORACLES, op2_license_set_join


def brute(text, templates, containment):
    found = []
    for i, line in enumerate((text or "").encode().split(b"\n")):
        words = set(license_scan.words_of(line))
        for t, (_, template) in enumerate(templates):
            sought = set(license_scan.words_of(template.encode()))
            both = len(words & sought)
            if sought and both >= containment * len(sought) - 1e-9:
                found.append((i, t, both / len(sought)))
    return found


def test_filters_lose_nothing(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(30)]
    templates = [(f"l{i}", " ".join(rng.sample(vocabulary, rng.randint(1, 12)))) for i in range(15)]
    texts = ["\n".join(" ".join(rng.choices(vocabulary, k=rng.randint(0, 25))) for _ in range(6)) for _ in range(80)]
    rows = [(i, t, "x") for i, t in enumerate([*texts, None, "", "w1"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches string").repartition(3)
    for containment in (0.5, 0.8, 1.0):
        got = {r.doc_id: r.matches for r in license_scan.scan(docs, templates, {}, containment).collect()}
        for i, text, _ in rows:
            assert sorted((m.block, m.template, m.containment) for m in got[i]) == brute(text, templates, containment)


def test_phrases_over_lines_and_at_ends(spark):
    texts = ["MIT License", "see the mit\nlicense mit license", "mit licenses", "GNU General Public\n\nLicense, cc-by", None,
             "apache" + " x" * 50_000 + " Apache LICENSE"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    places = {i: (r.n_base, r.first_word, r.last_word, ",".join(r.base_labels)) for i, r in got.items()}
    assert places == {
        0: (1, 0, 0, "mit"),
        1: (2, 2, 4, "mit"),
        2: (0, None, None, ""),
        3: (2, 0, 4, "cc-by,gpl"),
        4: (0, None, None, ""),
        5: (1, 50_001, 50_001, "apache"),
    }
    assert got[5].n_words == 50_003 and got[4].n_words == 0


def test_empty_table_and_repeated_rows(spark):
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(None, license_scan.TEMPLATES[0][1]), (1, "x"), (1, "x")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(len(r.matches) for r in got) == [0, 0, 1]


def test_wrapped_notices(spark):
    import textwrap

    rows = []
    for i, (_, text) in enumerate(license_scan.TEMPLATES):
        lines = textwrap.wrap("Here it is. " + text + " and more", 30)
        rows.append((i, "prose of some kind\n" + "\n".join(" * " + line for line in lines) + "\nother lines\n"))
    bsd = license_scan.TEMPLATES[7][1]
    half = bsd.index("with or")
    rows += [(100, bsd[:half] + "\n\n" + bsd[half:]), (101, bsd[:half] + "\n" + "filler words " * 20 + "\n" + bsd[half:])]
    rows += [(103, "released under " + "x " * 40 + "the\nlicense")]  # too far apart
    rows += [(102, "before\n" + bsd + "\nafter")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    for i, (label, _) in enumerate(license_scan.TEMPLATES):
        found = [*got[i].matches, *got[i].wrapped]
        assert (i, label) in {(m.template, m.label) for m in found}, i
    assert [(m.block, m.lines, m.containment) for m in got[7].wrapped] == [(1, 6, 1.0)]
    assert not got[7].matches and got[7].wrapped[0].start == 4
    assert [len(got[i].wrapped) for i in (100, 101, 102, 103)] == [0] * 4 and len(got[102].matches) == 1


def test_all_rights_reserved_alone(spark):
    rows = [(1, "prose\nAll rights reserved.\nmore"), (2, "All rights\nreserved."), (3, "all rights are mine")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    labels = {r.doc_id: [m.label for m in [*r.matches, *r.wrapped]] for r in got}
    assert labels == {1: ["reserved"], 2: ["reserved"], 3: []}


def brute_wrapped(text, templates, containment):
    """By template the best share of a stretch of words over lines, where no line of the stretch meets the template."""
    whole = {(i, t) for i, t, _ in brute(text, templates, containment)}
    best, paragraph = {}, []
    for i, line in enumerate([*(text or "").encode().split(b"\n"), b""]):
        words = license_scan.words_of(line)
        paragraph += [(word, i) for word in words]
        if words:
            continue
        for t, (_, template) in enumerate(templates):
            sought = license_scan.words_of(template.encode())
            span = math.ceil(len(sought) / containment)
            for low in range(len(paragraph)):
                for high in range(low + 1, min(low + span, len(paragraph))):
                    first, last = paragraph[low][1], paragraph[high][1]
                    both = {word for word, _ in paragraph[low : high + 1]} & set(sought)
                    if last > first and sought and len(both) >= containment * len(set(sought)) - 1e-9:
                        if not any((at, t) in whole for at in range(first, last + 1)):
                            best[t] = max(best.get(t, 0), len(both) / len(set(sought)))
        paragraph = []
    return best


def test_wrapped_notices_against_all_stretches(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(12)]
    templates = [(f"l{i}", " ".join(rng.choices(vocabulary, k=rng.randint(2, 9)))) for i in range(8)]
    rows = []
    for i in range(120):
        lines = [" ".join(rng.choices([*vocabulary, "x", "y", "z"], k=rng.choice([0, 1, 2, 3, 5]))) for _ in range(8)]
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = 0
    for containment in (0.6, 0.8, 1.0):
        for r in license_scan.scan(docs, templates, {}, containment).collect():
            expected = brute_wrapped(rows[r.doc_id][1], templates, containment)
            got = {}
            for m in r.wrapped:
                got[m.template] = max(got.get(m.template, 0), m.containment)
            assert got == expected, rows[r.doc_id]
            found += len(got)
    assert found > 100


def test_last_words_that_also_stand_before_the_notice(spark):
    bsd = license_scan.TEMPLATES[7][1]
    first, second, last = bsd[: bsd.index("with or")], bsd[bsd.index("with or") : bsd.index("the following")], bsd[bsd.index("the following") :]
    rows = [(1, f"Note that the following conditions are met here. {first}\n{second}\n{last}")]
    (row,) = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(m.label, m.containment) for m in row.wrapped if m.label == "bsd"] == [("bsd", 1.0)]


def test_query_agrees_with_sql_on_wrapped_notices(spark, tmp_path):
    import textwrap

    texts = []
    for i, (_, text) in enumerate(license_scan.NOTICES):
        for width in (12, 25, 40):
            lines = textwrap.wrap("The following is met. " + text + " and more text", width)
            texts.append("prose\n\n" + "\n".join(" # " + line for line in lines) + "\nother\n" * (i % 3))
    rows = [(k, text) for k, text in enumerate([*texts, None, "", "All rights reserved."])]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = op2_license_set_join(spark, str(tmp_path))
    assert compare(found, con, ORACLES["op2_license_set_join"]) == []
    assert sum(bool(r.labels) for r in found.collect()) > 40
