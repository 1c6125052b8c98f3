"""Verbatim and re-parameterised questions are found, others are not."""

import random

from prospectra.llm import decontaminate as dc
from prospectra.llm.queries import DECONTAMINATION

ITEMS = [
    (1, "A train leaves Boston at 9 and travels 120 km in 3 hours before it meets the train from Boston, how fast was it?"),
    (2, "If Anna Maria has 5 apples and gives 2 apples to Tom then how many apples does Anna Maria still have left?"),
    (3, "der schnelle braune fuchs springt heute über den faulen hund"),
    (4, "only five words stand here"),
    (5, None),
    (6, "Yes"),
]


def found(spark, texts, items=ITEMS, **options):
    docs = spark.createDataFrame([(*t, "x", 1) for t in texts], "doc_id long, text string, item_id string, length int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in dc.contaminated(docs.repartition(3), bench, **options).collect()}


def test_other_parameters_are_found_if_consistent(spark):
    train = "Intro text. A train leaves {a} at 10 and travels 300 miles in 4 days before it meets the train from {b}, how fast was it? More."
    texts = [
        (0, ITEMS[0][1]),
        (1, train.format(a="Paris", b="Paris")),
        (2, train.format(a="Paris", b="Rome")),  # two values for one
        (3, "well " + ITEMS[1][1].replace("Anna Maria", "Bob").replace("Tom", "Kim").replace("5", "17,5")),
        (4, ITEMS[2][1].upper()),  # all names
        (5, "x " + ITEMS[2][1] + " y"),
        (6, "Here " + ITEMS[3][1] + " indeed"),
        (7, "Yes"),
        (8, None),
        (9, ""),
        (None, ITEMS[2][1]),
        (0, ITEMS[0][1]),
    ]
    assert found(spark, texts) == {(0, 1), (1, 1), (3, 2), (5, 3), (6, 4), (None, 3)}


def brute(texts, items):
    """Every pair of windows, without filter or join."""
    scan = dc.WindowScan(dc.WINDOW, dc.MIN_LITERALS, None, None)
    hits = set()
    for item_id, item in items:
        windows = list(scan.of(item.encode()))
        if not windows:
            continue
        size = windows[0]["n_words"]
        for doc_id, text in texts:
            own = list(dc.WindowScan(dc.WINDOW, dc.MIN_LITERALS, [windows[0]["length"]], None).of(text.encode()))
            aligned = {}
            for a in windows:
                for b in own:
                    if a["template"] == b["template"]:
                        aligned.setdefault(b["place"] - a["place"], []).append((a, b))
            covered = set()
            for pairs in aligned.values():
                slots = {p for a, b in pairs for p in zip(a["slots"], b["slots"])}
                if len({x for x, _ in slots}) == len(slots) == len({y for _, y in slots}):
                    covered |= {a["place"] + k for a, _ in pairs for k in range(a["length"])}
            if size and len(covered) / size >= dc.MIN_COVERAGE:
                hits.add((doc_id, item_id))
    return hits


def test_against_all_pairs(spark):
    rng = random.Random(1)
    words = ["a", "b", "C", "D", "7", "8", "km", "e", "f", "g"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(4, 20)))) for i in range(25)]
    texts = []
    for i in range(60):
        base = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 3)):
            base[rng.randrange(len(base))] = rng.choice(words)
        texts.append((i, " ".join(rng.choices(words, k=5) + base + rng.choices(words, k=5))))
    got = found(spark, texts, items)
    assert got == brute(texts, items) and got


def test_portions_give_the_same_windows(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choices(["a", "b", "C", "D", "7", "km", "e"], k=300)).encode()
    whole = list(dc.WindowScan(8, 3, [5], None).of(text))
    monkeypatch.setattr(dc, "PORTION", 7)
    parts = list(dc.WindowScan(8, 3, [5], None).of(text))
    key = lambda row: (row["length"], row["place"])
    last = lambda rows: [{**r, "n_words": None, "slots": r["slots"][:-1]} for r in sorted(rows, key=key)]
    assert [key(r) for r in last(parts)] == [key(r) for r in last(whole)]
    assert [r["template"] for r in last(parts)] == [r["template"] for r in last(whole)]


def test_empty_tables_and_dropping(spark):
    assert found(spark, []) == set()
    assert found(spark, [(1, "text " * 20)], []) == set()
    docs = spark.createDataFrame([(1, ITEMS[0][1], 1), (2, "clean", 2), (None, "x", 3)], "doc_id long, text string, _held int")
    kept = dc.drop_contaminated(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, None}


def test_whole_table(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "benchmark"))
    items = bench.collect()
    verbatim = {(d.doc_id, b.item_id) for d in docs.collect() for b in items if b.text in (d.text or "")}
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()}
    assert verbatim and got == verbatim


def test_names_before_and_behind_an_item(spark):
    item = "The train leaves the old station at nine. The train then runs for many long hours to see Anna"
    other = "Anna has 5 red apples and gives 2 green apples to Tom before Anna goes home to Kim"
    texts = [
        (1, "Question: " + item),
        (2, "See Bob. " + item),
        (3, "Heading\n" + item + "\nAnswer"),
        (4, "Yesterday " + other.replace("Anna", "Mary Ann").replace("5", "7") + " Then"),  # no sign between
        (5, "Yesterday " + other.replace("Anna goes", "Bob goes")),  # two values for one
        (6, "Yesterday " + other.replace("Tom", "Kim")),  # one for two
    ]
    items = [(1, item), (2, other)]
    assert found(spark, texts, items) == {(1, 1), (2, 1), (3, 1)}
    assert found(spark, texts, items, run_on_names=True) == {(1, 1), (2, 1), (3, 1), (4, 2)}


def test_ends_of_names():
    scan = dc.WindowScan(1, 0, None, None)
    names = lambda text: [r["slots"][0] for r in scan.of(text.encode()) if r["slots"]]
    assert names("Ask Dr. J. Smith, Bob: The end") == ["Ask Dr J Smith Bob", "The"]
    assert names("New York! Rome") == ["New York", "Rome"] and names("New\nYork") == ["New", "York"]


def test_copies_of_other_case_and_without_literals(spark):
    title = "Great Expectations Of The Small Town Council Meeting In 1900 And 1901"
    items = [(1, ITEMS[0][1]), (2, title), (3, "Über die große Straße"), (4, "Yes"), (5, "12 13 14 15 16 17 18 19 20")]
    texts = [
        (1, "see: " + ITEMS[0][1].upper()),
        (2, "SEE " + ITEMS[0][1].lower() + " more"),
        (3, "the " + title + " report"),
        (4, title.lower()),
        (5, "ÜBER DIE GROSSE STRASSE gehen"),
        (6, "Yes"),
        (7, "x 12 13 14 15 16 17 18 19 20 y"),
        (8, ITEMS[0][1].replace("train", "tram").replace("hours", "days")),
    ]
    expected = {(1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (7, 5)}
    assert found(spark, texts, items, copies=True) - {(8, 1)} == expected
    assert expected & found(spark, texts, items) == {(2, 1)}


def test_copies_add_pairs_and_change_none(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "benchmark"))
    old = {tuple(r) for r in dc.contaminated(docs, bench).collect()}
    upper = docs.selectExpr("doc_id", "upper(text) AS text")
    assert old and old <= {tuple(r) for r in dc.contaminated(docs, bench, copies=True).collect()}
    pairs = {(r.doc_id, r.item_id) for r in dc.contaminated(upper, bench, copies=True).collect()}
    assert {row[:2] for row in old} <= pairs


def test_portions_give_the_same_plain_windows(monkeypatch):
    text = " ".join(random.Random(3).choices(["a", "B", "c", "7"], k=100)).encode()
    scan = lambda: sorted((r["place"], r["length"], r["template"]) for r in dc.WindowScan(8, 3, [-5], None, True).of(text) if r["plain"])  # noqa: E731, E501
    whole = scan()
    monkeypatch.setattr(dc, "PORTION", 7)
    assert scan() == whole and len(whole) == 93 + 96


def test_numbers_that_became_equal(spark):
    item = ITEMS[1][1]
    same = item.replace("5", "4").replace("2", "4")
    texts = [(1, same), (2, item.replace("Tom", "Bob").replace("Anna Maria", "Bob"))]  # names stay apart
    assert found(spark, texts, merged_values=True) == {(1, 2)}
    assert found(spark, texts) == set()


def plain_template(text):
    """Template words and values by a scan over the characters, without anything of the operator."""
    words = []  # word, start, end
    i = 0
    letter = lambda c: c.isalnum() and not c.isdecimal()
    while i < len(text):
        j = i
        if text[i].isdecimal():
            while j < len(text) and text[j].isdecimal():
                j += 1
                if j + 1 < len(text) and text[j] in ".," and text[j + 1].isdecimal():
                    j += 1
        else:
            while j < len(text) and letter(text[j]):
                j += 1
        if j > i:
            words.append((text[i:j], i, j))
        i = max(j, i + 1)
    shapes, values = [], []
    for k, (word, start, _) in enumerate(words):
        before, gap = words[k - 1][0] if k else "", text[words[k - 1][2] : start] if k else ""
        if word[0].isdigit():
            shape = "<NUM>"
        elif shapes and shapes[-1] == "<NUM>" and word.lower() in dc.UNITS:
            shape = "<UNIT>"
        elif word[0].isupper():
            shape = "<NAME>"
            stop = not any(c in gap for c in ".:;!?…\n\r  ")
            stop |= (len(before) == 1 or before in ("Mr", "Mrs", "Ms", "Dr", "Prof", "St")) and gap.strip(" \t") == "." and gap[0] == "."
            if shapes and shapes[-1] == "<NAME>" and stop:
                values[-1] += " " + word
                continue
        else:
            shape = word.lower()
        shapes.append(shape)
        values.append(word)
    return shapes, values, [word.casefold() for word, _, _ in words]


def registered(texts, items):
    """The pairs that the query's options find, by all pairs of windows."""
    hits = set()
    for item_id, item in items:
        of_item = plain_template(item)
        for doc_id, text in texts:
            own = plain_template(text)
            if plain_pair(of_item[2], own[2]) or template_pair(of_item, own):
                hits.add((doc_id, item_id))
    return hits


def plain_pair(item, text):
    size = min(8, len(item))
    covered = set()
    for a in range(len(item) - size + 1 if item else 0):
        if any(text[b : b + size] == item[a : a + size] for b in range(len(text) - size + 1)):
            covered |= set(range(a, a + size))
    return bool(item) and len(covered) >= 0.5 * len(item)


def template_pair(item, text):
    (shapes, values, _), (others, theirs, _) = item, text
    size, covered = min(8, len(shapes)), set()
    for shift in range(-len(shapes), len(others)):
        windows = [
            a
            for a in range(max(0, -shift), len(shapes) - size + 1)
            if size and shapes[a : a + size] == others[a + shift : a + shift + size]
            and sum(s[0] != "<" for s in shapes[a : a + size]) >= 4
        ]
        slot = lambda k: (values[k], theirs[k + shift])
        slots = [[k for k in range(a, a + size) if shapes[k][0] == "<"] for a in windows]
        low = {slot(s[0]) for a, s in zip(windows, slots) if shapes[a] == "<NAME>"}
        high = {slot(s[-1]) for a, s in zip(windows, slots) if shapes[a + size - 1] == "<NAME>"}
        inner = set()
        for a, s in zip(windows, slots):
            inner |= {slot(k) for k in s if not (shapes[k] == "<NAME>" and k in (a, a + size - 1))}
        every = {slot(k) for s in slots for k in s}
        fits = one_each(inner) and agree(low, inner, True) and agree(high, inner, False)
        if one_each(every) or (fits and (agree(low, high, True) or agree(high, low, False))):
            covered |= {k for a in windows for k in range(a, a + size)}
    return bool(shapes) and len(covered) >= 0.5 * len(shapes)


def one_each(pairs):
    names = [theirs for mine, theirs in pairs if mine[0].isupper()]
    return len({mine for mine, _ in pairs}) == len(pairs) and len(set(names)) == len(names)


def agree(border, others, start):
    for mine, theirs in border:
        for x, y in others:
            longer = theirs.endswith(" " + y) if start else theirs.startswith(y + " ")
            if (x == mine and not (theirs == y or longer)) or (x != mine and theirs == y):
                return False
    return True


def test_registered_options_against_all_pairs(spark):
    rng = random.Random(11)
    words = ["a", "b", "C", "D", "Dr", "J", "7", "8", "km", "e", "f", "g", "h"]
    gaps = [" ", " ", " ", " ", ", ", ". ", ": ", "\n"]
    text = lambda n: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 3, 5, 8, 12, 20]))) for k in range(30)]
    texts = []
    for k in range(90):
        base = rng.choice(items)[1].split(" ")
        for _ in range(rng.choice([0, 0, 1, 3])):
            base[rng.randrange(len(base))] = rng.choice(words)
        base = " ".join(base)
        texts.append((k, text(4) + rng.choice([base, base.upper(), base.lower()]) + " " + text(4)))
    got = found(spark, texts, items, **DECONTAMINATION)
    assert got == registered(texts, items) and got - found(spark, texts, items)


def test_items_of_few_words(spark):
    items = [(1, "Solve it now"), (2, "Yes"), (3, "Straße 9"), (4, "...")]
    texts = [(1, "please SOLVE it, now!"), (2, "solve it not now"), (3, "yes"), (4, "STRASSE 9"), (5, None), (6, "...")]
    assert found(spark, texts, items, copies=True, short_items=True) == {(1, 1), (3, 2), (4, 3)}
    assert found(spark, texts, items, copies=True) == set()


def test_pieces_of_a_long_text_give_the_same_windows(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice(["a", "B", "Dr", "J", "7", "km"]) + rng.choice([" ", ". ", "\n", " - "]) for _ in range(200)).encode()
    scan = lambda: sorted(map(str, dc.WindowScan(8, 3, [5, -6], None, True).of(text)))
    whole = scan()
    monkeypatch.setattr(dc, "PIECE", 9)
    monkeypatch.setattr(dc, "PORTION", 5)
    assert scan() == whole


def test_long_text_through_a_data_frame(spark):
    long = "word " * 400_000 + ITEMS[1][1] + " and " * 300_000
    assert found(spark, [(1, long)]) == {(1, 2)}
