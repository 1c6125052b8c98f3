"""Benchmark questions in documents, also with other numbers, names and units: template windows.

Texts become templates: numbers, capitalised names (a run of them within a sentence and line is one) and units
behind a number are typed placeholders, all other words stand as they are in lower case. Windows of template words are joined with the
windows of the benchmark by their text. A Bloom filter of the benchmark's windows keeps all other
windows of the documents from leaving their task; what it lets through by mistake, the join removes.
Tasks know words by number: codes, windows and their hashes are arrays over many texts, and text is only made
of windows that pass the filter.

Matching windows of a document and an item on one diagonal (place in the document less place in the item) are
an alignment. It counts if its slots are consistent: every value of the item has stood for one value of the
document and the other way round. With `run_on_names`, a name at the border of an alignment may run on into the text
around it and is compared by its near end. An item is found if its consistent alignments cover enough of its words.

With `copies`, windows of the plain words, case folded, are joined beside the template windows: copies are found
whatever their case, and of items without literals as well. Both kinds count for themselves. With `short_items`, items of
fewer words than a window has literals are found as well, word by word as a whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prospectra.llm.batches import slices, text_bytes
from prospectra.sources.scratch import materialize

_WORD = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+")
_SPACE = re.compile(r"\s")
#: Ends a run of names, but for the full stop of an initial or title.
_ENDS = ".:;!?\u2026\n\r\u2028\u2029"
_WORD_OR_END = re.compile(rf"{_WORD.pattern}|[{_ENDS}]")
_STOP = re.compile(r"\.[ \t]*")
TITLES = frozenset("Mr Mrs Ms Dr Prof St".split())
#: Units of measure and money that are slots behind a number.
UNITS = frozenset(
    """mm cm m km in ft yd mi mg g kg t oz lb lbs ms s sec min h hr hrs ml cl l gal pt w kw kwh v a hz mhz ghz
    c f k kb mb gb tb pa kpa bar rad deg mol j kj cal kcal usd eur gbp
    millimeter millimeters centimeter centimeters meter meters metre metres kilometer kilometers kilometres inch
    inches foot feet yard yards mile miles gram grams kilogram kilograms ton tons tonnes ounce ounces pound pounds
    second seconds minute minutes hour hours day days week weeks month months year years liter liters litre litres
    gallon gallons percent degree degrees dollar dollars cent cents euro euros""".split()
)
NAME, NUMBER, UNIT = "<NAME>", "<NUM>", "<UNIT>"
#: Template words of a window, and how many of them must stand as they are.
WINDOW, MIN_LITERALS = 8, 4
#: Share of an item's template words that consistent alignments must cover.
MIN_COVERAGE = 0.5
#: Bits of the filter for a window of the benchmark, and all its bits at the least and at the most, as powers of two.
BITS_PER_WINDOW, LEAST_BITS, MOST_BITS = 32, 16, 28
#: Windows hashed at a time, characters split into words at a time, and characters of texts taken together.
PORTION, PIECE, TOGETHER = 1 << 18, 1 << 20, 1 << 20
#: Words that a task remembers by number; it forgets them all beyond that.
REMEMBERED = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


PLACEHOLDERS = [np.uint64(xxhash.xxh64_intdigest(word.encode())) for word in (NAME, NUMBER, UNIT)]


class _Vocabulary:
    """Words and ends of runs by number, with the codes of their template word and plain word, and their kind."""

    NUMBER, CAPITAL, UNIT, END, SHORT = 1, 2, 4, 8, 16

    def __init__(self):
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.words: list[str] = []
        self.shapes, self.plain, self.kinds = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.uint8)

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))

    def learn(self) -> None:
        """Codes and kinds of the words that are new."""
        new = list(islice(self.number, len(self.words), None))
        lower, folded = [w.lower() for w in new], [w.casefold() for w in new]
        codes = np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in lower), np.uint64, len(new))
        plain = codes.copy()
        for k in [k for k, (a, b) in enumerate(zip(lower, folded, strict=True)) if a != b]:
            plain[k] = xxhash.xxh64_intdigest(folded[k].encode())
        kinds = np.array([w[0].isdigit() for w in new], np.uint8)
        kinds |= np.array([w[0].isupper() for w in new], np.uint8) * np.uint8(self.CAPITAL)
        kinds |= np.array([w in UNITS for w in lower], np.uint8) * np.uint8(self.UNIT)
        kinds |= np.array([w in _ENDS for w in new], np.uint8) * np.uint8(self.END)
        kinds |= np.array([len(w) == 1 or w in TITLES for w in new], np.uint8) * np.uint8(self.SHORT)
        self.words += new
        self.shapes, self.plain = np.concatenate([self.shapes, codes]), np.concatenate([self.plain, plain])
        self.kinds = np.concatenate([self.kinds, kinds])


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while start < len(text) or not start:
        cut = len(text)
        if cut - start > PIECE and (space := _SPACE.search(text, start + PIECE)):
            cut = space.start()
        yield text[start:cut]
        start = max(cut, 1)


def _gap(pieces: list[str], starts_text: list[bool], k: int, gaps: list[str]) -> str:
    """What stands before the first word of a piece, back to the word before in its text."""
    gap = gaps[0]
    while not starts_text[k]:
        k -= 1
        before = _WORD.split(pieces[k])
        gap = before[-1] + gap
        if len(before) > 1:
            break
    return gap


class _Words:
    """The words of texts, by number, and the template words that they make."""

    def __init__(self, texts: list[str], vocabulary: _Vocabulary):
        pieces, found, starts_text = [], [], []
        for text in texts:
            for j, piece in enumerate(_pieces(text)):
                pieces.append(piece)
                found.append(vocabulary.numbers(_WORD_OR_END.findall(piece)))
                starts_text.append(j == 0)
        vocabulary.learn()
        self.vocabulary = vocabulary
        tokens = np.concatenate(found) if found else np.empty(0, np.int32)
        ends = (vocabulary.kinds[tokens] & _Vocabulary.END) > 0
        before = np.concatenate([[0], np.cumsum(~ends)])  # words before each token
        firsts = before[np.cumsum([0, *map(len, found)])]  # first words of the pieces, and the number of words
        self.numbers = tokens[~ends]
        n = len(self.numbers)
        self.firsts = firsts[:-1][np.array(starts_text, bool)]  # of the texts
        kinds = vocabulary.kinds[self.numbers]
        number = (kinds & _Vocabulary.NUMBER) > 0
        starts = np.zeros(n + 1, bool)
        starts[self.firsts] = True
        unit, joined = np.zeros(n, bool), np.zeros(n, bool)
        unit[1:] = number[:-1] & ~starts[1:-1] & ((kinds[1:] & _Vocabulary.UNIT) > 0)
        name = ((kinds & _Vocabulary.CAPITAL) > 0) & ~unit & ~number
        joined[1:] = name[1:] & name[:-1] & ~starts[1:-1]
        # an end between them parts names, but for the full stop of an initial or title
        parted = np.zeros(n + 1, bool)
        parted[before[:-1][ends]] = True
        behind_short = np.zeros(n, bool)
        behind_short[1:] = (kinds[:-1] & _Vocabulary.SHORT) > 0
        asked = np.flatnonzero(joined & parted[:-1] & behind_short)
        joined &= ~parted[:-1]
        of = np.searchsorted(firsts[:-1], asked, side="right") - 1
        for k in np.unique(of).tolist():
            gaps = _WORD.split(pieces[k])
            for place in asked[of == k].tolist():
                at = place - int(firsts[k])
                gap = gaps[at] if at else _gap(pieces, starts_text, k, gaps)
                joined[place] = _STOP.fullmatch(gap) is not None
        self.begins = np.flatnonzero(~joined)  # of the template words
        self.shape = np.where(number, 1, np.where(unit, 2, np.where(name, 0, 3))).astype(np.int8)[self.begins]

    def template_codes(self, start: int, stop: int) -> np.ndarray:
        codes = self.vocabulary.shapes[self.numbers[self.begins[start:stop]]]
        shape = self.shape[start:stop]
        return np.where(shape < 3, _PLACEHOLDER_CODES[shape], codes)

    def plain_codes(self, start: int, stop: int) -> np.ndarray:
        return self.vocabulary.plain[self.numbers[start:stop]]

    def template_window(self, start: int, length: int) -> tuple[str, list[str]]:
        """The template words of a window, and the values of its slots."""
        shapes, values, words = [], [], self.vocabulary.words
        for k in range(start, start + length):
            first = int(self.begins[k])
            if self.shape[k] == 3:
                shapes.append(words[self.numbers[first]].lower())
                continue
            shapes.append(_PLACEHOLDER_WORDS[self.shape[k]])
            last = int(self.begins[k + 1]) if k + 1 < len(self.begins) else len(self.numbers)
            values.append(" ".join(words[n] for n in self.numbers[first:last].tolist()))
        return " ".join(shapes), values

    def plain_window(self, start: int, length: int) -> tuple[str, list[str]]:
        return " ".join(self.vocabulary.words[n].casefold() for n in self.numbers[start : start + length].tolist()), []


_PLACEHOLDER_WORDS = (NAME, NUMBER, UNIT)
_PLACEHOLDER_CODES = np.array([*PLACEHOLDERS, np.uint64(0)])


def _hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each window of `length` codes."""
    total = np.zeros(max(0, len(codes) - length + 1), np.uint64)
    for k in range(length):
        total = total * _STEP + codes[k : k + len(total)]
    return total ^ total >> np.uint64(29)


def _bits(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    """The two bits of each hash in a filter of `size` bits, a power of two."""
    mask = np.uint64(size - 1)
    return [(hashes & mask).astype(np.int64), ((hashes * _STEP >> np.uint64(20)) & mask).astype(np.int64)]


_WINDOWS = (
    "id bigint, key bigint, plain boolean, place bigint, length int, n_words bigint, template string, slots array<string>,"
    " hash bigint"
)
_WINDOW_SCHEMA = pa.schema(
    [
        ("id", pa.int64()),
        ("key", pa.int64()),
        ("plain", pa.bool_()),
        ("place", pa.int64()),
        ("length", pa.int32()),
        ("n_words", pa.int64()),
        ("template", pa.string()),
        ("slots", pa.list_(pa.string())),
        ("hash", pa.int64()),
    ]
)


class WindowScan:
    """The windows of texts that can be compared, with a filter of known windows or without.

    `short` are the lengths of items shorter than a window, those of plain words negative; None for items.
    """

    def __init__(
        self,
        window: int,
        min_literals: int,
        short: list[int] | None,
        known: np.ndarray | None,
        copies: bool = False,
        short_items: bool = False,
    ):
        self.window, self.min_literals, self.short, self.known, self.copies = window, min_literals, short, known, copies
        self.min_plain = 1 if short_items else min_literals
        self.vocabulary = _Vocabulary()

    def of(self, text: bytes) -> Iterator[dict]:
        for _, row in self.all_of([text]):
            yield row

    def all_of(self, texts: list[bytes]) -> Iterator[tuple[int, dict]]:
        """The windows of all texts, each with the place of its text."""
        if len(self.vocabulary.words) > REMEMBERED:
            self.vocabulary = _Vocabulary()
        words = _Words([text.decode() for text in texts], self.vocabulary)
        firsts = np.searchsorted(words.begins, words.firsts)  # a text starts a template word
        yield from self._windows(texts, words, False, firsts, len(words.begins))
        if self.copies:
            yield from self._windows(texts, words, True, words.firsts, len(words.numbers))

    def _windows(
        self, texts: list[bytes], words: _Words, plain: bool, firsts: np.ndarray, end: int
    ) -> Iterator[tuple[int, dict]]:
        sizes, sign = np.diff(firsts, append=end), -1 if plain else 1
        filled = np.flatnonzero(sizes)  # of texts without words none owns a place
        if not len(filled):
            return
        ends = firsts[filled] + sizes[filled]
        if self.short is None:  # an item: its windows, or all of it where it is shorter
            short = sorted({n for n in sizes.tolist() if 0 < n < self.window})
        else:
            short = [n * sign for n in self.short if n * sign > 0]
        codes_of = words.plain_codes if plain else words.template_codes
        show = words.plain_window if plain else words.template_window
        longest = max([self.window, *short])
        for low in range(0, end, PORTION):
            codes = codes_of(low, min(end, low + PORTION + longest - 1))
            places = np.arange(low, min(end, low + PORTION))
            owner = np.searchsorted(ends, places, side="right")
            left = ends[owner] - places
            if not plain:
                literals = np.concatenate([[0], np.cumsum(words.shape[low : low + len(codes)] == 3)])
            for length in [self.window, *short]:
                hashes = _hashes(codes, length)[: len(places)]
                n = len(hashes)
                enough = left[:n] >= length
                if plain:
                    hashes = ~hashes
                    enough &= length >= self.min_plain
                else:
                    enough &= literals[length : length + n] - literals[:n] >= self.min_literals
                if self.short is None and length < self.window:
                    enough &= sizes[filled][owner[:n]] == length
                if self.known is not None:
                    for bits in _bits(hashes, 8 * len(self.known)):
                        enough &= (self.known[bits >> 3] >> (bits & 7) & 1).astype(bool)
                for i in np.flatnonzero(enough).tolist():
                    text = int(filled[owner[i]])
                    shown, slots = show(low + i, length)
                    yield text, {
                        "key": xxhash.xxh64_intdigest(texts[text]) - 2**63,
                        "plain": plain,
                        "place": low + i - int(firsts[text]),
                        "length": length,
                        "n_words": int(sizes[text]),
                        "template": shown,
                        "slots": slots,
                        "hash": int(hashes[i].astype(np.int64)),
                    }

    def batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            ids, texts = piece.column(0).to_pylist(), text_bytes(piece.column(1))
            rows: list[dict] = []
            for group in _together(texts):
                for k, row in self.all_of(texts[group]):
                    rows.append({"id": ids[group.start + k], **row})
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema=_WINDOW_SCHEMA)
                        rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=_WINDOW_SCHEMA)


def _together(texts: list[bytes]) -> Iterable[slice]:
    """Slices of texts that hold about `TOGETHER` bytes each."""
    start = held = 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= TOGETHER:
            yield slice(start, k + 1)
            start, held = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _filter_of(hashes: DataFrame) -> np.ndarray:
    """The Bloom filter of the items' windows, sized by their number up to a limit.

    Each of a few tasks fills a filter; they are joined on the way to the driver.
    """
    wanted = (hashes.count() * BITS_PER_WINDOW).bit_length()
    size = 1 << min(MOST_BITS, max(LEAST_BITS, wanted))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(size // 8, np.uint8)
        for batch in batches:
            for bits in _bits(batch.column(0).to_numpy().view(np.uint64), size):
                np.bitwise_or.at(known, bits >> 3, np.left_shift(1, bits & 7).astype(np.uint8))
        yield pa.record_batch([pa.array([known.tobytes()])], ["known"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(size // 8, np.uint8)
        for piece in slices(batches, 1):
            known |= np.frombuffer(piece.column(0)[0].as_py(), np.uint8)
        yield pa.record_batch([pa.array([known.tobytes()])], ["known"])

    filled = hashes.coalesce(8).mapInArrow(fill, "known binary")
    return np.frombuffer(bytes(filled.repartition(1).mapInArrow(join, "known binary").first().known), np.uint8)


def _border_fits(border: str, others: str, start: bool) -> Column:
    """Whether all pairs at a border agree with `others`; their document value may be longer on the outer side."""

    def fits(b: Column, p: Column) -> Column:
        longer = b["slots"].endswith(F.concat(F.lit(" "), p["slots"])) if start else b["slots"].startswith(
            F.concat(p["slots"], F.lit(" "))
        )
        same = b["item_slots"] == p["item_slots"]
        return F.when(same, (b["slots"] == p["slots"]) | longer).otherwise(b["slots"] != p["slots"])

    return F.forall(border, lambda b: F.forall(others, lambda p: fits(b, p)))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    min_literals: int = MIN_LITERALS,
    min_coverage: float = MIN_COVERAGE,
    run_on_names: bool = False,
    copies: bool = False,
    merged_values: bool = False,
    short_items: bool = False,
) -> DataFrame:
    """`doc_id`, `item_id`, `covered`, `n_words`, `coverage`: the items that a document holds.

    `covered` counts the item's template words in consistent alignments, `coverage` is their share. A pair
    stands once, also if rows repeat. An item shorter than a window is one window; items without a window of
    `min_literals` literal words cannot be told from other text and are not searched by their template. `copies`
    also searches word by word, whatever the case, for all items of `min_literals` words or more; the columns of
    a pair that only this finds count plain words. `merged_values` lets several numbers or units of an item stand
    for the same one of a document; names stay one to one. `short_items`, with `copies`, also searches word by word for
    items of fewer words. Null and empty texts
    hold nothing and are found nowhere. `run_on_names` also takes alignments that are consistent but for names at
    their borders that go on outside ('Yesterday Anna' for 'Anna'). Null ids are ids like others. Further columns are not read.
    """
    items = benchmark.select(F.col(item_col).cast("bigint").alias("id"), F.col(item_text_col).alias("text"))
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return WindowScan(window, min_literals, None, None, copies, short_items).batches(batches)

    sought = items.mapInArrow(ask, _WINDOWS).dropDuplicates(["id", "key", "plain", "place", "length"])
    sought = materialize(
        sought.select(
            F.col("id").alias("item_id"),
            F.col("key").alias("item_key"),
            "plain",
            F.col("place").alias("item_place"),
            "length",
            "template",
            F.col("slots").alias("item_slots"),
            "n_words",
            "hash",
        ),
        "benchmark_windows",
    )
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(sought.select("hash")))
    # lengths below a window, of either kind
    lengths = sought.where(F.col("length") < window).select("plain", "length").distinct().collect()
    short = sorted(-row.length if row.plain else row.length for row in lengths)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return WindowScan(window, min_literals, short, shared.value, copies, short_items).batches(batches)

    found = texts.mapInArrow(scan, _WINDOWS).select(
        F.col("id").alias("doc_id"), F.col("key").alias("doc_key"), "plain", "place", "length", "template", "slots"
    )
    sizes = (
        sought.groupBy("item_id", "item_key", "plain")
        .agg(F.max("n_words").alias("n_words"))
        .select(
            F.col("item_id").alias("of"),
            F.col("item_key").alias("of_key"),
            F.col("plain").alias("of_plain"),
            "n_words",
        )
    )
    zipped = F.arrays_zip("item_slots", "slots")
    first = F.col("template").startswith(NAME).cast("int")
    final = F.col("template").endswith(NAME).cast("int")
    inside = F.slice(zipped, first + 1, F.greatest(F.size(zipped) - first - final, F.lit(0)))
    aligned = (
        found.join(sought.drop("n_words", "hash"), ["template", "length", "plain"])
        .groupBy("doc_id", "doc_key", "item_id", "item_key", "plain", (F.col("place") - F.col("item_place")).alias("shift"))
        .agg(
            F.collect_set(F.struct("item_place", "length")).alias("windows"),
            F.array_distinct(F.flatten(F.collect_set(zipped))).alias("pairs"),
            # a name within an alignment is at the border of some windows and inside others
            F.array_distinct(F.flatten(F.collect_set(inside))).alias("inner"),
            F.array_distinct(F.flatten(F.collect_set(F.slice(zipped, 1, first)))).alias("low"),
            F.array_distinct(F.flatten(F.collect_set(F.slice(zipped, F.size(zipped) - final + 1, final)))).alias("high"),
        )
    )

    def one_to_one(pairs: str) -> Column:
        item_values = F.size(F.array_distinct(F.col(f"{pairs}.item_slots")))
        told = F.filter(pairs, lambda p: p["item_slots"].rlike(r"^\p{Lu}")) if merged_values else F.col(pairs)
        return (item_values == F.size(pairs)) & (F.size(F.array_distinct(told["slots"])) == F.size(told))

    consistent = one_to_one("pairs")
    cut = one_to_one("inner") & _border_fits("low", "inner", True) & _border_fits("high", "inner", False)
    cut &= _border_fits("low", "high", True) | _border_fits("high", "low", False)
    consistent = aligned.where(consistent | cut if run_on_names else consistent)
    words = F.transform(
        "windows", lambda w: F.sequence(w["item_place"], w["item_place"] + w["length"].cast("bigint") - 1)
    )
    pair = ["doc_id", "doc_key", "item_id", "item_key", "plain"]
    covered = (
        consistent.select(*pair, F.explode(F.array_distinct(F.flatten(words))).alias("word"))
        .groupBy(*pair)
        .agg(F.countDistinct("word").alias("covered"))
    )
    sized = covered.join(
        sizes,
        F.col("item_id").eqNullSafe(F.col("of"))
        & (F.col("item_key") == F.col("of_key"))
        & (F.col("plain") == F.col("of_plain")),
    ).withColumn("coverage", F.col("covered") / F.col("n_words"))
    return (
        sized.where(F.col("coverage") >= min_coverage)
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct(~F.col("plain"), "coverage", "covered", "n_words")).alias("best"))
        .select("doc_id", "item_id", "best.covered", "best.n_words", "best.coverage")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` whose id holds no item; rows without id stay unless a row without id holds one."""
    hit = contaminated(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("_held")).distinct()
    hit = materialize(hit, "contaminated")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("id"))
    return rows.join(hit, F.col("id").eqNullSafe(F.col("_held")), "left_anti").select("row.*")
