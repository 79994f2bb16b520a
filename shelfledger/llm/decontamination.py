"""Benchmark decontamination by templates.

Texts are reduced to templates: letters are lower-cased, and numbers, names (capitalised words inside
a sentence) and units after a number become typed placeholders. Windows of eight template words of the
benchmark are hashed and joined with the windows of every document. Matched windows are then checked
for consistent slots: along one alignment a benchmark value must always stand for the same document
value, so a question with other numbers and names is caught, and a chance likeness of form is not.
Windows of too few words besides placeholders, as arithmetic has, are matched by their exact words and
numbers instead, and so are items of fewer than LEAST_WORDS words, whole and with the signs between them;
an item of one word is copied where that word is a sentence, line or text of its own.

Windows of more than COMMON_ITEMS items, such as those of an instruction that stands before each question, say
nothing of an item: they are left out, and with them the words that only they hold. Items of one template count once
here. An item that has no other windows keeps them.

A document's windows are probed in a Bloom filter of the benchmark's, of a bounded size; those that pass, with their
words, are joined with the benchmark's windows by hash, and the slots of a document and an item are checked
where their windows come together. Neither benchmark nor documents pass through the driver.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.chars import code_points, tables
from shelfledger.llm.common import released, small, stored
from shelfledger.llm.words import PIECE, mix, slices, span_hashes, text_bytes

WINDOW = 8
LEAST_WORDS = 4  # a shorter item counts only as a whole, as it is written
LEAST_LITERALS = 4  # words of a template window that are no placeholders
LEAST_SHARE = 0.4  # of an item's words, covered by consistent windows; or else
LEAST_RUN = 13  # covered words in a row, whatever the item's length
COMMON_ITEMS = 5  # a window of more items than this is common
FILTER_BITS = (1 << 20, 1 << 28)  # least and most bits of the filter: 16 for each window of the benchmark between them
BUCKET_BITS = 32768  # of one bitmap of bitmap_construct_agg

# Units of measure and money that become placeholders after a number.
UNITS = """mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs pound pounds oz ounce ounces
ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks
month months year years mph kmh percent dollar dollars euro euros cent cents usd eur gbp""".split()

NUMBER, NAME, UNIT, LITERAL = 1, 2, 3, 0
_PLACE = mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)
_KIND = mix(np.arange(101, 105, dtype=np.uint64))
_SPACES = np.array([c for c in range(0x3001) if chr(c).isspace()], np.uint32)


def tokens(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and kind of every word or number, and the number of them in each row."""
    return signed_tokens(offsets, data)[:3]


def signed_tokens(offsets: np.ndarray, data: np.ndarray, signs: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """As ``tokens``, and whether each word begins a sentence; with ``signs`` also a hash of what stands
    between each word and the one before it but white space."""
    t = tables()
    at, codes = code_points(offsets, data)
    rows, n = len(at) - 1, len(codes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(rows, np.int64), (np.zeros(0, np.uint64), np.zeros(0, bool))
    digit = t["digit"][codes]
    point = (codes == 46) | (codes == 44)
    point[1:-1] &= digit[:-2] & digit[2:]
    point[[0, -1]] = False
    kind = t["letter"][codes].astype(np.int8) + 2 * (digit | point).astype(np.int8)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    edge[1:-1] |= kind[1:] != kind[:-1]
    edges = np.flatnonzero(edge)
    inside = kind[edges[:-1]] > 0
    starts, ends = edges[:-1][inside], edges[1:][inside]
    low = t["lower"][codes]
    value = mix(low.astype(np.uint64) * np.uint64(2) + np.uint64(1))
    hashes = span_hashes(value, starts, ends)
    counts = np.searchsorted(starts, at[1:], "left") - np.searchsorted(starts, at[:-1], "left")
    # digits right behind letters belong to a name or code and are no number
    number = (kind[starts] >= 2) & ~((starts > 0) & (kind[starts - 1] == 1) & ~np.isin(starts, at))
    stop = np.cumsum(np.isin(codes, [10, 33, 46, 58, 63]))
    begins = np.ones(len(starts), bool)
    begins[1:] = stop[np.maximum(starts[1:] - 1, 0)] > stop[ends[:-1] - 1]
    firsts = (np.cumsum(counts) - counts)[counts > 0]
    begins[firsts] = True
    second = np.minimum(starts + 1, n - 1)
    name = ~number & ~begins & t["upper"][codes[starts]] & (ends - starts > 1) & ~t["upper"][codes[second]]
    after = np.zeros(len(starts), bool)
    after[1:] = number[:-1]
    after[firsts] = False
    unit = ~number & after & np.isin(hashes, _unit_hashes())
    between = np.zeros(len(starts), np.uint64)
    if signs and len(starts) > 1:
        sign = ~np.isin(codes, _SPACES)
        upto = np.concatenate([[0], np.cumsum(sign)])
        between[1:] = span_hashes(value[sign], upto[ends[:-1]], upto[starts[1:]])
    return hashes, np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, LITERAL))).astype(np.int8), counts, (between, begins)


_units: list[np.ndarray] = []


def _unit_hashes() -> np.ndarray:
    if not _units:
        _units.append(np.zeros(0, np.uint64))
        text = " ".join(UNITS).encode()
        _units[0] = tokens(np.array([0, len(text)]), np.frombuffer(text, np.uint8))[0]
    return _units[0]


TEMPLATES, NUMBERS, EXACT = range(3)  # placeholders: numbers, units and names; numbers and units; none


def windows(hashes: np.ndarray, kinds: np.ndarray, counts: np.ndarray, width: int, form: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each window within a row. Exact ones are made where numbers and units leave
    too few words for a template."""
    slot = (kinds == NUMBER) | (kinds == UNIT) | ((form == TEMPLATES) & (kinds == NAME))
    word = hashes if form == EXACT else np.where(slot, _KIND[kinds], hashes)
    n = max(0, len(word) - width + 1)
    out = np.full(n, np.uint64(width))
    for j in range(width):
        out += word[j : j + n] * _PLACE[j]
    ends = np.repeat(np.cumsum(counts), counts)[:n]
    literals = np.concatenate([[0], np.cumsum(~slot)])
    enough = literals[width : width + n] - literals[:n] >= min(LEAST_LITERALS, width)
    first = np.flatnonzero((np.arange(n) + width <= ends) & (enough != (form == EXACT)))
    return mix(out[first] + np.uint64(form == EXACT)), first


def wholes(hashes: np.ndarray, signs: tuple[np.ndarray, np.ndarray], counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each run of ``width`` words within a row, with the signs between them. A single
    word is one if it is all of its sentence."""
    between, begins = signs
    n = max(0, len(hashes) - width + 1)
    out = np.full(n, np.uint64(width))
    for j in range(width):
        out += hashes[j : j + n] * _PLACE[j]
        if j:
            out += between[j : j + n] * _PLACE[-j]
    use = np.arange(n) + width <= np.repeat(np.cumsum(counts), counts)[:n]
    if width == 1:
        use &= begins & np.append(begins[1:], True)[:n]
    first = np.flatnonzero(use)
    return mix(out[first]), first


def _parts(hashes, kinds, counts, signs, width) -> list[tuple[np.ndarray, np.ndarray]]:
    if width < LEAST_WORDS:
        return [wholes(hashes, signs, counts, width)]
    return [windows(hashes, kinds, counts, width, form) for form in (TEMPLATES, NUMBERS, EXACT)]


def all_windows(hashes, kinds, counts, signs, width) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each window of all forms; a window whose forms agree stands once."""
    parts = _parts(hashes, kinds, counts, signs, width)
    pair = np.stack([np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.uint64)])
    pair = np.unique(pair, axis=1) if pair.shape[1] else pair
    return pair[0], pair[1].astype(np.int64)


def _fixed(rows: np.ndarray) -> pa.Array:
    """A matrix as binary values, one for each row."""
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize if rows.size else 1
    ends = np.arange(len(rows) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())])


ITEM_WINDOWS = "h bigint, width int, item bigint, item_id bigint, place int, words binary, kinds binary, item_words int, family bigint"


@released
def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of benchmark items with their words; of windows that an item repeats, the first."""
    names = [c.split()[0] for c in ITEM_WINDOWS.split(", ")]
    for batch in batches:
        offsets, data = text_bytes(batch.column(2))
        hashes, kinds, counts, signs = signed_tokens(offsets, data, True)
        starts = np.cumsum(counts) - counts
        of = np.repeat(np.arange(batch.num_rows), counts)
        slot = kinds != LITERAL
        template = mix(np.where(slot, _KIND[kinds], hashes))
        family = np.array([int(mix((template[a : a + n] * (2 * np.arange(n, dtype=np.uint64) + np.uint64(1))).sum(dtype=np.uint64, keepdims=True))[0]) for a, n in zip(starts, counts)], np.uint64)
        key, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        for width in range(1, WINDOW + 1):
            whole = counts >= WINDOW if width == WINDOW else counts == width
            h, at = all_windows(hashes, kinds, counts, signs, width)
            keep = whole[of[at]]
            h, at = h[keep], at[keep]
            if not len(h):
                continue
            once = np.unique(np.stack([of[at].astype(np.uint64), h]), axis=1, return_index=True)[1]  # rows are in order of h, then place
            h, at = h[once], at[once]
            row, steps = of[at], np.arange(width)
            cells = (
                h.astype(np.int64), np.full(len(h), width, np.int32), key[row], ids[row], (at - starts[row]).astype(np.int32),
                _fixed(hashes[at[:, None] + steps]), _fixed(kinds[at[:, None] + steps].astype(np.uint8)), counts[row].astype(np.int32), family[row].astype(np.int64),
            )
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cells], names)


def _doc_windows(shared, widths: list[int]):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        mask = np.uint64(len(bits) * 8 - 1)
        for batch in batches:
            ids, text_hash = batch.column(0), batch.column(1).to_numpy()
            offsets, data = text_bytes(batch.column(2))
            for i, j in slices(offsets, PIECE):
                hashes, kinds, counts, signs = signed_tokens(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]], min(widths, default=WINDOW) < LEAST_WORDS)
                starts = np.cumsum(counts) - counts
                of = np.repeat(np.arange(j - i), counts)
                for width in widths:
                    h, at = _probed(hashes, kinds, counts, signs, width, bits, mask)
                    if not len(h):
                        continue
                    row = of[at]
                    cells = (
                        ids.take(pa.array(row + i)), pa.array(text_hash[row + i]), pa.array(h.astype(np.int64)), pa.array(np.full(len(h), width, np.int32)),
                        pa.array((at - starts[row]).astype(np.int32)), _fixed(hashes[at[:, None] + np.arange(width)]),
                    )
                    yield pa.RecordBatch.from_arrays(list(cells), ["id", "text_hash", "h", "width", "d_place", "d_words"])

    return run


def _probed(hashes, kinds, counts, signs, width, bits, mask) -> tuple[np.ndarray, np.ndarray]:
    """The windows that the filter may hold."""
    found = []
    for h, first in _parts(hashes, kinds, counts, signs, width):
        at = h & mask
        hit = (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        found.append(np.stack([h[hit], first[hit].astype(np.uint64)]))
    pair = np.concatenate(found, axis=1)
    pair = np.unique(pair, axis=1) if pair.shape[1] else pair
    return pair[0], pair[1].astype(np.int64)


def consistent(i_at: np.ndarray, doc: np.ndarray, item: np.ndarray, kinds: np.ndarray) -> tuple[set[int], bool]:
    """Words of an item covered by windows of one alignment whose slots are consistent, and whether a slot
    holds another value than in the item. ``i_at``: first words of the windows; ``doc``, ``item``, ``kinds``: a row of words each."""
    width = doc.shape[1]
    place, first = np.unique((i_at[:, None] + np.arange(width)).ravel(), return_index=True)
    d, w, k = doc.ravel()[first], item.ravel()[first], kinds.ravel()[first]
    other = d != w
    counted = np.flatnonzero((k > 0) | other)
    seen: dict[int, Counter] = defaultdict(Counter)
    for x in counted:
        seen[int(w[x])][int(d[x])] += 1
    meant = {value: c.most_common(1)[0][0] for value, c in seen.items()}
    bad = {int(place[x]) for x in counted if int(d[x]) != meant[int(w[x])]}
    covered: set[int] = set()
    for a in i_at.tolist():
        own = range(a, a + width)
        if not bad or bad.isdisjoint(own):
            covered.update(own)
    changed = set(place[other].tolist())
    return covered, not changed.isdisjoint(covered)


def longest_run(words: set[int]) -> int:
    """The largest number of consecutive members."""
    at = np.sort(np.fromiter(words, np.int64, len(words)))
    ends = np.append(np.flatnonzero(np.diff(at) != 1), len(at) - 1)
    return int(np.diff(ends, prepend=-1).max()) if len(at) else 0


@released
def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents and items whose consistent windows suffice; a row has all windows of a document and an item."""
    names = ["id", "item_id", "covered_words", "item_words", "reparameterised"]
    for batch in batches:
        cells = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
        keep, covered_words, changed_rows = [], [], []
        for row in range(batch.num_rows):
            found = cells["windows"][row].values
            width, d_place, i_place = (found.field(k).to_numpy() for k in range(3))
            d_words, i_words, i_kinds = (found.field(k) for k in (3, 4, 5))
            covered: set[int] = set()
            run, changed = 0, False
            lines = np.stack([width, d_place - i_place])
            for w, shift in np.unique(lines, axis=1).T:
                own = np.flatnonzero((lines[0] == w) & (lines[1] == shift))
                matrix = lambda a, kind: np.frombuffer(b"".join(a[int(x)].as_py() for x in own), kind).reshape(len(own), -1)  # noqa: E731, B023
                got, other = consistent(i_place[own], matrix(d_words, np.uint64), matrix(i_words, np.uint64), matrix(i_kinds, np.uint8))
                covered |= got
                run = max(run, longest_run(got))
                changed |= other and bool(got)
            if covered and (len(covered) >= LEAST_SHARE * cells["told"][row].as_py() or run >= LEAST_RUN):
                keep.append(row)
                covered_words.append(len(covered))
                changed_rows.append(changed)
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [cells["id"].take(at), cells["item_id"].take(at), pa.array(covered_words, pa.int64()), cells["item_words"].take(at), pa.array(changed_rows, pa.bool_())], names
        )


def item_windows(items: DataFrame) -> DataFrame:
    """The telling windows of the benchmark (item_id, text), stored; ``told`` is how many of an item's words they hold."""
    keyed = items.withColumn("item", F.monotonically_increasing_id()).select("item", "item_id", "text")
    every = stored(keyed.mapInArrow(_item_windows, ITEM_WINDOWS), "windows")
    often = every.groupBy("h").agg(F.count_distinct("family").alias("families")).filter(F.col("families") > COMMON_ITEMS).select("h", F.lit(True).alias("common"))
    marked = every.join(often, "h", "left").withColumn("common", F.coalesce("common", F.lit(False)))
    places = F.flatten(F.collect_list(F.when(~F.col("common") | F.col("none"), F.sequence("place", F.col("place") + F.col("width") - 1))))
    none = marked.groupBy("item").agg(F.bool_and("common").alias("none"))
    told = marked.join(none, "item").groupBy("item", "none").agg(F.size(F.array_distinct(places)).alias("told"))
    return stored(marked.join(told, "item").filter("not common or none").drop("common", "none", "family"), "telling")


def _filter_bits(hashes: DataFrame) -> bytes:
    """A bit for each window hash, of a number of bits that is bounded whatever the benchmark."""
    least, most = FILTER_BITS
    n = least
    while n < min(most, 16 * hashes.count()):
        n *= 2
    at = F.col("h").bitwiseAND(F.lit(n - 1))
    buckets = hashes.groupBy(F.expr(f"(h & {n - 1}L) div {BUCKET_BITS}").alias("bucket")).agg(F.bitmap_construct_agg(at % BUCKET_BITS).alias("bits"))
    out = bytearray(n // 8)
    for bucket, bits in buckets.toLocalIterator():
        out[bucket * BUCKET_BITS // 8 : (bucket + 1) * BUCKET_BITS // 8] = bits
    return bytes(out)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, covered_words, item_words, reparameterised) for every document and item in it.

    Null and empty texts match nothing, and an empty benchmark nothing at all. Rows repeating id and text count once; rows of one
    id with other texts are matched one by one. Items repeating an id, or a text, are items of their own. A slot that stands
    for two values equally often means the one that comes first. Columns besides those named may have any name.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter("text is not null")
    telling = item_windows(items)
    widths = sorted(r[0] for r in telling.select("width").distinct().collect())
    shared = spark.sparkContext.broadcast(_filter_bits(telling.select("h").distinct()))
    kind = docs.schema["id"].dataType.simpleString()
    seen = docs.mapInArrow(_doc_windows(shared, widths), f"id {kind}, text_hash bigint, h bigint, width int, d_place int, d_words binary")
    met = seen.join(telling, ["h", "width"]).groupBy("id", "text_hash", "item", "item_id", "item_words", "told").agg(
        F.collect_set(F.struct("width", "d_place", F.col("place").alias("i_place"), "d_words", F.col("words").alias("i_words"), F.col("kinds").alias("i_kinds"))).alias("windows")
    )
    found = met.select("id", "item_id", F.col("item_words").cast("bigint").alias("item_words"), "told", "windows").mapInArrow(
        _judged, f"id {kind}, item_id bigint, covered_words bigint, item_words bigint, reparameterised boolean"
    )
    return found.withColumnRenamed("id", id_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id has no match. Columns as they were; rows with a null id stay."""
    found = stored(matches(docs, benchmark, id_col, text_col).select(id_col).distinct(), "contaminated")
    return docs.join(small(found, found.count()), id_col, "left_anti").select(*docs.columns)
