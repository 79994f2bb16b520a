"""Language identification by n-gram filters that hold one bit per language.

An n-gram is three or four letters within a word, lower-cased, with the word's edges. The filters are
Bloom filters of one size and one set of probes, one per language, stored bit-sliced: a slot holds a
mask with a bit for each language, so the AND of an n-gram's slots names all languages that contain it.
A text's n-grams are counted per bit; each count is corrected for the filter's chance hits; the largest
corrected share decides, the smaller language name in a tie.

A language contains an n-gram if its relative frequency there is at least a quarter of that in the
language where it is most frequent, so words quoted from elsewhere don't enter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfledger.llm.chars import code_points, tables
from shelfledger.llm.common import released, stored
from shelfledger.llm.words import mix, slices, text_bytes

PROBES, SHIFT = 3, 21
SAMPLE_PER_LANGUAGE = 4000  # labelled rows the filters are fitted on, about, chosen by hash of the id
LEAST_COUNT, LEAST_SHARE = 3, 0.25
MIN_SLOTS, MAX_SLOTS = 1 << 16, 1 << 21  # of 8 bytes per 64 languages: 16 MB at most
PIECE = 1 << 18
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """``slots``: (slots, words of 64 languages); ``chance``: share of random n-grams a language seems to hold."""

    languages: list[str]
    slots: np.ndarray
    chance: np.ndarray


def ngrams(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the rows' n-grams and the row of each, in pieces."""
    t = tables()
    at, codes = code_points(offsets, data)
    letters = np.where(t["letter"][codes], t["lower"][codes], np.uint32(0))
    rows = len(at) - 1
    seq = np.insert(letters, at[:-1], np.uint32(0))
    row = np.repeat(np.arange(rows), np.diff(at) + 1)
    keep = np.ones(len(seq), bool)
    keep[1:] = (seq[1:] != 0) | (seq[:-1] != 0) | (row[1:] != row[:-1])
    seq, row = np.append(seq[keep], np.zeros(4, np.uint32)).astype(np.uint64), np.append(row[keep], [-1] * 4)
    for i in range(0, len(seq) - 4, PIECE):
        j = min(i + PIECE, len(seq) - 4)
        c = [seq[i + k : j + k] for k in range(4)]
        first = row[i:j]
        inner = c[1] != 0
        three = np.flatnonzero(inner & ((row[i + 2 : j + 2] == first) | (c[2] == 0)))
        base = c[0] * np.uint64(0x9E3779B97F4A7C15) + c[1] * np.uint64(0xC2B2AE3D27D4EB4F) + c[2] * np.uint64(0x165667B19E3779F9)
        yield mix(base[three]), first[three]
        four = np.flatnonzero(inner & (c[2] != 0) & (row[i + 2 : j + 2] == first) & ((row[i + 3 : j + 3] == first) | (c[3] == 0)))
        yield mix(base[four] + c[3][four] * np.uint64(0x27D4EB2F165667C5) + np.uint64(1)), first[four]


@released
def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = text_bytes(batch.column(1))
        language = batch.column(0).to_numpy()
        for i, j in slices(offsets, PIECE):
            for grams, row in ngrams(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]]):
                order = np.lexsort((grams, language[i:j][row]))
                grams, lang = grams[order], language[i:j][row][order]
                first = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]) | (lang[1:] != lang[:-1])])) if len(grams) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[first].astype(np.int64)), pa.array(lang[first]), pa.array(np.diff(np.append(first, len(grams))).astype(np.int64))],
                    ["gram", "language", "n"],
                )


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fits the filters on rows with a language, about SAMPLE_PER_LANGUAGE of each."""
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    per = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(per)
    if not languages:
        return Model([], np.zeros((MIN_SLOTS, 1), np.uint64), np.zeros(0))
    names = F.array(*[F.lit(x) for x in languages])
    bounds = F.array(*[F.lit(min(1.0, SAMPLE_PER_LANGUAGE / per[x])) for x in languages])
    place = (F.array_position(names, F.col("lang")) - 1).cast("int")
    draw = F.shiftrightunsigned(F.xxhash64("id", "lang"), 11).cast("double") / float(1 << 53)
    sample = rows.withColumn("language", place).filter(draw < F.element_at(bounds, F.col("language") + 1)).select("language", "text")
    counts = stored(
        sample.mapInArrow(_counts, "gram bigint, language int, n bigint").groupBy("gram", "language").agg(F.sum("n").alias("n")), "ngrams"
    )
    sums = {r["language"]: r["n"] for r in counts.groupBy("language").agg(F.sum("n").alias("n")).collect()}
    totals = F.array(*[F.lit(float(max(1, sums.get(k, 0)))) for k in range(len(languages))])
    rate = F.col("n") / F.element_at(totals, F.col("language") + 1)
    held = counts.filter(F.col("n") >= LEAST_COUNT).withColumn("rate", rate)
    held = held.join(held.groupBy("gram").agg(F.max("rate").alias("top")), "gram").filter(F.col("rate") >= LEAST_SHARE * F.col("top"))
    held = stored(held.select("gram", "language"), "held")
    grams = held.select("gram").distinct().count()
    slots = MIN_SLOTS
    while slots < min(MAX_SLOTS, 8 * PROBES * grams):
        slots *= 2
    probes = F.array(*[F.shiftrightunsigned("gram", SHIFT * p).bitwiseAND(F.lit(slots - 1)) for p in range(PROBES)])
    masks = (
        held.select(F.explode(probes).alias("slot"), F.expr("language div 64").alias("word"), F.expr("shiftleft(1L, language % 64)").alias("bit"))
        .groupBy("slot", "word").agg(F.bit_or("bit").alias("mask")).toPandas()
    )
    table = np.zeros((slots, (len(languages) + 63) // 64), np.int64)
    table[masks["slot"].to_numpy(np.int64), masks["word"].to_numpy(np.int64)] = masks["mask"].to_numpy(np.int64)
    table = table.view(np.uint64)
    fill = np.array([((table[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))])
    return Model(languages, table, fill**PROBES)


def shares(model: Model, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corrected share of each row's n-grams held by each language, and the number of n-grams."""
    rows = len(offsets) - 1
    hits, total = np.zeros((rows, len(model.languages))), np.zeros(rows)
    last = np.uint64(len(model.slots) - 1)
    for grams, row in ngrams(offsets, data):
        if not len(grams):
            continue
        mask = model.slots[(grams & last).astype(np.int64)]
        for p in range(1, PROBES):
            mask = mask & model.slots[((grams >> np.uint64(SHIFT * p)) & last).astype(np.int64)]
        lo, hi = row[0], row[-1] + 1
        total[lo:hi] += np.bincount(row - lo, minlength=hi - lo)
        for k in range(len(model.languages)):
            own = row[((mask[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).astype(bool)]
            hits[lo:hi, k] += np.bincount(own - lo, minlength=hi - lo)
    observed = hits / np.maximum(total, 1)[:, None]
    return np.clip((observed - model.chance) / (1 - model.chance), 0, 1), total


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns with lang_pred and score (the winner's corrected share, 0 to 1).

    A null text, one without a letter, or a model of no language gives ``und`` and 0; of languages with equal shares the first by
    name wins. Carried columns named lang_pred or score are replaced; others may have any name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carry = tuple(c for c in carry if c.lower() not in ("lang_pred", "score"))
    carried = len(carry)
    own = "text"
    while own in {c.lower() for c in carry}:
        own += "_"

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], dtype=object)
        for batch in batches:
            offsets, data = text_bytes(batch.column(carried))
            for i, j in slices(offsets, PIECE):
                share, total = shares(m, offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]])
                known = (total > 0) & bool(m.languages)
                best = share.argmax(axis=1) if m.languages else np.zeros(j - i, np.int64)
                score = share[np.arange(j - i), best] if m.languages else np.zeros(j - i)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:carried], pa.array(names[np.where(known, best, -1)], pa.string()), pa.array(np.where(known, score, 0.0))],
                    [*part.schema.names[:carried], "lang_pred", "score"],
                )

    frame = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(text_col).cast("string").alias(own))
    schema = T.StructType([*frame.schema.fields[:carried], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return frame.mapInArrow(run, schema)
