"""Token ids as byte planes: a chunked, compressed file format, its writer and its reader.

Documents are dealt to shards by ranges of ascending id and encoded in order. A shard's ids are cut into
chunks of CHUNK_IDS. A chunk's ids, as little-endian unsigned integers, are transposed into byte planes
(all lowest bytes, then all second bytes, ...), each compressed with zstandard; planes of zeros only are
left out. A file is a Parquet table with a row per chunk, so Spark's committer puts it in place whole or
not at all, on any storage Spark reaches:

    shard, chunk          place of the chunk
    first, n              ids of the shard before it, and in it
    doc_ids, doc_first, doc_tokens   the documents with ids in the chunk: id, first id in the shard, number of ids
    check                 crc32 of the ids as unsigned 32-bit integers
    planes                the compressed planes

All columns but the last are the chunk index: reading them alone touches no ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfledger.llm.common import released
from shelfledger.llm.words import mix, slices, span_hashes, text_bytes

CHUNK_IDS = 1 << 16
END_ID = 2
LEVEL = 3
BATCH_BYTES = 1 << 20
TOGETHER_BYTES = 1 << 16  # of new words that are encoded as one text
KNOWN_WORDS = 1_000_000  # distinct words an encoder remembers, in about 50 MB, before it starts anew
SCHEMA = """shard int, chunk int, first bigint, n bigint, doc_ids array<bigint>, doc_first array<bigint>,
    doc_tokens array<bigint>, check bigint, planes array<binary>"""


def to_planes(ids: np.ndarray) -> list[bytes]:
    """The compressed byte planes of 32-bit ids, lowest byte first, without the highest all-zero ones."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    used = max((k + 1 for k in range(4) if planes[k].any()), default=0)
    pack = zstandard.ZstdCompressor(level=LEVEL)
    return [pack.compress(planes[k].tobytes()) for k in range(used)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    unpack = zstandard.ZstdDecompressor()
    for k, plane in enumerate(planes):
        out[:, k] = np.frombuffer(unpack.decompress(plane, max_output_size=max(n, 1)), np.uint8)
    return out.view("<u4").ravel()


_VALUE = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
# Bytes after a blank that may begin white space: there the text isn't cut.
_MAY_BE_GAP = np.zeros(256, bool)
_MAY_BE_GAP[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = True


class Encoder:
    """Encodes texts by their distinct words.

    A byte-level tokenizer's splitting rule never joins a blank to what stands before it if the next
    character is no white space, and looks no further back. So a text is cut before such blanks, each
    distinct piece is encoded once by the tokenizer, and the ids are put together by array indexing. Pieces are
    told apart by 64-bit hashes.

    New pieces that begin with such a blank are encoded in one call, as one text. Where its pieces end
    among the ids follows from the bytes of the tokens; if an end falls inside a token, as with vocabularies whose
    tokens don't spell their bytes, each piece is encoded by itself.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        tokens = (self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size()))
        self.bytes = np.array([len(t or "") for t in tokens], np.int64)  # byte-level tokens have a character for each byte
        self.forget()

    def forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes in order, and where their ids are told
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _keep(self, hashes: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
        """Remembers the ids of new pieces, those of piece n ending at ``ends[n]``."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        length = np.diff(ends, prepend=0)
        order = np.argsort(hashes)
        at = np.searchsorted(self.known, hashes[order])
        self.known = np.insert(self.known, at, hashes[order])
        self.place = np.insert(self.place, at, len(self.start) + order)
        self.start = np.append(self.start, self.used + ends - length)
        self.length = np.append(self.length, length.astype(np.int32))
        self.used += len(ids)

    def _together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of pieces encoded as one text and where each piece's ids end; None if a piece doesn't end where a token does."""
        ids = np.array(self.tokenizer.encode_batch_fast([b"".join(pieces).decode()], add_special_tokens=False)[0].ids, np.int64)
        after = np.cumsum(self.bytes[ids])
        want = np.cumsum([len(p) for p in pieces])
        ends = np.searchsorted(after, want)
        if not len(ids) or after[-1] != want[-1] or (after[ends] != want).any():
            return None
        return ids.astype(np.uint32), ends + 1

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        led = np.array([len(p) > 1 and p[0] == 32 and not _MAY_BE_GAP[p[1]] for p in pieces])
        of = np.flatnonzero(led)
        size = np.cumsum([len(pieces[k]) for k in of]) // TOGETHER_BYTES
        for own in np.split(of, np.flatnonzero(np.diff(size)) + 1):
            found = self._together([pieces[k] for k in own]) if len(own) else None
            if found:
                self._keep(hashes[own], *found)
            else:
                led[own] = False
        hashes, pieces = hashes[~led], [p for p, x in zip(pieces, led) if not x]
        if pieces:
            ids = [f.ids for f in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
            self._keep(hashes, np.fromiter((i for x in ids for i in x), np.uint32), np.cumsum([len(x) for x in ids]))

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the number of ids of each."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-2] = (data[1:-1] == 32) & ~_MAY_BE_GAP[data[2:]] if len(data) > 2 else False
        cut[offsets[1:][offsets[1:] > 0] - 1] = False  # what follows a text's last byte is another text
        cut[offsets] = True
        cut[len(data)] = False
        starts = np.flatnonzero(cut[:-1])
        ends = np.append(starts[1:], len(data))
        keys, first, which = np.unique(span_hashes(_VALUE[data], starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, keys)
        new = np.flatnonzero(np.append(self.known, np.uint64(0))[at] != keys) if len(self.known) else np.arange(len(keys))
        if len(new):
            raw = data.tobytes()
            self._learn(keys[new], [raw[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            at = np.searchsorted(self.known, keys)
        place = self.place[at][which] if len(keys) else np.zeros(0, np.int32)
        length = self.length[place]
        upto = np.cumsum(length, dtype=np.int64)
        steps = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - length, length)
        ids = self.ids[np.repeat(self.start[place], length) + steps]
        sums = np.concatenate([[0], upto])[np.searchsorted(starts, offsets)]
        return ids, np.diff(sums)


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _chunks(tokenizer: str, size: int):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        docs: list[tuple] = []  # of those with ids not yet put out: id, first, number
        held: list[np.ndarray] = []
        first = at = 0  # ids put out, ids seen
        chunk, shard = 0, None

        def put(ids: np.ndarray) -> pa.RecordBatch:
            row = (
                [shard], [chunk], [first], [len(ids)], [[d[0] for d in docs]], [[d[1] for d in docs]], [[d[2] for d in docs]],
                [zlib.crc32(ids.astype("<u4").tobytes())], [to_planes(ids)],
            )
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.int64(), pa.list_(pa.binary()))
            names = ["shard", "chunk", "first", "n", "doc_ids", "doc_first", "doc_tokens", "check", "planes"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column(0)[0].as_py()
            names = batch.column(1).to_pylist()
            offsets, data = text_bytes(batch.column(2))
            for i, j in slices(offsets, BATCH_BYTES):
                own = offsets[i : j + 1] - offsets[i]
                found, counts = encoder.encode(own, data[offsets[i] : offsets[j]])
                for name, part in zip(names[i:j], np.split(found, np.cumsum(counts)[:-1])):
                    ids = np.append(part, np.uint32(END_ID))
                    docs.append((name, at, len(ids)))
                    at += len(ids)
                    held.append(ids)
                    if at - first < size:
                        continue
                    rest = np.concatenate(held)
                    while len(rest) >= size:
                        late = [d for d in docs if d[1] >= first + size]
                        docs = [d for d in docs if d[1] < first + size]
                        yield put(rest[:size])
                        rest, first, chunk = rest[size:], first + size, chunk + 1
                        docs = [d for d in docs if d[1] + d[2] > first] + late
                    held = [rest] if len(rest) else []
        if held:
            yield put(np.concatenate(held))

    return run


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
          chunk_ids: int = CHUNK_IDS) -> None:
    """Writes ``docs`` in ascending id order (null first; rows of one id by text hash) below ``path``.

    Null text is empty: the end id alone. ``tokenizer``: path of a tokenizers file on every executor.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(parts, "id", "hash", "row").sortWithinPartitions("id", "hash", "row")
    chunks = ordered.select(F.spark_partition_id().alias("shard"), "id", "text").mapInArrow(_chunks(tokenizer, chunk_ids), SCHEMA)
    chunks.write.option("compression", "none").parquet(path)


def index(spark: SparkSession, path: str) -> DataFrame:
    """The chunk index of the files below ``path``, with the number of ids before each shard."""
    chunks = spark.read.schema(SCHEMA).parquet(path).drop("planes")
    shards = chunks.groupBy("shard").agg(F.sum("n").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")  # a row for each shard
    return chunks.join(shards.select("shard", before.alias("shard_start")), "shard")


@released
def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document and chunk: whole documents with their crc32, others with this chunk's ids."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = from_planes(row["planes"], row["n"])
            if zlib.crc32(ids.tobytes()) != row["check"]:
                raise ValueError(f"shard {row['shard']}, chunk {row['chunk']}: ids differ from their check")
            lo, hi = row["first"], row["first"] + row["n"]
            out = []
            for doc, first, n in zip(row["doc_ids"], row["doc_first"], row["doc_tokens"]):
                part = ids[max(first, lo) - lo : min(first + n, hi) - lo]
                whole = len(part) == n
                out.append((row["shard"], doc, first, n, max(first, lo), zlib.crc32(part.tobytes()) if whole else None, None if whole else part.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), *[pa.int64()] * 5, pa.binary()))],
                    ["shard", "doc_id", "first", "n_tokens", "at", "crc", "ids"],
                )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files below ``path``.

    Only documents cut by a chunk's edge, two at most for each chunk, are put together by a shuffle.
    """
    chunks = spark.read.schema(SCHEMA).parquet(path)
    pieces = chunks.select("shard", "chunk", "first", "n", "doc_ids", "doc_first", "doc_tokens", "check", "planes").mapInArrow(
        _pieces, "shard int, doc_id bigint, first bigint, n_tokens bigint, at bigint, crc bigint, ids binary"
    )
    whole = pieces.filter("crc is not null").select("shard", "doc_id", "first", "n_tokens", F.col("crc").alias("ids_crc32"))
    cut = (
        pieces.filter("crc is null").groupBy("shard", "first", "doc_id", "n_tokens")
        .agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("parts"))
        .select("shard", "doc_id", "first", "n_tokens", F.crc32(F.expr("aggregate(parts, cast('' AS binary), (a, p) -> concat(a, p.ids))")).alias("ids_crc32"))
    )
    starts = index(spark, path).select("shard", "shard_start").distinct()
    return whole.union(cut).join(starts, "shard").select(
        "doc_id", (F.col("shard_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
