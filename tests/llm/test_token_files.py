import random
import zlib

import numpy as np
import pytest

from shelfledger.llm import token_files

P = pytest.importorskip("public_tokenizers")
TOKENIZER = P.path("byte_bpe_50k.json")


def want(rows):
    from tokenizers import Tokenizer

    encoder, start, out = Tokenizer.from_file(TOKENIZER), 0, []
    for i, t in rows:
        ids = np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_planes_round_trip():
    rng = np.random.default_rng(0)
    for top in (1, 200, 50_000, 2**31):
        for n in (1, 2, 1000, 65536):
            ids = rng.integers(0, top, n).astype(np.uint32)
            planes = token_files.to_planes(ids)
            assert len(planes) <= 4 and (token_files.from_planes(planes, n) == ids).all()
    assert token_files.from_planes(token_files.to_planes(np.zeros(0, np.uint32)), 0).size == 0


@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_files_read_back_as_encoded(spark, docs, tmp_path, chunk):
    rng = random.Random(chunk)
    rows = [(i, " ".join(rng.choice(["the", "Ünï", "code\n", "ζ", "42"]) for _ in range(rng.choice([0, 1, 9, 60])))) for i in range(-20, 60)]
    rows += [(70, None), (71, ""), (72, "\n\n x"), (73, "a" * 20000)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    path = str(tmp_path / "t")
    token_files.write(docs(shuffled).withColumnRenamed("lang", "shard"), path, TOKENIZER, chunk_ids=chunk)
    assert sorted(tuple(r) for r in token_files.read(spark, path).collect()) == sorted(want(rows))
    index = token_files.index(spark, path)
    assert "planes" not in index.columns and index.agg({"n": "sum"}).first()[0] == sum(r[2] for r in want(rows))


def test_repeated_and_null_ids(spark, docs, tmp_path):
    rows = [(None, "first"), (1, "same"), (1, "same"), (1, "other")]
    path = str(tmp_path / "t")
    token_files.write(docs(rows), path, TOKENIZER)
    got = token_files.read(spark, path).collect()
    assert len(got) == 4 and min(got, key=lambda r: r.start).doc_id is None
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_empty_table(spark, docs, tmp_path):
    path = str(tmp_path / "t")
    token_files.write(docs([]), path, TOKENIZER)
    assert token_files.read(spark, path).collect() == []


def test_damaged_chunk_is_noticed(spark, docs, tmp_path):
    path, other = str(tmp_path / "t"), str(tmp_path / "u")
    token_files.write(docs([(1, "some words")]), path, TOKENIZER)
    spark.read.parquet(path).selectExpr("* except (check)", "check + 1 AS check").write.parquet(other)
    with pytest.raises(Exception, match="differ from their check"):
        token_files.read(spark, other).collect()


def test_encoding_by_distinct_words_equals_encoding_whole_texts():
    rng = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\t", " ", " ", "\x1c", "é", "'s", "'", "12", "!", "\u3000", "<|endoftext|>", "“", "中", "\r\n", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(5000)] + ["", " ", "a ", "a  ", " a"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    encoder = token_files.Encoder(TOKENIZER)
    for _ in range(2):
        ids, counts = encoder.encode(offsets, np.frombuffer(b"".join(raw), np.uint8))
        assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [
            e.ids for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]
        encoder.forget()


def test_ids_do_not_depend_on_the_next_text(tmp_path):
    import pyarrow as pa
    from tokenizers import Tokenizer, models, pre_tokenizers

    from shelfledger.llm.words import text_bytes

    letters = sorted(pre_tokenizers.ByteLevel.alphabet())
    vocab = {x: k for k, x in enumerate([*letters, "\u0120\u0120"])}
    tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=[("\u0120", "\u0120")]))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tokenizer.save(path := str(tmp_path / "blanks.json"))
    texts = ["a  ", "b", " ", "c  ", "", "d  e", "\n ", "f"]
    offsets, data = text_bytes(pa.array(texts, pa.string()))
    ids, counts = token_files.Encoder(path).encode(offsets, data)
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
