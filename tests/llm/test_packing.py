import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from linksift.llm.common import fresh_path, tokenizer_file
from linksift.llm.packing import WordCache, bits_for, encoder, pack, read_ids, token_files, unpack, write_packed

PATH = tokenizer_file("byte_bpe_50k.json")


def test_pack_round_trip_and_random_access():
    assert [bits_for(n) for n in (1, 2, 3, 50257, 65536, 65537)] == [1, 1, 2, 16, 16, 17]
    rng = np.random.default_rng(1)
    for bits in (1, 5, 8, 15, 16, 17, 31, 32):
        ids = rng.integers(0, 2**bits, 999).astype("<u4")
        data = pack(ids, bits)
        assert len(data) == -(-999 * bits // 8)
        assert (unpack(data, bits, 999) == ids).all()
        assert (unpack(data, bits, 7, 501) == ids[501:508]).all()
        assert len(unpack(data, bits, 0, 3)) == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"ab .,'1-\n\té", " ", "<|endoftext|>", "\x1c", "　"]), max_size=20), max_size=5))
def test_words_give_the_ids_of_whole_texts(parts):
    enc, texts = encoder(PATH), ["".join(p) for p in parts]
    assert enc.encode(texts) == [enc.library(t) for t in texts]


def test_full_cache_changes_nothing():
    small = WordCache(PATH, limit=3)
    texts = ["aa bb, cc dd", "ee ff. gg", "hh ii jj kk ll"] * 2
    assert [small.encode([t])[0] for t in texts] == [small.library(t) for t in texts]


def expected(rows, enc):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = np.append(np.frombuffer(enc.library(text or ""), "<u4"), [2]).astype("<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_against_the_library(spark, odd_docs, documents):
    enc = encoder(PATH)
    for docs in (odd_docs, documents):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = token_files(docs, fresh_path(spark, "t"), PATH).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows, enc)


def test_empty_table(spark, no_docs):
    assert token_files(no_docs, fresh_path(spark, "t"), PATH).collect() == []


def test_any_run_of_ids_can_be_read(spark, documents):
    enc, path = encoder(PATH), fresh_path(spark, "t")
    write_packed(documents.coalesce(1), path, PATH)
    blocks = spark.read.parquet(path).orderBy("part", "first").collect()
    whole = np.concatenate([unpack(b.payload, b.bits, b.n_ids) for b in blocks if b.part == blocks[0].part])
    for start, n in ((0, 5), (len(whole) // 2, 70_000), (len(whole) - 3, 10)):
        assert (read_ids(spark, path, blocks[0].part, start, n) == whole[start : start + n]).all()
    assert enc.vocabulary == 50257
