import hashlib
import random

import public_tokenizers
import pytest
import regex

from profitlens.llm.bpe import CHUNK_CHARS, SAFE_CUT, bpe_decode, bpe_encode, digests, encoding, pieces

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def enc():
    with open(RANKS, "rb") as f:
        return encoding(f.read(), public_tokenizers.PATTERN)


def test_cuts_change_no_id(enc):
    cut, rng = regex.compile(SAFE_CUT), random.Random(1)
    parts = ["a", "Été", "12", " ", "  ", "\n", "\t\n", "'s", "'", "don't", "…", "%%%", "字字", "é́", " ", "🙂", "x'll"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 60)))
        for size in (1, 3, 7):
            cutted = list(pieces(text, cut, size))
            assert "".join(cutted) == text
            assert [i for p in cutted for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_endless_word_is_one_piece():
    assert list(pieces("a" * (3 * CHUNK_CHARS), regex.compile(SAFE_CUT))) == ["a" * (3 * CHUNK_CHARS)]


def test_whole_texts_and_round_trip(odd, enc):
    ids = bpe_encode(odd, "text", RANKS, public_tokenizers.PATTERN)
    both = bpe_decode(ids, "token_ids", RANKS, public_tokenizers.PATTERN)
    assert sorted(both.columns) == sorted(odd.columns)
    rows = both.select("text", "token_ids", "decoded").collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.token_ids == enc.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_digests(spark, odd, enc):
    ids = bpe_encode(odd, "text", RANKS, public_tokenizers.PATTERN)
    got = digests(bpe_decode(ids, "token_ids", RANKS, public_tokenizers.PATTERN)).collect()
    want = []
    for r in odd.select("doc_id", "text").collect():
        i = enc.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_raw_bytes_of_cut_characters(spark, enc):
    ids = enc.encode_ordinary("é字🙂")
    df = spark.createDataFrame([([i],) for i in ids] + [([],), (None,), ([ids[0], None],)], "ids array<int>")
    got = [bytes(r.decoded) for r in bpe_decode(df, "ids", RANKS, public_tokenizers.PATTERN).collect()]
    assert got == [enc.decode_bytes([i]) for i in ids] + [b"", b"", enc.decode_bytes([ids[0]])]


def test_empty_table(empty):
    assert bpe_decode(bpe_encode(empty, "text", RANKS, public_tokenizers.PATTERN), "token_ids", RANKS,
                      public_tokenizers.PATTERN).count() == 0


def test_few_values_are_held_at_once():
    import pyarrow as pa

    from profitlens.llm.bpe import values

    column = pa.array([None if i % 7 == 0 else [i, None] for i in range(500)]).slice(3, 400)
    assert list(values(column)) == column.to_pylist() and list(values(column.slice(0, 0))) == []
    it = values(column)
    next(it)
    assert len(it.gi_yieldfrom.__reduce__()[1][0]) <= 32
