"""Token output: the coder's round trip, damage, and the query against a
plain tokenization."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldlens.llm import queries, token_codec, token_output

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, " ", "Hello, World!  it's 1234 o'clock; don't\n\nstop.", "naïve Ça Ñandú × ÷ ß…. a×b., …..", "é é. ́x",
         "<|endoftext|> x<|endoftext|>y <|ENDOFTEXT|> endoftext", "a.b,c;d!e?f)g\"h", "日本語 テスト。abc", "İstanbul ǅ  x y\x85z\x1fq",
         "x" * 70_000, "the end " * 30_000, "\t\v\f\r\n a", "?!?!... ,,,\n ,a", "'s 't s't's", "ÀÉÎõü÷ø", "ΑΣ ας ΣΑΣ."]


LIBRARY = Tokenizer.from_file(WORDS)
BY_WORD = token_output.Encoder(open(WORDS, encoding="utf-8").read())


def plain(texts, end_id=1):
    return [LIBRARY.encode(x or "", add_special_tokens=False).ids + [end_id] for x in texts]


@given(st.lists(st.lists(st.integers(0, 65535) | st.integers(0, 5), max_size=700), max_size=6))
@settings(max_examples=30, deadline=None)
def test_blocks_round_trip(blocks):
    blocks = [np.array(b, dtype=np.uint16) for b in blocks]
    assert all(np.array_equal(a, b) for a, b in zip(blocks, token_codec.decode(token_codec.encode(blocks))))


def test_blocks_are_coded_alone():
    rng = np.random.default_rng(0)
    blocks = [rng.zipf(1.3, n) % 50_000 for n in (8192, 0, 1, 63, 64, 65, 1024, 1025, 3000, 8191)]
    together = token_codec.encode(blocks)
    assert together == [token_codec.encode([b])[0] for b in blocks]
    assert len(together[0]) < 2 * 8192 * 0.9
    assert all(np.array_equal(a, b) for a, b in zip(blocks[::-1], token_codec.decode(together[::-1])))


def test_predictions_adapt():
    one = token_codec.encode([np.full(8192, 40_000), np.tile(np.arange(100), 82)[:8192], np.arange(8192)])
    assert len(one[0]) < 250 and len(one[1]) < 1500 and len(one[2]) > 8192


@pytest.mark.parametrize("change", [lambda b: b[:10], lambda b: b[:-1], lambda b: b"XXXX" + b[4:], lambda b: b + b"\1",
                                    lambda b: b[:40] + bytes([b[40] ^ 1]) + b[41:], lambda b: b[:8] + b"abcd" + b[12:]])
def test_damage_is_found(change):
    block = token_codec.encode([np.arange(500)])[0]
    with pytest.raises(ValueError):
        token_codec.decode([change(block)])


def test_words_encode_as_whole_texts():
    assert BY_WORD.by_word
    for _ in range(2):
        data = "".join(t or "" for t in TEXTS).encode()
        offsets = np.cumsum([0] + [len((t or "").encode()) for t in TEXTS])
        ids, sizes = BY_WORD.run(np.frombuffer(data, np.uint8), offsets)
        cut = np.split(ids, np.cumsum(sizes)[:-1])
        assert [c.tolist() + [1] for c in cut] == plain(TEXTS)


@given(st.lists(st.text(alphabet="aZéÇß×÷'., \ń!?)\"<|>sendotx1٣…", max_size=30), max_size=8))
@settings(max_examples=200, deadline=None)
def test_cuts_change_no_id(texts):
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    ids, sizes = BY_WORD.run(np.frombuffer("".join(texts).encode(), np.uint8), offsets)
    assert ids.tolist() == [i for one in plain(texts) for i in one[:-1]]
    assert sizes.tolist() == [len(one) - 1 for one in plain(texts)]


def test_another_tokenizer_takes_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = token_output.Encoder(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    texts = ["Hello  world", "", " a\nb"]
    ids, sizes = encoder.run(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0] + [len(t) for t in texts]))
    assert not encoder.by_word and ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]
    assert len(sizes) == 3 and sizes[1] == 0


def test_files_give_back_every_id(spark, tmp_path):
    ids = [7, None, 3, 3, None, *range(100, 100 + len(TEXTS))]
    texts = ["seven", "no id", "three", "three", "no id either", *TEXTS]
    df = spark.createDataFrame(list(zip(texts, ids, ["x"] * len(ids))), "text string, doc_id long, part string").repartition(3)
    path = str(tmp_path / "ids")
    token_output.write_tokens(df, path, WORDS, end_id=1)
    rows = sorted(token_output.read_tokens(spark, path).collect(), key=lambda r: r.start)
    key = lambda pair: (pair[0] is not None, pair[0] or 0)
    assert [r.doc_id for r in rows] == [i for i, _ in sorted(zip(ids, texts), key=key)]
    got = sorted(((r.doc_id or -1, r.ids) for r in rows))
    assert got == sorted((i or -1, one) for i, one in zip(ids, plain(texts)))
    upto = 0
    for r in rows:
        assert r.start == upto and r.n_tokens == len(r.ids)
        upto += r.n_tokens
    digest = {r.start: (r.doc_id, r.n_tokens, r.ids_crc32) for r in token_output.token_digests(spark, path).collect()}
    assert digest == {r.start: (r.doc_id, r.n_tokens, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in rows}


def test_no_documents(spark, tmp_path):
    token_output.write_tokens(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"), WORDS, end_id=1)
    assert token_output.read_tokens(spark, str(tmp_path / "none")).count() == 0


@needs_data
def test_query_equals_plain_tokenization(spark):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op11_token_output(spark, SF).collect()}
    upto, want = 0, {}
    for r, ids in zip(docs, plain([r.text for r in docs])):
        want[r.doc_id] = (upto, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        upto += len(ids)
    assert got == want


def test_pieces_meet_without_case_space_and_marks():
    encoder = token_output.Encoder(open(WORDS, encoding="utf-8").read())
    text = "Pfau*** und&&& PFAU###\n\tUnd\"pfau\" | pfau ÀÉ àé=é"
    data = np.frombuffer(text.encode(), np.uint8)
    ids, _ = encoder.run(data, np.array([0, len(data)]))
    assert ids.tolist() == plain([text])[0][:-1]
    assert sorted(encoder.known.to_pylist()) == sorted(["pfau", "***", "und", "&&&", "###", '"', "|", "àé", "=", "é"])


def test_workers_keep_their_pieces():
    model = open(WORDS, encoding="utf-8").read()
    assert token_output._encoder(model) is token_output._encoder("".join(list(model)))


def test_cuts_at_marks_change_no_id():
    texts = ["=\u0338 a=\u0338b", "H\u0331h\u0331 A\u0301 I\u0307", "a<|endoftext|>b &<|ENDOFTEXT|>A", "(It's) it'S 'S .'s a'.s",
             "x|y <| |> Ab|Cd", "Á+Þ/ß~×*÷", "x\x1f \x1fY\x00Z\u00a0Q", "ͅ K ſ ²ª 日A本", "1.5a.b2", ""]
    encoder = token_output.Encoder(open(WORDS, encoding="utf-8").read())
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    ids, sizes = encoder.run(np.frombuffer("".join(texts).encode(), np.uint8), offsets)
    assert [x.tolist() + [1] for x in np.split(ids, np.cumsum(sizes)[:-1])] == plain(texts)


def test_forgotten_pieces_are_encoded_again(monkeypatch):
    monkeypatch.setattr(token_output, "_CACHE_WORDS", 5)
    encoder = token_output.Encoder(open(WORDS, encoding="utf-8").read())
    for text in ["one two three", "two four* five", "six seven one", "two six", "eight nine ten two", "one two seven ***"]:
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = encoder.run(data, np.array([0, len(data)]))
        assert ids.tolist() == plain([text])[0][:-1]
    assert len(encoder.known) < 13 and "two" in encoder.known.to_pylist()


def test_crc32_of_pieces():
    data = bytes(range(256)) * 600
    for cuts in ([0, 153_600], [0, 0, 5, 9, 32_768, 150_000, 153_600], [0, 100_000, 153_600]):
        pieces = [(zlib.crc32(data[a:b]), b - a) for a, b in zip(cuts, cuts[1:])]
        assert token_output.crc32_joined(pieces) == zlib.crc32(data)


def test_code_of_blocks_is_fixed():
    i = np.arange(20_000, dtype=np.int64)
    ids = (i * i * 7919 >> 9) % 700 + (i % 9 == 0) * 40_000
    blocks = [ids[:8192], ids[8192:16384], ids[16384:], ids[:5]]
    coded = token_codec.encode(blocks)
    assert zlib.crc32(b"".join(coded)) == 908683255
    assert all(np.array_equal(a, b) for a, b in zip(token_codec.decode(coded), blocks))
    assert token_codec.encode([]) == [] and token_codec.decode([]) == []
