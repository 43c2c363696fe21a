import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import bpe
from tests.llm.data import awkward, frame, with_clash

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    with open(PATH, encoding="utf-8") as f:
        return bpe.ByteBpe(f.read()), Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", [
    "", "it's they'll I'VE 'd ''s", "  a  \n\n b\t", "<|endoftext|> a<|endoftext|><|endoftext|>b", "aaaa" * 500, "\U0001f600é漢字 ١٢ ²½",
    "\x1c\x1d a\x85b 　c", "x" * 100 + " " * 100 + "\n"])
def test_same_as_library(both, text):
    own, lib = both
    ids = lib.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False) == text


def test_every_plane(both):
    own, lib = both
    for start in range(0, 0x110000, 0x800):
        text = " ".join(f"a{chr(c)}1{chr(c)}{chr(c)}" for c in range(start, start + 0x800, 5) if not 0xD800 <= c < 0xE000)
        assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids


def test_blocks_do_not_change_the_result(both, monkeypatch):
    own, lib = both
    text = "one two  three\n\nfour " * 50
    monkeypatch.setattr(bpe, "BLOCK", 7)
    assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids
    assert own.digest(text)[0] == len(own.encode(text))


def test_cache_bound(both, monkeypatch):
    own, _ = both
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 10)
    own.clear()
    own.encode(" ".join(f"w{i}" for i in range(100)))
    assert len(own) <= 10


def test_query(spark, both):
    _, lib = both
    rows = awkward()
    got = bpe.round_trip(with_clash(frame(spark, rows), "_d", "n_tokens"), PATH).collect()

    def want(doc_id, text):
        ids = lib.encode(text or "", add_special_tokens=False).ids
        return (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest())
    key = str
    assert sorted(map(tuple, got), key=key) == sorted((want(r[0], r[1]) for r in rows), key=key)
    assert bpe.round_trip(frame(spark, []), PATH).count() == 0


def test_columns(spark, both):
    own, _ = both
    df = bpe.with_encoding(with_clash(frame(spark, awkward(5)), "token_ids"), PATH)
    assert df.columns[-1] == "token_ids_1"
    spec = bpe.vocabulary(spark, PATH)
    back = df.select("text", bpe.decode_column(spec, df["token_ids_1"]).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in back)
