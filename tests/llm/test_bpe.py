"""BPE coding against the tokenizers library."""

import hashlib
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fieldloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "\r\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", " ", "​", "a", "the", "The", "'s", "'S",
         "'ll", "1", "22", "½", "٣", "é", "漢", "字", "ا", "!", "?", "...", "<|endoftext|>", "<|endof", "😀", "👩‍👩‍👧",
         "́", "\x00", "\x0b", "﻿", "𝔘", "ⅷ", "aaaa", "_", "-"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def mixed(n, seed=7):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_ids_equal_the_library(library):
    texts = mixed(4000) + ["", "a" * 3000, "ab" * 2000, "aaab" * 700, " " * 500, "=" * 801]
    got = [x.tolist() for x in bpe.Encoder(bpe.Vocabulary(PATH)).encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_narrow_texts_are_cut_alike(library):
    """Texts of code points below 256 take another engine: same words, same ids."""
    rnd = random.Random(12)
    texts = ["".join(chr(rnd.choice((rnd.randrange(256), rnd.randrange(32, 127), 32, 39))) for _ in range(rnd.randint(1, 60)))
             for _ in range(4000)] + ["it's we'll I'D 'tis x'", " '", "\xa0\xa0a", "\x85 \x1c\x1d b", "½²a1"]
    encoder = bpe.Encoder(bpe.Vocabulary(PATH))
    assert all(encoder.narrow.findall(t) == encoder.words.findall(t) for t in texts)
    assert [x.tolist() for x in encoder.encode(texts)] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_small_memory_and_batches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    monkeypatch.setattr(bpe, "BATCH_WORDS", 30)
    texts = mixed(500, 8)
    got = [x.tolist() for x in bpe.Encoder(bpe.Vocabulary(PATH)).encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_columns(spark, documents, library):
    texts = mixed(60, 9) + [None, "", "x " * 400_000, "same", "same"]
    docs = documents(texts).selectExpr("*", "7 AS ids", "'q' AS decoded", "1 AS lists")
    coded = bpe.encoded(docs, PATH)
    assert sorted(coded.columns) == sorted(docs.columns) and "lists" in coded.columns
    rows = bpe.token_digest(bpe.decoded(coded, PATH)).collect()
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert tuple(r)[1:] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                hashlib.sha256(text.encode()).hexdigest())
    assert len(rows) == len(texts)
    assert bpe.decoded(bpe.encoded(documents([]), PATH), PATH).count() == 0


def test_broken_bytes_decode_like_the_library(spark, library):
    ids = [library.encode("漢😀", add_special_tokens=False).ids[:-1], [50256, 0, 255], []]
    got = bpe.decoded(spark.createDataFrame([(x,) for x in ids] + [(None,)], "ids array<int>"), PATH).collect()
    assert [r.decoded for r in got] == [library.decode(x, skip_special_tokens=False) for x in ids] + [""]


def test_other_kinds_of_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    spec = json.load(open(PATH))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.Vocabulary(str(tmp_path / "t.json"))
