import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from coldshelf.llm.pieces import SPACE, encode_texts, vocabulary
from llm.cases import ODD, docs

MODEL = public_tokenizers.path("piece_bpe_32k.model")
OUTPUTS = ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_same_as_library(spark, library):
    r = random.Random(5)
    parts = [SPACE, " ", "  ", "a", "the", "é", "日", "\x01", "\t", "\n", "𝕏", "<s>", "<0x0A>", "ing", "thlyeror", "ß"]
    rows = [(1000 + i, "".join(r.choice(parts) for _ in range(r.randrange(80)))) for i in range(400)] + ODD
    for row in encode_texts(docs(spark, rows, extra=True), MODEL, outputs=OUTPUTS).collect():
        text = next(t for i, t in rows if i == row.doc_id) or ""
        ids = library.encode(text)
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.decoded == library.decode(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(row.decoded.encode()).hexdigest()


def test_heap_and_rounds_agree(library):
    own = vocabulary(MODEL)
    words = [SPACE + w for w in ("anthropology", "x", "日本語テキスト", "a" * 64, "ththth" * 9, "\U0001d54f")]
    for word, ids in zip(words, own.merge_many(words), strict=True):
        assert own.merge(word) == ids == library.encode(word[1:])
    long = "unbroken" * 3000
    assert own.merge(SPACE + long) == library.encode(long)


def test_decodes_any_ids(library):
    own, r = vocabulary(MODEL), random.Random(6)
    for _ in range(1500):
        ids = [r.randrange(0, 32000) if r.random() < 0.5 else r.randrange(3, 259) for _ in range(r.randrange(15))]
        assert own.decode(ids) == library.decode(ids)


def test_empty_table(spark):
    assert encode_texts(docs(spark, []), MODEL, outputs=OUTPUTS).count() == 0


def test_check_finds_a_difference():
    own = vocabulary.__wrapped__(MODEL)
    own.pair_ids = own.pair_ids.copy()
    own.pair_ids[:] = own.ids["the"]
    with pytest.raises(ValueError, match="library"):
        own.encode(["there and then"], check=True)
