import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from coldshelf.llm import crosswise
from coldshelf.llm.crosswise import ByteLevel, align_tokenizers
from coldshelf.llm.queries import QUERIES
from llm.cases import ODD, docs

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=B)


def spelt_a(token):
    """A byte-level entry as bytes, by the public rule for unseen bytes."""
    seen = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    of, extra = {}, 0
    for b in range(256):
        if b in seen:
            of[chr(b)] = b
        else:
            of[chr(256 + extra)] = b
            extra += 1
    return bytes(of[c] for c in token)


def expected(rows, libraries):
    """Token by token, document by document."""
    tokenizer, pieces = libraries
    documents, counts = [], Counter()
    for doc_id, text, *_ in rows:
        a = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids
        b = pieces.encode(text or "")
        bytes_a = [spelt_a(tokenizer.id_to_token(i)) for i in a]
        names = [pieces.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names)]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            documents.append((doc_id, [], [], [], []))
            continue
        ends_a, ends_b, end = {}, {}, 0
        for i, t in enumerate(bytes_a):
            end += len(t)
            ends_a[end] = i
        end = 0
        for i, t in enumerate(bytes_b):
            end += len(t)
            ends_b[end] = i
        groups, links, at_a, at_b = [], [], 0, 0
        for cut in sorted(ends_a.keys() & ends_b.keys()):
            i, j = ends_a[cut], ends_b[cut]
            groups.append(",".join(map(str, a[at_a : i + 1])) + "|" + ",".join(map(str, b[at_b : j + 1])))
            links.append((a[i], b[j]))
            at_a, at_b = i + 1, j + 1
        counts.update(links)
        documents.append((doc_id, a, b, groups, links))
    top = defaultdict(int)
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    return sorted(
        (
            (
                doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == top[x[1]] for x in links),
                sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
            )
            for doc_id, a, b, groups, links in documents
        ),
        key=str,
    )


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


PARTS = [
    " ", "  ", "the", " and", "é", "日本", "🙂", "\t", "\n\n", "1984", "'s", "<|endoftext|>", "<s>", "▁", "ß", "\x85",
    "​", "\xa0", "\x1c", "ǅ", "²", "Ⅷ", "𝕏", "ำ", "ing", "...", "\x00", "　", "०",
]


def test_against_single_documents(spark, libraries):
    r = random.Random(8)
    rows = [(100 + i, "".join(r.choice(PARTS) for _ in range(r.randrange(40)))) for i in range(300)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(200)] + ODD
    assert found(align_tokenizers(docs(spark, rows, extra=True).repartition(3), A, public_tokenizers.PATTERN, B)) == expected(
        rows, libraries
    )


def test_more_pairs_than_are_broadcast(spark, libraries, monkeypatch):
    monkeypatch.setattr("coldshelf.llm.hot.HOT_GROUPS", 4)
    r = random.Random(9)
    words = "the of and to in is that for it with as was on be by this are from".split()
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(30)))) for i in range(200)]
    rows += [(500 + i, "the hot one") for i in range(150)] + [(900, None), (901, "")]
    result = align_tokenizers(docs(spark, rows), A, public_tokenizers.PATTERN, B, broadcast_pairs=0)
    assert found(result) == expected(rows, libraries)


def test_empty_table(spark):
    for pairs in (0, 100):
        assert found(align_tokenizers(docs(spark, []), A, public_tokenizers.PATTERN, B, broadcast_pairs=pairs)) == []


def test_the_query(spark, libraries):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(QUERIES["op11_cross_tokenizer"](spark, sf)) == expected(rows, libraries)


def test_every_character_is_encoded_as_by_the_own_library(libraries):
    own = ByteLevel(A, public_tokenizers.PATTERN)
    texts = [f" x{chr(c)}y {chr(c)}{chr(c)} 1{chr(c)}" for c in range(0, 0x3000) if not 0xD800 <= c < 0xE000]
    assert own.encode(texts) == [e.ids for e in libraries[0].encode_batch_fast(texts, add_special_tokens=False)]


def test_long_runs_and_characters_that_differ_go_to_the_own_library(libraries, monkeypatch):
    monkeypatch.setattr(crosswise, "_LONG_RUN", 50)
    own = ByteLevel(A, public_tokenizers.PATTERN)
    assert own.fast is not None
    own.tried.add("q")
    own.differ.add("q")
    assert own._plain(["a" * 49 + " b", "a" * 60, "  " * 40, "a q", "a b " * 40]) == [True, False, False, False, True]
    assert own.encode(["a" * 60 + " q"]) == [libraries[0].encode("a" * 60 + " q").ids]
