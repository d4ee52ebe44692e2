import random

import public_tokenizers
import pytest

from coldshelf.llm.attribution import RULES, Tokenizer, count_field_tokens, count_section_tokens
from llm.cases import ODD, docs

MODEL = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tokens():
    return Tokenizer(*MODEL)


def brute(tokens, owners, text, rule):
    """Tokens of each owner, from the owner of every byte."""
    counts, at = [0.0] * (max(owners, default=0) + 1), 0
    for token in tokens.encoding.encode_ordinary(text):
        own = owners[at : at + int(tokens.lengths[token])]
        at += len(own)
        if rule == "first":
            counts[own[0]] += 1
        elif rule == "majority":
            counts[min(set(own), key=lambda o: (-own.count(o), o))] += 1
        else:
            for o in own:
                counts[o] += 1 / len(own)
    assert at == len(text.encode())
    return counts


def line_owners(text):
    owners, line = [], 0
    for byte in text.encode():
        owners.append(line)
        line += byte == 10
    return owners


@pytest.mark.parametrize("rule", RULES)
def test_lines(spark, tokens, rule):
    r = random.Random(3)
    parts = ["\n", "\n\n", " ", "é", "ab", "the", " of", "日本", "\n \n", ".", "🙂"]
    rows = [(100 + i, "".join(r.choice(parts) for _ in range(r.randrange(60)))) for i in range(150)]
    rows += [(i, t) for i, t in ODD if i not in (5, None)] + [(9, "\n"), (10, "a\n\n\n"), (11, "x\n\n\n\n\ny" * 20)]
    found = {}
    for row in count_section_tokens(docs(spark, rows, extra=True), *MODEL, rule=rule).collect():
        found.setdefault(row.doc_id, []).append(row)
    for doc_id, text in rows:
        own, text = sorted(found[doc_id], key=lambda x: x.section), text or ""
        expected = brute(tokens, line_owners(text), text, rule)
        assert [x.n_tokens for x in own] == pytest.approx(expected)
        assert "".join(text[x.start_char : x.end_char] for x in own) == text
        assert sum(x.n_tokens for x in own) == pytest.approx(len(tokens.encoding.encode_ordinary(text)))
    assert any(x.n_crossing for own in found.values() for x in own)


def test_fields(spark, tokens):
    rows = [(1, "src", "en", "hello world"), (2, None, "", "x"), (3, "a b", "\n", "\n\nz"), (4, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, a string, b string, text string")
    found = {}
    for row in count_field_tokens(frame, *MODEL, ["a", "b", "text"]).collect():
        found.setdefault(row.doc_id, []).append(row)
    for doc_id, *fields in rows:
        parts = [(f or "") + ("\n" if i < 2 else "") for i, f in enumerate(fields)]
        owners = [i for i, p in enumerate(parts) for _ in p.encode()]
        expected = (brute(tokens, owners, "".join(parts), "majority") + [0.0] * 3)[:3]
        assert [x.n_tokens for x in sorted(found[doc_id], key=lambda x: x.section)] == expected


def test_separator_of_several_characters(spark):
    found = count_section_tokens(docs(spark, [(1, "a--b----c"), (2, "-"), (3, "--")]), *MODEL, separator="--").collect()
    spans = {}
    for x in sorted(found, key=lambda x: x.section):
        spans.setdefault(x.doc_id, []).append((x.start_char, x.end_char))
    assert spans == {1: [(0, 3), (3, 6), (6, 8), (8, 9)], 2: [(0, 1)], 3: [(0, 2)]}


def test_empty_table_repeats_and_wrong_rule(spark):
    assert count_section_tokens(docs(spark, []), *MODEL).collect() == []
    assert count_section_tokens(docs(spark, [(1, "a\nb")] * 3), *MODEL).count() == 6
    with pytest.raises(ValueError, match="rule"):
        count_section_tokens(docs(spark, []), *MODEL, rule="last")
