import hashlib
import random

import public_tokenizers
import sentencepiece

import __spark_entry__ as registry
import corpus_pipeline as c
from coldshelf.llm.pseudonyms import pseudonymize
from coldshelf.llm.queries import PSEUDONYM_KEY, QUERIES
from llm.cases import ODD, docs
from llm.test_simhash import brute_groups, brute_print

BAD = ["vilex", "grotty", "scumbo", "nastor", "wretcho"]


def tables(spark, folder):
    r = random.Random(8)
    prose = lambda n: [f"w{r.randrange(500)}" for _ in range(n)]
    rows = [(i, " ".join(prose(r.randrange(30, 120)))) for i in range(500)]
    toxic = {}
    for i in range(0, 500, 6):
        words = rows[i][1].split() + r.choices(BAD, k=4)
        r.shuffle(words)
        rows[i] = (i, " ".join(words))
        toxic[i] = 1
    item = " ".join(prose(30))
    rows += [(600 + k, rows[1 + k][1].upper()) for k in range(4)]  # equal but for case
    rows += [(610, " ".join(prose(20)) + " " + item), (611, "mail bosbt.42@mail8.example.com to " + " ".join(prose(30)))]
    rows += [(700 + (i or 0), t) for i, t in ODD if i not in (None, 5)] + [(None, "no id " + " ".join(prose(9)))]
    docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
    marks = [(i, 1, toxic.get(i, 0)) for i in range(0, 500, 2)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, toxic


def test_whole_run(spark, folder):
    rows, toxic = tables(spark, folder)
    found = {x.doc_id: x for x in c.run(spark, folder).collect()}
    kept = [(i, t) for i, t in rows if i not in toxic]
    groups = brute_groups({i: brute_print(t) for i, t in kept if i is not None})
    kept = [(i, t) for i, t in kept if i is None or groups[i] == i]
    kept = [(i, t) for i, t in kept if i != 610]
    assert set(found) == {i for i, _ in kept}
    assert 600 not in found and 611 in found
    replaced = {x.doc_id: x.text for x in pseudonymize(docs(spark, kept), key=PSEUDONYM_KEY).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, x in found.items():
        ids = library.encode(replaced[i] or "")
        assert x.n_tokens == len(ids)
        assert x.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_stages_keep_the_columns(spark, folder):
    rows, _ = tables(spark, folder)
    frame = docs(spark, rows)
    for _, stage in c.STAGES[:-1]:
        assert stage(spark, frame, folder).columns == frame.columns
    empty = frame.limit(0)
    for _, stage in c.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_personal_data_is_replaced_and_measured(spark, folder):
    text = "mail bosbt.42@mail8.example.com and 2.3.4.55 é"
    row = c.replace_personal(spark, docs(spark, [(1, text), (2, None)]), folder).orderBy("doc_id").collect()
    assert "bosbt" not in row[0].text and row[0].n_chars == len(row[0].text)
    assert row[1].text is None and row[1].n_chars is None


def test_everything_is_registered():
    names = registry.queries()
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
