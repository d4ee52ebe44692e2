import random
import re
from collections import Counter, defaultdict

from coldshelf.llm.lines import line_frequency
from coldshelf.llm.queries import QUERIES
from llm.cases import ODD, docs

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_counts(spark):
    rows = ODD + [
        (10, "a b c a b c a b\n" * 9), (11, "x # y | <z>\nx # y | <z>\n \n"), (12, "a a a"), (13, "a a a a"),
        (14, "p q r s p q r"), (15, "tab\x0bsplit\x0cfeed\rret wide\u0085next"), (16, "u v w x y z"),
    ]
    for row in line_frequency(docs(spark, rows, extra=True)).collect():
        text = next(t for i, t in rows if i == row.doc_id)
        expected = brute(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == expected
        assert row.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])


def body(seed, words=60):
    # digits are made equal, so words differ by letters
    letters = str.maketrans("0123456789", "klmnopqrst")
    return " ".join(f"w{seed}x{i}".translate(letters) for i in range(words))


def test_common_lines_deplete(spark):
    common = body("boiler", 55)
    rows = [(i, common + "\n" + body(i, 2), "a") for i in range(30)]  # little of their own
    rows += [(100 + i, body(i) + "\n" + common.upper(), "a") for i in range(5)]  # enough of their own
    rows += [(200 + i, common, "b") for i in range(5)]  # not common on this host
    rows += [(300, common, None), (0, rows[0][1], "a")]
    found = {r.doc_id: r for r in line_frequency(docs(spark, rows), max_documents=20).collect()}
    assert not any(found[i].kept for i in range(30))
    assert all(found[100 + i].kept and found[100 + i].n_common_words == 55 for i in range(5))
    assert all(found[200 + i].kept and found[200 + i].n_common_words == 0 for i in range(5))
    assert found[300].kept


def test_repeated_rows_count_once(spark):
    rows = [(1, body(1), "a")] * 40
    assert all(r.kept for r in line_frequency(docs(spark, rows), max_documents=20).collect())


def verdicts(rows, max_documents=100, max_share=0.02, min_documents=10, least_left=0.3):
    """Which rows are kept, line by line and document by document."""
    holders, hosts = defaultdict(set), defaultdict(set)
    digits = str.maketrans("0123456789", "0" * 10)

    def lines_of(text):
        return [tuple(w.lower().translate(digits) for w in WORD.findall(x)) for x in (text or "").split("\n") if WORD.search(x)]

    for doc, text, host in rows:
        hosts[host].add(doc)
        for line in lines_of(text):
            holders[host, line].add(doc)
    kept = []
    for doc, text, host in rows:
        n_words, *_, n_repeat = brute(text)
        common = 0
        for line in lines_of(text):
            n = len(holders[host, line])
            if n > max_documents or n > min_documents and n > max_share * len(hosts[host]):
                common += len(line)
        ok = n_words >= 50 and 100 * n_repeat <= 50 * n_words
        kept.append((doc, ok and n_words - common >= least_left * n_words, common))
    return sorted(kept, key=str)


def test_verdicts_by_brute_force_in_hosts_of_all_sizes(spark):
    r = random.Random(4)
    pool = [body(f"p{i}", 9) for i in range(40)]
    rows = []
    for host, size in (("small", 30), ("middle", 300), (None, 60), ("large", 900)):
        for i in range(size):
            shared = [pool[min(int(r.expovariate(0.15)), 39)] for _ in range(r.randrange(9))]
            own = [body(f"{host}{i}x{j}", 9) for j in range(r.randrange(8))]
            rows.append((len(rows), "\n".join(r.sample(shared + own, len(shared + own))), host))
    rows += rows[:40] + [(None, pool[0] + "\n" + body("n", 60), "middle")] * 3
    for options in ({}, {"max_documents": 40, "max_share": 0.1}, {"max_share": 0.5, "min_documents": 3}):
        found = line_frequency(docs(spark, rows), **options).select("doc_id", "kept", "n_common_words").collect()
        expected = verdicts(rows, **options)
        assert sorted(map(tuple, found), key=str) == expected
        assert any(common and not ok for _, ok, common in expected)


def test_the_query_rejects_depleted_documents(spark):
    """On a whole table, at the production limits."""
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = QUERIES["op7_line_frequency"](spark, sf).select("doc_id", "kept", "n_common_words").collect()
    assert sorted(map(tuple, found), key=str) == verdicts(rows)


def test_empty_table(spark):
    assert line_frequency(docs(spark, [])).collect() == []
