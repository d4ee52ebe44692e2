import datetime as dt
import hashlib
import re

import pytest

from coldshelf.llm.pseudonyms import KINDS, ROUNDS, pseudonymize
from llm.cases import LONG, ODD, docs

KEY = "k"


def draw(kind, a, b, turn, half, below):
    text = f"{KEY}|{kind}|{a}|{b}|{turn}|{half}"
    return int(hashlib.sha256(text.encode()).hexdigest()[:15], 16) % below


def feistel(kind, pair, a, b):
    left, right = pair
    for turn in range(ROUNDS):
        if turn % 2 == 0:
            left = (left + draw(kind, a, b, turn, right, a)) % a
        else:
            right = (right + draw(kind, a, b, turn, left, b)) % b
    return left, right


def run_of(kind, digits):
    first = (len(digits) + 1) // 2
    a, b = 10**first, 10 ** (len(digits) - first)
    left, right = feistel(kind, (int(digits[:first]), int(digits[first:] or 0)), a, b)
    return f"{left:0{first}d}" + (f"{right:0{len(digits) - first}d}" if len(digits) > first else "")


def luhn(digits):
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits + "0")))
    return digits + str(-total % 10)


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def replaced(spark, texts):
    frame = docs(spark, list(enumerate(texts)), extra=True)
    rows = pseudonymize(frame, key=KEY).collect()
    assert all(r.id == "x" for r in rows)
    return {r.doc_id: r for r in rows}


def one(spark, texts, kind):
    out = replaced(spark, texts)
    assert all(out[i][f"n_{kind}"] == 1 for i in out)
    return [out[i].text for i in range(len(texts))]


def test_cards(spark):
    numbers = [luhn(p) for p in ("404189497460879", "411111111111111", "37828224631000", "601100099013942400")]
    for number, new in zip(numbers, one(spark, numbers, "card"), strict=True):
        assert new == luhn(number[0] + run_of("card", number[1:-1]))
    grouped = one(spark, ["4111 1111 1111 1111", "4111-1111-1111-1111"], "card")
    assert grouped[0].replace(" ", "") == grouped[1].replace("-", "") and re.fullmatch(r"\d{4}( \d{4}){3}", grouped[0])


def test_dates(spark):
    def expected(day):
        number = (day - dt.date(1900, 1, 1)).days
        window, place = divmod(number, 73_000)
        left, right = feistel("date", divmod(place, 292), 250, 292)
        return dt.date(1900, 1, 1) + dt.timedelta(window * 73_000 + left * 292 + right)

    days = [dt.date(2020, 2, 29), dt.date(1900, 1, 1), dt.date(2099, 11, 12), dt.date(2099, 11, 13), dt.date(1750, 6, 5)]
    assert one(spark, [d.isoformat() for d in days], "date") == [expected(d).isoformat() for d in days]
    assert one(spark, [d.strftime("%d.%m.%Y") for d in days], "date") == [expected(d).strftime("%d.%m.%Y") for d in days]


def test_phones_and_social_numbers(spark):
    def phone(ten):
        area, exchange, line = int(ten[:3]) - 200, int(ten[3:6]) - 200, int(ten[6:])
        left, right = feistel("phone", (area * 100 + exchange // 8, exchange % 8 * 10_000 + line), 80_000, 80_000)
        return f"{left // 100 + 200}{left % 100 * 8 + right // 10_000 + 200}{right % 10_000:04d}"

    tens = ["9885552485", "2002000000", "9999999999", "4562234567"]
    assert one(spark, [f"+1 ({t[:3]}) {t[3:6]}-{t[6:]}" for t in tens], "phone") == [
        f"+1 ({p[:3]}) {p[3:6]}-{p[6:]}" for p in map(phone, tens)
    ]

    def social(area, group, serial):
        left, right = feistel("ssn", ((area - (2 if area > 666 else 1)) * 99 + group - 1, serial - 1), 898 * 99, 9_999)
        area = left // 99 + 1
        return f"{area + (area >= 666):03d}-{left % 99 + 1:02d}-{right + 1:04d}"

    numbers = [(1, 1, 1), (665, 99, 9999), (667, 1, 2), (899, 99, 9999), (123, 45, 6789)]
    assert one(spark, [f"{a:03d}-{g:02d}-{s:04d}" for a, g, s in numbers], "ssn") == [social(*n) for n in numbers]


def test_accounts_addresses_and_others(spark):
    plain = ["DE89370400440532013000", "GB82WEST12345698765432"]
    for old, new in zip(plain, one(spark, plain, "iban"), strict=True):
        letters = re.sub(r"\d", "", old[4:])
        bban = letters + run_of("iban", re.sub(r"\D", "", old[4:]))
        assert new[:2] == old[:2] and new[4:] == bban and mod97(new[4:] + new[:4]) == 1
    ips = ["70.123.182.155", "0.0.0.0", "255.255.255.255"]
    for old, new in zip(ips, one(spark, ips, "ip"), strict=True):
        o = list(map(int, old.split(".")))
        left, right = feistel("ip", (o[0] * 256 + o[1], o[2] * 256 + o[3]), 65_536, 65_536)
        assert new == f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"
    assert one(spark, ["+442079460958"], "intl") == ["+44" + run_of("intl", "2079460958")]

    def name(part):
        first = (len(part) + 1) // 2
        a, b = 36**first, 36 ** (len(part) - first)
        pair = feistel("email", (int(part[:first], 36), int(part[first:] or "0", 36)), a, b)
        digits = "0123456789abcdefghijklmnopqrstuvwxyz"

        def spell(n, width):
            out = ""
            for _ in range(width):
                n, rest = divmod(n, 36)
                out = digits[rest] + out
            return out

        return spell(pair[0], first) + spell(pair[1], len(part) - first)

    mails = ["bosbt.42@mail8.example.com", "Averyveryverylongname_x@a-b.org"]
    expected = [f"{name('bosbt')}.{name('42')}@mail8.example.com", f"{name('averyveryv')}{name('erylongnam')}{name('e')}_{name('x')}@a-b.org"]
    assert one(spark, mails, "email") == expected


def test_values_beside_other_numbers(spark):
    card = one(spark, ["4111 1111 1111 1111"], "card")[0]
    iban = one(spark, ["DE89370400440532013000"], "iban")[0]
    spaced = " ".join(iban[i : i + 4] for i in range(0, 22, 4))
    texts = ["4111 1111 1111 1111 05/26", "4111 1111 1111 1111 123", "12 4111 1111 1111 1111", "4111 1111 1111 1111 7 (x)"]
    expected = [t.replace("4111 1111 1111 1111", card) for t in texts]
    assert one(spark, texts, "card") == expected
    assert one(spark, ["DE89 3704 0044 0532 0130 00 12"], "iban") == [f"{spaced} 12"]


def test_accounts_with_letters_inside(spark):
    plain = ["FR1420041010050500013M02606", "IT60X0542811101000000123456", "MT84MALT011000012345MTLCAST001S", "SM86U0322509800000000270100"]
    for old, new in zip(plain, one(spark, plain, "iban"), strict=True):
        assert new != old and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", old) and mod97(new[4:] + new[:4]) == 1


def test_dates_with_times_and_months_first(spark):
    day = one(spark, ["2024-01-15"], "date")[0]
    assert one(spark, ["2024-01-15T10:00", "at 2024-01-15T10:00:00Z"], "date") == [f"{day}T10:00", f"at {day}T10:00:00Z"]
    days = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(366)]
    days = [d for d in days if d.day > 12]
    new = [dt.datetime.strptime(t, "%m/%d/%Y").date() for t in one(spark, [d.strftime("%m/%d/%Y") for d in days], "date")]
    assert len(set(new)) == len(days) and all(d.day > 12 for d in new) and new != days


@pytest.mark.parametrize(
    "text",
    ["4111 1111 1111 1112", "000-12-3456", "666-12-3456", "900-12-3456", "123-00-4567", "2021-02-29", "31.04.2020", "300.1.1.1",
     "DE88370400440532013000", "version 1.2.3.4.5", "0999-01-01", "x@y", "call 123-456", "a4111111111111111", "12345"],
)
def test_invalid_values_stay(spark, text):
    row = replaced(spark, [text])[0]
    assert row.text == text and all(row[f"n_{k}"] == 0 for k in KINDS)


def test_values_stay_linked_and_differ(spark):
    mails = [f"user{i}@x.org" for i in range(300)]
    texts = mails + [f"see {m}, {m}." for m in mails[:50]]
    out = replaced(spark, texts)
    assert len({out[i].text for i in range(300)}) == 300
    for i in range(50):
        assert out[300 + i].text == f"see {out[i].text}, {out[i].text}."
    cards = [luhn(f"4{i:014d}") for i in range(300)]
    assert len(set(one(spark, cards, "card"))) == 300


def test_odd_rows_and_whole_texts(spark):
    far = LONG + "bosbt.42@mail8.example.com" + LONG
    rows = [t for _, t in ODD] + [far]
    out = replaced(spark, rows)
    for i, text in enumerate(rows[:-1]):
        assert out[i].text == text
    assert out[len(rows) - 1].n_email == 1 and "bosbt" not in out[len(rows) - 1].text
    assert len(out[len(rows) - 1].text) == len(far)
    assert pseudonymize(docs(spark, []), key=KEY).collect() == []


def test_stays_in_the_jvm(spark, capsys):
    pseudonymize(docs(spark, [(1, "a")]), key=KEY).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize(
    "text",
    [
        "x@a" + ".a1" * 50_000 + ".com", "x@" + "a-" * 50_000 + "a.com", "x" * 100_000 + "@a.com", "x@a" + "." * 100_000,
        "1" * 100_000, "1-" * 50_000, "1 2 " * 25_000, "." * 100_000, "1." * 50_000, "+1 (" * 25_000, "DE44 " * 20_000,
        "2020-01-01" * 10_000, "a@b." * 25_000, "﷐" * 50_000,
    ],
)
def test_no_text_is_too_long_or_too_odd(spark, text):
    out = replaced(spark, [text + " mail joe@example.org now"])[0]
    assert out.n_email >= 1 and "joe@example.org" not in out.text and out.text.endswith("@example.org now")


def test_addresses_of_every_form(spark):
    found = ["a@b.co", "a.b+c@d-e.f.museum", "x@a.com-", "x@a.com.", "x@a.com.-", "x@a.b-.com", "X@A1.B2.ORG"]
    none = ["a@b", "a@b.c", "a@b.com.x1", "a@b.co-m", "a@.com", "a@b..com", "@b.com"]
    out = replaced(spark, found + none)
    assert [out[i].n_email for i in out] == [1] * len(found) + [0] * len(none)
    for i, text in enumerate(found):
        assert out[i].text.split("@")[1] == text.split("@")[1]
    for i, text in enumerate(none, len(found)):
        assert out[i].text == text


def test_columns_that_have_the_names_of_steps(spark):
    frame = spark.createDataFrame([(1, "mail joe@example.org", "f", "n", "M", "m", 7)], "doc_id int, text string, __found__ string, __new__ string, __MARK__ string, __marked__ string, n_card int")
    row = pseudonymize(frame, key=KEY).first()
    assert (row["__found__"], row["__new__"], row["__MARK__"], row["__marked__"]) == ("f", "n", "M", "m")
    assert row.n_email == 1 and row.n_card == 0


def test_texts_that_hold_the_marks(spark):
    card = luhn("411111111111111")
    marks = "﷐﷐ " + "".join(chr(c) for c in range(0xFDD0, 0xFDF0))
    row = replaced(spark, [f"{marks}{card} 05/26 123﷐ 4 {card}"])[0]
    assert row.n_card == 2 and card not in row.text and row.text.startswith(marks) and row.text.count("﷐") == 4
