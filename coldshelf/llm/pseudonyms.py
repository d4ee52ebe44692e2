"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Candidates are found by pattern and validated (check digits, calendar, number plans).  The
valid values of each format are numbered without gaps, and a keyed Feistel network permutes
those numbers: a pseudonym is a valid value of the same format, equal values get equal
pseudonyms in every text, and different values different ones.  A number is a pair
(l, r) below (a, b); each round adds a keyed hash of one half to the other, modulo its
bound, which is a permutation for any a and b.

Kinds: e-mail (its local part), IBAN, IPv4 address, calendar date, North American and other
international telephone numbers, US social security number, payment card number.  Numbers
that fail their check are left as they are, and so are leading digits that only name a
country or issuer.  A card beside other numbers is found by trying the shorter runs.  Letters
in an IBAN's account stay.  A date with the month in front stays one.  Case in e-mail names is not kept, as it makes no difference there.

Everything is a DataFrame expression over the row's own text, without shuffles or Python.

Defined results: nulls stay null, empty texts empty; repeated rows get equal results, and
ids, null ones too, are not looked at.  Long texts are searched whole.  Where two kinds fit
one candidate the first of ``KINDS`` decides.  Other columns are handed on as they are,
whatever their names, but for those that have the name of a count; an empty table stays
empty.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import count as count_from

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "iban", "ip", "date", "phone", "intl", "ssn", "card"]
ROUNDS = 8
TURNS = 64  # two dates in five have a day up to 12, so that 64 in a row don't come up

# one pattern for all candidates; what a match is, is decided by the tests below.  Groups
# that may repeat without bound are possessive: these are matched in a loop, others by a
# call each, for which a long text has too many
_EMAIL = (
    r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@"
    r"[A-Za-z0-9][A-Za-z0-9-]*+(?:\.[A-Za-z0-9-]++(?=\.[A-Za-z0-9]))*+\.[A-Za-z]{2,}+"
)
# fixed values: the public register's form of the account behind the check digits: n digits, a capitals, c either
_ACCOUNTS = {
    "AD": "8n12c", "AE": "19n", "AL": "8n16c", "AT": "16n", "AZ": "4a20c", "BA": "16n", "BE": "12n", "BG": "4a6n8c", "BH": "4a14c",
    "BR": "23n1a1c", "BY": "4c4n16c", "CH": "5n12c", "CR": "18n", "CY": "8n16c", "CZ": "20n", "DE": "18n", "DK": "14n", "DO": "4c20n",
    "EE": "16n", "EG": "25n", "ES": "20n", "FI": "14n", "FO": "14n", "FR": "10n11c2n", "GB": "4a14n", "GE": "2a16n", "GI": "4a15c",
    "GL": "14n", "GR": "7n16c", "GT": "4c20c", "HR": "17n", "HU": "24n", "IE": "4a14n", "IL": "19n", "IQ": "4a15n", "IS": "22n",
    "IT": "1a10n12c", "JO": "4a4n18c", "KW": "4a22c", "KZ": "3n13c", "LB": "4n20c", "LC": "4a24c", "LI": "5n12c", "LT": "16n",
    "LU": "3n13c", "LV": "4a13c", "LY": "21n", "MC": "10n11c2n", "MD": "20c", "ME": "18n", "MK": "3n10c2n", "MR": "23n",
    "MT": "4a5n18c", "MU": "4a19n3a", "NL": "4a10n", "NO": "11n", "PK": "4a16c", "PL": "24n", "PS": "4a21c", "PT": "21n",
    "QA": "4a21c", "RO": "4a16c", "RS": "18n", "SA": "2n18c", "SC": "4a20n3a", "SD": "14n", "SE": "20n", "SI": "15n", "SK": "20n",
    "SM": "1a10n12c", "ST": "21n", "SV": "4a20n", "TL": "19n", "TN": "20n", "TR": "6n16c", "UA": "6n19c", "VA": "18n", "VG": "4a16n",
    "XK": "16n",
}
_ALPHABETS = {"n": "[0-9]", "a": "[A-Z]", "c": "[A-Z0-9]"}


def _account(form: str) -> str:
    return "".join(f"(?: ?{_ALPHABETS[kind]}){{{n}}}" for n, kind in re.findall("([0-9]+)([nac])", form))


# by country, and for countries that aren't listed by digits alone
_IBAN = "|".join(f"{country}[0-9]{{2}}{_account(form)}" for country, form in _ACCOUNTS.items()) + (
    "|[A-Z]{2}[0-9]{2}(?: ?[A-Z]{4})?(?: ?[0-9]){10,28}"
)
_IP = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
_DATE = r"[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4}"
_PHONE = r"(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}"
_INTL = r"\+[1-9][0-9](?:[ ().-]{0,2}[0-9]){6,13}"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
_CARD = r"[0-9](?:[ -]?[0-9]){11,17}[ -]?[0-9]"
_BEFORE, _AFTER = r"(?<![A-Za-z0-9_@+.-])", r"(?![A-Za-z0-9_@]|[.-][0-9A-Za-z])"
_FORMS = {"email": _EMAIL, "iban": _IBAN, "ip": _IP, "date": _DATE, "phone": _PHONE, "intl": _INTL, "ssn": _SSN, "card": _CARD}
# a date may end before a time of day
PATTERN = f"{_BEFORE}(?:(?:{_DATE})(?=[Tt][0-9]{{2}})|(?:" + "|".join(_FORMS[k] for k in KINDS) + f"){_AFTER})"
# how cards are written
_GROUPED = "^(?:[0-9]{13,19}|" + "|".join(
    f"[0-9]{{{sizes[0]}}}" + "".join(f"{by}[0-9]{{{n}}}" for n in sizes[1:])
    for sizes in ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3))
    for by in " -"
) + ")$"
# marks where a card begins and ends among other numbers, in a run longer than any in the text
_MARK = chr(0xFDD0)

# dates are permuted within windows of this many days, counted from 1900-01-01
_WINDOW_A, _WINDOW_B = 250, 292
_WINDOW = _WINDOW_A * _WINDOW_B


def _day_zero() -> Column:
    return F.lit("1900-01-01").cast("date")


def _big(text: Column | str) -> Column:
    return F.col(text).try_cast("bigint") if isinstance(text, str) else text.try_cast("bigint")


def _pad(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _ten(power: Column) -> Column:
    return F.rpad(F.lit("1"), power + 1, "0").try_cast("bigint")


def _feistel(key: str, kind: Column, left: Column, right: Column, a: Column, b: Column) -> Column:
    """The pair (l, r) that stands for the pair ``left`` below ``a`` and ``right`` below ``b``."""

    def draw(turn: Column, half: Column, below: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), kind, a.cast("string"), b.cast("string"), turn.cast("string"), half.cast("string"))
        return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).try_cast("bigint"), below)

    def turn(pair: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(pair["l"] + draw(i, pair["r"], a), a)).otherwise(pair["l"]).alias("l"),
            F.when(even, pair["r"]).otherwise(F.pmod(pair["r"] + draw(i, pair["l"], b), b)).alias("r"),
        )

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, F.struct(left.alias("l"), right.alias("r")), turn)


# -- validation ---------------------------------------------------------------------


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _mod97(text: Column) -> Column:
    """A text of digits and capitals (A is 10) modulo 97."""

    def step(rest: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        value = F.when(digit, c.try_cast("int")).otherwise(F.ascii(c) - 55)
        return ((rest * F.when(digit, 10).otherwise(100) + value) % 97).try_cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(step(rest, c)))


def _month_first(text: Column) -> Column:
    """Whether a text is no date with the day in front, but one with the month there."""
    d = _digits(text)
    return ~text.rlike("^[0-9]{4}") & (F.substring(d, 3, 2) > "12")


def _date_of(text: Column) -> Column:
    """The date a text of any form names, null if the calendar has none."""
    d = _digits(text)
    year_first = text.rlike("^[0-9]{4}")
    iso = F.when(year_first, F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2))).when(
        _month_first(text), F.concat_ws("-", F.substring(d, 5, 4), F.substring(d, 1, 2), F.substring(d, 3, 2))
    ).otherwise(
        F.concat_ws("-", F.substring(d, 5, 4), F.substring(d, 3, 2), F.substring(d, 1, 2))
    )
    return F.try_to_date(iso, "yyyy-MM-dd")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _kind(m: Column) -> Column:
    d = _digits(m)
    compact = F.regexp_replace(m, " ", "")
    area = F.substring(d, 1, 3)
    date = _date_of(m)
    octets = F.split(m, r"\.")
    day = F.datediff(date, _day_zero())
    tests = {
        "email": F.lit(True),
        "iban": (_mod97(F.concat(F.substr(compact, F.lit(5)), F.substring(compact, 1, 4))) == 1) & (F.length(d) > 2),
        "ip": F.forall(octets, lambda o: o.try_cast("int") <= 255),
        # windows that lie within years of four digits
        "date": date.isNotNull() & day.between(-4 * _WINDOW, 40 * _WINDOW - 1),
        "phone": F.lit(True),
        "intl": F.length(d).between(8, 15),
        "ssn": (area != "000") & (area != "666") & (area < "900") & (F.substring(d, 4, 2) != "00") & (F.substring(d, 6, 4) != "0000"),
        "card": _luhn(d) & F.length(d).between(13, 19),
    }
    out = F
    for kind in KINDS:
        out = out.when(m.rlike(f"^(?:{_FORMS[kind]})$") & tests[kind], F.lit(kind))
    return F.coalesce(out, F.lit("none"))


# -- numbering ----------------------------------------------------------------------


def _cut(digits: Column) -> tuple[Column, Column, Column, Column]:
    """A run of digits as two numbers and their bounds."""
    size = F.length(digits)
    first = F.floor((size + 1) / 2).try_cast("int")
    return (
        _big(F.substr(digits, F.lit(1), first)),
        F.coalesce(_big(F.substr(digits, first + 1)), F.lit(0).try_cast("bigint")),
        _ten(first),
        _ten(size - first),
    )


def _middle(kind: Column, d: Column) -> Column:
    """The digits of a number that are permuted as a plain run."""
    size = F.length(d)
    return (
        F.when(kind == "card", F.substr(d, F.lit(2), size - 2))
        .when(kind == "iban", F.substr(d, F.lit(3)))
        .when(kind == "intl", F.substr(d, F.lit(3)))
        .otherwise(F.lit("0"))
    )


def _pair(kind: Column, m: Column, d: Column) -> Column:
    """l, r, a and b of a valid value, null for others."""
    octets = F.split(m, r"\.")
    octet = lambda i: F.get(octets, F.lit(i)).try_cast("bigint")
    tail = F.right(d, F.lit(10))
    area = F.substring(d, 1, 3).try_cast("bigint")
    day = F.datediff(_date_of(m), _day_zero()).try_cast("bigint")
    run = _cut(_middle(kind, d))
    big = lambda n: F.lit(n).try_cast("bigint")
    forms = {
        "ip": (octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), big(65536), big(65536)),
        "date": (F.floor(F.pmod(day, big(_WINDOW)) / _WINDOW_B), F.pmod(day, big(_WINDOW_B)), big(_WINDOW_A), big(_WINDOW_B)),
        # 800 areas, 800 exchanges, 10,000 lines
        "phone": (
            (_big(F.substring(tail, 1, 3)) - 200) * 100 + F.floor((_big(F.substring(tail, 4, 3)) - 200) / 8),
            (_big(F.substring(tail, 4, 3)) - 200) % 8 * 10_000 + _big(F.right(tail, F.lit(4))),
            big(80_000),
            big(80_000),
        ),
        # 898 areas, 99 groups, 9,999 serials
        "ssn": (
            (area - F.when(area > 666, 2).otherwise(1)) * 99 + _big(F.substring(d, 4, 2)) - 1,
            _big(F.substring(d, 6, 4)) - 1,
            big(898 * 99),
            big(9_999),
        ),
    }
    fields = []
    for i, name in enumerate("lrab"):
        column = F
        for form, values in forms.items():
            column = column.when(kind == form, values[i].try_cast("bigint"))
        fields.append(column.otherwise(run[i]).alias(name))
    return F.struct(*fields)


def _refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced one by one."""

    def at(i: Column) -> Column:
        c = F.substr(m, i, F.lit(1))
        place = F.length(_digits(F.substr(m, F.lit(1), i)))
        return F.when(c.between("0", "9"), F.substr(digits, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), at), "")


def _new_date(m: Column, out: Column) -> Column:
    day = F.floor(F.datediff(_date_of(m), _day_zero()) / _WINDOW) * _WINDOW + out["l"] * _WINDOW_B + out["r"]
    # a date's window of days starts where its own does; both halves number the days in it
    return F.date_add(_day_zero(), day.try_cast("int"))


def _walked(key: str, s: Column) -> Column:
    """The permuted pair; of a date with the month in front one whose day can't be a month.

    The permutation is applied until it gives such a date, which permutes those dates.
    """
    p = s["p"]
    again = F.sequence(F.lit(1), F.lit(TURNS))
    unfit = lambda out: F.dayofmonth(_new_date(s["m"], out)) <= 12
    walk = lambda out, _: F.when(unfit(out), _feistel(key, s["kind"], out["l"], out["r"], p["a"], p["b"])).otherwise(out)
    return F.when((s["kind"] == "date") & _month_first(s["m"]), F.aggregate(again, s["out"], walk)).otherwise(s["out"])


def _written(kind: Column, m: Column, d: Column, out: Column, pair: Column) -> Column:
    """The value of kind ``kind`` that the permuted pair stands for, in the form of ``m``."""
    l, r = out["l"], out["r"]  # noqa: E741
    size = F.length(_middle(kind, d))
    first = F.floor((size + 1) / 2).try_cast("int")
    run = F.concat(_pad(l, first), F.when(size > first, _pad(r, size - first)).otherwise(F.lit("")))
    card = F.concat(F.substring(d, 1, 1), run)
    check = F.get(F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: c.cast("string")), lambda c: _luhn(F.concat(card, c))), F.lit(0))
    compact = F.regexp_replace(m, " ", "")
    account = _refill(F.substr(compact, F.lit(5)), run)
    rest = 98 - _mod97(F.concat(account, F.substring(compact, 1, 2), F.lit("00")))
    area = F.floor(l / 99) + 1
    exchange = l % 100 * 8 + F.floor(r / 10_000) + 200
    date = _new_date(m, out)
    digits = (
        F.when(kind == "card", F.concat(card, check))
        .when(kind == "iban", F.concat(_pad(rest, 2), run))
        .when(kind == "intl", F.concat(F.substring(d, 1, 2), run))
        .when(kind == "phone", F.concat(F.substr(d, F.lit(1), F.length(d) - 10), _pad(F.floor(l / 100) + 200, 3), _pad(exchange, 3), _pad(r % 10_000, 4)))
        .when(kind == "ssn", F.concat(_pad(area + F.when(area >= 666, 1).otherwise(0), 3), _pad(l % 99 + 1, 2), _pad(r + 1, 4)))
        .when(kind == "date", F.when(m.rlike("^[0-9]{4}"), F.date_format(date, "yyyyMMdd")).when(_month_first(m), F.date_format(date, "MMddyyyy")).otherwise(F.date_format(date, "ddMMyyyy")))
    )
    ip = F.concat_ws(".", F.floor(l / 256).cast("string"), (l % 256).cast("string"), F.floor(r / 256).cast("string"), (r % 256).cast("string"))
    return F.when(kind == "ip", ip).otherwise(_refill(m, digits))


def _email(key: str, m: Column) -> Column:
    """The local part permuted, in runs of at most ten letters and digits; the domain as it is."""
    local = F.lower(F.substring_index(m, "@", 1))

    def name(part: Column) -> Column:
        size = F.length(part)
        first = F.floor((size + 1) / 2).try_cast("int")
        base = lambda text: F.coalesce(F.conv(text, 36, 10).try_cast("bigint"), F.lit(0).try_cast("bigint"))
        power = lambda n: F.round(F.pow(F.lit(36.0), n)).try_cast("bigint")
        pair = _feistel(
            key, F.lit("email"), base(F.substr(part, F.lit(1), first)), base(F.substr(part, first + 1)), power(first), power(size - first)
        )
        spell = lambda n, width: F.lower(F.lpad(F.conv(n.cast("string"), 10, 36), width, "0"))
        written = F.transform(
            F.array(pair),
            lambda p: F.concat(spell(p["l"], first), F.when(size > first, spell(p["r"], size - first)).otherwise(F.lit(""))),
        )
        return F.when(part.rlike("^[a-z0-9]"), F.get(written, F.lit(0))).otherwise(part)

    parts = F.regexp_extract_all(local, F.lit("([a-z0-9]{1,10}|[^a-z0-9])"), F.lit(1))
    return F.concat(F.array_join(F.transform(parts, name), ""), F.lit("@"), F.substring_index(m, "@", -1))


def _replaced(key: str) -> Callable[[Column], Column]:
    """From an array of matches to an array of (kind, text); each step binds what the next one uses."""

    def run(matches: Column) -> Column:
        kinds = F.transform(matches, lambda m: F.struct(m.alias("m"), _kind(m).alias("kind"), _digits(m).alias("d")))
        paired = F.transform(kinds, lambda s: F.struct(s["m"], s["kind"], s["d"], _pair(s["kind"], s["m"], s["d"]).alias("p")))
        drawn = F.transform(
            paired,
            lambda s: F.struct(
                s["m"], s["kind"], s["d"], s["p"],
                F.when(
                    ~s["kind"].isin("none", "email"),
                    _feistel(key, s["kind"], s["p"]["l"], s["p"]["r"], s["p"]["a"], s["p"]["b"]),
                ).alias("out"),
            ),
        )
        drawn = F.transform(
            drawn, lambda s: F.struct(s["m"], s["kind"], s["d"], s["p"], _walked(key, s).alias("out"))
        )
        return F.transform(
            drawn,
            lambda s: F.struct(
                s["kind"].alias("kind"),
                F.when(s["kind"] == "none", s["m"])
                .when(s["kind"] == "email", _email(key, s["m"]))
                .otherwise(_written(s["kind"], s["m"], s["d"], s["out"], s["p"]))
                .alias("text"),
            ),
        )

    return run


def _card_in(m: Column) -> Column:
    """(begin, size) of the card in a run of numbers that isn't written as one; null if there is none.

    A card begins and ends where the run does or at a blank.  Of several the one written as
    cards are comes first, then the one further in front, then the longer one.
    """
    size = F.length(m)
    blank = lambda i: F.substr(m, i, F.lit(1)) == " "
    begins = F.filter(F.sequence(F.lit(1), size), lambda i: (i == 1) | blank(i - 1))
    ends = F.filter(F.sequence(F.lit(1), size), lambda i: (i == size) | blank(i + 1))
    runs = F.flatten(F.transform(begins, lambda b: F.transform(ends, lambda e: F.struct(b.alias("b"), (e - b + 1).alias("n")))))
    text = lambda r: F.substr(m, r["b"], r["n"])
    cards = F.filter(
        F.filter(runs, lambda r: r["n"] >= 13),
        lambda r: F.length(_digits(text(r))).between(13, 19) & _luhn(_digits(text(r))) & text(r).rlike(f"^(?:{_CARD})$"),
    )
    ranked = F.transform(cards, lambda r: F.struct((~text(r).rlike(_GROUPED)).alias("odd"), r["b"].alias("b"), (-r["n"]).alias("n")))
    best = F.array_min(ranked)
    return F.when(m.rlike(f"^(?:{_CARD})$") & m.contains(" "), best)


def _marked(found: Column, text: Column, mark: Column) -> Column:
    """The text with a mark before and after each card that has other numbers beside it."""

    def value(m: Column) -> Column:
        bound = F.transform(F.array(_card_in(m)), lambda c: F.when(
            c.isNotNull() & (-c["n"] < F.length(m)),
            F.concat(F.substr(m, F.lit(1), c["b"] - 1), mark, F.substr(m, c["b"], -c["n"]), mark, F.substr(m, c["b"] - c["n"])),
        ).otherwise(m))
        return F.get(bound, F.lit(0))

    gaps = F.split(text, PATTERN, -1)
    values = F.transform(found, value)
    return F.array_join(F.flatten(F.zip_with(gaps, values, lambda gap, v: F.array(gap, F.coalesce(v, F.lit(""))))), "")


_STEPS = ("found", "new", "mark", "marked")


def pseudonymize(docs: DataFrame, *, key: str, text_col: str = "text", count_prefix: str = "n_") -> DataFrame:
    """Replace personal values in whole texts; adds a count per kind, ``n_email`` and so on.

    ``key`` is the secret of the permutation: keep it, and the same values get the same
    pseudonyms in later runs.  A column that has the name of a count already is replaced.
    """
    text = F.col(text_col)
    # most texts hold no digit and no address: they skip the search
    some = text.rlike("[0-9@]")
    taken = {c.lower() for c in docs.columns}
    names = [next(n for n in (f"__{word}{i or ''}__" for i in count_from(0)) if n not in taken) for word in _STEPS]
    search = lambda t: F.regexp_extract_all(t, F.lit(f"({PATTERN})"), F.lit(1))
    runs = F.transform(F.regexp_extract_all(text, F.lit(f"({_MARK}+)"), F.lit(1)), F.length)
    free = F.repeat(F.lit(_MARK), F.coalesce(F.array_max(runs), F.lit(0)) + 1)
    out = docs.withColumn(names[0], F.when(some, search(text)))
    # what stands beside a card is searched on its own
    beside = F.exists(names[0], lambda m: F.coalesce(-_card_in(m)["n"] < F.length(m), F.lit(False)))
    out = out.withColumn(names[2], F.when(beside, free))
    out = out.withColumn(names[3], F.when(F.col(names[2]).isNotNull(), _marked(F.col(names[0]), text, F.col(names[2]))))
    marked = F.coalesce(F.col(names[3]), text)
    out = out.withColumn(names[0], F.when(F.col(names[3]).isNotNull(), search(F.col(names[3]))).otherwise(F.col(names[0])))
    out = out.withColumn(names[1], F.when(F.size(names[0]) > 0, _replaced(key)(F.col(names[0]))))
    new = F.col(names[1])
    gaps = F.split(marked, PATTERN, -1)
    joined = F.array_join(
        F.flatten(F.zip_with(gaps, new, lambda gap, value: F.array(gap, F.coalesce(value["text"], F.lit(""))))), ""
    )
    joined = F.when(F.col(names[2]).isNotNull(), F.replace(joined, F.col(names[2]), F.lit(""))).otherwise(joined)
    changed = new.isNotNull()

    def count(kind: str) -> Column:
        of_kind = F.size(F.filter(new, lambda v: v["kind"] == kind))
        return F.when(changed, of_kind).otherwise(F.lit(0)).cast("bigint")

    counts = {f"{count_prefix}{kind}": count(kind) for kind in KINDS}
    kept = [c for c in docs.columns if c not in counts]
    return out.select(
        *(F.when(changed, joined).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in kept),
        *(c.alias(name) for name, c in counts.items()),
    )
