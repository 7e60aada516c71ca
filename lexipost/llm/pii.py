"""Pseudonyms for personal data: keyed permutations within the format of each value.

Values are found by regular expressions, validated (check digits, octets, calendar), and
mapped by a Feistel network to another value of the same format and the same validity.
The map is a permutation: different values stay different, and equal values get equal
pseudonyms in every document. Everything is built-in SQL functions.

A number or date is taken as an index below N, N being how many values its format has.
The network works on pairs of digits to the base ceil(sqrt(N)); a result of N or more is
sent through again until it falls below N, which keeps the map a permutation. The local
part of an e-mail address goes through a network on its two halves that shifts every
letter within its kind.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8  # an even number, so that halves end in their places
_WALKS = 16  # of a cycle; an index leaves it by chance once in 10^20 and more

KINDS = ("email", "phone", "ip", "ssn", "date", "card")
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_FREE, _DONE = r"(?<![0-9+])(?<![0-9][.-])", r"(?![0-9]|[.-][0-9])"
#: With a country's code: the common grouping first, then 7 to 15 digits in any grouping.
PHONE = (
    r"(?<![0-9+])\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z+])\+[1-9](?:[ ./()-]{0,2}[0-9]){6,14}(?![0-9])"
    + "|" + _FREE + r"00[1-9][0-9]{0,2}[ .-](?:[ ./()-]{0,2}[0-9]){6,12}(?![0-9])"
)
#: Without one: 3-3-4 digits, and those that begin with the trunk's 0. A dot alone makes a
#: decimal number, so one after the area code needs a second separator.
NATIONAL = (
    _FREE + r"(?:1[ .-]?)?(?:\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?|(?<![0-9])[0-9]{3}[ .-][0-9]{3}[ .-])[0-9]{4}" + _DONE
)
TRUNK = (
    _FREE + r"(?:(?:\(0[1-9][0-9]{1,4}\)[ -]?|0[1-9][0-9]{1,4}[ /-])[0-9]{3,4}[ -]?"
    r"|0[1-9][0-9]{1,4}\.[0-9]{3,4}[ .-])[0-9]{3,5}" + _DONE
)
COUNTRY = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
ADDRESS = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
SOCIAL = r"(?<![0-9-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{3} [0-9]{2} [0-9]{4})(?![0-9-])"
DATE = (
    r"(?<![0-9-])[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?![0-9-])"
    r"|(?<![0-9./])[0-9]{4}(?:/[0-9]{1,2}/|\.[0-9]{1,2}\.)[0-9]{1,2}(?![0-9/]|\.[0-9])"
)
#: The day first; if that is no date, the month.
YEAR_LAST = (
    r"(?<![0-9./-])[0-9]{1,2}(?:/[0-9]{1,2}/|\.[0-9]{1,2}\.|-[0-9]{1,2}-)[0-9]{4}(?![0-9/-]|\.[0-9])"
)
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
FOUND = "|".join((EMAIL, PHONE, ADDRESS, SOCIAL, DATE, YEAR_LAST, CARD, NATIONAL, TRUNK))

#: Dates from the first to the last day are permuted; others are left alone.
FIRST_DAY, DAYS = "1900-01-01", 73_049  # to 2099-12-31
#: Dates that only a month-first reading allows have a day of 13 or more; so have their pseudonyms.
MONTHS = 2_400
LATE_DAYS = DAYS - 12 * MONTHS
SOCIAL_NUMBERS = 898 * 99 * 9_999  # area 001-899 without 666, group 01-99, serial 0001-9999

_LETTERS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _drawn(*parts: Column) -> Column:
    """A keyed number below 2^60."""
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def permuted(index: Column, count: Column, base: Column, key: str, label: Column) -> Column:
    """A keyed permutation of 0 .. count - 1; ``base`` is ceil(sqrt(count)), below 2^31."""

    def round_(pair: Column, number: Column) -> Column:
        mask = _drawn(F.lit(key), label, number, pair["r"])
        return F.struct(pair["r"].alias("l"), ((pair["l"] + mask) % base).alias("r"))

    def once(value: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(ROUNDS)),
            F.struct(_div(value, base).alias("l"), (value % base).alias("r")),
            round_,
            lambda p: p["l"] * base + p["r"],
        )

    return F.aggregate(
        F.sequence(F.lit(2), F.lit(_WALKS)),
        once(index),
        lambda now, _: F.when(now < count, now).otherwise(once(now)),
        lambda last: F.when(last < count, last).otherwise(index),
    )


def _shifted(part: Column, other: Column, number: Column, key: str) -> Column:
    """``part`` with each letter or digit moved within its kind by amounts from ``other``."""

    def moved(letter: Column, at: Column) -> Column:
        out = letter
        for alphabet in _LETTERS:
            place = F.instr(F.lit(alphabet), letter)
            step = _drawn(F.lit(key), F.lit("email"), number, at, other) % len(alphabet)
            to = ((place - 1 + step) % len(alphabet) + 1).cast("int")
            out = F.when((place > 0) & (letter != ""), F.substring(F.lit(alphabet), to, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(part, ""), moved), "")


def _email(value: Column, key: str) -> Column:
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    half = _div(F.length(local), F.lit(2)).cast("int")
    halves = F.struct(
        F.substring(local, F.lit(1), half).alias("l"),
        F.substring(local, half + 1, F.length(local)).alias("r"),
    )
    mixed = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        halves,
        lambda p, n: F.struct(p["r"].alias("l"), _shifted(p["l"], p["r"], n, key).alias("r")),
        lambda p: F.concat(p["l"], p["r"]),
    )
    return F.concat(mixed, F.lit("@"), domain)


def _padded(number: Column, digits: Column | int) -> Column:
    return F.lpad(number.cast("string"), digits, "0")


def _relaid(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, one by one, by ``digits``."""
    return F.array_join(
        F.transform(
            F.split(value, ""),
            lambda c, i: F.when(
                c.rlike("[0-9]"),
                F.substring(
                    digits,
                    F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), "[^0-9]", "")),
                    F.lit(1),
                ),
            ).otherwise(c),
        ),
        "",
    )


def _day(value: Column, month_first: bool = False) -> Column:
    """Days since the first day; null for what is no date of the range."""
    parts = F.split(value, "[./-]")
    order = F.when(value.rlike("^[0-9]{4}"), F.array(*[parts[i] for i in (0, 1, 2)])).otherwise(
        F.array(*[parts[i] for i in ((2, 0, 1) if month_first else (2, 1, 0))])
    )
    iso = F.array_join(F.transform(order, lambda x: F.lpad(x, F.greatest(F.length(x), F.lit(2)), F.lit("0"))), "-")
    day = F.datediff(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date"), F.lit(FIRST_DAY).cast("date"))
    return F.when((day >= 0) & (day < DAYS), day.cast("bigint"))


def _month_start(month: Column) -> Column:
    """Days from the first day to a month's first, months counted from 0."""
    first = F.lit(FIRST_DAY).cast("date")
    return F.datediff(F.add_months(first, month.cast("int")), first).cast("bigint")


def _late_index(day: Column) -> Column:
    """The number of a date among those whose day is 13 or later."""
    date = F.date_add(F.lit(FIRST_DAY).cast("date"), day.cast("int"))
    month = (F.year(date) - 1900) * 12 + F.month(date)
    return day - 12 * month


def _late_day(index: Column) -> Column:
    """The day that has this ``_late_index``."""
    near = _div(index * MONTHS, F.lit(LATE_DAYS))
    months = F.filter(
        F.sequence(F.greatest(near - 3, F.lit(0)), F.least(near + 3, F.lit(MONTHS - 1))),
        lambda m: _month_start(m) - 12 * m <= index,
    )
    return index + 12 * (F.array_max(months) + 1)


def _kind(value: Column) -> Column:
    """The kind of a match; null if it is not valid."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    octets = F.transform(F.split(value, "\\."), lambda o: o.cast("int"))
    is_address = value.rlike("^" + ADDRESS + "$")
    return (
        F.when(F.contains(value, F.lit("@")), F.lit("email"))
        .when(F.startswith(value, F.lit("+")), F.lit("phone"))
        .when(is_address, F.when(F.forall(octets, lambda o: o <= 255), F.lit("ip")))
        .when(
            value.rlike("^" + SOCIAL + "$"),
            F.when(
                ~value.rlike("^(?:000|666|9)") & ~value.rlike("[ -]00[ -]") & ~value.rlike("[ -]0000$"),
                F.lit("ssn"),
            ),
        )
        .when(
            value.rlike("^(?:" + DATE + "|" + YEAR_LAST + ")$"),
            F.when(_day(value).isNotNull() | _day(value, True).isNotNull(), F.lit("date")),
        )
        .when(
            value.rlike("^(?:" + PHONE + "|" + NATIONAL + "|" + TRUNK + ")$")
            & ~value.rlike("^(?:" + CARD + ")$"),
            F.lit("phone"),
        )
        .otherwise(F.when(F.call_function("luhn_check", digits), F.lit("card")))
    )


def _number_pseudonym(value: Column, kind: Column, key: str) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    # What stays of a phone number: the country's code, or the trunk's 0.
    code = lambda at: F.length(F.regexp_extract(F.substring(digits, at, 3), COUNTRY, 1)) + at - 1
    prefix = (
        F.when(F.startswith(value, F.lit("+")), code(1))
        .when(value.rlike("^(?:" + NATIONAL + ")$"), F.length(digits) - 10)
        .when(value.rlike("^00"), code(3))
        .otherwise(1)
    )
    # The digits of a phone number after that, of a card before its check digit.
    payload = F.length(digits) - F.when(kind == "phone", prefix).otherwise(1)
    late = (kind == "date") & _day(value).isNull()  # the month first

    def part(at: int, size: int) -> Column:
        return F.substring(value, at, size).cast("bigint")

    area = part(1, 3) - 1 - F.when(part(1, 3) > 666, 1).otherwise(0)
    octets = F.transform(F.split(value, "\\."), lambda o: o.cast("bigint"))
    index = (
        F.when(kind == "phone", F.substring(digits, prefix + 1, payload).cast("bigint"))
        .when(kind == "ip", F.aggregate(octets, F.lit(0).cast("bigint"), lambda a, o: a * 256 + o))
        .when(kind == "ssn", (area * 99 + part(5, 2) - 1) * 9_999 + part(8, 4) - 1)
        .when(late, _late_index(_day(value, True)))
        .when(kind == "date", _day(value))
        .otherwise(F.substring(digits, F.lit(1), payload).cast("bigint"))
    )
    powers = [10**n for n in range(19)]
    roots = [math.isqrt(p - 1) + 1 for p in powers]
    fixed = {"ip": 2**32, "ssn": SOCIAL_NUMBERS, "date": DAYS}
    count = F.element_at(F.array(*[F.lit(p).cast("bigint") for p in powers]), payload + 1)
    base = F.element_at(F.array(*[F.lit(r).cast("bigint") for r in roots]), payload + 1)
    for name, n in fixed.items():
        count = F.when(kind == name, F.lit(n).cast("bigint")).otherwise(count)
        base = F.when(kind == name, F.lit(math.isqrt(n - 1) + 1).cast("bigint")).otherwise(base)
    count = F.when(late, F.lit(LATE_DAYS).cast("bigint")).otherwise(count)
    base = F.when(late, F.lit(math.isqrt(LATE_DAYS - 1) + 1).cast("bigint")).otherwise(base)
    sized = (kind == "card") | ((kind == "phone") & (payload != 10))
    label = F.when(sized, F.concat(kind, payload.cast("string"))).otherwise(
        F.when(late, F.lit("late")).otherwise(kind)
    )
    values = F.struct(index.alias("index"), count.alias("count"), base.alias("base"), label.alias("label"))
    new = _let(values, lambda v: permuted(v["index"], v["count"], v["base"], key, v["label"]))

    def written(n: Column) -> Column:
        social_area = _div(n, F.lit(99 * 9_999)) + 1
        social_area = social_area + F.when(social_area >= 666, 1).otherwise(0)
        social = F.concat(
            _padded(social_area, 3),
            _padded(_div(n, F.lit(9_999)) % 99 + 1, 2),
            _padded(n % 9_999 + 1, 4),
        )
        day = F.date_add(
            F.lit(FIRST_DAY).cast("date"), F.when(late, _late_day(n)).otherwise(n).cast("int")
        )
        # A part of one digit says that small numbers are written without a zero.
        short = value.rlike("(?:^|[./-])[0-9](?:[./-]|$)")
        mark = F.regexp_extract(value, "[./-]", 0)

        def dated(*parts: str) -> Column:
            shown = lambda p: F.when(short, F.date_format(day, p[:1] if p != "yyyy" else p)).otherwise(
                F.date_format(day, p)
            )
            return F.concat(shown(parts[0]), mark, shown(parts[1]), mark, shown(parts[2]))

        date = (
            F.when(value.rlike("^[0-9]{4}"), dated("yyyy", "MM", "dd"))
            .when(late, dated("MM", "dd", "yyyy"))
            .otherwise(dated("dd", "MM", "yyyy"))
        )
        front = _padded(n, payload)
        checked = F.filter(
            F.sequence(F.lit(0), F.lit(9)),
            lambda c: F.call_function("luhn_check", F.concat(front, c.cast("string"))),
        )
        address = F.concat_ws(
            ".", *[(_div(n, F.lit(256**k)) % 256).cast("string") for k in (3, 2, 1, 0)]
        )
        kept = F.substring(digits, F.lit(1), prefix)
        return (
            F.when(kind == "ip", address)
            .when(kind == "phone", _relaid(value, F.concat(kept, front)))
            .when(kind == "ssn", _relaid(value, social))
            .when(kind == "date", date)
            .otherwise(_relaid(value, F.concat(front, checked[0].cast("string"))))
        )

    return _let(new, written)


def pseudonymized(
    docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row (key, text, n_email, n_phone, n_ip, n_ssn, n_date, n_card) per row.

    ``text`` has every valid value replaced by its pseudonym; what is not valid, and all
    else, stays as it is. Equal values have equal pseudonyms under one ``secret``. A null
    text stays null, with counts of 0. Repeated rows are treated each; other columns are
    left out, whatever their names; an empty table gives no rows.

    A projection without a shuffle: a text is handled within its row.
    """

    def pseudonym(value: Column) -> Column:
        return _let(
            F.struct(value.alias("value"), _kind(value).alias("kind")),
            lambda v: F.struct(
                v["kind"].alias("kind"),
                F.when(v["kind"].isNull(), v["value"])
                .when(v["kind"] == "email", _email(v["value"], secret))
                .otherwise(_number_pseudonym(v["value"], v["kind"], secret))
                .alias("value"),
            ),
        )

    def rewritten(s: Column) -> Column:
        made = F.transform(s["found"], pseudonym)
        return _let(
            F.struct(s["text"].alias("text"), made.alias("made")),
            lambda r: F.struct(
                F.array_join(
                    F.zip_with(
                        F.split(r["text"], FOUND, -1),
                        r["made"],
                        lambda piece, m: F.concat(piece, F.coalesce(m["value"], F.lit(""))),
                    ),
                    "",
                ).alias("text"),
                F.transform(r["made"], lambda m: m["kind"]).alias("kinds"),
            ),
        )

    content = F.col(text).cast("string")
    # A text without a digit or an @ holds no value and is not searched further.
    found = F.when(content.rlike("[0-9@]"), F.regexp_extract_all(content, F.lit(FOUND), F.lit(0)))
    changed = _let(
        F.struct(content.alias("text"), found.alias("found")),
        lambda s: F.when(F.size(s["found"]) > 0, rewritten(s)).otherwise(
            F.struct(s["text"].alias("text"), F.array().cast("array<string>").alias("kinds"))
        ),
    )
    return docs.select(F.col(key).alias(key), changed.alias("_new")).select(
        key,
        F.col("_new.text").alias("text"),
        *[
            F.expr(f"cast(size(filter(_new.kinds, k -> k = '{kind}')) as bigint)").alias(f"n_{kind}")
            for kind in KINDS
        ],
    )
