"""Format-preserving Feistel pseudonyms, in DataFrame functions only.

Validated numbers and dates in a text are replaced by a keyed permutation within their own
format: a card number becomes another card number with a right check digit, a date another
date. The permutation depends on the key and the kind alone, so that equal values stay equal
across documents, and :func:`restore` undoes it with the key.

Kinds: payment cards (13-19 digits, check digit), IBANs (mod 97), US social security numbers,
phone numbers (ten digits of the North American plan), IPv4 addresses of hosts, dates (year
first; day first with dots; month first with slashes or hyphens, day first where only that is
valid) and e-mail names (the part before the @; letters stay letters, digits stay digits).
Numbers that do not validate stay as they are.

Defined cases: a null text stays null and an empty one empty; repeated rows come out alike; a
null id stays null; extra columns pass through, also if they are named like internal ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Days in 400 years of the calendar, as a product: the two halves of a date.
_ERA = (189, 773)
_FIRST_DAY = "1800-01-01"

_CARD = r"(?<![\w.-])(?:\d{13,19}|\d{4}([ -])\d{4}\3\d{4}\3\d{1,7}|\d{4}([ -])\d{6}\4\d{5})(?![\w-])"
_IBAN = r"(?<!\w)[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?!\w)"
_SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
_PHONE = r"(?<![\w-])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
_IP = r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)"
_DATE = r"(?<![\w./-])(?:\d{4}([./-])\d{2}\1\d{2}|\d{1,2}([./-])\d{1,2}\2\d{4})(?!\w|[./-]\d)"
_MAIL = r"(?<![\w.+%-])[A-Za-z0-9][\w.+%-]{0,63}(?=@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
#: In this order: what a longer form may contain comes after it. Groups count through all of them.
PATTERN = "|".join((_MAIL, _DATE, _SSN, _PHONE, _IP, _CARD, _IBAN))


def _keyed(key: str, kind: str, *parts: Column) -> Column:
    """512 bits that depend on the key, as hexadecimal digits (two nested hashes)."""
    message = F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts])
    return F.sha2(F.concat_ws("|", F.lit(f"{key}|outer"), F.sha2(message, 512)), 512)


def _loop(start: Column, step: Callable[[Column, Column], Column], inverse: bool) -> Column:
    order = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(r) for r in order]), start, step)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is computed once."""
    return F.transform(F.array(value), then)[0]


def permute_number(value: Column, left: int, right: int, key: str, kind: str, inverse: bool = False) -> Column:
    """Feistel permutation of 0 .. left * right - 1 with halves of any two sizes."""
    sign = -1 if inverse else 1

    def shift(half: Column, other: Column, r: Column, size: int) -> Column:
        f = F.conv(F.substring(_keyed(key, kind, r, other), 1, 15), 16, 10).cast("long")
        return F.pmod(half + F.lit(sign) * F.pmod(f, F.lit(size)), F.lit(size)).cast("long")

    def step(s: Column, r: Column) -> Column:
        even = F.pmod(r, F.lit(2)) == 0
        return F.struct(
            F.when(even, shift(s["l"], s["r"], r, left)).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise(shift(s["r"], s["l"], r, right)).alias("r"),
        )

    whole = value.cast("long")
    start = F.struct(F.floor(whole / F.lit(right)).cast("long").alias("l"), F.pmod(whole, F.lit(right)).cast("long").alias("r"))
    return _let(_loop(start, step, inverse), lambda s: s["l"] * F.lit(right) + s["r"])


def permute_text(value: Column, key: str, kind: str, inverse: bool = False) -> Column:
    """Feistel permutation of a text: digits stay digits, letters letters of their case, and
    all other characters stay. Halves are the two halves of the text."""
    sign = -1 if inverse else 1

    def shifted(half: Column, other: Column, r: Column) -> Column:
        def one(c: Column, i: Column, stream: Column) -> Column:
            # two bytes of the hash for each of 32 places, then the same again
            f = F.conv(F.substr(stream, F.pmod(i, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int") * F.lit(sign)
            code = F.ascii(c)
            turn = lambda first, n: F.char(F.pmod(code - first + f, F.lit(n)) + first)
            return F.when(code.between(48, 57), turn(48, 10)).when(code.between(97, 122), turn(97, 26)).when(code.between(65, 90), turn(65, 26)).otherwise(c)

        return _let(_keyed(key, kind, r, other), lambda s: F.array_join(F.transform(F.split(half, ""), lambda c, i: one(c, i, s)), ""))

    def step(s: Column, r: Column) -> Column:
        even = F.pmod(r, F.lit(2)) == 0
        return F.struct(
            F.when(even, shifted(s["l"], s["r"], r)).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise(shifted(s["r"], s["l"], r)).alias("r"),
        )

    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), half).alias("l"), F.substr(value, half + 1, F.length(value)).alias("r"))
    return _let(_loop(start, step, inverse), lambda s: F.concat(s["l"], s["r"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _laid_out(value: Column, digits: Column) -> Column:
    """``digits`` in the places that the digits of ``value`` have."""
    return F.array_join(
        F.transform(
            F.split(value, ""),
            lambda c, i: F.when(c.rlike("^[0-9]$"), F.substr(digits, F.length(_digits(F.substr(value, F.lit(1), i + 1))), F.lit(1))).otherwise(c),
        ),
        "",
    )


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of digits from the right, each second one doubled, from place ``doubled`` on."""
    return F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda c, i: F.when(F.pmod(i, F.lit(2)) == doubled, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )


def _mod97(value: Column) -> Column:
    return F.aggregate(
        F.split(value, ""),
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), F.pmod(a * 10 + c.try_cast("int"), F.lit(97))).otherwise(F.pmod(a * 100 + F.ascii(c) - 55, F.lit(97))),
    )


def _card(v: Column, key: str, inverse: bool) -> Column:
    d = _digits(v)
    n = F.length(d)
    # the first digit stays (it names the network), the last is the check digit
    own = F.concat(F.substr(d, F.lit(1), F.lit(1)), permute_text(F.substr(d, F.lit(2), n - 2), key, "card", inverse))
    check = lambda x: F.pmod(F.lit(10) - F.pmod(_luhn_sum(x, 0), F.lit(10)), F.lit(10)).cast("string")
    return F.when(_luhn_sum(d, 1) % 10 == 0, _let(_let(own, lambda x: F.concat(x, check(x))), lambda x: _laid_out(v, x)))


def _iban(v: Column, key: str, inverse: bool) -> Column:
    land, account = F.substr(v, F.lit(1), F.lit(2)), F.substr(v, F.lit(5), F.length(v))
    check = lambda new: F.lpad((F.lit(98) - _mod97(F.concat(new, land, F.lit("00")))).cast("string"), 2, "0")
    out = _let(permute_text(account, key, "iban", inverse), lambda new: F.concat(land, check(new), new))
    return F.when(_mod97(F.concat(account, F.substr(v, F.lit(1), F.lit(4)))) == 1, out)


def _part(d: Column, at: int, n: int) -> Column:
    return F.substr(d, F.lit(at), F.lit(n)).cast("long")


def _ssn(v: Column, key: str, inverse: bool) -> Column:
    d = _digits(v)
    area, group, serial = _part(d, 1, 3), _part(d, 4, 2), _part(d, 6, 4)
    index = (area - 1 - (area > 666).cast("long")) * (99 * 9999) + (group - 1) * 9999 + serial - 1

    def digits(new: Column) -> Column:
        place = F.floor(new / (99 * 9999)) + 1
        return F.concat(
            F.lpad((place + (place >= 666).cast("long")).cast("string"), 3, "0"),
            F.lpad((F.pmod(F.floor(new / 9999), F.lit(99)) + 1).cast("string"), 2, "0"),
            F.lpad((F.pmod(new, F.lit(9999)) + 1).cast("string"), 4, "0"),
        )

    out = _let(_let(permute_number(index, 898, 99 * 9999, key, "ssn", inverse), digits), lambda x: _laid_out(v, x))
    return F.when(area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), out)


def _phone(v: Column, key: str, inverse: bool) -> Column:
    d = F.regexp_extract(_digits(v), "([0-9]{10})$", 1)
    area, office, line = _part(d, 1, 3), _part(d, 4, 3), _part(d, 7, 4)
    index = ((area - 200) * 800 + office - 200) * 10000 + line

    def digits(new: Column) -> Column:
        return F.concat(
            F.when(v.startswith("+1"), "1").otherwise(""),
            (F.floor(new / 8_000_000) + 200).cast("string"),
            (F.pmod(F.floor(new / 10_000), F.lit(800)) + 200).cast("string"),
            F.lpad(F.pmod(new, F.lit(10_000)).cast("string"), 4, "0"),
        )

    out = _let(_let(permute_number(index, 640_000, 10_000, key, "phone", inverse), digits), lambda x: _laid_out(v, x))
    return F.when((area >= 200) & (office >= 200), out)


def _ip(v: Column, key: str, inverse: bool) -> Column:
    o = [F.split_part(v, F.lit("."), F.lit(i)).cast("long") for i in (1, 2, 3, 4)]
    index = ((o[0] - 1) * 256 + o[1]) * 65536 + o[2] * 256 + o[3]
    shown = lambda new: F.concat_ws(".", *[(F.pmod(F.floor(new / 256**k), F.lit(256)) + int(k == 3)).cast("string") for k in (3, 2, 1, 0)])
    out = _let(permute_number(index, 223 * 256, 65536, key, "ip", inverse), shown)
    return F.when(o[0].between(1, 223) & (F.array_max(F.array(*o)) <= 255), out)


def _date(v: Column, key: str, inverse: bool) -> Column:
    a, b, c = (F.regexp_extract(v, r"^(\d+)[./-](\d+)[./-](\d+)$", i) for i in (1, 2, 3))
    year_first = F.length(a) == 4
    valid = lambda y, m, d: F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")
    ymd, mdy, dmy = valid(a, b, c), valid(c, a, b), valid(c, b, a)
    first_day = F.lit(_FIRST_DAY).cast("date")

    def moved(day: Column) -> Column:
        offset = F.datediff(day, first_day)
        size = _ERA[0] * _ERA[1]
        era = F.floor(offset / size).cast("int") * size
        return F.date_add(first_day, (era + permute_number(offset - era, *_ERA, key, "date", inverse)).cast("int"))

    sep = F.regexp_extract(v, r"([./-])", 1)

    def shown(day: Column, order: str) -> Column:
        parts = {"y": F.lpad(F.year(day).cast("string"), 4, "0"), "m": F.month(day).cast("string"), "d": F.dayofmonth(day).cast("string")}
        padded = [F.when(F.length(old) == 2, F.lpad(parts[k], 2, "0")).otherwise(parts[k]) for k, old in zip(order, (a, b, c), strict=True)]
        return F.concat(padded[0], sep, padded[1], sep, padded[2])

    return (
        F.when(year_first & ymd.isNotNull(), _let(moved(ymd), lambda day: shown(day, "ymd")))
        .when(~year_first & (sep != ".") & mdy.isNotNull(), _let(moved(mdy), lambda day: shown(day, "mdy")))
        .when(~year_first & dmy.isNotNull(), _let(moved(dmy), lambda day: shown(day, "dmy")))
    )


_KINDS = (
    (r"^[0-9]{4}([./-])[0-9]{2}\1[0-9]{2}$|^[0-9]{1,2}([./-])[0-9]{1,2}\2[0-9]{4}$", _date),
    (r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$", _ssn),
    (r"^(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$", _phone),
    (r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$", _ip),
    (r"^[0-9]{4}[0-9 -]{9,18}$", _card),
    (r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$", _iban),
)


def _replaced(v: Column, is_mail: Column, key: str, inverse: bool) -> Column:
    out = F.when(is_mail, permute_text(v, key, "mail", inverse))
    for pattern, kind in _KINDS:
        out = out.when(v.rlike(pattern), kind(v, key, inverse))
    return F.coalesce(out, v)


def pseudonymise(docs: DataFrame, key: str, inverse: bool = False) -> DataFrame:
    """``docs`` with replaced values in ``text``; all other columns as they are."""
    rows = docs.select(F.struct("*").alias("row"))
    text = F.col("row")["text"]
    # a cheap look first: no kind lacks an @, two digits in a row or digits around a dot
    maybe = text.contains("@") | text.rlike(r"[0-9](?:[0-9]|\.[0-9])")
    parts = rows.select(
        "row", F.when(maybe, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).alias("found")
    ).select("row", "found", F.when(F.size("found") > 0, F.split(text, PATTERN, -1)).alias("between"))
    new = F.transform(
        F.arrays_zip(F.col("found").alias("v"), F.slice("between", 2, F.size("found")).alias("after")),
        lambda x: F.concat(_replaced(x["v"], x["after"].startswith("@"), key, inverse), x["after"]),
    )
    whole = F.concat(F.col("between")[0], F.array_join(new, ""))
    return parts.select(
        *[(F.when(F.size("found") > 0, whole).otherwise(text) if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns]
    )


def restore(docs: DataFrame, key: str) -> DataFrame:
    """Undoes :func:`pseudonymise` (but for dates whose day-first reading became ambiguous)."""
    return pseudonymise(docs, key, inverse=True)
