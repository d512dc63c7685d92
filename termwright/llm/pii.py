"""Format-preserving pseudonyms for personal data, with DataFrame functions only.

Validated numbers and dates are permuted within their own format by a keyed Feistel network, so
equal values have equal pseudonyms in all documents and different ones stay different. Addresses
and secrets, which have no numeric format, get keyed digests of their own length.

The rounds use HMAC-SHA-256. What it derives from the key stands in the plan as literals, so whoever may
read plans or event logs can make the same pseudonyms: keep those as closed as the key, or hide the literals by
``spark.sql.redaction.string.regex``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termwright.llm._shared import plain

ROUNDS = 10

_EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
_SECRET = r"""(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key))["']?[ \t]*[=:][ \t]*["']?[A-Za-z0-9_+/-]{16,}"""
_IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)"
_PHONE = r"(?<![\d+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\.?\d)|(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/]|[.-]\d)"
_CARD = r"(?<![\d-])(?:\d{13,19}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"
#: What may be personal data besides cards and telephone numbers, in the order in which alternatives are tried.
PATTERN = "|".join((_EMAIL, _SECRET, _DATE, _IP, _SSN))
#: Every place where a card number may begin, whatever else it may be part of.
CARDS = f"(?=({_CARD}))"

#: Dates of two centuries: their number is 17 * 4297.
FIRST_DAY, LAST_DAY, DAYS = "1900-01-01", "2099-12-31", (17, 4297)


def _digest(key: str, tag: str, *parts: Column) -> Column:
    """The HMAC-SHA-256 of ``tag`` and ``parts`` in hex."""
    own = key.encode() if len(key.encode()) <= 64 else hashlib.sha256(key.encode()).digest()
    inner, outer = (F.lit(bytes(x ^ pad for x in own.ljust(64, b"\0"))) for pad in (0x36, 0x5C))
    said = F.concat_ws("|", F.lit(tag), *[p.cast("string") for p in parts]).cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, said), 256))), 256)


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, tag: str) -> Column:
    """A keyed permutation of the pairs (``a`` < ``size_a``, ``b`` < ``size_b``): struct<a, b>. Each round adds a digest of one half to the other."""
    number = lambda i, x: F.conv(F.substring(_digest(key, tag, i, size_a, size_b, x), 1, 14), 16, 10).cast("long")

    def turn(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(F.pmod(s["a"] + number(i, s["b"]), size_a).alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), F.pmod(s["b"] + number(i, s["a"]), size_b).alias("b"))
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), turn)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def permuted_digits(digits: Column, key: str, tag: str) -> Column:
    """A keyed permutation of the digit strings of each length from 2 to 36."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    end = feistel(F.substring(digits, F.lit(1), left), F.substring(digits, left + 1, n - left), _power(left), _power(n - left), key, tag)
    return _let(end, lambda s: F.concat(F.lpad(s["a"].cast("string"), left, F.lit("0")), F.lpad(s["b"].cast("string"), n - left, F.lit("0"))))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refilled(shown: Column, digits: Column) -> Column:
    """``shown`` with its digits replaced by ``digits``, one by one."""
    one = lambda i: F.when(
        F.substring(shown, i, F.lit(1)).rlike("[0-9]"), F.substring(digits, F.length(_only_digits(F.substring(shown, F.lit(1), i))), F.lit(1))
    ).otherwise(F.substring(shown, i, F.lit(1)))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shown)), one), "")


def luhn_sum(digits: Column, doubled: int) -> Column:
    """The Luhn sum; every second digit from the right counts double, from the last (``doubled`` 0) or the last but one (1)."""
    n = F.length(digits)

    def add(s: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == doubled, 2).otherwise(1)
        return s + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    digits = _only_digits(m)
    n = F.length(digits)
    new = permuted_digits(F.substring(digits, F.lit(1), n - 1), key, "card")
    return _let(new, lambda p: _refilled(m, F.concat(p, F.pmod(10 - luhn_sum(p, 0) % 10, F.lit(10)).cast("string"))))


def _ip(m: Column, key: str) -> Column:
    at = lambda i: F.split_part(m, F.lit("."), F.lit(i)).cast("long")
    size = F.lit(65536)
    end = feistel(at(1) * 256 + at(2), at(3) * 256 + at(4), size, size, key, "ip")
    return _let(end, lambda s: F.concat_ws(".", *[x.cast("string") for h in (s["a"], s["b"]) for x in (F.floor(h / 256), h % 256)]))


def _ssn(m: Column, key: str) -> Column:
    """Area 001 to 899 without 666, group and serial number above zero."""
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(i)).cast("long") for i in (1, 2, 3))
    end = feistel(area - 1 - (area > 666).cast("long"), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn")
    pad = lambda x, n: F.lpad(x.cast("long").cast("string"), n, "0")
    return _let(end, lambda s: F.concat_ws("-", pad(s["a"] + 1 + (s["a"] >= 665).cast("long"), 3), pad(F.floor(s["b"] / 9999) + 1, 2), pad(s["b"] % 9999 + 1, 4)))


def _date_format(m: Column) -> list[tuple[Column, str]]:
    return [(m.rlike("-"), "yyyy-MM-dd"), (m.rlike(r"\."), "dd.MM.yyyy"), (m.rlike("/"), "MM/dd/yyyy")]


def _parsed(m: Column) -> Column:
    out = F.lit(None).cast("date")
    for is_so, form in _date_format(m):
        out = F.when(is_so, F.try_to_date(m, form)).otherwise(out)
    return out


def _date(m: Column, key: str) -> Column:
    day = F.datediff(_parsed(m), F.lit(FIRST_DAY).cast("date"))
    end = feistel(day % DAYS[0], F.floor(day / DAYS[0]), F.lit(DAYS[0]), F.lit(DAYS[1]), key, "date")
    shown = lambda s: F.date_add(F.lit(FIRST_DAY).cast("date"), (s["b"] * DAYS[0] + s["a"]).cast("int"))
    out = lambda d: F.coalesce(*[F.when(is_so, F.date_format(d, form)) for is_so, form in _date_format(m)])
    return _let(end, lambda s: out(shown(s)))


def _phone(m: Column, key: str) -> Column:
    """The country code stays; the other digits are permuted."""
    digits = _only_digits(m)
    code = F.length(F.regexp_extract(m, r"^\+(\d*)", 1))
    return _refilled(m, F.concat(F.substring(digits, F.lit(1), code), permuted_digits(F.substring(digits, code + 1, F.length(digits) - code), key, "phone")))


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(_digest(key, "email", F.lower(m)), 1, 16), F.lit("@example.invalid"))


def _secret(m: Column, key: str) -> Column:
    value = F.regexp_extract(m, r"[A-Za-z0-9_+/-]{16,}$", 0)
    n = F.length(value)
    new = F.array_join(F.transform(F.sequence(F.lit(0), F.floor((n - 1) / 64)), lambda i: _digest(key, "secret", i, value)), "")
    return F.concat(F.substring(m, F.lit(1), F.length(m) - n), F.substring(new, F.lit(1), n))


def kind(m: Column) -> Column:
    """What a match is, or null if its validation fails: octets, areas, the calendar, 7 to 15 digits of a phone number."""
    digits = _only_digits(m)
    whole = lambda p: m.rlike(f"^(?:{p})$")
    octets = F.forall(F.split(m, r"\."), lambda x: x.cast("int") <= 255)
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(i)).cast("int") for i in (1, 2, 3))
    return (
        F.when(m.contains("@"), "email")
        .when(whole(_SECRET), "secret")
        .when(whole(_DATE), F.when(_parsed(m).between(FIRST_DAY, LAST_DAY), "date"))
        .when(whole(_IP), F.when(octets, "ip"))
        .when(whole(_PHONE), F.when(F.length(digits).between(7, 15), "phone"))
        .when(whole(_SSN), F.when(area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), "ssn"))
    )


_MAKE = {"email": _email, "secret": _secret, "date": _date, "ip": _ip, "phone": _phone, "ssn": _ssn}


def _as_it_is(m: Column) -> Column:
    return F.struct(m.alias("text"), F.lit(0).cast("long").alias("n"))


def _by_kind(m: Column, key: str) -> Column:
    """The struct (``text``, ``n``) that stands for a match; one that is not valid stays as it is."""

    def by(k: Column) -> Column:
        out = F.when(k.isNull(), _as_it_is(m))
        for name, make in _MAKE.items():
            out = out.when(k == name, F.struct(make(m, key).alias("text"), F.lit(1).cast("long").alias("n")))
        return out

    return _let(kind(m), by)


def _over(own: Column, pattern: Column, make, rest) -> Column:
    """The struct (``text``, ``n``) of a text whose matches of ``pattern`` give way to ``make`` of them, and the texts between to ``rest`` of them."""
    between, new = F.transform(F.split(own, pattern, -1), rest), F.transform(F.regexp_extract_all(own, pattern, F.lit(0)), make)

    def joined(rows: Column) -> Column:
        return F.struct(F.array_join(F.transform(rows, lambda r: r["text"]), "").alias("text"), F.aggregate(rows, F.lit(0).cast("long"), lambda s, r: s + r["n"]).alias("n"))

    # The texts between the matches are one more than these.
    return _let(F.filter(F.flatten(F.zip_with(between, new, lambda a, b: F.array(a, b))), lambda r: r.isNotNull()), joined)


def _replaced(own: Column, key: str) -> Column:
    """The struct (``text``, ``n``) of a text without cards: telephone numbers are sought last, as they may look like the beginning of anything."""
    phones = lambda t: _over(t, F.lit(_PHONE), lambda m: _by_kind(m, key), _as_it_is)
    return _over(own, F.lit(PATTERN), lambda m: _by_kind(m, key), phones)


def pseudonym(m: Column, key: str) -> Column:
    """What stands for a text that is as a whole a match; anything else stays as it is."""
    return _replaced(m, key)["text"]


def pseudonymised(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``df`` with personal data in its texts replaced, and ``n_pii``, how many were.

    Card numbers come first: every place where one may begin is tried, so none hides behind digits before it. A null text stays null
    and has 0, an empty one stays empty; a text is read whole, whatever its length. Rows are judged one by one, so repeated rows stay
    equal; an empty table gives no rows. A column named ``n_pii``, in any case, gives way.
    """
    plain_df = plain(df)
    at = df.columns.index(text)
    own = F.col(f"c{at}").cast("string")
    cards = F.filter(F.regexp_extract_all(own, F.lit(CARDS), F.lit(1)), lambda m: luhn_sum(_only_digits(m), 1) % 10 == 0)

    def without_cards(valid: Column) -> Column:
        # Card numbers hold digits, blanks and hyphens only: they are patterns of themselves.
        pattern = F.concat(F.lit(r"(?<![\d-])(?:"), F.array_join(F.array_distinct(valid), "|"), F.lit(r")(?!\d)"))
        card = lambda m: F.struct(_card(m, key).alias("text"), F.lit(1).cast("long").alias("n"))
        split = _over(own, pattern, card, lambda t: _replaced(t, key))
        return F.when(F.size(valid) > 0, split).otherwise(_replaced(own, key))

    # Most texts hold no digit that could be part of a match, and no address.
    maybe = own.rlike(r"[0-9@=:]")
    out = F.when(own.isNotNull() & maybe, _let(cards, without_cards)).otherwise(F.struct(own.alias("text"), F.lit(0).cast("long").alias("n")))
    keep = [i for i, c in enumerate(df.columns) if c.lower() != "n_pii" and i != at]
    rows = plain_df.select(*[f"c{i}" for i in keep], out.alias("out"))
    return rows.select(*[f"c{i}" for i in keep], "out.text", "out.n").toDF(*[df.columns[i] for i in keep], text, "n_pii")
