"""Operator 2, personal data: format-preserving Feistel pseudonyms, with DataFrame functions only.

Card numbers (Luhn), phone numbers, IPv4 addresses, dates (ISO, or day first), social security numbers and e-mail addresses are
found, validated and replaced by keyed permutations within their own format: digits stay digits,
separators stay where they were, a card stays a valid card of its length, an address has octets up to 255, a date
is a day of 1900 to 2099. Equal values get equal pseudonyms in every document, and different ones different ones.

A Feistel network adds a keyed hash of one half to the other half in turn, modulo the number of values
that half can have, so each step can be undone and no value is hit twice. Of an e-mail address the local part is
permuted, letter by letter and digit by digit; a country code stays.

Null texts stay null, empty ones empty, long ones are searched whole; numbers that fail validation stay as they are. Where two
patterns match at one place the first in ``PATTERNS`` is taken. Repeated rows give repeated rows; an empty table gives no rows; extra
columns, whatever their names, are kept, but for one named ``pii_kinds``, which is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, unused

ROUNDS = 10
#: The session setting with the query's key, and the key of the synthetic tables, which hold nothing to protect.
KEY, SYNTHETIC = "spark.tidemark.pseudonyms.key", "synthetic"
#: The days of 1900 to 2099, as a product, for the two halves of a date.
DAYS = (17, 4297)
ISO, DAY_FIRST = "yyyy-MM-dd", "dd.MM.yyyy"
#: A label of a domain that cannot be its last, and one that can. Repeated groups are possessive: others go a stack frame deeper each time.
_POOR, _GOOD = r"(?:\.(?![A-Za-z]{2})[A-Za-z0-9-]++)*+", r"\.(?=[A-Za-z]{2})"
#: Fixed patterns: what may be personal data. An address ends in the last label that begins with two letters, after the letters.
PATTERNS = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:{_POOR}{_GOOD}[A-Za-z0-9-]++(?={_POOR}{_GOOD}))*+{_POOR}\.[A-Za-z]{{2,}}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9-])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])",
    "day": r"(?<![0-9./])[0-9]{2}(?<mark>[./])[0-9]{2}\k<mark>(?:19|20)[0-9]{2}(?![0-9]|[./][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,3}|\([0-9]{3}\)[ ]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?<gap>[ -])[0-9]{4}\k<gap>[0-9]{4}\k<gap>[0-9]{4}|[0-9]{4}(?<space>[ -])[0-9]{6}\k<space>[0-9]{5})(?![0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _kept(value: Column, name: str) -> Column:
    return value.rlike(f"^(?:{PATTERNS[name]})$")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def permuted(a: Column, b: Column, of_a: Column, of_b: Column, key: str, tag: str) -> Column:
    """A struct (a, b): the permutation of a pair of numbers below ``of_a`` and ``of_b``."""
    pair = lambda x, y: F.struct(x.cast("long").alias("a"), y.cast("long").alias("b"))

    def step(acc: Column, i: Column) -> Column:
        h = F.conv(F.substring(F.sha2(F.concat_ws("/", F.lit(f"{key}/{tag}"), i, F.when(i % 2 == 0, acc["b"]).otherwise(acc["a"])), 256), 1, 15), 16, 10).cast("long")
        return F.when(i % 2 == 0, pair(F.pmod(acc["a"] + F.pmod(h, of_a), of_a), acc["b"])).otherwise(pair(acc["a"], F.pmod(acc["b"] + F.pmod(h, of_b), of_b)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), pair(a, b), step)


def _digits(d: Column, key: str, tag: str) -> Column:
    """A string of 2 to 18 digits, permuted among those of its length."""
    n, half = F.length(d), F.floor(F.length(d) / 2).cast("int")
    ten = lambda k: F.round(F.pow(F.lit(10.0), k)).cast("long")
    halves = permuted(F.substring(d, F.lit(1), half).cast("long"), F.substring(d, half + 1, n).cast("long"), ten(half), ten(n - half), key, tag)
    return _let(halves, lambda p: F.concat(F.lpad(p["a"].cast("string"), half, F.lit("0")), F.lpad(p["b"].cast("string"), (n - half).cast("int"), F.lit("0"))))


def _poured(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits, in order, replaced by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def step(acc: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(acc["out"], F.when(digit, F.substring(digits, acc["k"], F.lit(1))).otherwise(c)).alias("out"), (acc["k"] + digit.cast("int")).alias("k"))

    return F.aggregate(F.split(shape, ""), start, step, lambda acc: acc["out"])


def _bare(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(digits: Column, first_doubled: int) -> Column:
    """The Luhn sum with every second digit from the right doubled, from place ``first_doubled`` (0 or 1) on."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: _let(c.cast("int") * F.when(i % 2 == first_doubled, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(each, F.lit(0), lambda acc, x: acc + x)


def valid_card(value: Column) -> Column:
    return _luhn_sum(_bare(value), 1) % 10 == 0


def _card(value: Column, key: str) -> Column:
    body = _let(F.substring(_bare(value), F.lit(1), F.length(_bare(value)) - 1), lambda d: _digits(d, key, "card"))
    return _let(body, lambda d: _poured(value, F.concat(d, F.pmod(F.lit(10) - _luhn_sum(d, 0) % 10, F.lit(10)).cast("string"))))


def _phone(value: Column, key: str) -> Column:
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    return F.concat(code, _let(_digits(_bare(rest), key, "phone"), lambda d: _poured(rest, d)))


def valid_ip(value: Column) -> Column:
    """Octets up to 255 without leading zeros: those would be other ways to write an address."""
    return F.forall(F.split(value, r"\."), lambda x: (x.cast("int") <= 255) & ~x.rlike("^0[0-9]"))


def _ip(value: Column, key: str) -> Column:
    octet = lambda i: F.split_part(value, F.lit("."), F.lit(i)).cast("long")
    whole = permuted(octet(1) * 256 + octet(2), octet(3) * 256 + octet(4), F.lit(1 << 16), F.lit(1 << 16), key, "ip")
    return _let(whole, lambda p: F.concat_ws(".", F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256))


def _day(value: Column, form: str) -> Column:
    return F.try_to_timestamp(F.translate(value, "/", "."), F.lit(form)).cast("date")


def _date(value: Column, key: str, form: str) -> Column:
    first = F.lit("1900-01-01").cast("date")
    day = F.datediff(_day(value, form), first)
    moved = permuted(F.floor(day / DAYS[1]), day % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), key, "date")
    return _let(moved, lambda p: F.date_format(F.date_add(first, (p["a"] * DAYS[1] + p["b"]).cast("int")), form))


def _shifted(part: Column, by: Column) -> Column:
    """Letters and digits of ``part`` moved within their own alphabet by the hex digits of ``by``."""

    def one(c: Column, i: Column) -> Column:
        h = F.conv(F.substring(by, F.pmod(i, F.lit(30)) * 2 + 1, F.lit(4)), 16, 10).cast("int")
        turn = lambda first, n: F.char(F.pmod(F.ascii(c) - first + h, F.lit(n)) + first)
        return F.when(c.rlike("^[a-z]$"), turn(97, 26)).when(c.rlike("^[A-Z]$"), turn(65, 26)).when(c.rlike("^[0-9]$"), turn(48, 10)).otherwise(c)

    return F.array_join(F.transform(F.split(part, ""), one), "")


def _email(value: Column, key: str) -> Column:
    local = F.substring_index(value, "@", 1)
    half = F.floor(F.length(local) / 2).cast("int")
    pair = lambda x, y: F.struct(x.alias("a"), y.alias("b"))

    def step(acc: Column, i: Column) -> Column:
        by = F.sha2(F.concat_ws("/", F.lit(f"{key}/email"), i, F.when(i % 2 == 0, acc["b"]).otherwise(acc["a"])), 256)
        return F.when(i % 2 == 0, pair(_shifted(acc["a"], by), acc["b"])).otherwise(pair(acc["a"], _shifted(acc["b"], by)))

    halves = F.aggregate(F.sequence(F.lit(0), F.lit(5)), pair(F.substring(local, F.lit(1), half), F.substring(local, half + 1, F.length(local))), step)
    return _let(halves, lambda p: F.concat(p["a"], p["b"], F.substring(value, F.length(local) + 1, F.length(value))))


def kind_of(value: Column) -> Column:
    """What a match of ``ANY`` is, once validated, or null."""
    return (
        F.when(F.contains(value, F.lit("@")), F.lit("email"))
        .when(_kept(value, "ip"), F.when(valid_ip(value), F.lit("ip")))
        .when(_kept(value, "date"), F.when(_day(value, ISO).isNotNull(), F.lit("date")))
        .when(_kept(value, "day"), F.when(_day(value, DAY_FIRST).isNotNull(), F.lit("day")))
        .when(_kept(value, "ssn"), F.lit("ssn"))
        .when(_kept(value, "card") & valid_card(value), F.lit("card"))
        .when(_kept(value, "phone"), F.lit("phone"))
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    made = {"email": _email, "ip": _ip, "card": _card, "phone": _phone}
    out = F.when(kind == "ssn", _let(_digits(_bare(value), key, "ssn"), lambda d: _poured(value, d)))
    out = out.when(kind == "date", _date(value, key, ISO)).when(kind == "day", F.replace(_date(value, key, DAY_FIRST), F.lit("."), F.substring(value, 3, 1)))
    for name, f in made.items():
        out = out.when(kind == name, f(value, key))
    return out.otherwise(value)


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and ``pii_kinds``, the kinds replaced, in order (an old column of that name goes).

    Who has ``key`` can undo the permutation, so it is a secret and has no default.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    was, will = unused(docs, "pii_found"), unused(docs, "pii_new")
    may = F.col(text).rlike("[0-9@]")
    found = F.when(may, F.transform(F.regexp_extract_all(text, F.lit(ANY), 0), lambda m: F.struct(m.alias("value"), kind_of(m).alias("kind"))))
    rows = docs.withColumn(was, found)
    new = F.transform(was, lambda m: pseudonym(m["value"], m["kind"], key))
    rows = rows.withColumn(will, new)
    pieces = F.transform(F.split(text, ANY), lambda p, i: F.concat(p, F.coalesce(F.get(F.col(will), i), F.lit(""))))
    kinds = F.coalesce(F.filter(F.transform(was, lambda m: m["kind"]), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    rows = rows.withColumns({text: F.when(F.size(was) > 0, F.array_join(pieces, "")).otherwise(F.col(text)), "pii_kinds": kinds})
    return rows.drop(was, will)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms, and how many of each kind were put in."""
    rows = pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), spark.conf.get(KEY, SYNTHETIC))
    n = lambda kind: F.size(F.filter("pii_kinds", lambda k: k == kind)).cast("long")
    return rows.select("doc_id", "text", *[n(k).alias(f"n_{k}") for k in PATTERNS])
