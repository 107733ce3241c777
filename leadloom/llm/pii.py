"""Personal data replaced by format-preserving pseudonyms.

Found: e-mail addresses, card-like numbers, telephone and social security numbers, IPv4 addresses, calendar dates and
long hexadecimal secrets. Numbers are validated: a card-like number must pass the Luhn check, a social security number must
have an area, group and serial that are given out, a date must be one of the calendar; others stay as they are. E-mail
addresses have up to 64 characters before the ``@`` and 253 after it (RFC 5321). A value is permuted within its format by a keyed Feistel network (round function SHA-256 of key,
format, round and the other half), so it keeps length, character classes and punctuation, equal values get equal
pseudonyms in all documents, and different ones stay different, also where only the case of a secret differs. Validity is
kept: a card number passes the Luhn check afterwards, a social security number is one that may be given out, an address has
octets up to 255, a date is a real one from 1900 to 2099.

The patterns are linear in the text, whatever runs it holds: a run of address characters is entered at its first one only,
and nothing repeats a group without a bound.

Everything is a native expression on one row: nothing is joined, shuffled or collected. Null stays null, empty stays empty;
texts without a match are passed on unchanged. Other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.exprs import fresh_name, let

ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", 73049  # to 2099-12-31

# kind -> pattern; an alternation in this order finds the values, and the first whole match names the kind
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[._%+-]*+[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9][A-Za-z0-9.-]{0,249}(?<=[A-Za-z0-9])\.[A-Za-z]{2,63}+",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9a-fA-F]{0,63}[0-9])[0-9a-fA-F]{32,64}(?![0-9A-Za-z])",
    "date": r"(?<![0-9A-Za-z./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}"
            r"|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2})(?![0-9A-Za-z/-])",
    "ip": r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}"
          r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9A-Za-z]|\.[0-9])",
    "phone": r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])"
             r"|(?<![0-9A-Za-z+])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{13,19})(?![0-9A-Za-z])",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())


def _feistel(values: Column, radix: int, key: str, tweak: Column) -> Column:
    """A keyed permutation of an array of numbers below radix; one number alone is shifted."""
    def added(left: Column, right: Column, i: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), tweak, i.cast("string"), F.array_join(right.cast("array<string>"), ","))
        pad = F.sha2(text.cast("binary"), 256)
        return F.transform(left, lambda a, j: (a + F.conv(F.substring(pad, (j % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")) % radix)

    half = F.floor(F.size(values) / 2).cast("int")
    pair = F.struct(F.slice(values, F.lit(1), half).alias("l"), F.slice(values, half + 1, F.size(values)).alias("r"))
    # after an even number of rounds the halves have their lengths again
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), pair, lambda p, i: F.struct(
        p["r"].alias("l"), added(p["l"], p["r"], i).alias("r")), lambda p: F.concat(p["l"], p["r"]))


def _numbers(text: Column, alphabet: str) -> Column:
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.instr(F.lit(alphabet), c) - 1)


def _string(values: Column, alphabet: str) -> Column:
    return F.array_join(F.transform(values, lambda v: F.substring(F.lit(alphabet), v + 1, F.lit(1))), "")


DIGITS, LETTERS, HEX, MIXED_HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "0123456789abcdefABCDEF"
WALKS = 64  # most steps until a permuted number is a valid one; about nine in ten are at the first


def _permuted(text: Column, alphabet: str, key: str, tweak: Column) -> Column:
    return let(_numbers(text, alphabet), lambda v: F.when(F.size(v) > 0, _string(
        _feistel(v, len(alphabet), key, tweak), alphabet)).otherwise(F.lit("")))


def _put_back(text: Column, pattern: str, new: Column) -> Column:
    """The characters of ``text`` that match are replaced by those of ``new`` in order."""
    def step(acc: Column, c: Column) -> Column:
        hit = c.rlike(pattern)
        new_c = F.substring(acc["rest"], acc["at"], F.lit(1))
        new_c = F.when(c.rlike("[A-Z]"), F.upper(new_c)).otherwise(new_c)
        return F.struct(F.concat(acc["out"], F.when(hit, new_c).otherwise(c)).alias("out"), acc["rest"].alias("rest"),
                        (acc["at"] + hit.cast("int")).alias("at"))
    begin = F.struct(F.lit("").alias("out"), new.alias("rest"), F.lit(1).alias("at"))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), begin, step, lambda a: a["out"])


def _shape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "[0-9]", "9"), "[A-Za-z]", "a")


def _letters_and_digits(text: Column, key: str) -> Column:
    """Letters permuted among letters, digits among digits."""
    shape = _shape(text)
    letters = _permuted(F.lower(F.regexp_replace(text, "[^A-Za-z]", "")), LETTERS, key, F.concat(F.lit("a"), shape))
    digits = _permuted(F.regexp_replace(text, "[^0-9]", ""), DIGITS, key, F.concat(F.lit("9"), shape))
    return let(_put_back(text, "[A-Za-z]", letters), lambda t: _put_back(t, "[0-9]", digits))


def _luhn_digit(payload: Column) -> Column:
    """The check digit that makes payload + digit pass."""
    numbers = F.reverse(_numbers(payload, DIGITS))
    total = F.aggregate(F.transform(numbers, lambda d, i: F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d))
                                    .otherwise(d)), F.lit(0), lambda a, x: a + x)
    return (10 - total % 10) % 10


def _email(v: Column, key: str) -> Column:
    lead = F.regexp_extract(v, "^[._%+-]*", 0)
    rest = F.substring(v, F.length(lead) + 1, F.length(v))
    at = F.instr(rest, "@")
    return F.concat(lead, _letters_and_digits(F.substring(rest, F.lit(1), at - 1), key), F.substring(rest, at, F.length(rest)))


def _secret(v: Column, key: str) -> Column:
    def tweak(kind: str) -> Column:
        return F.concat(F.lit(kind), F.length(v).cast("string"))
    small, large = v.rlike("[a-f]"), v.rlike("[A-F]")
    return F.when(small & large, _permuted(v, MIXED_HEX, key, tweak("mixed"))).when(
        large, F.upper(_permuted(F.lower(v), HEX, key, tweak("HEX")))).otherwise(_permuted(v, HEX, key, tweak("hex")))


def _number(v: Column, key: str) -> Column:
    return _put_back(v, "[0-9]", _permuted(F.regexp_replace(v, "[^0-9]", ""), DIGITS, key, _shape(v)))


def _ssn(v: Column, key: str) -> Column:
    def once(digits: Column) -> Column:
        return _permuted(digits, DIGITS, key, F.lit("ssn"))
    invalid = "^(?:000|666|9|...00|.....0000)"
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), once(F.regexp_replace(v, "-", "")),
                         lambda x, _: F.when(x.rlike(invalid), once(x)).otherwise(x))
    return let(walked, lambda d: F.concat_ws("-", F.substring(d, F.lit(1), F.lit(3)), F.substring(d, F.lit(4), F.lit(2)), F.substring(d, F.lit(6), F.lit(4))))


def _phone(v: Column, key: str) -> Column:
    country = F.regexp_extract(v, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    return F.concat(country, _number(F.substring(v, F.length(country) + 1, F.length(v)), key))


def _passes_luhn(v: Column) -> Column:
    return let(F.regexp_replace(v, "[^0-9]", ""), lambda d: _luhn_digit(F.substring(d, F.lit(1), F.length(d) - 1)).cast("string") == F.right(d, F.lit(1)))


def _card(v: Column, key: str) -> Column:
    """All digits but the last are permuted, the last is their check digit."""
    def build(d: Column) -> Column:
        size = F.length(d)
        payload = F.substring(d, F.lit(1), size - 1)
        return let(_permuted(payload, DIGITS, key, F.concat(F.lit("card"), size.cast("string"))), lambda new: F.concat(
            new, _luhn_digit(new).cast("string")))

    return _put_back(v, "[0-9]", let(F.regexp_replace(v, "[^0-9]", ""), build))


def _ip(v: Column, key: str) -> Column:
    octets = F.transform(F.split(v, r"\."), lambda o: o.cast("int"))
    return F.array_join(_feistel(octets, 256, key, F.lit("ip")).cast("array<string>"), ".")


def _date(v: Column, key: str) -> Column:
    forms = (("-", "yyyy-MM-dd"), ("/", "dd/MM/yyyy"), (".", "dd.MM.yyyy"))
    day = F.coalesce(*[F.when(F.instr(v, mark) > 0, F.try_to_timestamp(v, F.lit(form))) for mark, form in forms]).cast("date")

    def walk(n: Column) -> Column:  # a permutation of 0..2^18-1 repeated until it falls among the days
        def once(x: Column) -> Column:
            two = F.array(F.floor(x / 512).cast("int"), (x % 512).cast("int"))
            return let(_feistel(two, 512, key, F.lit("date")), lambda p: p[0] * 512 + p[1])
        return F.aggregate(F.sequence(F.lit(1), F.lit(255)), once(n), lambda x, _: F.when(x < DAYS, x).otherwise(once(x)))

    def write(d: Column) -> Column:
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), d)
        return F.coalesce(*[F.when(F.instr(v, mark) > 0, F.date_format(new, form)) for mark, form in forms])

    return F.when(day.isNull(), v).otherwise(write(let(F.date_diff(day, F.lit(FIRST_DAY).cast("date")), walk)))


MAKERS = {"email": _email, "secret": _secret, "date": _date, "ip": _ip, "phone": _phone, "ssn": _ssn, "card": _card}


def kind_of(value: Column) -> Column:
    """Which kind a found value is; null for a number that is not valid."""
    kinds = F.when(F.contains(value, F.lit("@")), "email")
    for kind, pattern in KINDS.items():
        if kind != "email":
            hit = value.rlike(f"^(?:{pattern})$")
            kinds = kinds.when(hit & _passes_luhn(value) if kind == "card" else hit, kind)
    return kinds


def pseudonym(value: Column, key: str) -> Column:
    def chosen(kind: Column) -> Column:
        out = value
        for name, make in MAKERS.items():
            out = F.when(kind == name, make(value, key)).otherwise(out)
        return out
    return let(kind_of(value), chosen)


def _matches(text: Column) -> Column:
    return F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def _valid(found: Column) -> Column:
    return F.transform(F.filter(found, lambda v: kind_of(v).isNotNull()),
                       lambda v: F.when(F.contains(v, F.lit("@")), F.regexp_replace(v, "^[._%+-]+", "")).otherwise(v))


def found_values(text: Column) -> Column:
    """All values in the order of the text; none for null."""
    return _valid(_matches(text))


def replace_pii(docs: DataFrame, key: str, text: str = "text", values: str | None = None) -> DataFrame:
    """The documents with pseudonyms in ``text``; with ``values``, a column of that name holds what was found.

    All other columns stay, whatever their names; one named as ``values`` says is replaced.
    """
    body, mark = F.col(f"`{text}`"), fresh_name(docs, "found")
    held = docs.withColumn(mark, _matches(body))
    between = F.split(body, PATTERN, -1)

    def joined(found: Column) -> Column:
        new = F.transform(found, lambda v: pseudonym(v, key))
        return F.array_join(F.flatten(F.zip_with(between, new, lambda p, n: F.array(p, F.coalesce(n, F.lit(""))))), "")

    new = F.when(F.size(mark) > 0, joined(F.col(mark))).otherwise(body)
    columns = [new.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns if c != values]
    if values:
        columns.append(F.coalesce(_valid(F.col(mark)), F.array().cast("array<string>")).alias(values))
    return held.select(*columns)
