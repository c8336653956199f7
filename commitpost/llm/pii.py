"""Format-preserving pseudonyms of personal data, in DataFrame functions alone.

One pattern finds the candidates of a text, a rule of each kind validates them (check digits, octets, calendar), and a
keyed Feistel network permutes what is valid within its format: a card number becomes another one with a right check
digit, a date another date. The network is a permutation, so different values stay different, and equal values get
equal pseudonyms in all documents, without any table. Dates are one value whatever their notation. Whoever has the key
can invert the network; choose it per corpus and keep it secret.

Kinds: e-mail addresses (all but the last label; letters keep their case), phone numbers (+1 keeps the country code,
others two digits), payment cards (13 to 19 digits with a right check digit), IPv4 addresses, social security numbers,
IBANs (also in groups of four), dates from 1700 to 2099 (2024-02-29, 29.02.2024, 02/29/2024, or else 29/02/2024), and keys of 32 to 128 hex digits. What fails its
rule stays as it is.

Cases: null text stays null, empty text empty; repeated rows are treated alike; all other columns are kept, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 10
KEY = "set a key of your own"

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
PHONE_1 = r"(?<![0-9+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
PHONE = r"(?<![0-9+])\+[2-9][0-9]{0,2}(?:[ .-][0-9](?![0-9]))?(?:[ .-]?(?:\([0-9]{1,4}\)|[0-9]{2,5})){2,5}(?![0-9])"
PHONE_00 = r"(?<![0-9+])00[1-9][0-9]{0,2}(?:[ .-][0-9](?![0-9]))?(?:[ .-](?:\([0-9]{1,4}\)|[0-9]{2,5})){2,5}(?![0-9])"
NATIONAL = r"(?<![0-9+.-])(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"
GROUPED_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?(?![A-Za-z0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?![0-9-])"
DATE = r"(?<![0-9./])(?:[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![0-9])"
HEX_KEY = r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])"
# The long ones first: at one place the first alternative that fits is taken.
PATTERN = "|".join([EMAIL, IBAN, GROUPED_IBAN, HEX_KEY, PHONE_1, PHONE, PHONE_00, NATIONAL, CARD, IP, SSN, ISO_DATE, DATE])

FIRST_DAY, DAYS, DAY_ROWS = "1700-01-01", 146_097, 189  # 400 years of the calendar are 189 * 773 days


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _all(pattern: str) -> str:
    return "^(?:" + pattern + ")$"


def _noise(key: str, tweak: str, turn: Column, value: Column, bits: int = 256) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), turn.cast("string"), value.cast("string")), bits)


def permuted(left: Column, right: Column, left_size: Column, right_size: Column, key: str, tweak: str) -> Column:
    """A keyed permutation of the pairs (l, r) with l < left_size and r < right_size."""

    def amount(turn: Column, value: Column) -> Column:
        return F.conv(F.substring(_noise(key, tweak, turn, value), 1, 14), 16, 10).cast("bigint")

    def step(pair: Column, turn: Column) -> Column:
        l, r = pair["l"], pair["r"]
        return F.when(
            turn % 2 == 0, F.struct(F.pmod(l + amount(turn, r), left_size).alias("l"), r.alias("r"))
        ).otherwise(F.struct(l.alias("l"), F.pmod(r + amount(turn, l), right_size).alias("r")))

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def permuted_digits(digits: Column, key: str, tweak: str) -> Column:
    """Another string of as many digits (2 to 36)."""
    half = F.floor(F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    power = lambda n: F.pow(F.lit(10.0), n).cast("bigint")
    pair = permuted(
        F.substr(digits, F.lit(1), half).cast("bigint"), F.substr(digits, half + 1, rest).cast("bigint"),
        power(half), power(rest), key, tweak,
    )
    return let(pair, lambda p: F.concat(F.lpad(p["l"].cast("string"), half, "0"), F.lpad(p["r"].cast("string"), rest, "0")))


def permuted_text(text: Column, key: str, tweak: str, letters: int = 26) -> Column:
    """Another string in which digits stay digits and letters letters of their case (the first ``letters`` of the
    alphabet); the rest is unchanged. The case has no part in the noise."""

    def shifted(part: Column, noise: Column) -> Column:
        def one(c: Column, at: Column) -> Column:
            amount = F.conv(F.substr(noise, F.pmod(at, F.lit(42)) * 3 + 1, F.lit(3)), 16, 10).cast("int")
            code = F.ascii(c)
            turn = lambda first, size: F.char(F.lit(first) + F.pmod(code - first + amount, F.lit(size)))
            return (
                F.when(code.between(48, 57), turn(48, 10))
                .when(code.between(97, 96 + letters), turn(97, letters))
                .when(code.between(65, 64 + letters), turn(65, letters))
                .otherwise(c)
            )

        characters = F.when(F.length(part) > 0, F.split(part, "")).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.transform(characters, one), "")

    def step(pair: Column, turn: Column) -> Column:
        l, r = pair["l"], pair["r"]
        return F.when(
            turn % 2 == 0, F.struct(let(_noise(key, tweak, turn, F.lower(r), 512), lambda n: shifted(l, n)).alias("l"), r.alias("r"))
        ).otherwise(F.struct(l.alias("l"), let(_noise(key, tweak, turn, F.lower(l), 512), lambda n: shifted(r, n)).alias("r")))

    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1, F.length(text)).alias("r"))
    pair = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return let(pair, lambda p: F.concat(p["l"], p["r"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in turn."""

    def one(at: Column) -> Column:
        c = F.substr(shape, at, F.lit(1))
        nth = F.length(_digits(F.substr(shape, F.lit(1), at)))
        return F.when(c.rlike("[0-9]"), F.substr(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), one), "")


def luhn(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled (9 less if over 9)."""

    def add(total: Column, at: Column) -> Column:
        d = F.substr(F.reverse(digits), at, F.lit(1)).cast("int")
        return total + F.when(at % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def iban_remainder(iban: Column) -> Column:
    """The account, then country and check digits, as one number (A is 10), modulo 97."""

    def add(total: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code <= 57, total * 10 + code - 48).otherwise(total * 100 + code - 55) % 97

    moved = F.concat(F.substr(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    return F.aggregate(F.split(moved, ""), F.lit(0), add)


def _email(v: Column, key: str) -> Column:
    last = F.regexp_extract(v, r"\.[^.]*$", 0)
    return F.concat(permuted_text(F.substr(v, F.lit(1), F.length(v) - F.length(last)), key, "email"), last)


def _phone(v: Column, key: str, kind: int, fixed: int) -> Column:
    """``kind``: the digits of the country code that stay; ``fixed``: the digits before the permuted ones as written."""
    kept = lambda d: F.concat(F.substring(d, 1, fixed), permuted_digits(F.substr(d, F.lit(fixed + 1), F.length(d)), key, f"phone{kind}"))
    return let(let(_digits(v), kept), lambda d: _refill(v, d))


def _card(v: Column, key: str) -> Column:
    def another(digits: Column) -> Column:
        payload = permuted_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
        return let(payload, lambda p: F.concat(p, ((10 - luhn(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")))

    return let(_digits(v), lambda d: F.when(luhn(d) % 10 == 0, let(another(d), lambda n: _refill(v, n))).otherwise(v))


def _ip(v: Column, key: str) -> Column:
    def another(o: Column) -> Column:
        pair = permuted(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip")
        return let(pair, lambda p: F.concat_ws(".", *(
            F.floor(p[side] / 256).cast("string") if high else (p[side] % 256).cast("string") for side in "lr" for high in (True, False)
        )))

    octets = F.split(v, r"\.").cast("array<int>")
    return let(octets, lambda o: F.when(F.array_max(o) <= 255, another(o)).otherwise(v))


def _ssn(v: Column, key: str) -> Column:
    def another(p: Column) -> Column:
        area = p[0] - 1 - F.when(p[0] > 666, 1).otherwise(0)
        pair = permuted(area, (p[1] - 1) * 9999 + p[2] - 1, F.lit(898), F.lit(99 * 9999), key, "ssn")
        return let(pair, lambda n: F.format_string(
            "%03d-%02d-%04d", n["l"] + 1 + F.when(n["l"] >= 665, 1).otherwise(0),
            F.floor(n["r"] / 9999) + 1, n["r"] % 9999 + 1,
        ))

    parts = F.split(v, "-").cast("array<int>")
    valid = lambda p: p[0].between(1, 899) & (p[0] != 666) & (p[1] > 0) & (p[2] > 0)
    return let(parts, lambda p: F.when(valid(p), another(p)).otherwise(v))


def _iban(v: Column, key: str) -> Column:
    def another(account: Column) -> Column:
        country = F.substring(v, 1, 2)
        check = 98 - iban_remainder(F.concat(country, F.lit("00"), account))
        return F.concat(country, F.lpad(check.cast("string"), 2, "0"), account)

    account = permuted_text(F.substr(v, F.lit(5), F.length(v)), key, "iban")
    return F.when(iban_remainder(v) == 1, let(account, another)).otherwise(v)


def _date(v: Column, key: str, notation: str) -> Column:
    def another(index: Column) -> Column:
        per_row = DAYS // DAY_ROWS
        pair = permuted(F.floor(index / per_row), index % per_row, F.lit(DAY_ROWS), F.lit(per_row), key, "date")
        moved = let(pair, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * per_row + p["r"]).cast("int")))
        return F.date_format(moved, notation)

    year, month, day = {"yyyy-MM-dd": (0, 1, 2), "dd.MM.yyyy": (2, 1, 0), "MM/dd/yyyy": (2, 0, 1), "dd/MM/yyyy": (2, 1, 0)}[notation]
    parts = F.split(v, "[./-]")
    iso = F.concat_ws("-", parts[year], F.lpad(parts[month], 2, "0"), F.lpad(parts[day], 2, "0"))
    index = F.datediff(iso.try_cast("date"), F.lit(FIRST_DAY).cast("date"))
    return let(index, lambda i: F.when(i.between(0, DAYS - 1), another(i)).otherwise(_date(v, key, "dd/MM/yyyy") if notation == "MM/dd/yyyy" else v))


def _hex_key(v: Column, key: str) -> Column:
    return F.when(v.rlike("[0-9]") & v.rlike("[A-Fa-f]"), permuted_text(v, key, "hex", 6)).otherwise(v)


def pseudonym(value: Column, key: str = KEY) -> Column:
    """The pseudonym of one match of PATTERN; the match itself if it fails its kind's rule."""
    n = F.length(_digits(value))
    return (
        F.when(value.contains("@"), _email(value, key))
        .when(value.rlike(_all("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")), _iban(value, key))
        .when(value.rlike("^[A-Z]{2}[0-9]{2} "), F.regexp_replace(_iban(F.regexp_replace(value, " ", ""), key), "(.{4})(?!$)", "$1 "))
        .when(value.rlike(r"^\+1[^0-9]*[0-9]{3}[^0-9]*[0-9]{3}[^0-9]*[0-9]{4}$"), _phone(value, key, 1, 1))
        .when(value.startswith("+"), F.when(n.between(8, 15), _phone(value, key, 2, 2)).otherwise(value))
        .when(value.rlike(_all(NATIONAL)), _phone(value, key, 1, 0))
        .when(value.rlike(_all(PHONE_00)), F.when(n.between(10, 17), F.when(value.rlike("^001"), _phone(value, key, 1, 3)).otherwise(_phone(value, key, 2, 4))).otherwise(value))
        .when(value.rlike(_all("[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}")), _card(value, key))
        .when(value.rlike(_all("[0-9A-Fa-f]{32,128}")), _hex_key(value, key))
        .when(value.rlike(_all(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")), _ip(value, key))
        .when(value.rlike(_all("[0-9]{3}-[0-9]{2}-[0-9]{4}")), _ssn(value, key))
        .when(value.rlike(_all("[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}")), _date(value, key, "yyyy-MM-dd"))
        .when(value.contains("/"), _date(value, key, "MM/dd/yyyy"))
        .otherwise(_date(value, key, "dd.MM.yyyy"))
    )


def _treated(text: Column, key: str) -> Column:
    """struct(text, n): the text with pseudonyms, and how many of its values were replaced."""

    def with_pseudonyms(found: Column) -> Column:
        changed = F.transform(found, lambda v: pseudonym(v, key))
        between = F.split(text, PATTERN, -1)

        def joined(new: Column) -> Column:
            pairs = F.zip_with(between, F.concat(new, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
            n = F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x))
            return F.struct(F.array_join(pairs, "").alias("text"), n.cast("bigint").alias("n"))

        plain = F.struct(text.alias("text"), F.lit(0).cast("bigint").alias("n"))
        return F.when(F.size(found) > 0, let(changed, joined)).otherwise(plain)

    untouched = F.struct(text.alias("text"), F.lit(0).cast("bigint").alias("n"))
    candidates = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    return F.when(text.rlike("[0-9]|@"), let(candidates, with_pseudonyms)).otherwise(untouched)


def pseudonymise(documents: DataFrame, key: str = KEY) -> DataFrame:
    """``documents`` with pseudonyms in ``text``."""
    return documents.withColumn("text", _treated(F.col("text"), key)["text"])


def report(documents: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, the treated text, and how many values were replaced."""
    treated = documents.select("doc_id", _treated(F.col("text"), key).alias("treated"))
    return treated.select("doc_id", F.col("treated.text").alias("text"), F.col("treated.n").alias("n_replaced"))
