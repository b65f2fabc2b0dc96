"""Format-preserving pseudonyms by a keyed Feistel network, in built-in functions only.

Found and validated: e-mail addresses, payment cards (Luhn), IBANs (mod 97), social
security numbers, telephone numbers (international, and as written in North America, France, Spain,
Germany and Britain; ten bare digits count as one), IPv4 addresses and calendar dates. Each value is
moved by a keyed permutation of its own format, so equal values get equal pseudonyms in
every document, different values different ones, and the result is valid again: a card
keeps its length and separators and passes Luhn, a date stays in its century.

Numbers are taken apart as ``left * b + right`` on a grid of a by b cells, and each round
adds a keyed digest of one half to the other, modulo its side. Names in addresses and
account codes are moved character by character within their class, half against half.
Cases: null texts stay null, empty texts empty; texts without a find are returned as they
are; a value that fails its validation stays; repeated rows and repeated values give the
same result; other columns stay, a column of the result's name is replaced; work is
linear in the text, as no pattern can start twice in one run of characters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Set a secret of your own; the same key gives the same pseudonyms.
KEY = "tremorlake-pseudonyms"
ROUNDS = 8

_FREE = r"(?<![\p{L}\p{N}_])"
_DONE = r"(?![\p{L}\p{N}_])"
_NAME = r"\p{L}\p{N}._%+\-"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

# Characters of an account code by country, check digits included.
_IBANS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_forms() -> str:
    """Each country with its length, so a find never takes what follows it; others by the general form."""
    forms = []
    for length, countries in _IBANS.items():
        groups, rest = divmod(length - 4, 4)
        spaced = rf"(?: [A-Z0-9]{{4}}){{{groups}}}" + (rf" [A-Z0-9]{{{rest}}}" if rest else "")
        forms.append(rf"(?:{countries.replace(' ', '|')})\d{{2}}(?:[A-Z0-9]{{{length - 4}}}|{spaced})")
    known = "|".join(" ".join(_IBANS.values()).split())
    forms.append(rf"(?!{known})[A-Z]{{2}}\d{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?)")
    return "|".join(forms)


# Between digits of a telephone number: a space of any kind, dot, hyphen or slash.
_SEP = r"[ .\-/\u00A0\u202F\u2011]"
_NEXT = rf"(?:{_SEP}?\d)"
_CODE = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|(?:2[1-689]|3[578]|42|5[09]|6[7-9]|8[035789]|9[679])\d)"
# After the country code, by its plan if its numbers have one length. A trunk zero may stand in brackets.
_AREA = rf"{_SEP}?(?:\(0\){_SEP}?)?(?:\(\d{{2,5}}\))?"
_ABROAD = "|".join(
    (
        rf"1{_SEP}?(?:\(\d{{3}}\){_SEP}?\d{{3}}|\d{{3}}{_SEP}?\d{{3}}){_SEP}?\d{{4}}",
        rf"3[34]{_SEP}?(?:\(0\){_SEP}?)?\d{_NEXT}{{8}}",
        rf"44{_SEP}?(?:\(0\){_SEP}?)?(?:\(\d{{2,5}}\){_NEXT}{{5,8}}|\d{_NEXT}{{8,9}})",
        rf"(?!1|3[34]|44){_CODE}{_AREA}{_NEXT}{{4,12}}",
    )
)
_PHONES = "|".join(
    (
        rf"(?:\+|00{_SEP}?)(?:{_ABROAD})",
        # As written in North America, with any country code before it.
        rf"(?:\+\d{{1,3}}{_SEP}?|1{_SEP})?(?:\(\d{{3}}\) ?|\d{{3}}{_SEP})\d{{3}}{_SEP}\d{{4}}",
        # France by pairs, Spain by pairs or threes.
        rf"0[1-9](?:{_SEP}?\d{{2}}){{4}}",
        rf"[6-9]\d{{2}}(?:(?:{_SEP}\d{{3}}){{2}}|(?:{_SEP}\d{{2}}){{3}})",
        # Germany and Britain: an area code with its zero, then the number.
        rf"(?:\(0[1-9]\d{{1,4}}\){_SEP}?|0[1-9]\d{{1,4}}{_SEP})\d{{3,4}}{_SEP}?\d{{3,4}}",
        # Bare: ten digits, eleven with a zero before them.
        r"[2-9]\d{9}|0[1-9]\d{9}",
    )
)

# A find is of the first kind whose whole pattern it meets.
PATTERNS = {
    "email": rf"(?<![{_NAME}])[{_NAME}]++@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]*+)\.)++[A-Za-z]{{2,}}+",
    "iban": rf"{_FREE}(?:{_iban_forms()}){_DONE}",
    "date": rf"{_FREE}(?:\d{{4}}-\d{{2}}-\d{{2}}|\d{{2}}[./]\d{{2}}[./]\d{{4}}){_DONE}",
    "ipv4": rf"(?<![\p{{L}}\p{{N}}_.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\p{{N}}_]|\.\d)",
    "ssn": rf"{_FREE}\d{{3}}-\d{{2}}-\d{{4}}{_DONE}",
    "phone": rf"(?<![\p{{L}}\p{{N}}_+])(?:{_PHONES}){_DONE}",
    "card": rf"{_FREE}(?:\d{{13,19}}|\d{{4}}(?:[ \-]\d{{4}}){{3}}|\d{{4}}[ \-]\d{{6}}[ \-]\d{{5}}){_DONE}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named there."""
    return F.transform(F.array(value), use)[0]


def _keyed(modulus: Column | int, *parts: Column) -> Column:
    """A keyed digest of the parts, below the modulus."""
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    modulus = F.lit(modulus) if isinstance(modulus, int) else modulus
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % modulus


def on_grid(value: Column, a: Column | int, b: Column | int, kind: str, key: str) -> Column:
    """A keyed permutation of 0 .. a * b - 1."""
    a, b = (F.lit(x).cast("bigint") if isinstance(x, int) else x.cast("bigint") for x in (a, b))

    def step(s: Column, n: Column) -> Column:
        tag = F.concat(F.lit(f"{key}|{kind}|"), n.cast("string"))
        left = F.when(n % 2 == 1, (s["l"] + _keyed(a, tag, s["r"].cast("string"))) % a).otherwise(s["l"])
        right = F.when(n % 2 == 0, (s["r"] + _keyed(b, tag, s["l"].cast("string"))) % b).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    def run(v: Column) -> Column:
        start = F.struct(F.floor(v / b).cast("bigint").alias("l"), (v % b).alias("r"))
        rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
        return F.aggregate(rounds, start, step, lambda s: s["l"] * b + s["r"])

    return bind(value, run)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def digits_permuted(digits: Column, kind: str, key: str) -> Column:
    """A string of at most 18 digits, permuted among the strings of its length."""
    sides = lambda n: F.pow(F.lit(10), n).cast("bigint")
    half = F.floor(F.length(digits) / 2)
    moved = on_grid(digits.cast("bigint"), sides(F.length(digits) - half), sides(half), kind, key)
    return F.lpad(moved.cast("string"), F.length(digits), "0")


def _filled(pattern: Column, digits: Column) -> Column:
    """The pattern with its digits replaced one by one."""
    chars = F.split(pattern, "")
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("n"))

    def step(acc: Column, c: Column) -> Column:
        digit = c.rlike(r"^\d$")
        put = F.when(digit, F.substring(digits, acc["n"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(acc["s"], put).alias("s"), (acc["n"] + digit.cast("int")).alias("n"))

    return F.aggregate(chars, start, step, lambda acc: acc["s"])


def _luhn_sum(digits: Column) -> Column:
    """Sum of a number's digits as Luhn counts them, from the right."""

    def value(c: Column, n: Column) -> Column:
        d = c.cast("int")
        return F.when(n % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, d: a + d)


def is_card(text: Column) -> Column:
    return _luhn_sum(_digits(text)) % 10 == 0


def card(text: Column, key: str) -> Column:
    def run(digits: Column) -> Column:
        body = digits_permuted(F.substring(digits, F.lit(1), F.length(digits) - 1), "card", key)
        return bind(body, lambda x: F.concat(x, ((10 - _luhn_sum(F.concat(x, F.lit("0"))) % 10) % 10).cast("string")))

    return _filled(text, bind(_digits(text), run))


def is_phone(text: Column) -> Column:
    """Seven to fifteen digits, the country code included and a bracketed trunk zero and 00 left out."""
    return F.length(_digits(F.regexp_replace(text, r"^00|\(0\)", ""))).between(7, 15)


def phone(text: Column, key: str) -> Column:
    """All digits are permuted, but for the country code and a leading or bracketed zero."""

    def run(digits: Column) -> Column:
        abroad = text.startswith("+") | text.startswith("00")
        code = F.length(_digits(F.regexp_extract(text, rf"^(?:\+|00{_SEP}?){_CODE}(?:{_SEP}?\(0\))?", 0)))
        # Three, three and four digits are one format, whatever they begin with; the others keep their first digit.
        threes = text.rlike(rf"^(?:\(\d{{3}}\) ?|\d{{3}}{_SEP})\d{{3}}{_SEP}\d{{4}}$")
        head = F.when(threes, 0).when(abroad & (code > 0), code).when(abroad, F.length(digits) - 10).otherwise(1)
        return bind(head, lambda n: F.concat(F.substring(digits, F.lit(1), n), digits_permuted(F.substring(digits, n + 1, F.length(digits)), "phone", key)))

    return _filled(text, bind(_digits(text), run))


def ipv4(text: Column, key: str) -> Column:
    octet = lambda n: F.split_part(text, F.lit("."), F.lit(n)).cast("bigint")
    value = ((octet(1) * 256 + octet(2)) * 256 + octet(3)) * 256 + octet(4)
    moved = on_grid(value, 1 << 16, 1 << 16, "ipv4", key)
    parts = lambda v: F.concat_ws(".", *[(F.shiftright(v, n) % 256).cast("string") for n in (24, 16, 8, 0)])
    return bind(moved, parts)


# Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999.
_AREAS, _GROUPS, _SERIALS = 898, 99, 9999


def _ssn_parts(text: Column) -> tuple[Column, Column, Column]:
    return tuple(F.substring(text, *span).cast("bigint") for span in ((1, 3), (5, 2), (8, 4)))


def is_ssn(text: Column) -> Column:
    area, group, serial = _ssn_parts(text)
    return area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)


def ssn(text: Column, key: str) -> Column:
    area, group, serial = _ssn_parts(text)
    place = area - F.when(area > 666, 2).otherwise(1)
    value = (place * _GROUPS + group - 1) * _SERIALS + serial - 1

    def spell(v: Column) -> Column:
        at = F.floor(v / (_GROUPS * _SERIALS)).cast("bigint")
        area = at + F.when(at >= 665, 2).otherwise(1)
        group, serial = F.floor(v / _SERIALS).cast("bigint") % _GROUPS + 1, v % _SERIALS + 1
        return F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad(group.cast("string"), 2, "0"), F.lpad(serial.cast("string"), 4, "0"))

    return bind(on_grid(value, _AREAS * _GROUPS, _SERIALS, "ssn", key), spell)


def _as_date(text: Column) -> Column:
    """Null if there is no such day. A slash has the month first unless that can't be."""
    digits = lambda a, n: F.substring(text, a, n).cast("int")
    iso, slash = text.rlike(r"^\d{4}-"), text.contains("/")
    month_first = slash & (digits(1, 2) <= 12)
    year = F.when(iso, digits(1, 4)).otherwise(digits(7, 4))
    month = F.when(iso, digits(6, 2)).when(month_first, digits(1, 2)).otherwise(digits(4, 2))
    day = F.when(iso, digits(9, 2)).when(month_first, digits(4, 2)).otherwise(digits(1, 2))
    spelled = F.format_string("%04d-%02d-%02d", year, month, day)
    return F.try_to_timestamp(spelled, F.lit("yyyy-MM-dd")).cast("date")


def is_date(text: Column) -> Column:
    return _as_date(text).isNotNull() & ~text.contains("0000")


def date(text: Column, key: str) -> Column:
    """Moved among the days of its century: 36,524 = 92 * 397 or 36,525 = 75 * 487 of them.

    A slashed date moves with its own order of day and month kept apart: the first or
    second kind is a format of its own, and a result that would read otherwise is
    written with its day first.
    """

    def run(d: Column) -> Column:
        century = F.floor(F.year(d) / 100).cast("int")
        first = F.make_date(century * 100, F.lit(1), F.lit(1))
        long = F.datediff(F.make_date(century * 100 + 100, F.lit(1), F.lit(1)), first) == 36525
        a, b = F.when(long, F.lit(75)).otherwise(F.lit(92)), F.when(long, F.lit(487)).otherwise(F.lit(397))
        moved = F.date_add(first, on_grid(F.datediff(d, first).cast("bigint"), a, b, "date", key).cast("int"))
        iso, slash = text.rlike(r"^\d{4}-"), text.contains("/")
        month_first = slash & (F.substring(text, 1, 2).cast("int") <= 12)
        return (
            F.when(iso, F.date_format(moved, "yyyy-MM-dd"))
            .when(month_first, F.date_format(moved, "MM/dd/yyyy"))
            .when(slash & (F.dayofmonth(moved) > 12), F.date_format(moved, "dd/MM/yyyy"))
            .when(slash, F.date_format(moved, "MM/dd/yyyy"))
            .otherwise(F.date_format(moved, "dd.MM.yyyy"))
        )

    return bind(_as_date(text), run)


# Classes of characters that stay among themselves; all others keep their place.
_CLASSES = (("0", 10), ("a", 26), ("A", 26), ("à", 23), ("À", 23))


def _moved_char(c: Column, by: Column) -> Column:
    code, moved = F.ascii(c), c
    for start, size in _CLASSES:
        low = ord(start)
        shifted = F.lit(low) + (code - low + by) % size
        # chr() is for single bytes; the two Latin-1 ranges are looked up by place.
        spelled = F.chr(shifted) if low < 128 else F.substring(F.lit("".join(map(chr, range(low, low + size)))), shifted - low + 1, F.lit(1))
        moved = F.when(code.between(low, low + size - 1), spelled).otherwise(moved)
    return moved


def chars_permuted(text: Column, kind: str, key: str) -> Column:
    """Characters moved within their classes: each half by a keyed digest of the other half."""

    def half(moving: Column, other: Column, tag: Column) -> Column:
        digest = lambda block: F.sha2(F.concat_ws("|", tag, block.cast("string"), other), 512)
        blocks = F.sequence(F.lit(0), F.floor(F.length(moving) / 32).cast("int"))
        stream = F.aggregate(blocks, F.lit(""), lambda s, n: F.concat(s, digest(n)))

        def shift(s: Column) -> Column:
            by = lambda n: F.conv(F.substring(s, n * 4 + 1, F.lit(4)), 16, 10).cast("int")
            return F.array_join(F.transform(F.split(moving, ""), lambda c, n: _moved_char(c, by(n))), "")

        return F.when(moving == "", moving).otherwise(bind(stream, shift))

    def step(s: Column, n: Column) -> Column:
        tag = F.concat(F.lit(f"{key}|{kind}|"), n.cast("string"))
        left = F.when(n % 2 == 1, half(s["l"], s["r"], tag)).otherwise(s["l"])
        right = F.when(n % 2 == 0, half(s["r"], s["l"], tag)).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    def run(t: Column) -> Column:
        cut = F.ceil(F.length(t) / 2).cast("int")
        start = F.struct(F.substring(t, F.lit(1), cut).alias("l"), F.substring(t, cut + 1, F.length(t)).alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["l"], s["r"]))

    return bind(text, run)


def email(text: Column, key: str) -> Column:
    """The name is moved, the domain stays."""
    at = F.instr(text, "@")
    return F.concat(chars_permuted(F.substring(text, F.lit(1), at - 1), "email", key), F.substring(text, at, F.length(text)))


def _mod97(text: Column) -> Column:
    """Remainder of an account code, letters counted as 10 to 35."""

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def is_iban(text: Column) -> Column:
    bare = F.replace(text, F.lit(" "))
    return _mod97(F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))) == 1


def iban(text: Column, key: str) -> Column:
    """The account is moved, the country stays, the check digits are worked out anew; spaces keep their places."""

    def run(bare: Column) -> Column:
        def spell(account: Column) -> Column:
            country = F.substring(bare, 1, 2)
            check = 98 - _mod97(F.concat(account, country, F.lit("00")))
            return F.concat(country, F.lpad(check.cast("string"), 2, "0"), account)

        return bind(chars_permuted(F.substring(bare, F.lit(5), F.length(bare)), "iban", key), spell)

    def spaced(moved: Column) -> Column:
        start = F.struct(F.lit("").alias("s"), F.lit(0).alias("n"))

        def step(acc: Column, c: Column) -> Column:
            own = (c != " ").cast("int")
            put = F.when(own == 1, F.substring(moved, acc["n"] + 1, F.lit(1))).otherwise(c)
            return F.struct(F.concat(acc["s"], put).alias("s"), (acc["n"] + own).alias("n"))

        return F.aggregate(F.split(text, ""), start, step, lambda acc: acc["s"])

    return bind(bind(F.replace(text, F.lit(" ")), run), spaced)


_VALID = {"card": is_card, "ssn": is_ssn, "date": is_date, "iban": is_iban, "phone": is_phone}
_MOVE = {"email": email, "iban": iban, "date": date, "ipv4": ipv4, "ssn": ssn, "phone": phone, "card": card}


def _judged(found: Column, key: str) -> Column:
    """A find with its kind and pseudonym; a find that is not valid keeps its text and has no kind."""
    kind, moved = F.lit(None).cast("string"), found
    for name in reversed(PATTERNS):
        fits = found.rlike(f"^(?:{PATTERNS[name]})$")
        if name in _VALID:
            fits = fits & _VALID[name](found)
        kind, moved = F.when(fits, F.lit(name)).otherwise(kind), F.when(fits, _MOVE[name](found, key)).otherwise(moved)
    return F.struct(found.alias("value"), kind.alias("kind"), moved.alias("pseudonym"))


def pseudonymised(docs: DataFrame, text: str = "text", finds: str = "finds", key: str = KEY) -> DataFrame:
    """The documents with pseudonyms in the text, and a column of finds: kind, value and pseudonym."""
    found = f"__{finds}_found"
    extracted = docs.withColumn(found, F.regexp_extract_all(f"`{text}`", F.lit(ANY), F.lit(0)))
    judged = extracted.withColumn(finds, F.transform(found, lambda m: _judged(m, key)))
    between = F.split(F.col(f"`{text}`"), ANY)
    woven = F.zip_with(between, finds, lambda t, f: F.concat(t, F.coalesce(f["pseudonym"], F.lit(""))))
    kept = F.filter(finds, lambda f: f["kind"].isNotNull())
    changed = F.when(F.size(kept) > 0, F.array_join(woven, "")).otherwise(F.col(f"`{text}`"))
    return judged.withColumn(text, changed).withColumn(finds, kept).drop(found)


def op3_pii(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    replaced = pseudonymised(docs)
    of_kind = lambda kind: F.size(F.filter("finds", lambda f: f["kind"] == kind))
    counts = [of_kind(kind).alias(f"n_{kind}") for kind in PATTERNS]
    return replaced.select("doc_id", "text", F.size("finds").alias("n_found"), *counts)
