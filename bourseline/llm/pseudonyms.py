"""Format-preserving pseudonyms by keyed Feistel permutations. DataFrame functions only.

Candidates are found by one pattern, validated by kind, and replaced in place:

* card numbers (13 to 19 digits, Luhn): the digits before the last are permuted, the check
  digit is worked out anew;
* IBANs (the length that the country fixes, mod 97): country kept, account permuted letter by letter and digit by digit, check
  digits anew;
* telephone numbers (8 to 15 digits with their country code, or ten in North American form):
  the country code is kept, and the number ends where its country's numbers do (`NATIONAL`), or
  before a date, an address or another number of the kinds here;
* social security numbers: permuted among the valid ones;
* IPv4 addresses: permuted among all of them;
* dates from 1800 to 2199 (ISO, day and month in figures with a year, English month names):
  permuted among the days of these 400 years, and written in the same way;
* e-mail addresses: the local part, letters as letters and figures as figures;
* quoted secrets that follow token, key, secret or password: hexadecimal figures, or letters
  and figures.

A candidate that fails its validation stays. Separators and capitals stay in place and do
not count as part of the value, so equal values get equal pseudonyms in every document and
spelling. Each permutation has `ROUNDS` rounds with SHA-256 of the key, the kind and the
other half. A permutation can map a value to itself, with a chance of one over the number
of values of that format.

Cases: a null text stays null, an empty one empty; rows and values may repeat; an empty
table gives an empty result; extra columns pass through and cannot clash (one that has the
name asked for the list of values must be renamed, or no list be asked for); whole texts of
any length are searched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# Candidates by kind. Every pattern begins and ends at a border, and none has a capturing group.
DIGIT_BEFORE, DIGIT_AFTER = r"(?<![0-9])", r"(?![0-9])"
MONTHS = "(?:January|February|March|April|May|June|July|August|September|October|November|December)"
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
DATE = DIGIT_BEFORE + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}|[0-9]{1,2} " + MONTHS + r" [0-9]{4})" + DIGIT_AFTER + "|" + MONTHS + r" [0-9]{1,2}, [0-9]{4}" + DIGIT_AFTER
SSN = DIGIT_BEFORE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = DIGIT_BEFORE + r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})" + DIGIT_AFTER
# Characters of an IBAN by country.
IBANS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
# Figures after the country code, where a country has few lengths; other codes, and other lengths, may have 8 to 15 in all.
NATIONAL = {
    "44": (9, 10), "33": (9, 9), "34": (9, 9), "31": (9, 9), "32": (8, 9), "30": (10, 10), "36": (8, 9), "40": (9, 9), "41": (9, 9), "45": (8, 8), "47": (8, 8), "48": (9, 9), "351": (9, 9),
    "380": (9, 9), "420": (9, 9), "421": (9, 9), "27": (9, 9), "52": (10, 10), "55": (10, 11), "61": (9, 9), "65": (8, 8), "86": (10, 11), "90": (10, 10), "91": (10, 10), "852": (8, 8), "972": (8, 9),
}


def _iban_of(n: int, codes: str) -> str:
    fours, rest = divmod(n - 4, 4)
    last = f" [A-Za-z0-9]{{{rest}}}" if rest else ""
    return f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:(?: [A-Za-z0-9]{{4}}){{{fours}}}{last}|[A-Za-z0-9]{{{n - 4}}})"


# A figure with the separator before it; none of a number begins another kind, once there are eight.
_FIGURE = r"[ .-]?\(?[0-9]\)?"
_APART = r"(?![ .-](?:" + "|".join([DATE, SSN, CARD, IP]) + "))"


def _figures(least: int, most: int) -> str:
    return rf"(?:{_FIGURE}){{{least}}}(?:{_APART}{_FIGURE}){{0,{most - least}}}{DIGIT_AFTER}"


PHONE = (
    r"(?<![0-9+])(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|"
    + "|".join(rf"\+{code}(?: ?\(0\))?{_figures(*span)}" for code, span in NATIONAL.items())
    + rf"|\+[2-9][0-9]{_figures(6, 13)}"
    + r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4})" + DIGIT_AFTER
)
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "secret": r"""(?<=(?:token|key|secret|password)\s{0,3}[=:]\s{0,3}["'])[A-Za-z0-9_+/-]{16,64}(?=["'])""",
    "iban": r"(?<![A-Za-z0-9])(?:" + "|".join(_iban_of(n, codes) for n, codes in IBANS.items()) + ")(?![A-Za-z0-9])",
    "phone": PHONE,
    "ip": IP,
    "date": DATE,
    "ssn": SSN,
    "card": CARD,
}
# Capitals are accepted throughout: whole documents can be in capitals.
ANY = "(?i)(?:" + "|".join(PATTERNS.values()) + ")"
SHAPES = {
    "email": r"^[^@]+@",
    "iban": r"^[A-Za-z]{2}[0-9]{2}[ A-Za-z0-9]{11,}$",
    "ip": r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$",
    "date": r"(?i)^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}|[0-9]{1,2} [a-z]{3,} [0-9]{4}|[a-z]{3,} [0-9]{1,2}, [0-9]{4})$",
    "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "card": r"^([0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$",
    "phone": r"^[+(0-9][0-9 ().-]{6,}$",
}
# Years 1800 to 2199 are a whole cycle of the calendar: 146,097 days, which is 189 times 773.
FIRST_DAY, DAYS_LEFT, DAYS_RIGHT = "1800-01-01", 189, 773


def _one(value: Column, use) -> Column:
    """`use(value)` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hash(key: str, kind: str, turn: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), other.cast("string")).cast("binary"), 256)


def permuted_number(value: Column, left: int, right: int, key: str, kind: str) -> Column:
    """A permutation of 0 .. left * right - 1: each half is shifted by a hash of the other, in turn."""

    def shift(own: Column, other: Column, turn: Column, size: int) -> Column:
        number = F.conv(F.substring(_hash(key, kind, turn, other), 1, 12), 16, 10).cast("bigint")
        return F.pmod(own + number, F.lit(size))

    def step(a: Column, turn: Column) -> Column:
        odd = turn % 2 == 1
        return F.struct(
            F.when(odd, shift(a["l"], a["r"], turn, left)).otherwise(a["l"]).alias("l"),
            F.when(odd, a["r"]).otherwise(shift(a["r"], a["l"], turn, right)).alias("r"),
        )

    value = value.cast("bigint")
    start = F.struct(F.floor(value / right).cast("bigint").alias("l"), F.pmod(value, F.lit(right)).cast("bigint").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda a: a["l"] * right + a["r"])


def permuted_text(value: Column, key: str, kind: str, hexadecimal: bool = False) -> Column:
    """A permutation of the strings (at most 64 characters) with letters and figures in the same places."""

    def moved(c: Column, by: Column) -> Column:
        if hexadecimal:
            place = F.instr(F.lit("0123456789abcdef"), c) - 1
            return F.substring(F.lit("0123456789abcdef"), F.pmod(place + by, F.lit(16)) + 1, F.lit(1))
        figure = F.char(F.pmod(F.ascii(c) - 48 + by, F.lit(10)) + 48)
        letter = F.char(F.pmod(F.ascii(c) - 97 + by, F.lit(26)) + 97)
        return F.when(c.between("0", "9"), figure).when(c.between("a", "z"), letter).otherwise(c)

    def shift(own: Column, other: Column, turn: Column) -> Column:
        number = lambda h, i: F.conv(F.substring(h, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
        return _one(_hash(key, kind, turn, other), lambda h: F.array_join(F.transform(F.split(own, ""), lambda c, i: moved(c, number(h, i))), ""))

    def step(a: Column, turn: Column) -> Column:
        odd = turn % 2 == 1
        return F.struct(
            F.when(odd, shift(a["l"], a["r"], turn)).otherwise(a["l"]).alias("l"),
            F.when(odd, a["r"]).otherwise(shift(a["r"], a["l"], turn)).alias("r"),
        )

    def run(v: Column) -> Column:
        half = F.floor(F.length(v) / 2).cast("int")
        start = F.struct(F.substring(v, F.lit(1), half).alias("l"), F.substring(v, half + 1, F.length(v)).alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda a: F.concat(a["l"], a["r"]))

    return _one(value, run)


def _bare(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, "[^A-Za-z0-9]", ""))


def refilled(form: Column, symbols: Column) -> Column:
    """`form` with its letters and figures replaced in order by `symbols`; capitals stay capital."""

    def at(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substring(form, F.lit(1), i + 1), "[^A-Za-z0-9]", ""))
        new = F.substring(symbols, place, F.lit(1))
        upper = c.rlike("[A-Z]") | (c.rlike("[0-9]") & form.rlike("[A-Z]") & ~form.rlike("[a-z]"))
        return F.when(upper, F.upper(new)).when(c.rlike("[a-z0-9]"), new).otherwise(c)

    return F.array_join(F.transform(F.split(form, ""), at), "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum by Luhn's rule; places from the right whose number (from 0) modulo 2 is `doubled` count twice."""

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == doubled, twice).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda s, x: s + x)


def _mod97(account: Column) -> Column:
    """An IBAN's remainder, with its first four characters at the end."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 87)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda s, c: F.pmod(s * F.when(c.between("0", "9"), 10).otherwise(100) + value(c), F.lit(97)))


def _card(v: Column, key: str) -> Column:
    def of(bare: Column) -> Column:
        body = permuted_text(F.substring(bare, F.lit(1), F.length(bare) - 1), key, "card")
        new = _one(body, lambda b: F.concat(b, F.pmod(10 - _luhn_sum(b, 0) % 10, F.lit(10)).cast("string")))
        return F.when(_luhn_sum(bare, 1) % 10 == 0, refilled(v, new))

    return _one(_bare(v), of)


def _iban(v: Column, key: str) -> Column:
    def of(bare: Column) -> Column:
        account = permuted_text(F.substring(bare, F.lit(5), F.length(bare)), key, "iban")

        def checked(a: Column) -> Column:
            check = 98 - _mod97(F.concat(F.substring(bare, 1, 2), F.lit("00"), a))
            return F.concat(F.substring(bare, 1, 2), F.lpad(check.cast("string"), 2, "0"), a)

        valid = F.length(bare).between(15, 34) & (_mod97(bare) == 1)
        return F.when(valid, refilled(v, _one(account, checked)))

    return _one(_bare(v), of)


def _phone(v: Column, key: str) -> Column:
    # A zero in brackets after the country code is dialled inside the country alone: no part of the value.
    form = F.regexp_replace(v, r"^(\+[0-9]{2,3} ?)\(0\)", "$1\u0001")

    def of(bare: Column) -> Column:
        code = F.when(v.startswith("+1"), 1).when(v.startswith("+"), 2).otherwise(0)
        new = F.concat(F.substring(bare, F.lit(1), code), permuted_text(F.substring(bare, code + 1, F.length(bare)), key, "phone"))
        return F.when(F.length(bare).between(8, 15), F.replace(refilled(form, new), F.lit("\u0001"), F.lit("(0)")))

    return _one(_bare(form), of)


def _ssn(v: Column, key: str) -> Column:
    area, group, serial = (F.substring(v, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    number = (((area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1).cast("bigint")) * 9999 + serial - 1

    def written(n: Column) -> Column:
        left = F.floor(n / 9999)
        index = F.floor(left / 99)
        parts = ((index + 1 + F.when(index + 1 >= 666, 1).otherwise(0), 3), (left % 99 + 1, 2), (n % 9999 + 1, 4))
        return F.concat_ws("-", *[F.lpad(x.cast("bigint").cast("string"), n, "0") for x, n in parts])

    return F.when(valid, _one(permuted_number(number, 898 * 99, 9999, key, "ssn"), written))


def _ip(v: Column, key: str) -> Column:
    def of(parts: Column) -> Column:
        number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda s, p: s * 256 + p.cast("bigint"))

        def written(n: Column) -> Column:
            """Zeros before a figure are written again, as many as fill the old width."""
            fresh = [F.pmod(F.shiftright(n, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]
            old = [F.get(parts, F.lit(i)) for i in range(4)]
            return F.concat_ws(".", *[F.when(o.rlike("^0."), F.lpad(f, F.greatest(F.length(f), F.length(o)), F.lit("0"))).otherwise(f) for f, o in zip(fresh, old)])

        return F.when(F.forall(parts, lambda p: p.cast("int") <= 255), _one(permuted_number(number, 65536, 65536, key, "ip"), written))

    return _one(F.split(v, r"\."), of)


def _date(v: Column, key: str) -> Column:
    figures = r"^[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}$"
    # Days come first with dots, months with slashes; where that is no date, the other way.
    forms = [
        (v.rlike("^[0-9]{4}-"), ["yyyy-MM-dd"]),
        (v.rlike(r"^[0-9]{2}\.[0-9]{2}\."), ["dd.MM.yyyy", "MM.dd.yyyy"]),
        (v.rlike(r"^[0-9]{1,2}\.[0-9]{1,2}\."), ["d.M.yyyy", "M.d.yyyy"]),
        (v.rlike("^[0-9]{2}/[0-9]{2}/"), ["MM/dd/yyyy", "dd/MM/yyyy"]),
        (v.rlike("^[0-9]{1,2}/[0-9]{1,2}/"), ["M/d/yyyy", "d/M/yyyy"]),
        (v.rlike("^[0-9]{1,2} "), ["d MMMM yyyy"]),
        (v.rlike("^[A-Za-z]"), ["MMMM d, yyyy"]),
    ]
    plain = F.when(v.rlike(figures) | v.rlike("^[0-9]{4}-"), v).otherwise(F.initcap(F.lower(v)))
    out = F.lit(None).cast("string")
    for holds, ways in reversed(forms):
        found = []
        for way in ways:
            day = F.try_to_timestamp(plain, F.lit(way)).cast("date")
            index = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
            inside = index.between(0, DAYS_LEFT * DAYS_RIGHT - 1)
            new = F.date_add(F.lit(FIRST_DAY).cast("date"), permuted_number(index, DAYS_LEFT, DAYS_RIGHT, key, "date").cast("int"))
            found.append(F.when(inside, F.date_format(new, way)))
        out = F.when(holds, F.coalesce(*found)).otherwise(out)
    return F.when((v == F.upper(v)) & ~v.rlike(figures), F.upper(out)).otherwise(out)


def _email(v: Column, key: str) -> Column:
    local, rest = F.regexp_extract(v, "^[^@]+", 0), F.regexp_extract(v, "@.*$", 0)
    return F.concat(refilled(local, permuted_text(_bare(local), key, "email")), rest)


def _secret(v: Column, key: str) -> Column:
    bare = _bare(v)
    return F.when(v.rlike("^[0-9a-fA-F]+$"), refilled(v, permuted_text(bare, key, "secret", True))).otherwise(refilled(v, permuted_text(bare, key, "secret")))


KINDS = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "iban": _iban, "phone": _phone}


def replaced(candidate: Column, key: str) -> Column:
    """struct(kind, value): the pseudonym of a candidate, or null kind and the candidate itself."""

    def answer(kind: str):
        return lambda value: F.struct(F.when(value.isNotNull(), F.lit(kind)).alias("kind"), F.coalesce(value, candidate).alias("value"))

    out = answer("secret")(_secret(candidate, key))
    for kind, make in reversed(KINDS.items()):
        out = F.when(candidate.rlike(SHAPES[kind]), _one(make(candidate, key), answer(kind))).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text", pii: str | None = "pii") -> DataFrame:
    """`docs` with its text replaced, and the column `pii` (none if null): the kind and pseudonym of each value, in order.
    The rows travel as one structure beside the text, so that no column of theirs meets a name used here."""
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = F.when(F.col("text").rlike("[0-9@\"']"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    rows = rows.withColumn("found", F.coalesce(found, F.array().cast("array<string>")))
    rows = rows.withColumn("new", F.transform("found", lambda c: replaced(c, key)))
    between = F.split("text", ANY)
    values = F.concat(F.transform("new", lambda n: n["value"]), F.array(F.lit("")))
    whole = F.array_join(F.zip_with(between, values, lambda a, b: F.concat(a, b)), "")
    kept = F.filter("new", lambda n: n["kind"].isNotNull())
    own = F.when(F.size("found") > 0, whole).otherwise(F.col("text"))
    columns = [own.alias(text) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    return rows.select(*columns, *([kept.alias(pii)] if pii else []))
