"""Personal data replaced by format-preserving pseudonyms, natively in Spark SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# The formats looked for, in the order in which they are tried at a place.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: Lengths of the countries' IBANs.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}


def iban_of(length: int, countries: str) -> str:
    fours, rest = divmod(length - 4, 4)
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else "")


LISTED = "|".join(" ".join(IBAN_LENGTHS.values()).split())
#: Of other countries any length.
IBAN = "|".join([*(iban_of(n, c) for n, c in IBAN_LENGTHS.items()), rf"(?!{LISTED})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"])
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": rf"(?<![\w.]){OCTET}(?:\.{OCTET}){{3}}(?![\w]|\.[0-9])",
    "iban": rf"(?<!\w)(?=[A-Z]{{2}}[0-9]{{2}})(?:{IBAN})(?!\w)",
    "date": r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?!\w|[./-][0-9])",
    "ssn": r"(?<![\w-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![\w-])",
    "card": r"(?<![\w-])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4} [0-9]{4} |-[0-9]{4}-[0-9]{4}-)[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![\w-])",
    "phone": r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?!\w)|(?<![\w+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?!\w)",
}
KINDS = tuple(PATTERNS)
#: The kinds that start with a digit, + or (, behind a look at this character: most places of a text are done with at once.
NUMBERS = "(?=[0-9+(])(?:" + "|".join(f"(?:{PATTERNS[k]})" for k in KINDS if k not in ("email", "iban")) + ")"
ANY = f"(?:{PATTERNS['email']})|{NUMBERS}|(?:{PATTERNS['iban']})"


def has_any(t: Column) -> Column:
    """Whether a text matches ANY, by the cheapest conditions."""
    return t.rlike(NUMBERS) | (t.contains("@") & t.rlike(PATTERNS["email"])) | t.rlike(PATTERNS["iban"])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def prf(key: str, *parts: Column) -> Column:
    """60 bits that depend on the key and all parts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *parts), 256), 1, 15), 16, 10).cast("bigint")


def feistel_number(n: Column, left: int, right: int, key: str, tweak: str) -> Column:
    """A keyed permutation of 0 .. left*right-1: the two mixed-radix digits are shifted in turn by a hash of the other."""

    def turn(s: Column, k: Column) -> Column:
        a = F.pmod(s["a"] + prf(key, F.lit(tweak), k, F.lit("a"), s["b"]), F.lit(left))
        return let(a, lambda a: F.struct(a.alias("a"), F.pmod(s["b"] + prf(key, F.lit(tweak), k, F.lit("b"), a), F.lit(right)).alias("b")))

    start = F.struct((F.floor(n / right)).cast("bigint").alias("a"), F.pmod(n, F.lit(right)).cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, turn, lambda s: s["a"] * right + s["b"])


def shifted(own: Column, other: Column, key: str, tweak: str, turn: Column) -> Column:
    """Letters and digits moved within their class by a hash of the other half, their place and the turn."""

    def move(c: Column, i: Column) -> Column:
        def within(first: str, size: int) -> Column:
            return F.chr(F.pmod(F.ascii(c) - ord(first) + prf(key, F.lit(tweak), turn, i, other), F.lit(size)) + ord(first))

        return F.when(c.rlike("^[0-9]$"), within("0", 10)).when(c.rlike("^[a-z]$"), within("a", 26)).when(c.rlike("^[A-Z]$"), within("A", 26)).otherwise(c)

    return F.array_join(F.transform(chars(own), move), "")


def chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def feistel_string(s: Column, key: str, tweak: str) -> Column:
    """A keyed permutation of strings with the same length and the same classes of characters."""
    half = F.floor(F.length(s) / 2).cast("int")

    def turn(h: Column, k: Column) -> Column:
        left = shifted(h["l"], h["r"], key, tweak, F.concat(k.cast("string"), F.lit("l")))
        return let(left, lambda left: F.struct(left.alias("l"), shifted(h["r"], left, key, tweak, F.concat(k.cast("string"), F.lit("r"))).alias("r")))

    start = F.struct(F.substring(s, F.lit(1), half).alias("l"), F.substring(s, half + 1, F.length(s)).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, turn, lambda h: F.concat(h["l"], h["r"]))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def refilled(shape: Column, new: Column, keep: str) -> Column:
    """`shape` with the characters that match `keep` replaced by those of `new`, in order."""
    others = f"[^{keep}]"
    place = lambda i: F.length(F.regexp_replace(F.substring(shape, F.lit(1), i + 1), others, ""))
    return let(new, lambda new: F.array_join(F.transform(chars(shape), lambda c, i: F.when(c.rlike(f"^[{keep}]$"), F.substring(new, place(i), F.lit(1))).otherwise(c)), ""))


def card(m: Column, key: str) -> Column:
    """All digits but the last are permuted, the last becomes the check digit of the new ones."""
    plain = digits(m)
    body = feistel_string(F.substring(plain, F.lit(1), F.length(plain) - 1), key, "card")
    ends = let(body, lambda body: F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(body, d.cast("string"))))
    return refilled(m, F.filter(ends, lambda s: F.call_function("luhn_check", s))[0], "0-9")


def ip(m: Column, key: str) -> Column:
    part = F.transform(F.split(m, r"\."), lambda x: x.cast("bigint"))
    n = ((part[0] * 256 + part[1]) * 256 + part[2]) * 256 + part[3]
    return F.aggregate(F.array(feistel_number(n, 1 << 16, 1 << 16, key, "ip")), F.lit(""), lambda _, v: F.concat_ws(".", *[F.shiftrightunsigned(v, s).bitwiseAND(255) for s in (24, 16, 8, 0)]))


# The Gregorian calendar repeats after 400 years: 146097 = 189 * 773 days, here from 1800-01-01.
FIRST_DAY, DAYS_LEFT, DAYS_RIGHT = "1800-01-01", 189, 773


def date_of(m: Column) -> Column:
    """The date, NULL if there is no such day from 1800 to 2199.  DD.MM.YYYY and, with slashes, MM/DD/YYYY or, where that is no date, DD/MM/YYYY."""
    d = F.coalesce(F.try_to_date(m, "yyyy-MM-dd"), F.try_to_date(m, "dd.MM.yyyy"), F.try_to_date(m, "MM/dd/yyyy"), F.try_to_date(m, "dd/MM/yyyy"))
    return F.when((d >= F.lit(FIRST_DAY).cast("date")) & (d < F.lit("2200-01-01").cast("date")), d)


# Days after the 12th of their month, from 1800 to 2199: 88497 = 9 * 9833, about 18.44 a month.
LATE_LEFT, LATE_RIGHT, LATE_A_MONTH = 9, 9833, 88497 / 4800


def late_date(d: Column, key: str) -> Column:
    """A day after the 12th under a permutation of such days, so that DD/MM/YYYY never reads as MM/DD/YYYY."""
    first = F.lit(FIRST_DAY).cast("date")
    begin = lambda month: F.datediff(F.add_months(first, month), first) - 12 * month
    month = (F.year(d) - 1800) * 12 + F.month(d) - 1
    new = feistel_number((begin(month) + F.dayofmonth(d) - 13).cast("bigint"), LATE_LEFT, LATE_RIGHT, key, "late date")

    def day(n: Column) -> Column:
        about = F.floor(n / LATE_A_MONTH).cast("int")
        month = F.array_max(F.filter(F.sequence(about - 2, about + 2), lambda k: (k >= 0) & (begin(k) <= n)))
        return let(month, lambda k: F.date_add(F.add_months(first, k), (n - begin(k) + 12).cast("int")))

    return let(new, day)


def date(m: Column, key: str) -> Column:
    n = feistel_number(F.datediff(date_of(m), F.lit(FIRST_DAY).cast("date")).cast("bigint"), DAYS_LEFT, DAYS_RIGHT, key, "date")
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))
    late = m.contains("/") & F.try_to_date(m, "MM/dd/yyyy").isNull()
    out = F.when(m.contains("-"), F.date_format(new, "yyyy-MM-dd")).when(m.contains("."), F.date_format(new, "dd.MM.yyyy"))
    return out.when(late, F.date_format(late_date(date_of(m), key), "dd/MM/yyyy")).otherwise(F.date_format(new, "MM/dd/yyyy"))


def ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups from 01, serials from 0001."""
    part = F.transform(F.split(m, "-"), lambda x: x.cast("bigint"))
    area = F.when(part[0] > 666, part[0] - 2).otherwise(part[0] - 1)
    new = feistel_number(area * (99 * 9999) + (part[1] - 1) * 9999 + part[2] - 1, 898, 99 * 9999, key, "ssn")
    return F.aggregate(F.array(new), F.lit(""), lambda _, v: F.concat_ws("-", number(F.floor(v / (99 * 9999)) + F.when(v >= 665 * 99 * 9999, 2).otherwise(1), 3), number(F.pmod(F.floor(v / 9999), F.lit(99)) + 1, 2), number(F.pmod(v, F.lit(9999)) + 1, 4)))


def number(n: Column, width: int) -> Column:
    return F.lpad(n.cast("bigint").cast("string"), width, "0")


def email(m: Column, key: str) -> Column:
    """The part before the @ is permuted, the domain stays."""
    at = F.instr(m, "@")
    name = F.substring(m, F.lit(1), at - 1)
    word = F.regexp_replace(name, "[^A-Za-z0-9]", "")
    return F.concat(refilled(name, feistel_string(word, key, "email"), "A-Za-z0-9"), F.substring(m, at, F.length(m)))


def phone(m: Column, key: str) -> Column:
    """A leading + and country code stay, all other digits are permuted."""
    country = F.regexp_extract(m, r"^(\+[0-9]{1,3})(?=[^0-9])", 1)
    rest = F.substring(m, F.length(country) + 1, F.length(m))
    return F.concat(country, refilled(rest, feistel_string(digits(rest), key, "phone"), "0-9"))


def iban_number(m: Column) -> Column:
    """Remainder modulo 97 of an IBAN, read with its first four characters last and letters as 10 to 35."""
    plain = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    return mod97(turned)


def mod97(s: Column) -> Column:
    value = lambda c: F.when(c.rlike("^[0-9]$"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55).cast("bigint")
    return F.aggregate(chars(s), F.lit(0).cast("bigint"), lambda acc, c: F.pmod(acc * F.when(c.rlike("^[0-9]$"), 10).otherwise(100) + value(c), F.lit(97)))


def iban(m: Column, key: str) -> Column:
    """The account is permuted, the country stays and the check digits follow."""
    plain = F.regexp_replace(m, " ", "")
    account = feistel_string(F.substring(plain, F.lit(5), F.length(plain)), key, "iban")
    country = F.substring(plain, 1, 2)
    new = F.aggregate(F.array(account), F.lit(""), lambda _, a: F.concat(country, number(F.lit(98) - mod97(F.concat(a, country, F.lit("00"))), 2), a))
    return refilled(m, new, "A-Z0-9")


MAKERS: dict[str, Callable[[Column, str], Column]] = {"email": email, "ip": ip, "iban": iban, "date": date, "ssn": ssn, "card": card, "phone": phone}


def kind_of(m: Column) -> Column:
    """The first kind whose format the whole match has and whose check it passes; NULL for none."""
    checks = {"iban": lambda: iban_number(m) == 1, "date": lambda: date_of(m).isNotNull(), "card": lambda: F.call_function("luhn_check", digits(m))}
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        fits = m.rlike("^(?:" + PATTERNS[kind] + ")$")
        out = F.when(fits & checks[kind]() if kind in checks else fits, F.lit(kind)).otherwise(out)
    return out


def pseudonymise(df: DataFrame, key: str, text: str = "text", found: str = "pii") -> DataFrame:
    """Replaces personal data in `text`; adds `found`, the kinds of what was replaced, in order.

    E-mail names, IPv4 addresses, IBANs, dates, social security numbers, card
    numbers and telephone numbers are replaced by other values of the same
    format under a keyed Feistel permutation: equal values get equal
    pseudonyms in every row, different values different ones.  Numbers that
    fail their check (Luhn, modulo 97, no such day) stay as they are.  NULL
    texts stay NULL with no finds; all other columns stay, one named like
    `found` is replaced.  A row is changed by itself, without a shuffle.
    """
    t = F.col(text)
    hits = F.transform(F.regexp_extract_all(t, F.lit(ANY), F.lit(0)), lambda m: F.struct(m.alias("was"), kind_of(m).alias("kind")))
    none = F.array().cast("array<struct<was:string,kind:string>>")
    df = df.drop(found).withColumn("__hits", F.when(has_any(t), hits).otherwise(none))

    def changed(h: Column) -> Column:
        out = h["was"]
        for kind, make in MAKERS.items():
            out = F.when(h["kind"] == kind, make(h["was"], key)).otherwise(out)
        return out

    some = F.exists("__hits", lambda h: h["kind"].isNotNull())
    joined = F.array_join(F.flatten(F.zip_with(F.split(t, ANY, -1), F.transform("__hits", changed), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    kinds = F.filter(F.transform("__hits", lambda h: h["kind"]), lambda k: k.isNotNull())
    return df.withColumns({text: F.when(some, joined).otherwise(t), found: kinds}).drop("__hits")
