"""Format-preserving pseudonyms for personal data, by keyed Feistel networks in Spark expressions.

Numbers and dates are validated first: card numbers by the Luhn check, IBANs by mod 97, US social security numbers
by their forbidden groups, IPv4 addresses by their octets, dates by the calendar; phone numbers, e-mail addresses and hexadecimal
secrets by their form. Each valid value is permuted within its format under the key: the result is valid again, has the same
separators, and equal values (whatever their separators) become equal in every document. Card numbers get a new check digit,
IBANs keep the country and get new check digits; SSNs walk the permutation until the result is valid; dates are permuted
inside 1900-01-01 .. 2099-12-31; e-mail addresses keep their domain.

Not looked for: phones without country code that are written in one piece or with spaces, dates with the year first and slashes or with hyphens and the year last,
IBANs in lower case, IPv6 addresses, names and postal addresses.

Edge cases: a null text stays null with no finds; texts without finds are unchanged. A very long text is searched whole; no pattern
recurses. Repeated rows are treated alike. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: The domain is one run of characters: a repeated group would need a stack as deep as the domain has labels.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]*[A-Za-z0-9-]"
SECRET = r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![0-9A-Za-z])"
PHONE = r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
NATIONAL = r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\) ?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9-])"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
DATE = r"(?<![0-9])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./](?:19|20)[0-9]{2})(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
#: Cards as they are usually written: in one piece, 4-4-4-4, 4-6-5, 4-6-4; and with a last group of one to three digits.
SHAPED = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9])"
LONG = r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){2,3}[ -][0-9]{1,3}(?![0-9])"
#: A run of numbers of any length, up to a dotted date or address; cards, and what stands beside them, are looked for inside.
RUN = r"(?<![0-9])[0-9][0-9 -]{11,}[0-9](?![0-9]|[./][0-9]{1,3}[./][0-9])"
ANY = "|".join((EMAIL, SECRET, IBAN, PHONE, NATIONAL, IPV4, DATE, SSN, RUN))
KINDS = ("email", "secret", "iban", "phone", "ipv4", "date", "ssn", "card")
_DAYS = 73049  # 1900-01-01 .. 2099-12-31
_HEX = "0123456789abcdef"


def _let(value: Column, body) -> Column:
    """body(value), with the value worked out once: what a lambda holds is worked out for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _shift(c: Column, by: Column, hexadecimal: bool) -> Column:
    """c moved by so many places inside its class: digits, lower-case or upper-case letters; others stay."""
    if hexadecimal:
        return F.substring(F.lit(_HEX), (F.pmod(F.instr(F.lit(_HEX), c) - 1 + by, F.lit(16)) + 1).cast("int"), F.lit(1))
    code = F.ascii(c)
    move = lambda low, n: F.char(F.pmod(code - low + by, F.lit(n)) + low)
    return F.when(c.between("0", "9"), move(48, 10)).when(c.between("a", "z"), move(97, 26)).when(c.between("A", "Z"), move(65, 26)).otherwise(c)


def permuted_text(s: Column, key: str, tweak: str, hexadecimal: bool = False) -> Column:
    """A keyed permutation of the strings with the same class of character at each place (Feistel, halves of the string)."""
    c = _chars(s)
    half = F.floor(F.size(c) / 2).cast("int")
    start = F.struct(F.slice(c, F.lit(1), half).alias("a"), F.slice(c, half + 1, F.size(c) - half).alias("b"))
    n = F.length(s).cast("string")

    def turn(p: Column, i: Column) -> Column:
        h = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), i.cast("string"), n, F.array_join(p["b"], "")), 512)
        moved = _let(h, lambda g: F.transform(p["a"], lambda x, k: _shift(x, F.conv(F.substring(g, F.pmod(k, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int"), hexadecimal)))
        return F.struct(p["b"].alias("a"), moved.alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda p: F.array_join(F.concat(p["a"], p["b"]), ""))


def permuted_number(x: Column, n: int, root: int, key: str, tweak: str) -> Column:
    """A keyed permutation of 0 .. n - 1, root * root >= n (Feistel, walked until below n)."""

    def network(v: Column) -> Column:
        start = F.struct(F.floor(v / root).cast("long").alias("a"), F.pmod(v, F.lit(root)).cast("long").alias("b"))

        def turn(p: Column, i: Column) -> Column:
            h = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), i.cast("string"), p["b"].cast("string")), 256), 1, 12), 16, 10).cast("long")
            return F.struct(p["b"].alias("a"), F.pmod(p["a"] + h, F.lit(root)).cast("long").alias("b"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda p: p["a"] * root + p["b"])

    first = network(x.cast("long"))
    if n == root * root:
        return first
    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), first, lambda v, _: F.when(v < n, v).otherwise(network(v)))


def refilled(form: Column, chars: Column, places: str = "[0-9]") -> Column:
    """The form with the characters that match places replaced, in order, by those of another string."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def put(s: Column, c: Column) -> Column:
        fits = c.rlike(places)
        return F.struct(F.concat(s["out"], F.when(fits, F.substring(chars, s["k"], F.lit(1))).otherwise(c)).alias("out"), (s["k"] + F.when(fits, 1).otherwise(0)).alias("k"))

    return F.aggregate(_chars(form), start, put, lambda s: s["out"])


def _luhn_digit(body: Column) -> Column:
    doubled = F.transform(F.reverse(_chars(body)), lambda c, i: F.when(F.pmod(i, F.lit(2)) == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda a, b: a + b), F.lit(10)).cast("string")


def _mod97(s: Column) -> Column:
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(_chars(s), F.lit(0), lambda r, c: F.pmod(r * F.when(c.between("0", "9"), 10).otherwise(100) + value(c), F.lit(97)).cast("int"))


def kind_of(m: Column) -> Column:
    """The kind of a find, null if it isn't valid."""
    ip = F.forall(F.split(m, r"\."), lambda o: o.cast("int") <= 255)
    compact = F.translate(m, " ", "")
    iban = (F.length(compact).between(15, 34)) & (_mod97(F.concat(F.substring(compact, F.lit(5), F.lit(40)), F.substring(compact, F.lit(1), F.lit(4)))) == 1)
    ssn = ~m.rlike("^(000|666|9)") & ~m.rlike("-00-") & ~m.rlike("-0000$")
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(f"^{SECRET}$"), "secret")
        .when(m.rlike("^[A-Z]"), F.when(iban, "iban"))
        .when(m.startswith("+") | m.rlike(f"^{NATIONAL}$"), "phone")
        .when(m.rlike(f"^{IPV4}$"), F.when(ip, "ipv4"))
        .when(m.rlike(f"^{DATE}$"), F.when(_day(m).isNotNull(), "date"))
        .when(m.rlike(f"^{SSN}$"), F.when(ssn, "ssn"))
        .when(F.length(_digits(m)).between(13, 19) & (_luhn_digit(F.substring(_digits(m), F.lit(1), F.length(_digits(m)) - 1)) == F.right(_digits(m), F.lit(1))), "card")
    )


def _day(m: Column) -> Column:
    """Days since 1900-01-01, null if the calendar lacks the date. Day before month, but for the form with the year first."""
    p = F.split(m, r"[./-]")
    iso = m.rlike("^[0-9]{4}-")
    padded = F.concat_ws("-", F.when(iso, p[0]).otherwise(p[2]), F.lpad(p[1], 2, "0"), F.lpad(F.when(iso, p[2]).otherwise(p[0]), 2, "0"))
    return F.datediff(F.try_to_date(padded, "yyyy-MM-dd"), F.lit("1900-01-01").cast("date"))


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    at = F.instr(m, "@")
    local = F.substring(m, F.lit(1), at - 1)
    compact = F.translate(m, " ", "")
    bban = permuted_text(F.substring(compact, F.lit(5), F.lit(40)), key, "iban")
    check = F.lpad((98 - _mod97(F.concat(bban, F.substring(compact, F.lit(1), F.lit(2)), F.lit("00")))).cast("string"), 2, "0")
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("long"))
    ip = permuted_number(((octets[0] * 256 + octets[1]) * 256 + octets[2]) * 256 + octets[3], 1 << 32, 1 << 16, key, "ipv4")
    day = F.date_add(F.lit("1900-01-01").cast("date"), permuted_number(_day(m), _DAYS, 271, key, "date").cast("int"))
    parts = F.split(m, r"[./-]")
    pad = lambda value, form: F.when(F.length(form) == 1, value.cast("string")).otherwise(F.lpad(value.cast("string"), 2, "0"))
    sep = F.when(m.contains("/"), "/").otherwise(".")
    date = F.when(m.rlike("^[0-9]{4}-"), F.date_format(day, "yyyy-MM-dd")).otherwise(F.concat_ws("", pad(F.dayofmonth(day), parts[0]), sep, pad(F.month(day), parts[1]), sep, F.year(day).cast("string")))
    valid = lambda s: ~s.rlike("^(000|666|9)|^...00|0000$")
    ssn = F.aggregate(F.sequence(F.lit(1), F.lit(64)), permuted_text(_digits(m), key, "ssn"), lambda s, _: F.when(valid(s), s).otherwise(permuted_text(s, key, "ssn")))
    secret = permuted_text(F.lower(m), key, "secret", hexadecimal=True)
    digits = _digits(m)
    body = permuted_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    country = F.regexp_extract(m, r"^\+[0-9]{1,3}?(?=[ .(-])", 0)
    rest = F.substring(m, F.length(country) + 1, F.length(m))
    return (
        F.when(kind == "email", F.concat(permuted_text(local, key, "email"), F.substring(m, at, F.length(m))))
        .when(kind == "secret", F.when(m.rlike("[A-F]") & ~m.rlike("[a-f]"), F.upper(secret)).otherwise(secret))
        .when(kind == "iban", refilled(m, F.concat(F.substring(compact, F.lit(1), F.lit(2)), check, bban), "[0-9A-Z]"))
        .when(kind == "phone", F.concat(country, refilled(rest, permuted_text(_digits(rest), key, "phone"))))
        .when(kind == "ipv4", F.concat_ws(".", *(F.pmod(F.shiftright(ip, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0))))
        .when(kind == "date", date)
        .when(kind == "ssn", refilled(m, ssn))
        .when(kind == "card", refilled(m, F.concat(body, _luhn_digit(body))))
    )


def values_in(m: Column) -> Column:
    """The values of a run of numbers, likely forms first: dates, SSNs and phones, cards of the usual shapes from every number on, any others."""
    at = lambda p: F.regexp_extract_all(m, F.lit(f"(?=({p}))"), 1)
    inside = F.concat(at(f"{DATE}|{SSN}|{NATIONAL}"), at(SHAPED), at(LONG), F.regexp_extract_all(m, F.lit(CARD), 0))
    whole = m.rlike(f"^(?:{SHAPED}|{LONG})$") & kind_of(m).isNotNull()
    return F.when(whole, F.array(m)).otherwise(F.filter(F.array_distinct(inside), lambda v: kind_of(v).isNotNull()))


def _standing(v: Column) -> Column:
    """A pattern of a value (digits, spaces, hyphens) where it stands alone, and is no part of a longer number."""
    beside = F.when(v.rlike(f"^(?:{SSN}|{NATIONAL})$"), "[0-9-]").otherwise("[0-9]")
    return F.concat(F.lit("(?<!"), beside, F.lit(")"), v, F.lit("(?!"), beside, F.lit(")"))


def _mark(i: Column) -> Column:
    return F.concat(F.lit("<"), F.translate(i.cast("string"), "0123456789", "abcdefghij"), F.lit(">"))


def treated(m: Column, key: str) -> Column:
    """A find as kinds, in order, and new: with each of its valid values replaced. A run of numbers may have several."""
    kind = kind_of(m)
    one = F.struct(F.when(kind.isNull(), F.array().cast("array<string>")).otherwise(F.array(kind)).alias("kinds"), F.when(kind.isNull(), m).otherwise(pseudonym(m, kind, key)).alias("new"))
    # Values are marked first, so that none is replaced twice.
    seen = F.transform(F.array(values_in(m)), lambda v: F.struct(v.alias("v"), F.aggregate(F.sequence(F.lit(0), F.size(v)), m, lambda s, i: F.when(i < F.size(v), F.regexp_replace(s, _standing(F.get(v, i)), _mark(i))).otherwise(s)).alias("s")))
    split = F.transform(seen, lambda x: F.struct(x["v"].alias("v"), x["s"].alias("s"), F.regexp_extract_all(x["s"], F.lit("<[a-j]+>"), 0).alias("marks")))

    def put(x: Column) -> Column:
        held = F.transform(x["marks"], lambda k: F.get(x["v"], F.translate(F.translate(k, "<>", ""), "abcdefghij", "0123456789").cast("int")))
        new = F.transform(held, lambda v: pseudonym(v, kind_of(v), key))
        return F.struct(F.transform(held, lambda v: kind_of(v)).alias("kinds"), F.array_join(F.zip_with(F.split(x["s"], "<[a-j]+>", -1), new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "").alias("new"))

    return F.when(m.rlike(f"^{RUN}$") & ~m.rlike(f"^(?:{SECRET}|{DATE}|{SSN}|{NATIONAL})$"), F.get(F.transform(split, put), F.lit(0))).otherwise(one)


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """One row per document: doc_id, n_private, kinds (the kind of each find, in order), text.

    The text is split at its finds and joined again.
    """
    found = F.regexp_extract_all("text", F.lit(ANY), 0)
    rows = docs.select("doc_id", "text", F.coalesce(found, F.array().cast("array<string>")).alias("found"))
    rows = rows.withColumn("done", F.transform("found", lambda m: treated(m, key)))
    joined = F.array_join(F.zip_with(F.split("text", ANY, -1), F.col("done.new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    text = F.when(F.size("found") == 0, F.col("text")).otherwise(joined)
    kinds = F.flatten("done.kinds")
    return rows.select("doc_id", F.size(kinds).cast("long").alias("n_private"), F.array_join(kinds, ",").alias("kinds"), text.alias("text"))
