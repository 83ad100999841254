"""Format-preserving pseudonyms (operator 5), DataFrame functions only.

Personal numbers and dates are found by one pattern, validated, and replaced by
a keyed permutation of their own format: cards (Luhn) by cards, social security
numbers, phone numbers and IP addresses by others of their range, calendar
dates by dates, e-mail names by names of the same shape. The permutation is an
unbalanced Feistel network over a product of two ranges that has exactly the
size of the format, with rounds keyed by SHA-256; so equal values get equal
pseudonyms in every document, different ones different, and no table of them
is kept anywhere.

Phone numbers are: +1 with ten digits, ten digits in three groups of which the
first may be in brackets and a 1 may come before, and + with any other country
code, 7 to 15 digits in all. Any digits are accepted; the country code, the
separators and whether area code and exchange begin with 0 or 1 stay. Seven or
ten digits without a mark of the format aren't taken for a phone number.

What looks like one of the other formats but isn't valid (a number that fails the
Luhn check, 31 February) stays as it is. Null texts stay null, empty ones
empty; every row is rewritten by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# The formats.
#: Possessive, so that an address of any length is matched in a loop, not by recursion.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])"
DATE = r"(?<![\d-])(?:19|20)\d\d-\d\d-\d\d(?![\d-])|(?<![\d/])\d\d/\d\d/(?:19|20)\d\d(?![\d/])"
CARD = r"(?<!\d)(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)"
COUNTRY = r"(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
GROUPS = r"(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}"
#: A number with a country code ends where another format begins.
PHONE = (r"(?<![\d+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
         r"|(?<!\d)(?:(?<![\d.,+-])1[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
         rf"|(?<![\d.,+-]){GROUPS}(?!\d|[.,-]\d)"
         rf"|(?<![\d+])\+[1-9](?:(?! (?:{IP}|{SSN}|{DATE}|\+|\d{{4}}(?:[ -]\d{{4}}){{3}}(?![ -]?\d)|"
         rf"\d{{4}}[ -]\d{{6}}[ -]\d{{5}}(?![ -]?\d)))[ .()-]{{0,2}}\d){{6,14}}(?!\d)")
ANY = "|".join((EMAIL, IP, PHONE, SSN, DATE, CARD))
KINDS = ("email", "ip", "phone", "ssn", "date", "card")
#: Days from 1900-01-01 to 2099-12-31: 73,049 = 229 * 319.
FIRST_DAY, DAYS = "1900-01-01", (229, 319)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def feistel(x: Column, y: Column, size_x: Column | int, size_y: Column | int, key: str,
            tweak: Column | str) -> Column:
    """A keyed permutation of the pairs (x, y) of [0, size_x) x [0, size_y)."""
    as_long = [F.lit(s).cast("long") if isinstance(s, int) else s.cast("long")
               for s in (size_x, size_y)]
    name = F.lit(tweak) if isinstance(tweak, str) else tweak

    def turn(state: Column, r: Column) -> Column:
        odd = r % 2 == 1
        fixed = F.when(odd, state["y"]).otherwise(state["x"])
        mac = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(key), name, r.cast("string"),
                                                    fixed.cast("string")), 256), 1, 15),
                     16, 10).cast("long")
        return F.struct(
            F.when(odd, (state["x"] + mac % as_long[0]) % as_long[0]).otherwise(state["x"]).alias("x"),
            F.when(odd, state["y"]).otherwise((state["y"] + mac % as_long[1]) % as_long[1]).alias("y"))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced one by one."""
    def fill(new: Column) -> Column:
        def put(state: Column, c: Column) -> Column:
            is_digit = c.between("0", "9")
            return F.struct(
                F.concat(state["out"], F.when(is_digit, F.substring(new, state["at"], F.lit(1)))
                         .otherwise(c)).alias("out"),
                (state["at"] + F.when(is_digit, 1).otherwise(0)).alias("at"))
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
        return F.aggregate(F.split(form, "(?!^)"), start, put, lambda s: s["out"])
    return let(digits, fill)


def _part(value: Column, start, length) -> Column:
    start, length = (F.lit(v) if isinstance(v, int) else v for v in (start, length))
    return F.substring(value, start, length)


def _padded(value: Column, width) -> Column:
    return F.lpad(value.cast("string"), F.lit(width) if isinstance(width, int) else width, F.lit("0"))


def _permute_digits(digits: Column, key: str, tweak: str) -> Column:
    """Digits of any length up to 36, halves of up to 18."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    ten = F.array(*[F.lit(10 ** k).cast("long") for k in range(19)])
    pair = feistel(F.when(left > 0, _part(digits, 1, left).cast("long")).otherwise(F.lit(0)),
                   _part(digits, left + 1, n).cast("long"), F.get(ten, left), F.get(ten, n - left),
                   key, F.concat(F.lit(tweak), n.cast("string")))
    return let(pair, lambda out: F.concat(
        F.when(left > 0, _padded(out["x"], left)).otherwise(""), _padded(out["y"], n - left)))


def _luhn_sum(digits: Column, doubled_parity: Column) -> Column:
    """Luhn sum; places (from 1) of the given parity are doubled."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == doubled_parity, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def card_pseudonym(value: Column, key: str) -> Column:
    digits = _digits(value)
    n = F.length(digits)
    valid = (_luhn_sum(digits, (n + 1) % 2) % 10 == 0) & n.between(13, 19)

    def with_check(body: Column) -> Column:
        check = (10 - _luhn_sum(F.concat(body, F.lit("0")), (n + 1) % 2) % 10) % 10
        return F.concat(body, check.cast("string"))
    body = _permute_digits(_part(digits, 1, n - 1), key, "card")
    return F.when(valid, _refill(value, let(body, with_check)))


def phone_pseudonym(value: Column, key: str) -> Column:
    """Ten digits are permuted by area code, exchange and line, the first two
    among those that begin with 0 or 1 or among the others; the digits after
    another country code among all of their number."""
    digits = _digits(value)

    def ten_digits(ten: Column) -> Column:
        area, exchange = (_part(ten, k, 3).cast("long") for k in (1, 4))
        size_a, size_e = (F.when(v < 200, 200).otherwise(800) for v in (area, exchange))
        low_a, low_e = (F.when(v < 200, 0).otherwise(200) for v in (area, exchange))
        tweak = F.concat(F.lit("phone"), F.when(area < 200, "a").otherwise(""),
                         F.when(exchange < 200, "e").otherwise(""))
        pair = feistel((area - low_a) * size_e + exchange - low_e, _part(ten, 7, 4).cast("long"),
                       size_a * size_e, 10_000, key, tweak)
        return let(pair, lambda out: F.concat(
            _padded(F.floor(out["x"] / size_e).cast("long") + low_a, 3),
            _padded(out["x"] % size_e + low_e, 3), _padded(out["y"], 4)))

    def new(d: Column) -> Column:
        country = F.regexp_extract(d, f"^{COUNTRY}", 0)
        start = F.length(country) + 1
        american = ~value.startswith("+") | ((country == "1") & (F.length(d) == 11))
        return F.when(american, F.concat(
            _part(d, 1, F.length(d) - 10), let(F.substring(d, -10, 10), ten_digits))).otherwise(
            F.concat(country, _permute_digits(_part(d, start, F.length(d)), key, "abroad")))
    return _refill(value, let(digits, new))


def ip_pseudonym(value: Column, key: str) -> Column:
    part = F.split(value, r"\.")
    octet = [F.get(part, F.lit(k)).cast("long") for k in range(4)]
    valid = (octet[0] < 256) & (octet[1] < 256) & (octet[2] < 256) & (octet[3] < 256)
    pair = feistel(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], 65_536, 65_536, key, "ip")
    return F.when(valid, let(pair, lambda out: F.concat_ws(".", *[
        n.cast("long").cast("string") for c in ("x", "y")
        for n in (F.floor(out[c] / 256), out[c] % 256)])))


def ssn_pseudonym(value: Column, key: str) -> Column:
    area, group, serial = (_part(value, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    pair = feistel(place, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn")
    return F.when(valid, let(pair, lambda out: F.concat_ws(
        "-", _padded(out["x"] + F.when(out["x"] >= 665, 2).otherwise(1), 3),
        _padded(F.floor(out["y"] / 9999).cast("long") + 1, 2),
        _padded(out["y"] % 9999 + 1, 4))))


def _as_date(form: str):
    return lambda new: F.date_format(F.date_add(
        F.lit(FIRST_DAY).cast("date"), (new["x"] * DAYS[1] + new["y"]).cast("int")), form)


def date_pseudonym(value: Column, key: str) -> Column:
    """Years 1900 to 2099, as yyyy-MM-dd, dd/MM/yyyy or, where only that is a
    date, MM/dd/yyyy."""
    a, b, y = _part(value, 1, 2), _part(value, 4, 2), _part(value, 7, 4)
    forms = (("yyyy-MM-dd", F.when(value.contains("-"), value)),
             ("dd/MM/yyyy", F.when(value.contains("/"), F.concat_ws("-", y, b, a))),
             ("MM/dd/yyyy", F.when(value.contains("/"), F.concat_ws("-", y, a, b))))
    out = None
    for form, iso in forms:
        day = F.datediff(iso.try_cast("date"), F.lit(FIRST_DAY).cast("date"))
        pair = feistel(F.floor(day / DAYS[1]), day % DAYS[1], *DAYS, key, "date")
        text = F.when(day.isNotNull(), let(pair, _as_date(form)))
        out = text if out is None else F.coalesce(out, text)
    return out


def _permute_letters(text: Column, key: str) -> Column:
    """The letters a-z of a text of up to 24 letters, as two base-26 numbers."""
    letters = F.regexp_replace(text, "[^a-z]", "")
    n = F.length(letters)
    left = F.floor(n / 2).cast("int")
    power = F.array(*[F.lit(26 ** k).cast("long") for k in range(13)])

    def number(s: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0).cast("long"),
                           lambda t, i: t * 26 + F.ascii(F.substring(s, i, F.lit(1))) - 97)

    def spell(v: Column, width: Column) -> Column:
        chars = F.transform(F.sequence(F.lit(1), width), lambda i: F.char(
            F.expr("97L") + F.floor(v / F.get(power, width - i)).cast("long") % 26))
        return F.when(width > 0, F.array_join(chars, "")).otherwise("")

    head = _part(letters, 1, left)
    pair = feistel(F.when(left > 0, number(head)).otherwise(F.lit(0).cast("long")),
                   number(_part(letters, left + 1, n)), F.get(power, left), F.get(power, n - left),
                   key, F.concat(F.lit("letters"), n.cast("string")))
    return F.when(n.between(1, 24), let(pair, lambda out: F.concat(
        spell(out["x"], left), spell(out["y"], n - left))))


def _permute_long(codes: Column, size: int, key: str, tweak: str) -> Column:
    """A keyed permutation of the arrays of numbers below ``size`` of one length:
    rounds that add to one half a key stream made from the other one."""
    def stream(half: Column, n: Column, r: Column) -> Column:
        seed = F.sha2(F.concat_ws(":", F.lit(key), F.lit(tweak), r.cast("string"),
                                  F.array_join(half.cast("array<string>"), ",")), 256)
        return let(seed, lambda s: F.transform(F.slice(F.sequence(F.lit(0), n), F.lit(1), n), lambda i: F.conv(
            F.substring(F.sha2(F.concat_ws(":", s, i.cast("string")), 256), 1, 12), 16, 10).cast("long")))

    def turn(state: Column, r: Column) -> Column:
        odd = r % 2 == 1
        to, by = F.when(odd, state["x"]).otherwise(state["y"]), F.when(odd, state["y"]).otherwise(state["x"])
        new = let(F.struct(to.alias("to"), by.alias("by")), lambda h: F.zip_with(
            h["to"], stream(h["by"], F.size(h["to"]), r), lambda a, b: (a + b) % size))
        return F.struct(F.when(odd, new).otherwise(state["x"]).alias("x"),
                        F.when(odd, state["y"]).otherwise(new).alias("y"))

    left = F.floor(F.size(codes) / 2).cast("int")
    start = F.struct(F.slice(codes, F.lit(1), left).alias("x"),
                     F.slice(codes, left + 1, F.size(codes) - left).alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn,
                       lambda s: F.concat(s["x"], s["y"]))


def _long_name(name: Column, key: str) -> Column:
    """A name of any length: its letters, its digits and the rest each with their
    places, the first two permuted, put together in order of place."""
    chars = F.transform(F.split(name, "(?!^)"), lambda c, i: F.struct(i.alias("at"), c.alias("c")))

    def permuted(all_: Column, lo: str, hi: str, size: int) -> Column:
        mine = F.filter(all_, lambda x: x["c"].between(lo, hi))
        return let(mine, lambda own: F.zip_with(own, _permute_long(
            F.transform(own, lambda x: (F.ascii(x["c"]) - ord(lo)).cast("long")), size, key,
            f"long {lo}"), lambda x, n: F.struct(x["at"].alias("at"), F.char(n + ord(lo)).alias("c"))))

    def other(all_: Column) -> Column:
        return F.filter(all_, lambda x: ~(x["c"].between("a", "z") | x["c"].between("0", "9")))
    return let(chars, lambda all_: F.array_join(F.transform(F.array_sort(F.concat(
        permuted(all_, "a", "z", 26), permuted(all_, "0", "9", 10), other(all_))),
        lambda x: x["c"]), ""))


def email_pseudonym(value: Column, key: str) -> Column:
    """The name before the @ is permuted, letters and digits each among
    themselves; upper case counts as lower. Up to 24 letters and 36 digits are
    numbers to the Feistel network; of longer names its halves are the characters
    themselves (``_permute_long``)."""
    name = F.lower(F.substring_index(value, "@", 1))
    domain = F.substring_index(value, "@", -1)
    letters, digits = _permute_letters(name, key), F.regexp_replace(name, "[^0-9]", "")
    short = (F.length(F.regexp_replace(name, "[^a-z]", "")) <= 24) & (F.length(digits) <= 36)
    digits = F.when(F.length(digits) > 0, _permute_digits(digits, key, "name")).otherwise("")

    def fill(new: Column) -> Column:
        def put(state: Column, c: Column) -> Column:
            is_letter, is_digit = c.between("a", "z"), c.between("0", "9")
            return F.struct(
                F.concat(state["out"],
                         F.when(is_letter, F.substring(new["letters"], state["l"], F.lit(1)))
                         .when(is_digit, F.substring(new["digits"], state["d"], F.lit(1)))
                         .otherwise(c)).alias("out"),
                (state["l"] + F.when(is_letter, 1).otherwise(0)).alias("l"),
                (state["d"] + F.when(is_digit, 1).otherwise(0)).alias("d"))
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("l"), F.lit(1).alias("d"))
        return F.aggregate(F.split(name, "(?!^)"), start, put, lambda s: s["out"])
    filled = let(F.struct(letters.alias("letters"), digits.alias("digits")), fill)
    return F.concat(F.when(short, filled).otherwise(_long_name(name, key)), F.lit("@"), domain)


def _kind(value: Column) -> Column:
    return (F.when(value.contains("@"), "email")
            .when(value.rlike(rf"^(?:[+(]|1[ .-]?\(|{GROUPS}$)"), "phone")
            .when(value.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "ip")
            .when(value.rlike(r"^\d{3}-\d\d-\d{4}$"), "ssn")
            .when(value.rlike(r"^(\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4})$"), "date")
            .otherwise("card"))


_MAKERS = {"email": email_pseudonym, "ip": ip_pseudonym, "phone": phone_pseudonym,
           "ssn": ssn_pseudonym, "date": date_pseudonym, "card": card_pseudonym}


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a matched value, null where it isn't valid."""
    out = None
    for name in KINDS:
        made = _MAKERS[name](value, key)
        out = F.when(kind == name, made) if out is None else out.when(kind == name, made)
    return out


def _replaced(kind: str):
    return lambda m: (m["kind"] == kind) & m["new"].isNotNull()


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the column ``text`` rewritten and ``pii_<kind>`` (long), the
    number of values replaced, for each kind. A column of ``docs`` that has such
    a name is replaced; all others stay. Whoever has ``key`` can undo this, so
    there is no default; it is part of the plan's text."""
    if not key:
        raise ValueError("pseudonyms need a key")
    hits_, made_, gaps_ = (f"{name}{'_' * max(map(len, docs.columns))}" for name in ("hits", "made", "gaps"))
    hits = F.transform(F.regexp_extract_all(F.col("text"), F.lit(f"({ANY})"), F.lit(1)),
                       lambda v: F.struct(v.alias("value"), _kind(v).alias("kind")))
    made = F.transform(F.col(hits_), lambda h: F.struct(
        h["value"].alias("value"), h["kind"].alias("kind"),
        pseudonym(h["value"], h["kind"], key).alias("new")))
    joined = F.concat(F.array_join(F.transform(
        F.col(made_), lambda m, i: F.concat(F.get(F.col(gaps_), i),
                                            F.coalesce(m["new"], m["value"]))), ""),
        F.element_at(F.col(gaps_), -1))
    may = F.col("text").rlike(r"@|\d")
    found = F.size(hits_) > 0
    out = (docs.withColumn(hits_, F.when(may, hits))
           .withColumn(made_, F.when(found, made))
           .withColumn(gaps_, F.when(found, F.split("text", ANY, -1)))
           .withColumn("text", F.when(found, joined).otherwise(F.col("text"))))
    for name in KINDS:
        out = out.withColumn(f"pii_{name}", F.coalesce(F.size(F.filter(
            F.col(made_), _replaced(name))),
            F.lit(0)).cast("long"))
    return out.drop(hits_, made_, gaps_)
