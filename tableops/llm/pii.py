"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses, in DataFrame functions only.

Texts are split at one pattern; each match is validated (Luhn for cards, number-plan rules for phones, octets for
IPv4 addresses, area rules for social security numbers, the calendar for dates) and a valid one is replaced by a
keyed permutation of itself within its format: digits stay digits, a card stays Luhn-valid, a date stays a date.
The permutation depends on the key and the kind only, so equal values get equal pseudonyms in all documents and
different values get different ones, and it can be undone with the key.

The Feistel network works on arrays of digits of mixed radix: in each of ``ROUNDS`` rounds one half gets a keyed
hash of the other half added, digit by digit, modulo each digit's radix.

Nulls and ties: a null text stays null with counts 0; matches do not overlap, the leftmost one counts and at one
place the first kind listed in ``KINDS``; values that fail validation stay as they are. Of a run of digits in groups,
any sequence of whole groups may be the card. A pseudonym next to other groups can pass Luhn together with them by
chance (one in ten a sequence of 13 to 19 digits); such a run is not undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_YEAR, _MONTH, _DAY = "(?:1[89]|2[01])[0-9]{2}", "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12][0-9]|3[01])"
#: year first with - or /, day first with a dot, either first with - or /
_DATES = "|".join(
    [f"{_YEAR}{x}{_MONTH}{x}{_DAY}" for x in "-/"] + [f"{_DAY}[.]{_MONTH}[.]{_YEAR}"]
    + [f"(?:{_MONTH}{x}{_DAY}|{_DAY}{x}{_MONTH}){x}{_YEAR}" for x in "-/"]
)
_DIGIT = r"(?:[ .-]?\(?[0-9](?:\)(?=[ .-]?[0-9]))?)"
#: +1 and ten digits; + and another country code, 8 to 15 digits in all; without a code by the number plan
_PHONES = (
    rf"\+1{_DIGIT}{{10}}|\+[2-9]{_DIGIT}{{7,14}}"
    r"|\([2-9][0-9]{2}\)[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{4}|[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4}"
)
#: Country codes of one and two digits; the others have three.
_CODE = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
#: kind -> pattern, tried in this order at each place
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "date": rf"(?<![0-9/.-])(?:{_DATES})(?![0-9/-])",
    "phone": rf"(?<![0-9+])(?:{_PHONES})(?![0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
}
#: a whole run of groups of digits, up to one that begins a value of another kind
KINDS["card"] = rf"(?<![0-9])[0-9](?:(?:[ -](?!{KINDS['date']}|{KINDS['phone']}|{KINDS['ssn']}))?[0-9]){{12,}}+(?![0-9])"
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: Dates from 1800-01-01 to 2199-12-31 are 4800 months: 57600 = 240 * 240 days up to the 12th of a month, 88497 = 9 * 9833
#: after it. Either class is permuted within itself, whatever the layout: a day that only as a day can stand first
#: stays one, and a date has one pseudonym in all layouts.
FIRST_DAY, EARLY_RADIX, LATE_RADIX = "1800-01-01", (240, 240), (9, 9833)

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _kind(m: Column) -> Column:
    """The kind whose pattern matches at the start of ``m`` first; null when it fails validation.

    A run of digits is a ``card`` here; which of its groups make up cards is for ``_runs`` to say.
    """
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("int"))
    iso = _iso(m)
    day = F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date")
    valid = {
        "email": F.lit(True),
        "date": F.coalesce(F.date_format(day, "yyyy-MM-dd") == iso, F.lit(False)),
        "phone": F.lit(True),
        "ssn": F.lit(True),
        "ip": F.forall(octets, lambda o: o <= 255),
        "card": F.lit(True),
    }
    shape = {
        "email": m.contains("@"),
        "date": m.rlike(f"^(?:{_DATES})$"),
        "phone": m.rlike("^(?:" + KINDS["phone"] + ")$"),
        "ssn": m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        "ip": m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"),
        "card": F.lit(True),
    }
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(shape[kind], F.when(valid[kind], F.lit(kind))).otherwise(out)
    return out


def _part(m: Column, a: int, n: int) -> Column:
    return F.substr(m, F.lit(a), F.lit(n))


def _day_first(m: Column) -> Column:
    """Whether a date with the year last has its day first: with dots, or where the first number is no month."""
    return (_part(m, 3, 1) == ".") | (_part(m, 1, 2) > "12")


def _iso(m: Column) -> Column:
    """A date of any layout as yyyy-MM-dd."""
    last = F.when(_day_first(m), F.concat_ws("-", _part(m, 7, 4), _part(m, 4, 2), _part(m, 1, 2))).otherwise(
        F.concat_ws("-", _part(m, 7, 4), _part(m, 1, 2), _part(m, 4, 2))
    )
    return F.when(m.rlike("^[0-9]{4}"), F.concat_ws("-", _part(m, 1, 4), _part(m, 6, 2), _part(m, 9, 2))).otherwise(last)


def _like(m: Column, day: Column) -> Column:
    """The date ``day`` in the layout of ``m``."""
    y, mo, d = (F.date_format(day, x) for x in ("yyyy", "MM", "dd"))
    early, late = _part(m, 3, 1), _part(m, 5, 1)
    last = F.when(_day_first(m), F.concat(d, early, mo, early, y)).otherwise(F.concat(mo, early, d, early, y))
    return F.when(m.rlike("^[0-9]{4}"), F.concat(y, late, mo, late, d)).otherwise(last)


def _digits(m: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(m, "[^0-9]", ""), ""), lambda c: c.cast("int"))


def luhn_digit(digits: Column, whole: bool) -> Column:
    """The Luhn sum of ``digits`` modulo 10 (``whole``), or the check digit that makes it 0 when appended."""
    odd = 1 if whole else 0

    def add(acc: Column, x: Column) -> Column:
        doubled = x["d"] * 2
        return acc + F.when(F.pmod(x["i"], F.lit(2)) == odd, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(x["d"])

    numbered = F.transform(F.reverse(digits), lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    total = F.aggregate(numbered, F.lit(0), add)
    return F.pmod(total, F.lit(10)) if whole else F.pmod(-total, F.lit(10))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def feistel(values: Column, radix: Column, key: str, tweak: Column, undo: bool = False) -> Column:
    """The keyed permutation of an array of digits; ``radix`` gives the base of each. Halves alternate."""
    return _let(F.struct(values.alias("v"), radix.alias("r")), lambda x: _feistel(x["v"], x["r"], key, tweak, undo))


def _feistel(values: Column, radix: Column, key: str, tweak: Column, undo: bool) -> Column:
    half = F.floor(F.size(values) / 2).cast("int")

    def turn(v: Column, k: Column) -> Column:
        first = F.pmod(k, F.lit(2)) == 0
        other = F.when(first, F.slice(v, half + 1, F.greatest(F.size(v) - half, F.lit(0)))).otherwise(F.slice(v, 1, half))
        mask = F.md5(F.concat_ws(":", F.lit(key), tweak, k.cast("string"), F.concat_ws(",", F.transform(other, lambda x: x.cast("string")))).cast("binary"))

        def digit(x: Column, i: Column) -> Column:
            add = F.conv(F.substr(mask, F.pmod(i * 5, F.lit(26)) + 1, F.lit(6)), 16, 10).cast("int")
            return F.when((i < half) == first, F.pmod(x - add if undo else x + add, F.get(radix, i))).otherwise(x)

        return F.transform(v, digit)

    order = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if undo else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(order, values, turn)


def _spelled(m: Column, part: Column, key: str, tweak: str, low: Column | None = None, undo: bool = False) -> Column:
    """``m`` with the characters of its substring ``part`` (from the end on) permuted class by class.

    ``low(i)`` marks places where a digit of at least 2, as in a number plan, stays one and a smaller one stays small.
    """
    chars = F.filter(F.split(part, ""), lambda c: c != "")

    def entry(c: Column, i: Column) -> Column:
        base = F.when(low(i), F.when(c.isin("0", "1"), F.lit("01")).otherwise(F.lit("23456789"))).otherwise(F.lit(_DIGITS)) if low else F.lit(_DIGITS)
        alphabet = (
            F.when(c.rlike("[0-9]"), base).when(c.rlike("[a-z]"), F.lit(_LOWER)).when(c.rlike("[A-Z]"), F.lit(_UPPER)).otherwise(c)
        )
        return F.struct(alphabet.alias("a"), (F.position(c, alphabet) - 1).alias("v"))

    entries = F.transform(chars, entry)
    values = F.transform(entries, lambda e: e["v"])
    radix = F.transform(entries, lambda e: F.length(e["a"]))
    moved = feistel(values, radix, key, F.lit(tweak), undo)
    return F.array_join(F.zip_with(moved, entries, lambda v, e: F.substr(e["a"], v + 1, F.lit(1))), "")


def _fill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in order by the characters of ``digits``."""
    text = F.regexp_replace(m, "[^0-9]", "")
    # each character of m that is a digit takes the next of the new ones
    numbered = F.transform(
        F.filter(F.split(m, ""), lambda c: c != ""),
        lambda c, i: F.when(
            c.rlike("[0-9]"), F.substr(digits, F.length(F.regexp_replace(F.substr(m, F.lit(1), i + 1), "[^0-9]", "")), F.lit(1))
        ).otherwise(c),
    )
    return F.when(F.length(text) == F.length(digits), F.array_join(numbered, "")).otherwise(m)


def _moved_day(day: Column, key: str, undo: bool) -> Column:
    """The date at the permuted place among those up to the 12th of a month, or among those after it."""
    first = F.lit(FIRST_DAY).cast("date")

    def moved(at: Column, radix: tuple[int, int], tweak: str) -> Column:
        a, b = radix
        pair = _let(at, lambda x: F.array(F.floor(x / b).cast("int"), F.pmod(x, F.lit(b))))
        return _let(feistel(pair, F.array(F.lit(a), F.lit(b)), key, F.lit(tweak), undo), lambda out: out[0] * b + out[1])

    def late(place: Column) -> Column:
        # the last month that has no more late days before it than the place says; about the average
        before = lambda n: F.datediff(F.add_months(first, n), first) - 12 * n
        near = F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda x: F.floor(place * 4800 / (LATE_RADIX[0] * LATE_RADIX[1])).cast("int") + x)
        month = F.array_max(F.filter(near, lambda n: (n >= 0) & (n < 4800) & (before(n) <= place)))
        return _let(month, lambda n: F.date_add(F.add_months(first, n), 12 + place - before(n)))

    def early(place: Column) -> Column:
        return F.date_add(F.add_months(first, F.floor(place / 12).cast("int")), F.pmod(place, F.lit(12)))

    def of_day(d: Column) -> Column:
        months = (F.year(d) - F.lit(int(FIRST_DAY[:4]))) * 12 + F.month(d) - 1
        return F.when(F.dayofmonth(d) > 12, _let(moved(F.datediff(d, first) - 12 * (months + 1), LATE_RADIX, "late"), late)).otherwise(
            _let(moved(months * 12 + F.dayofmonth(d) - 1, EARLY_RADIX, "early"), early)
        )

    return _let(day, of_day)


def _runs(m: Column) -> Column:
    """The groups of a run of digits as ``array<struct<t, card>>``: from left to right the longest sequence of whole
    groups with 13 to 19 digits that passes Luhn is a card; groups keep the separator after them."""
    groups = F.split(m, "(?<=[ -])")
    none = F.array().cast("array<struct<t:string,card:boolean>>")

    def runs(g: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            def run(j: Column) -> Column:
                return F.struct(j.alias("j"), F.array_join(F.slice(g, i + 1, j - i + 1), "").alias("t"))

            ends = F.transform(F.sequence(F.least(i + 18, F.size(g) - 1), i, F.lit(-1)), run)
            sized = F.filter(ends, lambda r: F.length(F.regexp_replace(r["t"], "[^0-9]", "")).between(13, 19))
            valid = F.get(F.filter(sized, lambda r: luhn_digit(_digits(r["t"]), True) == 0), F.lit(0))
            found = _let(
                valid,
                lambda r: F.struct(
                    F.coalesce(r["j"], i).cast("int").alias("upto"),
                    F.concat(acc["out"], F.array(F.struct(F.coalesce(r["t"], F.get(g, i)).alias("t"), r["t"].isNotNull().alias("card")))).alias("out"),
                ),
            )
            return F.when(i <= acc["upto"], acc).otherwise(found)

        start = F.struct(F.lit(-1).alias("upto"), none.alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(g) - 1), start, step, lambda a: a["out"])

    return _let(groups, runs)


def _kinds(m: Column) -> Column:
    """The kinds of the values in one match: one or none, but as many cards as a run of digits holds."""
    cards = F.transform(F.filter(_runs(m), lambda r: r["card"]), lambda _: F.lit("card"))
    return _let(_kind(m), lambda k: F.when(k == "card", cards).otherwise(F.array(k)))


def pseudonym(m: Column, key: str, undo: bool = False) -> Column:
    """The pseudonym of one validated value; other values as they are."""
    kind = _kind(m)
    local = F.substring_index(m, "@", 1)
    email = F.concat(_spelled(m, local, key, "email", undo=undo), F.substr(m, F.length(local) + 1, F.length(m)))

    written = F.regexp_replace(m, "[^0-9]", "")
    code = F.when(m.startswith("+"), F.regexp_extract(written, _CODE, 0)).otherwise(F.lit(""))
    national = F.substr(written, F.length(code) + 1, F.length(written))
    planned = ~m.startswith("+") | (code == "1")
    phone_digits = _let(
        national, lambda n: _spelled(m, n, key, "phone", low=lambda i: planned & ((i == 0) | (i == 3)), undo=undo)
    )
    phone = _let(F.concat(code, phone_digits), lambda d: _fill(m, d))

    def card_of(t: Column) -> Column:
        digits = _digits(t)
        ten = F.transform(digits, lambda _: F.lit(10))
        payload = F.slice(digits, 1, F.size(digits) - 1)
        moved = feistel(payload, ten, key, F.lit("card"), undo)
        return _let(moved, lambda x: _fill(t, F.array_join(F.concat(x, F.array(luhn_digit(x, False))).cast("array<string>"), "")))

    card = F.array_join(F.transform(_runs(m), lambda r: F.when(r["card"], card_of(r["t"])).otherwise(r["t"])), "")

    # the area and group numbers have gaps: permute the serial 1..9999 and the group 1..99, leave the area
    ssn_values = F.array(F.substr(m, F.lit(5), F.lit(2)).cast("int") - 1, F.substr(m, F.lit(8), F.lit(4)).cast("int") - 1)
    ssn_moved = feistel(ssn_values, F.array(F.lit(99), F.lit(9999)), key, F.lit("ssn"), undo)
    ssn = F.format_string("%s-%02d-%04d", F.substr(m, F.lit(1), F.lit(3)), ssn_moved[0] + 1, ssn_moved[1] + 1)

    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("int"))
    o = lambda i: F.get(octets, F.lit(i))
    ip_moved = feistel(
        F.array(o(0) * 256 + o(1), o(2) * 256 + o(3)), F.array(F.lit(65536), F.lit(65536)), key, F.lit("ip"), undo
    )
    ip = F.concat_ws(
        ".", *[x.cast("string") for h in (ip_moved[0], ip_moved[1]) for x in (F.floor(h / 256).cast("int"), F.pmod(h, F.lit(256)))]
    )

    day = F.try_to_timestamp(_iso(m), F.lit("yyyy-MM-dd")).cast("date")
    date = _let(_moved_day(day, key, undo), lambda d: _like(m, d))

    made = {"email": email, "date": date, "phone": phone, "ssn": ssn, "ip": ip, "card": card}

    def chosen(name: Column) -> Column:
        out = m
        for k in reversed(KINDS):
            out = F.when(name == k, made[k]).otherwise(out)
        return out

    return _let(kind, chosen)


def _count(array: str, value: str) -> Column:
    return F.size(F.filter(array, lambda x: x == value))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", undo: bool = False) -> DataFrame:
    """One row per row: ``id_col, n_<kind> ..., text`` with every valid value replaced."""
    text = F.col("t")
    parts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).select(
        "id",
        "t",
        F.when(text.rlike(PATTERN), F.split(text, PATTERN, -1)).alias("pieces"),
        F.when(text.rlike(PATTERN), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).alias("found"),
    )
    named = parts.withColumn("kinds", F.flatten(F.transform("found", _kinds))).withColumn(
        "made", F.transform("found", lambda m: pseudonym(m, key, undo))
    )
    whole = F.array_join(F.flatten(F.transform(F.arrays_zip("pieces", "made"), lambda x: F.array(x["pieces"], F.coalesce(x["made"], F.lit(""))))), "")
    return named.select(
        F.col("id").alias(id_col),
        *[
            F.when(F.col("found").isNull(), F.lit(0)).otherwise(_count("kinds", name)).cast("long").alias(f"n_{name}")
            for name in KINDS
        ],
        F.when(F.col("found").isNull(), F.col("t")).otherwise(whole).alias("text"),
    )
