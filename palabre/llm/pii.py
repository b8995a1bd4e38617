"""Format-preserving pseudonyms for private values, in SQL functions.

Values are found by one regular expression and validated by kind. Numbers and dates are
permuted by a keyed Feistel network over exactly the values of their format: a card
number becomes another one with a right check digit, a date another date. The same value
gives the same pseudonym in every document, and different values different ones. E-mail
names and secrets become keyed digests in the same form. What doesn't validate stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# How long the account numbers of each country are.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD TG",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(
    f"(?:{'|'.join(countries.split())})[0-9]{{2}}(?:[ ]?[A-Z0-9]){{{n - 4}}}" for n, countries in IBAN_LENGTHS.items()
)
_KNOWN = rf"\b(?:{_KNOWN})\b"
# Other countries, up to where a number of known length begins.
_UNKNOWN = (
    rf"\b(?!{'|'.join(' '.join(IBAN_LENGTHS.values()).split())})[A-Z]{{2}}[0-9]{{2}}"
    rf"(?:[ ]?(?!{_KNOWN})[A-Z0-9]{{4}}){{2,7}}(?:[ ]?(?!{_KNOWN})[A-Z0-9]{{1,3}})?\b"
)
# The forms in which private values are written, the first that fits counts.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
FORMS = {
    "secret": r"(?<![A-Za-z0-9])(?i:token|secret|passwd|password|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_-]{16,}+",
    # Possessive throughout: a group that can give back recurses once for each label.
    "email": r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)++",
    "iban": f"{_KNOWN}|{_UNKNOWN}",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    # With a plus 7 to 15 digits in any groups; three groups with blanks only if no more stand beside them.
    "phone": r"(?<![0-9+])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ ]?[0-9]{3,4}[ .-]?[0-9]{3,4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})"
    r"|\+[1-9](?:[ .()-]{0,2}[0-9]){6,14}|(?<![0-9][ .-])[0-9]{3} [0-9]{3} [0-9]{4}(?! ?[0-9]))(?![0-9])",
}
#: A whole run of groups of digits, up to a group that another form begins with. Card numbers are looked for within.
FORMS["card"] = (
    r"(?<![0-9])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++"
    rf"(?:[ -](?!{'|'.join(FORMS[k] for k in ('ip', 'date', 'ssn', 'phone'))})[0-9]++)*+"
)
#: Forms with letters go first; what fails of them is searched for those of digits.
LETTERS, DIGITS = ("secret", "email", "iban"), ("ip", "date", "ssn", "phone", "card")
#: What any private value has; other texts aren't searched.
HINT = r"[0-9@=:]"
LETTERS_HINT = r"[@=:]|[A-Z]{2}[0-9]{2}"
LETTERS_PATTERN, DIGITS_PATTERN = ("|".join(f"(?:{FORMS[k]})" for k in kinds) for kinds in (LETTERS, DIGITS))
# First digits and lengths of the common brands of cards.
BRANDS = (
    r"^(?:4[0-9]{12}(?:[0-9]{3}){0,2}|(?:5[1-5]|2[2-7])[0-9]{14}|3[47][0-9]{13}|3(?:0[0-5]|[689][0-9])[0-9]{11}"
    r"|35[0-9]{14,17}|6(?:011|[245][0-9]{2})[0-9]{12,15})$"
)
CARD_DIGITS = range(13, 20)
# A group that a number of these brands may begin with.
BRAND_START = r"^[ -]?(?:4[0-9]|5[1-5]|2[2-7]|3[0-9]|6[0-9])[0-9]{2}(?:[0-9]{9,15})?$"
# How card numbers are grouped.
UNBROKEN = "^[0-9]+$"
GROUPED = r"^[0-9]{4}(?:([ -])[0-9]{4}(?:\1[0-9]{4}){2}(?:\1[0-9]{1,3})?|([ -])[0-9]{6}\2[0-9]{4,5})$"
#: Groups for each card number found; a longer run of digits is a table of figures.
MOST_GROUPS = 11


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _round(key: str, kind: str, i: Column, half: Column) -> Column:
    """The keyed round function: 52 bits of a digest."""
    text = F.concat_ws(":", F.lit(key), F.lit(kind), i.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def feistel(
    left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str, back: bool = False
) -> Column:
    """A keyed permutation of the pairs below both sizes, as ``struct(l, r)``.

    Halves are changed in turns by adding a function of the other one, so every round
    can be undone, whatever the sizes: ``back`` does.
    """
    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    sign = -1 if back else 1
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def step(s: Column, i: Column) -> Column:
        l, r = s["l"], s["r"]
        changed_l = F.pmod(l + sign * _round(key, kind, i, r), left_size.cast("long"))
        changed_r = F.pmod(r + sign * _round(key, kind, i, l), right_size.cast("long"))
        odd = i % 2 == 1
        return F.struct(F.when(odd, changed_l).otherwise(l).alias("l"), F.when(odd, r).otherwise(changed_r).alias("r"))

    return F.aggregate(rounds, start, step)


def permuted_digits(digits: Column, key: str, kind: str, back: bool = False) -> Column:
    """A permutation of the digit texts of each length from 2 to 36."""

    def run(d: Column) -> Column:
        n = F.length(d)
        a = F.floor(n / 2).cast("int")
        sizes = F.pow(F.lit(10), a).cast("long"), F.pow(F.lit(10), n - a).cast("long")
        halves = F.substr(d, F.lit(1), a), F.substr(d, a + 1)
        return let(
            feistel(*[h.cast("long") for h in halves], *sizes, key, f"{kind}", back),
            lambda s: F.concat(F.lpad(s["l"].cast("string"), a, "0"), F.lpad(s["r"].cast("string"), n - a, "0")),
        )

    return let(digits, run)


def _refill(text: Column, digits: Column) -> Column:
    """The text with its digits replaced one by one, all else in its place."""

    def put(state: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        own = F.when(is_digit, F.substr(state["d"], F.lit(1), F.lit(1))).otherwise(c)
        rest = F.when(is_digit, F.substr(state["d"], F.lit(2))).otherwise(state["d"])
        return F.struct(F.concat(state["s"], own).alias("s"), rest.alias("d"))

    start = F.struct(F.lit("").alias("s"), digits.alias("d"))
    return F.aggregate(F.split(text, ""), start, put, lambda state: state["s"])


def _luhn_sum(digits: Column) -> Column:
    """The weighted sum of a digit text, the last digit counting once."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, -i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    return F.aggregate(places, F.lit(0), add)


def _valid_card(digits: Column) -> Column:
    return (_luhn_sum(digits) % 10 == 0) & digits.rlike("[1-9]")


def _card(text: Column, key: str, back: bool) -> Column:
    def run(d: Column) -> Column:
        payload = F.substr(d, F.lit(1), F.length(d) - 1)

        def checked(p: Column) -> Column:
            check = F.pmod(-_luhn_sum(F.concat(p, F.lit("0"))), F.lit(10))
            return _refill(text, F.concat(p, check.cast("string")))

        return let(permuted_digits(payload, key, "card", back), checked)

    return let(_digits(text), run)


def _card_sizes(groups: Column) -> Column:
    """For each group of digits how many groups the longest card number that begins there has, or 0.

    Card numbers here are of a brand, with a right check digit, unbroken or in usual groups.
    """

    def fits(text: Column) -> Column:
        form = text.rlike(UNBROKEN) | text.rlike(GROUPED)
        return form & let(_digits(text), lambda d: d.rlike(BRANDS) & _valid_card(d))

    def size(i: Column) -> Column:
        def is_card(k: Column) -> Column:
            return (i + k <= F.size(groups)) & fits(F.ltrim(F.array_join(F.slice(groups, i + 1, k), ""), F.lit(" -")))

        return F.coalesce(F.get(F.filter(F.array(*map(F.lit, (5, 4, 3, 1))), is_card), F.lit(0)), F.lit(0))

    return F.transform(groups, lambda g, i: F.when(g.rlike(BRAND_START), size(i)).otherwise(F.lit(0)))


#: Groups that are walked through at once.
_BLOCK = 64


def _leftmost(sizes: Column) -> Column:
    """The sizes of the spans that overlap none before them, from left to right; 0 for others.

    A first walk only notes where it enters each block, a second one is made in every block
    from there, so neither carries along what it has found.
    """
    last = F.size(sizes) - 1
    blocks = F.sequence(F.lit(0), F.floor(last / _BLOCK).cast("int"))

    def places(block: Column) -> Column:
        return F.sequence(block * _BLOCK, F.least(block * _BLOCK + (_BLOCK - 1), last))

    def begins(free: Column, i: Column) -> Column:
        return (i >= free) & (F.get(sizes, i) > 0)

    def step(free: Column, i: Column) -> Column:
        return F.when(begins(free, i), i + F.get(sizes, i)).otherwise(free)

    def enter(state: Column, block: Column) -> Column:
        return F.struct(
            F.aggregate(places(block), state["free"], step).alias("free"),
            F.concat(state["entries"], F.array(state["free"])).alias("entries"),
        )

    def walk(state: Column, i: Column) -> Column:
        own = F.when(begins(state["free"], i), F.get(sizes, i)).otherwise(F.lit(0))
        return F.struct(step(state["free"], i).alias("free"), F.concat(state["own"], F.array(own)).alias("own"))

    nothing = F.array().cast("array<int>")
    entered = F.aggregate(blocks, F.struct(F.lit(0).alias("free"), nothing.alias("entries")), enter, lambda s: s["entries"])

    def within(entries: Column) -> Column:
        return F.flatten(
            F.transform(
                blocks,
                lambda b: F.aggregate(
                    places(b), F.struct(F.get(entries, b).alias("free"), nothing.alias("own")), walk, lambda s: s["own"]
                ),
            )
        )

    return let(entered, within)


def _among(groups: Column, key: str, back: bool) -> Column:
    """The card numbers among groups of digits replaced, as ``struct(s, n)`` with their number.

    One that overlaps an earlier one is left. Only unbroken ones count if there are many
    more groups than card numbers, which is a table of figures. Each group is looked at with
    its next ones alone, so that very long tables take time in proportion.
    """

    def put(sizes: Column) -> Column:
        def one(group: Column, i: Column) -> Column:
            span = F.array_join(F.slice(groups, i + 1, F.get(sizes, i)), "")
            gap = F.regexp_extract(group, "^[ -]?", 0)
            card = F.concat(gap, _card(F.substr(span, F.length(gap) + 1), key, back))
            covered = [F.coalesce(F.get(sizes, i - j) > j, F.lit(False)) for j in range(1, 5)]
            within = covered[0] | covered[1] | covered[2] | covered[3]
            return F.when(F.get(sizes, i) > 0, card).when(within, "").otherwise(group)

        return F.struct(
            F.array_join(F.transform(groups, one), "").alias("s"),
            F.size(F.filter(sizes, lambda n: n > 0)).alias("n"),
        )

    def no_table(sizes: Column) -> Column:
        many = F.size(sizes) > MOST_GROUPS * F.size(F.filter(sizes, lambda n: n > 0))
        return F.when(many, F.transform(sizes, lambda n: F.when(n == 1, n).otherwise(F.lit(0)))).otherwise(sizes)

    return let(let(let(_card_sizes(groups), _leftmost), no_table), put)


def _cards(text: Column, key: str, back: bool) -> Column:
    """The card numbers of a run of digits, as ``struct(s, n)``.

    That is the run itself if it is one: unbroken, in usual groups, or with the first digits
    of a brand. Otherwise those among its groups.
    """

    def run(d: Column) -> Column:
        form = text.rlike(UNBROKEN) | text.rlike(GROUPED) | d.rlike(BRANDS) | F.lit(back)
        whole = F.length(d).between(CARD_DIGITS[0], CARD_DIGITS[-1]) & form & _valid_card(d)
        among = let(F.regexp_extract_all(text, F.lit("[ -]?[0-9]+"), 0), lambda g: _among(g, key, back))
        return F.when(whole, F.struct(_card(text, key, back).alias("s"), F.lit(1).alias("n"))).otherwise(among)

    return let(_digits(text), run)


def _phone(text: Column, key: str, back: bool) -> Column:
    """All digits but those of the country code (the first two where nothing ends it)."""
    code = F.regexp_extract(text, r"^(\+[0-9]{1,3}(?=[ .(-])|\+[0-9]{2})?", 0)
    return let(code, lambda c: F.concat(c, let(F.substr(text, F.length(c) + 1), lambda r: _refill(r, permuted_digits(_digits(r), key, "phone", back)))))


def _ssn(text: Column, key: str, back: bool) -> Column:
    valid = ~text.rlike(r"^(?:000|666|9..)|-00-|-0000$")
    return F.when(valid, _walk(text, key, "ssn", back)).otherwise(text)


def _walk(text: Column, key: str, kind: str, back: bool) -> Column:
    """Valid social security numbers as pairs: 898 areas by 99 groups times 9999 serials."""
    area, group, serial = (F.substring(text, p, n).cast("long") for p, n in ((1, 3), (5, 2), (8, 4)))
    place = area - 1 - (area > 666).cast("long")
    rest = (group - 1) * 9999 + serial - 1

    def made(s: Column) -> Column:
        own = s["l"] + 1 + (s["l"] >= 665).cast("long")
        parts = ((own, 3), (F.floor(s["r"] / 9999) + 1, 2), (s["r"] % 9999 + 1, 4))
        return F.concat_ws("-", *[F.lpad(v.cast("string"), n, "0") for v, n in parts])

    return let(feistel(place, rest, F.lit(898), F.lit(99 * 9999), key, kind, back), made)


def _ip(text: Column, key: str, back: bool) -> Column:
    def run(parts: Column) -> Column:
        o = [F.get(parts, F.lit(i)).cast("long") for i in range(4)]

        def made(s: Column) -> Column:
            values = [F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256]
            return F.concat_ws(".", *[v.cast("string") for v in values])

        size = F.lit(65536)
        return let(feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], size, size, key, "ip", back), made)

    return let(F.split(text, r"\."), run)


#: The days of 1800 to 2199, a whole cycle of the calendar: 189 * 773.
_FIRST, _DAYS = "1800-01-01", (189, 773)


def _date(text: Column, key: str, back: bool) -> Column:
    iso = text.rlike("^[0-9]{4}-")
    year, month, day = F.substr(text, F.lit(7), F.lit(4)), F.substr(text, F.lit(4), F.lit(2)), F.substr(text, F.lit(1), F.lit(2))
    plain = F.when(iso, text).otherwise(F.concat_ws("-", year, month, day))
    # Days first, months first if that is no date.
    swapped = F.concat_ws("-", year, day, month)
    first = plain.try_cast("date")
    second = F.when(~iso, swapped.try_cast("date"))

    def run(value: Column) -> Column:
        n = F.datediff(value, F.lit(_FIRST).cast("date"))

        def made(s: Column) -> Column:
            new = F.date_add(F.lit(_FIRST).cast("date"), (s["l"] * _DAYS[1] + s["r"]).cast("int"))
            order = F.when(iso, F.date_format(new, "yyyyMMdd")).otherwise(
                F.when(first.isNotNull(), F.date_format(new, "ddMMyyyy")).otherwise(F.date_format(new, "MMddyyyy"))
            )
            return _refill(text, order)

        inside = value.isNotNull() & (F.year(value) >= 1800) & (F.year(value) < 2200)
        sizes = F.lit(_DAYS[0]), F.lit(_DAYS[1])
        halves = F.floor(n / _DAYS[1]), n % _DAYS[1]
        return F.when(inside, let(feistel(*halves, *sizes, key, "date", back), made)).otherwise(text)

    return let(F.coalesce(first, second), run)


def _mod97(text: Column) -> Column:
    """The remainder of an account number, its letters counting 10 to 35."""

    def add(total: Column, c: Column) -> Column:
        letter = c.rlike("[A-Z]")
        value = F.when(letter, F.ascii(c) - 55).otherwise(c.try_cast("int"))
        return (total * F.when(letter, 100).otherwise(10) + value) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(text: Column, key: str, back: bool) -> Column:
    """NULL for one that isn't valid."""

    def run(plain: Column) -> Column:
        country, own = F.substring(plain, 1, 2), F.substr(plain, F.lit(5))
        valid = (_mod97(F.concat(own, F.substring(plain, 1, 4))) == 1) & (F.length(_digits(own)) >= 2)

        def made(d: Column) -> Column:
            def checked(new: Column) -> Column:
                check = 98 - _mod97(F.concat(new, country, F.lit("00")))
                digits = F.concat(F.lpad(check.cast("string"), 2, "0"), d)
                return _refill(text, digits)

            return let(_refill(own, d), checked)

        return F.when(valid, let(permuted_digits(_digits(own), key, "iban", back), made))

    return let(F.replace(text, F.lit(" "), F.lit("")), run)


def _keyed(text: Column, key: str, kind: str) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), text), 256)


def _email(text: Column, key: str, back: bool) -> Column:
    digest = _keyed(F.lower(text), key, "email")
    return F.concat(F.lit("user-"), F.substring(digest, 1, 16), F.lit("@mail.invalid"))


def _secret(text: Column, key: str, back: bool) -> Column:
    head = F.regexp_extract(text, r"^[A-Za-z_-]+[\"']?\s{0,3}[=:]\s{0,3}[\"']?", 0)

    def run(h: Column) -> Column:
        value = F.substr(text, F.length(h) + 1)
        digest = _keyed(value, key, "secret")
        return F.concat(h, F.substr(F.repeat(digest, F.ceil(F.length(value) / 64).cast("int")), F.lit(1), F.length(value)))

    return let(head, run)


_MAKERS = {
    "secret": _secret, "email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone,
    "card": lambda text, key, back: _cards(text, key, back)["s"],
}


def _has_form(value: Column, kind: str) -> Column:
    return value.rlike(f"^(?:{FORMS[kind]})$")


def pseudonym(value: Column, key: str, back: bool = False) -> Column:
    """The pseudonym of a found value, by the first kind whose form it has.

    ``back`` turns pseudonyms of numbers and dates into the values again; e-mail addresses
    and secrets can't be had back.
    """
    out = value
    for kind, maker in reversed(_MAKERS.items()):
        if back and kind in ("secret", "email"):
            continue
        made = F.coalesce(maker(value, key, back), value) if kind == "iban" else maker(value, key, back)
        out = F.when(_has_form(value, kind), made).otherwise(out)
    return out


def _lettered(value: Column, key: str) -> Column:
    """The pseudonym of a value whose form has letters, NULL if it isn't valid."""
    out = F.lit(None).cast("string")
    for kind in reversed(LETTERS):
        out = F.when(_has_form(value, kind), _MAKERS[kind](value, key, False)).otherwise(out)
    return out


def _digital(text: Column, key: str) -> Column:
    """The text with all values of digits replaced, as ``struct(s, n)`` with their number."""

    def one(value: Column) -> Column:
        # A run of digits with no card number in it is of private form, too.
        def counted(c: Column) -> Column:
            return F.struct(c["s"].alias("s"), F.greatest(c["n"], F.lit(1)).alias("n"))

        out = F.struct(value.alias("s"), F.lit(0).alias("n"))
        for kind in reversed(DIGITS):
            if kind == "card":
                made = let(_cards(value, key, False), counted)
            else:
                made = F.struct(_MAKERS[kind](value, key, False).alias("s"), F.lit(1).alias("n"))
            out = F.when(_has_form(value, kind), made).otherwise(out)
        return out

    def put(made: Column) -> Column:
        pieces = F.zip_with(
            F.split(text, DIGITS_PATTERN, -1), made, lambda b, m: F.concat(b, F.coalesce(m["s"], F.lit("")))
        )
        n = F.aggregate(made, F.lit(0), lambda total, m: total + m["n"])
        return F.struct(F.array_join(pieces, "").alias("s"), n.alias("n"))

    found = let(F.transform(F.regexp_extract_all(text, F.lit(DIGITS_PATTERN), 0), one), put)
    return F.when(text.rlike("[0-9]"), found).otherwise(F.struct(text.alias("s"), F.lit(0).alias("n")))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", counted: str | None = None) -> DataFrame:
    """The documents with private values of ``text`` replaced, all columns and rows kept.

    ``counted`` names a column that is added: how many values of private form were found.
    A NULL text stays NULL, a text without private values stays as it is; whole texts are
    searched. Every row is worked on by itself, so repeated rows stay equal and an empty
    table stays empty. Secrets, e-mail addresses and valid account numbers go first, what
    is between them is searched for numbers and dates. Of values that overlap the leftmost
    counts. Digits and capitals beside a valid card or account number don't hide it. A date
    with slashes is read as day/month/year, or month/day/year if that is no date.
    """
    column = F.col(f"`{text}`")
    # Several steps, so that values and what is between them are found once each.
    found = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.when(column.rlike(LETTERS_HINT), F.regexp_extract_all(column, F.lit(LETTERS_PATTERN), 0)).alias("values"),
    )
    own, some = F.col("row").getField(text), F.size("values") > 0
    made = found.select("row", "values", F.when(some, F.transform("values", lambda v: _lettered(v, key))).alias("made"))
    parts = F.flatten(
        F.zip_with(F.split(own, LETTERS_PATTERN, -1), "values", lambda b, v: F.array(b, F.coalesce(v, F.lit(""))))
    )
    # The numbers of the valid values, -1 before and their count behind them.
    cuts = F.concat(
        F.array(F.lit(-1)),
        F.filter(F.sequence(F.lit(0), F.size("made") - 1), lambda i: F.get("made", i).isNotNull()),
        F.array(F.size("made")),
    )
    parted = made.select("row", "made", F.when(some, parts).alias("parts"), F.when(some, cuts).alias("cuts"))

    def left(i: Column) -> Column:
        """What is between two valid values, those that aren't valid included."""
        before, after = F.get("cuts", i), F.get("cuts", i + 1)
        return F.array_join(F.slice("parts", 2 * before + 3, 2 * (after - before) - 1), "")

    some_made = F.size("made") > 0
    free = F.when(some_made, F.transform(F.sequence(F.lit(0), F.size("cuts") - 2), left)).otherwise(
        F.array(own)
    )
    valid = F.when(some_made, F.filter("made", lambda m: m.isNotNull())).otherwise(F.array().cast("array<string>"))
    searched = own.rlike(HINT)
    pieces = parted.select(
        "row", F.when(searched, valid).alias("valid"), F.when(searched, F.transform(free, lambda f: _digital(f, key))).alias("free")
    )
    joined = F.array_join(
        F.zip_with("free", "valid", lambda b, v: F.concat(b["s"], F.coalesce(v, F.lit("")))),
        "",
    )
    new = F.when(F.col("free").isNotNull(), joined).otherwise(own)
    columns = [(new if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns]
    if counted:
        n = F.size("valid") + F.aggregate("free", F.lit(0), lambda total, f: total + f["n"])
        columns.append(F.coalesce(n, F.lit(0)).cast("long").alias(counted))
    return pieces.select(*columns)
