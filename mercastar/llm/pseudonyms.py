"""Numbers and dates that identify people, permuted within their own format."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercastar.llm.columns import packed, quoted, unpacked

ROUNDS = 8
HASH_DIGITS = 15  # hex digits of the round function: 60 bits
FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"
DAYS = 73049
DAY_SIDES = (270, 271)  # the least rectangle of nearly equal sides that holds DAYS
WALK = 16  # steps outside the calendar before giving up: probability below 1e-40

# After +1, ten digits of any value. Without it, the area stands in parentheses or the groups
# apart: 3-3-4, perhaps after a 1. Groups apart by blanks alone must begin with 2 to 9, as
# columns of numbers look alike; ten bare digits are taken for another number.
PHONE = (
    r"(?<![0-9])\+1[ .-]{0,3}\(?[0-9]{3}\)?[ .-]{0,3}[0-9]{3}[ .-]{0,3}[0-9]{4}(?![0-9])"
    r"|(?<![0-9+])(?<![0-9][.-])(?:1[ .-]{0,3})?"
    r"(?:\([0-9]{3}\)[ .-]{0,3}[0-9]{3}[ .-]{0,3}[0-9]{4}|[0-9]{3}[ .-][0-9]{3}[.-][0-9]{4}"
    r"|[2-9][0-9]{2}[ .-][2-9][0-9]{2} [0-9]{4})(?![0-9])"
)

# Fixed formats, tried in this order at each place of a text.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "phone": PHONE,
    "card": r"(?<![0-9-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.]*[0-9])",
    "date": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])|(?<![0-9./])[0-9]{2}([./])[0-9]{2}\1[0-9]{4}(?![0-9])",
}
# The same, with the valid IBANs of the text in place of their pattern.
BEFORE_IBAN, AFTER_IBAN = (
    "|".join(f"(?:{PATTERNS[kind]})" for kind in kinds).replace(r"\1", r"\2")
    for kinds in (("email",), ("phone", "card", "ssn", "ip", "date"))
)
# Every place at which an IBAN may begin, also inside another candidate.
IBAN_STARTS = f"(?=({PATTERNS['iban']}))"
LEAST_IBAN = 15  # of a prefix that is tried when the whole candidate fails

# Characters of an IBAN by country.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _number(text: Column) -> Column:
    return text.cast("bigint")


def _padded(number: Column, width) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _feistel(a: Column, sides: tuple, b: Column, key: str, tweak: Column) -> Column:
    """Permute pairs (a, b) of residues: each round adds a keyed hash of one to the other."""
    side_a, side_b = (F.lit(s).cast("bigint") if isinstance(s, int) else s for s in sides)

    def noise(i: Column, x: Column) -> Column:
        message = F.concat_ws("|", F.lit(key), tweak, i.cast("string"), x.cast("string"))
        digest = F.substring(F.sha2(message.cast("binary"), 256), 1, HASH_DIGITS)
        return F.conv(digest, 16, 10).cast("bigint")

    def step(s: Column, i: Column) -> Column:
        even = F.struct(((s["a"] + noise(i, s["b"])) % side_a).alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), ((s["b"] + noise(i, s["a"])) % side_b).alias("b"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """Permute strings of equally many digits; fewer than two stay as they are."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    right = n - left
    sides = tuple(F.pow(F.lit(10), w).cast("bigint") for w in (left, right))
    pair = _feistel(
        _number(F.substring(digits, F.lit(1), left)),
        sides,
        _number(F.substring(digits, left + 1, right)),
        key,
        F.concat(F.lit(kind), n.cast("string")),
    )
    # The accumulator is folded once more so that the pair is computed a single time.
    joined = F.transform(F.array(pair), lambda p: F.concat(_padded(p["a"], left), _padded(p["b"], right)))
    return F.when(n >= 2, F.get(joined, F.lit(0))).otherwise(digits)


def _laid_out(shape: Column, letters: Column, sign: str) -> Column:
    """Write `letters` over those characters of `shape` that match `sign`, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def put(s: Column, c: Column) -> Column:
        hit = c.rlike(sign)
        return F.struct(
            F.concat(s["out"], F.when(hit, F.substring(letters, s["at"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + hit.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(shape, ""), start, put, lambda s: s["out"])


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits whose last one is not doubled."""
    def add(s: Column, c: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.struct(
            (s["sum"] + F.when(s["double"], twice).otherwise(d)).alias("sum"),
            (~s["double"]).alias("double"),
        )

    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("double"))
    return F.aggregate(F.split(F.reverse(digits), ""), start, add, lambda s: s["sum"])


def _card(text: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        n = F.length(d)
        inner = _permuted_digits(F.substring(d, F.lit(2), n - 2), key, "card")
        payload = F.concat(F.substring(d, 1, 1), inner)
        whole = _once(
            payload,
            lambda p: F.concat(p, (F.lit(9) - (_luhn_sum(F.concat(p, F.lit("0"))) + 9) % 10).cast("string")),
        )
        return F.when(_luhn_sum(d) % 10 == 0, _once(whole, lambda w: _laid_out(text, w, "[0-9]")))

    return _once(_digits(text), new)


def _mod_97(text: Column) -> Column:
    """Remainder by 97 of letters and digits read as numbers, A = 10 to Z = 35."""
    def add(r: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return F.when(value > 9, (r * 100 + value) % 97).otherwise((r * 10 + value) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(text: Column, key: str) -> Column:
    def new(s: Column) -> Column:
        country = F.substring(s, 1, 2)
        body = F.substring(s, F.lit(5), F.length(s) - 4)
        valid = _mod_97(F.concat(body, F.substring(s, 1, 4))) == 1
        permuted = _once(_permuted_digits(_digits(body), key, "iban"), lambda d: _laid_out(body, d, "[0-9]"))
        whole = _once(
            permuted,
            lambda p: F.concat(
                country, _padded(F.lit(98) - _mod_97(F.concat(p, country, F.lit("00"))), 2), p
            ),
        )
        return F.when(valid, _once(whole, lambda w: _laid_out(text, w, "[A-Z0-9]")))

    return _once(F.replace(text, F.lit(" "), F.lit("")), new)


def _ibans(text: Column) -> Column:
    """The valid IBANs of a text, each once, the longest first.

    A candidate may run on into what follows it: of its prefixes by group, that of the
    country's length is taken if it is valid, else the longest valid one.
    """
    pairs = [F.lit(x) for size, names in IBAN_SIZES.items() for c in names.split() for x in (c, size)]
    sizes = F.create_map(*pairs)

    def best(candidate: Column) -> Column:
        def valid(groups: Column) -> Column:
            def prefix(n: Column) -> Column:
                return F.struct(
                    F.array_join(F.slice(groups, F.lit(1), n), " ").alias("text"),
                    F.array_join(F.slice(groups, F.lit(1), n), "").alias("plain"),
                )

            n = F.size(groups)
            tried = F.transform(F.sequence(n, F.least(n, F.lit(3)), F.lit(-1)), prefix)
            return F.filter(
                tried,
                lambda p: ((F.length(p["plain"]) >= LEAST_IBAN) | (p["text"] == candidate))
                & (_mod_97(F.concat(F.substring(p["plain"], F.lit(5), F.length(p["plain"])), F.substring(p["plain"], 1, 4))) == 1),
            )

        def pick(found: Column) -> Column:
            proper = F.filter(found, lambda p: F.length(p["plain"]) == sizes[F.substring(candidate, 1, 2)])
            return F.coalesce(F.get(proper, F.lit(0)), F.get(found, F.lit(0)))["text"]

        return _once(_once(F.split(candidate, " "), valid), pick)

    found = F.transform(F.regexp_extract_all(text, F.lit(IBAN_STARTS), F.lit(1)), best)
    line = F.transform(
        F.array_distinct(F.filter(found, lambda x: x.isNotNull())),
        lambda x: F.struct((-F.length(x)).alias("size"), x.alias("text")),
    )
    return F.transform(F.array_sort(line), lambda x: x["text"])


def _formats(text: Column) -> Column:
    """The pattern of everything to be found in a text, in one group."""
    ibans = F.when(text.rlike(PATTERNS["iban"]), F.array_join(_ibans(text), "|"))
    return _once(
        ibans,
        lambda x: F.when(
            x != "",
            F.concat(F.lit(f"({BEFORE_IBAN}|(?<![A-Za-z0-9])(?:"), x, F.lit(f")(?![A-Za-z0-9])|{AFTER_IBAN})")),
        ).otherwise(f"({BEFORE_IBAN}|{AFTER_IBAN})"),
    )


def _phone(text: Column, key: str) -> Column:
    """The last ten digits; a country code stays.

    Area and exchange stay at or above 200, or below: valid numbers become valid ones, and
    the others are permuted among themselves.
    """
    def new(d: Column) -> Column:
        area, exchange = _number(F.substring(d, -10, 3)), _number(F.substring(d, -7, 3))
        low_a, low_b = (F.when(x >= 200, 200).otherwise(0) for x in (area, exchange))
        size_a, size_b = (F.when(x >= 200, 800).otherwise(200).cast("bigint") for x in (area, exchange))
        rest = (exchange - low_b) * 10_000 + _number(F.substring(d, -4, 4))
        pair = _feistel(area - low_a, (size_a, size_b * 10_000), rest, key, F.lit("phone"))
        return _once(
            pair,
            lambda p: _laid_out(
                text,
                F.concat(
                    F.substring(d, F.lit(1), F.length(d) - 10),
                    _padded(p["a"] + low_a, 3),
                    _padded(F.floor(p["b"] / 10_000) + low_b, 3),
                    _padded(p["b"] % 10_000, 4),
                ),
                "[0-9]",
            ),
        )

    return _once(_digits(text), new)


def _ssn(text: Column, key: str) -> Column:
    """Area 001-899 without 666, group 01-99, serial 0001-9999."""
    area, group, serial = (_number(F.substring(text, at, n)) for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    pair = _feistel(place, (898, 99 * 9999), (group - 1) * 9999 + serial - 1, key, F.lit("ssn"))
    return F.when(
        valid,
        _once(
            pair,
            lambda p: F.concat_ws(
                "-",
                _padded(F.when(p["a"] >= 665, p["a"] + 2).otherwise(p["a"] + 1), 3),
                _padded(F.floor(p["b"] / 9999) + 1, 2),
                _padded(p["b"] % 9999 + 1, 4),
            ),
        ),
    )


def _ip(text: Column, key: str) -> Column:
    def new(parts: Column) -> Column:
        a = parts[0] * 256 + parts[1]
        b = parts[2] * 256 + parts[3]
        pair = _feistel(a, (65536, 65536), b, key, F.lit("ip"))
        dotted = _once(
            pair,
            lambda p: F.concat_ws(
                ".",
                *[x.cast("bigint").cast("string") for v in (p["a"], p["b"]) for x in (F.floor(v / 256), v % 256)],
            ),
        )
        return F.when(F.array_max(parts) < 256, dotted)

    return _once(F.split(text, r"\.").cast("array<bigint>"), new)


def _date(text: Column, key: str) -> Column:
    """A day of 1900 to 2099, year first with dashes or day first with dots or slashes."""
    iso = text.contains("-")
    sign = F.substring(text, 3, 1)
    first = F.when(iso, text).otherwise(
        F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    )

    def new(day: Column) -> Column:
        start = F.to_date(F.lit(FIRST_DAY))
        wide, high = DAY_SIDES

        def walk(x: Column, i: Column) -> Column:
            pair = _feistel(F.floor(x / high), DAY_SIDES, x % high, key, F.lit("date"))
            again = _once(pair, lambda p: p["a"] * high + p["b"])
            return F.when((i > 0) & (x < DAYS), x).otherwise(again)

        steps = F.sequence(F.lit(0), F.lit(WALK))
        place = F.aggregate(steps, F.datediff(day, start).cast("bigint"), walk)
        moved = F.date_add(start, F.least(place, F.lit(DAYS - 1)).cast("int"))
        shown = _once(
            moved,
            lambda m: F.when(iso, F.date_format(m, "yyyy-MM-dd")).otherwise(
                F.concat(F.date_format(m, "dd"), sign, F.date_format(m, "MM"), sign, F.date_format(m, "yyyy"))
            ),
        )
        inside = day.between(start, F.to_date(F.lit(LAST_DAY)))
        return F.when(inside, shown)

    return _once(F.try_to_date(first, "yyyy-MM-dd"), new)


def _email(text: Column, key: str) -> Column:
    """Digits of the name are permuted, its letters shifted by keyed amounts; the domain stays.

    The shift of a sign depends on the key, the domain and the new signs before it, so
    the map is one to one on names of one shape.
    """
    at = F.instr(text, F.lit("@"))
    name, domain = F.substring(text, F.lit(1), at - 1), F.substring(text, at, F.length(text))

    def put(out: Column, c: Column) -> Column:
        seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), domain, out).cast("binary"), 256)
        noise = F.conv(F.substring(seed, 1, HASH_DIGITS), 16, 10).cast("bigint")

        def shifted(zero: str, size: int) -> Column:
            return F.char(F.lit(ord(zero)) + ((F.ascii(c) - ord(zero)) + noise) % size)

        return F.concat(
            out,
            F.when(c.rlike("[0-9]"), shifted("0", 10))
            .when(c.rlike("[a-z]"), shifted("a", 26))
            .when(c.rlike("[A-Z]"), shifted("A", 26))
            .otherwise(c),
        )

    return F.concat(F.aggregate(F.split(name, ""), F.lit(""), put), domain)


KINDS: dict[str, Callable[[Column, str], Column]] = {
    "email": _email,
    "iban": _iban,
    "phone": _phone,
    "card": _card,
    "ssn": _ssn,
    "ip": _ip,
    "date": _date,
}


def _named(kind: str, value: Column) -> Callable[[Column], Column]:
    """Name a new text by its kind; without one, the value stays unnamed."""
    return lambda new: F.struct(
        F.when(new.isNotNull(), F.lit(kind)).alias("kind"), F.coalesce(new, value).alias("text")
    )


def pseudonym(value: Column, key: str) -> Column:
    """(kind, text) of the pseudonym of one found value; NULL kind and the value itself if invalid."""
    chosen = None
    for kind, permute in KINDS.items():
        new = permute(value, key)
        result = _once(new, _named(kind, value))
        fits = value.rlike(f"^(?:{PATTERNS[kind]})$")
        chosen = F.when(fits, result) if chosen is None else chosen.when(fits, result)
    return chosen.otherwise(F.struct(F.lit(None).cast("string").alias("kind"), value.alias("text")))


def pseudonymize(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Replace personal numbers and dates in `text` by keyed pseudonyms of the same format.

    Found and validated: payment cards (Luhn), IBANs (mod 97), North American phone
    numbers (with +1, or written in groups; see PHONE), US social security numbers, IPv4
    addresses, calendar days of 1900 to 2099; beside them e-mail names. A Feistel network permutes the valid values of
    each format, so equal values get equal pseudonyms in all documents, different
    ones different pseudonyms, and check digits are right again. An IBAN ends where its
    check digits are right, whatever groups of capitals or digits follow; what only looks
    like one hides nothing. Punctuation inside a
    value stays in place. What fails validation stays.

    `found` (array of kinds, in order of place) is added; an input column of that name
    is replaced. NULL texts stay NULL with no finds; empty texts, repeated rows and
    empty tables need no special case. Each row is worked on alone: no shuffle.
    """
    columns = df.columns
    body = F.col(quoted(text))
    some = body.rlike("[0-9@]")
    rows = packed(df, _text=body, _any=F.when(some, _formats(body)))
    rows = rows.withColumn("_parts", F.regexp_extract_all("_text", F.col("_any"), F.lit(1)))
    rows = rows.withColumn("_new", F.transform("_parts", lambda v: pseudonym(v, key)))
    between = F.split("_text", F.col("_any"), -1)
    whole = F.array_join(
        F.zip_with(between, "_new", lambda gap, new: F.concat(gap, F.coalesce(new["text"], F.lit("")))), ""
    )
    some = F.coalesce(F.size("_new") > 0, F.lit(False))
    kinds = F.filter(F.transform("_new", lambda n: n["kind"]), lambda k: k.isNotNull())
    results = {
        text: F.when(some, whole).otherwise(F.col("_text")),
        "found": F.coalesce(kinds, F.array().cast("array<string>")),
    }
    return unpacked(rows, columns, **results)
