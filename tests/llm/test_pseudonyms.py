from __future__ import annotations

import hashlib
import random
import re
from datetime import date, timedelta

from mercastar.llm.pseudonyms import PATTERNS, pseudonymize


def run(documents, *texts, key="k"):
    return [(r.text, r.found) for r in pseudonymize(documents(*texts), key).orderBy("doc_id").collect()]


def luhn(number):
    digits = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def mod97(iban):
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def test_formats_and_checks_hold(spark, documents):
    texts = [
        "pay 4041894974608795 now", "pay 4041-8949-7460-8795", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32",
        "+1 (988) 555-2485", "123-45-6789", "42.144.35.254", "2020-02-29", "29.02.2020", "31/12/1999", "the.19@mail5.example.com",
    ]
    kinds = ["card", "card", "iban", "iban", "phone", "ssn", "ip", "date", "date", "date", "email"]
    out = run(documents, *texts)
    for text, (new, found), kind in zip(texts, out, kinds, strict=True):
        assert found == [kind] and new != text and len(new) >= len(text) - 8
        assert re.search(PATTERNS[kind], new)
    cards = [re.sub(r"\D", "", out[i][0]) for i in (0, 1)]
    assert cards[0] == cards[1] and luhn(cards[0]) and cards[0][0] == "4"
    assert out[1][0].count("-") == 3
    assert mod97(out[2][0]) == 1 and mod97(out[3][0]) == 1
    assert out[7][0] == "-".join(reversed(out[8][0].split(".")))
    assert 1900 <= date.fromisoformat(out[7][0]).year <= 2099


def test_equal_values_stay_linked_and_keys_matter(spark, documents):
    texts = ["a 42.144.35.254 b", "42.144.35.254"]
    first = run(documents, *texts)
    assert first[0][0] == f"a {first[1][0]} b" == run(documents, *texts)[0][0]
    assert run(documents, *texts, key="other")[1][0] != first[1][0]


def test_different_values_stay_different(spark, documents):
    days = [f"{y}-{m:02}-{d:02}" for y in (1900, 1999, 2000, 2099) for m in range(1, 13) for d in range(1, 29)]
    ssns = [f"{a:03}-{b:02}-{c:04}" for a in (1, 665, 667, 899) for b in (1, 99) for c in (1, 2, 9999)]
    new = run(documents, " ; ".join(days), " ; ".join(ssns))
    for values, (text, found) in zip((days, ssns), new, strict=True):
        assert len(found) == len(values) and len(set(text.split(" ; "))) == len(values)
        assert all(len(a) == len(b) for a, b in zip(values, text.split(" ; "), strict=True))


def test_invalid_values_stay(spark, documents):
    texts = ["4041894974608796", "000-12-3456", "666-01-0001", "300.1.1.1", "2021-02-30", "1850-01-01", "DE00370400440532013000", "12345", "2020-13-01"]
    assert run(documents, *texts) == [(t, []) for t in texts]


def test_phone_numbers_of_all_forms(spark, documents):
    forms = [
        "+1 (202) 555-0143", "+1-202-555-0143", "+1.202.555.0143", "+12025550143", "+1  202 555 0143", "(202) 555-0143",
        "(202)555-0143", "202-555-0143", "202.555.0143", "202 555-0143", "202 555 0143", "1-202-555-0143", "1 (202) 555-0143",
    ]
    out = run(documents, *[f"call {f}, now" for f in forms])
    assert [found for _, found in out] == [["phone"]] * len(forms)
    assert len({re.sub(r"\D", "", text)[-10:] for text, _ in out}) == 1  # one number, one pseudonym
    for form, (text, _) in zip(forms, out, strict=True):
        assert form not in text and re.sub(r"\d", "0", text) == re.sub(r"\d", "0", f"call {form}, now")
        assert re.search(PATTERNS["phone"], text)
    areas = [f"+1 ({a:03}) {e:03}-7713" for a in (0, 17, 132, 199, 200, 999) for e in (0, 199, 200, 555)]
    text, found = run(documents, " ; ".join(areas))[0]
    new = text.split(" ; ")
    assert found == ["phone"] * len(areas) and len(set(new)) == len(areas) and not set(new) & set(areas)
    for a, b in zip(areas, new, strict=True):
        assert (a[4] < "2", a[9] < "2") == (b[4] < "2", b[9] < "2")
    others = ["100 200 3000", "2025550143", "+44-202-555-0143", "9202-555-0143", "202-555-01439"]
    assert run(documents, *others) == [(t, []) for t in others]


def test_ibans_end_before_what_follows(spark, documents):
    es, at, be = "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034"
    texts = [
        f"{es} 2024-01-05", f"{at} BIC", f"{at} BIC GIBA ATWW", f"{be} EUR 1999", f"{es} {at} {be}", es.replace(" ", "") + " 2024-01-05",
        "AB12 1234 5678 2024-01-05", f"AB12 CD34 {at}", f"{at} 42.144.35.254",
    ]
    kinds = [["iban", "date"], ["iban"], ["iban"], ["iban"], ["iban"] * 3, ["iban", "date"], ["date"], ["iban"], ["iban", "ip"]]
    out = run(documents, *texts)
    assert [found for _, found in out] == kinds
    new = {es: out[0][0][: len(es)], at: out[1][0][: len(at)], be: out[3][0][: len(be)]}
    for old, text in new.items():
        assert old != text and mod97(text) == 1 and [*map(len, old.split())] == [*map(len, text.split())]
    assert out[1][0] == f"{new[at]} BIC" and out[2][0] == f"{new[at]} BIC GIBA ATWW" and out[3][0] == f"{new[be]} EUR 1999"
    assert out[4][0] == " ".join(new[x] for x in (es, at, be))
    assert "2024-01-05" not in out[0][0] + out[5][0] + out[6][0] and out[7][0] == f"AB12 CD34 {new[at]}"


def test_nulls_empty_long_and_clashing_names(spark, documents):
    long = "x " * 60_000 + "1.2.3.4"
    docs = documents(None, "", long, "no numbers", found="old", _text="old")
    out = {r.doc_id: r for r in pseudonymize(docs, "k").collect()}
    assert out[0].text is None and out[1].text == "" and out[3].text == "no numbers"
    assert out[2].text.startswith(long[:120_000]) and out[2].found == ["ip"] and out[2]["_text"] == "old"
    assert pseudonymize(docs.where("doc_id < 0"), "k").collect() == []
    assert pseudonymize(docs.unionAll(docs), "k").count() == 8


def feistel(a, sides, b, key, tweak):
    """Eight rounds that add 60 bits of SHA-256 to one half and the other in turn."""
    for i in range(8):
        said = f"{key}|{tweak}|{i}|{b if i % 2 == 0 else a}"
        noise = int(hashlib.sha256(said.encode()).hexdigest()[:15], 16)
        if i % 2 == 0:
            a = (a + noise) % sides[0]
        else:
            b = (b + noise) % sides[1]
    return a, b


def digits_permuted(digits, key, kind):
    n = len(digits)
    left = n // 2
    right = n - left
    a, b = feistel(int(digits[:left]), (10**left, 10**right), int(digits[left:]), key, f"{kind}{n}")
    return f"{a:0{left}d}{b:0{right}d}"


def over(shape, signs, pattern):
    line = iter(signs)
    return "".join(next(line) if re.match(pattern, c) else c for c in shape)


def plain_card(text, key):
    d = re.sub(r"\D", "", text)
    body = d[0] + digits_permuted(d[1:-1], key, "card")
    return over(text, next(body + str(c) for c in range(10) if luhn(body + str(c))), "[0-9]")


def plain_iban(text, key):
    body = text[4:]
    digits = iter(digits_permuted(re.sub(r"\D", "", body), key, "iban"))
    body = "".join(next(digits) if c.isdigit() else c for c in body)
    return text[:2] + f"{98 - mod97(text[:2] + '00' + body):02d}" + body


def plain_phone(text, key):
    d = re.sub(r"\D", "", text)
    lead, area, exchange, last = d[:-10], int(d[-10:-7]), int(d[-7:-4]), int(d[-4:])
    (low_a, size_a), (low_b, size_b) = ((200, 800) if x >= 200 else (0, 200) for x in (area, exchange))
    a, b = feistel(area - low_a, (size_a, size_b * 10_000), (exchange - low_b) * 10_000 + last, key, "phone")
    return over(text, f"{lead}{a + low_a:03d}{b // 10_000 + low_b:03d}{b % 10_000:04d}", "[0-9]")


AREAS = [n for n in range(1, 900) if n != 666]


def plain_ssn(text, key):
    area, group, serial = map(int, text.split("-"))
    a, b = feistel(AREAS.index(area), (898, 99 * 9999), (group - 1) * 9999 + serial - 1, key, "ssn")
    return f"{AREAS[a]:03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"


def plain_ip(text, key):
    w, x, y, z = map(int, text.split("."))
    a, b = feistel(w * 256 + x, (65536, 65536), y * 256 + z, key, "ip")
    return ".".join(map(str, (*divmod(a, 256), *divmod(b, 256))))


def plain_date(text, key):
    start, place = date(1900, 1, 1), None
    while place is None or place >= (date(2099, 12, 31) - start).days + 1:
        a = (date.fromisoformat(text) - start).days if place is None else place
        high, low = feistel(a // 271, (270, 271), a % 271, key, "date")
        place = high * 271 + low
    return (start + timedelta(days=place)).isoformat()


def test_values_are_those_of_a_plain_network(spark, documents):
    rng = random.Random(11)

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        body = rng.choice("3456") + digits(rng.randint(11, 17))
        return next(body + str(c) for c in range(10) if luhn(body + str(c)))

    def iban():
        country, body = rng.choice([("DE", digits(18)), ("GB", "WEST" + digits(14)), ("NO", digits(11))])
        return country + f"{98 - mod97(country + '00' + body):02d}" + body

    made = {
        "card": (card, plain_card),
        "iban": (iban, plain_iban),
        "phone": (lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", plain_phone),
        "ssn": (lambda: f"{rng.choice(AREAS):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}", plain_ssn),
        "ip": (lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)), plain_ip),
        "date": (lambda: (date(1900, 1, 1) + timedelta(days=rng.randrange(73049))).isoformat(), plain_date),
    }
    for kind, (make, plain) in made.items():
        values = sorted({make() for _ in range(200)})
        out = run(documents, *[f"it is {v} here" for v in values], key="secret")
        assert [found for _, found in out] == [[kind]] * len(values), kind
        assert [text for text, _ in out] == [f"it is {plain(v, 'secret')} here" for v in values], kind
        assert len({text for text, _ in out}) == len(values)  # different values stay different
