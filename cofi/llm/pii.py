"""Format-preserving pseudonyms for personal data (operator 2), DataFrame functions only.

Found values are validated (card: Luhn sum; IBAN: remainder 97; IP: four octets; social
security number: no reserved part; phone: 10 to 15 digits marked by a plus, a leading 0 or 00,
brackets or groups of 3, 3 and 4, and not what follows a thousands separator; date: a real day of the covered
range) and replaced by a keyed permutation within their format: a Feistel network over
the value's symbols, each with its own radix (a digit 10, a letter 26, an octet 256, a day
of the range 250 x 292). Each round adds, symbol by symbol modulo its radix, a number from
SHA-256 of the key, the kind, the round and the other half, which can be undone, so
different values of a format get different pseudonyms and equal values the same one in
every document. Check digits are computed anew, so a pseudonym is valid in the same way. (A
phone's first digits may change, so its pseudonym need not be marked as one.)

A value ends where it validates: cards, IBANs and phones that fail as far as their format
reaches are tried up to each earlier gap (an IBAN first up to its country's length, otherwise
the longest valid end wins), then as the next format, and then the places inside them are
tried. A valid card in a card's grouping goes before other cards and phones that would begin
in the numbers before it; a number so grouped that fails its Luhn sum holds no phone.

Kept as they are: separators, an email's top-level domain, a phone's separated country code
(after + or 00), an IBAN's country, the first four letters of an access key, and values that
do not validate.

Defined cases: a null text stays null with no findings; rows are independent, so repeated
rows, ties and null ids need no rule; extra columns (dots in their names, names of the helper
columns) pass through ``mask`` unchanged. The key is read at run time and is in no plan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cofi.llm.common import text_rows

ROUNDS = 8
DAY_RADICES = (250, 292)             # 73,000 days
FIRST_DAY = "1900-01-01"

# The formats, in the order in which they are tried at a place.
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){0,126}\.[A-Za-z]{2,63}",
    "key": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,64})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\w)",
    "date": r"(?<![\w.\-/])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\-/]?\w)",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?!-?\w)",
    "phone": r"(?<![\w+])(?!(?<=\d[ .])\d{3}(?:[ .]\d{3})+(?!\d))(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?|\d{2,4}[ .\-])\d{2,4}[ .\-]\d{2,4}(?:[ .\-]\d{2,4})?(?![\w]|-\d)"
             r"|(?<![\w+])\+\d{10,15}(?!\w)"
             r"|(?<![\w+])(?:\+|00)[1-9]\d{0,2}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,8}(?:[ .\-]\d{2,8}){1,3}(?![\w]|-\d)",
    "card": r"(?<![\w])\d(?:[ \-]?\d){12,18}(?!\w)",
}
#: What tells a phone from other grouped digits: a plus, 00 or 0 before the number, brackets, or groups of 3, 3 and 4.
PHONE_MARK = r"^(?:\+|\(|00?[1-9]|[2-9]\d\d([ .\-])\d{3}\1\d{4}$)"
CARD_FIRST = ("email", "key", "iban", "ip", "date", "ssn", "card", "phone")
ANY = "|".join(f"(?:{FORMATS[k]})" for k in CARD_FIRST)
#: A number grouped as cards are.
CARD_SHAPE = r"^[1-9]\d{3}(?:([ \-]?)\d{4}\1\d{4}\1\d{4}|([ \-]?)\d{6}\2\d{5})(?!\d)"
#: Characters of an IBAN by country (ISO 13616 registry).
IBAN_SIZES = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in cs.split()}
CHUNK = 256                          # places gone through at a time
WITHIN = 24                          # places that a card or phone can hold behind its first
#: Every format holds one of these; other texts need no further look.
HINT = r"[0-9@]|AKIA|[a-f]{32}"


def _hash_number(text: Column, radix: Column) -> Column:
    """A number below ``radix`` from the first 60 bits of SHA-256 (the radix is tiny against them)."""
    return (F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint") % radix).cast("bigint")


def secret(spark: SparkSession, key: str) -> Column:
    """The key as a scalar read at run time from a table of one row: neither the plan nor an error text
    that cites it holds the key. Make it a column before it is used inside a higher-order function."""
    return spark.createDataFrame([(key,)], "key STRING").scalar()


def feistel(values: Column, radices: Column, key: Column | str, kind: Column | str) -> Column:
    """``values`` (ARRAY<BIGINT>, each below its radix) permuted. A key given as text becomes a literal of the
    plan; see ``secret``. Odd rounds change the first
    half by the second, even rounds the second by the first."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    key = F.lit(key) if isinstance(key, str) else key
    half = F.floor(F.size(values) / 2).cast("int")

    def one_round(now: Column, i: Column) -> Column:
        first = (i % 2) == 1
        other = F.array_join(F.filter(now, lambda _, j: (j < half) != first).cast("array<string>"), ",")
        seed = F.concat_ws("|", key, kind, i.cast("string"), other)
        return F.transform(now, lambda x, j: F.when((j < half) == first, (x + _hash_number(
            F.concat_ws("|", seed, j.cast("string")), F.get(radices, j))) % F.get(radices, j)).otherwise(x))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), values.cast("array<bigint>"), one_round)


def _chars(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: s.substr(i, F.lit(1)))
                  ).otherwise(F.array().cast("array<string>"))


def let(x: Column, f) -> Column:
    """f(x) with ``x`` written and computed once."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _char_job(s: Column, kind: Column, hexadecimal: Column) -> Column:
    """What the network needs to turn digits into digits and letters into letters of their
    case (or hexadecimal digits into such ones); anything else has radix 1 and stays."""
    code = F.transform(_chars(s), lambda c: F.ascii(c).cast("bigint"))
    digit, upper, lower = (lambda c: c.between(48, 57)), (lambda c: c.between(65, 90)), (lambda c: c.between(97, 122))
    base = lambda c: (F.when(hexadecimal, F.when(digit(c), 48).otherwise(87)).when(digit(c), 48)
                      .when(upper(c), 65).when(lower(c), 97).otherwise(c).cast("bigint"))
    radix = lambda c: (F.when(hexadecimal, 16).when(digit(c), 10)
                       .when(upper(c) | lower(c), 26).otherwise(1).cast("bigint"))
    return let(code, lambda x: F.struct(
        F.transform(x, lambda c: c - base(c)).alias("values"), F.transform(x, radix).alias("radices"),
        F.transform(x, base).alias("bases"), kind.alias("kind"), hexadecimal.alias("hex")))


def _number_job(numbers: list[Column], radices: list[int], kind: str) -> Column:
    long = lambda xs: F.array(*[x.cast("bigint") for x in xs])
    return F.struct(long(numbers).alias("values"), long(map(F.lit, radices)).alias("radices"),
                    long([F.lit(0)] * len(radices)).alias("bases"), F.lit(kind).alias("kind"), F.lit(False).alias("hex"))


def _shown(job: Column, new: Column) -> Column:
    """The characters of a permuted character job."""
    return F.array_join(F.zip_with(new, job["bases"], lambda v, b: F.when(
        job["hex"], F.lower(F.conv(v.cast("string"), 10, 16))).otherwise(F.char(b + v))), "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refill(shape: Column, symbol: str, symbols: Column) -> Column:
    """``shape`` with the characters that the class ``symbol`` names replaced, in order, by ``symbols``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(now: Column, c: Column) -> Column:
        hit = F.regexp_like(c, F.lit(f"^{symbol}$"))
        return F.struct(F.concat(now["out"], F.when(hit, symbols.substr(now["at"], F.lit(1))).otherwise(c)).alias("out"),
                        (now["at"] + F.when(hit, 1).otherwise(0)).alias("at"))

    return F.aggregate(_chars(shape), start, step, lambda x: x["out"])


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Of ``digits``, counted from the right from 1; those with number % 2 == ``doubled`` count double."""
    return F.aggregate(F.transform(F.reverse(_chars(digits)), lambda c, i: F.when(
        (i + 1) % 2 == doubled, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))),
        F.lit(0), lambda s, x: s + x)


def remainder_97(text: Column) -> Column:
    """Of the number that ``text`` spells, letters counting 10 to 35."""
    return F.aggregate(_chars(text), F.lit(0), lambda s, c: F.when(
        F.ascii(c) >= 65, s * 100 + F.ascii(c) - 55).otherwise(s * 10 + F.ascii(c) - 48) % 97)


def _day(m: Column) -> Column:
    """The day a date names: year first, or after / month before day where that is a day, else day
    before month, or after . day before month."""
    read = lambda shape: F.try_to_timestamp(m, F.lit(shape)).cast("date")
    return (F.when(m.contains("-"), read("yyyy-MM-dd")).when(m.contains("."), read("dd.MM.yyyy"))
            .otherwise(F.coalesce(read("MM/dd/yyyy"), read("dd/MM/yyyy"))))


def _day_text(day: Column, m: Column) -> Column:
    """``day`` in the shape of the date ``m``."""
    us = F.try_to_timestamp(m, F.lit("MM/dd/yyyy")).isNotNull()
    return (F.when(m.contains("-"), F.date_format(day, "yyyy-MM-dd")).when(m.contains("."), F.date_format(day, "dd.MM.yyyy"))
            .when(us, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "dd/MM/yyyy")))


def _jobs(kind: Column, m: Column) -> Column:
    """The network runs a match needs, or null if it does not validate."""
    no = F.lit(False)
    one = lambda valid, job: F.when(valid, F.array(job))
    domain = F.lower(F.substring_index(m, "@", -1))
    digits = _digits(m)
    area, group, serial = (F.get(F.split(m, "-"), F.lit(i)).cast("bigint") for i in range(3))
    octets = F.split(m, r"\.")
    span = DAY_RADICES[0] * DAY_RADICES[1]
    return (
        F.when(kind == "email", F.array(
            _char_job(F.lower(F.substring_index(m, "@", 1)), F.concat(F.lit("email@"), domain), no),
            _char_job(F.regexp_replace(domain, r"\.[a-z]+$", ""), F.lit("domain"), no)))
        .when(kind == "key", F.array(_char_job(F.regexp_replace(m, "^AKIA", ""),
                                               F.when(m.startswith("AKIA"), "key").otherwise("hex"), ~m.startswith("AKIA"))))
        .when(kind == "iban", let(F.regexp_replace(m, " ", ""), lambda x: one(
            _valid_iban(x), _char_job(x.substr(F.lit(5), F.lit(99)), F.concat(F.lit("iban"), x.substr(F.lit(1), F.lit(2))), no))))
        .when(kind == "ip", F.array(_number_job([F.get(octets, F.lit(i)) for i in range(4)], [256] * 4, "ip")))
        .when(kind == "date", let(F.datediff(_day(m), F.lit(FIRST_DAY).cast("date")), lambda n: one(
            n.between(0, span - 1), _number_job([F.floor(n / DAY_RADICES[1]), n % DAY_RADICES[1]], list(DAY_RADICES), "date"))))
        # area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999
        .when(kind == "ssn", one(area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), _number_job(
            [area - 1 - F.when(area > 666, 1).otherwise(0), group - 1, serial - 1], [898, 99, 9999], "ssn")))
        .when(kind == "card", let(digits, lambda x: one(_valid_card(x), _char_job(
            x.substr(F.lit(1), F.length(x) - 1), F.lit("card"), no))))
        .when(kind == "phone", let(digits, lambda x: one(_valid_phone(x) & F.regexp_like(m, F.lit(PHONE_MARK)), _char_job(
            x.substr(F.length(_country(m)) + 1, F.lit(17)), F.lit("phone"), no)))))


def _country(m: Column) -> Column:
    return _digits(F.regexp_extract(m, r"^(?:\+\d{1,3}|00[1-9]\d{0,2})[ .(\-]", 0))


def _valid_iban(x: Column) -> Column:
    return F.length(x).between(15, 34) & (remainder_97(F.concat(x.substr(F.lit(5), F.lit(99)), x.substr(F.lit(1), F.lit(4)))) == 1)


def _valid_card(digits: Column) -> Column:
    return F.length(digits).between(13, 19) & (luhn_sum(digits, 0) % 10 == 0)


def _valid_phone(digits: Column) -> Column:
    """10 to 15 digits, not counting a 00 before the country code."""
    return F.length(digits).between(10, F.when(digits.startswith("00"), 17).otherwise(15))


def _ends(m: Column, gap: str) -> Column:
    """``m``, and what is left of it before each ``gap``, the longest first."""
    return F.transform(F.filter(F.sequence(F.length(m), F.lit(1)), lambda k: (k == F.length(m)) | F.regexp_like(
        m.substr(k + 1, F.lit(1)), F.lit(gap))), lambda k: m.substr(F.lit(1), k))


def _longest(m: Column, gap: str, valid) -> Column:
    """The longest valid end of ``m``, or null."""
    return F.when(valid(m), m).otherwise(F.get(F.filter(_ends(m, gap), valid), F.lit(0)))


def _end_of(kind: str, m: Column) -> Column:
    """The part of match ``m`` that validates, or null."""
    if kind == "iban":
        sizes = F.create_map(*[F.lit(x) for pair in IBAN_SIZES.items() for x in pair])
        bare = lambda x: F.regexp_replace(x, " ", "")
        own = F.filter(_ends(m, " "), lambda x: F.length(bare(x)) == F.try_element_at(sizes, m.substr(F.lit(1), F.lit(2))))
        valid = lambda x: let(bare(x), _valid_iban)
        return F.coalesce(F.get(F.filter(own, valid), F.lit(0)), _longest(m, " ", valid))
    if kind == "card":
        return _longest(m, r"[ \-]", lambda x: let(_digits(x), _valid_card))
    return _longest(m, r"[ .\-]", lambda x: _valid_phone(_digits(x)) & F.regexp_like(x, F.lit(PHONE_MARK))
                    & F.regexp_like(x, F.lit(f"^(?:{_alone('phone')})$")))


def _chosen(matches: Column, phones: Column) -> Column:
    """ARRAY<STRUCT<kind, m, grouped>> per place: what validates there, or is kept whole (a date or
    social security number that is none); ``grouped``: the length of a number that is grouped like
    a card and is none. ``phones``: what the phone format matches at the same places."""
    x = F.transform(matches, lambda m, i: F.struct(
        m.alias("m"), _first_kind(m, F.lit(None).cast("string")).alias("kind"), F.get(phones, i).alias("phone")))
    x = F.transform(x, lambda r: F.struct(r["m"].alias("m"), r["kind"].alias("kind"), r["phone"].alias("phone"), F.when(
        r["kind"] == "iban", _end_of("iban", r["m"])).when(r["kind"] == "card", _end_of("card", r["m"])).when(
        r["kind"] == "phone", _end_of("phone", r["m"])).otherwise(r["m"]).alias("own")))
    x = F.transform(x, lambda r: F.struct(r["kind"].alias("kind"), r["own"].alias("own"), F.when(
        (r["kind"] == "card") & r["own"].isNull(), r["phone"]).otherwise("").alias("phone"), F.when(
        (r["kind"] == "card") & r["own"].isNull(), F.length(F.regexp_extract(r["m"], CARD_SHAPE, 0))).otherwise(0).alias("grouped")))
    x = F.transform(x, lambda r: F.struct(r["kind"].alias("kind"), r["own"].alias("own"), r["grouped"].alias("grouped"), F.when(
        (F.length(r["phone"]) > 0) & (r["grouped"] == 0), _end_of("phone", r["phone"])).alias("next")))
    return F.transform(x, lambda r: F.struct(
        F.when(r["own"].isNotNull(), r["kind"]).when(r["next"].isNotNull(), "phone").alias("kind"),
        F.coalesce(r["own"], r["next"]).alias("m"), r["grouped"].alias("grouped")))


def _covered(parts: Column, chosen: Column) -> Column:
    """ARRAY<INT> per place, from left to right: twice the characters from there that a value covers
    which begins there or before, plus one if it begins there. ``parts``: the text before the first
    place and from each place to the next. In chunks, as an array that grows is copied at each step."""
    spans = F.transform(chosen, lambda c, i: F.struct(
        F.length(F.get(parts, i + 1)).alias("n"), F.coalesce(F.length(c["m"]), F.lit(0)).alias("size"),
        F.coalesce(c["kind"] == "phone", F.lit(False)).alias("phone"), c["grouped"].alias("grouped"),
        F.coalesce(c["kind"].isin("card", "phone"), F.lit(False)).alias("number"),
        F.coalesce((c["kind"] == "card") & F.regexp_like(c["m"], F.lit(f"{CARD_SHAPE}$")), F.lit(False)).alias("sure")))

    def before_sure(x: Column, i: Column, xs: Column) -> Column:
        """Whether a card in a card's grouping begins inside ``x``, which is none."""
        far = F.struct(x["n"].alias("at"), F.lit(False).alias("hit"))
        return x["number"] & ~x["sure"] & F.aggregate(F.slice(xs, i + 2, WITHIN), far, lambda now, y: F.struct(
            (now["at"] + y["n"]).alias("at"), (now["hit"] | (y["sure"] & (now["at"] < x["size"]))).alias("hit")))["hit"]

    spans = let(spans, lambda xs: F.transform(xs, lambda x, i: F.struct(
        x["n"].alias("n"), F.when(before_sure(x, i, xs), 0).otherwise(x["size"]).alias("size"),
        x["phone"].alias("phone"), x["grouped"].alias("grouped"))))

    def state(left: Column, grouped: Column, out: Column) -> Column:
        return F.struct(left.cast("int").alias("left"), grouped.cast("int").alias("grouped"), out.alias("out"))

    def step(now: Column, x: Column) -> Column:
        free = now["left"] <= 0
        begins = free & (x["size"] > 0) & ~(x["phone"] & (now["grouped"] > 0))
        code = F.when(begins, 2 * x["size"] + 1).otherwise(2 * F.greatest(now["left"], F.lit(0)))
        return let(code.cast("int"), lambda c: state(
            F.floor(c / 2) - x["n"], F.greatest(now["grouped"], F.when(free, x["grouped"]).otherwise(0)) - x["n"],
            F.concat(now["out"], F.array(c))))

    def chunk(now: Column, xs: Column) -> Column:
        none = F.array().cast("array<int>")
        return let(F.aggregate(xs, state(now["left"], now["grouped"], none), step), lambda c: state(
            c["left"], c["grouped"], F.concat(now["out"], F.array(c["out"]))))

    chunks = let(spans, lambda s: F.transform(F.sequence(F.lit(1), F.size(s), F.lit(CHUNK)), lambda i: F.slice(s, i, CHUNK)))
    return F.flatten(F.aggregate(chunks, state(F.lit(0), F.lit(0), F.array().cast("array<array<int>>")), chunk)["out"])


def _render(kind: Column, m: Column, jobs: Column, new: Column) -> Column:
    """The pseudonym of match ``m`` from the network's results ``new``, one per job."""
    first = _shown(F.get(jobs, F.lit(0)), F.get(new, F.lit(0)))
    at = lambda i: F.get(F.get(new, F.lit(0)), F.lit(i))
    show = lambda x, n: F.lpad(x.cast("string"), n, "0")
    domain_end = F.regexp_extract(F.lower(m), r"\.[a-z]+$", 0)
    account = lambda x: F.concat(m.substr(F.lit(1), F.lit(2)), F.lpad((98 - remainder_97(F.concat(
        x, m.substr(F.lit(1), F.lit(2)), F.lit("00")))).cast("string"), 2, "0"), x)
    return (
        F.when(kind == "email", F.concat(first, F.lit("@"), _shown(F.get(jobs, F.lit(1)), F.get(new, F.lit(1))), domain_end))
        .when(kind == "key", F.concat(F.when(m.startswith("AKIA"), "AKIA").otherwise(""), first))
        .when(kind == "iban", _refill(m, "[A-Z0-9]", let(first, account)))
        .when(kind == "ip", F.array_join(F.get(new, F.lit(0)).cast("array<string>"), "."))
        .when(kind == "date", let(F.date_add(F.lit(FIRST_DAY).cast("date"), (
            at(0) * DAY_RADICES[1] + at(1)).cast("int")), lambda day: _day_text(day, m)))
        .when(kind == "ssn", F.concat_ws("-", show(at(0) + 1 + F.when(at(0) >= 665, 1).otherwise(0), 3),
                                         show(at(1) + 1, 2), show(at(2) + 1, 4)))
        .when(kind == "card", _refill(m, "[0-9]", let(first, lambda x: F.concat(
            x, ((10 - luhn_sum(x, 1) % 10) % 10).cast("string")))))
        .when(kind == "phone", _refill(m, "[0-9]", F.concat(_country(m), first))))


def pseudonyms_of(matches: Column, key: Column | str) -> Column:
    """ARRAY<STRUCT<kind, value>> for an array of (m, kind): each one's kind (null if it does
    not validate) and what replaces it. Step by step over the array, so that each
    expression is written once."""
    x = F.transform(matches, lambda r: F.struct(r["m"].alias("m"), r["kind"].alias("kind"), _jobs(r["kind"], r["m"]).alias("jobs")))
    x = F.transform(x, lambda r: F.struct(
        r["m"].alias("m"), r["kind"].alias("kind"), r["jobs"].alias("jobs"),
        F.transform(r["jobs"], lambda j: feistel(j["values"], j["radices"], key, j["kind"])).alias("new")))
    return F.transform(x, lambda r: F.struct(
        F.when(r["jobs"].isNotNull(), r["kind"]).alias("kind"),
        F.when(r["jobs"].isNotNull(), _render(r["kind"], r["m"], r["jobs"], r["new"])).otherwise(r["m"]).alias("value")))


def _first_kind(m: Column, none: Column) -> Column:
    out = none
    for kind in reversed(CARD_FIRST):
        out = F.when(F.regexp_like(m, F.lit(f"^(?:{_alone(kind)})$")), F.lit(kind)).otherwise(out)
    return out


def _alone(kind: str) -> str:
    """The format without what it asks of its surroundings."""
    return re.sub(r"\(\?<?!(?:[^()\[\]]|\[[^\]]*\])*\)", "", FORMATS[kind])


def mask(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` pseudonymised in place; all columns and their order stay."""
    return _with_findings(docs, key, text_col)[0].select(*[F.col(f"`{c}`") for c in docs.columns])


def _with_findings(docs: DataFrame, key: str, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with ``text_col`` replaced and the findings in a column of their own, and its name."""
    text = F.concat(F.lit(" "), F.col(text_col))  # so that no place is at the very start
    some = F.regexp_like(F.col(text_col), F.lit(HINT))
    names: list[str] = []
    for name in ("_places", "_chosen", "_at", "_found", "_key", "_findings"):
        while name in docs.columns:
            name += "_"
        names.append(name)
    places, chosen, at, found, hidden = map(F.col, names[:5])
    x = docs.withColumn(names[4], secret(docs.sparkSession, key)).withColumn(names[0], F.when(some, F.struct(
        F.split(text, f"(?={ANY})", -1).alias("parts"),
        F.regexp_extract_all(text, F.lit(f"(?=({ANY}))"), F.lit(1)).alias("matches"),
        F.regexp_extract_all(text, F.lit(f"(?={ANY})(?=({FORMATS['phone']}|))"), F.lit(1)).alias("phones"))))
    x = x.withColumn(names[1], F.when(F.size(places["matches"]) > 0, _chosen(places["matches"], places["phones"])))
    x = x.withColumn(names[2], F.when(chosen.isNotNull(), _covered(places["parts"], chosen)))
    x = x.withColumn(names[3], pseudonyms_of(F.transform(chosen, lambda c, i: F.when(
        F.get(at, i) % 2 == 1, F.struct(c["m"].alias("m"), c["kind"].alias("kind")))), hidden))
    code = lambda i: F.coalesce(F.get(at, i - 1), F.lit(0))
    whole = F.array_join(F.transform(places["parts"], lambda p, i: F.concat(
        F.when(code(i) % 2 == 1, F.get(found, i - 1)["value"]).otherwise(F.lit("")),
        p.substr(F.floor(code(i) / 2).cast("int") + 1, F.length(p)))), "")
    new = F.when(chosen.isNotNull(), whole.substr(F.lit(2), F.length(whole))).otherwise(F.col(text_col))
    return x.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
                    found.alias(names[5])), names[5]


def pseudonyms(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_<kind>...) per row of ``docs``: the masked text and what was replaced."""
    x, findings = _with_findings(text_rows(docs), key, "text")
    count = lambda k: F.size(F.filter(F.coalesce(F.col(findings), F.array().cast(
        "array<struct<kind:string,value:string>>")), lambda f: f["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return x.select("doc_id", "text", *[count(k) for k in FORMATS])
