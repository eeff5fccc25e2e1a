"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Candidates are found by pattern and validated: payment-card numbers by the Luhn check, IPv4 addresses by their octets,
dates by the calendar, phone numbers by country code (or North American area code) and length, account numbers (IBAN) by their
check digits, social security numbers by the areas, groups and serials that exist, e-mail addresses by shape, quoted keys as
32 or more hex digits. Each value is permuted within its format by a keyed Feistel network, so equal values get equal pseudonyms in all
documents and different values of one format never share one:
* cards: all digits but the last go through a decimal Feistel; the check digit is made anew, so the result is valid;
* phones: the digits after the country code, which is told by the numbering plan, so one number has one pseudonym however it is
  spaced, with a trunk zero in brackets or, for +1, without its code; punctuation stays in place;
* account numbers: all digits but the check digits, which are made anew; letters stay;
* social security numbers: within the valid ones;
* IPv4: the 32-bit number, in two 16-bit halves (octets with leading zeros are no addresses); * dates: the day within its 400-year cycle (146097 = 189 x 773 days);
* e-mail local parts and hex keys: strings of any length are replaced by keyed hash text of the same length (these two
  are linked by equality but, unlike the numbers, not a permutation).
The key is a parameter without a default; production keeps it in a secret store. Numbers that fail their check stay as they are.

Defined results: a null text stays null with zero counts; an empty text stays empty; a text of any length is rewritten whole;
ids are only carried; rows that repeat get equal results; an empty table gives an empty result; `pii` replaces an input column
of that name, all other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 6
#: The key of the registered query only.
QUERY_KEY = "demonstration-key"

CARD = r"(?<![\d.])(?:\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\d.]\d|\d)"
PHONE = r"\+\d{1,3}[ .-]?(?:\(0\) ?)?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)|(?<!\w)\(\d{3}\) ?\d{3}-\d{4}(?![\d-])|(?<![\w.-])[2-9]\d\d-[2-9]\d\d-\d{4}(?![\w-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
#: The country codes of one and two digits of the numbering plan; all others have three.
COUNTRY_CODE = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
IPV4 = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)"
DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
EMAIL = r"[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"
SECRET = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])"
ANY = "|".join((EMAIL, PHONE, IPV4, DATE, SSN, IBAN, SECRET, CARD))


def _bind(value: Column, f) -> Column:
    """f(value), with value computed once: as a plain Column its expression would be repeated at each use."""
    return F.transform(F.array(value), lambda x: f(x))[0]


def _hash(key: str, tag: Column, value: Column, modulus: Column) -> Column:
    """A keyed number below modulus, from 60 bits of SHA-256."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tag, value.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), modulus)


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, tag: Column, key: str, undo: bool = False) -> Column:
    """Permutes (a, b) in size_a x size_b, as struct<a, b>: in turn each half is moved by a keyed function of the other.
    `tag` names the format, so formats are permuted apart; `undo` gives the inverse. The halves may differ in size, so no
    value has to be walked into its range."""
    sign = -1 if undo else 1
    rounds = F.lit(list(reversed(range(ROUNDS))) if undo else list(range(ROUNDS)))

    def step(s: Column, r: Column) -> Column:
        t = F.concat(tag, F.lit("/"), r.cast("string"))
        left = F.pmod(s["a"] + sign * _hash(key, t, s["b"], size_a), size_a)
        right = F.pmod(s["b"] + sign * _hash(key, t, s["a"], size_b), size_b)
        even = r % 2 == 0
        return F.struct(F.when(even, left).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(right).alias("b"))

    return F.aggregate(rounds, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def permute_digits(digits: Column, tag: str, key: str, undo: bool = False) -> Column:
    """A permutation of the strings of so many decimal digits (2 to 30)."""

    def one(d: Column) -> Column:
        n, h = F.length(d), F.floor(F.length(d) / 2).cast("int")
        power = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("long")
        full = F.concat(F.lit(f"{tag}/"), n.cast("string"))
        state = feistel(F.substr(d, F.lit(1), h), F.substr(d, h + 1), power(h), power(n - h), full, key, undo)
        return _bind(state, lambda s: F.concat(F.lpad(s["a"].cast("string"), h, "0"), F.lpad(s["b"].cast("string"), n - h, "0")))

    return _bind(digits, one)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def with_digits(value: Column, digits: Column) -> Column:
    """value with its digits replaced in order; all else stays in place."""

    def step(s: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(s["out"], F.when(is_digit, F.substr(digits, s["k"], F.lit(1))).otherwise(c)).alias("out"),
            (s["k"] + is_digit.cast("int")).alias("k"),
        )

    return F.aggregate(F.split(value, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), step, lambda s: s["out"])


def card(value: Column, key: str, undo: bool = False) -> Column:
    def digits(d: Column) -> Column:
        body = permute_digits(F.substr(d, F.lit(1), F.length(d) - 1), "card", key, undo)
        valid = lambda b: F.filter(F.lit(list("0123456789")), lambda c: F.call_function("luhn_check", F.concat(b, c)))
        return _bind(body, lambda b: F.concat(b, valid(b)[0]))

    return _bind(digits(digits_of(value)), lambda d: with_digits(value, d))


def phone(value: Column, key: str, undo: bool = False) -> Column:
    """The country code stays; the digits after it are permuted. A trunk zero in brackets is no part of the number."""
    bare = F.replace(value, F.lit("(0)"), F.lit("(\u0001)"))

    def digits(d: Column) -> Column:
        code = F.when(value.startswith("+"), F.regexp_extract(d, COUNTRY_CODE, 0)).otherwise("")
        return F.concat(code, permute_digits(F.substr(d, F.length(code) + 1), "phone", key, undo))

    return F.replace(_bind(_bind(digits_of(bare), digits), lambda d: with_digits(bare, d)), F.lit("(\u0001)"), F.lit("(0)"))


def mod97(text: Column) -> Column:
    """The remainder of a number whose letters stand for 10 to 35."""

    def step(r: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.rlike("[0-9]"), (r * 10 + c.cast("int")) % 97).otherwise((r * 100 + letter) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def iban(value: Column, key: str, undo: bool = False) -> Column:
    """The digits behind the check digits are permuted, the check digits made anew."""
    rest = F.substr(value, F.lit(5))
    moved = _bind(permute_digits(digits_of(rest), "iban", key, undo), lambda d: with_digits(rest, d))
    check = lambda m: F.lpad((98 - mod97(F.concat(F.replace(m, F.lit(" "), F.lit("")), F.substr(value, F.lit(1), F.lit(2)), F.lit("00")))).cast("string"), 2, "0")
    return _bind(moved, lambda m: F.concat(F.substr(value, F.lit(1), F.lit(2)), check(m), m))


def ssn(value: Column, key: str, undo: bool = False) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999: numbered without gaps, permuted, written again."""
    part = lambda k: F.split(value, "-")[k].cast("long")
    area = part(0) - F.when(part(0) > 666, 2).otherwise(1)
    state = feistel(area, (part(1) - 1) * 9999 + part(2) - 1, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"), F.lit("ssn"), key, undo)
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
    return _bind(state, lambda s: F.concat_ws("-", pad(s["a"] + F.when(s["a"] >= 665, 2).otherwise(1), 3), pad(F.floor(s["b"] / 9999) + 1, 2), pad(s["b"] % 9999 + 1, 4)))


def ipv4(value: Column, key: str, undo: bool = False) -> Column:
    o = lambda k: F.split(value, r"\.")[k].cast("long")
    size = F.lit(65536).cast("long")
    state = feistel(o(0) * 256 + o(1), o(2) * 256 + o(3), size, size, F.lit("ipv4"), key, undo)
    part = lambda x: F.concat(F.floor(x / 256).cast("string"), F.lit("."), (x % 256).cast("string"))
    return _bind(state, lambda s: F.concat(part(s["a"]), F.lit("."), part(s["b"])))


def date(value: Column, key: str, undo: bool = False) -> Column:
    """Days from 1600 on, each permuted within its Gregorian cycle of 400 years (years 0000 and 9999 wrap in their own)."""
    day = F.datediff(F.try_to_date(value, "yyyy-MM-dd"), F.lit("2000-01-01").cast("date")).cast("long")

    def one(d: Column) -> Column:
        cycle, inside = F.floor(d / 146097), F.pmod(d, F.lit(146097).cast("long"))
        state = feistel(F.floor(inside / 773), inside % 773, F.lit(189).cast("long"), F.lit(773).cast("long"), F.lit("date"), key, undo)
        to = lambda s: F.date_add(F.lit("2000-01-01").cast("date"), (cycle * 146097 + s["a"] * 773 + s["b"]).cast("int"))
        return _bind(state, lambda s: F.date_format(to(s), "yyyy-MM-dd"))

    return _bind(day, one)


def email(value: Column, key: str) -> Column:
    """The local part becomes keyed letters of the same length; the domain stays."""
    local = F.substring_index(value, "@", 1)
    text = F.translate(F.sha2(F.concat(F.lit(f"{key}|email|"), value), 256), "0123456789", "ghijklmnop")
    return F.concat(F.substr(text, F.lit(1), F.length(local)), F.substr(value, F.length(local) + 1))


def secret(value: Column, key: str) -> Column:
    text = F.substr(F.sha2(F.concat(F.lit(f"{key}|secret|"), F.lower(value)), 256), F.lit(1), F.length(value))
    return F.when(value == F.upper(value), F.upper(text)).otherwise(text)


def kind_of(value: Column) -> Column:
    """The validated kind of a candidate; null when its check fails."""
    whole = lambda p: value.rlike(f"^(?:{p})$")
    octets = F.forall(F.split(value, r"\."), lambda x: (x.cast("int") <= 255) & ~x.rlike("^0."))
    social = ~value.rlike("^(000|666|9)|-00-|-0000$")
    n = F.length(digits_of(F.replace(value, F.lit("(0)"), F.lit(""))))
    account = F.replace(value, F.lit(" "), F.lit(""))
    return (
        F.when(value.contains("@"), F.lit("email"))
        .when(value.startswith("+"), F.when(n.between(8, 15), F.lit("phone")))
        .when(value.startswith("(") | whole(r"\d{3}-\d{3}-\d{4}"), F.lit("phone"))
        .when(whole(r"\d{3}-\d{2}-\d{4}"), F.when(social, F.lit("ssn")))
        .when(whole(r"\d{1,3}(?:\.\d{1,3}){3}"), F.when(octets, F.lit("ipv4")))
        .when(whole(r"\d{4}-\d{2}-\d{2}"), F.when(F.try_to_date(value, "yyyy-MM-dd").isNotNull(), F.lit("date")))
        .when(whole(r"[\d -]{13,24}"), F.when(n.between(13, 19) & F.call_function("luhn_check", digits_of(value)), F.lit("card")))
        .when(whole(IBAN) & F.length(account).between(15, 34) & (n >= 4) & (mod97(F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))) == 1), F.lit("iban"))
        .when(whole(r"[0-9a-fA-F]{32,64}"), F.lit("secret"))
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    return (
        F.when(kind == "card", card(value, key)).when(kind == "phone", phone(value, key)).when(kind == "ipv4", ipv4(value, key))
        .when(kind == "ssn", ssn(value, key)).when(kind == "date", date(value, key)).when(kind == "iban", iban(value, key)).when(kind == "email", email(value, key)).when(kind == "secret", secret(value, key))
        .otherwise(value)
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """docs with text_col rewritten and `pii`: array<struct<kind, pseudonym>> of what was replaced, in order. One pass, no
    shuffle: each text is split at its candidates and joined again around their pseudonyms."""
    text = F.col(f"`{text_col}`")
    found = F.when(text.rlike(r"[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    held = "_pii"
    while held in docs.columns:
        held += "_"

    def one(v: Column) -> Column:
        return _bind(kind_of(v), lambda k: F.struct(k.alias("kind"), pseudonym(v, k, key).alias("pseudonym")))

    out = docs.withColumn(held, F.transform(found, one))
    gaps = F.split(text, ANY, -1)
    values = F.concat(F.transform(held, lambda p: p["pseudonym"]), F.array(F.lit("")))
    rewritten = F.array_join(F.zip_with(gaps, values, lambda g, v: F.concat(g, v)), "")
    return out.withColumns({
        text_col: F.when(F.size(held) > 0, rewritten).otherwise(text),
        "pii": F.filter(held, lambda p: p["kind"].isNotNull()),
    }).drop(held)


def op10_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, QUERY_KEY).select(
        "doc_id", "text", F.sha2("text", 256).alias("text_sha256"), F.coalesce(F.size("pii"), F.lit(0)).cast("long").alias("n_pii"),
        F.array_sort(F.transform("pii", lambda p: F.concat(p["kind"], F.lit(":"), p["pseudonym"]))).alias("pseudonyms"),
    )


QUERIES = {"op10_pii_feistel": op10_pii_feistel}
ORACLES: dict[str, str] = {}
