"""Format-preserving pseudonyms for personal data, in DataFrame expressions only.

Method. One pattern finds candidates; each is validated by its kind: cards by length and
Luhn digit, dates by the calendar, social security numbers by their ranges, addresses by
their parts. Valid numbers and dates go through a keyed alternating Feistel network over
exactly the set of their format: the digits of a card before its check digit, the days of
a 400-year calendar (189 x 773 of them), the area and remainder of a social security
number, the 32 or 128 bits of an address, the digits of a phone number after the country
code. So a pseudonym is again valid, equal values get equal pseudonyms in all documents
however they are written (with or without separators, either order of a date, with or
without the +1), and different values different ones. E-mail names and secrets, which are
no numbers, get keyed digests, secrets of their own length and case; the mail domain stays.
What fails validation stays as it is, since it is no personal datum but some number. In a
run of four-digit groups every four that pass are a card, from the left.

The round function is SHA-256 over key, kind, round and the other half. The key is read from
the file that ``spark.capturelake.pii.keyPath`` names; without it, each application draws one
of its own. It comes into the plan as a scalar subquery over a table, so that neither plans
nor event logs show it.

Cases. Null texts stay null with counts 0; empty ones stay empty. Every row gives one row;
long texts, ties and repeated rows need no care, as a row is handled alone, without a
shuffle. Extra columns are ignored, those in keep stay whatever their names. Empty tables
give an empty result.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


KINDS = ("email", "secret", "date", "ssn", "ip", "ipv6", "phone", "card")
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_GROUP = "[0-9A-Fa-f]{1,4}"
_NAME = r"\p{L}\p{N}._+-"
PATTERNS = {
    "email": rf"(?<![{_NAME}])[\p{{L}}\p{{N}}][{_NAME}]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9A-Fa-f]{32,}|AKIA[0-9A-Z]{16}|sk-[A-Za-z0-9]{20,}|gh[opsu]_[A-Za-z0-9]{36})(?![0-9A-Za-z])",
    "date": r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "ipv6": rf"(?<![0-9A-Za-z:.])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?:{_GROUP}(?::{_GROUP}){{0,5}})?::(?:{_GROUP}(?::{_GROUP}){{0,5}})?)(?![0-9A-Za-z:]|\.[0-9])",
    "phone": r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![0-9(])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3,}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
#: country codes of telephone numbers, by their first digits; fixed values
COUNTRY = "^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
RUN = "^[0-9]{4}(?:[ -][0-9]{4}){3,}$"
PATTERN = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS)
ROUNDS = 8


def _full(m: Column, kind: str) -> Column:
    return m.rlike(f"^(?:{PATTERNS[kind]})$")


_DRAWN: dict[str, str] = {}


def key_column(spark: SparkSession, key: str | None = None) -> Column:
    """The key as a scalar subquery: that of the named file, else one that the application draws once."""
    path = spark.conf.get("spark.capturelake.pii.keyPath", None)
    if key is None and path:
        return spark.read.option("wholetext", True).text(path).agg(F.trim(F.max("value"))).scalar()
    if key is None:
        key = _DRAWN.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))
    # rows of the driver: neither plans nor the shared folder show the key
    return spark.createDataFrame([(key,)], "key string").agg(F.max("key")).scalar()


def keyed(key: Column, *parts: Column) -> Column:
    """A keyed digest as 64 hex digits."""
    return F.sha2(F.concat_ws("|", key, *[p.cast("string") for p in parts], key), 256)


def feistel(key: Column, kind: str, left: Column, right: Column, mod_left: Column, mod_right: Column) -> Column:
    """A keyed permutation of the pairs (l, r) with l < mod_left and r < mod_right, as struct<l, r>.

    Rounds alternate, each adding a digest of one half to the other modulo its own size, so any
    sizes work and every round can be undone.
    """

    def mask(i: Column, half: Column) -> Column:
        return F.conv(F.substring(keyed(key, F.lit(kind), i, half), 1, 15), 16, 10).cast("long")

    def step(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(acc["l"] + F.pmod(mask(i, acc["r"]), mod_left), mod_left)).otherwise(acc["l"]).alias("l"),
            F.when(~even, F.pmod(acc["r"] + F.pmod(mask(i, acc["l"]), mod_right), mod_right)).otherwise(acc["r"]).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def permuted_digits(key: Column, kind: str, digits: Column) -> Column:
    """A keyed permutation of the digit strings of each length from 2 to 36."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    left, right = F.substr(digits, F.lit(1), half), F.substr(digits, half + 1)
    out = feistel(key, kind, left, right, F.pow(F.lit(10.0), half).cast("long"), F.pow(F.lit(10.0), n - half).cast("long"))
    # the network is evaluated once, inside a one-element array
    return F.element_at(F.transform(F.array(out), lambda x: F.concat(F.lpad(x["l"].cast("string"), half, "0"), F.lpad(x["r"].cast("string"), n - half, "0"))), 1)


def refill(m: Column, digits: Column) -> Column:
    """m with its digits replaced in order; everything else stays in place."""
    place = F.sequence(F.lit(1), F.length(m))
    return F.array_join(
        F.transform(place, lambda i: F.when(F.substr(m, i, F.lit(1)).rlike("[0-9]"), F.substr(digits, F.length(_digits(F.substr(m, F.lit(1), i))), F.lit(1))).otherwise(F.substr(m, i, F.lit(1)))), ""
    )


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum with the last digit undoubled."""
    back = F.reverse(digits)

    def step(acc: Column, i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step)


def _card(key: Column, m: Column) -> Column:
    body = permuted_digits(key, "card", F.substr(_digits(m), F.lit(1), F.length(_digits(m)) - 1))

    def closed(x: Column) -> Column:
        return F.concat(x, F.pmod(10 - F.pmod(luhn_sum(F.concat(x, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string"))

    return F.element_at(F.transform(F.array(body), lambda x: refill(m, closed(x))), 1)


_EPOCH, _DAYS_LEFT, _DAYS_RIGHT = "1800-01-01", 189, 773


def _day(m: Column) -> Column:
    """The day of a date in one of the three formats, null if there is none or it is outside 1800 to 2199."""
    iso = F.when(m.rlike("^[0-9]{4}"), m).otherwise(F.regexp_replace(m, r"^(..)[./](..)[./](....)$", "$3-$2-$1"))
    day = F.datediff(F.try_to_date(iso, "yyyy-MM-dd"), F.lit(_EPOCH).cast("date"))
    return F.when((day >= 0) & (day < _DAYS_LEFT * _DAYS_RIGHT), day)


def _date(key: Column, m: Column) -> Column:
    day = _day(m)
    out = feistel(key, "date", F.floor(day / _DAYS_RIGHT), F.pmod(day, F.lit(_DAYS_RIGHT)), F.lit(_DAYS_LEFT), F.lit(_DAYS_RIGHT))

    def written(x: Column) -> Column:
        new = F.date_add(F.lit(_EPOCH).cast("date"), (x["l"] * _DAYS_RIGHT + x["r"]).cast("int"))
        return F.when(m.rlike("^[0-9]{4}"), F.date_format(new, "yyyy-MM-dd")).otherwise(refill(m, F.date_format(new, "ddMMyyyy")))

    return F.element_at(F.transform(F.array(out), written), 1)


def _ssn(key: Column, m: Column) -> Column:
    """Areas 001 to 899 without 666 and the rest (group 01 to 99, serial 0001 to 9999) as one number."""
    d = _digits(m)
    area, group, serial = (F.substr(d, F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 3), (4, 2), (6, 4)))
    left = F.when(area > 666, area - 2).otherwise(area - 1)
    out = feistel(key, "ssn", left, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999))

    def written(x: Column) -> Column:
        a = F.when(x["l"] >= 665, x["l"] + 2).otherwise(x["l"] + 1)
        return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((F.floor(x["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((x["r"] % 9999 + 1).cast("string"), 4, "0"))

    return F.element_at(F.transform(F.array(out), written), 1)


def _valid_ssn(m: Column) -> Column:
    return m.rlike("^(?!000|666|9..)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")


def _ip(key: Column, m: Column) -> Column:
    part = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    out = feistel(key, "ip", part[0] * 256 + part[1], part[2] * 256 + part[3], F.lit(65536), F.lit(65536))
    return F.element_at(
        F.transform(F.array(out), lambda x: F.concat_ws(".", *[y.cast("long").cast("string") for y in (F.floor(x["l"] / 256), x["l"] % 256, F.floor(x["r"] / 256), x["r"] % 256)])), 1
    )


def _country(m: Column) -> Column:
    """The country code of a number that begins with a plus, else nothing."""
    return F.when(m.startswith("+"), F.regexp_extract(_digits(m), COUNTRY, 1)).otherwise(F.lit(""))


def _phone(key: Column, m: Column) -> Column:
    rest = F.substr(_digits(m), F.length(_country(m)) + 1)
    return refill(m, F.concat(_country(m), permuted_digits(key, "phone", rest)))


def expanded(m: Column) -> Column:
    """The 32 hexadecimal digits of an IPv6 address, null if it has no room for its groups."""

    def groups(x: Column) -> Column:
        return F.transform(F.filter(F.split(x, ":"), lambda g: g != ""), lambda g: F.lpad(F.lower(g), 4, "0"))

    left, right = groups(F.substring_index(m, "::", 1)), groups(F.when(m.contains("::"), F.substring_index(m, "::", -1)).otherwise(F.lit("")))
    n = F.size(left) + F.size(right)
    short = m.contains("::") & (n >= 2) & (n <= 7) & m.rlike("[0-9]")
    return F.when(short | (~m.contains("::") & (n == 8)), F.concat(F.array_join(left, ""), F.repeat(F.lit("0000"), F.lit(8) - n), F.array_join(right, "")))


def _ipv6(key: Column, m: Column) -> Column:
    """Alternating exclusive ors of the two halves."""

    def signed(x: Column) -> Column:
        return F.conv(x, 16, -10).cast("long")

    def step(acc: Column, i: Column) -> Column:
        even = i % 2 == 0

        def mask(half: Column) -> Column:
            return signed(F.substring(keyed(key, F.lit("ipv6"), i, half), 1, 16))

        return F.struct(
            F.when(even, acc["l"].bitwiseXOR(mask(acc["r"]))).otherwise(acc["l"]).alias("l"),
            F.when(~even, acc["r"].bitwiseXOR(mask(acc["l"]))).otherwise(acc["r"]).alias("r"),
        )

    whole = expanded(m)
    begin = F.struct(signed(F.substring(whole, 1, 16)).alias("l"), signed(F.substring(whole, 17, 16)).alias("r"))
    out = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), begin, step)

    def written(x: Column) -> Column:
        digits = F.lower(F.concat(F.lpad(F.hex(x["l"]), 16, "0"), F.lpad(F.hex(x["r"]), 16, "0")))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.regexp_replace(F.substr(digits, i * 4 + 1, F.lit(4)), "^0{1,3}", "")), ":")

    return F.element_at(F.transform(F.array(out), written), 1)


def _cased(m: Column, new: Column) -> Column:
    return F.when((F.upper(m) == m) & (F.lower(m) != m), F.upper(new)).otherwise(new)


def _email(key: Column, m: Column) -> Column:
    name, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    size = F.greatest(F.length(name) - 1, F.lit(15))
    return F.concat(_cased(m, F.concat(F.lit("u"), F.substr(keyed(key, F.lit("email"), F.lower(m)), F.lit(1), size))), F.lit("@"), domain)


def _secret(key: Column, m: Column) -> Column:
    once = keyed(key, F.lit("secret"), F.lower(m))
    long = F.repeat(once, F.ceil(F.length(m) / 64).cast("int"))
    return _cased(m, F.substr(long, F.lit(1), F.length(m)))


def _passes(d: Column) -> Column:
    """Whether digits pass as a card."""
    return (F.pmod(luhn_sum(d), F.lit(10)) == 0) & d.rlike("[1-9]")


def kind_of(m: Column) -> Column:
    """The kind of a valid match, null for a candidate that fails validation; runs of groups are cards if any four pass."""
    d = _digits(m)
    return (
        F.when(m.contains("@"), "email")
        .when(_full(m, "secret"), "secret")
        .when(_full(m, "date"), F.when(_day(m).isNotNull(), "date"))
        .when(_full(m, "ssn"), F.when(_valid_ssn(m), "ssn"))
        .when(_full(m, "ip"), "ip")
        .when(m.contains(":"), F.when(expanded(m).isNotNull(), "ipv6"))
        .when(_full(m, "phone"), "phone")
        .when(F.length(d).between(13, 19), F.when(_passes(d), "card"))
    )


def canonical(kind: Column, m: Column) -> Column:
    """A value in the one form that links all ways to write it."""
    return (
        F.when(kind.isin("card", "ssn"), _digits(m))
        .when(kind == "phone", F.concat(F.when(m.startswith("+"), "").otherwise("1"), _digits(m)))
        .when(kind == "date", _day(m).cast("string"))
        .when(kind == "ip", F.array_join(F.transform(F.split(m, r"\."), lambda x: x.cast("int").cast("string")), "."))
        .when(kind == "ipv6", expanded(m))
        .otherwise(F.lower(m))
    )


def pseudonym(key: Column, kind: Column, m: Column) -> Column:
    makers = {"email": _email, "secret": _secret, "date": _date, "ssn": _ssn, "ip": _ip, "ipv6": _ipv6, "phone": _phone, "card": _card}
    out = F.when(kind.isNull(), m)
    for k, make in makers.items():
        out = out.when(kind == k, make(key, m))
    return out


def _run(key: Column, m: Column) -> Column:
    """struct<text, skip, found>: a run of four-digit groups with its cards replaced, and (was, now) of each."""
    n = F.floor((F.length(m) + 1) / 5).cast("int")

    def step(acc: Column, i: Column) -> Column:
        four = F.substr(m, i * 5 + 1, F.lit(19))
        hit = (acc["skip"] == 0) & (i + 4 <= n) & _passes(_digits(four))
        more = F.when(hit, F.array(F.struct(four.alias("was"), _card(key, four).alias("now"))))
        return F.element_at(
            F.transform(
                F.array(more),
                lambda x: F.struct(
                    F.when(x.isNotNull(), F.concat(acc["text"], x[0]["now"], F.substr(m, i * 5 + 20, F.lit(1)))).when(acc["skip"] > 0, acc["text"]).otherwise(F.concat(acc["text"], F.substr(m, i * 5 + 1, F.lit(5)))).alias("text"),
                    F.when(x.isNotNull(), 3).otherwise(F.greatest(acc["skip"] - 1, F.lit(0))).alias("skip"),
                    F.concat(acc["found"], F.coalesce(x, F.array().cast("array<struct<was:string,now:string>>"))).alias("found"),
                ),
            ),
            1,
        )

    begin = F.struct(F.lit("").alias("text"), F.lit(0).alias("skip"), F.array().cast("array<struct<was:string,now:string>>").alias("found"))
    return F.aggregate(F.sequence(F.lit(0), n - 1), begin, step)


def pseudonymise(docs: DataFrame, key: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple | list = ()) -> DataFrame:
    """(id, text, found) and the columns in keep: the text with pseudonyms, and found array<struct<kind, link, now>>.

    link is a keyed digest of the original value in one form, now its pseudonym.
    """
    text, secret = F.col("text"), F.col("key")
    kept = F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), kept.alias("kept"))
    rows = rows.withColumn("key", key_column(docs.sparkSession, key))
    maybe = text.rlike("[0-9@]|AKIA|sk-|gh[opsu]_")
    # texts without a candidate are not split; -1 keeps trailing empty pieces, so there is one more than matches
    rows = rows.withColumn("matches", F.when(maybe, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))))
    has = F.size("matches") > 0
    nothing = F.array().cast("array<struct<was:string,now:string>>")

    def handle(m: Column) -> Column:
        run = F.transform(F.array(_run(secret, m)), lambda r: F.struct(F.when(F.size(r["found"]) > 0, "card").alias("kind"), r["text"].alias("now"), r["found"].alias("found")))
        made = F.transform(F.array(kind_of(m)), lambda k: F.struct(k.alias("kind"), pseudonym(secret, k, m).alias("now")))
        one = F.transform(made, lambda x: F.struct(x["kind"].alias("kind"), x["now"].alias("now"), F.when(x["kind"].isNotNull(), F.array(F.struct(m.alias("was"), x["now"].alias("now")))).otherwise(nothing).alias("found")))
        return F.element_at(F.when(m.rlike(RUN), run).otherwise(one), 1)

    rows = rows.withColumn("done", F.when(has, F.transform("matches", handle)))
    pieces = F.split(text, PATTERN, -1)
    joined = F.array_join(F.zip_with(pieces, F.col("done"), lambda p, d: F.concat(p, F.coalesce(d["now"], F.lit("")))), "")
    found = F.coalesce(F.flatten(F.transform("done", lambda d: F.transform(d["found"], lambda x: F.struct(d["kind"].alias("kind"), x["was"].alias("was"), x["now"].alias("now"))))), F.array().cast("array<struct<kind:string,was:string,now:string>>"))
    return rows.select(
        "id",
        F.when(has, joined).otherwise(text).alias("text"),
        F.transform(found, lambda d: F.struct(d["kind"].alias("kind"), keyed(secret, F.lit("link"), d["kind"], canonical(d["kind"], d["was"])).alias("link"), d["now"].alias("now"))).alias("found"),
        *[F.col("kept")[f"c{i}"].alias(c) for i, c in enumerate(keep)],
    )


def counts(found: Column) -> list[Column]:
    def of(kind: str) -> Column:
        return F.size(F.filter(found, lambda d: d["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [of(k) for k in KINDS]


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = pseudonymise(docs)
    return out.select(F.col("id").alias("doc_id"), "text", *counts(F.col("found")))
