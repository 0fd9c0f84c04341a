"""Personal data: format-preserving Feistel pseudonyms, in SQL functions only.

One pattern finds every candidate; a candidate is validated by its kind (octets of an address, calendar days, Luhn digit
and leading digit of a card, mod-97 digits of an account, the parts of a social security number) and replaced within its
format: a keyed Feistel network permutes the digits, the letters, the day number or the 32 bits of an address; separators
stay, check digits are computed anew. What is no valid value stays as it is, so order numbers, versions and timestamps are
left alone. The permutation depends on the kind, the length and the key alone, so equal values stay linked across documents
and different ones stay apart. Names of mailboxes and secrets have no numeric format; they become keyed digests in the same
alphabet.

Whoever holds the key can undo the permutations, so it is a parameter, read from the session's configuration by the query.
Null texts stay null; empty texts and texts without candidates come back as they are; repeated rows are treated alike; other
columns, whatever their names, are not touched. Whole texts are scanned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_SETTING = "spark.tidemark.pseudonymKey"
TEST_KEY = "for tests and checks alone"
ROUNDS = 10
FIRST_DAY, DAYS = "1900-01-01", 73049  # pseudonymous dates lie in 1900-01-01 .. 2099-12-31

# Fixed patterns, in the order in which they are tried at a place.
SECRET = r"(?<![A-Za-z0-9_])(?i:api[_-]?key|access[_-]?key|auth[_-]?token|token|secret|password|passwd|pwd)\s{0,3}[:=]\s{0,3}[\"']?[A-Za-z0-9_+/=.\-]{8,}+"
BEARER = r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9_-]{20,}+|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)"
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
DATE = r"(?<![0-9./\-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./\-][0-9]{2}[./\-][0-9]{4})(?![0-9])"
ADDRESS = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
PHONE = r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .\-]?\([0-9]{1,4}\)[ .\-]?[0-9]{3,4}[ .\-]?[0-9]{3,4}|\+[0-9]{1,3}(?:[ \-]?[0-9]{2,4}){2,4}(?!\.[0-9])|\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}|[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4})(?![0-9])"
SSN = r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"
NUMBER = r"(?<![0-9A-Za-z.])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3}(?:[ \-][0-9]{3})?|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})(?![0-9A-Za-z])"
PATTERN = "|".join(f"(?:{p})" for p in (SECRET, BEARER, EMAIL, IBAN, DATE, ADDRESS, PHONE, SSN, NUMBER))
HINT = "[0-9@:=]|sk-|gh[pousr]_|eyJ|AKIA"  # every candidate holds one of these


def let(value: Column, body) -> Column:
    """body(value) with value worked out once, also inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def keyed(key: str, *parts: Column) -> Column:
    """60 bits of a keyed digest, as a long."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256), 1, 15), 16, 10).cast("long")


def feistel(value: Column, left: Column, right: Column, tag: Column, key: str) -> Column:
    """Keyed permutation of the longs 0 .. left * right - 1: the two halves are shifted in turn by a digest of the other."""

    def halves(l: Column, r: Column) -> Column:
        return F.struct(l.cast("long").alias("l"), r.cast("long").alias("r"))

    def step(s, i):
        return F.when(i % 2 == 0, halves((s["l"] + keyed(key, tag, i, s["r"]) % left) % left, s["r"])).otherwise(halves(s["l"], (s["r"] + keyed(key, tag, i, s["l"]) % right) % right))

    start = let(value, lambda v: halves(F.call_function("div", v, right), v % right))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["l"] * right + s["r"])


def power10(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**i).cast("long") for i in range(19)]), n.cast("int") + 1)


def permute_digits(digits: Column, tag: Column, key: str) -> Column:
    """A string of 1 to 18 digits becomes another of its length."""

    def run(d):
        n = F.length(d)
        half = F.floor(n / 2).cast("int")
        return F.lpad(feistel(d.cast("long"), power10(half), power10(n - half), F.concat(tag, F.lit(":"), n), key).cast("string"), n, "0")

    return let(digits, run)


def char(text: Column, at: Column) -> Column:
    return F.substring(text, at, F.lit(1))


def luhn_digit(payload: Column) -> Column:
    """The check digit that makes payload followed by it valid."""
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])

    def run(p):
        total = F.aggregate(
            F.sequence(F.lit(1), F.length(p)),
            F.lit(0),
            lambda s, i: s + F.when((F.length(p) - i) % 2 == 0, F.element_at(doubled, char(p, i).cast("int") + 1)).otherwise(char(p, i).cast("int")),
        )
        return (10 - total % 10) % 10

    return let(payload, run)


def refill(shape: Column, digits: Column, kind: str = "[0-9]") -> Column:
    """The characters of shape with its digits (or others of that kind) replaced, in order, by those of digits."""

    def step(s, c, d):
        return F.when(c.rlike(kind), F.struct(F.concat(s["out"], char(d, s["at"])).alias("out"), (s["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at")))

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return let(digits, lambda d: F.aggregate(F.split(shape, ""), start, lambda s, c: step(s, c, d), lambda s: s["out"]))


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def new_number(m: Column, key: str) -> Column:
    """Card numbers (a leading digit of the card ranges and a right Luhn digit): the payload is permuted and the Luhn digit
    computed anew, so no two meet; the leading digit is permuted too."""

    def run(d):
        payload = F.substring(d, F.lit(1), F.length(d) - 1)
        valid = d.rlike("^[2-6]") & (F.substring(d, F.length(d), F.lit(1)).cast("int") == luhn_digit(payload))
        return F.when(valid, refill(m, let(permute_digits(payload, F.lit("number"), key), lambda p: F.concat(p, luhn_digit(p).cast("string"))))).otherwise(m)

    return let(digits_of(m), run)


def new_phone(m: Column, key: str) -> Column:
    """Country codes stay; the digits after them are permuted."""
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .\-(])", 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    return F.concat(code, let(rest, lambda r: refill(r, permute_digits(digits_of(r), F.lit("phone"), key))))


def new_address(m: Column, key: str) -> Column:
    """Four octets become four others; dotted numbers that are no address stay."""
    half = F.lit(65536).cast("long")

    def run(parts):
        value = reduce(lambda s, i: s * 256 + parts[i].cast("long"), range(1, 4), parts[0].cast("long"))
        dotted = let(feistel(value, half, half, F.lit("address"), key), lambda v: F.concat_ws(".", *[F.shiftright(v, s).bitwiseAND(F.lit(255).cast("long")).cast("string") for s in (24, 16, 8, 0)]))
        return F.when(F.forall(parts, lambda p: p.cast("int") <= 255), dotted).otherwise(m)

    return let(F.split(m, r"\."), run)


def new_date(m: Column, key: str) -> Column:
    """Real days of 1900 to 2099 become other such days in the same notation; others are no dates and stay."""
    start, l, r = F.lit(FIRST_DAY).cast("date"), F.lit(271).cast("long"), F.lit(270).cast("long")
    iso, dashed = m.rlike("^[0-9]{4}"), F.translate(m, "./", "--")
    sep = F.substring(m, 3, 1)
    european = F.try_to_date(dashed, "dd-MM-yyyy")
    american = ~iso & european.isNull()
    day = F.when(iso, F.try_to_date(m, "yyyy-MM-dd")).otherwise(F.coalesce(european, F.try_to_date(dashed, "MM-dd-yyyy")))

    def fresh(number):
        # 271 * 270 is little over the number of days: the permutation is repeated until it lands on a day again
        walk = F.aggregate(F.sequence(F.lit(1), F.lit(8)), feistel(number, l, r, F.lit("date"), key), lambda v, i: F.when(v < DAYS, v).otherwise(feistel(v, l, r, F.lit("date"), key)))
        return let(F.date_add(start, walk.cast("int")), lambda d: written(F.date_format(d, "yyyy"), F.date_format(d, "MM"), F.date_format(d, "dd")))

    def written(y, mo, d):
        return F.when(iso, F.concat_ws("-", y, mo, d)).when(american, F.concat(mo, sep, d, sep, y)).otherwise(F.concat(d, sep, mo, sep, y))

    return let(F.datediff(day, start).cast("long"), lambda n: F.when(n.between(0, DAYS - 1), fresh(n)).otherwise(m))


def mod97(text: Column) -> Column:
    """Value mod 97 of the text with letters read as 10 to 35."""
    return F.aggregate(F.split(text, ""), F.lit(0), lambda s, c: F.when(c.rlike("[0-9]"), (s * 10 + c.try_cast("int")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97))


def permute_letters(letters: Column, tag: Column, key: str) -> Column:
    """A string of 0 to 12 capital letters becomes another of its length."""

    def run(word):
        n = F.length(word)
        half = F.floor(n / 2).cast("int")
        power = lambda k: F.element_at(F.array(*[F.lit(26**i).cast("long") for i in range(7)]), k + 1)
        value = F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda s, c: s * 26 + F.ascii(c) - 65)
        fresh = feistel(value, power(half), power((n - half).cast("int")), F.concat(tag, F.lit(":"), n), key)
        spelled = F.aggregate(F.sequence(F.lit(1), n), F.struct(fresh.alias("v"), F.lit("").alias("out")), lambda s, _: F.struct(F.call_function("div", s["v"], F.lit(26).cast("long")).alias("v"), F.concat(F.char((s["v"] % 26 + 65).cast("int")), s["out"]).alias("out")), lambda s: s["out"])
        return F.when(n > 0, spelled).otherwise(word)

    return let(letters, run)


def new_iban(m: Column, key: str) -> Column:
    """Valid account numbers: the account's digits and letters are permuted in their places (digits by 18, letters by 12),
    both check digits computed anew; the country stays."""

    def run(plain):
        account, country = F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 2)
        valid = mod97(F.concat(account, F.substring(plain, 1, 4))) == 1

        def moved(text, size, permute, name):
            """All of text but its last `size` characters, and those, each permuted."""

            def parts(t):
                at = F.greatest(F.length(t) - size, F.lit(0))
                first, last = F.substring(t, F.lit(1), F.least(at, F.lit(size))), F.substring(t, at + 1, F.length(t))
                lead = F.when(F.length(first) > 0, permute(first, F.lit(name + " lead"), key)).otherwise(F.lit(""))
                return F.concat(lead, F.when(F.length(last) > 0, permute(last, F.lit(name), key)).otherwise(F.lit("")))

            return let(text, parts)

        def put(kinds):
            fresh = refill(refill(account, kinds["d"]), kinds["l"], "[A-Z]")
            return let(fresh, lambda f: refill(m, F.concat(country, F.lpad((98 - mod97(F.concat(f, country, F.lit("00")))).cast("string"), 2, "0"), f), "[A-Z0-9]"))

        both = F.struct(moved(digits_of(account), 18, permute_digits, "account").alias("d"), moved(F.regexp_replace(account, "[^A-Z]", ""), 12, permute_letters, "bank").alias("l"))
        return F.when(valid, let(both, put)).otherwise(m)

    return let(F.regexp_replace(m, " ", ""), run)


def digest_text(m: Column, kind: str, key: str, n: Column) -> Column:
    """n lower-case hex digits; beyond 256 they repeat."""
    wide = F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lit(str(i)), m), 256) for i in range(4)])
    return F.substring(F.repeat(wide, F.ceil(n / 256).cast("int")), F.lit(1), n)


def new_email(m: Column, key: str) -> Column:
    """Mailbox and domain each become a digest, so mail of one domain stays together; the last label stays."""
    low = F.lower(m)
    domain = F.substring_index(low, "@", -1)
    return F.concat(F.lit("u"), digest_text(low, "mailbox", key, F.lit(12)), F.lit("@d"), digest_text(domain, "domain", key, F.lit(8)), F.lit("."), F.substring_index(domain, ".", -1))


def new_secret(m: Column, key: str) -> Column:
    """What stands before the value stays, the value becomes hex digits of its length."""
    head = F.regexp_extract(m, r"^(?i:[a-z_\-]+)\s*[:=]\s*[\"']?", 0)
    value = F.substring(m, F.length(head) + 1, F.length(m))
    return F.concat(head, digest_text(value, "secret", key, F.length(value)))


def whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one match, by the first kind that it is."""
    bearer = digest_text(m, "bearer", key, F.length(m))
    return (
        F.when(m.rlike(whole(SECRET)), new_secret(m, key))
        .when(m.rlike(whole(BEARER)), bearer)
        .when(m.rlike(whole(EMAIL)), new_email(m, key))
        .when(m.rlike(whole(IBAN)), new_iban(m, key))
        .when(m.rlike(whole(DATE)), new_date(m, key))
        .when(m.rlike(whole(ADDRESS)), new_address(m, key))
        .when(m.rlike(whole(PHONE)), new_phone(m, key))
        .when(m.rlike(whole(SSN)), F.when(m.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)"), new_phone(m, key)).otherwise(m))
        .otherwise(new_number(m, key))
    )


def pseudonymise(text: Column, key: str) -> Column:
    """The whole text with every match replaced."""
    between = F.split(text, PATTERN, -1)
    fresh = F.transform(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), lambda m: pseudonym(m, key))
    joined = F.array_join(F.zip_with(between, fresh, lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))), "")
    return F.when(text.rlike(HINT), joined).otherwise(text)


def found(text: Column) -> Column:
    """How many values are replaced at most."""
    return F.when(text.rlike(HINT), F.regexp_count(text, F.lit(PATTERN))).otherwise(F.when(text.isNotNull(), F.lit(0)))


def protect(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """docs with the text column pseudonymised; every other column as it is."""
    return docs.withColumn(text_col, pseudonymise(F.col(text_col), key))


def key_of(spark) -> str:
    """The session's key; sessions without one get the one for tests."""
    return spark.conf.get(KEY_SETTING, TEST_KEY)


def op5_pii(spark, sf_dir: str) -> DataFrame:
    """One row per document: doc_id and the whole text without personal data."""
    from tidemark.llm.common import table

    return protect(table(spark, sf_dir, "documents"), key_of(spark)).select("doc_id", "text")
