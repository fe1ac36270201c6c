"""PII: format-preserving Feistel pseudonyms, with DataFrame functions only.

Numbers with separators are permuted by a keyed Feistel network over their decimal digits
and put back into their format; equal values get equal pseudonyms in every document.
Card numbers (13 to 19 digits, Luhn-valid; beside other numbers only in the usual groups)
keep a valid check digit; dates (yyyy-mm-dd,
valid, 1900 to 2099) become other valid ones by walking the cycle of a five-digit network;
numbers of the forms 123-45-6789 and of telephones are permuted whole. One way, by a keyed
digest: IPv4 addresses become valid ones, e-mail names hexadecimal digits at example.org.
Numbers that fail their check stay.

A null text stays null, an empty one empty. Rows are treated each; other columns stay as
they are. An empty table gives no rows. The key is a parameter; keep it secret.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# No match begins inside a run of its characters, and none gives back what it has read: the
# time stays in proportion to the text, and the matcher does not recurse.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.]*[0-9])"
DATE = r"(?<![0-9])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9])"
SOCIAL = r"(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])"
# A telephone number takes no digits from one of three, three and four digits that follows.
NEXT = r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
PHONE = (
    rf"(?!(?:[0-9]{{1,4}}[ .-]){{1,2}}{NEXT})(?:\+[0-9]{{1,3}}[ .-]?)?"
    r"\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"
)
# What may be a card number, the likeliest first. The first form is a whole run of numbers,
# grouped in any way; the others may stand beside other numbers.
RUN = r"(?<![0-9])(?<![0-9][ -])(?=([0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])))"
CARDS = (
    RUN,
    r"(?<![0-9])(?=([0-9]{13,19}(?![0-9])))",
    r"(?<![0-9])(?<![0-9]-)(?=([0-9]{4}(?: [0-9]{4}){3}(?![0-9])))",
    r"(?<![0-9])(?=([0-9]{4}(?:-[0-9]{4}){3}(?![0-9])))",
    r"(?<![0-9])(?=([0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}(?![0-9])))",
    r"(?<![0-9])(?<![0-9]-)(?=([0-9]{4}(?: [0-9]{3}){3}(?![0-9])))",
    r"(?<![0-9])(?=([0-9]{4}(?:-[0-9]{3}){3}(?![0-9])))",
    rf"(?<![0-9])(?<![0-9]-)(?=([0-9]{{4}}(?: [0-9]{{4}}){{3}} (?!{NEXT}|{SOCIAL})[0-9]{{1,3}}(?![0-9])))",
    rf"(?<![0-9])(?=([0-9]{{4}}(?:-[0-9]{{4}}){{3}}-(?!{NEXT}|{SOCIAL})[0-9]{{1,3}}(?![0-9])))",
)
# A run that holds one of these is no card number as a whole.
SHORTER = "|".join((DATE, SOCIAL, rf"(?<![0-9]){NEXT}"))
# Card numbers that fail their check are not telephone numbers either.
FAILED = (
    r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}"
    rf"(?:(?:[ -][0-9]{{1,3}})?(?![ -]?[0-9])|(?=[ -]{PHONE}))"
)
FIRST = "|".join((EMAIL, IP, DATE, SOCIAL))
THEN = "|".join((FAILED, PHONE))
FIRST_DAY, DAYS = "1900-01-01", 73049


def feistel(digits: Column, key: str, label: str) -> Column:
    """A permutation of the decimal strings of each length (2 to 30 digits)."""
    half = F.floor(F.length(digits) / 2).cast("int")
    start = F.struct(
        F.substr(digits, F.lit(1), half).alias("l"), F.substr(digits, half + 1).alias("r")
    )

    def turn(s: Column, i: Column) -> Column:
        keyed = F.sha2(F.concat_ws(":", F.lit(key), F.lit(label), i.cast("string"), s["r"]), 256)
        size = F.length(s["l"])
        number = F.conv(F.substring(keyed, 1, 14), 16, 10).cast("decimal(20,0)")
        limit = F.rpad(F.lit("1"), size + 1, "0").cast("decimal(20,0)")
        moved = (s["l"].cast("decimal(20,0)") + number) % limit
        return F.struct(
            s["r"].alias("l"), F.lpad(moved.cast("decimal(20,0)").cast("string"), size, "0").alias("r")
        )

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, turn, lambda s: F.concat(s["l"], s["r"]))


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum with the last digit undoubled."""
    values = F.reverse(F.transform(F.split(digits, ""), lambda c: c.cast("int")))
    weighed = F.transform(
        values, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    )
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d)


def _refill(value: Column, digits: Column) -> Column:
    """The value with its digits replaced one by one."""
    between = F.split(value, "[0-9]", -1)
    return F.array_join(
        F.zip_with(between, F.split(digits, ""), lambda s, d: F.concat(s, F.coalesce(d, F.lit("")))), ""
    )


def pseudonym(value: Column, key: str) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    body = feistel(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    card = _refill(value, F.concat(body, check.cast("string")))

    day = F.datediff(F.try_to_date(value, "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date"))
    once = lambda d: feistel(F.lpad(d.cast("string"), 5, "0"), key, "date").cast("int")
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(24)), once(day), lambda d, i: F.when(d < DAYS, d).otherwise(once(d))
    )
    date = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), walk), "yyyy-MM-dd")

    parts = F.split(value, r"\.")
    keyed = F.sha2(F.concat(F.lit(f"{key}:ip:"), value), 256)
    ip = F.array_join(
        F.transform(parts, lambda p, i: F.conv(F.substr(keyed, i * 2 + 1, F.lit(2)), 16, 10)), "."
    )
    valid_ip = F.forall(parts, lambda p: p.cast("int") < 256)
    name = F.substring(F.sha2(F.concat(F.lit(f"{key}:mail:"), F.lower(value)), 256), 1, 12)
    whole = lambda p: value.rlike(f"^(?:{p})$")
    return (
        F.when(whole(EMAIL), F.concat(F.lit("u"), name, F.lit("@example.org")))
        .when(whole(IP), F.when(valid_ip, ip).otherwise(value))
        .when(whole(DATE), F.coalesce(date, value))
        .when(whole(SOCIAL) | whole(PHONE), _refill(value, feistel(digits, key, "number")))
        .when(luhn_sum(digits) % 10 == 0, card)
        .otherwise(value)
    )


def _cards(text: Column) -> Column:
    """The distinct valid card numbers of a text, as they are written there."""
    found = F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in CARDS]))
    valid = lambda v: (luhn_sum(F.regexp_replace(v, "[^0-9]", "")) % 10 == 0) & ~v.rlike(SHORTER)
    may = text.rlike("[0-9](?:[ -]?[0-9]){12}")
    none = F.array().cast("array<string>")
    return F.when(may, F.filter(F.array_distinct(found), valid)).otherwise(none)


def _pieces(text: Column, pattern: Column, rest) -> Column:
    """The text as pieces in order; ``rest`` makes pieces of what lies between the values."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    value = lambda v: F.struct(F.coalesce(v, F.lit("")).alias("s"), v.isNotNull().alias("hit"))
    return F.flatten(
        F.zip_with(F.split(text, pattern, -1), found, lambda s, v: F.concat(rest(s), F.array(value(v))))
    )


def pseudonymise(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """The rows with every value found in ``column`` replaced; n_found, the number of
    replaced values, is added, in place of a column of that name.

    Valid card numbers are looked for first, so that no other value takes a part of them.
    """
    # The given columns travel as one, whatever their names.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(column).alias("text"))
    text = F.col("text")
    cards = F.concat(F.lit("(?<![0-9])(?:"), F.array_join("cards", "|"), F.lit(f")(?![0-9])|{FIRST}"))
    first = F.when(F.size("cards") > 0, F.concat(F.lit(f"{EMAIL}|"), cards)).otherwise(F.lit(FIRST))
    plain = lambda s: F.array(F.struct(s.alias("s"), F.lit(False).alias("hit")))
    staged = rows.withColumn("cards", _cards(text)).withColumn("first", first)
    staged = staged.withColumn(
        "pieces", _pieces(text, F.col("first"), lambda s: _pieces(s, F.lit(THEN), plain))
    )
    put = F.transform("pieces", lambda p: F.when(p["hit"], pseudonym(p["s"], key)).otherwise(p["s"]))
    staged = staged.withColumn("put", put)
    # Values that fail their check stay.
    n = F.size(F.filter(F.zip_with("pieces", "put", lambda p, q: p["s"] != q), lambda changed: changed))
    new = F.when(n > 0, F.array_join("put", "")).otherwise(text)
    return staged.select(
        *[(new if c == column else F.col("row").getField(c)).alias(c) for c in docs.columns if c != "n_found"],
        F.coalesce(F.greatest(n, F.lit(0)), F.lit(0)).alias("n_found"),
    )
