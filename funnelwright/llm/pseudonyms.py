"""Format-preserving pseudonyms for personal data, with built-in functions only.

A value is found by its shape, validated (check digits, calendar, number
ranges), and moved by a keyed Feistel permutation of the set of all valid
values of its format. So a card number stays a valid card number of the same
length and layout, a date stays a date, equal values get equal pseudonyms in
every document, and different values different ones. Numbers that fail their
check are ordinary text and stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.llm.common import bound, documents

ROUNDS = 10
#: The secret comes from this setting; the default is for tests only.
KEY_SETTING = "spark.funnelwright.pseudonyms.key"
TEST_KEY = "not-a-secret"

_START, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
# Length of an account number by country, from the public registry of IBAN formats.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24,
    "XK": 20,
}


def _iban_shape() -> str:
    """Numbers of their country's length, in either case, then those of other countries.

    A word that follows is no part of a number whose length is known.
    """
    shapes = []
    for length in sorted(set(IBAN_LENGTHS.values())):
        countries = "|".join(c for c, n in IBAN_LENGTHS.items() if n == length)
        fours, rest = divmod(length - 4, 4)
        tail = f"(?: ?[A-Z0-9]{{{rest}}})" if rest else ""
        shapes.append(f"(?:{countries})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}{tail}" + _END)
    known = "|".join(shapes)
    other = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END
    # the countries are tried only where two letters and two digits stand
    return _START + f"(?=[A-Za-z]{{2}}[0-9]{{2}})(?:(?i:{known})|{other})"


#: By kind, in order of precedence. A shape has no groups that capture.
SHAPES = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"(?<=(?i:token|secret|api_key|password) ?[=:] ?\"?)[0-9a-fA-F]{32,64}" + _END,
    # keys that tell what they are by how they begin
    "key": _START + r"(?=[Ag])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[oprsu]_[A-Za-z0-9]{36})" + _END,
    "iban": _iban_shape(),
    "date": _START
    + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?:(?=[Tt][0-9]{2})|(?![\p{L}\p{N}]))|(?:[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})"
    + _END
    + ")",
    "ssn": _START + r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])" + _END,
    "ip": r"(?<![\p{L}\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[\p{L}\p{N}])",
    # national groups, groups after 00 and a country code or an area code in brackets, groups after a country code (8 to 15 digits in all), then one run after a country code
    "phone": r"(?<![\p{L}\p{N}+])(?:(?:\+[0-9]{1,3}[ .-]?)?"
    r"(?:\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4})" + _END
    + r"|00[1-9][0-9]{0,2}(?: [0-9]{2,4}){3,5}"
    + _END
    + r"|\(0[0-9]{1,4}\) ?[0-9]{3,4}[ -]?[0-9]{3,4}"
    + _END
    + r"|\+[0-9](?:[ ().-]{0,2}[0-9]){7,14}"
    + _END
    + r"|\+[0-9]{1,3}[ .-]?[0-9]{6,12}"
    + _END
    + ")",
    # a neighbouring number is no part of it; the check digit decides
    "card": _START
    + r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})"
    + _END,
}
PATTERN = "|".join(f"(?:{s})" for s in SHAPES.values())
_LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _noise(key: Column, *parts: Column) -> Column:
    """64 keyed hex digits."""
    return F.sha2(F.concat_ws("|", key, *[p.cast("string") for p in parts]), 256)


def permute_symbols(text: Column, alphabet: str, key: Column, tweak: Column) -> Column:
    """Feistel permutation of the strings of one length over an alphabet.

    Halves are added symbol by symbol to keyed noise, up to 32 symbols a half.
    Strings under two symbols stay.
    """
    radix = len(alphabet)

    def turn(state: Column, round_: Column) -> Column:
        noise = _noise(key, tweak, round_, F.array_join(state["r"].cast("array<string>"), ","))
        added = bound(
            noise,
            lambda hex_: F.transform(
                state["l"],
                lambda x, i: (x + F.conv(F.substring(hex_, i * 2 + 1, F.lit(2)), 16, 10).cast("int")) % radix,
            ),
        )
        return F.struct(state["r"].alias("l"), added.alias("r"))

    def whole(symbols: Column) -> Column:
        half = F.floor(F.size(symbols) / 2).cast("int")
        state = F.struct(
            F.slice(symbols, F.lit(1), half).alias("l"),
            F.slice(symbols, half + 1, F.size(symbols) - half).alias("r"),
        )
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(ROUNDS)),
            state,
            turn,
            lambda s: F.array_join(
                F.transform(F.concat(s["l"], s["r"]), lambda d: F.substring(F.lit(alphabet), d + 1, F.lit(1))), ""
            ),
        )

    symbols = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    return F.when(F.length(text) < 2, text).otherwise(bound(symbols, whole))


def permute_pair(left: Column, right: Column, n_left: int, n_right: int, key: Column, tweak: Column) -> Column:
    """Feistel permutation of the pairs below (n_left, n_right); a struct of l and r."""

    def turn(state: Column, round_: Column) -> Column:
        noise = F.conv(F.substring(_noise(key, tweak, round_, state["r"]), 1, 15), 16, 10).cast("bigint")
        return F.struct(
            state["r"].alias("l"),
            F.pmod(state["l"] + noise, state["nl"]).alias("r"),
            state["nr"].alias("nl"),
            state["nl"].alias("nr"),
        )

    start = F.struct(
        left.cast("bigint").alias("l"),
        right.cast("bigint").alias("r"),
        F.lit(n_left).cast("bigint").alias("nl"),
        F.lit(n_right).cast("bigint").alias("nr"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _laid_out(value: Column, symbols: Column) -> Column:
    """The symbols put in place of the letters and digits of a value, other characters kept."""
    places = F.split(value, "")
    is_symbol = lambda c: c.rlike("[0-9A-Za-z]")
    filled = F.transform(
        places,
        lambda c, i: F.when(
            is_symbol(c), F.substring(symbols, F.size(F.filter(F.slice(places, F.lit(1), i + 1), is_symbol)), F.lit(1))
        ).otherwise(c),
    )
    return F.array_join(filled, "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, the last one counted as it is."""
    return F.aggregate(
        F.transform(
            F.reverse(F.split(digits, "")),
            lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
                (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")
            ),
        ),
        F.lit(0),
        lambda a, d: a + d,
    )


def _card(value: Column, key: Column) -> Column:
    """First digit kept, the others permuted, the check digit computed anew."""

    def moved(digits: Column) -> Column:
        n = F.length(digits)
        body = F.concat(
            F.substring(digits, 1, 1),
            permute_symbols(
                F.substring(digits, F.lit(2), n - 2),
                "0123456789",
                key,
                F.concat(F.lit("card"), n.cast("string"), F.substring(digits, 1, 1)),
            ),
        )
        whole = bound(
            body,
            lambda b: F.concat(b, F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")),
        )
        return F.when((luhn_sum(digits) % 10 == 0) & ~digits.rlike("^0+$"), bound(whole, lambda s: _laid_out(value, s)))

    return bound(_digits(value), moved)


def _mod97(chars: Column) -> Column:
    return F.aggregate(
        F.split(chars, ""),
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("string").try_cast("int")) % 97).otherwise(
            (a * 100 + F.instr(F.lit(_LETTERS), c) - 1) % 97
        ),
    )


def _iban(value: Column, key: Column) -> Column:
    """Country and letters kept, the digits of the account permuted, check digits computed anew.

    Small letters count as capitals and stay as they are, so one number has one pseudonym however it is written.
    """

    def moved(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
        digits = permute_symbols(
            _digits(account), "0123456789", key, F.concat(country, F.regexp_replace(account, "[0-9]", "0"))
        )
        new_account = bound(
            digits,
            lambda d: F.array_join(
                F.transform(
                    F.split(account, ""),
                    lambda c, i: F.when(
                        c.rlike("[0-9]"), F.substring(d, F.length(_digits(F.substring(account, F.lit(1), i + 1))), F.lit(1))
                    ).otherwise(c),
                ),
                "",
            ),
        )
        whole = bound(
            new_account,
            lambda a: F.concat(
                country, F.lpad((98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), a
            ),
        )
        valid = (_mod97(F.concat(account, country, F.substring(plain, 3, 2))) == 1) & (F.length(plain) >= 15)
        cased = F.when(value.rlike("[A-Z]"), whole).otherwise(F.lower(whole))
        return F.when(valid, bound(cased, lambda s: _laid_out(value, s)))

    return bound(F.upper(F.regexp_replace(value, " ", "")), moved)


def _ssn(value: Column, key: Column) -> Column:
    area = F.substring(value, 1, 3).cast("int")
    group, serial = F.substring(value, 5, 2).cast("int"), F.substring(value, 8, 4).cast("int")
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    rank = area - 1 - (area > 666).cast("int")
    pair = permute_pair(rank, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, F.lit("ssn"))
    written = bound(
        pair,
        lambda p: F.format_string(
            "%03d-%02d-%04d",
            p["l"] + 1 + (p["l"] >= 665).cast("bigint"),
            F.floor(p["r"] / 9999) + 1,
            p["r"] % 9999 + 1,
        ),
    )
    return F.when(valid, written)


def _ip(value: Column, key: Column) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("int"))
    written = bound(
        octets,
        lambda o: F.when(
            F.array_max(o) < 256,
            bound(
                permute_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, F.lit("ip")),
                lambda p: F.concat_ws(
                    ".",
                    F.floor(p["l"] / 256).cast("string"),
                    (p["l"] % 256).cast("string"),
                    F.floor(p["r"] / 256).cast("string"),
                    (p["r"] % 256).cast("string"),
                ),
            ),
        ),
    )
    return written


def _moved_date(day: Column, key: Column) -> Column:
    """Another date of 1900 to 2099; leap days move among leap days, so both sets split into pairs."""
    leap = (F.month(day) == 2) & (F.dayofmonth(day) == 29)
    year = F.year(day)
    after = F.dayofyear(day) > 59
    is_leap_year = (year % 4 == 0) & (year != 1900)
    ordinal = F.dayofyear(day) - 1 - (is_leap_year & after).cast("int")
    plain = bound(
        permute_pair(year - 1900, ordinal, 200, 365, key, F.lit("date")),
        lambda p: F.date_add(
            F.make_date((p["l"] + 1900).cast("int"), F.lit(1), F.lit(1)),
            (p["r"] + (((p["l"] % 4 == 0) & (p["l"] != 0) & (p["r"] >= 59)).cast("bigint"))).cast("int"),
        ),
    )
    rank = F.floor((year - 1904) / 4)
    leap_day = bound(
        permute_pair(F.floor(rank / 7), rank % 7, 7, 7, key, F.lit("leap")),
        lambda p: F.make_date((1904 + (p["l"] * 7 + p["r"]) * 4).cast("int"), F.lit(2), F.lit(29)),
    )
    return F.when(~year.between(1900, 2099), F.lit(None)).when(leap, leap_day).otherwise(plain)


def _calendar_day(year: Column, month: Column, day: Column) -> Column:
    """The date, or null if the calendar has none."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def _date(value: Column, key: Column) -> Column:
    """The layout stays: order of the parts, separator, and leading zeros unless both were written without."""
    separator = F.regexp_extract(value, "([-/.])", 1)

    def parsed(parts: Column) -> Column:
        iso = _calendar_day(parts[0], parts[1], parts[2])
        month_first = _calendar_day(parts[2], parts[0], parts[1])
        day_first = _calendar_day(parts[2], parts[1], parts[0])
        slash = F.struct(month_first.alias("day"), F.lit(True).alias("month_first"))
        return F.when(separator == "-", F.struct(iso.alias("day"), F.lit(False).alias("month_first"))).when(
            (separator == "/") & month_first.isNotNull(), slash
        ).otherwise(F.struct(day_first.alias("day"), F.lit(False).alias("month_first")))

    def written(found: Column) -> Column:
        padded = value.rlike(r"^0|[/.]0") | ~value.rlike(r"(^|[/.])[0-9][/.]")
        return bound(
            _moved_date(found["day"], key),
            lambda d: F.when(separator == "-", F.date_format(d, "yyyy-MM-dd"))
            .when(found["month_first"] & padded, F.date_format(d, "MM/dd/yyyy"))
            .when(found["month_first"], F.date_format(d, "M/d/yyyy"))
            .when((separator == "/") & padded, F.date_format(d, "dd/MM/yyyy"))
            .when(separator == "/", F.date_format(d, "d/M/yyyy"))
            .when(padded, F.date_format(d, "dd.MM.yyyy"))
            .otherwise(F.date_format(d, "d.M.yyyy")),
        )

    parts = F.transform(F.split(value, "[-/.]"), lambda p: p.cast("int"))
    return bound(bound(parts, parsed), lambda found: F.when(found["day"].isNotNull(), written(found)))


def _phone(value: Column, key: Column) -> Column:
    """Country code and layout kept, the digits of the number permuted."""
    country = F.regexp_extract(value, r"^((?:\+|00)[0-9]{1,3}[ .-]?)(?=[(0-9])", 1)

    def moved(prefix: Column) -> Column:
        rest = F.substring(value, F.length(prefix) + 1, F.length(value))
        digits = _digits(rest)
        code = F.regexp_replace(_digits(prefix), "^00", "")
        tweak = F.concat(F.lit("phone"), code, F.length(digits).cast("string"))
        return F.concat(
            prefix, bound(permute_symbols(digits, "0123456789", key, tweak), lambda s: _laid_out(rest, s))
        )

    return bound(country, moved)


def _secret(value: Column, key: Column) -> Column:
    """Hex digits permuted; a value of one case stays in it, of both cases moves among all digits."""
    tweak = F.lit("secret")
    plain = permute_symbols(F.lower(value), "0123456789abcdef", key, tweak)
    mixed = permute_symbols(value, "0123456789abcdefABCDEF", key, tweak)
    return (
        F.when(~value.rlike("[A-F]"), plain).when(~value.rlike("[a-f]"), F.upper(plain)).otherwise(mixed)
    )


def _prefixed_key(value: Column, key: Column) -> Column:
    """The beginning kept, the rest permuted among capitals and digits, or among all letters and digits."""
    lead = F.substring(value, 1, 4)
    rest = F.substring(value, F.lit(5), F.length(value))
    capitals = permute_symbols(rest, _LETTERS, key, F.concat(F.lit("key"), lead))
    every = permute_symbols(rest, _LETTERS + _LETTERS[10:].lower(), key, F.concat(F.lit("key"), lead))
    return F.concat(lead, F.when(lead.endswith("_"), every).otherwise(capitals))


def _email(value: Column, key: Column) -> Column:
    """The mailbox becomes 16 keyed hex digits; its domain stays."""
    at = F.instr(value, "@")
    return F.concat(
        F.lit("u"), F.substring(_noise(key, F.lit("email"), F.lower(value)), 1, 16), F.substring(value, at, F.length(value))
    )


def pseudonym(value: Column, key: Column) -> Column:
    """Kind and pseudonym of a value of one of the shapes; null if it is not valid."""
    moved = {
        "email": _email(value, key),
        "secret": _secret(value, key),
        "key": _prefixed_key(value, key),
        "iban": _iban(value, key),
        "date": _date(value, key),
        "ssn": _ssn(value, key),
        "ip": _ip(value, key),
        "phone": _phone(value, key),
        "card": _card(value, key),
    }
    whole = {
        "email": F.instr(value, "@") > 0,
        "secret": value.rlike("^[0-9a-fA-F]{32,64}$"),
        "key": value.rlike("^(AKIA|ASIA|gh[oprsu]_)"),
        "iban": value.rlike("^[A-Za-z]{2}"),
        "date": value.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([/.])[0-9]{1,2}\2[0-9]{4})$"),
        "ssn": value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        "ip": value.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$"),
        "phone": value.rlike(r"^[+(]|^00[1-9][0-9]{0,2} |^[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$"),
        "card": F.lit(True),
    }
    out = None
    for kind, test in whole.items():
        made = F.struct(F.lit(kind).alias("kind"), moved[kind].alias("value"))
        out = F.when(test, made) if out is None else out.when(test, made)
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Replace the text by one with pseudonyms, and add ``found``.

    ``found`` lists each replaced value by kind and pseudonym, in order. A null
    text stays null, with an empty list. Texts without a digit are not searched
    beyond that. All other columns stay; columns named ``found``, ``_values``
    and ``_moved`` are replaced. No shuffle.
    """
    secret = F.lit(key)
    values = F.when(F.col(text).rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    moved = F.transform(
        "_values",
        lambda v: bound(
            pseudonym(v, secret), lambda p: F.struct(p["kind"].alias("kind"), v.alias("old"), p["value"].alias("value"))
        ),
    )
    pieces = F.zip_with(
        F.split(F.col(text), PATTERN, -1),
        F.transform("_moved", lambda m: F.coalesce(m["value"], m["old"])),
        lambda gap, new: F.concat(F.coalesce(gap, F.lit("")), F.coalesce(new, F.lit(""))),
    )
    found = F.transform(
        F.filter("_moved", lambda m: m["value"].isNotNull()), lambda m: F.struct(m["kind"], m["value"])
    )
    empty = F.array().cast("array<struct<kind:string,value:string>>")
    return (
        docs.withColumn("_values", values)
        .withColumn("_moved", F.when(F.size("_values") > 0, moved))
        .withColumn(text, F.when(F.col("_moved").isNotNull(), F.array_join(pieces, "")).otherwise(F.col(text)))
        .withColumn("found", F.coalesce(found, empty))
        .drop("_values", "_moved")
    )


def key_of(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, TEST_KEY)


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text with pseudonyms, how many were put in, and their kinds."""
    done = pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), key_of(spark))
    return done.select(
        "doc_id",
        "text",
        F.size("found").cast("long").alias("n_found"),
        F.array_distinct(F.transform("found", lambda f: f["kind"])).alias("kinds"),
    )


def pseudonym_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage of the pipeline: every document stays, its personal data changed."""
    done = pseudonymise(docs, key_of(spark))
    return done.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)
