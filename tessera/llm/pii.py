"""Personal data replaced by format-preserving Feistel pseudonyms, in DataFrame functions only.

Each value found is taken apart into small numbers, each below a size that its format sets (a digit 10, an octet 256, a letter 26,
a date's day two numbers), permuted by a keyed Feistel network over these numbers, and put together in the same format.
The permutation depends on the key, the kind and the sizes alone: equal values get equal pseudonyms in every document,
different ones of a format different ones, and whoever has the key can go back. Card and account numbers keep valid check digits and dates
stay dates.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fresh, prepare

ROUNDS = 8
#: A secret's name up to its value, and the value: from 6 characters on, up to its last letter or digit. What is a key of another
#: layout is left to that one, so that it has the same pseudonym with and without a name.
_NAMED = r"""(?i:password|passwd|secret(?:[_-]?access)?(?:[_-]?key)?|token|api[_-]?key)\d{0,2}["']?[ \t]{0,4}[=:]{1,3}>?[ \t]{0,4}["']?"""
_SECRET = r"(?!(?:[0-9A-Fa-f]{40}|AKIA[0-9A-Z]{16})(?![0-9A-Za-z]))(?=[A-Za-z0-9+/_.~@!#$%^*-]{6})(?:[+/_.~@!#$%^*-]*+[A-Za-z0-9]++)++"
#: Kinds with their patterns; of kinds that fit at one place the first is taken.
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}0-9._%+-])[\p{L}\p{M}0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "secret": _NAMED + _SECRET + r"|(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "hex": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{40}(?![0-9A-Za-z])",
    "phone": r"(?:\+\d{1,3}[ .-]?)?(?<!\d)\(\d{3}\)[ -]?\d{3}-\d{4}(?!\d)|(?<![\d.+-])(?:\+\d{1,3}[ .-]?)?(?:\d{3}-\d{3}-\d{4}|[2-9]\d{2}(?:\.[2-9]\d{2}\.| [2-9]\d{2} )\d{4})(?![\d-])"
    r"|(?<![\d+])\+(?:\d{8,15}|(?=(?:[ .-]?\d){8,15}(?!\d))\d{1,3}(?:[ .-]\d{2,9}){1,4})(?!\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[A-Fa-f:]{0,39}[0-9])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "date": r"(?<![A-Za-z])(?:January|February|March|April|May|June|July|August|September|October|November|December) [1-9]\d?, \d{4}(?!\d)|(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])|(?<![\d./])\d{2}/\d{2}/\d{4}(?![\d/])|(?<![\d./])\d{2}\.\d{2}\.\d{4}(?!\.?\d)",
    "number": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}(?: \d{4}){2} \d{1,4}|\d{4}(?:-\d{4}){2}-\d{1,4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
}
KINDS = [*PATTERNS, "none"]
#: The patterns joined, so that at one place the first that fits is taken, but asked only for kinds that can begin with the character there.
_ANY = "|".join(
    [
        PATTERNS["email"],
        "(?=[0-9+(])(?:" + "|".join(PATTERNS[k] for k in ("hex", "phone", "ipv6", "ip", "date", "number", "card")) + ")",
        "(?=[AaPpSsTt])(?:" + PATTERNS["secret"] + ")",
        "(?=[A-Za-z])(?<![0-9A-Za-z])(?:" + "|".join(PATTERNS[k] for k in ("hex", "iban", "ipv6")) + ")",
        "(?=[A-Z])(?:" + PATTERNS["date"] + ")",
    ]
)
#: What every match of a pattern holds: a digit, or else an address's sign or a secret's name.
_HOLDS = r"[0-9@]|(?=[AaPpSsTt])(?i:passw|secret|token|api[_-]?key|akia)"
#: Days from this one on: 288 * 256 of them, to November 2101. Those before it are permuted among themselves, back to April 1496.
_EPOCH, _DAYS = "1900-01-01", (288, 256)
_FORMER, _FORMER_DAYS = "1496-04-12", (288, 512)
#: Month-first dates are told by a day after the 12th; there are so many from _EPOCH on, to May 2101.
_LATE_DAYS = (174, 256)


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def feistel(values: Column, sizes: Column, tweak: Column, key: Column | str, back: bool = False) -> Column:
    """A permutation of arrays of integers with 0 <= values[i] < sizes[i], or its inverse. In turn, each half is shifted
    by a keyed hash of the other half."""

    def shifted(acc: Column, r: Column) -> Column:
        half = (F.size(acc) / 2).cast("int")
        left = (r % 2) == 0
        other = F.filter(acc, lambda x, i: (i < half) != left)
        source = F.concat_ws("|", key if isinstance(key, Column) else F.lit(key), tweak, r.cast("string"), F.concat_ws(",", F.transform(other, lambda x: x.cast("string"))))
        move = lambda s, i, x: F.pmod(x + (-1 if back else 1) * F.pmod(F.xxhash64(s, i), F.get(sizes, i)), F.get(sizes, i)).cast("int")
        return _let(
            F.sha2(source.cast("binary"), 256),
            lambda s: F.transform(acc, lambda x, i: F.when((i < half) == left, move(s, i, x)).otherwise(x)),
        )

    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, values, shifted)


def _characters(s: Column, tweak: str, key: Column | str, back: bool, hexadecimal: bool = False, letters: int = 26) -> Column:
    """s with each digit, lower- and upper-case letter (of the first `letters`) replaced by one of its class; all else stays in place.
    Hexadecimal digits are one class, shown in the case of s."""
    code = lambda c: F.ascii(c)
    digit = lambda c: (code(c) >= 48) & (code(c) <= 57)
    upper = lambda c: (code(c) >= 65) & (code(c) <= 90)
    lower = lambda c: (code(c) >= 97) & (code(c) <= 122)
    base = lambda c: F.when(digit(c), 48).when(upper(c), 65).when(lower(c), 97)
    if hexadecimal:
        values = lambda cs: F.transform(cs, lambda c: F.when(digit(c), code(c) - 48).when(upper(c), code(c) - 55).otherwise(code(c) - 87))
        sizes = lambda cs: F.transform(cs, lambda c: F.lit(16))
        show = lambda cs, vs: F.transform(vs, lambda v: F.when(s.rlike("[A-F]"), F.hex(v)).otherwise(F.lower(F.hex(v))))
    else:
        values = lambda cs: F.transform(cs, lambda c: F.coalesce(code(c) - base(c), F.lit(0)))
        sizes = lambda cs: F.transform(cs, lambda c: F.when(digit(c), 10).when(upper(c) | lower(c), letters).otherwise(1))
        show = lambda cs, vs: F.zip_with(cs, vs, lambda c, v: F.when(base(c).isNull(), c).otherwise(F.chr((base(c) + v).cast("long"))))
    return _let(
        F.split(s, ""),
        lambda cs: F.array_join(show(cs, _let(sizes(cs), lambda n: feistel(values(cs), n, F.concat_ws(":", F.lit(tweak), F.array_join(n.cast("array<string>"), ",")), key, back))), ""),
    )


def _digits(s: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(s, "[^0-9]", ""), ""), lambda c: c.cast("int"))


def _luhn(body: Column) -> Column:
    """The check digit that follows an array of digits."""
    n = F.size(body)
    doubled = F.transform(body, lambda d, i: F.when((n - i) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda a, d: a + d), F.lit(10)).cast("int")


def _into(s: Column, digits: Column) -> Column:
    """s with its digits replaced in order."""
    places = F.transform(F.split(s, ""), lambda c: F.struct(c.alias("c"), c.rlike("[0-9]").cast("int").alias("d")))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))
    return F.aggregate(
        places, start,
        lambda a, p: F.struct(F.concat(a["out"], F.when(p["d"] == 1, F.get(digits, a["k"]).cast("string")).otherwise(p["c"])).alias("out"), (a["k"] + p["d"]).alias("k")),
    )["out"]


def _card(s: Column, key: Column | str, back: bool) -> Column:
    """All digits but the last are permuted, the last is set to their check digit; null unless the check digit is right."""

    def of(d: Column) -> Column:
        body = F.slice(d, 1, F.size(d) - 1)
        tens = F.transform(body, lambda x: F.lit(10))
        new = feistel(body, tens, F.concat(F.lit("card:"), F.size(d).cast("string")), key, back)
        return F.when(F.element_at(d, -1) == _luhn(body), _let(new, lambda b: _into(s, F.concat(b, F.array(_luhn(b))))))

    return _let(_digits(s), of)


def _ip(s: Column, key: Column | str, back: bool) -> Column:
    parts = lambda x: F.transform(F.split(x, "\\."), lambda p: p.cast("int"))
    valid = s.rlike(r"^(?:0|[1-9]\d{0,2})(?:\.(?:0|[1-9]\d{0,2})){3}$")

    def of(v: Column) -> Column:
        new = feistel(v, F.transform(v, lambda p: F.lit(256)), F.lit("ip"), key, back)
        return F.when(F.forall(v, lambda p: p < 256), F.array_join(new.cast("array<string>"), "."))

    return F.when(valid, _let(parts(s), of))


def _remainder(s: Column) -> Column:
    """What is left of an account number divided by 97, letters counting from 10 and the first four characters last."""
    of = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    moved = F.concat(F.substring(s, 5, 40), F.substring(s, 1, 4))
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.pmod(a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + of(c), F.lit(97)))


def _iban(s: Column, key: Column | str, back: bool) -> Column:
    """The account is permuted in place, the country stays and the check digits are set; null unless they are right."""

    def of(plain: Column) -> Column:
        account = _characters(F.substring(plain, 5, 40), "iban", key, back)
        country = F.substring(plain, 1, 2)
        check = lambda a: F.lpad((98 - _remainder(F.concat(country, F.lit("00"), a))).cast("string"), 2, "0")
        return F.when(_remainder(plain) == 1, _let(account, lambda a: F.concat(country, check(a), a)))

    def spaced(new: Column) -> Column:
        places = F.split(s, "")
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
        step = lambda a, c: F.struct(F.concat(a["out"], F.when(c == " ", c).otherwise(F.substring(new, a["k"], F.lit(1)))).alias("out"), (a["k"] + F.when(c == " ", 0).otherwise(1)).alias("k"))
        return F.when(new.isNotNull(), F.aggregate(places, start, step)["out"])

    return _let(_let(F.replace(s, F.lit(" "), F.lit("")), of), spaced)


def _number(s: Column, key: Column | str, back: bool) -> Column:
    """Area, group and serial are permuted among those that exist: areas 1 to 899 but 666, and those from 900 on among themselves, groups and
    serials from 1; null for a number that doesn't exist."""

    def of(p: Column) -> Column:
        late = p[0] >= 900
        rank = F.when(late, p[0] - 900).otherwise(p[0] - F.when(p[0] > 666, 2).otherwise(1))
        sizes = F.array(F.when(late, 100).otherwise(898), F.lit(99), F.lit(9999))
        new = feistel(F.array(rank, p[1] - 1, p[2] - 1), sizes, F.when(late, "number9").otherwise("number"), key, back)
        area = lambda n: F.when(late, n + 900).otherwise(n + F.when(n >= 665, 2).otherwise(1))
        shown = _let(new, lambda n: F.concat_ws("-", *[F.lpad(x.cast("string"), w, "0") for x, w in ((area(n[0]), 3), (n[1] + 1, 2), (n[2] + 1, 4))]))
        return F.when((p[0] > 0) & (p[0] != 666) & (p[1] > 0) & (p[2] > 0), shown)

    return _let(F.transform(F.split(s, "-"), lambda x: x.cast("int")), of)


def _date(s: Column, key: Column | str, back: bool) -> Column:
    """A slashed date is read day first, or month first where only that can be; it stays one of its reading."""

    def permuted(n: Column, sizes: tuple[int, int], tweak: str) -> Column:
        v = F.array((n / sizes[1]).cast("int"), (n % sizes[1]).cast("int"))
        return F.when((n >= 0) & (n < sizes[0] * sizes[1]), _let(feistel(v, F.array(*map(F.lit, sizes)), F.lit(tweak), key, back), lambda d: d[0] * sizes[1] + d[1]))

    since = lambda day, first: F.datediff(day, F.lit(first).cast("date"))

    def other(day: Column) -> Column:
        new = F.date_add(F.lit(_EPOCH).cast("date"), permuted(since(day, _EPOCH), _DAYS, "date"))
        former = F.date_add(F.lit(_FORMER).cast("date"), permuted(since(day, _FORMER), _FORMER_DAYS, "former"))
        return F.when(day < F.lit(_EPOCH).cast("date"), former).otherwise(new)

    # month m from _EPOCH on holds the numbers from before(m), less than before(m + 1)
    month = lambda m: F.add_months(F.lit(_EPOCH).cast("date"), m)
    before = lambda m: since(month(m), _EPOCH) - 12 * m

    def late(day: Column) -> Column:
        n = since(day, _EPOCH) - 12 * (12 * (F.year(day) - int(_EPOCH[:4])) + F.month(day))

        def date_of(k: Column) -> Column:
            near = F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: (k / 18.436875).cast("int") + d)
            m = F.array_max(F.filter(near, lambda x: before(x) <= k))
            return _let(m, lambda x: F.date_add(month(x), 12 + k - before(x)))

        return _let(permuted(n, _LATE_DAYS, "late"), date_of)

    month_first = r"^\d{2}/(?:1[3-9]|[23])"
    forms = ((r"^\d{4}-", "yyyy-MM-dd"), (month_first, "MM/dd/yyyy"), (r"^\d{2}/", "dd/MM/yyyy"), (r"^\d{2}\.", "dd.MM.yyyy"), ("^[A-Z]", "MMMM d, yyyy"))

    def by_form(body) -> Column:
        out = F.lit(None)
        for shape, form in reversed(forms):
            out = F.when(s.rlike(shape), body(form)).otherwise(out)
        return out

    day = by_form(lambda form: F.try_to_timestamp(s, F.lit(form)).cast("date"))
    new = _let(day, lambda d: F.when(s.rlike(month_first), late(d)).otherwise(other(d)))
    return _let(new, lambda d: by_form(lambda form: F.date_format(d, form)))


def _with(f, second):
    """f with its second argument set, as a function of one argument: Spark counts a lambda's parameters."""
    return lambda x: f(x, second)


def _phone(s: Column, key: Column | str, back: bool) -> Column:
    """A country code stays (of digits in one run the first two, or a 1 or 7); area and exchange codes that begin with 2 to 9 go on
    to do so. A number has the same pseudonym in each layout."""
    code = F.regexp_extract(s, r"^(?:\+(?:[17](?=\d{7,}$)|\d{2}(?=\d{6,}$)|\d{1,3}(?=[ .(-]|\d{3}-\d{3}-|\d{3}[. ]\d{3}[. ]\d{4}$))[ .-]?)?", 0)
    rest = F.substring(s, F.char_length(code) + 1, F.char_length(s))

    def of(d: Column) -> Column:
        low = lambda x, i: F.when(((i == 0) | (i == 3)) & (x >= 2), 2).otherwise(0)
        size = lambda x, i: F.when((i == 0) | (i == 3), F.when(x >= 2, 8).otherwise(2)).otherwise(10)
        sizes, base = F.transform(d, size), F.transform(d, low)
        tweak = F.concat(F.lit("phone:"), F.array_join(sizes.cast("array<string>"), ","))
        new = F.zip_with(feistel(F.transform(d, lambda x, i: x - low(x, i)), sizes, tweak, key, back), base, lambda x, b: x + b)
        return F.concat(code, _let(new, lambda n: _into(rest, n)))

    return _let(_digits(rest), of)


def kind_of(value: Column) -> Column:
    """The kind of a match of the joined pattern, by the first pattern that fits it as a whole."""
    out = F.lit("none")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(value.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def pseudonym(value: Column, kind: Column, key: Column | str, back: bool = False) -> Column:
    """The pseudonym of a value of a kind, or the value itself where it isn't valid (a wrong check digit, no such date or number)."""
    name, domain = F.substring_index(value, "@", 1), F.concat(F.lit("@"), F.substring_index(value, "@", -1))
    head = F.regexp_extract(value, f"^(?:AKIA|{_NAMED})", 0)
    tail = F.substring(value, F.char_length(head) + 1, F.char_length(value))
    new = (
        F.when(kind == "email", F.concat(_characters(name, "email", key, back), domain))
        .when(kind == "secret", F.concat(head, _characters(tail, "secret", key, back)))
        .when((kind == "hex") & value.rlike("[a-f]") & value.rlike("[A-F]"), _characters(value, "hex", key, back, letters=6))
        .when(kind == "hex", _characters(value, "hex", key, back, True))
        .when(kind == "phone", _phone(value, key, back))
        .when(kind == "ip", _ip(value, key, back))
        .when(kind == "date", _date(value, key, back))
        .when(kind == "number", _number(value, key, back))
        .when(kind == "iban", _iban(value, key, back))
        .when(kind == "ipv6", _characters(value, "ipv6", key, back, letters=6))
        .when(kind == "card", _card(value, key, back))
    )
    return F.coalesce(new, value)


def session_key(spark: SparkSession) -> str:
    """The setting tessera.pii.secret_key, a name that Spark's redaction hides in logs; where it is unset, a random key that lives as
    long as the application, so that its pseudonyms link within it only."""
    given = spark.conf.get("tessera.pii.secret_key", None)
    return given or _KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


_KEYS: dict[str, str] = {}


def pseudonymise(docs: DataFrame, key: str, text: str = "text", back: bool = False) -> DataFrame:
    """docs with pseudonyms in the text and a column pii, a map from kind to the number of values replaced (kinds that occur; empty
    for null texts, which stay null). back undoes it with the same key; texts without personal data are left as they are.

    Values are found in the whole text. Numbers that fail their check and dates that don't exist stay. Rows are independent:
    repeated rows give equal results, and an empty table gives no rows. A column named pii is replaced.
    """
    prepare(docs.sparkSession)
    columns = [c for c in docs.columns if c != "pii"]
    # the key comes as a table's one value, so that no plan and no event log shows it
    secret, matched, replaced = (fresh(docs, n) for n in ("secret", "found", "new"))
    docs = docs.withColumn(secret, docs.sparkSession.createDataFrame([(key,)], "k string").scalar())
    key = F.col(secret)
    found = F.when(F.col(text).rlike(_HOLDS), F.regexp_extract_all(F.col(text), F.lit(_ANY), F.lit(0)))
    has = docs.select(*columns, secret, F.coalesce(found, F.array().cast("array<string>")).alias(matched))
    matches = F.transform(matched, lambda v: F.struct(v.alias("v"), kind_of(v).alias("k")))
    # one row's matches are few; a text is only split where there are any
    has = has.withColumn(replaced, F.when(F.size(matched) > 0, F.transform(matches, lambda m: F.struct(m["k"].alias("k"), m["v"].alias("v"), pseudonym(m["v"], m["k"], key, back).alias("p")))))
    gaps = F.split(F.col(text), _ANY)
    joined = F.array_join(F.zip_with(gaps, F.col(replaced), lambda g, m: F.concat(g, F.coalesce(m["p"], F.lit("")))), "")
    counts = F.map_from_arrays(F.array(*[F.lit(k) for k in PATTERNS]), F.array(*[F.size(F.filter(replaced, _with(lambda m, k: (m["k"] == k) & (m["p"] != m["v"]), k))) for k in PATTERNS]))
    counts = F.when(F.col(replaced).isNotNull(), F.map_filter(counts, lambda k, n: n > 0)).otherwise(F.create_map().cast("map<string,int>"))
    new = F.when(F.col(replaced).isNull(), F.col(text)).otherwise(joined)
    return has.select(*[new.alias(c) if c == text else F.col(c) for c in columns], counts.alias("pii"))
