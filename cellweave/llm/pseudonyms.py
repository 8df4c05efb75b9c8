"""Format-preserving pseudonyms for personal data, in SQL functions only.

Values are found by pattern, validated (check digits, calendar, ranges), and
permuted by a keyed Feistel network over their own alphabet: digits stay digits,
letters stay letters of their case, separators stay where they are.  A value's
pseudonym depends on the value and the key alone, so equal values stay equal
across documents, also when they are written with other separators.  Where the
network leaves the set of valid values it is applied again until it returns
(cycle walking), which keeps it a permutation of that set.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import bound

#: The setting that holds the key; a session without it gets a random one of its own.
KEY_SETTING = "spark.cellweave.pseudonymKey"
ROUNDS = 10
#: The patterns of each kind, in order of precedence.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"\bAKIA[0-9A-Z]{16}\b|\b(?=[0-9a-fA-F]*[a-fA-F])(?=[0-9a-fA-F]*[0-9])[0-9a-fA-F]{16,64}\b",
    "phone": r"(?<![\w+])\+?1 ?\(\d{3}\) ?\d{3}-\d{4}\b|(?<![\w-])\(\d{3}\) ?\d{3}-\d{4}\b|(?<![\w-])\d{3}[-. ]\d{3}[-. ]\d{4}\b(?!-)",
    "date": r"(?<![\w.-])(?:19|20)\d\d-[01]\d-[0-3]\d\b(?!-)|(?<![\w./-])[0-3]\d[./][01]\d[./](?:19|20)\d\d\b",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}\b(?!-)",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}\b(?!\.\d)",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}\b",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_DAYS = 73_049  # 1900-01-01 to 2099-12-31


def _shifted(key: str, half: Column, other: Column, kind: str, turn: Column, letters: int) -> Column:
    """``half`` with every digit and letter moved within its class by a keyed hash of ``other``."""
    def one(own: Column, digest: Column, at: Column) -> Column:
        c = F.substring(own, at, F.lit(1))
        # a fresh digest every 32 symbols
        row = F.when(at > 32, F.sha2(F.concat_ws("|", digest, F.floor((at - 1) / 32).cast("string")), 256)).otherwise(digest)
        step = F.conv(F.substring(row, (at - 1) % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")
        moved = lambda first, size: F.char(((F.ascii(c) - first + step) % size + first).cast("long"))
        return F.when(c.between("0", "9"), moved(48, 10)).when(c.between("a", "z"), moved(97, letters)).when(c.between("A", "Z"), moved(65, letters)).otherwise(c)

    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), other), 256)
    moved = bound(
        F.struct(half.alias("own"), digest.alias("digest")),
        lambda x: F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x["own"]), F.lit(1))), lambda at: one(x["own"], x["digest"], at)), ""),
    )
    return F.when(F.length(half) == 0, half).otherwise(moved)


def feistel(key: str, value: Column, kind: str, letters: int = 26) -> Column:
    """A keyed permutation of the strings with the same class of symbol at every place."""
    def halves(v: Column) -> Column:
        cut = F.floor(F.length(v) / 2).cast("int")
        return F.struct(F.substring(v, F.lit(1), cut).alias("a"), F.substring(v, cut + 1, F.length(v)).alias("b"))

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, _shifted(key, s["a"], s["b"], kind, i, letters)).otherwise(s["a"]).alias("a"),
            F.when(even, s["b"]).otherwise(_shifted(key, s["b"], s["a"], kind, i, letters)).alias("b"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), bound(value, halves), turn, lambda s: F.concat(s["a"], s["b"]))


def walked(key: str, value: Column, kind: str, valid) -> Column:
    """``feistel`` repeated until the value is valid again; a value has left after 64 steps less than once in 10^15."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), feistel(key, value, kind), lambda v, _: F.when(valid(v), v).otherwise(feistel(key, v, kind)))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum when one more digit follows on the right."""

    def total(own: Column) -> Column:
        def add(sum_: Column, at: Column) -> Column:
            d = F.substring(own, at, F.lit(1)).cast("int")
            twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
            return sum_ + F.when((F.length(own) - at) % 2 == 0, twice).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), F.length(own)), F.lit(0), add)

    return bound(digits, total)


def _refilled(written: Column, digits: Column) -> Column:
    """``written`` with its digits replaced in order."""

    def fill(x: Column) -> Column:
        def add(s: Column, at: Column) -> Column:
            c = F.substring(x["written"], at, F.lit(1))
            number = c.between("0", "9")
            return F.struct(
                F.concat(s["out"], F.when(number, F.substring(x["digits"], s["at"], F.lit(1))).otherwise(c)).alias("out"),
                (s["at"] + number.cast("int")).alias("at"),
            )

        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
        return F.aggregate(F.sequence(F.lit(1), F.length(x["written"])), start, add, lambda s: s["out"])

    return bound(F.struct(written.alias("written"), digits.alias("digits")), fill)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _card(key: str, m: Column) -> Column:
    def changed(digits: Column) -> Column:
        body = F.substring(digits, F.lit(1), F.length(digits) - 1)
        valid = (luhn_sum(body) + F.substring(digits, F.length(digits), F.lit(1)).cast("int")) % 10 == 0
        checked = bound(feistel(key, body, "card"), lambda new: F.concat(new, ((10 - luhn_sum(new) % 10) % 10).cast("string")))
        return F.when(valid, _refilled(m, checked)).otherwise(m)

    return bound(_digits(m), changed)


def _phone(key: str, m: Column) -> Column:
    digits = _digits(m)
    head = F.substring(digits, F.lit(1), F.length(digits) - 10)
    return _refilled(m, F.concat(head, feistel(key, F.substring(digits, F.length(digits) - 9, F.lit(10)), "phone")))


def _ssn(key: str, m: Column) -> Column:
    valid = lambda d: ~F.substring(d, 1, 3).isin("000", "666") & (F.substring(d, 1, 1) != "9") & (F.substring(d, 4, 2) != "00") & (F.substring(d, 6, 4) != "0000")
    digits = _digits(m)
    return F.when(valid(digits), _refilled(m, walked(key, digits, "ssn", valid))).otherwise(m)


def _ip(key: str, m: Column) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("long"))
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda n, o: n * 256 + o)
    new = walked(key, F.lpad(number.cast("string"), 10, "0"), "ip", lambda d: d.cast("long") < 1 << 32).cast("long")
    written = bound(new, lambda n: F.concat_ws(".", *[(F.shiftright(n, s) % 256).cast("string") for s in (24, 16, 8, 0)]))
    return F.when(F.forall(octets, lambda o: o <= 255), written).otherwise(m)


def _date(key: str, m: Column) -> Column:
    iso = F.substring(m, 5, 1) == "-"
    dotted = F.substring(m, 3, 1) == "."
    written = F.when(iso, m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    days = F.datediff(F.try_to_timestamp(written, F.lit("yyyy-MM-dd")).cast("date"), F.lit("1900-01-01"))

    def spelled(date: Column) -> Column:
        return F.when(iso, F.date_format(date, "yyyy-MM-dd")).when(dotted, F.date_format(date, "dd.MM.yyyy")).otherwise(F.date_format(date, "dd/MM/yyyy"))

    def changed(day: Column) -> Column:
        new = walked(key, F.lpad(day.cast("string"), 5, "0"), "date", lambda d: d.cast("int") < _DAYS).cast("int")
        valid = day.isNotNull() & (day >= 0) & (day < _DAYS)
        return F.when(valid, bound(F.date_add(F.lit("1900-01-01").cast("date"), new), spelled)).otherwise(m)

    return bound(days, changed)


def _email(key: str, m: Column) -> Column:
    name = F.substring_index(m, "@", 1)
    return F.concat(feistel(key, F.lower(name), "email"), F.substring(m, F.length(name) + 1, F.length(m)))


def _secret(key: str, m: Column) -> Column:
    return F.when(m.startswith("AKIA"), F.concat(F.lit("AKIA"), feistel(key, F.substring(m, F.lit(5), F.length(m)), "key"))).otherwise(feistel(key, m, "hex", 6))


KINDS = {"email": _email, "secret": _secret, "phone": _phone, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card}


def pseudonym(key: str, found: Column) -> Column:
    """The pseudonym of one found value, by the first kind whose whole pattern it is."""
    out = found
    for kind in reversed(PATTERNS):
        bare = PATTERNS[kind]
        out = F.when(found.rlike(f"^(?:{bare})$"), KINDS[kind](key, found)).otherwise(out)
    return out


def kind_of(found: Column) -> Column:
    """The first kind whose whole pattern a found value is."""
    out = F.lit(None).cast("string")
    for kind in reversed(PATTERNS):
        out = F.when(found.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def session_key(spark: SparkSession) -> str:
    """The key of this session: from its settings, else drawn once, so that it stands in no source and equal values stay linked."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` under ``key``, and what was found in ``pii``.

    ``pii`` holds (kind, value, pseudonym) in the order of the text, for the holder
    of the key; ``value`` is what was there, so do not hand the column on.  A found value
    that fails validation keeps its text.  Null texts stay null with an empty list.
    All other columns, keys and repeated rows stay as they are; a column of the
    name ``pii`` is replaced.
    """
    text = F.col(text_col).cast("string")
    found = F.when(text.rlike(ANY), F.regexp_extract_all(text, F.lit(f"({ANY})"), 1)).otherwise(F.array().cast("array<string>"))
    marked = docs.withColumn("pii", F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda m: F.struct(kind_of(m).alias("kind"), m.alias("value"), pseudonym(key, m).alias("pseudonym"))))
    parts = F.split(text, ANY, -1)
    joined = F.array_join(F.transform(parts, lambda part, i: F.concat(F.when(i > 0, F.get(F.col("pii"), i - 1)["pseudonym"]).otherwise(F.lit("")), part)), "")
    return marked.withColumn(text_col, F.when(F.size("pii") > 0, joined).otherwise(text))
