"""Format-preserving pseudonyms for personal data, by a keyed Feistel network.

Validated numbers and dates are permuted inside their own format: a card
number becomes another number that passes the same check digit, a phone number
another dialable one, a date another date, with every separator left where it
was. The permutation depends only on the key and the value (not on the
document, its spelling or its neighbours), so equal values stay linked across
documents while the original cannot be read back without the key.

A value is a pair (a, b) of residues with moduli (m, n), or a pair of
character lists; each Feistel round adds a keyed hash of one half to the other
half (modulo its size, or character by character within the character's
class), which is a bijection for any sizes. Only DataFrame functions are used.
"""
from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verity.llm.common import text_of

ROUNDS = 8
DEFAULT_KEY = "replace-this-key"

# The formats looked for, in order of preference at one place.
FORMATS = {
    "secret": r"\bAKIA[0-9A-Z]{16}\b|(?<=\bpassword=)[^\s\"']{6,}|(?<=\btoken = \")[0-9A-Za-z_-]{16,}(?=\")",
    "email": r"\b[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}\b",
    "phone": r"(?:\+1[ .-]?)?(?<![\d(])\([1-9]\d\d\) ?[1-9]\d\d[ .-]\d{4}(?!\d)"
             r"|(?<![\d.-])(?:\+1[ .-]?)?[1-9]\d\d([ .-])[1-9]\d\d\1\d{4}(?![\d-])",
    # A run of digit groups, in which the cards (and what stands beside them)
    # are looked for; the day or month of a slash date after it is not part.
    "run": r"(?<![\d.-])\d[\d -]{11,}\d(?!\d|\.\d)(?<![ -]\d\d(?=/\d\d/))",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "date": r"(?<![\d/.-])(?:(?:19|20)\d\d-\d\d-\d\d|\d\d/\d\d/(?:19|20)\d\d|\d\d\.\d\d\.(?:19|20)\d\d)(?![\d/-]|\.\d)",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)",
}
# Marks of a card inside a run, which holds digits, blanks and hyphens only.
_OPEN, _CLOSE = "\x01", "\x02"
# What a run can hold. The digits beside a card do not belong to the others.
IN_RUN = "|".join([_OPEN + "[^" + _CLOSE + "]+" + _CLOSE, FORMATS["phone"], FORMATS["ssn"], FORMATS["date"]])
# Groupings in which card numbers are written, and those that begin as the
# networks' numbers do; a card may also be cut into any groups of three digits or more,
# or be alone in its run.
CUSTOMARY = r"^(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{3})?|\d{4}([ -])\d{6}\2\d{4,5})$"
NETWORK = CUSTOMARY.replace("^", "^(?=4|5[1-5]|2[2-7]|3[0-8]|6(?:011|2|4|5))", 1)
CARD = r"^\d(?:[ -]?\d){12,18}$"
CARD_GROUPS = r"^\d{3,}(?:[ -]\d{3,}){0,5}$"
# Days of 1900-01-01 .. 2099-12-31: 73,049 = 17 x 4,297.
DATE_MODULI = (17, 4297)


def _any_format() -> str:
    # One group per format would shift the phone pattern's back-reference, so
    # it is named.
    parts = dict(FORMATS, phone=FORMATS["phone"].replace("([ .-])", "(?<sep>[ .-])").replace(r"\1", r"\k<sep>"))
    return "|".join(f"(?:{p})" for p in parts.values())


ANY = _any_format()


def _hash(key: str, tag: str, *parts: Column) -> Column:
    """A keyed hash as a non-negative long below 2^60."""
    h = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def permute_pair(a: Column, b: Column, m: int, n: int, key: str, tag: str) -> Column:
    """A keyed permutation of Z_m x Z_n as ``struct(a, b)``."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(acc: Column, r: Column) -> Column:
        even = F.struct(F.pmod(acc["a"] + F.pmod(_hash(key, tag, r, acc["b"]), F.lit(m)), F.lit(m)).alias("a"),
                        acc["b"].alias("b"))
        odd = F.struct(acc["a"].alias("a"),
                       F.pmod(acc["b"] + F.pmod(_hash(key, tag, r, acc["a"]), F.lit(n)), F.lit(n)).alias("b"))
        return F.when(r % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _add(text: Column, other: Column, r: Column, key: str, tag: str) -> Column:
    """Every character of ``text`` moved inside its class (digit, lower,
    upper) by a keyed hash of ``other``; characters of no class stay."""

    def move(c: Column, i: Column) -> Column:
        out = c
        for letters in _CLASSES:
            at = F.position(c, F.lit(letters))
            out = F.when((at > 0) & (c != ""), F.substr(F.lit(letters), (F.pmod(
                at - 1 + _hash(key, tag, r, i, other), F.lit(len(letters))) + 1).cast("int"), F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), move), "")


def permute_text(value: Column, key: str, tag: str) -> Column:
    """A keyed permutation of the strings with the same character classes at
    the same places: a Feistel network over the two halves."""
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), half).alias("a"), F.substr(value, half + 1).alias("b"))

    def step(acc: Column, r: Column) -> Column:
        return F.when(r % 2 == 0, F.struct(_add(acc["a"], acc["b"], r, key, tag).alias("a"), acc["b"].alias("b"))) \
            .otherwise(F.struct(acc["a"].alias("a"), _add(acc["b"], acc["a"], r, key, tag).alias("b")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step,
                       lambda acc: F.concat(acc["a"], acc["b"]))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def put_digits(value: Column, digits: Column, skip: int | Column = 0) -> Column:
    """``value`` with its digits, after the first ``skip`` ones, replaced in
    order by ``digits``; separators stay."""
    chars = F.split(value, "")
    # The new digits travel in the state: an expression inside the lambda
    # would be evaluated once per character.
    zero = F.struct(F.lit("").alias("s"), F.lit(0).alias("n"), digits.alias("d"), F.lit(skip).cast("int").alias("k")
                    if isinstance(skip, int) else skip.cast("int").alias("k"))

    def put(acc: Column, c: Column) -> Column:
        digit = c.rlike(r"^\d$")
        taken = F.when(acc["n"] < acc["k"], c).otherwise(F.substr(acc["d"], acc["n"] - acc["k"] + 1, F.lit(1)))
        return F.struct(F.concat(acc["s"], F.when(digit, taken).otherwise(c)).alias("s"),
                        (acc["n"] + F.when(digit, 1).otherwise(0)).alias("n"), acc["d"].alias("d"), acc["k"].alias("k"))

    return F.aggregate(chars, zero, put, lambda acc: acc["s"])


def _pad(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def luhn_sum(digits: Column, doubled_first: Column) -> Column:
    """Sum of the digits, every second one doubled (less 9 above 9), the first
    one doubled when ``doubled_first``."""
    def term(c: Column, i: Column) -> Column:
        d = F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0))
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((i % 2 == 0) == doubled_first, twice).otherwise(d)
    return F.aggregate(F.transform(F.split(digits, ""), term), F.lit(0), lambda s, x: s + x)


def _valid_card(value: Column) -> Column:
    d = digits_of(value)
    return luhn_sum(d, F.length(d) % 2 == 0) % 10 == 0


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value evaluated once."""
    return F.transform(F.array(value), lambda v: use(v))[0]


def mark_cards(run: Column) -> Column:
    """``run`` with each card number put between marks: ranges of whole groups
    that pass the check, first those in a customary grouping that begin as the
    networks' numbers do, then other customary ones, then any."""
    def whole(c: Column) -> Column:
        return c.rlike(CARD) & (c.rlike(CARD_GROUPS) | (c == run))

    out = run
    for fits, most in ((lambda c: c.rlike(NETWORK), 5), (lambda c: c.rlike(CUSTOMARY), 5), (whole, 19)):
        out = _bound(out, partial(_mark, fits=fits, most=most))
    return F.when(F.length(digits_of(run)) < 13, run).otherwise(out)


def _mark(run: Column, fits, most: int) -> Column:
    """From the left, the longest range of up to ``most`` groups that fits."""
    def join(groups: Column, start: Column, n: Column) -> Column:
        return F.array_join(F.slice(groups, start, n), "")

    def lengths(groups: Column, i: Column) -> Column:
        """The most groups from i on that are a card, or 0."""
        text = lambda k: F.regexp_replace(join(groups, i, k), "[ -]+$", "")
        longest = F.least(F.when(i == 1, most).otherwise(min(most, 6)), F.size(groups) - i + 1)
        found = F.transform(F.sequence(longest, F.lit(1), F.lit(-1)),
                            lambda k: F.struct(k.alias("k"), text(k).alias("c")))
        # A condition that holds for few guards the check.
        found = F.filter(found, lambda x: F.when(fits(x["c"]), _valid_card(x["c"])).otherwise(F.lit(False)))
        return F.coalesce(F.try_element_at(found, F.lit(1))["k"], F.lit(0))

    def marked(groups: Column) -> Column:
        zero = F.struct(F.lit("").alias("s"), F.lit(1).alias("next"))

        def step(acc: Column, i: Column) -> Column:
            def put(k: Column) -> Column:
                part = join(groups, i, F.greatest(k, F.lit(1)))
                card = F.regexp_replace(part, r"^(.*\d)([ -]*)$", _OPEN + "$1" + _CLOSE + "$2")
                return F.struct(F.concat(acc["s"], F.when(k > 0, card).otherwise(part)).alias("s"),
                                (i + F.greatest(k, F.lit(1))).alias("next"))
            return F.when(i < acc["next"], acc).otherwise(_bound(lengths(groups, i), put))

        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), zero, step, lambda acc: acc["s"])

    groups = F.lit(f"(?:{_OPEN}[^{_CLOSE}]+{_CLOSE}|\\d+)[ -]*")
    return _bound(F.regexp_extract_all(run, groups, F.lit(0)), marked)


def _card(value: Column, key: str) -> Column:
    """The first digit (the network) stays, the others but the last are
    permuted, the last is the check digit of the new number. A number that
    fails its check is no card: unchanged."""
    d = digits_of(value)
    body = F.substr(d, F.lit(2), F.length(d) - 2)
    new = F.concat(F.substr(d, F.lit(1), F.lit(1)), permute_text(body, key, "card"))
    check = F.pmod(-luhn_sum(new, F.length(new) % 2 == 1), F.lit(10))
    return F.when(_valid_card(value), put_digits(value, F.concat(new, check.cast("string")))).otherwise(value)


def _phone(value: Column, key: str) -> Column:
    """Area code and exchange keep a first digit of 1 to 9; the country code
    stays."""
    d = F.right(digits_of(value), F.lit(10))
    area, exchange = F.substr(d, F.lit(1), F.lit(3)).cast("long"), F.substr(d, F.lit(4), F.lit(3)).cast("long")
    p = permute_pair((area - 100) * 900 + exchange - 100, F.substr(d, F.lit(7)), 810_000, 10_000, key, "phone")
    new = F.concat((F.floor(p["a"] / 900) + 100).cast("string"), (p["a"] % 900 + 100).cast("string"), _pad(p["b"], 4))
    return put_digits(value, new, F.length(digits_of(value)) - 10)


def _ssn(value: Column, key: str) -> Column:
    """Areas 001-899 but 666, groups 01-99, serials 0001-9999."""
    area, group, serial = (F.substr(value, F.lit(i), F.lit(n)).cast("long") for i, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    rank = area - 1 - F.when(area > 666, 1).otherwise(0)
    p = permute_pair(rank * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")
    new_area = F.floor(p["a"] / 99) + 1
    new_area = new_area + F.when(new_area >= 666, 1).otherwise(0)
    return F.when(valid, F.concat_ws("-", _pad(new_area, 3), _pad(p["a"] % 99 + 1, 2), _pad(p["b"] + 1, 4))) \
        .otherwise(value)


def _date(value: Column, key: str) -> Column:
    """Days of 1900 to 2099. A slash date is month first, or day first where
    only that is a date; the new date is written the way the old one was."""
    iso = F.substr(value, F.lit(1), F.lit(10))
    start = F.lit("1900-01-01").cast("date")
    out = value
    for shape, formats in ((r"^\d{4}-", ("yyyy-MM-dd",)), (r"^\d\d/", ("dd/MM/yyyy", "MM/dd/yyyy")),
                           (r"^\d\d\.", ("dd.MM.yyyy",))):
        for f in formats:  # the later format wins where both parse
            parsed = F.try_to_date(iso, f)
            n = F.datediff(parsed, start).cast("long")
            m, k = DATE_MODULI
            p = permute_pair(F.floor(n / k), n % k, m, k, key, "date")
            day = F.date_add(start, (p["a"] * k + p["b"]).cast("int"))
            out = F.when(value.rlike(shape) & parsed.isNotNull(), F.date_format(day, f)).otherwise(out)
    return out


def _ip(value: Column, key: str) -> Column:
    """Four numbers below 256, permuted as two 16-bit halves."""
    x = F.transform(F.split(value, r"\."), lambda s: s.cast("long"))
    valid = F.forall(x, lambda n: n < 256)
    p = permute_pair(x[0] * 256 + x[1], x[2] * 256 + x[3], 65536, 65536, key, "ip")
    return F.when(valid, F.concat_ws(".", *[c.cast("long").cast("string") for c in (
        F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256)])).otherwise(value)


def _email(value: Column, key: str) -> Column:
    """The mailbox is permuted with the lower-cased address as its identity;
    the domain stays."""
    at = F.instr(value, "@")
    box = F.lower(F.substr(value, F.lit(1), at - 1))
    return F.concat(permute_text(box, key, "email"), F.substr(value, at))


def _secret(value: Column, key: str) -> Column:
    """A credential: the public prefix of an access key stays."""
    return F.when(value.rlike("^AKIA[0-9A-Z]{16}$"), F.concat(
        F.lit("AKIA"), permute_text(F.substr(value, F.lit(5)), key, "secret"))) \
        .otherwise(permute_text(value, key, "secret"))


PERMUTE = {"secret": _secret, "email": _email, "phone": _phone, "card": _card, "ssn": _ssn, "date": _date, "ip": _ip}
# Which format a found value has, by its own shape.
SHAPES = {
    "email": r"@[^@]*\.[A-Za-z]+$",
    "ip": r"^\d{1,3}(?:\.\d{1,3}){3}$",
    "ssn": r"^\d{3}-\d{2}-\d{4}$",
    "date": r"^(?:\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})$",
    "phone": r"^(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}$",
    "card": CARD,
}
RUN = r"^\d[\d -]{11,}\d$"


def pseudonymise(docs: DataFrame, key: str = DEFAULT_KEY, text_col: str = "text") -> DataFrame:
    """``docs`` with the text's personal data replaced, and two more columns:
    ``pii_values`` (array of ``kind, value`` with the new values, in order)
    and ``n_pii`` (their number).

    Numbers that fail their check (a card's check digit, a calendar date, an
    SSN's ranges, an address above 255) stay as they are and are not counted.
    A text without any is returned as it is, a null one as null. A value's own
    pseudonym may by chance (one in the size of its format) be itself.
    """
    text = F.col(text_col)
    # Parts between the values, and the values: one more part than values.
    found = docs.withColumn("__hit", F.coalesce(text.rlike(ANY), F.lit(False)))
    found = found.withColumn("__values", F.when(F.col("__hit"), F.regexp_extract_all(text_of(text), F.lit(ANY), F.lit(0))))

    def classify(v: Column) -> Column:
        kind = F.lit("secret")
        new = _secret(v, key)
        for k, shape in reversed(list(SHAPES.items())):
            kind = F.when(v.rlike(shape), F.lit(k)).otherwise(kind)
            new = F.when(v.rlike(shape), PERMUTE[k](v, key)).otherwise(new)
        return F.struct(kind.alias("kind"), v.alias("old"), new.alias("value"))

    def between(pieces: Column, values: Column) -> Column:
        return F.array_join(F.zip_with(pieces, values, lambda p, v: F.concat(p, F.coalesce(v, F.lit("")))), "")

    def parts(v: Column) -> Column:
        """What a found value holds: a run several things, others themselves."""
        def of_run(m: Column) -> Column:
            held = F.transform(F.regexp_extract_all(m, F.lit(IN_RUN), F.lit(0)),
                               lambda x: classify(F.regexp_replace(x, f"[{_OPEN}{_CLOSE}]", "")))
            return _bound(held, lambda h: F.struct(
                h.alias("items"), between(F.split(m, IN_RUN, -1), h["value"]).alias("value")))
        single = _bound(classify(v), lambda c: F.struct(F.array(c).alias("items"), c["value"].alias("value")))
        # A number of one group or format is found whole.
        plain = v.rlike(SHAPES["phone"]) | ~v.rlike(RUN)
        return F.when(plain, single).otherwise(_bound(mark_cards(v), of_run))

    found = found.withColumn("__new", F.transform("__values", parts))
    joined = between(F.split(text, ANY, -1), F.col("__new")["value"])
    changed = F.filter(F.coalesce(F.flatten(F.col("__new")["items"]),
                                  F.array().cast("array<struct<kind:string,old:string,value:string>>")),
                       lambda x: x["value"] != x["old"])
    return (found
            .withColumn("pii_values", F.transform(changed, lambda x: F.struct(x["kind"].alias("kind"), x["value"].alias("value"))))
            .withColumn("n_pii", F.size("pii_values").cast("long"))
            .withColumn(text_col, F.when(F.col("__hit"), joined).otherwise(text))
            .drop("__hit", "__values", "__new"))
