"""Format-preserving pseudonyms for personal data, as keyed Feistel permutations in column expressions.

Found and checked: e-mail addresses, telephone numbers, payment cards (Luhn),
IBANs (modulo 97), social security numbers (number ranges), IPv4 addresses
(octets), calendar dates, and hexadecimal secrets that follow a word such as
``token``. What fails its check is left as it is. Cards and IBANs are looked for
in the whole run of digit or capital groups around them, from any group to any
other, so a number beside one does not hide it. Each find is replaced within
its format: digits stay digits, separators stay where they are, a card keeps a
right check digit, an IBAN its country and right check digits, a date becomes a
date, an address keeps its domain. The replacement is a permutation of the
values of a format under a secret key, so equal values get equal pseudonyms in
all documents, different ones different pseudonyms, and the key holder can
undo it with ``invert=True`` (a card in unusual groups beside other numbers only
if its groups are told apart from them as before).

Rounds hash with SHA-256 or SHA-512 over key, kind, round and the half that
stays. Everything is row by row: no shuffle, no Python on the executors.

Results: null stays null, an empty text empty; repeated rows get equal results;
an empty table gives an empty one. Extra columns pass through; an input column
named like an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apexlake.llm.common import unused
from apexlake.llm.quality import let

ROUNDS = 8

# The patterns, in the order in which they are tried at a place. A group that may repeat without bound is
# possessive: matched in a loop, where a greedy one recurses and ends the JVM on a long text.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[._%+-]*+[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "secret": r"(?i:(?<=(?:token|secret|key|password) ?[=:] ?[\"']?))[0-9a-fA-F]{16,}+(?![\p{L}\p{N}])",
    "date": r"(?<![\p{L}\p{N}])(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "ip": r"(?<![\p{L}\p{N}.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?[\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}-])\d{3}[.-]\d{3}[.-]\d{4}(?![\p{L}\p{N}-])",
}
# Groups of digits and capitals that a card or an IBAN may stand in, up to a group that begins another kind of find.
_GROUP = r"[A-Z0-9]++(?![\p{L}\p{N}])"
_OTHER = "|".join(PATTERNS[k] for k in ("email", "date", "ssn", "ip", "phone"))
RUN = (r"(?<![\p{L}\p{N}])(?=[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2}|\d(?:[ -]?\d){12})"
       rf"{_GROUP}(?:(?: (?!{_OTHER})|-(?=\d)){_GROUP})*+")
ANY = "|".join([*[f"({p})" if k == "secret" else p for k, p in PATTERNS.items()], RUN])
IS_RUN = r"^(?:[A-Z]{2}\d{2} ?[A-Z0-9]{4}|\d(?:[ -]?\d){12})[A-Z0-9 -]*$"
CARD, IBAN = r"^\d(?:[ -]?\d){12,18}$", r"^[A-Z]{2}\d{2}[A-Z0-9 ]{8,}$"
# Cards as they are printed; an IBAN of any length is taken where the groups of four end.
PRINTED = r"^(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{4,5})$"
GROUPS_OF_FOUR = r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])"
MOST_GROUPS = 19
# Letters and digits of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_OF_COUNTRY = "^(?:" + "|".join(f"(?:{c.replace(' ', '|')})[A-Z0-9]{{{n - 2}}}" for n, c in IBAN_LENGTHS.items()) + ")$"
# Only texts with one of these can hold a find.
HINT = r"[@\d]|(?i:token|secret|key|password) ?[=:]"
# Days from 1800-01-01 on that the Gregorian calendar repeats, as a product of two numbers.
FIRST_DAY, DAY_ROWS, DAY_COLUMNS = "1800-01-01", 189, 773


def _number(digest: Column, start: Column | int, length: int) -> Column:
    return F.conv(F.substring(digest, start, length) if isinstance(start, int) else F.substr(digest, start, F.lit(length)), 16, 10).cast("bigint")


def _rounds(invert: bool) -> Column:
    return F.array(*[F.lit(r) for r in (reversed(range(ROUNDS)) if invert else range(ROUNDS))])


def feistel_pair(a: Column, b: Column, rows: Column, columns: Column, key: str, label: str, invert: bool = False) -> Column:
    """A permutation of the pairs with ``0 <= a < rows`` and ``0 <= b < columns``: struct ``a, b`` of bigints.

    Rounds take turns: one half moves by a hash of the other, within its range.
    """

    def step(state: Column, r: Column) -> Column:
        still = F.when(r % 2 == 0, state["b"]).otherwise(state["a"])
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(label), r.cast("string"), still.cast("string")), 256)
        move = _number(digest, 1, 15) * (-1 if invert else 1)
        return F.struct(
            F.when(r % 2 == 0, F.pmod(state["a"] + F.pmod(move, rows), rows)).otherwise(state["a"]).alias("a"),
            F.when(r % 2 == 1, F.pmod(state["b"] + F.pmod(move, columns), columns)).otherwise(state["b"]).alias("b"))

    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(_rounds(invert), start, step)


def feistel_digits(digits: Column, key: str, label: str, invert: bool = False) -> Column:
    """A permutation of the digit strings of each length from 2 to 30."""
    n = F.length(digits)
    head = F.floor(n / 2).cast("int")
    a, b = F.substr(digits, F.lit(1), head), F.substr(digits, head + 1, n - head)

    def power(count: Column) -> Column:
        return F.rpad(F.lit("1"), count + 1, F.lit("0")).cast("bigint")

    moved = feistel_pair(a, b, power(head), power(n - head), key, label, invert)
    return let(moved, lambda m: F.concat(F.lpad(m["a"].cast("string"), head, F.lit("0")), F.lpad(m["b"].cast("string"), n - head, F.lit("0"))))


def feistel_text(text: Column, key: str, label: str, alphabets: tuple[str, ...], invert: bool = False) -> Column:
    """A permutation of the strings of a length that keeps each character in its alphabet.

    Characters of no alphabet move within their block of 32 code points if they
    are beyond ASCII; others stay. Halves take turns: one is shifted by hashes
    of the other.
    """

    def shifted(half: Column, other: Column, r: Column) -> Column:
        seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit(label), r.cast("string"), F.length(half).cast("string"), other), 512)

        def move(digest: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                by = _number(digest, (i % 32) * 4 + 1, 4) * (-1 if invert else 1)
                code = F.ascii(c)
                beyond = F.decode(F.unhex(F.lpad(F.hex(code - code % 32 + F.pmod(code % 32 + by, F.lit(32))), 4, "0")), "UTF-16BE")
                out = F.when((code >= 160) & (code < 0xD800), beyond).otherwise(c)
                for letters in reversed(alphabets):
                    at = F.instr(F.lit(letters), c)
                    out = F.when(at > 0, F.substr(F.lit(letters), (F.pmod(at - 1 + by, F.lit(len(letters))) + 1).cast("int"), F.lit(1))).otherwise(out)
                return out

            return F.array_join(F.transform(F.filter(F.split(half, ""), lambda c: c != ""), one), "")

        return let(seed, move)

    def step(state: Column, r: Column) -> Column:
        return F.struct(
            F.when(r % 2 == 0, state["a"]).otherwise(shifted(state["a"], state["b"], r)).alias("a"),
            F.when(r % 2 == 1, state["b"]).otherwise(shifted(state["b"], state["a"], r)).alias("b"))

    head = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), head).alias("a"), F.substr(text, head + 1, F.length(text)).alias("b"))
    return let(F.aggregate(_rounds(invert), start, step), lambda s: F.concat(s["a"], s["b"]))


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string whose last digit is not doubled."""
    def one(c: Column, i: Column) -> Column:
        doubled = c.cast("int") * 2
        return F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    reversed_ = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(F.transform(reversed_, one), F.lit(0), lambda total, x: total + x)


def mod97(text: Column) -> Column:
    """The remainder of a string of digits and capital letters (A is 10) by 97."""
    def step(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (rest * 10 + (F.ascii(c) - 48)) % 97).otherwise((rest * 100 + (F.ascii(c) - 55)) % 97)

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _iban_remainder(plain: Column) -> Column:
    return mod97(F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4)))


def _refill(shape: Column, values: Column) -> Column:
    """The letters and digits of ``shape`` replaced, one by one, by the characters of ``values``."""
    def step(state: Column, c: Column) -> Column:
        own = c.rlike("[0-9A-Za-z]")
        return F.struct(
            F.concat(state["out"], F.when(own, F.substr(values, state["k"], F.lit(1))).otherwise(c)).alias("out"),
            (state["k"] + own.cast("int")).alias("k"))

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    return F.aggregate(F.filter(F.split(shape, ""), lambda c: c != ""), start, step)["out"]


def kind_of(found: Column) -> Column:
    """The kind of a find that is no run, by its shape, or null if it fails the check of its kind."""
    digits = _only_digits(found)
    day = _as_date(found)
    octets = F.split(found, r"\.")
    is_ip, is_ssn = found.rlike(r"^\d+(\.\d+){3}$"), found.rlike(r"^\d{3}-\d{2}-\d{4}$")
    is_date = found.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})$")
    right_ssn = ~found.rlike(r"^(000|666|9\d\d)-") & ~found.rlike(r"-00-|-0000$")
    return (
        F.when(F.contains(found, F.lit("@")), "email")
        .when(is_ip, F.when(F.forall(octets, lambda o: o.cast("int") <= 255), "ip"))
        .when(is_ssn, F.when(right_ssn, "ssn"))
        .when(is_date, F.when(day.isNotNull(), "date"))
        .when(found.rlike(CARD) & (luhn_sum(digits) % 10 == 0), "card")
        .when(found.rlike(r"^[0-9a-fA-F]{16,}$"), "secret")
        .when(F.length(digits) >= 7, "phone")
    )


PARTS = "array<struct<found:string,kind:string>>"


def _part(found: Column, kind: Column) -> Column:
    return F.struct(found.alias("found"), kind.cast("string").alias("kind"))


def parts_of_run(run: Column) -> Column:
    """A run as the cards and IBANs in it and what stands between them, in order; the latter have no kind.

    Of those that begin at a group the usual form counts before others, then the
    longest. One of another form gives way to one of a usual form within it.
    """

    def cut(pieces: Column) -> Column:  # groups at odd places, their separators between
        n = F.size(pieces)

        def joined(start: Column, count: Column | int) -> Column:
            return F.array_join(F.slice(pieces, start, count), "")

        def best(start: Column) -> Column:
            ahead = F.regexp_extract(joined(start, 2 * MOST_GROUPS + 1), GROUPS_OF_FOUR, 0)

            def judged(count: Column) -> Column:
                def one(text: Column) -> Column:
                    plain = F.regexp_replace(text, " ", "")
                    right_card = text.rlike(CARD) & (luhn_sum(_only_digits(text)) % 10 == 0)
                    own_length = plain.rlike(IBAN_OF_COUNTRY)
                    right_iban = text.rlike(IBAN) & (own_length | (text == ahead)) & (_iban_remainder(plain) == 1)
                    kind = F.when(text.rlike("^[0-9]"), F.when(right_card, "card")).otherwise(F.when(right_iban, "iban"))
                    return F.struct(
                        F.coalesce(text.rlike(PRINTED) | own_length, F.lit(False)).alias("sure"), count.alias("count"),
                        kind.alias("kind"), text.alias("found"), start.alias("start"))

                return let(joined(start, count), one)

            counts = F.sequence(F.lit(1), F.least(F.lit(2 * MOST_GROUPS - 1), n - start + 1), F.lit(2))
            return F.array_max(F.filter(F.transform(counts, judged), lambda w: w["kind"].isNotNull()))

        def chosen(firsts: Column) -> Column:
            def stands(w: Column, i: Column) -> Column:
                within = F.slice(firsts, i + 2, F.floor(w["count"] / 2).cast("int"))
                return w.isNotNull() & (w["sure"] | ~F.exists(within, lambda o: F.coalesce(o["sure"], F.lit(False))))

            return F.filter(firsts, stands)

        def step(state: Column, w: Column) -> Column:
            added = F.concat(state["parts"], F.array(
                _part(joined(state["at"], w["start"] - state["at"]), F.lit(None)), _part(w["found"], w["kind"])))
            free = w["start"] >= state["at"]
            return F.struct(
                F.when(free, added).otherwise(state["parts"]).alias("parts"),
                F.when(free, w["start"] + w["count"]).otherwise(state["at"]).alias("at"))

        def ended(state: Column) -> Column:
            return F.concat(state["parts"], F.array(_part(joined(state["at"], n), F.lit(None))))

        empty = F.struct(F.array().cast(PARTS).alias("parts"), F.lit(1).alias("at"))
        firsts = F.transform(F.sequence(F.lit(1), n, F.lit(2)), best)
        return let(firsts, lambda f: F.aggregate(chosen(f), empty, step, ended))

    return let(F.regexp_extract_all(run, F.lit("[A-Z0-9]+|[ -]"), F.lit(0)), cut)


def parts_of(found: Column, secret: Column) -> Column:
    """A find as an array of ``found, kind``: what has no kind stays as it is."""
    address = F.regexp_replace(found, "^[._%+-]+", "")
    led = F.array(_part(F.regexp_extract(found, "^[._%+-]+", 0), F.lit(None)), _part(address, F.lit("email")))
    return (F.when(F.contains(found, F.lit("@")), led)
            .when(found.rlike(IS_RUN) & ~secret, parts_of_run(found))
            .otherwise(F.array(_part(found, kind_of(found)))))


def _as_date(found: Column) -> Column:
    """The day of a written date: year first, or day first, or month first where day first is no date."""
    parts = F.split(found, r"[./]")
    first, second, year = F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
    read = F.when(found.rlike("^\\d{4}-"), F.try_to_date(found, "yyyy-MM-dd")).otherwise(F.coalesce(
        F.try_to_date(F.concat_ws("-", year, second, first), "yyyy-MM-dd"),
        F.try_to_date(F.concat_ws("-", year, first, second), "yyyy-MM-dd")))
    day = F.datediff(read, F.lit(FIRST_DAY).cast("date"))
    return F.when((day >= 0) & (day < DAY_ROWS * DAY_COLUMNS), read)


def _date_pseudonym(found: Column, key: str, invert: bool) -> Column:
    """A day of the same 400 years, written with the same separators; what only reads as month first becomes day first."""
    day = F.datediff(_as_date(found), F.lit(FIRST_DAY).cast("date"))
    moved = feistel_pair(F.floor(day / DAY_COLUMNS), day % DAY_COLUMNS, F.lit(DAY_ROWS), F.lit(DAY_COLUMNS), key, "date", invert)
    new = let(moved, lambda m: F.date_add(F.lit(FIRST_DAY).cast("date"), (m["a"] * DAY_COLUMNS + m["b"]).cast("int")))
    separator = F.substring(found, 3, 1)
    return let(new, lambda d: F.when(found.rlike("^\\d{4}-"), F.date_format(d, "yyyy-MM-dd")).otherwise(
        F.concat(F.date_format(d, "dd"), separator, F.date_format(d, "MM"), separator, F.date_format(d, "yyyy"))))


_LETTERS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")


def pseudonym(found: Column, kind: Column, key: str, invert: bool = False) -> Column:
    """The pseudonym of one find of a kind; a find without a kind stays."""
    digits = _only_digits(found)
    local = F.substring_index(found, "@", 1)
    octets = F.split(found, r"\.")

    def octet(i: int) -> Column:
        return F.get(octets, F.lit(i)).cast("bigint")

    def card() -> Column:
        body = feistel_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card", invert)
        check = lambda b: F.pmod(10 - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10)).cast("string")
        return _refill(found, let(body, lambda b: F.concat(b, check(b))))

    def iban() -> Column:
        plain = F.regexp_replace(found, " ", "")
        body = feistel_text(F.substring(plain, 5, 40), key, "iban", _LETTERS, invert)
        country = F.substring(plain, 1, 2)
        check = lambda b: F.lpad((98 - mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0")
        return _refill(found, let(body, lambda b: F.concat(country, check(b), b)))

    def phone() -> Column:
        code = F.regexp_extract(found, r"^\+(\d{1,3}?)(?=[ .(-])", 1)  # a country code that is set apart stays
        rest = F.substr(digits, F.length(code) + 1, F.length(digits))
        return _refill(found, F.concat(code, feistel_digits(rest, key, "phone", invert)))

    address = feistel_pair(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), F.lit(65536), F.lit(65536), key, "ip", invert)
    numbers = let(address, lambda m: F.concat_ws(".", *[
        (F.floor(half / 256) if high else half % 256).cast("string") for half in (m["a"], m["b"]) for high in (True, False)]))
    return (
        F.when(kind == "email", F.concat(feistel_text(local, key, "email", _LETTERS, invert), F.substr(found, F.length(local) + 1, F.length(found))))
        .when(kind == "card", card())
        .when(kind == "phone", phone())
        .when(kind == "ssn", _refill(found, feistel_digits(digits, key, "ssn", invert)))
        .when(kind == "ip", numbers)
        .when(kind == "date", _date_pseudonym(found, key, invert))
        .when(kind == "iban", iban())
        .when(kind == "secret", feistel_text(found, key, "secret", ("0123456789abcdef", "ABCDEF"), invert))
        .otherwise(found)
    )


def pseudonymise(
    docs: DataFrame, key: str, text: str = "text", counts: str | None = "pii_kinds", invert: bool = False,
    change: Callable[[Column, Column, str, bool], Column] = pseudonym,
) -> DataFrame:
    """Replace every checked find in ``text``; add the array of the kinds replaced, in order, as ``counts``."""
    source, own = F.col(text), unused(docs, "pii")
    found, secrets, parted, changed = (f"{own}_{part}" for part in ("found", "secrets", "parts", "text"))
    finds = F.regexp_extract_all(source, F.lit(ANY), F.lit(0))
    empty = F.array().cast(f"array<{PARTS}>")
    # Where a secret could also be read as a run, the first group tells which it is.
    unclear = F.when(F.exists(found, lambda f: f.rlike("^[0-9A-F]{16,}$")), F.regexp_extract_all(source, F.lit(ANY), F.lit(1)))
    docs = docs.withColumn(found, F.when(source.rlike(HINT), finds)).withColumn(secrets, unclear)
    parts = F.transform(found, lambda f, i: parts_of(f, F.coalesce(F.get(secrets, i) == f, F.lit(False))))
    docs = docs.withColumn(parted, F.coalesce(parts, empty)).drop(found, secrets)
    kinds = F.filter(F.transform(F.flatten(parted), lambda f: f["kind"]), lambda k: k.isNotNull())
    between = F.split(source, ANY, -1)

    def put(parts: Column) -> Column:
        return F.array_join(F.transform(parts, lambda f: F.when(f["kind"].isNull(), f["found"]).otherwise(change(f["found"], f["kind"], key, invert))), "")

    replaced = let(between, lambda rest: F.concat(rest[0], F.array_join(F.zip_with(
        F.col(parted), F.slice(rest, 2, F.size(parted)), lambda f, after: F.concat(put(f), after)), "")))
    docs = docs.withColumn(changed, F.when(F.exists(F.flatten(parted), lambda f: f["kind"].isNotNull()), replaced).otherwise(source))
    if counts:
        docs = docs.withColumn(counts, kinds)
    return docs.withColumn(text, F.col(changed)).drop(parted, changed)
