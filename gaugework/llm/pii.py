"""Personal data replaced by format-preserving Feistel pseudonyms.

Found values are validated (check digits, issuers, octets, calendar) and permuted
by a keyed Feistel network within their format: a card number stays a card number
of its length, separators and issuer, a date a date of 1900 to 2099 in its
notation, an address an address. A permutation under one key gives equal
pseudonyms to equal values in all documents and different ones to different
values, and whoever has the key can turn it back. Numbers that fail their
validation are text and stay.

Kinds, in the order in which they are replaced: e-mail (the local part, letter
by letter within its class), secret (hexadecimal words of 32 to 64, access keys
by their known prefixes, and what follows a word such as password= or token:),
iban (by its check sum, which is made anew), card (13 to 19 digits of a known
issuer with a valid last digit, which is made anew), phone (digits after the
country code), ssn, ip (32 bits), ipv6 (by hexadecimal digit), date (day number).
A value inside one of an earlier kind (a date in an e-mail address) is part of
that one; a later kind that still fits a replaced value permutes it once more,
which the inverse, in the opposite order, undoes.

All of it is DataFrame expressions inside the row; a document without a mark of
a kind (an @, a plus, a run of digits) is not searched for it. No shuffle.

Defined results: a null text stays null with no findings, an empty one stays
empty, one of any length is searched whole; repeated rows give equal results;
extra columns pass through, those named like an output are replaced. A letter
beyond ASCII in a local part becomes another of its alphabet, or, in scripts
that LETTER_RUNS does not list, one of its sixteen neighbours, which the inverse
may then not find.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import fresh_names, let

ROUNDS = 6
#: Runs of code points that are all letters, as (first, last); a letter moves within its run.
LETTER_RUNS = (
    (0x00C0, 0x00D6), (0x00D8, 0x00F6), (0x00F8, 0x024F), (0x03A3, 0x03CE), (0x0400, 0x0481), (0x048A, 0x052F), (0x05D0, 0x05EA), (0x0620, 0x064A),
    (0x0561, 0x0586), (0x0905, 0x0939), (0x0E01, 0x0E30), (0x10D0, 0x10FA), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3),
)
#: Leading digits of card issuers, digits of a card's number that stay, prefixes of access keys, words before a secret.
ISSUERS = r"^(?:4|5[0-9]|2[2-7]|3[04-9]|6[0-9])"
ISSUER_DIGITS = 4
KEY_PREFIX = r"(?:AKIA|ASIA|sk_live_|sk_test_|pk_live_|ghp_|gho_|xox[abp]-)"
#: What a text with such a prefix shows, beginning with a letter so that few places are tried.
KEY_MARK = "[Aspgx](?:[KS]IA|k_(?:live|test)_|h[po]_|ox[abp]-)"
SECRET_WORD = r"(?i:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key)[\"']?[ ]?[:=][ ]?[\"']?"


def _mix(key: str, tweak: Column | str, number: Column, value: Column) -> Column:
    """60 keyed bits of a round number and a value."""
    tweak = F.lit(tweak) if isinstance(tweak, str) else tweak
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, number.cast("string"), value.cast("string"), F.lit(key)).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, tweak: Column | str, inverse: bool = False) -> Column:
    """Permute (left, right) in [0, left_size) x [0, right_size); a struct of both."""
    state = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    numbers = F.array(*[F.lit(k) for k in (range(ROUNDS, 0, -1) if inverse else range(1, ROUNDS + 1))])

    def onward(acc, i):
        new = F.pmod(acc["l"] + F.pmod(_mix(key, tweak, i, acc["r"]), left_size), left_size)
        return F.struct(new.alias("l"), F.pmod(acc["r"] + F.pmod(_mix(key, tweak, -i, new), right_size), right_size).alias("r"))

    def back(acc, i):
        old = F.pmod(acc["r"] - F.pmod(_mix(key, tweak, -i, acc["l"]), right_size), right_size)
        return F.struct(F.pmod(acc["l"] - F.pmod(_mix(key, tweak, i, old), left_size), left_size).alias("l"), old.alias("r"))

    return F.aggregate(numbers, state, back if inverse else onward)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def permute_digits(digits: Column, key: str, tweak: Column | str, inverse: bool = False) -> Column:
    """A string of 2 to 36 digits as another of its length."""
    half = F.floor(F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    size = lambda n: F.pow(F.lit(10.0), n).cast("long")
    out = feistel(F.left(digits, half).cast("long"), F.right(digits, rest).cast("long"), size(half), size(rest), key, tweak, inverse)
    return F.element_at(F.transform(F.array(out), lambda s: F.concat(F.lpad(s["l"].cast("string"), half, F.lit("0")), F.lpad(s["r"].cast("string"), rest, F.lit("0")))), 1)


def refill(template: Column, digits: Column, slot: str = "^[0-9]$") -> Column:
    """The template with its digits, or other characters that `slot` matches, replaced in turn."""
    put = F.aggregate(
        F.split(template, ""),
        F.struct(F.lit("").alias("s"), F.lit(1).alias("k")),
        lambda acc, c: F.when(
            c.rlike(slot), F.struct(F.concat(acc["s"], F.substr(digits, acc["k"], F.lit(1))).alias("s"), (acc["k"] + 1).alias("k"))
        ).otherwise(F.struct(F.concat(acc["s"], c).alias("s"), acc["k"].alias("k"))),
        lambda acc: acc["s"],
    )
    return put


def _luhn_sum(digits: Column, first: int) -> Column:
    """Sum of the digits from the right, every second one doubled; first: 0 if the last digit counts once."""
    return F.aggregate(
        F.split(F.reverse(digits), ""),
        F.struct(F.lit(0).alias("s"), F.lit(first).alias("k")),
        lambda acc, c: F.struct(
            (acc["s"] + F.when(acc["k"] == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))).alias("s"),
            (1 - acc["k"]).alias("k"),
        ),
        lambda acc: acc["s"],
    )


def _card(x: Column, key: str, inverse: bool) -> Column:
    def of(d: Column) -> Column:
        head = F.left(d, F.lit(ISSUER_DIGITS))
        body = F.substr(d, F.lit(ISSUER_DIGITS + 1), F.length(d) - ISSUER_DIGITS - 1)
        new = F.concat(head, permute_digits(body, key, F.concat(F.lit("card"), head), inverse))
        return let(new, lambda n: F.concat(n, F.pmod(-_luhn_sum(n, 1), F.lit(10)).cast("string")))

    return refill(x, let(_digits(x), of))


def _phone(x: Column, key: str, inverse: bool) -> Column:
    code = F.coalesce(F.regexp_extract(x, r"^(?:\+\d{1,3}(?=[ .(-])|0(?=\d+[ /-]))", 0), F.lit(""))
    rest = F.substr(x, F.length(code) + 1, F.length(x))
    return F.concat(code, refill(rest, permute_digits(_digits(rest), key, F.concat(F.lit("phone"), code), inverse)))


def _ssn(x: Column, key: str, inverse: bool) -> Column:
    out = feistel(F.substring(x, 5, 2).cast("long") - 1, F.substring(x, 8, 4).cast("long") - 1, F.lit(99), F.lit(9999), key, F.concat(F.lit("ssn"), F.substring(x, 1, 3)), inverse)
    return let(out, lambda s: F.concat(F.substring(x, 1, 4), F.lpad((s["l"] + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((s["r"] + 1).cast("string"), 4, "0")))


def _octet(x: Column, k: int) -> Column:
    return F.split(x, r"\.")[k].cast("long")


def _ip(x: Column, key: str, inverse: bool) -> Column:
    out = feistel(_octet(x, 0) * 256 + _octet(x, 1), _octet(x, 2) * 256 + _octet(x, 3), F.lit(65536), F.lit(65536), key, "ip", inverse)
    part = lambda v: F.concat_ws(".", F.floor(v / 256).cast("string"), F.pmod(v, F.lit(256)).cast("string"))
    return let(out, lambda s: F.concat_ws(".", part(s["l"]), part(s["r"])))


#: Days from 1900-01-01 to 2099-12-31 are 319 x 229.
FIRST_DAY, LAST_DAY, DAYS_A, DAYS_B = "1900-01-01", "2099-12-31", 319, 229


def _day(x: Column) -> Column:
    iso = F.try_to_timestamp(x, F.lit("yyyy-MM-dd"))
    dotted = F.try_to_timestamp(x, F.lit("dd.MM.yyyy"))
    slashed = F.try_to_timestamp(x, F.lit("MM/dd/yyyy"))
    ordered = F.try_to_timestamp(x, F.lit("yyyy/MM/dd"))
    return F.coalesce(iso, dotted, slashed, ordered).cast("date")


def _date(x: Column, key: str, inverse: bool) -> Column:
    number = F.datediff(_day(x), F.lit(FIRST_DAY).cast("date")).cast("long")
    out = let(number, lambda n: feistel(F.floor(n / DAYS_B), F.pmod(n, F.lit(DAYS_B)), F.lit(DAYS_A), F.lit(DAYS_B), key, "date", inverse))
    day = let(out, lambda s: F.date_add(F.lit(FIRST_DAY).cast("date"), (s["l"] * DAYS_B + s["r"]).cast("int")))
    style = lambda f: F.date_format(day, f)
    return F.when(x.contains("-"), style("yyyy-MM-dd")).when(x.contains("."), style("dd.MM.yyyy")).when(x.rlike("^[0-9]{4}/"), style("yyyy/MM/dd")).otherwise(style("MM/dd/yyyy"))


def _char(code: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")


def _shift(text: Column, by: Column, sign: int, letters: Column) -> Column:
    """Each letter or digit moved within its run by the codes of `by`, a digest; others stay. letters: how many ASCII letters a run has."""
    runs = [(48, 57), (65, 90), (97, 122), *LETTER_RUNS]
    firsts, lasts = (F.split(F.lit(",".join(str(run[k]) for run in runs)), ",").cast("array<int>") for k in (0, 1))

    def move(c: Column, i: Column) -> Column:
        at = F.pmod(i, F.lit(32)) * 2
        step = sign * (F.ascii(F.substr(by, at + 1, F.lit(1))) * 16 + F.ascii(F.substr(by, at + 2, F.lit(1))))
        # The run that begins at or before the character, and its length; where it ends before, sixteen neighbours.
        code = F.ascii(c)
        run = let(F.size(F.filter(firsts, lambda f: f <= code)) - 1, lambda k: F.struct(F.get(firsts, k).alias("first"), F.get(lasts, k).alias("last")))
        place = let(run, lambda r: F.when(code <= r["last"], F.struct(r["first"].alias("first"), F.when(code > 127, r["last"] - r["first"] + 1).when(code < 58, 10).otherwise(letters).alias("n")))
                    .when(code > 127, F.struct((F.floor(code / 16) * 16).cast("int").alias("first"), F.lit(16).alias("n"))))
        moved = let(place, lambda p: _char(p["first"] + F.pmod(code - p["first"] + step, p["n"])))
        return F.when(c.rlike(r"^[\p{L}\p{N}]$"), F.coalesce(moved, c)).otherwise(c)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), move), "")


def permute_letters(x: Column, key: str, tweak: Column | str, inverse: bool = False, letters: Column | int = 26) -> Column:
    """A Feistel network over the halves of a string, letter by letter, each within its class; a string of one letter moves alone."""
    letters = F.lit(letters) if isinstance(letters, int) else letters
    tweak = F.lit(tweak) if isinstance(tweak, str) else tweak
    half = F.floor(F.length(x) / 2).cast("int")
    state = F.struct(F.left(x, half).alias("l"), F.right(x, F.length(x) - half).alias("r"))
    code = lambda i, v: F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), v, F.lit(key)).cast("binary"), 256)
    numbers = F.array(*[F.lit(k) for k in (range(ROUNDS, 0, -1) if inverse else range(1, ROUNDS + 1))])

    def onward(acc, i):
        new = _shift(acc["l"], code(i, acc["r"]), 1, letters)
        return F.struct(new.alias("l"), _shift(acc["r"], code(-i, new), 1, letters).alias("r"))

    def back(acc, i):
        old = _shift(acc["r"], code(-i, acc["l"]), -1, letters)
        return F.struct(_shift(acc["l"], code(i, old), -1, letters).alias("l"), old.alias("r"))

    return F.aggregate(numbers, state, back if inverse else onward, lambda acc: F.concat(acc["l"], acc["r"]))


def _email(x: Column, key: str, inverse: bool) -> Column:
    local, domain = F.substring_index(x, "@", 1), F.substring_index(x, "@", -1)
    return F.concat(permute_letters(local, key, F.concat(F.lit("email"), F.lower(domain)), inverse), F.lit("@"), domain)


def _secret(x: Column, key: str, inverse: bool) -> Column:
    """The secret after the word or prefix that shows it; hexadecimal digits stay such."""
    head = F.regexp_extract(x, f"^(?:{SECRET_WORD}|{KEY_PREFIX})", 0)
    rest = F.substr(x, F.length(head) + 1, F.length(x))
    return let(rest, lambda r: F.concat(head, permute_letters(r, key, "secret", inverse, F.when(r.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 6).otherwise(26))))


def _mod97(text: Column) -> Column:
    """Remainder of a string of digits and capitals (A is 10) by 97."""
    step = lambda r, c: F.when(c.rlike("[0-9]"), F.pmod(r * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(F.pmod(r * 100 + F.ascii(c) - 55, F.lit(97)))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _iban_valid(x: Column) -> Column:
    return let(F.replace(x, F.lit(" "), F.lit("")), lambda v: F.length(v).between(15, 34) & (_mod97(F.concat(F.substr(v, F.lit(5), F.length(v)), F.left(v, F.lit(4)))) == 1))


def _iban(x: Column, key: str, inverse: bool) -> Column:
    def of(v: Column) -> Column:
        land = F.left(v, F.lit(2))
        body = permute_letters(F.substr(v, F.lit(5), F.length(v)), key, F.concat(F.lit("iban"), land), inverse)
        return let(body, lambda n: F.concat(land, F.lpad((98 - _mod97(F.concat(n, land, F.lit("00")))).cast("string"), 2, "0"), n))

    return refill(x, let(F.replace(x, F.lit(" "), F.lit("")), of), "^[0-9A-Z]$")


def _ipv6(x: Column, key: str, inverse: bool) -> Column:
    return permute_letters(x, key, "ipv6", inverse, 6)


def _ipv6_valid(x: Column) -> Column:
    """Eight groups, or fewer around one double colon, and a digit."""
    colons = F.length(x) - F.length(F.replace(x, F.lit(":"), F.lit("")))
    short = F.regexp_count(x, F.lit("::"))
    return x.rlike("[0-9]") & ~x.rlike(":::") & ~x.rlike("[^:]:$|^:[^:]") & F.when(short == 0, colons == 7).otherwise((short == 1) & (colons <= 7))


@dataclass(frozen=True)
class Kind:
    """A pattern, a cheap mark that any match shows, a validation and a permutation."""

    name: str
    mark: Callable[[Column], Column]
    pattern: str
    valid: Callable[[Column], Column]
    permute: Callable[[Column, str, bool], Column]


KINDS = (
    Kind("email", lambda t: t.contains("@"), r"(?<![\p{L}\p{N}._%+'-])[\p{L}\p{N}._%+-]++(?:'[\p{L}\p{N}._%+-]++)*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+", lambda x: x.rlike(r"^[^@]*[\p{L}\p{N}]"), _email),
    Kind(
        "secret",
        lambda t: t.rlike("[0-9a-fA-F]{32}") | t.rlike(KEY_MARK) | t.rlike("[:=]") & t.rlike(f"{SECRET_WORD}[^ ]{{8}}"),
        rf"(?<![0-9A-Za-z]){SECRET_WORD}[^\s\"',;]{{8,128}}|(?<![0-9A-Za-z]){KEY_PREFIX}[0-9A-Za-z-]{{12,128}}(?![0-9A-Za-z])|(?<![0-9A-Za-z])(?:[0-9a-f]{{32,64}}|[0-9A-F]{{32,64}})(?![0-9A-Za-z])",
        lambda x: x.rlike(f"^(?:{SECRET_WORD}|{KEY_PREFIX}).*[0-9]") | x.rlike("^[0-9a-fA-F]+$") & x.rlike("[0-9]") & x.rlike("[A-Fa-f]"),
        _secret,
    ),
    Kind(
        "iban",
        lambda t: t.rlike("[A-Z]{2}[0-9]{2} ?[0-9A-Z]{4} ?[0-9A-Z]{4}"),
        r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?)(?![0-9A-Za-z])",
        _iban_valid,
        _iban,
    ),
    Kind(
        "card",
        lambda t: t.rlike("[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}"),
        r"(?<![\p{L}0-9]|[0-9][.,])(?:[0-9]{13,19}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{1,7}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{1,7})(?![\p{L}0-9]|[.,][0-9])",
        lambda x: let(_digits(x), lambda d: (F.length(d).between(13, 19)) & (F.pmod(_luhn_sum(d, 0), F.lit(10)) == 0) & d.rlike(ISSUERS)),
        _card,
    ),
    Kind(
        "phone",
        lambda t: t.rlike(r"\+[0-9]|[0-9]{3}[ .-][0-9]{4}|0[0-9]{2,4}[ /-][0-9]{3}"),
        r"(?<![\p{L}0-9])\+[0-9]{8,15}(?![0-9]|\.[0-9])|(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])|(?<![0-9+])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9.+-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])|(?<![\p{L}0-9+.,/-]|[0-9] )0[0-9]{2,4}[ /-][0-9]{3,8}(?:[ -][0-9]{2,8}){0,2}(?![0-9]|[.,/-][0-9])",
        lambda x: F.length(_digits(x)).between(8, 15),
        _phone,
    ),
    Kind(
        "ssn",
        lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda x: ~x.rlike("^(000|666|9)") & ~x.rlike("-00-|-0000$"),
        _ssn,
    ),
    Kind(
        "ip",
        lambda t: t.rlike(r"[0-9]\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]"),
        r"(?<![\p{L}0-9]|[0-9]\.)(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\p{L}0-9]|\.[0-9])",
        lambda x: F.forall(F.split(x, r"\."), lambda o: (o.cast("int") <= 255) & ~o.rlike("^0[0-9]")),
        _ip,
    ),
    Kind(
        "ipv6",
        lambda t: t.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]{0,4}:"),
        r"(?<![\p{L}0-9:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\p{L}0-9:])",
        _ipv6_valid,
        _ipv6,
    ),
    Kind(
        "date",
        lambda t: t.rlike(r"[0-9]{4}[/-][0-9]{2}[/-][0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4}"),
        r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-]|\.[0-9])",
        lambda x: F.coalesce(_day(x).between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), F.lit(False)),
        _date,
    ),
)


def _replaced(kind: Kind, text: Column, key: str, inverse: bool) -> Column:
    """A struct of the text with the kind's values permuted and their number.

    Every value is bound once, so the expression stays as long as the list of
    kinds, whatever is filtered or projected above it.
    """
    hits = F.when(kind.mark(text), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))

    def with_hits(h: Column) -> Column:
        tested = F.when(F.size(h) > 0, F.transform(h, lambda x: F.coalesce(kind.valid(x), F.lit(False)))).otherwise(F.array().cast("array<boolean>"))

        def with_tests(v: Column) -> Column:
            # A hit that fails its test stays as it is.
            new = F.zip_with(h, v, lambda x, yes: F.when(yes, kind.permute(x, key, inverse)).otherwise(x))
            parts = F.zip_with(F.split(text, kind.pattern, -1), new, lambda part, hit: F.concat(part, F.coalesce(hit, F.lit(""))))
            return F.struct(
                F.when(F.exists(v, lambda yes: yes), F.array_join(parts, "")).otherwise(text).alias("text"),
                F.size(F.filter(v, lambda yes: yes)).cast("long").alias("n"),
            )

        return let(tested, with_tests)

    return let(hits, with_hits)


def pseudonymize(docs: DataFrame, key: str, text: str = "text", inverse: bool = False) -> DataFrame:
    """docs with the text replaced, `n_<kind>` for each kind, and `n_pii`; inverse turns pseudonyms back under the same key."""
    names = [f"n_{k.name}" for k in KINDS]
    out = docs.drop(*[c for c in docs.columns if c.lower() in (*names, "n_pii") and c != text])
    state = fresh_names(out, "pii")[0]
    out = out.withColumn(state, F.struct(F.col(text).cast("string").alias("text")))
    known: list[str] = []

    def step(kind: Kind, before: list[str]) -> Column:
        def onward(s: Column) -> Column:
            return let(_replaced(kind, s["text"], key, inverse), lambda r: F.struct(r["text"].alias("text"), *[s[n].alias(n) for n in before], r["n"].alias(f"n_{kind.name}")))

        return let(F.col(state), onward)

    for kind in reversed(KINDS) if inverse else KINDS:
        out = out.withColumn(state, step(kind, list(known)))
        known.append(f"n_{kind.name}")
    total = F.lit(0).cast("long")
    for name in names:
        total = total + F.col(f"{state}.{name}")
    return out.withColumns({text: F.col(f"{state}.text"), **{n: F.col(f"{state}.{n}") for n in names}, "n_pii": total}).drop(state)
