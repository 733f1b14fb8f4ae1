"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Card numbers, phone numbers, social security numbers, IBANs, IPv4 addresses,
dates and e-mail addresses are found by one pattern, validated, and replaced by
a keyed Feistel permutation of their own format: a card stays a valid card, a
date stays a date, separators stay where they are.  A permutation has no
collisions, so equal values get equal pseudonyms in every document and
different values stay different.  Values that fail validation are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, free

ROUNDS = 8
#: Replaced dates: the days from 1900-01-01 to 2099-12-31, 17 * 4297 of them.
FIRST_DAY, DAY_HIGH, DAY_LOW = "1900-01-01", 17, 4297

EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
         r"(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)++")   # possessive: a loop in Java, not a call a label
#: Countries by the length of their IBANs (SWIFT registry).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _spaced_iban(n: int, countries: str) -> str:
    """In groups of four, of just this length: what follows is not part of it."""
    last = f" [A-Z0-9]{{{n % 4}}}" if n % 4 else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}{last}"


#: A group that starts an IBAN of a known country ends what other countries' IBANs take.
_NOT_NEXT = f"(?!(?:{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')})[0-9]{{2}} )"
IBAN = (r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:[A-Z0-9]{15,34}|" + "|".join(_spaced_iban(*x) for x in IBAN_LENGTHS.items())
        + rf"|[A-Z0-9]{{4}}(?: {_NOT_NEXT}[A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])")
IP = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"
DATE_Y = r"(?<![0-9A-Za-z/.-])[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}(?![0-9A-Za-z]|[/.-][0-9])"
DATE_D = r"(?<![0-9A-Za-z/.-])[0-9]{2}([-/.])[0-9]{2}\2[0-9]{4}(?![0-9A-Za-z]|[/.-][0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
NANP = (r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])"
        r"[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])")
NANP_PLAIN = r"(?<![0-9A-Za-z])\+1[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])"
PHONE = r"(?<![0-9A-Za-z])\+[2-9][0-9]{0,2}(?:[ -]?\([0-9]{1,4}\))?(?:[ -]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\3[0-9]{4}\3[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\4[0-9]{5})(?![0-9A-Za-z])"
#: Alternatives in order of preference at one position; the numbered separators count over the whole pattern.
PATTERN = "|".join(f"(?:{p})" for p in (EMAIL, IBAN, IP, DATE_Y, DATE_D, SSN, NANP, NANP_PLAIN, PHONE, CARD))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _lit(text: str) -> Column:
    return F.lit(text)


class Pseudonyms:
    """Column functions under one key."""

    def __init__(self, key: str):
        self.key = key

    def _noise(self, kind: str, i: Column, text: Column) -> Column:
        """60 keyed bits."""
        h = F.sha2(F.concat_ws("|", _lit(self.key), _lit(kind), i.cast("string"), text).cast("binary"), 256)
        return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")

    def pair(self, high: Column, low: Column, a: Column, b: Column, kind: str) -> Column:
        """Permutation of pairs (l, r) with 0 <= l < a, 0 <= r < b, as struct(l, r)."""
        start = F.struct(high.cast("bigint").alias("l"), low.cast("bigint").alias("r"))

        def step(s, i):
            left = F.pmod(s["l"] + self._noise(kind, i, s["r"].cast("string")) % a, a)
            right = F.pmod(s["r"] + self._noise(kind, i, s["l"].cast("string")) % b, b)
            even = i % 2 == 0
            return F.struct(F.when(even, left).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(right).alias("r"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)

    def digits(self, text: Column, kind: str) -> Column:
        """Permutation of the digit strings of each length (at most 36 digits)."""
        def body(s):
            n = F.length(s)
            h = F.floor(n / 2).cast("int")
            ten = lambda k: F.rpad(_lit("1"), k + 1, "0").cast("bigint")
            halves = self.pair(F.coalesce(F.substr(s, F.lit(1), h).try_cast("bigint"), F.lit(0)),
                               F.substr(s, h + 1, n - h).cast("bigint"), ten(h), ten(n - h), kind)
            return _let(halves, lambda p: F.concat(
                F.when(h > 0, F.lpad(p["l"].cast("string"), h, _lit("0"))).otherwise(""),
                F.lpad(p["r"].cast("string"), n - h, _lit("0"))))
        return F.when(F.length(text) > 0, _let(text, body)).otherwise(text)

    def card(self, m: Column) -> Column:
        """Valid check digit: the first digit stays, the check digit is worked out again."""
        def body(d):
            n = F.length(d)
            inner = F.concat(F.substring(d, 1, 1), self.digits(F.substr(d, F.lit(2), n - 2), "card"))
            new = _let(inner, lambda x: F.concat(x, (F.pmod(-luhn(F.concat(x, _lit("0"))), F.lit(10))).cast("string")))
            return F.when((n >= 13) & (n <= 19) & (luhn(d) % 10 == 0) & ~d.rlike("^0+$"), refill(m, new))
        return _let(only_digits(m), body)

    def phone(self, m: Column) -> Column:
        """Ten national digits with area and exchange codes from 200; others keep their first two digits."""
        def body(d):
            n = F.length(d)
            national = F.substr(d, n - 9, F.lit(10))
            pair = self.pair(F.substring(national, 1, 3).cast("bigint") - 200, F.substring(national, 4, 7).cast("bigint") - 2000000,
                             F.lit(800), F.lit(8000000), "phone")
            nanp = _let(pair, lambda p: F.concat(F.substr(d, F.lit(1), n - 10), (p["l"] + 200).cast("string"),
                                                 (p["r"] + 2000000).cast("string")))
            other = F.concat(F.substring(d, 1, 2), self.digits(F.substr(d, F.lit(3), n - 2), "phone"))
            is_nanp = d.rlike("^1?[2-9][0-9]{2}[2-9][0-9]{6}$") & ~m.rlike(r"^\+[2-9]")
            return F.when(is_nanp, refill(m, nanp)).when((n >= 8) & (n <= 15), refill(m, other))
        return _let(only_digits(m), body)

    def ssn(self, m: Column) -> Column:
        """Area 001-899 without 666, group and serial not zero."""
        area, group, serial = (F.substring(m, i, k).cast("bigint") for i, k in ((1, 3), (5, 2), (8, 4)))
        pair = self.pair(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1,
                         F.lit(898), F.lit(99 * 9999), "ssn")
        new = _let(pair, lambda p: F.concat_ws(
            "-", F.lpad((p["l"] + F.when(p["l"] >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
            F.lpad((F.floor(p["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((p["r"] % 9999 + 1).cast("string"), 4, "0")))
        return F.when((area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0), new)

    def ip(self, m: Column) -> Column:
        """Four octets up to 255."""
        def body(o):
            n = [F.element_at(o, i).cast("int") for i in (1, 2, 3, 4)]
            pair = self.pair(n[0] * 256 + n[1], n[2] * 256 + n[3], F.lit(65536), F.lit(65536), "ip")
            new = _let(pair, lambda p: F.concat_ws(".", *[
                x.cast("string") for x in (F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256)]))
            return F.when(F.forall(o, lambda x: x.cast("int") <= 255), new)
        return _let(F.split(m, r"\."), body)

    def date(self, m: Column) -> Column:
        """Year first, or day and month first (day first where both readings are dates)."""
        sep = F.when(m.rlike("^[0-9]{4}"), F.substring(m, 5, 1)).otherwise(F.substring(m, 3, 1))
        year_first = m.rlike("^[0-9]{4}")
        y = F.when(year_first, F.substring(m, 1, 4)).otherwise(F.substring(m, 7, 4))
        a = F.when(year_first, F.substring(m, 6, 2)).otherwise(F.substring(m, 1, 2))
        b = F.when(year_first, F.substring(m, 9, 2)).otherwise(F.substring(m, 4, 2))
        dm = F.to_date(F.try_to_timestamp(F.concat_ws("-", y, b, a), F.lit("yyyy-MM-dd")))   # day, month
        md = F.to_date(F.try_to_timestamp(F.concat_ws("-", y, a, b), F.lit("yyyy-MM-dd")))
        value = F.when(year_first, md).otherwise(F.coalesce(dm, md))
        shape = F.when(year_first, "y").when(dm.isNotNull(), "d").otherwise("m")
        day = F.datediff(value, F.lit(FIRST_DAY).cast("date"))
        pair = self.pair(F.floor(day / DAY_LOW), day % DAY_LOW, F.lit(DAY_HIGH), F.lit(DAY_LOW), "date")

        def shown(x):
            new = F.date_add(F.lit(FIRST_DAY).cast("date"), (x["p"]["l"] * DAY_LOW + x["p"]["r"]).cast("int"))
            yy, mm, dd = F.date_format(new, "yyyy"), F.date_format(new, "MM"), F.date_format(new, "dd")
            return (F.when(x["shape"] == "y", F.concat(yy, x["sep"], mm, x["sep"], dd))
                    .when(x["shape"] == "d", F.concat(dd, x["sep"], mm, x["sep"], yy))
                    .otherwise(F.concat(mm, x["sep"], dd, x["sep"], yy)))

        new = _let(F.struct(pair.alias("p"), sep.alias("sep"), shape.alias("shape")), shown)
        return F.when((day >= 0) & (day < DAY_HIGH * DAY_LOW), new)

    def iban(self, m: Column) -> Column:
        """Valid remainder: country and letters stay, check digits are worked out again."""
        def body(c):
            bank = F.substr(c, F.lit(5), F.length(c) - 4)
            valid = (F.length(c) >= 15) & (F.length(c) <= 34) & (mod97(F.concat(bank, F.substring(c, 1, 4))) == 1)
            new_bank = refill(bank, self.digits(only_digits(bank), "iban"))
            new = _let(new_bank, lambda x: F.concat(
                F.substring(c, 1, 2),
                F.lpad((98 - mod97(F.concat(x, F.substring(c, 1, 2), _lit("00")))).cast("string"), 2, "0"), x))
            return F.when(valid & bank.rlike("[0-9]"), respace(m, new))
        return _let(F.translate(m, " ", ""), body)

    def email(self, m: Column) -> Column:
        """Letters and digits of the local part are permuted within their class; the domain stays."""
        local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)

        def step(s, i):
            left = self._shift(s["l"], self._stream(i, s["r"]))
            right = self._shift(s["r"], self._stream(i, s["l"]))
            even = i % 2 == 0
            return F.struct(F.when(even, left).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(right).alias("r"))

        h = F.floor(F.length(local) / 2).cast("int")
        start = F.struct(F.substr(local, F.lit(1), h).alias("l"), F.substr(local, h + 1, F.length(local) - h).alias("r"))
        done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["l"], s["r"]))
        return F.concat(done, _lit("@"), domain)

    def _stream(self, i: Column, text: Column) -> Column:
        """64 hex digits per text and round; longer halves use them again."""
        return F.sha2(F.concat_ws("|", _lit(self.key), _lit("email"), i.cast("string"), text).cast("binary"), 256)

    def _shift(self, text: Column, stream: Column) -> Column:
        """Each letter and digit moved by four hex digits of the stream, within its class; in time linear in the text."""
        def shifted(st):
            def one(ch, i):
                n = F.conv(F.substr(st, i * 4 % 60 + 1, F.lit(4)), 16, 10).cast("int")
                at = F.ascii(ch)
                moved = lambda first, size: F.char(F.lit(first) + (at - first + n) % size)
                return (F.when((at >= 97) & (at <= 122), moved(97, 26)).when((at >= 65) & (at <= 90), moved(65, 26))
                        .when((at >= 48) & (at <= 57), moved(48, 10)).otherwise(ch))
            return F.array_join(F.transform(F.split(text, ""), one), "")
        return F.when(F.length(text) > 0, _let(stream, shifted)).otherwise("")

    def of(self, m: Column) -> Column:
        """The pseudonym of one match; the match itself if it isn't valid."""
        new = (F.when(m.contains("@"), self.email(m))
               .when(m.rlike("^[A-Z]"), self.iban(m))
               .when(m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), self.ip(m))
               .when(m.rlike("^(?:[0-9]{4}([-/.])[0-9]{2}[-/.][0-9]{2}|[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4})$"), self.date(m))
               .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), self.ssn(m))
               .when(m.rlike(r"^[+(]|^(?:1[ .-]?)?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$|^1[ .-]?\("), self.phone(m))
               .otherwise(self.card(m)))
        return F.coalesce(new, m)


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn sum of a digit string."""
    n = F.length(digits)

    def add(acc, i):
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def mod97(text: Column) -> Column:
    """Remainder of letters (A = 10 ...) and digits read as one number."""
    def add(acc, i):
        at = F.ascii(F.substr(text, i, F.lit(1)))
        return F.when(at < 58, (acc * 10 + at - 48) % 97).otherwise((acc * 100 + at - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def _put(mask: Column, new: Column, taken) -> Column:
    """``mask`` with the characters where ``taken`` holds replaced, in order, by those of ``new``."""
    def add(s, i):
        ch = F.substr(mask, i, F.lit(1))
        hit = taken(ch)
        return F.struct(F.concat(s["out"], F.when(hit, F.substr(new, s["k"], F.lit(1))).otherwise(ch)).alias("out"),
                        (s["k"] + hit.cast("int")).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), F.length(mask)), F.struct(_lit("").alias("out"), F.lit(1).alias("k")), add,
                       lambda s: s["out"])


def refill(mask: Column, digits: Column) -> Column:
    """The digits of ``mask`` replaced in order."""
    return _let(digits, lambda d: _put(mask, d, lambda ch: ch.between("0", "9")))


def respace(mask: Column, text: Column) -> Column:
    """``text`` with the spaces of ``mask``."""
    return _let(text, lambda t: _put(mask, t, lambda ch: ch != " "))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", found: str | None = "n_pii") -> DataFrame:
    """``docs`` with personal data in the whole ``text`` column replaced.

    ``key`` is the caller's secret: who has it can undo the pseudonyms.
    All columns and rows stay.  ``found`` names an added column with the number
    of replaced values (an underscore is appended if taken; None: no such
    column).  A null text stays null with a null count, an empty one empty.
    """
    p = Pseudonyms(key)
    out = free("__out", docs)
    t = col(text)
    # text = pieces[0] match[0] pieces[1] ...: both come from the same pattern
    pieces, matches = F.split(t, PATTERN, -1), F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0))

    def joined(m):
        def put(new):
            whole = F.array_join(F.zip_with(pieces, F.concat(new, F.array(_lit(""))), lambda a, b: F.concat(a, b)), "")
            return F.struct(whole.alias("text"),
                            F.size(F.filter(F.zip_with(new, m, lambda a, b: a != b), lambda x: x)).alias("n"))
        return _let(F.transform(m, p.of), put)

    plain = F.struct(t.alias("text"), F.when(t.isNotNull(), F.lit(0)).alias("n"))
    x = docs.withColumn(out, F.when(t.rlike("[0-9@]"), _let(matches, joined)).otherwise(plain))
    cols = [F.col(out)["text"].alias(c) if c == text else col(c) for c in docs.columns]
    return x.select(*cols, *([F.col(out)["n"].alias(free(found, docs))] if found else []))
