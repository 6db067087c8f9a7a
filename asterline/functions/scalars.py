"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from asterline.contracts import UNKNOWN_KEY, UNKNOWN_NAME

GENESIS = "0" * 64


def date_key(at: str) -> Column:
    """yyyymmdd as an integer, by arithmetic on the date parts."""
    return F.year(at) * 10000 + F.month(at) * 100 + F.dayofmonth(at)


def known_key(column: str) -> Column:
    """A dimension key, or the Unknown member's."""
    return F.coalesce(F.col(column), F.lit(UNKNOWN_KEY).cast("long"))


def known_name(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(UNKNOWN_NAME))


def line_revenue(quantity: str = "quantity", price: str = "unit_price") -> Column:
    return F.col(quantity) * F.col(price)


def nonblank(column: str) -> Column:
    return F.coalesce(F.length(F.trim(column)) > 0, F.lit(False))


def line_number(text: Column, position: Column) -> Column:
    """The line, from one, on which the character at `position` (from one) stands."""
    before = F.substring(text, F.lit(1), position - 1)
    return F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1


def canonical_json(**columns: Column) -> Column:
    """Compact JSON with the names in order and nulls kept."""
    ordered = [columns[name].alias(name) for name in sorted(columns)]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def canonical_object(text: str | Column) -> Column:
    """Compact JSON of any JSON text, with the names in order at every depth; null for text that is none, or that names a key twice.

    Arrays keep their order. A number is written by its value: 1.50 and 1.5 are one number.
    """
    return F.to_json(F.try_parse_json(F.col(text) if isinstance(text, str) else text))


def json_text(column: str) -> Column:
    """One string as a JSON string literal, quotes included."""
    wrapped = F.to_json(F.struct(F.coalesce(F.col(column), F.lit("")).alias("s")))
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def entry_prefix(machine: str, payload: str) -> Column:
    """The hashed text of a ledger entry up to the previous hash."""
    return F.concat(
        F.lit('{"machine":'), json_text(machine),
        F.lit(',"payload":'), F.col(payload),
        F.lit(',"previous_hash":"'),
    )


def entry_suffix(sequence: str) -> Column:
    return F.concat(F.lit('","sequence":'), F.col(sequence).cast("string"), F.lit("}"))


def entry_hash(machine: str, payload: str, previous: Column, sequence: str) -> Column:
    return F.sha2(
        F.concat(entry_prefix(machine, payload), previous, entry_suffix(sequence)), 256
    )


def luhn_valid(digits: Column) -> Column:
    """The Luhn checksum over a string of digits."""
    reverse = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    total = F.aggregate(
        F.transform(
            reverse,
            lambda d, i: F.when(i % 2 == 0, d).otherwise(
                d * 2 - F.when(d > 4, F.lit(9)).otherwise(F.lit(0))
            ),
        ),
        F.lit(0),
        lambda acc, d: acc + d,
    )
    return total % 10 == 0


def iban_valid(code: Column) -> Column:
    """The mod-97 check: country and check digits moved to the end, letters as 10..35."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))
    remainder = F.aggregate(
        F.split(moved, ""),
        F.lit(0).cast("long"),
        lambda acc, c: F.when(
            F.ascii(c) >= 65, (acc * 100 + F.ascii(c) - 55) % 97
        ).otherwise((acc * 10 + F.ascii(c) - 48) % 97),
    )
    return remainder == 1


BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def base58_valid(address: Column) -> Column:
    """Whether a text of base58 digits is 21 bytes followed by the first four of their double SHA-256.

    The number is kept in five parts of 40 bits, low ones first; what does not fit in them is too long.
    """
    parts, low = 5, (1 << 40) - 1
    nothing = F.array(*[F.lit(0).cast("long")] * (parts + 1))

    def digit(number: Column, char: Column) -> Column:
        carry, out = F.instr(F.lit(BASE58), char).cast("long") - 1, []
        for i in range(parts):
            wide = number[i] * 58 + carry
            out.append(wide.bitwiseAND(F.lit(low)))
            carry = F.shiftright(wide, 40)
        return F.array(*out, F.greatest(number[parts], carry))

    def checked(number: Column) -> Column:
        text = F.concat(*[F.lpad(F.hex(number[i]), 10, "0") for i in reversed(range(parts))])
        ones = F.length(F.regexp_extract(address, "^(1*)", 1))
        zeros = F.length(F.regexp_extract(text, "^((?:00)*)", 1)) / 2
        digest = F.sha2(F.unhex(F.sha2(F.unhex(F.substring(text, 1, 42)), 256)), 256)
        return (number[parts] == 0) & (ones == zeros) & (F.substring(digest, 1, 8) == F.lower(F.substring(text, 43, 8)))

    # One element, so that the number is computed once.
    number = F.aggregate(F.split(address, ""), nothing, digit)
    return F.transform(F.array(number), checked)[0]


def medical_license_valid(code: Column) -> Column:
    """The registration checksum: (d1+d3+d5) + 2*(d2+d4+d6) ends in d7."""
    digit = lambda i: F.substring(code, 2 + i, 1).cast("int")
    total = digit(1) + digit(3) + digit(5) + 2 * (digit(2) + digit(4) + digit(6))
    return total % 10 == digit(7)


def ssn_plausible(code: Column) -> Column:
    """Number ranges that are never issued are not findings."""
    area, group, serial = F.substring(code, 1, 3), F.substring(code, 5, 2), F.substring(code, 8, 4)
    issued = ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")
    return issued
