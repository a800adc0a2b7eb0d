"""Encodings that pages hide addresses in, and bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_AZ, _NM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "NOPQRSTUVWXYZABCDEFGHIJKLM"


def rot13(x: Column) -> Column:
    """ROT13, after ``[at]`` has become ``@``."""
    return F.translate(F.replace(x, F.lit("[at]"), F.lit("@")), _AZ + _AZ.lower(), _NM + _NM.lower())


def cloaked_email(x: Column) -> Column:
    """An address in hex whose first byte is the key that the others are XORed with; null if it isn't such hex."""
    n = F.char_length(x) / 2
    byte = lambda i: F.conv(F.substring(x, i * 2 + 1, 2), 16, 10).cast("int")
    codes = F.transform(F.sequence(F.lit(1), n.cast("int") - 1), lambda i: F.lpad(F.hex(byte(i).bitwiseXOR(byte(F.lit(0)))), 2, "0"))
    good = x.rlike("^([0-9a-fA-F]{2}){2,}$")
    return F.when(good, F.decode(F.unhex(F.array_join(codes, "")), "UTF-8"))


def cloak(x: Column, key: int) -> Column:
    """The hex form that ``cloaked_email`` reads."""
    data = F.encode(x, "UTF-8")
    hexed = F.hex(data)
    byte = lambda i: F.conv(F.substring(hexed, i * 2 + 1, 2), 16, 10).cast("int")
    codes = F.transform(F.sequence(F.lit(0), F.octet_length(x) - 1), lambda i: F.lpad(F.hex(byte(i).bitwiseXOR(F.lit(key))), 2, "0"))
    return F.lower(F.concat(F.lit(f"{key:02x}"), F.array_join(codes, "")))


def cut_bytes(x: Column, most: int) -> Column:
    """A text of at most ``most`` UTF-8 bytes, without half a character at its end."""
    return F.when(F.octet_length(x) <= most, x).otherwise(F.decode(_whole(F.substring(F.encode(x, "UTF-8"), 1, most)), "UTF-8"))


def _whole(data: Column) -> Column:
    """Bytes less an unfinished character at the end."""
    hexed = F.hex(data)
    tail = r"(?:[CDEF][0-9A-F]|E[0-9A-F][89AB][0-9A-F]|F[0-7][89AB][0-9A-F](?:[89AB][0-9A-F])?)$"
    return F.unhex(F.regexp_replace(hexed, rf"^((?:..)*?){tail}", "$1"))
