"""Column expressions for the three posting codes.

Each code has a text form of one posting, a pattern that cuts a payload into
such forms again, and the value of a form. Payloads are upper-case hex. All of it
is built-in Spark SQL, so encoding and decoding stay inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexipost.functions.numbers import whole_div

# Fixed values of the formats.
RAW_BYTES = 8  # bytes of an uncompressed id, little-endian
VB_BITS = 7  # value bits in each byte, most significant group first
VB_MORE = 128  # set in every byte of a number but its last
VB_BASE = 0  # what the first gap of a list is measured from
GAMMA_BASE = -1  # the same for gamma, so that document 0 gives gap 1
GAMMA_PAD = "1"  # fills the last byte of a gamma payload

_LONG_BITS = 63
_VB_GROUPS = _LONG_BITS // VB_BITS


def _byte_hex(value: Column) -> Column:
    return F.lpad(F.hex(value), 2, "0")


def _signed(hex_digits: Column) -> Column:
    """Up to 16 hex digits as a bigint."""
    return F.conv(hex_digits, 16, -10).cast("bigint")


def _bit_length(value: Column) -> Column:
    return F.length(F.bin(value))


# --- raw -------------------------------------------------------------------

RAW_CODE = "[0-9A-F]{16}"


def raw_code(doc_id: Column) -> Column:
    low_first = [F.shiftright(doc_id, 8 * i).bitwiseAND(255) for i in range(RAW_BYTES)]
    return F.concat(*[_byte_hex(byte) for byte in low_first])


def raw_value(code: Column) -> Column:
    high_first = [F.substring(code, 2 * i + 1, 2) for i in reversed(range(RAW_BYTES))]
    return _signed(F.concat(*high_first))


# --- variable byte ---------------------------------------------------------

VB_CODE = "(?:[89A-F][0-9A-F])*[0-7][0-9A-F]"


def vb_code(gap: Column) -> Column:
    lead = [
        F.when(
            gap >= F.lit(1 << (VB_BITS * i)),
            F.hex(F.shiftright(gap, VB_BITS * i).bitwiseAND(VB_MORE - 1).bitwiseOR(VB_MORE)),
        ).otherwise("")
        for i in reversed(range(1, _VB_GROUPS))
    ]
    return F.concat(*lead, _byte_hex(gap.bitwiseAND(VB_MORE - 1)))


def vb_value(code: Column) -> Column:
    packed = _signed(F.right(code, F.lit(16)))
    low = [
        F.shiftleft(F.shiftright(packed, 8 * i).bitwiseAND(VB_MORE - 1), VB_BITS * i)
        for i in range(8)
    ]
    value = low[0]
    for group in low[1:]:
        value = value.bitwiseOR(group)
    ninth = F.shiftleft(_signed(F.left(code, F.lit(2))).bitwiseAND(VB_MORE - 1), VB_BITS * 8)
    return F.when(F.length(code) > 16, value.bitwiseOR(ninth)).otherwise(value)


def vb_bytes(gap: Column) -> Column:
    """Bytes that ``vb_code`` takes, without encoding."""
    return whole_div(_bit_length(gap) + (VB_BITS - 1), VB_BITS)


# --- Elias gamma -----------------------------------------------------------


def _gamma_pattern() -> str:
    """A number is n ones, a zero, and n more bits; n is at most 63 here.

    The nesting mirrors the unary part, so matching never backtracks. The ones
    that pad the last byte contain no zero and match nothing.
    """
    pattern = f"0[01]{{{_LONG_BITS}}}"
    for n in reversed(range(1, _LONG_BITS)):
        pattern = f"(?:0[01]{{{n}}}|1{pattern})"
    return f"(?:0|1{pattern})"


GAMMA_CODE = _gamma_pattern()


def gamma_code(gap: Column) -> Column:
    offset = F.substr(F.bin(gap), F.lit(2))
    return F.concat(F.repeat(F.lit("1"), F.length(offset)), F.lit("0"), offset)


def gamma_value(code: Column) -> Column:
    n = whole_div(F.length(code), 2).cast("int")  # n ones, a zero, n bits
    return F.conv(F.concat(F.lit("1"), F.substr(code, n + 2)), 2, 10).cast("bigint")


def gamma_bits(gap: Column) -> Column:
    """Bits that ``gamma_code`` takes, without encoding."""
    return (F.lit(2) * _bit_length(gap) - 1).cast("bigint")


def bits_to_hex(bits: Column) -> Column:
    """Bit text to hex, the last byte filled with ones."""
    short = F.pmod(-F.length(bits), F.lit(8))
    full = F.concat(bits, F.repeat(F.lit(GAMMA_PAD), short))
    words = F.regexp_extract_all(full, F.lit("[01]{8,32}"), F.lit(0))
    return F.array_join(
        F.transform(
            words,
            lambda word: F.lpad(
                F.conv(word, 2, 16), whole_div(F.length(word), 4).cast("int"), F.lit("0")
            ),
        ),
        "",
    )


def hex_to_bits(payload: Column) -> Column:
    # Move the digits out of the way of the 0s and 1s that replace them.
    bits = F.translate(payload, "0123456789ABCDEF", "ghijklmnopqrstuv")
    for value, letter in enumerate("ghijklmnopqrstuv"):
        bits = F.replace(bits, F.lit(letter), F.lit(f"{value:04b}"))
    return bits


# --- by name ---------------------------------------------------------------

CODECS = ("raw", "vb", "gamma")


def check_codec(codec: str) -> str:
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec!r}, expected one of {CODECS}")
    return codec


def split_payload(payload: Column, codec: str, lead: Column, n_postings: Column) -> Column:
    """The ``n_postings`` code forms in a hex payload, in order.

    ``lead`` is the bit text that stands before the payload of a gamma run. What follows
    the last code, in a byte shared with the next run, is left out.
    """
    source = F.concat(lead, hex_to_bits(payload)) if codec == "gamma" else payload
    pattern = {"raw": RAW_CODE, "vb": VB_CODE, "gamma": GAMMA_CODE}[codec]
    found = F.regexp_extract_all(source, F.lit(pattern), F.lit(0))
    return F.slice(found, F.lit(1), n_postings.cast("int"))
