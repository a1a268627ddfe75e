"""Quantisation, Z-order and variable-length integers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U16 = 65535
#: Of a quantised embedding axis: no embedding.
NO_EMBEDDING = U16


def quant_scale(lo: Column, hi: Column, most: int = U16) -> Column:
    """Step of a quantiser from lo to hi with codes 0..most; its offset is lo."""
    return F.greatest(hi - lo, F.lit(1e-9)) / most


def quant_encode(v: Column, offset: Column, scale: Column) -> Column:
    """Nearest code (ties to even), clipped to 16 bits whatever range the quantiser was fitted to."""
    return F.least(F.greatest(F.rint((v - offset) / scale), F.lit(0.0)), F.lit(float(U16))).cast("int")


def quant_decode(q: Column, offset: Column, scale: Column) -> Column:
    return offset + q * scale


#: The bits of each byte, with a zero after each.
SPREAD = [sum((b >> i & 1) << 2 * i for i in range(8)) for b in range(256)]


def spread(v: Column) -> Column:
    """The 16 bits of v with a zero after each, as a long. From a table, as shifts name v so often that the code of a stage isn't compiled."""
    part = lambda c: F.get(F.lit(SPREAD), c.bitwiseAND(F.lit(255)).cast("int")).cast("long")
    return part(v).bitwiseOR(F.shiftleft(part(F.shiftright(v, 8)), 16))


def morton(x: Column, y: Column) -> Column:
    """Bits of two 16-bit numbers in turn, x first, as a long."""
    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def product_u32(*factors: Column) -> Column:
    """Remainder of the product of whole numbers by 2^32, as a long, however large the product is."""
    m = 1 << 32
    out = factors[0].cast("long") % m
    for f in factors[1:]:
        f = f.cast("long") % m
        high, low = (f - f % 65536) / 65536, f % 65536  # steps of 48 bits at most
        out = (out * high.cast("long") % m * 65536 + out * low) % m
    return out


def varint_length(v: Column) -> Column:
    """Bytes of v (below 2^32) in unsigned LEB128."""
    n = F.lit(1)
    for bits in (7, 14, 21, 28):
        n = n + F.when(v >= (1 << bits), 1).otherwise(0)
    return n


def varint_hex(v: Column) -> Column:
    """Unsigned LEB128 of v as hex."""
    v = v.cast("long")
    byte = lambda i: F.lpad(F.hex(F.shiftright(v, 7 * i).bitwiseAND(F.lit(127).cast("long")).bitwiseOR(F.when(F.shiftright(v, 7 * (i + 1)) > 0, 128).otherwise(0).cast("long"))), 2, "0")
    return F.concat(byte(0), *[F.when(v >= (1 << (7 * i)), byte(i)).otherwise("") for i in range(1, 5)])


def varint_decode(data: Column) -> Column:
    """Numbers of a hex string of LEB128 codes, as an array."""
    start = F.expr("named_struct('out', cast(array() as array<bigint>), 'v', 0L, 's', 0)")
    bytes_ = F.transform(F.sequence(F.lit(0), F.floor(F.length(data) / 2).cast("int") - 1), lambda i: F.conv(F.substr(data, i * 2 + 1, F.lit(2)), 16, 10).cast("long"))

    def step(a, b):
        v = a["v"].bitwiseOR(F.call_function("shiftleft", b.bitwiseAND(F.lit(127).cast("long")), a["s"]))
        return F.when(b >= 128, F.struct(a["out"].alias("out"), v.alias("v"), (a["s"] + 7).alias("s"))).otherwise(F.struct(F.array_append(a["out"], v).alias("out"), F.lit(0).cast("long").alias("v"), F.lit(0).alias("s")))

    return F.when(F.length(data) > 0, F.aggregate(bytes_, start, step, lambda a: a["out"])).otherwise(F.expr("cast(array() as array<bigint>)"))


def u32_hex(v: Column) -> Column:
    """Four little-endian bytes as hex."""
    v = v.cast("long")
    return F.concat(*[F.lpad(F.hex(F.shiftright(v, 8 * i).bitwiseAND(F.lit(255).cast("long"))), 2, "0") for i in range(4)])


def u16_hex(v: Column) -> Column:
    v = v.cast("long")
    return F.concat(*[F.lpad(F.hex(F.shiftright(v, 8 * i).bitwiseAND(F.lit(255).cast("long"))), 2, "0") for i in range(2)])
