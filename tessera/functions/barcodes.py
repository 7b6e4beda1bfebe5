"""Barcodes and colours: column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The bases in the order of their numbers 0 to 3.
BASES = "ACGT"


def number(base: Column) -> Column:
    """0 to 3 for a base, -1 for anything else."""
    return (F.array_position(F.array(*[F.lit(b) for b in BASES]), base) - 1).cast("int")


def encode_bases(seq: Column) -> Column:
    """The colours 1 to 4 of neighbouring bases: one more than the exclusive or of their numbers. Fewer than two
    bases have no colour."""
    chars = F.split(seq, "")
    pair = lambda i: (number(F.get(chars, i)).bitwiseXOR(number(F.get(chars, i + 1))) + 1).cast("string")
    places = F.sequence(F.lit(0), F.char_length(seq) - 2)
    return F.when(F.char_length(seq) >= 2, F.array_join(F.transform(places, pair), "")).otherwise(F.when(seq.isNotNull(), F.lit("")))


def decode_colors(colors: Column, start: str) -> Column:
    """The bases that begin with `start` and have these colours; null where a colour isn't one of 1 to 4."""
    first = F.struct(F.lit(BASES.index(start)).alias("k"), F.lit(start).alias("out"))

    def step(a: Column, c: Column) -> Column:
        k = a["k"].bitwiseXOR(c.cast("int") - 1)
        return F.struct(k.alias("k"), F.concat(a["out"], F.substring(F.lit(BASES), k + 1, F.lit(1))).alias("out"))

    return F.when(colors.rlike("^[1-4]*$"), F.aggregate(F.filter(F.split(colors, ""), lambda c: c != ""), first, step)["out"])


def split_rotate(colors: Column, at: int) -> Column:
    """Drops the colour at a place (from 1) and swaps what lies before and after it."""
    left, right = F.substring(colors, 1, at - 1), F.substring(colors, at + 1, 1 << 20)
    return F.concat(right, left)


def segments(colors: Column, cuts: list[int]) -> Column:
    """Segments of a colour string at the cuts (places from 1). The first cut gives the part before it and all from it on;
    a later one gives what lies between the place after the cut before it and itself, and all from itself on."""
    tail = lambda a: F.substring(colors, a, 1 << 20)
    out = [F.substring(colors, 1, cuts[0] - 1), tail(cuts[0])]
    for k in range(1, len(cuts)):
        out.append(F.substring(colors, cuts[k - 1] + 1, cuts[k] - cuts[k - 1] - 1))
        out.append(tail(cuts[k] + (1 if k > 1 else 0)))
    return F.array(*out)


def call_color(values: Column) -> Column:
    """struct(color, score) of one value for each channel: the channel (from 1) of the largest value of the vector scaled to
    unit length, and minus its logarithm; ties are called M, and values of which one is no number N, with an infinite score."""
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, v: a + v * v)) + 1e-6
    top = F.array_max(values)
    single = F.size(F.filter(values, lambda v: v == top)) == 1
    none = F.exists(values, lambda v: v.isNull() | F.isnan(v))
    color = F.when(none, "N").when(single, F.array_position(values, top).cast("string")).otherwise("M")
    return F.struct(color.alias("color"), F.when(single & ~none, -F.log(top / norm)).otherwise(F.lit(float("inf"))).alias("score"))


def fov_name(number: Column) -> Column:
    return F.format_string("Position%03d", number)


def fov_number(name: Column) -> Column:
    return F.regexp_extract(name, "(\\d+)", 1).cast("int")


def natural_key(name: Column) -> Column:
    """A key whose order is that of people: runs of digits by their number, other runs as text."""
    chunks = F.regexp_extract_all(name, F.lit("(\\d+|\\D+)"), F.lit(1))
    return F.array_join(F.transform(chunks, lambda c: F.when(c.rlike("^\\d"), F.lpad(F.regexp_replace(c, "^0+(?=.)", ""), 20, "0")).otherwise(F.lower(c))), "\u0001")
