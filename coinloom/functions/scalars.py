"""Column functions over amounts, addresses and levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coinloom.sources.schemas import TYPE_ORDER

SATS = 100_000_000


def to_sats(value: Column) -> Column:
    """Coins (a decimal literal as a string) to satoshis: floor, negative to 0; null if it is no finite number."""
    exact = value.try_cast("decimal(28,18)")
    sats = F.floor(exact * F.lit(SATS).cast("decimal(9,0)")).cast("long")
    return F.when(exact.isNotNull(), F.greatest(F.lit(0).cast("long"), sats))


def to_coins(sats: Column) -> Column:
    return sats / F.lit(float(SATS))


def rounded_long(value: Column) -> Column:
    """To a long, halves away from zero."""
    return F.round(value, 0).cast("long")


def is_txid(txid: Column) -> Column:
    return F.coalesce(txid.rlike(r"\A[0-9a-fA-F]{64}\z"), F.lit(False))


def packed(text: Column) -> Column:
    """An id of 64 small hex digits as its 32 bytes; any other text as its own bytes after 33 zero bytes."""
    return F.when(text.rlike(r"\A[0-9a-f]{64}\z"), F.unhex(text)).otherwise(F.concat(F.lit(bytearray(33)), text.cast("binary")))


def unpacked(code: Column) -> Column:
    """The text that `packed` was given."""
    return F.when(F.length(code) == 32, F.lower(F.hex(code))).otherwise(F.substring(code, 34, 2**31 - 1).cast("string"))


def address_type(address: Column) -> Column:
    """Type by prefix; null for null or empty."""
    return (
        F.when(address.isNull() | (address == ""), F.lit(None).cast("string"))
        .when(address.startswith("1"), "p2pkh")
        .when(address.startswith("3"), "p2sh")
        .when(address.startswith("bc1p"), "taproot")
        .when(address.startswith("bc1q"), "bech32")
        .otherwise("unknown")
    )


def normalised_type(script_type: Column, address: Column) -> Column:
    """Type by script where it is known, else by prefix, else `unknown`."""
    # Script types of the node and the address types they mean.
    return (
        F.when(script_type == "pubkeyhash", "p2pkh")
        .when(script_type == "scripthash", "p2sh")
        .when(script_type.isin("witness_v0_keyhash", "witness_v0_scripthash"), "bech32")
        .when(script_type == "witness_v1_taproot", "taproot")
        .otherwise(F.coalesce(address_type(address), F.lit("unknown")))
    )


def type_rank(kind: Column) -> Column:
    """Place of a type in the order of declaration."""
    return F.array_position(F.array(*(F.lit(x) for x in TYPE_ORDER)), kind)


def hop_confidence(depth: Column) -> Column:
    """0.8 to the power of the depth, 0.15 at least, 3 places."""
    return F.round(F.greatest(F.lit(0.15), F.pow(F.lit(0.8), depth.cast("double"))), 3)


def attribution(single_input: Column) -> Column:
    return F.when(single_input, "direct").otherwise("co-mingled")


def category_rank(category: Column) -> Column:
    """0 for the category that goes first among several tags."""
    return F.when(category == "sanctioned", 0).when(category == "mixer", 1).when(category == "exchange", 2).otherwise(3)


def risk_rank(category: Column) -> Column:
    return F.when(category == "sanctioned", 3).when(category == "mixer", 2).when(category == "exchange", 1).otherwise(0)


def risk_name(rank: Column) -> Column:
    return F.when(rank == 3, "HIGH").when(rank == 2, "MED").when(rank == 1, "LOW")


def signed_level(depth: Column, side: Column) -> Column:
    return F.when(depth == 0, 0).when(side == "in", -depth).otherwise(depth)


def pubkey_of_script(script: Column) -> Column:
    """The key of a pay-to-pubkey script: a push of 65 or 33 bytes, then the check operation."""
    long = (F.length(script) == 134) & F.lower(script).startswith("41") & F.lower(script).endswith("ac")
    short = (F.length(script) == 70) & F.lower(script).startswith("21") & F.lower(script).endswith("ac")
    return F.when(long | short, F.lower(F.substr(script, F.lit(3), F.length(script) - 4)))
