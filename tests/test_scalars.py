import pytest
from coinloom.functions import scalars as S
from coinloom.functions.pubkeys import with_pubkey_addresses
from pyspark.sql import functions as F

GENESIS = "04678afdb0fe5548271967f1a67130b7105cd6a828e03909a67962e0ea1f61deb649f6bc3f4cef38c4f35504e51ec112de5c384df7ba0b8d578a4c702b6bf11d5f"


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_to_sats(spark):
    values = ["50.0", "0.00000001", "0", "-1", "20.99999999", "1e-8", "NaN", "true", None, ""]
    assert column(spark, values, S.to_sats) == [5_000_000_000, 1, 0, 0, 2_099_999_999, 1, None, None, None, None]


def test_txid(spark):
    values = ["a" * 64, "a" * 63, None, "g" * 64, "A" * 64, "a" * 64 + "\n"]
    assert column(spark, values, S.is_txid) == [True, False, False, False, True, False]


def test_address_type(spark):
    assert column(spark, ["1x", "3x", "bc1qx", "bc1px", "zz", "", None], S.address_type) == [
        "p2pkh", "p2sh", "bech32", "taproot", "unknown", None, None,
    ]


def test_normalised_type(spark):
    rows = [("pubkeyhash", "zz"), ("witness_v0_scripthash", None), (None, "3x"), ("other", None)]
    df = spark.createDataFrame(rows, "s string, a string")
    got = [r[0] for r in df.select(S.normalised_type(F.col("s"), F.col("a"))).collect()]
    assert got == ["p2pkh", "bech32", "p2sh", "unknown"]


def test_rounding_and_levels(spark):
    assert column(spark, [2.5, -2.5, 2.4], S.rounded_long, "double") == [3, -3, 2]
    assert column(spark, [0, 1, 3, 20], S.hop_confidence, "int") == [1.0, 0.8, 0.512, 0.15]
    assert column(spark, ["sanctioned", "mixer", "exchange", None], S.category_rank) == [0, 1, 2, 3]
    assert column(spark, ["p2pkh", "p2pk", "unknown"], S.type_rank) == [1, 6, 5]


def test_pubkey_of_script(spark):
    script = "41" + GENESIS + "ac"
    assert column(spark, [script, script.upper(), "21" + "02" * 33 + "ac", "76a914" + "00" * 20 + "88ac", None], S.pubkey_of_script) == [
        GENESIS, GENESIS, "02" * 33, None, None,
    ]


@pytest.mark.parametrize(
    "key, address", [(GENESIS, "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa"), ("zz", None), ("", None), ("05" + "00" * 64, None), (None, None)]
)
def test_pubkey_address(spark, key, address):
    df = spark.createDataFrame([(1, key)], "i int, k string")
    assert with_pubkey_addresses(df, "k", "a").first()["a"] == address
