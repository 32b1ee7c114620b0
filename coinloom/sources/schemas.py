"""Declared layouts of every table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, L, I, TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType()  # noqa: E741

BLOCK_STATUS = _struct(
    ("height", I), ("features", S), ("vout_status", S), ("vin_status", S), ("address_status", S), ("updated_at", TS)
)
PHASES = _struct(("height", I), ("features", S), ("vout_status", S), ("vin_status", S))
BLOCKS = _struct(("height", I), ("block_hash", S), ("block_time", TS))
TRANSACTIONS = _struct(
    ("txid", S), ("block_hash", S), ("height", I), ("received_time", TS), ("total_in", L), ("total_out", L)
)
TX_IO = _struct(("txid", S), ("address", S), ("address_type", S), ("amount", L), ("io_type", S), ("idx", I))
SPENDS = _struct(
    ("prev_txid", S), ("prev_vout", I), ("spending_txid", S), ("spending_vin", I),
    ("spent_height", I), ("spent_block", S), ("spent_time", TS),
)
WATCH = _struct(
    ("address", S), ("address_type", S), ("label", S), ("tags", T.ArrayType(S)), ("first_seen", TS), ("last_seen", TS),
    ("tx_count", L), ("utxo_count", L), ("balance_sats", L), ("last_scanned_height", I), ("last_scanned_time", TS),
    ("last_scanned_txid", S),
)
ENTITY_TAGS = _struct(
    ("address", S), ("source", S), ("entity_name", S), ("category", S), ("confidence", T.DoubleType()), ("reference", S)
)
PRICES = _struct(("ts", TS), ("currency", S), ("price", T.DecimalType(18, 8)), ("source", S))

SCRIPT = _struct(("type", S), ("hex", S), ("asm", S), ("address", S), ("addresses", T.ArrayType(S)))
PREVOUT = _struct(("value", S), ("scriptPubKey", SCRIPT))
VIN = _struct(("coinbase", S), ("txid", S), ("vout", I), ("sequence", L), ("prevout", PREVOUT))
# Values are read as strings, so that no literal passes through a double.
VOUT = _struct(("value", S), ("n", I), ("scriptPubKey", SCRIPT))
BLOCK_TX = _struct(("txid", S), ("version", I), ("locktime", L), ("vin", T.ArrayType(VIN)), ("vout", T.ArrayType(VOUT)))
BLOCK = _struct(("hash", S), ("height", I), ("time", L), ("tx", T.ArrayType(BLOCK_TX)))

KEYS = {
    "block_status": [["height"]],
    "blocks": [["height"], ["block_hash"]],
    "transactions": [["txid"]],
    "tx_io": [["txid", "io_type", "idx"]],
    "spends": [["prev_txid", "prev_vout"], ["spending_txid", "spending_vin"]],
    "entity_tags": [["address", "source"]],
}
CLUSTER_BY = {"tx_io": ["io_type"], "spends": [], "transactions": []}
# Declaration order of the address types: the greatest of several is the last one here.
TYPE_ORDER = ["p2pkh", "p2sh", "bech32", "taproot", "unknown", "p2pk"]
# The categories that a tag added by hand may have.
CATEGORIES = ["exchange", "mixer", "gambling", "sanctioned", "mining", "service", "darknet", "scam", "other"]
