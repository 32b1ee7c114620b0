"""coinloom: analytics over UTXO-style ledgers as plain PySpark DataFrame operators."""
