"""Coverage and health of a ledger: statuses, gaps, probes, constraints, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PHASES = ["vout", "vin", "address"]
TERMINAL = ["done", "skipped", "failed"]
FEATURES = ["both", "vin", "vout", "op_return_only", "coinbase_only", "none"]


def status_summary(status: DataFrame) -> DataFrame:
    return status.agg(F.count("*").alias("total"), F.min("height").alias("min_height"), F.max("height").alias("max_height"))


def status_histogram(status: DataFrame) -> DataFrame:
    """`phase, status, n`, most frequent first within a phase."""
    each = F.explode(F.array(*(F.struct(F.lit(p).alias("phase"), F.col(f"{p}_status").alias("status")) for p in PHASES)))
    return status.select(each.alias("x")).groupBy("x.phase", "x.status").agg(F.count("*").alias("n")).orderBy("phase", F.desc("n"), "status")


def feature_histogram(status: DataFrame) -> DataFrame:
    return status.groupBy("features").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "features")


READY = {
    "vout": "true",
    "vin": "vout_status in ('done', 'skipped')",
    "address": "vout_status in ('done', 'skipped') and vin_status = 'done'",
}


def phase_progress(status: DataFrame, phase: str) -> DataFrame:
    """done, in_progress, pending, skipped_failed, latest_done of a phase, over heights that are ready for it."""
    s = F.col(f"{phase}_status")
    ready = status.filter(READY[phase])
    return ready.agg(
        F.count_if(s == "done").alias("done"),
        F.count_if(s == "in_progress").alias("in_progress"),
        F.count_if(s == "pending").alias("pending"),
        F.count_if(s.isin("skipped", "failed")).alias("skipped_failed"),
        F.coalesce(F.max(F.when(s.isin("done", "skipped"), F.col("height"))), F.lit(0)).alias("latest_done"),
    )


def next_heights(status: DataFrame, phase: str, n: int) -> DataFrame:
    """The n lowest pending heights that are ready for a phase."""
    return status.filter(READY[phase]).filter(F.col(f"{phase}_status") == "pending").select("height").orderBy("height").limit(n)


def select_for_reprocess(
    status: DataFrame, phase: str, low: int | None = None, high: int | None = None,
    skipped: bool = False, failed: bool = False, features: list[str] | None = None,
) -> DataFrame:
    """`status` with the phase set back to pending where the selection holds.

    Heights in the range (if given) that are skipped, failed or of the features, as asked; with a
    range alone, every finished height in it. Nothing selected, or an unknown feature, is refused.
    """
    if set(features or ()) - set(FEATURES):
        raise ValueError(f"unknown features {sorted(set(features) - set(FEATURES))}")
    if low is None and high is None and not (skipped or failed or features):
        raise ValueError("nothing selected")
    column = F.col(f"{phase}_status")
    kinds = F.lit(False)
    if skipped:
        kinds = kinds | (column == "skipped")
    if failed:
        kinds = kinds | (column == "failed")
    if features:
        kinds = kinds | F.col("features").isin(features)
    hit = kinds if skipped or failed or features else column.isin(TERMINAL)
    if low is not None:
        hit = hit & (F.col("height") >= low)
    if high is not None:
        hit = hit & (F.col("height") <= high)
    return status.withColumn(f"{phase}_status", F.when(F.coalesce(hit, F.lit(False)), "pending").otherwise(column))


def stale(status: DataFrame, now: str, minutes: int = 15) -> DataFrame:
    """Heights in progress that were not touched for so long before `now`."""
    limit = F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    busy = F.lit(False)
    for p in PHASES:
        busy = busy | (F.col(f"{p}_status") == "in_progress")
    return status.filter(busy & (F.col("updated_at") < limit))


def missing_heights(status: DataFrame, tip: int) -> DataFrame:
    """Heights from 0 to the tip that have no row."""
    spark = status.sparkSession
    whole = spark.range(tip + 1).select(F.col("id").cast("int").alias("height"))
    return whole.join(status.select("height"), "height", "left_anti")


def top_up(status: DataFrame, tip: int) -> DataFrame:
    """`status` with a pending row for each height after its greatest, up to the tip."""
    spark = status.sparkSession
    most = status.agg(F.coalesce(F.max("height"), F.lit(-1))).first()[0]
    new = (
        spark.range(most + 1, max(tip, most) + 1).select(F.col("id").cast("int").alias("height"))
        .select(
            "height", F.lit(None).cast("string").alias("features"), *(F.lit("pending").alias(f"{p}_status") for p in PHASES),
            F.lit(None).cast("timestamp").alias("updated_at"),
        )
    )
    return status.unionByName(new)


def pubkey_coverage(status: DataFrame, early: int = 260_000) -> DataFrame:
    """Blocks that may lack outputs to raw public keys."""
    return status.agg(
        F.count_if(F.col("features").isin("op_return_only", "none", "vin")).alias("suspect"),
        F.count_if(F.col("vout_status").isin("skipped", "failed")).alias("skipped_failed"),
        F.count_if((F.col("height") < early) & F.col("features").isin("both", "vout")).alias("early_done"),
    )


def has_type(io: DataFrame, kind: str = "p2pk") -> DataFrame:
    """`kind, present`: whether any row has the type; the first one found ends the search."""
    one = io.filter(F.col("address_type") == kind).select(F.lit(1)).limit(1)
    return one.agg((F.count("*") > 0).alias("present")).select(F.lit(kind).alias("kind"), "present")


def known_addresses(io: DataFrame, addresses: DataFrame) -> DataFrame:
    """Outputs and their sum for each address asked for; 0 where there are none."""
    outs = io.filter("io_type = 'out'").join(addresses, "address", "left_semi")
    sums = outs.groupBy("address").agg(F.count("*").alias("n_outputs"), F.sum("amount").alias("sats"))
    return addresses.join(sums, "address", "left").fillna(0, ["n_outputs", "sats"])


def block_counts(status: DataFrame, tx: DataFrame, io: DataFrame) -> DataFrame:
    """Rows of each block: transactions, outputs, inputs, with its status."""
    per_tx = io.groupBy("txid").agg(
        F.count_if(F.col("io_type") == "out").alias("outs"), F.count_if(F.col("io_type") == "in").alias("ins")
    )
    per_block = (
        tx.select("txid", "height").join(per_tx, "txid", "left").groupBy("height")
        .agg(F.count("*").alias("n_tx"), F.coalesce(F.sum("outs"), F.lit(0)).alias("n_out"), F.coalesce(F.sum("ins"), F.lit(0)).alias("n_in"))
    )
    return status.select("height", "features", "vout_status").join(per_block, "height", "left").fillna(0, ["n_tx", "n_out", "n_in"])


def sample_done(status: DataFrame, n: int = 5, seed: str = "s") -> DataFrame:
    """n finished heights, by a seeded hash."""
    done = status.filter("vout_status = 'done'").select("height")
    return done.orderBy(F.sha2(F.concat(F.lit(seed), F.col("height").cast("string")), 256)).limit(n)


def spends_at(heights: DataFrame, spends: DataFrame) -> DataFrame:
    counts = spends.groupBy(F.col("spent_height").alias("height")).agg(F.count("*").alias("n_spends"))
    return heights.join(counts, "height", "left").fillna(0, ["n_spends"])


def watch_stats(watch: DataFrame, year: int = 2011) -> DataFrame:
    return watch.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("balance_sats") > 0).alias("funded"),
        F.count_if(F.col("first_seen") < F.lit(f"{year}-01-01").cast("timestamp")).alias("early"),
    )


def tip_lag(status: DataFrame, tip: int) -> DataFrame:
    return status.agg((F.lit(tip) - F.max("height")).alias("lag"))


def missing_inputs(tx: DataFrame, io: DataFrame, spends: DataFrame) -> DataFrame:
    """Per height: transactions without an input row, and spend edges."""
    has = io.filter("io_type = 'in'").select("txid").distinct()
    bare = tx.join(has, "txid", "left_anti").groupBy("height").agg(F.count("*").alias("tx_without_inputs"))
    edges = spends.groupBy(F.col("spent_height").alias("height")).agg(F.count("*").alias("spend_edges"))
    return bare.join(edges, "height", "full").fillna(0, ["tx_without_inputs", "spend_edges"])


def duplicate_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    return table.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def constraint_report(tables: dict[str, DataFrame], keys: dict[str, list[list[str]]]) -> DataFrame:
    """`table, rule, violations` for unique keys, counters that must not be negative, and block references."""
    out = []

    def add(name: str, rule: str, rows: DataFrame) -> None:
        out.append(rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("table"), F.lit(rule).alias("rule"), "violations"))

    for name, table in tables.items():
        for key in keys.get(name, []):
            add(name, f"unique({','.join(key)})", duplicate_keys(table, key))
    if "watch" in tables:
        add("watch", "not_negative", tables["watch"].filter("tx_count < 0 or utxo_count < 0 or balance_sats < 0"))
    if "transactions" in tables and "blocks" in tables:
        add("transactions", "block_exists", tables["transactions"].join(tables["blocks"].select("block_hash"), "block_hash", "left_anti"))
    whole = out[0]
    for x in out[1:]:
        whole = whole.unionByName(x)
    return whole


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """`table, n_rows, checksum, min_height, max_height`: one aggregate per table, independent of row order."""
    out = None
    for name, table in tables.items():
        height = F.col("height") if "height" in table.columns else F.lit(None).cast("int")
        row = table.agg(
            F.count("*").alias("n_rows"),
            F.coalesce(F.sum(F.xxhash64(*table.columns).cast(T.DecimalType(38, 0))), F.lit(0).cast(T.DecimalType(38, 0))).cast("string").alias("checksum"),
            F.min(height).alias("min_height"),
            F.max(height).alias("max_height"),
        ).select(F.lit(name).alias("table"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def verify_manifest(stored: DataFrame, found: DataFrame) -> DataFrame:
    """`table, verdict`: ok, size mismatch, checksum mismatch or missing."""
    a, b = stored.select("table", F.col("n_rows").alias("n"), F.col("checksum").alias("c")), found.select("table", "n_rows", "checksum")
    verdict = (
        F.when(F.col("n_rows").isNull(), "missing")
        .when(F.col("n").isNull(), "unexpected")
        .when(F.col("n") != F.col("n_rows"), "size mismatch")
        .when(F.col("c") != F.col("checksum"), "checksum mismatch")
        .otherwise("ok")
    )
    return a.join(b, "table", "full").select("table", verdict.alias("verdict"))


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """`path, length, sha256` of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


FANOUT_BITS = 4


def hash_tree(rows: DataFrame, keys: list[str], depth: int = 2) -> DataFrame:
    """`level, node, n_rows, checksum`: sums over ranges of the keys' hashes, 16 ranges in each one above.

    Level 0 is the whole table, level `depth` has 16 ** depth leaves. Sums do not depend on order, and
    a node's are those of the nodes below it, so the table is read once and combined on the map side.
    """
    at = F.call_function("shiftrightunsigned", F.xxhash64(*keys), F.lit(64 - FANOUT_BITS * depth))
    columns = [F.col(c) for c in sorted(rows.columns)]
    leaves = rows.groupBy(at.cast("bigint").alias("leaf")).agg(
        F.count("*").alias("n_rows"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("checksum")
    )
    up = [F.struct(F.lit(k).alias("level"), F.call_function("shiftright", F.col("leaf"), F.lit(FANOUT_BITS * (depth - k))).alias("node")) for k in range(depth + 1)]
    return leaves.select(F.explode(F.array(*up)).alias("at"), "n_rows", "checksum").groupBy("at.level", "at.node").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("checksum").alias("checksum")
    )


def differing_leaves(one: DataFrame, other: DataFrame, depth: int = 2) -> list[int]:
    """Leaves in which two trees of `hash_tree` differ, looking only below nodes that differ."""
    gap = one.alias("a").join(other.alias("b"), ["level", "node"], "full").filter(
        ~(F.col("a.n_rows").eqNullSafe(F.col("b.n_rows")) & F.col("a.checksum").eqNullSafe(F.col("b.checksum")))
    )
    apart = gap.select("level", "node").persist()
    try:
        found = {0} if not apart.filter("level = 0").isEmpty() else set()
        for level in range(1, depth + 1):
            if not found:
                break
            above = F.call_function("shiftright", F.col("node"), F.lit(FANOUT_BITS))
            found = {r.node for r in apart.filter((F.col("level") == level) & above.isin(sorted(found))).collect()}
        return sorted(found)
    finally:
        apart.unpersist()


def differing_rows(one: DataFrame, other: DataFrame, keys: list[str], depth: int = 2) -> DataFrame:
    """Keys of rows that differ between two tables, and `what`: `changed`, `missing` (from the other) or `added`.

    Trees say where; only rows of those ranges are compared. Keys are unique in each table.
    """
    leaves = differing_leaves(hash_tree(one, keys, depth), hash_tree(other, keys, depth), depth)
    at = F.call_function("shiftrightunsigned", F.xxhash64(*keys), F.lit(64 - FANOUT_BITS * depth)).cast("bigint")
    columns = [F.col(c) for c in sorted(one.columns)]
    side = lambda rows, name: rows.filter(at.isin(leaves) if leaves else F.lit(False)).select(*keys, F.xxhash64(*columns).alias(name))
    both = side(one, "_a").join(side(other, "_b"), keys, "full").filter(~F.col("_a").eqNullSafe(F.col("_b")))
    what = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "added").otherwise("changed")
    return both.select(*keys, what.alias("what"))
