"""Operator 3: documents that hold passages of a benchmark, on built-in functions alone.

Benchmark items are cut into windows of ten words (an item of fewer words is one window). Their hashes fill a bit table of
bounded size that goes with the plan; each window of each document is hashed and looked up in it, and only what passes is
written out as text and joined with the windows' text itself, so a hash alone never makes a hit. The windows are broadcast
while they have at most ``BROADCAST_BYTES``; beyond that the same join is shuffled, and Spark splits what a common passage
brings to one task, as rows of documents are its left side.

The bit table has 64 bits for each window up to a million windows, and then 2^26 bits in all: with m million windows about
(1 - exp(-3m/67))^3 of a document's windows pass it, 0.2 % at three million and 5 % at ten. What passes costs its text in the
join; results stay the same.

Defined results: a null text has no words and no hits; benchmark rows without an id, text or words are passed over, and
repeated ones count once; repeated documents are judged each; empty tables give no rows or no hits; other columns are
ignored. Whole texts are scanned, and nothing of a text is shuffled but the windows that pass the bit table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.native import let, words
from tidemill.llm.tables import checkpointed, free_name, read_table, texts

WINDOW = 10
#: The bit table has about 64 bits for each window of the benchmark, between these powers of two. A fuller table lets more pass.
LEAST_BITS, MOST_BITS = 16, 26
PROBES = 3
#: Bound of the windows' text and item ids that are broadcast, and of the rows (an id and a hash) of contaminated documents.
BROADCAST_BYTES, BROADCAST_ROWS = 64 << 20, 1_000_000


def _window_hash(hashes: Column, start: Column, size: int) -> Column:
    """Of the words' hashes from ``start`` (from 1)."""
    return F.xxhash64(F.slice(hashes, start, size))


def _places(h: Column, bits: int) -> list[Column]:
    """The places of a hash in the bit table."""
    return [F.shiftrightunsigned(h, k * 19).bitwiseAND(F.lit((1 << bits) - 1)) for k in range(PROBES)]


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``size`` (words), ``window`` (its words, joined), ``hash`` and ``item_ids`` of each different window."""
    items = benchmark.where("item_id IS NOT NULL").select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = items.select("item_id", "words", F.least(F.size("words"), F.lit(window)).alias("size"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("start")
    at = items.select("item_id", "words", "hashes", "size", starts)
    cut = at.select("item_id", "size", F.array_join(F.slice("words", F.col("start"), F.col("size")), " ").alias("window"), F.xxhash64(F.slice("hashes", F.col("start"), F.col("size"))).alias("hash"))
    return cut.groupBy("size", "window", "hash").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))


def _bit_table(windows: DataFrame) -> tuple[int, str, list[int], int]:
    """Bits (as a power of two), the table's 64-bit numbers as text, the windows' sizes, and how many bytes the windows have.
    What reaches the driver is bounded: the table itself and at most as many sizes as a window has words."""
    held = F.octet_length("window").cast("long") + F.octet_length(F.array_join("item_ids", ","))
    n, size = windows.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * n).bit_length()))
    placed = windows.select(F.explode(F.array(*_places(F.col("hash"), bits))).alias("at"))
    slots = placed.groupBy(F.shiftright("at", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, int(at & 63))")).alias("bits"))
    table = [0] * (1 << (bits - 6))
    for row in slots.collect():
        table[row["slot"]] = row["bits"]
    return bits, ",".join(map(str, table)), sorted(r["size"] for r in windows.select("size").distinct().collect()), size


def _passing(hashes: Column, plain: Column, size: int, bits: int, table: Column) -> Column:
    """(start, size, window) of a text's windows of one size that the bit table lets pass."""

    def probe(h: Column) -> Column:
        def is_set(at: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
            return F.get(table, F.shiftright(at, 6).cast("int")).bitwiseAND(bit) != 0

        first, second, third = map(is_set, _places(h, bits))
        return first & second & third

    def among(hs: Column, ws: Column) -> Column:
        starts = F.when(F.size(ws) >= size, F.sequence(F.lit(1), F.size(ws) - size + 1)).otherwise(F.array().cast("array<int>"))
        passing = F.filter(starts, lambda s: let(_window_hash(hs, s, size), probe))
        return F.transform(passing, lambda s: F.struct((s - 1).cast("long").alias("start"), F.lit(size).alias("size"), F.array_join(F.slice(ws, s, size), " ").alias("window")))

    # Bound once for the row: what an inner function names would else be computed again for each window.
    return let(hashes, lambda hs: let(plain, lambda ws: among(hs, ws)))


def _covered(spans: Column) -> Column:
    """How many places the spans (start, end) cover together."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def widen(st: Column, s: Column) -> Column:
        new = F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(s["start"], st["end"]))
        return F.struct((st["n"] + new).alias("n"), F.greatest(st["end"], s["end"]).alias("end"))

    return F.aggregate(F.array_sort(spans), start, widen, lambda st: st["n"])


def hits(docs: DataFrame, benchmark: DataFrame, *keys: str) -> DataFrame:
    """For each row of ``docs``: ``keys``, ``n_words``, ``spans`` (start, end in words, of every hit window) and ``item_ids``."""
    windows = checkpointed(benchmark_windows(benchmark))
    bits, text, sizes, size_in_bytes = _bit_table(windows)
    table = F.split(F.lit(text), ",").cast("array<bigint>")
    plain = docs.select(F.monotonically_increasing_id().alias("_row"), *keys, words(F.col("text")).alias("_words"))
    hashed = plain.select("_row", *keys, "_words", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    found = [_passing(F.col("_hashes"), F.col("_words"), size, bits, table) for size in sizes]
    none = F.array().cast("array<struct<start:bigint,size:int,window:string>>")
    passed = hashed.select("_row", *keys, F.size("_words").cast("long").alias("n_words"), F.concat(none, *found).alias("_found"))
    one = passed.select("_row", *keys, "n_words", F.explode_outer("_found").alias("_hit"))
    # Rows without a window keep their place in the join under a key of their own, so that they meet nobody, wherever they go.
    one = one.select("_row", *keys, "n_words", F.col("_hit.start").alias("start"), (F.col("_hit.start") + F.col("_hit.size")).alias("end"), F.coalesce("_hit.window", F.concat(F.lit(" "), F.col("_row"))).alias("window"))
    known = windows.select("window", "item_ids")
    matched = one.join(F.broadcast(known) if size_in_bytes <= BROADCAST_BYTES else known, "window", "left")
    span = F.when(F.col("item_ids").isNotNull(), F.struct("start", "end"))
    return matched.groupBy("_row", *keys, "n_words").agg(F.collect_list(span).alias("spans"), F.array_distinct(F.flatten(F.collect_set("item_ids"))).alias("item_ids")).drop("_row")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` of every row."""
    found = hits(texts(docs), benchmark, "doc_id")
    return found.select(
        "doc_id",
        "n_words",
        _covered(F.col("spans")).alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("item_ids"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns, whatever their names. A row is known by its id, its text's
    length and hash. Rows with a hit are counted first: while they are few they are broadcast and no text is moved."""
    row, key = free_name(docs, "_judged"), ["_key"]
    named = F.struct(F.col("doc_id"), F.octet_length("text").alias("size"), F.xxhash64("text").alias("hash"))
    hit = hits(docs.select(named.alias("_key"), "text"), benchmark, *key).where(F.size("spans") > 0)
    hit = checkpointed(hit.select("_key.doc_id", "_key.size", "_key.hash").distinct().toDF(*(f"{row}_{k}" for k in range(3))))
    same = F.col("doc_id").eqNullSafe(F.col(f"{row}_0")) & (F.octet_length("text") == F.col(f"{row}_1")) & (F.xxhash64("text") == F.col(f"{row}_2"))
    return docs.join(F.broadcast(hit) if hit.count() <= BROADCAST_ROWS else hit, same, "left_anti")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, w, least(10, len(w)) AS k FROM (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT k FROM items),
found AS (
  SELECT d.doc_id, d.i, d.k, x.item_id FROM (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
      SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, sizes WHERE len(w) >= k)) d
  JOIN windows x ON x.k = d.k AND x.g = d.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit ON hit.doc_id = docs.doc_id LEFT JOIN named ON named.doc_id = docs.doc_id
"""
