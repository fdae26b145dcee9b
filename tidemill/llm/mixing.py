"""Operator 12: sources mixed to target weights by Sainte-Laguë apportionment.

Sources in the order of their names have weights in turn and share a multiple of all words; none gets more than so many times
its own size, and what is over goes to the others by weight. The mix is made of blocks of equal length: sources get blocks by
the highest quotients of their targets, then a source's shards get its blocks by the highest quotients of their words. A shard
is a part of a source, by hash, of bounded size. Its documents stand in seeded order; the quota takes the whole shard as often as it holds it,
and of the rest blocks at even distances from a seeded first one. So a source's words differ from its target by half a
block and by what rounding gives to shards that are already taken as often as allowed.

Nothing is made for each block: who gets how many follows from two divisors between which at most twice as many quotients lie
as there are sources (or shards), and what a document gives from its place in the shard. Of texts only their number of words and
a digest are kept. Sums are of whole numbers, so that every run has the same targets, quotas and blocks.

Defined results: null and empty texts have size 0 and give nothing; a source of size 0 has target 0; rows without a source are a
source, the last; repeated rows count each; other columns are ignored; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.ordering import numbered
from tidemill.llm.tables import checkpointed, read_table

WEIGHTS = (3, 1, 2)
#: All words times the first number by the second are shared.
SHARE = (3, 2)
REPEATS = 2
BLOCK_WORDS = 16
#: Bounds of a shard, about.
SHARD_WORDS, SHARD_ROWS = 1 << 20, 100_000
SEED = 12
#: The sources' table is broadcast up to so many bytes of names, a shuffle join beyond.
BROADCAST_BYTES = 16 << 20

WORD = r"[^\x20\x09-\x0D]+"


def _number(digest: Column) -> Column:
    """A whole number of 32 bits from a digest in hexadecimal digits."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``key`` (the source, in an order with null last) and ``digest``, which sets the order in a shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("t"))
    return docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), key.alias("key"), digest.alias("digest"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``sources`` (``key``, ``source_size``) with ``target``. Each round is one aggregate over the sources: the sizes and weights of those
    whose part is above their bound; the level of the others only rises, and the rounds end when nobody new is above it."""
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_place") - 1) % len(weights) + 1).cast("int")).cast("long")
    held = checkpointed(numbered(sources, [F.col("key")], "_place").withColumn("_weight", weight))
    total, all_weights = held.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_weight"), F.lit(0))).first()
    size = weight_above = -1
    known = (0, 0)
    while known != (size, weight_above):
        size, weight_above = known
        # Whole numbers until the last step: (share * total - repeats * size above) * weight / weights left.
        left, over = share[0] * total - share[1] * repeats * size, share[1] * max(1, all_weights - weight_above)
        part = F.col("_weight") * F.lit(left) / F.lit(over)
        above = part > repeats * F.col("source_size")
        known = tuple(held.where(above).agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_weight"), F.lit(0))).first())
    return held.withColumn("target", F.when(above, (repeats * F.col("source_size")).cast("double")).otherwise(part)).drop("_place", "_weight")


def apportioned(units: DataFrame, by: list[str], unit: list[str]) -> DataFrame:
    """``units`` (``by``, ``unit``, ``votes`` and, the same in each group, ``seats``) with ``blocks``: the group's seats go to the highest of
    the quotients votes / (1, 3, 5, ...), of equal ones to the unit that comes first.

    The divisors votes / (seats ± half the units) give at most, and at least, as many seats as there are; only the quotients
    between them, twice as many as units, are ordered."""
    sums = units.groupBy(*by).agg(F.sum("votes").alias("_votes"), F.count_if(F.col("votes") > 0).alias("_units"))
    both = units.join(sums, by).where("votes > 0")

    def at(seats: Column) -> Column:
        """How many seats a unit has at the divisor that parts all votes into so many."""
        return F.floor(F.col("votes") * F.greatest(seats, F.lit(0.0)) / F.col("_votes") + 0.5)

    both = both.withColumn("_sure", at(F.col("seats") - F.col("_units") / 2 - 1)).withColumn("_most", at(F.col("seats") + F.col("_units") / 2 + 1))
    both = checkpointed(both)
    sure = both.groupBy(*by).agg((F.first("seats") - F.sum("_sure")).alias("_left"))
    open_ones = both.where("_most > _sure").select(*by, *unit, "votes", F.explode(F.sequence("_sure", F.col("_most") - 1)).alias("_k"))
    open_ones = open_ones.select(*by, *unit, (F.col("votes") / (2 * F.col("_k") + 1)).alias("_quotient"))
    ranked = numbered(open_ones, [*map(F.col, by), F.desc("_quotient"), *map(F.col, unit)], "_place")
    first = ranked.groupBy(*by).agg(F.min("_place").alias("_first"))
    won = ranked.join(first.join(sure, by), by).where("_place - _first < _left").groupBy(*by, *unit).agg(F.count("*").alias("_won"))
    got = both.select(*by, *unit, "_sure").join(won, [*by, *unit], "left").select(*by, *unit, (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias("blocks"))
    return units.join(got, [*by, *unit], "left").withColumn("blocks", F.coalesce("blocks", F.lit(0)).cast("long"))


def quotas(shards: DataFrame, block: int, repeats: int, seed: int) -> DataFrame:
    """``shards`` (``key``, ``shard``, ``words``, ``blocks``) with what is taken: ``copies`` of the whole; ``chosen`` of its ``full`` blocks, those
    whose place times ``chosen`` plus ``shift`` passes a multiple of ``full``; and ``more`` words of the first block, which isn't
    chosen, or of what stands behind the last full one."""
    quota = F.least(F.col("blocks") * block, F.col("words") * repeats)
    out = shards.withColumn("_quota", quota).withColumn("copies", F.expr("_quota div greatest(words, 1)")).withColumn("_rest", F.expr("_quota - copies * words"))
    out = out.withColumn("full", F.expr(f"words div {block}")).withColumn("chosen", F.expr(f"_rest div {block}")).withColumn("more", F.expr(f"_rest % {block}"))
    first = _number(F.md5(F.concat_ws(":", F.lit(str(seed)), "key", F.col("shard").cast("string"))))
    return out.withColumn("shift", F.when(F.col("chosen") < F.col("full"), first % (F.col("full") - F.col("chosen"))).otherwise(0)).drop("_quota", "_rest")


def _is_chosen(k: Column) -> Column:
    return (k * F.col("chosen") + F.col("shift")) % F.greatest("full", F.lit(1)) >= F.col("full") - F.col("chosen")


def _taken_before(x: Column, block: int) -> Column:
    """How many of a shard's first ``x`` words its blocks take, beside the copies."""
    k = F.least(F.floor(x / block), F.col("full"))
    whole = F.floor((k * F.col("chosen") + F.col("shift")) / F.greatest("full", F.lit(1))) * block
    here = F.when(k < F.col("full"), F.when(_is_chosen(k), x - k * block).otherwise(0)).when(F.col("chosen") == F.col("full"), F.least(x - k * block, F.col("more"))).otherwise(0)
    return whole + here + F.when(F.col("chosen") < F.col("full"), F.least(x, F.col("more"))).otherwise(0)


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, repeats: int = REPEATS, block: int = BLOCK_WORDS, seed: int = SEED, shard_words: int = SHARD_WORDS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Of each row of ``docs``: ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` (of its source), ``taken``, and where it stands:
    ``shard``, ``start`` (its first word there), ``copies``, ``full``, ``chosen``, ``shift``, ``more`` (see ``quotas``)."""
    rows = checkpointed(sized(docs, seed))
    sources = targets(rows.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows")), weights, share, repeats)
    n, name_bytes = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(F.octet_length("key") + 64), F.lit(0))).first()
    seats = (2 * share[0] * n + share[1] * block) // (2 * share[1] * block)  # the shared words in blocks, rounded
    won = apportioned(sources.select(F.lit(0).alias("_all"), "key", F.col("target").alias("votes"), F.lit(seats).cast("long").alias("seats")), ["_all"], ["key"])
    parts = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("_rows") / shard_rows)).cast("long").alias("_parts")
    known = checkpointed(sources.select("key", "source_size", "target", parts).join(won.select("key", F.col("blocks").alias("seats")), "key"))
    placed = rows.join(F.broadcast(known) if name_bytes <= BROADCAST_BYTES else known, "key").withColumn("shard", _number(F.col("digest")) % F.col("_parts")).drop("_parts")
    shards = placed.groupBy("key", "shard", "seats").agg(F.sum("size").alias("words"))
    cut = apportioned(checkpointed(shards).withColumn("votes", F.col("words").cast("double")), ["key"], ["shard"])
    taken = quotas(cut.select("key", "shard", "words", "blocks"), block, repeats, seed)
    # One exchange: rows meet their shard's quota where they are ordered.
    both = placed.join(taken, ["key", "shard"])
    end = F.expr("sum(size) OVER (PARTITION BY key, shard ORDER BY digest, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    both = both.withColumn("_end", end).withColumn("start", F.col("_end") - F.col("size"))
    gain = (F.col("copies") * F.col("size") + _taken_before(F.col("_end"), block) - _taken_before(F.col("start"), block)).cast("long")
    return both.select("doc_id", "source", "size", "source_size", "target", gain.alias("taken"), "shard", "start", "copies", "full", "chosen", "shift", "more")


def pieces(mix: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id``, ``begin``, ``end`` (in words of the document) of what ``mixed`` takes beside whole copies, a row for each block's part."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    spans = F.transform(F.sequence(first, last), lambda k: F.struct((k * block).alias("b"), F.when(k >= F.col("full"), F.when(F.col("chosen") == F.col("full"), k * block + F.col("more")).otherwise(k * block)).when(_is_chosen(k), (k + 1) * block).when(k == 0, F.col("more")).otherwise(k * block).alias("e")))
    one = mix.where("size > 0").select("doc_id", "start", "size", F.explode(spans).alias("s"))
    cut = one.select("doc_id", F.greatest(F.col("s.b") - F.col("start"), F.lit(0)).alias("begin"), F.least(F.col("s.e") - F.col("start"), F.col("size")).alias("end"))
    return cut.where("end > begin")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_sql(block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, shard_rows: int = SHARD_ROWS, seed: int = SEED) -> str:
    """Every quotient of every source and shard is made and ordered, and every block of every shard."""
    number = "CAST('0x' || substr({}, 1, 8) AS BIGINT)"
    return rf"""
WITH sized AS (SELECT doc_id, coalesce('s' || source, 't') AS key, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size, md5(concat_ws(':', '{seed}', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))) AS digest FROM documents),
sources AS (SELECT key, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n, CASE (row_number() OVER (ORDER BY key) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM sized GROUP BY key),
filling AS (SELECT *, coalesce(sum(source_size) OVER before, 0) AS full_size, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weights, sum(source_size) OVER () AS total FROM sources WINDOW before AS (ORDER BY source_size / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT CAST(3 * total - 4 * full_size AS BIGINT) AS l, CAST(2 * weights AS BIGINT) AS o FROM filling WHERE weight * (3 * total - 4 * full_size) / (2 * weights) <= 2 * source_size ORDER BY source_size / weight, key LIMIT 1),
targets AS (SELECT key, source_size, n, least(CAST(2 * source_size AS DOUBLE), coalesce(CAST(weight * l AS DOUBLE) / o, 2 * source_size)) AS target FROM sources LEFT JOIN level ON true),
quotients AS (SELECT key, target / (2 * k + 1) AS q FROM (SELECT key, target, unnest(generate_series(0, CAST(target / {block} AS BIGINT) + 2)) AS k FROM targets) WHERE target > 0),
seats AS (SELECT key, count(*) AS seats FROM (SELECT key FROM quotients ORDER BY q DESC, key LIMIT (SELECT (6 * CAST(coalesce(sum(source_size), 0) AS BIGINT) + 2 * {block}) // (4 * {block}) FROM sources)) GROUP BY key),
placed AS (SELECT s.*, t.source_size, t.target, {number.format("digest")} % greatest(1, CAST(ceil(t.source_size / {shard_words}) AS BIGINT), CAST(ceil(t.n / {shard_rows}) AS BIGINT)) AS shard FROM sized s JOIN targets t USING (key)),
shards AS (SELECT key, shard, CAST(sum(size) AS BIGINT) AS words FROM placed GROUP BY ALL),
won AS (SELECT key, shard, count(*) AS blocks FROM (SELECT key, shard, seats, row_number() OVER (PARTITION BY key ORDER BY words / (2 * k + 1) DESC, shard) AS place
  FROM (SELECT key, shard, words, seats, unnest(generate_series(0, seats - 1)) AS k FROM shards JOIN seats USING (key) WHERE words > 0)) WHERE place <= seats GROUP BY ALL),
quotas AS (SELECT key, shard, words, least(coalesce(blocks, 0) * {block}, 2 * words) AS quota FROM shards LEFT JOIN won USING (key, shard)),
rest AS (SELECT *, quota // greatest(words, 1) AS copies, words // {block} AS full_blocks, (quota - (quota // greatest(words, 1)) * words) // {block} AS chosen, (quota - (quota // greatest(words, 1)) * words) % {block} AS more FROM quotas),
shifted AS (SELECT *, CASE WHEN chosen < full_blocks THEN {number.format(f"md5('{seed}:' || key || ':' || shard)")} % (full_blocks - chosen) ELSE 0 END AS shift FROM rest),
cut AS (SELECT key, shard, k * {block} AS b, CASE WHEN k = full_blocks THEN CASE WHEN chosen = full_blocks THEN k * {block} + more ELSE k * {block} END
  WHEN ((k + 1) * chosen + shift) // full_blocks > (k * chosen + shift) // full_blocks THEN (k + 1) * {block} WHEN k = 0 THEN more ELSE k * {block} END AS e FROM (SELECT *, unnest(generate_series(0, full_blocks)) AS k FROM shifted)),
docs AS (SELECT *, sum(size) OVER (PARTITION BY key, shard ORDER BY digest, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS doc_end, row_number() OVER () AS id FROM placed),
part AS (SELECT d.id, sum(least(c.e, d.doc_end) - greatest(c.b, d.doc_end - d.size)) AS words FROM docs d JOIN cut c ON c.key = d.key AND c.shard = d.shard AND c.b < d.doc_end AND c.e > d.doc_end - d.size AND c.e > c.b GROUP BY d.id)
SELECT doc_id, size, source_size, target, CAST(copies * size + coalesce(part.words, 0) AS BIGINT) AS taken FROM docs LEFT JOIN part USING (id) JOIN shifted USING (key, shard)"""
