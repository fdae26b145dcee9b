"""Operator 2: secrets in texts, on built-in functions alone.

Three patterns give the base spans. Besides them, strings that may be keys are candidates: maximal runs of base64 or
hexadecimal characters that hold a digit and a letter. Over each candidate slides a window; the counts of its characters
change by one character in and one out at each step, and with them the sum that makes the Shannon entropy. A candidate is
a secret if its largest window entropy reaches the limit of its character class and no rule of the allow-list names it.
Placeholder words cut a candidate: it is a secret if what is left on either side of them is one.

Defined results: a null text counts as empty and has no span; repeated rows are scanned each; an empty table gives no
rows; other columns are ignored, whatever their names; texts are scanned whole, and positions are code points with exclusive
ends. Of overlapping base spans all are told; of a candidate that touches base spans, the parts outside them are judged, each
by itself, if they are at least a window long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.native import blocks_of, let, piece, sum_before
from tidemill.llm.tables import columns_of, read_table, texts

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGNED = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run is taken whole, so that asking for 20 characters here drops the same ones as a test afterwards
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
#: Least entropy of a window, in bits a character, by the candidate's class.
LIMITS = {"hex": 3.1, "base64": 3.85}
#: Candidates of these forms are no secrets: UUIDs, dates and numbers, words joined by separators.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9/_+-]+$",
    # Possessive: Java repeats such a group in a loop, others by recursion, so that a long candidate would overflow the stack.
    r"^[a-z]++(?:[/_-][a-z]++)++(?:[/_-]?[0-9]{1,4})?$",
)
#: Placeholders and counted-up characters: what holds them is no secret unless the rest is.
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|xxxx|0000000|your[_-]|abcdefgh|01234567|12345678|qwertyui"


def _found(text: Column, pattern: str) -> Column:
    """The matches of a pattern, leftmost first, not overlapping."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _starts(text: Column, pattern: str, matches: Column) -> Column:
    """Where each of ``matches`` starts: what stands between the matches is as long as the parts of a split at them."""
    gaps = F.slice(F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long")), 1, F.size(matches))

    def starts(gaps: Column) -> Column:
        return F.zip_with(sum_before(F.zip_with(gaps, matches, lambda g, m: g + F.length(m))), gaps, lambda b, g: b + g)

    return F.when(F.size(matches) > 0, let(gaps, starts)).otherwise(F.array().cast("array<long>"))


def _spans(starts: Column, matches: Column, kind: str) -> Column:
    """(start, rank of the kind, end, kind, matched text) of each match."""
    return F.zip_with(
        starts, matches, lambda s, m: F.struct(s.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (s + F.length(m)).alias("end"), F.lit(kind).alias("kind"), m.alias("match"))
    )


def _weight(n: Column) -> Column:
    return n * F.log2(F.greatest(n, F.lit(1)).cast("double"))


def window_entropy(s: Column, width: int = WINDOW) -> Column:
    """The largest entropy of any window of an ASCII string at least as long as a window."""

    def changed(counts: Column, code: Column, by: int) -> Column:
        return F.concat(F.slice(counts, 1, code), F.array(F.get(counts, code) + by), F.slice(counts, code + 2, 128))

    def state(counts: Column, total: Column, least: Column) -> Column:
        return F.struct(counts.alias("counts"), total.alias("total"), least.alias("least"))

    def entered(st: Column, code: Column) -> Column:
        n = F.get(st["counts"], code)
        return state(changed(st["counts"], code, 1), st["total"] + _weight(n + 1) - _weight(n), st["least"])

    def left(st: Column, code: Column) -> Column:
        n = F.get(st["counts"], code)
        return state(changed(st["counts"], code, -1), st["total"] + _weight(n - 1) - _weight(n), st["least"])

    def least_total(codes: Column) -> Column:
        empty = state(F.array_repeat(F.lit(0), 128), F.lit(0.0), F.lit(1e9))
        first = let(F.aggregate(F.slice(codes, 1, width), empty, entered), lambda x: state(x["counts"], x["total"], x["total"]))

        def moved(st: Column, i: Column) -> Column:
            after = let(left(st, F.get(codes, i - width)), lambda x: entered(x, F.get(codes, i)))
            return let(after, lambda x: state(x["counts"], x["total"], F.least(x["least"], x["total"])))

        steps = F.when(F.size(codes) > width, F.sequence(F.lit(width), F.size(codes) - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, first, moved, lambda st: st["least"])

    codes = F.transform(F.filter(F.split(s, ""), lambda c: c != ""), lambda c: F.ascii(c))
    return F.log2(F.lit(float(width))) - let(codes, least_total) / width


def is_secret(s: Column) -> Column:
    """Whether a candidate string is a secret by its entropy and the allow-list."""

    def random(part: Column) -> Column:
        core = F.rtrim(part, F.lit("="))
        limit = F.when(core.rlike("^([0-9a-f]+|[0-9A-F]+)$"), LIMITS["hex"]).otherwise(LIMITS["base64"])
        worth = (F.length(core) >= WINDOW) & core.rlike("[0-9]") & core.rlike("[A-Za-z]")
        return F.when(worth, window_entropy(core) >= limit).otherwise(False)

    allowed = F.lit(False)
    for rule in ALLOWED:
        allowed = allowed | s.rlike(rule)
    return F.when(~s.rlike("[0-9]") | allowed, False).otherwise(F.exists(F.split(s, PLACEHOLDER), random))


def _outside(candidate: Column, base: Column) -> Column:
    """The parts of a candidate (start, rank, end, kind, match) that no base span holds, where they are at least a window long."""
    touching = F.array_sort(F.filter(base, lambda b: (b["start"] < candidate["end"]) & (candidate["start"] < b["end"])))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def after(state: Column, span: Column) -> Column:
        free = F.array(F.struct(state["at"].alias("start"), span["start"].alias("end")))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["free"], F.when(span["start"] >= state["at"] + WINDOW, free).otherwise(none)).alias("free"))

    def rest(state: Column) -> Column:
        last = F.array(F.struct(state["at"].alias("start"), candidate["end"].alias("end")))
        return F.concat(state["free"], F.when(candidate["end"] >= state["at"] + WINDOW, last).otherwise(none))

    def cut(part: Column) -> Column:
        said = F.substring(candidate["match"], (part["start"] - candidate["start"] + 1).cast("int"), (part["end"] - part["start"]).cast("int"))
        return F.struct(part["start"].alias("start"), candidate["rank"].alias("rank"), part["end"].alias("end"), candidate["kind"].alias("kind"), said.alias("match"))

    parts = F.aggregate(touching, F.struct(candidate["start"].alias("at"), none.alias("free")), after, rest)
    return F.when(F.size(touching) == 0, F.array(candidate)).otherwise(F.transform(parts, cut))


def with_spans(docs: DataFrame, *keep: str) -> DataFrame:
    """``text`` and the columns ``keep`` of ``docs``, and an array ``spans`` of (start, rank, end, kind, match), in order. A
    projection: nothing moves. ``keep`` may not have the names used here."""
    text, held = F.col("text"), [*keep, "text"]
    found = docs.select(*held, *(_found(text, p).alias(f"_{k}") for k, p in zip(KINDS, (ASSIGN, ACCESS, HEX, CANDIDATE), strict=True)))
    values = F.when(F.size("_assign") > 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,match:string>>")

    def where_any(kind: str, pattern: str) -> Column:
        matches = F.col(f"_{kind}")
        return F.when(F.size(matches) > 0, _spans(_starts(text, pattern, matches), matches, kind)).otherwise(none)

    possible = F.exists("_entropy", lambda m: m.rlike("[0-9]"))
    spans = found.select(
        *held,
        F.when(F.size("_assign") > 0, F.filter(F.zip_with(where_any("assign", ASSIGN), values, lambda s, v: F.when(F.length(v) >= ASSIGNED, s)), lambda s: s.isNotNull())).otherwise(none).alias("_s0"),
        where_any("access", ACCESS).alias("_s1"),
        where_any("hex", HEX).alias("_s2"),
        F.when(possible, where_any("entropy", CANDIDATE)).otherwise(none).alias("_s3"),
    ).select(*held, F.concat("_s0", "_s1", "_s2").alias("_base"), "_s3")
    added = F.filter(F.flatten(F.transform("_s3", lambda c: _outside(c, F.col("_base")))), lambda s: is_secret(s["match"]))
    return spans.select(*held, F.array_sort(F.concat("_base", F.when(F.size("_s3") > 0, added).otherwise(none))).alias("spans"))


def _told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` of every row."""
    found = with_spans(texts(docs), "doc_id")

    def many(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [many(k) for k in KINDS[:3]]
    base = F.filter("spans", lambda s: s["rank"] < 3)
    return found.select("doc_id", *counts, F.sha2(_told(base), 256).alias("base_sha256"), _told(F.col("spans")).alias("spans"))


def _apart(spans: Column) -> Column:
    """Spans (start, end) in order, those that overlap made one."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def widened(state: Column, s: Column) -> Column:
        last = F.try_element_at(state, F.lit(-1))
        both = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(s["start"] < last["end"], F.concat(F.slice(state, 1, F.size(state) - 1), F.array(both))).otherwise(F.array_append(state, s))

    bare = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    overlap = F.exists(F.zip_with(F.slice(bare, 2, F.size(bare)), F.slice(bare, 1, F.size(bare) - 1), lambda b, a: b["start"] < a["end"]), lambda x: x)
    return F.when(F.size(bare) < 2, bare).when(~overlap, bare).otherwise(F.aggregate(bare, none, widened))


def redacted(docs: DataFrame, marker: str = "[SECRET]") -> DataFrame:
    """``docs`` with the same columns, the spans of each text replaced by ``marker`` (those that overlap by one) and ``n_chars`` set to
    the new length where it is there. The spans are those that ``secrets`` tells; texts without any stay as they are, nulls too."""
    rows = docs.select(F.struct(*columns_of(docs)).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = with_spans(rows, "row")

    def rebuilt(spans: Column, blocks: Column) -> Column:
        ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
        starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length("text").cast("long")))
        return F.array_join(F.zip_with(ends, starts, lambda a, b: piece(blocks, a, b)), marker)

    some = F.size("spans") > 0
    text = let(_apart(F.col("spans")), lambda spans: let(blocks_of(F.col("text")), lambda blocks: rebuilt(spans, blocks)))
    told = found.select("row", some.alias("some"), F.when(some, text).alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return told.select(*(F.when(F.col("some"), new[c]).otherwise(F.col("row").getField(c)).alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(read_table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT r, 'assign' AS kind, 0 AS rank, regexp_extract_all(text, '{assign}') AS m, regexp_extract_all(text, '{assign}', 2) AS v, string_split_regex(text, '{assign}') AS gaps FROM docs UNION ALL
  SELECT r, 'access', 1, regexp_extract_all(text, 'AKIA[A-Z0-9]+'), NULL, string_split_regex(text, 'AKIA[A-Z0-9]+') FROM docs UNION ALL
  SELECT r, 'hex', 2, regexp_extract_all(text, '[0-9a-f]+'), NULL, string_split_regex(text, '[0-9a-f]+') FROM docs UNION ALL
  SELECT r, 'entropy', 3, regexp_extract_all(text, '[A-Za-z0-9+/_-]{{20,}}={{0,2}}'), NULL, string_split_regex(text, '[A-Za-z0-9+/_-]{{20,}}={{0,2}}') FROM docs),
each_one AS (SELECT r, kind, rank, unnest(m) AS m, unnest(CASE WHEN v IS NULL THEN m ELSE v END) AS v, unnest(gaps[1:len(m)]) AS gap, unnest(range(len(m))) AS k FROM found WHERE len(m) > 0),
placed AS (SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY r, rank ORDER BY k) AS BIGINT) AS stop FROM each_one),
spans AS (SELECT r, kind, rank, m, v, stop - length(m) AS start, stop FROM placed),
base AS (SELECT r, kind, rank, start, stop FROM spans WHERE (rank = 0 AND length(v) >= 6) OR (rank = 1 AND length(m) >= 20) OR (rank = 2 AND length(m) >= 24)),
met AS (
  SELECT c.r, c.start AS c_start, c.stop AS c_stop, c.m, b.start, b.stop, greatest(c.start, coalesce(max(b.stop) OVER (PARTITION BY c.r, c.start ORDER BY b.start, b.rank, b.stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS at_
  FROM spans c JOIN base b ON b.r = c.r AND b.start < c.stop AND c.start < b.stop WHERE c.rank = 3),
pieces AS (
  SELECT r, start, stop, m AS said FROM spans c WHERE rank = 3 AND NOT EXISTS (SELECT 1 FROM met WHERE met.r = c.r AND met.c_start = c.start) UNION ALL
  SELECT r, at_, start, substr(m, CAST(at_ - c_start + 1 AS BIGINT), start - at_) FROM met WHERE start - at_ >= 20 UNION ALL
  SELECT r, greatest(c_start, max(stop)), c_stop, substr(m, CAST(greatest(c_start, max(stop)) - c_start + 1 AS BIGINT), c_stop - greatest(c_start, max(stop))) FROM met GROUP BY r, c_start, c_stop, m HAVING c_stop - greatest(c_start, max(stop)) >= 20),
judged AS (SELECT DISTINCT said FROM pieces WHERE regexp_matches(said, '[0-9]')
  AND NOT regexp_full_match(said, '[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}') AND NOT regexp_full_match(said, '[0-9/_+-]+') AND NOT regexp_full_match(said, '[a-z]+([/_-][a-z]+)+([/_-]?[0-9]{{1,4}})?')),
parts AS (SELECT said, rtrim(unnest(string_split_regex(said, '{placeholder}')), '=') AS core FROM judged),
windows AS (SELECT said, core, unnest(range(1, length(core) - 18)) AS i FROM (SELECT DISTINCT said, core FROM parts WHERE length(core) >= 20 AND regexp_matches(core, '[0-9]') AND regexp_matches(core, '[A-Za-z]'))),
secret AS (SELECT DISTINCT said FROM windows WHERE list_aggregate(string_split(substr(core, i, 20), ''), 'entropy') >= CASE WHEN regexp_full_match(core, '[0-9a-f]+|[0-9A-F]+') THEN 3.1 ELSE 3.85 END),
told AS (SELECT r, kind, rank, start, stop FROM base UNION ALL SELECT r, 'entropy', 3, start, stop FROM pieces WHERE said IN (SELECT said FROM secret)),
by_doc AS (SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) FILTER (rank < 3) AS base_spans, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS spans FROM told GROUP BY r)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN by_doc ON by_doc.r = docs.r
""".format(assign=r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", placeholder="(?i)example|sample|dummy|placeholder|changeme|xxxx|0000000|your[_-]|abcdefgh|01234567|12345678|qwertyui")
