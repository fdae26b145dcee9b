"""Operator 6: licences that texts name, on built-in functions alone.

A rule is a signature over lower-cased words joined by single spaces: a regular expression with one of its words marked as
its keyword. Rules are ordered by priority. Texts are first sifted by keyword: only the surroundings of a keyword, with that
word marked, meet the rules of this keyword, so that each place is found once. Of overlapping findings, one that lies within
the interval of a finding of higher priority, or of the same priority and longer, is suppressed; of equal intervals and
priorities the first label stays. Findings of the base phrases are never suppressed.

The rules are written by hand: passages of notices and grants (see ``signatures``), each a rule of its own, and names of licences,
which make a rule with each of the phrases in which they are named.

Defined results: a null or empty text has no words and no finding; repeated rows are scanned each; an empty table gives no
rows; other columns are ignored; texts are scanned whole."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.native import let, words
from tidemill.llm.signatures import GRANTS, NOTICES, TITLES
from tidemill.llm.tables import read_table, texts

#: Stands before the keyword where rules and surroundings meet; no word of a text can hold it. In the lists below keywords are marked with "§".
MARK = "\x01"
#: Words on either side of a keyword that a rule can reach.
REACH = 28
BASE = (("under the §mit license", "mit"), ("§apache license version 2", "apache-2"), ("§cc by nc", "cc-by-nc"))

# Licences by label, each with its names; in a name the keyword is marked.
NAMES = {
    "mit": ["§mit license", "§mit licence", "expat §license"],
    "apache-2": ["§apache license(?: version)? 2(?: 0)?", "§apache 2(?: 0)?(?: license)?", "§apache software license(?: version)? 2(?: 0)?"],
    "apache-1": ["§apache license(?: version)? 1(?: [01])?", "§apache software license(?: version)? 1(?: [01])?"],
    "bsd-2": ["§bsd 2 clause", "2 clause §bsd", "simplified §bsd", "§freebsd license"],
    "bsd-3": ["§bsd 3 clause", "3 clause §bsd", "new §bsd", "modified §bsd", "revised §bsd"],
    "bsd": ["§bsd license", "§bsd style license", "§bsd licence"],
    "gpl-2": ["§gnu general public licen[cs]e(?: version| v)? ?2", "§gpl(?: version)? v?2(?: 0)?", "§gplv2"],
    "gpl-3": ["§gnu general public licen[cs]e(?: version| v)? ?3", "§gpl(?: version)? v?3(?: 0)?", "§gplv3"],
    "gpl": ["§gnu general public licen[cs]e", "§gnu gpl"],
    "lgpl-2": ["§gnu (?:lesser|library) general public licen[cs]e(?: version| v)? ?2(?: 1)?", "§lgpl(?: version)? v?2(?: 1)?", "§lgplv2"],
    "lgpl-3": ["§gnu lesser general public licen[cs]e(?: version| v)? ?3", "§lgpl(?: version)? v?3", "§lgplv3"],
    "agpl-3": ["§gnu affero general public licen[cs]e(?: version| v)? ?3?", "§agpl(?: version)? v?3", "§agplv3"],
    "mpl-2": ["§mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?", "§mpl 2(?: 0)?"],
    "mpl-1": ["§mozilla public licen[cs]e(?: version| v)? ?1(?: [01])?", "§mpl 1(?: [01])?"],
    "epl": ["§eclipse public licen[cs]e(?: version| v)?(?: [12](?: 0)?)?", "§epl [12] 0"],
    "cddl": ["common development and distribution §license", "§cddl"],
    "isc": ["§isc license", "§isc licence"],
    "zlib": ["§zlib license", "§zlib libpng license"],
    "unlicense": ["the §unlicense"],
    "wtfpl": ["§wtfpl"],
    "artistic": ["§artistic license(?: [12] 0)?"],
    "boost": ["§boost software license"],
    "python": ["§psf license", "§python software foundation license"],
    "eupl": ["§eupl(?: v?1 [12])?", "european union public §licence"],
    "odbl": ["open database §license", "§odbl"],
    "ofl": ["sil open font §license", "§ofl 1 1"],
    "openssl": ["§openssl license"],
    "cecill": ["§cecill(?: [abc]| 2 1)?"],
    "proprietary": ["all rights §reserved", "proprietary and §confidential"],
}
# Parts of Creative Commons licences, with their names in full.
CREATIVE = {
    "by": "attribution",
    "by nc": "attribution non ?commercial",
    "by sa": "attribution share ?alike",
    "by nd": "attribution no ?deriv(?:ative)?s",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s",
}
# Phrases around a name, with the confidence that a document which says so is under the licence.
PHRASES = (
    ("(?:is |are )?(?:hereby )?(?:licensed|licenced) under (?:the |a )?(?:terms of the )?{}", 0.95),
    ("(?:is |are )?(?:released|distributed|published|available|made available|provided) under (?:the |a )?(?:terms of the )?{}", 0.95),
    ("spdx license identifier {}", 1.0),
    ("under (?:the )?(?:terms of the )?{}", 0.85),
    ("(?:see|read) (?:the )?{}", 0.6),
    ("{}", 0.5),
)


def _literal(name: str) -> str:
    """The plain text that a match has from the marked keyword on, up to where the expression first leaves a choice."""
    plain = re.match(rf"{MARK}[^\[(?\\{{.+*]*", name[name.index(MARK) :])[0]
    return plain[:-1] if name[name.index(MARK) + len(plain) :].startswith(("?", "*", "{")) else plain


def _keyword(rule: str) -> str:
    return re.split(r"[^0-9a-z]", rule.split(MARK)[1], maxsplit=1)[0]


def rules() -> list[tuple[str, str, str, str, int, float]]:
    """(keyword, plain text, regular expression, label, priority, confidence); of a higher priority wins. Base phrases come first."""
    names = [(label, name) for label, all_names in NAMES.items() for name in all_names]
    for part, full in CREATIVE.items():
        label = "cc-" + part.replace(" ", "-")
        names += [(label, f"§cc {part}(?: [1-4] [05])?"), (label, f"§creative commons {full}(?: [1-4] [05])?")]
    names += [("cc0", "§cc0(?: 1 0)?"), ("cc0", "§creative commons zero")]
    names += [(label, title) for label, titles in TITLES.items() for title in titles]
    names = [(label, name.replace("§", MARK)) for label, name in names]
    base = [(p.replace("§", MARK), label) for p, label in BASE]
    out = [(p.split(MARK)[1].split(" ")[0], _literal(p), p, label, 1000, 0.9) for p, label in base]
    for priority, confidence, table in ((len(PHRASES) + 2, 0.95, NOTICES), (len(PHRASES) + 1, 0.9, GRANTS)):
        passages = [(label, p.replace("§", MARK)) for label, passages in table.items() for p in passages]
        out += [(_keyword(p), _literal(p), p, label, priority, confidence) for label, p in passages]
    for label, name in names:
        keyword = _keyword(name)
        for k, (phrase, confidence) in enumerate(PHRASES):
            out.append((keyword, _literal(name), phrase.format(name), label, len(PHRASES) - k, confidence))
    return out


def findings(docs: DataFrame, *keys: str) -> DataFrame:
    """One row of each document with null ``label``, and one for each finding: ``_row``, ``keys``, ``n_words``, ``start``, ``end``
    (in words), ``label``, ``priority``, ``confidence``, before any suppression. ``docs``: ``keys`` and ``text``."""
    spark = docs.sparkSession
    table = F.broadcast(spark.createDataFrame(rules(), "keyword string, plain string, rule string, label string, priority int, confidence double"))  # some hundred rows, always
    keywords = sorted({r[0] for r in rules()})
    split = docs.select(F.monotonically_increasing_id().alias("_row"), *keys, words(F.col("text")).alias("_words"))

    def around(ws: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(ws)), lambda i: F.get(ws, i).isin(keywords))

        def near(i: Column) -> Column:
            left = F.slice(ws, F.greatest(i - REACH, F.lit(0)) + 1, F.least(i, F.lit(REACH)))
            right = F.slice(ws, i + 1, REACH)
            return F.struct(i.alias("at"), F.get(ws, i).alias("keyword"), F.concat(F.array_join(F.concat(F.array(F.lit("")), left), " "), F.lit(" " + MARK), F.array_join(right, " "), F.lit(" ")).alias("said"))

        return F.transform(places, near)

    near = split.select("_row", *keys, F.size("_words").cast("long").alias("n_words"), let(F.col("_words"), around).alias("_near"))
    rows = near.select("_row", *keys, "n_words", F.explode(F.concat(F.array(F.lit(None).cast("struct<at:int,keyword:string,said:string>")), "_near")).alias("_place"))
    met = rows.select("_row", *keys, "n_words", "_place.*").join(table.withColumnRenamed("keyword", "word"), (F.col("keyword") == F.col("word")) & F.contains("said", "plain"), "left")
    # " rule " within " words \x01keyword words ": whole words only. Where it starts and how long it is, in words.
    pattern = F.concat(F.lit(" "), F.col("rule"), F.lit("(?= )"))
    match = met.select("*", F.when(F.col("rule").isNotNull(), F.call_function("regexp_extract", F.col("said"), pattern, F.lit(0))).alias("match"))
    begin = F.size(F.split(F.substring_index("said", MARK, 1), " ")) - 2
    before = F.size(F.split(F.substring_index("match", MARK, 1), " ")) - 2
    start = (F.col("at") - before).cast("long")
    found = F.col("match").isNotNull() & (F.col("match") != "") & (before <= begin)
    return match.where(F.col("at").isNull() | found).select(
        "_row", *keys, "n_words", start.alias("start"), (start + F.size(F.split(F.expr("substring(match, 2)"), " "))).alias("end"), "label", "priority", "confidence"
    )


def unsuppressed(found: DataFrame) -> DataFrame:
    """Without the findings that lie within one of the same or a higher priority. What could hold a finding comes before it by start and
    then by falling end, so that one running maximum for each priority tells; a window never reaches beyond one document."""
    levels = sorted({r[4] for r in rules()})
    before = Window.partitionBy("_row").orderBy(F.asc_nulls_first("start"), F.desc("end"), F.desc("priority"), "label").rowsBetween(Window.unboundedPreceding, -1)
    held = F.lit(False)
    reached = [F.max(F.when(F.col("priority") >= level, F.col("end"))).over(before).alias(f"_over{level}") for level in levels[:-1]]
    for level in levels[:-1]:
        held = held | ((F.col("priority") == level) & F.coalesce(F.col(f"_over{level}") >= F.col("end"), F.lit(False)))
    return found.select("*", *reached).where(~held).select(*found.columns)


def licenses(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` of every row.

    Only findings and one short row of each document are shuffled, by document."""
    kept = unsuppressed(findings(texts(docs), "doc_id"))
    base = F.col("priority") == 1000
    told = kept.groupBy("_row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"),
        F.coalesce(F.max("confidence"), F.lit(0.0)).alias("score"),
    )
    return told.select("doc_id", "n_words", "n_base", "first_word", "last_word", *(F.array_join(F.sort_array(c), ",").alias(c) for c in ("base_labels", "labels")), "score")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(read_table(spark, sf_dir, "documents"))


def op6_sql() -> str:
    """The query in DuckDB's SQL, with the same rules as a table of values."""
    values = ",\n".join(f"('{k}', '{plain}', '{rule}', '{label}', {priority}, {confidence})" for k, plain, rule, label, priority, confidence in rules())
    return rf"""
WITH rules(keyword, plain, rule, label, priority, confidence) AS (VALUES {values}),
docs AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
places AS (SELECT r, i, w[i] AS keyword, w FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs) WHERE w[i] IN (SELECT keyword FROM rules)),
near AS (SELECT r, i, keyword, CASE WHEN i > 1 THEN ' ' || array_to_string(w[greatest(1, i - {REACH}):i - 1], ' ') ELSE '' END || ' ' || chr(1) || array_to_string(w[i:i + {REACH - 1}], ' ') || ' ' AS said FROM places),
met AS (SELECT r, i, label, priority, confidence, rtrim(regexp_extract(said, ' ' || rule || ' '), ' ') AS m FROM near JOIN rules ON rules.keyword = near.keyword AND contains(said, plain)),
found AS (SELECT DISTINCT r, label, priority, CAST(confidence AS DOUBLE) AS confidence, i - 1 - (len(string_split(string_split(m, chr(1))[1], ' ')) - 2) AS start, len(string_split(substr(m, 2), ' ')) AS n FROM met WHERE m <> ''),
kept AS (SELECT * FROM found f WHERE priority = 1000 OR NOT EXISTS (SELECT 1 FROM found g WHERE g.r = f.r AND g.start <= f.start AND f.start + f.n <= g.start + g.n
  AND (g.priority > f.priority OR g.priority = f.priority AND (g.n > f.n OR g.n = f.n AND g.label < f.label)))),
told AS (SELECT r, count(*) FILTER (priority = 1000) AS n_base, min(start) FILTER (priority = 1000) AS first_word, max(start) FILTER (priority = 1000) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (priority = 1000) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(confidence) AS score FROM kept GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN told ON told.r = docs.r
"""
