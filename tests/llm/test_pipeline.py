"""The pipeline's stages, each on its own input and all together, against plain Python."""

from collections import Counter, defaultdict

import corpus_pipeline
import plain
import public_tokenizers
import pytest

from tidemill.llm import labelled, quality, queries
from tidemill.llm.wordhash import blocks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels", "benchmark")}


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def accepted(tables, rows):
    """The rows that the classifier accepts, each text scored by itself."""
    import pyarrow as pa

    docs = {r["doc_id"]: r["text"] for r in tables["documents"].collect()}
    known = [r for r in tables["labels"].collect() if r["doc_id"] in docs and plain.zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    assert all(Counter(r["quality"] for r in known)[k] < quality.TRAIN_ROWS_PER_LABEL for k in (0, 1))  # all are taken
    known.sort(key=lambda r: (r["doc_id"], r["quality"]))
    model = quality.fit(pa.array([docs[r["doc_id"]] for r in known], pa.large_string()), plain.np.array([float(r["quality"]) for r in known]))
    scores = [float(model(*next((raw, offsets) for _, raw, offsets in blocks(pa.array([t or ""], pa.large_string()))))[0]) for _, t in rows]
    return [row for row, s in zip(rows, scores, strict=True) if s >= quality.THRESHOLD]


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def check_packed(got, rows, tokenizer):
    want = plain.pieces(rows, tokenizer, 2048)
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == Counter(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == len(plain.rooms([w[2] for w in want], 2048))


def test_each_stage_and_the_whole(spark, tables, tokenizer):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    docs = tables["documents"]
    odd = spark.createDataFrame([(None, "a row without an id, and with words enough for shingles", "en", "s", 1), (900_001, None, "en", "s", None), (900_002, "", "en", "s", 0), (900_003, "password=hunter2222 in a short text of some words", "en", "s", 3)], docs.schema)
    items = rows_of_benchmark = [(r["item_id"], r["text"]) for r in tables["benchmark"].collect()]
    held = docs.unionByName(odd)

    def keep(df):
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
        return spark.createDataFrame(df.collect(), docs.schema)

    good = keep(stage("quality")(spark, held, SF))
    assert sorted(map(str, rows_of(good))) == sorted(map(str, accepted(tables, rows_of(held))))
    some = good.unionByName(held.where("doc_id IS NULL OR doc_id > 900000")).dropDuplicates()
    one = keep(stage("near_duplicates")(spark, some, SF))
    stay, choice = plain.one_of_each(rows_of(some))
    assert one.count() == len(stay) + len(choice) and all(len(c & set(rows_of(one))) == 1 for c in choice) and not set(stay) - set(rows_of(one))
    clean = keep(stage("decontamination")(spark, one, SF))
    assert sorted(map(str, rows_of(clean))) == sorted(str(r) for r in rows_of(one) if not plain.contaminated(r[1] or "", items)[1])
    masked = keep(stage("secrets")(spark, clean, SF))
    want = [(i, t if t is None else plain.redacted(t)) for i, t in rows_of(clean)]
    assert sorted(map(str, rows_of(masked))) == sorted(map(str, want)) and any("[SECRET]" in (t or "") for _, t in want)
    assert {r["doc_id"]: r["n_chars"] for r in masked.collect() if r["doc_id"] == 900_003} == {900_003: len("[SECRET] in a short text of some words")}
    check_packed(stage("packing")(spark, masked, SF).collect(), rows_of(masked), tokenizer)

    rows = accepted(tables, rows_of(docs))
    stay, choice = plain.one_of_each(rows)
    rows = stay + [min(c) for c in choice]
    assert all(len(c) == 1 for c in choice)
    rows = [(i, plain.redacted(t)) for i, t in rows if not plain.contaminated(t, rows_of_benchmark)[1]]
    check_packed(corpus_pipeline.run(spark, SF).collect(), rows, tokenizer)


def test_empty_documents(spark, tables):
    docs = tables["documents"].limit(0)
    for _, make in corpus_pipeline.STAGES:
        docs = make(spark, docs, SF)
        assert docs.count() == 0


def test_without_labels_every_document_stays(spark, tables):
    docs = tables["documents"].limit(20)
    for labels in (tables["labels"].limit(0), tables["labels"].where("quality = 0")):
        assert quality.good_documents(docs, labels).count() == 20
    assert labelled.training_sample(docs, tables["labels"].limit(0), "quality", 4, 2, 10).count() == 0


def test_columns_with_clashing_names(spark, tables):
    docs = tables["documents"].where("doc_id < 60")
    names = ["_matches", "_id", "_hash", "_text", "_key", "_judged", "_judged_0", "a.b", "row", "spans", "some", "start", "owner", "mark", "bucket", "many", "many`x"]
    wide = docs.selectExpr("*", *(f"{k} AS `{n.replace('`', '``')}`" for k, n in enumerate(names)))
    for name, make in corpus_pipeline.STAGES[:-1]:
        out = make(spark, wide, SF)
        assert out.columns == wide.columns
        got = out.collect()
        assert got and all(tuple(r)[5:] == tuple(range(len(names))) for r in got)
        assert sorted((r["doc_id"], r["text"]) for r in got) == sorted(rows_of(make(spark, docs, SF))), name


def test_repeated_ids_lose_no_text(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen fourteen"
    near = " ".join(f"w{k}" for k in range(40))
    cases = {
        ((1, a), (3, a), (3, b)): [{(1, a)}, {(3, b)}],
        ((3, a), (3, b)): [{(3, a)}, {(3, b)}],
        ((3, a), (3, a), (2, b)): [{(3, a)}, {(2, b)}],
        ((5, near), (5, near + " end"), (6, near)): [{(5, near), (5, near + " end")}],
        ((1, ""), (1, ""), (2, None), (None, a), (None, a)): [],
    }
    for rows, choice in cases.items():
        docs = spark.createDataFrame(list(rows), "doc_id long, text string")
        got = rows_of(stage("near_duplicates")(spark, docs, SF))
        stay, want = plain.one_of_each(list(rows))
        assert sorted(map(str, want)) == sorted(map(str, choice)) or {frozenset(c) for c in want} == {frozenset(c) for c in choice}
        assert len(got) == len(stay) + len(choice) and all(len(c & set(got)) == 1 for c in choice)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, name):
    from oracle import compare

    compare(spark, queries.queries()[name], queries.oracle_sql()[name], SF)


def test_registered():
    assert sorted(queries.queries()) == sorted(["op1_edit_embedding", "op2_secrets", "op3_decontamination", "op4_substring_dedup", "op5_toxicity", "op6_licenses", "op7_packing", "op8_quality", "op9_ngram_join", "op10_bpe_token_counts", "near_fingerprints"])
    assert corpus_pipeline.ORACLE_SQL is None
