"""Every operator on an empty table and on rows with nulls, empty and very
long texts, repeated rows and extra columns whose names clash with its own."""
import pytest
from pyspark.sql import functions as F

from verity.llm.bands import score_quality
from verity.llm.bpe import decode, encode, round_trip
from verity.llm.ctw import score_texts
from verity.llm.embed import near_duplicate_vectors
from verity.llm.licenses import scan
from verity.llm.minhash import near_duplicates
from verity.llm.mixing import mix, mix_plan
from verity.llm.pii import pseudonymise
from verity.llm.queries import tokenizer_path
from verity.llm.spans import remove_repeated_spans
from verity.llm.toxicity import drop_toxic, score_toxicity

LONG = " ".join(f"word{i % 977}x" for i in range(20_000))
ROWS = [
    (1, "a plain little text of a few words", "s1"),
    (1, "a plain little text of a few words", "s1"),
    (1, "another text under the same id", "s1"),
    (2, None, None),
    (3, "", "s2"),
    (4, " \t\n ", "s2"),
    (None, "a text without an id", "s1"),
    (None, None, None),
    (5, "one", "s3"),
    (6, LONG, "s1"),
    (7, LONG + " tail", "s1"),
    (8, "x" * 50_000, "s3"),
    (9, "a plain little text of a few words", "s2"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    for name in ("key", "size", "rep", "n", "chunk", "kept", "score", "kind", "ids", "n_words", "label", "component"):
        df = df.withColumn(name, F.lit("clash"))
    return df.withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (5, 1, 1), (None, 1, 1), (9, 0, None)],
                                 "doc_id long, quality int, toxic int")


OPERATORS = {
    "minhash": lambda d, l: near_duplicates(d),
    "bpe": lambda d, l: round_trip(d, tokenizer_path()),
    "bpe_small_leaves": lambda d, l: round_trip(d, tokenizer_path(), leaf=300),
    "spans": lambda d, l: remove_repeated_spans(d),
    "ctw": lambda d, l: score_texts(d, depth=3),
    "mix_plan": lambda d, l: mix_plan(d),
    "pii": lambda d, l: pseudonymise(d),
    "bands": lambda d, l: score_quality(d),
    "toxicity": lambda d, l: score_toxicity(d, l),
    "licenses": lambda d, l: scan(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(docs, labels, name):
    rows = OPERATORS[name](docs, labels).select("doc_id").collect()
    key = lambda x: (x is None, x or 0)
    assert sorted((r[0] for r in rows), key=key) == sorted((r[0] for r in ROWS), key=key)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(docs, labels, name):
    assert OPERATORS[name](docs.filter("false"), labels.filter("false")).collect() == []


def test_row_filters_keep_columns(docs, labels):
    for out in (drop_toxic(docs, labels), mix(docs)):
        assert out.columns == docs.columns
        out.collect()
    assert drop_toxic(docs.filter("false"), labels).count() == 0
    assert mix(docs.filter("false")).count() == 0


def test_decode_null_list(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in decode(df, tokenizer_path()).orderBy("doc_id").collect()] == ["", ""]
    assert encode(spark.createDataFrame([(1, None)], "doc_id long, text string"), tokenizer_path()).first().ids == []


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [0.95, 0.1, 0.0]), (4, [0.0, 1.0, 0.0]), (5, None), (6, []),
            (7, [0.0, 0.0, 0.0]), (8, [1.0, None, 0.0]), (9, [1.0, nan, 0.0]), (10, [inf, 0.0, 0.0]), (11, [1.0]),
            (None, [1.0, 0.0, 0.0]), (12, [1e300, 0.0, 0.0]), (12, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit("clash"))
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(df).collect()}
    assert got == {(1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (12, 4, 1, False), (4, 0, 4, True),
                   *((i, 0, i, True) for i in (5, 6, 7, 8, 9, 10, 11)), (None, 0, None, True)}
    assert near_duplicate_vectors(df.filter("false")).collect() == []
