"""Rows that share an id, have none, or are equal; vectors of several lengths;
and the whole pipeline against plain Python on such rows."""
import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from verity.llm import embed, minhash, mixing
from verity.llm.queries import tokenizer_path

from test_brute_force import crafted_copies, near_groups


def text(rng, n=60):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    rng = random.Random(1)
    a, b = text(rng), text(rng)
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (None, a), (4, text(rng)), (4, None)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in
                 minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
                 if r.doc_id is not None)
    assert [(i, c) for i, n, c in got if n] == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(2)
    a, b, c = text(rng), text(rng), text(rng)
    rows = [(5, a, "x"), (5, a, "x"), (5, b, "x"), (1, a + " end", "y"), (None, c, "z"), (None, c, "z"), (None, c + " end", "z"),
            (None, None, "z"), (None, "", "z"), (7, None, "z"), (9, c, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").withColumn("doc", F.lit("clash")).repartition(3)
    out = minhash.drop_near_duplicates(df)
    assert out.columns == df.columns
    kept = collections.Counter((r.doc_id, r.text) for r in out.collect())
    assert kept == collections.Counter([(1, a + " end"), (5, b), (9, c), (None, None), (None, ""), (7, None)])
    assert minhash.drop_near_duplicates(df.filter("false")).collect() == []


@pytest.mark.parametrize("block", [3, 1024])
def test_blocks_report_forests(spark, monkeypatch, block):
    """Many near copies of one text, most of which no hub is near to: the
    rows of the second round stay below the members of its lists."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, t) for i, t in crafted_copies(9)]
    seen = []
    confirm = minhash.cross_links

    def counted(crossing, labels, suspects, staging):
        members = crossing.select("key", "i", "j", F.explode(F.array("a", "b")).alias("rep")).distinct().count()
        seen.append((crossing.count(), members))
        return confirm(crossing, labels, suspects, staging)

    monkeypatch.setattr(minhash, "cross_links", counted)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == near_groups(rows)
    assert all(pairs <= members for pairs, members in seen)


def test_a_failed_candidate_leaves_no_link_behind():
    """A forest's pair that is no link must not hide another pair's link."""
    import pyarrow as pa
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(1, 2**63, 400, dtype=np.uint64)) for _ in range(2)]
    sets += [np.unique(np.concatenate([sets[0][:380], rng.integers(1, 2**63, 20, dtype=np.uint64)])),
             np.unique(np.concatenate([sets[0][60:], rng.integers(1, 2**63, 50, dtype=np.uint64)]))]
    table = pa.table({"rep": [0, 1, 2, 3], "component": [0, 1, 2, 3], "shingles": [s.tobytes() for s in sets],
                      "fine": [minhash.fine_signature(s) for s in sets]})
    links = {tuple(sorted(x.values())) for x in minhash._confirm(table).to_pylist()}
    assert links == {(0, 2), (0, 3)} or links == {(0, 2), (2, 3)}
    merged = table.set_column(1, "component", pa.array([5, 1, 5, 3]))  # what is together already is not reported again
    assert len(minhash._confirm(merged)) == 1


def members_of_components(spark):
    """Components {0, 1} and {2, 3} whose likeliest candidate, 0 and 2, fails,
    while 1 and 3 link: (lists, labels, members, suspects)."""
    rng = np.random.default_rng(9)
    random_set = lambda: np.unique(rng.integers(1, 2**63, 400, dtype=np.uint64))
    sets = [random_set() for _ in range(4)]
    sets[3] = np.unique(np.concatenate([sets[1][:380], sets[3][:20]]))
    fine = rng.integers(0, 256, (4, minhash.FINE), dtype=np.uint8)
    fine[2] = fine[0]
    fine[3, :400] = fine[1, :400]
    rows = [(r, 400, [5] * minhash.COORDINATES, bytearray(fine[r].tobytes()), r, 0.0, -1, bytearray(sets[r].tobytes()), 5)
            for r in range(4)]
    df = spark.createDataFrame(rows, "rep long, n_shingles long, sig array<int>, fine binary, hub long, far double, "
                                     "mask long, shingles binary, key long")
    labels = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (3, 2)], "id long, component long")
    return df.select("key", "rep", "n_shingles"), labels, df.drop("key"), df.select("rep", "sig", "mask", "fine", "shingles")


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_all_members_of_a_failed_tree_meet_again(spark, monkeypatch, block):
    """Also those whose pair the forest had no need of."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    lists, labels, members, suspects = members_of_components(spark)
    staging = minhash.Staging(spark, "test")
    crossing = minhash.cross_pairs(lists, labels, members, staging)
    pairs = {tuple(sorted((r.a, r.b))) for r in crossing.filter("a IS NOT NULL AND b IS NOT NULL").collect()}
    assert (0, 2) in pairs
    links = {tuple(sorted(r)) for r in minhash.cross_links(crossing, labels, suspects, staging).collect()}
    assert links == {(1, 3)}


def test_mixed_words_equal_the_plan(spark):
    """Also where a third of the rows share an id or have none."""
    rng = random.Random(4)
    rows = [((None if i % 3 == 0 else 7 if i % 3 == 1 else i), text(rng, rng.randrange(1, 30)), f"s{i % 4}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("taken", F.lit("clash"))
    words = lambda d: {r.source: r.n for r in d.groupBy("source").agg(
        F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    plan = {r.source: r.n for r in mixing.mix_plan(df).groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    out = mixing.mix(df)
    assert out.columns == df.columns and words(out) == plan


def test_vectors_of_every_length_are_compared(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows, i = [], 0
    for n, count in ((3, 90), (5, 40), (2, 6), (4, 1)):
        base = rng.normal(size=(4, n))
        for k in range(count):
            rows.append((i, [float(c) for c in base[k % 4] + rng.normal(size=n) * 0.1]))
            i += 1
    rows += [(0, [9.0, -1.0, 2.0]), (500, [1.0, 0.0]), (501, [1.0, 0.0, 0.0]), (502, [0.0, 0.0]), (None, [1.0, 0.0])]
    want = {}
    vec = [(k, np.array(v) / np.linalg.norm(v)) for k, v in rows if k is not None and np.linalg.norm(v) > 0]
    links = [[len(a) == len(b) and float(a @ b) >= 0.9 for _, b in vec] for _, a in vec]
    label = [k for k, _ in vec]
    for _ in vec:
        label = [min(label[y] for y in range(len(vec)) if x == y or links[x][y]) for x in range(len(vec))]
    want = sorted((k, sum(links[x]) - 1, label[x]) for x, (k, _) in enumerate(vec))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit("clash")).repartition(3)
    for shard in (1024, 30):  # every length one shard, and two of them clustered
        monkeypatch.setattr(embed, "SHARD", shard)
        got = embed.near_duplicate_vectors(df).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id not in (None, 502)) == want
        assert {(r.n_links, r.component_id) for r in got if r.vec_id == 502} == {(0, 502)}
        assert min(r.recall for r in got) >= 0.98
    alone = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert {r.recall for r in embed.near_duplicate_vectors(alone).collect()} == {None}


def test_lost_recall_fails(spark, monkeypatch):
    monkeypatch.setattr(embed, "search", lambda queries, nodes, lists, beam: np.zeros((len(queries), len(nodes)), bool))
    rows = [(i, [1.0, i / 1000]) for i in range(20)]
    with pytest.raises(RuntimeError, match="recall"):
        embed.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))


def test_pipeline_keeps_what_each_stage_kept(spark, tmp_path):
    """Every stage against its input, on rows with repeated and missing ids."""
    from tokenizers import Tokenizer
    rng = random.Random(8)
    rows = [(i, text(rng), "en", f"s{i % 3}") for i in range(60)]
    rows += [(3, rows[3][1], "en", "s0"), (3, text(rng), "en", "s1"), (100, rows[5][1] + " end", "en", "s2"),
             (None, rows[7][1], "en", "s1"), (None, text(rng), None, None), (101, None, "en", "s0"), (102, "", "en", None),
             (103, f"call 4111 1111 1111 1111 {text(rng)}", "en", "s2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df.withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rest = stages["toxicity"](spark, docs, str(tmp_path))
    assert rest.columns == docs.columns and rest.count() == len(rows)  # no toxic example: nothing to reject
    deduped = stages["near_dedup"](spark, rest, str(tmp_path)).collect()
    gone = collections.Counter((r[0], r[1]) for r in rows) - collections.Counter((r.doc_id, r.text) for r in deduped)
    assert gone == collections.Counter([(3, rows[3][1]), (100, rows[5][1] + " end"), (None, rows[7][1])])
    kept = spark.createDataFrame(deduped, docs.schema)
    hidden = stages["pseudonyms"](spark, kept, str(tmp_path)).collect()
    assert len(hidden) == len(deduped) and not any("4111 1111 1111 1111" in (r.text or "") for r in hidden)
    safe = spark.createDataFrame(hidden, docs.schema)
    mixed = stages["source_mix"](spark, safe, str(tmp_path))
    plan = mixing.mix_plan(safe).agg(F.sum("taken")).first()[0]
    assert mixed.agg(F.sum(F.size(F.split("text", " ")))).first()[0] == plan
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(tokenizer_path())
    expected = collections.Counter()
    for r in mixed.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                 hashlib.sha256(back.encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in whole) == expected
