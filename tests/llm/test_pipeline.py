"""Pipeline stages, each against a plain statement of what it should keep."""

from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from brute import jaccard_join, remove_repeats, smallest_reachable
from pyspark.sql import functions as F

from joblens.llm import language, toxicity
from joblens.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120")
    odd = [(9000, None, None, "x", None), (9001, "", "en", None, 0), (9002, "12 34", "en", "x", 5), (None, "the and of the thing is here with others", "en", "x", 40)]
    return base.unionByName(spark.createDataFrame(odd, base.schema)).repartition(3)


def rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "jaccard", "suffix_dedup", "packing"]


def test_filters_drop_what_their_operator_rejects(spark, docs):
    labels = table(spark, SF, "labels", "doc_id", "toxic")
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns
    scored = toxicity.score(docs, toxicity.train(docs, labels), "toxic_score")
    assert rows(kept) == rows(scored.where(F.col("toxic_score") < toxicity.THRESHOLD))
    kept = corpus_pipeline.drop_unknown_language(spark, docs, SF)
    assert kept.columns == docs.columns
    found = language.predict(docs, language.train(docs))
    assert rows(kept) == rows(found.where((F.col("lang_pred") != "und") & (F.col("score") >= corpus_pipeline.LEAST_COSINE)))
    assert not {9000, 9001, 9002} & {r.doc_id for r in kept.collect()}


def test_one_document_of_each_group_stays(spark, docs):
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    every = [(r.doc_id, r.text) for r in docs.collect()]
    reach = jaccard_join([r for r in every if r[0] is not None])
    assert rows(kept) == Counter(r for r in every if r[0] is None or reach[r[0]][1] == r[0])


def near_copies():
    """Copies of 200 distinct words: 4 scattered changes, a changed block, 12 scattered changes."""
    for k, changed in enumerate([(), (20, 70, 120, 170), range(90, 107), range(10, 190, 15)]):
        yield 9100 + k, " ".join(f"x{k}y{i}" if i in changed else f"w{i}" for i in range(200))


def grams(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n, 0) + 1)} if w else set()


def test_near_duplicates_are_of_five_words_and_four_fifths(spark, docs):
    more = spark.createDataFrame([(d, t, "en", "x", 0) for d, t in near_copies()], docs.schema)
    every = [(r.doc_id, r.text) for r in docs.unionByName(more).where("doc_id is not null").collect()]
    sets = {d: grams(t) for d, t in every}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    reach = smallest_reachable(sets, links)
    assert [reach[9100 + k] for k in range(4)] == [9100, 9100, 9100, 9103]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.unionByName(more), SF)
    assert rows(kept.where("doc_id is not null")) == Counter(r for r in every if reach[r[0]] == r[0])


def test_one_row_of_equal_rows_stays(spark, docs):
    cols = [f.name for f in docs.schema]
    row = lambda d, t, source="x": tuple({"doc_id": d, "text": t, "lang": "en", "source": source, "n_chars": 1}[c] for c in cols)
    copies = [row(9200, "one row of these three", s) for s in "cab"] + [row(9200, "another text of this id")]
    copies += [row(None, "no id but a text")] * 2 + [row(None, None)] * 2 + [row(9201, None)] * 2 + [row(9202, "")] * 2
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(copies, docs.schema).repartition(4), SF).collect()
    got = Counter((r.doc_id, r.text) for r in kept)
    assert got == Counter({(r[cols.index("doc_id")], r[cols.index("text")]) for r in copies})
    assert [r.source for r in kept if r.text == "one row of these three"] == ["a"]


def test_columns_with_the_names_used_inside_go_along(spark, docs):
    names = ["_found", "_REPEATS", "_key", "Toxic_Score", "LANG_PRED", "Lang_score", "row", "runs", "crc", "tag", "doc", "ids", "tiles"]
    wide = docs.select("*", *(F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES:
        out, plain = stage(spark, wide, SF), stage(spark, docs, SF)
        if name == "packing":
            assert sorted(map(str, out.drop("sequence_id", "offset").collect())) == sorted(map(str, plain.drop("sequence_id", "offset").collect()))
        else:
            assert out.columns == wide.columns and rows(out) == rows(plain)
            assert all(r[n] == f"{n}:{'-' if r.doc_id is None else r.doc_id}" for r in out.collect() for n in names)


def test_repeats_are_cut(spark, docs):
    cut = corpus_pipeline.cut_repeats(spark, docs, SF)
    assert cut.columns == docs.columns and cut.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    want = remove_repeats([(r.doc_id, r.text) for r in docs.collect()])
    before = {r.doc_id: r.text for r in docs.collect()}
    for r in cut.collect():
        if before[r.doc_id] is None:
            assert r.text is None and r.n_chars is None
        else:
            assert r.n_chars == len(r.text)
            n, removed, *_ = want[r.doc_id]
            # A cut can halve a character on each side of every span.
            assert n - removed - 6 * want[r.doc_id][2] <= len(r.text.encode()) <= n - removed


def test_run_packs_every_kept_document(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    seqs = defaultdict(list)
    for r in out:
        seqs[r.sequence_id].append((r.offset, r.length))
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert 100 < len({r.doc_id for r in out}) <= 200


def test_stages_on_an_empty_table(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_stages_read_texts_in_small_batches(spark, docs):
    """10,000 texts were one batch however long: with four copies of it an
    executor's memory went over its limit."""
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    long_texts = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("some words "), 4000).alias("text"))  # 17.6 MB
    for _, stage in corpus_pipeline.STAGES[:2]:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, docs, SF)
        got = long_texts.mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r.rows for r in got) == 400 and max(r.bytes for r in got) < 5 << 20
