"""The pipeline against its stages' rules worked out in plain Python."""

import random
import re
from collections import Counter

import corpus_pipeline
from kpiloom.llm import lines, minhash
from tests.compare import compare, duck


def test_stages_return_documents_until_the_last(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        assert docs.count() > 0


def test_run_is_its_stages_in_turn(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    once = corpus_pipeline.run(spark, sf_dir)
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(map(tuple, docs.select(*key).collect())) == Counter(map(tuple, once.select(*key).collect()))


def test_first_three_stages_by_hand(spark, documents, prose, sf_dir):
    rng = random.Random(1)
    rows = [(i, f"{prose(i, 70)}\n{prose(1000 + i, 30)}", "en", rng.choice("ab")) for i in range(40)]
    rows += [(100 + i, rows[i][1], "en", "a") for i in range(10)]  # copies
    rows += [(200 + i, f"{rows[i][1]}\n{prose(2000 + i, 12)}", "en", "a") for i in range(5)]  # a line more
    rows += [(300, "too short", "en", "a"), (301, None, None, None), (302, "", "en", "a"), (303, "the same words " * 60, "en", "b")]
    docs = documents(rows)

    good = corpus_pipeline.quality_rules(spark, docs, sf_dir)
    assert {r.doc_id for r in good.collect()} == {r[0] for r in rows if r[0] < 300}

    left = {r.doc_id: r for r in corpus_pipeline.line_dedup(spark, good, sf_dir).collect()}
    assert set(left) == {r[0] for r in rows if r[0] < 300 and not 100 <= r[0] < 200}
    assert all(left[200 + i].text == prose(2000 + i, 12) and left[200 + i].n_chars == len(left[200 + i].text) for i in range(5))
    assert all(left[i].text == rows[i][1] and left[i].row == "x" for i in range(40))

    near = documents([(1, prose(1, 200)), (2, prose(1, 200) + " end"), (3, prose(2, 200)), (4, None), (None, prose(1, 200)), (None, prose(7, 200)), (None, prose(7, 200) + " end")])
    assert Counter(r.doc_id for r in corpus_pipeline.near_dedup(spark, near, sf_dir).collect()) == Counter([1, 3, 4, None])


def test_near_stage_keeps_one_row_of_each_group_at_080(spark, documents, prose, sf_dir):
    words = prose(1, 204).split()
    # Of 200 shingles each, 178 and 176 are in both: similarities of 0.802 and 0.786.
    near = {n: " ".join(words[: 204 - n] + [f"new{i}" for i in range(n)]) for n in (22, 24)}
    rows = [(1, " ".join(words)), (2, near[22]), (10, prose(2, 100)), (10, prose(2, 100)), (11, prose(3, 100)), (11, prose(4, 100))]
    rows += [(None, prose(5, 100)), (None, prose(5, 100)), (None, prose(5, 100) + " end"), (None, prose(6, 100)), (20, None)]
    left = corpus_pipeline.near_dedup(spark, documents(rows), sf_dir).collect()
    assert Counter(r.doc_id for r in left) == Counter([1, 10, 11, 11, None, None, 20])
    left = corpus_pipeline.near_dedup(spark, documents([(1, " ".join(words)), (3, near[24])]), sf_dir).collect()
    assert {r.doc_id for r in left} == {1, 3}
    assert (1 - 0.8**6) ** minhash.bands_for(corpus_pipeline.SIMILAR) <= 5e-5 and minhash.bands_for(85) <= minhash.BANDS


def test_mix_stage_repeats_documents(spark, documents, prose, sf_dir):
    rows = [(i, prose(i, 10 + i % 50), "en", "abc"[i % 3]) for i in range(150)]
    out = corpus_pipeline.mix_sources(spark, documents(rows), sf_dir).collect()
    assert max(Counter(r.doc_id for r in out).values()) <= 2
    words = sum(len(re.findall(r"\S+", r.text)) for r in out)
    total = sum(len(r[1].split()) for r in rows)
    assert abs(words - 1.5 * total) < 0.02 * total


def test_registered_oracles(spark, sf_dir):
    from kpiloom.llm.oracle import ORACLE
    from kpiloom.llm.queries import QUERIES

    connection = duck(sf_dir)
    for name, sql in ORACLE.items():
        assert compare(QUERIES[name](spark, sf_dir), connection, sql) is None


def test_blank_lines_stay(spark, documents):
    docs = documents([(1, "a\n\nb\n\n"), (2, "\n\na\nc")])
    got = {r.payload.doc_id: r.kept_text for r in lines.without_repeated_lines(docs, ["doc_id"]).collect()}
    assert got == {1: "a\n\nb\n\n", 2: "\n\nc"}


EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


def test_every_stage_takes_an_empty_table(spark, sf_dir, tmp_path):
    none = spark.createDataFrame([], EMPTY)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, none, sf_dir)
        assert left.columns == none.columns and left.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, none, sf_dir).count() == 0
    none.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_stage_takes_long_texts_and_clashing_names(spark, prose, sf_dir):
    """A text of some megabytes, and further columns named as the stages name theirs."""
    long = "\n".join(prose(k, 40) for k in range(9000))
    rows = [(1, long, "en", "a", len(long)), (2, prose(99999, 100), "en", "a", 9), (3, long + "\nmore", None, None, None)]
    clashing = ("row", "key", "hash", "component", "payload", "kept", "copy", "words", "line")
    docs = spark.createDataFrame([(*r, *["x"] * len(clashing)) for r in rows], ", ".join([EMPTY, *(f"{c} string" for c in clashing)]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, sf_dir)
        assert left.columns == docs.columns, name
        assert all(r[c] == "x" for r in left.collect() for c in clashing), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 100
