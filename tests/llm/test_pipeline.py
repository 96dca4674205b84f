"""The pipeline stage by stage against what each stage's operator decides."""

from __future__ import annotations

import uuid

import corpus_pipeline
from pyspark.sql import functions as F

from folioquarry.llm import common, op02_jaccard, op06_mixing, op10_line_dedup
from folioquarry.llm.common import WORD

from . import force
from .helpers import WORD as WORDS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_hand_on_documents(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = common.written(stage(spark, docs, sf_dir))
        if name == "language_id":
            assert {r[0] for r in docs.select("doc_id").collect()} - {r[0] for r in out.select("doc_id").collect()} == {r[0] for r in docs.where(~F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))).select("doc_id").collect()}
        elif name == "line_dedup":
            expected = op10_line_dedup.dedup_lines(docs).where((F.col("removed_lines") == 0) | F.col("text").rlike(WORD))
            assert sorted(map(tuple, out.select("doc_id", "text").collect())) == sorted(map(tuple, expected.select("doc_id", "text").collect()))
        elif name == "jaccard_join":
            groups = op02_jaccard.jaccard_components(docs, 5, 80)
            assert out.count() == groups.select("component_id").distinct().count()
        elif name == "mixing":
            plan = op06_mixing.mix_plan(docs)
            assert out.count() == plan.agg(F.sum("times")).first()[0]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert sorted(out.columns) == sorted(COLUMNS)
        docs = out
    assert 0 < docs.count() < 2 * before
    assert docs.where(F.size("ids") == 0).where(F.length("text") > 0).isEmpty()


def test_run_equals_stages(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, sf_dir))
    ran = corpus_pipeline.run(spark, sf_dir)
    key = F.xxhash64("doc_id", "text", "ids").alias("k")
    assert sorted(r[0] for r in ran.select(key).collect()) == sorted(r[0] for r in docs.select(key).collect())


def test_small_tables_are_counted_as_they_are_written(spark):
    """A table that may be broadcast costs one job, its write, and is marked only within its bounds; an empty table is small."""

    def made(df, *bounds):
        group = f"small-{uuid.uuid4().hex}"
        spark.sparkContext.setJobGroup(group, group)
        out = common.written_small(df, *bounds)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        return out, jobs, "ResolvedHint" in out._jdf.queryExecution().analyzed().toString()

    rows = spark.range(100).select("id", F.repeat(F.lit("x"), 50).alias("text"), F.array(F.struct(F.lit("y").alias("z"))).alias("list"))
    out, jobs, marked = made(rows)
    assert jobs == 1 and marked and sorted(map(tuple, out.collect())) == sorted(map(tuple, rows.collect()))
    assert [made(rows, *bounds)[2] for bounds in ((100,), (99,), (100, 100 * 50))] == [True, False, False]
    out, _, marked = made(rows.where("id < 0"))
    assert marked and out.count() == 0 and out.columns == rows.columns


def test_a_level_of_lines_is_a_query_of_its_own(spark, monkeypatch):
    """No plan of line dedup grows with the levels of doubling: with twice as many of them, the largest query written has no more joins."""

    def most_joins(levels: int) -> int:
        text = "\n".join(f"w{i}" for i in range(2**levels + 2))
        docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
        plans = []
        real = op10_line_dedup.written
        monkeypatch.setattr(op10_line_dedup, "written", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().analyzed().toString().count("Join ")), real(df, *a, **k))[1])
        op10_line_dedup.deletions(docs, 2**levels)
        monkeypatch.setattr(op10_line_dedup, "written", real)
        return max(plans)

    assert most_joins(4) == most_joins(2)


def test_pipeline_by_force(spark, tmp_path):
    """Every row of the pipeline, by plain Python versions of its stages."""
    import random
    from collections import Counter

    import sentencepiece

    from folioquarry.llm import op05_sentencepiece

    r = random.Random(21)
    words = {"en": "the of and house water stone river under light over".split(), "de": "der und von haus wasser stein fluss unter licht weit".split(), "fr": "le et de maison eau pierre fleuve sous clair loin".split()}
    passage = [" ".join(f"passage{k}x{j}" for j in range(18)) for k in range(6)]
    rows = []
    for i in range(70):
        lang = r.choice(list(words))
        lines = [" ".join(r.choice(words[lang]) + r.choice(["", "s", "en"]) for _ in range(r.randint(8, 25))) for _ in range(r.randint(3, 8))]
        if i % 4 == 0:
            at = r.randint(0, 2)
            lines[1:1] = passage[at : at + r.randint(2, 4)]
        rows.append((i * 3, "\n".join(lines), lang if i % 5 else None, r.choice(["web", "books", None, "news", "web"])))
    rows += [(500 + i, rows[i][1].replace("water", "waters", 1), rows[i][2], rows[i][3]) for i in range(0, 30, 3)]
    rows += [(600, "12 34 !!", "en", "web"), (601, None, "en", "web"), (602, "\n".join(passage), "en", "books"), (603, rows[5][1], None, "news"), (604, "", None, "web")]
    documents_ = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    documents_.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))

    left = [row for row in rows if row[1] is not None and any(c.isalpha() for c in row[1])]
    edited = force.without_repeats(left)
    left = [(i, edited[i][0], lang, s) for i, _, lang, s in left if not edited[i][1] or WORDS.search(edited[i][0])]
    groups = force.components(left, 5, 80)
    left = [row for row in left if groups[row[0]][1] == row[0]]
    times = force.mixture(left)
    sp = sentencepiece.SentencePieceProcessor(model_file=op05_sentencepiece.MODEL_PATH)
    expected = Counter({(i, text, lang, s, tuple(sp.encode(text))): times[i] for i, text, lang, s in left if times[i]})
    got = Counter((x.doc_id, x.text, x.lang, x.source, tuple(x.ids)) for x in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert len(expected) > 40 and any(e[1] for e in edited.values()) and len(groups) > len(left)
    assert got == expected


def test_clashing_columns(spark, tmp_path):
    """Stages keep further columns, whatever their names."""
    from .helpers import awkward, clashing, documents

    docs = clashing(documents(spark, awkward()))
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, str(tmp_path)))
        assert docs.where("size <> 'mine' or rank <> 'mine' or score <> 'mine' or removed_lines <> 'mine' or t <> 'mine'").isEmpty(), name


def test_empty_documents(spark, tmp_path):
    from .helpers import documents

    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, str(tmp_path)))
        assert docs.count() == 0


def test_awkward_documents(spark, tmp_path):
    from .helpers import awkward, documents

    docs = documents(spark, awkward())
    for _, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, str(tmp_path)))
    assert {r.doc_id for r in docs.collect()} <= {r[0] for r in awkward()}
