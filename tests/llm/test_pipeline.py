import corpus_pipeline as P
from helpers import CLASH, docs, odd_rows

from claimlens.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from claimlens.llm.common import stored, table
from claimlens.llm.queries import oracle_sql, queries

DIR = "/root/testdata/sf0.001"


def test_stages_call_the_operators_in_order(spark):
    t = lambda name: table(spark, DIR, name)
    docs = stored(toxicity.keep_clean(t("documents"), t("labels")), "t")
    assert docs.count() < t("documents").count()
    docs = stored(line_dedup.dedup_lines(docs, keep_columns=True), "t")
    docs = stored(near_dedup.drop_near_copies(docs), "t")
    docs = stored(decontaminate.drop_contaminated(docs, t("benchmark")), "t")
    by_hand = packing.best_fit_pack(docs)
    same = ("doc_id", "piece", "start", "length", "ids_crc32")
    rows = lambda df: sorted(tuple(r) for r in df.select(*same).collect())
    assert rows(P.run(spark, DIR)) == rows(by_hand)


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    rows = docs(spark, odd_rows(), CLASH)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, rows, DIR)
        assert out.dtypes == rows.dtypes, name
        assert out.count() <= rows.count()
        assert stage(spark, docs(spark, []), DIR).count() == 0
    assert P.STAGES[-1][1](spark, docs(spark, []), DIR).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as E
    names = [f"op{n}" for n in range(1, 14)]
    assert sorted({q.split("_")[0] for q in queries()}) == sorted(names)
    assert set(queries()) <= set(E.queries()) and "pipeline" in E.queries()
    assert set(oracle_sql()) <= set(queries())
