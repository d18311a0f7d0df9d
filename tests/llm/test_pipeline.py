"""The pipeline stage by stage against brute force on the smallest tables."""

import corpus_pipeline as P
from cairnflow.llm.common import written

from .test_operators import brute_join, brute_quality, check_packing, hf

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), name)
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept[name] <= {r.doc_id for r in before.select("doc_id").collect()}
        if name != "pack_sequences":
            assert docs.columns == P.COLUMNS
            last = docs
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for i, t in texts.items():
        n, _, _, _, repeated = brute_quality(t)
        assert not (n < 50 or 100 * repeated > 50 * n) or i not in kept["quality_rules"]
    ids = sorted(kept["language_id"])
    root = brute_join([texts[i] for i in ids])
    assert kept["near_duplicates"] == {ids[i] for i, _, r in root if i == r}
    mixed = [r.text for r in last.orderBy("doc_id").collect()]
    place = {r.doc_id: k for k, r in enumerate(last.orderBy("doc_id").collect())}

    class Row(dict):
        __getattr__ = dict.__getitem__

    rows = [Row(r.asDict() | {"doc_id": place[r.doc_id]}) for r in docs.collect()]
    check_packing(rows, mixed, hf())


def test_stages_with_odd_rows(spark):
    """Nulls in every column, empty and long texts, repeated rows and extra columns; and an empty table."""
    prose = "the of and to in is that it was for on are with as his they be at one have this from or had by hot word but what some we can out other were all there when up use your how said an each she "
    prose += " ".join(prose.split()[::-1]) + " "
    rows = [(1, prose + "one two", "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (4, prose + "three four", None, None, None), (1, prose + "one two", "en", "s", 1), (5, "w " * 40_000, "en", "s", 1)]
    other = " ".join(f"{a}{b}en" for a in ("der", "und", "ein", "nicht", "von", "mit", "auf") for b in "abcdefghijklm")
    rows += [(10 + i, f"{other} {'abcdefghij'[i]}lich", "de", None, 5) for i in range(6)]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string, tokens double")
    for name, stage in P.STAGES:
        out = written(stage(spark, docs, SF), name)
        assert stage(spark, docs.limit(0), SF).count() == 0
        ids = [r.doc_id for r in out.collect()]
        if name != "pack_sequences":
            assert out.columns == P.COLUMNS
        assert set(ids) <= {r[0] for r in rows}
        if name == "quality_rules":
            assert sorted(ids) == sorted([1, 1, 4, *range(10, 16)])
        if name == "language_id":
            assert ids.count(1) in (0, 2) and not {2, 3} & set(ids)
        if name == "near_duplicates":
            assert ids.count(1) == 2 and {2, 3, 5} <= set(ids) and 4 not in ids and sum(i >= 10 for i in ids) == 1
        if name == "mix_sources":
            assert {2, 3} <= set(ids)  # no words: no weight to give
        if name == "pack_sequences":
            assert set(ids) == {r[0] for r in rows} and ids.count(1) == 2
