"""Each operator on nulls, empty, long and repeated texts, empty tables and clashing columns."""
import importlib.util
from pathlib import Path

import pytest

from bursa.llm import (bpe_codec, decontaminate, lang_hd, lm_score, para_dedup, pii, quality_knn, quality_rules,
                       simhash, token_store)
from bursa.llm.common import scratch

_spec = importlib.util.spec_from_file_location("edge_rows", Path(__file__).with_name("conftest.py"))
_rows = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_rows)
ODD, CLASH = _rows.ODD, _rows.CLASH


def _labels(spark, rows=((1, 1), (2, 0), (4, 1), (4, 0), (6, 0), (7, None), (None, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int")


def _bench(spark, rows=((1, None), (2, ""), (None, "words without an id"), (3, "same text"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def _store(docs):
    path = scratch(docs.sparkSession, "edge")
    token_store.write(docs, path)
    return token_store.digests(token_store.read(docs.sparkSession, path))


ROW_WISE = {
    "op1": lambda d: decontaminate.contamination(d, _bench(d.sparkSession)),
    "op2": lambda d: lm_score.score(d),
    "op3": _store,
    "op4": pii.find,
    "op6": bpe_codec.round_trip,
    "op7": lambda d: quality_knn.score(d, _labels(d.sparkSession)),
    "op8": lambda d: quality_rules.judge(d, _labels(d.sparkSession)),
    "op9": simhash.near_duplicates,
    "op10": lang_hd.identify,
}


@pytest.mark.parametrize("name", ROW_WISE)
def test_one_row_per_row(make_docs, name):
    odd = make_docs(ODD, CLASH)
    got = ROW_WISE[name](odd).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
    same = {tuple(round(v, 4) if isinstance(v, float) else v for k, v in r.asDict().items()
                  if k not in ("doc_id", "held_out", "start")) for r in got if r.doc_id in (4, 5)}
    assert len(same) == 1  # equal texts, equal results
    assert ROW_WISE[name](make_docs([])).collect() == []


def test_empty_labels_and_benchmark(spark, make_docs):
    docs = make_docs(ODD)
    assert {r.score for r in quality_knn.score(docs, _labels(spark, [])).collect()} == {0.5}
    assert {r.probability for r in quality_rules.judge(docs, _labels(spark, [])).collect()} == {0.5}
    assert not any(r.contaminated for r in decontaminate.contamination(docs, _bench(spark, [])).collect())


def test_paragraphs_edges(make_docs):
    line = " ".join(f"w{k}" for k in range(60))
    rows = [*ODD, (20, line), (20, line), (21, f"{line}\n{line}"), (None, line)]
    got = para_dedup.repeated(make_docs(rows, CLASH)).collect()
    own = [r for r in got if r.n_words == 60]
    assert len(own) == 5 and {r.n_group for r in own} == {5}
    assert {(r.group_doc_id, r.group_paragraph) for r in own} == {(20, 0)}
    assert sum(r.removed for r in own if r.doc_id in (21, None)) == 3
    assert para_dedup.repeated(make_docs([])).collect() == []


def test_filters_keep_columns(spark, make_docs):
    docs = make_docs(ODD, CLASH)
    kept = {}
    for name, out in (("quality", quality_knn.accepted(docs, _labels(spark))), ("dedup", simhash.keep_one(docs)),
                      ("clean", decontaminate.clean_documents(docs, _bench(spark))), ("pii", pii.mask(docs))):
        assert out.columns == docs.columns
        rows = out.collect()
        assert {r.key for r in rows} <= {7}
        kept[name] = [r.doc_id for r in rows]
    assert kept["dedup"].count(4) == 1 and 5 not in kept["dedup"]
    assert {4, 5}.isdisjoint(kept["clean"]) and len(kept["pii"]) == len(ODD)


def test_one_row_per_component(make_docs):
    def text(k, n=80):
        return " ".join(f"t{k}w{j}" for j in range(n))

    rows = [(None, text(1)), (None, text(2)), (None, text(2)), (7, text(3)), (7, text(4)), (7, text(4)),
            (3, text(5)), (None, text(5)), (7, text(5)), (8, text(4))]
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(make_docs(rows, CLASH)).collect()]
    assert sorted(kept, key=str) == sorted([(None, text(1)), (None, text(2)), (7, text(3)), (7, text(4)), (3, text(5))],
                                           key=str)


def test_passages_edges(make_docs):
    line = " ".join(f"w{k}" for k in range(60))
    got = para_dedup.repeated_anywhere(make_docs([*ODD, (20, line), (20, line), (None, line), (None, line)], CLASH)).collect()
    own = [r for r in got if r.n_words == 60]
    assert len(own) == 4 and sum(r.removed for r in own) == 3 and {r.group_doc_id for r in own} == {20}
    assert {(r.removed, r.n_words) for r in got if r.doc_id == 7} == {(False, 50), (True, 299_999)}
    assert para_dedup.repeated_anywhere(make_docs([])).collect() == []


def _odd_tables(spark, make_docs, path, rows):
    make_docs(rows).write.parquet(f"{path}/documents.parquet")
    _labels(spark).write.parquet(f"{path}/labels.parquet")
    _bench(spark).write.parquet(f"{path}/benchmark.parquet")


def test_pipeline_on_odd_rows_and_an_empty_table(spark, make_docs, tmp_path):
    import corpus_pipeline
    _odd_tables(spark, make_docs, f"{tmp_path}/odd", ODD)
    got = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    kept = [r.doc_id for r in got]
    assert set(kept) <= {i for i, _ in ODD} and 4 not in kept and 5 not in kept  # a benchmark item
    assert sum(i in (1, 2, 3) for i in kept) <= 1  # texts without words are one group
    _odd_tables(spark, make_docs, f"{tmp_path}/none", [])
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_spans_and_lookup_on_odd_rows(spark, make_docs):
    cut = {}
    for r in decontaminate.without_spans(make_docs(ODD, CLASH), _bench(spark)).collect():
        cut.setdefault(r.doc_id, []).append(r.text)
    assert cut[1] == [None] and cut[2] == [""] and cut[4] == ["", ""] and cut[5] == [""] and cut[8] == ["x" * 200_000]
    path = scratch(spark, "odd")
    token_store.write(make_docs(ODD, CLASH), path)
    found = token_store.lookup(spark, path, [1, 4, 7, 99]).collect()
    assert sorted(r.doc_id for r in found) == [1, 4, 4, 7]
    assert {len(bytes(r.ids)) for r in found if r.doc_id == 1} == {4}  # only the end


def test_texts_without_words(make_docs):
    """What null, empty and blank texts give, by operator."""
    docs = make_docs([(1, None), (2, ""), (3, " \n\t ")])
    for r in lm_score.score(docs).collect():
        assert (r.n_tokens, r.n_rare) == (1, 0) and r.score <= 0 and r.base_score <= 0
    assert {(r.n_tokens, r.n_split) for r in bpe_codec.round_trip(docs.where("doc_id < 3")).collect()} == {(0, 0)}
    assert {r.fingerprint for r in simhash.near_duplicates(docs).collect()} == {"0" * 16}
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {1}
    assert {(r.lang_pred, r.score) for r in lang_hd.identify(docs).collect()} == {("und", 0.0)}
    assert {(r.spans, r.n_added) for r in pii.find(docs).collect()} == {("", 0)}
    assert {(r.n_words, r.kept) for r in quality_rules.judge(docs, _labels(docs.sparkSession)).collect()} == {(0, False)}
