from collections import Counter

import corpus_pipeline
from panelweave.llm import host_quality, line_runs, mixing, near_duplicates, packing
from panelweave.llm.shared import DOCUMENT_COLUMNS
from panelweave.session import stage
from tests.llm.conftest import SF
from tests.llm.test_documents import counted, plain_lines, words
from tests.llm.test_near_duplicates import grouped, plain


def test_stages(spark, given):
    docs = given("documents")
    functions = dict(corpus_pipeline.STAGES)
    assert list(functions) == ["quality", "lines", "duplicates", "mixture", "batches"]

    good = stage(functions["quality"](spark, docs, SF))
    verdict = {r["doc_id"]: counted(r["text"]) for r in docs.collect()}
    base = {i for i, (n, _, _, _, rep) in verdict.items() if n >= 50 and 100 * rep <= 50 * n}
    kept = {r["doc_id"] for r in good.collect()}
    assert kept <= base and good.columns == DOCUMENT_COLUMNS

    thin = stage(functions["lines"](spark, good, SF))
    rows = [(r["doc_id"], r["text"]) for r in thin.collect()]
    want = plain_lines([(r["doc_id"], r["text"]) for r in good.collect()])
    assert sorted(str(tuple(r)) for r in line_runs.digest(good).collect()) == want and len(rows) == len(kept)

    single = stage(functions["duplicates"](spark, thin, SF))
    components = grouped([i for i, _ in rows], [plain(t) for _, t in rows])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(components))

    mixed = stage(functions["mixture"](spark, single, SF))
    taken = {r["doc_id"]: r["taken"] for r in mixing.digest(single).collect()}
    got = Counter()
    for r in mixed.collect():
        got[r["doc_id"]] += len(words(r["text"]))
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in got.items() if v} and mixed.columns == DOCUMENT_COLUMNS

    last = functions["batches"](spark, mixed, SF).collect()
    assert Counter(r["doc_id"] for r in last) == Counter(r["doc_id"] for r in mixed.collect())
    assert sorted(map(str, last)) == sorted(map(str, corpus_pipeline.run(spark, SF).collect()))


def test_empty(spark, documents):
    docs = documents("x").filter("false")
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF))
    assert docs.count() == 0


def test_modules_are_the_operators():
    assert all(m.__doc__ for m in (host_quality, line_runs, near_duplicates, mixing, packing))
