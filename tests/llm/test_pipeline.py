from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD_TEXTS, docs_of, prose
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_near import brute as classes
from tests.llm.test_quality import brute as measures
from tests.llm.test_quality import mask_of
from tickwise.llm.common import stored
from tickwise.llm.pii import mask
from tickwise.llm.quality import CURRENT, POLICIES, bits


def brute(rows, items):
    """Texts that reach the packing stage, by id."""
    rows = [(i, t) for i, t in rows if not mask_of(measures(t)) & bits(POLICIES[CURRENT])]
    stay = {}
    labels, _ = classes(rows)
    first = {}
    for i, c, _links in labels:
        first[c] = min(first.get(c, i), i)
    for i, t in rows:
        if i in first.values():
            stay[i] = t
    found = hits(list(stay.items()), items)
    stay = {i: t for i, t in stay.items() if not (found[i][1] and 20 * found[i][1] >= found[i][0])}
    return {i: mask(t) for i, t in stay.items()}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = brute(rows, items)
    assert 0 < len(want) < len(rows)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_copies", "decontamination", "personal_data", "packing"]
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stored(stage(spark, at, SF_SMALL), f"test-{name}")
        assert at.schema == docs.schema
    assert {r.doc_id: r.text for r in at.collect()} == want
    pieces = corpus_pipeline.run(spark, SF_SMALL).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc, own in pieces.groupby("doc_id"):
        ids = np.frombuffer(b"".join(own.sort_values("start")["ids"]), dtype="<u4").tolist()
        assert ids == [*tokenizer.encode(want[doc], add_special_tokens=False).ids, 2]
    assert set(pieces.doc_id) == set(want)


def test_stages_take_awkward_rows_and_columns(spark):
    good = prose(1, 120, 5000)
    rows = [*enumerate(ODD_TEXTS), (20, good), (21, good), (None, prose(2, 90, 5000)), (22, prose(3, 90, 5000) + " a@b.org"), (22, prose(4, 90, 5000))]
    at = stored(docs_of(spark, rows), "test-docs")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = at
        at = stored(stage(spark, at, SF_SMALL), "test-stage")
        assert at.columns == before.columns and [f.dataType for f in at.schema] == [f.dataType for f in before.schema]
    out = {r.text: r for r in at.collect()}
    assert len(out) == 4 and out[good].doc_id == 20
    assert all(r.row == 7 and r["a.b"] == "x" and r.n_chars == len(r.text) for r in out.values())
    masked = next(r for t, r in out.items() if t.endswith("<EMAIL>"))
    assert masked.doc_id == 22
    assert corpus_pipeline.packing(spark, at, SF_SMALL).select("doc_id").distinct().count() == 3


def test_stages_take_no_rows(spark):
    at = stored(docs_of(spark, []).where(F.lit(True)), "test-empty")
    for _, stage in corpus_pipeline.STAGES:
        at = stored(stage(spark, at, SF_SMALL), "test-empty-stage")
        assert at.count() == 0
