from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import ODD_TEXTS, docs_of, prose
from tickwise.llm.quality import MEASURES, POLICIES, RULES, ablation, apply_policy, bits, ledger


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", t)),
        t.count("!"),
        t.count("\n") + 1,
        len(lines) - len(set(lines)),
        len(covered),
    )


def mask_of(measures):
    names = dict(zip(MEASURES, measures, strict=True))
    return sum(1 << i for i, rule in enumerate(RULES.values()) if eval(rule, {}, names))  # noqa: S307


def check(spark, texts):
    rows = ledger(docs_of(spark, list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert tuple(r[m] for m in MEASURES) == want
        assert r.failures == mask_of(want)
        assert (r.row, r["a.b"], r.text) == (7, "x", texts[r.doc_id])


def test_measures_and_mask(spark):
    check(spark, [*ODD_TEXTS, "a b c a b c", "a a a a", "x y x y x y x", "p\np\n \n \nq\np", "!! ## |", prose(1, 20000, 30), prose(2, 300)])


@given(st.lists(st.lists(st.sampled_from(["a", "b", "#", "!", "\n", " ", "\x0b"]), max_size=40).map(" ".join), min_size=1, max_size=6))
@settings(max_examples=15, deadline=None)
def test_measures_of_any_text(spark, texts):
    check(spark, texts)


def test_policies_and_ablation(spark):
    texts = [prose(i, 80) for i in range(6)] + [prose(9, 5), None, ("# " * 60), (prose(3, 30) + "\n") * 9, "! " * 100 + prose(4, 60)]
    rows = ledger(docs_of(spark, list(enumerate(texts))))
    masks = [r.failures for r in rows.collect()]
    for version, rules in POLICIES.items():
        kept = {r.doc_id for r in apply_policy(rows, version).collect() if r.kept is True}
        assert len(kept) == sum(not m & bits(rules) for m in masks)
        for r in ablation(rows, version).collect():
            one = bits((r.rule,))
            assert r.n_failed == sum(bool(m & one) for m in masks)
            assert r.n_only == sum(m & bits(rules) == one for m in masks)
            assert r.n_kept == len(kept)


def test_no_rows(spark):
    empty = ledger(docs_of(spark, []))
    assert empty.count() == 0 and ablation(empty).count() == 0
