from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import ODD_TEXTS, docs_of
from tickwise.llm.pii import KINDS, added_spans, all_spans, find_personal, joined, luhn, mask, mask_personal, plain_spans

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(EMAIL, text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(CARD, text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(PHONE, text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


@given(st.text(alphabet="ab@.-+ 014()%é\n", max_size=60))
@settings(max_examples=400, deadline=None)
def test_plain_spans_are_those_of_the_patterns(text):
    assert plain_spans(text) == brute(text)


@given(st.lists(st.sampled_from(["4111111111111111", "4111-1111 1111-1111", "1.2.3.4", "256.1.1.1", "+1 (555) 010-7713", "a@b.c", "@", ".", " ", "x", "+"]), max_size=8))
@settings(max_examples=300, deadline=None)
def test_plain_spans_of_joined_cases(parts):
    assert plain_spans("".join(parts)) == brute("".join(parts))


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" + " " * 200_000, "- " * 150_000, "at " * 100_000, "a dot " * 50_000, "a_at_" * 60_000, "x@" + "a dot " * 50_000, "one " * 100_000, "&#64;" * 50_000):
        plain = plain_spans(text)
        added_spans(text, plain)


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com"),
        ("ask john.doe at example dot org!", "email", "john.doe at example dot org"),
        ("call jo_at_mail_dot_org", "email", "jo_at_mail_dot_org"),
        ("x jo@mail dot example dot com.", "email", "jo@mail dot example dot com"),
        ("jo (at) mail.example.com", "email", "jo (at) mail.example.com"),
        ("jo&#64;mail&period;com", "email", "jo&#64;mail&period;com"),
        ("JO AT MAIL DOT COM", "email", "JO AT MAIL DOT COM"),
        ("ip 10 dot 0 dot 0 dot 1", "ip", "10 dot 0 dot 0 dot 1"),
        ("+1 five five five zero one zero one two three four", "phone", "+1 five five five zero one zero one two three four"),
        ("+44-20 seven nine four six zero nine five eight", "phone", "+44-20 seven nine four six zero nine five eight"),
        ("info (at) foo (dot) co (dot) uk", "email", "info (at) foo (dot) co (dot) uk"),
        ("to jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("jo​hn@ex.com", "email", "jo​hn@ex.com"),
        ("ｊａｎ＠ｗｅｂ．ｄｅ", "email", "ｊａｎ＠ｗｅｂ．ｄｅ"),
        ("host 192[.]168[.]1[.]10 x", "ip", "192[.]168[.]1[.]10"),
        ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
        ("card ４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("four one one one " + "one one one one " * 3, "card", ("four one one one " + "one one one one " * 3).strip()),
        ("call plus one two zero two five five five zero one two three ok", "phone",
         "plus one two zero two five five five zero one two three"),
        ("+49 ٣٠ ١٢٣٤٥٦٧٨", "phone", "+49 ٣٠ ١٢٣٤٥٦٧٨"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, found):
    spans = added_spans(text, plain_spans(text))
    assert [(KINDS[k], text[a:b]) for a, k, b in spans] == [(kind, found)]
    assert found not in mask(text) and f"<{kind.upper()}>" in mask(text)


@pytest.mark.parametrize(
    "text",
    ["look at the dot", "look at www.example.com", "see it at example.org now", "3 point 5", "cat-at-home", "dot dot dot", "a_dot_b", "one two three four five", "meet at noon dot", "version 1.2.3", "état à l'école, n° 5", "αβγ и кириллица", "at [x] (y)",
     "We arrived at this point the team left.", "He stopped at that point in time", "Look at this dot in the picture", "We met at gate point seven",
     "he looked at each dot and line", "she is at home dot"],
)
def test_clean_text_stays(text):
    assert plain_spans(text) == [] and added_spans(text, []) == [] and mask(text) == text


def test_tables(spark):
    texts = [*ODD_TEXTS, "a@b.c 1.2.3.4 and x [at] y [dot] com", "no", "no"]
    docs = docs_of(spark, [*enumerate(texts), (None, "q@r.s")])
    rows = {r.doc_id: r for r in find_personal(docs).withColumn("every", all_spans()).withColumn("base", joined("plain")).collect()}
    assert len(rows) == len(texts) + 1
    at = texts.index("a@b.c 1.2.3.4 and x [at] y [dot] com")
    assert rows[at].base == "email:0:5,ip:6:13"
    assert [tuple(s) for s in rows[at].every] == [("email", 0, 5), ("ip", 6, 13), ("email", 18, 36)]
    assert rows[0].plain == [] and rows[0].added == []
    masked = mask_personal(docs)
    assert masked.columns == docs.columns and [f.dataType for f in masked.schema] == [f.dataType for f in docs.schema]
    out = {r.doc_id: r for r in masked.collect()}
    assert out[at].text == "<EMAIL> <IP> and <EMAIL>" and out[at].n_chars == len(out[at].text)
    assert out[0].text is None and out[None].text == "<EMAIL>" and out[at]["a.b"] == "x"
    assert find_personal(docs_of(spark, [])).count() == 0 and mask_personal(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize(
    ("text", "masked"),
    [
        ("write john dot smith at example dot com now", "write <EMAIL> now"),
        ("john dot q dot smith [at] mail dot example dot com!", "<EMAIL>!"),
        ("jo at my-big-site dot org", "<EMAIL>"),
        ("jo at mail.example dot com", "<EMAIL>"),
        ("card 4111 1111 1111 111 one.", "card <CARD>."),
        ("card four 111 1111 1111 1111.", "card <CARD>."),
        ("call +1 555 010 77 one three", "call <PHONE>"),
        ("call +1 555 010 779 one", "call <PHONE> one"),
        ("host 10 dot 0 dot 0 dot one", "host <IP>"),
        ("card 4111 1111 1111 1111 two days", "card <CARD> two days"),
        ("4111 1111 1111 112 one", "4111 1111 1111 112 one"),
        ("we met at noon dot three 3 one", "we met at noon dot three 3 one"),
        ("jo arroba correo punto es", "<EMAIL>"),
        ("write jo@ex.com point taken", "write <EMAIL> point taken"),
    ],
)
def test_common_disguises_are_masked(text, masked):
    assert mask(text) == masked


def test_long_disguises_take_linear_time():
    for text in ("jo dot " * 30_000, "a at b-" * 20_000, "at-" * 30_000, "1 one " * 30_000, "x@ dot y " * 20_000):
        added_spans(text, plain_spans(text))
