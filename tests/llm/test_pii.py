import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casewatch.llm.pii import KINDS, find_pii, identifiers, masked, scan
from casewatch.llm.spans import Mapped, Span, added, digest, joined

from .helpers import ODD, docs


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain(text):
    """The base by its patterns, word for word."""
    def n_digits(m):
        return len(re.sub("[^0-9]", "", m[0]))
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= n_digits(m) <= 19 and luhn(re.sub("[^0-9]", "", m[0]))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= n_digits(m) <= 15),
    ]
    return sorted(Span(m.start(), k, m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m))


@settings(max_examples=400, deadline=None)
@given(st.text("0123459@.+- ()aZ_é\n", max_size=60))
def test_base_spans(text):
    assert sorted(identifiers(text)) == plain(text)


@pytest.mark.parametrize("text", ["a@b.c@d.e x.@y.z", "300.1.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255", "4111 1111-1111 1111 4111111111111112 0-0000000000000",
                                  "+1 (499) 555-6503+4(0)123456789 +1 2", "@@a@b-.c..d@e.f-g", "1" * 5000 + "." + "2" * 5000])
def test_base_spans_of_hard_texts(text):
    assert sorted(identifiers(text)) == plain(text)


@pytest.mark.parametrize(("text", "kind", "source"), [
    ("x jo dot doe at example dot com y", "email", "jo dot doe at example dot com"),
    ("jane [at] mail (dot) example [dot] org!", "email", "jane [at] mail (dot) example [dot] org"),
    ("mail ј0е@ехаmple.com now", "email", "ј0е@ехаmple.com"),
    ("jo​e@exa­mple.com", "email", "jo​e@exa­mple.com"),
    ("é call plus one five five five one two three four five six seven now", "phone", "plus one five five five one two three four five six seven"),
    ("card " + " ".join(["four"] + ["one"] * 15) + " ok", "card", " ".join(["four"] + ["one"] * 15)),
    ("192 dot 168 dot 1 dot 20", "ip", "192 dot 168 dot 1 dot 20"),
    ("１９２．168.1.1", "ip", "１９２．168.1.1"),
])
def test_disguises_map_back(text, kind, source):
    base, more = scan(text)
    assert base == [] and [(KINDS[s.kind], text[s.start:s.end]) for s in more] == [(kind, source)]


@pytest.mark.parametrize(("kind", "source"), [
    ("ip", "one nine two dot one six eight dot zero dot one"), ("ip", "one nine two . one six eight . zero . one"), ("ip", "192 dot one six eight dot 0 dot one"),
    ("phone", "+1 415 five five five 0199"), ("phone", "plus one (four one five) five five five zero one nine nine"),
    ("phone", "plus one four one five five five five\n  zero one nine nine"), ("card", "four one one one\n" + "one one one one\n" * 2 + "one one one one"),
    ("card", "four. one. " + "one. " * 13 + "one"), ("card", "4111 one one one one 1111 one one one one"),
    ("ip", "\u0661\u0669\u0662.168.1.1"), ("ip", "\u06f1\u06f9\u06f2.168.1.1"), ("ip", "\u0967\u096f\u0968.168.1.1"), ("ip", "\ua9d1.2.3.4"),
    ("email", "jo" + " dot x" * 12 + " at mail" + " dot y" * 12 + " dot org"), ("email", "jo\ufe6bmail.org"),
], ids=range(15))
def test_more_disguises_map_back(kind, source):
    text = f"é {source}, ok"
    base, more = scan(text)
    assert base == [] and [(KINDS[s.kind], text[s.start:s.end]) for s in more] == [(kind, source)]


def test_long_chains_end():
    for chain in ("a dot " * 40_000, "one. " * 40_000, "a.b" * 40_000 + " dot ", "1 two, " * 40_000):
        assert scan(chain)[1] == []


@pytest.mark.parametrize("text", ["see you at noon. dot the i", "we met at example.com yesterday", "one two three", "at the dot on the map", "five of six – seven"])
def test_prose_is_left_alone(text):
    assert scan(text) == ([], [])


def test_base_stays_beside_added():
    text = "a@b.co and c [at] d [dot] org"
    base, more = scan(text)
    assert base == plain(text) and [text[s.start:s.end] for s in more] == ["c [at] d [dot] org"]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=30), st.data())
def test_map_of_edits(text, data):
    edits, at = [], 0
    while at < len(text) and data.draw(st.booleans()):
        a = data.draw(st.integers(at, len(text)))
        b = data.draw(st.integers(a, len(text)))
        if b > a:
            edits.append((a, b, data.draw(st.text("XY", max_size=3))))
        at = max(b, at + 1)
    m = Mapped(text, edits)
    for i, c in enumerate(m.text):
        a, b = m.source_span(i, i + 1)
        assert m.edited(i, i + 1) == (c in "XY") or any(not new for _, _, new in edits)
        assert text[a:b] == c if c in "abc" else (a, b) in {e[:2] for e in edits}


def test_added_spans_do_not_overlap():
    assert added([Span(5, 0, 9)], [Span(0, 0, 6), Span(0, 1, 6), Span(9, 0, 12), Span(10, 0, 11)]) == [Span(0, 1, 6), Span(9, 0, 12)]


@pytest.mark.parametrize(("text", "base_source", "source"), [
    ("mail jo\u200bhn@example.com now", "hn@example.com", "jo\u200bhn@example.com"),
    ("jane dot doe@example.com", "doe@example.com", "jane dot doe@example.com"),
    ("x@exam.pl\u0435.org", "x@exam.pl", "x@exam.pl\u0435.org"),
    ("+1 415 555 019\u200b9 12", "+1 415 555 019", "+1 415 555 019\u200b9 12"),
])
def test_a_fuller_span_stands_beside_the_base_one(text, base_source, source):
    base, more = scan(text)
    assert base == plain(text) and [text[s.start:s.end] for s in base] == [base_source]
    assert [text[s.start:s.end] for s in more] == [source]


@pytest.mark.parametrize("text", ["call +14155550199 one more time", "call +1 415 555 0199 one two three four five"])
def test_words_after_a_number_do_not_make_it_fuller(text):
    base, more = scan(text)
    assert base == plain(text) and len(base) == 1 and more == []


@pytest.mark.parametrize(("kind", "source"), [
    ("email", "john     (at)     example     (dot)     com"), ("email", "jo" + " " * 40 + "at" + " " * 40 + "mail" + "\t" * 9 + "dot" + " " * 9 + "org"),
    ("card", "\uff14\uff11\uff11\uff11" + "\u3000\uff11\uff11\uff11\uff11" * 3), ("card", "4111\u20021111\u20051111\u205f1111"),
    ("phone", "plus     one" + "     five" * 10), ("ip", "192     dot     168  dot     1     dot     20")])
def test_blanks_of_any_kind_and_number(kind, source):
    base, more = scan(f"é {source}, ok")
    assert base == [] and [(KINDS[s.kind], f"é {source}, ok"[s.start:s.end]) for s in more] == [(kind, source)]


@pytest.mark.parametrize("text", ["a" + " " * 300_000 + "at b dot c", "a at" + " " * 300_000 + "b dot c.", "one" + " " * 300_000 + "two", "( " * 100_000 + " dot "])
def test_long_runs_of_blanks_end(text):
    assert len(scan(text)[1]) <= 1


def test_table(spark):
    rows = [*ODD, (20, "mail a@b.co, 1.2.3.4 and c [at] d [dot] org", "en", "s", 1)]
    got = find_pii(docs(spark, rows, clashing=True)).collect()
    want = sorted(((r[0], joined(plain(r[1] or ""), KINDS)) for r in rows), key=str)
    assert sorted(((r.doc_id, ",".join(x for x in r.spans.split(",") if not x.startswith("email:25"))) for r in got), key=str) == want
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].spans == "" and by_id[1].base_sha256 == digest("")
    assert (by_id[20].n_email, by_id[20].n_ip, by_id[20].n_added) == (1, 1, 1)
    assert find_pii(docs(spark, [])).collect() == []


def test_mask(spark):
    rows = [(1, "to a@b.co or c [at] d [dot] org", "en", "s", 1), (2, None, "en", "s", 1)]
    rows += [(3, "jo\u200bhn@example.com, x@exam.pl\u0435.org.", "en", "s", 1)]
    assert {r.doc_id: r.text for r in masked(docs(spark, rows)).collect()} == {1: "to [email] or [email]", 2: None, 3: "[email], [email]."}
