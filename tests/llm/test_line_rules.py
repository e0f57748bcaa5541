import random

from casewatch.llm.line_rules import quality_rules, repeated_words, without_common_lines

from .helpers import ODD, docs, words


def slow_repeats(w):
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    return len({i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)})


def test_repeated_words():
    rng = random.Random(1)
    for n in (0, 4, 5, 6, 40, 200):
        for v in (1, 2, 3, 50):
            w = [b"%d" % rng.randrange(v) for _ in range(n)]
            assert repeated_words(w) == slow_repeats(w), (n, v)


def brute(rows, share, least, most=100):
    hosts, of_line = {}, {}
    norm = lambda x: " ".join(x.encode().split() and [w.decode() for w in x.encode().lower().split()])
    for i, r in enumerate(rows):
        hosts[r[3]] = hosts.get(r[3], 0) + 1
        for x in (r[1] or "").split("\n"):
            if x.encode().split():
                of_line.setdefault((r[3], norm(x)), set()).add(i)
    common = {k for k, v in of_line.items() if len(v) > most or len(v) > least and len(v) > share * hosts[k[0]]}
    out = []
    for r in rows:
        t = r[1] or ""
        lines = [x for x in t.split("\n") if x.encode().split()]
        w = t.encode().split()
        lost = [x for x in lines if (r[3], norm(x)) in common]
        left = len(w) - sum(len(x.encode().split()) for x in lost)
        rep = slow_repeats(w) if len(w) < 3000 else len(w)
        failed = len(w) < 10 or 100 * rep > 20 * len(w)
        out.append((r[0], len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), rep, failed,
                    left, len({norm(x) for x in lost}), not failed and left >= 10 and 2 * left >= len(w)))
    return sorted(out, key=str)


def made():
    rng = random.Random(2)
    rows = []
    for i in range(400):
        lines = [words(rng, rng.randrange(3, 12)) for _ in range(rng.randrange(0, 6))]
        if rng.random() < 0.5:
            lines.insert(0, "Subscribe  to OUR\tnewsletter " + words(random.Random(0), 12))
        if rng.random() < 0.3:
            lines += [lines[0], "# * | $"] if lines else []
        rows.append((i, "\n".join(lines), "en", rng.choice(["hot", "hot", "hot", "b", None]), 0))
    return rows


def collected(df):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.words_left, r.n_common_lines, r.kept)
                   for r in df.collect()), key=str)


def test_as_brute_force(spark):
    got = collected(quality_rules(docs(spark, made()), max_share=0.2, min_docs=5))
    assert got == brute(made(), 0.2, 5)
    assert any(r[8] and not r[6] and not r[9] for r in got) and any(r[8] and r[9] for r in got)  # depleted ones, and others


def test_a_limit_that_does_not_grow_with_the_host(spark):
    """A line in 9 % of a host is common by the number of its documents alone."""
    got = collected(quality_rules(docs(spark, made()), max_share=0.9, min_docs=5, max_docs=60))
    assert got == brute(made(), 0.9, 5, 60) and any(r[8] for r in got)
    assert not any(r[8] for r in collected(quality_rules(docs(spark, made()), max_share=0.9, min_docs=5, max_docs=400)))


def test_odd_rows(spark):
    assert collected(quality_rules(docs(spark, ODD, clashing=True), max_share=0.1, min_docs=1)) == brute(ODD, 0.1, 1)
    assert quality_rules(docs(spark, [])).collect() == []


def test_lines_are_removed(spark):
    got = {r.doc_id: r.text for r in without_common_lines(docs(spark, made()), max_share=0.2, min_docs=5).collect()}
    assert all("newsletter" not in t for t in got.values()) and sum(t != "" for t in got.values()) > 200
    assert {r.doc_id: r.text for r in without_common_lines(docs(spark, ODD)).collect()}[1] is None
