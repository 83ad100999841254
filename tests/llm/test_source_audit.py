"""The divergence audit against sums over all terms in Python's integers."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import source_audit as sa
from tests.llm.conftest import ODD

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least):
    """rows: (text, lang, source)."""
    counts, seen, out = {}, {}, []
    for text, lang, source in rows:
        lang, source, terms = lang or "", source or "", TERM.findall(low(text))
        counts.setdefault(lang, {}).setdefault(source, Counter()).update(terms)
        seen.setdefault(lang, Counter()).update(set(terms))
    for lang, groups in counts.items():
        kept = {t for t, n in seen[lang].items() if n >= least}
        v = len(kept)
        n = {s: sum(c for t, c in own.items() if t in kept) for s, own in groups.items()}
        total = Counter()
        for own in groups.values():
            total.update({t: c for t, c in own.items() if t in kept})

        def p(c, n):
            return 1 + 10 ** 9 * (c + 5) // (n + 5 * v)
        for a, own in groups.items():
            value = [(b, sum(abs(p(own[t], n[a]) - p(groups[b][t], n[b])) for t in kept))
                     for b in groups if b != a]
            value.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, a, "pair", b, x, k + 1) for k, (b, x) in enumerate(value)]
            value = [(t, p(own[t], n[a]) - p(total[t], sum(n.values()))) for t in kept if own[t]]
            value = sorted((x for x in value if x[1] > 0), key=lambda x: (-x[1], x[0].encode()))[:50]
            out += [(lang, a, "term", t, x, k + 1) for k, (t, x) in enumerate(value)]
    return sorted(out)


def got(df, least):
    return sorted(tuple(r) for r in sa.divergence_audit(df, least).collect())


SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, cells int, part string"


def build(spark, rows):
    from tidewater.llm.registry import on_workers
    on_workers(spark)
    return spark.createDataFrame([(i, *r, "x", 1, 2, "y") for i, r in enumerate(rows)], SCHEMA)


def test_against_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)] + ["É", "été", "THE", "the"]
    rows = []
    for _ in range(400):
        lang, source = rng.choice(["en", "en", "fr", None]), rng.choice(["a", "a", "b", "é", None, ""])
        text = rng.choice([" ", ",", "1"]).join(
            rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randint(0, 60)))
        rows.append((rng.choice([text, text.upper(), text]), lang, source))
    rows += [(None, "en", "empty"), ("", "de", "one"), (None, "de", "two"), ("rare", "it", "alone")]
    for least in (2, 30):
        assert got(build(spark, rows), least) == brute(rows, least)


def test_odd_rows(spark):
    rows = [(t, "en", f"s{i % 3}") for i, (_, t) in enumerate(ODD)]
    assert got(build(spark, rows), 1) == brute(rows, 1)


def test_empty_table(spark):
    assert got(build(spark, [("x", "en", "a")]).where("false"), 1) == []


def test_ties_of_the_last_rank(spark):
    names = ["".join(chr(97 + (i >> (4 * k)) % 16) for k in range(3)) for i in range(300)]
    rows = [(" ".join(names), "en", "a"), ("other " * 300, "en", "b")]
    out = got(build(spark, rows), 1)
    assert out == brute(rows, 1)
    assert [r[3] for r in out if r[1:3] == ("a", "term")] == sorted(names)[:50]


@pytest.mark.parametrize("columns", [8, 40, 1024])
def test_products_of_any_chunking(monkeypatch, columns):
    monkeypatch.setattr(sa, "COLUMNS", columns)
    rng = np.random.default_rng(5)
    counts = rng.geometric(0.3, (200, 9)) - 1
    counts[:5] *= 10 ** 6
    n, v = counts.sum(0), len(counts)
    totals = np.zeros((9, 9), np.int64)
    cuts = list(sa._pieces(counts))
    assert cuts[0].start == 0 and all(a.stop == b.start for a, b in zip(cuts, cuts[1:]))
    for piece in cuts:
        sa.level_product(counts[piece], n, v, totals)
    p = [[1 + 10 ** 9 * (int(c) + 5) // (int(n[g]) + 5 * v) for g, c in enumerate(row)]
         for row in counts]
    want = [[sum(abs(r[a] - r[b]) for r in p) for b in range(9)] for a in range(9)]
    assert totals.tolist() == want


def test_shares_beyond_64_bits():
    count, n = [0, 7, 10 ** 13, 9 * 10 ** 14], 9 * 10 ** 14
    want = [1 + 10 ** 9 * (c + 5) // (n + 5 * 12) for c in count]
    assert sa.shares(np.array(count), n, 12).tolist() == want
