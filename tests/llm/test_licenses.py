"""License scans against a plain scan with Python's re and quadratic suppression."""

import random
import re

import pytest

from tidewater.llm.license_rules import BASE, NAME, RULES, WEIGHTS, scan_licenses
from tests.llm.conftest import ODD

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FILL = "the code of this work is under a license version 2 0 mit apache gnu public cc by nc".split()


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    line = "".join(f" {w} " for w in words)
    found = [(line[:m.start()].count(" ") // 2, line[:m.end()].count(" ") // 2, r.priority, k)
             for k, r in enumerate(RULES) for m in re.finditer(r.regex, line)]
    kept = [d for d in found if not any(
        e != d and e[2] <= d[2] and e[0] <= d[0] and e[1] >= d[1]
        and (e[:2] != d[:2] or (e[2], e[3]) < (d[2], d[3])) for e in found)]
    base = [d for d in found if RULES[d[3]].base]
    starts = [d[0] for d in base]
    base_labels = {RULES[d[3]].label for d in base}
    labels = base_labels | {RULES[d[3]].label for d in kept}
    return (len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(labels)),
            max((WEIGHTS[d[2]] for d in kept), default=0.0), len(found))


def example(pattern, rng):
    """A text that the pattern matches, alternatives and options drawn."""
    def group(s):
        depth, parts, at = 0, [], 0
        for i, c in enumerate(s):
            depth += (c in "(<") - (c in ")>")
            if c == "|" and depth == 0:
                parts.append(s[at:i])
                at = i + 1
        return [*parts, s[at:]]

    def word(w):
        w = rng.choice(w.split("|")).replace("[cs]", rng.choice("cs")).replace("\\d", "4")
        return re.sub(r"(\w)\?", lambda m: m[1] if rng.random() < 0.5 else "", w.replace("\\w+", "use"))

    def draw(s):
        out, i = [], 0
        while i < len(s):
            close = {"(": ")", "<": ">"}[s[i]]
            depth, j = 0, i
            while True:
                depth += (s[j] == s[i]) - (s[j] == close)
                if not depth:
                    break
                j += 1
            body, i = s[i + 1:j], j + 1
            optional = s[i:i + 1] == "?"
            i += optional
            if not (optional and rng.random() < 0.5):
                out += draw(rng.choice(group(body))) if close == ")" else [word(body)]
        return out
    return " ".join(draw(pattern))


def rows_of(df):
    return [(r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels,
                        r.score, len(r.detections))) for r in df.collect()]


def test_every_rule_finds_examples_of_its_own(make):
    rng = random.Random(1)
    drawn = [(k, example(r.pattern, rng)) for k, r in enumerate(RULES) for _ in range(6)]
    for k, text in drawn:
        assert re.search(RULES[k].regex, "".join(f" {w} " for w in text.split())), (k, text)
    docs = make([(i, f"Begin, {t}; end") for i, (_, t) in enumerate(drawn)])
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    for i, (k, text) in enumerate(drawn):
        assert k in {d.rule for d in got[i].detections}, (RULES[k], text)


def test_against_brute_force(make):
    rng = random.Random(2)
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice([example(rng.choice(RULES).pattern, rng), *FILL,
                                     rng.choice(BASE)[2].replace("><", "-").strip("<>"), "Fünf cc"]))
        texts.append(rng.choice([" ", ", ", "\n", "  "]).join(parts).title())
    docs = [(i, t) for i, t in enumerate(texts)]
    assert dict(rows_of(scan_licenses(make(docs)))) == {i: brute(t) for i, t in docs}


def test_odd_rows_and_clashing_columns(odd):
    got = sorted(rows_of(scan_licenses(odd)), key=str)
    assert got == sorted(((i, brute(t)) for i, t in ODD), key=str)


def test_empty_table(make):
    assert scan_licenses(make([(1, "x")]).where("false")).count() == 0


@pytest.mark.parametrize("n", [1, 255, 256, 257, 3000])
def test_many_matches_in_one_text(make, n):
    text = "x under the MIT license " * n + "cc by nc"
    (row,) = rows_of(scan_licenses(make([(1, text)])))
    assert row[1][:6] == (5 * n + 3, n + 1, 1, 5 * n, "cc-by-nc,mit", "cc-by-nc,mit")


def test_letters_beyond_ascii(make):
    rows = [(1, "ÉTÉ Under The MİT License \u212a"), (2, "AİR CC BY NC ŞÇ"), (3, "Straße CC-BY-NC")]
    assert dict(rows_of(scan_licenses(make(rows)))) == {i: brute(t) for i, t in rows}


def test_suppression(make):
    texts = ["GNU Lesser General Public License, version 3", "under the GNU GPL v3 or later",
             "CC BY-NC-SA 4.0", "gplv2", "SPDX-License-Identifier: Apache-2.0", "an MIT License"]
    got = [r.labels for r in scan_licenses(make(list(enumerate(texts)))).orderBy("doc_id").collect()]
    assert got == ["lgpl-3", "gpl-3", "cc-by-nc,cc-by-nc-sa", "gpl-2", "apache-2", "mit"]
    assert min(WEIGHTS) == 0 and max(WEIGHTS) == NAME
