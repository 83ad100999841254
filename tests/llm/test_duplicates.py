import hashlib
import random
import re

import numpy as np

from tidewater.llm.components import connected_components
from tidewater.llm.digest_merge import exact_duplicates
from tidewater.llm.superminhash import (_across, band_keys, drop_near_duplicates, near_duplicates,
                                        shingle_sets, super_minhash)

from .conftest import ODD


def brute_exact(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append(
            (-len(text or ""), doc is None, doc))
    out = []
    for plain, members in groups.items():
        keep = min(members)[2]
        out += [(doc, keep, len(members), hashlib.sha256(plain.encode()).hexdigest())
                for _, _, doc in members]
    return sorted(out, key=str)


def test_exact(odd):
    got = exact_duplicates(odd).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got),
                  key=str) == brute_exact(ODD)
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["text_sha256"] for r in got})


def test_exact_many_runs(make):
    rows = [(i, f"text {i % 7}" + " " * (i % 5)) for i in range(300)]
    got = exact_duplicates(make(rows).repartition(40), rounds_at_once=1).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got),
                  key=str) == brute_exact(rows)


def brute_near(rows, percent):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else (
            {tuple(w)} if w else set())
    sets = {d: shingles(t) for d, t in rows}
    comp = {d: d for d in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def edited_copies():
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(6):
        text = [r.choice(words) for _ in range(r.choice([6, 40, 120, 200]))]
        for _ in range(14):
            copy = list(text)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    return rows + [(9000 + i, t) for i, t in enumerate(["", None, "one", "One", "a b c d", "a b c"])]


def test_near_equals_brute_force(make):
    rows = edited_copies()
    for percent in (80, 85):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
               for r in near_duplicates(make(rows), percent).collect()}
        assert got == brute_near(rows, percent)


def test_one_shared_band_is_enough(spark):
    mixed = spark.createDataFrame(
        [(10, i, i, 20, 1, 1, 20, i, 3, 3) for i in (1, 2, 3)],
        "band long, id long, k long, n long, la long, lk long, ln long, component long, major long, comps long")
    tested = spark.createDataFrame([(1, 1, 2, 2, 0.3), (1, 1, 3, 3, 0.3)],
                                   "a long, ka long, b long, kb long, dist double")
    bands = spark.createDataFrame([(1, 1, [10]), (2, 2, [10, 11]), (3, 3, [10, 12])],
                                  "id long, k long, bands array<long>")
    sets = spark.createDataFrame([(1, 1, list(range(4, 24))), (2, 2, list(range(20))),
                                  (3, 3, list(range(1, 21)))], "id long, k long, items array<long>")
    pairs = _across(mixed, tested, bands, sets, 85).collect()
    assert [(r["a"], r["b"]) for r in pairs] == [(2, 3)]


def test_near_odd_rows(odd):
    got = near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[4]["component_id"] == 3 and not by[4]["kept"]
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert by[1]["n_shingles"] == by[6]["n_shingles"] == 0 and by[1]["kept"] and by[6]["kept"]
    # one row of the group of 3, 3 and 4 stays
    assert sorted(str(r["doc_id"]) for r in drop_near_duplicates(odd).collect()) == sorted(
        str(d) for d in {d for d, _ in ODD} if d != 4)


A, B, C = (f"{w} one two three four five six seven {w}" for w in ("alpha", "beta", "gamma"))


def test_rows_of_one_id_are_one_node(make):
    by = {}
    for r in near_duplicates(make([(3, B), (5, A), (5, B), (9, A), (7, C), (8, C), (8, "x")])).collect():
        by.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert by == {3: {3}, 5: {3}, 9: {3}, 7: {7}, 8: {7}}


def test_no_text_is_lost_and_no_copy_stays(make):
    rows = [(3, B), (5, A), (5, B), (None, A), (None, C), (None, C), (6, C), (6, C), (None, ""), (None, None)]
    docs = make(rows)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert [t for _, t in got if t] and sorted(t for _, t in got if t) == sorted([A, B, C])
    assert (3, B) in got and (6, C) in got and len(got) == 5     # texts without words all stay
    many = [(None if i % 3 else 4, f"{A} {i // 30}" if i % 2 else B) for i in range(300)]
    texts = [r["text"] for r in drop_near_duplicates(make(many), 100).collect()]
    assert sorted(texts) == sorted({t for _, t in many})


def test_near_empty(make):
    assert near_duplicates(make([])).count() == 0


def test_signature_estimates_similarity():
    r = np.random.default_rng(0)
    pool = r.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [pool[:1000], pool[100:1100], pool[:12], pool[1:13], pool[:0]]
    sig = super_minhash(sets)
    assert abs((sig[0] == sig[1]).mean() - 900 / 1100) < 0.12
    assert abs((sig[2] == sig[3]).mean() - 11 / 13) < 0.15
    # a signature entry's step number is below the number of steps
    assert (sig[:4] >> np.uint64(32)).max() < 125
    assert (band_keys(sig)[0] == band_keys(super_minhash(sets[:1]))[0]).all()


def test_shingles_of_long_words_and_blocks():
    long = b"x" * (3 << 20) + b" b c d e f"
    assert len(shingle_sets([long])[0]) == 2
    assert (shingle_sets([b"A b\tc\nd e"])[0] == shingle_sets([b"a B c d E"])[0]).all()


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (3, 9), (5, 5)] + [(100 + i, 101 + i) for i in range(60)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 10: 10, 11: 10, 5: 5} | {100 + i: 100 for i in range(61)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
