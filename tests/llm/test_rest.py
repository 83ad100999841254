import datetime
import hashlib
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidewater.llm import registry
from tidewater.llm.curriculum import (BUCKET_DIGITS, SCHEDULES, curriculum_order, invert_demand,
                                      mix_plan, order_key)
from tidewater.llm.decontaminate import (contaminated_documents, drop_contaminated, lcs_length,
                                         passages)
from tidewater.llm.feistel_pii import feistel, pseudonymise
from tidewater.llm.token_rollup import TokenLedger
from tidewater.session import staging_path

from .conftest import ODD

DATA = "/root/testdata/sf0.001"


# ---- pseudonyms
def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])


def test_pseudonyms_keep_formats_and_links(make):
    text = ("a 4111 1111 1111 1111 b 4111111111111112 c 2017-02-28 d 2017-02-31 e 31/12/1999 "
            "f 10.0.0.255 g 300.1.1.1 h +1 (988) 555-2485 i 123-45-6789 j 000-45-6789 "
            "k Ann.b7@mail.example.com. l")
    rows = [(1, text), (2, "again 4111 1111 1111 1111, ann.B7@mail.example.com"), (3, None), (4, ""),
            (None, "none 12")]
    by = {r["doc_id"]: r for r in pseudonymise(make(rows), "key").collect()}
    new = by[1]["text"]
    form = (r"a (\d{4} \d{4} \d{4} \d{4}) b 4111111111111112 c ((?:19|20)\d\d-\d\d-\d\d) d 2017-02-31 "
            r"e (\d\d/\d\d/\d{4}) f (\d+\.\d+\.\d+\.\d+) g 300\.1\.1\.1 h (\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}) "
            r"i (\d{3}-\d\d-\d{4}) j 000-45-6789 k ([a-z]{3}\.[a-z]\d@mail\.example\.com)\. l")
    found = re.fullmatch(form, new)
    assert found and luhn(found[1]) % 10 == 0
    for old, made in zip(("4111 1111 1111 1111", "2017-02-28", "31/12/1999", "10.0.0.255"),
                         found.groups(), strict=False):
        assert old != made
    pd.Timestamp(found[2])
    assert by[2]["text"] == f"again {found[1]}, {found[7]}"
    assert by[3]["text"] is None and by[4]["text"] == "" and by[None]["text"] == "none 12"
    assert [by[1][f"pii_{k}"] for k in ("email", "ip", "phone", "ssn", "date", "card")] == [1, 1, 1, 1, 2, 1]


@pytest.mark.parametrize("text", [
    "x a@b" + ".ab" * 340_000, "a" * 1_000_000 + "@", "a@" * 500_000, "1" * 1_000_000, "1-" * 500_000,
    "+1 " * 330_000, "(123) " * 170_000, "2017-02-" * 125_000, "1.2." * 250_000, "4111 " * 200_000,
    "@." * 500_000])
def test_long_adversarial_texts(make, text):
    (row,) = pseudonymise(make([(1, text)]), "key").select("text").collect()
    assert len(row["text"]) == len(text)


def test_long_email_names_keep_their_shape_and_links(make):
    names = [f"{'abcde' * 8}.{k}_{'0123456789' * 5}-{'z' * 30}" for k in range(20)]
    rows = [(k, f"to {n}@mail.example.com or {n.upper()}@b.org") for k, n in enumerate(names)]
    new = {r["doc_id"]: r["text"] for r in pseudonymise(make(rows), "key").collect()}
    seen = set()
    for k, old in enumerate(names):
        first, other = re.fullmatch("to (.*)@mail.example.com or (.*)@b.org", new[k]).groups()
        assert first == other != old and len(first) == len(old)
        assert re.sub("[a-z]", "a", re.sub("[0-9]", "0", first)) == re.sub("[a-z]", "a", re.sub("[0-9]", "0", old))
        seen.add(first)
    assert len(seen) == len(names)


def test_key_and_columns_of_the_input(make):
    docs = make([(1, "mail a.b@c.de")]).selectExpr("*", "1 AS _hits", "2 AS _made", "3 AS _gaps", "4 AS hits")
    row = pseudonymise(docs, "key").first()
    assert (row["_hits"], row["_made"], row["_gaps"], row["hits"], row["pii_email"]) == (1, 2, 3, 4, 1)
    with pytest.raises(ValueError, match="key"):
        pseudonymise(docs, "")


def test_phones_of_any_digits_and_country(make):
    forms = ["+1 (017) 555-7713", "+1 (988) 155-2485", "(017) 555-7713", "+1 017.555.7713", "+10175557713",
             "017-555-7713", "988.555.2485", "1-800-555-0199", "1.800.555.0199", "800 555 0199",
             "1 (800) 555-0199", "+44 20 7946 0958", "+49 (0)30 1234567", "+351 912 345 678",
             "+7 495 123-45-67", "+1 555 1234"]
    rows = [(i, f"call {p}, 4111 1111 1111 1111") for i, p in enumerate(forms)]
    rows += [(100, "+44 20 7946 0958 2017-02-28 +44 20 7946 0959 4111 1111 1111 1111"),
             (101, "12.345.678.9012 and 5557713 and 0175557713"), (102, "+44 20 7946 0958 10.0.0.255")]
    by = {r["doc_id"]: r for r in pseudonymise(make(rows), "key").collect()}
    made = []
    for i, p in enumerate(forms):
        new = by[i]["text"][5:].split(",")[0]
        made.append(new)
        country = re.match(r"(\+(1|44|49|351|7)(?!\d\d\d\d\d\d\d\d\d\d\d)|1(?=\D)|)", p)[0]
        assert by[i]["pii_phone"] == 1 and new != p and new.startswith(country), (p, new)
        assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", p)
    assert made[0].endswith(made[2])
    assert re.sub(r"\D", "", made[0]) == re.sub(r"\D", "", made[3]) == re.sub(r"\D", "", made[4])
    assert [by[100][f"pii_{k}"] for k in ("phone", "date", "card")] == [2, 1, 1]
    assert [by[102][f"pii_{k}"] for k in ("phone", "ip")] == [1, 1]
    assert by[101]["text"] == rows[-2][1]


def test_phone_pseudonyms_are_distinct(spark, make):
    rows = [(a, f"+1 ({a:03d}) {e:03d}-0000") for a in range(0, 1000, 9) for e in (0, 155, 199, 200, 999)]
    got = {r["text"] for r in pseudonymise(make(rows), "key").collect()}
    assert len(got) == len(rows) and not got & {t for _, t in rows}


def brute_feistel(x, y, size_x, size_y, key, tweak):
    for r in range(1, 9):
        fixed = y if r % 2 else x
        mac = int(hashlib.sha256(f"{key}:{tweak}:{r}:{fixed}".encode()).hexdigest()[:15], 16)
        if r % 2:
            x = (x + mac) % size_x
        else:
            y = (y + mac) % size_y
    return x, y


def test_pseudonyms_equal_brute_force(make):
    r = random.Random(6)
    first, rows, want = datetime.date(1900, 1, 1), [], []
    for i in range(60):
        a, b, c, d = (r.randrange(256) for _ in range(4))
        x, y = brute_feistel(a * 256 + b, c * 256 + d, 65536, 65536, "k", "ip")
        area = r.choice([v for v in range(1, 900) if v != 666])
        group, serial = r.randint(1, 99), r.randint(1, 9999)
        s, t = brute_feistel(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "k", "ssn")
        day = r.randrange(73049)
        on = first + datetime.timedelta(day)
        new = first + datetime.timedelta(int(np.dot(brute_feistel(*divmod(day, 319), 229, 319, "k", "date"), (319, 1))))
        rows.append((i, f"ip {a}.{b}.{c}.{d}, ssn {area:03}-{group:02}-{serial:04} on {on} or {on:%d/%m/%Y}"))
        want.append(f"ip {x // 256}.{x % 256}.{y // 256}.{y % 256}, "
                    f"ssn {s + 1 + (s >= 665):03}-{t // 9999 + 1:02}-{t % 9999 + 1:04} on {new} or {new:%d/%m/%Y}")
    got = {g["doc_id"]: g["text"] for g in pseudonymise(make(rows), "k").collect()}
    assert [got[i] for i in range(60)] == want


def test_feistel_is_a_permutation(spark):
    from pyspark.sql import functions as F
    out = spark.range(17 * 13).select(feistel(F.col("id") % 17, F.floor(F.col("id") / 17), 17, 13,
                                              "k", "t").alias("p")).select("p.*").collect()
    assert len({(r["x"], r["y"]) for r in out}) == 17 * 13
    assert all(0 <= r["x"] < 17 and 0 <= r["y"] < 13 for r in out)


# ---- decontamination
def test_decontamination_finds_copies_and_paraphrases(spark, make):
    r = random.Random(3)
    words = [f"w{i}" for i in range(900)]

    def text(n):
        return [r.choice(words) for _ in range(n)]
    items = [text(r.randint(16, 60)) for _ in range(30)]
    rows, leaked = [], {}
    for i in range(150):
        body = text(r.randint(5, 200))
        if i % 3 == 0:
            item = list(items[i % 30])
            if i % 2:                                   # a paraphrase: some words differ
                for _ in range(len(item) // 10):
                    item[r.randrange(len(item))] = "changed"
            at = r.randrange(len(body))
            body = body[:at] + item + body[at:]
            leaked[i] = i % 30
        rows.append((i, " ".join(body).capitalize()))
    rows += [(d if d is None else d + 1000, t) for d, t in ODD]
    bench = spark.createDataFrame([(i, " ".join(t) + ".") for i, t in enumerate(items)]
                                  + [(99, None), (98, ""), (None, "x")], "item_id long, text string")
    docs = make(rows)
    got = contaminated_documents(docs, bench).collect()
    assert len(got) == len(rows)
    assert {g["doc_id"]: g["item_ids"] for g in got if g["contaminated"]} == {
        d: [i] for d, i in leaked.items()}
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len(leaked)
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(g["contaminated"] for g in contaminated_documents(docs, none).collect())
    assert contaminated_documents(make([]), bench).count() == 0


def test_decontamination_finds_short_items_among_foreign_words(spark, make):
    r = random.Random(5)
    items = [[f"i{k}w{j}" for j in range(16)] for k in range(12)]
    rows, leaked = [], {}
    for i in range(300):                 # all words of an item in every third document: a low idf
        body = [w for k, item in enumerate(items) if (i + k) % 3 for w in r.sample(item, 5)]
        rows.append((i, " ".join(body)))
    for i, item in enumerate(items):
        foreign = [f"x{i}y{j}" for j in range(60)]
        split = [w for j, v in enumerate(item) for w in ((v, "zz") if j % 4 == 3 else (v,))]
        changed = ["qq" if j in (3, 9) else w for j, w in enumerate(item)]
        for kind, text in enumerate((item, split, changed)):
            rows.append((1000 + 100 * kind + i, " ".join(foreign[:33] + text + foreign[33:])))
            leaked[rows[-1][0]] = [i]
    bench = spark.createDataFrame([(k, " ".join(t) + ".") for k, t in enumerate(items)],
                                  "item_id long, text string")
    got = contaminated_documents(make(rows), bench).collect()
    assert {g["doc_id"]: g["item_ids"] for g in got if g["contaminated"]} == leaked


def test_decontamination_fits_all_documents(spark, make):
    from tidewater.llm import decontaminate as d
    r = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    rows = [(i % 900, " ".join(r.choice(words + ["zz", "yy"]) for _ in range(r.randint(0, 70))))
            for i in range(2300)] + [(None, None), (7, "")]
    bench = spark.createDataFrame([(0, " ".join(words[:25]) + "."), (1, " ".join(words[20:]) + ".")],
                                  "item_id long, text string")
    searcher, = d._searchers(make(rows), bench, d.COSINE)
    items = searcher.items
    size = len(items.vocabulary)
    held, gram = np.zeros(size), np.zeros((size, size))
    for _, text in rows:
        ids = np.array([items.place.get(w, -1) for w in (text or "").encode().split()], np.int32)
        held[np.unique(ids[ids >= 0])] += 1
        for passage in passages(ids):
            known = passage[passage >= 0]
            gram[np.ix_(known, known)] += 1
    n, df, pairs = d.word_counts(make(rows).select(d.text_bytes()), items.place)
    assert n == len(rows) and (df == held).all()
    got = np.zeros((size, size))
    for row in pairs.collect():
        for b, k in row["cells"]:
            got[row["a"], b] = k
    assert (got == gram).all()
    # the space's vectors are those of the whole Gram matrix: they make it diagonal
    idf = np.log((n + 1) / (held + 1)) + 0.1
    own = items.grid()[0]
    whole = d.ITEM_WEIGHT * d._gram_times(own, idf, np.eye(size)) \
        + d.FIT_WEIGHT / n * idf[:, None] * gram * idf
    space = searcher.table[:-1].astype(float) / idf[:, None]
    turned = space.T @ whole @ space
    assert np.abs(turned - np.diag(np.diag(turned))).max() < 1e-4 * turned.max()


def test_lcs_and_passages():
    r = random.Random(0)
    for _ in range(50):
        a, b = ([r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(0, 20))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert lcs_length(a, b) == table[-1, -1]
    for n in (0, 1, 16, 31, 32, 33, 100):
        grid = passages(np.arange(n, dtype=np.int32))
        assert set(grid[grid >= 0].tolist()) == set(range(n))


# ---- rollups
CHANGES = "op string, seq long, doc_id long, source string, lang string, tokenizer string, tokens long"


def _replayed(batches):
    """The totals by a plain replay: each document's rows, nameless rows apart."""
    state, nameless = {}, []
    for batch in batches:
        seqs = {}
        for op, seq, doc, *rest in batch:
            if doc is None:
                nameless += [rest] * (op != "delete")
            else:
                seqs.setdefault(doc, []).append((seq, op, rest))
        for doc, rows in seqs.items():
            low = min((s for s, *_ in rows if s is not None), default=0) - 1
            top = max(low if s is None else s for s, *_ in rows)
            rows = [(op, rest) for s, op, rest in rows if (low if s is None else s) == top]
            state[doc] = [] if any(op == "delete" for op, _ in rows) else [rest for _, rest in rows]
    want = {}
    for source, lang, tokenizer, tokens in [r for rows in state.values() for r in rows] + nameless:
        n, t = want.get((source, lang, tokenizer), (0, 0))
        want[source, lang, tokenizer] = (n + 1, t + (tokens or 0))
    return want


def _totals(ledger):
    return {tuple(r[:3]): tuple(r[3:]) for r in ledger.totals().collect()}


def test_rollup_batches_are_idempotent(spark):
    batches = {
        1: [("insert", 0, i, "s%d" % (i % 2), "en", "v1", 10 + i) for i in range(6)]
           + [("insert", 0, 6, None, None, "v1", 3), ("insert", 0, None, "s0", "en", "v1", 5)],
        2: [("revise", 0, 1, "s1", "en", "v2", 100), ("revise", 1, 1, "s1", "en", "v2", 101),
            ("delete", 0, 2, None, None, None, 0), ("delete", 0, 77, None, None, None, 0)],
        3: [("delete", 0, 1, None, None, None, 0), ("insert", 0, 2, "s9", "fr", "v2", 7)]}
    ledger = TokenLedger(spark, staging_path(spark, "ledger"))
    for batch in (1, 2, 2, 3, 1, 2):
        ledger.commit(batch, spark.createDataFrame(batches[batch], CHANGES))
    assert _totals(ledger) == _replayed(batches.values())
    with pytest.raises(ValueError):
        ledger.commit(0, spark.createDataFrame(batches[1], CHANGES))


def test_rollup_random_batches_with_folds(spark):
    r = random.Random(8)
    batches = [[(r.choice(["insert", "insert", "revise", "delete"]), r.choice([None, 0, 0, 1]),
                 r.choice([None, 1, 1, 1, *range(2, 12)]), r.choice([None, "a", "b"]), r.choice([None, "en"]),
                 r.choice(["v1", "v2"]), r.choice([None, 0, 5, 2 ** 40])) for _ in range(30 * (n != 2))]
               for n in range(5)]
    ledger = TokenLedger(spark, staging_path(spark, "ledger"), fold_every=2)
    for n, batch in enumerate(batches):
        ledger.commit(n, spark.createDataFrame(batch, CHANGES))
        assert _totals(ledger) == _replayed(batches[:n + 1])
    assert list(ledger._runs("folds")) == [1, 3]
    # what a commit reads: the last fold and the batches since
    read = ledger.state().inputFiles()
    assert {p.split("/batch=")[1].split("/")[0] for p in read} == {"3", "4"}


def test_rollup_unfinished_commit_leaves_the_former_totals(spark, monkeypatch):
    ledger = TokenLedger(spark, staging_path(spark, "ledger"))
    first = [("insert", 0, 1, "a", "en", "v1", 4), ("insert", 0, 1, "a", "fr", "v1", 6)]
    second = [("revise", 0, 1, "a", "en", "v2", 9)]
    ledger.commit(1, spark.createDataFrame(first, CHANGES))
    with monkeypatch.context() as m:
        m.setattr(ledger, "_mark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ledger.commit(2, spark.createDataFrame(second, CHANGES))
    assert _totals(ledger) == _replayed([first]) and ledger.entries().count() == 2
    ledger.commit(2, spark.createDataFrame(second, CHANGES))
    assert _totals(ledger) == _replayed([first, second])


def test_rollup_empty(spark):
    ledger = TokenLedger(spark, staging_path(spark, "ledger"))
    assert ledger.totals().count() == 0
    ledger.commit(1, spark.createDataFrame([], CHANGES))
    ledger.fold()
    assert ledger.totals().count() == 0 and ledger.state().count() == 0


# ---- curriculum
def test_mix(make):
    r = random.Random(4)
    rows = [(i, "w " * r.randint(0, 60), r.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(7, "twice told", "d"), (7, "twice told", "d"), (None, "no id", "e"), (8, None, "f")]
    docs = make(rows)
    got = [r.asDict() for r in mix_plan(docs).collect()]
    again = [r.asDict() for r in mix_plan(docs.repartition(7)).collect()]
    order = lambda x: sorted(map(str, ({k: v for k, v in g.items()} for g in x)))
    assert order(got) == order(again) and len(got) == len(rows)
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(len((r[1] or "").split()) for r in rows if r[2] == s) for s in names}
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        share = {s: left * weights[s] / sum(weights[t] for t in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    target |= share
    taken = dict.fromkeys(names, 0)
    for g in got:
        assert g["target"] == pytest.approx(target[g["source"]])
        assert g["source_size"] == sizes[g["source"]] and 0 <= g["taken"] <= 2 * g["size"]
        assert g["positions"] == sorted(g["positions"]) and all(0 <= p <= 1 for p in g["positions"])
        taken[g["source"]] += g["taken"]
    assert all(abs(taken[s] - target[s]) < 1 for s in names)
    ordered = curriculum_order(docs)
    assert ordered.columns == docs.columns
    assert ordered.count() == sum(len(g["positions"]) for g in got)
    assert mix_plan(make([])).count() == 0


def test_rows_of_one_id_or_none_are_dealt_by_their_texts(spark):
    from pyspark.sql import functions as F
    rows = spark.range(3000).select(F.when(F.col("id") % 2 == 0, 7).alias("doc_id"), F.xxhash64("id").alias("h"))
    per = rows.groupBy("doc_id", F.substring(order_key(F.col("doc_id"), F.col("h")), 1, BUCKET_DIGITS).alias("b")).count()
    for doc_id in (7, None):
        own = per.where(F.col("doc_id").eqNullSafe(F.lit(doc_id)))
        assert own.count() > 1000 and own.agg(F.max("count")).first()[0] < 10


def test_inverse_of_the_integral(spark):
    from pyspark.sql import functions as F
    for schedule in SCHEDULES:
        rows = spark.range(101).select((F.col("id") / 100).alias("u")).select(
            "u", invert_demand(schedule, F.col("u")).alias("t")).collect()
        x = np.linspace(0, 1, 200_001)
        w = np.interp(x, *zip(*schedule, strict=True))
        whole = np.concatenate(([0], np.cumsum((w[1:] + w[:-1]) / 2)))
        for u, t in rows:
            assert np.interp(t, x, whole / whole[-1]) == pytest.approx(u, abs=1e-4)


# ---- registered queries
def test_oracle_queries(spark):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    for name, sql in registry.ORACLE.items():
        want = con.execute(sql).df()
        got = registry.QUERIES[name](spark, DATA).toPandas()[list(want.columns)]
        key = list(want.columns)
        pd.testing.assert_frame_equal(got.sort_values(key).reset_index(drop=True),
                                      want.sort_values(key).reset_index(drop=True), check_dtype=False)


def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = corpus_pipeline.read_table(spark, DATA, "documents")
    columns = docs.columns
    for name, run in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(run(spark, docs, DATA), name)
        assert docs.columns == columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == docs.count() > 0


def test_token_file_follows_the_curriculum(spark, make):
    import corpus_pipeline
    r = random.Random(9)
    rows = [(i, f"number {i} " + "w " * r.choice((1, 5, 60, 900)), r.choice("abc")) for i in range(300)]
    docs = corpus_pipeline.stage(make(rows + [(5, "twice told", "a"), (5, "twice told", "a"),
                                              (None, "no id", "b")]), "mix-input")
    plan = [(p, g["doc_id"]) for g in mix_plan(docs).collect() for p in g["positions"]]
    ordered = corpus_pipeline.mixing(spark, docs, DATA)
    staged = corpus_pipeline.stage(ordered, "mix")
    want = [d for _, d in sorted(plan, key=lambda x: (x[0], x[1] is not None, x[1] or 0))]
    for given in (ordered, staged):
        index = corpus_pipeline.token_ids(spark, given, DATA).orderBy("start").collect()
        assert [g["doc_id"] for g in index] == want
        starts = np.cumsum([0] + [g["n_tokens"] for g in index])
        assert [g["start"] for g in index] == starts[:-1].tolist()
    assert want != sorted(want, key=lambda d: (d is not None, d or 0))
    # parts that a scan deals by size, not by name
    uneven = make([(i, "x " * (2000 if i % 3 else 1)) for i in range(30)]).coalesce(1)
    parts = corpus_pipeline.stage(uneven.repartitionByRange(9, "doc_id").sortWithinPartitions(
        "doc_id"), "uneven")
    index = corpus_pipeline.token_ids(spark, parts, DATA).orderBy("start").collect()
    assert [g["doc_id"] for g in index] == list(range(30))
