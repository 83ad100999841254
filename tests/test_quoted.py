"""Quoted CSV in splits of any size against the reader that takes a file whole."""

import csv
import io
import os
import random
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidewater.sources.files import scan_quoted
from tidewater.sources.quoted import Lines, begin_inside, ends_inside, quoted_records

SCHEMA = StructType([StructField(c, StringType()) for c in "abc"])


def deliver(*files: str) -> str:
    root = tempfile.mkdtemp(prefix="tw-test-")
    for i, text in enumerate(files):
        with open(f"{root}/part-{i}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(text)
    return root


def as_csv(rows, end="\n"):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end)
    w.writerow("abc")
    w.writerows(rows)
    return out.getvalue()


def drawn(seed, n, end="\n"):
    rng = random.Random(seed)

    def value():
        text = "".join(rng.choice('xyé ,"\n') for _ in range(rng.randint(0, 30)))
        return "v" + (text.replace("\n", "\r\n") if rng.random() < 0.2 else text)
    return [(str(i), value(), value()) for i in range(n)]


@pytest.fixture
def splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                          "spark.sql.files.openCostInBytes")}
    yield lambda size: (spark.conf.set("spark.sql.files.maxPartitionBytes", size),
                        spark.conf.set("spark.sql.files.openCostInBytes", "0"))
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", ["128m", "2k", "150"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_split_gives_the_same_records(spark, splits, size, end):
    files = [drawn(1, 150), [], drawn(2, 40), [("1", "x" * 3000 + "\n" * 20, "")]]
    root = deliver(*(as_csv(f, end) for f in files))
    splits(size)
    got = sorted(tuple(v or "" for v in r) for r in scan_quoted(spark, root, SCHEMA).collect())
    assert got == sorted((*r, "") for f in files for r in f)


def test_one_file_is_read_in_many_tasks(spark, splits):
    root = deliver(as_csv(drawn(3, 400)))
    splits("1k")
    assert quoted_records(spark, root).rdd.getNumPartitions() >= os.path.getsize(f"{root}/part-0.csv") // 1100


def test_as_the_reader_of_whole_files(spark, splits):
    text = as_csv(drawn(4, 100)) + 'k7,5" disk,"q" tail\nk8,,""\n\n"k9","a""",b'
    root = deliver(text)
    whole = (spark.read.schema(SCHEMA).option("header", True).option("quote", '"')
             .option("escape", '"').option("multiLine", True).csv(root))
    splits("100")
    got = scan_quoted(spark, root, SCHEMA).drop("_corrupt_record")
    key = str
    rows = sorted((tuple(r) for r in got.collect()), key=key)
    want = sorted((tuple(r) for r in whole.collect()), key=key)
    assert [r for r in rows if r[0] != "k7"] == [r for r in want if r[0] != "k7"]
    assert [r[:2] for r in rows if r[0] == "k7"] == [("k7", '5" disk')]


@pytest.mark.parametrize("size", ["128m", "60"])
def test_what_does_not_fit_is_rejected_with_its_record(spark, splits, size):
    schema = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    root = deliver('a,b\n1,"x\ny"\nbad,"line 1\nline 2"\n2,z\n3,"open ' + "\nnever closed" * 20)
    splits(size)
    rows = scan_quoted(spark, root, schema).collect()
    good = sorted((r.a, r.b) for r in rows if r._corrupt_record is None)
    assert good == [(1, "x\ny"), (2, "z")]
    bad = [r._corrupt_record for r in rows if r._corrupt_record is not None]
    assert 'bad,"line 1\nline 2"' in bad
    assert sum(t.count("never closed") for t in bad) == 20


def test_states():
    assert not ends_inside('a,"b ""c"", d",e', False) and ends_inside('a,"b ""', False)
    assert ends_inside('c"" d', True) and not ends_inside('c" d,e', True)
    assert ends_inside('c",d,"e', True) and not ends_inside('x"y,z', False)
    scanned = [("f", 0, True, True), ("f", 9, False, True), ("f", 18, False, False), ("g", 0, False, True)]
    assert begin_inside(scanned) == ({("f", 9), ("f", 18)}, False)
    assert begin_inside([("f", 0, True, False), ("g", 0, False, False)]) == (set(), True)


def test_empty_delivery(spark):
    assert scan_quoted(spark, deliver("a,b,c\n", ""), SCHEMA).count() == 0


@pytest.mark.parametrize("alphabet", ['a,"', 'a,""\r', '",', 'é,"x'])
def test_lines_at_once_as_one_by_one(monkeypatch, alphabet):
    monkeypatch.setattr(Lines, "STEP", 5)
    rng = random.Random(alphabet)
    for _ in range(300):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6))) for _ in range(12)]
        for kind in (pa.string(), pa.large_string()):
            for state in (False, True):
                want, at = [], state
                for t in texts[3:]:
                    at = ends_inside(t, at)
                    want.append(at)
                assert Lines(pa.array(texts, kind).slice(3)).after(state).tolist() == want
