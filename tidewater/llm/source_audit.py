"""Divergence audit of sources by one-hot level products (operator 11).

For every language, how far each source's term shares are from those of every
other source, and the terms by which it stands out most. A share is an exact
integer p = 1 + floor(1000000000 * (count + 5) / (N + 5 * V)); it depends only on
the source and the count, the term's *level* there. So all that a pair of sources
needs is their joint table: how many terms have level i in the one and level j
in the other.

1. Terms are counted per (language, source) in bounded memory inside the tasks,
   and added up; a term's row holds its count in each source of the language.
2. Term rows are dealt to blocks by hash. In a block, rows in order of their
   count are cut into pieces of few distinct levels; a piece becomes an indicator
   matrix with a column for each (source, level), zeros included, and its
   transpose times itself is every joint table of the piece at once. The numbers
   are whole and below 2**24, so the products are exact in 32-bit floats.
3. Each joint cell is priced with the difference of its two levels' shares, in
   64-bit integers, and summed per pair; the sums of all blocks are added up.
   The same level shares price the terms of a source against the language.

A source with a third of all rows is many term rows like any other. What meets in
one task is a block of terms with their counts in the sources of a language; the
sums are one number for each pair of sources, as the result is.

Null text, lang and source count as ''. Groups without terms and languages
without kept terms give value 0 for each pair. Repeated rows all count; ids and
other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import slices, stage, text_bytes
from tidewater.operators import join_back

LEAST_DOCS, TOP, ONE, PRIOR = 30, 50, 1_000_000_000, 5
#: Terms of a block, columns and rows of an indicator matrix, counts held by a task.
BLOCK_TERMS, COLUMNS, PIECE_ROWS, HELD = 2048, 1024, 1024, 500_000
#: Bytes of terms: letters lowered, all other ASCII characters as blanks.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by (lang, source); a row without a
    term for each group seen."""
    n: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def emit() -> Iterator[pa.RecordBatch]:
        for (lang, source), count in n.items():
            terms, in_docs = list(count), docs[lang, source]
            for at in range(0, len(terms) + 1, 50_000):
                part = terms[at:at + 50_000]
                rows = [*part, None] if at == 0 else part
                own = [count[t] for t in part] + [0] * (len(rows) - len(part))
                seen = [in_docs[t] for t in part] + [0] * (len(rows) - len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(rows), pa.string()),
                     pa.array([source] * len(rows), pa.string()),
                     pa.array(rows, pa.binary()).cast(pa.string()),
                     pa.array(own, pa.int64()), pa.array(seen, pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
        n.clear()
        docs.clear()

    for whole in batches:
        for batch in slices(whole):
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = (lang, source)
                if key not in n:
                    n[key], docs[key] = Counter(), Counter()
                terms = text.translate(_FOLD).split()
                n[key].update(terms)
                docs[key].update(set(terms))
            if sum(map(len, n.values())) > HELD:
                yield from emit()
    yield from emit()


def shares(count: np.ndarray, n: np.ndarray | int, v: int) -> np.ndarray:
    """1 + floor(ONE * (count + PRIOR) / (n + PRIOR * v)), exact: the quotient is
    made three decimal digits at a time, so nothing passes 64 bits."""
    whole = np.asarray(n, np.int64) + PRIOR * v
    out, rest = np.divmod(np.asarray(count, np.int64) + PRIOR, whole)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digits
    return 1 + out


def _pieces(counts: np.ndarray) -> Iterator[slice]:
    """Cut rows (in order of their totals) so that a piece has few levels."""
    at, groups = 0, counts.shape[1]
    while at < len(counts):
        rows = max(1, min(PIECE_ROWS, 4_000_000 // max(1, groups)))
        while rows > 1:
            own = np.sort(counts[at:at + rows], axis=0)
            if groups + int((np.diff(own, axis=0) > 0).sum()) <= COLUMNS:
                break
            rows //= 2
        yield slice(at, at + rows)
        at += rows


def level_product(counts: np.ndarray, n: np.ndarray, v: int, totals: np.ndarray) -> None:
    """Add to ``totals`` (groups, groups), for each pair of groups, the sum over the
    rows of ``counts`` (terms, groups) of the difference of their shares."""
    groups, columns, level = counts.shape[1], [], []
    for g in range(groups):
        levels, place = np.unique(counts[:, g], return_inverse=True)
        columns.append(place)
        level.append(levels)
    width = np.array([len(x) for x in level])
    starts = np.concatenate(([0], np.cumsum(width)))
    price = shares(np.concatenate(level), np.repeat(n, width), v)
    # chunks of whole groups, so that a product has a bounded size
    chunks, lo = [], 0
    while lo < groups:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + COLUMNS, "right")) - 1)
        chunks.append((lo, hi))
        lo = hi

    def one_hot(lo: int, hi: int) -> np.ndarray:
        x = np.zeros((len(counts), starts[hi] - starts[lo]), np.float32)
        for g in range(lo, hi):
            x[np.arange(len(counts)), starts[g] - starts[lo] + columns[g]] = 1
        return x

    for i, (a, b) in enumerate(chunks):
        left = one_hot(a, b)
        for c, d in chunks[i:]:
            right = left if c == a else one_hot(c, d)
            joint = (left.T @ right).astype(np.int64)
            joint *= np.abs(price[starts[a]:starts[b], None] - price[None, starts[c]:starts[d]])
            cell = np.add.reduceat(np.add.reduceat(joint, starts[a:b] - starts[a], axis=0),
                                   starts[c:d] - starts[c], axis=1)
            totals[a:b, c:d] += cell
            if c != a:
                totals[c:d, a:b] += cell.T


def _priced(block: pa.Table) -> pa.Table:
    """The pairs' sums and each group's outstanding terms of one block."""
    rows = block.to_pylist()
    (about,) = (r for r in rows if r["term"] is None)
    rows = sorted((r for r in rows if r["term"] is not None),
                  key=lambda r: (-r["total"], r["term"].encode()))
    lang, v, all_ = about["lang"], about["v"], about["total"]
    sources = [c["source"] for c in about["cells"]]
    n = np.array([c["n"] for c in about["cells"]], np.int64)
    place = {s: k for k, s in enumerate(sources)}
    totals = np.zeros((len(sources), len(sources)), np.int64)
    best: list[list[tuple[int, bytes]]] = [[] for _ in sources]
    total = np.array([r["total"] for r in rows], np.int64)
    at = [[(place[c["source"]], c["n"]) for c in r["cells"]] for r in rows]
    step = max(1, 4_000_000 // max(1, len(sources)))
    for lo in range(0, len(rows), step):
        counts = np.zeros((len(rows[lo:lo + step]), len(sources)), np.int64)
        for k, cells in enumerate(at[lo:lo + step]):
            for g, c in cells:
                counts[k, g] = c
        for piece in _pieces(counts):
            level_product(counts[piece], n, v, totals)
        over = shares(counts, n, v) - shares(total[lo:lo + step], all_, v)[:, None]
        over[counts == 0] = 0
        for g in range(len(sources)):
            mine = np.flatnonzero(over[:, g] > 0)
            if len(mine) > TOP:     # all ties of the last place stay until the order by name
                cut = -np.partition(-over[mine, g], TOP - 1)[TOP - 1]
                mine = mine[over[mine, g] >= cut]
            best[g] = sorted(best[g] + [(-int(over[k, g]), rows[lo + k]["term"].encode())
                                        for k in mine])[:TOP]
    a, b = np.nonzero(~np.eye(len(sources), dtype=bool))
    out = [(lang, sources[i], "pair", sources[j], int(totals[i, j])) for i, j in zip(a, b, strict=True)]
    out += [(lang, sources[g], "term", t.decode(), -minus) for g in range(len(sources))
            for minus, t in best[g]]
    return pa.table([pa.array([r[k] for r in out], pa.string()) for k in range(4)]
                    + [pa.array([r[4] for r in out], pa.int64())],
                    names=["lang", "source", "part", "item", "value"])


def divergence_audit(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (lang, source, text): all
    other sources of the language by distance (part ``pair``) and the terms
    with the largest excess over the language (part ``term``, to rank 50)."""
    empty = F.lit("")
    text = docs.select(F.coalesce("lang", empty).alias("lang"),
                       F.coalesce("source", empty).alias("source"), text_bytes().alias("text"))
    # dealt by term: the counts of a group and then the groups of a term add up in place
    cells = (text.mapInArrow(_count, _COUNTS).repartition("lang", "term")
             .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    terms = stage(cells.groupBy("lang", "term")
                  .agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"),
                       F.collect_list(F.struct("source", "n")).alias("cells"))
                  .where(F.col("term").isNull() | (F.col("docs") >= least_docs)), "terms")
    kept = terms.where("term IS NOT NULL")
    per_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("total"))
    sums = (kept.select("lang", F.explode("cells").alias("c"))
            .groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("n")))
    # a row about each language: its sources with their sums, also those without terms
    every = terms.where("term IS NULL").select("lang", F.explode("cells.source").alias("source"))
    about = (every.join(sums, ["lang", "source"], "left")
             .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct(
                 "source", F.coalesce("n", F.lit(0)).alias("n")))).alias("cells"))
             .join(per_lang, "lang", "left")
             .select("lang", "cells", F.coalesce("v", F.lit(0)).alias("v"),
                     F.coalesce("total", F.lit(0)).alias("total")))
    blocks = F.greatest(F.ceil(F.col("v") / BLOCK_TERMS), F.lit(1))
    dealt = join_back(kept, per_lang.select("lang", "v", F.col("v").alias("size")), ["lang"], "size",
                      F.xxhash64("term"))
    columns = ["lang", "block", "term", "total", "v", "cells"]
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("term"), blocks)).select(*columns)
    about = (about.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
             .withColumn("term", F.lit(None).cast("string")).select(*columns))
    priced = dealt.union(about).groupBy("lang", "block").applyInArrow(
        _priced, "lang string, source string, part string, item string, value long")
    priced = stage(priced, "priced")
    keys = ["lang", "source", "part"]
    order = Window.partitionBy(*keys).orderBy(F.desc("value"), "item")
    pairs = (priced.where("part = 'pair'").groupBy(*keys, "item").agg(F.sum("value").alias("value"))
             .withColumn("rank", F.row_number().over(order)))
    top = (priced.where("part = 'term'").withColumn("rank", F.row_number().over(order))
           .where(F.col("rank") <= TOP))
    return pairs.union(top).select(*keys, "item", "value", "rank")


#: The query in SQL.
ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
w AS MATERIALIZED (
  SELECT r, lang, source, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT r, lang, source, unnest(words) AS t FROM d)),
kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCS}),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM w GROUP BY ALL),
full_ AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, k.total
  FROM g JOIN kept k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, sum(c) AS n FROM full_ GROUP BY ALL),
p AS MATERIALIZED (
  SELECT f.lang, f.source, term, c,
    1 + ({ONE}::HUGEINT * (c + {PRIOR})) // (s.n + {PRIOR} * l.v)::HUGEINT AS p,
    1 + ({ONE}::HUGEINT * (total + {PRIOR})) // (l.n + {PRIOR} * l.v)::HUGEINT AS q
  FROM full_ f JOIN s ON s.lang = f.lang AND s.source = f.source JOIN l ON l.lang = f.lang),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM parts)
WHERE part = 'pair' OR rank <= {TOP}
"""
