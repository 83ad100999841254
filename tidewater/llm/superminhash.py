"""Near-duplicate detection with SuperMinHash signatures (operator 9).

Words are the runs of non-space characters of the text with A-Z lowered; a
document's set holds its distinct five-word shingles (with fewer words, the
whole sequence as one; without words it is empty and linked with nothing).

1. One pass over the whole texts computes each set as 64-bit hashes, its
   SuperMinHash signature and the band keys. Every element draws a random
   permutation of the signature's places and one uniform number per step; step
   j can only give values in [j, j+1), so a document stops as soon as its
   largest entry is below j. The steps run vectorised over the elements of
   many documents.
2. Documents with equal sets become one class (a map-side aggregated group),
   so thousands of copies cost one row from here on.
3. Classes that share a band key meet in a bucket. Each is compared with the
   bucket's leader (smallest id), on the full sets. Confirmed links are
   united (union-find); what is left outside a bucket's largest component is
   compared with a few changing members of that, and united again. Only the
   pairs of a bucket that are then still in different components and that the
   triangle inequality of the Jaccard distance (through the leader) can't rule
   out are compared one by one. No bucket is capped and none is expanded into
   all its pairs.

Null ids and repeated rows: rows that repeat an id are one node whose links
unite; a null id gets a null component and is kept. ``drop_near_duplicates`` goes
by rows instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import slices, splitmix, stage, text_bytes
from tidewater.llm.components import connected_components
from tidewater.operators import join_back

SHINGLE = 5
BANDS, ROWS = 25, 5
#: Rounds of comparisons with changing members of a bucket's largest component.
PIVOT_ROUNDS = 1
#: Hash cells of a set's bitmap, for a bound on what two sets have in common.
BITS = 1024
#: Bytes hashed at a time; a longer word extends its block.
BLOCK = 1 << 20
_U = np.uint64
_BASE = 0xD6E8FEB86659FD93          # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MULT = splitmix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | _U(1)
_UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for a length of at least n."""
    size = max(BLOCK, 1 << (n - 1).bit_length())
    if size not in _powers:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and start offsets of the words of ``data``."""
    buf = np.frombuffer(data.lower(), np.uint8)
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, lo + BLOCK, "right")))
        block = buf[lo:ends[to - 1]]
        up, down = _power(len(block))
        total = np.concatenate((np.zeros(1, np.uint64),
                                np.cumsum((block.astype(np.uint64) + _U(1)) * up[:len(block)])))
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = splitmix((total[e] - total[s]) * down[s] ^ (e - s).astype(np.uint64))
        at = to
    return out, starts


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    words, starts = hash_words(b"\n".join(texts))
    first = np.searchsorted(starts, offsets)
    joined = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        joined += words[k:k + len(joined)] * _MULT[k]
    joined = splitmix(joined)
    sets = []
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        if hi - lo >= SHINGLE:
            sets.append(np.unique(joined[lo:hi - SHINGLE + 1]))
        elif hi > lo:
            short = (words[lo:hi] * _MULT[:hi - lo]).sum(dtype=np.uint64) + _U(hi - lo)
            sets.append(splitmix(np.array([short])))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def super_minhash(sets: list[np.ndarray], places: int = BANDS * ROWS) -> np.ndarray:
    """SuperMinHash signatures, one row of ``places`` values per set.

    An entry is kept as step j in the upper 32 bits and the uniform draw in
    the lower ones, i.e. j + r as a fixed-point number."""
    m = places
    sizes = np.array([len(s) for s in sets])
    sig = np.full(len(sets) * m, _UNSET)
    if not sizes.sum():
        return sig.reshape(len(sets), m)
    x = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), sizes)
    perm: np.ndarray | None = None     # of the elements still active, from step 1 on
    half, low = _U(32), _U(0xFFFFFFFF)
    for j in range(m):
        draw = splitmix(x + _U((j * 0xA24BAED4963EE407) & 0xFFFFFFFFFFFFFFFF))
        k = j + (((draw & low) * _U(m - j)) >> half).astype(np.int64)
        if perm is None:
            place = k
        else:
            rows = np.arange(len(x))
            place = perm[rows, k].astype(np.int64)
            perm[rows, k], perm[rows, j] = perm[rows, j], place
        np.minimum.at(sig, doc * m + place, (_U(j) << half) | (draw >> half))
        # early stop: a later step cannot go below its own number
        largest = sig.reshape(-1, m).max(axis=1) >> half
        go = (largest > _U(j))[doc]
        if not go.any():
            break
        if perm is None:
            x, doc, k = x[go], doc[go], k[go]
            perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32), (len(x), 1))
            rows = np.arange(len(x))
            perm[rows, k], perm[rows, 0] = 0, k
        elif not go.all():
            x, doc, perm = x[go], doc[go], perm[go]
    return sig.reshape(len(sets), m)


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band of each signature; equal entries, equal keys."""
    rows = sig.shape[1] // bands
    parts = splitmix(sig).reshape(len(sig), bands, rows)
    key = np.zeros((len(sig), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        key = splitmix(key ^ parts[:, :, k])
    return key


def _ids(batch: pa.RecordBatch, k: int) -> pa.Array:
    return batch.column(k).cast(pa.int64())


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            sets = shingle_sets(batch.column(1).to_pylist())
            keys = band_keys(super_minhash(sets))
            sizes = np.array([len(s) for s in sets], np.int64)
            sums = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
            mixes = np.array([np.bitwise_xor.reduce(splitmix(s)) if len(s) else 0 for s in sets],
                             np.uint64)
            flat = pa.array(keys.reshape(-1).view(np.int64))
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(0, flat.__len__() + 1, BANDS, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays(
                [_ids(batch, 0), pa.array(sizes), pa.array(sums.view(np.int64)),
                 pa.array(mixes.view(np.int64)), bands],
                names=["doc_id", "n", "k1", "k2", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            sets = shingle_sets(batch.column(1).to_pylist())
            sums = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
            ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
            flat = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [_ids(batch, 0), pa.array(sums.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), flat)], names=["id", "k", "items"])


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, ka, b, kb, na, nb) with the size of the intersection of the
    full sets, the exact Jaccard distance and whether they are linked."""
    of_a = sets.select(F.col("id").alias("a"), F.col("k").alias("ka"), F.col("items").alias("sa"))
    of_b = sets.select(F.col("id").alias("b"), F.col("k").alias("kb"), F.col("items").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(of_b, ["b", "kb"]).join(of_a, ["a", "ka"])
            .select("a", "ka", "b", "kb", "na", "nb", common.cast("long").alias("common"))
            .withColumn("either", F.col("na") + F.col("nb") - F.col("common"))
            .withColumn("dist", 1 - F.col("common") / F.col("either"))
            .withColumn("linked", 100 * F.col("common") >= percent * F.col("either"))
            .drop("either"))


def near_duplicates(docs: DataFrame, percent: int = 85, unique_ids: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.
    ``unique_ids`` says that no id repeats, so none is looked for.

    ``docs`` needs doc_id and text; other columns are ignored. Documents are
    linked when 100 * intersection >= percent * union of their shingle sets.
    A pair at exactly 85 per cent shares none of the 25 bands of five entries
    with a probability of 4e-7, at 80 per cent of 5e-5."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    signed = stage(base.mapInArrow(
        _sign, "doc_id long, n long, k1 long, k2 long, bands array<long>"), "signed")
    classes = (signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "k1", "k2")
               .agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")))
    classes = stage(classes, "classes")
    member = classes.select(F.explode("bands").alias("band"), "id", F.col("k1").alias("k"), "n")
    leaders = (member.groupBy("band")
               .agg(F.min(F.struct("id", "k", "n")).alias("lead"), F.count("*").alias("size"))
               .where("size > 1").drop("size"))
    buckets = stage(member.join(leaders, "band"), "buckets")
    led = buckets.where("NOT (id = lead.id AND k = lead.k)")
    ratio = F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb")
    first = (led.select(F.col("lead.id").alias("a"), F.col("lead.k").alias("ka"),
                        F.col("id").alias("b"), F.col("k").alias("kb"),
                        F.col("lead.n").alias("na"), F.col("n").alias("nb"))
             .where(ratio).distinct())
    wanted = (buckets.select("id").union(buckets.select("lead.id")).distinct()
              .withColumnRenamed("id", "doc_id"))
    sets = stage(base.join(wanted, "doc_id", "left_semi")
                 .mapInArrow(_sets, "id long, k long, items array<long>")
                 .dropDuplicates(["id", "k"]), "sets")
    tested = stage(_confirm(first, sets, percent), "tested")
    edges = tested.where("linked").select("a", "b")
    parts = connected_components(edges)
    for turn in range(PIVOT_ROUNDS):
        pairs = _to_pivots(_mixed(buckets, parts), turn, percent)
        more = stage(_confirm(pairs, sets, percent), "tested").where("linked").select("a", "b")
        if not more.limit(1).count():
            break
        edges = edges.union(more)
        parts = connected_components(edges)
    rest = _across(_mixed(buckets, parts), tested, signed_bands(classes), sets, percent)
    more = stage(_confirm(rest, sets, percent), "tested").where("linked").select("a", "b")
    same = None if unique_ids else _shared_ids(signed, classes)
    if more.limit(1).count() or same is not None:
        edges = edges.union(more)
        parts = connected_components(edges if same is None else edges.union(same))

    # class -> component -> documents; a class is a row per distinct set, and
    # its documents find it by the keys of the set
    joined = (classes.join(parts, classes["id"] == parts["node"], "left")
              .select("n", "k1", "k2", F.coalesce("component", "id").alias("component_id")))
    return _spread(signed.drop("bands"), joined)


def _shared_ids(signed: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Edges between the classes that one id has rows in; None where no id has."""
    key = F.struct("n", "k1", "k2")
    several = (signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id")
               .agg(F.min(key).alias("low"), F.max(key).alias("high"))
               .where("low != high").select("doc_id"))
    several = stage(several, "several")
    if several.isEmpty():
        return None
    of_id = (signed.join(several, "doc_id", "left_semi").select("doc_id", "n", "k1", "k2").distinct()
             .join(classes.select("n", "k1", "k2", "id"), ["n", "k1", "k2"]).select("doc_id", "id"))
    first = of_id.groupBy("doc_id").agg(F.min("id").alias("a"))
    return stage(of_id.join(first, "doc_id").select("a", F.col("id").alias("b")), "shared")


def signed_bands(classes: DataFrame) -> DataFrame:
    return classes.select("id", F.col("k1").alias("k"), "bands")


def _mixed(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """The classes of buckets that hold several components, with their own and
    their bucket's largest component."""
    comp = parts.select(F.col("node").alias("id"), "component")
    rows = (buckets.select("band", "id", "k", "n", F.col("lead.id").alias("la"),
                           F.col("lead.k").alias("lk"), F.col("lead.n").alias("ln"))
            .join(comp, "id", "left")
            .withColumn("component", F.coalesce("component", "id")))
    counts = rows.groupBy("band", "component").agg(F.count("*").alias("size"))
    several = (counts.groupBy("band")
               .agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("comps"))
               .where("comps > 1").select("band", F.col("top.component").alias("major")))
    return stage(rows.join(several, "band"), "mixed")


def _pairs(joined: DataFrame) -> DataFrame:
    """Distinct pairs (a, ka, b, kb, na, nb), a the smaller id, of columns u_* and v_*."""
    lower = F.col("u_id") < F.col("v_id")

    def pick(c: str, low: bool):
        one, two = (f"u_{c}", f"v_{c}") if low else (f"v_{c}", f"u_{c}")
        return F.when(lower, F.col(one)).otherwise(F.col(two))

    return joined.select(pick("id", True).alias("a"), pick("k", True).alias("ka"),
                         pick("id", False).alias("b"), pick("k", False).alias("kb"),
                         pick("n", True).alias("na"), pick("n", False).alias("nb")).distinct()


def _to_pivots(mixed: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each class outside its bucket's largest component with one member of
    that, another one in every band and turn: one pair per row."""
    pivots = (mixed.where("component = major").groupBy("band")
              .agg(F.min(F.struct(F.xxhash64("id", "band", F.lit(turn)).alias("h"), "id", "k", "n"))
                   .alias("p"))
              .select("band", *[F.col(f"p.{c}").alias(f"v_{c}") for c in ("id", "k", "n")]))
    rows = mixed.where("component != major").select(
        "band", *[F.col(c).alias(f"u_{c}") for c in ("id", "k", "n")])
    return _pairs(rows.join(pivots, "band").where(
        F.least("u_n", "v_n") * 100 >= percent * F.greatest("u_n", "v_n")))


def _held_in_common(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, k, common): how many shingles of each set occur in another one of
    ``rows`` too. No intersection of two of these sets is larger."""
    items = (rows.select("id", "k").distinct().join(sets, ["id", "k"])
             .select("id", "k", F.explode("items").alias("item")))
    twice = items.groupBy("item").agg(F.count("*").alias("df")).where("df > 1").select("item")
    return items.join(twice, "item").groupBy("id", "k").agg(F.count("*").alias("common"))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which of the ``BITS`` hash cells a set's elements fall into, as 64-bit words."""
    for batch in batches:
        out = np.zeros((batch.num_rows, BITS // 64), np.uint64)
        items = batch.column(2)
        ends = items.value_lengths().to_numpy(zero_copy_only=False)
        cell = splitmix(items.flatten().to_numpy().view(np.uint64)) % _U(BITS)
        row = np.repeat(np.arange(batch.num_rows), ends)
        np.bitwise_or.at(out, (row, (cell >> _U(6)).astype(np.int64)), _U(1) << (cell & _U(63)))
        flat = pa.array(out.reshape(-1).view(np.int64))
        starts = pa.array(np.arange(0, len(flat) + 1, BITS // 64, dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.ListArray.from_arrays(starts, flat)],
            names=["id", "k", "cells"])


def _outside(u: str, v: str):
    """Cells that only the first set has; as many of its elements, at least, aren't
    in the second."""
    own = F.zip_with(F.col(f"{u}_cells"), F.col(f"{v}_cells"),
                     lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b))).cast("long"))
    return F.aggregate(own, F.lit(0).cast("long"), lambda s, x: s + x)


def _across(mixed: DataFrame, tested: DataFrame, bands: DataFrame, sets: DataFrame,
            percent: int) -> DataFrame:
    """Pairs of a bucket that are still in different components and may be
    linked: every class outside the bucket's largest component against the
    others, each pair in the first band that it shares. Three exact bounds keep
    out what can't be linked: edited copies of one text have shingles that no
    other set has, the triangle inequality through the leader, and the hash cells
    that only one of the two sets has elements in."""
    far = (100 - percent) / 100 + 1e-9
    seen = tested.select(F.col("a").alias("la"), F.col("ka").alias("lk"), F.col("b").alias("id"),
                         F.col("kb").alias("k"), "dist")
    is_lead = (F.col("id") == F.col("la")) & (F.col("k") == F.col("lk"))
    rows = mixed.where(~is_lead)             # the leader's own pairs have all been compared
    common = _held_in_common(rows, sets)
    rows = stage(rows.join(common, ["id", "k"])
                 .where(F.col("common") * 100 >= percent * F.col("n"))
                 .join(seen, ["la", "lk", "id", "k"], "left")
                 .withColumn("lo", F.coalesce("dist", 1 - F.least("n", "ln") / F.greatest("n", "ln")))
                 .withColumn("hi", F.coalesce("dist", F.lit(1.0)))
                 .join(bands, ["id", "k"])
                 .select("band", "id", "k", "n", "component", "major", "lo", "hi", "bands",
                         "common"), "rest")
    cells = (rows.select("id", "k").distinct().join(sets, ["id", "k"]).select("id", "k", "items")
             .mapInArrow(_bitmaps, "id long, k long, cells array<long>"))
    rows = stage(rows.join(cells, ["id", "k"]), "cells")
    names = ("id", "k", "n", "component", "lo", "hi", "bands", "common", "cells")
    u = rows.where("component != major").select("band", *[F.col(c).alias(f"u_{c}") for c in names])
    v = rows.select("band", *[F.col(c).alias(f"v_{c}") for c in names])
    may = (F.col("u_component") != F.col("v_component")) & (F.col("u_id") != F.col("v_id"))
    near = F.least("u_n", "v_n") * 100 >= percent * F.greatest("u_n", "v_n")
    most = F.least("u_common", "v_common")
    near = near & (most * 100 >= percent * (F.col("u_n") + F.col("v_n") - most))
    # triangle inequality of the Jaccard distance, through the leader
    reach = (F.col("u_lo") - F.col("v_hi") <= far) & (F.col("v_lo") - F.col("u_hi") <= far)
    shared = F.array_intersect("u_bands", "v_bands")
    v = v.withColumnRenamed("band", "v_band")
    most = F.least(F.col("u_n") - _outside("u", "v"), F.col("v_n") - _outside("v", "u"))
    fits = most * 100 >= percent * (F.col("u_n") + F.col("v_n") - most)
    return _pairs(u.join(v, (F.col("band") == F.col("v_band")) & may & near & reach
                         & (F.array_min(shared) == F.col("band")) & fits))


def _spread(docs: DataFrame, classes: DataFrame, salts: int = 64) -> DataFrame:
    """Give each document its class's component. A set shared by a third of
    all rows is one hot key, so sets with several documents are salted."""
    sizes = (docs.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "k1", "k2")
             .agg(F.count("*").alias("size")))
    known = (classes.join(sizes, ["n", "k1", "k2"])
             .withColumn("salt", F.explode(F.when(
                 F.col("size") > salts, F.sequence(F.lit(0), F.lit(salts - 1)))
                 .otherwise(F.array(F.lit(0)))))
             .withColumn("wide", F.col("size") > salts))
    one = known.where("NOT wide").select("n", "k1", "k2", "component_id")
    many = known.where("wide").select("n", "k1", "k2", "salt", F.col("component_id").alias("c2"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")
    out = (docs.withColumn("salt", salt)
           .join(many, ["n", "k1", "k2", "salt"], "left")
           .withColumn("spread", F.when(F.col("c2").isNull() & (F.col("n") > 0), F.lit(0))
                       .otherwise(F.col("salt") + 1))
           .join(one.withColumn("spread", F.lit(0)), ["n", "k1", "k2", "spread"], "left"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c2", "component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near copies, with all
    columns. Rows are told apart by themselves, not by their ids: of rows that
    repeat an id those with a text of its own stay, and copies with null ids go.
    The row of the smallest id stays; null ids, and the rows of an id but its first,
    count as larger than all others."""
    ids = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.count("*").alias("n"), F.max(F.col("doc_id").cast("long")).alias("top"))
    most = ids.agg(F.max("top").alias("top"), F.max(F.col("doc_id").isNull() | (F.col("n") > 1))
                   .alias("any")).first()
    if not most["any"]:
        dropped = near_duplicates(docs, percent, unique_ids=True).where("NOT kept").select("doc_id")
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    repeated = stage(ids.where("n > 1 AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("_again")), "repeated")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    own = docs.select(row, F.col("doc_id").cast("long").alias("_id"))
    hit = F.col("_id") == F.col("_again")
    plain = own.where("_id IS NOT NULL").join(repeated, hit, "left_anti")
    other = (own.where("_id IS NULL")
             .union(own.where("_id IS NOT NULL").join(repeated, hit, "left_semi")))
    other = stage(other.select("row", "_id", F.monotonically_increasing_id().alias("_place")),
                  "repeated-rows")
    first = other.groupBy("_id").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    number = F.when(F.col("_id").isNotNull() & (F.col("_place") == F.col("_first")), F.col("_id")) \
        .otherwise(F.lit((most["top"] or 0) + 1) + F.col("_place"))
    other = join_back(other, first, ["_id"], "_rows", F.xxhash64("_place")).withColumn("_id", number)
    rows = plain.select("row", "_id").union(other.select("row", "_id"))
    seen = rows.select(F.col("_id").alias("doc_id"), F.col("row.text").alias("text"))
    dropped = (near_duplicates(seen, percent, unique_ids=True).where("NOT kept")
               .select(F.col("doc_id").alias("_gone")))
    return rows.join(dropped, F.col("_id") == F.col("_gone"), "left_anti").select("row.*")
