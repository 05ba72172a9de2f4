"""Line dedup, centroid clustering and vector codes against brute force, on whole tables and odd rows."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import clustering, codes, lines, queries, vectors
from rollcall.llm.tables import matched

SF = "/root/testdata/sf0.001"
LICENCE = "This file may be used under the terms of the ünited licence, see there."
BLANKS = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))


def brute_lines(rows, shortest=40, documents=5):
    """Every row's lines, dropped ones and what is left."""
    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= shortest:
                holders[key_of(line)].add(-math.inf if i is None else i)
    keeper = {k: max(ids) for k, ids in holders.items() if len(ids) >= documents}
    out = []
    for i, text in rows:
        split = (text or "").split("\n")
        left = [x for x in split if keeper.get(key_of(x), i) == (-math.inf if i is None and key_of(x) in keeper else i)]
        out.append((i, len(split), len(split) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def got_lines(frame, settings=lines.Settings()):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in lines.drop_shared(frame, settings).collect()), key=str)


def odd_texts():
    """Shared lines in all shapes: in other case and blanks, twice in a text, in copies, without an id."""
    rnd = random.Random(4)
    own = lambda: " ".join(str(rnd.random()) for _ in range(4))
    rows = [(i, f"{own()}\n  {LICENCE.upper() if i % 2 else LICENCE}\r\n{own()}\n\n{LICENCE}") for i in range(7)]
    rows += [(6, "another text of document six\n" + LICENCE)] * 2
    rows += [(None, LICENCE), (None, LICENCE + "\nx"), (None, None), (20, None), (21, ""), (22, "\n\n"), (23, " \t\x0b" * 30)]
    rows += [(30 + i, "x" * 40) for i in range(4)] + [(40 + i, "y" * 39) for i in range(9)] + [(50 + i, "z" * 40) for i in range(5)]
    rows += [(60, "only once but long enough to count as a line\n" * 50_000), (61, " " + "n" * 40), (62, "n" * 40)]
    rows += [(70 + i, f"{'é' * 40}\n{'a' * 39} \n{own()}") for i in range(6)]
    return rows


def test_lines(spark):
    rows = odd_texts()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "*", F.lit(1).alias("at"), F.lit("k").alias("key"), F.lit(2).alias("n"), F.lit(3).alias("drop"), F.lit(4).alias("h1"), F.lit(5).alias("id")
    )
    assert got_lines(frame) == brute_lines(rows)
    three = lines.Settings(shortest=3, documents=2)
    assert got_lines(frame, three) == brute_lines(rows, 3, 2)
    assert lines.drop_shared(frame.limit(0)).collect() == []
    # By hand: the last holder keeps all its lines, others lose theirs.
    kept = {(i, n, d) for i, n, d, _ in got_lines(frame)}
    assert (6, 5, 0) in kept and (5, 5, 1) in kept and (0, 5, 2) in kept and (None, 1, 1) in kept
    assert (54, 1, 0) in kept and (53, 1, 1) in kept and (33, 1, 0) in kept and (48, 1, 0) in kept


def test_lines_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    expected = brute_lines([tuple(r) for r in docs.collect()])
    assert sum(d for _, _, d, _ in expected) > 0
    got = queries.QUERIES["op11_shared_lines"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted((i, n, d, sha(t)) for i, n, d, t in expected)


def test_matched(spark):
    """Heavy keys and light ones, null among them, meet their row once; rows without one leave."""
    rows = [(k, v) for k, n in ((None, 500), (1, 700), (2, 3), (3, 1), (9, 4)) for v in range(n)]
    left = spark.createDataFrame(rows, "k int, v int")
    table = spark.createDataFrame([(None, "null", 500), (1, "one", 700), (2, "two", 3), (3, "three", 1), (4, "four", 0)], "k int, said string, n bigint")
    got = collections.Counter((r.k, r.said) for r in matched(left, table, ["k"], len(rows), shares=10).collect())
    assert got == {(None, "null"): 500, (1, "one"): 700, (2, "two"): 3, (3, "three"): 1}


def kept_vectors(rows, scale, dims=64):
    return [
        (i, label, [math.floor(scale * x) for x in v]) for i, v, label in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]


def closest(point, centres):
    return min((sum((a - b) ** 2 for a, b in zip(point, c)), j) for j, c in enumerate(centres))


def brute_clusters(rows, clusters=8, rounds=10):
    kept = kept_vectors(rows, 1024)
    order = sorted(kept, key=lambda r: (r[0] is None, sha(f"3:{r[0]}") if r[0] is not None else "", r[2]))
    centres = [r[2] for r in order[:clusters]]
    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, _, v in kept:
            groups[closest(v, centres)[1]].append(v)
        centres = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centres)]
    found = [(i, *closest(v, centres)[::-1]) for i, _, v in kept]
    total = collections.Counter()
    for _, c, d in found:
        total[c] += d
    return sorted(((i, c, d, total[c], sum(total.values()), sha(",".join(map(str, centres[c])))) for i, c, d in found), key=str)


def brute_codes(rows, entries=16, rounds=6):
    kept = kept_vectors(rows, 4096)
    cut = lambda v: [v[p * 8 : p * 8 + 8] for p in range(8)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(r[2])[p] for r in first] for p in range(8)]
    for _ in range(rounds):
        for p in range(8):
            groups = collections.defaultdict(list)
            for r in kept:
                groups[closest(cut(r[2])[p], books[p])[1]].append(cut(r[2])[p])
            books[p] = [[sum(x) // len(groups[e]) for x in zip(*groups[e])] if e in groups else c for e, c in enumerate(books[p])]
    found, total = [], collections.Counter()
    for i, label, v in kept:
        best = [closest(x, books[p]) for p, x in enumerate(cut(v))]
        found.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
        total[label] += found[-1][2]
    digest = sha(",".join(str(x) for b in books for e in b for x in e))
    return sorted(((i, c, e, total[label], digest) for i, c, e, label in found), key=str)


def odd_vectors():
    """Nulls, other lengths, non-finite numbers, ties, repeated rows and ids, large and tiny numbers."""
    rnd = random.Random(9)
    some = lambda size=64, by=1.0: [rnd.gauss(0, by) for _ in range(size)]
    rows = [(i, some(), i % 3 if i % 4 else None) for i in range(60)]
    rows += [(100, None, 1), (101, [], 1), (102, some(63), 1), (103, some(65), 1), (104, [None] + some(63), 2), (105, [None] * 64, 2)]
    rows += [(106, some(63) + [math.nan], 1), (107, [math.inf] + some(63), 1), (108, some(63) + [-math.inf], 1)]
    rows += [rows[3], rows[3], (3, some(), 0), (None, some(), 0), (None, some(), None)]
    rows += [(120 + i, [0.0] * 64, 2) for i in range(5)] + [(130, [-0.0] * 64, 2), (131, [2.0 / 1024] * 64, 2), (132, [1e-9] * 64, 2), (133, [-1e-9] * 64, 2)]
    return rows


@pytest.mark.parametrize("operator, brute", [(lambda f: clustering.cluster(f), brute_clusters), (lambda f: codes.compress(f), brute_codes)])
def test_vectors(spark, operator, brute):
    schema = "vec_id bigint, vector array<double>, label int"
    rows = odd_vectors()
    frame = spark.createDataFrame(rows, schema).select("*", F.lit(1).alias("n"), F.lit(2).alias("cluster"), F.lit(3).alias("point"), F.lit(4).alias("code"))
    ours = lambda df: sorted(map(tuple, operator(df).collect()), key=str)
    assert ours(frame) == brute(rows)
    assert ours(frame.repartition(5)) == brute(rows)
    assert ours(frame.limit(0)) == []
    assert ours(frame.where("vec_id in (100, 101, 104, 106)")) == []
    few = [r for r in rows if r[0] in (1, 2, 120, 121)]
    assert ours(spark.createDataFrame(few, schema)) == brute(few)
    # Beyond 64-bit squares, yet with distances that fit: large parts in common.
    wide = [(i, [3e8 + (i % 5) * 64 + j / 7 for j in range(64)], i % 2) for i in range(40)]
    assert ours(spark.createDataFrame(wide, schema)) == brute(wide)
    # Distances that do not fit are the largest long.
    far = [(i, [1e12 * (-1) ** i * (1 + i)] * 64, 0) for i in range(40)]
    assert max(r[2] for r in brute(far)) > vectors.LONG_MAX
    assert max(r[2] for r in ours(spark.createDataFrame(far, schema))) == vectors.LONG_MAX


def test_vectors_of_the_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    for name, brute in (("op12_rotated_centroids", brute_clusters), ("op13_slice_codes", brute_codes)):
        assert sorted(map(tuple, queries.QUERIES[name](spark, SF).collect()), key=str) == brute(rows)


def test_bounds_leave_out_most_and_never_the_nearest():
    rnd = np.random.default_rng(1)
    points = np.floor(rnd.normal(size=(3000, 64)) * np.geomspace(3000, 3, 64)).astype(np.int64)
    centres = points[:8].copy()
    centres[5] = centres[2]
    _, axes = np.linalg.eigh(np.cov(points.T.astype(float)))
    found = clustering.Rotation(points.mean(axis=0), axes[:, ::-1][:, :16])
    lead, rest = found.project(points)
    exact = ((points[:, None] - centres) ** 2).sum(axis=2)
    best, distance = clustering.nearest(points, lead.astype(np.float32), rest, centres, found)
    assert (best == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    lead_c, rest_c = found.project(centres)
    below = ((lead[:, None] - lead_c) ** 2).sum(axis=2) + (rest[:, None] - rest_c) ** 2
    assert (below <= exact * (1 + 1e-9) + 1).all()
    assert (below <= exact.min(axis=1)[:, None]).sum() < 0.4 * exact.size


def test_masks_hold_exactly_the_entries_within_the_radius():
    rnd = np.random.default_rng(2)
    for entries, spread in ((64, 5), (16, 500), (1, 9), (3, 1)):
        book = rnd.integers(-spread, spread, size=(entries, 8))
        points = rnd.integers(-spread, spread, size=(400, 8))
        radius = rnd.integers(0, spread, size=400)
        mask = codes.Slices(book).candidates(points, radius)
        inside = (np.abs(points[:, None] - book) <= radius[:, None, None]).all(axis=2)
        assert (((mask[:, None] >> np.arange(entries, dtype=np.uint64)) & np.uint64(1)).astype(bool) == inside).all()
        best, distance = codes.Slices(book).nearest(points)
        exact = ((points[:, None] - book) ** 2).sum(axis=2)
        assert (best == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    with pytest.raises(ValueError):
        codes.Settings(entries=65)
