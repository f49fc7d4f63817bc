import hashlib
import math

import numpy as np
import pytest

from paysight.llm import vector_codes as V


def plain(rows, parts=16, entries=64, rounds=2):
    """Python integers only; rows are (id, vector, label)."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = [[v[p * w : p * w + w] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (distance(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, code in zip(cut, codes) if code[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    codes = assign()
    errors = [sum(distance(c[p], books[p][code[p]]) for p in range(parts)) for c, code in zip(cut, codes)]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    by = {}
    for (_, _, lab), e in zip(kept, errors):
        by[lab] = by.get(lab, 0) + e
    return sorted(((i, bytes(code).hex(), e, by[lab], digest) for (i, _, lab), code, e in zip(kept, codes, errors)), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], "vec_id long, embedding array<double>, label int, v string, id int")


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_nulls_ties_repeated_rows_and_clashing_names(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), (rng.integers(-3, 4, 32) / 8).tolist(), int(k) % 4 or None) for k in range(150)]  # few values: many ties
    rows += [rows[7], rows[7], (9, rows[12][1], 2), (None, rows[3][1], 1), (500, None, 1), (501, [], 1)]
    rows += [(502, [None] + [0.0] * 31, 1), (503, [math.nan] + [0.0] * 31, 1), (504, [math.inf] * 32, 1), (505, [1e300] * 32, 1)]
    sound = [r for r in rows if r[0] != 505]  # too large for a long, as the docstring says
    assert got(V.vector_codes(frame(spark, rows).repartition(3))) == plain(sound)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(k, (rng.integers(-(2**27), 2**27, 48) / 512).tolist(), 1) for k in range(90)]
    assert got(V.vector_codes(frame(spark, rows))) == plain(rows)


def test_few_rows_and_none(spark):
    rows = [(k, [k / 7] * 16, None) for k in range(5)]
    assert got(V.vector_codes(frame(spark, rows))) == plain(rows)
    assert V.vector_codes(frame(spark, [])).count() == 0
    assert V.vector_codes(frame(spark, [(1, None, 1)])).count() == 0
    for bad in ([(1, [0.5] * 17, 1)], [(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)]):
        with pytest.raises(ValueError):
            V.vector_codes(frame(spark, bad))


@pytest.mark.parametrize("size,width", [(2**10, 4), (2**28, 7), (2**29, 4), (2**30, 1), (2**20, 1000)])
def test_dot_products_are_exact(size, width):
    rng = np.random.default_rng(width)
    x, c = rng.integers(-size, size, (40, width)), rng.integers(-size, size, (9, width))
    x[0], c[0] = -size, -size
    want = [[sum(a * b for a, b in zip(u, v)) for v in c.tolist()] for u in x.tolist()]
    assert V.exact_dots(x, c).tolist() == want


def test_codes_decode_to_their_entries(spark):
    rows = [(k, [(k * j % 11) / 4 for j in range(32)], 0) for k in range(80)]
    df = frame(spark, rows)
    vectors = df.select("vec_id", V.whole_vector(df.embedding).alias("w"))
    books = V.fit_codebooks(vectors, "vec_id", "w")
    for r in vectors.select("w", V.encode(vectors.w, books, spark).alias("e")).collect():
        assert sum((a - b) ** 2 for a, b in zip(r.w, books.decode(r.e.code))) == r.e.error
