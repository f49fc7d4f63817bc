"""Vector code compression: product codebooks found with exact limb-split matrix products.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook. The
nearest entry of a part comes from |x|² - 2 x·c + |c|², all in whole numbers. The dot products are
matrix products of limbs: every number is cut into limbs of so few bits that no sum of a float64
product passes 2^53, so the products are exact whatever order BLAS sums in; shifted and added in int64 they
give the exact dot product, and the first least distance is the lowest entry of a tie.

Each round is one pass over a written table of the vectors. A task hands on one sum and count per
codebook slot, whatever the number of its vectors, and Spark adds them up; the driver holds nothing but the
codebooks (parts x entries x width numbers).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from paysight.runtime import SmallTable

from .common import Scratch, table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 30  # of |component| times the root of the length: no distance passes 2^62
EXACT_BITS = 53  # whole numbers up to 2^53 are exact in float64
ROWS_AT_ONCE = 1 << 13


def whole_vector(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null where the vector is null, empty or has a component that is
    null, not finite or too large (scale * |x| * sqrt(length) is 2^30 or more, where a distance would not fit a long)."""
    x = F.transform(vector, lambda x: x.cast("double") * scale)
    sound = F.forall(x, lambda y: F.coalesce(F.abs(y) * F.sqrt(F.size(vector)) < LARGEST, F.lit(False)) & ~F.isnan(y))
    return F.when((F.size(vector) > 0) & sound, F.transform(x, lambda y: F.floor(y).cast("long")))


def limbs_of(x: np.ndarray, bits: int, n: int) -> list[np.ndarray]:
    """x as n limbs, the lowest first: whole numbers in float64, from 0 to 2^bits - 1 but for the signed last one."""
    out = []
    for _ in range(n - 1):
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def exact_dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x @ c.T of int64 matrices by float64 products of limbs, exact as long as the result fits int64."""
    width = max(1, x.shape[1])
    bits = (EXACT_BITS - (width - 1).bit_length()) // 2
    need = lambda a: max(1, -(-int(np.abs(a).max(initial=0)).bit_length() // bits))
    out = np.zeros((len(x), len(c)), np.int64)
    right = limbs_of(c, bits, need(c))
    for i, a in enumerate(limbs_of(x, bits, need(x))):
        for j, b in enumerate(right):
            out += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(x: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the first nearest entry, and the squared distance to it."""
    code, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    norms = (codebook * codebook).sum(axis=1)
    for k in range(0, len(x), ROWS_AT_ONCE):
        some = x[k : k + ROWS_AT_ONCE]
        distance = norms - 2 * exact_dots(some, codebook) + (some * some).sum(axis=1)[:, None]
        at = distance.argmin(axis=1)
        code[k : k + ROWS_AT_ONCE], error[k : k + ROWS_AT_ONCE] = at, distance[np.arange(len(some)), at]
    return code, error


@dataclass
class Codebooks:
    """entries[part, entry, position], int64."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, code: str) -> list[int]:
        """The vector that a code stands for."""
        return [int(v) for part, e in enumerate(bytes.fromhex(code)) for v in self.entries[part, e]]


def _parts(column: pa.Array, parts: int) -> np.ndarray:
    """(row, part, position) of a column of lists of one length."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), parts, -1)


def _sums(books: np.ndarray):
    """A task's sums and counts by codebook slot."""
    parts, entries, width = books.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            x = _parts(batch[0], parts)
            for p in range(parts):
                own = np.ascontiguousarray(x[:, p])
                code, _ = nearest(own, books[p])
                counts[p] += np.bincount(code, minlength=entries)
                np.add.at(sums[p], code, own)
        part, entry = np.nonzero(counts)
        slot = ((part * entries + entry)[:, None] * width + np.arange(width)).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot), pa.array(sums[part, entry].ravel()), pa.array(np.repeat(counts[part, entry], width))], ["slot", "s", "n"]
        )

    return task


def fit_codebooks(vectors: DataFrame, id_col: str, vector_col: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of whole vectors (none null, all of one length, a multiple of ``parts``): begun from the vectors of the
    least ids (nulls last, ties by components), then ``rounds`` times assigned and averaged (floored)."""
    first = vectors.select(F.col(id_col).alias("i"), F.col(vector_col).alias("v")).orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).collect()
    start = np.array([r["v"] for r in first], np.int64)
    if not len(first) or start.shape[1] % parts:
        raise ValueError(f"no vectors, or their length is no multiple of {parts}")
    books = np.ascontiguousarray(start.reshape(len(first), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        counted = vectors.select(vector_col).mapInArrow(_sums(books), "slot long, s long, n long")
        exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("s", "n")]
        flat = books.ravel().copy()
        for r in counted.groupBy("slot").agg(*exact).collect():
            flat[r["slot"]] = int(r["s"]) // int(r["n"])
        books = flat.reshape(books.shape)
    return Codebooks(books)


def encode(vector: Column, books: Codebooks, spark) -> Column:
    """Struct (code, error): two hex digits per part, and the squared distances summed over the parts."""
    shared = spark.sparkContext.broadcast(books.entries)
    parts = len(books.entries)

    @arrow_udf("struct<code:string,error:long>")
    def of(column: pa.Array) -> pa.Array:
        x = _parts(column, parts)
        codes, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
        for p in range(parts):
            code, distance = nearest(np.ascontiguousarray(x[:, p]), shared.value[p])
            codes[:, p] = code
            error += distance
        return pa.StructArray.from_arrays([pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)], ["code", "error"])

    return of(vector)


def vector_codes(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(id_col, code, error, label_error, codebooks_sha256) of every row whose vector ``whole_vector`` accepts.

    Repeated rows and ids count as often as they occur and come out as often; null ids come after all others. With
    fewer rows than ``entries`` (at most 256) the codebooks are that much smaller; ties go to the lower entry. label_error sums the errors
    of equal labels, nulls together, and is null if that passes a long. An empty table, or one without an
    accepted vector, gives an empty result; vectors of different lengths, or of a length that is no multiple of ``parts``,
    raise ValueError. Other columns of ``df``, whatever their names, are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: entries must be from 1 to 256")
    spark = df.sparkSession
    scratch = Scratch(spark, "vector-codes")
    whole = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), whole_vector(F.col(vector_col)).alias("v"))
    vectors = scratch.write(whole.filter("v IS NOT NULL"), "vectors")
    n, least, most = vectors.agg(F.count("*"), F.min(F.size("v")), F.max(F.size("v"))).first()
    if n and (least != most or most % parts):
        raise ValueError(f"vectors have {least} to {most} components; all must have the same, a multiple of {parts}")
    if not n:
        books = Codebooks(np.zeros((parts, 1, 1), np.int64))
    else:
        books = fit_codebooks(vectors, "id", "v", parts, entries, rounds)
    coded = scratch.write(vectors.select("id", "label", encode(F.col("v"), books, spark).alias("e")).select("id", "label", "e.*"), "codes")
    scratch.drop("vectors")
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    by_label = SmallTable(sums.withColumnRenamed("label", "l"))
    return coded.join(by_label.for_join(), F.col("label").eqNullSafe(F.col("l")), "left").select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _rounds_sql(rounds: int) -> str:
    """Assignments a0.. to codebooks c0.., each codebook from the assignment before."""
    out = []
    for k in range(rounds + 1):
        if k:
            out.append(f"""c{k} AS (
  SELECT c.part, c.entry, c.pos, coalesce(m.mean, c.c) AS c FROM c{k - 1} c LEFT JOIN (
    SELECT x.part, a.entry, x.pos, (sum(x.x) - ((sum(x.x) % count(*)) + count(*)) % count(*)) // count(*) AS mean
    FROM xs x JOIN a{k - 1} a USING (rid, part) GROUP BY x.part, a.entry, x.pos
  ) m USING (part, entry, pos)
)""")
        out.append(f"""a{k} AS (
  SELECT rid, part, arg_min(entry, d * 1000 + entry) AS entry, min(d) AS d FROM (
    SELECT x.rid, x.part, c.entry, CAST(sum((x.x - c.c) * (x.x - c.c)) AS BIGINT) AS d
    FROM xs x JOIN c{k} c USING (part, pos) GROUP BY x.rid, x.part, c.entry
  ) GROUP BY rid, part
)""")
    return ",\n".join(out)


OP13_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS rid, vec_id, label, embedding,
         len(embedding) // {PARTS} AS width
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), xs AS (
  SELECT rid, (i - 1) // width AS part, (i - 1) % width AS pos, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS HUGEINT) AS x
  FROM (SELECT rid, width, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)
), c0 AS (SELECT part, rid AS entry, pos, x AS c FROM xs WHERE rid < {ENTRIES}),
{_rounds_sql(ROUNDS)},
codes AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY rid
), books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (rid) CROSS JOIN books
"""
