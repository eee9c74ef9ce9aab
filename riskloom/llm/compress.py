"""Product codes of vectors by exact integer arithmetic on float64 BLAS.

Components become integers ``floor(1024 * x)``; a vector is cut into four
equal parts and each part is replaced by the index of its nearest codebook
entry. Distances come from matrix products: the integers are broken into limbs
so short that a float64 product of two limb matrices stays below 2**53 and is
therefore exact; the limb products are put together again in int64, and the
first smallest distance wins. Codebooks (a fixed number of entries) travel to
the tasks; what comes back from a round is one sum and count an entry.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored
from riskloom.session import ship_package

SCALE = 1024     # integers are floor(SCALE * x)
PARTS = 4
ENTRIES = 256    # of a part's codebook: an index has two hex digits
ROUNDS = 4
HELD = 2 ** 40   # integers are held within -HELD .. HELD
FAR = 2 ** 62    # squared distances are held at FAR
STEP = 4096      # rows whose distances are held at once
FLUSH = 2 ** 20  # rows after which a task hands on its sums (2**20 * HELD < 2**63)
SUMS = "part int, entry int, n long, sums array<long>"


def _limbs(x: np.ndarray, bits: int, most: int) -> list[np.ndarray]:
    """float64 limbs, lowest first: all but the last lie in [0, 2**bits)."""
    out = []
    while most >= 1 << bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x, most = x >> bits, most >> bits
    return [*out, x.astype(np.float64)]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, modulo 2**64."""
    width = max(a.shape[1], 1)
    bits = (52 - (width - 1).bit_length()) // 2  # width * 2**bits * 2**bits <= 2**52
    most = lambda x: int(np.abs(x).max(initial=0))
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    for i, low in enumerate(_limbs(a, bits, most(a))):
        for j, high in enumerate(_limbs(b, bits, most(b))):
            out += (low @ high.T).astype(np.int64) << np.int64(bits * (i + j))
    return out


def nearest_entries(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of ``book`` (the lowest on ties) and the squared distance."""
    with np.errstate(over="ignore"):  # sums that wrap come out right whenever the distance fits
        dist = (x * x).sum(axis=1)[:, None] - 2 * products(x, book) + (book * book).sum(axis=1)
    reach = int(np.abs(x).max(initial=0)) + int(np.abs(book).max(initial=0))
    if reach * reach * max(x.shape[1], 1) >= FAR:
        xf, bf = x.astype(np.float64), book.astype(np.float64)
        rough = (xf * xf).sum(axis=1)[:, None] - 2.0 * xf @ bf.T + (bf * bf).sum(axis=1)
        dist = np.where(rough > FAR + 2.0 ** 48, FAR, np.minimum(dist, FAR))
    best = dist.argmin(axis=1)
    return best, dist[np.arange(len(x)), best]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), width)


def _chunks(batch: pa.RecordBatch, width: int):
    for at in range(0, batch.num_rows, STEP):
        part = batch.slice(at, STEP)
        yield part, _matrix(part.column("ints"), width)


def _sums(books, width: int):
    """Sums and counts of the parts nearest to each entry, from one task's rows."""
    cut = width // PARTS

    def flush(n, sums):
        part, entry = np.nonzero(n)
        return pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry], pa.int64()),
             pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    def run(batches):
        book = books.value
        n = np.zeros(book.shape[:2], dtype=np.int64)
        sums = np.zeros(book.shape, dtype=np.int64)
        seen = 0
        for batch in batches:
            for part, x in _chunks(batch, width):
                for p in range(PARTS):
                    mine = x[:, p * cut:(p + 1) * cut]
                    entry, _ = nearest_entries(mine, book[p])
                    n[p] += np.bincount(entry, minlength=len(book[p]))
                    np.add.at(sums[p], entry, mine)
                seen += len(x)
                if seen >= FLUSH:
                    yield flush(n, sums)
                    n[:], sums[:], seen = 0, 0, 0
        yield flush(n, sums)
    return run


def _codes(books, width: int):
    cut = width // PARTS

    def run(batches):
        book = books.value
        for batch in batches:
            for part, x in _chunks(batch, width):
                found = [nearest_entries(x[:, p * cut:(p + 1) * cut], book[p]) for p in range(PARTS)]
                text = ["%02x%02x%02x%02x" % row for row in zip(*(e.tolist() for e, _ in found))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), pa.array(text, pa.string()),
                     pa.array([sum(d) for d in zip(*(d.tolist() for _, d in found))], pa.decimal128(38))],
                    names=["vec_id", "label", "code", "error"])
    return run


def integer_rows(df: DataFrame, id_col: str, vec_col: str, label_col: str | None) -> DataFrame:
    """``vec_id, label, ints`` of the vectors that hold finite components only."""
    vec = F.col(vec_col).cast("array<double>")
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), vec.alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    held = lambda x: F.greatest(F.lit(-float(HELD)), F.least(F.lit(float(HELD)), x * float(SCALE)))
    return (rows.filter(F.col("vec").isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select("vec_id", "label", F.transform("vec", lambda x: F.floor(held(x)).cast("long")).alias("ints")))


def train(rows: DataFrame, width: int, rounds: int = ROUNDS, entries: int = ENTRIES) -> np.ndarray:
    """Codebooks (part, entry, position) after ``rounds`` rounds over all rows."""
    spark = rows.sparkSession
    first = (rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select("ints").limit(entries).collect())
    cut = width // PARTS
    book = np.array([r.ints for r in first], dtype=np.int64).reshape(len(first), PARTS, cut).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        sent = spark.sparkContext.broadcast(book)  # PARTS * entries * cut integers
        sums = rows.select("ints").mapInArrow(_sums(sent, width), SUMS)
        new = (sums.select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
               .groupBy("part", "entry", "at")
               .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")))
        book = book.copy()
        for r in new.toLocalIterator():  # one row for each component of a codebook
            book[r.part, r.entry, r.at] = int(r.x) // int(r.n)
        sent.unpersist()
    return book


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label",
             rounds: int = ROUNDS, entries: int = ENTRIES) -> DataFrame:
    """Codes of all vectors: ``vec_id, code, error, label_error, codebooks_sha256``.

    A row takes part if its vector is neither null nor empty, holds no null or
    non-finite component, and has the length that most such vectors have (the
    longer one on ties) among lengths that four parts divide. Integers beyond
    2**40 are held there, squared distances at 2**62, sums of them at the
    largest long. Each row counts, repeated rows and rows that share an id
    too; the codebooks start from the smallest ids, null ids last, equal ids
    by their integers. Fewer rows than ``entries``: that many entries. Null
    labels are one label. No usable row: no result. Other columns of ``df``
    are ignored whatever their names.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = stored(integer_rows(df, id_col, vec_col, label_col), "integer-vectors")
    size = F.size("ints")
    most = (rows.filter((size > 0) & (size % PARTS == 0)).groupBy(size.alias("width"))
            .count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect())
    width = most[0]["width"] if most else PARTS
    rows = rows.filter(size == width)
    book = train(rows, width, rounds, entries)
    digest = hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()
    sent = spark.sparkContext.broadcast(book)
    kind = rows.schema["label"].dataType.simpleString()
    coded = stored(rows.mapInArrow(_codes(sent, width), f"vec_id long, label {kind}, code string, error decimal(38,0)"), "codes")
    largest = F.lit(2 ** 63 - 1).cast("decimal(38,0)")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.least(F.sum("error"), largest).cast("long").alias("label_error"))
    return (coded.join(by_label, coded["label"].eqNullSafe(by_label["of"]))
            .select("vec_id", "code", F.least("error", largest).cast("long").alias("error"), "label_error",
                    F.lit(digest).alias("codebooks_sha256")))


def oracle(rounds: int = ROUNDS, width: int = 64) -> str:
    """DuckDB SQL of the same rows over ``embeddings`` of 64 components."""
    cut = width // PARTS
    steps, book = [], "c0"
    gap = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(p.x, b.c)])"
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT p.r, p.part, min({gap} * 256 + b.e) AS de
            FROM p JOIN {book} b ON b.part = p.part GROUP BY p.r, p.part)""")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT part, e, list(CAST(floor(t / n) AS BIGINT) ORDER BY i) AS c FROM
                (SELECT a.part, CAST(a.de % 256 AS BIGINT) AS e, u.i, CAST(sum(p.x[u.i]) AS DOUBLE) AS t, CAST(count(*) AS DOUBLE) AS n
                 FROM a{i} a JOIN p ON p.r = a.r AND p.part = a.part, range(1, {cut + 1}) u(i)
                 GROUP BY ALL) GROUP BY part, e)""")
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT b.part, b.e, coalesce(s.c, b.c) AS c
                FROM {book} b LEFT JOIN s{i} s ON s.part = b.part AND s.e = b.e)""")
            book = f"c{i + 1}"
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS a
  FROM embeddings WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (SELECT r, vec_id, CAST(t.j AS BIGINT) AS part, a[{cut} * t.j + 1 : {cut} * t.j + {cut}] AS x FROM v, range({PARTS}) t(j)),
c0 AS MATERIALIZED (SELECT part, e, c FROM
  (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x AS c FROM p) WHERE e < {ENTRIES}),
{", ".join(steps)},
f AS (SELECT r, string_agg(printf('%02x', CAST(de % 256 AS INTEGER)), '' ORDER BY part) AS code,
        CAST(sum((de - de % 256) / 256) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
g AS (SELECT v.label, CAST(sum(f.error) AS BIGINT) AS label_error FROM f JOIN v ON v.r = f.r GROUP BY v.label),
h AS (SELECT sha256(string_agg(CAST(c[u.i] AS VARCHAR), ',' ORDER BY part, e, u.i)) AS d FROM {book}, range(1, {cut + 1}) u(i))
SELECT v.vec_id, f.code, f.error, g.label_error, h.d AS codebooks_sha256
FROM v JOIN f ON f.r = v.r JOIN g ON g.label IS NOT DISTINCT FROM v.label, h
"""
