"""Product quantisation of vectors by member-resident Lloyd rounds on integers.

A vector is cut into equal parts. A part belongs to the owner (position, entry,
salt) and lives in that owner's partition; the salt spreads the members of one
entry evenly over all partitions, however many there are. In a round an owner
compares its resident members with the new codebooks; those that stay do not move,
those whose entry changes are the only ones in the round's shuffle, on their way
to the owner of their new entry. Sums and counts of the resident members give the
next codebooks. A codebook entry is the floor of an exact integer mean, so results
do not depend on the order of members or on retries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..operators.keys import lookup, shared_folder
from .registry import query, table
from .store import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integer components are at most this far from 0, so that squared distances are exact; |x| <= 2048 at the usual scale.
LARGEST = 1 << 23
#: Members that one block holds, and about the bytes of members of one partition.
BLOCK, PARTITION_BYTES = 1 << 13, 32 << 20
#: Rounds after which the members are written to the shared folder, so that a lost executor costs a few rounds at most.
CHECKPOINT = 3


def integers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component, at most ``LARGEST`` from 0; null where a component is null, NaN or infinite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is greater than infinity
    limit = float(LARGEST)
    return F.when(finite, F.transform(wide, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(limit)), F.lit(-limit))).cast("int")))


def _distances(members: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of all members to all entries, as int64."""
    largest = int(max(np.abs(members).max(initial=0), np.abs(book).max(initial=0)))
    kind = np.float64 if members.shape[1] * (2 * largest) ** 2 < 1 << 53 else np.int64
    m, c = members.astype(kind), book.astype(kind)
    found = (m * m).sum(1)[:, None] - 2 * (m @ c.T) + (c * c).sum(1)[None, :]
    return found.astype(np.int64)


def _nearest(members: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (the lowest of equals) and squared distance."""
    found = _distances(members, book)
    entry = found.argmin(1)
    return entry, found[np.arange(len(found)), entry]


def _narrow(members: np.ndarray) -> np.ndarray:
    largest = int(np.abs(members).max(initial=0))
    return members.astype(np.int8 if largest < 128 else np.int16 if largest < 1 << 15 else np.int32)


class Owners:
    """Numbers of the owners and their partitions: one salt of every (position, entry) in each partition."""

    def __init__(self, entries: int, salts: int):
        self.entries, self.salts = entries, salts

    def number(self, position: int, entry: int, salt: int) -> int:
        return (position * self.entries + entry) * self.salts + salt

    def split(self, number: int) -> tuple[int, int, int]:
        group, salt = divmod(number, self.salts)
        return *divmod(group, self.entries), salt

    def partition(self, number: int) -> int:
        group, salt = divmod(number, self.salts)
        return group + salt


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _placed(books: np.ndarray, owners: Owners):
    """Parts of the table's rows as blocks of their first owners; a batch of rows has one salt."""
    def run(batches):
        salt = TaskContext.get().partitionId() * 7919
        for batch in batches:
            rows = _matrix(batch.column(0))
            parts = np.split(rows, len(books), axis=1) if len(rows) else []
            numbers, blocks = [], []
            for position, part in enumerate(parts):
                entry, _ = _nearest(part, books[position])
                for e in np.unique(entry):
                    numbers.append(owners.number(position, int(e), salt % owners.salts))
                    blocks.append(_packed(part[entry == e]))
            salt += 1
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(blocks, pa.binary())], names=["owner", "block"])
    return run


def _packed(members: np.ndarray) -> bytes:
    small = _narrow(members)
    return bytes([small.itemsize]) + small.tobytes()


def _unpacked(block: bytes, width: int) -> np.ndarray:
    return np.frombuffer(block, f"i{block[0]}", offset=1).reshape(-1, width)


def _compacted(width: int):
    """Blocks of the same owner and salt joined up to ``BLOCK`` members."""
    def run(blocks: Iterator[tuple[int, bytes]]):
        held: dict[int, list[np.ndarray]] = {}
        count: dict[int, int] = {}
        for owner, block in blocks:
            members = _unpacked(block, width)
            held.setdefault(owner, []).append(members)
            count[owner] = count.get(owner, 0) + len(members)
            if count[owner] >= BLOCK:
                yield owner, _packed(np.concatenate(held.pop(owner)))
                del count[owner]
        for owner, parts in held.items():
            yield owner, _packed(np.concatenate(parts))
    return run


def _staying(books: np.ndarray, owners: Owners, width: int):
    def run(blocks):
        for owner, block in blocks:
            position, own, _ = owners.split(owner)
            members = _unpacked(block, width)
            stay = _nearest(members, books[position])[0] == own
            if stay.all():
                yield owner, block
            elif stay.any():
                yield owner, _packed(members[stay])
    return run


def _leaving(books: np.ndarray, owners: Owners, width: int):
    def run(blocks):
        for owner, block in blocks:
            position, own, salt = owners.split(owner)
            members = _unpacked(block, width)
            entry, _ = _nearest(members, books[position])
            for e in np.unique(entry):
                if e != own:
                    yield owners.number(position, int(e), salt), _packed(members[entry == e])
    return run


def _totals(owners: Owners, width: int):
    """Count and sums of the members of every (position, entry) in a partition."""
    def run(blocks):
        total: dict[tuple[int, int], list[int]] = {}
        for owner, block in blocks:
            members = _unpacked(block, width)
            own = [len(members), *members.sum(0, dtype=np.int64).tolist()]
            at = owners.split(owner)[:2]
            total[at] = [x + y for x, y in zip(total[at], own, strict=True)] if at in total else own
        yield from total.items()
    return run


def _updated(books: np.ndarray, members: RDD, owners: Owners) -> np.ndarray:
    """Floor of the mean of each entry's members; an entry without members stays. As many rows as entries reach the driver."""
    width = books.shape[2]
    sums = members.mapPartitions(_totals(owners, width)).reduceByKey(lambda x, y: [a + b for a, b in zip(x, y, strict=True)], 8).collect()
    out = books.copy()
    for (position, entry), (count, *total) in sums:
        out[position, entry] = [t // count for t in total]
    return out


def lloyd(rows: DataFrame, books: np.ndarray, *, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (position, entry, component) after ``rounds`` rounds over the integer arrays ``vector`` of ``rows``.

    ``rows`` is read again if an executor is lost, and must then come in the same partitions: a stored table.
    """
    spark = rows.sparkSession
    sc = spark.sparkContext
    shared_folder(spark)
    positions, entries, width = books.shape
    size = rows.count() * positions * width * 4
    partitions = max(sc.defaultParallelism, -(-size // PARTITION_BYTES))
    owners = Owners(entries, partitions)
    place = owners.partition  # one object: Spark joins the rounds' members without a shuffle only if it is the same
    placed = rows.select("vector").mapInArrow(_placed(books, owners), "owner long, block binary").rdd.map(lambda r: (r.owner, bytes(r.block)))
    members = placed.partitionBy(partitions, place).mapPartitions(_compacted(width), preservesPartitioning=True)
    old = None
    for done in range(1, rounds + 1):
        members.persist(StorageLevel.MEMORY_AND_DISK)
        if done % CHECKPOINT == 0:
            members.checkpoint()
        before, books = books, _updated(books, members, owners)
        if old is not None:
            old.unpersist()  # the new members are made; a lost one is made again from the round's shuffle
        if np.array_equal(before, books):
            break
        if done < rounds:
            stay = members.mapPartitions(_staying(books, owners, width), preservesPartitioning=True)
            moved = members.mapPartitions(_leaving(books, owners, width)).partitionBy(partitions, place)
            old, members = members, stay.union(moved).mapPartitions(_compacted(width), preservesPartitioning=True)
    members.unpersist()
    return books


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The parts of the rows with the smallest ids; fewer rows give fewer entries, none give none."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    made = np.array([r.vector for r in first], np.int64).reshape(len(first), parts, -1 if first else 0)
    return np.ascontiguousarray(made.transpose(1, 0, 2))


def _encoded(books: np.ndarray):
    names = ["vec_id", "label", "code", "error"]

    def run(batches):
        for batch in batches:
            rows = _matrix(batch.column(2))
            codes, error = np.zeros((len(rows), len(books)), np.uint8), np.zeros(len(rows), np.int64)
            for position, part in enumerate(np.split(rows, len(books), axis=1) if len(rows) else []):
                entry, distance = _nearest(part, books[position])
                codes[:, position] = entry
                error += distance
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()),
                                              pa.array(error)], names=names)
    return run


def digest(books: np.ndarray) -> str:
    """Of the decimal components by part, entry and place within the part, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of the rows of ``vectors`` (``vec_id, embedding, label``), and the codebooks.

    ``code`` has one byte for each part, ``error`` is the squared distance to the codebooks' entries on the integer scale.
    Rows whose embedding is null or has a null or non-finite component are left out; integers beyond ``LARGEST`` are cut
    to it. Null vec_ids come last among the first entries, equal ones are ordered by their vectors. Repeated rows count as
    often as they are there and come back as often. Other columns are not read. Embeddings of different lengths, or of a
    length that ``parts`` does not divide, are an error; ``entries`` is at most 256. Without rows there are no codebooks.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    rows = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                                 integers(F.col("embedding"), scale).alias("vector")).where("vector is not null"), "integers")
    shape = rows.agg(F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most")).first()
    if shape.most is not None and (shape.least != shape.most or shape.most % parts):
        raise ValueError(f"embeddings of {shape.least} to {shape.most} components cannot be cut into {parts} equal parts")
    books = first_codebooks(rows, parts, entries)
    if books.size:
        books = lloyd(rows, books, rounds=rounds)
    made = rows.select("vec_id", "label", "vector").mapInArrow(_encoded(books), "vec_id long, label long, code binary, error long")
    return made, books


def _sql() -> str:
    def nearest(vectors: str, book: str) -> str:
        d = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
        return (f"SELECT rid, p, x, min(struct_pack(d := CAST({d} AS BIGINT), e := e)) AS best FROM {vectors} JOIN {book} USING (p) GROUP BY rid, p, x")

    out = [f"""WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT rid, p, list_slice(vector, CAST(p * len(vector) // {PARTS} + 1 AS BIGINT), CAST((p + 1) * len(vector) // {PARTS} AS BIGINT)) AS x
  FROM v, range({PARTS}) AS t(p)),
book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, x AS c FROM part WHERE rid <= {ENTRIES})"""]
    for r in range(1, ROUNDS + 1):
        out.append(f"near{r} AS MATERIALIZED ({nearest('part', f'book{r - 1}')})")
        out.append(f"""mean{r} AS (SELECT p, e, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS c FROM (
  SELECT p, best.e AS e, i, CAST(sum(x[i]) AS DOUBLE) AS total, count(*) AS n FROM near{r}, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY ALL) GROUP BY p, e)""")
        out.append(f"book{r} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{r - 1} b LEFT JOIN mean{r} m USING (p, e))")
    out.append(f"last AS MATERIALIZED ({nearest('part', f'book{ROUNDS}')})")
    out.append(f"""coded AS (SELECT rid, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM last GROUP BY rid),
hash AS (SELECT sha256(coalesce(string_agg(array_to_string(c, ','), ',' ORDER BY p, e), '')) AS h FROM book{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM v JOIN coded USING (rid), hash""")
    return ",\n".join(out)


@query(_sql())
def op11_vector_codes(spark, folder):
    made, books = compressed(table(spark, folder, "embeddings"))
    made = made.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error")
    totals = made.groupBy("label").agg(F.sum("error").alias("label_error"))
    return lookup(made, totals, ["label"], "left").select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
