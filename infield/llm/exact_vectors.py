"""Vectors as exact integers: packed to the least width, unpacked in bounded chunks, summed without rounding or overflow."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from infield.llm.common import tidy

CHUNK = 4_096  #: rows that are worked on at once
LONGEST = 2**63 - 1
LIMB = 31  #: bits of a part of a large sum
WIDE = 64  #: components of a wide vector are kept in units of two to this power


def narrow_limit(dim: int) -> int:
    """Integers up to this size are worked on as 64-bit ones: squared distances of a chunk of vectors add up below 2**63."""
    return isqrt(2**49 // max(dim, 1))


def finite_vectors(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and components, as doubles, of the vectors of ``dim`` components of which none is null, NaN or infinite."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dim)
    flat = column.take(pa.array(at)).flatten().cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    rows = flat.reshape(len(at), dim)
    good = np.isfinite(rows).all(axis=1)
    return at[good], rows[good]


def packed(rows: np.ndarray, scale: int) -> list[bytes]:
    """floor(scale * x) of each row's components as bytes: two or four of each, or a double in units of 2**WIDE.

    ``scale`` is a power of two. Equal integers give equal bytes, and the number of bytes tells the width.
    """
    with np.errstate(over="ignore"):
        values = np.floor(rows * scale) + 0.0
    largest = np.abs(values).max(axis=1, initial=0.0)
    limit = min(narrow_limit(rows.shape[1]), 2**31 - 1)
    out: list[bytes] = [b""] * len(rows)
    for kind, own in (("<i2", largest <= 32_767), ("<i4", (largest > 32_767) & (largest <= limit))):
        at = np.flatnonzero(own)
        whole = values[at].astype(kind)
        for i, row in zip(at.tolist(), whole, strict=True):
            out[i] = row.tobytes()
    for i in np.flatnonzero(largest > limit).tolist():
        # beyond 2**53 a double is an integer, so that the factors commute with floor
        v = np.where(np.abs(rows[i]) < 2.0**900, np.floor(np.clip(rows[i], -(2.0**900), 2.0**900) * scale) * 2.0**-WIDE, rows[i] * (scale * 2.0**-WIDE))
        out[i] = (v + 0.0).astype("<f8").tobytes()
    return out


def unpacked(column: pa.Array, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and matrices of the integers, by width, CHUNK rows at most; wide ones as objects, that is Python's integers."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    size = np.diff(offsets)
    for start in range(0, len(column), CHUNK):
        own = size[start : start + CHUNK]
        for width, kind in ((2, "<i2"), (4, "<i4"), (8, "<f8")):
            at = np.flatnonzero(own == width * dim) + start
            if not len(at):
                continue
            data = np.frombuffer(b"".join(column.take(pa.array(at)).to_pylist()), kind).reshape(len(at), dim)
            if width == 8:
                exact = np.empty(data.shape, object)
                exact[:] = [[int(Fraction(v) * 2**WIDE) for v in row] for row in data.tolist()]
                yield at, exact
            else:
                yield at, data.astype(np.int64)


def pack(vectors: DataFrame, key: str, embedding: str, scale: int, dim: int) -> DataFrame:
    """``key`` and the packed integers of the vectors of ``dim`` finite components; other vectors are left out."""
    chosen = vectors.select(F.col(key), F.col(embedding).alias("_v"))
    schema = T.StructType([chosen.schema[0], T.StructField("packed", T.BinaryType())])

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                at, rows = finite_vectors(part.column(1), dim)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), pa.array(packed(rows, scale), pa.binary())], names=[key, "packed"])

    return chosen.mapInArrow(run, schema)


class Totals:
    """Sums of integers by group and place, in Python's integers: nothing overflows."""

    def __init__(self) -> None:
        self.sums: dict[int, np.ndarray] = {}

    def add(self, group: int, values: np.ndarray) -> None:
        values = np.asarray(values).astype(object)
        self.sums[group] = self.sums[group] + values if group in self.sums else values

    def limbs(self) -> Iterator[tuple[int, int, int, int]]:
        """(group, place, limb, part): parts below 2**LIMB, so that sums of parts of very many tasks fit 64 bits."""
        for group, values in self.sums.items():
            for place, value in enumerate(values.tolist()):
                sign, rest, limb = (-1 if value < 0 else 1), abs(int(value)), 0
                while rest or not limb:
                    yield group, place, limb, sign * (rest & (2**LIMB - 1))
                    rest, limb = rest >> LIMB, limb + 1


def exact_totals(rows: DataFrame, dim: int, add: Callable[[Totals, np.ndarray], None]) -> dict[int, dict[int, int]]:
    """{group: {place: sum}} of what ``add`` puts into a task's Totals for each chunk of the column ``packed``.

    Groups and places have to be few: their sums come to the driver, a row for each and for each 31 bits.
    """

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Totals()
        for batch in batches:
            for _, matrix in unpacked(batch.column(0), dim):
                add(totals, matrix)
        made = list(totals.limbs())
        columns = [pa.array([m[i] for m in made], pa.int64()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(columns, names=["grp", "place", "limb", "part"])

    parts = rows.select("packed").mapInArrow(run, "grp long, place long, limb long, part long")
    out: dict[int, dict[int, int]] = defaultdict(lambda: defaultdict(int))
    for r in parts.groupBy("grp", "place", "limb").agg(F.sum("part").alias("part")).collect():
        out[r.grp][r.place] += r.part << (LIMB * r.limb)
    return out


def fits(value: int) -> int | None:
    """The integer, or None if no long holds it."""
    return value if -LONGEST - 1 <= value <= LONGEST else None


def by_literal(values: list, kind: str, at: Column) -> Column:
    """The value at a place, from 0, of a short list."""
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), at + 1)
