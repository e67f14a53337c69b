"""Embedding near-dedup by lattice hashing.

Each of ``TABLES`` tables projects the unit vector to eight random dimensions, scales it and decodes
it to the nearest point of the E8 lattice. A vector lives in that cell and visits the ``PROBES``
neighbouring cells that lie nearest. Residents of a cell are compared with each other and with its
visitors by exact cosines in double precision, as blocks of a matrix product. A pair that meets more
than once is counted where it first meets: the homes and probes of linked rows are derived again
from the vectors, so they need not travel.

Cells are cut into blocks of at most about ``BLOCK`` rows and each pair of blocks is one unit of work,
so a cell with a third of all vectors is spread over tasks. A unit gives each row its number of new
links and the smallest id of its component inside the unit, not the pairs. Equal vectors are one row
with a weight from the start.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing; vectors of different length do not link; a null id never links and is its own component;
rows that repeat an id count as one more copy each; an empty table gives an empty result; labels and
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forget, materialise

TABLES = 6
PROBES = 8
SCALE = 0.65
COSINE = 0.9
BLOCK = 1024
SEED = 20

#: The 240 shortest vectors of E8: (+-1, +-1, 0 ...) in all places, and halves with an even number of minus signs.
_PAIRS = [
    np.eye(8)[i] * a + np.eye(8)[j] * b for i in range(8) for j in range(i + 1, 8) for a in (1, -1) for b in (1, -1)
]
_HALVES = [
    np.array([-0.5 if m >> k & 1 else 0.5 for k in range(8)]) for m in range(256) if bin(m).count("1") % 2 == 0
]
NEIGHBOURS = np.array(_PAIRS + _HALVES)


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(x)
    rest = x - near
    odd = np.flatnonzero(near.sum(1).astype(np.int64) & 1)
    worst = np.abs(rest[odd]).argmax(1)
    near[odd, worst] += np.where(rest[odd, worst] >= 0, 1.0, -1.0)
    return near


def e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice points of rows with eight columns."""
    whole, half = _d8(x), _d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


@lru_cache(maxsize=8)
def projections(dim: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).normal(size=(dim, tables * 8)) * SCALE


def _codes(points: np.ndarray, dim: int, table: int) -> np.ndarray:
    """64-bit names of lattice points, distinct by table and dimension."""
    out = np.full(points.shape[:-1], np.uint64(dim * 1000 + table + 1), dtype=np.uint64)
    for k in range(8):
        out = (out ^ (points[..., k] * 2).astype(np.int64).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """Cells of unit vectors: (rows, tables, 1 + probes), the home first.

    The projection adds one dimension after the other, so a row's result does not depend on what
    other rows are in the batch.
    """
    n, dim = unit.shape
    matrix = projections(dim, tables)
    x = np.zeros((n, tables * 8))
    for j in range(dim):
        x += unit[:, j : j + 1] * matrix[j]
    out = np.empty((n, tables, 1 + probes), dtype=np.int64)
    for t in range(tables):
        own = x[:, 8 * t : 8 * t + 8]
        home = e8(own)
        out[:, t, 0] = _codes(home, dim, t)
        rest = own - home
        gain = np.zeros((n, len(NEIGHBOURS)))
        for k in range(8):
            gain += rest[:, k : k + 1] * NEIGHBOURS[:, k]
        top = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
        out[:, t, 1:] = _codes(home[:, None, :] + NEIGHBOURS[top], dim, t)
    return out


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, weight, v) -> a row for each cell: lives there or visits."""
    for pdf in batches:
        for lo in range(0, len(pdf), 500):
            part = pdf.iloc[lo : lo + 500]
            dims = np.array([len(v) for v in part["v"]])
            for dim in np.unique(dims):
                own = part[dims == dim]
                unit = unit_rows(own["v"], dim // 8)
                names = cells(unit)
                n, reps = len(own), names.shape[1] * names.shape[2]
                yield pd.DataFrame(
                    {
                        "cell": names.reshape(n, -1).ravel(),
                        "home": np.tile(np.repeat([[True] + [False] * PROBES], TABLES, axis=0).ravel(), n),
                        "id": np.repeat(own["id"].to_numpy(), reps),
                        "weight": np.repeat(own["weight"].to_numpy(), reps),
                        "v": np.repeat(own["v"].to_numpy(), reps),
                    }
                )


def unit_rows(packed, dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(packed), dtype="<f8").reshape(-1, dim)
    x = x / np.abs(x).max(1)[:, None]  # neither tiny nor huge components lose the norm
    return x / np.sqrt((x * x).sum(1))[:, None]


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors as bytes of doubles."""
    for pdf in batches:
        yield pd.DataFrame({"id": pdf["id"], "v": [np.asarray(v, dtype="<f8").tobytes() for v in pdf["v"]]})


def _first_meets(cell: int, ids: np.ndarray, names: dict[int, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether pairs (i, j) of rows meet here for the first time.

    They meet in table t at the home of the smaller id if the other one lives or visits there, else
    at the home of the other one.
    """
    low, high = np.where(ids[i] < ids[j], i, j), np.where(ids[i] < ids[j], j, i)
    a = np.array([names[k] for k in low])
    b = np.array([names[k] for k in high])
    at_low = (b == a[:, :, :1]).any(2)
    at_high = (a == b[:, :, :1]).any(2)
    meets = at_low | at_high
    first = meets.argmax(1)
    row = np.arange(len(i))
    place = np.where(at_low[row, first], a[row, first, 0], b[row, first, 0])
    return meets.any(1) & (place == cell)


def roots(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each row's component over the pairs."""
    label = ids.copy()
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == label).all():
            return label
        label = new


def _unit_links(cell: int, pdf: pd.DataFrame, left: np.ndarray, right: np.ndarray, same: bool) -> pd.DataFrame:
    """Links between rows ``left`` and ``right`` of a unit (positions in ``pdf``)."""
    dim = len(pdf["v"].iloc[0]) // 8
    unit = unit_rows(pdf["v"], dim)
    ids, weight = pdf["id"].to_numpy(), pdf["weight"].to_numpy()
    a, b = np.nonzero(unit[left] @ unit[right].T >= COSINE - 1e-12)
    i, j = left[a], right[b]
    keep = ids[i] < ids[j] if same else ids[i] != ids[j]
    i, j = i[keep], j[keep]
    if len(i):
        good = np.einsum("ij,ij->i", unit[i], unit[j]) >= COSINE
        i, j = i[good], j[good]
    if not len(i):
        return pd.DataFrame({"id": ids[:0], "n": ids[:0], "root": ids[:0]})
    touched = np.unique(np.concatenate([i, j]))
    names = dict(zip(touched.tolist(), cells(unit[touched]), strict=True))
    keep = np.concatenate([_first_meets(cell, ids, names, i[k : k + 50_000], j[k : k + 50_000]) for k in range(0, len(i), 50_000)])
    label = roots(len(ids), i, j, ids)
    n = np.bincount(i[keep], weights=weight[j[keep]], minlength=len(ids)) + np.bincount(j[keep], weights=weight[i[keep]], minlength=len(ids))
    return pd.DataFrame({"id": ids[touched], "n": n[touched].astype(np.int64), "root": label[touched]})


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows (cell, unit, ...) -> links, unit by unit; a unit may straddle batches."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        cell, unit = pdf["cell"].to_numpy(), pdf["unit"].to_numpy()
        starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (unit[1:] != unit[:-1])])
        done = [_unit(pdf.iloc[a:b]) for a, b in zip(starts, starts[1:], strict=False)]
        rest = pdf.iloc[starts[-1] :]
        if done := [d for d in done if len(d)]:
            yield pd.concat(done)
    if rest is not None:
        yield _unit(rest)


def _unit(pdf: pd.DataFrame) -> pd.DataFrame:
    side = pdf["side"].to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    cell = int(pdf["cell"].iloc[0])
    if not len(left) or not (len(right) or len(left) > 1):
        return pd.DataFrame({"id": np.zeros(0, np.int64), "n": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})
    out = []
    if len(left) > 1 and bool(pdf["alone"].iloc[0]):
        out.append(_unit_links(cell, pdf, left, left, True))
    if len(right):
        out.append(_unit_links(cell, pdf, left, right, False))
    return pd.concat(out) if out else pd.DataFrame({"id": np.zeros(0, np.int64), "n": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})


def units(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of cells -> rows of units: ``unit`` names a pair of blocks, ``side`` the block's side and
    ``alone`` whether the left block is also compared with itself there.

    Residents fall into r blocks and visitors into s blocks by a hash of the id. Units are resident
    block a with resident block b > a, and with visitor block v; the first visitor unit also compares
    a with itself. Block counts come from a partial aggregate by cell.
    """
    counts = rows.groupBy("cell").agg(
        F.ceil(F.sum(F.when(F.col("home"), 1).otherwise(0)) / block).cast("int").alias("r"),
        F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("home"), 0).otherwise(1)) / block).cast("int")).alias("s"),
    )
    wide = materialise(counts.where("r > 1 or s > 1"), "lattice-wide")
    out = rows.join(wide, "cell", "left").withColumns({"r": F.coalesce("r", F.lit(1)), "s": F.coalesce("s", F.lit(1))})
    mix = F.xxhash64("id", F.lit(5))
    own = F.when(F.col("home"), F.pmod(mix, F.col("r"))).otherwise(F.pmod(mix, F.col("s"))).cast("int")
    out = out.withColumn("own", own)
    # a unit is (left resident block, right block); right blocks 0..s-1 are visitors, s..s+r-1 residents
    width = F.col("s") + F.col("r")
    name = lambda a, b: (a * width + b).cast("int")
    as_left = F.transform(
        F.concat(
            F.sequence(F.lit(0), F.col("s") - 1),
            F.when(F.col("own") + 1 < F.col("r"), F.transform(F.sequence(F.col("own") + 1, F.greatest(F.col("own") + 1, F.col("r") - 1)), lambda b: b + F.col("s"))).otherwise(F.array().cast("array<int>")),
        ),
        lambda b: F.struct(name(F.col("own"), b).alias("unit"), F.lit(0).alias("side"), (b == 0).alias("alone")),
    )
    as_right = F.when(
        F.col("own") > 0,
        F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("own") - 1)), lambda a: F.struct(name(a, F.col("s") + F.col("own")).alias("unit"), F.lit(1).alias("side"), F.lit(False).alias("alone"))),
    ).otherwise(F.array().cast("array<struct<unit:int,side:int,alone:boolean>>"))
    visits = F.transform(
        F.sequence(F.lit(0), F.col("r") - 1),
        lambda a: F.struct(name(a, F.col("own")).alias("unit"), F.lit(1).alias("side"), (F.col("own") == 0).alias("alone")),
    )
    places = F.when(F.col("home"), F.concat(as_left, as_right)).when(F.col("r") > 0, visits).otherwise(F.array().cast("array<struct<unit:int,side:int,alone:boolean>>"))
    return out.select("cell", "id", "weight", "v", F.explode(places).alias("p")).select("cell", "id", "weight", "v", "p.unit", "p.side", "p.alone")


def link(vectors: DataFrame) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False)) & F.col("id").isNotNull()
    packed = rows.where(usable).mapInPandas(_pack, "id bigint, v binary")
    packed = materialise(packed.withColumn("h", F.sha2("v", 256)), "lattice-vectors")
    same = materialise(packed.groupBy("h").agg(F.min("id").alias("id"), F.count("*").alias("weight")), "lattice-same")
    one = packed.select("id", "h", "v").join(same, ["id", "h"]).dropDuplicates(["id", "h"])
    spread = materialise(one.select("id", "weight", "v").mapInPandas(_spread, "cell bigint, home boolean, id bigint, weight bigint, v binary"), "lattice-cells")
    work = units(spread).repartition("cell", "unit").sortWithinPartitions("cell", "unit")
    found = materialise(work.mapInPandas(_units, "id bigint, n bigint, root bigint"), "lattice-links")
    forget(spread)
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    labels = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).distinct())
    per_text = materialise(
        same.join(counts, "id", "left").join(labels, "id", "left").select(
            "h", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
        ),
        "lattice-classes",
    )
    linked = packed.select("id", "h").join(per_text, "h").select(F.col("id").alias("vec_id"), "n_links", "component_id")
    rest = rows.where(~usable).select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
