"""SimHash near-dedup with pivot distance tables.

Fingerprint: 64 bits over word shingles (XXH64, seed 42); bit i is set when more than half
of the shingle hashes set it.  Documents link at Hamming distance ``max_bits`` or less.

The pivot table holds, for each distinct fingerprint x, its distances to reference
fingerprints.  Hamming distance is a metric, so |d(x, p) - d(y, p)| <= d(x, y) for every
reference p, and a pair whose largest coordinate difference exceeds ``max_bits`` is out.

The references are the zero fingerprint and one per pair of neighbouring bits (the pair set, all
else zero).  The table stores a fingerprint's distances to them and to a few dense references.  A
ring coordinate is half the difference of two stored distances, (d(x, 0) - d(x, pair)) / 2 = bits set in
that pair - 1, so a differing bit changes one ring coordinate only.  The 32 ring coordinates are
dealt to families; two fingerprints within ``max_bits`` differ in the coordinates of at most that
many families, so agreement on ``families - max_bits`` families is the join key that proposes
pairs, with no pair lost.  A ring coordinate does not tell which bit of the pair is set, so proposals
can be far apart: those whose largest coordinate difference over all stored distances exceeds
``max_bits`` are discarded, and the survivors are verified exactly.

A key held by more than ``group_limit`` distinct fingerprints is not paired out: its
fingerprints go to a second exact route, where each is written under itself and all
fingerprints one bit away.  Two fingerprints share such a point exactly when they differ in
at most two bits, and all that share a point are linked, so each links to the smallest
there (for ``max_bits`` = 2; at most 65 fingerprints share a point).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import discard, materialize
from .arrow_text import slices, texts_of
from .blocks import lookup
from .components import connected_components

SHINGLE = 3
MAX_BITS = 2
FAMILIES = 6
GROUP_LIMIT = 32

# Dense reference fingerprints (alternating runs of 1, 2, 4, 8, 16 and 32 bits,
# and two de Bruijn-like words), as signed 64-bit numbers in hexadecimal.
DENSE = [0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F, 0x00FF00FF00FF00FF,
         0x0000FFFF0000FFFF, 0x00000000FFFFFFFF, 0x0218A392CD3D5DBF, 0x07EDD5E59A4E28C2]

RINGS = 32  # pairs of neighbouring bits
# the references in the order of the stored distances: zero, the pairs, the dense ones
REFERENCES = [0, *(3 << 2 * i for i in range(RINGS)), *DENSE]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of one text (unsigned)."""
    return int(_fingerprints([text], shingle)[0])


def _fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), dtype=np.uint64)
    for i, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            out[i] = digest(joined, 42)
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = len(words) - shingle + 1
        counts = np.zeros(64, dtype=np.int64)
        for at in range(0, n, 1 << 16):  # bounded bit matrices for very long texts
            to = min(n, at + (1 << 16))
            h = np.array([digest(joined[a:b], 42) for a, b in
                          zip(starts[at:to].tolist(), ends[at + shingle - 1:to + shingle - 1].tolist())],
                         dtype="<u8")
            counts += _bit_counts(h)
        bits = counts * 2 > n
        out[i] = np.packbits(bits, bitorder="little").view("<u8")[0]
    return out


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes set each bit: sums of the bytes' unpacked bits."""
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(bits), 255):  # 255 rows fit the sum of a byte
        counts += bits[at:at + 255].sum(axis=0, dtype=np.uint8)
    return counts


def _map_fingerprints(shingle: int, text: str = "text", keep_text: bool = True):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                t = texts_of(batch.column(text))
                fp = _fingerprints([t.bytes(i) for i in range(len(t))], shingle)
                names = [c for c in batch.schema.names if keep_text or c != text]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), pa.array(fp.view(np.int64))], [*names, "fp"])

    return run


def simhash(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (signed 64-bit) for every row; null and empty texts have fingerprint 0."""
    return docs.select("doc_id", "text").mapInArrow(
        _map_fingerprints(shingle, keep_text=False), "doc_id long, fp long")


def pivot_columns(fp: Column) -> Column:
    """Distances to all references, as one row of the pivot table."""
    signed = [p - (1 << 64) if p >> 63 else p for p in REFERENCES]
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p).cast("long"))).cast("byte") for p in signed])


def _family_codes(pivots: Column, families: int) -> list[Column]:
    """Per family the number that its ring coordinates (0, 1 or 2 after adding 1) spell in base 3."""
    cuts = [round(RINGS * i / families) for i in range(families + 1)]
    codes = []
    for a, b in zip(cuts, cuts[1:]):
        code = F.lit(0).cast("long")
        for i in range(a, b):
            ring = (pivots[0].cast("long") - pivots[1 + i].cast("long")) / 2 + 1
            code = code * 3 + ring.cast("long")
        codes.append(code)
    return codes


def _family_keys(codes: Column, families: int, max_bits: int) -> Column:
    """One key per choice of agreeing families: the choice and the codes of its families."""
    keys = []
    for k, chosen in enumerate(combinations(range(families), families - max_bits)):
        key = F.lit(0).cast("long")
        for f in chosen:  # at most 32 ring coordinates: 3 ** 32 fits a long
            key = key * 3 ** math.ceil(RINGS / families) + codes[f]
        keys.append(F.struct(F.lit(k).cast("byte").alias("k"), key.alias("rings")))
    return F.array(*keys)


def pivot_table(fps: DataFrame, families: int = FAMILIES) -> DataFrame:
    """``fp, pivots, codes``: stored distances of every distinct fingerprint and the codes of its families."""
    table = materialize(fps.select("fp", pivot_columns(F.col("fp")).alias("pivots")), "pivot_table")
    return table.withColumn("codes", F.array(*_family_codes(F.col("pivots"), families)))


def links(fps: DataFrame, max_bits: int = MAX_BITS, families: int = FAMILIES,
          group_limit: int = GROUP_LIMIT) -> DataFrame:
    """``a, b``: links that connect every pair of distinct fingerprints within ``max_bits``."""
    if max_bits not in (1, 2):
        raise ValueError("the exact route for large groups covers 1 or 2 bits")
    if not max_bits < families <= RINGS:
        raise ValueError("families must be more than max_bits and at most 32")
    table = pivot_table(fps, families)
    keyed = table.withColumn("key", F.explode(_family_keys(F.col("codes"), families, max_bits)))
    keyed = keyed.select("key.k", "key.rings", "fp", "pivots")
    sizes = keyed.groupBy("k", "rings").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(keyed.join(sizes, ["k", "rings"]), "pivots")
    discard(table)
    small = shared.filter(F.col("n") <= group_limit).drop("n")
    left = small.select("k", "rings", F.col("fp").alias("a"), F.col("pivots").alias("pa"))
    right = small.select("k", "rings", F.col("fp").alias("b"), F.col("pivots").alias("pb"))
    near = F.greatest(*[F.abs(F.col("pa")[i] - F.col("pb")[i]) for i in range(len(REFERENCES))]) <= max_bits
    paired = (left.join(right, ["k", "rings"]).filter(F.col("a") < F.col("b")).filter(near)
              .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b"))
    crowd = shared.filter(F.col("n") > group_limit).select("fp").distinct()
    flips = [F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)]
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(f) for f in flips])
    at_points = crowd.withColumn("point", F.explode(around))
    if max_bits == 2:  # all that share a point are linked: each to the smallest there
        hub = at_points.groupBy("point").agg(F.min("fp").alias("a"))
    else:  # within one bit: the point itself must be one of the two
        hub = crowd.select(F.col("fp").alias("point"), F.col("fp").alias("a"))
    crowded = at_points.join(hub, "point").filter("fp != a").select("a", F.col("fp").alias("b"))
    return paired.union(crowded).distinct()


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``doc_id, fp, fingerprint (16 hex digits), component_id``.

    ``component_id`` is the smallest doc_id whose document is reachable over links; null ids
    are passed over (a component of null ids only has a null ``component_id``).  Rows with
    equal fingerprints are one node, so copies never meet as pairs.  Null, empty and
    word-free texts have fingerprint zero and link like any other.  Repeated rows give
    repeated results; an empty table gives an empty one.  Only ``doc_id`` and ``text`` are
    read, so other columns may have any name.
    """
    prints = materialize(simhash(docs, shingle), "simhash")
    labels = materialize(_labels(prints, max_bits), "simhash_labels")
    return lookup(prints, labels, "fp", prints.count()).select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _labels(prints: DataFrame, max_bits: int) -> DataFrame:
    """``fp, n, component_id, head``: n rows have the fingerprint; head marks the component's leading one."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    near = links(nodes.select("fp"), max_bits)
    found = connected_components(near)
    discard(near)
    labelled = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("component", F.coalesce("component", "fp"))
    lead = F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("id"), F.col("fp").alias("fp"))
    heads = labelled.groupBy("component").agg(F.min(lead).alias("lead"))
    return labelled.join(heads, "component").select(
        "fp", "n", F.col("lead.id").alias("component_id"), (F.col("fp") == F.col("lead.fp")).alias("head"))


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (all columns) that lead their component: one row each.

    The row with the smallest doc_id stays (a null id comes last); among rows that repeat
    that id and fingerprint, the one with the smallest text and columns stays.
    """
    names = docs.columns
    given = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, key = f"c{names.index('text')}", f"c{names.index('doc_id')}"
    schema = StructType([*given.schema.fields, StructField("fp", LongType())])
    rows = materialize(given.mapInArrow(_map_fingerprints(shingle, text), schema), "simhash_rows")
    prints = rows.select(F.col(key).alias("doc_id"), "fp")
    heads = _labels(prints, max_bits).filter("head").select("fp", F.col("component_id").alias("id"))
    led = rows.join(heads, (rows["fp"] == heads["fp"]) & rows[key].eqNullSafe(heads["id"])) \
        .select(rows["*"])
    order = Window.partitionBy("fp").orderBy(F.col(text), F.xxhash64(*given.columns))
    first = led.withColumn("rank", F.row_number().over(order)).filter("rank = 1")
    return first.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
