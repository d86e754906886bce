"""Near duplicates by SimHash: fingerprints, tiled exact comparison, groups.

All pairs of fingerprints within the radius are found, none by chance. Fingerprints with equal
population counts in each of their segments make a tile. Two fingerprints differ in at least as
many bits as their population counts do, segment by segment; so a tile is only compared with
those whose counts differ by the radius or less, and every other pair of tiles is skipped
unseen. Inside a pair of tiles numpy compares all with all by exclusive-or and bit counts.

Nulls and ties: a null or empty text, or one without words, has fingerprint zero and is linked
like any other. A null doc_id has a fingerprint and a group; it is never the id of a group that
has another id. Repeated rows are copies of each other. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import free_name
from linepulse.llm.components import components
from linepulse.scratch import stage

WIDTH = 3
RADIUS = 3
BITS = 64
#: Parts of a fingerprint whose bits are counted apart.
SEGMENTS = 4
#: Most fingerprints of a tile; larger ones are dealt over several by hash.
TILE_ROWS = 2048
_SEED = 42
_BLOCK = 1 << 16


def fingerprint_of(text: str | None, width: int = WIDTH) -> int:
    """Majority of the bits of the XXH64 of every shingle, repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: ASCII only
    if not words:
        return 0
    if len(words) < width:
        shingles: Iterable[bytes] = (b" ".join(words),)
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, _SEED) for s in shingles), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), _BLOCK):
        part = hashes[i : i + _BLOCK].view(np.uint8).reshape(-1, 8)
        for byte in range(8):  # 256 counts of each byte, then the bits of those
            counts = np.bincount(part[:, byte], minlength=256)
            ones[8 * byte : 8 * byte + 8] += counts @ _BITS_OF_BYTE
    over_half = 2 * ones > len(hashes)
    return int(np.packbits(over_half, bitorder="little").view("<u8")[0])


_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: Column, width: int = WIDTH) -> Column:
    """The fingerprint of each text, as the signed long of its 64 bits."""

    def of(texts: pd.Series) -> pd.Series:
        bits = np.fromiter((fingerprint_of(t, width) for t in texts), dtype="<u8", count=len(texts))
        return pd.Series(bits.view("<i8"))

    return F.pandas_udf(of, "long")(text)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _counts_key(fp: Column, segments: int) -> Column:
    """Population counts of the segments, one in each 7 bits."""
    size = BITS // segments
    key = F.lit(0).cast("long")
    for i in range(segments):
        part = F.shiftrightunsigned(fp, size * i)
        if size < BITS:
            part = part.bitwiseAND(F.lit((1 << size) - 1))
        key = key + F.bit_count(part).cast("long") * F.lit(1 << (7 * i))
    return key


def _steps(segments: int, radius: int) -> list[int]:
    """Differences of keys to look at: zero, and one of each pair of opposite directions.

    A count is at most 64 and a step changes it by few; a sum outside of its range leaves a
    field that no key has, so it meets no tile.
    """
    if radius >= 31:
        raise ValueError("the radius must be below 31")
    ranges = product(range(-radius, radius + 1), repeat=segments)
    near = [d for d in ranges if sum(map(abs, d)) <= radius and d >= (0,) * segments]
    return [sum(x * (1 << (7 * i)) for i, x in enumerate(d)) for d in near]


def join_pair(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is within the radius between ``a`` and ``b``, and no more.

    Not every pair is returned: each fingerprint is linked with the first of those that it is
    joined with, so a large group of near copies gives a link for each of its members.
    """
    rows, cols = [], []
    step = max(1, (1 << 19) // max(1, len(b)))
    for i in range(0, len(a), step):
        near = np.bitwise_count(a[i : i + step, None] ^ b[None, :]) <= radius
        r, c = np.nonzero(near)
        rows.append(r + i)
        cols.append(c)
    i, j = np.concatenate(rows), np.concatenate(cols)
    if not len(i):
        return a[:0], a[:0]
    of_a, of_b = np.arange(len(a)), np.full(len(b), len(a))
    while True:
        was = of_a.copy()
        np.minimum.at(of_b, j, of_a[i])
        np.minimum.at(of_a, i, of_b[j])
        if (of_a == was).all():
            break
    np.minimum.at(of_b, j, of_a[i])
    ia, jb = np.unique(i), np.unique(j)
    u = np.concatenate([a[ia], b[jb]])
    v = np.concatenate([a[of_a[ia]], a[of_b[jb]]])
    return u[u != v], v[u != v]


def links(prints: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(u, v)`` that join all of ``prints(fp)``, which are distinct, within ``radius`` bits."""
    keyed = prints.select("fp", _counts_key(F.col("fp"), segments).alias("key"))
    # At most (64 / segments + 1) ** segments keys: 83,521 for four, whatever the input.
    sizes = keyed.groupBy("key").agg(F.ceil(F.count("*") / tile_rows).alias("parts"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    tiles = stage(
        keyed.join(F.broadcast(sizes), "key").groupBy("key", part.alias("part")).agg(F.collect_list("fp").alias("fps")),
        "tiles",
    )
    step = F.explode(F.array([F.lit(d).cast("long") for d in _steps(segments, radius)]))
    moved = tiles.select("key", F.col("part").alias("its_part"), F.col("fps").alias("others"), step.alias("step"))
    moved = moved.select((F.col("key") + F.col("step")).alias("key"), "step", "its_part", "others")
    moved = moved.join(F.broadcast(sizes.select("key")), "key", "left_semi")
    pairs = moved.join(tiles, "key").where("step != 0 OR its_part <= part").select("others", "fps")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray]] = []
            left, right = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                a, b = (c[i].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in (left, right))
                u, v = join_pair(a, b, radius)
                if len(u):
                    found.append((u, v))
            if found:
                u, v = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return pairs.mapInArrow(compare, "u long, v long")


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(fp, component_id)`` for each fingerprint of ``prints(doc_id, fp)``: the least doc_id it reaches."""
    first = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    joined = stage(components(links(first.select("fp"), radius)), "components")
    linked = first.join(joined.withColumnRenamed("node", "fp"), "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    members = joined.join(least, "root").select(F.col("node").alias("fp"), "least")
    # A fingerprint of a linked group may have null ids only; the group's least id holds then too.
    return first.join(members, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for each row of ``docs(doc_id, text)``."""
    prints = stage(docs.select("doc_id", fingerprint(F.col("text"), width).alias("fp")), "prints")
    return prints.join(groups(prints, radius), "fp").select(
        "doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near duplicates, with their columns.

    Of each group the row with the smallest doc_id stays, null ids last; among rows of that id
    the one whose text has the smallest hash, and of exact repeats the least row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    prints = stage(
        docs.select("doc_id", F.xxhash64(text).alias("digest"), fingerprint(F.col("text"), width).alias("fp")),
        "prints",
    )
    first = prints.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    )
    first = stage(first, "fingerprints")
    joined = stage(components(links(first.select("fp"), radius)), "components")
    of = first.join(joined.withColumnRenamed("node", "fp"), "fp", "left")
    kept = of.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    keys, digest, row = (free_name(docs, x) for x in ("kept_id", "kept_digest", "kept_row"))
    kept = kept.select(F.col("first.doc_id").alias(keys), F.col("first.digest").alias(digest)).distinct()
    twice = prints.groupBy("doc_id", "digest").count().where("count > 1").limit(1).count()
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept[keys]) & (F.xxhash64(text) == kept[digest]), "left_semi")
    if not twice:
        return rows
    whole = F.struct(*[F.col(c) for c in rows.columns])
    one = rows.groupBy("doc_id", F.xxhash64(text).alias(digest)).agg(F.min_by(whole, whole).alias(row))
    return one.select(*[F.col(row)[c].alias(c) for c in rows.columns])
