"""SimHash near-dedup: pigeonhole blocks, a join on blocks, verified Hamming distances.

A fingerprint's 64 bits are cut into ``BLOCKS`` = 6 blocks.  Two fingerprints
within 2 bits differ in at most 2 blocks, so they agree on at least one choice
of 4 blocks: each distinct fingerprint goes to the 15 groups keyed by such a
choice (42 to 44 bits of it).  A group can hold at most ``2**22`` distinct
fingerprints, as many as its free bits allow, whatever the data.  Inside a
group distances are verified and only a spanning forest leaves it (never all
pairs); the forests meet in a distributed components run.

Copies share a fingerprint and are reduced to one before the blocks.

Defined results: null or wordless texts have fingerprint zero and link like any
other; ids of null are ignored in a component's smallest id (null if it has no
other); repeated rows belong to the same component; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.llm.common import discard, per_batch, recorded, ship, small, stage
from churnlane.llm.components import connected_components

BITS, BLOCKS, SHINGLE, MAX_BITS, SEED = 64, 6, 3, 2, 42
_CHUNK = 16384             # shingles whose bits are counted at once


def fingerprint(text: str | None, words: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned SimHash of the word shingles of ``text``; ASCII lower case and ASCII white space only."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    digest = xxhash.xxh64_digest
    if len(w) <= words:
        return int.from_bytes(digest(b" ".join(w), seed))
    line = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = len(w) - words + 1
    spans = zip(starts[:n].tolist(), (ends[words - 1:] - 1).tolist())
    raw = np.frombuffer(b"".join([digest(line[a:b], seed) for a, b in spans]), np.uint8).reshape(n, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        ones += np.unpackbits(raw[at: at + _CHUNK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes())


def fingerprints(rows: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(rid, id, text) -> (rid, id, fp)."""
    def make():
        return lambda b: {"fp": np.fromiter((fingerprint(t, words) for t in b.column("text").to_pylist()), np.uint64, len(b)).view(np.int64)}
    return per_batch(rows, ["rid", "id"], "fp long", {"fp": pa.int64()}, make)


def local_forest(fps: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Smallest index reachable for each of the distinct ``fps`` through steps of ``max_bits`` or fewer bits.

    Two values lie within 2 bits exactly when they share a value within 1 bit
    of both, so linking over those values replaces comparing all pairs.
    """
    m = len(fps)
    u = fps.view(np.uint64)
    labels = np.arange(m)
    if max_bits == 2:
        free = np.bitwise_or.reduce(u ^ u[0])
        flips = [np.uint64(0)] + [np.uint64(1) << np.uint64(b) for b in range(BITS) if int(free) >> b & 1]
        near = np.stack([u ^ f for f in flips], axis=1)
        _, which = np.unique(near.ravel(), return_inverse=True)
        which = which.reshape(near.shape)
        size = int(which.max()) + 1
        while True:
            lowest = np.full(size, m)
            np.minimum.at(lowest, which.ravel(), np.repeat(labels, which.shape[1]))
            new = lowest[which].min(axis=1)
            new = new[new]
            if (new == labels).all():
                return labels
            labels = new
    while True:                                    # other distances: rows of the distance matrix, a chunk at a time
        new = labels.copy()
        step = max(1, 4_000_000 // m)
        for at in range(0, m, step):
            linked = np.bitwise_count(u[at: at + step, None] ^ u[None, :]) <= max_bits
            new[at: at + step] = np.where(linked, labels[None, :], m).min(axis=1)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def fingerprint_edges(distinct: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Spanning edges (a, b) of the links between the distinct ``fp`` values."""
    ship()
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    mask = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    keys = [signed(sum(mask[i] for i in kept)) for kept in combinations(range(blocks), blocks - max_bits)]
    parts = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(k).cast("long")).alias("part"))
                      for i, k in enumerate(keys)])
    groups = (distinct.select("fp", F.explode(parts).alias("k")).select("k.choice", "k.part", "fp")
              .groupBy("choice", "part").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1").select("fps"))

    def verify(batches):
        for pdf in batches:
            a, b = [], []
            for fps in pdf["fps"]:
                fps = np.sort(np.asarray(fps, np.int64))
                labels = local_forest(fps, max_bits)
                moved = labels != np.arange(len(fps))
                a.append(fps[moved])
                b.append(fps[labels[moved]])
            yield pd.DataFrame({"a": np.concatenate(a) if a else np.empty(0, np.int64),
                                "b": np.concatenate(b) if b else np.empty(0, np.int64)})
    return groups.mapInPandas(verify, "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: rid, id, fp, root (the component), component_id (its smallest id)."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _grouped(stage(fingerprints(rows, words), "simhash"), max_bits)


def _grouped(prints: DataFrame, max_bits: int) -> DataFrame:
    with recorded() as used:
        distinct = stage(prints.groupBy("fp").agg(F.min("id").alias("id")), "simhash-fps")
        roots = connected_components(fingerprint_edges(distinct.select("fp"), max_bits))
        member = stage(roots.join(distinct, roots["node"] == distinct["fp"]).select("fp", "root", "id"), "simhash-members")
        named = stage(member.groupBy("root").agg(F.min("id").alias("component_id")), "simhash-names")
        linked = member.drop("id").join(named, "root")
    table = stage(distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")), "simhash-components")
    discard(prints.sparkSession, used)
    return prints.join(table, "fp").select("rid", "id", "fp", "root", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                     max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component (the smallest id, then the first row), all columns as they were."""
    rows = stage(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct("*").alias("row")), "near-rows")
    with recorded() as used:
        prints = stage(fingerprints(rows.select("rid", F.col("row")[id_col].alias("id"), F.col("row")[text_col].alias("text")),
                                    words), "simhash")
        grouped = _grouped(prints, max_bits)
        keep = stage(grouped.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "rid")).alias("first"))
                     .select("root", F.col("first.rid").alias("keep")), "near-keep")
        dropped = grouped.select("rid", "root").join(keep, "root").filter("rid <> keep").select("rid")
    dropped = stage(dropped, "near-dropped")
    discard(docs.sparkSession, used)
    return rows.join(small(dropped, dropped.count()), "rid", "left_anti").select("row.*")
