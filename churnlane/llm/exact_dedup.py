"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every row gets a 64-bit fingerprint of its text.  Rows are cut into blocks
   (one scan partition's rows, at most ``2**BLOCK_BITS`` of them); each block
   sorts its distinct fingerprints and sends each *owner* (a range of the hash
   space) its share as one Golomb-Rice coded message.
2. An owner decodes the messages of all blocks, finds fingerprints that occur
   twice, and answers every block with a bitmap over the fingerprints it sent.
3. Blocks read their bitmaps; only the rows behind set bits (suspects) have
   their texts shuffled, grouped by the full text: the byte verification.

A group of copies sends one fingerprint per block and meets in a partial
aggregate, so a group holding a third of all rows costs no task more.

Defined results: a null text counts as empty; a null id is smaller than any
other and ``keep_id`` is null only if all ids of the group are; of rows equal
in text *and* id exactly one is kept; an empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlane.llm.common import discard, recorded, ship, small, stage

BLOCK_BITS = 20            # at most 1,048,576 rows in a block
OWNER_ROWS = 8_000_000     # fingerprints an owner holds, about (64 MB of numbers)


def golomb_encode(values: np.ndarray, start: int) -> tuple[int, bytes, bytes]:
    """Sorted distinct uint64 ``values`` >= ``start``: Rice parameter, unary quotients, packed remainders."""
    gaps = np.diff(values, prepend=np.uint64(start))
    mean = max(1.0, float(gaps.astype(np.float64).mean())) if len(gaps) else 1.0
    k = max(0, int(math.log2(mean)))
    q = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.ones(int(q.sum()) + len(q), np.uint8)
    unary[np.cumsum(q + 1) - 1] = 0
    rest = np.empty((len(gaps), k), np.uint8)
    for j in range(k):
        rest[:, j] = (gaps >> np.uint64(k - 1 - j)) & np.uint64(1)
    return k, np.packbits(unary).tobytes(), np.packbits(rest.ravel()).tobytes()


def golomb_decode(n: int, k: int, unary: bytes, rest: bytes, start: int) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    bits = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * k].reshape(n, k)
    low = np.zeros(n, np.uint64)
    for j in range(k):
        low = (low << np.uint64(1)) | bits[:, j].astype(np.uint64)
    return np.cumsum(gaps + low, dtype=np.uint64) + np.uint64(start)


def _owner(values: np.ndarray, owners: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def _owner_start(owner: int, owners: int) -> int:
    return (-(-(owner << 32) // owners)) << 32


def _send(owners: int):
    def encode(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        values, counts = np.unique(pdf["fp"].to_numpy(np.int64).view(np.uint64), return_counts=True)
        to, out = _owner(values, owners), []
        edges = np.flatnonzero(np.diff(to, prepend=-1, append=owners + 1))
        for a, b in zip(edges[:-1], edges[1:]):
            owner = int(to[a])
            k, unary, rest = golomb_encode(values[a:b], _owner_start(owner, owners))
            out.append((owner, block, int(b - a), k, unary, rest, np.packbits(counts[a:b] > 1).tobytes()))
        return pd.DataFrame(out, columns=["owner", "block", "n", "k", "unary", "rest", "twice"])
    return encode


def _answer(owners: int):
    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        owner = int(pdf["owner"].iloc[0])
        start = _owner_start(owner, owners)
        parts = [golomb_decode(m.n, m.k, m.unary, m.rest, start) for m in pdf.itertuples()]
        twice = np.concatenate([np.unpackbits(np.frombuffer(m.twice, np.uint8))[: m.n] for m in pdf.itertuples()])
        _, which, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        dup = (counts > 1)[which]
        dup |= np.bincount(which, weights=twice)[which] > 0
        out, at = [], 0
        for m in pdf.itertuples():
            bits = dup[at: at + m.n]
            at += m.n
            if bits.any():
                out.append((m.block, owner, np.packbits(bits).tobytes()))
        return pd.DataFrame(out, columns=["block", "owner", "bits"])
    return find


def _mark(owners: int):
    def suspects(rows: pd.DataFrame, bitmaps: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(bitmaps):
            return pd.DataFrame({"rid": np.empty(0, np.int64)})
        values, which = np.unique(rows["fp"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        to, dup = _owner(values, owners), np.zeros(len(values), bool)
        for m in bitmaps.itertuples():
            mine = np.flatnonzero(to == m.owner)
            dup[mine] = np.unpackbits(np.frombuffer(m.bits, np.uint8))[: len(mine)].astype(bool)
        return pd.DataFrame({"rid": rows["rid"].to_numpy()[dup[which]]})
    return suspects


def fingerprint_suspects(rows: DataFrame, owners: int) -> DataFrame:
    """``rid`` of every row whose fingerprint another row has too; ``rows``: staged (rid, fp)."""
    ship()
    thin = rows.select(F.shiftright("rid", BLOCK_BITS).alias("block"), "rid", "fp")
    messages = thin.select("block", "fp").groupBy("block").applyInPandas(
        _send(owners), "owner long, block long, n long, k int, unary binary, rest binary, twice binary")
    bitmaps = messages.groupBy("owner").applyInPandas(_answer(owners), "block long, owner long, bits binary")
    return thin.groupBy("block").cogroup(bitmaps.groupBy("block")).applyInPandas(_mark(owners), "rid long")


def _groups(rows: DataFrame, body: Column, owner_rows: int) -> DataFrame:
    """Staged (rid, id, fp, sha) and its text -> rid, id, sha, group (size and keeper; null for a lone text)."""
    slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    n = rows.count()
    owners = max(1, -(-n // owner_rows), min(slots, n // 4096))
    with recorded() as used:
        suspects = stage(fingerprint_suspects(rows.select("rid", "fp"), owners), "exact-suspects")
    suspects = small(suspects, suspects.count())

    # Only suspects' texts move; grouping by the text itself compares the bytes.
    verified = (rows.select("rid", "fp", body.alias("body")).join(suspects, "rid", "left_semi")
                .groupBy("fp", "body").agg(F.count("*").alias("group_size"))
                .filter("group_size > 1").select(F.sha2("body", 256).alias("sha"), "group_size"))
    keepers = (rows.select("rid", "id", "sha").join(suspects, "rid", "left_semi")
               .groupBy("sha").agg(F.max(F.struct("id", "rid")).alias("keep")))
    groups = stage(verified.join(keepers, "sha"), "exact-groups")
    discard(rows.sparkSession, used)
    return rows.select("rid", "id", "sha").join(groups, "sha", "left")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 owner_rows: int = OWNER_ROWS) -> DataFrame:
    """One row per row of ``docs``: rid, id, keep_id, group_size, kept, text_sha256."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stage(_prints(docs, text, F.col(id_col), text.alias("body")), "exact-rows")
    lone = F.col("group_size").isNull()
    return _groups(rows, F.col("body"), owner_rows).select(
        "rid", "id", F.when(lone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (lone | (F.col("keep.rid") == F.col("rid"))).alias("kept"), F.col("sha").alias("text_sha256"))


def _prints(docs: DataFrame, text: Column, id_: Column, *more: Column) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("rid"), id_.alias("id"), F.xxhash64(text).alias("fp"),
                       F.sha2(text, 256).alias("sha"), *more)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      owner_rows: int = OWNER_ROWS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stage(_prints(docs, text, F.col(id_col), F.struct("*").alias("row")), "exact-rows")
    with recorded() as used:
        groups = _groups(rows, F.coalesce(F.col("row")[text_col], F.lit("")), owner_rows)
    dropped = stage(groups.filter("keep.rid <> rid").select("rid"), "exact-dropped")
    discard(docs.sparkSession, used)
    return rows.select("rid", "row").join(small(dropped, dropped.count()), "rid", "left_anti").select("row.*")
