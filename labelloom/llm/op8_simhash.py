"""SimHash near-duplicates: links by pigeonring filtering, classes by connected components.

The 64 bits are a ring of five segments. If two fingerprints differ in at most four bits, some segment begins a chain whose first l segments
together differ in at most l * 4 / 5 bits, for every l (otherwise the ring's segments would add up to more). So the first segment of
that chain is equal and the second differs in one bit at most: an equi-join on both, with the second one's flips enumerated. In the
join's condition the chain goes on over three and four segments, and at last all bits are counted.

Equal fingerprints become one node first, so copies make no pairs. Crowded keys are split by the join's skew handling; the links that a task of the join
finds are reduced to a forest before they leave it, so near copies by the thousand hand on no more rows than there are of them.

Null and empty texts, and texts without words: fingerprint zero, linked like any other. Fewer than four words: one shingle of all. Rows
with null doc_id take part; they name no component unless nothing else does, then it is null. Repeated rows get equal results.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from labelloom.llm.common import annotate, column
from labelloom.llm.graph import components
from labelloom.session import cut_lineage

WORDS, BUDGET = 4, 4
WIDTHS = (13, 13, 13, 13, 12)


def fingerprint(text: bytes, k: int = WORDS) -> int:
    """Bit i is set if it is set in more than half of the shingles' hashes."""
    words = text.lower().split()  # of bytes: folds A-Z, splits at space and \t..\r
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - k + 1)
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for low in range(0, n, 1 << 16):
        ones += np.unpackbits(h[low:low + (1 << 16), None].view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """Narrow: appends the fingerprint as a signed long."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(np.array([fingerprint((x or "").encode()) for x in column(batch, text).to_pylist()], np.uint64).view(np.int64))]

    return annotate(docs, run, [T.StructField(name, T.LongType())])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segments() -> list[int]:
    out, low = [], 0
    for width in WIDTHS:
        out.append(((1 << width) - 1) << low)
        low += width
    return out


def chains() -> list[list[int]]:
    """For each first segment the masks of one to five consecutive segments of the ring."""
    masks, n = segments(), len(WIDTHS)
    return [[sum(masks[(i + j) % n] for j in range(length)) for length in range(1, n + 1)] for i in range(n)]


def keyed(fps: DataFrame) -> DataFrame:
    """Rows (chain, key, fp, probe): one for each chain, and one for each of its flips of a bit of the second segment (``probe``)."""
    table = []
    for i, masks in enumerate(chains()):
        second = masks[1] & ~masks[0]
        table += [(i, signed(masks[1]), 0, False)] + [(i, signed(masks[1]), signed(1 << b), True) for b in range(64) if second >> b & 1]
    rows = F.array(*[F.struct(F.lit(i).cast("byte").alias("chain"), F.lit(m).cast("long").alias("mask"), F.lit(f).cast("long").alias("flip"), F.lit(p).alias("probe")) for i, m, f, p in table])
    return fps.select("fp", F.explode(rows).alias("r")).select(F.col("r.chain").alias("chain"), F.col("fp").bitwiseXOR(F.col("r.flip")).bitwiseAND(F.col("r.mask")).alias("key"), "fp", F.col("r.probe").alias("probe"))


def links(fps: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(a, b): pairs of different fingerprints of column fp at ``budget`` or fewer differing bits; a pair may come from several chains."""
    rows = keyed(fps)
    index = rows.filter("not probe").select("chain", "key", F.col("fp").alias("b"))
    probe = rows.select("chain", "key", F.col("fp").alias("a"))
    differ = F.col("a").bitwiseXOR(F.col("b"))

    def within(length: int):
        """The first ``length`` segments of the chain stay in their share of the budget."""
        masks = F.element_at(F.array(*[F.lit(signed(c[length - 1])) for c in chains()]), F.col("probe.chain").cast("int") + 1)
        return F.bit_count(differ.bitwiseAND(masks)) <= length * budget // len(WIDTHS)

    on = (F.col("probe.chain") == F.col("index.chain")) & (F.col("probe.key") == F.col("index.key")) & (F.col("a") < F.col("b"))
    return probe.alias("probe").join(index.alias("index"), on & within(3) & within(4) & (F.bit_count(differ) <= budget)).select("a", "b")


def rooted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (doc_id, fp and others) as kept in the folder of ``spark.checkpoint.dir``, and (fp, root, least doc_id) of each different fingerprint."""
    rows = cut_lineage(rows)
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = cut_lineage(nodes)
    trees = components(links(nodes.select("fp")))
    return rows, nodes.join(trees, nodes["fp"] == trees["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (doc_id, fp, component_id) for each row of ``docs``. Fingerprints are kept in the folder of ``spark.checkpoint.dir``."""
    rows, named = rooted(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text").drop("text"))
    whole = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.select("fp", "root").join(whole, "root").select(F.col("fp").alias("k"), "component_id")
    return rows.join(of, F.col("fp") == F.col("k")).select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """Exactly one row of each class stays: of the least doc_id (null last), and among rows that share it the least by digest of all columns. Columns stay."""
    digest = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    rows, named = rooted(fingerprints(docs.select("doc_id", "text", digest.alias("row")), "text").drop("text"))
    of = named.select(F.col("fp").alias("k"), "root")
    least = rows.join(of, F.col("fp") == F.col("k")).groupBy("root").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "row")).alias("first"))
    kept = least.select(F.col("first.row").alias("__kept"))
    once = docs.withColumn("__row", digest).join(kept, F.col("__row") == F.col("__kept"), "left_semi")
    return once.dropDuplicates(["__row"]).select(*docs.columns)
