"""Near-duplicate documents by SimHash and pigeonring filtering.

Fingerprints are 64 bits long and link at `max_bits` or fewer differing bits. The bits lie on a ring
of 2*max_bits+1 segments. By the pigeonring principle, two linked fingerprints have a segment from which
every run of l segments differs in at most l*max_bits/m bits. The first runs may not differ at all, so
those segments together are an equi-join key; longer runs are checked before the full distance.

A key whose group is dense is not paired up. Its fingerprints meet at centres instead: two
fingerprints within 2 bits share a value that is at most 1 bit away from each, and all that share
one are linked, so a star on the smallest says the same in linear size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotline.llm.common import id_and_text, small_batches
from lotline.llm.components import connected_components
from lotline.staging import stage

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BITS = 64
# more fingerprints than this under one key are linked through centres, not pair by pair
DENSE = 64
CHUNK = 1 << 16
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a UTF-8 text, repeats included, as an unsigned number.

    Words are runs without ASCII white space, A-Z in lower case. Fewer words than a shingle: the whole
    sequence is one shingle. No word: zero.
    """
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    counts, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        hashes = np.array(
            [digest(line[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])], dtype="<u8"
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, bits, text_mark): the fingerprint as a signed long, and a hash that tells the texts of a repeated id apart; null text counts as empty."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found), batch.column("text_mark")], ["doc_id", "bits", "text_mark"])

    return id_and_text(docs).withColumn("text_mark", _mark(F.col("text"))).mapInArrow(run, "doc_id long, bits long, text_mark long")


def _mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of the ring."""
    m = 2 * max_bits + 1
    cuts = [round(i * BITS / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _run_mask(segments: list[tuple[int, int]], first: int, length: int) -> int:
    """Bits of `length` segments of the ring from `first` on."""
    mask = 0
    for j in range(length):
        at, width = segments[(first + j) % len(segments)]
        mask |= ((1 << width) - 1) << at
    return _signed(mask)


def _equal_run(max_bits: int) -> int:
    """Length of the first run, none of whose bits may differ."""
    m = 2 * max_bits + 1
    return max(n for n in range(1, m + 1) if n * max_bits < m)


def ring_keys(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(bits, at, part): for each start on the ring, the bits that a linked fingerprint must share there."""
    segments = _segments(max_bits)
    length = _equal_run(max_bits)
    keys = F.array(*[
        F.struct(
            F.lit(i).alias("at"),
            F.col("bits").bitwiseAND(F.lit(_run_mask(segments, i, length))).alias("part"),
        )
        for i in range(len(segments))
    ])
    return prints.select("bits", F.inline(keys))


def chain_holds(a: Column, b: Column, at: Column, max_bits: int = MAX_BITS) -> Column:
    """Whether every run that starts at segment `at` keeps within its share of `max_bits`."""
    segments = _segments(max_bits)
    m, differ = len(segments), a.bitwiseXOR(b)

    def from_start(i: int) -> Column:
        ok = F.lit(True)
        for length in range(_equal_run(max_bits) + 1, m + 1):
            part = F.bit_count(differ.bitwiseAND(F.lit(_run_mask(segments, i, length))))
            ok = ok & (part <= length * max_bits // m)
        return ok

    out = F.lit(False)
    for i in range(m):
        out = out | ((at == i) & from_start(i))
    return out


def links(prints: DataFrame, max_bits: int = MAX_BITS, dense: int = DENSE) -> DataFrame:
    """(a, b) between distinct fingerprints such that the links' components are those of all pairs within `max_bits`.

    `prints` has one row per distinct fingerprint, column `bits`. Outside dense keys every linked
    pair comes out; dense keys give stars over shared centres (for `max_bits` of at most 2).
    """
    keys = ring_keys(prints, max_bits)
    crowded = keys.groupBy("at", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > dense)
    if max_bits > 2:
        crowded = crowded.where(F.lit(False))
    marked = keys.join(crowded, ["at", "part"], "left")
    sparse = marked.where("n is null").select("at", "part", "bits")
    a, b = sparse.alias("a"), sparse.alias("b")
    near = (F.col("a.at") == F.col("b.at")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.bits") < F.col("b.bits"))
    chain = chain_holds(F.col("a.bits"), F.col("b.bits"), F.col("a.at"), max_bits)
    full = F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits"))) <= max_bits
    pairs = a.join(b, near & chain & full).select(F.col("a.bits").alias("a"), F.col("b.bits").alias("b"))
    if max_bits > 2:
        return pairs
    flips = [_signed(1 << i) for i in range(BITS)] if max_bits else []
    centres = F.array(F.col("bits"), *[F.col("bits").bitwiseXOR(F.lit(f)) for f in flips])
    # a ball of radius 1 holds 65 values, which bounds the collected list
    stars = (
        marked.where("n is not null").select("bits").distinct()
        .select("bits", F.explode(centres).alias("centre"))
        .groupBy("centre").agg(F.min("bits").alias("a"), F.collect_list("bits").alias("ball"))
        .where(F.size("ball") > 1)
        .select("a", F.explode("ball").alias("b")).where("a <> b")
    )
    return pairs.unionByName(stars)


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, dense: int = DENSE
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    component_id is the smallest doc_id reachable over links, the document itself included. Texts
    without words have fingerprint zero and are linked like any other. Null ids stay null and name no
    component unless all its ids are null. Repeated rows come out as often as they go in. An empty table gives an
    empty result.
    """
    return _classes(docs, shingle, max_bits, dense).select("doc_id", "fingerprint", "component_id")


def _classes(docs: DataFrame, shingle: int, max_bits: int, dense: int) -> DataFrame:
    """`near_duplicates` with the class (`root`, also where ids repeat) and the hash of the text."""
    prints = stage(fingerprints(docs, shingle), "prints")
    nodes = stage(prints.groupBy("bits").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = connected_components(links(nodes.select("bits"), max_bits, dense), "links")
    placed = nodes.join(roots, nodes["bits"] == roots["node"], "left").select(
        nodes["bits"], "least_id", F.coalesce("root", nodes["bits"]).alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    component = stage(placed.join(named, "root").select("bits", "root", "component_id"), "classes")
    return prints.join(component, "bits", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id", "root", "text_mark"
    )


def keep_one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, dense: int = DENSE) -> DataFrame:
    """The document with the smallest id of every group, all columns as given.

    Groups are of texts: rows that repeat an id but not its text are in the groups of their own texts. Of the rows of a group
    that share its smallest id one stays, the first by a hash of the text, then of all columns. Rows without an
    id cannot be named as the one that stays, so all of them stay.
    """
    found = _classes(docs, shingle, max_bits, dense).where("doc_id = component_id")
    keep = found.groupBy("doc_id", "root").agg(F.min("text_mark").alias("text_mark"))
    # names that no column of the table has
    own, row = (_free_name(docs, n) for n in ("kept", "row"))
    keep = keep.select(F.struct("doc_id", "text_mark").alias(own)).distinct()
    same = (docs["doc_id"].cast("long") == F.col(own)["doc_id"]) & (_mark(docs["text"]) == F.col(own)["text_mark"])
    named = docs.join(keep, same, "left_semi")
    whole = [F.col(f"`{c}`") for c, kind in named.dtypes if not kind.startswith(("map", "variant"))]
    nth = F.row_number().over(Window.partitionBy(F.col("doc_id"), _mark(F.col("text"))).orderBy(F.xxhash64(*whole)))
    named = named.withColumn(row, nth).where(F.col(row) == 1).drop(row)
    return named.unionByName(docs.where(docs["doc_id"].isNull()))


def _free_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name
