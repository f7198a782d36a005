"""Near-duplicate documents by min-max hashing, bands, exact confirmation and connected components.

One pass over the texts gives each document its number of distinct word shingles, a hash of the whole set and a min-max
signature: under every permutation both the least and the greatest hash are kept, two unbiased samples for one
evaluation. Documents with equal sets are collapsed to one node at once. Bands of the signature deal the nodes into
buckets. Within a bucket no all-pairs list is made: members are confirmed against one member of the bucket first, found
links are merged, and only members of a bucket that are still apart are paired, by an exact prefix filter on their
rarest shingles. Every link is confirmed on the full shingle sets of the two texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, doc_texts, slices, written

SHINGLE_WORDS, PERCENT = 5, 80
#: Permutations; each gives two signature values.
PERMUTATIONS = 72
#: A pair exactly at the threshold is missed by all bands with at most this probability, if the values were independent.
MISS = 2e-5
#: Members that are confirmed against one copy of a centre, about.
GROUP_ROWS = 1_000
#: Bits of the table that orders shingles by rarity: enough for four counters a shingle, within these bounds.
LEAST_BITS, MOST_BITS = 18, 21

_MULTIPLIERS = np.random.default_rng(20240229).integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def rolled(h: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every run of `width` word hashes."""
    out = np.full(len(h) - width + 1, np.uint64(width))
    for k in range(width):
        out = (out ^ h[k : len(h) - width + 1 + k]) * _STEP
        out ^= out >> np.uint64(29)
    return out


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text; A-Z lower-cased, words split at ASCII white space.

    Fewer words than a shingle: the whole sequence as one. Null or no words: empty. Words are hashed once a batch.
    """
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = cut.flatten().dictionary_encode()
    number = flat.indices.to_numpy()
    distinct = flat.dictionary.to_pylist()
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))
    real = np.fromiter(map(bool, distinct), bool, len(distinct))[number]  # the split gives "" at a text's ends
    h = hashed[number[real]]
    before = np.concatenate([[0], np.cumsum(real)])
    ends = before[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
    runs = rolled(h, words) if len(h) >= words else np.zeros(0, np.uint64)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield np.unique(runs[a : b - words + 1]) if b - a >= words else rolled(h[a:b], b - a) if b > a else h[:0]


def signature(hashes: np.ndarray) -> np.ndarray:
    """Least and greatest value of the set under every permutation x -> a * x (a odd, modulo 2^64)."""
    least = np.full(PERMUTATIONS, np.uint64(2**64 - 1))
    most = np.zeros(PERMUTATIONS, np.uint64)
    for i in range(0, len(hashes), 1024):
        moved = hashes[i : i + 1024, None] * _MULTIPLIERS
        np.minimum(least, moved.min(axis=0), out=least)
        np.maximum(most, moved.max(axis=0), out=most)
    return np.concatenate([least, most])


def band_rows(percent: int) -> int:
    """Most values per band for which a pair at the threshold is missed by all bands with probability <= MISS."""
    t = percent / 100
    return max(r for r in range(1, 2 * PERMUTATIONS + 1) if r == 1 or (1 - t**r) ** (2 * PERMUTATIONS // r) <= MISS)


def set_key(hashes: np.ndarray) -> bytes | None:
    """128-bit hash of a whole shingle set; None for the empty one."""
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def bucket_keys(hashes: np.ndarray, rows: int) -> list[int]:
    """One bucket key per band of the signature."""
    n_bands = 2 * PERMUTATIONS // rows
    values = signature(hashes)[: n_bands * rows].reshape(rows, n_bands).T
    return [xxhash.xxh3_64_intdigest(bytes([k % 256, k // 256]) + v.tobytes()) - 2**63 for k, v in enumerate(values)]


def sketch(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, set_key (hash of the whole set, null if empty), bands (one bucket key per band)."""
    rows = band_rows(percent)

    def run(batches):
        for batch in slices(batches):
            sets = list(shingle_sets(batch.column("text"), words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, sets), pa.int64()), pa.array(map(set_key, sets), pa.binary()),
                 pa.array([bucket_keys(s, rows) if len(s) else [] for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"],
            )

    return doc_texts(docs).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def node_texts(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, text), one text for each of nodes (node, rep, set_key).

    The texts of the representatives' documents move once by doc_id; a document with several texts gives each to the node
    of its set. Both sides grow with the corpus, so the join is a merge join at any size.
    """

    def run(batches):
        for batch in slices(batches):
            keys = [set_key(s) for s in shingle_sets(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("text")], ["set_key", "text"])

    wanted = nodes.select(F.col("rep").alias("doc_id")).distinct()
    texts = doc_texts(docs).join(wanted.hint("merge"), "doc_id", "left_semi").select("text").mapInArrow(run, "set_key binary, text string")
    return texts.groupBy("set_key").agg(F.any_value("text").alias("text")).join(nodes.select("node", "set_key"), "set_key").select("node", "text")


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those (a, b) of the distinct pairs whose texts' shingle sets have 100 * intersection >= percent * union.

    Every a is copied for each GROUP_ROWS of its partners, so that a centre with very many of them is no one task's work;
    a task reads its rows sorted, each centre before its partners.
    """
    sizes = pairs.groupBy("a").agg(F.count("*").alias("_n"))
    salted = pairs.join(sizes, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("_n") / GROUP_ROWS)))
    centres = salted.select("a", "salt", F.col("a").alias("node"), F.lit(0).alias("role")).distinct()
    roles = salted.select("a", "salt", F.col("b").alias("node"), F.lit(1).alias("role")).unionByName(centres)

    def run(batches):
        centre = centre_set = None
        for batch in slices(batches):
            a, b, keep = [], [], []
            for key, salt, node, role, found in zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "node", "role")), shingle_sets(batch.column("text"), words)):
                if role == 0:
                    centre, centre_set = (key, salt), found
                elif centre == (key, salt):
                    common = len(np.intersect1d(centre_set, found, assume_unique=True))
                    if 100 * common >= percent * (len(centre_set) + len(found) - common):
                        a.append(key)
                        b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rows = roles.join(texts, "node").repartition("a", "salt").sortWithinPartitions("a", "salt", "role", "node")
    return rows.select("a", "salt", "node", "role", "text").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b); component is the smallest node reachable.

    Each round maps every node to the neighbour (or itself) of the least priority under a new hash and contracts the
    edges, which leaves a constant share of them whatever the shape. All tables stay distributed and are written to
    the shared folder, so a lost executor repeats one round at most.
    """
    edges = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels, done = None, 0
    while not edges.isEmpty():
        done += 1

        def priority(node: str | Column, salt: int = done) -> Column:
            return F.struct(F.xxhash64(F.lit(salt), node).alias("h"), F.col(node).alias("v"))

        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min(priority("b")).alias("m"))
        move = written(least.select(F.col("a").alias("node"), F.least("m", priority("a"))["v"].alias("to")), "moves")
        old = labels, edges
        if labels is None:
            labels = written(move.select("node", F.col("to").alias("root")), "labels")
        else:
            labels = written(labels.join(move.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")
        moved = edges.join(move.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
        moved = moved.join(move.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        edges = written(moved.filter("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
        discard(*old, move)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    smallest = labels.groupBy("root").agg(F.min("node").alias("component"))
    out = written(labels.join(smallest, "root").select("node", "component"), "components")
    discard(labels, edges)
    return out


def shingle_order(texts: DataFrame, words: int, bits: int) -> np.ndarray:
    """How often shingles occur in texts, by the first bits of their hash: a table of bounded size that orders shingles by
    rarity. Collisions only make the order less telling, never a result wrong; a shingle of very many texts stands out
    above what others add to its counter."""

    def run(batches):
        counts = np.zeros(1 << bits, np.int64)
        for batch in slices(batches):
            found = np.concatenate(list(shingle_sets(batch.column("text"), words)))
            counts += np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["slot", "n"])

    rows = texts.select("text").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(1 << bits, np.int32)
    table[rows["slot"].to_numpy()] = np.minimum(rows["n"].to_numpy(), 2**31 - 1)
    return table


def prefixes(texts: DataFrame, order: np.ndarray, words: int, percent: int) -> DataFrame:
    """(h, pos, node, n, comp, s0..s3): the rarest shingles of each text, so many that two similar texts must share one.

    s0..s3 hold the parity of the shingles in each of 256 slots: two sets differ by at least as many shingles as bits.
    """
    shared = texts.sparkSession.sparkContext.broadcast(order)
    shift = np.uint64(65 - len(order).bit_length())

    def run(batches):
        for batch in slices(batches):
            h, pos, rows, parity = [], [], [], []
            for k, found in enumerate(shingle_sets(batch.column("text"), words)):
                keep = len(found) - -(-percent * len(found) // 100) + 1
                h.append(found[np.lexsort((found, shared.value[found >> shift]))][:keep].view(np.int64))
                pos.append(np.arange(len(h[-1])))
                rows.append(np.full(len(h[-1]), k))
                parity.append(np.packbits(np.bincount((found >> np.uint64(8)).astype(np.uint8), minlength=256) & 1).view(np.int64))
            at = np.concatenate(rows)
            bits = np.stack(parity)[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(h)), pa.array(np.concatenate(pos)), *(batch.column(c).take(pa.array(at)) for c in ("node", "n", "comp")),
                 *(pa.array(bits[:, k]) for k in range(4))],
                ["h", "pos", "node", "n", "comp", "s0", "s1", "s2", "s3"],
            )

    return texts.select("node", "n", "comp", "text").mapInArrow(run, "h long, pos long, node long, n long, comp long, s0 long, s1 long, s2 long, s3 long")


def rest_pairs(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of members in different components that may be similar; no similar pair is missing.

    Two texts of similarity t share at least one of their rarest shingles, and the place of the first one bounds what
    they can share in all, as do the parities of the two sets. Texts that have only common passages in common, or copies
    that have drifted too far apart, therefore meet nowhere. The texts of the component that has most of a shingle's rows
    meet only those of the others, so a large group that shares its shingles isn't paired with itself.
    """
    here = written(members.select("node", "n", "comp").distinct().join(texts, "node"), "open-texts")
    total = here.agg(F.sum("n")).first()[0] or 0
    bits = min(max(LEAST_BITS, (4 * total).bit_length()), MOST_BITS)
    rows = written(prefixes(here, shingle_order(here, words, bits), words, percent), "prefixes")
    counted = rows.groupBy("h", "comp").agg(F.count("*").alias("_c"))
    several = counted.groupBy("h").agg(F.max_by("comp", F.struct("_c", "comp")).alias("main"), F.count("*").alias("_k")).filter("_k > 1").select("h", "main")
    live = written(rows.join(several, "h"), "live")
    columns = ("pos", "node", "n", "comp", "s0", "s1", "s2", "s3")
    left = live.filter("comp <> main").select("h", *(F.col(c).alias(f"{c}_a") for c in columns))
    right = live.select("h", "main", *(F.col(c).alias(f"{c}_b") for c in columns))
    most = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    both = F.col("n_a") + F.col("n_b")
    apart = sum((F.bit_count(F.col(f"s{k}_a").bitwiseXOR(F.col(f"s{k}_b"))) for k in range(4)), F.lit(0))
    fits = (most * (100 + percent) >= both * percent) & ((both - apart) * (100 + percent) >= both * 2 * percent)
    once = (F.col("comp_b") == F.col("main")) | (F.col("node_a") < F.col("node_b"))
    pairs = left.join(right, "h").filter((F.col("comp_a") != F.col("comp_b")) & once & fits)
    out = written(pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct(), "rest")
    discard(here, rows, live)
    return out


def link_buckets(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """All links needed to join the members of each bucket that are similar: confirmed (a, b).

    members: key, node, n. First every node is confirmed against one centre, then against the centre of each of its
    buckets, and of another one, unless both are known to be connected by then. Members of buckets that still hold several components are at
    last paired by their rarest shingles, which misses none and leaves texts apart that share common passages alone.
    """
    similar_size = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    links: DataFrame | None = None
    for salt, step in enumerate(("one centre", "all centres", "other centres", "rest")):
        known = here = None
        if links is None:
            placed = members.withColumn("comp", F.col("node"))
        else:
            known = components(links)
            placed = members.join(known, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
            split = placed.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1").select("key")
            placed = here = written(placed.join(split, "key", "left_semi"), "open")
        if step == "rest":
            pairs = rest_pairs(placed, texts, words, percent)
        else:
            order = F.struct(F.xxhash64(F.lit(salt), "node"), "node", "n", "comp")  # other centres in every step
            centre = placed.groupBy("key").agg(F.min(order).alias("m"))
            pairs = placed.join(centre, "key").select(
                F.col("m.node").alias("a"), F.col("node").alias("b"), F.col("m.n").alias("n_a"), F.col("n").alias("n_b"),
                F.col("m.comp").alias("c_a"), F.col("comp").alias("c_b"),
            ).filter((F.col("c_a") != F.col("c_b")) & similar_size)
            if step == "one centre":
                pairs = pairs.groupBy("b").agg(F.min(F.struct(F.xxhash64("a"), "a")).alias("m")).select("m.a", "b")
            pairs = written(pairs.select("a", "b").distinct(), "pairs")
        found = written(confirm(pairs, texts, words, percent), "links")
        links = found if links is None else links.unionByName(found)
        discard(pairs, here, known)
    return links


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs.

    component_id is the smallest doc_id reachable over links, the document itself included; kept marks it. Null text or
    text without words has an empty set and no link. Rows that share a doc_id count as one document, which has the links
    of all its texts; repeats of a row cost no more than their reading. A null doc_id has no component (null), links
    nothing and is kept. Empty input gives an empty result.
    """
    sketched = written(sketch(docs, words, percent), "sketch")
    sets = sketched.filter("doc_id IS NOT NULL AND set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    sets = written(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    # joined from written tables, so that Spark can split the rows of one very common set or group
    tagged = written(sketched.join(sets, "set_key", "left"), "tagged")
    dealt = tagged.filter("doc_id = rep").select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = dealt.groupBy("key").agg(F.min("node").alias("i0"), F.max("node").alias("i1")).filter("i0 <> i1").select("key")
    members = written(dealt.join(shared, "key"), "buckets")
    nodes = sets.join(members.select("node").distinct(), "node", "left_semi")
    texts = written(node_texts(docs, nodes, words), "texts")
    links = link_buckets(members, texts, words, percent)
    # rows of one id with different texts are one document: tie their sets together
    rows = tagged.filter("doc_id IS NOT NULL AND node IS NOT NULL").select("doc_id", "node")
    several = rows.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("r1")).filter("a <> r1").select("doc_id", "a")
    ties = rows.join(several, "doc_id").select("a", F.col("node").alias("b"))
    known = components(links.unionByName(ties))
    named = known.join(sets.select("node", "rep"), "node")
    smallest = named.groupBy("component").agg(F.min("rep").alias("smallest"))
    found = written(named.join(smallest, "component").select("node", "smallest"), "found")
    discard(sketched, sets, members, texts, known)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "rep", "doc_id"))
    return tagged.join(found, "node", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def deduplicate(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows of docs that stay, one per group of near-duplicates, with all their columns; rows that repeat the doc_id that
    stays all stay."""
    dropped = near_duplicates(docs, words, percent).filter("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, docs.doc_id == dropped._dropped, "left_anti")
