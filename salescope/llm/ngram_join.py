"""N-gram Jaccard join: documents linked by the overlap of their shingle sets.

Size-aware and in two halves. Small sets enumerate their subsets of the size
that a link needs: two sets that share such a subset are linked, nothing is
left to check. Large sets go through inverted lists of their rarest shingles:
in any fixed order of shingles, two sets at the threshold meet in their first
``n - ceil(0.8 n) + 1``. The boundary between the halves is the size at which
the cost, summed over the sizes that the corpus has, is least.

The order is a hash, with shingles that many documents share put last, so
that a passage in a third of all documents is not what lists are made of.
Exact copies are one node by the fingerprint of their sets. Links are sought
to find components, so a list first links each member to the list's least
node; the pairs left are those between different components, and all of them
are checked, first on bitmaps of the sets, whose distance is a lower bound of
what the sets differ in, then on the whole sets, computed from the texts again
where the pair's leader is; leaders with many partners are salted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, few, free_name, mix, signed, slices, staged, text_column
from .components import components

#: words of a shingle, and the threshold in hundredths
SHINGLE, THRESHOLD = 5, 80
#: a shingle counts as shared by many from so many documents of one batch on
HEAVY_IN_BATCH = 4
#: most shingles that are put last; it only bears on the speed
HEAVY_MOST = 200_000
#: cost of a list entry in subsets
ENTRY_COST = 4
#: largest size that may count as small
SMALL_MOST = 24
#: partners of a leader that one task checks
SALT_ROWS = 400


def needed(s: int, t: int) -> int:
    """Least intersection of linked sets of s and t shingles."""
    return -(-THRESHOLD * (s + t) // (100 + THRESHOLD))


def least_size(s: int) -> int:
    """Size of the smallest set that a set of s shingles can link to."""
    return -(-THRESHOLD * s // 100)


def prefix_size(n):
    return n - -(-THRESHOLD * n // 100) + 1


def can_link(shared: str) -> F.Column:
    """Whether sets of na and nb shingles that share so many of their prefixes
    can be linked: of the one whose prefix ends first, every shingle they share
    lies in both prefixes or behind its own."""
    behind = F.greatest(F.col("na") - prefix_column("na"), F.col("nb") - prefix_column("nb"))
    return (100 + THRESHOLD) * (F.col(shared) + behind) >= THRESHOLD * (F.col("na") + F.col("nb"))


def prefix_column(n: str) -> F.Column:
    return F.col(n) - F.ceil(THRESHOLD * F.col(n) / 100) + 1


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row offsets): the distinct shingles of each text, ascending."""
    w = Words(texts, lower=True)
    size = np.diff(w.first)
    row = np.repeat(np.arange(len(size)), size)
    grams, whole = w.grams(SHINGLE)
    keep = whole.copy()
    with np.errstate(over="ignore"):
        for n in range(1, SHINGLE):
            at = w.first[:-1][size == n]
            if len(at):
                short, _ = w.grams(n)
                grams[at] = mix(short[at] + np.uint64(n))
                keep[at] = True
    row, grams = row[keep], grams[keep]
    order = np.lexsort((grams, row))
    row, grams = row[order], grams[order]
    if len(row):
        fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (grams[1:] != grams[:-1])])
        row, grams = row[fresh], grams[fresh]
    return grams, np.searchsorted(row, np.arange(len(size) + 1))


def fingerprints(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One 64-bit value a set; 0 for the empty set."""
    out = np.zeros(len(at) - 1, np.uint64)
    some = np.diff(at) > 0
    if len(grams):
        with np.errstate(over="ignore"):
            out[some] = mix(np.add.reduceat(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), at[:-1][some]) + np.diff(at)[some].astype(np.uint64))
    return out


def bitmaps(grams: np.ndarray, at: np.ndarray) -> pa.Array:
    """A bitmap of each set: a power of two of bits, at least 64 and twice the
    set's size, each the parity of the shingles whose hash falls on it; empty
    for the empty set."""
    n = np.diff(at)
    bits = np.where(n > 0, 1 << np.ceil(np.log2(np.maximum(2 * n, 64))).astype(np.int64), 0)
    first = np.concatenate([[0], np.cumsum(bits)])
    spot = np.sort(np.repeat(first[:-1], n) + (grams & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64))
    edge = np.flatnonzero(np.concatenate([[True], spot[1:] != spot[:-1]])) if len(spot) else np.zeros(0, np.int64)
    flags = np.zeros(int(first[-1]), np.uint8)
    flags[spot[edge]] = np.diff(np.append(edge, len(spot))) & 1
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((first // 8).astype(np.int32)), pa.py_buffer(np.packbits(flags))])


def bits_apart(x: np.ndarray, y: np.ndarray) -> int:
    """Bits in which two bitmaps differ, the longer one folded to the shorter:
    at most the shingles that are in one of the two sets only."""
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _heavy(docs: DataFrame) -> np.ndarray:
    """Shingles of many documents, ascending: at most HEAVY_MOST."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = np.concatenate([shingle_sets(p.column("text"))[0] for p in slices(batch)] or [np.zeros(0, np.uint64)])
            grams.sort()
            edge = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
            count = np.diff(np.append(edge, len(grams)))
            many = count >= HEAVY_IN_BATCH
            yield pa.RecordBatch.from_arrays([pa.array(signed(grams[edge[many]])), pa.array(count[many], pa.int64())], ["shingle", "n"])

    rows = docs.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = rows.orderBy(F.desc("n"), "shingle").limit(HEAVY_MOST).select("shingle").collect()
    return np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))


def _read(docs: DataFrame, heavy: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, prefix, small, bitmap) of every
    document: ``prefix`` for the lists, ``small`` the whole set of a set that
    may count as small."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)        # at most HEAVY_MOST hashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = shared.value
        for batch in batches:
            for part in slices(batch):
                grams, at = shingle_sets(part.column("text"))
                n = np.diff(at)
                node = fingerprints(grams, at)
                row = np.repeat(np.arange(len(n)), n)
                many = np.zeros(len(grams), bool)
                if len(last) and len(grams):
                    i = np.minimum(np.searchsorted(last, grams), len(last) - 1)
                    many = last[i] == grams
                order = np.lexsort((many, row))                      # stable: hashes stay ascending
                place = np.arange(len(grams)) - np.repeat(at[:-1], n)
                used = place < np.repeat(prefix_size(n), n)
                prefix = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, prefix_size(n), 0))]), pa.int32()), pa.array(signed(grams[order][used])))
                tiny = n <= SMALL_MOST
                small = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(tiny, n, 0))]), pa.int32()), pa.array(signed(grams[np.repeat(tiny, n)])))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(n, pa.int64()), pa.array(signed(node)), prefix, small, bitmaps(grams, at)],
                    ["doc_id", "text_hash", "n_shingles", "node", "prefix", "small", "bitmap"])

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, node long, prefix array<long>, small array<long>, bitmap binary")


def boundary(sizes: dict[int, int]) -> int:
    """The largest size whose sets enumerate subsets: least cost over the
    numbers of sets of each size up to SMALL_MOST."""
    def subsets(s: int) -> int:
        return sum(comb(s, needed(s, t)) for t in range(least_size(s), s + 1)) + sum(
            comb(s, needed(s, t)) for t in range(s + 1, 100 * s // THRESHOLD + 1))

    costs = {x: sum(n * (subsets(s) if s <= x else ENTRY_COST * prefix_size(s)) for s, n in sizes.items()) for x in range(SMALL_MOST + 1)}
    return min(costs, key=lambda x: (costs[x], x))


def _subset_links(sets: DataFrame, most: int) -> DataFrame:
    """(u, v): links of sets of at most ``most`` shingles (node, small)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, list, list] = ([], [], [])
            for node, small in zip(batch.column("node").to_pylist(), batch.column("small").to_pylist()):
                s = len(small)
                with np.errstate(over="ignore"):
                    hashes = mix(np.array(small, np.int64).view(np.uint64))
                for t in range(least_size(s), min(most, 100 * s // THRESHOLD) + 1):
                    size, big, little = needed(s, t), max(s, t), min(s, t)
                    tag = np.uint64(big << 32 | little << 16)
                    with np.errstate(over="ignore"):
                        keys = mix(np.array([hashes[list(c)].sum() for c in combinations(range(s), size)], np.uint64) ^ tag)
                    for role in (True, False) if s == t else (s == big,):
                        rows[0].extend(signed(keys).tolist())
                        rows[1].extend([node] * len(keys))
                        rows[2].extend([role] * len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.bool_())], ["subset", "node", "big"])

    # every larger set of a subset links to every smaller one: the least of the other side links them all
    member = sets.mapInArrow(run, "subset long, node long, big boolean").distinct()
    least = staged(member.groupBy("subset").agg(F.min(F.when(F.col("big"), F.col("node"))).alias("of_big"), F.min(F.when(~F.col("big"), F.col("node"))).alias("of_little"))
                   .filter("of_big IS NOT NULL AND of_little IS NOT NULL"), "join-subsets")
    return member.join(least, "subset").select(F.col("node").alias("u"), F.when(F.col("big"), F.col("of_little")).otherwise(F.col("of_big")).alias("v")).filter("u <> v").distinct()


def _asked(pairs: DataFrame) -> DataFrame:
    """(a, salt, role, node): the partners (role 1) of each leader a of the
    pairs (a, b), salted, and the leader itself (role 0) once a salt."""
    salts = staged(pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts")), "join-salts")
    member = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), F.lit(1).alias("role"), F.col("b").alias("node"))
    leader = salts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("a").alias("node"))
    return member.unionByName(leader)


def _led(rows: DataFrame) -> DataFrame:
    """Each leader's rows of a salt in one task, the leader first."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", "role")


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bitmaps leave a link possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, None, 0
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for a, salt, role, node, n, bitmap in zip(*(batch.column(c) for c in ("a", "salt", "role", "node", "n", "bitmap"))):
                now, n = (a.as_py(), salt.as_py()), n.as_py()
                mine = np.frombuffer(bitmap.as_buffer(), np.uint8)
                if role.as_py() == 0:
                    key, held, size = now, mine.copy(), n
                elif key == now and bits_apart(held, mine) <= size + n - 2 * needed(size, n):
                    out[0].append(now[0])
                    out[1].append(node.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], ["a", "b"])

    rows = _asked(pairs).join(nodes.select("node", "n", "bitmap"), "node").select("a", "salt", "role", "node", "n", "bitmap")
    return _led(rows).mapInArrow(run, "a long, b long")


def _checked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are at the threshold."""
    asked = _asked(staged(_likely(pairs, nodes), "join-likely")).join(nodes.select("node", F.col("doc_id").alias("at")), "node")
    texts = docs.join(few(staged(asked, "join-asked")), docs["doc_id"].eqNullSafe(F.col("at"))).select("a", "salt", "role", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            for part in slices(batch):
                grams, at = shingle_sets(part.column("text"))
                found = signed(fingerprints(grams, at))
                out: tuple[list, list] = ([], [])
                for i, (a, salt, role, node) in enumerate(zip(*(part.column(c).to_pylist() for c in ("a", "salt", "role", "node")))):
                    if found[i] != node:                             # another text of the same id
                        continue
                    mine = grams[at[i]:at[i + 1]]
                    if role == 0:
                        key, held = (a, salt), mine.copy()
                    elif key == (a, salt):
                        place = np.minimum(np.searchsorted(held, mine), len(held) - 1)
                        both = int((held[place] == mine).sum())
                        if 100 * both >= THRESHOLD * (len(held) + len(mine) - both):
                            out[0].append(a)
                            out[1].append(node)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], ["u", "v"])

    return _led(texts).mapInArrow(run, "u long, v long").distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``: see ``_components``."""
    return _components(docs).select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id) of every row of ``docs``
    (doc_id, text).

    A null or empty text, or one of separators only, has no shingles and is
    linked with nothing: its component is its own id. Copies and repeated rows
    share one component; a component's id is its least non-null document id,
    null if it has none; other columns are ignored; an empty table gives an
    empty table.
    """
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text"))
    sets = staged(_read(docs, _heavy(docs)), "join-sets")
    full = sets.filter("n_shingles > 0")
    # copies are one node from here on, already before the shuffle where a task has several
    nodes = staged(full.groupBy("node").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("n_shingles", "prefix", "small", "bitmap")))
                   .withColumnRenamed("n_shingles", "n"), "join-nodes")
    sizes = {r["n"]: r["count"] for r in nodes.filter(F.col("n") <= SMALL_MOST).groupBy("n").count().collect()}
    most = boundary(sizes)
    small = nodes.filter(F.col("n") <= most).select("node", "small")
    links = staged(_subset_links(small, most), "join-links")

    # lists: of sets over the boundary, and of those small ones that can link to such a set
    listed = nodes.filter(F.col("n") >= least_size(most + 1)).select("node", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "shingle"))
    of_list = Window.partitionBy("shingle")
    entries = staged(listed.withColumn("low", F.min("node").over(of_list)).withColumn("high", F.max("node").over(of_list)).filter("low < high")
                     .select("shingle", "node", "n", "pos"), "join-entries")
    # the member that shares most leads a list: of near copies that is their original
    weight = staged(entries.withColumn("others", F.count("*").over(of_list)).groupBy("node").agg(F.sum("others").alias("weight")), "join-weights")
    leads = staged(entries.join(weight, "node").groupBy("shingle").agg(F.max(F.struct("weight", "node", "n")).alias("lead"))
                   .select("shingle", F.col("lead.node").alias("a"), F.col("lead.n").alias("na")), "join-leads")
    stars = entries.join(leads, "shingle").filter("node <> a").groupBy("a", F.col("node").alias("b")).agg(
        F.count("*").alias("shared"), F.first("na").alias("na"), F.first("n").alias("nb")).filter(can_link("shared"))
    first = staged(stars.groupBy("b").agg(F.max(F.struct("shared", "a")).alias("best")).select("best.a", "b"), "join-first")
    links = staged(links.unionByName(_checked(first, nodes, docs)), "join-links")
    roots = staged(components(links), "join-roots")

    # what the stars leave: pairs of a list that are in different components and unchecked
    placed = staged(entries.join(roots, "node", "left").select("shingle", "node", "n", "pos", F.coalesce("root", "node").alias("root")), "join-members")
    split = staged(placed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("shingle"), "join-split")
    left = placed.join(split, "shingle")
    x = left.select("shingle", F.col("node").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("root").alias("ra"))
    y = left.select("shingle", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("root").alias("rb"))
    fits = (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & (100 * F.least("na", "nb") >= THRESHOLD * F.greatest("na", "nb"))
    # entries that agree only late in both lists leave too little to share
    fits &= (100 + THRESHOLD) * F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= THRESHOLD * (F.col("na") + F.col("nb"))
    rest = staged(x.join(y, "shingle").filter(fits).select("a", "b").distinct().join(
        first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "join-rest")
    more = staged(_checked(rest, nodes, docs), "join-more")
    roots = staged(components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more)), "join-roots")

    named = nodes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_node = staged(named.select("node", "root").join(staged(least, "join-least"), "root").select("node", "component_id"), "join-components")
    return full.select("doc_id", "text_hash", "n_shingles", "node").join(of_node, "node").drop("node").unionByName(
        sets.filter("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``: that of the component's id, or
    where rows share that id, of the least text hash. Texts without shingles
    are groups by their ids; a component without an id keeps a row likewise."""
    found = staged(_components(docs), "join-found")
    group = ["component_id", F.col("n_shingles") == 0]
    kept = staged(found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(*group).agg(F.min("text_hash").alias("_hash"))
                  .select(F.col("component_id").alias("_id"), "_hash").distinct(), "join-kept")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    gone = staged(found.join(kept, same, "left_anti").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "join-gone")
    hashed = F.xxhash64(text_column(docs))
    rows = docs.join(few(gone), docs["doc_id"].cast("long").eqNullSafe(gone["_id"]) & (hashed == gone["_hash"]), "left_anti")
    again = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows")).filter("rows > 1")
    if not again.isEmpty():                     # rows that repeat id and text
        name = free_name(docs, "_hash")
        rows = rows.withColumn(name, hashed).dropDuplicates(["doc_id", name])
    return rows.select(*docs.columns)
