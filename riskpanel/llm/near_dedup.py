"""MinHash near-deduplication with tensored banding, links verified on full shingle sets.

Table keys are pairs: one part from a first collection of short minhash
tuples, one from a second. HALVES parts a side make HALVES x HALVES tables
from 2 x HALVES x ROWS minhashes instead of HALVES x HALVES x 2 x ROWS. A pair
of sides must both be shared for a key to be shared, so only parts that some
other document has are combined.

Steps: (1) one pass makes each document's signature; documents with the same
words are one class, and only classes go on. (2) Classes with a table key in
common are joined into candidate clusters by star edges (no pairs). (3) Shingle
sets of clustered classes are compared, exactly, in blocks of bounded size: all
pairs of a block (or of two blocks of a large cluster that can hold similar
sizes) are counted in one task, which returns a spanning forest of the true
links. (4) Components of those links are the groups.

A pair is compared if its classes share a cluster, so a missed table key loses
a link only if no chain of keys joins the two. At a similarity of 0.80 the
probability that two documents share no key is about 2 * (1 - 0.80 ** 3) ** 13,
that is 1.8e-4; at 0.85 it is 8e-6, and it falls quickly above.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.common import parallelism, shipped, written
from riskpanel.llm.components import connected_components

WORDS = 5
HALVES, ROWS = 13, 3
#: Documents and shingles of one block.
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1_000_000
_CHUNK = 4096
_rng = np.random.Generator(np.random.PCG64(71))
_MULTIPLY = _rng.integers(0, 2 ** 63, 2 * HALVES * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2 ** 64, 2 * HALVES * ROWS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased: maximal runs without ASCII white space."""
    return text.lower().split()


def shingles(words: list[bytes], k: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words make one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < k:
        acc = np.full(1, len(words), np.uint64)
        for x in h:
            acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + x)
        return acc
    n = len(h) - k + 1
    acc = np.full(n, k, np.uint64)
    for i in range(k):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(acc)


def half_keys(s: np.ndarray) -> np.ndarray:
    """2 x HALVES keys of ROWS minhashes each, of a non-empty shingle set."""
    least = np.full(len(_ADD), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), _CHUNK):
        least = np.minimum(least, (s[i:i + _CHUNK, None] * _MULTIPLY + _ADD).min(axis=0))
    parts = least.reshape(2 * HALVES, ROWS)
    acc = np.arange(1, 2 * HALVES + 1, dtype=np.uint64)
    for i in range(ROWS):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return acc


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, c1, c2, half_a, half_b): set size, digest of the words, half keys."""
    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                n, c1, c2, ha, hb = [], [], [], [], []
                for t in part.column(1):
                    words = words_of(t.as_py()) if t.is_valid else []
                    sh = shingles(words)
                    digest = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), np.int64)
                    k = half_keys(sh).view(np.int64) if len(sh) else np.zeros(0, np.int64)
                    n.append(len(sh))
                    c1.append(int(digest[0]))
                    c2.append(int(digest[1]))
                    ha.append(k[:HALVES])
                    hb.append(k[HALVES:])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                     pa.array(ha, pa.list_(pa.int64())), pa.array(hb, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "c1", "c2", "half_a", "half_b"])

    return shipped(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id long, n_shingles long, c1 long, c2 long, half_a array<long>, half_b array<long>")


def candidate_stars(classes: DataFrame) -> DataFrame:
    """Edges (u, v) that join all classes sharing a table key, from (node, half_a, half_b)."""
    halves = classes.select("node", F.explode("half_a").alias("h"), F.lit(True).alias("first")).unionByName(
        classes.select("node", F.explode("half_b").alias("h"), F.lit(False).alias("first")))
    halves = written(halves, "near-halves")
    shared = halves.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    sides = (halves.join(shared, "h", "left_semi").groupBy("node")
             .agg(F.collect_list(F.when(F.col("first"), F.col("h"))).alias("a"),
                  F.collect_list(F.when(~F.col("first"), F.col("h"))).alias("b")))
    keys = written(sides.select("node", F.explode("a").alias("a"), "b")
                   .select("node", "a", F.explode("b").alias("b"))
                   .select("node", F.xxhash64("a", "b").alias("key")), "near-keys")
    centre = keys.groupBy("key").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1").select("key", "v")
    return keys.join(centre, "key").filter("node <> v").select(F.col("node").alias("u"), "v").distinct()


def similar(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix: which sets (sorted, distinct) have 100 * intersection >= percent * union."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    inter = np.zeros(n * n, np.int64)
    values = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    times = np.diff(np.append(start, len(values)))
    # elements of few sets: count each pair; of many: multiply incidence matrices
    few = 32
    held, kept = 0, []
    for m in np.unique(times[(times > 1) & (times <= few)]):
        rows = owner[start[times == m][:, None] + np.arange(m)]
        for i in range(m):
            for j in range(i + 1, m):
                kept.append(rows[:, i] * n + rows[:, j])
                held += len(rows)
                if held > 2_000_000:
                    inter += np.bincount(np.concatenate(kept), minlength=n * n)
                    held, kept = 0, []
    if kept:
        inter += np.bincount(np.concatenate(kept), minlength=n * n)
    inter = inter.reshape(n, n)
    inter = inter + inter.T
    many = np.flatnonzero(times > few)
    for i in range(0, len(many), 2048):
        part = many[i:i + 2048]
        column = np.repeat(np.arange(len(part)), times[part])
        at = np.concatenate([np.arange(start[g], start[g] + times[g]) for g in part])
        incidence = np.zeros((n, len(part)), np.float32)
        incidence[owner[at], column] = 1
        inter += np.rint(incidence @ incidence.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - inter
    link = (100 * inter >= percent * union) & (inter > 0)
    np.fill_diagonal(link, False)
    return link


def spanning(link: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix, the least row of its component."""
    label = np.arange(len(link))
    i, j = np.nonzero(link)
    while len(i):
        new = label.copy()
        np.minimum.at(new, i, label[j])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    return label


def _verify(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node").drop_duplicates("node")  # a class whose words several rows of its least id have
        ids = pdf["node"].to_numpy()
        label = spanning(similar([np.asarray(s, np.int64).view(np.uint64) for s in pdf["s"]], percent))
        moved = label != np.arange(len(label))
        return pd.DataFrame({"u": ids[moved], "v": ids[label[moved]]})
    return run


def _sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """members (node, rep, c1, c2, jobs) with their shingle set s, read once more from the texts of document rep."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                node, jobs, sets = [], [], []
                for r, t, c1, c2, j in zip(*[c for c in part.columns]):
                    words = words_of(t.as_py()) if t.is_valid else []
                    digest = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), np.int64)
                    if (digest[0], digest[1]) == (c1.as_py(), c2.as_py()):
                        node.append(r.as_py())
                        jobs.append(j.as_py())
                        sets.append(shingles(words).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), pa.array(jobs, pa.list_(pa.string())),
                     pa.array(sets, pa.list_(pa.int64()))], ["node", "jobs", "s"])

    text = shipped(docs).select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("binary").alias("text"))
    # members grow with the input, so the join shuffles at every size instead of turning into a broadcast at some
    return text.join(members.hint("merge"), "rep").select("node", "text", "c1", "c2", "jobs") \
        .mapInArrow(run, "node long, jobs array<string>, s array<long>")


def comparison_jobs(members: DataFrame, percent: int) -> DataFrame:
    """Add ``jobs``: names of the block comparisons each (node, n, cluster) takes part in.

    Small clusters share comparisons. A large one is cut by set size into
    layers so wide that linked sets lie in the same layer or in neighbours,
    and a layer into blocks; all blocks that can hold a link are compared.
    """
    width = -np.log(percent / 100 - 1e-6)
    total = members.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(parallelism(members), -(-total[0] // (BLOCK_SHINGLES // 2)), -(-total[1] // (BLOCK_DOCS // 2)))
    size = members.groupBy("cluster").agg(F.sum("n").alias("c_n"), F.count(F.lit(1)).alias("c_docs"))
    m = members.join(size, "cluster")
    large = (F.col("c_docs") > BLOCK_DOCS) | (F.col("c_n") > BLOCK_SHINGLES)
    small = m.filter(~large).withColumn("jobs", F.array(F.concat(
        F.lit("s"), F.pmod(F.xxhash64("cluster"), F.lit(tasks)).cast("string"))))
    big = m.filter(large).withColumn("layer", F.floor(F.log("n") / F.lit(float(width))))
    blocks = big.groupBy("cluster", "layer").agg(F.greatest(
        F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_DOCS)).alias("blocks"))
    near = blocks.select("cluster", "layer", F.col("blocks").alias("b0"))
    for step, name in ((1, "b1"), (-1, "b_1")):
        near = near.join(blocks.select("cluster", (F.col("layer") - step).alias("layer"),
                                       F.col("blocks").alias(name)), ["cluster", "layer"], "left")
    near = written(near, "near-blocks")  # plain tables on both sides: a hot layer's partition can be split
    big = big.join(near, ["cluster", "layer"]).withColumn("i", F.pmod(F.xxhash64("node"), F.col("b0")))
    own = F.expr("""transform(sequence(0L, b0 - 1), j -> concat_ws(':', cluster, layer, least(i, j), layer, greatest(i, j)))""")
    up = F.expr("""case when b1 is null then array() else
        transform(sequence(0L, b1 - 1), j -> concat_ws(':', cluster, layer, i, layer + 1, j)) end""")
    down = F.expr("""case when b_1 is null then array() else
        transform(sequence(0L, b_1 - 1), j -> concat_ws(':', cluster, layer - 1, j, layer, i)) end""")
    big = big.withColumn("jobs", F.concat(own, up, down))
    cols = ["node", "rep", "c1", "c2", "jobs"]
    return small.select(*cols).unionByName(big.select(*cols))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, kept).

    Documents are linked if their shingle sets' intersection is at least
    ``percent`` hundredths of the union; component_id is the smallest id
    reachable over links (itself included) and kept says whether that is the
    document's own. Texts that are null or without words have no shingles and
    no links. A null id is ignored as a component's name: its row gets the
    component of its words' class (null if no document with an id has those
    words) and is not kept. Rows repeated with the same id and text have the
    same result each. Empty input gives no rows.
    """
    sig = written(signatures(docs), "near-signatures")
    some = sig.filter("n_shingles > 0")
    # a class has a number of its own: an id with two texts is the least of two classes
    classes = written(some.filter("doc_id is not null").groupBy("c1", "c2").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
        F.first("half_a").alias("half_a"), F.first("half_b").alias("half_b"))
        .withColumn("node", F.monotonically_increasing_id()), "near-classes")
    clusters = connected_components(candidate_stars(classes))
    members = written(classes.select("node", "rep", "c1", "c2", "n").join(
        clusters.select("node", F.col("component").alias("cluster")), "node"), "near-members")
    jobs = written(comparison_jobs(members, percent), "near-jobs")
    sets = _sets(docs, jobs).select(F.explode("jobs").alias("job"), "node", "s")
    links = shipped(sets).groupBy("job").applyInPandas(_verify(percent), "u long, v long")
    groups = connected_components(links)
    grouped = written(classes.select("c1", "c2", "rep", "node").join(groups, "node", "left")
                      .withColumn("component", F.coalesce("component", "node")), "near-grouped")
    least = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = written(grouped.select("c1", "c2", "component").join(least, "component").drop("component"), "near-named")
    linked = some.select("doc_id", "n_shingles", "c1", "c2").join(named, ["c1", "c2"], "left") \
        .select("doc_id", "n_shingles", "component_id")
    alone = sig.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def drop_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One document of each group, with all columns: the one whose id names the group.

    Rows with a null id name no group and stay; rows repeated with the id that
    stays are all kept.
    """
    stay = near_duplicates(docs, percent).filter("kept").select(F.col("doc_id").alias("__stay")).distinct()
    whole = docs.join(stay, docs["doc_id"].cast("long") == F.col("__stay"), "left_semi")
    return whole.unionByName(docs.filter("doc_id is null"))
