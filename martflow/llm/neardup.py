"""MinHash near-dedup with SetSketch registers.

Each document's set of word shingles becomes a SetSketch: per register the
smallest of exponentially distributed hash values, truncated to a whole power of
a base just over 1. Registers merge by maximum and are equal in two sketches
about as often as the sets are alike.

Documents with equal sets are one class. Bands of registers put classes into
buckets, and links are looked for in two passes. In the first, each bucket's
members are compared with its smallest one only: a candidate passes if the joint
likelihood of both sketches doesn't rule the threshold out (by more than
``SIGMAS`` standard deviations), and is then confirmed on the full sets. What
that links is contracted. In the second pass, buckets that still hold several
components compare members of different components inside the tasks, by registers
and then on the full sets, and give back only links that join two components. So a
group of thousands of copies costs a comparison or a few for each member, no pairs
are written down, and no candidate is left out: members of one component need no
further comparison. A large bucket is cut into blocks by number and bytes of its
sets. Those of its largest component stay where they are; the others are sent to
each of them, and to each other.

A pair at the threshold shares no band with a probability of 3 in ten million
(40 bands of 4 registers); likelier the more alike it is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import ngram_hashes, pieces, table, whole, word_hashes
from martflow.llm.graph import components
from martflow.session import settle

WORDS = 5
ALIKE = 75  # per cent: intersection of union
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
SIGMAS = 5.0
BLOCK = 2048  # members of a block of a bucket, and of several small buckets in one task, about
BLOCK_BYTES = 64 << 20  # and bytes of their sets, about; a block has one set at least
_NO_ID = 1 << 62  # rows without an id are nodes from here on, by their text

_DRAW = np.random.Generator(np.random.PCG64(75))
_FACTORS = _DRAW.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _DRAW.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z are read as lower case."""
    found = word_hashes(text.encode().lower())
    if not len(found):
        return found
    return np.unique(ngram_hashes(found, min(words, len(found))))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The SetSketch of a non-empty set of hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 4096):
        values = hashes[at:at + 4096, None] * _FACTORS + _OFFSETS
        least = np.minimum(least, (values ^ (values >> np.uint64(32))).min(0))
    smallest = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, TOP).astype("<u2")


def _chance(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def plausible(n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray, alike: float, sigmas: float = SIGMAS) -> np.ndarray:
    """Whether a similarity of ``alike`` or more isn't ruled out by registers (rows of ``a`` and ``b``) and set sizes.

    The numbers of larger, smaller and equal registers have a joint likelihood
    given the similarity; its best value is searched on a grid and compared with
    the likelihood at ``alike``.
    """
    over, under = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - over - under
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)

    def fit(j: np.ndarray) -> np.ndarray:
        up, down = _chance(np.maximum(u - v * j, 1e-12)), _chance(np.maximum(v - u * j, 1e-12))
        return over * np.log(up) + under * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-12))

    grid = most * np.linspace(0, 1, 129)[None, :]
    values = fit(grid)
    best = values.argmax(1)
    estimate = grid[np.arange(len(grid)), best]
    behind = values.max(1) - fit(np.full((len(grid), 1), alike))[:, 0]
    return (most[:, 0] >= alike - 1e-9) & ((estimate >= alike) | (2 * behind <= sigmas**2))


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, node, n, sig, regs) of every row; ``sig`` identifies the set, empty sets have null."""
    def run(batches):
        for batch in pieces(batches, "text"):
            rows = [shingles(text, words) for text in batch.column("text").to_pylist()]
            regs = [registers(x) if len(x) else None for x in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("node"), pa.array([len(x) for x in rows], pa.int64()),
                 pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in rows], pa.binary()),
                 pa.array([r.tobytes() if r is not None else None for r in regs], pa.binary())],
                names=["doc_id", "node", "n", "sig", "regs"],
            )

    return _rows(docs).mapInArrow(run, "doc_id bigint, node bigint, n bigint, sig binary, regs binary")


def _node() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(whole()).bitwiseAND(_NO_ID - 1) + _NO_ID)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _node().alias("node"), whole().alias("text"))


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, hashes): the full sets of the wanted nodes, from their texts."""
    def run(batches):
        for batch in pieces(batches, "text"):
            rows = [shingles(text, words) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([x.tobytes() for x in rows], pa.binary())], names=["node", "hashes"]
            )

    chosen = _rows(docs).select("node", "text").join(wanted.hint("shuffle_hash"), "node", "left_semi")
    return chosen.mapInArrow(run, "node bigint, hashes binary")


def _likely(pairs: DataFrame, classes: DataFrame, alike: float) -> DataFrame:
    """Pairs (a, b) whose sketches don't rule the similarity out."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype="<u2").reshape(-1, REGISTERS)
                for name in ("regs_a", "regs_b")
            )
            n_a, n_b = (batch.column(name).to_numpy().astype(float) for name in ("n_a", "n_b"))
            passed = pa.array(plausible(n_a, n_b, a, b, alike))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(passed), batch.column("b").filter(passed)], names=["a", "b"]
            )

    side = lambda name: classes.select(
        F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("regs").alias(f"regs_{name}")
    )
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, sets: DataFrame, alike: int) -> DataFrame:
    """Pairs (a, b) whose full sets are alike."""
    def run(batches):
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(s.as_buffer(), dtype="<u8") for s in (a, b))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= alike * (len(x) + len(y) - both))
            passed = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(passed), batch.column("b").filter(passed)], names=["a", "b"]
            )

    side = lambda name: sets.select(F.col("node").alias(name), F.col("hashes").alias(f"set_{name}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a bigint, b bigint").distinct()


def least_equal(alike: int) -> int:
    """Registers that two sketches share at least where the sets are alike, but for one pair in some millions.

    Each is equal with about the similarity as its chance.
    """
    j = alike / 100
    return int(REGISTERS * j - SIGMAS * np.sqrt(REGISTERS * j * (1 - j)))


def joining_links(nodes: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], regs: np.ndarray, side: np.ndarray, inside: bool,
                  alike: int) -> list[tuple[int, int]]:
    """Links between members of different components, as many as join them.

    Members of different sides are compared, and with ``inside`` also those of
    one side other than 0. Sides are in order, 0 last.
    """
    labels, sizes = labels.copy(), np.array([len(x) for x in sets])
    dense = np.unique(np.concatenate(sets), return_inverse=True)[1]
    edges = np.concatenate([[0], np.cumsum(sizes)])
    held, found, equal = np.zeros(dense.max() + 1, dtype=np.int32), [], least_equal(alike)
    for i in range(int((side != 0).sum())):
        low, high = np.minimum(sizes[i], sizes[i + 1:]), np.maximum(sizes[i], sizes[i + 1:])
        wanted = (labels[i + 1:] != labels[i]) & (100 * low >= alike * high)
        if not inside:
            wanted &= side[i + 1:] != side[i]
        others = i + 1 + np.flatnonzero(wanted)
        others = others[(regs[others] == regs[i]).sum(1) >= equal]
        if not len(others):
            continue
        own = dense[edges[i]:edges[i + 1]]
        held[own] = 1
        at = np.concatenate([[0], np.cumsum(sizes[others])])
        places = np.arange(at[-1]) + np.repeat(edges[others] - at[:-1], sizes[others])
        both = np.add.reduceat(held[dense[places]], at[:-1])
        held[own] = 0
        for j in others[100 * both >= alike * (sizes[i] + sizes[others] - both)].tolist():
            if labels[j] != labels[i]:
                found.append((int(nodes[i]), int(nodes[j])))
                labels[labels == labels[j]] = labels[i]
    return found


def dealt_across(open_: DataFrame) -> DataFrame:
    """(bin, task, inside, side, node, component) of every row of ``open_`` (key, node, component, n) in every task it takes part in.

    The largest component of a bucket is side 0. Each of its blocks meets each
    block of the rest, and these meet each other; pairs of rows of one block of
    the rest are compared where it meets the first block of side 0.
    """
    count, size = F.count(F.lit(1)).alias("m"), F.sum(F.col("n") * 8).alias("bytes")
    of_component = open_.groupBy("key", "component").agg(count, size)
    largest = F.max_by(F.struct("component", "m", "bytes"), F.struct("m", -F.col("component")))
    of_key = of_component.groupBy("key").agg(largest.alias("main"), F.sum("m").alias("m"), F.sum("bytes").alias("bytes"))
    cut = lambda m, b: F.greatest(F.ceil(m / BLOCK), F.ceil(b / BLOCK_BYTES), F.lit(1)).cast("int")
    of_key = settle(of_key.select(
        "key", F.col("main.component").alias("_main"), cut(F.col("main.m"), F.col("main.bytes")).alias("mains"),
        cut(F.col("m") - F.col("main.m"), F.col("bytes") - F.col("main.bytes")).alias("rests"),
    ), "buckets")
    rows = open_.join(of_key, "key").withColumn("_is_main", F.col("component") == F.col("_main"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("_is_main"), F.col("mains")).otherwise(F.col("rests"))).cast("int")
    rows = rows.withColumn("_own", own)
    up_to = lambda n: F.sequence(F.lit(0), n - 1)
    task = lambda a, b: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))
    # Blocks a of side 0 with b of the rest; for blocks of the rest, the smaller one is -1 - a.
    with_rests = F.transform(up_to(F.col("rests")), lambda b: task(F.col("_own"), b))
    with_mains = F.transform(up_to(F.col("mains")), lambda a: task(a, F.col("_own")))
    among = F.transform(
        F.filter(up_to(F.col("rests")), lambda b: b != F.col("_own")),
        lambda b: task(-1 - F.least(b, F.col("_own")), F.greatest(b, F.col("_own"))))
    tasks = F.when(F.col("_is_main"), with_rests).otherwise(F.concat(with_mains, among))
    each = rows.select("key", "node", "component", "n", "_is_main", "_own", "mains", "rests", F.explode(tasks).alias("t"))
    total = of_component.agg(F.sum("m"), F.sum("bytes")).head()
    bins = 1 + max((total[0] or 0) // BLOCK, (total[1] or 0) // BLOCK_BYTES)
    large = (F.col("mains") > 1) | (F.col("rests") > 1)
    name = F.xxhash64("key", "t.a", "t.b")
    return each.select(
        F.when(large, name).otherwise(F.pmod("key", F.lit(bins))).alias("bin"), name.alias("task"),
        (F.col("t.a") == 0).alias("inside"), F.when(F.col("_is_main"), 0).otherwise(F.col("_own") + 1).alias("side"), "node", "component",
    )


def _across(open_: DataFrame, sketch: DataFrame, sets: DataFrame, alike: int) -> DataFrame:
    """Links (a, b) inside the buckets of ``open_`` (key, node, component, n) that join components."""
    def run(group: pa.Table) -> pa.Table:
        names, nodes, labels, sides = (group.column(name).to_numpy() for name in ("task", "node", "component", "side"))
        inside = group.column("inside").to_numpy(zero_copy_only=False)
        sets_, sketches_ = (group.column(name).combine_chunks() for name in ("hashes", "regs"))
        order = np.lexsort((nodes, sides, sides == 0, names))
        cuts = np.flatnonzero(np.diff(names[order])) + 1
        found = []
        for some in np.split(order, cuts):
            if labels[some].min() != labels[some].max():
                own = [np.frombuffer(sets_[i].as_buffer(), dtype="<u8") for i in some.tolist()]
                regs = np.array([np.frombuffer(sketches_[i].as_buffer(), dtype="<u2") for i in some.tolist()])
                found += joining_links(nodes[some], labels[some], own, regs, sides[some], bool(inside[some[0]]), alike)
        return pa.table({name: pa.array([x[i] for x in found], pa.int64()) for i, name in enumerate("ab")})

    # Tasks are dealt by number first; sets and sketches are joined to the copies of a row that are needed.
    dealt = dealt_across(open_).join(sketch.select("node", "regs"), "node").join(sets, "node")
    return dealt.groupBy("bin").applyInArrow(run, "a bigint, b bigint").distinct()


def near_groups(docs: DataFrame, words: int = WORDS, alike: int = ALIKE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    ``n_shingles`` is the size of the row's set; a text of fewer words has one
    shingle, a null text or one without words none, and is linked with nothing.
    ``component_id`` is the smallest doc_id among all documents that links lead
    to; ``kept`` marks it. Rows with one doc_id and one text are alike in
    everything, so all or none are kept. Rows without an id take part: their
    group goes by its smallest id, and where it has none its component is null
    and all its rows are kept. Other columns are not read.
    """
    return _grouped(docs, words, alike).drop("node")


def one_of_each(docs: DataFrame, words: int = WORDS, alike: int = ALIKE) -> DataFrame:
    """The rows of ``docs`` that ``near_groups`` marks as kept, with all their columns."""
    kept = _grouped(docs, words, alike).where("kept").select(F.col("node").alias("_node")).distinct()
    return docs.join(kept, _node() == F.col("_node"), "left_semi")


def _grouped(docs: DataFrame, words: int, alike: int) -> DataFrame:
    sketched = settle(sketches(docs, words), "sketches")
    classes = settle(
        sketched.where("n > 0").groupBy("sig").agg(
            F.min("node").alias("node"), F.min("doc_id").alias("first"), *(F.any_value(c).alias(c) for c in ("n", "regs"))
        ),
        "classes",
    )
    size = 2 * ROWS
    keys = F.array(*(F.xxhash64(F.lit(i), F.substring("regs", i * size + 1, size)) for i in range(BANDS)))
    banded = classes.select("node", F.explode(keys).alias("key"))
    shared = settle(
        banded.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("members")).where("members > 1"),
        "shared",
    )
    members = settle(banded.join(shared.select("key", "pivot"), "key"), "members")
    wanted = settle(members.select("node").distinct(), "wanted")
    sets = settle(_sets(docs, wanted, words), "sets")
    sketch = classes.select("node", "n", "regs")

    first = settle(members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = settle(_confirmed(settle(_likely(first, sketch, alike / 100), "likely"), sets, alike), "links")
    labels = components(links)

    labelled = settle(
        members.select("key", "node").join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node")),
        "labelled",
    )
    mixed = settle(
        labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high").select("key"),
        "mixed",
    )
    open_ = settle(labelled.join(mixed, "key").join(classes.select("node", "n"), "node"), "open")
    more = settle(_across(open_, sketch, sets, alike), "links")
    if not more.isEmpty():
        labels = components(links.union(more))

    of_class = settle(
        classes.select("sig", "node", "first").join(labels, "node", "left")
        .select("sig", "first", F.coalesce("component", "node").alias("component")),
        "of-class",
    )
    smallest = of_class.groupBy("component").agg(F.min("first").alias("smallest"))
    named = settle(of_class.join(smallest, "component").select("sig", "smallest"), "named")
    return (
        sketched.select("doc_id", "node", "n", "sig").join(named, "sig", "left")
        .select("doc_id", "node", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def query(spark, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
