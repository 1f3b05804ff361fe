"""SimHash fingerprints of whole texts, with DataFrame functions only.

A text's terms are its pairs of neighbouring words (and its last word), weighted
by their length, so frequent terms vote often and long ones vote strongly. Every
term has a 128-bit hash; each bit of the fingerprint is what the weighted terms'
bits vote for. Two votes are counted in one 64-bit sum (a field of 32 bits
each), so 64 sums inside one generated aggregation make a fingerprint.

Block tables find all fingerprints within a Hamming radius: cut into radius + 1
blocks, two such fingerprints agree in one block at least, so each table is
keyed by one of the blocks and candidates are compared in full, inside the join.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.common import parts, table, whole
from martflow.session import settle

BITS = 128
_FIELDS = 0x0000000100000001
_NO_ID = -(1 << 63)  # stands for a null id, so that it comes last in descending order
_HEAVIEST = 3


def words_of(body: str) -> Column:
    return F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), "")


def terms(words: str) -> Column:
    """array<struct<h: bigint, w: bigint>>: hash and weight of every term of a column of words."""
    def term(word: Column, i: Column) -> Column:
        # Lengths are of the words' letters; weights stay small enough for the 32-bit fields.
        other = F.get(F.col(words), i + 1)
        size = F.length(word) + F.coalesce(F.length(other), F.lit(0))
        weight = F.least(F.lit(_HEAVIEST), 1 + F.floor(size / 8)).cast("long")
        return F.struct(F.xxhash64(word, other).alias("h"), weight.alias("w"))

    return F.transform(words, term)  # of a stored column, which is not split again per word


def votes(rows: DataFrame, keys: list[str], body: str) -> DataFrame:
    """Fingerprint halves ``a`` and ``b`` of ``body`` per distinct ``keys``; other columns go.

    ``keys`` name one row each. Rows partitioned by some of them are not moved.
    A text without words has the fingerprint 0.
    """
    each = rows.select(*keys, words_of(body).alias("_words"))
    each = each.select(*keys, F.explode_outer(terms("_words")).alias("_t")).select(
        *keys, F.col("_t.h").alias("_a"), F.xxhash64("_t.h").alias("_b"), F.col("_t.w").alias("_w")
    )
    half = BITS // 4
    sums = [
        F.sum(F.shiftrightunsigned(name, i).bitwiseAND(F.lit(_FIELDS)) * F.col("_w")).alias(f"{name}{i}")
        for name in ("_a", "_b") for i in range(half)
    ]
    counted = each.groupBy(*keys).agg(F.sum("_w").alias("_all"), *sums)

    def bits(name: str) -> Column:
        def vote(i: int) -> Column:
            pair = F.col(f"{name}{i % half}")
            field = F.shiftrightunsigned(pair, 32) if i >= half else pair.bitwiseAND(F.lit(0xFFFFFFFF))
            return F.when(2 * field > F.col("_all"), F.lit(1 << i if i < 63 else _NO_ID)).otherwise(F.lit(0).cast("long"))
        return reduce(Column.bitwiseOR, [vote(i) for i in range(2 * half)])

    return counted.select(*keys, bits("_a").alias("a"), bits("_b").alias("b"))


def text_of(a: Column, b: Column) -> Column:
    """The fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def distance(one: str, other: str) -> Column:
    """Bits in which the fingerprints of two structs (a, b) differ."""
    return sum(F.bit_count(F.col(f"{one}.{x}").bitwiseXOR(F.col(f"{other}.{x}"))) for x in "ab")


def likeness(one: str, other: str) -> Column:
    return 1 - distance(one, other) / BITS


# ---- search ------------------------------------------------------------------------------------

def _blocks(radius: int) -> list[tuple[str, int, int]]:
    """radius + 1 blocks of the fingerprint: half, shift, width."""
    if not 0 <= radius < BITS:
        raise ValueError(f"a radius is 0 to {BITS - 1}")
    found, of_a = [], (radius + 2) // 2
    for half, n in (("a", of_a), ("b", radius + 1 - of_a)):
        edges = [64 * i // n for i in range(n + 1)] if n else []
        found += [(half, low, high - low) for low, high in zip(edges, edges[1:])]
    return found


def block_tables(prints: DataFrame, radius: int) -> DataFrame:
    """(t, block, print): each distinct fingerprint in every table. ``prints`` has halves a and b."""
    keys = [
        F.struct(
            F.lit(t).alias("t"),
            F.shiftrightunsigned(half, shift).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1)).alias("block"),
        )
        for t, (half, shift, width) in enumerate(_blocks(radius))
    ]
    return (
        prints.select("a", "b").distinct()
        .select(F.struct("a", "b").alias("print"), F.explode(F.array(*keys)).alias("_k"))
        .select("print", "_k.*")
    )


def within(queries: DataFrame, prints: DataFrame, radius: int = 3) -> DataFrame:
    """(query, found, distance): all distinct fingerprints of ``prints`` within ``radius`` of each of ``queries``.

    Both have halves a and b. Copies are one fingerprint here; join the result
    to their rows by it. A pair that agrees in several blocks is given by the
    first of them alone, and distances are compared inside the join, so that
    nothing but the pairs found leaves it. Spark can split a frequent block.
    """
    asked = block_tables(queries, radius).select(F.col("t").alias("_t"), F.col("block").alias("_block"), F.col("print").alias("query"))
    stored = block_tables(prints, radius).withColumnRenamed("print", "found")
    earlier = F.lit(False)
    for t, (half, shift, width) in enumerate(_blocks(radius)):
        mask = F.lit((1 << width) - 1 if width < 64 else -1)
        differing = F.shiftrightunsigned(F.col(f"query.{half}").bitwiseXOR(F.col(f"found.{half}")), shift).bitwiseAND(mask)
        earlier = earlier | ((F.col("t") > t) & (differing == 0))
    near = (F.col("t") == F.col("_t")) & (F.col("block") == F.col("_block")) & (distance("query", "found") <= radius) & ~earlier
    return asked.join(stored, near).select("query", "found", distance("query", "found").alias("distance"))


# ---- documents and their edited texts ----------------------------------------------------------

def _range_of(name: str, cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` lie below a value, by blocks of cuts and then inside one block."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    # Arrays that Spark folds to one literal each, however long they are.
    numbers = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    below = lambda values: F.size(F.filter(values, lambda x: x < F.col(name)))
    tops = cuts[step - 1::step]
    skipped = step * below(numbers(tops)) if tops else F.lit(0)
    return skipped + below(F.slice(numbers(cuts), skipped + 1, step))


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """(range, pos, doc_id, ghost, text, next): each text with that of the next document in descending id order.

    Ids are dealt to ranges at their quantiles, and the first text of each range
    is also put, as a ghost row, behind the last row of the range above it (the
    very first one behind the last range). So the next row is always in the same
    range, and texts are shuffled once. Broadcast is one id per range.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    read = read.withColumn("_id", F.coalesce("doc_id", F.lit(_NO_ID)))
    cuts = read.agg(F.percentile_approx("_id", [i / ranges for i in range(1, ranges)], 10 * ranges)).head()[0] if ranges > 1 else None
    ranged = read.withColumn("range", _range_of("_id", sorted(set(cuts or []))))
    firsts = ranged.groupBy("range").agg(F.max("_id").alias("_id"))  # a row per range
    above = F.lead("range").over(Window.orderBy("range"))
    heads = firsts.select("_id", F.coalesce(above, F.min("range").over(Window.partitionBy())).alias("_to"))
    ghosts = (
        ranged.join(F.broadcast(heads), "_id")
        .groupBy("_id", "_to").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .select(F.lit(None).cast("long").alias("doc_id"), "text", "_id", F.col("_to").alias("range"), F.lit(True).alias("ghost"))
    )
    order = Window.partitionBy("range").orderBy("ghost", F.col("_id").desc(), F.xxhash64("text"))
    return ranged.withColumn("ghost", F.lit(False)).unionByName(ghosts).select(
        "range", F.row_number().over(order).alias("pos"), "doc_id", "ghost", "text", F.lead("text").over(order).alias("next")
    )


def halves(text: str) -> tuple[Column, Column]:
    """The halves a and b of a fingerprint's 32 hexadecimal digits."""
    return tuple(F.conv(F.substring(text, at, 16), 16, -10).cast("long") for at in (1, 17))


def edited_prints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per document: n_chars, the SHA-256 and fingerprint of its edited text, and likenesses.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many of the next document. A null text is empty. Rows with one
    doc_id follow each other by a hash of their text, null ids come last, and
    the next document of the only one is itself. Other columns are not read.
    """
    ranges = ranges or 2 * parts(docs)
    size = F.char_length("text").cast("long")
    rows = with_next(docs, ranges).withColumn("n_chars", size).withColumn("_half", F.floor(F.col("n_chars") / 2).cast("int"))
    rows = rows.withColumn("_edited", F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - F.col("_half")),
        F.substring(F.coalesce("next", F.lit("")), F.lit(1), F.col("_half")),
    )).withColumn("edited_sha256", F.sha2(F.col("_edited").cast("binary"), 256))
    keys = ["range", "pos", "doc_id", "ghost", "n_chars", "edited_sha256", "which"]
    both = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("body")),
                   F.struct(F.lit(1).alias("which"), F.col("_edited").alias("body")))
    each = rows.select(*keys[:-1], F.explode(both).alias("_v")).select(*keys[:-1], "_v.*").where("which = 0 OR NOT ghost")
    order = Window.partitionBy("range", "pos").orderBy("which")
    following = Window.partitionBy("range").orderBy("pos", "which")
    own = F.struct("a", "b")
    prints = votes(each, keys, "body").select(*keys, own.alias("print"))
    return (
        prints.withColumn("edited", F.lead("print").over(order))
        .where("which = 0").withColumn("next", F.lead("print").over(following))
        .where("NOT ghost")
        .select(
            "doc_id", "n_chars", "edited_sha256", text_of(F.col("print.a"), F.col("print.b")).alias("fingerprint"),
            text_of(F.col("edited.a"), F.col("edited.b")).alias("edited_fingerprint"),
            likeness("print", "edited").alias("near_edited"), likeness("print", "next").alias("near_next"),
        )
    )


def with_neighbours(prints: DataFrame, asked: Column, radius: int = 3) -> DataFrame:
    """``prints`` with ``n_near``: other distinct fingerprints of the table within ``radius`` of each asked row's, null for other rows."""
    a, b = halves("fingerprint")
    every = prints.select("fingerprint", asked.alias("_asked")).groupBy("fingerprint").agg(F.bool_or("_asked").alias("_asked"))
    every = settle(every.select("fingerprint", a.alias("a"), b.alias("b"), "_asked"), "fingerprints")
    found = within(every.where("_asked"), every, radius).where("distance > 0 OR query <> found")
    counts = found.groupBy("query").agg(F.count("*").alias("_n")).select(text_of(F.col("query.a"), F.col("query.b")).alias("_print"), "_n")
    # Rows that weren't asked for have nothing to be joined by, and would meet in one task.
    own = prints.where(asked).join(counts, F.col("fingerprint") == F.col("_print"), "left")
    own = own.select(*prints.columns, F.coalesce("_n", F.lit(0)).cast("long").alias("n_near"))
    return own.unionByName(prints.where(~asked).withColumn("n_near", F.lit(None).cast("long")))


def query(spark, sf_dir: str) -> DataFrame:
    prints = settle(edited_prints(table(spark, sf_dir, "documents").select("doc_id", "text")), "prints")
    return with_neighbours(prints, F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False)))
