"""Substring dedup: words inside long passages that occur elsewhere are removed.

Equal windows of words must meet in one shard, whatever documents they are from.
So each window goes by its anchor, the smallest hash among its runs of
``GRAM`` words; neighbouring windows with one anchor stay together as a segment.
Anchors that occur once in the corpus can't belong to a repeated window (a
segment in which its anchor occurs twice may repeat itself), and
equal segments are counted before anything else: those of two or more places are
repeated as they are, and only one copy of each goes on.

The distinct segments of the other anchors are dealt to shards. Each shard makes
a compressed FM-index of its segments (suffix order, BWT, wavelet matrix) and
streams the segments through it: backward search gives the matching statistics
of every place, and those that reach the window's length with two occurrences
are reported. An anchor with more than ``CROWD`` distinct segments, or more than
``CROWD_WORDS`` words in them (a very common line in many documents), isn't put in
one shard: its windows are dealt by their own hashes, which splits it evenly.

Segments and windows are told apart by 128 bits, their own hash and their anchor,
and rows by two 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.common import (
    mix, ngram_hashes, parts, pieces, powers, table, whole, word_hashes,
)
from martflow.llm.fmindex import FmIndex
from martflow.session import settle

WINDOW = 35
GRAM = 8
SHARD = 1 << 18  # words of a shard, about
CROWD = 1024  # distinct segments of one anchor in a shard, at most
CROWD_WORDS = 2 * SHARD  # and their words
MANY = 1 << 17  # windows of a shard from which equal ones are searched once
LONGEST = 1024  # windows of a segment


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the word sequences [start, end)."""
    up, down = powers(len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[:len(words)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def segments(words: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor, and number of the anchor's occurrences of each segment of a document."""
    if len(words) < window:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, np.empty(0, dtype=np.uint64), empty
    grams = ngram_hashes(words, gram)
    anchor = _sliding_least(grams, window - gram + 1)
    starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    counts = np.diff(np.concatenate([starts, [len(anchor)]]))
    if counts.max() > LONGEST:  # one anchor again and again, as in a repeated phrase
        pieces_ = -(-counts // LONGEST)
        inner = np.arange(pieces_.sum()) - np.repeat(np.cumsum(pieces_) - pieces_, pieces_)
        counts = np.minimum(np.repeat(counts, pieces_) - inner * LONGEST, LONGEST)
        starts = np.repeat(starts, pieces_) + inner * LONGEST
    places = np.argsort(grams, kind="stable")
    group = np.concatenate([[0], np.cumsum(np.diff(grams[places]) != 0)]) * len(grams)
    ordered = group + places  # by hash, then place
    own = group[np.searchsorted(grams[places], anchor[starts])]
    last = own + starts + counts - 1 + window - gram
    occurs = np.searchsorted(ordered, last, "right") - np.searchsorted(ordered, own + starts)
    return starts, counts, anchor[starts], occurs


def _row(text: str = "text") -> Column:
    """A row's identity: rows of one id and text get the same outcome."""
    return F.struct(F.xxhash64("doc_id", whole(text)).alias("a"), F.xxhash64(F.lit(1), whole(text), "doc_id").alias("b"))


ROW = "row struct<a:bigint,b:bigint>"


def _segmented(docs: DataFrame, window: int, gram: int, spans: Callable) -> DataFrame:
    def run(batches):
        for batch in pieces(batches, "text"):
            at, found = [], {"start": [], "windows": [], "anchor": [], "seg": [], "occurs": []}
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = word_hashes(text.encode())
                starts, counts, anchor, occurs = segments(words, window, gram)
                if len(starts):
                    at.append(np.full(len(starts), i))
                    seg = spans(words, starts, starts + counts + window - 1)
                    for name, x in (("start", starts), ("windows", counts), ("anchor", anchor.view(np.int64)),
                                    ("seg", seg.view(np.int64)), ("occurs", occurs)):
                        found[name].append(x)
            if at:
                columns = {
                    name: pa.array(np.concatenate(x), pa.int64() if name in ("anchor", "seg") else pa.int32())
                    for name, x in found.items()
                }
                rows = batch.column("row").take(pa.array(np.concatenate(at)))
                yield pa.RecordBatch.from_arrays([rows, *columns.values()], names=["row", *columns])

    return docs.mapInArrow(run, f"{ROW}, start int, windows int, anchor bigint, seg bigint, occurs int")


def _extracted(docs: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """For the asked segments (row, list of start, windows, anchor, seg, crowded): their words or their windows' hashes.

    A crowded segment gives a row per window with the window's ``hash``; others
    give one row with their word hashes.
    """
    def run(batches):
        for batch in pieces(batches, "text"):
            out = {"anchor": [], "seg": [], "offset": [], "hash": [], "crowded": [], "words": []}
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                words = word_hashes(text.encode())
                for one in wanted:
                    start, n = one["start"], one["windows"]
                    if one["crowded"]:
                        at = np.arange(start, start + n)
                        out["hash"] += span_hashes(words, at, at + window).view(np.int64).tolist()
                        out["offset"] += range(n)
                        out["anchor"] += [one["anchor"]] * n
                        out["seg"] += [one["seg"]] * n
                        out["crowded"] += [True] * n
                        out["words"] += [None] * n
                    else:
                        for name, x in (("anchor", one["anchor"]), ("seg", one["seg"]), ("offset", 0), ("hash", None), ("crowded", False),
                                        ("words", words[start:start + n + window - 1].tobytes())):
                            out[name].append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["anchor"], pa.int64()), pa.array(out["seg"], pa.int64()), pa.array(out["offset"], pa.int32()),
                 pa.array(out["hash"], pa.int64()), pa.array(out["crowded"], pa.bool_()), pa.array(out["words"], pa.binary())],
                names=list(out),
            )

    texts = docs.select("row", "text").join(asked.hint("shuffle_hash"), "row")
    return texts.mapInArrow(run, "anchor bigint, seg bigint, offset int, hash bigint, crowded boolean, words binary")


def _searched(window: int, many: int = MANY):
    """Repeated windows among one shard's segments, by its FM-index: (anchor, seg, offset) of each."""
    def run(rows: pa.Table) -> pa.Table:
        contents = [np.frombuffer(x.as_buffer(), dtype="<u8") for x in rows.column("words")]
        sizes = np.array([len(x) for x in contents])
        ends = np.cumsum(sizes + 1)  # each segment is followed by a separator
        starts = ends - sizes - 1
        text = np.zeros(ends[-1], dtype=np.int64)
        used = np.ones(len(text), dtype=bool)
        used[ends - 1] = False
        text[used] = np.unique(np.concatenate(contents), return_inverse=True)[1] + 1
        index = FmIndex(text, window)
        once = np.flatnonzero(rows.column("places").to_numpy() == 1)
        n = sizes[once] - window + 1
        which = np.repeat(once, n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first = starts[which] + offset
        if len(first) < many:
            long_enough = index.matched(text, first + window, window) >= window
        else:
            wide = np.lib.stride_tricks.sliding_window_view(text.astype(np.int32), window)[first]
            _, one, kind = np.unique(wide.view([("", np.void, 4 * window)]).ravel(), return_index=True, return_inverse=True)
            long_enough = (index.matched(text, first[one] + window, window) >= window)[kind]
        places = pa.array(which[long_enough])
        return pa.Table.from_arrays(
            [*(rows.column(name).combine_chunks().take(places) for name in ("anchor", "seg")), pa.array(offset[long_enough], pa.int32())],
            names=["anchor", "seg", "offset"],
        )

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, crowd: int = CROWD, crowd_words: int = CROWD_WORDS,
                   shard: int = SHARD, spans: Callable = span_hashes) -> DataFrame:
    """(row, spans): word ranges [from, to) of each row of ``docs`` (row, text) that repeated windows cover."""
    key = ["anchor", "seg"]
    runs = settle(_segmented(docs, window, gram, spans), "segments")
    anchors = settle(runs.groupBy("anchor").agg(F.sum("occurs").alias("n")).where("n > 1").select("anchor"), "anchors")
    shared = settle(runs.join(anchors, "anchor"), "shared")
    kinds = settle(
        shared.groupBy(*key).agg(
            F.count(F.lit(1)).alias("places"), F.min(F.struct("row", "start")).alias("at"), F.any_value("windows").alias("windows"),
            F.any_value("occurs").alias("occurs"),
        ),
        "kinds",
    )
    size = F.col("windows") + (window - 1)
    variety = settle(
        kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.max("occurs").alias("occurs"), F.sum(size).alias("words"))
        .where("kinds > 1 OR occurs > 1")
        .select("anchor", ((F.col("kinds") > crowd) | (F.col("words") > crowd_words)).alias("crowded")), "variety",
    )
    open_ = settle(
        kinds.join(variety, "anchor").select(*key, "places", "windows", "crowded", "at.row", "at.start"), "open"
    )
    asked = open_.groupBy("row").agg(F.collect_list(F.struct("start", "windows", *key, "crowded")).alias("wanted"))
    extracted = settle(_extracted(docs, settle(asked, "asked"), window), "extracted")
    places = open_.select(*key, "places", "crowded")

    total = open_.where("NOT crowded").agg(F.sum(size + 1)).head()[0] or 0
    shards = max(1 + total // shard, min(parts(docs), 1 + total // (shard // 16)))
    contents = (
        extracted.where("NOT crowded").select(*key, "words").dropDuplicates(key).join(places.where("NOT crowded").drop("crowded"), key)
        .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int"))
    )
    found = contents.groupBy("shard").applyInArrow(_searched(window), "anchor bigint, seg bigint, offset int")

    # Equal windows have equal anchors.
    windows = settle(
        extracted.where("crowded").select("hash", *key, "offset").distinct().join(places.where("crowded").drop("crowded"), key),
        "windows",
    )
    often = settle(windows.groupBy("hash", "anchor").agg(F.sum("places").alias("n")).where("n > 1").select("hash", "anchor"), "often")
    found = found.union(windows.where("places = 1").join(often, ["hash", "anchor"]).select(*key, "offset"))

    partly = found.select(*key, F.struct("offset", (F.col("offset") + window).alias("to")).alias("part"))
    wholly = kinds.where("places > 1").select(*key, F.struct(F.lit(0).alias("offset"), size.alias("to")).alias("part"))
    marks = settle(partly.union(wholly).groupBy(*key).agg(F.collect_set("part").alias("parts")), "marks")
    placed = shared.select("row", "start", *key).join(marks, key).select(
        "row", F.explode(F.transform("parts", lambda p: F.struct(
            (F.col("start") + p["offset"]).alias("from"), (F.col("start") + p["to"]).alias("to")))).alias("span"),
    )
    return placed.groupBy("row").agg(F.collect_set("span").alias("spans"))


_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def cut_passages(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """``docs`` without the words inside windows of ``window`` words that start anywhere else too.

    Adds ``n_words`` (before) and ``n_removed``; columns of those names are
    replaced, ``text`` is what is left, joined by single spaces, others pass
    through. All occurrences go, the first as well; windows are judged on the
    input. A null text has no words. Rows repeated as a whole are repeated
    passages.
    """
    rest = docs.drop("n_words", "n_removed").withColumn("text", whole())
    order = rest.columns
    rowed = rest.withColumn("_row", _row())
    spans = repeated_spans(rowed.select(F.col("_row").alias("row"), "text"), window, **options)
    joined = rowed.join(spans.select(F.col("row").alias("_row"), F.col("spans").alias("_spans")), "_row", "left").drop("_row")

    def run(batches):
        for batch in pieces(batches, "text"):
            texts, before, removed = [], [], []
            for text, cut in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist()):
                words = [x for x in _SPACE.split(text) if x]
                before.append(len(words))
                if cut:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(change, [x["from"] for x in cut], 1)
                    np.add.at(change, [x["to"] for x in cut], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
                removed.append(before[-1] - len(words))
                texts.append(" ".join(words))
            columns = {name: batch.column(name) for name in order} | {
                "text": pa.array(texts, pa.string()),
                "n_words": pa.array(before, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    added = [T.StructField(name, T.LongType()) for name in ("n_words", "n_removed")]
    return joined.select(*order, "_spans").mapInArrow(run, T.StructType([*rest.schema.fields, *added]))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cut_passages(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 34), ' ')) AS h
  FROM words, range(1, len(w) - 33) r(i)),
often AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT doc_id, p FROM windows JOIN often USING (h), range(i, i + 35) r(p)),
marked AS (
  SELECT doc_id, p, w[p] AS word FROM words, range(1, len(w) + 1) r(p)),
kept AS (
  SELECT m.doc_id, count(*) FILTER (c.p IS NOT NULL) AS n_removed,
    string_agg(m.word, ' ' ORDER BY m.p) FILTER (c.p IS NULL) AS kept
  FROM marked m LEFT JOIN covered c ON m.doc_id = c.doc_id AND m.p = c.p GROUP BY m.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""
