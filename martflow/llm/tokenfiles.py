"""Token ids in flat binary files.

Documents are dealt to tasks by ranges of doc_id and sorted there. Each task
encodes its texts and writes three flat little-endian files: the ids (16 bits
if the vocabulary fits, else 32), a 64-bit offset where each document begins and
where the last one ends, and the 64-bit document ids. File names are unique to
the attempt; only those of committed tasks get into the manifest, so a lost
executor or a second attempt leaves no wrong data. The manifest has a row per
file; the prefix sums of its counts are the files' bases, and base plus offset is
a document's place in the whole. Readers map the files into memory.

The files lie under a path that all executors share. It is opened as a local
(mounted) path or by a scheme that pyarrow knows; only local ones are mapped.
"""

from __future__ import annotations

import gc
import re
import uuid
import zlib
from array import array
from collections.abc import Callable
from pathlib import PurePosixPath

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martflow.llm.common import pieces, read_bytes, table, whole
from martflow.session import settle, shared_dir

END = 2
KEPT_BYTES = 96 << 20  # of a worker's table of known words and stems, of which it has two at most
_LONG_WORD = 48
_ENTRY = 150  # bytes of an entry besides its letters and ids
_SIGNS = ".,;:!?#$%&*|()<>[]{}=+/\\_-"  # no apostrophe: with letters it is a part of its own
_NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id, which comes last
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
_WIDE = re.compile("[^\x00-\xff]")  # beyond them, lower case may depend on a letter's neighbours
_CODERS: dict = {}


class Coder:
    """A tokenizer that remembers the ids of words and of their stems.

    The vocabulary lowers its text, and its own splitting drops white space and
    keeps runs of letters apart from runs of signs. So the ids of a text are
    those of its parts between spaces and newlines, one after the other, and a
    part's are those of its stem and of the signs behind it, where the stem's last
    character still is a letter or number once the vocabulary has normalised it
    (a letter that becomes base and mark joins the signs). The stem may be lowered
    where it is ASCII. Only words not met before are taken apart, and only stems not met before
    go to the tokenizer.

    Strings of special tokens are found in the text as it is, before all that, and
    have their own ids; what only becomes such a string when lowered is ordinary.
    """

    def __init__(self, vocabulary: bytes, kept: int = KEPT_BYTES):
        self.tokenizer, self.ordinary = (Tokenizer.from_str(vocabulary.decode()) for _ in range(2))
        for each in (self.tokenizer, self.ordinary):
            each.no_padding()
            each.no_truncation()
        self.ordinary.encode_special_tokens = True  # lowered stems hold no special tokens
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.kept = kept
        self.apart: dict[str, bool] = {}
        added = self.tokenizer.get_added_tokens_decoder().items()
        self.special = {x.content: np.array([i], dtype=self.kind).tobytes() for i, x in added}
        self.known = _Known({"": b"", **self.special}, self.learn)
        self.pieces = self.ordinary.model.tokenize
        self.plain, self.letters = self._plain_letters()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, longest_first)) or "(?!)")

    def splits(self, last: str) -> bool:
        """Whether the vocabulary takes signs behind the character ``last`` apart from it."""
        if last not in self.apart:
            normal = self.tokenizer.normalizer.normalize_str(last + _SIGNS)
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
            self.apart[last] = last.isalnum() and pieces[-1][0] == _SIGNS
        return self.apart[last]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as flat integers."""
        known = self.known
        if known.bytes > self.kept:
            known.age()
        split = [self._lowered(text).replace("\n", " ").split(" ") for text in texts]
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def _lowered(self, text: str) -> str:
        """The text with spaces around special tokens; in lower case if that is all its letters' own, and makes no special token."""
        if not _WIDE.search(text):
            low = text.lower()
            if not self.marks.search(low):
                return low
        return self.marks.sub(r" \g<0> ", text)

    def learn(self, word: str) -> bytes:
        """The ids of a word not met before: of its stem in lower case and of the signs behind it, or of itself."""
        stem = word.rstrip(_SIGNS)
        if stem is not word and (not stem or not (self.apart.get(stem[-1]) or self.splits(stem[-1]))):
            stem = word
        low = stem.lower() if stem.isascii() else stem
        if low != word:
            signs = word[len(low):]
            return self.known[low] + self.known[signs] if signs else self.known[low]
        if self.plain(word):
            found = [piece.id for piece in self.pieces(word if word.isascii() else word.translate(self.letters))]
        else:
            found = self.ordinary.encode(word, add_special_tokens=False).ids
        return array(self.kind.char, found).tobytes()

    def _plain_letters(self) -> tuple[Callable, dict[int, str]]:
        """Which stems are lower-case letters that the vocabulary neither changes nor takes apart, and how it spells their bytes."""
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normal is None or split is None or normal.normalize_str(_LETTERS) != _LETTERS:
            return re.compile("(?!)").match, {}
        spelled = {c: split.pre_tokenize_str(c) for c in _LETTERS}
        together = split.pre_tokenize_str(_LETTERS)
        if len(together) != 1 or together[0][0] != "".join(x[0][0] for x in spelled.values()):
            return re.compile("(?!)").match, {}
        return re.compile(f"[{_LETTERS}]+").fullmatch, {ord(c): x[0][0] for c, x in spelled.items()}


class _Known(dict):
    """Ids by word. A word that isn't there is learned, and kept unless it is long.

    A full table becomes the older one, and its words come back as they are met
    again; those that weren't met since are gone with the next change.
    """

    def __init__(self, always: dict[str, bytes], learn: Callable[[str], bytes]):
        super().__init__(always)
        self.always, self.learn, self.bytes = always, learn, 0
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.learn(word)
        if len(word) <= _LONG_WORD:
            self[word] = ids
            self.bytes += _ENTRY + len(word) + len(ids)
        return ids

    def age(self) -> None:
        self.older = dict(self)
        self.clear()
        self.update(self.always)
        self.bytes = 0


def coder(vocabulary: bytes) -> Coder:
    if vocabulary not in _CODERS:
        _CODERS[vocabulary] = Coder(vocabulary)
    return _CODERS[vocabulary]


def _without_collector(call, *given):
    """The result of a call that makes many objects and no cycles, which the collector would look through again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        return call(*given)
    finally:
        if was:
            gc.enable()


def _opened(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if "://" in root or root.startswith("file:"):
        return pafs.FileSystem.from_uri(root.replace("file:/", "file:///", 1) if "://" not in root else root)
    return pafs.LocalFileSystem(), root


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(int(_NO_ID)).to_numpy()


MANIFEST = "part int, name string, width int, n_docs bigint, n_ids bigint"


def write(docs: DataFrame, root: str, vocabulary: str, end: int = END) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) below ``root``; returns the manifest with each file's ``base``.

    Documents come in ascending doc_id, null ids last; rows with one id by a hash
    of their text. Each has the id ``end`` after its own ids, so a null or empty
    text has that one. Without documents the manifest is empty. Other columns
    are not read.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(read_bytes(spark, vocabulary))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
    )

    def run(batches):
        made = coder(sent.value)
        last = np.array([end], dtype=made.kind).tobytes()
        files, base = _opened(root)
        files.create_dir(base)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        path = str(PurePosixPath(base) / name)
        n_docs = n_ids = 0
        with (
            files.open_output_stream(f"{path}.bin") as ids, files.open_output_stream(f"{path}.off") as offsets,
            files.open_output_stream(f"{path}.doc") as doc_ids,
        ):
            offsets.write(np.zeros(1, dtype="<u8").tobytes())
            for batch in pieces(batches, "text", 2 << 20):
                found = [x + last for x in _without_collector(made.encode, batch.column("text").to_pylist())]
                ends = n_ids + np.cumsum([len(x) for x in found]) // made.kind.itemsize
                ids.write(b"".join(found))
                offsets.write(ends.astype("<u8").tobytes())
                doc_ids.write(_ids(batch).astype("<i8").tobytes())
                n_docs, n_ids = n_docs + len(found), int(ends[-1])
        if n_docs:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "name": [name],
                "width": pa.array([made.kind.itemsize], pa.int32()), "n_docs": [n_docs], "n_ids": [n_ids],
            })
        else:
            for kind in ("bin", "off", "doc"):
                files.delete_file(f"{path}.{kind}")

    manifest = settle(dealt.mapInArrow(run, MANIFEST), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _mapped(files: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
    if files.get_file_info(path).size == 0:
        return np.empty(0, dtype=kind)
    if isinstance(files, pafs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r")
    with files.open_input_file(path) as opened:
        return np.frombuffer(opened.read(), dtype=kind)


def read(manifest: DataFrame, root: str, with_ids: bool = True, rows: int = 1000) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the files alone.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is taken
    over the ids as little-endian 32-bit integers.
    """
    def run(batches):
        files, base = _opened(root)
        for entry in (x for batch in batches for x in batch.to_pylist()):
            path = str(PurePosixPath(base) / entry["name"])
            ids = _mapped(files, f"{path}.bin", f"<u{entry['width']}")
            offsets = _mapped(files, f"{path}.off", "<u8").astype(np.int64)
            doc_ids = _mapped(files, f"{path}.doc", "<i8")
            if len(doc_ids) != entry["n_docs"] or len(ids) != entry["n_ids"]:
                raise ValueError(f"{path} isn't what the manifest says")
            for at in range(0, len(doc_ids), rows):
                starts, ends = offsets[at:at + rows + 1][:-1], offsets[at + 1:at + rows + 1]
                found = [ids[a:b].astype("<u4") for a, b in zip(starts, ends)]
                doc = doc_ids[at:at + rows]
                columns = {
                    "doc_id": pa.array(np.asarray(doc), mask=np.asarray(doc == _NO_ID)),
                    "start": pa.array(starts + entry["base"]), "n_tokens": pa.array(ends - starts),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in found], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(found, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    kinds = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    dealt = settle(manifest, "manifest")
    return dealt.repartition(max(1, dealt.count()), "part").mapInArrow(run, kinds)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    root = shared_dir(spark, "tokens")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read(write(docs, root, public_tokenizers.path("word_bpe_49k.json")), root, with_ids=False)
