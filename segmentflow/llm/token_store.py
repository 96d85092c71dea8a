"""Token-id output (operator 2): Arrow IPC files whose record batches hold
equal-length sequences as fixed-size lists.

Each file is a sequence of record batches of ``BATCH`` rows.  A row has

* ``tokens``: fixed_size_list<uint16 or uint32>[length], the ids;
* ``mask``: fixed_size_list<uint8>[length / 8], packed bits: bit ``i % 8`` of
  byte ``i // 8`` is 1 for an id, 0 for padding (bytes, as NumPy can't view
  Arrow's booleans; a byte for each id would take the disk of half the ids);
* ``ends``: fixed_size_list<bool>[length], true at the end id of a document;
* ``docs``: list<struct<doc_id, at, n>>, the documents that start in it.

Documents follow each other in ascending id, an end id after each, across
row borders; only a file's last row is padded.  The footer gives the place
of every batch, so row ``i`` is found by arithmetic, and an uncompressed
file that is memory-mapped gives its token and mask matrices without a
copy (``SequenceFile``).

Spark orders the documents by range of id (rows of one id are spread by a
hash of their text, so a repeated id doesn't fill one task), every task
encodes its range and writes files of at most ``FILE_TOKENS`` ids beyond
the last document.  A file gets its name when it is complete, with a name
of its own for each attempt, and only files in the manifest count: a lost
or repeated task leaves no trace.
"""

from __future__ import annotations

import re
import uuid
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segmentflow.llm.common import bounded_batches, forget_kept, give_back, scratch_path, staged, text_slices, vocabulary_bytes, worker_kept

LENGTH = 2048
BATCH = 64
FILE_TOKENS = 16 << 20
READ_ROWS = 10_000
CACHE_ENTRIES = 300_000
MARKS = ".,!?;:%&$*#"
# White space for Python's split alone, not for the library.
CONTROL = re.compile(r"[\x1c-\x1f]").search
# Letters that stay one word of letters in lower case and under NFC.
LATIN = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
# The vocabulary file's own split (endings, letters, a digit,
# other marks) for lower-case texts of Latin-1 characters, and how it is
# written in the file.
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
SPACE, LETTER, DIGIT, OTHER = range(4)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[*range(9, 14), 32, 0x85, 0xA0]] = SPACE
CLASS[[*range(97, 123), 0xAA, 0xB5, 0xBA, *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = LETTER
CLASS[[*range(48, 58), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = DIGIT
MANIFEST = "part BIGINT, roll BIGINT, path STRING, n_docs BIGINT, n_ids BIGINT"


def open_fs(path: str):
    """The file system and path of a folder URI (a plain path is local)."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def schema(length: int, kind: pa.DataType) -> pa.Schema:
    docs = pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int32()), ("n", pa.int64())]))
    return pa.schema([("tokens", pa.list_(kind, length)), ("mask", pa.list_(pa.uint8(), length // 8)), ("ends", pa.list_(pa.bool_(), length)), ("docs", docs)])


def cut_units(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The units of lower-case Latin-1 texts, one after the other (Latin-1
    bytes), and how many each text has: runs of letters, single digits, runs
    of other marks, and the endings of ``SPLIT``, which take an apostrophe
    that begins a unit."""
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    data = np.frombuffer(" ".join([*texts, "  "]).encode("latin-1"), np.uint8)
    kind = CLASS[data]
    before = np.concatenate([[SPACE], kind[:-1]])
    start = ((kind != before) | (kind == DIGIT)) & (kind != SPACE)
    at = np.flatnonzero((data == 39) & (before != OTHER))
    if len(at):
        one, two = data[at + 1], data[at + 2]
        long = (two == 101) & ((one == 114) | (one == 118)) | (one == 108) & (two == 108)  # 're 've 'll
        length = np.where(np.isin(one, np.frombuffer(b"stmd", np.uint8)), 2, np.where(long, 3, 0))
        at, length = at[length > 0], length[length > 0]
        start[at + 1] = False
        start[at + length] = kind[at + length] != SPACE
    kept = kind != SPACE
    places = np.flatnonzero(start)
    offsets = np.append((np.cumsum(kept) - kept)[places], kept.sum()).astype(np.int32)
    units = pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(data[kept])])
    return units, np.diff(np.searchsorted(places, np.concatenate([[0], np.cumsum(size)])))


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices of runs of ``size`` from ``first``, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Tokenizer:
    """Ids of whole texts by the tokenizers library, as raw integers.

    The library lower-cases a text, cuts it into units and drops white
    space, and never joins units, so a text's ids are those of its units in
    turn; repeated units are encoded once (a bounded table), and many go
    into one call: each ends with a token that closes a word.  Texts with characters beyond Latin-1 or an added
    token, and vocabularies with another split, are cut at white space only, and the library does
    the rest; there plain Latin words that differ only by case or closing
    marks share one call."""

    def __init__(self, data: bytes, kind: np.dtype):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library, self.kind = Library.from_str(data.decode()), kind
        file = json.loads(data)
        model = file["model"]
        steps = [n.get("type") for n in (file.get("normalizer") or {}).get("normalizers", [])]
        cuts = (file.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.known_split = steps == ["NFC", "Replace", "Lowercase"] and cuts[0].get("pattern", {}).get("Regex") == SPLIT and cuts[0].get("invert") is True
        suffix = model.get("end_of_word_suffix")
        self.closes = np.zeros(max(model["vocab"].values()) + 1, bool)
        if suffix:
            self.closes[[i for t, i in model["vocab"].items() if t.endswith(suffix)]] = True
        # Added tokens are found before a text is cut.
        self.added = [t["content"].lower() for t in file.get("added_tokens", [])]
        # Units: place of each in ``ids``, where each ends, ids in turn.
        self.index: dict[bytes, int] = {}
        self.ends, self.ids = np.zeros(1, np.int64), np.zeros(0, kind)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}  # bounded: up to three of MARKS

    def _cut(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        raw, at = ids.astype(self.kind).tobytes(), (ends * self.kind.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *at], at, strict=False)]

    def _separate(self, words: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            coded = self.library.encode(part, is_pretokenized=True, add_special_tokens=False)
            size = np.bincount(np.array(coded.word_ids, np.int64), minlength=len(part))
            out += self._cut(np.array(coded.ids, np.int64), np.cumsum(size))
        return out

    def _joined(self, words: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(words), 512):
            part = words[at : at + 512]
            ids = np.array(self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.flatnonzero(self.closes[ids]) + 1 if len(ids) and ids.max() < len(self.closes) else ids[:0]
            out += self._cut(ids, ends) if len(ends) == len(part) and ends[-1] == len(ids) else self._separate(part)
        return out

    def _learn(self, words: list[str]) -> None:
        split, other = [], []
        for w in words:
            core = w.rstrip(MARKS)
            tail = w[len(core) :]
            if len(tail) > 3 or not LATIN(core):
                other.append(w)
                continue
            if tail not in self.marks:
                self.marks[tail] = self._separate([tail])[0]
            split.append((w, core.lower(), tail))
        if len(self.cores) > CACHE_ENTRIES:
            self.cores = {}
        new = [w for w in {core for _, core, _ in split} if w not in self.cores]
        self.cores.update(zip(new, self._joined(new), strict=True))
        cores, marks = self.cores, self.marks
        self.young.update((w, cores[core] + marks[tail]) for w, core, tail in split)
        self.young.update(zip(other, self._separate(other), strict=True))

    def _plain(self, text: str | None) -> str | None:
        """The lower-case text if it is cut into units, None if into words."""
        if not text:
            return ""
        if not self.known_split:
            return None
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return None
        lower = text.lower()
        return None if any(a in lower for a in self.added) else lower

    def _number(self, units: list[bytes]) -> np.ndarray:
        """The place of each unit in ``ids``; new ones are encoded.  When
        the table is full it restarts with the units of this call."""
        if len(self.index) > CACHE_ENTRIES:
            kept = [u for u in units if u in self.index]
            at = np.fromiter(map(self.index.__getitem__, kept), np.int64, len(kept))
            size = self.ends[at + 1] - self.ends[at]
            self.ids = self.ids[_spread(self.ends[at], size)]
            self.ends = np.concatenate([[0], np.cumsum(size)])
            self.index = dict(zip(kept, range(len(kept)), strict=True))
        new = [u for u in units if u not in self.index]
        if new:
            raw = self._joined([u.decode("latin-1") for u in new])
            size = np.fromiter(map(len, raw), np.int64, len(raw)) // self.kind.itemsize
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(raw), self.kind)])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size)])
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        return np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))

    def _by_units(self, texts: list[str]) -> list[bytes]:
        """Ids of lower-case Latin-1 texts: cut and numbered as arrays, only
        the different units of a call reach Python."""
        units, counts = cut_units(texts)
        coded = units.dictionary_encode()
        at = self._number(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        size = self.ends[at + 1] - self.ends[at]
        raw = self.ids[_spread(self.ends[at], size)].tobytes()
        stop = np.concatenate([[0], np.cumsum(size)])[np.cumsum(counts)] * self.kind.itemsize
        stop = stop.tolist()
        return [raw[a:b] for a, b in zip([0, *stop], stop, strict=False)]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        plain = [self._plain(t) for t in texts]
        by_units = iter(self._by_units([t for t in plain if t is not None]))
        if len(self.young) > CACHE_ENTRIES:
            self.old, self.young = self.young, {}
        cuts = [(t.split(" ") if CONTROL(t) else t.split()) if p is None else [] for t, p in zip(texts, plain, strict=True)]
        young, old = self.young, self.old
        new = {w for w in set().union(*cuts) if w not in young}
        young.update((w, old[w]) for w in new if w in old)
        self._learn([w for w in new if w not in young])
        get = young.__getitem__
        return [b"".join(map(get, c)) if p is None else next(by_units) for p, c in zip(plain, cuts, strict=True)]


class Writer:
    """Packs (doc_id, ids) into rows and files; ``done`` lists the files."""

    def __init__(self, folder: str, part: int, length: int, kind: np.dtype):
        self.fs, self.root = open_fs(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.part, self.length, self.kind = part, length, kind
        self.schema = schema(length, pa.from_numpy_dtype(kind))
        self.done: list[tuple] = []
        self.sink = None

    def _open(self) -> None:
        self.name = f"{self.root}/part-{self.part:06d}-{len(self.done):04d}-{uuid.uuid4().hex}.arrow"
        self.raw = self.fs.open_output_stream(self.name + ".open")
        self.sink = pa.ipc.new_file(self.raw, self.schema)
        self.pending: list[bytes] = []  # ids not written yet
        self.size = 0  # how many
        self.n_docs = self.n_ids = 0
        self.docs: list[tuple[int, int, int]] = []  # id, place from the first pending id, n
        self.ends: list[int] = []

    def add(self, doc_id: int, ids: bytes) -> None:
        if self.sink is None:
            self._open()
        n = len(ids) // self.kind.itemsize
        self.docs.append((doc_id, self.size, n))
        self.ends.append(self.size + n - 1)
        self.pending.append(ids)
        self.size += n
        self.n_docs, self.n_ids = self.n_docs + 1, self.n_ids + n
        if self.size >= self.length * BATCH:
            self._flush(self.size // (self.length * BATCH) * BATCH)
        if self.n_ids >= FILE_TOKENS:
            self.close()

    def _flush(self, rows: int) -> None:
        count = rows * self.length
        ids = np.frombuffer(b"".join(self.pending), self.kind)
        tokens = np.zeros(count, self.kind)
        used = min(count, len(ids))
        tokens[:used] = ids[:used]
        mask = np.packbits(np.arange(count) < used, bitorder="little")
        ends = np.zeros(count, bool)
        ends[[e for e in self.ends if e < count]] = True
        starting = [d for d in self.docs if d[1] < count]
        row = np.array([d[1] // self.length for d in starting], np.int64)
        offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
        struct = pa.StructArray.from_arrays(
            [pa.array([d[0] for d in starting], pa.int64()), pa.array([d[1] % self.length for d in starting], pa.int32()), pa.array([d[2] for d in starting], pa.int64())],
            fields=list(self.schema.field("docs").type.value_type),
        )
        fixed = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x), len(x) // rows)
        whole = pa.RecordBatch.from_arrays([fixed(tokens), fixed(mask), fixed(ends), pa.ListArray.from_arrays(pa.array(offsets), struct)], schema=self.schema)
        for at in range(0, rows, BATCH):
            self.sink.write_batch(whole.slice(at, BATCH))
        self.pending = [ids[used:].tobytes()]
        self.size -= used
        self.docs = [(i, at - count, n) for i, at, n in self.docs[len(starting) :]]
        self.ends = [e - count for e in self.ends if e >= count]

    def close(self) -> None:
        if self.sink is None:
            return
        if self.size:
            self._flush(-(-self.size // self.length))
        self.sink.close()
        self.raw.close()
        self.fs.move(self.name + ".open", self.name)
        self.done.append((self.part, len(self.done), self.name, self.n_docs, self.n_ids))
        self.sink = None


class SequenceFile:
    """Random access to a written file: ``tokens(i)`` and ``mask(i)`` of the
    i-th sequence, and a batch's token matrix, without a copy."""

    def __init__(self, folder: str, name: str):
        fs, _ = open_fs(folder)
        local = type(fs).__name__ == "LocalFileSystem"
        self.file = pa.ipc.open_file(pa.memory_map(name) if local else fs.open_input_file(name))

    def _matrix(self, batch: pa.RecordBatch, name: str) -> np.ndarray:
        column = batch.column(name)
        return column.flatten().to_numpy(zero_copy_only=True).reshape(len(column), -1)

    def batch(self, k: int) -> tuple[np.ndarray, pa.RecordBatch]:
        b = self.file.get_batch(k)
        return self._matrix(b, "tokens"), b

    def tokens(self, i: int) -> np.ndarray:
        return self.batch(i // BATCH)[0][i % BATCH]

    def mask(self, i: int) -> np.ndarray:
        """A view of the packed bits; ``np.unpackbits(..., bitorder="little")``
        gives one for each id."""
        return self._matrix(self.file.get_batch(i // BATCH), "mask")[i % BATCH]

    def documents(self):
        """(doc_id, ids) of each document in order; one document's ids and
        one batch are held at a time."""
        open_doc, have = None, []
        for k in range(self.file.num_record_batches):
            tokens, b = self.batch(k)
            flat = tokens.ravel()
            docs = b.column("docs")
            starts = np.repeat(np.arange(len(docs)), docs.value_lengths().to_numpy()) * tokens.shape[1]
            struct = docs.flatten()
            places = starts + struct.field("at").to_numpy() if len(struct) else starts
            if open_doc is not None:
                need = open_doc[1] - sum(map(len, have))
                have.append(flat[:need])
                if need > len(flat):
                    continue
                yield open_doc[0], np.concatenate(have)
                open_doc, have = None, []
            for doc_id, at, n in zip(struct.field("doc_id").to_pylist(), places.tolist(), struct.field("n").to_pylist(), strict=True):
                if at + n <= len(flat):
                    yield doc_id, flat[at : at + n]
                else:
                    open_doc, have = (doc_id, n), [flat[at:]]


def write_sequences(
    df: DataFrame,
    tokenizer_path: str,
    end_id: int,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
) -> DataFrame:
    """Encode and write every document; returns the manifest (one row per
    file, ``path``, ``n_docs``, ``n_ids``, ``start``: ids of all documents
    before the file).

    A null text counts as empty and is the end id alone.  Null ids are
    written first, as id -1.  Rows of equal id stand together, each a
    document of its own.  An empty table gives an empty manifest.  Other
    columns are not read.  Texts are encoded whole.  ``length`` is a multiple
    of 8."""
    if length % 8:
        raise ValueError("length must be a multiple of 8")
    spark = df.sparkSession
    data = vocabulary_bytes(tokenizer_path)
    import json

    vocab = json.loads(data)
    top = max([*vocab["model"]["vocab"].values(), *(t["id"] for t in vocab.get("added_tokens", [])), end_id])
    kind = np.dtype("<u2") if top < 1 << 16 else np.dtype("<u4")
    shared = spark.sparkContext.broadcast(data)
    folder = folder or scratch_path(spark, "tokens")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.withColumn("spread", F.xxhash64("text", F.monotonically_increasing_id()))
    ordered = rows.repartitionByRange("id", "spread").sortWithinPartitions("id", "spread").select("id", "text")

    def run(batches):
        data = shared.value
        encode = worker_kept("tokenizer", (zlib.crc32(data), len(data), kind.str), lambda: Tokenizer(data, kind))
        writer = Writer(folder, TaskContext.get().partitionId(), length, kind)
        end = np.array([end_id], kind).tobytes()
        batch = part = None
        for batch in batches:
            for part in text_slices(batch, "text"):
                for doc_id, ids in zip(part.column("id").to_pylist(), encode(part.column("text").to_pylist()), strict=True):
                    writer.add(-1 if doc_id is None else doc_id, ids + end)
        writer.close()
        columns = list(zip(*writer.done, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "roll", "path", "n_docs", "n_ids"])
        del batch, part, writer
        give_back()

    bounded_batches(spark)
    manifest = staged(ordered.mapInArrow(run, MANIFEST), "token-manifest")
    # One small row per file of many documents: a single ordered window.
    before = W.orderBy("part", "roll").rowsBetween(W.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).withColumn("folder", F.lit(folder))


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers).  One task reads one file."""

    def summed(documents, start):
        for doc_id, ids in documents:
            yield doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())
            start += len(ids)

    def run(batches):
        forget_kept()
        for batch in batches:
            for folder, path, start in zip(*(batch.column(c).to_pylist() for c in ("folder", "path", "start")), strict=True):
                rows = summed(SequenceFile(folder, path).documents(), start)
                # A file may hold as many documents as ids.
                while some := list(islice(rows, READ_ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*some, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])
        give_back()

    files = manifest.select("folder", "path", "start")
    spread = files.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism * 4), "path")
    return spread.mapInArrow(run, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
