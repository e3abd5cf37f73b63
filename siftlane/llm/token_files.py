"""Token-id files with bit-plane shuffling (operator 3).

Documents are range-partitioned by id; each partition (a *shard*) is encoded
and becomes one binary file, or several if it is large.  A file is a row of
records, a record is a run of whole documents with about RECORD_IDS ids.  Its
ids are cut into fixed-size blocks; a block is transposed into bit planes (or
byte planes) and each plane is compressed with zstandard by itself.

A record, all numbers little-endian, followed by one newline byte:

    magic "BPS1", mode u8 (0 bit planes, 1 byte planes), shard u32, n_docs u32,
    n_ids u64, first u64 (ids of the shard before the record), block_ids u32,
    n_blocks u32, size u64 (bytes of the planes)
    known u8[n_docs], doc_id i64[n_docs], n_tokens u64[n_docs]
    chunk index: planes u8[n_blocks], length u32 of every plane in turn
    the compressed planes

Files are written by Spark's committer, so a task that runs twice leaves one
file, and they are read back with Spark's binary reader; neither side touches
local paths.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import freeze, scratch_path, small_batches
from .common import worker_cache

MAGIC = b"BPS1"
HEAD = "<4sBIIQQIIQ"
BIT, BYTE = 0, 1
#: Ids of a block; a plane of it has an eighth as many bytes (byte planes: as many).
BLOCK_IDS = 1 << 16
#: Ids after which a record ends with the next document.
RECORD_IDS = 1 << 20
#: Compression level of the planes.
LEVEL = 3
#: Bytes of text that a shard should hold, shards at most, and records of a file at most (a large shard has several files).
SHARD_BYTES = 32 << 20
MAX_SHARDS = 20_000
FILE_RECORDS = 64
#: Remembered pieces of a worker, and words; of each the newer half, and what was asked for of the older one, outlasts the rest.
PIECES_KEPT = 200_000
WORDS_KEPT = 1_000_000
#: Characters of the longest piece or word that is remembered.
CHARS_KEPT = 64
#: Bytes of the texts that are encoded at once; a longer text is cut at white space after so many characters.
WORK_BYTES = 8 << 20


# ---- planes ----------------------------------------------------------------


def to_planes(ids: np.ndarray, mode: int = BIT) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, lowest first, up to the highest that is not all zero."""
    top = int(ids.max(initial=0))
    if mode == BYTE:
        n = (top.bit_length() + 7) // 8
        return [np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, i]).tobytes() for i in range(n)]
    n = top.bit_length()
    columns = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : (n + 7) // 8].T)
    return [np.packbits(columns[i // 8] & np.uint8(1 << i % 8), bitorder="little").tobytes() for i in range(n)]


def from_planes(planes: list[bytes], n: int, mode: int = BIT) -> np.ndarray:
    out = np.zeros(n, np.uint32)
    for i, p in enumerate(planes):
        if mode == BYTE:
            out |= np.frombuffer(p, np.uint8, n).astype(np.uint32) << np.uint32(8 * i)
            continue
        if i % 8 == 0:
            column = np.zeros(n, np.uint8)
        column |= np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little", count=n) << np.uint8(i % 8)
        if i % 8 == 7 or i == len(planes) - 1:
            out |= column.astype(np.uint32) << np.uint32(i // 8 * 8)
    return out


def pack_record(doc_ids: list, ids: list[bytes], shard: int, first: int, block_ids: int = BLOCK_IDS, mode: int = BIT, level: int = LEVEL) -> bytes:
    """A record of whole documents; ``ids`` are each document's as little-endian unsigned 32-bit integers."""
    import zstandard

    comp = zstandard.ZstdCompressor(level=level)
    flat = np.frombuffer(b"".join(ids), "<u4")
    blocks = [[comp.compress(p) for p in to_planes(flat[i : i + block_ids], mode)] for i in range(0, len(flat), block_ids)]
    body = b"".join(p for b in blocks for p in b)
    index = bytes(map(len, blocks)) + np.array([len(p) for b in blocks for p in b], "<u4").tobytes()
    head = struct.pack(HEAD, MAGIC, mode, shard, len(doc_ids), len(flat), first, block_ids, len(blocks), len(body))
    known = bytes(d is not None for d in doc_ids)
    keys = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    sizes = np.array([len(x) // 4 for x in ids], "<u8").tobytes()
    return b"".join((head, known, keys, sizes, index, body))


class Record:
    """A record's header and chunk index; blocks are decompressed only when asked for."""

    def __init__(self, data: bytes, at: int = 0):
        magic, self.mode, self.shard, n_docs, self.n_ids, self.first, self.block_ids, n_blocks, size = struct.unpack_from(HEAD, data, at)
        if magic != MAGIC:
            raise ValueError("not a record of a token file")
        at += struct.calcsize(HEAD)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        known, keys, sizes = take("u1", n_docs), take("<i8", n_docs), take("<u8", n_docs)
        self.doc_ids = [k if ok else None for k, ok in zip(keys.tolist(), known.tolist())]
        self.sizes = sizes.astype(np.int64)
        self.starts = np.cumsum(np.append(0, self.sizes))[:-1]  # within the record
        planes = take("u1", n_blocks)
        lengths = take("<u4", int(planes.sum())).astype(np.int64)
        self.data, self.planes = data, np.append(0, np.cumsum(planes.astype(np.int64)))
        self.offsets = at + np.append(0, np.cumsum(lengths))
        if self.offsets[-1] != at + size:
            raise ValueError("a record's chunk index does not fit its planes")
        self.end = at + size + 1  # after the newline

    def block(self, b: int, unzip) -> np.ndarray:
        """The ids of one block, found by the chunk index."""
        first, last = self.planes[b], self.planes[b + 1]
        some = [unzip.decompress(self.data[self.offsets[i] : self.offsets[i + 1]]) for i in range(first, last)]
        return from_planes(some, min(self.block_ids, self.n_ids - b * self.block_ids), self.mode)

    def ids(self, start: int, end: int, unzip) -> np.ndarray:
        """The ids from ``start`` to ``end``, from the blocks that hold them."""
        if start >= end:
            return np.empty(0, np.uint32)
        low = start // self.block_ids
        got = np.concatenate([self.block(b, unzip) for b in range(low, (end - 1) // self.block_ids + 1)])
        return got[start - low * self.block_ids : end - low * self.block_ids]


def records(data: bytes):
    """The records of a file."""
    at = 0
    while at < len(data):
        r = Record(data, at)
        yield r
        at = r.end


def read_records(data: bytes):
    """``(shard, doc_ids, local starts, sizes, ids)`` of each record of a file."""
    import zstandard

    unzip = zstandard.ZstdDecompressor()
    for r in records(data):
        yield r.shard, r.doc_ids, r.first + r.starts, r.sizes, r.ids(0, r.n_ids, unzip)


# ---- encoding --------------------------------------------------------------

# Characters of plain pieces: printable ASCII, Latin letters, dashes and quotation marks, but the Latin capitals whose
# lower case is not such a character.  A piece that has any other goes through the tokenizer whole.
PLAIN = "!-~‐-‧" + "".join(c for c in map(chr, range(ord("À"), ord("ɏ") + 1)) if re.fullmatch("[À-ɏ]", c.lower()))
ODD = re.compile(f"[^ {PLAIN}]")
# fixed values: the tokenizer's own splitting pattern, for lower-cased plain text
PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^a-z0-9ß-öø-ɏ]+")
WHITE = re.compile(r"[\t-\r ]")


#: Characters of a text by which rows of one id are ordered, before a hash of it (the range sampling carries them).
TIE_CHARS = 8


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian u32."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Remembered(dict):
    """What ``ask`` says of a key, asked once while it is remembered; ``most`` entries at once, none for long keys."""

    def __init__(self, ask, most: int):
        self.ask, self.most, self.older = ask, most, {}

    def __missing__(self, key: str) -> bytes:
        if 2 * len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(key)
        if ids is None:
            ids = self.ask(key)
        if len(key) <= CHARS_KEPT:
            self[key] = ids
        return ids


class WordEncoder(Remembered):
    """Odd piece (without ASCII white space) to its ids as little-endian u32; ``words`` has those of plain words."""

    def __init__(self, content: str):
        import tokenizers

        from .bpe import byte_alphabet

        super().__init__(self.whole, PIECES_KEPT)
        self.tokenizer = tokenizers.Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or r"(?!)")
        self.stand_in = {b: c for c, b in byte_alphabet().items()}
        self.words = Remembered(self.word, WORDS_KEPT)

    @property
    def older_words(self) -> dict[str, bytes]:
        return self.words.older

    def whole(self, piece: str) -> bytes:
        return packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def word(self, w: str) -> bytes:
        raw = w if w.isascii() else "".join(map(self.stand_in.__getitem__, w.encode()))
        return packed([t.id for t in self.model.tokenize(raw)])

    def is_odd(self, t: str) -> bool:
        return bool(ODD.search(t) or self.special.search(t))

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of every piece."""
        cut, ids = PRETOKEN.findall, self.words.__getitem__
        if not self.is_odd(" ".join(pieces)):
            return [b"".join(map(ids, cut(p.lower()))) for p in pieces]
        return [self[p] if self.is_odd(p) else b"".join(map(ids, cut(p.lower()))) for p in pieces]

    def encode(self, texts: pa.Array):
        """Each text's ids as little-endian u32; a piece is looked up once for all texts."""
        lists = pc.ascii_split_whitespace(texts)
        codes = lists.flatten().dictionary_encode()
        known = self.pieces(codes.dictionary.to_pylist()).__getitem__
        at, offsets = codes.indices.to_numpy(), (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
        for start, end in zip(offsets, offsets[1:]):
            yield b"".join(map(known, at[start:end].tolist()))

    def documents(self, texts: pa.Array):
        """:meth:`encode` of any number of texts of any length, about WORK_BYTES at a time."""
        size = np.append(0, np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)))
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(size, size[first] + WORK_BYTES, "right")) - 1)
            if size[last] - size[first] > WORK_BYTES:
                yield b"".join(x for run in runs(texts[first].as_py()) for x in self.encode(pa.array([run])))
            else:
                yield from self.encode(texts.slice(first, last - first))
            first = last

    def text(self, t: str) -> bytes:
        return next(self.documents(pa.array([t])))


def runs(t: str):
    """A long text, cut at white space."""
    at = 0
    while len(t) - at > WORK_BYTES and (end := WHITE.search(t, at + WORK_BYTES)):
        yield t[at : end.start()]
        at = end.start()
    yield t[at:]


def _encode_shard(content, key: str, end_id: int, mode: int):
    """mapInArrow: the records of one partition, its documents being in order."""

    def run(batches):
        import pyspark

        shard = pyspark.TaskContext.get().partitionId()
        cache = worker_cache("token_files")
        if key not in cache:
            cache.clear()
            cache[key] = WordEncoder(content.value)
        enc, end = cache[key], struct.pack("<I", end_id)
        keys, ids, held, first = [], [], 0, 0
        for b in batches:
            out = []
            for d, x in zip(b.column(0).to_pylist(), enc.documents(pc.fill_null(b.column(1), ""))):
                x += end
                keys.append(d)
                ids.append(x)
                held += len(x) // 4
                if held >= RECORD_IDS:
                    out.append(pack_record(keys, ids, shard, first, mode=mode))
                    first += held
                    keys, ids, held = [], [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([pack_record(keys, ids, shard, first, mode=mode)], pa.binary())], names=["record"])

    return run


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, mode: int = BIT, id: str = "doc_id", text: str = "text") -> None:
    """Writes the files of all documents, each followed by ``end_id``, in ascending id order.

    Null ids come first; rows that share an id follow their first TIE_CHARS
    characters, then a hash of the text, and may span many files.  A null text
    counts as empty, an empty table gives no documents, other columns are not
    read."""
    import hashlib

    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(MAX_SHARDS, max(1, -(-total // SHARD_BYTES)))
    key = hashlib.sha1(content.value.encode()).hexdigest()
    # the place in the input only spreads equal rows over the files
    order = [F.col("doc_id").asc_nulls_first(), F.substring("text", 1, TIE_CHARS), F.xxhash64("text"), F.col("place")]
    records = (
        rows.select("doc_id", "text", F.monotonically_increasing_id().alias("place"))
        .repartitionByRange(shards, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(_encode_shard(content, key, end_id, mode), "record binary")
    )
    # the text writer puts each record's bytes down as they are, and a newline after it
    with small_batches(spark):
        records.select(F.col("record").cast("string").alias("value")).write.option("maxRecordsPerFile", FILE_RECORDS).mode("errorifexists").text(folder)


DOC_SCHEMA = pa.schema([("shard", pa.int64()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _decode_files(batches):
    for b in batches:
        for content in b.column(0):
            for shard, keys, starts, sizes, ids in read_records(content.as_py()):
                data = memoryview(ids.astype("<u4").tobytes())
                offsets = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))]) * 4
                crc = [zlib.crc32(data[offsets[i] : offsets[i + 1]]) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(keys), pa.int64()), pa.array(keys, pa.int64()), pa.array(starts), pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64())],
                    schema=DOC_SCHEMA,
                )


def read(spark, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files."""
    files = spark.read.format("binaryFile").load(folder)
    docs = freeze(files.select("content").mapInArrow(_decode_files, "shard long, doc_id long, local long, n_tokens long, ids_crc32 long"), "token_docs")
    # one row a shard: the ids of all shards before it
    shards = docs.groupBy("shard").agg(F.max(F.col("local") + F.col("n_tokens")).alias("n"))
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = shards.select("shard", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    return docs.join(before, "shard").select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, mode: int = BIT) -> DataFrame:
    folder = scratch_path(docs.sparkSession, "token_files")
    write(docs, folder, tokenizer, end_id, mode)
    return read(docs.sparkSession, folder)


def document_index(spark, folder: str) -> DataFrame:
    """``(path, record, doc_id, n_tokens)`` of every document in the files, from their headers alone: nothing is decompressed."""
    schema = pa.schema([("path", pa.string()), ("record", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content")):
                for n, r in enumerate(records(content.as_py())):
                    k = len(r.doc_ids)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * k, pa.string()), pa.array([n] * k, pa.int64()), pa.array(r.doc_ids, pa.int64()), pa.array(r.sizes)], schema=schema)

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(run, "path string, record long, doc_id long, n_tokens long")


def fetch(spark, folder: str, doc_ids: list[int], index: DataFrame | None = None) -> DataFrame:
    """``(doc_id, tokens)`` of the documents of a short list, one row for each in the files.

    Only files that hold one of them are opened (``index``, a written
    :func:`document_index`, tells which; the driver gets their names, as many
    as documents at most), and of these only the blocks that hold their ids are
    decompressed.  Ids that no document has give no row."""
    import zstandard

    wanted = set(doc_ids)
    ddl = "doc_id long, tokens array<long>"
    held = (document_index(spark, folder) if index is None else index).where(F.col("doc_id").isin(list(wanted)))
    paths = [r["path"] for r in held.select("path").distinct().collect()] if wanted else []
    if not paths:
        return spark.createDataFrame([], ddl)

    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            for content in b.column("content"):
                for r in records(content.as_py()):
                    rows = [(d, r.ids(s, s + n, unzip).tolist()) for d, s, n in zip(r.doc_ids, r.starts.tolist(), r.sizes.tolist()) if d in wanted]
                    yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.list_(pa.int64()))], names=["doc_id", "tokens"])

    return spark.read.format("binaryFile").load(paths).select("content").mapInArrow(run, ddl)
