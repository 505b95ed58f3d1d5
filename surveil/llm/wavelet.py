"""Token ids as wavelet matrices: one compressed file per shard, read without unpacking all of it.

Documents are range-partitioned by id, encoded, and written in ascending order of id as shards of
about ``SHARD_TOKENS`` ids. A shard holds one bit-plane per bit of the largest id. In the first
plane bit i is the top bit of id i; ids with a 0 there go before those with a 1 (each in its old
order), and the next plane holds the next bit in the new order. A plane is cut into blocks of
``BLOCK_BITS`` bits, each stored as it is or zstd-compressed, whichever is smaller, and a
directory has the number of ones before each block. So access, rank (how often an id stands before
a place) and select (where its k-th copy stands) each touch a block or so per plane.

Files go to a folder every executor reaches, by URI through ``pyarrow.fs``. A task names its files
anew on every attempt, and only the index, committed by Spark as a Parquet table, says which count.

Encoding is the ``tokenizers`` library's, once per distinct piece. A single blank between two other
characters starts a new piece in the byte-level pattern, so texts are cut there first, and each
distinct word is cut further where all its letters are well known. Texts with an added token or with
odd white space (two blanks, tabs) are given to the library whole.

Defined results: a null text is empty and has the end id alone; a null doc_id sorts first and reads
back as null; rows that repeat an id are documents of their own, ordered by a hash of the text, then
the text; a text of any length stays in one shard; an empty table gives an empty index; all other
columns are ignored, whatever their names. ``SHARD_TOKENS`` bounds a task's memory, but for a single
longer document.
"""

import hashlib
import json
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveil.llm.bpe import byte_characters
from surveil.llm.idtable import ranges
from surveil.llm.warc import new_folder
from surveil.llm.words import resting, slices
from surveil.session import stage

SHARD_TOKENS = 1 << 22
BLOCK_BITS = 1 << 16
BATCH_CHARS = 1 << 23
CACHE_PIECES = 1_200_000
END_ID = 0
MAGIC = b"wavelet1"
LEVEL = 1

INDEX = "part int, seq int, shard string, n_docs long, n_ids long"
# letters and digits of which every version of Unicode says the same
_LETTERS, _DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾"
_FINE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^\s\0{_LETTERS}{_DIGITS}]+|\s+(?!\S)|\s+|\0")
_COARSE = re.compile(r" ?[^\s]+|\s+(?!\S)|\s+")
_UNKNOWN = re.compile("[^\0-\u017f\u2010-\u2027\u20ac]")
# NUL, and white space of other kinds, the four separators included that the library's pattern takes for none
_ODD = re.compile("[\0\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


# ---- bit-planes -------------------------------------------------------------------------------

class PlaneWriter:
    """Lays a shard out as bytes: planes, document table, footer."""

    def __init__(self):
        import zstandard
        self.squeeze = zstandard.ZstdCompressor(level=LEVEL)

    def pack(self, ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> bytes:
        n, out, at = len(ids), [MAGIC], len(MAGIC)
        width = max(int(ids.max()).bit_length(), 1) if n else 1
        row = ids.astype(np.uint16 if width <= 16 else np.uint32)
        zeros, ones, offsets = [], [], []
        for level in range(width - 1, -1, -1):
            bits = np.packbits((row & row.dtype.type(1 << level)) != 0, bitorder="little")
            packed = bits.tobytes()
            before, step = 0, BLOCK_BITS // 8
            for start in range(0, len(packed), step):
                raw = packed[start:start + step]
                ones.append(before)
                before += int(np.bitwise_count(bits[start:start + step]).sum())
                small = self.squeeze.compress(raw)
                block = b"\1" + small if len(small) < len(raw) else b"\0" + raw
                offsets.append(at)
                out.append(block)
                at += len(block)
            mask = pa.BooleanArray.from_buffers(pa.bool_(), len(row), [None, pa.py_buffer(packed)])
            low, high = (pc.filter(pa.array(row), m).to_numpy() for m in (pc.invert(mask), mask))
            zeros.append(len(low))
            row = np.concatenate([low, high])
        offsets.append(at)
        known = np.array([d is not None for d in doc_ids], np.uint8)
        table = b"".join([np.array([d or 0 for d in doc_ids], "<i8").tobytes(), known.tobytes(), np.asarray(ends, "<i8").tobytes(),
                          np.array(zeros, "<i8").tobytes(), np.array(ones, "<i8").tobytes(), np.array(offsets, "<i8").tobytes()])
        small = self.squeeze.compress(table)
        return b"".join([*out, small, struct.pack("<QQQQ", len(doc_ids), n, width, at), MAGIC])


class WaveletFile:
    """Access, rank and select on one open shard; only blocks that are asked for are read."""

    def __init__(self, file, cached: int = 64):
        import zstandard
        self.file, self.plain = file, zstandard.ZstdDecompressor()
        size = file.size()
        tail = file.read_at(32 + len(MAGIC), size - 32 - len(MAGIC))
        if tail[32:] != MAGIC:
            raise ValueError("not a wavelet shard")
        n_docs, self.n, self.width, at = struct.unpack("<QQQQ", tail[:32])
        self.blocks = -(-self.n // BLOCK_BITS)
        lengths = [8 * n_docs, n_docs, 8 * n_docs, 8 * self.width, 8 * self.width * self.blocks, 8 * (self.width * self.blocks + 1)]
        table = self.plain.decompress(file.read_at(size - 32 - len(MAGIC) - at, at), max_output_size=sum(lengths) or 1)
        cuts = np.cumsum([0, *lengths])
        ids, known, self.ends, self.zeros, ones, self.offsets = (
            np.frombuffer(table[a:b], t) for a, b, t in zip(cuts, cuts[1:], ["<i8", "u1", "<i8", "<i8", "<i8", "<i8"]))
        self.ones = ones.reshape(self.width, self.blocks)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.cache, self.cached = {}, cached

    def block(self, level: int, number: int) -> np.ndarray:
        """The bits of one block, one byte each."""
        key = level * self.blocks + number
        bits = self.cache.get(key)
        if bits is None:
            raw = self.file.read_at(int(self.offsets[key + 1] - self.offsets[key]), int(self.offsets[key]))
            bits = self._bits(raw)
            if len(self.cache) >= self.cached:
                self.cache.pop(next(iter(self.cache)))
            self.cache[key] = bits
        return bits

    def _bits(self, raw: bytes) -> np.ndarray:
        body = self.plain.decompress(raw[1:], max_output_size=BLOCK_BITS // 8) if raw[:1] == b"\1" else raw[1:]
        return np.unpackbits(np.frombuffer(body, np.uint8), bitorder="little")

    def ones_before(self, level: int, place: int) -> int:
        if place >= self.n:
            return self.n - int(self.zeros[level])
        number, rest = divmod(place, BLOCK_BITS)
        return int(self.ones[level, number]) + int(np.count_nonzero(self.block(level, number)[:rest]))

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        value = 0
        for level in range(self.width):
            bit = int(self.block(level, place // BLOCK_BITS)[place % BLOCK_BITS])
            ones = self.ones_before(level, place)
            place = int(self.zeros[level]) + ones if bit else place - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the copies of ``token`` among places [start, end) end up below the last plane."""
        if token < 0 or token >> self.width:
            return 0, 0
        for level in range(self.width):
            a, b = self.ones_before(level, start), self.ones_before(level, end)
            if token >> (self.width - 1 - level) & 1:
                start, end = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                start, end = start - a, end - b
            if start >= end:
                return 0, 0
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def rank(self, token: int, place: int) -> int:
        """Copies of ``token`` before a place."""
        return self.count(token, 0, place)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """The place of the k-th (from 0) one or zero of a plane."""
        before = self.ones[level] if bit else np.arange(self.blocks) * BLOCK_BITS - self.ones[level]
        number = int(np.searchsorted(before, k, "right")) - 1
        return number * BLOCK_BITS + int(np.flatnonzero(self.block(level, number) == bit)[k - int(before[number])])

    def select(self, token: int, k: int) -> int:
        """The place of the k-th (from 0) copy of ``token``."""
        start, end = self._range(token, 0, self.n)
        if not 0 <= k < end - start:
            raise IndexError(k)
        place = start + k
        for level in range(self.width - 1, -1, -1):
            bit = token >> (self.width - 1 - level) & 1
            place = self._select_bit(level, bit, place - int(self.zeros[level]) if bit else place)
        return place

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids: the planes are undone from the last to the first."""
        row = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for level in range(self.width - 1, -1, -1):
            first = level * self.blocks
            raw = self.file.read_at(int(self.offsets[first + self.blocks] - self.offsets[first]), int(self.offsets[first]))
            cuts = (self.offsets[first:first + self.blocks + 1] - self.offsets[first]).tolist()
            bits = np.concatenate([self._bits(raw[a:b]) for a, b in zip(cuts, cuts[1:])])[:self.n] if self.blocks else np.zeros(0, np.uint8)
            mask, zeros, back = bits.view(bool), int(self.zeros[level]), np.empty_like(row)
            back[np.flatnonzero(~mask)] = row[:zeros]
            back[np.flatnonzero(mask)] = row[zeros:] | row.dtype.type(1 << (self.width - 1 - level))
            row = back
        return row


# ---- encoding ---------------------------------------------------------------------------------

class CutEncoder:
    """The ``tokenizers`` library over the distinct pieces of many texts."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_str(spec)
        self.model.no_truncation()
        self.model.no_padding()
        added = [t["content"] for t in json.loads(spec).get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        bare = json.loads(spec)
        before = bare.get("pre_tokenizer") or {}
        # a piece that the pattern leaves whole goes to the library's model at once, as the characters that stand for its bytes
        self.bytewise = not bare.get("normalizer") and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.characters = dict(enumerate(byte_characters())) | {0: "\0"}
        self._clear()

    def _clear(self):
        self.coarse = set()     # pieces that the library has yet to cut
        self.number, self.ids = {"\0": 0}, [(np.zeros(0, np.int32), np.zeros(2, np.int64))]   # a NUL ends a word and has no ids

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not known yet."""
        whole = [p for p in pieces if p not in self.coarse] if self.bytewise else []
        if whole:
            tokenize, flat, cuts = self.model.model.tokenize, [], [0]
            for piece in "\0".join(whole).encode("utf-8", "surrogatepass").decode("latin-1").translate(self.characters).split("\0"):
                flat += [token.id for token in tokenize(piece)]
                cuts.append(len(flat))
            self._keep(whole, flat, np.array(cuts, np.int64))
        rest = [p for p in pieces if p in self.coarse] if self.bytewise else pieces
        if rest:
            found = self.model.encode(rest, is_pretokenized=True, add_special_tokens=False)
            self._keep(rest, found.ids, np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(rest) + 1)))
        self.coarse = set()

    def _keep(self, pieces: list[str], flat: list[int], cuts: np.ndarray) -> None:
        base = len(self.number)
        self.number.update(zip(pieces, range(base, base + len(pieces))))
        self.ids.append((np.array(flat, np.int32), cuts))

    def _table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all known pieces, their starts, their lengths)."""
        if len(self.ids) > 1:
            flats, base = [], 0
            starts = []
            for flat, cuts in self.ids:
                flats.append(flat)
                starts.append(cuts[:-1] + base)
                base += len(flat)
            self.ids = [(np.concatenate(flats), np.concatenate([*starts, [base]]))]
        flat, cuts = self.ids[0]
        return flat, cuts[:-1], np.diff(cuts)

    def pieces(self, joined: str) -> list[str]:
        """The pieces of words that end with a NUL each, with a NUL after each word; letters beyond the known ones are left to the library."""
        if not _UNKNOWN.search(joined):
            return _FINE.findall(joined)
        out = []
        for word in joined.split("\0")[:-1]:
            if _UNKNOWN.search(word):
                found = _COARSE.findall(word)
                self.coarse.update(found)
            else:
                found = _FINE.findall(word)
            out += found
            out.append("\0")
        return out

    def encode_words(self, joined: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words, their starts, their lengths); a NUL ends each word."""
        cut = self.pieces(joined)
        distinct = set(cut)
        new = [p for p in distinct if p not in self.number]
        if len(self.number) + len(new) > CACHE_PIECES:
            self._clear()
            new = [p for p in distinct if p != "\0"]
        if new:
            self._learn(new)
        flat, starts, lengths = self._table()
        at = np.fromiter(map(self.number.__getitem__, cut), np.int64, len(cut))
        length = lengths[at]
        bounds = np.concatenate([[0], np.cumsum(length)[at == 0]])
        return flat[ranges(starts[at], length)], bounds[:-1], np.diff(bounds)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        out: list = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if not t:
                out[i] = np.zeros(0, np.int32)
            elif _ODD.search(t) or self.added and self.added.search(t) or t[0] == " " or t[-1] == " " or t.endswith("\n\n") or "  " in t or " \n" in t or "\n " in t:
                out[i] = np.array(self.model.encode(t, add_special_tokens=False).ids, np.int32)
            else:
                plain.append(i)
        if not plain:
            return out
        # every blank stands between two other characters here
        split = pc.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        firsts = [texts[i].split(" ", 1)[0] for i in plain]
        words = coded.dictionary.to_pylist()
        flat, starts, lengths = self.encode_words("\0".join([" " + "\0 ".join(words), *firsts, ""]))
        offsets = split.offsets.to_numpy().astype(np.int64)
        codes = coded.indices.to_numpy().astype(np.int64)
        codes[offsets[:-1]] = len(words) + np.arange(len(plain))  # the first word of a text has no blank before it
        total = np.concatenate([[0], np.cumsum(lengths[codes])])
        ids, bounds = flat[ranges(starts[codes], lengths[codes])], total[offsets].tolist()
        for i, a, b in zip(plain, bounds, bounds[1:]):
            out[i] = ids[a:b]
        return out


_encoders: dict[str, CutEncoder] = {}


def _encoder(spec: str) -> CutEncoder:
    """The worker's encoder; kept between tasks of a reused worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = CutEncoder(spec)
    return _encoders[key]


# ---- Spark ------------------------------------------------------------------------------------

def write_shards(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode (doc_id, text) and write it as shards in ``folder``; returns the committed index,
    one row per shard: (part, seq) is their order."""
    with open(path, encoding="utf-8") as f:  # the driver's copy of a vocabulary of fixed size
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text").drop("_tie")

    @resting
    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext
        encoder, part = _encoder(sent.value), TaskContext.get().partitionId()
        system, place = fs.FileSystem.from_uri(folder)
        writer, own, doc_ids, held, seq = PlaneWriter(), [], [], 0, 0

        def close():
            nonlocal own, doc_ids, held, seq
            name = f"{uuid.uuid4().hex}.wavelet"
            ids = np.concatenate(own).astype(np.uint32)
            with system.open_output_stream(f"{place}/{name}", compression=None) as out:
                out.write(writer.pack(ids, doc_ids, np.cumsum([len(x) for x in own])))
            row = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in (
                (part, pa.int32()), (seq, pa.int32()), (name, pa.string()), (len(doc_ids), pa.int64()), (len(ids), pa.int64()))],
                names=["part", "seq", "shard", "n_docs", "n_ids"])
            own, doc_ids, held, seq = [], [], 0, seq + 1
            return row

        system.create_dir(place, recursive=True)
        end = np.array([end_id], np.int32)
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_pylist()
            for some in slices(sizes, BATCH_CHARS):
                texts = batch.column(1).slice(some.start, some.stop - some.start).to_pylist()
                for doc_id, ids in zip(batch.column(0).slice(some.start, len(texts)).to_pylist(), encoder.encode(texts)):
                    if own and held + len(ids) + 1 > shard_tokens:
                        yield close()
                    own.append(np.concatenate([ids, end]))
                    doc_ids.append(doc_id)
                    held += len(ids) + 1
        if own:
            yield close()

    return stage(ordered.mapInArrow(run, INDEX), "wavelet-index")


def placed(index: DataFrame) -> DataFrame:
    """The index with ``start``, the ids of all shards before. It has one row per ``SHARD_TOKENS``
    ids, so one window holds it at any size."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return index.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _over_shards(index: DataFrame, folder: str, schema: str, read):
    """``read(file, row)`` yields record batches for every shard; one task per shard."""
    shards = placed(index).select("shard", "start")
    spread = shards.repartition(max(index.count(), 1))

    def run(batches):
        from pyarrow import fs
        system, place = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for shard, start in zip(*(c.to_pylist() for c in batch.columns)):
                with system.open_input_file(f"{place}/{shard}") as file:
                    yield from read(WaveletFile(file), start)

    return spread.mapInArrow(run, schema)


def _batch(schema: list[tuple], columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema])


def read_documents(index: DataFrame, folder: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, and with ``ids`` the ids) of every document, read back from the shards."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]

    def read(file, start):
        flat = file.decode().astype("<u4")
        ends = file.ends.tolist()
        begins = [0, *ends[:-1]]
        for first in range(0, len(ends), 4096):
            pairs = list(zip(begins[first:first + 4096], ends[first:first + 4096]))
            made = _batch(fields, (file.doc_ids[first:first + 4096], [start + a for a, _ in pairs], [b - a for a, b in pairs],
                                   [zlib.crc32(flat[a:b]) for a, b in pairs]))
            if ids:
                lists = pa.array([flat[a:b].astype(np.int32) for a, b in pairs], pa.list_(pa.int32()))
                made = pa.RecordBatch.from_arrays([*made.columns, lists], names=[*made.schema.names, "ids"])
            yield made

    return _over_shards(index, folder, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids, read)


def count_tokens(index: DataFrame, folder: str, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of a few ids stands in the corpus, by rank alone; nothing is decoded."""
    wanted = [int(t) for t in tokens]
    fields = [("token", pa.int64()), ("n", pa.int64())]
    found = _over_shards(index, folder, "token long, n long",
                         lambda file, start: iter([_batch(fields, (wanted, [file.count(t) for t in wanted]))]))
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def find_token(index: DataFrame, folder: str, token: int) -> DataFrame:
    """(doc_id, place, at): every occurrence of an id, by select; ``place`` counts from the corpus start, ``at`` from the document's."""
    fields = [("doc_id", pa.int64()), ("place", pa.int64()), ("at", pa.int64())]

    def read(file, start):
        begins = np.concatenate([[0], file.ends[:-1]])
        total = file.count(token)
        for first in range(0, total, 4096):
            places = np.array([file.select(token, k) for k in range(first, min(first + 4096, total))], np.int64)
            docs = np.searchsorted(file.ends, places, "right")
            yield _batch(fields, ([file.doc_ids[d] for d in docs.tolist()], (places + start).tolist(), (places - begins[docs]).tolist()))

    return _over_shards(index, folder, "doc_id long, place long, at long", read)


def tokens_at(index: DataFrame, folder: str, places: DataFrame) -> DataFrame:
    """(place, token) for a table of places counted from the corpus start; places outside the corpus are left out."""
    shards = placed(index).select("shard", "start", (F.col("start") + F.col("n_ids")).alias("_stop"))
    # a shard meets few bins as wide as shards are, and every place falls into one
    bins = F.explode(F.sequence(F.floor(F.col("start") / SHARD_TOKENS), F.floor((F.col("_stop") - 1) / SHARD_TOKENS)))
    asked = places.select(F.col("place").cast("long").alias("place")).distinct().withColumn("_bin", F.floor(F.col("place") / SHARD_TOKENS))
    rows = asked.join(shards.withColumn("_bin", bins), "_bin").filter("place >= start AND place < _stop").select("shard", "start", "place")
    rows = rows.repartition("shard").sortWithinPartitions("shard", "place")
    fields = [("place", pa.int64()), ("token", pa.int64())]

    def run(batches):
        from pyarrow import fs
        system, folder_path = fs.FileSystem.from_uri(folder)
        name, file, stream = None, None, None
        for batch in batches:
            out = []
            for shard, start, place in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != name:
                    if stream is not None:
                        stream.close()
                    name, stream = shard, system.open_input_file(f"{folder_path}/{shard}")
                    file = WaveletFile(stream)
                out.append((place, file.access(place - start)))
            yield _batch(fields, list(zip(*out)) or [(), ()])
        if stream is not None:
            stream.close()

    return rows.mapInArrow(run, "place long, token long")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def query(spark, sf_dir: str) -> DataFrame:
    folder = new_folder(spark).replace("/warc-", "/wavelet-")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return read_documents(write_shards(docs, folder, vocabulary_path()), folder, ids=False)
