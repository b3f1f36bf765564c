"""Token ids in files compressed by Re-Pair grammars, with random access.

Documents are range-sorted by their id, and each range is one file. Its task encodes the
texts and cuts the stream of ids into shards. In a shard the most frequent pairs of
neighbouring symbols are replaced by nonterminals, over and over: a round counts all pairs,
takes the most frequent ones of which no symbol ends one and begins another, so that their
places cannot overlap, and replaces all of them at once; pairs of one symbol twice are
replaced from the start of each run. A shard stores its rules and the length of what each
nonterminal stands for, so that a reader finds any id by a running sum over the shard's
symbols, and expands only those that it wants.

A file is (numbers little-endian):

    shards     rules (2 x 16 bits each), their lengths (32 bits each), symbols (16 bits each)
    documents  id (64 bits), whether it has one (8 bits), first id in the file and number of
               ids (64 bits each), as four columns
    directory  a row of 64-bit numbers a shard: its place, first id, rules, symbols
    end        rows of the two tables, place of the documents, and the magic number

Every task writes a file of its own name and reports it; only reported files make up the
result, so a task that is lost or run twice leaves nothing that is read. Files lie in the
shared folder and are opened through pyarrow's file systems by their address.

Defined results: a null or empty text has the end id alone; rows that repeat an id follow
each other; rows with a null id come first and keep it; a text of any length is cut over
shards; an empty table gives no files; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parityline.llm.common import shared_path, written
from parityline.llm.pretokens import _OTHER as OTHER
from parityline.llm.pretokens import WORD_PATTERN, Encoder

END_ID = 2
MAGIC = b"repair01"
#: Ids of a shard, bytes of texts in a file.
SHARD_IDS, FILE_BYTES = 1 << 20, 32 << 20
#: Symbols are 16-bit numbers: terminals, then nonterminals as far as they go.
SYMBOLS = 1 << 16
#: A round replaces up to so many pairs, each with so many places; rounds end when one
#: takes away less than this share of the symbols.
ROUND_PAIRS, LEAST_PLACES, LEAST_GAIN = 4096, 6, 0.04
ROUNDS = 24
#: Chunks of text whose ids a worker remembers, in each of two generations, and their bytes.
CHUNKS, CHUNK_BYTES = 500_000, 32 << 20
_END = struct.Struct("<QQQ8s")
#: Characters whose pre-tokens are those of the pattern; the four that separate records are
#: white space to the library alone.
_PLAIN = bytes(c for c in range(256) if not OTHER.match(chr(c)) and not 0x1C <= c <= 0x1F)
_MARKS = frozenset(b".,;:!?")
#: Small letters of Latin-1.
_SMALL = bytes(range(256)).decode("latin-1").lower().encode("latin-1")


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian 16-bit numbers."""
    return struct.pack(f"<{len(ids)}H", *ids)


@cache
def _numbers(count: int, form: str) -> tuple[bytes, ...]:
    """The bytes of each number below ``count``."""
    return tuple(struct.pack(form, i) for i in range(count))


class Chunks(dict):
    """Ids of chunks of text between white space, made when first asked for.

    ``old`` is the generation before this one, of which what is still in use returns.
    """

    def __init__(self, encoder: Encoder, old: dict[bytes, bytes]):
        self.encoder, self.old, self.bytes = encoder, old, 0
        self.two = _numbers(SYMBOLS, "<H")

    def __missing__(self, chunk: bytes) -> bytes:
        found = self.old.get(chunk)
        if found is None:
            # A word and one mark after it are pre-tokens of their own.
            if chunk[-1] in _MARKS and chunk[-2:-1].isalpha():
                found = self[chunk[:-1]] + self[chunk[-1:]]
            else:
                text, two = chunk.decode("latin-1"), self.two
                if chunk.isalpha():  # the byte level writes letters of ASCII as they are
                    found = b"".join([two[t.id] for t in self.encoder.tokenize(text)])
                else:
                    pieces = [text] if text.isalpha() else self.encoder.pieces(text)
                    found = b"".join([two[i] for piece in pieces for i in self.encoder.piece(piece)])
        self[chunk] = found
        self.bytes += len(chunk) + len(found)
        return found


class Ids:
    """Ids of whole texts as 16-bit numbers: each chunk between white space is encoded once.

    No pre-token holds white space, so a text's ids are those of its chunks in order.
    """

    def __init__(self, path: str, end_id: int):
        self.encoder = Encoder.of(path, WORD_PATTERN, lower=True)
        self.terminals = self.encoder.library.get_vocab_size()
        if self.terminals > SYMBOLS - 1024:
            raise ValueError("the vocabulary leaves no numbers for nonterminals")
        self.end = _packed([end_id])
        self.chunks = Chunks(self.encoder, {})

    def of(self, text: str) -> bytes:
        """The ids of a text and the end id, little-endian."""
        try:
            data = text.encode("latin-1")
        except UnicodeEncodeError:
            data = None
        if data is None or data.translate(None, _PLAIN) or any(s in text for s in self.encoder.special):
            return _packed(self.encoder.whole(text)) + self.end
        found = b"".join(map(self.chunks.__getitem__, data.translate(_SMALL).split()))
        if len(self.chunks) > CHUNKS or self.chunks.bytes > CHUNK_BYTES:
            self.chunks.old = {}
            self.chunks = Chunks(self.encoder, dict(self.chunks))
        return found + self.end


def _slots(keys: np.ndarray) -> np.ndarray:
    """A place among 2^16 for each pair, by which it is looked up."""
    return (keys * np.uint32(0x9E3779B1)) >> np.uint32(16)


def _choose(keys: np.ndarray, counts: np.ndarray, room: int) -> tuple[list[int], list[int]]:
    """The most frequent pairs of which no symbol ends one and begins another.

    Of the two lists the first has pairs of two symbols, the second of one symbol twice.
    Of pairs that share a slot the most frequent one is taken; others wait for a next round.
    """
    most = min(ROUND_PAIRS, room)
    if len(keys) > 2 * most:
        some = np.argpartition(counts, -2 * most)[-2 * most :]
        keys, counts = keys[some], counts[some]
    begins, ends, pairs, twice = set(), set(), [], []
    keys = keys[np.lexsort((keys, -counts))]
    _, best = np.unique(_slots(keys), return_index=True)
    for key in keys[np.sort(best)].tolist():
        a, b = key >> 16, key & 0xFFFF
        if a == b:
            if a not in begins and a not in ends:
                twice.append(key)
                begins.add(a)
                ends.add(a)
        elif a not in ends and b not in begins:
            pairs.append(key)
            begins.add(a)
            ends.add(b)
        if len(pairs) + len(twice) == most:
            break
    return pairs, twice


def compress(ids: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray]:
    """(rules, symbols) of a shard: rule k is the pair that ``terminals + k`` stands for."""
    symbols, rules = ids.astype(np.uint16), []
    for _ in range(ROUNDS):
        room = SYMBOLS - terminals - len(rules)
        if len(symbols) < 2 or room <= 0:
            break
        places = symbols[:-1].astype(np.uint32) << 16 | symbols[1:]
        ordered = np.sort(places)
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(first, append=len(ordered))
        often = np.flatnonzero(counts >= LEAST_PLACES)
        pairs, twice = _choose(ordered[first[often]], counts[often], room)
        if not pairs and not twice:
            break
        chosen = np.array(pairs + twice, np.uint32)
        slots = np.zeros(SYMBOLS, np.uint16)
        slots[_slots(chosen)] = np.arange(len(chosen), dtype=np.uint16)
        number = slots[_slots(places)]
        at = np.flatnonzero(chosen[number] == places)
        number = number[at].astype(np.int64)
        # In a run of one symbol every second place, counted from its start.
        if twice and len(at):
            start = np.concatenate(([True], (np.diff(at) > 1) | (number[1:] != number[:-1])))
            begin = np.flatnonzero(start)
            place = np.arange(len(at)) - np.repeat(begin, np.diff(begin, append=len(at)))
            kept = (number < len(pairs)) | (place % 2 == 0)
            at, number = at[kept], number[kept]
        symbols[at] = (terminals + len(rules) + number).astype(np.uint16)
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        symbols = symbols[stays]
        rules += pairs + twice
        if len(at) < LEAST_GAIN * len(stays):
            break
    rules = np.array(rules, np.uint32)
    return np.stack([rules >> 16, rules & 0xFFFF], axis=1).astype("<u2"), symbols.astype("<u2")


def lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """How many ids each rule's nonterminal stands for."""
    found = [1] * terminals
    for a, b in rules.tolist():
        found.append(found[a] + found[b])
    return np.array(found[terminals:], "<u4")


class Shard:
    """A shard as it is read: expands any span of its ids.

    For short spans only their own symbols are expanded; once many are asked for, all rules.
    """

    def __init__(self, rules: np.ndarray, long: np.ndarray, symbols: np.ndarray, terminals: int):
        self.rules, self.symbols, self.terminals = rules.tolist(), symbols, terminals
        every = np.concatenate([np.ones(terminals, np.int64), long.astype(np.int64)])
        self.ends = np.cumsum(every[symbols])
        self.known: dict[int, bytes] = {}
        self.every: list[bytes] | None = None
        self.asked = 0

    def _expand(self, symbol: int) -> None:
        """Note the ids of one symbol, as 32-bit numbers; rules name earlier ones only."""
        known, waiting = self.known, [symbol]
        while waiting:
            s = waiting[-1]
            if s in known:
                waiting.pop()
            elif s < self.terminals:
                known[s] = struct.pack("<I", s)
            else:
                a, b = self.rules[s - self.terminals]
                if a in known and b in known:
                    known[s] = known[a] + known[b]
                else:
                    waiting += [a, b]

    def span(self, start: int, length: int) -> bytes:
        """``length`` ids from ``start`` on, as little-endian 32-bit numbers."""
        if not length:
            return b""
        low = int(np.searchsorted(self.ends, start, "right"))
        high = int(np.searchsorted(self.ends, start + length, "left")) + 1
        symbols = self.symbols[low:high].tolist()
        self.asked += len(symbols)
        if self.every is None and self.asked > len(self.rules):
            self.every = list(_numbers(self.terminals, "<I"))
            for a, b in self.rules:
                self.every.append(self.every[a] + self.every[b])
        known = self.every
        if known is None:
            known = self.known
            for symbol in set(symbols).difference(known):
                self._expand(symbol)
        skip = 4 * (start - (int(self.ends[low - 1]) if low else 0))
        return b"".join(map(known.__getitem__, symbols))[skip : skip + 4 * length]


class Writer:
    """One file: takes documents in order, writes a shard whenever it is full."""

    def __init__(self, path: str, terminals: int, shard_ids: int = SHARD_IDS):
        store, place = fs.FileSystem.from_uri(path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(place, compression=None)
        self.terminals, self.shard_ids = terminals, shard_ids
        self.held: list[bytes] = []
        self.waiting = self.total = self.written = self.bytes = 0
        self.shards: list[tuple[int, int, int, int]] = []
        self.documents: list[tuple] = []

    def add(self, doc: int | None, ids: bytes) -> None:
        """A document's 16-bit ids."""
        self.documents.append((doc or 0, doc is not None, self.total, len(ids) // 2))
        self.total += len(ids) // 2
        while ids:
            room = 2 * (self.shard_ids - self.waiting)
            part, ids = ids[:room], ids[room:]
            self.held.append(part)
            self.waiting += len(part) // 2
            if self.waiting == self.shard_ids:
                self._shard()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def _shard(self) -> None:
        rules, symbols = compress(np.frombuffer(b"".join(self.held), "<u2"), self.terminals)
        self.shards.append((self.bytes, self.written, len(rules), len(symbols)))
        self._put(rules.tobytes() + lengths(rules, self.terminals).tobytes() + symbols.tobytes())
        self.written += self.waiting
        self.held, self.waiting = [], 0

    def close(self) -> None:
        if self.waiting:
            self._shard()
        place = self.bytes
        columns = zip(*self.documents, strict=True)
        for column, kind in zip(columns, ("<i8", "?", "<i8", "<i8"), strict=True):
            self._put(np.array(column, kind).tobytes())
        self._put(np.array(self.shards, "<i8").tobytes())
        self._put(_END.pack(len(self.documents), len(self.shards), place, MAGIC))
        self.out.close()


class Reader:
    """One file: its documents, and any span of its ids."""

    def __init__(self, path: str, size: int, terminals: int):
        store, place = fs.FileSystem.from_uri(path)
        self.source, self.terminals = store.open_input_file(place), terminals
        docs, shards, at, magic = _END.unpack(self._get(size - _END.size, _END.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no file of this format, or is cut off")
        table = self._get(at, size - _END.size - at)
        cuts = np.cumsum([0, 8 * docs, docs, 8 * docs, 8 * docs]).tolist()
        kinds = ("<i8", "?", "<i8", "<i8")
        self.ids, self.has_id, self.starts, self.lengths = (
            np.frombuffer(table[a:b], k) for a, b, k in zip(cuts, cuts[1:], kinds, strict=False)
        )
        self.directory = np.frombuffer(table[cuts[-1] :], "<i8").reshape(shards, 4)
        self.total = int(self.starts[-1] + self.lengths[-1]) if docs else 0
        self.number, self.shard = -1, None

    def _get(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _open(self, number: int) -> Shard:
        """A shard; the one in use stays."""
        if number != self.number:
            at, _, rules, symbols = self.directory[number].tolist()
            data = self._get(at, 8 * rules + 2 * symbols)
            self.shard = Shard(
                np.frombuffer(data[: 4 * rules], "<u2").reshape(rules, 2),
                np.frombuffer(data[4 * rules : 8 * rules], "<u4"),
                np.frombuffer(data[8 * rules :], "<u2"),
                self.terminals,
            )
            self.number = number
        return self.shard

    def spans(self, start: int, length: int) -> Iterator[bytes]:
        """``length`` ids from ``start`` on, a shard's part at a time."""
        firsts = self.directory[:, 1]
        while length > 0:
            number = int(np.searchsorted(firsts, start, "right")) - 1
            end = int(firsts[number + 1]) if number + 1 < len(firsts) else self.total
            part = min(length, end - start)
            yield self._open(number).span(start - int(firsts[number]), part)
            start, length = start + part, length - part

    def sums(self) -> list[int]:
        """The crc32 of every document's ids, shard after shard."""
        found, at, first = [0] * len(self.starts), 0, 0
        ends = (self.starts + self.lengths).tolist()
        for data in self.shards():
            stop = first + len(data) // 4
            part, start = memoryview(data), first
            while at < len(ends):
                end = min(ends[at], stop)
                found[at] = zlib.crc32(part[4 * (start - first) : 4 * (end - first)], found[at])
                if ends[at] > stop:
                    break  # it goes on in the next shard
                at, start = at + 1, end
            first = stop
        return found

    def shards(self) -> Iterator[bytes]:
        """The ids of each shard as a whole."""
        ends = [*self.directory[1:, 1].tolist(), self.total]
        for number, (first, end) in enumerate(zip(self.directory[:, 1].tolist(), ends, strict=False)):
            yield self._open(number).span(0, end - first)

    def close(self) -> None:
        self.source.close()


def write(
    docs: DataFrame,
    path: str,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_bytes: int = FILE_BYTES,
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Write the ids of ``docs``; returns the written list of files.

    Its columns are (path, bytes, part, terminals, tokens); ``part`` orders the files.
    """
    spark = docs.sparkSession
    folder = shared_path(spark, "repair")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc"), F.coalesce(f"`{text_col}`", F.lit("")).alias("t")
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    # Rows of one id are spread by their texts, and equal rows by their place.
    spread = [F.xxhash64("t").alias("h"), F.monotonically_increasing_id().alias("u")]
    order = ["doc", "h", "u"]
    rows = rows.select("doc", "t", *spread).repartitionByRange(max(1, -(-size // file_bytes)), *order)
    rows = rows.sortWithinPartitions(*order).select("doc", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, name, writer = Ids(path, end_id), f"{folder}/{uuid.uuid4().hex}.repair", None
        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    writer = Writer(name, ids.terminals, shard_ids)
                writer.add(doc, ids.of(text))
        if writer is not None:
            writer.close()
            row = [name, writer.bytes, TaskContext.get().partitionId(), ids.terminals, writer.total]
            names = ["path", "bytes", "part", "terminals", "tokens"]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names)

    kinds = "path string, bytes long, part long, terminals long, tokens long"
    return written(rows.mapInArrow(run, kinds), "files")


def read(files: DataFrame) -> DataFrame:
    """(doc, start, n, ids_crc32) per document, all of its ids decoded from the files.

    ``start`` counts the ids of all documents before it; a file is one row of the list, so
    one window may add them up.
    """
    before = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")
    rows = files.select("path", "bytes", "terminals", before.alias("before"))
    rows = rows.repartition(max(1, min(files.count(), 10_000)), "path")
    names = ["doc", "start", "n", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, terminals, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader = Reader(path, size, terminals)
                sums = reader.sums()
                reader.close()
                doc = pa.array(reader.ids, pa.int64(), mask=~reader.has_id)
                columns = [pa.array(reader.starts + before), pa.array(reader.lengths), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays([doc, *columns], names)

    return rows.mapInArrow(run, "doc long, start long, n long, ids_crc32 long")


def spans(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(start, length, ids): the ids of each row (start, length) of ``wanted``.

    Only the shards that hold a span are read, and only its symbols expanded. A span ends
    with the last file at the latest; one that crosses files has a row for each.
    """
    # One number a file, which has tens of millions of ids.
    listed = sorted(tuple(r) for r in files.select("part", "tokens").collect())
    ends = np.cumsum([0, *[n for _, n in listed]])

    @F.pandas_udf("int")
    def place(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ends[1:], at, "right").astype("int32"))

    before = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")
    number = F.row_number().over(Window.orderBy("part")) - 1
    known = files.select("path", "bytes", "terminals", "tokens", before.alias("before"), number.alias("file"))
    wanted = wanted.where("length > 0").select("start", "length")
    last = place(F.col("start") + F.col("length") - 1)
    wanted = wanted.withColumn("file", F.explode(F.sequence(place("start"), last)))
    rows = wanted.join(known, "file").select("start", "length", "path", "bytes", "terminals", "tokens", "before")
    rows = rows.repartition("path")
    rows = rows.sortWithinPartitions("path", "start")
    names = ["start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, reader = None, None
        for batch in batches:
            out = []
            for start, length, name, size, terminals, tokens, before in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if name != path:
                    if reader:
                        reader.close()
                    path, reader = name, Reader(name, size, terminals)
                low = max(start, before)
                n = min(start + length, before + tokens) - low
                out.append((low, n, b"".join(reader.spans(low - before, n))))
            columns = zip(*out, strict=True) if out else [[]] * 3
            kinds = [pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        if reader:
            reader.close()

    return rows.mapInArrow(run, "start long, length long, ids binary")
