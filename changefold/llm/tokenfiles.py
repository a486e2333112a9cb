"""Token ids in binary files: one wavelet matrix per shard.

A file holds documents in order of their key, and their ids as bit planes from the highest bit down: every
plane holds one bit per token, the tokens sorted stably by the bits above, zeros first. With counts of
ones before every 512th bit, a token is read, counted or found by one rank or select per plane, and 16-bit
ids take little over two bytes each. Planes are compressed in frames of 64 KiB that open alone.

Layout, little-endian: magic, length of the JSON head, the head (documents, tokens, planes, zeros per plane,
place of each part), then the parts: keys, document ends, and per plane its frames, frame ends and ranks.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
import zstandard

from .chunks import BEFORE_BLANK, chunks
from .common import held, let_go, open_fs, pieces, put_file, tasks, written

MAGIC = b"WVMX0001"
BLOCK, FRAME = 512, 1 << 16  # bits per rank entry, bytes per compressed frame
STEP = 1 << 15  # tokens moved at a time, so that they and their places stay in the CPU's cache


def build(ids: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """Packed bit planes (highest first) and the zeros in each."""
    depth = max(1, int(ids.max(initial=0)).bit_length())
    narrow = np.uint16 if depth <= 16 else np.uint32
    current = ids.astype(narrow)
    ones = np.empty_like(current)
    planes, zeros = [], []
    for level in reversed(range(depth)):
        plane, low, high = np.empty(-(-len(ids) // 8), np.uint8), 0, 0
        for at in range(0, len(ids), STEP):
            own = current[at:at + STEP]
            bits = (own & narrow(1 << level)) != 0
            plane[at // 8:(at + STEP) // 8] = np.packbits(bits, bitorder="little")
            zero, one = own.take(np.flatnonzero(~bits)), own.take(np.flatnonzero(bits))
            current[low:low + len(zero)] = zero  # never beyond what has been read
            ones[high:high + len(one)] = one
            low, high = low + len(zero), high + len(one)
        current[low:] = ones[:high]
        planes.append(plane)
        zeros.append(low)
    return planes, zeros


def ranks_of(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of ``BLOCK`` bits."""
    step = BLOCK // 8
    padded = np.pad(plane, (0, -len(plane) % step)).reshape(-1, step)
    counts = np.bitwise_count(padded).sum(axis=1, dtype=np.uint32)
    return np.concatenate([[0], np.cumsum(counts, dtype=np.uint32)]).astype("<u4")


def to_file(keys: list, ids: list[np.ndarray]) -> bytes:
    """The bytes of a shard's file from its documents' keys (any JSON values) and ids."""
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    planes, zeros = build(flat)
    parts = [json.dumps(keys).encode(), np.cumsum([len(x) for x in ids], dtype=np.uint64).astype("<u8").tobytes()]
    squeeze = zstandard.ZstdCompressor(level=1)
    for plane in planes:
        frames = [squeeze.compress(plane[a:a + FRAME].tobytes()) for a in range(0, len(plane), FRAME)]
        parts += [b"".join(frames), np.cumsum([len(x) for x in frames], dtype=np.uint64).astype("<u8").tobytes(),
                  ranks_of(plane).tobytes()]
    places, at = [], 0
    for part in parts:
        places.append((at, len(part)))
        at += len(part)
    head = json.dumps({"documents": len(ids), "tokens": len(flat), "planes": len(planes), "zeros": zeros, "places": places}).encode()
    return b"".join([MAGIC, struct.pack("<Q", len(head)), head, *parts])


class Shard:
    """A shard's file, read by ranges: ``read(offset, length)``."""

    def __init__(self, read: Callable[[int, int], bytes]):
        if read(0, 8) != MAGIC:
            raise ValueError("not a token file")
        size = struct.unpack("<Q", read(8, 8))[0]
        head = json.loads(read(16, size))
        self.read, self.base = read, 16 + size
        self.documents, self.tokens, self.zeros, self.places = (head[k] for k in ("documents", "tokens", "zeros", "places"))
        self.keys = json.loads(self._part(0))
        self.ends = np.frombuffer(self._part(1), "<u8").astype(np.int64)
        self._frame_ends = [np.frombuffer(self._part(3 + 3 * p), "<u8").astype(np.int64) for p in range(head["planes"])]
        self._ranks = [np.frombuffer(self._part(4 + 3 * p), "<u4").astype(np.int64) for p in range(head["planes"])]
        self._open: dict[tuple[int, int], np.ndarray] = {}
        self._inflate = zstandard.ZstdDecompressor()

    def _part(self, i: int) -> bytes:
        at, length = self.places[i]
        return self.read(self.base + at, length) if length else b""

    def _frame(self, plane: int, frame: int) -> np.ndarray:
        if (plane, frame) not in self._open:
            if len(self._open) >= 1024:
                self._open.clear()
            ends = self._frame_ends[plane]
            start = int(ends[frame - 1]) if frame else 0
            data = self.read(self.base + self.places[2 + 3 * plane][0] + start, int(ends[frame]) - start)
            self._open[plane, frame] = np.frombuffer(self._inflate.decompress(data), np.uint8)
        return self._open[plane, frame]

    def _bit(self, plane: int, i: int) -> int:
        return int(self._frame(plane, i // 8 // FRAME)[i // 8 % FRAME]) >> i % 8 & 1

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, rest = divmod(i, BLOCK)
        ones = int(self._ranks[plane][block])
        if rest:
            start = block * BLOCK // 8
            own = self._frame(plane, start // FRAME)[start % FRAME:start % FRAME + BLOCK // 8]
            ones += int(np.bitwise_count(own[:rest // 8]).sum())
            if rest % 8:
                ones += (int(own[rest // 8]) & (1 << rest % 8) - 1).bit_count()
        return ones

    def access(self, i: int) -> int:
        """Token at position ``i``."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        token = 0
        for plane, zeros in enumerate(self.zeros):
            bit = self._bit(plane, i)
            ones = self._rank1(plane, i)
            i = zeros + ones if bit else i - ones
            token = token << 1 | bit
        return token

    def _run(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences within [start, end) stand below the last plane."""
        if token >> len(self.zeros):
            return 0, 0
        for plane, zeros in enumerate(self.zeros):
            a, b = self._rank1(plane, start), self._rank1(plane, end)
            one = token >> len(self.zeros) - 1 - plane & 1
            start, end = (zeros + a, zeros + b) if one else (start - a, end - b)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token at positions [start, end)."""
        a, b = self._run(token, start, self.tokens if end is None else end)
        return b - a

    def find(self, token: int, nth: int) -> int:
        """Position of the ``nth`` occurrence (from 0) of a token; -1 if there are fewer."""
        start, end = self._run(token, 0, self.tokens)
        if nth < 0 or start + nth >= end:
            return -1
        i = start + nth
        for plane in reversed(range(len(self.zeros))):
            one = token >> len(self.zeros) - 1 - plane & 1
            i = self._select(plane, one, i - self.zeros[plane] if one else i)
        return i

    def _select(self, plane: int, one: int, nth: int) -> int:
        """Position of the ``nth`` one (or zero) bit of a plane."""
        ranks = self._ranks[plane]
        before = ranks if one else np.arange(len(ranks), dtype=np.int64) * BLOCK - ranks
        block = int(np.searchsorted(before, nth, side="right")) - 1
        start = block * BLOCK // 8
        own = self._frame(plane, start // FRAME)[start % FRAME:start % FRAME + BLOCK // 8]
        bits = np.unpackbits(own, bitorder="little") == one
        return block * BLOCK + int(np.flatnonzero(bits)[nth - int(before[block])])

    def all(self) -> np.ndarray:
        """All tokens, by undoing the planes from the lowest up."""
        narrow = np.uint16 if len(self.zeros) <= 16 else np.uint32
        current, above = np.zeros(self.tokens, narrow), np.empty(self.tokens, narrow)
        for plane in reversed(range(len(self.zeros))):
            frames = [self._frame(plane, f) for f in range(len(self._frame_ends[plane]))]
            packed = np.concatenate(frames) if frames else np.zeros(0, np.uint8)
            value, low, high = narrow(1 << len(self.zeros) - 1 - plane), 0, self.zeros[plane]
            for at in range(0, self.tokens, STEP):
                own = above[at:at + STEP]
                bits = np.unpackbits(packed[at // 8:(at + STEP) // 8], count=len(own), bitorder="little").view(bool)
                zero, one = np.flatnonzero(~bits), np.flatnonzero(bits)
                own[zero] = current[low:low + len(zero)]
                own[one] = current[high:high + len(one)] | value
                low, high = low + len(zero), high + len(one)
            current, above = above, current
            self._open.clear()
        return current.astype(np.uint32)

    def document(self, i: int) -> list[int]:
        """Token ids of the ``i``-th document."""
        return [self.access(p) for p in range(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))]


# -- encoding ------------------------------------------------------------------------------------------

class Words:
    """Ids of words in Arrow arrays: different words and, in the same order, the bytes of their ids.

    ``encode(words)`` gives the ids of new ones. Of all, the ``room`` most frequent are kept, earlier counts
    weighing less and less, and very long ones aside.
    """

    def __init__(self, encode: Callable[[pa.Array], pa.Array], room: int, longest: int = 100):
        self.encode, self.room, self.longest = encode, room, longest
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.counts = np.zeros(0)

    def lookup(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The ids of different words, and which of them each word has."""
        if not len(words):
            return self.ids, np.zeros(0, np.int32)
        old = len(self.words)
        coded = pa.chunked_array([self.words, words]).dictionary_encode()
        coded = coded.chunk(coded.num_chunks - 1)  # one hash table for what is kept and for all words
        known, codes = coded.dictionary, coded.indices.to_numpy()
        ids = self.ids
        if len(known) > old:
            ids = pa.concat_arrays([ids, self.encode(known.slice(old))])
        counts = np.bincount(codes, minlength=len(known)).astype(float)
        counts[:old] += 0.7 * self.counts
        kept = np.flatnonzero(pc.binary_length(known).to_numpy() <= self.longest)
        if len(kept) > self.room:
            kept = np.sort(kept[np.argpartition(-counts[kept], self.room)[:self.room]])
        self.words, self.ids, self.counts = known.take(pa.array(kept)), ids.take(pa.array(kept)), counts[kept]
        return ids, codes


class LibraryEncoder:
    """Whole texts by the tokenizers library; words that texts share are given to it once.

    A batch is cut and its different chunks are found by Arrow, and stay there: no chunk becomes a Python object.
    New ones are encoded some hundreds together: those that hold only the blank in front as one text, told apart by
    the tokens that begin with a blank; the others with an added token between them, which the library cuts out
    before anything else.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        described = json.loads(content)
        added = described.get("added_tokens", [])
        plain = [t for t in added if not any(t.get(k) for k in ("single_word", "lstrip", "rstrip"))]
        if len(plain) != len(added) or not plain:
            raise ValueError("the vocabulary needs a plain added token, and no other kind")
        self.added = [t["content"] for t in plain]
        self.mark, self.mark_id = plain[0]["content"], plain[0]["id"]
        self.begins = _begins(described, self.added)
        top = max([*described["model"]["vocab"].values(), *(t["id"] for t in added)])
        self.narrow = np.uint16 if top < 1 << 16 else np.uint32
        self.memo = Words(lambda words: self._encode(words, " "), room=400_000)  # some 20 MB a worker
        self.first = Words(lambda words: self._encode(words, ""), room=50_000)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.narrow)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.narrow)

    def _encode(self, words: pa.Array, before: str) -> pa.Array:
        """The bytes of the ids of each word with ``before`` in front."""
        alone = _alone(words) if before and self.begins is not None else np.zeros(len(words), bool)
        own = np.flatnonzero(alone)
        flat, lengths = [], []
        for at, text in zip(range(0, len(own), TOGETHER), _joined(words.take(pa.array(own)), before)):
            part = own[at:at + TOGETHER]
            ids = self._ids(before + text)
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) == len(part):
                flat.append(ids)
                lengths.append(np.diff(starts, append=len(ids)))
            else:
                alone[part] = False
        own, rest = np.flatnonzero(alone), np.flatnonzero(~alone)
        for text in _joined(words.take(pa.array(rest)), self.mark + before):
            ids = self._ids(before + text)
            cuts = np.flatnonzero(ids == self.mark_id)
            flat.append(np.delete(ids, cuts))
            lengths.append(np.diff(cuts, prepend=-1, append=len(ids)) - 1)
        made = _blobs(flat, lengths, self.narrow)
        if not len(own) or not len(rest):
            return made
        place = np.empty(len(words), np.int64)
        place[np.concatenate([own, rest])] = np.arange(len(words))
        return made.take(pa.array(place))

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        column = column.cast(pa.large_string())  # chunks of a batch may have more than 2 GB of text
        size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        whole = np.zeros(len(column), bool)
        for a in self.added:
            whole |= pc.fill_null(pc.match_substring(column, a), False).to_numpy(zero_copy_only=False)
        odd = pc.fill_null(pc.match_substring_regex(column, BEFORE_BLANK), False).to_numpy(zero_copy_only=False)
        made = [np.zeros(0, self.narrow)] * len(column)
        for i in np.flatnonzero(whole).tolist():
            made[i] = self._whole(column[i].as_py())
        plain, odd = (np.flatnonzero(rows & ~whole & (size > 0)) for rows in (~odd, odd))
        if len(plain):
            self._place(made, plain, pc.split_pattern(column.take(pa.array(plain)), " "))
        if len(odd):
            self._place(made, odd, pa.array([chunks(t) for t in column.take(pa.array(odd)).to_pylist()], pa.large_list(pa.large_string())))
        return made

    def _place(self, made: list[np.ndarray], rows: np.ndarray, lists: pa.Array) -> None:
        """Put the ids of texts, given by their chunks (one at least), at their rows."""
        words = lists.flatten()
        sizes = pc.list_value_length(lists).to_numpy()
        ends = np.cumsum(sizes)
        first = ends - sizes
        spaced = np.ones(len(words), bool)
        spaced[first] = False
        values, own = self.memo.lookup(words.filter(pa.array(spaced)))
        begun, begin = self.first.lookup(words.take(pa.array(first)))
        codes = np.empty(len(words), np.int32)
        codes[spaced] = own
        codes[first] = len(values) + begin
        found = pa.concat_arrays([values, begun]).take(pa.array(codes))
        ids = np.frombuffer(found.buffers()[2] or b"", self.narrow)
        cuts = (_offsets(found)[ends] // ids.itemsize).tolist()
        for row, a, b in zip(rows.tolist(), [0, *cuts], cuts):
            made[row] = ids[a:b]


#: Words given to the library as one text: more cost it more memory and time a word.
TOGETHER = 300


def _offsets(column: pa.Array) -> np.ndarray:
    """Where the values of a large string or binary column begin, and where the last ends."""
    return np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)


def _alone(words: pa.Array) -> np.ndarray:
    """Which words hold no blank and do not end in white space."""
    offsets, size = _offsets(words), pc.binary_length(words).to_numpy()
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    last = np.zeros(len(words), np.uint8)
    last[size > 0] = data[offsets[1:][size > 0] - 1]
    for i in np.flatnonzero(last >= 0x80).tolist():  # the only white space of several bytes may be here
        last[i] = 0 if words[i].as_py()[-1].isspace() else last[i]
    return (last > 0x20) & ~pc.match_substring(words, " ").to_numpy(zero_copy_only=False)


def _joined(words: pa.Array, between: str) -> Iterable[str]:
    """The words as texts of ``TOGETHER`` each."""
    cuts = pa.array([*range(0, len(words), TOGETHER), len(words)], pa.int64())
    lists = pa.LargeListArray.from_arrays(cuts, words)
    return pc.binary_join(lists, pa.scalar(between, pa.large_string())).to_pylist()


def _blobs(flat: list[np.ndarray], lengths: list[np.ndarray], narrow: type) -> pa.Array:
    """Runs of ids, given by their lengths, as bytes in an Arrow array."""
    ends = np.cumsum(np.concatenate([[0], *lengths]), dtype=np.int64) * np.dtype(narrow).itemsize
    data = np.concatenate([np.zeros(0, narrow), *flat])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _begins(described: dict, added: list[str]) -> np.ndarray | None:
    """Which ids begin with a blank, for vocabularies whose pre-splitter leaves a blank in front of what follows."""
    splitter = described.get("pre_tokenizer") or {}
    known = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
    if not known or described.get("normalizer") or any(" " in a for a in added):
        return None
    vocab = described["model"]["vocab"]
    begins = np.zeros(1 + max([*vocab.values(), *(t["id"] for t in described["added_tokens"])]), bool)
    begins[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True
    return begins


def encoder(content: str) -> LibraryEncoder:
    return held(("library", content), lambda: LibraryEncoder(content))


# -- Spark ---------------------------------------------------------------------------------------------

SHARD_ROWS = StructType([
    StructField("part", IntegerType()), StructField("seq", IntegerType()), StructField("path", StringType()),
    StructField("documents", LongType()), StructField("tokens", LongType()),
])


def write_token_files(docs: DataFrame, content, folder: str, key: str = "doc_id", text: str = "text",
                      end_id: int | None = 2, shard_tokens: int = 1 << 22, parts: int | None = None) -> DataFrame:
    """Write the ids of all whole texts in ascending order of the key; returns the shards in order.

    ``content`` is a broadcast vocabulary file. Documents are dealt by ranges of the key (and, within one
    key, of the text's hash, so a key with a third of the rows is dealt too), sorted by Spark, encoded
    with ``end_id`` after each document, and cut into shards of about ``shard_tokens``; a document is never
    cut. NULL texts are empty; NULL keys come first; rows with one key stand in order of their text's
    hash; an empty table gives no shard. Files of lost or repeated tasks are not in the result.
    """
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(parts or tasks(docs.sparkSession), "key", "tie").sortWithinPartitions("key", "tie")

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        own, keys, ids, held, seq = encoder(content.value), [], [], 0, 0
        tail = np.array([] if end_id is None else [end_id], own.narrow if end_id is None or end_id < 1 << 16 else np.uint32)

        def close():
            path = put_file(folder, f"tokens-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.wm", [to_file(keys, ids)])
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [path],
                "documents": [len(keys)], "tokens": [held]})

        for batch in (piece for whole in batches for piece in pieces(whole, 2, 16 << 20)):
            for own_key, found in zip(batch.column(0).to_pylist(), own.encode(batch.column(2))):
                keys.append(own_key)
                ids.append(np.concatenate([found, tail]))
                held += len(ids[-1])
                if held >= shard_tokens:
                    yield close()
                    keys, ids, held, seq = [], [], 0, seq + 1
        if keys:
            yield close()

    return written(rows.mapInArrow(run, SHARD_ROWS), "token-shards")


def read_token_files(shards: DataFrame, key_type: str = "long") -> DataFrame:
    """(``key``, ``start``, ``token_ids``, ``ids_crc32``) of every document from the shards' files.

    ``start`` counts the ids of all documents before; the running sum goes over shards, one row each.
    """
    # one row per file of millions of tokens, whatever the number of documents
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("path", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("base"))

    def run(batches: Iterable[pa.RecordBatch]):
        let_go()  # a worker that wrote files still has the encoder and its memo
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, own = open_fs(path)
                with system.open_input_file(own) as file:
                    shard = Shard(lambda at, n: file.read_at(n, at))
                    flat = shard.all().astype("<u4", copy=False)
                ends = shard.ends.tolist()
                starts = [0, *ends[:-1]]
                for at in range(0, len(ends), 1000):
                    spans = list(zip(starts[at:at + 1000], ends[at:at + 1000]))
                    a, b = spans[0][0], spans[-1][1]
                    offsets = pa.array([x - a for x, _ in spans] + [b - a], pa.int32())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard.keys[at:at + 1000]).cast(KEYS[key_type]),
                        pa.array([base + x for x, _ in spans], pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(flat[a:b].view(np.int32))),
                        pa.array([zlib.crc32(flat[x:y].tobytes()) for x, y in spans], pa.int64()),
                    ], names=["key", "start", "token_ids", "ids_crc32"])

    schema = StructType([
        StructField("key", LongType() if key_type == "long" else StringType()), StructField("start", LongType()),
        StructField("token_ids", ArrayType(IntegerType())), StructField("ids_crc32", LongType())])
    return placed.repartition(max(1, shards.count()), "path").mapInArrow(run, schema)


KEYS = {"long": pa.int64(), "string": pa.string()}
