"""Token ids of a corpus in compressed, checksummed binary files.

Documents are range-sorted by ``doc_id``; every task tokenises its range, appends the end id to each
document and writes blocks of ids coded by ``rangecoder`` (each block starts with a fresh model and
carries a CRC of its payload). Files are sealed under the hash of their content and listed in a
manifest, with the number of ids before each, so a reader finds every document's place.

Tokenising. The tokenizer splits at white space before it merges, so the ids of a text are those of
its white-space-separated pieces in order. A Python worker keeps the ids of pieces that its tasks have met (by
64-bit hash, a bounded table) and asks the tokenizer for new pieces only. Pieces are also cut where
an ASCII letter or digit is followed by ASCII punctuation, which the tokenizer's pattern always
separates; a chunk that holds ``<|`` (special tokens) is cut at white space only. Where the tokenizer lower-cases
texts, pieces of ASCII alone are lower-cased first, so that one entry serves all their spellings. Another tokenizer
than one with these properties needs ``by_word=False``, which passes whole texts.

Defined cases: a null or empty text is the end id alone; rows that repeat a ``doc_id`` are documents
of their own, in the order of their texts' hashes; a null ``doc_id`` sorts first; an empty table
gives an empty manifest and no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastemap.llm import rangecoder
from tastemap.llm import words as W
from tastemap.llm import workers
from tastemap.llm.files import Checked, SealedFile, new_folder, open_fs

END_ID = 2
KNOWN_PIECES = 1_600_000
KNOWN_IDS = 1 << 24
CHUNK_BYTES = 500_000
ROLL_BYTES = 512 << 20
NO_ID = -(1 << 63)
MAGIC = b"TIDS0001"
HEAD = struct.Struct("<IIIII")  # ids, payload bytes, payload CRC, index bytes, index CRC

ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True
# ASCII letters, and the bytes of U+00C0..U+00FF but for the two that are no letters: texts of these
# alone are one word to the tokenizer
LETTER = ALNUM.copy()
LETTER[0x30:0x3A] = False
LETTER[0xC3] = LETTER[0x80:0xC0] = True
LETTER[[0x97, 0xB7]] = False
PUNCT = np.zeros(256, bool)
PUNCT[0x21:0x7F] = True
PUNCT &= ~ALNUM


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Pieces:
    """Ids of pieces by 64-bit hash (never 0): an open-addressing table, searched for many at a time. It holds the
    place of each piece in ``pool``, where the number of its ids stands before them."""

    END = 1  # place of the end id, which is no piece

    def __init__(self, end_id: int):
        self.known = 0
        self._slots(1 << 16)
        self.pool, self.used = np.empty(1 << 18, np.int32), 3
        self.pool[:3] = 0, 1, end_id

    def _slots(self, n: int) -> None:
        self.key, self.place = np.zeros(n, np.uint64), np.zeros(n, np.uint32)
        self.by = np.uint64(64 - (n.bit_length() - 1))

    def find(self, key: np.ndarray) -> np.ndarray:
        """Place of every key; 0 where it is not known."""
        at = (key >> self.by).view(np.int64)
        got = self.key.take(at)
        out = self.place.take(at) * (got == key)
        live = np.flatnonzero((got != key) & (got != 0))
        at = at.take(live)
        while len(live):
            at = (at + 1) & (len(self.key) - 1)
            got, want = self.key.take(at), key.take(live)
            hit = np.flatnonzero(got == want)
            out[live.take(hit)] = self.place.take(at.take(hit))
            go = np.flatnonzero((got != want) & (got != 0))
            live, at = live.take(go), at.take(go)
        return out.astype(np.int64)

    def _put(self, key: np.ndarray, place: np.ndarray) -> None:
        at = (key >> self.by).view(np.int64)
        while len(key):
            free = np.flatnonzero(self.key.take(at) == 0)
            self.key[at.take(free)] = key.take(free)  # of several keys for one slot the last stays
            mine = self.key.take(at) == key
            self.place[at[mine]] = place[mine]
            key, place, at = key[~mine], place[~mine], (at[~mine] + 1) & (len(self.key) - 1)

    def add(self, key: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """New, different keys, the ids of all their pieces one after the other, and the number of each."""
        place = self.used + np.cumsum(n + 1) - (n + 1)
        end = self.used + len(ids) + len(n)
        if end > len(self.pool):
            pool = np.empty(2 * end, np.int32)
            pool[: self.used] = self.pool[: self.used]
            self.pool = pool
        number = np.zeros(end - self.used, bool)
        number[place - self.used] = True
        added = self.pool[self.used : end]
        added[number], added[~number] = n, ids
        self.used = end
        self.known += len(key)
        place = place.astype(np.uint32)
        if 5 * self.known > 4 * len(self.key):
            held = np.flatnonzero(self.key)
            key, place = np.concatenate([self.key[held], key]), np.concatenate([self.place[held], place])
            slots = len(self.key)
            while 5 * self.known > 4 * slots:
                slots *= 2
            self._slots(slots)
        self._put(key, place)


def lowers(tokenizer: str) -> bool:
    """Whether a tokenizer (its JSON) lower-cases texts, and before that changes no ASCII text but for its white space."""
    steps = json.loads(tokenizer).get("normalizer") or {}
    steps = steps.get("normalizers", [steps])
    harmless = [x.get("type") in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") or (x.get("type"), x.get("pattern")) == ("Replace", {"Regex": r"\s+"}) for x in steps]
    return all(harmless) and any(x.get("type") == "Lowercase" for x in steps)


class Tokens:
    """Tokenises chunks of texts; one per task."""

    def __init__(self, path: str, by_word: bool = True):
        # a task has one core; threads of the tokenizer's own would also keep memory each
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.vocab = self.tok.get_vocab_size()
        self.by_word = by_word
        self.lowers = lowers(self.tok.to_str())
        self.ends = np.zeros(self.vocab, bool)
        for s, i in self.tok.get_vocab().items():
            self.ends[i] = s.endswith("</w>")
        self.pieces = Pieces(END_ID)

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, key: np.ndarray, pieces: list[bytes], simple: np.ndarray) -> None:
        """Add pieces with their ids. Plain letter pieces are tokenised many at a time: each ends
        with its one word-final id."""
        plain, rest = np.flatnonzero(simple), np.flatnonzero(~simple).tolist()
        for i in range(0, len(plain), 4096):
            part = plain[i : i + 4096]
            lines = [b" ".join([pieces[k] for k in part[j : j + 512]]).decode() for j in range(0, len(part), 512)]
            got = np.concatenate([np.array(x, np.int32) for x in self._raw(lines)])
            cut = np.flatnonzero(self.ends[got]) + 1
            if len(cut) == len(part) and cut[-1] == len(got):
                self.pieces.add(key[part], got, np.diff(cut, prepend=0))
            else:
                rest.extend(part.tolist())
        if rest:
            raw = self._raw([pieces[k].decode() for k in rest])
            self.pieces.add(key[rest], np.concatenate([np.array(x, np.int32) for x in raw]), np.array([len(x) for x in raw], np.int64))

    def _lowered(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """``buf`` with the pieces of ASCII alone in lower case."""
        high = np.concatenate([[0], np.cumsum(buf >= 128, dtype=np.int32)])
        out = W.LOWER[buf]
        if high[-1]:
            kept = np.flatnonzero(high[ends] > high[starts])
            n = ends[kept] - starts[kept]
            at = np.repeat(starts[kept] - np.cumsum(n) + n, n) + np.arange(n.sum())
            out[at] = buf[at]
        return out

    def chunk(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with the end id after each, number of ids of each text)."""
        rows = len(off) - 1
        raw = buf.tobytes()
        if not self.by_word:
            parts = self._raw([raw[off[i] : off[i + 1]].decode() for i in range(rows)])
            n = np.array([len(p) + 1 for p in parts], np.int64)
            return np.concatenate([np.array([*p, END_ID], np.int32) for p in parts]), n
        special = b"<|" in raw
        starts, ends, first = W.split_words(buf, off, cuts=None if special else (ALNUM, PUNCT))
        if not len(starts):
            return np.full(rows, END_ID, np.int32), np.ones(rows, np.int64)
        if self.lowers and not special:
            buf = self._lowered(buf, starts, ends)
            raw = buf.tobytes()
        h = W.word_hashes(buf, starts, ends)
        h[h == 0] = 1
        if self.pieces.known > KNOWN_PIECES or self.pieces.used > KNOWN_IDS:
            self.pieces = Pieces(END_ID)
        place = self.pieces.find(h)
        unknown = np.flatnonzero(place == 0)
        if len(unknown):
            key, new = np.unique(h.take(unknown), return_index=True)
            new = unknown[new]
            letters = np.concatenate([[0], np.cumsum(LETTER[buf])])
            simple = letters[ends[new]] - letters[starts[new]] == ends[new] - starts[new]
            self._learn(key, [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)], simple)
            place[unknown] = self.pieces.find(h.take(unknown))
        place = np.insert(place, first[1:], Pieces.END)
        n = self.pieces.pool.take(place).astype(np.int64)
        total = np.cumsum(n)
        src = np.repeat(place + 1 - (total - n), n)
        src += np.arange(len(src))
        return self.pieces.pool.take(src), np.diff(total[first[1:] + np.arange(rows)], prepend=0)


def worker_tokens(path: str, by_word: bool) -> Tokens:
    """One table of known pieces for all tasks of this operator that a Python worker runs."""
    held = workers.kept("tokens")
    if (path, by_word) not in held:
        held[path, by_word] = Tokens(path, by_word)
    return held[path, by_word]


class Writer:
    """Cuts a stream of documents into coded blocks; a document may span blocks and is indexed in
    the block where it ends."""

    def __init__(self, folder: str, vocab: int):
        self.out, self.vocab = SealedFile(folder), vocab
        self.out.write(MAGIC + struct.pack("<I", vocab))
        self.ids: list[np.ndarray] = []
        self.held = self.written = self.docs = 0
        self.index: list[tuple[np.ndarray, np.ndarray]] = []  # (doc ids, end positions)
        self.first = None

    def add(self, doc_id: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
        at = self.written + self.held
        if self.first is None:
            self.first = int(doc_id[0])
        self.index.append((doc_id, at + np.cumsum(n)))
        self.docs += len(doc_id)
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= rangecoder.BLOCK:
            all_ids = np.concatenate(self.ids)
            full = len(all_ids) // rangecoder.BLOCK * rangecoder.BLOCK
            for i in range(0, full, rangecoder.BLOCK):
                self._block(all_ids[i : i + rangecoder.BLOCK])
            self.ids, self.held = [all_ids[full:]], len(all_ids) - full

    def _block(self, ids: np.ndarray) -> None:
        payload = rangecoder.encode(ids, self.vocab)
        self.written += len(ids)
        doc = np.concatenate([d for d, _ in self.index]) if self.index else np.zeros(0, np.int64)
        end = np.concatenate([e for _, e in self.index]) if self.index else np.zeros(0, np.int64)
        k = int(np.searchsorted(end, self.written, "right"))
        self.index = [(doc[k:], end[k:])]
        index = zlib.compress(doc[:k].astype("<i8").tobytes() + end[:k].astype("<i8").tobytes(), 1)
        self.out.write(HEAD.pack(len(ids), len(payload), zlib.crc32(payload), len(index), zlib.crc32(index)) + payload + index)

    def close(self, part: int, seq: int) -> pa.RecordBatch:
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int32)
        if len(ids):
            self._block(ids)
        name, size, digest = self.out.seal(f"ids-{part:06d}-{seq:04d}", ".tids")
        row = {"name": name, "part": part, "seq": seq, "docs": self.docs, "ids": self.written, "bytes": size, "sha256": digest}
        return pa.RecordBatch.from_pylist([row], pa.schema([(k, pa.string() if k in ("name", "sha256") else pa.int64()) for k in row]))


def write(docs: DataFrame, tokenizer: str | None = None, folder: str | None = None, by_word: bool = True, roll_bytes: int = ROLL_BYTES) -> str:
    """Write the ids of ``docs`` (doc_id, text); returns the folder with its committed manifest."""
    spark = docs.sparkSession
    path, folder = tokenizer or default_tokenizer(), folder or new_folder(spark, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        tok, out = None, None
        for batch in batches:
            tok = tok or worker_tokens(path, by_word)
            buf, off = W.text_bytes(batch.column("text"))
            doc = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for i, j in W.chunks(off, CHUNK_BYTES):
                out = out or Writer(folder, tok.vocab)
                ids, n = tok.chunk(buf[off[i] : off[j]], off[i : j + 1] - off[i])
                out.add(doc[i:j], n, ids)
                if out.out.size >= roll_bytes:
                    yield out.close(part, seq)
                    out, seq = None, seq + 1
        if out:
            yield out.close(part, seq)

    manifest = ranged.mapInArrow(workers.tidy(task, "tokens"), "name string, part long, seq long, docs long, ids long, bytes long, sha256 string")
    # one small row per file
    manifest.repartition(1).write.parquet(f"{folder}/manifest")
    return folder


def blocks(stream) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, doc ids, end positions) of every block of a file; bounded by one block."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    (vocab,) = struct.unpack("<I", stream.read(4))
    while head := stream.read(HEAD.size):
        n, size, crc, index_size, index_crc = HEAD.unpack(head)
        payload, index = stream.read(size), stream.read(index_size)
        if zlib.crc32(payload) != crc or zlib.crc32(index) != index_crc:
            raise ValueError("damaged block")
        flat = np.frombuffer(zlib.decompress(index), "<i8")
        yield rangecoder.decode(payload, n, vocab), flat[: len(flat) // 2], flat[len(flat) // 2 :]


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the manifest's files."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    # one row per file: the prefix sums are over a table of file names
    before = F.sum("ids").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("before", F.coalesce(before, F.lit(0)))
    files = files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        for batch in batches:
            for f in batch.to_pylist():
                with fs.open_input_stream(f"{root}/{f['name']}", compression=None) as raw:
                    stream, at, done, crc = Checked(raw), 0, 0, 0
                    for ids, doc, end in blocks(stream):
                        data = memoryview(ids.astype("<u4").tobytes())
                        out = np.zeros(len(doc), np.int64)
                        begin = np.concatenate([[done], end[:-1]]) if len(end) else end
                        here = 0
                        for k, e in enumerate((end - at).tolist()):
                            out[k] = zlib.crc32(data[4 * here : 4 * e], crc)
                            here, crc = e, 0
                        crc = zlib.crc32(data[4 * here :], crc)
                        at += len(ids)
                        if len(doc):
                            done = int(end[-1])
                            yield pa.record_batch(
                                {"doc_id": pa.array(doc, mask=doc == NO_ID), "start": pa.array(f["before"] + begin), "n_tokens": pa.array(end - begin), "ids_crc32": pa.array(out)}
                            )
                    if (stream.size, at, stream.sha.hexdigest()) != (f["bytes"], f["ids"], f["sha256"]):
                        raise ValueError(f"{f['name']} differs from the manifest")

    return files.mapInArrow(workers.tidy(task), "doc_id long, start long, n_tokens long, ids_crc32 long")


def report(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The query's columns."""
    return read(docs.sparkSession, write(docs, tokenizer))
