"""Token-ID output: flat unsigned integer files with 64-bit document offsets, read through memory maps.

Layout of a written corpus, one folder:

- ``shard-P-U.ids``: the ids of partition P as little-endian unsigned integers, of 16 bits where the vocabulary fits and else 32, one document after another, each
  ended by the end id; U tells attempts of a task apart, so a retried or speculative task never touches another's file.
- ``shard-P-U.off``: little-endian unsigned 64-bit offsets into the shard's ids, one for each document and one for the end.
- ``shard-P-U.doc``: little-endian signed 64-bit document ids (a null id is the least integer).
- ``index.json``: the shards in order with their base, the number of ids in all shards before; bases are prefix sums of
  the counts that the tasks report, a row for each shard, never for each document.

Documents lie in ascending doc_id order over the shards (null first; rows of one doc_id by a hash of the text, then by
the text). A null text is an empty one and has the end id alone; repeated rows are kept; an empty table has no shards.
Columns other than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import clean_text, shared_dir, shuffle_parts
from linkloom.llm.textarrays import frugal, slices

NO_ID = np.iinfo(np.int64).min
#: Parts of a generation whose ids a worker remembers, and the bytes of the longest one remembered: about 200 bytes each.
REMEMBERED, SHORT = 250_000, 64


def is_local(url: str) -> bool:
    return urlparse(url).scheme in ("", "file")


def local(url: str) -> str:
    return unquote(urlparse(url).path) if urlparse(url).scheme else url


def sink(url: str):
    """A binary stream to a file of a mounted folder or of any store that pyarrow can write."""
    if is_local(url):
        os.makedirs(os.path.dirname(local(url)), exist_ok=True)
        return open(local(url), "wb")  # noqa: SIM115
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(url)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path)


def mapped(url: str, kind: str) -> np.ndarray:
    """A memory map of the file, or its content where the store is remote."""
    if is_local(url):
        return np.memmap(local(url), kind, "r") if os.path.getsize(local(url)) else np.zeros(0, kind)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(url)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def _table(codes: list[int] | range | bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes)] = True
    return out


_LETTER = _table([*range(65, 91), *range(97, 123)])
_WHITE = _table([*range(9, 14), *range(28, 33)])
_MARK = _table(b",.;:!?|)")
#: White space, and the lead bytes of characters that may be white space.
_UNSURE = _WHITE | _table([0xC2, 0xE1, 0xE2, 0xE3])
_PLAIN = ~_WHITE & (np.arange(256) < 128)


def byte_alphabet() -> str:
    """The character that a byte-level vocabulary writes for each byte: the printable ones of Latin-1 for themselves, the
    others, in order, from U+0100 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(rest)) for b in range(256))


_ALPHABET = byte_alphabet()


class Encoder:
    """Ids of texts by a vocabulary file of the tokenizers library.

    A byte-level vocabulary (byte_level()) cuts a text into words before it merges, so texts can be cut wherever a word ends
    for certain: before a blank that a non-blank follows, between an ASCII letter and a punctuation mark, and behind a lone
    line feed before an ASCII letter. Parts are compared byte by byte (dictionary encoding), the library encodes each one that
    is not remembered, and a memory of bounded size (two generations of REMEMBERED short parts) keeps its ids. A text that holds an
    added token's string is one part. Any other vocabulary encodes whole texts.
    """

    def __init__(self, path: str, kind: str = "<u4"):
        from tokenizers import Tokenizer

        self.library, self.kind = Tokenizer.from_file(path), kind
        self.parted = byte_level(json.loads(self.library.to_str()))
        self.model = self.library.model
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.special = [x.content.encode() for x in self.library.get_added_tokens_decoder().values()]
        self.line = self.library.encode("\n", add_special_tokens=False).ids

    def alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, parts: list[bytes]) -> list[bytes]:
        """Words of Latin letters, with or without a blank in front, go to the library's merges straight away, as they are one word
        to the library too; other parts without white space are encoded many to a text, a line for each.
        """
        out: list[bytes] = [b""] * len(parts)
        raw, end = b"".join(parts), np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        direct = self.words(np.frombuffer(raw, np.uint8), end) if self.parted and parts else np.zeros(len(parts), bool)
        written, tokenize, size = raw.decode("latin-1").translate(_ALPHABET), self.model.tokenize, np.dtype(self.kind).itemsize
        some, at = np.flatnonzero(direct).tolist(), np.append(0, end)[:-1]
        ids = [[x.id for x in tokenize(written[i:j])] for i, j in zip(at[direct].tolist(), end[direct].tolist(), strict=True)]
        flat = np.fromiter(chain.from_iterable(ids), self.kind).tobytes()
        to = (np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) * size).tolist()
        for i, x, y in zip(some, [0, *to], to, strict=False):
            out[i] = flat[x:y]
        text = {i: parts[i].decode() for i in np.flatnonzero(~direct).tolist()}
        plain = [i for i, t in text.items() if self.parted and len(self.line) == 1 and len(t) < 1000 and (t[1:] or t).isprintable() and " " not in t[1:] and not t.isspace()]
        for a in range(0, len(plain), 2000):
            some = plain[a : a + 2000]
            ids = np.array(self.library.encode_batch_fast(["\n".join([text[i] for i in some])], add_special_tokens=False)[0].ids, self.kind)
            raw, cut = ids.tobytes(), (np.flatnonzero(ids == self.line[0]) * ids.itemsize).tolist()
            got = [raw[i:j] for i, j in zip([0, *(x + ids.itemsize for x in cut)], [*cut, len(raw)], strict=True)]
            for i, x in zip(some, got if len(got) == len(some) else self.alone([text[i] for i in some]), strict=True):
                out[i] = x
        once = set(plain)
        rest = [i for i in text if i not in once]
        for i, x in zip(rest, self.alone([text[i] for i in rest]), strict=True):
            out[i] = x
        return out

    @staticmethod
    def words(data: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which parts are letters of ASCII or Latin-1, a blank in front allowed, and not too long."""
        begin = np.append(0, end[:-1])
        lead = np.append(data, 0)[:-1] == 0xC3
        letter = _LETTER[data] | lead
        letter[1:] |= lead[:-1] & (data[1:] != 0x97) & (data[1:] != 0xB7)  # the signs of multiplication and division
        blank = data[begin] == 32
        letter[begin[blank]] = True
        return np.logical_and.reduceat(letter, begin) & (end - begin > blank) & (end - begin < 1000)

    def cuts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where parts begin."""
        c = np.zeros(len(data) + 1, bool)
        if len(data) > 2 and self.parted:
            c[:-2] = (data[:-1] == 32) & ~_UNSURE[data[1:]]
            c[off[1:-1] - 1] = False
            c[1:-1] |= _LETTER[data[:-1]] & _MARK[data[1:]]
            line = (data[1:-1] == 10) & _LETTER[data[2:]] & _PLAIN[data[:-2]]
            line[np.minimum(off[:-1], len(line))[1:] - 1] = False  # a line feed that begins its text
            c[2:-1] |= line
        raw = data.tobytes()
        for x in self.special:
            at = raw.find(x)
            while at >= 0:
                d = np.searchsorted(off, at, "right")
                c[off[d - 1] : off[d]] = False
                at = raw.find(x, at + 1)
        c[off[:-1][np.diff(off) > 0]] = True
        return np.flatnonzero(c[:-1])

    def __call__(self, data: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id behind it, and the number of each text's ids."""
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, {}
        at = self.cuts(data, off)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)])
        parts = parts.dictionary_encode()
        code, keys = parts.indices.to_numpy(), parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        before = self.before
        found = list(map(self.known.get, keys))
        lost = [i for i, x in enumerate(found) if x is None]
        for i in lost:
            found[i] = before.get(keys[i])
        new = [i for i in lost if found[i] is None]
        for i, x in zip(new, self.encode([keys[i] for i in new]), strict=True):
            found[i] = x
        self.known.update((keys[i], found[i]) for i in lost if len(keys[i]) <= SHORT)
        flat = np.frombuffer(b"".join(found), self.kind)
        size = np.fromiter(map(len, found), np.int64, len(found)) // np.dtype(self.kind).itemsize
        begin = np.append(0, np.cumsum(size))[:-1]
        n = size[code]
        total = np.append(0, np.cumsum(n))
        per_text = np.diff(total[np.searchsorted(at, off)])
        out = np.full(total[-1] + len(per_text), end_id, self.kind)
        out[np.arange(total[-1]) + np.repeat(np.arange(len(per_text)), per_text)] = flat[np.repeat(begin[code] - total[:-1], n) + np.arange(total[-1])]
        return out, per_text + 1


def byte_level(spec: dict) -> bool:
    """Whether a vocabulary (its JSON document) merges bytes within the words of the usual byte-level expression, and does nothing else."""
    words, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    plain = not (model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or spec.get("normalizer") or spec.get("truncation") or spec.get("padding"))
    return plain and model.get("type") == "BPE" and words.get("type") == "ByteLevel" and words.get("use_regex") is True and not words.get("add_prefix_space")


def id_type(vocabulary: str) -> str:
    """Two bytes where all ids fit, else four; little-endian."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(vocabulary).get_vocab_size() <= 1 << 16 else "<u4"


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every whole text and writes the corpus to the folder (layout above)."""
    spark, kind = docs.sparkSession, id_type(vocabulary)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]
    rows = rows.repartitionByRange(shuffle_parts(spark), *order[:2]).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = Encoder(vocabulary, kind)  # the task's own, and gone with it before memory is handed back; one of the module would be copied for each task too
        shard, stem = TaskContext.get().partitionId(), None
        ids = offsets = names = None
        at = n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if stem is None:
                stem = f"shard-{shard:06d}-{uuid.uuid4().hex[:12]}"
                ids, offsets, names = (sink(f"{folder}/{stem}.{x}") for x in ("ids", "off", "doc"))
                offsets.write(np.zeros(1, "<u8").tobytes())
            names.write(np.asarray(batch.column(0).fill_null(NO_ID), "<i8").tobytes())
            for _, data, off in slices(batch.column(1), 3 << 20):
                got, lengths = use(data, off, end_id)
                ends = at + np.cumsum(lengths)
                at = int(ends[-1])
                ids.write(got.tobytes())
                offsets.write(ends.astype("<u8").tobytes())
            n += batch.num_rows
        if stem is not None:
            for f in (ids, offsets, names):
                f.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "stem": [stem], "n_docs": [n], "n_ids": [at]})

    made = rows.mapInArrow(frugal(encode), "shard long, stem string, n_docs long, n_ids long").collect()  # a row for each shard
    base, shards = 0, []
    for r in sorted(made):
        shards.append({"stem": r.stem, "base": base, "n_docs": r.n_docs, "n_ids": r.n_ids})
        base += r.n_ids
    with sink(f"{folder}/index.json") as f:
        f.write(json.dumps({"ids": kind, "offsets": "<u8", "end_id": end_id, "n_ids": base, "shards": shards}).encode())


def read_index(folder: str) -> dict:
    return json.loads(bytes(mapped(f"{folder}/index.json", "u1")))


def read_ids(spark: SparkSession, folder: str, schema: str, each: Callable[[np.ndarray], dict]) -> DataFrame:
    """A row for each document of a written corpus: doc_id, start, n_tokens and what each() makes of its ids."""
    index = read_index(folder)
    shards, width = [(x["stem"], x["base"]) for x in index["shards"]], index["ids"]
    names = [x.split()[0] for x in schema.split(",")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for stem, base in (x for f in frames for x in f.itertuples(index=False)):
            ids, off, doc = (mapped(f"{folder}/{stem}.{x}", kind) for x, kind in (("ids", width), ("off", "<u8"), ("doc", "<i8")))
            for a in range(0, len(doc), 10_000):
                o = off[a : a + 10_001].astype(np.int64)
                d = pd.Series(doc[a : a + 10_000], dtype="Int64")
                found = [each(ids[i:j]) for i, j in zip(o[:-1], o[1:], strict=True)]
                yield pd.DataFrame({"doc_id": d.mask(d == NO_ID), "start": base + o[:-1], "n_tokens": np.diff(o)} | {k: [x[k] for x in found] for k in names})

    table = spark.createDataFrame(spark.sparkContext.parallelize(shards, max(1, len(shards))), "stem string, base long")
    return table.mapInPandas(frugal(read), f"doc_id long, start long, n_tokens long, {schema}")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/token-ids-{uuid.uuid4().hex}"


def token_id_output(docs: DataFrame, vocabulary: str, folder: str | None = None, end_id: int = 0) -> DataFrame:
    """Writes the corpus and reads it back: doc_id, start, n_tokens, ids_crc32 (of the little-endian ids, unsigned)."""
    folder = folder or new_folder(docs.sparkSession)
    write_ids(docs, folder, vocabulary, end_id)
    return read_ids(docs.sparkSession, folder, "ids_crc32 long", lambda ids: {"ids_crc32": zlib.crc32(np.ascontiguousarray(ids, "<u4").data)})


__all__ = ["read_ids", "read_index", "token_id_output", "write_ids"]
