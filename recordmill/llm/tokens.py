"""Token files: texts as ids of a public tokenizer, Huffman-coded in files that follow the order of doc_id.

A file holds a zlib-packed table of code lengths, independent blocks of ids, a zlib-packed table of documents and,
at its end, the places of all these. Codes come from the counts of all ids of all documents.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordmill.llm import huffman
from recordmill.llm.common import file_system, pieces, worker_memory, workspace, written

TOKENIZER = "byte_bpe_50k.json"  # of the public tokenizer files
END_ID = 2
FILE_IDS = 16 << 20  # ids of one file
CACHE_WORDS = 650_000  # words whose ids a worker remembers
MAGIC = b"IDHUFF01"

DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"
PIECE = 4 << 20  # characters of the texts that are encoded at a time
# A text with blanks other than single spaces and single line ends between words is encoded as a whole.
OTHER_BLANKS = (
    "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ASCII_BLANKS = OTHER_BLANKS[:8]
DOUBLE_BLANKS = ("  ", "\n\n", " \n", "\n ")
# Letters or digits, then marks: two pieces for the tokenizer, the first with the blank before it.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LETTERS_END = "\u0250"  # letters before it are letters for the tokenizer's library too
ENDINGS = 10_000  # runs of marks that are remembered


def irregular(text: str) -> bool:
    blanks = ASCII_BLANKS if text.isascii() else OTHER_BLANKS
    return text[:1] in " \n" or text[-1:] in " \n" or any(b in text for b in DOUBLE_BLANKS) or any(b in text for b in blanks)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Places(dict):
    """Words after a blank, or after a line end that they start with, to their place in the pool; an unknown one is
    encoded and remembered."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> int:
        self[word] = place = self.encode(word)
        return place


class Encoder:
    """Ids of texts. The tokenizer cuts texts into pieces before it merges bytes, and a single blank between words
    always starts a piece; so the ids of a text are those of its words, which are remembered. The special token holds
    no blank and takes none beside it, so a word with it has the same ids alone as in its text."""

    def __init__(self, path: str, remember: int = CACHE_WORDS) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.tokenize = self.whole.model.tokenize
        self.remember = remember
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (b for b in range(256) if b not in set(printable))
        # the tokenizer's characters for bytes: printable ones stand for themselves
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.sign = {"": "", " ": self.letters[32]}
        self.line_end = self.ids("\n")
        self.marks: dict[str, list[int]] = {}
        self.later = _Places(self._place)
        self.pool, self.offsets = array("i"), array("q", [0])

    def _forget(self) -> None:
        """Keep the half of the words that came first, which has the frequent ones; places follow their order."""
        kept = len(self.later) // 2
        first = list(islice(self.later.items(), kept))
        self.later = _Places(self._place)
        self.later.update(first)
        self.pool, self.offsets = self.pool[: self.offsets[kept]], self.offsets[: kept + 1]

    def _place(self, word: str) -> int:
        if word[0] == "\n":
            self.pool.extend(self.line_end)
            self.pool.extend(self._word(word[1:], ""))
        else:
            letters = word.rstrip(MARKS)
            if not self._is_piece(letters):
                self.pool.extend(self.ids(" " + word))
            elif len(letters) < len(word):
                # the letters alone are remembered too, for all the marks that may follow them
                at = self.later[letters]
                self.pool.extend(self.pool[self.offsets[at] : self.offsets[at + 1]])
                self.pool.extend(self._ending(word[len(letters) :]))
            else:
                self.pool.extend(self._piece(word, " "))
        self.offsets.append(len(self.pool))
        return len(self.offsets) - 2

    def ids(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _is_piece(letters: str) -> bool:
        if letters.isascii():
            return letters.isalpha() or letters.isdigit()
        return letters.isalpha() and max(letters) < LETTERS_END

    def _piece(self, letters: str, blank: str) -> list[int]:
        """The tokenizer does not cut a piece before it merges, so its model gets it at once; of ASCII only the blank
        has a character of its own."""
        shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.tokenize(self.sign[blank] + shown)]

    def _ending(self, marks: str) -> list[int]:
        if marks not in self.marks:
            if len(self.marks) >= ENDINGS:
                self.marks.clear()
            self.marks[marks] = [t.id for t in self.tokenize(marks)]
        return self.marks[marks]

    def _word(self, word: str, blank: str) -> list[int]:
        """Ids of a word without line ends: letters or digits, and marks after them, are a piece each."""
        letters = word.rstrip(MARKS)
        if not self._is_piece(letters):
            return self.ids(blank + word)
        ids = self._piece(letters, blank)
        return ids + self._ending(word[len(letters) :]) if len(letters) < len(word) else ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the number of ids of each."""
        if len(self.offsets) > self.remember:
            self._forget()
        # a text that is not empty starts with ids that are not remembered, of its first word or of it as a whole
        once, ends, rests, counts = array("i"), array("q", [0]), [], []
        for text in texts:
            n = 0
            if text:
                if irregular(text):
                    once.extend(self.ids(text))
                else:
                    head, _, rest = text.replace("\n", " \n").partition(" ")
                    once.extend(self._word(head, ""))
                    if rest:
                        rests.append(rest)
                        n = rest.count(" ") + 1
                ends.append(len(once))
                n += 1
            counts.append(n)
        different, indices = _different(rests)
        known = np.array(list(map(self.later.__getitem__, different)), dtype=np.int64)
        offsets = np.frombuffer(self.offsets, dtype=np.int64)
        begin, size = offsets[known], offsets[known + 1] - offsets[known]
        pool = np.concatenate([_stretches(np.frombuffer(self.pool, dtype=np.int32), begin, size), np.array(once, dtype=np.int32)])
        size = np.concatenate([size, np.diff(np.array(ends, dtype=np.int64))])
        begin = np.cumsum(size) - size
        counts = np.array(counts, dtype=np.int64)
        stop = np.cumsum(counts)
        first = (stop - counts)[counts > 0]
        place = np.empty(int(counts.sum()), dtype=np.int64)
        later = np.ones(len(place), dtype=bool)
        later[first] = False
        place[first] = len(known) + np.arange(len(first))
        place[later] = indices
        size = size[place]
        own = np.concatenate([[0], np.cumsum(size)])
        return _stretches(pool, begin[place], size), own[stop] - own[stop - counts]


def _different(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The different words of these texts, and of every word its place among them: only different ones are looked up.

    Arrow finds them. Its pool keeps what it has once taken, so that is given back to the system every time.
    """
    words = pc.split_pattern(pa.array(texts, pa.large_string()), " ").flatten().dictionary_encode()
    different, indices = words.dictionary.to_numpy(zero_copy_only=False).tolist(), np.array(words.indices)
    del words
    pa.default_memory_pool().release_unused()
    return different, indices


def _stretches(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` of these begins and sizes, end to end."""
    ends = np.cumsum(size)
    return values[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker. Spark hands a worker one task after another, and words encoded for one are
    known to the next; a new worker starts without any. Tasks of other operators that read whole texts let it go."""
    held = worker_memory()
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def tokenized(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """A written table in order of doc_id: part and row in it, doc_id, and the ids of the text as 32-bit integers.

    Ties of doc_id go by the text. Row groups keep their order, so the files can be read back in it.
    """
    path = tokenizer_path(tokenizer)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = worker_encoder(path)
        row = 0
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for i, j in pieces(texts, PIECE):
                ids, sizes = encoder.encode(texts[i:j])
                ends = np.cumsum(sizes)
                own = [np.append(ids[b - n : b], np.int32(end_id)).astype("<i4").tobytes() for b, n in zip(ends, sizes)]
                some = batch.iloc[i:j]
                yield pd.DataFrame(
                    {"part": some["part"], "row": np.arange(row, row + len(some)), "doc_id": some["doc_id"].astype("Int64"), "ids": own}
                )
                row += len(some)

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    return written(ordered.mapInPandas(encode, "part int, row long, doc_id long, ids binary"), folder, "ids")


def id_counts(ids: DataFrame) -> np.ndarray:
    """Counts of all ids; as many numbers as the tokenizer has ids. Tasks add up their own rows first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            own = np.bincount(np.frombuffer(b"".join(batch["ids"]), "<i4"))
            if len(own) > len(total):
                own[: len(total)] += total
                total = own
            else:
                total[: len(own)] += own
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})

    rows = ids.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r.id for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def _file(ids: np.ndarray, docs: list[int | None], sizes: list[int], codes: np.ndarray, lengths: np.ndarray) -> bytes:
    blocks = [huffman.encode_block(ids[i : i + huffman.BLOCK], codes, lengths) for i in range(0, len(ids), huffman.BLOCK)]
    table = zlib.compress(lengths.tobytes())
    known = np.array([d is not None for d in docs], dtype=np.uint8)
    names = np.array([d or 0 for d in docs], dtype="<i8")
    listed = zlib.compress(known.tobytes() + names.tobytes() + np.array(sizes, dtype="<i8").tobytes())
    places = np.cumsum([len(MAGIC) + len(table), *map(len, blocks), len(listed)], dtype="<i8")
    end = places.tobytes() + struct.pack("<IQ", len(places), len(docs)) + MAGIC
    return b"".join([MAGIC, table, *blocks, listed, end])


def write_files(ids: DataFrame, folder: str) -> DataFrame:
    """Write the id files; returns a written table with a row per file: its place in the order, path and ids.

    A file holds rows that follow each other in one part. Files of failed attempts have other names and are not
    in the table.
    """
    lengths = huffman.code_lengths(id_counts(ids))
    codes, _ = huffman.canonical(lengths)

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int | None, np.ndarray]] = []
        begin, last, size = (0, 0), None, 0

        def flush() -> pd.DataFrame:
            path = f"{folder}/{uuid.uuid4().hex}.ids"
            fs, local = file_system(path)
            data = _file(np.concatenate([x for _, x in held]), [d for d, _ in held], [len(x) for _, x in held], codes, lengths)
            with fs.open_output_stream(local) as out:
                out.write(data)
            return pd.DataFrame({"part": [begin[0]], "row": [begin[1]], "path": [path], "n": [size]})

        fs, local = file_system(folder)
        fs.create_dir(local, recursive=True)
        for batch in batches:
            names = [None if pd.isna(d) else int(d) for d in batch["doc_id"]]
            for part, row, name, data in zip(batch["part"].tolist(), batch["row"].tolist(), names, batch["ids"]):
                own = np.frombuffer(data, "<i4")
                if held and ((part, row - 1) != last or size + len(own) > FILE_IDS):
                    yield flush()
                    held.clear()
                    size = 0
                if not held:
                    begin = (part, row)
                held.append((name, own))
                size += len(own)
                last = (part, row)
        if held:
            yield flush()

    return written(ids.mapInPandas(put, "part int, row long, path string, n long"), folder, "files")


def read_files(files: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, ids of all documents before it, its ids' number and checksum."""

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"].tolist()):
                fs, local = file_system(path)
                with fs.open_input_file(local) as f:
                    n_places, n_docs = struct.unpack("<IQ", f.read_at(12, f.size() - len(MAGIC) - 12))
                    places = np.frombuffer(f.read_at(8 * n_places, f.size() - len(MAGIC) - 12 - 8 * n_places), "<i8").tolist()
                    lengths = np.frombuffer(zlib.decompress(f.read_at(places[0] - len(MAGIC), len(MAGIC))), np.uint8)
                    listed = zlib.decompress(f.read_at(places[-1] - places[-2], places[-2]))
                    table = huffman.decoding_table(lengths)
                    blocks = (f.read_at(b - a, a) for a, b in zip(places[:-2], places[1:-1]))
                    ids = np.concatenate([huffman.decode_block(x, table) for x in blocks]).astype("<u4")
                known = np.frombuffer(listed, np.uint8, n_docs)
                names = np.frombuffer(listed, "<i8", n_docs, n_docs)
                sizes = np.frombuffer(listed, "<i8", n_docs, 9 * n_docs)
                ends = np.cumsum(sizes)
                sums = [zlib.crc32(ids[b - n : b]) for b, n in zip(ends, sizes)]
                yield pd.DataFrame(
                    {"doc_id": pd.array(names, dtype="Int64").copy(), "start": start + ends - sizes, "n_tokens": sizes, "ids_crc32": sums}
                ).assign(doc_id=lambda d: d["doc_id"].where(known == 1))

    before = Window.orderBy("part", "row").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file, not per document
    listed = files.select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    spread = listed.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism), "path")
    return spread.mapInPandas(get, DOC_SCHEMA)


def encoded(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Write the texts of ``docs`` (doc_id, text; other columns are not read) as id files and read these back.

    A null text is an empty one and gives the end id alone. Rows are in ascending order of doc_id, nulls first;
    repeated rows are written as often as they come. An empty table gives an empty table.
    """
    folder = workspace(docs.sparkSession, "tokens")
    return read_files(write_files(tokenized(docs, folder, tokenizer, end_id), folder))
