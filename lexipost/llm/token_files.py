"""Token ids as ORC files: writing, reading by stripe, and offsets from the files.

Rows are range-partitioned and sorted by document id, so each file and each stripe of a
file covers a narrow range of ids. ORC stores ids in run-length encoded integer columns,
keeps minima and maxima per stripe and per row group (its row index), and Bloom filters
on the document id: a look-up by id skips files, stripes and row groups by metadata. A
reader splits files at stripes, so stripes are read in parallel.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexipost.llm.arrow import gathered, map_batches
from lexipost.llm.bpe import byte_letters

STRIPE_BYTES = 64 << 20
ROW_INDEX_STRIDE = 1_000  # documents per row group
BLOOM_FPP = 0.01
CACHE_CHUNKS = 300_000  # chunks per generation; two generations are kept
ENCODED_AT_ONCE = 4_096  # the library's encodings are large, so they are few at a time
BATCH_CHARS = 8 << 20  # text whose different chunks are looked up at once

TOKEN_SCHEMA = "doc_id bigint, n_tokens int, ids array<int>"
WORDS_IN_A_ROW = 64  # words that the library encodes as one sequence
_MARKS = ".,;:!?%$&*#"  # neither letters, digits, white space nor apostrophes
_WORD = r"\A[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+\z"  # Latin letters

_caches: dict[int, ChunkIds] = {}


def _listed(values: pa.Array) -> list:
    """The values of an array without nulls; ``to_pylist`` makes an object more for each."""
    return values.to_numpy(zero_copy_only=False).tolist()


class ChunkIds:
    """The ids, as bytes, of what stands between two spaces.

    The pattern of byte-level vocabularies lets a space join the piece after it and never
    the piece before, so a text may be cut before every single space. Chunks are kept
    without that space, in two generations: the older goes when the newer is full.
    """

    def __init__(self, spec: str) -> None:
        # The task's core is the parallelism; the library's own threads would take those of
        # other tasks, and their memory. Read by the library when it encodes.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        # Texts are encoded whole, whatever the file says about lengths.
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.codes = np.array([ord(letter) for letter in self.letters], "<u2")
        self.gap = _free_byte(json.loads(spec)["model"], self.letters)
        # The same merges for text that is cut already.
        self.bare = Tokenizer(self.model)
        # By whether a space stands before the chunk.
        self.newer: dict[bool, dict[str, bytes]] = {True: {}, False: {}}
        self.older: dict[bool, dict[str, bytes]] = {True: {}, False: {}}
        self.marks: dict[str, bytes] = {}
        self.line_end = self.encode("\n")

    def _words(self, words: list[str], spaced: bool) -> list[bytes]:
        """The ids of words of letters, which the pattern leaves whole, from the library's model.

        Words stand in one sequence behind each other, each with a byte after it that no merge
        takes, so that no merge reaches from one word into the next.
        """
        space = " " if spaced else ""
        out: list[bytes] = []
        if self.gap is None:
            for word in words:
                ids = self.model.tokenize(self._spelled((space + word).encode()))
                out.append(array("I", [t.id for t in ids]).tobytes())
            return out
        mark, mark_id = self.gap
        for at in range(0, len(words), ENCODED_AT_ONCE):
            part = words[at : at + ENCODED_AT_ONCE]
            rows = [
                self._spelled("".join([f"{space}{w}{mark}" for w in part[k : k + WORDS_IN_A_ROW]]).encode())
                for k in range(0, len(part), WORDS_IN_A_ROW)
            ]
            found = self.bare.encode_batch_fast(rows, add_special_tokens=False)
            flat = np.concatenate([np.array(f.ids, "<u4") for f in found])
            ends = np.flatnonzero(flat == mark_id)
            if len(ends) != len(part):
                raise ValueError("the vocabulary merges words with the byte between them")
            raw = flat.tobytes()
            starts = [0, *(4 * (ends[:-1] + 1)).tolist()]
            out += [raw[a:b] for a, b in zip(starts, (4 * ends).tolist(), strict=True)]
        return out

    def _spelled(self, text: bytes) -> str:
        return self.codes[np.frombuffer(text, np.uint8)].tobytes().decode("utf-16-le")

    def _tail(self, tail: str) -> bytes:
        """The ids of marks behind a word."""
        if tail not in self.marks:
            if len(self.marks) > ENCODED_AT_ONCE:
                self.marks.clear()
            self.marks[tail] = array("I", [t.id for t in self.model.tokenize(tail)]).tobytes()
        return self.marks[tail]

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), ENCODED_AT_ONCE):
            part = texts[at : at + ENCODED_AT_ONCE]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            out += [np.array(f.ids, "<u4").tobytes() for f in found]
        return out

    def runs(self, chunks: pa.StringArray, spaced: bool) -> list[bytes | None]:
        """The ids of each different chunk, after a space or without one.

        The pattern cuts Latin letters from marks behind them; words are looked up without
        their marks. A chunk with white space at an edge, of itself or of one of its lines,
        has None: its text must be encoded whole.
        """
        core = pc.utf8_rtrim(chunks, _MARKS)
        word = pc.match_substring_regex(core, _WORD)
        keys = pc.if_else(word, core, chunks).dictionary_encode()
        letters = pc.match_substring_regex(keys.dictionary, _WORD)
        found = self._keys(_listed(keys.dictionary), _listed(letters), spaced)
        out = [found[k] for k in _listed(keys.indices)]
        marked = pc.indices_nonzero(pc.and_(word, pc.not_equal(core, chunks)))
        texts, sizes = _listed(chunks.take(marked)), _listed(pc.utf8_length(core.take(marked)))
        for i, text, size in zip(_listed(marked), texts, sizes, strict=True):
            out[i] += self._tail(text[size:])
        return out

    def _keys(self, keys: list[str], letters: list[bool], spaced: bool) -> list[bytes | None]:
        """The ids of different words (of ``letters`` only) and other chunks."""
        newer, older = self.newer[spaced], self.older[spaced]
        out = list(map(newer.get, keys))
        words, rest = [], []
        for i, found in enumerate(out):
            if found is not None:
                continue
            key = keys[i]
            ids = older.get(key)
            if ids is not None:
                out[i] = newer[key] = ids
            elif letters[i]:
                words.append(i)
            elif key == key.strip():
                rest.append(i)
        for i, ids in zip(words, self._words([keys[i] for i in words], spaced), strict=True):
            out[i] = newer[keys[i]] = ids
        lines = [i for i in rest if "\n" in keys[i]]
        others = [i for i in rest if "\n" not in keys[i]]
        texts = [f" {keys[i]}" if spaced else keys[i] for i in others]
        for i, ids in zip(others, self.encode_all(texts), strict=True):
            out[i] = newer[keys[i]] = ids
        if lines:
            # "a.\nB" is "a.", "\n", "B" if no white space stands at the line end.
            cut = [keys[i].split("\n") for i in lines]
            heads = list({x[0] for x in cut})
            tails = list({t for x in cut for t in x[1:]})
            head = dict(zip(heads, self.runs(pa.array(heads, pa.string()), spaced), strict=True))
            tail = dict(zip(tails, self.runs(pa.array(tails, pa.string()), False), strict=True))
            for i, (first, *more) in zip(lines, cut, strict=True):
                parts = [head[first], *[tail[x] for x in more]]
                if all(parts):  # neither empty nor to be encoded whole
                    out[i] = self.line_end.join(parts)
        return out

    def age(self) -> None:
        for spaced in (True, False):
            if len(self.newer[spaced]) > CACHE_CHUNKS:
                self.older[spaced], self.newer[spaced] = self.newer[spaced], {}


def _free_byte(model: dict, letters: list[str]) -> tuple[str, int] | None:
    """A control character, and its id, that takes part in no merge; None if there is none.

    None, too, for models in which the place in a sequence matters.
    """
    places = ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")
    if any(model.get(p) for p in places):
        return None
    merged = {a for m in model["merges"] for a in "".join(m if isinstance(m, list) else m.split(" "))}
    free = (b for b in range(9) if letters[b] in model["vocab"] and letters[b] not in merged)
    byte = next(free, None)
    return None if byte is None else (chr(byte), model["vocab"][letters[byte]])


def encode_texts(
    texts: pa.StringArray, chunks: ChunkIds, end: bytes = b""
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after the other, ``end`` behind each, and their numbers.

    Arrow cuts the texts at their spaces and numbers the different chunks; only these are
    looked up. A text with two spaces in a row or one at an edge is encoded whole, and so
    is one with a chunk that needs it. The runs of ids are then put in place by numpy.
    """
    texts = pc.fill_null(texts, "")
    odd = pc.or_(
        pc.match_substring(texts, "  "),
        pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")),
    )
    whole = pc.or_(odd, pc.equal(texts, "")).to_numpy(zero_copy_only=False).astype(bool)
    plain = np.flatnonzero(~whole)
    lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    starts, counts = offsets[:-1] - offsets[0], np.diff(offsets)
    number = coded.indices.to_numpy().astype(np.int64)
    different = coded.dictionary
    firsts, first = np.unique(number[starts], return_inverse=True)
    inner = np.ones(len(number), bool)
    inner[starts] = False
    used = np.zeros(len(different), bool)
    used[number[inner]] = True
    table: list[bytes | None] = [b""] * len(different)
    at = np.flatnonzero(used)
    for i, ids in zip(at.tolist(), chunks.runs(different.take(pa.array(at)), True), strict=True):
        table[i] = ids
    number[starts] = len(table) + first
    table += chunks.runs(different.take(pa.array(firsts)), False)
    ragged = np.array([ids is None for ids in table], bool)
    if ragged.any():
        broken = np.logical_or.reduceat(ragged[number], starts)
        whole[plain[broken]] = True
        kept = np.repeat(~broken, counts)
        number, counts, plain = number[kept], counts[~broken], plain[~broken]

    # Every text is a row of runs: its chunks, or itself, and the end.
    rows = np.ones(len(texts), np.int64)
    rows[plain] = counts
    place = np.cumsum(rows + 1) - rows - 1
    order = np.empty(int((rows + 1).sum()), np.int64)
    inside = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
    order[np.repeat(place[plain], counts) + inside] = number
    alone = np.flatnonzero(whole)
    order[place[alone]] = len(table) + np.arange(len(alone))
    table += [chunks.encode(t) if t else b"" for t in texts.take(pa.array(alone)).to_pylist()]
    order[place + rows] = len(table)
    table.append(end)

    joined = [ids or b"" for ids in table]
    sizes = np.fromiter(map(len, joined), np.int64, len(joined)) // 4
    run_starts = np.cumsum(sizes) - sizes
    store = np.frombuffer(b"".join(joined), "<u4")
    lengths = sizes[order]
    ends = np.cumsum(lengths)
    source = np.repeat(run_starts[order] - (ends - lengths), lengths)
    source += np.arange(len(source))
    chunks.age()
    numbers = np.add.reduceat(lengths, place) if len(place) else lengths
    return store[source], numbers


def _file_bounds(docs: DataFrame, key: str) -> list[float]:
    """Keys that cut the table into as many files as there are shuffle partitions."""
    files = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / files for k in range(1, files)]
    return sorted(set(docs.select(key).dropna().approxQuantile(key, shares, 0.1 / files)))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode whole texts, append ``end_id`` to each, and write ORC files by ``key``.

    ``key`` is a whole number; rows ascend by it, null keys first, over the files in
    order of their numbers, and equal keys, ordered by their ids, stay in one file. A null text is empty.
    The keys alone are read first, to tell which file takes which of them; texts are
    encoded once, and ids are shuffled once.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    if json.loads(spec)["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError("a byte-level vocabulary file is needed")
    bounds = np.array(_file_bounds(docs, key), np.float64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached = hash(spec)
        if cached not in _caches:  # kept by the worker for its next tasks
            _caches.clear()
            _caches[cached] = ChunkIds(spec)
        end = np.array([end_id], "<u4").tobytes()
        for batch in gathered(batches, "_text", BATCH_CHARS):
            flat, numbers = encode_texts(batch.column("_text"), _caches[cached], end)
            ends = np.concatenate(([0], np.cumsum(numbers)))
            lists = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(flat.view(np.int32))
            )
            keys = batch.column("doc_id")
            values = keys.to_numpy(zero_copy_only=False).astype(np.float64)
            place = np.searchsorted(bounds, values, "right")
            place[keys.is_null().to_numpy(zero_copy_only=False)] = 0
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(numbers, pa.int32()), lists, pa.array(place, pa.int32())],
                ["doc_id", "n_tokens", "ids", "_file"],
            )

    kept = docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("_text")
    )
    (
        map_batches(kept, work, f"{TOKEN_SCHEMA}, _file int")
        .repartitionById(len(bounds) + 1, "_file")
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "n_tokens", "ids")
        .drop("_file")
        .write.option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", ROW_INDEX_STRIDE)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FPP)
        .option("orc.compress", "zstd")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids). A filter on doc_id reaches stripes and Bloom filters."""
    return spark.read.schema(TOKEN_SCHEMA).orc(path)


def token_offsets(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document in the files at ``path``.

    ``start`` counts the ids of all documents before it, in ascending key order. Files
    cover ascending ranges of keys in the order of their numbers, so the start of a file is the sum over the files
    before it (one row per file), and a running sum stays within the file.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat, ends = lists.flatten(), lists.offsets.to_numpy()
            ends = ends - ends[0]
            raw = memoryview(np.ascontiguousarray(flat.to_numpy(), "<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [batch.column(c) for c in ("file", "doc_id")]
            columns += [pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["file", "doc_id", "n_tokens", "ids_crc32"])

    files = read_token_files(spark, path).select(
        F.col("_metadata.file_path").alias("file"), "doc_id", "ids"
    )
    rows = map_batches(files, work, "file string, doc_id bigint, n_tokens bigint, ids_crc32 bigint")
    sizes = (
        read_token_files(spark, path)
        .select(F.col("_metadata.file_path").alias("file"), "n_tokens")
        .groupBy("file")
        .agg(F.sum("n_tokens").alias("ids"))
    )
    # By the number in the name: as text, the file after 99999 would come too early.
    place = F.regexp_extract("file", r"part-(\d+)[^/]*$", 1).cast("bigint")
    before = Window.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    inside = (
        Window.partitionBy("file")
        .orderBy(F.asc_nulls_first("doc_id"), "n_tokens", "ids_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return rows.join(F.broadcast(starts), "file").select(
        F.col("doc_id").alias(key),
        (F.col("first") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
